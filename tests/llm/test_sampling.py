"""op4's draws and shingles against plain versions."""

import numpy as np
import pytest
from candlewick.llm import neardup
from candlewick.llm.neardup import BETA, INVERSE_R, LOG_C, MORE_SEEDS, R, SEEDS


def every_element(hashes, weights, seeds):
    """The draws, with all elements looked at for all seeds at once."""
    lw = np.log(weights).astype(np.float32)[None, :]
    x = neardup._mixed(seeds[:, None] ^ hashes[None, :])
    spot, other = (x >> np.uint64(52)).astype(int), (x & np.uint64(4095)).astype(int)
    part = ((x >> np.uint64(28)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(2.0**-24)
    t = np.floor(lw * INVERSE_R[other] + BETA[other])
    a = LOG_C[spot] + part * (LOG_C[spot + 1] - LOG_C[spot]) - R[other] * (t + 1 - BETA[other])
    at = a.argmin(axis=1)
    return neardup._mixed(hashes[at] + t[np.arange(len(seeds)), at].astype(np.int64).view(np.uint64))


@pytest.mark.parametrize("seeds", [SEEDS, MORE_SEEDS])
def test_draws_are_those_of_looking_at_every_element(seeds):
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 450, 9000):
        hashes = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for weights in (np.ones(n), rng.uniform(0.1, 9, n), np.exp(rng.uniform(-2, 16, n)), np.full(n, 1e-3)):
            assert (neardup.sampled(hashes, weights, seeds) == every_element(hashes, weights, seeds)).all()


def test_only_elements_that_may_be_least_are_looked_at_closely(monkeypatch):
    looked, values = [], neardup._values
    monkeypatch.setattr(neardup, "_values", lambda x, lw: looked.append(x.size) or values(x, lw))
    rng = np.random.default_rng(5)
    hashes, weights = rng.integers(0, 2**64, 2000, dtype=np.uint64), rng.uniform(1, 9, 2000)
    neardup.sampled(hashes, weights)
    assert 0 < sum(looked) < 0.3 * len(SEEDS) * len(hashes)


def test_shingles_do_not_reach_into_the_next_text():
    texts = ["", "one", "a b c d", "a b c d e", " ", "a b c d e f a b c d e", "x y", "\n", "b c d e f", "é 日 本 😀 ü z"]
    alone = [next(neardup.shingled([t])) for t in texts]
    for found, (hashes, counts) in zip(neardup.shingled(texts), alone, strict=True):
        assert found[0].tolist() == hashes.tolist() and found[1].tolist() == counts.tolist()
    assert [int(n.sum()) for _, n in alone] == [0, 1, 1, 1, 0, 7, 1, 0, 1, 2]
    assert alone[5][1].max() == 2 and set(alone[3][0]) <= set(alone[5][0]) and set(alone[8][0]) <= set(alone[5][0])
