"""The Kneser-Ney model of op5 against an exhaustive one over real code points."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from candlewick.llm import perplexity, pointmodel

TEXTS = [
    "the cat sat on the mat", "The cat, the hat and the bat", "日本語の文章 と 日本の本", "жили-были дед и баба", "", None, "a",
    "the cat sat on the mat", "no & marks | here", "SHOUTING at 😀 cats", "\x00 nul \x00 and\nlines\n",
]


def plain(gram):
    letters = [c for c in gram if c is not None]
    marks = any(ord(c) < 128 and not (c.isalnum() or c in " \t\n\r\x0b\x0c.,-'") for c in letters)
    return not marks and sum(c.isupper() for c in letters) < 2


def spread(text):
    n = pointmodel.ORDER
    symbols = [None] * (n - 1) + list(text or "") + [None]
    return [tuple(symbols[i : i + n]) for i in range(len(symbols) - n + 1)]


class Exhaustive:
    """The textbook's formulas on dictionaries."""

    def __init__(self, texts):
        n = pointmodel.ORDER
        self.levels = {n: Counter(g for t in texts for g in spread(t) if plain(g))}
        for k in range(n - 1, 0, -1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.cuts, self.after = {}, {}
        for k, level in self.levels.items():
            have = Counter(level.values())
            y = have[1] / max(1, have[1] + 2 * have[2])
            self.cuts[k] = [0.0] + [
                min(i, max(0.1 * i, i - (i + 1) * y * have[i + 1] / have[i])) if have[i] else 0.5 * i for i in (1, 2, 3)
            ]
            self.after[k] = defaultdict(list)
            for g, c in level.items():
                self.after[k][g[:-1]].append(c)

    def probability(self, gram):
        k = len(gram)
        if not k:
            return 1 / pointmodel.BORDER
        lower, counts = self.probability(gram[1:]), self.after[k].get(gram[:-1])
        if not counts:
            return lower
        cut = lambda c: self.cuts[k][min(c, 3)]
        c = self.levels[k][gram]
        return (c - cut(c) + sum(map(cut, counts)) * lower) / sum(counts)


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    return pointmodel.trained(rows)


def test_probabilities_match_an_exhaustive_model(model):
    want, asked = Exhaustive(TEXTS), [t or "" for t in TEXTS] + ["the dog 猫", "\U0010ffff\ud800x", "ZZ%%", "ab" * 40]
    found = model.log_perplexity(asked)
    for text, got in zip(asked, found, strict=True):
        logs = [np.log(want.probability(g)) for g in spread(text)]
        assert got == pytest.approx(-sum(logs) / len(logs), rel=1e-9), text


def test_probabilities_sum_to_one(model):
    seen = {c for t in TEXTS for c in t or ""}
    for context in ("the ", "日本語の", "....", "q猫&Z"):
        before = [ord(c) + 1 for c in context]
        windows = [[*before, s] for s in [*(ord(c) + 1 for c in seen), pointmodel.BORDER, ord("ß") + 1]]
        symbols = np.array(windows, np.uint32).ravel()
        got = model.probability(symbols, np.arange(len(windows)) * pointmodel.ORDER)
        unseen = pointmodel.BORDER - len(seen) - 1  # each as likely as the last
        assert got[:-1].sum() + unseen * got[-1] == pytest.approx(1, abs=1e-9)


def test_long_texts_and_many_symbols_are_looked_at_whole(model, monkeypatch):
    every = "".join(map(chr, [*range(0x3400, 0x9000), *range(0xAC00, 0xD000)])) * 2
    asked = ["the cat sat " * 50, "日本", every, ""]
    whole = model.log_perplexity(asked)
    for block in (7, 1000):
        monkeypatch.setattr(pointmodel, "BLOCK", block if block > 7 else 1 << 15)
        assert model.log_perplexity(asked) == pytest.approx(whole, rel=1e-12)
    symbols = next(pointmodel.windows([every]))[0]
    number, first = pointmodel.distinct(*pointmodel.dense(symbols), None, pointmodel.ORDER)
    rows = np.lib.stride_tricks.sliding_window_view(symbols, pointmodel.ORDER)
    assert (rows[first][number] == rows).all() and len(first) == len(np.unique(rows, axis=0))


def test_letters_of_other_scripts_are_told_apart(spark):
    """Letters 31 code points on were one symbol once, so that junk made of them looked like the text."""
    base = "длинный рассказ о том как жили люди на берегу моря и ловили рыбу каждый день пока солнце не село " * 6
    junk = "".join(chr(ord(c) + 31 * 40) if ord(c) > 127 else c for c in base)
    rows = [(i, base[i:] + base[:i], "ru") for i in range(40)] + [(100, junk, "ru")]
    found = perplexity.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).toPandas().set_index("doc_id")
    assert found.n_words.min() >= perplexity.MIN_WORDS
    got = found.log_perplexity
    assert got[100] > 1.5 * got[0] and not found.loc[100, "n_symbols"]


def test_no_texts_and_nothing_plain(spark):
    made = spark.createDataFrame([(1, "%%%%% &&"), (2, None)], "doc_id long, text string")
    assert np.isfinite(pointmodel.trained(made).log_perplexity(["%%", "", "ok"])).all()
    nothing = pointmodel.trained(made.limit(0))
    assert nothing.log_perplexity(["ab"]) == pytest.approx(np.log(pointmodel.BORDER))
