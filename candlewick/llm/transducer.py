"""Minimal acyclic transducers: sorted terms as an automaton whose paths add up to their ordinals.

A state's edges carry a byte and the number of terms that sort before the ones behind the edge, so the
sum along a term's path is its place among all terms.  States with equal ends are one state.  Terms are
looked up in numpy, all at once, one byte of each per step.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

_HEAD = 4  # terms, edges, states, root


def build(terms: Iterable[bytes]) -> bytes:
    """The transducer of distinct terms in ascending order, as bytes (see ``Transducer``)."""
    ends: list[bool] = []
    edges: list[tuple[tuple[int, int], ...]] = []
    below: list[int] = []  # terms behind a state
    known: dict[tuple, int] = {}
    path: list[list] = [[False, []]]  # the states along the last term: does a term end here, edges
    last: bytes | None = None

    def settled(node: list) -> int:
        """The number of the state that equals node; new if there is none."""
        key = (node[0], tuple(node[1]))
        state = known.get(key)
        if state is None:
            state = known[key] = len(ends)
            ends.append(key[0])
            edges.append(key[1])
            below.append(key[0] + sum(below[target] for _, target in key[1]))
        return state

    def close(depth: int) -> None:
        while len(path) > depth:
            state = settled(path.pop())
            path[-1][1].append((last[len(path) - 1], state))

    for term in terms:
        if last is not None and term <= last:
            raise ValueError("terms have to be distinct and in ascending order")
        shared = 0
        if last is not None:
            limit = min(len(term), len(last))
            while shared < limit and term[shared] == last[shared]:
                shared += 1
            close(shared + 1)
        path.extend([False, []] for _ in term[shared:])
        path[-1][0] = True
        last = term
    close(1)
    root = settled(path[0])

    keys, targets, adds = [], [], []
    for state, out in enumerate(edges):
        add = int(ends[state])
        for byte, target in out:
            keys.append(state << 8 | byte)
            targets.append(target)
            adds.append(add)
            add += below[target]
    return b"".join((
        np.array([below[root], len(keys), len(ends), root], np.int64).tobytes(), np.array(keys, np.int64).tobytes(),
        np.array(targets, np.int64).tobytes(), np.array(adds, np.int64).tobytes(), np.array(ends, np.uint8).tobytes(),
    ))


class Transducer:
    """A built transducer, read in place from its bytes."""

    def __init__(self, data: bytes):
        self.size, n_edges, n_states, self.root = (int(n) for n in np.frombuffer(data, np.int64, _HEAD))
        at = 8 * _HEAD
        self.keys, self.targets, self.adds = (
            np.frombuffer(data, np.int64, n_edges, at + 8 * n_edges * part) for part in range(3)
        )
        self.ends = np.frombuffer(data, np.uint8, n_states, at + 24 * n_edges)

    def ordinals(self, terms: Sequence[bytes]) -> np.ndarray:
        """Each term's place among the stored ones, or -1."""
        lengths = np.fromiter(map(len, terms), np.int64, len(terms))
        starts = np.cumsum(lengths) - lengths
        text = np.frombuffer(b"".join(terms), np.uint8)
        states, places = np.full(len(terms), self.root), np.zeros(len(terms), np.int64)
        alive, step = np.arange(len(terms)), 0
        found = np.full(len(terms), -1, np.int64)
        while len(alive):
            done = lengths[alive] == step
            ended = alive[done]
            accepted = ended[self.ends[states[ended]] == 1]
            found[accepted] = places[accepted]
            alive = alive[~done]
            if not len(alive) or not len(self.keys):
                break
            wanted = states[alive] << 8 | text[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            same = self.keys[at] == wanted
            alive, at = alive[same], at[same]
            states[alive] = self.targets[at]
            places[alive] += self.adds[at]
            step += 1
        return found

    def term(self, ordinal: int) -> bytes:
        """The term at a place."""
        if not 0 <= ordinal < self.size:
            raise IndexError(f"{ordinal} is not among {self.size} terms")
        state, out = self.root, bytearray()
        while ordinal or not self.ends[state]:
            first, beyond = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            edge = first + int(np.searchsorted(self.adds[first:beyond], ordinal, "right")) - 1
            out.append(int(self.keys[edge]) & 255)
            ordinal -= int(self.adds[edge])
            state = int(self.targets[edge])
        return bytes(out)
