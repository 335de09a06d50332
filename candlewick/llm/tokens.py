"""Token counts: exact counts at every prefix by dynamic programming over the prefixes of units.

A sentencepiece BPE text falls into units (a run of word marks and what follows up to the next), and
no piece crosses them.  Within a unit, the last token of each prefix is the one token t that ends there
and may follow the last token of the prefix before t, so count(prefix) = count(prefix before t) + 1.
A pair of tokens may follow each other if merging their joined text gives just these two.  Counts at
every prefix of a unit are kept by prefix, so that words sharing a beginning share its work; counts at
unit ends add up to counts at every prefix of a text, which a prefix table holds as runs of equal counts.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, read

MARK = "▁"  # stands for a space in pieces
LIMIT = 4096
#: Entries of the memo per Python worker; beyond them it starts anew (a cache size: results don't change).
MEMO_PREFIXES = 500_000
INFINITE = float("inf")
LONG_UNIT = 200
_UNIT = re.compile(f"{MARK}*[^{MARK}]*")


class PrefixCounter:
    """Token counts of prefixes for one sentencepiece BPE model with byte fallback and no normalizing."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.ranks = {model.id_to_piece(i): -model.get_score(i) for i in ids if i not in special}
        self.longest = max(map(len, self.ranks))
        if any(MARK in piece.lstrip(MARK) for piece in self.ranks):
            raise ValueError("a piece joins two words: units would not be independent")
        ends: dict[str, set[int]] = {}
        for piece in self.ranks:
            if len(piece) > 2:
                ends.setdefault(piece[-3:], {1, 2}).add(len(piece))
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in ends.items()}  # by last three
        self.same: dict[str, str] = {}
        self.split: dict[str, tuple[str, str] | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, tuple[int, str]] = {"": (0, "")}
        self.insides: dict[str, bytes] = {}
        counter = self

        class Words(dict):
            def __missing__(self, word: str) -> int:
                if len(self) > MEMO_PREFIXES:
                    self.clear()
                n = self[word] = counter.unit(MARK + word)
                return n

        self.words = Words()

    def merged(self, text: str, until: int = 1) -> list[str]:
        """The tokens of a short text by merging (best score first, leftmost of equals), down to until."""
        parts = list(text)
        while len(parts) > until:
            ranks = [self.ranks.get(a + b, INFINITE) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == INFINITE:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: str) -> tuple[str, str] | None:
        """The two parts that the last merge of a token joins; none if merging doesn't make it."""
        if token not in self.split:
            parts = self.merged(token, until=2)
            self.split[token] = tuple(parts) if len(parts) == 2 else None
        return self.split[token]

    def follows(self, before: str, token: str) -> bool:
        """Whether merging before + token gives just these two: no merge across their border comes
        before the merges that make them.  Walks back through the merges on both sides of it."""
        key = (before, token)
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) > MEMO_PREFIXES:
                self.pairs.clear()
            known = self.pairs[key] = self._follows(before, token)
        return known

    def _follows(self, a: str, b: str) -> bool:
        if len(b) > 1 and self.halves(b) is None:
            return False
        limit = INFINITE
        while a:
            if self.ranks.get(a + b, INFINITE) < limit:
                return False
            rank_a = self.ranks[a] if len(a) > 1 else -1
            rank_b = self.ranks[b] if len(b) > 1 else -1
            if rank_a > rank_b:
                limit, a = rank_a, self.halves(a)[1]
            elif rank_b < 0:
                break
            else:  # of equal merges the left one comes first
                limit, b = rank_b + 1, self.halves(b)[0]
        return True

    @staticmethod
    @lru_cache(100_000)
    def _fallback(char: str) -> int:
        return len(char.encode("utf-8", "surrogatepass"))

    def prefixes(self, unit: str) -> list[int]:
        """Tokens of every prefix of a unit, from the empty one on."""
        return [n for n, _ in self._by_position(unit)] if len(unit) > LONG_UNIT else [n for n, _ in self._states(unit, {"": (0, "")}, 0)]

    def _states(self, unit: str, memo: dict, known: int) -> list[tuple[int, str]]:
        """(tokens, last token) of the prefixes after the first known characters, put into memo."""
        ranks, lengths, pairs, states = self.ranks, self.lengths, self.pairs, [memo[""]]
        for end in range(known + 1, len(unit) + 1):
            for length in lengths.get(unit[max(0, end - 3) : end], (2, 1)):
                if length > end:
                    continue
                token = unit[end - length : end]
                if token in ranks or length == 1:
                    n, last = memo[unit[: end - length]]
                    if (ok := pairs.get((last, token))) is None:
                        ok = self.follows(last, token)
                    if ok:
                        break
            state = (n + (1 if token in ranks else self._fallback(token)), self.same.setdefault(token, token))
            memo[unit[:end]] = state
            states.append(state)
        return states

    def unit(self, unit: str) -> int:
        """Tokens of a whole unit; prefixes already met are looked up."""
        if len(unit) > LONG_UNIT:
            return self._by_position(unit)[-1][0]
        memo = self.memo
        if len(memo) > MEMO_PREFIXES:
            memo.clear()
            memo[""] = (0, "")
        known = len(unit)
        while unit[:known] not in memo:
            known -= 1
        if known < len(unit):
            self._states(unit, memo, known)
        return memo[unit][0]

    def _by_position(self, unit: str) -> list[tuple[int, str]]:
        """As _states() with no memo and states by position: slices of a long unit would be costly."""
        states = [(0, "")]
        for end in range(1, len(unit) + 1):
            for length in range(min(self.longest, end), 0, -1):
                token = unit[end - length : end]
                if (token in self.ranks or length == 1) and self.follows(states[end - length][1], token):
                    states.append((states[end - length][0] + (1 if token in self.ranks else self._fallback(token)), token))
                    break
        return states

    def units(self, text: str) -> list[str]:
        return [u for u in _UNIT.findall(MARK + text.replace(" ", MARK)) if u] if text else []

    def count(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            return sum(map(self.unit, self.units(text)))
        return sum(map(self.words.__getitem__, text.split(" ")))

    def ends(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(characters, tokens) up to the end of each unit: with prefixes(), a count at every prefix."""
        units = self.units(text)
        chars = np.fromiter(accumulate(map(len, units)), np.int64, len(units)) - 1
        return chars, np.fromiter(accumulate(map(self.unit, units)), np.int64, len(units))

    def _inside(self, unit: str) -> bytes:
        """Tokens of every prefix of a unit but the empty one, as 32-bit numbers."""
        if len(unit) > LONG_UNIT:
            return np.array(self.prefixes(unit)[1:], np.uint32).tobytes()
        if len(self.insides) > MEMO_PREFIXES:
            self.insides.clear()
        self.unit(unit)  # puts every prefix into the memo
        memo = self.memo
        known = self.insides[unit] = array("I", [memo[unit[:i]][0] for i in range(1, len(unit) + 1)]).tobytes()
        return known

    def runs(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(characters of the last prefix, tokens) of each run of prefixes with equal counts: a count at
        every prefix of the text, the empty one included."""
        if not text:
            return np.zeros(1, np.int64), np.zeros(1, np.int64)
        units, insides = self.units(text), self.insides
        counts = np.frombuffer(b"".join([insides.get(u) or self._inside(u) for u in units]), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        before = np.append(0, np.cumsum(counts[np.cumsum(sizes) - 1])[:-1])
        counts += np.repeat(before, sizes)
        counts[0] = 0  # the mark before the text is no prefix of it
        ends = np.append(np.flatnonzero(np.diff(counts)), len(counts) - 1)
        return ends, counts[ends]

    def at(self, text: str, n_chars: int) -> int:
        """Tokens of the text's first n_chars characters."""
        chars, tokens = self.ends(text)
        if n_chars <= 0 or not len(chars):
            return 0
        k = int(np.searchsorted(chars, n_chars))
        if k == len(chars):
            return int(tokens[-1])
        begin = int(chars[k - 1]) + 1 if k else 0  # in the marked text, which has one mark more
        return (int(tokens[k - 1]) if k else 0) + self.prefixes(self.units(text)[k])[n_chars + 1 - begin]

    def cut(self, text: str, budget: int) -> int:
        """Characters of the longest prefix that takes at most budget tokens."""
        return self._fit(*self.runs(text), budget)

    @staticmethod
    def _fit(ends: np.ndarray, counts: np.ndarray, budget: int) -> int:
        fit = np.flatnonzero(counts <= budget)
        return int(ends[fit[-1]]) if len(fit) else 0

    def counted(self, text: str, budget: int) -> tuple[int, int]:
        """(tokens, characters that fit budget: all where the text does); long texts, which hardly fit, are encoded once."""
        if len(text) <= 4 * budget and (n := self.count(text)) <= budget:
            return n, len(text)
        ends, counts = self.runs(text)
        n = int(counts[-1])
        return n, len(text) if n <= budget else self._fit(ends, counts, budget)


@lru_cache(2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit and cut_chars, the characters that fit limit.

    Null and empty texts have 0 tokens.  Repeated rows are counted each; other columns are ignored.
    """

    def row(texts: list[str]) -> dict:
        c = counter(model_path)
        tokens, cuts = zip(*[c.counted(t, limit) for t in texts], strict=True)
        return {
            "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
            "n_tokens": list(tokens),
            "over_limit": [n > limit for n in tokens],
            "cut_chars": list(cuts),
        }

    return map_texts(docs, row, "n_bytes long, n_tokens long, over_limit boolean, cut_chars long")


def prefix_table(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document the exact token count of every prefix, run by run: ends (characters of the last
    prefix of each run of equal counts) and counts (tokens).  count_at() and fits() answer from them.
    """

    def row(texts: list[str]) -> dict:
        both = [counter(model_path).runs(t) for t in texts]
        return {"ends": [a for a, _ in both], "counts": [b for _, b in both]}

    return map_texts(docs, row, "ends array<long>, counts array<long>")


def count_at(n_chars: int):
    """Tokens of the first n_chars characters (of the whole text if it is shorter), from a prefix table."""
    n = F.size(F.filter("ends", lambda e: e < n_chars))
    return F.element_at("counts", F.least(n + 1, F.size("counts")))


def fits(budget: int):
    """Characters of the longest prefix that takes at most budget tokens, from a prefix table."""
    fit = F.filter(F.arrays_zip("ends", "counts"), lambda r: r["counts"] <= budget)
    return F.when(F.size(fit) > 0, F.element_at(fit, -1)["ends"]).otherwise(0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
