"""Modified Kneser-Ney over n-grams of real code points, kept as sorted arrays in files.

Every code point is a symbol of its own, and so is the border before and after a text: nothing is folded,
in any script.  An n-gram is spelled in three bytes a symbol, so its context and its suffix are parts of
its bytes, and Spark counts, continues and discounts n-grams as plain aggregates of binary keys.  The
table grows with the corpus; it is written in the order of its keys by the tasks that hold its ranges,
and tasks that score map the files: a lookup is a binary search, and only pages that it touches are read.
No part of it passes through the driver but the names of the files and the counts of counts.

Models learn from plain text: n-grams with a mark or with two capitals are scored like all others but
not learnt, so that markup, junk and shouting stay unlikely however much of it a corpus holds.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .charmodel import blocks
from .common import shared_folder, ship, stored, tidied, whole_text

ORDER, SPELLED = 5, 3
#: A code point's symbol is the next number, so that no symbol is 0, which pads keys.
BORDER = sys.maxunicode + 2
KEY = np.dtype(f"S{SPELLED * ORDER}")
#: Windows looked at a time, so that memory doesn't grow with a text or a batch.
BLOCK = 1 << 21


@lru_cache
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """By symbol: whether it is an ASCII mark, other than . , - and '; and whether it is a capital."""
    marks, capitals = np.zeros(BORDER + 1, bool), np.zeros(BORDER + 1, bool)
    for c in map(chr, range(128)):
        marks[ord(c) + 1] = not (c.isalnum() or c in " \t\n\r\x0b\x0c.,-'")
    capitals[1:BORDER] = np.fromiter((chr(c).isupper() for c in range(sys.maxunicode + 1)), bool, BORDER - 1)
    return marks, capitals


def windows(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols some at a time, which text each of their n-grams is of (-1 between texts), and those texts' numbers.

    A text has ORDER - 1 borders before it and one after it, so one n-gram more than it has characters.
    """
    at, edge = 0, np.full(ORDER - 1, BORDER, np.uint32)
    for group in blocks(texts):
        parts, owner = [], []
        for i, text in enumerate(group):
            own = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint32(1)
            parts += [edge, own, edge[:1]]
            owner += [(i, len(own) + 1), (-1, ORDER - 1)]
        symbols = np.concatenate(parts)
        of = np.repeat(*np.array(owner, np.int64).T)[: len(symbols) - ORDER + 1]
        for begin in range(0, len(of), BLOCK):
            yield symbols[begin : begin + BLOCK + ORDER - 1], of[begin : begin + BLOCK], np.arange(at, at + len(group))
        at += len(group)


def dense(symbols: np.ndarray) -> tuple[np.ndarray, int]:
    """Symbols numbered from 0 without gaps, and how many there are."""
    seen = np.zeros(BORDER + 1, bool)
    seen[symbols] = True
    return (np.cumsum(seen) - 1)[symbols], int(seen.sum())


def distinct(ids: np.ndarray, size: int, starts: np.ndarray | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams at starts (None: all) as numbers of the distinct ones, and a place in starts of each of these."""
    count = len(ids) - n + 1 if starts is None else len(starts)
    code, top = np.zeros(count, np.int64), 1
    for j in range(n):
        if top * size >= 1 << 62:  # number what there is so far anew
            code, found = pd.factorize(code)
            top = len(found)
        code = code * size + (ids[j : count + j] if starts is None else ids[starts + j])
        top *= size
    number, found = pd.factorize(code)
    first = np.zeros(len(found), np.int64)
    first[number[::-1]] = np.arange(count - 1, -1, -1)
    return number, first


def spelled(symbols: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n-grams at starts, as bytes filled up with zeros."""
    out = np.zeros((len(starts), KEY.itemsize), np.uint8)
    rows = symbols[starts[:, None] + np.arange(n)].astype(">u4").view(np.uint8).reshape(len(starts), n, 4)
    out[:, : SPELLED * n] = rows[:, :, 1:].reshape(len(starts), SPELLED * n)
    return out.view(KEY).ravel()


def gram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n) of the plain n-grams of ORDER symbols of every whole text.

    Null and empty texts count as one n-gram of borders; repeated rows count each.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks, capitals = _kinds()
        for frame in frames:
            for symbols, of, _ in windows(frame["__text"].tolist()):
                number, first = distinct(*dense(symbols), None, ORDER)
                times = np.bincount(number, of >= 0).astype(np.int64)
                rows = symbols[first[:, None] + np.arange(ORDER)]
                chosen = (times > 0) & ~marks[rows].any(axis=1) & (capitals[rows].sum(axis=1) < 2)
                keys = spelled(symbols, first[chosen], ORDER)
                yield pd.DataFrame({"gram": keys.view(f"V{KEY.itemsize}").tolist(), "n": times[chosen]})

    counted = ship(docs).select(whole_text().alias("__text")).mapInPandas(tidied(count), "gram binary, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def _times(low: int) -> Column:
    return F.count_if(F.col("n") == low if low < 3 else F.col("n") >= low)


class Model:
    """Discounts by order, and the table: n of an n-gram, total and left of it as a context."""

    def __init__(self, discounts: list[list[float]], files: list[tuple[bytes, str, int]]):
        self.discounts = discounts  # [n][min(count, 3)]
        self.files = sorted((bytes(first), path, rows) for first, path, rows in files)
        self._open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _file(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self._open:
            _, path, n = self.files[i]
            found = []
            for name, kind, shape in ((f"{path}.keys", KEY, (n,)), (f"{path}.values", np.float64, (n, 3))):
                system, at = _system(name)
                if isinstance(system, fs.LocalFileSystem):
                    found.append(np.memmap(at, kind, "r", shape=shape))
                else:  # cannot be mapped
                    found.append(np.frombuffer(system.open_input_file(at).read(), kind).reshape(shape))
            self._open[i] = tuple(found)
        return self._open[i]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """(n, total, left) by key; 0 where there is none."""
        out = np.zeros((len(keys), 3))
        if not self.files:
            return out
        place = np.searchsorted(np.array([f[0] for f in self.files], KEY), keys, "right") - 1
        for i in np.unique(place[place >= 0]):
            asked = np.flatnonzero(place == i)
            held, values = self._file(int(i))
            spot = np.minimum(np.searchsorted(held, keys[asked]), len(held) - 1)
            same = held[spot] == keys[asked]
            out[asked[same]] = values[spot[same]]
        return out

    def probability(self, symbols: np.ndarray, starts: np.ndarray | None = None, n: int = ORDER, ids: tuple | None = None) -> np.ndarray:
        """Of the last symbol after the ones before it, for the n-grams at starts (None: all)."""
        if n == 0:
            return np.full(len(starts), 1 / BORDER)  # each of the symbols alike
        ids = dense(symbols) if ids is None else ids
        number, first = distinct(*ids, starts, n)
        own = first if starts is None else starts[first]
        count = self.find(spelled(symbols, own, n))[:, 0]
        of, places = distinct(*ids, own, n - 1)
        _, total, left = self.find(spelled(symbols, own[places], n - 1))[of].T
        lower = self.probability(symbols, own + 1, n - 1, ids)
        above = count - np.array(self.discounts[n])[np.minimum(count, 3).astype(np.int64)]
        return np.where(total > 0, above / np.maximum(total, 1) + left * lower, lower)[number]

    def log_perplexity(self, texts: list[str]) -> np.ndarray:
        """Minus the mean log-probability of each text's symbols and its end."""
        sums = np.zeros(len(texts))
        for symbols, of, numbers in windows(texts):
            logs = np.where(of >= 0, np.log(self.probability(symbols)), 0.0)
            sums[numbers] += np.bincount(np.maximum(of, 0), logs, len(numbers))
        return -sums / (np.fromiter(map(len, texts), np.int64, len(texts)) + 1)


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _discounts(levels: DataFrame) -> list[list[float]]:
    """Of each order and each count up to 3, from the counts of counts."""
    size = (F.length("gram") / SPELLED).cast("int")
    rows = levels.groupBy(size.alias("size")).agg(*(F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5))).collect()
    out = [[0.0] * 4 for _ in range(ORDER + 1)]
    for size, *have in rows:
        y = have[0] / max(1, have[0] + 2 * have[1])
        for i in (1, 2, 3):
            cut = i - (i + 1) * y * have[i] / have[i - 1] if have[i - 1] else 0.5 * i
            out[size][i] = float(np.clip(cut, 0.1 * i, i))
    return out


def trained(docs: DataFrame) -> Model:
    """The model of all texts."""
    level = levels = stored(gram_counts(docs), "grams")
    for n in range(ORDER - 1, 0, -1):  # distinct symbols before: each longer n-gram counts once
        level = level.groupBy(F.col("gram").substr(SPELLED + 1, SPELLED * n).alias("gram")).agg(F.count("*").alias("n"))
        levels = levels.union(level)
    levels = stored(levels, "levels")
    discounts = _discounts(levels)
    # of contexts: how often they are followed, and the share that discounts leave for shorter contexts
    before = F.substring("gram", F.lit(1), F.length("gram") - SPELLED)
    ends = levels.groupBy(before.alias("gram")).agg(F.sum("n").alias("total"), *(_times(i).alias(f"n{i}") for i in (1, 2, 3)))
    cut = F.array(*(F.array(*map(F.lit, d)) for d in discounts[1:]))[(F.length("gram") / SPELLED).cast("int")]
    left = sum((cut[i] * F.col(f"n{i}") for i in (1, 2, 3)), F.lit(0.0)) / F.col("total")
    table = levels.join(ends.select("gram", "total", left.alias("left")), "gram", "full")
    folder = f"{shared_folder(docs.sparkSession)}/arrays-{uuid.uuid4().hex}"

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, first, rows, out = f"{folder}/{uuid.uuid4().hex}", None, 0, []
        for frame in frames:
            if first is None and len(frame):
                first = frame["gram"].iloc[0]
                system, at = _system(path)
                system.create_dir(at.rpartition("/")[0])
                out = [system.open_output_stream(f"{at}.{name}") for name in ("keys", "values")]
            if len(frame):
                out[0].write(np.array(frame["gram"].tolist(), KEY).tobytes())
                out[1].write(frame[["n", "total", "left"]].fillna(0.0).to_numpy(np.float64).tobytes())
                rows += len(frame)
        for stream in out:
            stream.close()
        if rows:
            yield pd.DataFrame({"first": [first], "path": [path], "rows": [rows]})

    ranges = ship(table).repartitionByRange("gram").sortWithinPartitions("gram").select("gram", "n", "total", "left")
    files = ranges.mapInPandas(tidied(write), "first binary, path string, rows long").collect()
    return Model(discounts, [tuple(f) for f in files])
