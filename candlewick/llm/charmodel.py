"""Character n-grams over a fixed alphabet of 64 symbols, counted over whole corpora, for restoring words.

Documents are scored over real code points instead: see pointmodel.

Symbols: 0 white space and text borders, 1-26 letters a-z, 27 digits, 28 '.', 29 ',', 30 - and ', 31 other
ASCII marks, 32 capital letters, 33-63 everything else by code point.  An n-gram of up to four symbols is
a number below 64**4, so a model never has more than 2**24 entries of a kind, whatever it is counted on.
Models learn from plain text: n-grams with a mark or with two capitals are not counted, so that markup,
junk and shouting stay unlikely however much of it a corpus holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, tidied, whole_text

BITS, ORDER = 6, 4
#: Characters counted at a time, so that memory doesn't grow with a text or a batch.
BLOCK = 1 << 21


MARK, CAPITAL, OTHER = 31, 32, 33


def _table() -> np.ndarray:
    table = OTHER + np.arange(0x3000, dtype=np.int64) % (64 - OTHER)
    table[:128] = MARK
    table[[9, 10, 11, 12, 13, 32]] = 0
    for i in range(26):
        table[97 + i] = 1 + i
    table[48:58], table[46], table[44], table[[39, 45]] = 27, 28, 29, 30
    for c in range(0x3000):
        if chr(c).isupper():
            table[c] = CAPITAL
    return table.astype(np.uint32)


TABLE = _table()


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) and points.max() >= len(TABLE):
        return np.where(points < len(TABLE), TABLE[np.minimum(points, len(TABLE) - 1)], OTHER + points % (64 - OTHER)).astype(np.uint32)
    return TABLE[points]


def grams(stream: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each symbol after the first order - 1."""
    n = len(stream) - order + 1
    codes = np.zeros(max(0, n), np.uint32)
    for i in range(order):
        codes = (codes << np.uint32(BITS)) | stream[i : n + i]
    return codes


def plain(stream: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Which n-grams have no mark and at most one capital."""
    n = max(0, len(stream) - order + 1)
    marks, capitals = np.zeros(n, bool), np.zeros(n, np.int8)
    for i in range(order):
        marks |= stream[i : n + i] == MARK
        capitals += stream[i : n + i] == CAPITAL
    return ~marks & (capitals < 2)


def stream(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts, each after order - 1 borders and before one; and where each text's n-grams begin."""
    edge = np.zeros(order - 1, np.uint32)
    parts, begins, at = [], [], 0
    for text in texts:
        own = symbols(text)
        parts += [edge, own, edge[:1]]
        begins.append(at)
        at += len(own) + order
    return (np.concatenate(parts) if parts else edge), np.array(begins, np.int64)


def blocks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of about BLOCK characters; a long text is a group of its own."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > BLOCK:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def gram_counts(docs: DataFrame, order: int = ORDER, fold: bool = False) -> DataFrame:
    """(gram, n) of the plain n-grams of every whole text, in lower case if fold; each partition adds its own counts up before the shuffle.

    Null and empty texts count as one border; repeated rows count each.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << (BITS * order), np.int64) if order <= 3 else None
        keys, values = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for frame in frames:
            for group in blocks(frame["__text"].tolist()):
                text, _ = stream([t.lower() for t in group] if fold else group, order)
                codes = grams(text, order)[plain(text, order)]
                if total is not None:
                    for i in range(0, len(codes), BLOCK):
                        total += np.bincount(codes[i : i + BLOCK], minlength=len(total))
                    continue
                for i in range(0, len(codes), BLOCK):
                    k, v = np.unique(codes[i : i + BLOCK], return_counts=True)
                    both, inverse = np.unique(np.concatenate([keys, k]), return_inverse=True)
                    values = np.bincount(inverse, np.concatenate([values, v]), len(both)).astype(np.int64)
                    keys = both
        if total is not None:
            keys = np.flatnonzero(total)
            values = total[keys]
        for i in range(0, len(keys), 100_000):
            yield pd.DataFrame({"gram": keys[i : i + 100_000].astype(np.int64), "n": values[i : i + 100_000]})

    counted = ship(docs).select(whole_text().alias("__text")).mapInPandas(tidied(count), "gram long, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))
