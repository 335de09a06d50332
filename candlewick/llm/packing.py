"""Harmonic packing: documents as token ids in sequences of a fixed capacity.

A piece belongs to class k if its length is in (capacity / (k + 1), capacity / k]; each bin of class k
takes exactly k pieces, so a bin needs no look at lengths and workers never meet.  To leave little
padding, a document is cut into whole sequences, then into the exact reciprocals capacity / 2, / 4, ...
down to FINEST, whose bins are full to the last token; only its tail goes to a class between two
reciprocals, whose bins are at least k / (k + 1) full.  What a partition leaves in unfinished bins is
laid end to end in a few last sequences.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import read, ship, tidied, whole_text

CAPACITY, END_ID = 4096, 2
#: The shortest reciprocal slot; a shorter tail is at most 1/64 of a bin, and so is a bin's padding.
FINEST = 64
#: Words, and characters of them, whose ids a task remembers; beyond them it starts anew (cache sizes).
MEMO_WORDS, MEMO_CHARS = 800_000, 12_000_000
ROWS = 50_000  # pieces in a batch of results
MARKS = "!#$%&*,.:;?"
# White space of the tokenizer's pattern \s; str.split() would also split at \x1c to \x1f.
SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
# Bytes that stand for themselves in the tokenizer's byte alphabet; the others follow from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_ALPHABET = {b: b for b in PRINTABLE} | {b: 0x100 + i for i, b in enumerate(sorted({*range(0x100)} - {*PRINTABLE}))}
SCHEMA = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"


if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are kept as little-endian 32-bit numbers")


@lru_cache(2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids as little-endian 32-bit bytes.  No token crosses white space, so words are encoded once.

    Words of letters below U+0130 are composed, are one part of the tokenizer's pattern and have simple
    lower-case forms, so its model gets them directly, spelled in its byte alphabet, and once for all
    their cases; MARKS after them are one part of the pattern, as no letter, number or apostrophe is among
    them, and are encoded once for all words that end with them.  All others take the whole way.
    An encoder and what it remembers belong to one task.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.memo: dict[str, bytes] = {}
        self.held = 0

    def _whole(self, words: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: dict[str, None]) -> None:
        """Adds the ids of words to the memo."""
        memo, tokenize, odd = self.memo, self.model.tokenize, []
        for word in words:
            stem = word.rstrip(MARKS)
            if not (stem.isalpha() and (stem.isascii() or max(stem) < "\u0130")):
                odd.append(word)
                continue
            end = word[len(stem) :]
            stem = stem.lower()
            ids = memo.get(stem)
            if ids is None:
                spelled = stem if stem.isascii() else stem.encode().decode("latin-1").translate(BYTE_ALPHABET)
                ids = memo[stem] = array("I", [token.id for token in tokenize(spelled)]).tobytes()
            if end:
                marks = memo.get(end)
                if marks is None:
                    marks = memo[end] = self._whole([end])[0]
                    self.held += len(end)
                ids += marks
            memo[word] = ids
        memo.update(zip(odd, self._whole(odd), strict=True))
        self.held += sum(map(len, words))

    def encode(self, text: str) -> bytes:
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        words = [w for w in SPACES.split(text) if w] if odd else text.split()
        memo = self.memo
        parts = list(map(memo.get, words))
        if None in parts:
            if len(memo) > MEMO_WORDS or self.held > MEMO_CHARS:
                memo.clear()
                self.held = 0
                parts = [None] * len(words)
            missing = [i for i, ids in enumerate(parts) if ids is None]
            self._learn(dict.fromkeys([words[i] for i in missing]))
            for i in missing:  # the others are not looked up again
                parts[i] = memo[words[i]]
        return b"".join(parts)


def encoder(path: str) -> Encoder:
    return Encoder(tokenizer(path))


def slots(n: int, capacity: int = CAPACITY, finest: int = FINEST) -> Iterator[tuple[int, int]]:
    """(class, length) of the pieces of n tokens: whole sequences, exact reciprocals, a tail."""
    k = 1
    while n:
        size = capacity // k
        if size >= finest and capacity % k == 0:
            for _ in range(n // size):
                yield k, size
            n %= size
            k *= 2
        else:
            yield capacity // n, n
            return


class Bins:
    """Open bins by class; a bin of class k is closed by its k-th piece."""

    def __init__(self, first_id: int, capacity: int = CAPACITY):
        self.open: dict[int, list] = defaultdict(list)
        self.next, self.capacity = first_id, capacity

    def add(self, k: int, piece: tuple) -> list[tuple]:
        bin_ = self.open[k]
        bin_.append(piece)
        return self._closed(self.open.pop(k)) if len(bin_) == k else []

    def _closed(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for piece in pieces:
            out.append((*piece, self.next, offset))
            offset += piece[2]
        self.next += 1
        return out

    def rest(self) -> Iterator[tuple]:
        """The unfinished bins' pieces, longest first, end to end; pieces are cut at sequence ends."""
        left = sorted((p for pieces in self.open.values() for p in pieces), key=lambda p: -p[2])
        self.open.clear()
        held, room = [], self.capacity
        for doc, start, length, ids, total in left:
            while length:
                take = min(length, room)
                held.append((doc, start, take, ids[: 4 * take], total))
                start, length, ids, room = start + take, length - take, ids[4 * take :], room - take
                if not room:
                    yield from self._closed(held)
                    held, room = [], self.capacity
        if held:
            yield from self._closed(held)


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, ids.

    Every document ends with end_id, so null and empty texts are one token; repeated rows are packed
    each; other columns are ignored.  A sequence is capacity long and padded by whoever writes it,
    unless its length is a power of two.  No row leaves its partition: a task that is run again gives
    the same pieces, as a partition's rows and their order come from the files.
    """
    end = end_id.to_bytes(4, "little")

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        bins = Bins((context.partitionId() if context else 0) << 33, capacity)
        code, rows = encoder(tokenizer_path), []

        def frame(pieces: list[tuple]) -> pd.DataFrame:
            doc, start, length, ids, total, sequence, offset = zip(*pieces, strict=True)
            columns = {
                "doc_id": pd.Series(doc, dtype=object), "start": start, "length": length, "ids_crc32": list(map(zlib.crc32, ids)),
                "doc_tokens": total, "sequence_id": sequence, "offset": offset,
            }
            return pd.DataFrame(columns | ({"ids": ids} if with_ids else {}))

        for part in frames:
            for doc, text in zip(part["doc_id"].astype(object).where(part["doc_id"].notna(), None), part["__text"], strict=True):
                ids = code.encode(text) + end
                total, start = len(ids) // 4, 0
                for k, length in slots(total, capacity):
                    rows += bins.add(k, (doc, start, length, ids[4 * start : 4 * (start + length)], total))
                    start += length
                if len(rows) >= ROWS:
                    yield frame(rows)
                    rows = []
        rows += bins.rest()
        if rows:
            yield frame(rows)

    chosen = ship(docs).select("doc_id", whole_text().alias("__text"))
    schema = SCHEMA.format(dict(docs.dtypes)["doc_id"])
    return chosen.mapInPandas(tidied(batches), schema + ", ids binary" * with_ids)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
