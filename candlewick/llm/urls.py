"""URL verdicts from sorted digest arrays: hosts and host/path prefixes as sorted 64-bit xxhash keys.

The entries of a list are kept in files that Spark hands to every executor and that tasks map into
memory: only the pages that a search touches are loaded.  A batch of urls is probed by one vectorised
binary search over the digests of its hosts' suffixes, and by a second one over the path prefixes of
the hosts found.  Equal digests are confirmed by the stored strings, so a collision is never a match.

Nulls and urls without ``://`` have an empty host and path, which no entry fits; they are allowed, as
is every url that fits nothing.  Each row is judged by itself: repeated rows and repeated or null ids
give as many rows.  Only the id and the url are read, so other columns may have any name.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import read, ship

#: Entries (host, path, verdict): of several that fit a url, the longest decides.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
#: Hosts blocked where no rule fits.
LISTED = (
    ("spam-farm.example.org", "", "block"), ("spam-farm.example.net", "", "block"),
    ("cheap-pills.example.org", "", "block"), ("cheap-pills.example.net", "", "block"),
    ("free-bets.example.org", "", "block"), ("free-bets.example.net", "", "block"),
)
#: Bytes of strings that one file holds at most, which bounds what the driver builds at a time.
FILE_BYTES = 128 * 2**20
VERDICTS = ("allow", "block")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUTPUT = "host string, path string, rule string, verdict string"


# ---------------------------------------------------------------------------------------------
# The array
# ---------------------------------------------------------------------------------------------


def digest_file(path: str, items: Sequence[tuple[bytes, bytes]], digest: Callable = xxh64_intdigest) -> None:
    """Write (key, value) pairs: counts, sorted digests, ends of the keys, ends of the values, their bytes."""
    digests = np.fromiter((digest(key) for key, _ in items), np.uint64, len(items))
    order = np.argsort(digests, kind="stable")
    keys, values = [items[i][0] for i in order], [items[i][1] for i in order]
    with open(path, "wb") as out:
        np.array([len(items), sum(map(len, keys))], np.int64).tofile(out)
        digests[order].tofile(out)
        for part in (keys, values):
            np.cumsum([0, *map(len, part)], dtype=np.int64).tofile(out)
        for part in (keys, values):
            out.write(b"".join(part))


class DigestArray:
    """A mapped file of ``digest_file``."""

    def __init__(self, path: str):
        size, key_bytes = (int(n) for n in np.fromfile(path, np.int64, 2))
        at = 16

        def mapped(kind: type, count: int) -> np.ndarray:
            nonlocal at
            part = np.memmap(path, kind, "r", at, (count,)) if count else np.zeros(0, kind)
            at += part.nbytes
            return part

        self.digests = mapped(np.uint64, size)
        self._key_ends, self._value_ends = mapped(np.int64, size + 1), mapped(np.int64, size + 1)
        self._keys, self._values = mapped(np.uint8, key_bytes), mapped(np.uint8, int(self._value_ends[-1]))

    def key(self, i: int) -> bytes:
        return self._keys[self._key_ends[i] : self._key_ends[i + 1]].tobytes()

    def value(self, i: int) -> bytes:
        return self._values[self._value_ends[i] : self._value_ends[i + 1]].tobytes()

    def find(self, keys: Sequence[bytes], digests: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(position in keys, value) of every key that is stored."""
        if not len(self.digests) or not len(keys):
            return
        at = np.searchsorted(self.digests, digests)
        same = self.digests[np.minimum(at, len(self.digests) - 1)] == digests
        for i in np.flatnonzero(same & (at < len(self.digests))):
            j = at[i]
            while j < len(self.digests) and self.digests[j] == digests[i]:  # colliding keys are neighbours
                if self.key(j) == keys[i]:
                    yield int(i), self.value(j)
                    break
                j += 1


class Lookup:
    """The files of one kind of key, probed together."""

    def __init__(self, paths: Iterable[str], digest: Callable = xxh64_intdigest):
        self.arrays, self._digest = [DigestArray(path) for path in paths], digest

    def find(self, keys: Sequence[bytes]) -> dict[int, bytes]:
        digests = np.fromiter(map(self._digest, keys), np.uint64, len(keys))
        return {i: value for array in self.arrays for i, value in array.find(keys, digests)}


# ---------------------------------------------------------------------------------------------
# Judging
# ---------------------------------------------------------------------------------------------


def host_suffixes(host: str, longest: int) -> list[str]:
    """The host and its parent domains, as far as one of them can be listed."""
    suffixes, at = [], max(len(host) - longest, 0)
    if at:  # the first label boundary within reach
        at = host.find(".", at - 1) + 1
        if not at:
            return []
    while host:
        suffixes.append(host[at:])
        at = host.find(".", at) + 1
        if not at:
            break
    return suffixes


class Judge:
    """Verdicts of batches of (host, path) against the mapped entries."""

    def __init__(self, hosts: Lookup, entries: Lookup, longest: int):
        self.hosts, self.entries, self.longest = hosts, entries, longest

    def _listed(self, hosts: Iterable[str]) -> dict[str, list[tuple[str, np.ndarray]]]:
        """Of each host: its suffixes that have entries, with the lengths of their paths."""
        probes = [(host, suffix) for host in set(hosts) for suffix in host_suffixes(host, self.longest)]
        found: dict[str, list[tuple[str, np.ndarray]]] = {}
        for i, value in self.hosts.find([suffix.encode() for _, suffix in probes]).items():
            host, suffix = probes[i]
            found.setdefault(host, []).append((suffix, np.frombuffer(value, np.uint32)))
        return found

    def verdicts(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str]]:
        listed = self._listed(hosts)
        probes = [
            (row, suffix, path[:length])
            for row, (host, path) in enumerate(zip(hosts, paths))
            for suffix, lengths in listed.get(host, ())
            for length in lengths[lengths <= len(path)].tolist()
        ]
        best: list[dict[int, tuple]] = [{} for _ in hosts]
        for i, value in self.entries.find([(suffix + start).encode() for _, suffix, start in probes]).items():
            row, suffix, start = probes[i]
            size = (len(suffix) + len(start), len(suffix))
            for layer, verdict in zip(value[::2], value[1::2]):
                kept = best[row].get(layer)
                if kept is None or size > kept[0]:
                    best[row][layer] = (size, suffix + start, VERDICTS[verdict])
        rules = [fits[0][1] if 0 in fits else None for fits in best]
        return rules, [fits[min(fits)][2] if fits else VERDICTS[0] for fits in best]


def address(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; only A-Z of the host are lower-cased."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def entry_table(spark: SparkSession, rules: Iterable[tuple], listed: Iterable[tuple] = ()) -> DataFrame:
    """(layer, host, path, verdict): rules in layer 0, the list behind them in layer 1."""
    rows = [(layer, *entry) for layer, entries in enumerate((rules, listed)) for entry in entries]
    return spark.createDataFrame(rows, "layer int, host string, path string, verdict string")


def _checked(entries: DataFrame) -> DataFrame:
    """One row per (host, path) with its verdicts by layer; fails on an entry that cannot be meant so."""
    shaped = F.expr(
        "host RLIKE '^[^/?#A-Z]+$' AND path RLIKE '^(/[^?#]*)?$' AND verdict IN ('allow', 'block') AND layer BETWEEN 0 AND 255"
    )
    wrong = F.raise_error(F.concat(F.lit("Not an entry: "), F.to_json(F.struct("layer", "host", "path", "verdict"))))
    layers = entries.filter(F.when(shaped, True).otherwise(wrong.cast("boolean"))).groupBy("host", "path", "layer").agg(
        F.min("verdict").alias("verdict"), F.max("verdict").alias("other")
    )
    torn = F.raise_error(F.concat(F.lit("Both allowed and blocked: "), "host", "path"))
    agreed = layers.filter(F.when(F.col("verdict") == F.col("other"), True).otherwise(torn.cast("boolean")))
    return agreed.groupBy("host", "path").agg(
        F.sort_array(F.collect_list(F.struct("layer", (F.col("verdict") == VERDICTS[1]).cast("int").alias("code")))).alias("codes")
    )


def _files(rows: Iterator[tuple[bytes, bytes]], folder: str, kind: str, limit: int) -> list[str]:
    """Digest files of at most ``limit`` bytes of strings each (one at least)."""
    paths: list[str] = []
    batch: list[tuple[bytes, bytes]] = []
    size = 0

    def flush() -> None:
        paths.append(f"{folder}/{kind}-{len(paths)}-{uuid.uuid4().hex}.digests")
        digest_file(paths[-1], batch)

    for key, value in rows:
        if batch and size + len(key) + len(value) > limit:
            flush()
            batch, size = [], 0
        batch.append((key, value))
        size += len(key) + len(value)
    flush()
    return paths


def listed_files(entries: DataFrame, limit: int = FILE_BYTES) -> tuple[list[str], list[str], int]:
    """Build the digest files of a list and hand them to the executors: names of both kinds, longest host.

    The list passes the driver one file at a time (FILE_BYTES); it is a parameter of the operator and
    does not grow with the pages.  Executors that join later fetch the files too.
    """
    spark = entries.sparkSession
    rows = _checked(entries)
    hosts = rows.groupBy("host").agg(F.sort_array(F.collect_set(F.length("path"))).alias("lengths"))
    longest = hosts.agg(F.max(F.length("host"))).first()[0] or 0
    folder = tempfile.mkdtemp(prefix="urls-")  # Spark serves the files from here
    by_host = ((r["host"].encode(), np.array(r["lengths"], np.uint32).tobytes()) for r in hosts.toLocalIterator())
    by_entry = (
        ((r["host"] + r["path"]).encode(), bytes(x for code in r["codes"] for x in code)) for r in rows.toLocalIterator()
    )
    kinds = [_files(by_host, folder, "hosts", limit), _files(by_entry, folder, "entries", limit)]
    for path in kinds[0] + kinds[1]:
        spark.sparkContext.addFile(path)
    names = [[Path(path).name for path in paths] for paths in kinds]
    return names[0], names[1], longest


def judged(pages: DataFrame, entries: DataFrame, keep: Sequence[str] = ("page_id",), url: str = "url") -> DataFrame:
    """The kept columns, host, path, the rule of layer 0 that decides (null without one) and the verdict.

    An entry fits its host and all subdomains if the path starts with its path.  The longest fitting entry
    of the first layer that has one gives the verdict, else the url is allowed.  No shuffle; a batch of
    urls is one search, whatever the number of entries.
    """
    host_files, entry_files, longest = listed_files(entries)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts, paths = ([SparkFiles.get(name) for name in names] for names in (host_files, entry_files))
        judge = Judge(Lookup(hosts), Lookup(paths), longest)
        for part in parts:
            rules, verdicts = judge.verdicts(part.column("host").to_pylist(), part.column("path").to_pylist())
            made = [pa.array(rules, pa.string()), pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "rule", "verdict"])

    host, path = address(F.col(url))
    types = dict(pages.dtypes)
    kept = [f"`{name}` {types[name]}" for name in keep]
    chosen = ship(pages).select(*keep, host.alias("host"), path.alias("path"))
    return chosen.mapInArrow(batches, ", ".join([*kept, OUTPUT]))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all pages by the rules and, where none fits, by the listed hosts."""
    return judged(read(spark, sf_dir, "pages"), entry_table(spark, RULES, LISTED))
