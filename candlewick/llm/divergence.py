"""How sources differ from each other and from their language, term by term.

Terms in at least MIN_DOCS documents of a language are its vocabulary.  It is stored as minimal acyclic
transducers (``transducer``), each over a range of the sorted terms; texts are streamed through them to
count terms again, so counts move as (source, ordinal) numbers, and ordinals, which ascend as terms do in
UTF-8, decide ties.  Shares are whole parts of 10**9, so every value is exact.

A null text, lang or source is ''.  Rows count one by one, also where ids repeat or are null; texts
without terms leave their group with no counts.  An empty table gives no rows.  Only text, lang and
source are read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, ship, stored, whole_text
from .transducer import Transducer, build

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
#: Terms of one transducer; bytes of transducers that tasks hold at a time (more need more passes over texts).
SHARD_TERMS, PASS_BYTES = 200_000, 64 * 2**20
#: Words and bytes of different terms (with what Python needs for one) that a task holds before it adds up.
FLUSH_WORDS, FLUSH_BYTES, TERM_BYTES = 4_000_000, 96 * 2**20, 100
#: Terms of a block and sources of a chunk whose values one task adds up.
BLOCK_TERMS, CHUNK_SOURCES = 4096, 256
CELLS = 1 << 20  # numbers in a task's matrix of shares
#: Bytes of terms: letters, A-Z as a-z, and all beyond ASCII; the others part terms.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalpha() else 32 for b in range(256))

Words = Iterator[tuple[str, str, list[bytes]]]


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def _worded(parts: Iterator[pa.RecordBatch]) -> Words:
    """(lang, source, terms) of each row."""
    for part in parts:
        for lang, source, text in zip(*(part.column(name).to_pylist() for name in ("lang", "source", "text"))):
            yield lang, source, terms_of(text)


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(name, F.lit("")).alias(name) for name in ("lang", "source")), whole_text().alias("text"))


class Terms(dict):
    """Terms numbered as they come."""

    n_bytes = 0

    def __missing__(self, term: bytes) -> int:
        self.n_bytes += len(term) + TERM_BYTES
        number = self[term] = len(self)
        return number


class Tally:
    """Terms of rows by (lang, source), as numbers, until they are many; then they are added up."""

    def __init__(self):
        self.terms: dict[str, Terms] = defaultdict(Terms)
        self._held: dict[tuple[str, str], list[np.ndarray]] = defaultdict(list)
        self._words = 0

    def add(self, lang: str, source: str, words: list[bytes] | set[bytes]) -> bool:
        """Take a row's terms in; whether it is time to add up."""
        terms = self.terms[lang]
        self._held[lang, source].append(np.fromiter(map(terms.__getitem__, words), np.int32, len(words)))
        self._words += len(words) + 1
        return self._words > FLUSH_WORDS or sum(t.n_bytes for t in self.terms.values()) > FLUSH_BYTES

    def numbers(self) -> Iterator[tuple[str, str, np.ndarray]]:
        """What is held, which is then let go."""
        for (lang, source), held in self._held.items():
            yield lang, source, np.concatenate(held)
        self._held.clear()
        self.terms.clear()
        self._words = 0


def _batch(**columns) -> pa.RecordBatch:
    """Arrays and single values, which are repeated, as rows."""
    n = max(len(value) for value in columns.values() if not isinstance(value, str))
    arrays = [pa.repeat(pa.scalar(v), n) if isinstance(v, str) else v for v in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array(a) if isinstance(a, np.ndarray) else a for a in arrays], names=list(columns))


# ---------------------------------------------------------------------------------------------
# Vocabulary
# ---------------------------------------------------------------------------------------------


def kept_terms(texts: DataFrame) -> DataFrame:
    """(lang, term) of the terms in at least MIN_DOCS documents of a language, stored."""

    def summed(tally: Tally) -> Iterator[pa.RecordBatch]:
        terms = {lang: pa.array(list(known), pa.binary()).cast(pa.string()) for lang, known in tally.terms.items()}
        for lang, _, numbers in tally.numbers():
            if len(terms[lang]):
                yield _batch(lang=lang, term=terms[lang], n_docs=np.bincount(numbers, minlength=len(terms[lang])))

    def documents(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for lang, _, words in _worded(parts):
            if tally.add(lang, "", set(words)):
                yield from summed(tally)
        yield from summed(tally)

    found = ship(texts).mapInArrow(documents, "lang string, term string, n_docs bigint")
    kept = found.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs")).filter(F.col("n_docs") >= MIN_DOCS)
    return stored(kept.select("lang", "term"), "kept-terms")


def shards_of(kept: DataFrame) -> DataFrame:
    """(lang, first, size, data): a transducer per language and range of sorted terms, stored."""

    def built(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for part in parts for row in zip(*(part.column(name).to_pylist() for name in ("lang", "term"))))
        for lang, group in groupby(rows, key=lambda row: row[0]):
            terms = [term.encode() for _, term in group]
            values = ([lang], [terms[0].decode()], [len(terms)], [build(terms)])
            kinds = (pa.string(), pa.string(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(value, kind) for value, kind in zip(values, kinds)], names=["lang", "first", "size", "data"]
            )

    n_shards = max(1, -(-kept.count() // SHARD_TERMS))
    ranges = kept.repartitionByRange(n_shards, "lang", "term").sortWithinPartitions("lang", "term")
    return stored(ship(ranges).mapInArrow(built, "lang string, first string, size bigint, data binary"), "transducers")


class Vocabulary:
    """The shards of a pass within the order of all shards; ordinals are those of the whole language."""

    def __init__(self, order: dict[str, tuple[list[bytes], list[int]]], held: dict[tuple[str, bytes], bytes]):
        self._order = order
        self._held = {key: Transducer(data) for key, data in held.items()}

    def ordinals(self, lang: str, terms: list[bytes]) -> np.ndarray:
        """Places of terms in a language; -1 for those that are not kept or not in this pass."""
        firsts, bases = self._order.get(lang, ((), ()))
        found = np.full(len(terms), -1, np.int64)
        shard = np.fromiter((bisect_right(firsts, term) - 1 for term in terms), np.int64, len(terms))
        for i in np.unique(shard[shard >= 0]).tolist():
            transducer = self._held.get((lang, firsts[i]))
            if transducer is not None:
                rows = np.flatnonzero(shard == i)
                places = transducer.ordinals([terms[row] for row in rows])
                found[rows] = np.where(places >= 0, places + bases[i], -1)
        return found

    def term(self, lang: str, ordinal: int) -> str | None:
        """The term at a place, or None where another pass holds it."""
        firsts, bases = self._order[lang]
        i = bisect_right(bases, ordinal) - 1
        transducer = self._held.get((lang, firsts[i]))
        return None if transducer is None else transducer.term(ordinal - bases[i]).decode()


class Shards:
    """All shards of a run: one row each is known to the driver, their data only a pass at a time."""

    def __init__(self, table: DataFrame):
        self._table = table
        sizes = table.select("lang", "first", "size", F.length("data").alias("n_bytes")).collect()
        self._rows = sorted(((r["lang"], r["first"].encode(), r["size"], r["n_bytes"]) for r in sizes), key=lambda r: r[:2])
        self.order: dict[str, tuple[list[bytes], list[int]]] = {}
        self.sizes: Counter = Counter()
        for lang, first, size, _ in self._rows:
            firsts, bases = self.order.setdefault(lang, ([], []))
            firsts.append(first)
            bases.append(self.sizes[lang])
            self.sizes[lang] += size

    def passes(self, limit: int) -> Iterator[dict[tuple[str, bytes], bytes]]:
        """The data of all shards, as many at a time as ``limit`` bytes hold (one at least)."""
        groups: list[list[tuple]] = [[]]
        for row in self._rows:
            if groups[-1] and sum(other[3] for other in groups[-1]) + row[3] > limit:
                groups.append([])
            groups[-1].append(row)
        for group in filter(None, groups):
            wanted = F.lit(False)
            for lang, rows in groupby(group, key=lambda row: row[0]):
                firsts = [row[1].decode() for row in rows]
                wanted |= (F.col("lang") == lang) & F.col("first").between(firsts[0], firsts[-1])
            rows = self._table.filter(wanted).toLocalIterator()
            yield {(r["lang"], r["first"].encode()): bytes(r["data"]) for r in rows}

    def apply(
        self, rows: DataFrame, run: Callable, schema: str, name: str, limit: int,
        finish: Callable[[DataFrame], DataFrame] = lambda found: found,
    ) -> DataFrame | None:
        """finish(run(batches, vocabulary)) over rows, once for each pass; the stored results together.

        A term belongs to one pass, so what finish adds up by term is complete.
        """
        context, whole = rows.sparkSession.sparkContext, None
        for held in self.passes(limit):
            sent = context.broadcast((self.order, held))
            mapped = ship(rows).mapInArrow(lambda parts, sent=sent: run(parts, Vocabulary(*sent.value)), schema)
            found = stored(finish(mapped), name)
            sent.destroy()
            whole = found if whole is None else whole.unionByName(found)
        return whole


def recounted(texts: DataFrame, shards: Shards, limit: int = PASS_BYTES) -> DataFrame | None:
    """(lang, source, ordinal, n): kept terms counted by the transducers; None without any shard."""

    def counted(parts: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
        def summed(tally: Tally) -> Iterator[pa.RecordBatch]:
            places = {lang: vocabulary.ordinals(lang, list(known)) for lang, known in tally.terms.items()}
            for lang, source, numbers in tally.numbers():
                found = places[lang][numbers]
                ordinals, n = np.unique(found[found >= 0], return_counts=True)
                if len(ordinals):
                    yield _batch(lang=lang, source=source, ordinal=ordinals, n=n)

        tally = Tally()
        for lang, source, words in _worded(parts):
            if tally.add(lang, source, words):
                yield from summed(tally)
        yield from summed(tally)

    def added(found: DataFrame) -> DataFrame:
        return found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))

    return shards.apply(texts, counted, "lang string, source string, ordinal bigint, n bigint", "term-counts", limit, added)


# ---------------------------------------------------------------------------------------------
# Shares and values
# ---------------------------------------------------------------------------------------------


def share(count: str, total: str, size: str) -> Column:
    """A term's share of 10**9, never 0; exact for any count."""
    part = f"CAST({count} + 1 AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0))"
    return F.expr(f"1 + ({part}) DIV CAST({total} + {size} AS DECIMAL(20, 0))")


def distance(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV {q}")


def _block_values(key: tuple, points: pd.DataFrame, layout: pd.DataFrame) -> pd.DataFrame:
    """Values of a block's terms for every source against the sources of a chunk, added up."""
    lang, block, chunk = key
    sources = [row["source"] for row in layout["sources"].iloc[0]]
    base = np.array([row["p"] for row in layout["sources"].iloc[0]], np.int64)
    n_terms = int(layout["n_terms"].iloc[0])
    row_of = {source: i for i, source in enumerate(sources)}
    rows = points["source"].map(row_of).to_numpy(np.int64)
    columns, shares = points["place"].to_numpy(np.int64), points["p"].to_numpy(np.int64)
    against = range(chunk * CHUNK_SOURCES, min((chunk + 1) * CHUNK_SOURCES, len(sources)))
    values = np.zeros((len(sources), len(against)), np.int64)
    width = max(1, CELLS // len(sources))
    for start in range(0, n_terms, width):
        inside = (columns >= start) & (columns < start + width)
        matrix = np.repeat(base[:, None], min(width, n_terms - start), axis=1)
        matrix[rows[inside], columns[inside] - start] = shares[inside]
        for j, q in enumerate(against):
            apart = matrix - matrix[q]
            values[:, j] += (apart * apart // matrix[q]).sum(axis=1)
    i, j = (part.ravel() for part in np.indices(values.shape))
    other = i != j + chunk * CHUNK_SOURCES
    names = np.array(sources, object)
    return pd.DataFrame({
        "lang": lang, "source": names[i[other]], "item": names[(j + chunk * CHUNK_SOURCES)[other]], "value": values.ravel()[other],
    })


def pair_values(points: DataFrame, groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, over all its kept terms.

    Blocks of terms are compared in tasks of their own and their sums added up: a task holds a block's
    shares of all sources of the language, and the sums have as many rows as the result.
    """
    spread = groups.join(sizes, "lang").groupBy("lang", "size").agg(
        F.sort_array(F.collect_list(F.struct("source", "p"))).alias("sources")
    )
    blocks = F.sequence(F.lit(0), F.greatest(F.expr(f"(size - 1) DIV {BLOCK_TERMS}"), F.lit(0)))
    layout = spread.withColumn("block", F.explode(blocks)).select(
        "lang", "block",
        F.explode(F.expr(f"sequence(0L, (size(sources) - 1) DIV {CHUNK_SOURCES})")).alias("chunk"),
        F.expr(f"least({BLOCK_TERMS}L, size - block * {BLOCK_TERMS})").alias("n_terms"), "sources",
    )
    n_chunks = spread.select("lang", F.expr(f"(size(sources) - 1) DIV {CHUNK_SOURCES}").alias("last_chunk"))
    placed = points.join(n_chunks, "lang").select(
        "lang", F.expr(f"ordinal DIV {BLOCK_TERMS}").alias("block"), F.explode(F.expr("sequence(0L, last_chunk)")).alias("chunk"),
        "source", F.expr(f"ordinal % {BLOCK_TERMS}").alias("place"), "p",
    )
    key = ["lang", "block", "chunk"]
    sums = ship(placed).groupBy(*key).cogroup(layout.groupBy(*key)).applyInPandas(
        _block_values, "lang string, source string, item string, value bigint"
    )
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, tie: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col(tie))
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked if top is None else ranked.filter(F.col("rank") <= top)


def audited(docs: DataFrame, top: int = TOP, limit: int = PASS_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): a source's distance to the others of its language (part
    ``pair``) and the terms that it has more often than its language (part ``term``, to rank ``top``)."""
    spark, texts = docs.sparkSession, texts_of(docs)
    shards = Shards(shards_of(kept_terms(texts)))
    empty = spark.createDataFrame([], "lang string, source string, ordinal bigint, n bigint")
    counts = recounted(texts, shards, limit) or empty

    known = spark.createDataFrame(list(shards.sizes.items()), "lang string, size bigint")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(
        texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(known, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("size", F.lit(0)).alias("size")),
        "source-totals",
    )
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("size").alias("size"))

    whole = F.sum("n").over(Window.partitionBy("lang", "ordinal"))
    points = stored(
        counts.withColumn("lang_n", whole).join(groups, ["lang", "source"]).join(langs.drop("size"), "lang").select(
            "lang", "source", "ordinal", share("n", "total", "size").alias("p"), share("lang_n", "lang_total", "size").alias("q")
        ),
        "term-shares",
    )
    # a vocabulary of nothing has no shares; its pairs are 0
    bases = groups.filter("size > 0").select("lang", "source", share("0", "total", "size").alias("p"))
    bare = groups.filter("size = 0").select("lang", "source", F.lit(SCALE).cast("bigint").alias("p"))
    sizes = langs.select("lang", "size")
    pairs = _ranked(pair_values(points, bases.unionByName(bare), sizes), "item")

    scored = points.filter("p > q").select("lang", "source", "ordinal", distance("p", "q").alias("value"))
    best = stored(_ranked(scored, "ordinal", top), "best-terms")

    def named(parts: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
        for part in parts:
            langs, ordinals = part.column("lang").to_pylist(), part.column("ordinal").to_pylist()
            items = pa.array([vocabulary.term(*place) for place in zip(langs, ordinals)], pa.string())
            columns = [*(part.column(name) for name in ("lang", "source")), items, *(part.column(n) for n in ("value", "rank"))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "item", "value", "rank"]).filter(items.is_valid())

    schema = "lang string, source string, item string, value bigint, rank int"
    terms = shards.apply(best, named, schema, "named-terms", limit) or spark.createDataFrame([], schema)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns)
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents' sources, by language."""
    return audited(read(spark, sf_dir, "documents"))
