"""Benchmark decontamination: which test items lie inside which documents.

Containment of an item in a document is the share of the item's distinct shingles (five words; all words
of a shorter item) that the document has.  Items are partitioned by size.  An item's sketch is its lowest
shingle hashes, so many that a document containing THRESHOLD of the item must have one of them: all but
THRESHOLD of the largest size in its partition, and one more.  A document's sketch is its hashes up to
the highest one of any item's sketch.  Documents that share a sketch hash with an item are candidates;
they are verified by exact shingle containment on the words themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, sized, stored, whole_text

WORDS, THRESHOLD = 5, 0.8
#: A word: letters and digits, in lower case.
GAP = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), GAP), "")


def _windows(source: str, size: int, shingle: Callable[[Column], Column]) -> Column:
    """shingle(i) for each window of size elements, i from 1."""
    n = F.size(source)
    return F.when(n >= size, F.transform(F.sequence(F.lit(1), n - size + 1), shingle))


def _distinct(parts: list[Column], kind: str) -> Column:
    none = F.expr(f"CAST(array() AS array<{kind}>)")
    return F.array_distinct(F.concat(*(F.coalesce(p, none) for p in parts)))


def _hashes(sizes: list[int]) -> Column:
    """Distinct shingle hashes of __h, the hashes of a text's words."""

    def windows(k: int) -> Column:
        return _windows("__h", k, lambda i: F.xxhash64(F.lit(k), *(F.element_at("__h", i + j) for j in range(k))))

    return _distinct([windows(k) for k in sizes], "long")


def _texts(sizes: list[int]) -> Column:
    """Distinct shingles of __w, the words of a text."""

    def windows(k: int) -> Column:
        return _windows("__w", k, lambda i: F.array_join(F.slice("__w", i, F.lit(k)), " "))

    return _distinct([windows(k) for k in sizes], "string")


def _worded(rows: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).select(key, words(whole_text()).alias("__w")).where(F.size("__w") > 0)


def item_shingles(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per item: item_id, size (words of a shingle), hashes and texts of its distinct shingles, sketch."""
    rows = _worded(items.dropDuplicates(["item_id", "text"]), "item_id")
    rows = rows.select("item_id", "__w", F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"))
    by_size = [rows.where(F.least(F.size("__w"), F.lit(WORDS)) == k).select(
        "item_id", F.lit(k).alias("size"), _hashes([k]).alias("hashes"), _texts([k]).alias("texts")
    ) for k in range(1, WORDS + 1)]
    out = reduce(DataFrame.unionByName, by_size).withColumn("n_item", F.size("hashes"))
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n_item")) + 1) - 1  # of the partition by size
    probes = (largest - F.ceil(largest * threshold - 1e-9) + 1).cast("int")
    return out.withColumn("sketch", F.slice(F.array_sort("hashes"), F.lit(1), probes))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of all pairs with containment >= threshold.

    Rows without an id, and texts without a word, are never found.  Rows that share a doc_id are one
    document; of rows that share an item_id, each text is judged and the best containment is returned.
    """
    found = stored(item_shingles(items, threshold), "items")
    sizes = sorted(r["size"] for r in found.select("size").distinct().collect())  # five at most
    top = found.select(F.max(F.array_max("sketch")).alias("top")).first()["top"]
    if top is None:
        nothing = docs.join(items, F.lit(False)).select("doc_id", "item_id")
        return nothing.selectExpr("*", "0L AS n_shared", "0 AS n_item", "0.0D AS containment")
    probes = stored(found.select("item_id", F.explode("sketch").alias("hash")).distinct(), "probes")
    hashed = _worded(docs, "doc_id").select("doc_id", F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"))
    sketches = hashed.select("doc_id", F.explode(F.filter(_hashes(sizes), lambda h: h <= top)).alias("hash"))
    candidates = stored(sketches.join(sized(probes), "hash").select("doc_id", "item_id").distinct(), "candidates")

    near = docs.join(sized(candidates.select("doc_id").distinct()), "doc_id", "left_semi")
    shingles = _worded(near, "doc_id").select("doc_id", F.explode(_texts(sizes)).alias("shingle"))
    known = found.select("item_id", "n_item", F.xxhash64("texts").alias("__item"), F.explode("texts").alias("shingle"))
    shared = shingles.join(sized(stored(known, "shingles")), "shingle").join(sized(candidates), ["doc_id", "item_id"])
    verified = shared.groupBy("doc_id", "item_id", "__item", "n_item").agg(F.countDistinct("shingle").alias("n_shared"))
    verified = verified.withColumn("containment", F.col("n_shared") / F.col("n_item"))
    best = F.max(F.struct("containment", "n_shared", "n_item")).alias("best")
    passed = verified.where(F.col("n_shared") >= F.ceil(F.col("n_item") * threshold - 1e-9))
    return passed.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.n_shared", "best.n_item", "best.containment"
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without those that contain a test item; rows without an id stay."""
    return docs.join(sized(contaminated(docs, items).select("doc_id").distinct()), "doc_id", "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
