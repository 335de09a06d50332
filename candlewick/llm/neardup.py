"""Near-duplicates: consistent weighted sampling over TF-IDF shingles, banded, verified exactly.

A text is the weighted set of its five-word shingles: times in the text, times the inverse share of
documents.  Shares are counted for FEATURES hash features (rare shingles sit on an even floor, frequent
ones stand out at any corpus size).  Improved consistent weighted sampling draws SAMPLES elements of each
set, such that two sets agree in a draw with the probability of their weighted Jaccard similarity.  Texts
that agree in all draws of a band are candidates; links are candidates whose exact weighted Jaccard
similarity is at least THRESHOLD, and classes are what links connect.

Exact copies are one text from the start.  In each bucket of a band, texts are compared with one text of
it (a star), in ROUNDS rounds with other centres for those that are not yet in the centre's class; texts
of a bucket that are still in different classes are then paired, where their total weights and draws
leave a link possible.  Buckets of more than SMALL texts are paired block by block with MORE_SAMPLES
draws, and the likely links are verified first, as they join classes whose other pairs then need none.
So no link is lost, and a class of copies costs a few comparisons each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .charmodel import blocks
from .common import map_texts, read, ship, sized, stored, tidied, whole_text

WORDS, THRESHOLD = 5, 0.8
ROWS_PER_BAND, BANDS = 4, 12
SAMPLES = ROWS_PER_BAND * BANDS  # of texts at the threshold, 99.8 % share a band
FEATURES = 1 << 18
ROUNDS = 3
#: Agreeing draws that a link has at least: below the threshold's mean by more than four deviations.
MIN_AGREE = int(SAMPLES * 0.54)
BLOCK = 1 << 17  # (seed, shingle) pairs sampled at a time, so that memory grows neither with a text nor with the seeds
PAIRS = 4_000_000  # characters of the pairs verified at a time
#: Larger buckets are paired in blocks of BLOCK_TEXTS texts with MORE_SAMPLES draws each.
SMALL, BLOCK_TEXTS, MORE_SAMPLES = 50, 400, 448
#: Of these draws, links have fewer with a chance of 1 in 10,000 at the threshold.
MORE_AGREE = int(MORE_SAMPLES * 0.73)
_KNOTS = 4096
#: More than rounding can put a value below its bound.
SLACK = np.float32(1e-2)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, ...]:
    """Of Gamma(2, 1): logarithms at even quantiles, for c; and draws of r, 1 / r and beta."""
    rng = np.random.default_rng(20)
    x = np.concatenate([np.geomspace(1e-9, 0.05, 4000), np.linspace(0.05, 45, 40_000)[1:]])
    quantiles = np.interp(np.arange(_KNOTS + 1) / _KNOTS, 1 - (1 + x) * np.exp(-x), x)
    quantiles[0], quantiles[-1] = quantiles[1] / 16, 24.0
    r = rng.gamma(2.0, 1.0, _KNOTS)
    return tuple(t.astype(np.float32) for t in (np.log(quantiles), r, 1 / r, rng.random(_KNOTS)))


LOG_C, R, INVERSE_R, BETA = _tables()
SEEDS = _mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingled(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, counts) of the distinct shingles of each text; a text of fewer words has one.

    Texts are split some at a time, as words take much more memory than their text.
    """
    for group in blocks(texts):
        split = [t.split() for t in group]
        flat = [w for words in split for w in words]
        hashes = pd.util.hash_array(np.array(flat, object), categorize=False) if flat else np.zeros(0, np.uint64)
        full = _windows(hashes, WORDS)  # across texts as well; those are left out
        at = 0
        for n in map(len, split):
            h = full[at : at + n - WORDS + 1] if n >= WORDS else _windows(hashes[at : at + n], n)
            at += n
            yield np.unique(h, return_counts=True)


def _windows(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of every size words in a row."""
    h = np.full(max(0, len(words) - size + 1) if size else 0, size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(h)])
    return h


def features(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) & (FEATURES - 1)


MORE_SEEDS = _mixed(np.arange(1, MORE_SAMPLES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def sampled(hashes: np.ndarray, weights: np.ndarray, seeds: np.ndarray = SEEDS) -> np.ndarray:
    """A draw of a weighted set for each seed: the hash of (element, quantized weight)."""
    best, chosen = np.full(len(seeds), np.inf, np.float32), np.zeros(len(seeds), np.uint64)
    log_w = np.log(weights).astype(np.float32)
    rows = np.arange(len(seeds))
    step = max(1, BLOCK // len(seeds))
    for i in range(0, len(hashes), step):
        h, lw = hashes[i : i + step], log_w[i : i + step]
        x = _mixed_here(seeds[:, None] ^ h[None, :])
        # no value is below log_c - lw - r; only elements that may be the least are looked at closely
        least = LOG_C.take((x >> np.uint64(52)).view(np.int64), mode="wrap")
        least -= R.take((x & np.uint64(_KNOTS - 1)).view(np.int64), mode="wrap")
        least -= lw
        first = least.argmin(axis=1)
        value, _ = _values(x[rows, first], lw[first])
        near = np.flatnonzero(least <= (np.minimum(value, best) + SLACK)[:, None])
        if not len(near):
            continue
        row, at = np.divmod(near, len(h))
        value, t = _values(x.ravel()[near], lw[at])
        begins = np.flatnonzero(np.diff(row, prepend=-1))
        smallest = np.minimum.reduceat(value, begins)
        own = np.flatnonzero(value == np.repeat(smallest, np.diff(begins, append=len(row))))
        own = own[np.flatnonzero(np.diff(row[own], prepend=-1))]  # the first of equal ones
        own = own[value[own] < best[row[own]]]
        best[row[own]] = value[own]
        chosen[row[own]] = _mixed(h[at[own]] + t[own].astype(np.int64).view(np.uint64))
    return chosen


def _mixed_here(x: np.ndarray) -> np.ndarray:
    """_mixed in x's own memory."""
    y = x >> np.uint64(30)
    x ^= y
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=y)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=y)
    return x


def _values(x: np.ndarray, lw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the sampling takes the least of, and the quantized weight, by (seed, element) hash and log-weight."""
    spot = (x >> np.uint64(52)).view(np.int64)
    part = ((x >> np.uint64(28)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(2.0**-24)
    low = LOG_C[spot]
    log_c = low + part * (LOG_C[spot + 1] - low)
    other = (x & np.uint64(_KNOTS - 1)).view(np.int64)
    beta = BETA[other]
    t = np.floor(lw * INVERSE_R[other] + beta)
    return log_c - R[other] * (t + 1 - beta), t


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets with sorted elements."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - shared
    return float(shared / total) if total else 0.0


def inverse_shares(docs: DataFrame) -> np.ndarray:
    """log(documents / documents with a feature), by feature, over all documents."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for frame in frames:
            n += len(frame)
            for h, _ in shingled(frame["__text"].tolist()):
                total[features(h)] += 1  # once a feature, however often it is among them
        at = np.flatnonzero(total)
        yield pd.DataFrame({"feature": np.append(at, -1), "n": np.append(total[at], n)})

    parts = ship(docs).select(whole_text().alias("__text")).mapInPandas(tidied(count), "feature long, n long")
    rows = parts.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # FEATURES rows at most
    n = int(rows.loc[rows["feature"] < 0, "n"].sum())
    share = np.zeros(FEATURES)
    rows = rows[rows["feature"] >= 0]
    share[rows["feature"].to_numpy()] = rows["n"].to_numpy()
    return np.log((n + 1) / (share + 1)) + 0.1


def signatures(docs: DataFrame, idf) -> DataFrame:
    """doc_id, key (of the text), weight, bands, draws (a byte each); no bands for texts without words."""

    def row(texts: list[str]) -> dict:
        weight, bands, draws = [], [], []
        for h, n in shingled(texts):
            w = n * idf.value[features(h)]
            weight.append(float(w.sum()))
            s = sampled(h, w) if len(h) else np.zeros(0, np.uint64)
            draws.append(s.astype(np.uint8).tobytes())
            parts = s.reshape(-1, ROWS_PER_BAND) if len(h) else np.zeros((0, ROWS_PER_BAND), np.uint64)
            code = np.arange(1, len(parts) + 1, dtype=np.uint64)
            for i in range(ROWS_PER_BAND):
                code = _mixed(code + parts[:, i])
            bands.append(code.view(np.int64))
        return {"weight": weight, "bands": bands, "draws": draws}

    keyed = docs.select("doc_id", "text", F.sha2(whole_text(), 256).alias("key"))
    return map_texts(keyed, row, "weight double, bands array<long>, draws binary", ("doc_id", "key"))


def components(edges: DataFrame) -> DataFrame:
    """(id, class) of the ids in edges (u, v): the least id that edges connect.

    Alternates between linking larger and smaller neighbours to the least one until nothing changes.
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "cc")
    before = None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        larger = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        smaller = larger.groupBy("u").agg(F.min("v").alias("m"))
        linked = larger.join(smaller, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = stored(linked.union(smaller.select("u", F.col("m").alias("v"))).distinct(), "cc")
        after = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("class"))
        before = after


def verified(pairs: DataFrame, docs: DataFrame, idf) -> DataFrame:
    """The pairs (u, v) whose texts have a weighted Jaccard similarity of THRESHOLD or more."""
    ids = stored(pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v")).distinct(), "ids")
    texts = docs.select("doc_id", whole_text().alias("text")).join(sized(ids), "doc_id", "left_semi")
    first = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("b"))
    second = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("a"))
    # the centre's text first: its rows are small until then, and spread by the other side after it
    joined = pairs.join(first, "v").join(second, "u")

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            # some pairs at a time, as sets take a multiple of their texts' memory
            part = (frame["a"].str.len() + frame["b"].str.len()).cumsum() // PAIRS
            for _, rows in frame.groupby(part):
                texts = list(dict.fromkeys([*rows["a"], *rows["b"]]))
                sets = {t: (h, n * idf.value[features(h)]) for t, (h, n) in zip(texts, shingled(texts), strict=True)}
                same = [similarity(sets[a], sets[b]) >= THRESHOLD for a, b in zip(rows["a"], rows["b"], strict=True)]
                yield rows.loc[same, ["u", "v"]]

    kind = dict(docs.dtypes)["doc_id"]
    return ship(joined).mapInPandas(tidied(check), f"u {kind}, v {kind}").distinct()


def _agree(a: str, b: str) -> Column:
    """Draws in which two texts agree (differing draws agree in their byte by chance in 1 of 256)."""
    same = F.transform(F.sequence(F.lit(0), F.lit(SAMPLES - 1)), lambda i: (F.substring(a, i * 2 + 1, F.lit(2)) == F.substring(b, i * 2 + 1, F.lit(2))).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x)


def _block_pairs(placed: DataFrame, docs: DataFrame, idf) -> DataFrame:
    """(u, v, agree): pairs of texts in one bucket and different classes whose draws leave a link possible.

    A bucket's texts are dealt to blocks; a task pairs two blocks, so it never holds a whole bucket.  A
    pair is named by the first band that its texts share.
    """

    def draw(texts: list[str]) -> dict:
        sets = [(h, n * idf.value[features(h)]) for h, n in shingled(texts)]
        return {"more": [sampled(h, w, MORE_SEEDS).astype(np.uint8).tobytes() for h, w in sets]}

    def pair(rows: pd.DataFrame) -> pd.DataFrame:
        draws = np.stack([np.frombuffer(x, np.uint8) for x in rows["more"]])
        bands = np.stack(rows["bands"].to_list())
        ids, classes, weights, block = (rows[k].to_numpy() for k in ("id", "class", "weight", "i"))
        band, crossing, out = rows["band"].iloc[0], rows["low"].iloc[0] != rows["high"].iloc[0], []
        for k in range(len(rows)):
            other = (classes != classes[k]) & (ids > ids[k])
            if crossing:
                other &= block != block[k]
            other &= np.minimum(weights, weights[k]) >= np.maximum(weights, weights[k]) * (THRESHOLD - 1e-9)
            at = np.flatnonzero(other)
            agree = (draws[at] == draws[k]).sum(axis=1)
            at, agree = at[agree >= MORE_AGREE], agree[agree >= MORE_AGREE]
            if len(at):
                same = bands[at] == bands[k]
                first = bands[k][same.argmax(axis=1)] == band
                out.append(pd.DataFrame({"u": ids[at][first], "v": ids[k], "agree": agree[first]}))
        return pd.concat(out) if out else pd.DataFrame({"u": [], "v": [], "agree": []})

    ids = stored(placed.select(F.col("id").alias("doc_id")).distinct(), "ids")
    more = map_texts(docs.join(sized(ids), "doc_id", "left_semi").dropDuplicates(["doc_id"]), draw, "more binary")
    count = F.ceil(F.col("n") / BLOCK_TEXTS).cast("int")
    dealt = placed.join(more.withColumnRenamed("doc_id", "id"), "id").withColumn("i", F.pmod(F.xxhash64("id"), count).cast("int"))
    dealt = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), count - 1)))
    dealt = dealt.withColumn("low", F.least("i", "j")).withColumn("high", F.greatest("i", "j"))
    kind = dict(docs.dtypes)["doc_id"]
    return dealt.groupBy("band", "low", "high").applyInPandas(pair, f"u {kind}, v {kind}, agree int")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class_id (the least doc_id of its class), copy_of (the least doc_id with
    the same text), kept (whether it is its class's first).

    Null texts are empty ones, and empty texts are copies of each other.  Texts without a word have
    exact copies only.  Rows without an id are in no class and kept; rows that share an id and a text
    are one document.  Texts of fewer than five words are one shingle.  Other columns are ignored.
    """
    spark = docs.sparkSession
    known = docs.where(F.col("doc_id").isNotNull())
    idf = spark.sparkContext.broadcast(inverse_shares(known))  # FEATURES numbers
    marks = stored(signatures(known, idf), "signatures")
    texts = stored(
        marks.groupBy("key").agg(F.min("doc_id").alias("id"), F.min(F.struct("weight", "bands", "draws")).alias("s"))
        .select("key", "id", "s.weight", "s.bands", F.hex("s.draws").alias("draws")), "texts"
    )
    members = texts.select("id", "weight", "draws", "bands", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    members = stored(members.join(shared, "band"), "members")
    classes = members.select("id").distinct().select("id", F.col("id").alias("class"))
    links = None

    def joined(pairs: DataFrame) -> None:
        nonlocal links, classes
        found = stored(verified(pairs, known, idf), "links")
        links = found if links is None else links.union(found)
        linked = components(links)
        own = members.select("id").distinct().join(linked, "id", "left")
        classes = stored(own.select("id", F.coalesce("class", "id").alias("class")), "classes")

    for k in range(ROUNDS):
        placed = members.join(classes, "id")
        # the same order of centres in all bands, so that bands mostly repeat each other's comparisons
        rank = F.struct(F.xxhash64("id", F.lit(k)).alias("r"), "id", "class", "weight", "draws")
        centre = placed.groupBy("band").agg(F.min(rank).alias("c"), F.min("class").alias("low"), F.max("class").alias("high"))
        open_ = centre.where("low <> high").select("band", "c.*").toDF("band", "r", "v", "vc", "vw", "vd")
        pairs = placed.join(open_, "band").where("class <> vc").select("id", "v", "weight", "vw", "draws", "vd").distinct()
        pairs = stored(pairs.where(_possible()).select(F.col("id").alias("u"), "v"), "pairs")
        if pairs.isEmpty():
            break
        joined(pairs)

    placed = members.join(classes, "id")
    mixed = placed.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("n"))
    placed = placed.join(mixed.where("low <> high").select("band", "n"), "band")
    placed = stored(placed, "rest")
    small = placed.where(F.col("n") <= SMALL)
    right = small.select("band", F.col("id").alias("v"), F.col("class").alias("vc"), F.col("weight").alias("vw"), F.col("draws").alias("vd"))
    pairs = small.join(right, "band").where("class < vc").where(_possible()).select(F.col("id").alias("u"), "v")
    blocked = stored(_block_pairs(placed.where(F.col("n") > SMALL), known, idf), "blocks")
    likely = blocked.where(F.col("agree") >= MORE_SAMPLES * THRESHOLD)
    pairs = stored(pairs.union(likely.select("u", "v")).distinct(), "pairs")
    if not pairs.isEmpty():
        joined(pairs)
    own, other = (classes.toDF(k, f"{k}c") for k in "uv")
    rest = blocked.where(F.col("agree") < MORE_SAMPLES * THRESHOLD).join(own, "u").join(other, "v").where("uc <> vc")
    pairs = stored(rest.select("u", "v").distinct(), "pairs")
    if not pairs.isEmpty():
        joined(pairs)

    idf.unpersist()
    class_of = texts.select("key", F.col("id").alias("copy_of")).join(
        classes.select(F.col("id").alias("copy_of"), F.col("class").alias("class_id")), "copy_of", "left"
    )
    out = marks.select("doc_id", "key").join(class_of, "key")
    out = out.select("doc_id", F.coalesce("class_id", "copy_of").alias("class_id"), "copy_of")
    out = out.withColumn("kept", F.col("doc_id") == F.col("class_id"))
    return out.union(docs.where(F.col("doc_id").isNull()).select("doc_id", F.col("doc_id"), F.col("doc_id"), F.lit(True)))


def _possible() -> Column:
    """Whether (weight, draws) and (vw, vd) leave a link possible."""
    ratio = F.least("weight", "vw") >= F.greatest("weight", "vw") * (THRESHOLD - 1e-9)
    return ratio & (_agree("draws", "vd") >= MIN_AGREE)


def _kept(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs).where("kept AND doc_id IS NOT NULL")
    return sized(stored(found.select("doc_id").distinct(), "kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with the first document of each class; rows without an id stay.

    Of rows with one id and one text, one stays.  Where an id has several texts, each of them is a document
    of its own: rows are numbered, and the first of each class by number stays.
    """
    known, nameless = docs.where(F.col("doc_id").isNotNull()), docs.where(F.col("doc_id").isNull())
    if known.groupBy("doc_id").count().where("count > 1").isEmpty():
        return known.join(_kept(known), "doc_id", "left_semi").select(*docs.columns).unionByName(nameless)
    number = "_" + max(docs.columns, key=len)  # longer than any column's name
    rows = stored(known.dropDuplicates(["doc_id", "text"]).withColumn(number, F.monotonically_increasing_id()), "rows")
    kept = _kept(rows.select(F.col(number).alias("doc_id"), "text")).withColumnRenamed("doc_id", number)
    return rows.join(kept, number, "left_semi").select(*docs.columns).unionByName(nameless)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
