"""Quality rules: perplexity of whole texts under a modified Kneser-Ney model of character n-grams.

Spark counts the n-grams of every text, over real code points (see pointmodel).  From the counts of the
highest order come the continuation counts of the lower ones (distinct symbols before an n-gram), three
discounts per order from the counts of counts, and interpolated probabilities.  The model is sorted
arrays of n-grams and contexts; a lookup is a binary search.  KneserNey is the same model over the folded
alphabet of charmodel, for words that toxicity restores; it scores no document here.  Per language,
documents are rejected whose log-perplexity lies outside the median plus or minus BAND times the spread
(the median distance from it, at least MIN_SPREAD).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import statistics
from .charmodel import BITS, ORDER, blocks, grams, stream
from .common import map_texts, read, stored
from .pointmodel import Model, trained

BAND, MIN_SPREAD = 8.0, 0.04
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: Accuracy of the percentiles: relative error of the rank is 1 / PRECISION.
PRECISION = 10_000


class KneserNey:
    """Interpolated modified Kneser-Ney; grams[n], logp[n] and contexts[n], backoff[n] by order n."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.order = order
        order_of = np.argsort(codes)
        keys, values = codes[order_of].astype(np.uint32), counts[order_of].astype(np.float64)
        levels = {order: (keys, values)}
        for n in range(order - 1, 0, -1):  # distinct symbols before: each longer n-gram counts once
            shorter = levels[n + 1][0] & np.uint32((1 << (BITS * n)) - 1)
            k, v = np.unique(shorter, return_counts=True)
            levels[n] = (k, v.astype(np.float64))
        self.grams, self.logp, self.contexts, self.backoff = {}, {}, {}, {}
        for n in range(1, order + 1):
            k, v = levels[n]
            have = np.array([(v == i).sum() for i in range(1, 5)], np.float64)
            y = have[0] / max(1.0, have[0] + 2 * have[1])
            cuts = [0.0] + [
                float(np.clip(i - (i + 1) * y * have[i] / have[i - 1], 0.1 * i, i)) if have[i - 1] else 0.5 * i for i in (1, 2, 3)
            ]
            discount = np.array(cuts)[np.minimum(v, 3).astype(np.int64)]
            context, inverse = np.unique(k >> np.uint32(BITS), return_inverse=True)
            total = np.bincount(inverse, v, len(context))
            left = np.bincount(inverse, discount, len(context)) / total
            lower = self.probability(k & np.uint32((1 << (BITS * (n - 1))) - 1), n - 1)
            self.grams[n], self.logp[n] = k, np.log((v - discount) / total[inverse] + left[inverse] * lower)
            self.contexts[n], self.backoff[n] = context, np.log(left)

    def probability(self, codes: np.ndarray, n: int) -> np.ndarray:
        return np.exp(self.log_probability(codes, n))

    def log_probability(self, codes: np.ndarray, n: int | None = None) -> np.ndarray:
        """Of the last symbol after the ones before it, for n-gram numbers of order n."""
        n = self.order if n is None else n
        if n == 0 or not len(codes):
            return np.full(len(codes), -BITS * np.log(2.0))  # each of the 64 symbols alike
        at = np.minimum(np.searchsorted(self.grams[n], codes), len(self.grams[n]) - 1)
        out = self.logp[n][at].copy()
        missing = np.flatnonzero(self.grams[n][at] != codes)
        if len(missing):
            rest = codes[missing]
            context = rest >> np.uint32(BITS)
            spot = np.minimum(np.searchsorted(self.contexts[n], context), len(self.contexts[n]) - 1)
            known = self.contexts[n][spot] == context
            lower = self.log_probability(rest & np.uint32((1 << (BITS * (n - 1))) - 1), n - 1)
            out[missing] = np.where(known, self.backoff[n][spot], 0.0) + lower
        return out

    def log_perplexity(self, texts: list[str]) -> np.ndarray:
        """Minus the mean log-probability of each text's symbols and its end."""
        out = []
        for group in blocks(texts):
            symbols, begins = stream(group, self.order)
            sums = np.zeros(len(group))
            ends = np.append(begins[1:] - self.order + 1, len(symbols) - self.order + 1)
            for i, (begin, end) in enumerate(zip(begins, ends, strict=True)) if len(group) == 1 else ():
                for at in range(begin, end, 1 << 20):  # a long text block by block
                    part = symbols[at : min(at + (1 << 20), end) + self.order - 1]
                    sums[i] += self.log_probability(grams(part, self.order)).sum()
            if len(group) > 1:
                total = np.append(0.0, np.cumsum(self.log_probability(grams(symbols, self.order))))
                sums = total[ends] - total[begins]
            out.append(-sums / (ends - begins))
        return np.concatenate(out) if out else np.zeros(0)


def measured(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, lang, the base counts and log_perplexity."""

    def row(texts: list[str]) -> dict:
        base = [statistics.base(t) for t in texts]
        return {k: [b[k] for b in base] for k in base[0]} | {"log_perplexity": model.log_perplexity(texts)}

    schema = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_perplexity double"
    return map_texts(docs, row, schema, ("doc_id", "lang"))


def failed_base() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def bands(rows: DataFrame) -> DataFrame:
    """(lang, lower, upper) limits of log_perplexity, from all documents that pass the base rules.

    Sketches of the percentiles are merged map-side, so a language with most rows is no hot group.
    """
    passed = rows.where(~failed_base())
    middle = passed.groupBy("lang").agg(F.percentile_approx("log_perplexity", 0.5, PRECISION).alias("middle"))
    spread = (
        passed.join(middle.withColumnRenamed("lang", "__lang"), F.col("lang").eqNullSafe(F.col("__lang")))
        .groupBy("lang", "middle")
        .agg(F.percentile_approx(F.abs(F.col("log_perplexity") - F.col("middle")), 0.5, PRECISION).alias("spread"))
    )
    width = BAND * F.greatest("spread", F.lit(MIN_SPREAD))
    return spread.select("lang", (F.col("middle") - width).alias("lower"), (F.col("middle") + width).alias("upper"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, kept, log_perplexity, lower, upper.

    Null and empty texts have no words and fail the base rules.  A null language is a language of its
    own; a language none of whose documents passes the base rules has no band.  Repeated rows are
    judged each; other columns are ignored.
    """
    rows = stored(measured(docs, trained(docs)), "perplexity")
    limits = bands(rows).withColumnRenamed("lang", "__lang")
    inside = F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    return (
        rows.join(limits, F.col("lang").eqNullSafe(F.col("__lang")), "left")
        .withColumn("base_failed", failed_base())
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
        .drop("lang", "__lang")
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))
