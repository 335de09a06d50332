"""What each filter of a chain removes, in every order: joins of the filters' tables of failing rows.

Each filter's failing rows are stored as a table of their own (a partition of one Parquet table), with the
row's part and labels.  What a filter removes after a set of others is its table, left-anti joined with
theirs; what is left after a set is the table of all rows, joined alike.  So a prefix is a chain of
left-anti joins, and orders that share a prefix's set share its result: 32 sets serve the 120 orders.
Texts are read once; the joins move row numbers only.

Rows count one by one, also where ids repeat or are null: a row's number, not its id, is the key.  A null
text is empty, a null lang is the part ''.  Labels are those of the row's id; a null id has none, and of
several label rows of an id any that says 1 counts.  Other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, stored, whole_text

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 3  # words, percent of words, percent of characters
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SALTS = 16  # tasks that share the rows of one text
ALL = "all"  # the table that every row is in
COUNTS = ("n", "good", "toxic")


def failures(text: Column) -> dict[str, Column]:
    """Whether a text fails the filters that need nothing but itself."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    n_words = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": n_words < MIN_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < n_words * MIN_DISTINCT,
        "C": capitals * 100 > F.length(text) * MAX_CAPITALS,
        "D": text.rlike("[#$%&*|]"),
    }


def facts(docs: DataFrame) -> DataFrame:
    """(row, doc_id, part, failing, digest) of each row, stored: row numbers stay what they were."""
    text = whole_text()
    failing = F.array_compact(F.array(*(F.when(fails, F.lit(name)) for name, fails in failures(text).items())))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("lang", F.lit("")).alias("part"),
        failing.alias("failing"), F.sha2(text, 256).alias("digest"),
    )
    return stored(rows, "filter-facts")


def repeats(rows: DataFrame) -> DataFrame:
    """The numbers of rows whose text a smaller doc_id has: a left-semi join with each text's least id.

    Only texts that two different ids have are joined.  The rows of a text are dealt over SALTS tasks, each
    of which has the text's least id, so copies of one text do not meet in one task.
    """
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = least.filter("least < most").select(
        F.col("digest").alias("text"), "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    again = (F.col("digest") == F.col("text")) & (F.col("row") % SALTS == F.col("salt")) & (F.col("doc_id") > F.col("least"))
    return rows.join(shared, again, "left_semi").select("row")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with good and toxic (0 or 1)."""
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    found = rows.join(known.filter("good = 1 OR toxic = 1"), "doc_id", "left")
    return found.withColumns({name: F.coalesce(name, F.lit(0)) for name in ("good", "toxic")})


def id_tables(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(filter, row, part, good, toxic): a stored partition per filter, and one (ALL) of all rows."""
    rows = facts(docs)
    known = labelled(rows, labels)
    kept = ["row", "part", "good", "toxic"]
    own = known.select(F.explode(F.concat(F.array(F.lit(ALL)), "failing")).alias("filter"), *kept)
    again = known.select(*kept).join(repeats(rows), "row", "left_semi").select(F.lit("E").alias("filter"), *kept)
    return stored(own.unionByName(again), "filter-rows", partition_by=("filter",))


def spread(rows: DataFrame, tables: DataFrame, names: str) -> DataFrame:
    """Rows (with the set that they outlived, ``before``), and those that outlive each set of names as well."""
    branches = [rows]
    for name in names:
        failing = tables.filter(F.col("filter") == name).select("row")
        branches += [
            outlived.filter(F.col("filter") != name).join(failing, "row", "left_anti")
            .withColumn("before", F.concat("before", F.lit(name)))
            for outlived in branches
        ]
    return reduce(DataFrame.unionByName, branches)


def after_sets(tables: DataFrame) -> DataFrame:
    """(filter, before, part, n, good, toxic): what each filter removes after each set of other filters.

    ``before`` holds the set's letters in order; the rows of ALL are the survivors of the set.  Every filter
    is added to all sets so far by left-anti joins, for all filters' rows at once.  The sets of the first
    filters are stored, which keeps plans small.
    """
    first = stored(spread(tables.withColumn("before", F.lit("")), tables, FILTERS[:2]), "filter-sets")
    return spread(first, tables, FILTERS[2:]).groupBy("filter", "before", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step.

    kept and removed: rows after and by this step; redundant: rows that fail its filter but were removed
    before; unique_fails: rows that fail its filter alone; good_lost, toxic_lost: labelled rows among the
    removed; shapley: the filter's removed rows summed over all orders.
    """
    counts = stored(after_sets(id_tables(docs, labels)), "filter-counts")
    entry = F.struct(F.concat_ws(":", "filter", "before").alias("key"), F.struct(*COUNTS).alias("counts"))
    # at most 6 filters x 32 sets a part
    parts = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(entry)).alias("found"))

    orders = ",".join(map("".join, permutations(FILTERS)))
    steps = parts.select("part", "found", F.explode(F.split(F.lit(orders), ",")).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    )

    def letters(text: Column) -> Column:
        return F.array_join(F.array_sort(F.split(text, "")), "")

    prefix = steps.withColumns({
        "filter": F.expr("substring(filter_order, step, 1)"),
        "before": letters(F.expr("substring(filter_order, 1, step - 1)")),
        "upto": letters(F.expr("substring(filter_order, 1, step)")),
    })

    def count(name: str, of: Column, before: Column) -> Column:
        return F.coalesce(F.try_element_at("found", F.concat(of, F.lit(":"), before))[name], F.lit(0))

    step_filter, before = F.col("filter"), F.col("before")
    others = F.expr(f"translate('{FILTERS}', filter, '')")
    found = prefix.select(
        "part", "filter_order", "step", "filter",
        count("n", F.lit(ALL), F.col("upto")).alias("kept"),
        count("n", step_filter, before).alias("removed"),
        (count("n", step_filter, F.lit("")) - count("n", step_filter, before)).alias("redundant"),
        count("n", step_filter, others).alias("unique_fails"),
        count("good", step_filter, before).alias("good_lost"),
        count("toxic", step_filter, before).alias("toxic_lost"),
    )
    orders_of = Window.partitionBy("part", "filter")
    return found.withColumn("shapley", F.sum("removed").over(orders_of)).drop("filter")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the five filters over all documents, in every order, by language."""
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
