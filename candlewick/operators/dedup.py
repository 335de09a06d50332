"""Latest-wins deduplication to a grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_by(rows: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Keep one row per key: the one with the highest ``newest`` columns (nulls lose).

    Ties are broken by all remaining columns, so the result does not depend on the partitioning.
    Spark limits the rank before the shuffle (``WindowGroupLimit``): each map task sends at most
    one row per key, so a key with a third of all rows is no hot spot.
    """
    rest = [name for name in rows.columns if name not in keys and name not in newest]
    order = [F.col(name).desc_nulls_last() for name in [*newest, *rest]]
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
