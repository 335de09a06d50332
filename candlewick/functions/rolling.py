"""Window helpers for daily series.

Frames count rows, not days.  The windows are partitioned by entity only, which is safe because
they run at daily grain: one entity has at most one row per calendar day, so even the hottest
entity contributes a few thousand rows however many raw rows it had before (the reduction to days
happens earlier, with map-side partial aggregation or map-side rank limits).
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec, functions as F


def series(entity: str | list[str], order: str) -> WindowSpec:
    """One entity's rows in time order, unknown times last."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())


def trailing(window: WindowSpec, n_rows: int) -> WindowSpec:
    """The current row and the ``n_rows - 1`` rows before it."""
    return window.rowsBetween(1 - n_rows, Window.currentRow)


def change(column: str, window: WindowSpec) -> Column:
    return F.col(column) - F.lag(column).over(window)


def rolling_mean(column: str, window: WindowSpec, n_rows: int) -> Column:
    return F.avg(column).over(trailing(window, n_rows))


def rolling_std(column: str, window: WindowSpec, n_rows: int) -> Column:
    """Sample deviation; null while the frame has fewer than two values."""
    return F.stddev_samp(column).over(trailing(window, n_rows))


def rolling_corr(x: str, y: str, window: WindowSpec, n_rows: int) -> Column:
    """Pearson correlation over the complete pairs of the frame.

    Null without any pair; NaN where it is undefined (one pair, or a constant side).  Built from
    its moments because ``corr`` itself raises a division error on a constant side in ANSI mode.
    """
    frame = trailing(window, n_rows)
    x_val, y_val = F.col(x).cast("double"), F.col(y).cast("double")
    x_pair = F.when(y_val.isNotNull(), x_val)
    y_pair = F.when(x_val.isNotNull(), y_val)
    pairs = F.count(F.when(x_val.isNotNull() & y_val.isNotNull(), F.lit(1))).over(frame)
    spread = F.stddev_samp(x_pair).over(frame) * F.stddev_samp(y_pair).over(frame)
    shared = F.covar_samp(x_pair, y_pair).over(frame)
    undefined = (pairs == 1) | (spread == 0)
    return (
        F.when(pairs == 0, F.lit(None).cast("double"))
        .when(undefined, F.lit(float("nan")))
        .otherwise(F.try_divide(shared, spread))
    )
