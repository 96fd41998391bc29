"""Previous and next readings of a series, without sending a whole series to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.config import Config

BUCKET = "_bucket"


def hot_days(
    counts: DataFrame, keys: list[str], day_col: str, count_col: str, cfg: Config = Config()
) -> DataFrame:
    """Key-days holding more than ``hot_share`` of all rows (and more than ``hot_floor``).

    At most ``1 / hot_share`` key-days can qualify, so the result is safe to broadcast.
    """
    cutoff = counts.agg(
        F.greatest(F.sum(count_col) * F.lit(cfg.hot_share), F.lit(float(cfg.hot_floor)))
    ).scalar()
    per_day = counts.groupBy(*keys, day_col).agg(F.sum(count_col).alias("_rows"))
    return per_day.where(F.col("_rows") > cutoff).select(*keys, day_col)


def busy_days(
    df: DataFrame, keys: list[str], order_col: str, cfg: Config = Config()
) -> DataFrame:
    """``hot_days`` counted from the rows themselves: one narrow scan, partially aggregated."""
    counts = df.groupBy(*keys, F.to_date(order_col).alias("_counted_day")).agg(
        F.count("*").alias("_count")
    )
    return hot_days(counts, keys, "_counted_day", "_count", cfg)


def with_bucket(df: DataFrame, keys: list[str], order_col: str, hot: DataFrame) -> DataFrame:
    """Adds the time bucket of each row: its hour, or its minute on the hot days of a key."""
    moment = F.col(order_col)
    day = next(c for c in hot.columns if c not in keys)
    marked = F.broadcast(hot.select(*keys, F.col(day).alias("_day"), F.lit(True).alias("_hot")))
    return (
        df.withColumn("_day", F.to_date(moment))
        .join(marked, [*keys, "_day"], "left")
        .withColumn(
            BUCKET,
            F.when(F.col("_hot"), F.date_trunc("minute", moment)).otherwise(
                F.date_trunc("hour", moment)
            ),
        )
        .drop("_day", "_hot")
    )


def bucket_edges(
    bucketed: DataFrame, keys: list[str], order_col: str, cols: list[str], forward: bool = False
) -> DataFrame:
    """For each bucket the values of the nearest row outside it, as ``_carry_<col>``.

    Buckets are first reduced to their last (or first) row by a partial aggregation; only one
    row per bucket enters the window over a whole series.
    """
    pick, step = (F.min_by, F.lead) if forward else (F.max_by, F.lag)
    edges = bucketed.groupBy(*keys, BUCKET).agg(
        *(pick(c, order_col).alias(f"_edge_{c}") for c in cols)
    )
    across = Window.partitionBy(*keys).orderBy(BUCKET)
    return edges.select(
        *keys, BUCKET, *(step(f"_edge_{c}").over(across).alias(f"_carry_{c}") for c in cols)
    )


def attach_neighbours(
    bucketed: DataFrame,
    carry: DataFrame,
    keys: list[str],
    order_col: str,
    cols: list[str],
    prefix: str,
    forward: bool = False,
) -> DataFrame:
    """Adds ``<prefix><col>`` from the neighbouring row; extra columns of ``carry`` stay.

    The window and the join use the same keys, so the rows are shuffled and sorted once.
    """
    step = F.lead if forward else F.lag
    inside = Window.partitionBy(*keys, BUCKET).orderBy(order_col)
    stepped = bucketed.withColumns(
        {
            "_edge": step(F.lit(True)).over(inside).isNull(),
            **{f"_inside_{c}": step(c).over(inside) for c in cols},
        }
    )
    joined = stepped.join(carry, [*keys, BUCKET], "left")

    def pick(c: str) -> Column:
        return F.when(F.col("_edge"), F.col(f"_carry_{c}")).otherwise(F.col(f"_inside_{c}"))

    helpers = [f"_{kind}_{c}" for kind in ("inside", "carry") for c in cols]
    return joined.withColumns({f"{prefix}{c}": pick(c) for c in cols}).drop("_edge", *helpers)


def with_neighbour(
    df: DataFrame,
    keys: list[str],
    order_col: str,
    cols: list[str],
    forward: bool = False,
    prefix: str | None = None,
    hot: DataFrame | None = None,
    cfg: Config = Config(),
) -> DataFrame:
    """LAG (or LEAD) of ``cols`` per key by ``order_col``.

    Same result as a window over the whole series for non-null keys and distinct, non-null
    order values, but a series is split into time buckets: each bucket takes the row before
    its first row from the last row of the bucket before. ``hot`` (from ``hot_days``) saves
    counting the rows when a summary already holds the counts.
    """
    prefix = prefix or ("next_" if forward else "prev_")
    if hot is None:
        hot = busy_days(df, keys, order_col, cfg)
    bucketed = with_bucket(df, keys, order_col, hot)
    carry = bucket_edges(bucketed, keys, order_col, cols, forward)
    return attach_neighbours(bucketed, carry, keys, order_col, cols, prefix, forward).drop(BUCKET)
