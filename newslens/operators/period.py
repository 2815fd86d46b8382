"""Period granularity and per-period ranking.

One shared core replaces the reference's per-granularity copies: a
granularity names the period columns, and ``top_k_per_group`` keeps the best
``k`` rows of each period.

Scale note: ``row_number() <= k`` is planned by Catalyst as a
``WindowGroupLimit`` that runs once *before* the shuffle (partial: each map
task keeps at most ``k`` rows per period) and once after it (final).  A hot
period therefore ships at most ``k`` rows per map task to its reducer instead
of all of its rows; the final per-period sort sees ``tasks * k`` rows at most.

Beyond ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default) Spark
leaves the partial step out, and a hot period would be sorted in one task.  Such a
``k`` is ranked in three distributed steps: a cut-off per period from a histogram of
the leading value drops what cannot be among the best ``k``; the rest is cut into
ranges of (period, order) that are written once; a row's rank is its place in its
range plus the sizes of the period's ranges ahead.  No task holds more than a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.session import scratch_path

#: Quantiles of the histogram per period, and the accuracy that Spark computes them with.
QUANTILES, ACCURACY = 200, 2000

GRANULARITY_COLUMNS: dict[str, tuple[str, ...]] = {
    "year": ("event_year",),
    "month": ("event_year", "event_month"),
    "day": ("event_year", "event_month", "event_day"),
}


def period_columns(granularity: str) -> list[str]:
    try:
        return list(GRANULARITY_COLUMNS[granularity])
    except KeyError:
        raise ValueError(
            f"unknown granularity {granularity!r}; expected one of "
            f"{sorted(GRANULARITY_COLUMNS)}") from None


def period_desc(granularity: str) -> list[Column]:
    """Newest period first."""
    return [F.desc_nulls_last(c) for c in period_columns(granularity)]


def group_limit(df: DataFrame) -> int:
    """The largest ``k`` for which Spark ranks per map task first."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_by: Sequence[Column],
                    k: int, lead: str | None = None) -> DataFrame:
    """Rows ranked ``1..k`` by ``order_by`` within each group (exactly ``<= k`` per group).

    ``order_by`` should be a total order so the result does not depend on
    partitioning.  Callers pass rows that are aggregated already.  ``lead`` names the
    column that ``order_by`` begins with, if that is a number in descending order.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if k > group_limit(df):
        return _deep_top_k(df, list(group_cols), list(order_by), k, lead)
    w = Window.partitionBy(*group_cols).orderBy(*order_by)
    rank = "__rank"
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k).drop(rank)


def _cut_off(df: DataFrame, group_cols: list[str], k: int, lead: str) -> DataFrame:
    """Rows without those whose ``lead`` is too small to be among a group's best ``k``.

    The bound is a quantile with room for the histogram's error; a group where fewer
    than ``k`` rows reach it keeps all of its rows, so nothing of the result is lost.
    """
    shares = [q / QUANTILES for q in range(QUANTILES + 1)]
    bounds = df.groupBy(*group_cols).agg(
        F.count("*").alias("_n"),
        F.percentile_approx(F.col(lead), shares, ACCURACY).alias("_q"))
    room = F.lit(float(k)) / F.col("_n") + F.lit(2.0 / ACCURACY)
    place = F.floor((F.lit(1.0) - room) * QUANTILES).cast("int")
    bounds = bounds.select(*group_cols, F.when(place >= 0, F.get("_q", place)).alias("_least"))
    same = reduce(lambda a, b: a & b, [
        F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group_cols])
    reach = df.alias("a").join(bounds.alias("b"), same).filter(
        F.col(f"a.{lead}") >= F.col("b._least"))
    enough = reach.groupBy(*[F.col(f"a.{c}").alias(c) for c in group_cols],
                           F.col("b._least").alias("_least")).agg(
        F.count("*").alias("_reach")).filter(F.col("_reach") >= k).drop("_reach")
    return (df.alias("a").join(enough.alias("b"), same, "left")
            .filter(F.col("b._least").isNull() | (F.col(f"a.{lead}") >= F.col("b._least")))
            .select("a.*"))


def _deep_top_k(df: DataFrame, group_cols: list[str], order_by: list[Column], k: int,
                lead: str | None) -> DataFrame:
    spark, names = df.sparkSession, df.columns
    if lead is not None:
        path = scratch_path(spark, "top-k-rows")
        df.write.parquet(path)
        df = _cut_off(spark.read.schema(df.schema).parquet(path), group_cols, k, lead)
    path = scratch_path(spark, "top-k-ranges")
    # Ranges are cut by a sample, so they are written once and read as they are.
    (df.repartitionByRange(*group_cols, *order_by)
     .withColumn("__range", F.spark_partition_id()).write.parquet(path))
    ranged = spark.read.parquet(path)
    sizes = ranged.groupBy(*group_cols, "__range").agg(F.count("*").alias("__size"))
    ahead = (Window.partitionBy(*group_cols).orderBy("__range")
             .rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*group_cols, "__range",
                         F.coalesce(F.sum("__size").over(ahead), F.lit(0)).alias("__ahead"))
    # Ranges behind a group's best k are not even read.
    sizes = sizes.filter(F.col("__ahead") < k)
    same = reduce(lambda a, b: a & b, [
        F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*group_cols, "__range"]])
    placed = ranged.alias("a").join(sizes.alias("b"), same).select("a.*", "b.__ahead")
    inside = Window.partitionBy(*group_cols, "__range").orderBy(*order_by)
    return (placed.withColumn("__rank", F.row_number().over(inside) + F.col("__ahead"))
            .filter(F.col("__rank") <= k).select(*names))
