"""Timed rows in windows of any length that may overlap (W1, W2 beyond half days).

A row belongs to every window that holds its time, which is a join on a range.  Here it
is an equality join: a window is cut into the fewest stretches of 2^n seconds that start
at a multiple of their length (at most two a size, so some thirty for a week, some sixty
for a century), and a time lies in exactly one stretch of each size.  A row meets a
window in one stretch or none, so nothing is compared beyond the key and no pair comes
twice.  Rows are repeated once for each size that the windows use, whatever their number.

Windows are a set of ``window_start``, ``window_end``, both included, in whole seconds
without a time zone; fractions of a row's second are cut.  A window with a null bound, or
that ends before it starts, holds nothing, and neither does a row without a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.sources import manifest

BOUNDS = ["window_start", "window_end"]
# 2^40 seconds are more than all the years that a timestamp can name.
SIZES = 41


def seconds(ts: Column) -> Column:
    """Seconds since 1970 of a time without zone."""
    days = F.date_diff(F.to_date(ts), F.lit(dt.date(1970, 1, 1))).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts).cast("long")


def stretches(first: Column, end: Column) -> Column:
    """``[first, end)`` as an array of (size, number): ``2^size`` seconds from ``number``."""
    start = F.struct(first.alias("a"), end.alias("b"),
                     F.expr("CAST(array() AS array<struct<size:int,number:bigint>>)").alias("out"))

    def piece(keep: Column, size: Column, number: Column) -> Column:
        one = F.struct(size.alias("size"), number.alias("number"))
        return F.filter(F.array(one), lambda _: keep)

    def step(at: Column, size: Column) -> Column:
        a, b = at["a"], at["b"]
        left = (a < b) & (a.bitwiseAND(F.lit(1).cast("long")) == 1)
        # A last odd stretch, unless the left one was all there was.
        right = (b.bitwiseAND(F.lit(1).cast("long")) == 1) & (
            F.when(left, a + 1).otherwise(a) < b)
        return F.struct(
            F.shiftright(F.when(left, a + 1).otherwise(a), 1).alias("a"),
            F.shiftright(F.when(right, b - 1).otherwise(b), 1).alias("b"),
            F.concat(at["out"], piece(left, size, a), piece(right, size, b - 1)).alias("out"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(SIZES - 1)), start, step, lambda at: at["out"])


def rows_in_windows(rows: DataFrame, windows: DataFrame, ts_col: str = "file_ts") -> DataFrame:
    """Every row beside each window that holds its time: the rows' columns and ``BOUNDS``."""
    clash = set(BOUNDS) & set(rows.columns)
    if clash:
        raise ValueError(f"rows have columns of the windows' names: {sorted(clash)}")
    w = windows.select(*BOUNDS).distinct()
    cut = w.select(*BOUNDS, F.explode(stretches(
        seconds(F.col("window_start")), seconds(F.col("window_end")) + 1)).alias("_stretch"))
    # At most SIZES values.
    sizes = [r[0] for r in cut.select("_stretch.size").distinct().collect()]
    if not sizes:
        return rows.select("*", *[F.lit(None).cast(w.schema[c].dataType).alias(c)
                                  for c in BOUNDS]).filter(F.lit(False))
    of_time = F.transform(
        F.lit(sorted(sizes)).cast("array<int>"),
        lambda size: F.struct(size.alias("size"),
                              F.floor(F.col("_second") / F.pow(F.lit(2.0), size)).alias("number")))
    timed = (rows.withColumn("_second", seconds(F.col(ts_col)))
             .filter(F.col("_second").isNotNull())
             .withColumn("_stretch", F.explode(of_time)).drop("_second"))
    return timed.join(cut, "_stretch").drop("_stretch")


def counts_in_windows(rows: DataFrame, windows: DataFrame, ts_col: str,
                      counts: dict[str, Column]) -> DataFrame:
    """Sums over each window's rows, zero for a window without any.

    ``counts`` names integer aggregates that add up over parts.  Rows are reduced to one
    per time before they meet the windows, so a time of many rows is one row there.
    """
    per_time = rows.groupBy(F.col(ts_col).alias("_time")).agg(
        *[c.alias(n) for n, c in counts.items()])
    held = (rows_in_windows(per_time, windows, "_time").groupBy(*BOUNDS)
            .agg(*[F.sum(n).alias(n) for n in counts]))
    return (windows.select(*BOUNDS).distinct().join(held, BOUNDS, "left")
            .select(*BOUNDS, *[F.coalesce(n, F.lit(0)).alias(n) for n in counts]))


def sliding_windows(spark: SparkSession, first: dt.datetime, last: dt.datetime,
                    length: dt.timedelta, every: dt.timedelta) -> DataFrame:
    """Windows of ``length`` that start at ``first`` and ``every`` so often up to ``last``."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(every.total_seconds()))
    # Texts, as a literal time would be read in the session's zone.
    bounds = [F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (first, last)]
    starts = spark.range(1).select(F.explode(F.sequence(*bounds, step)).alias("s"))
    return starts.select(F.col("s").alias("window_start"), F.timestamp_add(
        "SECOND", F.lit(int(length.total_seconds()) - 1), F.col("s")).alias("window_end"))


def files_per_any_window(entries: DataFrame, windows: DataFrame) -> DataFrame:
    """``ingest.files_per_window`` for windows of any length, overlapping or not."""
    feeds = [f for f, _ in manifest.FEED_MASKS]
    return counts_in_windows(
        manifest.selected_files(entries), windows, "file_ts",
        {**{f"{f}_files": F.count_if(F.col("feed") == f) for f in feeds},
         "file_count": F.count("*")})
