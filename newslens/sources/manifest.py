"""Feed manifests: text lines ``size hash url`` listing the published files.

One scan of the manifest text (``spark.read.text`` over one or more manifest
files) replaces the reference's six HTTP reads; selection by file kind and
time window are column predicates on that scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions.fields import PY_WHITESPACE_CLASS, bind

# --- Fixed values -------------------------------------------------------------
# File-kind masks (substring tests on the URL) and the feed each selects,
# checked in this order.
FEED_MASKS = [("export", "export.CSV.zip"), ("mentions", "mentions.CSV.zip"),
              ("gkg", "gkg.csv.zip")]
FEED_CLASSES = [("export", "export.CSV"), ("mentions", "mentions.CSV"), ("gkg", "gkg.csv")]
# File names start with a 14-digit timestamp (yyyyMMddHHmmss).
FILE_KEY_PATTERN = r"^[0-9]{14}$"
# ------------------------------------------------------------------------------


def read_manifest(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    return spark.read.text(paths)


def file_key_to_ts(key: Column) -> Column:
    """14-digit ``yyyyMMddHHmmss`` key -> TIMESTAMP_NTZ (null when not a valid date-time).

    Built from the digit fields, so no session time zone (and no DST gap) is involved.
    """
    def parse(k: Column) -> Column:
        part = [F.substring(k, pos, n).cast("int") for pos, n in
                ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))]
        return F.when(k.rlike(FILE_KEY_PATTERN), F.try_make_timestamp_ntz(*part))
    return bind(key, parse)


def file_key_to_event_time(key: Column) -> Column:
    """The file's wall-clock time read as UTC, as a TIMESTAMP (for watermarks).

    Streaming event time must be a TIMESTAMP; reading the digits as UTC keeps
    it independent of the session time zone and aligns 12-hour tumbling
    windows with the feed's half days.
    """
    def parse(k: Column) -> Column:
        part = [F.substring(k, pos, n).cast("int") for pos, n in
                ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))]
        return F.when(k.rlike(FILE_KEY_PATTERN),
                      F.try_make_timestamp(*part, timezone=F.lit("UTC")))
    return bind(key, parse)


def feed_of(url: Column) -> Column:
    """Feed name of a URL by substring, first match wins (null if none)."""
    out = None
    for feed, mask in FEED_CLASSES:
        out = F.when(url.contains(mask), F.lit(feed)) if out is None else out.when(
            url.contains(mask), F.lit(feed))
    return out


def manifest_entries(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines with exactly three whitespace-separated fields -> one row per file.

    Columns: size, hash, url, file_name (last path segment), file_key (file name
    up to its first dot), file_ts (null when the key is not a timestamp), feed.
    """
    # Python's str.split(): runs of whitespace, no empty leading/trailing fields.
    parts = F.filter(F.split(F.col(value), PY_WHITESPACE_CLASS + "+", -1), lambda t: t != "")
    rows = lines.select(parts.alias("p")).filter(F.size("p") == 3)
    url = F.get("p", F.lit(2))
    file_name = F.substring_index(url, "/", -1)
    key = F.substring_index(file_name, ".", 1)
    return rows.select(
        F.get("p", F.lit(0)).alias("size"), F.get("p", F.lit(1)).alias("hash"),
        url.alias("url"), file_name.alias("file_name"), key.alias("file_key"),
        file_key_to_ts(key).alias("file_ts"), feed_of(url).alias("feed"))


def _key(ts: dt.datetime) -> str:
    return ts.strftime("%Y%m%d%H%M%S")


def manifest_window(entries: DataFrame, start: dt.datetime, end: dt.datetime,
                    file_type: str) -> DataFrame:
    """Files whose URL contains ``file_type`` and whose time is in ``[start, end]``.

    Both bounds are inclusive; entries with an unparsable time are skipped.
    Bounds compare as 14-digit keys, so no time zone is involved.
    """
    return entries.filter(
        F.col("url").contains(file_type) & F.col("file_ts").isNotNull()
        & F.col("file_key").between(_key(start), _key(end)))


def selected_files(entries: DataFrame, start: dt.datetime | None = None,
                   end: dt.datetime | None = None) -> DataFrame:
    """Files of the three feed kinds (optionally in a window), with their feed."""
    cond = None
    for _, mask in FEED_MASKS:
        c = F.col("url").contains(mask)
        cond = c if cond is None else cond | c
    out = entries.filter(cond)
    if start is not None:
        out = out.filter(F.col("file_ts").isNotNull() & (F.col("file_key") >= _key(start)))
    if end is not None:
        out = out.filter(F.col("file_ts").isNotNull() & (F.col("file_key") <= _key(end)))
    return out


def manifest_by_feed(entries: DataFrame, start: dt.datetime | None = None,
                     end: dt.datetime | None = None) -> DataFrame:
    """File count per feed (export / mentions / gkg)."""
    return (selected_files(entries, start, end)
            .groupBy("feed").agg(F.count("*").alias("file_count")))
