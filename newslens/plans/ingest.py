"""Incremental ingest: half-day windows, file assignment, window processing.

W1  ``half_day_windows`` / ``windows_from_entries`` - two windows per calendar
    day, ``[00:00:00, 11:45:00]`` and ``[12:00:00, 23:45:00]``, both inclusive
    (calendar days, so no drift across a DST change).
W2  ``assign_windows`` - each file's window is *computed* from its timestamp
    (no range join); files between 11:45:01 and 11:59:59 (or after 23:45:00)
    fall in no window.  ``files_per_window`` reports per-window counts.
W3  ``process_windows`` - one Spark job for any number of windows: the
    export x mentions join stays inside a window and the latest window wins
    per key, which equals processing the windows one after another.  The result
    is applied to the serving tables with the keyed, partition-scoped upsert.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions.fields import bind
from newslens.operators import prepare
from newslens.schemas import FEED_SCHEMAS
from newslens.session import scratch_path
from newslens.sources import archives, lines, manifest, serving

# --- Fixed values: the two half-day windows (seconds after midnight) ----------
HALF_DAYS = [(0, 11 * 3600 + 45 * 60), (12 * 3600, 23 * 3600 + 45 * 60)]
# ------------------------------------------------------------------------------

WINDOW_COLUMNS = ["window_start", "window_end", "batch_seq"]


def _at(day: Column, seconds: Column | int) -> Column:
    secs = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_add("SECOND", secs, day.cast("timestamp_ntz"))


def batch_seq(window_start: Column) -> Column:
    """Window start as a sortable ``yyyyMMddHHmmss`` number (later window = larger)."""
    t = window_start
    ymd = F.year(t).cast("bigint") * 10000 + F.month(t) * 100 + F.dayofmonth(t)
    return ymd * 1000000 + F.hour(t) * 10000 + F.minute(t) * 100 + F.second(t)


def _windows_of_days(days: DataFrame) -> DataFrame:
    halves = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(e).alias("e")) for s, e in HALF_DAYS])
    w = days.select("window_date", F.explode(halves).alias("h"))
    start = _at(F.col("window_date"), F.col("h.s"))
    return w.select(start.alias("window_start"),
                    _at(F.col("window_date"), F.col("h.e")).alias("window_end"),
                    batch_seq(start).alias("batch_seq"))


def half_day_windows(spark: SparkSession, start_date: dt.date, end_date: dt.date) -> DataFrame:
    """Both end dates inclusive; ``2 * days`` rows."""
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(start_date), F.lit(end_date), F.expr("INTERVAL 1 DAY"))).alias("window_date"))
    return _windows_of_days(days)


def windows_from_entries(entries: DataFrame) -> DataFrame:
    """Windows covering every day from the first to the last dated file."""
    span = entries.filter(F.col("file_ts").isNotNull()).agg(
        F.min(F.to_date("file_ts")).alias("lo"), F.max(F.to_date("file_ts")).alias("hi"))
    days = span.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("window_date"))
    return _windows_of_days(days)


def window_of(ts: Column) -> dict[str, Column]:
    """The half-day window a timestamp falls in (all null when in none).

    Both windows last ``HALF_DAYS[i][1] - HALF_DAYS[i][0]`` seconds from their
    start, so one offset describes the window.  ``ts`` is bound once.
    """
    (s0, e0), (s1, e1) = HALF_DAYS

    def window(t: Column) -> Column:
        secs = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
        offset = F.when(secs < s1, F.lit(s0)).otherwise(F.lit(s1))
        span = F.when(secs < s1, F.lit(e0 - s0)).otherwise(F.lit(e1 - s1))
        start = _at(F.to_date(t), offset)
        return F.when((secs - offset) <= span, F.struct(
            start.alias("window_start"),
            F.timestamp_add("SECOND", span, start).alias("window_end"),
            batch_seq(start).alias("batch_seq")))

    w = bind(ts, window)
    return {n: w.getField(n) for n in WINDOW_COLUMNS}


def assign_windows(files: DataFrame, ts_col: str = "file_ts") -> DataFrame:
    """Add the window columns; files in no window are dropped."""
    w = window_of(F.col(ts_col))
    return files.select("*", *[c.alias(n) for n, c in w.items()]).filter(
        F.col("window_start").isNotNull())


def files_per_window(entries: DataFrame, windows: DataFrame) -> DataFrame:
    """File counts of the three feeds per window (every window listed, zero if empty).

    ``windows`` holds two rows per day of the requested range; no hint forces a
    broadcast, AQE picks one from the measured size of either side.
    """
    assigned = assign_windows(manifest.selected_files(entries))
    counts = assigned.groupBy("window_start").agg(
        *[F.count_if(F.col("feed") == f).alias(f"{f}_files") for f, _ in manifest.FEED_MASKS],
        F.count("*").alias("file_count"))
    w = windows.select(*WINDOW_COLUMNS)
    joined = w.join(counts, on="window_start", how="left")
    return joined.select(*WINDOW_COLUMNS, *[
        F.coalesce(F.col(c), F.lit(0)).alias(c)
        for c in [f"{f}_files" for f, _ in manifest.FEED_MASKS] + ["file_count"]])


# --- window processing ----------------------------------------------------------
def tag_files(df: DataFrame, path_col: str = "path",
              batch: tuple[dt.datetime, dt.datetime] | None = None) -> DataFrame:
    """Add feed and window columns from the archive file name (one row per file).

    Without ``batch`` each file goes to its half-day window; with
    ``batch=(start, end)`` every file is one batch, the requested range.
    """
    name = F.substring_index(F.col(path_col), "/", -1)
    if batch is None:
        ts = manifest.file_key_to_ts(F.substring_index(name, ".", 1))
        w = window_of(ts)
    else:
        start, end = batch
        w = {"window_start": F.lit(start).cast("timestamp_ntz"),
             "window_end": F.lit(end).cast("timestamp_ntz"),
             "batch_seq": F.lit(int(start.strftime("%Y%m%d%H%M%S")))}
    return df.select("*", manifest.feed_of(name).alias("feed"),
                     *[c.alias(n) for n, c in w.items()])


def feed_lines(blocks: DataFrame,
               batch: tuple[dt.datetime, dt.datetime] | None = None) -> DataFrame:
    """Archive blocks -> lines tagged with feed and window (tagged per block)."""
    tagged = tag_files(blocks, batch=batch)
    return archives.member_lines(tagged, keep=["path", "member", "feed", *WINDOW_COLUMNS])


def parse_feed(tagged: DataFrame, feed: str, quote: str = lines.DEFAULT_QUOTE) -> DataFrame:
    rows = tagged.filter((F.col("feed") == feed) & F.col("batch_seq").isNotNull())
    return lines.parse_lines(rows, FEED_SCHEMAS[feed], quote=quote, keep=["batch_seq"])


def process_windows(export_lines: DataFrame, mentions_lines: DataFrame, gkg_lines: DataFrame,
                    quote: str = lines.DEFAULT_QUOTE,
                    history: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(event_mentions, articles) rows, one per key, for all windows in the input.

    Inputs are tagged line DataFrames (``feed_lines``) of each feed.  Rows carry
    the ``batch_seq`` of their window.  ``history`` names the stored event_mentions
    table that late mentions are joined with.
    """
    export = parse_feed(export_lines, "export", quote)
    mentions = parse_feed(mentions_lines, "mentions", quote)
    gkg = parse_feed(gkg_lines, "gkg", quote)
    em = latest_with_history(export, mentions, history) if history else \
        prepare.latest_event_mentions(export, mentions, batch_col="batch_seq", keep_batch=True)
    art = prepare.latest_articles(gkg, batch_col="batch_seq", keep_batch=True)
    return em, art


def latest_with_history(export: DataFrame, mentions: DataFrame, path: str) -> DataFrame:
    """``latest_event_mentions`` of windows in order, late mentions included.

    A mention whose event is not in its window's export counts for the event as it is
    known from an earlier window, of this input or of the table at ``path`` (read
    through its key index).  An event no window has stored so far stays unknown.
    """
    spark = export.sparkSession
    rows = prepare.latest_event_mentions(export, mentions, batch_col="batch_seq",
                                         keep_batch=True)
    late_path = scratch_path(spark, "late-mentions")
    late = prepare.late_mentions(export, mentions, "batch_seq")
    late.write.parquet(late_path)
    late = spark.read.schema(late.schema).parquet(late_path)
    stored = serving.rows_of_keys(spark, late, path, "event_mentions")
    return prepare.with_history(rows, late, stored, "batch_seq")


def name_glob(mask: str, days: Sequence[dt.date] | None = None) -> str:
    """File-name pattern of one feed, narrowed to the days (or their months, or years).

    It only keeps the listing short: which files are taken is decided by their
    names' own times.
    """
    if days is None:
        return f"*{mask}*"
    for fmt in ("%Y%m%d", "%Y%m", "%Y"):
        prefixes = sorted({d.strftime(fmt) for d in days})
        if len(prefixes) <= 400:
            break
    return f"{{{','.join(prefixes)}}}*{mask}*"


def ingest_landing(spark: SparkSession, landing_dir: str, event_mentions_path: str,
                   articles_path: str, quote: str = lines.DEFAULT_QUOTE,
                   batch: tuple[dt.datetime, dt.datetime] | None = None,
                   names: DataFrame | None = None, windows: Sequence[int] | None = None,
                   days: Sequence[dt.date] | None = None,
                   history_join: bool = False,
                   files: Sequence[str] | None = None) -> dict[str, int]:
    """Read each feed's landed archives once (one task per archive) and upsert.

    Files are grouped into half-day windows by name (many windows, one job), or,
    with ``batch=(start, end)``, all treated as that one batch.  ``names`` (column
    ``file_name``) keeps listed files, ``windows`` those of these windows'
    ``batch_seq``; no list of files ever comes to the driver.  A caller that knows the
    paths of the archives gives them as ``files``, and no folder is listed.  With
    ``history_join`` mentions of events that earlier windows stored count too (windows
    in order).
    """
    tagged = {}
    name = F.substring_index("path", "/", -1)
    for feed, mask in manifest.FEED_CLASSES:
        found = (archives.landed(spark, landing_dir, name_glob(mask, days)) if files is None
                 else archives.named(spark, [f for f in files if mask in f.rsplit("/", 1)[-1]]))
        found = found.filter(manifest.feed_of(name) == feed)
        if windows is not None:
            key = F.substring_index(name, ".", 1)
            found = found.filter(window_of(manifest.file_key_to_ts(key))["batch_seq"]
                                 .isin(list(windows)))
        if names is not None:
            listed = names.select(F.col("file_name").alias("_name")).distinct()
            found = found.join(listed, name == F.col("_name"), "left_semi")
        tagged[feed] = feed_lines(archives.member_blocks(found), batch)
    em, art = process_windows(tagged["export"], tagged["mentions"], tagged["gkg"], quote,
                              event_mentions_path if history_join else None)
    return {
        "event_mentions": serving.upsert_serving(spark, em, event_mentions_path,
                                                 "event_mentions"),
        "articles": serving.upsert_serving(spark, art, articles_path, "articles"),
    }


def ingest_range(spark: SparkSession, landing_dir: str, manifest_paths: Sequence[str] | str,
                 start: dt.datetime, end: dt.datetime, event_mentions_path: str,
                 articles_path: str, quote: str = lines.DEFAULT_QUOTE,
                 one_batch: bool = False, history_join: bool = False) -> dict[str, int]:
    """Ingest the manifest's files of ``[start, end]`` in one job, window by window.

    With ``one_batch`` the whole range is one window.
    """
    entries = manifest.manifest_entries(manifest.read_manifest(spark, manifest_paths))
    names = manifest.selected_files(entries, start, end).select("file_name")
    days = [start.date() + dt.timedelta(days=i) for i in range((end - start).days + 2)]
    return ingest_landing(spark, landing_dir, event_mentions_path, articles_path, quote,
                          batch=(start, end) if one_batch else None, names=names, days=days,
                          history_join=history_join)


def process_window(spark: SparkSession, landing_dir: str, manifest_paths: Sequence[str] | str,
                   start: dt.datetime, end: dt.datetime, event_mentions_path: str,
                   articles_path: str, quote: str = lines.DEFAULT_QUOTE,
                   history_join: bool = False) -> dict[str, int]:
    """W3: ingest the files of ``[start, end]`` as one batch and upsert both tables.

    Rerunning a window, at any time, gives the same table: its rows carry the
    window's sequence, and rows of later windows stay.
    """
    return ingest_range(spark, landing_dir, manifest_paths, start, end, event_mentions_path,
                        articles_path, quote, one_batch=True, history_join=history_join)
