"""Registered queries: name -> (Spark plan over the test tables, DuckDB oracle SQL).

Every registered query reads the provided tables in ``sf_dir`` (through the
fixture feeds that Spark derives from them) and runs over all of their rows.
Parameters are the reference's call parameters where the fixture data has
matching rows (see ``FIXTURES.md``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions import fields as X
from newslens.operators import prepare
from newslens.operators.period import top_k_per_group
from newslens.plans import oracle
from newslens.plans import queries as Q
from newslens.schemas import EXPORT_SCHEMA, GKG_SCHEMA, MENTIONS_SCHEMA
from newslens.plans import ingest, intervals
from newslens.sources import archives, manifest, serving
from newslens.sources.fixtures import (HISTORY_SPLITS, LINE_FIXTURES, ROWS_PER_ARCHIVE,
                                       TWO_WINDOW_SPLITS, TWO_WINDOW_STARTS, fixture,
                                       window_lines, write_archives)
from newslens.sources.lines import parse_lines
from newslens.session import scratch_path
from newslens.streaming.ingest_stream import start_ingest_stream, start_window_stream

QueryFn = Callable[[SparkSession, str], DataFrame]

GRANULARITIES = ("year", "month", "day")

# Query parameters (fixture data has rows for each).
Q1_ARGS = (1998, 5, 2, "FR")
Q1_LANGUAGE = "eng"
Q2_COUNTRY = "FR"
Q3_SOURCE = "msn.com"
Q31_LIMIT = 100
Q33_K = Q34_K = 3
Q35_K = 10
Q4_PAIR = ("France", "United States")
Q42_K = 3
DEEP_K = 1500
# Small files, so that these tables' months have several.
CLUSTERED_FILE_ROWS = 500
Q42_SUBSTRING_PAIR = ("Niger", "France")
Q42_HYPHEN_PAIR = ("Guinea", "France")


# --- serving tables built from the fixture feeds ------------------------------
def serving_event_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.latest_event_mentions(fixture(spark, sf_dir, "raw_export"),
                                         fixture(spark, sf_dir, "raw_mentions"))


def serving_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.latest_articles(fixture(spark, sf_dir, "raw_gkg"))


SERVING_TABLES = {"event_mentions": serving_event_mentions, "articles": serving_articles}


def stored(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The serving table over ``sf_dir`` as a query finds it: written, then read (S10).

    Written once per application and folder, below the shared checkpoint folder.
    """
    place = f"newslens.stored.{table}.{spark.sparkContext.applicationId}.{sf_dir}"
    path = spark.conf.get(place, None)
    if path is None or not serving.Staging(spark, path).exists(path):
        path = scratch_path(spark, f"stored-{table}")
        serving.write_serving(SERVING_TABLES[table](spark, sf_dir), path, table)
        spark.conf.set(place, path)
    return serving.read_serving(spark, path, table)


def _clustered(table: str, fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    """A query over the table after its files were laid along the curve (S10)."""
    def run(spark, sf_dir):
        path = scratch_path(spark, f"clustered-{table}")
        serving.write_serving(SERVING_TABLES[table](spark, sf_dir), path, table)
        serving.compact_serving(spark, path, table, min_files=1, file_rows=CLUSTERED_FILE_ROWS)
        return fn(serving.read_serving(spark, path, table))
    return run


def _q42_by_names(pair: tuple[str, str]) -> QueryFn:
    """Q4.2 by substring, the names looked up in the index of a clustered table."""
    def run(spark, sf_dir):
        path = scratch_path(spark, "named-articles")
        serving.write_serving(serving_articles(spark, sf_dir), path, "articles")
        serving.keep_names(spark, path, "articles")
        return Q.themes_by_countries(serving.read_serving(spark, path, "articles"), *pair, "year",
                                     Q42_K, names=serving.read_names(spark, path))
    return run


def _on_events(fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    return lambda spark, sf_dir: fn(stored(spark, sf_dir, "event_mentions"))


def _on_articles(fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    return lambda spark, sf_dir: fn(stored(spark, sf_dir, "articles"))


# --- pipeline steps -------------------------------------------------------------
def _join_events_mentions(spark, sf_dir, split_hot=False):
    return prepare.join_events_mentions(fixture(spark, sf_dir, "raw_export"),
                                        fixture(spark, sf_dir, "raw_mentions"), split_hot)


def _event_mentions(spark, sf_dir):
    return prepare.event_mentions(fixture(spark, sf_dir, "raw_export"),
                                  fixture(spark, sf_dir, "raw_mentions"))


def _articles(spark, sf_dir):
    return prepare.articles(fixture(spark, sf_dir, "raw_gkg"))


def _event_date_parts(spark, sf_dir, export="raw_export"):
    parts = X.event_date_parts("Day")
    return fixture(spark, sf_dir, export).select(
        "GlobalEventID", "Day", *[c.alias(n) for n, c in parts.items()])


def _article_date_parts(spark, sf_dir):
    parts = X.article_date_parts("DATE")
    return fixture(spark, sf_dir, "raw_gkg").select(
        "GKGRECORDID", "DATE", *[c.alias(n) for n, c in parts.items()])


def _source_language(spark, sf_dir):
    return fixture(spark, sf_dir, "raw_mentions").select(
        "GlobalEventID", "MentionIdentifier", "MentionDocTranslationInfo",
        X.source_language("MentionDocTranslationInfo").alias("source_language"))


def _blank_to_null(spark, sf_dir):
    return X.blank_to_null(fixture(spark, sf_dir, "raw_export"))


def _first_tone(spark, sf_dir, gkg="raw_gkg"):
    return fixture(spark, sf_dir, gkg).select(
        "GKGRECORDID", "V2Tone", X.first_tone("V2Tone").alias("event_tone"))


def _first_theme(spark, sf_dir):
    return fixture(spark, sf_dir, "raw_gkg").select(
        "GKGRECORDID", "V2Counts", X.first_theme("V2Counts").alias("event_themes"))


def _location_countries(spark, sf_dir):
    c = fixture(spark, sf_dir, "raw_gkg").withColumn(
        "c", X.location_countries("Locations"))
    return c.select("GKGRECORDID", "Locations",
                    F.array_join("c", "|").alias("country_list"),
                    F.array_size("c").alias("country_count"))


def _article_countries(spark, sf_dir):
    c = fixture(spark, sf_dir, "raw_gkg").withColumn(
        "c", X.location_countries("Locations"))
    return c.select("GKGRECORDID", F.get("c", F.lit(0)).alias("first_country"),
                    F.get("c", F.lit(1)).alias("second_country"))


def _parse(feed_lines: str, schema) -> QueryFn:
    def run(spark, sf_dir):
        return X.blank_to_null(parse_lines(fixture(spark, sf_dir, feed_lines), schema))
    return run


def _latest_odd(table: str) -> QueryFn:
    """The whole preparation over feeds with malformed and null dates and tones."""
    def run(spark, sf_dir):
        if table == "articles":
            return prepare.latest_articles(fixture(spark, sf_dir, "odd_gkg"))
        return prepare.latest_event_mentions(fixture(spark, sf_dir, "odd_export"),
                                             fixture(spark, sf_dir, "raw_mentions"))
    return run


# --- manifest and windows --------------------------------------------------------
MANIFEST_WINDOW = (dt.datetime(2024, 1, 5, 0, 0, 0), dt.datetime(2024, 1, 5, 11, 45, 0),
                   "export.CSV.zip")
FILES_PER_WINDOW_DAYS = (dt.date(2024, 1, 5), dt.date(2024, 1, 7))
# First and last start, hours, hours between starts.
SLIDING_FILES = ("2024-01-04 06:00:00", "2024-01-09 00:00:00", 36, 6)
SLIDING_MENTIONS = (168, 24)
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _entries(spark, sf_dir):
    return manifest.manifest_entries(fixture(spark, sf_dir, "raw_manifest"))


def _manifest_window(spark, sf_dir):
    w = manifest.manifest_window(_entries(spark, sf_dir), *MANIFEST_WINDOW)
    return w.select("url", "file_name", "file_key",
                    F.date_format("file_ts", TS_TEXT).alias("file_time"))


def _manifest_by_feed(spark, sf_dir):
    return manifest.manifest_by_feed(_entries(spark, sf_dir))


def _window_text(df):
    return df.select(F.date_format("window_start", TS_TEXT).alias("window_start"),
                     F.date_format("window_end", TS_TEXT).alias("window_end"),
                     *[c for c in df.columns if c not in ("window_start", "window_end")])


def _ingest_windows(spark, sf_dir):
    return _window_text(ingest.windows_from_entries(_entries(spark, sf_dir)))


def _files_per_window(spark, sf_dir):
    windows = ingest.half_day_windows(spark, *FILES_PER_WINDOW_DAYS)
    return _window_text(ingest.files_per_window(_entries(spark, sf_dir), windows))


def _sliding(spark, first, last, hours: int, every: int) -> DataFrame:
    return intervals.sliding_windows(spark, first, last, dt.timedelta(hours=hours),
                                     dt.timedelta(hours=every))


def _files_per_any_window(spark, sf_dir):
    first, last, *hours = SLIDING_FILES
    windows = _sliding(spark, dt.datetime.fromisoformat(first), dt.datetime.fromisoformat(last),
                       *hours)
    return _window_text(intervals.files_per_any_window(_entries(spark, sf_dir), windows))


def _mentions_per_any_window(spark, sf_dir):
    """All mentions in weeks that start on each day from the first to the last mention."""
    timed = fixture(spark, sf_dir, "raw_mentions").select(
        manifest.file_key_to_ts(F.col("MentionTimeDate").cast("string")).alias("t"))
    lo, hi = timed.agg(F.to_date(F.min("t")), F.to_date(F.max("t"))).first()
    midnight = dt.time()
    windows = _sliding(spark, dt.datetime.combine(lo, midnight), dt.datetime.combine(hi, midnight),
                       *SLIDING_MENTIONS)
    return _window_text(intervals.counts_in_windows(
        timed, windows, "t", {"mention_count": F.count("*")}))


# --- two windows, upserted one after the other into written tables ---------------
def _batch(spark, sf_dir, table: str, b: int, export: str = "raw_export") -> DataFrame:
    pred = TWO_WINDOW_SPLITS[b]
    if table == "event_mentions":
        rows = prepare.latest_event_mentions(
            fixture(spark, sf_dir, export).filter(F.expr(pred["raw_export"])),
            fixture(spark, sf_dir, "raw_mentions").filter(F.expr(pred["raw_mentions"])))
    else:
        rows = prepare.latest_articles(
            fixture(spark, sf_dir, "raw_gkg").filter(F.expr(pred["raw_gkg"])))
    return rows.withColumn(serving.BATCH_SEQ, F.lit(b).cast("long"))


def _two_window(table: str, order: tuple = (1, 2), later_export: str = "raw_export") -> QueryFn:
    """Batches applied in ``order``; all but the first export from ``later_export``."""
    def run(spark, sf_dir):
        path = scratch_path(spark, f"two-window-{table}")
        for b in order:
            export = "raw_export" if b == min(order) else later_export
            serving.upsert_serving(spark, _batch(spark, sf_dir, table, b, export), path, table)
        return serving.read_serving(spark, path, table)
    return run


def _totals(table: str, rollup: str, fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    """A query over totals that three upserts have kept: two windows, the first one again.

    The tables are written once per application and folder.
    """
    def run(spark, sf_dir):
        place = f"newslens.totals.{table}.{spark.sparkContext.applicationId}.{sf_dir}"
        path = spark.conf.get(place, None)
        if path is None or not serving.Staging(spark, path).exists(path):
            path = scratch_path(spark, f"totals-{table}")
            serving.upsert_serving(spark, _batch(spark, sf_dir, table, 1), path, table)
            serving.keep_totals(spark, path, table)
            for b in (2, 1):
                serving.upsert_serving(spark, _batch(spark, sf_dir, table, b), path, table)
            spark.conf.set(place, path)
        return fn(serving.read_totals(spark, path, table, rollup))
    return run


def _history_join(runs: tuple) -> QueryFn:
    """W3 with late mentions: each run ingests some of the three windows in one job."""
    def run(spark, sf_dir):
        path = scratch_path(spark, "history-join")
        for windows in runs:
            export, mentions = (reduce(DataFrame.unionByName, [
                fixture(spark, sf_dir, raw).filter(F.expr(HISTORY_SPLITS[b][raw])).withColumn(
                    serving.BATCH_SEQ, F.lit(b).cast("long")) for b in windows])
                for raw in ("raw_export", "raw_mentions"))
            rows = ingest.latest_with_history(export, mentions, path)
            serving.upsert_serving(spark, rows, path, "event_mentions")
        return serving.read_serving(spark, path, "event_mentions")
    return run


def _land(spark, sf_dir, landing: str, window: int, feeds=tuple(LINE_FIXTURES)) -> None:
    for feed in feeds:
        write_archives(window_lines(spark, sf_dir, feed, window, ROWS_PER_ARCHIVE), landing,
                       TWO_WINDOW_STARTS[window], LINE_FIXTURES[feed][2],
                       rows_per_file=None).collect()


def _landing(spark, sf_dir) -> str:
    """Landing directory with the two windows of all three feeds as zip archives."""
    landing = scratch_path(spark, "landing")
    for b in TWO_WINDOW_STARTS:
        _land(spark, sf_dir, landing, b)
    return landing


def _close_windows(spark, landing: str) -> None:
    """An empty file of a later window: everything before it is closed."""
    write_archives(spark.range(1).select(F.lit("").alias("value")), landing,
                   CLOSING_START, LINE_FIXTURES["gkg"][2]).collect()


def _stream(table: str) -> QueryFn:
    """W4: three runs, the files out of order and in triggers of one or two files.

    The first run sees mentions only, the second the later window, the third the
    earlier window's files, long after.
    """
    def run(spark, sf_dir):
        landing = scratch_path(spark, "stream-landing")
        paths = [scratch_path(spark, f"stream-{t}") for t in ("event_mentions", "articles")]
        checkpoint = scratch_path(spark, "stream-checkpoint")
        for window, feeds in ((2, ("mentions",)), (2, ("gkg", "export")),
                              (1, ("gkg", "mentions", "export"))):
            _land(spark, sf_dir, landing, window, feeds)
            start_ingest_stream(spark, landing, *paths, checkpoint,
                                files_per_trigger=2).awaitTermination()
        return serving.read_serving(spark, paths[table == "articles"], table)
    return run


def _window_stream(spark, sf_dir):
    """W4, closed windows only: the earlier window's export comes after it was ingested."""
    landing = scratch_path(spark, "wstream-landing")
    em_path, art_path = (scratch_path(spark, "wstream-event_mentions"),
                         scratch_path(spark, "wstream-articles"))
    checkpoint = scratch_path(spark, "wstream-checkpoint")

    def turn():
        start_window_stream(spark, landing, em_path, art_path, checkpoint,
                            available_now=True).awaitTermination()

    _land(spark, sf_dir, landing, 1, ("mentions", "gkg"))
    _land(spark, sf_dir, landing, 2)
    turn()
    _land(spark, sf_dir, landing, 1, ("export",))
    _close_windows(spark, landing)
    turn()
    return serving.read_serving(spark, em_path, "event_mentions")


def _manifest_of(spark, landing: str) -> str:
    path = f"{landing}-manifest"
    archives.landed(spark, landing).select(
        F.concat(F.lit("100 - http://feed.example/v2/"),
                 F.substring_index("path", "/", -1)).alias("value")).write.text(path)
    return path


def _process_window_files(table: str, then_empty: bool = False) -> QueryFn:
    """W3 from files: manifest -> window's archives -> parse -> upsert, per window.

    With ``then_empty`` a window without files follows, which must change nothing.
    """
    def run(spark, sf_dir):
        landing = _landing(spark, sf_dir)
        manifest_path = _manifest_of(spark, landing)
        paths = [scratch_path(spark, f"w3-{t}") for t in ("event_mentions", "articles")]
        starts = [dt.datetime.fromisoformat(s) for s in TWO_WINDOW_STARTS.values()]
        for ws in starts + [EMPTY_WINDOW] * then_empty:
            ingest.process_window(spark, landing, manifest_path, ws,
                                  ws + dt.timedelta(hours=11, minutes=45), *paths)
        return serving.read_serving(spark, paths[table == "articles"], table)
    return run


CLOSING_START = "1996-01-01 00:15:00"
EMPTY_WINDOW = dt.datetime(2023, 12, 31)


def _serving_schema(spark, sf_dir):
    """K3: the upserted rows through the partitioned serving sink and back."""
    path = scratch_path(spark, "serving-event_mentions")
    serving.write_serving(serving_event_mentions(spark, sf_dir), path, "event_mentions")
    return serving.read_serving(spark, path, "event_mentions")


def _archive_round_trip(feed: str) -> QueryFn:
    def run(spark, sf_dir):
        raw, lines_name, suffix = LINE_FIXTURES[feed]
        out = scratch_path(spark, f"archives-{feed}")
        write_archives(fixture(spark, sf_dir, lines_name), out, "2024-01-01 00:00:00", suffix,
                       rows_per_file=4_000).collect()
        got = archives.archive_lines(spark, out)
        return got.filter(F.col("value") != "").select("value")
    return run


# --- registry -------------------------------------------------------------------
def _registry() -> dict[str, tuple[QueryFn, str | None]]:
    reg: dict[str, tuple[QueryFn, str | None]] = {
        "join_events_mentions": (_join_events_mentions, oracle.join_events_mentions()),
        "join_events_mentions_split": (partial(_join_events_mentions, split_hot=True),
                                       oracle.join_events_mentions()),
        "event_date_parts": (_event_date_parts, oracle.event_date_parts()),
        "article_date_parts": (_article_date_parts, oracle.article_date_parts()),
        "source_language": (_source_language, oracle.source_language()),
        "blank_to_null": (_blank_to_null, oracle.blank_to_null()),
        "first_tone": (_first_tone, oracle.first_tone()),
        "first_theme": (_first_theme, oracle.first_theme()),
        "location_countries": (_location_countries, oracle.location_countries()),
        "article_countries": (_article_countries, oracle.article_countries()),
        "event_mentions": (_event_mentions, oracle.event_mentions()),
        "upsert_event_mentions": (serving_event_mentions, oracle.upsert_event_mentions()),
        "articles": (_articles, oracle.articles()),
        "upsert_articles": (serving_articles, oracle.upsert_articles()),
        "parse_export": (_parse("raw_export_lines", EXPORT_SCHEMA),
                         oracle.parse_feed("raw_export", EXPORT_SCHEMA)),
        "parse_mentions": (_parse("raw_mentions_lines", MENTIONS_SCHEMA),
                           oracle.parse_feed("raw_mentions", MENTIONS_SCHEMA)),
        "parse_gkg": (_parse("raw_gkg_lines", GKG_SCHEMA),
                      oracle.parse_feed("raw_gkg", GKG_SCHEMA)),
        "event_date_parts_odd": (partial(_event_date_parts, export="odd_export"),
                                 oracle.event_date_parts("odd_export")),
        "first_tone_odd": (partial(_first_tone, gkg="odd_gkg"), oracle.first_tone("odd_gkg")),
        "upsert_event_mentions_odd": (_latest_odd("event_mentions"),
                                      oracle.upsert_event_mentions("odd_export")),
        "upsert_articles_odd": (_latest_odd("articles"), oracle.upsert_articles("odd_gkg")),
        "q2_all_null_period": (
            lambda spark, sf_dir: Q.most_mentioned_events(
                _latest_odd("event_mentions")(spark, sf_dir), Q2_COUNTRY, "month"),
            oracle.q2(Q2_COUNTRY, "month", "odd_export")),
        "q1_one_language": (
            _on_events(partial(_q1, language=Q1_LANGUAGE)),
            oracle.q1(*Q1_ARGS, Q1_LANGUAGE)),
        "q1_all_languages": (_on_events(partial(_q1, language=None)),
                             oracle.q1(*Q1_ARGS, None)),
    }
    for g in GRANULARITIES:
        reg[f"q2_{g}"] = (_on_events(partial(Q.most_mentioned_events, country=Q2_COUNTRY,
                                             granularity=g)), oracle.q2(Q2_COUNTRY, g))
        reg[f"q31_{g}"] = (_on_articles(partial(Q.all_by_source, source=Q3_SOURCE,
                                                granularity=g, limit=Q31_LIMIT)),
                           oracle.q31(Q3_SOURCE, g, Q31_LIMIT))
        reg[f"q32_{g}"] = (_on_articles(partial(Q.tone_and_count_by_source, source=Q3_SOURCE,
                                                granularity=g)), oracle.q32(Q3_SOURCE, g))
        reg[f"q33_{g}"] = (_on_articles(partial(Q.themes_by_source, source=Q3_SOURCE,
                                                granularity=g, limit=Q33_K)),
                           oracle.q33(Q3_SOURCE, g, Q33_K))
        reg[f"q34_{g}"] = (_on_articles(partial(Q.locations_by_source, source=Q3_SOURCE,
                                                granularity=g, limit=Q34_K)),
                           oracle.q34(Q3_SOURCE, g, Q34_K))
        reg[f"q35_{g}"] = (_on_articles(partial(Q.persons_by_source, source=Q3_SOURCE,
                                                granularity=g, limit=Q35_K)),
                           oracle.q35(Q3_SOURCE, g, Q35_K))
        reg[f"q41_{g}"] = (_on_articles(partial(Q.tone_and_count_by_countries,
                                                country1=Q4_PAIR[0], country2=Q4_PAIR[1],
                                                granularity=g)),
                           oracle.q41(*Q4_PAIR, g))
        reg[f"q42_{g}"] = (_on_articles(partial(Q.themes_by_countries, country1=Q4_PAIR[0],
                                                country2=Q4_PAIR[1], granularity=g,
                                                limit=Q42_K)),
                           oracle.q42(*Q4_PAIR, g, Q42_K))
    # The reference's own k for the calls that differ from the keys above.
    for key, fn, osql, dim_k in (
            ("q33_day_k1", Q.themes_by_source, oracle.q33, ("day", 1)),
            ("q34_day_k1", Q.locations_by_source, oracle.q34, ("day", 1)),
            ("q35_month_k3", Q.persons_by_source, oracle.q35, ("month", 3)),
            ("q35_day_k1", Q.persons_by_source, oracle.q35, ("day", 1))):
        g, k = dim_k
        reg[key] = (_on_articles(partial(fn, source=Q3_SOURCE, granularity=g, limit=k)),
                    osql(Q3_SOURCE, g, k))
    # The same answers from clustered files.
    reg["q1_clustered"] = (_clustered("event_mentions", partial(_q1, language=None)),
                           oracle.q1(*Q1_ARGS, None))
    reg["q33_clustered"] = (_clustered("articles", partial(
        Q.themes_by_source, source=Q3_SOURCE, granularity="month", limit=Q33_K)),
        oracle.q33(Q3_SOURCE, "month", Q33_K))
    reg["q41_clustered"] = (_clustered("articles", partial(
        Q.tone_and_count_by_countries, country1=Q4_PAIR[0], country2=Q4_PAIR[1],
        granularity="month")), oracle.q41(*Q4_PAIR, "month"))
    reg["compacted_articles"] = (_clustered("articles", lambda rows: rows),
                                 oracle.upsert_articles())
    reg["top_k_deep"] = (_on_articles(_deep_top), oracle.deep_top(DEEP_K))
    reg["manifest_window"] = (_manifest_window, oracle.manifest_window(
        "2024-01-05 00:00:00", "2024-01-05 11:45:00", MANIFEST_WINDOW[2]))
    reg["manifest_by_feed"] = (_manifest_by_feed, oracle.manifest_by_feed())
    reg["ingest_windows"] = (_ingest_windows, oracle.ingest_windows())
    reg["files_per_window"] = (_files_per_window, oracle.files_per_window(
        *[d.isoformat() for d in FILES_PER_WINDOW_DAYS]))
    reg["files_per_any_window"] = (_files_per_any_window,
                                   oracle.files_per_any_window(*SLIDING_FILES))
    reg["mentions_per_any_window"] = (_mentions_per_any_window,
                                      oracle.mentions_per_any_window(*SLIDING_MENTIONS))
    reg["two_window_upsert"] = (_two_window("event_mentions"),
                                oracle.two_window_event_mentions(TWO_WINDOW_SPLITS))
    reg["two_window_upsert_articles"] = (_two_window("articles"),
                                         oracle.two_window_articles(TWO_WINDOW_SPLITS))
    reg["stream_upsert"] = (_stream("event_mentions"),
                            oracle.two_window_event_mentions(TWO_WINDOW_SPLITS))
    reg["stream_upsert_articles"] = (_stream("articles"),
                                     oracle.two_window_articles(TWO_WINDOW_SPLITS))
    reg["window_stream_upsert"] = (_window_stream,
                                   oracle.two_window_event_mentions(TWO_WINDOW_SPLITS))
    reg["upsert_moved_key"] = (
        _two_window("event_mentions", later_export="moved_export"),
        oracle.two_window_event_mentions(TWO_WINDOW_SPLITS, "moved_export"))
    reg["upsert_replay_older_window"] = (
        _two_window("event_mentions", order=(1, 2, 1)),
        oracle.two_window_event_mentions(TWO_WINDOW_SPLITS))
    reg["upsert_replay_older_window_articles"] = (
        _two_window("articles", order=(2, 1)), oracle.two_window_articles(TWO_WINDOW_SPLITS))
    # The same questions asked of totals kept up to date by upserts.
    pair = {"country1": Q4_PAIR[0], "country2": Q4_PAIR[1]}
    for key, rollup, fn, args, sql in (
            ("q32_totals", "sources", Q.tone_and_count_by_source, {"source": Q3_SOURCE},
             oracle.q32(Q3_SOURCE, "month")),
            ("q33_totals", "source_themes", Q.themes_by_source,
             {"source": Q3_SOURCE, "limit": Q33_K}, oracle.q33(Q3_SOURCE, "month", Q33_K)),
            ("q34_totals", "source_countries", Q.locations_by_source,
             {"source": Q3_SOURCE, "limit": Q34_K}, oracle.q34(Q3_SOURCE, "month", Q34_K)),
            ("q35_totals", "source_persons", Q.persons_by_source,
             {"source": Q3_SOURCE, "limit": Q35_K}, oracle.q35(Q3_SOURCE, "month", Q35_K)),
            ("q41_totals", "pair_themes", Q.tone_and_count_by_countries, pair,
             oracle.q41(*Q4_PAIR, "month")),
            ("q42_totals", "pair_themes", Q.themes_by_countries, {**pair, "limit": Q42_K},
             oracle.q42(*Q4_PAIR, "month", Q42_K))):
        reg[key] = (_totals("articles", rollup, partial(fn, granularity="month", **args)),
                    oracle.on_two_windows(sql, TWO_WINDOW_SPLITS))
    history = oracle.history_join(HISTORY_SPLITS)
    reg["history_join"] = (_history_join(((1,), (2,), (3,), (3,))), history)
    reg["history_join_one_job"] = (_history_join(((1,), (2, 3))), history)
    reg["process_window"] = (_process_window_files("event_mentions"),
                             oracle.two_window_event_mentions(TWO_WINDOW_SPLITS))
    reg["process_window_articles"] = (_process_window_files("articles"),
                                      oracle.two_window_articles(TWO_WINDOW_SPLITS))
    reg["empty_feed"] = (_process_window_files("event_mentions", then_empty=True),
                         oracle.two_window_event_mentions(TWO_WINDOW_SPLITS))
    reg["serving_schema"] = (_serving_schema, oracle.upsert_event_mentions())
    reg["archive_lines"] = (_archive_round_trip("export"),
                            oracle.lines_of("raw_export_lines"))
    reg["decode_fallback"] = (_archive_round_trip("gkg"), oracle.lines_of("raw_gkg_lines"))
    reg["q42_substring"] = (
        _on_articles(partial(Q.themes_by_countries, country1=Q42_SUBSTRING_PAIR[0],
                             country2=Q42_SUBSTRING_PAIR[1], granularity="year",
                             limit=Q42_K)),
        oracle.q42(*Q42_SUBSTRING_PAIR, "year", Q42_K))
    reg["q42_substring_hyphen"] = (
        _on_articles(partial(Q.themes_by_countries, country1=Q42_HYPHEN_PAIR[0],
                             country2=Q42_HYPHEN_PAIR[1], granularity="year", limit=Q42_K)),
        oracle.q42(*Q42_HYPHEN_PAIR, "year", Q42_K))
    for key, named in (("q42_substring_names", Q42_SUBSTRING_PAIR),
                       ("q42_hyphen_names", Q42_HYPHEN_PAIR)):
        reg[key] = (_q42_by_names(named), oracle.q42(*named, "year", Q42_K))
    lo, hi = Q4_PAIR
    for key, (a, b), symmetric in (("q41_swapped", (hi, lo), False),
                                   ("q41_symmetric", (hi, lo), True),
                                   ("q41_equal_pair", (lo, lo), False)):
        reg[key] = (_on_articles(partial(Q.tone_and_count_by_countries, country1=a, country2=b,
                                         granularity="month", symmetric=symmetric)),
                    oracle.q41(*sorted((a, b)) if symmetric else (a, b), "month"))
    # A single country and no second one: the pair's text is that country alone.
    reg["q42_null_member"] = (
        _on_articles(partial(Q.themes_by_countries, country1=lo, country2=lo,
                             granularity="month", limit=20)),
        oracle.q42(lo, lo, "month", 20))
    return reg


def _deep_top(articles: DataFrame) -> DataFrame:
    """N2 / O3 beyond Spark's own group limit: the best-toned articles of each year."""
    return top_k_per_group(
        articles.select("event_year", "event_tone", "global_event_id"), ["event_year"],
        [F.desc_nulls_last("event_tone"), F.asc_nulls_last("global_event_id")], DEEP_K,
        "event_tone")


def _q1(em: DataFrame, language: str | None) -> DataFrame:
    return Q.articles_by_date_country_language(em, *Q1_ARGS, language=language)


def registered_queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in _registry().items()}


def registered_oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _registry().items() if sql is not None}
