"""Command line: ingest windows, run the stream, run a query, compact tables.

    python -m newslens ingest --landing DIR --manifest FILE [--manifest FILE] \\
        --start 2024-01-05 --end 2024-01-07 --tables DIR [--one-job] [--history-join]
    python -m newslens stream --landing DIR --tables DIR --checkpoint DIR [--continuous]
        [--complete-windows]
    python -m newslens query themes_by_source --tables DIR --source msn.com \\
        --granularity month --limit 3
    python -m newslens calls --tables DIR [--day 1998-05-02 --country FR --source msn.com]
    python -m newslens compact --tables DIR [--min-files 8]

``ingest`` walks the half-day windows of the date range in order (a failed
window is reported and the walk goes on), or with ``--one-job`` ingests the
whole range as one Spark job with the same result.  Tables live under
``--tables`` as ``event_mentions/`` and ``articles/``.  The session comes from
``spark-submit``/defaults; nothing here sets cluster resources.
"""

from __future__ import annotations

import argparse
import datetime as dt
import inspect
import sys

from pyspark.sql import SparkSession

from newslens.plans import ingest
from newslens.plans import queries as Q
from newslens.sources import serving

QUERIES = {
    "articles_by_date_country_language": ("event_mentions", Q.articles_by_date_country_language),
    "most_mentioned_events": ("event_mentions", Q.most_mentioned_events),
    "all_by_source": ("articles", Q.all_by_source),
    "tone_and_count_by_source": ("articles", Q.tone_and_count_by_source),
    "themes_by_source": ("articles", Q.themes_by_source),
    "locations_by_source": ("articles", Q.locations_by_source),
    "persons_by_source": ("articles", Q.persons_by_source),
    "tone_and_count_by_countries": ("articles", Q.tone_and_count_by_countries),
    "themes_by_countries": ("articles", Q.themes_by_countries),
}


def _paths(tables: str) -> tuple[str, str]:
    base = tables.rstrip("/")
    return f"{base}/event_mentions", f"{base}/articles"


def cmd_ingest(spark: SparkSession, a: argparse.Namespace) -> int:
    em, art = _paths(a.tables)
    start = dt.date.fromisoformat(a.start)
    end = dt.date.fromisoformat(a.end)
    if a.one_job:
        lo = dt.datetime.combine(start, dt.time(0, 0))
        hi = dt.datetime.combine(end, dt.time(23, 59, 59))
        print(ingest.ingest_range(spark, a.landing, a.manifest, lo, hi, em, art, a.quote,
                                  history_join=a.history_join))
        return 0
    failed = 0
    day = start
    while day <= end:
        for s, e in ingest.HALF_DAYS:
            ws = dt.datetime.combine(day, dt.time()) + dt.timedelta(seconds=s)
            we = dt.datetime.combine(day, dt.time()) + dt.timedelta(seconds=e)
            try:
                n = ingest.process_window(spark, a.landing, a.manifest, ws, we, em, art, a.quote,
                                          a.history_join)
                print(f"{ws} .. {we}: {n}")
            except Exception as exc:  # one bad window does not stop the walk
                failed += 1
                print(f"{ws} .. {we}: FAILED {exc}", file=sys.stderr)
        day += dt.timedelta(days=1)
    return 1 if failed else 0


def cmd_stream(spark: SparkSession, a: argparse.Namespace) -> int:
    from newslens.streaming.ingest_stream import start_ingest_stream, start_window_stream

    em, art = _paths(a.tables)
    start = start_window_stream if a.complete_windows else start_ingest_stream
    start(spark, a.landing, em, art, a.checkpoint, available_now=not a.continuous,
          quote=a.quote).awaitTermination()
    return 0


def cmd_compact(spark: SparkSession, a: argparse.Namespace) -> int:
    em, art = _paths(a.tables)
    for path, table in ((em, "event_mentions"), (art, "articles")):
        n = serving.compact_serving(spark, path, table, a.min_files)
        print(f"{table}: {n} partitions rewritten")
    return 0


def cmd_calls(spark: SparkSession, a: argparse.Namespace) -> int:
    """Run and time the reference's 26 query calls (build + show, as it did)."""
    import time

    from newslens.plans.calls import reference_calls

    em, art = _paths(a.tables)
    kwargs = {}
    if a.day:
        kwargs["day"] = tuple(int(x) for x in a.day.split("-"))
    for opt in ("country", "source"):
        if getattr(a, opt):
            kwargs[opt] = getattr(a, opt)
    calls = reference_calls(serving.read_serving(spark, em, "event_mentions"),
                            serving.read_serving(spark, art, "articles"), **kwargs)
    for name, thunk in calls:
        t0 = time.perf_counter()
        thunk().show(a.show, truncate=False)
        print(f"{name}: {time.perf_counter() - t0:.3f} s")
    return 0


def cmd_query(spark: SparkSession, a: argparse.Namespace) -> int:
    table, fn = QUERIES[a.name]
    em, art = _paths(a.tables)
    df = serving.read_serving(spark, em if table == "event_mentions" else art, table)
    params = inspect.signature(fn).parameters
    kwargs = {k: v for k, v in vars(a).items() if k in params and v is not None}
    fn(df, **kwargs).show(a.show, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="newslens")
    sub = p.add_subparsers(dest="cmd", required=True)
    pi = sub.add_parser("ingest")
    pi.add_argument("--landing", required=True)
    pi.add_argument("--manifest", required=True, action="append")
    pi.add_argument("--start", required=True)
    pi.add_argument("--end", required=True)
    pi.add_argument("--tables", required=True)
    pi.add_argument("--one-job", action="store_true")
    pi.add_argument("--history-join", action="store_true",
                    help="late mentions count for events that earlier windows stored")
    pi.add_argument("--quote", default='"')
    ps = sub.add_parser("stream")
    ps.add_argument("--landing", required=True)
    ps.add_argument("--tables", required=True)
    ps.add_argument("--checkpoint", required=True)
    ps.add_argument("--continuous", action="store_true")
    ps.add_argument("--complete-windows", action="store_true",
                    help="let a half-day window wait until a later one has begun")
    ps.add_argument("--quote", default='"')
    pk = sub.add_parser("calls")
    pk.add_argument("--tables", required=True)
    pk.add_argument("--day", help="YYYY-MM-DD for Q1 (default: the reference's)")
    pk.add_argument("--country")
    pk.add_argument("--source")
    pk.add_argument("--show", type=int, default=20)
    pc = sub.add_parser("compact")
    pc.add_argument("--tables", required=True)
    pc.add_argument("--min-files", type=int, default=8)
    pq = sub.add_parser("query")
    pq.add_argument("name", choices=sorted(QUERIES))
    pq.add_argument("--tables", required=True)
    pq.add_argument("--show", type=int, default=20)
    for opt in ("source", "country", "country1", "country2", "language", "granularity"):
        pq.add_argument(f"--{opt}")
    for opt in ("year", "month", "day", "limit"):
        pq.add_argument(f"--{opt}", type=int)
    pq.add_argument("--symmetric", action="store_true", default=None)
    pq.add_argument("--exact", action="store_true", default=None)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"newslens-{a.cmd}").getOrCreate()
    commands = {"ingest": cmd_ingest, "stream": cmd_stream, "query": cmd_query,
                "calls": cmd_calls, "compact": cmd_compact}
    return commands[a.cmd](spark, a)


if __name__ == "__main__":
    sys.exit(main())
