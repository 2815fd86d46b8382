"""W4: the window ingest as a Structured Streaming job.

A ``binaryFile`` stream over the landing directory sees new archives by name
alone.  A micro-batch yields the set of half-day windows that its files belong
to; all landed files of these windows are read again, as the batch path does,
and upserted under the windows' sequence.  So the tables end up the same however
files are dealt to triggers: in any order, a window spread over many of them, or
a file long after its window.  ``start_window_stream`` holds windows back until they
are closed, in keyed state with timers in event time.

Fault tolerance: progress lives in the checkpoint location on shared storage; a
replayed micro-batch re-applies the same keyed upsert, which changes nothing the
second time.

A stream's own session has adaptive execution off, and without it rebalancing is
ignored: each of a shuffle's tasks would write a file to every month.  So the windows
are read and upserted in the session that started the stream.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newslens.plans import ingest
from newslens.session import release
from newslens.sources import lines, manifest

# The fixed schema of Spark's ``binaryFile`` source (streams must state it).
BINARY_FILE_SCHEMA = ("path string, modificationTime timestamp, length bigint, "
                      "content binary")
#: Days of event time that a window's state outlives the window: some 15 KB a window.
RETAIN_DAYS = 90
#: Closed windows that one job ingests: about 9,000 archive paths on the driver at a time.
WINDOWS_PER_JOB = 64
#: Triggers after which the driver gives back what they left (an upsert does so by itself).
RELEASE_EVERY = 50


def window_counts(paths: DataFrame) -> DataFrame:
    """(batch_seq, files) of the windows that named archives belong to."""
    tagged = ingest.tag_files(paths.select("path"))
    return (tagged.filter(F.col("batch_seq").isNotNull() & F.col("feed").isNotNull())
            .groupBy("batch_seq").agg(F.count("*").alias("files")))


def _days_of(windows: list[int]) -> list[dt.date]:
    return [dt.datetime.strptime(str(w), "%Y%m%d%H%M%S").date() for w in windows]


def _with_time(files: DataFrame) -> set[tuple[str, int]]:
    """(path, modification time) of some archives."""
    rows = files.select("path", F.unix_micros("modificationTime").alias("at")).collect()
    return {(r.path, r.at) for r in rows}


def _landed_of(spark: SparkSession, landing_dir: str, windows: list[int]) -> set[tuple[str, int]]:
    """The landed archives of some windows, from a listing of names."""
    names = (spark.read.format("binaryFile")
             .option("pathGlobFilter", ingest.name_glob(".zip", _days_of(windows)))
             .load(landing_dir).select("path", "modificationTime"))
    return _with_time(ingest.tag_files(names).filter(
        F.col("batch_seq").isin(windows) & F.col("feed").isNotNull()))


def _ingest_windows(spark: SparkSession, landing_dir: str, windows: list[int],
                    event_mentions_path: str, articles_path: str, quote: str,
                    files: list[str] | None = None) -> None:
    if windows:
        ingest.ingest_landing(spark, landing_dir, event_mentions_path, articles_path, quote,
                              windows=windows, days=_days_of(windows), files=files)


def _start(spark: SparkSession, landing_dir: str, checkpoint_location: str, on_batch,
           available_now: bool, processing_time: str, files_per_trigger: int | None,
           step=lambda paths: paths) -> StreamingQuery:
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", "*.zip"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    names = reader.load(landing_dir).select("path", "modificationTime")
    writer = (step(names).writeStream.foreachBatch(on_batch)
              .outputMode("update").option("checkpointLocation", checkpoint_location))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()


def start_ingest_stream(spark: SparkSession, landing_dir: str, event_mentions_path: str,
                        articles_path: str, checkpoint_location: str,
                        available_now: bool = True, processing_time: str = "5 minutes",
                        quote: str = lines.DEFAULT_QUOTE,
                        files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops after the files present now.

    A window is brought up to date whenever a file of it arrives.
    ``files_per_trigger`` only paces the stream; the tables do not depend on it.  With it
    a window's files come in several triggers, and the first one reads all that have
    landed.  The driver keeps the names of those whose trigger is still to come, for as
    long as this query runs; a trigger with no other files has nothing to do.
    """
    ahead: set[tuple[str, int]] = set()

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        files = batch
        if epoch_id % RELEASE_EVERY == RELEASE_EVERY - 1:
            release(spark)
        if files_per_trigger:
            dealt = _with_time(batch)
            known = dealt & ahead
            ahead.difference_update(known)
            if len(dealt) < files_per_trigger:
                # Caught up: what is left had its trigger earlier.
                ahead.clear()
            if known == dealt:
                return
            files = batch.filter(~F.col("path").isin([path for path, _ in known]))
        # Windows, not files: two a day of the time that the trigger covers.
        touched = [r.batch_seq for r in window_counts(files).select("batch_seq").collect()]
        # Listed before they are read: a file that lands meanwhile has its own trigger.
        landed = (_landed_of(spark, landing_dir, touched) - dealt
                  if files_per_trigger and touched else set())
        _ingest_windows(spark, landing_dir, touched, event_mentions_path, articles_path, quote)
        ahead.update(landed)

    return _start(spark, landing_dir, checkpoint_location, on_batch, available_now,
                  processing_time, files_per_trigger)


def _window_state(retain_ms: int):
    """The state step of one window, built in a local scope so it is shipped by value.

    State: the paths landed so far, and whether the window has been handed on.  A timer
    at the start of the next window hands the window on; a file that comes after that
    hands on all of the window's files again; a second timer, ``retain_ms`` later, drops
    the state.  A window without state that is older than that may have had one, so it
    is handed on as not ``known``: its files have to be looked up by name.
    """
    def step(key, batches, state):
        import datetime as dt

        import pandas as pd

        start = dt.datetime.strptime(str(key[0]), "%Y%m%d%H%M%S").replace(tzinfo=dt.UTC)
        # Fires once the watermark has reached the start of the next window.
        closes = int((start + dt.timedelta(hours=12)).timestamp()) * 1000 - 1
        forgets = closes + retain_ms
        now = state.getCurrentWatermarkMs()
        paths, done = (list(state.get[0]), state.get[1]) if state.exists else ([], False)
        landed = {p for b in batches for p in b["path"] if p is not None}
        fresh = not done or not landed <= set(paths)
        paths = sorted(landed | set(paths))
        hand_on = fresh and now >= closes
        known = state.exists or now < forgets
        if now < closes:
            if paths:
                state.update((paths, False))
                state.setTimeoutTimestamp(closes)
        elif now < forgets:
            state.update((paths, True))
            state.setTimeoutTimestamp(forgets)
        elif state.exists:
            state.remove()
        if hand_on and paths:
            yield pd.DataFrame({"batch_seq": [key[0]], "known": [known], "paths": [paths]})

    return step


def closed_windows(paths: DataFrame, delay: str = "0 seconds",
                   retain_days: int = RETAIN_DAYS) -> DataFrame:
    """Stream of archive paths -> (batch_seq, known, paths) of the windows that closed.

    Event time is the time in the files' names; a window closes when the watermark
    (the newest time less ``delay``) reaches the next window.  Spark drops rows that are
    behind the watermark ahead of keyed state, and a late archive must not be lost.  So
    a file is two rows: one with its path and no event time, which is never dropped,
    and one with its event time alone, which moves the watermark.
    """
    key = F.substring_index(F.substring_index("path", "/", -1), ".", 1)
    tagged = ingest.tag_files(paths.select("path")).filter(
        F.col("batch_seq").isNotNull() & F.col("feed").isNotNull())
    rows = tagged.select("batch_seq", F.inline(F.array(
        F.struct(F.lit(None).cast("timestamp").alias("event_time"), F.col("path")),
        F.struct(manifest.file_key_to_event_time(key).alias("event_time"),
                 F.lit(None).cast("string").alias("path")))))
    return (rows.withWatermark("event_time", delay).groupBy("batch_seq")
            .applyInPandasWithState(_window_state(retain_days * 86_400_000),
                                    "batch_seq long, known boolean, paths array<string>",
                                    "paths array<string>, done boolean",
                                    "update", "EventTimeTimeout"))


def start_window_stream(spark: SparkSession, landing_dir: str, event_mentions_path: str,
                        articles_path: str, checkpoint_location: str,
                        available_now: bool = False, processing_time: str = "5 minutes",
                        quote: str = lines.DEFAULT_QUOTE,
                        files_per_trigger: int | None = None, delay: str = "0 seconds",
                        retain_days: int = RETAIN_DAYS) -> StreamingQuery:
    """As ``start_ingest_stream``, but a window waits until a file of a later one has landed.

    Keyed state holds the paths of each window's archives and a timer in event time
    (``closed_windows``); a trigger reads the archives of the windows that closed by
    their paths and does not look at the landing folder otherwise.  A late file takes its
    whole window up again.  ``delay`` keeps windows open longer; state is kept for
    ``retain_days`` after a window's end, later files are looked up by their window's day.
    """
    due_path = f"{checkpoint_location.rstrip('/')}-due"
    schema = "batch_seq long, known boolean, paths array<string>"

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # Written once: the state step runs once a trigger, whatever is read from it.
        batch.write.mode("overwrite").parquet(due_path)
        due = spark.read.schema(schema).parquet(due_path)
        keys = sorted((r.known, r.batch_seq) for r in due.select("known", "batch_seq").collect())
        for known in (True, False):
            seqs = [s for k, s in keys if k == known]
            for i in range(0, len(seqs), WINDOWS_PER_JOB):
                part = seqs[i:i + WINDOWS_PER_JOB]
                files = None if not known else [
                    r.path for r in due.filter(F.col("batch_seq").isin(part))
                    .select(F.explode("paths").alias("path")).collect()]
                _ingest_windows(spark, landing_dir, part, event_mentions_path, articles_path,
                                quote, files)

    return _start(spark, landing_dir, checkpoint_location, on_batch, available_now,
                  processing_time, files_per_trigger,
                  lambda paths: closed_windows(paths, delay, retain_days))
