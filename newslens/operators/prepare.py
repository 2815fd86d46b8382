"""Raw feeds -> serving rows (join, date parts, renames, cleaning, dedup).

``event_mentions`` / ``articles`` are the cleaned rows of one batch before
the keyed upsert; ``latest_event_mentions`` / ``latest_articles`` are the
upserted form (one row per key).  Every step is a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.functions import fields as X
from newslens.operators.skew import join_split
from newslens.operators.upsert import latest_per_key
from newslens.schemas import ARTICLES_SCHEMA, EVENT_MENTIONS_SCHEMA

EVENT_MENTIONS_COLUMNS = [f.name for f in EVENT_MENTIONS_SCHEMA.fields]
ARTICLES_COLUMNS = [f.name for f in ARTICLES_SCHEMA.fields]

# Columns carried next to the serving columns so the upsert winner is defined.
MENTION_ORDER_COLUMNS = ["mention_time_date", "mention_identifier"]

EXPORT_FIELDS = ["GlobalEventID", "Day", "ActionGeo_CountryCode", "ActionGeo_FullName",
                 "NumMentions"]
MENTION_FIELDS = ["GlobalEventID", "MentionTimeDate", "MentionIdentifier",
                  "MentionDocTranslationInfo"]
GKG_FIELDS = ["GKGRECORDID", "DATE", "SourceCommonName", "V2Counts", "Persons", "Locations",
              "V2Tone"]

EVENT_REQUIRED = ["global_event_id", "event_year", "event_month", "event_day", "event_country"]
ARTICLE_REQUIRED = ["global_event_id", "event_year", "event_month", "event_day",
                    "countries_name", "event_themes", "event_tone"]

# Upsert winner among the mentions of one event: latest mention, then the
# smallest identifier, then the language; the remaining columns break any
# tie left (only possible when an event row is duplicated in a batch).
EVENT_MENTIONS_ORDER = [("mention_time_date", "desc"), ("mention_identifier", "asc"),
                        ("source_language", "asc")]
# Articles: newest day first, then every other column ascending.
ARTICLES_ORDER = [("event_year", "desc"), ("event_month", "desc"), ("event_day", "desc")]


def join_events_mentions(export: DataFrame, mentions: DataFrame,
                         split_hot: bool = False) -> DataFrame:
    """Inner equi-join on ``GlobalEventID``; one row per mention.

    Both sides are projected to the columns used downstream before the join, so
    the scans read only those columns.  ``split_hot`` cuts events of very many
    mentions into pieces (``operators.skew``; one more scan of the mentions' key).
    """
    e = export.select(*EXPORT_FIELDS)
    m = mentions.select(*MENTION_FIELDS)
    if split_hot:
        return join_split(e, m, "GlobalEventID")
    return e.join(m, on="GlobalEventID", how="inner")


def event_mentions(export: DataFrame, mentions: DataFrame) -> DataFrame:
    """All joined and cleaned rows of one batch (one per surviving mention)."""
    joined = join_events_mentions(export, mentions)
    parts = X.event_date_parts("Day")
    rows = joined.select(
        F.col("GlobalEventID").alias("global_event_id"),
        parts["event_year"].alias("event_year"),
        parts["event_month"].alias("event_month"),
        parts["event_day"].alias("event_day"),
        X.source_language("MentionDocTranslationInfo").alias("source_language"),
        F.col("ActionGeo_CountryCode").alias("event_country"),
        F.col("ActionGeo_FullName").alias("event_country_full_name"),
        F.col("NumMentions").alias("num_mentions"),
        F.col("MentionTimeDate").alias("mention_time_date"),
        F.col("MentionIdentifier").alias("mention_identifier"),
    )
    rows = X.blank_to_null(rows, ["source_language", "event_country", "event_country_full_name"])
    return rows.dropna(how="any", subset=EVENT_REQUIRED)


EVENT_PAYLOAD = ["event_year", "event_month", "event_day", "event_country",
                 "event_country_full_name", "num_mentions"]


def _clean_events(export: DataFrame, extra: list[str]) -> DataFrame:
    """Event-side cleaning (date parts, renames, blank -> null, required fields)."""
    parts = X.event_date_parts("Day")
    rows = export.select(
        *extra,
        F.col("GlobalEventID").alias("global_event_id"),
        parts["event_year"].alias("event_year"),
        parts["event_month"].alias("event_month"),
        parts["event_day"].alias("event_day"),
        F.col("ActionGeo_CountryCode").alias("event_country"),
        F.col("ActionGeo_FullName").alias("event_country_full_name"),
        F.col("NumMentions").alias("num_mentions"),
    )
    rows = X.blank_to_null(rows, ["event_country", "event_country_full_name"])
    return rows.dropna(how="any", subset=EVENT_REQUIRED)


def _mentions(mentions: DataFrame, extra: list[str]) -> DataFrame:
    """Mention-side columns of the ranking."""
    return mentions.select(
        *extra, F.col("GlobalEventID").alias("global_event_id"),
        F.col("MentionTimeDate").alias("mention_time_date"),
        F.col("MentionIdentifier").alias("mention_identifier"),
        F.nullif(X.source_language("MentionDocTranslationInfo"), F.lit("")).alias(
            "source_language"))


def latest_event_mentions(export: DataFrame, mentions: DataFrame,
                          with_order_columns: bool = False, batch_col: str | None = None,
                          keep_batch: bool = False) -> DataFrame:
    """One row per event: the batch's ``event_mentions`` after the keyed upsert.

    Equal to ``latest_per_key(event_mentions(...))`` but cheaper and skew-proof.
    The winner ranks mention columns first and event columns after them, and
    the row filter reads event columns only, so both sides can be reduced to
    one row per event *before* the join: the winning mention (latest time,
    then identifier, then language) and the winning surviving event row
    (smallest columns).  The join is then one-to-one, so an event holding a
    third of all mentions (or duplicated export rows) no longer skews it, and
    both reductions combine map-side.

    ``batch_col`` (an integer batch sequence present on both inputs) processes
    many batches in one job: the join stays inside a batch, as when each batch
    is processed on its own, and the highest batch wins per key, as when the
    batches are upserted one after another.  ``keep_batch`` keeps the winner's
    batch sequence as a last column.
    """
    batch = [batch_col] if batch_col else []
    best_mention = latest_per_key(_mentions(mentions, batch), batch + ["global_event_id"],
                                  EVENT_MENTIONS_ORDER)
    best_event = latest_per_key(_clean_events(export, batch), batch + ["global_event_id"],
                                [(c, "asc") for c in EVENT_PAYLOAD])
    joined = best_event.join(best_mention, on=batch + ["global_event_id"], how="inner")
    cols = EVENT_MENTIONS_COLUMNS + (MENTION_ORDER_COLUMNS if with_order_columns else [])
    if not batch_col:
        return joined.select(*cols)
    order = [(batch_col, "desc")] + EVENT_MENTIONS_ORDER
    return latest_per_key(joined, "global_event_id", order, cols + [batch_col] * keep_batch)


def late_mentions(export: DataFrame, mentions: DataFrame, batch_col: str) -> DataFrame:
    """``global_event_id, batch_col, source_language`` of the latest mention of every event
    whose last window with a mention did not export it.

    ``batch_col`` orders the windows; the mention is the one that the upsert would take
    in that window.  Both sides are reduced to a row per event and window first.
    """
    key = ["global_event_id"]
    best = latest_per_key(_mentions(mentions, [batch_col]), key + [batch_col],
                          EVENT_MENTIONS_ORDER)
    last = latest_per_key(best, "global_event_id", [(batch_col, "desc")])
    exported = _clean_events(export, [batch_col]).select(batch_col, *key).distinct()
    return last.join(exported, key + [batch_col], "left_anti").select(
        *key, batch_col, "source_language")


def with_history(rows: DataFrame, late: DataFrame, stored: DataFrame,
                 batch_col: str) -> DataFrame:
    """The windows' rows, brought up to date by late mentions.

    A late mention takes the event from this input's rows or, if it has none, from the
    ``stored`` rows of earlier windows, and its own language and window.  Each event has
    one row at most in ``rows``, ``late`` and ``stored``, so every mention counts once.
    """
    key = "global_event_id"
    own = [c for c in EVENT_MENTIONS_COLUMNS if c not in (key, "source_language")]
    known = rows.select(key, *own, F.lit(0).alias("_from")).unionByName(
        stored.select(key, *own, F.lit(1).alias("_from")))
    event = latest_per_key(known, key, [("_from", "asc")], [key, *own])
    found = late.join(event, key).select(*EVENT_MENTIONS_COLUMNS, batch_col)
    return rows.join(found.select(key), key, "left_anti").select(
        *EVENT_MENTIONS_COLUMNS, batch_col).unionByName(found)


def articles(gkg: DataFrame, batch_col: str | None = None) -> DataFrame:
    """Cleaned article rows of one batch (serving columns, before the upsert)."""
    parts = X.article_date_parts("DATE")
    batch = [batch_col] if batch_col else []
    rows = gkg.select(
        *batch,
        F.col("GKGRECORDID").alias("global_event_id"),
        F.col("SourceCommonName").alias("internet_source"),
        parts["event_year"].alias("event_year"),
        parts["event_month"].alias("event_month"),
        parts["event_day"].alias("event_day"),
        F.col("V2Counts").alias("event_themes"),
        F.col("Persons").alias("person_list"),
        F.col("Locations").alias("countries_name"),
        X.first_tone("V2Tone").alias("event_tone"),
    )
    rows = X.blank_to_null(rows, ARTICLES_COLUMNS + ["countries_name"])
    rows = rows.dropna(how="any", subset=ARTICLE_REQUIRED)
    # Country list computed once, then indexed (CollapseProject keeps it shared).
    rows = rows.withColumn("countries", X.location_countries("countries_name"))
    return rows.select(
        *batch, "global_event_id", "internet_source", "event_year", "event_month", "event_day",
        X.first_theme("event_themes").alias("event_themes"),
        "person_list", "event_tone",
        F.get("countries", F.lit(0)).alias("first_country"),
        F.get("countries", F.lit(1)).alias("second_country"),
    )


def latest_articles(gkg: DataFrame, batch_col: str | None = None,
                    keep_batch: bool = False) -> DataFrame:
    """One row per article id (keyed upsert of one batch; with ``batch_col``,
    of several batches in order, the highest batch winning)."""
    order = [(batch_col, "desc")] + ARTICLES_ORDER if batch_col else ARTICLES_ORDER
    return latest_per_key(articles(gkg, batch_col), "global_event_id", order,
                          ARTICLES_COLUMNS + [batch_col] * keep_batch)
