"""Counts and sums of a serving table, kept beside it by data file.

A rollup holds, for each data file, day and combination of values, the number of rows
and the sum and number of their tones.  The table's totals are those of the files that
are there: an upsert that rewrites a file takes the file's old rows out with its entries
and brings the new rows in with those of the file that takes its place, so a replaced,
moved or replayed key is counted once, and nothing is ever subtracted from a sum.
Entries are written before the files they count become part of the table, and those of
files that have gone are passed over, so a crash leaves no count behind.

Queries take the totals in place of the rows (``newslens.plans.queries``).  Entries grow
with the distinct combinations in a file, so compacted files, whose rows lie together by
source and country, have far fewer entries than rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.functions.fields import split_persons

DAY = ["event_year", "event_month", "event_day"]
# What a rollup's folders are named by; a query of some months reads only these.
BY = ["event_year", "event_month"]

# Per table and rollup: the columns that values are combined of.
ROLLUPS: dict[str, dict[str, list[str]]] = {
    "event_mentions": {"country_languages": ["event_country", "source_language"]},
    "articles": {"sources": ["internet_source"],
                 "source_themes": ["internet_source", "event_themes"],
                 "source_countries": ["internet_source", "first_country"],
                 "source_persons": ["internet_source", "person"],
                 "pair_themes": ["first_country", "second_country", "event_themes"]},
}
ROWS, TONE_SUM, TONE_ROWS = "row_count", "tone_sum", "tone_count"


def rollup_schema(table: str, rollup: str) -> T.StructType:
    text = [T.StructField(c, T.StringType()) for c in ROLLUPS[table][rollup]]
    tone = [T.StructField(TONE_SUM, T.DoubleType()), T.StructField(TONE_ROWS, T.LongType())]
    return T.StructType([
        *text, T.StructField("file", T.StringType()), T.StructField("event_day", T.IntegerType()),
        T.StructField(ROWS, T.LongType()), *(tone if table == "articles" else []),
        *[T.StructField(c, T.IntegerType()) for c in BY]])


def count_files(rows: DataFrame, table: str, rollup: str) -> DataFrame:
    """The entries of some stored rows, each with its ``file``."""
    if "person" in ROLLUPS[table][rollup]:
        rows = rows.withColumn("person", F.explode(split_persons("person_list")))
    tone = ([F.sum("event_tone").alias(TONE_SUM), F.count("event_tone").alias(TONE_ROWS)]
            if table == "articles" else [])
    return (rows.groupBy(*ROLLUPS[table][rollup], "file", *DAY)
            .agg(F.count("*").alias(ROWS), *tone)
            .select(*[f.name for f in rollup_schema(table, rollup).fields]))


def write_entries(entries: DataFrame, table: str, rollup: str, to: str, mode: str) -> None:
    (entries.hint("rebalance", *BY)
     .sortWithinPartitions(*BY, *ROLLUPS[table][rollup], "event_day")
     .write.mode(mode).option("compression", "zstd").partitionBy(*BY).parquet(f"{to}/{rollup}"))


# --- measures over rows or totals ---------------------------------------------------
def row_count(df: DataFrame, of: str = "*") -> Column:
    """Number of rows (where ``of`` is not null), of stored rows or of their totals."""
    return F.sum(ROWS) if ROWS in df.columns else F.count(of)


def mean_tone(df: DataFrame) -> Column:
    if ROWS not in df.columns:
        return F.avg("event_tone")
    return F.try_divide(F.sum(TONE_SUM), F.sum(TONE_ROWS))
