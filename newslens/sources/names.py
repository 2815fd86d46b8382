"""Index of the country names of a table by their three-character pieces.

A substring test on a pair's members says nothing about a row group's smallest and largest
value; Spark's Parquet reader answers it from the group's dictionary, where there is one.
The names themselves are few, so the test is put to them first: those that hold every
piece of the text are looked up and compared, and the scan gets ``IN`` with the names
found, which the statistics answer before any dictionary is read, and also for columns
that are not dictionary-encoded.

The index may hold names that no row has any more, which find nothing; a name is added
before the file that brings it becomes part of the table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 3
SCHEMA = "piece string, name string"
# A text that more names hold than this is left to the scan's own substring test.
MAX_NAMES = 1_000


def pieces(name: Column) -> Column:
    """All runs of ``PIECE`` characters; a shorter name is a piece of its own."""
    last = F.char_length(name) - PIECE + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                       lambda i: F.substr(name, i, F.lit(PIECE)))
    return F.array_distinct(runs)


def names_of(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct names of some columns."""
    parts = [rows.select(F.col(c).alias("name")).filter(F.col(c).isNotNull()).distinct()
             for c in columns]
    return reduce(DataFrame.union, parts).distinct()


def write_names(names: DataFrame, to: str, mode: str) -> None:
    (names.select(F.explode(pieces(F.col("name"))).alias("piece"), "name")
     .repartitionByRange("piece", "name").sortWithinPartitions("piece", "name")
     .write.mode(mode).option("compression", "zstd").parquet(to))


def finder(index: DataFrame) -> Callable[[str], list[str] | None]:
    """A function from a text to the names that hold it (None: more than ``MAX_NAMES``)."""
    def find(text: str) -> list[str] | None:
        wanted = sorted({text[i:i + PIECE] for i in range(len(text) - PIECE + 1)})
        found = index
        if wanted:
            found = (index.filter(F.col("piece").isin(wanted)).groupBy("name")
                     .agg(F.count_distinct("piece").alias("held"))
                     .filter(F.col("held") == len(wanted)))
        found = found.filter(F.col("name").contains(text)).select("name").distinct()
        got = [r.name for r in found.limit(MAX_NAMES + 1).collect()]
        return sorted(got) if len(got) <= MAX_NAMES else None
    return find
