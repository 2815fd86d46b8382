"""Equality join whose hot keys are cut into pieces by plan, not by run-time splitting.

A sketch of frequent keys (one aggregate over the key column, combined map-side) names
every key that holds a given share of the rows.  Rows of such a key are dealt to pieces
by a hash of all their columns, so the deal is the same when a lost task runs again, and
the other side's rows of that key are repeated once for each piece.  All other keys have
one piece, so there is one shuffle by (key, piece) and no second join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pieces of an average task's rows; more make the tasks more even.
PIECES_PER_TASK = 8
# Keys that are told apart as hot at most, each with more than 1 / MAX_HOT of the rows.
MAX_HOT = 10_000
# Items that the sketch keeps; its counts are off by rows / TRACKED at most or so.
TRACKED = 8 * MAX_HOT


def hot_keys(rows: DataFrame, key: str) -> list[tuple]:
    """``(key, pieces)`` of the keys with more rows than a piece should have.

    At most ``MAX_HOT`` of them, since each holds more than that part of all rows.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1 / (PIECES_PER_TASK * tasks), 1 / MAX_HOT)
    got = (rows.filter(F.col(key).isNotNull())
           .agg(F.count("*").alias("n"),
                F.expr(f"approx_top_k(`{key}`, {math.ceil(1 / share)}, {TRACKED})").alias("top"))
           .first())
    piece = share * got.n
    return [(t["item"], math.ceil(t["count"] / piece)) for t in got.top or []
            if t["count"] > piece]


def join_split(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """``one.join(many, key)`` for a ``many`` that may hold any part of its rows in one key.

    Rows of a hot key that agree in every column share a piece.  A key that is hot on
    both sides has as many results as the product says, here as in any join.
    """
    hot = hot_keys(many, key)
    if not hot:
        return one.join(many, key)
    kind = many.schema[key].dataType.simpleString()
    # MAX_HOT rows at most.
    table = F.broadcast(one.sparkSession.createDataFrame(hot, f"`{key}` {kind}, _pieces int"))
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in many.columns]),
                   F.coalesce("_pieces", F.lit(1))).cast("int")
    many = many.join(table, key, "left").withColumn("_piece", dealt).drop("_pieces")
    one = (one.join(table, key, "left")
           .withColumn("_piece", F.explode(F.sequence(
               F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))).drop("_pieces"))
    return one.join(many, [key, "_piece"]).drop("_piece")
