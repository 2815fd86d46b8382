"""Keyed upserts: one winner per key inside a batch, last batch wins across batches.

The serving tables have a primary key; appending a batch to such a table means
the last write per key survives.  ``latest_per_key`` picks a deterministic
winner inside one batch and ``merge_keyed`` applies a batch to an existing
table.

Scale note: the in-batch winner is a ``min`` over a struct whose leading
fields encode the ranking.  ``min`` is an algebraic aggregate, so Spark
combines map-side before the shuffle: a key holding a third of all rows sends
one row per map task, not its whole group.  No window over the key is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _rank_fields(df: DataFrame, order: Sequence[tuple[str, str]]) -> list[Column]:
    """Struct fields whose ascending order is the requested order, nulls last.

    Field ``v<i>`` holds column ``i`` (bitwise-NOT for descending); ``n<i>``, a
    null flag, is only added for nullable columns.
    """
    fields_by_name = {f.name: f for f in df.schema.fields}
    fields: list[Column] = []
    for i, (name, direction) in enumerate(order):
        c = F.col(name)
        if fields_by_name[name].nullable:
            fields.append(c.isNull().alias(f"n{i}"))  # false < true: nulls last
        if direction == "asc":
            fields.append(c.alias(f"v{i}"))
        elif direction == "desc":
            if not isinstance(fields_by_name[name].dataType, _INTEGRAL):
                raise TypeError(f"descending rank needs an integral column, got {name}")
            # bitwise NOT reverses integer order without overflow (~x == -x - 1).
            fields.append(F.bitwise_not(c).alias(f"v{i}"))
        else:
            raise ValueError(direction)
    return fields


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[tuple[str, str]],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``key``: the first row under ``order`` (then all other columns, asc).

    ``key`` is a column name or a list of names.  ``order`` is a list of
    ``(column, 'asc' | 'desc')``; nulls always rank last.  Remaining columns are
    appended to the ranking so the winner is unique whatever the partitioning.
    Returns ``columns`` (default: all of ``df``).  Every column is part of the
    ranking struct, so the winner's values are read back from it (no payload).
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = list(columns or df.columns)
    ranked = [c for c, _ in order]
    rest = [(c, "asc") for c in df.columns if c not in keys and c not in ranked]
    full_order = list(order) + rest
    winner = F.min(F.struct(*_rank_fields(df, full_order))).alias("w")
    out = df.groupBy(*keys).agg(winner)
    position = {name: (i, direction) for i, (name, direction) in enumerate(full_order)}

    def value(c: str) -> Column:
        i, direction = position[c]
        v = F.col(f"w.v{i}")
        return (F.bitwise_not(v) if direction == "desc" else v).alias(c)

    return out.select(*[F.col(c) if c in keys else value(c) for c in columns])


def merge_keyed(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``batch``, plus all of ``batch``.

    ``batch`` must already hold one row per key.  Spark picks the join of the
    keys from their measured size.
    """
    batch = batch.select(*existing.columns)
    return existing.join(batch.select(key), on=key, how="left_anti").unionByName(batch)
