"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor can reread, so a lost
    executor costs a task and not the whole chain.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sheltered(docs: DataFrame, own: Collection[str],
              work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``docs`` whose columns but ``own`` have names that no operator uses.

    The result has the columns of ``docs`` again, so that no column of the input can
    clash with one that ``work`` adds for itself.
    """
    names = {c: c if c in own else f"column {k}" for k, c in enumerate(docs.columns)}
    done = work(docs.select(*[quoted(c).alias(n) for c, n in names.items()]))
    return done.select(*[quoted(n).alias(c) for c, n in names.items()])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def fold(doc_id: str | Column, folds: int) -> Column:
    """``crc32`` of the id written as text, modulo ``folds`` (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str)
                   else doc_id.cast("string")) % F.lit(folds)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(batch) -> bytes:
    """An Arrow table as one compressed value."""
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema,
                           options=pa.ipc.IpcWriteOptions(
                               compression=pa.Codec("zstd", compression_level=5))) as w:
        w.write_table(batch)
    return sink.getvalue().to_pybytes()


def unpacked(value: bytes):
    import pyarrow as pa

    return pa.ipc.open_stream(value).read_all()
