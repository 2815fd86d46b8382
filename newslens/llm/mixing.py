"""Mixing sources to target weights in fixed-length blocks.

Tokens are words.  The documents of a source are strung together in a fixed
order and packed into blocks of ``BLOCK_WORDS`` words.  The mix is a row of
slots, cut into output shards.  Every slot of a shard draws its source with
probability in proportion to the sources' wanted block counts, so the counts of
a shard are multinomial; what the draws miss of a source's wanted count is
given back in one closing shard, and what they exceed it by is left out.  The
``i``-th slot of a source takes block ``permutation(i mod blocks)`` of pass
``i div blocks``, with a keyed permutation of the block numbers for each pass.
Slots and blocks are then joined by (source, block).

Nothing is kept per source in one task: document offsets come from sums over
small hash buckets, draws meet sources by slices of the slot range, and the join
key is a single block.

Defined results: a null text has no words; a null source is a source of its
own, last in order; a null or repeated id does no harm (rows are mixed one by
one, equal rows in any order); documents without words are never taken; an
empty table gives an empty mix; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm.common import materialize, sheltered

BLOCK_WORDS = 64
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
BUCKET_ROWS = 512
#: Buckets whose sums are added up together before the stretches' sums are.
STRETCH_BUCKETS = 4096
#: At most this many output shards, each of at least SHARD_SLOTS slots.
MAX_SHARDS = 1 << 14
SHARD_SLOTS = 4096
SEED = 20260
PIECES_PER_BATCH = 2000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; zero for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple = WEIGHTS,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per source: size, target words, blocks and wanted blocks.

    Targets share the total by weight; a target above ``max_repeats`` times its
    source's size stops there and the excess is shared anew.  That is filling by
    water level: with sources in order of cap / weight, the level of the first
    one whose cap is not reached holds for all that follow.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = Window.partitionBy()
    in_order = whole.orderBy(F.col("source").asc_nulls_last())
    per = (per.withColumn("source_no", F.row_number().over(in_order) - 1)
           .withColumn("weight", F.element_at(
               F.array(*[F.lit(float(w)) for w in weights]),
               (F.col("source_no") % len(weights) + 1).cast("int")))
           .withColumn("cap", F.lit(float(max_repeats)) * F.col("source_size"))
           .withColumn("total", F.sum("source_size").over(whole)))
    by_cap = whole.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    per = per.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    per = per.withColumn("level", F.max("level").over(whole))
    per = per.withColumn("target", F.least(F.col("cap"), F.col("level") * F.col("weight")))
    blocks = F.ceil(F.col("source_size") / F.lit(BLOCK_WORDS))
    wanted = F.when(F.col("source_size") > 0, F.least(
        F.round(F.col("target") / F.col("source_size") * blocks).cast("long"),
        blocks * max_repeats)).otherwise(F.lit(0))
    return per.select("source", "source_no", "source_size", "target",
                      blocks.cast("long").alias("blocks"), wanted.cast("long").alias("wanted"))


def sized_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source") -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(source).cast("string").alias("source"),
                       word_count(F.col(text)).alias("size"),
                       F.xxhash64(F.col(text)).alias("text_hash"))
    # The number of a row among those of equal id and text.
    copies = Window.partitionBy("doc_id", "text_hash").orderBy("source")
    return rows.withColumn("copy", F.row_number().over(copies))


def _pieces(sized: DataFrame, per: DataFrame) -> DataFrame:
    """(source_no, block, doc_id, start_word, n_words): the blocks' contents."""
    n = sized.agg(F.count("*")).first()[0]
    buckets = max(1, -(-n // BUCKET_ROWS))
    rows = (sized.filter("size > 0").join(per.select("source", "source_no"),
                                          sized["source"].eqNullSafe(per["source"]))
            .select("source_no", "doc_id", "size", "text_hash", "copy")
            .withColumn("bucket", F.pmod(
                F.xxhash64("doc_id", "text_hash", "copy", F.lit(SEED)), F.lit(buckets))))
    sums = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("words")).withColumn(
        "stretch", F.floor(F.col("bucket") / STRETCH_BUCKETS))
    # Sums of the buckets ahead in two levels: a source's stretches, a stretch's buckets.
    ahead = (Window.partitionBy("source_no").orderBy("stretch")
             .rowsBetween(Window.unboundedPreceding, -1))
    stretches = sums.groupBy("source_no", "stretch").agg(F.sum("words").alias("all")).select(
        "source_no", "stretch", F.coalesce(F.sum("all").over(ahead), F.lit(0)).alias("start"))
    ahead = (Window.partitionBy("source_no", "stretch").orderBy("bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    sums = (sums.withColumn("before", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
            .join(stretches, ["source_no", "stretch"])
            .select("source_no", "bucket", (F.col("start") + F.col("before")).alias("base")))
    inside = (Window.partitionBy("source_no", "bucket").orderBy("doc_id", "text_hash", "copy")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(sums, ["source_no", "bucket"])
              .withColumn("at", F.col("base") + F.col("inside")))
    end = F.col("at") + F.col("size")
    out = placed.select(
        "source_no", "doc_id", "text_hash", "copy", "size", "at",
        F.explode(F.sequence((F.col("at") / BLOCK_WORDS).cast("long"),
                             ((end - 1) / BLOCK_WORDS).cast("long"))).alias("block"))
    first = F.greatest(F.col("at"), F.col("block") * BLOCK_WORDS)
    last = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * BLOCK_WORDS)
    return out.select("source_no", "block", "doc_id", "text_hash", "copy",
                      (first - F.col("at")).alias("start_word"), (last - first).alias("n_words"))


def _draws(per: DataFrame, slots: int) -> DataFrame:
    """(shard, source_no, count): each slot's source, drawn by weight.

    A slot draws a number below the number of slots; the source whose stretch
    of that range holds it is the slot's.  Stretches are cut into slices of
    equal length so that draws and stretches meet by an equality join.
    """
    spark = per.sparkSession
    shard_slots = max(SHARD_SLOTS, -(-slots // MAX_SHARDS))
    width = SHARD_SLOTS
    up_to = Window.partitionBy().orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    stretch = (per.filter("wanted > 0")
               .withColumn("low", F.coalesce(F.sum("wanted").over(up_to), F.lit(0)))
               .withColumn("high", F.col("low") + F.col("wanted")))
    stretch = stretch.select("source_no", "low", "high", F.explode(F.sequence(
        (F.col("low") / width).cast("long"), ((F.col("high") - 1) / width).cast("long")))
        .alias("slice"))
    draws = (spark.range(slots).select(
        F.floor(F.col("id") / shard_slots).alias("shard"),
        F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(slots)).alias("u"))
        .withColumn("slice", (F.col("u") / width).cast("long")))
    met = draws.join(stretch, "slice").filter("u >= low and u < high")
    return met.groupBy("shard", "source_no").agg(F.count("*").alias("count"))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of ``0..size-1``, row by row.

    A four-round Feistel network on the smallest even number of bits that
    covers ``size``, applied again to rows that land outside.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    value = index.astype(np.uint64)
    todo = np.arange(len(value))
    with np.errstate(over="ignore"):
        while len(todo):
            h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
            left, right = value[todo] >> h, value[todo] & m
            for r in range(4):
                f = (right ^ (k + np.uint64(r) * np.uint64(0x9E3779B97F4A7C15)))
                f = (f ^ (f >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & m)
            value[todo] = (left << h) | right
            todo = todo[value[todo] >= size[todo].astype(np.uint64)]
    return value.astype(np.int64)


def _slots(per: DataFrame) -> DataFrame:
    """(shard, source_no, nth, pass, block): which block fills which slot."""
    slots = per.agg(F.sum("wanted")).first()[0] or 0
    draws = _draws(per, slots) if slots else per.sparkSession.createDataFrame(
        [], "shard long, source_no int, count long")
    ahead = Window.partitionBy("source_no").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    drawn = draws.withColumn("from", F.coalesce(F.sum("count").over(ahead), F.lit(0)))
    missing = (per.filter("wanted > 0").join(
        draws.groupBy("source_no").agg(F.sum("count").alias("drawn")), "source_no", "left")
        .withColumn("from", F.coalesce("drawn", F.lit(0))).filter("wanted > from")
        .select(F.lit(-1).cast("long").alias("shard"), "source_no",
                (F.col("wanted") - F.col("from")).alias("count"), "from"))
    runs = (drawn.select("shard", "source_no", "count", "from").unionByName(missing)
            .join(per.select("source_no", "blocks", "wanted"), "source_no"))
    until = F.least(F.col("from") + F.col("count"), F.col("wanted")) - 1
    nths = runs.filter(F.col("from") <= until).select(
        "shard", "source_no", "blocks", F.explode(F.sequence(F.col("from"), until)).alias("nth"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            nth, size = p["nth"].to_numpy(), p["blocks"].to_numpy()
            turn = nth // size
            key = (p["source_no"].to_numpy().astype(np.int64) << 8) ^ (turn << 40) ^ SEED
            yield pd.DataFrame({"shard": p["shard"], "source_no": p["source_no"], "nth": nth,
                                "pass": turn, "block": permuted(nth % size, size, key)})

    return nths.mapInPandas(
        place, "shard long, source_no int, nth long, pass long, block long")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
        source: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mixture, targets, sizes).

    The mixture has one row per piece of a slot's block: ``shard, source_no,
    nth, pass, block, doc_id, text_hash, copy, start_word, n_words``; targets one row
    per source; sizes one row per document.
    """
    sized = materialize(sized_documents(docs, doc_id, text, source), "mix-sizes")
    per = materialize(targets(sized), "mix-targets")
    mixture = _slots(per).join(_pieces(sized, per), ["source_no", "block"])
    return mixture, per, sized


def taken(docs: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes."""
    mixture, per, sized = mix(docs)
    used = mixture.groupBy("doc_id", "text_hash", "copy").agg(F.sum("n_words").alias("taken"))
    rows = sized.join(per.select(
        F.col("source").alias("_source"), "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_source")))
    same = [rows[c].eqNullSafe(used[c]) for c in ("doc_id", "text_hash", "copy")]
    return rows.join(used, same, "left").select(
        rows["doc_id"], "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).alias("taken"))


def piece_texts(docs: DataFrame, mixture: DataFrame, doc_id: str = "doc_id",
                text: str = "text", source: str = "source") -> DataFrame:
    """The mixture's pieces as documents: the columns of ``docs``, texts cut to the piece.

    A piece reaches from its first word to the next piece's first word, so white
    space between words stays as it is.
    """
    return sheltered(docs, (doc_id, text, source), lambda d: _piece_texts(
        d, mixture, doc_id, text, source))


def _piece_texts(docs: DataFrame, mixture: DataFrame, doc_id: str, text: str,
                 source: str) -> DataFrame:
    word = re.compile(WORD)
    # The number of a row among its copies and its pieces meet under the same three
    # keys, none of them null, so that texts move once.
    keys = ["_null", "_id", "_hash"]

    def keyed(df: DataFrame, the_id: Column, the_hash: Column) -> DataFrame:
        return (df.withColumn("_null", the_id.isNull())
                .withColumn("_id", F.coalesce(the_id.cast("long"), F.lit(0).cast("long")))
                .withColumn("_hash", the_hash))

    spans = keyed(mixture, F.col("doc_id"), F.col("text_hash")).groupBy(keys).agg(
        F.collect_list(F.struct("copy", "start_word", "n_words")).alias("_all"))
    own = Window.partitionBy(*keys).orderBy(F.col(source).cast("string"))
    rows = keyed(docs, F.col(doc_id), F.xxhash64(F.col(text))).withColumn(
        "_no", F.row_number().over(own))
    joined = rows.join(spans, keys).withColumn(
        "_spans", F.filter("_all", lambda x: x["copy"] == F.col("_no")))

    names = list(docs.columns)
    place = names.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Row by row, so that few pieces are held at a time."""
        for batch in batches:
            rows, pieces = [], []
            for i, (value, spans) in enumerate(zip(batch.column(place), batch.column("_spans"))):
                value = value.as_py()
                starts = [m.start() for m in word.finditer(value)]
                starts.append(len(value))
                for s in spans.as_py():
                    rows.append(i)
                    pieces.append(value[starts[s["start_word"]]:
                                        starts[s["start_word"] + s["n_words"]]])
                if len(rows) >= PIECES_PER_BATCH or i == batch.num_rows - 1:
                    own = pa.array(rows, pa.int32())
                    columns = [pa.array(pieces, pa.string()) if c == text
                               else batch.column(c).take(own) for c in names]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    rows, pieces = [], []

    return joined.select(*names, "_spans").mapInArrow(cut, docs.schema)
