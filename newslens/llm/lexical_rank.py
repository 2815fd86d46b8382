"""Ranked lexical search by pipelined term partitioning.

An inverted index of the documents is made once, in blocks of bounded size (a
block's documents, and for every term of its texts the places and counts), and cut
down to the terms of the items by a join.  The terms are partitioned over
``OWNERS`` owners by weight, the rarest first.  A bundle holds the items of one
chunk together with their sparse document accumulators over one block; it passes
through the owners one after another, each stage a cogroup of the bundles with the
owner's postings, which adds the integer contributions of its terms.  The last
stage selects the best ``k`` of each item and block, and a ranking over these
selects the best overall.

How it spreads: a group is one (block, chunk), so a term that every document holds
lies in as many pieces as there are blocks, and an owner's postings are never in
one task.  Corpus statistics are sums that Spark combines before its shuffles; the
driver sees three numbers.  Items are dealt to chunks by their id's hash, so their
number may grow; a chunk's items meet each block once.  Nothing is cut off: every
document that holds a term of an item is scored in full, in 64-bit integers.

Defined results: a null text has no terms; rows that repeat an item's id are one
item with the terms of all of them, a null id is an id; rows that repeat a
document's id are ranked one by one; equal scores go by ascending document id,
null last; scores of 0 (terms whose weight rounds to 0) are left out; other columns
are not read; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm.common import materialize, packed, unpacked

K = 10
#: Length's share in the damping, in hundredths.
B = 90
#: Least weight of the terms of each owner but the last.
OWNERS = (4500, 2500, 1000)
BLOCK_DOCS = 4096
BLOCK_BYTES = 8 << 20
CHUNK_ITEMS = 256

#: Bytes of a term: ASCII letters and digits, and everything beyond ASCII.
_TERM_BYTES = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_FOLD = _TERM_BYTES.lower()

_INDEX = ("block long, term binary, df long, docs array<int>, tfs array<int>, "
          "known long, length long, ids binary")


def terms_of(data: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, ASCII letters in lower case."""
    return data.translate(_FOLD).split()


def _block_rows(block: int, ids: pa.Table, terms: list[bytes], sizes: list[int]):
    """The postings of one block, and a row without a term for its documents."""
    n = np.asarray(sizes, np.int64)
    codes = pa.array(terms, pa.binary()).dictionary_encode()
    docs = np.repeat(np.arange(len(n)), n)
    key, tf = np.unique(codes.indices.to_numpy().astype(np.int64) * len(n) + docs,
                        return_counts=True)
    term, doc = np.divmod(key, len(n))
    ends = np.flatnonzero(np.r_[term[1:] != term[:-1], len(term) > 0])
    offsets = np.r_[0, ends + 1].astype(np.int32)
    rows = len(offsets) - 1
    lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.astype(np.int32)))
             for x in (doc, tf)]
    blocks = pa.array(np.full(rows, block), pa.int64())
    own = pa.table({"id": ids, "n": n})
    return [
        [blocks, codes.dictionary.take(pa.array(term[ends])) if rows
         else pa.array([], pa.binary()), pa.array(np.diff(offsets), pa.int64()), *lists,
         pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary())],
        [pa.array([block], pa.int64()), pa.array([b""], pa.binary()), pa.nulls(1, pa.int64()),
         *[pa.nulls(1, pa.list_(pa.int32()))] * 2,
         pa.array([int((n > 0).sum())]), pa.array([int(n.sum())]),
         pa.array([packed(own)], pa.binary())]]


def index(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Postings in blocks of bounded size; the row of the empty term is the block itself."""
    names = [f.strip().split()[0] for f in _INDEX.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        ids: list = []
        terms: list[bytes] = []
        sizes: list[int] = []
        held = 0

        def flush():
            for columns in _block_rows(block, pa.array(ids, pa.int64()), terms, sizes):
                yield pa.RecordBatch.from_arrays(columns, names=names)

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                data = t.as_buffer() if t.is_valid else None
                found = terms_of(data.to_pybytes()) if data is not None else []
                ids.append(i)
                terms += found
                sizes.append(len(found))
                held += data.size if data is not None else 0
                if len(ids) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                    yield from flush()
                    block, ids, terms, sizes, held = block + 1, [], [], [], 0
        if ids:
            yield from flush()

    return docs.select(F.col(doc_id).cast("long").alias("id"),
                       F.col(text).cast("string").alias("text")).mapInArrow(run, _INDEX)


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``(item, term)``, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                found = sorted(set(terms_of(t.as_buffer().to_pybytes()))) if t.is_valid else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(found), pa.int64()), pa.array(found, pa.binary())],
                    names=["item", "term"])

    return items.select(F.col(item_id).cast("long").alias("item"),
                        F.col(text).cast("string").alias("text")).mapInArrow(
        run, "item long, term binary").distinct()


def weight(n_docs: int, df: Column) -> Column:
    return F.floor(F.lit(1000.0) * F.log(
        F.lit(2.0 * n_docs + 2.0) / (2 * df + 1).cast("double"))).cast("long")


def owner(w: Column) -> Column:
    """The stage at which a term's postings are added."""
    stage = F.lit(len(OWNERS))
    for k, least in reversed(list(enumerate(OWNERS))):
        stage = F.when(w >= least, F.lit(k)).otherwise(stage)
    return stage


# --- stages ------------------------------------------------------------------------
class Bundle:
    """The accumulators of a chunk's items over a block's documents."""

    def __init__(self, row: dict, mean: tuple[int, int]):
        self.row = row
        own = unpacked(row["ids"])
        self.ids, n = own["id"].combine_chunks(), own["n"].to_numpy()
        n_docs, length = mean
        self.m = 100 - B + (B * n * n_docs) // length
        self.items = np.asarray(row["items"], object)
        self.scores = np.zeros((len(self.items), len(n)), np.int64)
        if row["acc"] is not None:
            acc = unpacked(row["acc"])
            self.scores.ravel()[acc["at"].to_numpy()] = acc["score"].to_numpy()

    def add(self, w: int, slots: np.ndarray, docs: np.ndarray, tf: np.ndarray) -> None:
        tf = tf.astype(np.int64)
        gain = w * ((1_000_000_000 * tf) // (1000 * tf + 8 * self.m[docs]))
        self.scores[np.ix_(slots, docs)] += gain

    def accumulators(self) -> bytes:
        at = np.flatnonzero(self.scores)
        return packed(pa.table({"at": at, "score": self.scores.ravel()[at]}))

    def best(self, k: int) -> list[pa.Array]:
        """The best ``k`` of each item: item, id, score."""
        items, places, scores = [], [], []
        for slot, line in enumerate(self.scores):
            at = np.flatnonzero(line)
            if len(at) > k:
                # All documents at least as good as the k-th, then by id.
                least = np.partition(line[at], len(at) - k)[len(at) - k]
                at = at[line[at] >= least]
            if len(at) > k:
                exact = pa.table({"s": -line[at], "i": self.ids.take(pa.array(at))})
                order = pc.sort_indices(
                    exact, sort_keys=[("s", "ascending"), ("i", "ascending")])
                at = at[order.to_numpy()[:k]]
            items += [self.items[slot]] * len(at)
            places.append(at)
            scores.append(line[at])
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        return [pa.array(items, pa.int64()), self.ids.take(pa.array(at)), pa.array(np.concatenate(scores) if scores else [], pa.int64())]


_BUNDLE = "block long, chunk int, ids binary, items array<long>, acc binary"
_BEST = "item_id long, doc_id long, score long"


def _stage(bundles: DataFrame, postings: DataFrame, mean: tuple[int, int],
           last: int | None) -> DataFrame:
    """Bundles after one owner; after the last one, its best ``last`` of each item."""
    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for row in left.to_pylist():
            bundle = Bundle(row, mean)
            for w, slots, docs, tfs in zip(*(right[c] for c in ("w", "slots", "docs", "tfs"))):
                bundle.add(w.as_py(), slots.values.to_numpy(), docs.values.to_numpy(),
                           tfs.values.to_numpy())
            if last is None:
                found.append(pa.table(
                    {"block": pa.array([row["block"]], pa.int64()),
                     "chunk": pa.array([row["chunk"]], pa.int32()),
                     "ids": pa.array([row["ids"]], pa.binary()),
                     "items": pa.array([row["items"]], pa.list_(pa.int64())),
                     "acc": pa.array([bundle.accumulators()], pa.binary())}))
            else:
                found.append(pa.table(bundle.best(last), names=["item_id", "doc_id", "score"]))
        if found:
            return pa.concat_tables(found)
        types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
                 "array<long>": pa.list_(pa.int64())}
        fields = [f.split() for f in (_BEST if last else _BUNDLE).split(", ")]
        return pa.table({n: pa.array([], types[t]) for n, t in fields})

    return bundles.groupBy("block", "chunk").cogroup(
        postings.groupBy("at_block", "at_chunk")).applyInArrow(add, _BEST if last else _BUNDLE)


def rank(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id",
         text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the best ``k`` documents of every item."""
    wanted = materialize(item_terms(items, item_id, item_text), "rank-items")
    vocabulary = wanted.select("term").union(
        docs.sparkSession.range(1).select(F.lit(b"").alias("term"))).distinct()
    everything = index(docs, doc_id, text)
    kept = materialize(everything.join(vocabulary, "term", "left_semi").select(
        *everything.columns), "rank-index")
    blocks = kept.filter("ids is not null")
    postings = kept.filter("ids is null")
    n_docs, length = blocks.agg(F.sum("known"), F.sum("length")).first()
    n_items = wanted.select("item").distinct().count()
    mean = (n_docs or 0, length or 1)
    chunks = max(1, -(-n_items // CHUNK_ITEMS))

    terms = postings.groupBy("term").agg(F.sum("df").alias("df")).select(
        "term", weight(mean[0], F.col("df")).alias("w")).filter("w > 0")
    # The items of each chunk, numbered: their slots in a bundle.
    in_chunk = F.pmod(F.xxhash64("item"), F.lit(chunks)).cast("int")
    listed = wanted.select("item").distinct().groupBy(in_chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("item"))).alias("x")).select(
        "chunk", F.transform("x", lambda x: x["item"]).alias("items"))
    slots = listed.select("chunk", F.posexplode("items").alias("slot", "item"))
    asked = (wanted.join(slots, wanted["item"].eqNullSafe(slots["item"]))
             .groupBy("term", "chunk").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
             .join(terms, "term").withColumn("owner", owner(F.col("w"))))
    asked = materialize(asked, "rank-asked")
    bundles = blocks.select("block", "ids", F.explode(F.sequence(
        F.lit(0), F.lit(chunks - 1))).alias("chunk")).join(listed, "chunk").select(
        "block", "chunk", "ids", "items", F.lit(None).cast("binary").alias("acc"))
    for stage in range(len(OWNERS) + 1):
        own = postings.select("block", "term", "docs", "tfs").join(
            asked.filter(F.col("owner") == stage), "term").select(
            F.col("block").alias("at_block"), F.col("chunk").alias("at_chunk"), "w", "slots",
            "docs", "tfs")
        bundles = _stage(bundles, own, mean, k if stage == len(OWNERS) else None)
    best = Window.partitionBy("item_id").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id"))
    return (bundles.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
