"""SimHash near-duplicates found by bit-sliced comparison.

Fingerprints: words of the lower-cased text, shingles of ``shingle_words``
words, XXH64 of each; a bit is set if it is set in over half of the hashes.

Links: equal fingerprints are one node.  The 64 bits are cut into ``radius + 2``
blocks; two fingerprints within the radius agree on two blocks at least, so
every pair of blocks gives a key, and only fingerprints that share a key meet.
Where they meet, candidates are stored as 64 vertical bit planes, one lane per
candidate, and compared with many queries at once: the differing bits of a plane
are added to carry-save counters that start so high that a lane's counter runs
over once its distance exceeds the radius.  Query rows whose lanes have all run
over are abandoned.  Of the pairs found in one place only a spanning forest is
given out.  Keys with many fingerprints are cut into blocks that meet pair by
pair, each in a task of its own, so no pair is lost and no task grows.

Components: alternating large-star and small-star steps over the forest, each
written to the shared folder, until nothing changes.

Defined results: a null, empty or white text has fingerprint zero, linked like
any other; fewer words than a shingle are one shingle; rows that repeat an id
are linked one by one; a null id never is a component id unless a component has
no other; an empty table gives an empty result; long texts are hashed in
stretches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm.common import materialize, sheltered

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
STRETCH = 8192
#: Fingerprints compared at once; larger keys are cut into blocks of about half of it.
CHUNK = 1024


def text_fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest

    # Bytes lower-case A-Z alone and split at exactly the six ASCII white spaces.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle_words:
        return xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - shingle_words + 1].tolist()
    ends = ends[shingle_words - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for first in range(0, len(starts), STRETCH):
        hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(
            starts[first:first + STRETCH], ends[first:first + STRETCH])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(counts * 2 > len(starts), bitorder="little").tobytes(),
                          "little")


def fingerprints(docs: DataFrame, text: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The columns of ``docs``, the text's fingerprint as a signed long behind them."""
    n = docs.columns.index(text)
    name = "_fp"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([text_fingerprint(t.as_py(), shingle_words) for t in b.column(n)],
                           np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps.view(np.int64))],
                                             names=[*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields,
                                              T.StructField(name, T.LongType())]))


def block_keys(fp: Column, radius: int = RADIUS) -> Column:
    """One key for every two of the ``radius + 2`` bit blocks."""
    n = radius + 2
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
              for lo, hi in zip(edges, edges[1:])]
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    return F.array(*[F.struct(F.lit(k).alias("pair"), blocks[i].alias("x"), blocks[j].alias("y"))
                     for k, (i, j) in enumerate(pairs)])


def planes(values: np.ndarray) -> np.ndarray:
    """64 x lanes/64 words: bit plane ``p`` holds bit ``p`` of every value."""
    lanes = -(-len(values) // 64) * 64
    padded = np.zeros(lanes, "<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def near_pairs(queries: np.ndarray, lanes: np.ndarray, radius: int = RADIUS,
               ordered: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, lane) within the radius; ``ordered`` only gives query < lane."""
    vertical = planes(lanes)
    width, n_bits = vertical.shape[1], (radius + 1).bit_length()
    start = (1 << n_bits) - 1 - radius
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out_q, out_l = [], []
    for first in range(0, len(queries), 256):
        tile = queries[first:first + 256].astype(np.uint64)
        row = np.arange(first, first + len(tile))
        done = np.arange(width * 64) >= len(lanes)
        done = np.tile(done, (len(tile), 1))
        if ordered:
            done |= np.arange(width * 64)[None, :] <= row[:, None]
        over = np.packbits(done, axis=1, bitorder="little").view("<u8").copy()
        counters = [np.full(over.shape, full if start >> b & 1 else 0, np.uint64)
                    for b in range(n_bits)]
        for p in range(64):
            mask = (tile >> np.uint64(p) & np.uint64(1)) * full
            carry = vertical[p][None, :] ^ mask[:, None]
            for b in range(n_bits):
                counters[b], carry = counters[b] ^ carry, counters[b] & carry
            over |= carry
            if p % 4 == 3:
                alive = (over != full).any(axis=1)
                if not alive.all():
                    tile, row, over = tile[alive], row[alive], over[alive]
                    counters = [c[alive] for c in counters]
                    if not len(row):
                        break
        if len(row):
            hit = np.unpackbits(np.ascontiguousarray(~over).view(np.uint8), axis=1, bitorder="little")
            i, j = np.nonzero(hit)
            out_q.append(row[i])
            out_l.append(j)
    if not out_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_q), np.concatenate(out_l)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes is connected to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _link(a: np.ndarray, b: np.ndarray | None, radius: int) -> pd.DataFrame:
    """Star links among ``a``, or between ``a`` and ``b``."""
    if b is None:
        values = a
        i, j = near_pairs(a, a, radius, ordered=True)
    else:
        values = np.concatenate([a, b])
        i, j = near_pairs(a, b, radius)
        j = j + len(a)
    root = forest(len(values), i, j)
    own = np.flatnonzero(root != np.arange(len(values)))
    return pd.DataFrame({"a": values[own].view(np.int64), "b": values[root[own]].view(np.int64)})


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): a spanning forest of the pairs of fingerprints within the radius."""
    members = distinct.select("fp", F.explode(block_keys(F.col("fp"), radius)).alias("key")) \
        .select("fp", "key.*")
    key = ["pair", "x", "y"]
    shared = members.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(CHUNK // 2))
    met = members.join(shared, key).withColumn(
        "blocks", F.when(F.col("n") > CHUNK, blocks).otherwise(F.lit(1)))
    met = met.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    met = met.select("fp", *key, "own", F.explode(F.sequence(F.lit(0).cast("long"),
                                                             F.col("blocks") - 1)).alias("other"))
    met = met.select(*key, F.least("own", "other").alias("lo"),
                     F.greatest("own", "other").alias("hi"), "own", "fp")
    place = [*key, "lo", "hi"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None

        def work(p: pd.DataFrame) -> Iterator[pd.DataFrame]:
            """Whole places, in order: small ones together, cut ones each alone."""
            fp = p["fp"].to_numpy().view(np.uint64)
            cross = (p["lo"] != p["hi"]).to_numpy()
            codes = p[place].to_numpy()
            ends = np.flatnonzero(np.r_[(codes[1:] != codes[:-1]).any(axis=1), True]) + 1
            starts = np.r_[0, ends[:-1]]
            at = 0
            while at < len(starts):
                a, b = starts[at], ends[at]
                if cross[a]:
                    low = (p["own"].to_numpy()[a:b] == p["lo"].to_numpy()[a:b])
                    if low.any() and not low.all():
                        yield _link(fp[a:b][low], fp[a:b][~low], radius)
                    at += 1
                    continue
                to = at + 1
                while to < len(starts) and ends[to] - a <= CHUNK and not cross[starts[to]]:
                    to += 1
                yield _link(np.unique(fp[a:ends[to - 1]]), None, radius)
                at = to

        for frame in frames:
            p = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = (p[place] == p[place].iloc[-1]).all(axis=1).to_numpy()
            # The last place may go on in the next batch.
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut:
                yield from work(p.iloc[:cut])
            rest = p.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield from work(rest)

    dealt = met.repartition(*[F.col(c) for c in place]).sortWithinPartitions(*place)
    return dealt.mapInPandas(run, "a long, b long").distinct()


def stars(edges: DataFrame, name: str = "simhash-stars") -> DataFrame:
    """(a, root): every linked node and the smallest node that it is connected to."""
    def checksum(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                     .first())

    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), name)
    before = checksum(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours go to the smallest one around.
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"),
                                                             F.col("m").alias("b"))
        large = large.distinct()
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .filter("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = materialize(small, name)
        after = checksum(edges)
        if after == before:
            break
        before = after
    return edges.select("a", F.col("b").alias("root"))


def components(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, first, root): every fingerprint, its smallest id and its component's root."""
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")),
                           "simhash-distinct")
    root = stars(links(distinct, radius))
    return distinct.join(root, distinct["fp"] == root["a"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    fps = materialize(fingerprints(rows, "text", shingle_words).select(
        "doc_id", F.col("_fp").alias("fp")), "simhash-fingerprints")
    placed = components(fps, radius)
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The columns of ``docs`` for one row of each component: that of the smallest id."""
    return sheltered(docs, (doc_id, text), lambda d: _one_per_group(
        d, doc_id, text, shingle_words, radius))


def _one_per_group(docs: DataFrame, doc_id: str, text: str, shingle_words: int,
                   radius: int) -> DataFrame:
    rows = materialize(fingerprints(docs, text, shingle_words), "simhash-documents")
    keys = rows.select(F.col(doc_id).cast("long").alias("doc_id"), F.col("_fp").alias("fp"))
    placed = components(keys, radius)
    # One candidate a fingerprint before anything meets by component.
    by_root = Window.partitionBy("root").orderBy(F.col("first").asc_nulls_last(), "fp")
    chosen = placed.withColumn("nth", F.row_number().over(by_root)).filter("nth = 1").select(
        F.col("first").alias("_first"), F.col("fp").alias("_chosen"))
    kept = rows.join(chosen, (F.col("_fp") == F.col("_chosen"))
                     & F.col(doc_id).cast("long").eqNullSafe(F.col("_first")), "left_semi")
    # Rows that repeat both id and fingerprint are copies of each other.
    return kept.dropDuplicates([doc_id, "_fp"]).select(*docs.columns)
