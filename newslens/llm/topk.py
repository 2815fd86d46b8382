"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors become sparse integer rows (``floor(scale * x)``; a zero component has
no posting).  They are gathered into blocks of bounded size, written once.  A
query block meets every candidate block: for each term the query weights are
scattered along the term's postings into a dense array of scores, one row per
query of the block.  Partition selection keeps the best ``k`` of each block
pair and a grouped merge keeps the best ``k`` overall, ties to the smaller id.

The query set is a stated share of the rows, so the work is queries x rows; it
is dealt as (query block, candidate block) pairs, and no task or driver ever
holds more than one pair.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows without an id; rows that repeat an id are candidates
of their own for other queries, never for their own id, and a repeated query id
answers with its smallest vector in array order; vectors of unequal length
count missing components as zero; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm.common import materialize

SCALE = 64
K = 20
CANDIDATE_ROWS = 8192
QUERY_ROWS = 512
TILE = 16
RUN = 2048
#: Lists that cover more of a block than this are added as a whole.
DENSE = 0.1

_BLOCK = "n long, ids binary, dims binary, rows binary, weights binary"


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` per component, each taken as double first."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """No null and no non-finite component."""
    def bad(x):
        d = x.cast("double")
        return x.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """(block, postings by term) of at most ``rows`` vectors each."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vecs = [], []

        def flush(m):
            take_ids, take = ids[:m], vecs[:m]
            del ids[:m], vecs[:m]
            sizes = np.fromiter((len(v) for v in take), np.int64, len(take))
            flat = np.concatenate([np.asarray(v, np.int64) for v in take]) if sizes.sum() \
                else np.zeros(0, np.int64)
            row = np.repeat(np.arange(len(take)), sizes)
            dim = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = np.flatnonzero(flat)
            order = keep[np.argsort(dim[keep], kind="stable")]
            return pd.DataFrame({"n": [len(take)], "ids": [np.array(take_ids, "<i8").tobytes()],
                                 "dims": [dim[order].astype("<i4").tobytes()],
                                 "rows": [row[order].astype("<i4").tobytes()],
                                 "weights": [flat[order].astype("<i8").tobytes()]})

        for pdf in batches:
            ids.extend(pdf["id"].tolist())
            vecs.extend(pdf["v"].tolist())
            while len(ids) >= rows:
                yield flush(rows)
        if ids:
            yield flush(len(ids))

    return vectors.mapInPandas(pack, _BLOCK)


def _postings(dims, rows, weights) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    dims = np.frombuffer(dims, "<i4")
    rows, weights = np.frombuffer(rows, "<i4"), np.frombuffer(weights, "<i8")
    starts = np.flatnonzero(np.r_[True, dims[1:] != dims[:-1]]) if len(dims) else []
    return {int(dims[a]): (rows[a:b], weights[a:b])
            for a, b in zip(starts, np.r_[starts[1:], len(dims)].astype(int))}


def accumulate(query: dict, n_query: int, cand: dict, n_cand: int) -> Iterator[tuple]:
    """(first query, scores) tiles; scores has one dense row per query.

    Candidates are passed in runs that stay in the processor's cache.
    """
    largest = sum(int(np.abs(query[t][1]).max()) * int(np.abs(cand[t][1]).max())
                  for t in query if t in cand)
    kind = np.int32 if largest < 2**31 else np.int64
    terms = []
    for t, (r, w) in query.items():
        if t in cand:
            dense = np.zeros((n_query, 1), kind)
            dense[r, 0] = w
            rows, weights = cand[t][0], cand[t][1].astype(kind)
            if len(rows) > n_cand * DENSE:
                # A long list is laid out with its gaps: adding zeros beats scattering.
                line = np.zeros(n_cand, kind)
                line[rows] = weights
                rows, weights = np.arange(n_cand), line
            terms.append((dense, rows, weights))
    for first in range(0, n_query, TILE):
        m = min(TILE, n_query - first)
        scores = np.zeros((m, n_cand), kind)
        for low in range(0, n_cand, RUN):
            high = min(low + RUN, n_cand)
            run = np.zeros((m, high - low), kind)
            part = np.empty_like(run)
            for dense, rows, weights in terms:
                a, b = np.searchsorted(rows, (low, high))
                if b - a == high - low:
                    np.multiply(dense[first:first + m], weights[a:b], out=part)
                    run += part
                else:
                    run[:, rows[a:b] - low] += dense[first:first + m] * weights[a:b]
            scores[:, low:high] = run
        yield first, scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, ties to the smaller id, in that order."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= floor)
    else:
        keep = np.arange(len(scores))
    order = np.lexsort((ids[keep], -scores[keep].astype(np.int64)))[:k]
    return ids[keep][order], scores[keep][order]


def top_k(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id",
          vector: str = "embedding", k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row where ``is_query`` holds."""
    rows = vectors.filter(F.col(vec_id).isNotNull() & usable(F.col(vector)))
    ints = rows.select(F.col(vec_id).cast("long").alias("id"),
                       quantised(F.col(vector), scale).alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("q"))
    cand = materialize(_blocks(ints.select("id", "v"), CANDIDATE_ROWS).withColumn(
        "cb", F.monotonically_increasing_id()), "topk-candidates")
    queries = ints.filter("q").groupBy("id").agg(F.min("v").alias("v"))
    qblocks = materialize(_blocks(queries, QUERY_ROWS).withColumn(
        "qb", F.monotonically_increasing_id()), "topk-queries")
    # Every query block is sent to every candidate block under that block's key;
    # the list of keys is one number per few thousand vectors.
    keys = cand.agg(F.collect_list("cb").alias("keys"))
    sent = (qblocks.withColumn("one", F.lit(1))
            .join(keys.withColumn("one", F.lit(1)), "one")
            .select("qb", *[F.col(c).alias(f"q_{c}") for c in ("n", "ids", "dims", "rows",
                                                               "weights")],
                    F.explode("keys").alias("cb")))
    pairs = sent.join(cand, "cb").drop("qb", "cb", "one")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf.itertuples(index=False):
                q_ids, c_ids = np.frombuffer(p.q_ids, "<i8"), np.frombuffer(p.ids, "<i8")
                query = _postings(p.q_dims, p.q_rows, p.q_weights)
                cand_postings = _postings(p.dims, p.rows, p.weights)
                out = []
                for first, scores in accumulate(query, p.q_n, cand_postings, p.n):
                    for i, line in enumerate(scores):
                        q = q_ids[first + i]
                        own = c_ids == q
                        i_ids, i_scores = (c_ids[~own], line[~own]) if own.any() \
                            else (c_ids, line)
                        got, value = best(i_scores, i_ids, k)
                        out.append((np.full(len(got), q), got, value.astype(np.int64)))
                yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"),
                                            map(np.concatenate, zip(*out)))))

    found = pairs.mapInPandas(score, "query_id long, vec_id long, score long")

    return _merged(found, k)


def _merged(found: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast(T.IntegerType()).alias("rank"),
                    "vec_id", "score"))
