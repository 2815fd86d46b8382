"""Language-model scoring by context-tree weighting over bytes.

A text is lower-cased (A-Z), its words are joined by single spaces and closed by
a line feed, and the bytes are coded one after the other.  A byte is eight binary
decisions; each of the 255 nodes of the byte's code tree has a context tree of
its own over the ``DEPTH`` bytes before.  A node of a context tree holds the
Krichevsky-Trofimov estimate of its bits, and its weighted probability is half
that estimate and half the product of its children's, so that a prediction mixes
the estimates of all depths on the path of its context.

Training texts only matter by their counts of (context, byte), so training is a
grouped sum.  Texts are cut into groups of bounded size; every group yields its
distinct (context, byte) keys and words, packed by part of the key space.  Sums
meet by part, context trees are weighed per pair of latest bytes (the two upper
levels are at most 257 x 255 numbers), and each group gets back the
log-probabilities of its own keys and the counts of those of its words that other
groups hold too.  No table of the whole model is ever sent anywhere.

The base score is the add-one unigram score of the tokens: the words, then one
end.

Defined results: a null or empty text is the end token alone; a row without an
id is scored, not learned from and not held out; repeated rows count and are
scored one by one; with nothing to learn from every bit costs one bit and the
base score is 0; an empty table gives an empty result; a text longer than a
group is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import fold, materialize, packed, unpacked

DEPTH = 5
GROUP_BYTES = 12 << 20
STRETCH = 1 << 20
#: Keys weighed in one task, about; those with the same two latest bytes stay together.
BUCKET_KEYS = 200_000
FOLDS, HELD_OUT = 7, 2
END = b"\n"

#: Text for which there is one more part of the key space.
PART_BYTES = 8 << 20

_DOCS, _GRAM, _WORD = 0, 1, 2
_ROWS = "kind int, g long, part long, blob binary"


# --- texts to keys ---------------------------------------------------------------
def tokens(text: str | None) -> list[bytes]:
    """Bytes lower-case A-Z alone and split at exactly the six ASCII white spaces."""
    return [*(text or "").encode().lower().split(), END]


def coded(words: list[bytes]) -> bytes:
    return b" ".join(words[:-1]) + END


class Words:
    """The words of coded texts, told apart by number."""

    def __init__(self, texts: list[bytes]):
        lines = pc.binary_slice(pa.array(texts, pa.large_binary()), 0, -len(END))
        split = pc.split_pattern(lines, b" ")
        n = pc.list_value_length(split).to_numpy().copy()
        # A text without words splits into one empty one.
        n[np.fromiter((t == END for t in texts), bool, len(texts))] = 0
        self.doc = np.repeat(np.arange(len(texts)), n)
        flat = pc.list_flatten(split)
        coded = flat.filter(pc.not_equal(flat, b"")).dictionary_encode()
        self.number, self.distinct = coded.indices.to_numpy(), coded.dictionary
        self.n = n


def keys_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    """(context, byte) keys of all bytes in order: latest context byte on top, byte below."""
    stream = np.frombuffer(b"".join(bytes(DEPTH) + t for t in texts), np.uint8)
    starts = np.cumsum([0] + [len(t) + DEPTH for t in texts])[:-1]
    real = np.ones(len(stream), bool)
    real[(starts[:, None] + np.arange(DEPTH)).ravel()] = False
    for first in range(DEPTH, len(stream), STRETCH):
        last = min(first + STRETCH, len(stream))
        key = stream[first:last].astype(np.int64)
        for j in range(1, DEPTH + 1):
            key |= stream[first - j:last - j].astype(np.int64) << (8 * (DEPTH - j + 1))
        yield key[real[first:last]]


def counted(parts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts over arrays of keys."""
    got = [np.unique(p, return_counts=True) for p in parts]
    if not got:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return summed(np.concatenate([k for k, _ in got]), np.concatenate([c for _, c in got]))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else []
    return (keys[first], np.add.reduceat(counts, first)) if len(keys) else (keys, counts)


# --- estimates --------------------------------------------------------------------
def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at ``x + 8``, carried back by the recurrence."""
    y = x + 8.0
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * y * y)) / (y * y)) / (y * y)) / y
    back = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - back


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a run with these counts."""
    return (log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi)
            - log_gamma(zeros + ones + 1.0))


def _nodes(context_byte: np.ndarray, j: int) -> np.ndarray:
    """Context and the first ``j`` bits of the byte, with a leading one."""
    return (context_byte & ~np.int64(0xFF)) | (1 << j) | ((context_byte & 0xFF) >> (8 - j))


def _at_depth(key: np.ndarray, depth: int) -> np.ndarray:
    return (key >> (8 * (DEPTH - depth + 1)) << 8) | (key & 0xFF)


class Trees:
    """The context trees of depth 2 and more under some pairs of latest bytes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.levels: dict[tuple[int, int], tuple] = {}
        seen = counts > 0
        keys, counts = keys[seen], counts[seen].astype(np.float64)
        below: dict[int, tuple] = {}
        for depth in range(DEPTH, 1, -1):
            pair, n = summed(_at_depth(keys, depth), counts)
            for j in range(8):
                node = _nodes(pair, j)
                first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) \
                    else np.zeros(0, int)
                one = (pair >> (7 - j)) & 1
                if len(node):
                    n1 = np.add.reduceat(n * one, first)
                    n0 = np.add.reduceat(n * (1 - one), first)
                else:
                    n0 = n1 = np.zeros(0)
                node = node[first]
                own = log_kt(n0, n1)
                if depth == DEPTH:
                    weighted, stop = own, np.ones(len(node))
                else:
                    child, value = below[j]
                    parent = np.searchsorted(node, (child >> 16 << 8) | (child & 0xFF))
                    split = np.bincount(parent, weights=value, minlength=len(node))
                    weighted = np.logaddexp(own, split) - np.log(2)
                    stop = np.exp(own - np.log(2) - weighted)
                below[j] = (node, weighted)
                self.levels[depth, j] = (node, n0, n1, stop, weighted)

    def tops(self) -> pd.DataFrame:
        """The nodes of depth 2, for the levels above them."""
        parts = [pd.DataFrame({"latest": node >> 16, "p": node & 0xFF, "zeros": n0, "ones": n1, "weighted": w})
                 for node, n0, n1, _, w in (self.levels[2, j] for j in range(8))]
        return pd.concat(parts, ignore_index=True)

    def log_probability(self, keys: np.ndarray, upper: Upper) -> np.ndarray:
        """Natural log of the probability of each key's byte in its context."""
        out = np.zeros(len(keys))
        latest = keys >> (8 * DEPTH) & 0xFF
        for j in range(8):
            bit = (keys >> (7 - j)) & 1
            p = np.full(len(keys), 0.5)
            for depth in range(DEPTH, 1, -1):
                node, n0, n1, stop, _ = self.levels[depth, j]
                if not len(node):
                    continue
                want = _nodes(_at_depth(keys, depth), j)
                at = np.minimum(np.searchsorted(node, want), len(node) - 1)
                kt = (np.where(bit == 1, n1[at], n0[at]) + 0.5) / (n0[at] + n1[at] + 1.0)
                p = np.where(node[at] == want, stop[at] * kt + (1 - stop[at]) * p, 0.5)
            prefix = (1 << j) | ((keys & 0xFF) >> (8 - j))
            for row in (latest + 1, np.zeros(len(keys), np.int64)):
                n0, n1, stop = (t[row, prefix] for t in (upper.zeros, upper.ones, upper.stop))
                kt = (np.where(bit == 1, n1, n0) + 0.5) / (n0 + n1 + 1.0)
                p = np.where(n0 + n1 > 0, stop * kt + (1 - stop) * p, 0.5)
            out += np.log(p)
        return out


class Upper:
    """Depths 0 (row 0) and 1 (row 1 + latest byte) of all context trees."""

    def __init__(self, depth1: pd.DataFrame):
        self.zeros, self.ones = np.zeros((257, 256)), np.zeros((257, 256))
        split = np.zeros((257, 256))
        row, p = depth1["latest"].to_numpy() + 1, depth1["p"].to_numpy()
        self.zeros[row, p], self.ones[row, p] = depth1["zeros"], depth1["ones"]
        split[row, p] = depth1["weighted"]
        self.zeros[0], self.ones[0] = self.zeros[1:].sum(axis=0), self.ones[1:].sum(axis=0)
        own = log_kt(self.zeros, self.ones)
        weighted = np.where(self.zeros + self.ones > 0, np.logaddexp(own, split) - np.log(2), 0)
        split[0] = weighted[1:].sum(axis=0)
        weighted[0] = np.logaddexp(own[0], split[0]) - np.log(2)
        self.stop = np.exp(own - np.log(2) - weighted)


# --- Spark stages -------------------------------------------------------------------
def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
    names = [f.split()[0] for f in _ROWS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 4, types)], names=names)


def _packed_keys(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Sorted keys as steps, which compress well, and their values."""
    return packed(pa.table({"step": np.diff(keys, prepend=0), "value": values}))


def _unpacked_keys(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    t = unpacked(blob)
    return np.cumsum(t["step"].to_numpy()), t["value"].to_numpy()


def by_part_of_keys(keys: np.ndarray, parts: int) -> list[np.ndarray]:
    """For every part of the key space the places of its keys, in order."""
    part = keys % parts
    order = np.argsort(part, kind="stable")
    return np.split(order, np.searchsorted(part[order], np.arange(1, parts)))


def grouped_texts(docs: DataFrame, parts: int, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Per group its texts, and per part of the key space its keys and its words.

    ``docs`` has id, text and learn (whether to learn from the row).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, size = TaskContext.get().partitionId() << 24, 0
        ids, texts, learn = [], [], []

        def flush():
            yield _batch([(_DOCS, g, None, packed(pa.table({
                "id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.binary()),
                "learn": learn})))])
            words = Words(texts)
            trained = np.array(learn)
            n = np.bincount(words.number[trained[words.doc]], minlength=len(words.distinct))
            # The end token is one more word.
            distinct = pa.concat_arrays([words.distinct, pa.array([END], pa.large_binary())])
            n = np.append(n, trained.sum()).astype(np.int64)
            order = pc.sort_indices(distinct).to_numpy()
            part = np.fromiter((crc32(w) % parts for w in distinct.take(order).to_pylist()),
                               np.int64, len(order))
            yield _batch([(_WORD, g, k, packed(pa.table({
                "word": distinct.take(order[part == k]), "n": n[order[part == k]]})))
                for k in np.unique(part).tolist()])
            found = [counted(keys_of([t for t, x in zip(texts, learn) if x == y]))
                     for y in (True, False)]
            keys, n = summed(np.concatenate([found[0][0], found[1][0]]),
                             np.concatenate([found[0][1], 0 * found[1][1]]))
            yield _batch([(_GRAM, g, part, _packed_keys(keys[i], n[i]))
                          for part, i in enumerate(by_part_of_keys(keys, parts)) if len(i)])

        for b in batches:
            for i, text, train in zip(b.column(0).to_pylist(), b.column(1),
                                      b.column(2).to_pylist()):
                ids.append(i)
                texts.append(coded(tokens(text.as_py())))
                learn.append(bool(train))
                size += len(texts[-1])
                if size >= group_bytes:
                    yield from flush()
                    g, size = g + 1, 0
                    ids, texts, learn = [], [], []
        if ids:
            yield from flush()

    return docs.select("id", "text", "learn").mapInArrow(run, _ROWS)


def _sum_grams(t: pa.Table) -> pa.Table:
    got = [_unpacked_keys(b.as_py()) for b in t["blob"]]
    keys, n = summed(np.concatenate([k for k, _ in got]),
                     np.concatenate([n for _, n in got]))
    return pa.table({"key": keys, "n": n})


def _values_back(rows: pa.Table, values: pa.Table) -> pa.Table:
    """For every group its keys of one part with their values."""
    keys, value = values["key"].to_numpy(), values["value"].to_numpy().astype(np.float32)
    order = np.argsort(keys)
    keys, value = keys[order], value[order]
    out = []
    for g, blob in zip(rows["g"].to_pylist(), rows["blob"]):
        own, _ = _unpacked_keys(blob.as_py())
        out.append((_GRAM, g, None,
                    _packed_keys(own, value[np.searchsorted(keys, own)])))
    return pa.Table.from_batches([_batch(out)])


def _words_back(t: pa.Table) -> pa.Table:
    """For every group's words of one part their counts, where other groups hold them too.

    One more row, of no group, has the sums of the part.
    """
    held = [unpacked(b.as_py()) for b in t["blob"]]
    coded = pa.concat_tables(held)["word"].combine_chunks().dictionary_encode()
    number = coded.indices.to_numpy()
    n = np.concatenate([x["n"].to_numpy() for x in held])
    total = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(total, number, n)
    shared = (np.bincount(number) > 1) & (total > 0)
    out, at = [], 0
    for g, x in zip(t["g"].to_pylist(), held):
        own = number[at:at + len(x)]
        at += len(x)
        out.append((_WORD, g, None, packed(pa.table({
            "word": x["word"].filter(pa.array(shared[own])),
            "n": total[own[shared[own]]]})), 0, 0))
    out.append((_WORD, None, None, None, int(total.sum()), int((total > 0).sum())))
    table = pa.Table.from_batches([_batch([r[:4] for r in out])])
    for k, name in ((4, "tokens"), (5, "vocabulary")):
        table = table.append_column(name, pa.array([r[k] for r in out], pa.int64()))
    return table


def _tops(t: pa.Table) -> pa.Table:
    trees = Trees(t["key"].to_numpy(), t["n"].to_numpy())
    out = trees.tops().groupby(["latest", "p"], as_index=False).sum()
    return pa.Table.from_pandas(out[["latest", "p", "zeros", "ones", "weighted"]],
                                preserve_index=False)


def log_probabilities(per_key: DataFrame) -> DataFrame:
    """(key, value) for every row of ``per_key`` (key, n): n counts in training."""
    # All keys with the same two latest bytes are weighed together.
    buckets = 1 + per_key.count() // BUCKET_KEYS
    dealt = per_key.withColumn("bucket", F.pmod(F.xxhash64(F.shiftright(
        "key", 8 * (DEPTH - 1))), F.lit(buckets)))
    depth1 = (dealt.groupBy("bucket").applyInArrow(
        _tops, "latest long, p long, zeros double, ones double, weighted double")
        .groupBy("latest", "p").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")]))
    # At most 256 x 255 rows, whatever the corpus.
    upper = Upper(depth1.toPandas())

    def weigh(t: pa.Table) -> pa.Table:
        keys = t["key"].to_numpy()
        trees = Trees(keys, t["n"].to_numpy())
        return pa.table({"key": keys, "value": trees.log_probability(keys, upper)})

    return dealt.groupBy("bucket").applyInArrow(weigh, "key long, value double")


class Lookup:
    """Values by key, in an open table four times as large as the keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(
            1 << bits, values.dtype)
        at = self.place(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            own = self.keys[at] == keys
            self.values[at[own]] = values[own]
            keys, values, at = keys[~own], values[~own], (at[~own] + 1) & self.mask

    def place(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(
                np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The values of keys that are all present."""
        at = self.place(keys)
        out = self.values[at]
        miss = np.flatnonzero(self.keys[at] != keys)
        while len(miss):
            at[miss] = (at[miss] + 1) & self.mask
            out[miss] = self.values[at[miss]]
            miss = miss[self.keys[at[miss]] != keys[miss]]
        return out


def _scores(texts: list[bytes], grams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability and length of every text, from the group's keys and values."""
    got = [_unpacked_keys(b) for b in grams]
    lookup = Lookup(np.concatenate([k for k, _ in got]), np.concatenate([v for _, v in got]))
    del got
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends, at, score = np.cumsum(sizes), 0, np.zeros(len(texts))
    for k in keys_of(texts):
        if not len(k):
            continue
        # The texts that these bytes belong to; none is empty.
        first, last = np.searchsorted(ends, (at, at + len(k) - 1), side="right")
        starts = np.maximum((ends - sizes)[first:last + 1] - at, 0)
        score[first:last + 1] += np.add.reduceat(lookup(k), starts, dtype=float)
        at += len(k)
    return score / np.log(10), sizes


def score(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` per row.

    Scores are log10 probabilities; the model learns from rows where ``learn`` holds.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Odd, so that keys fall evenly by their remainder.
    parts = 1 + 2 * (size // (2 * PART_BYTES))
    rows = materialize(grouped_texts(docs, parts), "ctw-groups")
    grams, words = (rows.filter(F.col("kind") == k) for k in (_GRAM, _WORD))
    per_key = materialize(grams.select("part", "blob").groupBy("part").applyInArrow(
        _sum_grams, "key long, n long"), "ctw-keys")
    values = log_probabilities(per_key).withColumn("part", F.col("key") % F.lit(parts))
    values = grams.select("part", "g", "blob").groupBy("part").cogroup(
        values.groupBy("part")).applyInArrow(_values_back, _ROWS)
    counts = materialize(words.select("part", "g", "blob").groupBy("part").applyInArrow(
        _words_back, f"{_ROWS}, tokens long, vocabulary long"), "ctw-words")
    n_train, vocabulary = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)),
                                     F.coalesce(F.sum("vocabulary"), F.lit(0))).first()
    own = ["kind", "g", "blob"]
    parts_of_group = (rows.filter(F.col("kind") == _DOCS).select(own)
                      .unionByName(values.select(own))
                      .unionByName(counts.filter("g is not null").select(own)))
    unseen = n_train + vocabulary + 1

    def run(t: pa.Table) -> pa.Table:
        blobs: dict[int, list] = {_DOCS: [], _GRAM: [], _WORD: []}
        for kind, blob in zip(t["kind"].to_pylist(), t["blob"]):
            blobs[kind].append(blob.as_py())
        table = unpacked(blobs[_DOCS][0])
        texts, trained = table["text"].to_pylist(), table["learn"].to_numpy()
        words = Words(texts)
        # Words that no other group holds have the count they have here.
        count = np.bincount(words.number[trained[words.doc]], minlength=len(words.distinct))
        ends = int(trained.sum())
        place = dict(zip(words.distinct.to_pylist(), range(len(words.distinct))))
        for b in blobs[_WORD]:
            x = unpacked(b)
            for w, n in zip(x["word"].to_pylist(), x["n"].to_pylist()):
                if w == END:
                    ends = n
                else:
                    count[place[w]] = n
        n_tokens = words.n + 1
        n_known = np.bincount(words.doc[count[words.number] > 0], minlength=len(texts)) + (ends > 0)
        base = (np.bincount(words.doc, np.log10((count[words.number] + 1.0) / unseen), len(texts))
                + np.log10((ends + 1.0) / unseen))
        del words, place, count
        score, sizes = _scores(texts, blobs[_GRAM])
        return pa.table({
            "doc_id": table["id"], "n_tokens": n_tokens.astype(np.int64),
            "n_known": n_known.astype(np.int64),
            "train_tokens": np.full(len(texts), n_train, np.int64),
            "base_score": base, "score": score,
            "bits_per_byte": -score * np.log2(10) / sizes})

    return parts_of_group.groupBy("g").applyInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double, bits_per_byte double")


def held_out(doc_id: str = "doc_id", folds: int = FOLDS, which: int = HELD_OUT) -> Column:
    return F.coalesce(fold(doc_id, folds) == which, F.lit(False))
