"""Removal of repeated passages by bounded interval expansion on a BWT.

A byte goes if it lies in a string of ``length`` bytes (``LENGTH`` unless asked
otherwise) that also starts anywhere else.  Bringing equal strings together, then telling which are equal:

1. Every window of ``length`` bytes has an anchor: of the ``ANCHOR``-byte strings
   inside it, the leftmost of the smallest hash.  Equal windows have equal
   anchors at equal places.  Windows that follow each other and share an anchor
   form a run, so there is a run for every hundred bytes or two; only (anchor
   hash, content hash, place) of a run leaves the task, while the texts stay in
   compressed groups of bounded size.
2. Anchors that occur once hold nothing repeated.  Runs of equal content are one
   run with a count; if an anchor has no other, all of its windows are repeated.
3. For the other anchors the distinct runs' bytes are fetched and dealt to
   buckets of bounded size by anchor.  All runs of an anchor are aligned at it,
   so a bucket's bytes are read as symbols of ``BLOCK`` bytes counted from the
   anchor.  From the Burrows-Wheeler transform of the bucket, breadth-first
   backward extension of intervals sets the common-prefix lengths in increasing
   order and stops at the number of whole symbols that any window covers; what
   is not set by then is repeated.  Windows over repeated symbols are checked to
   the byte by their hash.
4. Anchors with more distinct runs than ``MAX_VARIANTS`` would make a bucket grow;
   the hashes of their windows are counted by Spark instead.
5. Each group gets the repeated stretches of its own runs and removes them.

Hashes are 64 bits wide; contents are compared by (anchor hash, content hash).

Defined results: a null text is empty; texts shorter than ``length`` keep every
byte; rows are judged one by one, so repeated rows repeat each other; a text
longer than a group is a group of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm.common import materialize, packed, unpacked

LENGTH = 400
ANCHOR = 96
BLOCK = 8
GROUP_BYTES = 16 << 20
#: Windows of one text that are looked at together.
STRETCH = 1 << 18
BUCKET_BYTES = 4 << 20
MAX_VARIANTS = 8192

_PLACE_BITS, _RUN_BITS = 20, 27
_BASE = 0x9E3779B97F4A7C15


# --- hashes of all strings of one length ---------------------------------------------
class Rolling:
    """Hashes of all substrings of a byte string by wrapping polynomial prefix sums."""

    def __init__(self, data: np.ndarray):
        with np.errstate(over="ignore"):
            n = len(data)
            values = np.random.default_rng(20260).integers(1, 1 << 63, 256, dtype=np.uint64)
            inverse = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            self.power = np.full(n + 1, _BASE, np.uint64)
            inverse[:1], self.power[0] = 1, 1
            inverse = np.multiply.accumulate(inverse)
            self.power = np.multiply.accumulate(self.power)
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values[data] * inverse, out=self.sums[1:])

    def at(self, starts, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            if isinstance(starts, slice):
                first = self.sums[starts]
                h = (self.sums[length:length + len(first)] - first) * self.power[starts]
            else:
                h = (self.sums[starts + length] - self.sums[starts]) * self.power[starts]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return h ^ (h >> np.uint64(29))


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from block-wise running minima."""
    pad = np.full(-len(v) % width, np.iinfo(v.dtype).max, v.dtype)
    rows = np.concatenate([v, pad]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(v) - width + 1
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchored_runs(text: bytes, length: int, anchor: int
                  ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first window, windows, anchor's place, anchor hash) of the runs of a text."""
    data = np.frombuffer(text, np.uint8)
    for base in range(0, len(data) - length + 1, STRETCH):
        part = data[base:base + STRETCH + length - 1]
        hashes = Rolling(part).at(slice(0, len(part) - anchor + 1), anchor)
        # Hash above, place below: the least is the leftmost of the smallest.
        low = np.uint64((1 << _PLACE_BITS) - 1)
        least = sliding_min((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64),
                            length - anchor + 1)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        place = (least[first] & low).astype(np.int64)
        yield (base + first, np.diff(np.r_[first, len(least)]), base + place, hashes[place])


# --- bounded interval expansion ---------------------------------------------------------
def suffix_order(symbols: np.ndarray, length: int) -> np.ndarray:
    """Suffixes ordered by their first ``length`` symbols at least, by prefix doubling."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    step = 1
    key = symbols
    while True:
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
        if step >= length or rank[order[-1]] == n - 1:
            return order
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        step *= 2


def repeated(symbols: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` symbols from each position on also start elsewhere.

    Beller, Gog, Ohlebusch and Schnattinger's computation of the common-prefix
    array from the transform alone, stopped at ``length``.  Texts are told apart
    by symbols that occur once.
    """
    n = len(symbols)
    order = suffix_order(symbols, length)
    bwt = symbols[order - 1]
    back = np.empty(n, np.int64)
    back[np.argsort(bwt, kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        size = high - low
        owner = np.repeat(np.arange(len(low)), size)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner]
        to, symbol = back[at], bwt[at]
        line = np.argsort(to)
        to, symbol, owner = to[line], symbol[line], owner[line]
        first = np.flatnonzero(np.r_[True, (symbol[1:] != symbol[:-1])
                                     | (owner[1:] != owner[:-1])])
        low, high = to[first], to[np.r_[first[1:], len(to)] - 1] + 1
        new = ~known[high]
        low, high = low[new], high[new]
        if not len(low):
            break
        known[high] = True
    out = np.zeros(n, bool)
    out[order] = ~known[:-1] | ~known[1:]
    return out


def repeated_windows(contents: list[bytes], places: list[int],
                     length: int) -> list[np.ndarray]:
    """Per run of windows of ``length`` bytes, which of them occur again in these runs.

    ``places`` are the anchors' places in the contents.
    """
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    offsets = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(contents), np.uint8)
    lead = np.asarray(places, np.int64) % BLOCK
    blocks = (sizes - lead) // BLOCK
    # One symbol more per content, of its own, ends it.
    base = np.cumsum(blocks + 1) - (blocks + 1)
    owner = np.repeat(np.arange(len(contents)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = offsets[owner] + lead[owner] + nth * BLOCK
    words = np.zeros(len(start), np.uint64)
    for b in range(BLOCK):
        words |= data[start + b].astype(np.uint64) << np.uint64(8 * b)
    symbols = np.empty(len(owner) + len(contents), np.int64)
    codes, inverse = np.unique(words, return_inverse=True)
    symbols[base[owner] + nth] = inverse
    symbols[base + blocks] = len(codes) + np.arange(len(contents))
    # A window of any alignment covers so many whole symbols.
    flagged = repeated(symbols, (length - BLOCK + 1) // BLOCK)

    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(contents)), windows)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    block = base[owner] + np.maximum(0, -((lead[owner] - nth) // BLOCK))
    likely = np.flatnonzero(flagged[block])
    hashes = Rolling(data).at(offsets[owner[likely]] + nth[likely], length)
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    out = np.zeros(len(owner), bool)
    out[likely] = counts[inverse] > 1
    return np.split(out, np.cumsum(windows)[:-1])


def stretches(flags: np.ndarray) -> np.ndarray:
    """First and last place of every run of true flags, as one flat array."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    edge[1::2] -= 1
    return edge


# --- Spark stages ---------------------------------------------------------------------
_GROUPS = "g long, docs binary, runs binary, anchor long, content long, run long"


def grouped_runs(docs: DataFrame, text: str, length: int,
                 anchor_bytes: int) -> DataFrame:
    """Groups (documents and places of their runs) and rows of runs, in one pass."""
    names = [f.split()[0] for f in _GROUPS.split(", ")]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        g = TaskContext.get().partitionId() << 16

        def flush(rows: pa.Table):
            parts, contents = [], []
            for d, value in enumerate(rows[text]):
                data = value.as_py()
                view = memoryview(data)
                for first, windows, place, anchor in anchored_runs(
                        data, length, anchor_bytes):
                    parts.append((np.full(len(first), d), first, windows, place, anchor))
                    contents.extend(xxh3_64_intdigest(view[a:a + n + length - 1])
                                    for a, n in zip(first.tolist(), windows.tolist()))
            doc, first, windows, place, anchor = (
                map(np.concatenate, zip(*parts)) if parts else [np.zeros(0, np.int64)] * 5)
            runs = pa.table({"doc": doc, "first": first, "windows": windows, "place": place})
            n = len(contents)
            values = [[g], [packed(rows)], [packed(runs)], None, None, None]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, t) if v is None else pa.array(v, t)
                 for v, t in zip(values, types)], names=names)
            values = [None, None, None, anchor.astype(np.uint64).view(np.int64),
                      np.array(contents, np.uint64).view(np.int64),
                      (g << _RUN_BITS) + np.arange(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, t) if v is None else pa.array(v, t)
                 for v, t in zip(values, types)], names=names)

        held, size = [], 0
        for batch in batches:
            at = batch.schema.get_field_index(text)
            sizes = pc.binary_length(batch.column(at)).to_pylist()
            begin = 0
            for i, n in enumerate(sizes):
                size += n
                if size >= GROUP_BYTES:
                    held.append(batch.slice(begin, i + 1 - begin))
                    yield from flush(pa.Table.from_batches(held))
                    g, held, size, begin = g + 1, [], 0, i + 1
            if begin < len(sizes):
                held.append(batch.slice(begin))
        if held:
            yield from flush(pa.Table.from_batches(held))

    return docs.mapInArrow(scan, _GROUPS)


def _fetch(t: pa.Table, length: int) -> pa.Table:
    """Bytes of the wanted runs of one group; window hashes for those of crowded anchors."""
    wanted = t.filter(pc.is_valid(t["run"])).to_pylist()
    group = t.filter(pc.is_valid(t["docs"]))
    out: dict[str, list] = {k: [] for k in ("anchor", "content", "n", "place", "bytes", "hashes")}
    if wanted:
        texts = unpacked(group["docs"][0].as_py()).column(0)
        runs = unpacked(group["runs"][0].as_py())
        runs = [runs[c].to_numpy() for c in ("doc", "first", "windows", "place")]
        for w in wanted:
            doc, first, windows, place = (int(c[w["run"] & ((1 << _RUN_BITS) - 1)]) for c in runs)
            data = texts[doc].as_buffer()[first:first + windows + length - 1].to_pybytes()
            for k in ("anchor", "content", "n"):
                out[k].append(w[k])
            out["place"].append(place - first)
            out["bytes"].append(None if w["crowded"] else data)
            out["hashes"].append(Rolling(np.frombuffer(data, np.uint8)).at(
                slice(0, windows), length).view(np.int64) if w["crowded"] else None)
    return pa.table({"anchor": pa.array(out["anchor"], pa.int64()),
                     "content": pa.array(out["content"], pa.int64()),
                     "n": pa.array(out["n"], pa.int64()),
                     "place": pa.array(out["place"], pa.int64()),
                     "bytes": pa.array(out["bytes"], pa.binary()),
                     "hashes": pa.array(out["hashes"], pa.list_(pa.int64()))})


def _compare(t: pa.Table, length: int) -> pa.Table:
    """Repeated stretches of the runs of one bucket; null stands for all windows."""
    contents = t["bytes"].to_pylist()
    found = [stretches(f).astype(np.int32)
             for f in repeated_windows(contents, t["place"].to_pylist(), length)]
    whole = [n > 1 for n in t["n"].to_pylist()]
    out = pa.table({"anchor": t["anchor"], "content": t["content"],
                    "spans": pa.array([None if w else f for w, f in zip(whole, found)],
                                      pa.list_(pa.int32()))})
    return out.filter(pa.array([w or len(f) > 0 for w, f in zip(whole, found)], pa.bool_()))


def repeated_spans(rows: DataFrame, length: int) -> DataFrame:
    """(anchor, content, spans): the repeated windows of every run content that has any."""
    runs = rows.filter("run is not null").select("anchor", "content", "run")
    per_content = runs.groupBy("anchor", "content").agg(F.count("*").alias("n"),
                                                        F.min("run").alias("run"))
    per_anchor = per_content.groupBy("anchor").agg(F.count("*").alias("kinds"),
                                                   F.sum("n").alias("total"))
    shared = materialize(per_content.join(per_anchor.filter("total > 1"), "anchor")
                         .drop("total"), "repeats-shared")
    whole = shared.filter("kinds = 1").select("anchor", "content",
                                              F.lit(None).cast("array<int>").alias("spans"))
    wanted = shared.filter("kinds > 1").select(
        F.shiftright("run", _RUN_BITS).alias("g"), "anchor", "content", "n", "run",
        (F.col("kinds") > MAX_VARIANTS).alias("crowded"))
    groups = rows.filter("docs is not null").select("g", "docs", "runs")
    fetched = materialize(
        wanted.unionByName(groups, allowMissingColumns=True).groupBy("g").applyInArrow(
            lambda t: _fetch(t, length), "anchor long, content long, n long, place long, bytes binary, "
                    "hashes array<long>"), "repeats-fetched")
    plain = fetched.filter("bytes is not null")
    total = plain.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(1 + total // BUCKET_BYTES))
    compared = plain.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(
        lambda t: _compare(t, length), "anchor long, content long, spans array<int>")
    crowded = fetched.filter("hashes is not null")
    windows = crowded.select("anchor", "content", "n", F.posexplode("hashes").alias("at", "hash"))
    again = windows.groupBy("hash").agg(F.count("*").alias("times")).filter("times > 1")
    hit = (windows.join(again, "hash").groupBy("anchor", "content")
           .agg(F.collect_list("at").alias("at")))
    counted = (crowded.select("anchor", "content", "n").join(hit, ["anchor", "content"], "left")
               .filter("n > 1 or at is not null")
               .select("anchor", "content", F.when(F.col("n") == 1, F.flatten(F.transform(
                   "at", lambda x: F.array(x, x)))).alias("spans")))
    return whole.unionByName(compared).unionByName(counted)


def remove_repeats(docs: DataFrame, text: str = "text", keep: tuple = ("doc_id",),
                   with_kept: bool = False, length: int | None = None,
                   anchor_bytes: int | None = None) -> DataFrame:
    """Strings of ``length`` bytes (``LENGTH``) that also start elsewhere are removed.

    Every window of that length is anchored by a string of ``anchor_bytes`` (``ANCHOR``)
    inside it; the anchor changes the work, not the result.
    Returns the columns ``keep`` with ``n_bytes, n_removed, n_spans, kept_sha256`` per row.

    ``with_kept`` adds the remaining bytes as the text ``kept``, without characters that
    were cut in two.
    """
    length = LENGTH if length is None else length
    anchor_bytes = ANCHOR if anchor_bytes is None else anchor_bytes
    if not BLOCK <= anchor_bytes <= length:
        raise ValueError(f"anchor of {anchor_bytes} bytes for windows of {length}")
    # The text comes first and by a name that no kept column has.
    source = docs.select(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("_text"),
                         *[F.col(c) for c in keep])
    rows = materialize(grouped_runs(source, "_text", length, anchor_bytes), "repeats-groups")
    spans = repeated_spans(rows, length)
    runs = rows.filter("run is not null").select("anchor", "content", "run")
    hits = runs.join(spans, ["anchor", "content"]).select(
        F.shiftright("run", _RUN_BITS).alias("g"), "run", "spans")
    groups = rows.filter("docs is not null").select("g", "docs", "runs")
    schema = T.StructType([source.schema[c] for c in keep])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("kept_sha256", T.StringType())
    if with_kept:
        schema = schema.add("kept", T.StringType())

    def remove(t: pa.Table) -> pa.Table:
        found = t.filter(pc.is_valid(t["run"]))
        group = t.filter(pc.is_valid(t["docs"]))
        docs = unpacked(group["docs"][0].as_py())
        runs = unpacked(group["runs"][0].as_py())
        doc, first, windows = (runs[c].to_numpy() for c in ("doc", "first", "windows"))
        at = found["run"].to_numpy() & ((1 << _RUN_BITS) - 1)
        by_doc: dict[int, list] = {}
        for r, spans in zip(at.tolist(), found["spans"].to_pylist()):
            spans = (0, int(windows[r]) - 1) if spans is None else spans
            by_doc.setdefault(int(doc[r]), []).extend(
                int(first[r]) + x for x in spans)
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        kept = []
        for d, value in enumerate(docs["_text"]):
            data = value.as_py()
            pieces, end, removed, n_spans = [], 0, 0, 0
            flat = by_doc.get(d, ())
            for a, b in sorted(zip(flat[::2], flat[1::2])):
                b += length
                if a > end or not n_spans:
                    pieces.append(data[end:a])
                    n_spans += 1
                    removed += b - a
                    end = b
                elif b > end:
                    removed += b - end
                    end = b
            pieces.append(data[end:])
            rest = b"".join(pieces)
            for k, v in zip(out, (len(data), removed, n_spans,
                                  hashlib.sha256(rest).hexdigest())):
                out[k].append(v)
            if with_kept:
                kept.append(rest.decode(errors="ignore"))
        columns = [docs[c] for c in keep] + list(out.values()) + [kept] * with_kept
        return pa.table(dict(zip(schema.names, columns)))

    return hits.unionByName(groups, allowMissingColumns=True).groupBy("g").applyInArrow(
        remove, schema)
