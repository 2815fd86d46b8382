"""Document fingerprints from closed syncmers, in DataFrame expressions alone.

A k-mer (``K`` characters) is a closed syncmer if the smallest of its ``W``
inner substrings of ``S`` characters, by hash, is its first or its last.  That
depends on the k-mer alone, so equal passages are anchored at the same places
whatever surrounds them.  One of ``SAMPLE`` anchors is kept, by the hash of its first
inner substring, so the number kept grows with the text.  Anchors are matched by
position: a mark is made of an anchor, the next one and the distance between their
places, and the fingerprint is the set of all marks, sorted.  Two texts share a
mark only where two anchors follow each other equally far apart; the likeness of two
fingerprints is the share of their union that both hold.

Texts are cut once into overlapping chunks, so that taking substrings stays
linear in the length of a text, and every substring is hashed once.  The edited
text's anchors are those of its two parts, shifted, and those across the seam.

The next document is found without a global order: ids are cut into stretches at
approximate quantiles, wide ones again into equal parts, and rows without an id by
the hash of their text; rows are sorted per stretch, and the first row of a stretch
is also sent to the stretch before it.  Texts move once.  (Rows that all have the
same id share a stretch.)

Defined results: a null or empty text has an empty fingerprint; a text shorter
than a k-mer, or without a kept anchor, is one mark; two empty fingerprints are alike
(1), an empty and another one are not (0); rows of equal id follow each other by hash
of their text, rows without an id come last; a single document is its own next one;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

S = 12
W = 5
K = S + W - 1
#: One anchor in so many is kept, a power of two.
SAMPLE = 8
CHUNK = 64
STRETCH_ROWS = 4096
#: Quantiles of the ids that are looked up, and parts of all stretches between them.
QUANTILES = 1024
MAX_STRETCHES = 1 << 19


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def inner_hashes(text: Column) -> Column:
    """Hash of every substring of ``S`` characters, in order."""
    chunks = F.regexp_extract_all(
        text, F.lit(rf"(?s)(?=(.{{1,{CHUNK + S - 1}}})).{{1,{CHUNK}}}"), F.lit(1))

    def of(chunk: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(chunk) - (S - 1))
        return F.when(F.length(chunk) < S, F.array().cast("array<bigint>")).otherwise(
            F.transform(places, lambda i: F.xxhash64(F.substring(chunk, i, F.lit(S)))))

    return F.flatten(F.transform(chunks, of))


def anchors(hashes: Column) -> Column:
    """(hash, place) of every closed syncmer, from the inner hashes of a text."""
    return sampled_anchors(1)(hashes)


def sampled_anchors(sample: int):
    """As ``anchors``, of one anchor in ``sample``."""
    return lambda hashes: _anchors(hashes, sample)


def _anchors(hashes: Column, sample: int) -> Column:
    def closed(i: Column) -> Column:
        inner = [F.get(hashes, i + j) for j in range(1, W - 1)]
        edge = F.least(F.get(hashes, i), F.get(hashes, i + (W - 1)))
        test = edge <= (F.least(*inner) if len(inner) > 1 else inner[0])
        return test if sample == 1 else (
            F.get(hashes, i).bitwiseAND(F.lit(sample - 1)) == 0) & test

    def anchor(i: Column) -> Column:
        # The two edge substrings cover the whole k-mer.
        value = F.xxhash64(F.get(hashes, i), F.get(hashes, i + (W - 1)))
        return F.struct(F.shiftright(value, 32).cast("int").alias("hash"), i.alias("place"))

    starts = F.sequence(F.lit(0), F.size(hashes) - W)
    return F.when(F.size(hashes) >= W, F.transform(F.filter(starts, closed), anchor)).otherwise(
        F.array().cast("array<struct<hash:int,place:int>>"))


def marks(found: Column) -> Column:
    """A hash of every anchor with the next one and the distance to it (a column)."""
    def mark(x: Column, k: Column) -> Column:
        following = F.get(found, k + 1)
        return F.shiftright(F.xxhash64(
            x["hash"], following["place"] - x["place"], following["hash"]), 32).cast("int")

    return F.transform(found, mark)


def distinct(values: Column) -> Column:
    """The distinct values, sorted."""
    return F.sort_array(F.array_distinct(values))


def whole(text: Column) -> Column:
    """The fingerprint of a text without a kept anchor."""
    return F.when(F.length(text) == 0, F.array().cast("array<int>")).otherwise(
        F.array(F.shiftright(F.xxhash64(text), 32).cast("int")))


def likeness(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        shared.cast("double") / (F.size(a) + F.size(b) - shared))


def text_of(sketch: Column) -> Column:
    """A fingerprint as eight hexadecimal digits a hash."""
    return F.lower(F.array_join(F.transform(sketch, lambda x: F.substring(
        F.hex(x.cast("long") + F.lit(1 << 32)), -8, 8)), ""))


def sketch(text: Column, found: Column) -> Column:
    """The fingerprint of a text with the kept anchors ``found`` (both columns)."""
    return F.when(F.size(found) == 0, whole(text)).otherwise(distinct(marks(found)))


def stretch_of(rows: DataFrame) -> Column:
    """The number of a row's stretch, which falls as the order of documents goes on."""
    counts = rows.agg(F.count("*"), F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    n, known, low, high = counts
    stretches = min(MAX_STRETCHES, max(1, -(-known // STRETCH_ROWS)))
    coarse = min(QUANTILES, stretches)
    fine = -(-stretches // coarse)
    # Fewer than QUANTILES numbers.
    bounds = sorted(set(rows.agg(F.percentile_approx(
        "doc_id", [k / coarse for k in range(1, coarse)], 10 * QUANTILES)).first()[0]
        if coarse > 1 and known else []))
    bounds = [b for b in bounds if b > low]
    of_null = max(1, -(-(n - known) // STRETCH_ROWS))
    share = F.col("text_hash").cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    nameless = F.lit(-1) - F.least(
        F.lit(of_null - 1), F.floor(share * F.lit(of_null)).cast("long"))
    if not known:
        return nameless
    limits = F.array(*[F.lit(b).cast("long") for b in [low, *bounds, high + 1]])
    at = F.size(F.filter(limits, lambda b: b <= F.col("doc_id"))) if bounds else F.lit(1)
    start, end = F.element_at(limits, at), F.element_at(limits, at + 1)
    if fine == 1:
        part = F.lit(0).cast("long")
    else:
        wide = [x.cast("decimal(20,0)") for x in (F.col("doc_id"), start, end)]
        part = F.least(F.lit(fine - 1), F.floor(
            (wide[0] - wide[1]).cast("double") * fine / (wide[2] - wide[1]).cast("double"))
            .cast("long"))
    return F.when(F.col("doc_id").isNull(), nameless).otherwise(
        F.lit(fine).cast("long") * at + part)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, stretch, copy, text_hash``.

    ``copy`` marks rows that only serve the stretch before their own.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    rows = rows.withColumn("stretch", stretch_of(rows))
    # One row per stretch: its first document, and the stretch before it (round the end).
    first = F.min(F.struct(F.isnull("doc_id").alias("n"), F.bitwise_not("doc_id").alias("i"),
                           F.col("text_hash").alias("h")))
    heads = rows.groupBy("stretch").agg(first.alias("head"))
    down = Window.orderBy(F.desc("stretch"))
    last = heads.agg(F.min("stretch").alias("last"))
    heads = heads.withColumn("before", F.lag("stretch").over(down)).join(last, F.lit(True)) \
        .select(F.bitwise_not(F.col("head.i")).alias("head_id"),
                F.col("head.h").alias("head_hash"),
                F.coalesce("before", "last").alias("before"))
    placed = rows.join(heads, rows["doc_id"].eqNullSafe(heads["head_id"])
                       & (rows["text_hash"] == heads["head_hash"]), "left")
    own = F.struct(F.col("stretch"), F.lit(False).alias("copy"))
    sent = F.struct(F.col("before").alias("stretch"), F.lit(True).alias("copy"))
    head = F.col("before").isNotNull()
    return placed.select("doc_id", "text", "text_hash", F.explode(F.when(
        head, F.array(own, sent)).otherwise(F.array(own))).alias("at")).select(
        "doc_id", "text", "at.stretch", "at.copy", "text_hash")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    The edited text has its last ``floor(n / 2)`` characters replaced by as many
    of the first ones of the next document by descending id.
    """
    line = Window.partitionBy("stretch").orderBy(
        "copy", F.col("doc_id").desc_nulls_last(), "text_hash")
    rows = with_next(docs, doc_id, text).withColumn("next_text", F.lead("text").over(line))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("found", _let(inner_hashes(F.col("text")),
                                         sampled_anchors(SAMPLE)))
    # Same stretches in the same order: no further exchange or sort.
    rows = rows.withColumn("next_found", F.lead("found").over(line)).filter("not copy")
    need = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("need", need).withColumn(
        "half", F.col("n_chars").cast("int") - need)
    rows = rows.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("half")),
        F.coalesce(F.substring(F.col("next_text"), F.lit(1), F.col("need")), F.lit(""))))
    # Anchors of the edited text: before the seam, across it, behind it.
    rows = rows.withColumn("from", F.greatest(F.col("half") - (K - 1), F.lit(0)))
    seam = F.substring(F.col("edited"), F.col("from") + 1, F.col("half") - F.col("from") + (K - 1))
    across = F.transform(_let(inner_hashes(seam), sampled_anchors(SAMPLE)), lambda x: F.struct(
        x["hash"].alias("hash"), (x["place"] + F.col("from")).alias("place")))
    kept = F.filter("found", lambda x: x["place"] <= F.col("half") - K)
    behind = F.transform(
        F.filter("next_found", lambda x: x["place"] <= F.col("need") - K),
        lambda x: F.struct(x["hash"].alias("hash"), (x["place"] + F.col("half")).alias("place")))
    rows = rows.withColumn("edited_found", F.concat(
        kept, across, F.coalesce(behind, F.array().cast("array<struct<hash:int,place:int>>"))))
    rows = rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text"), F.col("found")).alias("sketch"),
        sketch(F.col("edited"), F.col("edited_found")).alias("edited_sketch"),
        sketch(F.col("next_text"), F.col("next_found")).alias("next_sketch"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", text_of(F.col("sketch")).alias("fingerprint"),
        text_of(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
