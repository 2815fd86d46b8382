"""Fill-in-the-middle transformation with counted quantifiers of a regular expression.

``regexp_count`` gives the number ``n`` of a text's units (code points), two draws
from a hash of the document's id give the cuts ``a <= b``, and one pattern per
row, ``\\A(unit{a}+)(unit{b-a}+)(unit*+)\\z`` with possessive quantifiers, captures
prefix, middle and suffix in a single match; the replacement puts them in the
order of the form.  A possessive counted group walks forward once and never gives
back, so a row costs time in proportion to its length.  Everything is a built-in
expression: no shuffle, no Python, one row at a time.

Forms: ``plain`` is the text itself (empty texts, texts that contain a marker, and
the share of documents that is not transformed); ``psm`` is prefix, suffix, middle;
``spm`` is suffix, prefix, middle, each behind its marker.

Units are counted a stretch at a time and then one by one in what is left, so
that no list with an entry per character is ever held.

Defined results: a null text is empty; a null id draws as an empty decimal; rows
that repeat an id draw the same numbers; a cut may leave prefix, middle or suffix
empty; other columns of the input are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents so many are transformed, and of 100 of these so many as spm.
TRANSFORMED, SPM = 90, 20
SALT = "1:"
STRETCH = 4096

_UNIT = "(?s)."


def units(text: Column) -> Column:
    """Number of code points, by matches of whole stretches and of single units."""
    stretches = F.regexp_count(text, F.lit(f"{_UNIT}{{{STRETCH}}}+"))
    rest = F.substring(text, stretches * F.lit(STRETCH) + F.lit(1), F.lit(STRETCH))
    return (stretches * F.lit(STRETCH) + F.regexp_count(rest, F.lit(_UNIT))).cast("long")


def draws(doc_id: Column, salt: str = SALT) -> list[Column]:
    """Four unsigned 32-bit numbers of an id: the first groups of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              transformed: int = TRANSFORMED, spm: int = SPM, salt: str = SALT) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, text, output`` of every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", units(F.col("text")).alias("n"),
                       F.array(*draws(F.col("doc_id"), salt)).alias("h"))
    cuts = [F.get("h", F.lit(k)) % (F.col("n") + 1) for k in (0, 1)]
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col("text"), F.lit(marker))
    plain = (F.col("n") == 0) | marked | (F.get("h", F.lit(2)) % 100 >= transformed)
    rows = rows.select(
        "doc_id", "text", "n", F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"),
        F.when(plain, F.lit("plain")).when(F.get("h", F.lit(3)) % 100 < spm, F.lit("spm"))
        .otherwise(F.lit("psm")).alias("form"))
    a, middle = F.col("a"), F.col("b") - F.col("a")
    pattern = F.concat(F.lit(r"(?s)\A(.{"), a.cast("string"), F.lit("}+)(.{"),
                       middle.cast("string"), F.lit(r"}+)(.*+)\z"))
    order = F.when(F.col("form") == "psm", F.lit(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")).otherwise(
        F.lit(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"))
    cut = F.col("form") != "plain"
    return rows.select(
        "doc_id", "n", "form", F.when(cut, a).alias("prefix_chars"),
        F.when(cut, middle).alias("middle_chars"), "text",
        F.when(cut, F.regexp_replace(F.col("text"), pattern, order)).otherwise(
            F.col("text")).alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from."""
    return (F.when(form == "psm", F.regexp_replace(
        output, F.lit(rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z"), F.lit("$1$3$2")))
        .when(form == "spm", F.regexp_replace(
            output, F.lit(rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z"), F.lit("$2$3$1")))
        .otherwise(output))
