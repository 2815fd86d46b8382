"""Line-first cleaning with built-in expressions alone.

Every line of a text that holds a word is judged on its own by three kinds of
rules, and the lines that fail one are removed:

* punctuation: the line does not end in a terminal mark (closing quotes and
  brackets aside), or symbols ``#*$%&|<>`` are more than a share of its characters;
* navigation: separators stand alone as words more often than once in a number of
  characters, or it is short and begins with the name of a menu entry;
* boilerplate: it holds one of the phrases of site notices, or a curly bracket.

The document is rejected if the removed lines held more than ``MAX_LOSS`` of its
word characters; before that, counts over the whole text reject texts that are
too short or repeat themselves.

Words are maximal runs of other characters than white space; lines are cut at line
feeds.  A word lies in a repeated window if one of the ``WINDOW`` windows over it is
found twice or more in its text.  Windows are compared by a 64-bit hash, doubled up
from the words' hashes; only a text in which hashes repeat is looked at closely.

All of it is one projection over the scan: no shuffle, no join, no Python; a
document's work does not depend on any other.  Arrays of a document's words and
lines are the largest values held.

Defined results: a null text has no words; texts without a word have counts of 0
and are rejected as too short; ties cannot arise; repeated rows and null ids are
judged one by one; other columns of the input are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 20
#: Largest share, in percent, of words in repeated windows.
MAX_REPEAT = 30
#: Largest share of a document's word characters that removed lines may hold.
MAX_LOSS = 0.3
WINDOW = 8
#: Largest share of symbols among a line's characters.
MAX_SYMBOLS = 0.06
#: The terminal mark lies among so many last characters.
LINE_END = 16
#: A separator that stands alone for every so many characters makes navigation.
SEPARATOR_EVERY = 50
#: A line that begins with a menu entry is navigation up to this many characters.
SHORT_LINE = 30

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
TERMINAL = (r"""[.!?\x{2026}\x{3002}\x{FF01}\x{FF1F}\x{061F}\x{0964}]"""
            r"""["')\]\x{00BB}\x{2019}\x{201D}]*""" rf"[{SPACE}]*\z")
#: A word of separators alone, with the white space or end behind it.
SEPARATOR = (rf"(^|[{SPACE}])[|/>\x{{00BB}}\x{{203A}}\x{{00B7}}\x{{2022}}\x{{2192}}]+"
             rf"([{SPACE}]|\z)")
MENU = ("home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "next",
        "previous", "back to top", "contact us", "about us", "sitemap", "share this",
        "skip to content")
BOILERPLATE = ("all rights reserved", "click here", "cookie policy", "enable javascript",
               "javascript is", "lorem ipsum", "privacy policy", "read more",
               "subscribe to our newsletter", "terms of service", "terms of use",
               "use cookies", "uses cookies", "{", "}")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(f"[^{SPACE}]"))


# --- repeated windows --------------------------------------------------------------
def paired(hashes: Column, step: int) -> Column:
    """Hash of each value and the one ``step`` further on."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n),
                      lambda a, b: F.xxhash64(a, b))


def covered(hashes: Column) -> Column:
    """Words under windows whose hash is there twice or more.

    ``hashes`` must be a column, as it is looked into at random.
    """
    marked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(
        h.alias("h"), i.alias("i"))))

    def twice(sorted_marks: Column) -> Column:
        again = F.filter(sorted_marks, lambda x, k: (
            (F.get(sorted_marks, k - 1)["h"] == x["h"])
            | (F.get(sorted_marks, k + 1)["h"] == x["h"])))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    def words(starts: Column) -> Column:
        return F.aggregate(F.transform(starts, lambda i, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - i, F.lit(WINDOW)))),
            F.lit(0), lambda a, b: a + b)

    return _let(_let(marked, twice), words)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


# --- rules of one line ---------------------------------------------------------------
def line_fails(line: Column) -> Column:
    """Whether a line with words is to be removed."""
    return _let(F.struct(line.alias("line"), F.lower(line).alias("low"),
                         F.length(line).alias("n")),
                lambda x: _fails(x["line"], x["low"], x["n"]))


def _fails(line: Column, low: Column, n: Column) -> Column:
    failed = ~F.rlike(F.substring(line, -LINE_END, LINE_END), F.lit(TERMINAL))
    failed = failed | (F.regexp_count(line, F.lit(SYMBOLS)) > F.lit(MAX_SYMBOLS) * n)
    failed = failed | ((n <= SHORT_LINE) & F.rlike(low, F.lit(
        rf"^[{SPACE}]*({'|'.join(MENU)})([^a-z]|\z)")))
    for phrase in BOILERPLATE:
        failed = failed | F.contains(low, F.lit(phrase))
    # Of two separators with one space between them the second is not counted.
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    return failed | ((separators > 0) & (separators * SEPARATOR_EVERY >= n))


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the counts and verdicts, and ``cleaned``, the lines that stay.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines, n_removed_lines, removed_chars, kept, cleaned``.
    """
    text = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), text.alias("text"))
    rows = rows.select(
        "doc_id", "text", words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), has_word).alias("lines"))
    rows = rows.select(
        "doc_id", "lines", F.size("words").cast("long").alias("n_words"),
        word_chars(F.col("words")).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    rows = rows.withColumn("windows", _let(
        _let(paired(F.col("hashes"), 1), lambda two: paired(two, 2)),
        lambda four: paired(four, 4)))
    rows = rows.withColumn("stays", F.filter("lines", lambda x: ~line_fails(x)))
    repeats = F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0)).otherwise(
        covered(F.col("windows")))
    rows = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeats.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stays")).cast("long").alias("n_removed_lines"),
        F.array_join("stays", "\n").alias("cleaned"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    removed = F.col("word_chars") - word_chars(words_of(F.col("cleaned")))
    rows = rows.withColumn("base_failed", failed).withColumn(
        "removed_chars", removed.cast("long"))
    kept = ~F.col("base_failed") & (
        F.col("removed_chars") <= F.lit(MAX_LOSS) * F.col("word_chars"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "n_lines", "n_removed_lines",
                       "removed_chars", kept.alias("kept"), "cleaned")
