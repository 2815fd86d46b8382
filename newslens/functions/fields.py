"""Column expressions for the feed's delimited mini-languages.

Every function returns a built-in Spark ``Column`` so the work stays inside
whole-stage codegen; none of them needs a Python worker.  All are ANSI-safe:
parse failures become null instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# --- Fixed values -------------------------------------------------------------
# Characters that Python's ``str.strip()`` / ``str.split()`` treat as
# whitespace (``str.isspace``), and the same set as a Java regex class.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")
PY_WHITESPACE_CLASS = "[" + "".join(f"\\u{ord(c):04X}" for c in PY_WHITESPACE) + "]"
# One location segment's country: segment start, block 0, '#', a non-empty
# block 1, and block 1's text after its last comma.
LOCATION_COUNTRY_PATTERN = r"(?:^|;)[^;#]*#(?=[^;#])(?:[^;#]*,)?([^;#,]*)"
# Language used when a mention carries no translation info.
DEFAULT_LANGUAGE = "eng"
# Event day format and the 1-based character ranges of the article DATE.
EVENT_DAY_FORMAT = "yyyyMMdd"
ARTICLE_DATE_PARTS = {"year": (1, 4), "month": (5, 2), "day": (7, 2)}
# Separators of the mini-languages.
SEGMENT_SEP, BLOCK_SEP, NAME_SEP, LIST_SEP, PAIR_SEP = ";", "#", ",", ",", "-"
# ------------------------------------------------------------------------------


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: ColumnOrName, fn) -> Column:
    """``fn(value)`` with ``value`` referenced once ("let" binding).

    Catalyst substitutes aliases when it pushes filters down or collapses
    projections; an expression that uses a derived value many times then
    repeats that value's whole derivation.  Passing the value through a
    one-element ``transform`` keeps a single reference to it.
    """
    return F.get(F.transform(F.array(_col(value)), fn), F.lit(0))


def py_strip(c: ColumnOrName) -> Column:
    """``str.strip()`` semantics: remove leading and trailing Unicode whitespace."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def event_date(day: ColumnOrName) -> Column:
    """Packed ``yyyyMMdd`` integer -> date; malformed values become null."""
    return F.try_to_date(_col(day).cast("string"), EVENT_DAY_FORMAT)


def event_date_parts(day: ColumnOrName) -> dict[str, Column]:
    d = event_date(day)
    return {"event_year": F.year(d), "event_month": F.month(d), "event_day": F.dayofmonth(d)}


def article_date_parts(date14: ColumnOrName) -> dict[str, Column]:
    """Year / month / day from the 14-digit ``yyyyMMddHHmmss`` number, by position."""
    text = _col(date14).cast("bigint").cast("string")
    out = {}
    for part, (pos, length) in ARTICLE_DATE_PARTS.items():
        out[f"event_{part}"] = F.substring(text, pos, length).try_cast("int")
    return out


def source_language(translation_info: ColumnOrName) -> Column:
    """Characters 7-9 of the translation info; blank or missing means the default."""
    code = F.substring(_col(translation_info), 7, 3)
    return F.when(code != "", code).otherwise(F.lit(DEFAULT_LANGUAGE))


def first_tone(v2tone: ColumnOrName) -> Column:
    """First element of the comma list, as a double (null when unparsable)."""
    return F.get(F.split(_col(v2tone), LIST_SEP, -1), F.lit(0)).try_cast("double")


def first_theme(v2counts: ColumnOrName) -> Column:
    """Text before the first ``#`` (``''`` when the value starts with ``#``)."""
    return F.get(F.split(_col(v2counts), BLOCK_SEP, -1), F.lit(0))


def location_countries(locations: ColumnOrName) -> Column:
    """Country names of a ``;``-separated location list, in order, not distinct.

    A segment counts when it is non-empty, has at least two ``#`` blocks and a
    non-empty second block; its country is the text after the last comma of
    that block, whitespace-stripped (an all-space name stays as ``''``).
    One regex pass finds every counted segment's name (a match can only start
    at the string start or at a ``;``, i.e. at a segment start).
    """
    names = F.regexp_extract_all(_col(locations), F.lit(LOCATION_COUNTRY_PATTERN), 1)
    return F.transform(names, py_strip)


def split_persons(person_list: ColumnOrName) -> Column:
    return F.split(_col(person_list), SEGMENT_SEP, -1)


def canonical_pair_array(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``[a, b]`` when ``a < b`` else ``[b, a]`` (a null member takes the else branch)."""
    a, b = _col(a), _col(b)
    return F.when(a < b, F.array(a, b)).otherwise(F.array(b, a))


def canonical_pair_string(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a-b`` when ``a < b`` else ``b-a``; ``concat_ws`` skips a null member."""
    a, b = _col(a), _col(b)
    return F.when(a < b, F.concat_ws(PAIR_SEP, a, b)).otherwise(F.concat_ws(PAIR_SEP, b, a))


def pair_member(pair_string: ColumnOrName, i: int) -> Column:
    """Member ``i`` of a ``-``-joined pair (re-split, so hyphenated names are cut)."""
    return F.get(F.split(_col(pair_string), PAIR_SEP, -1), F.lit(i))


def blank_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Empty strings become null in every string column (whitespace is kept)."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = strings if columns is None else strings & set(columns)
    return df.select(*[
        F.nullif(F.col(n), F.lit("")).alias(n) if n in targets else F.col(n)
        for n in df.columns])
