"""The analytical queries over the two serving tables.

Each function takes the serving table as a DataFrame (read it with
``newslens.sources.serving.read_serving``, or pass any DataFrame with the
serving columns) and returns a lazy DataFrame.  Q1, Q3.2 to Q3.5, Q4.1 and Q4.2 also
take a rollup that holds their columns (``serving.read_totals``) and sum its counts.  ``granularity`` is one of
``year``, ``month``, ``day``; an unknown value raises ``ValueError``.

Ties the reference leaves to chance are broken by a total order so results do
not depend on partitioning (documented per query).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions import fields as X
from newslens.operators.period import period_columns, period_desc, top_k_per_group
from newslens.sources.totals import mean_tone, row_count

ARTICLE_PERIOD_OUTPUT = ["event_themes", "person_list", "first_country", "event_tone"]


def ordered_result(df: DataFrame, *order: Column | str) -> DataFrame:
    """Final ordering; callers name a total order of the result's rows."""
    return df.orderBy(*order)


# --- Q1 ----------------------------------------------------------------------
def articles_by_date_country_language(event_mentions: DataFrame, year: int, month: int,
                                      day: int, country: str,
                                      language: str | None = None) -> DataFrame:
    """Row count of one day and country, per source language (or for one language).

    Without a language the result is ordered by language.  Output columns:
    event_year, event_month, event_day, event_country, source_language, count.
    """
    cond = ((F.col("event_year") == year) & (F.col("event_month") == month)
            & (F.col("event_day") == day) & (F.col("event_country") == country))
    if language is not None:
        cond = cond & (F.col("source_language") == language)
    out = (event_mentions.filter(cond)
           .groupBy("event_year", "event_month", "event_day", "event_country", "source_language")
           .agg(row_count(event_mentions).alias("count")))
    return out if language is not None else ordered_result(out, "source_language")


# --- Q2 ----------------------------------------------------------------------
def most_mentioned_events(event_mentions: DataFrame, country: str,
                          granularity: str = "year") -> DataFrame:
    """The most mentioned event of each period for one country.

    Ranking: ``num_mentions`` descending (nulls last), then ``global_event_id``
    ascending.  Newest period first.
    """
    period = period_columns(granularity)
    df = event_mentions.filter(F.col("event_country") == country)
    top = top_k_per_group(df, period, [F.desc_nulls_last("num_mentions"),
                                       F.asc_nulls_last("global_event_id")], 1, "num_mentions")
    return ordered_result(top.select(*period, "event_country", "global_event_id", "num_mentions"),
                          *period_desc(granularity))


# --- Q3.1 --------------------------------------------------------------------
def all_by_source(articles: DataFrame, source: str, granularity: str = "year",
                  limit: int = 100) -> DataFrame:
    """The newest ``limit`` articles of one source (ties: ``global_event_id`` ascending).

    Planned as a ``TakeOrderedAndProject``: each task keeps its own top
    ``limit`` rows, so only ``tasks * limit`` rows reach the final merge.
    """
    period = period_columns(granularity)
    df = articles.filter(F.col("internet_source") == source)
    return (df.orderBy(*period_desc(granularity), F.asc_nulls_last("global_event_id"))
            .select("internet_source", *period, *ARTICLE_PERIOD_OUTPUT)
            .limit(limit))


# --- Q3.2 --------------------------------------------------------------------
def tone_and_count_by_source(articles: DataFrame, source: str,
                             granularity: str = "year") -> DataFrame:
    """Average tone and article count per period for one source."""
    period = period_columns(granularity)
    agg = (articles.filter(F.col("internet_source") == source)
           .groupBy("internet_source", *period)
           .agg(mean_tone(articles).alias("average_tone"),
                row_count(articles, "global_event_id").alias("article_count")))
    return ordered_result(agg, *period_desc(granularity))


# --- Q3.3 / Q3.4 / Q3.5 ------------------------------------------------------
def _source_top_k(rows: DataFrame, source: str, granularity: str, dim: str, count_name: str,
                  k: int) -> DataFrame:
    """Top ``k`` values of ``dim`` per period by row count (null is a value).

    Aggregation first (partial + final), then ranking on the aggregated rows;
    ties are broken by ``dim`` ascending, nulls last.
    """
    period = period_columns(granularity)
    agg = (rows.groupBy("internet_source", *period, dim)
           .agg(mean_tone(rows).alias("average_tone"), row_count(rows).alias(count_name)))
    top = top_k_per_group(agg, period, [F.desc_nulls_last(count_name),
                                        F.asc_nulls_last(dim)], k, count_name)
    return ordered_result(top.select("internet_source", *period, dim, "average_tone", count_name),
                          *period_desc(granularity), F.desc_nulls_last(count_name),
                          F.asc_nulls_last(dim))


def themes_by_source(articles: DataFrame, source: str, granularity: str = "year",
                     limit: int = 3) -> DataFrame:
    df = articles.filter(F.col("internet_source") == source)
    return _source_top_k(df, source, granularity, "event_themes", "theme_count", limit)


def locations_by_source(articles: DataFrame, source: str, granularity: str = "year",
                        limit: int = 3) -> DataFrame:
    """Only the first country of each article counts."""
    df = articles.filter(F.col("internet_source") == source)
    return _source_top_k(df, source, granularity, "first_country", "location_count", limit)


def persons_by_source(articles: DataFrame, source: str, granularity: str = "year",
                      limit: int = 3) -> DataFrame:
    """Each ``;``-separated name counts once per occurrence (``''`` included)."""
    df = articles.filter(F.col("internet_source") == source)
    if "person" not in df.columns:
        df = df.withColumn("person", F.explode(X.split_persons("person_list")))
    return _source_top_k(df, source, granularity, "person", "person_count", limit)


# --- Q4.1 --------------------------------------------------------------------
def tone_and_count_by_countries(articles: DataFrame, country1: str, country2: str,
                                granularity: str = "year",
                                symmetric: bool = False) -> DataFrame:
    """Average tone and count per period for articles about one country pair.

    The pair is ordered (smaller name first), so by default ``country1`` must
    be the smaller name; ``symmetric=True`` orders the arguments first.
    """
    if symmetric and country2 < country1:
        country1, country2 = country2, country1
    period = period_columns(granularity)
    pair = X.canonical_pair_array("first_country", "second_country")
    # Implied by the pair test; a plain IN filter reaches the Parquet scan.
    members = [country1, country2]
    df = (articles
          .filter(F.col("first_country").isin(members) & F.col("second_country").isin(members))
          .withColumn("sorted_country_pair", pair)
          .filter((F.get("sorted_country_pair", F.lit(0)) == country1)
                  & (F.get("sorted_country_pair", F.lit(1)) == country2)))
    agg = (df.groupBy("sorted_country_pair", *period)
           .agg(mean_tone(df).alias("average_tone"), row_count(df).alias("event_count")))
    out = agg.select(F.get("sorted_country_pair", F.lit(0)).alias("first_country"),
                     F.get("sorted_country_pair", F.lit(1)).alias("second_country"),
                     *period, "average_tone", "event_count")
    return ordered_result(out, *period_desc(granularity))


# --- Q4.2 --------------------------------------------------------------------
def themes_by_countries(articles: DataFrame, country1: str, country2: str,
                        granularity: str = "year", limit: int = 3, exact: bool = False,
                        names: Callable[[str], list[str] | None] | None = None) -> DataFrame:
    """Top ``limit`` themes per period over articles whose pair mentions both names.

    Default (reference behaviour): the pair is the ``-``-joined ordered names and
    matches by *substring*, so ``Niger`` also selects ``Nigeria`` pairs; themes
    are ranked across all matching pairs of a period; the output re-splits the
    pair on ``-`` (``Guinea-Bissau`` is cut).  ``exact=True`` matches the
    ordered pair exactly and reports the stored names.
    Ties: theme count descending, then theme, then pair, ascending.

    ``names`` (``serving.read_names``) turns a text into the stored names that hold it,
    so the scan tests for these in place of the substring.
    """
    period = period_columns(granularity)
    if exact:
        lo, hi = sorted([country1, country2])
        pair_arr = X.canonical_pair_array("first_country", "second_country")
        # Implied by the exact pair test; plain IN filters reach the Parquet scan.
        df = (articles.filter(F.col("first_country").isin([lo, hi])
                              & F.col("second_country").isin([lo, hi]))
              .withColumn("pair_arr", pair_arr)
              .filter((F.get("pair_arr", F.lit(0)) == lo) & (F.get("pair_arr", F.lit(1)) == hi))
              .withColumn("country_pair", F.concat_ws(X.PAIR_SEP, "pair_arr"))
              .withColumn("first_country", F.get("pair_arr", F.lit(0)))
              .withColumn("second_country", F.get("pair_arr", F.lit(1))))
        keys = ["country_pair", "first_country", "second_country"]
        first: Column = F.col("first_country")
        second: Column = F.col("second_country")
    else:
        pair = X.canonical_pair_string("first_country", "second_country")
        df = articles
        for name in (country1, country2):
            # A non-empty name without the separator can only match inside one
            # member, so this implied filter is exact and reaches the scan.
            if name and X.PAIR_SEP not in name:
                found = names(name) if names else None
                df = df.filter(reduce(Column.__or__, [
                    F.col(c).contains(name) if found is None else F.col(c).isin(found)
                    for c in ("first_country", "second_country")]))
        df = (df.withColumn("country_pair", pair)
              .filter(F.col("country_pair").contains(country1)
                      & F.col("country_pair").contains(country2)))
        keys = ["country_pair"]
        first, second = X.pair_member("country_pair", 0), X.pair_member("country_pair", 1)
    agg = (df.groupBy(*keys, *period, "event_themes")
           .agg(mean_tone(df).alias("average_tone"), row_count(df).alias("theme_count")))
    top = top_k_per_group(agg, period, [F.desc_nulls_last("theme_count"),
                                        F.asc_nulls_last("event_themes"),
                                        F.asc_nulls_last("country_pair")], limit, "theme_count")
    out = top.select(first.alias("first_country"), second.alias("second_country"), *period,
                     "event_themes", "average_tone", "theme_count")
    return ordered_result(out, *period_desc(granularity), F.desc_nulls_last("theme_count"),
                          F.asc_nulls_last("event_themes"), F.asc_nulls_last("first_country"),
                          F.asc_nulls_last("second_country"))
