"""Independent SQL statements of every registered query, for DuckDB.

These are the correctness oracle: plain SQL over the provided tables (views
named as the tables), written without any of the Spark code.  Fixture feeds
come in as CTEs from the same fixture text Spark runs.
"""

from __future__ import annotations

from newslens.operators.period import period_columns
from newslens.sources.fixtures import fixture_cte, line_fields

EVENT_MENTIONS_CTE = r"""
{name} AS (
  SELECT * FROM (
    SELECT e.GlobalEventID AS global_event_id,
      CAST(year(e.d) AS INTEGER) AS event_year,
      CAST(month(e.d) AS INTEGER) AS event_month,
      CAST(day(e.d) AS INTEGER) AS event_day,
      CASE WHEN substr(m.MentionDocTranslationInfo, 7, 3) <> ''
           THEN substr(m.MentionDocTranslationInfo, 7, 3) ELSE 'eng' END AS source_language,
      NULLIF(e.ActionGeo_CountryCode, '') AS event_country,
      NULLIF(e.ActionGeo_FullName, '') AS event_country_full_name,
      e.NumMentions AS num_mentions,
      m.MentionTimeDate AS mention_time_date,
      m.MentionIdentifier AS mention_identifier
    FROM (SELECT *, CAST(TRY_STRPTIME(CAST(Day AS VARCHAR), '%Y%m%d') AS DATE) AS d
          FROM {export}) e
    JOIN {mentions} m ON e.GlobalEventID = m.GlobalEventID) t
  WHERE global_event_id IS NOT NULL AND event_year IS NOT NULL AND event_month IS NOT NULL
    AND event_day IS NOT NULL AND event_country IS NOT NULL
)"""

UPSERT_EVENT_MENTIONS_CTE = r"""
{name} AS (
  SELECT global_event_id, event_year, event_month, event_day, source_language,
         event_country, event_country_full_name, num_mentions FROM (
    SELECT *, row_number() OVER (PARTITION BY global_event_id ORDER BY
        mention_time_date DESC NULLS LAST, mention_identifier ASC NULLS LAST,
        source_language ASC NULLS LAST, event_year ASC NULLS LAST, event_month ASC NULLS LAST,
        event_day ASC NULLS LAST, event_country ASC NULLS LAST,
        event_country_full_name ASC NULLS LAST, num_mentions ASC NULLS LAST) AS rn
    FROM {source}) x WHERE rn = 1
)"""

ARTICLES_CTE = r"""
{name} AS (
  SELECT global_event_id, internet_source, event_year, event_month, event_day,
    split_part(event_themes, '#', 1) AS event_themes, person_list, event_tone,
    countries[1] AS first_country, countries[2] AS second_country
  FROM (
    SELECT *, list_transform(
        list_filter(
          list_transform(list_filter(string_split(countries_name, ';'), lambda s: s <> ''),
                         lambda s: string_split(s, '#')),
          lambda blk: len(blk) > 1 AND blk[2] <> ''),
        lambda blk: regexp_replace(string_split(blk[2], ',')[-1], '^\s+|\s+$', '', 'g')
      ) AS countries
    FROM (
      SELECT NULLIF(GKGRECORDID, '') AS global_event_id,
        NULLIF(SourceCommonName, '') AS internet_source,
        TRY_CAST(substr(CAST(DATE AS VARCHAR), 1, 4) AS INTEGER) AS event_year,
        TRY_CAST(substr(CAST(DATE AS VARCHAR), 5, 2) AS INTEGER) AS event_month,
        TRY_CAST(substr(CAST(DATE AS VARCHAR), 7, 2) AS INTEGER) AS event_day,
        NULLIF(V2Counts, '') AS event_themes,
        NULLIF(Persons, '') AS person_list,
        NULLIF(Locations, '') AS countries_name,
        TRY_CAST(split_part(V2Tone, ',', 1) AS DOUBLE) AS event_tone
      FROM {gkg}) a0
    WHERE global_event_id IS NOT NULL AND event_year IS NOT NULL AND event_month IS NOT NULL
      AND event_day IS NOT NULL AND countries_name IS NOT NULL AND event_themes IS NOT NULL
      AND event_tone IS NOT NULL) a1
)"""

UPSERT_ARTICLES_CTE = r"""
{name} AS (
  SELECT global_event_id, internet_source, event_year, event_month, event_day, event_themes,
         person_list, event_tone, first_country, second_country FROM (
    SELECT *, row_number() OVER (PARTITION BY global_event_id ORDER BY
        event_year DESC NULLS LAST, event_month DESC NULLS LAST, event_day DESC NULLS LAST,
        internet_source ASC NULLS LAST, event_themes ASC NULLS LAST, person_list ASC NULLS LAST,
        event_tone ASC NULLS LAST, first_country ASC NULLS LAST,
        second_country ASC NULLS LAST) AS rn
    FROM {source}) x WHERE rn = 1
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes if c.strip()) + "\n"


def with_event_tables(export: str = "raw_export") -> str:
    return _with(fixture_cte([export, "raw_mentions"]),
                 EVENT_MENTIONS_CTE.format(name="event_mentions", export=export,
                                           mentions="raw_mentions"),
                 UPSERT_EVENT_MENTIONS_CTE.format(name="upsert_event_mentions",
                                                  source="event_mentions"))


def with_article_tables(gkg: str = "raw_gkg") -> str:
    return _with(fixture_cte([gkg]), ARTICLES_CTE.format(name="articles", gkg=gkg),
                 UPSERT_ARTICLES_CTE.format(name="upsert_articles", source="articles"))


def _p(granularity: str) -> str:
    return ", ".join(period_columns(granularity))


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- queries -----------------------------------------------------------------
def q1(year: int, month: int, day: int, country: str, language: str | None) -> str:
    lang = f" AND source_language = {_lit(language)}" if language is not None else ""
    return with_event_tables() + f"""
SELECT event_year, event_month, event_day, event_country, source_language, count(*) AS count
FROM upsert_event_mentions
WHERE event_year = {year} AND event_month = {month} AND event_day = {day}
  AND event_country = {_lit(country)}{lang}
GROUP BY event_year, event_month, event_day, event_country, source_language"""


def q2(country: str, granularity: str, export: str = "raw_export") -> str:
    p = _p(granularity)
    return with_event_tables(export) + f"""
SELECT {p}, event_country, global_event_id, num_mentions FROM (
  SELECT *, row_number() OVER (PARTITION BY {p}
      ORDER BY num_mentions DESC NULLS LAST, global_event_id ASC NULLS LAST) AS rn
  FROM upsert_event_mentions WHERE event_country = {_lit(country)}) x
WHERE rn = 1"""


def q31(source: str, granularity: str, limit: int) -> str:
    p = _p(granularity)
    order = ", ".join(f"{c} DESC NULLS LAST" for c in period_columns(granularity))
    return with_article_tables() + f"""
SELECT internet_source, {p}, event_themes, person_list, first_country, event_tone
FROM upsert_articles WHERE internet_source = {_lit(source)}
ORDER BY {order}, global_event_id ASC NULLS LAST LIMIT {limit}"""


def q32(source: str, granularity: str) -> str:
    p = _p(granularity)
    return with_article_tables() + f"""
SELECT internet_source, {p}, avg(event_tone) AS average_tone,
       count(global_event_id) AS article_count
FROM upsert_articles WHERE internet_source = {_lit(source)}
GROUP BY internet_source, {p}"""


def _source_top_k(rows_sql: str, dim: str, count_name: str, granularity: str, k: int) -> str:
    p = _p(granularity)
    return f"""
SELECT internet_source, {p}, {dim}, average_tone, {count_name} FROM (
  SELECT *, row_number() OVER (PARTITION BY {p}
      ORDER BY {count_name} DESC NULLS LAST, {dim} ASC NULLS LAST) AS rn
  FROM (SELECT internet_source, {p}, {dim}, avg(event_tone) AS average_tone,
               count(*) AS {count_name}
        FROM ({rows_sql}) r GROUP BY internet_source, {p}, {dim}) g) x
WHERE rn <= {k}"""


def q33(source: str, granularity: str, k: int) -> str:
    rows = f"SELECT * FROM upsert_articles WHERE internet_source = {_lit(source)}"
    return with_article_tables() + _source_top_k(rows, "event_themes", "theme_count",
                                                 granularity, k)


def q34(source: str, granularity: str, k: int) -> str:
    rows = f"SELECT * FROM upsert_articles WHERE internet_source = {_lit(source)}"
    return with_article_tables() + _source_top_k(rows, "first_country", "location_count",
                                                 granularity, k)


def q35(source: str, granularity: str, k: int) -> str:
    rows = (f"SELECT *, unnest(string_split(person_list, ';')) AS person FROM upsert_articles "
            f"WHERE internet_source = {_lit(source)}")
    return with_article_tables() + _source_top_k(rows, "person", "person_count",
                                                 granularity, k)


def q41(c1: str, c2: str, granularity: str) -> str:
    p = _p(granularity)
    return with_article_tables() + f"""
SELECT pair[1] AS first_country, pair[2] AS second_country, {p}, average_tone, event_count FROM (
  SELECT pair, {p}, avg(event_tone) AS average_tone, count(*) AS event_count FROM (
    SELECT *, CASE WHEN first_country < second_country THEN [first_country, second_country]
                   ELSE [second_country, first_country] END AS pair
    FROM upsert_articles) a
  WHERE pair[1] = {_lit(c1)} AND pair[2] = {_lit(c2)}
  GROUP BY pair, {p}) g"""


def q42(c1: str, c2: str, granularity: str, k: int) -> str:
    p = _p(granularity)
    return with_article_tables() + f"""
SELECT string_split(country_pair, '-')[1] AS first_country,
       string_split(country_pair, '-')[2] AS second_country,
       {p}, event_themes, average_tone, theme_count FROM (
  SELECT *, row_number() OVER (PARTITION BY {p}
      ORDER BY theme_count DESC NULLS LAST, event_themes ASC NULLS LAST,
               country_pair ASC NULLS LAST) AS rn
  FROM (SELECT country_pair, {p}, event_themes, avg(event_tone) AS average_tone,
               count(*) AS theme_count
        FROM (SELECT *, CASE WHEN first_country < second_country
                             THEN concat_ws('-', first_country, second_country)
                             ELSE concat_ws('-', second_country, first_country) END AS country_pair
              FROM upsert_articles) a
        WHERE contains(country_pair, {_lit(c1)}) AND contains(country_pair, {_lit(c2)})
        GROUP BY country_pair, {p}, event_themes) g) x
WHERE rn <= {k}"""


# --- pipeline steps ----------------------------------------------------------
def join_events_mentions() -> str:
    return _with(fixture_cte(["raw_export", "raw_mentions"])) + """
SELECT e.GlobalEventID, e.Day, e.ActionGeo_CountryCode, e.ActionGeo_FullName, e.NumMentions,
       m.MentionTimeDate, m.MentionIdentifier, m.MentionDocTranslationInfo
FROM raw_export e JOIN raw_mentions m ON e.GlobalEventID = m.GlobalEventID"""


def event_mentions() -> str:
    return _with(fixture_cte(["raw_export", "raw_mentions"]),
                 EVENT_MENTIONS_CTE.format(name="event_mentions", export="raw_export",
                                           mentions="raw_mentions")) + \
        "SELECT * FROM event_mentions"


def upsert_event_mentions(export: str = "raw_export") -> str:
    return with_event_tables(export) + "SELECT * FROM upsert_event_mentions"


def articles() -> str:
    return _with(fixture_cte(["raw_gkg"]), ARTICLES_CTE.format(name="articles", gkg="raw_gkg")) + \
        "SELECT * FROM articles"


def upsert_articles(gkg: str = "raw_gkg") -> str:
    return with_article_tables(gkg) + "SELECT * FROM upsert_articles"


def event_date_parts(export: str = "raw_export") -> str:
    return _with(fixture_cte([export])) + f"""
SELECT GlobalEventID, Day, CAST(year(d) AS INTEGER) AS event_year,
       CAST(month(d) AS INTEGER) AS event_month, CAST(day(d) AS INTEGER) AS event_day
FROM (SELECT *, CAST(TRY_STRPTIME(CAST(Day AS VARCHAR), '%Y%m%d') AS DATE) AS d
      FROM {export}) e"""


def article_date_parts() -> str:
    return _with(fixture_cte(["raw_gkg"])) + """
SELECT GKGRECORDID, DATE,
  TRY_CAST(substr(CAST(DATE AS VARCHAR), 1, 4) AS INTEGER) AS event_year,
  TRY_CAST(substr(CAST(DATE AS VARCHAR), 5, 2) AS INTEGER) AS event_month,
  TRY_CAST(substr(CAST(DATE AS VARCHAR), 7, 2) AS INTEGER) AS event_day
FROM raw_gkg"""


def source_language() -> str:
    return _with(fixture_cte(["raw_mentions"])) + """
SELECT GlobalEventID, MentionIdentifier, MentionDocTranslationInfo,
  CASE WHEN substr(MentionDocTranslationInfo, 7, 3) <> ''
       THEN substr(MentionDocTranslationInfo, 7, 3) ELSE 'eng' END AS source_language
FROM raw_mentions"""


def blank_to_null() -> str:
    return _with(fixture_cte(["raw_export"])) + """
SELECT GlobalEventID, Day, NULLIF(ActionGeo_CountryCode, '') AS ActionGeo_CountryCode,
       NULLIF(ActionGeo_FullName, '') AS ActionGeo_FullName, NumMentions
FROM raw_export"""


def first_tone(gkg: str = "raw_gkg") -> str:
    return _with(fixture_cte([gkg])) + f"""
SELECT GKGRECORDID, V2Tone, TRY_CAST(split_part(V2Tone, ',', 1) AS DOUBLE) AS event_tone
FROM {gkg}"""


def first_theme() -> str:
    return _with(fixture_cte(["raw_gkg"])) + """
SELECT GKGRECORDID, V2Counts, split_part(V2Counts, '#', 1) AS event_themes FROM raw_gkg"""


_COUNTRIES_EXPR = r"""list_transform(
    list_filter(
      list_transform(list_filter(string_split(Locations, ';'), lambda s: s <> ''),
                     lambda s: string_split(s, '#')),
      lambda blk: len(blk) > 1 AND blk[2] <> ''),
    lambda blk: regexp_replace(string_split(blk[2], ',')[-1], '^\s+|\s+$', '', 'g'))"""


def location_countries() -> str:
    return _with(fixture_cte(["raw_gkg"])) + f"""
SELECT GKGRECORDID, Locations, array_to_string(c, '|') AS country_list,
       CAST(len(c) AS INTEGER) AS country_count
FROM (SELECT *, {_COUNTRIES_EXPR} AS c FROM raw_gkg) g"""


def article_countries() -> str:
    return _with(fixture_cte(["raw_gkg"])) + f"""
SELECT GKGRECORDID, c[1] AS first_country, c[2] AS second_country
FROM (SELECT *, {_COUNTRIES_EXPR} AS c FROM raw_gkg) g"""


def deep_top(k: int) -> str:
    return with_article_tables() + f"""
SELECT event_year, event_tone, global_event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_year ORDER BY event_tone DESC NULLS LAST,
                               global_event_id ASC NULLS LAST) AS rn
  FROM upsert_articles) x WHERE rn <= {k}"""


def parse_feed(raw: str, schema) -> str:
    """Every field of a feed's lines: its text, blank as null, as its type."""
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    columns = ",\n  ".join(
        f"CAST(NULLIF({text}, '') AS {types[schema[name].dataType.simpleString()]}) AS {name}"
        for name, text in line_fields(raw).items())
    return _with(fixture_cte([raw])) + f"SELECT {columns}\nFROM {raw}"


# --- manifest and windows -------------------------------------------------------
_ENTRIES = r"""
entries AS (
  SELECT p[1] AS size, p[2] AS hash, p[3] AS url,
         string_split(p[3], '/')[-1] AS file_name,
         split_part(string_split(p[3], '/')[-1], '.', 1) AS file_key,
         CASE WHEN regexp_full_match(split_part(string_split(p[3], '/')[-1], '.', 1), '[0-9]{14}')
              THEN TRY_STRPTIME(split_part(string_split(p[3], '/')[-1], '.', 1), '%Y%m%d%H%M%S')
         END AS file_ts,
         CASE WHEN contains(p[3], 'export.CSV') THEN 'export'
              WHEN contains(p[3], 'mentions.CSV') THEN 'mentions'
              WHEN contains(p[3], 'gkg.csv') THEN 'gkg' END AS feed
  FROM (SELECT regexp_split_to_array(trim(value), '\s+') AS p FROM raw_manifest) t
  WHERE len(p) = 3
)"""
_SELECTED = """(contains(url, 'export.CSV.zip') OR contains(url, 'mentions.CSV.zip')
     OR contains(url, 'gkg.csv.zip'))"""


def manifest_window(start: str, end: str, file_type: str) -> str:
    return _with(fixture_cte(["raw_manifest"]), _ENTRIES) + f"""
SELECT url, file_name, file_key, strftime(file_ts, '%Y-%m-%d %H:%M:%S') AS file_time
FROM entries
WHERE contains(url, {_lit(file_type)})
  AND file_ts BETWEEN TIMESTAMP {_lit(start)} AND TIMESTAMP {_lit(end)}"""


def manifest_by_feed() -> str:
    return _with(fixture_cte(["raw_manifest"]), _ENTRIES) + f"""
SELECT feed, count(*) AS file_count FROM entries WHERE {_SELECTED} GROUP BY feed"""


_HALVES = "(VALUES (0, 42300), (43200, 85500)) AS h(s, e)"


def _window_rows(days_sql: str) -> str:
    return f"""
SELECT CAST(d AS TIMESTAMP) + to_seconds(h.s) AS window_start,
       CAST(d AS TIMESTAMP) + to_seconds(h.e) AS window_end
FROM ({days_sql}) dd, {_HALVES}"""


def ingest_windows() -> str:
    days = """SELECT unnest(generate_series(min(CAST(file_ts AS DATE)), max(CAST(file_ts AS DATE)),
                                    INTERVAL 1 DAY)) AS d FROM entries WHERE file_ts IS NOT NULL"""
    return _with(fixture_cte(["raw_manifest"]), _ENTRIES) + f"""
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end,
       CAST(strftime(window_start, '%Y%m%d%H%M%S') AS BIGINT) AS batch_seq
FROM ({_window_rows(days)}) w"""


def files_per_window(start_date: str, end_date: str) -> str:
    days = f"""SELECT unnest(generate_series(DATE {_lit(start_date)}, DATE {_lit(end_date)},
                                             INTERVAL 1 DAY)) AS d"""
    return _with(fixture_cte(["raw_manifest"]), _ENTRIES) + f"""
SELECT strftime(w.window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(w.window_end, '%Y-%m-%d %H:%M:%S') AS window_end,
       CAST(strftime(w.window_start, '%Y%m%d%H%M%S') AS BIGINT) AS batch_seq,
       count(e.feed) FILTER (WHERE e.feed = 'export') AS export_files,
       count(e.feed) FILTER (WHERE e.feed = 'mentions') AS mentions_files,
       count(e.feed) FILTER (WHERE e.feed = 'gkg') AS gkg_files,
       count(e.url) AS file_count
FROM ({_window_rows(days)}) w
LEFT JOIN (SELECT * FROM entries WHERE {_SELECTED}) e
  ON e.file_ts BETWEEN w.window_start AND w.window_end
GROUP BY w.window_start, w.window_end"""


def _sliding(first: str, last: str, hours: int, every: int) -> str:
    return f"""sliding AS (
  SELECT s AS window_start, s + INTERVAL {hours} HOUR - INTERVAL 1 SECOND AS window_end
  FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL {every} HOUR)) AS s) g)"""


_SLIDING_TEXT = """strftime(w.window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(w.window_end, '%Y-%m-%d %H:%M:%S') AS window_end"""


def files_per_any_window(first: str, last: str, hours: int, every: int) -> str:
    span = _sliding(f"TIMESTAMP {_lit(first)}", f"TIMESTAMP {_lit(last)}", hours, every)
    return _with(fixture_cte(["raw_manifest"]), _ENTRIES, span) + f"""
SELECT {_SLIDING_TEXT},
       count(e.feed) FILTER (WHERE e.feed = 'export') AS export_files,
       count(e.feed) FILTER (WHERE e.feed = 'mentions') AS mentions_files,
       count(e.feed) FILTER (WHERE e.feed = 'gkg') AS gkg_files,
       count(e.url) AS file_count
FROM sliding w
LEFT JOIN (SELECT * FROM entries WHERE {_SELECTED}) e
  ON e.file_ts BETWEEN w.window_start AND w.window_end
GROUP BY w.window_start, w.window_end"""


def mentions_per_any_window(hours: int, every: int) -> str:
    timed = """timed AS (
  SELECT TRY_STRPTIME(CAST(MentionTimeDate AS VARCHAR), '%Y%m%d%H%M%S') AS t
  FROM raw_mentions)"""
    span = _sliding("(SELECT date_trunc('day', min(t)) FROM timed)",
                    "(SELECT date_trunc('day', max(t)) FROM timed)", hours, every)
    return _with(fixture_cte(["raw_mentions"]), timed, span) + f"""
SELECT {_SLIDING_TEXT}, count(m.t) AS mention_count
FROM sliding w LEFT JOIN timed m ON m.t BETWEEN w.window_start AND w.window_end
GROUP BY w.window_start, w.window_end"""


# --- two windows upserted one after the other -------------------------------------
def two_window_event_mentions(splits: dict[int, dict[str, str]],
                              later_export: str = "raw_export") -> str:
    """Windows one after the other; all but the first export from ``later_export``."""
    ctes = [fixture_cte(["raw_export", later_export, "raw_mentions"])]
    for i, (b, pred) in enumerate(splits.items()):
        source = later_export if i else "raw_export"
        ctes.append(f"e{b} AS (SELECT * FROM {source} WHERE {pred['raw_export']})")
        ctes.append(f"m{b} AS (SELECT * FROM raw_mentions WHERE {pred['raw_mentions']})")
        ctes.append(EVENT_MENTIONS_CTE.format(name=f"em{b}", export=f"e{b}", mentions=f"m{b}"))
        ctes.append(UPSERT_EVENT_MENTIONS_CTE.format(name=f"u{b}", source=f"em{b}"))
    return _with(*ctes) + _merge_sql(list(splits))


def history_join(splits: dict[int, dict[str, str]]) -> str:
    """Events as of the last window that had them with a mention, language of the last mention."""
    ctes = [fixture_cte(["raw_export", "raw_mentions"])]
    for b, pred in splits.items():
        ctes.append(f"e{b} AS (SELECT * FROM raw_export WHERE {pred['raw_export']})")
        ctes.append(f"m{b} AS (SELECT * FROM raw_mentions WHERE {pred['raw_mentions']})")
        ctes.append(EVENT_MENTIONS_CTE.format(name=f"em{b}", export=f"e{b}", mentions=f"m{b}"))
        ctes.append(UPSERT_EVENT_MENTIONS_CTE.format(name=f"u{b}", source=f"em{b}"))
    union = "\n  UNION ALL ".join
    ctes.append("known AS (SELECT *, row_number() OVER (PARTITION BY global_event_id "
                "ORDER BY w DESC) AS rn FROM (\n  "
                + union(f"SELECT {b} AS w, * FROM u{b}" for b in splits) + ") k)")
    ctes.append("""
mentioned AS (SELECT *, row_number() OVER (PARTITION BY GlobalEventID ORDER BY w DESC,
    MentionTimeDate DESC NULLS LAST, MentionIdentifier ASC NULLS LAST,
    language ASC NULLS LAST) AS rn
  FROM (SELECT *, CASE WHEN substr(MentionDocTranslationInfo, 7, 3) <> ''
                       THEN substr(MentionDocTranslationInfo, 7, 3) ELSE 'eng' END AS language
        FROM (""" + union(f"SELECT {b} AS w, * FROM m{b}" for b in splits) + ") a) m)")
    return _with(*ctes) + """
SELECT global_event_id, event_year, event_month, event_day, language AS source_language,
       event_country, event_country_full_name, num_mentions
FROM known JOIN mentioned ON global_event_id = GlobalEventID
WHERE known.rn = 1 AND mentioned.rn = 1"""


def two_window_articles(splits: dict[int, dict[str, str]]) -> str:
    ctes = [fixture_cte(["raw_gkg"])]
    for b, pred in splits.items():
        ctes.append(f"g{b} AS (SELECT * FROM raw_gkg WHERE {pred['raw_gkg']})")
        ctes.append(ARTICLES_CTE.format(name=f"a{b}", gkg=f"g{b}"))
        ctes.append(UPSERT_ARTICLES_CTE.format(name=f"u{b}", source=f"a{b}"))
    return _with(*ctes) + _merge_sql(list(splits))


def on_two_windows(sql: str, splits: dict[int, dict[str, str]]) -> str:
    """A query over the articles as they are after the windows of ``two_window_articles``."""
    one_run = with_article_tables()
    assert sql.startswith(one_run)
    merged = two_window_articles(splits)
    ctes, rows = merged.removesuffix(_merge_sql(list(splits))), _merge_sql(list(splits))
    return f"{ctes.rstrip()},\nupsert_articles AS (\n{rows})\n{sql.removeprefix(one_run)}"


def _merge_sql(batches: list[int]) -> str:
    """Later batch wins per key."""
    parts = []
    for i, b in enumerate(batches):
        later = batches[i + 1:]
        cond = " AND ".join(
            f"global_event_id NOT IN (SELECT global_event_id FROM u{x})" for x in later)
        parts.append(f"SELECT * FROM u{b}" + (f" WHERE {cond}" if cond else ""))
    return "\nUNION ALL\n".join(parts)


def lines_of(lines_fixture: str) -> str:
    return _with(fixture_cte([lines_fixture])) + f"SELECT value FROM {lines_fixture}"
