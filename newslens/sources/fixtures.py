"""Fixture feeds derived from the provided test tables.

The reference ships no data; its inputs are live feeds.  These statements turn
the provided tables into raw export / mentions / gkg / manifest rows (and
their tab-separated line form).  Each text runs unchanged in Spark SQL and in
DuckDB: table names are ``{placeholders}`` that Spark binds to DataFrames
(``spark.sql(text, orders=df)``) and the oracle binds to view names or CTEs.
Their work grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newslens.schemas import EXPORT_SCHEMA, GKG_SCHEMA, MENTIONS_SCHEMA

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

FIXTURE_SQL: dict[str, str] = {
    # Events: country blank on every 17th, NumMentions null on every 23rd.
    "raw_export": """
SELECT o_orderkey AS GlobalEventID,
  CAST(year(o_orderdate)*10000+month(o_orderdate)*100+(day(o_orderdate)-1)%3+1 AS INT) AS Day,
  CASE WHEN o_orderkey%17=0 THEN '' WHEN c_nationkey%5=0 THEN 'FR' WHEN c_nationkey%5=1 THEN 'US'
       WHEN c_nationkey%5=2 THEN 'DE' WHEN c_nationkey%5=3 THEN 'ES' ELSE 'CN' END AS ActionGeo_CountryCode,
  concat('Cité ', CAST(c_custkey AS STRING), ', ', n_name) AS ActionGeo_FullName,
  CASE WHEN o_orderkey%23=0 THEN NULL ELSE CAST(o_orderkey*7919%97 AS INT)+1 END AS NumMentions
FROM {orders} JOIN {customer} ON o_custkey=c_custkey JOIN {nation} ON c_nationkey=n_nationkey
""",
    # Mentions: several per event; translation info blank, null or one of three codes.
    "raw_mentions": """
SELECT l_orderkey AS GlobalEventID,
  CAST(year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) AS BIGINT)*1000000 AS MentionTimeDate,
  concat('http://m.example/', CAST(l_partkey AS STRING), '/', CAST(l_linenumber AS STRING)) AS MentionIdentifier,
  CASE l_linenumber WHEN 1 THEN 'srclc:fra;eng:GT-FRA 1.0' WHEN 2 THEN 'srclc:spa;eng:GT-SPA 1.0'
       WHEN 3 THEN 'srclc:deu;eng:GT-DEU 1.0' WHEN 4 THEN '' ELSE NULL END AS MentionDocTranslationInfo
FROM {lineitem}
""",
    # Articles: blank fields, malformed and empty location segments, repeated
    # and trailing-';' persons, overlapping country names, integer tones.
    "raw_gkg": """
SELECT concat(CAST(d AS STRING), '-', CAST(event_id AS STRING)) AS GKGRECORDID, d AS DATE,
  CASE user_id%4 WHEN 0 THEN 'msn.com' WHEN 1 THEN 'yahoo.com' WHEN 2 THEN 'bbc.co.uk' ELSE '' END AS SourceCommonName,
  CASE WHEN event_id%19=0 THEN '' ELSE concat(upper(event_type), '#', CAST(event_id%9 AS STRING), '#people#1#Somewhere;KILL#2##') END AS V2Counts,
  CASE WHEN event_id%11=0 THEN '' ELSE concat('person ', CAST(user_id%7 AS STRING), ';person ', CAST(event_id%5 AS STRING), CASE WHEN event_id%13=0 THEN ';' ELSE '' END) END AS Persons,
  CASE WHEN event_id%29=0 THEN '' WHEN event_id%7=3 THEN 'abc' WHEN event_id%6=0 THEN concat('1#', c1, '#XX##1.0#2.0#XX')
       ELSE concat('4#Ýork, Región, ', c1, '#XX##1.0#2.0#-1;;1#', c2, '#YY##3.0#4.0#YY') END AS Locations,
  concat(CAST(CAST(round(value*100) AS INT)-5000 AS STRING), ',1.5,2.5,4,20,0,150') AS V2Tone
FROM (SELECT *, (2020+event_id%3)*10000000000+(1+event_id%4)*100000000+(1+(event_id%5))*1000000+120000 AS d,
  CASE (user_id+event_id)%6 WHEN 0 THEN 'France' WHEN 1 THEN 'United States' WHEN 2 THEN 'Niger' WHEN 3 THEN 'Nigeria' WHEN 4 THEN 'Guinea' ELSE 'Guinea-Bissau' END AS c1,
  CASE (user_id*3+event_id*2)%7 WHEN 0 THEN 'France' WHEN 1 THEN 'United States' WHEN 2 THEN 'Niger' WHEN 3 THEN 'Nigeria' WHEN 4 THEN 'Guinea' WHEN 5 THEN 'Guinea-Bissau' ELSE 'Spain' END AS c2
  FROM {events}) e
""",
    # Manifest lines: truncated lines, a non-date file name, six file kinds.
    "raw_manifest": """
SELECT CASE WHEN event_id%37=0 THEN 'truncated line'
  ELSE concat(CAST(100+event_id%900 AS STRING), ' ', md5(CAST(event_id AS STRING)), ' http://feed.example/v2/',
    CASE WHEN event_id%41=0 THEN 'latest' ELSE CAST(year(ts)*10000000000+month(ts)*100000000+day(ts)*1000000+hour(ts)*10000+(minute(ts)-minute(ts)%15)*100 AS STRING) END,
    CASE event_id%6 WHEN 0 THEN '.export.CSV.zip' WHEN 1 THEN '.mentions.CSV.zip' WHEN 2 THEN '.gkg.csv.zip'
         WHEN 3 THEN '.translation.export.CSV.zip' WHEN 4 THEN '.translation.mentions.CSV.zip' ELSE '.translation.gkg.csv.zip' END) END AS value
FROM {events}
""",
    # Variants with malformed and null dates, null counts, and null and malformed tones.
    "odd_export": """
SELECT GlobalEventID, CASE WHEN GlobalEventID%31=0 THEN 19981399 WHEN GlobalEventID%37=0 THEN NULL
         WHEN GlobalEventID%41=0 THEN 7 ELSE Day END AS Day,
  ActionGeo_CountryCode, ActionGeo_FullName,
  CASE WHEN Day < 19960101 THEN NULL ELSE NumMentions END AS NumMentions FROM {raw_export}
""",
    "odd_gkg": """
SELECT GKGRECORDID, CASE WHEN DATE%3=1 THEN NULL ELSE DATE END AS DATE, SourceCommonName, V2Counts, Persons, Locations,
  CASE length(GKGRECORDID)+length(V2Tone) WHEN 42 THEN NULL WHEN 43 THEN 'n/a,1' WHEN 44 THEN '' WHEN 45 THEN ',5' ELSE V2Tone END AS V2Tone FROM {raw_gkg}
""",
    # The same events, corrected a year later.
    "moved_export": """
SELECT GlobalEventID, Day+10000 AS Day, ActionGeo_CountryCode, ActionGeo_FullName, NumMentions FROM {raw_export}
""",
}

# The base number that the filled-in fields of a feed's lines are made from.
_FILL_BASE = {"raw_export": "GlobalEventID", "raw_mentions": "GlobalEventID", "raw_gkg": "DATE"}
_FEEDS = {"raw_export": EXPORT_SCHEMA, "raw_mentions": MENTIONS_SCHEMA, "raw_gkg": GKG_SCHEMA}
_OWN_FIELDS = {"raw_export": ("GlobalEventID", "Day", "ActionGeo_CountryCode",
                              "ActionGeo_FullName", "NumMentions"),
               "raw_mentions": ("GlobalEventID", "MentionTimeDate", "MentionIdentifier",
                                "MentionDocTranslationInfo"),
               "raw_gkg": ("GKGRECORDID", "DATE", "SourceCommonName", "V2Counts", "Persons",
                           "Locations", "V2Tone")}


def line_fields(raw: str) -> dict[str, str]:
    """SQL text of every field of a feed's line, in file order.

    Fields that the raw fixture has are its own; the others are made from the
    base number by a rule of their place and type, so that a shifted field shows.
    """
    out = {}
    for i, f in enumerate(_FEEDS[raw].fields):
        number = f"CAST({_FILL_BASE[raw]}%{i + 3} AS STRING)"
        if f.name in _OWN_FIELDS[raw]:
            out[f.name] = f"coalesce(CAST({f.name} AS STRING),'')"
        elif f.dataType.simpleString() == "string":
            out[f.name] = f"concat('{f.name.lower()} ñ', {number})"
        elif f.dataType.simpleString() == "double":
            out[f.name] = f"concat('-', {number}, '.5')"
        else:
            out[f.name] = number
    return out


for _raw in _FEEDS:
    # Tab-separated line form (61 / 16 / 27 fields).
    FIXTURE_SQL[f"{_raw}_lines"] = (
        "SELECT concat(" + ", chr(9), ".join(line_fields(_raw).values())
        + f") AS value FROM {{{_raw}}}")

# Which fixture each fixture reads (besides the base tables).
FIXTURE_DEPS = {
    "odd_export": ("raw_export",),
    "odd_gkg": ("raw_gkg",),
    "moved_export": ("raw_export",),
    "raw_export_lines": ("raw_export",),
    "raw_mentions_lines": ("raw_mentions",),
    "raw_gkg_lines": ("raw_gkg",),
}


def _placeholders(text: str) -> list[str]:
    import string

    return [f for _, f, _, _ in string.Formatter().parse(text) if f]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one fixture feed as a lazy DataFrame over the tables in ``sf_dir``."""
    text = FIXTURE_SQL[name]
    bound = {}
    for ref in _placeholders(text):
        bound[ref] = fixture(spark, sf_dir, ref) if ref in FIXTURE_SQL else read_table(
            spark, sf_dir, ref)
    return spark.sql(text, **bound)


def fixture_cte(names: list[str]) -> str:
    """``WITH``-clause body defining the given fixtures (and their inputs) for DuckDB."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        for dep in FIXTURE_DEPS.get(n, ()):
            visit(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in ordered:
        text = FIXTURE_SQL[n]
        body = text.format(**{p: p for p in _placeholders(text)}).strip()
        parts.append(f"{n} AS (\n{body}\n)")
    return ",\n".join(parts)


# --- two ingest windows over the whole fixture feeds -------------------------------
# Every mention falls in exactly one window and every event in at least one;
# events exported in both windows, and articles in both, exercise the upsert.
# The predicates are SQL text shared by Spark (``F.expr``) and the oracle.
TWO_WINDOW_SPLITS: dict[int, dict[str, str]] = {
    1: {"raw_export": "Day < 19990101",
        "raw_mentions": "MentionTimeDate < 19980701000000",
        "raw_gkg": "DATE < 20220101000000"},
    2: {"raw_export": "Day >= 19980101",
        "raw_mentions": "MentionTimeDate >= 19980701000000",
        "raw_gkg": "DATE >= 20210101000000"},
}
# Window starts used when the two windows are written as landing archives.
TWO_WINDOW_STARTS = {1: "1995-12-31 00:00:00", 2: "1995-12-31 12:00:00"}

# Three windows without overlap: mentions of the turn of a year come a window late.
HISTORY_SPLITS: dict[int, dict[str, str]] = {
    1: {"raw_export": "Day < 19960101", "raw_mentions": "MentionTimeDate < 19960101000000"},
    2: {"raw_export": "Day >= 19960101 AND Day < 19980101",
        "raw_mentions": "MentionTimeDate >= 19960101000000 AND MentionTimeDate < 19980101000000"},
    3: {"raw_export": "Day >= 19980101", "raw_mentions": "MentionTimeDate >= 19980101000000"},
}

LINE_FIXTURES = {"export": ("raw_export", "raw_export_lines", "export.CSV.zip"),
                 "mentions": ("raw_mentions", "raw_mentions_lines", "mentions.CSV.zip"),
                 "gkg": ("raw_gkg", "raw_gkg_lines", "gkg.csv.zip")}


def window_lines(spark: SparkSession, sf_dir: str, feed: str, window: int,
                 rows_per_file: int | None = None) -> DataFrame:
    """Tab-separated lines of one feed restricted to one of the two windows.

    With ``rows_per_file`` dealt out to as many partitions as that makes archives: the
    rows are, before they become lines, which are some ten times as wide.
    """
    from pyspark.sql import functions as F

    raw, lines_name, _ = LINE_FIXTURES[feed]
    rows = fixture(spark, sf_dir, raw).filter(F.expr(TWO_WINDOW_SPLITS[window][raw]))
    if rows_per_file:
        rows = rows.repartition(_archives_of(rows, rows_per_file))
    return spark.sql(FIXTURE_SQL[lines_name], **{raw: rows})


ROWS_PER_ARCHIVE = 20_000


def _archives_of(rows: DataFrame, rows_per_file: int) -> int:
    return max(1, -(-rows.count() // rows_per_file))


def write_archives(lines: DataFrame, out_dir: str, window_start: str, suffix: str,
                   rows_per_file: int | None = ROWS_PER_ARCHIVE, first: int = 0) -> DataFrame:
    """Write ``lines.value`` as zip archives of about ``rows_per_file`` rows (test fixture).

    With ``rows_per_file=None`` each partition of ``lines`` is an archive as it is.
    Archive ``i`` is named ``<window_start + 15 min * i>.<suffix>`` (past the window's
    46 quarters, again from the start with a number) and holds one member; odd
    archives are encoded in ISO-8859-1, even ones in UTF-8.  ``first`` shifts the
    numbering.  Returns one row per archive written: (path, line_count).  Lazy:
    the files are written when the result is evaluated, to any store that the
    executors reach.
    """
    import datetime as dt

    base = dt.datetime.fromisoformat(window_start)
    folder = out_dir.rstrip("/")

    def write(batches):
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs
        from pyspark import TaskContext

        system, out = (fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0]
                       else (fs.LocalFileSystem(), folder))
        pid = TaskContext.get().partitionId() + first
        key = (base + dt.timedelta(minutes=15 * (pid % 46))).strftime("%Y%m%d%H%M%S")
        key += f".{pid // 46}" if pid >= 46 else ""
        encoding = "iso-8859-1" if pid % 2 else "utf-8"
        buf, count = io.BytesIO(), 0
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as zf:
            with zf.open(f"{key}.{suffix.removesuffix('.zip')}", "w", force_zip64=True) as member:
                for b in batches:
                    if len(b):
                        text = "\n".join(b["value"]) + "\n"
                        member.write(text.encode(encoding, "replace"))
                        count += len(b)
        system.create_dir(out, recursive=True)
        path = f"{out}/{key}.{suffix}"
        with system.open_output_stream(path, compression=None) as fh:
            fh.write(buf.getvalue())
        yield pd.DataFrame({"path": [path], "line_count": [count]})

    lines = lines.select("value")
    if rows_per_file:
        lines = lines.repartition(_archives_of(lines, rows_per_file))
    return lines.mapInPandas(write, "path string, line_count bigint")
