"""Serving tables at rest: read, conform, and keyed write.

The reference keeps its two serving tables in a wide-column store keyed on
``global_event_id``.  Here they are Parquet directories partitioned by month or
by day (``event_year`` / ``event_month`` [/ ``event_day``], set when a table is
first written; take days once a month is more than one wants to rewrite):

* queries filtered on a day, month or year prune whole partitions;
* an upsert rewrites only the files that hold a row it replaces;
* rows are sorted by the main filter column inside each file so Parquet
  min/max statistics skip row groups for ``event_country`` /
  ``internet_source`` filters;
* ``compact_serving`` lays the rows of a partition along a space-filling curve over the
  two columns that queries filter on (``CLUSTER``) and cuts it into files, so most files
  of a month hold no row that a filter on either column lets through.

Every stored row carries ``batch_seq``, the sequence of the batch it came from.
The row of the greater sequence stays whatever order batches are applied in, and
a batch that is applied again changes nothing.

A key's old row may be in any partition, because a corrected event date moves it.
It is found through a key index beside the table (``<table>__keys``): key, batch
sequence and data file, in one folder per range of keys.  Both feeds number their
records in order of time, so a batch's keys lie in few ranges, and a lookup reads
these folders and then only the data files that hold one of the keys.  Entries are
added before a batch is committed and never changed; those whose data file has gone
are passed over, and ``compact_serving`` leaves them out.  A table without an index
gets one from a scan of its key column.  Counts and tone sums per day and value are
kept by data file in the same way once ``keep_totals`` was called (``totals.py``).

Writes are staged in a folder of fixed name beside the table: what stays of the
rewritten files together with new rows beside them, and files to add.  A marker file
then commits the batch with the names of the files it replaces; the staged files are
renamed into the table and the replaced ones deleted.  The next write of a table first
finishes what a committed staging folder still holds and throws away one without a
marker, so a crash at any point loses nothing.  One writer per table at a time; a
reader that lists the table during the renames may see both rows of a replaced key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.schemas import ARTICLES_SCHEMA, EVENT_MENTIONS_SCHEMA
from newslens.session import below_checkpoints, release, scratch_path
from newslens.sources import names, totals
from newslens.sources.clustering import curve_place

PARTITIONS = {"month": ["event_year", "event_month"],
              "day": ["event_year", "event_month", "event_day"]}
BATCH_SEQ = "batch_seq"
# Parquet codec of the serving tables: zstd reads about as fast as snappy and
# stores (and scans) noticeably fewer bytes, which dominates at 100 TB.
COMPRESSION = "zstd"
# Key ranges of the index: so many low bits of a number, so many first digits of a text.
KEY_BITS, KEY_DIGITS = 16, 8
# Folders for keys of neither form, by hash.
OTHER_BINS = 64
# A batch with keys of more ranges than this reads the whole index.
MAX_BINS = 10_000

SERVING = {
    "event_mentions": (EVENT_MENTIONS_SCHEMA, "global_event_id", "event_country"),
    "articles": (ARTICLES_SCHEMA, "global_event_id", "internet_source"),
}

# The columns that compacted files are clustered by.
CLUSTER = {"event_mentions": ["event_country", "event_day"],
           "articles": ["internet_source", "first_country"]}
# The columns of the name index.
NAMED = {"event_mentions": ["event_country_full_name"],
         "articles": ["first_country", "second_country"]}
# Rows of a compacted file at most: some 100 MB of articles.
FILE_ROWS = 2_000_000


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order, cast to its types (the serving DDL)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stored_schema(table: str) -> T.StructType:
    return T.StructType([*SERVING[table][0].fields, T.StructField(BATCH_SEQ, T.LongType())])


def with_seq(df: DataFrame) -> DataFrame:
    """Rows without a batch sequence count as the oldest."""
    return df if BATCH_SEQ in df.columns else df.withColumn(BATCH_SEQ, F.lit(0).cast("long"))


def read_stored(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The table with its batch sequence; partition columns come from the paths."""
    schema = stored_schema(table)
    return conform(spark.read.schema(schema).parquet(path), schema)


def read_serving(spark: SparkSession, path: str, table: str, fmt: str = "parquet",
                 **options: str) -> DataFrame:
    """Whole-table load; filters applied later reach the scan (pushdown/pruning).

    Parquet tables are read with the serving schema (no footer sampling; an
    empty table reads as zero rows); partition columns come from the paths.
    """
    schema = SERVING[table][0]
    reader = spark.read.format(fmt).options(**options)
    if fmt == "parquet":
        reader = reader.schema(schema)
    return conform(reader.load(path), schema)


def partitions_of(spark: SparkSession, path: str, new: str = "month") -> list[str]:
    """The partition columns of the table at ``path``, or those a new table gets."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for depth, column in enumerate(PARTITIONS["day"]):
        inner = next((f.getPath() for f in (fs.listStatus(folder) if fs.exists(folder) else ())
                      if f.getPath().getName().startswith(f"{column}=")), None)
        if inner is None:
            return PARTITIONS["month"] if depth == 2 else PARTITIONS[new]
        folder = inner
    return PARTITIONS["day"]


def write_serving(df: DataFrame, path: str, table: str, mode: str = "overwrite",
                  by: str | list[str] = "month") -> None:
    _, _, sort_col = SERVING[table]
    columns = PARTITIONS[by] if isinstance(by, str) else by
    # What is written here is not in the indexes or totals of an earlier table of that name.
    for beside in (keys_path, totals_path, names_path):
        _delete(df.sparkSession, beside(path))
    # REBALANCE (not repartition): AQE splits a hot partition over several writer
    # tasks and merges tiny ones, so one partition with a third of the rows does
    # not end up in one task.
    (conform(with_seq(df), stored_schema(table))
     .hint("rebalance", *columns)
     .sortWithinPartitions(*columns, sort_col)
     .write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", COMPRESSION)
     .partitionBy(*columns)
     .parquet(path))


def write_clustered(df: DataFrame, path: str, table: str, by: list[str],
                    file_rows: int = FILE_ROWS) -> None:
    """Write stored rows along the curve over ``CLUSTER``'s columns, in each partition.

    ``df`` is read three times: for the curve's axes (two columns), for the bounds of the
    ranges, and to be written.  Ranges end with the key, so any number of rows of one
    value is cut over several tasks.
    """
    key = SERVING[table][1]
    rows = conform(with_seq(df), stored_schema(table))
    order = [*by, "_place", *CLUSTER[table], key]
    (rows.withColumn("_place", curve_place(rows, CLUSTER[table]))
     .repartitionByRange(*order)
     .sortWithinPartitions(*order)
     .drop("_place")
     .write.mode("overwrite")
     .option("maxRecordsPerFile", file_rows)
     .option("compression", COMPRESSION)
     .partitionBy(*by)
     .parquet(path))


# --- staging folder -----------------------------------------------------------
class Staging:
    """``<table>__staging``: ``replace/`` and ``add/`` partitions, and a marker.

    Paths are handled through Hadoop's ``FileSystem``, so any store that Spark
    writes to will do.  What the driver lists is the files of one batch.
    """

    def __init__(self, spark: SparkSession, table_path: str):
        self.spark, self.table = spark, table_path.rstrip("/")
        self.root = f"{self.table}__staging"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.table).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration())
        if (self.fs.getUri().getScheme() == "file"
                and not spark.sparkContext.master.startswith("local")
                and not below_checkpoints(spark, self.table)):
            # The executors' file: paths may or may not be a shared mount; only the
            # operator can know, so it has to be said, for other folders than that
            # of the checkpoints, which has to be shared anyway.
            if spark.conf.get("newslens.sharedLocalPaths", "false") != "true":
                raise ValueError(
                    f"{self.table} is a local path on a cluster; use a shared store, or set "
                    "newslens.sharedLocalPaths=true if it is a mount that all nodes share")

    def sub(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def drop(self) -> None:
        self.fs.delete(self._path(self.root), True)

    def _files(self, name: str) -> list[str]:
        """Data files below a sub-folder, relative to it."""
        top = self._path(self.sub(name))
        if not self.fs.exists(top):
            return []
        base = self.fs.makeQualified(top).toString().rstrip("/") + "/"
        found, out = self.fs.listFiles(top, True), []
        while found.hasNext():
            rel = found.next().getPath().toString().removeprefix(base)
            if rel.endswith(".parquet"):
                out.append(rel)
        return sorted(out)

    def commit(self, replaced: list[str]) -> None:
        """Write the marker: the table's files that the staged ones take the place of."""
        out = self.fs.create(self._path(self.sub("_marker")), True)
        try:
            out.write(bytearray("\n".join(replaced), "utf-8"))
        finally:
            out.close()
        # The rename makes the marker appear whole or not at all.
        self._rename(self._path(self.sub("_marker")), self._path(self.sub("_COMMITTED")))

    def _committed(self) -> list[str]:
        stream = self.fs.open(self._path(self.sub("_COMMITTED")))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(
                stream, "UTF-8")
        finally:
            stream.close()
        return [line for line in text.split("\n") if line]

    def apply(self) -> None:
        """Move committed files into the table; may be run again at any point."""
        replaced = self._committed()
        for name in ("replace", "add"):
            for rel in self._files(name):
                target = self._path(f"{self.table}/{rel}")
                self.fs.mkdirs(target.getParent())
                self._rename(self._path(f"{self.sub(name)}/{rel}"), target)
        for rel in replaced:
            self.fs.delete(self._path(f"{self.table}/{rel}"), False)
        self.drop()

    def gone(self, files: list[str]) -> list[str]:
        """Which of the table's files do not exist (any more)."""
        there: set[str] = set()
        for folder in {f.rsplit("/", 1)[0] for f in files}:
            top = self._path(f"{self.table}/{folder}")
            if self.fs.exists(top):
                there |= {f"{folder}/{x.getPath().getName()}" for x in self.fs.listStatus(top)}
        return sorted(set(files) - there)

    def _rename(self, source, target) -> None:
        if not self.fs.rename(source, target):
            raise OSError(f"cannot rename {source.toString()} to {target.toString()}")

    def recover(self) -> None:
        """Finish a committed write, throw away an unfinished one."""
        if self.exists(self.sub("_COMMITTED")):
            self.apply()
        else:
            self.drop()


def _partition_predicate(rows, columns: list[str]) -> Column:
    """``(year = y AND ((month = m AND day IN (...)) OR ...)) OR ...``, for pruning."""
    first, *rest = columns
    if not rest:
        return F.col(first).isin(sorted({r[first] for r in rows}))
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[first], []).append(r)
    cond = F.lit(False)
    for value, inner in sorted(groups.items()):
        cond = cond | ((F.col(first) == value) & _partition_predicate(inner, rest))
    return cond


# --- key index ----------------------------------------------------------------
def keys_path(path: str) -> str:
    return f"{path.rstrip('/')}__keys"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def key_bin(key: Column, data_type: T.DataType) -> Column:
    """The range that a key lies in, as a folder's name."""
    if isinstance(data_type, T.LongType):
        return F.shiftright(key, KEY_BITS).cast("string")
    other = F.concat(F.lit("other-"), F.pmod(F.xxhash64(key), F.lit(OTHER_BINS)).cast("string"))
    return F.when(key.rlike(f"^[0-9]{{{KEY_DIGITS}}}"), F.substring(key, 1, KEY_DIGITS)).otherwise(
        other)


def _index_schema(table: str) -> T.StructType:
    key = SERVING[table][1]
    return T.StructType([T.StructField(key, SERVING[table][0][key].dataType),
                         T.StructField(BATCH_SEQ, T.LongType()),
                         T.StructField("file", T.StringType()),
                         T.StructField("bin", T.StringType())])


def _with_file(spark: SparkSession, folder: str, table: str, columns: list[str]) -> DataFrame:
    """The rows of the data files below ``folder``, each with the file's place in the table."""
    rows = spark.read.schema(stored_schema(table)).parquet(folder)
    return rows.withColumn("file", F.concat_ws(
        "/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in columns],
        F.col("_metadata.file_name")))


def _index_rows(spark: SparkSession, folder: str, table: str, columns: list[str],
                to: str, mode: str) -> None:
    """Write an entry for every row of the data files below ``folder`` (key column alone)."""
    key = SERVING[table][1]
    rows = _with_file(spark, folder, table, columns)
    (rows.select(key, BATCH_SEQ, "file",
                 key_bin(F.col(key), rows.schema[key].dataType).alias("bin"))
     .hint("rebalance", "bin").sortWithinPartitions("bin", key)
     .write.mode(mode).option("compression", COMPRESSION).partitionBy("bin").parquet(to))


def build_keys(spark: SparkSession, path: str, table: str) -> None:
    """The index of a whole table, in place of the one it has."""
    fresh, keys = f"{keys_path(path)}_new", keys_path(path)
    _index_rows(spark, path, table, partitions_of(spark, path), fresh, "overwrite")
    _delete(spark, keys)
    # Between the two the table has no index, so the next write builds one.
    staging = Staging(spark, path)
    staging._rename(staging._path(fresh), staging._path(keys))


def places_of(spark: SparkSession, keys: DataFrame, path: str, table: str) -> DataFrame:
    """``key, batch_seq, file`` of the index entries of some keys (a frame of the key column).

    Reads the index folders of the keys' ranges.  Files that have gone since are not
    told apart here.
    """
    key = SERVING[table][1]
    if not Staging(spark, path).exists(keys_path(path)):
        build_keys(spark, path, table)
    schema = _index_schema(table)
    index = spark.read.schema(schema).parquet(keys_path(path))
    bins = (keys.select(key_bin(F.col(key), schema[key].dataType).alias("bin")).distinct()
            .limit(MAX_BINS + 1).collect())
    if len(bins) <= MAX_BINS:
        index = index.filter(F.col("bin").isin([r.bin for r in bins]))
    return index.drop("bin").join(keys.select(key).distinct(), key)


def _live_places(spark: SparkSession, keys: DataFrame, path: str, table: str,
                 staged: str) -> DataFrame:
    """``places_of`` without files that have gone, written once to the folder ``staged``."""
    staging = Staging(spark, path)
    found = places_of(spark, keys, path, table)
    found.write.mode("overwrite").parquet(staged)
    found = spark.read.schema(found.schema).parquet(staged)
    gone = staging.gone([r.file for r in found.select("file").distinct().collect()])
    return found.filter(~F.col("file").isin(gone)) if gone else found


def read_files(spark: SparkSession, path: str, table: str, files: list[str]) -> DataFrame:
    """Some data files of the table, named as in its index."""
    schema = stored_schema(table)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(
        *[f"{path.rstrip('/')}/{f}" for f in files])
    return conform(rows, schema)


def rows_of_keys(spark: SparkSession, keys: DataFrame, path: str, table: str) -> DataFrame:
    """The stored rows of some keys, read from the files that hold one of them."""
    key = SERVING[table][1]
    staging = Staging(spark, path)
    if not staging.exists(path):
        return spark.createDataFrame([], stored_schema(table))
    found = _live_places(spark, keys, path, table, scratch_path(spark, "lookup"))
    files = sorted(r.file for r in found.select("file").distinct().collect())
    return read_files(spark, path, table, files).join(found.select(key), key, "left_semi")


# --- totals -------------------------------------------------------------------
def totals_path(path: str) -> str:
    return f"{path.rstrip('/')}__totals"


def _file_names(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``path`` and ``file`` (the place in the table) of all data files, from a listing."""
    names = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(path).select("path"))
    return names.select("path", F.substring_index("path", "/", -len(columns) - 1).alias("file"))


def _count_staged(spark: SparkSession, folder: str, path: str, table: str,
                  columns: list[str]) -> None:
    """Entries of staged files in the totals and the name index, if the table keeps them."""
    staging, rows = Staging(spark, path), _with_file(spark, folder, table, columns)
    if staging.exists(names_path(path)):
        known = spark.read.schema(names.SCHEMA).parquet(names_path(path))
        new = names.names_of(rows, NAMED[table]).join(known, "name", "left_anti")
        if not new.isEmpty():
            names.write_names(new, names_path(path), "append")
    if staging.exists(totals_path(path)):
        for rollup in totals.ROLLUPS[table]:
            totals.write_entries(totals.count_files(rows, table, rollup), table, rollup,
                                 totals_path(path), "append")


def _entries(spark: SparkSession, path: str, table: str, rollup: str) -> DataFrame:
    """A rollup's entries of the files that are there."""
    kept = (spark.read.schema(totals.rollup_schema(table, rollup))
            .parquet(f"{totals_path(path)}/{rollup}"))
    names = _file_names(spark, path, partitions_of(spark, path)).select("file")
    return kept.join(names, "file", "left_semi")


def _put_totals(spark: SparkSession, path: str, table: str, entries) -> None:
    """Write ``entries(rollup)`` of all rollups in place of the table's totals."""
    fresh = f"{totals_path(path)}_new"
    for rollup in totals.ROLLUPS[table]:
        totals.write_entries(entries(rollup), table, rollup, fresh, "overwrite")
    _delete(spark, totals_path(path))
    # Between the two the table keeps no totals; ``keep_totals`` counts them anew.
    staging = Staging(spark, path)
    staging._rename(staging._path(fresh), staging._path(totals_path(path)))


def keep_totals(spark: SparkSession, path: str, table: str) -> None:
    """Count the table's rollups; from now on every upsert keeps them up to date."""
    Staging(spark, path).recover()
    rows = _with_file(spark, path, table, partitions_of(spark, path))
    _put_totals(spark, path, table, lambda rollup: totals.count_files(rows, table, rollup))


def read_totals(spark: SparkSession, path: str, table: str, rollup: str) -> DataFrame:
    """A rollup's columns, ``event_year``, ``event_month``, ``event_day`` and the measures.

    A combination may come in several rows, one per file that holds it.
    """
    if not Staging(spark, path).exists(totals_path(path)):
        raise ValueError(f"{path} keeps no totals; see keep_totals")
    return _entries(spark, path, table, rollup).drop("file")


# --- names --------------------------------------------------------------------
def names_path(path: str) -> str:
    return f"{path.rstrip('/')}__names"


def keep_names(spark: SparkSession, path: str, table: str) -> None:
    """Index the table's country names; from now on every upsert adds new ones."""
    Staging(spark, path).recover()
    names.write_names(names.names_of(read_stored(spark, path, table), NAMED[table]),
                      names_path(path), "overwrite")


def read_names(spark: SparkSession, path: str):
    """What ``themes_by_countries`` takes as ``names``: a text's names by the index."""
    if not Staging(spark, path).exists(names_path(path)):
        raise ValueError(f"{path} has no name index; see keep_names")
    return names.finder(spark.read.schema(names.SCHEMA).parquet(names_path(path)))


# --- writes -------------------------------------------------------------------
def upsert_serving(spark: SparkSession, batch: DataFrame, path: str, table: str,
                   by: str = "month") -> int:
    """Apply one batch (one row per key) to the keyed table at ``path``; returns batch rows.

    * Old rows are found through the key index.
    * Files that hold a replaced row are rewritten without it; batch rows that fall in
      other partitions are added as files of their own (the common case).
    * Batch rows whose key is stored with a greater ``batch_seq`` are left out.

    ``by`` (month or day) is how a new table is partitioned.
    """
    try:
        return _upsert(spark, batch, path, table, by)
    finally:
        release(spark)


def _upsert(spark: SparkSession, batch: DataFrame, path: str, table: str, by: str) -> int:
    key = SERVING[table][1]
    staging = Staging(spark, path)
    staging.recover()
    columns = partitions_of(spark, path, by)
    conform(with_seq(batch), stored_schema(table)).write.mode("overwrite").parquet(
        staging.sub("batch"))
    release(spark)
    batch = spark.read.schema(stored_schema(table)).parquet(staging.sub("batch"))
    n = batch.count()
    if not staging.exists(path):
        # First load: nothing to merge, and no totals or names of these files.
        for beside in (totals_path, names_path):
            _delete(spark, beside(path))
        write_serving(batch, staging.sub("add"), table, by=columns)
        if not n:
            write_serving(batch, path, table, by=columns)
        _index_rows(spark, staging.sub("add"), table, columns, keys_path(path), "overwrite")
        staging.commit([])
        staging.apply()
        return n
    if not n:
        staging.drop()
        return 0
    places = _live_places(spark, batch.select(key), path, table, staging.sub("old"))
    old = places.join(batch.select(key, F.col(BATCH_SEQ).alias("new_seq")), on=key)
    stays = F.col(BATCH_SEQ) > F.col("new_seq")
    batch = batch.join(old.filter(stays).select(key), on=key, how="left_anti")
    # Names of files at most, however many rows there are.
    touched = sorted(r.file for r in old.filter(~stays).select("file").distinct().collect())
    added = batch
    if touched:
        stored = read_files(spark, path, table, touched)
        rest = stored.join(old.filter(~stays).select(key), on=key, how="left_anti")
        replaced = _partition_predicate(_partitions(touched, columns), columns)
        write_serving(rest.unionByName(batch.filter(replaced).select(*rest.columns)),
                      staging.sub("replace"), table, by=columns)
        _index_rows(spark, staging.sub("replace"), table, columns, keys_path(path), "append")
        _count_staged(spark, staging.sub("replace"), path, table, columns)
        added = batch.filter(~replaced)
    write_serving(added, staging.sub("add"), table, by=columns)
    _index_rows(spark, staging.sub("add"), table, columns, keys_path(path), "append")
    _count_staged(spark, staging.sub("add"), path, table, columns)
    staging.commit(touched)
    staging.apply()
    return n


def _partitions(files: list[str], columns: list[str]) -> list[dict[str, int]]:
    """The partitions of some data files."""
    folders = {f.rsplit("/", 1)[0] for f in files}
    return [{c: int(part.split("=")[1]) for c, part in zip(columns, folder.split("/"))}
            for folder in sorted(folders)]


def compact_serving(spark: SparkSession, path: str, table: str, min_files: int = 8,
                    file_rows: int = FILE_ROWS) -> int:
    """Rewrite partitions that hold at least ``min_files`` files (from added batches).

    Files are counted over a listing of names, no row is read for it.  Rows are
    unchanged; they come to lie along a curve (``write_clustered``), so ``min_files=1``
    clusters a whole table.  The key index is built anew.  Returns the number of
    partitions rewritten.
    """
    staging = Staging(spark, path)
    staging.recover()
    columns = partitions_of(spark, path)
    place = [F.regexp_extract("path", f"/{c}=([0-9]+)/", 1).cast("int").alias(c)
             for c in columns]
    # Names of the files that are about to be replaced.
    targets = (_file_names(spark, path, columns).select(*place, "file")
               .groupBy(*columns).agg(F.collect_list("file").alias("files"))
               .filter(F.size("files") >= min_files).collect())
    if not targets:
        return 0
    rows = read_stored(spark, path, table).filter(
        _partition_predicate(targets, columns))
    write_clustered(rows, staging.sub("replace"), table, columns, file_rows)
    if staging.exists(keys_path(path)):
        _index_rows(spark, staging.sub("replace"), table, columns, keys_path(path), "append")
    _count_staged(spark, staging.sub("replace"), path, table, columns)
    staging.commit(sorted(f for r in targets for f in r.files))
    staging.apply()
    build_keys(spark, path, table)
    if staging.exists(totals_path(path)):
        _put_totals(spark, path, table, lambda rollup: _entries(spark, path, table, rollup))
    return len(targets)
