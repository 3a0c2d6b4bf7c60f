"""Writers for the raw and staging layers.

* Formats: text (the '|' / '\\' raw dialect), parquet, orc, and avro when the
  Avro data source is on the classpath. Sequence and RC files are refused.
* Compression follows the format: snappy for parquet/orc/avro, gzip for
  text, none when compression is switched off.
* Partitioned writes go through a ``rebalance`` hint on the partition
  columns: AQE then splits a hot period into several advisory-sized tasks
  and merges small ones, so a period holding a third of the rows neither
  lands in one task nor explodes into tiny files.
* ``dynamic=True`` overwrites only the partitions present in the data (a
  per-write option, not a session setting).
* Raw batches live under ``batch_id=<id>`` partitions: the current batch is
  a partition filter away, older batches are the archive. A batch is landed in
  a folder that readers skip and then published by a rename, so a rerun with
  fewer periods, or no rows, leaves exactly the new batch.
* A table is replaced by renames, and the old version is set aside until the
  new one stands; ``recover`` puts it back if a run died in between. On an
  object store, where a rename is a copy, point the layout at a store with
  atomic renames.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import (data_files, delete_path, list_dirs, make_dirs, path_exists, read_text,
                               rename_path, replace_text, write_text)
from lodestone.sources.rawtext import read_raw_text, to_lines

# Accepted format names (case-insensitive) and their meaning.
FORMATS = {
    "TEXTFILE": "text", "TXT": "text", "TEXT": "text",
    "PARQUET": "parquet", "ORC": "orc", "AVRO": "avro",
}
# Row formats that are refused.
REJECTED_FORMATS = ("SEQ", "SEQUENCEFILE", "RC", "RCFILE")
COMPRESSION = {"parquet": "snappy", "orc": "snappy", "avro": "snappy", "text": "gzip"}
BATCH_COL = "batch_id"
#: Rows in one file at most: compressed text cannot be split by its readers.
MAX_RECORDS = 5_000_000


class FormatError(ValueError):
    pass


def resolve_format(name: str | None, default: str = "parquet") -> str:
    key = (name or default).strip().upper()
    if key in REJECTED_FORMATS:
        raise FormatError(f"format {name!r} is not supported (row-oriented legacy format); "
                          "use TEXTFILE, PARQUET, ORC or AVRO")
    if key not in FORMATS:
        raise FormatError(f"unknown format {name!r}")
    return FORMATS[key]


def avro_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroFileFormat")
        return True
    except Exception:
        return False


def avro_schema(names: list[str], record: str = "raw") -> str:
    """The Avro schema of raw rows as JSON: nullable strings with a NULL default,
    so that batches landed before a column was added read as NULL there."""
    bad = [c for c in names if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", c)]
    if bad:
        raise FormatError(f"columns {bad} cannot be Avro field names")
    fields = [{"name": c, "type": ["null", "string"], "default": None} for c in names]
    return json.dumps({"type": "record", "name": record, "fields": fields})


def compression_for(fmt: str, compress: bool = True) -> str:
    return COMPRESSION[fmt] if compress else "none"


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: list[str] | None = None, compress: bool = True,
                  dynamic: bool = False, rebalance_exempt: tuple[str, ...] = (),
                  max_records: int = MAX_RECORDS) -> None:
    fmt = resolve_format(fmt)
    if fmt == "avro" and not avro_available(df.sparkSession):
        raise FormatError("the Avro data source is not on the classpath")
    parts = list(partition_by or [])
    data_cols = [c for c in df.columns if c not in parts]
    spread = [p for p in parts if p not in (rebalance_exempt or ())]
    if spread:
        # before the text encoding, so lines are built after the exchange,
        # in as many tasks as the rebalance produces
        df = df.hint("rebalance", *spread)
    if fmt == "text":
        df = df.select(to_lines(df, data_cols).alias("value"), *parts)
    w = df.write.mode(mode).format(fmt).option("compression", compression_for(fmt, compress))
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    if parts:
        w = w.partitionBy(*parts)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet",
                 names: list[str] | None = None, schema=None) -> DataFrame:
    """Read back a dataset; text needs the data column names, in order."""
    fmt = resolve_format(fmt)
    if fmt == "text":
        if not names:
            raise ValueError("reading raw text needs the column names (the header)")
        return read_raw_text(spark, path, names)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


# ----------------------------------------------------------------- raw layer

def as_strings(df: DataFrame) -> DataFrame:
    """Every column as text (how a raw copy of any source looks)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def widen(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread a source known to arrive in few partitions (one unsplittable
    file, a single-stream JDBC pull) over the cluster, so that landing, parsing
    and cleansing run in parallel. A wide source needs no such shuffle."""
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


def _landing(raw_path: str, batch_id: str) -> str:
    return f"{raw_path}/_landing_{batch_id}"


def land_batch(df: DataFrame, raw_path: str, batch_id: str, fmt: str = "text",
               partition_col: str | None = None, compress: bool = True, narrow: bool = False) -> None:
    """Write one extract batch as text columns where readers do not look yet.
    A period column is rebalanced by the write itself."""
    strings = as_strings(df)
    if narrow and not partition_col:
        strings = widen(strings)
    write_dataset(strings, _landing(raw_path, batch_id), fmt, mode="overwrite",
                  partition_by=[partition_col] if partition_col else None, compress=compress)


def publish_batch(spark: SparkSession, raw_path: str, batch_id: str, archive: bool = False) -> None:
    """Make the landed batch the batch of its id. Without archiving, other
    batches go once it stands. Publishing a batch twice changes nothing."""
    landed, batch = _landing(raw_path, batch_id), f"{raw_path}/{BATCH_COL}={batch_id}"
    recover(spark, batch)
    if path_exists(spark, landed):
        swap_in(spark, batch, landed, keep_previous=False)
    elif not path_exists(spark, batch):
        raise FileNotFoundError(f"batch {batch_id!r} has not been landed in {raw_path}")
    if not archive:
        for d in list_dirs(spark, raw_path):
            if d.startswith(f"{BATCH_COL}=") and d != f"{BATCH_COL}={batch_id}":
                delete_path(spark, f"{raw_path}/{d}")


def land_raw(df: DataFrame, raw_path: str, batch_id: str, fmt: str = "text",
             partition_col: str | None = None, compress: bool = True,
             archive: bool = False, narrow: bool = False) -> None:
    """Land and publish one batch."""
    land_batch(df, raw_path, batch_id, fmt, partition_col, compress, narrow)
    publish_batch(df.sparkSession, raw_path, batch_id, archive)


def read_raw(spark: SparkSession, raw_path: str, names: list[str], fmt: str = "text",
             batch_id: str | None = None, partition_col: str | None = None,
             fields_col: str | None = None) -> DataFrame:
    """All-string raw rows (optionally of one batch: a partition filter, so
    only that batch's files are listed and read). ``fields_col`` adds to rows of
    text the number of fields that their line has."""
    fmt = resolve_format(fmt)
    parts = [BATCH_COL] + ([partition_col] if partition_col else [])
    if batch_id is not None and not data_files(spark, f"{raw_path}/{BATCH_COL}={batch_id}"):
        # an extract that returned no rows lands no files
        from pyspark.sql import types as T
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names + parts])
        none = spark.createDataFrame([], schema)
        return none.withColumn(fields_col, F.lit(0)) if fields_col and fmt == "text" else none
    if fmt == "text":
        df = read_raw_text(spark, raw_path, names, parts, fields_col)
    else:
        told = {"avroSchema": avro_schema(names)} if fmt == "avro" else {}
        df = spark.read.format(fmt).options(**told).load(raw_path)
        df = df.select(*[F.col(c).cast("string").alias(c) for c in names],
                       *[c for c in df.columns if c not in names])
    if batch_id is not None:
        df = df.filter(F.col(BATCH_COL) == F.lit(str(batch_id)))
    return df


def raw_batches(spark: SparkSession, raw_path: str) -> list[str]:
    return [d.split("=", 1)[1] for d in list_dirs(spark, raw_path)
            if d.startswith(f"{BATCH_COL}=")]


def partition_label_from_path(path_col=None):
    """Partition label of a file: its parent directory name with '=' -> '_'
    (``.../month=199601/part-0.gz`` -> ``month_199601``)."""
    p = path_col if path_col is not None else F.input_file_name()
    parent = F.regexp_extract(p, r"([^/]+)/[^/]+$", 1)
    return F.replace(parent, F.lit("="), F.lit("_"))


# ------------------------------------------------------------- staging layer

def write_staging(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_col: str | None = None, periods: list[str] | None = None,
                  dynamic: bool = False, compress: bool = True) -> None:
    """Typed staging write.

    ``periods`` restricts the rows to the listed partition values in the same
    pass (one job for all periods, not one per period)."""
    if periods is not None:
        if not partition_col:
            raise ValueError("periods need a partition column")
        df = df.filter(F.col(partition_col).isin(list(periods)))
    write_dataset(df, path, fmt, mode=mode,
                  partition_by=[partition_col] if partition_col else None,
                  compress=compress, dynamic=dynamic)


def _aside(path: str) -> str:
    """Where the old version of ``path`` waits; readers skip the name."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_old_{name}"


def recover(spark: SparkSession, path: str) -> bool:
    """After a run that died between the renames of ``swap_in``: the table is
    put back if it is away, and what a finished swap left behind is dropped."""
    old = _aside(path)
    if not path_exists(spark, old):
        return False
    if path_exists(spark, path):
        delete_path(spark, old)
        return False
    rename_path(spark, old, path)
    return True


def swap_in(spark: SparkSession, table_path: str, new_path: str, keep_previous: bool = True) -> None:
    """Make the complete ``new_path`` the table. The old version is renamed
    aside, the new one into place, and only then does the old one move to
    ``new_path`` (or go). At every step one whole version exists; ``recover``
    finds it."""
    if not path_exists(spark, new_path):
        raise FileNotFoundError(f"no new version at {new_path}")
    recover(spark, table_path)
    old = _aside(table_path)
    had_table = path_exists(spark, table_path)
    if had_table:
        rename_path(spark, table_path, old)
    rename_path(spark, new_path, table_path)
    if had_table and keep_previous:
        rename_path(spark, old, new_path)
    elif had_table:
        delete_path(spark, old)


def replace_partitions(spark: SparkSession, table_path: str, new_path: str, column: str,
                       values: list[str] | None = None) -> list[str]:
    """Swap each partition folder of the complete ``new_path`` into the table;
    of ``values`` (all partitions that are being replaced), those without rows
    in ``new_path`` go. Doing it again after a crash ends the same. Returns the
    folders that were swapped in."""
    make_dirs(spark, table_path)
    fresh = [d for d in list_dirs(spark, new_path) if d.startswith(f"{column}=")]
    for d in {*fresh, *(f"{column}={v}" for v in values or [])}:
        recover(spark, f"{table_path}/{d}")
        if d in fresh:
            swap_in(spark, f"{table_path}/{d}", f"{new_path}/{d}", keep_previous=False)
        else:
            delete_path(spark, f"{table_path}/{d}")
    delete_path(spark, new_path)
    return fresh


_CHANGE = "_change"


def replace_files(spark: SparkSession, table_path: str, new_path: str, removed: list[str]) -> list[str]:
    """Replace single files of a table: those at ``removed`` (below the table)
    give way to all files of the complete ``new_path``; others stay as they are.
    What is to be done is written down first, so that ``finish_change`` can end
    it after a crash. (Renames and deletes of files; no data passes here.)
    Returns the folders that got or lost files."""
    change = f"{table_path}/{_CHANGE}"
    delete_path(spark, change)
    make_dirs(spark, change)
    added = [f"{folder}{name}" for folder, name in data_files(spark, new_path)]
    rename_path(spark, new_path, f"{change}/data")
    write_text(spark, f"{change}/plan", "\n".join([f"+{f}" for f in added] + [f"-{f}" for f in removed]))
    finish_change(spark, table_path)
    return sorted({f.rpartition("/")[0] for f in [*added, *removed]})


def finish_change(spark: SparkSession, table_path: str) -> bool:
    """Ends a ``replace_files`` that was written down; one that wasn't is dropped
    and the table is as before. Doing it again changes nothing."""
    change = f"{table_path}/{_CHANGE}"
    plan = read_text(spark, f"{change}/plan")
    if plan is None:
        if path_exists(spark, change):
            delete_path(spark, change)
        return False
    steps = plan.splitlines()
    for f in (s[1:] for s in steps if s[0] == "+"):
        if path_exists(spark, f"{change}/data/{f}"):
            make_dirs(spark, f"{table_path}/{f}".rpartition("/")[0])
            rename_path(spark, f"{change}/data/{f}", f"{table_path}/{f}")
    for f in (s[1:] for s in steps if s[0] == "-"):
        delete_path(spark, f"{table_path}/{f}")
    delete_path(spark, change)
    return True


def remove_batch_files(spark: SparkSession, path: str, batch_id: str) -> None:
    for folder, name in data_files(spark, path):
        if name.startswith(f"batch-{batch_id}-"):
            delete_path(spark, f"{path}/{folder}{name}")


def append_batch(df: DataFrame, path: str, batch_id: str, fmt: str = "parquet",
                 partition_col: str | None = None, compress: bool = True) -> list[str]:
    """Append rows once per batch id: they are written aside and then renamed
    into the table under names that carry the id, after files of that id from
    an earlier attempt are gone. (A rename for each file; no data passes here.)
    Returns the folders that got files."""
    spark, attempt = df.sparkSession, f"{path}/_append_{batch_id}"
    write_dataset(df, attempt, fmt, partition_by=[partition_col] if partition_col else None, compress=compress)
    remove_batch_files(spark, path, batch_id)
    written = data_files(spark, attempt)
    for folder, name in written:
        make_dirs(spark, f"{path}/{folder}")
        rename_path(spark, f"{attempt}/{folder}{name}", f"{path}/{folder}batch-{batch_id}-{name}")
    delete_path(spark, attempt)
    return sorted({folder for folder, _ in written})


# ------------------------------------------------------------------ versions

POINTER = "_current"


def versions(spark: SparkSession, table_path: str) -> list[int]:
    return sorted(int(d[2:]) for d in list_dirs(spark, table_path) if d.startswith("_v") and d[2:].isdigit())


def current_version(spark: SparkSession, table_path: str) -> str:
    """The folder that holds the table's rows now. A reader that asks once stays
    with this version, whatever is published meanwhile. A table without versions
    is its own folder."""
    found = read_text(spark, f"{table_path}/{POINTER}")
    return f"{table_path}/{found}" if found else table_path


def publish_version(spark: SparkSession, table_path: str, new_path: str, keep: int = 2) -> str:
    """Make the complete ``new_path`` the table's next version. It becomes a
    version folder, and then one small file that names it replaces the one that
    names the old: the table never is away, and a crash leaves the old version or
    the new one. The last ``keep`` versions stay for readers that are at work. (On
    an object store, write ``new_path`` as the version folder: a folder's rename
    is a copy there, that of the pointer is one small object.)"""
    have = versions(spark, table_path)
    name = f"_v{(have[-1] if have else 0) + 1:08d}"
    make_dirs(spark, table_path)
    if new_path != f"{table_path}/{name}":
        rename_path(spark, new_path, f"{table_path}/{name}")
    replace_text(spark, f"{table_path}/{POINTER}", name)
    for old in versions(spark, table_path)[:-keep]:
        delete_path(spark, f"{table_path}/_v{old:08d}")
    return f"{table_path}/{name}"


# ------------------------------------------------------------------ catalog

def _ddl_type(t) -> str:
    return t.simpleString()


def create_external(spark: SparkSession, database: str, table: str, schema, path: str,
                    fmt: str = "parquet", partition_col: str | None = None,
                    replace: bool = False) -> str:
    """Create the database if missing and an external table over ``path``
    (``replace=True`` drops and recreates the table entry, never the data)."""
    fmt = resolve_format(fmt)
    if fmt == "text":
        raise FormatError("catalog tables over raw text: read with read_raw instead")
    name = f"{database}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = ", ".join(f"`{f.name}` {_ddl_type(f.dataType)}" for f in schema.fields
                     if f.name != partition_col)
    if partition_col:
        cols += f", `{partition_col}` string"
    part = f" PARTITIONED BY (`{partition_col}`)" if partition_col else ""
    known = spark.catalog.tableExists(name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}{part} "
              f"LOCATION '{path}'")
    if partition_col and not known and path_exists(spark, path):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def _quoted(value: str) -> str:
    return str(value).replace("\\", "\\\\").replace("'", "\\'")


def partition_values(folders) -> list[str]:
    """Values of one partition column from folder names (``month=199601``)."""
    found = {f.strip("/").partition("=")[2] for f in folders if "=" in f}
    return sorted(unquote(v) for v in found)


def create_latest_view(spark: SparkSession, database: str, table: str, keys: list[str], ts: str,
                       base: str | None = None, incr: str | None = None) -> str:
    """The persisted view ``<table>_view``: of base and increment (catalog tables,
    ``<table>`` and ``<table>_incr`` unless named) the rows with the greatest
    ``ts`` of their key, as ``latest_version`` gives them. The keys are join keys,
    so a filter on them reaches every scan below."""
    base, incr = base or f"{database}.{table}", incr or f"{database}.{table}_incr"
    cols = ", ".join(f"`{c}`" for c in spark.table(base).columns)
    both = f"SELECT {cols} FROM {base} UNION ALL SELECT {cols} FROM {incr}"
    by = ", ".join(f"`{k}`" for k in keys)
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    name = f"{database}.{table}_view"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT t.* FROM ({both}) t JOIN "
              f"(SELECT {by}, MAX(`{ts}`) AS _top FROM ({both}) u GROUP BY {by}) s ON {on} AND t.`{ts}` = s._top")
    return name


def partition_spec(column: str, value: str) -> str:
    return f"`{column}`='{_quoted(value)}'"


def add_partitions(spark: SparkSession, table: str, column: str, values: list[str]) -> None:
    """Pre-create partitions (one statement for all of them)."""
    if not values:
        return
    specs = " ".join(f"PARTITION ({partition_spec(column, v)})" for v in values)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
