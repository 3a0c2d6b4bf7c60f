"""Configuration tables: sources, extract specs, defaults — registration,
listing, pattern selection and lookup. These are small metadata tables
(one row per source / per table to load); they are DataFrames so they can
live in any catalog or folder, and only a selected spec row reaches the
driver. A selected row is turned into a load (``load_from_config``).
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.types import HeaderColumn, header_from_schema
from lodestone.plans.pipeline import Layout, LoadResult, LoadSpec, run_load
from lodestone.session import path_exists
from lodestone.sources import jdbc as J

# The columns of the configuration tables.
SOURCE_SCHEMA = T.StructType([
    T.StructField("service_nm", T.StringType()),
    T.StructField("source_db_typ", T.StringType()),
    T.StructField("hostname", T.StringType()),
    T.StructField("port", T.IntegerType()),
    T.StructField("db_name", T.StringType()),
    T.StructField("connect_typ", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("password_ref", T.StringType()),   # name of a secret, never the secret
    T.StructField("comments", T.StringType()),
])

_S = T.StringType()
EXTRACT_SCHEMA = T.StructType([
    T.StructField("extract_id", T.IntegerType()),
    T.StructField("extract_name", _S), T.StructField("create_job", _S),
    T.StructField("src_schema", _S), T.StructField("src_tab_nm", _S),
    T.StructField("interface_nm", _S), T.StructField("is_raw", _S),
    T.StructField("raw_tab_nm", _S), T.StructField("raw_file_dir", _S),
    T.StructField("raw_archiving", _S), T.StructField("stg_tab_nm", _S),
    T.StructField("stg_file_dir", _S), T.StructField("refresh_typ", _S),
    T.StructField("incr_pk_col", _S), T.StructField("incr_tab_nm", _S),
    T.StructField("incr_file_dir", _S), T.StructField("incr_col_nm", _S),
    T.StructField("incr_col_equation", _S), T.StructField("is_partition", _S),
    T.StructField("partition_col_nm", _S), T.StructField("parallel_extract", _S),
    T.StructField("extract_parallelism", T.IntegerType()),
    T.StructField("parallel_splitby", _S), T.StructField("query", _S),
    T.StructField("map_columns", _S), T.StructField("import_file_format", _S),
    T.StructField("stg_file_format", _S), T.StructField("file_compress", _S),
    T.StructField("service_nm", _S), T.StructField("create_dt", T.DateType()),
    T.StructField("modify_dt", T.DateType()), T.StructField("comments", _S),
    # beyond the fixed record: what a load of such a table needs to know
    T.StructField("period_source", _S),     # date column that a period is derived from
    T.StructField("keys_move", _S),         # Y: a key's period can change
    T.StructField("dedupe_by", _S),         # order of increment rows of one key
    T.StructField("first_load", _S),        # full: INCR on an empty target loads it
    T.StructField("merge_strategy", _S),    # auto, shuffle, files
    T.StructField("split_method", _S),      # stride, quantile, hash
])

# Registration defaults (key=value, as a defaults file holds them).
# The raw format is one that every Spark installation can write.
DEFAULTS_TEXT = """INTERFACE_NM=STAGE
REFRESH_TYP=FULL
IS_PARTITION=N
PARALLEL_EXTRACT=N
EXTRACT_PARALLELISM=1
IMPORT_FILE_FORMAT=PARQUET
STG_FILE_FORMAT=PARQUET
FILE_COMPRESS=Y
CREATE_JOB=N"""


def parse_defaults(text: str = DEFAULTS_TEXT) -> dict[str, str]:
    out = {}
    for line in text.splitlines():
        line = line.strip()
        if line and not line.startswith("#") and "=" in line:
            k, v = line.split("=", 1)
            out[k.strip().lower()] = v.strip()
    return out


def list_sources(sources: DataFrame) -> DataFrame:
    """Every source with NULLs shown as the text 'NULL' (passwords omitted)."""
    return sources.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias(c)
                            for c in sources.columns if c != "password_ref"])


def list_extracts(extracts: DataFrame, service: str) -> DataFrame:
    return (extracts.filter(F.upper("service_nm") == service.upper())
            .select("service_nm", "extract_id", "extract_name", "src_schema",
                    "src_tab_nm", "refresh_typ"))


def listing_line(df: DataFrame) -> F.Column:
    cols = ["service_nm", "extract_id", "extract_name", "src_schema", "src_tab_nm",
            "refresh_typ"]
    return F.concat_ws("  ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


def _pattern_filter(text: F.Column, pattern: str | None) -> F.Column:
    if pattern is None or pattern.strip().upper() == "ALL":
        return F.lit(True)
    return F.lower(text).rlike(pattern.lower())


def select_tables(tables: DataFrame, pattern: str | None, col: str = "table_name") -> DataFrame:
    """``ALL`` or a case-insensitive pattern on the table names."""
    return tables.filter(_pattern_filter(F.col(col), pattern))


def select_extracts(extracts: DataFrame, pattern: str | None, on: str = "line") -> DataFrame:
    """Pattern against the whole listing line (service, id, name, schema,
    table, refresh type) — or only the table name with ``on="table"``."""
    text = listing_line(extracts) if on == "line" else F.col("src_tab_nm")
    return extracts.filter(_pattern_filter(text, pattern))


def config_lookup(sources: DataFrame, extracts: DataFrame, service: str, schema: str,
                  table: str) -> DataFrame:
    """The one spec row of (service, schema, table) joined with its source.
    A spec whose service is not configured drops out; a spec registered twice
    resolves to the lowest extract id (deterministic)."""
    e = extracts.filter((F.upper("service_nm") == service.upper()) &
                        (F.upper("src_schema") == schema.upper()) &
                        (F.upper("src_tab_nm") == table.upper()))
    s = sources.select(*[F.col(c).alias(f"src_{c}") for c in sources.columns])
    joined = e.join(s, F.upper("service_nm") == F.upper("src_service_nm"), "inner")
    return (joined.withColumn("refresh_typ", F.upper("refresh_typ"))
            .withColumn("src_source_db_typ", F.lower("src_source_db_typ"))
            .orderBy(F.col("extract_id").asc_nulls_last()).limit(1))


def append_rows(spark: SparkSession, path: str, rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Append configuration rows to the table at ``path``; the whole table."""
    rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]) \
        .coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def register_source(spark: SparkSession, path: str, **source) -> DataFrame:
    """Append one source; its name must be new (names ignore case)."""
    unknown = set(source) - set(SOURCE_SCHEMA.names)
    if unknown or not source.get("service_nm"):
        raise ValueError(f"a source needs service_nm and knows no {sorted(unknown)}")
    if path_exists(spark, path):
        known = spark.read.schema(SOURCE_SCHEMA).parquet(path)
        if not known.filter(F.upper("service_nm") == source["service_nm"].upper()).isEmpty():
            raise ValueError(f"source {source['service_nm']!r} is registered")
    row = spark.createDataFrame([tuple(source.get(n) for n in SOURCE_SCHEMA.names)], SOURCE_SCHEMA)
    return append_rows(spark, path, row, SOURCE_SCHEMA)


def register_tables(spark: SparkSession, path: str, tables: DataFrame, service: str, schema: str,
                    defaults: dict[str, str] | None = None, **columns) -> DataFrame:
    """Append a spec for each table of a listing; ``columns`` overrides values
    (keys, refresh type, query, split column ...)."""
    known = spark.read.schema(EXTRACT_SCHEMA).parquet(path) if path_exists(spark, path) else empty_extracts(spark)
    new = register_extracts(known, tables, service, schema, defaults)
    for name, value in columns.items():
        new = new.withColumn(name, F.lit(value).cast(EXTRACT_SCHEMA[name].dataType))
    return append_rows(spark, path, new, EXTRACT_SCHEMA)


def register_extracts(extracts: DataFrame, tables: DataFrame, service: str, schema: str,
                      defaults: dict[str, str] | None = None,
                      table_col: str = "table_name") -> DataFrame:
    """New spec rows for a listing of tables, ids continuing after the
    current maximum (an empty config starts at 1), ordered by table name.
    Defaults become literal columns: no join is needed for nine constants."""
    d = {k.lower(): v for k, v in (defaults or parse_defaults()).items()}
    start = extracts.agg(F.coalesce(F.max("extract_id"), F.lit(0)).alias("m")).first()["m"]
    # a table listing of one schema: small, so one ordered window is fine
    new = (tables.select(F.upper(F.col(table_col)).alias("t")).distinct()
           .withColumn("n", F.row_number().over(Window.orderBy("t")))
           .withColumn("m", F.lit(int(start))))
    row = {f.name: F.lit(None).cast(f.dataType) for f in EXTRACT_SCHEMA.fields}
    for k, v in d.items():
        if k in row:
            row[k] = F.lit(v).cast(EXTRACT_SCHEMA[k].dataType)
    row.update({
        "extract_id": (F.col("m") + F.col("n")).cast("int"),
        "extract_name": F.concat(F.lit(schema.upper() + "."), F.col("t")),
        "src_schema": F.lit(schema.upper()),
        "src_tab_nm": F.col("t"),
        "stg_tab_nm": F.col("t"),
        "service_nm": F.lit(service.upper()),
        "create_dt": F.current_date(),
        "modify_dt": F.current_date(),
    })
    return new.select(*[row[f.name].alias(f.name) for f in EXTRACT_SCHEMA.fields])


def connection_from_row(row) -> J.Connection:
    """The connection of a joined spec row; the password stays a reference."""
    r = row.asDict()
    return J.Connection(r["src_source_db_typ"], r.get("src_hostname") or "", r.get("src_port") or "",
                        r.get("src_db_name") or "", r.get("src_username"), r.get("src_password_ref"))


def query_of(row, query: str | None = None, query_dir: str | None = None,
             spark: SparkSession | None = None) -> str | None:
    """The query to pull: the argument, else the configured one, else the file
    ``<extract_name>.sql`` of the query folder, else none (the whole table)."""
    if query or row["query"]:
        return query or row["query"]
    if query_dir and path_exists(spark, path := f"{query_dir}/{row['extract_name']}.sql"):
        return spark.read.option("wholetext", True).text(path).first()["value"]
    return None


def source_from_row(spark: SparkSession, row, query: str | None = None,
                    query_dir: str | None = None, **options) -> DataFrame:
    """The DataFrame that pulls a configured extract: its query or table, in
    parallel if the row says so and names a split column."""
    conn, r = connection_from_row(row), row.asDict()
    sql = query_of(row, query, query_dir, spark)
    wide = (r.get("parallel_extract") or "N").upper() == "Y"
    streams = int(r.get("extract_parallelism") or 1) if wide else 1
    return J.read_split(spark, conn, r["src_schema"], r["src_tab_nm"], r.get("parallel_splitby"),
                        streams, query=sql, method=(r.get("split_method") or "stride").lower(), **options)


def upper_of_row(spark: SparkSession, row, source: DataFrame, incr_col: str, query: str | None = None,
                 query_dir: str | None = None, **options):
    """The end of the window of a configured INCR or APPEND pull, read now."""
    conn = connection_from_row(row)
    name = next(c for c in source.columns if c.lower() == incr_col.lower())
    table = J.source_sql(conn, row["src_schema"], row["src_tab_nm"], query_of(row, query, query_dir, spark))
    return J.upper_bound(spark, conn, table, conn.quoted(name), **options)


def load_from_config(spark: SparkSession, sources: DataFrame, extracts: DataFrame, service: str, schema: str,
                     table: str, layout: Layout, batch_id: str, query: str | None = None,
                     query_dir: str | None = None, header: list[HeaderColumn] | None = None,
                     options: dict | None = None, **run) -> LoadResult:
    """Runs one registered table end to end. Without ``header``, the header is
    that of the columns of the first pull, which is frozen: a column that changes
    its type or goes stops a later load, a new one is noted in the audit and left
    out until ``accept_header`` takes it. The end of an incremental pull's window
    is read once, before the pull."""
    row = config_lookup(sources, extracts, service, schema, table).first()
    if row is None:
        raise LookupError(f"no configured extract {service}.{schema}.{table}")
    options = options or {}
    source, spec = source_from_row(spark, row, query, query_dir, **options), spec_from_row(row)
    if header is None:
        sql = query_of(row, query, query_dir, spark)
        spec.freeze_header, spec.header_key = True, f"{zlib.crc32(sql.encode()):08x}" if sql else ""
    if spec.refresh in ("INCR", "APPEND") and spec.incr_col and run.get("start_at", 1) <= 1:
        run.setdefault("upper", lambda: upper_of_row(spark, row, source, spec.incr_col, query, query_dir, **options))
    return run_load(spark, source, header or header_from_schema(source.schema), spec, layout, batch_id, **run)


def spec_from_row(row) -> LoadSpec:
    """LoadSpec from one extract config row (a ``Row`` or dict)."""
    r = row.asDict() if hasattr(row, "asDict") else dict(row)

    def g(k, default=None):
        v = r.get(k)
        return default if v in (None, "") else v
    is_part = (g("is_partition", "N") or "N").upper() in ("Y", "YES", "TRUE")
    op = g("incr_col_equation", ">")
    return LoadSpec(
        table=g("stg_tab_nm") or g("src_tab_nm"),
        interface=g("interface_nm", "stage"),
        refresh=g("refresh_typ", "FULL").upper(),
        keys=tuple((g("incr_pk_col", "") or "").split()),
        incr_col=g("incr_col_nm"),
        incr_op=op.strip(),
        partition=g("partition_col_nm", "none") if is_part else "none",
        raw_format=g("import_file_format", "TEXTFILE"),
        stg_format=g("stg_file_format", "PARQUET"),
        compress=(g("file_compress", "Y").upper() == "Y"),
        archive=(g("raw_archiving", "N").upper() == "Y"),
        extract_id=g("extract_id"),
        narrow_source=g("parallel_extract", "N").upper() != "Y",
        period_source=g("period_source"),
        keys_move=g("keys_move", "Y").upper() != "N",
        dedupe_by=g("dedupe_by"),
        first_load=g("first_load", "error").lower(),
        merge_strategy=g("merge_strategy", "auto").lower(),
    )


def empty_extracts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], EXTRACT_SCHEMA)
