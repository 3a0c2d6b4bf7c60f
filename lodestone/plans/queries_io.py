"""Registered queries for sources, sinks and whole load workflows.

Each callable performs its writes into a fresh folder under the session's
shared checkpoint folder and returns the DataFrame Spark reads back, so the
oracle compares what actually landed on storage.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions.periods import expand_period
from lodestone.functions.types import HeaderColumn, header_from_schema
from lodestone.operators.aggregates import reconcile_frame, table_stats
from lodestone.operators.cleanse import cleanse_projection
from lodestone.operators.sinks import (add_partitions,
                                       create_external, land_raw,
                                       partition_label_from_path, read_raw, widen,
                                       write_dataset, write_staging)
from lodestone.plans import derived as D
from lodestone.plans import oracle as O
from lodestone.plans.audit import read_audit
from lodestone.plans.pipeline import Layout, LoadSpec, dedup_swap, read_staging, run_load
from lodestone.plans.queries import register
from lodestone.session import work_dir
from lodestone.sources import jdbc as J
from lodestone.sources.rawtext import read_raw_text

RAW_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                  "o_orderdate", "o_orderpriority"]
TRICKY_COLS = ["k", "pipe", "slash", "lines", "mixed", "blank"]
BATCH = "20240101000000"


def _nullif(cols, src="raw_orders"):
    return ", ".join(f"NULLIF({c}, '') AS {c}" for c in cols)


# ------------------------------------------------------------------ raw text

_TRICKY_SQL = """tricky AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS k,
         o_orderpriority || '|' || o_orderstatus AS pipe,
         'x' || chr(92) || o_orderstatus || chr(92) AS slash,
         CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'l1' || chr(10) || o_orderpriority || chr(13) || chr(10) || 'l3' END AS lines,
         chr(92) || '|' || o_orderstatus || chr(92) || chr(92) AS mixed,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE ' ' || chr(9) || ' ' END AS blank
  FROM orders)"""


@register("scan_raw_text", O.with_ctes(_TRICKY_SQL) + f"SELECT {_nullif(TRICKY_COLS)} FROM tricky")
def q_scan_raw_text(spark, sf):
    path = work_dir(spark, "rawtext")
    write_dataset(widen(D.tricky_text(spark, sf)), path, "TEXTFILE", compress=True)
    return read_raw_text(spark, path, TRICKY_COLS)


@register("land_full", O.with_ctes(O.RAW_ORDERS) + f"SELECT {_nullif(RAW_ORDER_COLS)} FROM raw_orders")
def q_land_full(spark, sf):
    path = work_dir(spark, "landing")
    # a first landing, then the real one: overwrite replaces the target dir
    write_dataset(D.raw_customer(spark, sf), path, "TEXTFILE")
    write_dataset(D.raw_orders(spark, sf), path, "TEXTFILE")
    return read_raw_text(spark, path, RAW_ORDER_COLS)


def _formats():
    return ["TEXTFILE", "PARQUET", "ORC"]


@register("land_formats", O.with_ctes(O.RAW_ORDERS) + " UNION ALL ".join(
    [f"SELECT 'TEXTFILE' AS fmt, {_nullif(RAW_ORDER_COLS)} FROM raw_orders"] +
    [f"SELECT '{f}' AS fmt, {', '.join(RAW_ORDER_COLS)} FROM raw_orders"
     for f in ("PARQUET", "ORC")]))
def q_land_formats(spark, sf):
    root = work_dir(spark, "formats")
    raw = D.raw_orders(spark, sf)
    out = None
    for fmt in _formats():
        path = f"{root}/{fmt.lower()}"
        write_dataset(raw, path, fmt, compress=True)
        back = (read_raw_text(spark, path, RAW_ORDER_COLS) if fmt == "TEXTFILE"
                else spark.read.format(fmt.lower()).load(path).select(*RAW_ORDER_COLS))
        back = back.select(F.lit(fmt).alias("fmt"), *RAW_ORDER_COLS)
        out = back if out is None else out.unionByName(back)
    return out


@register("land_raw", O.with_ctes(O.RAW_ORDERS) +
          f"SELECT {_nullif(RAW_ORDER_COLS)}, '{BATCH}' AS batch_id FROM raw_orders")
def q_land_raw(spark, sf):
    path = work_dir(spark, "raw")
    raw = D.raw_orders(spark, sf)
    land_raw(raw, path, "20231231000000")
    land_raw(raw, path, BATCH)          # no archiving: the older batch goes
    return read_raw(spark, path, RAW_ORDER_COLS)


@register("raw_archive", O.with_ctes(O.RAW_ORDERS) +
          f"SELECT {_nullif(RAW_ORDER_COLS)}, '0001' AS batch_id FROM raw_orders UNION ALL "
          "SELECT " + ", ".join("'U' AS o_orderstatus" if c == "o_orderstatus" else
                                f"NULLIF({c}, '') AS {c}" for c in RAW_ORDER_COLS) +
          ", '0002' AS batch_id FROM raw_orders")
def q_raw_archive(spark, sf):
    path = work_dir(spark, "archive")
    raw = D.raw_orders(spark, sf)
    land_raw(raw, path, "0001", archive=True)
    land_raw(raw.withColumn("o_orderstatus", F.lit("U")), path, "0002", archive=True)
    return read_raw(spark, path, RAW_ORDER_COLS)


@register("land_raw_partitioned", O.with_ctes(O.RAW_ORDERS) +
          f"SELECT {_nullif(RAW_ORDER_COLS)}, '{BATCH}' AS batch_id, month FROM "
          "(SELECT r.*, strftime(o.o_orderdate, '%Y%m') AS month FROM raw_orders r "
          "JOIN orders o ON r.o_orderkey = CAST(o.o_orderkey AS VARCHAR))")
def q_land_raw_partitioned(spark, sf):
    path = work_dir(spark, "rawpart")
    land_raw(D.raw_orders(spark, sf, with_month=True), path, BATCH, partition_col="month")
    return read_raw(spark, path, RAW_ORDER_COLS, partition_col="month")


@register("partition_from_path",
          "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, "
          "'month_' || strftime(o_orderdate, '%Y%m') AS part_label FROM orders")
def q_partition_from_path(spark, sf):
    path = work_dir(spark, "frompath")
    land_raw(D.raw_orders(spark, sf, with_month=True), path, BATCH, partition_col="month")
    lines = spark.read.schema("value string").text(f"{path}/{'batch_id='}{BATCH}")
    return lines.select(F.regexp_extract("value", r"^([^|]*)", 1).alias("o_orderkey"),
                        partition_label_from_path().alias("part_label"))


def _cm_sql() -> str:
    return ("cm AS (" + O.sql_cleanse_select(O.ORDERS_TYPED, "r.") + ", strftime(o.o_orderdate, '%Y%m') AS month "
            "FROM raw_orders r JOIN orders o ON r.o_orderkey = CAST(o.o_orderkey AS VARCHAR))")


CM = _cm_sql()
ORDER_NAMES = [c.name for c in D.ORDERS_HEADER]


def _cleansed_with_month(spark, sf):
    return cleanse_projection(D.raw_orders(spark, sf, with_month=True), D.ORDERS_HEADER,
                              partition_col="month")


@register("filter_period", O.with_ctes(O.RAW_ORDERS, CM) + "SELECT * FROM cm WHERE month = '199601'")
def q_filter_period(spark, sf):
    path = work_dir(spark, "period")
    land_raw(D.raw_orders(spark, sf, with_month=True), path, BATCH, partition_col="month")
    raw = read_raw(spark, path, RAW_ORDER_COLS, batch_id=BATCH, partition_col="month")
    return cleanse_projection(raw.filter(F.col("month") == "199601"), D.ORDERS_HEADER,
                              partition_col="month")


# ------------------------------------------------------------------ staging

@register("stage_full", O.cleansed_orders_sql())
def q_stage_full(spark, sf):
    path = work_dir(spark, "stg")
    typed = cleanse_projection(D.raw_orders(spark, sf), D.ORDERS_HEADER)
    write_staging(typed, path, "PARQUET", "overwrite")
    write_staging(typed, path, "PARQUET", "overwrite")   # a rerun replaces, never doubles
    return read_staging(spark, path)


@register("stage_incr", O.cleansed_orders_sql())
def q_stage_incr(spark, sf):
    path = work_dir(spark, "stg") + "/orders_incr"
    write_staging(cleanse_projection(D.raw_customer(spark, sf), D.CUSTOMER_HEADER), path)
    write_staging(cleanse_projection(D.raw_orders(spark, sf), D.ORDERS_HEADER), path,
                  "PARQUET", "overwrite")
    return read_staging(spark, path)


_DYN_MONTHS = ("199601", "199602")


@register("stage_dynamic_partition", O.with_ctes(O.RAW_ORDERS, CM) +
          f"SELECT * FROM cm WHERE month NOT IN {_DYN_MONTHS} UNION ALL "
          f"SELECT {', '.join(c if c != 'o_orderstatus' else chr(39) + 'X' + chr(39) + ' AS o_orderstatus' for c in ORDER_NAMES)}, month "
          f"FROM cm WHERE month IN {_DYN_MONTHS}")
def q_stage_dynamic_partition(spark, sf):
    path = work_dir(spark, "dyn")
    typed = _cleansed_with_month(spark, sf)
    write_staging(typed, path, partition_col="month")
    incr = (typed.filter(F.col("month").isin(*_DYN_MONTHS))
            .withColumn("o_orderstatus", F.lit("X")))
    write_staging(incr, path, "PARQUET", "overwrite", "month", dynamic=True)
    return read_staging(spark, path).select(*ORDER_NAMES, F.col("month").cast("string"))


_STATIC = "199511-199602"


@register("stage_static_partitions", O.with_ctes(O.RAW_ORDERS, CM) +
          f"SELECT * FROM cm WHERE month IN {tuple(expand_period(_STATIC))}")
def q_stage_static_partitions(spark, sf):
    path = work_dir(spark, "static")
    write_staging(_cleansed_with_month(spark, sf), path, "PARQUET", "append", "month",
                  periods=expand_period(_STATIC))
    return read_staging(spark, path).select(*ORDER_NAMES, F.col("month").cast("string"))


@register("stage_append_partition", O.with_ctes(O.RAW_ORDERS, CM) +
          "SELECT * FROM cm UNION ALL SELECT * FROM cm WHERE month = '199601'")
def q_stage_append_partition(spark, sf):
    path = work_dir(spark, "append")
    typed = _cleansed_with_month(spark, sf)
    write_staging(typed, path, "PARQUET", "append", "month")
    write_staging(typed.filter(F.col("month") == "199601"), path, "PARQUET", "append", "month")
    return read_staging(spark, path).select(*ORDER_NAMES, F.col("month").cast("string"))


@register("create_external", O.cleansed_customer_sql())
def q_create_external(spark, sf):
    from lodestone.functions.types import staging_schema
    path = work_dir(spark, "ext")
    typed = cleanse_projection(D.raw_customer(spark, sf), D.CUSTOMER_HEADER)
    write_staging(typed, path)
    db = "lodestone_" + path.rsplit("-", 1)[-1]
    name = create_external(spark, db, "customer", staging_schema(D.CUSTOMER_HEADER), path)
    return spark.table(name)


_PRECREATE = expand_period(_STATIC) + ["203001"]


@register("add_partitions",
          "WITH p AS (SELECT * FROM (VALUES " + ", ".join(f"('{m}')" for m in _PRECREATE) +
          ") t(month)), c AS (SELECT strftime(o_orderdate, '%Y%m') AS month, count(*) AS n_rows "
          "FROM orders GROUP BY 1) SELECT p.month, coalesce(c.n_rows, 0) AS n_rows "
          "FROM p LEFT JOIN c ON p.month = c.month")
def q_add_partitions(spark, sf):
    from lodestone.functions.types import staging_schema
    path = work_dir(spark, "addpart")
    db = "lodestone_" + path.rsplit("-", 1)[-1]
    schema = staging_schema(D.ORDERS_HEADER, "month")
    name = create_external(spark, db, "orders", schema, path, partition_col="month")
    add_partitions(spark, name, "month", _PRECREATE)
    typed = _cleansed_with_month(spark, sf)
    write_staging(typed, path, "PARQUET", "append", "month", periods=expand_period(_STATIC))
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    parts = (spark.sql(f"SHOW PARTITIONS {name}")
             .select(F.regexp_extract("partition", r"month=(.*)$", 1).alias("month")))
    counts = spark.table(name).groupBy("month").agg(F.count(F.lit(1)).alias("n_rows"))
    return (parts.join(counts, "month", "left")
            .select("month", F.coalesce("n_rows", F.lit(0)).alias("n_rows")))


@register("table_stats", O.with_ctes(O.RAW_ORDERS, CM) +
          "SELECT month, count(*) AS row_count, "
          + ", ".join(f"count_if({c} IS NULL) AS {c}__nulls, min({c}) AS {c}__min, max({c}) AS {c}__max"
                      for c in ("o_totalprice", "o_orderdate", "o_orderstatus"))
          + " FROM cm GROUP BY month")
def q_table_stats(spark, sf):
    path = work_dir(spark, "stats")
    write_staging(_cleansed_with_month(spark, sf), path, partition_col="month")
    staged = read_staging(spark, path).withColumn("month", F.col("month").cast("string"))
    return table_stats(staged, "month", ["o_totalprice", "o_orderdate", "o_orderstatus"])


# --------------------------------------------------------------- workflows

def _orders_typed_sql() -> str:
    return ("SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, "
            "o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")


def _full_load(spark, sf, label, **kw):
    root = work_dir(spark, label)
    orders = D.table(spark, sf, "orders")
    spec = LoadSpec("orders", "tpch", "FULL", extract_id=1, narrow_source=True, **kw)
    layout = Layout(root)
    res = run_load(spark, orders, header_from_schema(orders.schema), spec, layout, BATCH)
    return res, layout, spec


@register("refresh_full", _orders_typed_sql())
def q_refresh_full(spark, sf):
    res, layout, spec = _full_load(spark, sf, "full")
    return read_staging(spark, layout.stg(spec))


@register("reconcile_counts",
          "SELECT count(*) AS source_rows, count(*) AS target_rows, 'S' AS status FROM orders")
def q_reconcile_counts(spark, sf):
    res, layout, spec = _full_load(spark, sf, "reconcile")
    return reconcile_frame(spark, res.source_rows, res.target_rows)


@register("audit_append",
          f"SELECT CAST({BATCH} AS BIGINT) AS exec_id, 1 AS extract_id, 'TPCH.ORDERS' AS stg_tab_nm, "
          "count(*) AS source_row, 'FULL' AS refresh_typ, count(*) AS tgt_rows, "
          "NULL::VARCHAR AS incr_col_val, NULL::INTEGER AS fail_step, 'S' AS status, true AS timed, "
          "0::BIGINT AS excluded_rows, 0::BIGINT AS rejected_values, 0::BIGINT AS malformed_lines FROM orders "
          f"UNION ALL SELECT CAST({BATCH} AS BIGINT) + 1, 2, 'TPCH.EVENTS', NULL, 'INCR', NULL, "
          "NULL, 1, 'F', true, 0, 0, 0")
def q_audit_append(spark, sf):
    res, layout, spec = _full_load(spark, sf, "audit")
    events = D.table(spark, sf, "events")
    failing = LoadSpec("events", "tpch", "INCR", keys=("event_id",), incr_col="ts", extract_id=2)
    run_load(spark, events, header_from_schema(events.schema), failing, layout,
             str(int(BATCH) + 1), raise_errors=False)
    return read_audit(spark, layout.audit()).select(
        "exec_id", "extract_id", "stg_tab_nm", "source_row", "refresh_typ", "tgt_rows",
        "incr_col_val", "fail_step", "status",
        ((F.col("exec_strt_ts") <= F.col("exec_end_ts")) & (F.abs(
            F.timestamp_diff("SECOND", "exec_strt_ts", "exec_end_ts") - F.col("exec_lapse_s")) <= 1)).alias("timed"),
        "excluded_rows", "rejected_values", "malformed_lines")


_BASE_HEADER = [HeaderColumn("o_orderkey", "NUMBER"), HeaderColumn("o_custkey", "NUMBER"),
                HeaderColumn("o_orderstatus", "VARCHAR2"), HeaderColumn("o_totalprice", "NUMBER"),
                HeaderColumn("o_orderdate", "TIMESTAMP"), HeaderColumn("o_orderpriority", "CHAR"),
                HeaderColumn("extract_ts", "TIMESTAMP")]
_BASE_NAMES = [c.name for c in _BASE_HEADER]
_BASE_TYPED = ("SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, "
               "o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderdate, "
               "coalesce(o_orderpriority, '') AS o_orderpriority, extract_ts FROM {}")  # text NULLs stage as ''


@register("refresh_incr", O.with_ctes(
    O.BASE, O.DELTA, "tb AS (" + _BASE_TYPED.format("base") + ")",
    "td AS (" + _BASE_TYPED.format("delta") + f" WHERE extract_ts > TIMESTAMP '{D.BASE_TS}')")
    + O.merge_sql("tb", "td", ["o_orderkey"], _BASE_NAMES))
def q_refresh_incr(spark, sf):
    layout = Layout(work_dir(spark, "incr"))
    base, delta = D.base(spark, sf), D.delta(spark, sf)
    full = LoadSpec("orders", "tpch", "FULL")
    run_load(spark, base, _BASE_HEADER, full, layout, "1")
    # the source now holds the base rows and the changed/new rows
    source = base.unionByName(delta)
    incr = LoadSpec("orders", "tpch", "INCR", keys=("o_orderkey",), incr_col="extract_ts")
    res = run_load(spark, source, _BASE_HEADER, incr, layout, "2")
    if res.status != "S":
        raise RuntimeError(f"incremental load did not reconcile: {res}")
    return read_staging(spark, layout.stg(incr))


_EVENTS_TYPED = ("SELECT CAST(event_id AS DOUBLE) AS event_id, ts, CAST(user_id AS DOUBLE) AS user_id, "
                 "event_type, value, props FROM events")
_CUTOFF = "2024-01-15 00:00:00"


@register("refresh_append", _EVENTS_TYPED)
def q_refresh_append(spark, sf):
    layout = Layout(work_dir(spark, "appendload"))
    events = D.table(spark, sf, "events")
    header = header_from_schema(events.schema)
    spec = LoadSpec("events", "tpch", "APPEND", incr_col="ts")
    # first run: the source as it was at the cut-off; second: the whole source
    run_load(spark, events.filter(F.col("ts") <= D.ts_literal(_CUTOFF)), header, spec, layout, "1")
    run_load(spark, events, header, spec, layout, "2")
    return read_staging(spark, layout.stg(spec))


def _incr_by_period(spark, sf, label, keys_move, strategy="auto"):
    layout = Layout(work_dir(spark, label))
    base, delta = D.base(spark, sf), D.delta(spark, sf)
    run_load(spark, base, _BASE_HEADER, LoadSpec("orders", "tpch", "FULL", partition="month",
                                                  period_source="o_orderdate"), layout, "1")
    # a listed spec does not drop increment rows of other periods
    incr = LoadSpec("orders", "tpch", "INCR", keys=("o_orderkey",), incr_col="extract_ts", keys_move=keys_move,
                    partition="199501-199512", period_source="o_orderdate", merge_strategy=strategy)
    res = run_load(spark, base.unionByName(delta), _BASE_HEADER, incr, layout, "2")
    if res.status != "S":
        raise RuntimeError(f"incremental load did not reconcile: {res}")
    return read_staging(spark, layout.stg(incr)).select(*_BASE_NAMES, F.col("month").cast("string"))


_PERIOD_SQL = O.with_ctes(
    O.BASE, O.DELTA, "tb AS (" + _BASE_TYPED.format("base") + ")",
    "td AS (" + _BASE_TYPED.format("delta") + f" WHERE extract_ts > TIMESTAMP '{D.BASE_TS}')",
    "m AS (" + O.merge_sql("tb", "td", ["o_orderkey"], _BASE_NAMES) + ")") \
    + "SELECT *, strftime(o_orderdate, '%Y%m') AS month FROM m"


@register("refresh_incr_periods", _PERIOD_SQL)
def q_refresh_incr_periods(spark, sf):
    return _incr_by_period(spark, sf, "incrper", True)


@register("refresh_incr_scoped", _PERIOD_SQL)
def q_refresh_incr_scoped(spark, sf):
    """Only the partitions that the increment touches are rewritten."""
    return _incr_by_period(spark, sf, "incrscope", False)


@register("merge_touched_files", _PERIOD_SQL)
def q_merge_touched_files(spark, sf):
    """Only files that hold a key of the increment are rewritten, also where keys change their period."""
    return _incr_by_period(spark, sf, "incrfiles", True, "files")


@register("refresh_append_periods", "SELECT *, strftime(ts, '%Y%m') AS month FROM (" + _EVENTS_TYPED + ")")
def q_refresh_append_periods(spark, sf):
    layout = Layout(work_dir(spark, "appendper"))
    events = D.table(spark, sf, "events")
    header = header_from_schema(events.schema)
    spec = LoadSpec("events", "tpch", "APPEND", incr_col="ts", partition="202401", period_source="ts")
    for batch, rows in (("1", events.filter(F.col("ts") <= D.ts_literal(_CUTOFF))), ("2", events)):
        res = run_load(spark, rows, header, spec, layout, batch)
        if res.status != "S":
            raise RuntimeError(f"append did not reconcile: {res}")
    # a restart of the same batch appends nothing twice
    run_load(spark, events.limit(0), header, spec, layout, "2", start_at=3)
    return read_staging(spark, layout.stg(spec)).select(*events.columns, F.col("month").cast("string"))


@register("scan_raw_text_long",
          "SELECT CAST(doc_id AS VARCHAR) AS doc_id, NULLIF(text || chr(92) || '|' || chr(10) || text, '') AS text, "
          "source FROM documents")
def q_scan_raw_text_long(spark, sf):
    """Whole documents, twice over with every special character, as text fields."""
    path = work_dir(spark, "rawlong")
    d = D.table(spark, sf, "documents")
    write_dataset(d.select(F.col("doc_id").cast("string").alias("doc_id"),
                           F.concat("text", F.lit("\\|\n"), "text").alias("text"), "source"), path, "TEXTFILE")
    return read_raw_text(spark, path, ["doc_id", "text", "source"])


@register("refresh_raw_only",
          "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
          "o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, "
          "CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority, "
          f"'{BATCH}' AS batch_id FROM orders")
def q_refresh_raw_only(spark, sf):
    root = work_dir(spark, "rawonly")
    orders = D.table(spark, sf, "orders")
    spec = LoadSpec("orders", "tpch", "FULL")
    layout = Layout(root)
    run_load(spark, orders, header_from_schema(orders.schema), spec, layout, BATCH,
             stop_after="raw")
    return read_raw(spark, layout.raw(spec), list(orders.columns))


@register("restart_from_raw", _orders_typed_sql())
def q_restart_from_raw(spark, sf):
    root = work_dir(spark, "restart")
    orders = D.table(spark, sf, "orders")
    header = header_from_schema(orders.schema)
    spec = LoadSpec("orders", "tpch", "FULL")
    layout = Layout(root)
    run_load(spark, orders, header, spec, layout, BATCH, stop_after="raw")
    # restart at stage 3: the extract is not repeated, the raw batch is reused
    res = run_load(spark, orders.limit(0), header, spec, layout, BATCH, start_at=3)
    if res.source_rows != res.target_rows:
        raise RuntimeError(f"restart did not reconcile: {res}")
    return read_staging(spark, layout.stg(spec))


@register("dedup_swap", O.with_ctes(O.BASE, O.DELTA) + O.latest_sql("base", "delta", ["o_orderkey"]))
def q_dedup_swap(spark, sf):
    layout = Layout(work_dir(spark, "swap"))
    spec = LoadSpec("orders", "tpch", "INCR", keys=("o_orderkey",))
    write_staging(D.base(spark, sf), layout.stg(spec))
    write_staging(D.delta(spark, sf), layout.incr(spec))
    dedup_swap(spark, spec, layout, "extract_ts")
    return read_staging(spark, layout.stg(spec))


@register("stream_merge", O.with_ctes(
    O.BASE, O.DELTA, "tb AS (" + _BASE_TYPED.format("base") + ")",
    "td AS (" + _BASE_TYPED.format("delta") + ")")
    + O.merge_sql("tb", "td", ["o_orderkey"], _BASE_NAMES))
def q_stream_merge(spark, sf):
    from lodestone.streaming.increments import merge_batches
    layout = Layout(work_dir(spark, "stream"))
    full = LoadSpec("orders", "tpch", "FULL")
    run_load(spark, D.base(spark, sf), _BASE_HEADER, full, layout, "1")
    raw = f"{layout.root}/raw/increments"
    land_raw(D.delta(spark, sf), raw, "2", archive=True)
    q = merge_batches(spark, raw, _BASE_HEADER, layout.stg(full), ["o_orderkey"],
                      dedupe_by="extract_ts", checkpoint=f"{layout.root}/ckpt")
    q.awaitTermination()
    return read_staging(spark, layout.stg(full))


# --------------------------------------------------------------- incremental

@register("scan_incremental",
          f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{_CUTOFF}')")
def q_scan_incremental(spark, sf):
    from lodestone.operators.aggregates import watermark_literal
    events = D.table(spark, sf, "events")
    loaded = events.filter(F.col("ts") <= D.ts_literal(_CUTOFF))
    return J.read_incremental(events, "ts", ">", watermark_literal(loaded, "ts")[0])


# --------------------------------------------------------------------- JDBC

def _derby(spark, rows, name, **opts):
    import uuid
    conn = J.derby_connection("lodestone_" + uuid.uuid4().hex[:10])
    J.write_table(rows, conn, name, **opts)
    return conn


def _derby_orders(spark, sf):
    return _derby(spark, D.table(spark, sf, "orders"), "orders")


_NTZ = {"preferTimestampNTZ": "true"}


@register("scan_jdbc_table", "SELECT * FROM orders")
def q_scan_jdbc_table(spark, sf):
    conn = _derby_orders(spark, sf)
    return J.read_table(spark, conn, None, "orders", **_NTZ)


@register("scan_jdbc_query",
          "SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_price "
          "FROM orders WHERE o_totalprice > 100000 GROUP BY o_custkey")
def q_scan_jdbc_query(spark, sf):
    conn = _derby_orders(spark, sf)
    q = ('SELECT "o_custkey", COUNT(*) AS "n_orders", MAX("o_totalprice") AS "max_price" '
         'FROM orders WHERE "o_totalprice" > 100000 GROUP BY "o_custkey"')
    return J.read_query(spark, conn, q, **_NTZ)


@register("scan_jdbc_split", "SELECT * FROM orders")
def q_scan_jdbc_split(spark, sf):
    conn = _derby_orders(spark, sf)
    return J.read_split(spark, conn, None, "orders", '"o_orderkey"', 4, **_NTZ)


@register("scan_jdbc_split_query", "SELECT o_orderkey, o_totalprice * 2 AS doubled, o_orderpriority FROM orders")
def q_scan_jdbc_split_query(spark, sf):
    conn = _derby_orders(spark, sf)
    q = 'SELECT "o_orderkey", "o_totalprice" * 2 AS "doubled", "o_orderpriority" FROM orders'
    return J.read_split(spark, conn, None, "orders", '"o_orderkey"', 4, query=q, **_NTZ)



_WINDOW_FROM = "1995-06-17 00:00:00"


@register("scan_window", f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{_WINDOW_FROM}'")
def q_scan_window(spark, sf):
    """A pull by four streams of (mark, upper]; rows that the source gets after
    the upper bound was read aren't in it."""
    conn = _derby_orders(spark, sf)
    upper = J.upper_bound(spark, conn, "orders", '"o_orderdate"', **_NTZ)
    source = J.read_split(spark, conn, None, "orders", '"o_orderkey"', 4, **_NTZ)
    late = D.table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 20 YEARS"))
    J.write_table(late, conn, "orders", mode="append")
    mark = F.lit(_WINDOW_FROM).cast(source.schema["o_orderdate"].dataType)
    return J.read_window(source, "o_orderdate", ">", mark, upper[0])


@register("scan_split_text", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def q_scan_split_text(spark, sf):
    """Streams over a text column, cut where the database finds equal numbers of rows."""
    conn = _derby(spark, D.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"),
                  "customer", createTableColumnTypes="c_name VARCHAR(200)")
    return J.read_split(spark, conn, None, "customer", '"c_name"', 4, method="quantile")


#: Nine rows of ten in a hundredth of the range.
_SKEWED_SQL = "CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey * 100 ELSE o_orderkey END AS place"


@register("scan_split_skewed", f"SELECT o_orderkey, {_SKEWED_SQL}, o_orderpriority FROM orders")
def q_scan_split_skewed(spark, sf):
    rows = D.table(spark, sf, "orders").selectExpr("o_orderkey", _SKEWED_SQL, "o_orderpriority")
    return J.read_split(spark, _derby(spark, rows, "skewed"), None, "skewed", '"place"', 8, method="quantile")
