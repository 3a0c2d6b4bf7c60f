import uuid

import pytest
from pyspark.sql import functions as F

from lodestone.plans.config import (EXTRACT_SCHEMA, SOURCE_SCHEMA, config_lookup,
                                    empty_extracts, list_extracts, list_sources,
                                    parse_defaults, register_extracts, select_extracts,
                                    select_tables, spec_from_row)
from lodestone.sources import jdbc as J


def _extract(**kw):
    row = {f.name: None for f in EXTRACT_SCHEMA.fields}
    row.update(kw)
    return tuple(row[f.name] for f in EXTRACT_SCHEMA.fields)


@pytest.fixture()
def config(spark):
    sources = spark.createDataFrame([
        ("SALES", "oracle", "db1", 1521, "ORCL", "jdbc", "etl", "SALES_PW", None),
        ("HRDB", "sqlserver", None, 1433, "hr", "jdbc", "etl", "HR_PW", "second"),
    ], SOURCE_SCHEMA)
    extracts = spark.createDataFrame([
        _extract(extract_id=1, extract_name="A.ORDERS", src_schema="A", src_tab_nm="ORDERS",
                 service_nm="SALES", refresh_typ="full", interface_nm="SALES"),
        _extract(extract_id=2, extract_name="A.ORDERS", src_schema="A", src_tab_nm="ORDERS",
                 service_nm="HRDB", refresh_typ="INCR", incr_pk_col="O_ID O_LINE",
                 incr_col_nm="MODIFIED", incr_col_equation=">=", interface_nm="HR"),
        _extract(extract_id=3, extract_name="A.DEPT", src_schema="A", src_tab_nm="DEPT",
                 service_nm="NOSUCH", refresh_typ="FULL"),
        _extract(extract_id=None, extract_name="A.ORDERS", src_schema="A", src_tab_nm="ORDERS",
                 service_nm="SALES", refresh_typ="APPEND"),
        _extract(extract_id=5, extract_name="B.ITEMS", src_schema="B", src_tab_nm="ITEMS",
                 service_nm="SALES", refresh_typ="FULL", parallel_extract="Y",
                 extract_parallelism=4),
    ], EXTRACT_SCHEMA)
    return sources, extracts


def test_list_sources_shows_null_text(config):
    sources, _ = config
    rows = list_sources(sources).collect()
    assert rows[0]["comments"] == "NULL" and rows[1]["hostname"] == "NULL"
    assert "password_ref" not in list_sources(sources).columns


def test_config_lookup(config):
    sources, extracts = config
    r = config_lookup(sources, extracts, "sales", "a", "orders").collect()
    assert len(r) == 1 and r[0]["extract_id"] == 1 and r[0]["refresh_typ"] == "FULL"
    assert r[0]["src_source_db_typ"] == "oracle"
    # a service that is not configured drops out
    assert config_lookup(sources, extracts, "NOSUCH", "A", "DEPT").count() == 0
    spec = spec_from_row(config_lookup(sources, extracts, "HRDB", "A", "ORDERS").first())
    assert spec.refresh == "INCR" and spec.keys == ("O_ID", "O_LINE") and spec.incr_op == ">="


def test_listing_and_selection(config):
    _, extracts = config
    assert list_extracts(extracts, "sales").count() == 3
    assert select_extracts(extracts, "ALL").count() == 5
    # the whole listing line matches: a service name selects too
    assert select_extracts(extracts, "hrdb").count() == 1
    assert select_extracts(extracts, "ord").count() == 3
    assert select_extracts(extracts, "sales", on="table").count() == 0


def test_register_extracts(spark, config):
    _, extracts = config
    tables = spark.createDataFrame([("zeta",), ("alpha",), ("alpha",)], "table_name string")
    assert select_tables(tables, "^AL").count() == 2
    new = register_extracts(extracts, tables, "sales", "b").orderBy("extract_id").collect()
    assert [(r["extract_id"], r["src_tab_nm"]) for r in new] == [(6, "ALPHA"), (7, "ZETA")]
    assert new[0]["stg_file_format"] == "PARQUET" and new[0]["extract_parallelism"] == 1
    first = register_extracts(empty_extracts(spark), tables, "s", "x").collect()
    assert sorted(r["extract_id"] for r in first) == [1, 2]
    assert parse_defaults("A=1\n# c\nB = two\n") == {"a": "1", "b": "two"}


def test_connection_options():
    c = J.Connection("ORACLE", "h", 1521, "svc", user="u")
    assert c.options()["url"] == "jdbc:oracle:thin:@h:1521/svc"
    assert c.table_name("S", "T") == "S.T"
    with pytest.raises(ValueError):
        J.Connection("netezza").options()
    with pytest.raises(KeyError):
        J.Connection("mysql", "h", 3306, "d", password_env="LODESTONE_NO_SUCH_VAR").options()


@pytest.fixture()
def derby(spark):
    from lodestone.plans import derived as D
    conn = J.derby_connection("t" + uuid.uuid4().hex[:8])
    J.write_table(D.table(spark, "/root/testdata/sf0.001", "orders"), conn, "orders")
    return conn


def test_jdbc_reads(spark, derby):
    whole = J.read_table(spark, derby, None, "orders", preferTimestampNTZ="true")
    assert whole.count() == 1500
    pulled = J.read_incremental(whole, "o_orderkey", ">", 1000)
    plan = pulled._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderkey" in plan
    assert pulled.count() == 499
    split = J.read_split(spark, derby, None, "orders", '"o_orderkey"', 4)
    assert split.rdd.getNumPartitions() == 4 and split.count() == 1500
    with pytest.raises(ValueError, match="split column"):
        J.read_split(spark, derby, None, "orders", None, 4)
    q = J.read_query(spark, derby, 'SELECT "o_custkey", "o_totalprice" FROM orders')
    assert q.filter(F.col("o_totalprice") > 1e5).count() == \
        whole.filter(F.col("o_totalprice") > 1e5).count()


def _counts(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_quantile_splits_are_even_and_whole(spark):
    conn = J.derby_connection("q" + uuid.uuid4().hex[:8])
    names = ["O'Hara", "a", "B", "zz", "Ä", ""]
    rows = spark.range(4000).selectExpr("id", "CASE WHEN id % 97 = 0 THEN NULL WHEN id % 10 = 0 THEN id * 100 ELSE id END AS skewed",
                                        "concat(substr('QKMAZ', 1 + id % 5, 1), id) AS t",
                                        "DATE'2020-01-01' + CAST(id % 900 AS int) AS d")
    J.write_table(rows, conn, "split", createTableColumnTypes="t VARCHAR(40)")
    for col in ('"skewed"', '"t"', '"d"'):
        got = J.read_split(spark, conn, None, "split", col, 8, method="quantile")
        counts = _counts(got)
        assert got.rdd.getNumPartitions() == 8 and sum(counts) == 4000
        assert max(counts) <= 2 * 500
        assert got.select("id").distinct().count() == 4000
    # equal strides would put nine rows of ten in one stream
    assert max(_counts(J.read_split(spark, conn, None, "split", '"skewed"', 8))) > 3000
    assert J.read_split(spark, conn, None, "split", '"t"', 8, method="quantile",
                        query='SELECT "id", "t" FROM split WHERE "id" < 0').count() == 0
    tricky = spark.createDataFrame([(i, n) for i, n in enumerate(names * 4)], "id int, n string")
    J.write_table(tricky, conn, "tricky", createTableColumnTypes="n VARCHAR(40)")
    assert J.read_split(spark, conn, None, "tricky", '"n"', 5, method="quantile").count() == 24
    with pytest.raises(ValueError, match="hash"):
        J.read_split(spark, conn, None, "split", '"t"', 8, method="hash")
    other = J.Connection("oracle", "h", 1, "d")
    assert J.split_predicates(spark, other, "t", "c", 2, "hash") == ["(MOD(ORA_HASH(c), 2) = 0) OR c IS NULL",
                                                                    "MOD(ORA_HASH(c), 2) = 1"]


def test_a_window_is_the_same_for_every_task_and_the_next_load_takes_the_rest(spark, tmp_root):
    from lodestone.functions.types import HeaderColumn
    from lodestone.plans.pipeline import Layout, LoadSpec, read_staging, run_load
    conn, ntz = J.derby_connection("w" + uuid.uuid4().hex[:8]), {"preferTimestampNTZ": "true"}

    def put(ids, mode="append"):
        J.write_table(spark.createDataFrame([(i,) for i in ids], "k long")
                      .selectExpr("k", "TIMESTAMP_NTZ'2020-01-01' + make_dt_interval(0, 0, 0, k) AS ts"), conn, "src", mode)
    put(range(20), "overwrite")
    header = [HeaderColumn("k", "NUMBER"), HeaderColumn("ts", "TIMESTAMP")]
    spec, layout = LoadSpec("src", refresh="APPEND", incr_col="ts"), Layout(tmp_root)

    def load(batch, between=()):
        upper = J.upper_bound(spark, conn, "src", '"ts"', **ntz)
        source = J.read_split(spark, conn, None, "src", '"k"', 4, **ntz)
        put(between)  # the source goes on before the first task reads
        window = J.read_window(source, "ts", ">", None, upper[0])
        assert "ts" in window._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
        r = run_load(spark, source, header, spec, layout, batch, upper=upper)
        assert r.status == "S"
        return r.source_rows, read_staging(spark, layout.stg(spec)).count()
    assert load("1", range(20, 30)) == (20, 20)
    assert load("2", range(30, 33)) == (10, 30)
    assert load("3") == (3, 33)
    assert sorted(r.k for r in read_staging(spark, layout.stg(spec)).collect()) == list(range(33))
    # a task run again, after more rows, reads the same
    upper = J.upper_bound(spark, conn, "src", '"ts"', **ntz)[0]
    pull = J.read_window(J.read_split(spark, conn, None, "src", '"k"', 4, **ntz), "ts", ">",
                         F.expr("TIMESTAMP_NTZ'2020-01-01 00:00:09'"), upper)
    first = sorted(r.k for r in pull.collect())
    put(range(33, 50))
    assert sorted(r.k for r in pull.collect()) == first == list(range(10, 33))


def test_headers_of_a_whole_schema(spark):
    columns = spark.createDataFrame(
        [("S", "T1", "B", "NUMBER", 22, 2, 2), ("S", "T1", "A", "VARCHAR2", 9, None, 1), ("S", "T2", "X", "DATE", 7, None, 1)],
        "owner string, table_name string, column_name string, data_type string, data_length int, data_scale int, column_id int")
    comments = spark.createDataFrame([("S", "T1", "A", "first"), ("S", "T2", "X", None), ("R", "T1", "B", "no")],
                                     "owner string, table_name string, column_name string, comments string")
    got = {r.table_name: [tuple(c) for c in r.header] for r in J.schema_headers(columns, comments).collect()}
    assert got == {"T1": [("A", "VARCHAR2", "first", "9", None), ("B", "NUMBER", " ", "22", "2")],
                   "T2": [("X", "DATE", " ", "7", None)]}
    assert {r.table_name: len(r.header) for r in J.schema_headers(columns).collect()} == {"T1": 2, "T2": 1}


def test_dictionary(spark, derby):
    schemas = {r[0] for r in J.catalog_schemas(spark, derby).collect()}
    assert "APP" in schemas
    tables = {r[0] for r in J.catalog_tables(spark, derby, "APP").collect()}
    assert "ORDERS" in tables
    found = J.catalog_columns(spark, derby, "APP", "ORDERS").collect()
    assert [r["name"] for r in found][:2] == ["o_orderkey", "o_custkey"] and "BIGINT" in found[0]["sql_type"]
    # column metadata in ordinal order, blank comment when missing (J4 shape)
    cols = spark.createDataFrame(
        [("B", "NUMBER", None, 22, 0, 2), ("A", "VARCHAR2", "name", 30, None, 1)],
        "column_name string, data_type string, comments string, data_length int, "
        "data_scale int, column_id int")
    h = J.header_frame(cols).collect()
    assert [(r["name"], r["comment"]) for r in h] == [("A", "name"), ("B", " ")]


def test_lookup_ignores_case_of_the_service(spark, config):
    sources, extracts = config
    lower = sources.withColumn("service_nm", F.lower("service_nm"))
    assert config_lookup(lower, extracts, "Sales", "a", "orders").first()["extract_id"] == 1


def test_registered_table_loads_end_to_end(spark, derby, tmp_root):
    from lodestone.plans.config import load_from_config, query_of, register_source, register_tables
    from lodestone.plans.pipeline import Layout, read_staging
    sources = register_source(spark, f"{tmp_root}/sources", service_nm="Shop", source_db_typ="DERBY",
                              db_name=derby.db)
    with pytest.raises(ValueError, match="registered"):
        register_source(spark, f"{tmp_root}/sources", service_nm="SHOP", source_db_typ="derby")
    tables = J.catalog_tables(spark, derby, "APP")
    extracts = register_tables(spark, f"{tmp_root}/extracts", tables, "shop", "app",
                               parallel_extract="Y", extract_parallelism=3, parallel_splitby='"o_orderkey"')
    extracts = register_tables(spark, f"{tmp_root}/extracts", tables, "shop", "other")
    assert sorted(r.extract_id for r in extracts.collect()) == [1, 2]
    layout, ntz = Layout(f"{tmp_root}/loads"), {"preferTimestampNTZ": "true"}
    r = load_from_config(spark, sources, extracts, "SHOP", "APP", "orders", layout, "1", options=ntz)
    assert (r.status, r.source_rows, r.target_rows) == ("S", 1500, 1500)
    assert read_staging(spark, r.staging_path).count() == 1500
    q = 'SELECT "o_orderkey", "o_totalprice" FROM APP.orders WHERE "o_orderkey" <= 100'
    r = load_from_config(spark, sources, extracts, "SHOP", "APP", "orders", layout, "2", query=q, options=ntz)
    assert r.status == "S" and read_staging(spark, r.staging_path).columns == ["o_orderkey", "o_totalprice"]
    with pytest.raises(LookupError):
        load_from_config(spark, sources, extracts, "SHOP", "APP", "nothing", layout, "3")
    # argument, then configured query, then query file, then the table
    spark.createDataFrame([("SELECT 3",)], "value string").coalesce(1).write.text(f"{tmp_root}/q/A.sql")
    row = {"query": "SELECT 2", "extract_name": "A"}
    assert query_of(row, "SELECT 1") == "SELECT 1" and query_of(row) == "SELECT 2"
    row["query"] = None
    assert query_of(row, None, f"{tmp_root}/q", spark).strip() == "SELECT 3" and query_of(row) is None


def test_registered_period_table_loads_twice(spark, tmp_root):
    """A table registered with a derived period: a first load, then an increment whose window ends where it began."""
    from lodestone.plans.config import load_from_config, register_source, register_tables
    from lodestone.plans.pipeline import Layout, read_staging
    from lodestone.sources.header import HeaderDrift  # noqa: F401
    conn, ntz = J.derby_connection("p" + uuid.uuid4().hex[:8]), {"preferTimestampNTZ": "true"}

    def put(rows, mode):
        J.write_table(spark.createDataFrame(rows, "k long, d string, ts string, v double").selectExpr(
            "k", "CAST(d AS timestamp_ntz) AS d", "CAST(ts AS timestamp_ntz) AS ts", "v"), conn, "sales", mode)
    put([(i, f"2014-0{1 + i % 4}-05 00:00:00", "2020-01-01 00:00:00", 1.0) for i in range(40)], "overwrite")
    sources = register_source(spark, f"{tmp_root}/sources", service_nm="Shop", source_db_typ="DERBY", db_name=conn.db)
    extracts = register_tables(spark, f"{tmp_root}/extracts", J.catalog_tables(spark, conn, "APP"), "shop", "app",
                               refresh_typ="INCR", incr_pk_col="k", incr_col_nm="ts", is_partition="Y",
                               partition_col_nm="month", period_source="d", first_load="full", merge_strategy="files",
                               parallel_extract="Y", extract_parallelism=3, parallel_splitby='"k"', split_method="quantile")
    layout = Layout(f"{tmp_root}/loads")

    def load(batch, **more):
        return load_from_config(spark, sources, extracts, "shop", "APP", "sales", layout, batch, options=ntz, **more)
    r = load("1")
    assert (r.status, r.target_rows) == ("S", 40)
    put([(3, "2014-04-05 00:00:00", "2020-01-02 00:00:00", 2.0), (99, "2015-01-01 00:00:00", "2020-01-02 00:00:00", 3.0)], "append")
    r = load("2")
    assert (r.status, r.source_rows, r.inserted_rows, r.target_rows) == ("S", 2, 1, 41)
    got = {x.k: (x.v, str(x.month)) for x in read_staging(spark, r.staging_path).collect()}
    assert got[3] == (2.0, "201404") and got[99] == (3.0, "201501") and len(got) == 41
    # the source changes a type: the load stops
    J.write_table(spark.createDataFrame([(1, "x")], "k long, ts string"), conn, "sales")
    assert "HeaderDrift" in load("3", raise_errors=False).error
