import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestone.functions.types import HeaderColumn, header_from_schema
from lodestone.operators.merge import merge_patch
from lodestone.operators.sinks import raw_batches
from lodestone.plans import derived as D
from lodestone.plans.audit import audit_summary, read_audit
from lodestone.plans.pipeline import (Layout, LoadError, LoadSpec, read_staging,
                                      run_load)

SF = "/root/testdata/sf0.001"
HEADER = [HeaderColumn("o_orderkey", "NUMBER"), HeaderColumn("o_orderstatus", "VARCHAR2"),
          HeaderColumn("o_totalprice", "NUMBER"), HeaderColumn("extract_ts", "TIMESTAMP")]
T0, T1 = "2020-01-01 00:00:00", "2020-01-01 02:00:00"


def test_full_then_incr_then_reconcile(spark, tmp_root):
    layout = Layout(tmp_root)
    base, delta = D.base(spark, SF), D.delta(spark, SF)
    full = LoadSpec("orders", "t", "FULL", extract_id=1)
    r1 = run_load(spark, base, HEADER, full, layout, "1")
    assert (r1.status, r1.source_rows, r1.target_rows) == ("S", 1500, 1500)
    incr = LoadSpec("orders", "t", "INCR", keys=("o_orderkey",), incr_col="extract_ts",
                    extract_id=1)
    r2 = run_load(spark, base.unionByName(delta), HEADER, incr, layout, "2")
    new_keys = delta.filter(F.col("o_orderkey") >= D.NEW_KEY_OFFSET) \
        .filter(F.col("extract_ts") > D.ts_literal(D.BASE_TS)).count()
    assert r2.status == "S" and r2.inserted_rows == new_keys
    assert r2.target_rows == 1500 + new_keys
    assert r2.incr_col_val.startswith("2020-01-01")
    merged = read_staging(spark, layout.stg(incr))
    # a blank string in the increment overwrites, a NULL number keeps the old value
    k20 = merged.filter(F.col("o_orderkey") == 20).first()
    assert k20["o_orderstatus"] == "" and k20["o_totalprice"] is not None
    # the previous version is kept next to the table
    assert read_staging(spark, layout.new(incr)).count() == 1500
    merged_rows = merged.count()
    # rerunning the same increment is idempotent
    run_load(spark, base.unionByName(delta), HEADER, incr, layout, "3")
    again = read_staging(spark, layout.stg(incr))
    assert again.count() == merged_rows
    audit = read_audit(spark, layout.audit())
    assert audit.count() == 3 and audit.filter("status = 'S'").count() == 3
    s = audit_summary(audit).first()
    assert s["runs"] == 3 and s["last_status"] == "S"


def test_failures_record_the_real_stage(spark, tmp_root):
    layout = Layout(tmp_root)
    orders = D.table(spark, SF, "orders")
    header = header_from_schema(orders.schema)
    spec = LoadSpec("orders", "t", "INCR", keys=("o_orderkey",), incr_col="o_orderdate")
    with pytest.raises(LoadError, match="stage 1"):
        run_load(spark, orders, header, spec, layout, "1")
    bad = header[:-1] + [HeaderColumn("o_orderpriority", "BIGINT")]
    res = run_load(spark, orders, bad, LoadSpec("orders", "t"), layout, "2", raise_errors=False)
    assert res.status == "F" and res.fail_step == 5 and "BIGINT" in res.error
    rows = read_audit(spark, layout.audit()).orderBy("exec_id").collect()
    assert [(r["status"], r["fail_step"]) for r in rows] == [("F", 1), ("F", 5)]


def test_incr_first_load_option(spark, tmp_root):
    layout = Layout(tmp_root)
    base = D.base(spark, SF)
    spec = LoadSpec("orders", "t", "INCR", keys=("o_orderkey",), incr_col="extract_ts",
                    first_load="full")
    r = run_load(spark, base, HEADER, spec, layout, "1")
    assert r.status == "S" and r.target_rows == 1500


def test_partitioned_loads_and_archive(spark, tmp_root):
    layout = Layout(tmp_root)
    orders = D.table(spark, SF, "orders")
    header = header_from_schema(orders.schema)
    spec = LoadSpec("orders", "t", "FULL", partition="199511-199602",
                    period_source="o_orderdate", archive=True)
    r = run_load(spark, orders, header, spec, layout, "1")
    stg = read_staging(spark, layout.stg(spec))
    want = orders.filter(F.date_format("o_orderdate", "yyyyMM")
                         .isin("199511", "199512", "199601", "199602")).count()
    assert r.status == "S" and stg.count() == want
    assert {str(x[0]) for x in stg.select("month").distinct().collect()} == \
        {"199511", "199512", "199601", "199602"}
    run_load(spark, orders, header, spec, layout, "2")
    assert raw_batches(spark, layout.raw(spec)) == ["1", "2"]
    assert read_staging(spark, layout.stg(spec)).count() == want   # rerun replaces
    sym = LoadSpec("orders2", "t", "APPEND", incr_col="o_orderdate", partition="quarter",
                   period_source="o_orderdate")
    run_load(spark, orders, header, sym, layout, "1")
    q = read_staging(spark, layout.stg(sym))
    assert q.count() == 1500 and q.select("quarter").distinct().count() > 20


def test_raw_only_and_restart(spark, tmp_root):
    layout = Layout(tmp_root)
    orders = D.table(spark, SF, "orders")
    header = header_from_schema(orders.schema)
    spec = LoadSpec("orders", "t", "FULL", raw_format="PARQUET", stg_format="ORC")
    r = run_load(spark, orders, header, spec, layout, "7", stop_after="raw")
    assert r.status == "S" and r.source_rows == 1500
    r2 = run_load(spark, orders.limit(0), header, spec, layout, "7", start_at=3)
    assert r2.status == "S" and r2.target_rows == 1500
    assert read_staging(spark, layout.stg(spec), "ORC").count() == 1500


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, ts string, month string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))


KV = [HeaderColumn("k", "INTEGER"), HeaderColumn("v", "VARCHAR2"), HeaderColumn("ts", "TIMESTAMP")]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_watermark_does_not_depend_on_the_process_zone(spark, zone, kind, monkeypatch):
    import time

    from lodestone.operators.aggregates import watermark_literal
    from lodestone.sources.jdbc import read_incremental
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        rows = spark.sql(f"SELECT id, CAST('2020-01-01 00:00:00.123457' AS {kind}) + id * INTERVAL 1 HOUR AS ts "
                         "FROM range(10)")
        mark, text = watermark_literal(rows.filter("id <= 5"), "ts")
        assert sorted(r.id for r in read_incremental(rows, "ts", ">", mark).collect()) == [6, 7, 8, 9]
        assert text.startswith("2020-01-01 05:00:00.123457")
    finally:
        monkeypatch.undo()
        time.tzset()


def test_period_specs_lose_no_increment_rows(spark, tmp_root):
    layout = Layout(tmp_root)
    run_load(spark, _rows(spark, [(1, "a", T0, "201401")]), KV, LoadSpec("t", partition="month"), layout, "1")
    for refresh, batch in (("INCR", "2"), ("APPEND", "3")):
        spec = LoadSpec("t", refresh=refresh, keys=("k",), incr_col="ts", partition="201402")
        at = f"2020-01-0{batch} 00:00:00"
        r = run_load(spark, _rows(spark, [(int(batch), "b", at, "201402"), (10 + int(batch), "c", at, "201403")]),
                     KV, spec, layout, batch)
        assert (r.status, r.source_rows, r.excluded_rows) == ("S", 2, 0)
    got = {(r.k, str(r.month)) for r in read_staging(spark, layout.stg(spec)).collect()}
    assert got == {(1, "201401"), (2, "201402"), (12, "201403"), (3, "201402"), (13, "201403")}


def test_full_load_counts_excluded_rows_and_drops_emptied_periods(spark, tmp_root):
    layout = Layout(tmp_root)
    spec = LoadSpec("t", partition="201401-201402")
    r = run_load(spark, _rows(spark, [(1, "a", T0, "201401"), (2, "b", T0, "201402"), (3, "c", T0, "201405")]),
                 KV, spec, layout, "1")
    assert (r.status, r.excluded_rows, r.target_rows) == ("S", 1, 2)
    r = run_load(spark, _rows(spark, [(2, "b", T0, "201402")]), KV, spec, layout, "1")
    assert (r.status, r.target_rows) == ("S", 1)        # the period without rows is empty now
    r = run_load(spark, _rows(spark, []), KV, LoadSpec("empty", partition="201401"), layout, "1")
    assert (r.status, r.target_rows) == ("S", 0)


def test_a_lost_row_fails_the_load(spark, tmp_root, monkeypatch):
    from lodestone.plans import pipeline as P
    layout, spec = Layout(tmp_root), LoadSpec("t", refresh="INCR", keys=("k",), incr_col="ts")
    run_load(spark, _rows(spark, [(1, "a", T0, ""), (2, "b", T0, "")]), KV, LoadSpec("t"), layout, "1")
    merge = P.merge_patch
    monkeypatch.setattr(P, "merge_patch", lambda *a, **k: merge(*a, **k).filter("k <> 2"))
    r = run_load(spark, _rows(spark, [(1, "x", T1, "")]), KV, spec, layout, "2", raise_errors=False)
    assert r.status == "F" and "expected 2" in r.error
    rejects = run_load(spark, spark.createDataFrame([("1", "a", T0), ("zwei", "b", T0)], "k string, v string, ts string"),
                       KV, LoadSpec("r"), layout, "1")
    assert (rejects.status, rejects.rejected_values) == ("S", 1)


def test_restart_at_every_stage(spark, tmp_root):
    layout = Layout(tmp_root)
    run_load(spark, _rows(spark, [(1, "a", T0, "")]), KV, LoadSpec("t"), layout, "1")
    spec = LoadSpec("t", refresh="INCR", keys=("k",), incr_col="ts")
    more = _rows(spark, [(1, "x", T1, ""), (2, "y", T1, "")])
    want = {(1, "x"), (2, "y")}
    run_load(spark, more, KV, spec, layout, "2")
    for stage in (2, 3, 4, 5, 6):
        r = run_load(spark, None, KV, spec, layout, "2", start_at=stage)
        assert r.status == "S" and r.inserted_rows == 0
        assert {(r.k, r.v) for r in read_staging(spark, layout.stg(spec)).collect()} == want
    app = LoadSpec("a", refresh="APPEND", incr_col="ts")
    run_load(spark, more, KV, app, layout, "1")
    for stage in (1, 2, 3, 4, 5, 6):
        r = run_load(spark, more, KV, app, layout, "1", start_at=stage)
        assert r.status == "S" and read_staging(spark, layout.stg(app)).count() == 2


def test_rerun_of_a_batch_leaves_exactly_the_new_rows(spark, tmp_root):
    from lodestone.operators.sinks import land_raw, read_raw
    rows = spark.createDataFrame([("1", "201401"), ("2", "201402")], "k string, month string")
    for part in (rows, rows.limit(1), rows.limit(0)):
        land_raw(part, tmp_root, "7", partition_col="month")
        assert read_raw(spark, tmp_root, ["k"], batch_id="7", partition_col="month").count() == part.count()


@pytest.mark.parametrize("after", [0, 1, 2, 3])
def test_a_swap_that_dies_loses_nothing(spark, tmp_root, after, monkeypatch):
    """Dies after each rename in turn; the retry ends with the new version."""
    from lodestone.operators import sinks as S
    layout, spec = Layout(tmp_root), LoadSpec("t", refresh="INCR", keys=("k",), incr_col="ts")
    run_load(spark, _rows(spark, [(i, "a", T0, "") for i in range(10)]), KV, LoadSpec("t"), layout, "1")
    renamed, rename = [], S.rename_path

    def dying(sp, src, dst):
        if "/stg/" in src and len(renamed) >= after:
            raise OSError("the driver died")
        rename(sp, src, dst)
        if "/stg/" in src:
            renamed.append(dst)

    more = _rows(spark, [(3, "x", T1, "")])
    monkeypatch.setattr(S, "rename_path", dying)
    run_load(spark, more, KV, spec, layout, "2", raise_errors=False)
    monkeypatch.undo()
    run_load(spark, None, KV, spec, layout, "2", start_at=3)
    got = {r.k: r.v for r in read_staging(spark, layout.stg(spec)).collect()}
    assert got == {i: "x" if i == 3 else "a" for i in range(10)}


def test_scoped_merge_leaves_other_partitions_alone(spark, tmp_root):
    from lodestone.session import data_files
    layout = Layout(tmp_root)
    run_load(spark, _rows(spark, [(i, "a", T0, f"20140{i % 3 + 1}") for i in range(9)]), KV,
             LoadSpec("t", partition="month"), layout, "1")
    spec = LoadSpec("t", refresh="INCR", keys=("k",), incr_col="ts", partition="month", keys_move=False)
    before = set(data_files(spark, layout.stg(spec)))
    r = run_load(spark, _rows(spark, [(1, "x", T1, "201402"), (50, "n", T1, "201402")]), KV, spec, layout, "2")
    assert r.status == "S" and r.inserted_rows == 1
    after = set(data_files(spark, layout.stg(spec)))
    assert {f for f in before if "201402" not in f[0]} == {f for f in after if "201402" not in f[0]}
    got = {r.k: r.v for r in read_staging(spark, layout.stg(spec)).collect()}
    assert got == {**{i: "a" for i in range(9)}, 1: "x", 50: "n"}


def test_scoped_merge_finds_rows_of_patches_without_a_period(spark, tmp_root):
    from lodestone.session import data_files
    layout = Layout(tmp_root)
    run_load(spark, _rows(spark, [(i, "a", T0, f"20140{i % 3 + 1}") for i in range(9)] + [(20, "a", T0, None)]), KV,
             LoadSpec("t", partition="month"), layout, "1")
    spec = LoadSpec("t", refresh="INCR", keys=("k",), incr_col="ts", partition="month", keys_move=False)
    before = set(data_files(spark, layout.stg(spec)))
    patches = [(1, "x", T1, None), (20, "y", T1, None), (50, "n", T1, None), (3, "z", T1, "201401")]
    r = run_load(spark, _rows(spark, patches), KV, spec, layout, "2")
    assert (r.status, r.inserted_rows, r.target_rows) == ("S", 1, 11)
    after = set(data_files(spark, layout.stg(spec)))
    assert {f for f in before if "201403" in f[0]} == {f for f in after if "201403" in f[0]}
    got = sorted((r.k, r.v, r.month and str(r.month)) for r in read_staging(spark, layout.stg(spec)).collect())
    assert got == sorted([(i, {1: "x", 3: "z"}.get(i, "a"), f"20140{i % 3 + 1}") for i in range(9)]
                         + [(20, "y", None), (50, "n", None)])


def _month_files(spark, path):
    from lodestone.session import data_files
    return set(data_files(spark, path))


def test_merge_of_touched_files_keeps_all_others(spark, tmp_root):
    from lodestone.plans.pipeline import merge_files, touched_files
    rows = [(i, "a", T0, f"20140{i % 4 + 1}") for i in range(40)] + [(None, "n", T0, "201401")]
    cols = "k long, v string, ts string, month string"
    # two files a period: k below 20 and the others
    base, table = spark.createDataFrame(rows, cols), f"{tmp_root}/files/t"
    for half in (F.col("k") < 20, (F.col("k") >= 20) | F.col("k").isNull()):
        base.filter(half).coalesce(1).write.mode("append").partitionBy("month").parquet(table)
    before = _month_files(spark, table)
    assert len(before) == 8
    # 1 is patched in its period, 25 (201402) moves to 201404, 60 is new, a null key is inserted
    incr = spark.createDataFrame([(1, "x", T1, None), (25, None, T1, "201404"), (60, "n", T1, "201401"),
                                  (None, "z", T1, "201403")], cols)
    schema = spark.read.parquet(table).schema
    want = merge_patch(base, incr, ["k"]).collect()
    assert len(touched_files(read_staging(spark, table, schema=base.schema), incr, ["k"])) == 2
    assert merge_files(spark, table, f"{tmp_root}/files/new", incr, ["k"], None, part="month", schema=base.schema) == 2
    after = _month_files(spark, table)
    gone = before - after
    assert len(gone) == 2 and all(f[0] == "month=201402/" for f in gone)
    got = read_staging(spark, table, schema=base.schema).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 43
    assert spark.read.parquet(table).schema.fieldNames() == schema.fieldNames()
    # nothing to change: no file is touched
    none = incr.filter("false")
    assert merge_files(spark, table, f"{tmp_root}/files/new", none, ["k"], None, part="month", schema=base.schema) == 0
    assert _month_files(spark, table) == after


@pytest.mark.parametrize("after", range(7))  # its steps, and none
def test_a_merge_of_files_that_dies_is_ended_by_the_next_load(spark, tmp_root, after, monkeypatch):
    """Dies after each rename or delete in turn; the retry ends with the new rows once."""
    from lodestone.operators import sinks as S
    layout = Layout(tmp_root)
    spec = LoadSpec("t", refresh="INCR", keys=("k",), incr_col="ts", partition="month", merge_strategy="files")
    run_load(spark, _rows(spark, [(i, "a", T0, f"20140{i % 3 + 1}") for i in range(9)]), KV,
             LoadSpec("t", partition="month"), layout, "1")
    done, dying = [], {}

    def deadly(name):
        plain = getattr(S, name)

        def step(sp, *paths):
            if dying and "_change" in paths[0] + paths[-1] or (dying and name == "delete_path" and "month=" in paths[0]):
                if len(done) >= after:
                    raise OSError("the driver died")
                done.append(paths)
            return plain(sp, *paths)
        monkeypatch.setattr(S, name, step)
    deadly("rename_path")
    deadly("delete_path")
    dying["now"] = True
    more = [(3, "x", T1, "201402"), (70, "n", T1, "201401")]
    run_load(spark, _rows(spark, more), KV, spec, layout, "2", raise_errors=False)
    monkeypatch.undo()
    r = run_load(spark, _rows(spark, more), KV, spec, layout, "2")
    assert r.status == "S" and len(done) == after
    got = sorted((r.k, r.v, str(r.month)) for r in read_staging(spark, layout.stg(spec)).collect())
    assert got == sorted([(i, "x" if i == 3 else "a", "201402" if i == 3 else f"20140{i % 3 + 1}") for i in range(9)]
                         + [(70, "n", "201401")])


def test_the_mark_is_carried_and_verified(spark, tmp_root, monkeypatch):
    """The next load knows the high-water mark without reading the column, unless the files are others."""
    from lodestone.plans import pipeline as P
    layout, spec = Layout(tmp_root), LoadSpec("t", refresh="APPEND", incr_col="ts")
    run_load(spark, _rows(spark, [(1, "a", T0, ""), (2, "a", T1, "")]), KV, spec, layout, "1")
    reads = []
    real = P.read_staging
    monkeypatch.setattr(P, "read_staging", lambda *a: reads.append(a) or real(*a))
    load = P._Load(spark, KV, spec, layout, "2", P.LoadResult("F", None, None, ""))
    load.plan()
    assert load.high_water()[1] == T1 and not reads
    r = run_load(spark, _rows(spark, [(2, "a", T1, ""), (3, "b", "2020-01-01 03:00:00", "")]), KV, spec, layout, "2")
    assert (r.status, r.source_rows, r.incr_col_val) == ("S", 1, T1)
    # files that no load wrote: the column is read
    real(spark, layout.stg(spec)).limit(1).selectExpr("k", "v", "TIMESTAMP_NTZ'2021-01-01 00:00:00' AS ts") \
        .write.mode("append").parquet(layout.stg(spec))
    reads.clear()
    assert load.high_water()[1] == "2021-01-01 00:00:00" and reads


def test_footers_tell_the_mark(spark, tmp_root):
    from lodestone.operators.aggregates import footer_max
    spark.range(10_000).selectExpr("id", "DATE'2020-01-01' + CAST(id % 50 AS int) AS d", "'x' AS s") \
        .repartition(4).write.parquet(f"{tmp_root}/f")
    schema = spark.read.parquet(f"{tmp_root}/f").schema
    for col, top in (("id", 9999), ("d", dt.date(2020, 2, 19))):
        found = footer_max(spark, f"{tmp_root}/f", schema, col)
        assert "PushedAggregation: [MAX(" in found._jdf.queryExecution().executedPlan().toString()
        assert found.first()[0] == top
    with pytest.raises(TypeError):
        footer_max(spark, f"{tmp_root}/f", schema, "s")


def test_a_frozen_header_stops_drift(spark, tmp_root):
    from lodestone.sources.header import accept_header, freeze_header
    layout, spec = Layout(tmp_root), LoadSpec("t", freeze_header=True)
    rows = _rows(spark, [(1, "a", T0, "")])
    assert run_load(spark, rows, KV, spec, layout, "1").status == "S"
    # a new column is noted and left out, in any order of columns
    more = [HeaderColumn("extra", "NUMBER"), *KV]
    r = run_load(spark, rows.withColumn("extra", F.lit(1)), more, spec, layout, "2")
    assert r.status == "S" and read_staging(spark, layout.stg(spec)).columns == [c.name for c in KV]
    other = [HeaderColumn(c.name, "VARCHAR2" if c.name == "k" else c.sql_type, c.comment, c.length, c.scale) for c in KV]
    for bad in (other, KV[1:]):
        r = run_load(spark, rows, bad, spec, layout, "3", raise_errors=False)
        assert (r.status, r.fail_step) == ("F", 1) and "HeaderDrift" in r.error
    said = {(a.status, a.notes) for a in read_audit(spark, layout.audit()).collect()}
    assert said == {("S", None), ("S", "the source has new columns: extra"), ("F", None)}
    assert accept_header(spark, layout.header(spec), other) == 2
    assert run_load(spark, rows, other, spec, layout, "4").status == "S"
    odd = [HeaderColumn("a b", "NUMBER", 'said "x", y; z', "9", "2")]
    assert freeze_header(spark, f"{tmp_root}/h", odd) == (odd, []) == freeze_header(spark, f"{tmp_root}/h", odd)


def test_a_versioned_table_never_is_away(spark, tmp_root):
    """A reader that polls during the swaps always finds one whole version."""
    import threading

    from lodestone.operators.sinks import current_version, publish_version, versions
    table, seen, stop, wrong = f"{tmp_root}/v/t", set(), threading.Event(), []

    def put(n):
        spark.range(100).selectExpr("id", f"{n} AS n").write.parquet(f"{tmp_root}/v/new{n}")
        publish_version(spark, table, f"{tmp_root}/v/new{n}")

    def poll():
        while not stop.is_set():
            try:
                rows = read_staging(spark, table).groupBy("n").count().collect()
                seen.add(rows[0][0])
                if len(rows) != 1 or rows[0][1] != 100:
                    wrong.append(rows)
            except Exception as e:
                wrong.append(e)
    put(0)
    reader = threading.Thread(target=poll)
    reader.start()
    pinned = current_version(spark, table)
    for n in range(1, 6):
        put(n)
        if n == 1:
            assert spark.read.parquet(pinned).select("n").first()[0] == 0
    stop.set()
    reader.join()
    assert not wrong and max(seen) >= 1 and versions(spark, table) == [5, 6]


def test_a_replaced_text_never_is_away(spark, tmp_root):
    """Readers beside 50 replacements find one of the texts each time; the first
    replaces a file that has a checksum file."""
    import threading

    from lodestone.session import read_text, replace_text, write_text
    path, stop, found = f"{tmp_root}/name", threading.Event(), []

    def poll():
        while not stop.is_set():
            try:
                found.append(read_text(spark, path))
            except Exception as e:
                found.append(e)
    write_text(spark, path, "text 0")
    readers = [threading.Thread(target=poll) for _ in range(3)]
    for r in readers:
        r.start()
    for n in range(1, 51):
        replace_text(spark, path, f"text {n}")
    stop.set()
    for r in readers:
        r.join()
    assert read_text(spark, path) == "text 50" and set(found) <= {f"text {n}" for n in range(51)}


@pytest.mark.parametrize("at", ["rename_path", "replace_text", "delete_path"])
def test_a_version_that_is_not_published_changes_nothing(spark, tmp_root, at, monkeypatch):
    from lodestone.operators import sinks as S
    layout = Layout(tmp_root)
    spec = LoadSpec("t", versioned=True)
    for batch in "12":
        assert run_load(spark, _rows(spark, [(int(batch), "a", T0, "")]), KV, spec, layout, batch).status == "S"
    real = getattr(S, at)
    monkeypatch.setattr(S, at, lambda sp, *p: (_ for _ in ()).throw(OSError("died")) if "/stg/" in p[0] else real(sp, *p))
    run_load(spark, _rows(spark, [(3, "a", T0, "")]), KV, spec, layout, "3", raise_errors=False)
    monkeypatch.undo()
    assert read_staging(spark, layout.stg(spec)).select("k").collect()[0][0] == (3 if at == "delete_path" else 2)
    assert run_load(spark, _rows(spark, [(4, "a", T0, "")]), KV, spec, layout, "4").status == "S"
    assert [r.k for r in read_staging(spark, layout.stg(spec)).collect()] == [4]
    incr = LoadSpec("t", refresh="INCR", keys=("k",), incr_col="ts", versioned=True)
    r = run_load(spark, _rows(spark, [(4, "b", T1, ""), (5, "n", T1, "")]), KV, incr, layout, "5")
    assert (r.status, r.target_rows) == ("S", 2)
    with pytest.raises(LoadError, match="versioned"):
        run_load(spark, _rows(spark, []), KV, LoadSpec("t", refresh="APPEND", incr_col="ts", versioned=True), layout, "6")


def test_catalog_gets_what_the_load_touched_and_a_view(spark, tmp_root, monkeypatch):
    layout, db = Layout(tmp_root), f"cat{tmp_root.rsplit('/', 1)[-1].replace('-', '')[-8:]}"
    full = LoadSpec("t", db, partition="month", register_catalog=True, statistics=True)
    run_load(spark, _rows(spark, [(i, "a", T0, f"20140{i % 9 + 1}") for i in range(27)]), KV, full, layout, "1")
    spec = LoadSpec("t", db, "INCR", keys=("k",), incr_col="ts", partition="month", merge_strategy="files",
                    register_catalog=True, statistics=True, latest_view=True)
    said, plain = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **b: said.append(q) or plain(self, q, *a, **b))
    r = run_load(spark, _rows(spark, [(1, "x", T1, "201402"), (70, "n", T1, "201512")]), KV, spec, layout, "2")
    monkeypatch.undo()
    assert r.status == "S"
    assert not any("RECOVER" in q and f"{db}.t " in q for q in said)
    assert sorted(q.split("(")[1].split(")")[0] for q in said if q.startswith("ANALYZE")) \
        == ["`month`='201402'", "`month`='201512'"]
    assert spark.table(f"{db}.t").count() == 28 and spark.sql(f"SHOW PARTITIONS {db}.t").count() == 10
    from lodestone.operators.merge import latest_version
    want = latest_version(spark.table(f"{db}.t"), spark.table(f"{db}.t_incr"), ["k"], "ts")
    view = spark.table(f"{db}.t_view")
    assert sorted(map(str, view.collect())) == sorted(map(str, want.collect())) and view.count() == 30
    plan = spark.sql(f"SELECT * FROM {db}.t_view WHERE k = 1")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 4 and all("EqualTo(k,1" in line for line in scans)


def test_stream_keeps_order_and_partitions(spark, tmp_root):
    from lodestone.operators.sinks import land_raw
    from lodestone.session import list_dirs
    from lodestone.streaming.increments import merge_batches
    header = [*KV, HeaderColumn("month", "CHAR")]
    for batch, v in (("1", "first"), ("2", "second"), ("3", "third")):
        rows = spark.createDataFrame([(1, v if batch != "3" else None, T0, "201401"), (int(batch), v, T0, "201402")][:2],
                                     "k int, v string, ts string, month string")
        land_raw(rows.filter(f"k <> 1 OR {batch} < 3 OR month = '201401'"), f"{tmp_root}/raw", batch, archive=True)
    q = merge_batches(spark, f"{tmp_root}/raw", header, f"{tmp_root}/t", ["k", "month"], "ts",
                      checkpoint=f"{tmp_root}/ckpt", partition_col="month")
    q.awaitTermination()
    assert set(list_dirs(spark, f"{tmp_root}/t")) == {"month=201401", "month=201402"}
    got = {(r.k, str(r.month)): r.v for r in read_staging(spark, f"{tmp_root}/t").collect()}
    assert got[(2, "201402")] == "second" and got[(3, "201402")] == "third" and got[(1, "201401")] in ("", "second")


@pytest.mark.parametrize("how", [{"strategy": "files"}, {"keys_move": False}])
def test_stream_rewrites_only_what_a_batch_touches(spark, tmp_root, how):
    from lodestone.operators.sinks import data_files, land_raw
    from lodestone.plans.audit import read_audit
    from lodestone.streaming.increments import merge_batches
    header, cols = [*KV, HeaderColumn("month", "CHAR")], "k int, v string, ts string, month string"

    def run():
        q = merge_batches(spark, f"{tmp_root}/raw", header, f"{tmp_root}/t", "k", "ts", checkpoint=f"{tmp_root}/ckpt",
                          partition_col="month", audit=f"{tmp_root}/audit", **how)
        q.awaitTermination()
        return set(data_files(spark, f"{tmp_root}/t"))

    months = [f"2014{m:02d}" for m in range(1, 7)]
    first = [(i, "old", T0, months[i % 6]) for i in range(30)]
    land_raw(spark.createDataFrame(first, cols), f"{tmp_root}/raw", "1", archive=True)
    before = run()
    land_raw(spark.createDataFrame([(7, "new", T1, months[1]), (100, "new", "x", months[2])], cols),
             f"{tmp_root}/raw", "2", archive=True)
    after = run()
    kept = {f for f in before if "month=201402" not in f[0] and "month=201403" not in f[0]}
    assert kept <= after and not any("month=201402" in d for d, _ in before & after)
    rows = {r.k: r.v for r in read_staging(spark, f"{tmp_root}/t").collect()}
    assert rows == {i: "old" for i in range(30)} | {7: "new", 100: "new"}
    told = [(r.status, r.source_row, r.tgt_rows, r.rejected_values, r.malformed_lines)
            for r in read_audit(spark, f"{tmp_root}/audit").orderBy("exec_strt_ts").collect()]
    assert told == [("S", 30, 30, 0, 0), ("S", 2, 31, 1, 0)]


def test_stream_stops_at_malformed_lines(spark, tmp_root):
    from lodestone.plans.audit import read_audit
    from lodestone.streaming.increments import merge_batches
    spark.createDataFrame([("1|a|" + T0,), ("2|b",), ("3|c|" + T0 + "|more",)], "value string") \
        .write.text(f"{tmp_root}/raw/batch_id=1")

    def run():
        merge_batches(spark, f"{tmp_root}/raw", KV, f"{tmp_root}/t", "k", "ts", checkpoint=f"{tmp_root}/ckpt",
                      audit=f"{tmp_root}/audit").awaitTermination()

    for _ in range(2):  # nor does a restart pass over them
        with pytest.raises(Exception, match="2 malformed raw lines of 3"):
            run()
    from lodestone.session import path_exists
    assert not path_exists(spark, f"{tmp_root}/t")
    assert [(r.status, r.fail_step, r.source_row, r.malformed_lines)
            for r in read_audit(spark, f"{tmp_root}/audit").collect()] == [("F", 5, 3, 2)] * 2


def test_a_key_that_moves_after_all_ends_a_scoped_merge(spark, tmp_root):
    spec = LoadSpec("t", refresh="INCR", keys=("k",), incr_col="ts", partition="month", keys_move=False,
                    first_load="full")
    layout = Layout(tmp_root)
    assert run_load(spark, _rows(spark, [(1, "a", T0, "201401"), (2, "b", T0, "201402"), (9, "c", T0, None)]),
                    KV, spec, layout, "1").status == "S"
    before = read_staging(spark, layout.stg(spec)).collect()
    with pytest.raises(LoadError, match="keys_move"):
        run_load(spark, _rows(spark, [(1, "moved", T1, "201402"), (5, "new", T1, "201403")]), KV, spec, layout, "2")
    assert sorted(map(str, read_staging(spark, layout.stg(spec)).collect())) == sorted(map(str, before))


def test_catalog_statistics_after_a_load(spark, tmp_root):
    db = "stats_" + tmp_root.rsplit("-", 1)[-1]
    spec = LoadSpec("t", db, partition="month", register_catalog=True, statistics=True)
    run_load(spark, _rows(spark, [(i, "a", T0, "201401") for i in range(7)]), KV, spec, Layout(tmp_root), "1")
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {db}.t").collect()}
    assert "7 rows" in info["Statistics"]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from lodestone.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))
