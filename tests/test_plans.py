"""Physical-plan checks: pruning, pushdown, codegen, partial aggregation and
join strategy of the main operators."""

from lodestone.functions.types import header_from_schema
from lodestone.operators.aggregates import watermark_frame
from lodestone.operators.cleanse import cleanse_projection
from lodestone.operators.merge import latest_version, merge_patch
from lodestone.operators.sinks import land_raw, read_raw
from lodestone.plans import derived as D
from lodestone.sources import jdbc as J

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_reads_one_column(spark):
    p = plan(watermark_frame(D.table(spark, SF, "events"), "ts"))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in p
    assert p.count("HashAggregate") == 2          # partial + final


def test_incremental_filter_reaches_the_scan(spark):
    events = D.table(spark, SF, "events")
    p = plan(J.read_incremental(events, "event_id", ">", 500))
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,500)]" in p


def test_cleansing_is_one_codegen_stage(spark, tmp_root):
    orders = D.table(spark, SF, "orders")
    land_raw(orders, tmp_root, "1")
    raw = read_raw(spark, tmp_root, orders.columns, batch_id="1")
    typed = cleanse_projection(raw, header_from_schema(orders.schema))
    p = plan(typed)
    assert "Exchange" not in p                 # narrow: no shuffle
    # every project is inside whole-stage codegen (no interpreted fallback)
    lines = [ln for ln in p.splitlines() if "Project [" in ln]
    assert lines and all("*(" in ln for ln in lines)
    assert "PartitionFilters: [isnotnull(batch_id" in p


def test_shuffled_merge_uses_joins_that_can_be_split(spark):
    m = merge_patch(D.base(spark, SF), D.delta(spark, SF), ["o_orderkey"], strategy="shuffle")
    p = plan(m)
    assert "FullOuter" not in p and "ShuffledHashJoin" not in p and "BroadcastHashJoin" not in p
    assert p.count("SortMergeJoin") == 2 and "LeftOuter" in p and "LeftAnti" in p


def test_hot_key_of_a_merge_is_split(spark):
    """Three quarters of the base on one key: adaptive execution deals it to several tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        base = spark.range(0, 80_000, 1, 8).selectExpr("IF(id % 4 = 0, id, -1) AS k", "id AS v", "uuid() AS w")
        m = merge_patch(base, spark.range(0, 80_000, 40).selectExpr("id AS k", "-id AS v", "'x' AS w"), ["k"])
        m.write.format("noop").mode("overwrite").save()
        rows = m.collect()
        assert len(rows) == 80_000
        assert "SortMergeJoin(skew=true)" in m._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_keys_of_a_large_merge_meet_in_a_set_number_of_tasks(spark):
    """Adaptive execution doesn't gather the base keys, which compress well, in a few tasks."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
           if spark.conf.get(k, None) is not None}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        m = merge_patch(D.base(spark, SF), D.delta(spark, SF), ["o_orderkey"])
        m.collect()
        final = m._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        semi = final[final.index("LeftSemi"):final.index("LeftSemi") + final[final.index("LeftSemi"):].index("Filter")]
        assert "REPARTITION_BY_NUM" in final and "coalesced" not in semi
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_keys_of_a_merge_with_null_keys_meet_in_a_set_number_of_tasks(spark):
    """Null keys don't meet at all; the other base keys aren't gathered in a few tasks."""
    from lodestone.plans.queries import q_merge_null_keys
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        m = q_merge_null_keys(spark, SF)
        rows = m.collect()
        final = m._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        semi = final[final.index("LeftSemi"):]
        semi = semi[:semi.index("Filter")]
        assert "coalesced" not in semi and "o_orderkey#" in semi and ", 7)" in semi
        base = {r.o_orderkey for r in D.table(spark, SF, "orders").collect()}
        keys = [r.o_orderkey for r in rows]
        assert {k for k in base if k % 97} <= set(keys) and len(keys) - keys.count(None) == len(set(keys) - {None})
        assert keys.count(None) == sum(k % 97 == 0 for k in base) + sum(
            r.o_orderkey % 70 == 0 for r in D.delta(spark, SF).collect())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_auto_merge_respects_the_threshold(spark):
    b, d = D.base(spark, SF), D.delta(spark, SF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" not in plan(merge_patch(b, d, ["o_orderkey"]))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
        assert "BroadcastHashJoin" in plan(merge_patch(b, d, ["o_orderkey"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_latest_version_aggregates_partially(spark):
    lv = latest_version(D.base(spark, SF), D.delta(spark, SF), ["o_orderkey"])
    p = plan(lv)
    assert p.count("HashAggregate") >= 2


def test_latest_version_window_drops_old_rows_before_the_shuffle(spark):
    rows = spark.range(0, 4000, 1, 4).selectExpr("IF(id % 4 = 0, id, -1) AS k", "id % 500 AS extract_ts", "id AS v")
    lv = latest_version(rows, None, ["k"], method="window")
    before = plan(lv).split("Exchange")[1]
    assert "WindowGroupLimit" in before and "Partial" in before
    assert lv.exceptAll(latest_version(rows, None, ["k"])).count() == 0
    assert lv.count() == latest_version(rows, None, ["k"]).count()
