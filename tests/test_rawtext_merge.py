import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lodestone.operators.merge import latest_version, merge_patch
from lodestone.operators.sinks import FormatError, avro_schema, resolve_format, write_dataset
from lodestone.sources.rawtext import read_raw_text

TRICKY = ["a|b", "\\", "\\\\", "end\\", "", None, "two\nlines", "cr\r", "\\n literal",
          "\\|", "x\\\\|y", "||", "\t"]


def _round_trip(spark, root, rows, names):
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    write_dataset(df, root, "TEXTFILE")
    return sorted((tuple(r) for r in read_raw_text(spark, root, names).collect()),
                  key=lambda t: t[0])


def test_raw_text_round_trip(spark, tmp_root):
    rows = [(str(i), v, v) for i, v in enumerate(TRICKY)]
    got = _round_trip(spark, tmp_root, rows, ["k", "a", "b"])
    want = sorted(((k, a or None, b or None) for k, a, b in rows), key=lambda t: t[0])
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab|\\\n\r\t n", max_size=8), min_size=1, max_size=12))
def test_raw_text_round_trip_property(spark, tmp_root, values):
    import uuid
    rows = [(f"{i:03d}", v) for i, v in enumerate(values)]
    got = _round_trip(spark, f"{tmp_root}/{uuid.uuid4().hex}", rows, ["k", "v"])
    assert got == [(k, v or None) for k, v in rows]


def test_rejected_formats():
    for bad in ("SEQ", "rcfile"):
        try:
            resolve_format(bad)
        except FormatError:
            continue
        raise AssertionError(bad)
    assert resolve_format("txt") == resolve_format("TEXTFILE") == "text"


BASE = [(1, "a"), (1, "a2"), (2, "b"), (None, "n")]
DELTA = [(1, "x"), (1, None), (None, "m"), (3, "z")]


def _frames(spark):
    b = spark.createDataFrame(BASE, "k int, v string")
    d = spark.createDataFrame(DELTA, "k int, v string")
    return b, d


def test_literal_merge_null_and_duplicate_keys(spark):
    b, d = _frames(spark)
    got = sorted(merge_patch(b, d, "k", strategy="shuffle", keep_duplicates=True).collect(),
                 key=str)
    # duplicates multiply, NULL keys never match, a NULL patch keeps the old value
    assert len(got) == 8
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, "x"), (1, "x"), (1, "a"), (1, "a2"), (2, "b"), (None, "n"), (None, "m"), (3, "z")],
        key=str)


def test_repeated_keys_need_an_order(spark):
    b, d = _frames(spark)
    with pytest.raises(ValueError, match="repeats keys"):
        merge_patch(b, d, "k")
    got = sorted(map(tuple, merge_patch(b, d, "k", dedupe_by="v").collect()), key=str)
    # the NULL patch of key 1 hides nothing; duplicates in the base are each patched
    assert got == sorted([(1, "x"), (1, "x"), (2, "b"), (None, "n"), (None, "m"), (3, "z")], key=str)


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_one_batch_equals_its_rows_one_after_another(spark, strategy):
    base = spark.createDataFrame([(1, 10.0, "A", 0), (2, 20.0, "B", 0), (None, 1.0, "N", 0)],
                                 "k int, price double, status string, ts int")
    steps = [[(1, 5.0, None, 1), (3, 7.0, None, 1)], [(1, None, "X", 2)], [(3, None, "Z", 3), (2, None, None, 3)],
             [(None, 9.0, "M", 4)]]
    one = base
    for rows in steps:
        one = merge_patch(one, spark.createDataFrame(rows, base.schema), "k", strategy, dedupe_by="ts")
    batch = spark.createDataFrame([r for rows in steps for r in rows], base.schema).repartition(3)
    whole = merge_patch(base, batch, "k", strategy, dedupe_by="ts")
    assert sorted(map(str, one.collect())) == sorted(map(str, whole.collect()))
    assert {r.k: (r.price, r.status) for r in whole.collect() if r.k}[1] == (5.0, "X")


def test_forms_agree_on_orders(spark):
    from lodestone.plans import derived as D
    sf = "/root/testdata/sf0.001"
    b, d = D.base(spark, sf), D.delta(spark, sf)
    a = merge_patch(b, d, ["o_orderkey"], strategy="shuffle")
    c = merge_patch(b, d, ["o_orderkey"])
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
    # merging the same increment twice changes nothing more (idempotent)
    twice = merge_patch(a, d, ["o_orderkey"])
    assert twice.exceptAll(a).count() == 0 and a.exceptAll(twice).count() == 0
    j = latest_version(b, d, ["o_orderkey"])
    w = latest_version(b, d, ["o_orderkey"], method="window")
    assert j.exceptAll(w).count() == 0 and w.exceptAll(j).count() == 0


def test_megabyte_fields_and_malformed_lines(spark, tmp_root):
    from lodestone.sources.rawtext import malformed_lines, parse_lines
    long = ("ab|c\\d\n" * 130_000) + "\\"
    got = _round_trip(spark, tmp_root, [("1", long), ("2", "|" * 5000)], ["k", "v"])
    assert got == [("1", long), ("2", "|" * 5000)]
    lines = spark.createDataFrame([("a|b",), ("a|b|c",), ("a",), ("x\\|y|z",)], "value string")
    assert tuple(malformed_lines(lines, 2).first()) == (2, 4)
    assert [r.n for r in parse_lines(lines, ["a", "b"], fields_col="n").collect()] == [2, 3, 1, 2]


def test_latest_version_ties_and_nulls(spark):
    rows = [(1, "a", 1), (1, "b", 1), (2, "c", None), (None, "d", 5), (3, "e", 1), (3, "f", 2)]
    df = spark.createDataFrame(rows, "k int, v string, extract_ts int")
    for method in ("join", "window"):
        got = sorted(tuple(r) for r in latest_version(df, None, ["k"], method=method).collect())
        assert got == [(1, "a", 1), (1, "b", 1), (3, "f", 2)]


def test_avro_schema_of_raw_rows():
    told = json.loads(avro_schema(["k", "v_1"], "orders"))
    assert told["name"] == "orders" and [f["name"] for f in told["fields"]] == ["k", "v_1"]
    assert all(f["type"] == ["null", "string"] and f["default"] is None for f in told["fields"])
    with pytest.raises(FormatError):
        avro_schema(["a b"])


def test_plain_decoding_matches_the_regular_expressions(spark):
    import random

    from pyspark.sql import functions as F

    from lodestone.sources.rawtext import escape_value, parse_lines, split_line, unescape_value
    r = random.Random(4)
    texts = ["".join(r.choices("\\|nrx", k=r.randrange(9))) for _ in range(3000)]
    texts += ["".join(r.choices(["\\\\", "\\|", "\\n", "\\r", "|", "n", "é", " "], k=r.randrange(12))) for _ in range(3000)]
    texts += ["a\nb\\|c|d\\n", "a\\\\\r|b", "\\", "a|b\\", "\\ |x"]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    v = F.col("value")
    slow = F.transform(split_line(v), unescape_value)
    names = ["a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "k"]
    got = parse_lines(lines, names, keep=["value"], fields_col="n")
    odd = got.filter((F.col("n") != F.size(split_line(v)))
                     | ~F.array(*names).eqNullSafe(F.array(*[F.nullif(F.get(slow, i), F.lit("")) for i in range(len(names))])))
    assert got.count() == len(texts) and odd.collect() == []
    two = parse_lines(lines.select(F.concat(escape_value(v), F.lit("|"), escape_value(v)).alias("value"), v.alias("was")),
                      ["a", "b"], keep=["was"], fields_col="n")
    assert two.filter("nullif(was, '') IS DISTINCT FROM a OR a IS DISTINCT FROM b OR n <> 2").collect() == []


def test_lines_of_usual_escapes_need_no_regular_expression(spark):
    from pyspark.sql import functions as F

    from lodestone.sources.rawtext import mark_escapes, unmark_escapes, usual_escapes
    line = spark.createDataFrame([("a\\\\n\\|b\\n\\r|c\\\\",), ("a\\x",)], "value string")
    got = line.select(usual_escapes(F.col("value")), F.transform(F.split(mark_escapes(F.col("value")), r"\|", -1), unmark_escapes))
    assert [tuple(r) for r in got.collect()][0] == (True, ["a\\n|b\n\r", "c\\"])
    assert got.collect()[1][0] is False
