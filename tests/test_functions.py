import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lodestone.functions.cleansing import (convert_date, convert_null, convert_sign,
                                           decimal_chain, java_trim,
                                           register_sql_functions, to_timestamp_text)


def _apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


def test_convert_date_vectors(spark):
    vals = ["20121205", "2012011", None, "00000000", "2012-12-05 10:11:12", "", "  20121205 "]
    assert _apply(spark, convert_date, vals) == [
        "2012-12-05 00:00:00", "2012-01-01 00:00:00", "", "0000-00-00 00:00:00",
        "2012-12-05 10:11:12", "", "2012-12-05 00:00:00"]


def test_convert_date_to_timestamp(spark):
    got = _apply(spark, to_timestamp_text, ["20121205", "00000000", "", None, "abcdefgh"])
    assert got == [dt.datetime(2012, 12, 5), None, None, None, None]


def test_convert_sign_vectors(spark):
    vals = ["2134.00-", "2134.00", None, "-", " 5- ", "-3"]
    assert _apply(spark, convert_sign, vals) == ["-2134.00", "2134.00", "", "-", "-5", "-3"]


def test_convert_null_vectors(spark):
    vals = ["  ", "null", "NULL", "Null", "bukan null", "\tx\t", None, " a b "]
    assert _apply(spark, convert_null, vals) == ["", "", "", "", "bukan null", "x", "", "a b"]


def test_trim_strips_control_characters(spark):
    vals = ["\t a \t", "\x00\x1fz\x20", " y"]
    # U+00A0 is above U+0020 and stays
    assert _apply(spark, java_trim, vals) == ["a", "z", " y"]


def test_decimal_chain(spark):
    got = _apply(spark, lambda c: decimal_chain(c, DecimalType(12, 2)),
                 ["2134.00-", "12.345", "abc", "", None, "99999999999999999999"])
    assert got == [Decimal("-2134.00"), Decimal("12.35"), None, None, None, None]


def test_decimal_chain_goes_through_scale_two(spark):
    # a wider target scale still only keeps two decimals (the chain's rule)
    got = _apply(spark, lambda c: decimal_chain(c, DecimalType(10, 4)), ["1.23456"])
    assert got == [Decimal("1.2300")]
    direct = _apply(spark, lambda c: decimal_chain(c, DecimalType(10, 4), "direct"), ["1.23456"])
    assert direct == [Decimal("1.2346")]
    with pytest.raises(ValueError):
        decimal_chain(F.col("x"), DecimalType(10, 2), "other")


def test_sql_functions_match_column_functions(spark):
    register_sql_functions(spark)
    vals = ["20121205", "2012011", " null ", "2134.00-", None, "\tx\t", "-"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = df.selectExpr("ConvertDate(s)", "ConvertSign(s)", "ConvertNULL(s)").collect()
    want = df.select(convert_date("s"), convert_sign("s"), convert_null("s")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_cleanse_projection_counts_rejects(spark):
    from lodestone.functions.types import HeaderColumn
    from lodestone.operators.cleanse import cleanse_projection
    header = [HeaderColumn("n", "INTEGER"), HeaderColumn("d", "DATE"),
              HeaderColumn("a", "DECIMAL", "", "8", "2"), HeaderColumn("s", "VARCHAR")]
    raw = spark.createDataFrame([("12", "20240131", "5.5-", "x"),
                                 ("x1", "2024013", "abc", None),
                                 ("", None, "", " null ")], "n string, d string, a string, s string")
    rows = cleanse_projection(raw, header, with_rejects=True).collect()
    assert [r["_rejects"] for r in rows] == [[], ["n", "a"], []]
    assert rows[0]["a"] == Decimal("-5.50") and rows[1]["d"] == dt.datetime(2024, 1, 3)
    assert rows[2]["s"] == "" and rows[2]["n"] is None
