import pytest
from pyspark.sql import types as T

from lodestone.functions.periods import (classify_period, expand_period, period_frame,
                                         valid_fiscal_years)
from lodestone.functions.types import (TYPE_MAP, HeaderColumn, UnmappedTypeError,
                                       cleanse_kind, map_type, raw_schema,
                                       staging_schema, staging_type)
from lodestone.sources.header import header_csv, read_header


def test_type_map_has_26_names():
    assert len(TYPE_MAP) == 26
    assert map_type(" varchar2 ") == "string"
    with pytest.raises(UnmappedTypeError):
        map_type("BIGINT")


@pytest.mark.parametrize("sql_type,length,scale,expected", [
    ("NUMBER", None, None, T.DoubleType()),
    ("DATE", None, None, T.TimestampNTZType()),
    ("DATS", None, None, T.TimestampNTZType()),
    ("TIMESTAMP", None, None, T.TimestampNTZType()),
    ("DATETIME", None, None, T.TimestampNTZType()),
    ("NUMERIC", "12", "3", T.DecimalType(12, 3)),
    ("DECIMAL", None, None, T.DecimalType(10, 0)),
    ("numeric", "x", "", T.DecimalType(10, 0)),
    ("CURR", "5", "2", T.DecimalType(10, 0)),
    ("INT4", None, None, T.IntegerType()),
    ("NUMC", None, None, T.IntegerType()),
    ("CUKY", None, None, T.StringType()),
    (" nvarchar ", None, None, T.StringType()),
])
def test_staging_types(sql_type, length, scale, expected):
    assert staging_type(HeaderColumn("c", sql_type, "", length, scale)) == expected


def test_unmapped_type_names_the_column():
    with pytest.raises(UnmappedTypeError, match="amount.*BIGINT"):
        staging_type(HeaderColumn("amount", "BIGINT"))


def test_cleanse_kinds():
    assert cleanse_kind(HeaderColumn("a", "DATE")) == "date"
    assert cleanse_kind(HeaderColumn("a", "DATETIME")) == "date"
    assert cleanse_kind(HeaderColumn("a", "QUAN")) == "decimal"
    assert cleanse_kind(HeaderColumn("a", "NUMBER")) == "text"


def test_schemas_keep_order_comments_and_partition():
    h = [HeaderColumn("b", "CHAR", "x; 'y', z"), HeaderColumn("a", "INTEGER")]
    s = staging_schema(h, "month")
    assert [f.name for f in s.fields] == ["b", "a", "month"]
    assert s["b"].metadata["comment"] == "x; 'y', z"
    r = raw_schema(h, "month")
    assert [f.dataType for f in r.fields] == [T.StringType()] * 3


def test_header_file_round_trip(spark, tmp_root):
    header = [HeaderColumn(n, t, "") for n, t in
              [(f"c{i}", k) for i, k in enumerate(sorted(TYPE_MAP))]]
    header += [HeaderColumn("lower", "varchar", "a comma, here"),
               HeaderColumn("blank", " INTEGER ", ""),
               HeaderColumn("quote", "CHAR", 'he said "x"; ok'),
               HeaderColumn("num", "NUMERIC", "", None, None)]
    path = tmp_root.replace("file:", "") + "/h.csv"
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header_csv(header))
    back = read_header(spark, path)
    assert [(c.name, c.sql_type, c.comment) for c in back] == \
        [(c.name, c.sql_type, c.comment) for c in header]
    assert staging_type(back[-1]) == T.DecimalType(10, 0)


def test_classify_period():
    assert classify_period("none").kind == "none"
    assert classify_period("FY2014").kind == "year"
    assert classify_period("fy2014-fy2016").column == "year"
    assert classify_period("2014Q1").kind == "quarter"
    assert classify_period("201401").kind == "month"
    assert classify_period("month").symbolic
    for bad in ("201413", "abc", "2014Q5"):
        with pytest.raises(ValueError, match="not a period spec"):
            classify_period(bad)
    with pytest.raises(ValueError):
        classify_period("199501", strict_years=True)
    with pytest.raises(ValueError):
        classify_period("FY2020", strict_years=True)


def test_expand_periods():
    assert expand_period("201411-201502") == ["201411", "201412", "201501", "201502"]
    assert expand_period("201502-201411") == ["201411", "201412", "201501", "201502"]
    assert expand_period("201401") == ["201401"]
    assert expand_period("2014Q3-2015Q2") == ["2014Q3", "2014Q4", "2015Q1", "2015Q2"]
    assert expand_period("FY2014-FY2016") == ["FY2014", "FY2015", "FY2016"]


def test_valid_fiscal_years():
    v = valid_fiscal_years()
    assert len(v) == 44
    assert v[:2] == ["FY2009", "FY2010"] and "FY2009-FY2009" in v and "FY2016-FY2009" not in v


@pytest.mark.parametrize("spec", ["201411-201502", "2014Q3-2015Q2", "FY2014-FY2016", "199912-200001"])
def test_period_frame_equals_expansion(spark, spec):
    df = period_frame(spark, spec)
    assert sorted(r[0] for r in df.collect()) == expand_period(spec)
