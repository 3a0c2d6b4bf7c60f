"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each over whole driver tables (or what Spark derives from them),
with the DuckDB SQL that must give the same rows.

Queries that exercise sinks write into a fresh folder under the session's
shared checkpoint folder and return what Spark reads back from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.cleansing import (convert_date, convert_null,
                                           convert_sign, decimal_chain)
from lodestone.functions.periods import period_frame, period_of
from lodestone.operators.cleanse import cleanse_projection
from lodestone.operators.merge import (latest_version, max_ts_per_key,
                                       merge_patch, union_base_incr)
from lodestone.plans import derived as D
from lodestone.plans import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- functions

@register("convert_null", O.with_ctes(O.RAW_ORDERS) +
          f"SELECT o_orderkey, {O.sql_convert_null('o_orderstatus')} AS o_orderstatus "
          "FROM raw_orders")
def q_convert_null(spark, sf):
    r = D.raw_orders(spark, sf)
    return r.select("o_orderkey", convert_null("o_orderstatus").alias("o_orderstatus"))


@register("convert_date", O.with_ctes(O.RAW_ORDERS) +
          f"SELECT o_orderkey, {O.sql_convert_date('o_orderdate')} AS date_text, "
          f"try_cast({O.sql_convert_date('o_orderdate')} AS TIMESTAMP) AS o_orderdate "
          "FROM raw_orders")
def q_convert_date(spark, sf):
    r = D.raw_orders(spark, sf)
    d = convert_date("o_orderdate")
    return r.select("o_orderkey", d.alias("date_text"),
                    d.try_cast("timestamp_ntz").alias("o_orderdate"))


@register("convert_sign", O.with_ctes(O.RAW_CUSTOMER) +
          f"SELECT c_custkey, c_acctbal AS raw_text, {O.sql_convert_sign('c_acctbal')} AS c_acctbal "
          "FROM raw_customer")
def q_convert_sign(spark, sf):
    r = D.raw_customer(spark, sf)
    return r.select("c_custkey", F.col("c_acctbal").alias("raw_text"),
                    convert_sign("c_acctbal").alias("c_acctbal"))


@register("decimal_chain", O.with_ctes(O.RAW_CUSTOMER, O.RAW_ORDERS) +
          f"SELECT 'C' AS src, c_custkey AS k, {O.sql_decimal_chain('c_acctbal', 12, 2)} AS amount "
          "FROM raw_customer UNION ALL "
          f"SELECT 'O', o_orderkey, {O.sql_decimal_chain('o_totalprice', 12, 2)} FROM raw_orders")
def q_decimal_chain(spark, sf):
    from pyspark.sql.types import DecimalType
    t = DecimalType(12, 2)
    c = D.raw_customer(spark, sf).select(F.lit("C").alias("src"), F.col("c_custkey").alias("k"),
                                         decimal_chain("c_acctbal", t).alias("amount"))
    o = D.raw_orders(spark, sf).select(F.lit("O").alias("src"), F.col("o_orderkey").alias("k"),
                                       decimal_chain("o_totalprice", t).alias("amount"))
    return c.unionByName(o)


@register("cleanse_projection", O.cleansed_orders_sql())
def q_cleanse_projection(spark, sf):
    return cleanse_projection(D.raw_orders(spark, sf), D.ORDERS_HEADER)


@register("cleanse_customer", O.cleansed_customer_sql())
def q_cleanse_customer(spark, sf):
    return cleanse_projection(D.raw_customer(spark, sf), D.CUSTOMER_HEADER)


# ------------------------------------------------------------------- merges

_BASE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
              "extract_ts"]
_COMP_COLS = _BASE_COLS
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_KEYS = ["l_orderkey", "l_linenumber"]


@register("merge_patch", O.with_ctes(O.BASE, O.DELTA) +
          O.merge_sql("base", "delta", ["o_orderkey"], _BASE_COLS))
def q_merge_patch(spark, sf):
    return merge_patch(D.base(spark, sf), D.delta(spark, sf), ["o_orderkey"])


@register("merge_patch_shuffle", O.with_ctes(O.BASE, O.DELTA) +
          O.merge_sql("base", "delta", ["o_orderkey"], _BASE_COLS))
def q_merge_patch_shuffle(spark, sf):
    return merge_patch(D.base(spark, sf), D.delta(spark, sf), ["o_orderkey"],
                       strategy="shuffle")


@register("merge_patch_composite", O.with_ctes(O.COMP_BASE, O.COMP_DELTA) +
          O.merge_sql("comp_base", "comp_delta", ["o_custkey", "o_orderkey"], _COMP_COLS))
def q_merge_patch_composite(spark, sf):
    return merge_patch(D.comp_base(spark, sf), D.comp_delta(spark, sf),
                       "o_custkey o_orderkey")


_NULLK_BASE = ("nk_base AS (SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END "
               "AS o_orderkey, * EXCLUDE (o_orderkey) FROM base)")
_NULLK_DELTA = ("nk_delta AS (SELECT CASE WHEN o_orderkey % 70 = 0 THEN NULL ELSE o_orderkey END "
                "AS o_orderkey, * EXCLUDE (o_orderkey) FROM delta)")


@register("merge_null_keys", O.with_ctes(O.BASE, O.DELTA, _NULLK_BASE, _NULLK_DELTA) +
          O.merge_sql("nk_base", "nk_delta", ["o_orderkey"], _BASE_COLS))
def q_merge_null_keys(spark, sf):
    b = D.with_null_keys(D.base(spark, sf), "o_orderkey", 97)
    d = D.with_null_keys(D.delta(spark, sf), "o_orderkey", 70)
    return merge_patch(b, d, ["o_orderkey"])


@register("merge_dup_keys", O.with_ctes(
    O.LINEITEM_BASE, O.LINEITEM_ROWS, O.folded_sql("li_delta", "li_rows", _LI_KEYS, _LI_COLS, "l_shipdate"))
    + O.merge_sql("li_base", "li_delta", _LI_KEYS, _LI_COLS))
def q_merge_dup_keys(spark, sf):
    return merge_patch(D.lineitem_base(spark, sf), D.lineitem_delta(spark, sf), _LI_KEYS, dedupe_by="l_shipdate")


@register("latest_version", O.with_ctes(O.BASE, O.DELTA) +
          O.latest_sql("base", "delta", ["o_orderkey"]))
def q_latest_version(spark, sf):
    return latest_version(D.base(spark, sf), D.delta(spark, sf), ["o_orderkey"])


@register("latest_version_composite", O.with_ctes(O.COMP_BASE, O.COMP_DELTA) +
          O.latest_sql("comp_base", "comp_delta", ["o_custkey", "o_orderkey"]))
def q_latest_version_composite(spark, sf):
    return latest_version(D.comp_base(spark, sf), D.comp_delta(spark, sf),
                          ["o_custkey", "o_orderkey"])


@register("latest_version_window", O.with_ctes(O.BASE, O.DELTA) +
          O.latest_sql("base", "delta", ["o_orderkey"]))
def q_latest_version_window(spark, sf):
    return latest_version(D.base(spark, sf), D.delta(spark, sf), ["o_orderkey"],
                          method="window")


@register("max_ts_per_key", O.with_ctes(O.BASE, O.DELTA) +
          "SELECT o_orderkey, max(extract_ts) AS extract_ts FROM "
          "(SELECT * FROM base UNION ALL SELECT * FROM delta) GROUP BY o_orderkey")
def q_max_ts_per_key(spark, sf):
    u = union_base_incr(D.base(spark, sf), D.delta(spark, sf))
    return max_ts_per_key(u, ["o_orderkey"])


@register("union_base_incr", O.with_ctes(O.BASE, O.DELTA) +
          "SELECT * FROM base UNION ALL SELECT * FROM delta")
def q_union_base_incr(spark, sf):
    return union_base_incr(D.base(spark, sf), D.delta(spark, sf))


# ------------------------------------------------------------ aggregations

@register("watermark", "SELECT max(ts) AS watermark, count(*) AS target_rows FROM events")
def q_watermark(spark, sf):
    from lodestone.operators.aggregates import watermark_frame
    return watermark_frame(D.table(spark, sf, "events"), "ts")


# ------------------------------------------------------------------ periods

def _period_counts(spark, sf, spec, kind):
    o = D.table(spark, sf, "orders")
    counts = (o.groupBy(period_of(kind, "o_orderdate").alias(kind))
              .agg(F.count(F.lit(1)).alias("n_orders"),
                   F.sum("o_totalprice").alias("total_price")))
    periods = period_frame(spark, spec)
    return (periods.join(counts, kind, "left")
            .select(kind, F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
                    "total_price"))


def _period_sql(values_sql: str, kind: str, label_sql: str) -> str:
    return (f"WITH p AS ({values_sql}), c AS (SELECT {label_sql} AS {kind}, count(*) AS n_orders, "
            f"sum(o_totalprice) AS total_price FROM orders GROUP BY 1) "
            f"SELECT p.{kind}, coalesce(c.n_orders, 0) AS n_orders, c.total_price "
            f"FROM p LEFT JOIN c ON p.{kind} = c.{kind}")


@register("expand_months", _period_sql(
    "SELECT CAST(v AS VARCHAR) AS month FROM range(199511, 199603) t(v) WHERE v % 100 BETWEEN 1 AND 12",
    "month", "strftime(o_orderdate, '%Y%m')"))
def q_expand_months(spark, sf):
    return _period_counts(spark, sf, "199511-199602", "month")


@register("expand_quarters", _period_sql(
    "SELECT CAST(v // 100 AS VARCHAR) || 'Q' || CAST(v % 100 AS VARCHAR) AS quarter "
    "FROM range(199503, 199703) t(v) WHERE v % 100 BETWEEN 1 AND 4",
    "quarter", "CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR)"))
def q_expand_quarters(spark, sf):
    return _period_counts(spark, sf, "1995Q3-1997Q2", "quarter")


@register("expand_years", _period_sql(
    "SELECT 'FY' || CAST(v AS VARCHAR) AS year FROM range(1994, 2003) t(v)",
    "year", "'FY' || CAST(year(o_orderdate) AS VARCHAR)"))
def q_expand_years(spark, sf):
    return _period_counts(spark, sf, "FY1994-FY2002", "year")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # sinks and workflows register themselves on import
    from lodestone.plans import queries_io  # noqa: F401
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from lodestone.plans import queries_io  # noqa: F401
    return dict(ORACLE)


__all__ = ["all_queries", "all_oracles", "register"]
