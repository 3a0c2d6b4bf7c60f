"""Relations derived by Spark from the driver tables, used by the registered
queries, the tests and the benchmark.

The source tables hold no NULLs, no sign-suffixed numbers and no compact
dates, so these derivations put such cases into whole tables (every row of
``orders`` / ``customer`` / ``lineitem`` / ``events`` goes through them):

* ``raw_orders``   all-string orders with NULL / 'null' / blank / tab-padded
                   statuses and 8- and 7-character compact dates;
* ``raw_customer`` all-string customers, balances written with a trailing sign;
* ``base`` / ``delta`` a keyed table and an increment that updates, inserts,
                   blanks a string, nulls a number and ties a timestamp.

The key arithmetic below only decides *what an increment contains*; every
query still reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.types import HeaderColumn

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events")

# The headers of the derived raw tables (source type names as a
# relational dictionary would report them).
ORDERS_HEADER = [
    HeaderColumn("o_orderkey", "NUMBER", "Order key", "19", "0"),
    HeaderColumn("o_custkey", "NUMBER", "Customer key", "19", "0"),
    HeaderColumn("o_orderstatus", "VARCHAR2", "Order status", "1", None),
    HeaderColumn("o_totalprice", "DECIMAL", "Total price, with tax", "15", "2"),
    HeaderColumn("o_orderdate", "DATE", "Order date", None, None),
    HeaderColumn("o_orderpriority", "CHAR", "Priority", "15", None),
]
CUSTOMER_HEADER = [
    HeaderColumn("c_custkey", "NUMBER", "Customer key", "19", "0"),
    HeaderColumn("c_name", "VARCHAR", "Name; as registered", "25", None),
    HeaderColumn("c_nationkey", "INTEGER", "Nation", "10", "0"),
    HeaderColumn("c_acctbal", "DECIMAL", "Account balance", "12", "2"),
    HeaderColumn("c_mktsegment", "CHAR", "Segment", "10", None),
]
BASE_TS = "2020-01-01 00:00:00"
DELTA_TS = "2020-02-01 00:00:00"
NEW_KEY_OFFSET = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ts_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def cents_text(x: Column, trailing_sign: bool = False) -> Column:
    """Fixed two-decimal text of a double, built from integer cents."""
    cents = F.round(F.abs(x) * 100).cast("long")
    body = F.concat((cents / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(body, sign) if trailing_sign else F.concat(sign, body)


def raw_orders(spark: SparkSession, sf_dir: str, with_month: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k8, k11 = F.col("o_orderkey") % 8, F.col("o_orderkey") % 11
    st = F.col("o_orderstatus")
    status = (F.when(k8 == 0, F.lit("NULL"))
              .when(k8 == 1, F.concat(F.lit(" "), st, F.lit(" ")))
              .when(k8 == 2, F.lit(None).cast("string"))
              .when(k8 == 3, F.lit(" "))
              .when(k8 == 4, F.lit("\tnull\t"))
              .otherwise(st))
    d = F.col("o_orderdate")
    date = (F.when(k11 == 0, F.lit(None).cast("string"))
            .when(k11 == 1, F.lit("00000000"))
            .when(k11 == 2, F.lit(""))
            .when(k11 == 3, F.concat(F.date_format(d, "yyyyMM"),
                                     (F.dayofmonth(d) % 10).cast("string")))
            .otherwise(F.date_format(d, "yyyyMMdd")))
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        status.alias("o_orderstatus"),
        cents_text(F.col("o_totalprice")).alias("o_totalprice"),
        date.alias("o_orderdate"),
        F.col("o_orderpriority"),
        *([F.date_format(d, "yyyyMM").alias("month")] if with_month else []),
    )


def raw_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.col("c_name"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        cents_text(F.col("c_acctbal"), trailing_sign=True).alias("c_acctbal"),
        F.col("c_mktsegment"),
    )


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of orders, as of the first extract."""
    return table(spark, sf_dir, "orders").withColumn("extract_ts", ts_literal(BASE_TS))


def _patched(k: Column) -> list[Column]:
    """Columns of an increment row: untouched ones are NULL on some rows."""
    return [
        F.when(k % 20 == 0, F.lit("")).otherwise(F.lit("U")).alias("o_orderstatus"),
        F.when(k % 30 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.when(k % 70 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        F.when(k % 110 == 0, F.lit(None).cast("string")).otherwise(F.lit("0-PATCH")).alias("o_orderpriority"),
    ]


def delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 10 == 0)
    k = F.col("o_orderkey")
    return o.select(
        F.when(k % 50 == 0, k + NEW_KEY_OFFSET).otherwise(k).alias("o_orderkey"), "o_custkey", *_patched(k),
        F.when(k % 40 == 0, ts_literal(BASE_TS)).otherwise(ts_literal(DELTA_TS)).alias("extract_ts"))


def with_null_keys(df: DataFrame, key: str, every: int) -> DataFrame:
    """Same rows with the key blanked out on every ``every``-th key value."""
    k = F.col(key)
    return df.withColumn(key, F.when(k % every == 0, F.lit(None).cast(df.schema[key].dataType))
                         .otherwise(k))


def comp_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders keyed by (o_custkey, o_orderkey)."""
    return base(spark, sf_dir)


def comp_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 7 == 0)
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(k % 21 == 0, F.col("o_custkey") + NEW_KEY_OFFSET)
        .otherwise(F.col("o_custkey")).alias("o_custkey"), *_patched(k),
        F.when(k % 4 == 0, ts_literal(BASE_TS)).otherwise(ts_literal(DELTA_TS))
        .alias("extract_ts"))


def lineitem_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem keyed by (l_orderkey, l_linenumber): keys repeat."""
    return table(spark, sf_dir, "lineitem")


def lineitem_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of the orders ending in 3, several for many keys, each a patch
    of some columns: quantities only of even part keys, discounts only of odd."""
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_orderkey") % 10 == 3)
    even = F.col("l_partkey") % 2 == 0
    return li.select(*[
        F.when(even, F.col(c) + 1).alias(c) if c == "l_quantity" else
        F.when(~even, F.col(c)).alias(c) if c in ("l_discount", "l_suppkey") else
        F.lit("U").alias(c) if c == "l_returnflag" else F.col(c) for c in li.columns])


def tricky_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text holding the raw dialect's special characters: the
    delimiter, the escape (also trailing and doubled), line breaks, blanks."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    return o.select(
        k.cast("string").alias("k"),
        F.concat(pr, F.lit("|"), st).alias("pipe"),
        F.concat(F.lit("x\\"), st, F.lit("\\")).alias("slash"),
        F.when(k % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit("l1\n"), pr, F.lit("\r\nl3"))).alias("lines"),
        F.concat(F.lit("\\|"), st, F.lit("\\\\")).alias("mixed"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit(" \t ")).alias("blank"),
    )
