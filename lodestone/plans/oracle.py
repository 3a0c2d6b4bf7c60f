"""DuckDB SQL text for the correctness oracle of each registered query.

The derived relations of ``derived.py`` are restated here as CTEs over the
same parquet views. Nothing of the code under test decides what is expected:
the typed columns of each header are written out below.
"""

from __future__ import annotations

from lodestone.plans.derived import BASE_TS, DELTA_TS, NEW_KEY_OFFSET

#: Expected staging columns (fixed values): name, kind of cleansing, SQL type.
ORDERS_TYPED = [
    ("o_orderkey", "text", "DOUBLE"), ("o_custkey", "text", "DOUBLE"), ("o_orderstatus", "text", "VARCHAR"),
    ("o_totalprice", "decimal", "DECIMAL(15,2)"), ("o_orderdate", "date", "TIMESTAMP"),
    ("o_orderpriority", "text", "VARCHAR"),
]
CUSTOMER_TYPED = [
    ("c_custkey", "text", "DOUBLE"), ("c_name", "text", "VARCHAR"), ("c_nationkey", "text", "INTEGER"),
    ("c_acctbal", "decimal", "DECIMAL(12,2)"), ("c_mktsegment", "text", "VARCHAR"),
]

WS = r"'^[\x00-\x20]+|[\x00-\x20]+$'"


def sql_trim(e: str) -> str:
    return f"regexp_replace(coalesce({e}, ''), {WS}, '', 'g')"


def sql_convert_null(e: str) -> str:
    t = sql_trim(e)
    return f"(CASE WHEN lower({t}) = 'null' THEN '' ELSE {t} END)"


def sql_convert_sign(e: str) -> str:
    t = sql_trim(e)
    return (f"(CASE WHEN {t} LIKE '%-' THEN '-' || substr({t}, 1, length({t}) - 1) "
            f"ELSE {t} END)")


def sql_convert_date(e: str) -> str:
    t = sql_trim(e)
    return (f"(CASE length({t}) "
            f"WHEN 8 THEN substr({t},1,4) || '-' || substr({t},5,2) || '-' || "
            f"substr({t},7,2) || ' 00:00:00' "
            f"WHEN 7 THEN substr({t},1,4) || '-' || substr({t},5,2) || '-0' || "
            f"substr({t},7,1) || ' 00:00:00' "
            f"ELSE {t} END)")


def sql_decimal_chain(e: str, p: int = 17, s: int = 2) -> str:
    inner = f"try_cast(try_cast({sql_convert_sign(e)} AS DOUBLE) AS DECIMAL(17,2))"
    return inner if (p, s) == (17, 2) else f"try_cast({inner} AS DECIMAL({p},{s}))"


def sql_cleanse_column(name: str, kind: str, sql_type: str, of: str = "") -> str:
    src = of + name
    if kind == "date":
        e = f"try_cast({sql_convert_date(src)} AS {sql_type})"
    elif kind == "decimal":
        e = f"try_cast(try_cast(try_cast({sql_convert_sign(src)} AS DOUBLE) AS DECIMAL(17,2)) AS {sql_type})"
    elif sql_type == "VARCHAR":
        e = sql_convert_null(src)
    else:
        e = f"try_cast({sql_convert_null(src)} AS {sql_type})"
    return f"{e} AS {name}"


def sql_cleanse_select(columns: list[tuple[str, str, str]], of: str = "") -> str:
    return "SELECT\n  " + ",\n  ".join(sql_cleanse_column(*c, of) for c in columns)


def sql_cents_text(x: str, trailing_sign: bool = False) -> str:
    cents = f"CAST(round(abs({x}) * 100) AS BIGINT)"
    body = (f"(CAST({cents} // 100 AS VARCHAR) || '.' || "
            f"lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'))")
    sign = f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END)"
    return f"({body} || {sign})" if trailing_sign else f"({sign} || {body})"


RAW_ORDERS = f"""raw_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
         CAST(o_custkey AS VARCHAR) AS o_custkey,
         CASE o_orderkey % 8 WHEN 0 THEN 'NULL'
              WHEN 1 THEN ' ' || o_orderstatus || ' '
              WHEN 2 THEN NULL WHEN 3 THEN ' '
              WHEN 4 THEN chr(9) || 'null' || chr(9)
              ELSE o_orderstatus END AS o_orderstatus,
         {sql_cents_text('o_totalprice')} AS o_totalprice,
         CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '00000000'
              WHEN 2 THEN ''
              WHEN 3 THEN strftime(o_orderdate, '%Y%m') || CAST(day(o_orderdate) % 10 AS VARCHAR)
              ELSE strftime(o_orderdate, '%Y%m%d') END AS o_orderdate,
         o_orderpriority
  FROM orders)"""

RAW_CUSTOMER = f"""raw_customer AS (
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
         CAST(c_nationkey AS VARCHAR) AS c_nationkey,
         {sql_cents_text('c_acctbal', True)} AS c_acctbal,
         c_mktsegment
  FROM customer)"""

BASE = f"""base AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         TIMESTAMP '{BASE_TS}' AS extract_ts FROM orders)"""

_PATCHED = """CASE WHEN o_orderkey % 20 = 0 THEN '' ELSE 'U' END AS o_orderstatus,
         CASE WHEN o_orderkey % 30 = 0 THEN NULL ELSE o_totalprice + 1 END AS o_totalprice,
         CASE WHEN o_orderkey % 70 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
         CASE WHEN o_orderkey % 110 = 0 THEN NULL ELSE '0-PATCH' END AS o_orderpriority"""

DELTA = f"""delta AS (
  SELECT CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey + {NEW_KEY_OFFSET} ELSE o_orderkey END AS o_orderkey,
         o_custkey, {_PATCHED},
         CASE WHEN o_orderkey % 40 = 0 THEN TIMESTAMP '{BASE_TS}' ELSE TIMESTAMP '{DELTA_TS}' END AS extract_ts
  FROM orders WHERE o_orderkey % 10 = 0)"""

COMP_BASE = f"""comp_base AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         TIMESTAMP '{BASE_TS}' AS extract_ts FROM orders)"""

COMP_DELTA = f"""comp_delta AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 21 = 0 THEN o_custkey + {NEW_KEY_OFFSET} ELSE o_custkey END AS o_custkey,
         {_PATCHED},
         CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '{BASE_TS}' ELSE TIMESTAMP '{DELTA_TS}' END AS extract_ts
  FROM orders WHERE o_orderkey % 7 = 0)"""

LINEITEM_BASE = "li_base AS (SELECT * FROM lineitem)"

LINEITEM_ROWS = """li_rows AS (
  SELECT * REPLACE (CASE WHEN l_partkey % 2 = 0 THEN l_quantity + 1 END AS l_quantity,
                    CASE WHEN l_partkey % 2 <> 0 THEN l_discount END AS l_discount,
                    CASE WHEN l_partkey % 2 <> 0 THEN l_suppkey END AS l_suppkey,
                    'U' AS l_returnflag)
  FROM lineitem WHERE l_orderkey % 10 = 3)"""


def folded_sql(name: str, rows: str, keys: list[str], cols: list[str], order: str) -> str:
    """One patch per key: each column's last non-NULL value by ``order``, ties
    to the greatest value."""
    last = ", ".join(
        f"(max({{'o': {order}, 'v': {c}}}) FILTER (WHERE {c} IS NOT NULL)).v AS {c}" for c in cols if c not in keys)
    return f"{name} AS (SELECT {', '.join(keys)}, {last} FROM {rows} GROUP BY {', '.join(keys)})"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def cleansed_orders_sql() -> str:
    return with_ctes(RAW_ORDERS) + sql_cleanse_select(ORDERS_TYPED) + "\nFROM raw_orders"


def cleansed_customer_sql() -> str:
    return with_ctes(RAW_CUSTOMER) + sql_cleanse_select(CUSTOMER_TYPED) + "\nFROM raw_customer"


def merge_sql(base: str, delta: str, keys: list[str], cols: list[str]) -> str:
    on = " AND ".join(f"i.{k} = o.{k}" for k in keys)
    sel = ", ".join(f"coalesce(i.{c}, o.{c}) AS {c}" for c in cols)
    return f"SELECT {sel} FROM {delta} i FULL OUTER JOIN {base} o ON {on}"


def latest_sql(base: str, delta: str, keys: list[str], ts: str = "extract_ts") -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"t1.{c} = s.{c}" for c in keys)
    return (f"SELECT t1.* FROM (SELECT * FROM {base} UNION ALL SELECT * FROM {delta}) t1 "
            f"JOIN (SELECT {k}, max({ts}) AS {ts} FROM "
            f"(SELECT {k}, {ts} FROM {base} UNION ALL SELECT {k}, {ts} FROM {delta}) t2 "
            f"GROUP BY {k}) s ON {on} AND t1.{ts} = s.{ts}")
