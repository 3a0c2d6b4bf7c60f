"""Scalar cleansing functions as native Spark ``Column`` expressions.

Every function here is built from built-in expressions only, so it stays in
whole-stage codegen and runs on the executors; nothing is a Python UDF.

Semantics (the raw layer is all text):

* ``convert_null``  NULL -> ''; trim; 'null' in any case or empty -> ''.
* ``convert_sign``  NULL -> ''; trim; a trailing '-' moves to the front.
* ``convert_date``  NULL -> ''; trim; 8 chars ``yyyyMMdd`` and 7 chars
  ``yyyyMMd`` become ``yyyy-MM-dd 00:00:00``; anything else passes through.
* ``decimal_chain`` sign fix, then text -> double -> decimal(17,2) -> target
  decimal, each step a ``try_cast`` so malformed text becomes NULL.

Trimming strips every character from U+0000 to U+0020 on both ends (not only
blanks), which is what the cleansing rules expect of "trim".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

# Fixed value: the characters removed by "trim", U+0000 through U+0020.
TRIM_CHARS = "".join(chr(c) for c in range(0x21))

# Fixed value: scale and precision of the intermediate decimal in the
# decimal cleansing chain.
CHAIN_DECIMAL = DecimalType(17, 2)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """Strip control characters and blanks (<= U+0020) from both ends."""
    return F.btrim(_col(c), F.lit(TRIM_CHARS))


def _trimmed(c: Column | str) -> Column:
    return java_trim(F.coalesce(_col(c), F.lit("")))


def convert_null(c: Column | str) -> Column:
    t = _trimmed(c)
    return F.when(F.lower(t) == F.lit("null"), F.lit("")).otherwise(t)


def convert_sign(c: Column | str) -> Column:
    t = _trimmed(c)
    moved = F.concat(F.lit("-"), t.substr(F.lit(1), F.length(t) - 1))
    return F.when(t.endswith("-"), moved).otherwise(t)


def convert_date(c: Column | str) -> Column:
    t = _trimmed(c)
    n = F.length(t)
    eight = F.concat(t.substr(1, 4), F.lit("-"), t.substr(5, 2), F.lit("-"),
                     t.substr(7, 2), F.lit(" 00:00:00"))
    seven = F.concat(t.substr(1, 4), F.lit("-"), t.substr(5, 2), F.lit("-0"),
                     t.substr(7, 1), F.lit(" 00:00:00"))
    return F.when(n == 8, eight).when(n == 7, seven).otherwise(t)


def decimal_chain(c: Column | str, target: DataType | None = None,
                  mode: str = "exact") -> Column:
    """Signed decimal text -> decimal.

    ``mode="exact"`` keeps the observable legacy result: through double and
    decimal(17,2) whatever the target precision. ``mode="direct"`` casts the
    sign-fixed text straight to the target decimal.
    """
    target = target or CHAIN_DECIMAL
    signed = convert_sign(c)
    if mode == "direct":
        return signed.try_cast(target)
    if mode != "exact":
        raise ValueError(f"unknown decimal mode {mode!r}")
    chained = signed.try_cast("double").try_cast(CHAIN_DECIMAL)
    return chained if target == CHAIN_DECIMAL else chained.try_cast(target)


def to_timestamp_text(c: Column | str) -> Column:
    """Cleansed date text -> timestamp without time zone (NULL if invalid)."""
    return convert_date(c).try_cast("timestamp_ntz")


# SQL bodies for the same three functions, so that SQL users can call
# ConvertNULL / ConvertSign / ConvertDate by name. The trim set is passed as
# a literal built from char() so the text stays printable.
_SQL_TRIM = "concat(" + ", ".join(f"char({i})" for i in range(0x21)) + ")"
_SQL_T = f"btrim(coalesce(s, ''), {_SQL_TRIM})"

SQL_FUNCTIONS = {
    "ConvertNULL": (
        f"CASE WHEN lower({_SQL_T}) = 'null' THEN '' ELSE {_SQL_T} END"
    ),
    "ConvertSign": (
        f"CASE WHEN endswith({_SQL_T}, '-') "
        f"THEN concat('-', substr({_SQL_T}, 1, length({_SQL_T}) - 1)) "
        f"ELSE {_SQL_T} END"
    ),
    "ConvertDate": (
        f"CASE length({_SQL_T}) "
        f"WHEN 8 THEN concat(substr({_SQL_T},1,4),'-',substr({_SQL_T},5,2),'-',"
        f"substr({_SQL_T},7,2),' 00:00:00') "
        f"WHEN 7 THEN concat(substr({_SQL_T},1,4),'-',substr({_SQL_T},5,2),'-0',"
        f"substr({_SQL_T},7,1),' 00:00:00') "
        f"ELSE {_SQL_T} END"
    ),
}


def register_sql_functions(spark) -> list[str]:
    """Register ConvertNULL / ConvertSign / ConvertDate as SQL functions.

    They are SQL-bodied temporary functions, inlined by the analyzer into
    ordinary expressions (no Python, no JVM UDF object)."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) "
            f"RETURNS STRING RETURN {body}")
    return list(SQL_FUNCTIONS)
