"""Header-driven cleansing projection: all-string raw -> typed staging.

One expression per header column, in header order, chosen by the column's
source type. The result is a single ``select`` (a narrow, codegen'd
projection: no shuffle, no Python), so it fuses with the scan before it and
the write after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.cleansing import (convert_date, convert_null,
                                           decimal_chain)
from lodestone.functions.types import (DATE_KIND, DECIMAL_KIND, HeaderColumn,
                                       cleanse_kind, staging_type)


def cleanse_column(col: HeaderColumn, source: Column | None = None,
                   decimal_mode: str = "exact") -> Column:
    name = col.name.strip()
    src = F.col(name) if source is None else source
    target = staging_type(col)
    kind = cleanse_kind(col)
    if kind == DATE_KIND:
        expr = convert_date(src).try_cast(target)
    elif kind == DECIMAL_KIND:
        expr = decimal_chain(src, target, decimal_mode)
    elif isinstance(target, T.StringType):
        expr = convert_null(src)
    else:
        expr = convert_null(src).try_cast(target)
    return expr.alias(name, metadata={"comment": col.comment or ""})


def cleanse_projection(raw: DataFrame, header: list[HeaderColumn],
                       partition_col: str | None = None,
                       decimal_mode: str = "exact",
                       with_rejects: bool = False,
                       rejected_col: str | None = None) -> DataFrame:
    """Typed staging rows from raw rows.

    ``partition_col`` (symbolic period partitions) is cleansed as text and
    put last. ``with_rejects`` adds ``_rejects``: the names of columns whose
    non-empty text did not convert, so malformed input is counted instead of
    silently becoming NULL; ``rejected_col`` adds their number instead, which
    stays inside whole-stage code."""
    exprs = [cleanse_column(c, decimal_mode=decimal_mode) for c in header]
    lost = [((convert_null(F.col(c.name.strip())) != F.lit("")) & e.isNull()).cast("int")
            for c, e in zip(header, exprs) if not isinstance(staging_type(c), T.StringType)]
    if partition_col:
        exprs.append(convert_null(F.col(partition_col)).alias(partition_col))
    if with_rejects:
        failed = []
        for c, e in zip(header, exprs):
            if isinstance(staging_type(c), T.StringType):
                continue
            text = convert_null(F.col(c.name.strip()))
            failed.append(F.when((text != F.lit("")) & e.isNull(),
                                 F.lit(c.name.strip())))
        rejects = (F.filter(F.array(*failed), lambda x: x.isNotNull())
                   if failed else F.array().cast("array<string>"))
        exprs.append(rejects.alias("_rejects"))
    if rejected_col:
        exprs.append(sum(lost, F.lit(0)).alias(rejected_col))
    return raw.select(*exprs)
