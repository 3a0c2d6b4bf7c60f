"""Aggregations of the load cycle: high-water mark, counts, table profile.

All are single-pass aggregates with partial (map-side) aggregation; the only
values brought to the driver are scalars (a watermark, two counts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def watermark_frame(target: DataFrame, col: str) -> DataFrame:
    """``max(col)`` of the target with its row count; an empty target gives
    a NULL watermark."""
    return target.agg(F.max(col).alias("watermark"),
                      F.count(F.lit(1)).alias("target_rows"))


def watermark_literal(target: DataFrame, col: str) -> tuple[Column, str] | None:
    """The high-water mark as a literal of the column's own type, and as text;
    None for an empty target. It never becomes a Python date, whose zone is the
    process's: instants travel as microseconds, other types as text that Spark
    casts back."""
    kind = target.schema[col].dataType
    row = target.agg(*exact_top(F.max(col), kind)).first()
    if row["exact"] is None:
        return None
    return mark_literal(row["exact"], kind), row["text"]


def exact_top(top: Column, kind: T.DataType) -> tuple[Column, Column]:
    """A greatest value as ``exact`` (text; microseconds of an instant) and ``text``."""
    exact = F.unix_micros(top) if isinstance(kind, T.TimestampType) else top
    return exact.cast("string").alias("exact"), top.cast("string").alias("text")


def mark_literal(exact: str, kind: T.DataType) -> Column:
    return F.timestamp_micros(F.lit(int(exact))) if isinstance(kind, T.TimestampType) else F.lit(exact).cast(kind)


#: Types whose greatest value Parquet's footers hold exactly.
FOOTER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def footer_max(spark, path: str, schema: T.StructType, col: str) -> DataFrame:
    """The greatest value of a column of a Parquet table from the files' footers:
    the aggregate is pushed into the scan, which reads no column data. (Its
    settings are those of a session of its own.)"""
    if not isinstance(schema[col].dataType, FOOTER_TYPES):
        raise TypeError(f"footers hold no exact greatest {schema[col].dataType.simpleString()}")
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(schema).parquet(path).agg(F.max(col).alias(col))


def count_rows(df: DataFrame) -> int:
    return df.count()


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs next
    (the write), so source rows are counted without a second scan."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def observed_value(obs: Observation, key: str = "rows"):
    """The observed metric, or None when the plan never reported it (Catalyst
    can fold an always-empty source into an empty relation, dropping the
    observation); callers then count what was written instead."""
    try:
        return obs.get.get(key)
    except Exception:
        return None


def reconcile_frame(spark, source_rows: int, target_rows: int,
                    expected_rows: int | None = None) -> DataFrame:
    """One row ``(source_rows, target_rows, status)``: S when the target holds
    exactly the expected rows (by default: the source rows), else F."""
    expected = source_rows if expected_rows is None else expected_rows
    status = "S" if target_rows == expected else "F"
    return spark.createDataFrame(
        [(int(source_rows), int(target_rows), status)],
        "source_rows long, target_rows long, status string")


def table_stats(df: DataFrame, partition_col: str | None = None,
                columns: list[str] | None = None) -> DataFrame:
    """Row count and, per column, NULL count, min and max — per partition
    when a partition column is given. One aggregate, partial on the map side."""
    columns = columns or [c for c in df.columns if c != partition_col]
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for c in columns:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
                 F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    if partition_col:
        return df.groupBy(partition_col).agg(*aggs)
    return df.agg(*aggs)


def analyze_table(spark, table: str, partition: str | None = None,
                  columns: bool = False) -> None:
    """Catalog statistics for the optimizer (sizes, row counts)."""
    part = f" PARTITION ({partition})" if partition else ""
    cols = " FOR ALL COLUMNS" if columns and not partition else ""
    spark.sql(f"ANALYZE TABLE {table}{part} COMPUTE STATISTICS{cols}")
