"""The audit trail: one appended record per load execution, and the
reconciliation status it carries."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of an audit record.
AUDIT_SCHEMA = T.StructType([
    T.StructField("exec_id", T.LongType()),
    T.StructField("extract_id", T.IntegerType()),
    T.StructField("stg_tab_nm", T.StringType()),
    T.StructField("source_row", T.LongType()),
    T.StructField("refresh_typ", T.StringType()),
    T.StructField("tgt_rows", T.LongType()),
    T.StructField("incr_col_val", T.StringType()),
    T.StructField("exec_strt_ts", T.TimestampNTZType()),
    T.StructField("exec_end_ts", T.TimestampNTZType()),
    T.StructField("exec_lapse_s", T.IntegerType()),
    T.StructField("fail_step", T.IntegerType()),
    T.StructField("status", T.StringType()),
    # beyond the fixed record: what a count alone would hide
    T.StructField("excluded_rows", T.LongType()),
    T.StructField("rejected_values", T.LongType()),
    T.StructField("malformed_lines", T.LongType()),
    T.StructField("notes", T.StringType()),
])


def exec_id_of(batch_id: str) -> int:
    """Numeric execution id: the batch id itself when it is a timestamp-like
    number, else a stable checksum of it."""
    return int(batch_id) if str(batch_id).isdigit() else zlib.crc32(str(batch_id).encode())


def audit_frame(spark: SparkSession, spec, result, batch_id: str) -> DataFrame:
    row = (exec_id_of(batch_id), spec.extract_id, f"{spec.interface}.{spec.table}".upper(),
           result.source_rows, spec.refresh.upper(), result.target_rows, result.incr_col_val,
           result.started, result.ended, result.elapsed_s, result.fail_step, result.status,
           result.excluded_rows, result.rejected_values, result.malformed_lines,
           result.notes)
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def append_audit(spark: SparkSession, path: str, spec, result, batch_id: str) -> None:
    audit_frame(spark, spec, result, batch_id).coalesce(1).write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def audit_summary(audit: DataFrame) -> DataFrame:
    """Per table: runs, successes, rows per second of the successful runs and
    the last status (a grouped aggregate over the audit trail)."""
    last = F.max_by(F.col("status"), F.col("exec_strt_ts"))
    ok = F.col("status") == "S"
    return (audit.groupBy("stg_tab_nm")
            .agg(F.count(F.lit(1)).alias("runs"),
                 F.count_if(ok).alias("successes"),
                 (F.sum(F.when(ok, F.col("tgt_rows"))) /
                  F.sum(F.when(ok, F.col("exec_lapse_s")))).alias("rows_per_s"),
                 last.alias("last_status")))
