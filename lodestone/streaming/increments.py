"""Repeated increments as one Structured Streaming job.

New raw batches (``batch_id=<id>`` directories of raw text) are picked up by
a file stream. Each micro-batch is parsed and cleansed with the header once, and
written as typed rows; folded to one patch per key (rows of a later batch id
come after those of an earlier one), it is then patch-merged into the typed
target, which keeps its partitioning. ``strategy="files"`` rewrites only the
files that hold a key of the micro-batch, ``keys_move=False`` only the
partitions that it touches; else the merge writes a new version and swaps it in.
All three give the same table when a micro-batch is retried after a failure
(at-least-once delivery). Progress is kept in the stream checkpoint, which must
live in the shared folder (``spark.checkpoint.dir`` by default).

Lines with a wrong number of fields are counted while the micro-batch is written;
if there are any, the stream stops before the target is touched, and goes on
from the same micro-batch when it is started again. Values that do not convert
are counted. The target must have grown by the inserted rows. With ``audit``
each micro-batch appends a record, those that fail included.

``trigger(availableNow=True)`` processes what has landed and stops, which is
how a scheduled incremental load runs; a processing-time trigger keeps it
running.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.types import HeaderColumn, staging_schema
from lodestone.operators.aggregates import observed_value
from lodestone.operators.cleanse import cleanse_projection
from lodestone.operators.merge import fold_increment
from lodestone.operators.sinks import BATCH_COL, finish_change, recover, swap_in, write_dataset
from lodestone.plans.audit import append_audit
from lodestone.plans.pipeline import LoadError, LoadResult, LoadSpec, merge_files, merge_into, read_staging
from lodestone.session import path_exists, work_dir
from lodestone.sources.rawtext import parse_lines


def raw_stream(spark: SparkSession, raw_path: str, max_files: int | None = None) -> DataFrame:
    schema = T.StructType([T.StructField("value", T.StringType()),
                           T.StructField(BATCH_COL, T.StringType())])
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.text(raw_path)


def merge_batches(spark: SparkSession, raw_path: str, header: list[HeaderColumn],
                  target_path: str, keys, dedupe_by: str | None = None,
                  checkpoint: str | None = None, fmt: str = "PARQUET",
                  available_now: bool = True, strategy: str = "auto",
                  partition_col: str | None = None, keys_move: bool = True,
                  audit: str | None = None, max_files: int | None = None):
    """Start the stream; returns the ``StreamingQuery``. ``partition_col`` is a
    header column that the target is partitioned by; ``audit`` is the folder of
    the audit trail."""
    names = [c.name.strip() for c in header]
    checkpoint = checkpoint or work_dir(spark, "stream-ckpt")
    table = target_path.rstrip("/")
    rows_path, incr_path, new_path = table + "_stream_rows", table + "_stream_incr", table + "_new"
    schema = staging_schema(header)
    by = [partition_col] if partition_col else None
    key_list = keys.split() if isinstance(keys, str) else list(keys)
    home, _, name = table.rpartition("/")
    spec = LoadSpec(name, home.rpartition("/")[2], "INCR", keys=tuple(key_list))

    def arrive(batch: DataFrame, epoch_id: int, r: LoadResult) -> DataFrame:
        """The micro-batch as typed rows on storage, parsed once and counted."""
        seen = Observation(f"lines-{name}-{epoch_id}")
        lines = parse_lines(batch, names, keep=[BATCH_COL], fields_col="_fields") \
            .observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col("_fields") != len(names)).alias("malformed"))
        cast = Observation(f"values-{name}-{epoch_id}")
        typed = cleanse_projection(lines, header, partition_col=BATCH_COL, rejected_col="_rejected") \
            .observe(cast, F.sum("_rejected").alias("rejected")).drop("_rejected")
        write_dataset(typed, rows_path, fmt)
        r.source_rows = int(observed_value(seen, "lines") or 0)
        r.malformed_lines = int(observed_value(seen, "malformed") or 0)
        r.rejected_values = int(observed_value(cast, "rejected") or 0)
        return read_staging(spark, rows_path, fmt, typed.schema)

    def merge(typed: DataFrame, r: LoadResult) -> None:
        order = F.struct(BATCH_COL, *([F.col(dedupe_by).alias("then")] if dedupe_by else []))
        folded = fold_increment(typed.withColumn("_order", order), key_list, "_order").select(*names)
        write_dataset(folded, incr_path, fmt)
        incr = read_staging(spark, incr_path, fmt, schema)
        recover(spark, table)
        finish_change(spark, table)
        before = 0
        if not path_exists(spark, table):
            write_dataset(incr, new_path, fmt, partition_by=by)
            swap_in(spark, table, new_path)
            r.inserted_rows = incr.count()
        else:
            before = read_staging(spark, table, fmt, schema).count()
            if strategy == "files":
                r.inserted_rows = merge_files(spark, table, new_path, incr, key_list, None, fmt, partition_col, schema)
            else:
                r.inserted_rows = merge_into(spark, table, new_path, incr, key_list, None, fmt, partition_col, schema,
                                             strategy=strategy, scoped=bool(partition_col) and not keys_move)
        r.target_rows = read_staging(spark, table, fmt, schema).count()
        if r.target_rows != before + r.inserted_rows:
            raise LoadError(6, f"target {r.target_rows} is not {before} + {r.inserted_rows}")

    def apply(batch: DataFrame, epoch_id: int) -> None:
        r, t0 = LoadResult("F", None, None, table, fail_step=5), time.time()
        try:
            typed = arrive(batch, epoch_id, r)
            if r.malformed_lines:
                raise LoadError(5, f"{r.malformed_lines} malformed raw lines of {r.source_rows}")
            r.fail_step = 6
            merge(typed, r)
            r.status, r.fail_step = "S", None
        finally:
            r.ended, r.elapsed_s = dt.datetime.now(), int(round(time.time() - t0))
            if audit:
                append_audit(spark, audit, spec, r, str(epoch_id))

    w = (raw_stream(spark, raw_path, max_files).writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
