"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import delete_path

#: The lists of written tables of the ``discarding`` blocks that are open.
_OPEN: ContextVar[tuple[list, ...]] = ContextVar("open", default=())

#: ASCII letters, for the lower-casing that leaves every other character alone.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; it must be set."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                         "executors share; intermediate tables are written there")
    return root.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    later plans start from the table, and a lost executor costs no recompute."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    for tables in _OPEN.get():
        tables.append((spark, path))
    table = spark.read.schema(schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned and that no later plan reads."""
    for table in tables:
        delete_path(table.sparkSession, table.written_to)


@contextmanager
def discarding() -> Iterator[None]:
    """Deletes on leaving every table that ``materialize`` wrote inside. Results
    are lazy and read such tables, so write the result inside, too."""
    mine: list[tuple[SparkSession, str]] = []
    token = _OPEN.set((*_OPEN.get(), mine))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for spark, path in mine:
            delete_path(spark, path)


def id_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets`` (0 for a null id)."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return (crc % buckets).cast("int")
