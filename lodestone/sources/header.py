"""Header files: the frozen column metadata of a source table, as CSV with
the first line ``Column Name,SQL Type,Business Name,Length,Decimal``.

Read as a proper CSV (quoted comments may hold commas); a handful of rows,
so the header is collected to the driver, where it drives schema derivation
and the cleansing projection.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.types import HEADER_COLUMNS, HeaderColumn
from lodestone.session import data_files, make_dirs, read_text, write_text

HEADER_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("sql_type", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("length", T.StringType()),
    T.StructField("scale", T.StringType()),
])


def scan_header(spark: SparkSession, path: str) -> DataFrame:
    """Header rows in file order (the first line is skipped)."""
    return (spark.read.schema(HEADER_SCHEMA).option("header", True)
            .option("quote", '"').option("escape", '"').csv(path)
            .withColumn("_pos", F.monotonically_increasing_id())
            .orderBy("_pos").drop("_pos"))


def header_from_frame(df: DataFrame) -> list[HeaderColumn]:
    rows = df.collect()
    return [HeaderColumn(r["name"].strip(), r["sql_type"], r["comment"] or "",
                         r["length"], r["scale"]) for r in rows if r["name"]]


def read_header(spark: SparkSession, path: str) -> list[HeaderColumn]:
    return header_from_frame(scan_header(spark, path))


class HeaderDrift(ValueError):
    """The source's columns no longer are those that the table was built from."""


def _told(c: HeaderColumn) -> tuple[str, str, str]:
    return c.sql_type.strip().upper(), str(c.length or "").strip(), str(c.scale or "").strip()


def _stored(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n[1:-4]) for _, n in data_files(spark, folder) if n[0] == "v" and n.endswith(".csv"))


def freeze_header(spark: SparkSession, folder: str, header: list[HeaderColumn]) -> tuple[list[HeaderColumn], list[str]]:
    """The frozen header of a table and the columns that its source has gained
    since. The first header seen is frozen in ``folder``; from then on it is what
    loads use. A column that is gone or has another type is drift, an error."""
    have = _stored(spark, folder)
    if not have:
        accept_header(spark, folder, header)
        return header, []
    rows = list(csv.reader(io.StringIO(read_text(spark, f"{folder}/v{have[-1]:04d}.csv"))))[1:]
    frozen = [HeaderColumn(*r) for r in rows if r]
    now = {c.name.strip(): c for c in header}
    wrong = [f"column {c.name} is gone" for c in frozen if c.name.strip() not in now]
    wrong += [f"column {c.name} was {' '.join(filter(None, _told(c)))}, is {' '.join(filter(None, _told(now[c.name.strip()])))}"
              for c in frozen if c.name.strip() in now and _told(c) != _told(now[c.name.strip()])]
    if wrong:
        raise HeaderDrift("; ".join(wrong))
    known = {c.name.strip() for c in frozen}
    return frozen, [c.name.strip() for c in header if c.name.strip() not in known]


def accept_header(spark: SparkSession, folder: str, header: list[HeaderColumn]) -> int:
    """Make ``header`` the frozen one from now on; the number of its version."""
    have = _stored(spark, folder)
    number = (have[-1] if have else 0) + 1
    make_dirs(spark, folder)
    write_text(spark, f"{folder}/v{number:04d}.csv", header_csv(header), overwrite=False)
    return number


def header_csv(header: list[HeaderColumn]) -> str:
    """CSV text of a header (for writing a header file once per table)."""
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(HEADER_COLUMNS)
    for c in header:
        w.writerow([c.name, c.sql_type, c.comment or "", c.length or "", c.scale or ""])
    return buf.getvalue()
