"""The raw text dialect: '|' between fields, '\\' escapes, '' is NULL.

Writing escapes ``\\``, ``|``, line feed and carriage return inside values so
that one record is always one line and the file splits cleanly across tasks.
Reading cuts each line at the delimiters that are not escaped (Spark's CSV reader
does not round-trip this dialect), then undoes the escapes. Lines without any
backslash take a plain ``split``. Lines that hold only the four escapes that
writing makes are cut and decoded by plain replacements: a line never holds a line
feed or carriage return itself, so these two mark escapes meanwhile. Any other line
is tokenised by regular expressions that understand the escapes.

Both directions are pure column expressions: text files are read and written
in parallel by Spark, one task per file split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The dialect.
DELIMITER = "|"
ESCAPE = "\\"
NULL_TEXT = ""
# One field = any run of escaped characters or characters other than the
# delimiter and the escape, terminated by a delimiter. Appending a delimiter
# to the line makes the number of matches equal to the number of fields. The
# runs are possessive: they never need to be given back, and the matcher does
# not recurse, so a field can be megabytes long.
FIELD_PATTERN = r"((?:[^|\\]++|\\.)*+)\|"
NEWLINE_ESCAPE = r"(?<!\\)((?:\\\\)*+)\\n"
RETURN_ESCAPE = r"(?<!\\)((?:\\\\)*+)\\r"
ANY_ESCAPE = r"\\(.)"


def escape_value(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit("|"), F.lit("\\|"))
    c = F.replace(c, F.lit("\n"), F.lit("\\n"))
    return F.replace(c, F.lit("\r"), F.lit("\\r"))


def unescape_value(c: Column) -> Column:
    """Undo the escapes. An escape ``\\n`` / ``\\r`` is one preceded by an
    even run of backslashes (each pair being an escaped backslash); those
    become line breaks first, then every remaining escape pair ``\\X``
    becomes ``X``. Only plain ``regexp_replace`` (codegen'd), and only on
    values that contain a backslash at all."""
    v = F.regexp_replace(c, F.lit(NEWLINE_ESCAPE), F.lit("$1\n"))
    v = F.regexp_replace(v, F.lit(RETURN_ESCAPE), F.lit("$1\r"))
    v = F.regexp_replace(v, F.lit(ANY_ESCAPE), F.lit("$1"))
    return F.when(c.contains("\\"), v).otherwise(c)


def to_lines(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One text line per row from the given (string-castable) columns."""
    columns = columns or df.columns
    parts = [F.coalesce(escape_value(F.col(c).cast("string")), F.lit(NULL_TEXT))
             for c in columns]
    return F.concat_ws(DELIMITER, *parts)


def usual_escapes(c: Column) -> Column:
    """Whether every backslash belongs to one of the four escapes that ``escape_value``
    makes, in one line."""
    rest = c
    for pair in ("\\\\", "\\|", "\\n", "\\r"):
        rest = F.replace(rest, F.lit(pair), F.lit("\n"))
    return ~(rest.contains("\\") | c.contains("\n") | c.contains("\r"))


def mark_escapes(line: Column) -> Column:
    """A line of the usual escapes with an escaped backslash as backslash and line
    feed, and an escaped delimiter as carriage return: every delimiter left separates."""
    return F.replace(F.replace(line, F.lit("\\\\"), F.lit("\\\n")), F.lit("\\|"), F.lit("\r"))


def unmark_escapes(c: Column) -> Column:
    """The value of a field that ``mark_escapes`` marked: a carriage return is a
    delimiter before ``\\r`` becomes one, and a line feed after a backslash always
    stands for the backslash, since no other escape is left in front of it."""
    v = F.replace(F.replace(c, F.lit("\r"), F.lit("|")), F.lit("\\r"), F.lit("\r"))
    v = F.replace(v, F.lit("\\n"), F.lit("\n"))
    return F.replace(v, F.lit("\\\n"), F.lit("\\"))


def split_line(line: Column) -> Column:
    """The fields of a line, still with their escapes."""
    slow = F.regexp_extract_all(F.concat(line, F.lit(DELIMITER)),
                                F.lit(FIELD_PATTERN), 1)
    fast = F.split(line, r"\|", -1)
    return F.when(line.contains("\\"), slow).otherwise(fast)


def marked_line(line: Column) -> Column:
    """Whether ``line_fields`` marks this line's escapes."""
    return line.contains("\\") & usual_escapes(line)


def line_fields(line: Column) -> Column:
    """The fields of a line, their escapes marked or as they are."""
    return F.when(marked_line(line), F.split(mark_escapes(line), r"\|", -1)).otherwise(split_line(line))


def parse_lines(lines: DataFrame, names: list[str], keep: list[str] | None = None,
                fields_col: str | None = None) -> DataFrame:
    """Turn a DataFrame with a ``value`` text column into string columns.

    ``keep`` lists extra columns (partition columns discovered from the
    directory layout) to carry through unchanged. ``fields_col`` adds the
    number of fields each line has: a line is malformed unless that is the
    number of names (missing fields read as NULL, surplus ones are lost)."""
    staged = lines.select(line_fields(F.col("value")).alias("_f"), marked_line(F.col("value")).alias("_marked"),
                          *(keep or []))
    cols = []
    for i, n in enumerate(names):
        f = F.get(F.col("_f"), i)
        v = F.when(F.col("_marked"), unmark_escapes(f)).otherwise(unescape_value(f))
        cols.append(F.when(v == F.lit(NULL_TEXT), F.lit(None).cast("string"))
                    .otherwise(v).alias(n))
    count = [F.size("_f").alias(fields_col)] if fields_col else []
    return staged.select(*cols, *(keep or []), *count)


def malformed_lines(lines: DataFrame, width: int) -> DataFrame:
    """One row: how many lines of ``lines`` (value) don't have ``width`` fields,
    and how many there are."""
    n = F.size(line_fields(F.col("value")))
    return lines.agg(F.count_if(n != width).alias("malformed"), F.count(F.lit(1)).alias("lines"))


def read_raw_text(spark: SparkSession, path: str, names: list[str],
                  partition_cols: list[str] | None = None, fields_col: str | None = None) -> DataFrame:
    """Scan raw text files under ``path`` into all-string columns.

    Partition directories (``batch_id=…``, ``month=…``) below ``path`` are
    discovered by Spark and kept as columns; filters on them prune files.
    Named partition columns are read as text (no type inference, so a batch
    id keeps its leading zeros)."""
    reader = spark.read
    if partition_cols:
        reader = reader.schema(T.StructType(
            [T.StructField("value", T.StringType())] +
            [T.StructField(p, T.StringType()) for p in partition_cols]))
    lines = reader.text(path)
    extra = [c for c in lines.columns if c != "value"]
    out = parse_lines(lines, names, keep=extra, fields_col=fields_col)
    return out.select(*[F.col(c).cast("string") if c in extra else F.col(c)
                        for c in out.columns])
