"""Source type names -> staging types, and header -> schemas.

A *header* is the frozen column metadata of one source table: name, SQL type
name, business comment, length and scale, in source column order. It is a
handful of rows per table and is the only thing besides configuration that is
held on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Source type name -> logical type (lookup key is the trimmed,
# upper-cased source name).
TYPE_MAP = {
    "NUMBER": "int",
    "CHAR": "string",
    "TIMS": "string",
    "DATS": "date",
    "CUKY": "string",
    "NUMC": "integer",
    "UNIT": "string",
    "DATE": "date",
    "CHARACTER": "string",
    "VARCHAR": "string",
    "VARCHAR2": "string",
    "NVARCHAR": "string",
    "INTEGER": "integer",
    "DECIMAL": "decimal",
    "DEC": "decimal",
    "NUMERIC": "decimal",
    "CURR": "decimal",
    "QUANT": "decimal",
    "QUAN": "decimal",
    "INT4": "integer",
    "TIMESTAMP": "timestamp",
    "INT": "integer",
    "NCHAR": "string",
    "SMALLINT": "integer",
    "DATETIME": "timestamp",
    "TINYINT": "integer",
}

# Source names whose staging column is a timestamp even though
# the logical type says date, and the one whose staging column is a double.
TIMESTAMP_SOURCE_NAMES = ("DATE", "DATS", "TIMESTAMP")
DOUBLE_SOURCE_NAMES = ("NUMBER",)
# Precision and scale used when a NUMERIC/DECIMAL header row
# gives none (also the meaning of a bare "decimal").
DEFAULT_PRECISION, DEFAULT_SCALE = 10, 0
# Fixed value: the header file's first line.
HEADER_COLUMNS = ("Column Name", "SQL Type", "Business Name", "Length", "Decimal")

# Cleansing kinds: which scalar function a column goes through.
DATE_KIND, DECIMAL_KIND, TEXT_KIND = "date", "decimal", "text"


class UnmappedTypeError(ValueError):
    pass


@dataclass(frozen=True)
class HeaderColumn:
    name: str
    sql_type: str
    comment: str = ""
    length: str | None = None
    scale: str | None = None

    @property
    def key(self) -> str:
        return self.sql_type.strip().upper()


def map_type(sql_type: str) -> str:
    """Logical type of a source type name; raises for names not in the map."""
    key = sql_type.strip().upper()
    if key not in TYPE_MAP:
        raise UnmappedTypeError(f"unmapped source type {sql_type!r}")
    return TYPE_MAP[key]


def _is_number(text: str | None) -> bool:
    if text is None:
        return False
    try:
        float(text.strip())
    except ValueError:
        return False
    return text.strip() != ""


def staging_type(col: HeaderColumn) -> T.DataType:
    """Typed staging column type for one header row."""
    key = col.key
    try:
        logical = map_type(key)
    except UnmappedTypeError:
        raise UnmappedTypeError(
            f"column {col.name!r}: unmapped source type {col.sql_type!r}") from None
    if key in TIMESTAMP_SOURCE_NAMES:
        return T.TimestampNTZType()
    if key in DOUBLE_SOURCE_NAMES:
        return T.DoubleType()
    if key in ("NUMERIC", "DECIMAL"):
        p = int(float(col.length)) if _is_number(col.length) else DEFAULT_PRECISION
        s = int(float(col.scale)) if _is_number(col.scale) else DEFAULT_SCALE
        return T.DecimalType(p, s)
    return {
        "integer": T.IntegerType(),
        "string": T.StringType(),
        "decimal": T.DecimalType(DEFAULT_PRECISION, DEFAULT_SCALE),
        "timestamp": T.TimestampNTZType(),
        "date": T.TimestampNTZType(),
    }[logical]


def cleanse_kind(col: HeaderColumn) -> str:
    logical = map_type(col.key)
    if logical in ("date", "timestamp"):
        return DATE_KIND
    if logical == "decimal":
        return DECIMAL_KIND
    return TEXT_KIND


def staging_schema(header: list[HeaderColumn],
                   partition_col: str | None = None) -> T.StructType:
    """Typed staging schema; business comments go to field metadata."""
    fields = [T.StructField(c.name.strip(), staging_type(c), True,
                            {"comment": c.comment or ""}) for c in header]
    if partition_col:
        fields.append(T.StructField(partition_col, T.StringType(), True))
    return T.StructType(fields)


def raw_schema(header: list[HeaderColumn],
               partition_col: str | None = None) -> T.StructType:
    """All-string raw schema in header order (plus the partition column)."""
    names = [c.name.strip() for c in header]
    if partition_col and partition_col not in names:
        names.append(partition_col)
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Spark type -> source type name, used when the "source" is a Spark relation
# (a parquet table standing in for a database table).
def header_from_schema(schema: T.StructType) -> list[HeaderColumn]:
    out = []
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, (T.LongType, T.DoubleType, T.FloatType)):
            out.append(HeaderColumn(f.name, "NUMBER", "", "19", "0"))
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(HeaderColumn(f.name, "INTEGER", "", "10", "0"))
        elif isinstance(t, T.DecimalType):
            out.append(HeaderColumn(f.name, "DECIMAL", "", str(t.precision),
                                    str(t.scale)))
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            out.append(HeaderColumn(f.name, "TIMESTAMP"))
        elif isinstance(t, T.DateType):
            out.append(HeaderColumn(f.name, "DATE"))
        elif isinstance(t, (T.StringType, T.BooleanType)):
            out.append(HeaderColumn(f.name, "VARCHAR"))
        else:
            raise UnmappedTypeError(
                f"column {f.name!r}: no source type for {t.simpleString()}")
    return out
