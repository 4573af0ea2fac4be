"""Column kinds: what a source column type becomes in a document index, a column store and in Spark."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import types as T


class Kind(Enum):
    BOOL = "bool"
    INT = "int"
    UINT = "uint"
    FLOAT = "float"
    DECIMAL = "decimal"
    STRING = "string"
    BYTES = "bytes"
    JSON = "json"
    DATE = "date"
    DATETIME = "datetime"
    TIMESTAMP = "timestamp"
    TIME = "time"
    YEAR = "year"
    ENUM = "enum"
    SET = "set"
    BIT = "bit"


class UnsupportedColumn(ValueError):
    """A column that cannot be replicated without guessing."""


@dataclass(frozen=True)
class Column:
    """A source column as its catalogue describes it."""

    name: str
    data_type: str
    column_type: str = ""
    nullable: bool = False
    generated: bool = False
    charset: str = ""
    precision: int | None = None
    scale: int | None = None
    fsp: int = 0
    members: tuple[str, ...] = field(default=())

    @property
    def unsigned(self) -> bool:
        return "unsigned" in self.column_type.lower()


@dataclass(frozen=True)
class Mapped:
    """A column's kind and its types; bits is the width of integers and floats."""

    kind: Kind
    index_type: str
    store_type: str
    spark_type: T.DataType
    bits: int = 64


# Integer widths as (signed index type, unsigned index type, bits, Spark signed, Spark unsigned).
INTEGERS = {
    "tinyint": ("byte", "short", 8, T.ByteType(), T.ShortType()),
    "smallint": ("short", "integer", 16, T.ShortType(), T.IntegerType()),
    "mediumint": ("integer", "long", 32, T.IntegerType(), T.LongType()),
    "int": ("integer", "long", 32, T.IntegerType(), T.LongType()),
    "integer": ("integer", "long", 32, T.IntegerType(), T.LongType()),
    "bigint": ("long", "unsigned_long", 64, T.LongType(), T.DecimalType(20, 0)),
}
TEXTS = {"char": "keyword", "varchar": "keyword", "tinytext": "text", "text": "text", "mediumtext": "text", "longtext": "text"}
BINARIES = {"binary", "varbinary", "tinyblob", "blob", "mediumblob", "longblob"}
SPATIAL = {"geometry", "point", "linestring", "polygon", "multipoint", "multilinestring", "multipolygon", "geometrycollection", "geomcollection"}
#: Charsets whose bytes are UTF-8 already; latin1 converts, all others are refused.
PLAIN_CHARSETS = {"", "utf8", "utf8mb3", "utf8mb4", "ascii", "binary"}


def map_column(col: Column) -> Mapped:
    """The column's kind and types; refuses generated columns, spatial and unknown types, and label types without labels."""
    t = col.data_type.lower()
    if col.generated:
        raise UnsupportedColumn(f"{col.name}: generated columns are not replicated")
    if t == "tinyint" and re.match(r"tinyint\(1\)", col.column_type.lower()) and not col.unsigned:
        return Mapped(Kind.BOOL, "boolean", "Bool", T.BooleanType(), 8)
    if t in INTEGERS:
        signed, unsigned, bits, spark_signed, spark_unsigned = INTEGERS[t]
        if col.unsigned:
            return Mapped(Kind.UINT, unsigned, f"UInt{bits}", spark_unsigned, bits)
        return Mapped(Kind.INT, signed, f"Int{bits}", spark_signed, bits)
    if t in ("decimal", "numeric"):
        p, s = 10 if col.precision is None else col.precision, 0 if col.scale is None else col.scale
        return Mapped(Kind.DECIMAL, "keyword", f"Decimal({p}, {s})", T.DecimalType(p, s) if p <= 38 else T.StringType())
    if t == "float":
        return Mapped(Kind.FLOAT, "float", "Float32", T.FloatType(), 32)
    if t in ("double", "real"):
        return Mapped(Kind.FLOAT, "double", "Float64", T.DoubleType(), 64)
    if t in TEXTS:
        return Mapped(Kind.STRING, TEXTS[t], "String", T.StringType())
    if t in BINARIES:
        return Mapped(Kind.BYTES, "binary", "String", T.StringType())
    if t == "json":
        return Mapped(Kind.JSON, "object", "String", T.StringType())
    if t == "date":
        return Mapped(Kind.DATE, "date", "Date32", T.DateType())
    if t == "datetime":
        return Mapped(Kind.DATETIME, "date", f"DateTime64({col.fsp})", T.TimestampType())
    if t == "timestamp":
        return Mapped(Kind.TIMESTAMP, "date", f"DateTime64({col.fsp}, 'UTC')", T.TimestampType())
    if t == "time":
        return Mapped(Kind.TIME, "long", "Int64", T.LongType())
    if t == "year":
        return Mapped(Kind.YEAR, "short", "UInt16", T.ShortType())
    if t in ("enum", "set"):
        if not col.members:
            raise UnsupportedColumn(f"{col.name}: no labels are known for this {t}")
        if t == "enum":
            return Mapped(Kind.ENUM, "keyword", "LowCardinality(String)", T.StringType())
        return Mapped(Kind.SET, "keyword", "Array(String)", T.ArrayType(T.StringType()))
    if t == "bit":
        return Mapped(Kind.BIT, "long", "UInt64", T.DecimalType(20, 0))
    if t in SPATIAL:
        raise UnsupportedColumn(f"{col.name}: spatial type {t} has no document form")
    raise UnsupportedColumn(f"{col.name}: type {t} is unknown")


def nullable_store_type(mapped: Mapped, nullable: bool) -> str:
    """Column-store type; LowCardinality stays outside Nullable, arrays cannot be null."""
    if not nullable or mapped.store_type.startswith("Array("):
        return mapped.store_type
    if m := re.fullmatch(r"LowCardinality\((.*)\)", mapped.store_type):
        return f"LowCardinality(Nullable({m[1]}))"
    return f"Nullable({mapped.store_type})"


def parse_members(column_type: str) -> tuple[str, ...]:
    """Labels of ``enum('a','it''s')`` or ``set(...)``; empty for other types."""
    m = re.fullmatch(r"\s*(?:enum|set)\s*\((.*)\)\s*", column_type, re.I | re.S)
    return tuple(x.replace("''", "'") for x in re.findall(r"'((?:[^']|'')*)'", m[1])) if m else ()
