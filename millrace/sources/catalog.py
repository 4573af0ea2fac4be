"""Table definitions from a catalogue, or from a DataFrame's schema; cached, and dropped on DDL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.functions.kinds import Column, parse_members
from millrace.plans.mapping import Table

# Source type of each Spark type.
SOURCE_TYPES = {
    T.BooleanType: ("tinyint", "tinyint(1)"), T.ByteType: ("tinyint", "tinyint"), T.ShortType: ("smallint", "smallint"), T.IntegerType: ("int", "int"), T.LongType: ("bigint", "bigint"),
    T.FloatType: ("float", "float"), T.DoubleType: ("double", "double"), T.StringType: ("varchar", "varchar(255)"), T.BinaryType: ("varbinary", "varbinary(255)"),
    T.DateType: ("date", "date"), T.TimestampType: ("timestamp", "timestamp(6)"), T.TimestampNTZType: ("datetime", "datetime(6)"),
}
DDL = re.compile(r"^\s*(alter|create|drop|rename|truncate)\s+(table\s+)?", re.I)


def from_rows(schema: str, name: str, columns: list[dict], key: list[str]) -> Table:
    """A table from catalogue rows: name, data_type, column_type, nullable, generated, charset, precision, scale, fsp."""
    made = tuple(
        Column(c["name"], c["data_type"], c.get("column_type", c["data_type"]), bool(c.get("nullable")), bool(c.get("generated")), c.get("charset") or "", c.get("precision"), c.get("scale"), c.get("fsp") or 0, parse_members(c.get("column_type", "")))
        for c in sorted(columns, key=lambda c: c.get("ordinal", 0))
    )
    return Table(schema, name, made, tuple(key))


def from_dataframe(df: DataFrame, schema: str, name: str, key: list[str], overrides: dict[str, Column] | None = None) -> Table:
    """A table with the DataFrame's columns; key columns count as not null."""
    made = []
    for f in df.schema.fields:
        if overrides and f.name in overrides:
            made.append(overrides[f.name])
        elif isinstance(f.dataType, T.DecimalType):
            made.append(Column(f.name, "decimal", f.dataType.simpleString(), f.nullable and f.name not in key, precision=f.dataType.precision, scale=f.dataType.scale))
        elif type(f.dataType) in SOURCE_TYPES:
            made.append(Column(f.name, *SOURCE_TYPES[type(f.dataType)], f.nullable and f.name not in key))
        else:
            made.append(Column(f.name, f.dataType.simpleString(), f.dataType.simpleString(), f.nullable))
    return Table(schema, name, tuple(made), tuple(key))


class Catalog:
    """Definitions by name without case; a DDL statement drops what it may have changed."""

    def __init__(self, load: Callable[[str, str], Table]):
        self.load, self.known = load, {}

    def get(self, schema: str, name: str) -> Table:
        key = (schema.lower(), name.lower())
        if key not in self.known:
            self.known[key] = self.load(schema, name)
        return self.known[key]

    def saw(self, statement: str, schema: str = "") -> bool:
        """True if the statement was DDL. RENAME, or a statement without a database, drops everything."""
        m = DDL.match(statement)
        if not m:
            return False
        if m[1].lower() == "rename" or not schema:
            self.known.clear()
        else:
            self.known = {k: v for k, v in self.known.items() if k[0] != schema.lower()}
        return True
