"""Mappings: which columns of a table become which fields, compiled once to expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.encode import encode_column, json_document
from millrace.functions.keys import doc_key
from millrace.functions.kinds import PLAIN_CHARSETS, Column, Kind, Mapped, map_column

RESERVED = ("_version", "_is_deleted")


class MappingError(ValueError):
    pass


@dataclass(frozen=True)
class Table:
    """A source table: ordered columns and primary key; names are matched without case."""

    schema: str
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()

    def find(self, name: str) -> Column | None:
        return next((c for c in self.columns if c.name.lower() == name.lower()), None)


@dataclass(frozen=True)
class Mapping:
    key: tuple[str, ...] = ()
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    rename: dict[str, str] = field(default_factory=dict)


def resolve_key(table: Table, mapping: Mapping) -> list[Column]:
    """The configured key, else the primary key; refuses none, unknown, repeated, generated and nullable ones."""
    names = mapping.key or table.primary_key
    if not names:
        raise MappingError(f"{table.schema}.{table.name} has no primary key; set mapping.key")
    out: list[Column] = []
    for name in names:
        col = table.find(name)
        if col is None:
            raise MappingError(f"key column {name} does not exist")
        if col in out:
            raise MappingError(f"key column {name} is listed twice")
        if col.generated:
            raise MappingError(f"key column {name} is generated")
        if col.nullable:
            raise MappingError(f"key column {name} is nullable")
        out.append(col)
    return out


def select_columns(table: Table, mapping: Mapping) -> list[Column]:
    """Chosen columns in the table's order: all that are not generated, the included ones, or all but the excluded."""
    if mapping.include and mapping.exclude:
        raise MappingError("include and exclude cannot both be set")
    for name in (*mapping.include, *mapping.exclude):
        if table.find(name) is None:
            raise MappingError(f"column {name} does not exist")
    key = {c.name.lower() for c in resolve_key(table, mapping)}
    include, exclude = ({n.lower() for n in names} for names in (mapping.include, mapping.exclude))
    if include:
        if missing := sorted(key - include):
            raise MappingError(f"include must contain the key: {', '.join(missing)}")
        return [c for c in table.columns if c.name.lower() in include]
    if both := sorted(key & exclude):
        raise MappingError(f"the key cannot be excluded: {', '.join(both)}")
    return [c for c in table.columns if c.name.lower() not in exclude and not c.generated]


def destination_names(columns: Sequence[Column], mapping: Mapping) -> list[str]:
    """Names after renaming; checked against the final set, so that no two fields and no reserved name meet."""
    rename = {k.lower(): v for k, v in mapping.rename.items()}
    if unknown := sorted(set(rename) - {c.name.lower() for c in columns}):
        raise MappingError(f"rename of columns that are not selected: {', '.join(unknown)}")
    names = [rename.get(c.name.lower(), c.name) for c in columns]
    for name in names:
        if not name:
            raise MappingError("a column cannot be renamed to nothing")
        if name in RESERVED:
            raise MappingError(f"{name} is reserved")
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise MappingError(f"more than one column becomes {', '.join(twice)}")
    return names


@dataclass(frozen=True)
class Field:
    column: Column
    mapped: Mapped
    name: str


@dataclass(frozen=True)
class Plan:
    """A compiled mapping: expressions over a struct column that holds a row image."""

    table: Table
    key: tuple[Column, ...]
    fields: tuple[Field, ...]
    zone: str = "UTC"
    zero_date: str = "null"
    dialect: str = "index"

    def key_of(self, image: str) -> Expr:
        """Document key from raw values: an enum counts by number."""
        return doc_key([F.col(f"{image}.`{c.name}`") for c in self.key])

    def encoded(self, image: str) -> list[tuple[Field, Expr, Expr]]:
        out = []
        for f in self.fields:
            e = encode_column(f.column, f.mapped, F.col(f"{image}.`{f.column.name}`"), self.zone, self.zero_date, self.dialect == "index")
            out.append((f, e.value, e.problem))
        return out

    def values(self, image: str) -> Expr:
        """Struct of typed document values."""
        return F.struct(*(v.alias(f.name) for f, v, _ in self.encoded(image)))

    def key_values(self, image: str) -> Expr:
        """Struct like values() with the key's fields alone; the others are null."""
        keys = {c.name for c in self.key}
        return F.struct(*((v if f.column.name in keys else F.lit(None)).alias(f.name) for f, v, _ in self.encoded(image)))

    def problem(self, image: str) -> Expr:
        """Why the image cannot become a document, if so: the first field at fault, or a null key."""
        null_key = F.when(self.key_of(image).isNull(), F.lit("null in the key"))
        return F.coalesce(null_key, *(F.when(p.isNotNull(), F.concat(F.lit(f"{f.column.name}: "), p)) for f, _, p in self.encoded(image)))

    def body(self, image: str) -> Expr:
        return json_document([(f.name, v, f.mapped.kind == Kind.JSON) for f, v, _ in self.encoded(image)])

    def key_body(self, image: str) -> Expr:
        keys = {c.name for c in self.key}
        return json_document([(f.name, v, f.mapped.kind == Kind.JSON) for f, v, _ in self.encoded(image) if f.column.name in keys])

    def project(self, rows: DataFrame) -> DataFrame:
        """The mapping's columns of a table scan, unencoded and renamed."""
        return rows.select(*(F.col(f"`{f.column.name}`").alias(f.name) for f in self.fields))


def compile_plan(table: Table, mapping: Mapping, zone: str = "UTC", zero_date: str = "null", dialect: str = "index") -> Plan:
    """Everything about a mapping that can fail without looking at a row fails here."""
    if zero_date not in ("null", "epoch", "error"):
        raise MappingError(f"zero-date policy {zero_date!r} is unknown")
    if dialect not in ("index", "store"):
        raise MappingError(f"dialect {dialect!r} is unknown")
    key, columns = resolve_key(table, mapping), select_columns(table, mapping)
    names = destination_names(columns, mapping)
    fields = tuple(Field(c, map_column(c), n) for c, n in zip(columns, names))
    plan = Plan(table, tuple(key), fields, zone, zero_date, dialect)
    for f in fields:  # charsets are refused while compiling
        if f.mapped.kind == Kind.STRING:
            if f.column.charset.lower() not in PLAIN_CHARSETS | {"latin1"}:
                raise MappingError(f"{f.column.name}: charset {f.column.charset} cannot be converted")
    if dialect == "store" and (missing := sorted({c.name for c in key} - {c.name for c in columns})):
        raise MappingError(f"a column store needs the key in the row: {', '.join(missing)}")
    return plan
