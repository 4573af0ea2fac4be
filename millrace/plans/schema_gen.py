"""Destination schemas: index mappings, column-store and Spark DDL, and checks of what is there."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.kinds import Kind, nullable_store_type
from millrace.plans.mapping import Plan

# Which existing field types hold a wanted type without loss, besides the same type.
WIDER = {
    "byte": ("short", "integer", "long", "unsigned_long"),
    "short": ("integer", "long", "unsigned_long"),
    "integer": ("long", "unsigned_long"),
    "long": ("unsigned_long",),
    "float": ("double",),
    "keyword": ("text_with_keyword",),
    "object": ("", "nested", "flattened"),
}


def compatible(wanted: str, found: str) -> bool:
    return wanted == found or found in WIDER.get(wanted, ())


def faults(wanted: dict[str, str], found: dict[str, str]) -> list[str]:
    """What keeps an existing mapping from holding the wanted fields; fields of its own do no harm."""
    out = [f"{name} is missing" for name in wanted if name not in found]
    return out + [f"{name} is {found[name]}, {kind} is wanted" for name, kind in wanted.items() if name in found and not compatible(kind, found[name])]


def expected_fields(plan: Plan) -> dict[str, str]:
    return {f.name: f.mapped.index_type for f in plan.fields}


def index_mapping(plan: Plan, shards: int = 1, replicas: int = 1) -> tuple[str, list[str]]:
    """Strict mapping as JSON, and notes for whoever applies it."""
    fields, notes = {}, []
    for f in plan.fields:
        fields[f.name] = {"type": "object", "enabled": False} if f.mapped.kind == Kind.JSON else {"type": f.mapped.index_type}
        if f.mapped.index_type == "unsigned_long":
            notes.append(f"{f.name}: unsigned_long sorts and aggregates with reduced precision")
        if f.mapped.kind == Kind.DECIMAL:
            notes.append(f"{f.name}: decimals are kept as keywords; range queries compare text")
    body = {"settings": {"number_of_shards": shards, "number_of_replicas": replicas}, "mappings": {"dynamic": "strict", "properties": fields}}
    return json.dumps(body, indent=2, ensure_ascii=False), notes


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def store_ddl(plan: Plan, database: str = "") -> tuple[str, list[str]]:
    """A replacing, versioned table ordered by the renamed key."""
    key = [next(f.name for f in plan.fields if f.column == c) for c in plan.key]
    lines = [f"  {_quote(f.name)} {nullable_store_type(f.mapped, f.column.nullable)}" for f in plan.fields]
    lines += ["  `_version` UInt64", "  `_is_deleted` UInt8"]
    name = f"{_quote(database)}.{_quote(plan.table.name)}" if database else _quote(plan.table.name)
    ddl = f"CREATE TABLE {name} (\n" + ",\n".join(lines) + f"\n) ENGINE = ReplacingMergeTree(_version, _is_deleted)\nORDER BY ({', '.join(map(_quote, key))})"
    notes = [f"{f.name}: set columns cannot be null in arrays; null becomes empty" for f in plan.fields if f.mapped.kind == Kind.SET and f.column.nullable]
    return ddl, notes + ["read with FINAL and _is_deleted = 0"]


def spark_ddl(plan: Plan, name: str, location: str | None = None) -> str:
    """The append-only versioned table that this engine writes."""
    cols = [f"  {_quote(f.name)} {f.mapped.spark_type.simpleString()}" for f in plan.fields] + ["  `_version` bigint", "  `_is_deleted` int"]
    return f"CREATE TABLE {name} (\n" + ",\n".join(cols) + "\n) USING parquet" + (f" LOCATION '{location}'" if location else "")


def schema_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """All faults of an existing mapping at once: fields (field, type) that are missing or cannot hold the wanted type."""
    wider = expected.sparkSession.createDataFrame([(w, f) for w, fs in WIDER.items() for f in fs], "type string, found string")
    both = expected.join(actual.select("field", F.col("type").alias("found")), "field", "left").join(F.broadcast(wider.withColumn("fits", F.lit(True))), ["type", "found"], "left")
    missing = F.col("found").isNull()
    fits = (F.col("type") == F.col("found")) | F.coalesce("fits", F.lit(False))
    return both.where(missing | ~fits).select("field", "type", "found", F.when(missing, "missing").otherwise("incompatible").alias("fault"))
