"""Change events and what they become: documents, tombstones, key-change pairs, routes, diffs.

An event has ``op`` (insert, update, delete, snapshot), ``before`` and ``after`` row images and a version, ``seq``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.encode import enum_label, set_members
from millrace.functions.kinds import Column as SourceColumn
from millrace.plans.mapping import Plan

DELETE, UPDATE, INSERT, SNAPSHOT = "delete", "update", "insert", "snapshot"
#: Row-event names of the replication log and their operations.
ROW_EVENTS = {"WRITE_ROWS": INSERT, "UPDATE_ROWS": UPDATE, "DELETE_ROWS": DELETE}


def classify(event_type: Column) -> Column:
    """Operation of a row-event name with or without version suffix; null for other events."""
    out = F.lit(None).cast("string")
    for name, op in ROW_EVENTS.items():
        out = F.when(event_type.rlike(f"^{name}(_?EVENT)?(_?[vV][0-2])?$"), F.lit(op)).otherwise(out)
    return out


def dispatch(event_type: Column) -> Column:
    """What becomes of an event of the replication log, by its name: its rows are applied, its position counts, the definitions
    it may change are dropped, or it says nothing to us."""
    name = F.upper(event_type)
    return (
        F.when(classify(name).isNotNull(), "rows").when(name.rlike("^(GTID|ANONYMOUS_GTID|XID)(_?EVENT|_LOG_EVENT)?$"), "position")
        .when(name.rlike("^QUERY(_?EVENT)?$"), "statement").otherwise("ignored")
    )


def is_upsert(op: Column | str = "op") -> Column:
    return (F.col(op) if isinstance(op, str) else op) != DELETE


def event_values(events: DataFrame) -> Column:
    """The image that an event is about: after, or before for deletes."""
    return F.when(is_upsert(), F.col("after")).otherwise(F.col("before"))


def split_key_changes(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """One or two documents for each event: ``image``, ``seq`` and ``deleted``.

    An update that changes the key deletes the old document and writes the new one, under one version. Tombstones
    carry the old image, from which a destination takes the key.
    """
    image = lambda c, gone: F.struct(F.col(c).alias("image"), F.lit(gone).alias("deleted"))
    moved = F.lit(False)
    for k in key:
        moved = moved | ~F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}"))
    gone = (F.col("op") == DELETE) | ((F.col("op") == UPDATE) & F.col("before").isNotNull() & moved)
    docs = F.array(F.when(gone, image("before", True)), F.when(is_upsert(), image("after", False)))
    rest = [c for c in events.columns if c not in ("before", "after")]
    return events.select(*rest, F.explode(docs).alias("__d")).where("__d IS NOT NULL").select(*rest, "__d.image", "__d.deleted")


def documents(events: DataFrame, plan: Plan) -> DataFrame:
    """Encoded documents: key, values (key fields alone on tombstones), _version, _is_deleted, and problem if any."""
    docs = split_key_changes(events, [c.name for c in plan.key])
    return docs.select(
        plan.key_of("image").alias("key"),
        F.when(F.col("deleted"), plan.key_values("image")).otherwise(plan.values("image")).alias("doc"),
        F.col("seq").alias("_version"),
        F.col("deleted").alias("_is_deleted"),
        F.when(~F.col("deleted"), plan.problem("image")).otherwise(F.when(plan.key_of("image").isNull(), F.lit("null in the key"))).alias("problem"),
    )


def sink_documents(events: DataFrame, plan: Plan) -> DataFrame:
    """Documents as a sink sends them: key, JSON body, _version, _is_deleted, and problem if any. A tombstone has no body, or, for a
    column store, the key's fields alone."""
    docs = split_key_changes(events, [c.name for c in plan.key])
    gone = plan.key_body("image") if plan.dialect == "store" else F.lit(None).cast("string")
    return docs.select(
        plan.key_of("image").alias("key"),
        F.when(F.col("deleted"), gone).otherwise(plan.body("image")).alias("body"),
        F.col("seq").alias("_version"),
        F.col("deleted").alias("_is_deleted"),
        F.when(~F.col("deleted"), plan.problem("image")).otherwise(F.when(plan.key_of("image").isNull(), F.lit("null in the key"))).alias("problem"),
    )


def tombstones(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key fields, version and delete mark of everything that must go."""
    gone = split_key_changes(events, key).where("deleted")
    return gone.select(*(F.col(f"image.{k}").alias(k) for k in key), F.col("seq").alias("_version"), F.col("deleted").alias("_is_deleted"))


def watched(events: DataFrame, tables: Sequence[str], table: str = "table") -> DataFrame:
    """Events of the watched tables, whatever the case of the names."""
    return events.where(F.lower(F.col(table)).isin([t.lower() for t in tables]))


def fan_out(events: DataFrame, streams: DataFrame, table: str = "table") -> DataFrame:
    """Every event once for each stream (stream, table) on its table; streams is a short configured list."""
    routes = F.broadcast(streams.select("stream", F.lower("table").alias("__t")))
    return events.join(routes, F.lower(F.col(table)) == F.col("__t")).drop("__t")


def update_diff(before: str, after: str, fields: Sequence[str]) -> Column:
    """Only the changed fields of an update, ``name: was -> now``, in field order."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NULL"))
    parts = [F.when(~F.col(f"{before}.{f}").eqNullSafe(F.col(f"{after}.{f}")), F.concat(F.lit(f"{f}: "), text(f"{before}.{f}"), F.lit(" -> "), text(f"{after}.{f}"))) for f in fields]
    return F.concat_ws(", ", *parts)


def readable(value: Column, column: SourceColumn | None = None, binary: bool = False) -> Column:
    """A raw value as a person reads it: labels of enums and sets, hexadecimal for bytes that are no UTF-8, NULL."""
    text = value.cast("string")
    if binary:
        text = F.when(F.is_valid_utf8(text), text).otherwise(F.concat(F.lit("0x"), F.lower(F.hex(value))))
    elif column is not None and column.members and column.data_type.lower() == "enum":
        number, label = value.cast("int"), enum_label(value, column.members)
        text = F.when(number == 0, F.lit("''")).otherwise(F.coalesce(label, text))
    elif column is not None and column.members:
        text = F.concat(F.lit("{"), F.array_join(set_members(value.cast("long"), column.members), ","), F.lit("}"))
    return F.coalesce(text, F.lit("NULL"))


def readable_images(events: DataFrame, columns: Mapping[str, SourceColumn]) -> DataFrame:
    """Events whose images hold readable text in every field."""
    fields = events.schema["after"].dataType.fields

    def image(c: str) -> Column:
        made = F.struct(*(readable(F.col(f"{c}.`{f.name}`"), columns.get(f.name.lower()), f.dataType.simpleString() == "binary").alias(f.name) for f in fields))
        return F.when(F.col(c).isNotNull(), made)

    return events.withColumns({c: image(c) for c in ("before", "after")})


def describe(events: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Readable lines for a diagnostic tail: whole images of inserts and deletes, differences of updates."""
    whole = lambda c: F.concat_ws(", ", *(F.concat(F.lit(f"{f}: "), F.coalesce(F.col(f"{c}.{f}").cast("string"), F.lit("NULL"))) for f in fields))
    line = F.when(F.col("op") == UPDATE, update_diff("before", "after", fields)).when(F.col("op") == DELETE, whole("before")).otherwise(whole("after"))
    return events.select("op", "seq", line.alias("line"))


def pair_updates(rows: DataFrame, group: Sequence[str], position: str, image: str) -> DataFrame:
    """Update rows that come as before, after, before, ... joined to one row for each pair."""
    place = F.floor(F.col(position) / 2)
    return (
        rows.groupBy(*group, place.alias("pair"))
        .agg(F.min_by(image, position).alias("before"), F.max_by(image, position).alias("after"))
    )
