"""Table scans in key order: whole, in chunks after a cursor, and normalised to the change log's value shapes."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.encode import enum_ordinal, set_bitmask, time_of_day_micros
from millrace.functions.kinds import Kind, Mapped, map_column
from millrace.functions.kinds import Column as SourceColumn

CHUNK_ROWS, ROWS_PER_SECOND = 5000, 20_000


def after(key: Sequence[str], last: Sequence) -> Column:
    """Rows beyond a key, as ANDs and ORs that the Parquet reader takes as filters (a comparison of structs is not)."""
    out = None
    for i in range(len(key)):
        term = F.col(key[i]) > F.lit(last[i])
        for k in range(i):
            term = (F.col(key[k]) == F.lit(last[k])) & term
        out = term if out is None else out | term
    # implied, and a range on the leading column that prunes row groups
    return (F.col(key[0]) >= F.lit(last[0])) & out if len(key) > 1 else out


def chunk(table: DataFrame, key: Sequence[str], last: Sequence | None, rows: int = CHUNK_ROWS) -> DataFrame:
    """The next rows in key order."""
    rest = table if last is None else table.where(after(key, last))
    return rest.orderBy(*key).limit(rows)


def cursor(key: Sequence[str]) -> Column:
    """A row's place in the scan: JSON array of its key's texts."""
    return F.to_json(F.array(*(F.col(k).cast("string") for k in key)))


def read_cursor(text: str, arity: int) -> list[str]:
    parts = json.loads(text)
    if not isinstance(parts, list) or len(parts) != arity or not all(isinstance(p, str) for p in parts):
        raise ValueError(f"not a cursor of {arity} key columns: {text!r}")
    return parts


def last_of(rows: DataFrame, key: Sequence[str]) -> str | None:
    """Cursor of the chunk's last row."""
    found = rows.select(F.max(F.struct(*key)).alias("k")).select(F.to_json(F.array(*(F.col(f"k.{k}").cast("string") for k in key))).alias("c"), "k").head()
    return None if found["k"] is None else found["c"]


def chunks(table: DataFrame, key: Sequence[str], rows: int = CHUNK_ROWS, start: str | None = None, rate: float | None = None, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> Iterator[tuple[DataFrame, str, int]]:
    """(chunk, cursor after it, its rows) until an empty or short chunk; held to ``rate`` rows a second.

    The loop is the resumable form for live sources; a file-backed table is scanned whole, in parallel.
    """
    types = [table.schema[k].dataType for k in key]
    last = start
    while True:
        began = clock()
        values = None if last is None else [F.lit(v).cast(t) for v, t in zip(read_cursor(last, len(key)), types)]
        part = chunk(table, key, values, rows).persist()
        try:
            n = part.count()
            if not n:
                return
            last = last_of(part, key)
            yield part, last, n
        finally:
            part.unpersist()
        if n < rows:
            return
        if rate and (wait := n / rate - (clock() - began)) > 0:
            sleep(wait)


def boundaries(table: DataFrame, key: Sequence[str], parts: int) -> list[tuple[tuple, str]]:
    """Upper keys, with their cursors, of at most so many ranges of about equal size, but for the last, which has none."""
    if parts < 2:
        return []
    tops = table.select(*key).repartitionByRange(parts, *key).groupBy(F.spark_partition_id().alias("p")).agg(F.max(F.struct(*key)).alias("k"))
    found = tops.select("p", "k", F.to_json(F.array(*(F.col(f"k.`{k}`").cast("string") for k in key))).alias("c")).orderBy("p").collect()
    return [(tuple(r["k"]), r["c"]) for r in found[:-1]]  # a row for each range


def ranges(table: DataFrame, key: Sequence[str], rows: int, start: str | None = None, most: int = 200) -> Iterator[tuple[DataFrame, str | None]]:
    """(rows of the next key range, cursor after it), each of about ``rows`` rows, or more if that were over ``most`` ranges.

    Each range is read in parallel; a scan that stops goes on after the last cursor. The last range has no cursor.
    """
    types = [table.schema[k].dataType for k in key]
    typed = lambda values: [F.lit(v).cast(t) for v, t in zip(values, types)]
    rest = table if start is None else table.where(after(key, typed(read_cursor(start, len(key)))))
    n, last = rest.count(), None
    for top, text in boundaries(rest, key, -(-n // max(rows, -(-n // most)))):
        part = rest if last is None else rest.where(after(key, typed(last)))
        yield part.where(~after(key, typed(top))), text
        last = top
    yield rest if last is None else rest.where(after(key, typed(last))), None


def normalised(rows: DataFrame, columns: Sequence[SourceColumn]) -> DataFrame:
    """Scanned rows in the change log's shape: text of enums, sets and times of day as numbers."""
    have = {f.name.lower(): f for f in rows.schema.fields}
    out = {}
    for c in columns:
        f = have.get(c.name.lower())
        if f is not None and f.dataType.simpleString() == "string" and c.data_type.lower() in ("enum", "set", "time"):
            out[f.name] = normalise(c, map_column(c), F.col(f"`{f.name}`"))
    return rows.withColumns(out) if out else rows


def normalise(col: SourceColumn, mapped: Mapped, text: Column) -> Column:
    """A scanned value in the shape that the change log has: labels to numbers, set text to bits, times of day kept."""
    if mapped.kind == Kind.ENUM:
        return enum_ordinal(text, col.members)
    if mapped.kind == Kind.SET:
        return set_bitmask(text, col.members)
    if mapped.kind == Kind.TIME:
        return time_of_day_micros(text)
    if mapped.kind in (Kind.DATE, Kind.DATETIME, Kind.TIMESTAMP, Kind.STRING, Kind.JSON):
        return text.cast("string")
    if mapped.kind == Kind.BYTES:
        return text.cast("binary")
    if mapped.kind == Kind.BOOL:
        return text.cast("int")
    return text.cast(mapped.spark_type)


def align_by_name(rows: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows under a newer definition (name, type): by name, missing columns null, dropped ones left out."""
    have = {c.lower(): c for c in rows.columns}
    return rows.select(*((F.col(f"`{have[n.lower()]}`") if n.lower() in have else F.lit(None)).cast(t).alias(n) for n, t in columns))


def as_events(rows: DataFrame, base_version: int) -> DataFrame:
    """Scan rows as snapshot events under one version below all later changes."""
    image = F.struct(*rows.columns)
    empty = F.lit(None).cast(rows.select(image.alias("x")).schema["x"].dataType)
    return rows.select(F.lit("snapshot").alias("op"), empty.alias("before"), image.alias("after"), F.lit(base_version).cast("long").alias("seq"))
