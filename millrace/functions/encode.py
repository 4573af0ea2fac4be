"""Value encoders as Catalyst expressions: no Python runs per row."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.kinds import PLAIN_CHARSETS, Kind, Mapped, UnsupportedColumn
from millrace.functions.kinds import Column as SourceColumn


class Encoded(NamedTuple):
    """A value and why it cannot be encoded (null if it can)."""

    value: Column
    problem: Column


def _fine(value: Column) -> Encoded:
    return Encoded(value, F.lit(None).cast("string"))


def _labels(labels: Sequence[str]) -> Column:
    return F.array(*map(F.lit, labels))


def bool_value(n: Column) -> Column:
    return n != 0


def enum_label(number: Column, labels: Sequence[str]) -> Column:
    """Label of a member number; 0 is the empty label; null out of range."""
    return F.when(number == 0, F.lit("")).when(number.between(1, len(labels)), F.get(_labels(labels), number.cast("int") - 1))


def enum_ordinal(label: Column, labels: Sequence[str]) -> Column:
    """Member number of a label; the empty label is 0 unless declared; null if unknown."""
    at = F.array_position(_labels(labels), label)
    return F.when(at > 0, at).when(label == "", F.lit(0).cast("long"))


def set_members(bits: Column, labels: Sequence[str]) -> Column:
    """Labels of the set bits in order of declaration; bits beyond the labels are ignored."""
    picked = F.transform(_labels(labels), lambda x, i: F.when(F.getbit(bits.cast("long"), i) == 1, x))
    return F.filter(picked, lambda x: x.isNotNull())


def set_bitmask(csv: Column, labels: Sequence[str]) -> Column:
    """Bitmask of comma-separated labels; the empty text is 0; null if a label is unknown."""
    names = _labels(labels)
    parts = F.split(csv, ",")
    known = F.forall(parts, lambda m: F.array_position(names, m) > 0)
    bit = lambda acc, m: acc.bitwiseOR(F.get(F.array(*(F.lit(1 << i).cast("long") if i < 63 else F.lit(-(1 << 63)).cast("long") for i in range(len(labels)))), (F.array_position(names, m) - 1).cast("int")))
    return F.when(csv == "", F.lit(0).cast("long")).when(known, F.aggregate(parts, F.lit(0).cast("long"), bit))


def unsigned64(n: Column) -> Column:
    """A signed 64-bit value read as unsigned: exact as decimal(20,0)."""
    wide = n.cast("decimal(20,0)")
    return F.when(n < 0, (wide + F.lit("18446744073709551616").cast("decimal(20,0)")).cast("decimal(20,0)")).otherwise(wide)


def decimal_text(n: Column) -> Column:
    """Fixed text at the value's own scale, trailing zeros kept."""
    return n.cast("string")


def base64_text(b: Column) -> Column:
    """Standard base64, padded and in one line."""
    return F.regexp_replace(F.base64(b), r"[\r\n]", "")


def latin1_text(b: Column, charset: str = "ISO-8859-1") -> Column:
    return F.decode(b, charset)


def json_value(text: Column) -> Column:
    """JSON kept as it stands; empty text is null."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("null"))


def is_zero_date(text: Column) -> Column:
    return text.startswith("0000-00-00")


def parse_wall_clock(text: Column) -> Column:
    """A time without zone from any accepted layout: date and time, date, or time of day alone; null otherwise."""
    dated = F.when(text.rlike(r"^\d{2}:\d{2}:\d{2}(\.\d{1,9})?$"), F.concat(F.lit("0000-01-01 "), text)).when(text.rlike(r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2}(\.\d{1,9})?)?$"), text)
    return dated.try_cast("timestamp_ntz")


def rfc3339(utc: Column) -> Column:
    """Text of a UTC wall clock: trailing zeros of the fraction go, with the dot if none is left."""
    text = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.?0+$", ""), F.lit("Z"))


def instant_text(text: Column, zone: str, zero_date: str = "null") -> Encoded:
    """RFC 3339 text in UTC of a wall clock in zone, under a zero-date policy: null, epoch or error."""
    if zero_date not in ("null", "epoch", "error"):
        raise ValueError(f"zero-date policy must be null, epoch or error, not {zero_date!r}")
    zero = is_zero_date(text)
    wall = parse_wall_clock(text)
    utc = wall if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    value = F.when(~zero, rfc3339(utc))
    if zero_date == "epoch":
        value = F.when(zero, F.lit("1970-01-01T00:00:00Z")).otherwise(value)
    problem = F.when(~zero & wall.isNull(), F.concat(F.lit("not a date or time: "), text))
    if zero_date == "error":
        problem = F.when(zero, F.lit("zero date")).otherwise(problem)
    return Encoded(value, problem)


def time_of_day_micros(text: Column) -> Column:
    """A signed duration ``[-]H+:MM:SS[.f]`` in microseconds."""
    part = lambda i: F.regexp_extract(text, r"^(-?)(\d+):(\d{2}):(\d{2})(?:\.(\d{1,6}))?$", i)
    ok = text.rlike(r"^-?\d+:\d{2}:\d{2}(\.\d{1,6})?$")
    whole = (part(2).try_cast("long") * 3600 + part(3).try_cast("long") * 60 + part(4).try_cast("long")) * 1_000_000
    total = whole + F.rpad(part(5), 6, "0").try_cast("long")
    return F.when(ok, F.when(part(1) == "-", -total).otherwise(total))


def bit_number(b: Column) -> Column:
    """A BIT value's big-endian bytes as a number."""
    return F.conv(F.hex(b), 16, 10).cast("decimal(20,0)")


def seq_floor(ts: Column) -> Column:
    """Smallest version of a millisecond: 1,024 of them to each."""
    return F.shiftleft(F.unix_millis(ts), 10)


def encode_column(col: SourceColumn, mapped: Mapped, raw: Column, zone: str = "UTC", zero_date: str = "null", quote_decimals: bool = True) -> Encoded:
    """The typed document value of a raw source value; null stays null without a problem."""
    kind = mapped.kind
    if kind == Kind.STRING:
        charset = col.charset.lower()
        if charset == "latin1":
            return _fine(latin1_text(raw.cast("binary")))
        if charset not in PLAIN_CHARSETS:
            raise UnsupportedColumn(f"{col.name}: charset {charset} cannot be converted")
        raw = raw.cast("binary")
        return Encoded(F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")), F.when(~F.is_valid_utf8(raw.cast("string")), F.concat(F.lit("not UTF-8: "), F.hex(raw))))
    if kind == Kind.BOOL:
        return _fine(bool_value(raw))
    if kind in (Kind.INT, Kind.YEAR, Kind.TIME):
        return _fine(raw.cast("long"))
    if kind == Kind.BIT:
        return _fine(raw.cast("decimal(20,0)"))
    if kind == Kind.UINT:
        wide = raw.cast("decimal(20,0)")
        return Encoded(F.when(wide >= 0, wide), F.when(wide < 0, F.lit("negative value of an unsigned column")))
    if kind == Kind.FLOAT:
        return _fine(raw.cast("float" if mapped.bits == 32 else "double"))
    if kind == Kind.DECIMAL:
        exact = raw.cast(mapped.spark_type)
        return _fine(decimal_text(exact) if quote_decimals else exact)
    if kind == Kind.ENUM:
        label = enum_label(raw, col.members)
        return Encoded(label, F.when(raw.isNotNull() & label.isNull(), F.concat(F.lit("no enum member "), raw.cast("string"))))
    if kind == Kind.SET:
        return _fine(F.when(raw.isNotNull(), set_members(raw, col.members)))
    if kind == Kind.JSON:
        return _fine(F.when(raw.isNotNull(), json_value(raw)))
    if kind == Kind.BYTES:
        return _fine(base64_text(raw.cast("binary")))
    if kind == Kind.DATE:
        whole = instant_text(raw.cast("string"), "UTC", zero_date)
        return Encoded(F.substring(whole.value, 1, 10), whole.problem)
    return instant_text(raw.cast("string"), "UTC" if kind == Kind.TIMESTAMP else zone, zero_date)


def json_document(fields: Sequence[tuple[str, Column, bool]]) -> Column:
    """A JSON object of (name, value, value is JSON already); nulls are written, never left out."""
    parts: list[Column] = []
    run: list[Column] = []

    def flush():
        if run:
            text = F.to_json(F.struct(*run), {"ignoreNullFields": "false"})
            parts.append(F.substring(text, F.lit(2), F.length(text) - 2))
            run.clear()

    for name, value, raw in fields:
        if raw:
            flush()
            parts.append(F.concat(F.lit(_json_string(name) + ":"), F.coalesce(value, F.lit("null"))))
        else:
            run.append(value.alias(name))
    flush()
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _json_string(text: str) -> str:
    return json.dumps(text, ensure_ascii=False)
