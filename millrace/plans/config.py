"""Configuration: strict YAML with environment references, defaults, and all faults reported at once."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping as MappingType
from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any, get_args, get_origin, get_type_hints

import yaml

from millrace.functions.text import expand, parse_duration, parse_size
from millrace.plans.mapping import RESERVED, Mapping

STREAM_NAME = re.compile(r"[a-zA-Z0-9_]{1,48}")


class ConfigError(ValueError):
    pass


@dataclass
class Source:
    dsn: str = ""
    snapshot_dsn: str = ""
    time_zone: str = "UTC"
    heartbeat: str = "5s"
    read_timeout: str = "90s"


@dataclass
class Runtime:
    buffer: int = 8192
    grace: str = "30s"
    metrics: str = "127.0.0.1:9187"
    row_bytes: str = "1KiB"
    memory_limit: str = ""


@dataclass
class Batch:
    rows: int = 1000
    bytes: str = "5MiB"
    interval: str = "500ms"


@dataclass
class Snapshot:
    enabled: bool = True
    chunk_rows: int = 5000
    rows_per_second: int = 20_000


@dataclass
class SinkSettings:
    type: str = ""
    addresses: list[str] = field(default_factory=list)
    target: str = ""
    database: str = ""
    user: str = ""
    password: str = ""
    workers: int = 4


@dataclass
class MappingSettings:
    key: list[str] = field(default_factory=list)
    include: list[str] = field(default_factory=list)
    exclude: list[str] = field(default_factory=list)
    rename: dict[str, str] = field(default_factory=dict)
    zero_date: str = "null"

    def mapping(self) -> Mapping:
        return Mapping(tuple(self.key), tuple(self.include), tuple(self.exclude), dict(self.rename))


@dataclass
class StreamSettings:
    table: str = ""
    sink: SinkSettings = field(default_factory=SinkSettings)
    mapping: MappingSettings = field(default_factory=MappingSettings)
    batch: Batch = field(default_factory=Batch)
    snapshot: Snapshot = field(default_factory=Snapshot)


@dataclass
class Config:
    source: Source = field(default_factory=Source)
    checkpoint: str = ""
    runtime: Runtime = field(default_factory=Runtime)
    streams: dict[str, StreamSettings] = field(default_factory=dict)

    def selected(self, names: list[str] | None = None) -> list[tuple[str, StreamSettings]]:
        """Streams in order of name."""
        if names and (unknown := sorted(set(names) - set(self.streams))):
            raise ConfigError(f"no such stream: {', '.join(unknown)}")
        return [(n, self.streams[n]) for n in sorted(names or self.streams)]

    def memory_bound(self) -> int:
        """Bytes that queues and batches can hold: every stream's buffer of rows, and a batch for each of its workers."""
        row = parse_size(self.runtime.row_bytes)
        return sum(self.runtime.buffer * row + s.sink.workers * parse_size(s.batch.bytes) for s in self.streams.values())


def _build(kind: Any, value: Any, at: str, faults: list[str]) -> Any:
    if is_dataclass(kind):
        if not isinstance(value, dict):
            faults.append(f"{at or 'the file'}: a mapping is wanted")
            return kind()
        known = {f.name for f in fields(kind)}
        faults += [f"{at}.{k}".lstrip(".") + ": unknown" for k in value if k not in known]
        hints = get_type_hints(kind)
        return kind(**{k: _build(hints[k], v, f"{at}.{k}".lstrip("."), faults) for k, v in value.items() if k in known and v is not None})
    if get_origin(kind) is dict:
        if not isinstance(value, dict):
            faults.append(f"{at}: a mapping is wanted")
            return {}
        return {str(k): _build(get_args(kind)[1], v, f"{at}.{k}", faults) for k, v in value.items()}
    if get_origin(kind) is list:
        return [str(x) for x in value] if isinstance(value, list) else [str(value)]
    if kind is bool:
        if not isinstance(value, bool):
            faults.append(f"{at}: true or false is wanted")
        return bool(value)
    if kind is int:
        try:
            return int(value)
        except (TypeError, ValueError):
            faults.append(f"{at}: a number is wanted")
            return 0
    return str(value)


def _check(c: Config, faults: list[str]) -> None:
    want = lambda ok, text: None if ok else faults.append(text)

    def tried(parse, text: str, at: str) -> None:
        try:
            parse(text)
        except ValueError as e:
            faults.append(f"{at}: {e}")

    want(c.source.dsn, "source.dsn: missing")
    want(c.checkpoint, "checkpoint: missing")
    want(c.streams, "streams: at least one is needed")
    want(c.runtime.buffer > 0, "runtime.buffer: must be positive")
    for at, text in (("source.heartbeat", c.source.heartbeat), ("source.read_timeout", c.source.read_timeout), ("runtime.grace", c.runtime.grace)):
        tried(parse_duration, text, at)
    tried(parse_size, c.runtime.row_bytes, "runtime.row_bytes")
    for name, s in c.streams.items():
        at = f"streams.{name}"
        want(STREAM_NAME.fullmatch(name), f"{at}: names have 1 to 48 letters, digits and underscores")
        want(s.table.count(".") == 1 and all(s.table.split(".")), f"{at}.table: schema.table is wanted")
        want(s.sink.type in ("index", "store", "table"), f"{at}.sink.type: index, store or table")
        want(s.sink.type == "table" or s.sink.addresses, f"{at}.sink.addresses: missing")
        want(s.sink.workers > 0, f"{at}.sink.workers: must be positive")
        want(s.batch.rows > 0, f"{at}.batch.rows: must be positive")
        tried(parse_size, s.batch.bytes, f"{at}.batch.bytes")
        tried(parse_duration, s.batch.interval, f"{at}.batch.interval")
        want(s.snapshot.chunk_rows > 0, f"{at}.snapshot.chunk_rows: must be positive")
        want(not (s.mapping.include and s.mapping.exclude), f"{at}.mapping: include and exclude cannot both be set")
        want(s.mapping.zero_date in ("null", "epoch", "error"), f"{at}.mapping.zero_date: null, epoch or error")
        targets = list(s.mapping.rename.values())
        want(all(targets), f"{at}.mapping.rename: empty name")
        want(len(set(targets)) == len(targets), f"{at}.mapping.rename: two columns get one name")
        want(not set(targets) & set(RESERVED), f"{at}.mapping.rename: {' and '.join(RESERVED)} are reserved")
    if not faults and c.runtime.memory_limit:
        limit = parse_size(c.runtime.memory_limit)
        want(c.memory_bound() <= limit, f"runtime.memory_limit: queues and batches may need {c.memory_bound()} bytes, the limit is {limit}")


def parse(text: str, env: MappingType[str, str] = os.environ) -> Config:
    faults: list[str] = []
    try:
        raw = yaml.safe_load(expand(text, env)) or {}
    except (yaml.YAMLError, ValueError) as e:
        raise ConfigError(str(e)) from None
    config = _build(Config, raw, "", faults)
    _check(config, faults)
    if faults:
        raise ConfigError("\n".join(faults))
    return config


class ConfigBuilder:
    """A configuration from code, written as YAML."""

    def __init__(self):
        self.raw: dict[str, Any] = {}

    def source(self, dsn: str, **more: Any) -> ConfigBuilder:
        self.raw["source"] = {"dsn": dsn, **more}
        return self

    def checkpoint(self, path: str) -> ConfigBuilder:
        self.raw["checkpoint"] = path
        return self

    def runtime(self, **settings: Any) -> ConfigBuilder:
        self.raw["runtime"] = settings
        return self

    def _stream(self, name: str, table: str, sink: dict, mapping: dict | None, more: dict) -> ConfigBuilder:
        self.raw.setdefault("streams", {})[name] = {"table": table, "sink": sink, **({"mapping": mapping} if mapping else {}), **more}
        return self

    def index_stream(self, name: str, table: str, addresses: list[str], index: str, mapping: dict | None = None, **more: Any) -> ConfigBuilder:
        return self._stream(name, table, {"type": "index", "addresses": addresses, "target": index}, mapping, more)

    def store_stream(self, name: str, table: str, addresses: list[str], target: str, database: str = "", mapping: dict | None = None, **more: Any) -> ConfigBuilder:
        return self._stream(name, table, {"type": "store", "addresses": addresses, "target": target, "database": database}, mapping, more)

    def table_stream(self, name: str, table: str, target: str, mapping: dict | None = None, **more: Any) -> ConfigBuilder:
        return self._stream(name, table, {"type": "table", "target": target}, mapping, more)

    def to_yaml(self) -> str:
        text = yaml.safe_dump(self.raw, sort_keys=False, allow_unicode=True)
        parse(text, {})
        return text

    def write_to(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            f.write(self.to_yaml())
