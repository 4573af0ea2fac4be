"""Versions that only grow, and the decision where a stream starts."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

BLOCK, PER_MS_BITS = 10_000, 10
SCHEMA_VERSION = 1


@dataclass(frozen=True)
class Checkpoint:
    """One stream's durable state."""

    stream: str
    position: str = ""
    snapshot_done: bool = False
    snapshot_start: str = ""
    snapshot_cursor: str = ""
    snapshot_base: int = 0
    snapshot_rows_done: int = 0
    snapshot_rows_total: int = 0
    seq_watermark: int = 0
    last_event_ms: int | None = None
    last_error: str = ""
    snapshot_chunks: int = 0
    scans: int = 0
    ddl_seq: int = 0
    saved_ms: int = 0
    schema_version: int = SCHEMA_VERSION

    def lag_seconds(self, now_ms: int) -> float | None:
        return None if self.last_event_ms is None else max(0.0, (now_ms - self.last_event_ms) / 1000)

    def without_scan(self) -> Checkpoint:
        """What a new scan starts from: the position stays, and the next scan writes batches of its own."""
        return replace(self, snapshot_done=False, snapshot_start="", snapshot_cursor="", snapshot_base=0, snapshot_rows_done=0, snapshot_rows_total=0, snapshot_chunks=0, scans=self.scans + 1)


@dataclass
class MemoryStore:
    """Checkpoints that last as long as the process; counts saves."""

    rows: dict[str, Checkpoint] = field(default_factory=dict)
    saves: int = 0

    def load(self, stream: str) -> Checkpoint | None:
        return self.rows.get(stream)

    def save(self, row: Checkpoint) -> None:
        if row.schema_version > SCHEMA_VERSION:
            raise RuntimeError(f"checkpoint of schema {row.schema_version}; this engine knows {SCHEMA_VERSION}")
        self.rows[row.stream], self.saves = row, self.saves + 1

    def list(self) -> list[Checkpoint]:
        return [self.rows[k] for k in sorted(self.rows)]


class FileStore(MemoryStore):
    """Checkpoints as one JSON file for each stream."""

    def __init__(self, files, path: str):
        super().__init__()
        self.files, self.path = files, path

    def load(self, stream: str) -> Checkpoint | None:

        text = self.files.read_text(f"{self.path}/{stream}.json")
        if text is None:
            return None
        row = Checkpoint(**json.loads(text))
        if row.schema_version > SCHEMA_VERSION:
            raise RuntimeError(f"checkpoint of schema {row.schema_version}; this engine knows {SCHEMA_VERSION}")
        self.rows[stream] = row
        return row

    def save(self, row: Checkpoint) -> None:
        row = replace(row, saved_ms=time.time_ns() // 1_000_000)
        super().save(row)
        self.files.replace(f"{self.path}/{row.stream}.json", json.dumps(asdict(row)))


def seq_floor(now_ms: int) -> int:
    return now_ms << PER_MS_BITS


class Allocator:
    """Reserves blocks of versions in the store before it hands any out, so that none is given twice, even after a crash."""

    def __init__(self, store: MemoryStore, stream: str, block: int = BLOCK, clock: Callable[[], int] = lambda: time.time_ns() // 1_000_000):
        self.store, self.stream, self.block, self.clock = store, stream, block, clock
        self.next_free = self.end = 0
        self.lock = threading.Lock()

    def next(self) -> int:
        with self.lock:
            if self.next_free >= self.end:
                row = self.store.load(self.stream) or Checkpoint(self.stream)
                start = max(row.seq_watermark + 1, seq_floor(self.clock()), self.end)
                self.store.save(replace(row, seq_watermark=start + self.block - 1))
                self.next_free, self.end = start, start + self.block
            out, self.next_free = self.next_free, self.next_free + 1
            return out


def resume_decision(row: Checkpoint | None, snapshot_enabled: bool) -> str:
    """``tail`` from the saved position, ``start_here`` at the current one, ``scan`` from the start or ``resume_scan``."""
    if row is not None and row.position and (row.snapshot_done or not snapshot_enabled):
        return "tail"
    if not snapshot_enabled:
        return "start_here"
    return "resume_scan" if row is not None and row.snapshot_cursor and row.snapshot_start else "scan"
