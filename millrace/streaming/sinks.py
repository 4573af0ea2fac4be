"""Writers to HTTP destinations, for use inside foreachBatch on small batches; transports are injected.

A transport takes (address, path, headers, body) and returns (status, body); the header ``:method`` names a method other than
POST. Tasks call it, so it must be a function that can be shipped to them.
"""

from __future__ import annotations

import base64
import gzip
import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple, Protocol

import pandas as pd
from pyspark.sql import DataFrame

from millrace.functions.text import backoff, shorten

Transport = Callable[[str, str, dict, bytes], tuple[int, bytes]]


class Doc(NamedTuple):
    key: str
    body: str | None
    version: int
    deleted: bool = False


class Rejection(NamedTuple):
    doc: Doc
    status: int
    reason: str


@dataclass
class Result:
    applied: int = 0
    stale: int = 0
    rejected: list[Rejection] = field(default_factory=list)

    @property
    def total(self) -> int:
        return self.applied + self.stale + len(self.rejected)

    def add(self, other: Result) -> Result:
        return Result(self.applied + other.applied, self.stale + other.stale, self.rejected + other.rejected)


class Sink(Protocol):
    def write(self, docs: Sequence[Doc]) -> Result: ...

    def close(self) -> None: ...


class SinkError(RuntimeError):
    pass


def http(address: str, path: str, headers: dict, body: bytes, timeout: float = 120.0) -> tuple[int, bytes]:
    """The transport of real runs."""
    headers = dict(headers)
    method = headers.pop(":method", "POST")
    url = (address if "://" in address else f"http://{address}").rstrip("/") + urllib.request.quote(path, safe="/?=&%")
    request = urllib.request.Request(url, data=None if method == "GET" else body, headers=headers, method=method)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status, answer.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


class _Http:
    """Addresses in turn, gzip bodies, basic authentication."""

    def __init__(self, addresses: Sequence[str], transport: Transport, user: str = "", password: str = "", attempts: int = 5, sleep: Callable[[float], None] = time.sleep):
        if not addresses:
            raise ValueError("a sink needs an address")
        self.addresses, self.transport, self.attempts, self.sleep, self.turn = list(addresses), transport, attempts, sleep, 0
        self.headers = {"Content-Encoding": "gzip"}
        if user:
            self.headers["Authorization"] = "Basic " + base64.b64encode(f"{user}:{password}".encode()).decode()

    def call(self, method: str, path: str, body: str = "", kind: str = "application/json") -> tuple[int, bytes]:
        """One request whose failure is the caller's to judge."""
        address = self.addresses[self.turn % len(self.addresses)]
        self.turn += 1
        headers = {k: v for k, v in self.headers.items() if k != "Content-Encoding"}
        return self.transport(address, path, {**headers, "Content-Type": kind, ":method": method}, body.encode())

    def post(self, path: str, body: str, kind: str) -> tuple[int, bytes]:
        address = self.addresses[self.turn % len(self.addresses)]
        self.turn += 1
        try:
            return self.transport(address, path, {**self.headers, "Content-Type": kind}, gzip.compress(body.encode()))
        except OSError as e:
            return 503, str(e).encode()

    def wait(self, attempt: int) -> None:
        self.sleep(backoff(attempt, jitter=random.random))

    def close(self) -> None:
        pass


class IndexSink(_Http):
    """Bulk upserts and deletes under external versions."""

    def __init__(self, index: str, *args, **kwargs):
        super().__init__(*args, **kwargs)
        self.index = index

    def lines(self, docs: Sequence[Doc]) -> str:
        out = []
        for d in docs:
            action = {"_index": self.index, "_id": d.key, "version": d.version, "version_type": "external"}
            out.append(json.dumps({"delete" if d.deleted else "index": action}, ensure_ascii=False, separators=(",", ":")))
            if not d.deleted:
                out.append(d.body or "{}")
        return "\n".join(out) + "\n" if out else ""

    def write(self, docs: Sequence[Doc]) -> Result:
        """Only what is still pending is sent again; a body that is too large is halved."""
        result, pending = Result(), list(docs)
        for attempt in range(self.attempts):
            if not pending:
                break
            if attempt:
                self.wait(attempt - 1)
            status, body = self.post("/_bulk", self.lines(pending), "application/x-ndjson")
            if status == 413:
                if len(pending) == 1:  # the cluster's limit is wrong for this table, which no dead letter mends
                    raise SinkError(f"{pending[0].key} alone is larger than the request limit")
                half = len(pending) // 2
                return result.add(self.write(pending[:half])).add(self.write(pending[half:]))
            if status == 429 or status >= 500:
                continue
            if not 200 <= status < 300:
                raise SinkError(f"bulk request refused with {status}: {shorten(body.decode(errors='replace'), 300)}")
            items = json.loads(body)["items"]
            if len(items) != len(pending):
                raise SinkError(f"{len(items)} answers to {len(pending)} documents")
            again = []
            for doc, item in zip(pending, items):
                answer = next(iter(item.values()))
                code = answer["status"]
                if 200 <= code < 300:
                    result.applied += 1
                elif code == 409 or (code == 404 and doc.deleted):
                    result.stale += 1
                elif code == 429 or code >= 500:
                    again.append(doc)
                else:
                    result.rejected.append(Rejection(doc, code, shorten(json.dumps(answer.get("error", ""), ensure_ascii=False), 300)))
            pending = again
        if pending:
            raise SinkError(f"{len(pending)} documents still refused after {self.attempts} attempts")
        return result

    def fields(self) -> dict[str, str] | None:
        """Types of the index's fields, or of the index behind an alias; None if there is none."""
        status, body = self.call("GET", f"/{self.index}/_mapping")
        if status == 404:
            return None
        if status >= 300:
            raise SinkError(f"mapping of {self.index}: {status}: {shorten(body.decode(errors='replace'), 300)}")
        found = next(iter(json.loads(body).values()), {}).get("mappings", {}).get("properties", {})
        with_keyword = lambda f: "text_with_keyword" if f.get("type") == "text" and "keyword" in f.get("fields", {}) else f.get("type", "object")
        return {name: with_keyword(f) for name, f in found.items()}

    def _settings(self, interval: str | None) -> None:
        status, body = self.call("PUT", f"/{self.index}/_settings", json.dumps({"index": {"refresh_interval": interval}}))
        if status >= 300:
            raise SinkError(f"settings of {self.index}: {status}: {shorten(body.decode(errors='replace'), 300)}")

    def begin_load(self) -> str | None:
        """Stop refreshing while a scan runs; returns the interval to put back. For an index that nobody reads yet."""
        status, body = self.call("GET", f"/{self.index}/_settings")
        if status >= 300:
            raise SinkError(f"settings of {self.index}: {status}: {shorten(body.decode(errors='replace'), 300)}")
        found = next(iter(json.loads(body).values()), {}).get("settings", {}).get("index", {}).get("refresh_interval")
        self._settings("-1")
        return None if found in ("-1", -1) else found  # left so by a run that was killed

    def end_load(self, interval: str | None, merge: bool = False) -> None:
        """Put the interval back (none is the server's default), then show the rows; merging segments may fail harmlessly."""
        self._settings(interval)
        status, body = self.call("POST", f"/{self.index}/_refresh")
        if status >= 300:
            raise SinkError(f"refresh of {self.index}: {status}: {shorten(body.decode(errors='replace'), 300)}")
        if merge:
            self.call("POST", f"/{self.index}/_forcemerge?max_num_segments=1")


class StoreSink(_Http):
    """Inserts of JSON rows with _version and _is_deleted; a refused batch is halved until the bad rows stand alone."""

    DEPTH = 12

    def __init__(self, table: str, *args, database: str = "", **kwargs):
        super().__init__(*args, **kwargs)
        self.table = f"{database}.{table}" if database and "." not in table else table

    def rows(self, docs: Sequence[Doc]) -> str:
        out = []
        for d in docs:
            if not d.body:
                raise SinkError(f"{d.key}: a column store needs the key fields in a tombstone")
            inner = d.body.strip()[1:-1].strip()
            marks = f'"_version":{d.version},"_is_deleted":{int(d.deleted)}'
            out.append("{" + (inner + "," if inner else "") + marks + "}")
        return "\n".join(out) + "\n"

    @staticmethod
    def token(docs: Sequence[Doc]) -> str:
        return f"{docs[0].key}-{docs[0].version}-{docs[-1].version}-{len(docs)}"

    def write(self, docs: Sequence[Doc], depth: int = 0) -> Result:
        if not docs:
            return Result()
        path = f"/?query=INSERT INTO {self.table} FORMAT JSONEachRow&insert_deduplication_token={self.token(docs)}"
        status, body = 0, b""
        for attempt in range(self.attempts):
            if attempt:
                self.wait(attempt - 1)
            status, body = self.post(path, self.rows(docs), "application/json")
            if status != 429 and status < 500:
                break
        else:
            raise SinkError(f"insert still refused with {status} after {self.attempts} attempts")
        if 200 <= status < 300:
            return Result(applied=len(docs))
        if len(docs) == 1:
            return Result(rejected=[Rejection(docs[0], status, shorten(body.decode(errors="replace"), 300))])
        if depth >= self.DEPTH:  # not one bad row but a fault of them all, such as a missing column
            raise SinkError(f"{len(docs)} rows refused with {status} after {depth} divisions: {shorten(body.decode(errors='replace'), 300)}")
        half = len(docs) // 2
        return self.write(docs[:half], depth + 1).add(self.write(docs[half:], depth + 1))


def batches(docs: Iterator[Doc], rows: int, size: int) -> Iterator[list[Doc]]:
    """Documents as batches of at most so many rows and bytes; one that is larger alone goes with what is pending."""
    held, n = [], 0
    for doc in docs:
        own = len(doc.key.encode()) + len((doc.body or "").encode())
        if held and n + own > size and own < size:
            yield held
            held, n = [], 0
        held.append(doc)
        n += own
        if len(held) >= rows or n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


@dataclass(frozen=True)
class Delivery:
    """Where and how a stream's documents go: settings of the destination, and limits of a batch."""

    type: str
    target: str
    addresses: tuple[str, ...]
    database: str = ""
    user: str = ""
    password: str = ""
    workers: int = 4
    rows: int = 1000
    bytes: int = 5 << 20
    transport: Transport = http

    def sink(self) -> IndexSink | StoreSink:
        rest = (self.addresses, self.transport, self.user, self.password)
        if self.type == "index":
            return IndexSink(self.target, *rest)
        if self.type == "store":
            return StoreSink(self.target, *rest, database=self.database)
        raise ValueError(f"no sink of type {self.type!r}")


OUTCOME = "applied long, stale long, key string, _version long, _is_deleted boolean, status int, reason string, body string"


def deliver(docs: DataFrame, to: Delivery) -> DataFrame:
    """Send documents (key, body, _version, _is_deleted) and return what became of them: a row of counts for each batch, and
    a row for each refused document.

    Documents of one key go through one task in order of version. A task that runs again sends its batches again, which
    versions and tokens make harmless.
    """

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sink = to.sink()

        def each() -> Iterator[Doc]:
            for f in frames:
                for key, body, version, gone in zip(f["key"], f["body"], f["_version"], f["_is_deleted"]):
                    yield Doc(key, body, int(version), bool(gone))

        for batch in batches(each(), to.rows, to.bytes):
            done = sink.write(batch)
            if done.total != len(batch):
                raise SinkError(f"{done.total} outcomes of {len(batch)} documents")
            rows = [(done.applied, done.stale, None, None, None, None, None, None)]
            rows += [(0, 0, r.doc.key, r.doc.version, r.doc.deleted, r.status, r.reason, r.doc.body) for r in done.rejected]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUTCOME.split(", ")]).astype({"_version": "Int64", "status": "Int32", "_is_deleted": "boolean"})
        sink.close()

    dealt = docs.select("key", "body", "_version", "_is_deleted").repartition(to.workers, "key").sortWithinPartitions("_version")
    return dealt.mapInPandas(send, OUTCOME)
