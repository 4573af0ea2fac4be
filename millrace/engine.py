"""The engine's control surface: run, status, schemas, rebuilds, preflight and a diagnostic tail.

Sources are table folders and change-log folders; a stream named in the configuration reads ``<dsn>/<schema>.<table>/scan``
(Parquet) and ``.../log`` (change events), and writes below ``<checkpoint>/<stream>`` or delivers to its sink. Beside a log,
``log.ddl.json`` may hold the statements that came with it, and ``log.purged.json`` how much of it is gone.
"""

from __future__ import annotations

import functools
import json
import os
import threading
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.kinds import map_column
from millrace.functions.text import parse_duration, parse_size
from millrace.operators.batching import dlq_count
from millrace.operators.changes import describe, readable_images
from millrace.operators.status import alerts, healthy
from millrace.plans import preflight, schema_gen
from millrace.plans.config import Config, StreamSettings
from millrace.plans.mapping import Plan, Table, compile_plan
from millrace.sources import catalog, changelog, snapshot
from millrace.streaming import pipeline, versions
from millrace.streaming.metrics import Metrics, serve
from millrace.streaming.sinks import Delivery, Transport, http
from millrace.streaming.storage import Files, StreamLock

STATUS = "stream string, position string, snapshot_done boolean, rows_done long, rows_total long, progress double, last_event_ms long, lag_seconds double, age_seconds double, last_error string"
#: Chunks that a scan is cut into at most; a table of more rows has larger ones.
MOST_CHUNKS = 200


class Engine:
    def __init__(self, spark: SparkSession, config: Config, tables: Mapping[str, Table] | None = None, transport: Transport = http, sleep: Callable[[float], None] = time.sleep):
        self.spark, self.config, self.files = spark, config, Files(spark)
        self.store = versions.FileStore(self.files, f"{config.checkpoint}/_checkpoints")
        self.catalog = catalog.Catalog(self._load)
        self.tables = {k.lower(): v for k, v in (tables or {}).items()}
        self.metrics, self.transport, self.sleep, self.stopping = Metrics(), transport, sleep, threading.Event()
        self.address: str | None = None  # where the health endpoints answer, while it runs

    def _folder(self, table: str, what: str) -> str:
        """Scans may come from a replica of their own."""
        source = self.config.source
        return f"{source.snapshot_dsn if what == 'scan' and source.snapshot_dsn else source.dsn}/{table}/{what}"

    def _load(self, schema: str, name: str) -> Table:
        if known := self.tables.get(f"{schema}.{name}".lower()):
            return known
        scan = self.spark.read.option("mergeSchema", "true").parquet(self._folder(f"{schema}.{name}", "scan"))
        return catalog.from_dataframe(scan, schema, name, scan.columns[:1])

    def plan(self, name: str) -> Plan:
        s = self.config.selected([name])[0][1]
        schema, table = s.table.split(".")
        dialect = "index" if s.sink.type == "index" else "store"
        return compile_plan(self.catalog.get(schema, table), s.mapping.mapping(), self.config.source.time_zone, s.mapping.zero_date, dialect)

    def stream(self, name: str) -> pipeline.Stream:
        s, to = self.config.selected([name])[0][1], None
        if s.sink.type != "table":
            to = Delivery(s.sink.type, s.sink.target, tuple(s.sink.addresses), s.sink.database, s.sink.user, s.sink.password, s.sink.workers, s.batch.rows, parse_size(s.batch.bytes), self.transport)
        return pipeline.Stream(name, self.plan(name), self.config.checkpoint, delivery=to)

    def _lock(self, name: str) -> StreamLock:
        return StreamLock(self.files, f"{self.config.checkpoint}/{name}.lock", f"process {os.getpid()}")

    def stop(self) -> None:
        """Let the running streams finish what has arrived, and end."""
        self.stopping.set()

    def run(self, streams: Sequence[str] | None = None, follow: bool = False) -> None:
        """Backfill what has not been scanned yet, then apply the change logs: until caught up, or with ``follow`` until stop().

        One failure stops all. While it runs, /metrics, /healthz, /readyz and /streams answer at the configured address.
        """
        self.spark.streams.addListener(self.metrics)
        self.stopping.clear()
        host, _, port = self.config.runtime.metrics.rpartition(":")
        server = serve(self.metrics, host or "127.0.0.1", int(port)) if port else None
        self.address = "{}:{}".format(*server.server_address) if server else None
        chosen, locks, queries = self.config.selected(list(streams) if streams else None), [], []
        try:
            for name, s in chosen:
                locks.append(self._lock(name).__enter__())
                row = self.store.load(name) or versions.Checkpoint(name)
                try:
                    log = self._folder(s.table, "log")
                    row = self._defined(row, s.table, log)
                    stream = self.stream(name)
                    self._checked(stream)
                    if row.position:
                        changelog.check_purged(self.files, log, int(row.position))
                    if versions.resume_decision(row, s.snapshot.enabled) in ("scan", "resume_scan"):
                        row = self._scan(stream, s, row, log)
                    row = versions.replace(row, position=row.position or "0", last_error="")
                    self.store.save(row)  # before the query, whose batches save it too
                    if self.files.exists(log):
                        image, timed = changelog.read_image(self.spark, log), changelog.is_timed(self.spark, log)
                        events = changelog.stream_log(self.spark, log, image, timed=timed)
                        queries.append(pipeline.run(stream, events, not follow, f"{int(parse_duration(s.batch.interval) * 1000)} milliseconds", functools.partial(self._applied, name)))
                except Exception as e:
                    self.store.save(versions.replace(self.store.load(name) or row, last_error=str(e)[:1000]))
                    raise
            try:
                pipeline.run_all(self.spark, queries, self.stopping.is_set, parse_duration(self.config.runtime.grace))
            except Exception as e:
                for q in queries:
                    if q.exception():
                        self.store.save(versions.replace(self.store.load(q.name) or versions.Checkpoint(q.name), last_error=str(e)[:1000]))
                raise
        finally:
            for lock in locks:
                lock.__exit__()
            self.spark.streams.removeListener(self.metrics)
            if server:
                server.shutdown()
                server.server_close()

    def _applied(self, name: str, counts: dict) -> None:
        """After each batch: how far the stream has come. The offset itself is the query's, which commits it next."""
        self.metrics.counted(name, counts)
        row = self.store.load(name) or versions.Checkpoint(name)
        position = max(int(row.position or 0), counts["version"] or 0)
        self.store.save(versions.replace(row, position=str(position), last_event_ms=max(row.last_event_ms or 0, counts.get("event_ms") or 0) or None, last_error=""))

    def _defined(self, row: versions.Checkpoint, table: str, log: str) -> versions.Checkpoint:
        """Forget the definitions that statements since the last run may have changed."""
        for s in changelog.statements(self.files, log):
            if s["seq"] > row.ddl_seq:
                self.catalog.saw(s["statement"], s.get("schema", ""))
                row = versions.replace(row, ddl_seq=s["seq"])
        return row

    def _checked(self, stream: pipeline.Stream) -> None:
        """Before anything is written to an index: does its mapping hold what the stream sends? All faults are told at once."""
        if stream.delivery is None or stream.delivery.type != "index":
            return
        have = stream.delivery.sink().fields()
        if have is None:
            raise ValueError(f"index {stream.delivery.target} does not exist; create it from the schema command's output")
        faults = schema_gen.faults(schema_gen.expected_fields(stream.plan), have)
        if faults:
            raise ValueError(f"index {stream.delivery.target} does not fit: {'; '.join(faults)}")

    def _scan(self, stream: pipeline.Stream, s: StreamSettings, row: versions.Checkpoint, log: str) -> versions.Checkpoint:
        """Base version and start are stored before a row is read, so any later change beats the scanned copy; and the scanned copy
        beats what was stored before. The cursor is stored after each chunk, so a scan that is killed goes on from there."""
        folder = self._folder(s.table, "scan")
        if not row.snapshot_start:
            base = 1
            if row.scans:  # a new scan: above all that is stored, and all that the log held when it began
                top = changelog.read_log(self.spark, log, changelog.read_image(self.spark, log)).agg(F.max("seq")).head()[0] if self.files.exists(log) else 0
                kept = pipeline.versions(self.spark, stream).agg(F.max("_version")).head()[0] if self.files.exists(stream.path("table")) else 0
                base = max(top or 0, kept or 0, int(row.position or 0)) + 1
            total = self.spark.read.parquet(folder).count() if self.files.exists(folder) else 0
            row = versions.replace(row, snapshot_base=base, snapshot_start=row.position or "0", position=row.position or "0", snapshot_rows_total=total, seq_watermark=max(row.seq_watermark, base))
            self.store.save(row)
        if self.files.exists(folder):
            sink = stream.delivery.sink() if stream.delivery and stream.delivery.type == "index" and not row.scans else None  # an index that nobody reads yet
            interval = sink.begin_load() if sink else None
            try:
                row = self._chunks(stream, s, row, folder)
            finally:
                if sink:
                    sink.end_load(interval, merge=True)
        row = versions.replace(row, snapshot_done=True, snapshot_cursor="")
        self.store.save(row)
        return row

    def _chunks(self, stream: pipeline.Stream, s: StreamSettings, row: versions.Checkpoint, folder: str) -> versions.Checkpoint:
        table = stream.plan.table
        rows = self.spark.read.option("mergeSchema", "true").parquet(folder)
        have = {f.name.lower(): f for f in rows.schema.fields}
        if lost := sorted(c.name for c in stream.plan.key if c.name.lower() not in have):
            raise ValueError(f"the scan of {s.table} lacks key columns: {', '.join(lost)}")
        # columns that the scan does not have yet are null, those that the definition no longer has stay behind
        wanted = [(c.name, have[c.name.lower()].dataType.simpleString() if c.name.lower() in have else map_column(c).spark_type.simpleString()) for c in table.columns if not c.generated]
        rows = snapshot.normalised(snapshot.align_by_name(rows, wanted), table.columns)
        key, began = [c.name for c in stream.plan.key], time.monotonic()
        for part, cursor in snapshot.ranges(rows, key, s.snapshot.chunk_rows, row.snapshot_cursor or None, MOST_CHUNKS):
            counts = pipeline.backfill(self.spark, stream, snapshot.as_events(part, row.snapshot_base), row.scans * 1_000_000 + row.snapshot_chunks)
            self.metrics.counted(stream.name, counts)
            row = versions.replace(row, snapshot_cursor=cursor or row.snapshot_cursor, snapshot_chunks=row.snapshot_chunks + 1, snapshot_rows_done=row.snapshot_rows_done + counts["total"])
            self.store.save(row)
            rate = s.snapshot.rows_per_second
            if cursor and rate and (wait := counts["total"] / rate - (time.monotonic() - began)) > 0:
                self.sleep(wait)
            began = time.monotonic()  # finding the next range and storing its cursor count as well, but no time is saved up
        return row

    def view(self, name: str) -> DataFrame:
        """The stream's living documents, to query freely; a stream that goes to a sink is read there."""
        if self.config.selected([name])[0][1].sink.type != "table":
            raise ValueError(f"{name} goes to a sink; ask that")
        return pipeline.view(self.spark, self.stream(name))

    def status(self, streams: Sequence[str] | None = None) -> DataFrame:
        """A row for each stream; healthy if it has no error and is not far behind."""
        now, data = time.time_ns() // 1_000_000, []
        for name, _ in self.config.selected(list(streams) if streams else None):
            r = self.store.load(name) or versions.Checkpoint(name)
            progress = 1.0 if r.snapshot_done else min(1.0, r.snapshot_rows_done / r.snapshot_rows_total) if r.snapshot_rows_total else None
            data.append((name, r.position, r.snapshot_done, r.snapshot_rows_done, r.snapshot_rows_total, progress, r.last_event_ms, r.lag_seconds(now), (now - r.saved_ms) / 1000 if r.saved_ms else None, r.last_error))
        out = self.spark.createDataFrame(data, STATUS)
        return out.withColumn("healthy", healthy(F.col("last_error"), F.col("lag_seconds")))

    def unhealthy(self) -> DataFrame:
        return self.status().where("NOT healthy")

    def alerts(self) -> DataFrame:
        """Alert rules that fire now, by what the streams' state and this process's batches show."""
        rows = []
        for r in self.status().collect():  # a row for each stream
            seen = self.metrics.streams.get(r["stream"], {})
            found = {"lag_seconds": r["lag_seconds"], "checkpoint_age_seconds": r["age_seconds"], "dead_letters_increase": seen.get("rejected")}
            rows += [(r["stream"], metric, float(value)) for metric, value in found.items() if value is not None]
        return alerts(self.spark.createDataFrame(rows, "stream string, metric string, value double"))

    def dead_letters(self, name: str) -> DataFrame | None:
        """Dead letters of a stream, read strictly: a corrupt line is an error."""
        path = f"{self.config.checkpoint}/{name}/dlq"
        return self.spark.read.option("mode", "FAILFAST").json(path) if self.files.exists(path) else None

    def dead_letter_count(self, name: str) -> int:
        letters = self.dead_letters(name)
        return 0 if letters is None else sum(r["records"] for r in dlq_count(letters).collect())  # a row for each stream

    def generate_schema(self, name: str, shards: int = 1, replicas: int = 1) -> tuple[str, list[str]]:
        s, plan = self.config.selected([name])[0][1], self.plan(name)
        if s.sink.type == "index":
            return schema_gen.index_mapping(plan, shards, replicas)
        if s.sink.type == "store":
            return schema_gen.store_ddl(plan, s.sink.database)
        return schema_gen.spark_ddl(plan, s.sink.target.replace("/", "_").strip("_"), pipeline.Stream(name, plan, self.config.checkpoint).path("table")), []

    def resnapshot(self, name: str, confirm: bool = False) -> None:
        """Forget the scan, so that the next run makes it again, under a version above all that is stored; the position stays."""
        if not confirm:
            raise ValueError("a new scan rewrites the whole table; confirm it")
        with self._lock(name):
            row = self.store.load(name)
            if row is None:
                raise ValueError(f"{name} has never run")
            self.store.save(row.without_scan())

    def rebuild(self, name: str, generation: int) -> DataFrame:
        """Compact all that is stored and let readers have that, and what comes after it."""
        with self._lock(name):
            return pipeline.rebuild(self.spark, self.stream(name), generation=generation)

    def tail(self, table: str) -> DataFrame:
        """Readable lines of a table's change log."""
        log = self._folder(table, "log")
        image = changelog.read_image(self.spark, log)
        columns = {c.name.lower(): c for c in self.catalog.get(*table.split(".")).columns}
        return describe(readable_images(changelog.read_log(self.spark, log, image), columns), image.fieldNames())

    def capture(self, table: str, path: str) -> int:
        """Copy a table's raw change events to a folder as JSON lines, with a manifest of what they are; returns their number."""
        log = self._folder(table, "log")
        image = changelog.read_image(self.spark, log)
        events = changelog.read_log(self.spark, log, image)
        events.write.mode("overwrite").json(f"{path}/events")
        n, low, high = self.spark.read.schema(events.schema).json(f"{path}/events").agg(F.count("*"), F.min("seq"), F.max("seq")).head()
        self.files.replace(f"{path}/manifest.json", json.dumps({"table": table, "events": n, "first": low, "last": high, "image": image.simpleString()}))
        return n

    @staticmethod
    def preflight(variables: Mapping[str, str], grants: Sequence[str]) -> list[preflight.Check]:
        return preflight.evaluate(variables, grants)
