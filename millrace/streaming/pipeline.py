"""A stream from the change log to a versioned table or to a sink: one transform for scans and tails.

Every micro-batch is written below its own number, so a repeated batch overwrites itself, and versions come from the log,
so a repeated event changes nothing. The offset is committed only after the batch, its dead letters and its counts are
written. Counts are observed while a batch is written, so its rows are computed once.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.batching import BatchMismatch, dead_letters
from millrace.operators.changes import documents, sink_documents
from millrace.operators.merge import compact, final_view, latest
from millrace.plans.mapping import Plan
from millrace.streaming.sinks import Delivery, deliver
from millrace.streaming.storage import Alias, Files


@dataclass(frozen=True)
class Stream:
    """A stream's name, compiled mapping, folders below one root, and the sink if it does not go to a table."""

    name: str
    plan: Plan
    root: str
    dead_letters: bool = True
    delivery: Delivery | None = None

    def path(self, what: str) -> str:
        return f"{self.root}/{self.name}/{what}"


def write_batch(stream: Stream, events: DataFrame, batch: int) -> dict[str, int]:
    """Transform and write or deliver one micro-batch; returns its counts."""
    seen, done = Observation(), Observation()
    docs = (sink_documents if stream.delivery else documents)(events, stream.plan)
    timed = F.max("ts_ms") if "ts_ms" in events.columns else F.lit(None).cast("long")
    watched = docs.observe(seen, F.count(F.lit(1)).alias("total"), F.count("problem").alias("rejected"), F.max("_version").alias("version"))
    good = watched.where("problem IS NULL")
    if stream.delivery:
        # versions of one key that a later one of the same batch replaces need not travel
        last = latest(good, ["key"]).observe(done, F.count(F.lit(1)).alias("applied"))
        path = f"{stream.path('outcomes')}/batch={batch}"
        deliver(last, stream.delivery).write.mode("overwrite").parquet(path)
        outcomes = events.sparkSession.read.parquet(path)
        found = outcomes.agg(F.sum("applied").alias("applied"), F.sum("stale").alias("stale"), F.count("key").alias("refused")).head()
        applied, stale, refused = found["applied"] or 0, found["stale"] or 0, found["refused"]
        if applied + stale + refused != done.get["applied"]:
            raise BatchMismatch(f"batch {batch}: {applied} applied, {stale} stale and {refused} refused of {done.get['applied']}")
        letters = outcomes.where("key IS NOT NULL").select("key", "_version", "_is_deleted", "status", "reason", "body") if refused else None
    else:
        written = good.select("key", "doc.*", "_version", "_is_deleted").observe(done, F.count(F.lit(1)).alias("applied"))
        written.write.mode("overwrite").parquet(f"{stream.path('table')}/batch={batch}")
        applied, stale, refused, letters = done.get["applied"], 0, 0, None
        if applied + seen.get["rejected"] != seen.get["total"]:
            raise BatchMismatch(f"batch {batch}: {applied} written and {seen.get['rejected']} refused of {seen.get['total']}")
    counts = seen.get
    rejected = counts["rejected"] + refused
    if rejected and not stream.dead_letters:
        raise RuntimeError(f"{rejected} documents of batch {batch} cannot be written, and {stream.name} has no dead-letter log")
    if counts["rejected"]:
        bad = docs.where("problem IS NOT NULL").select("key", "_version", "_is_deleted", F.lit(None).cast("int").alias("status"), F.col("problem").alias("reason"), F.lit(None).cast("string").alias("body"))
        letters = bad if letters is None else letters.unionByName(bad)
    if letters is not None:
        dead_letters(letters, F.lit(stream.name), F.current_timestamp(), F.col("status")).write.mode("overwrite").json(f"{stream.path('dlq')}/batch={batch}")
    event_ms = events.agg(timed.alias("t")).head()["t"] if "ts_ms" in events.columns else None
    out = {"total": counts["total"], "applied": applied, "rejected": rejected, "version": counts["version"]}
    return out | ({"stale": stale} if stream.delivery else {}) | ({"event_ms": event_ms} if event_ms is not None else {})


def run(stream: Stream, events: DataFrame, available_now: bool = True, interval: str = "500 milliseconds", on_batch: Callable[[dict], None] | None = None) -> StreamingQuery:
    """Start the query; with available_now it ends when it has caught up, else a batch begins at each interval at the latest."""
    files = Files(events.sparkSession)

    def each(batch_df: DataFrame, batch_id: int) -> None:
        counts = write_batch(stream, batch_df, batch_id)
        files.replace(f"{stream.path('metrics')}/batch={batch_id}.json", json.dumps({"stream": stream.name, "batch": batch_id, **counts}))
        if on_batch:
            on_batch(counts)

    writer = events.writeStream.queryName(stream.name).option("checkpointLocation", stream.path("checkpoint")).foreachBatch(each)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def run_all(spark: SparkSession, queries: Sequence[StreamingQuery], stopped: Callable[[], bool] = lambda: False, grace: float = 30.0, poll: float = 0.1) -> None:
    """Wait for all; the first error, of whichever, stops the others and is raised.

    When ``stopped`` says so, the queries may finish what has arrived, for ``grace`` seconds in all, and end.
    """
    try:
        while any(q.isActive for q in queries):
            if failed := next((q for q in queries if not q.isActive and q.exception()), None):
                raise failed.exception()
            if stopped():
                until = time.monotonic() + grace
                for q in queries:
                    while q.isActive and q.status["isTriggerActive"] and time.monotonic() < until:
                        time.sleep(poll)
                return
            time.sleep(poll)
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def alias_of(spark: SparkSession, stream: Stream) -> Alias:
    return Alias(Files(spark), stream.path("alias.json"))


def versions(spark: SparkSession, stream: Stream) -> DataFrame:
    """All versions written so far, tombstones included. Columns that came or went with a new definition are null elsewhere."""
    path = stream.path("table")
    batches = sorted((int(n.removeprefix("batch=")) for n in Files(spark).names(path) if n.startswith("batch=")))
    if not batches:
        return spark.read.parquet(path)
    fields: dict[str, T.StructField] = {}
    for batch in (batches[-1], batches[0]):  # the latest definition, and the first: two footers are read, not all
        for f in spark.read.parquet(f"{path}/batch={batch}").schema.fields:
            fields.setdefault(f.name, f)
    return spark.read.schema(T.StructType([*fields.values(), T.StructField("batch", T.LongType())])).parquet(path)


def current(spark: SparkSession, stream: Stream) -> DataFrame:
    """The compacted copy that the alias points at, with the batches that came after it; all versions if there is none."""
    every, alias = versions(spark, stream), alias_of(spark, stream).info()
    if not alias:
        return every
    low, high = alias["batches"]
    later = every.where((F.col("batch") > high) | (F.col("batch") < low))  # a filter on folders, so old ones are not read
    return spark.read.parquet(alias["target"]).withColumn("batch", F.lit(low - 1).cast(every.schema["batch"].dataType)).unionByName(later, allowMissingColumns=True)


def view(spark: SparkSession, stream: Stream) -> DataFrame:
    """Living documents; of equal versions the one of the later batch."""
    return final_view(current(spark, stream), ["key"], F.col("batch"))


def backfill(spark: SparkSession, stream: Stream, scan: DataFrame, number: int = 0) -> dict[str, int]:
    """Write a scan, or its chunk of that number, as a batch below 0: of equal versions the tail's wins."""
    return write_batch(stream, scan, -1 - number)


def rebuild(spark: SparkSession, stream: Stream, alias: Alias | None = None, generation: int = 1) -> DataFrame:
    """Write a compacted copy and move the alias to it; until the copy is complete, readers keep the old one."""
    alias, files = alias or alias_of(spark, stream), Files(spark)
    target = stream.path(f"generations/{generation:06d}")
    if alias.target() == target:
        raise ValueError(f"generation {generation} is the one that readers have")
    files.delete(target)
    batches = sorted(int(n.removeprefix("batch=")) for n in files.names(stream.path("table")) if n.startswith("batch="))
    source = versions(spark, stream).where(F.col("batch").between(batches[0], batches[-1]))
    compact(source, ["key"], F.col("batch")).drop("batch").write.parquet(target)
    alias.promote(target, batches=[batches[0], batches[-1]])
    return alias.read()
