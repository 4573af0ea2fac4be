"""Status of streams: lag, progress, health, counters, histograms, positions and alert rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEALTHY_LAG_S, READY_LAG_S = 300, 300
# Upper bounds of the two histograms, and the alert rules as (name, severity, metric, operator, threshold).
BATCH_BUCKETS = (1, 10, 50, 100, 500, 1000, 5000, 10000, 50000, 100000)
WRITE_SECONDS_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
ALERT_RULES = (
    ("lag_high", "warning", "lag_seconds", ">", 300.0),
    ("lag_critical", "critical", "lag_seconds", ">", 1800.0),
    ("position_stale", "critical", "checkpoint_age_seconds", ">", 600.0),
    ("dead_letters", "critical", "dead_letters_increase", ">", 0.0),
    ("sink_errors", "warning", "sink_errors_per_second", ">", 0.1),
    ("queue_full", "warning", "queue_events", ">", 6000.0),
    ("scan_stalled", "warning", "scan_rows_per_second", "<=", 0.0),
    ("stale_writes", "warning", "stale_per_second", ">", 1.0),
)


def lag_seconds(last_event_ms: Column, now_ms: Column) -> Column:
    """Seconds behind, never negative; unknown (null) before the first event."""
    return F.when(last_event_ms.isNotNull(), F.greatest(F.lit(0.0), (now_ms - last_event_ms) / 1000.0))


def stream_lag(events: DataFrame, stream: str, ts: str, now_ms: int) -> DataFrame:
    last = F.max(F.unix_millis(F.col(ts).cast("timestamp")))
    return events.groupBy(stream).agg(last.alias("last_event_ms")).withColumn("lag_seconds", lag_seconds(F.col("last_event_ms"), F.lit(now_ms)))


def snapshot_progress(done: Column, rows_done: Column, rows_total: Column) -> Column:
    """1 when done, null without an estimate, else the share read, at most 1."""
    return F.when(done, F.lit(1.0)).when(rows_total > 0, F.least(F.lit(1.0), rows_done / rows_total))


def healthy(last_error: Column, lag: Column, limit: float = HEALTHY_LAG_S) -> Column:
    """No recorded error, and a lag that is unknown or within the limit."""
    return F.coalesce(F.coalesce(last_error, F.lit("")) == "", F.lit(True)) & F.coalesce(lag <= limit, F.lit(True))


def ready(streaming: Column, last_error: Column, since_apply_s: Column) -> Column:
    return streaming & (F.coalesce(last_error, F.lit("")) == "") & (since_apply_s <= READY_LAG_S)


def events_by_operation(events: DataFrame, stream: str, op: str) -> DataFrame:
    return events.groupBy(stream, op).agg(F.count("*").cast("long").alias("events"))


def histogram(values: DataFrame, value: str, by: Sequence[str], buckets: Sequence[float]) -> DataFrame:
    """Cumulative counts for each upper bound; +Inf is null. One pass with a partial sum for each bucket."""
    sums = [F.sum((F.col(value) <= b).cast("long")).alias(f"b{i}") for i, b in enumerate(buckets)]
    wide = values.groupBy(*by).agg(*sums, F.count("*").alias("all"))
    bounds = F.array(*(F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(buckets)), F.struct(F.lit(None).cast("double").alias("le"), F.col("all").alias("n")))
    return wide.select(*by, F.inline(bounds))


def alerts(metrics: DataFrame, rules: Sequence[tuple[str, str, str, str, float]] = ALERT_RULES) -> DataFrame:
    """Rules that fire, for metrics (stream, metric, value)."""
    table = metrics.sparkSession.createDataFrame([tuple(r) for r in rules], "alert string, severity string, metric string, operator string, threshold double")
    fires = F.when(F.col("operator") == ">", F.col("value") > F.col("threshold")).otherwise(F.col("value") <= F.col("threshold"))
    return metrics.join(F.broadcast(table), "metric").where(fires).select("stream", "alert", "severity", "value")


def shared_start_position(positions: DataFrame, by: str = "source") -> DataFrame:
    """The position that streams of one source can all start from: the smallest end, if all sets start alike.

    positions: (source, stream, uuid, first, last), executed ranges. Sets diverge, and have no common start, if for any
    uuid the first differs or a stream lacks it.
    """
    streams = positions.groupBy(by).agg(F.countDistinct("stream").alias("__n"))
    each = positions.groupBy(by, "uuid").agg(F.min("first").alias("first"), F.max("first").alias("__most"), F.min("last").alias("last"), F.countDistinct("stream").alias("__have"))
    joined = each.join(streams, by)
    fine = (F.col("first") == F.col("__most")) & (F.col("__have") == F.col("__n"))
    return joined.select(by, "uuid", F.when(fine, F.concat("uuid", F.lit(":"), F.col("first").cast("string"), F.lit("-"), F.col("last").cast("string"))).alias("start_position"), (~fine).alias("divergent"))
