"""The change log: files of events in version order, read whole or as a stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class PositionPurged(RuntimeError):
    """The log no longer holds the position to resume from; the remedy is a new scan."""


def event_schema(image: T.StructType, timed: bool = False) -> T.StructType:
    """Events, with the millisecond they happened at if the log has it."""
    fields = [T.StructField("op", T.StringType()), T.StructField("before", image), T.StructField("after", image), T.StructField("seq", T.LongType())]
    return T.StructType([*fields, T.StructField("ts_ms", T.LongType())] if timed else fields)


def write_segments(events: DataFrame, path: str, segments: int) -> None:
    """The log as files of consecutive version ranges of about equal size, written at once."""
    events.repartitionByRange(segments, "seq").write.mode("overwrite").parquet(path)


def read_log(spark: SparkSession, path: str, image: T.StructType, timed: bool = False) -> DataFrame:
    return spark.read.schema(event_schema(image, timed)).option("recursiveFileLookup", "true").parquet(path)


def stream_log(spark: SparkSession, path: str, image: T.StructType, files_per_trigger: int = 1000, timed: bool = False) -> DataFrame:
    """New files as they come, oldest first. A file that is gone before it was read fails the query rather than being skipped."""
    return (
        spark.readStream.schema(event_schema(image, timed)).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger)
        .option("latestFirst", "false").parquet(path)
    )


def check_position(spark: SparkSession, path: str, position: int) -> None:
    """Raise if the log begins after the position."""
    first = spark.read.option("recursiveFileLookup", "true").parquet(path).agg(F.min("seq")).head()[0]
    if first is not None and first > position + 1:
        raise PositionPurged(f"the log starts at version {first}, after position {position}; scan the table again")


def read_image(spark: SparkSession, path: str) -> T.StructType:
    """The row image that the log's files hold: of files from before and after a column was added, the wider one."""
    return spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(path).schema["after"].dataType


def is_timed(spark: SparkSession, path: str) -> bool:
    return "ts_ms" in spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(path).columns


def purge(files, log: str, through: int) -> None:
    """Note beside the log that events up to a version are gone; whoever deletes its files calls this first."""
    files.replace(f"{log}.purged.json", json.dumps({"through": through}))


def check_purged(files, log: str, position: int) -> None:
    """Raise if events after the position are gone."""
    text = files.read_text(f"{log}.purged.json")
    if text and json.loads(text)["through"] > position:
        raise PositionPurged(f"the log of {log} is gone up to version {json.loads(text)['through']}, the stream has read up to {position}; scan the table again")


def statements(files, log: str) -> list[dict]:
    """Statements that came with the log: rows of seq, schema and statement, in order."""
    text = files.read_text(f"{log}.ddl.json") or ""
    return sorted((json.loads(line) for line in text.splitlines() if line.strip()), key=lambda x: x["seq"])
