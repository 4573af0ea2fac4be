"""Batches, their outcomes, refused documents and the dead-letter log."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS, MAX_BYTES = 1000, 5 << 20
APPLIED, STALE, RETRY, REJECTED = "applied", "stale", "retry", "rejected"


class BatchMismatch(RuntimeError):
    """A sink accounted for more or fewer documents than it was given."""


def doc_size(key: Column, body: Column) -> Column:
    """Bytes of key and body."""
    return (F.octet_length(key) + F.coalesce(F.octet_length(body), F.lit(0))).cast("long")


def assign_by_rows(docs: DataFrame, stream: Sequence[str], order: Sequence[str], rows: int = MAX_ROWS) -> DataFrame:
    """Batch number of each document when a stream's batches flush at a number of rows."""
    place = F.row_number().over(Window.partitionBy(*stream).orderBy(*order))
    return docs.withColumn("batch", F.floor((place - 1) / rows).cast("long"))


def assign_by_size(docs: DataFrame, stream: str, order: Sequence[str], rows: int = MAX_ROWS, size: int = MAX_BYTES) -> DataFrame:
    """Batch number when a batch flushes at its row limit, and before a document that would pass its byte limit.

    docs has ``bytes``. A batch depends on all before it, so a stream is one sequence: its (order, bytes) pairs are
    walked in one task as a sorted iterator that holds a batch of rows at a time, while streams run in parallel. An
    document of at least the byte limit is flushed with what is pending before it.
    """
    schema = docs.schema.add("batch", "long")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, batch, n, held = None, 0, 0, 0
        for frame in batches:
            out = []
            for s, b in zip(frame[stream], frame["bytes"]):
                if s != name:
                    name, batch, n, held = s, 0, 0, 0
                if n and held + b > size and b < size:
                    batch, n, held = batch + 1, 0, 0
                out.append(batch)
                n, held = n + 1, held + b
                if n >= rows or held >= size:
                    batch, n, held = batch + 1, 0, 0
            yield frame.assign(batch=out)

    return docs.repartition(stream).sortWithinPartitions(stream, *order).mapInPandas(walk, schema)


def classify_outcome(status: Column, deleted: Column) -> Column:
    """What a document store's item status means: 2xx applied, 409 stale, 404 of a delete stale, 429 and 5xx retry."""
    return (
        F.when(status.between(200, 299), APPLIED).when(status == 409, STALE).when((status == 404) & deleted, STALE)
        .when((status == 429) | (status >= 500), RETRY).otherwise(REJECTED)
    )


def batch_outcome(items: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts of outcomes for each batch, and whether they account for all its documents."""
    count = lambda o: F.sum(F.when(F.col("outcome") == o, 1).otherwise(0)).cast("long").alias(o)
    out = items.groupBy(*by).agg(F.count("*").cast("long").alias("total"), count(APPLIED), count(STALE), count(REJECTED))
    return out.withColumn("complete", F.col(APPLIED) + F.col(STALE) + F.col(REJECTED) == F.col("total"))


def isolate_rejects(docs: DataFrame, problem: Column) -> tuple[DataFrame, DataFrame]:
    """(good, bad with reason): one predicate instead of bisecting a refused batch."""
    marked = docs.withColumn("reason", problem)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def dedup_token(docs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Token by which a destination knows a repeated batch: first key, first and last version, size."""
    token = F.concat_ws("-", F.min_by("key", F.struct("_version", "key")), F.min("_version").cast("string"), F.max("_version").cast("string"), F.count("*").cast("string"))
    return docs.groupBy(*by).agg(token.alias("token"))


def dead_letters(bad: DataFrame, stream: Column, recorded_at: Column, status: Column | None = None, with_body: bool = False) -> DataFrame:
    """Dead-letter records of refused documents: bodies are withheld unless asked for."""
    size = F.octet_length("body") if "body" in bad.columns else F.lit(0)
    cols = [
        recorded_at.alias("recorded_at"), stream.alias("stream"), F.col("key"), F.col("_version").alias("version"), F.col("_is_deleted").alias("deleted"),
        (status if status is not None else F.lit(None).cast("int")).alias("status"), F.substring("reason", 1, 1000).alias("reason"), F.coalesce(size, F.lit(0)).cast("long").alias("body_bytes"),
    ]
    return bad.select(*cols, *([F.col("body")] if with_body else []))


def dlq_count(letters: DataFrame) -> DataFrame:
    return letters.groupBy("stream").agg(F.count("*").cast("long").alias("records"))


def versioned_append(docs: DataFrame) -> DataFrame:
    """Rows of an append-only column store: the document's fields, then _version and _is_deleted as 0 or 1."""
    return docs.select("doc.*", F.col("_version"), F.col("_is_deleted").cast("int").alias("_is_deleted"))
