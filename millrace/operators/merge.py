"""Latest-version views: what a reader of the destination sees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(docs: DataFrame, key: Sequence[str], tie: Column | None = None) -> DataFrame:
    """The row with the largest _version of each key, tombstones included.

    Equal versions: the largest tie wins, so pass arrival order for last-write-wins. row_number() with a limit plans a
    group limit before the shuffle, so a key with many versions sends one row from each task.
    """
    order = [F.col("_version").desc(), *([tie.desc()] if tie is not None else [])]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return docs.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def final_view(docs: DataFrame, key: Sequence[str], tie: Column | None = None) -> DataFrame:
    """Living documents: the latest version of each key unless that is a tombstone."""
    return latest(docs, key, tie).where(~F.col("_is_deleted"))


def merge_external_version(current: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Document store's rule: an incoming document is applied if its version is strictly larger than the stored one's.

    Both have the same columns; current has one row for each key, tombstones included. Of incoming documents of one
    key the largest version counts, the first in arrival order if ``arrival`` is a column of incoming.
    """
    cols = current.columns
    ranked = incoming.select(*cols, (-F.col("arrival") if "arrival" in incoming.columns else F.lit(0)).cast("long").alias("__tie"), F.lit(0).alias("__old"))
    both = current.select(*cols, F.lit(0).cast("long").alias("__tie"), F.lit(1).alias("__old")).unionByName(ranked)
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("_version").desc(), F.col("__old").desc(), F.col("__tie").desc()))
    return both.withColumn("__rank", rank).where(F.col("__rank") == 1).select(*cols)


def stale(docs: DataFrame, key: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """Documents that arrive when their key already has that version or a later one."""
    seen = F.max("_version").over(Window.partitionBy(*key).orderBy(*arrival).rowsBetween(Window.unboundedPreceding, -1))
    return docs.withColumn("__seen", seen).where(F.col("_version") <= F.col("__seen")).drop("__seen")


def reconcile(source: DataFrame, view: DataFrame, key: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Keys at fault: ``missing`` from the view, ``extra`` in it, or ``different`` in a compared column."""
    s = source.select(*key, F.struct(*compare).alias("__s"), F.lit(True).alias("__in_s"))
    v = view.select(*key, F.struct(*compare).alias("__v"), F.lit(True).alias("__in_v"))
    fault = F.when(F.col("__in_v").isNull(), "missing").when(F.col("__in_s").isNull(), "extra").when(~F.col("__s").eqNullSafe(F.col("__v")), "different")
    return s.join(v, list(key), "full").select(*key, fault.alias("fault")).where("fault IS NOT NULL")


def compact(docs: DataFrame, key: Sequence[str], tie: Column | None = None, keep_tombstones: bool = True) -> DataFrame:
    """What a background merge leaves: one row for each key; tombstones stay while older versions may still arrive."""
    out = latest(docs, key, tie)
    return out if keep_tombstones else out.where(~F.col("_is_deleted"))
