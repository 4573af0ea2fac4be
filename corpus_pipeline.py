"""The corpus pipeline: quality, language, near-duplicates, benchmark leaks, then packing.

Each stage takes all that the one before kept, written as Parquet and reread, and drops the documents it rejects
whole; the last returns packed pieces. Stages see the columns of ``documents`` and nothing else, so a document's
other columns are never changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, langid, neardup, packing, quality, tokenize
from millrace.llm.storage import BATCH, Stash

#: Softmax share of the best language below which a text counts as undetermined.
LEAST_LANGUAGE_SCORE = 0.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of being neither junk nor toxic is at least one half."""
    heads = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, heads).where("accepted").select(*docs.columns)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language can be told; profiles are learned from what came in."""
    profiles = langid.learn(docs)
    known = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return langid.identify(docs, profiles).where(known if profiles.langs else F.lit(True)).select(*docs.columns)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component.

    A row without an id goes by a number made of its text, larger than those of real ids. Rows that share an id but not
    their text are each judged, and rows that share both are one.
    """
    stand_in = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2)
    named = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), stand_in), "__text": neardup.text_key(F.col("text"))})
    kept = neardup.near_duplicates(named.select(F.col("__id").alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"))
    return named.join(kept, ["__id", "__text"], "left_semi").dropDuplicates(["__id", "__text"]).select(*docs.columns)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenize.default_path())


STAGES = [
    ("quality classifier", keep_quality),
    ("language ID", keep_language),
    ("MinHash near-dedup", keep_first_copies),
    ("benchmark decontamination", keep_unleaked),
    ("best-fit packing", pack),
]

#: The learned stages have no SQL form; tests hold run() against brute-force versions of the others.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stash = _table(spark, sf_dir, "documents"), Stash(spark, "pipeline")
    for name, stage in STAGES:
        docs = stash.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"), BATCH)
    return docs
