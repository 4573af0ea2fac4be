"""The registered queries of this package: thin wrappers that read a table and apply one operator to all of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import ann, decontam, htmltree, langid, licenses, neardup, packing, quality, tokenize, tokenout, url_rules
from millrace.llm.storage import Stash


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [
    url_rules.Rule.parse("block", "com/en/"),
    url_rules.Rule.parse("allow", "example.com/en/7"),
    url_rules.Rule.parse("allow", "net/de/"),
    url_rules.Rule.parse("block", "example.net/de/8"),
    url_rules.Rule.parse("block", "org/es/"),
]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenize.default_path())


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.identify(docs.select("doc_id", "text"), profiles).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the packed matrices to the shared folder and returns what is read back from them."""
    name = tokenize.default_path()
    rows = tokenout.write(tokenout.packed_rows(table(spark, sf_dir, "documents"), name), f"{Stash(spark, 'token-ids').base}/rows")
    return tokenout.unpack(rows, tokenout.id_type(name))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltree.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    heads = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, heads).select("doc_id", "p_low_quality", "p_toxic", "quality_score", "accepted")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/dK/doc_id.txt``, ten to a directory, of which the first is its LICENSE."""
    part = lambda c: F.coalesce(F.col(c), F.lit("none"))
    doc_id = F.col("doc_id").cast("long")
    name = F.when(F.pmod(doc_id, F.lit(10)) == 0, F.lit("LICENSE")).otherwise(F.concat(F.coalesce(doc_id.cast("string"), F.lit("none")), F.lit(".txt")))
    folder = F.concat(F.lit("d"), F.coalesce(F.floor(doc_id / 10).cast("string"), F.lit("none")))
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.concat_ws("/", part("source"), part("lang"), folder, name).alias("path"), "text")
    return licenses.scan(files).select(F.col("id").alias("doc_id"), "path", "licence", "score", "unit", "found_in", "depth")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
