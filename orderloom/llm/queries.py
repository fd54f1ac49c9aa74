"""The registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import decontaminate, embed_dedup, langid, line_dedup, mixing, near_dedup, perplexity, phrases, prefix_trie, quality, tokens, url_filter, warc
from orderloom.llm.common import NULL_ID, table
from orderloom.session import scratch_path


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"))


def _known(column: str):
    return F.when(F.col(column) != NULL_ID, F.col(column))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(_known("id").alias("vec_id"), "n_links", _known("component").alias("component_id"),
                        (F.col("id") == F.col("component")).alias("kept"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(langid.learning_rows(docs))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc.doc_id", langid.held_out("doc.doc_id").alias("held_out"), "lang_pred", "score")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(_known("id").alias("doc_id"), "n_shingles", _known("component").alias("component_id"),
                        (F.col("id") == F.col("component")).alias("kept"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("reps")).alias("taken"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc.doc_id", quality.held_out("doc.doc_id").alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("doc.page_id", "host", "path", "rule", "verdict", "probability")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read_warc(spark, path))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = perplexity.judge(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return judged.select("doc.doc_id", *perplexity.COUNTS, "base_failed", "kept", "rate")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
