"""A training corpus in five stages, from ``documents`` to token files.

1. language: documents whose language cannot be told go (no letters, a
   posterior below ``LEAST_SCORE``, or a log likelihood per letter far below that of
   the learning rows: gibberish and languages that are not learned);
2. near-duplicates: one document of each group stays;
3. decontamination: documents that hold a benchmark window go;
4. mixing: documents are repeated to their source's target share;
5. tokens: the mix is written as token files, of which the digests return.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet under the shared checkpoint folder and read again as the next one's
``docs``. All stages but the last return the columns of ``documents``. Nulls,
empty tables and extra columns are treated as the operators say.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import decontaminate, langid, mixing, near_dedup, tokens
from orderloom.llm.common import compact, stored, table, undoc

LEAST_SCORE = 0.5


def _stage(f):
    @wraps(f)
    def compactly(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with compact(spark):
            return f(spark, docs, sf_dir)
    return compactly


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.learn(langid.learning_rows(docs))
    # stored: the texts are scored once, for the calibration and for the filter
    found = stored(langid.identify(docs, model), "identified")
    told = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    rows = langid.learned("doc.doc_id") & F.col("doc.lang").isNotNull()
    return undoc(found.where(told & langid.plausible(found, rows)), docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(docs).where("reps > 0")
    return undoc(mixed.select("doc", F.explode(F.sequence(F.lit(1), F.col("reps").cast("int"))).alias("copy")), docs)


@_stage
def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.round_trip(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mix", mix), ("token_files", token_files)]

#: signatures, the language model and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
