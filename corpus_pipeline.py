"""Corpus pipeline: documents to training tokens in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last give the
columns of ``documents``.

1. quality: documents that the subword classifier rejects (score under 0.7) go.
2. near_duplicates: of documents linked by 5-word shingles with a Jaccard
   similarity of 0.8 or more, the one with the smallest id stays.
3. decontamination: documents that contain a benchmark item go.
4. secrets: owner-specific credentials are replaced by a mark; n_chars follows.
5. tokens: every text as BPE tokens, with the digest of the text decoded again.

Cases: null and empty texts pass all stages (the classifier's bias decides) and
have no tokens; of repeated rows one stays, but rows without any word stay as
they are; an empty table gives an empty table; columns besides those of
``documents`` are handed on to the last stage.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import bpe, decontam, jaccard, quality, secrets
from vigil.session import bounded_batches, ensure_checkpoint_dir

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def bounded(stage):
    """A stage whose Arrow batches are bounded by bytes, so that an executor's
    memory does not depend on the length of texts; the session keeps the bound
    (a stage's rows are computed when they are written)."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@bounded
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.quality_scores(docs, model, carry=tuple(docs.columns))
    return scored.where("predicted = 1").select(*(F.col(f"carry_{c}").alias(c) for c in docs.columns))


@bounded
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


@bounded
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@bounded
def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with owner-specific credentials replaced."""
    clean = secrets.redacted(docs, F.concat_ws("/", "source", "lang"), F.col("source"))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


@bounded
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each text: doc_id, n_tokens, ids and both digests."""
    return bpe.encode_decode(docs, bpe.vocabulary_path(), with_ids=True).drop("decoded")


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("decontamination", decontamination_stage),
          ("secrets", secret_stage), ("tokens", token_stage)]
ORACLE_SQL = None  # a trained classifier and a tokenizer are beyond SQL; tests/llm/test_pipeline.py holds brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what lies between them is
    written below the shared checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
