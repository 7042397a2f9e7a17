"""The corpus pipeline: five stages from raw documents to token ids, each written and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm.common import table
from tablewarden.llm.decontamination import drop_leaks
from tablewarden.llm.pii import redact, train
from tablewarden.llm.quality_rules import keep_good
from tablewarden.llm.sentencepiece_codec import encode_texts
from tablewarden.llm.simhash import drop_near_duplicates
from tablewarden.llm.token_counts import MODEL
from tablewarden.session import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose five-word shingles are 0.8 similar the smallest id stays."""
    return drop_near_duplicates(docs, complete=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go, also with other numbers, names or units in it."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the new text."""
    clean = redact(docs, train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with parity against SentencePiece and the round trip."""
    return encode_texts(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", redact_personal_data),
    ("sentencepiece", encode),
]
# The codec's pieces and the trees have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
