"""Token counts with a digest cache: each different text is encoded once for each tokenizer version.

The cache is a Parquet folder of (tokenizer, digest, n_tokens), one partition per tokenizer version.
The digest is of the normalised content, that is of what the tokenizer sees: it writes the space as
U+2581, so the two are the same to it. Misses are made distinct before they are encoded and then
appended; an append that is repeated after a failure does no harm, as readers take one row a digest.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tablewarden.llm.common import pick, prepare, table
from tablewarden.operators.scale import attach
from tablewarden.session import shared_folder

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
SPACE_MARK = "▁"
# Texts or words that go to the library in one call.
AT_ONCE = 1 << 14


def tokenizer_version(model: bytes) -> str:
    """Digest of the model file and the library's version: counts of others are never used."""
    return hashlib.sha256(model + sentencepiece.__version__.encode()).hexdigest()


def splits_at_spaces(model: bytes) -> bool:
    """Whether no piece of a BPE model holds a space after another character.

    Then no merge crosses the start of a word, and a text has as many tokens as its words have.
    """
    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    plain = proto.normalizer_spec
    return (
        proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        and not plain.precompiled_charsmap
        and plain.add_dummy_prefix
        and plain.escape_whitespaces
        and not plain.remove_extra_whitespaces
        and not proto.trainer_spec.treat_whitespace_as_suffix
        and not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p.piece) for p in proto.pieces)
    )


class Counter:
    """Counts tokens of whole texts, word by word where that is the same."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.by_word = splits_at_spaces(model)

    def _whole(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text, encoded as it is."""
        n = np.zeros(len(texts), np.int64)
        for at in range(0, len(texts), AT_ONCE):
            part = texts.slice(at, AT_ONCE).to_pylist()
            n[at : at + AT_ONCE] = [len(ids) for ids in self.library.encode(part, num_threads=1)]
        return n

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each of ``texts`` (normalised); every different word of them is encoded once."""
        if not self.by_word:
            return self._whole(texts)
        # spaces side by side, first or last are pieces together: such a text is counted whole
        odd = pc.match_substring_regex(texts, "^ |  | $|^$").to_numpy(zero_copy_only=False)
        n = np.zeros(len(texts), np.int64)
        n[odd] = self._whole(texts.filter(pa.array(odd)))
        split = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        words = split.flatten().dictionary_encode()
        sums = np.concatenate([[0], np.cumsum(self._whole(words.dictionary)[words.indices.to_numpy()])])
        n[~odd] = np.diff(sums[np.cumsum(pc.list_value_length(split).to_numpy())], prepend=0)
        return n


def _encode(model: bytes):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model)
        for batch in batches:
            n = pa.array(counter.count(batch.column("content")))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), n], ["digest", "n_tokens"])

    return encode


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACE_MARK, " ")


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored for one tokenizer version; empty if there are none yet."""
    folder = f"{cache}/tokenizer={version}"
    schema = "digest binary, n_tokens bigint"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return spark.createDataFrame([], schema)
    # each append is a folder of its own
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def count_tokens(docs: DataFrame, cache: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens of every row, counts taken from ``cache`` (a shared folder), misses added.

    Null texts count as empty: 0 bytes, 0 tokens. Repeated rows and copies are encoded once and each
    get their count; a hot text is one row per task before the shuffle. The model file is read on the
    driver and sent with the tasks.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(model_path, "rb") as f:
        model = f.read()
    version = tokenizer_version(model)
    rows = pick(docs, id_col, text_col).select(
        "id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), normalised(F.col("text")).alias("content")
    )
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("content").cast("binary"), 256)))
    misses = rows.select("digest", "content").join(read_cache(spark, cache, version), "digest", "left_anti")
    distinct = misses.groupBy("digest").agg(F.first("content").alias("content"))
    counted = distinct.mapInArrow(_encode(model), "digest binary, n_tokens bigint")
    counted.write.parquet(f"{cache}/tokenizer={version}/append={uuid.uuid4().hex}")
    known = read_cache(spark, cache, version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    counted = attach(rows.drop("content"), known, ["digest"])
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def op7_token_counts(spark, sf_dir):
    """Every run starts a cache of its own, so that its work is that of a first run."""
    cache = f"{shared_folder(spark)}/token-cache-{uuid.uuid4().hex}"
    counts = count_tokens(table(spark, sf_dir, "documents"), cache, public_tokenizers.path(MODEL))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
