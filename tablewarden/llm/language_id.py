"""Language identification by error-correcting output codes over hashed byte n-grams.

Every language has a codeword; for each bit a binary naive Bayes classifier tells the languages with
a 1 from those with a 0. A text's n-grams give one margin per bit; decoding weighs each bit by how
far apart its classifier holds the languages, and takes the codeword of least loss. Training is one
aggregate of n-gram counts per language over all training rows; nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import blocks, pick, prepare, table

BUCKETS = 1 << 13
LENGTHS = (2, 3, 4)
# Every n-gram count is raised by this much, so that unseen ones say little.
SMOOTHING = 1.0
# Languages beyond this many make the count table larger than a driver should hold.
MAX_LANGUAGES = 500
EXHAUSTIVE = 6
STEEPNESS = 4.0
# A text is ambiguous if the best language is less than this much more likely than the next.
AMBIGUOUS_GAP = 0.2
UNDETERMINED = "und"
TEXTS_AT_ONCE = 64

# Bytes that are no letters end a word: all of ASCII but a-z (texts are lowered before).
LETTER = np.zeros(256, np.uint32)
LETTER[97:123] = np.arange(97, 123)
LETTER[128:] = np.arange(128, 256)


def histogram(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams of letters, one row per text; n-grams end in a letter."""
    n, rows = len(data), len(off) - 1
    out = np.zeros((rows, BUCKETS), np.int64)
    letters = LETTER[data]
    row = np.repeat(np.arange(rows), np.diff(off))
    for k in LENGTHS:
        if n < k:
            continue
        code = np.zeros(n - k + 1, np.uint32)
        for i in range(k):
            code = (code << np.uint32(8)) | letters[i : n - k + 1 + i]
        good = (letters[k - 1 :] > 0) & (row[: n - k + 1] == row[k - 1 :])
        bucket = (code[good] * np.uint32(2654435761) + np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF)) >> np.uint32(19)
        out += np.bincount(row[k - 1 :][good] * BUCKETS + bucket, minlength=rows * BUCKETS).reshape(rows, BUCKETS)
    return out


def histograms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts) of a few texts at a time, whatever their length."""
    lowered = pc.utf8_lower(texts)
    for at in range(0, len(lowered), TEXTS_AT_ONCE):
        for first, data, off in blocks(lowered.slice(at, TEXTS_AT_ONCE)):
            yield at + first, histogram(data, off)


def codewords(languages: int) -> np.ndarray:
    """0/1 matrix, one row per language; its columns differ and none is constant.

    Few languages: all ways to part them in two. More: rows of a Hadamard matrix, any two of which
    differ in half their bits.
    """
    if languages < 2:
        return np.zeros((languages, 0), np.int8)
    if languages <= EXHAUSTIVE:
        columns = np.arange(1, 1 << (languages - 1))
        return (columns[None, :] >> np.arange(languages)[:, None] & 1).astype(np.int8)
    size = 1 << (languages - 1).bit_length()
    both = np.arange(languages)[:, None] & np.arange(1, size)[None, :]
    return (np.bitwise_count(both) & 1).astype(np.int8)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, 0 or 1
    odds: np.ndarray  # buckets x bits: log odds of an n-gram for bit 1
    middle: np.ndarray  # of each bit: mean log odds half way between the two sides
    scale: np.ndarray  # of each bit: distance of either side from the middle
    weight: np.ndarray  # of each bit, sums to 1


def fit(languages: list[str], counts: np.ndarray) -> Model:
    """Classifiers of all bits from n-gram counts (languages x buckets)."""
    code = codewords(len(languages))
    share = counts + SMOOTHING
    share = share / share.sum(1, keepdims=True)
    ones = code.T @ share / np.maximum(code.sum(0), 1)[:, None]
    zeros = (1 - code).T @ share / np.maximum((1 - code).sum(0), 1)[:, None]
    odds = np.log(ones / zeros).T
    expected = share @ odds  # mean log odds of a text of each language, for each bit
    low_one = np.where(code == 1, expected, np.inf).min(0, initial=np.inf)
    high_zero = np.where(code == 0, expected, -np.inf).max(0, initial=-np.inf)
    scale = np.maximum((low_one - high_zero) / 2, 1e-6)
    weight = scale / scale.sum() if len(scale) else scale
    return Model(languages, code, odds.astype(np.float32), (low_one + high_zero) / 2, scale, weight)


def decode(model: Model, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language (index), its score from 0 to 1 and the gap to the next, of each row of counts."""
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    margin = ((counts.astype(np.float32) @ model.odds) / total - model.middle) / model.scale
    margin = np.clip(margin, -3, 3)
    signs = 2.0 * model.code - 1
    loss = np.logaddexp(0, -STEEPNESS * margin[:, None, :] * signs[None, :, :]) @ model.weight
    likely = np.exp(-STEEPNESS * (loss - loss.min(1, keepdims=True)))
    likely /= likely.sum(1, keepdims=True)
    best = likely.argmax(1)
    score = likely[np.arange(len(best)), best]
    rest = likely.copy()
    rest[np.arange(len(best)), best] = 0
    return best, score, score - rest.max(1, initial=0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for at, counts in histograms(batch.column("text")):
            for i, own in enumerate(counts):
                lang = langs[at + i]
                sums[lang] = sums[lang] + own if lang in sums else own.copy()
            if len(sums) > MAX_LANGUAGES:
                yield from rows()
                sums.clear()
    yield from rows()


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on all rows of ``docs`` with a language; the driver gets one count per language and bucket."""
    prepare(docs.sparkSession)
    rows = docs.select(docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
    sums = rows.where("lang is not null and text is not null").mapInArrow(_count, "lang string, bucket int, n bigint")
    sums = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # one row per language: the table is bounded by languages x buckets
    packed = sums.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    found = packed.limit(MAX_LANGUAGES + 1).toArrow().sort_by("lang")
    if found.num_rows > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((found.num_rows, BUCKETS))
    for i, cells in enumerate(found.column("counts").to_pylist()):
        for cell in cells:
            counts[i, cell["bucket"]] = cell["n"]
    return fit(found.column("lang").to_pylist(), counts)


def _predict(model: Model):
    names = np.array(model.languages, object)

    @F.arrow_udf("lang string, score double, ambiguous boolean")
    def predicted(texts: pa.Array) -> pa.Array:
        langs, scores, unclear = [], [], []
        for _, counts in histograms(texts):
            best, score, gap = decode(model, counts)
            langs += names[best].tolist()
            scores += score.tolist()
            unclear += (gap < AMBIGUOUS_GAP).tolist()
        parts = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unclear, pa.bool_())]
        return pa.StructArray.from_arrays(parts, ["lang", "score", "ambiguous"])

    return predicted


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score and ``ambiguous`` of every row.

    ``und`` with score 0 where the text is null or has no letter, or where no language was learned.
    """
    prepare(docs.sparkSession)
    rows = pick(docs, id_col, text_col)
    lettered = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    if not model.languages:
        rows = rows.select("id", F.lit(None).cast("struct<lang:string,score:double,ambiguous:boolean>").alias("p"))
    else:
        rows = rows.select("id", F.when(lettered, _predict(model)(F.col("text"))).alias("p"))
    return rows.select(
        F.col("id").alias(id_col),
        F.coalesce("p.lang", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.coalesce("p.score", F.lit(0.0)).alias("score"),
        F.coalesce("p.ambiguous", F.lit(True)).alias("ambiguous"),
    )


def op3_language_codes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = train(docs.where(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")
