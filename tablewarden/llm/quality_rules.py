"""Quality rules: how much of a text lies inside repeated word n-grams and repeated lines.

All texts of an Arrow batch are measured together: word and line hashes come from one rolling hash
over the bytes, n-gram hashes from one over the words, and a sort finds the ones that occur twice.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import (
    MULTIPLIER,
    blocks,
    byte_sums,
    fresh,
    mix,
    pick,
    prepare,
    rolling,
    span_hash,
    table,
    trim,
    word_bounds,
)

BASE_NGRAM = 3
NGRAMS = (5, 7, 10)
# A text is rejected if more than this share of its word characters lies inside n-grams of that
# length that occur twice, or inside lines that occur earlier.
NGRAM_LIMITS = {5: 0.45, 7: 0.40, 10: 0.35}
LINE_LIMIT = 0.30
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS.encode())] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]


def _twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key: does it occur twice or more; is it one of the further ones of its value."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    equal = ordered[1:] == ordered[:-1]
    any_, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][equal]] = True
    any_[order[:-1][equal]] = True
    return any_ | later, later


def _per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, values, n).astype(np.int64)


def measure_block(data: np.ndarray, off: np.ndarray, ngrams: Sequence[int]) -> dict[str, np.ndarray]:
    n = len(off) - 1
    starts, ends, row = word_bounds(data, off)
    solid = np.zeros(len(data) + 1, np.int64)  # characters of words before each byte
    space = (data == 32) | ((data >= 9) & (data <= 13))
    np.cumsum(((data & 0xC0) != 0x80) & ~space, out=solid[1:])
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(IS_SYMBOL[data], out=symbols[1:])
    sums = byte_sums(data)
    chars = solid[ends] - solid[starts]
    out = {
        "n_words": np.bincount(row, minlength=n).astype(np.int64),
        "word_chars": solid[off[1:]] - solid[off[:-1]],
        "n_symbols": symbols[off[1:]] - symbols[off[:-1]],
    }

    breaks = np.flatnonzero(data == 10)
    # in order, the k-th line starts at the k-th of these places and ends at the k-th of those
    line_start = np.sort(np.concatenate([off[:-1], breaks + 1]))
    line_end = np.sort(np.concatenate([breaks, off[1:]]))
    worded = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[worded], line_end[worded]
    line_row = np.searchsorted(off, line_start, "right") - 1
    salt = mix(np.arange(1, n + 1, dtype=np.uint64) * MULTIPLIER)
    _, later = _twice(span_hash(sums, line_start, line_end) + salt[line_row])
    out["n_dup_lines"] = _per_row(later, line_row, n)
    out["dup_line_chars"] = _per_row(later * (solid[line_end] - solid[line_start]), line_row, n)

    words = rolling(span_hash(sums, starts, ends))
    for k in (BASE_NGRAM, *ngrams):
        at = np.arange(max(0, len(starts) - k + 1))
        at = at[row[at] == row[at + k - 1]]
        found, _ = _twice(span_hash(words, at, at + k) + salt[row[at]])
        steps = np.zeros(len(starts) + 1, np.int64)
        np.add.at(steps, at[found], 1)
        np.subtract.at(steps, at[found] + k, 1)
        covered = np.cumsum(steps)[:-1] > 0
        if k == BASE_NGRAM:
            out["n_repeat_words"] = _per_row(covered, row, n)
        if k in ngrams:
            out[f"dup_chars_{k}"] = _per_row(covered * chars, row, n)
    return out


def _measure(ngrams: Sequence[int]):
    names = [*COUNTS, *[f"dup_chars_{k}" for k in ngrams]]

    @F.arrow_udf(", ".join(f"{c} bigint" for c in names))
    def measured(texts: pa.Array) -> pa.Array:
        parts = [measure_block(data, off, ngrams) for _, data, off in blocks(texts)]
        columns = [np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in names]
        del parts
        trim()
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return measured


def repetition(text: Column, ngrams: Sequence[int] = NGRAMS) -> Column:
    """Struct of counts of a whole text (null: all zero)."""
    return _measure(tuple(ngrams))(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])


def verdict(m: Column, limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> Column:
    """True where the base rules hold and no measured share passes its limit."""
    good = ~base_failed(m) & (m["dup_line_chars"] <= line_limit * m["word_chars"])
    for k, limit in limits.items():
        good = good & (m[f"dup_chars_{k}"] <= limit * m["word_chars"])
    return good


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the measures, ``base_failed`` and ``kept``.

    Null and blank texts have no words and fail the base rules; repeated rows are judged alike;
    further columns of ``docs`` are not read.
    """
    prepare(docs.sparkSession)
    rows = pick(docs, id_col, text_col).select(F.col("id").alias(id_col), repetition(F.col("text")).alias("m"))
    m = F.col("m")
    return rows.select(id_col, "m.*", base_failed(m).alias("base_failed"), verdict(m).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    prepare(docs.sparkSession)
    m = fresh(docs, "measured")
    return docs.withColumn(m, repetition(docs[text_col].cast("string"))).where(verdict(F.col(m))).drop(m)


def op4_repetition_coverage(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"))
