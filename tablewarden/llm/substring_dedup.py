"""Substring dedup: runs of words that occur earlier in the collection are removed.

Windows grow level by level. At the first level (half a window) only *seeds* are compared: of the
half windows inside each window the one with the least hash, so equal windows have equal seeds and
few positions are shuffled. Seeds that occur once are dropped. Around the others the windows of
twice the length are compared: windows that share their seed and follow each other form a run, and
equal runs are settled by one hash. Only where runs with the same seed differ - at the edges of a
repeated passage - are their windows compared one by one. Longer levels are not needed: every
longer repeat is made of repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import (
    blocks,
    byte_sums,
    mix,
    pick,
    prepare,
    rolling,
    same,
    span_hash,
    stored,
    table,
    word_bounds,
)

WINDOW = 20


class Runs:
    """The seeds and runs of windows of a block of texts."""

    def __init__(self, data: np.ndarray, off: np.ndarray, window: int):
        self.window, half = window, window // 2
        self.starts, self.ends, self.row = word_bounds(data, off)
        n = len(self.starts)
        self.first_word = np.searchsorted(self.row, np.arange(len(off)))
        self.sums = rolling(span_hash(byte_sums(data), self.starts, self.ends))
        at = np.arange(max(0, n - window + 1))
        self.at = at = at[self.row[at] == self.row[at + window - 1]] if n >= window else at
        if not len(at):
            self.begin = self.size = self.seed = np.zeros(0, np.int64)
            return
        places = np.arange(n - half + 1)
        seeds = span_hash(self.sums, places, places + half)
        best, width, need = places, 1, window - half + 1  # leftmost least seed of `width` places
        while width < need:
            step = min(width, need - width)
            here, there = best[: len(best) - step], best[step:]
            best = np.where(seeds[there] < seeds[here], there, here)
            width += step
        chosen = best[at]
        new = np.ones(len(at), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
        head = np.flatnonzero(new)
        self.begin = at[head]  # first word of the run's first window
        self.size = np.diff(np.append(head, len(at)))  # windows
        self.seed = seeds[chosen[head]]

    def contents(self) -> np.ndarray:
        """Hash of all words of each run, with its number of windows."""
        ends = self.begin + self.size + self.window - 1
        return mix(span_hash(self.sums, self.begin, ends) + self.size.astype(np.uint64))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of all windows of the chosen runs, run by run."""
        size = self.size[which]
        base = np.repeat(self.begin[which] - np.cumsum(size) + size, size)
        at = base + np.arange(size.sum())
        return at, span_hash(self.sums, at, at + self.window)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def _seed_counts(window: int):
    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, off in blocks(batch.column("text")):
                seed, n = np.unique(Runs(data, off, window).seed, return_counts=True)
                if len(seed):
                    yield pa.RecordBatch.from_arrays([_long(seed), _long(n)], ["seed", "n"])

    return seeds


def _seeds_of_texts(window: int):
    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, off in blocks(batch.column("text")):
                r = Runs(data, off, window)
                if len(r.seed):
                    owner = batch.column("id").take(pa.array(r.row[r.begin] + at))
                    yield pa.RecordBatch.from_arrays([owner, _long(r.seed)], ["id", "seed"])

    return seeds


def _among(values: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which values are in any of the lists: what is repeated for one text is so for all."""
    known = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return np.isin(values, known)


def _runs_of_texts(window: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "seed", "content", "windows"]
        for batch in batches:
            for at, data, off in blocks(batch.column("text")):
                r = Runs(data, off, window)
                rows = len(off) - 1
                which = np.flatnonzero(_among(r.seed, batch.column("seeds").slice(at, rows)))
                if not len(which):
                    continue
                row = r.row[r.begin[which]]
                _, hashes = r.windows(which)
                ends = pa.array(np.concatenate([[0], np.cumsum(r.size[which])]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(row + at)),
                        _long(r.begin[which] - r.first_word[row]),
                        _long(r.seed[which]),
                        _long(r.contents()[which]),
                        pa.ListArray.from_arrays(ends, _long(hashes)),
                    ],
                    names,
                )

    return runs


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_words", "n_removed", "kept_text", "spans"]
        for batch in batches:
            for at, data, off in blocks(batch.column("text")):
                r, rows = Runs(data, off, window), len(off) - 1
                part = batch.slice(at, rows)
                gone = np.zeros(len(r.starts) + 1, np.int64)
                which = np.flatnonzero(_among(r.seed, part.column("seeds")))
                if len(which):
                    begin, size, row = r.begin[which], r.size[which], r.row[r.begin[which]]
                    place, hashes = r.windows(which)
                    # kept: (row, first word, hash) of whole runs and of single windows
                    kept = part.column("kept")
                    flat = kept.flatten()
                    owner = np.repeat(np.arange(rows), kept.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                    word = r.first_word[owner] + flat.field("start").to_numpy(zero_copy_only=False)
                    known = mix(word.astype(np.uint64)) + flat.field("hash").to_numpy(zero_copy_only=False).view(np.uint64)
                    stay = np.isin(mix(begin.astype(np.uint64)) + r.contents()[which], known)
                    single = np.isin(mix(place.astype(np.uint64)) + hashes, known)
                    lost = place[~(np.repeat(stay, size) | single)]
                    np.add.at(gone, lost, 1)
                    np.subtract.at(gone, lost + window, 1)
                removed = np.cumsum(gone)[:-1] > 0
                counts = np.bincount(r.row, minlength=rows)
                texts, spans = [], []
                for i in range(rows):
                    a, b = r.first_word[i], r.first_word[i + 1]
                    words = data[off[i] : off[i + 1]].tobytes().split()
                    own = removed[a:b]
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)])
                    if len(edges):
                        words = [w for w, out in zip(words, own.tolist(), strict=True) if not out]
                    texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        _long(counts),
                        _long(np.bincount(r.row, removed, rows).astype(np.int64)),
                        pa.array(texts, pa.string()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ],
                    names,
                )

    return cut


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id, n_words, n_removed, kept_text (kept words joined by one space) and the removed word spans.

    A word goes if a window over it holds a word sequence that also starts earlier: at a smaller id,
    or earlier in the same text. Null and blank texts have no words. Rows that repeat an id have one
    place in the order, so neither of two equal ones removes the other. A null id comes first.
    """
    if window < 2 or window % 2:
        raise ValueError("a window is twice its first level: an even number of words")
    prepare(docs.sparkSession)
    rows = pick(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    # level 1: seeds that occur twice
    seeds = rows.mapInArrow(_seed_counts(window), "seed bigint, n bigint")
    seeds = seeds.groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")
    seeds = stored(seeds, "seeds")
    marks = (
        rows.mapInArrow(_seeds_of_texts(window), f"id {kind}, seed bigint")
        .join(seeds, "seed", "left_semi")
        .groupBy("id")
        .agg(F.collect_set("seed").alias("seeds"))
    )
    marks = stored(marks, "marks")
    # level 2: windows around them, run by run, then one by one where runs differ
    found = (
        rows.join(marks.withColumnRenamed("id", "of"), same(rows["id"], F.col("of")))
        .select("id", "text", "seeds")
        .mapInArrow(_runs_of_texts(window), f"id {kind}, start bigint, seed bigint, content bigint, windows array<bigint>")
    )
    runs = found.groupBy("seed", "content").agg(F.min(F.struct("id", "start")).alias("at"), F.first("windows").alias("windows"))
    runs = stored(runs, "runs")
    split = runs.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed")
    whole = runs.join(split, "seed", "left_anti").select("at.id", "at.start", F.col("content").alias("hash"))
    single = (
        runs.join(split, "seed", "left_semi")
        .select("at", F.posexplode("windows").alias("i", "hash"))
        .groupBy("hash")
        .agg(F.min(F.struct(F.col("at.id").alias("id"), (F.col("at.start") + F.col("i")).alias("start"))).alias("at"))
        .select("at.id", "at.start", "hash")
    )
    kept = whole.union(single).groupBy("id").agg(F.collect_list(F.struct("start", "hash")).alias("kept"))
    marks = marks.join(kept.withColumnRenamed("id", "keeper"), same(F.col("id"), F.col("keeper")), "left")
    marks = stored(marks.select(F.col("id").alias("of"), "seeds", "kept"), "kept")
    return (
        rows.join(marks, same(rows["id"], marks["of"]), "left")
        .select("id", "text", "seeds", "kept")
        .mapInArrow(
            _cut(window),
            f"id {kind}, n_words bigint, n_removed bigint, kept_text string, spans array<struct<start:bigint,end:bigint>>",
        )
        .withColumnRenamed("id", id_col)
    )


def op10_substring_dedup(spark, sf_dir):
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
