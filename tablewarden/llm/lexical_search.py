"""Ranked lexical search with range-maximum sparse tables over posting lists.

Documents are scanned once for the terms the items ask for. A task reads its share of the found terms
in blocks of whole documents. Within a block every posting list has a sparse table that answers which
posting of a range has the largest impact, so the sum over an item's terms bounds every interval of
documents. Intervals are taken best bound first and split at the document of their largest impact,
which is scored; an interval whose bound falls behind the k best documents is never entered. Each task
hands on its k best documents of every item.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import blocks, byte_sums, pick, prepare, span_hash, stored, table, trim

TOP = 10
# Pairs of item and term searched for in one pass over the documents; more items take more passes.
PASS_TERMS = 500_000
# A block takes whole documents until it holds this many postings.
BLOCK_POSTINGS = 1 << 19
# Intervals split in one numpy step, best bounds first.
AT_ONCE = 128
# The k best of all tasks meet in this many groups an item before they meet in one.
MEETINGS = 64
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = np.iinfo(np.int64).max  # a row without an id comes after all others

# Bytes of terms: digits, ASCII letters and every byte of a multi-byte character.
IN_TERM = np.zeros(256, bool)
IN_TERM[48:58] = IN_TERM[65:91] = IN_TERM[97:123] = IN_TERM[128:] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def term_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end and row of every term of a block of texts."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = IN_TERM[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(off, starts, "right") - 1


def term_hashes(terms: list[str]) -> np.ndarray:
    raw = [t.encode() for t in terms]
    ends = np.cumsum([len(r) for r in raw])
    return span_hash(byte_sums(np.frombuffer(b"".join(raw), np.uint8)), ends - [len(r) for r in raw], ends)


# ---- documents to postings --------------------------------------------------------------------

FOUND = "id bigint, n bigint, terms array<int>, counts array<int>"


def _finder(hashes: np.ndarray):
    """Terms of each text that are asked for: places in the sorted ``hashes`` and their counts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, off in blocks(batch.column("text")):
                rows = len(off) - 1
                data = FOLD[data]
                starts, ends, row = term_spans(data, off)
                n = np.bincount(row, minlength=rows)
                h = span_hash(byte_sums(data), starts, ends)
                place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                asked = hashes[place] == h
                pair, counts = np.unique(row[asked] * len(hashes) + place[asked], return_counts=True)
                to = np.searchsorted(pair, np.arange(rows + 1) * len(hashes)).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(to, pa.array((pair % len(hashes)).astype(np.int32))),
                    pa.ListArray.from_arrays(to, pa.array(counts.astype(np.int32))),
                ]
                found = pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, rows), pa.array(n.astype(np.int64)), *lists], ["id", "n", "terms", "counts"]
                )
                yield found.filter(pa.array(n > 0))
        trim()

    return find


# ---- one block of documents -------------------------------------------------------------------


class Block:
    """Posting lists of some documents one after another, by term and document, with one sparse table.

    ``largest[j, i]`` is the place of the largest impact among the ``2**j`` postings from ``i`` on. A
    range is covered by two such windows that lie within it, so no answer reaches over a list's end.
    """

    def __init__(self, ids, n, lengths, terms, counts, weights, n_docs: int, n_terms: int):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        doc = np.repeat(np.arange(len(ids)), lengths)
        counts = counts.astype(np.int64)
        length = 25 + 75 * n * n_docs // n_terms
        impact = weights[terms] * (10**9 * counts // (1000 * counts + 8 * length[doc]))
        self.size = max(1, len(ids))
        key = terms.astype(np.int64) * self.size + place[doc]
        order = np.argsort(key)
        self.key, self.impact = key[order], impact[order]
        sizes = np.bincount(terms, minlength=len(weights))
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        levels = int(sizes.max(initial=0)).bit_length() or 1
        self.largest = np.empty((levels, len(key)), np.int32)
        self.largest[0] = np.arange(len(key))
        for j in range(1, levels):
            half, below = 1 << (j - 1), self.largest[j - 1]
            self.largest[j] = below
            left, right = below[:-half], below[half:]
            self.largest[j, :-half] = np.where(self.impact[right] > self.impact[left], right, left)
        self.log = np.frexp(np.arange(max(2, int(sizes.max(initial=0)) + 1)))[1] - 1

    def maxima(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the largest impacts of the ranges from ``a`` to ``b``, none of them empty."""
        level = self.log[b - a]
        one, two = self.largest[level, a], self.largest[level, b - (1 << level)]
        return np.where(self.impact[two] > self.impact[one], two, one)

    def search(self, terms: np.ndarray, times: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int):
        """``best`` (scores, ids), best first, after this block; documents with score 0 take no part."""
        have = self.first[terms + 1] > self.first[terms]
        terms, times = terms[have], times[have]
        if not len(terms):
            return best
        base = terms.astype(np.int64) * self.size
        every = np.arange(len(terms))
        open_ = _Intervals(self, times)
        open_.add(np.zeros(1, np.int64), np.zeros(len(terms), np.int64), every, self.first[terms], self.first[terms + 1], 0)
        while True:
            scores, ids = best
            least, last = (scores[-1], ids[-1]) if len(scores) >= k else (0, -1)
            now = open_.take(least, last)
            if now is None:
                return best
            low, split, row, col, a, b = now
            wanted = base[col] + split[row]
            place = np.searchsorted(self.key, wanted)
            hit = (place < b) & (self.key[np.minimum(place, len(self.key) - 1)] == wanted)
            heads = _heads(row)
            score = np.add.reduceat(np.where(hit, self.impact[np.minimum(place, len(self.key) - 1)] * times[col], 0), heads)
            left, right = a < place, place + hit < b
            open_.add(
                np.concatenate([low, split + 1]),
                np.concatenate([row[left], row[right] + len(low)]),
                np.concatenate([col[left], col[right]]),
                np.concatenate([a[left], (place + hit)[right]]),
                np.concatenate([place[left], b[right]]),
                least,
            )
            scores, ids = np.concatenate([scores, score]), np.concatenate([ids, self.ids[split]])
            order = np.lexsort((ids, -scores))[:k]
            best = scores[order], ids[order]


def _heads(row: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.concatenate([[0], np.flatnonzero(row[1:] != row[:-1]) + 1])


class _Intervals:
    """Open intervals of documents, each with the posting ranges of the terms that occur in it.

    Intervals do not overlap, so all ranges together are no more than the postings of the block.
    """

    def __init__(self, block: Block, times: np.ndarray):
        self.block, self.times = block, times
        self.heads = np.zeros((5, 0), np.int64)  # start and count of its ranges, first document, bound, split
        self.ranges = np.empty((3, 1024), np.int64)  # term, from, to
        self.used = 0

    def add(self, low, row, col, a, b, least: int) -> None:
        """Intervals numbered by ``row`` (ascending), first documents ``low``; those under ``least`` are left out."""
        if not len(row):
            return
        block = self.block
        place = block.maxima(a, b)
        impact = block.impact[place] * self.times[col]
        starts = _heads(row)
        counts = np.concatenate([starts[1:], [len(row)]]) - starts
        bound, most = np.add.reduceat(impact, starts), np.maximum.reduceat(impact, starts)
        tops = np.flatnonzero(impact == np.repeat(most, counts))
        split = block.key[place[tops[np.searchsorted(tops, starts)]]] % block.size
        good = (bound >= least) & (bound > 0)
        kept = np.repeat(good, counts)
        heads = np.stack([np.cumsum(counts[good]) - counts[good] + self.used, counts[good], low[row[starts[good]]], bound[good], split[good]])
        n = int(kept.sum())
        if self.used + n > self.ranges.shape[1]:
            self._grow(n)
            heads[0] += self.used - (heads[0, 0] if heads.shape[1] else 0)
        self.ranges[:, self.used : self.used + n] = col[kept], a[kept], b[kept]
        self.used += n
        self.heads = np.concatenate([self.heads, heads], axis=1)

    def _grow(self, n: int) -> None:
        """Let go of ranges of intervals that were taken, then make room for as many again."""
        _, at = self._gather(self.heads)
        room = np.empty((3, 2 * (len(at) + n) + 1024), np.int64)
        room[:, : len(at)] = self.ranges[:, at]
        self.ranges, self.used = room, len(at)
        self.heads[0] = np.cumsum(self.heads[1]) - self.heads[1]

    def _gather(self, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(heads.shape[1]), heads[1])
        before = np.cumsum(heads[1]) - heads[1]
        return row, np.arange(len(row)) + np.repeat(heads[0] - before, heads[1])

    def take(self, least: int, last: int):
        """The open intervals of the best bounds, or None if none can hold a better document."""
        bound, ids = self.heads[3], self.block.ids
        # a tie goes to the smaller id, and ids rise within a block
        live = (bound > least) | ((bound == least) & (ids[np.minimum(self.heads[2], len(ids) - 1)] < last))
        heads = self.heads[:, live]
        if not heads.shape[1]:
            return None
        order = np.lexsort((heads[2], -heads[3]))
        now, self.heads = heads[:, order[:AT_ONCE]], heads[:, order[AT_ONCE:]]
        row, at = self._gather(now)
        return now[2], now[4], row, *self.ranges[:, at]


def _searcher(weights, items: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, n_terms: int, k: int):
    """The k best documents of every item among the rows of a task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        best = {item: none for item, _, _ in items}
        held: list[pa.RecordBatch] = []

        def finish() -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            lists = rows.column("terms").combine_chunks()
            block = Block(
                rows.column("id").fill_null(NO_ID).to_numpy(),
                rows.column("n").to_numpy(),
                lists.value_lengths().to_numpy(zero_copy_only=False),
                lists.flatten().to_numpy(),
                rows.column("counts").combine_chunks().flatten().to_numpy(),
                weights, n_docs, n_terms,
            )
            for item, terms, times in items:
                best[item] = block.search(terms, times, best[item], k)

        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten())
            if size >= BLOCK_POSTINGS:
                finish()
                size = 0
        if held:
            finish()
        found = [(i, id_, s) for i, (scores, ids) in best.items() for s, id_ in zip(scores.tolist(), ids.tolist(), strict=True) if s > 0]
        item, id_, score = zip(*found, strict=True) if found else [()] * 3
        ids = pa.array([None if x == NO_ID else x for x in id_], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), ids, pa.array(score, pa.int64())], ["item", "id", "score"])
        trim()

    return search


# ---- all documents ----------------------------------------------------------------------------


def _best(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _one_pass(rows: DataFrame, asked: list, k: int) -> DataFrame:
    """(item, id, score): the k best documents per task of the items of one pass."""
    terms = sorted({r.term for r in asked})
    hashes = term_hashes(terms)
    order = np.argsort(hashes)
    hashes, place = hashes[order], {terms[o]: i for i, o in enumerate(order)}
    if len(np.unique(hashes)) < len(hashes):
        raise ValueError("two terms of the items have the same 64-bit hash")
    found = stored(rows.mapInArrow(_finder(hashes), FOUND), "found-terms")
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ratio = F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)
    weights = np.zeros(len(hashes), np.int64)
    for term, weight in held.select("term", F.floor(1000 * F.log(ratio)).alias("w")).collect():  # asked terms only
        weights[term] = weight
    by_item: dict[int, list] = {}
    for r in asked:
        by_item.setdefault(r.item, []).append((place[r.term], r.times))
    items = [(i, *(np.array(x, np.int64) for x in zip(*pairs, strict=True))) for i, pairs in by_item.items()]
    return found.mapInArrow(_searcher(weights, items, n_docs, n_terms, k), "item bigint, id bigint, score bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of every item, score above 0.

    Equal scores come by ascending id, rows without an id last. Null texts and texts without a term
    are no documents and no items; item rows that repeat id and text are one, other texts under one id
    are ranked each for itself. Repeated document rows are documents of their own. Whole texts count.
    A term is known by a 64-bit hash; that two terms of the items share one is checked.

    Items go to the driver and the tasks at most ``PASS_TERMS`` terms at a time (one item is never
    split); further items take further passes, so nothing is left out.
    """
    prepare(docs.sparkSession)
    texts = pick(items, item_col, item_text_col).dropDuplicates(["id", "text"])
    texts = stored(texts.withColumn("item", F.monotonically_increasing_id()), "items")
    asked = texts.select("item", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("item", "term")
    asked = stored(asked.agg(F.count(F.lit(1)).alias("times")), "item-terms")
    passes = -(-asked.count() // PASS_TERMS)
    rows = pick(docs, id_col, text_col).select(F.col("id").cast("bigint").alias("id"), "text")
    parts = []
    for p in range(passes):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == p).collect()
        if mine:
            parts.append(_one_pass(rows, mine, k))
    if not parts:
        return texts.limit(0).select(F.col("id").alias(item_col), F.lit(1).alias("rank"), F.lit(1).cast("bigint").alias(id_col), F.lit(1).cast("bigint").alias("score"))
    found = reduce(DataFrame.union, parts).withColumn("meeting", F.pmod(F.spark_partition_id(), F.lit(MEETINGS)))
    best = _best(_best(found, k, "item", "meeting").drop("rank"), k, "item")
    named = best.join(texts.select("item", F.col("id").alias("own")), "item")
    return named.select(F.col("own").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def op13_ranked_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP13_SQL = f"""
WITH docs AS (SELECT doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL
), long AS (SELECT doc_id, terms, len(terms) AS n FROM docs WHERE len(terms) > 0
), totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM long
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
), tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM long)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, totals GROUP BY term
), scored AS (
  SELECT item_id, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM tf JOIN weights USING (term) JOIN asked USING (term), totals GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
