"""Hard negatives from Hilbert-ordered blocks with zone maps.

Rows are ordered along a Hilbert curve and written as Parquet blocks, one row a block, beside the
least and greatest value of every dimension in it. Interval arithmetic on those bounds every inner
product of an anchor with a block, so an anchor's windows of scores choose the blocks to be read:
first the block of the best bound alone, which says how good a row must be, then all blocks that can
still hold one. Anchors go over the blocks in sweeps of bounded size; blocks are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import prepare, stored, table, trim

POSITIVES, NEGATIVES = 5, 3
ANCHOR_EVERY = 50
# A negative scores at least 50 and at most 95 hundredths of the positive.
LEAST, MOST = 50, 95
BLOCK_ROWS = 512
# The curve runs through this many dimensions, those that vary most, with CURVE_BITS bits in all.
CURVE_DIMENSIONS, CURVE_BITS = 16, 64
# Bytes of anchors' vectors in one sweep over the blocks; more anchors take more sweeps.
SWEEP_BYTES = 32 << 20
# Anchors scored against a block in one product.
ANCHORS_AT_ONCE = 1024
# Ranges of block numbers asked of Parquet at most; close ones are joined.
RANGES = 64
EXACT = 2.0**53
# Under every score (its negative is a 64-bit number too); after every id.
LOWEST, NO_ID = -np.iinfo(np.int64).max, np.iinfo(np.int64).max
BLOCK = "block bigint, ids array<bigint>, labels array<int>, vectors array<bigint>, lows array<bigint>, highs array<bigint>, label_low int, label_high int"
ZONE = ["block", "lows", "highs", "label_low", "label_high"]


# ---- rows to blocks ---------------------------------------------------------------------------


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of ``width`` numbers, short ones filled up with zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (values under ``2**bits``), as unsigned integers."""
    x = cells.T.astype(np.uint64).copy()
    zero, one = np.uint64(0), np.uint64(1)
    steps = [np.uint64(1 << b) for b in range(bits - 1, 0, -1)]
    for q in steps:  # undo the turns of the sub-cubes, coarse to fine
        p = q - one
        for i in range(len(x)):
            on = (x[i] & q) != zero
            t = np.where(on, zero, (x[0] ^ x[i]) & p)
            x[i] ^= t
            x[0] ^= np.where(on, p, t)
    for i in range(1, len(x)):  # Gray code over the dimensions
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.uint64)
    for q in steps:
        t ^= np.where((x[-1] & q) != zero, q - one, zero)
    x ^= t
    key = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for row in x:
            key = (key << one) | ((row >> np.uint64(bit)) & one)
    return key


def _spread(width: int):
    """Per task: number of rows, least, greatest, sum and sum of squares of every dimension."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, parts = 0, []
        for batch in batches:
            v = matrix(batch.column("vector"), width)
            if len(v):
                n += len(v)
                f = v.astype(float)
                parts.append(np.stack([v.min(0), v.max(0), f.sum(0), (f * f).sum(0)]))
        if parts:
            p = np.stack(parts)
            columns = [range(width), p[:, 0].min(0), p[:, 1].max(0), p[:, 2].sum(0), p[:, 3].sum(0)]
            arrays = [pa.array(np.asarray(c, float)) for c in columns] + [pa.array(np.full(width, float(n)))]
            yield pa.RecordBatch.from_arrays(arrays, ["dim", "low", "high", "total", "squares", "n"])

    return spread


def _curve(width: int, dims: np.ndarray, low: np.ndarray, span: np.ndarray, bits: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("vector"), width)[:, dims].astype(float)
            cells = np.clip((v - low) / span * (1 << bits), 0, (1 << bits) - 1)
            key = (hilbert(cells.astype(np.uint64), bits) ^ np.uint64(1 << 63)).view(np.int64)  # signed, same order
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], [*batch.schema.names, "key"])

    return place


def _pack(width: int, rows: int):
    """Rows in the order they come, ``rows`` to a block; block numbers rise along the curve."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def block(ids, labels, v) -> pa.RecordBatch:
            nonlocal number
            number += 1
            numbers = [int(labels.min()), int(labels.max())]
            values = [number, ids, labels, v.ravel(), v.min(0), v.max(0), *numbers]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3, pa.int32(), pa.int32()]
            names = ["block", "ids", "labels", "vectors", "lows", "highs", "label_low", "label_high"]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            held.append((batch.column("id").to_numpy(), batch.column("label").to_numpy(), matrix(batch.column("vector"), width)))
            if sum(len(x[0]) for x in held) >= rows:
                ids, labels, v = (np.concatenate(x) for x in zip(*held, strict=True))
                whole = len(ids) // rows * rows
                for at in range(0, whole, rows):
                    yield block(ids[at : at + rows], labels[at : at + rows], v[at : at + rows])
                held = [(ids[whole:], labels[whole:], v[whole:])]
        if held:
            ids, labels, v = (np.concatenate(x) for x in zip(*held, strict=True))
            if len(ids):
                yield block(ids, labels, v)

    return pack


def build_blocks(rows: DataFrame, width: int, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows with their ``key`` on the curve, blocks with zone maps), both stored. ``rows``: id, label, vector."""
    kinds = "dim double, low double, high double, total double, squares double, n double"
    seen = rows.select("vector").mapInArrow(_spread(width), kinds).groupBy("dim").agg(
        F.min("low"), F.max("high"), F.sum("total"), F.sum("squares"), F.sum("n")
    )
    stats = np.array(sorted(map(tuple, seen.collect())))  # one row a dimension
    deviation = stats[:, 4] / stats[:, 5] - (stats[:, 3] / stats[:, 5]) ** 2
    dims = np.sort(np.argsort(-deviation, kind="stable")[:CURVE_DIMENSIONS])
    low, span = stats[dims, 1], np.maximum(stats[dims, 2] - stats[dims, 1], 1.0)
    place = _curve(width, dims, low, span, min(16, CURVE_BITS // len(dims)))
    keyed = stored(rows.mapInArrow(place, "id bigint, label int, vector array<bigint>, key bigint"), "curve")
    # ids break ties, so copies of one vector fill as many blocks and tasks as they need
    ordered = keyed.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return keyed, stored(ordered.mapInArrow(_pack(width, block_rows), BLOCK), "blocks")


# ---- bounds and scores ------------------------------------------------------------------------


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``: in doubles where those are exact, else in integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def bounds(a: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that a row of ``a`` can have with a vector inside each zone."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    return products(plus, lows) + products(minus, highs), products(plus, highs) + products(minus, lows)


@dataclass
class Targets:
    """Anchors of one sweep and their windows: rows of scores from ``least`` to ``most`` are wanted.

    ``floor`` is the score that the k-th best row of a window has at least. ``same`` asks for rows of
    the anchor's own label (without the anchor), else rows of other labels.
    """

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    least: np.ndarray
    most: np.ndarray
    same: bool
    k: int
    floor: np.ndarray

    def reach(self, at: slice, lows, highs, label_low, label_high) -> np.ndarray:
        """For anchors ``at``, windows and zones: the best score that may be found, ``LOWEST`` where none can."""
        least, most = bounds(self.vectors[at], lows, highs)
        label = self.labels[at][:, None]
        fits = (label_low <= label) & (label <= label_high) if self.same else (label_low != label) | (label_high != label)
        top = np.minimum(most[:, None, :], self.most[at][:, :, None])
        may = fits[:, None, :] & (least[:, None, :] <= top) & (top >= self.least[at][:, :, None])
        return np.where(may, top, LOWEST)


def _zones(batch: pa.RecordBatch, width: int):
    numbers = [batch.column(c).to_numpy() for c in ("label_low", "label_high")]
    return matrix(batch.column("lows"), width), matrix(batch.column("highs"), width), *numbers


def _seeds(t: Targets):
    """Per task, anchor and window: the block of the best bound."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full(t.least.shape, LOWEST)
        block = np.zeros(t.least.shape, np.int64)
        for batch in batches:
            zones, numbers = _zones(batch, t.vectors.shape[1]), batch.column("block").to_numpy()
            for i in range(0, len(t.ids) if len(numbers) else 0, ANCHORS_AT_ONCE):
                at = slice(i, i + ANCHORS_AT_ONCE)
                top = t.reach(at, *zones)
                place = top.argmax(axis=2)
                value = np.take_along_axis(top, place[:, :, None], 2)[:, :, 0]
                better = value > best[at]
                best[at] = np.where(better, value, best[at])
                block[at] = np.where(better, numbers[place], block[at])
        anchor, window = np.nonzero(best > LOWEST)
        arrays = [anchor, window, best[anchor, window], block[anchor, window]]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in arrays], ["anchor", "window", "reach", "block"])

    return seeds


def _needed(t: Targets):
    """Per batch of zones: first and last block that some window must read."""

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zones, numbers = _zones(batch, t.vectors.shape[1]), batch.column("block").to_numpy()
            wanted = np.zeros(len(numbers), bool)
            for i in range(0, len(t.ids) if len(numbers) else 0, ANCHORS_AT_ONCE):
                at = slice(i, i + ANCHORS_AT_ONCE)
                top = t.reach(at, *zones)
                wanted |= ((top > LOWEST) & (top >= t.floor[at][:, :, None])).any(axis=(0, 1))
            found = numbers[wanted]
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array([found.min()]), pa.array([found.max()])], ["low", "high"])

    return needed


class _Best:
    """The k best (score, id) so far of every anchor and window."""

    def __init__(self, t: Targets):
        self.t = t
        self.scores = np.full((*t.least.shape, t.k), LOWEST)
        self.ids = np.full((*t.least.shape, t.k), NO_ID)

    def add(self, anchors: np.ndarray, window: int, scores: np.ndarray, ids: np.ndarray, good: np.ndarray) -> None:
        """Rows of one block: ``scores`` and ``good`` by anchor and row."""
        some = good.any(axis=1)
        anchors, good = anchors[some], good[some]
        if not len(anchors):
            return
        scores = np.where(good, scores[some], LOWEST)
        all_scores = np.concatenate([self.scores[anchors, window], scores], axis=1)
        all_ids = np.concatenate([self.ids[anchors, window], np.where(good, ids, NO_ID)], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.t.k]
        self.scores[anchors, window] = np.take_along_axis(all_scores, order, 1)
        self.ids[anchors, window] = np.take_along_axis(all_ids, order, 1)


def _read(t: Targets, only: dict[int, np.ndarray] | None = None):
    """Per task the k best of every window from the blocks it must read (``only``: from these, for these anchors)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(t)
        width = t.vectors.shape[1]
        for batch in batches:
            zones, numbers = _zones(batch, width), batch.column("block").to_numpy()
            for b, number in enumerate(numbers):
                if only is not None and number not in only:
                    continue
                ids = batch.column("ids")[b].values.to_numpy()
                labels = batch.column("labels")[b].values.to_numpy()
                v = batch.column("vectors")[b].values.to_numpy().reshape(len(ids), width)
                zone = [z[b : b + 1] for z in zones]
                every = np.arange(len(t.ids)) if only is None else only[number]
                for i in range(0, len(every), ANCHORS_AT_ONCE):
                    part = every[i : i + ANCHORS_AT_ONCE]
                    floor = np.maximum(t.floor[part], best.scores[part, :, -1])
                    top = t.reach(part, *zone)[:, :, 0]
                    open_ = (top > LOWEST) & (top >= floor)
                    rows = open_.any(axis=1)
                    part, floor, open_ = part[rows], floor[rows], open_[rows]
                    if not len(part):
                        continue
                    scores = products(t.vectors[part], v)
                    equal = labels == t.labels[part][:, None]
                    good = equal & (ids != t.ids[part][:, None]) if t.same else ~equal
                    for w in range(t.least.shape[1]):
                        low = np.maximum(t.least[part, w], floor[:, w])[:, None]
                        fits = good & open_[:, w, None] & (scores >= low) & (scores <= t.most[part, w][:, None])
                        best.add(part, w, scores, ids, fits)
        found = np.nonzero(best.scores > LOWEST)
        arrays = [found[0], found[1], best.scores[found], best.ids[found]]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in arrays], ["anchor", "window", "score", "id"])
        trim()

    return read


def _first(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _within(blocks: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    """The blocks in ``ranges``, which Parquet's statistics let it skip the others by; at most RANGES are asked for."""
    if not ranges:
        return blocks.where("false")
    joined = [sorted(ranges)[0]]
    for low, high in sorted(ranges)[1:]:
        if low <= joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
        else:
            joined.append((low, high))
    while len(joined) > RANGES:  # close every gap up to the median one
        gaps = [b[0] - a[1] for a, b in zip(joined, joined[1:], strict=False)]
        limit, kept = sorted(gaps)[len(gaps) // 2], joined[:1]
        for gap, r in zip(gaps, joined[1:], strict=True):
            kept[-1:] = [(kept[-1][0], r[1])] if gap <= limit else [kept[-1], r]
        joined = kept
    return blocks.where(reduce(Column.__or__, [F.col("block").between(a, b) for a, b in joined]))


FOUND = "anchor bigint, window bigint, score bigint, id bigint"


def _sweep(blocks: DataFrame, t: Targets) -> DataFrame:
    """(anchor, window, score, id, rank), stored: the k best rows of every window."""
    zones = blocks.select(*ZONE)
    seeds = zones.mapInArrow(_seeds(t), "anchor bigint, window bigint, reach bigint, block bigint")
    seeds = seeds.groupBy("anchor", "window").agg(F.max_by("block", F.struct("reach", "block")).alias("block"))
    chosen = seeds.select("anchor", "block").distinct().toArrow()  # of the anchors of one sweep
    anchors, numbers = (chosen.column(c).to_numpy() for c in ("anchor", "block"))
    order = np.argsort(numbers, kind="stable")
    own, starts = np.unique(numbers[order], return_index=True)
    only = dict(zip(own.tolist(), np.split(anchors[order], starts[1:]), strict=True)) if len(own) else {}
    seeded = _within(blocks, [(b, b) for b in only]).mapInArrow(_read(t, only), FOUND)
    kth = _first(seeded, t.k).where(F.col("rank") == t.k).select("anchor", "window", "score").toArrow()
    t.floor[kth.column("anchor").to_numpy(), kth.column("window").to_numpy()] = kth.column("score").to_numpy()
    ranges = [tuple(r) for r in zones.mapInArrow(_needed(t), "low bigint, high bigint").collect()]  # one a batch of zones
    return stored(_first(_within(blocks, ranges).mapInArrow(_read(t), FOUND), t.k), "windows")


def hundredths(column: str, share: int, up: bool) -> Column:
    """``share`` hundredths of a whole number, rounded up or down, in whole numbers."""
    x = F.col(column) * F.lit(-share if up else share)
    down = (x - F.pmod(x, F.lit(100).cast("bigint"))) / 100
    return (-down if up else down).cast("bigint")


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    block_rows: int = BLOCK_ROWS,
    sweep_bytes: int = SWEEP_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has id, label and vector (whole numbers); ``anchor`` says of a row whether it is one. Each
    anchor's ``positives`` best rows of its label set a window of scores; of the rows of other labels
    within it the ``negatives`` best are returned. Ties go to the smaller id. Rows without an id, label
    or vector, or with a null component, take no part; a shorter vector counts as if filled up with
    zeros, an empty one as zeros. Repeated anchors are one; other repeated rows count each. No anchor
    pairs with its own id. Scores are exact while they fit 64 bits. Empty tables give no rows.
    """
    spark = rows.sparkSession
    prepare(spark)
    rows = rows.select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("int").alias("label"), F.col("vector").cast("array<bigint>").alias("vector"), anchor.alias("is_anchor"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    rows = stored(rows, "vectors")
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    width = rows.agg(F.max(F.size("vector"))).first()[0]
    if not width:
        # without a component every score is 0; one zero component says the same
        rows, width = rows.withColumn("vector", F.array(F.lit(0).cast("bigint"))), 1
    if rows.isEmpty():
        return spark.createDataFrame([], result)
    keyed, blocks = build_blocks(rows.select("id", "label", "vector"), width, block_rows)
    ids = rows.where("is_anchor").select("id").distinct()
    anchors = keyed.join(ids, "id", "left_semi").dropDuplicates(["id", "label", "vector"])
    n = stored(anchors, "anchors")
    sweeps = max(1, -(-n.count() * width * 8 // sweep_bytes))
    # neighbours on the curve share a sweep, so they ask for the same blocks
    anchors = stored(n.repartitionByRange(sweeps, "key", "id").withColumn("sweep", F.spark_partition_id()), "sweeps")
    parts = []
    for s in range(sweeps):
        mine_ = anchors.where(F.col("sweep") == s).select("id", "label", "vector").toArrow().combine_chunks()
        if not mine_.num_rows:
            continue
        own, labels = mine_.column("id").to_numpy(), mine_.column("label").to_numpy()
        v = matrix(mine_.column("vector").combine_chunks(), width)
        wide = lambda x: np.full((len(own), 1), x, np.int64)
        good = _sweep(blocks, Targets(own, labels, v, wide(LOWEST + 1), wide(NO_ID), True, positives, wide(LOWEST)))
        good = good.select("anchor", F.col("score").alias("positive_score"), F.col("id").alias("positive_id"), (F.col("rank") - 1).cast("bigint").alias("window"))
        good = good.withColumns({"least": hundredths("positive_score", LEAST, True), "most": hundredths("positive_score", MOST, False)})
        known = good.select("anchor", "window", "least", "most").toArrow()
        least, most = np.full((len(own), positives), NO_ID), np.full((len(own), positives), LOWEST)
        places = known.column("anchor").to_numpy(), known.column("window").to_numpy()
        least[places], most[places] = known.column("least").to_numpy(), known.column("most").to_numpy()
        bad = _sweep(blocks, Targets(own, labels, v, least, most, False, negatives, np.full(least.shape, LOWEST)))
        bad = bad.select(F.col("anchor").alias("of"), F.col("window").alias("at"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        names = spark.createDataFrame(pa.table({"number": np.arange(len(own)), "anchor_id": own}))
        both = good.join(bad, (F.col("anchor") == F.col("of")) & (F.col("window") == F.col("at"))).join(names, F.col("anchor") == F.col("number"))
        parts.append(both.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], result)


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component; null if one is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~odd, F.transform(x, lambda v: F.floor(v * scale)))


def op11_hard_negatives(spark, sf_dir):
    """Rows whose id is divisible by 50 against all rows of ``embeddings``."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("id"), moved.alias("label"), whole_numbers(F.col("embedding")).alias("vector"))
    return mine(rows, F.col("id") % ANCHOR_EVERY == 0)


OP11_SQL = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_inner_product(a.vector, b.vector)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES}
)
SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER best <= {NEGATIVES}
"""
