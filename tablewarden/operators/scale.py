"""Building blocks that keep hot keys from landing in one task.

A key may hold a third of all rows, so nothing here puts a whole key into one
window partition, one aggregation buffer or the driver. Group results are
computed with map-side partial aggregation and attached by an equi-join (which
adaptive execution splits when a key is skewed); positions within a group are
computed slice by slice and then shifted by the sizes of the slices before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.session import settle

SLICE_WIDTH = 1_000_000
SMALL_GROUP = 20_000
BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 32 << 20


def attach(big: DataFrame, facts: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``facts`` (one row per ``on``) to ``big``, nulls matching nulls.

    The null-safe comparison is kept for keys without nulls too: it makes Spark
    exchange the (small) facts once more instead of joining on top of their
    aggregation, and only a join of two plain exchanges can be split when a key
    is skewed.
    """
    keys = {c: f"_k_{c}" for c in on}
    right = facts.select(
        *[F.col(c).alias(k) for c, k in keys.items()],
        *[c for c in facts.columns if c not in keys],
    )
    cond = None
    for c, k in keys.items():
        part = F.col(c).eqNullSafe(F.col(k))
        cond = part if cond is None else cond & part
    return big.join(right, cond, how).drop(*keys.values())


def attach_total(df: DataFrame, by: Sequence[str], **totals: Column) -> DataFrame:
    """``agg() over (partition by …)`` as a two-phase aggregate and a join."""
    facts = df.groupBy(*by).agg(*[c.alias(name) for name, c in totals.items()])
    return attach(df, facts, by)


def attach_grand(df: DataFrame, **totals: Column) -> DataFrame:
    """Aggregates over the whole frame on every row; the joined side is one row."""
    return df.join(F.broadcast(df.agg(*[c.alias(n) for n, c in totals.items()])))


def first_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows per key.

    ``row_number() <= k`` is pruned to k rows per key and map task before the
    shuffle, so the task that owns a hot key sees k rows per upstream task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def positions(
    df: DataFrame,
    by: Sequence[str],
    order: str | Sequence[Column],
    out: str = "pos",
    weight: str | None = None,
    width: int | None = SLICE_WIDTH,
) -> DataFrame:
    """1-based position of each row within its key, or a running sum of ``weight``.

    ``order`` as a column name with ``width`` set is an integer ordinal, unique
    within the key: slices are fixed ranges of it. Any other order is range
    partitioned, which adapts the slices to the data; the partition number is
    settled so that both uses of it agree.
    """
    by = list(by)
    if isinstance(order, str) and width:
        cols = [F.col(order)]
        sliced = df.withColumn("_slice", F.floor(F.col(order) / F.lit(width)).cast("bigint"))
    else:
        cols = [F.col(order)] if isinstance(order, str) else list(order)
        sliced = settle(
            df.repartitionByRange(*by, *cols).withColumn(
                "_slice", F.spark_partition_id().cast("bigint")
            )
        )
    # one struct key: nulls equal nulls, and window, sizes and join share one shuffle
    keyed = sliced.withColumn("_key", F.struct(*by, "_slice"))
    inside = Window.partitionBy("_key").orderBy(*cols)
    if weight is None:
        local, size = F.row_number().over(inside), F.count(F.lit(1))
    else:
        local = F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        size = F.sum(weight)
    sizes = keyed.groupBy("_key").agg(size.alias("_size"))
    before = Window.partitionBy(*[F.col(f"_key.{c}") for c in by]).orderBy("_key._slice")
    starts = sizes.select(
        "_key",
        F.coalesce(
            F.sum("_size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_start"),
    )
    return (
        keyed.withColumn("_local", local)
        .join(starts, "_key", "left")
        .withColumn(out, (F.col("_local") + F.col("_start")).cast("bigint"))
        .drop("_key", "_slice", "_local", "_start")
    )


def spread(df: DataFrame) -> DataFrame:
    """More partitions for work that is heavy per row, if the input has fewer than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its rows and bytes are counted to be few, else as it is.

    For frames that are settled or cheap; the join is a shuffle join beyond.
    """
    text = F.octet_length(F.to_json(F.struct("*")))
    seen = df.limit(rows + 1).agg(F.count("*").alias("n"), F.sum(text).alias("b")).first()
    return F.broadcast(df) if seen["n"] <= rows and (seen["b"] or 0) <= size else df


def _percentiles(rows: DataFrame, by: list[str], probs: dict[str, float]) -> DataFrame:
    return rows.groupBy(*by).agg(
        *[F.percentile("_v", F.lit(float(p))).alias(name) for name, p in probs.items()]
    )


def interpolate(n: Column, p: float, low: Column, high: Column) -> Column:
    h = (n - 1) * F.lit(float(p))
    return low + (h - F.floor(h)) * (high - low)


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: dict[str, float],
    small: int = SMALL_GROUP,
    accuracy: int = 10_000,
    at_most: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key.

    The largest group decides the way. Up to ``small`` values, Spark's
    ``percentile`` holds the group in its buffer. Beyond, a sketch gives for
    every quantile a narrow bracket that must enclose it; one more scan counts
    the values between the brackets and keeps only those inside, so no raw
    value outside a bracket is ever shuffled. ``at_most``
    is a bound on the group size the caller already has.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    if at_most is not None and at_most <= small:
        return _percentiles(rows, by, probs)
    names = sorted(probs, key=probs.get)
    eps = 3.0 / accuracy
    ends = [float(min(1.0, max(0.0, probs[n] + s))) for n in names for s in (-eps, eps)]
    fences = settle(
        rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("_n"),
            F.percentile_approx("_v", F.array(*map(F.lit, ends)), F.lit(accuracy)).alias("_f"),
        )
    )
    largest = fences.agg(F.max("_n")).first()[0] or 0
    if largest <= small:
        return _percentiles(rows, by, probs)

    # Brackets in ascending order. A value inside any is kept; of the others only their number
    # counts, apart for each gap: `_gap` says how many brackets lie wholly below. In groups not
    # larger than the accuracy the slack of the sketch is below two ranks: keep all of them.
    v, f, everything = F.col("_v"), F.col("_f"), F.col("_n") <= F.lit(max(small, accuracy))
    inside, gap = everything, F.lit(0)
    for i, (p_lo, p_hi) in enumerate(zip(ends[::2], ends[1::2], strict=True)):
        above = F.lit(p_lo == 0) | (v >= f[2 * i])
        inside = inside | (above & (F.lit(p_hi == 1) | (v <= f[2 * i + 1])))
        gap = gap + F.when(~everything & F.lit(p_hi < 1) & (v > f[2 * i + 1]), 1).otherwise(0)
    counted = (
        attach(rows, small_side(fences), by)
        .groupBy(*by, "_n", gap.alias("_gap"), F.when(inside, v).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    order = [F.col("_gap"), F.col("_v").asc_nulls_first()]
    if largest * len(probs) * 3 * eps + max(small, accuracy) <= SLICE_WIDTH:
        w = Window.partitionBy(*by).orderBy(*order)
        cum = counted.withColumn("_cum", F.sum("_c").over(w))
    else:
        cum = positions(counted, by, order, out="_cum", weight="_c", width=None)
    hits = []
    for name in names:
        h = (F.col("_n") - 1) * F.lit(float(probs[name]))
        for side, k in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            covers = (F.col("_cum") > k) & (F.col("_cum") - F.col("_c") <= k)
            hits.append(F.max(F.when(covers, v)).alias(f"_{side}_{name}"))

    def value_of(name: str) -> Column:
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        lost = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
        found = interpolate(F.col("_n"), probs[name], low, high)
        return F.when(low.isNull() | high.isNull(), lost).otherwise(found).alias(name)

    return (
        cum.groupBy(*by)
        .agg(F.max("_n").alias("_n"), *hits)
        .select(*by, *[value_of(name) for name in probs])
    )
