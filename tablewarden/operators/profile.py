"""Column profiles: counts, moments, quantiles, inferred types, samples, read budget."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tablewarden.functions.names import is_id_name
from tablewarden.operators.scale import (
    SLICE_WIDTH,
    attach,
    attach_grand,
    exact_quantiles,
    first_rows,
    interpolate,
    positions,
    small_side,
)
from tablewarden.session import settle

QUANTILES = {"median": 0.5, "p25": 0.25, "p75": 0.75}
STATS = ["mean", "sd", "se", "median", "min", "max", "range", "p25", "p75", "iqr", "skewness", "kurtosis"]

# Thresholds of the type rules.
DATE_SHARE, LONG_TEXT = 0.70, 40
COMMA_SHARE, OUTLIER_SHARE, MANY_VALUES = 0.95, 0.80, 20
INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Column types an outside answer may carry.
COLUMN_TYPES = [
    "continuous", "binary", "categorical", "ordinal", "date", "id", "text", "continuous_comma_decimal",
    "continuous_outliers_excluded", "empty", "constant", "unknown", "llm_error",
]


def long_form(
    df: DataFrame,
    columns: Sequence[str],
    keep: Sequence[str] = (),
    cast: str = "string",
    positions: Sequence[int] | None = None,
) -> DataFrame:
    """One row per (row, column): ``keep…, col_pos, column_name, value``."""
    cells = [
        F.struct(
            F.lit(i).alias("col_pos"),
            F.lit(c).alias("column_name"),
            F.col(f"`{c}`").cast(cast).alias("value"),
        )
        for i, c in zip(positions or range(1, len(columns) + 1), columns, strict=True)
    ]
    return df.select(*keep, F.inline(F.array(*cells)))


def _clean(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def moments(v: Column) -> dict[str, Column]:
    """Moments of ``v`` with the sample standard deviation in every denominator."""
    n, sd = F.count(v), F.stddev_samp(v)
    shrink = (n - 1) / n
    return {
        "mean": F.avg(v),
        "sd": F.when(n > 1, sd),
        "se": F.when(n > 1, sd / F.sqrt(n)),
        "min": F.min(v),
        "max": F.max(v),
        "range": F.max(v) - F.min(v),
        "skewness": F.when((n > 2) & (sd > 0), F.skewness(v) * F.pow(shrink, F.lit(1.5))),
        "kurtosis": F.when((n > 3) & (sd > 0), (F.kurtosis(v) + 3) * shrink * shrink - 3),
    }


def _kind(df: DataFrame, column: str) -> str:
    name = df.schema[column].dataType.typeName()
    if name in ("double", "float"):
        return "double"
    return "bigint" if name in ("byte", "short", "integer", "long") else "string"


def profile_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per column: non-null, missing and distinct values. NaN counts as missing.

    A value is counted once per (column, value) before the shuffle, so a value
    that fills a third of a column travels once per task. Numbers are compared
    as numbers; only what is no number goes through text.
    """
    out = None
    for kind in ("bigint", "double", "string"):
        chosen = [c for c in columns if _kind(df, c) == kind]
        if not chosen:
            continue
        cells = long_form(df, chosen, by, cast=kind, positions=[columns.index(c) + 1 for c in chosen])
        value = F.col("value")
        if kind == "double":
            # zero and negative zero are one value
            cells = cells.withColumn("value", _clean(value) + F.lit(0.0))
        part = (
            cells.groupBy(*by, "col_pos", "column_name", "value")
            .agg(F.count(F.lit(1)).alias("c"))
            .groupBy(*by, "col_pos", "column_name")
            .agg(
                F.coalesce(F.sum(F.when(value.isNotNull(), F.col("c"))), F.lit(0)).alias("n"),
                F.coalesce(F.sum(F.when(value.isNull(), F.col("c"))), F.lit(0)).alias("n_missing"),
                F.count("value").alias("n_unique"),
            )
        )
        out = part if out is None else out.unionByName(part)
    return out


def profile_moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Moments per numeric column from one wide aggregate: no row is multiplied or shuffled."""
    wide = df.groupBy(*by).agg(
        *[
            F.struct(
                *[e.alias(name) for name, e in moments(_clean(F.col(c).cast("double"))).items()]
            ).alias(f"_m{i}")
            for i, c in enumerate(columns)
        ]
    )
    cells = [
        F.struct(F.lit(i + 1).alias("col_pos"), F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("m"))
        for i, c in enumerate(columns)
    ]
    return wide.select(*by, F.inline(F.array(*cells))).select(*by, "col_pos", "column_name", "m.*")


def profile_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The twelve statistics per numeric column, one row per column and key."""
    quantiles = exact_quantiles(
        long_form(df, columns, by, cast="double"), [*by, "column_name"], "value", QUANTILES
    )
    return attach(profile_moments(df, columns, by), quantiles, [*by, "column_name"]).withColumn(
        "iqr", F.col("p75") - F.col("p25")
    )


def frequencies(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by…, col_pos, column_name, i, d, s, c``: how often every value of every column occurs, in one scan.

    A value stands in the column of its kind (whole number, number, text), a missing one in none. It is
    counted per task before the shuffle, so a value that fills a third of a column travels once per task.
    """
    kinds = {"i": "bigint", "d": "double", "s": "string"}
    cells = []
    for at, c in enumerate(columns, 1):
        own = _kind(df, c)
        value = F.col(f"`{c}`").cast(own)
        # NaN is missing, zero and negative zero are one value
        value = _clean(value) + F.lit(0.0) if own == "double" else value
        typed = [(value if kind == own else F.lit(None).cast(kind)).alias(name) for name, kind in kinds.items()]
        cells.append(F.struct(F.lit(at).alias("col_pos"), F.lit(c).alias("column_name"), *typed))
    tall = df.select(*by, F.inline(F.array(*cells)))
    return tall.groupBy(*by, "col_pos", "column_name", *kinds).agg(F.count(F.lit(1)).alias("c"))


def profile_table(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Counts and the twelve statistics per column and key, from two scans.

    One is a table of frequencies, settled, from which counts and quantiles come: running counts over
    the values in order, within a key or, where a column has very many values, within ranges of them.
    The other is one wide aggregate for the moments, which shuffles a row per task and key.
    """
    keys = [*by, "col_pos", "column_name"]
    freq = settle(frequencies(df, columns, by))
    c, v = F.col("c"), F.coalesce("d", F.col("i").cast("double"), F.col("s").try_cast("double"))
    there = F.coalesce(F.col("i").isNotNull() | F.col("d").isNotNull() | F.col("s").isNotNull(), F.lit(False))
    counts = settle(
        freq.groupBy(*keys).agg(
            F.coalesce(F.sum(F.when(there, c)), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(~there, c)), F.lit(0)).alias("n_missing"),
            F.count_if(there).alias("n_unique"),
            F.coalesce(F.sum(F.when(v.isNotNull(), c)), F.lit(0)).alias("_n"),
        )
    )
    values = freq.select(*keys, v.alias("_v"), "c").where("_v IS NOT NULL")
    many = counts.agg(F.max("n_unique")).first()[0] or 0
    if many <= SLICE_WIDTH:
        ranked = values.withColumn("_cum", F.sum("c").over(Window.partitionBy(*keys).orderBy("_v")))
    else:
        ranked = positions(values, keys, [F.col("_v")], out="_cum", weight="c", width=None)
    ranked = attach(ranked, small_side(counts.select(*keys, "_n")), keys)
    ends = {}
    for name, p in QUANTILES.items():
        h = (F.col("_n") - 1) * F.lit(float(p))
        for side, k in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            covers = (F.col("_cum") > k) & (F.col("_cum") - F.col("c") <= k)
            ends[f"_{side}_{name}"] = F.max(F.when(covers, F.col("_v")))
    found = attach(counts, ranked.groupBy(*keys).agg(*[e.alias(name) for name, e in ends.items()]), keys)
    found = found.withColumns({q: interpolate(F.col("_n"), p, F.col(f"_lo_{q}"), F.col(f"_hi_{q}")) for q, p in QUANTILES.items()})
    out = attach(found, profile_moments(df, columns, by), keys).withColumn("iqr", F.col("p75") - F.col("p25"))
    return out.select(*keys, "n", "n_missing", "n_unique", *STATS)


def as_number(value: Column) -> Column:
    """Numbers and ``Inf``; ``NaN`` is a missing number, hence null."""
    endless = F.when(F.trim(value).startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(value.rlike(NUMBER), F.trim(value).try_cast("double")).when(value.rlike(INFINITE), endless)


def as_comma_number(value: Column) -> Column:
    return as_number(F.replace(value, F.lit(","), F.lit(".")))


def is_date_text(value: Column) -> Column:
    """A leading calendar date, ``Y-m-d`` or ``Y/m/d``; the year has one to four digits."""
    parts = r"^\s*([0-9]{1,4})([-/])([0-9]{1,2})\2([0-9]{1,2})"
    year, month, day = (F.regexp_extract(value, parts, i) for i in (1, 3, 4))
    text = F.concat_ws("-", F.lpad(year, 4, "0"), month, day)
    return F.try_to_date(F.when(year != "", text), "yyyy-M-d").isNotNull()


def infer_types(cells: DataFrame, by: Sequence[str] = (), date_sample: int | None = None) -> DataFrame:
    """Type of every column from its cells ``(by…, col_pos, column_name, ord, value)``.

    Cells are text. A column is numeric when every value that is neither null,
    ``NA`` nor blank reads as a number; blanks and ``NaN`` are missing only
    there. All tests are sums over the distinct values. ``date_sample`` lets the
    date test look at the first so many distinct values in file order only.
    """
    keys = [*by, "col_pos", "column_name"]
    distinct = (
        cells.withColumn("value", F.when(F.col("value") != "NA", F.col("value")))
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("c"), F.min("ord").alias("first_ord"))
        .withColumn("num", as_number(F.col("value")))
        .withColumn("comma", as_comma_number(F.col("value")))
        .withColumn("filled", F.col("value").isNotNull() & (F.trim("value") != ""))
        .withColumn("nan", F.coalesce(F.trim("value") == "NaN", F.lit(False)))
    )
    c, value, filled = F.col("c"), F.col("value"), F.col("filled")
    # lengths above 2 * LONG_TEXT cannot change the verdict; clipping bounds the buffer
    clipped = F.least(F.length(value), F.lit(2 * LONG_TEXT + 1))
    facts = distinct.groupBy(*keys).agg(
        F.sum(c).alias("n_rows"),
        F.coalesce(F.sum(F.when(value.isNotNull(), c)), F.lit(0)).alias("n_value"),
        F.coalesce(F.sum(F.when(filled, c)), F.lit(0)).alias("n_filled"),
        F.coalesce(F.sum(F.when(F.col("num").isNotNull(), c)), F.lit(0)).alias("n_num"),
        F.coalesce(F.sum(F.when(F.col("nan"), c)), F.lit(0)).alias("n_nan"),
        F.avg(F.when(value.isNotNull(), is_date_text(value).cast("double"))).alias("date_share"),
        F.coalesce(F.sum(F.when(F.col("comma").isNotNull(), c)), F.lit(0)).alias("n_comma"),
        F.count("value").alias("u_text"),
        F.count_distinct("num").alias("u_num"),
        F.coalesce(F.bool_or((F.abs("num") < float("inf")) & (F.col("num") != F.floor("num"))), F.lit(False)).alias("fraction"),
        F.percentile(F.when(value.isNotNull(), clipped), F.lit(0.5), c).alias("mid_len"),
        F.percentile(F.when(filled & ~F.col("nan"), clipped), F.lit(0.5), c).alias("mid_len_filled"),
    )
    if date_sample:
        order = [F.col("first_ord"), F.col("value")]
        dates = (
            first_rows(distinct.where(value.isNotNull()), keys, order, date_sample)
            .groupBy(*keys)
            .agg(F.avg(is_date_text(value).cast("double")).alias("date_share"))
        )
        facts = attach(facts.drop("date_share"), dates, keys)
    n_num, n_nan, n_filled = F.col("n_num"), F.col("n_nan"), F.col("n_filled")
    numeric = (n_filled > 0) & (n_num + n_nan == n_filled)
    n = F.when(numeric, n_num).when(n_filled == 0, n_filled).otherwise(F.col("n_value"))
    u = F.when(numeric, F.col("u_num")).when(n_filled == 0, F.lit(0)).otherwise(F.col("u_text"))
    date_share = F.coalesce("date_share", F.lit(0.0))
    mid = F.when(numeric, F.col("mid_len_filled")).otherwise(F.col("mid_len"))
    ok = F.col("n_comma") / n
    col_type = (
        F.when(n == 0, F.lit("empty"))
        .when(is_id_name(F.col("column_name")), F.lit("id"))
        .when(u == 1, F.lit("constant"))
        .when(u == 2, F.lit("binary"))
        .when(date_share >= DATE_SHARE, F.lit("date"))
        .when(mid > LONG_TEXT, F.lit("text"))
        .when(numeric & (F.col("fraction") | (u > MANY_VALUES)), F.lit("continuous"))
        .when(numeric, F.lit(None).cast("string"))
        .when(ok >= COMMA_SHARE, F.lit("continuous_comma_decimal"))
        .when(ok >= OUTLIER_SHARE, F.lit("continuous_outliers_excluded"))
    )
    return facts.select(
        *keys,
        col_type.alias("col_type"),
        numeric.alias("is_numeric"),
        F.when(
            col_type.isin("continuous_comma_decimal", "continuous_outliers_excluded"),
            n - F.col("n_comma"),
        ).alias("n_coerced"),
        n.alias("n"),
        (F.col("n_rows") - n).alias("n_missing"),
        u.alias("n_unique"),
    )


def resolve_types(types: DataFrame, answers: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Close the open types: numeric → continuous; text → a valid answer, else ``text``.

    ``answers`` carries ``(by…, column_name, answer)``, one row per column name.
    """
    open_type = F.col("col_type").isNull()
    known = (
        attach(types, answers, [*by, "column_name"])
        if answers is not None
        else types.withColumn("answer", F.lit(None).cast("string"))
    )
    answer = F.when(F.col("answer").isin(COLUMN_TYPES) & (F.col("answer") != "unknown"), F.col("answer"))
    numeric, asked = F.col("is_numeric"), F.col("answer").isNotNull()
    return known.select(
        *types.columns[: types.columns.index("col_type")],
        F.when(~open_type, F.col("col_type"))
        .when(numeric, F.lit("continuous"))
        .otherwise(F.coalesce(answer, F.lit("text")))
        .alias("col_type"),
        F.when(~open_type | numeric, F.lit("rules"))
        .when(asked, F.lit("llm"))
        .otherwise(F.lit("fallback"))
        .alias("col_type_method"),
        *types.columns[types.columns.index("col_type") + 1 :],
    )


def describe_columns(
    cells: DataFrame, answers: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Types with counts, and the twelve statistics for ``continuous…`` columns only."""
    keys = [*by, "col_pos", "column_name"]
    types = settle(resolve_types(infer_types(cells, by), answers, by))
    numeric = F.col("col_type").startswith("continuous")
    values = attach(
        cells.select(*keys, "value"), types.where(numeric).select(*keys, "col_type"), keys, "inner"
    ).select(
        *keys,
        F.when(F.col("col_type") == "continuous", as_number(F.col("value")))
        .otherwise(as_comma_number(F.col("value")))
        .alias("v"),
    )
    stats = values.groupBy(*keys).agg(*[e.alias(k) for k, e in moments(F.col("v")).items()])
    full = attach(stats, exact_quantiles(values, keys, "v", QUANTILES), keys).withColumn(
        "iqr", F.col("p75") - F.col("p25")
    )
    return attach(types, full.select(*keys, *STATS), keys)


def sample_values(cells: DataFrame, by: Sequence[str] = (), k: int = 5) -> DataFrame:
    """The first ``k`` non-null values of each column in file order, joined."""
    keys = [*by, "col_pos", "column_name"]
    head = first_rows(cells.where(F.col("value").isNotNull()), keys, [F.col("ord")], k)
    return head.groupBy(*keys).agg(_joined("ord", "value", " | ").alias("sample_values"))


def distinct_samples(cells: DataFrame, by: Sequence[str] = (), k: int = 20) -> DataFrame:
    """The first ``k`` distinct values of each column in file order, joined."""
    keys = [*by, "col_pos", "column_name"]
    firsts = (
        cells.where(F.col("value").isNotNull())
        .groupBy(*keys, "value")
        .agg(F.min("ord").alias("ord"))
    )
    head = first_rows(firsts, keys, [F.col("ord")], k)
    return head.groupBy(*keys).agg(_joined("ord", "value", ", ").alias("sample_values_unique"))


def _joined(order: str, value: str, sep: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(order, value)))
    return F.array_join(F.transform(rows, lambda r: r[value]), sep)


def strip_export_header(rows: DataFrame, file: Sequence[str], row_nr: str, cells: str) -> DataFrame:
    """Drop the leading rows a survey tool writes above the data.

    ``row_nr`` counts a file's rows from 1, ``cells`` is an array. If one of
    the first three rows has an ``{…ImportId`` cell, it and all before it go.
    Files of a single row are left alone.
    """
    mark = F.exists(F.col(cells), lambda c: F.coalesce(c.rlike(r"^\{.*ImportId"), F.lit(False)))
    hits = (
        rows.where(F.col(row_nr) <= 3)
        .groupBy(*file)
        .agg(
            F.min(F.when(mark, F.col(row_nr))).alias("_hit"), F.max(row_nr).alias("_seen")
        )
        .where(F.col("_hit").isNotNull() & (F.col("_seen") >= 2))
    )
    return (
        attach(rows, hits, file)
        .where(F.col("_hit").isNull() | (F.col(row_nr) > F.col("_hit")))
        .drop("_hit", "_seen")
    )


def read_budget(
    files: DataFrame,
    by: Sequence[str],
    order: str,
    size: str,
    file_cap: int,
    total_cap: int,
    fold_limit: int = 50_000,
    readable: str | None = None,
) -> DataFrame:
    """Which files are read: none above ``file_cap``; greedy up to ``total_cap`` per key.

    In ``order`` a file that would pass the cap is skipped and later smaller
    ones may still fit; unreadable files use up nothing. Keys within the cap
    take all their files. Keys over it with few files are folded in one list, in linear
    time; keys with more go through rounds of distributed running sums (see
    ``_greedy_rounds``).
    """
    by = list(by)
    can = F.col(size) <= file_cap
    if readable:
        can = can & F.col(readable)
    cand = files.where(can).select(*by, order, F.col(size).cast("bigint").alias("_s"))
    totals = cand.groupBy(*by).agg(F.sum("_s").alias("_sum"), F.count(F.lit(1)).alias("_cnt"))
    over = attach(cand, totals, by)
    fits = over.where(F.col("_sum") <= total_cap).select(*by, order)
    tight = over.where(F.col("_sum") > total_cap)

    small = tight.where(F.col("_cnt") <= fold_limit)
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).cast("bigint").alias("o"), F.col("_s").alias("s"))))
    listed = small.groupBy(*by).agg(parts.alias("_l"))
    listed = listed.select(*by, F.transform("_l", lambda r: r["o"]).alias("_o"), F.transform("_l", lambda r: r["s"]).alias("_z"))
    kinds = StructType([*[listed.schema[c] for c in by], StructField("_o", ArrayType(LongType()))])
    folded = listed.mapInArrow(_greedy(total_cap), kinds).select(*by, F.explode("_o").alias(order))
    large = tight.where(F.col("_cnt") > fold_limit).select(*by, order, "_s")
    taken = fits.unionByName(folded).unionByName(_greedy_rounds(large, by, order, total_cap))
    flagged = attach(files, taken.withColumn("is_read", F.lit(True)), [*by, order])
    return flagged.withColumn("is_read", F.coalesce("is_read", F.lit(False)))


def _greedy(cap: int):
    """Files taken one after another while they fit, one list per key in linear time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken = []
            for orders, sizes in zip(batch.column("_o"), batch.column("_z"), strict=True):
                left, kept = cap, []
                for o, s in zip(orders.as_py(), sizes.as_py(), strict=True):
                    if s <= left:
                        left -= s
                        kept.append(o)
                taken.append(kept)
            names = [n for n in batch.schema.names if n not in ("_o", "_z")]
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(taken, pa.list_(pa.int64()))], [*names, "_o"])

    return run


def _greedy_rounds(cand: DataFrame, by: list[str], order: str, cap: int) -> DataFrame:
    """Greedy packing by running sums; every round at least halves what is left.

    With ``left`` remaining, call a file small if it needs at most half of it.
    Up to a turning point all small files fit and no large one does. The
    turning point is the first small file whose running sum passes half, or
    the first large file that still fits on top of the small ones before it;
    taking it leaves less than half. So ``log2(cap)`` rounds settle every key.
    """
    open_files = cand.withColumn("_left", F.lit(cap).cast("bigint"))
    taken = cand.select(*by, order).limit(0)
    if cand.isEmpty():
        return taken
    while True:
        half = F.col("_left") / 2
        open_files = open_files.where(F.col("_s") <= F.col("_left")).withColumn(
            "_small", F.when(F.col("_s") <= half, F.col("_s")).otherwise(F.lit(0))
        )
        run = positions(open_files, by, order, out="_run", weight="_small")
        is_small = F.col("_s") <= half
        turning = F.when(is_small, F.col("_run") > half).otherwise(
            F.col("_run") + F.col("_s") <= F.col("_left")
        )
        turn = run.groupBy(*by).agg(
            F.min(F.when(turning, F.struct(F.col(order).alias("at"), "_s", "_run"))).alias("_t")
        )
        step = settle(attach(run, turn, by))
        at = F.col("_t.at")
        taken = taken.unionByName(
            step.where(at.isNull() & is_small | (F.col(order) < at) & is_small | (F.col(order) == at))
            .select(*by, order)
        )
        used = F.when(F.col("_t._s") <= half, F.col("_t._run")).otherwise(
            F.col("_t._run") + F.col("_t._s")
        )
        open_files = step.where(F.col(order) > at).select(
            *by, order, "_s", (F.col("_left") - used).alias("_left")
        )
        if open_files.isEmpty():
            return taken


def type_distribution(columns: DataFrame) -> DataFrame:
    """Columns per type with the share of all."""
    counts = columns.groupBy("col_type").agg(F.count(F.lit(1)).alias("n"))
    return attach_grand(counts, total=F.sum("n")).select(
        "col_type", "n", (100.0 * F.col("n") / F.col("total")).alias("pct")
    )


def unknown_rate(columns: DataFrame, threshold: float = 0.30) -> DataFrame:
    """Repositories whose share of ``unknown`` columns is above the threshold."""
    return (
        columns.groupBy("paper_id")
        .agg(
            F.count(F.lit(1)).alias("n_columns"),
            F.count_if(F.col("col_type") == "unknown").alias("n_unknown"),
        )
        .withColumn("rate", F.col("n_unknown") / F.col("n_columns"))
        .where(F.col("rate") > threshold)
    )


def without_columns(runs: DataFrame, columns: DataFrame) -> DataFrame:
    """Successful repositories that have no column at all."""
    return attach(runs.where("success"), columns.select("paper_id").distinct(), ["paper_id"], "left_anti")


def weighted_type_distribution(columns: DataFrame) -> DataFrame:
    """Share of each type within a repository, averaged over all repositories.

    A repository without the type counts as zero, so the average is the sum of
    the shares over the number of repositories; no grid is built.
    """
    cells = columns.groupBy("paper_id", "col_type").agg(F.count(F.lit(1)).alias("n"))
    sizes = cells.groupBy("paper_id").agg(F.sum("n").alias("size"))
    shares = (
        attach(cells, sizes, ["paper_id"])
        .groupBy("col_type")
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") / F.col("size")).alias("_share"))
    )
    papers = sizes.agg(F.count(F.lit(1)).alias("_papers"))
    return shares.join(F.broadcast(papers)).select(
        "col_type", "n", (100.0 * F.col("_share") / F.col("_papers")).alias("avg_pct")
    )


def compare_reported(
    computed: DataFrame, reported: DataFrame, mapping: DataFrame, tolerance: float = 0.01
) -> DataFrame:
    """Reported statistics against computed ones, one row per variable and statistic.

    ``mapping`` gives the ``column_name`` of each ``reported_name``. Column
    names compare in lower case; reported numbers may be text.
    """
    stats = ["n", "n_missing", "mean", "sd", "min", "max", "n_unique"]

    def tall(df: DataFrame, key: str, out: str) -> DataFrame:
        return (
            df.select(F.lower(F.col(key)).alias("variable"), *[F.col(s).try_cast("double") for s in stats])
            .unpivot("variable", stats, "stat", out)
        )

    named = attach(reported, mapping, ["reported_name"], "inner")
    both = tall(computed, "column_name", "computed").join(
        tall(named, "column_name", "reported"), ["variable", "stat"]
    )
    gap = F.abs(F.col("computed") - F.col("reported"))
    return both.select(
        "variable",
        "stat",
        "computed",
        "reported",
        gap.alias("abs_diff"),
        F.coalesce(gap <= tolerance, F.lit(False)).alias("matches"),
    )
