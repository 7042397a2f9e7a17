"""Classifier evaluation. Every figure derives from the confusion counts.

``confusion`` aggregates the scored rows once, with map-side combine; what
follows works on at most classes × classes cells per key, whatever the size of
the largest repository. Operators that use the counts more than once settle
them, so the scored rows are read a single time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.grading import accuracy_bucket, kappa_band
from tablewarden.functions.paths import SENTINEL, ext_or_none
from tablewarden.operators.scale import (
    attach,
    attach_grand,
    exact_quantiles,
    first_rows,
    positions,
)
from tablewarden.session import settle



def _pct(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole)


def score_join(truth: DataFrame, predicted: DataFrame, on: Sequence[str] = ("paper_id", "rel_path")):
    """Truth rows with their prediction; rows nobody predicted stay, with nulls."""
    return truth.join(predicted, list(on), "left")


def confusion(df: DataFrame, gt: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Cells ``(by…, gt, pred, n)``; rows with a null on either side are left out."""
    return (
        df.where(F.col(gt).isNotNull() & F.col(pred).isNotNull())
        .groupBy(*by, F.col(gt).alias("gt"), F.col(pred).alias("pred"))
        .agg(F.count("*").alias("n"))
    )


def class_margins(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per class: ``truth`` and ``predicted`` totals and the ``hits``."""
    n, same = F.col("n"), F.col("gt") == F.col("pred")
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("gt").alias("cls"), n.alias("r"), zero.alias("c"), F.when(same, n).otherwise(0).alias("d")
        ),
        F.struct(F.col("pred").alias("cls"), zero.alias("r"), n.alias("c"), zero.alias("d")),
    )
    return (
        cells.select(*by, F.inline(sides))
        .groupBy(*by, "cls")
        .agg(F.sum("r").alias("truth"), F.sum("c").alias("predicted"), F.sum("d").alias("hits"))
    )


def f1(policy: str) -> Column:
    """F1 in percent of a margins row; see ``cm_stats`` for the policies."""
    r, c, d = F.col("truth"), F.col("predicted"), F.col("hits")
    score = 200.0 * d / (r + c)
    if policy == "eval":
        return F.when(r > 0, F.coalesce(score, F.lit(0.0)))
    return F.when((r > 0) & (c > 0) & (d > 0), score)


def cm_stats(cells: DataFrame, by: Sequence[str] = (), policy: str = "eval") -> DataFrame:
    """Accuracy, kappa, macro F1 and MCC per key.

    ``eval``: a class of the truth that is never predicted scores 0, a class
    absent from the truth is left out, nothing left is 0. ``report``: whatever
    is undefined is left out, nothing left is null.
    """
    r, c, d = (F.col(x).cast("double") for x in ("truth", "predicted", "hits"))
    sums = (
        class_margins(cells, by)
        .withColumn("f1", f1(policy))
        .groupBy(*by)
        .agg(
            F.sum("truth").alias("n"),
            F.sum(d).alias("d"),
            F.sum(r * c).alias("rc"),
            F.sum(r * r).alias("rr"),
            F.sum(c * c).alias("cc"),
            F.avg("f1").alias("f1"),
        )
    )
    n = F.col("n").cast("double")
    p_o, p_e = F.col("d") / n, F.col("rc") / (n * n)
    root = F.sqrt((n * n - F.col("cc")) * (n * n - F.col("rr")))
    macro = F.coalesce("f1", F.lit(0.0)) if policy == "eval" else F.col("f1")
    return sums.where(F.col("n") > 0).select(
        *by,
        "n",
        (100.0 * p_o).alias("accuracy"),
        F.when(p_e < 1, (p_o - p_e) / (1 - p_e)).alias("kappa"),
        macro.alias("macro_f1"),
        F.when(root > 0, (n * F.col("d") - F.col("rc")) / root).alias("mcc"),
    )


def class_metrics(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per class: TP, FP, FN, TN, rates, and the class most confused with it each way."""
    cells = settle(cells)
    margins = class_margins(cells, by)
    totals = margins.groupBy(*by).agg(F.sum("truth").alias("_n"))
    wrong = cells.where(F.col("gt") != F.col("pred"))

    def most(cls: str, other: str, out: str) -> DataFrame:
        # most frequent, alphabetical first on ties
        return wrong.groupBy(*by, F.col(cls).alias("cls")).agg(
            F.min_by(other, F.struct(-F.col("n"), F.col(other))).alias(out)
        )

    keys = [*by, "cls"]
    full = attach(margins, totals, by) if by else margins.join(F.broadcast(totals))
    full = attach(attach(full, most("pred", "gt", "top_fp"), keys), most("gt", "pred", "top_fn"), keys)
    tp, fp = F.col("hits"), F.col("predicted") - F.col("hits")
    fn = F.col("truth") - F.col("hits")
    tn = F.col("_n") - tp - fp - fn
    precision, recall = _pct(tp, tp + fp), _pct(tp, tp + fn)
    return full.select(
        *keys,
        tp.alias("tp"),
        fp.alias("fp"),
        fn.alias("fn"),
        tn.alias("tn"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).alias("f1"),
        _pct(fp, fp + tn).alias("fpr"),
        _pct(fn, tp + fn).alias("fnr"),
        "top_fp",
        "top_fn",
    )


def micro_f1(cells: DataFrame, by: Sequence[str] = (), sentinel: str | None = None) -> DataFrame:
    """Pooled F1. A sentinel is no class of its own, but its rows stay misses; 0 if undefined."""
    margins = class_margins(cells, by)
    if sentinel:
        margins = margins.where(F.col("cls") != sentinel)
    sums = margins.groupBy(*by).agg(
        F.sum("hits").alias("tp"),
        F.sum(F.col("predicted") - F.col("hits")).alias("fp"),
        F.sum(F.col("truth") - F.col("hits")).alias("fn"),
    )
    score = 200.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return sums.select(*by, "tp", "fp", "fn", F.coalesce(score, F.lit(0.0)).alias("micro_f1"))


def repository_metrics(df: DataFrame, min_files: int = 2) -> DataFrame:
    """One row per repository: agreement, accuracies, most frequent error and its extension.

    All of it comes from one count per (repository, true class, predicted
    class, extension) that also carries the hits of the other fields.
    """
    by = ["paper_id"]
    data = F.col("type_gt") == "data"
    fields = {
        "group": ("group_acc", F.lit(True)),
        "data_granularity": ("granularity_acc", data),
        "data_format": ("format_acc", data),
    }
    hits = []
    for name, (_, scope) in fields.items():
        hits += [
            F.count_if(scope & F.col(f"{name}_gt").isNotNull()).alias(f"_n_{name}"),
            F.count_if(scope & (F.col(name) == F.col(f"{name}_gt"))).alias(f"_ok_{name}"),
        ]
    counts = settle(
        df.groupBy(*by, F.col("type_gt").alias("gt"), F.col("type").alias("pred"), ext_or_none(F.col("rel_path")).alias("e"))
        .agg(F.count("*").alias("n"), *hits)
    )
    cells = (
        counts.where(F.col("gt").isNotNull() & F.col("pred").isNotNull())
        .groupBy(*by, "gt", "pred")
        .agg(F.sum("n").alias("n"))
    )
    stats = cm_stats(cells, by, "report").where(F.col("n") >= min_files)
    accuracy = counts.groupBy(*by).agg(
        *[_pct(F.sum(f"_ok_{name}"), F.sum(f"_n_{name}")).alias(out) for name, (out, _) in fields.items()]
    )
    pair = F.concat(F.col("gt"), F.lit("→"), F.col("pred"))
    top = (
        cells.where(F.col("gt") != F.col("pred"))
        .groupBy(*by)
        .agg(
            F.min_by(
                F.concat(pair, F.lit(" ("), F.col("n").cast("string"), F.lit(")")),
                F.struct(-F.col("n"), pair),
            ).alias("top_err")
        )
    )
    exts = (
        counts.where(F.col("gt") != F.col("pred"))
        .groupBy(*by, "e")
        .agg(F.sum("n").alias("n"))
        .groupBy(*by)
        .agg(F.min_by("e", F.struct(-F.col("n"), F.col("e"))).alias("top_ext"))
    )
    out = stats.withColumnRenamed("accuracy", "type_acc")
    for facts in (accuracy, top, exts):
        out = attach(out, facts, by)
    return out


def averaged(df: DataFrame, by: Sequence[str], *names: str) -> DataFrame:
    """Means over repositories, nulls left out."""
    return df.groupBy(*by).agg(
        *[F.avg(n).alias(f"avg_{n}") for n in names], F.count("*").alias("n_repos")
    )


def pooled_and_averaged(df: DataFrame, by: Sequence[str] = (), policy: str = "eval") -> DataFrame:
    """Pooled and repository-averaged accuracy, macro F1 and micro F1 side by side."""
    by = list(by)
    cells = settle(confusion(df, "type_gt", "type", [*by, "paper_id"]))
    pooled_cells = cells.groupBy(*by, "gt", "pred").agg(F.sum("n").alias("n"))

    def both(c: DataFrame, keys: list[str]) -> DataFrame:
        left, right = cm_stats(c, keys, policy), micro_f1(c, keys).select(*keys, "micro_f1")
        return attach(left, right, keys) if keys else left.join(F.broadcast(right))

    names = ["accuracy", "macro_f1", "micro_f1"]
    mean = averaged(both(cells, [*by, "paper_id"]), by, *names)
    pooled = both(pooled_cells, by).select(*by, "n", *[F.col(x).alias(f"pooled_{x}") for x in names])
    return attach(pooled, mean, by) if by else pooled.join(F.broadcast(mean))


def class_f1_averaged(df: DataFrame, by: Sequence[str] = (), policy: str = "report") -> DataFrame:
    """Per class: repository-averaged F1, its deviation, repositories, difference to pooled."""
    by = list(by)
    cells = settle(confusion(df, "type_gt", "type", [*by, "paper_id"]))
    each = class_margins(cells, [*by, "paper_id"]).withColumn("f1", f1(policy))
    mean = each.groupBy(*by, "cls").agg(
        F.avg("f1").alias("avg_f1"), F.stddev_samp("f1").alias("sd_f1"), F.count("f1").alias("n_repos")
    )
    pooled_cells = cells.groupBy(*by, "gt", "pred").agg(F.sum("n").alias("n"))
    pooled = class_margins(pooled_cells, by).select(*by, "cls", f1(policy).alias("pooled_f1"))
    return attach(mean, pooled, [*by, "cls"]).withColumn("gap", F.col("avg_f1") - F.col("pooled_f1"))


def weighted_confusion(df: DataFrame, gt: str, pred: str, min_files: int = 1) -> DataFrame:
    """Row-normalised confusion averaged over the repositories that have the true class.

    A cell a repository lacks counts as zero, so each cell is the sum of its
    shares over the number of repositories with that class. Cells never seen
    anywhere are listed with zero, from the (closed) set of levels.
    """
    cells = settle(confusion(df, gt, pred, ["paper_id"]))
    if min_files > 1:
        sizes = cells.groupBy("paper_id").agg(F.sum("n").alias("_size"))
        cells = attach(cells, sizes, ["paper_id"]).where(F.col("_size") >= min_files).drop("_size")
    rows = cells.groupBy("paper_id", "gt").agg(F.sum("n").alias("_row"))
    papers = rows.groupBy("gt").agg(F.count("*").alias("n_repos"))
    shares = (
        attach(cells, rows, ["paper_id", "gt"])
        .groupBy("gt", "pred")
        .agg(F.sum(F.col("n") / F.col("_row")).alias("_sum"))
    )
    # the level set is collected once per true class: at most |classes| values each
    levels = cells.agg(
        F.array_sort(F.array_union(F.collect_set("gt"), F.collect_set("pred"))).alias("levels")
    )
    grid = papers.join(F.broadcast(levels)).select("gt", "n_repos", F.explode("levels").alias("pred"))
    return attach(grid, shares, ["gt", "pred"]).select(
        "gt", "pred", "n_repos", (F.coalesce("_sum", F.lit(0.0)) / F.col("n_repos")).alias("share")
    )


def config_summary(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Per run configuration: mean of each metric and of each class's F1 over repositories."""
    keys = ["config", "paper_id"]
    cells = settle(confusion(df, "type_gt", "type", keys))
    stats = cm_stats(cells, keys, "eval")
    means = stats.groupBy("config").agg(
        F.count("*").alias("n_repos"),
        *[F.avg(m).alias(m) for m in ("accuracy", "kappa", "macro_f1", "mcc")],
    )
    per_class = (
        class_margins(cells, keys)
        .withColumn("f1", f1("eval"))
        .groupBy("config")
        .pivot("cls", list(classes))
        .agg(F.avg("f1"))
        .select("config", *[F.col(c).alias(f"f1_{c}") for c in classes])
    )
    return attach(means, per_class, ["config"])


def top_pairs(cells: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent confusions with their share of all errors."""
    wrong = settle(cells.where(F.col("gt") != F.col("pred")))
    total = wrong.groupBy(*by).agg(F.sum("n").alias("_all"))
    ranked = [F.col("n").desc(), F.col("gt"), F.col("pred")]
    top = first_rows(wrong, by, ranked, k) if by else wrong.orderBy(*ranked).limit(k)
    full = attach(top, total, by) if by else top.join(F.broadcast(total))
    return full.withColumn("share", 100.0 * F.col("n") / F.col("_all")).drop("_all")


def extension_errors(df: DataFrame, min_files: int = 5) -> DataFrame:
    """Error rate per extension with at least ``min_files`` files, and its top confusion."""
    cells = (
        df.where(F.col("type_gt").isNotNull() & F.col("type").isNotNull())
        .groupBy(ext_or_none(F.col("rel_path")).alias("ext"), "type_gt", "type")
        .agg(F.count("*").alias("n"))
    )
    wrong = F.col("type_gt") != F.col("type")
    pair = F.concat_ws("→", "type_gt", "type")
    return (
        cells.groupBy("ext")
        .agg(
            F.sum("n").alias("n_files"),
            F.coalesce(F.sum(F.when(wrong, F.col("n"))), F.lit(0)).alias("n_errors"),
            F.min_by(F.when(wrong, pair), F.when(wrong, F.struct(-F.col("n"), pair))).alias("top_pair"),
        )
        .where(F.col("n_files") >= min_files)
        .withColumn("error_rate", 100.0 * F.col("n_errors") / F.col("n_files"))
    )


def accuracy_by(
    df: DataFrame, key: str, fields: Sequence[tuple[str, str, str]], total: str | None = "TOTAL"
) -> DataFrame:
    """Accuracy per value of ``key``: pooled, averaged over repositories, coverage, repositories.

    ``fields`` are (name, truth column, prediction column). The TOTAL row comes
    from grouping sets over the per-repository counts, so the rows are read once.
    """
    known = df.where(F.col(key).isNotNull())
    counts = settle(known.groupBy(key, "paper_id").agg(
        *[
            e
            for name, gt, pred in fields
            for e in (
                F.count_if(F.col(gt).isNotNull() & F.col(pred).isNotNull()).alias(f"_n_{name}"),
                F.count_if(F.col(gt) == F.col(pred)).alias(f"_ok_{name}"),
            )
        ]
    ))
    sums = [F.sum(c).alias(c) for c in counts.columns if c.startswith("_")]
    per_repo = counts
    if total:
        whole = counts.groupBy("paper_id").agg(*sums).withColumn(key, F.lit(total))
        per_repo = counts.unionByName(whole)
    first = fields[0][0]
    pooled = per_repo.groupBy(key).agg(
        F.count("*").alias("n_repos"),
        F.sum(f"_n_{first}").alias("n_files"),
        *[
            e
            for name, _, _ in fields
            for e in (
                _pct(F.sum(f"_ok_{name}"), F.sum(f"_n_{name}")).alias(f"{name}_pooled"),
                F.avg(_pct(F.col(f"_ok_{name}"), F.col(f"_n_{name}"))).alias(f"{name}_avg"),
            )
        ],
    )
    scored = counts.agg(F.sum(f"_n_{first}").alias("_all"))
    return pooled.join(F.broadcast(scored)).select(
        "*", _pct(F.col("n_files"), F.col("_all")).alias("coverage")
    ).drop("_all")


def type_method_matrix(df: DataFrame, methods: Sequence[str]) -> DataFrame:
    """Accuracy and n per true type, one pair of columns per method."""
    scored = df.where(F.col("type_gt").isNotNull() & F.col("type").isNotNull())
    wide = (
        scored.groupBy("type_gt")
        .pivot("type_source", list(methods))
        .agg(
            F.count("type").alias("n"),
            (100.0 * F.avg((F.col("type_gt") == F.col("type")).cast("double"))).alias("acc"),
        )
    )
    return wide.select(
        "type_gt",
        *[F.coalesce(f"{m}_n", F.lit(0)).alias(f"n_{m}") for m in methods],
        *[F.col(f"{m}_acc").alias(f"acc_{m}") for m in methods],
    )


def confused_with(cells: DataFrame, cls: str) -> DataFrame:
    """False positives and negatives of one class by the other class, with shares."""
    wrong = cells.where((F.col("gt") != F.col("pred")) & ((F.col("gt") == cls) | (F.col("pred") == cls)))
    fp = F.col("pred") == cls
    parts = settle(
        wrong.groupBy(
            F.when(fp, F.lit("fp")).otherwise(F.lit("fn")).alias("kind"),
            F.when(fp, F.col("gt")).otherwise(F.col("pred")).alias("other"),
        )
        .agg(F.sum("n").alias("n"))
    )
    totals = parts.groupBy("kind").agg(F.sum("n").alias("_all"))
    return attach(parts, totals, ["kind"]).select(
        "kind", "other", "n", (100.0 * F.col("n") / F.col("_all")).alias("share")
    )


def subtype_rates(df: DataFrame, subtype: str, cls: str = "data") -> DataFrame:
    """Repository-averaged recall by true subtype, precision by predicted subtype.

    A false positive has no true subtype, hence the two keys.
    """

    def side(scope: str, key: str, other: str, rate: str, count: str) -> DataFrame:
        rows = df.where((F.col(scope) == cls) & F.col(key).isNotNull())
        per = rows.groupBy(F.col(key).alias("subtype"), "paper_id").agg(
            F.count("*").alias("_n"),
            (100.0 * F.avg((F.col(other) == cls).cast("double"))).alias("_rate"),
        )
        return per.groupBy("subtype").agg(F.sum("_n").alias(count), F.avg("_rate").alias(rate))

    recall = side("type_gt", f"{subtype}_gt", "type", "recall_avg", "n_true")
    precision = side("type", subtype, "type_gt", "precision_avg", "n_predicted")
    return recall.join(precision, "subtype", "full")


def binary_field(df: DataFrame, field: str, values: Sequence[str], cls: str = "data") -> DataFrame:
    """Per configuration, averaged: recall of the class, accuracy of the field, recall per value.

    A repository without the class or the value has no rate there and is left out.
    """
    gt, pred = F.col(f"{field}_gt"), F.col(field)
    both = gt.isNotNull() & pred.isNotNull()
    true_cls = F.col("type_gt") == cls
    per = df.groupBy("config", "paper_id").agg(
        (100.0 * F.avg(F.when(true_cls & F.col("type").isNotNull(), (F.col("type") == cls).cast("double")))).alias(
            f"recall_{cls}"
        ),
        (100.0 * F.avg(F.when(both, (gt == pred).cast("double")))).alias("accuracy"),
        *[
            (100.0 * F.avg(F.when(both & (gt == v), (pred == v).cast("double")))).alias(f"recall_{v}")
            for v in values
        ],
    )
    names = [f"recall_{cls}", "accuracy", *[f"recall_{v}" for v in values]]
    return per.groupBy("config").agg(*[F.avg(n).alias(n) for n in names])


def group_split(df: DataFrame, gt: str = "group_gt", pred: str = "group") -> DataFrame:
    """Averaged group accuracy of repositories with one true group and with several."""
    scored = df.where(F.col(gt).isNotNull())
    per = scored.groupBy("paper_id").agg(
        F.count_distinct(gt).alias("groups"),
        (100.0 * F.avg(F.coalesce(F.col(gt) == F.col(pred), F.lit(False)).cast("double"))).alias("acc"),
    )
    kind = F.when(F.col("groups") >= 2, F.lit("multi")).otherwise(F.lit("single"))
    return per.groupBy(kind.alias("kind")).agg(F.count("*").alias("n_repos"), F.avg("acc").alias("acc_avg"))


def missingness(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per configuration and field: % null, % sentinel, accuracy, macro F1 and kappa."""
    cells = [
        F.struct(F.lit(f).alias("field"), F.col(f"{f}_gt").alias("g"), F.col(f).alias("p")) for f in fields
    ]
    tall = df.select("config", F.inline(F.array(*cells))).where(F.col("g").isNotNull())
    counts = settle(tall.groupBy("config", "field", "g", "p").agg(F.count("*").alias("n")))
    keys = ["config", "field"]
    n, p = F.col("n"), F.col("p")
    head = counts.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"),
        (100.0 * F.coalesce(F.sum(F.when(p.isNull(), n)), F.lit(0)) / F.sum("n")).alias("pct_null"),
        (100.0 * F.coalesce(F.sum(F.when(p == SENTINEL, n)), F.lit(0)) / F.sum("n")).alias("pct_sentinel"),
    )
    usable = counts.where(p.isNotNull() & (p != SENTINEL)).select(
        *keys, F.col("g").alias("gt"), p.alias("pred"), "n"
    )
    return attach(head, cm_stats(usable, keys, "eval").drop("n", "mcc"), keys)


def batch_failures(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of (repository, batch) with any sentinel answer."""
    batches = (
        df.where(F.col("prompt_nr").isNotNull())
        .groupBy(*by, "paper_id", "prompt_nr")
        .agg(F.bool_or(F.coalesce(F.col("type") == SENTINEL, F.lit(False))).alias("failed"))
    )
    return batches.groupBy(*by).agg(
        F.count("*").alias("n_batches"), (100.0 * F.avg(F.col("failed").cast("double"))).alias("pct_failed")
    )


def reliability(per_repo: DataFrame, value: str = "type_acc", kappa: str = "kappa") -> DataFrame:
    """Spread of a score over repositories, share below 50, repositories of high agreement."""
    v = F.col(value)
    head = per_repo.agg(
        F.count(v).alias("n_repos"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("sd"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        _pct(F.count_if(v < 50), F.count(v)).alias("pct_below_50"),
        F.count_if(F.col(kappa) >= 0.8).alias("n_high_kappa"),
    )
    quant = exact_quantiles(per_repo, [], value, {"median": 0.5, "p25": 0.25, "p75": 0.75})
    return head.join(F.broadcast(quant)).withColumn("iqr", F.col("p75") - F.col("p25"))


def score_buckets(per_repo: DataFrame, value: str = "type_acc", kappa: str = "kappa") -> DataFrame:
    """Repositories per accuracy bucket and kappa band."""
    return per_repo.groupBy(
        accuracy_bucket(F.col(value)).alias("bucket"), kappa_band(F.col(kappa)).alias("band")
    ).agg(F.count("*").alias("n_repos"))


def worst(per_repo: DataFrame, value: str, k: int) -> DataFrame:
    return per_repo.where(F.col(value).isNotNull()).orderBy(F.col(value), "paper_id").limit(k)


def size_quartiles(per_repo: DataFrame, size: str, metrics: Sequence[str]) -> DataFrame:
    """Repositories in four bins cut at the quartiles of their size, equal sizes together."""
    cuts = exact_quantiles(per_repo, [], size, {"_q1": 0.25, "_q2": 0.5, "_q3": 0.75})
    s = F.col(size)
    binned = per_repo.join(F.broadcast(cuts)).withColumn(
        "bin",
        F.when(s <= F.col("_q1"), 1).when(s <= F.col("_q2"), 2).when(s <= F.col("_q3"), 3).otherwise(4),
    )
    head = binned.groupBy("bin").agg(
        F.count("*").alias("n_repos"),
        F.min(size).alias("min_size"),
        F.max(size).alias("max_size"),
        *[F.avg(m).alias(f"avg_{m}") for m in metrics],
    )
    return attach(head, exact_quantiles(binned, ["bin"], size, {"median_size": 0.5}), ["bin"])


def average_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Rank with ties sharing their mean, over all rows, without a single-task sort."""
    ties = df.groupBy(value).agg(F.count("*").alias("_ties"))
    ranked = positions(ties, [], [F.col(value)], out="_to", weight="_ties", width=None)
    facts = ranked.select(value, (F.col("_to") - (F.col("_ties") - 1) / 2.0).alias(out))
    return attach(df, facts, [value])


def size_effect(per_repo: DataFrame, size: str, metric: str, min_size: int = 20) -> DataFrame:
    """Spearman of size and metric (large repositories, all) and size-weighted Pearson of log size."""
    known = F.col(size).isNotNull() & F.col(metric).isNotNull() & (F.col(size) > 0)
    rows = settle(per_repo.where(known).select(F.col(size).cast("double").alias("n"), F.col(metric).alias("y")))

    def spearman(df: DataFrame, out: str) -> DataFrame:
        ranks = average_rank(average_rank(df, "n", "rn"), "y", "ry")
        return ranks.agg(F.corr("rn", "ry").alias(f"rho_{out}"), F.count("*").alias(f"n_{out}"))

    n, y, lx = F.col("n"), F.col("y"), F.log("n")
    s = rows.agg(
        F.sum(n).alias("w"),
        F.sum(n * lx).alias("wx"),
        F.sum(n * y).alias("wy"),
        F.sum(n * lx * lx).alias("wxx"),
        F.sum(n * y * y).alias("wyy"),
        F.sum(n * lx * y).alias("wxy"),
    )
    w = F.col("w")
    mx, my = F.col("wx") / w, F.col("wy") / w
    den = F.sqrt((F.col("wxx") / w - mx * mx) * (F.col("wyy") / w - my * my))
    weighted = s.select(F.when(den > 0, (F.col("wxy") / w - mx * my) / den).alias("weighted_r"))
    large = spearman(rows.where(n >= min_size), "large")
    return large.join(F.broadcast(spearman(rows, "all"))).join(F.broadcast(weighted))


def spread_between(df: DataFrame, within: str, across: str, metric: str) -> DataFrame:
    """Largest minus smallest mean of a metric across one factor, within the other."""
    means = df.groupBy(within, across).agg(F.avg(metric).alias("_m"))
    return means.groupBy(F.col(within).alias("level")).agg(
        F.lit(within).alias("within"),
        F.count("*").alias("n_levels"),
        F.min("_m").alias("lowest"),
        F.max("_m").alias("highest"),
        (F.max("_m") - F.min("_m")).alias("spread"),
    )


def winner(summary: DataFrame, score: str = "macro_f1", coverage: str = "n_repos", share: float = 0.8) -> DataFrame:
    """The best configuration among those covering enough of the largest coverage."""
    top = summary.agg(F.max(coverage).alias("_top"))
    return (
        summary.join(F.broadcast(top))
        .where(F.col(coverage) >= share * F.col("_top"))
        .orderBy(F.col(score).desc_nulls_last(), "config")
        .limit(1)
        .drop("_top")
    )


def share_within(df: DataFrame, by: Sequence[str], n: str = "n", out: str = "share") -> DataFrame:
    """``n`` as a share of its sum within the key."""
    if not by:
        return attach_grand(df, _all=F.sum(n)).withColumn(out, F.col(n) / F.col("_all")).drop("_all")
    totals = df.groupBy(*by).agg(F.sum(n).alias("_all"))
    return attach(df, totals, by).withColumn(out, F.col(n) / F.col("_all")).drop("_all")
