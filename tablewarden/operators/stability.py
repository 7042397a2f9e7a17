"""Agreement between repeated runs, run quality, and a recommendation from both.

Runs have ``paper_id, temperature, repeat, status``; their rows have
``paper_id, temperature, repeat, key, value, ord``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.paths import SENTINEL
from tablewarden.operators.scale import attach
from tablewarden.session import settle


def pairwise_agreement(
    a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, order: str = "ord"
) -> DataFrame:
    """Share of the keys of either run on which both agree; a key in one run only disagrees.

    Of repeated keys the first row counts.
    """

    def first(df: DataFrame, out: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.min_by(value, order).alias(out))

    both = first(a, "va").join(first(b, "vb"), list(keys), "full")
    same = F.coalesce(F.col("va") == F.col("vb"), F.lit(False))
    return both.agg(F.count("*").alias("n_keys"), F.avg(same.cast("double")).alias("agreement"))


def stability(runs: DataFrame, rows: DataFrame, by: Sequence[str] = ("paper_id", "temperature")) -> DataFrame:
    """Mean agreement over the unordered pairs of successful repeats.

    Rows of one run are never joined to rows of another. Each key is reduced
    to the list of its repeats with the equality pattern of their values, equal
    patterns are counted, and only then are pairs of repeats read off. A pair's
    keys are the union of both runs: ``|A| + |B| - |A∩B|``. Only (repeat,
    repeat) pairs of one sweep point are formed, and those are what is averaged.
    """
    by = list(by)
    ok = runs.where(F.col("status") == "ok").select(*by, "repeat").distinct()
    first = (
        attach(rows, ok, [*by, "repeat"], "left_semi")
        .groupBy(*by, "repeat", "key")
        .agg(F.min_by("value", "ord").alias("value"))
    )
    per_key = first.groupBy(*by, "key").agg(
        F.array_sort(F.collect_list(F.struct("repeat", "value"))).alias("_r")
    )
    values = F.transform("_r", lambda r: r["value"])
    pattern = F.transform(
        "_r",
        lambda r: F.struct(
            r["repeat"].alias("repeat"),
            F.array_position(values, r["value"]).alias("v"),
            r["value"].isNull().alias("nil"),
        ),
    )
    # keys seen in the same repeats with the same pattern of equal values count together
    shared = settle(per_key.groupBy(*by, pattern.alias("_p")).agg(F.count("*").alias("c")))
    sizes = (
        shared.select(*by, "c", F.explode("_p.repeat").alias("repeat"))
        .groupBy(*by, "repeat")
        .agg(F.sum("c").alias("size"))
    )
    pairs = shared.select(
        *by,
        "c",
        F.explode(
            F.flatten(
                F.transform(
                    "_p",
                    lambda x: F.transform(
                        F.filter("_p", lambda y: y["repeat"] > x["repeat"]),
                        lambda y: F.struct(
                            x["repeat"].alias("a"),
                            y["repeat"].alias("b"),
                            F.coalesce((x["v"] == y["v"]) & ~x["nil"] & ~y["nil"], F.lit(False)).alias("same"),
                        ),
                    ),
                )
            )
        ).alias("p"),
    )
    met = pairs.groupBy(*by, F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(
        F.sum("c").alias("common"), F.coalesce(F.sum(F.when(F.col("p.same"), F.col("c"))), F.lit(0)).alias("agree")
    )
    sides = attach(
        ok.select(*by, F.col("repeat").alias("a")),
        sizes.select(*by, F.col("repeat").alias("a"), F.col("size").alias("na")),
        [*by, "a"],
    )
    grid = (
        sides.join(
            sides.select(*by, F.col("a").alias("b"), F.col("na").alias("nb")), by
        )
        .where(F.col("a") < F.col("b"))
    )
    joined = attach(grid, met, [*by, "a", "b"])
    # a run without any rows has no agreement with another run
    union = F.col("na") + F.col("nb") - F.coalesce("common", F.lit(0))
    scored = joined.withColumn("_union", union).withColumn(
        "_agree", F.coalesce("agree", F.lit(0)) / F.col("_union")
    )
    agg = scored.groupBy(*by).agg(
        F.avg("_agree").alias("agreement"),
        F.count("*").alias("n_pairs"),
        F.sum("_union").alias("n_keys_compared"),
    )
    out = attach(runs.select(*by).distinct(), agg, by)
    return out.withColumn("n_pairs", F.coalesce("n_pairs", F.lit(0)))


def run_quality(runs: DataFrame, columns: DataFrame, coverage: DataFrame, labels: DataFrame) -> DataFrame:
    """Known-type, coverage and labelling rates per temperature, averaged over successful runs.

    A run without columns counts 0 for known types; a run without coverage or
    labels is left out of those means.
    """
    run = ["paper_id", "temperature", "repeat"]
    ok = runs.where(F.col("status") == "ok").select(*run).distinct()

    def rate(df: DataFrame, hit: Column, out: str) -> DataFrame:
        return df.groupBy(*run).agg(F.avg(hit.cast("double")).alias(out))

    out = attach(ok, rate(columns, F.col("col_type") != "unknown", "known"), run)
    out = attach(out, rate(coverage, F.col("match_status") == "matched", "covered"), run)
    out = attach(out, rate(labels, F.coalesce(F.col("label") != "", F.lit(False)), "filled"), run)
    rates = out.groupBy("paper_id", "temperature").agg(
        F.avg(F.coalesce("known", F.lit(0.0))).alias("known_type_rate"),
        F.avg("covered").alias("codebook_coverage_rate"),
        F.avg("filled").alias("nonempty_label_rate"),
        F.count("*").alias("n_repeats_used"),
    )
    keys = ["paper_id", "temperature"]
    full = attach(runs.select(*keys).distinct(), rates, keys)
    return full.withColumn("n_repeats_used", F.coalesce("n_repeats_used", F.lit(0)))


def recommend(
    stable: DataFrame, quality: DataFrame, weight: float = 0.5, by: Sequence[str] = ("paper_id",)
) -> DataFrame:
    """Combined score per temperature and whether it ties with the best within 0.001."""
    keys = [*by, "temperature"]
    joined = stable.select(*keys, F.col("agreement").alias("stability_score")).join(
        quality, keys, "full"
    )
    rates = F.filter(
        F.array("known_type_rate", "codebook_coverage_rate", "nonempty_label_rate"), lambda x: x.isNotNull()
    )
    q = F.when(
        F.size(rates) > 0, F.aggregate(rates, F.lit(0.0), lambda a, x: a + x) / F.size(rates)
    )
    s = F.col("stability_score")
    scored = joined.select(*keys, "stability_score", q.alias("quality_score")).withColumn(
        "combined_score",
        F.coalesce(weight * s + (1 - weight) * F.col("quality_score"), s, F.col("quality_score")),
    )
    top = scored.groupBy(*by).agg(F.max("combined_score").alias("_top"))
    tied = (F.col("_top") - F.col("combined_score") < 0.001) & F.col("combined_score").isNotNull()
    return attach(scored, top, by).withColumn("is_tied", F.coalesce(tied, F.lit(False))).drop("_top")


def grand_report(runs: DataFrame, types: DataFrame, labels: DataFrame, quality: DataFrame) -> DataFrame:
    """Two stage rows per repository and temperature; ``no_data`` if all its runs were.

    ``types`` and ``labels`` are stability frames of the two stages.
    """
    keys = ["paper_id", "temperature"]
    base = runs.groupBy(*keys).agg(F.bool_and(F.col("status") == "no_data").alias("_empty"))
    out = attach(base, types.select(*keys, F.col("agreement").alias("_t")), keys)
    out = attach(out, labels.select(*keys, F.col("agreement").alias("_l")), keys)
    out = attach(out, quality, keys)
    cov, lab = F.col("codebook_coverage_rate"), F.col("nonempty_label_rate")
    null = F.lit(None).cast("double")

    def stage(name: str, agree: str, known: Column, c: Column, f: Column, status: Column) -> Column:
        def keep(x: Column) -> Column:
            return F.when(~F.col("_empty"), x)

        return F.struct(
            F.lit(name).alias("stage"),
            F.when(F.col("_empty"), F.lit(0)).otherwise(F.col("n_repeats_used")).alias("repeat_count"),
            keep(F.col(agree)).alias("mean_pairwise_agreement"),
            keep(known).alias("known_type_rate"),
            keep(c).alias("codebook_coverage_rate"),
            keep(f).alias("nonempty_label_rate"),
            F.when(F.col("_empty"), F.lit("no_data")).otherwise(status).alias("status"),
        )

    index = stage(
        "index", "_t", F.col("known_type_rate"), null, null,
        F.when(F.col("_t").isNotNull(), F.lit("ok")).otherwise(F.lit("failed")),
    )
    codebook = stage(
        "codebook", "_l", null, cov, lab,
        F.when(F.col("_l").isNull() & cov.isNull(), F.lit("no_codebook")).otherwise(F.lit("ok")),
    )
    return out.select(*keys, F.inline(F.array(index, codebook)))


def config_agreement(predictions: DataFrame, configs: Sequence[str]) -> DataFrame:
    """Agreement of every two configurations on the files both answered, truth aside.

    The configurations are a short closed list, so each file becomes one row
    with a value per configuration; pairs are columns of that row.
    """
    usable = predictions.where(F.col("type").isNotNull() & (F.col("type") != SENTINEL))
    wide = usable.groupBy("paper_id", "rel_path").pivot("config", list(configs)).agg(F.first("type"))
    pairs = [
        F.struct(
            F.lit(a).alias("config_a"),
            F.lit(b).alias("config_b"),
            F.col(f"`{a}`").alias("va"),
            F.col(f"`{b}`").alias("vb"),
        )
        for i, a in enumerate(configs)
        for b in configs[i + 1 :]
    ]
    return (
        wide.select(F.inline(F.array(*pairs)))
        .where(F.col("va").isNotNull() & F.col("vb").isNotNull())
        .groupBy("config_a", "config_b")
        .agg(
            F.count("*").alias("n_files"),
            (100.0 * F.avg((F.col("va") == F.col("vb")).cast("double"))).alias("agreement"),
        )
    )


def repeat_scores(truth: DataFrame, predicted: DataFrame, run: Sequence[str]) -> DataFrame:
    """Accuracy per run overall and by difficulty, unanswered paths, order-free fingerprint.

    ``truth``: ``path, type_gt, difficulty``; ``predicted``: ``run…, path, type``.
    The fingerprint is a sum of row hashes over ``path=type``, which needs no
    ordered list of paths in one place. An unanswered path counts as MISSING;
    those are added from the totals of the truth, so no run × path grid is built.
    """

    def stamp(answer: Column) -> Column:
        return F.xxhash64(F.concat_ws("=", F.col("path"), answer)).cast("decimal(38,0)")

    missing = stamp(F.lit("MISSING"))
    totals = truth.agg(F.count("*").alias("n_total"), F.sum(missing).alias("_blank"))
    answers = predicted.groupBy(*run, "path").agg(F.min("type").alias("type"))
    found = attach(answers, truth, ["path"], "inner").where(F.col("type").isNotNull())
    right = F.col("type") == F.col("type_gt")
    levels = ["easy", "medium", "hard"]
    per_run = found.groupBy(*run).agg(
        F.count("*").alias("_found"),
        F.count_if(right).alias("n_correct"),
        *[F.count_if(right & (F.col("difficulty") == d)).alias(f"{d}_correct") for d in levels],
        F.sum(stamp(F.col("type")) - missing).alias("_shift"),
    )
    counts = ["n_correct", *[f"{d}_correct" for d in levels]]
    return (
        attach(predicted.select(*run).distinct(), per_run, run)
        .join(F.broadcast(totals))
        .select(
            *run,
            "n_total",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
            (F.col("n_total") - F.coalesce("_found", F.lit(0))).alias("n_path_miss"),
            (F.col("_blank") + F.coalesce("_shift", F.lit(0))).alias("fingerprint"),
        )
    )


def repeat_stability(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean accuracy over the repeats and whether all gave the same answers."""
    return scores.groupBy(*by).agg(
        F.count("*").alias("n_runs"),
        F.avg(100.0 * F.col("n_correct") / F.col("n_total")).alias("mean_accuracy"),
        (F.count_distinct("fingerprint") == 1).alias("stable"),
    )
