"""Corpus reports: composition, documentation health, batch and token planning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.grading import codebook_origin
from tablewarden.functions.names import label_quality
from tablewarden.operators.scale import attach, attach_grand, exact_quantiles


def repository_summary(structure: DataFrame, columns: DataFrame) -> DataFrame:
    """The counters of a run log row, per repository."""
    data = F.col("type") == "data"
    tabular = data & (F.col("data_format") == "tabular")

    def gran(value: str) -> Column:
        return F.count_if(data & (F.col("data_granularity") == value))

    files = structure.groupBy("paper_id").agg(
        F.count("*").alias("n_files"),
        F.count_if(data).alias("n_data_files"),
        F.count_if(tabular & (F.col("data_granularity") == "combined")).alias("n_tabular_files"),
        F.count_distinct("aggregate_folder").alias("n_agg_dirs"),
        gran("individual").alias("n_individual"),
        gran("combined").alias("n_combined"),
    )
    cols = columns.groupBy("paper_id").agg(
        F.count("*").alias("n_columns"), F.count_distinct("source_file").alias("n_src_files")
    )
    return attach(files, cols, ["paper_id"]).select(
        *files.columns,
        F.coalesce("n_columns", F.lit(0)).alias("n_columns"),
        F.coalesce("n_src_files", F.lit(0)).alias("n_src_files"),
    )


def health_checks(structure: DataFrame, labels: DataFrame, coverage: DataFrame) -> DataFrame:
    """Documentation indicators per repository, one row per indicator that applies.

    Embedded labels are recognised by ``haven_priority``, the value matching writes.
    """
    key = ["paper_id"]
    files = structure.groupBy(*key).agg(
        F.coalesce(F.bool_or(F.col("type") == "readme"), F.lit(False)).alias("readme"),
        F.coalesce(F.bool_or(F.col("type") == "codebook"), F.lit(False)).alias("codebook"),
    )
    lab = labels.groupBy(*key).agg(
        F.count("*").alias("n_cols"),
        F.count_if(F.col("label_status").isin("labelled", "llm")).alias("n_lab"),
        F.coalesce(F.bool_or(F.col("label_method") == "haven_priority"), F.lit(False)).alias("embedded"),
    )
    cov = coverage.groupBy(*key).agg(
        F.count("*").alias("n_cov"),
        F.count_if(F.col("match_status") == "matched").alias("n_match"),
        F.coalesce(F.bool_or(F.col("parse_method").isin("structured", "haven")), F.lit(False)).alias("machine"),
    )
    f = attach(attach(files, lab, key), cov, key)

    def yes(c: str) -> Column:
        return F.coalesce(c, F.lit(False))

    def check(name: str, applies: Column, good: Column, other: str) -> Column:
        return F.when(
            applies,
            F.struct(
                F.lit(name).alias("indicator"),
                F.when(good, F.lit("good")).otherwise(F.lit(other)).alias("state"),
            ),
        )

    n_cols, n_cov = F.coalesce("n_cols", F.lit(0)), F.coalesce("n_cov", F.lit(0))
    always = F.lit(True)
    rows = F.filter(
        F.array(
            check("readme", always, yes("readme"), "warn"),
            check("codebook", always, yes("codebook"), "warn"),
            check("machine_readable", yes("codebook"), yes("machine"), "info"),
            check("embedded_labels", yes("embedded"), always, "warn"),
            check("columns_documented", n_cols > 0, F.col("n_lab") == n_cols, "warn"),
            check("variables_found", n_cov > 0, F.col("n_match") == n_cov, "warn"),
        ),
        lambda r: r.isNotNull(),
    )
    return f.select(*key, F.inline(rows))


def health_score(checks: DataFrame) -> DataFrame:
    return checks.groupBy("paper_id").agg(
        F.count_if(F.col("state") == "good").alias("n_good"), F.count("*").alias("n_checks")
    )


def codebook_tiles(structure: DataFrame, labels: DataFrame, coverage: DataFrame) -> DataFrame:
    """Codebook files, variables, labelled columns and matched variables per repository."""
    key = ["paper_id"]
    files = structure.groupBy(*key).agg(F.count_if(F.col("type") == "codebook").alias("n_codebook_files"))
    lab = labels.groupBy(*key).agg(
        F.count("*").alias("n_columns"),
        F.count_if(F.col("label_status").isin("labelled", "llm")).alias("n_labelled"),
    )
    cov = coverage.groupBy(*key).agg(
        F.count("*").alias("n_variables"),
        F.count_if(F.col("match_status") == "matched").alias("n_matched"),
        F.count_if(F.col("match_status") == "unmatched_in_data").alias("n_unmatched"),
    )
    out = attach(attach(files, lab, key), cov, key)
    names = ["n_columns", "n_labelled", "n_variables", "n_matched", "n_unmatched"]
    n = {c: F.coalesce(c, F.lit(0)) for c in names}
    return out.select(
        *key,
        "n_codebook_files",
        *[c.alias(name) for name, c in n.items()],
        (100.0 * n["n_labelled"] / F.nullif(n["n_columns"], F.lit(0))).alias("pct_labelled"),
        (100.0 * n["n_matched"] / F.nullif(n["n_variables"], F.lit(0))).alias("pct_matched"),
        ((F.col("n_codebook_files") > 0) & (n["n_variables"] == 0)).alias("unparsed_codebook"),
    )


def coverage_per_repository(coverage: DataFrame) -> DataFrame:
    return coverage.groupBy("paper_id").agg(
        F.count("*").alias("n_vars"),
        F.count_if(F.col("match_status") == "matched").alias("n_matched"),
        (100.0 * F.avg((F.col("match_status") == "matched").cast("double"))).alias("pct_matched"),
    )


def coverage_distribution(per_repo: DataFrame) -> DataFrame:
    """Mean, median, extremes and full or empty coverage over repositories."""
    p = F.col("pct_matched")
    head = per_repo.agg(
        F.count("*").alias("n_repos"),
        F.avg(p).alias("mean"),
        F.min(p).alias("min"),
        F.max(p).alias("max"),
        F.count_if(p == 100).alias("n_full"),
        F.count_if(p == 0).alias("n_none"),
    )
    return head.join(F.broadcast(exact_quantiles(per_repo, [], "pct_matched", {"median": 0.5})))


def lowest_coverage(per_repo: DataFrame, k: int) -> DataFrame:
    return per_repo.orderBy("pct_matched", "paper_id").limit(k)


def codebook_provenance(coverage: DataFrame) -> DataFrame:
    """Parsed and matched variables per origin and in ALL."""
    cells = coverage.groupBy(
        codebook_origin(F.col("parse_method"), F.col("codebook_source")).alias("origin"), "paper_id"
    ).agg(F.count("*").alias("n"), F.count_if(F.col("match_status") == "matched").alias("m"))
    rolled = cells.rollup("origin").agg(
        F.sum("n").alias("parsed_vars"),
        F.sum("m").alias("matched"),
        (100.0 * F.sum("m") / F.sum("n")).alias("match_rate"),
        F.count_distinct("paper_id").alias("n_repos"),
    )
    return rolled.withColumn("origin", F.coalesce("origin", F.lit("ALL")))


def embedded_label_quality(coverage: DataFrame, order: str = "ord") -> DataFrame:
    """Lengths, gain and edit distance of embedded labels: mean, median and mode within a
    repository, then averaged over repositories. The mode of equals is the value seen first."""
    measures = ["label_len", "name_len", "len_gain", "edit_dist"]
    hv = coverage.where(F.col("parse_method") == "haven").select(
        "paper_id", order, *[e.alias(n) for n, e in label_quality(F.col("label"), F.col("codebook_variable")).items()]
    )
    tall = hv.select(
        "paper_id",
        order,
        F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias("v")) for m in measures])),
    )
    keys = ["paper_id", "measure"]
    # one row per distinct value: the mode needs no list of all values
    values = tall.groupBy(*keys, "v").agg(F.count("*").alias("c"), F.min(order).alias("first"))
    per = values.groupBy(*keys).agg(
        (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"),
        F.min_by("v", F.struct(-F.col("c"), F.col("first"))).alias("mode"),
    )
    per = attach(per, exact_quantiles(tall, keys, "v", {"median": 0.5}), keys)
    lengths = per.groupBy("measure").agg(*[F.avg(s).alias(f"{s}_pa") for s in ("mean", "median", "mode")])
    info = (
        hv.groupBy("paper_id")
        .agg(F.avg(F.col("informative").cast("double")).alias("i"), F.count("*").alias("n"))
        .agg(
            (100.0 * F.avg("i")).alias("informative_pa"),
            F.sum("n").alias("n_vars"),
            F.count("*").alias("n_repos"),
        )
    )
    return lengths.join(F.broadcast(info))


def composition(files: DataFrame, subset_limit: int = 500) -> DataFrame:
    """Files per type, granularity and format with shares, for all and for small repositories."""
    sizes = files.groupBy("paper_id").agg(F.count("*").alias("_size"))
    cells = files.groupBy("paper_id", "type", "data_granularity", "data_format").agg(F.count("*").alias("n"))
    scoped = attach(cells, sizes, ["paper_id"]).withColumn(
        "scope",
        F.explode(
            F.when(F.col("_size") <= subset_limit, F.array(F.lit("all"), F.lit("small"))).otherwise(
                F.array(F.lit("all"))
            )
        ),
    )
    dims = ["type", "data_granularity", "data_format"]
    tall = scoped.select(
        "scope",
        "paper_id",
        "n",
        F.inline(F.array(*[F.struct(F.lit(d).alias("field"), F.col(d).alias("value")) for d in dims])),
    ).where(F.col("value").isNotNull())
    counts = tall.groupBy("scope", "field", "value").agg(
        F.sum("n").alias("n_files"), F.count_distinct("paper_id").alias("n_repos")
    )
    repos = scoped.groupBy("scope").agg(F.count_distinct("paper_id").alias("_repos"))
    return attach(counts, repos, ["scope"]).select(
        *counts.columns, (100.0 * F.col("n_repos") / F.col("_repos")).alias("pct_repos")
    )


def file_count_histogram(files: DataFrame, width: int = 20) -> DataFrame:
    """Repositories per file-count bin of fixed width, counts above p95 put into the bin of p95."""
    sizes = files.groupBy("paper_id").agg(F.count("*").alias("n_files"))
    cut = exact_quantiles(sizes, [], "n_files", {"p95": 0.95})
    clipped = F.least(F.col("n_files").cast("double"), F.col("p95"))
    return (
        sizes.join(F.broadcast(cut))
        .groupBy((F.floor(clipped / width) * width).cast("bigint").alias("bin_start"))
        .agg(F.count("*").alias("n_repos"))
    )


def file_count_percentiles(files: DataFrame, probs: Sequence[float]) -> DataFrame:
    sizes = files.groupBy("paper_id").agg(F.count("*").alias("n_files"))
    return exact_quantiles(sizes, [], "n_files", {f"p{round(100 * p)}": p for p in probs})


def variables_per_repository(columns: DataFrame) -> DataFrame:
    """Repositories per power of ten of their column count, with mean and median overall."""
    sizes = columns.groupBy("paper_id").agg(F.count("*").alias("n_columns"))
    head = sizes.agg(F.avg("n_columns").alias("mean_columns"))
    mid = exact_quantiles(sizes, [], "n_columns", {"median_columns": 0.5})
    return (
        sizes.groupBy((F.length(F.col("n_columns").cast("string")) - 1).alias("log_bin"))
        .agg(F.count("*").alias("n_repos"))
        .join(F.broadcast(head))
        .join(F.broadcast(mid))
    )


def batch_plan(structure: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Calls needed per batch size: single files and groups are batched apart."""
    per = structure.groupBy("paper_id").agg(
        F.count_if(F.coalesce("aggregate_folder", F.lit("")) == "").alias("single"),
        F.count_distinct(F.when(F.col("aggregate_folder") != "", F.col("aggregate_folder"))).alias("groups"),
    )
    calls = per.select(
        F.explode(F.array(*[F.lit(b) for b in sizes])).alias("batch_size"), "single", "groups"
    ).withColumn(
        "calls",
        F.ceil(F.col("single") / F.col("batch_size")) + F.ceil(F.col("groups") / F.col("batch_size")),
    )
    c = F.col("calls")
    head = calls.groupBy("batch_size").agg(
        F.sum(c).alias("total_calls"),
        F.avg(c).alias("mean_calls"),
        F.max(c).alias("max_calls"),
        *[(100.0 * F.avg((c <= k).cast("double"))).alias(f"pct_le_{k}") for k in (1, 2, 5)],
        (100.0 * F.avg((c == 1).cast("double"))).alias("pct_1"),
    )
    return attach(head, exact_quantiles(calls, ["batch_size"], "calls", {"median_calls": 0.5}), ["batch_size"])


def token_fit(calls: DataFrame, by: Sequence[str], size: str, tokens: str) -> DataFrame:
    """Least-squares line of tokens on batch size with R²."""
    t, n = F.col(tokens).cast("double"), F.col(size).cast("double")
    return calls.groupBy(*by).agg(
        F.regr_slope(t, n).alias("rate"),
        F.regr_intercept(t, n).alias("base"),
        F.regr_r2(t, n).alias("r2"),
        F.count("*").alias("n_calls"),
    )


def token_totals(traces: DataFrame) -> DataFrame:
    """Calls and tokens per repository, summed and averaged over repositories."""
    per = traces.groupBy("paper_id").agg(
        F.count("*").alias("calls"), F.sum("tokens_in").alias("t_in"), F.sum("tokens_out").alias("t_out")
    )
    head = per.agg(
        F.sum("calls").alias("total_calls"),
        F.avg("calls").alias("mean_calls"),
        F.sum("t_in").alias("total_in"),
        F.avg("t_in").alias("mean_in"),
        F.sum("t_out").alias("total_out"),
        F.avg("t_out").alias("mean_out"),
    )
    return head.join(F.broadcast(exact_quantiles(per, [], "calls", {"median_calls": 0.5})))


def cost_by_step(calls: DataFrame, step: str, model: str, cost: dict[str, Column]) -> DataFrame:
    """Calls, tokens and price per step and model; ``cost`` comes from ``call_cost``.

    Millionths are summed exactly and rounded once. A model without a known price has none here.
    """
    millionth = F.lit("0.000001").cast("decimal(7,6)")
    return (
        calls.groupBy(step, model)
        .agg(F.count("*").alias("n_calls"), *[F.sum(c).alias(name) for name, c in cost.items()])
        .withColumn("price", F.round(F.col("price").cast("decimal(28,3)") * millionth, 6).cast("double"))
    )


def ab_summary(scored: DataFrame, conditions: Sequence[str]) -> DataFrame:
    """Accuracies and mean time per condition."""

    def acc(field: str) -> Column:
        right = F.coalesce(F.col(f"{field}_gt") == F.col(field), F.lit(False)).cast("double")
        return (100.0 * F.avg(F.when(F.col(f"{field}_gt").isNotNull(), right))).alias(f"{field}_acc")

    return (
        scored.where(F.col("condition").isin(list(conditions)))
        .groupBy("condition")
        .agg(
            F.count("*").alias("n_files"),
            acc("type"),
            acc("group"),
            acc("data_granularity"),
            F.avg("elapsed_ms").alias("mean_ms"),
        )
    )


def ab_recall(scored: DataFrame, conditions: Sequence[str]) -> DataFrame:
    """Recall per true type, conditions side by side."""
    right = F.coalesce(F.col("type_gt") == F.col("type"), F.lit(False)).cast("double")
    return (
        scored.where(F.col("type_gt").isNotNull())
        .groupBy("type_gt")
        .pivot("condition", list(conditions))
        .agg(100.0 * F.avg(right))
        .select("type_gt", *[F.col(c).alias(f"recall_{c}") for c in conditions])
    )


def publication_year(paper_id: Column) -> Column:
    """Characters 9 and 10 of the id as a year of this century."""
    return F.substring(paper_id, 9, 2).try_cast("int") + 2000


def corpus_by_year(papers: DataFrame) -> DataFrame:
    per = papers.groupBy(publication_year(F.col("paper_id")).alias("year")).agg(
        F.count_distinct("paper_id").alias("n_papers")
    )
    y, n = F.col("year"), F.col("n_papers")
    facts = {
        "first_year": F.min(y),
        "last_year": F.max(y),
        "_early": F.coalesce(F.sum(F.when((y >= 2014) & (y <= 2017), n)), F.lit(0)),
        "_all": F.sum(F.when(y.isNotNull(), n)),
    }
    return attach_grand(per, **facts).select(
        "year",
        "n_papers",
        (100.0 * n / F.col("_all")).alias("pct"),
        "first_year",
        "last_year",
        (100.0 * F.col("_early") / F.col("_all")).alias("pct_2014_2017"),
    )


def type_shares(files: DataFrame, field: str) -> DataFrame:
    """Files and repositories per type, and the shares of ``field`` within the type."""
    cells = files.groupBy("type", F.coalesce(field, F.lit("(none)")).alias("value"), "paper_id").agg(
        F.count("*").alias("n")
    )
    parts = cells.groupBy("type", "value").agg(F.sum("n").alias("n_files"))
    totals = cells.groupBy("type").agg(F.sum("n").alias("_all"), F.count_distinct("paper_id").alias("n_repos"))
    return attach(parts, totals, ["type"]).select(
        "type", "value", "n_files", "n_repos", (100.0 * F.col("n_files") / F.col("_all")).alias("share")
    )


def backfill_format(structure: DataFrame, data_format: Column) -> DataFrame:
    """Formats of data rows from their extension where missing; other rows have none. Idempotent."""
    data = F.col("type") == "data"
    return structure.withColumn("data_format", F.when(data, F.coalesce("data_format", data_format)))
