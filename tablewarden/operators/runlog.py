"""Run logs: overview, slowest runs, latest rows, stage status, resume and upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.text import error_code, failure_reason
from tablewarden.operators.scale import attach, attach_grand, exact_quantiles, first_rows

TIMINGS = ["elapsed_ms", "download_ms", "llm_ms", "column_ms"]

# Validator keys by who has to fix them.
ISSUE_KEYS = {
    "repository": [
        "CSV_HEADER_REPEATED", "CSV_HEADER_LENGTH_MISMATCH", "FILENAME_KEYWORD_FORMATTING_ERROR", "FILE_EMPTY",
    ],
    "converter": ["VARIABLE_MISSING_FROM_CSV_COLUMNS", "MISSING_DATAFILE", "MISSING_SIDECAR_METADATA"],
    "structural": [
        "FILE_NOT_CHECKED", "MISSING_CHANGES_DOC", "MISSING_DIRECTORY_METADATA", "MISSING_RESULTS_DIRECTORY",
        "MISSING_README_DOC", "MISSING_MATERIALS_DIRECTORY", "MISSING_ANALYSIS_DIRECTORY",
        "MISSING_DOCUMENTATION_DIRECTORY", "INVALID_SCHEMAORG_PROPERTY", "FILENAME_UNOFFICIAL_KEYWORD_WARNING",
        "UNKNOWN_NAMESPACE",
    ],
}


def run_overview(runs: DataFrame) -> DataFrame:
    """Runs, successes and success rate."""
    ok = F.coalesce("success", F.lit(False))
    return runs.agg(
        F.count("*").alias("n_total"),
        F.count_if(ok).alias("n_success"),
        F.count_if(~ok).alias("n_failed"),
        (100.0 * F.avg(ok.cast("double"))).alias("pct_success"),
    )


def failure_codes(runs: DataFrame) -> DataFrame:
    """Failures per leading error code with their share of the failures that name one."""
    failed = runs.where(~F.coalesce("success", F.lit(False)) & F.col("error").isNotNull())
    counts = failed.groupBy(error_code(F.col("error")).alias("error_code")).agg(F.count("*").alias("n"))
    return attach_grand(counts, _all=F.sum("n")).select(
        "error_code", "n", (100.0 * F.col("n") / F.col("_all")).alias("share")
    )


def timing_long(runs: DataFrame, keep: Sequence[str] = ("paper_id",), timings: Sequence[str] = TIMINGS) -> DataFrame:
    cells = [F.struct(F.lit(t).alias("metric"), F.col(t).cast("double").alias("ms")) for t in timings]
    return runs.select(*keep, F.inline(F.array(*cells)))


def timing_summary(runs: DataFrame, timings: Sequence[str] = TIMINGS) -> DataFrame:
    """Mean, median and maximum of each timing, missing ones left out."""
    tall = timing_long(runs, [], timings)
    head = tall.groupBy("metric").agg(
        F.count("ms").alias("n"), F.avg("ms").alias("mean_ms"), F.max("ms").alias("max_ms")
    )
    return attach(head, exact_quantiles(tall, ["metric"], "ms", {"median_ms": 0.5}), ["metric"])


def slowest(runs: DataFrame, k: int, tie: str, timings: Sequence[str] = TIMINGS) -> DataFrame:
    """The ``k`` slowest runs by each timing, with the number of runs lacking it."""
    tall = timing_long(runs, ["paper_id", tie], timings)
    lacking = tall.groupBy("metric").agg(F.count_if(F.col("ms").isNull()).alias("n_missing"))
    top = first_rows(
        tall.where(F.col("ms").isNotNull()), ["metric"], [F.col("ms").desc(), F.col(tie)], k
    )
    return attach(top, lacking, ["metric"])


def last_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    return first_rows(df, keys, [F.col(order).desc()])


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    return first_rows(df, keys, [F.col(order)])


def latest_run(df: DataFrame, keys: Sequence[str], run_id: str, preferred: str | None = None) -> DataFrame:
    """One run per key: the preferred run id where it exists, else the latest."""
    order = [F.col(run_id).desc()]
    if preferred is not None:
        order.insert(0, (F.col(run_id) == preferred).desc())
    return first_rows(df, keys, order)


def top_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    return first_rows(df, keys, order, k)


def priority_order(
    papers: DataFrame, labelled: DataFrame, limit: int | None = None, seed: int | None = None
) -> DataFrame:
    """Labelled repositories first, then OSF before other hosts, then id or a seeded shuffle."""
    known = labelled.select("paper_id").distinct().withColumn("is_gt", F.lit(True))
    out = attach(papers, known, ["paper_id"]).withColumn("is_gt", F.coalesce("is_gt", F.lit(False)))
    tie = F.col("paper_id") if seed is None else F.xxhash64(F.lit(seed), "paper_id")
    ordered = out.orderBy(F.col("is_gt").desc(), (F.col("source") == "osf").desc(), tie)
    return ordered.limit(limit) if limit else ordered


def newest(papers: DataFrame, n: int) -> DataFrame:
    """The ``n`` repositories with the largest numeric id; ids that are no number come last."""
    number = F.col("paper_id").try_cast("decimal(38,0)")
    return papers.orderBy(number.desc_nulls_last(), "paper_id").limit(n)


def stage_status(
    papers: DataFrame,
    index_log: DataFrame,
    codebook_log: DataFrame,
    convert_log: DataFrame,
    report_log: DataFrame,
    structure: DataFrame,
    columns: DataFrame,
    labels: DataFrame,
    converted: DataFrame | None = None,
    reports: DataFrame | None = None,
    tracked: DataFrame | None = None,
) -> DataFrame:
    """Status of the four stages for repositories not tracked yet.

    Logs carry ``paper_id, success`` and are reduced to one row per repository;
    the other frames count as present if they hold the repository at all.
    """
    key = ["paper_id"]
    todo = papers if tracked is None else attach(papers, tracked.select("paper_id"), ["paper_id"], "left_anti")

    def flag(df: DataFrame | None, out: str, todo: DataFrame) -> DataFrame:
        if df is None:
            return todo.withColumn(out, F.lit(False))
        there = df.select("paper_id").distinct().withColumn(out, F.lit(True))
        return attach(todo, there, key).withColumn(out, F.coalesce(out, F.lit(False)))

    def logged(df: DataFrame, out: str, todo: DataFrame) -> DataFrame:
        best = df.groupBy("paper_id").agg(F.bool_or(F.coalesce("success", F.lit(False))).alias(out))
        return attach(todo, best, key)

    out = todo
    for df, name in ((index_log, "_i"), (codebook_log, "_c"), (convert_log, "_v"), (report_log, "_r")):
        out = logged(df, name, out)
    for df, name in (
        (structure, "_fs"), (columns, "_fc"), (labels, "_fl"), (converted, "_fv"), (reports, "_fr")
    ):
        out = flag(df, name, out)

    def ladder(log: str, present: str, *more: tuple[Column, str]) -> Column:
        c = F.when(F.col(log), F.lit("ok")).when(F.col(log).isNotNull(), F.lit("fail"))
        c = c.when(F.col(present), F.lit("ok"))
        for cond, name in more:
            c = c.when(cond, F.lit(name))
        return c.otherwise(F.lit("pending"))

    failed = F.col("_i").isNotNull() & ~F.col("_i")

    def after_index(c: Column) -> Column:
        return F.when(failed, F.lit("skip")).otherwise(c)

    return out.select(
        *papers.columns,
        ladder("_i", "_fs").alias("index"),
        after_index(ladder("_c", "_fl", (~F.col("_fc"), "no_cols"))).alias("codebook"),
        after_index(ladder("_v", "_fv")).alias("convert"),
        after_index(ladder("_r", "_fr")).alias("report"),
    )


def all_done(tracker: DataFrame) -> DataFrame:
    """Repositories with nothing left to do."""
    done = ["ok", "fail", "skip", "no_cols", "no_columns"]
    cond = F.col("index").isin("ok", "fail") & F.col("codebook").isin(done)
    for stage in ("convert", "report"):
        cond = cond & F.col(stage).isin("ok", "fail", "skip")
    return tracker.where(cond)


def tracker_wide(events: DataFrame, stages: Sequence[str]) -> DataFrame:
    """The latest status per repository and stage, one column per stage."""
    last = events.groupBy("paper_id", "stage").agg(F.max_by("status", "ts").alias("status"))
    return last.groupBy("paper_id").pivot("stage", list(stages)).agg(F.first("status"))


def unprocessed(todo: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Resume: what the log does not hold yet."""
    return attach(todo, log.select(*keys).distinct(), keys, "left_anti")


def upsert(base: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``base`` with the same key."""
    kept = attach(base, new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def conversion_funnel(conversions: DataFrame, validations: DataFrame) -> DataFrame:
    """Groups and repositories attempted, converted and valid; a repository is valid iff all its groups are."""
    per = conversions.groupBy("paper_id").agg(
        F.count("*").alias("g"), F.count_if(F.coalesce("success", F.lit(False))).alias("ok")
    )
    valid = validations.groupBy("paper_id").agg(
        F.count("*").alias("vg"),
        F.count_if(F.coalesce("valid", F.lit(False))).alias("vok"),
        F.bool_and(F.coalesce("valid", F.lit(False))).alias("all_valid"),
    )
    return attach(per, valid, ["paper_id"]).agg(
        F.sum("g").alias("n_groups"),
        F.count("*").alias("n_repos"),
        F.sum("ok").alias("n_converted"),
        F.count_if(F.col("ok") > 0).alias("n_repos_converted"),
        F.coalesce(F.sum("vg"), F.lit(0)).alias("n_validated"),
        F.coalesce(F.sum("vok"), F.lit(0)).alias("n_valid"),
        F.count_if(F.coalesce("all_valid", F.lit(False))).alias("n_repos_valid"),
    )


def failure_reasons(conversions: DataFrame) -> DataFrame:
    """Failed groups and the repositories they belong to, per reason."""
    failed = conversions.where(~F.coalesce("success", F.lit(False)))
    return failed.groupBy(failure_reason(F.col("error")).alias("reason")).agg(
        F.count("*").alias("n_groups"), F.count_distinct("paper_id").alias("n_repos")
    )


def error_keys(validations: DataFrame) -> DataFrame:
    """Validator keys from ``;``-joined lists: occurrences and repositories."""
    keys = validations.select("paper_id", F.explode(F.split("error_keys", ";")).alias("key"))
    return (
        keys.withColumn("key", F.trim("key"))
        .where(F.col("key") != "")
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.count_distinct("paper_id").alias("n_repos"))
    )


def issue_category(key: Column, path: Column) -> Column:
    """Who has to fix a validator issue; two keys depend on where the file lies."""
    raw = F.coalesce(path.contains("/data/raw/"), F.lit(False))
    made = F.coalesce(path.rlike("/data/(source-|granularity-)"), F.lit(False))
    out = F.when(
        key == "CSV_COLUMN_MISSING_FROM_METADATA",
        F.when(raw & ~made, F.lit("repository")).otherwise(F.lit("ambiguous")),
    ).when(
        key == "CSV_FORMATTING_ERROR",
        F.when(made & ~raw, F.lit("converter")).otherwise(F.lit("repository")),
    )
    for category, names in ISSUE_KEYS.items():
        out = out.when(key.isin(names), F.lit(category))
    return out.otherwise(F.lit("unknown"))


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("key", issue_category(F.col("key"), F.col("files")).alias("category")).agg(
        F.count("*").alias("n")
    )


def key_sets(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of two frames with the side they occur on: ``left``, ``right`` or ``both``.

    One union and one aggregate give the union, both differences and the
    intersection at once.
    """
    both = a.select(*keys, F.lit(1).alias("_s")).unionByName(b.select(*keys, F.lit(2).alias("_s")))
    sides = both.groupBy(*keys).agg(F.bit_or("_s").alias("_s"))
    name = F.when(F.col("_s") == 3, F.lit("both")).when(F.col("_s") == 1, F.lit("left")).otherwise(F.lit("right"))
    return sides.select(*keys, name.alias("side"))
