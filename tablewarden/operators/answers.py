"""Batches for an outside classifier, its answers merged back, human labels overlaid."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.paths import SENTINEL, basename, clean_group, dirname, valid_type
from tablewarden.operators.scale import attach, first_rows, positions

OVERLAID = ("type", "group", "data_granularity")


def batches(
    items: DataFrame, size: int, by: Sequence[str] = ("paper_id",), order: str | Sequence[Column] = "ord"
) -> DataFrame:
    """Number the items of each repository in chunks of ``size``, in listing order or another."""
    numbered = positions(items, list(by), order, out="_pos")
    return numbered.withColumn("batch", F.ceil(F.col("_pos") / F.lit(size)).cast("bigint")).drop("_pos")


def text_chunks(lines: DataFrame, by: Sequence[str], order: str, size: int = 100, cap: int | None = None) -> DataFrame:
    """Lines grouped into chunks of ``size``; ``cap`` keeps the first chunks only."""
    chunked = batches(lines, size, by, order).withColumnRenamed("batch", "chunk")
    if cap:
        chunked = chunked.where(F.col("chunk") <= cap)
    rows = F.array_sort(F.collect_list(F.struct(order, "line")))
    return chunked.groupBy(*by, "chunk").agg(
        F.array_join(F.transform(rows, lambda r: r["line"]), "\n").alias("text")
    )


def batch_context(answered: DataFrame, tokens: int = 3, examples: int = 2) -> DataFrame:
    """What earlier batches of the repository established, per batch.

    ``answered`` carries ``paper_id, batch, ord, rel_path, type, group``. Per
    group the first ``tokens`` distinct folder names and per type the first
    ``examples`` distinct file names are fixed by first occurrence, so a batch
    simply sees those first seen before it; also the last entry before it.
    """
    path = F.col("rel_path")
    folder = basename(dirname(path))
    token = F.when(folder == "", basename(path)).otherwise(folder)

    def seen(key: str, value: Column, keep: Column, k: int) -> DataFrame:
        first = (
            answered.where(keep)
            .groupBy("paper_id", F.col(key).alias("key"), value.alias("value"))
            .agg(F.min("ord").alias("ord"), F.min("batch").alias("first_batch"))
        )
        return first_rows(first, ["paper_id", "key"], [F.col("ord")], k)

    def listed(rows: DataFrame, out: str) -> DataFrame:
        return rows.groupBy("paper_id").agg(
            F.array_sort(F.collect_list(F.struct("key", "ord", "value", "first_batch"))).alias(out)
        )

    groups = listed(
        seen("group", token, F.col("group").rlike("^(ex|pilot|shared)"), tokens), "group_tokens"
    )
    types = listed(seen("type", basename(path), F.col("type").isNotNull(), examples), "type_examples")
    last = (
        answered.groupBy("paper_id", "batch")
        .agg(F.max_by(F.struct("rel_path", "type", "group"), "ord").alias("last_entry"))
        .select("paper_id", (F.col("batch") + 1).alias("batch"), "last_entry")
    )
    all_batches = answered.select("paper_id", "batch").distinct()
    out = attach(attach(all_batches, groups, ["paper_id"]), types, ["paper_id"])

    def before(name: str) -> Column:
        kept = F.filter(name, lambda r: r["first_batch"] < F.col("batch"))
        return F.transform(kept, lambda r: F.concat_ws("=", r["key"], r["value"])).alias(name)

    return attach(out, last, ["paper_id", "batch"]).select(
        "paper_id", "batch", before("group_tokens"), before("type_examples"), "last_entry"
    )


def ask(items: DataFrame, classifier: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Run a user's batch classifier over whole batches, on the executors.

    One row per batch travels as an array of paths; batches have a fixed size,
    so no group grows with the data. The function gets a frame of batches and
    returns answer rows in ``schema``.
    """
    rows = items.groupBy("paper_id", "batch").agg(
        F.array_sort(F.collect_list(F.struct("ord", "rel_path"))).alias("_r")
    )
    paths = rows.select("paper_id", "batch", F.transform("_r", lambda r: r["rel_path"]).alias("paths"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield classifier(frame)

    return paths.mapInPandas(run, schema)


def merge_answers(
    items: DataFrame, answers: DataFrame, fallback_type: str = "other", fallback_group: str = "shared"
) -> DataFrame:
    """Answers joined to their batch items; a bad batch falls to the sentinel as a whole.

    A batch is good if it has one answer row per item, each field occurs, and
    every type is known once missing answers take the fallback. Of repeated
    keys the first answer counts. Groups outside the pattern become shared.
    """
    # items and answers of a batch meet once; a batch has a fixed size, so its window has too
    answered = answers.select(
        "paper_id", "batch", "rel_path", F.struct("ord", "type", "group").alias("_a"), F.lit(True).alias("_answer")
    )
    both = items.unionByName(answered, allowMissingColumns=True)
    own, whole = Window.partitionBy("paper_id", "batch", "rel_path"), Window.partitionBy("paper_id", "batch")
    is_item = F.col("_answer").isNull()
    filled = both.withColumn("_first", F.min_by("_a", "_a.ord").over(own)).withColumns(
        {
            "type": F.coalesce("_first.type", F.lit(fallback_type)),
            "group": F.coalesce("_first.group", F.lit(fallback_group)),
        }
    )
    ok = (
        (F.count_if(is_item).over(whole) == F.count("_answer").over(whole))
        & F.bool_or(F.col("_a.type").isNotNull()).over(whole)
        & F.bool_or(F.col("_a.group").isNotNull()).over(whole)
        & F.bool_and(F.when(is_item, valid_type(F.col("type")))).over(whole)
    )
    judged = filled.withColumn("batch_ok", F.coalesce(ok, F.lit(False))).where(is_item)
    good = F.col("batch_ok")
    return judged.select(
        *items.columns,
        F.when(good, F.col("type")).otherwise(F.lit(SENTINEL)).alias("type"),
        F.when(good, clean_group(F.col("group"))).otherwise(F.lit("shared")).alias("group"),
        "batch_ok",
    )


def propagate(members: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The verdict of a folder and extension goes to all its members; default other / shared."""
    keys = ["paper_id", "aggregate_folder", "ext"]
    return (
        attach(members, verdicts.select(*keys, "type", "group"), keys)
        .withColumn("type", F.coalesce("type", F.lit("other")))
        .withColumn("group", F.coalesce("group", F.lit("shared")))
    )


def overlay(base: DataFrame, truth: DataFrame) -> DataFrame:
    """Human labels win where they are filled and their path names exactly one base row.

    ``truth`` has one row per key with ``<field>_gt`` columns. A count per path
    decides; paths that occur several times are left as they are.
    """
    key = ["paper_id", "rel_path"]
    single = base.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") == 1)
    usable = attach(truth, single.select(*key), key, "left_semi").withColumn("_gt", F.lit(True))
    fields = [f"{f}_gt" for f in OVERLAID]
    out = attach(base, usable.select(*key, *fields, "_gt"), key)
    for f in OVERLAID:
        filled = F.when(F.trim(f"{f}_gt") != "", F.col(f"{f}_gt"))
        out = out.withColumn(f, F.coalesce(filled, f))
    return out.withColumn("ground_truth_validated", F.coalesce("_gt", F.lit(False))).drop("_gt", *fields)


def overlay_mismatches(base: DataFrame, truth: DataFrame) -> DataFrame:
    """Labels whose path names no base row, or several."""
    key = ["paper_id", "rel_path"]
    counts = base.groupBy(*key).agg(F.count("*").alias("n_matches"))
    return (
        attach(truth.select(*key), counts, key)
        .withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))
        .where(F.col("n_matches") != 1)
    )


def annotation_status(base: DataFrame, truth: DataFrame) -> DataFrame:
    """Per repository: complete if both sides list the same paths, partial, or none."""
    key = ["paper_id", "rel_path"]
    left = base.select(*key).distinct().withColumn("_b", F.lit(True))
    right = truth.select(*key).distinct().withColumn("_t", F.lit(True))
    facts = (
        left.join(right, key, "full")
        .groupBy("paper_id")
        .agg(
            F.count("_b").alias("n_base"),
            F.count("_t").alias("n_truth"),
            F.count_if(F.col("_b") & F.col("_t")).alias("n_both"),
        )
    )
    b, t, both = F.col("n_base"), F.col("n_truth"), F.col("n_both")
    return facts.withColumn(
        "status",
        F.when((b == 0) | (t == 0), F.lit("none"))
        .when((both == b) & (both == t), F.lit("complete"))
        .otherwise(F.lit("partial")),
    )


def fully_annotated(base: DataFrame, truth: DataFrame) -> DataFrame:
    done = annotation_status(base, truth).where(F.col("status") == "complete").select("paper_id")
    return attach(base, done, ["paper_id"], "left_semi")


def consistency_findings(truth: DataFrame) -> DataFrame:
    """One row per label row and failed check, over six checks."""

    def has(c: str) -> Column:
        return F.coalesce(F.trim(c) != "", F.lit(False))

    data = F.coalesce(F.trim("type_gt") == "data", F.lit(False))
    key = ["paper_id", "rel_path"]
    repeated = truth.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    checks = {
        "data_missing_granularity": data & ~has("data_granularity_gt"),
        "spurious_granularity": ~data & has("data_granularity_gt"),
        "data_missing_format": data & ~has("data_format_gt"),
        "spurious_format": ~data & has("data_format_gt"),
        "duplicate_paths": F.col("_n").isNotNull(),
        "missing_group": ~has("group_gt"),
    }
    found = F.filter(
        F.array(*[F.when(cond, F.lit(name)) for name, cond in checks.items()]), lambda x: x.isNotNull()
    )
    return attach(truth, repeated, key).withColumn("check", F.explode(found)).drop("_n")


def enrich(base: DataFrame, lookup: DataFrame) -> DataFrame:
    """Citation fields from the lookup win; title and authors only where the base has none."""
    cited = ["journal", "pub_year", "date", "volume", "issue", "pages", "issn", "publisher"]
    joined = base.join(
        lookup.select("paper_id", *[F.col(c).alias(f"_l_{c}") for c in [*cited, "title", "authors"]]),
        "paper_id",
        "left",
    )
    out = joined
    for c in cited:
        out = out.withColumn(c, F.coalesce(f"_l_{c}", c))
    out = out.withColumn("title", F.coalesce(F.when(F.col("title") != "", F.col("title")), F.col("_l_title")))
    out = out.withColumn(
        "authors", F.when(F.coalesce(F.size("authors"), F.lit(0)) > 0, F.col("authors")).otherwise(F.col("_l_authors"))
    )
    return out.select(*base.columns)
