"""Whole stages over all repositories: files indexed with their types, columns labelled from dictionaries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.paths import basename, data_format, ext
from tablewarden.operators import answers as A
from tablewarden.operators import folders as D
from tablewarden.operators import match as X
from tablewarden.operators.scale import attach
from tablewarden.session import settle

# Takes (paper_id, batch, ord, rel_path), gives (paper_id, batch, ord, rel_path, type, group).
Classifier = Callable[[DataFrame], DataFrame]

GROUP = ["paper_id", "aggregate_folder", "ext"]
STRUCTURE = [
    "paper_id", "rel_path", "filename", "ext", "type", "type_source", "group", "aggregate_folder",
    "data_granularity", "granularity_source", "prompt_nr", "data_format",
]


def _answered(items: DataFrame, classifier: Classifier, size: int) -> DataFrame:
    """Items in batches of ``size`` with type, group and ``prompt_nr``, the number of the batch.

    ``items``: paper_id, rel_path and the columns of ``place``, their order in the repository. The
    batches are settled, so that the classifier and the merging see the same ones.
    """
    numbered = settle(A.batches(items, size, order=[F.col("place")]).withColumnRenamed("place", "_place"))
    numbered = numbered.withColumn("ord", F.col("_place.ord"))
    asked = numbered.select("paper_id", "batch", "ord", "rel_path")
    merged = A.merge_answers(numbered.drop("_place"), settle(classifier(asked)))
    return merged.withColumn("prompt_nr", F.col("batch")).drop("batch", "batch_ok")


def index_collections(
    files: DataFrame,
    classifier: Classifier,
    verdicts: DataFrame | None = None,
    batch: int = 50,
    limit: int = D.FOLDER_LIMIT,
    build_files: int = D.BUILD_MIN_FILES,
    fingerprint: str = "fingerprint",
) -> DataFrame:
    """The structure table of all repositories: one row per file that is no duplicate, columns ``STRUCTURE``.

    ``files``: paper_id, rel_path, size, ord (place in the listing, unique in a repository) and
    ``fingerprint`` (``with_fingerprints``). In order: version-control files and duplicates go; software
    folders are claimed; large folders and folders of participants are grouped by extension, groups
    under ``limit`` files go with the single files; single files and then one descriptor
    ``folder/.ext`` per group are classified in batches, a bad batch falls to the sentinel; a group's
    answer goes to its members; data files get format and granularity (``verdicts`` as for
    ``granularity``); pairs, fixed extensions and readme names have the last word.
    """
    files = files.select("paper_id", "rel_path", "size", "ord", F.col(fingerprint).alias("fingerprint"))
    kept = D.drop_duplicates(D.drop_git(files)).select("paper_id", "rel_path", "ord")
    claimed = settle(D.software_folders(kept, build_files))
    software = claimed.where("software_folder IS NOT NULL")
    rest = D.assign_aggregate_folder(claimed.where("software_folder IS NULL").drop("software_folder"), limit)
    rest = rest.withColumn("ext", ext(F.col("rel_path")))
    # the top folder has a name too
    rest = settle(rest.withColumn("aggregate_folder", F.when(F.col("aggregate_folder") == "", ".").otherwise(F.col("aggregate_folder"))))
    groups = settle(D.extension_groups(rest, limit).select(*GROUP, "is_series", "route_individually"))
    tagged = attach(rest.drop("by_participant"), groups, GROUP)
    own = F.col("aggregate_folder").isNull()
    alone = own | F.col("route_individually")
    place = F.struct((~own).alias("routed"), F.col("ord").alias("ord"))  # files of small groups come last
    single = tagged.where(alone).select("paper_id", "rel_path", place.alias("place"))
    single = _answered(single, classifier, batch).withColumns(
        {"type_source": F.lit("llm"), "aggregate_folder": F.lit(None).cast("string"), "is_series": F.lit(None).cast("boolean")}
    )
    # one descriptor per group, in the order of its first file
    first = tagged.where(~alone).groupBy(*GROUP).agg(F.min("ord").alias("ord"))
    described = first.select(*GROUP, F.concat("aggregate_folder", F.lit("/."), "ext").alias("rel_path"), F.struct("ord").alias("place"))
    answers = _answered(described, classifier, batch).select(*GROUP, "type", "group", "prompt_nr")
    members = tagged.where(~alone).select("paper_id", "rel_path", "ord", "aggregate_folder", "ext", "is_series")
    members = attach(A.propagate(members, answers), answers.select(*GROUP, "prompt_nr"), GROUP)
    members = members.withColumn("type_source", F.lit("aggregate_llm")).drop("ext")
    claimed = software.select(
        "paper_id", "rel_path", "ord", F.col("software_folder").alias("aggregate_folder"),
        F.lit("software").alias("type"), F.lit("rule_folder").alias("type_source"), F.lit(None).cast("string").alias("group"),
    )
    table = claimed.unionByName(single, allowMissingColumns=True).unionByName(members, allowMissingColumns=True)
    table = table.withColumn("filename", basename(F.col("rel_path"))).withColumn("ext", ext(F.col("rel_path")))
    table = table.withColumn("data_format", F.when(F.col("type") == "data", data_format(F.col("ext"))))
    return D.apply_type_rules(D.granularity(settle(table), verdicts)).select(*STRUCTURE)


def profiled_files(structure: DataFrame, cells: DataFrame) -> DataFrame:
    """The cells (paper_id, source_file, …) of the files whose columns the index describes."""
    wanted = D.profiling_candidates(structure).select("paper_id", F.col("rel_path").alias("source_file"), F.col("group").alias("file_group"))
    return attach(cells, wanted, ["paper_id", "source_file"], "inner")


class Labelling(NamedTuple):
    """What ``label_columns`` returns, a table each."""

    labels: DataFrame
    dictionary: DataFrame
    coverage: DataFrame
    status: DataFrame


def label_columns(
    columns: DataFrame,
    structure: DataFrame,
    parsed: DataFrame,
    embedded: DataFrame | None = None,
    verdicts: DataFrame | None = None,
    pairs: DataFrame | None = None,
) -> Labelling:
    """Columns of all repositories labelled from their dictionaries, with coverage and status.

    ``parsed`` are the dictionary rows read from files, ``codebook_source`` their path: only rows from
    files that ``structure`` calls codebook or readme count. ``embedded`` are labels stored in data
    files (``parse_method`` ``haven``), of which those from data files count; they come first and win
    conflicts. The dictionary is merged and stemmed once and written, then matched, ranges as
    intervals; ``verdicts`` settle conflicts and ``pairs`` fill what is open, where they are given. A
    repository without any such file has the status ``no_codebook``.
    """

    def from_files(rows: DataFrame, files: DataFrame) -> DataFrame:
        named = files.select("paper_id", F.col("rel_path").alias("codebook_source")).distinct()
        return attach(rows, named, ["paper_id", "codebook_source"], "left_semi")

    books = D.codebook_files(structure)
    has = books.select("paper_id")
    parsed = from_files(parsed, books)
    if embedded is None:
        embedded = parsed.where("false")
    else:
        embedded = from_files(embedded, structure.where("type = 'data'"))
        has = has.union(embedded.select("paper_id"))
    book = X.with_label_stems(X.merge_dictionaries(embedded, parsed))
    labels = settle(X.match_labels(columns, book, with_codebook=has))
    if verdicts is not None:
        labels = X.merge_verdicts(labels, verdicts)
    if pairs is not None:
        labels = settle(X.second_pass(settle(labels), book, pairs))
    book = book.drop("label_stem")
    return Labelling(labels, book, X.codebook_coverage(book, labels), X.labelling_status(labels, book))
