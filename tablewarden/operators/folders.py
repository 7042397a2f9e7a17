"""Operators over file listings: duplicates, folder roles, granularity, type overrides.

A listing has ``paper_id, rel_path`` and, where first-come matters, an integer
``ord`` (listing order). Containment is never a prefix join: a file's folders
are computed from its own path and compared by equality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.paths import (
    BUILD_FOLDERS,
    TABLE_EXTENSIONS,
    TOOL_FOLDERS,
    ancestors,
    basename,
    dirname,
    ext,
    is_git_internal,
    is_participant_id,
    is_readme,
    stem,
    type_from_extension,
)
from tablewarden.operators.scale import attach, first_rows, positions
from tablewarden.session import settle

FOLDER_LIMIT = 20
BUILD_MIN_FILES = 100
PATTERN_MIN_FILES = 8
TEXT_EXTENSIONS = ["csv", "tsv", "txt", "dat"]
PAIR_SOURCES = ["rmd", "qmd", "tex"]


def drop_git(files: DataFrame) -> DataFrame:
    return files.where(~is_git_internal(F.col("rel_path")))


def settle_clashes(files: DataFrame, by: Sequence[str], name: str, full: str) -> DataFrame:
    """Shortened names made unique: where different ``full`` names share one, a digest goes before its extension.

    A name that only one full name has stays as it is.
    """
    keys = [*by, name]
    shared = files.groupBy(*keys).agg((F.min(full) != F.max(full)).alias("_clash")).where("_clash")
    marked = F.regexp_replace(name, r"(_data)?(\.[A-Za-z0-9]+)?$", "")
    tail = F.expr(f"substr({name}, length(regexp_replace({name}, '(_data)?([.][A-Za-z0-9]+)?$', '')) + 1)")
    unique = F.concat(marked, F.lit("-"), F.substring(F.md5(full), 1, 12), tail)
    return attach(files, shared, keys).withColumn(name, F.when(F.col("_clash"), unique).otherwise(F.col(name))).drop("_clash")


def drop_duplicates(files: DataFrame, fingerprint: str = "fingerprint") -> DataFrame:
    """Same name and size within a repository: only the first listed file stays.

    Text tables must also agree in their ``fingerprint`` (their first lines).
    Copies are reduced to one per task before the shuffle.
    """
    path = F.col("rel_path")
    keyed = files.withColumn("_name", basename(path)).withColumn(
        "_print",
        F.when(ext(path).isin(TEXT_EXTENSIONS), F.coalesce(fingerprint, F.lit(""))).otherwise(F.lit("")),
    )
    return first_rows(keyed, ["paper_id", "_name", "size", "_print"], [F.col("ord")]).drop(
        "_name", "_print"
    )


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).drop("_n")
    return attach(df, repeated.withColumn("_hit", F.lit(True)), keys, "inner").drop("_hit")


def _named(path: Column, names: Sequence[str]) -> Column:
    lowered = [n.lower() for n in names]
    return F.filter(ancestors(path), lambda d: F.lower(F.substring_index(d, "/", -1)).isin(lowered))


def software_folders(files: DataFrame, min_files: int = BUILD_MIN_FILES) -> DataFrame:
    """Each file with the software folder that claims it, null if none does.

    The outermost tool folder above a file claims it. Among the rest a build
    folder qualifies with at least ``min_files`` files of which at most half
    are tables; the outermost that qualifies claims. An outer folder that
    qualifies takes all files of an inner one, and one that does not leaves
    them alone, so every folder is judged on its own count.
    """
    path = F.col("rel_path")
    tool = files.withColumn("_tool", F.get(_named(path, TOOL_FOLDERS), F.lit(0)))
    rest = tool.where(F.col("_tool").isNull())
    cand = rest.select(
        "paper_id", "rel_path", F.explode(_named(path, BUILD_FOLDERS)).alias("_dir")
    )
    judged = (
        cand.groupBy("paper_id", "_dir")
        .agg(
            F.count("*").alias("_n"),
            F.avg(ext(path).isin(TABLE_EXTENSIONS).cast("double")).alias("_tables"),
        )
        .where((F.col("_n") >= min_files) & (F.col("_tables") <= 0.5))
        .select("paper_id", "_dir")
    )
    claims = (
        attach(cand, judged, ["paper_id", "_dir"], "left_semi")
        .groupBy("paper_id", "rel_path")
        .agg(F.min_by("_dir", F.length("_dir")).alias("_build"))
    )
    return (
        attach(tool, claims, ["paper_id", "rel_path"])
        .withColumn("software_folder", F.coalesce("_tool", "_build"))
        .drop("_tool", "_build")
    )


def flat_aggregates(files: DataFrame, limit: int = FOLDER_LIMIT) -> DataFrame:
    """Folders with more than ``limit`` direct files."""
    return (
        files.withColumn("folder", dirname(F.col("rel_path")))
        .groupBy("paper_id", "folder")
        .agg(F.count("*").alias("n_files"))
        .where(F.col("n_files") > limit)
    )


def participant_aggregates(files: DataFrame, limit: int = FOLDER_LIMIT) -> DataFrame:
    """Folders with more than ``limit`` direct child folders named like a participant."""
    child = files.select("paper_id", F.explode(ancestors(F.col("rel_path"))).alias("_dir")).distinct()
    return (
        child.select("paper_id", dirname(F.col("_dir")).alias("folder"), basename(F.col("_dir")).alias("_name"))
        .where((F.col("folder") != "") & is_participant_id(F.col("_name")))
        .groupBy("paper_id", "folder")
        .agg(F.count("*").alias("n_children"))
        .where(F.col("n_children") > limit)
    )


def assign_aggregate_folder(files: DataFrame, limit: int = FOLDER_LIMIT) -> DataFrame:
    """Each file's aggregate folder: the outermost participant folder above it, else its own
    folder if that is a flat aggregate, else null. ``by_participant`` tells which."""
    path = F.col("rel_path")
    people = participant_aggregates(files, limit).select("paper_id", F.col("folder").alias("_dir"))
    above = files.select("paper_id", "rel_path", F.explode(ancestors(path)).alias("_dir"))
    under = (
        attach(above, people, ["paper_id", "_dir"], "left_semi")
        .groupBy("paper_id", "rel_path")
        .agg(F.min_by("_dir", F.length("_dir")).alias("_people"))
    )
    flat = flat_aggregates(files, limit).select(
        "paper_id", F.col("folder").alias("_own"), F.lit(True).alias("_flat")
    )
    marked = attach(files.withColumn("_own", dirname(path)), flat, ["paper_id", "_own"])
    return (
        attach(marked, under, ["paper_id", "rel_path"])
        .withColumn("aggregate_folder", F.coalesce("_people", F.when(F.col("_flat"), F.col("_own"))))
        .withColumn("by_participant", F.col("_people").isNotNull())
        .drop("_own", "_flat", "_people")
    )


def extension_groups(members: DataFrame, route_below: int = FOLDER_LIMIT, samples: int = 5) -> DataFrame:
    """Per aggregate folder and extension: size, series flag, evenly spaced sample paths.

    ``members`` carry ``aggregate_folder`` and ``by_participant``. Samples are
    the members at ``round(1 + k (n-1) / 4)`` in name order, halves to even.
    Groups below ``route_below`` are sent through one by one.
    """
    keys = ["paper_id", "aggregate_folder", "ext"]
    rows = settle(
        members.where(F.col("aggregate_folder").isNotNull()).select(
            "paper_id", "aggregate_folder", ext(F.col("rel_path")).alias("ext"), "rel_path", "by_participant"
        )
    )
    parent = basename(dirname(F.col("rel_path")))
    sizes = rows.groupBy(*keys).agg(
        F.count("*").alias("n_members"),
        (
            F.bool_or("by_participant") & (F.avg(is_participant_id(parent).cast("double")) > 0.5)
        ).alias("is_series"),
    )
    placed = attach(positions(rows, keys, [F.col("rel_path")], width=None), sizes, keys)
    spots = F.array(
        *[F.bround(1 + k * (F.col("n_members") - 1) / float(samples - 1)).cast("bigint") for k in range(samples)]
    )
    wanted = (F.col("n_members") <= samples) | F.array_contains(spots, F.col("pos"))
    picks = (
        placed.where(wanted)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("rel_path")).alias("sample_paths"))
    )
    return attach(sizes, picks, keys).withColumn("route_individually", F.col("n_members") < route_below)


def name_template(path: Column) -> Column:
    """The file stem with every run of digits replaced by ``NUM``."""
    return F.regexp_replace(stem(path), "[0-9]+", "NUM")


def template_regex(template: Column, extension: Column) -> Column:
    body = F.regexp_replace(template, r"([.\\+*?\[\]^$(){}|])", r"\\$1")
    body = F.replace(body, F.lit("NUM"), F.lit("[0-9]+"))
    tail = F.when(extension == "", F.lit("")).otherwise(F.concat(F.lit("\\."), extension))
    return F.concat(F.lit("^"), body, tail, F.lit("$"))


def filename_patterns(files: DataFrame, min_files: int = PATTERN_MIN_FILES, examples: int = 3) -> DataFrame:
    """Numbered name patterns per folder with at least ``min_files`` files."""
    keys = ["paper_id", "folder", "template", "ext"]
    path = F.col("rel_path")
    rows = files.select(
        "paper_id",
        dirname(path).alias("folder"),
        name_template(path).alias("template"),
        ext(path).alias("ext"),
        basename(path).alias("name"),
    )
    common = rows.groupBy(*keys).agg(F.count("*").alias("n_files")).where(F.col("n_files") >= min_files)
    head = (
        first_rows(rows, keys, [F.col("name")], examples)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("name")).alias("examples"))
    )
    return attach(common, head, keys).withColumn(
        "pattern", template_regex(F.col("template"), F.col("ext"))
    )


def base_granularity(files: DataFrame) -> DataFrame:
    """Group members by their series flag, others combined unless named like a participant."""
    member = F.coalesce(F.col("aggregate_folder"), F.lit("")) != ""
    data = F.col("type") == "data"
    person = is_participant_id(stem(F.col("rel_path")))
    return files.withColumn(
        "data_granularity",
        F.when(data & member & F.col("is_series"), F.lit("individual"))
        .when(data & ~member & person, F.lit("individual"))
        .when(data, F.lit("combined")),
    ).withColumn(
        "granularity_source",
        F.when(data & member, F.lit("folder_heuristic"))
        .when(data & person, F.lit("filename_heuristic"))
        .when(data, F.lit("default_combined")),
    )


def granularity(
    files: DataFrame, verdicts: DataFrame | None = None, min_files: int = PATTERN_MIN_FILES
) -> DataFrame:
    """The full ladder: folder and file names, then outside verdicts per aggregate folder, then
    the name patterns of folders judged individual, applied to data files outside such folders.

    ``files`` carry ``type, aggregate_folder, is_series``; ``verdicts`` carry
    ``paper_id, aggregate_folder, verdict``. A file matches a pattern when its
    own template and extension equal those of the pattern, so this is an
    equi-join and not a regex join.
    """
    folder = ["paper_id", "aggregate_folder"]
    path = F.col("rel_path")
    base = base_granularity(files)
    open_rows = base.where((F.col("type") == "data") & (F.col("granularity_source") == "folder_heuristic"))
    majority = (
        open_rows.select(*folder, basename(dirname(path)).alias("_name"))
        .distinct()
        .groupBy(*folder)
        .agg((F.avg(is_participant_id(F.col("_name")).cast("double")) > 0.5).alias("_people"))
    )
    marked = attach(base, majority, folder)
    if verdicts is None:
        marked = marked.withColumn("verdict", F.lit(None).cast("string"))
    else:
        marked = attach(marked, verdicts, folder)
    unclear = (F.col("granularity_source") == "folder_heuristic") & (F.col("type") == "data")
    people = unclear & F.coalesce("_people", F.lit(False))
    judged = unclear & ~people & F.col("verdict").isin("individual", "combined")
    ladder = marked.withColumn(
        "data_granularity",
        F.when(people, F.lit("individual")).when(judged, F.col("verdict")).otherwise(F.col("data_granularity")),
    ).withColumn(
        "granularity_source",
        F.when(people, F.lit("folder_name_heuristic"))
        .when(judged, F.lit("llm"))
        .otherwise(F.col("granularity_source")),
    )
    names = ["_template", "_ext"]
    named = ladder.withColumn("_template", name_template(path)).withColumn("_ext", ext(path))
    learned = (
        named.where((F.col("granularity_source") == "llm") & (F.col("data_granularity") == "individual"))
        .groupBy(*folder, *names)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") >= min_files)
        .select("paper_id", *names, F.lit(True).alias("_learned"))
        .distinct()
    )
    out = attach(named, learned, ["paper_id", *names])
    hit = (
        F.col("_learned")
        & F.col("aggregate_folder").isNull()
        & (F.col("type") == "data")
        & (F.col("data_granularity") != "individual")
    )
    return (
        out.withColumn(
            "granularity_source",
            F.when(hit, F.lit("llm_pattern_inference")).otherwise(F.col("granularity_source")),
        )
        .withColumn(
            "data_granularity", F.when(hit, F.lit("individual")).otherwise(F.col("data_granularity"))
        )
        .drop("_people", "verdict", "_learned", *names)
    )


def override_type(files: DataFrame, new_type: Column, source: Column | str) -> DataFrame:
    """Set the type where ``new_type`` is not null and differs; only then touch source and format."""
    label = F.lit(source) if isinstance(source, str) else source
    hit = new_type.isNotNull() & ~new_type.eqNullSafe(F.col("type")) & F.col("type").isNotNull()
    return (
        files.withColumn("_hit", hit)
        .withColumn("type_source", F.when(F.col("_hit"), label).otherwise(F.col("type_source")))
        .withColumn("data_format", F.when(~F.col("_hit"), F.col("data_format")))
        .withColumn("type", F.when(F.col("_hit"), new_type).otherwise(F.col("type")))
        .drop("_hit")
    )


def apply_extension_rules(files: DataFrame) -> DataFrame:
    return override_type(files, type_from_extension(F.col("ext")), "fixed_ext_rule")


def apply_readme_rule(files: DataFrame) -> DataFrame:
    readme = F.when(is_readme(basename(F.col("rel_path"))), F.lit("readme"))
    return override_type(files, readme, "fixed_filename_rule")


def apply_pair_rule(files: DataFrame) -> DataFrame:
    """A PDF next to its source document is output, the source is code."""
    key = F.concat_ws("/", dirname(F.col("rel_path")), stem(F.col("rel_path")))
    keyed = files.withColumn("_key", key)
    both = keyed.groupBy("paper_id", "_key").agg(
        (F.bool_or(F.col("ext") == "pdf") & F.bool_or(F.col("ext").isin(PAIR_SOURCES))).alias("_pair")
    )
    e = F.col("ext")
    hit = F.coalesce("_pair", F.lit(False)) & ((e == "pdf") | e.isin(PAIR_SOURCES))
    return (
        attach(keyed, both.where("_pair"), ["paper_id", "_key"])
        .withColumn("_hit", hit)
        .withColumn(
            "type",
            F.when(F.col("_hit"), F.when(e == "pdf", F.lit("output")).otherwise(F.lit("code"))).otherwise(
                F.col("type")
            ),
        )
        .withColumn(
            "type_source", F.when(F.col("_hit"), F.lit("rmd_pair_rule")).otherwise(F.col("type_source"))
        )
        .withColumn("data_format", F.when(~F.col("_hit"), F.col("data_format")))
        .drop("_key", "_pair", "_hit")
    )


def apply_type_rules(files: DataFrame) -> DataFrame:
    """Pair rule, then fixed extensions, then readme names; later wins."""
    return apply_readme_rule(apply_extension_rules(apply_pair_rule(files)))


def resolve_shared(files: DataFrame, studies: str = r"^(ex|pilot)\d+\w*$") -> DataFrame:
    """A shared file in a folder whose other files name exactly one study joins that study."""
    keyed = files.withColumn("_dir", dirname(F.col("rel_path")))
    own = F.when(F.col("group").rlike(studies), F.col("group"))
    facts = keyed.groupBy("paper_id", "_dir").agg(F.min(own).alias("_lo"), F.max(own).alias("_hi"))
    one = (F.col("group") == "shared") & (F.col("_lo") == F.col("_hi"))
    return (
        attach(keyed, facts, ["paper_id", "_dir"])
        .withColumn("group", F.when(one, F.col("_lo")).otherwise(F.col("group")))
        .drop("_dir", "_lo", "_hi")
    )


def assemble_structure(software: DataFrame, individual: DataFrame, grouped: DataFrame) -> DataFrame:
    """Software files, single files and expanded group members in one listing."""
    tagged = software.withColumn("type", F.lit("software")).withColumn(
        "type_source", F.lit("software_folder")
    )
    return tagged.unionByName(individual, allowMissingColumns=True).unionByName(
        grouped, allowMissingColumns=True
    )


def study_layout(files: DataFrame) -> DataFrame:
    """Output folder per file: flat for one study, else one folder per study plus shared.

    Studies are the distinct groups among the data files.
    """
    studies = (
        files.where((F.col("type") == "data") & F.col("group").isNotNull() & (F.col("group") != "shared"))
        .groupBy("paper_id")
        .agg(F.count_distinct("group").alias("n_studies"))
    )
    n = F.coalesce("n_studies", F.lit(0))
    return (
        attach(files, studies, ["paper_id"])
        .withColumn("n_studies", n)
        .withColumn(
            "output_folder",
            F.when(n <= 1, F.col("paper_id")).otherwise(
                F.concat_ws("/", "paper_id", F.coalesce("group", F.lit("shared")))
            ),
        )
    )


def inventory_crosstab(files: DataFrame, types: Sequence[str]) -> DataFrame:
    """Files per group and type; experiments first, then pilots, shared and the rest."""
    g = F.col("group")
    rank = (
        F.when(g.startswith("ex"), 1).when(g.startswith("pilot"), 2).when(g == "shared", 3).otherwise(4)
    )
    wide = files.groupBy("group").pivot("type", list(types)).agg(F.count("type"))
    return wide.select(
        "group", rank.alias("group_rank"), *[F.coalesce(t, F.lit(0)).alias(t) for t in types]
    )


def profiling_candidates(files: DataFrame) -> DataFrame:
    """Tabular, combined data files that are no placeholder for a group."""
    return files.where(
        (F.col("type") == "data")
        & (F.col("data_format") == "tabular")
        & (F.col("data_granularity") == "combined")
        & (F.col("type_source") != "aggregate_sentinel")
    )


def csv_codebooks(files: DataFrame) -> DataFrame:
    return files.where((F.col("type") == "codebook") & (F.col("ext") == "csv"))


def codebook_files(files: DataFrame, k: int | None = None) -> DataFrame:
    """Codebook and readme files; with ``k`` the first so many per repository, codebooks first."""
    docs = files.where(F.col("type").isin("codebook", "readme"))
    return docs if k is None else first_rows(docs, ["paper_id"], [F.col("type"), F.col("ord")], k)
