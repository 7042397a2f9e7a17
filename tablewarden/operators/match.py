"""Matching of columns to dictionary variables.

A dictionary has ``paper_id, codebook_variable, label, codebook_source, group,
parse_method`` and an integer ``ord`` (its order within the repository). The
columns have ``paper_id, source_file, col_pos, column_name, group``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.names import normalize_label, normalize_variable, stemmed_label
from tablewarden.operators.scale import attach, attach_grand
from tablewarden.session import settle

RANGE = r"^([A-Za-z]*)\s*([0-9]+)\s*[-–]\s*([0-9]+)$"
RANGE_DIGITS = 18
RANGE_STEP = 50_000
# Widths of ranges are counted in hexadecimal digits; 18 decimal ones need no more than this.
LEVELS = 15
# Whose entries a name may mean: those of no group, of the column's group, of any group.
OPEN, OWN, ANY = "open", "own:", "any"
COLUMN_KEY = ["paper_id", "source_file", "col_pos"]
JOINER = " | "


def merge_dictionaries(embedded: DataFrame, parsed: DataFrame) -> DataFrame:
    """Embedded labels first, then the rest; one row per variable, label and group.

    The order is the pair (origin, original order); the first row of a key stays.
    """
    both = embedded.withColumn("_src", F.lit(0)).unionByName(
        parsed.withColumn("_src", F.lit(1)), allowMissingColumns=True
    )
    rest = [c for c in both.columns if c not in ("paper_id", "_src", "ord")]
    keyed = both.withColumn("_norm", normalize_variable(F.col("codebook_variable")))
    return (
        keyed.groupBy("paper_id", "_norm", F.col("label").alias("_label"), F.col("group").alias("_group"))
        .agg(F.min(F.struct("_src", "ord", *rest)).alias("_r"))
        .select("paper_id", "_r.*")
        .select("paper_id", F.struct("_src", "ord").alias("ord"), *rest)
    )


def _bounds(codebook: DataFrame) -> DataFrame:
    """Adds ``_is`` (reads as a range), ``_ok`` (runs forwards), ``_pre``, ``_a`` and ``_b``.

    A number of more than ``RANGE_DIGITS`` digits makes a row an ordinary name.
    """
    text = F.trim(F.col("codebook_variable"))

    def number(group: int) -> Column:
        digits = F.regexp_replace(F.regexp_extract(text, RANGE, group), "^0+(?=[0-9])", "")
        return F.when(F.length(digits) <= RANGE_DIGITS, digits.try_cast("bigint"))

    shaped = F.coalesce(F.col("codebook_variable").rlike(RANGE), F.lit(False))
    return (
        codebook.withColumn("_a", F.when(shaped, number(2)))
        .withColumn("_b", F.when(shaped, number(3)))
        .withColumn("_pre", F.when(shaped, F.regexp_extract(text, RANGE, 1)))
        .withColumn("_is", F.col("_a").isNotNull() & F.col("_b").isNotNull())
        .withColumn("_ok", F.coalesce(F.col("_a") <= F.col("_b"), F.lit(False)))
    )


def _without_backward(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(names, ranges): a range that runs backwards is a name only where its repository has no other range."""
    ranges = tagged.where("_ok")
    backward = attach(tagged.where("_is AND NOT _ok"), ranges.select("paper_id").distinct(), ["paper_id"], "left_anti")
    return tagged.where("NOT _is").unionByName(backward), ranges


def expand_ranges(codebook: DataFrame) -> DataFrame:
    """``V1-V3`` style rows (``V1-3``, hyphen or en dash) become one row per number, after all other rows.

    Padding is lost. Ranges that run backwards are dropped, unless no range of the repository can be
    expanded: then its rows stay as they are. A range gives as many rows as it has numbers, however
    many those are; matching does not need them, see ``match_labels``.
    """
    names, ranges = _without_backward(_bounds(codebook))
    # a long range is unfolded in steps, so that no array has more than RANGE_STEP numbers
    low, high, out = F.col("_a"), F.col("_b"), ranges
    for power in range(3, -1, -1):
        step = RANGE_STEP**power
        out = out.withColumn("_from", F.explode(F.sequence(low, high, F.lit(step).cast("bigint"))))
        low, high = F.col("_from"), F.least(F.col("_b"), F.col("_from") + (step - 1))
    named = out.withColumn("codebook_variable", F.concat("_pre", F.col("_from").cast("string")))
    # expanded rows last, in range order
    order = lambda late, n: F.struct(F.lit(late).alias("late"), F.col("ord").alias("ord"), n.alias("n"))
    rest = ["_a", "_b", "_pre", "_is", "_ok"]
    return (
        names.withColumn("ord", order(0, F.lit(0).cast("bigint")))
        .drop(*rest)
        .unionByName(named.withColumn("ord", order(1, F.col("_from"))).drop(*rest, "_from"))
    )


def _entries(codebook: DataFrame) -> DataFrame:
    """Dictionary rows under the ``_key`` by which a name finds them, with ``_late``, ``_a``, ``_b``.

    An ordinary row has its normalised name as key. A range stands under its prefix, the least number
    of hexadecimal digits that its length needs, and its bounds without so many digits: at most two
    keys, one of which every number of the range has too.
    """
    names, ranges = _without_backward(_bounds(codebook))
    plain = names.withColumn("_key", normalize_variable(F.col("codebook_variable"))).withColumn("_late", F.lit(0))
    plain = plain.withColumns({c: F.lit(None).cast("bigint") for c in ("_a", "_b")})
    digits = F.length(F.hex(F.col("_b") - F.col("_a")))
    spots = F.array_distinct(F.array(*[F.call_function("shiftright", F.col(c), 4 * digits) for c in ("_a", "_b")]))
    spread = (
        ranges.withColumn("_spot", F.explode(spots))
        .withColumn("_key", _spot_key(F.lower("_pre"), digits, F.col("_spot")))
        .withColumn("codebook_variable", F.col("_pre"))  # the number follows from the name that asks
        .withColumn("_late", F.lit(1))
        .drop("_spot")
    )
    return plain.unionByName(spread).drop("_pre", "_is", "_ok")


def _spot_key(prefix: Column, digits: Column, spot: Column) -> Column:
    # no normalised name has a line end, so these keys meet no other
    return F.concat_ws("\n", prefix, digits.cast("string"), spot.cast("string"))


NUMBERED = "^([a-z]*)(0|[1-9][0-9]{0,17})$"


def _asked_keys(names: DataFrame) -> DataFrame:
    """One row per key under which the dictionary may hold ``_norm``: the name, and its places in ranges."""
    digits, number = F.regexp_extract("_norm", NUMBERED, 2), F.col("_number")
    levels = F.when(number.isNotNull(), F.sequence(F.lit(0), F.lit(LEVELS))).otherwise(F.array(F.lit(0)))
    key = F.when(F.col("_level") == 0, F.col("_norm")).otherwise(
        _spot_key(F.regexp_extract("_norm", NUMBERED, 1), F.col("_level"), F.call_function("shiftright", number, 4 * F.col("_level")))
    )
    return (
        names.withColumn("_number", F.when(digits != "", digits.cast("bigint")))
        .withColumn("_level", F.explode(levels))
        .withColumn("_key", key)
        .drop("_level")
    )


def entries_of_names(names: DataFrame, codebook: DataFrame) -> DataFrame:
    """The rows of ``codebook`` that stand for each ``(paper_id, _norm)``, ranges as the one name asked for.

    An interval join by equality: a number meets a range under the width of the range, then the bounds
    decide. No range is unfolded, so its length does not matter. ``ord`` sorts as after ``expand_ranges``.
    """
    asked = _asked_keys(names.select("paper_id", "_norm").distinct())
    book = _entries(codebook).withColumnRenamed("paper_id", "_of")
    inside = F.col("_a").isNull() | F.col("_number").between(F.col("_a"), F.col("_b"))
    found = asked.join(book.withColumnRenamed("_key", "_found"), F.expr("paper_id <=> _of AND _key = _found") & inside)
    variable = F.when(F.col("_a").isNotNull(), F.concat("codebook_variable", F.col("_number").cast("string")))
    return (
        found.withColumn("codebook_variable", F.coalesce(variable, "codebook_variable"))
        .withColumn("ord", F.struct(F.col("_late").alias("late"), F.col("ord").alias("ord")))
        .drop("_of", "_found", "_key", "_number", "_late", "_a", "_b")
    )


def _longest(rows: Column) -> Column:
    """The longest label of (ord, value) in order, the first of equals."""
    labels = F.transform(rows, lambda r: r["value"])
    top = F.array_max(F.transform(labels, F.length))
    return F.get(F.filter(labels, lambda x: F.length(x) == top), F.lit(0))


def match_labels(
    columns: DataFrame, codebook: DataFrame, stems: bool = True, with_codebook: DataFrame | None = None
) -> DataFrame:
    """Label outcome per column by equality of normalised names within the repository.

    What a name means depends only on (repository, name, group of the column). The outcome is worked
    out once per such key and then joined to the columns. Dictionary rows are taken apart into their
    distinct values (label, variable, source) before they meet the keys, so a name that the dictionary
    repeats very often counts as often as it has different values; only values that belong into the
    outcome come together in a row. Rows like ``V1-99`` stand for all their numbers, see
    ``entries_of_names``.

    Labels that agree in their Porter stems are one; with ``stems=False`` only plurals are stripped. A
    codebook that has a column ``label_stem`` (``with_label_stems``) is not stemmed again.
    ``with_codebook`` lists the ``paper_id`` that have any codebook: columns of all others get the
    status ``no_codebook``.
    """
    outcome_key = ["paper_id", "_norm", "group"]
    key = ["paper_id", "_key", "_late", "_a", "_b", "_scope", "field", "value"]
    stemmed = "label_stem" in codebook.columns
    entries = _entries(codebook)
    fields = {"label": F.col("label"), "variable": F.col("codebook_variable"), "source": F.col("codebook_source")}
    own = F.col("parse_method") == "haven"
    cells = [F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in fields.items()]
    cells += [F.struct(F.lit(f"own_{f}").alias("field"), F.when(own, v).alias("value")) for f, v in fields.items()]
    # an entry of a group counts for the columns of that group and, as another's, for all
    scopes = F.when(F.col("group").isNull(), F.array(F.lit(OPEN))).otherwise(
        F.array(F.concat(F.lit(OWN), "group"), F.lit(ANY))
    )
    values = (
        entries.withColumn("_cell", F.explode(F.array(*cells)))
        .select(*[c for c in key[:5] if c != "_scope"], "group", "ord", *(["label_stem"] if stemmed else []), "_cell.*")
        .where("value IS NOT NULL")
        .withColumn("_scope", F.explode(scopes))
        .groupBy(*key, *(["label_stem"] if stemmed else []))
        .agg(F.min("ord").alias("ord"))
    )
    if not stemmed:
        words = stemmed_label(F.col("value")) if stems else normalize_label(F.col("value"))
        labels = values.where("field = 'label'").withColumn("label_stem", words)
        values = values.where("field <> 'label'").withColumn("label_stem", F.lit(None).cast("string")).unionByName(labels)
    keyed = columns.withColumn("_norm", normalize_variable(F.col("column_name")))
    mine = F.when(F.col("group").isNull(), F.array(F.lit(OPEN), F.lit(ANY))).otherwise(
        F.array(F.lit(OPEN), F.lit(ANY), F.concat(F.lit(OWN), "group"))
    )
    asked = _asked_keys(keyed.select(*outcome_key).distinct()).withColumn("_scope", F.explode(mine))
    right = values.withColumnsRenamed({c: f"b{c}" for c in ("paper_id", "_key", "_scope")})
    inside = F.col("_a").isNull() | F.col("_number").between(F.col("_a"), F.col("_b"))
    same = F.expr("paper_id <=> bpaper_id AND _key = b_key AND _scope = b_scope")
    found = asked.join(right, same & inside)
    number = F.col("_a").isNotNull() & F.col("field").isin("variable", "own_variable")
    value = F.when(number, F.concat("value", F.col("_number").cast("string"))).otherwise(F.col("value"))
    # open entries come before those of the group, expanded ranges last
    order = F.struct(F.startswith("_scope", F.lit(OWN)).alias("own"), F.col("_late").alias("late"), F.col("ord").alias("ord"))
    rows = found.select(*outcome_key, "_scope", "field", F.struct(order.alias("ord"), value.alias("value"), F.col("label_stem").alias("stem")).alias("r"))
    here = F.col("_scope") != ANY

    def listed(field: str, applies: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(applies & (F.col("field") == field), F.col("r"))))

    lists = {f"_{f}": listed(f, here) for f in (*fields, "own_label", "own_variable", "own_source")}
    lists |= {f"_other_{f}": listed(f, ~here) for f in fields}
    staged = rows.groupBy(*outcome_key).agg(*[c.alias(n) for n, c in lists.items()])
    staged = staged.withColumn("_stems", F.array_distinct(F.transform("_label", lambda r: r["stem"])))

    def distinct(field: str) -> Column:
        return F.array_distinct(F.transform(field, lambda r: r["value"]))

    def first(field: str) -> Column:
        return F.array(F.get(field, F.lit(0))["value"])

    some, n_labels = F.size("_variable") > 0, F.size(distinct("_label"))
    other_only = ~some & (F.size("_other_variable") > 0)
    one = some & (n_labels <= 1)
    many = some & (n_labels > 1)
    embedded = many & (F.size("_own_variable") > 0)
    merged = many & ~embedded & (F.size("_stems") == 1)
    status = (
        F.when(other_only, F.lit("ambiguous_experiment"))
        .when(one | embedded | merged, F.lit("labelled"))
        .when(many, F.lit("conflicting_definition"))
    )
    method = F.when(one, F.lit("rules")).when(embedded, F.lit("haven_priority")).when(merged, F.lit("merged_rules"))
    labels = (
        F.when(other_only, distinct("_other_label"))
        .when(embedded, F.array(_longest(F.col("_own_label"))))
        .when(merged, F.array(_longest(F.col("_label"))))
        .otherwise(distinct("_label"))
    )
    variables = (
        F.when(other_only, distinct("_other_variable"))
        .when(one | merged, first("_variable"))
        .when(embedded, first("_own_variable"))
        .otherwise(distinct("_variable"))
    )
    sources = (
        F.when(other_only, distinct("_other_source")).when(embedded, distinct("_own_source")).otherwise(distinct("_source"))
    )
    outcome = staged.select(
        *outcome_key,
        labels.alias("label"),
        variables.alias("codebook_variable"),
        sources.alias("label_source"),
        status.alias("label_status"),
        method.alias("label_method"),
    )
    empty = F.array().cast("array<string>")
    out = attach(keyed, outcome, outcome_key).drop("_norm")
    out = out.withColumns({c: F.coalesce(c, empty) for c in ("label", "codebook_variable", "label_source")})
    status = F.coalesce("label_status", F.lit("unlabelled"))
    if with_codebook is None:
        return out.withColumn("label_status", status)
    known = with_codebook.select("paper_id").distinct().withColumn("_known", F.lit(True))
    status = F.when(F.col("_known"), status).otherwise(F.lit("no_codebook"))
    return attach(out, known, ["paper_id"]).withColumn("label_status", status).drop("_known")


def with_label_stems(codebook: DataFrame) -> DataFrame:
    """The dictionary with its labels' Porter stems, written once for all matching that follows."""
    return settle(codebook.withColumn("label_stem", stemmed_label(F.col("label"))))


def merge_verdicts(labels: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Conflicting rows that an outside verdict calls equivalent take its canonical label.

    ``verdicts``: ``paper_id, column_name, equivalent, canonical``, one per name.
    """
    joined = attach(labels, verdicts, ["paper_id", "column_name"])
    hit = (
        (F.col("label_status") == "conflicting_definition")
        & F.coalesce("equivalent", F.lit(False))
        & (F.coalesce("canonical", F.lit("")) != "")
    )
    return (
        joined.withColumn("label", F.when(hit, F.array("canonical")).otherwise(F.col("label")))
        .withColumn("label_method", F.when(hit, F.lit("merged_llm")).otherwise(F.col("label_method")))
        .withColumn("label_status", F.when(hit, F.lit("labelled")).otherwise(F.col("label_status")))
        .drop("equivalent", "canonical")
    )


def second_pass(labels: DataFrame, codebook: DataFrame, pairs: DataFrame) -> DataFrame:
    """Outside (column, variable) pairs for what is still open on both sides.

    A pair counts only if the column is unlabelled and no labelled row uses the
    variable. It applies to every unlabelled column of that name in the
    repository; the first pair (by ``ord``) of a column wins.
    """
    names = ["paper_id", "_norm"]
    keyed = labels.withColumn("_norm", normalize_variable(F.col("column_name")))
    used = (
        labels.where(F.col("label_status") == "labelled")
        .select("paper_id", F.explode("codebook_variable").alias("_v"))
        .select("paper_id", normalize_variable(F.col("_v")).alias("_var"))
        .distinct()
    )
    asked = pairs.select(
        "paper_id",
        normalize_variable(F.col("column_name")).alias("_norm"),
        normalize_variable(F.col("codebook_variable")).alias("_var"),
        "ord",
    )
    named = entries_of_names(asked.select("paper_id", F.col("_var").alias("_norm")), codebook).withColumnRenamed("_norm", "_var")
    free = (
        attach(named, used, ["paper_id", "_var"], "left_anti")
        .groupBy("paper_id", "_var")
        .agg(
            F.min_by(F.struct("label", "codebook_variable", "codebook_source"), "ord").alias("_hit")
        )
    )
    chosen = asked.join(free, ["paper_id", "_var"]).groupBy(*names).agg(F.min_by("_hit", "ord").alias("_hit"))
    out = attach(keyed, chosen, names)
    hit = (F.col("label_status") == "unlabelled") & F.col("_hit").isNotNull()

    def put(name: str, value: Column) -> Column:
        return F.when(hit, value).otherwise(F.col(name))

    return out.select(
        *[
            c
            for c in labels.columns
            if c not in ("label", "codebook_variable", "label_source", "label_status", "label_method")
        ],
        put("label", F.array("_hit.label")).alias("label"),
        put("codebook_variable", F.array("_hit.codebook_variable")).alias("codebook_variable"),
        put("label_source", F.array("_hit.codebook_source")).alias("label_source"),
        put("label_status", F.lit("llm")).alias("label_status"),
        put("label_method", F.lit("llm")).alias("label_method"),
    )


def joined_output(labels: DataFrame) -> DataFrame:
    """Lists as joined text, empty lists as null, for writing."""
    out = labels
    for c in ("label", "codebook_variable", "label_source"):
        text = F.array_join(c, JOINER)
        out = out.withColumn(c, F.when(F.size(c) > 0, text))
    return out


def codebook_coverage(codebook: DataFrame, labels: DataFrame) -> DataFrame:
    """Each dictionary variable with whether any labelled column uses it."""
    used = (
        labels.where(F.col("label_status").isin("labelled", "llm"))
        .select("paper_id", F.explode("codebook_variable").alias("_v"))
        .select("paper_id", normalize_variable(F.col("_v")).alias("_norm"), F.lit(True).alias("_hit"))
        .distinct()
    )
    keyed = codebook.withColumn("_norm", normalize_variable(F.col("codebook_variable")))
    status = F.when(F.col("_hit"), F.lit("matched")).otherwise(F.lit("unmatched_in_data"))
    return (
        attach(keyed, used, ["paper_id", "_norm"]).withColumn("match_status", status).drop("_norm", "_hit")
    )


def labelling_status(labels: DataFrame, codebook: DataFrame) -> DataFrame:
    """Per repository: labelled and unlabelled counts, and ok / no_match / no_codebook."""
    counts = labels.groupBy("paper_id").agg(
        F.count("*").alias("n_columns"),
        F.count_if(F.col("label_status").isin("labelled", "llm")).alias("n_labelled"),
        F.count_if(F.col("label_status").isin("unlabelled", "no_codebook")).alias("n_unlabelled"),
    )
    size = codebook.groupBy("paper_id").agg(F.count("*").alias("n_vars"))
    n = F.coalesce("n_vars", F.lit(0))
    return (
        attach(counts, size, ["paper_id"])
        .withColumn("n_vars", n)
        .withColumn(
            "status",
            F.when(n == 0, F.lit("no_codebook"))
            .when(F.col("n_labelled") == 0, F.lit("no_match"))
            .otherwise(F.lit("ok")),
        )
    )


def label_coverage(labels: DataFrame, codebook: DataFrame) -> DataFrame:
    """Repository-averaged labelling, for the whole corpus and where a codebook exists."""
    per = labels.groupBy("paper_id").agg(
        F.count("*").alias("n_cols"),
        F.avg((F.col("label_status") == "labelled").cast("double")).alias("strict"),
        F.avg(F.col("label_status").isin("labelled", "conflicting_definition").cast("double")).alias("loose"),
    )
    with_book = codebook.select("paper_id").distinct().withColumn("_book", F.lit(True))
    scopes = F.when(
        F.col("_book"), F.array(F.lit("whole corpus"), F.lit("codebook-corpus"))
    ).otherwise(F.array(F.lit("whole corpus")))
    return (
        attach(per, with_book, ["paper_id"])
        .withColumn("scope", F.explode(scopes))
        .groupBy("scope")
        .agg(
            F.count("*").alias("n_papers"),
            F.sum("n_cols").alias("n_cols"),
            (100 * F.avg("strict")).alias("labelled_pa"),
            (100 * F.avg("loose")).alias("matched_pa"),
        )
    )


def label_rate_by_type(labels: DataFrame, columns: DataFrame) -> DataFrame:
    """Share of labelled columns per column type."""
    typed = attach(labels, columns.select(*COLUMN_KEY, "col_type"), COLUMN_KEY)
    done = F.col("label_status").isin("labelled", "llm")
    return typed.groupBy("col_type").agg(
        F.count("*").alias("n_columns"),
        F.count_if(done).alias("n_labelled"),
        (100.0 * F.avg(done.cast("double"))).alias("pct_labelled"),
    )


def label_methods(labels: DataFrame) -> DataFrame:
    """Columns per repository and label method."""
    return labels.groupBy("paper_id", F.coalesce("label_method", F.lit("none")).alias("method")).agg(
        F.count("*").alias("n_columns")
    )


def type_string(columns: DataFrame) -> DataFrame:
    """``binary:2, continuous:5`` per repository; the type vocabulary bounds its length."""
    return (
        columns.groupBy("paper_id", "col_type")
        .agg(F.count("*").alias("n"))
        .groupBy("paper_id")
        .agg(
            F.array_join(
                F.array_sort(F.collect_list(F.concat_ws(":", "col_type", F.col("n").cast("string")))), ", "
            ).alias("types")
        )
    )


def coverage_share(coverage: DataFrame) -> DataFrame:
    return attach_grand(coverage.groupBy("match_status").agg(F.count("*").alias("n")), total=F.sum("n"))


def documented_columns(columns: DataFrame, labels: DataFrame, structure: DataFrame) -> DataFrame:
    """Columns with their label outcome and the type and group of their file.

    Keyed by position, since names may repeat within a file.
    """
    outcome = labels.select(*COLUMN_KEY, "label", "label_status", "label_method")
    files = structure.select(
        "paper_id",
        F.col("rel_path").alias("source_file"),
        F.col("type").alias("file_type"),
        F.col("group").alias("file_group"),
    )
    return attach(attach(columns, outcome, COLUMN_KEY), files, ["paper_id", "source_file"])
