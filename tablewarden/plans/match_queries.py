"""Queries over dictionary matching and documentation reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.functions import names as NF
from tablewarden.operators import corpus as C
from tablewarden.operators import match as X
from tablewarden.plans.profile_queries import rounded
from tablewarden.plans.views import Family
from tablewarden.session import settle
from tablewarden.sources import export as E

FAMILY = Family()
query = FAMILY.add


def norm(c: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(lower({c})), '_+', ' ', 'g'), "
        f"'\\s+', ' ', 'g'), '^\\.+', ''), '\\.+$', ''))"
    )


def norm_label(c: str) -> str:
    clean = f"trim(regexp_replace(regexp_replace(lower({c}), '[''’‘]s', '', 'g'), '[^a-z0-9 ]', ' ', 'g'))"
    return (
        f"array_to_string(list_transform(list_filter(regexp_split_to_array({clean}, '\\s+'), lambda w: w <> ''), "
        f"lambda w: regexp_replace(w, '^([a-z]{{{{7,}}}})s$', '\\1')), ' ')"
    )


RANGES = r"""
    rg AS (SELECT *, regexp_matches(codebook_variable, '^([A-Za-z]*)\s*([0-9]+)\s*[-–]\s*([0-9]+)$') AS is_range,
      try_cast(regexp_extract(codebook_variable, '^([A-Za-z]*)\s*([0-9]+)\s*[-–]\s*([0-9]+)$', 2) AS BIGINT) AS a,
      try_cast(regexp_extract(codebook_variable, '^([A-Za-z]*)\s*([0-9]+)\s*[-–]\s*([0-9]+)$', 3) AS BIGINT) AS b,
      regexp_extract(codebook_variable, '^([A-Za-z]*)\s*([0-9]+)\s*[-–]\s*([0-9]+)$', 1) AS pre FROM {v_book}),
    able AS (SELECT DISTINCT paper_id FROM rg WHERE is_range AND a <= b),
    book AS (
      SELECT paper_id, codebook_variable, label, codebook_source, "group", parse_method, 0 AS late, ord, 0 AS nr FROM rg
      WHERE NOT is_range OR paper_id NOT IN (SELECT paper_id FROM able)
      UNION ALL
      SELECT paper_id, pre || CAST(nr AS VARCHAR), label, codebook_source, "group", parse_method, 1, ord, nr FROM (
        SELECT *, unnest(range(a, b + 1)) AS nr FROM rg WHERE is_range AND a <= b) q),
    ord_book AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY late, ord, nr) AS o FROM book)"""


@query(
    "expand_ranges",
    f"WITH {RANGES} SELECT paper_id, codebook_variable, label, ord, late FROM book",
)
def expand_ranges(t):
    out = X.expand_ranges(t.v_book)
    return out.select("paper_id", "codebook_variable", "label", F.col("ord.ord").alias("ord"), F.col("ord.late").alias("late"))


def _distinct_list(field: str, rows: str) -> str:
    """Distinct values of a field in first-seen order, joined, per column."""
    return (
        f"(SELECT col_pos, string_agg({field}, ' | ' ORDER BY o) AS {field} FROM "
        f"(SELECT col_pos, {field}, min(o) AS o FROM {rows} GROUP BY col_pos, {field}) q GROUP BY col_pos)"
    )


MATCH = (
    RANGES
    + f""",
    ck AS (SELECT col_pos, paper_id, source_file, column_name, "group", {norm('column_name')} AS nm FROM {{v_cols}}),
    hit AS (SELECT ck.col_pos AS col_pos, b.label AS label, b.codebook_variable AS codebook_variable,
        b.codebook_source AS codebook_source, b.parse_method AS pm, length(b.label) AS len,
        CASE WHEN b."group" IS NULL THEN 0 WHEN b."group" = ck."group" THEN 1 ELSE 2 END AS scope,
        CASE WHEN b."group" IS NULL THEN b.o ELSE b.o + 1000000 END AS o
      FROM ck JOIN ord_book b ON b.paper_id = ck.paper_id AND {norm('b.codebook_variable')} = ck.nm),
    app AS (SELECT * FROM hit WHERE scope < 2), oth AS (SELECT * FROM hit WHERE scope = 2),
    own AS (SELECT * FROM app WHERE pm = 'haven'),
    st AS (SELECT col_pos, count(DISTINCT label) AS labels, count(DISTINCT {norm_label('label')}) AS kinds,
      bool_or(pm = 'haven') AS emb, arg_min(codebook_variable, o) AS v1 FROM app GROUP BY col_pos),
    lo AS (SELECT col_pos, label AS longest FROM (SELECT col_pos, label,
      row_number() OVER (PARTITION BY col_pos ORDER BY len DESC, o) AS k FROM app) q WHERE k = 1),
    ho AS (SELECT col_pos, label AS longest, v1 FROM (SELECT col_pos, label,
      row_number() OVER (PARTITION BY col_pos ORDER BY len DESC, o) AS k,
      first(codebook_variable) OVER (PARTITION BY col_pos ORDER BY o) AS v1 FROM own) q WHERE k = 1),
    kind AS (SELECT ck.*, CASE WHEN st.col_pos IS NULL THEN CASE WHEN ot.col_pos IS NULL THEN 'none' ELSE 'other' END
        WHEN labels <= 1 THEN 'one' WHEN emb THEN 'own' WHEN kinds = 1 THEN 'merged' ELSE 'conflict' END AS kind, st.v1 AS v1
      FROM ck LEFT JOIN st ON st.col_pos = ck.col_pos LEFT JOIN (SELECT DISTINCT col_pos FROM oth) ot ON ot.col_pos = ck.col_pos),
    lab AS (SELECT k.*,
      CASE kind WHEN 'other' THEN ol.label WHEN 'own' THEN ho.longest WHEN 'merged' THEN lo.longest ELSE al.label END AS label,
      CASE kind WHEN 'other' THEN ov.codebook_variable WHEN 'own' THEN ho.v1 WHEN 'conflict' THEN av.codebook_variable ELSE k.v1 END
        AS codebook_variable,
      CASE kind WHEN 'other' THEN os.codebook_source WHEN 'own' THEN hs.codebook_source ELSE asr.codebook_source END AS label_source,
      CASE kind WHEN 'none' THEN 'unlabelled' WHEN 'other' THEN 'ambiguous_experiment' WHEN 'conflict' THEN 'conflicting_definition'
        ELSE 'labelled' END AS label_status,
      CASE kind WHEN 'one' THEN 'rules' WHEN 'own' THEN 'haven_priority' WHEN 'merged' THEN 'merged_rules' END AS label_method
      FROM kind k
      LEFT JOIN {_distinct_list('label', 'app')} al ON al.col_pos = k.col_pos
      LEFT JOIN {_distinct_list('codebook_variable', 'app')} av ON av.col_pos = k.col_pos
      LEFT JOIN {_distinct_list('codebook_source', 'app')} asr ON asr.col_pos = k.col_pos
      LEFT JOIN {_distinct_list('label', 'oth')} ol ON ol.col_pos = k.col_pos
      LEFT JOIN {_distinct_list('codebook_variable', 'oth')} ov ON ov.col_pos = k.col_pos
      LEFT JOIN {_distinct_list('codebook_source', 'oth')} os ON os.col_pos = k.col_pos
      LEFT JOIN {_distinct_list('codebook_source', 'own')} hs ON hs.col_pos = k.col_pos
      LEFT JOIN lo ON lo.col_pos = k.col_pos LEFT JOIN ho ON ho.col_pos = k.col_pos)"""
)


def _labels(t):
    return X.match_labels(t.v_cols.drop("col_type"), t.v_book)


_OUT = "col_pos, label, codebook_variable, label_source, label_status, label_method"


@query("match_labels", f"WITH {MATCH} SELECT {_OUT} FROM lab")
def match_labels(t):
    return X.joined_output(_labels(t)).select(*_OUT.split(", "))


@query(
    "merge_verdicts",
    f"""
    WITH {MATCH},
    v AS (SELECT DISTINCT paper_id, column_name, ascii(right(column_name, 1)) % 2 = 0 AS eq,
      CASE WHEN ascii(right(column_name, 1)) % 4 = 0 THEN '' ELSE 'canonical label' END AS can FROM {{v_cols}})
    SELECT col_pos, CASE WHEN h THEN can ELSE label END AS label, CASE WHEN h THEN 'labelled' ELSE label_status END AS label_status,
      CASE WHEN h THEN 'merged_llm' ELSE label_method END AS label_method
    FROM (SELECT lab.*, can, label_status = 'conflicting_definition' AND eq AND can <> '' AS h FROM lab
      JOIN v ON v.paper_id = lab.paper_id AND v.column_name = lab.column_name) q""",
)
def merge_verdicts(t):
    verdicts = t.v_cols.selectExpr(
        "paper_id", "column_name", "ascii(right(column_name, 1)) % 2 = 0 AS equivalent",
        "CASE WHEN ascii(right(column_name, 1)) % 4 = 0 THEN '' ELSE 'canonical label' END AS canonical",
    ).distinct()
    out = X.joined_output(X.merge_verdicts(_labels(t), verdicts))
    return out.select("col_pos", "label", "label_status", "label_method")


# every column name of a repository is paired with the variable of the same number plus one
_PAIRS = """
    pr AS (SELECT paper_id, column_name, 'Q_' || CAST(CAST(right(column_name, 1) AS INT) - 3 AS VARCHAR) AS var, min(col_pos) AS ord
      FROM {v_cols} GROUP BY paper_id, column_name)"""


@query(
    "second_pass",
    f"""
    WITH {MATCH}, {_PAIRS},
    used AS (SELECT DISTINCT paper_id, {norm('codebook_variable')} AS var FROM lab WHERE label_status = 'labelled'),
    bk AS (SELECT *, {norm('codebook_variable')} AS nv FROM ord_book),
    fr AS (SELECT bk.paper_id AS paper_id, nv, arg_min(label, o) AS label, arg_min(codebook_variable, o) AS v,
        arg_min(codebook_source, o) AS src FROM bk
      LEFT JOIN used ON used.paper_id = bk.paper_id AND used.var = nv WHERE used.var IS NULL GROUP BY bk.paper_id, nv),
    ch AS (SELECT p.paper_id AS paper_id, {norm('p.column_name')} AS nm, arg_min(fr.label, p.ord) AS label, arg_min(fr.v, p.ord) AS v,
        arg_min(fr.src, p.ord) AS src FROM pr p
      JOIN fr ON fr.paper_id = p.paper_id AND fr.nv = {norm('p.var')} GROUP BY 1, 2)
    SELECT col_pos, CASE WHEN h THEN chl ELSE label END AS label, CASE WHEN h THEN v ELSE codebook_variable END AS codebook_variable,
      CASE WHEN h THEN src ELSE label_source END AS label_source, CASE WHEN h THEN 'llm' ELSE label_status END AS label_status,
      CASE WHEN h THEN 'llm' ELSE label_method END AS label_method
    FROM (SELECT lab.*, ch.label AS chl, ch.v AS v, ch.src AS src, ch.v IS NOT NULL AND label_status = 'unlabelled' AS h FROM lab
      LEFT JOIN ch ON ch.paper_id = lab.paper_id AND ch.nm = lab.nm) q""",
)
def second_pass(t):
    pairs = (
        t.v_cols.groupBy("paper_id", "column_name")
        .agg(F.min("col_pos").alias("ord"))
        .withColumn("codebook_variable", F.expr("'Q_' || CAST(CAST(right(column_name, 1) AS INT) - 3 AS STRING)"))
    )
    return X.joined_output(X.second_pass(settle(_labels(t)), t.v_book, pairs)).select(*_OUT.split(", "))


COVERAGE = (
    MATCH
    + f""",
    us AS (SELECT DISTINCT paper_id, {norm('codebook_variable')} AS nv FROM lab WHERE label_status IN ('labelled', 'llm')),
    cov AS (SELECT b.*, CASE WHEN us.nv IS NULL THEN 'unmatched_in_data' ELSE 'matched' END AS match_status FROM {{v_book}} b
      LEFT JOIN us ON us.paper_id = b.paper_id AND us.nv = {norm('b.codebook_variable')})"""
)


def _coverage(t, labels=None):
    return X.codebook_coverage(t.v_book, labels or _labels(t))


@query("coverage", f"WITH {COVERAGE} SELECT paper_id, ord, codebook_variable, match_status FROM cov")
def coverage(t):
    return _coverage(t).select("paper_id", "ord", "codebook_variable", "match_status")


@query(
    "labelling_status",
    f"""
    WITH {MATCH}
    SELECT l.paper_id AS paper_id, n_columns, n_labelled, n_unlabelled, coalesce(n, 0) AS n_vars,
      CASE WHEN coalesce(n, 0) = 0 THEN 'no_codebook' WHEN n_labelled = 0 THEN 'no_match' ELSE 'ok' END AS status
    FROM (SELECT paper_id, count(*) AS n_columns, count(*) FILTER (WHERE label_status = 'labelled') AS n_labelled,
      count(*) FILTER (WHERE label_status = 'unlabelled') AS n_unlabelled FROM lab GROUP BY paper_id) l
    LEFT JOIN (SELECT paper_id, count(*) AS n FROM {{v_book}} GROUP BY paper_id) b ON b.paper_id = l.paper_id""",
)
def labelling_status(t):
    return X.labelling_status(_labels(t), t.v_book)


@query(
    "merge_dictionaries",
    f"""
    WITH s AS (SELECT *, CASE WHEN parse_method = 'haven' THEN 0 ELSE 1 END AS src, {norm('codebook_variable')} AS nv FROM {{v_book}}),
    r AS (SELECT *, row_number() OVER (PARTITION BY paper_id, nv, label, "group" ORDER BY src, ord) AS k FROM s)
    SELECT paper_id, ord, codebook_variable, label, parse_method FROM r WHERE k = 1""",
)
def merge_dictionaries(t):
    book = t.v_book
    both = X.merge_dictionaries(book.where("parse_method = 'haven'"), book.where("parse_method <> 'haven'"))
    return both.select("paper_id", F.col("ord.ord").alias("ord"), "codebook_variable", "label", "parse_method")


@query(
    "label_coverage",
    f"""
    WITH {MATCH},
    p AS (SELECT paper_id, count(*) AS n, avg(CASE WHEN label_status = 'labelled' THEN 1.0 ELSE 0.0 END) AS s,
      avg(CASE WHEN label_status IN ('labelled', 'conflicting_definition') THEN 1.0 ELSE 0.0 END) AS l FROM lab GROUP BY paper_id)
    SELECT 'whole corpus' AS scope, count(*) AS n_papers, CAST(sum(n) AS BIGINT) AS n_cols, round(100 * avg(s), 6) AS labelled_pa,
      round(100 * avg(l), 6) AS matched_pa FROM p
    UNION ALL
    SELECT 'codebook-corpus', count(*), CAST(sum(n) AS BIGINT), round(100 * avg(s), 6), round(100 * avg(l), 6) FROM p
    WHERE paper_id IN (SELECT paper_id FROM {{v_book}}) HAVING count(*) > 0""",
)
def label_coverage(t):
    return rounded(X.label_coverage(_labels(t), t.v_book))


@query(
    "provenance",
    f"""
    WITH {COVERAGE}, o AS (SELECT CASE WHEN parse_method = 'haven' THEN 'haven-embedded'
        WHEN lower(codebook_source) LIKE '%readme%' THEN 'README' ELSE 'structured file' END AS origin, paper_id, match_status FROM cov),
    u AS (SELECT * FROM o UNION ALL SELECT 'ALL', paper_id, match_status FROM o)
    SELECT origin, count(*) AS parsed_vars, count(*) FILTER (WHERE match_status = 'matched') AS matched,
      round(100.0 * count(*) FILTER (WHERE match_status = 'matched') / count(*), 6) AS match_rate, count(DISTINCT paper_id) AS n_repos
    FROM u GROUP BY origin""",
)
def provenance(t):
    return rounded(C.codebook_provenance(_coverage(t)))


_MEASURES = {
    "label_len": "length(label)",
    "name_len": "length(codebook_variable)",
    "len_gain": "length(label) - length(codebook_variable)",
    "edit_dist": "levenshtein(lower(label), lower(codebook_variable))",
}


@query(
    "label_quality",
    """
    WITH h AS (SELECT * FROM {v_book} WHERE parse_method = 'haven'),
    x AS ("""
    + " UNION ALL ".join(f"SELECT paper_id, ord, '{m}' AS measure, {e} AS v FROM h" for m, e in _MEASURES.items())
    + r"""),
    c AS (SELECT paper_id, measure, v, count(*) AS n, min(ord) AS o FROM x GROUP BY 1, 2, 3),
    md AS (SELECT paper_id, measure, v AS mode FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, measure ORDER BY n DESC, o) AS k
      FROM c) q WHERE k = 1),
    p AS (SELECT paper_id, measure, avg(v) AS mean, median(v) AS median FROM x GROUP BY 1, 2),
    i AS (SELECT paper_id, count(*) AS n, avg(CASE WHEN regexp_replace(lower(trim(label)), '[^a-z0-9]', '', 'g') NOT IN
      ('', regexp_replace(lower(trim(codebook_variable)), '[^a-z0-9]', '', 'g')) THEN 1.0 ELSE 0.0 END) AS f FROM h GROUP BY 1)
    SELECT p.measure AS measure, round(avg(mean), 6) AS mean_pa, round(avg(median), 6) AS median_pa, round(avg(mode), 6) AS mode_pa,
      (SELECT round(100.0 * avg(f), 6) FROM i) AS informative_pa, (SELECT CAST(sum(n) AS BIGINT) FROM i) AS n_vars,
      (SELECT count(*) FROM i) AS n_repos
    FROM p JOIN md ON md.paper_id = p.paper_id AND md.measure = p.measure GROUP BY p.measure""",
)
def label_quality(t):
    return rounded(C.embedded_label_quality(t.v_book))


@query(
    "label_rate_by_type",
    f"""
    WITH {MATCH}
    SELECT c.col_type AS col_type, count(*) AS n_columns, count(*) FILTER (WHERE label_status = 'labelled') AS n_labelled,
      round(100.0 * count(*) FILTER (WHERE label_status = 'labelled') / count(*), 6) AS pct_labelled
    FROM lab JOIN {{v_cols}} c ON c.col_pos = lab.col_pos GROUP BY c.col_type""",
)
def label_rate_by_type(t):
    return rounded(X.label_rate_by_type(_labels(t), t.v_cols))


@query(
    "label_methods",
    f"""
    WITH {MATCH}
    SELECT paper_id, coalesce(label_method, 'none') AS method, count(*) AS n_columns FROM lab GROUP BY 1, 2""",
)
def label_methods(t):
    return X.label_methods(_labels(t))


@query(
    "type_string",
    """
    SELECT paper_id, string_agg(col_type || ':' || CAST(n AS VARCHAR), ', ' ORDER BY col_type || ':' || CAST(n AS VARCHAR)) AS types
    FROM (SELECT paper_id, col_type, count(*) AS n FROM {v_cols} GROUP BY 1, 2) q GROUP BY paper_id""",
)
def type_string(t):
    return X.type_string(t.v_cols)


@query(
    "coverage_distribution",
    f"""
    WITH {COVERAGE}, p AS (SELECT paper_id, 100.0 * count(*) FILTER (WHERE match_status = 'matched') / count(*) AS p FROM cov GROUP BY paper_id)
    SELECT count(*) AS n_repos, round(avg(p), 6) AS mean, round(min(p), 6) AS min, round(max(p), 6) AS max,
      count(*) FILTER (WHERE p = 100) AS n_full, count(*) FILTER (WHERE p = 0) AS n_none, round(median(p), 6) AS median FROM p""",
)
def coverage_distribution(t):
    return rounded(C.coverage_distribution(settle(C.coverage_per_repository(_coverage(t)))))


@query(
    "lowest_coverage",
    f"""
    WITH {COVERAGE}
    SELECT paper_id, count(*) AS n_vars, count(*) FILTER (WHERE match_status = 'matched') AS n_matched,
      round(100.0 * count(*) FILTER (WHERE match_status = 'matched') / count(*), 6) AS pct_matched
    FROM cov GROUP BY paper_id ORDER BY pct_matched, paper_id LIMIT 10""",
)
def lowest_coverage(t):
    return rounded(C.lowest_coverage(C.coverage_per_repository(_coverage(t)), 10))


_STRUCT = """
    str AS (SELECT 'p' || CAST(user_id AS VARCHAR) AS paper_id, bool_or(event_id % 90 = 0) AS readme,
      count(*) FILTER (WHERE event_id % 40 = 1) AS books FROM {events} GROUP BY 1)"""


def _structure(t):
    return t.events.selectExpr(
        "'p' || CAST(user_id AS STRING) AS paper_id",
        "CASE WHEN event_id % 90 = 0 THEN 'readme' WHEN event_id % 40 = 1 THEN 'codebook' ELSE 'data' END AS type",
    )


@query(
    "health_checks",
    f"""
    WITH {COVERAGE}, {_STRUCT},
    lb AS (SELECT paper_id, count(*) AS n, count(*) FILTER (WHERE label_status = 'labelled') AS k,
      coalesce(bool_or(label_method = 'haven_priority'), false) AS emb FROM lab GROUP BY 1),
    cv AS (SELECT paper_id, count(*) AS n, count(*) FILTER (WHERE match_status = 'matched') AS k,
      bool_or(parse_method IN ('structured', 'haven')) AS mach FROM cov GROUP BY 1),
    f AS (SELECT str.*, lb.n AS ln, lb.k AS lk, lb.emb AS emb, cv.n AS cn, cv.k AS ck, cv.mach AS mach FROM str
      LEFT JOIN lb ON lb.paper_id = str.paper_id LEFT JOIN cv ON cv.paper_id = str.paper_id)
    SELECT paper_id, 'readme' AS indicator, CASE WHEN readme THEN 'good' ELSE 'warn' END AS state FROM f UNION ALL
    SELECT paper_id, 'codebook', CASE WHEN books > 0 THEN 'good' ELSE 'warn' END FROM f UNION ALL
    SELECT paper_id, 'machine_readable', CASE WHEN coalesce(mach, false) THEN 'good' ELSE 'info' END FROM f WHERE books > 0 UNION ALL
    SELECT paper_id, 'embedded_labels', 'good' FROM f WHERE emb UNION ALL
    SELECT paper_id, 'columns_documented', CASE WHEN lk = ln THEN 'good' ELSE 'warn' END FROM f WHERE ln > 0 UNION ALL
    SELECT paper_id, 'variables_found', CASE WHEN ck = cn THEN 'good' ELSE 'warn' END FROM f WHERE cn > 0""",
)
def health_checks(t):
    labels = settle(_labels(t))
    return C.health_checks(_structure(t), labels, _coverage(t, labels))


@query(
    "health_score",
    f"""
    WITH {COVERAGE}, {_STRUCT},
    lb AS (SELECT paper_id, count(*) FILTER (WHERE label_status <> 'labelled') = 0 AS k,
      coalesce(bool_or(label_method = 'haven_priority'), false) AS emb FROM lab GROUP BY 1),
    cv AS (SELECT paper_id, count(*) FILTER (WHERE match_status <> 'matched') = 0 AS k,
      bool_or(parse_method IN ('structured', 'haven')) AS mach FROM cov GROUP BY 1)
    SELECT str.paper_id AS paper_id,
      CAST(CAST(readme AS BIGINT) + CAST(books > 0 AS BIGINT) + CAST(books > 0 AND coalesce(mach, false) AS BIGINT)
        + CAST(coalesce(emb, false) AS BIGINT) + CAST(coalesce(lb.k, false) AS BIGINT) + CAST(coalesce(cv.k, false) AS BIGINT) AS BIGINT) AS n_good,
      CAST(2 + CAST(books > 0 AS BIGINT) + CAST(coalesce(emb, false) AS BIGINT) + CAST(lb.k IS NOT NULL AS BIGINT)
        + CAST(cv.k IS NOT NULL AS BIGINT) AS BIGINT) AS n_checks
    FROM str LEFT JOIN lb ON lb.paper_id = str.paper_id LEFT JOIN cv ON cv.paper_id = str.paper_id""",
)
def health_score(t):
    labels = settle(_labels(t))
    return C.health_score(C.health_checks(_structure(t), labels, _coverage(t, labels)))


@query(
    "codebook_tiles",
    f"""
    WITH {COVERAGE}, {_STRUCT},
    lb AS (SELECT paper_id, count(*) AS n, count(*) FILTER (WHERE label_status = 'labelled') AS k FROM lab GROUP BY 1),
    cv AS (SELECT paper_id, count(*) AS n, count(*) FILTER (WHERE match_status = 'matched') AS k FROM cov GROUP BY 1)
    SELECT str.paper_id AS paper_id, books AS n_codebook_files, coalesce(lb.n, 0) AS n_columns, coalesce(lb.k, 0) AS n_labelled,
      coalesce(cv.n, 0) AS n_variables, coalesce(cv.k, 0) AS n_matched, coalesce(cv.n - cv.k, 0) AS n_unmatched,
      round(100.0 * lb.k / lb.n, 6) AS pct_labelled, round(100.0 * cv.k / cv.n, 6) AS pct_matched,
      books > 0 AND coalesce(cv.n, 0) = 0 AS unparsed_codebook
    FROM str LEFT JOIN lb ON lb.paper_id = str.paper_id LEFT JOIN cv ON cv.paper_id = str.paper_id""",
)
def codebook_tiles(t):
    labels = settle(_labels(t))
    return rounded(C.codebook_tiles(_structure(t), labels, _coverage(t, labels)))


@query(
    "normalize_names",
    f"""
    SELECT p_partkey, {norm("'.' || p_brand || '__' || p_name || ' .'")} AS var_norm,
      {norm_label("p_name || '''s ' || p_type || ' (labelings)'")} AS label_norm FROM {{part}}""",
)
def normalize_names(t):
    return t.part.select(
        "p_partkey",
        NF.normalize_variable(F.expr("'.' || p_brand || '__' || p_name || ' .'")).alias("var_norm"),
        NF.normalize_label(F.expr("p_name || '\\'s ' || p_type || ' (labelings)'")).alias("label_norm"),
    )


@query("stemmed_labels")
def stemmed_labels(t):
    labels = t.part.select("p_partkey", F.expr("p_name || '\\'s ' || p_type || ' relational'").alias("label"))
    return NF.with_stemmed_label(labels, "label", "stemmed").select("p_partkey", "stemmed")


@query("dataset_json")
def dataset_json(t):
    cols = t.v_cols.withColumns(
        {s: F.lit(1.0) for s in ["mean", "sd", "se", "median", "min", "max", "p25", "p75", "iqr", "skewness", "kurtosis"]}
    ).withColumns({"n": F.lit(10), "n_missing": F.lit(0), "sample_values": F.lit("a | b | a")})
    labels = settle(_labels(t))
    return E.dataset_lines(settle(E.property_values(cols, labels, _coverage(t, labels))))


@query("sidecar_json")
def sidecar_json(t):
    files = t.v_scored.where("type_gt = 'data'").withColumns(
        {"method": F.lit("csv_copy"), "export_name": F.concat(F.lit("source-f"), F.col("ord").cast("string"), F.lit("_data.csv"))}
    )
    return E.sidecar_json(files)


@query("provenance_json")
def provenance_json(t):
    files = t.v_scored.withColumns(
        {
            "export_name": F.concat(F.lit("data/f"), F.col("ord").cast("string")),
            "ground_truth_validated": F.col("ord") % 3 == 0,
            "validated_at": F.lit("2026-01-01"),
            "annotator": F.lit("a"),
        }
    )
    return E.provenance_json(files)
