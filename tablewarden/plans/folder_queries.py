"""Queries over file listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.functions import paths as PF
from tablewarden.operators import answers as A
from tablewarden.operators import folders as D
from tablewarden.operators.scale import attach
from tablewarden.plans.profile_queries import rounded
from tablewarden.plans.views import Family
from tablewarden.sources import files as S

FAMILY = Family()
query = FAMILY.add

PERSON = (
    r"'^\d+$|^sub\d+|^subj\d+|^s\d{{2,}}$|^p\d+|^id\d+|^participant[\s_-]?\d+|^pp\d+|^vp\d+'"
)
DIR = r"regexp_extract(rel_path, '^(.*)/[^/]*$', 1)"
# folders above a file, outermost first
ANCESTORS = f"""
    anc AS (SELECT paper_id, rel_path, array_to_string(list_slice(parts, 1, i), '/') AS dir FROM (
      SELECT paper_id, rel_path, parts, unnest(range(1, len(parts))) AS i FROM (
        SELECT paper_id, rel_path, string_split(rel_path, '/') AS parts FROM {{v_files}}) a) b)"""


@query(
    "path_parts",
    r"""
    SELECT ord, rel_path, regexp_extract(rel_path, '[^/]*$', 0) AS filename,
      regexp_extract(rel_path, '^(.*)/[^/]*$', 1) AS folder,
      lower(regexp_extract(rel_path, '\.([A-Za-z0-9]+)$', 1)) AS ext,
      CASE WHEN ext IN ('mat', 'pdf') THEN 'raw' ELSE 'tabular' END AS data_format,
      regexp_matches(lower(split_part(regexp_extract(rel_path, '[^/]*$', 0), '.', 1)), """
    + PERSON
    + r""") AS is_participant,
      CASE WHEN paper_id LIKE 'doi_%' THEN 'dataverse' ELSE 'osf' END AS host,
      '/data/osf/' || paper_id || '/' || rel_path AS full_path
    FROM {v_files}""",
)
def path_parts(t):
    path = F.col("rel_path")
    return t.v_files.select(
        "ord",
        "rel_path",
        PF.basename(path).alias("filename"),
        PF.dirname(path).alias("folder"),
        PF.ext(path).alias("ext"),
        PF.data_format(PF.ext(path)).alias("data_format"),
        PF.is_participant_id(PF.stem(path)).alias("is_participant"),
        PF.repository_host(F.col("paper_id")).alias("host"),
        PF.rebuild_path("/data", F.lit("osf"), F.col("paper_id"), path).alias("full_path"),
    )


@query(
    "dedup_files",
    """
    WITH f AS (SELECT source AS paper_id, doc_id AS ord, lang || CASE WHEN doc_id % 2 = 0 THEN '.csv' ELSE '.bin' END AS name,
      n_chars AS size, coalesce(array_to_string(list_slice(string_split(text, chr(10)), 1, 3), chr(10)), '') AS fingerprint FROM {documents}),
    r AS (SELECT *, row_number() OVER (PARTITION BY paper_id, name, size,
      CASE WHEN name LIKE '%.csv' THEN fingerprint ELSE '' END ORDER BY ord) AS k FROM f)
    SELECT paper_id, ord, name AS rel_path, size FROM r WHERE k = 1""",
)
def dedup_files(t):
    """Documents as files: text tables must agree in their first three lines, others in name and size."""
    files = t.documents.selectExpr(
        "source AS paper_id", "doc_id AS ord", "lang || CASE WHEN doc_id % 2 = 0 THEN '.csv' ELSE '.bin' END AS rel_path", "n_chars AS size"
    )
    lines = t.documents.select(F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("ord", "line"))
    prints = S.first_lines(lines).withColumnRenamed("file", "ord")
    return D.drop_duplicates(attach(files, prints, ["ord"])).drop("fingerprint")


@query(
    "duplicate_members",
    """
    SELECT page_id, url FROM {pages} WHERE regexp_extract(url, '^https?://([^/]+)', 1) IN (
      SELECT regexp_extract(url, '^https?://([^/]+)', 1) FROM {pages} GROUP BY 1 HAVING count(*) > 1)""",
)
def duplicate_members(t):
    pages = t.pages.select("page_id", "url", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))
    return D.duplicate_members(pages, ["host"]).select("page_id", "url")


@query(
    "software_folders",
    f"""
    WITH {ANCESTORS},
    tool AS (SELECT paper_id, rel_path, arg_min(dir, length(dir)) AS dir FROM anc
      WHERE lower(regexp_extract(dir, '[^/]*$', 0)) IN ('node_modules', 'renv', 'venv', '.git') GROUP BY paper_id, rel_path),
    cand AS (SELECT anc.* FROM anc LEFT JOIN tool USING (paper_id, rel_path) WHERE tool.dir IS NULL
      AND lower(regexp_extract(anc.dir, '[^/]*$', 0)) IN ('lib', 'libs', 'src', 'build', 'dist', 'vendor')),
    ok AS (SELECT paper_id, dir FROM cand GROUP BY paper_id, dir HAVING count(*) >= 5
      AND avg(CASE WHEN lower(regexp_extract(rel_path, '[^.]*$', 0)) IN
        ('csv', 'tsv', 'txt', 'dat', 'xlsx', 'xls', 'sav', 'dta', 'sas7bdat', 'rds', 'rda', 'rdata') THEN 1.0 ELSE 0.0 END) <= 0.5),
    build AS (SELECT paper_id, rel_path, arg_min(dir, length(dir)) AS dir FROM cand SEMI JOIN ok USING (paper_id, dir)
      GROUP BY paper_id, rel_path)
    SELECT f.paper_id AS paper_id, f.rel_path AS rel_path, coalesce(tool.dir, build.dir) AS software_folder
    FROM {{v_files}} f LEFT JOIN tool ON tool.paper_id = f.paper_id AND tool.rel_path = f.rel_path
    LEFT JOIN build ON build.paper_id = f.paper_id AND build.rel_path = f.rel_path""",
)
def software_folders(t):
    files = t.v_files.select("paper_id", "rel_path")
    return D.software_folders(files, min_files=5).select("paper_id", "rel_path", "software_folder")


@query(
    "flat_aggregates",
    f"""
    SELECT paper_id, {DIR} AS folder, count(*) AS n_files FROM {{v_files}} GROUP BY paper_id, {DIR} HAVING count(*) > 5""",
)
def flat_aggregates(t):
    return D.flat_aggregates(t.v_files, limit=5)


PEOPLE = f"""
    people AS (SELECT paper_id, regexp_extract(dir, '^(.*)/[^/]*$', 1) AS folder, count(DISTINCT dir) AS n_children FROM anc
      WHERE contains(dir, '/') AND regexp_matches(lower(regexp_extract(dir, '[^/]*$', 0)), {PERSON})
      GROUP BY 1, 2 HAVING count(DISTINCT dir) > 2)"""


@query("participant_aggregates", f"WITH {ANCESTORS}, {PEOPLE} SELECT * FROM people")
def participant_aggregates(t):
    return D.participant_aggregates(t.v_files, limit=2)


ASSIGNED = f"""
    flat AS (SELECT paper_id, {DIR} AS folder FROM {{v_files}} GROUP BY 1, 2 HAVING count(*) > 2),
    under AS (SELECT anc.paper_id AS paper_id, anc.rel_path AS rel_path, arg_min(dir, length(dir)) AS dir FROM anc
      JOIN people ON people.paper_id = anc.paper_id AND people.folder = anc.dir GROUP BY 1, 2),
    assigned AS (SELECT f.paper_id AS paper_id, f.rel_path AS rel_path, f.ext AS ext,
        coalesce(under.dir, flat.folder) AS folder, under.dir IS NOT NULL AS by_participant
      FROM {{v_files}} f LEFT JOIN under ON under.paper_id = f.paper_id AND under.rel_path = f.rel_path
      LEFT JOIN flat ON flat.paper_id = f.paper_id AND flat.folder = {DIR.replace('rel_path', 'f.rel_path')})"""


def _assigned(t):
    return D.assign_aggregate_folder(t.v_files.drop("aggregate_folder"), limit=2)


@query(
    "even_sample",
    f"""
    WITH {ANCESTORS}, {PEOPLE}, {ASSIGNED},
    s AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY paper_id, folder, ext) AS n,
        regexp_matches(lower(regexp_extract({DIR}, '[^/]*$', 0)), {PERSON}) AS person
      FROM assigned WHERE folder IS NOT NULL WINDOW w AS (PARTITION BY paper_id, folder, ext ORDER BY rel_path)),
    z AS (SELECT *, n <= 3 OR k IN (1, round_even(1 + (n - 1) / 2, 0), n) AS hit FROM s)
    SELECT paper_id, folder AS aggregate_folder, ext, count(*) AS n_members,
      bool_or(by_participant) AND avg(CASE WHEN person THEN 1.0 ELSE 0.0 END) > 0.5 AS is_series,
      string_agg(rel_path, ',' ORDER BY rel_path) FILTER (WHERE hit) AS samples, count(*) < 4 AS route_individually
    FROM z GROUP BY paper_id, folder, ext""",
)
def even_sample(t):
    groups = D.extension_groups(_assigned(t), route_below=4, samples=3)
    return groups.withColumn("samples", F.array_join("sample_paths", ",")).drop("sample_paths")


TEMPLATE = r"regexp_replace(regexp_replace(regexp_extract(rel_path, '[^/]*$', 0), '\.[A-Za-z0-9]+$', ''), '[0-9]+', 'NUM', 'g')"


@query(
    "filename_patterns",
    f"""
    WITH r AS (SELECT paper_id, {DIR} AS folder, {TEMPLATE} AS template, ext, regexp_extract(rel_path, '[^/]*$', 0) AS name
      FROM {{v_files}}),
    n AS (SELECT *, row_number() OVER (PARTITION BY paper_id, folder, template, ext ORDER BY name) AS k FROM r)
    SELECT paper_id, folder, template, ext, count(*) AS n_files,
      string_agg(name, ',' ORDER BY name) FILTER (WHERE k <= 3) AS examples,
      '^' || replace(template, 'NUM', '[0-9]+') || '\\.' || ext || '$' AS pattern
    FROM n GROUP BY paper_id, folder, template, ext HAVING count(*) >= 3""",
)
def filename_patterns(t):
    return D.filename_patterns(t.v_files, min_files=3).withColumn("examples", F.array_join("examples", ","))


@query(
    "granularity",
    f"""
    WITH b AS (SELECT paper_id, rel_path, type_gt AS type, aggregate_folder AS folder, k, {TEMPLATE} AS tpl, ext,
        regexp_matches(lower(regexp_replace(regexp_extract(rel_path, '[^/]*$', 0), '\\.[A-Za-z0-9]+$', '')), {PERSON}) AS person,
        regexp_matches(lower(regexp_extract({DIR}, '[^/]*$', 0)), {PERSON}) AS pdir,
        regexp_extract({DIR}, '[^/]*$', 0) AS dname,
        aggregate_folder IS NOT NULL AND k = 6 AS series FROM {{v_files}}),
    c AS (SELECT *, type = 'data' AS d, folder IS NOT NULL AS mem FROM b),
    m AS (SELECT paper_id, folder, avg(CASE WHEN pdir THEN 1.0 ELSE 0.0 END) > 0.5 AS ppl FROM (
      SELECT DISTINCT paper_id, folder, dname, pdir FROM c WHERE d AND mem) q GROUP BY paper_id, folder),
    v AS (SELECT DISTINCT paper_id, folder, CASE WHEN folder = 'logs' THEN 'individual' END AS verdict FROM c WHERE mem),
    g AS (SELECT c.*, CASE WHEN NOT d THEN NULL WHEN mem THEN
          CASE WHEN m.ppl THEN 'individual' WHEN v.verdict IS NOT NULL THEN v.verdict WHEN series THEN 'individual' ELSE 'combined' END
          WHEN person THEN 'individual' ELSE 'combined' END AS gran,
        CASE WHEN NOT d THEN NULL WHEN mem THEN
          CASE WHEN m.ppl THEN 'folder_name_heuristic' WHEN v.verdict IS NOT NULL THEN 'llm' ELSE 'folder_heuristic' END
          WHEN person THEN 'filename_heuristic' ELSE 'default_combined' END AS src
      FROM c LEFT JOIN m ON m.paper_id = c.paper_id AND m.folder = c.folder
      LEFT JOIN v ON v.paper_id = c.paper_id AND v.folder = c.folder),
    l AS (SELECT DISTINCT paper_id, tpl, ext FROM (SELECT paper_id, folder, tpl, ext FROM g WHERE src = 'llm' AND gran = 'individual'
      GROUP BY paper_id, folder, tpl, ext HAVING count(*) >= 2) q)
    SELECT g.paper_id AS paper_id, g.rel_path AS rel_path,
      CASE WHEN l.tpl IS NOT NULL AND NOT mem AND d AND gran <> 'individual' THEN 'individual' ELSE gran END AS data_granularity,
      CASE WHEN l.tpl IS NOT NULL AND NOT mem AND d AND gran <> 'individual' THEN 'llm_pattern_inference' ELSE src END
        AS granularity_source
    FROM g LEFT JOIN l ON l.paper_id = g.paper_id AND l.tpl = g.tpl AND l.ext = g.ext""",
)
def granularity(t):
    files = t.v_files.withColumn("type", F.col("type_gt")).withColumn(
        "is_series", F.col("aggregate_folder").isNotNull() & (F.col("k") == 6)
    )
    verdicts = (
        files.where(F.col("aggregate_folder").isNotNull())
        .select("paper_id", "aggregate_folder")
        .distinct()
        .withColumn("verdict", F.when(F.col("aggregate_folder") == "logs", F.lit("individual")))
    )
    out = D.granularity(files, verdicts, min_files=2)
    return out.select("paper_id", "rel_path", "data_granularity", "granularity_source")


_START = """SELECT ord, paper_id, rel_path, ext, CASE WHEN ord % 5 = 0 THEN 'other' ELSE type_gt END AS type,
      'llm' AS type_source, 'tabular' AS data_format FROM {v_files}"""


def _start(t):
    return t.v_files.selectExpr(
        "ord", "paper_id", "rel_path", "ext", "CASE WHEN ord % 5 = 0 THEN 'other' ELSE type_gt END AS type",
        "'llm' AS type_source", "'tabular' AS data_format",
    )


@query(
    "ext_rules",
    f"""
    WITH s AS ({_START}), h AS (SELECT *, ext = 'r' AND type <> 'code' AS hit FROM s)
    SELECT ord, CASE WHEN hit THEN 'code' ELSE type END AS type, CASE WHEN hit THEN 'fixed_ext_rule' ELSE type_source END AS type_source,
      CASE WHEN NOT hit THEN data_format END AS data_format FROM h""",
)
def ext_rules(t):
    return D.apply_extension_rules(_start(t)).select("ord", "type", "type_source", "data_format")


@query(
    "readme_rule",
    """
    WITH s AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'README' WHEN doc_id % 4 = 1 THEN 'readme.txt'
        WHEN doc_id % 4 = 2 THEN 'read_me.txt' ELSE 'readmefirst' END AS name FROM {documents})
    SELECT doc_id AS ord, CASE WHEN doc_id % 4 < 2 THEN 'readme' ELSE 'other' END AS type,
      CASE WHEN doc_id % 4 < 2 THEN 'fixed_filename_rule' ELSE 'llm' END AS type_source FROM s""",
)
def readme_rule(t):
    name = (
        "'docs/' || CASE doc_id % 4 WHEN 0 THEN 'README' WHEN 1 THEN 'readme.txt' WHEN 2 THEN 'read_me.txt' "
        "ELSE 'readmefirst' END AS rel_path"
    )
    files = t.documents.selectExpr(
        "doc_id AS ord", name, "'other' AS type", "'llm' AS type_source", "CAST(NULL AS STRING) AS data_format"
    )
    return D.apply_readme_rule(files).select("ord", "type", "type_source")


@query(
    "pair_rule",
    """
    WITH f AS (SELECT event_id AS ord, 'p' || CAST(user_id AS VARCHAR) AS paper_id,
      'doc' || CAST(event_id % 20 AS VARCHAR) AS stem,
      CASE event_type WHEN 'click' THEN 'pdf' WHEN 'error' THEN 'rmd' WHEN 'view' THEN 'tex' ELSE 'txt' END AS ext FROM {events}),
    b AS (SELECT paper_id, stem FROM f GROUP BY paper_id, stem
      HAVING bool_or(ext = 'pdf') AND bool_or(ext IN ('rmd', 'qmd', 'tex')))
    SELECT ord, CASE WHEN b.stem IS NULL OR ext = 'txt' THEN 'supplemental' WHEN ext = 'pdf' THEN 'output' ELSE 'code' END AS type,
      CASE WHEN b.stem IS NULL OR ext = 'txt' THEN 'llm' ELSE 'rmd_pair_rule' END AS type_source
    FROM f LEFT JOIN b ON b.paper_id = f.paper_id AND b.stem = f.stem""",
)
def pair_rule(t):
    files = t.events.selectExpr(
        "event_id AS ord",
        "'p' || CAST(user_id AS STRING) AS paper_id",
        "CASE event_type WHEN 'click' THEN 'pdf' WHEN 'error' THEN 'rmd' WHEN 'view' THEN 'tex' ELSE 'txt' END AS ext",
    ).selectExpr(
        "*", "'a/doc' || CAST(ord % 20 AS STRING) || '.' || ext AS rel_path", "'supplemental' AS type",
        "'llm' AS type_source", "'tabular' AS data_format",
    )
    return D.apply_pair_rule(files).select("ord", "type", "type_source")


@query(
    "resolve_shared",
    f"""
    WITH d AS (SELECT paper_id, {DIR} AS folder, min("group") FILTER (WHERE "group" <> 'shared') AS lo,
      max("group") FILTER (WHERE "group" <> 'shared') AS hi FROM {{v_files}} GROUP BY 1, 2)
    SELECT f.ord AS ord, CASE WHEN f."group" = 'shared' AND lo = hi THEN lo ELSE f."group" END AS "group"
    FROM {{v_files}} f JOIN d ON d.paper_id = f.paper_id AND d.folder = {DIR.replace('rel_path', 'f.rel_path')}""",
)
def resolve_shared(t):
    return D.resolve_shared(t.v_files.select("ord", "paper_id", "rel_path", "group")).select("ord", "group")


TYPES = ["asset", "code", "codebook", "data", "supplemental"]


@query(
    "inventory_crosstab",
    'SELECT "group", CASE WHEN "group" LIKE \'ex%\' THEN 1 WHEN "group" LIKE \'pilot%\' THEN 2 ELSE 3 END AS group_rank, '
    + ", ".join(f"count(*) FILTER (WHERE type_gt = '{c}') AS {c}" for c in TYPES)
    + ' FROM {v_files} GROUP BY "group"',
)
def inventory_crosstab(t):
    return D.inventory_crosstab(t.v_files.withColumnRenamed("type_gt", "type"), TYPES)


@query(
    "study_layout",
    """
    WITH s AS (SELECT paper_id, count(DISTINCT "group") AS st FROM {v_files} WHERE type_gt = 'data' AND "group" <> 'shared'
      GROUP BY paper_id)
    SELECT f.ord AS ord, coalesce(st, 0) AS n_studies,
      CASE WHEN coalesce(st, 0) <= 1 THEN f.paper_id ELSE f.paper_id || '/' || "group" END AS output_folder
    FROM {v_files} f LEFT JOIN s ON s.paper_id = f.paper_id""",
)
def study_layout(t):
    files = t.v_files.withColumnRenamed("type_gt", "type").select("ord", "paper_id", "type", "group")
    return D.study_layout(files).select("ord", "n_studies", "output_folder")


@query(
    "assemble_structure",
    """
    SELECT ord, CASE WHEN rel_path LIKE 'node_modules/%' THEN 'software' ELSE type_gt END AS type,
      CASE WHEN rel_path LIKE 'node_modules/%' THEN 'software_folder' WHEN aggregate_folder IS NOT NULL THEN 'aggregate_llm'
        ELSE 'llm' END AS type_source FROM {v_files}""",
)
def assemble_structure(t):
    files = t.v_files.select("ord", "rel_path", "aggregate_folder", F.col("type_gt").alias("type"))
    tool = F.col("rel_path").startswith("node_modules/")
    rest = files.where(~tool)
    single = rest.where("aggregate_folder IS NULL").withColumn("type_source", F.lit("llm"))
    grouped = rest.where("aggregate_folder IS NOT NULL").withColumn("type_source", F.lit("aggregate_llm"))
    return D.assemble_structure(files.where(tool), single, grouped).select("ord", "type", "type_source")


@query(
    "candidate_files",
    """
    SELECT 'profile' AS kind, ord FROM {v_scored} WHERE type = 'data' AND data_format = 'tabular'
      AND data_granularity = 'combined' AND type_source <> 'aggregate_sentinel'
    UNION ALL
    SELECT 'codebook', ord FROM {v_scored} WHERE type IN ('codebook', 'readme')""",
)
def candidate_files(t):
    files = t.v_scored
    return D.profiling_candidates(files).select(F.lit("profile").alias("kind"), "ord").unionByName(
        D.codebook_files(files).select(F.lit("codebook").alias("kind"), "ord")
    )


@query(
    "batches",
    """
    SELECT ord, paper_id, CAST(ceil(row_number() OVER (PARTITION BY paper_id ORDER BY ord) / 7) AS BIGINT) AS batch FROM {v_files}""",
)
def batches(t):
    return A.batches(t.v_files.select("ord", "paper_id"), 7)


ANSWERED = """
    answered AS (SELECT ord, paper_id, rel_path, type, "group",
      CAST(ceil(row_number() OVER (PARTITION BY paper_id ORDER BY ord) / 7) AS BIGINT) AS batch FROM {v_scored})"""


def _answered(t):
    return A.batches(t.v_scored.select("ord", "paper_id", "rel_path", "type", "group"), 7)


@query(
    "batch_context",
    f"""
    WITH {ANSWERED},
    tk AS (SELECT paper_id, "group" AS key, CASE WHEN contains(rel_path, '/') THEN regexp_extract({DIR}, '[^/]*$', 0) ELSE rel_path END AS value,
      ord, batch FROM answered WHERE regexp_matches("group", '^(ex|pilot|shared)')),
    tf AS (SELECT paper_id, key, value, min(ord) AS ord, min(batch) AS b FROM tk GROUP BY 1, 2, 3),
    tr AS (SELECT *, row_number() OVER (PARTITION BY paper_id, key ORDER BY ord) AS k FROM tf),
    ef AS (SELECT paper_id, type AS key, regexp_extract(rel_path, '[^/]*$', 0) AS value, min(ord) AS ord, min(batch) AS b
      FROM answered WHERE type IS NOT NULL GROUP BY 1, 2, 3),
    er AS (SELECT *, row_number() OVER (PARTITION BY paper_id, key ORDER BY ord) AS k FROM ef),
    bt AS (SELECT DISTINCT paper_id, batch FROM answered),
    g AS (SELECT bt.paper_id AS paper_id, batch, string_agg(key || '=' || value, ';' ORDER BY key, ord) AS s FROM bt
      JOIN tr ON tr.paper_id = bt.paper_id AND tr.k <= 3 AND tr.b < bt.batch GROUP BY 1, 2),
    e AS (SELECT bt.paper_id AS paper_id, batch, string_agg(key || '=' || value, ';' ORDER BY key, ord) AS s FROM bt
      JOIN er ON er.paper_id = bt.paper_id AND er.k <= 2 AND er.b < bt.batch GROUP BY 1, 2),
    la AS (SELECT paper_id, batch + 1 AS batch, arg_max(rel_path, ord) AS p FROM answered GROUP BY paper_id, batch)
    SELECT bt.paper_id AS paper_id, bt.batch AS batch, coalesce(g.s, '') AS group_tokens, coalesce(e.s, '') AS type_examples,
      la.p AS last_path
    FROM bt LEFT JOIN g ON g.paper_id = bt.paper_id AND g.batch = bt.batch
    LEFT JOIN e ON e.paper_id = bt.paper_id AND e.batch = bt.batch
    LEFT JOIN la ON la.paper_id = bt.paper_id AND la.batch = bt.batch""",
)
def batch_context(t):
    return A.batch_context(_answered(t)).select(
        "paper_id",
        "batch",
        F.array_join("group_tokens", ";").alias("group_tokens"),
        F.array_join("type_examples", ";").alias("type_examples"),
        F.col("last_entry.rel_path").alias("last_path"),
    )


# answers to the batches: some missing, some repeated, some with unknown types or groups
_REPLY = """
    reply AS (
      SELECT paper_id, batch, rel_path, ord * 2 AS ord, CASE WHEN batch % 5 = 1 AND ord % 7 = 0 THEN 'nonsense' ELSE type END AS type,
        CASE WHEN ord % 9 = 0 THEN 'group x' ELSE "group" END AS "group"
      FROM answered WHERE NOT (batch % 4 = 0 AND ord % 3 = 0)
      UNION ALL
      SELECT paper_id, batch, rel_path, ord * 2 + 1, 'asset', 'ex9' FROM answered WHERE batch % 4 = 0 AND ord % 3 = 1)"""


@query(
    "merge_answers",
    f"""
    WITH {ANSWERED}, {_REPLY},
    sz AS (SELECT paper_id, batch, count(*) AS n FROM answered GROUP BY 1, 2),
    sh AS (SELECT paper_id, batch, count(*) AS n, bool_or(type IS NOT NULL) AND bool_or("group" IS NOT NULL) AS f FROM reply GROUP BY 1, 2),
    fr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, batch, rel_path ORDER BY ord) AS k FROM reply) q WHERE k = 1),
    fl AS (SELECT a.paper_id AS paper_id, a.batch AS batch, a.rel_path AS rel_path, coalesce(fr.type, 'other') AS type,
        coalesce(fr."group", 'shared') AS grp FROM answered a
      LEFT JOIN fr ON fr.paper_id = a.paper_id AND fr.batch = a.batch AND fr.rel_path = a.rel_path),
    kn AS (SELECT paper_id, batch, bool_and(type <> 'nonsense') AS ok FROM fl GROUP BY 1, 2),
    st AS (SELECT sz.paper_id AS paper_id, sz.batch AS batch, coalesce(sh.n, 0) = sz.n AND coalesce(sh.f, false) AND kn.ok AS ok
      FROM sz LEFT JOIN sh ON sh.paper_id = sz.paper_id AND sh.batch = sz.batch
      JOIN kn ON kn.paper_id = sz.paper_id AND kn.batch = sz.batch)
    SELECT fl.paper_id AS paper_id, fl.rel_path AS rel_path, st.ok AS batch_ok, CASE WHEN st.ok THEN type ELSE 'llm_error' END AS type,
      CASE WHEN st.ok AND regexp_matches(grp, '^(ex|pilot)[0-9]+\\w*$|^shared$') THEN grp ELSE 'shared' END AS "group"
    FROM fl JOIN st ON st.paper_id = fl.paper_id AND st.batch = fl.batch""",
)
def merge_answers(t):
    items = _answered(t)
    kept = items.where("NOT (batch % 4 = 0 AND ord % 3 = 0)").selectExpr(
        "paper_id", "batch", "rel_path", "ord * 2 AS ord",
        "CASE WHEN batch % 5 = 1 AND ord % 7 = 0 THEN 'nonsense' ELSE type END AS type",
        "CASE WHEN ord % 9 = 0 THEN 'group x' ELSE `group` END AS `group`",
    )
    extra = items.where("batch % 4 = 0 AND ord % 3 = 1").selectExpr(
        "paper_id", "batch", "rel_path", "ord * 2 + 1 AS ord", "'asset' AS type", "'ex9' AS `group`"
    )
    out = A.merge_answers(items.select("paper_id", "batch", "rel_path"), kept.unionByName(extra))
    return out.select("paper_id", "rel_path", "batch_ok", "type", "group")


@query(
    "propagate",
    """
    WITH v AS (SELECT paper_id, aggregate_folder, ext, min(type_gt) AS type, min("group") AS grp FROM {v_files}
      WHERE aggregate_folder IS NOT NULL AND ext <> 'png' GROUP BY 1, 2, 3)
    SELECT f.ord AS ord, coalesce(v.type, 'other') AS type, coalesce(v.grp, 'shared') AS "group" FROM {v_files} f
    LEFT JOIN v ON v.paper_id = f.paper_id AND v.aggregate_folder = f.aggregate_folder AND v.ext = f.ext
    WHERE f.aggregate_folder IS NOT NULL""",
)
def propagate(t):
    members = t.v_files.where(F.col("aggregate_folder").isNotNull())
    verdicts = (
        members.where("ext <> 'png'")
        .groupBy("paper_id", "aggregate_folder", "ext")
        .agg(F.min("type_gt").alias("type"), F.min("group").alias("group"))
    )
    return A.propagate(members.select("ord", "paper_id", "aggregate_folder", "ext"), verdicts).select("ord", "type", "group")


# human labels for every third file, one in seven under a path nobody knows
_TRUTH = """
    truth AS (SELECT paper_id, CASE WHEN ord % 7 = 0 THEN 'gone/' || rel_path ELSE rel_path END AS rel_path,
      CASE WHEN ord % 2 = 0 THEN 'asset' ELSE '' END AS type_gt, CASE WHEN ord % 5 <> 0 THEN 'ex7' END AS group_gt,
      CASE WHEN ord % 4 = 0 THEN 'individual' WHEN ord % 4 = 1 THEN '' END AS data_granularity_gt FROM {v_files} WHERE size > 500)"""


def _truth(t):
    return t.v_files.where("size > 500").selectExpr(
        "paper_id",
        "CASE WHEN ord % 7 = 0 THEN 'gone/' || rel_path ELSE rel_path END AS rel_path",
        "CASE WHEN ord % 2 = 0 THEN 'asset' ELSE '' END AS type_gt",
        "CASE WHEN ord % 5 <> 0 THEN 'ex7' END AS group_gt",
        "CASE WHEN ord % 4 = 0 THEN 'individual' WHEN ord % 4 = 1 THEN '' END AS data_granularity_gt",
    )


@query(
    "overlay",
    f"""
    WITH {_TRUTH}
    SELECT s.ord AS ord, coalesce(nullif(t.type_gt, ''), s.type) AS type, coalesce(nullif(t.group_gt, ''), s."group") AS "group",
      coalesce(nullif(t.data_granularity_gt, ''), s.data_granularity) AS data_granularity,
      t.rel_path IS NOT NULL AS ground_truth_validated
    FROM {{v_scored}} s LEFT JOIN truth t ON t.paper_id = s.paper_id AND t.rel_path = s.rel_path""",
)
def overlay(t):
    base = t.v_scored.select("ord", "paper_id", "rel_path", "type", "group", "data_granularity")
    return A.overlay(base, _truth(t)).drop("paper_id", "rel_path")


@query(
    "overlay_mismatches",
    f"WITH {_TRUTH} SELECT paper_id, rel_path, CAST(0 AS BIGINT) AS n_matches FROM truth WHERE rel_path LIKE 'gone/%'",
)
def overlay_mismatches(t):
    return A.overlay_mismatches(t.v_files.select("paper_id", "rel_path"), _truth(t))


@query(
    "annotation_status",
    """
    WITH f AS (SELECT 'p' || CAST(c_custkey % 40 AS VARCHAR) AS paper_id, c_custkey, c_mktsegment FROM {customer}),
    b AS (SELECT paper_id, c_custkey FROM f WHERE c_custkey % 40 <> 7),
    tr AS (SELECT paper_id, c_custkey FROM f WHERE c_custkey % 40 < 20 AND (c_custkey % 40 < 10 OR c_mktsegment = 'BUILDING')),
    j AS (SELECT coalesce(b.paper_id, tr.paper_id) AS paper_id, b.c_custkey AS bk, tr.c_custkey AS tk FROM b
      FULL JOIN tr ON b.paper_id = tr.paper_id AND b.c_custkey = tr.c_custkey)
    SELECT paper_id, count(bk) AS n_base, count(tk) AS n_truth, count(*) FILTER (WHERE bk IS NOT NULL AND tk IS NOT NULL) AS n_both,
      CASE WHEN count(bk) = 0 OR count(tk) = 0 THEN 'none' WHEN count(*) = count(bk) AND count(*) = count(tk) THEN 'complete'
        ELSE 'partial' END AS status FROM j GROUP BY paper_id""",
)
def annotation_status(t):
    rows = t.customer.selectExpr(
        "'p' || CAST(c_custkey % 40 AS STRING) AS paper_id", "CAST(c_custkey AS STRING) AS rel_path", "c_custkey % 40 AS k", "c_mktsegment"
    )
    truth = rows.where("k < 20 AND (k < 10 OR c_mktsegment = 'BUILDING')")
    return A.annotation_status(rows.where("k <> 7"), truth)


@query(
    "consistency_checks",
    """
    WITH l AS (SELECT event_id, 'p' || CAST(user_id AS VARCHAR) AS paper_id, 'f' || CAST(event_id % 50 AS VARCHAR) AS rel_path,
      event_type AS type_gt, event_type = 'view' AS d, CASE WHEN event_id % 3 <> 0 THEN 'individual' ELSE ' ' END AS g,
      CASE WHEN event_id % 5 <> 0 THEN 'raw' END AS f, CASE WHEN event_id % 11 <> 0 THEN 'ex1' END AS grp FROM {events}),
    c AS (SELECT *, count(*) OVER (PARTITION BY paper_id, rel_path) AS k FROM l)
    SELECT event_id, 'data_missing_granularity' AS "check" FROM c WHERE d AND trim(g) = '' UNION ALL
    SELECT event_id, 'spurious_granularity' FROM c WHERE NOT d AND trim(g) <> '' UNION ALL
    SELECT event_id, 'data_missing_format' FROM c WHERE d AND f IS NULL UNION ALL
    SELECT event_id, 'spurious_format' FROM c WHERE NOT d AND f IS NOT NULL UNION ALL
    SELECT event_id, 'duplicate_paths' FROM c WHERE k > 1 UNION ALL
    SELECT event_id, 'missing_group' FROM c WHERE grp IS NULL""",
)
def consistency_checks(t):
    labels = t.events.selectExpr(
        "event_id", "'p' || CAST(user_id AS STRING) AS paper_id", "'f' || CAST(event_id % 50 AS STRING) AS rel_path",
        "CASE WHEN event_type = 'view' THEN ' data ' ELSE event_type END AS type_gt",
        "CASE WHEN event_id % 3 <> 0 THEN 'individual' ELSE ' ' END AS data_granularity_gt",
        "CASE WHEN event_id % 5 <> 0 THEN 'raw' END AS data_format_gt",
        "CASE WHEN event_id % 11 <> 0 THEN 'ex1' END AS group_gt",
    )
    return A.consistency_findings(labels).select("event_id", "check")


@query(
    "export_names",
    r"""
    WITH k AS (SELECT ord, type_gt, paper_id, rel_path, substr(regexp_replace(regexp_replace(name, '\.[A-Za-z0-9]+$', ''), '[^a-zA-Z0-9]', '', 'g'), 1, 60) AS kw,
      ext, j FROM {v_files}),
    x AS (SELECT ord, paper_id, rel_path, CASE WHEN j % 2 = 0 THEN 'granularity-individual_' ELSE '' END || 'source-' || kw
      || CASE WHEN ext = 'csv' THEN '_sheet-' || type_gt ELSE '' END AS name FROM k)
    SELECT ord, name || CASE WHEN min(rel_path) OVER w <> max(rel_path) OVER w THEN '-' || substr(md5(rel_path), 1, 12) ELSE '' END
      || '_data.csv' AS export_name FROM x WINDOW w AS (PARTITION BY paper_id, name)""",
)
def export_names(t):
    sheet = F.when(F.col("ext") == "csv", F.col("type_gt"))
    name = PF.export_filename(F.col("name"), F.col("j") % 2 == 0, sheet, F.col("ord"))
    named = t.v_files.select("ord", "paper_id", "rel_path", name.alias("export_name"))
    return D.settle_clashes(named, ["paper_id"], "export_name", "rel_path").select("ord", "export_name")


@query(
    "text_chunks",
    r"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS nr
      FROM {documents})
    SELECT doc_id, CAST(ceil(nr / 20) AS BIGINT) AS chunk, md5(string_agg(line, chr(10) ORDER BY nr)) AS text_md5 FROM l GROUP BY 1, 2""",
)
def text_chunks(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select(
        "doc_id", (F.col("pos") + 1).alias("nr"), "line"
    )
    out = A.text_chunks(lines, ["doc_id"], "nr", 20)
    return out.select("doc_id", "chunk", F.md5("text").alias("text_md5"))


@query(
    "backfill_format",
    """
    SELECT ord, CASE WHEN type_gt = 'data' THEN CASE WHEN ord % 3 = 0 THEN 'tabular' WHEN ext = 'mat' THEN 'raw' ELSE 'tabular' END END
      AS data_format FROM {v_files}""",
)
def backfill_format(t):
    from tablewarden.operators.corpus import backfill_format as fill

    files = t.v_files.withColumn("type", F.col("type_gt")).withColumn(
        "data_format", F.when(F.col("ord") % 3 == 0, F.lit("tabular"))
    )
    once = fill(files, PF.data_format(F.col("ext")))
    return rounded(fill(once, PF.data_format(F.col("ext"))).select("ord", "data_format"))
