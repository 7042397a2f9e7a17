"""Queries that run whole stages: a collection indexed from its listing, columns labelled from dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.operators import match as X
from tablewarden.operators import stages as ST
from tablewarden.plans.folder_queries import DIR, PERSON
from tablewarden.plans.match_queries import MATCH, norm
from tablewarden.plans.views import Family
from tablewarden.session import settle

FAMILY = Family()
query = FAMILY.add

LIMIT, BATCH, BUILD = 5, 10, 5

# The listing with copies (every second of them agrees in its first lines), version-control files,
# documents beside their sources and readme files.
_LISTING = """
    SELECT paper_id, rel_path, size, ord, 'a' AS fingerprint FROM {v_files}
    UNION ALL SELECT paper_id, 'copy/' || name, size, ord + 1000000000, CASE WHEN ord % 20 = 0 THEN 'a' ELSE 'b' END FROM {v_files} WHERE ord % 10 = 0
    UNION ALL SELECT paper_id, '.git/x' || CAST(ord AS STRING), size, ord + 2000000000, 'a' FROM {v_files} WHERE ord % 50 = 7
    UNION ALL SELECT paper_id, regexp_replace(rel_path, '[.]rmd$', '.pdf'), size, ord + 3000000000, 'a' FROM {v_files} WHERE k = 4 AND ord % 6 = 0
    UNION ALL SELECT paper_id, 'docs' || CAST(ord AS STRING) || '/README.txt', size, ord + 4000000000, 'a' FROM {v_files} WHERE ord % 30 = 3"""

# What the outside classifier says; a word it may not use spoils its batch.
_TYPE = """CASE WHEN ord % 97 = 5 THEN 'nonsense' WHEN rel_path LIKE '%.csv' OR rel_path LIKE '%.mat' THEN 'data'
      WHEN rel_path LIKE '%.txt' THEN 'codebook' WHEN rel_path LIKE '%.r' OR rel_path LIKE '%.rmd' THEN 'data'
      WHEN rel_path LIKE '%.png' THEN 'asset' WHEN rel_path LIKE '%.pdf' THEN 'supplemental' END"""
_GROUP = "CASE ord % 4 WHEN 0 THEN 'ex1' WHEN 1 THEN 'Study 2' WHEN 2 THEN 'pilot1' END"

_NAME = "regexp_extract(rel_path, '[^/]*$', 0)"
_EXT = "lower(regexp_extract(rel_path, '[^.]*$', 0))"
_STEM = f"regexp_replace({_NAME}, '\\.[A-Za-z0-9]+$', '')"


def _above(files: str, out: str) -> str:
    """Folders above each file of a table, outermost first."""
    return f"""{out} AS (SELECT paper_id, rel_path, array_to_string(list_slice(parts, 1, i), '/') AS dir FROM (
      SELECT paper_id, rel_path, parts, unnest(range(1, len(parts))) AS i FROM (
        SELECT paper_id, rel_path, string_split(rel_path, '/') AS parts FROM {files}) a) b)"""


_LAST = "lower(regexp_extract(dir, '[^/]*$', 0))"
_ANSWER = f"""CASE WHEN bad THEN 'llm_error' ELSE coalesce({_TYPE}, 'other') END AS type,
      CASE WHEN NOT bad AND {_GROUP} IN ('ex1', 'pilot1') THEN {_GROUP} ELSE 'shared' END AS grp"""

INDEX = f"""
    src AS ({_LISTING}),
    nogit AS (SELECT *, {_NAME} AS fname, {_EXT} AS ext FROM src WHERE NOT regexp_matches(rel_path, '(^|/)\\.git(/|$)')),
    kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, fname, size,
        CASE WHEN ext IN ('csv', 'tsv', 'txt', 'dat') THEN fingerprint ELSE '' END ORDER BY ord) AS nr FROM nogit) q WHERE nr = 1),
    {_above('kept', 'anc')},
    tool AS (SELECT paper_id, rel_path, arg_min(dir, length(dir)) AS dir FROM anc
      WHERE {_LAST} IN ('node_modules', 'renv', 'venv', '.git') GROUP BY paper_id, rel_path),
    cand AS (SELECT anc.* FROM anc LEFT JOIN tool USING (paper_id, rel_path) WHERE tool.dir IS NULL
      AND {_LAST.replace('dir', 'anc.dir')} IN ('lib', 'libs', 'src', 'build', 'dist', 'vendor')),
    okd AS (SELECT paper_id, dir FROM cand GROUP BY paper_id, dir HAVING count(*) >= {BUILD}
      AND avg(CASE WHEN {_EXT} IN ('csv', 'tsv', 'txt', 'dat', 'xlsx', 'xls', 'sav', 'dta', 'sas7bdat', 'rds', 'rda', 'rdata')
        THEN 1.0 ELSE 0.0 END) <= 0.5),
    build AS (SELECT paper_id, rel_path, arg_min(dir, length(dir)) AS dir FROM cand SEMI JOIN okd USING (paper_id, dir) GROUP BY paper_id, rel_path),
    claimed AS (SELECT k.paper_id AS paper_id, k.rel_path AS rel_path, k.ord AS ord, k.ext AS ext, coalesce(tool.dir, build.dir) AS sw FROM kept k
      LEFT JOIN tool ON tool.paper_id = k.paper_id AND tool.rel_path = k.rel_path
      LEFT JOIN build ON build.paper_id = k.paper_id AND build.rel_path = k.rel_path),
    rest AS (SELECT *, {DIR} AS own FROM claimed WHERE sw IS NULL),
    {_above('rest', 'anr')},
    people AS (SELECT paper_id, regexp_extract(dir, '^(.*)/[^/]*$', 1) AS folder FROM anr
      WHERE contains(dir, '/') AND regexp_matches({_LAST}, {PERSON}) GROUP BY 1, 2 HAVING count(DISTINCT dir) > {LIMIT}),
    flat AS (SELECT paper_id, own AS folder FROM rest GROUP BY 1, 2 HAVING count(*) > {LIMIT}),
    under AS (SELECT anr.paper_id AS paper_id, anr.rel_path AS rel_path, arg_min(dir, length(dir)) AS dir FROM anr
      JOIN people ON people.paper_id = anr.paper_id AND people.folder = anr.dir GROUP BY 1, 2),
    placed AS (SELECT r.*, CASE WHEN under.dir IS NOT NULL THEN under.dir WHEN flat.folder = '' THEN '.' ELSE flat.folder END AS folder,
        under.dir IS NOT NULL AS byp, regexp_matches(lower(regexp_extract(own, '[^/]*$', 0)), {PERSON}) AS person
      FROM rest r LEFT JOIN under ON under.paper_id = r.paper_id AND under.rel_path = r.rel_path
      LEFT JOIN flat ON flat.paper_id = r.paper_id AND flat.folder = r.own),
    grps AS (SELECT paper_id, folder, ext, count(*) < {LIMIT} AS route, min(ord) AS ord, folder || '/.' || ext AS rel_path,
        bool_or(byp) AND avg(CASE WHEN person THEN 1.0 ELSE 0.0 END) > 0.5 AS series
      FROM placed WHERE folder IS NOT NULL GROUP BY paper_id, folder, ext),
    tagd AS (SELECT p.*, g.series AS series, coalesce(g.route, true) AS alone FROM placed p
      LEFT JOIN grps g ON g.paper_id = p.paper_id AND g.folder = p.folder AND g.ext = p.ext),
    single AS (SELECT *, CAST(ceil(row_number() OVER (PARTITION BY paper_id ORDER BY folder IS NOT NULL, ord) / {BATCH}.0) AS BIGINT) AS batch
      FROM tagd WHERE alone),
    judged AS (SELECT *, bool_or(ord % 97 = 5) OVER b OR NOT bool_or({_GROUP} IS NOT NULL) OVER b OR NOT bool_or({_TYPE} IS NOT NULL) OVER b AS bad
      FROM single WINDOW b AS (PARTITION BY paper_id, batch)),
    descr AS (SELECT *, CAST(ceil(row_number() OVER (PARTITION BY paper_id ORDER BY ord) / {BATCH}.0) AS BIGINT) AS batch FROM grps WHERE NOT route),
    djudged AS (SELECT *, bool_or(ord % 97 = 5) OVER b OR NOT bool_or({_GROUP} IS NOT NULL) OVER b OR NOT bool_or({_TYPE} IS NOT NULL) OVER b AS bad
      FROM descr WINDOW b AS (PARTITION BY paper_id, batch)),
    dansw AS (SELECT paper_id, folder, ext, batch, {_ANSWER} FROM djudged),
    tbl AS (
      SELECT paper_id, rel_path, ext, 'software' AS type, 'rule_folder' AS src, NULL AS grp, sw AS folder, NULL AS series, NULL AS batch FROM claimed WHERE sw IS NOT NULL
      UNION ALL SELECT paper_id, rel_path, ext, type, 'llm', grp, NULL, NULL, batch FROM (SELECT *, {_ANSWER} FROM judged) q
      UNION ALL SELECT t.paper_id, t.rel_path, t.ext, d.type, 'aggregate_llm', d.grp, t.folder, t.series, d.batch FROM tagd t
        JOIN dansw d ON d.paper_id = t.paper_id AND d.folder = t.folder AND d.ext = t.ext WHERE NOT alone),
    gr AS (SELECT *, type = 'data' AS d, folder IS NOT NULL AND folder <> '' AS mem, regexp_extract({DIR}, '[^/]*$', 0) AS dname,
        regexp_matches(lower({_STEM}), {PERSON}) AS person FROM tbl),
    maj AS (SELECT paper_id, folder, avg(CASE WHEN regexp_matches(lower(dname), {PERSON}) THEN 1.0 ELSE 0.0 END) > 0.5 AS ppl FROM (
      SELECT DISTINCT paper_id, folder, dname FROM gr WHERE d AND mem) q GROUP BY paper_id, folder),
    gran AS (SELECT gr.*, CASE WHEN NOT d THEN NULL WHEN mem THEN CASE WHEN ppl OR series THEN 'individual' ELSE 'combined' END
          WHEN person THEN 'individual' ELSE 'combined' END AS granularity,
        CASE WHEN NOT d THEN NULL WHEN mem THEN CASE WHEN ppl THEN 'folder_name_heuristic' ELSE 'folder_heuristic' END
          WHEN person THEN 'filename_heuristic' ELSE 'default_combined' END AS gsrc,
        regexp_replace(rel_path, '\\.[A-Za-z0-9]+$', '') AS pairkey
      FROM gr LEFT JOIN maj ON maj.paper_id = gr.paper_id AND maj.folder = gr.folder),
    prs AS (SELECT paper_id, pairkey FROM gran GROUP BY 1, 2 HAVING bool_or(ext = 'pdf') AND bool_or(ext IN ('rmd', 'qmd', 'tex'))),
    r1 AS (SELECT gran.*, prs.pairkey IS NOT NULL AND ext IN ('pdf', 'rmd', 'qmd', 'tex') AS hit FROM gran
      LEFT JOIN prs ON prs.paper_id = gran.paper_id AND prs.pairkey = gran.pairkey),
    r2 AS (SELECT * EXCLUDE (type, src), CASE WHEN NOT hit THEN type WHEN ext = 'pdf' THEN 'output' ELSE 'code' END AS type,
        CASE WHEN hit THEN 'rmd_pair_rule' ELSE src END AS src,
        CASE WHEN hit OR type <> 'data' THEN NULL WHEN ext IN ('mat', 'pdf') THEN 'raw' ELSE 'tabular' END AS fmt FROM r1),
    r3 AS (SELECT *, ext = 'r' AND type <> 'code' AS fix, regexp_matches(lower({_NAME}), '^readme($|\\.)') AND type <> 'readme' AS readme FROM r2)"""


def _listing(t):
    return t.spark.sql(_LISTING, v_files=t.v_files)


def _classifier(items):
    return items.select("paper_id", "batch", "ord", "rel_path", F.expr(_TYPE).alias("type"), F.expr(_GROUP).alias("group"))


@query(
    "index_pipeline",
    f"""
    WITH {INDEX}
    SELECT paper_id, rel_path, {_NAME} AS filename, ext, CASE WHEN readme THEN 'readme' WHEN fix THEN 'code' ELSE type END AS type,
      CASE WHEN readme THEN 'fixed_filename_rule' WHEN fix THEN 'fixed_ext_rule' ELSE src END AS type_source, grp AS "group",
      folder AS aggregate_folder, granularity AS data_granularity, gsrc AS granularity_source, batch AS prompt_nr,
      CASE WHEN NOT fix AND NOT readme THEN fmt END AS data_format FROM r3""",
)
def index_pipeline(t):
    return ST.index_collections(_listing(t), _classifier, batch=BATCH, limit=LIMIT, build_files=BUILD)


# Which files of a repository the index calls what: some have no dictionary that counts.
_BOOKS = """
    SELECT paper_id, rel_path, type, min(ord) AS ord FROM (
      SELECT paper_id, ord, codebook_source AS rel_path, CASE WHEN codebook_source = 'README.md' THEN
          CASE WHEN ord % 150 % 4 <> 0 THEN 'readme' ELSE 'other' END WHEN codebook_source = 'codebook.csv' THEN 'codebook'
        WHEN ord % 150 % 5 <> 0 THEN 'data' ELSE 'output' END AS type
      FROM {v_book} WHERE ord % 150 % 10 <> 9) q GROUP BY paper_id, rel_path, type"""
_VERDICTS = """
    SELECT DISTINCT paper_id, column_name, ascii(right(column_name, 1)) % 2 = 0 AS equivalent,
      CASE WHEN ascii(right(column_name, 1)) % 4 = 0 THEN '' ELSE 'canonical label' END AS canonical FROM {v_cols}"""
_PAIRS = """
    SELECT paper_id, column_name, 'Q_' || CAST(CAST(right(column_name, 1) AS INT) - 3 AS STRING) AS codebook_variable, min(col_pos) AS ord
    FROM {v_cols} GROUP BY paper_id, column_name"""

LABELLED = (
    f"""
    sb AS ({_BOOKS}), vd AS ({_VERDICTS}), pr AS ({_PAIRS}),
    usable AS (SELECT b.*, CASE WHEN parse_method = 'haven' THEN 0 ELSE 1 END AS late FROM {{v_book}} b
      JOIN sb ON sb.paper_id = b.paper_id AND sb.rel_path = b.codebook_source
      WHERE (parse_method = 'haven' AND type = 'data') OR (parse_method <> 'haven' AND type IN ('codebook', 'readme'))),
    once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, {norm('codebook_variable')}, label, "group" ORDER BY late, ord) AS nr
      FROM usable) q WHERE nr = 1),
    lb AS (SELECT * EXCLUDE (ord), row_number() OVER (PARTITION BY paper_id ORDER BY late, ord) AS ord FROM (SELECT * EXCLUDE (late, nr), late FROM once) q),
    has AS (SELECT DISTINCT paper_id FROM sb WHERE type IN ('codebook', 'readme') UNION SELECT paper_id FROM lb),"""
    + MATCH.replace("{v_book}", "lb")
    + f""",
    l1 AS (SELECT lab.*, has.paper_id IS NOT NULL AS known FROM lab LEFT JOIN has ON has.paper_id = lab.paper_id),
    l2 AS (SELECT l1.* EXCLUDE (label_status), CASE WHEN known THEN label_status ELSE 'no_codebook' END AS label_status FROM l1),
    l3 AS (SELECT l2.*, canonical, label_status = 'conflicting_definition' AND equivalent AND canonical <> '' AS agreed FROM l2
      JOIN vd ON vd.paper_id = l2.paper_id AND vd.column_name = l2.column_name),
    l4 AS (SELECT * EXCLUDE (label, label_status, label_method), CASE WHEN agreed THEN canonical ELSE label END AS label,
      CASE WHEN agreed THEN 'labelled' ELSE label_status END AS label_status, CASE WHEN agreed THEN 'merged_llm' ELSE label_method END AS label_method FROM l3),
    used AS (SELECT DISTINCT paper_id, {norm('v')} AS var FROM (
      SELECT paper_id, unnest(string_split(codebook_variable, ' | ')) AS v FROM l4 WHERE label_status = 'labelled') q),
    bk AS (SELECT *, {norm('codebook_variable')} AS nv FROM ord_book),
    fr AS (SELECT bk.paper_id AS paper_id, nv, arg_min(label, o) AS label, arg_min(codebook_variable, o) AS v, arg_min(codebook_source, o) AS src
      FROM bk LEFT JOIN used ON used.paper_id = bk.paper_id AND used.var = nv WHERE used.var IS NULL GROUP BY bk.paper_id, nv),
    ch AS (SELECT p.paper_id AS paper_id, {norm('p.column_name')} AS nm, arg_min(fr.label, p.ord) AS label, arg_min(fr.v, p.ord) AS v,
        arg_min(fr.src, p.ord) AS src FROM pr p JOIN fr ON fr.paper_id = p.paper_id AND fr.nv = {norm('p.codebook_variable')} GROUP BY 1, 2),
    l5 AS (SELECT l4.*, ch.label AS chl, ch.v AS chv, ch.src AS chs, ch.v IS NOT NULL AND label_status = 'unlabelled' AS found FROM l4
      LEFT JOIN ch ON ch.paper_id = l4.paper_id AND ch.nm = l4.nm),
    done AS (SELECT paper_id, col_pos, CASE WHEN found THEN chl ELSE label END AS label, CASE WHEN found THEN chv ELSE codebook_variable END AS codebook_variable,
      CASE WHEN found THEN chs ELSE label_source END AS label_source, CASE WHEN found THEN 'llm' ELSE label_status END AS label_status,
      CASE WHEN found THEN 'llm' ELSE label_method END AS label_method FROM l5)"""
)


def _labelled(t) -> ST.Labelling:
    sql = lambda text, **views: t.spark.sql(text, **views)
    structure = sql(_BOOKS, v_book=t.v_book)
    own = F.col("parse_method") == "haven"
    return ST.label_columns(
        t.v_cols.drop("col_type"), structure, t.v_book.where(~own), t.v_book.where(own), sql(_VERDICTS, v_cols=t.v_cols), sql(_PAIRS, v_cols=t.v_cols)
    )


_OUT = "col_pos, label, codebook_variable, label_source, label_status, label_method"


@query("label_pipeline", f"WITH {LABELLED} SELECT {_OUT} FROM done")
def label_pipeline(t):
    return X.joined_output(_labelled(t).labels).select(*_OUT.split(", "))


@query(
    "label_pipeline_status",
    f"""
    WITH {LABELLED},
    us AS (SELECT DISTINCT paper_id, {norm('v')} AS nv FROM (
      SELECT paper_id, unnest(string_split(codebook_variable, ' | ')) AS v FROM done WHERE label_status IN ('labelled', 'llm')) q),
    cov AS (SELECT lb.paper_id AS paper_id, count(*) AS n_vars, count(us.nv) AS n_matched FROM lb
      LEFT JOIN us ON us.paper_id = lb.paper_id AND us.nv = {norm('lb.codebook_variable')} GROUP BY lb.paper_id),
    n AS (SELECT paper_id, count(*) AS n_columns, count(*) FILTER (WHERE label_status IN ('labelled', 'llm')) AS n_labelled,
      count(*) FILTER (WHERE label_status IN ('unlabelled', 'no_codebook')) AS n_unlabelled FROM done GROUP BY paper_id)
    SELECT n.*, coalesce(n_vars, 0) AS n_vars, coalesce(n_matched, 0) AS n_matched,
      CASE WHEN coalesce(n_vars, 0) = 0 THEN 'no_codebook' WHEN n_labelled = 0 THEN 'no_match' ELSE 'ok' END AS status
    FROM n LEFT JOIN cov ON cov.paper_id = n.paper_id""",
)
def label_pipeline_status(t):
    """Counts and status per repository, and how many of its dictionary's variables the columns use."""
    found = _labelled(t)
    matched = found.coverage.groupBy(F.col("paper_id").alias("of")).agg(F.count_if(F.col("match_status") == "matched").alias("n_matched"))
    out = settle(found.status).join(matched, F.col("paper_id") == F.col("of"), "left").drop("of")
    return out.withColumn("n_matched", F.coalesce("n_matched", F.lit(0).cast("bigint")))
