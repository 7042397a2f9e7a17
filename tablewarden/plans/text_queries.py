"""Queries over free text, markup and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.functions import paths as PF
from tablewarden.functions import text as TF
from tablewarden.operators import answers as A
from tablewarden.plans.views import Family
from tablewarden.sources import export as E

FAMILY = Family()
query = FAMILY.add


@query(
    "strip_markup",
    r"""
    SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
      '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&apos;', ''''), '&quot;', '"'), '\s+', ' ', 'g'))) AS text_md5 FROM {pages}""",
)
def strip_markup(t):
    return t.pages.select("page_id", F.md5(TF.strip_markup(F.col("html"))).alias("text_md5"))


@query(
    "strip_rtf",
    r"""
    WITH r AS (SELECT item_id, '{{\rtf1\ansi {{\b ' || replace(text, ' ', '\par ') || '}}\''e9}}' AS x FROM {benchmark})
    SELECT item_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '\\[a-z]+-?[0-9]*\s?', ' ', 'g'),
      '\\[^a-z' || chr(10) || ']', ' ', 'g'), '[{{}}]', '', 'g'), '\s+', ' ', 'g'))) AS text_md5 FROM r""",
)
def strip_rtf(t):
    rtf = F.concat(
        F.lit("{\\rtf1\\ansi {\\b "), F.replace("text", F.lit(" "), F.lit("\\par ")), F.lit("}\\'e9}")
    )
    return t.benchmark.select("item_id", F.md5(TF.strip_rtf(rtf)).alias("text_md5"))


_CONTEXT = (
    "CASE conv_id % 5 WHEN 0 THEN 'Study ' WHEN 1 THEN 'our experiment' WHEN 2 THEN 'Pilot  ' WHEN 3 THEN 'none ' ELSE 'study 1 pilot ' END"
    " || CAST(conv_id AS STRING) || CASE turn % 3 WHEN 0 THEN 'A' WHEN 1 THEN '' ELSE ' b' END"
)


@query(
    "infer_group",
    rf"""
    WITH c AS (SELECT conv_id, turn, {_CONTEXT} AS x FROM {{conversations}})
    SELECT conv_id, turn, CASE WHEN regexp_matches(lower(x), 'pilot\s*[0-9]') THEN 'pilot' || regexp_extract(lower(x), 'pilot\s*([0-9]+[a-z]?)', 1)
      WHEN regexp_matches(lower(x), '(experiment|study)\s*[0-9]') THEN 'ex' || regexp_extract(lower(x), '(experiment|study)\s*([0-9]+[a-z]?)', 2)
      END AS "group", CASE WHEN conv_id % 2 = 0 THEN 'shared' ELSE 'experiment-specific' END AS scope,
      conv_id % 2 = 0 OR regexp_matches(x, '^(ex|pilot)[0-9]+\w*$') AS is_valid
    FROM c""",
)
def infer_group(t):
    x = F.expr(_CONTEXT)
    group = F.when(F.col("conv_id") % 2 == 0, F.lit("shared")).otherwise(x)
    return t.conversations.select(
        "conv_id", "turn", PF.infer_group(x).alias("group"),
        PF.group_scope(group).alias("scope"), PF.valid_group(group).alias("is_valid"),
    )


_DOI = (
    "CASE page_id % 5 WHEN 0 THEN 'https://doi.org/10.1177/' WHEN 1 THEN 'DOI: 10.1177/' WHEN 2 THEN ' http://dx.doi.org/10.12345/' "
    "WHEN 3 THEN 'see 10.1177/' ELSE 'none ' END || CAST(page_id * 7919 AS STRING) "
    "|| CASE page_id % 4 WHEN 0 THEN 'pss.' WHEN 1 THEN 'pss.sagepub' WHEN 2 THEN ';,' ELSE '' END"
)


@query(
    "clean_doi",
    rf"""
    WITH d AS (SELECT page_id, regexp_extract(regexp_replace(regexp_replace(lower(trim({_DOI})), '^https?://(dx\.)?doi\.org/', ''), '^doi:\s*', ''),
      '(10\.[0-9]{{{{4,9}}}}/\S+)', 1) AS x FROM {{pages}}),
    e AS (SELECT page_id, CASE WHEN x <> '' THEN regexp_replace(x, '[.,;]+$', '') END AS doi FROM d),
    f AS (SELECT *, regexp_replace(doi, '([0-9])[a-z]+$', '\1') AS d2, regexp_replace(doi, '([0-9])[^0-9]*$', '\1') AS d3 FROM e)
    SELECT page_id, doi, coalesce(doi || CASE WHEN d2 <> doi THEN '|' || d2 ELSE '' END
      || CASE WHEN d3 <> doi AND d3 <> d2 THEN '|' || d3 ELSE '' END, '') AS candidates FROM f""",
)
def clean_doi(t):
    raw = F.expr(_DOI)
    return t.pages.select(
        "page_id", TF.clean_doi(raw).alias("doi"), F.array_join(TF.doi_candidates(raw), "|").alias("candidates")
    )


def _reply():
    """A model-like reply about each turn: fences, prose around, backticks, one in seven broken."""
    body = F.to_json(
        F.array(
            F.struct(F.concat(F.lit("`"), "role", F.lit("`")).alias("path"), F.col("turn").cast("string").alias("type")),
            F.struct(F.lit("second").alias("path"), F.concat(F.lit("n"), F.length("text").cast("string")).alias("type")),
        )
    )
    whole = F.concat(F.lit("```json\nNote: "), body, F.lit(" (done)\n```"))
    return F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, F.lit("no array here")).otherwise(whole)


@query(
    "parse_answer",
    """
    SELECT conv_id, turn, role AS path, CAST(turn AS VARCHAR) AS type FROM {conversations} WHERE (conv_id + turn) % 7 <> 0
    UNION ALL
    SELECT conv_id, turn, 'second', 'n' || CAST(length(text) AS VARCHAR) FROM {conversations} WHERE (conv_id + turn) % 7 <> 0""",
)
def parse_answer(t):
    parsed = TF.parse_answer(_reply(), "struct<path:string,type:string>")
    return t.conversations.select("conv_id", "turn", F.inline(parsed))


@query(
    "explain_error",
    r"""
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'column count mismatch building study table (' || CAST(user_id AS VARCHAR) || ' input rows vs '
      || CAST(event_id AS VARCHAR) || ' in data)' WHEN 1 THEN 'no data files found for this study group' ELSE event_type END AS message,
      CASE event_id % 4 WHEN 0 THEN 'a_code' ELSE 'plain text' END AS code,
      CASE WHEN user_id = 0 THEN '-' ELSE printf('%.1f%%', 100.0 * event_id / user_id) END AS pct FROM {events}""",
)
def explain_error(t):
    message = F.expr(
        "CASE event_id % 3 WHEN 0 THEN 'x replacement has ' || user_id || ' rows, data has ' || event_id "
        "WHEN 1 THEN ' no_data_files ' ELSE event_type END"
    )
    code = F.expr("CASE event_id % 4 WHEN 0 THEN 'a_code: broken: twice' ELSE 'plain text' END")
    return t.events.select(
        "event_id", TF.explain_error(message).alias("message"), TF.error_code(code).alias("code"),
        TF.format_percent(F.col("event_id"), F.col("user_id")).alias("pct"),
    )


@query(
    "author_links",
    r"""
    WITH c AS (SELECT c_custkey, c_nationkey, c_name, c_mktsegment FROM {customer})
    SELECT c_custkey, CASE WHEN c_nationkey % 3 <> 0 THEN c_name || CASE WHEN c_nationkey % 2 = 0 THEN '; Solo' ELSE '' END
      ELSE CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment || '; Solo' ELSE c_mktsegment END END AS authors,
      CASE WHEN c_nationkey % 4 = 0 THEN 'https://osf.io/abc' || c_custkey ELSE 'https://osf.io/' || c_custkey END AS link FROM c""",
)
def author_links(t):
    authors = F.array(
        F.expr("named_struct('given', CASE WHEN c_nationkey % 3 <> 0 THEN c_name END, "
               "'surname', CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment ELSE '' END)"),
        F.expr("named_struct('given', CASE WHEN c_nationkey % 2 = 0 THEN 'Solo' ELSE ' ' END, 'surname', CAST(NULL AS STRING))"),
    )
    links = F.array(
        F.lit("osf.io/badge"),
        F.expr("CASE WHEN c_nationkey % 4 = 0 THEN 'https://osf.io/abc' || c_custkey || '//' ELSE 'osf.io/' || c_custkey END"),
    )
    return t.customer.select(
        "c_custkey", TF.author_list(authors).alias("authors"), TF.first_link(links, ["osf.io/badge"]).alias("link")
    )


@query(
    "capped_list",
    """
    WITH l AS (SELECT conv_id, string_agg(role || CAST(turn AS VARCHAR), ', ' ORDER BY turn) FILTER (WHERE k <= 2) AS shown, max(k) AS n FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM {conversations}) q GROUP BY conv_id)
    SELECT conv_id, shown || CASE WHEN n > 2 THEN ' … and ' || CAST(n - 2 AS VARCHAR) || ' more' ELSE '' END AS items FROM l""",
)
def capped_list(t):
    rows = F.array_sort(F.collect_list(F.struct("turn", "role")))
    items = F.transform(rows, lambda r: F.concat(r["role"], r["turn"].cast("string")))
    return t.conversations.groupBy("conv_id").agg(TF.capped_list(items, 2).alias("items"))


@query(
    "narrative_files",
    """
    SELECT doc_id, doc_id % 6 < 3 AS is_narrative FROM {documents}""",
)
def narrative_files(t):
    name = F.expr(
        "CASE doc_id % 6 WHEN 0 THEN 'Manuscript_v2.docx' WHEN 1 THEN 'my_Report_3.pdf' WHEN 2 THEN 'preregistration' "
        "WHEN 3 THEN 'reports.txt' WHEN 4 THEN 'data.csv' ELSE 'man.pdf' END"
    )
    return t.documents.select("doc_id", PF.is_narrative(name).alias("is_narrative"))


def _tei():
    """A TEI document around each conversation turn."""
    return F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>Title '),
        F.col("conv_id").cast("string"),
        F.lit('</title></titleStmt><sourceDesc><biblStruct><analytic><author><persName><forename>Ann</forename><surname>A'),
        F.col("turn").cast("string"),
        F.lit('</surname></persName></author><author><persName><forename>Bo</forename><surname>B</surname></persName></author></analytic>'
              '<monogr><title level="j">Journal</title><imprint><biblScope unit="volume">'),
        F.col("turn").cast("string"),
        F.lit('</biblScope><biblScope unit="page" from="1" to="9"/><date type="published" when="2015-03-01"/></imprint></monogr>'
              '</biblStruct></sourceDesc></fileDesc><profileDesc><abstract><p>'),
        F.regexp_replace("text", "[<>&]", " "),
        F.lit('</p></abstract></profileDesc></teiHeader><text><back><listBibl><biblStruct><analytic><author><persName>'
              '<forename>X</forename><surname>Y</surname></persName></author></analytic></biblStruct></listBibl></back></text></TEI>'),
    )


@query(
    "xml_metadata",
    r"""
    SELECT conv_id, turn, 'Title ' || CAST(conv_id AS VARCHAR) AS title, 'Ann A' || CAST(turn AS VARCHAR) || '; Bo B' AS authors,
      'Journal' AS journal, CAST(turn AS VARCHAR) AS volume, '1-9' AS pages, '2015' AS pub_year,
      md5(regexp_replace(text, '[<>&]', ' ', 'g')) AS abstract_md5 FROM {conversations}""",
)
def xml_metadata(t):
    docs = t.conversations.select("conv_id", "turn", _tei().alias("xml"))
    out = E.xml_metadata(docs)
    return out.select(
        "conv_id", "turn", "title", F.array_join("authors", "; ").alias("authors"), "journal", "volume", "pages", "pub_year",
        F.md5("abstract").alias("abstract_md5"),
    )


@query(
    "enrich",
    """
    SELECT conv_id AS paper_id, CASE WHEN conv_id % 2 = 0 THEN 'L' ELSE 'B' END AS journal, 'B' AS volume,
      CASE WHEN conv_id % 3 = 0 THEN 'L' ELSE 'B' END AS title, CASE WHEN conv_id % 5 = 0 THEN 'L1' ELSE 'B1' END AS authors
    FROM (SELECT DISTINCT conv_id FROM {conversations}) q""",
)
def enrich(t):
    ids = t.conversations.select(F.col("conv_id").alias("paper_id")).distinct()
    base = ids.selectExpr(
        "paper_id", "'B' AS journal", "'B' AS volume", "CASE WHEN paper_id % 3 = 0 THEN '' ELSE 'B' END AS title",
        "CASE WHEN paper_id % 5 = 0 THEN array() ELSE array('B1') END AS authors",
        *[f"'B' AS {c}" for c in ("pub_year", "date", "issue", "pages", "issn", "publisher")],
    )
    lookup = ids.selectExpr(
        "paper_id", "CASE WHEN paper_id % 2 = 0 THEN 'L' END AS journal", "CAST(NULL AS STRING) AS volume",
        "'L' AS title", "array('L1') AS authors",
        *[f"CAST(NULL AS STRING) AS {c}" for c in ("pub_year", "date", "issue", "pages", "issn", "publisher")],
    )
    return A.enrich(base, lookup).select(
        "paper_id", "journal", "volume", "title", F.array_join("authors", ",").alias("authors")
    )


@query(
    "drop_empty",
    "SELECT doc_id AS original_row_id, source, n_chars FROM {documents}",
)
def drop_empty(t):
    table = t.documents.selectExpr(
        "doc_id", "CASE WHEN doc_id >= 0 THEN 1 END AS same", "source", "' ' AS blank", "CAST(NULL AS STRING) AS nothing", "n_chars"
    )
    doubled = table.selectExpr("source AS row_id", "doc_id AS original", "blank", "nothing", "n_chars")
    cleaned = E.clean_table(doubled)
    return cleaned.selectExpr("original AS original_row_id", "original_row_id AS source", "n_chars")
