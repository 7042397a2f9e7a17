"""Queries over delimited text, encodings and document inventories."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from tablewarden.functions import grading as G
from tablewarden.functions import paths as PF
from tablewarden.operators import match as X
from tablewarden.operators import metrics as M
from tablewarden.operators import runlog as R
from tablewarden.plans.match_queries import MATCH, _labels
from tablewarden.plans.profile_queries import rounded
from tablewarden.plans.views import Family
from tablewarden.session import shared_folder
from tablewarden.sources import export as E
from tablewarden.sources import files as S
from tablewarden.streaming import incremental as I

FAMILY = Family()
query = FAMILY.add

_SEP = "CASE o_custkey % 4 WHEN 0 THEN ',' WHEN 1 THEN ';' WHEN 2 THEN '|' ELSE ',' END"


def _lines(t):
    """One delimited file per customer: a header in some, a comment line, quoted fields."""
    row = f"CAST(o_orderkey AS STRING) || {_SEP} || '\"' || o_orderstatus || {_SEP} || 'x\"' || {_SEP} || CAST(o_custkey AS STRING)"
    plain = f"CAST(o_orderkey AS STRING) || {_SEP} || 'NA' || {_SEP} || CAST(o_custkey AS STRING)"
    return t.orders.select(
        F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("file"),
        F.col("o_orderkey").alias("ord"),
        F.expr(f"CASE WHEN o_custkey % 3 = 0 THEN {plain} ELSE {row} END").alias("line"),
    )


@query(
    "file_layout",
    f"""
    SELECT 'f' || CAST(o_custkey AS VARCHAR) AS file, any_value({_SEP}) AS sep, NOT (o_custkey % 3 = 0 AND count(*) >= 2) AS has_header
    FROM {{orders}} GROUP BY o_custkey""",
)
def file_layout(t):
    return S.layout(_lines(t)).select("file", "sep", "has_header")


@query(
    "delimited_cells",
    f"""
    WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus, {_SEP} AS sep, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k,
      count(*) OVER (PARTITION BY o_custkey) AS n, min(o_orderkey) OVER (PARTITION BY o_custkey) AS h,
      first(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS hs FROM {{orders}}),
    b AS (SELECT *, NOT (o_custkey % 3 = 0 AND n >= 2) AS head FROM o),
    c AS (SELECT * FROM b WHERE NOT head OR k > 1)
    SELECT 'f' || CAST(o_custkey AS VARCHAR) AS file, o_orderkey AS ord, 1 AS col_pos, CASE WHEN head THEN CAST(h AS VARCHAR) ELSE 'col_1' END
      AS column_name, CAST(o_orderkey AS VARCHAR) AS value FROM c
    UNION ALL
    SELECT 'f' || CAST(o_custkey AS VARCHAR), o_orderkey, 2, CASE WHEN NOT head THEN 'col_2' WHEN o_custkey % 3 = 0 THEN 'NA' ELSE hs || sep || 'x' END,
      CASE WHEN o_custkey % 3 = 0 THEN 'NA' ELSE o_orderstatus || sep || 'x' END FROM c
    UNION ALL
    SELECT 'f' || CAST(o_custkey AS VARCHAR), o_orderkey, 3, CASE WHEN head THEN CAST(o_custkey AS VARCHAR) ELSE 'col_3' END,
      CAST(o_custkey AS VARCHAR) FROM c""",
)
def delimited_cells(t):
    return S.cells_of_lines(_lines(t))


@query(
    "latin1_lines",
    "SELECT conv_id, turn, md5(text) AS text_md5 FROM {conversations}",
)
def latin1_lines(t):
    lines = t.conversations.select(
        F.col("conv_id").alias("file"),
        F.col("turn").alias("ord"),
        F.expr("CASE WHEN conv_id % 2 = 0 THEN CAST(encode(text, 'ISO-8859-1') AS STRING) ELSE text END").alias("line"),
    )
    return S.decode_lines(lines).select(
        F.col("file").alias("conv_id"), F.col("ord").alias("turn"), F.md5("line").alias("text_md5")
    )


@query(
    "load_union",
    """
    SELECT doc_id, n_chars, NULL AS quality FROM {documents} UNION ALL SELECT doc_id, NULL, quality FROM {labels}""",
)
def load_union(t):
    return S.load_union([t.documents.select("doc_id", "n_chars"), t.labels.select("doc_id", "quality")])


@query(
    "documented_columns",
    f"""
    WITH {MATCH},
    fs AS (SELECT DISTINCT paper_id, source_file, CASE WHEN source_file < 'f3' THEN 'data' ELSE 'output' END AS ft FROM {{v_cols}})
    SELECT lab.col_pos AS col_pos, label, label_status, fs.ft AS file_type FROM lab
    JOIN fs ON fs.paper_id = lab.paper_id AND fs.source_file = lab.source_file""",
)
def documented_columns(t):
    structure = t.v_cols.select("paper_id", "source_file").distinct().selectExpr(
        "paper_id", "source_file AS rel_path", "CASE WHEN source_file < 'f3' THEN 'data' ELSE 'output' END AS type", "'ex1' AS `group`"
    )
    out = X.documented_columns(t.v_cols, _labels(t), structure)
    text = F.array_join("label", X.JOINER)
    return out.select("col_pos", F.when(F.size("label") > 0, text).alias("label"), "label_status", "file_type")


@query(
    "key_sets",
    """
    WITH a AS (SELECT DISTINCT o_custkey AS k FROM {orders} WHERE o_orderstatus = 'F'),
    b AS (SELECT DISTINCT c_custkey AS k FROM {customer} WHERE c_acctbal > 0)
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS side
    FROM a FULL JOIN b ON a.k = b.k""",
)
def key_sets(t):
    a = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    return R.key_sets(a, t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), ["k"])


@query(
    "type_origin",
    """
    WITH c AS (SELECT CASE WHEN col_type IN ('categorical', 'unknown') THEN 'LLM' ELSE 'Rule' END AS origin, count(*) AS n FROM {v_cols} GROUP BY 1)
    SELECT origin, n, round(n / sum(n) OVER (), 6) AS share FROM c""",
)
def type_origin(t):
    counts = t.v_cols.groupBy(G.column_type_origin(F.col("col_type")).alias("origin")).agg(F.count("*").alias("n"))
    return rounded(M.share_within(counts, []))


@query(
    "folder_words",
    r"""
    SELECT item_id, array_to_string(list_slice(list_filter(list_transform(regexp_split_to_array(trim(text), '\s+'),
      lambda w: regexp_replace(w, '[^A-Za-z0-9_-]', '', 'g')), lambda w: w <> ''), 1, 5), '_') AS folder,
      'doi_10.1_' || CAST(item_id AS VARCHAR) AS safe_id FROM {benchmark}""",
)
def folder_words(t):
    return t.benchmark.select(
        "item_id", PF.folder_words(F.col("text")).alias("folder"),
        PF.safe_id(F.concat(F.lit("doi:10.1/"), F.col("item_id").cast("string"))).alias("safe_id"),
    )


@query(
    "top_within",
    """
    SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k
      FROM {orders}) q WHERE k <= 3""",
)
def top_within(t):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return R.top_within(t.orders, ["o_custkey"], order, 3).select("o_custkey", "o_orderkey")


@query(
    "incremental_log",
    "SELECT event_id, event_type, round(value, 6) AS value FROM {events}",
)
def incremental_log(t):
    """The event table arrives as a stream of files, is logged batch by batch and read back."""
    folder = f"{shared_folder(t.spark)}/stream-{uuid4().hex}"
    arriving = I.arrivals(t.spark, f"{t.sf_dir}/events.parquet*", t.events.schema)
    work = I.append_log(f"{folder}/log", ["event_id"])
    I.run_available(arriving.select("event_id", "event_type", "value"), work, f"{folder}/state").awaitTermination()
    return rounded(I.read_log(t.spark, f"{folder}/log", ["event_id"]))


@query(
    "last_of_log",
    """
    SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM {events}) q WHERE k = 1""",
)
def last_of_log(t):
    """The last event of every user, from a log whose batches repeat users very often."""
    folder = f"{shared_folder(t.spark)}/stream-{uuid4().hex}"
    arriving = I.arrivals(t.spark, f"{t.sf_dir}/events.parquet*", t.events.schema).select("user_id", "event_id", "event_type", "ts")
    order = ["ts", "event_id"]
    I.run_available(arriving, I.append_log(f"{folder}/log", ["user_id"], order), f"{folder}/state").awaitTermination()
    return I.read_log(t.spark, f"{folder}/log", ["user_id"], order).select("user_id", "event_id", "event_type")


def _written(t) -> str:
    """Customers as delimited files below ``osf/<nation>/``: tabs or semicolons, with and without a header."""
    root = f"{shared_folder(t.spark)}/collection-{uuid4().hex}"
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    rows = rows.toDF("c_custkey", "c_name", "c_text", "c_nationkey")
    for part, sep in ((0, ";"), (1, "\t")):
        rows.where(F.col("c_custkey") % 3 == part).write.csv(f"{root}/osf/n{part}", sep=sep, header=True, quoteAll=True)
    rows.where("c_custkey % 3 = 2").select("c_custkey", "c_nationkey").write.csv(f"{root}/osf/n2", sep="|")
    return root


@query(
    "file_inventory",
    """
    SELECT CASE WHEN o_orderstatus = 'F' THEN 'osf' ELSE 'dataverse' END AS source, '_p' || CAST(o_custkey % 5 AS VARCHAR) AS paper_id,
      'txt' AS ext, sum(strlen(CAST(o_orderkey AS VARCHAR)) + 1) AS bytes FROM {orders} GROUP BY 1, 2""",
)
def file_inventory(t):
    """Order keys written as text files of ten repositories, then listed again."""
    root = f"{shared_folder(t.spark)}/inventory-{uuid4().hex}"
    rows = t.orders.selectExpr(
        "CASE WHEN o_orderstatus = 'F' THEN 'osf' ELSE 'dataverse' END AS source", "CAST(o_custkey % 5 AS STRING) AS p", "CAST(o_orderkey AS STRING) AS k"
    )
    rows.write.partitionBy("source", "p").text(root)
    found = S.file_inventory(t.spark, root).where("ext = 'txt'").withColumn("source", F.expr("substring_index(source, '=', -1)"))
    return found.groupBy("source", F.concat(F.lit("_p"), F.expr("substring_index(paper_id, '=', -1)")).alias("paper_id"), "ext").agg(
        F.sum("size").alias("bytes")
    )


@query(
    "read_collection",
    f"""
    WITH c AS (SELECT c_custkey % 3 AS p, c_custkey, c_name, c_mktsegment AS c_text, c_nationkey FROM {{customer}}),
    cells AS (SELECT p, unnest(['c_custkey', 'c_name', 'c_text', 'c_nationkey']) AS column_name,
        unnest([CAST(c_custkey AS VARCHAR), c_name, c_text, CAST(c_nationkey AS VARCHAR)]) AS value FROM c WHERE p < 2
      UNION ALL SELECT p, unnest(['col_1', 'col_2']), unnest([CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR)]) FROM c WHERE p = 2)
    SELECT 'n' || CAST(p AS VARCHAR) AS folder, column_name, value, count(*) AS n FROM cells GROUP BY 1, 2, 3""",
)
def read_collection(t):
    cells = S.read_cells(t.spark, f"{_written(t)}/osf")
    folder = F.regexp_extract("file", "/osf/(n[0-9])/", 1)
    return cells.groupBy(folder.alias("folder"), "column_name", "value").agg(F.count("*").alias("n"))


@query(
    "read_delimited_mixed",
    f"""
    SELECT CASE WHEN c_custkey % 3 < 2 THEN c_custkey END AS c_custkey, CASE WHEN c_custkey % 3 < 2 THEN c_name END AS c_name,
      CASE WHEN c_custkey % 3 < 2 THEN c_mktsegment END AS c_text, CASE WHEN c_custkey % 3 < 2 THEN c_nationkey END AS c_nationkey,
      CASE WHEN c_custkey % 3 = 2 THEN c_custkey END AS col_1, CASE WHEN c_custkey % 3 = 2 THEN c_nationkey END AS col_2 FROM {{customer}}""",
)
def read_delimited_mixed(t):
    return S.read_delimited(t.spark, f"{_written(t)}/osf")


@query(
    "folder_names",
    r"""
    WITH s AS (SELECT item_id, text, array_to_string(list_slice(list_filter(list_transform(regexp_split_to_array(trim(text), '\s+'),
      lambda w: regexp_replace(w, '[^A-Za-z0-9_-]', '', 'g')), lambda w: w <> ''), 1, 5), '_') AS short FROM {benchmark})
    SELECT item_id, CASE WHEN short = replace(text, ' ', '_') THEN short ELSE short || '-' || substr(md5(text), 1, 12) END AS folder FROM s""",
)
def folder_names(t):
    return t.benchmark.select("item_id", PF.folder_name(F.col("text")).alias("folder"))


@query(
    "stream_upsert",
    """
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1 - quality ELSE quality END AS quality FROM {labels}""",
)
def stream_upsert(t):
    """Labels arrive as a stream, then changes of every third twice: an upsert that broke off, and its repetition."""
    folder = f"{shared_folder(t.spark)}/upsert-{uuid4().hex}"
    labels = t.labels.select("doc_id", "quality")
    arriving = I.arrivals(t.spark, f"{t.sf_dir}/labels.parquet*", t.labels.schema).select("doc_id", "quality")
    I.run_available(arriving, I.upsert_rows(f"{folder}/table", ["doc_id"], partitions=16), f"{folder}/state").awaitTermination()
    table = I.KeyedTable(t.spark, f"{folder}/table", ["doc_id"], 16)
    changed = labels.where("doc_id % 3 = 0").withColumn("quality", (1 - F.col("quality")).cast(labels.schema["quality"].dataType))
    number = table.versions()[-1] + 1
    half = changed.where("doc_id % 2 = 0").withColumn("part", F.lit(0))
    half.write.partitionBy("part").parquet(f"{folder}/table/data/version={number}")  # no pointer: not seen
    table.upsert(changed, number)
    table.upsert(changed, number)
    return table.read()


@query(
    "archive_members",
    """
    WITH c AS (SELECT c_custkey, c_nationkey, c_name FROM {customer})
    SELECT column_name, value, count(*) AS n FROM (
      SELECT 'c_custkey' AS column_name, CAST(c_custkey AS VARCHAR) AS value FROM c
      UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM c UNION ALL SELECT 'c_name', c_name FROM c) q GROUP BY 1, 2""",
)
def archive_members(t):
    """Customers written as zipped, gzipped and bzip2 tables and read back out of the archives."""
    root = f"{shared_folder(t.spark)}/archives-{uuid4().hex}"
    rows = t.customer.select("c_custkey", "c_nationkey", "c_name")
    E.write_zipped(rows.where("c_custkey % 3 = 0"), f"{root}/zip")
    for part, kind in ((1, "gzip"), (2, "bzip2")):
        rows.where(F.col("c_custkey") % 3 == part).write.csv(f"{root}/{kind}", header=True, compression=kind)
    files = S.list_files(t.spark, t.spark.createDataFrame([(root,)], "folder string"))
    cells = S.cells_of_lines(S.decode_lines(S.lines_of_archives(files)))
    return cells.groupBy("column_name", "value").agg(F.count("*").alias("n"))


_WIDE = """
    SELECT p_partkey AS ord, 'p' || CAST(p_partkey % 150 AS STRING) AS paper_id,
      'q' || CAST(p_size % 9 AS STRING) || '-' || CAST(p_size % 9 + CASE WHEN p_size % 4 = 0 THEN 10000000000 ELSE p_size % 5 END AS STRING)
        AS codebook_variable, p_name AS label, 'codebook.csv' AS codebook_source, CAST(NULL AS STRING) AS "group", 'structured' AS parse_method
    FROM {part}"""


@query(
    "range_join",
    f"""
    WITH b AS (SELECT ord, paper_id, label, CAST(split_part(substr(codebook_variable, 2), '-', 1) AS BIGINT) AS a,
      CAST(split_part(codebook_variable, '-', 2) AS BIGINT) AS z FROM ({_WIDE}) q),
    n AS (SELECT DISTINCT paper_id, CAST(right(column_name, 1) AS BIGINT) * 1234567891 + 3 AS nr FROM {{v_cols}}
      UNION SELECT paper_id, CAST(right(column_name, 1) AS BIGINT) FROM {{v_cols}})
    SELECT n.paper_id AS paper_id, 'q' || CAST(nr AS VARCHAR) AS name, b.ord AS ord, label FROM n JOIN b ON b.paper_id = n.paper_id AND nr BETWEEN a AND z""",
)
def range_join(t):
    """Which ranges of a dictionary, some of ten thousand million numbers, hold a name."""
    book = t.spark.sql(_WIDE.replace('"group"', "`group`"), part=t.part)
    digit = F.right("column_name", F.lit(1)).cast("bigint")
    numbers = F.explode(F.array(digit, digit * 1234567891 + 3))
    names = t.v_cols.select("paper_id", numbers.alias("nr")).distinct().select("paper_id", F.concat(F.lit("q"), F.col("nr").cast("string")).alias("_norm"))
    found = X.entries_of_names(names, book)
    return found.select("paper_id", F.col("_norm").alias("name"), F.col("ord.ord").alias("ord"), "label")
