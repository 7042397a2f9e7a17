"""Queries over column profiles and type inference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators import profile as P
from tablewarden.plans.views import Family

FAMILY = Family()
query = FAMILY.add

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_orderkey", "l_partkey", "l_suppkey"]
ORDER_NUMBERS = ["o_totalprice", "o_custkey", "o_orderkey"]
STATS = ["mean", "sd", "se", "median", "min", "max", "range", "p25", "p75", "iqr", "skewness", "kurtosis"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
            for f in df.schema
        ]
    )


def _stats_sql(value: str, by: str = "") -> str:
    """Statistics per group of a frame ``x`` with a double column."""
    v = value
    return f"""
      SELECT {by} count({v}) AS n, avg({v}) AS mean, stddev_samp({v}) AS sd,
        median({v}) AS median, min({v}) AS min, max({v}) AS max,
        quantile_cont({v}, 0.25) AS p25, quantile_cont({v}, 0.75) AS p75,
        avg({v}) AS m1, avg({v}*{v}) AS m2, avg({v}*{v}*{v}) AS m3, avg({v}*{v}*{v}*{v}) AS m4"""


STAT_COLUMNS = """
  round(mean, 6) AS mean, CASE WHEN n > 1 THEN round(sd, 6) END AS sd,
  CASE WHEN n > 1 THEN round(sd / sqrt(n), 6) END AS se, round(median, 6) AS median,
  round(min, 6) AS min, round(max, 6) AS max, round(max - min, 6) AS "range",
  round(p25, 6) AS p25, round(p75, 6) AS p75, round(p75 - p25, 6) AS iqr,
  CASE WHEN n > 2 AND sd > 0 THEN round((m3 - 3*m1*m2 + 2*m1*m1*m1) / (sd*sd*sd), 6) END AS skewness,
  CASE WHEN n > 3 AND sd > 0 THEN
    round((m4 - 4*m1*m3 + 6*m1*m1*m2 - 3*m1*m1*m1*m1) / (sd*sd*sd*sd) - 3, 6) END AS kurtosis"""


def _union(table: str, columns: list[str], by: str = "", scale: dict | None = None) -> str:
    scale = scale or {}
    return " UNION ALL ".join(
        f"SELECT {by} '{c}' AS column_name, {i} AS col_pos, CAST({c} AS DOUBLE) AS v FROM {table}"
        for i, c in enumerate(columns, 1)
    )


@query(
    "profile_lineitem",
    f"""
    WITH x AS ({_union('{lineitem}', LINE_NUMBERS)}),
    s AS ({_stats_sql('v', 'column_name, col_pos, count(*) - count(v) AS n_missing, count(DISTINCT v) AS n_unique,')}
      FROM x GROUP BY column_name, col_pos)
    SELECT column_name, col_pos, n, n_missing, n_unique, {STAT_COLUMNS} FROM s""",
)
def profile_lineitem(t):
    return rounded(P.profile_table(t.lineitem, LINE_NUMBERS))


@query(
    "profile_orders_by_status",
    f"""
    WITH x AS ({_union('{orders}', ORDER_NUMBERS, 'o_orderstatus,')}),
    s AS ({_stats_sql('v', 'o_orderstatus, column_name, col_pos, count(*) - count(v) AS n_missing, count(DISTINCT v) AS n_unique,')}
      FROM x GROUP BY o_orderstatus, column_name, col_pos)
    SELECT o_orderstatus, column_name, col_pos, n, n_missing, n_unique, {STAT_COLUMNS} FROM s""",
)
def profile_orders_by_status(t):
    return rounded(P.profile_table(t.orders, ORDER_NUMBERS, ["o_orderstatus"]))


def _cells_sql(table: str, ord_: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {i} AS col_pos, {ord_} AS ord, {expr} AS value FROM {table}"
        for i, (name, expr) in enumerate(columns.items(), 1)
    )


def _types_sql(cells: str) -> str:
    number = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"
    return rf"""
    WITH cells AS ({cells}),
    c AS (SELECT column_name, col_pos, ord, CASE WHEN value <> 'NA' THEN value END AS value FROM cells),
    d AS (
      SELECT column_name, col_pos, value, count(*) AS c, min(ord) AS o,
        CASE WHEN regexp_matches(value, {number}) THEN try_cast(trim(value) AS DOUBLE) END AS num,
        CASE WHEN regexp_matches(replace(value, ',', '.'), {number})
          THEN try_cast(trim(replace(value, ',', '.')) AS DOUBLE) END AS comma,
        value IS NOT NULL AND trim(value) <> '' AS filled
      FROM c GROUP BY column_name, col_pos, value),
    lens AS (
      SELECT column_name, median(length(value)) AS mid_all,
        median(CASE WHEN trim(value) <> '' THEN length(value) END) AS mid_filled FROM c GROUP BY column_name),
    f AS (
      SELECT column_name, col_pos, sum(c) AS rows_, sum(CASE WHEN value IS NOT NULL THEN c ELSE 0 END) AS nv,
        sum(CASE WHEN filled THEN c ELSE 0 END) AS nf, sum(CASE WHEN num IS NOT NULL THEN c ELSE 0 END) AS nn,
        sum(CASE WHEN comma IS NOT NULL THEN c ELSE 0 END) AS nc, count(value) AS ut, count(DISTINCT num) AS un,
        coalesce(bool_or(num <> floor(num)), false) AS frac
      FROM d GROUP BY column_name, col_pos),
    g AS (SELECT f.*, nf > 0 AND nn = nf AS numeric_, lens.mid_all, lens.mid_filled FROM f JOIN lens USING (column_name)),
    r AS (SELECT column_name, value FROM d WHERE value IS NOT NULL),
    dates AS (
      SELECT column_name, avg(CASE WHEN try_strptime(regexp_extract(value, '^\s*([0-9]{{{{4}}}}-[0-9]{{{{1,2}}}}-[0-9]{{{{1,2}}}})', 1), '%Y-%m-%d') IS NOT NULL
          OR try_strptime(regexp_extract(value, '^\s*([0-9]{{{{4}}}}/[0-9]{{{{1,2}}}}/[0-9]{{{{1,2}}}})', 1), '%Y/%m/%d') IS NOT NULL
          THEN 1.0 ELSE 0.0 END) AS share FROM r GROUP BY column_name),
    h AS (
      SELECT g.*, coalesce(dates.share, 0) AS share,
        CASE WHEN numeric_ OR nf = 0 THEN nf ELSE nv END AS n,
        CASE WHEN numeric_ THEN un WHEN nf = 0 THEN 0 ELSE ut END AS u,
        CASE WHEN numeric_ THEN mid_filled ELSE mid_all END AS mid
      FROM g LEFT JOIN dates USING (column_name)),
    types AS (
      SELECT column_name, col_pos, n, rows_ - n AS n_missing, u AS n_unique, numeric_, nc,
        CASE WHEN n = 0 THEN 'empty'
          WHEN regexp_matches(lower(column_name), '^(participant|subject|subj|respondent|pp|ppt|pid|sub|id)$|[_.-](id|number|num|nr|no|code)$') THEN 'id'
          WHEN u = 1 THEN 'constant' WHEN u = 2 THEN 'binary' WHEN share >= 0.7 THEN 'date'
          WHEN mid > 40 THEN 'text'
          WHEN numeric_ THEN 'continuous'
          WHEN nc / n >= 0.95 THEN 'continuous_comma_decimal'
          WHEN nc / n >= 0.8 THEN 'continuous_outliers_excluded' ELSE 'text' END AS col_type,
        mid
      FROM h)
    SELECT column_name, col_pos, CAST(n AS BIGINT) AS n, CAST(n_missing AS BIGINT) AS n_missing,
      CAST(n_unique AS BIGINT) AS n_unique, col_type,
      CASE WHEN col_type = 'text' AND mid <= 40 THEN 'fallback' ELSE 'rules' END AS col_type_method,
      CASE WHEN col_type IN ('continuous_comma_decimal', 'continuous_outliers_excluded')
        THEN CAST(n - nc AS BIGINT) END AS n_coerced FROM types"""


def _resolved(cells: DataFrame) -> DataFrame:
    return P.resolve_types(P.infer_types(cells)).drop("is_numeric")


CUSTOMER = {
    "c_custkey": "CAST(c_custkey AS STRING)",
    "customer_id": "c_name",
    "c_nationkey": "CAST(c_nationkey AS STRING)",
    "c_acctbal": "CAST(c_acctbal AS STRING)",
    "c_mktsegment": "c_mktsegment",
    "c_side": "CASE WHEN c_nationkey < 12 THEN 'low' ELSE 'high' END",
    "c_none": "CASE WHEN c_custkey >= 0 THEN 'NA' END",
    "c_blank": "CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE CAST(c_nationkey AS STRING) END",
}


@query("infer_types_customer", _types_sql(_cells_sql("{customer}", "c_custkey", CUSTOMER)))
def infer_types_customer(t):
    table = t.customer.selectExpr("c_custkey AS ord", *[f"{e} AS {n}" for n, e in CUSTOMER.items()])
    return _resolved(P.long_form(table, list(CUSTOMER), ["ord"]))


EVENTS = {
    "event_type": "event_type",
    "day": "substr(CAST(ts AS STRING), 1, 10)",
    "value": "CAST(value AS STRING)",
    "props": "props",
    "long_text": "'a description of the event that is long: ' || event_type || CAST(user_id AS STRING)",
    "user-id": "CAST(user_id AS STRING)",
}


@query("infer_types_events", _types_sql(_cells_sql("{events}", "event_id", EVENTS)))
def infer_types_events(t):
    table = t.events.selectExpr("event_id AS ord", *[f"{e} AS `{n}`" for n, e in EVENTS.items()])
    return _resolved(P.long_form(table, list(EVENTS), ["ord"]))


PART = {
    "price_comma": "replace(CAST(p_retailprice AS STRING), '.', ',')",
    "price_some": "CASE WHEN p_partkey % 8 = 0 THEN 'n/a' ELSE replace(CAST(p_retailprice AS STRING), '.', ',') END",
    "price_few": "CASE WHEN p_partkey % 3 = 0 THEN 'n/a' ELSE replace(CAST(p_retailprice AS STRING), '.', ',') END",
    "p_size": "CAST(p_size AS STRING)",
}


@query(
    "comma_decimal",
    f"""
    WITH cells AS ({_cells_sql('{part}', 'p_partkey', PART)}),
    x AS (SELECT column_name, col_pos, try_cast(replace(value, ',', '.') AS DOUBLE) AS v FROM cells
      WHERE column_name <> 'price_few'),
    s AS ({_stats_sql('v', "column_name, col_pos, count(*) AS rows_,")} FROM x GROUP BY column_name, col_pos),
    k AS (SELECT column_name, count(DISTINCT value) AS u FROM cells GROUP BY column_name)
    SELECT column_name, col_pos, k.u AS n_unique,
      CASE column_name WHEN 'price_comma' THEN 'continuous_comma_decimal'
        WHEN 'price_some' THEN 'continuous_outliers_excluded' WHEN 'p_size' THEN 'continuous' ELSE 'text' END AS col_type,
      CASE WHEN column_name LIKE 'price_%e' OR column_name = 'price_comma' THEN
        CASE WHEN column_name <> 'p_size' THEN rows_ - s.n END END AS n_coerced, {STAT_COLUMNS}
    FROM k LEFT JOIN s USING (column_name)
    WHERE col_pos IS NOT NULL
    UNION ALL
    SELECT column_name, 3, u, 'text', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
    FROM k WHERE column_name = 'price_few'""",
)
def comma_decimal(t):
    table = t.part.selectExpr("p_partkey AS ord", *[f"{e} AS {n}" for n, e in PART.items()])
    out = P.describe_columns(P.long_form(table, list(PART), ["ord"]))
    return rounded(out.select("column_name", "col_pos", "n_unique", "col_type", "n_coerced", *STATS))


@query(
    "sample_values",
    """
    WITH c AS (
      SELECT 'event_type' AS column_name, event_id AS ord, event_type AS value FROM {events} UNION ALL
      SELECT 'value', event_id, CAST(value AS VARCHAR) FROM {events} UNION ALL
      SELECT 'user_id', event_id, CAST(user_id AS VARCHAR) FROM {events} UNION ALL
      SELECT 'ts', event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') FROM {events} UNION ALL
      SELECT 'props', event_id, props FROM {events}),
    a AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY ord) AS k FROM c WHERE value IS NOT NULL),
    u AS (SELECT column_name, value, min(ord) AS ord FROM c WHERE value IS NOT NULL GROUP BY column_name, value),
    b AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY ord) AS k FROM u)
    SELECT column_name, first5.s AS sample_values, string_agg(b.value, ', ' ORDER BY b.ord) AS sample_values_unique
    FROM b JOIN (SELECT column_name, string_agg(value, ' | ' ORDER BY ord) AS s FROM a WHERE k <= 5
      GROUP BY column_name) first5 USING (column_name)
    WHERE k <= 20 GROUP BY column_name, first5.s""",
)
def sample_values(t):
    rows = t.events.withColumnRenamed("event_id", "ord").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    cells = P.long_form(rows, ["event_type", "value", "user_id", "ts", "props"], ["ord"])
    return (
        P.sample_values(cells)
        .join(P.distinct_samples(cells), ["col_pos", "column_name"])
        .select("column_name", "sample_values", "sample_values_unique")
    )


@query(
    "header_strip",
    """
    WITH r AS (
      SELECT o_custkey AS file, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS row_nr,
        o_orderkey, o_custkey % 3 AS k, o_custkey % 4 AS spot FROM {orders}),
    m AS (SELECT *, k = 0 AND row_nr = spot AS mark, count(*) OVER (PARTITION BY file) AS n FROM r),
    h AS (SELECT file, min(row_nr) AS hit FROM m WHERE mark AND row_nr <= 3 AND n >= 2 GROUP BY file)
    SELECT file, m.o_orderkey AS o_orderkey, m.row_nr AS row_nr FROM m LEFT JOIN h USING (file)
    WHERE hit IS NULL OR row_nr > hit""",
)
def header_strip(t):
    from tablewarden.operators.scale import positions

    rows = positions(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey", out="row_nr").select(
        F.col("o_custkey").alias("file"),
        "o_orderkey",
        "row_nr",
        F.expr(
            "array('x', CASE WHEN o_custkey % 3 = 0 AND row_nr = o_custkey % 4 "
            "THEN '{\"ImportId\":\"QID1\"}' ELSE '1' END)"
        ).alias("cells"),
    )
    return P.strip_export_header(rows, ["file"], "row_nr", "cells").select("file", "o_orderkey", "row_nr")


@query(
    "read_budget",
    """
    WITH RECURSIVE f AS (
      SELECT source AS paper_id, doc_id, n_chars AS s FROM {documents} WHERE n_chars <= 20000),
    o AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY doc_id) AS k FROM f),
    walk AS (
      SELECT paper_id, k, doc_id, CASE WHEN s <= 40000 THEN s ELSE 0 END AS used, s <= 40000 AS ok FROM o WHERE k = 1
      UNION ALL
      SELECT o.paper_id, o.k, o.doc_id, CASE WHEN w.used + o.s <= 40000 THEN w.used + o.s ELSE w.used END,
        w.used + o.s <= 40000 FROM walk w JOIN o ON o.paper_id = w.paper_id AND o.k = w.k + 1)
    SELECT d.source AS paper_id, d.doc_id AS doc_id, d.n_chars AS size, coalesce(w.ok, false) AS is_read
    FROM {documents} d LEFT JOIN walk w ON w.paper_id = d.source AND w.doc_id = d.doc_id""",
)
def read_budget(t):
    files = t.documents.selectExpr("source AS paper_id", "doc_id", "n_chars AS size")
    return P.read_budget(files, ["paper_id"], "doc_id", "size", file_cap=20_000, total_cap=40_000)


@query(
    "type_distribution",
    """
    SELECT col_type, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM {v_cols}), 6) AS pct
    FROM {v_cols} GROUP BY col_type""",
)
def type_distribution(t):
    return rounded(P.type_distribution(t.v_cols))


@query(
    "weighted_distribution",
    """
    WITH p AS (SELECT paper_id, count(*) AS size FROM {v_cols} GROUP BY paper_id),
    c AS (SELECT paper_id, col_type, count(*) AS n FROM {v_cols} GROUP BY paper_id, col_type),
    g AS (SELECT paper_id, size, t.col_type AS col_type FROM p, (SELECT DISTINCT col_type FROM {v_cols}) t)
    SELECT g.col_type AS col_type, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n,
      round(100.0 * avg(coalesce(n, 0) / size), 6) AS avg_pct
    FROM g LEFT JOIN c ON c.paper_id = g.paper_id AND c.col_type = g.col_type GROUP BY g.col_type""",
)
def weighted_distribution(t):
    return rounded(P.weighted_type_distribution(t.v_cols))


@query(
    "unknown_rate",
    """
    SELECT paper_id, count(*) AS n_columns, count(*) FILTER (WHERE col_type = 'unknown') AS n_unknown,
      round(count(*) FILTER (WHERE col_type = 'unknown') / count(*), 6) AS rate
    FROM {v_cols} GROUP BY paper_id HAVING count(*) FILTER (WHERE col_type = 'unknown') / count(*) > 0.2""",
)
def unknown_rate(t):
    return rounded(P.unknown_rate(t.v_cols, threshold=0.2))


@query(
    "without_columns",
    """
    SELECT DISTINCT 'p' || CAST(c_custkey AS VARCHAR) AS paper_id FROM {customer}
    WHERE 'p' || CAST(c_custkey AS VARCHAR) NOT IN (SELECT paper_id FROM {v_cols})""",
)
def without_columns(t):
    runs = t.customer.selectExpr("'p' || CAST(c_custkey AS STRING) AS paper_id", "true AS success")
    return P.without_columns(runs, t.v_cols).select("paper_id")


@query(
    "reported_vs_computed",
    f"""
    WITH x AS ({_union('{lineitem}', ['l_quantity', 'l_tax'])}),
    s AS ({_stats_sql('v', 'column_name, count(*) - count(v) AS n_missing, count(DISTINCT v) AS n_unique,')}
      FROM x GROUP BY column_name),
    c AS (UNPIVOT (SELECT column_name AS variable, CAST(n AS DOUBLE) AS n, CAST(n_missing AS DOUBLE) AS n_missing,
        mean, sd, CAST(min AS DOUBLE) AS min, CAST(max AS DOUBLE) AS max, CAST(n_unique AS DOUBLE) AS n_unique FROM s)
      ON n, n_missing, mean, sd, min, max, n_unique INTO NAME stat VALUE computed),
    r AS (SELECT 'l_' || lower(l_name) AS variable, stat, reported FROM (
      SELECT 'QUANTITY' AS l_name, stat, CASE stat WHEN 'n' THEN n0 WHEN 'n_missing' THEN 0.0 WHEN 'mean' THEN q
        WHEN 'sd' THEN 14.4 WHEN 'min' THEN 1.0 WHEN 'max' THEN 50.0 WHEN 'n_unique' THEN 50.0 END AS reported
      FROM (SELECT CAST(count(*) AS DOUBLE) AS n0, round(avg(l_quantity), 1) AS q FROM {{lineitem}}) a,
        (SELECT unnest(['n', 'n_missing', 'mean', 'sd', 'min', 'max', 'n_unique']) AS stat) b
      UNION ALL
      SELECT 'TAX', stat, CASE stat WHEN 'n' THEN n0 WHEN 'n_missing' THEN 0.0 WHEN 'mean' THEN q
        WHEN 'sd' THEN 14.4 WHEN 'min' THEN 1.0 WHEN 'max' THEN 50.0 WHEN 'n_unique' THEN 50.0 END
      FROM (SELECT CAST(count(*) AS DOUBLE) AS n0, round(avg(l_tax), 1) AS q FROM {{lineitem}}) a,
        (SELECT unnest(['n', 'n_missing', 'mean', 'sd', 'min', 'max', 'n_unique']) AS stat) b))
    SELECT c.variable AS variable, c.stat AS stat, round(computed, 6) AS computed, round(reported, 6) AS reported,
      round(abs(computed - reported), 6) AS abs_diff, coalesce(abs(computed - reported) <= 0.05, false) AS matches
    FROM c JOIN r ON c.variable = r.variable AND c.stat = r.stat""",
)
def reported_vs_computed(t):
    lines = t.lineitem
    both = ["l_quantity", "l_tax"]
    computed = P.profile_counts(lines, both).join(P.profile_moments(lines, both), ["col_pos", "column_name"])
    fixed = "'0' AS n_missing", "'14.4' AS sd", "'1' AS min", "'50' AS max", "'50' AS n_unique"
    facts = lines.agg(
        F.count("*").cast("string").alias("n"),
        F.round(F.avg("l_quantity"), 1).cast("string").alias("q"),
        F.round(F.avg("l_tax"), 1).cast("string").alias("x"),
    )
    reported = facts.selectExpr("'Quantity' AS reported_name", "n", "q AS mean", *fixed).unionByName(
        facts.selectExpr("'Tax' AS reported_name", "n", "x AS mean", *fixed)
    )
    mapping = reported.select("reported_name", F.concat(F.lit("L_"), F.upper("reported_name")).alias("variable"))
    named = mapping.withColumnRenamed("variable", "column_name")
    return rounded(P.compare_reported(computed, reported, named, tolerance=0.05))
