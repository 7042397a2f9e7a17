"""Views over the given tables in the shape the operators expect.

Every view is one SELECT in the SQL that Spark and the oracle share, over whole
tables. ``{name}`` stands for a given table or an earlier view.
"""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from tablewarden.session import tune

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

FILE_CLASSES = ["asset", "code", "codebook", "data", "output", "readme", "supplemental"]
CONFIGS = ["m120_md", "m20_json", "m20_md"]


# Classes by extension number k; kept flat so that no expression nests in another.
_TRUE = (
    "CASE k WHEN 0 THEN 'data' WHEN 1 THEN 'data' WHEN 2 THEN 'code' WHEN 3 THEN 'supplemental' "
    "WHEN 4 THEN 'code' WHEN 5 THEN 'asset' WHEN 6 THEN 'data' ELSE 'codebook' END"
)
_WRONG = (
    "CASE k WHEN 0 THEN 'code' WHEN 1 THEN 'code' WHEN 2 THEN 'data' WHEN 3 THEN 'output' "
    "WHEN 4 THEN 'data' WHEN 5 THEN 'data' WHEN 6 THEN 'code' ELSE 'readme' END"
)


def _scored(config: str, modulus: int) -> str:
    return f"""
    SELECT ord, paper_id, rel_path, ext, size, type_gt, '{config}' AS config,
      CASE WHEN ord % 53 = 0 THEN 'llm_error' WHEN ord % 97 = 0 THEN NULL
           WHEN ord % {modulus} = 0 THEN {_WRONG} ELSE {_TRUE} END AS type,
      "group" AS group_gt,
      CASE WHEN ord % 89 = 0 THEN NULL WHEN ord % 11 = 0 THEN 'shared' ELSE "group" END AS "group",
      CASE WHEN k IN (0, 1, 6) THEN CASE WHEN j % 2 = 0 THEN 'individual' ELSE 'combined' END END
        AS data_granularity_gt,
      CASE WHEN k IN (0, 1, 6) THEN
        CASE WHEN (j % 2 = 0) <> (ord % 13 = 0) THEN 'individual' ELSE 'combined' END END AS data_granularity,
      CASE WHEN k IN (0, 1, 6) THEN CASE WHEN k = 6 THEN 'raw' ELSE 'tabular' END END AS data_format_gt,
      CASE WHEN k IN (0, 1, 6) THEN
        CASE WHEN (k = 6) <> (ord % 17 = 0) THEN 'raw' ELSE 'tabular' END END AS data_format,
      CASE ord % 3 WHEN 0 THEN 'llm' WHEN 1 THEN 'aggregate_llm' ELSE 'fixed_ext_rule' END AS type_source,
      CAST(floor(ord / 30) AS BIGINT) AS prompt_nr
    FROM {{v_files}}"""


VIEWS = {
    # one file per document
    "v_files": f"""
    SELECT ord, paper_id, lang, size, j, k, folder, stem || '.' || ext AS name, ext, {_TRUE} AS type_gt,
      CASE WHEN m = 4 THEN stem || '.' || ext ELSE folder || '/' || stem || '.' || ext END AS rel_path,
      CASE k % 4 WHEN 0 THEN 'ex1' WHEN 1 THEN 'ex2' WHEN 2 THEN 'pilot1' ELSE 'shared' END AS "group",
      CASE WHEN m IN (0, 5) THEN folder END AS aggregate_folder
    FROM (
      SELECT ord, paper_id, lang, size, j, k, m,
        CASE WHEN j % 3 = 0 THEN 'sub' ELSE 'doc_' END || CAST(ord AS STRING) AS stem,
        CASE k WHEN 0 THEN 'csv' WHEN 1 THEN 'txt' WHEN 2 THEN 'r' WHEN 3 THEN 'pdf'
          WHEN 4 THEN 'rmd' WHEN 5 THEN 'png' WHEN 6 THEN 'mat' ELSE 'html' END AS ext,
        CASE m WHEN 0 THEN 'data/sub' || CAST(j AS STRING) WHEN 1 THEN 'node_modules/x' WHEN 2 THEN 'src/build'
          WHEN 3 THEN 'Study ' || CAST(j % 3 + 1 AS STRING) || '/data' WHEN 4 THEN '' ELSE 'logs' END AS folder
      FROM (
        SELECT doc_id AS ord, source AS paper_id, lang, n_chars AS size, CAST(floor(doc_id / 20) AS BIGINT) AS j,
          (doc_id + CAST(floor(doc_id / 20) AS BIGINT)) % 8 AS k,
          (doc_id + 3 * CAST(floor(doc_id / 20) AS BIGINT)) % 6 AS m
        FROM {{documents}}) a
      ) b""",
    "v_scored": _scored("m20_md", 7),
    "v_scored_120": _scored("m120_md", 9),
    "v_scored_json": _scored("m20_json", 5),
    "v_scored_cfg": """
    SELECT * FROM {v_scored} UNION ALL SELECT * FROM {v_scored_120} UNION ALL SELECT * FROM {v_scored_json}""",
    # one run per event
    "v_runs": """
    SELECT event_id, 'p' || CAST(user_id AS STRING) AS paper_id, ts, event_id % 3 AS temperature,
      event_id % 4 AS repeat, event_type,
      CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'no_data' ELSE 'ok' END AS status,
      event_type <> 'error' AS success,
      CASE WHEN event_type = 'error' THEN
        CASE event_id % 4 WHEN 0 THEN 'no_links: paper has none' WHEN 1 THEN 'download_failed: timeout'
          WHEN 2 THEN 'invalid UTF-8 byte' ELSE 'no_data_files' END END AS error,
      value * 1000 AS elapsed_ms,
      CASE WHEN event_id % 10 <> 0 THEN value * 10 END AS download_ms,
      CASE WHEN event_id % 7 <> 0 THEN value * 300 END AS llm_ms,
      value * 50 AS column_ms
    FROM {events}""",
    # one table column per event
    "v_cols": """
    SELECT 'p' || CAST(user_id AS STRING) AS paper_id, 'f' || CAST(event_id % 5 AS STRING) || '.csv' AS source_file,
      event_id AS col_pos,
      CASE event_id % 3 WHEN 0 THEN 'Q_' WHEN 1 THEN 'q__' ELSE ' q ' END
        || CAST(CAST(floor(event_id / 3) AS BIGINT) % 9 AS STRING) AS column_name,
      CASE event_id % 4 WHEN 0 THEN 'ex1' WHEN 1 THEN 'ex2' WHEN 2 THEN NULL ELSE 'shared' END AS "group",
      CASE event_type WHEN 'click' THEN 'continuous' WHEN 'error' THEN 'unknown' WHEN 'purchase' THEN 'binary'
        WHEN 'signup' THEN 'categorical' ELSE 'text' END AS col_type
    FROM {events}""",
    # one dictionary row per part
    "v_book": """
    SELECT p_partkey AS ord, 'p' || CAST(p_partkey % 150 AS STRING) AS paper_id,
      CASE WHEN p_size % 17 = 0 THEN 'Q' || CAST(p_size % 5 AS STRING) || '-' || CAST(p_size % 7 AS STRING)
        ELSE CASE WHEN p_size % 2 = 0 THEN 'q ' ELSE 'Q_' END
          || CAST(CAST(floor(p_partkey / 150) AS BIGINT) % 7 AS STRING) END AS codebook_variable,
      CASE WHEN p_size % 5 = 0 THEN 'Participants'' responses' WHEN p_size % 5 = 1 THEN 'participants response'
        ELSE p_name END AS label,
      CASE p_size % 3 WHEN 0 THEN 'README.md' WHEN 1 THEN 'codebook.csv' ELSE 'data.sav' END AS codebook_source,
      CASE p_size % 4 WHEN 0 THEN 'ex1' WHEN 1 THEN 'ex2' ELSE NULL END AS "group",
      CASE p_size % 3 WHEN 0 THEN 'llm' WHEN 1 THEN 'structured' ELSE 'haven' END AS parse_method
    FROM {part}""",
}


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(f for _, f, _, _ in Formatter().parse(sql) if f))


class Tables:
    """The given tables and the views over them, read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in VIEWS:
            sql = VIEWS[name].replace('"group"', "`group`")
            return self.spark.sql(sql, **{n: getattr(self, n) for n in _names(sql)})
        raise AttributeError(name)


def oracle(sql: str) -> str:
    """A query with the views it names as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _names(text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    plain = {n: n for n in [*TABLES, *VIEWS]}
    body = sql.format(**plain).strip()
    if not needed:
        return body
    parts = ",\n".join(f"{n} AS ({VIEWS[n].format(**plain)})" for n in needed)
    if body[:4].upper() == "WITH":
        return f"WITH {parts},\n{body[4:].strip()}"
    return f"WITH {parts}\n{body}"


class Family:
    """Queries by name, each with its oracle where SQL can say it."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def register(build: Callable[[Tables], DataFrame]):
            self.queries[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
            if sql is not None:
                self.oracles[name] = oracle(sql)
            return build

        return register
