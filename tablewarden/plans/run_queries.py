"""Queries over run logs, repeated runs, conversions and corpus reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.functions import grading as G
from tablewarden.operators import corpus as C
from tablewarden.operators import runlog as R
from tablewarden.operators import stability as S
from tablewarden.plans.profile_queries import rounded
from tablewarden.plans.views import CONFIGS, Family
from tablewarden.session import settle

FAMILY = Family()
query = FAMILY.add


@query(
    "run_overview",
    """
    SELECT count(*) AS n_total, count(*) FILTER (WHERE success) AS n_success, count(*) FILTER (WHERE NOT success) AS n_failed,
      round(100.0 * count(*) FILTER (WHERE success) / count(*), 6) AS pct_success FROM {v_runs}""",
)
def run_overview(t):
    return rounded(R.run_overview(t.v_runs))


@query(
    "failure_codes",
    """
    WITH f AS (SELECT regexp_replace(error, '^([a-z_]+):.*', '\\1') AS error_code FROM {v_runs} WHERE NOT success AND error IS NOT NULL)
    SELECT error_code, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM f), 6) AS share FROM f GROUP BY error_code""",
)
def failure_codes(t):
    return rounded(R.failure_codes(t.v_runs))


_TIMES = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, paper_id, event_id, CAST({m} AS DOUBLE) AS ms FROM {{v_runs}}" for m in R.TIMINGS
)


@query(
    "timing_summary",
    f"""
    WITH x AS ({_TIMES})
    SELECT metric, count(ms) AS n, round(avg(ms), 6) AS mean_ms, round(max(ms), 6) AS max_ms, round(median(ms), 6) AS median_ms
    FROM x GROUP BY metric""",
)
def timing_summary(t):
    return rounded(R.timing_summary(t.v_runs))


@query(
    "slowest_k",
    f"""
    WITH x AS ({_TIMES}), r AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY ms DESC, event_id) AS k FROM x WHERE ms IS NOT NULL)
    SELECT r.metric AS metric, paper_id, event_id, round(ms, 6) AS ms, n_missing FROM r
    JOIN (SELECT metric, count(*) FILTER (WHERE ms IS NULL) AS n_missing FROM x GROUP BY metric) m ON m.metric = r.metric WHERE k <= 10""",
)
def slowest_k(t):
    return rounded(R.slowest(t.v_runs, 10, "event_id"))


@query(
    "latest_run",
    """
    SELECT paper_id, event_id, temperature FROM (SELECT *, row_number() OVER (PARTITION BY paper_id
      ORDER BY CASE WHEN event_id = 77 THEN 0 ELSE 1 END, event_id DESC) AS k FROM {v_runs}) q WHERE k = 1""",
)
def latest_run(t):
    out = R.latest_run(t.v_runs.withColumn("run_id", F.col("event_id")), ["paper_id"], "run_id", preferred=77)
    return out.select("paper_id", "event_id", "temperature")


@query(
    "first_and_last",
    """
    SELECT paper_id, event_type, min(event_id) AS first_id, max(event_id) AS last_id FROM {v_runs} GROUP BY paper_id, event_type""",
)
def first_and_last(t):
    keys = ["paper_id", "event_type"]
    last = R.last_per_key(t.v_runs, keys, "event_id").select(*keys, F.col("event_id").alias("last_id"))
    first = R.first_per_key(t.v_runs, keys, "event_id").select(*keys, F.col("event_id").alias("first_id"))
    return first.join(last, keys)


@query(
    "priority_order",
    """
    WITH p AS (SELECT DISTINCT user_id FROM {events})
    SELECT 'p' || CAST(user_id AS VARCHAR) AS paper_id, user_id % 5 = 0 AS is_gt,
      CASE WHEN user_id % 3 = 0 THEN 'dataverse' ELSE 'osf' END AS source FROM p
    ORDER BY 2 DESC, CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END, 1 LIMIT 40""",
)
def priority_order(t):
    papers = t.events.select("user_id").distinct().selectExpr(
        "'p' || CAST(user_id AS STRING) AS paper_id",
        "CASE WHEN user_id % 3 = 0 THEN 'dataverse' ELSE 'osf' END AS source",
        "user_id % 5 = 0 AS g",
    )
    return R.priority_order(papers.drop("g"), papers.where("g"), limit=40).select("paper_id", "is_gt", "source")


@query(
    "newest",
    """
    SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'x' || CAST(o_orderkey AS VARCHAR) ELSE '0' || CAST(o_orderkey AS VARCHAR) END AS paper_id
    FROM {orders} ORDER BY try_cast(paper_id AS BIGINT) DESC NULLS LAST, paper_id LIMIT 25""",
)
def newest(t):
    papers = t.orders.selectExpr(
        "CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE '0' END || CAST(o_orderkey AS STRING) AS paper_id"
    )
    return R.newest(papers, 25)


def _log(t, cond: str):
    return t.v_runs.where(cond).select("paper_id", "success")


@query(
    "stage_status",
    """
    WITH p AS (SELECT DISTINCT paper_id, CAST(substr(paper_id, 2) AS BIGINT) AS u FROM {v_runs}),
    i AS (SELECT paper_id, bool_or(success) AS s FROM {v_runs} WHERE temperature = 0 AND elapsed_ms > 150000 GROUP BY 1),
    c AS (SELECT paper_id, bool_or(success) AS s FROM {v_runs} WHERE temperature = 1 AND elapsed_ms > 130000 GROUP BY 1),
    v AS (SELECT paper_id, bool_or(success) AS s FROM {v_runs} WHERE temperature = 2 AND elapsed_ms > 130000 GROUP BY 1),
    r AS (SELECT paper_id, bool_or(success) AS s FROM {v_runs} WHERE repeat = 3 AND elapsed_ms > 130000 GROUP BY 1)
    SELECT p.paper_id AS paper_id,
      CASE WHEN i.s THEN 'ok' WHEN i.s IS NOT NULL THEN 'fail' WHEN u % 4 = 0 THEN 'ok' ELSE 'pending' END AS index,
      CASE WHEN NOT i.s THEN 'skip' WHEN c.s THEN 'ok' WHEN c.s IS NOT NULL THEN 'fail' WHEN u % 6 = 0 THEN 'ok'
        WHEN u % 5 <> 0 THEN 'no_cols' ELSE 'pending' END AS codebook,
      CASE WHEN NOT i.s THEN 'skip' WHEN v.s THEN 'ok' WHEN v.s IS NOT NULL THEN 'fail' ELSE 'pending' END AS convert,
      CASE WHEN NOT i.s THEN 'skip' WHEN r.s THEN 'ok' WHEN r.s IS NOT NULL THEN 'fail' ELSE 'pending' END AS report
    FROM p LEFT JOIN i ON i.paper_id = p.paper_id LEFT JOIN c ON c.paper_id = p.paper_id
    LEFT JOIN v ON v.paper_id = p.paper_id LEFT JOIN r ON r.paper_id = p.paper_id WHERE u % 9 <> 0""",
)
def stage_status(t):
    papers = t.v_runs.select("paper_id").distinct()
    number = F.substring("paper_id", 2, 20).cast("bigint")

    def having(k: int):
        return papers.where(number % k == 0)

    return R.stage_status(
        papers,
        _log(t, "temperature = 0 AND elapsed_ms > 150000"),
        _log(t, "temperature = 1 AND elapsed_ms > 130000"),
        _log(t, "temperature = 2 AND elapsed_ms > 130000"),
        _log(t, "repeat = 3 AND elapsed_ms > 130000"),
        structure=having(4),
        columns=having(5),
        labels=having(6),
        tracked=having(9),
    )


@query(
    "tracker_wide",
    """
    WITH l AS (SELECT paper_id, event_type AS stage, status, row_number() OVER (PARTITION BY paper_id, event_type ORDER BY ts DESC) AS k FROM {v_runs})
    SELECT paper_id, max(status) FILTER (WHERE stage = 'click') AS click, max(status) FILTER (WHERE stage = 'error') AS error,
      max(status) FILTER (WHERE stage = 'signup') AS signup FROM l WHERE k = 1 GROUP BY paper_id""",
)
def tracker_wide(t):
    return R.tracker_wide(t.v_runs.select("paper_id", F.col("event_type").alias("stage"), "status", "ts"), ["click", "error", "signup"])


@query(
    "resume",
    """
    SELECT DISTINCT paper_id, temperature, repeat FROM {v_runs} r WHERE NOT EXISTS (SELECT 1 FROM {v_runs} l
      WHERE l.paper_id = r.paper_id AND l.temperature = r.temperature AND l.repeat = r.repeat AND l.status = 'ok')""",
)
def resume(t):
    keys = ["paper_id", "temperature", "repeat"]
    return R.unprocessed(t.v_runs.select(*keys).distinct(), t.v_runs.where("status = 'ok'"), keys)


@query(
    "upsert",
    """
    SELECT doc_id, quality + 10 AS quality, toxic FROM {labels} WHERE toxic = 1 OR quality = 0
    UNION ALL SELECT doc_id, quality, toxic FROM {labels} WHERE NOT (toxic = 1 OR quality = 0)""",
)
def upsert(t):
    new = t.labels.where("toxic = 1 OR quality = 0").withColumn("quality", F.col("quality") + 10)
    return R.upsert(R.upsert(t.labels, new, ["doc_id"]), new, ["doc_id"])


_SWEEP = """
    rows_ AS (SELECT paper_id, temperature, repeat, event_id AS ord, 'c' || CAST(CAST(floor(value) AS BIGINT) % 6 AS VARCHAR) AS key,
      CASE WHEN event_id % 5 = 0 THEN NULL ELSE 't' || CAST(CAST(floor(value / 7) AS BIGINT) % 2 AS VARCHAR) END AS value
      FROM (SELECT r.*, r.elapsed_ms / 1000 AS value FROM {v_runs} r) q),
    okr AS (SELECT DISTINCT paper_id, temperature, repeat FROM {v_runs} WHERE status = 'ok' AND event_type <> 'view'),
    fr AS (SELECT * FROM (SELECT rows_.*, row_number() OVER (PARTITION BY paper_id, temperature, repeat, key ORDER BY ord) AS k
      FROM rows_ SEMI JOIN okr USING (paper_id, temperature, repeat)) q WHERE k = 1),
    pr AS (SELECT a.paper_id AS paper_id, a.temperature AS temperature, a.repeat AS ra, b.repeat AS rb FROM okr a
      JOIN okr b ON a.paper_id = b.paper_id AND a.temperature = b.temperature AND a.repeat < b.repeat),
    ks AS (SELECT pr.*, f.key AS key FROM pr JOIN fr f ON f.paper_id = pr.paper_id AND f.temperature = pr.temperature
        AND f.repeat IN (pr.ra, pr.rb)),
    kd AS (SELECT DISTINCT * FROM ks),
    ag AS (SELECT kd.paper_id AS paper_id, kd.temperature AS temperature, ra, rb, count(*) AS n,
      avg(CASE WHEN a.value = b.value THEN 1.0 ELSE 0.0 END) AS agree FROM kd
      LEFT JOIN fr a ON a.paper_id = kd.paper_id AND a.temperature = kd.temperature AND a.repeat = ra AND a.key = kd.key
      LEFT JOIN fr b ON b.paper_id = kd.paper_id AND b.temperature = kd.temperature AND b.repeat = rb AND b.key = kd.key
      GROUP BY 1, 2, 3, 4),
    stab AS (SELECT p.paper_id AS paper_id, p.temperature AS temperature, agreement, coalesce(n_pairs, 0) AS n_pairs, n_keys_compared
      FROM (SELECT DISTINCT paper_id, temperature FROM {v_runs}) p LEFT JOIN (SELECT paper_id, temperature, avg(agree) AS agreement, count(*) AS n_pairs,
        CAST(sum(n) AS BIGINT) AS n_keys_compared FROM ag GROUP BY 1, 2) s ON s.paper_id = p.paper_id AND s.temperature = p.temperature)"""


def _sweep(t):
    runs = t.v_runs.withColumn("status", F.when(F.col("event_type") == "view", F.lit("failed")).otherwise(F.col("status")))
    rows = t.events.selectExpr(
        "'p' || CAST(user_id AS STRING) AS paper_id", "event_id % 3 AS temperature", "event_id % 4 AS repeat", "event_id AS ord",
        "'c' || CAST(CAST(floor(value) AS BIGINT) % 6 AS STRING) AS key",
        "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 't' || CAST(CAST(floor(value / 7) AS BIGINT) % 2 AS STRING) END AS value",
    )
    return runs, rows


@query(
    "stability",
    f"WITH {_SWEEP} SELECT paper_id, temperature, round(agreement, 6) AS agreement, n_pairs, n_keys_compared FROM stab",
)
def stability(t):
    return rounded(S.stability(*_sweep(t)))


_QUALITY = """
    ok2 AS (SELECT DISTINCT paper_id, temperature, repeat FROM {v_runs} WHERE status = 'ok'),
    kc AS (SELECT paper_id, temperature, repeat, avg(CASE WHEN event_type <> 'purchase' THEN 1.0 ELSE 0.0 END) AS v FROM {v_runs}
      WHERE event_id % 2 = 0 GROUP BY 1, 2, 3),
    vc AS (SELECT paper_id, temperature, repeat, avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) AS v FROM {v_runs}
      WHERE event_type <> 'view' GROUP BY 1, 2, 3),
    lc AS (SELECT paper_id, temperature, repeat, avg(CASE WHEN error IS NOT NULL THEN 1.0 ELSE 0.0 END) AS v FROM {v_runs}
      WHERE event_type <> 'click' GROUP BY 1, 2, 3),
    q AS (SELECT ok2.paper_id AS paper_id, ok2.temperature AS temperature, avg(coalesce(kc.v, 0.0)) AS known_type_rate,
        avg(vc.v) AS codebook_coverage_rate, avg(lc.v) AS nonempty_label_rate, count(*) AS n_repeats_used FROM ok2
      LEFT JOIN kc ON kc.paper_id = ok2.paper_id AND kc.temperature = ok2.temperature AND kc.repeat = ok2.repeat
      LEFT JOIN vc ON vc.paper_id = ok2.paper_id AND vc.temperature = ok2.temperature AND vc.repeat = ok2.repeat
      LEFT JOIN lc ON lc.paper_id = ok2.paper_id AND lc.temperature = ok2.temperature AND lc.repeat = ok2.repeat GROUP BY 1, 2),
    qual AS (SELECT p.paper_id AS paper_id, p.temperature AS temperature, known_type_rate, codebook_coverage_rate, nonempty_label_rate,
        coalesce(n_repeats_used, 0) AS n_repeats_used FROM (SELECT DISTINCT paper_id, temperature FROM {v_runs}) p
      LEFT JOIN q ON q.paper_id = p.paper_id AND q.temperature = p.temperature)"""


def _quality(t):
    runs = t.v_runs
    columns = runs.where("event_id % 2 = 0").withColumn(
        "col_type", F.when(F.col("event_type") == "purchase", F.lit("unknown")).otherwise(F.lit("binary"))
    )
    coverage = runs.where("event_type <> 'view'").withColumn(
        "match_status", F.when(F.col("event_type") == "click", F.lit("matched")).otherwise(F.lit("unmatched_in_data"))
    )
    labels = runs.where("event_type <> 'click'").withColumn("label", F.col("error"))
    return S.run_quality(runs, columns, coverage, labels)


@query(
    "run_quality",
    f"""WITH {_QUALITY} SELECT paper_id, temperature, n_repeats_used, round(known_type_rate, 6) AS known_type_rate,
      round(codebook_coverage_rate, 6) AS codebook_coverage_rate, round(nonempty_label_rate, 6) AS nonempty_label_rate FROM qual""",
)
def run_quality(t):
    return rounded(_quality(t))


@query(
    "recommend",
    f"""
    WITH {_SWEEP}, {_QUALITY},
    sc AS (SELECT coalesce(stab.paper_id, qual.paper_id) AS paper_id, coalesce(stab.temperature, qual.temperature) AS temperature,
        agreement AS s, list_avg([known_type_rate, codebook_coverage_rate, nonempty_label_rate]) AS q
      FROM stab FULL JOIN qual ON stab.paper_id = qual.paper_id AND stab.temperature = qual.temperature),
    cm AS (SELECT *, coalesce(0.5 * s + 0.5 * q, s, q) AS c FROM sc)
    SELECT paper_id, temperature, round(s, 6) AS stability_score, round(q, 6) AS quality_score, round(c, 6) AS combined_score,
      coalesce(max(c) OVER (PARTITION BY paper_id) - c < 0.001, false) AS is_tied FROM cm""",
)
def recommend(t):
    return rounded(S.recommend(S.stability(*_sweep(t)), _quality(t)))


@query(
    "grand_report",
    f"""
    WITH {_SWEEP}, {_QUALITY},
    b AS (SELECT paper_id, temperature, bool_and(status = 'no_data') AS e FROM {{v_runs}} GROUP BY 1, 2),
    j AS (SELECT b.*, stab.agreement AS a, n_repeats_used AS n, known_type_rate AS k, codebook_coverage_rate AS c, nonempty_label_rate AS l
      FROM b LEFT JOIN stab ON stab.paper_id = b.paper_id AND stab.temperature = b.temperature
      LEFT JOIN qual ON qual.paper_id = b.paper_id AND qual.temperature = b.temperature)
    SELECT paper_id, temperature, 'index' AS stage, CASE WHEN e THEN 0 ELSE n END AS repeat_count,
      CASE WHEN NOT e THEN round(a, 6) END AS mean_pairwise_agreement, CASE WHEN NOT e THEN round(k, 6) END AS known_type_rate,
      CAST(NULL AS DOUBLE) AS codebook_coverage_rate, CAST(NULL AS DOUBLE) AS nonempty_label_rate,
      CASE WHEN e THEN 'no_data' WHEN a IS NOT NULL THEN 'ok' ELSE 'failed' END AS status FROM j
    UNION ALL
    SELECT paper_id, temperature, 'codebook', CASE WHEN e THEN 0 ELSE n END, CASE WHEN NOT e THEN round(a, 6) END, NULL,
      CASE WHEN NOT e THEN round(c, 6) END, CASE WHEN NOT e THEN round(l, 6) END,
      CASE WHEN e THEN 'no_data' WHEN a IS NULL AND c IS NULL THEN 'no_codebook' ELSE 'ok' END FROM j""",
)
def grand_report(t):
    stable = settle(S.stability(*_sweep(t)))
    return rounded(S.grand_report(t.v_runs, stable, stable, _quality(t)))


@query(
    "pairwise_agreement",
    """
    WITH a AS (SELECT paper_id, rel_path, min(type) AS v FROM {v_scored} WHERE ord % 6 <> 0 GROUP BY 1, 2),
    b AS (SELECT paper_id, rel_path, min(type) AS v FROM {v_scored_json} WHERE ord % 4 <> 0 GROUP BY 1, 2)
    SELECT count(*) AS n_keys, round(avg(CASE WHEN a.v = b.v THEN 1.0 ELSE 0.0 END), 6) AS agreement
    FROM a FULL JOIN b ON a.paper_id = b.paper_id AND a.rel_path = b.rel_path""",
)
def pairwise_agreement(t):
    a, b = t.v_scored.where("ord % 6 <> 0"), t.v_scored_json.where("ord % 4 <> 0")
    return rounded(S.pairwise_agreement(a, b, ["paper_id", "rel_path"], "type"))


@query(
    "cross_config",
    """
    WITH u AS (SELECT * FROM {v_scored_cfg} WHERE type IS NOT NULL AND type <> 'llm_error')
    SELECT a.config AS config_a, b.config AS config_b, count(*) AS n_files,
      round(100.0 * avg(CASE WHEN a.type = b.type THEN 1.0 ELSE 0.0 END), 6) AS agreement
    FROM u a JOIN u b ON a.ord = b.ord AND a.config < b.config GROUP BY 1, 2""",
)
def cross_config(t):
    return rounded(S.config_agreement(t.v_scored_cfg, CONFIGS))


_LEVEL = "CASE ord % 3 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' ELSE 'hard' END"


@query(
    "repeat_score",
    f"""
    WITH tr AS (SELECT ord AS path, type_gt, {_LEVEL} AS difficulty FROM {{v_files}}),
    p AS (SELECT config, ord AS path, type FROM {{v_scored_cfg}} WHERE type IS NOT NULL),
    m AS (SELECT c.config AS config, tr.*, p.type AS type FROM tr, (SELECT DISTINCT config FROM {{v_scored_cfg}}) c
      LEFT JOIN p ON p.config = c.config AND p.path = tr.path)
    SELECT config, count(*) AS n_total, count(*) FILTER (WHERE type = type_gt) AS n_correct,
      count(*) FILTER (WHERE type = type_gt AND difficulty = 'easy') AS easy_correct,
      count(*) FILTER (WHERE type = type_gt AND difficulty = 'medium') AS medium_correct,
      count(*) FILTER (WHERE type = type_gt AND difficulty = 'hard') AS hard_correct,
      count(*) FILTER (WHERE type IS NULL) AS n_path_miss FROM m GROUP BY config""",
)
def repeat_score(t):
    truth = t.v_files.selectExpr("ord AS path", "type_gt", f"{_LEVEL} AS difficulty")
    predicted = t.v_scored_cfg.selectExpr("config", "ord AS path", "type")
    return S.repeat_scores(truth, predicted, ["config"]).drop("fingerprint")


@query(
    "repeat_stability",
    """
    WITH a AS (SELECT 'm20_md' AS config, 1 AS run, ord, type, type_gt FROM {v_scored} UNION ALL
      SELECT 'm20_md', 2, ord, type, type_gt FROM {v_scored} UNION ALL
      SELECT 'm20_json', 1, ord, type, type_gt FROM {v_scored_json} UNION ALL
      SELECT 'm20_json', 2, ord, type, type_gt FROM {v_scored_120}),
    s AS (SELECT config, run, 100.0 * count(*) FILTER (WHERE type = type_gt) / count(*) AS acc,
      md5(string_agg(CAST(ord AS VARCHAR) || '=' || coalesce(type, 'MISSING'), ';' ORDER BY ord)) AS sig FROM a GROUP BY 1, 2)
    SELECT config, count(*) AS n_runs, round(avg(acc), 6) AS mean_accuracy, count(DISTINCT sig) = 1 AS stable FROM s GROUP BY config""",
)
def repeat_stability(t):
    def run(df, config: str, nr: int):
        return df.selectExpr(f"'{config}' AS config", f"{nr} AS run", "ord AS path", "type")

    runs = (
        run(t.v_scored, "m20_md", 1)
        .unionByName(run(t.v_scored, "m20_md", 2))
        .unionByName(run(t.v_scored_json, "m20_json", 1))
        .unionByName(run(t.v_scored_120, "m20_json", 2))
    )
    truth = t.v_files.selectExpr("ord AS path", "type_gt", "'easy' AS difficulty")
    return rounded(S.repeat_stability(S.repeat_scores(truth, runs, ["config", "run"]), ["config"]))


_VALID = """
    val AS (SELECT paper_id, event_id, event_type <> 'view' AND elapsed_ms > 20000 AS valid,
      CASE event_type WHEN 'click' THEN 'FILE_EMPTY;CSV_FORMATTING_ERROR' WHEN 'purchase' THEN 'MISSING_DATAFILE; FILE_EMPTY;' ELSE '' END
        AS error_keys FROM {v_runs} WHERE success)"""


def _validations(t):
    keys = (
        "CASE event_type WHEN 'click' THEN 'FILE_EMPTY;CSV_FORMATTING_ERROR' WHEN 'purchase' THEN 'MISSING_DATAFILE; FILE_EMPTY;' "
        "ELSE '' END AS error_keys"
    )
    return t.v_runs.where("success").selectExpr(
        "paper_id", "event_type <> 'view' AND elapsed_ms > 20000 AS valid", keys
    )


@query(
    "funnel",
    f"""
    WITH {_VALID},
    p AS (SELECT paper_id, count(*) AS g, count(*) FILTER (WHERE success) AS k FROM {{v_runs}} GROUP BY 1),
    v AS (SELECT paper_id, count(*) AS g, count(*) FILTER (WHERE valid) AS k, bool_and(valid) AS a FROM val GROUP BY 1)
    SELECT CAST(sum(p.g) AS BIGINT) AS n_groups, count(*) AS n_repos, CAST(sum(p.k) AS BIGINT) AS n_converted,
      count(*) FILTER (WHERE p.k > 0) AS n_repos_converted, CAST(coalesce(sum(v.g), 0) AS BIGINT) AS n_validated,
      CAST(coalesce(sum(v.k), 0) AS BIGINT) AS n_valid, count(*) FILTER (WHERE v.a) AS n_repos_valid
    FROM p LEFT JOIN v ON v.paper_id = p.paper_id""",
)
def funnel(t):
    return R.conversion_funnel(t.v_runs, _validations(t))


@query(
    "failure_reasons",
    """
    SELECT CASE WHEN error LIKE '%UTF-8%' THEN 'encoding (non-UTF-8 input)' WHEN error LIKE '%no_data_files%' THEN 'no data files in group'
      ELSE error END AS reason, count(*) AS n_groups, count(DISTINCT paper_id) AS n_repos FROM {v_runs} WHERE NOT success GROUP BY 1""",
)
def failure_reasons(t):
    return R.failure_reasons(t.v_runs)


@query(
    "error_keys",
    f"""
    WITH {_VALID}, x AS (SELECT paper_id, trim(unnest(string_split(error_keys, ';'))) AS key FROM val)
    SELECT key, count(*) AS n, count(DISTINCT paper_id) AS n_repos FROM x WHERE key <> '' GROUP BY key""",
)
def error_keys(t):
    return R.error_keys(_validations(t))


_KEY = (
    "CASE event_id % 6 WHEN 0 THEN 'CSV_HEADER_REPEATED' WHEN 1 THEN 'MISSING_DATAFILE' WHEN 2 THEN 'UNKNOWN_NAMESPACE' "
    "WHEN 3 THEN 'CSV_COLUMN_MISSING_FROM_METADATA' WHEN 4 THEN 'CSV_FORMATTING_ERROR' ELSE 'OTHER' END"
)
_WHERE = "CASE event_type WHEN 'click' THEN '/data/raw/a.csv' WHEN 'error' THEN '/data/source-a_data.csv' ELSE '/docs/x' END"


@query(
    "issue_class",
    f"""
    WITH i AS (SELECT {_KEY} AS key, {_WHERE} AS f FROM {{events}})
    SELECT key, CASE key WHEN 'CSV_HEADER_REPEATED' THEN 'repository' WHEN 'MISSING_DATAFILE' THEN 'converter'
        WHEN 'UNKNOWN_NAMESPACE' THEN 'structural'
        WHEN 'CSV_COLUMN_MISSING_FROM_METADATA' THEN CASE WHEN f LIKE '/data/raw/%' THEN 'repository' ELSE 'ambiguous' END
        WHEN 'CSV_FORMATTING_ERROR' THEN CASE WHEN f LIKE '/data/source-%' THEN 'converter' ELSE 'repository' END
        ELSE 'unknown' END AS category, count(*) AS n FROM i GROUP BY 1, 2""",
)
def issue_class(t):
    return R.issue_counts(t.events.selectExpr(f"{_KEY} AS key", f"{_WHERE} AS files"))


@query(
    "repo_summary",
    """
    WITH c AS (SELECT 'src' || CAST(event_id % 25 AS VARCHAR) AS paper_id, count(*) AS n, count(DISTINCT user_id) AS s FROM {events} GROUP BY 1),
    f AS (SELECT s.*, v.aggregate_folder AS af FROM {v_scored} s JOIN {v_files} v ON v.ord = s.ord)
    SELECT f.paper_id AS paper_id, count(*) AS n_files, count(*) FILTER (WHERE type = 'data') AS n_data_files,
      count(*) FILTER (WHERE type = 'data' AND data_format = 'tabular' AND data_granularity = 'combined') AS n_tabular_files,
      count(DISTINCT af) AS n_agg_dirs, count(*) FILTER (WHERE type = 'data' AND data_granularity = 'individual') AS n_individual,
      count(*) FILTER (WHERE type = 'data' AND data_granularity = 'combined') AS n_combined,
      coalesce(any_value(c.n), 0) AS n_columns, coalesce(any_value(c.s), 0) AS n_src_files
    FROM f LEFT JOIN c ON c.paper_id = f.paper_id GROUP BY f.paper_id""",
)
def repo_summary(t):
    files = t.v_scored.join(t.v_files.select("ord", "aggregate_folder"), "ord")
    columns = t.events.selectExpr("'src' || CAST(event_id % 25 AS STRING) AS paper_id", "user_id AS source_file")
    return C.repository_summary(files, columns)


_DIMS = ["type_gt", "data_granularity", "data_format"]


@query(
    "corpus_composition",
    """
    WITH s AS (SELECT *, count(*) OVER (PARTITION BY lang) AS size FROM (
        SELECT f.lang AS lang, s.type_gt AS type, s.data_granularity AS data_granularity, s.data_format AS data_format
        FROM {v_scored} s JOIN {v_files} f ON f.ord = s.ord) q),
    x AS (SELECT 'all' AS scope, * FROM s UNION ALL SELECT 'small', * FROM s WHERE size <= 500),
    y AS (SELECT scope, lang, 'type' AS field, type AS value FROM x UNION ALL SELECT scope, lang, 'data_granularity', data_granularity FROM x
      UNION ALL SELECT scope, lang, 'data_format', data_format FROM x),
    r AS (SELECT scope, count(DISTINCT lang) AS n FROM x GROUP BY scope)
    SELECT y.scope AS scope, field, value, count(*) AS n_files, count(DISTINCT lang) AS n_repos,
      round(100.0 * count(DISTINCT lang) / any_value(r.n), 6) AS pct_repos
    FROM y JOIN r ON r.scope = y.scope WHERE value IS NOT NULL GROUP BY 1, 2, 3""",
)
def corpus_composition(t):
    files = t.v_scored.join(t.v_files.select("ord", "lang"), "ord").select(
        F.col("lang").alias("paper_id"), F.col("type_gt").alias("type"), "data_granularity", "data_format"
    )
    return rounded(C.composition(files))


@query(
    "type_shares",
    """
    WITH p AS (SELECT type_gt AS type, coalesce(data_format, '(none)') AS value, count(*) AS n FROM {v_scored} GROUP BY 1, 2),
    q AS (SELECT type_gt AS type, count(*) AS a, count(DISTINCT paper_id) AS r FROM {v_scored} GROUP BY 1)
    SELECT p.type AS type, value, n AS n_files, r AS n_repos, round(100.0 * n / a, 6) AS share FROM p JOIN q ON q.type = p.type""",
)
def type_shares(t):
    return rounded(C.type_shares(t.v_scored.drop("type").withColumnRenamed("type_gt", "type"), "data_format"))


@query(
    "histogram",
    """
    WITH s AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY 1), c AS (SELECT quantile_cont(n, 0.95) AS p FROM s)
    SELECT CAST(floor(least(CAST(n AS DOUBLE), p) / 2) * 2 AS BIGINT) AS bin_start, count(*) AS n_repos FROM s, c GROUP BY 1""",
)
def histogram(t):
    return C.file_count_histogram(t.orders.select(F.col("o_custkey").alias("paper_id")), width=2)


@query(
    "file_count_percentiles",
    """
    WITH s AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY 1)
    SELECT round(quantile_cont(n, 0.05), 6) AS p5, round(quantile_cont(n, 0.25), 6) AS p25, round(median(n), 6) AS p50,
      round(quantile_cont(n, 0.75), 6) AS p75, round(quantile_cont(n, 0.95), 6) AS p95 FROM s""",
)
def file_count_percentiles(t):
    papers = t.orders.select(F.col("o_custkey").alias("paper_id"))
    return rounded(C.file_count_percentiles(papers, [0.05, 0.25, 0.5, 0.75, 0.95]))


@query(
    "variables_per_repo",
    """
    WITH s AS (SELECT paper_id, count(*) AS n FROM {v_cols} GROUP BY 1)
    SELECT CAST(floor(log10(n)) AS INTEGER) AS log_bin, count(*) AS n_repos, (SELECT round(avg(n), 6) FROM s) AS mean_columns,
      (SELECT round(median(n), 6) FROM s) AS median_columns FROM s GROUP BY 1""",
)
def variables_per_repo(t):
    return rounded(C.variables_per_repository(t.v_cols))


@query(
    "batch_plan",
    """
    WITH p AS (SELECT paper_id, count(*) FILTER (WHERE aggregate_folder IS NULL) AS s, count(DISTINCT aggregate_folder) AS g FROM {v_files} GROUP BY 1),
    b AS (SELECT unnest([1, 5, 10, 30]) AS batch_size),
    c AS (SELECT batch_size, CAST(ceil(s / batch_size) + ceil(g / batch_size) AS BIGINT) AS calls FROM p, b)
    SELECT batch_size, CAST(sum(calls) AS BIGINT) AS total_calls, round(avg(calls), 6) AS mean_calls, max(calls) AS max_calls,
      round(100.0 * avg(CASE WHEN calls <= 1 THEN 1.0 ELSE 0.0 END), 6) AS pct_le_1, round(100.0 * avg(CASE WHEN calls <= 2 THEN 1.0 ELSE 0.0 END), 6) AS pct_le_2,
      round(100.0 * avg(CASE WHEN calls <= 5 THEN 1.0 ELSE 0.0 END), 6) AS pct_le_5, round(100.0 * avg(CASE WHEN calls = 1 THEN 1.0 ELSE 0.0 END), 6) AS pct_1,
      round(median(calls), 6) AS median_calls FROM c GROUP BY batch_size""",
)
def batch_plan(t):
    return rounded(C.batch_plan(t.v_files, [1, 5, 10, 30]))


@query(
    "token_fit",
    """
    SELECT event_type, round(regr_slope(elapsed_ms + 2415 + 24 * repeat, repeat), 4) AS rate,
      round(regr_intercept(elapsed_ms + 2415 + 24 * repeat, repeat), 4) AS base,
      round(regr_r2(elapsed_ms + 2415 + 24 * repeat, repeat), 6) AS r2, count(*) AS n_calls FROM {v_runs} GROUP BY event_type""",
)
def token_fit(t):
    calls = t.v_runs.withColumn("tokens", F.col("elapsed_ms") + 2415 + 24 * F.col("repeat"))
    out = C.token_fit(calls, ["event_type"], "repeat", "tokens")
    return out.select(
        "event_type", F.round("rate", 4).alias("rate"), F.round("base", 4).alias("base"), F.round("r2", 6).alias("r2"), "n_calls"
    )


@query(
    "token_totals",
    """
    WITH p AS (SELECT user_id, count(*) AS c, sum(event_id % 100) AS i, sum(event_id % 37) AS o FROM {events} GROUP BY 1)
    SELECT CAST(sum(c) AS BIGINT) AS total_calls, round(avg(c), 6) AS mean_calls, CAST(sum(i) AS BIGINT) AS total_in, round(avg(i), 6) AS mean_in,
      CAST(sum(o) AS BIGINT) AS total_out, round(avg(o), 6) AS mean_out, round(median(c), 6) AS median_calls FROM p""",
)
def token_totals(t):
    traces = t.events.selectExpr("user_id AS paper_id", "event_id % 100 AS tokens_in", "event_id % 37 AS tokens_out")
    return rounded(C.token_totals(traces))


@query(
    "call_cost",
    """
    WITH fits(model, bi, ri, bo, ro, pi, po) AS (VALUES ('8b', 2377, 24, -15, 45, 0.050, 0.080), ('20b', 2415, 24, 255, 46, 0.075, 0.300),
      ('120b', 2415, 24, 161, 52, 0.150, 0.600), ('235b', 2383, 25, 760, 129, 0.071, 0.100), ('other', 2400, 24, 300, 60, NULL, NULL)),
    k AS (SELECT event_type AS step, model, greatest(0, bi + ri * (user_id % 30)) AS ti, greatest(0, bo + ro * (user_id % 30)) AS o, pi, po
      FROM {events} JOIN fits ON model = CASE event_id % 5 WHEN 0 THEN '8b' WHEN 1 THEN '20b' WHEN 2 THEN '120b' WHEN 3 THEN '235b' ELSE 'other' END)
    SELECT step, model, count(*) AS n_calls, CAST(sum(ti) AS BIGINT) AS tokens_in, CAST(sum(o) AS BIGINT) AS tokens_out,
      CAST(round(CAST(sum(ti) * any_value(CAST(pi AS DECIMAL(6,3))) + sum(o) * any_value(CAST(po AS DECIMAL(6,3))) AS DECIMAL(28,3))
        * CAST(0.000001 AS DECIMAL(7,6)), 6) AS DOUBLE) AS price
    FROM k GROUP BY 1, 2""",
)
def call_cost(t):
    names = "CASE event_id % 5 WHEN 0 THEN '8b' WHEN 1 THEN '20b' WHEN 2 THEN '120b' WHEN 3 THEN '235b' ELSE 'other' END"
    calls = t.events.selectExpr("event_type AS step", f"{names} AS model", "user_id % 30 AS n")
    return rounded(C.cost_by_step(calls, "step", "model", G.call_cost(F.col("model"), F.col("n"))))


_YEAR = "CASE WHEN o_orderkey % 50 = 0 THEN '0956797x' ELSE '09567976' END || substr(CAST(o_orderdate AS STRING), 3, 2) || CAST(o_orderkey AS STRING)"


@query(
    "by_year",
    f"""
    WITH p AS (SELECT 2000 + CAST(substr({_YEAR}, 9, 2) AS INT) AS year FROM {{orders}}),
    y AS (SELECT year, count(*) AS n FROM p GROUP BY year)
    SELECT year, n AS n_papers, round(100.0 * n / (SELECT sum(n) FROM y), 6) AS pct, (SELECT min(year) FROM y) AS first_year,
      (SELECT max(year) FROM y) AS last_year,
      round(100.0 * (SELECT coalesce(sum(n), 0) FROM y WHERE year BETWEEN 2014 AND 2017) / (SELECT sum(n) FROM y), 6) AS pct_2014_2017 FROM y""",
)
def by_year(t):
    return rounded(C.corpus_by_year(t.orders.selectExpr(f"{_YEAR} AS paper_id")))
