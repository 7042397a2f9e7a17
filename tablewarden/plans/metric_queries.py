"""Queries over classifier evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.operators import corpus as C
from tablewarden.operators import metrics as M
from tablewarden.plans.profile_queries import rounded
from tablewarden.plans.views import FILE_CLASSES, Family

FAMILY = Family()
query = FAMILY.add

OK = "type_gt IS NOT NULL AND type IS NOT NULL"


def _margins(cells: str, by: str = "") -> str:
    """Class margins of a frame of cells, as SQL; ``by`` ends with a comma."""
    return f"""
      SELECT {by} cls, sum(r) AS r, sum(c) AS c, sum(d) AS d FROM (
        SELECT {by} gt AS cls, n AS r, 0 AS c, CASE WHEN gt = pred THEN n ELSE 0 END AS d FROM {cells}
        UNION ALL SELECT {by} pred, 0, n, 0 FROM {cells}) u GROUP BY {by} cls"""


EVAL_F1 = "CASE WHEN r > 0 THEN 200.0 * d / (r + c) END"
REPORT_F1 = "CASE WHEN r > 0 AND c > 0 AND d > 0 THEN 200.0 * d / (r + c) END"


def _cm(margins: str, by: str = "", policy: str = "eval") -> str:
    f1 = EVAL_F1 if policy == "eval" else REPORT_F1
    macro = "coalesce(f, 0.0)" if policy == "eval" else "f"
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return f"""
      SELECT {by} CAST(n AS BIGINT) AS n, 100.0 * d / n AS accuracy,
        CASE WHEN rc / (n * n) < 1 THEN (d / n - rc / (n * n)) / (1 - rc / (n * n)) END AS kappa,
        {macro} AS macro_f1,
        CASE WHEN (n * n - cc) * (n * n - rr) > 0 THEN (n * d - rc) / sqrt((n * n - cc) * (n * n - rr)) END AS mcc
      FROM (SELECT {by} CAST(sum(r) AS DOUBLE) AS n, CAST(sum(d) AS DOUBLE) AS d, CAST(sum(r * c) AS DOUBLE) AS rc,
          CAST(sum(r * r) AS DOUBLE) AS rr, CAST(sum(c * c) AS DOUBLE) AS cc, avg({f1}) AS f
        FROM ({margins}) m {group}) t WHERE n > 0"""


def _cells(view: str, by: str = "", gt: str = "type_gt", pred: str = "type") -> str:
    return (
        f"SELECT {by} {gt} AS gt, {pred} AS pred, count(*) AS n FROM {view} "
        f"WHERE {gt} IS NOT NULL AND {pred} IS NOT NULL GROUP BY {by} {gt}, {pred}"
    )


def _round(cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols.split())


@query("confusion", _cells("{v_scored}"))
def confusion(t):
    return M.confusion(t.v_scored, "type_gt", "type")


for _policy in ("eval", "report"):
    query(
        f"cm_stats_{_policy}",
        f"""WITH cells AS ({_cells('{v_scored}', 'paper_id,')})
        SELECT paper_id, n, {_round('accuracy kappa macro_f1 mcc')} FROM
        ({_cm(_margins('cells', 'paper_id,'), 'paper_id,', _policy)}) z""",
    )(
        lambda t, policy=_policy: rounded(
            M.cm_stats(M.confusion(t.v_scored, "type_gt", "type", ["paper_id"]), ["paper_id"], policy)
        )
    )


@query(
    "class_metrics",
    f"""
    WITH cells AS ({_cells('{v_scored}')}), m AS ({_margins('cells')}),
    b AS (SELECT cls, CAST(d AS BIGINT) AS tp, CAST(c - d AS BIGINT) AS fp, CAST(r - d AS BIGINT) AS fn,
      CAST((SELECT sum(n) FROM cells) - r - c + d AS BIGINT) AS tn FROM m),
    fp AS (SELECT pred AS cls, gt AS top_fp, row_number() OVER (PARTITION BY pred ORDER BY n DESC, gt) AS k
      FROM cells WHERE gt <> pred),
    fn AS (SELECT gt AS cls, pred AS top_fn, row_number() OVER (PARTITION BY gt ORDER BY n DESC, pred) AS k
      FROM cells WHERE gt <> pred)
    SELECT b.cls AS cls, tp, b.fp AS fp, b.fn AS fn, tn,
      round(CASE WHEN tp + b.fp > 0 THEN 100.0 * tp / (tp + b.fp) END, 6) AS "precision",
      round(CASE WHEN tp + b.fn > 0 THEN 100.0 * tp / (tp + b.fn) END, 6) AS recall,
      round(CASE WHEN tp + b.fp > 0 AND tp + b.fn > 0 AND tp > 0 THEN 200.0 * tp / (2 * tp + b.fp + b.fn) END, 6) AS f1,
      round(CASE WHEN b.fp + tn > 0 THEN 100.0 * b.fp / (b.fp + tn) END, 6) AS fpr,
      round(CASE WHEN tp + b.fn > 0 THEN 100.0 * b.fn / (tp + b.fn) END, 6) AS fnr, top_fp, top_fn
    FROM b LEFT JOIN fp ON fp.cls = b.cls AND fp.k = 1 LEFT JOIN fn ON fn.cls = b.cls AND fn.k = 1""",
)
def class_metrics(t):
    return rounded(M.class_metrics(M.confusion(t.v_scored, "type_gt", "type")))


@query(
    "micro_f1",
    f"""
    WITH cells AS ({_cells('{v_scored_cfg}', 'config,')}), m AS ({_margins('cells', 'config,')})
    SELECT config, CAST(sum(d) AS BIGINT) AS tp, CAST(sum(c - d) AS BIGINT) AS fp, CAST(sum(r - d) AS BIGINT) AS fn,
      round(200.0 * sum(d) / (2 * sum(d) + sum(c - d) + sum(r - d)), 6) AS micro_f1
    FROM m WHERE cls <> 'llm_error' GROUP BY config""",
)
def micro_f1(t):
    cells = M.confusion(t.v_scored_cfg, "type_gt", "type", ["config"])
    return rounded(M.micro_f1(cells, ["config"], sentinel="llm_error"))


def _acc(field: str, scope: str = "TRUE") -> str:
    return (
        f"round(100.0 * count(*) FILTER (WHERE {scope} AND \"{field}\" = \"{field}_gt\") / "
        f"nullif(count(*) FILTER (WHERE {scope} AND \"{field}_gt\" IS NOT NULL), 0), 6)"
    )


PER_REPO = f"""
    cells AS ({_cells('{v_scored}', 'paper_id,')}),
    s AS ({_cm(_margins('cells', 'paper_id,'), 'paper_id,', 'report')})"""


@query(
    "per_repo_metrics",
    f"""
    WITH {PER_REPO},
    a AS (SELECT paper_id, {_acc('group')} AS group_acc, {_acc('data_granularity', "type_gt = 'data'")} AS granularity_acc,
      {_acc('data_format', "type_gt = 'data'")} AS format_acc FROM {{v_scored}} GROUP BY paper_id),
    e AS (SELECT paper_id, gt || '→' || pred || ' (' || n || ')' AS top_err,
      row_number() OVER (PARTITION BY paper_id ORDER BY n DESC, gt || '→' || pred) AS k FROM cells WHERE gt <> pred),
    x AS (SELECT paper_id, ext AS top_ext, row_number() OVER (PARTITION BY paper_id ORDER BY count(*) DESC, ext) AS k
      FROM {{v_scored}} WHERE type_gt <> type GROUP BY paper_id, ext)
    SELECT s.paper_id AS paper_id, s.n AS n, round(s.accuracy, 6) AS type_acc, round(s.kappa, 6) AS kappa,
      round(s.macro_f1, 6) AS macro_f1, round(s.mcc, 6) AS mcc, group_acc, granularity_acc, format_acc, top_err, top_ext
    FROM s LEFT JOIN a ON a.paper_id = s.paper_id LEFT JOIN e ON e.paper_id = s.paper_id AND e.k = 1
    LEFT JOIN x ON x.paper_id = s.paper_id AND x.k = 1 WHERE s.n >= 2""",
)
def per_repo_metrics(t):
    return rounded(M.repository_metrics(t.v_scored))


@query(
    "repo_avg",
    f"""
    WITH cells AS ({_cells('{v_scored_cfg}', 'config, paper_id,')}),
    pool AS (SELECT config, gt, pred, sum(n) AS n FROM cells GROUP BY config, gt, pred),
    s AS ({_cm(_margins('cells', 'config, paper_id,'), 'config, paper_id,')}),
    p AS ({_cm(_margins('pool', 'config,'), 'config,')}),
    mi AS (SELECT config, paper_id, 200.0 * sum(d) / sum(r + c) AS f FROM ({_margins('cells', 'config, paper_id,')}) q
      GROUP BY config, paper_id),
    mp AS (SELECT config, 200.0 * sum(d) / sum(r + c) AS f FROM ({_margins('pool', 'config,')}) q GROUP BY config),
    a AS (SELECT s.config AS config, avg(accuracy) AS acc, avg(macro_f1) AS ma, avg(mi.f) AS mi, count(*) AS k
      FROM s JOIN mi ON s.config = mi.config AND s.paper_id = mi.paper_id GROUP BY s.config)
    SELECT p.config AS config, p.n AS n, round(p.accuracy, 6) AS pooled_accuracy, round(p.macro_f1, 6) AS pooled_macro_f1,
      round(mp.f, 6) AS pooled_micro_f1, round(a.acc, 6) AS avg_accuracy, round(a.ma, 6) AS avg_macro_f1,
      round(a.mi, 6) AS avg_micro_f1, a.k AS n_repos
    FROM p JOIN mp ON mp.config = p.config JOIN a ON a.config = p.config""",
)
def repo_avg(t):
    return rounded(M.pooled_and_averaged(t.v_scored_cfg, ["config"]))


@query(
    "repo_class_f1",
    f"""
    WITH cells AS ({_cells('{v_scored}', 'paper_id,')}),
    pool AS (SELECT gt, pred, sum(n) AS n FROM cells GROUP BY gt, pred),
    e AS (SELECT cls, {REPORT_F1} AS f FROM ({_margins('cells', 'paper_id,')}) m),
    p AS (SELECT cls, {REPORT_F1} AS f FROM ({_margins('pool')}) m),
    a AS (SELECT cls, avg(f) AS avg_f1, stddev_samp(f) AS sd_f1, count(f) AS n_repos FROM e GROUP BY cls)
    SELECT a.cls AS cls, round(avg_f1, 6) AS avg_f1, round(sd_f1, 6) AS sd_f1, n_repos, round(p.f, 6) AS pooled_f1,
      round(avg_f1 - p.f, 6) AS gap FROM a JOIN p ON p.cls = a.cls""",
)
def repo_class_f1(t):
    return rounded(M.class_f1_averaged(t.v_scored))


@query(
    "weighted_confusion",
    f"""
    WITH cells AS ({_cells('{v_scored}', 'paper_id,')}),
    rows_ AS (SELECT paper_id, gt, sum(n) AS size FROM cells GROUP BY paper_id, gt),
    k AS (SELECT gt, count(*) AS n_repos FROM rows_ GROUP BY gt),
    lv AS (SELECT DISTINCT gt AS pred FROM cells UNION SELECT DISTINCT pred FROM cells),
    s AS (SELECT c.gt AS gt, c.pred AS pred, sum(c.n / r.size) AS sh FROM cells c
      JOIN rows_ r ON r.paper_id = c.paper_id AND r.gt = c.gt GROUP BY c.gt, c.pred)
    SELECT k.gt AS gt, lv.pred AS pred, n_repos, round(coalesce(sh, 0.0) / n_repos, 6) AS share
    FROM k, lv LEFT JOIN s ON s.gt = k.gt AND s.pred = lv.pred""",
)
def weighted_confusion(t):
    return rounded(M.weighted_confusion(t.v_scored, "type_gt", "type"))


@query(
    "config_summary",
    f"""
    WITH cells AS ({_cells('{v_scored_cfg}', 'config, paper_id,')}), m AS ({_margins('cells', 'config, paper_id,')}),
    s AS ({_cm('SELECT * FROM m', 'config, paper_id,')})
    SELECT a.config AS config, n_repos, accuracy, kappa, macro_f1, mcc, {', '.join(f'f1_{c}' for c in FILE_CLASSES)}
    FROM (SELECT config, count(*) AS n_repos, round(avg(accuracy), 6) AS accuracy, round(avg(kappa), 6) AS kappa,
        round(avg(macro_f1), 6) AS macro_f1, round(avg(mcc), 6) AS mcc FROM s GROUP BY config) a
    JOIN (SELECT config, {', '.join(f"round(avg(CASE WHEN cls = '{c}' THEN {EVAL_F1} END), 6) AS f1_{c}" for c in FILE_CLASSES)}
      FROM m GROUP BY config) b ON a.config = b.config""",
)
def config_summary(t):
    return rounded(M.config_summary(t.v_scored_cfg, FILE_CLASSES))


@query(
    "top_pairs",
    f"""
    WITH cells AS ({_cells('{v_scored_cfg}', 'config,')}),
    w AS (SELECT *, row_number() OVER (PARTITION BY config ORDER BY n DESC, gt, pred) AS k,
      sum(n) OVER (PARTITION BY config) AS total FROM cells WHERE gt <> pred)
    SELECT config, gt, pred, n, round(100.0 * n / total, 6) AS share FROM w WHERE k <= 5""",
)
def top_pairs(t):
    return rounded(M.top_pairs(M.confusion(t.v_scored_cfg, "type_gt", "type", ["config"]), 5, ["config"]))


@query(
    "top_pairs_pooled",
    f"""
    WITH w AS (SELECT * FROM ({_cells('{v_scored}')}) c WHERE gt <> pred)
    SELECT gt, pred, n, round(100.0 * n / (SELECT sum(n) FROM w), 6) AS share FROM w ORDER BY n DESC, gt, pred LIMIT 6""",
)
def top_pairs_pooled(t):
    return rounded(M.top_pairs(M.confusion(t.v_scored, "type_gt", "type"), 6))


@query(
    "ext_errors",
    f"""
    WITH s AS (SELECT ext, type_gt, type, count(*) AS n FROM {{v_scored}} WHERE {OK} GROUP BY ext, type_gt, type),
    w AS (SELECT ext, type_gt || '→' || type AS top_pair,
      row_number() OVER (PARTITION BY ext ORDER BY n DESC, type_gt || '→' || type) AS k FROM s WHERE type_gt <> type)
    SELECT a.ext AS ext, n_files, n_errors, top_pair, round(100.0 * n_errors / n_files, 6) AS error_rate
    FROM (SELECT ext, CAST(sum(n) AS BIGINT) AS n_files,
        CAST(sum(CASE WHEN type_gt <> type THEN n ELSE 0 END) AS BIGINT) AS n_errors FROM s GROUP BY ext) a
    LEFT JOIN w ON w.ext = a.ext AND w.k = 1 WHERE n_files >= 5""",
)
def ext_errors(t):
    return rounded(M.extension_errors(t.v_scored))


_FIELDS = [("type", "type_gt", "type"), ("group", "group_gt", "group"),
           ("granularity", "data_granularity_gt", "data_granularity")]


@query(
    "method_accuracy",
    """
    WITH r AS (SELECT * FROM {v_scored} UNION ALL SELECT * REPLACE ('TOTAL' AS type_source) FROM {v_scored}),
    p AS (SELECT type_source, paper_id, """
    + ", ".join(
        f'count(*) FILTER (WHERE "{g}" IS NOT NULL AND "{p}" IS NOT NULL) AS n_{f}, '
        f'count(*) FILTER (WHERE "{g}" = "{p}") AS k_{f}'
        for f, g, p in _FIELDS
    )
    + """ FROM r GROUP BY type_source, paper_id)
    SELECT type_source, count(*) AS n_repos, CAST(sum(n_type) AS BIGINT) AS n_files, """
    + ", ".join(
        f"round(100.0 * sum(k_{f}) / nullif(sum(n_{f}), 0), 6) AS {f}_pooled, "
        f"round(avg(100.0 * k_{f} / nullif(n_{f}, 0)), 6) AS {f}_avg"
        for f, _, _ in _FIELDS
    )
    + f""", round(100.0 * sum(n_type) / (SELECT count(*) FROM {{v_scored}} WHERE {OK}), 6) AS coverage
    FROM p GROUP BY type_source""",
)
def method_accuracy(t):
    return rounded(M.accuracy_by(t.v_scored, "type_source", _FIELDS))


@query(
    "granularity_by_source",
    """
    WITH d AS (SELECT * FROM {v_scored} WHERE type_gt = 'data'),
    p AS (SELECT prompt_nr % 4 AS src, paper_id, count(*) AS n,
      count(*) FILTER (WHERE data_granularity_gt = data_granularity) AS k FROM d GROUP BY 1, 2)
    SELECT src, count(*) AS n_repos, CAST(sum(n) AS BIGINT) AS n_files, round(100.0 * sum(k) / sum(n), 6) AS granularity_pooled,
      round(avg(100.0 * k / n), 6) AS granularity_avg, round(100.0 * sum(n) / (SELECT count(*) FROM d), 6) AS coverage
    FROM p GROUP BY src""",
)
def granularity_by_source(t):
    rows = t.v_scored.where("type_gt = 'data'").withColumn("src", F.col("prompt_nr") % 4)
    field = [("granularity", "data_granularity_gt", "data_granularity")]
    return rounded(M.accuracy_by(rows, "src", field, total=None))


@query(
    "type_method_matrix",
    "SELECT type_gt, "
    + ", ".join(
        f"count(*) FILTER (WHERE type_source = '{m}') AS n_{m}, "
        f"round(100.0 * avg(CASE WHEN type_source = '{m}' THEN CASE WHEN type_gt = type THEN 1.0 ELSE 0.0 END END), 6) AS acc_{m}"
        for m in ("llm", "aggregate_llm", "fixed_ext_rule")
    )
    + f" FROM {{v_scored}} WHERE {OK} GROUP BY type_gt",
)
def type_method_matrix(t):
    return rounded(M.type_method_matrix(t.v_scored, ["llm", "aggregate_llm", "fixed_ext_rule"]))


@query(
    "group_accuracy_by_type",
    """
    WITH p AS (SELECT type_gt, paper_id, count(*) FILTER (WHERE "group" IS NOT NULL AND group_gt IS NOT NULL) AS n,
      count(*) FILTER (WHERE group_gt = "group") AS k FROM {v_scored} WHERE type_gt IS NOT NULL GROUP BY type_gt, paper_id)
    SELECT type_gt, count(*) AS n_repos, CAST(sum(n) AS BIGINT) AS n_files, round(100.0 * sum(k) / nullif(sum(n), 0), 6) AS group_pooled,
      round(avg(100.0 * k / nullif(n, 0)), 6) AS group_avg,
      round(100.0 * sum(n) / (SELECT count(*) FROM {v_scored} WHERE "group" IS NOT NULL AND group_gt IS NOT NULL), 6) AS coverage
    FROM p GROUP BY type_gt""",
)
def group_accuracy_by_type(t):
    return rounded(M.accuracy_by(t.v_scored, "type_gt", [("group", "group_gt", "group")], total=None))


@query(
    "fp_fn_breakdown",
    f"""
    WITH w AS (SELECT CASE WHEN pred = 'data' THEN 'fp' ELSE 'fn' END AS kind,
      CASE WHEN pred = 'data' THEN gt ELSE pred END AS other, n FROM ({_cells('{v_scored}')}) c
      WHERE gt <> pred AND (gt = 'data' OR pred = 'data'))
    SELECT kind, other, CAST(sum(n) AS BIGINT) AS n, round(100.0 * sum(n) / sum(sum(n)) OVER (PARTITION BY kind), 6) AS share
    FROM w GROUP BY kind, other""",
)
def fp_fn_breakdown(t):
    return rounded(M.confused_with(M.confusion(t.v_scored, "type_gt", "type"), "data"))


@query(
    "subtype_recall",
    """
    WITH r AS (SELECT data_format_gt AS subtype, paper_id, count(*) AS n,
        100.0 * avg(CASE WHEN type IS NULL THEN NULL WHEN type = 'data' THEN 1.0 ELSE 0.0 END) AS v FROM {v_scored}
      WHERE type_gt = 'data' AND data_format_gt IS NOT NULL GROUP BY data_format_gt, paper_id),
    p AS (SELECT data_format AS subtype, paper_id, count(*) AS n,
        100.0 * avg(CASE WHEN type_gt = 'data' THEN 1.0 ELSE 0.0 END) AS v FROM {v_scored}
      WHERE type = 'data' AND data_format IS NOT NULL GROUP BY data_format, paper_id),
    ra AS (SELECT subtype, CAST(sum(n) AS BIGINT) AS n_true, round(avg(v), 6) AS recall_avg FROM r GROUP BY subtype),
    pa AS (SELECT subtype, CAST(sum(n) AS BIGINT) AS n_predicted, round(avg(v), 6) AS precision_avg FROM p GROUP BY subtype)
    SELECT coalesce(ra.subtype, pa.subtype) AS subtype, n_true, recall_avg, n_predicted, precision_avg
    FROM ra FULL JOIN pa ON ra.subtype = pa.subtype""",
)
def subtype_recall(t):
    return rounded(M.subtype_rates(t.v_scored, "data_format"))


_BOTH = "data_granularity IS NOT NULL AND data_granularity_gt IS NOT NULL"


@query(
    "binary_field",
    f"""
    WITH p AS (SELECT config, paper_id,
      100.0 * avg(CASE WHEN type_gt = 'data' AND type IS NOT NULL THEN CASE WHEN type = 'data' THEN 1.0 ELSE 0.0 END END) AS rd,
      100.0 * avg(CASE WHEN {_BOTH} THEN CASE WHEN data_granularity = data_granularity_gt THEN 1.0 ELSE 0.0 END END) AS acc,
      100.0 * avg(CASE WHEN {_BOTH} AND data_granularity_gt = 'individual' THEN
        CASE WHEN data_granularity = 'individual' THEN 1.0 ELSE 0.0 END END) AS ri,
      100.0 * avg(CASE WHEN {_BOTH} AND data_granularity_gt = 'combined' THEN
        CASE WHEN data_granularity = 'combined' THEN 1.0 ELSE 0.0 END END) AS rc
      FROM {{v_scored_cfg}} GROUP BY config, paper_id)
    SELECT config, round(avg(rd), 6) AS recall_data, round(avg(acc), 6) AS accuracy,
      round(avg(ri), 6) AS recall_individual, round(avg(rc), 6) AS recall_combined FROM p GROUP BY config""",
)
def binary_field(t):
    return rounded(M.binary_field(t.v_scored_cfg, "data_granularity", ["individual", "combined"]))


@query(
    "group_split",
    """
    WITH p AS (SELECT paper_id, count(DISTINCT group_gt) AS g,
      100.0 * avg(CASE WHEN group_gt = "group" THEN 1.0 ELSE 0.0 END) AS acc FROM {v_scored}
      WHERE group_gt IS NOT NULL GROUP BY paper_id)
    SELECT CASE WHEN g >= 2 THEN 'multi' ELSE 'single' END AS kind, count(*) AS n_repos, round(avg(acc), 6) AS acc_avg
    FROM p GROUP BY 1""",
)
def group_split(t):
    return rounded(M.group_split(t.v_scored))


@query(
    "missingness",
    f"""
    WITH tall AS (
      SELECT config, 'type' AS field, type_gt AS g, type AS p FROM {{v_scored_cfg}} UNION ALL
      SELECT config, 'group', group_gt, "group" FROM {{v_scored_cfg}} UNION ALL
      SELECT config, 'data_granularity', data_granularity_gt, data_granularity FROM {{v_scored_cfg}}),
    k AS (SELECT * FROM tall WHERE g IS NOT NULL),
    cells AS (SELECT config, field, g AS gt, p AS pred, count(*) AS n FROM k WHERE p IS NOT NULL AND p <> 'llm_error'
      GROUP BY config, field, g, p),
    s AS ({_cm(_margins('cells', 'config, field,'), 'config, field,')})
    SELECT a.config AS config, a.field AS field, n_rows, pct_null, pct_sentinel, round(accuracy, 6) AS accuracy,
      round(kappa, 6) AS kappa, round(macro_f1, 6) AS macro_f1
    FROM (SELECT config, field, count(*) AS n_rows, round(100.0 * count(*) FILTER (WHERE p IS NULL) / count(*), 6) AS pct_null,
      round(100.0 * count(*) FILTER (WHERE p = 'llm_error') / count(*), 6) AS pct_sentinel FROM k GROUP BY config, field) a
    LEFT JOIN s ON s.config = a.config AND s.field = a.field""",
)
def missingness(t):
    return rounded(M.missingness(t.v_scored_cfg, ["type", "group", "data_granularity"]))


@query(
    "prompt_fail",
    """
    WITH b AS (SELECT config, paper_id, prompt_nr, bool_or(coalesce(type = 'llm_error', false)) AS f FROM {v_scored_cfg}
      GROUP BY config, paper_id, prompt_nr)
    SELECT config, count(*) AS n_batches, round(100.0 * avg(CASE WHEN f THEN 1.0 ELSE 0.0 END), 6) AS pct_failed
    FROM b GROUP BY config""",
)
def prompt_fail(t):
    return rounded(M.batch_failures(t.v_scored_cfg, ["config"]))


# customers as repositories where there are too few sources: one score per customer
_CUST = """
    c AS (SELECT o_custkey AS paper_id, count(*) AS n, 100.0 * avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS type_acc
      FROM {orders} GROUP BY o_custkey)"""


def _customers(t):
    return t.orders.groupBy(F.col("o_custkey").alias("paper_id")).agg(
        F.count("*").alias("n"),
        (100.0 * F.avg((F.col("o_orderstatus") == "F").cast("double"))).alias("type_acc"),
    )


@query(
    "reliability",
    f"""
    WITH {_CUST}
    SELECT count(type_acc) AS n_repos, round(avg(type_acc), 6) AS mean, round(stddev_samp(type_acc), 6) AS sd,
      round(min(type_acc), 6) AS min, round(max(type_acc), 6) AS max,
      round(100.0 * count(*) FILTER (WHERE type_acc < 50) / count(type_acc), 6) AS pct_below_50,
      count(*) FILTER (WHERE type_acc / 100 >= 0.8) AS n_high_kappa, round(median(type_acc), 6) AS median,
      round(quantile_cont(type_acc, 0.25), 6) AS p25, round(quantile_cont(type_acc, 0.75), 6) AS p75,
      round(quantile_cont(type_acc, 0.75) - quantile_cont(type_acc, 0.25), 6) AS iqr FROM c""",
)
def reliability(t):
    return rounded(M.reliability(_customers(t).withColumn("kappa", F.col("type_acc") / 100)))


@query(
    "score_buckets",
    f"""
    WITH {_CUST}
    SELECT CASE WHEN type_acc <= 50 THEN '<50%' WHEN type_acc <= 70 THEN '50–70%' WHEN type_acc <= 85 THEN '70–85%'
        WHEN type_acc <= 95 THEN '85–95%' ELSE '95–100%' END AS bucket,
      CASE WHEN type_acc / 100 < 0.2 THEN 'slight (0.00–0.20)' WHEN type_acc / 100 < 0.4 THEN 'fair (0.20–0.40)'
        WHEN type_acc / 100 < 0.6 THEN 'moderate (0.40–0.60)' WHEN type_acc / 100 < 0.8 THEN 'substantial (0.60–0.80)'
        ELSE 'almost perfect (0.80–1.00)' END AS band, count(*) AS n_repos
    FROM c GROUP BY 1, 2""",
)
def score_buckets(t):
    return M.score_buckets(_customers(t).withColumn("kappa", F.col("type_acc") / 100))


@query(
    "worst_repos",
    f"WITH {PER_REPO} SELECT paper_id, n, round(kappa, 6) AS kappa FROM s ORDER BY kappa, paper_id LIMIT 5",
)
def worst_repos(t):
    stats = M.cm_stats(M.confusion(t.v_scored, "type_gt", "type", ["paper_id"]), ["paper_id"], "report")
    return rounded(M.worst(stats.select("paper_id", "n", "kappa"), "kappa", 5))


@query(
    "size_quartiles",
    f"""
    WITH {_CUST},
    q AS (SELECT quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS q2, quantile_cont(n, 0.75) AS q3 FROM c),
    b AS (SELECT c.*, CASE WHEN n <= q1 THEN 1 WHEN n <= q2 THEN 2 WHEN n <= q3 THEN 3 ELSE 4 END AS bin FROM c, q)
    SELECT bin, count(*) AS n_repos, min(n) AS min_size, max(n) AS max_size, round(avg(type_acc), 6) AS avg_type_acc,
      round(median(n), 6) AS median_size FROM b GROUP BY bin""",
)
def size_quartiles(t):
    return rounded(M.size_quartiles(_customers(t), "n", ["type_acc"]))


@query(
    "size_effect",
    f"""
    WITH {_CUST},
    r AS (SELECT n, type_acc AS y FROM c),
    ra AS (SELECT rank() OVER (ORDER BY n) + (count(*) OVER (PARTITION BY n) - 1) / 2.0 AS rn,
      rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM r),
    rl AS (SELECT rank() OVER (ORDER BY n) + (count(*) OVER (PARTITION BY n) - 1) / 2.0 AS rn,
      rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM r WHERE n >= 12),
    w AS (SELECT sum(n) AS w, sum(n * ln(n)) / sum(n) AS mx, sum(n * y) / sum(n) AS my FROM r),
    v AS (SELECT sum(n * (ln(n) - mx) * (y - my)) / sqrt(sum(n * (ln(n) - mx) * (ln(n) - mx)) * sum(n * (y - my) * (y - my))) AS x
      FROM r, w)
    SELECT (SELECT round(corr(rn, ry), 6) FROM rl) AS rho_large, (SELECT count(*) FROM rl) AS n_large,
      (SELECT round(corr(rn, ry), 6) FROM ra) AS rho_all, (SELECT count(*) FROM ra) AS n_all,
      (SELECT round(x, 6) FROM v) AS weighted_r""",
)
def size_effect(t):
    return rounded(M.size_effect(_customers(t), "n", "type_acc", min_size=12))


@query(
    "format_effect",
    f"""
    WITH cells AS ({_cells('{v_scored_cfg}', 'config, paper_id,')}),
    s AS ({_cm(_margins('cells', 'config, paper_id,'), 'config, paper_id,')}),
    k AS (SELECT regexp_extract(config, '^(.*)_([^_]+)$', 1) AS model, regexp_extract(config, '^(.*)_([^_]+)$', 2) AS format,
      macro_f1 FROM s),
    a AS (SELECT model, format, avg(macro_f1) AS m FROM k GROUP BY model, format)
    SELECT model AS level, 'model' AS within, count(*) AS n_levels, round(min(m), 6) AS lowest, round(max(m), 6) AS highest,
      round(max(m) - min(m), 6) AS spread FROM a GROUP BY model
    UNION ALL
    SELECT format, 'format', count(*), round(min(m), 6), round(max(m), 6), round(max(m) - min(m), 6) FROM a GROUP BY format""",
)
def format_effect(t):
    from tablewarden.functions.grading import config_format, config_model

    keys = ["config", "paper_id"]
    stats = M.cm_stats(M.confusion(t.v_scored_cfg, "type_gt", "type", keys), keys)
    tagged = stats.withColumn("model", config_model(F.col("config"))).withColumn(
        "format", config_format(F.col("config"))
    )
    return rounded(
        M.spread_between(tagged, "model", "format", "macro_f1").unionByName(
            M.spread_between(tagged, "format", "model", "macro_f1")
        )
    )


@query(
    "winner",
    f"""
    WITH cells AS ({_cells('{v_scored_cfg}', 'config, paper_id,')}),
    s AS ({_cm(_margins('cells', 'config, paper_id,'), 'config, paper_id,')}),
    a AS (SELECT config, avg(macro_f1) AS f, count(*) AS k FROM s GROUP BY config)
    SELECT config, round(f, 6) AS avg_macro_f1, k AS n_repos FROM a WHERE k >= 0.8 * (SELECT max(k) FROM a)
    ORDER BY f DESC, config LIMIT 1""",
)
def winner(t):
    keys = ["config", "paper_id"]
    stats = M.cm_stats(M.confusion(t.v_scored_cfg, "type_gt", "type", keys), keys)
    return rounded(M.winner(M.averaged(stats, ["config"], "macro_f1"), score="avg_macro_f1"))


@query(
    "score_join",
    """
    SELECT f.type_gt AS type_gt, count(*) AS n, count(l.doc_id) AS n_answered FROM {v_files} f
    LEFT JOIN {labels} l ON l.doc_id = f.ord GROUP BY f.type_gt""",
)
def score_join(t):
    predicted = t.labels.select(F.col("doc_id").alias("ord"), "quality")
    joined = M.score_join(t.v_files.select("ord", "type_gt"), predicted, on=["ord"])
    return joined.groupBy("type_gt").agg(F.count("*").alias("n"), F.count("quality").alias("n_answered"))


@query(
    "ab_summary",
    """
    SELECT config AS condition, count(*) AS n_files,
      round(100.0 * avg(CASE WHEN type_gt = type THEN 1.0 ELSE 0.0 END), 6) AS type_acc,
      round(100.0 * avg(CASE WHEN group_gt = "group" THEN 1.0 ELSE 0.0 END), 6) AS group_acc,
      round(100.0 * avg(CASE WHEN data_granularity_gt IS NOT NULL THEN
        CASE WHEN data_granularity_gt = data_granularity THEN 1.0 ELSE 0.0 END END), 6) AS data_granularity_acc,
      round(avg(size), 6) AS mean_ms
    FROM {v_scored_cfg} WHERE config <> 'm20_json' GROUP BY config""",
)
def ab_summary(t):
    rows = t.v_scored_cfg.withColumn("condition", F.col("config")).withColumn("elapsed_ms", F.col("size"))
    return rounded(C.ab_summary(rows, ["m20_md", "m120_md"]))


@query(
    "ab_recall",
    "SELECT type_gt, "
    + ", ".join(
        f"round(100.0 * avg(CASE WHEN config = '{c}' THEN CASE WHEN type_gt = type THEN 1.0 ELSE 0.0 END END), 6) AS recall_{c}"
        for c in ("m20_md", "m120_md")
    )
    + " FROM {v_scored_cfg} GROUP BY type_gt",
)
def ab_recall(t):
    return rounded(C.ab_recall(t.v_scored_cfg.withColumnRenamed("config", "condition"), ["m20_md", "m120_md"]))


