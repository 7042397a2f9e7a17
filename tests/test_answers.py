from tablewarden.operators import answers as A
from tablewarden.operators import runlog as R
from tablewarden.operators import stability as S

ITEM = "paper_id string, batch bigint, rel_path string, ord bigint"


def merged(spark, n, replies):
    items = spark.createDataFrame([("p", 1, f"f{i}", i) for i in range(n)], ITEM)
    answers = spark.createDataFrame([("p", 1, *r, i) for i, r in enumerate(replies)],
                                    "paper_id string, batch bigint, rel_path string, type string, group string, ord bigint")
    out = A.merge_answers(items, answers).orderBy("rel_path").collect()
    assert len(out) == n
    return [(r["type"], r["group"]) for r in out]


def test_good_batch(spark):
    assert merged(spark, 2, [("f0", "data", "ex1"), ("f1", "code", "study 2")]) == [("data", "ex1"), ("code", "shared")]


def test_short_batch_falls_to_the_sentinel(spark):
    assert merged(spark, 2, [("f0", "data", "ex1")]) == [("llm_error", "shared")] * 2
    assert merged(spark, 2, []) == [("llm_error", "shared")] * 2


def test_repeated_key_counts_once_and_the_lost_item_takes_the_fallback(spark):
    assert merged(spark, 2, [("f0", "data", "ex1"), ("f0", "code", "ex2")]) == [("data", "ex1"), ("other", "shared")]


def test_unknown_type_or_absent_field_spoils_the_batch(spark):
    assert merged(spark, 2, [("f0", "datum", "ex1"), ("f1", "code", "ex2")]) == [("llm_error", "shared")] * 2
    assert merged(spark, 2, [("f0", "data", None), ("f1", "code", None)]) == [("llm_error", "shared")] * 2


def test_user_classifier_runs_per_batch(spark):
    import pandas as pd

    items = spark.createDataFrame([("p", i // 3, f"f{i}", i) for i in range(7)], ITEM)

    def classify(frame):
        rows = [(r.paper_id, r.batch, p, "data", "ex1", i) for r in frame.itertuples() for i, p in enumerate(r.paths)]
        return pd.DataFrame(rows, columns=["paper_id", "batch", "rel_path", "type", "group", "ord"])

    answers = A.ask(items, classify, "paper_id string, batch bigint, rel_path string, type string, group string, ord bigint")
    out = A.merge_answers(items, answers)
    assert out.where("batch_ok and type = 'data'").count() == 7


def test_overlay_is_idempotent_and_skips_repeated_paths(spark):
    base = spark.createDataFrame(
        [("p", "a", "data", "ex1", None), ("p", "b", "data", "ex1", None), ("p", "b", "code", "ex1", None)],
        "paper_id string, rel_path string, type string, group string, data_granularity string",
    )
    truth = spark.createDataFrame(
        [("p", "a", "asset", "", "combined"), ("p", "b", "asset", None, None), ("p", "c", "asset", None, None)],
        "paper_id string, rel_path string, type_gt string, group_gt string, data_granularity_gt string",
    )
    once = A.overlay(base, truth)
    got = sorted((r["rel_path"], r["type"], r["group"], r["data_granularity"], r["ground_truth_validated"]) for r in once.collect())
    assert got == [("a", "asset", "ex1", "combined", True), ("b", "code", "ex1", None, False), ("b", "data", "ex1", None, False)]
    again = A.overlay(once.drop("ground_truth_validated"), truth)
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    assert {(r["rel_path"], r["n_matches"]) for r in A.overlay_mismatches(base, truth).collect()} == {("b", 2), ("c", 0)}


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = R.upsert(base, new, ["k"])
    assert sorted(R.upsert(once, new, ["k"]).collect()) == sorted(once.collect()) == [(1, "a"), (2, "B"), (3, "C")]


RUNS = "paper_id string, temperature double, repeat int, status string"
ROWS = "paper_id string, temperature double, repeat int, key string, value string, ord int"


def test_stability_edges(spark):
    runs = spark.createDataFrame(
        [("p", 0.0, 1, "ok"), ("p", 0.0, 2, "ok"), ("p", 0.0, 3, "failed"), ("p", 0.5, 1, "ok"), ("p", 1.0, 1, "ok"), ("p", 1.0, 2, "ok")], RUNS
    )
    rows = spark.createDataFrame(
        [("p", 0.0, 1, "a", "x", 1), ("p", 0.0, 1, "a", "y", 2), ("p", 0.0, 1, "b", "x", 3), ("p", 0.0, 1, "n", None, 4),
         ("p", 0.0, 2, "a", "x", 1), ("p", 0.0, 2, "c", "x", 2), ("p", 0.0, 2, "n", None, 3), ("p", 0.0, 3, "a", "z", 1),
         ("p", 1.0, 1, "a", "x", 1)], ROWS,
    )
    got = {r["temperature"]: r for r in S.stability(runs, rows).collect()}
    # keys a, b, c, n: only a agrees
    assert (got[0.0]["agreement"], got[0.0]["n_pairs"], got[0.0]["n_keys_compared"]) == (0.25, 1, 4)
    assert got[0.5]["agreement"] is None and got[0.5]["n_pairs"] == 0
    assert got[1.0]["agreement"] is None


def test_run_without_columns_counts_zero(spark):
    runs = spark.createDataFrame([("p", 0.0, 1, "ok"), ("p", 0.0, 2, "ok")], RUNS)
    columns = spark.createDataFrame([("p", 0.0, 1, "binary")], "paper_id string, temperature double, repeat int, col_type string")
    coverage = spark.createDataFrame([("p", 0.0, 1, "matched")], "paper_id string, temperature double, repeat int, match_status string")
    labels = spark.createDataFrame([], "paper_id string, temperature double, repeat int, label string")
    q = S.run_quality(runs, columns, coverage, labels).first()
    assert (q["known_type_rate"], q["codebook_coverage_rate"], q["nonempty_label_rate"]) == (0.5, 1.0, None)


def test_fingerprint_ignores_order_and_sees_changes(spark):
    truth = spark.createDataFrame([("a", "x", "easy"), ("b", "y", "hard"), ("c", "y", "hard")], "path string, type_gt string, difficulty string")
    pred = spark.createDataFrame(
        [(1, "a", "x"), (1, "b", "y"), (2, "b", "y"), (2, "a", "x"), (3, "a", "x"), (3, "b", "x"), (4, "zz", "x")], "run int, path string, type string"
    )
    got = {r["run"]: r for r in S.repeat_scores(truth, pred, ["run"]).collect()}
    assert got[1]["fingerprint"] == got[2]["fingerprint"] != got[3]["fingerprint"]
    assert (got[1]["n_correct"], got[1]["n_path_miss"], got[4]["n_path_miss"], got[4]["n_correct"]) == (2, 1, 3, 0)
