import pytest
from pyspark.sql import functions as F

from tablewarden.operators import metrics as M


def scored(spark, pairs):
    rows = [(p, f"f{i}.csv", g, t) for i, (p, g, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, "paper_id string, rel_path string, type_gt string, type string")


def stats(spark, pairs, policy):
    cells = M.confusion(scored(spark, pairs), "type_gt", "type")
    return M.cm_stats(cells, policy=policy).first()


def test_single_class_has_no_kappa(spark):
    s = stats(spark, [("p", "a", "a")] * 3, "eval")
    assert s["accuracy"] == 100 and s["kappa"] is None and s["mcc"] is None and s["macro_f1"] == 100


def test_never_predicted_class_scores_zero_or_is_left_out(spark):
    pairs = [("p", "a", "a"), ("p", "a", "a"), ("p", "b", "a")]
    assert stats(spark, pairs, "eval")["macro_f1"] == pytest.approx((80 + 0) / 2)
    assert stats(spark, pairs, "report")["macro_f1"] == pytest.approx(80)


def test_nothing_correct(spark):
    pairs = [("p", "a", "b"), ("p", "b", "a")]
    assert stats(spark, pairs, "eval")["macro_f1"] == 0
    assert stats(spark, pairs, "report")["macro_f1"] is None
    assert stats(spark, pairs, "eval")["kappa"] == pytest.approx(-1)


def test_empty_input(spark):
    df = scored(spark, [("p", "a", None)])
    cells = M.confusion(df, "type_gt", "type")
    assert cells.count() == 0 and M.cm_stats(cells).count() == 0


def test_kappa_and_mcc_by_hand(spark):
    pairs = [("p", "a", "a")] * 4 + [("p", "a", "b")] + [("p", "b", "b")] * 3 + [("p", "b", "a")] * 2
    s = stats(spark, pairs, "eval")
    assert s["kappa"] == pytest.approx((0.7 - 0.5) / 0.5)
    assert s["mcc"] == pytest.approx((10 * 7 - 50) / ((100 - 52) * (100 - 50)) ** 0.5)
    assert abs(s["kappa"]) <= 1


def test_confusion_sums_to_the_scored_rows(spark):
    pairs = [("p", "a", "b"), ("q", "a", "a"), ("q", "b", None)]
    assert M.confusion(scored(spark, pairs), "type_gt", "type").agg(F.sum("n")).first()[0] == 2


def test_sentinel_is_a_miss_but_no_class(spark):
    pairs = [("p", "a", "a"), ("p", "a", "llm_error"), ("p", "b", "b")]
    cells = M.confusion(scored(spark, pairs), "type_gt", "type")
    row = M.micro_f1(cells, sentinel="llm_error").first()
    assert (row["tp"], row["fp"], row["fn"]) == (2, 0, 1)
    assert row["micro_f1"] == pytest.approx(80.0)


def test_weighted_confusion_rows_sum_to_one(spark):
    pairs = [("p", "a", "a"), ("p", "a", "b"), ("q", "a", "a"), ("q", "b", "b")]
    out = M.weighted_confusion(scored(spark, pairs), "type_gt", "type").collect()
    assert {(r["gt"], r["pred"]): r["share"] for r in out} == {
        ("a", "a"): 0.75, ("a", "b"): 0.25, ("b", "a"): 0.0, ("b", "b"): 1.0
    }


def test_equal_sizes_share_a_bin(spark):
    df = spark.createDataFrame([(str(i), s, 1.0) for i, s in enumerate([1, 1, 1, 1, 5, 9])], "paper_id string, n int, y double")
    got = M.size_quartiles(df, "n", ["y"]).collect()
    assert {r["bin"]: (r["n_repos"], r["min_size"], r["max_size"]) for r in got} == {1: (4, 1, 1), 4: (2, 5, 9)}


def test_average_ranks(spark):
    df = spark.createDataFrame([(v,) for v in [3.0, 1.0, 3.0, 2.0, 3.0]], "v double")
    got = sorted((r["v"], r["r"]) for r in M.average_rank(df, "v", "r").collect())
    assert got == [(1.0, 1.0), (2.0, 2.0), (3.0, 4.0), (3.0, 4.0), (3.0, 4.0)]
