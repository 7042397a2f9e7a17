import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewarden.operators import profile as P


def cells(spark, **columns):
    rows = []
    for pos, (name, values) in enumerate(columns.items(), 1):
        rows += [(pos, name.replace("__", "-"), i, v) for i, v in enumerate(values, 1)]
    return spark.createDataFrame(rows, "col_pos int, column_name string, ord bigint, value string")


def types(spark, **columns):
    out = P.resolve_types(P.infer_types(cells(spark, **columns)))
    return {r["column_name"]: r for r in out.collect()}


def test_moments_on_tiny_columns(spark):
    rows = [("n1", 3.0), ("n2", 1.0), ("n2", 2.0), ("n3", 1.0), ("n3", 2.0), ("n3", 6.0), ("same", 4.0), ("same", 4.0),
            ("same", 4.0), ("same", 4.0), ("nan", float("nan")), ("nan", None), ("nan", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in P.profile_table(df, ["v"], ["k"]).collect()}
    assert got["n1"]["sd"] is None and got["n1"]["skewness"] is None and got["n1"]["median"] == 3.0
    assert got["n2"]["sd"] == pytest.approx(math.sqrt(0.5)) and got["n2"]["skewness"] is None
    x = [1.0, 2.0, 6.0]
    m = sum(x) / 3
    sd = math.sqrt(sum((v - m) ** 2 for v in x) / 2)
    assert got["n3"]["skewness"] == pytest.approx(sum((v - m) ** 3 for v in x) / 3 / sd**3)
    assert got["n3"]["kurtosis"] is None
    assert got["same"]["sd"] == 0 and got["same"]["kurtosis"] is None and got["same"]["n_unique"] == 1
    assert (got["nan"]["n"], got["nan"]["n_missing"], got["nan"]["n_unique"]) == (1, 2, 1)
    assert got["none"]["mean"] is None and got["none"]["n_missing"] == 1


def test_type_ladder(spark):
    got = types(
        spark,
        empty=[None, "NA", None],
        blank=[" ", "", " "],
        Participant_ID=["x", "y", "z"],
        identity=["a", "b", "c"],
        sub__01=["1", "2", "3"],
        one=["5", "5", None],
        two=["5", "6", "5"],
        three=["1", "2", "3"],
        twenty=[str(i) for i in range(20)],
        twentyone=[str(i) for i in range(21)],
        fraction=["1", "2.5", "3"],
        gaps=["1", " ", "2.5", "3"],
        dates=["2023-01-02", "2023/2/3 noon", "2023-02-30", "2020-12-31"],
        day_first=["01-02-2020", "31-12-2021", "15-11-2020", "9-9-1999"],
        few_dates=["2023-01-02", "x", "2023-02-30", "2020-12-31"],
        years=["1990", "1991", "1992"],
        logical=["TRUE", "FALSE", None],
        comma=["1,5"] + ["2,5"] * 17 + ["3,5", "n/a"],
        outliers=["1,5"] * 4 + ["2,5"] * 6 + ["3,5"] * 6 + ["a", "b", "c", "d"],
        words=["1,5"] * 3 + ["2,5"] * 6 + ["3,5"] * 6 + ["a", "b", "c", "d", "e"],
        len40=["a" * 40, "b" * 40, "c" * 40],
        len41=["a" * 41, "b" * 41, "c" * 41],
    )
    want = dict(
        empty="empty", blank="empty", Participant_ID="id", identity="text", one="constant", two="binary",
        three="continuous", twenty="continuous", twentyone="continuous", fraction="continuous", gaps="continuous",
        dates="date", few_dates="text",
        # read as year 1, month 2, day 20: a date by the prefix rule
        day_first="date", years="continuous", logical="binary", comma="continuous_comma_decimal",
        outliers="continuous_outliers_excluded", words="text", len40="text", len41="text",
    )
    assert {k: got[k]["col_type"] for k in want} == want
    assert got["sub-01"]["col_type"] == "id"
    assert got["len40"]["col_type_method"] == "fallback" and got["len41"]["col_type_method"] == "rules"
    assert (got["gaps"]["n"], got["gaps"]["n_missing"], got["gaps"]["n_unique"]) == (3, 1, 3)
    assert got["comma"]["n_coerced"] == 1 and got["outliers"]["n_coerced"] == 4


def test_answers_decide_open_text_columns(spark):
    base = P.infer_types(cells(spark, a=["x", "y", "z"], b=["x", "y", "z"], c=["x", "y", "z"], d=["1", "2", "3"]))
    answers = spark.createDataFrame(
        [("a", "ordinal"), ("b", "unknown"), ("c", "nonsense"), ("d", "ordinal")], "column_name string, answer string"
    )
    got = {r["column_name"]: (r["col_type"], r["col_type_method"]) for r in P.resolve_types(base, answers).collect()}
    assert got == {"a": ("ordinal", "llm"), "b": ("text", "llm"), "c": ("text", "llm"), "d": ("continuous", "rules")}


def test_statistics_only_for_continuous_columns(spark):
    out = P.describe_columns(cells(spark, a=["1", "2", "x", "y"], b=["1,5", "2,5", "4,5", None]))
    got = {r["column_name"]: r for r in out.collect()}
    assert got["a"]["mean"] is None
    assert got["b"]["mean"] == pytest.approx(17 / 6) and got["b"]["n_missing"] == 1


def test_samples_follow_file_order(spark):
    c = cells(spark, a=["9", None, "1", "9", "3", "2", "7"])
    assert P.sample_values(c).first()["sample_values"] == "9 | 1 | 9 | 3 | 2"
    assert P.distinct_samples(c, k=3).first()["sample_values_unique"] == "9, 1, 3"


def test_survey_header_is_stripped(spark):
    rows = [("f", 1, ["q"]), ("f", 2, ['{"ImportId":"x"}']), ("f", 3, ["1"]), ("g", 1, ["1"]), ("g", 2, ["2"]),
            ("late", 1, ["1"]), ("late", 2, ["1"]), ("late", 3, ["1"]), ("late", 4, ['{"ImportId":"x"}']),
            ("only", 1, ["q"]), ("only", 2, ['{"ImportId":"x"}']), ("single", 1, ['{"ImportId":"x"}'])]
    df = spark.createDataFrame(rows, "file string, row_nr int, cells array<string>")
    left = P.strip_export_header(df, ["file"], "row_nr", "cells").groupBy("file").count().collect()
    assert {r["file"]: r["count"] for r in left} == {"f": 1, "g": 2, "late": 4, "single": 1}


def test_weighted_distribution_counts_absent_as_zero(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "paper_id string, col_type string")
    got = {r["col_type"]: r["avg_pct"] for r in P.weighted_type_distribution(df).collect()}
    assert got == {"x": 75.0, "y": 25.0}
    assert P.unknown_rate(df.withColumn("col_type", F.lit("unknown"))).count() == 2


def test_words_for_no_number(spark):
    columns = {
        "v": [str(i % 30) for i in range(34)] + ["NaN", "Inf"],
        "w": ["NaN"] * 36,
        "late_dates": ["x"] * 20 + ["unused"] * 2 + [f"2020-01-{i + 1:02d}" for i in range(14)],
    }
    rows = [(i, *r) for i, r in enumerate(zip(*columns.values()))]
    cells = P.long_form(spark.createDataFrame(rows, ["ord", *columns]), list(columns), ["ord"])
    got = {r["column_name"]: r for r in P.infer_types(cells).collect()}
    assert (got["v"]["col_type"], got["v"]["n"], got["v"]["n_missing"], got["v"]["n_unique"]) == ("continuous", 35, 1, 31)
    assert got["w"]["col_type"] == "empty" and got["w"]["n_missing"] == 36
    assert got["late_dates"]["col_type"] == "date"
    assert {r["column_name"]: r["col_type"] for r in P.infer_types(cells, date_sample=1).collect()}["late_dates"] != "date"


@pytest.mark.parametrize("width", [1_000_000, 0])
def test_table_profile_from_frequencies(spark, monkeypatch, width):
    """Both ways to running counts, with missing, repeated and lonely values, against numpy."""
    monkeypatch.setattr(P, "SLICE_WIDTH", width)
    rng = np.random.default_rng(7)
    rows = [(k, None if rng.random() < 0.1 else round(float(rng.normal(5, 3)), 1), int(rng.integers(4))) for k in "ab" for _ in range(700)]
    rows += [("a", float("nan"), None), ("c", 4.0, 1), ("d", None, None), (None, 1.0, 2), (None, 2.0, 2), ("e", -0.0, 5), ("e", 0.0, 5)]
    df = spark.createDataFrame(rows, "k string, x double, n int")
    got = {(r["k"], r["column_name"]): r for r in P.profile_table(df, ["x", "n"], ["k"]).collect()}
    assert len(got) == 12
    for (k, name), r in got.items():
        own = [row[1 if name == "x" else 2] for row in rows if row[0] == k]
        v = np.array([x for x in own if x is not None and x == x], float)
        assert (r["n"], r["n_missing"], r["n_unique"]) == (len(v), len(own) - len(v), len(set(v.tolist())))
        if not len(v):
            assert r["mean"] is None and r["median"] is None
            continue
        want = {"mean": v.mean(), "min": v.min(), "max": v.max(), "median": np.median(v), "p25": np.quantile(v, 0.25), "p75": np.quantile(v, 0.75)}
        if len(v) > 1:
            want["sd"] = v.std(ddof=1)
        if len(v) > 3 and v.std() > 0:
            d, sd = v - v.mean(), v.std(ddof=1)
            want |= {"skewness": (d**3).mean() / sd**3, "kurtosis": (d**4).mean() / sd**4 - 3}
        for stat, w in want.items():
            assert r[stat] == pytest.approx(w, abs=1e-9), (k, name, stat)


def test_table_profile_reads_the_table_twice(spark, tmp_path):
    spark.createDataFrame([(1, 2.0), (2, 3.0)], "a int, b double").write.parquet(str(tmp_path / "t"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    once = plan(P.frequencies(spark.read.parquet(str(tmp_path / "t")), ["a", "b"]))
    assert once.count("FileScan") == 1 and once.count("Exchange") == 1
    rest = plan(P.profile_table(spark.read.parquet(str(tmp_path / "t")), ["a", "b"]))
    assert rest.split("Initial Plan")[-1].count("FileScan") == 1


def test_read_budget_is_linear_in_the_files_of_a_repository(spark):
    n = 50_000
    files = spark.range(n).select(F.lit("p").alias("paper_id"), F.col("id").alias("ord"), (F.col("id") % 97 + 1).alias("size"))
    start = time.monotonic()
    read = P.read_budget(files, ["paper_id"], "ord", "size", 90, 1_000_000)
    got = {r["ord"] for r in read.where("is_read").collect()}
    left, want = 1_000_000, set()
    for i in range(n):
        size = i % 97 + 1
        if size <= 90 and size <= left:
            left -= size
            want.add(i)
    assert got == want and time.monotonic() - start < 60
