"""The building blocks against brute force, with one key holding most rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewarden.operators import scale as S
from tablewarden.operators.profile import read_budget
from tablewarden.session import tune


def skewed(n=3000, seed=7):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 else r.choice(["a", "b", None])
        rows.append((key, i, round(r.lognormvariate(0, 2), r.choice([0, 3])), f"s{r.randrange(10**6):06d}-{i}"))
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(skewed(), "k string, ord bigint, v double, name string").repartition(5)


@pytest.mark.parametrize("how", ["ordinal", "sorted"])
def test_positions_match_a_sequential_count(frame, how):
    if how == "ordinal":
        got = S.positions(frame, ["k"], "ord", width=100)
        sort = lambda r: r[1]
    else:
        got = S.positions(frame, ["k"], [F.col("name")], width=None)
        sort = lambda r: r[3]
    expected, seen = {}, {}
    for row in sorted(skewed(), key=sort):
        seen[row[0]] = seen.get(row[0], 0) + 1
        expected[row[1]] = seen[row[0]]
    assert {r["ord"]: r["pos"] for r in got.collect()} == expected


def test_running_weight_without_key(frame):
    got = S.positions(frame, [], "ord", out="run", weight="ord", width=250).collect()
    assert {r["ord"]: r["run"] for r in got} == {i: i * (i + 1) // 2 for i in range(3000)}


@pytest.mark.parametrize("small", [10**6, 50, 0])
def test_quantiles_equal_numpy_on_every_way(spark, frame, small):
    probs = {"p0": 0.0, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p100": 1.0}
    accuracy = 10_000 if small else 400
    got = S.exact_quantiles(frame, ["k"], "v", probs, small=small, accuracy=accuracy).collect()
    for row in got:
        values = [v for k, _, v, _ in skewed() if k == row["k"]]
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(values, p))
    assert len(got) == 4


def test_quantiles_with_one_value_in_a_third_of_the_rows(spark):
    rows = [(float(i % 3 and i * i % 9973) if i % 3 else 5.0,) for i in range(6000)]
    df = spark.createDataFrame(rows, "v double")
    got = S.exact_quantiles(df, [], "v", {"a": 0.1, "b": 0.33, "c": 0.5}, small=0, accuracy=200).first()
    values = [r[0] for r in rows]
    assert [got["a"], got["b"], got["c"]] == pytest.approx([np.quantile(values, p) for p in (0.1, 0.33, 0.5)])


def test_wide_brackets_go_through_distributed_positions(spark, frame, monkeypatch):
    monkeypatch.setattr(S, "SLICE_WIDTH", 10)
    got = S.exact_quantiles(frame, ["k"], "v", {"m": 0.5}, small=0, accuracy=300).collect()
    for row in got:
        assert row["m"] == pytest.approx(np.median([v for k, _, v, _ in skewed() if k == row["k"]]))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert S.exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] is None


def greedy(rows, file_cap, cap):
    used, taken = {}, set()
    for key, ord_, size in sorted(rows, key=lambda r: r[1]):
        if size <= file_cap and used.get(key, 0) + size <= cap:
            used[key] = used.get(key, 0) + size
            taken.add(ord_)
    return taken


@pytest.mark.parametrize("fold_limit", [10**6, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_read_budget_is_the_sequential_greedy(spark, fold_limit, seed):
    r = random.Random(seed)
    rows = [
        (r.choice(["hot"] * 6 + ["x", "y"]), i, r.choice([0, 1, 2, 30, 60, 120, 400, 900]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, ord bigint, size bigint")
    got = read_budget(df, ["k"], "ord", "size", file_cap=500, total_cap=1000, fold_limit=fold_limit)
    out = got.collect()
    assert len(out) == 400
    assert {x["ord"] for x in out if x["is_read"]} == greedy(rows, 500, 1000)


def test_first_rows_prunes_before_the_shuffle(frame):
    plan = S.first_rows(frame, ["k"], [F.col("ord")], 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") >= 2
    assert plan.count() == 8


def test_attach_keeps_null_keys(frame):
    out = S.attach_total(frame, ["k"], n=F.count("*"))
    sizes = {}
    for k, *_ in skewed():
        sizes[k] = sizes.get(k, 0) + 1
    assert {r["k"]: r["n"] for r in out.select("k", "n").distinct().collect()} == sizes
    assert out.count() == 3000


def test_a_hot_key_is_split_when_facts_are_attached(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(60_000, numPartitions=6).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        out = S.attach_total(rows, ["k"], n=F.count("*"))
        assert out.agg(F.max("n"), F.count("*")).first() == (20_000, 60_000)
        out.write.format("noop").mode("overwrite").save()
        result = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(result) == 60_000 and "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        tune(spark)


def test_small_side_counts_bytes(spark):
    wide = spark.range(3).select(F.repeat(F.lit("x"), 1000).alias("v"))
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(S.small_side(wide)) and not hinted(S.small_side(wide, size=2000)) and not hinted(S.small_side(wide, rows=2))
