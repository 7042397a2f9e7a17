from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tablewarden.streaming import incremental as I

SCHEMA = "paper_id string, status string"


def add(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(str(folder / name))


def test_only_new_files_are_processed(spark, tmp_path):
    inbox, log, state = tmp_path / "inbox", str(tmp_path / "log"), str(tmp_path / "state")
    add(spark, inbox, "a", [("1", "ok"), ("2", "fail")])

    def run():
        stream = I.arrivals(spark, str(inbox / "*"), SCHEMA)
        query = I.run_available(stream, I.append_log(log, ["paper_id"]), state)
        query.awaitTermination(60)
        return query.recentProgress

    run()
    add(spark, inbox, "b", [("2", "ok"), ("3", "ok")])
    progress = run()
    assert sum(p["numInputRows"] for p in progress) == 2
    got = {r["paper_id"]: r["status"] for r in I.read_log(spark, log, ["paper_id"]).collect()}
    assert got == {"1": "ok", "2": "ok", "3": "ok"}
    assert not run() or sum(p["numInputRows"] for p in run()) == 0


def test_replayed_batch_changes_nothing(spark, tmp_path):
    a, b = str(tmp_path / "v0"), str(tmp_path / "v1")
    spark.createDataFrame([("1", "old"), ("2", "old")], SCHEMA).write.parquet(a)
    work = I.replace_rows(a, b, ["paper_id"])
    batch = spark.createDataFrame([("2", "new"), ("3", "new")], SCHEMA)
    work(batch, 0)
    work(batch, 0)
    got = {r["paper_id"]: r["status"] for r in spark.read.parquet(b).collect()}
    assert got == {"1": "old", "2": "new", "3": "new"}
    assert spark.read.parquet(b).count() == 3


def test_last_row_of_a_repeated_key(spark, tmp_path):
    log = str(tmp_path / "log")
    kind = "k string, at int, v string"
    work = I.append_log(log, ["k"], ["at"])
    work(spark.createDataFrame([("a", 3, "late"), ("a", 1, "early"), ("b", 5, "x"), (None, 1, "n")], kind), 0)
    work(spark.createDataFrame([("a", 2, "between"), ("b", 5, "y"), ("c", None, "z")], kind), 1)
    got = {r["k"]: r["v"] for r in I.read_log(spark, log, ["k"], ["at"]).collect()}
    assert got == {"a": "late", "b": "y", "c": "z", None: "n"}
    assert {r["k"]: r["v"] for r in I.read_log(spark, log, ["k"]).collect()} == {"a": "between", "b": "y", "c": "z", None: "n"}
    same = spark.createDataFrame([("a", 1, x) for x in "pqrst"], kind)
    assert len({I.last_rows(same.repartition(n), ["k"], ["at"]).first()["v"] for n in (1, 2, 3, 4)}) == 1


def test_upsert_rewrites_touched_parts_alone(spark, tmp_path):
    kind = "k bigint, v string"
    table = I.KeyedTable(spark, str(tmp_path / "t"), ["k"], 8)
    assert table.read() is None
    table.upsert(spark.createDataFrame([(i, "old") for i in range(100)], kind), 0)
    table.upsert(spark.createDataFrame([(7, "new"), (7, "newer"), (200, "new")], kind), 1, ["v"])
    want = {i: "old" for i in range(100)} | {7: "newer", 200: "new"}
    assert {r["k"]: r["v"] for r in table.read().collect()} == want and table.read().count() == 101
    parts = table._parts(1)
    assert sorted(parts.values()).count(1) <= 2 and len(parts) == 8
    # a write that breaks off before the pointer is not seen, and is done over
    third = spark.createDataFrame([(8, "third", 1)], kind + ", extra int")
    bad = spark.createDataFrame([(8, "half", 0)], "k bigint, v string, part int")
    bad.write.partitionBy("part").parquet(str(tmp_path / "t" / "data" / "version=2"))
    assert {r["k"]: r["v"] for r in table.read().collect()} == want
    table.upsert(third, 2)
    table.upsert(third, 2)
    want[8] = "third"
    assert {r["k"]: r["v"] for r in table.read().select("k", "v").collect()} == want and table.versions() == [0, 1, 2]
    assert {r["k"]: r["v"] for r in table.read(1).collect()}[8] == "old"
    table.upsert(spark.createDataFrame([], kind), 3)
    table.vacuum(1)
    assert table.versions() == [3] and {r["k"]: r["v"] for r in table.read().select("k", "v").collect()} == want


def test_stream_upserts(spark, tmp_path):
    inbox, table, state = tmp_path / "inbox", str(tmp_path / "table"), str(tmp_path / "state")
    for name, rows in (("a", [("1", "ok"), ("2", "fail")]), ("b", [("2", "ok"), ("3", "ok")])):
        add(spark, inbox, name, rows)
        stream = I.arrivals(spark, str(inbox / "*"), SCHEMA)
        I.run_available(stream, I.upsert_rows(table, ["paper_id"], partitions=4), state).awaitTermination(60)
    got = {r["paper_id"]: r["status"] for r in I.KeyedTable(spark, table, ["paper_id"], 4).read().collect()}
    assert got == {"1": "ok", "2": "ok", "3": "ok"}


def test_old_log_gets_the_new_columns(spark):
    schema = StructType([StructField("paper_id", StringType()), StructField("n", IntegerType()), StructField("why", StringType())])
    out = I.add_missing_columns(spark.createDataFrame([("1", "7")], "paper_id string, n string").withColumn("x", F.lit(1)), schema)
    assert out.columns == ["paper_id", "n", "why", "x"] and out.first() == ("1", 7, None, 1)
