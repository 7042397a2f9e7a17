from pyspark.sql import functions as F

from tablewarden.functions import paths as PF
from tablewarden.operators import folders as D


def listing(spark, paths, paper="p"):
    return spark.createDataFrame([(paper, p, i) for i, p in enumerate(paths)], "paper_id string, rel_path string, ord bigint")


def test_flat_folder_threshold_is_strict(spark):
    df = listing(spark, [f"a/{i}.csv" for i in range(20)] + [f"b/{i}.csv" for i in range(21)])
    assert [r["folder"] for r in D.flat_aggregates(df).collect()] == ["b"]


def claimed(spark, paths):
    rows = D.software_folders(listing(spark, paths)).collect()
    return {r["rel_path"]: r["software_folder"] for r in rows if r["software_folder"]}


def test_build_folder_needs_a_hundred_files(spark):
    assert claimed(spark, [f"build/{i}.o" for i in range(99)]) == {}
    assert len(claimed(spark, [f"build/{i}.o" for i in range(100)])) == 100


def test_build_folder_of_tables_is_data(spark):
    half = [f"lib/{i}.csv" for i in range(50)] + [f"lib/{i}.o" for i in range(50)]
    assert len(claimed(spark, half)) == 100
    assert claimed(spark, half + ["lib/x.csv"]) == {}


def test_outermost_qualifying_folder_claims(spark):
    inner = [f"src/lib/{i}.o" for i in range(100)]
    assert set(claimed(spark, inner + ["src/a.o"]).values()) == {"src"}
    tables = [f"src/{i}.csv" for i in range(150)]
    assert set(claimed(spark, inner + tables).values()) == {"src/lib"}


def test_tool_folder_claims_at_any_size(spark):
    got = claimed(spark, ["a/.git/x", "a/Renv/b/node_modules/c", "renv.lock", "data/renv/x.csv"])
    assert got == {"a/.git/x": "a/.git", "a/Renv/b/node_modules/c": "a/Renv", "data/renv/x.csv": "data/renv"}
    assert D.drop_git(listing(spark, [".git/x", "a/.git/y", "a.git/z"])).count() == 1


def test_participant_folders(spark):
    people = [f"data/sub{i}/x.csv" for i in range(21)]
    assert D.participant_aggregates(listing(spark, people)).first()["folder"] == "data"
    assert D.participant_aggregates(listing(spark, people[:20])).count() == 0
    files = D.assign_aggregate_folder(listing(spark, people + ["top.csv"]))
    groups = D.extension_groups(files).collect()
    assert [(g["aggregate_folder"], g["n_members"], g["is_series"]) for g in groups] == [("data", 21, True)]


def test_even_samples_round_half_to_even(spark):
    df = listing(spark, [f"a/{i:02d}.csv" for i in range(1, 24)])
    group = D.extension_groups(D.assign_aggregate_folder(df)).first()
    # positions 1, 6.5, 12, 17.5, 23
    assert group["sample_paths"] == [f"a/{i:02d}.csv" for i in (1, 6, 12, 18, 23)]


def test_patterns_and_granularity(spark):
    logs = [("p", f"logs/run_{i}.dat", "data", "logs", False) for i in range(8)]
    rest = [("p", "run_99.dat", "data", None, False), ("p", "walk_1.dat", "data", None, False),
            ("p", "sub7.csv", "data", None, False), ("p", "people/sub1/a.csv", "data", "people", False),
            ("p", "x/s/a.csv", "data", "x", True), ("p", "note.txt", "readme", None, False)]
    df = spark.createDataFrame(logs + rest, "paper_id string, rel_path string, type string, aggregate_folder string, is_series boolean")
    verdicts = spark.createDataFrame([("p", "logs", "individual")], "paper_id string, aggregate_folder string, verdict string")
    got = {r["rel_path"]: (r["data_granularity"], r["granularity_source"]) for r in D.granularity(df, verdicts).collect()}
    assert got["logs/run_1.dat"] == ("individual", "llm")
    assert got["run_99.dat"] == ("individual", "llm_pattern_inference")
    assert got["walk_1.dat"] == ("combined", "default_combined")
    assert got["sub7.csv"] == ("individual", "filename_heuristic")
    assert got["people/sub1/a.csv"] == ("individual", "folder_name_heuristic")
    assert got["x/s/a.csv"] == ("individual", "folder_heuristic")
    assert got["note.txt"] == (None, None)
    pattern = D.filename_patterns(df).first()
    assert pattern["pattern"] == r"^run_[0-9]+\.dat$" and pattern["n_files"] == 8


def test_duplicates_keep_the_first_listed(spark):
    rows = [("p", "b/x.csv", 1, 10, "h1"), ("p", "a/x.csv", 2, 10, "h1"), ("p", "c/x.csv", 3, 10, "h2"),
            ("p", "a/y.bin", 4, 10, "h1"), ("p", "b/y.bin", 5, 10, "h2"), ("q", "x.csv", 6, 10, "h1")]
    df = spark.createDataFrame(rows, "paper_id string, rel_path string, ord bigint, size bigint, fingerprint string")
    assert sorted(r["ord"] for r in D.drop_duplicates(df).collect()) == [1, 3, 4, 6]


def test_type_rules_only_touch_what_differs(spark):
    rows = [("p", "a/doc.pdf", "pdf", "data", "llm", "raw"), ("p", "a/doc.rmd", "rmd", "data", "llm", "tabular"),
            ("p", "run.sh", "sh", "data", "llm", "tabular"), ("p", "x.r", "r", "code", "llm", "tabular"),
            ("p", "README", "", "other", "llm", "tabular"), ("p", "readme_old.txt", "txt", "other", "llm", None)]
    df = spark.createDataFrame(rows, "paper_id string, rel_path string, ext string, type string, type_source string, data_format string")
    got = {r["rel_path"]: (r["type"], r["type_source"], r["data_format"]) for r in D.apply_type_rules(df).collect()}
    assert got == {
        "a/doc.pdf": ("output", "rmd_pair_rule", None), "a/doc.rmd": ("code", "rmd_pair_rule", None),
        "run.sh": ("software", "fixed_ext_rule", None), "x.r": ("code", "llm", "tabular"),
        "README": ("readme", "fixed_filename_rule", None), "readme_old.txt": ("other", "llm", None),
    }


def test_shared_files_take_the_single_study_of_their_folder(spark):
    rows = [("p", "a/1", "ex1"), ("p", "a/2", "shared"), ("p", "b/1", "ex1"), ("p", "b/2", "ex2"), ("p", "b/3", "shared"), ("p", "c", "shared")]
    df = spark.createDataFrame(rows, "paper_id string, rel_path string, group string")
    got = {r["rel_path"]: r["group"] for r in D.resolve_shared(df).collect()}
    assert (got["a/2"], got["b/3"], got["c"]) == ("ex1", "shared", "shared")


def test_path_functions(spark):
    names = ["12", "sub01", "sub-01", "s1", "s12", "P3", "vp9x", "participant 4", "people", None, ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(PF.is_participant_id(F.col("n"))).collect()]
    assert got == [True, True, False, False, True, True, True, True, False, False, False]
    row = spark.range(1).select(
        PF.folder_words(F.lit("My big & (bad) folder of many words")).alias("w"),
        PF.ext_or_none(F.lit("Makefile")).alias("e"),
        PF.export_filename(F.lit("My data.v2.csv"), F.lit(True), F.lit("Sheet 1"), F.lit(1)).alias("x"),
        PF.safe_id(F.lit("doi:10/ab")).alias("i"),
        PF.clean_group(F.lit("study1")).alias("g"),
        PF.valid_type(F.lit("datum")).alias("t"),
        PF.stem(F.lit("a/.gitignore")).alias("s"),
    ).first()
    assert row["w"] == "My_big_bad_folder_of"
    assert row["e"] == "(none)" and row["i"] == "doi_10_ab" and row["g"] == "shared" and row["t"] is False
    assert row["s"] == ".gitignore"
    assert row["x"] == "granularity-individual_source-Mydatav2_sheet-Sheet1_data.csv"


def test_export_names_do_not_clash(spark):
    df = spark.createDataFrame([("p", "a.csv", "x_data.csv"), ("p", "b.csv", "x_data.csv"), ("q", "a.csv", "x_data.csv"), ("p", "c", "y")],
                               "paper_id string, rel_path string, name string")
    got = {(r["paper_id"], r["rel_path"]): r["name"] for r in D.settle_clashes(df, ["paper_id"], "name", "rel_path").collect()}
    assert got["q", "a.csv"] == "x_data.csv" and got["p", "c"] == "y"
    a, b = got["p", "a.csv"], got["p", "b.csv"]
    assert a != b and all(x.startswith("x-") and x.endswith("_data.csv") for x in (a, b))
