from tablewarden.operators import stages as ST

ANSWERS = {
    "Study 1/data.csv": ("data", "ex1"), "Study 1/analysis.R": ("data", "ex1"), "README.md": ("other", "shared"),
    "paper.Rmd": ("supplemental", None), "paper.pdf": ("supplemental", "Study 9"), "few/a.txt": ("codebook", "shared"),
    "few/b.txt": ("codebook", "shared"), "people/.csv": ("data", "ex2"), "many/.png": ("asset", "pilot1"),
    "sub01.csv": ("data", "shared"),
}


def classifier(items):
    known = items.sparkSession.createDataFrame([(p, *a) for p, a in ANSWERS.items()], "p string, type string, group string")
    return items.join(known, items["rel_path"] == known["p"]).select("paper_id", "batch", "ord", "rel_path", "type", "group")


def listing(spark, *paths, paper="p"):
    rows = [(paper, p, 10 + i, i, "x") for i, p in enumerate(paths)]
    return spark.createDataFrame(rows, "paper_id string, rel_path string, size bigint, ord bigint, fingerprint string")


PATHS = [
    "Study 1/data.csv", "Study 1/analysis.R", "README.md", "paper.Rmd", "paper.pdf", ".git/HEAD", "node_modules/x/index.js",
    "sub01.csv", *[f"people/{i}/scan.csv" for i in range(20, 25)], *[f"many/{i}.png" for i in range(4)],
]


def test_index_of_a_small_repository(spark):
    files = listing(spark, *PATHS).unionByName(listing(spark, "few/a.txt", paper="q"))
    copy = spark.createDataFrame([("p", "copy/data.csv", 10, 99, "x")], files.schema)
    rows = ST.index_collections(files.unionByName(copy), classifier, batch=4, limit=3)
    assert rows.columns == ST.STRUCTURE
    got = {(r["paper_id"], r["rel_path"]): r for r in rows.collect()}
    assert set(got) == {("p", x) for x in PATHS if x != ".git/HEAD"} | {("q", "few/a.txt")}

    def facts(path, *names):
        return tuple(got["p", path][n] for n in names)

    assert facts("Study 1/data.csv", "type", "group", "data_granularity", "data_format") == ("data", "ex1", "combined", "tabular")
    assert facts("Study 1/analysis.R", "type", "type_source", "data_format") == ("code", "fixed_ext_rule", None)
    assert facts("README.md", "type", "type_source") == ("readme", "fixed_filename_rule")
    assert facts("paper.Rmd", "type", "type_source", "group") == ("code", "rmd_pair_rule", "shared")
    assert facts("paper.pdf", "type", "type_source", "group") == ("output", "rmd_pair_rule", "shared")
    assert facts("node_modules/x/index.js", "type", "type_source", "aggregate_folder") == ("software", "rule_folder", "node_modules")
    assert facts("sub01.csv", "data_granularity", "granularity_source") == ("individual", "filename_heuristic")
    for i in range(20, 25):
        names = ("type", "group", "aggregate_folder", "data_granularity", "granularity_source", "type_source")
        assert facts(f"people/{i}/scan.csv", *names) == ("data", "ex2", "people", "individual", "folder_name_heuristic", "aggregate_llm")
    assert facts("many/0.png", "type", "group", "data_granularity") == ("asset", "pilot1", None)
    # six single files in batches of four: the answers come from two batches, the groups from their own
    assert [facts(p, "prompt_nr")[0] for p in ("Study 1/data.csv", "paper.pdf", "people/20/scan.csv", "many/0.png")] == [1, 2, 1, 1]


def test_a_spoiled_batch_falls_to_the_sentinel(spark):
    files = listing(spark, "Study 1/data.csv", "unknown.bin", "README.md")
    got = {r["rel_path"]: (r["type"], r["group"]) for r in ST.index_collections(files, classifier, batch=2, limit=9).collect()}
    assert got == {"Study 1/data.csv": ("llm_error", "shared"), "unknown.bin": ("llm_error", "shared"), "README.md": ("readme", "shared")}
    assert ST.index_collections(files.where("false"), classifier).count() == 0


def test_labels_of_whole_repositories(spark):
    structure = spark.createDataFrame(
        [("p", "codebook.csv", "codebook", 1), ("p", "d.sav", "data", 2), ("p", "notes.csv", "other", 3), ("q", "x.csv", "data", 1),
         ("r", "README", "readme", 1)],
        "paper_id string, rel_path string, type string, ord bigint",
    )
    kind = "paper_id string, codebook_variable string, label string, codebook_source string, group string, parse_method string, ord bigint"
    parsed = spark.createDataFrame(
        [("p", "age", "Age in years", "codebook.csv", None, "structured", 1), ("p", "q1-1000000000000", "An item", "codebook.csv", None, "structured", 2),
         ("p", "sex", "from a file that does not count", "notes.csv", None, "structured", 3), ("p", "lost", "Lost", "codebook.csv", None, "structured", 4)],
        kind,
    )
    embedded = spark.createDataFrame([("p", "AGE", "Age", "d.sav", None, "haven", 1)], kind)
    columns = spark.createDataFrame(
        [(p, "f.csv", i, n, None) for i, (p, n) in enumerate([("p", "Age"), ("p", "q999999999999"), ("p", "sex"), ("q", "age"), ("r", "age")])],
        "paper_id string, source_file string, col_pos bigint, column_name string, group string",
    )
    pairs = spark.createDataFrame([("p", "sex", "LOST", 1)], "paper_id string, column_name string, codebook_variable string, ord int")
    found = ST.label_columns(columns, structure, parsed, embedded, pairs=pairs)
    got = {r["col_pos"]: (r["label_status"], r["label_method"], r["label"]) for r in found.labels.collect()}
    assert got == {
        0: ("labelled", "haven_priority", ["Age"]), 1: ("labelled", "rules", ["An item"]), 2: ("llm", "llm", ["Lost"]),
        3: ("no_codebook", None, []), 4: ("unlabelled", None, []),
    }
    status = {r["paper_id"]: (r["n_vars"], r["n_labelled"], r["status"]) for r in found.status.collect()}
    assert status == {"p": (4, 3, "ok"), "q": (0, 0, "no_codebook"), "r": (0, 0, "no_codebook")}
    cover = {(r["codebook_variable"], r["match_status"]) for r in found.coverage.collect()}
    assert ("AGE", "matched") in cover and ("lost", "matched") in cover
    assert found.dictionary.count() == 4
