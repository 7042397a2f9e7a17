import random

from pyspark.sql import functions as F

from tablewarden.functions import names as N
from tablewarden.operators import match as X

BOOK = "paper_id string, codebook_variable string, label string, codebook_source string, group string, parse_method string, ord bigint"
COLS = "paper_id string, source_file string, col_pos bigint, column_name string, group string"


def book(spark, *rows):
    return spark.createDataFrame([("p", *r, i) for i, r in enumerate(rows)], BOOK)


def outcome(spark, codebook, *columns):
    cols = spark.createDataFrame([("p", "f.csv", i, n, g) for i, (n, g) in enumerate(columns)], COLS)
    out = X.joined_output(X.match_labels(cols, codebook)).orderBy("col_pos").collect()
    return [(r["label_status"], r["label_method"], r["label"], r["codebook_variable"], r["label_source"]) for r in out]


def test_name_normalisation(spark):
    row = spark.range(1).select(
        N.normalize_variable(F.lit(" .SSS__total  x. ")).alias("v"),
        N.normalize_label(F.lit("Participants’s  responses (N)")).alias("l"),
        N.normalize_label(F.lit("glass classes")).alias("short"),
    ).first()
    assert row["v"] == "sss total x"
    assert row["l"] == "participant response n" and row["short"] == "glass classes"


def test_label_outcomes(spark):
    b = book(
        spark,
        ("Age", "Age in years", "a.csv", None, "structured"),
        ("q_1", "Participants responses", "a.csv", None, "structured"),
        ("Q 1", "Participant response", "b.csv", None, "llm"),
        ("q2", "short", "s.sav", None, "haven"),
        ("q2", "a longer one", "t.sav", None, "haven"),
        ("q2", "from the very long readme text", "README", None, "llm"),
        ("q3", "one", "a.csv", None, "structured"),
        ("q3", "two", "b.csv", "ex1", "structured"),
        ("q4", "only there", "a.csv", "ex2", "structured"),
        ("q5", "scoped", "a.csv", "ex1", "structured"),
    )
    got = outcome(spark, b, ("AGE", "ex1"), ("q__1", "ex1"), ("q2", "ex1"), ("q3", "ex1"), ("q4", "ex1"), ("q5", None), ("zz", "ex1"),
                  ("q3", "ex2"))
    assert got[0] == ("labelled", "rules", "Age in years", "Age", "a.csv")
    assert got[1] == ("labelled", "merged_rules", "Participants responses", "q_1", "a.csv | b.csv")
    assert got[2] == ("labelled", "haven_priority", "a longer one", "q2", "s.sav | t.sav")
    assert got[3] == ("conflicting_definition", None, "one | two", "q3", "a.csv | b.csv")
    assert got[4] == ("ambiguous_experiment", None, "only there", "q4", "a.csv")
    assert got[5][0] == "ambiguous_experiment"
    assert got[6] == ("unlabelled", None, None, None, None)
    assert got[7] == ("labelled", "rules", "one", "q3", "a.csv")


def test_unscoped_entries_come_before_scoped_ones(spark):
    b = book(spark, ("q", "scoped", "a", "ex1", "llm"), ("q", "open", "b", None, "llm"))
    assert outcome(spark, b, ("q", "ex1"))[0][2] == "open | scoped"


def test_first_of_equally_long_labels(spark):
    b = book(spark, ("q", "responses", "a", None, "llm"), ("q", "responses", "b", None, "llm"), ("q", "Responses", "c", None, "llm"))
    assert outcome(spark, b, ("q", None))[0][1:3] == ("merged_rules", "responses")


def test_ranges(spark):
    b = book(spark, ("V01–V03", "x", "a", None, "llm"), ("V2-V9x", "x", "a", None, "llm"), ("V08-10", "r", "a", None, "llm"),
             ("q9-7", "bad", "a", None, "llm"), ("keep", "k", "a", None, "llm"))
    rows = X.expand_ranges(b).orderBy("ord").collect()
    assert [r["codebook_variable"] for r in rows] == ["V01–V03", "V2-V9x", "keep", "V8", "V9", "V10"]
    long = X.expand_ranges(book(spark, ("x1-120001", "long", "a", None, "llm"), ("y1-" + "9" * 19, "a name", "a", None, "llm")))
    assert long.count() == 120_002 and long.select("codebook_variable").distinct().count() == 120_002
    far = X.expand_ranges(book(spark, ("z99999999998-100000000001", "far", "a", None, "llm")))
    assert sorted(r["codebook_variable"] for r in far.collect()) == ["z100000000000", "z100000000001", "z99999999998", "z99999999999"]
    stuck = X.expand_ranges(book(spark, ("q9-7", "bad", "a", None, "llm"), ("x", "k", "a", None, "llm"))).collect()
    assert {r["codebook_variable"] for r in stuck} == {"q9-7", "x"}


def test_ranges_of_any_length_match(spark):
    b = book(
        spark,
        ("V1-10000000000", "wide", "a.csv", None, "llm"),
        ("v5–7", "narrow", "b.csv", "ex1", "llm"),
        ("V6", "named", "c.csv", None, "llm"),
        ("w3-1", "backwards", "a.csv", None, "llm"),
        ("12-19", "bare numbers", "a.csv", None, "llm"),
    )
    got = outcome(spark, b, ("v_10000000000", None), ("V10000000000", None), ("V10000000001", None), ("v6", "ex1"), ("v0", None),
                  ("v7", "ex2"), ("V07", None), ("w3-1", None), ("12", None), ("20", None))
    assert [g[0] for g in got] == ["unlabelled", "labelled", "unlabelled", "conflicting_definition", "unlabelled", "labelled",
                                   "unlabelled", "unlabelled", "labelled", "unlabelled"]
    assert got[1] == ("labelled", "rules", "wide", "V10000000000", "a.csv")
    assert got[3] == ("conflicting_definition", None, "named | wide | narrow", "V6 | v6", "c.csv | a.csv | b.csv")
    assert X.expand_ranges(book(spark, ("w3-1", "b", "a", None, "llm"))).count() == 1


def test_interval_join_against_plain_expansion(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(60):
        a = rng.choice([rng.randrange(40), rng.randrange(5000)])
        rows.append((f"{rng.choice('qv')}{a}-{a + rng.choice([0, 1, 15, 16, 17, 255, 256, 300])}", f"l{rng.randrange(9)}", "a", None, "llm"))
    b = book(spark, *rows)
    names = spark.createDataFrame([("p", f"{x}{n}") for x in "qv" for n in range(0, 5400, 7)], "paper_id string, _norm string")
    got = X.entries_of_names(names, b).select("_norm", "codebook_variable", "label", F.col("ord.ord"))
    flat = X.expand_ranges(b).select(F.lower("codebook_variable").alias("_norm"), "codebook_variable", "label", F.col("ord.ord"))
    want = flat.join(names.select("_norm"), "_norm")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 500


def test_a_name_the_dictionary_repeats_very_often(spark):
    n = 200_000
    many = spark.range(n).select(
        F.lit("p").alias("paper_id"), F.lit("q_1").alias("codebook_variable"),
        F.when(F.col("id") % 2 == 0, "Test scores").otherwise("test score").alias("label"),
        F.concat(F.lit("f"), (F.col("id") % 3).cast("string")).alias("codebook_source"),
        F.when(F.col("id") % 5 == 0, "ex1").alias("group"), F.lit("llm").alias("parse_method"), F.col("id").alias("ord"),
    )
    got = outcome(spark, many, ("Q 1", None), ("Q 1", "ex1"), ("q1", None))
    assert got[0] == got[1] == ("labelled", "merged_rules", "Test scores", "q_1", "f1 | f2 | f0")
    assert got[2][0] == "unlabelled"


def test_stems_handed_in(spark):
    b = book(spark, ("q", "Relational responses", "a.csv", None, "llm"), ("q", "relate response", "b.csv", None, "llm"))
    stemmed = X.with_label_stems(b)
    assert outcome(spark, stemmed, ("q", None)) == outcome(spark, b, ("q", None))
    assert outcome(spark, b, ("q", None))[0][:2] == ("labelled", "merged_rules")


def test_embedded_rows_win_in_the_merged_dictionary(spark):
    a = book(spark, ("q_1", "L", "s.sav", None, "haven"))
    b = book(spark, ("Q 1", "L", "a.csv", None, "structured"), ("Q 1", "L", "a.csv", "ex1", "structured"))
    got = X.merge_dictionaries(a, b).orderBy("ord").collect()
    assert [(r["codebook_variable"], r["group"]) for r in got] == [("q_1", None), ("Q 1", "ex1")]


def test_second_pass_and_verdicts(spark):
    b = book(spark, ("age", "Age", "a", None, "llm"), ("sex", "Sex", "a", None, "llm"), ("q", "one", "a", None, "llm"), ("q", "two", "a", None, "llm"))
    cols = spark.createDataFrame(
        [("p", f, i, n, None) for i, (f, n) in enumerate([("f", "age"), ("f", "gender"), ("g", "Gender"), ("f", "q")])], COLS
    )
    labels = X.match_labels(cols, b)
    pairs = spark.createDataFrame(
        [("p", "gender", "AGE", 0), ("p", "gender", "Sex", 1), ("p", "q", "sex", 2)],
        "paper_id string, column_name string, codebook_variable string, ord int",
    )
    got = {r["col_pos"]: (r["label_status"], r["label"]) for r in X.second_pass(labels, b, pairs).collect()}
    assert got == {0: ("labelled", ["Age"]), 1: ("llm", ["Sex"]), 2: ("llm", ["Sex"]), 3: ("conflicting_definition", ["one", "two"])}
    verdicts = spark.createDataFrame(
        [("p", "q", True, "one of two"), ("p", "age", True, "no")], "paper_id string, column_name string, equivalent boolean, canonical string"
    )
    merged = {r["col_pos"]: (r["label_method"], r["label"]) for r in X.merge_verdicts(labels, verdicts).collect()}
    assert merged[3] == ("merged_llm", ["one of two"]) and merged[0] == ("rules", ["Age"])
    cov = {(r["codebook_variable"]): r["match_status"] for r in X.codebook_coverage(b, labels).collect()}
    assert cov == {"age": "matched", "sex": "unmatched_in_data", "q": "unmatched_in_data"}


def test_dictionary_headers(spark):
    assert N.dictionary_columns(["ID", "Variable Name", "Notes", "Question_Text"]) == ("Variable Name", "Question_Text")
    assert N.dictionary_columns(["variable", "notes"]) is None
    df = spark.createDataFrame([("a", "A"), (" ", "B")], ["Name", "Label"])
    assert [r["codebook_variable"] for r in N.read_dictionary(df, F.lit("x")).collect()] == ["a"]


def test_stemmer_on_published_examples():
    pairs = {
        "caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
        "motoring": "motor", "sing": "sing", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file",
        "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "vietnamization": "vietnam",
        "triplicate": "triplic", "hopefulness": "hope", "revival": "reviv", "adjustment": "adjust", "adoption": "adopt",
        "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    }
    assert {w: N._porter(w) for w in pairs} == pairs


def test_stemmed_labels_compare_equal(spark):
    df = spark.createDataFrame([("Relational responses",), ("relate responded",), (None,), ("!!",)], "label string")
    got = {r["label"]: r["s"] for r in N.with_stemmed_label(df, "label", "s").collect()}
    assert got == {"Relational responses": "relat respons", "relate responded": "relat respond", None: "", "!!": ""}


def test_stems_and_missing_codebooks(spark):
    b = book(spark, ("q", "Test scores", "a.csv", None, "structured"), ("q", "Test score", "b.csv", None, "structured"))
    cols = spark.createDataFrame([("p", "f", 1, "q", None), ("r", "f", 1, "q", None), ("s", "f", 1, "q", None)], COLS)
    has = spark.createDataFrame([("p",), ("r",), ("p",)], "paper_id string")
    got = {r["paper_id"]: (r["label_status"], r["label_method"]) for r in X.match_labels(cols, b, with_codebook=has).collect()}
    assert got == {"p": ("labelled", "merged_rules"), "r": ("unlabelled", None), "s": ("no_codebook", None)}
    plural = X.match_labels(cols, b, stems=False).where("paper_id = 'p'").first()
    assert plural["label_status"] == "conflicting_definition"
