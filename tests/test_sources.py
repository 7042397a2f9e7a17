import bz2
import gzip
import io
import json
import random
import tarfile
import zipfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewarden.operators import folders as D
from tablewarden.sources import export as E
from tablewarden.sources import files as S


def write(folder, **files):
    for name, data in files.items():
        path = folder / name.replace("__", "/").replace("_dot_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder)


def by_name(df, value):
    return {r["file"].rsplit("/", 1)[-1]: r[value] for r in df.collect()}


def test_sniffing(spark, tmp_path):
    root = write(
        tmp_path, a_dot_csv="# note; with; marks\n\nx;y,z;w\n1;2;3\n", b_dot_tsv="a\tb\n1\t2\n", c_dot_txt="word\nword\n",
        d_dot_dat="1,2\nNA,4\nx,y\n", e_dot_csv="a,b\n", f_dot_csv="#c\n" * 12 + "a;b\n", g_dot_csv="1;2\n3;inf\n",
    )
    lines = S.text_lines(spark, root)
    found = S.layout(lines)
    got = by_name(found, "sep")
    assert got == {"a.csv": ";", "b.tsv": "\t", "c.txt": ",", "d.dat": ",", "e.csv": ",", "f.csv": ",", "g.csv": ";"}
    head = by_name(found, "has_header")
    assert (head["a.csv"], head["b.tsv"], head["d.dat"], head["e.csv"], head["g.csv"]) == (True, True, False, True, False)


def test_cells_of_mixed_layouts(spark, tmp_path):
    root = write(tmp_path, a_dot_csv='id,"full name"\n1,"Doe, Jo"\n2,"say ""hi"""\n', b_dot_dat="1;2\n3;4\n", c_dot_csv=b"name,x\ncaf\xe9,1\n")
    got = sorted(
        (r["file"].rsplit("/", 1)[-1], r["column_name"], r["value"]) for r in S.read_cells(spark, root).collect()
    )
    assert got == sorted([
        ("a.csv", "id", "1"), ("a.csv", "full name", "Doe, Jo"), ("a.csv", "id", "2"), ("a.csv", "full name", 'say "hi"'),
        ("b.dat", "col_1", "1"), ("b.dat", "col_2", "2"), ("b.dat", "col_1", "3"), ("b.dat", "col_2", "4"),
        ("c.csv", "name", "café"), ("c.csv", "x", "1"),
    ])


def test_single_table(spark, tmp_path):
    root = write(tmp_path, a_dot_csv="id;v\n1;2.5\n2;NA\n")
    table = S.read_delimited(spark, root)
    assert table.columns == ["id", "v"] and table.agg(F.sum("v")).first()[0] == 2.5
    other = write(tmp_path / "n", b_dot_dat="1,2\n3,4\n")
    assert S.read_delimited(spark, other).columns == ["col_1", "col_2"]


def test_rows_with_hashes_tabs_and_long_fields(spark, tmp_path):
    wide = ",".join(f'"a,{i}"' for i in range(30_000))
    root = write(
        tmp_path, **{"_a_dot_csv": "# note\nid,v\n1,x\n# 2,y\n", "b_dot_tsv": "a,b\tc\n1,5\t2\n", "sub/_c_dot_csv": f"{wide}\n{wide}\n",
        "d_dot_csv": "id,\x01,id,\n1,\"\x01,z\",3,4\r\n\r\n5,6,7,8", "e_dot_pdf": "no,table\n", "f_dot_csv": ""},
    )
    rows = S.read_cells(spark, root).where("col_pos < 9").collect()
    got = sorted((r["file"].rsplit("/", 1)[-1], r["col_pos"], r["column_name"], r["value"]) for r in rows)
    assert [r for r in got if r[0] == "_a.csv"] == [
        ("_a.csv", 1, "id", "# 2"), ("_a.csv", 1, "id", "1"), ("_a.csv", 2, "v", "x"), ("_a.csv", 2, "v", "y")]
    assert [r for r in got if r[0] == "b.tsv"] == [("b.tsv", 1, "a,b", "1,5"), ("b.tsv", 2, "c", "2")]
    assert [r[1:] for r in got if r[0] == "d.csv"] == [
        (1, "id", "1"), (1, "id", "5"), (2, "\x01", "\x01,z"), (2, "\x01", "6"), (3, "id", "3"), (3, "id", "7"), (4, "", "4"), (4, "", "8")]
    assert len([r for r in got if r[0] == "_c.csv"]) == 8
    assert {r[0] for r in got} == {"_a.csv", "b.tsv", "_c.csv", "d.csv"}


def test_pieces_give_the_same_lines(spark, tmp_path, monkeypatch):
    text = "\n".join("x" * (i % 7) for i in range(200)) + "\r\nlast"
    root = write(tmp_path, a_dot_txt=text)
    want = [(r["ord"], r["line"]) for r in S.text_lines(spark, root).orderBy("ord").collect()]
    assert [x for _, x in want] == text.replace("\r\n", "\n").split("\n")
    for size in (1, 3, 10, 64):
        monkeypatch.setattr(S, "PIECE", size)
        assert [(r["ord"], r["line"]) for r in S.text_lines(spark, root).orderBy("ord").collect()] == want


def test_quoted_fields_over_lines(spark, tmp_path):
    root = write(tmp_path, a_dot_csv='id,t\n1,"x\n# y\nz"\n2,w\n3,"q\n', b_dot_csv="id,t\n1,2\n")
    got = sorted((r["file"].rsplit("/", 1)[-1], r["column_name"], r["value"]) for r in S.read_cells(spark, root, multiline=True).collect())
    assert got == [("a.csv", "id", "1"), ("a.csv", "id", "2"), ("a.csv", "id", "3"), ("a.csv", "t", "q"), ("a.csv", "t", "w"),
                   ("a.csv", "t", "x\n# y\nz"), ("b.csv", "id", "1"), ("b.csv", "t", "2")]


def test_one_table_of_two_layouts(spark, tmp_path):
    root = write(tmp_path, a_dot_csv="id,v,v\n1,2.5,a\n", b_dot_csv="v;id\n7;8\nNA;9\n", c_dot_dat="1,2\n3,4\n")
    table = S.read_delimited(spark, root)
    assert table.columns == ["id", "v", "v", "col_1", "col_2"]
    got = sorted(map(tuple, table.collect()), key=str)
    assert got == sorted([(1, 2.5, "a", None, None), (8, 7.0, None, None, None), (9, None, None, None, None),
                          (None, None, None, 1, 2), (None, None, None, 3, 4)], key=str)


def test_inventory_keeps_odd_names(spark, tmp_path):
    for name in ("_raw.csv", "__pycache__/a.py", ".venv/x.py", "data/b.csv", ".git/c"):
        path = tmp_path / "osf" / "p1" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
    root = str(tmp_path)
    rows = {r["rel_path"] for r in S.file_inventory(spark, root).collect()}
    assert rows == {"_raw.csv", "__pycache__/a.py", ".venv/x.py", "data/b.csv"}
    given = spark.createDataFrame([(f"{root}/osf/p1/a.csv", 3), (f"{root}/top.csv", 1)], "path string, size bigint")
    assert [(r["rel_path"], r["size"]) for r in S.file_inventory(spark, root, given).collect()] == [("a.csv", 3)]


def test_inventory(spark, tmp_path):
    root = write(tmp_path, osf__p1__data__a_dot_CSV="x", osf__p1__README="yy", dataverse__p2__b_dot_r="z")
    rows = {(r["source"], r["paper_id"], r["rel_path"]): (r["size"], r["ext"]) for r in S.file_inventory(spark, root).collect()}
    assert rows == {("osf", "p1", "data/a.CSV"): (1, "csv"), ("osf", "p1", "README"): (2, ""), ("dataverse", "p2", "b.r"): (1, "r")}


def test_archives(spark, tmp_path):
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("in/a.csv", "1")
        f.writestr("b.csv", "22")
    t = io.BytesIO()
    with tarfile.open(fileobj=t, mode="w:gz") as f:
        info = tarfile.TarInfo("c.txt")
        info.size = 3
        f.addfile(info, io.BytesIO(b"333"))
    root = write(tmp_path, **{"my data_dot_zip": z.getvalue(), "t_dot_tgz": t.getvalue(), "x_dot_csv_dot_gz": gzip.compress(b"4444"),
                              "one two three four five six_dot_zip": z.getvalue(), "one two three four five seven_dot_zip": z.getvalue(),
                              "y_dot_csv_dot_bz2": bz2.compress(b"55555"), "broken_dot_zip": b"nope", "plain_dot_csv": b"1"})
    binary = spark.read.format("binaryFile").load(root)
    rows = S.expand_archives(binary).collect()
    good = {r["member"]: r["size"] for r in rows if r["error"] is None}
    long = sorted(m for m in good if m.startswith("one_two_three_four_five-"))
    assert len(long) == 4 and len({m.split("/")[0] for m in long}) == 2
    good = {m: n for m, n in good.items() if m not in long}
    assert good == {"my_data/in/a.csv": 1, "my_data/b.csv": 2, "t/c.txt": 3, "x.csv": 4, "y.csv": 5}
    assert [r["archive"].rsplit("/", 1)[-1] for r in rows if r["error"]] == ["broken.zip"]


def test_archives_are_read_in_blocks(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    big = bytes(rng.randrange(256) for _ in range(3 << 20))
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("big.bin", big)
        f.writestr("../out.csv", "1")
        f.writestr("empty.txt", "")
        for i in range(2500):
            f.writestr(f"t/{i}.csv", f"id;v\n{i};{i % 7}\n")
    t = io.BytesIO()
    with tarfile.open(fileobj=t, mode="w") as f:
        info = tarfile.TarInfo("deep/c.csv")
        info.size = 12
        f.addfile(info, io.BytesIO(b"id;v\r\n-1;x\r\n"))
    root = write(tmp_path, **{"a_dot_zip": z.getvalue(), "b_dot_tar": t.getvalue(), "x_dot_csv_dot_gz": gzip.compress(b"id;v\n-2;y\n"),
                              "broken_dot_zip": b"nope", "plain_dot_csv": b"1"})
    files = S._listed(spark, root)
    rows = S.archive_members(files).collect()
    parts = sorted((r["place"], bytes(r["content"])) for r in rows if r["member"] == "a/big.bin")
    assert len(parts) == 3 and b"".join(x for _, x in parts) == big
    errors = {(r["archive"].rsplit("/", 1)[-1], r["member"]): r["error"] for r in rows if r["error"]}
    assert errors.pop(("a.zip", "a/../out.csv")) == "unsafe path" and set(errors) == {("broken.zip", None)}
    assert [bytes(r["content"]) for r in rows if r["member"] == "a/empty.txt"] == [b""]
    small = {r["member"]: r["error"] for r in S.archive_members(files, limit=20).collect() if r["error"]}
    assert small["a/big.bin"] == "larger than 20 bytes" and "a/t/1.csv" not in small
    lines = S.lines_of_archives(files)
    cells = S.cells_of_lines(S.decode_lines(lines)).collect()
    ids = [int(r["value"]) for r in cells if r["column_name"] == "id"]
    assert sorted(ids) == list(range(-2, 2500))
    # the zip's 2,503 members are the work of several tasks
    tasks = S._spread_out(files.select("path")).count()
    assert tasks and list(S._slices(f"{root}/a.zip", None)) == [(0, 1000), (1000, 2000), (2000, 2503)]


def test_listing_in_rounds(spark, tmp_path):
    want = set()
    for i in range(30):
        for j in range(4):
            path = tmp_path / f"d{i}" / f"e{j}" / "deep" / "er" / f"f{i}_{j}.txt"
            path.parent.mkdir(parents=True)
            path.write_text("x")
            want.add(str(path))
    (tmp_path / "d0" / "loop").symlink_to(tmp_path)
    top = spark.createDataFrame([(str(tmp_path),)], "folder string")
    for at_once in (1, 10, 5_000):
        found = S.list_files(spark, top, at_once=at_once)
        assert {r["path"] for r in found.collect()} == want
        if at_once == 1:  # no task listed more than a part of the tree
            held = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            assert held < len(want) / 4


def test_fingerprints_of_candidates_alone(spark, tmp_path):
    a, b = "one\ntwo\nthree\nA\n", "one\ntwo\nTHREE\nA\n"
    write(tmp_path, **{"x__t_dot_csv": a, "y__t_dot_csv": a.replace("A", "B"), "z__t_dot_csv": b, "x__alone_dot_csv": a, "x__n_dot_bin": "12", "y__n_dot_bin": "34",
                       "x__l_dot_txt": b"\xe9\n", "y__l_dot_txt": b"\xe8\n", "x__e_dot_csv": "", "y__e_dot_csv": ""})
    files = S._listed(spark, str(tmp_path)).selectExpr("'p' AS paper_id", "path", "substring_index(path, '/', -2) AS rel_path", "size")
    files = files.withColumn("ord", F.rank().over(Window.orderBy("rel_path")))
    printed = S.with_fingerprints(files)
    got = {r["rel_path"]: r["fingerprint"] for r in printed.collect()}
    assert got["x/t.csv"] == got["y/t.csv"] == "one\ntwo\nthree" and got["z/t.csv"] == "one\ntwo\nTHREE"
    assert got["x/alone.csv"] is None and got["x/n.bin"] is None and got["x/l.txt"] != got["y/l.txt"]
    left = {r["rel_path"] for r in D.drop_duplicates(printed).collect()}
    assert left == {"x/t.csv", "z/t.csv", "x/alone.csv", "x/n.bin", "x/l.txt", "y/l.txt", "x/e.csv"}


def test_fields_over_lines_by_default(spark, tmp_path):
    root = write(tmp_path, a_dot_csv='id,t\n1,"x\ny"\n', b_dot_csv="id,t\n2,z\n", c_dot_csv=b'id,t\n3,"caf\xe9\nz"\n')
    got = sorted(map(tuple, S.read_delimited(spark, root).collect()))
    assert got == [(1, "x\ny"), (2, "z"), (3, "café\nz")]
    assert S.read_cells(spark, root, multiline=False).where("column_name = 't'").count() == 3


def test_union_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1,)], ["x"]), spark.createDataFrame([(2,)], ["y"])
    assert sorted(map(tuple, S.load_union([a, b]).collect()), key=str) == [(1, None), (None, 2)]


def test_clean_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", " ", None), (1, "", " ", None)], "row_id int, v string, blank string, nothing string")
    report = E.export_table(df, str(tmp_path / "out"))
    assert (report["rows_written"], report["columns_written"], report["row_id_renamed"]) == (2, 2, True)
    assert spark.read.csv(str(tmp_path / "out"), header=True).columns == ["original_row_id", "v"]
    E.write_table(df.withColumn("source", F.lit("osf")).withColumn("paper_id", F.lit("007")), str(tmp_path / "t"))
    assert (tmp_path / "t" / "source=osf" / "paper_id=007").exists()


def test_metadata_leaves_out_cited_works(spark):
    xml = """<TEI xmlns="http://x"><teiHeader><fileDesc><titleStmt><title type="main">Main</title></titleStmt>
    <publicationStmt><date type="published" when="2016-05">May</date></publicationStmt>
    <sourceDesc><biblStruct><analytic><author><persName><surname>Solo &amp; Co</surname></persName></author>
    <author><persName><forename type="first">Ann</forename><surname>A</surname></persName></author>
    <author><persName><forename>Bo</forename><forename>C</forename><surname>B</surname></persName></author>
    </analytic>
    <idno type="DOI">10.1/x</idno><monogr><title level="j">J</title><imprint><biblScope unit="page">5-9</biblScope></imprint></monogr>
    </biblStruct></sourceDesc></fileDesc><profileDesc><abstract><p>One.</p><p>Two.</p></abstract>
    <textClass><keywords><term>k1</term><term>k2</term></keywords></textClass></profileDesc></teiHeader>
    <text><back><listBibl><biblStruct><analytic><author><persName><forename>No</forename><surname>One</surname></persName></author></analytic>
    <idno type="DOI">10.1/other</idno></biblStruct></listBibl></back></text></TEI>"""
    df = spark.createDataFrame([("p", xml), ("q", None), ("r", "<TEI><teiHeader/></TEI>"), ("s", "<TEI><teiHeader><a></teiHeader>"),
                                ("t", "no xml at all"), ("u", "")], "paper_id string, xml string")
    got = {r["paper_id"]: r for r in E.xml_metadata(df).collect()}
    p = got["p"]
    assert p["title"] == "Main" and p["authors"] == ["Solo & Co", "Ann A", "Bo B"] and p["doi"] == "10.1/x"
    assert (p["date"], p["pub_year"], p["pages"], p["journal"]) == ("2016-05", "2016", "5-9", "J")
    assert p["abstract"] == "One. Two." and p["keywords"] == ["k1", "k2"]
    assert all(got[k]["title"] is None and not got[k]["authors"] for k in "qrstu")


def test_documents_are_valid_json(spark, tmp_path):
    cols = spark.createDataFrame(
        [("p", "ex1", "a.csv", 1, "age", "continuous", 1.0, "1 | 2"), ("p", "ex1", "a.csv", 2, 'se"x', "binary", None, "m | f | m"),
         ("p", "ex1", "a.csv", 3, "none", "empty", None, None), ("q", "shared", "b.csv", 1, "x", "text", None, "t")],
        "paper_id string, group string, source_file string, col_pos bigint, column_name string, col_type string, mean double, sample_values string",
    )
    for s in ["n", "n_missing", "sd", "se", "median", "p25", "p75", "iqr", "skewness", "kurtosis", "min", "max"]:
        cols = cols.withColumn(s, F.lit(2.0))
    labels = spark.createDataFrame(
        [("p", "a.csv", 1, ["Age"], "labelled", ["cb"], "rules", ["AGE"]), ("p", "a.csv", 2, ["x", "y"], "conflicting_definition", [], None, [])],
        "paper_id string, source_file string, col_pos bigint, label array<string>, label_status string, label_source array<string>, "
        "label_method string, codebook_variable array<string>",
    )
    coverage = spark.createDataFrame(
        [("p", "ex1", "lost", "Lost one", "cb", "unmatched_in_data"), ("p", "ex1", "age", "Age", "cb", "matched")],
        "paper_id string, group string, codebook_variable string, label string, codebook_source string, match_status string",
    )
    values = E.property_values(cols, labels, coverage)
    docs = {r["paper_id"]: json.loads(r["document"]) for r in E.dataset_documents(values).collect()}
    age, sex, lost = docs["p"]["variableMeasured"]
    assert docs["p"]["name"] == "p ex1" and len(docs["q"]["variableMeasured"]) == 1
    assert age["description"] == "Age" and age["audit:statistics"]["sd"] == 2.0 and age["minValue"] == 2.0
    assert sex["name"] == 'se"x' and sex["valuePattern"] == "m|f" and "description" not in sex and "audit:statistics" not in sex
    assert lost["name"] == "lost" and lost["audit:match_status"] == "unmatched_in_data"
    E.write_documents(values, str(tmp_path / "docs"))
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "docs").glob("part-*")))
    decoder, found = json.JSONDecoder(), []
    while text.strip():
        text = text.lstrip()
        doc, end = decoder.raw_decode(text)
        found.append(doc)
        text = text[end:]
    assert [d["name"] for d in found] == ["p ex1", "q shared"]
