"""Reading file collections: listings, delimited text, archives, encodings."""

from __future__ import annotations

import bz2
import gzip
import hashlib
import io
import lzma
import os
import re
import sys
import tarfile
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewarden.functions.paths import basename, ext
from tablewarden.operators.scale import attach, first_rows, positions, small_side
from tablewarden.session import settle

# the archive reader travels with the job: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEPARATORS = [",", ";", "\t", "|"]
NUMERIC_WORDS = ["NA", "NAN", "NULL", "INF", "-INF", "+INF"]
ARCHIVES = r"(?i)\.(zip|tar|tgz|tar\.gz|tar\.bz2|tar\.xz|gz|bz2|xz)$"
# Extensions of delimited text.
TEXT_TABLES = ["csv", "txt", "tsv", "dat"]
SNIFF_LINES = 10
# Entries a task lists before it hands the folders that are left to others.
LISTED_AT_ONCE = 5_000
# Lines by which two text tables of one name and size are compared.
PRINT_LINES = 3
# A file is read in pieces of this many bytes, so that a long one is shared by many tasks.
PIECE = 64 << 20
BATCH_BYTES = 4 << 20
# Members of archives: bytes of a block, members of a zip in one task at most, bytes a member may unpack to.
MEMBER_BLOCK = 1 << 20
SLICE_MEMBERS = 1_000
MEMBER_LIMIT = 1 << 40
# Marks of the splitter: the first is escaped wherever a line has it, so no text is mistaken for a separator.
MARK, LITERAL, CUT = "\x01", "\x01\x02", "\x01\x03"


def _spread_out(df: DataFrame) -> DataFrame:
    """Short rows that stand for much work, dealt over all cores (not merged by size)."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def _store(path: str) -> tuple[FileSystem, str, str]:
    """Client of a path's file system, the path within it, and what precedes that."""
    if path.startswith("file:"):
        base = "/" + path.removeprefix("file:").lstrip("/")
        return LocalFileSystem(), base, path[: len(path) - len(base)]
    if "://" not in path:
        return LocalFileSystem(), path, ""
    client, base = FileSystem.from_uri(path)
    return client, base, path[: len(path) - len(base)]


def _subfolders(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for folder in frame["folder"]:
            client, base, prefix = _store(folder)
            found = client.get_file_info(FileSelector(base))
            names = [prefix + x.path for x in found if x.type == FileType.Directory]
            yield pd.DataFrame({"folder": names}, dtype="object")


def _entries_below(skip: tuple[str, ...], at_once: int):
    """Files below each folder; a folder not yet listed when ``at_once`` entries were seen is handed back."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for folder in frame["folder"]:
                client, base, prefix = _store(folder)
                local = isinstance(client, LocalFileSystem)
                todo, seen = [base], 0
                while todo and seen < at_once:
                    found = client.get_file_info(FileSelector(todo.pop(0)))
                    seen += len(found)
                    # a linked folder may lead back to one of its parents
                    todo += [
                        x.path for x in found
                        if x.type == FileType.Directory and x.base_name not in skip
                        and not (local and os.path.islink(x.path))
                    ]
                    kept = [(prefix + x.path, x.size, False) for x in found if x.type == FileType.File]
                    for i in range(0, len(kept), 10_000):
                        yield pd.DataFrame(kept[i : i + 10_000], columns=ENTRY)
                if todo:
                    yield pd.DataFrame([(prefix + x, 0, True) for x in todo], columns=ENTRY)

    return run


ENTRY = ["path", "size", "is_folder"]


def list_files(
    spark: SparkSession, folders: DataFrame, skip: Sequence[str] = (".git",), at_once: int = LISTED_AT_ONCE
) -> DataFrame:
    """``path, size`` of every file below the folders in column ``folder``, also names that start with ``_`` or ``.``.

    Spark's own file index leaves such names out, so folders are listed in tasks with a file-system
    client. A task goes breadth first and hands back what is left after ``at_once`` entries; those
    folders are dealt over all cores in the next round, so one large tree is not one task's work.
    Folders named in ``skip`` are not entered. Every round's entries are settled.
    """
    rounds, todo = [], folders.select("folder")
    while True:
        found = _spread_out(todo).mapInPandas(
            _entries_below(tuple(skip), at_once), "path string, size bigint, is_folder boolean"
        )
        found = settle(found)
        rounds.append(found.where("NOT is_folder").select("path", "size"))
        todo = found.where("is_folder").select(F.col("path").alias("folder"))
        if todo.isEmpty():
            return reduce(DataFrame.unionAll, rounds)


def file_inventory(
    spark: SparkSession, root: str, manifest: DataFrame | None = None, skip: Sequence[str] = (".git",)
) -> DataFrame:
    """Every file below ``root/<source>/<paper_id>/``; contents are never loaded.

    A ``manifest`` with ``path, size`` replaces the listing, for stores that can export one.
    """
    root = root.rstrip("/")
    if manifest is None:
        top = spark.createDataFrame([(root,)], "folder string")
        sources = top.mapInPandas(_subfolders, "folder string")
        papers = _spread_out(sources).mapInPandas(_subfolders, "folder string")
        manifest = list_files(spark, papers, skip)
    tail = re.escape(root) + r"/([^/]+)/([^/]+)/(.+)$"
    path = F.col("path")
    return (
        manifest.where(path.rlike(tail))
        .select(
            F.regexp_extract(path, tail, 1).alias("source"),
            F.regexp_extract(path, tail, 2).alias("paper_id"),
            path,
            F.regexp_extract(path, tail, 3).alias("rel_path"),
            "size",
        )
        .withColumn("filename", basename(F.col("rel_path")))
        .withColumn("ext", ext(F.col("rel_path")))
    )


def decode_lines(lines: DataFrame) -> DataFrame:
    """Latin-1 text for every file with any line that is not UTF-8; other files stay."""
    odd = lines.where(~F.is_valid_utf8("line")).select("file").distinct().withColumn("_latin", F.lit(True))
    line = F.col("line")
    return (
        attach(lines, odd, ["file"])
        .withColumn(
            "line", F.when(F.col("_latin"), F.decode(line.cast("binary"), "ISO-8859-1")).otherwise(line)
        )
        .drop("_latin")
    )


def _split_lines(source: io.BufferedIOBase, at: int, stop: int | None) -> Iterator[tuple[int, bytes]]:
    """Lines from byte ``at`` on that begin before ``stop``; ends are LF, CRLF or CR."""
    while stop is None or at < stop:
        whole = source.readline()
        if not whole:
            return
        begin = at
        for part in whole.removesuffix(b"\n").removesuffix(b"\r").split(b"\r"):
            yield begin, part
            begin += len(part) + 1
        at += len(whole)


def _lines_of(path: str, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """Lines that begin in ``[start, stop)`` with their byte offset."""
    client, name, _ = _store(path)
    with client.open_input_file(name) as raw, io.BufferedReader(raw, 1 << 20) as source:
        at = start
        if start:
            source.seek(start - 1)
            at = start - 1 + len(source.readline())
        yield from _split_lines(source, at, stop)


def _read_pieces(heads: int, usable_lines: int = 0):
    def pieces(path: str, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
        usable = 0
        for i, (at, line) in enumerate(_lines_of(path, start, stop)):
            yield at, line
            usable += bool(line.strip()) and not line.strip().startswith(b"#")
            if heads and i + 1 >= heads and usable >= usable_lines:
                return

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, start, stop in zip(frame["path"], frame["_start"], frame["_stop"], strict=True):
                rows, size = [], 0
                for at, line in pieces(path, int(start), int(stop)):
                    rows.append((path, at, line))
                    size += len(line) + 64
                    if size >= BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=["file", "ord", "line"])
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=["file", "ord", "line"])

    return run


def lines_of_files(files: DataFrame, heads: int = 0, usable: int = 0) -> DataFrame:
    """``file, ord, line`` of the files in ``path, size``; ``ord`` is the byte at which a line begins.

    With ``heads`` no more of each file is read than that many lines and ``usable`` usable ones.
    """
    size = F.col("size")
    if heads:
        cut = files.where(size > 0).select("path", F.lit(0).cast("bigint").alias("_start"), size.alias("_stop"))
    else:
        starts = F.sequence(F.lit(0).cast("bigint"), size - 1, F.lit(PIECE).cast("bigint"))
        cut = files.where(size > 0).select("path", size, F.explode(starts).alias("_start"))
        cut = cut.select("path", "_start", F.least(size, F.col("_start") + PIECE).alias("_stop"))
    read = _spread_out(cut).mapInPandas(_read_pieces(heads, usable), "file string, ord bigint, line binary")
    return read.withColumn("line", F.col("line").cast("string"))


def first_lines(lines: DataFrame, n: int = PRINT_LINES) -> DataFrame:
    """``file, fingerprint``: the first ``n`` lines of each file of ``file, ord, line``."""
    head = first_rows(lines.select("file", "ord", "line"), ["file"], [F.col("ord")], n)
    parts = F.array_sort(F.collect_list(F.struct("ord", "line")))
    return head.groupBy("file").agg(F.array_join(F.transform(parts, lambda r: r["line"]), "\n").alias("fingerprint"))


def with_fingerprints(files: DataFrame, n: int = PRINT_LINES) -> DataFrame:
    """Files (``paper_id, path, rel_path, size``) with ``fingerprint``, the first lines of text tables.

    Only text tables that share name and size with another file of their repository are opened, and
    of those no more than ``n`` lines are read; the fingerprint of all others is null. A file that is
    no UTF-8 is compared by its bytes' digest, so that two encodings are not taken for one text.
    """
    named = files.withColumn("_name", basename(F.col("rel_path")))
    keys = ["paper_id", "_name", "size"]
    again = named.groupBy(*keys).agg((F.count("*") > 1).alias("_again")).where("_again")
    asked = attach(named.where(ext(F.col("rel_path")).isin(TEXT_TABLES)), again, keys, "left_semi").select("path", "size")
    lines = lines_of_files(asked, heads=n)
    line = F.when(F.is_valid_utf8("line"), F.col("line")).otherwise(F.md5(F.col("line").cast("binary")))
    prints = first_lines(lines.withColumn("line", line), n).withColumnRenamed("file", "path")
    return attach(files, prints, ["path"])


def _listed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, size`` of single files and of all files below folders."""
    named = [paths] if isinstance(paths, str) else list(paths)
    given = spark.createDataFrame([(p.rstrip("/"),) for p in named], "folder string")

    def kinds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["folder"]:
                client, base, _ = _store(path)
                info = client.get_file_info(base)
                if info.type != FileType.NotFound:
                    yield pd.DataFrame([(path, info.size or 0, info.type == FileType.Directory)], columns=ENTRY)

    named = settle(given.mapInPandas(kinds, "path string, size bigint, is_folder boolean"))
    below = list_files(spark, named.where("is_folder").select(F.col("path").alias("folder")))
    return named.where("NOT is_folder").select("path", "size").unionAll(below)


def text_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of all files below ``paths`` with their file and place: ``file, ord, line``."""
    return decode_lines(lines_of_files(_listed(spark, paths)))


def _usable(line: Column) -> Column:
    return (F.trim(line) != "") & ~F.trim(line).startswith("#")


def sniff_delimiter(lines: DataFrame) -> DataFrame:
    """Separator per file from its first usable line among the first ten.

    The most frequent of ``, ; tab |`` wins, ties in that order; none means comma.
    A ``.tsv`` file is always split at tabs.
    """
    head = first_rows(lines, ["file"], [F.col("ord")], SNIFF_LINES)
    line = F.col("line")
    chosen = head.groupBy("file").agg(
        F.min_by("line", F.struct((~_usable(line)).cast("int"), "ord")).alias("line"),
        F.max_by("line", "ord").alias("_last"),
        F.count("*").alias("_n"),
    )
    text = F.when(_usable(line), line).when(F.col("_n") == SNIFF_LINES, F.col("_last")).otherwise(F.lit(""))
    count = {s: F.length(text) - F.length(F.replace(text, F.lit(s), F.lit(""))) for s in SEPARATORS}
    most = F.greatest(*count.values())
    out = F.when(F.lower(F.col("file")).endswith(".tsv"), F.lit("\t")).when(most == 0, F.lit(","))
    for s in SEPARATORS:
        out = out.when(count[s] == most, F.lit(s))
    return chosen.select("file", out.alias("sep"))


def split_line(line: Column, sep: Column) -> Column:
    """Fields of a line or record; a separator inside double quotes does not split."""
    escaped = F.replace(line, F.lit(MARK), F.lit(LITERAL))
    # pieces between quotes alternate: outside, inside, outside, …
    parts = F.transform(
        F.split(escaped, '"'), lambda x, i: F.when(i % 2 == 0, F.replace(x, sep, F.lit(CUT))).otherwise(x)
    )
    marked = F.when(line.contains('"'), F.array_join(parts, '"')).otherwise(F.replace(escaped, sep, F.lit(CUT)))

    def plain(x: Column) -> Column:
        bare = F.regexp_replace(F.trim(x), '^"|"$', "")
        return F.replace(F.replace(bare, F.lit('""'), F.lit('"')), F.lit(LITERAL), F.lit(MARK))

    return F.transform(F.split(marked, CUT), plain)


def _numeric(x: Column) -> Column:
    number = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return (x == "") | F.upper(x).isin(NUMERIC_WORDS) | x.rlike(number)


def layout(lines: DataFrame) -> DataFrame:
    """Per file: ``sep, has_header, head`` (order of the header line) and ``names``.

    A file has no header iff its first two usable rows are all numeric; blanks
    and words for missing count as numeric. With fewer than two rows there is a
    header.
    """
    sep = sniff_delimiter(lines)
    two = first_rows(lines.where(_usable(F.col("line"))), ["file"], [F.col("ord")], 2)
    numbers = F.forall(split_line(F.col("line"), F.col("sep")), _numeric)
    facts = (
        attach(two, sep, ["file"])
        .groupBy("file")
        .agg(
            (F.count("*") == 2).alias("_two"),
            F.bool_and(numbers).alias("_num"),
            F.min_by("line", "ord").alias("_first"),
            F.min("ord").alias("_ord"),
        )
    )
    header = ~F.coalesce(F.col("_two") & F.col("_num"), F.lit(False))
    return attach(sep, facts, ["file"]).select(
        "file",
        "sep",
        header.alias("has_header"),
        F.when(header, F.col("_ord")).alias("head"),
        F.when(header, split_line(F.col("_first"), F.col("sep"))).alias("names"),
    )


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def join_quoted(lines: DataFrame) -> DataFrame:
    """Lines of one quoted field become one record, placed at its first line.

    A line with an odd number of quotes opens or closes a field; a running sum
    of them within the file tells which lines belong together. A field that is
    never closed leaves its lines as they are, so that a stray quote does not
    gather the rest of a file in one row. Only files with such a line are settled
    and put together, all other lines pass by.
    """
    torn = settle(lines.where(_quotes(F.col("line")) % 2 == 1).select("file").distinct())
    plain = attach(lines, torn, ["file"], "left_anti").select("file", "ord", "line")
    return plain.unionByName(_records(attach(lines, torn, ["file"], "left_semi")))


def _records(torn: DataFrame) -> DataFrame:
    """``join_quoted`` of files that have a line with an odd number of quotes."""
    tagged = settle(torn.select("file", "ord", "line", (_quotes(F.col("line")) % 2).alias("_odd")))
    k = F.col("_k")
    counted = positions(tagged, ["file"], "ord", "_k", weight="_odd")
    # opening line and lines inside have an odd sum, the closing one has the next even sum
    rows = settle(counted.withColumn("_record", F.when((k % 2 == 1) | (F.col("_odd") == 1), F.floor((k + 1) / 2))))
    closed = rows.where("_record IS NOT NULL").groupBy("file", "_record").agg((F.max("_k") % 2 == 0).alias("_closed"))
    known = attach(rows, closed, ["file", "_record"]).withColumn("_closed", F.coalesce("_closed", F.lit(False)))
    parts = F.array_sort(F.collect_list(F.struct("ord", "line")))
    joined = known.where("_closed").groupBy("file", "_record").agg(
        F.min("ord").alias("ord"), F.array_join(F.transform(parts, lambda r: r["line"]), "\n").alias("line")
    )
    return known.where("NOT _closed").select("file", "ord", "line").unionByName(joined.select("file", "ord", "line"))


def _body(lines: DataFrame, info: DataFrame) -> DataFrame:
    """Data rows with the layout of their file; lines that start with ``#`` are rows unless they precede the header."""
    rows = attach(lines.where(F.trim("line") != ""), info, ["file"])
    return rows.where(F.col("head").isNull() | (F.col("ord") > F.col("head")))


def cells_of_lines(lines: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """Delimited lines of any number of files in long form, whatever their layouts.

    Returns ``file, col_pos, column_name, ord, value``: the input of the type
    and profile operators. Names stay verbatim, also blank or repeated ones; a
    file without a header gets ``col_1 …``. ``info`` is the ``layout`` where it
    was read from the heads of the files. The layouts are broadcast if they are
    few, so lines are not shuffled; with very many files both sides are joined
    by file.
    """
    body = _body(lines, small_side(settle(layout(lines) if info is None else info)))
    # each field takes its name along before the rows part, so that no row carries all names
    fields = F.transform(
        split_line(F.col("line"), F.col("sep")),
        lambda x, i: F.struct(
            F.coalesce(F.get("names", i), F.concat(F.lit("col_"), (i + 1).cast("string"))).alias("column_name"),
            x.alias("value"),
        ),
    )
    cells = body.select("file", "ord", F.posexplode(fields).alias("_i", "_cell"))
    return cells.select("file", (F.col("_i") + 1).alias("col_pos"), "_cell.column_name", "ord", "_cell.value")


def _decoded(lines: DataFrame, facts: DataFrame) -> DataFrame:
    latin = F.decode(F.col("line").cast("binary"), "ISO-8859-1")
    known = attach(lines, facts.select("file", "latin", "torn"), ["file"])
    return known.withColumn("line", F.when(F.col("latin"), latin).otherwise(F.col("line"))).drop("latin")


def _tables(spark: SparkSession, paths: str | Sequence[str], multiline: bool) -> tuple[DataFrame, DataFrame]:
    """Lines (or records) of the delimited files below ``paths`` and the layout of each file from its head.

    One scan tells of each file whether a line is no UTF-8 and whether one has an odd number of quotes;
    the second is the one that uses the lines. Files with torn fields, which are few, are put together
    and settled.
    """
    files = settle(_listed(spark, paths).where(ext(F.col("path")).isin(TEXT_TABLES)))
    raw = lines_of_files(files)
    facts = raw.groupBy("file").agg(
        F.bool_or(~F.is_valid_utf8("line")).alias("latin"), F.bool_or(_quotes(F.col("line")) % 2 == 1).alias("torn")
    )
    facts = settle(facts)
    known = small_side(facts)
    lines = _decoded(raw, known)
    heads = _decoded(lines_of_files(files, heads=SNIFF_LINES, usable=2), known).drop("torn")
    if not multiline or facts.where("torn").isEmpty():
        return lines.drop("torn"), layout(heads)
    rest = attach(files.withColumnRenamed("path", "file"), facts.where("torn"), ["file"], "left_semi")
    torn = _decoded(lines_of_files(rest.withColumnRenamed("file", "path")), known).drop("torn")
    records = settle(_records(torn))
    whole = attach(heads, facts.where("torn"), ["file"], "left_anti").unionByName(records)
    return lines.where("NOT torn").drop("torn").unionByName(records), layout(whole)


def read_cells(spark: SparkSession, paths: str | Sequence[str], multiline: bool = True) -> DataFrame:
    """``cells_of_lines`` over all delimited files below ``paths``.

    A quoted field may run over several lines; ``multiline=False`` takes every line for a row.
    """
    return cells_of_lines(*_tables(spark, paths, multiline))


def _numbers_typed(table: DataFrame) -> DataFrame:
    """Columns whose every value is a whole number or a number take that type; one pass decides."""
    inner = [f"_{i}" for i in range(len(table.columns))]
    plain = table.toDF(*inner)
    checks = []
    for c in inner:
        v = F.trim(c)
        filled = (v != "") & v.isNotNull()
        checks += [
            F.bool_and(F.when(filled, v.rlike(r"^[+-]?[0-9]+$") & v.try_cast("bigint").isNotNull())).alias(f"i{c}"),
            F.bool_and(F.when(filled, v.try_cast("double").isNotNull() & ~v.rlike("(?i)[df]$"))).alias(f"d{c}"),
        ]
    found = plain.agg(*checks).first() if inner else {}
    typed = [
        F.trim(c).try_cast("bigint" if found[f"i{c}"] else "double").alias(c) if found[f"d{c}"] else F.col(c)
        for c in inner
    ]
    return plain.select(*typed).toDF(*table.columns)


def read_delimited(spark: SparkSession, path: str | Sequence[str], multiline: bool = True) -> DataFrame:
    """One table from delimited files, each read by its own separator, header and encoding; number types inferred.

    Columns are matched by name, a repeated or blank name by its turn; names stay
    verbatim, so a name may occur twice. ``NA`` and absent columns are null.
    """
    lines, found = _tables(spark, path, multiline)
    info = settle(found)
    body = _body(lines, small_side(info)).withColumn("_f", split_line(F.col("line"), F.col("sep")))
    cells = info.where("has_header").select("names", F.posexplode("names").alias("_i", "_n"))
    # a file without a header is as wide as its widest row
    width = body.where(~F.col("has_header")).agg(F.max(F.size("_f"))).first()[0] or 0
    turn = F.size(F.filter(F.slice("names", 1, F.col("_i") + 1), lambda x: x == F.col("_n")))
    columns = [
        (r["_n"], r["_t"])
        for r in cells.groupBy("_n", turn.alias("_t")).agg(F.min("_i").alias("_i")).orderBy("_i", "_n", "_t").collect()
    ]
    columns += [(f"col_{i + 1}", 1) for i in range(width) if (f"col_{i + 1}", 1) not in columns]
    keys = F.transform("names", lambda n, i: F.struct(n.alias("n"), F.size(F.filter(F.slice("names", 1, i + 1), lambda x: x == n)).alias("t")))
    rows = body.withColumn("_k", keys)

    def value(n: str, t: int) -> Column:
        wanted = F.struct(F.lit(n).alias("n"), F.lit(t).alias("t"))
        at = F.array_position("_k", wanted)
        named = F.when(at > 0, F.get("_f", at.cast("int") - 1))
        bare = re.fullmatch(r"col_([0-9]+)", n)
        out = F.when(F.col("has_header"), named)
        return out.otherwise(F.get("_f", F.lit(int(bare[1]) - 1))) if bare and t == 1 else out

    table = rows.select(
        *[F.nullif(value(n, t), F.lit("NA")).alias(f"_{i}") for i, (n, t) in enumerate(columns)]
    )
    return _numbers_typed(table.toDF(*[n for n, _ in columns]))


def load_union(frames: Sequence[DataFrame]) -> DataFrame:
    """One table out of several with differing columns; absent ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _folder(name: str) -> str:
    """Folder of an archive's members: the first words of its name, with a digest where that loses a part of it."""
    words = [re.sub(r"[^A-Za-z0-9_\-]", "", w) for w in name.strip().split()]
    short = "_".join([w for w in words if w][:5])
    if short == "_".join(name.split(" ")):
        return short
    return f"{short}-{hashlib.md5(name.encode()).hexdigest()[:12]}"


# ---- archives ---------------------------------------------------------------------------------

SINGLE = {"gz": gzip.open, "bz2": bz2.open, "xz": lzma.open}
UNSAFE = re.compile(r"(^|[/\\\\])\.\.([/\\\\]|$)|^[/\\\\]|^[A-Za-z]:")


def _kind(path: str) -> str:
    lower = path.lower()
    last = lower.rsplit(".", 1)[-1]
    return last if last == "zip" or (last in SINGLE and not re.search(r"\.tar\.(gz|bz2|xz)$", lower)) else "tar"


def _members(path: str, source: io.BufferedIOBase, first: int, last: int | None) -> Iterator[tuple[str, int, object]]:
    """(name, declared size or -1, opener) of the members from number ``first`` up to ``last``."""
    name = path.rsplit("/", 1)[-1]
    stem, kind = name.rsplit(".", 1)[0], _kind(path)
    if kind in SINGLE:
        yield stem, -1, lambda: SINGLE[kind](source)
    elif kind == "zip":
        with zipfile.ZipFile(source) as z:
            for info in [i for i in z.infolist() if not i.is_dir()][first:last]:
                yield f"{_folder(stem)}/{info.filename}", info.file_size, lambda info=info: z.open(info)
    else:
        with tarfile.open(fileobj=source, mode="r|*") as t:
            for info in t:
                if info.isfile():
                    yield f"{_folder(stem)}/{info.name}", info.size, lambda info=info: t.extractfile(info)


def _open(path: str, content: bytes | None) -> io.BufferedIOBase:
    if content is not None:
        return io.BytesIO(content)
    client, name, _ = _store(path)
    return io.BufferedReader(client.open_input_file(name), 1 << 20)


def _said(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def _slices(path: str, content: bytes | None) -> Iterator[tuple[int, int | None]]:
    """Ranges of members that are one task's work: a zip is cut by number and size, others are read through."""
    if _kind(path) != "zip":
        yield 0, None
        return
    with _open(path, content) as source, zipfile.ZipFile(source) as z:
        first, size = 0, 0
        sizes = [i.file_size for i in z.infolist() if not i.is_dir()]
    for n, more in enumerate(sizes):
        size += more
        if size >= PIECE or n - first + 1 >= SLICE_MEMBERS:
            yield first, n + 1
            first, size = n + 1, 0
    if first < len(sizes) or not sizes:
        yield first, len(sizes)


def _pieces_of(path: str, content: bytes | None, first: int, last: int | None, limit: int, as_lines: bool) -> Iterator[tuple]:
    """(archive, member, place, bytes, error): blocks or lines of members, in order; what cannot be read is an error."""
    try:
        with _open(path, content) as source:
            for member, size, opener in _members(path, source, first, last):
                if UNSAFE.search(member.split("/", 1)[-1]):
                    yield path, member, None, None, "unsafe path"
                    continue
                if size > limit:
                    yield path, member, None, None, f"larger than {limit} bytes"
                    continue
                try:
                    with opener() as data:
                        if as_lines:
                            parts = _split_lines(io.BufferedReader(data), 0, None)
                        else:
                            at = range(0, sys.maxsize, MEMBER_BLOCK)
                            parts = zip(at, iter(lambda data=data: data.read(MEMBER_BLOCK), b""), strict=False)
                        some = False
                        for place, part in parts:
                            if place + len(part) > limit:
                                yield path, member, None, None, f"larger than {limit} bytes"
                                break
                            some = True
                            yield path, member, place, part, None
                        if not some and not as_lines:
                            yield path, member, 0, b"", None
                except Exception as problem:  # noqa: BLE001 - any unreadable member becomes a row
                    yield path, member, None, None, _said(problem)
    except Exception as problem:  # noqa: BLE001 - any unreadable archive becomes a row
        yield path, None, None, None, _said(problem)


def _unpacked(archives: DataFrame, limit: int, as_lines: bool) -> DataFrame:
    """``archives``: path and, where the bytes are at hand, content."""
    held = "content" in archives.columns

    def contents(frame: pd.DataFrame) -> list[bytes | None]:
        return [bytes(x) for x in frame["content"]] if held else [None] * len(frame)

    def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                try:
                    found = [(path, a, b) for a, b in _slices(path, None)]
                except Exception:  # noqa: BLE001 - the reader says what is wrong
                    found = [(path, 0, None)]
                yield pd.DataFrame(found, columns=["path", "first", "last"]).astype({"last": "Int64"})

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, rows, size = ["archive", "member", "place", "content", "error"], [], 0
        for frame in frames:
            for i, (path, content) in enumerate(zip(frame["path"], contents(frame), strict=True)):
                first, last = (0, None) if held else (int(frame["first"].iloc[i]), frame["last"].iloc[i])
                for row in _pieces_of(path, content, first, None if last is None or pd.isna(last) else int(last), limit, as_lines):
                    rows.append(row)
                    size += 64 + len(row[3] or b"")
                    if size >= BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=names).astype({"place": "Int64"})
                        rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names).astype({"place": "Int64"})

    todo = archives.where(F.col("path").rlike(ARCHIVES))
    if not held:
        todo = _spread_out(_spread_out(todo.select("path")).mapInPandas(plan, "path string, first bigint, last bigint"))
    return todo.mapInPandas(read, "archive string, member string, place bigint, content binary, error string")


def archive_members(files: DataFrame, limit: int = MEMBER_LIMIT) -> DataFrame:
    """``archive, member, place, content, error``: the members of the archives in ``path``, in blocks.

    Archives are read where they lie, by seeking; a block has ``MEMBER_BLOCK`` bytes at most and stands
    at byte ``place`` of its member, so neither an archive nor a member has to fit in memory. A zip is
    shared by many tasks, a tar or a single compressed file is read through by one. What cannot be read
    is a row with an ``error``: a broken archive, a name that leads out of the folder, a member that
    unpacks to more than ``limit`` bytes (its blocks so far, if there are any, are not the whole).
    """
    return _unpacked(files.select("path"), limit, False)


def lines_of_archives(files: DataFrame, limit: int = MEMBER_LIMIT) -> DataFrame:
    """``file, ord, line`` of the delimited members of the archives in ``path``, as ``lines_of_files`` gives them.

    ``file`` is archive and member with ``!`` between; members that cannot be read give no lines, see
    ``archive_members`` for why.
    """
    rows = _unpacked(files.select("path"), limit, True).where("error IS NULL").where(ext(F.col("member")).isin(TEXT_TABLES))
    return rows.select(F.concat_ws("!", "archive", "member").alias("file"), F.col("place").alias("ord"), F.col("content").cast("string").alias("line"))


def expand_archives(binary: DataFrame, limit: int = MEMBER_LIMIT) -> DataFrame:
    """Whole members of the archives among ``path, content`` rows; a broken one is an error row.

    For archives whose bytes are already in the table and members that fit in a row; ``archive_members``
    reads archives of any size.
    """
    parts = _unpacked(binary.select("path", "content"), limit, False)
    blocks = F.array_sort(F.collect_list(F.when(F.col("error").isNull(), F.struct("place", "content"))))
    whole = parts.groupBy("archive", "member").agg(blocks.alias("_b"), F.max("error").alias("error"))
    content = F.aggregate("_b", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["content"]))
    good = F.col("error").isNull()
    return whole.select(
        "archive", "member",
        F.when(good, F.octet_length(content)).otherwise(0).cast("bigint").alias("size"),
        F.when(good, content).alias("content"), "error",
    )
