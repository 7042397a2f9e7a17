"""Sinks and documents: result tables, clean data export, XML metadata, dataset JSON."""

from __future__ import annotations

import csv
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.text import strip_markup
from tablewarden.operators.scale import attach, spread
from tablewarden.sources.files import _store

NUMERIC_TYPES = [
    "continuous", "continuous_comma_decimal", "continuous_outliers_excluded"
]
CATEGORICAL_TYPES = ["categorical", "binary", "ordinal"]
STATISTICS = ["n", "n_missing", "mean", "sd", "se", "median", "p25", "p75", "iqr", "skewness", "kurtosis"]


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("source", "paper_id"), fmt: str = "parquet") -> None:
    """Result table as parquet or CSV under one folder per partition value.

    No shuffle by partition value first: a hot repository is written by all
    tasks that hold its rows.
    """
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    writer.csv(path, header=True) if fmt == "csv" else writer.format(fmt).save(path)


def filled_columns(df: DataFrame) -> list[str]:
    """Columns with any non-blank value, from one aggregate over the table."""
    marks = df.agg(
        *[
            F.coalesce(F.bool_or(F.trim(F.col(f"`{c}`").cast("string")) != ""), F.lit(False)).alias(str(i))
            for i, c in enumerate(df.columns)
        ]
    ).first()
    return [c for i, c in enumerate(df.columns) if marks[i]]


def clean_table(df: DataFrame) -> DataFrame:
    """Without empty columns; a ``row_id`` with repeated values becomes ``original_row_id``."""
    out = df.select(*[F.col(f"`{c}`") for c in filled_columns(df)])
    if "row_id" in out.columns:
        repeated = out.groupBy("row_id").agg(F.count("*").alias("n")).where("n > 1")
        if not repeated.isEmpty():
            out = out.withColumnRenamed("row_id", "original_row_id")
    return out


def write_zipped(df: DataFrame, path: str) -> None:
    """One zip per task below ``path``, with the task's rows as a quoted CSV file in it.

    A zip is written to a name of its attempt and then renamed to that of its partition, so a task that
    is run again leaves one whole file.
    """
    names = df.columns

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        client, base, _ = _store(path)
        client.create_dir(base, recursive=True)
        final = f"{base}/part-{task.partitionId():05d}.zip"
        draft = f"{base}/.{task.partitionId()}-{task.taskAttemptId()}"
        with client.open_output_stream(draft) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            with z.open(f"part-{task.partitionId():05d}.csv", "w", force_zip64=True) as member:
                for i, frame in enumerate(frames):
                    text = frame.to_csv(index=False, header=names if i == 0 else False, quoting=csv.QUOTE_ALL)
                    member.write(text.encode())
        client.move(draft, final)
        yield pd.DataFrame({"path": [final]})

    df.mapInPandas(write, "path string").write.format("noop").mode("overwrite").save()


def export_table(df: DataFrame, path: str) -> dict[str, object]:
    """Write the cleaned table as quoted CSV and report what was written."""
    out = clean_table(df)
    out.write.mode("overwrite").csv(path, header=True, quoteAll=True)
    return {
        "path": path,
        "rows_written": out.count(),
        "columns_written": len(out.columns),
        "row_id_renamed": "original_row_id" in out.columns and "row_id" in df.columns,
    }


# a character no XML document can contain
_MARK = "\x1f"


def _texts(xml: Column, path: str) -> Column:
    return F.filter(
        F.transform(F.xpath(xml, F.lit(f"{path}/text()")), lambda v: F.trim(v)), lambda x: x != ""
    )


def _inner(xml: Column, tag: str) -> Column:
    """Text of the first such element of a fragment."""
    return strip_markup(F.regexp_extract(xml, f"(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>", 1))


def xml_metadata(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Paper metadata of TEI documents as columns; malformed documents give nulls only.

    Authors, journal and identifiers are read under the header's source node,
    so cited works do not count. Only the header is parsed, and single values are
    fetched several at a time; the long body never is.
    """
    keep = [c for c in df.columns if c != xml]
    raw = F.col(xml)
    start, end = F.instr(raw, "<teiHeader"), F.instr(raw, "</teiHeader>")
    header = F.when((start > 0) & (end > start), F.substr(raw, start, end - start + 12)).otherwise(raw)
    bare = F.regexp_replace(header, r'\sxmlns(:\w+)?="[^"]*"', "")
    shape = F.from_xml("_x", "broken string", {"columnNameOfCorruptRecord": "broken"})
    clean = (
        spread(df)
        .select(*keep, bare.alias("_x"))
        .withColumn("_x", F.when(shape["broken"].isNull() & (F.trim("_x") != ""), F.col("_x")))
    )
    x = F.col("_x")
    src = "//teiHeader//sourceDesc/biblStruct"
    monogr, imprint = f"{src}/monogr", f"{src}/monogr/imprint"
    page = f"{imprint}/biblScope[@unit='page']"
    single = {
        "title": ["//titleStmt/title[@type='main']", "//titleStmt/title[1]"],
        "doi": [f"{src}//idno[@type='DOI']"],
        "date": ["//publicationStmt//date[@type='published']/@when", f"{imprint}/date[@type='published']/@when"],
        "journal": [f"{monogr}/title[@level='j']", f"{monogr}/title[@level='m']"],
        "volume": [f"{imprint}/biblScope[@unit='volume']"],
        "issue": [f"{imprint}/biblScope[@unit='issue']"],
        "first_page": [f"{page}/@from"],
        "last_page": [f"{page}/@to"],
        "page_text": [page],
        "publisher": [f"{imprint}/publisher"],
        "issn": [f"{monogr}/idno[@type='ISSN']"],
    }
    paths = [p for several in single.values() for p in several]

    def together(some: list[str]) -> Column:
        joined = f", '{_MARK}', ".join(f"string({p})" for p in some)
        return F.split(F.xpath_string(x, F.lit(f"concat({joined})")), _MARK)

    # an XPath expression may hold a hundred operators, which is enough for five paths
    groups = [paths[i : i + 5] for i in range(0, len(paths), 5)]
    parts = clean.withColumn("_p", F.concat(*[together(g) for g in groups]))

    def value(name: str) -> Column:
        found = [F.trim(F.get("_p", F.lit(paths.index(p)))) for p in single[name]]
        return F.coalesce(*[F.when(v != "", v) for v in found])

    analytic = F.regexp_extract(x, r"(?s)<sourceDesc.*?<analytic[^>]*>(.*?)</analytic>", 1)
    people = F.regexp_extract_all(analytic, F.lit(r"(?s)(<persName.*?</persName>)"), F.lit(1))
    names = F.transform(
        people, lambda p: F.trim(F.concat_ws(" ", _inner(p, "forename"), _inner(p, "surname")))
    )
    first, last = value("first_page"), value("last_page")
    pages = F.when(
        first.isNotNull(),
        F.concat(first, F.when(last.isNotNull(), F.concat(F.lit("-"), last)).otherwise(F.lit(""))),
    ).otherwise(value("page_text"))
    year = F.regexp_extract(value("date"), "^([0-9]{4})", 1)
    return parts.select(
        *keep,
        value("title").alias("title"),
        F.nullif(F.array_join(_texts(x, "//abstract//p"), " "), F.lit("")).alias("abstract"),
        F.array_distinct(F.filter(names, lambda n: n != "")).alias("authors"),
        *[value(n).alias(n) for n in ("doi", "date")],
        F.when(year != "", year).alias("pub_year"),
        *[value(n).alias(n) for n in ("journal", "volume", "issue")],
        pages.alias("pages"),
        *[value(n).alias(n) for n in ("publisher", "issn")],
        F.array_distinct(_texts(x, "//keywords/term")).alias("keywords"),
    )


def _present(fields: dict[str, Column]) -> Column:
    """A JSON object of the fields that are not null."""
    return F.to_json(F.struct(*[e.alias(n) for n, e in fields.items()]), {"ignoreNullFields": "true"})


def property_values(columns: DataFrame, labels: DataFrame, coverage: DataFrame | None = None, prefix: str = "audit") -> DataFrame:
    """One JSON object per variable of a study: ``paper_id, group, source_file, col_pos, json``.

    A description appears only for labelled columns, a statistics block for
    numeric types, a value pattern for categorical ones; empty columns are left
    out. Dictionary variables missing from the data come last.
    """
    key = ["paper_id", "source_file", "col_pos"]
    lab = labels.select(*key, "label", "label_status", "label_source", "label_method", "codebook_variable")
    rows = attach(columns.where(F.lower("col_type") != "empty"), lab, key)
    text = F.array_join("label", " | ")
    described = (F.col("label_status") == "labelled") & (text != "")
    numeric = F.col("col_type").isin(NUMERIC_TYPES)
    stats = F.struct(*[F.col(s) for s in STATISTICS])
    values = F.array_distinct(
        F.filter(F.transform(F.split("sample_values", r"\|"), lambda v: F.trim(v)), lambda v: v != "")
    )
    pattern = F.when(F.col("col_type").isin(CATEGORICAL_TYPES) & (F.size(values) > 0), F.array_join(values, "|"))

    def labelled(c: Column) -> Column:
        return F.when(described, c)

    json = _present(
        {
            "@type": F.lit("PropertyValue"),
            "name": F.col("column_name"),
            "description": labelled(text),
            f"{prefix}:label_source": labelled(F.array_join("label_source", " | ")),
            f"{prefix}:label_method": labelled(F.col("label_method")),
            f"{prefix}:codebook_variable": labelled(F.array_join("codebook_variable", " | ")),
            "minValue": F.when(numeric, F.col("min")),
            "maxValue": F.when(numeric, F.col("max")),
            f"{prefix}:statistics": F.when(numeric, stats),
            "valuePattern": pattern,
            f"{prefix}:col_type": F.col("col_type"),
            f"{prefix}:source_file": F.col("source_file"),
            f"{prefix}:sample_values": F.col("sample_values"),
        }
    )
    out = rows.select("paper_id", "group", "source_file", "col_pos", json.alias("json"))
    if coverage is None:
        return out
    extra = coverage.where(F.col("match_status") == "unmatched_in_data").select(
        "paper_id",
        "group",
        F.lit("~").alias("source_file"),
        F.xxhash64("codebook_variable", "label", "codebook_source").alias("col_pos"),
        _present(
            {
                "@type": F.lit("PropertyValue"),
                "name": F.col("codebook_variable"),
                "description": F.nullif("label", F.lit("")),
                f"{prefix}:match_status": F.col("match_status"),
                f"{prefix}:source_file": F.col("codebook_source"),
            }
        ).alias("json"),
    )
    return out.unionByName(extra)


def dataset_lines(values: DataFrame, by: Sequence[str] = ("paper_id", "group")) -> DataFrame:
    """The JSON document of each study, line by line: ``by…, part, source_file, col_pos, line``.

    In the order (part, source_file, col_pos) the lines of a study concatenate
    to its document. No study is gathered in one row, so its size is no matter.
    """
    by = list(by)
    firsts = values.groupBy(*by).agg(F.max(F.struct("source_file", "col_pos")).alias("_last"))
    head = firsts.select(
        *by, F.lit(0).alias("part"), F.lit("").alias("source_file"), F.lit(0).cast("bigint").alias("col_pos"),
        F.concat(
            F.lit('{"@context":"https://schema.org/","@type":"Dataset","name":'),
            F.to_json(F.struct(F.concat_ws(" ", *by).alias("n"))).substr(F.lit(6), F.lit(2_147_483_647)),
        ).alias("_h"),
    ).select(
        *by, "part", "source_file", "col_pos",
        F.concat(F.regexp_replace("_h", r"\}$", ""), F.lit(',"variableMeasured":[')).alias("line"),
    )
    body = attach(values, firsts, by).select(
        *by, F.lit(1).alias("part"), "source_file", F.col("col_pos").cast("bigint").alias("col_pos"),
        F.concat(
            "json",
            F.when(F.struct("source_file", "col_pos") == F.col("_last"), F.lit("")).otherwise(F.lit(",")),
        ).alias("line"),
    )
    tail = firsts.select(
        *by, F.lit(2).alias("part"), F.lit("").alias("source_file"), F.lit(0).cast("bigint").alias("col_pos"),
        F.lit("]}").alias("line"),
    )
    return head.unionByName(body).unionByName(tail)


def dataset_documents(values: DataFrame, by: Sequence[str] = ("paper_id", "group"), limit: int | None = None) -> DataFrame:
    """Whole documents, one row per study; with ``limit`` only of studies with at most so many variables.

    A study is gathered in one row; ``write_documents`` never does that, for studies of any size.
    """
    by = list(by)
    sizes = values.groupBy(*by).agg(F.count("*").alias("n_variables"))
    if limit is not None:
        sizes = sizes.where(F.col("n_variables") <= limit)
    lines = attach(dataset_lines(values, by), sizes, by, "inner")
    ordered = F.array_sort(F.collect_list(F.struct("part", "source_file", "col_pos", "line")))
    return lines.groupBy(*by, "n_variables").agg(
        F.array_join(F.transform(ordered, lambda r: r["line"]), "\n").alias("document")
    )


def write_documents(values: DataFrame, path: str, by: Sequence[str] = ("paper_id", "group")) -> None:
    """All documents as text in document order; one document may span several part files."""
    order = [*by, "part", "source_file", "col_pos"]
    lines = dataset_lines(values, by).repartitionByRange(*order).sortWithinPartitions(*order)
    lines.select("line").write.mode("overwrite").text(path)


def sidecar_json(files: DataFrame, prefix: str = "audit") -> DataFrame:
    """Sidecar object per exported file; its variables follow as ``dataset_lines`` by file."""
    name = F.substring_index("rel_path", "/", -1)
    original = F.struct("rel_path", F.col("ext").alias("format"), F.col("size").alias("size_bytes"), "data_granularity")
    conversion = F.struct(
        F.col("method"),
        F.lit(True).alias("encoding_normalized"),
        F.col("method").contains("haven").alias("haven_labels_extracted"),
    )
    return files.select(
        "paper_id",
        "rel_path",
        _present(
            {
                "@type": F.lit("Dataset"),
                "name": F.concat(name, F.lit(" — "), F.col("paper_id")),
                "description": F.concat(
                    F.lit("Data file '"), name, F.lit("' from repository "), F.col("paper_id"),
                    F.lit(" (converted: "), F.regexp_replace("export_name", r"\.csv$", ""), F.lit(")"),
                ),
                f"{prefix}:original_file": original,
                f"{prefix}:conversion": conversion,
            }
        ).alias("json"),
    )


def provenance_json(files: DataFrame) -> DataFrame:
    """Where each exported file came from, with the human labels of validated ones."""
    validated = F.coalesce("ground_truth_validated", F.lit(False))
    truth = F.struct("type_gt", "group_gt", "data_granularity_gt", "validated_at", "annotator")
    return files.select(
        "paper_id",
        "rel_path",
        _present(
            {
                "export_path": F.col("export_name"),
                "original_rel_path": F.col("rel_path"),
                "original_format": F.col("ext"),
                "pipeline_type": F.col("type"),
                "pipeline_group": F.col("group"),
                "pipeline_data_granularity": F.col("data_granularity"),
                "ground_truth_validated": validated,
                "ground_truth": F.when(validated, truth),
            }
        ).alias("json"),
    )
