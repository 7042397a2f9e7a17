"""Exact dedup by a persistent digest index: a table bucketed and sorted by the digest of the text.

New data is reduced to one row per digest, set against the index by a sort-merge anti join that reads
the index bucket by bucket without shuffling it, and what the index lacks is appended. All of it is
DataFrame expressions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm.common import pick, prepare, stored, table
from tablewarden.session import shared_folder

ENTRIES = "digest binary, keep_id bigint, batch string"


class DigestIndex:
    """The index in ``folder`` (shared by all executors): ``entries`` bucketed by digest, and ``about``.

    An index outlives its session: opening the folder again declares the same bucketed table. An
    append is committed as a whole by Spark's writer; one that is run again after a failure finds its
    own entries and adds nothing. One writer at a time. A new index has ``buckets`` buckets, as many as
    a shuffle has partitions if none are named; one that exists keeps its number.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        about = f"{self.folder}/about"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{about}/_SUCCESS")
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(about)
        self.buckets = spark.read.schema("buckets int").parquet(about).first()[0]
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} ({ENTRIES}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/entries'"
        )

    def entries(self) -> DataFrame:
        """(digest, keep_id, batch), one row per digest; Spark knows the buckets and does not shuffle them."""
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        """Add rows whose digests the index lacks; they come with one task per bucket, so one file each."""
        self.spark.catalog.refreshTable(self.name)
        writer = rows.select("digest", "keep_id", "batch").write.format("parquet").mode("append")
        writer.bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)

    def close(self) -> None:
        """Forget the table's name in this session; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deduplicate(
    docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, known, digest; new digests join the index.

    Texts are equal when their bytes are. Of equal texts of one batch the row with the largest id stays;
    a text that an earlier batch brought goes, ``known``, and ``keep_id`` names the row that stayed then.
    ``group_size`` counts the equal texts of this batch. A null text is an empty one. Of rows that repeat
    an id and a text one stays, and of a group without any id one row too (``keep_id`` null), so a text is
    never lost. A batch that is run again gets the decisions of its first run. Long texts are digested
    whole; an empty table gives no rows and leaves the index as it is.

    Only digests are shuffled. They are counted before that, so a hot text is one row per task; the join
    back to the rows is a plain one that adaptive execution splits.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, id_col, text_col).select(
        F.col("id").cast("bigint").alias("id"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"),
    )
    # the number tells repeated rows apart; it is written once and so never changes
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    groups = rows.groupBy("digest").agg(
        F.max(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    groups = stored(groups, "digest-groups").repartition(index.buckets, "digest")
    new = groups.join(index.entries().hint("merge"), "digest", "left_anti")
    index.append(new.select("digest", F.col("best.id").alias("keep_id"), F.lit(batch).alias("batch")))
    decided = groups.join(index.entries().hint("merge"), "digest").select(
        "digest", "keep_id", "group_size", F.col("best.row").alias("best_row"), (F.col("batch") != batch).alias("known")
    )
    decided = stored(decided, "decided")
    return rows.join(decided, "digest").select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (~F.col("known") & (F.col("row") == F.col("best_row"))).alias("kept"),
        "known",
        "digest",
    )


def op12_exact_dedup(spark, sf_dir):
    """All documents as the first batch of a new index in the shared folder."""
    index = DigestIndex(spark, f"{shared_folder(spark)}/digest-index-{uuid.uuid4().hex}")
    found = deduplicate(table(spark, sf_dir, "documents"), index, "documents")
    index.close()
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP12_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
