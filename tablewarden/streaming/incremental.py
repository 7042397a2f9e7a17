"""Incremental work: new files as a stream, an append-only log, keyed upserts.

The audited collections are batches; what streams is their arrival. A file
source with a checkpoint remembers which files were seen, ``availableNow``
processes the backlog and stops, and every sink below can run a micro-batch
again without doubling rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablewarden.operators.runlog import upsert
from tablewarden.operators.scale import attach
from tablewarden.session import settle


def arrivals(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "parquet", per_batch: int = 1000) -> DataFrame:
    """Files that appear in ``folder`` as a stream, at most ``per_batch`` files a time."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_batch)
    return reader.load(folder)


def run_available(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Run ``work`` on all that has arrived since the last run, then stop."""
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row per key by ``order``, equal ones by their content: the same rows give the same row.

    Keys are reduced with map-side combine, so a key that arrives very often is one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    place = F.struct(*order, F.xxhash64(*df.columns).alias("_content"))
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), place).alias("_r")) if rest else df.dropDuplicates(list(keys))
    return newest.select(*[F.col("_r")[c].alias(c) if c in rest else F.col(c) for c in df.columns])


def append_log(path: str, keys: Sequence[str], order: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Sink for ``run_available``: each micro-batch goes to its own folder of the log.

    Of rows of a batch with one key the last by ``order`` is kept. Writing a batch again overwrites its
    folder, so a replay adds nothing. Keys may still repeat across batches; ``read_log`` settles those.
    """

    def work(batch: DataFrame, number: int) -> None:
        last_rows(batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return work


def read_log(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The log with the last row per key: by ``order`` over all batches, equal or without it the later batch."""
    log = spark.read.option("basePath", path).parquet(path)
    return last_rows(log, keys, [*order, "batch"]).drop("batch")


class KeyedTable:
    """A table that is upserted by key, partition by partition, and always has one current version.

    Rows lie by the hash of their key in ``partitions`` parts. An upsert rewrites the parts its keys
    fall into, below a new version, and last writes a pointer: a small table of which version each part
    is at. A reader takes the newest pointer that is complete, so it sees a version before or after an
    upsert and never a half; an upsert that broke off is run again from the version before it. Versions
    are numbered by the caller (the micro-batch), one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partitions: int = 64):
        self.spark, self.path, self.keys, self.partitions = spark, path.rstrip("/"), list(keys), partitions

    def _names(self, folder: str) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        store = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [x.getPath().getName() for x in store.listStatus(path)] if store.exists(path) else []

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        named = [int(n.removeprefix("version=")) for n in self._names("pointers") if n.startswith("version=")]
        return sorted(n for n in named if "_SUCCESS" in self._names(f"pointers/version={n}"))

    def _parts(self, version: int) -> dict[int, int]:
        rows = self.spark.read.schema("part int, at bigint").parquet(f"{self.path}/pointers/version={version}").collect()
        return {r["part"]: r["at"] for r in rows}  # one row a part

    def _read(self, parts: dict[int, int]) -> DataFrame | None:
        paths = [f"{self.path}/data/version={v}/part={p}" for p, v in sorted(parts.items())]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of the current (or a named) version; None before the first."""
        known = self.versions()
        return self._read(self._parts(known[-1] if version is None else version)) if known else None

    def upsert(self, batch: DataFrame, number: int, order: Sequence[str] = ()) -> None:
        """Rows of ``batch`` replace those of their keys, as version ``number``; a version that is complete stays."""
        before = [v for v in self.versions() if v <= number]
        if before and before[-1] == number:
            return
        parts = self._parts(before[-1]) if before else {}
        keyed = settle(last_rows(batch, self.keys, order).withColumn("part", self._part()))
        touched = sorted(r["part"] for r in keyed.select("part").distinct().collect())
        base = self._read({p: parts[p] for p in touched if p in parts})
        merged = keyed.drop("part")
        if base is not None:
            kept = attach(base, merged.select(*self.keys), self.keys, "left_anti")
            merged = kept.unionByName(merged, allowMissingColumns=True)
        if touched:
            rows = merged.withColumn("part", self._part()).repartition("part")
            rows.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/data/version={number}")
        parts |= {p: number for p in touched}
        pointer = self.spark.createDataFrame(sorted(parts.items()), "part int, at bigint")
        pointer.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/pointers/version={number}")

    def _part(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.partitions)).cast("int")

    def vacuum(self, keep: int = 2) -> None:
        """Deletes pointers older than the newest ``keep`` and parts that none of these names."""
        known = self.versions()
        kept = known[-keep:]
        used = {(v, p) for k in kept for p, v in self._parts(k).items()}
        jvm = self.spark.sparkContext._jvm
        store = jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for v in known[:-keep]:
            store.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/pointers/version={v}"), True)
        for folder in self._names("data"):
            v = int(folder.removeprefix("version="))
            if kept and v <= kept[-1]:
                for part in self._names(f"data/{folder}"):
                    if part.startswith("part=") and (v, int(part.removeprefix("part="))) not in used:
                        store.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/{folder}/{part}"), True)


def upsert_rows(path: str, keys: Sequence[str], order: Sequence[str] = (), partitions: int = 64) -> Callable[[DataFrame, int], None]:
    """Sink for ``run_available``: every micro-batch is upserted into the ``KeyedTable`` at ``path``."""

    def work(batch: DataFrame, number: int) -> None:
        KeyedTable(batch.sparkSession, path, keys, partitions).upsert(batch, number, order)

    return work


def replace_rows(base_path: str, next_path: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Sink that upserts by key: the merged table is written beside the one it replaces.

    Versions alternate by batch number, so no write reads what it overwrites and a replayed batch starts
    from the same version. It rewrites the whole table; ``upsert_rows`` only the parts that change.
    """

    def work(batch: DataFrame, number: int) -> None:
        source, target = (base_path, next_path) if number % 2 == 0 else (next_path, base_path)
        base = batch.sparkSession.read.parquet(source)
        upsert(base, last_rows(batch, keys), keys).write.mode("overwrite").parquet(target)

    return work


def add_missing_columns(log: DataFrame, schema: StructType) -> DataFrame:
    """An older log brought to the current columns; new ones are null."""
    have = set(log.columns)
    return log.select(
        *[
            F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ],
        *[c for c in log.columns if c not in schema.names],
    )
