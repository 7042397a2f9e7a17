"""What several operators of this subpackage share: session limits, stored tables, words in numpy."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.session import shared_folder, tune

# A Python worker holds one Arrow batch at a time, so its memory is bounded by rows and by bytes.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20
# Whole texts are put together to blocks of about this size for numpy.
BLOCK_BYTES = 1 << 20

# The bytes of [\x20\x09-\x0D], which never occur inside a multi-byte character.
SPACES = [9, 10, 11, 12, 13, 32]
SPACE = np.zeros(256, bool)
SPACE[SPACES] = True

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))


def prepare(spark: SparkSession) -> None:
    """Runtime settings the operators count on; set while a query is built."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``id`` and ``text`` alone, so that no other column's name can clash."""
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Unlike ``checkpoint()`` the copy is compressed and knows its size. The finished plan is let go
    of at once, so that its shuffle files are deleted before the next step writes its own.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = df.schema
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folders of a ``stored`` table that no later step reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def same(left: Column, right: Column) -> Column:
    """Equality in which null equals null."""
    return left.eqNullSafe(right)


def trim() -> None:
    """Give freed memory back to the system; a worker lives on from stage to stage and would keep it."""
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, others need not
    if release:
        release(0)


# ---- numpy on Arrow strings -------------------------------------------------------------------


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, content = texts.buffers()
    off = np.frombuffer(places, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, data[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end and row of every word; no word runs over the end of a text."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(off, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(which: str, n: int) -> np.ndarray:
    have = _powers[which]
    if len(have) < n:
        step = np.full(max(n, 1 << 16), MULTIPLIER if which == "up" else INVERSE, np.uint64)
        step[0] = 1
        have = _powers[which] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def rolling(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial modulo 2**64, from which any span has its hash in one step."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power("up", len(values)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the values from ``starts`` to ``ends``, wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _power("down", len(sums))[starts])


def byte_sums(data: np.ndarray) -> np.ndarray:
    return rolling(BYTE_VALUE[data])
