"""Sharding by jump consistent hashing: a stable key and the number of shards decide, no table does.

The hash steps a 64-bit linear congruential generator and jumps ahead until it passes the number of
shards. All of it is column arithmetic: the 64-bit product, which Spark's long would refuse as an
overflow, is put together from 16-bit and 32-bit parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import pick, prepare, table
from tablewarden.operators.scale import positions

# Fixed value: the multiplier of the generator, as published for this hash.
STEP = 2862933555777941757
LOW32 = (1 << 32) - 1
# Jumps tried for every row; the few rows that need more (none below 2**20 shards in practice) go on
# with one try for each shard, which always suffices.
JUMPS = 48


def _next_key(high: Column, low: Column) -> tuple[Column, Column]:
    """(high, low) 32-bit halves of ``key * STEP + 1`` modulo 2**64."""
    a00, a01 = STEP & 0xFFFF, STEP >> 16 & 0xFFFF
    a10, a11 = STEP >> 32 & 0xFFFF, STEP >> 48

    def times(x: Column, part0: int, part1: int) -> Column:
        """x * (part1 * 2**16 + part0) modulo 2**49 or so: its low 32 bits are right."""
        return x * F.lit(part0) + F.shiftleft((x * F.lit(part1)).bitwiseAND(F.lit(0xFFFF)), 16)

    upper = low * F.lit(a01)
    whole = low * F.lit(a00) + F.lit(1) + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftright(whole, 32) + F.shiftright(upper, 16)
    return (
        (carry + times(high, a00, a01) + times(low, a10, a11)).bitwiseAND(F.lit(LOW32)),
        whole.bitwiseAND(F.lit(LOW32)),
    )


def jump_hash(key: Column, shards: int) -> Column:
    """Shard (int, 0 to ``shards`` - 1) of a long key taken as 64 unsigned bits; null goes as 0."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    big = lambda x: F.lit(x).cast("bigint")
    n = big(shards)
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(big(LOW32)).alias("low"),
        big(-1).alias("b"),
        big(0).alias("j"),
    )

    def jump(s: Column, _: Column) -> Column:
        high, low = _next_key(s["high"], s["low"])
        ratio = F.lit(2147483648.0) / (F.shiftright(high, 1) + big(1)).cast("double")
        ahead = ((s["j"] + big(1)).cast("double") * ratio).cast("bigint")
        return F.when(s["j"] >= n, s).otherwise(
            F.struct(high.alias("high"), low.alias("low"), s["j"].alias("b"), ahead.alias("j"))
        )

    def run(tries: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(tries)), start, jump)

    if shards <= JUMPS:
        return run(shards)["b"].cast("int")
    few = run(JUMPS)
    return F.when(few["j"] >= n, few["b"]).otherwise(run(shards)["b"]).cast("int")


def stable_key(df: DataFrame, *cols: str) -> Column:
    """The key of one integer column itself; of anything else its 64-bit hash."""
    kinds = dict(df.dtypes)
    if len(cols) == 1 and kinds[cols[0]] in ("tinyint", "smallint", "int", "bigint"):
        return F.col(cols[0]).cast("bigint")
    return F.xxhash64(*[F.col(c) for c in cols])


def assign_shards(df: DataFrame, key_cols: list[str], shards: int, out: str = "shard") -> DataFrame:
    """``df`` with its shard in column ``out`` (which replaces a column of that name).

    No shuffle: each row is decided on its own. Equal keys share a shard, null keys too; with one
    more shard, rows move only into that one.
    """
    return df.withColumn(out, jump_hash(stable_key(df, *key_cols), shards))


def op9_jump_hash(spark, sf_dir, shards: int = 8):
    """Shard, gapless place in it (by id) and the shard after growing by one.

    A null text counts as empty; rows equal in id, size and checksum have any order among them.
    """
    prepare(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = pick(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = assign_shards(rows, ["doc_id"], shards)
    rows = assign_shards(rows, ["doc_id"], shards + 1, "grown_shard")
    order = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    placed = positions(rows, ["shard"], order, out="slot", width=None)
    return placed.withColumn("slot", F.col("slot") - 1)


OP9_SQL = """
WITH RECURSIVE hexed AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(hex(coalesce(text, '')), '') AS h FROM documents
), bits AS (
  SELECT doc_id, strlen(t) + 1 AS size, CASE WHEN t = '' THEN []::BIGINT[] ELSE
    list_transform(range(1, len(h) + 1), lambda i: strpos('0123456789ABCDEF', h[CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END]) - 1) END AS nibbles
  FROM hexed
), polynomial AS (
  SELECT list_transform(range(16), lambda i: list_reduce([i, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), summed AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295, nibbles),
    lambda c, x: xor(c >> 4, steps[(xor(c, x) & 15) + 1]))) AS text_crc32
  FROM bits CROSS JOIN polynomial
), jump AS (
  SELECT doc_id, n, ((doc_id::HUGEINT + 18446744073709551616) % 18446744073709551616) AS key, -1::BIGINT AS b, 0::BIGINT AS j
  FROM documents CROSS JOIN (VALUES (8), (9)) AS shards(n)
  UNION ALL
  SELECT doc_id, n, next, j, floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((next // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (key * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM jump) WHERE j < n
), found AS (
  SELECT doc_id, max(b) FILTER (n = 8)::INTEGER AS shard, max(b) FILTER (n = 9)::INTEGER AS grown_shard
  FROM jump WHERE j >= n GROUP BY doc_id
)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM summed JOIN found USING (doc_id)
"""
