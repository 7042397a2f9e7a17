"""SimHash near-duplicates by an inverted index on the bytes of the fingerprints.

A posting list is keyed by a few byte positions and the bytes there. Pairs that meet in a list have
their shared positional bytes tallied; pairs below the minimum are let go of, the rest is verified.
Lists of a single byte would hold 1/256 of all texts each, so a list takes several positions at once:

* Hamming distance 3 on 8 bytes leaves at least five bytes equal, and every five of eight positions
  hold one of fourteen quadruples. No pair is missed.
* Similarity of word shingles has no such guarantee; there a wide fingerprint and many triples of
  positions propose pairs, and the shingle sets themselves decide. Pairs that differ by scattered
  words are rarely missed, but about a third of those at 0.8 with one block appended or replaced are.
* ``complete=True`` lets posting lists on the shingles look for the rest, between the groups that the
  fingerprints made: sets of similarity s share a member among the first (1 - s) of each, in any one
  order of all shingles. No pair is missed.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import discard, fresh, mix, pick, prepare, same, stored, table, trim
from tablewarden.operators.scale import small_side
from tablewarden.session import settle

SEED = 42
CONTRACT_WORDS = 3
MAX_BITS = 3
NEAR_WORDS = 5
NEAR_SIMILARITY = 0.8
# Near-duplicates: features of two words change less under edits than the five words compared.
FEATURE_WORDS = 2
WIDE_LANES = 4
LANES = [f"f{i}" for i in range(WIDE_LANES)]
NEAR_TRIPLES = 64
MIN_SHARED = 5
PARITY_LONGS = 16
SHINGLES_AT_ONCE = 1 << 15
# Digests broadcast at most, to pick the sets that are still asked for; more are joined by a shuffle.
SMALL_ENDS = 500_000
# Order of shingles: counts of buckets over a share of the texts. Any order is right, a rare-first one is fast.
RANK_BITS = 20
RANK_SHARE = 8
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# ---- fingerprints -----------------------------------------------------------------------------


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every shingle of a text with A-Z in lower case, in order and with repeats."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(parts) - k + 1)


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set if it is set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = np.ascontiguousarray(hashes[at : at + SHINGLES_AT_ONCE])
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(words: int = CONTRACT_WORDS):
    """UDF: the 64-bit fingerprint as a long."""

    @F.arrow_udf("bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        found = [majority(shingle_hashes(t, words)) for t in texts.to_pylist()]
        return pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())

    return fingerprints


def parity(hashes: np.ndarray) -> np.ndarray:
    """Of each of 1024 buckets the parity of the number of hashes in it, as longs.

    Two sets differ in at least as many members as their parities differ in bits: what both hold
    cancels out, and every other member turns one bit.
    """
    odd = np.bincount((mix(hashes) >> np.uint64(54)).astype(np.int64), minlength=64 * PARITY_LONGS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> np.uint64(64 - RANK_BITS)).astype(np.int64)


def _tallied(words: int):
    def tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << RANK_BITS, np.int64)
        for batch in batches:
            for t in batch.column("text").to_pylist():
                np.add.at(counts, bucket(np.unique(shingle_hashes(t, words))), 1)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])

    return tallies


def shingle_ranks(rows: DataFrame, words: int) -> np.ndarray:
    """Of each bucket of shingles how often it occurs in a share of the texts of ``rows`` (text)."""
    share = rows.where(F.pmod(F.xxhash64("text"), F.lit(RANK_SHARE)) == 0).select("text")
    got = share.mapInArrow(_tallied(words), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    ranks = np.zeros(1 << RANK_BITS, np.uint32)
    ranks[got.column("bucket").to_numpy()] = np.minimum(got.column("n").to_numpy(), (1 << 32) - 1)
    return ranks


def prefix(own: np.ndarray, similarity: float, ranks: np.ndarray) -> np.ndarray:
    """The rarest of a set of shingles, so many that each set so similar has one of its own rarest among them.

    A similar set shares at least ``similarity`` of this one. What is left out here is less than
    that, so the rarest shared member is in here, and by the same count in the other's.
    """
    most = len(own) - math.ceil(similarity * len(own) - 1e-6) + 1
    return own[np.lexsort((own, ranks[bucket(own)]))[:most]]


def near_sketch(words: int, similarity: float, ranks: np.ndarray | None = None, feature_words: int = FEATURE_WORDS):
    """UDF: fingerprint lanes of the set of features, parity and size of the set of shingles, with ``ranks`` its rarest members."""

    @F.arrow_udf("array<bigint>")
    def sketches(texts: pa.Array) -> pa.Array:
        rows = [np.zeros(0, np.uint64)]
        for t in texts.to_pylist():
            features, own = (np.unique(shingle_hashes(t, n)) for n in (feature_words, words))
            with np.errstate(over="ignore"):
                lanes = [majority(mix(features + np.uint64(i * 0x632BE59BD9B4E019 & (1 << 64) - 1))) for i in range(WIDE_LANES)]
                parts = [np.array(lanes, np.uint64), parity(own), np.array([len(own)], np.uint64)]
            if ranks is not None:
                parts.append(prefix(own, similarity, ranks))
            rows.append(np.concatenate(parts))
        values = np.concatenate(rows).view(np.int64)
        trim()
        return pa.ListArray.from_arrays(pa.array(np.cumsum([len(r) for r in rows]), pa.int32()), pa.array(values, pa.int64()))

    return sketches


# ---- the index --------------------------------------------------------------------------------


def quadruples() -> list[tuple[int, ...]]:
    """Fourteen of the quadruples of eight positions, such that any five positions hold one.

    Both halves are in. Five positions that hold neither half have three in one half and a pair in
    the other; pairs of a half fall into three perfect matchings, three positions hold a pair of
    each, so it suffices to join pairs of the same matching.
    """
    matchings = [[(0, 1), (2, 3)], [(0, 2), (1, 3)], [(0, 3), (1, 2)]]
    out = [(0, 1, 2, 3), (4, 5, 6, 7)]
    for pairs in matchings:
        out += [(*p, *(x + 4 for x in q)) for p in pairs for q in pairs]
    return out


def triples(positions: int, n: int) -> list[tuple[int, ...]]:
    """``n`` triples of positions that use all positions about equally and share few pairs."""
    out, seen = [], set()
    for step in itertools.count(1):
        for a in range(positions):
            t = tuple(sorted({a, (a + step) % positions, (a + 3 * step + 1) % positions}))
            if len(t) == 3 and t not in seen:
                seen.add(t)
                out.append(t)
                if len(out) == n:
                    return out


def byte_at(lanes: Sequence[Column], position: int) -> Column:
    return F.shiftrightunsigned(lanes[position // 8], position % 8 * 8).bitwiseAND(F.lit(255).cast("bigint"))


def shared_bytes(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """How many positional bytes two fingerprints share: those whose bits all agree."""
    total = F.lit(0)
    for x, y in zip(a, b, strict=True):
        folded = x.bitwiseXOR(y)
        for step in (4, 2, 1):  # the lowest bit of a byte becomes the or of all its bits
            folded = folded.bitwiseOR(F.shiftrightunsigned(folded, step))
        total = total + (F.lit(8) - F.bit_count(folded.bitwiseAND(F.lit(0x0101010101010101))))
    return total


def list_keys(lanes: Sequence[str], keys: Sequence[tuple[int, ...]]) -> Column:
    """Array of the posting lists of a fingerprint: which positions, and the bytes there."""
    cols = [F.col(c) for c in lanes]
    lists = []
    for k, positions in enumerate(keys):
        value = F.lit(k).cast("bigint")
        for p in positions:
            value = F.shiftleft(value, 8) + byte_at(cols, p)
        lists.append(value)
    return F.array(*lists)


def candidate_pairs(prints: DataFrame, lanes: list[str], keys: list[tuple[int, ...]], at_least: int) -> DataFrame:
    """Pairs ``a_*``, ``b_*`` of different fingerprints that share ``at_least`` positional bytes.

    ``prints`` has distinct fingerprints in the columns ``lanes`` (longs). Pairs are tallied where
    they meet; few are left when they are made distinct. Lists join as two plain exchanges, which
    adaptive execution splits where a list is long.
    """
    postings = prints.select(F.explode(list_keys(lanes, keys)).alias("key"), *lanes)
    left = postings.select("key", *[F.col(c).alias(f"a_{c}") for c in lanes])
    right = postings.select("key", *[F.col(c).alias(f"b_{c}") for c in lanes])
    a, b = [F.col(f"a_{c}") for c in lanes], [F.col(f"b_{c}") for c in lanes]
    before = F.lit(False)  # lexicographic a < b, so that each pair is taken in one order
    for x, y in zip(reversed(a), reversed(b), strict=True):
        before = (x < y) | ((x == y) & before)
    return left.join(right, "key").where(before & (shared_bytes(a, b) >= at_least)).drop("key").distinct()


def fingerprint_links(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of the distinct longs in column ``print`` that differ in at most ``bits`` <= 3 bits."""
    if bits > MAX_BITS:
        raise ValueError("the lists of four bytes guarantee distance 3 at most")
    pairs = candidate_pairs(prints.select("print"), ["print"], quadruples(), 8 - bits)
    a, b = F.col("a_print"), F.col("b_print")
    return pairs.where(F.bit_count(a.bitwiseXOR(b)) <= bits).select(a.alias("a"), b.alias("b"))


# ---- components -------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, component = smallest node reachable) of every node that has a link.

    Large-star and small-star steps in turn until nothing changes; every step is an aggregate with
    map-side combine and an equi-join, so a node with very many links is no group in one task.
    """
    edges = settle(links.select("a", "b").where("a <> b").distinct())
    last = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        edges = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        hung = down.join(least, "a")
        edges = settle(
            hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(hung.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(
        F.col("a").alias("node"), "component"
    ).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


# ---- operators --------------------------------------------------------------------------------


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = CONTRACT_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """id, fingerprint (long) and smallest id reachable over links of at most ``bits`` bits.

    Null and blank texts have fingerprint zero and are linked like any other; equal fingerprints are
    one node, so copies never pair. A null id is no candidate for the smallest.
    """
    prepare(docs.sparkSession)
    rows = pick(docs, id_col, text_col)
    rows = stored(rows.select("id", fingerprint(words)(F.col("text")).alias("print")), "prints")
    nodes = stored(rows.groupBy("print").agg(F.min("id").alias("root")), "nodes")
    found = components(fingerprint_links(nodes, bits))
    named = nodes.join(found, nodes["print"] == found["node"], "left").select(
        "print", "root", F.coalesce("component", "print").alias("component")
    )
    named = settle(named)
    roots = named.groupBy("component").agg(F.min("root").alias("component_id"))
    of_print = named.join(roots, "component").select(F.col("print").alias("p"), "component_id")
    return rows.join(of_print, rows["print"] == of_print["p"], "left").select(
        F.col("id").alias(id_col), F.col("print"), "component_id"
    )


def _shingle_sets(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in batch.column("text").to_pylist()]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(own, kind)], ["digest", "shingles"])
            del own
            trim()

    return sets


def posting_lists(wide: DataFrame) -> DataFrame:
    """(key, node, weight) of the lists that hold several of the fingerprints ``wide`` (node, lanes).

    A node's weight is the length of all its lists; in a group of near copies the most typical one
    has most. Lists of one node, nearly all there are, propose nothing and go before anything wide moves.
    """
    places = wide.select("node", F.explode(list_keys(LANES, triples(8 * WIDE_LANES, NEAR_TRIPLES))).alias("key"))
    long = places.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    live = stored(places.join(long, "key"), "lists")
    weights = live.groupBy("node").agg(F.sum("n").alias("weight"))
    postings = stored(live.join(weights, "node").select("key", "node", "weight"), "postings")
    discard(live)
    return postings


def to_leaders(postings: DataFrame, wide: DataFrame) -> DataFrame:
    """One pair (a, b) per node at most: with the heaviest first of its lists that shares enough bytes.

    Fingerprints meet in many lists, so pairs are made distinct before the bytes (``wide``: node, lanes) are looked up.
    """
    first = postings.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("top"))
    met = postings.join(first, "key").where(F.col("node") != F.col("top.node"))
    met = stored(met.select(F.col("node").alias("a"), F.col("top.node").alias("b"), F.col("top.weight").alias("w")).distinct(), "met")
    pairs = met
    for side in "ab":
        pairs = pairs.join(wide.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in LANES]), side)
    shared = shared_bytes([F.col(f"a_{c}") for c in LANES], [F.col(f"b_{c}") for c in LANES])
    best = pairs.where(shared >= MIN_SHARED).groupBy("a").agg(F.max(F.struct("w", "b")).alias("best"))
    leaders = stored(best.select("a", F.col("best.b").alias("b")), "leaders")
    discard(met)
    return leaders


def prefix_lists(prints: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, node, of, weight) of the lists of rarest shingles that hold nodes of several groups; see ``posting_lists``.

    ``prints`` (digest, keys) may repeat a digest; ``groups`` is (node, component) of nodes with a link,
    any other node is a group by itself. A list is known to hold several by its least and greatest
    group, so copies count once and only what is left is made distinct and counted.
    """
    known = small_side(groups.select(F.col("node").alias("digest"), "component"), SMALL_ENDS)
    places = prints.join(known, "digest", "left").select(
        F.col("digest").alias("node"), F.coalesce("component", "digest").alias("of"), F.explode("keys").alias("key")
    )
    several = places.groupBy("key").agg(F.min("of").alias("low"), F.max("of").alias("high")).where("low < high")
    several = stored(several.select("key"), "several")
    # most places go here, so the group is looked up again for those that stay
    live = prints.select(F.col("digest").alias("node"), F.explode("keys").alias("key")).join(several, "key", "left_semi")
    live = stored(live.distinct(), "lists")
    discard(several)
    long = live.groupBy("key").agg(F.count("*").alias("n"))
    weights = live.join(long, "key").groupBy("node").agg(F.sum("n").alias("weight"))
    named = known.withColumnRenamed("digest", "node")
    postings = live.join(weights, "node").join(named, "node", "left").select("key", "node", F.coalesce("component", "node").alias("of"), "weight")
    postings = stored(postings, "postings")
    discard(live)
    return postings


def allowed(similarity: float) -> Column:
    """Whether sizes and parities of a_* and b_* leave the similarity possible.

    Sets of sizes p and q that are so similar differ in (p + q)(1 - s)/(1 + s) members at most.
    """
    differ = sum((F.bit_count(F.col("a_parity")[i].bitwiseXOR(F.col("b_parity")[i])) for i in range(PARITY_LONGS)), F.lit(0))
    most = (F.col("a_size") + F.col("b_size")) * ((1 - similarity) / (1 + similarity)) + 1e-6
    return (F.abs(F.col("a_size") - F.col("b_size")) <= most) & (differ <= most)


def prefix_leaders(postings: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """One pair (a, b) per node at most: with the heaviest first of its lists that is of another group and its sketch allows."""
    first = postings.groupBy("key").agg(F.max(F.struct("weight", "node", "of")).alias("top"))
    met = postings.join(first, "key").where(F.col("of") != F.col("top.of"))
    met = stored(met.select(F.col("node").alias("a"), F.col("top.node").alias("b"), F.col("top.weight").alias("w")).distinct(), "met")
    for side in "ab":
        met = met.join(sketches.select(*[F.col(c).alias(x) for c, x in (("digest", side), ("parity", f"{side}_parity"), ("size", f"{side}_size"))]), side)
    best = met.where(allowed(similarity)).groupBy("a").agg(F.max(F.struct("w", "b")).alias("best"))
    return stored(best.select("a", F.col("best.b").alias("b")), "leaders")


def between_groups(
    postings: DataFrame, sketches: DataFrame, groups: DataFrame, similarity: float, lanes: Sequence[str] = LANES
) -> DataFrame:
    """Pairs (a, b) of nodes of different groups that share enough bytes and whose parity allows the similarity.

    ``sketches`` is (digest, parity, size, lanes), ``groups`` (node, component) of nodes with a link. Without
    ``lanes`` there are no bytes to compare.
    """
    named = groups.select(F.col("node").alias("g"), "component")
    tagged = postings.join(named, postings["node"] == named["g"], "left").select(
        "key", "node", F.coalesce("component", "node").alias("of")
    )
    mixed = tagged.groupBy("key").agg(F.min("of").alias("low"), F.max("of").alias("high")).where("low < high").select("key")
    rows = tagged.join(mixed, "key").join(sketches.withColumnRenamed("digest", "node"), "node")
    rows = stored(rows.select("key", "node", *lanes, "of", "size", "parity"), "between")
    a, b = [rows.select("key", *[F.col(c).alias(f"{side}_{c}") for c in rows.columns if c != "key"]) for side in "ab"]
    meet = (F.col("a_node") < F.col("b_node")) & (F.col("a_of") != F.col("b_of"))
    if lanes:
        meet = meet & (shared_bytes([F.col(f"a_{c}") for c in lanes], [F.col(f"b_{c}") for c in lanes]) >= MIN_SHARED)
    meet = meet & allowed(similarity)
    found = stored(a.join(b, "key").where(meet).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct(), "rest")
    discard(rows)
    return found


def shingle_sets(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(digest, shingles) of the digests in ``wanted``; of each a single row of ``texts`` is read.

    Where few are wanted they are broadcast and no text is shuffled; beyond that texts and wanted rows
    meet by a merge join.
    """
    held = nodes.join(wanted, "digest", "left_semi").select("digest", F.col("id").alias("head"), "own")
    held = small_side(stored(held, "heads"), SMALL_ENDS)
    return (
        texts.join(held, same(texts["id"], F.col("head")) & (texts["hash"] == F.col("own")))
        .select("digest", "text")
        .mapInArrow(_shingle_sets(words), "digest bigint, shingles array<bigint>")
    )


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` whose sets of shingles are so similar (Jaccard)."""
    x, y = F.col("x"), F.col("y")
    both = F.size(F.array_intersect(x, y))
    return (
        pairs.join(sets.select(F.col("digest").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("digest").alias("b"), F.col("shingles").alias("y")), "b")
        .where((F.size(x) > 0) & (both >= F.lit(similarity) * (F.size(x) + F.size(y) - both)))
        .select("a", "b")
    )


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("digest")).union(pairs.select(F.col("b").alias("digest"))).distinct()


def near_links(
    docs: DataFrame,
    nodes: DataFrame,
    words: int = NEAR_WORDS,
    similarity: float = NEAR_SIMILARITY,
    prefixes: DataFrame | None = None,
) -> DataFrame:
    """Links (a, b) of digests of different texts that join up the same groups as all proposed similar pairs do.

    ``nodes`` has one row per different text: digest, fingerprint lanes, parity
    and size of its shingles, and the ``id`` and ``own`` hash of a row of ``docs`` (id, text) that holds
    it. The index of fingerprints of two-word features proposes most similar pairs; the Jaccard
    similarity of the whole sets of ``words``-word shingles decides. Thousands of near copies of one
    text would make millions of pairs;
    so each text is first compared with the leader of its lists, and then only with texts of other
    groups, where their parities do not rule the similarity out. A proposed pair left out either is
    in one group already or cannot be similar.

    ``prefixes`` (digest, keys) has the rarest shingles of each text; it is stored and deleted after use.
    The lists of these propose every similar pair between the groups that the fingerprints made, and
    go through the same steps.
    """
    heads = nodes.groupBy(*LANES).agg(F.min("digest").alias("node"))
    heads = stored(heads, "heads")
    postings = posting_lists(heads)
    # different texts with one fingerprint meet through the first of them
    alike = nodes.join(heads, LANES).where("digest <> node").select(F.col("node").alias("a"), F.col("digest").alias("b"))
    pairs = to_leaders(postings, heads).union(alike)
    links = _joined_up(docs, nodes, postings, pairs, words, similarity, LANES)
    discard(postings)
    if prefixes is None:
        return links
    postings = prefix_lists(prefixes, components(links))
    discard(prefixes)  # the longest table of the stage; what follows reads the lists
    pairs = prefix_leaders(postings, nodes.select("digest", "parity", "size"), similarity)
    return links.union(_joined_up(docs, nodes, postings.drop("of"), pairs, words, similarity, [], links))


def _joined_up(
    docs: DataFrame,
    nodes: DataFrame,
    postings: DataFrame,
    pairs: DataFrame,
    words: int,
    similarity: float,
    lanes: Sequence[str],
    known: DataFrame | None = None,
) -> DataFrame:
    """The similar ones of ``pairs``, then those of the lists that lie between the groups these make with the ``known`` links."""
    texts = docs.withColumn("hash", F.xxhash64("text"))
    sets = stored(shingle_sets(texts, nodes, ends(pairs), words), "shingles")
    near = stored(verified(pairs, sets, similarity), "near")
    sketches = nodes.select("digest", "parity", "size", *lanes)
    groups = components(near if known is None else near.union(known))
    rest = between_groups(postings, sketches, groups, similarity, lanes)
    wanted = stored(ends(rest), "ends")
    more = wanted.join(sets.select("digest"), "digest", "left_anti")
    more = stored(shingle_sets(texts, nodes, more, words), "shingles")
    # only sets that a pair still asks for are shuffled
    held = sets.join(small_side(wanted, SMALL_ENDS), "digest", "left_semi")
    links = stored(near.union(verified(rest, held.unionByName(more), similarity)), "links")
    for done in (sets, more, rest, wanted, near):
        discard(done)
    return links


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = NEAR_WORDS,
    similarity: float = NEAR_SIMILARITY,
    complete: bool = False,
) -> DataFrame:
    """``docs`` with one row of each group of exact and near copies, the one with the smallest id.

    The index of fingerprints proposes pairs and may miss some; ``complete`` also finds all others of that similarity.

    Texts equal up to the case of A-Z and white space are copies. Rows without words are one group.
    A null id comes after all others. Of rows that repeat an id, the one whose text hashes lowest
    stays, and of wholly equal rows any one.
    """
    prepare(docs.sparkSession)
    rows = pick(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    plain = F.trim(F.regexp_replace(F.translate("text", UPPER, UPPER.lower()), "[\\x20\\x09-\\x0D]+", " "))
    sketch = near_sketch(words, similarity, shingle_ranks(rows, words) if complete else None)
    prints = rows.select("id", F.xxhash64("text").alias("own"), F.xxhash64(plain).alias("digest"), sketch(F.col("text")).alias("f"))
    held = [F.col("f")[i].alias(c) for i, c in enumerate(LANES)]
    held += [F.slice("f", WIDE_LANES + 1, PARITY_LONGS).alias("parity"), F.col("f")[WIDE_LANES + PARITY_LONGS].alias("size")]
    facts = [*LANES, "size", "parity"]
    if complete:
        held.append(F.slice("f", F.lit(WIDE_LANES + PARITY_LONGS + 2), F.size("f")).alias("keys"))
    prints = stored(prints.select("id", "own", "digest", *held), "wide")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "own")
    # the rarest shingles stay where they are: they are long and needed once
    nodes = prints.groupBy("digest").agg(F.min(place).alias("at"), F.min(F.struct(*facts)).alias("of"))
    nodes = stored(nodes.select("digest", "of.*", "at.none", "at.id", "at.own"), "nodes")
    repeated = prints.groupBy("id", "own").count().where("count > 1").limit(1).count()
    if repeated:  # rows that are wholly alike would give a text's shingles more than once
        rows = rows.dropDuplicates(["id", "text"])
    prefixes = prints.select("digest", "keys") if complete else None
    found = components(near_links(rows, nodes, words, similarity, prefixes))
    groups = nodes.join(found, nodes["digest"] == found["node"], "left")
    keep = groups.groupBy(F.coalesce("component", "digest").alias("group")).agg(F.min(place).alias("at"))
    keep = stored(keep.select(F.col("at.id").alias("keep_id"), F.col("at.own").alias("keep_own")), "keep")
    own = fresh(docs, "own")
    tagged = docs.withColumn(own, F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))))
    kept = tagged.join(keep, same(tagged[id_col], keep["keep_id"]) & (tagged[own] == keep["keep_own"]), "left_semi")
    if repeated:  # wholly repeated rows
        kept = kept.dropDuplicates([id_col, own])
    return kept.select(*docs.columns)


def op6_simhash(spark, sf_dir):
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
