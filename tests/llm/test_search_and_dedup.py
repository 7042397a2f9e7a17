"""Hard negatives, exact dedup by index and ranked search against plain versions and on edge rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewarden.llm import exact_dedup, hard_negatives, lexical_search

DOCS = "doc_id bigint, text string, lang string, id string, digest string, row string, keep_id string, n string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["clash"] * 6) for i, t in rows], DOCS)


# ---- exact dedup ------------------------------------------------------------------------------


def test_exact_dedup_edges(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "a"), (4, "A"), (5, "a "), (6, "a"), (7, LONG), (8, LONG), (None, "only without id"),
            (None, "only without id"), (None, "a"), (6, "a"), (9, "é"), (10, "é")]
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    got = exact_dedup.deduplicate(frame(spark, rows), index, "one").collect()
    assert len(got) == len(rows)
    sizes = Counter(t or "" for _, t in rows)
    by_digest = {hashlib.sha256(t.encode()).digest(): t for t in sizes}
    kept = Counter()
    for r in got:
        t = by_digest[bytes(r.digest)]
        ids = [i for i, x in rows if (x or "") == t and i is not None]
        assert r.group_size == sizes[t] and r.keep_id == max(ids, default=None) and not r.known
        assert not r.kept or r.doc_id == r.keep_id
        kept[t] += r.kept
    assert set(kept.values()) == {1}
    assert index.entries().count() == len(sizes)
    assert exact_dedup.deduplicate(frame(spark, []), index, "none").count() == 0
    assert index.entries().count() == len(sizes)


def test_exact_dedup_over_batches(spark, tmp_path):
    folder = str(tmp_path / "index")
    first = exact_dedup.DigestIndex(spark, folder, 4)
    exact_dedup.deduplicate(frame(spark, [(1, "a"), (2, "b"), (5, "a")]), first, "one").collect()
    first.close()
    again = exact_dedup.DigestIndex(spark, folder, 99)  # an index keeps its number of buckets
    assert again.buckets == 4 and again.entries().count() == 2

    def decisions(rows, batch):
        found = exact_dedup.deduplicate(frame(spark, rows), again, batch).collect()
        return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.known) for r in found}

    second = [(7, "a"), (3, "c"), (4, "c")]
    want = {7: (5, 1, False, True), 3: (4, 2, False, False), 4: (4, 2, True, False)}
    assert decisions(second, "two") == want
    assert decisions(second, "two") == want  # run again: the same decisions, nothing appended
    assert again.entries().count() == 3
    assert decisions([(9, "c")], "three") == {9: (4, 1, False, True)}


def test_index_is_not_shuffled(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    new = spark.createDataFrame([(b"x",)], "digest binary").repartition(4, "digest")
    joined = new.join(index.entries().hint("merge"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("FileScan") - 400 :]
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Exchange" not in side[400:]


# ---- ranked search ----------------------------------------------------------------------------

TERM = re.compile(lexical_search.TERM)


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans(lexical_search.UPPER, lexical_search.LOWER)))


def ranked(docs, item, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for i, c, n in held:
        m = 100 - 75 + (75 * n * n_docs) // n_terms
        score = 0
        for t in terms(item):
            if c[t]:
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
        if score > 0:
            out.append((-score, i is None, i or 0, i))
    return [(r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(out)[:k])]


@pytest.mark.parametrize("passes", [500_000, 3])
def test_search(spark, monkeypatch, passes):
    monkeypatch.setattr(lexical_search, "PASS_TERMS", passes)
    rng = np.random.default_rng(8)
    pool = ["Alpha", "beta", "ГАММА", "гамма", "δ5", "x", "12", "λόγος", "ß", "漢字", "é", "É", "zz-top", "a_b"]
    docs = [(i, " ".join(rng.choice(pool, rng.integers(0, 30)))) for i in range(120)]
    docs += [(200 + i, "alpha beta x x 漢字") for i in range(40)]  # many equal scores
    docs += [(300, None), (301, ""), (302, "-- \n"), (None, "alpha alpha 漢字 漢字"), (303, LONG + " δ5 alpha"), (7, docs[7][1])]
    items = [(1, "alpha BETA alpha"), (2, "漢字 δ5 x"), (3, "nowhere"), (4, None), (5, ""), (6, " ".join(pool)), (6, "λόγος ß"), (None, "É é"), (1, "alpha BETA alpha")]
    bench = spark.createDataFrame(items, "item_id int, text string").withColumns({"id": F.lit(0), "term": F.lit("t"), "doc_id": F.lit(1)})
    got = lexical_search.search(frame(spark, docs), bench).collect()
    want = {(i, *r) for i, t in items for r in ranked(docs, t)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_search_of_nothing(spark):
    docs, none = frame(spark, [(1, "alpha")]), frame(spark, [])
    bench = spark.createDataFrame([(1, "alpha"), (2, None)], "item_id int, text string")
    assert lexical_search.search(none, bench).count() == 0
    empty = lexical_search.search(docs, bench.where("item_id = 2"))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
    assert [tuple(r) for r in lexical_search.search(docs, bench).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]


@pytest.mark.parametrize("seed", range(4))
def test_block_search(seed):
    """Best-first search of one block after another gives what all scores sorted give."""
    rng = np.random.default_rng(seed)
    n_terms, best, every = 12, (np.zeros(0, np.int64), np.zeros(0, np.int64)), []
    asked, times = np.array([0, 3, 5, 11]), np.array([1, 2, 1, 3])
    weights = rng.integers(0, 3, n_terms) * 100  # some weigh nothing, many scores are equal
    for block in range(3):
        ids = rng.permutation(900)[:300] + 1000 * (2 - block)
        held = [np.unique(rng.integers(0, n_terms, rng.integers(0, 9))) for _ in ids]
        counts = [rng.integers(1, 3, len(h)) for h in held]
        lengths = np.array([len(h) for h in held])
        n = np.full(len(ids), 10)
        flat = np.concatenate(held).astype(np.int64)
        b = lexical_search.Block(ids, n, lengths, flat, np.concatenate(counts), weights, 900, 9000)
        best = b.search(asked, times, best, 10)
        for i, h, c in zip(ids, held, counts, strict=True):
            found = dict(zip(h.tolist(), c.tolist(), strict=True))
            m = 25 + 75 * 10 * 900 // 9000
            s = sum(int(weights[t] * x * (10**9 * found[t] // (1000 * found[t] + 8 * m))) for t, x in zip(asked, times, strict=True) if t in found)
            every.append((-s, int(i)))
    want = [(-s, i) for s, i in sorted(every)[:10] if s < 0]
    assert list(zip(best[0].tolist(), best[1].tolist(), strict=True)) == want


# ---- hard negatives ---------------------------------------------------------------------------


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_hilbert_curve(dims, bits):
    """The curve visits every cell once, each beside the one before."""
    axes = np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")
    cells = np.stack([a.ravel() for a in axes], axis=1)
    keys = hard_negatives.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for scale in (300, 10**8):
        a, v = rng.integers(-scale, scale, (20, 7)), rng.integers(-scale, scale, (50, 7))
        least, most = hard_negatives.bounds(a, v.min(0)[None], v.max(0)[None])
        scores = a @ v.T
        assert (least <= scores).all() and (scores <= most).all()
        assert (hard_negatives.products(a, v) == scores).all()


def mined(rows, positives=5, negatives=3):
    good = [(i, lab, v) for i, lab, v in rows if i is not None and lab is not None and v is not None and None not in v]
    out = set()
    for a, la, va in {(i, lab, tuple(v)) for i, lab, v in good if i % 50 == 0}:
        score = lambda v, va=va: sum(x * y for x, y in zip(va, v, strict=False))
        best = sorted((-score(v), i) for i, lab, v in good if lab == la and i != a)[:positives]
        others = sorted((-score(v), i) for i, lab, v in good if lab != la)
        for p, pid in best:
            found = [(-s, i) for s, i in others if 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out |= {(a, pid, r + 1, i, -p, s) for r, (s, i) in enumerate(found)}
    return out


@pytest.mark.parametrize(("seed", "block_rows", "sweep_bytes"), [(0, 16, 1 << 20), (1, 7, 400), (2, 512, 1 << 20)])
def test_mining(spark, seed, block_rows, sweep_bytes):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-60, 60, (6, 8))
    rows = [(i, int(rng.integers(4)), (centres[i % 6] + rng.integers(-25, 25, 8)).tolist()) for i in range(400)]
    hot = rows[3][2]
    rows += [(1000 + i, i % 3, hot) for i in range(120)]  # copies of one vector, anchors among them
    rows += [(450, 2, [1, 2]), (451, 2, []), (452, None, hot), (453, 1, None), (None, 1, hot), (454, 1, [*hot[:7], None])]
    rows += [(500, 1, [0] * 8), (550, 3, [-x for x in hot]), (600, 9, hot)]
    df = spark.createDataFrame(rows, "id bigint, label int, vector array<bigint>").withColumns({"key": F.lit(1), "block": F.lit(2)})
    got = hard_negatives.mine(df, F.col("id") % 50 == 0, block_rows=block_rows, sweep_bytes=sweep_bytes).collect()
    want = mined(rows)
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 50


def test_mining_of_little(spark):
    kind = "id bigint, label int, vector array<bigint>"
    anchor = F.col("id") % 50 == 0
    assert hard_negatives.mine(spark.createDataFrame([], kind), anchor).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(1, 1, [1]), (2, 2, [1])], kind), anchor).count() == 0
    alone = hard_negatives.mine(spark.createDataFrame([(50, 1, [2]), (2, 2, [1])], kind), anchor)
    assert alone.count() == 0
    far = [(50, 1, [3 * 10**8, 1]), (1, 1, [3 * 10**8, 1]), (2, 2, [2 * 10**8, 5]), (3, 2, [2 * 10**8, 6])]
    got = hard_negatives.mine(spark.createDataFrame(far, kind), anchor).orderBy("rank").collect()
    assert [(r.negative_id, r.negative_score) for r in got] == [(3, 6 * 10**16 + 6), (2, 6 * 10**16 + 5)]


def test_whole_numbers(spark):
    rows = [([0.5, -0.001],), ([float("nan"), 1.0],), ([1.0, None],), ([float("-inf")],), (None,), ([],)]
    df = spark.createDataFrame(rows, "v array<float>").select(hard_negatives.whole_numbers(F.col("v")).alias("w"))
    assert [r.w for r in df.collect()] == [[128, -1], None, None, None, None, []]
