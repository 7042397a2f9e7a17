"""Personal data: generators propose overlapping spans, boosted trees choose among them.

Exact patterns give the base spans, which always stay. Generators propose much more: addresses
written around (``name (at) host (dot) org``), number chains with any separators. Trees, one set per
kind, score each candidate by its format and its context; a candidate above the kind's threshold
that overlaps no span already taken is added.

The trees learn from all the corpus' own candidates. A base match is a positive of
its kind; a candidate that fails the checks (Luhn, range, number of digits) is a negative. Each is
also rewritten in other formats, with its label, since the exact patterns know only one format.
Candidates with the same features are one row with its counts; the rows stay on the executors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.boosting import BINS, SCORE_PARTS, Block, Label, Trees, binned, boost_blocks, score_tally, start_of, threshold
from tablewarden.llm.common import discard, pick, prepare, stored, table

KINDS = ["email", "ip", "card", "phone"]
# Of so many texts one is kept back to calibrate the thresholds.
HELD = 3
# Distinct rows of features in a block, and those that are worth a task of their own.
BLOCK_ROWS, TASK_ROWS = 1 << 14, 1 << 16
PRECISION = 0.98
SUPPORT = 40
# Least certainty of an added span; without support for a calibration a fixed one, and so many positives to a negative.
LEAST_SURE = 0.5
FEW_SURE = 0.9
FEW_SHARE = 0.25
CONTEXT = 24
MASKS = {k: f"[{k.upper()}]" for k in KINDS}

# ---- base patterns ----------------------------------------------------------------------------

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run that fails at its first digit fails at every later one: start at the first only.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether every second digit doubled from the right gives a digit sum divisible by ten."""
    total = sum(map(int, digits[-1::-2]))
    for d in map(int, digits[-2::-2]):
        total += 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from each @ outwards, so that a long word without one is never searched."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind as an index of ``KINDS``, end), in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# ---- candidates -------------------------------------------------------------------------------

WRITTEN_AT = re.compile(r"\s?(?:@|\(at\)|\[at\])\s?", re.I)
WRITTEN_DOT = re.compile(r"\s?(?:\(dot\)|\[dot\]|\[\.\])\s?", re.I)
HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\s?(?:\(dot\)|\[dot\]|\[\.\])\s?)[A-Za-z0-9-]+)*+", re.I)
CHAIN = re.compile(r"(?<![0-9])(?:\+ ?|00(?=[1-9]))?\(?[0-9]++(?:[ .\-/()\[\]_]{1,3}[0-9]++)*+")
# An address, card or phone has so many digits; each start of a run in a chain has as few ends.
LEAST_DIGITS, MOST_DIGITS = 4, 19
PART = -2
MAYBE = re.compile(r"[0-9@]|[(\[]at[)\]]", re.I)

# Words near a span that say what it is.
CUES = {
    "email": ["mail", "email", "contact", "write", "address", "courriel", "correo"],
    "ip": ["ip", "host", "server", "address", "port", "ping", "network"],
    "card": ["card", "visa", "mastercard", "amex", "credit", "payment", "cc", "karte", "carte", "tarjeta"],
    "phone": ["tel", "phone", "call", "fax", "mobile", "cell", "whatsapp", "telefon", "telephone"],
    "other": ["order", "invoice", "version", "isbn", "id", "no", "nr", "token", "key", "ref", "item"],
}
WORD = re.compile(r"[A-Za-z]+")
GROUPS = re.compile("[0-9]+")


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that may be personal data, overlapping as they come.

    Addresses end where their pattern does, however long; what is searched for one is not searched again.
    """
    out = []
    for m in WRITTEN_AT.finditer(text):
        start = m.start()
        while start > 0 and text[start - 1] in LOCAL:
            start -= 1
        host = HOST.match(text, m.end())
        if host and start < m.start():
            out.append((start, host.end()))
    for m in CHAIN.finditer(text):
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in GROUPS.finditer(m[0])]
        if sum(b - a for a, b in groups) < LEAST_DIGITS:
            continue
        for i in range(len(groups)):  # every run of groups, so a number beside another one is proposed too
            digits, start = 0, groups[i][0] if i else m.start()
            for a, b in groups[i:]:
                digits += b - a
                if digits > MOST_DIGITS:
                    break
                if digits >= LEAST_DIGITS:
                    out.append((start, b))
    return out


FEATURES = 27


def features(text: str, start: int, end: int) -> list[float]:
    span = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = [len(g) for g in GROUPS.findall(span)]
    digits = NOT_DIGIT.sub("", span)
    parts = GROUPS.findall(span)
    near = {w.lower() for w in WORD.findall(before)} | {w.lower() for w in WORD.findall(after)[:2]}
    return [
        len(span),
        len(digits),
        sum(c.isalpha() for c in span),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        groups[0] if groups else 0,
        groups[-1] if groups else 0,
        span.count("."),
        span.count("-"),
        span.count(" "),
        span.count("/") + span.count("_"),
        span.count("(") + span.count("["),
        span.startswith("+"),
        span.startswith("00"),
        bool(WRITTEN_AT.search(span)),
        len(WRITTEN_DOT.findall(span)),
        bool(re.search(r"[A-Za-z]{2,}$", span)),
        14 <= len(digits) <= 19 and luhn(digits),
        len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts),
        before[-1:].isalnum(),
        after[:1].isalnum(),
        before[-1:] in ("=", '"', "'", "$", "#"),
        *[any(c in near for c in CUES[k]) for k in ("email", "phone", "card", "other")],
    ]


def rewritten(span: str, kind: int) -> list[str]:
    """The same data in formats that the exact patterns do not know."""
    if kind == 0:
        return [span.replace("@", " (at) ").replace(".", " (dot) "), span.replace("@", "[at]").replace(".", "[dot]")]
    if kind == 1:
        return [span.replace(".", "[.]"), span.replace(".", "-")]
    if kind == 2:
        digits = NOT_DIGIT.sub("", span)
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".".join(fours), "/".join(fours), "  ".join(fours)]
    return [re.sub(r"^\+", "00", span), re.sub(r"[ ()]+", "/", span)]


def may_be(span: str) -> bool:
    """Whether a span beside no base match passes for a card all the same, by its check digit and groups."""
    size = [len(g) for g in GROUPS.findall(span)]
    even = len(size) == 1 or (set(size[:-1]) == {4} and size[-1] <= 4) or (len(size) == 3 and size[:2] == [4, 6])
    return even and 14 <= sum(size) <= 19 and luhn(NOT_DIGIT.sub("", span))


def examples(text: str) -> Iterator[tuple[list[float], int]]:
    """Features and kind (-1: none, PART: a piece of a match or more than it) of the candidates, as they are and rewritten."""
    base = base_spans(text)
    exact = {(a, b): k for a, k, b in base}
    for a, b in dict.fromkeys(candidates(text)):
        kind = exact.get((a, b), -1)
        if kind < 0 and may_be(text[a:b]):
            continue  # a good number that stands beside another one is neither
        if kind < 0 and any(x < b and a < y for x, _, y in base):
            yield features(text, a, b), PART
            continue
        yield features(text, a, b), kind
        forms = rewritten(text[a:b], kind) if kind >= 0 else []
        if kind < 0 and text[a:b].count(".") == 3:
            forms = rewritten(text[a:b], 1)
        elif kind < 0 and len(NOT_DIGIT.sub("", text[a:b])) >= 14:
            forms = rewritten(text[a:b], 2)
        for form in forms:
            other = text[max(0, a - CONTEXT) : a] + form + text[b : b + CONTEXT]
            at = min(a, CONTEXT)
            whole = (at, at + len(form))
            yield features(other, *whole), kind
            if kind >= 0:
                for u, v in candidates(other):
                    if u < whole[1] and at < v and (u, v) != whole and not may_be(other[u:v]):
                        yield features(other, u, v), PART


# ---- model ------------------------------------------------------------------------------------


@dataclass
class Model:
    trees: list[Trees | None]
    least: list[float]  # calibrated threshold of each kind

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        if not MAYBE.search(text) or not any(t for t in self.trees):
            return []
        taken = [(a, b) for a, _, b in base]
        spans = [(a, b) for a, b in dict.fromkeys(candidates(text)) if not any(x < b and a < y for x, y in taken)]
        if not spans:
            return []
        x = np.array([features(text, a, b) for a, b in spans], float)
        scored = []
        for kind, (trees, least) in enumerate(zip(self.trees, self.least, strict=True)):
            if trees:
                p = trees.probability(x)
                scored += [(-p[i], *spans[i], kind) for i in np.flatnonzero(p >= least)]
        out = []
        for _, a, b, kind in sorted(scored):  # the surest first
            if not any(u < b and a < v for u, v in taken):
                taken.append((a, b))
                out.append((a, kind, b))
        return out


# How many of the examples with the same features are of each kind.
OF = {k: f"n_{name}" for k, name in zip(range(PART, len(KINDS)), ["part", "none", *KINDS], strict=True)}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter[tuple] = Counter()
        for text, held in zip(batch.column("text").to_pylist(), batch.column("held").to_pylist(), strict=True):
            seen.update((tuple(map(int, f)), held, kind) for f, kind in examples(text))
        if seen:
            f, held, kind = zip(*seen, strict=True)
            n, kind = np.fromiter(seen.values(), np.int64, len(seen)), np.array(kind)
            parts = [pa.array(f, pa.list_(pa.int32())), pa.array(held, pa.bool_()), *[pa.array(n * (kind == k)) for k in OF]]
            yield pa.RecordBatch.from_arrays(parts, ["features", "held", *OF.values()])


def counted_examples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(features, held, one count for each kind) of all examples; ``held``: of a text that is kept back."""
    rows = docs.select(docs[text_col].cast("string").alias("text")).where(F.col("text").rlike("[0-9@]|[(\\[](at|AT)[)\\]]"))
    rows = rows.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0)
    schema = ", ".join(["features array<int>", "held boolean", *[f"{c} bigint" for c in OF.values()]])
    return rows.mapInArrow(_counted, schema).groupBy("features", "held").agg(*[F.sum(c).alias(c) for c in OF.values()])


def bin_edges(found: DataFrame) -> list[np.ndarray]:
    """Of each feature the quantiles of its values, those of every kind, so that a rare kind has its own."""
    values = found.select(F.posexplode("features").alias("feature", "value"), *OF.values())
    values = values.groupBy("feature", "value").agg(*[F.sum(c).alias(c) for c in OF.values()])
    at = F.lit(np.linspace(0, 1, BINS)[:-1].tolist())
    edges = [np.zeros(1)] * FEATURES
    for row in values.groupBy("feature").agg(*[F.percentile("value", at, F.col(c)).alias(c) for c in OF.values()]).collect():
        edges[row.feature] = np.unique(np.concatenate([row[c] or [] for c in OF.values()]))
    return edges


def _joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together as long as they hold ``rows`` at most."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if waiting and sum(map(len, waiting)) + len(batch) > rows:
            yield pa.Table.from_batches(waiting)
            waiting = []
        waiting.append(batch)
    if waiting:
        yield pa.Table.from_batches(waiting)


def _blocks(edges: Sequence[np.ndarray], rows: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _joined(batches, rows):
            x = part.column("features").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
            counts = np.stack([part.column(c).to_numpy() for c in OF.values()])
            held = np.array(part.column("held").to_pylist(), bool)
            packed = [pa.array([a.tobytes()], pa.binary()) for a in (binned(x, edges), counts, held)]
            yield pa.RecordBatch.from_arrays(packed, ["bins", "counts", "held"])

    return blocks


def example_blocks(found: DataFrame, rows: int, edges: Sequence[np.ndarray], at_once: int = BLOCK_ROWS) -> RDD:
    """The examples (``rows`` of them) as ``Block``s with one label for each kind, kept for many passes."""
    packed = found.coalesce(math.ceil(rows / TASK_ROWS)).mapInArrow(_blocks(edges, at_once), "bins binary, counts binary, held binary").rdd

    def block(row) -> Block:
        held = np.frombuffer(row.held, bool)
        counts = np.frombuffer(row.counts, np.int64).reshape(len(OF), len(held))
        bins = np.frombuffer(row.bins, np.uint8).reshape(FEATURES, len(held))
        return Block(bins, counts.sum(0), counts[-len(KINDS) :], held)

    return packed.map(block).persist(StorageLevel.MEMORY_AND_DISK)


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Fit trees and thresholds on all candidates of all texts.

    A third of the texts is held back to calibrate the thresholds. A kind with too few examples for
    that is fitted on all of them, repeated, and has a fixed threshold; one without any adds nothing.
    """
    prepare(docs.sparkSession)
    found = stored(counted_examples(docs, text_col), "examples")
    n = {(r.held, k): r[c] for r in found.groupBy("held").agg(*[F.sum(c).alias(c) for c in OF.values()]).collect() for k, c in OF.items()}
    of = lambda k: (n.get((False, k), 0), n.get((True, k), 0))
    total = [sum(of(k)[side] for k in OF) for side in (0, 1)]
    labels, starts = {}, []
    for k in range(len(KINDS)):
        fit, held = of(k)
        hits = fit + held
        if not hits or hits == sum(total):  # nothing to tell apart
            continue
        if fit < SUPPORT or held < SUPPORT // 2:
            weight = math.ceil(FEW_SHARE * (sum(total) - hits) / hits)
            labels[k] = Label(k, weight, all_rows=True)
            starts.append(start_of(weight * hits, sum(total) + (weight - 1) * hits))
        else:
            labels[k] = Label(k)
            starts.append(start_of(fit, total[0]))
    trees: list[Trees | None] = [None] * len(KINDS)
    least = [float("inf")] * len(KINDS)
    if labels:
        edges = bin_edges(found)
        blocks = example_blocks(found, found.count(), edges)
        grown = boost_blocks(blocks, list(labels.values()), starts, edges)
        tally = score_tally(blocks, list(labels.values()), grown)
        blocks.unpersist()
        for (k, label), model, counts in zip(labels.items(), grown, tally, strict=True):
            trees[k] = model.on(edges)
            least[k] = FEW_SURE
            if not label.all_rows:
                part = np.flatnonzero(counts[:, 1])
                hits, rows = counts[part].T
                least[k] = max(LEAST_SURE, threshold(part / SCORE_PARTS, hits, PRECISION, SUPPORT // 2, rows))
    discard(found)
    return Model(trees, least)


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def spans_of(text: str | None, model: Model) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, whether base) of all spans of a text, in order."""
    if not text:
        return []
    base = base_spans(text)
    return sorted([(*s, True) for s in base] + [(*s, False) for s in model.added(text, base)])


def find_spans(model: Model):
    @F.arrow_udf(SPANS)
    def found(texts: pa.Array) -> pa.Array:
        rows = [[(KINDS[k], a, b, base) for a, k, b, base in spans_of(t, model)] for t in texts.to_pylist()]
        return pa.array([[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in row] for row in rows], SPAN_TYPE)

    return found


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and spans (kind, start, end, base) of each row, by start and kind; code points, end exclusive.

    Null and empty texts have none; repeated rows are treated alike.
    """
    prepare(docs.sparkSession)
    return pick(docs, id_col, text_col).select(F.col("id").alias(id_col), find_spans(model)(F.col("text")).alias("spans"))


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans by their first.

    Null texts stay null. All other columns stay as they are.
    """
    prepare(docs.sparkSession)

    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            parts, at = [], 0
            for a, k, b, _ in spans_of(text, model):
                if a >= at:
                    parts += [text[at:a], MASKS[KINDS[k]]]
                at = max(at, b)
            out.append(text if not parts else "".join(parts) + text[at:])
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, masked(docs[text_col].cast("string")))


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def op1_pii_boosting(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = detect(docs, train(docs))
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda k: F.filter(base, lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("bigint").alias("n_added"),
    )
