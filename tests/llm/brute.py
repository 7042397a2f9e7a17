"""Plain versions of the dealt operators, text by text, to compare with."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import sentencepiece
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def base_pii(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, f"email:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, f"ip:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        double = sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 14 <= len(d) <= 19 and (double + sum(d[-1::-2])) % 10 == 0:
            out.append((m.start(), 2, f"card:{m.start()}:{m.end()}"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, f"phone:{m.start()}:{m.end()}"))
    out.sort()
    return Counter(k for _, k, _ in out), hashlib.sha256(",".join(s for *_, s in out).encode()).hexdigest(), [s for *_, s in out]


def quality(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    n, rep = len(w), len(covered)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, rep, n < 50 or 100 * rep > 50 * n)


def dup_chars(text, k):
    w = words(text)
    grams = Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    covered = {j for i in range(len(w) - k + 1) if grams[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}
    return sum(len(w[j]) for j in covered)


def simhash(text):
    w = words((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_components(prints):
    """{id: fingerprint} to {id: smallest id reachable} over links of three bits."""
    values = sorted(set(prints.values()))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 3:
            parent[find(a)] = find(b)
    least = {}
    for i, v in prints.items():
        least[find(v)] = min(i, least.get(find(v), i))
    return {i: least[find(v)] for i, v in prints.items()}


def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def substring(texts, window=20):
    """{id: text} to {id: (n_words, n_removed, kept text)}."""
    first, split = {}, {i: words(t) for i, t in texts.items()}
    for i in sorted(split):
        for s in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][s : s + window]), (i, s))
    out = {}
    for i, w in split.items():
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] != (i, s):
                gone.update(range(s, s + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def token_counts(texts, model):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    return [len(library.encode(t or "")) for t in texts]


def near_groups(texts, k=5, similarity=0.8):
    """{id: text} to the ids that stay: the smallest of each group of exact and near copies."""
    sets = {}
    for i, t in texts.items():
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = frozenset(tuple(w[j : j + min(k, len(w))]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    parent = {i: i for i in texts}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    empty = [i for i, s in sets.items() if not s]
    pairs = set(zip(empty, empty[1:]))
    shared = Counter(p for ids in by.values() for p in itertools.combinations(ids, 2))
    pairs |= {(a, b) for (a, b), n in shared.items() if n >= similarity * (len(sets[a]) + len(sets[b]) - n)}
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {find(i) for i in texts}
