"""Plain versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import regex
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def repeated(rows, size):
    """doc rows (id, text) -> for each row a list of marks, one for each word."""
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        out.append(gone)
    return out


def substring_rows(rows, size=13):
    out = []
    for (i, text), gone in zip(rows, repeated(rows, size), strict=True):
        kept = " ".join(w for w, g in zip(words(text), gone, strict=True) if not g)
        out.append((i, len(gone), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def jaccard(a, b):
    """Weighted Jaccard index of two bags."""
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def bag(text, size=5):
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1)))


def least_reachable(nodes, links):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_classes(rows, similarity=0.8):
    """doc rows (id, text) with distinct ids -> class of each id."""
    bags = {i: bag(text) for i, text in rows if i is not None}
    by_shingle = {}
    for i, b in bags.items():
        for shingle in b:
            by_shingle.setdefault(shingle, set()).add(i)
    pairs = {(i, j) for ids in by_shingle.values() for i in ids for j in ids if i < j}
    links = [(i, j) for i, j in pairs if jaccard(bags[i], bags[j]) >= similarity]
    return least_reachable(bags, links)


def base_counts(text):
    text = text or ""
    w = words(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    n_words, n_repeat = len(w), len(covered)
    return (
        n_words,
        sum(map(len, w)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        n_repeat,
        n_words < 50 or 100 * n_repeat > 50 * n_words,
    )


def spark_hash(*values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode(), h)
    return h


def units(text):
    return regex.findall(r"\p{L}+|\p{N}+|[^\p{L}\p{N} \t\n\x0b\f\r]+", text or "")


def grams(text, buckets=1 << 16):
    u = units(text)
    return [spark_hash(x) % buckets for x in u] + [
        spark_hash(a, b) % buckets for a, b in zip(u, u[1:], strict=False)
    ]


def ratios(docs, good, buckets=1 << 16):
    """Weights of the buckets, for doc rows (id, text) and the ids of trusted documents."""
    raw, target = Counter(), Counter()
    for i, text in docs:
        g = grams(text)
        raw.update(g)
        if i in good:
            target.update(g)
    all_raw, all_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    return [math.log((target[b] + 1) / all_target) - math.log((raw[b] + 1) / all_raw) for b in range(buckets)]


def score(text, weights):
    g = grams(text)
    return sum(weights[b] for b in g) / len(g) if g else 0.0


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# -- importance resampling -------------------------------------------------------------

FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, size):
    """All runs of 1 to ``size`` words, and the number of words."""
    w = FEATURE_WORD.findall(low(text))
    return [" ".join(w[i : i + k]) for k in range(1, size + 1) for i in range(len(w) - k + 1)], len(w)


def resampled(docs, target, size=1, buckets=10_000, seed=2024, least_words=20, percent=10):
    """doc rows (id, text) -> rows (id, features, weight, score, rank)."""

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    found = [(i, *features(text, size)) for i, text in docs]
    s = Counter(bucket(f) for _, fs, _ in found for f in fs)
    t = Counter(bucket(f) for text in target for f in features(text, size)[0])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for i, fs, words in found:
        weight, score = sum(gain[bucket(f)] for f in fs), None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(fs), weight, score, None, words])
    usable = sorted((r for r in rows if r[5] >= least_words and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for place, row in enumerate(usable[: len(usable) * percent // 100]):
        row[4] = place + 1
    return [tuple(r[:5]) for r in rows]


# -- Katz backoff ----------------------------------------------------------------------


class Katz:
    """doc rows (id, text, learn); probabilities by the definition."""

    def __init__(self, rows, order):
        self.order = order
        self.texts = [(i, words(low(text)) + ["</s>"], learn) for i, text, learn in rows]
        self.grams = [None] + [Counter() for _ in range(order)]
        for _, w, learn in self.texts:
            for k in range(len(w) if learn else 0):
                for n in range(1, order + 1):
                    self.grams[n][tuple((["<s>"] * (order - 1) + w)[k + order - n : k + order])] += 1
        self.d = [None] + [self.discounts(Counter(self.grams[n].values())) for n in range(1, order + 1)]
        self.followers = [None] + [{} for _ in range(order)]
        for n in range(1, order + 1):
            for gram, c in self.grams[n].items():
                self.followers[n].setdefault(gram[:-1], {})[gram[-1]] = c
        self.tokens, self.kinds = sum(self.grams[1].values()), len(self.grams[1])
        self.memory = {}

    @staticmethod
    def discounts(n):
        for most in (5, 4, 3, 2):
            if all(n[r] for r in range(1, most + 1)) and (most + 1) * n[most + 1] < n[1]:
                common = (most + 1) * n[most + 1] / n[1]
                d = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, most + 1)]
                if all(0 < x < 1 for x in d):
                    return [0.0, *d, *[1.0] * (5 - most)]
        return [0.0, *((r - 0.5) / r for r in range(1, 6))]

    def kept(self, n, c):
        return c * (self.d[n][c] if c <= 5 else 1)

    def weighed(self, n, context):
        if (n, context) not in self.memory:
            by = self.followers[n].get(context, {})
            total, lost = sum(by.values()), sum(c - self.kept(n, c) for c in by.values())
            if not total and n > 1:
                self.memory[n, context] = by, 1, 1.0
            else:
                if not lost:
                    lost, total = 1, total + 1
                rest = 1 - sum(self.p(n - 1, context[1:], w) for w in by) if n > 1 else 1
                self.memory[n, context] = by, total, lost / total / rest
        return self.memory[n, context]

    def p(self, n, context, word):
        by, total, backoff = self.weighed(n, context)
        if by.get(word):
            return self.kept(n, by[word]) / total
        return backoff if n == 1 else backoff * self.p(n - 1, context[1:], word)

    def rows(self):
        for i, w, learn in self.texts:
            padded = ["<s>"] * (self.order - 1) + w
            base = [(self.grams[1][(x,)] + 0.5) / (self.tokens + 0.5 * (self.kinds + 1)) for x in w]
            logs = [math.log10(self.p(self.order, tuple(padded[k : k + self.order - 1]), x)) for k, x in enumerate(w)]
            known = sum(self.grams[1][(x,)] > 0 for x in w)
            yield i, not learn, len(w), known, self.tokens, sum(map(math.log10, base)), sum(logs)


# -- collocations ----------------------------------------------------------------------


def collocations(rows, longest=3, least=10, percent=50, first=2000):
    """doc rows (lang, text) -> rows (lang, rank, phrase, a, l, r, n, score)."""
    f = {}
    for lang, text in rows:
        count = f.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                count.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        n = sum(c for p, c in count.items() if len(p) == 1)
        phrases = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        longer = {}
        for p, a in phrases.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer.get(p[i : i + k], 0), a)
        scored = []
        for p, a in phrases.items():
            if 100 * longer.get(p, 0) >= percent * a:
                continue
            cuts = [(10**6 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)
