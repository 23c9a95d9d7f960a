"""Plain versions of the operators for small inputs."""

import math
import re
from collections import Counter, defaultdict

import xxhash

from topicpulse.llm.substring_dedup import Paragraphs

BLANK = " \t\n\x0b\x0c\r"


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def simhash(t, size):
    w = words(lower(t or ""))
    if not w:
        return 0
    parts = [" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, near):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and near(a, b):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_duplicates(docs, size=4, radius=4):
    fp = {i: simhash(t, size) for i, t in docs}
    return fp, components(list(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= radius)


def line_dedup(docs, need):
    """docs sorted by id, texts not null; the text of each after the deletions."""
    first, runs, all_lines = {}, [], {}
    for i, t in docs:
        lines = [(k, x) for k, x in enumerate(t.split("\n")) if x.strip(BLANK)]
        all_lines[i] = lines
        for k in range(len(lines)):
            n, m = 0, 0
            while k + m < len(lines) and n < need:
                n, m = n + len(words(lines[k + m][1])), m + 1
            if n >= need:
                key = tuple(x for _, x in lines[k:k + m])
                if key in first:
                    runs.append((i, k, m, first[key]))
                else:
                    first[key] = (i, k)
    gone = defaultdict(set)
    for i, k, m, (j, q) in runs:
        a, b = all_lines[i][k + m:k + m + need - 1], all_lines[j][q + m:q + m + need - 1]
        more = 0
        while more < min(len(a), len(b)) and a[more][1] == b[more][1]:
            more += 1
        gone[i].update(all_lines[i][x][0] for x in range(k, k + m + more))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in docs}


def similar(docs):
    """docs: (id, text); the smallest id reachable over a Jaccard similarity of 0.8 of 5-word shingles."""
    sets = {}
    for i, t in docs:
        w = words(lower(t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return components(sorted(sets), lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]))


def passages(docs):
    """docs sorted by id; the removed (line, first, end) spans of each."""
    found, sets = [], {}
    for i, t in docs:
        p = Paragraphs([t], {})
        for s, node in zip(p.spans, p.nodes()):
            found.append((i, s[1], s[2], s[3], node))
            if s[5]:
                sets[node] = set(p.set_of(s).tolist())
    group = components(sorted(sets), lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]))
    head, out = {}, defaultdict(set)
    for i, line, a, b, node in sorted(found):
        g = group.get(node, node)
        if g not in head:
            head[g] = (i, line, a, b)
        h = head[g]
        if (i, line, a, b) > h and not ((i, line) == h[:2] and a < h[3]):
            out[i].add((line, a, b))
    return out


def cut(t, spans):
    lines = []
    for k, line in enumerate(t.split("\n")):
        own = [(a, b) for x, a, b in spans if x == k]
        if own:
            line = " ".join(w for n, w in enumerate(words(line)) if not any(a <= n < b for a, b in own))
            if not line:
                continue
        lines.append(line)
    return "\n".join(lines)


class Ppm:
    """Whole texts as bytes with escapes (method C) and exclusion; contexts reach over words."""

    def __init__(self, texts, order):
        self.order, self.c = order, Counter()
        self.follow = defaultdict(Counter)
        for t in texts:
            self.c.update([*words(lower(t or "")), "\n"])
            for ctx, s in self.spelled(t):
                for k in range(order + 1):
                    self.follow[k, ctx[order - k:]][s] += 1
        self.n, self.v = sum(self.c.values()), len(self.c)

    def spelled(self, t):
        raw = b" " * self.order + "".join(w + " " for w in words(lower(t or ""))).encode() + b"\n"
        return [(raw[i:i + self.order], raw[i + self.order]) for i in range(len(raw) - self.order)]

    def byte(self, ctx, s):
        out, seen = 0.0, set()
        for k in range(self.order, -1, -1):
            f = {x: n for x, n in self.follow[k, ctx[self.order - k:]].items() if x not in seen}
            if not f:
                continue
            total = sum(f.values()) + len(f)
            if s in f:
                return out + math.log10(f[s] / total)
            out, seen = out + math.log10(len(f) / total), seen | set(f)
        return out + math.log10(1 / (256 - len(seen)))

    def score(self, t):
        return sum(self.byte(*x) for x in self.spelled(t))

    def base(self, t):
        return sum(math.log10((self.c[w] + 1) / (self.n + self.v + 1)) for w in [*words(lower(t or "")), "\n"])
