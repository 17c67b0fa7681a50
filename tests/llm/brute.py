"""Plain versions of the corpus operators, written from their definitions and used on small tables only."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def remainder(doc_id, n: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def base_secrets(text: str | None) -> tuple[int, int, int, str]:
    text, found = text or "", []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end(), "assign"))
    for k, name, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 20), (2, "hex", r"[0-9a-f]+", 24)):
        found += [(m.start(), k, m.end(), name) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    found.sort()
    n = Counter(f[3] for f in found)
    return n["assign"], n["access"], n["hex"], sha(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found))


def quality_counts(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    again = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again), n < 50 or 100 * len(again) > 50 * n


def contamination(docs: list[tuple], items: list[tuple]) -> dict:
    """doc_id -> (n_words, n_hit, n_items, items_sha256); ids must differ."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        words = cut(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i : i + 10])] |= {str(item)} if item is not None else set()
    sizes, out = {len(w) for w in windows}, {}
    for doc, text in docs:
        words, hit, found = cut(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (own := windows.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out[doc] = len(words), len(hit), len(found), sha(",".join(sorted(found)))
    return out


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of rows (doc_id, text), by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                up[top(i)] = top(j)
    least: dict[int, int | None] = {}
    for i, (d, _) in enumerate(rows):
        k = top(i)
        if d is not None:
            least[k] = d if least.get(k) is None else min(least[k], d)
    return [(d, len(sets[i]), least.get(top(i))) for i, (d, _) in enumerate(rows)]


class Katz:
    """The same model from nested dictionaries, with probabilities rather than logarithms."""

    K = 5

    def __init__(self, texts: list[str | None]):
        self.one, self.two = Counter(), defaultdict(Counter)
        for t in texts:
            before = "<s>"
            for w in self.tokens(t):
                self.one[w] += 1
                self.two[before][w] += 1
                before = w
        self.n = sum(self.one.values())
        self.d1 = self.factors(Counter(self.one.values()))
        self.d2 = self.factors(Counter(c for of in self.two.values() for c in of.values()))

    @staticmethod
    def tokens(text: str | None) -> list[str]:
        return [*WORD.findall((text or "").translate(LOWER)), "<end>"]

    def factors(self, n: Counter) -> dict[int, float]:
        out, k = {}, self.K
        d = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5))
        for r in range(1, k + 1):
            over = (k + 1) * n[k + 1] / n[1] if n[1] else 1
            turned = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0
            f = (turned - over) / (1 - over) if over != 1 else 0
            out[r] = f if 0 < f < 1 else 1 - d / r
        return out

    def p1(self, w: str | None) -> float:
        """Of a word; of all unknown words together for None."""
        if w in self.one:
            return self.d1.get(self.one[w], 1) * self.one[w] / (self.n + 1)
        return 1 - sum(self.d1.get(c, 1) * c for c in self.one.values()) / (self.n + 1)

    def p2(self, h: str, w: str | None) -> float:
        after = self.two.get(h)
        if not after:
            return self.p1(w)
        total = sum(after.values()) + 1
        if w in after:
            return self.d2.get(after[w], 1) * after[w] / total
        left = 1 - sum(self.d2.get(c, 1) * c for c in after.values()) / total
        return left / (1 - sum(map(self.p1, after))) * self.p1(w)

    def score(self, text: str | None) -> float:
        out, before = 0.0, "<s>"
        for w in self.tokens(text):
            out += math.log10(self.p2(before, w))
            before = w
        return out

    def base(self, text: str | None) -> float:
        return sum(math.log10((self.one[w] + 0.5) / (self.n + 0.5 * (len(self.one) + 1))) for w in self.tokens(text))
