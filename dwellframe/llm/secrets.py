"""Secret scan: fixed credential patterns, and random strings found by how badly a tokenizer packs them.

A byte-pair vocabulary learned from ordinary text packs words and identifiers into few tokens. Random
strings fall apart into tokens of one or two characters, so a low number of characters per token marks
them. Strings of the shape of digests and identifiers are excluded first.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.llm.common import map_texts

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A run of this alphabet, or such runs joined by dots, as in signed tokens.
CANDIDATE = re.compile(r"(?:[A-Za-z0-9+/_=-]{8,}+\.)+[A-Za-z0-9+/_=-]{8,}+|[A-Za-z0-9+/_=-]{20,}+")

UUID = re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}")
#: Lengths of hexadecimal MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 digests, and what is said shortly before them.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
#: Keys have the first two lengths as well, so capitals of these are digests only where the text says so.
KEY_LENGTHS = (32, 40)
DIGEST_NAME = re.compile(r"(?i)sha-?\d+|md5|digest|checksum|fingerprint|hash|commit")
NAME_REACH = 24
#: Parts of an identifier: a word with at most one leading capital, capitals, or a number of a few digits.
PART = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]+(?![a-z])|[0-9]{1,8}")

#: Random strings have fewer characters per token than this.
MAX_RATIO = 2.4
#: Letters of one case need a lower one, since invented or compound words come near. Digits alone are numbers, not secrets.
LETTER_RATIO = 2.05
#: Stretches of this length inside a run, the least of a candidate, are random at fewer characters per token than the
#: second number; dates and codes, which hold more separators than the third, are not.
WINDOW, WINDOW_RATIO, WINDOW_MARKS = 20, 1.9, 3
MARKS = re.compile(r"[+/_=.-]")
#: Tokens are counted piece by piece, so that one long run costs linear time.
PIECE = 256

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("ratio", T.DoubleType()),
]))


def tokenizer(path: str) -> Callable[[str], list[int]]:
    """Encoder of a tiktoken rank file. The vocabulary is a parameter; it is not part of this package."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    name = "secrets"
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the fixed patterns, in order; kinds may overlap each other."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def is_digest(s: str, named: bool = False) -> bool:
    """Hexadecimal of a digest's length: lower-case (a fixed pattern has those), or capitals of a length no key has, or ``named``."""
    if len(s) not in DIGEST_LENGTHS:
        return False
    return bool(re.fullmatch("[0-9a-f]+" if len(s) in KEY_LENGTHS and not named else "[0-9a-f]+|[0-9A-F]+", s))


def is_identifier(s: str, known: Collection[str] = (), named: bool = False) -> bool:
    """True for known strings, digests, UUID strings, paths, and names made of words and short numbers."""
    if s.lower() in known or UUID.fullmatch(s) or is_digest(s, named):
        return True
    parts = PART.findall(s)
    words = sum(len(p) for p in parts if len(p) >= 4 and p.isalpha())
    covered = sum(map(len, parts))
    if re.fullmatch("[a-z]+|[A-Z0-9]+", s):
        return False  # looks like words whatever its letters are; its ratio says
    return covered + len(MARKS.findall(s)) == len(s) and words >= 0.7 * covered


def ratio(s: str, encode: Callable[[str], list[int]]) -> float:
    return len(s) / sum(len(encode(s[i : i + PIECE])) for i in range(0, len(s), PIECE))


def kinds(s: str) -> int:
    return bool(re.search("[0-9]", s)) + bool(re.search("[a-z]", s)) + bool(re.search("[A-Z]", s))


def limit(s: str, max_ratio: float) -> float:
    """Characters per token below which a run is random."""
    if kinds(s) >= 2:
        return max_ratio
    return min(max_ratio, LETTER_RATIO) if re.fullmatch("[a-z]+|[A-Z]+", s) else 0.0


def random_parts(
    s: str, encode, max_ratio: float = MAX_RATIO, known: Collection[str] = (), named: bool = False
) -> list[tuple[int, int, float]]:
    """(start, end, ratio) of what is random in a run: all of it, or else parts between separators, or else windows.

    Ordinary words beside a key raise the ratio of the whole run, so each part of a candidate's length is tested
    like a run, and what the parts leave (a key may hold separators) in windows. Windows that fail are joined, and
    ordinary words at their ends left out. Identifiers inside the run are excluded like whole ones. ``named``: the
    text before names a digest.
    """
    if s.lower() in known or UUID.fullmatch(s):
        return []
    if not is_identifier(s, known, named) and (r := ratio(s, encode)) < limit(s, max_ratio):
        return [(0, len(s), r)]
    found, at = [], 0
    parts = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9]+", s)]
    closed = [m.span() for m in UUID.finditer(s)]  # no window reaches into these
    for a, b in parts:
        if b - a < WINDOW:
            continue
        part = s[a:b]
        if part.lower() in known or is_digest(part, named):
            closed.append((a, b))
        elif b - a < len(s) and not is_identifier(part, known, named) and (r := ratio(part, encode)) < limit(part, max_ratio):
            found.append((a, b, r))
    for a, b in [*sorted([*closed, *((a, b) for a, b, _ in found)]), (len(s), len(s))]:
        found += _random_windows(s, at, a, parts, encode)
        at = max(at, b)
    return sorted(found)


def _random_windows(s: str, low: int, high: int, parts: list[tuple[int, int]], encode) -> list[tuple[int, int, float]]:
    joined: list[list[int]] = []
    for a in range(low, high - WINDOW + 1):
        w = s[a : a + WINDOW]
        if kinds(w) >= 2 and len(MARKS.findall(w)) <= WINDOW_MARKS and not is_identifier(w) and ratio(w, encode) < WINDOW_RATIO:
            if joined and a <= joined[-1][1]:
                joined[-1][1] = a + WINDOW
            else:
                joined.append([a, a + WINDOW])
    out = []
    for a, b in joined:
        inside = [p for p in parts if p[0] < b and a < p[1]]
        word = lambda p: bool(re.fullmatch(r"[A-Z]?[a-z]{3,}|[A-Z]{3,}", s[slice(*p)])) and p[1] - p[0] < WINDOW
        while len(inside) > 1 and word(inside[0]):
            inside.pop(0)
            a = inside[0][0]
        while len(inside) > 1 and word(inside[-1]):
            inside.pop()
            b = inside[-1][1]
        a, b = max(low, min(a, inside[0][0])), min(high, max(b, inside[-1][1]))  # a key is reported to its ends
        out.append((a, b, ratio(s[a:b], encode)))
    return out


def within(start: int, end: int, spans: list[tuple[int, int]]) -> bool:
    """Whether ``spans``, ordered by start, cover everything from ``start`` to ``end``."""
    for a, b in spans:
        if a <= start:
            start = max(start, b)
    return start >= end


def scan(text: str | None, encode, max_ratio: float = MAX_RATIO, known: Collection[str] = ()) -> list[tuple]:
    """All spans (kind, start, end, ratio), by start then kind. Random strings may overlap base spans, but none lies within them."""
    text = text or ""
    found: list[tuple] = [(s, k, e, None) for s, k, e in base_spans(text)]
    taken = [(s, e) for s, _, e, _ in found]
    for m in CANDIDATE.finditer(text):
        near = [(a, b) for a, b in taken if a < m.end() and m.start() < b]
        if within(m.start(), m.end(), near):
            continue
        named = bool(DIGEST_NAME.search(text, max(0, m.start() - NAME_REACH), m.start()))
        parts = [(m.start() + a, 3, m.start() + b, r) for a, b, r in random_parts(m[0], encode, max_ratio, known, named)]
        found += [p for p in parts if not within(p[0], p[2], near)]
    return [(KINDS[k], s, e, r) for s, k, e, r in sorted(found, key=lambda x: x[:3])]


def find_secrets(docs: DataFrame, vocabulary: str, max_ratio: float = MAX_RATIO, known: Collection[str] = ()) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end in code points, characters per token) of every row of ``docs``.

    Row by row: a null or empty text has an empty list, a null id stays null, repeated rows are scanned
    each, equal starts are ordered by kind, and other columns are ignored. ``known`` holds lower-case
    strings that are no secrets (such as published digests); only the method's own spans heed it.
    """
    known = frozenset(x.lower() for x in known)

    def make():
        encode = tokenizer(vocabulary)
        return lambda texts: [[scan(t, encode, max_ratio, known) for t in texts]]

    return map_texts(docs, lambda: _structs(make()), [T.StructField("spans", SPANS)])


def _structs(work):
    names = ("kind", "start", "end", "ratio")
    return lambda texts: [[[dict(zip(names, s, strict=True)) for s in spans] for spans in work(texts)[0]]]


def redact(docs: DataFrame, vocabulary: str, mask: str = "[secret]", max_ratio: float = MAX_RATIO) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mask``; overlapping spans become one mask.

    Columns and rows stay as they are; null texts stay null; texts without secrets are unchanged.
    """

    def make():
        encode = tokenizer(vocabulary)

        def clean(text: str | None) -> str | None:
            spans = scan(text, encode, max_ratio)
            if not spans:
                return text
            out, at = [], 0
            for _, start, end, _ in spans:
                if start >= at:
                    out += [text[at:start], mask]
                at = max(at, end)
            return "".join([*out, text[at:]])

        return lambda texts: [[clean(t) for t in texts]]

    others = [c for c in docs.columns if c != "text"]
    return map_texts(docs, make, [T.StructField("text", T.StringType())], keep=others).select(*docs.columns)


def digests(found: DataFrame) -> DataFrame:
    """The counts and digest columns of a scan: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), count("random").alias("n_random"),
    )
