"""Quality rules: word, symbol, line and repetition counts, and zstandard compression bands.

Natural prose compresses by a factor that depends on how much of it there is. Repetitive text compresses
far better, keys and encoded data hardly at all. The factor is taken over the whole text and over chunks of
a fixed size, the last of which ends where the text ends; each has limits for its length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dwellframe.llm.common import map_texts

SYMBOLS = "#*$%&|<>"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
CHUNK = 4096
#: (bytes from, least, most): factors inside the limits pass. Short texts only fail at extremes, since a frame's fixed bytes count.
BANDS = ((0, 0.0, 1e9), (200, 0.9, 6.0), (1000, 1.1, 8.0), (4096, 1.25, 10.0), (32768, 1.35, 12.0), (131072, 1.35, 16.0))
CHUNK_BAND = (1.45, 10.0)
#: (chunks from, share): a text fails if more than this share of its chunks is outside the chunk limits.
BAD_CHUNKS = ((0, 0.0), (5, 0.2), (20, 0.15), (100, 0.1))

FIELDS = [
    *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("ratio", T.DoubleType()), T.StructField("n_chunks", T.LongType()), T.StructField("n_bad_chunks", T.LongType()),
]


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in some window of ``width`` words which occurs at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    key = a[:n]
    for k in range(1, width):  # pairs are renumbered at each step, so keys stay exact
        key = np.unique(key * len(ids) + a[k : k + n], return_inverse=True)[1]
    twice = np.bincount(key)[key] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k : k + n] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


def base_counts(text: str) -> tuple[int, int, int, int, int, bool]:
    words = text.encode().split()
    n, repeats = len(words), repeated_words(words)
    chars = len(text) - sum(map(text.count, WHITE))
    failed = n < 50 or 100 * repeats > 50 * n
    return n, chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeats, failed


def band(size: int) -> tuple[float, float]:
    least, most = BANDS[0][1:]
    for start, low, high in BANDS:
        if size >= start:
            least, most = low, high
    return least, most


def chunks_of(raw: bytes) -> list[bytes]:
    """Every byte of a text of at least a chunk's length, in chunks; the last one reaches back to be full."""
    if len(raw) < CHUNK:
        return []
    return [raw[i : i + CHUNK] for i in [*range(0, len(raw) - CHUNK, CHUNK), len(raw) - CHUNK]]


def judge(text: str | None, compress) -> tuple:
    """The values of ``FIELDS`` for one text; ``compress`` is a function from bytes to bytes."""
    text = text or ""
    *counts, failed = base_counts(text)
    raw = text.encode()
    factor = len(raw) / len(compress(raw)) if raw else None
    chunks = chunks_of(raw)
    bad = sum(not CHUNK_BAND[0] <= CHUNK / len(compress(c)) <= CHUNK_BAND[1] for c in chunks)
    least, most = band(len(raw))
    share = [s for n, s in BAD_CHUNKS if len(chunks) >= n][-1]
    passes = factor is not None and least <= factor <= most and bad <= share * len(chunks)
    return *counts, failed, passes and not failed, factor, len(chunks), bad


def quality_rules(docs: DataFrame, level: int = 3) -> DataFrame:
    """doc_id and the columns of ``FIELDS`` for every row of ``docs``.

    Row by row: a null text counts as empty and fails (fewer than 50 words, ratio null); a null id stays
    null; repeated rows are judged each; other columns are ignored. A text of any length is read whole.
    """

    def make():
        import zstandard

        compress = zstandard.ZstdCompressor(level=level).compress
        return lambda texts: list(zip(*(judge(t, compress) for t in texts), strict=True))

    return map_texts(docs, make, FIELDS)
