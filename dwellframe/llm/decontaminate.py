"""Benchmark decontamination: one automaton over all windows of the test items scans each text once.

Texts and items are lower-cased (A-Z) and cut into words. The automaton (Aho-Corasick) reads a text as a
sequence of word numbers and reports every window wherever it ends.
Word positions are mapped back to code points of the original text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.llm.common import map_texts, stage

WIDTH = 10
#: Most (window, item) pairs in one automaton, about 100 MB in a task. More make further passes over the texts.
WINDOWS_PER_PASS = 150_000

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
#: Bytes of words stay, A-Z lower-cased; all others become blanks.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

HIT = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(BYTES).split()


def windows_of(text: str | None, width: int = WIDTH) -> list[bytes]:
    words = words_of(text)
    if not words:
        return []
    return [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


def window_table(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct (window, item): the item's id as text, null for an item without one. Rows without words have none."""
    schema = "window binary, item string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(w, i) for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for w in windows_of(t, width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.string())], ["window", "item"]
            )

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return items.mapInArrow(run, schema).distinct()


class Automaton:
    """Word numbers are spelled with three characters from separate alphabets, so no node has many children
    and no match can start inside a word. Words that the benchmark lacks are spelled as three zeros."""

    def __init__(self, pairs: list[tuple[bytes, str]]):
        import ahocorasick

        items = defaultdict(list)
        for window, item in pairs:
            items[window].append(item)
        self.code: dict[bytes, str] = {}
        self.machine = ahocorasick.Automaton()
        for window, of in items.items():
            words = window.split()
            self.machine.add_word("".join(map(self._spell, words)), (len(words), of))
        self.machine.make_automaton()

    def _spell(self, word: bytes) -> str:
        n = len(self.code)
        return self.code.setdefault(word, chr(0x100 + n // 4096) + chr(0x80 + n // 64 % 64) + chr(1 + n % 64))

    def scan(self, words: list[bytes]) -> tuple[list[int], list[str]]:
        """Positions of hit words, and the items with occurring windows."""
        get, none = self.code.get, "\0\0\0"
        found = list(self.machine.iter("".join([get(w, none) for w in words])))
        if not found:
            return [], []
        edge, items = np.zeros(len(words) + 1, np.int32), set()
        for at, (size, of) in found:
            last = at // 3
            edge[last - size + 1] += 1
            edge[last + 1] -= 1
            items.update(i for i in of if i is not None)
        return np.flatnonzero(np.cumsum(edge)).tolist(), sorted(items)


def _pass(docs: DataFrame, pairs: list[tuple[bytes, str]], keep: list[str], text: str = "text") -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(pairs)

    def make():
        machine = Automaton(held.value) if held.value else None

        def work(texts):
            out = []
            for text in texts:
                words = words_of(text)
                out.append((len(words), *(machine.scan(words) if machine else ([], []))))
            return list(zip(*out, strict=True))

        return work

    return map_texts(docs, make, FIELDS, keep=keep, text=text)


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, width: int = WIDTH,
                   per_pass: int = WINDOWS_PER_PASS, text: str = "text") -> DataFrame:
    """The kept columns, ``n_words``, ``hits`` (positions of hit words) and ``items`` for every row of ``docs``.

    The benchmark's windows are counted first. Up to ``per_pass`` of them form one automaton, sent to all
    tasks; a larger benchmark is dealt by hash into parts of that size and the texts are scanned once for
    each, with a staged table between, so neither the driver nor a task ever holds more than one part.

    Null texts and texts or items without words have no hits; windows of items with a null id hit, and are named by
    none; repeated rows are scanned each; equal items count under each of their ids; other columns are ignored.
    """
    keep = ["doc_id"] if keep is None else list(keep)
    table = window_table(benchmark, width)
    parts = max(1, -(-table.count() // per_pass))
    if parts == 1:
        return _pass(docs, [tuple(r) for r in table.collect()], keep, text)
    table = stage(table.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(parts))), "windows")
    plain = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    names = [f"kept_{i}" for i in range(len(keep))]
    found = docs.select(*plain, F.col(text).alias("text"), F.lit(0).cast("long").alias("n0"),
                        F.array().cast("array<int>").alias("h0"), F.array().cast("array<string>").alias("i0"))
    for part in range(parts):
        pairs = [(r["window"], r["item"]) for r in table.filter(F.col("part") == part).select("window", "item").collect()]
        scanned = _pass(found.withColumn("copy", F.col("text")), pairs, [*names, "copy", "h0", "i0"])
        found = stage(scanned.select(*names, F.col("copy").alias("text"), F.col("n_words").alias("n0"),
                                     F.array_sort(F.array_union("h0", "hits")).alias("h0"),
                                     F.array_sort(F.array_union("i0", "items")).alias("i0")), "scanned")
    return found.select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)),
                        F.col("n0").alias("n_words"), F.col("h0").alias("hits"), F.col("i0").alias("items"))


def spans_of(text: str, hits: list[int]) -> list[tuple[int, int]]:
    """Code point ranges of the original text for runs of hit words."""
    places = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    spans: list[list[int]] = []
    last = None
    for h in hits:
        if last is not None and h == last + 1:
            spans[-1][1] = places[h][1]
        else:
            spans.append(list(places[h]))
        last = h
    return [tuple(s) for s in spans]


def hit_spans(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows with hits only: the kept columns, ``items`` and ``spans`` (start, end in code points of the text).

    Nulls, rows without words, repeated rows and empty tables as in :func:`scan_benchmark`; columns of any name.
    """
    keep = ["doc_id"] if keep is None else list(keep)
    packed = docs.select(F.struct(*keep).alias("row"), "text")
    found = scan_benchmark(packed, benchmark, ["row", "text"]).filter(F.size("hits") > 0)

    @F.pandas_udf(T.ArrayType(HIT))
    def places(text, hits):
        return text.combine(hits, lambda t, h: [{"start": a, "end": b} for a, b in spans_of(t, list(h))])

    return found.select("row.*", "items", places("text", "hits").alias("spans"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold any benchmark window; columns unchanged, whatever their names.

    Null and empty texts stay; repeated rows stay or go alike; an empty benchmark drops nothing.
    """
    packed = docs.select(F.struct(*docs.columns).alias("row"))
    return scan_benchmark(packed, benchmark, ["row"], text="row.text").filter(F.size("hits") == 0).select("row.*")
