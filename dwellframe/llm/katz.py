"""Word bigram language model with Katz backoff, learned and applied by Spark over partitioned tables.

Tokens are the words of a text and one end. Counts of up to ``K`` are discounted by Good-Turing; larger counts
are trusted. A bigram that was seen has its discounted share of its history; any other falls back to the
unigram model, weighted so that each history's probabilities add up to exactly 1; an unknown word falls back
once more, to the mass that the discounted unigrams leave. Every history sets one count aside for successors
it has not had, so mass is left even where all its successors are frequent.

Tables: ``unigrams`` (word, count), and ``evaluated``, dealt by history, which holds the bigram counts
(``kind`` model: history, words, counts), the statistics of histories and the scored parts of texts.
Words are 64-bit hashes in ``unigrams``, which numbers them from the most frequent on; elsewhere they are
those numbers, which take fewer bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from dwellframe.llm.common import bound_batches, mix, slices, stage, word_hashes

K = 5
#: Tokens that a task packs at once, counts or adds up at once, and about how many one bucket holds.
CHUNK, COUNTED, BUCKET = 600_000, 1_200_000, 1_500_000
#: Histories with this share of all tokens, or as many as this part of a bucket's, are split over all buckets.
HOT, HOT_PART = 1 / 4096, 1 / 4
#: So many split histories' sums are sent to all tasks; more are joined by shuffle.
FEW = 100_000
#: A unigram table below this size is sent to all tasks; a larger one is joined to blocks of texts.
BROADCAST_BYTES = 48 << 20
#: Texts whose parts are added up together: 2 to this power.
RANGE = 12
#: Texts in a block when the unigram table is joined.
BLOCK = 2000

END = pd.util.hash_array(np.array(["end of text\n"], object))[0]
UNKNOWN, START = -1, -2
PACKED = "h ch runs w cw train occ doc".split()
EVALUATED = (
    "kind string, block long, h long, ids array<long>, counts array<long>, values array<double>, "
    "doc_id {}, n_tokens long, n_known long, base double"
)


def good_turing(n: dict[int, int], k: int = K) -> np.ndarray:
    """Factors for counts 0 to ``k`` (index 0 unused) from the numbers ``n`` of things seen 1, 2, .. ``k`` + 1 times.

    Where those numbers give a factor outside (0, 1), as small corpora do, count r keeps
    1 - D / r with D = n1 / (n1 + 2 n2), between 0.1 and 0.9, instead.
    """
    n1, n2 = n.get(1, 0), n.get(2, 0)
    plain = min(0.9, max(0.1, n1 / (n1 + 2 * n2) if n1 else 0.5))
    out, over = np.ones(k + 1), (k + 1) * n.get(k + 1, 0) / n1 if n1 else 1.0
    for r in range(1, k + 1):
        turned = (r + 1) * n.get(r + 1, 0) / (r * n[r]) if n.get(r) else 0.0
        d = (turned - over) / (1 - over) if over != 1 else 0.0
        out[r] = d if 0.0 < d < 1.0 else 1 - plain / r
    return out


def hot_from(tokens: int) -> float:
    """The count from which a history is split: a bucket never holds one that is larger than a part of it."""
    return max(1.0, min(tokens * HOT, BUCKET * HOT_PART))


@dataclass
class Unigrams:
    """Totals of the training tokens and the discounted unigram model."""

    tokens: int
    types: int
    factors: np.ndarray
    left: float

    @classmethod
    def of(cls, table: DataFrame) -> Unigrams:
        total, types = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        n = {r["c"]: r["count"] for r in table.filter(F.col("c") <= K + 1).groupBy("c").count().collect()}
        factors = good_turing(n)
        kept = total - sum((1 - factors[r]) * r * n.get(r, 0) for r in range(1, K + 1))
        # as for histories, one count is set aside, so unknown words always have a probability
        return cls(total, types, factors, 1 - kept / (total + 1))

    def probability(self, c: np.ndarray) -> np.ndarray:
        """Of a word with count ``c``; of all unknown words together for 0."""
        return np.where(c > 0, c * self.factors[np.where(c <= K, c, 0)] / (self.tokens + 1), self.left)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def count_words(docs: DataFrame, train: Column) -> DataFrame:
    """(w, c, id) of the training rows, ends included; staged. Each task sends a word once per ``COUNTED`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            w, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c)], ["w", "c"])

        for batch in batches:
            for part in slices(batch, 0):
                words, _ = word_hashes(part.column(0))
                held += [words, np.full(part.num_rows, END, np.uint64)]
                size += len(words) + part.num_rows
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    counts = docs.filter(train).select("text").mapInArrow(run, "w long, c long")
    ranked = counts.groupBy("w").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "w")
    return stage(ranked.select("w", "c", F.monotonically_increasing_id().alias("id")), "unigrams")


@dataclass
class Chunk:
    """Rows of whole texts to be packed: ids, training marks, word hashes and each text's place in them."""

    ids: list
    train: np.ndarray
    words: np.ndarray
    offsets: np.ndarray

    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens with ends, and the text of each."""
        n = np.diff(self.offsets)
        doc = np.repeat(np.arange(len(n)), n + 1)
        tokens = np.full(len(doc), END, np.uint64)
        inside = np.ones(len(doc), bool)
        inside[np.cumsum(n + 1) - 1] = False
        tokens[inside] = self.words
        return tokens, doc


@dataclass
class Lookup:
    """A part of the unigrams: hashes in order, and the rank of each by number.

    Counts fall as numbers rise, and numbers run on but for the edges of the table's files. So both are kept
    as runs of ranks, (first rank, value), and a word takes 12 bytes.
    """

    hashes: np.ndarray
    ranks: np.ndarray
    counts: tuple[np.ndarray, np.ndarray]
    shifts: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, table: pa.Table) -> Lookup:
        numbers = table.column("id").to_numpy()
        order = np.argsort(numbers, kind="stable")
        counts, shifts = cls._runs(table.column("c").to_numpy()[order]), cls._runs(numbers[order] - np.arange(len(order)))
        hashes = table.column("w").to_numpy()[order].view(np.uint64)
        ranks = np.argsort(hashes)
        return cls(hashes[ranks], ranks.astype(np.int32), counts, shifts)

    @staticmethod
    def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1])[: len(a)])
        return first, a[first]

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and number of each word; 0 and ``UNKNOWN`` for those not held."""
        c, number = np.zeros(len(words), np.int64), np.full(len(words), UNKNOWN)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
            hit = self.hashes[at] == words
            rank = self.ranks[at[hit]]
            of = lambda runs: runs[1][np.searchsorted(runs[0], rank, "right") - 1]
            c[hit], number[hit] = of(self.counts), rank + of(self.shifts)
        return c, number


def pack(chunk: Chunk, block: int, lookup: Lookup, uni: Unigrams, buckets: int) -> list[dict]:
    """Rows for the buckets: one per text with its base figures, and one per bucket with bigrams and where they occur.

    ``lookup`` are the unigrams, or those of them that these texts need.
    """
    tokens, doc = chunk.tokens()
    known, local = np.unique(tokens, return_inverse=True)
    c, number = lookup.find(known)
    number = np.append(number, UNKNOWN)
    texts = len(chunk.ids)
    base = np.bincount(doc, uni.base(c)[local], texts)
    n_known = np.bincount(doc[c[local] > 0], minlength=texts)
    first = np.insert(doc[1:] != doc[:-1], 0, True)
    before = np.insert(local[:-1], 0, 0)
    ends = c[np.searchsorted(known, np.uint64(END))] if texts else 0
    ch = np.where(first, ends, c[before])  # every training text starts once and ends once
    direct = np.zeros(texts)
    lone = ch == 0  # an unknown history knows no successors
    direct += np.bincount(doc[lone], np.log10(uni.probability(c[local[lone]])), texts)
    rows = [
        {"bucket": (block + k) % buckets, "kind": "text", "block": block + k, "doc_id": i, "n_tokens": int(n), "n_known": int(m), "base": float(b), "direct": float(d)}
        for k, (i, n, m, b, d) in enumerate(zip(chunk.ids, np.bincount(doc, minlength=texts), n_known, base, direct, strict=True))
    ]
    use = ~lone
    if not use.any():
        return rows
    w = np.where(c[local[use]] > 0, local[use], len(known))  # all unknown words are one
    h = np.where(first[use], len(known), before[use])
    order = np.argsort(h * (len(known) + 1) + w, kind="stable")
    w, h, d, ch = w[order], h[order], doc[use][order], ch[use][order]
    start = np.flatnonzero(np.insert((w[1:] != w[:-1]) | (h[1:] != h[:-1]), 0, True))
    occ = np.diff(np.append(start, len(w)))
    train = np.add.reduceat(chunk.train[d].astype(np.int64), start)
    w_id = number[w[start]]
    h_id = np.where(h[start] == len(known), START, number[h[start]])
    cw, ch = np.append(c, 0)[w[start]], ch[start]
    hot = ch >= hot_from(uni.tokens)
    bucket = (np.where(hot, mix(mix(w_id.view(np.uint64)) + h_id.view(np.uint64)), mix(h_id.view(np.uint64))) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    filled, edges = np.unique(bucket[order], return_index=True)  # work in proportion to the chunk, however many buckets there are
    place = np.append(0, np.cumsum(occ))
    for k, e in zip(filled.tolist(), np.split(order, edges[1:]), strict=True):
        heads = np.flatnonzero(np.insert(h_id[e][1:] != h_id[e][:-1], 0, True))
        inside = np.repeat(place[e] - np.append(0, np.cumsum(occ[e]))[:-1], occ[e]) + np.arange(occ[e].sum())
        arrays = (h_id[e][heads], ch[e][heads], np.diff(np.append(heads, len(e))), w_id[e], cw[e], train[e], occ[e], d[inside])
        rows.append({"bucket": k, "kind": "bigrams", "block": block, **dict(zip(PACKED, arrays, strict=True))})
    return rows


def _packed_schema(kind: str) -> str:
    return f"bucket int, kind string, block long, doc_id {kind}, n_tokens long, n_known long, base double, direct double, " + ", ".join(f"{c} binary" for c in PACKED)


def _press(a: np.ndarray, press) -> bytes:
    """Compressed by byte planes: the upper bytes of small numbers cost next to nothing."""
    return press(a.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpress(b: bytes, unpress) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpress(b), np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _packer(uni: Unigrams, buckets: int, id_type: pa.DataType):
    """Function from (chunk, block, lookup) to a record batch of the packed rows."""
    import zstandard

    press = zstandard.ZstdCompressor(level=1).compress
    plain = {"bucket": pa.int32(), "kind": pa.string(), "block": pa.int64(), "doc_id": id_type, "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "direct": pa.float64()}

    def made(chunk: Chunk, block: int, lookup: Lookup) -> pa.RecordBatch:
        rows = pack(chunk, block, lookup, uni, buckets)
        columns = [pa.array([r.get(c) for r in rows], kind) for c, kind in plain.items()]
        columns += [pa.array([_press(r[c], press) if c in r else None for r in rows], pa.binary()) for c in PACKED]
        return pa.RecordBatch.from_arrays(columns, names=[*plain, *PACKED])

    return made


def _rows(table: pa.Table | pa.RecordBatch, text: int) -> Chunk:
    words, offsets = word_hashes(table.column(text) if isinstance(table, pa.RecordBatch) else table.column(text).combine_chunks())
    train = np.array(table.column("train").to_pylist(), bool)
    return Chunk(table.column("doc_id").to_pylist(), train, words, offsets)


def _joined(chunks: list[Chunk]) -> Chunk:
    offsets = np.cumsum(np.concatenate([[0], *(np.diff(c.offsets) for c in chunks)]))
    return Chunk([i for c in chunks for i in c.ids], np.concatenate([c.train for c in chunks]), np.concatenate([c.words for c in chunks]), offsets)


def _held(table: DataFrame, uni: Unigrams) -> Broadcast | None:
    """The unigrams for all tasks, where they take less than ``BROADCAST_BYTES``."""
    if uni.types * 12 >= BROADCAST_BYTES:
        return None
    return table.sparkSession.sparkContext.broadcast(Lookup.of(table.toArrow()))


def _packed(docs: DataFrame, train: Column, table: DataFrame, uni: Unigrams, buckets: int, held: Broadcast | None) -> DataFrame:
    """Packed rows of all texts. A block's number leaves room for the texts in it, which are numbered on from it."""
    kind, id_type = docs.schema["doc_id"].dataType.simpleString(), to_arrow_type(docs.schema["doc_id"].dataType)
    rows = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train"))
    if held:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            made = _packer(uni, buckets, id_type)
            lookup = held.value
            parts, size, block = [], 0, TaskContext.get().partitionId() << 40
            for batch in batches:
                for part in slices(batch, 1):
                    parts.append(_rows(part, 1))
                    size += len(parts[-1].words)
                    if size >= CHUNK:
                        chunk = _joined(parts)
                        yield made(chunk, block, lookup)
                        parts, size, block = [], 0, block + len(chunk.ids)
            if parts:
                yield made(_joined(parts), block, lookup)

        return rows.mapInArrow(run, _packed_schema(kind))
    return _packed_by_join(rows, table, uni, buckets, kind, id_type)


def _packed_by_join(rows: DataFrame, table: DataFrame, uni: Unigrams, buckets: int, kind: str, id_type: pa.DataType) -> DataFrame:
    """As above with the unigrams of each block of texts joined to it, when they are too many to be sent everywhere."""
    blocks = max(1, rows.count() // BLOCK)
    placed = rows.withColumn("b", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                words, offsets = word_hashes(part.column(0))
                b = np.repeat(part.column(1).to_numpy(), np.diff(offsets))
                pairs = pd.DataFrame({"b": b, "w": words.view(np.int64)}).drop_duplicates()
                ends = pd.DataFrame({"b": np.unique(part.column(1).to_numpy()), "w": np.array([END], np.uint64).view(np.int64)[0]})
                yield pa.RecordBatch.from_pandas(pd.concat([pairs, ends]), preserve_index=False)

    wanted = placed.select("text", "b").mapInArrow(distinct, "b long, w long").distinct().join(table, "w")

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        made = _packer(uni, buckets, id_type)
        if not texts.num_rows:
            return pa.Table.from_batches([made(Chunk([], np.zeros(0, bool), np.zeros(0, np.uint64), np.zeros(1, np.int64)), 0, Lookup.of(words))])
        block = texts.column("b")[0].as_py() << 32
        return pa.Table.from_batches([made(_rows(texts, 1), block, Lookup.of(words))])

    return placed.groupBy("b").cogroup(wanted.groupBy("b")).applyInArrow(run, _packed_schema(kind))


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype(np.int32)), pa.array(values))


def evaluate(group: pa.Table, uni: Unigrams, schema: pa.Schema) -> pa.Table:
    """All there is to say about one bucket before the bigram discounts are known."""
    import zstandard

    unpress = zstandard.ZstdDecompressor().decompress
    out = []

    def emit(kind: str, n: int, **columns) -> None:
        arrays = [pa.array([kind] * n) if f.name == "kind" else columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
        out.append(pa.Table.from_arrays(arrays, schema=schema))

    whole = lambda column: column.combine_chunks()
    kinds = np.array(group.column("kind").to_pylist(), object)
    texts = group.filter(pa.array(kinds == "text"))
    if texts.num_rows:
        direct = whole(texts.column("direct")).to_numpy()
        emit("text", texts.num_rows, **{c: whole(texts.column(c)) for c in ("block", "doc_id", "n_tokens", "n_known", "base")},
             values=_lists(direct, np.arange(len(direct))))
    packs = group.filter(pa.array(kinds == "bigrams"))
    if packs.num_rows:
        read = {c: [_unpress(x, unpress) for x in packs.column(c).to_pylist()] for c in PACKED}
        blocks = packs.column("block").to_pylist()
        row = np.concatenate([d + b for d, b in zip(read["doc"], blocks, strict=True)])
        h, ch, runs, w, cw, train, occ = (np.concatenate(read[c]) for c in PACKED[:-1])
        h, ch = np.repeat(h, runs), np.repeat(ch, runs)
        del read, packs, texts, group
        order = np.lexsort((w, h))
        new = np.insert((h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1]), 0, True)
        pair = np.empty(len(h), np.int64)
        pair[order] = np.cumsum(new) - 1
        seen = np.bincount(pair, train).astype(np.int64)  # of each pair
        one = order[new]
        ph, pw, pc, pch = h[one], w[one], cw[one], ch[one]
        r = seen[pair]
        del order, new, one, h, w, train
        # texts: the logarithms known by now, and how many tokens have each discount
        value = np.where(r > 0, np.log10(np.maximum(r, 1) / (ch + 1.0)), np.log10(uni.probability(cw)))
        entry = np.repeat(np.arange(len(occ)), occ)
        del ch, cw
        rows, inverse = np.unique(row, return_inverse=True)
        total = np.bincount(inverse, value[entry])
        small = np.where(r <= K, r, 0)[entry]
        marks = np.bincount(inverse * (K + 1) + small, minlength=len(rows) * (K + 1)).reshape(-1, K + 1)[:, 1:]
        del inverse, small, value
        emit("part", 1, ids=_lists(rows, np.zeros(1)), values=_lists(total, np.zeros(1)), counts=_lists(marks.ravel(), np.zeros(1)))
        # model: the bigrams of each history
        had = seen > 0
        if had.any():
            mh, mw, mr = ph[had], pw[had], seen[had]
            starts = np.flatnonzero(np.insert(mh[1:] != mh[:-1], 0, True))
            emit("model", len(starts), h=pa.array(mh[starts]), ids=_lists(mw, starts), counts=_lists(mr, starts))
        emit("seen", 1, counts=_lists(np.bincount(np.minimum(seen, K + 2), minlength=K + 3)[1 : K + 2], np.zeros(1)))
        # histories: what their backoff weight depends on, and the texts that ask for it
        heads = np.flatnonzero(np.insert(ph[1:] != ph[:-1], 0, True))
        of = np.cumsum(np.insert(ph[1:] != ph[:-1], 0, True)) - 1
        stats = np.empty((len(heads), K + 2))
        stats[:, 0] = pch[heads]
        for k in range(1, K + 1):
            stats[:, k] = np.bincount(of, seen == k, len(heads))
        stats[:, K + 1] = np.bincount(of, np.where(had, uni.probability(pc), 0.0), len(heads))
        asks = (r == 0)[entry]
        who, whom = of[pair[entry[asks]]], row[asks]
        order = np.lexsort((whom, who))
        who, whom = who[order], whom[order]
        asked = np.searchsorted(who, np.arange(len(heads)))
        hot = stats[:, 0] >= hot_from(uni.tokens)
        keep = hot | (np.diff(np.append(asked, len(who))) > 0)
        ends = np.append(asked, len(who))
        sizes = np.diff(ends)[keep]
        chosen = np.repeat(keep, np.diff(ends))
        emit("history", int(keep.sum()), h=pa.array(ph[heads][keep]), ids=_lists(whom[chosen], np.append(0, np.cumsum(sizes))[:-1]),
             values=_lists(stats[keep].ravel(), np.arange(keep.sum()) * (K + 2)))
    return pa.concat_tables(out) if out else schema.empty_table()


def log_backoff(stats: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """log10 of the weight of histories with (count, n1 .. nK, unigram mass of what followed)."""
    r = np.arange(1, K + 1)
    left = (1 + stats[:, 1 : K + 1] @ ((1 - factors[1:]) * r)) / (stats[:, 0] + 1)
    return np.log10(left / (1 - stats[:, K + 1]))


@dataclass
class Model:
    """The learned tables and what they were learned with."""

    unigrams: DataFrame
    evaluated: DataFrame
    totals: Unigrams
    factors: np.ndarray

    def bigrams(self) -> DataFrame:
        """(h, w, c): all bigrams of the training texts, by the numbers of their words; a text's start is -2."""
        rows = self.evaluated.filter("kind = 'model'").select("h", F.explode(F.arrays_zip("ids", "counts")).alias("x"))
        return rows.select("h", F.col("x.ids").alias("w"), F.col("x.counts").alias("c"))


def learn(docs: DataFrame, train: Column) -> Model:
    """Count the training rows of ``docs`` and evaluate the parts of all rows' scores; both staged as tables."""
    bound_batches(docs.sparkSession)
    table = count_words(docs, train)
    uni = Unigrams.of(table)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, int(size // 6 // BUCKET) + 1)
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = _held(table, uni)
    packed = _packed(docs, train, table, uni, buckets, held)
    schema = EVALUATED.format(kind)

    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def run(group: pa.Table) -> pa.Table:
        return evaluate(group, uni, arrow)

    evaluated = stage(packed.groupBy("bucket").applyInArrow(run, schema), "evaluated")
    if held:
        held.destroy()  # the staged table does not need it
    got = evaluated.filter("kind = 'seen'").select(F.posexplode("counts").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()
    return Model(table, evaluated, uni, good_turing({r["k"] + 1: r["n"] for r in got}))


def score(model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row that ``learn`` was given.

    Null and empty texts have the end alone. A null id stays null, repeated rows are scored each, other
    columns are ignored. Without training texts every word is unknown and has probability 1.
    """
    factors, uni = model.factors, model.totals
    asked = model.evaluated.filter("kind in ('part', 'history')").select("kind", "h", "ids", "counts", "values")
    # split histories: their parts are added up first
    is_hot = (F.col("kind") == "history") & (F.col("values")[0] >= hot_from(uni.tokens))
    sums = F.array(F.max(F.col("values")[0]), *(F.sum(F.col("values")[k]) for k in range(1, K + 2)))
    whole = stage(asked.filter(is_hot).groupBy("h").agg(sums.alias("whole")), "split")
    few = F.broadcast(whole) if whole.count() <= FEW else whole
    hot = asked.filter(is_hot).join(few, "h").select("kind", "h", "ids", "counts", F.col("whole").alias("values"))
    asked = asked.filter(~is_hot).unionByName(hot)

    def known(batch: pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Texts and what is to be added to them."""
        kind = np.array(batch.column(0).to_pylist(), object)
        part, history = batch.filter(pa.array(kind == "part")), batch.filter(pa.array(kind == "history"))
        marks = part.column(3).flatten().to_numpy().reshape(-1, K)
        stats = history.column(4).flatten().to_numpy().reshape(-1, K + 2)
        times = history.column(2).value_lengths().to_numpy()
        values = part.column(4).flatten().to_numpy() + marks @ np.log10(factors[1:])
        return [part.column(2).flatten().to_numpy(), history.column(2).flatten().to_numpy()], [values, np.repeat(log_backoff(stats, factors), times)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, values, size = [], [], 0

        def added() -> pa.RecordBatch:
            row, inverse = np.unique(np.concatenate(rows), return_inverse=True)
            part = np.bincount(inverse, np.concatenate(values), len(row))
            group = row >> RANGE
            edges = np.append(np.flatnonzero(np.insert(group[1:] != group[:-1], 0, True)), len(row)) if len(row) else np.zeros(1, np.int64)
            cut = lambda a: pa.array([a[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(group[edges[:-1]]), cut(row), cut(part)], ["group", "rows", "parts"])

        for batch in batches:
            r, v = known(batch)
            rows += r
            values += v
            size += sum(map(len, r))
            if size >= COUNTED:
                yield added()
                rows, values, size = [], [], 0
        if rows:
            yield added()

    def total(group: pa.Table) -> pa.Table:
        row, inverse = np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in group.column("rows").to_pylist()]), return_inverse=True)
        parts = np.concatenate([np.frombuffer(x, np.float64) for x in group.column("parts").to_pylist()])
        return pa.table({"row": row, "part": np.bincount(inverse, parts, len(row))})

    parts = asked.mapInArrow(run, "group long, rows binary, parts binary")
    sums = parts.groupBy("group").applyInArrow(total, "row long, part double")
    texts = model.evaluated.filter("kind = 'text'").select("block", F.col("values")[0].alias("direct"), "doc_id", "n_tokens", "n_known", "base")
    return texts.join(sums, F.col("block") == F.col("row"), "left").select(
        "doc_id", "n_tokens", "n_known", F.lit(uni.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"),
        (F.col("direct") + F.coalesce("part", F.lit(0.0))).alias("score"),
    )
