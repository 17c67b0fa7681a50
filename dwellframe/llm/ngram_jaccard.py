"""N-gram Jaccard join by a matrix of tokens and groups: exact links and components of similar texts.

A text's set are its distinct shingles of words. Equal sets form one class, and each class takes part once.
Two sets whose Jaccard similarity reaches the threshold must share several shingles among the first few of
each (the rarer ones come first), so only these openings of the sets are indexed, and a class that shares too
few of its own with anything is done with.

Links are found in groups. A step says which classes may be similar; these form groups of at most ``GROUP`` members, each
group stores the union of its members' shingles, and a class that may be similar to a member of another group is a
query for that group. Where a query's overlap with the union is too small, no member can be similar and the group
stays closed; in an open group the query is compared with the members, but for those that are in its component already.

1. Rare shingles, held by a few classes, name their holders as possibly similar, if the shingles that two of them share, and
   the common ones they could share at most, are enough. This leaves pairs that share common shingles only.
2. Every common shingle names one leader among the classes that hold it, which the others may be similar to; so a shingle
   held by many texts makes a star, not all pairs. Leaders change from round to round.
3. Matrix: shingles whose holders are all in one component by now are settled, and so are classes that hold too few others.
   The classes left are dealt into groups by their first leader. The matrix of shingles and groups tells which groups share
   enough shingles; of those, each member of one is a query for the other.

No link between components is missed: a pair shares a rare shingle and is counted, or shares a settled one
and is in one component, or meets in step 3. Shingles and classes are 64-bit hashes; none is left out for
being frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellframe.llm.common import bound_batches, mix, slices, stage, word_hashes
from dwellframe.llm.components import components

WIDTH = 5
#: Similarity 75 / 100.
OVER, UNDER = 75, 100
#: A shingle held by more classes is common: its holders are compared by way of leaders and groups.
COMMON = 8
#: Members of a group whose union is stored, and queries that one task puts to a group.
GROUP, QUERIES = 64, 512
#: Rounds of leaders before the matrix.
ROUNDS = 2
#: Shingles counted at once when frequent ones are looked for, the least count that is kept, and how many
#: frequent shingles are known to all tasks. They only decide which shingles of a set come first.
COUNTED, LEAST, FREQUENT = 600_000, 3, 400_000
#: Similar sets share this part of the smaller set's size in their openings, at least; openings are as much longer.
SHARED = 16
#: Entries of the index that one task sorts at a time, about.
BUCKET = 500_000
#: A table of ids below this size is sent to all tasks.
BROADCAST_BYTES = 32 << 20


def shingle_sets(words: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words has one shingle of all of them."""
    out = []
    total = np.uint64(0x9E3779B97F4A7C15)
    n = len(words)
    rolled = np.zeros(n, np.uint64)
    for k in range(min(width, n)):
        rolled[: n - k] = mix(rolled[: n - k] + words[k:] + total)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for w in words[a:b]:
                short = mix(short + w + total)
            out.append(short)
        else:
            out.append(words[:0])
    return out


def class_of(hashes: np.ndarray) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def opening(n: int) -> int:
    """How many first shingles of a set of ``n`` are indexed. Sets of one or two have no similar set but their equals.

    Sets of ``n`` and ``m`` with at least ``c`` in common share ``k`` among the first ``n - c + k`` of the
    one and the first ``m - c + k`` of the other. Similar sets have c >= 0.75 max(n, m); k is n / 16.
    """
    return n - -(-OVER * n // UNDER) + -(-n // SHARED) if n > 2 else 0


#: SQL: least number of shared indexed shingles of a set of ``n`` with any similar set, which has 0.75 n or more.
LEAST_SHARED = f"ceil({OVER} * n / {UNDER * SHARED})"


def similar(overlap, n, m):
    return UNDER * overlap >= OVER * (n + m - overlap)


def _sets(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in slices(batch, column):
            yield part, shingle_sets(*word_hashes(part.column(column)))


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles found in several texts of one task, with their counts: at most ``FREQUENT``, sorted by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= LEAST
            return pa.RecordBatch.from_arrays([pa.array(found[many].view(np.int64)), pa.array(n[many])], ["t", "n"])

        for _, sets in _sets(batches, 0):
            held += sets
            size += sum(map(len, sets))
            if size >= COUNTED:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    counts = docs.select("text").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
    got = counts.orderBy(F.desc("n"), "t").limit(FREQUENT).toArrow()
    t, n = got.column("t").to_numpy().view(np.uint64), got.column("n").to_numpy()
    order = np.argsort(t)
    return t[order], n[order]


def _opening(hashes: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indexed shingles of a set in the common order: by known count (0 if not frequent), then hash."""
    if not (size := opening(len(hashes))):
        return hashes[:0]
    if not len(frequent):
        return hashes[:size]
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    known = np.where(frequent[at] == hashes, counts[at], 0)
    return hashes[np.lexsort((hashes, known))[:size]]


def _described(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, class, opening) of every row, staged."""
    held = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = held.value
        for part, sets in _sets(batches, 1):
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([_opening(s, frequent, counts).tobytes() for s in sets], pa.binary()),
            ], ["doc_id", "n_shingles", "class", "opening"])

    return stage(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, class long, opening binary"), "described")


def _index(described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Common shingles as (t, rep, n, comp), of classes that hold enough of them, and pairs (a, b) with rare ones.

    Entries travel packed, each class once per task, dealt by hash into buckets of about ``BUCKET``
    entries; only what is shared becomes rows: a common shingle with each holder, or the few pairs of a
    rare one, counted.
    """
    entries = described.agg(F.sum(F.expr("octet_length(opening)")) / 8).first()[0] or 0
    buckets = max(1, int(entries // BUCKET) + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows = [(r, n, x) for r, n, x in zip(*(c.to_pylist() for c in batch.columns), strict=True) if not (r in seen or seen.add(r))]
            if not rows:
                continue
            sets = [np.frombuffer(x, np.uint64) for *_, x in rows]
            t = np.concatenate(sets)
            row = np.repeat(np.arange(len(rows)), [len(s) for s in sets])
            bucket = (mix(t) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            t, row, bucket = t[order], row[order], bucket[order]
            rep, n = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
            filled, edges = np.unique(bucket, return_index=True)  # work in proportion to the batch, however many buckets there are
            made = []
            for k, a, b in zip(filled.tolist(), edges.tolist(), [*edges[1:].tolist(), len(t)], strict=True):
                own, runs = np.unique(row[a:b], return_counts=True)  # entries of a row stand together
                made.append((k, t[a:b].tobytes(), rep[own].tobytes(), n[own].tobytes(), runs.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*made, strict=True), [pa.int32()] + [pa.binary()] * 4, strict=True)],
                ["bucket", "t", "rep", "n", "runs"])

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        t, rep, n, runs = (np.concatenate([np.frombuffer(x, np.int64) for x in group[c]]) for c in ("t", "rep", "n", "runs"))
        rep, n = np.repeat(rep, runs), np.repeat(n, runs)
        order = np.lexsort((rep, t))
        t, rep, n = t[order], rep[order], n[order]
        fresh = np.insert((t[1:] != t[:-1]) | (rep[1:] != rep[:-1]), 0, True)  # other tasks may have the class too
        t, rep, n = t[fresh], rep[fresh], n[fresh]
        run = np.cumsum(np.insert(t[1:] != t[:-1], 0, True)) - 1
        held = np.bincount(run)[run]
        common = held > COMMON
        out = [pd.DataFrame({"t": t[common], "a": rep[common], "b": np.int64(0), "n": n[common], "shared": np.int64(0)})]
        rare = (held > 1) & ~common
        r, v, m = run[rare], rep[rare], n[rare]
        for k in range(1, COMMON):  # the holders of a rare shingle stand together: pairs at each distance
            one, two = slice(0, len(r) - k), slice(k, len(r))
            pair = (r[one] == r[two]) & (UNDER * np.minimum(m[one], m[two]) >= OVER * np.maximum(m[one], m[two]))
            if pair.any():
                found = pd.DataFrame({"a": v[one][pair], "b": v[two][pair], "n": np.minimum(m[one], m[two])[pair]})
                counted = found.groupby(["a", "b", "n"], as_index=False).size().rename(columns={"size": "shared"})
                out.append(counted.assign(t=np.int64(0)))
        return pd.concat(out)[["t", "a", "b", "n", "shared"]]

    openings = described.filter("octet_length(opening) > 0").select("class", "n_shingles", "opening")
    packed = openings.mapInArrow(pack, "bucket int, t binary, rep binary, n binary, runs binary")
    made = stage(packed.groupBy("bucket").applyInPandas(shared, "t long, a long, b long, n long, shared long"), "index")
    index = made.filter("shared = 0").select("t", F.col("a").alias("rep"), "n", F.col("a").alias("comp"))
    held = stage(index.groupBy("rep").agg(F.count("*").alias("held"), F.first("n").alias("n")), "held")
    # pairs with a rare shingle: what they share of these, and could share of common ones
    pairs = made.filter("shared > 0").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.first("n").alias("n"))
    sides = [held.select(F.col("rep").alias(k), F.col("held").alias(f"{k}_held")) for k in "ab"]
    both = pairs.join(sides[0], "a", "left").join(sides[1], "b", "left")
    could = F.col("shared") + F.least(F.coalesce("a_held", F.lit(0)), F.coalesce("b_held", F.lit(0)))
    rare = both.filter(could >= F.ceil(F.col("n") / SHARED)).select("a", "b")
    enough = held.filter(f"held >= {LEAST_SHARED}").select("rep")
    return index.join(enough, "rep", "leftsemi"), stage(rare, "rare")


def _needed_sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(rep, set): the whole sets of the classes in ``needed`` (rep, doc_id), staged.

    Texts are found by id; where several texts have one id, their class tells which is meant.
    """
    ids = needed.select(F.col("doc_id").alias("id")).distinct()
    few = needed.count() * 8 < BROADCAST_BYTES
    texts = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, F.col("doc_id").eqNullSafe(F.col("id")), "leftsemi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, 0):
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["class", "set"])

    made = texts.select("text").mapInArrow(run, "class long, set binary")
    found = needed.select("rep").join(made, F.col("rep") == F.col("class"))
    return stage(found.groupBy("rep").agg(F.first("set").alias("set")), "sets")


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0


def _near(n: str, m: str) -> str:
    """Sizes that allow similarity."""
    return f"{UNDER} * least({n}, {m}) >= {OVER} * greatest({n}, {m})"


def _with_components(index: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of shingles whose holders are in more than one component."""
    joined = index.drop("comp").join(found, F.col("rep") == F.col("node"), "left").select("t", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    mixed = joined.groupBy("t").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("t")
    left = joined.join(mixed, "t")
    # a similar set of another component shares unsettled shingles only, and so many of them
    enough = left.groupBy("rep").agg(F.count("*").alias("held"), F.first("n").alias("n")).filter(f"held >= {LEAST_SHARED}").select("rep")
    return stage(left.join(enough, "rep", "leftsemi"), "unsettled")


def _from_leaders(index: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each shingle's leader with its other holders of possible size, in other components."""
    order = "rep" if turn == 0 else f"xxhash64(rep, {turn})"
    leaders = index.groupBy("t").agg(F.expr(f"min_by(struct(rep, n, comp), struct({order}, rep))").alias("leader"))
    joined = index.join(leaders, "t").filter("leader.rep <> rep and leader.comp <> comp").filter(_near("n", "leader.n"))
    return joined.select(F.least("rep", "leader.rep").alias("a"), F.greatest("rep", "leader.rep").alias("b")).distinct()


def _grouped(near: DataFrame) -> DataFrame:
    """(rep, g): the group of each class in ``near`` (rep, leader); classes of one leader, dealt into groups of about ``GROUP``."""
    sizes = near.groupBy("leader").agg(F.ceil(F.count("*") / GROUP).alias("chunks"))
    chunk = F.pmod(F.xxhash64("rep"), F.col("chunks"))
    return stage(near.join(sizes, "leader").select("rep", F.xxhash64("leader", chunk).alias("g")), "groups")


def open_group(members: list[tuple[int, np.ndarray]], queries: list[tuple[int, np.ndarray]], among: bool) -> list[tuple[int, int]]:
    """Links of a group: of queries with members, and ``among`` members; enough to connect what is similar."""
    up: dict[int, int] = {}

    def top(c: int) -> int:
        while c in up:
            c = up[c]
        return c

    links = []

    def compare(rep: int, x: np.ndarray, others: list[tuple[int, np.ndarray]]) -> None:
        for other, y in others:
            if UNDER * min(len(x), len(y)) < OVER * max(len(x), len(y)) or top(rep) == top(other):
                continue
            if similar(_overlap(x, y), len(x), len(y)):
                links.append((rep, other))
                up[top(rep)] = top(other)

    if among:
        for k, (rep, x) in enumerate(members):
            compare(rep, x, members[:k])
    union = np.unique(np.concatenate([y for _, y in members])) if queries and members else np.zeros(0, np.uint64)
    for rep, x in queries:
        if UNDER * _overlap(x, union) >= OVER * len(x):
            compare(rep, x, members)
    return links


def _opened(groups: DataFrame, queries: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) found in ``groups`` (rep, g), among members and with ``queries`` (rep, g) of other groups.

    A group with many queries is opened in several tasks, each with some of them and all members, of which there are few.
    """
    queries = queries.distinct()
    asked = queries.groupBy("g").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
    members = groups.join(asked, "g", "left").join(sets, "rep")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    asking = queries.join(asked, "g").join(sets, "rep")
    rows = members.select("g", parts, "rep", "set", F.lit(False).alias("asks")).unionByName(
        asking.select("g", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part"), "rep", "set", F.lit(True).alias("asks"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, ([], [])

        def links() -> pa.RecordBatch:
            found = open_group(sorted(sides[0], key=lambda m: m[0]), sides[1], at[1] == 0)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for g, part, rep, x, asks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (g, part) != at:
                    if at and len(sides[0]) + len(sides[1]) > 1:
                        yield links()
                    at, sides = (g, part), ([], [])
                sides[asks].append((rep, np.frombuffer(x, np.uint64)))
        if at:
            yield links()

    # a group's rows stand together, so a task holds one group at a time
    return rows.repartition("g", "part").sortWithinPartitions("g", "part").mapInArrow(run, "a long, b long")


def _from_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between classes that ``pairs`` (a, b) say may be similar: each joins its least partner's group, and asks those of its others."""
    sides = pairs.select(F.col("a").alias("rep"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    groups = _grouped(sides.groupBy("rep").agg(F.least(F.min("other"), F.col("rep")).alias("leader")))
    of = [groups.select(F.col("rep").alias(k), F.col("g").alias(f"{k}_g")) for k in "ab"]
    foreign = pairs.join(of[0], "a").join(of[1], "b").filter("a_g <> b_g")
    return _opened(groups, foreign.select(F.col("b").alias("rep"), F.col("a_g").alias("g")), sets)


def _from_matrix(index: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components: the matrix of shingles and groups says which groups' members are queries for which."""
    leaders = index.groupBy("t").agg(F.min("rep").alias("leader"))
    groups = _grouped(index.join(leaders, "t").groupBy("rep").agg(F.min("leader").alias("leader")))
    cells = index.select("t", "rep", "n", "comp").join(groups, "rep")
    matrix = stage(cells.groupBy("t", "g").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("comp").alias("lo"), F.max("comp").alias("hi")), "matrix")
    other = matrix.select("t", *(F.col(c).alias(f"o_{c}") for c in ("g", "least", "most", "lo", "hi")))
    meets = matrix.join(other, "t").filter("g < o_g and not (lo = hi and o_lo = o_hi and lo = o_lo)")
    meets = meets.filter(f"{UNDER} * o_most >= {OVER} * least and {UNDER} * most >= {OVER} * o_least")
    counted = meets.groupBy("g", "o_g").agg(F.count("*").alias("held"), F.greatest(F.min("least"), F.min("o_least")).alias("n"))
    met = counted.filter(f"held >= {LEAST_SHARED}").select(F.col("g").alias("one"), F.col("o_g").alias("two"))
    queries = met.join(groups, F.col("one") == F.col("g")).select("rep", F.col("two").alias("g"))
    return _opened(groups, queries, sets)


def _solved(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row as (doc_id, n_shingles, class, ..) and every class as (class, comp, its least doc_id), both staged."""
    bound_batches(docs.sparkSession)
    described = _described(docs)
    classes = described.filter("class is not null").groupBy(F.col("class").alias("rep")).agg(F.min("doc_id").alias("doc_id"))
    index, rare = _index(described)
    wanted = index.select("rep").union(rare.select(F.explode(F.array("a", "b")).alias("rep"))).distinct()
    sets = _needed_sets(docs, classes.join(wanted, "rep", "leftsemi"))
    found = components(_from_pairs(rare, sets))
    changed = True
    for turn in range(ROUNDS + 1):
        if changed:
            index = _with_components(index, found)
        if index.isEmpty():
            break
        fresh = stage(_from_pairs(_from_leaders(index, turn), sets) if turn < ROUNDS else _from_matrix(index, sets), "pairs")
        changed = not fresh.isEmpty()
        if changed:  # what was connected before is a star by now
            found = stage(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(fresh)), "found")
    joined = classes.join(found, F.col("rep") == F.col("node"), "left")
    return described, stage(joined.select(F.col("rep").alias("class"), F.coalesce("component", "rep").alias("comp"), "doc_id"), "nodes")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id reachable by links, itself included) of every row.

    Two texts link when their sets' Jaccard similarity is 0.75 or more. A null or empty text has an empty
    set, links with nothing and is its own component. Repeated rows keep a row each and share a
    component. A null id stays null and is passed over when the least id is taken (null if there is no
    other). Other columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    described, nodes = _solved(docs)
    least = nodes.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_class = nodes.join(least, "comp").select(F.col("class").alias("of"), "component_id")
    joined = described.join(by_class, F.col("class") == F.col("of"), "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that with the least id, of equal ids the least class. Columns unchanged.

    Of wholly repeated rows one stays. Rows without words stay. A null id goes before any other id; in a
    component of null ids alone one row stays.
    """
    described, nodes = _solved(docs)
    best = nodes.groupBy("comp").agg(F.expr("min_by(class, struct(doc_id is null, doc_id, class))").alias("best"))
    chosen = nodes.join(best, "comp").filter("class = best").select(F.col("class").alias("of"), F.col("doc_id").alias("id"))
    rows = described.filter("class is not null").groupBy("doc_id", "class").count()
    match = (F.col("class") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id"))
    gone = stage(rows.join(chosen, match, "leftanti").select(F.col("doc_id").alias("id"), F.col("class").alias("of")), "gone")
    again = stage(rows.filter("count > 1").join(chosen, match, "leftsemi").select(F.col("doc_id").alias("id"), F.col("class").alias("of")), "again")

    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, at):
            made = pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, "__class"])

    classed = docs.mapInArrow(run, _added(docs))
    here = lambda other: F.col("__class").eqNullSafe(other["of"]) & classed["doc_id"].eqNullSafe(other["id"])
    small = lambda df: F.broadcast(df) if df.count() * 40 < BROADCAST_BYTES else df
    left = classed.join(small(gone), here(gone), "leftanti")
    if again.isEmpty():
        return left.select(*docs.columns)
    few = small(again)
    twice = left.join(few, here(again), "leftsemi").dropDuplicates(["doc_id", "__class"])
    return left.join(few, here(again), "leftanti").union(twice).select(*docs.columns)


def _added(docs: DataFrame):
    from pyspark.sql import types as T

    return T.StructType([*docs.schema.fields, T.StructField("__class", T.LongType())])
