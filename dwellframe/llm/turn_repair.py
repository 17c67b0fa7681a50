r"""Conversation structure repair: the cheapest edits that give every conversation a sound order of roles.

Wanted are roles whose initials read ``(s?(ua)+)?``. A row can be kept (K), given the role user or assistant (R), deleted
(D), or a turn without text can be inserted (I); blank rows and rows seen before must go. :class:`Survivors` finds the
cheapest edits by the Viterbi algorithm over four states (nothing yet, after s, after u, after a). Each state's best edits
are a branch of a tree of back pointers; equal costs go to the branch whose edits sort first, found by going back to
where the two branches part. As soon as all states' branches share a node, the edits up to it are settled: they are
emitted and their nodes and texts dropped. So memory holds the unsettled edits only, a few rows unless costs stay tied.

Rows are judged (blank, repeated, truncated) in the JVM, dealt by conversation, sorted, and walked through in order;
neither a conversation nor its texts are gathered.

Nulls: a null role or text is one space, null conversations are one conversation, null turns come first and count for no
gap. Rows of one turn number are ordered by role and text. An empty table gives no rows. Columns other than the four
(and ``dropped``) are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.llm.chat_format import records
from dwellframe.llm.common import bound_batches

SPACE = " \t\n\x0b\f\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a user or assistant turn leads to; whether a turn is one or the other follows from the state before.
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
SOUND_PAIRS = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
MOST = (1 << 63) - 1


def text_of(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults put in by a hash of conversation and turn.

    Of 20 remainders of crc32(``conv_id:turn``), 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats
    it, 4 makes its role user. Dropped rows stay as rows with ``dropped`` true, so that no conversation is lost.
    """
    kind = F.crc32(F.concat_ws(":", text_of(F.col("conv_id")), text_of(F.col("turn"))).cast("binary")) % 20
    role, text = text_of(F.col("role")), text_of(F.col("text"))
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("__copy"),
    ).drop("__copy")


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` dealt by conversation, in order, each with its first fault: blank, duplicate, truncated or null.

    A row is a duplicate if its role and text occur earlier in its conversation. The window needs the rows of one
    conversation in one partition, as the walk does, so there is one shuffle for both; it numbers rows as they pass.
    """
    dropped = F.col("dropped") if "dropped" in rows.columns else F.lit(False)
    dealt = rows.select(
        "conv_id", "turn", text_of(F.col("role")).alias("role"), text_of(F.col("text")).alias("text"), F.coalesce(dropped, F.lit(False)).alias("dropped")
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "text", "dropped").orderBy(F.col("turn").asc_nulls_first())
    said = F.rtrim("text", F.lit(SPACE))
    fault = (
        F.when(said == "", "blank").when(F.col("__nth") > 1, "duplicate").when(~F.right(said, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    return (
        dealt.withColumn("__nth", F.row_number().over(same))
        .select("conv_id", "turn", "role", "text", "dropped", F.when(~F.col("dropped"), fault).alias("fault"), "__nth")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "__nth")
        .drop("__nth")
    )


class Node:
    """An edit, linked to the one before it. ``jump`` points further back, so that two branches are compared in few steps."""

    __slots__ = ("parent", "jump", "depth", "edit", "made", "children", "alive")

    def __init__(self, parent: Node | None, edit: str = "", made: tuple[str, str] | None = None) -> None:
        self.parent, self.edit, self.made = parent, edit, made
        self.children: list[Node] = []  # their number, with ``alive``, is the node's reference count
        self.alive = False  # the end of a state's branch
        if parent is None:
            self.jump, self.depth = self, 0
        else:
            far = parent.jump
            self.depth = parent.depth + 1
            self.jump = far.jump if parent.depth - far.depth == far.depth - far.jump.depth else parent


def sorts_before(a: Node, b: Node) -> bool:
    """Whether the edits up to ``a`` sort before those up to ``b``; the whole of both branches down to where they part."""
    x, y = a, b
    while x.depth > y.depth:
        x = x.jump if x.jump.depth >= y.depth else x.parent
    while y.depth > x.depth:
        y = y.jump if y.jump.depth >= x.depth else y.parent
    if x is y:
        return a.depth < b.depth
    while x.parent is not y.parent:
        x, y = (x.parent, y.parent) if x.jump is y.jump else (x.jump, y.jump)
    return x.edit < y.edit


class Survivors:
    """The cheapest edits to each state after the rows read so far."""

    def __init__(self) -> None:
        self.root = Node(None)
        self.best: dict[int, tuple[int, Node]] = {}
        self._settle(self._inserted({NOTHING: (0, self.root)}))

    @staticmethod
    def _offer(found: dict, state: int, cost: int, node: Node) -> None:
        known = found.get(state)
        if known is None or cost < known[0] or (cost == known[0] and sorts_before(node, known[1])):
            found[state] = cost, node

    def _inserted(self, found: dict) -> dict:
        """``found`` with inserted turns. No insertion leads back to where it pays, so the cheaper of u and a goes first."""

        def insert(state: int) -> None:
            if state in found:
                cost, node = found[state]
                self._offer(found, NEXT[state], cost + INSERT, Node(node, "I", (ROLE[NEXT[state]], "")))

        insert(NOTHING)
        insert(SYSTEM)
        insert(USER if USER in found and (ASSISTANT not in found or found[USER][0] <= found[ASSISTANT][0]) else ASSISTANT)
        # Nothing that "nothing yet" or "after s" can still become is closed to "after a", but for a leading s, worth one deletion.
        if ASSISTANT in found:
            paid = found[ASSISTANT][0]
            if NOTHING in found and found[NOTHING][0] > paid + DELETE:
                del found[NOTHING]
            if SYSTEM in found and found[SYSTEM][0] > paid:
                del found[SYSTEM]
        return found

    def add(self, role: str, text: str, must_go: bool, truncated: bool) -> list[Node]:
        """Read one row; returns the edits that it settled, in order."""
        found: dict[int, tuple[int, Node]] = {}
        for state, (cost, node) in self.best.items():
            self._offer(found, state, cost + DELETE, Node(node, "D"))
            if must_go:
                continue
            late, to, initial = cost + TRUNCATED * truncated, NEXT[state], role[:1]
            if initial == "s" and state == NOTHING:
                self._offer(found, SYSTEM, late, Node(node, "K", (role, text)))
            if initial == ROLE[to][0]:
                self._offer(found, to, late, Node(node, "K", (role, text)))
            self._offer(found, to, late + REROLE, Node(node, "R", (ROLE[to], text)))
        return self._settle(self._inserted(found))

    def _settle(self, found: dict[int, tuple[int, Node]]) -> list[Node]:
        """Hang the new branches into the tree, let go of those that died, and emit what all that are left share."""
        old = [node for _, node in self.best.values()]
        for node in old:
            node.alive = False
        for _, node in found.values():
            node.alive = True
            while node is not self.root and node not in node.parent.children:
                node.parent.children.append(node)
                node = node.parent
        for node in old:
            while node is not self.root and not node.alive and not node.children:
                node.parent.children.remove(node)
                node = node.parent
        self.best = found
        settled = []
        while not self.root.alive and len(self.root.children) == 1:
            child = self.root.children[0]
            self.root.children, child.parent = [], None
            settled.append(child)
            self.root = child
        return settled

    def finish(self) -> tuple[int, list[Node]]:
        """The least cost of a sound whole, and the edits not emitted yet."""
        found: dict[int, tuple[int, Node]] = {}
        for state in (NOTHING, ASSISTANT):
            if state in self.best:
                self._offer(found, 0, *self.best[state])
        cost, node = found[0]
        rest = []
        while node is not self.root:
            rest.append(node)
            node = node.parent
        return cost, rest[::-1]


class Repair:
    """One conversation, row by row; ``out`` gets its edits as they are settled, then its figures."""

    def __init__(self, conv_id, out: list[tuple]) -> None:
        self.conv_id, self.out, self.survivors, self.steps = conv_id, out, Survivors(), 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.turns = 0
        self.least = self.last = self.initial = None

    def _emit(self, nodes: list[Node]) -> None:
        for node in nodes:
            role, text = node.made or (None, None)
            self.out.append((self.conv_id, self.steps, node.edit, role, text, *[None] * 6))
            self.steps += 1
            node.made = None  # later nodes may point here for a while

    def add(self, turn: int | None, role: str, text: str, dropped: bool, fault: str | None) -> None:
        if dropped:
            return
        if turn is not None and turn != self.last:
            self.least = turn if self.least is None else self.least
            self.last, self.turns = turn, self.turns + 1
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in SOUND_PAIRS
        self.initial = initial
        self._emit(self.survivors.add(role, text, fault in ("blank", "duplicate"), fault == "truncated"))

    def finish(self) -> None:
        cost, rest = self.survivors.finish()
        self._emit(rest)
        gaps = 0 if self.least is None else min(self.last - self.least + 1 - self.turns, MOST)
        self.out.append((self.conv_id, self.steps, None, None, None, gaps, *self.counts.values(), self.illegal, cost))


def repair_turns(rows: DataFrame) -> DataFrame:
    """The edits of each conversation of ``rows`` (conv_id, turn, role, text), in order, then one row of its figures.

    Edit rows: conv_id, step from 0, edit (K, R, D or I), role and text of the repaired turn (null if deleted). Figure
    rows have a null edit and the number of steps, with gaps (turn numbers missing between the least and the largest),
    blank, duplicate and truncated rows by first fault, illegal neighbours and the cost. Rows with ``dropped`` true only
    name their conversation. A conversation's rows lie in one partition in this order.
    """
    bound_batches(rows.sparkSession)
    schema = T.StructType([
        T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("step", T.LongType()),
        *[T.StructField(n, T.StringType()) for n in ("edit", "role", "text")],
        *[T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    ])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at: Repair | None = None
        for batch in batches:
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at is None or conv_id != at.conv_id:
                    if at:
                        at.finish()
                    at = Repair(conv_id, out)
                at.add(*row)
            yield from records(out, schema)
            out.clear()
        if at:
            at.finish()
            yield from records(out, schema)

    return judged(rows).mapInArrow(walk, schema)


def audits(repaired: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair_turns`: its figures, its edits as one text, and the digest of its turns."""
    kept = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([
        repaired.schema["conv_id"], *[repaired.schema[n] for n in kept], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, turns, first = bytearray(), hashlib.sha256(), True
        for batch in batches:
            done = []
            for conv_id, edit, role, text, *figures in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if edit is None:
                    done.append((conv_id, *figures, edits.decode(), turns.hexdigest()))
                    edits, turns, first = bytearray(), hashlib.sha256(), True
                    continue
                edits += edit.encode()
                if role is not None:
                    turns.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            yield from records(done, schema)

    return repaired.select("conv_id", "edit", "role", "text", *kept).mapInArrow(close, schema)
