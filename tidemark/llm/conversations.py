"""Repair of the structure of conversations by a Viterbi search whose survivors coalesce.

The rows of a conversation, in order of their turns, are edited so that their roles read
``(s?(ua)+)?``: an optional system row, then user and assistant in turn.  Keeping a row costs
nothing, changing its role to user or assistant ``REROLE``, deleting it ``DELETE`` (blank and
repeated rows must go), inserting a row without text ``INSERT``; a truncated row that stays costs
``TRUNCATED`` more.  Of the cheapest edits the one whose initials come first in ASCII is taken.

The search keeps one survivor for each state that the roles so far can be in.  Survivors point
into a tree of edits.  A node counts who needs it (children and survivors) and is freed when
nobody does; as long as the root has a single child and no survivor, all survivors share that
edit, and it is emitted.  Of two equally cheap ways into a state the complete edits back to their
common ancestor are compared.  Survivors that can no longer be part of a cheapest repair are
dropped, so that the tree holds only what is really undecided, however long the conversation is.

A row's own faults need the row alone, and whether it repeats an earlier one is found by
aggregation over (conversation, role, text), in which copies are added up before they move.  Rows
are then dealt by conversation and sorted, and a task streams through them: it holds the tree, a
running SHA-256 and the initials of the edits of the conversation at hand.  A conversation stays
in one task, because the digest over its repaired rows can only be taken in their order.

Edge cases: a missing role or text is one space, as is a missing id or turn in the text that
decides the damage.  Rows without a conversation id form one conversation, returned with a missing
id.  Rows without a turn come first (they sort as the least long); rows of one turn are ordered by
role and text.  A conversation of which no row is left has zeros, an empty audit and the digest of
the empty string; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ship
from tidemark.session import durable

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANK = " \t\n\x0b\x0c\r"
_FIRST_TURN = -(2**63)
_REPAIRED = "key long, missing boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

# States: nothing yet, system, user or assistant last; and what a row of each role leads to.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {
    NOTHING: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
FINAL = (NOTHING, ASSISTANT)
WRITTEN = {"u": "user", "a": "assistant"}
# A repair from the first state costs at most so much less than one from the second: the same edits
# serve, a system row that cannot be kept is deleted, a missing user or assistant row inserted.
AHEAD = {
    (NOTHING, ASSISTANT): DELETE,
    (NOTHING, USER): INSERT + DELETE,
    (SYSTEM, ASSISTANT): 0,
    (SYSTEM, USER): INSERT,
}


def damage(rows: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) after the damage that the checksum of each row's id and turn decides."""
    space = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), space) for c in (conversation, turn)]
    kind = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20
    body, who = F.coalesce(F.col(text).cast("string"), space), F.coalesce(F.col(role).cast("string"), space)
    damaged = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(body, "[.!?]", "")).otherwise(body)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select(
        F.col(conversation).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(who).alias("role"), damaged.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")


class Node:
    """One edit; ``needed`` counts the children and survivors that hang on it."""

    __slots__ = ("parent", "edit", "role", "text", "children", "survivors", "depth")

    def __init__(self, parent: Node | None, edit: str = "", role: str | None = None, text: str = ""):
        self.parent, self.edit, self.role, self.text = parent, edit, role, text
        self.children: list[Node] = []
        self.survivors = 0
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.children.append(self)

    @property
    def needed(self) -> int:
        return len(self.children) + self.survivors


def precedes(a: Node, more_a: str, b: Node, more_b: str) -> bool:
    """Whether the edits up to ``a`` and then ``more_a`` come before those up to ``b`` and ``more_b``."""
    left, right = [more_a], [more_b]
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit)
            a = a.parent
        else:
            right.append(b.edit)
            b = b.parent
    return "".join(reversed(left)) < "".join(reversed(right))


class Repair:
    """The search over one conversation; rows are given in order, ``finish`` gives the answer."""

    def __init__(self) -> None:
        self.root = Node(None)
        self.audit: list[str] = []
        self.digest, self.written = hashlib.sha256(), False
        self.survivors: dict[int, tuple[int, Node]] = {}
        self._take({NOTHING: (0, self.root, "", None, "")})
        self._insert()

    def _take(self, chosen: dict[int, tuple]) -> None:
        """Put (cost, parent, edit, role, text) of each state in the place of the survivors."""
        new = {}
        for state, (cost, parent, edit, role, text) in chosen.items():
            node = Node(parent, edit, role, text) if edit else parent
            node.survivors += 1
            new[state] = (cost, node)
        old, self.survivors = self.survivors, new
        for _, node in old.values():
            self._leave(node)
        while len(self.root.children) == 1 and not self.root.survivors:
            self.root = self.root.children[0]
            self.root.parent = None
            self._emit(self.root)

    def _leave(self, node: Node) -> None:
        node.survivors -= 1
        while not node.needed and node.parent:
            parent = node.parent
            parent.children.remove(node)
            node = parent

    def _emit(self, node: Node) -> None:
        self.audit.append(node.edit)
        if node.role is not None:
            self.digest.update(("\n" * self.written + f"{node.role}:{node.text}").encode())
            self.written = True

    def _offer(self, chosen: dict[int, tuple], state: int, cost: int, parent: Node, edit: str, role: str | None, text: str) -> None:
        held = chosen.get(state)
        if held is None or cost < held[0] or cost == held[0] and precedes(parent, edit, held[1], held[2]):
            chosen[state] = (cost, parent, edit, role, text)

    def _insert(self) -> None:
        """Rows without text may stand before the next one: states that are cheaper so are reached so."""
        changed = True
        while changed:
            changed = False
            for state in list(self.survivors):
                for initial, following in NEXT[state].items():
                    if initial in WRITTEN and self._extend(state, following, WRITTEN[initial]):
                        changed = True

    def _extend(self, state: int, following: int, role: str) -> bool:
        cost, node = self.survivors[state]
        cost, held = cost + INSERT, self.survivors.get(following)
        if held and (held[0] < cost or held[0] == cost and not precedes(node, "I", held[1], "")):
            return False
        new = Node(node, "I", role)
        new.survivors = 1
        self.survivors[following] = (cost, new)
        if held:
            self._leave(held[1])
        return True

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        chosen: dict[int, tuple] = {}
        extra = TRUNCATED if truncated else 0
        for state, (cost, node) in self.survivors.items():
            self._offer(chosen, state, cost + DELETE, node, "D", None, "")
            if must_go:
                continue
            for initial, following in NEXT[state].items():
                if role[:1] == initial:
                    self._offer(chosen, following, cost + extra, node, "K", role, text)
                if initial in WRITTEN:
                    self._offer(chosen, following, cost + extra + REROLE, node, "R", WRITTEN[initial], text)
        for (state, other), most in AHEAD.items():
            if state in chosen and other in chosen and chosen[state][0] > chosen[other][0] + most:
                del chosen[state]
        self._take(chosen)
        self._insert()

    def held(self) -> int:
        """Edits that are not decided yet."""
        count, open_ = 0, [self.root]
        while open_:
            node = open_.pop()
            open_ += node.children
            count += len(node.children)
        return count

    def finish(self) -> tuple[int, str, str]:
        """(cost, audit, digest) of the cheapest repair."""
        best = None
        for state in FINAL:
            if state in self.survivors:
                cost, node = self.survivors[state]
                if best is None or cost < best[0] or cost == best[0] and precedes(node, "", best[1], ""):
                    best = cost, node
        cost, node = best
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self._emit(node)
        return cost, "".join(self.audit), self.digest.hexdigest()


LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class Conversation:
    """Counts and repair of the conversation at hand."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.repair, self.last = conv, Repair(), None
        self.faults, self.illegal = [0, 0, 0], 0
        self.turns, self.least, self.most = 0, 0, 0

    def add(self, turn: int, role: str, text: str, blank: bool, repeated: bool, truncated: bool) -> None:
        last = self.last
        if turn != _FIRST_TURN and (last is None or turn != last[0]):
            self.least, self.most = self.least if self.turns else turn, turn
            self.turns += 1
        if last is not None and (last[1][:1], role[:1]) not in LEGAL:
            self.illegal += 1
        duplicate = repeated or last == (turn, role, text)
        fault = 0 if blank else 1 if duplicate else 2 if truncated else None
        if fault is not None:
            self.faults[fault] += 1
        self.repair.row(role, text, fault in (0, 1), fault == 2)
        self.last = (turn, role, text)

    def answer(self) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults, self.illegal, *self.repair.finish())


def repaired(rows: Iterable[tuple]) -> Iterator[tuple]:
    """One answer for each conversation of rows (conv, turn, role, text, blank, repeated, truncated) in order.

    ``repeated`` tells of rows of earlier turns; equal rows of one turn stand next to each other.
    """
    now = None
    for conv, *row in rows:
        if now is None or conv != now.conv:
            if now:
                yield now.answer()
            now = Conversation(conv)
        now.add(*row)
    if now:
        yield now.answer()


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    names = [part.split()[0] for part in _REPAIRED.split(", ")]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held))
        kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for conv, *rest in repaired(rows):
        held.append((conv, conv is None, *rest))
        if len(held) == 5_000:
            yield batch()
            held = []
    if held:
        yield batch()


def repair(rows: DataFrame) -> DataFrame:
    """Counts of faults and the cheapest repair of every conversation of (conv, turn, role, text).

    Gives (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).
    """
    ship(rows.sparkSession)
    turn = F.coalesce("turn", F.lit(_FIRST_TURN))
    # 16 bytes stand for a role and a text; copies meet before they move.
    content = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    own = rows.select("conv", turn.alias("turn"), "role", "text", content.alias("content"))
    seen = own.groupBy("conv", "content").agg(F.min("turn").alias("first"), F.max("turn").alias("last"))
    seen = durable(seen.where("first < last").drop("last"))
    same = (F.col("o.conv").eqNullSafe(F.col("s.conv"))) & (F.col("o.content") == F.col("s.content"))
    ending = F.right(F.rtrim(F.col("text"), F.lit(BLANK)), F.lit(1))
    faults = own.alias("o").join(seen.alias("s"), same, "left").select(
        "o.conv", "o.turn", "o.role", "o.text",
        (F.rtrim(F.col("text"), F.lit(BLANK)) == "").alias("blank"),
        F.coalesce(F.col("o.turn") > F.col("s.first"), F.lit(False)).alias("repeated"),
        (~ending.isin(".", "!", "?")).alias("truncated"),
    )
    dealt = faults.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    found = dealt.mapInArrow(_run, _REPAIRED)
    conv = F.when(F.col("missing"), None).otherwise(F.col("key")).alias("conv")
    return found.select(conv, *[part.split()[0] for part in _REPAIRED.split(", ")[2:]])


def damage_and_repair(rows: DataFrame, conversation: str = "conv_id", **columns: str) -> DataFrame:
    """The repair of every conversation after its damage; one without rows has zeros and an empty audit."""
    every = rows.select(F.col(conversation).cast("long").alias("every")).distinct()
    found = repair(damage(rows, conversation=conversation, **columns))
    joined = every.join(found, F.col("every").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        F.col("every").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", empty).alias("repaired_sha256"),
    )
