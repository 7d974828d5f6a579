r"""Repair of conversations: the cheapest edits after which roles go ``(s?(ua)+)?``, by a Viterbi search that emits edits as soon as they are certain.

1. **Faults.** A row is blank (no ``[^\x20\x09-\x0D]``), else a duplicate (its role and text came earlier), else truncated (the last such character is not ``[.!?]``), else
   sound. Rows come by turn, nulls first; those of one turn by role and text. Which texts a conversation repeats in later turns is found by an
   aggregation, combined in the tasks, and a join; equal rows of one turn are neighbours.
2. **Edits.** Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (of a user or assistant row without text, anywhere) 2. Blank and duplicate rows must go, a truncated
   row that stays adds 1. Of the cheapest edits those count whose initials are least in ASCII.
3. **Search.** States are what was built so far: nothing, ``s``, ending in ``u``, ending in ``a``. Per state survives the best way to it, as a leaf of a tree of back pointers.
   A node counts the nodes that point to it and is freed with the last one; once all survivors share an ancestor, the edits up to it are emitted. A survivor
   goes when another could do all that it can for less. Ties are settled by the complete edits since the shared ancestor: as every way to a state has edited the same rows,
   none is the beginning of another, so their order is kept as a rank and a tie costs no second look.
4. **Audit.** Counts, cost, initials and hash of the repaired rows are folded from the stream of edits, in the same task and without holding a conversation.

A conversation is read as a stream sorted by Spark, which spills: a task holds rows whose edits are still open, not the conversation. Those are few rows as a rule. A conversation that
leaves two ways equally good for long (say, user rows alone) holds as many rows as that lasts. The stream of one conversation goes through one task, as its hash and its initials
have an order; what is row by row, or looks for repeats, is spread whatever its size.

Edge cases: null roles and texts are read as one space, null ids and turns as one space in the key of the damage; null ids are one conversation; rows without a turn come first and make no
gaps; rows of one turn go by role and text; repeated rows are duplicates; a conversation without rows has empty edits; texts may have any length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bizmetrics.llm.common import ship_package, slices

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What is built so far: nothing, s, ending in u, ending in a.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWING = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The role that may be given or inserted, and what it leads to.
MADE = {EMPTY: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: How many rows have to be inserted at the end.
LACKING = {EMPTY: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: EXTRA[p, q]: for at most so much more, p can do all that q can.
EXTRA = {
    (EMPTY, SYSTEM): 0, (EMPTY, USER): 2, (EMPTY, ASSISTANT): 4,
    (SYSTEM, EMPTY): 4, (SYSTEM, USER): 2, (SYSTEM, ASSISTANT): 4,
    (USER, EMPTY): 5, (USER, SYSTEM): 2, (USER, ASSISTANT): 2,
    (ASSISTANT, EMPTY): 3, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): 2,
}
LEGAL = {"su", "ua", "au"}

#: A row as the search takes it: (turn, role, text, fault).
Row = tuple[int | None, str, str, str | None]
#: An edit: (initial, turn, role before, role, text, fault); an inserted row has no turn, role before and fault, a deleted one no role.
Edit = tuple[str, int | None, str | None, str | None, str | None, str | None]

SLICE_BYTES = 4_000_000
OUT_ROWS, OUT_BYTES = 5_000, 8_000_000


class _Node:
    """A row's edits on the way to a state. ``kids`` are the nodes that point back here, so their number is the reference count."""

    __slots__ = ("parent", "kids", "state", "edits", "row")

    def __init__(self, parent: _Node | None, state: int, edits: str, row: Row | None) -> None:
        self.parent, self.kids, self.state, self.edits, self.row = parent, [], state, edits, row


class Search:
    """Take rows one by one; give back the edits that all survivors share."""

    def __init__(self) -> None:
        self.root = _Node(None, EMPTY, "", None)
        self.survivors: dict[int, tuple[int, int, _Node]] = {EMPTY: (0, 0, self.root)}  # cost, rank, leaf
        self.open_rows = 0

    def take(self, row: Row) -> list[Edit]:
        _, role, _, fault = row
        best: dict[int, tuple[int, int, str, _Node]] = {}

        def offer(state: int, *way) -> None:
            if state not in best or way[:3] < best[state][:3]:
                best[state] = way

        must_go = fault in ("blank", "duplicate")
        stays = TRUNCATED if fault == "truncated" else 0
        for state, (cost, rank, leaf) in self.survivors.items():
            for inserted in ("", "I", "II"):
                offer(state, cost + DELETE, rank, inserted + "D", leaf)
                made = MADE[state][1]
                if not must_go:
                    kept = FOLLOWING.get((state, role[:1]))
                    if kept is not None:
                        offer(kept, cost + stays, rank, inserted + "K", leaf)
                    offer(made, cost + REROLE + stays, rank, inserted + "R", leaf)
                state, cost = made, cost + INSERT

        alive = {q: way for q, way in best.items() if not any(best[p][0] + EXTRA[p, q] < way[0] for p in best if p != q)}
        old = [leaf for _, _, leaf in self.survivors.values()]
        self.survivors = {}
        for rank, (state, (cost, _, edits, leaf)) in enumerate(sorted(alive.items(), key=lambda item: item[1][1:3])):
            node = _Node(leaf, state, edits, row)
            leaf.kids.append(node)
            self.survivors[state] = cost, rank, node
        self.open_rows += 1
        for leaf in old:
            self._free(leaf)
        return self._shared()

    def end(self) -> list[Edit]:
        """The edits still open, once there are no more rows."""
        ways = ((cost + INSERT * LACKING[state], rank, "I" * LACKING[state], state, leaf) for state, (cost, rank, leaf) in self.survivors.items())
        _, _, edits, state, leaf = min(ways, key=lambda way: way[:3])
        last = _Node(leaf, ASSISTANT if edits else state, edits, None)
        leaf.kids.append(last)
        for _, _, other in self.survivors.values():
            self._free(other)
        self.survivors = {}
        return self._shared()

    def _free(self, node: _Node) -> None:
        while not node.kids and node.parent is not None:
            node.parent.kids.remove(node)
            node = node.parent

    def _shared(self) -> list[Edit]:
        out: list[Edit] = []
        while len(self.root.kids) == 1:
            state, node = self.root.state, self.root.kids[0]
            out.extend(_spelled(state, node.edits, node.row))
            node.parent = None
            self.root = node
            self.open_rows -= 1
        return out


def _spelled(state: int, edits: str, row: Row | None) -> Iterator[Edit]:
    for edit in edits:
        made, after = MADE[state]
        if edit == "I":
            yield edit, None, None, made, "", None
            state = after
            continue
        turn, role, text, fault = row
        yield edit, turn, role, {"K": role, "R": made, "D": None}[edit], None if edit == "D" else text, fault


def repaired(rows: Iterable[Row]) -> Iterator[Edit]:
    """The cheapest edits of a conversation, each as soon as it is certain."""
    search = Search()
    for row in rows:
        yield from search.take(row)
    yield from search.end()


# --- Rows and their faults


def damaged(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text, gone: the rows with damage by the checksum of their id and turn. Lost rows stay as marks (``gone``) without a text."""
    space = F.lit(" ")
    given = conversations.select(
        F.col(f"`{conversation}`").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), space).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), space).alias("text"),
    )
    key = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    marked = given.withColumn("kind", kind).withColumn("copies", F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    text_after = F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role_after = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    return marked.select("conv", "turn", role_after.alias("role"), text_after.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode("copies").alias("copy")).drop("copy")


def faulty(rows: DataFrame) -> DataFrame:
    r"""``rows`` (conv, turn, role, text, gone) with ``blank``, ``truncated`` and ``again`` (an earlier turn of the conversation has the role and text)."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    truncated = F.col("text").rlike(r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z")
    when = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    keyed = rows.select("*", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), when.alias("at"))
    there = keyed.where("not gone").groupBy("conv", "role", "digest").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    several = there.where("first != last").select(F.col("conv").alias("its_conv"), F.col("role").alias("its_role"), F.col("digest").alias("its_digest"), "first")
    same = F.col("conv").eqNullSafe(F.col("its_conv")) & (F.col("role") == F.col("its_role")) & (F.col("digest") == F.col("its_digest"))
    joined = keyed.join(several, same, "left")
    again = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    return joined.select("conv", "turn", "role", "text", "gone", blank.alias("blank"), truncated.alias("truncated"), again.alias("again"))


# --- The stream of rows and of edits


class _Faults:
    """Names each row's first fault; rows come in order."""

    def __init__(self) -> None:
        self.before: tuple | None = None

    def row(self, turn, role, text, blank, truncated, again) -> Row:
        same = (turn, role, text) == self.before
        self.before = turn, role, text
        return turn, role, text, "blank" if blank else "duplicate" if again or same else "truncated" if truncated else None


_EDIT_FIELDS = ["edit", "turn", "role_before", "role", "text", "fault"]
_EDIT_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
_EDIT_DDL = "edit string, turn long, role_before string, role string, text string, fault string"
_END: Edit = (None, None, None, None, None, None)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, its rows without it) of a stream that has each conversation's rows together; rows must be used up before the next."""
    rows = chain.from_iterable(zip(*(c.to_pylist() for c in part.columns), strict=True) for batch in batches for part in slices(batch, "text", SLICE_BYTES))
    following = next(rows, None)

    def own(conv) -> Iterator[tuple]:
        nonlocal following
        while following is not None and following[0] == conv:
            yield following[1:]
            following = next(rows, None)

    while following is not None:
        conv = following[0]
        yield conv, own(conv)


def _batches(made: Iterator[tuple], names: list[str], types: list[pa.DataType], length) -> Iterator[pa.RecordBatch]:
    """Tuples as batches of bounded size; ``length`` tells a tuple's characters."""

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    held: list[tuple] = []
    size = 0
    for row in made:
        held.append(row)
        size += length(row)
        if len(held) >= OUT_ROWS or size >= OUT_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _edited(rows: DataFrame) -> DataFrame:
    """conv and the edits, in order and each conversation in one task, with a row of nulls after each conversation."""
    ship_package(rows.sparkSession)
    field = rows.schema["conv"].dataType
    names, types = ["conv", *_EDIT_FIELDS], [to_arrow_type(field), *_EDIT_TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for conv, own in _grouped(batches):
                faults = _Faults()
                present = (faults.row(turn, role, text, *marks) for turn, role, text, gone, *marks in own if not gone)
                for edit in chain(repaired(present), [_END]):
                    yield conv, *edit

        yield from _batches(made(), names, types, lambda row: len(row[5] or ""))

    # Marks of lost rows come among the others, without effect.
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return ordered.select("conv", "turn", "role", "text", "gone", "blank", "truncated", "again").mapInArrow(run, f"conv {field.simpleString()}, {_EDIT_DDL}")


def repairs(rows: DataFrame) -> DataFrame:
    """The edits of each conversation: conv, edit, turn, role_before, role, text, fault. Rows with a role are the repaired conversation.

    ``rows`` are conv, turn, role, text and gone, as ``damaged`` gives them. The edits of a conversation lie together, in order.
    """
    return _edited(faulty(rows)).where("edit is not null")


class _Audit:
    """Sums of a conversation's edits, which come one by one."""

    def __init__(self) -> None:
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = self.turns = 0
        self.first = self.last = self.before = None
        self.initials: list[str] = []
        self.hash, self.empty = hashlib.sha256(), True

    def add(self, edit, turn, role_before, role, text, fault) -> None:
        self.initials.append(edit)
        self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        if fault:
            self.faults[fault] += 1
        if edit != "I":
            if self.before is not None and self.before + role_before[:1] not in LEGAL:
                self.illegal += 1
            self.before = role_before[:1]
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last = turn
                self.turns += 1
        if role is not None:
            self.hash.update(f"{'' if self.empty else '\n'}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.empty = False

    def result(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.initials), self.hash.hexdigest()


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (as for ``repairs``): gaps, faults, illegal neighbours, cost and initials of the edits, hash of the repaired rows."""
    edits = _edited(faulty(rows))
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [to_arrow_type(rows.schema["conv"].dataType), *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            # The mark after each conversation ends it, so that two of them never run together.
            audit = _Audit()
            for conv, own in _grouped(batches):
                for edit in own:
                    if edit[0] is None:
                        yield conv, *audit.result()
                        audit = _Audit()
                    else:
                        audit.add(*edit)

        yield from _batches(made(), names, types, lambda row: len(row[7]))

    ddl = f"conv {rows.schema['conv'].dataType.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return edits.mapInArrow(run, ddl)


def conversation_audit(conversations: DataFrame) -> DataFrame:
    """Of every conversation, damaged by the checksums of its rows: its faults, and the cheapest repair."""
    return audits(damaged(conversations)).withColumnRenamed("conv", "conv_id")
