"""Operator 13 - conversation structure repair by survivor-coalescence Viterbi.

A conversation's rows, by turn, get the cheapest edits after which the initials of its roles read ``(s?(ua)+)?``. The
states are what has been said last (nothing, system, user, assistant). For each row every state keeps one survivor,
the cheapest edits that lead to it, of equally cheap ones the least in ASCII order. Survivors are leaves of a tree of
back-pointers with reference counts: who has no child left frees its node, and once all survivors share an ancestor
the edits up to it are certain and go out with their rows. A survivor that another one beats whatever may follow is
dropped, so only what is really open is held: rows since the last common ancestor.

Ties compare the complete unresolved suffixes without reading them: the edits of no survivor begin those of another
(each ends with the same row), so their order, once known, holds for everything appended to them; it is carried from
row to row with the survivors.

Rows are dealt by conversation, sorted by turn and streamed; neither a conversation nor its texts are ever held
as a whole. A conversation is one stream in one task, as the hash of its repaired text reads it in order; further
machines do not shorten a single long one.

Defined results: null roles and texts read as one space; rows whose turn is null come first; rows of one turn stand by
role and text; repeated rows are rows; a null conv_id is a conversation of its own; a conversation without rows has no
edits; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Costs of edits, and of a truncated row that stays.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: Said last: nothing, system, user, assistant. Whose turn it is then, and where that leads.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
TURN = ("u", "u", "a", "u")
THEN = (USER, USER, ASSISTANT, USER)
ENDS = (NOTHING, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}


def _mimicked() -> list[list[int]]:
    """``[q][p]``: at most how much more it costs to go on from q as one would from p. By insertions one comes to
    p itself; whoever has heard an assistant can do all that follows a system row, and, deleting that row, all that
    follows nothing."""
    far = 10**6
    out = [[0 if p == q else far for p in range(4)] for q in range(4)]
    for q in range(4):
        at, cost = q, 0
        for _ in range(2):
            at, cost = THEN[at], cost + INSERT
            out[q][at] = min(out[q][at], cost)
    for q in range(4):
        out[q][SYSTEM] = min(out[q][SYSTEM], out[q][ASSISTANT])
        out[q][NOTHING] = min(out[q][NOTHING], out[q][ASSISTANT] + DELETE)
    return out


MIMICKED = _mimicked()


class Node:
    """Edits up to and with one row (insertions before it, then its own), reached from those of ``above``."""

    __slots__ = ("above", "edits", "below", "held")

    def __init__(self, above: Node | None, edits: str):
        self.above, self.edits, self.below, self.held = above, edits, set(), 0
        if above is not None:
            above.below.add(self)

    def release(self) -> None:
        """One survivor less; frees what no survivor needs."""
        self.held -= 1
        node = self
        while node.above is not None and not node.held and not node.below:
            node.above.below.discard(node)
            node = node.above


class Repairer:
    """Edits of one conversation, given row by row; ``row`` and ``close`` yield (edits of a row, row) as they become certain."""

    def __init__(self):
        self.root = Node(None, "")
        self.root.held = 1
        self.open: deque = deque()
        # state -> (cost, rank of its edits in ASCII order, node)
        self.survivors: dict[int, tuple[int, int, Node]] = {NOTHING: (0, 0, self.root)}

    def _reached(self) -> Iterator[tuple[int, tuple[int, int, str], Node]]:
        """(state, (cost, rank, insertions), node) of every survivor, without and with insertions."""
        for state, (cost, rank, node) in self.survivors.items():
            for n in range(3):
                yield state, (cost + n * INSERT, rank, "I" * n), node
                state = THEN[state]

    def row(self, item, initial: str, must_go: bool, truncated: bool) -> Iterator[tuple[str, object]]:
        best: dict[int, tuple[tuple[int, int, str], Node]] = {}

        def offer(state: int, key: tuple[int, int, str], node: Node) -> None:
            if state not in best or key < best[state][0]:
                best[state] = key, node

        more = TRUNCATED if truncated else 0
        for state, (cost, rank, edits), node in self._reached():
            offer(state, (cost + DELETE, rank, edits + "D"), node)
            if must_go:
                continue
            if initial == TURN[state]:
                offer(THEN[state], (cost + more, rank, edits + "K"), node)
            else:
                offer(THEN[state], (cost + REROLE + more, rank, edits + "R"), node)
            if initial == "s" and state == NOTHING:
                offer(SYSTEM, (cost + more, rank, edits + "K"), node)
        for p in list(best):  # who is beaten whatever follows
            if any(best[q][0][0] + MIMICKED[q][p] < best[p][0][0] for q in best if q != p):
                del best[p]
        old = [node for _, _, node in self.survivors.values()]
        least = min(key[0] for key, _ in best.values())
        order = sorted(best, key=lambda p: best[p][0][1:])
        self.survivors = {}
        for rank, p in enumerate(order):
            (cost, _, edits), above = best[p]
            node = Node(above, edits)
            node.held = 1
            self.survivors[p] = cost - least, rank, node  # only differences are kept: costs stay small
        for node in old:
            node.release()
        self.open.append(item)
        yield from self._certain()

    def _certain(self) -> Iterator[tuple[str, object]]:
        while not self.root.held and len(self.root.below) == 1:
            self.root = self.root.below.pop()
            self.root.above = None
            yield self.root.edits, self.open.popleft()

    def close(self) -> Iterator[tuple[str, object]]:
        """What is left, and insertions at the end with no row."""
        ends = [((cost, rank, edits), node) for state, (cost, rank, edits), node in self._reached() if state in ENDS]
        (_, _, edits), node = min(ends, key=lambda x: x[0])
        path = []
        while node is not self.root:
            path.append(node.edits)
            node = node.above
        for own in reversed(path):
            yield own, self.open.popleft()
        if edits:
            yield edits, None


ROWS = ("conv_id", "turn", "role", "text", "dropped", "repeated")
EDITS = "conv_id long, step long, edit string, turn long, was string, role string, text string, fault string, cost long"
_EDITS = pa.schema([("conv_id", pa.int64()), ("step", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("was", pa.string()),
                    ("role", pa.string()), ("text", pa.string()), ("fault", pa.string()), ("cost", pa.int64())])
_BLANKS = " \t\n\x0b\x0c\r"
#: Rows handed on at a time, and characters of text.
FLUSH_ROWS, FLUSH_CHARS = 4096, 1 << 22


def fault_of(text: str, repeated: bool) -> str | None:
    """blank, duplicate, truncated or none: the first that holds."""
    said = text.rstrip(_BLANKS)
    if not said:
        return "blank"
    if repeated:
        return "duplicate"
    return None if said[-1] in ".!?" else "truncated"


class _Edits:
    """Turns certain edits of one conversation into result rows."""

    def __init__(self, conv):
        self.conv, self.step, self.state = conv, 0, NOTHING

    def rows(self, certain: Iterable[tuple[str, tuple | None]]) -> Iterator[tuple]:
        for edits, item in certain:
            for edit in edits:
                if edit == "I":
                    yield self._row("I", None, None, ROLES[TURN[self.state]], "", None, INSERT)
                    self.state = THEN[self.state]
                    continue
                turn, was, text, fault = item
                more = TRUNCATED if fault == "truncated" else 0
                if edit == "D":
                    yield self._row("D", turn, was, None, text, fault, DELETE)
                    continue
                role = was if edit == "K" else ROLES[TURN[self.state]]
                yield self._row(edit, turn, was, role, text, fault, more + (REROLE if edit == "R" else 0))
                self.state = SYSTEM if edit == "K" and was[:1] == "s" else THEN[self.state]

    def _row(self, *cells) -> tuple:
        self.step += 1
        return (self.conv, self.step - 1, *cells)


def _edits(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Rows (conv_id, turn, role, text, dropped, repeated) by conversation and turn -> EDITS rows."""
    nothing = object()
    conv, repairer, out = nothing, None, None

    def end() -> Iterator[tuple]:
        if conv is not nothing:
            yield from out.rows(repairer.close())
            if not out.step:
                yield conv, None, None, None, None, None, None, None, None

    for at, turn, role, text, dropped, repeated in rows:
        if conv is nothing or at != conv:
            yield from end()
            conv, repairer, out = at, Repairer(), _Edits(at)
        if not dropped:
            fault = fault_of(text, repeated)
            yield from out.rows(repairer.row((turn, role, text, fault), role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    yield from end()


def _unpacked(batches: Iterator[pa.RecordBatch], names: Iterable[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def _packed(rows: Iterator[tuple], schema: pa.Schema, text: int | None) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[text] or "") if text is not None else 0
        if len(held) >= FLUSH_ROWS or chars >= FLUSH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def repaired(rows: DataFrame) -> DataFrame:
    """The edits of every conversation of ``rows`` (conv_id, turn, role, text[, dropped]), one row each, in order within a partition:
    (conv_id, step, edit K/R/D/I, turn, was, role, text, fault, cost). Rows marked ``dropped`` only show that their conversation exists;
    one without other rows gives one row of nulls."""
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                      F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), dropped.alias("dropped"))
    alike = Window.partitionBy("conv_id", "role", "text", "dropped").orderBy(F.col("turn").asc_nulls_first())
    own = own.repartition("conv_id").withColumn("repeated", F.row_number().over(alike) > 1)
    own = own.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return own.select(*ROWS).mapInArrow(lambda batches: _packed(_edits(_unpacked(batches, ROWS)), _EDITS, 6), EDITS)


DIGESTS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
_DIGESTS = pa.schema([(c.split()[0], pa.int64() if c.split()[1] == "long" else pa.string()) for c in DIGESTS.split(", ")])
LEGAL = ("su", "ua", "au")


class _Digest:
    """Counts, audit and hash of one conversation, from its edits in order."""

    def __init__(self, conv):
        self.conv, self.faults, self.illegal, self.cost, self.audit = conv, {"blank": 0, "duplicate": 0, "truncated": 0}, 0, 0, []
        self.first = self.last = self.initial = None
        self.turns, self.hash, self.written = 0, hashlib.sha256(), False

    def add(self, edit: str, turn: int | None, was: str, role: str | None, text: str, fault: str | None, cost: int) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            if turn is not None and turn != self.last:
                self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
            self.illegal += self.initial is not None and self.initial + was[:1] not in LEGAL
            self.initial = was[:1]
            if fault:
                self.faults[fault] += 1
        if edit != "D":
            self.hash.update(f"{chr(10) if self.written else ''}{role}:{text}".encode("utf-8", "replace"))
            self.written = True

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def digests(edits: DataFrame) -> DataFrame:
    """One row a conversation from ``repaired``'s rows, as they stand in its partitions."""

    def rows(given: Iterable[tuple]) -> Iterator[tuple]:
        held = None
        for conv, edit, *cells in given:
            if held is None or held.conv != conv:
                if held:
                    yield held.row()
                held = _Digest(conv)
            if edit is not None:
                held.add(edit, *cells)
        if held:
            yield held.row()

    names = ("conv_id", "edit", "turn", "was", "role", "text", "fault", "cost")
    return edits.mapInArrow(lambda batches: _packed(rows(_unpacked(batches, names)), _DIGESTS, None), DIGESTS)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults by crc32(``conv_id:turn``) % 20: 0 marks a row ``dropped``, 1 empties its text,
    2 removes its ``.!?``, 3 repeats it, 4 makes it the user's."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = rows.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"),
                      (F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20).alias("way"))
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.sequence(F.lit(0), F.when(F.col("way") == 3, 1).otherwise(0))
    return own.select("conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                      (F.col("way") == 0).alias("dropped"), F.explode(times).alias("copy")).drop("copy")
