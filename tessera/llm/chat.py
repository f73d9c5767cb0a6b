"""Operator 3 - roles and turns of raw transcripts by a hidden Markov model, rendered canonically.

A transcript is lines of text in which speakers may be marked in many ways, or not at all. Each line has
one of eight hidden states: it begins or goes on with a turn of one of four roles. What is seen of a line
is its speaker marker and the marker's form, whether a gap precedes it, its length, and how it starts and
ends. All probabilities are counts over labelled turns; as whole numbers (scaled logarithms) their sums
are exact. Viterbi finds the likeliest states of a whole transcript, markers go, and each turn is rendered
as ``<|im_start|>role\\ntext<|im_end|>\\n``.

A transcript comes as rows (conv_id, turn, text): one row of many lines, or many rows in the order of
``turn``. Rows are dealt by range and read in order, so transcripts are decoded where they lie, and one
that holds a third of all rows is spread over many tasks: it is cut into segments, a segment's best
scores from each state to each form a matrix, and products of these (maxima of sums) give each segment
the scores that enter it and the state that it must end in. The path has the same score as that of an
uncut transcript. Products are formed within a partition first, then over partitions.

Defined results: texts are null = empty; a null conv_id is a transcript of its own in each row; null turns
come first, ties are ordered by a hash of the text, repeated rows are all read; the text of a turn has no
white space at its ends; a row without any line but blank ones and without a marker adds no turn; an
empty table gives an empty result; other columns are ignored. ``<|im_`` within a text is rendered as ``< |im_``,
so no text can forge a turn. Without labelled turns (nothing to count) the shares
are the smoothing alone, and markers tell nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, empty_text, materialize

ROLES = ("system", "user", "assistant", "tool")
#: States: 2 r begins a turn of role r, 2 r + 1 goes on with it; the last, before the first line, is entered by none.
STATES = 2 * len(ROLES)
START = STATES
#: A segment ends after so many rows or code points.
SEGMENT_ROWS, SEGMENT_CHARS = 512, 1 << 20
#: Names of speakers, by role.
NAMES = {
    "system": "system sys developer context",
    "user": "user human customer client question q prompt instruction input me",
    "assistant": "assistant ai bot chatbot agent model gpt answer a response output",
    "tool": "tool function observation result",
}
_ROLE = {n: r for r, names in enumerate(NAMES.values()) for n in names.split()}
_UNKNOWN, _UNMARKED = len(ROLES), len(ROLES) + 1
#: The forms of speaker markers: tags, bracketed names, headings, names before a colon.
_FORMS = re.compile(r"\s{0,3}(?:<\|(?:im_start\|>)?\s*(?P<tag>\w{1,20})\s*(?:\|>)?|\[(?P<bracket>\w{1,20})\]:?|#{1,4}\s*(?P<heading>\w{1,20}):?\s*$"
                    r"|(?:\*\*|__)?(?P<name>[A-Za-z]\w{0,20})(?:\*\*|__)?\s{0,2}:(?:\*\*|__)?(?=\s|$))[ \t]?")
_FORM = {"tag": 0, "bracket": 1, "heading": 2, "name": 3}
_CLOSING = re.compile(r"\s*(?:<\|im_end\|>|<\|end\|>|</s>)\s*$")
_BLANK = " \t\n\x0b\x0c\r"
#: How many values each feature of a line has, and where each begins in a table of all.
WIDTHS = (6, 5, 4, 16, 5, 5)
_AT = np.cumsum((0, *WIDTHS))
#: Weight of what all roles have in common: values and roles not met in fitting are judged by it.
COMMON = 0.2
#: Logarithms are whole numbers of 2 ** -20.
_SCALE, _NEVER = 1 << 20, -(1 << 50)


def marker(line: str) -> tuple[int, int, int]:
    """(role or unknown or unmarked, form, where the rest begins) of a line."""
    found = _FORMS.match(line)
    if found is None:
        return _UNMARKED, 4, 0
    role = _ROLE.get(found[found.lastgroup].lower(), _UNKNOWN)
    if role == _UNKNOWN and found.lastgroup != "name":
        return _UNMARKED, 4, 0
    return role, _FORM[found.lastgroup], found.end()


def features(text: str) -> tuple[list[str], list[tuple[int, ...]], list[int]]:
    """The lines of a row, what is seen of each, and where each begins without its marker. A row's
    first line has a gap before it."""
    lines, seen, rest = text.split("\n"), [], []
    gap = True
    for line in lines:
        bare = line.strip(_BLANK)
        role, form, at = marker(line)
        closing = bool(_CLOSING.match(line))
        kind = 2 if not bare else 3 if closing else int(gap)
        first, last = bare[:1], bare[-1:]
        starts = 0 if not bare else 1 if first.isupper() else 2 if first.islower() else 3 if first.isdigit() or first in "-*•`>" else 4
        ends = 0 if not bare else 1 if last in "?？" else 2 if last in ".!。" else 3 if last == ":" else 4
        seen.append((role, form, kind, min(15, len(bare).bit_length()), starts, ends))
        rest.append(at)
        gap = not bare or closing
    return lines, seen, rest


def _levelled(score: np.ndarray) -> np.ndarray:
    """Only differences count: the best is 0, however long the transcript."""
    return np.maximum(score - score.max(), 2 * _NEVER)


def _after(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of maxima of sums."""
    return _levelled((a[:, :, None] + b).max(axis=1))


def _pooled(counts: np.ndarray, named: bool) -> np.ndarray:
    """What all roles have in common, as shares by role: how often a value is seen and, if values name roles,
    how often it names the turn's own role, or another."""
    shares = np.tile(counts.sum(axis=0) + 1.0, (len(counts), 1))
    if named:
        k = len(ROLES)
        own = np.trace(counts[:, :k])
        other = (counts[:, :k].sum() - own) / (k - 1)
        shares[:, :k] = np.where(np.eye(k, dtype=bool), own + 1.0, other + 1.0)
    return shares / shares.sum(axis=1, keepdims=True)


class Model:
    """Whole-number scores: ``enter`` of each state after each, and of what is seen in each state."""

    def __init__(self, seen: np.ndarray, follows: np.ndarray, one: np.ndarray, more: np.ndarray, runs: np.ndarray):
        """Counts: seen (state, value of a feature); follows (role or start, role); turns of one line,
        of more, and lines that go on, by role."""
        def log(p):
            return np.rint(np.log(p) * _SCALE).astype(np.int64)

        follows = log((follows + 0.5) / (follows + 0.5).sum(axis=1, keepdims=True))
        goes = (more + 0.5) / (one + more + 1)  # a first line is followed by another of its turn
        stays = (runs - more + 0.5) / (runs + 1)  # so is a later one
        self.enter = np.full((STATES + 1, STATES + 1), _NEVER, dtype=np.int64)
        for r in range(len(ROLES)):
            begin, inside = 2 * r, 2 * r + 1
            self.enter[begin, inside], self.enter[inside, inside] = log(goes[r]), log(stays[r])
            self.enter[begin, 0:STATES:2], self.enter[inside, 0:STATES:2] = log(1 - goes[r]) + follows[r], log(1 - stays[r]) + follows[r]
        self.enter[START, 0:STATES:2] = follows[len(ROLES)]
        self.seen = np.zeros((STATES, _AT[-1]), dtype=np.int64)
        for a, b in zip(_AT, _AT[1:]):
            prior = np.stack([_pooled(seen[k::2, a:b], named=a == 0) for k in (0, 1)], axis=1).reshape(STATES, b - a)
            total = seen[:, a:b].sum(axis=1, keepdims=True)
            own = np.where(total > 0, seen[:, a:b] / np.maximum(total, 1), prior)
            self.seen[:, a:b] = log((1 - COMMON) * own + COMMON * prior)
        self.known: dict[tuple[int, ...], np.ndarray] = {}

    def line(self, seen: tuple[int, ...]) -> np.ndarray:
        if seen not in self.known:
            self.known[seen] = np.append(sum(self.seen[:, a + v] for a, v in zip(_AT, seen)), _NEVER)
        return self.known[seen]

    def through(self, seen: list[tuple[int, ...]]) -> np.ndarray:
        """Best scores from each state before the lines to each state of the last."""
        best = np.where(np.eye(STATES + 1, dtype=bool), 0, 2 * _NEVER)
        for x in seen:
            best = _after(best, self.enter + self.line(x))
        return best

    def decode(self, seen: list[tuple[int, ...]], before: np.ndarray, end: int | None) -> list[int]:
        """The likeliest states of the lines, given the scores before them and the last state, if known."""
        back = np.empty((len(seen), STATES + 1), dtype=np.int8)
        score, states = before, np.arange(STATES + 1)
        for i, x in enumerate(seen):
            each = score[:, None] + self.enter
            back[i] = came = each.argmax(axis=0)
            score = _levelled(each[came, states] + self.line(x))
        path = [int(score.argmax()) if end is None else end]
        for i in range(len(seen) - 1, 0, -1):
            path.append(int(back[i, path[-1]]))
        return path[::-1]


def _begin() -> np.ndarray:
    score = np.full(STATES + 1, 2 * _NEVER, dtype=np.int64)
    score[START] = 0
    return score


def fit(turns: DataFrame) -> Model:
    """The model of labelled turns (conv_id, turn, role, text), text with its marker as in a transcript. Counts over
    all rows whose role is known; only sums, a few hundred numbers, reach the driver."""
    names = F.create_map(*[F.lit(x) for n, r in _ROLE.items() for x in (n, r)])
    rows = columns(turns, conv_id="long", turn="long", role="string", text="string").withColumn("role", names[F.lower(F.trim("role"))]).filter("role is not null")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for role, text in zip(batch["role"], batch["text"]):
                _, seen, _ = features(text or "")
                counts["one" if len(seen) == 1 else "more", role, 0] += 1
                counts["runs", role, 0] += len(seen) - 1
                for i, x in enumerate(seen):
                    for a, v in zip(_AT, x):
                        counts["seen", 2 * role + (i > 0), int(a) + v] += 1
        yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["what", "x", "y", "n"])

    total = rows.select("role", "text").mapInPandas(run, "what string, x long, y long, n long").groupBy("what", "x", "y").agg(F.sum("n").alias("n"))
    # One role for each (conversation, turn): repeated rows cannot multiply in the join of neighbours.
    one = rows.filter("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("role").alias("y"))
    before = one.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("y").alias("x"))
    pairs = one.join(before, ["conv_id", "turn"], "left").groupBy(F.coalesce("x", F.lit(len(ROLES))).cast("long").alias("x"), F.col("y").cast("long").alias("y")).agg(F.count("*").alias("n"))
    table = {"seen": np.zeros((STATES, _AT[-1])), "follows": np.zeros((len(ROLES) + 1, len(ROLES)))} | {k: np.zeros((len(ROLES), 1)) for k in ("one", "more", "runs")}
    for what, x, y, n in total.unionByName(pairs.select(F.lit("follows").alias("what"), "x", "y", "n")).collect():
        table[what][x, y] = n
    return Model(table["seen"], table["follows"], *(table[k][:, 0] for k in ("one", "more", "runs")))


def _segments(transcripts: DataFrame) -> DataFrame:
    """(conv_id, part, k, open, texts): runs of rows of one transcript in order; open if its transcript
    may have others, as it is cut or at an end of its partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, k, out = TaskContext.get().partitionId(), 0, []
        own, texts, chars, cut = None, [], 0, True
        for batch in batches:
            for conv, null, text in zip(batch["conv_id"], batch["no_id"], batch["text"]):
                conv = None if null else int(conv)
                same = conv is not None and conv == own
                if texts and not (same and len(texts) < SEGMENT_ROWS and chars < SEGMENT_CHARS):
                    out.append((own, part, k, own is not None and (cut or same), texts))
                    k, texts, chars, cut = k + 1, [], 0, same
                own = conv
                texts.append(text)
                chars += len(text)
            yield pd.DataFrame(out, columns=["conv_id", "part", "k", "open", "texts"]).astype({"conv_id": "Int64"})
            out = []
        if texts:
            yield pd.DataFrame([(own, part, k, own is not None, texts)], columns=["conv_id", "part", "k", "open", "texts"]).astype({"conv_id": "Int64"})

    rows = columns(transcripts, conv_id="long", turn="long", text="string").withColumn("text", empty_text())
    order = ["conv_id", "turn", "tie", "at"]
    rows = rows.withColumns({"tie": F.xxhash64("text"), "at": F.monotonically_increasing_id()}).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.col("conv_id").isNull().alias("no_id"), "text")
    return materialize(rows.mapInPandas(run, "conv_id long, part long, k long, open boolean, texts array<string>"), "chat-segments")


_MATRIX = "matrix array<long>"


def _square(values) -> np.ndarray:
    return np.array(list(values), dtype=np.int64).reshape(STATES + 1, STATES + 1)


def _products(segments: DataFrame) -> DataFrame:
    """(conv_id, part, matrix): the product of each partition's open segments of a transcript."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for m in pdf.sort_values("k")["matrix"]:
            total = _square(m) if total is None else _after(total, _square(m))
        return pd.DataFrame({"conv_id": pdf["conv_id"][:1], "part": pdf["part"][:1], "matrix": [total.ravel().tolist()]})

    return segments.groupBy("conv_id", "part").applyInPandas(run, f"conv_id long, part long, {_MATRIX}")


def _spread(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """(conv_id, part, k, entry, ends): the scores that enter each member of a group, and its last state, from
    the group's own."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        score, entries = np.array(list(pdf["entry"].iloc[0]), dtype=np.int64), []
        matrices = [_square(m) for m in pdf["matrix"]]
        for m in matrices:
            entries.append(score)
            score = _levelled((score[:, None] + m).max(axis=0))
        end = int(pdf["ends"].iloc[0])
        end = int(score.argmax()) if end < 0 else end
        ends = []
        for entry, m in zip(entries[::-1], matrices[::-1]):
            ends.append(end)
            end = int((entry + m[:, end]).argmax())
        return pdf[["conv_id", "part", "k"]].assign(entry=[e.tolist() for e in entries], ends=ends[::-1])

    return rows.groupBy(*by).applyInPandas(run, "conv_id long, part long, k long, entry array<long>, ends int")


def _decoded(segments: DataFrame, model: Model) -> DataFrame:
    """(conv_id, part, k, turn, begins, role, text): the turns of each segment (entry and ends null: a whole transcript),
    counted within it from 0; what goes on with a turn begun earlier is -1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, part, k, texts, entry, end in zip(*(batch[c] for c in ("conv_id", "part", "k", "texts", "entry", "ends"))):
                lines, seen, rest = ([x for row in found for x in row] for found in zip(*map(features, texts)))
                whole = entry is None
                path = model.decode(seen, _begin() if whole else np.array(entry, dtype=np.int64), None if whole else int(end))
                turn, own = -1, []
                for state, line, at, x in zip(path, lines, rest, seen):
                    if state % 2 == 0:
                        if own:
                            out.append((conv, part, k, turn, ROLES[role], "\n".join(own)))
                        turn, own = turn + 1, []
                        line = line[at:]
                    role = state // 2
                    if x[2] != 3:  # closing marks go
                        own.append(line)
                if own:
                    out.append((conv, part, k, turn, ROLES[role], "\n".join(own)))
            yield pd.DataFrame(out, columns=["conv_id", "part", "k", "turn", "role", "text"]).astype({"conv_id": "Int64"})

    wanted = segments.select("conv_id", "part", "k", "texts", "entry", "ends")
    return wanted.mapInPandas(run, "conv_id long, part long, k long, turn long, role string, text string")


def parse(transcripts: DataFrame, model: Model) -> DataFrame:
    """(conv_id, turn, role, text) of every turn of ``transcripts`` (conv_id, turn, text), turns counted from 0."""
    segments = _segments(transcripts)
    none = {"entry": F.lit(None).cast("array<long>"), "ends": F.lit(None).cast("int")}
    whole = _decoded(segments.filter("not open").withColumns(none), model).select("conv_id", "turn", "role", "text")

    def through(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            m = [model.through([x for t in texts for x in features(t)[1]]).ravel().tolist() for texts in batch["texts"]]
            yield batch[["conv_id", "part", "k"]].assign(matrix=m)

    cut = segments.filter("open")
    matrices = materialize(cut.select("conv_id", "part", "k", "texts").mapInPandas(through, f"conv_id long, part long, k long, {_MATRIX}"), "chat-matrices")
    begin = F.array(*[F.lit(int(x)).cast("long") for x in _begin()])
    tops = _products(matrices).withColumns({"k": F.lit(0).cast("long"), "entry": begin, "ends": F.lit(-1)})
    tops = _spread(tops, ["conv_id"], "part").drop("k")
    bounds = _spread(matrices.join(tops, ["conv_id", "part"]), ["conv_id", "part"], "k")
    pieces = materialize(_decoded(cut.join(bounds, ["conv_id", "part", "k"]), model), "chat-pieces")
    begun = pieces.groupBy("conv_id", "part", "k").agg((F.max("turn") + 1).alias("begun"))
    earlier = Window.partitionBy("conv_id").orderBy("part", "k").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select("conv_id", "part", "k", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("earlier"))
    joined = pieces.join(begun, ["conv_id", "part", "k"]).withColumn("turn", F.col("turn") + F.col("earlier"))
    joined = joined.groupBy("conv_id", "turn", "role").agg(F.array_sort(F.collect_list(F.struct("part", "k", "text")))["text"].alias("texts"))
    joined = joined.select("conv_id", "turn", "role", F.array_join("texts", "\n").alias("text"))
    return whole.unionByName(joined).withColumn("text", F.btrim("text", F.lit(_BLANK)))


def rendered(role: str = "role", text: str = "text"):
    """The canonical form of a turn."""
    return F.concat(F.lit("<|im_start|>"), F.col(role), F.lit("\n"), F.replace(F.col(text), F.lit("<|im_"), F.lit("< |im_")), F.lit("<|im_end|>\n"))


def transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): ``conversations`` as raw transcripts, as they are met on the web. By a checksum of conv_id the
    speakers are marked in one of eight ways; one turn in ten, by a checksum of conv_id and turn, has lost its marker,
    as has every turn without a role. A gap follows each turn. ``role`` is the truth, for fitting alone."""
    rows = columns(conversations, conv_id="long", turn="long", role="string", text="string").withColumn("text", empty_text())
    role, text = F.lower(F.trim("role")), F.col("text")
    short = {"user": "Q", "assistant": "A"}
    other = {"user": "Human", "assistant": "AI"}
    headings = {"user": "Instruction", "assistant": "Response"}

    def name(of: dict[str, str]):
        found = F.initcap(role)
        for k, v in of.items():
            found = F.when(role == k, v).otherwise(found)
        return found

    styles = [F.concat(name({}), F.lit(": "), text), F.concat(name(other), F.lit(": "), text), F.concat(name(short), F.lit(": "), text),
              F.concat(F.lit("### "), name(headings), F.lit(":\n"), text), F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("\n<|im_end|>")),
              F.concat(F.lit("["), F.upper(role), F.lit("] "), text), F.concat(F.lit("**"), name({}), F.lit("**: "), text), F.concat(role, F.lit(":\n"), text)]
    style = F.pmod(F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")), F.lit(len(styles)))
    raw = styles[-1]
    for i, s in enumerate(styles[:-1]):
        raw = F.when(style == i, s).otherwise(raw)
    lost = (F.pmod(F.crc32(F.concat_ws(":", "conv_id", "turn").cast("binary")), F.lit(10)) == 0) & (F.length(F.btrim(text, F.lit(_BLANK))) > 0)
    return rows.select("conv_id", "turn", "role", F.concat(F.when(lost | role.isNull(), text).otherwise(raw), F.lit("\n")).alias("text"))


def held_out(key: str = "conv_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def recover(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rendered, held_out): the turns recovered from the raw transcripts of all ``conversations``; the
    model is counted on those not held out."""
    raw = transcripts(conversations)
    model = fit(raw.filter(~held_out()))
    return parse(raw.drop("role"), model).select("conv_id", "turn", "role", "text", rendered().alias("rendered"), held_out().alias("held_out"))
