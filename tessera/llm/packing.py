"""Operator 2 - packing documents into training sequences.

A document becomes ids of a public tokenizer, then an end id; it is cut at every ``length`` ids. The
pieces are dealt to random groups of bounded size, and each group is packed by itself: first-fit
decreasing, where a tournament tree over the free capacities of the bins finds the leftmost bin that
still holds the piece in log steps. Full pieces fill a sequence of their own.

Defined results: a null or empty text has the end id alone; repeated rows are separate documents;
a null doc_id is carried; an empty table gives an empty result; other columns are ignored. Strings of
special tokens in a text become the special ids, as the tokenizer has it.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns, materialize, rows_per_split

#: Ids in a sequence, the id after each document, pieces packed together in one group.
LENGTH, END_ID, GROUP = 2048, 1, 8192
#: A text is cut into chunks at the six blanks of ASCII; no token, nor the normal form of one, crosses them.
#: The end of the last id of each of the tokenizer's own words, and how many chunks go into one call. Chunks of letters are one
#: such word each: their ids are parted there.
WORD_END, CALL = "</w>", 64
#: Small letters of ASCII and Latin-1 are their own normal form, lower case and tokenizer's word: chunks of these need only its merges.
PLAIN, PLAIN_CALL = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch, 512
#: A special token that parts the other chunks of one call; chunks with its first characters go by themselves.
PART, PART_ID = "<|endoftext|>", 49407
#: Marks at the end of a chunk have ids of their own after a letter or digit of these blocks, but for
#: U+0130, whose lower case ends in a mark itself.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CUT_AFTER = np.array([c < 0x250 and c != 0x130 and chr(c).isalnum() for c in range(0x280)])
#: Chunks whose ids a worker remembers before it starts anew (some 300 bytes each, in every worker of an executor),
#: documents whose pieces it holds before it hands them on, and letters of these that are encoded together.
REMEMBERED, HANDED, TOGETHER = 150_000, 512, 1 << 20


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def lower_case(text: str) -> str:
    """``text`` as the tokenizer takes it, composed (NFC) and then in lower case, which saves chunks; or as
    it is, where the tokenizer's own composing would go on in the lower case (J with a caron has no composed
    form, j with one has), or its rules may differ (U+0130, U+03A3, special tokens)."""
    if "<|" in text:
        return text
    if text.isascii():
        return text.lower()
    composed = unicodedata.normalize("NFC", text)
    if "\u0130" in composed or "\u03a3" in composed:
        return text
    lower = composed.lower()
    return lower if unicodedata.is_normalized("NFC", lower) else text


def gathered(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` from ``begin``, ``size`` long, one after another."""
    stop = np.cumsum(size)
    return values[np.repeat(begin - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)]


def cut_marks(chunks: pa.LargeStringArray) -> tuple[pa.Array, pa.Array]:
    """Each chunk without the marks at its end, and these; they stay with the chunk, and the marks are empty, where they
    don't follow a letter or digit of the blocks that allow a cut."""
    stems = pc.utf8_rtrim(chunks, characters=MARKS)
    size, kept = (pc.binary_length(x).to_numpy() for x in (chunks, stems))
    data = np.frombuffer(chunks.buffers()[2] or b"", np.uint8)
    end = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset:chunks.offset + len(chunks)] + kept
    last, lead = (np.append(data, 0)[np.maximum(end - k, 0)].astype(int) for k in (1, 2))
    two = (last >> 6 == 2) & (lead >= 0xC2) & (lead <= 0xC9)   # a letter of two bytes, below U+0280
    point = np.where(two, (lead & 31) << 6 | last & 63, np.where(last < 128, last, 0))
    cut = (kept > 0) & (kept < size) & CUT_AFTER[point] & ~pc.match_substring(chunks, "<|").to_numpy(False)
    tail = np.where(cut, size - kept, 0)
    offsets = np.append(0, np.cumsum(tail))
    marks = pa.LargeStringArray.from_buffers(len(chunks), pa.py_buffer(offsets), pa.py_buffer(gathered(data, end, tail)))
    return pc.if_else(pa.array(cut), stems, chunks), marks


class Encoder:
    """Ids of whole texts, by chunks between white space. A chunk with marks at its end is put together from the ids of
    the chunk without them and of the marks; the ids of such parts and of all other chunks are remembered."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)   # the same pieces and merges, for what needs no normal form
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for piece, i in vocab.items() if piece.endswith(WORD_END)]] = True
        self.known: dict[str, bytes] = {}
        self.past: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        listed = pc.ascii_split_whitespace(pa.array(map(lower_case, texts), pa.large_string()))
        words = listed.flatten().dictionary_encode()
        parts, marks = map(pa.Array.dictionary_encode, cut_marks(words.dictionary))
        of = self._remembered(parts.dictionary.to_numpy(False).tolist() + marks.dictionary.to_numpy(False).tolist())
        # a word is two places in ``of``, whose ids are one after another in ``raw``
        raw, size = np.frombuffer(b"".join(of), "<u4"), np.fromiter(map(len, of), np.int64, len(of)) // 4
        at = np.stack([parts.indices.to_numpy(), marks.indices.to_numpy() + len(parts.dictionary)], 1)[words.indices.to_numpy()].ravel()
        ids = gathered(raw, (np.cumsum(size) - size)[at], size[at])
        ends = np.append(0, np.cumsum(size[at]))[2 * listed.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in itertools.pairwise(ends)]

    def _remembered(self, parts: list[str]) -> list[bytes]:
        """The ids of each of ``parts``; new ones are encoded and remembered."""
        if len(self.known) > REMEMBERED // 2:   # the half before last goes, but for what came again since
            self.past, self.known = self.known, {}
        known, past = self.known, self.past
        out = list(map(known.get, parts))
        missing = {parts[i] for i, found in enumerate(out) if found is None}
        again = [c for c in missing if c in past]
        known.update(zip(again, map(past.__getitem__, again), strict=True))
        self.stems = {}
        self._encode(list(missing.difference(again)))
        known.update(self.stems)
        return list(map(known.__getitem__, parts)) if missing else out

    def _encode(self, new: list[str]) -> None:
        """Put the ids of ``new`` parts into ``stems``, many in one call."""
        plain, words, others, alone = [], [], [], []
        for c in new:
            (plain if PLAIN(c) else words if c.isalpha() else alone if "<|" in c else others).append(c)
        for tokenizer, letters, call in ((self.plain, plain, PLAIN_CALL), (self.tokenizer, words, CALL)):
            for at in range(0, len(letters), call):
                parts = letters[at:at + call]
                ids = self._ids(" ".join(parts), tokenizer)
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) == len(parts):
                    self._part(parts, ids, ends, 0)
                else:   # letters that the tokenizer takes for none, or whose lower case holds a mark
                    alone += parts
        for part, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False), strict=True):
            self.stems[part] = np.array(e.ids, dtype="<u4").tobytes()
        for at in range(0, len(others), CALL):
            parts = others[at:at + CALL]
            ids = self._ids(PART.join(parts), self.tokenizer)
            self._part(parts, ids, np.append(np.flatnonzero(ids == PART_ID), len(ids)), 1)

    def _ids(self, text: str, tokenizer) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _part(self, parts: list[str], ids: np.ndarray, ends: np.ndarray, between: int) -> None:
        """Put the ids of each part into ``stems``: those up to its end, then ``between`` ids that are nobody's."""
        raw, start = ids.tobytes(), 0
        if len(ends) != len(parts):
            raise ValueError("the tokenizer does not know the special token that parts chunks")
        for part, end in zip(parts, (ends * 4).tolist(), strict=True):
            self.stems[part] = raw[start:end]
            start = end + 4 * between


@functools.lru_cache(1)
def encoder(path: str) -> Encoder:
    """The encoder of this worker: what one task has learned serves the next."""
    return Encoder(path)


def calls(texts: list[str], first: int, last: int) -> list[int]:
    """Where ``texts`` from ``first`` to ``last`` are parted into calls of TOGETHER letters, but for longer texts."""
    ends = np.cumsum([len(t) for t in texts[first:last]])
    at = [first]
    while at[-1] < last:
        before = ends[at[-1] - first - 1] if at[-1] > first else 0
        at.append(max(at[-1] + 1, first + int(np.searchsorted(ends, before + TOGETHER, "right"))))
    return at


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every piece of ``docs`` (doc_id, text)."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            texts, doc_ids = batch["text"].fillna("").tolist(), batch["doc_id"].tolist()
            for first in range(0, len(texts), HANDED):
                out = []
                for at, upto in itertools.pairwise(calls(texts, first, min(first + HANDED, len(texts)))):
                    for doc_id, ids in zip(doc_ids[at:upto], encode(texts[at:upto]), strict=True):
                        ids += end
                        for start in range(0, len(ids), 4 * length):
                            part = ids[start:start + 4 * length]
                            out.append((doc_id, start // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, *([part] if with_ids else [])))
                frame = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])])
                yield frame.astype({"doc_id": "Int64"})

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    # Int64 keeps null ids as integers.
    return columns(docs, doc_id="long", text="string").mapInPandas(_whole_ids(cut), kind)


def _whole_ids(f):
    def g(batches):
        return f(b.astype({"doc_id": "Int64"}) for b in batches)
    return g


class FreeSpace:
    """A tournament tree of bin capacities: each inner node has the larger free space of its two."""

    def __init__(self, bins: int, length: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.tree = [length] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """The leftmost bin with room for ``size``, and its free space before; takes the room."""
        tree, at = self.tree, 1
        while at < self.leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        free = tree[at]
        tree[at] = free - size
        bin_ = at - self.leaves
        while at > 1:
            at //= 2
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
        return bin_, free


def first_fit_decreasing(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece (none longer than ``length``) and its offset there."""
    order = np.argsort(-lengths, kind="stable")
    space = FreeSpace(len(lengths), length)
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    for i in order:
        bins[i], free = space.place(int(lengths[i]))
        offsets[i] = length - free
    return bins, offsets


def pack(cut: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``cut`` (any columns, with length) with sequence_id and offset. Rows are dealt to groups at random,
    from a written table, so that a rerun of a lost task deals them alike."""
    names = cut.columns
    cut = materialize(cut, "pack-pieces")
    groups = rows_per_split(cut.sparkSession, cut.count(), group)
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), length)
        return pdf[names].assign(sequence_id=pdf["_group"].to_numpy() * (1 << 32) + bins, offset=offsets)

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return dealt.groupBy("_group").applyInPandas(_nullable(packed), f"{kind}, sequence_id long, offset long")


def _nullable(f):
    """Null ids stay integers on their way through pandas."""
    def g(pdf):
        return f(pdf.astype({"doc_id": "Int64"}))
    return g


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from pieces that carry their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"))
