"""Words of whole texts as numbers, many documents in one array.

A word is ``[^\\x20\\x09-\\x0D]+``, which is what ``bytes.split`` without arguments parts. Equal words have
equal numbers within one part; numbers of different parts are not comparable.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Words handled at once; a longer document is a part of its own, never cut.
PART_WORDS = 1 << 18

_MIX = np.uint64(0x9E3779B97F4A7C15)
_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


class Numbers(dict):
    """Numbers of words in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def parts(documents: Iterable[tuple[object, list[bytes]]]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(key, words) of documents -> parts of about PART_WORDS words: the (key, words) in it, the numbers of
    all its words, and where each document begins (one more entry than documents)."""
    held, total, numbers, ids = [], 0, Numbers(), []
    for key, words in documents:
        held.append((key, words))
        ids.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        total += len(words)
        if total >= PART_WORDS or len(held) >= PART_WORDS:
            yield held, np.concatenate(ids), np.cumsum([0, *map(len, ids)])
            held, total, numbers, ids = [], 0, Numbers(), []
    if held:
        yield held, np.concatenate(ids), np.cumsum([0, *map(len, ids)])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two neighbouring windows, each given by its hash, as one window."""
    return mixed(left * _LEFT + right * _RIGHT + _MIX)


def word_hashes(ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A hash of each word that tells documents of one part apart."""
    of = np.repeat(np.arange(len(begins) - 1, dtype=np.uint64), np.diff(begins))
    return joined(mixed(ids.astype(np.uint64) + _MIX), mixed(of))
