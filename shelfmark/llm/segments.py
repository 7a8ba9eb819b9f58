"""Cutting many texts into words at ASCII separators with numpy, on their UTF-8 bytes.

Every separator is an ASCII byte and no byte of a longer UTF-8 sequence is one, so cutting bytes is
cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
JOINT = b"\n"  # between two texts; callers count it among their breaks


class Words(NamedTuple):
    codes: np.ndarray  # number of each word in ``distinct``
    distinct: list[bytes]
    pieces: np.ndarray  # grows at every break; words with one number have none between them
    starts: np.ndarray  # byte at which each word starts in the joined texts


def classes(separators: bytes, breaks: bytes) -> np.ndarray:
    """Class of every byte: 0 part of a word, 1 separator, 2 break."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(separators)] = 1
    kinds[list(breaks)] = 2
    return kinds


def slices(texts: list[bytes], most_bytes: int) -> Iterator[list[bytes]]:
    """Runs of whole texts of at most ``most_bytes``; a longer text is a run of its own."""
    run: list[bytes] = []
    held = 0
    for text in texts:
        if run and held + len(text) > most_bytes:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


def cut_words(texts: list[bytes], kinds: np.ndarray, lower: bool = False) -> Words:
    """All words of ``texts`` in order; a text's end is a break."""
    data = np.frombuffer(JOINT.join(texts), np.uint8)
    if lower:
        data = LOWER[data]
    kind = kinds[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    codes, distinct = numbered(data, inside, first)
    return Words(codes, distinct, np.cumsum(kind == 2, dtype=np.int32)[starts], starts)


def numbered(data: np.ndarray, inside: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(number of each word, different words): words are the runs of ``inside`` bytes that begin at ``first``."""
    kept = data[inside]
    offsets = np.append(np.flatnonzero(first[inside]), len(kept)).astype(np.int32)
    if not len(kept):
        return np.empty(0, np.int64), []
    words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary.to_pylist()


def text_numbers(texts: list[bytes], starts: np.ndarray) -> np.ndarray:
    """Which of ``texts`` each word, given by its start in the joined texts, belongs to."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.concatenate(([0], np.cumsum(lengths + len(JOINT))[:-1])) if len(texts) else np.empty(0, np.int64)
    return np.searchsorted(firsts, starts, "right") - 1
