"""Words of an Arrow column of texts as numbers, found on the bytes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What a byte is: part of a word, white space between words, or the end of a piece.
WORD, SPACE, BREAK = 0, 1, 2


class Words(NamedTuple):
    codes: np.ndarray  # number of each word in ``distinct``
    distinct: pa.Array  # binary
    firsts: np.ndarray  # first word of each text, and the number of all words
    pieces: np.ndarray  # number of the piece each word stands in


def byte_kinds(spaces: bytes, breaks: bytes = b"") -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[list(spaces)] = SPACE
    kinds[list(breaks)] = BREAK
    return kinds


#: Words are runs without \x20 and \x09-\x0D.
PLAIN = byte_kinds(b" \t\n\x0b\x0c\r")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: none) and where each text starts, with the end."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def strings(data: np.ndarray, ends: np.ndarray, kind=None) -> pa.Array:
    """Arrow array of the consecutive byte runs that end at ``ends`` (which starts with 0)."""
    small = ends[-1] < 1 << 31
    kind = kind or (pa.binary() if small else pa.large_binary())
    ends = ends.astype(np.int32 if small else np.int64)
    return pa.Array.from_buffers(kind, len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def split_words(texts: pa.Array, kinds: np.ndarray = PLAIN, lower: bool = False) -> Words:
    data, ends = text_bytes(texts)
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        data = table[data]
    kind = kinds[data]
    inside = kind == WORD
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True  # texts start and end here
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1] if len(data) else inside
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:] if len(data) else inside
    lens = np.flatnonzero(inside & ~after) + 1 - starts
    coded = strings(data[inside], np.concatenate([[0], np.cumsum(lens)])).dictionary_encode()
    limits = np.sort(np.concatenate([np.flatnonzero(kind == BREAK), ends[:-1]]))
    return Words(
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        coded.dictionary,
        np.searchsorted(starts, ends),
        np.searchsorted(limits, starts, side="right"),
    )
