"""Words of whole batches as numpy arrays: no Python object per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of a batch's texts handled at a time (one longer text stands alone).
BATCH_BYTES = 4 << 20
WORD, BLANK, HARD = 0, 1, 2
_LOWER = bytes(range(256)).lower()


def classes(blanks: bytes, hard: bytes = b"") -> bytes:
    """Class of each byte: WORD, BLANK (ends a word) or HARD (ends a word and the piece it lies in)."""
    return bytes(BLANK if b in blanks else HARD if b in hard else WORD for b in range(256))


#: Words `[^\\x20\\x09-\\x0D]+`.
PLAIN = classes(b" \t\n\x0b\x0c\r")


@dataclass
class Words:
    """Words of a batch in order: `of` indexes `known` (distinct words, lower case, and what stands between words), `row` the batch's texts.

    `piece` numbers the pieces; words of different texts lie in different pieces.
    """

    known: list[bytes]
    of: np.ndarray
    row: np.ndarray
    piece: np.ndarray


def words_of(texts: pa.Array, table: bytes = PLAIN) -> Words:
    """Words of a binary array of UTF-8 texts (null: empty), A-Z lowered."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    begin, end = int(offsets[0]), int(offsets[-1])
    if begin == end:
        return Words([], *(np.zeros(0, np.int64) for _ in range(3)))
    data = texts.buffers()[2].slice(begin, end - begin).to_pybytes().translate(_LOWER)
    offsets = offsets - begin
    kind = np.frombuffer(data.translate(table), np.uint8)
    new = np.empty(len(data), bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new[offsets[:-1][offsets[:-1] < len(data)]] = True
    start = np.flatnonzero(new)
    of_token = kind[start]
    cuts = np.append(start, len(data)).astype(np.int32)
    tokens = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(cuts), pa.py_buffer(data)]).dictionary_encode()
    at = np.flatnonzero(of_token == WORD)
    row = np.searchsorted(offsets, start[at], side="right") - 1
    hard = np.cumsum(of_token == HARD)[at]
    changed = np.empty(len(at), bool)
    changed[:1] = True
    changed[1:] = (hard[1:] != hard[:-1]) | (row[1:] != row[:-1])
    return Words(tokens.dictionary.to_pylist(), tokens.indices.to_numpy()[at], row, np.cumsum(changed) - 1)
