"""Byte-level BPE ids of whole texts, by the tokenizers library, with a bounded cache of pieces.

A byte-level BPE first cuts a text by a pattern (blanks, letters, digits, marks) and then merges inside each cut.
`cuts` finds places that the pattern never crosses from the bytes alone: ahead of blanks, and between ASCII letters, digits and
marks. A text is the sequence of its pieces between them, and equal pieces have equal ids: each is encoded by the library once and
then looked up. When the cache is full, the pieces met in the most batches stay. Texts with special tokens go to the library as they are.
"""

from __future__ import annotations

import os

import numpy as np

from doctables.llm import shared

#: Pieces a worker remembers at most, beyond those of one batch.
CACHE_PIECES = 400_000
#: Pieces that go to the library at a time.
CHUNK = 8192
_LETTER, _DIGIT, _MARK, _SPACE, _BLANK, _OTHER = 1, 2, 3, 4, 5, 6
_CLASS = np.full(256, _OTHER, np.uint8)  # bytes beyond ASCII, and the blanks that are not ASCII, are of no known class
_CLASS[:128] = _MARK
_CLASS[9:14] = _BLANK
_CLASS[32] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a vocabulary file; kept between tasks."""
    return shared.held(path, lambda: Encoder(path))


def cuts(data: np.ndarray) -> np.ndarray:
    """True at bytes of UTF-8 ahead of which the pattern always cuts, whatever stands around.

    A piece that ends in a blank beyond ASCII is cut too early where a space follows; `Encoder` finds those by their text.
    """
    kind = _CLASS[data]
    lead = np.flatnonzero(((data >= 0xC3) & (data <= 0xC8)) | (data == 0xD0) | (data == 0xD1))  # U+00C0 to U+023F, U+0400 to U+047F
    lead = lead[lead + 1 < len(data)]
    lead = lead[(data[lead] != 0xC3) | ((data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]  # the signs among those letters
    kind[lead] = kind[lead + 1] = _LETTER
    cut = np.zeros(len(data), bool)
    before, here = kind[:-1], kind[1:]
    known = before <= _MARK
    # a run of blanks begins: ahead of a space after anything but an ASCII blank, ahead of other blanks after known classes
    cut[1:] = (here == _SPACE) & (before != _SPACE) & (before != _BLANK) | (here == _BLANK) & known
    # another class begins; an apostrophe may take the letters behind it
    cut[1:] |= known & (here <= _MARK) & (before != here) & (data[:-1] != 39)
    # one blank other than a space, between known classes, stands alone
    cut[2:] |= known[:-1] & (kind[1:-1] == _BLANK) & (here[1:] <= _MARK)
    return cut


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes_of = np.zeros(self.vocab_size, np.int64)  # a letter of the byte-level alphabet is a byte
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes_of[i] = len(token)
        self.clear()

    def clear(self) -> None:
        self.entries: dict[bytes, int] = {}  # piece -> entry
        self.flat = np.zeros(0, np.uint32)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.odd = np.zeros(0, bool)
        self.met = np.zeros(0, np.int64)  # batches

    def _shrink(self) -> None:
        """Keep the half of the pieces met in the most batches."""
        stay = np.sort(np.argsort(-self.met, kind="stable")[: CACHE_PIECES // 2])
        pieces = list(self.entries)
        self.entries = {pieces[k]: i for i, k in enumerate(stay.tolist())}
        size, begin = self.size[stay], self.begin[stay]
        upto = np.cumsum(size)
        self.flat = self.flat[np.repeat(begin - (upto - size), size) + np.arange(upto[-1])]
        self.begin, self.size, self.odd, self.met = upto - size, size, self.odd[stay], self.met[stay] // 2

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> None:
        """Enter new pieces. Those led by a space go to the library as one text, whose ids are dealt by their bytes."""
        led, rest = [], []
        for p in new:
            t = p.decode("utf-8", "surrogatepass")
            (led if t[0] == " " and not t[-1].isspace() else rest).append((p, t))
        chunks = lambda x: (x[at : at + CHUNK] for at in range(0, len(x), CHUNK))  # noqa: E731  # the library's results are many times the ids
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(self._encode(["".join(t for _, t in own)])[0], np.uint32) for own in chunks(led))])
        ends = np.cumsum(np.array([len(p) for p, _ in led], np.int64))
        at = np.cumsum(self.bytes_of[ids])
        upto = np.searchsorted(at, ends) + 1
        if len(led) and not np.array_equal(at[upto - 1], ends):
            raise ValueError("the tokenizer merges over a space")
        found = [f for own in chunks(rest) for f in self._encode([t for _, t in own])]
        size = np.concatenate([np.diff(upto, prepend=0), np.array([len(f) for f in found], np.int64)])
        n = len(self.entries)
        self.entries.update(zip((p for p, _ in led + rest), range(n, n + len(new))))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.flat = np.concatenate([self.flat, ids, np.array([i for f in found for i in f], np.uint32)])
        self.size = np.concatenate([self.size, size])
        self.odd = np.concatenate([self.odd, np.zeros(len(led), bool), np.array([t[-1] > "\x7f" and t[-1].isspace() for _, t in rest], bool)])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end as uint32, number of ids of each text); null is empty.

        Every distinct piece is looked up once. Where a piece ends in a blank beyond ASCII, or a special token occurs, the
        whole text goes to the library.
        """
        import pyarrow as pa

        if len(self.entries) > CACHE_PIECES:
            self._shrink()
        whole = [bool(t) and any(s in t for s in self.special) for t in texts]
        data = [b"" if w or not t else t.encode("utf-8", "surrogatepass") for t, w in zip(texts, whole)]
        ends = np.cumsum(np.array([len(d) for d in data], np.int64))
        data = b"".join(data)
        new = cuts(np.frombuffer(data, np.uint8))
        new[(ends - np.diff(ends, prepend=0))[np.diff(ends, prepend=0) > 0]] = True
        start = np.flatnonzero(new)
        bounds = pa.py_buffer(np.append(start, len(data)).astype(np.int32))
        pieces = pa.Array.from_buffers(pa.binary(), len(start), [None, bounds, pa.py_buffer(data)]).dictionary_encode()
        known = pieces.dictionary.to_pylist()
        self._learn([p for p in known if p not in self.entries])
        entry = np.fromiter(map(self.entries.__getitem__, known), np.int64, len(known))
        self.met[entry] += 1
        entry = entry[pieces.indices.to_numpy()]
        upto_piece = np.searchsorted(start, ends)
        count = np.diff(upto_piece, prepend=0)
        odd = np.append(0, np.cumsum(self.odd[entry]))
        for i in np.flatnonzero(odd[upto_piece] > odd[upto_piece - count]).tolist():
            whole[i] = True
        size = self.size[entry]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.begin[entry] - upto[:-1], size) + np.arange(upto[-1])]
        n_ids = upto[upto_piece] - upto[upto_piece - count]
        own = [i for i, w in enumerate(whole) if w]
        if own:
            parts = np.split(ids, np.cumsum(n_ids)[:-1])
            for i, found in zip(own, self._encode([texts[i] for i in own])):
                parts[i] = np.array(found, np.uint32)
                n_ids[i] = len(found)
            ids = np.concatenate(parts)
        return ids, n_ids
