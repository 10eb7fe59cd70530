"""Token ids in a file format of fixed-width bits, with block offsets for random access.

File: blocks of BLOCK ids, each packed at `bits` bits an id, lowest bit first, each starting at a byte;
then the offsets of the blocks (uint64), the documents' ids (int64, with a null mask byte each) and starts
(uint64, in ids), and a trailer: bits, block size, number of ids, blocks and documents, magic.
Any range of ids is read from the blocks it touches alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doctables.llm import shared, tokens

BLOCK = 4096
MAGIC = b"BITIDS01"
TRAILER = struct.Struct("<IIQQQ8s")
BATCH_BYTES = 4 << 20


def bits_for(vocab_size: int) -> int:
    """Bits of the largest id, at least one."""
    return max(1, (int(vocab_size) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive `bits`-bit numbers, lowest bit first; the last byte is filled with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(wide[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first n ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    narrow = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: n * bits].reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = narrow
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)


class Writer:
    """Writes one file; holds at most a block of ids and the documents' starts."""

    def __init__(self, out, bits: int) -> None:
        self.out, self.bits = out, bits
        self.offsets, self.at, self.n = [], 0, 0
        self.rest = np.zeros(0, np.uint32)
        self.ids, self.null, self.starts = [], [], []

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"an id needs more than {self.bits} bits")
        self.starts.append(self.n + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.uint64))
        self.ids += [0 if d is None else d for d in doc_ids]
        self.null += [d is None for d in doc_ids]
        self.n += len(ids)
        ids = np.concatenate([self.rest, ids])
        full = len(ids) // BLOCK * BLOCK
        for b in range(0, full, BLOCK):
            self._block(ids[b : b + BLOCK])
        self.rest = ids[full:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.offsets.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        self.out.write(np.array([*self.offsets, self.at], "<u8").tobytes())
        self.out.write(np.array(self.ids, "<i8").tobytes())
        self.out.write(np.array(self.null, np.uint8).tobytes())
        self.out.write((np.concatenate(self.starts) if self.starts else np.zeros(0)).astype("<u8").tobytes())
        self.out.write(TRAILER.pack(self.bits, BLOCK, self.n, len(self.offsets), len(self.ids), MAGIC))


class Reader:
    """Reads a file at random: doc_ids, starts, and any range of ids."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        self.bits, self.block, self.n, blocks, docs, magic = TRAILER.unpack(self._at(size - TRAILER.size, TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        foot = 8 * (blocks + 1) + 17 * docs
        data = self._at(size - TRAILER.size - foot, foot)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1).astype(np.int64)
        at = 8 * (blocks + 1)
        ids = np.frombuffer(data, "<i8", docs, at).tolist()
        null = np.frombuffer(data, np.uint8, docs, at + 8 * docs)
        self.doc_ids = [None if z else d for d, z in zip(ids, null)]
        self.starts = np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64)

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def ids(self, start: int, n: int) -> np.ndarray:
        if n <= 0:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (start + n - 1) // self.block
        data = self._at(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        if self.block * self.bits % 8 == 0:  # blocks lie gapless: one unpacking
            count = min(self.n, (last + 1) * self.block) - first * self.block
            return unpack(data, count, self.bits)[start - first * self.block :][:n]
        parts = []
        for b in range(first, last + 1):
            lo = int(self.offsets[b] - self.offsets[first])
            parts.append(unpack(data[lo : lo + int(self.offsets[b + 1] - self.offsets[b])], min(self.block, self.n - b * self.block), self.bits))
        return np.concatenate(parts)[start - first * self.block :][:n]


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, files: int) -> DataFrame:
    """Encode `text` of (doc_id, text) and write files in ascending doc_id order.

    Documents are dealt by ranges of doc_id, so file k holds smaller ids than file k+1. Each task names its
    file with its attempt: a task that runs twice leaves a file that no row names. Returns (part, file, n_ids).
    Null text is empty; null doc_ids come first; rows of one doc_id stay all, ordered by text; other columns
    are ignored; an empty table gives no rows.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange(files, "doc_id", "text").sortWithinPartitions("doc_id", "text")

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        writer = None
        for batch in shared.batches_of(it, "text", BATCH_BYTES):
            if writer is None:
                where, path = shared.file_system(folder)
                where.create_dir(path, recursive=True)
                out = where.open_output_stream(f"{path}/{name}")
                writer = Writer(out, bits_for(max(enc.vocab_size, end_id + 1)))
            ids, n = enc.encode(batch.column("text").to_pylist())
            ends = np.cumsum(n)
            writer.add(batch.column("doc_id").to_pylist(), np.insert(ids, ends, end_id), n + 1)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "file": [f"{folder}/{name}"], "n_ids": [writer.n]})
        shared.trim()

    return ordered.mapInArrow(write, "part long, file string, n_ids long")


def read_ids(files: DataFrame, budget: int = 1 << 20) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in files (file, base); start counts from base.

    A document's ids are read at most `budget` at a time.
    """

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                where, path = shared.file_system(file)
                with where.open_input_file(path) as source:
                    reader = Reader(source)
                    counts = np.diff(np.append(reader.starts, reader.n))
                    crc = np.zeros(len(counts), np.int64)
                    i = 0
                    while i < len(counts):
                        j, start = i + 1, int(reader.starts[i])
                        while j < len(counts) and reader.starts[j] + counts[j] - start <= budget:
                            j += 1
                        if counts[i] > budget:
                            c = 0
                            for at in range(start, start + int(counts[i]), budget):
                                c = zlib.crc32(reader.ids(at, min(budget, start + int(counts[i]) - at)).astype("<u4").tobytes(), c)
                            crc[i] = c
                        else:
                            data = memoryview(reader.ids(start, int(reader.starts[j - 1] + counts[j - 1]) - start).astype("<u4").tobytes())
                            for k in range(i, j):
                                lo = int(reader.starts[k]) - start
                                crc[k] = zlib.crc32(data[4 * lo : 4 * (lo + int(counts[k]))])
                        i = j
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array(reader.doc_ids, pa.int64()), "start": base + reader.starts, "n_tokens": counts.astype(np.int64), "ids_crc32": crc})

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def packed_ids(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, files: int | None = None) -> DataFrame:
    """Write the ids of all documents as packed files and read them back.

    Driver work is one row per file, whose number is the parameter `files`.
    """
    spark = docs.sparkSession
    files = files or shared.partitions(spark)
    made = shared.written(write_ids(docs, shared.new_folder(spark, "ids"), tokenizer or tokens.default_path(), end_id, files), "id-files")
    base, rows = 0, []
    for r in sorted(made.collect(), key=lambda r: r.part):
        rows.append((r.file, base))
        base += r.n_ids
    listed = spark.createDataFrame(rows, "file string, base long")
    return read_ids(listed.repartition(max(1, len(rows)), "file") if rows else listed)


def op5_packed_ids(spark, sf_dir):
    """All documents as packed ids of 16 bits, read back."""
    return packed_ids(shared.table(spark, sf_dir, "documents"))
