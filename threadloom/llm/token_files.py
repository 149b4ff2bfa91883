"""Token ids in files of fixed-width bits, with block offsets for random access.

File: header, blocks, index, trailer. Every id takes the bits of the largest id of the
vocabulary. A block holds ``BLOCK_IDS`` ids: 64 ids fill exactly ``width`` 64-bit words, so packing
and unpacking are a few numpy operations for all groups of 64 at once. The index has the byte
offset of each block and, per document, its id and the position of its first token.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.common import small_slices
from threadloom.llm.files import atomic_output, exact_reader, open_input
from threadloom.llm.tokens import encoder
from threadloom.sources.stages import scratch_path

MAGIC = b"TLTOKEN1"
BLOCK_IDS = 1 << 16
END_ID = 0
_HEADER = "<8sBII"  # magic, width, vocabulary, ids per block
_TRAILER = "<QQQQI8s"  # documents, ids, blocks, index offset, index crc32, magic


def id_width(vocabulary: int) -> int:
    """Bits of the largest id."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids as consecutive ``width``-bit fields, lowest bit first, padded to groups of 64 ids."""
    groups = -(-len(ids) // 64)
    padded = np.zeros(groups * 64, np.uint64)
    padded[: len(ids)] = ids
    columns = padded.reshape(groups, 64)
    words = np.zeros((groups, width), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        words[:, word] |= columns[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= columns[:, j] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack_bits(data: bytes, width: int, count: int) -> np.ndarray:
    words = np.frombuffer(data, "<u8").reshape(-1, width)
    ids = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        ids[:, j] = value & mask
    return ids.reshape(-1)[:count]


class TokenFileWriter:
    def __init__(self, out, vocabulary: int, block_ids: int = BLOCK_IDS):
        self.out, self.vocabulary, self.block_ids = out, vocabulary, block_ids
        self.width = id_width(vocabulary)
        self.rest: list[np.ndarray] = []
        self.waiting = 0
        self.doc_ids: list[int | None] = []
        self.starts = [0]
        self.at = out.write(struct.pack(_HEADER, MAGIC, self.width, vocabulary, block_ids))
        self.offsets = [self.at]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids))
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block_ids:
            self._write(False)

    def _write(self, last: bool) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) - len(ids) % self.block_ids
        for a in range(0, whole, self.block_ids):
            self.at += self.out.write(pack_bits(ids[a : min(a + self.block_ids, whole)], self.width))
            self.offsets.append(self.at)
        self.rest = [ids[whole:]]
        self.waiting = len(ids) - whole

    def close(self) -> None:
        self._write(True)
        known = np.asarray([d is not None for d in self.doc_ids], np.uint8)
        index = (
            np.asarray([d or 0 for d in self.doc_ids], "<i8").tobytes()
            + known.tobytes()
            + np.asarray(self.starts, "<u8").tobytes()
            + np.asarray(self.offsets, "<u8").tobytes()
        )
        self.out.write(index)
        sizes = (len(self.doc_ids), self.starts[-1], len(self.offsets) - 1, self.at)
        self.out.write(struct.pack(_TRAILER, *sizes, zlib.crc32(index), MAGIC))


class TokenFile:
    """Reads a token file: in order by ``documents``, or one document by ``document``."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        read = exact_reader(stream)
        stream.seek(size - struct.calcsize(_TRAILER))
        n, self.tokens, blocks, at, crc, magic = struct.unpack(_TRAILER, read(struct.calcsize(_TRAILER)))
        stream.seek(0)
        head, self.width, self.vocabulary, self.block_ids = struct.unpack(_HEADER, read(struct.calcsize(_HEADER)))
        if head != MAGIC or magic != MAGIC:
            raise ValueError("not a token file")
        stream.seek(at)
        index = read(size - struct.calcsize(_TRAILER) - at)
        if zlib.crc32(index) != crc:
            raise ValueError("the index is damaged")
        ids = np.frombuffer(index, "<i8", n)
        known = np.frombuffer(index, np.uint8, n, 8 * n)
        self.doc_ids = [d if k else None for d, k in zip(ids.tolist(), known.tolist(), strict=True)]
        self.starts = np.frombuffer(index, "<u8", n + 1, 9 * n).astype(np.int64)
        self.offsets = np.frombuffer(index, "<u8", blocks + 1, 9 * n + 8 * (n + 1)).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        self.stream.seek(int(self.offsets[k]))
        data = exact_reader(self.stream)(int(self.offsets[k + 1] - self.offsets[k]))
        return unpack_bits(data, self.width, min(self.block_ids, self.tokens - k * self.block_ids))

    def document(self, row: int) -> np.ndarray:
        """The ids of document ``row`` of the file; only the blocks it touches are read."""
        a, b = int(self.starts[row]), int(self.starts[row + 1])
        if a == b:
            return np.zeros(0, np.uint32)
        first, last = a // self.block_ids, (b - 1) // self.block_ids
        ids = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return ids[a - first * self.block_ids : b - first * self.block_ids]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``doc_id, start in the file, ids`` of all documents; every block is read once."""
        held, base, k = np.zeros(0, np.uint32), 0, 0
        for row, doc_id in enumerate(self.doc_ids):
            a, b = int(self.starts[row]), int(self.starts[row + 1])
            if b > base + len(held):
                parts, base = [held[a - base :]], a
                have = len(parts[0])
                while have < b - a:
                    parts.append(self.block(k))
                    have += len(parts[-1])
                    k += 1
                held = np.concatenate(parts)
            yield doc_id, a, held[a - base : b - base]


MANIFEST = "shard int, path string, documents long, tokens long"


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` in ascending ``doc_id`` order (nulls first, then by text hash) into one file
    per range of ids under ``folder``; the manifest table, a row per file, is written beside them.

    A null text is an empty one. Repeated ids and rows are all written.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        first = next(iter(batches), None)
        if first is None:
            return
        encode = encoder(tokenizer_path)
        end = np.asarray([end_id], "<u4")
        path = f"{folder}/ids-{shard:06d}.tok"
        with atomic_output(path) as out:
            writer = TokenFileWriter(out, encode.vocabulary)
            batch: pa.RecordBatch | None = first
            while batch is not None:
                done = 0
                for texts in small_slices(batch.column(1)):
                    doc_ids = batch.column(0).slice(done, len(texts)).to_pylist()
                    for doc_id, ids in zip(doc_ids, encode.encode(texts), strict=True):
                        writer.add(doc_id, np.concatenate((ids, end)))
                    done += len(texts)
                batch = next(batches, None)
            writer.close()
        row = [[shard], [path], [len(writer.doc_ids)], [writer.starts[-1]]]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["shard", "path", "documents", "tokens"]
        )

    order = ["doc_id", "_tie"]
    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "text", "xxhash64(text) as _tie")
    written = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(write, MANIFEST)
    written.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files of ``manifest``.

    ``start`` counts the ids of all earlier documents: the file's offset comes from the
    manifest, which has one row per file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_input(path) as stream:
                    rows = [
                        (doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for doc_id, start, ids in TokenFile(stream).documents()
                    ]
                columns = zip(*rows, strict=True) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    files = based.repartition(manifest.sparkSession.sparkContext.defaultParallelism, "path")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` to token files under ``folder`` (shared scratch by default) and read them back.

    An empty table gives no rows; columns other than ``doc_id`` and ``text`` are not read.
    """
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id))
