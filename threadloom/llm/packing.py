"""Cost-balanced packing of documents into token sequences of bounded length.

A piece's cost is linear plus quadratic (attention) in its length. Descending pieces go
to the lowest-cost sequence that still has room for them. Each task encodes its own
split of the documents and packs it in windows of a bounded number of tokens, so no
token is shuffled, memory does not depend on the data, and a hot source or a very long
document is nothing special. Every window but for its last fraction of a sequence is filled
to the brim, because a piece that fits nowhere whole is cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from threadloom.llm.common import small_slices
from threadloom.llm.tokens import encoder

SEQUENCE_TOKENS = 2048
END_ID = 1
WINDOW_TOKENS = 1 << 22
LINEAR_COST = 1.0
QUADRATIC_COST = 1.0 / SEQUENCE_TOKENS

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, `offset` long, padding long, cost double"
)


def piece_cost(length):
    return LINEAR_COST * length + QUADRATIC_COST * length * length


def pack_window(lengths: np.ndarray, capacity: int = SEQUENCE_TOKENS) -> tuple[np.ndarray, np.ndarray, int]:
    """Pack documents of ``lengths`` ids into as few sequences as can hold them.

    Returns piece rows ``document, start, length, sequence, offset``, the ids in each
    sequence, and their number. Longer documents are cut at multiples of the capacity; equal
    lengths keep their order, equal costs take the first sequence.
    """
    total = int(lengths.sum())
    count = -(-total // capacity)
    used = np.zeros(count, np.int64)
    cost = np.zeros(count)
    pieces: list[tuple[int, int, int, int, int]] = []

    def put(document: int, start: int, length: int, sequence: int) -> None:
        pieces.append((document, start, length, sequence, int(used[sequence])))
        used[sequence] += length
        cost[sequence] += piece_cost(length)

    full = 0
    rest: list[tuple[int, int, int]] = []
    for document, length in enumerate(lengths.tolist()):
        start = 0
        while length - start >= capacity:
            put(document, start, capacity, full)
            start += capacity
            full += 1
        if length > start:
            rest.append((document, start, length - start))
    rest.sort(key=lambda p: -p[2])
    open_cost, open_used = cost[full:], used[full:]  # views: the sequences still to fill
    for document, start, length in rest:
        while length:
            fits = open_used <= capacity - length
            if fits.any():
                at = int(np.where(fits, open_cost, np.inf).argmin())
                part = length
            else:  # cut: fill the emptiest sequence
                at = int(open_used.argmin())
                part = capacity - int(open_used[at])
            put(document, start, part, full + at)
            start += part
            length -= part
    return np.asarray(pieces, np.int64).reshape(-1, 5), used, count


def padding(used: np.ndarray, capacity: int = SEQUENCE_TOKENS) -> np.ndarray:
    """Pad ids of sequences of ``used`` ids: up to the capacity, none at a power of two."""
    return np.where((used & (used - 1)) == 0, 0, capacity - used)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = END_ID,
    capacity: int = SEQUENCE_TOKENS,
    window_tokens: int = WINDOW_TOKENS,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: its place in its document and in its sequence, and the crc32 of its ids.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. A null text is
    an empty one, of which only the end id remains. Null and repeated ids and repeated rows are
    packed like any other; an empty table gives no rows. With ``keep_ids`` the piece's ids come
    along as unsigned little-endian 32-bit integers in the column ``ids``.
    """
    schema = SCHEMA + (", ids binary" if keep_ids else "")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        partition = TaskContext.get().partitionId()
        end = np.asarray([end_id], "<u4")
        sequences = 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequences, tokens
            if not held:
                return
            lengths = np.asarray([len(x) for x in held], np.int64)
            pieces, used, count = pack_window(lengths, capacity)
            order = np.lexsort((pieces[:, 4], pieces[:, 3]))
            pad = padding(used, capacity)
            for start in range(0, len(order), 20_000):
                rows = pieces[order[start : start + 20_000]]
                document, first, length, sequence, offset = rows.T
                ids = [held[d][a : a + n].tobytes() for d, a, n in zip(document, first, length, strict=True)]
                columns = [
                    pa.array([doc_ids[d] for d in document], pa.int64()),
                    pa.array(first),
                    pa.array(length),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array(lengths[document]),
                    pa.array((partition << 32) + sequences + sequence),
                    pa.array(offset),
                    pa.array(pad[sequence]),
                    pa.array(piece_cost(length.astype(float))),
                ]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padding", "cost"]
                if keep_ids:
                    columns.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
            sequences += count
            doc_ids.clear()
            held.clear()
            tokens = 0

        for batch in batches:
            done = 0
            for texts in small_slices(batch.column(1)):
                for ids in encode(texts):
                    held.append(np.concatenate((ids, end)))
                    tokens += len(held[-1])
                doc_ids += batch.column(0).slice(done, len(texts)).to_pylist()
                done += len(texts)
                if tokens >= window_tokens:
                    yield from flush()
        yield from flush()

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(pack, schema)
