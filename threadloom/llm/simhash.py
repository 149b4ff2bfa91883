"""SimHash near-duplicates by a grid range-join on segment bit counts.

A 64-bit fingerprint becomes a point: the bit counts of its segments. One differing bit moves the
point by at most one step along one axis, so the Manhattan distance of two points never
exceeds the Hamming distance of the fingerprints. The range join looks up every grid cell
within that distance and verifies the Hamming distance exactly. Only different
fingerprints are joined; copies share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import small_slices, text_bytes
from threadloom.llm.components import components
from threadloom.sources.stages import cut_lineage

BITS = 64
SEGMENTS = 8  # 16 give about a thousandth of the candidates for four times the probes
SEED = 42
SHINGLE_WORDS = 3
MAX_DISTANCE = 2


def _shingle_hashes(text: bytes, shingle_words: int) -> np.ndarray:
    """XXH64 of the text's word shingles, repeats included; of all words if they are too few, none without words."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z and the six ASCII blanks only
    n = len(words) - shingle_words + 1
    if n <= 1:
        return np.asarray([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)


def _fingerprint(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have set; zero without hashes."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, -(-n // 65_536)):
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _byte_texts(texts: pa.Array) -> Iterator[bytes]:
    raw, starts = text_bytes(texts)
    data, bounds = raw.tobytes(), starts.tolist()
    return (data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))


def fingerprint_column(text: str | Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The 64-bit SimHash as a signed long; null and empty texts give zero."""

    @F.arrow_udf("long")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for texts in small_slices(batch):
                out += [_fingerprint(_shingle_hashes(t, shingle_words)) for t in _byte_texts(texts)]
            yield pa.array(np.asarray(out, np.uint64).view(np.int64))

    return fingerprint(text)


def _cell_bits(segments: int) -> int:
    """Bits for a segment's count, one more than its largest, and a borrow."""
    return (BITS // segments + 1).bit_length()


def _cell(fingerprint: str, segments: int) -> Column:
    """Bit counts of the segments, a few bits each, in one long."""
    width, bits = BITS // segments, _cell_bits(segments)
    cell = F.lit(0).cast("long")
    for i in range(segments):
        ones = F.bit_count(F.shiftrightunsigned(fingerprint, width * i).bitwiseAND(F.lit((1 << width) - 1))).cast("long")
        cell = cell + F.shiftleft(ones, bits * i)
    return cell


def _offsets(radius: int, segments: int) -> list[int]:
    """Code differences of the cells within Manhattan ``radius``, one of each opposite pair.

    An impossible count (below 0 or above a segment's width) borrows or stays within its bits and so
    never equals a real cell's code.
    """
    bits, steps = _cell_bits(segments), set()
    for axes in combinations_with_replacement(range(segments), radius):
        for signs in product((-1, 0, 1), repeat=radius):
            step = [0] * segments
            for axis, sign in zip(axes, signs, strict=True):
                step[axis] += sign
            if tuple(step) >= (0,) * segments:
                steps.add(tuple(step))
    return [sum(s << (bits * i) for i, s in enumerate(step)) for step in sorted(steps)]


def near_pairs(fingerprints: DataFrame, max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """``a, b``: all pairs of the distinct, non-null ``fp`` values at most ``max_distance`` bits apart."""
    points = fingerprints.select("fp").withColumn("cell", _cell("fp", segments))
    offsets = F.array(*[F.lit(o).cast("long") for o in _offsets(max_distance, segments)])
    probes = points.select(F.col("fp").alias("a"), "cell", F.explode(offsets).alias("step")).select(
        "a", (F.col("cell") + F.col("step")).alias("cell"), (F.col("step") == 0).alias("same")
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    once = ~F.col("same") | (F.col("a") < F.col("b"))
    return probes.join(points.withColumnRenamed("fp", "b"), "cell").where(near & once).select("a", "b")


def _classes(marked: DataFrame, first: Column, max_distance: int, segments: int) -> DataFrame:
    """``fp, root, first``: the class of every different fingerprint of ``marked``, and the
    least ``first`` of a class's rows."""
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min(first).alias("first")))
    roots = components(near_pairs(distinct, max_distance, segments)).withColumnRenamed("node", "fp")
    placed = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("first").alias("first"))
    return placed.select("fp", "root").join(least, "root")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` linked to the row directly or through
    others, itself included; null ids never name a component, so one of null ids only has a null
    id. Null and empty texts share the zero fingerprint and link like any other. Repeated rows
    are returned each; an empty table gives no rows; other columns are not read.
    """
    marked = cut_lineage(docs.select("doc_id", fingerprint_column("text", shingle_words).alias("fp")))
    classes = _classes(marked, F.col("doc_id"), max_distance, segments)
    # One row per different fingerprint on the right; a hot fingerprint is a skewed left side.
    return marked.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def drop_near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS
) -> DataFrame:
    """One row of each component of ``near_duplicates``, with all its columns.

    The row with the smallest ``doc_id`` stays (a null id only if there is no other; of equal ids
    the smaller text hash); rows repeated with the same id and text count once. Null and
    empty texts share a fingerprint and so are one component; an empty table gives no rows.
    """
    own = [F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.xxhash64("text").alias("_text")]
    key = ["_none", "_id", "_text"]
    marked = cut_lineage(docs.select(*own, fingerprint_column("text", shingle_words).alias("fp")))
    keepers = _classes(marked, F.struct(*key), max_distance, segments).select("first.*").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_row"), *own)
    # Repeated rows are combined before the shuffle, and the join keeps its partitions.
    return rows.dropDuplicates(key).join(keepers, key, "left_semi").select("_row.*")
