"""Approximate nearest neighbours by multiprobe p-stable hashing.

``TABLES`` hash tables cut space along ``PROJECTIONS`` Gaussian directions into cells of a
fitted width. A query visits its own bucket and perturbed ones in the order of their estimated
success; the candidates of all tables are ranked by their exact distance. Buckets are dealt to parts of
bounded size: a part's vectors are held in memory, its queries stream past, and only
the best few of each query and part leave the task. A part with too many vectors, such as one
hot bucket, is split by salt and its queries visit every split.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.sources.stages import cut_lineage

PROJECTIONS = 12
TABLES = 4
RELATIVE_WIDTH = 2.5  # cell width in standard deviations of a projection
NEAREST = 10
MAX_FIT = 8_192  # vectors the driver fits on
FIT_QUERIES = 256
RECALL = 0.95  # wanted on the fitting sample
PROBE_STEPS = (25, 50, 100, 200, 400, 800, 1_600, 3_200)
PART_ROWS = 16_384


def perturbations(projections: int, number: int) -> np.ndarray:
    """Up to ``number`` sets of boundary ranks, best expected success first, as rows of zeros and ones.

    Ranks number a query's 2k cell boundaries from nearest to farthest. The expected square of the
    distance to each ranks the sets; rank j and its mirror 2k-1-j are the two sides of one
    direction and exclude each other.
    """
    k, n = projections, 2 * projections
    j = np.arange(1, n + 1)
    near = j * (j + 1) / (4.0 * (k + 1) * (k + 2))
    far = 1 - (n + 1 - j) / (k + 1) + (n + 1 - j) * (n + 2 - j) / (4.0 * (k + 1) * (k + 2))
    expected = np.where(j <= k, near, far)
    found: list[tuple[int, ...]] = [()]
    heap = [(float(expected[0]), (0,))]
    while heap and len(found) < number:
        score, chosen = heapq.heappop(heap)
        if not any(n - 1 - r in chosen for r in chosen):
            found.append(chosen)
        last = chosen[-1]
        if last + 1 < n:
            step = float(expected[last + 1])
            heapq.heappush(heap, (score - float(expected[last]) + step, (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (score + step, (*chosen, last + 1)))
    out = np.zeros((len(found), n), np.int64)
    for row, chosen in enumerate(found):
        out[row, list(chosen)] = 1
    return out


@dataclass(frozen=True)
class Hashing:
    """Directions, shifts and code multipliers of all tables, and how many buckets a query visits."""

    directions: np.ndarray  # tables, dimensions, projections
    shifts: np.ndarray  # tables, projections
    multipliers: np.ndarray
    width: float
    probes: int

    @staticmethod
    def draw(dimensions: int, width: float, probes: int, seed: int) -> Hashing:
        rng = np.random.default_rng(seed)
        shape = (TABLES, PROJECTIONS)
        return Hashing(
            rng.standard_normal((TABLES, dimensions, PROJECTIONS)),
            rng.uniform(0, 1, shape),
            rng.integers(1, 2**62, shape) | 1,
            width,
            probes,
        )

    def _cells(self, vectors: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        at = vectors @ self.directions[table] / self.width + self.shifts[table]
        cells = np.floor(at)
        return cells.astype(np.int64), at - cells

    def codes(self, vectors: np.ndarray, table: int) -> np.ndarray:
        cells, _ = self._cells(vectors, table)
        return (cells * self.multipliers[table]).sum(axis=1)

    def probed(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Bucket codes to visit per vector, likeliest first. Twice as many sets as wanted are
        scored by the vector's own boundary distances."""
        cells, offset = self._cells(vectors, table)
        own = (cells * self.multipliers[table]).sum(axis=1)
        distance = np.concatenate((offset, 1 - offset), axis=1)
        order = np.argsort(distance, axis=1, kind="stable")
        near = np.take_along_axis(distance, order, axis=1) ** 2
        sets = perturbations(PROJECTIONS, 2 * self.probes)
        best = np.argsort(near @ sets.T, axis=1, kind="stable")[:, : self.probes]
        moves = np.concatenate((-self.multipliers[table], self.multipliers[table]))[order]
        return own[:, None] + np.take_along_axis(moves @ sets.T, best, axis=1)


def fit_hashing(sample: np.ndarray, seed: int = 5) -> Hashing:
    """Width from the spread of the sample, probes from its measured recall.

    Neighbours in a sample are farther apart than in the whole table, so the recall on the
    whole is rather higher. If even the most probes do not reach the wanted recall, cells are widened.
    """
    spread = float(np.sqrt(np.square(sample - sample.mean(axis=0)).sum(axis=1).mean())) or 1.0
    dimensions = sample.shape[1]
    queries = sample[:FIT_QUERIES]
    wanted = min(NEAREST, len(sample) - 1)
    if wanted < 1:
        return Hashing.draw(dimensions, RELATIVE_WIDTH * spread, PROBE_STEPS[0], seed)
    squares = np.square(sample).sum(axis=1)
    distance = squares[None, :] - 2 * queries @ sample.T
    distance[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    true = np.argsort(distance, axis=1, kind="stable")[:, :wanted]
    width = RELATIVE_WIDTH * spread
    while True:
        hashing = Hashing.draw(dimensions, width, PROBE_STEPS[-1], seed)
        rank = np.full((len(queries), wanted), PROBE_STEPS[-1])
        for table in range(TABLES):
            codes, visits = hashing.codes(sample, table), hashing.probed(queries, table)
            for q in range(len(queries)):
                place = {c: i for i, c in reversed(list(enumerate(visits[q].tolist())))}
                found = [place.get(c, PROBE_STEPS[-1]) for c in codes[true[q]].tolist()]
                rank[q] = np.minimum(rank[q], found)
        for probes in PROBE_STEPS:
            if (rank < probes).mean() >= RECALL:
                return Hashing.draw(dimensions, width, probes, seed)
        width *= 1.5


# --- Spark side -------------------------------------------------------------
def usable_vectors(table: DataFrame) -> DataFrame:
    """``vec_id, vec``: vectors of the commonest dimension without null, non-finite or only zero components."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    good = table.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole & F.exists("embedding", lambda x: x != 0)
    )
    size = F.size("embedding")
    common = good.groupBy(size.alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(size == (common["n"] if common else 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nested(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


_ROW = "tab int, part long, kind int, id long, codes array<long>, vec array<double>"
_NAMES = ["tab", "part", "kind", "id", "codes", "vec"]


def _index_rows(vectors: DataFrame, hashing: Hashing, parts: int) -> DataFrame:
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch.column(1))
            for table in range(TABLES):
                codes = hashing.codes(vectors, table)
                fixed = [np.full(len(codes), table, np.int32), codes % parts, np.zeros(len(codes), np.int32)]
                columns = [*map(pa.array, fixed), batch.column(0), _nested(codes[:, None]), batch.column(1)]
                yield pa.RecordBatch.from_arrays(columns, _NAMES)

    return vectors.mapInArrow(index, _ROW)


def _query_rows(queries: DataFrame, hashing: Hashing, parts: int) -> DataFrame:
    """A row per query, table and part that holds a bucket to visit, with those buckets' codes."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                some = batch.slice(start, 256)
                vectors, ids = _matrix(some.column(1)), some.column(0).to_pylist()
                for table in range(TABLES):
                    rows = []
                    for q, codes in enumerate(hashing.probed(vectors, table)):
                        part = codes % parts
                        order = np.argsort(part, kind="stable")
                        borders = np.flatnonzero(np.diff(part[order])) + 1
                        for chosen in np.split(order, borders):
                            rows.append((table, int(part[chosen[0]]), 1, ids[q], codes[chosen], vectors[q]))
                    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
                    columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, _NAMES)

    return queries.mapInArrow(probe, _ROW)


class _Part:
    """The vectors of one part, by bucket."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.codes: list[np.ndarray] = []
        self.vectors: list[np.ndarray] = []
        self.buckets = None

    def __bool__(self) -> bool:
        return bool(self.ids) or self.buckets is not None

    def add(self, ids: np.ndarray, codes: np.ndarray, vectors: np.ndarray) -> None:
        self.ids.append(ids)
        self.codes.append(codes)
        self.vectors.append(vectors)

    def nearest(self, query: int, codes: np.ndarray, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if self.buckets is None:
            all_codes = np.concatenate(self.codes)
            order = np.argsort(all_codes, kind="stable")  # a bucket's rows lie together
            self.all_ids, self.all_vectors = np.concatenate(self.ids)[order], np.concatenate(self.vectors)[order]
            self.repeats = len(np.unique(self.all_ids)) < len(self.all_ids)
            self.buckets, self.starts = np.unique(all_codes[order], return_index=True)
            self.starts = np.append(self.starts, len(order))
            self.ids, self.codes, self.vectors = [], [], []
        if len(codes):
            at = np.minimum(np.searchsorted(self.buckets, codes), len(self.buckets) - 1)
            at = np.unique(at[self.buckets[at] == codes])
            size = self.starts[at + 1] - self.starts[at]
            rows = np.arange(size.sum()) + np.repeat(self.starts[at] - (np.cumsum(size) - size), size)
        else:  # every bucket
            rows = np.arange(len(self.all_ids))
        rows = rows[self.all_ids[rows] != query]
        apart = self.all_vectors[rows] - vector
        distance = np.sqrt(np.einsum("ij,ij->i", apart, apart))
        ids = self.all_ids[rows]
        if self.repeats:  # an id counts once, at its smallest distance
            order = np.lexsort((distance, ids))
            ids, once = np.unique(ids[order], return_index=True)
            distance = distance[order][once]
        if len(ids) > k:
            near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
            ids, distance = ids[near], distance[near]
        order = np.lexsort((ids, distance))[:k]
        return ids[order], distance[order]


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by part, the part's vectors before its queries."""
        current, part = None, _Part()
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            ids = batch.column(4).to_numpy(zero_copy_only=False)
            borders = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1).tolist(), len(batch)]
            out: tuple[list, list, list] = ([], [], [])
            for a, b in zip(borders[:-1], borders[1:], strict=True):
                if a == b:
                    continue
                here = tuple(key[a, :3])
                if here != current:
                    current, part = here, _Part()
                vectors = _matrix(batch.column(6).slice(a, b - a))
                codes = batch.column(5).slice(a, b - a)
                if key[a, 3] == 0:
                    part.add(ids[a:b], codes.flatten().to_numpy(zero_copy_only=False), vectors)
                elif part:
                    for q in range(b - a):
                        found, distance = part.nearest(ids[a + q], codes[q].values.to_numpy(zero_copy_only=False), vectors[q], k)
                        out[0].append(np.full(len(found), ids[a + q]))
                        out[1].append(found)
                        out[2].append(distance)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["query_id", "vec_id", "score"])

    return search


def nearest_neighbours(table: DataFrame, is_query: Column, k: int = NEAREST, seed: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found rows of each query row.

    ``table`` has ``vec_id`` and ``embedding``; ``is_query`` marks query rows. Candidates are all rows
    but those of the query's own id; ties go to the smaller id. Rows without an id and vectors
    that are null, zero, of another than the commonest dimension, or hold null or non-finite components take no part. Of
    equal vectors only the k + 1 smallest ids can be among the nearest, so only those are
    indexed. Rows repeated with one id count once, at their smallest distance. An empty table gives no rows.
    """
    spark = table.sparkSession
    good = usable_vectors(table)
    total = good.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    some = good
    if total > MAX_FIT:
        cut = int(-(2**63) + (MAX_FIT / total) * 2**64)
        some = good.where(F.xxhash64("vec_id", F.lit(seed)) < F.lit(cut).cast("long"))
    # An id's smallest vector stands for its repeated rows, so that the sample's bound holds.
    sample = some.groupBy("vec_id").agg(F.min("vec").alias("vec")).toPandas().sort_values("vec_id", kind="stable")
    if not len(sample):
        sample = good.limit(1).toPandas()
    hashing = fit_hashing(np.stack(sample["vec"].to_numpy())[: 2 * MAX_FIT], seed)
    parts = -(-total // PART_ROWS)

    copies = Window.partitionBy(F.xxhash64("vec"), "vec").orderBy("vec_id")
    # Repeated rows are merged first, so that k + 1 counts different ids.
    kept = good.distinct().withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1).select("vec_id", "vec")
    index = _index_rows(kept, hashing, parts)
    probes = _query_rows(good.where(is_query), hashing, parts)
    crowded = (
        index.groupBy("tab", "part")
        .count()
        .where(F.col("count") > 2 * PART_ROWS)
        .select("tab", "part", F.ceil(F.col("count") / PART_ROWS).cast("int").alias("splits"))
    )
    splits = F.coalesce("splits", F.lit(1))
    columns = ["tab", "part", "salt", "kind", "id", "codes", "vec"]

    def search(vectors: DataFrame, visits: DataFrame) -> DataFrame:
        dealt_index = vectors.join(crowded, ["tab", "part"], "left").withColumn("salt", F.pmod(F.hash("id"), splits))
        dealt_visits = visits.join(crowded, ["tab", "part"], "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), splits - 1))
        )
        dealt = (
            dealt_index.select(*columns)
            .unionByName(dealt_visits.select(*columns))
            .repartition("tab", "part", "salt")
            .sortWithinPartitions("tab", "part", "salt", "kind", "id")
        )
        return dealt.mapInArrow(_search(k), "query_id long, vec_id long, score double")

    found = cut_lineage(search(index, probes))
    # A lone query may meet fewer than k rows in its buckets; it visits all buckets of one table.
    met = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("met"))
    lone = good.where(is_query).join(met, F.col("vec_id") == F.col("query_id"), "left").where(F.coalesce("met", F.lit(0)) < k)
    everywhere = lone.select(
        F.lit(0).alias("tab"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
        F.lit(1).alias("kind"),
        F.col("vec_id").alias("id"),
        F.array().cast("array<long>").alias("codes"),
        "vec",
    )
    if not lone.isEmpty():
        found = found.unionByName(search(index.where("tab = 0"), everywhere))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
