"""Exact BM25 top-k by block-max WAND over sharded inverted indexes.

Tasks index their own split of the documents into shard files in the shared folder: postings by term,
in blocks of documents. Document frequencies and lengths are summed over all shards, so that every
shard scores with global statistics. A search task loads a shard, turns term frequencies into
impacts with their maxima per term and block. Common terms that cannot reach the k-th score by themselves nominate no
document, and blocks whose summed maxima stay below it are skipped unread. Common terms, whose postings would be
most of those read, are scored for a tile of queries at once by a matrix product. A task searches a chain of shards
one after the other for a block of queries and carries each query's best rows along, so that a shard starts with the
k-th score reached so far and a chain gives k rows a query. The chains' exact best rows are merged exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.llm.common import ascii_words, ascii_words_sql
from threadloom.llm.files import atomic_output, open_input
from threadloom.sources.stages import scratch_path

K1, B = 1.2, 0.75
TOP = 10
BLOCK_DOCS = 64
SHARD_DOCS = 8_192
SHARD_TOKENS = 1 << 24
SPARE = 1.25  # a shard may be so much fuller, rather than leave a small one behind
QUERY_BLOCK = 4_096  # queries that meet a shard at once, if there are several such blocks
SMALL_BLOCK = 1_024
QUERY_BLOCKS = 8  # wanted, so that a block is smaller while it is larger than a small one
CHAINS = 4  # of shards, for each block of queries
CHAIN_SHARDS = 16  # beyond them there are more chains
QUERY_TILE = 64  # queries of one matrix product
COMMON_SHARE = 0.05  # of a shard's documents: terms in as many are columns of its matrix
MAX_COMMON = 512
RUN_POSTINGS = 8  # a run: terms with as many on average are read by block
FIRST_BLOCKS = 8
PRODUCT_BLOCKS = 16
NOMINEES_AT_ONCE = 24
MARGIN = 1e-6  # more than rounding can move a sum
DIGITS = 9  # scores are compared after rounding, so that the order of sums does not decide ties


# --- index ------------------------------------------------------------------
_PARTS = (("doc_ids", "<i8"), ("lengths", "<i8"), ("terms", "<i8"), ("bounds", "<i8"), ("docs", "<i4"), ("tf", "<i4"))


def build_shard(doc_ids: np.ndarray, terms: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Postings of documents whose term hashes lie one after the other in ``terms``.

    Documents are numbered by their most frequent term, then by length, so that a block holds
    documents of one kind and its maxima are tight.
    """
    docs = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    order = np.argsort(terms, kind="stable")
    terms, docs = terms[order], docs[order]
    new = _starts(terms, docs)
    tf = np.diff(np.concatenate((new, [len(terms)]))).astype(np.int32)
    terms, docs = terms[new], docs[new]
    leading = np.zeros(len(lengths), np.int64)
    by_tf = np.lexsort((terms, tf))  # of equally frequent terms the largest hash
    leading[docs[by_tf]] = terms[by_tf]
    kinds = np.lexsort((lengths, leading))
    number = np.empty(len(lengths), np.int32)
    number[kinds] = np.arange(len(lengths), dtype=np.int32)
    docs = number[docs]
    order = np.lexsort((docs, terms))
    terms, docs, tf = terms[order], docs[order], tf[order]
    first = _starts(terms)
    return {
        "doc_ids": doc_ids[kinds], "lengths": lengths[kinds], "terms": terms[first],
        "bounds": np.concatenate((first, [len(terms)])), "docs": docs, "tf": tf,
    }


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    changed = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(np.concatenate(([True], changed)))


_QUERY_PARTS = (("ids", "<i8"), ("bounds", "<i8"), ("terms", "<i8"), ("idf", "<f8"))


def _save(uri: str, arrays: dict[str, np.ndarray], parts=_PARTS) -> None:
    with atomic_output(uri) as out:
        out.write(np.asarray([len(arrays[name]) for name, _ in parts], "<i8").tobytes())
        for name, kind in parts:
            out.write(np.ascontiguousarray(arrays[name], kind).tobytes())


def _load(uri: str, parts=_PARTS) -> dict[str, np.ndarray]:
    with open_input(uri) as stream:
        sizes = np.frombuffer(stream.read(8 * len(parts)), "<i8").tolist()
        return {
            name: np.frombuffer(stream.read(n * np.dtype(kind).itemsize), kind)
            for (name, kind), n in zip(parts, sizes, strict=True)
        }


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers from each first to before each last, one after the other."""
    size = last - first
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


class Queries:
    """Queries' ids and weighted terms, those of each between its bounds; every word is looked up once."""

    def __init__(self, ids: list[int], bounds: list[int], terms: np.ndarray, idf: np.ndarray):
        self.ids, self.bounds, self.idf = ids, bounds, idf
        self.words, self.word = np.unique(terms, return_inverse=True)


class Shard:
    """A shard ready to be searched, with impacts under the global average length.

    Terms of many documents, which make most of the postings that a query meets, are kept as columns of a
    matrix besides; the others are read by their postings, those that lie in few blocks by their runs.
    """

    def __init__(self, parts: dict[str, np.ndarray], average: float, block_docs: int = BLOCK_DOCS):
        self.doc_ids, self.terms, self.bounds = parts["doc_ids"], parts["terms"], parts["bounds"]
        self.docs = parts["docs"].astype(np.int64)
        size = len(self.doc_ids)
        self.block_starts = np.arange(0, size, block_docs)
        self.n_blocks = len(self.block_starts)
        norm = K1 * (1 - B + B * parts["lengths"] / max(average, 1e-12))
        self.impact = norm[self.docs]
        self.impact += parts["tf"]
        np.divide(parts["tf"] * (K1 + 1), self.impact, out=self.impact)
        df = np.diff(self.bounds)
        block = parts["docs"] // block_docs
        starts = _starts(np.repeat(np.arange(len(df), dtype=np.int32), df), block)
        some = len(starts) > 0
        self.block_max = np.maximum.reduceat(self.impact, starts) if some else np.zeros(0)
        self.term_max = np.maximum.reduceat(self.impact, self.bounds[:-1]) if some else np.zeros(0)
        self.block_of = block[starts].astype(np.int64)
        self.run_starts = np.append(starts, len(self.docs))
        # Runs of a term: from its first to the next term's first.
        self.run_bounds = np.searchsorted(starts, self.bounds)
        common = np.flatnonzero(df >= max(1, COMMON_SHARE * size))
        common = np.sort(common[np.argsort(-df[common], kind="stable")[:MAX_COMMON]])
        self.column = np.full(len(df), -1, np.int64)
        self.column[common] = np.arange(len(common))
        self.gathered = (df >= RUN_POSTINGS * np.diff(self.run_bounds)) & (self.column < 0)
        self.matrix = np.zeros((size, len(common)))
        rows = _ranges(self.bounds[common], self.bounds[common + 1])
        self.matrix[self.docs[rows], np.repeat(np.arange(len(common)), df[common])] = self.impact[rows]
        self.rough_matrix = self.matrix.astype(np.float32)
        self.matrix_max = np.zeros((self.n_blocks, len(common)))
        self.matrix_postings = np.zeros((self.n_blocks, len(common)), np.float32)
        for i, a in enumerate(self.block_starts):
            docs = self.matrix[a : a + block_docs]
            self.matrix_max[i], self.matrix_postings[i] = docs.max(axis=0), np.count_nonzero(docs, axis=0)
        # Postings scored, those of them that were read and not multiplied, and those of blocks that were skipped.
        self.evaluated = self.read = self.skipped = 0

    def _sums(self, first: np.ndarray, last: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of all documents over ranges of postings, each with its term's weight."""
        rows = _ranges(first, last)
        self.evaluated += len(rows)
        self.read += len(rows)
        sums = np.bincount(self.docs[rows], np.repeat(weights, last - first) * self.impact[rows], len(self.doc_ids))
        return sums.astype(np.float64, copy=False)  # those of no rows are integers

    def _run_sums(self, runs: np.ndarray, weights: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Scores of all documents over the postings of ``runs`` in ``live`` blocks; the others stay unread."""
        read = live[self.block_of[runs]]
        if not read.all():
            self.skipped += int((self.run_starts[runs + 1] - self.run_starts[runs])[~read].sum())
            runs, weights = runs[read], weights[read]
        return self._sums(self.run_starts[runs], self.run_starts[runs + 1], weights)

    def _common_scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Scores of ``docs`` over the common terms, summed alike for all, so that equal documents tie."""
        return np.einsum("ij,j->i", self.matrix[docs], weight)

    def search(
        self, query: int, terms: np.ndarray, idf: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray] | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """``search_all`` for one query."""
        carried = [best or (np.zeros(0, np.int64), np.zeros(0))]
        self.search_all(Queries([query], [0, len(terms)], terms, idf), k, carried)
        return carried[0]

    def search_all(self, asked: Queries, k: int, best: list) -> None:
        """Put ids and rounded scores of each query's ``k`` best documents, here and in ``best``, into ``best``.

        A query's own id is no result. ``best`` are the rows of earlier
        shards; their k-th score is the floor to start with. Terms that are not common are read by their postings.
        A block's bound is the largest sum of its documents so far, plus the block maxima of the terms that are
        not read yet. Where the common terms stay below the floor together, they nominate no document (WAND's
        pivot): a block without another term lies below it too. Blocks below the floor are skipped; the
        common terms of the others are added for many queries at once by a matrix product in single precision,
        and documents that come near the floor are scored in full, the most promising first.
        """
        if not len(self.terms):
            return
        place = np.minimum(np.searchsorted(self.terms, asked.words), len(self.terms) - 1)
        place[self.terms[place] != asked.words] = -1
        for lo in range(0, len(asked.ids), QUERY_TILE):
            hi = min(lo + QUERY_TILE, len(asked.ids))
            a, b = asked.bounds[lo], asked.bounds[hi]
            at = place[asked.word[a:b]]
            here = at >= 0
            own = np.repeat(np.arange(hi - lo), np.diff(asked.bounds[lo : hi + 1]))[here]
            cuts = np.searchsorted(own, np.arange(hi - lo + 1)).tolist()
            carried = best[lo:hi]
            self._search_tile(asked.ids[lo:hi], cuts, own, at[here], asked.idf[a:b][here], k, carried)
            best[lo:hi] = carried

    def _take(self, query: int, best: tuple, docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[tuple, float]:
        """Merge scored documents into the best, each id once at its best score; with the new floor."""
        ids = np.concatenate((best[0], self.doc_ids[docs]))
        scores = np.concatenate((best[1], np.round(scores, DIGITS)))
        keep = (ids != query) & (scores > 0)
        ids, scores = ids[keep], scores[keep]
        order = np.lexsort((ids, -scores))
        _, once = np.unique(ids[order], return_index=True)
        first = order[np.sort(once)[:k]]
        best = ids[first], scores[first]
        return best, _floor(best, k)

    def _search_tile(
        self, queries: list[int], cuts: list[int], own: np.ndarray, at: np.ndarray, idf: np.ndarray, k: int, best: list
    ) -> None:
        """``search_all`` for a few queries, whose terms are the ``at``-th here; ``own`` is each term's query."""
        size, column = len(self.doc_ids), self.column[at]
        common = column >= 0
        weight = np.zeros((len(queries), self.matrix.shape[1]))
        weight[own[common], column[common]] = idf[common]
        top = idf * self.term_max[at]
        reach = np.bincount(own, top, len(queries))
        near = reach * (weight.shape[1] + 8) * 2.0**-23
        rough_weight = weight.astype(np.float32)
        common_bound = weight @ self.matrix_max.T
        common_postings = (rough_weight > 0) @ self.matrix_postings.T
        gathered = self.gathered[at]
        floor = np.array([_floor(b, k) for b in best])
        partial: list = [None] * len(queries)
        rough_partial = np.zeros((len(queries), size), np.float32)
        live = np.zeros((len(queries), self.n_blocks), bool)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a == b or reach[i] < floor[i]:
                continue
            terms, weights = at[a:b], idf[a:b]
            rare = ~(common[a:b] | gathered[a:b])
            sums = self._sums(self.bounds[terms[rare]], self.bounds[terms[rare] + 1], weights[rare])
            bound = np.maximum.reduceat(sums, self.block_starts) + common_bound[i]
            few, few_weights = terms[gathered[a:b]], weights[gathered[a:b]]
            first, last = self.run_bounds[few], self.run_bounds[few + 1]
            runs, run_weights = _ranges(first, last), np.repeat(few_weights, last - first)
            if len(runs):
                bound += np.bincount(self.block_of[runs], run_weights * self.block_max[runs], self.n_blocks)
            first_floor = floor[i] <= 0
            if first_floor:
                # The most promising blocks give a first k-th score that documents really reach.
                chosen = np.zeros(self.n_blocks, bool)
                chosen[np.argsort(-bound, kind="stable")[:FIRST_BLOCKS]] = True
                docs = np.flatnonzero(np.repeat(chosen, np.diff(self.block_starts, append=size)))
                scores = (sums + self._run_sums(runs, run_weights, chosen))[docs] if len(runs) else sums[docs]
                scores = scores + self._common_scores(docs, weight[i])
                self.evaluated += int(common_postings[i, chosen].sum())
                best[i], floor[i] = self._take(queries[i], best[i], docs, scores, k)
            live[i] = bound >= floor[i]
            if first_floor:
                live[i] &= ~chosen
            if len(runs):
                sums += self._run_sums(runs, run_weights, live[i])
            partial[i] = rough_partial[i] = sums
        # What is not 0 in double precision is not 0 in single precision either.
        found = []
        self.evaluated += int(common_postings[live].sum())
        self.skipped += int(common_postings[~live].sum())
        least = np.maximum(floor - near - MARGIN, np.finfo(np.float32).tiny).astype(np.float32)
        for first in range(0, self.n_blocks, PRODUCT_BLOCKS):
            some = live[:, first : first + PRODUCT_BLOCKS]
            asks = np.flatnonzero(some.any(axis=1))
            a = self.block_starts[first]
            b = self.block_starts[first + PRODUCT_BLOCKS] if first + PRODUCT_BLOCKS < self.n_blocks else size
            if not len(asks):
                continue
            rough = rough_weight[asks] @ self.rough_matrix[a:b].T
            rough += rough_partial[asks, a:b]
            hit = np.flatnonzero(rough >= least[asks, None])
            row, col = np.divmod(hit, rough.shape[1])
            found.append((asks[row], a + col, rough.ravel()[hit]))
        if not found:
            return
        row, docs, rough = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((-rough, row))
        row, docs, rough = row[order], docs[order], rough[order]
        ends = np.searchsorted(row, np.arange(len(queries) + 1)).tolist()
        for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            while a < b:
                some = docs[a : min(b, a + NOMINEES_AT_ONCE)]
                if rough[a] < floor[i] - near[i] - MARGIN:
                    break
                scores = partial[i][some] + self._common_scores(some, weight[i])
                best[i], floor[i] = self._take(queries[i], best[i], some, scores, k)
                a += len(some)


def _floor(best: tuple[np.ndarray, np.ndarray], k: int) -> float:
    """What a document must reach to be among the best, less than rounding; 0 while there is room."""
    return float(best[1][-1]) - MARGIN if len(best[1]) == k else 0.0


# --- Spark side -------------------------------------------------------------
def _term_arrays(docs: DataFrame) -> DataFrame:
    """``doc_id, terms``: 64-bit hashes of all words of the rows that have an id."""
    return docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.transform(ascii_words("text"), lambda w: F.xxhash64(w)).alias("terms")
    )


def write_index(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Index ``docs`` into shard files; returns ``path, docs, tokens`` and ``term, df`` tables."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number = TaskContext.get().partitionId(), 0
        held: tuple[list, list, list] = ([], [], [])
        rows = tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal rows, tokens, number
            if not rows:
                return
            lengths = np.concatenate(held[2])
            shard = build_shard(np.concatenate(held[0]), np.concatenate(held[1]), lengths)
            path = f"{folder}/shard-{partition:06d}-{number:04d}.idx"
            _save(path, shard)
            names = ["path", "docs", "tokens", "term", "df"]
            none = [pa.array([None], pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([len(lengths)], pa.int64()), pa.array([int(lengths.sum())], pa.int64()), *none], names
            )
            df = np.diff(shard["bounds"])
            for a in range(0, len(df), 50_000):
                n = len(df[a : a + 50_000])
                nulls = [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
                yield pa.RecordBatch.from_arrays([*nulls, pa.array(shard["terms"][a : a + n]), pa.array(df[a : a + n])], names)
            for part in held:
                part.clear()
            rows = tokens = 0
            number += 1

        for batch in batches:
            for start in range(0, len(batch), 1_000):
                some = batch.slice(start, 1_000)
                lists = some.column(1)
                lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                held[0].append(some.column(0).to_numpy(zero_copy_only=False))
                held[1].append(lists.flatten().to_numpy(zero_copy_only=False))
                held[2].append(lengths)
                rows += len(lengths)
                tokens += int(lengths.sum())
                if rows >= SPARE * SHARD_DOCS or tokens >= SHARD_TOKENS:
                    yield from flush()
        yield from flush()

    spark = docs.sparkSession
    shards = max(1, docs.count() // SHARD_DOCS)
    if docs.rdd.getNumPartitions() > shards:
        docs = docs.coalesce(shards)
    schema = "path string, docs long, tokens long, term long, df long"
    _term_arrays(docs).mapInArrow(index, schema).write.parquet(f"{folder}/manifest")
    written = spark.read.schema(schema).parquet(f"{folder}/manifest")
    files = written.where("path is not null").select("path", "docs", "tokens")
    return files, written.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"))


def _write_queries(weighted: DataFrame, folder: str, size: int) -> DataFrame:
    """Write ``query_id, terms, idf`` rows to files of at most ``size`` queries; returns ``block, queries``: their paths and sizes."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, len(batch), size):
                some = batch.slice(start, size)
                terms = some.column(1)
                arrays = {
                    "ids": some.column(0).to_numpy(zero_copy_only=False),
                    "bounds": np.concatenate(([0], np.cumsum(np.diff(terms.offsets.to_numpy())))),
                    "terms": terms.flatten().to_numpy(zero_copy_only=False),
                    "idf": some.column(2).flatten().to_numpy(zero_copy_only=False),
                }
                path = f"{folder}/queries-{partition:06d}-{number:04d}.qry"
                _save(path, arrays, _QUERY_PARTS)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(some)], pa.int64())], ["block", "queries"])
                number += 1

    schema = "block string, queries long"
    weighted.mapInArrow(write, schema).write.parquet(f"{folder}/blocks")
    return weighted.sparkSession.read.schema(schema).parquet(f"{folder}/blocks")


def search_top_k(docs: DataFrame, is_query: Column, k: int = TOP, folder: str | None = None) -> DataFrame:
    """``query_id, rank, doc_id, score`` of the ``k`` best documents for every query row.

    A query is the whole text of a row that ``is_query`` marks: all its different words. Every row
    with an id is searched but the query's own id. Documents without a common word are no result, so queries of
    null or empty text give none. Ties go to the smaller id; rows repeated with one id count
    once, at their best score. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "bm25")
    files, frequencies = write_index(docs, folder)
    n, tokens = files.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    average = tokens / max(n, 1)

    queries = _term_arrays(docs.where(is_query)).select("doc_id", F.explode(F.array_distinct("terms")).alias("term"))
    idf = F.log((F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0)
    # Ids of repeated query rows share their words.
    weighted = (
        queries.distinct()
        .join(frequencies, "term")
        .groupBy(F.col("doc_id").alias("query_id"))
        .agg(F.array_sort(F.collect_list(F.struct("term", idf.alias("idf")))).alias("words"))
        .select("query_id", F.col("words.term").alias("terms"), F.col("words.idf").alias("idf"))
    )
    # Full blocks, since every one of them meets every shard.
    number = docs.where(is_query).count()
    size = min(QUERY_BLOCK, max(SMALL_BLOCK, number // QUERY_BLOCKS))
    blocks = _write_queries(weighted.repartition(max(1, -(-number // size))), folder, size)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by block and chain; a block's best rows are carried along its chain."""
        current, asked, best = None, None, []

        def found() -> Iterator[pa.RecordBatch]:
            if best:
                sizes = [len(ids) for ids, _ in best]
                columns = [np.repeat(np.asarray(asked.ids, np.int64), sizes), *map(np.concatenate, zip(*best, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "doc_id", "score"])

        for batch in batches:
            for block, chain, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (block, chain) != current:
                    yield from found()
                    current, held = (block, chain), _load(block, _QUERY_PARTS)
                    asked = Queries(held["ids"].tolist(), held["bounds"].tolist(), held["terms"], held["idf"])
                    best = [(np.zeros(0, np.int64), np.zeros(0))] * len(asked.ids)
                shard = None  # let go of the last one first
                shard = Shard(_load(path), average)
                shard.search_all(asked, k, best)
        yield from found()

    # Every shard meets every block of the stated query set; only their paths are shuffled.
    numbered = files.select("path", (F.row_number().over(Window.orderBy("path")) - 1).alias("shard"))
    shards = files.count()
    chains = max(1, min(shards, max(CHAINS, -(-shards // CHAIN_SHARDS))))
    order = F.row_number().over(Window.orderBy("block")) - 1  # a row for each file of queries
    ordered = blocks.select("block", (order * chains).alias("_group"))
    tasks = (
        ordered.select("block", "_group", F.explode(F.sequence(F.lit(0), F.lit(max(shards, 1) - 1))).alias("shard"))
        .join(numbered, "shard")
        .withColumn("chain", F.col("shard") % chains)
    )
    number = max(1, blocks.count() * chains)
    found = (
        tasks.withColumn("_group", F.col("_group") + F.col("chain"))
        .repartitionByRange(number, "_group")
        .sortWithinPartitions("_group", "path")
        .select("block", "chain", "path")
        .mapInArrow(search, "query_id long, doc_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return (
        found.groupBy("query_id", "doc_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "doc_id", "score")
    )


def oracle_sql(is_query: str = "doc_id % 100 = 0", k: int = TOP) -> str:
    """The same search in DuckDB SQL, scoring every pair that shares a word."""
    return f"""
WITH words AS (SELECT doc_id, {ascii_words_sql("text")} AS w FROM documents WHERE doc_id IS NOT NULL),
lengths AS (SELECT doc_id, len(w) AS dl FROM words),
stats AS (SELECT count(*)::DOUBLE AS n, avg(dl) AS average FROM lengths),
postings AS (SELECT doc_id, term, count(*)::DOUBLE AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words) GROUP BY ALL),
idf AS (SELECT term, ln((n - count(*) + 0.5) / (count(*) + 0.5) + 1) AS idf FROM postings, stats GROUP BY term, n),
scored AS (
  SELECT q.doc_id AS query_id, p.doc_id,
         round(sum(idf * p.tf * {K1 + 1} / (p.tf + {K1} * (1 - {B} + {B} * dl / average))), {DIGITS}) AS score
  FROM postings q JOIN postings p USING (term) JOIN idf USING (term) JOIN lengths l ON l.doc_id = p.doc_id, stats
  WHERE q.{is_query} AND p.doc_id <> q.doc_id GROUP BY q.doc_id, p.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {k}
"""
