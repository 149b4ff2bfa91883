from collections import Counter

import numpy as np
import oracle
from pyspark.sql import functions as F

from threadloom.llm import topk

FIRST = "doc_id % 100 = 0"


def shard_of(texts, **options):
    terms = [np.asarray([hash(w) for w in t.split()], np.int64) for t in texts]
    lengths = np.asarray([len(t) for t in terms], np.int64)
    parts = topk.build_shard(np.arange(len(texts)), np.concatenate(terms), lengths)
    return topk.Shard(parts, lengths.mean(), **options), terms, lengths


def test_pruned_search_equals_scoring_everything_and_skips_blocks():
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 30) if x < 500) for _ in range(3_000)]
    texts += ["rare1 rare2 rare3"] * 3 + [""]
    shard, terms, lengths = shard_of(texts, block_docs=16)
    df: dict[int, int] = {}
    for t in terms:
        for w in set(t.tolist()):
            df[w] = df.get(w, 0) + 1
    touched = 0
    for words in (["rare1", "rare2", "rare3", "w1"], ["w7", "w9", "w40"], ["w1"], ["unknown"]):
        query = np.sort(np.asarray([hash(w) for w in words], np.int64))
        idf = np.asarray([np.log((len(texts) - df.get(w, 0) + 0.5) / (df.get(w, 0) + 0.5) + 1) for w in query.tolist()])
        ids, scores = shard.search(-1, query, idf, 10)
        naive = []
        for d, t in enumerate(terms):
            s = 0.0
            for w, i in zip(query.tolist(), idf, strict=True):
                tf = int((t == w).sum())
                s += i * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * lengths[d] / lengths.mean())) if tf else 0.0
            if s:
                naive.append((-round(s, 9), d))
        assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist(), strict=True)] == sorted(naive)[:10]
        touched += len(naive)
    assert shard.evaluated < touched


def test_a_carried_floor_skips_blocks_and_keeps_the_best():
    """Two halves searched one after the other give the rows of the whole, and read less of the second."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"k{kind}w{int(x)}" for x in rng.zipf(1.4, 20) if x < 60) for kind in range(40) for _ in range(60)]
    whole, terms, _ = shard_of(texts, block_docs=16)
    lengths = np.asarray([len(t) for t in terms], np.int64)
    halves = []
    for part in (slice(0, None, 2), slice(1, None, 2)):
        ids = np.arange(len(texts))[part]
        parts = topk.build_shard(ids, np.concatenate([terms[i] for i in ids]), lengths[ids])
        halves.append(topk.Shard(parts, lengths.mean(), block_docs=16))
    fresh = topk.Shard(parts, lengths.mean(), block_docs=16)
    for kind in range(0, 40, 3):
        query = np.unique(np.asarray([hash(f"k{kind}w{i}") for i in (1, 2, 5, 9)] + [hash(f"k{kind + 1}w1")], np.int64))
        idf = np.linspace(1.0, 3.0, len(query))
        first = halves[0].search(-1, query, idf, 10)
        both = halves[1].search(-1, query, idf, 10, first)
        alone = whole.search(-1, query, idf, 10)
        assert both[0].tolist() == alone[0].tolist() and both[1].tolist() == alone[1].tolist()
        fresh.search(-1, query, idf, 10)
    assert halves[1].skipped > 0 and halves[1].evaluated < fresh.evaluated


def test_many_queries_at_once_read_common_words_less_than_once_each():
    """A tile of queries gives what scoring everything gives, and reads only the postings of words that are not common."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.2, 40) if x < 800) for _ in range(900)] + ["w1"] * 3
    shard, terms, lengths = shard_of(texts)
    df = Counter(w for t in terms for w in set(t.tolist()))
    asked = [np.unique(terms[i]) for i in range(0, 900, 6)] + [np.zeros(0, np.int64)]
    idf = [np.asarray([np.log((len(texts) - df[w] + 0.5) / (df[w] + 0.5) + 1) for w in t.tolist()]) for t in asked]
    ids = list(range(0, 6 * len(asked), 6))
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in asked]))).tolist()
    best = [(np.zeros(0, np.int64), np.zeros(0))] * len(asked)
    shard.search_all(topk.Queries(ids, bounds, np.concatenate(asked), np.concatenate(idf)), 10, best)
    tf = [Counter(t.tolist()) for t in terms]
    norm = 1.2 * (0.25 + 0.75 * lengths / lengths.mean())
    met = 0
    for i, t, weight, (found, scores) in zip(ids, asked, idf, best, strict=True):
        naive = []
        for d in range(len(texts)):
            hits = [(w, x) for w, x in zip(t.tolist(), weight, strict=True) if tf[d][w]]
            met += len(hits)
            s = round(sum(x * tf[d][w] * 2.2 / (tf[d][w] + norm[d]) for w, x in hits), 9)
            naive += [(-s, d)] if s and d != i else []
        wanted = sorted(naive)[:10]
        assert np.allclose(scores, [-s for s, _ in wanted], rtol=0, atol=1e-8)
        assert found.tolist() == [d for _, d in wanted]
    assert len(asked) > topk.QUERY_TILE and 2 * shard.read < met


def test_a_floor_that_no_block_reaches_leaves_the_best_as_they_are():
    texts = [f"k{kind}a k{kind}a k{kind}b k{kind}c{i}" for kind in range(40) for i in range(32)]
    shard, _, _ = shard_of(texts, block_docs=16)
    query = np.unique(np.asarray([hash(f"k{kind}{x}") for kind in (3, 7) for x in "ab"], np.int64))
    ids, scores = shard.search(-1, query, np.ones(4), 10)
    carried = np.arange(5_000, 5_010), np.full(10, 1.5 * scores[0])
    read = shard.evaluated
    assert shard.gathered.any() and len(ids) == 10
    same = shard.search(-1, query, np.ones(4), 10, carried)
    assert same[0].tolist() == carried[0].tolist() and same[1].tolist() == carried[1].tolist()
    assert shard.evaluated == read and shard.skipped > 0


def test_odd_rows_and_tables(odd_documents, no_documents):
    got = topk.search_top_k(odd_documents, F.expr(FIRST))
    rows = got.collect()
    assert {r.query_id for r in rows} == {0, 100, 200}
    best = {r.query_id: r for r in rows if r["rank"] == 1}
    assert best[0].doc_id == 5 and best[200].doc_id in (0, 5)
    assert all(r.doc_id is not None and r.doc_id != r.query_id for r in rows)
    assert len(rows) == len({(r.query_id, r.doc_id) for r in rows})
    assert topk.search_top_k(no_documents, F.expr(FIRST)).count() == 0


def test_many_shards_merge_to_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_DOCS", 37)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 1)
    monkeypatch.setattr(topk, "CHAINS", 3)
    sf_dir = "/root/testdata/sf0.001"
    got = topk.search_top_k(spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(4), F.expr(FIRST))
    assert oracle.difference(got, oracle.connect(sf_dir), topk.oracle_sql()) is None


def test_a_chain_gives_k_rows_a_query(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_DOCS", 15)
    monkeypatch.setattr(topk, "CHAINS", 2)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(4)
    searched = []
    usual = type(docs).mapInArrow

    def watched(df, fn, schema, *rest):
        out = usual(df, fn, schema, *rest)
        if schema.startswith("query_id"):
            searched.append(out)
        return out

    monkeypatch.setattr(type(docs), "mapInArrow", watched)
    topk.search_top_k(docs, F.expr(FIRST))
    rows = searched[0].groupBy("query_id").count().collect()
    assert rows and all(r["count"] <= 2 * topk.TOP for r in rows)


def test_rows_repeated_more_than_k_times_leave_room(spark):
    rows = [(0, "apple pear plum fig")] + [(1, "apple pear plum fig")] * 15 + [(2, "apple pear plum")] * 3
    rows += [(i, "apple " + "kiwi " * i) for i in range(3, 18)] + [(100 + i, "nothing here") for i in range(1, 40)]
    got = topk.search_top_k(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), F.expr("doc_id = 0"))
    n, average = len(rows), sum(len(t.split()) for _, t in rows) / len(rows)
    scores = {}
    for i, text in rows[1:]:
        words = text.split()
        s = 0.0
        for w in {"apple", "pear", "plum", "fig"} & set(words):
            df, tf = sum(w in t.split() for _, t in rows), words.count(w)
            s += np.log((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / average))
        if s:
            scores[i] = max(round(s, 9), scores.get(i, 0.0))
    wanted = sorted((-s, i) for i, s in scores.items())[:10]
    assert [r.doc_id for r in got.orderBy("rank").collect()] == [i for _, i in wanted]
    assert len(wanted) == 10
