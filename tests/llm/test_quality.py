import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm import quality
from threadloom.llm.common import read_table, small_slices, text_bytes


def naive_tree(trees: quality.FlatTrees, row) -> float:
    total = trees.bias
    for node in trees.roots.tolist():
        for _ in range(trees.depth):
            side = trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right
            node = side[node]
        total += trees.value[node]
    return total


def test_flat_traversal_equals_walking_each_tree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > -0.1)).astype(float)
    trees = quality.fit_trees(x, y, trees=12)
    assert np.allclose(trees.raw(x[:40]), [naive_tree(trees, r) for r in x[:40]])
    assert ((trees.probability(x) > 0.5) == (y > 0.5)).mean() > 0.97


def test_first_split_is_the_best_one_by_brute_force():
    rng = np.random.default_rng(2)
    x, ridge = rng.integers(0, 9, size=(200, 3)).astype(float), 2.0
    y = (x[:, 1] >= 5).astype(float)
    trees = quality.fit_trees(x, y, trees=1, depth=1, ridge=ridge)
    g = y.mean() * 0 + (y.sum() + 0.5) / (len(y) + 1) - y
    h = np.full(len(y), (y.sum() + 0.5) / (len(y) + 1) * (1 - (y.sum() + 0.5) / (len(y) + 1)))
    best = max(
        (g[m].sum() ** 2 / (h[m].sum() + ridge) + g[~m].sum() ** 2 / (h[~m].sum() + ridge), f, t)
        for f in range(3)
        for t in range(8)
        if 10 <= (m := x[:, f] <= t).sum() <= 190
    )
    root = trees.roots[0]
    assert (trees.feature[root], trees.threshold[root]) == best[1:]


@pytest.mark.parametrize("labels", [[], [1.0] * 30, [0.0] * 30])
def test_one_class_or_no_rows_give_the_prior(labels):
    trees = quality.fit_trees(np.zeros((len(labels), 4)), np.asarray(labels))
    p = trees.probability(np.ones((2, 4)))
    assert np.allclose(p, (sum(labels) + 0.5) / (len(labels) + 1))


def test_slices_and_bytes_cover_a_batch():
    texts = pa.array(["a" * 10, None, "", "é" * 7, "b" * 50])
    parts = [p for s in small_slices(texts, 12) for p in s.to_pylist()]
    assert parts == texts.to_pylist()
    raw, starts = text_bytes(texts.slice(1), tail="|")
    assert raw.tobytes().decode() == "||" + "é" * 7 + "|" + "b" * 50 + "|"
    assert starts.tolist() == [0, 1, 2, 17, 68]
    assert [len(s) for s in small_slices(texts.slice(0, 0))] == [0]


def test_statistics_do_not_depend_on_the_batch():
    texts = ["Plain words. And more words.\nA line", "", None, "!!! ??? %%%", "word " * 5000]
    whole = quality.document_statistics(pa.array(texts))
    alone = np.concatenate([quality.document_statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(whole, alone)
    assert not whole[1:3].any()
    assert quality.document_statistics(pa.array([], pa.string())).shape == (0, len(quality.FEATURES))


def test_odd_rows_and_tables(odd_documents, odd_labels, no_documents, no_labels):
    rows = quality.classify_quality(odd_documents, odd_labels).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out is not None for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert quality.classify_quality(no_documents, odd_labels).count() == 0
    assert {r.score for r in quality.classify_quality(odd_documents, no_labels).collect()} == {0.5}
    kept = quality.keep_quality(odd_documents, odd_labels)
    assert kept.columns == odd_documents.columns


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = read_table(spark, sf_dir, "labels")
    scored = quality.classify_quality(read_table(spark, sf_dir, "documents"), labels)
    rows = scored.join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    assert np.mean([r.quality == r.predicted for r in rows]) >= 0.95


def test_held_out_labels_are_never_learnt(spark):
    import zlib

    docs = spark.createDataFrame([(i, "good text here" if i % 2 else "%%% $$$ ###") for i in range(60)], "doc_id long, text string")
    honest = [(i, i % 2, 0) for i in range(60)]
    lying = [(i, q if zlib.crc32(str(i).encode()) % 5 else 1 - q, 0) for i, q, _ in honest]
    scores = [
        {r.doc_id: r.score for r in quality.classify_quality(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()}
        for rows in (honest, lying)
    ]
    assert scores[0] == scores[1]
