import numpy as np
import pytest

from threadloom.llm import mixing
from threadloom.llm.common import read_table

TARGETS = mixing.LANGUAGE_TARGETS


def mixed(spark, sf_dir="/root/testdata/sf0.01"):
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return docs, mixing.labelled_languages(docs, labels)


def test_expected_totals_match_the_targets(spark):
    docs, labelled = mixed(spark)
    rows = mixing.mixing_rates(docs, labelled, TARGETS).toPandas()
    assert len(rows) == docs.count() and (rows.rate >= 0).all()
    p = rows[[f"p_{d}" for d in sorted(TARGETS)]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1)
    share = (p * (rows.tokens * rows.rate).to_numpy()[:, None]).sum(axis=0) / rows.tokens.sum()
    assert np.allclose(share, [TARGETS[d] for d in sorted(TARGETS)], atol=1e-6)
    assert ((rows.copies - rows.rate).abs() < 1).all()
    assert abs(rows.copies.sum() / rows.rate.sum() - 1) < 0.05
    assert (rows.tokens == [len((t or "").lower().split()) for t in _texts(docs, rows)]).mean() > 0.99


def _texts(docs, rows):
    texts = dict(docs.select("doc_id", "text").collect())
    return [texts[i] for i in rows.doc_id]


def test_posteriors_equal_plain_naive_bayes(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "b c"), (3, "c c d"), (4, "a d zz"), (5, None)], "doc_id long, text string")
    labelled = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (3, "z"), (9, "y")], "doc_id long, domain string")
    model = mixing.fit_domains(docs, labelled, ("x", "y"))
    got = {r.doc_id: r.posterior for r in mixing.domain_posteriors(docs, model).collect()}
    counts = {"x": {"a": 2, "b": 2, "c": 1}, "y": {"c": 2, "d": 1}}
    prior = {"x": 3 / 5, "y": 2 / 5}
    for doc_id, text in docs.collect():
        odds = []
        for d in ("x", "y"):
            total = sum(counts[d].values())
            odds.append(prior[d] * np.prod([(counts[d].get(w, 0) + 1) / (total + 4) for w in (text or "").split() if w in "abcd"]))
        assert got[doc_id] == pytest.approx(np.asarray(odds) / sum(odds))


def test_rates_stay_nonnegative_where_plain_least_squares_would_not(spark):
    rows = [(10, [1.0, 0.0, 0.0])] * 5 + [(10, [0.5, 0.5, 0.0])] * 5 + [(10, [0.0, 0.1, 0.9])] * 5
    members = spark.createDataFrame(rows, "tokens long, posterior array<double>")
    steps = mixing.fit_rates(members, [0.02, 0.08, 0.9])
    rated = members.withColumn("rate", mixing.rate_after(steps, 3)).collect()
    share = sum(np.asarray(r.posterior) * r.rate * r.tokens for r in rated) / 150
    # Brute force over a grid of rates of the three kinds of documents.
    kinds = np.asarray([[1, 0, 0], [0.5, 0.5, 0], [0, 0.1, 0.9]]) / 3
    grid = np.stack(np.meshgrid(*[np.linspace(0, 4, 81)] * 3), -1).reshape(-1, 3)
    best = np.square(grid @ kinds - [0.02, 0.08, 0.9]).sum(axis=1).min()
    assert all(r.rate >= 0 for r in rated)
    assert np.square(share - [0.02, 0.08, 0.9]).sum() <= best + 1e-3


def test_odd_rows_and_tables(odd_documents, odd_labels, no_documents, no_labels):
    labelled = mixing.labelled_languages(odd_documents, odd_labels)
    rows = mixing.mixing_rates(odd_documents, labelled, TARGETS).collect()
    assert len(rows) == odd_documents.count()
    assert all(r.rate >= 0 and r.copies >= 0 for r in rows)
    assert sum(r.tokens == 0 for r in rows) == 4
    unlabelled = mixing.labelled_languages(odd_documents, no_labels)
    uniform = mixing.mixing_rates(odd_documents, unlabelled, TARGETS).collect()
    assert all(r.p_en == pytest.approx(0.25) for r in uniform)
    assert mixing.mixing_rates(no_documents, unlabelled, TARGETS).count() == 0
    with pytest.raises(ValueError, match="no target"):
        mixing.mixing_rates(odd_documents, labelled, {})


def test_documents_come_as_often_as_decided(spark, odd_documents, odd_labels):
    labelled = mixing.labelled_languages(odd_documents, odd_labels)
    decided = mixing.mixing_rates(odd_documents, labelled, TARGETS)
    out = mixing.mix_documents(odd_documents, labelled, TARGETS)
    assert out.columns == odd_documents.columns
    assert out.count() == decided.agg({"copies": "sum"}).first()[0]


def test_no_python_in_the_plan(spark):
    from conftest import plan_of

    docs, labelled = mixed(spark, "/root/testdata/sf0.001")
    plan = plan_of(mixing.domain_posteriors(docs, mixing.fit_domains(docs, labelled, ("de", "en"))))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))
