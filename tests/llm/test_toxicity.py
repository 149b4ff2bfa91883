import itertools

import numpy as np
import pytest

from threadloom.llm import toxicity as tx
from threadloom.llm.common import read_table


@pytest.fixture(scope="module")
def decoder(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    return tx.Decoder(tx.CharacterModel.fit(docs))


def path_score(decoder, reading: str) -> float:
    state, total = 0, 0.0
    for ch in reading:
        o = ord(ch) - 96
        code = state * tx.LETTERS + (o if 1 <= o <= 26 else 0)
        total += decoder.log_probability[code]
        state = code % tx.LETTERS**3
    return total


@pytest.mark.parametrize("word", ["m0r0n", "1d10t", "h3ll0", "s.t.op", "aaab", "l00ser", "st*p", "$a1t"])
def test_viterbi_finds_the_best_path_of_all(decoder, word):
    nodes = tx.lattice(word)
    scores = {}
    for path in itertools.product(*nodes):
        text = "".join(r for r, _ in path)
        score = path_score(decoder, text + " ") - sum(c for _, c in path)
        scores[text] = max(score, scores.get(text, -np.inf))
    found = decoder.best(nodes)
    assert scores[found] == pytest.approx(max(scores.values()), abs=1e-6)


@pytest.mark.parametrize(
    ("text", "word"),
    [
        ("1d10t", "idiot"), ("$tup1d!", "stupid"), ("l0s3r", "loser"), ("tr4sh,", "trash"), ("cl0wn", "clown"), ("p4th3t1c", "pathetic"),
        ("i d i o t", "idiot"), ("what a m o r o n.", "moron"), ("s.t.u.p.i.d", "stupid"), ("m-o-r-o-n", "moron"), ("idiooooot", "idiot"),
        ("STUPID!!!", "stupid"), ("id​iot", "idiot"), ("stup*d", "stupid"),
    ],
)
def test_disguised_words_are_restored(decoder, text, word):
    assert word in decoder.words(text)


def test_plain_words_are_left_alone(decoder):
    text = "Plain words, with (marks) and 2024 numbers; über alles a b c."
    assert decoder.words(text) == "plain words with marks and 2024 numbers über alles a b c".split()
    assert decoder.words("on$$$ of%%% TH!!") == ["on", "of", "th"]
    assert decoder.words("") == []
    assert decoder.distinct_words(text) == set(decoder.words(text))


def test_counts_cover_all_documents(spark, odd_documents):
    counted = {r.code: r.n for r in tx.gram_counts(spark.createDataFrame([("ab",), ("AB",), (None,), ("",)], "text string")).collect()}
    ab = (1 * tx.LETTERS + 2) * tx.LETTERS**2
    assert counted[ab] == 2
    assert tx.gram_counts(odd_documents.where("false")).count() == 0


def test_logistic_is_at_its_minimum():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 2, (80, 4)).astype(float), rng.integers(0, 2, 80).astype(float)

    def loss(w, b):
        z = x @ w + b
        return np.logaddexp(0, z).sum() - y @ z + 0.05 * (w @ w) + 0.0005 * b * b

    w, b = tx.fit_logistic(x, y, ridge=0.1)
    assert all(loss(w + d, b) >= loss(w, b) - 1e-9 for d in 0.01 * np.vstack([np.eye(4), -np.eye(4)]))


def test_odd_rows_and_tables(odd_documents, odd_labels, no_documents, no_labels):
    rows = tx.score_toxicity(odd_documents, odd_labels).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out is not None for r in rows)
    assert tx.score_toxicity(no_documents, no_labels).count() == 0
    assert len({r.score for r in tx.score_toxicity(odd_documents, no_labels).collect()}) == 1
    assert tx.drop_toxic(odd_documents, odd_labels).columns == odd_documents.columns


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = tx.score_toxicity(docs.join(labels, "doc_id", "left_semi"), labels)
    rows = scored.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    caught = np.mean([r.predicted for r in rows if r.toxic])
    false = np.mean([r.predicted for r in rows if not r.toxic])
    assert caught >= 0.85
    assert false <= 0.02
