import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from threadloom.llm import queries, runs
from threadloom.llm.common import read_table

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words, min_length=12):
    """Every stretch of every period, by comparing all words; of one stretch the smallest period."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j + q - i >= min_length:
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def searched(texts, min_length=12):
    names: dict = {}
    numbers = np.asarray([names.setdefault(w, len(names)) for t in texts for w in t], np.int64)
    rows = runs.word_runs(numbers, np.asarray([len(t) for t in texts], np.int64), min_length).tolist()
    return [[tuple(r[1:]) for r in rows if r[0] == i] for i in range(len(texts))]


def check(texts):
    assert searched(texts) == [plain_runs(t) for t in texts]


def powers(draw_from):
    """Words nested by repetition: highly periodic regions, their neighbours and their combinations."""
    return st.recursive(
        st.text(draw_from, min_size=1, max_size=4),
        lambda inner: st.one_of(st.tuples(inner, st.integers(2, 24)).map(lambda t: t[0] * t[1]), st.tuples(inner, inner, inner).map("".join)),
        max_leaves=6,
    ).map(lambda t: t[:700])


@settings(max_examples=250, deadline=None)
@given(st.lists(st.one_of(st.text("ab", max_size=150), st.text("abc", max_size=300), powers("ab"), powers("abcd")), max_size=4))
def test_runs_equal_those_of_all_comparisons(texts):
    check(texts)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 60), st.integers(0, 40), st.integers(2, 4), st.randoms(use_true_random=False))
def test_periods_whose_first_period_is_highly_periodic(small, times, rest, copies, rng):
    root = "".join(rng.choice("ab") for _ in range(small))
    whole = (root * times)[: max(1, small * times - rest % (small + 1))]
    around = "".join(rng.choice("abx") for _ in range(rest))
    check([around + whole * copies + around, (whole + "x") * copies, ("x" + whole) * copies + whole, whole[::-1] * copies + whole])


def test_famous_words():
    fibonacci, thue = ["a", "ab"], "a"
    while len(fibonacci[-1]) < 1500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    while len(thue) < 1024:
        thue += thue.translate(str.maketrans("ab", "ba"))
    blocks = "".join("a" * (20 + i % 3) + "b" for i in range(40))
    check([fibonacci[-1], thue, "a" * 1000, ("a" * 30 + "b") * 30, blocks, "ab" * 300 + "a" + "ab" * 300, "", "a"])


def test_long_periods(prose):
    rng = random.Random(2)
    for p in (15, 16, 17, 31, 63, 64, 100, 257, 511, 1000):
        root = [f"w{rng.randrange(10 * p)}" for _ in range(p)]
        words = (root * 4)[: 2 * p + rng.randrange(2 * p)]
        edge = [f"e{i}" for i in range(rng.randrange(50))]
        check([edge + words + edge, words, words[:-1] + edge, root * 2, (root * 2)[:-1]])


def test_met_hashes_are_noticed(monkeypatch):
    """With all hashes equal for one seed, another seed is taken."""
    usual = runs._Words.__init__

    def blind(self, words, longest, seed):
        usual(self, words, longest, seed)
        if seed == 12:
            self.levels = [np.zeros_like(x) for x in self.levels]

    monkeypatch.setattr(runs._Words, "__init__", blind)
    root = "abcdefghijklmnopqrstu"
    check(["xyz" + root * 3, "abcdefghijk" * 9])


def test_set_is_consistent_and_dense():
    rng = np.random.default_rng(5)
    words = np.concatenate((rng.integers(0, 3, 3000), np.zeros(200, np.int64), rng.integers(0, 3, 500), np.arange(900) % 2))
    hashed = runs._Words(words, len(words), 1)
    for scale in (4, 8, 16):
        periodic = runs._periodic_windows(runs._smallest_periods(runs._direct_runs(words)), scale, len(words) - scale + 1)
        members = set(runs.synchronising_set(hashed.levels[scale.bit_length() - 1], scale, periodic).tolist())
        contexts: dict = {}
        for i in range(len(words) - 2 * scale + 1):
            contexts.setdefault(words[i : i + 2 * scale].tobytes(), set()).add(i in members)
        assert all(len(x) == 1 for x in contexts.values())
        for i in range(len(words) - 3 * scale + 2):
            part = words[i : i + 3 * scale - 1]
            highly = any((part[q:] == part[:-q]).all() for q in range(1, scale // 3 + 1))
            assert highly or members & set(range(i, i + scale))


def plain_digest(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def digest(docs):
    return runs.run_digest(runs.find_runs(runs.plant_repetitions(docs)))


def test_query_equals_brute_force(spark):
    got = queries.QUERIES["op12_synchronised_runs"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    docs = read_table(spark, SF_DIR, "documents").collect()
    short = {r.doc_id for r in docs if len((r.text or "").split()) <= 1500}
    wanted = {r.doc_id: plain_digest(r.doc_id, r.text) for r in docs if r.doc_id in short}
    rows = {r.doc_id: tuple(r) for r in got.collect()}
    assert len(rows) == len(docs) and {d: rows[d] for d in short} == wanted
    assert sum(r[1] > 0 for r in rows.values()) > len(docs) // 20


def test_odd_rows_and_tables(spark, odd_documents, no_documents):
    texts = odd_documents.where("length(text) < 20000 or text is null")
    key = lambda t: tuple("" if x is None else str(x) for x in t)
    assert sorted(map(key, digest(texts).collect())) == sorted(key(plain_digest(r.doc_id, r.text)) for r in texts.collect())
    assert digest(odd_documents).count() == odd_documents.count()
    assert digest(no_documents).count() == 0
    spaces = spark.createDataFrame([(1, "a b\x0b\x0ca　 a b " * 9)], "doc_id long, text string")
    assert [tuple(r) for r in digest(spaces).collect()] == [plain_digest(1, spaces.first().text)]
    found = runs.find_runs(spark.createDataFrame([(1, "x " + "a b c " * 6 + "y")], "doc_id long, text string")).first()
    assert [tuple(r) for r in found.runs] == [(1, 18, 3)] and found.collapsed == "x a b c y"


def test_slices_do_not_matter(spark, monkeypatch, prose):
    rows = [(i, " ".join((prose(i, 30) + " ") * (1 + i % 4) for _ in range(2))) for i in range(40)]
    whole = {r.doc_id: r for r in digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    alone = {r.doc_id: r for r in digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(40)).collect()}
    assert whole == alone


@pytest.mark.parametrize("min_length", [2, 5, 40])
def test_other_least_lengths(min_length):
    rng = random.Random(min_length)
    texts = ["".join(rng.choice("ab") for _ in range(200)), "ab" * 30 + "c" * 30]
    assert searched(texts, min_length) == [plain_runs(t, min_length) for t in texts]
