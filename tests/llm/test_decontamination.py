import random
import re

import oracle
import pytest
from conftest import plan_of
from threadloom.llm import decontamination as dc
from threadloom.llm.common import read_table

SF_DIR = "/root/testdata/sf0.001"


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered) if w]


def plain_hits(text, items, size=10):
    """Words, words inside a window, and the items that have one, by trying every window everywhere."""
    words, hit, found = plain_words(text), set(), set()
    for item_id, item in items:
        own = plain_words(item)
        if not own:
            continue
        n = min(size, len(own))
        for i in range(len(own) - n + 1):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == own[i : i + n]:
                    hit |= set(range(at, at + n))
                    found.add(item_id)
    return len(words), len(hit), sorted(i for i in found if i is not None)


def compare(spark, docs, items, **settings):
    got = dc.find_contamination(docs, items, **settings).collect()
    listed = [(r.item_id, r.text) for r in items.collect()]
    wanted = sorted((-1 if r.doc_id is None else r.doc_id, *plain_hits(r.text, listed, settings.get("window_words", 10))) for r in docs.collect())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got) == wanted
    for r in got:
        assert [tuple(s) for s in r.spans] == sorted({tuple(s) for s in r.spans})
        assert len({p for s in r.spans for p in range(s.start, s.start + s.length)}) == r.n_hit
    return got


@pytest.fixture(scope="module")
def tables(spark, prose):
    rng = random.Random(4)
    items = [(i, prose(700 + i, 25 + i)) for i in range(12)]
    items += [(20, prose(720, 9)), (21, "Two, words."), (22, "solo"), (23, "..."), (24, None), (25, items[3][1]), (26, "go " * 14), (None, prose(730, 15))]
    docs = []
    for d in range(60):
        words = prose(800 + d, rng.randrange(0, 120)).split()
        for _ in range(d % 4):
            passage = plain_words(rng.choice(items)[1])
            cut = passage[rng.randrange(3) : len(passage) - rng.randrange(3)]
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() if rng.random() < 0.3 else w for w in cut]
        docs.append((d, rng.choice([" ", ", ", "\n-"]).join(words)))
    docs += [(900, items[0][1]), (900, items[0][1]), (901, "go " * 200), (902, "solo two words solo"), (903, " ".join(plain_words(items[1][1])[:9]))]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("few", [200_000, 0])
def test_equals_trying_every_window(spark, tables, monkeypatch, few):
    """The broadcast joins and the salted ones."""
    monkeypatch.setattr(dc, "BROADCAST_ROWS", few)
    got = compare(spark, *tables)
    assert sum(r.n_hit > 0 for r in got) > 20


@pytest.mark.parametrize(("window_words", "shingle_words"), [(10, 1), (10, 5), (4, 3), (1, 2)])
def test_other_windows_and_shingles(spark, tables, window_words, shingle_words):
    compare(spark, *tables, window_words=window_words, shingle_words=shingle_words)


def test_odd_rows_and_tables(spark, odd_documents, no_documents):
    items = odd_documents.select(odd_documents.doc_id.alias("item_id"), "text", "label", "score")
    short = odd_documents.where("length(text) < 5000 or text is null")
    compare(spark, short, items.where("length(text) < 5000 or text is null"))
    whole = {r.doc_id: r for r in dc.find_contamination(odd_documents, items).collect()}
    assert whole[4].n_hit == whole[4].n_words == 40_000 and whole[4].item_ids == [4]
    assert whole[1].n_words == 0 and whole[1].item_ids == []
    assert dc.find_contamination(no_documents, items).count() == 0
    clean = dc.find_contamination(odd_documents, items.where("false")).collect()
    assert len(clean) == odd_documents.count() and all(r.n_hit == 0 and r.spans == [] for r in clean)


def test_no_python_and_matches_sql(spark):
    from threadloom.llm import queries

    got = queries.QUERIES["op11_prefix_filtered_decontamination"](spark, SF_DIR)
    assert "Python" not in plan_of(got) and "Arrow" not in plan_of(got)
    problem = oracle.difference(got, oracle.connect(SF_DIR), dc.oracle_sql())
    assert problem is None, problem


def test_only_the_rarest_shingle_is_joined(spark):
    """A window with a shingle that no document has meets nothing, however common the rest is."""
    items = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "a b c d e f g h i zebra")], "item_id long, text string")
    docs = spark.createDataFrame([(i, "a b c d e f g h i j") for i in range(5)] + [(9, "k a b c x")], "doc_id long, text string")
    places = dc.window_places(docs, items).collect()
    assert sorted(r["_id"] for r in places) == [str(i) for i in range(5)]
    assert all(len(r.places) == 1 and r.places[0].start == 0 for r in places)
    assert read_table(spark, SF_DIR, "benchmark").count() > 0
