from threadloom.llm import licenses
from threadloom.llm.common import read_table


def scan(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for _, r in sorted((r.doc_id, r) for r in licenses.scan_licenses(rows).collect())]


def test_base_places_are_counted_word_for_word(spark):
    a, b, c, d = scan(
        spark,
        ["CC-BY cc  by; CC by. all rights; reserved", "General Public Licenses", "x " * 3000 + "general public license " * 3, "ccby cc éby by cc"],
    )
    assert (a.n_words, a.n_base, a.first_word, a.last_word, a.base_labels) == (9, 4, 0, 6, "cc-by,reserved")
    assert (b.n_base, b.first_word, b.last_word, b.base_labels, b.score) == (0, None, None, "", 0.0)
    assert (c.n_words, c.n_base, c.first_word, c.last_word) == (3009, 3, 3000, 3006)
    assert (d.n_words, d.n_base) == (5, 0)


def test_notices_survive_small_changes(spark):
    grant = licenses.TEMPLATES[1][1]
    dropped = " ".join(w for i, w in enumerate(grant.split()) if i != 9)
    added = grant.replace("to any person", "to any natural person")
    whole, less, more, part, far = scan(
        spark, [f"Intro. {grant}; rest", dropped, added, " ".join(grant.split()[:8]), grant.replace(" of ", " of the one and only ")]
    )
    assert whole.labels == less.labels == more.labels == "mit"
    # An added word covers no template word less; a dropped one is missing.
    assert whole.score == more.score == 1.0 and 0.8 <= less.score < 1
    assert part.labels == "" and 0 < part.score < 0.8
    assert far.base_labels == ""


CHANGED = [
    ("Released under the very MIT License", "mit"),
    ("Licensed under the old Apache License, Version 2.0", "apache-2.0"),
    ("GNU Lesser new General Public License", "gpl,lgpl"),
    ("Licensed, as always, under CC BY-NC", "cc-by,cc-by-nc"),
    ("under the, under the, released under the MIT License", "mit"),
    ("the license under the mit released", ""),
    ("Released under the law of the land by MIT people with a License", ""),
    ("licensed under the terms", ""),
]


def test_short_notices_with_an_inserted_word(spark):
    got = scan(spark, [text for text, _ in CHANGED])
    assert [r.labels for r in got] == [labels for _, labels in CHANGED]


def test_changed_notices_match_sql(spark, tmp_path):
    import duckdb
    import oracle

    grants = [text for _, text in licenses.TEMPLATES]
    texts = [t for t, _ in CHANGED] + grants + [" ".join(w for i, w in enumerate(g.split()) if i % 6 != 4) for g in grants]
    texts += [g.replace(" ", " x ", n) for n in (1, 2, 3) for g in grants] + [" ".join(grants), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert oracle.difference(licenses.scan_licenses(docs), con, licenses.oracle_sql()) is None


def test_odd_rows_and_tables(odd_documents, no_documents):
    rows = licenses.scan_licenses(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert sum(r.n_words == 0 for r in rows) == 4
    assert all(r.n_base == 0 and r.first_word is None and r.labels == "" for r in rows)
    assert licenses.scan_licenses(no_documents).count() == 0


def test_no_python_in_the_plan(spark):
    from conftest import plan_of

    plan = plan_of(licenses.scan_licenses(read_table(spark, "/root/testdata/sf0.001", "documents")))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))
