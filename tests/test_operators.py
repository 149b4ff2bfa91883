"""Sampling, ranking, history, attempts, scoring and array operators."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from threadloom.functions.training import encode_examples
from threadloom.operators import history, language, links, pairs, ranking, sampling, scoring, vocab
from threadloom.operators.attempts import first_valid_attempt
from threadloom.sources import stages


def hashed(i, seed):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


@pytest.fixture(scope="module")
def hot(spark):
    """A stratum with a third of the rows next to many small ones."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 20)).alias("company")
    )


@pytest.mark.parametrize("n", [1, 10, 2999, 3000, 5000, None])
def test_sample_n_is_exact_and_partition_independent(hot, n):
    got = {r["id"] for r in sampling.sample_n(hot.repartition(7), n, 42, "id").collect()}
    wanted = sorted(range(3000), key=lambda i: hashed(i, 42))[: n or 3000]
    assert got == set(wanted)


def test_split_sizes(hot):
    split = sampling.train_val_split(hot, 1, "id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in split} == {"val": 600, "train": 2400}


def test_hash_rank_is_a_permutation(hot):
    rows = sampling.shuffle_rows(hot, 5, "id").orderBy("shuffle_idx").collect()
    assert [r["shuffle_idx"] for r in rows] == list(range(3000))
    assert [r["id"] for r in rows] == sorted(range(3000), key=lambda i: hashed(i, 5))


@pytest.mark.parametrize(
    "values, total",
    [(["hot", "c1", "absent"], 90), (["hot", "c1"], 10), (["c1", "c2"], 100000), (["hot", "c1", "c2"], 2), (["absent"], 5)],
)
def test_quota_sample(hot, values, total):
    got = sampling.stratified_quota_sample(hot, "company", values, total, 3, "id").collect()
    company = {i: "hot" if i % 3 == 0 else f"c{i % 20}" for i in range(3000)}
    quota = total // len(values)
    wanted = []
    for v in values:
        members = [i for i in range(3000) if company[i] == v]
        wanted += sorted(members, key=lambda i: hashed(i, 3))[:quota]
    spare = [i for i in range(3000) if company[i] in values and i not in set(wanted)]
    wanted += sorted(spare, key=lambda i: hashed(i, "3:extra"))[: total - len(wanted)]
    assert sorted(r["id"] for r in got) == sorted(wanted)
    assert sorted(r["sample_idx"] for r in got) == list(range(len(wanted)))


def test_zip_with_index(spark):
    words = spark.createDataFrame([(f"w{i % 700:03d}", i % 7) for i in range(700)], "w string, n int")
    order = [F.col("n").desc(), F.col("w").asc()]
    rows = ranking.zip_with_index(words.repartition(5), order).orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(700))
    assert [(r["n"], r["w"]) for r in rows] == sorted(((i % 7, f"w{i:03d}") for i in range(700)), key=lambda x: (-x[0], x[1]))


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_history_does_not_depend_on_blocks(spark, block):
    rng = random.Random(block)
    rows = []
    for conv in range(6):
        turn = 0
        for _ in range(40 if conv == 0 else 5):
            turn += rng.randint(1, 9)
            rows.append((conv, turn, rng.choice(["user", "assistant", "system"]), f"t{turn}"))
    wanted = {}
    for conv in range(6):
        lines = []
        for c, turn, role, text in rows:
            if c == conv and role != "system":
                lines.append(("Customer: " if role == "user" else "Support: ") + text)
                if role == "user":
                    wanted[conv, turn] = "\n".join(lines[-6:])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = history.history_window(df.repartition(3), block=block).collect()
    assert {(r["conv_id"], r["turn"]): r["history"] for r in got} == wanted


def test_pairing_rules(spark):
    rows = [
        (1, "u", True, "question", None),
        (2, "a", False, "first answer", 1),
        (3, "b", False, "second answer", 1),
        (4, "u", True, "not a company", 1),
        (5, "a", None, "unknown direction", 1),
        (6, "a", False, "no parent", None),
        (7, "a", False, "answers an answer", 2),
    ]
    df = spark.createDataFrame(rows, "tweet_id long, author_id string, inbound boolean, cleaned_text string, in_response_to_tweet_id long")
    got = sorted((r["response"], r["company"]) for r in pairs.pair_replies(df).collect())
    assert got == [("first answer", "a"), ("second answer", "b")]
    empty = pairs.pair_replies(df.where("false"))
    assert empty.columns == ["input", "response", "customer_input", "company"] and empty.count() == 0


def test_first_valid_attempt(spark):
    rows = [(1, 0, "a"), (1, 1, "b [1]"), (1, 2, "c [2]"), (2, 0, "x"), (2, 1, "y")]
    df = spark.createDataFrame(rows, "m int, attempt int, response string")
    got = first_valid_attempt(df, ["m"], F.col("response").contains("[")).collect()
    assert {r["m"]: (r["attempt"], r["valid_response"]) for r in got} == {1: (1, "b [1]"), 2: (None, None)}


def test_perplexity_cap(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 100.0)], "g string, nll double")
    got = {r["g"]: r["perplexity"] for r in scoring.perplexity(df, ["g"]).collect()}
    assert math.isclose(got["a"], math.exp(2.0)) and got["b"] == math.inf


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_sentiment_negation(spark, monkeypatch, limit):
    monkeypatch.setattr(scoring, "LEXICON_ROWS", limit)
    lexicon = spark.createDataFrame([("good", 0.8), ("bad", -0.6)], "word string, polarity double")
    rows = spark.createDataFrame(
        [(1, "good and bad"), (2, "not good"), (3, "no words here"), (4, ""), (5, None), (6, "Good GOOD bad")],
        "id int, text string",
    )
    got = {r["id"]: round(r["sentiment"], 6) for r in scoring.sentiment(rows, lexicon, "id").collect()}
    assert got == {1: 0.1, 2: -0.4, 3: 0.0, 4: 0.0, 5: 0.0, 6: round(1 / 3, 6)}


def test_gibberish_verdicts(spark):
    corpus = spark.createDataFrame([("the order will arrive soon and the order is fine",)], "text string")
    frequencies = scoring.word_frequency(corpus)
    rows = spark.createDataFrame(
        [(1, "the order"), (2, "1 2 3 4"), (3, "the order zzz qqq xxx"), (4, "the order qqq xxx"), (5, ""), (6, None)],
        "id int, text string",
    )
    for limit in (2.5, -3.0):  # broadcast word list, then the unbounded one
        got = scoring.gibberish_gate(rows, frequencies, "id", min_zipf=limit).collect()
        verdict = {r["id"]: r["verdict"] for r in got}
        assert verdict[1] == "short" and verdict[2] == "no_words"
        assert verdict[3] == "rare" and verdict[4] == "ok" and verdict[5] == "short"


def test_language_paths_agree(spark, monkeypatch):
    train = spark.createDataFrame(
        [("en", "the cat and the dog went there"), ("fr", "le chat et le chien sont la bas"), ("de", "der hund und die katze")],
        "lang string, text string",
    )
    rows = spark.createDataFrame(
        [(1, "the dog"), (2, "le chien"), (3, "die katze und der hund"), (4, ""), (5, None), (6, "ab"), (7, "😀😀😀x")],
        "id int, text string",
    )
    model = language.fit_language_profiles(train)
    small = {r["id"]: r["language"] for r in model.predict(rows, "id").collect()}
    assert small[1] == "en" and small[2] == "fr" and small[3] == "de"
    assert small[4] is None and small[5] is None and small[6] is None and small[7] is not None
    monkeypatch.setattr(language, "BROADCAST_BYTES", 0)
    assert {r["id"]: r["language"] for r in model.predict(rows, "id").collect()} == small


@pytest.mark.parametrize("head", [200_000, 1, 0])
def test_vocabulary_and_unknown_words(spark, monkeypatch, head):
    monkeypatch.setattr(vocab, "HEAD_TOKENS", head)
    corpus = spark.createDataFrame([("b a b c a b",)], "text string")
    words = vocab.build_vocab(corpus)
    assert [(r["token"], r["token_id"]) for r in words.orderBy("token_id").collect()] == [("b", 3), ("a", 4), ("c", 5)]
    rows = spark.createDataFrame([(1, "a x b"), (2, ""), (3, None)], "id int, text string")
    got = {r["id"]: r["ids"] for r in vocab.tokenize_ids(rows, words, "id").collect()}
    assert got == {1: [4, 2, 3], 2: [], 3: []}


@pytest.mark.parametrize("n_in, n_out", [(3, 2), (600, 5), (512, 1), (510, 9), (0, 0), (511, 0)])
def test_encode_examples(spark, n_in, n_out):
    rows = spark.createDataFrame([(list(range(10, 10 + n_in)), list(range(5, 5 + n_out)))], "i array<int>, t array<int>")
    e = rows.select(encode_examples(F.col("i"), F.col("t"), 1, 0).alias("e")).first()["e"]
    src = list(range(10, 10 + n_in))[:512]
    tgt = (list(range(5, 5 + n_out)) + [1])[: 512 - len(src)]
    pad = 512 - len(src) - len(tgt)
    assert e["input_ids"] == src + tgt + [0] * pad
    assert e["attention_mask"] == [1] * (512 - pad) + [0] * pad
    assert e["labels"] == [-100] * len(src) + tgt + [-100] * pad


def test_crawl_budget_and_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "a"), ("b", "d"), ("d", "e"), ("x", "y")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    run = lambda **kw: {r["node"]: r["depth"] for r in links.crawl_frontier(edges, seeds, **kw).collect()}
    assert run(max_depth=1) == {"a": 0, "b": 1, "c": 1}
    assert run(max_depth=9) == {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3}
    assert run(max_depth=9, max_pages=2) == {"a": 0, "b": 1}
    assert run(max_depth=0) == {"a": 0}


def test_links_variants(spark):
    page = '<A class="x" href="/a&amp;b">1</A><a href="http://h.x/c"></a><a href="http://other/"></a><area href="/no">'
    df = spark.createDataFrame([(1, "http://h.x/p/q", page)], "page_id int, url string, html string")
    assert [r["href"] for r in links.extract_links(df).orderBy("link_idx").collect()] == ["http://h.x/a&b", "http://h.x/c"]


def test_stage_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "stage")
    assert stages.stage_or_load(spark, path, build).count() == 3
    assert stages.stage_or_load(spark, path, build).count() == 3
    assert len(calls) == 1
    (tmp_path / "stage" / "_SUCCESS").unlink()  # a half-written stage is rebuilt
    assert stages.stage_or_load(spark, path, build).count() == 3
    assert len(calls) == 2
    with pytest.raises(Exception):
        stages.write_stage(spark.range(1), path)


def test_observed_counts(spark):
    rows, seen = stages.observe_stage(spark.range(10).where("id > 3"), "kept")
    assert rows.where("id < 8").count() == 4
    assert seen.get == {"rows": 6}


def test_sample_keeps_null_ids_and_is_exact_on_ties(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d"), (3, "e"), (3, "f")], "id int, v string")
    for n in range(1, 8):
        got = [r["v"] for r in sampling.sample_n(rows, n, 42, "id").collect()]
        assert len(got) == len(set(got)) == min(n, 6)
    assert sorted(r["i"] for r in sampling.shuffle_rows(rows, 42, "id", "i").collect()) == list(range(6))


def test_transparency_is_left_alone(spark):
    from threadloom.operators.images import augment_images
    from threadloom.schemas import IMAGE

    pixels = bytes([10, 200, 90, 255, 40, 50, 60, 128] * 2)
    rows = spark.createDataFrame([("a.png", 2, 2, 4, 24, bytearray(pixels))], IMAGE)
    got = {r["aug"]: bytes(r["data"]) for r in augment_images(rows, 1).collect()}
    for name in ("bright", "contrast", "original"):
        assert got[name][3::4] == pixels[3::4]
    assert got["bright"] != pixels


def test_links_in_any_quotes(spark):
    from threadloom.operators.links import extract_links

    html = """<a href='/a'>x</a><A class=c HREF=/b>y</A><a href="/c">z</a><a href = "/d"><a data-href="/no"><area href="/no">
    <a title="t"href='http://h/e?x="1"'><a href=""><abbr href="/no">"""
    pages = spark.createDataFrame([(1, "http://h/p", html), (2, "http://h/q", None)], "page_id long, url string, html string")
    assert [r["href"] for r in extract_links(pages).orderBy("link_idx").collect()] == [
        "http://h/a", "http://h/b", "http://h/c", "http://h/d", 'http://h/e?x="1"',
    ]


def test_tokens_are_split_on_all_white_space(spark):
    words = spark.createDataFrame([("order", 6.0), ("arrive", 6.0), ("will", 6.0)], "word string, zipf double")
    rows = spark.createDataFrame([(1, "the\norder\nwill\narrive"), (2, "order arrive\tnow")], "id int, text string")
    got = {r["id"]: (r["n_tokens"], r["verdict"]) for r in scoring.gibberish_gate(rows, words, "id").collect()}
    assert got == {1: (4, "ok"), 2: (3, "ok")}


def test_any_number_of_languages(spark):
    train = spark.createDataFrame([(f"l{i:04d}", f"x{i:04d}y") for i in range(700)], "lang string, text string")
    rows = spark.createDataFrame([(i, f"x{i:04d}y") for i in range(0, 700, 70)], "id int, text string")
    got = language.fit_language_profiles(train).predict(rows, "id").collect()
    assert all(r["language"] == f"l{r['id']:04d}" for r in got)


def test_similarity_probe_moves_no_rows(spark):
    from threadloom.operators import retrieval

    vectors = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(50)], "vec_id int, embedding array<double>")
    asked = vectors.select("vec_id", "embedding").withColumnRenamed("embedding", "vec")
    assert retrieval._collect_if_small(asked, 49) is None
    assert len(retrieval._collect_if_small(asked, 50).ids) == 50
    assert retrieval._collect_if_small(asked.limit(0), 50) is None


@pytest.mark.parametrize("block", [3, 10_000])
def test_closing_word_starts_a_new_session(spark, block):
    rng = random.Random(5)
    talk = []
    for conv in range(6):
        for turn in range(12):
            role = "user" if turn % 2 == 0 else "assistant"
            closes = role == "user" and rng.random() < 0.3
            talk.append((conv, turn, role, " Bye " if closes else f"t{turn}"))
    wanted, lines = {}, {}
    for conv, turn, role, text in talk:
        kept = lines.setdefault(conv, [])
        if role == "user" and text.strip().lower() == "bye":
            kept.clear()
            wanted[conv, turn] = ""
            continue
        kept.append(("Customer: " if role == "user" else "Support: ") + text)
        if role == "user":
            wanted[conv, turn] = "\n".join(kept[-6:])
    turns = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    got = history.history_window(turns, block=block).collect()
    assert {(r["conv_id"], r["turn"]): r["history"] for r in got} == wanted


def test_language_of_null_and_repeated_ids(spark, monkeypatch):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")], "text string, lang string")
    model = language.fit_language_profiles(train)
    texts = [(None, "the dog"), (None, "die katze"), (1, "the cat and"), (1, "der hund und die"), (2, None), (2, "katze")]
    rows = spark.createDataFrame(texts, "id long, text string")
    wanted = sorted([("None", "en"), ("None", "de"), ("1", "en"), ("1", "de"), ("2", "None"), ("2", "de")])
    for size in (language.BROADCAST_BYTES, 0):
        monkeypatch.setattr(language, "BROADCAST_BYTES", size)
        assert sorted((str(r["id"]), str(r["language"])) for r in model.predict(rows, "id").collect()) == wanted


def test_sizes_are_exact_with_repeated_ids(spark):
    """Rows of one id or of none, different and equal ones, in every sampling operator."""
    schema = "id int, company string, v int"
    for rows in (
        [(None, "a", i) for i in range(20)],
        [(7, "a", i // 4) for i in range(20)],
        [(7, "a", 1)] * 20,
        [(i % 3, "a", i % 5) for i in range(16)] + [(None, "a", 0)] * 4,
    ):
        df = spark.createDataFrame(rows, schema).repartition(3)
        split = sampling.train_val_split(df, 1, "id").collect()
        assert sorted((r.id or -1, r.v) for r in split) == sorted((r[0] or -1, r[2]) for r in rows)
        assert sum(r.split == "val" for r in split) == 4
        got = sampling.stratified_quota_sample(df, "company", ["a"], 5, 3, "id").collect()
        assert len(got) == 5 and sorted(r.sample_idx for r in got) == list(range(5))
        several = sampling.stratified_quota_sample(df.unionByName(df.withColumn("company", F.lit("b"))), "company", ["a", "b"], 31, 3, "id")
        counts = {r.company: r["count"] for r in several.groupBy("company").count().collect()}
        assert sum(counts.values()) == 31 and min(counts.values()) >= 15
        assert sampling.sample_n(df, 7, 3, "id").count() == 7


def test_many_rows_of_one_id_are_cut_and_ranked_in_parts(spark, monkeypatch):
    rows = spark.range(100_000).select(F.lit(5).alias("id"), F.col("id").alias("v"))
    split = sampling.train_val_split(rows, 1, "id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in split} == {"val": 20_000, "train": 80_000}
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 1_000)
    ranked = sampling.shuffle_rows(rows, 1, "id").cache()
    assert ranked.columns == ["id", "v", "shuffle_idx"]
    assert ranked.agg(F.countDistinct("shuffle_idx"), F.min("shuffle_idx"), F.max("shuffle_idx")).first() == (100_000, 0, 99_999)
    assert ranked.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    few = spark.range(500)
    usual = {r["id"]: r["i"] for r in sampling.shuffle_rows(few, 5, "id", "i").collect()}
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 0)
    assert {r["id"]: r["i"] for r in sampling.shuffle_rows(few, 5, "id", "i").collect()} == usual


def test_rows_of_one_id_are_judged_each(spark):
    rows = spark.createDataFrame(
        [(None, "alpha beta gamma"), (None, "zzz yyy xxx"), (1, "alpha beta gamma"), (1, "qqq ppp ooo"), (1, "qqq ppp ooo"), (2, None)], "id int, text string"
    )
    words = spark.createDataFrame([("alpha", 6.0), ("beta", 6.0), ("gamma", 6.0)], "word string, zipf double")
    got = scoring.gibberish_gate(rows, words, "id").collect()
    assert sorted((r.id or 0, r.verdict) for r in got) == [(0, "ok"), (0, "rare"), (1, "ok"), (1, "rare"), (1, "rare"), (2, "no_words")]
    lexicon = spark.createDataFrame([("alpha", 1.0), ("zzz", -1.0)], "word string, polarity double")
    felt = scoring.sentiment(rows, lexicon, "id").collect()
    assert sorted((r.id or 0, r.sentiment) for r in felt) == [(0, -1.0), (0, 1.0), (1, 0.0), (1, 0.0), (1, 1.0), (2, 0.0)]
    table = spark.createDataFrame([("alpha", 3), ("beta", 4)], "token string, token_id int")
    ids = vocab.tokenize_ids(rows, table, "id").collect()
    assert sorted((r.id or 0, r.ids) for r in ids) == [(0, [2, 2, 2]), (0, [3, 4, 2]), (1, [2, 2, 2]), (1, [2, 2, 2]), (1, [3, 4, 2]), (2, [])]
    cut = vocab.tokenize_ids(rows, table, "id", max_ids=1).collect()
    assert sorted(len(r.ids) for r in cut) == [0, 1, 1, 1, 1, 1]


def test_rare_and_hot_unknown_tokens(spark, monkeypatch):
    monkeypatch.setattr(vocab, "HEAD_TOKENS", 2)
    table = spark.createDataFrame([(f"t{i}", 3 + i) for i in range(8)], "token string, token_id int")
    texts = ["t0 t5 nowhere nowhere t7"] * 3 + ["nowhere " * 50, "t6 t1 once t6", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    wanted = {i: [3 + int(w[1:]) if w[0] == "t" else 2 for w in t.split()] for i, t in enumerate(texts)}
    for share in (2_048, 3, 0):  # none, some or all tokens are hot
        monkeypatch.setattr(vocab, "HOT_SHARE", share)
        assert {r["id"]: r["ids"] for r in vocab.tokenize_ids(rows, table, "id").collect()} == wanted


def test_language_filter_judges_every_row_by_its_text(spark):
    from threadloom.operators import language

    known = spark.createDataFrame(
        [("en", "the cat and the dog went there"), ("fr", "le chat et le chien sont la bas")], "lang string, text string"
    )
    rows = spark.createDataFrame(
        [(None, "the dog and the cat"), (None, "le chien et le chat"), (1, "the cat"), (1, "le chat et la"), (2, None)], "id int, text string"
    )
    for limit in (language.BROADCAST_BYTES, 0):
        language.BROADCAST_BYTES, usual = limit, language.BROADCAST_BYTES
        try:
            kept = language.english_filter(rows, language.fit_language_profiles(known))
            assert sorted((r.id or 0, r.text) for r in kept.collect()) == [(0, "the dog and the cat"), (1, "the cat")]
        finally:
            language.BROADCAST_BYTES = usual
