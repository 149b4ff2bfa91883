"""The corpus pipeline stage by stage on the small tables."""

from collections import Counter
from itertools import combinations

import corpus_pipeline
import public_tokenizers
from .test_simhash import plain_components, plain_fingerprint
from threadloom.llm import mixing, packing, quality, toxicity
from threadloom.llm.common import read_table
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.001"


def test_stages_and_their_columns(spark, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "mixing", "packing"]
    docs = read_table(spark, SF_DIR, "documents")
    columns, before = docs.columns, docs
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
            assert docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
        if name in ("quality", "toxicity", "near_duplicates"):
            assert 0 < counts[-1] <= before.count()
    # Packing keeps every token of what the mixture kept.
    assert docs.where("start = 0").count() == counts[3]
    assert docs.agg({"length": "sum"}).first()[0] == docs.where("start = 0").agg({"doc_tokens": "sum"}).first()[0]
    filled = dict(docs.groupBy("sequence_id").sum("length").collect())
    assert max(filled.values()) <= packing.SEQUENCE_TOKENS
    tasks = {s >> 32 for s in filled}
    assert sum(packing.SEQUENCE_TOKENS - n for n in filled.values()) < packing.SEQUENCE_TOKENS * len(tasks)
    labels = {r.doc_id: r for r in read_table(spark, SF_DIR, "labels").collect()}
    kept = {r.doc_id for r in docs.select("doc_id").distinct().collect()}
    clean = [d for d, r in labels.items() if r.quality == 1 and r.toxic == 0]
    dirty = [d for d, r in labels.items() if r.quality == 0 or r.toxic == 1]
    assert sum(d in kept for d in dirty) <= 0.35 * len(dirty)  # few labels to learn from
    assert sum(d in kept for d in clean) >= 0.5 * len(clean)


def test_pipeline_of_no_documents(spark, tmp_path):
    docs = read_table(spark, SF_DIR, "documents").where("false")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == 0


def test_rows_equal_a_brute_force_pipeline(spark, tmp_path, prose, odd_documents):
    """Every stage's rows, worked out by plain Python from its own input, on hubs of copies and odd rows."""
    small = read_table(spark, SF_DIR, "documents")
    first = [(r.doc_id, r.text) for r in small.limit(60).collect() if r.text]
    hub = [(50_000 + i, first[7][1]) for i in range(120)] + [(51_000 + i, first[9][1] + f" end{i}") for i in range(40)]
    extra = spark.createDataFrame([(*r, "en", "hub", len(r[1])) for r in hub], small.schema)
    docs = small.union(extra).union(odd_documents.select(small.columns))
    labels = read_table(spark, SF_DIR, "labels")
    key = lambda rows: Counter((r.doc_id, r.text) for r in rows)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        seen[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = seen[name][1]

    for name, classify, kept in (("quality", quality.classify_quality, 1), ("toxicity", toxicity.score_toxicity, 0)):
        before, after = seen[name]
        verdicts = Counter((r.doc_id, r.predicted) for r in classify(before, labels).collect())
        wanted = Counter({d: n for (d, p), n in verdicts.items() if p == kept})
        assert Counter(r.doc_id for r in after.collect()) == wanted

    before, after = seen["near_duplicates"]
    rows = sorted({(r.doc_id is None, r.doc_id or 0, r.text or "") for r in before.collect()})
    prints = [plain_fingerprint(text, 3) for _, _, text in rows]
    values = sorted(set(prints))
    roots = plain_components([(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 2], values)
    best = {}
    for (none, doc_id, _), p in zip(rows, prints, strict=True):
        best.setdefault(roots[p], None if none else doc_id)
    assert Counter(r.doc_id for r in after.collect()) == Counter(best.values())

    before, after = seen["mixing"]
    labelled = mixing.labelled_languages(before, labels)
    rates = mixing.mixing_rates(before, labelled, mixing.LANGUAGE_TARGETS).collect()
    wanted = Counter()
    for r in rates:
        wanted[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in after.collect()) == +wanted
    assert key(after.collect()).keys() <= key(before.collect()).keys()

    before, after = seen["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = Counter()
    for r in before.collect():
        ids[r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids) + 1] += 1
    pieces = after.collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in pieces if r.start == 0) == ids
    total = Counter()
    for r in pieces:
        total[r.doc_id] += r.length
    assert total == sum((Counter({d: n * times}) for (d, n), times in ids.items()), Counter())
