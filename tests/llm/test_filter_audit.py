import re
from collections import Counter, defaultdict
from itertools import permutations

import oracle
import pytest
from threadloom.llm import filter_audit
from threadloom.llm.common import read_table

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def plain_failures(rows):
    """The letters that each ``doc_id, text, part`` row fails."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        failed = ""
        failed += "A" * (len(words) < 50)
        failed += "B" * (100 * len(set(words)) < 65 * len(words))
        failed += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text))
        failed += "D" * any(c in text for c in "#$%&*|")
        same = [d for d, t, _ in rows if (t or "") == text and d is not None]
        failed += "E" * (doc_id is not None and any(d < doc_id for d in same))
        out.append(failed)
    return out


def plain_audit(rows, good, toxic):
    """Apply the filters one after the other, in every order."""
    failed = plain_failures(rows)
    out = defaultdict(Counter)
    for order in map("".join, permutations("ABCDE")):
        for part in {p or "" for _, _, p in rows}:
            left = [i for i, r in enumerate(rows) if (r[2] or "") == part]
            everyone = list(left)
            for step, own in enumerate(order, 1):
                gone = [i for i in left if own in failed[i]]
                cell = out[part, order, step]
                cell["redundant"] = sum(own in failed[i] for i in everyone) - len(gone)
                cell["unique_fails"] = sum(failed[i] == own for i in everyone)
                cell["removed"] = len(gone)
                cell["good_lost"] = sum(rows[i][0] in good for i in gone)
                cell["toxic_lost"] = sum(rows[i][0] in toxic for i in gone)
                left = [i for i in left if own not in failed[i]]
                cell["kept"] = len(left)
    shapley = Counter()
    for (part, order, step), cell in out.items():
        shapley[part, order[step - 1]] += cell["removed"]
    return out, shapley


def compare(got, rows, good, toxic):
    wanted, shapley = plain_audit(rows, good, toxic)
    assert len(got) == len(wanted) == 600 * len({p or "" for _, _, p in rows})
    for r in got:
        cell = wanted[r.part, r.filter_order, r.step]
        assert {c: r[c] for c in COLUMNS} == {c: cell[c] for c in COLUMNS}
        assert r.shapley == shapley[r.part, r.filter_order[r.step - 1]]


@pytest.mark.parametrize("share", [2_048, 4])
def test_equals_filters_applied_in_turn(spark, prose, monkeypatch, share):
    """Repeated texts, hot ones that are salted, and texts around every limit."""
    monkeypatch.setattr(filter_audit, "HOT_SHARE", share)
    texts = [prose(i, n) for i, n in enumerate([49, 50, 51, 200, 3])]
    texts += ["", None, " \n ", "a b " * 40, "A" + "b" * 18, "A" + "b" * 19, "x # y", "WORD word " * 30, "price 5 % " + prose(9, 60)]
    texts += [" ".join(f"w{i % 65}" for i in range(100)), " ".join(f"w{i % 64}" for i in range(100)), "\x85".join("ab" * 60)]
    rows = [(i, texts[i % len(texts)], (None, "a", "b")[i % 3]) for i in range(90)] + [(1000 + i, texts[2], "b") for i in range(60)]
    good, toxic = {i for i in range(0, 1100, 3)}, {i for i in range(0, 1100, 7)}
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, int(i in good), int(i in toxic)) for i in range(0, 1100)], "doc_id long, quality int, toxic int")
    compare(filter_audit.audit_filters(docs, labels).collect(), rows, good, toxic)


def test_odd_rows_and_tables(spark, odd_documents, odd_labels, no_documents, no_labels):
    rows = [(r.doc_id, r.text, r.source) for r in odd_documents.collect()]
    good, toxic = {0, 5, 100, 4}, {5}  # 5 has one vote of two for each label
    compare(filter_audit.audit_filters(odd_documents, odd_labels).collect(), rows, good, toxic)
    compare(filter_audit.audit_filters(odd_documents, no_labels).collect(), rows, set(), set())
    assert filter_audit.audit_filters(no_documents, odd_labels).count() == 0


def test_matches_sql(spark):
    got = filter_audit.audit_filters(read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "labels"))
    problem = oracle.difference(got, oracle.connect(SF_DIR), filter_audit.oracle_sql())
    assert problem is None, problem
