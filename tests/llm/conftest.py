import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
CLASHING = "score double, predicted int, label int, rank int, word string, term string, fp long, node long, minima string, digest string, tokens long, posterior string, domain string, seed int"


@pytest.fixture(scope="session")
def prose():
    """Deterministic made-up sentences."""

    def make(seed: int, words: int) -> str:
        rng = random.Random(seed)
        parts = ["ba", "de", "ki", "lo", "mu", "ner", "sal", "tor", "ven", "wix"]
        return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(words))

    return make


@pytest.fixture(scope="session")
def odd_documents(spark, prose):
    """Null, empty, blank, very long, repeated and foreign texts, null ids, clashing extra columns."""
    texts = [
        (0, prose(0, 60)), (1, None), (2, ""), (3, " \t\n "), (4, prose(4, 40_000)), (5, prose(0, 60)), (5, prose(0, 60)),
        (6, "Ünïcödé — “quotes” 漢字 \U0001f600 ß"), (None, prose(7, 30)), (None, None), (8, "x" * 50_000), (9, "one"),
        (100, prose(100, 80)), (200, prose(0, 59) + " changed"),
    ]
    names = [c.split()[0] for c in CLASHING.split(", ")]
    kinds = [c.split()[1] for c in CLASHING.split(", ")]
    filler = tuple({"string": "s", "double": 1.5}.get(k, 7) for k in kinds)
    rows = [(i, t, ("en", "de", "fr", "es", None)[n % 5], f"src{n % 3}", len(t or ""), *filler) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


@pytest.fixture(scope="session")
def odd_labels(spark):
    """Repeated, contradictory, null and dangling labels."""
    rows = [(0, 1, 0), (0, 1, 0), (5, 0, 1), (5, 1, 1), (6, None, None), (None, 1, 1), (9, 0, 0), (100, 1, 0), (12345, 1, 1), (4, 1, 0)]
    return spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")


@pytest.fixture(scope="session")
def no_labels(odd_labels):
    return odd_labels.where("false")
