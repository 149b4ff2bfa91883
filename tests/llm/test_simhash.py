import itertools
import random

import pytest
import xxhash

from threadloom.llm import simhash
from threadloom.llm.components import components


def plain_fingerprint(text: str | None, k: int) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    links += [(i, i + 1) for i in range(1000, 1040)] + [(2000, j) for j in range(2001, 2100)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == plain_components(links, linked)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


@pytest.mark.parametrize(("distance", "segments"), [(1, 8), (2, 8), (3, 8), (2, 16), (2, 4)])
def test_grid_finds_exactly_the_near_pairs(spark, distance, segments):
    rng = random.Random(distance)
    values = {0, 1, 3, 7, (1 << 64) - 1, (1 << 64) - 2, 1 << 63}
    for _ in range(60):
        v = rng.getrandbits(64)
        values |= {v, *(v ^ sum(1 << b for b in rng.sample(range(64), n)) for n in (1, 2, 3, 4))}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    pairs = simhash.near_pairs(spark.createDataFrame([(v,) for v in signed], "fp long"), distance, segments).collect()
    got = {frozenset(r) for r in pairs}
    wanted = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance}
    assert got == wanted and len(pairs) == len(wanted)


def test_bound_holds():
    rng = random.Random(0)
    for _ in range(200):
        a, b = rng.getrandbits(64), rng.getrandbits(64)
        steps = sum(abs((a >> 8 * i & 255).bit_count() - (b >> 8 * i & 255).bit_count()) for i in range(8))
        assert steps <= (a ^ b).bit_count()


def test_odd_rows_and_tables(odd_documents, no_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    texts = [(r.doc_id, r.text) for r in odd_documents.collect()]
    prints = sorted((f"{plain_fingerprint(t, 3):016x}", -1 if d is None else d) for d, t in texts)
    assert prints == sorted((r.fingerprint, -1 if r.doc_id is None else r.doc_id) for r in rows)
    values = {int(p, 16) for p, _ in prints}
    roots = plain_components([(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2], values)
    smallest: dict[int, int] = {}
    for p, d in prints:
        if d >= 0:
            root = roots[int(p, 16)]
            smallest[root] = min(d, smallest.get(root, d))
    assert all(r.component_id == smallest.get(roots[int(r.fingerprint, 16)]) for r in rows)
    assert simhash.near_duplicates(no_documents).count() == 0


def exact_keepers(rows) -> list[int]:
    """The smallest id of every group of fingerprints that link, over all pairs."""
    prints = {i: plain_fingerprint(t, 3) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    return sorted(set(plain_components(links, prints).values()))


def edited(words: list[str], places, tag: str) -> str:
    return " ".join(f"{tag}x{i}" if i in places else w for i, w in enumerate(words))


def test_one_of_each_group_stays(odd_documents, no_documents):
    kept = simhash.drop_near_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns and kept.schema == odd_documents.schema
    ids = [r.doc_id for r in kept.collect()]
    # 5 copies 0; 1 to 3 and the null text have no words.
    wanted = exact_keepers([(-1 if r.doc_id is None else r.doc_id, r.text) for r in odd_documents.collect() if r.doc_id is not None])
    assert sorted(-1 if i is None else i for i in ids) == [-1, *wanted]
    assert {0, 1, 4, 6, 8, 9, 100} <= set(ids) and not {2, 3, 5} & set(ids)
    assert simhash.drop_near_duplicates(no_documents).count() == 0


def test_kept_rows_equal_those_of_all_pairs(spark, prose):
    """Families of edits of long texts, hubs of copies and texts without words."""
    rng = random.Random(9)
    rows = []
    for family in range(12):
        words = prose(4000 + family, rng.choice([6, 40, 400, 2000])).split()
        for _ in range(15):
            change = rng.sample(range(len(words)), rng.randrange(1 + len(words) // 50))
            rows.append((len(rows), edited(words, change, f"r{len(rows)}")))
    rows += [(1000 + i, rows[i % 3][1]) for i in range(300)] + [(900, "one"), (901, "ONE"), (902, None), (903, " \n")]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(r.doc_id for r in kept.collect())
    assert got == exact_keepers(rows)
    assert len(got) < 150  # the families do link


def test_the_zero_hash_bit_is_a_strict_majority():
    one, two = xxhash.xxh64_intdigest(b"a b c", 42), xxhash.xxh64_intdigest(b"b c d", 42)
    assert plain_fingerprint("a b c d", 3) == one & two
