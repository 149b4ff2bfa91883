import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import neighbours as nb

FIRST = "vec_id % 10 = 0"


def brute(rows, k):
    good = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in good:
        if q % 10 == 0:
            near = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in good if i != q)
            out[q] = near[:k]
    return out


def test_perturbations_come_in_order_and_never_contradict():
    sets = nb.perturbations(4, 81)
    assert len(sets) == 81 == len({tuple(s) for s in sets.tolist()})  # all of 3**4
    assert not any(s[j] and s[7 - j] for s in sets for j in range(4))
    j = np.arange(1, 9)
    expected = np.where(j <= 4, j * (j + 1) / 120, 1 - (9 - j) / 5 + (9 - j) * (10 - j) / 120)
    cost = sets @ expected
    assert (np.diff(cost) >= -1e-12).all() and not sets[0].any()


def test_probed_codes_are_the_perturbed_cells():
    hashing = nb.Hashing.draw(6, 1.0, 40, seed=1)
    vector = np.random.default_rng(0).normal(size=(1, 6))
    cells, _ = hashing._cells(vector, 2)
    codes = hashing.probed(vector, 2)[0]
    assert codes[0] == hashing.codes(vector, 2)[0]
    steps = itertools.product((-1, 0, 1), repeat=3)
    own = {int(((cells[0][:3] + s) * hashing.multipliers[2][:3]).sum()) for s in steps}
    rest = int((cells[0][3:] * hashing.multipliers[2][3:]).sum())
    assert len(codes) == len(set(codes.tolist())) == 40
    assert any(int(c) - rest in own for c in codes[1:].tolist())


def test_recall_on_the_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = nb.nearest_neighbours(table, F.expr(FIRST)).collect()
    wanted = brute([(r.vec_id, r.embedding) for r in table.collect()], 10)
    found = {(r.query_id, r.vec_id) for r in got}
    hits = sum((q, i) in found for q, near in wanted.items() for _, i in near)
    assert hits >= 0.9 * sum(map(len, wanted.values()))
    exact = {(q, i): d for q, near in wanted.items() for d, i in near}
    assert all(r.score == pytest.approx(exact[r.query_id, r.vec_id], abs=1e-12) for r in got if (r.query_id, r.vec_id) in exact)


def test_copies_ties_and_odd_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(40)] + [(50, [1.0, 2.0, 3.5]), (60, [0.0, 0.0, 0.0]), (61, None), (62, [1.0, None, 2.0])]
    rows += [(63, [float("nan"), 1.0, 1.0]), (64, [float("inf"), 1.0, 1.0]), (None, same), (65, [1.0]), (70, [9.0, 9.0, 9.0])]
    table = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<double>, score double, rank int")
    got = {}
    for r in nb.nearest_neighbours(table, F.expr(FIRST)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    wanted = brute([r for r in rows if r[0] != 65], 10)
    assert got[0] == [(0.0, i) for i in range(1, 11)] and got[20] == [(0.0, i) for i in range(10)]
    assert set(got) == set(wanted)
    assert nb.nearest_neighbours(table.where("false"), F.expr(FIRST)).count() == 0
    assert nb.nearest_neighbours(table.where("vec_id = 0"), F.expr(FIRST)).count() == 0


def test_split_parts_give_the_same_neighbours(spark, monkeypatch):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    whole = {tuple(r) for r in nb.nearest_neighbours(table, F.expr(FIRST)).collect()}
    monkeypatch.setattr(nb, "PART_ROWS", 40)
    assert {tuple(r) for r in nb.nearest_neighbours(table, F.expr(FIRST)).collect()} == whole


def test_repeated_rows_leave_room_for_other_ids(spark):
    same, near = [1.0, 2.0, 3.0], [1.0, 2.0, 3.25]
    rows = [(1, same)] * 30 + [(i, same) for i in range(2, 6)] + [(10, same)] + [(6, near)] * 25 + [(7, near), (8, [1.0, 2.5, 3.0])]
    rows += [(6, [9.0, 9.0, 9.0]), (9, [2.0, 2.0, 3.0]), (11, [1.0, 4.0, 3.0]), (12, [5.0, 4.0, 3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.score, r.vec_id) for r in nb.nearest_neighbours(table, F.expr("vec_id = 10")).orderBy("rank").collect()]
    wanted = {}
    for d, i in brute(rows, 1000)[10]:
        wanted.setdefault(i, d)
    assert got == sorted((d, i) for i, d in wanted.items())[:10] and len(got) == 10
