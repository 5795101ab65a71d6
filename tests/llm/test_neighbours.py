"""Neighbours against brute force."""

import math

import numpy as np
import pytest

from qalathe.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, rank int"


def brute(vectors, queries, k):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], np.float32).astype(float)
    out = {}
    for q, v in queries:
        scores = (x * np.array(v, np.float32).astype(float)).sum(axis=1)
        order = [p for p in np.lexsort((ids, -scores)) if ids[p] != q][:k]
        out[q] = [(int(ids[p]), float(scores[p])) for p in order]
    return out


def found(table, queries, k, **options):
    out = {}
    for r in sorted(neighbours.nearest(table, queries, k, **options).collect()):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) / len(want[q]) for q in want if want[q]])


@pytest.mark.parametrize("spread", [0.2, 2.0])
def test_recall(spark, monkeypatch, spread):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 100)
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 16)
    monkeypatch.setattr(neighbours, "QUERIES_PER_TASK", 5)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(8, 24))
    x = centres[rng.integers(0, 8, 1500)] + spread * rng.normal(size=(1500, 24))
    rows = [(k, [float(v) for v in np.float32(x[k])], 0) for k in range(1500)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute([r[:2] for r in rows], [r[:2] for r in rows if r[0] % 20 == 0], 20)
    got = found(table, table.where("vec_id % 20 = 0"), 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    exact = {i: v for i, v, _ in rows}
    for q, pairs in got.items():
        for i, score in pairs:
            assert math.isclose(score, np.dot(np.float64(exact[q]), np.float64(exact[i])), rel_tol=1e-9, abs_tol=1e-12)


def test_ties_copies_and_odd_vectors(spark):
    same, other = [1.0, 0.0, 0.5], [0.0, 1.0, 0.25]
    rows = [(k, same, 0) for k in range(60)] + [(100, other, 0)]
    odd = [(200, None, 0), (201, [], 0), (202, [0.0, 0.0, 0.0], 0), (203, [1.0, None, 0.0], 0), (204, [float("nan"), 1.0, 0.0], 0),
           (205, [float("inf"), 1.0, 0.0], 0), (206, [1.0, 2.0], 0), (None, same, 0), (0, same, 0)]
    table = spark.createDataFrame(rows + odd, SCHEMA)
    got = found(table, table.where("vec_id % 20 = 0"), 20)
    assert got == brute([r[:2] for r in rows], [r[:2] for r in rows if r[0] % 20 == 0], 20)
    few = found(table.where("vec_id IN (0, 1, 100)"), table.where("vec_id = 0"), 20)
    assert [i for i, _ in few[0]] == [1, 100]
    assert neighbours.nearest(table.limit(0), table).isEmpty() and neighbours.nearest(table, table.limit(0)).isEmpty()


def test_chi_square_quantile():
    assert math.isclose(neighbours.chi_square_quantile(0.95, 2), -2 * math.log(0.05), rel_tol=1e-9)
    assert math.isclose(neighbours.chi_square_quantile(0.95, 8), 15.5073, rel_tol=1e-4)
