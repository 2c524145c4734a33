import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatstream.llm import neighbours
from beatstream.llm.catalog import op11_nearest_neighbours
from beatstream.llm.common import table

SF = "/root/testdata/sf0.1"
VEC = "vec_id long, embedding array<double>, h1 string, first string, cell string, score string, id string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x", "x") for i, v in rows], VEC)


def exact(rows, queries, k):
    """{query: [(id, score)]} over the distinct (id, vector) rows, the best vector of an id counting."""
    out = {}
    for q in queries:
        best = {}
        for mine in [np.array(v) for i, v in rows if i == q]:
            for i, v in rows:
                if i != q:
                    best[i] = max(best.get(i, -math.inf), float((mine * np.array(v)).sum()))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    for rows in out.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert [(-r[2], r[1]) for r in rows] == sorted((-r[2], r[1]) for r in rows)
    return {q: [(i, s) for _, i, s in rows] for q, rows in out.items()}


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_query_reaches_the_recall(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table(spark, SF, "embeddings").collect()]
    got = found(op11_nearest_neighbours(spark, SF).withColumnRenamed("vec_id", "id"))
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    want = {}
    for q in ids[ids % 20 == 0].tolist():
        s = (x * x[ids == q][0]).sum(1)
        s[ids == q] = -math.inf
        want[q] = [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -s))[:20]]
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    place = {int(i): j for j, i in enumerate(ids)}
    for q, hits in got.items():
        for i, s in hits:
            assert s == float((x[place[i]] * x[place[q]]).sum())


@pytest.mark.parametrize("scales", [(1.0,), (0.1, 1.0, 30.0)])
def test_clusters_and_lengths(spark, scales):
    """Clustered vectors of different lengths: the largest inner product isn't the smallest angle."""
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(12, 16)) * 2
    rows = [(i, [float(x) for x in (centres[i % 12] + rnd.normal(size=16) * 0.4) * scales[i % len(scales)]]) for i in range(1500)]
    got = found(neighbours.nearest(vectors(spark, rows), F.col("id") % 50 == 0, k=10))
    assert recall(got, exact(rows, range(0, 1500, 50), 10)) >= 0.9


def test_odd_vectors_copies_and_ties(spark):
    rnd = random.Random(4)
    unit = [1.0, 0.0, 0.0]
    rows = [(i, unit) for i in range(0, 120)]                      # copies: ties go to the smaller id
    rows += [(i, [rnd.choice([-1.0, 0.0, 1.0]) for _ in range(2)] + [0.5]) for i in range(200, 260)]
    rows += [(20, unit), (300, unit), (300, [0.0, 1.0, 0.0])]      # a repeated row; an id with two vectors
    odd = [(400, None), (420, [0.0, 0.0, 0.0]), (440, [1.0, None, 0.0]), (460, [float("nan"), 1.0, 0.0]), (480, [float("inf"), 0.0, 1.0]),
           (500, []), (520, [1.0, 2.0]), (None, unit), (540, [-0.0, 0.0, -0.0])]
    got = found(neighbours.nearest(vectors(spark, rows + odd), F.col("id") % 20 == 0, k=20, recall=1.0))
    assert got == exact(rows, [q for q in {i for i, _ in rows} if q % 20 == 0], 20)


def test_few_rows_and_empty_tables(spark):
    near = lambda rows: found(neighbours.nearest(vectors(spark, rows), F.col("id") % 20 == 0))
    assert near([]) == {} and near([(1, [1.0])]) == {} and near([(20, [1.0])]) == {}
    assert near([(20, [1.0, 2.0]), (3, [2.0, 0.0]), (40, [1.0, 2.0])]) == {20: [(40, 5.0), (3, 2.0)], 40: [(20, 5.0), (3, 2.0)]}


def test_crowded_cells_are_cut_into_parts(spark, monkeypatch):
    rnd = np.random.default_rng(8)
    rows = [(i, [float(x) for x in np.array([1.0, 0, 0, 0]) + rnd.normal(size=4) * 0.01]) for i in range(600)]
    meet = neighbours._meet
    monkeypatch.setattr(neighbours, "_meet", lambda *a: meet(*a, most_queries=5, most_vectors=40))
    got = found(neighbours.nearest(vectors(spark, rows), F.col("id") % 20 == 0, k=7))
    assert recall(got, exact(rows, range(0, 600, 20), 7)) >= 0.95


def test_probes_come_in_order_of_their_distance():
    rnd = np.random.default_rng(5)
    index = neighbours.Index(1.0, rnd.normal(size=(5, 6)), rnd.uniform(0, 2, 6), 2.0, 2,
                             rnd.integers(0, 1 << 62, 6, np.uint64) * 2 + 1, rnd.integers(0, 1 << 62, 2, np.uint64))
    for _ in range(20):
        spot = rnd.normal(size=3) * 3
        moves = index.probe_moves(spot, 1000)
        assert len(moves) == len(set(moves)) == 5 ** 3 and moves[0] == ()
        inside = spot - np.floor(spot)
        cost = [sum((m - inside[j] if m > 0 else inside[j] - m - 1) ** 2 for j, m in x) for x in moves]
        assert np.allclose(cost, sorted(cost))
        vec = rnd.normal(size=(1, 4))
        probes, home = index.probe_cells(vec, 0, 9)[0], index.cells(np.floor(index.spots(vec, True)))[0]
        assert [p[0] for p in probes] == home.tolist()
        assert [p.tolist() for p in index.probe_cells(vec, 4, 9)[0]] == [p[4:].tolist() for p in probes]
