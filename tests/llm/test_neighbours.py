"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from folkmoot.llm import neighbours


def exact(rows, query, k=10):
    rows = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 16}
    if query not in rows:
        return []
    return sorted((float(np.sqrt(((v - rows[query]) ** 2).sum())), i) for i, v in rows.items() if i != query)[:k]


def test_recall_ties_and_invalid_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).round(3).tolist()) for i in range(3000)]
    rows += [(3000 + i, rows[0][1]) for i in range(40)]
    rows += [(None, rows[1][1]), (5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5100, [1.0, None] * 8), (5003, [1.0] * 3), (5004, []), rows[7]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash"))
    out = neighbours.search(table, F.col("id") % 100 == 0, chunk=64).collect()
    hit = total = 0
    for q in range(0, 5200, 100):
        want, got = exact(rows, q), [(r.score, r.vec_id) for r in sorted(out, key=lambda r: r.rank) if r.query_id == q]
        assert len(got) == len(want) and got == sorted(got)
        assert all(abs(s - exact_s) < 1e-12 for s, i in got for exact_s, j in exact(rows, q, 4000) if i == j)
        hit += len({i for _, i in got} & {i for _, i in want})
        total += len(want)
    assert hit / total >= 0.9


def test_copies_do_not_narrow_the_search(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(4000)]
    rows += [(4000 + i, rows[1][1]) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    packed = table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")).mapInArrow(neighbours.as_bytes("f8"), "id long, v binary")
    q = np.array([v for _, v in rows[2:42]])
    true = [exact(rows[:4000], i)[-1][0] for i in range(2, 42)]
    near = neighbours.neighbour_distance(packed, q, 10)
    assert abs(near - np.quantile(true, neighbours.HIGH)) < 1e-9
    m, width, sure = neighbours.fit(q, near, len(rows), neighbours.TABLES)
    assert m == 2 or neighbours.chance(m, near / width, neighbours.PROBES_A_PROJECTION * m, neighbours.TABLES) >= neighbours.AIM
    assert neighbours.chance(m, sure / width, neighbours.PROBES_A_PROJECTION * m, neighbours.TABLES) >= neighbours.AIM
    found = neighbours.search(table, F.col("id") % 100 == 50).where("query_id < 4000").collect()
    hit = sum(len({r.vec_id for r in found if r.query_id == i} & {j for _, j in exact(rows, i)}) for i in range(50, 4000, 100))
    assert hit / 400 >= 0.9


def test_few_rows(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(0, 400, 100)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = neighbours.search(table, F.col("id") % 100 == 0, block=2).collect()
    assert {q: [r.vec_id for r in sorted(out, key=lambda r: r.rank) if r.query_id == q] for q in (0, 300)} == {0: [100, 200, 300], 300: [200, 100, 0]}
    assert neighbours.search(table.limit(0), F.col("id") % 100 == 0).count() == 0


def test_probe_order_is_by_cost():
    f = np.array([0.1, 0.6, 0.35])
    cost = lambda v: sum(x**2 if d < 0 else (1 - x) ** 2 for x, d in zip(f, v) if d)
    found = neighbours.probe_order(f, 27)
    assert len({tuple(v) for v in found}) == 27 and [cost(v) for v in found] == sorted(cost(v) for v in found)


def test_repeated_ids_and_huge_components(spark):
    rows = [(0, [1e200, 1.0]), (1, [-1e200, 1.0]), (2, [1e200, 3.0]), (3, [1.0, 1.0]), (3, [0.5, 1.0]), (100, [1.0, 2.0]), (4, [1e308, 1e308])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    out = neighbours.search(table, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect()
    got = {q: [(r.vec_id, r.score) for r in out if r.query_id == q] for q in (0, 100)}
    assert [i for i, _ in got[0]] == [2, 3, 100, 1, 4] and got[0][0][1] == 2.0 and abs(got[0][3][1] / 2e200 - 1) < 1e-12
    assert got[100][0] == (3, 1.25**0.5)


def test_floats_are_measured_in_double_precision(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(300, 16)).astype(np.float32)
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    for r in neighbours.search(table, F.col("id") % 100 == 0).collect():
        assert abs(r.score - np.linalg.norm(v[r.query_id].astype(float) - v[r.vec_id].astype(float))) < 1e-12
