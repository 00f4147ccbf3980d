"""Near-duplicate vectors against all cosines."""

import math

import numpy as np
import pytest

from portpulse.llm import embedding_dedup as ed


def brute(rows, threshold=0.95):
    ok = [
        i for i, (_, v) in enumerate(rows)
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    near = {i: set() for i in range(len(rows))}
    for i in ok:
        for j in ok:
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if i != j and len(a) == len(b) and a @ b >= threshold * np.linalg.norm(a) * np.linalg.norm(b):
                near[i].add(j)
    out, root = [], {}
    for i in range(len(rows)):
        group, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()] - group:
                group.add(k)
                todo.append(k)
        root[i] = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), root[i], rows[i][0] == root[i]))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [500, 7])
def test_equals_all_cosines(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "BLOCK", block)
    r = np.random.default_rng(block)
    rows = []
    for _ in range(12):
        base = r.standard_normal(24)
        for _ in range(r.integers(1, 14)):
            rows.append((len(rows) * 5 % 97, (base + 0.03 * r.standard_normal(24)).tolist()))
    rows += [(300, None), (301, []), (302, [0.0] * 24), (303, [1.0, None]), (304, [float("nan")] * 24)]
    rows += [(305, [float("inf")] * 24), (None, rows[0][1]), (400, rows[3][1]), (401, rows[3][1])]
    rows += [(306, [1.0, 9.0]), (307, [1.0, 9.1]), (308, [1e300, 1e300]), (309, [1e300, 1.01e300]), (7, rows[9][1])]
    frame = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<double>, key int")
    got = ed.near_vectors(frame.repartition(3)).collect()
    want = brute([x for x in rows if x[0] not in (308, 309)])
    assert sorted((tuple(x) for x in got if x.vec_id not in (308, 309)), key=str) == want
    big = {x.vec_id: x for x in got if x.vec_id in (308, 309)}
    assert {x.component_id for x in big.values()} == {308}


def test_recall_at_the_threshold():
    """Pairs just above the threshold meet in some table."""
    r = np.random.default_rng(1)
    tables, k = ed.tables_and_projections(50_000, 0.95, 0.995, ed.WIDTH)
    near = ed.collision(math.sqrt(0.1), ed.WIDTH)
    assert 1 - (1 - near**k) ** tables >= 0.995
    hits = 0
    for _ in range(300):
        v = r.standard_normal(64)
        v /= np.linalg.norm(v)
        w = r.standard_normal(64)
        w -= (w @ v) * v
        w = 0.951 * v + math.sqrt(1 - 0.951**2) * w / np.linalg.norm(w)
        a = r.standard_normal((tables, k, 64))
        shift = r.uniform(0, ed.WIDTH, (tables, k))
        hits += (np.floor((a @ v + shift) / ed.WIDTH) == np.floor((a @ w + shift) / ed.WIDTH)).all(1).any()
    assert hits >= 290


def test_sample_and_empty(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    assert sorted((tuple(r) for r in ed.near_vectors(frame).collect()), key=str) == brute(rows)
    assert ed.near_vectors(spark.createDataFrame([], frame.schema)).count() == 0


def test_one_very_large_bucket(spark, monkeypatch):
    """Hundreds of different vectors that all link, compared in many pairs of blocks."""
    monkeypatch.setattr(ed, "BLOCK", 40)
    r = np.random.default_rng(3)
    base = r.standard_normal(16)
    rows = [(i, (base + 0.001 * r.standard_normal(16)).tolist()) for i in range(300)] + [(900, (-base).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ed.near_vectors(frame.repartition(4)).collect()
    assert {(x.n_links, x.component_id) for x in got if x.vec_id < 900} == {(299, 0)}
    assert [(x.n_links, x.component_id) for x in got if x.vec_id == 900] == [(0, 900)]


def test_no_schema_pitfalls(spark):
    """An empty table, and columns that share names with the working tables."""
    schema = "vec_id long, embedding array<double>, key int, bucket string, id int"
    assert ed.near_vectors(spark.createDataFrame([], schema)).count() == 0
    got = ed.near_vectors(spark.createDataFrame([(1, [1.0], 2, "b", 3), (2, [2.0], 2, "b", 3)], schema)).collect()
    assert {(x.vec_id, x.n_links, x.component_id) for x in got} == {(1, 1, 1), (2, 1, 1)}
