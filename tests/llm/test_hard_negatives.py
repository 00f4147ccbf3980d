"""Hard negatives against integer products of all rows with all anchors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from portpulse.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string, row int"


def brute(rows, positives=5, negatives=5):
    """Rows of (vec_id, embedding, label); anchors are ids divisible by 10."""
    whole = [
        (i, [math.floor(256 * x) for x in v], y)
        for i, v, y in rows
        if i is not None and y is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    whole = [r for r in whole if sum(x * x for x in r[1]) < hn.LARGEST]
    out = []
    for at, (i, v, y) in enumerate(whole):
        if i % 10:
            continue
        near = sorted(
            (-sum(a * b for a, b in zip(v, w)), k, z)
            for n, (k, w, z) in enumerate(whole) if n != at and len(w) == len(v)
        )
        for p, k, _ in [x for x in near if x[2] == y][:positives]:
            fit = [x for x in near if x[2] != y and -80 * p <= -100 * x[0] <= -100 * p][:negatives]
            out += [(i, k, r, n, -p, -s) for r, (s, n, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = hn.hard_negatives(frame, F.col("vec_id") % 10 == 0, F.col("label"), **more)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("sizes", [{}, {"BLOCK": 4, "STEP": 3, "SPLIT": 16, "ROWS": 5}])
def test_equals_all_products(spark, monkeypatch, sizes):
    for name, n in sizes.items():
        monkeypatch.setattr(hn, name, n)
    r = np.random.default_rng(7)
    centres = r.standard_normal((4, 12))
    rows = []
    for i in range(150):
        v = centres[i % 4] + 0.5 * r.standard_normal(12)
        rows.append((i, v.astype(np.float32).tolist(), int(r.integers(0, 3))))
    rows += [(200 + i, rows[0][1], 1) for i in range(12)]  # copies: ties by the id
    rows += [(10, rows[3][1], 2), (10, rows[3][1], 2), (300, rows[7][1], 5)]  # repeated ids, no positive
    rows += [(310, [0.0] * 12, 1), (311, [-1.0] * 12, 1), (320, [], 1), (321, [], 2), (322, [], 1)]
    rows += [(330, [1.0, 2.0], 1), (331, [1.0, 1.9], 1), (332, [1.0, 1.8], 2), (340, [1e30, 0.0], 1)]
    rows += [(400, None, 1), (401, rows[1][1], None), (None, rows[1][1], 1)]
    rows += [(402, [None] * 12, 1), (403, [float("nan")] * 12, 1), (404, [float("inf")] * 12, 1)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, positives=2, negatives=1) == brute(rows, 2, 1)


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, None, 1)]) == []


@pytest.mark.parametrize("width, top", [(3, 1 << 27), (64, 200), (9_000, 1_000), (40, 1 << 20)])
def test_products_are_exact(width, top):
    """For any width and size of the numbers, up to the largest squared norm."""
    r = np.random.default_rng(width)
    a, b = (r.integers(-top, top, (n, width)) for n in (5, 8))
    bound = max(int(sum(int(x) ** 2 for x in v)) for v in (*a, *b))
    assert bound < hn.LARGEST
    primes = hn.primes_for(bound)
    got = hn.scores([hn.residues(a, p) for p in primes], [hn.residues(b, p) for p in primes], primes)
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(v, w)) for w in b] for v in a]


def test_primes_cover_the_largest_scores():
    assert math.prod(hn.primes_for(hn.LARGEST)) > 2 * hn.LARGEST
    assert len(hn.primes_for(70_000)) == 3 and hn.primes_for(0) == hn.PRIMES[:1]
    for p in hn.PRIMES:
        assert all(p % k for k in range(2, p))


def test_a_tile_holds_one_block(spark):
    """Every row meets every block once, every anchor every split once."""
    rows = spark.range(40).select(F.col("id").alias("row"), F.lit(2).alias("dim"))
    tiles = hn._tiled(rows.where("row % 10 = 0"), rows, 3, 2)
    met = tiles.groupBy("kind", "row").agg(F.count("*").alias("n"), F.countDistinct("block", "split").alias("d"))
    assert {tuple(r) for r in met.select("kind", "n", "d").distinct().collect()} == {(0, 2, 2), (1, 3, 3)}
