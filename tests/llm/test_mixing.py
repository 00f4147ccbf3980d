"""The mix: targets by exact fractions, draws by their definition, totals near the targets."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from portpulse.llm import mixing

DOCS = "doc_id long, text string, source string, size int, target string"
WEIGHTS = (5, 2, 1)


def exact_targets(sizes):
    """Targets per source by giving out the excess until none is above, in fractions."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, open_, target = Fraction(3, 2) * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in open_}
        for s in above:
            target[s] = Fraction(2 * sizes[s])
            left -= target[s]
        open_ -= above
    return target


def mixed(spark, docs, **more):
    frame = spark.createDataFrame([(*d, 3, "x") for d in docs], DOCS).repartition(3)
    return mixing.mix(frame, **more)


def test_targets_and_draws(spark):
    docs = [(k, "w " * (k * 7 % 40), ["a", "b", "B", "", None, "é", "z"][k % 7]) for k in range(300)]
    docs += [(1000 + k, "one two", "hot") for k in range(150)] + [(2000, "", "void"), (None, "lone row", "z")]
    docs += [(9, "again and again", "a")] * 40 + [(3, None, None)] * 3
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += size(t)
    want, rows = exact_targets(sizes), defaultdict(list)
    seen = Counter()
    for i, t, s in docs:
        key = " ".join(
            ["null" if i is None else str(i), hashlib.sha256((t or "").encode()).hexdigest()] + [s] * (s is not None)
        )
        key = hashlib.sha256(key.encode()).hexdigest()
        bits = hashlib.sha256(f"{key} {seen[key]}".encode()).hexdigest()
        seen[key] += 1
        rows[s].append((i, size(t), [int(bits[8 * j : 8 * j + 8], 16) / 2**32 for j in range(8)]))
    expected = []
    for s, found in rows.items():
        rate = float(want[s]) / sizes[s] if sizes[s] else 0.0
        whole, part = int(rate), rate - int(rate)
        taken = [[n * (whole + (u[j] < part)) for _, n, u in found] for j in range(8)]
        best = min(range(8), key=lambda j: abs(sum(taken[j]) - float(want[s])))
        expected += [(i, n, sizes[s], round(float(want[s]), 6), x) for (i, n, _), x in zip(found, taken[best], strict=True)]
    got = mixed(spark, docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(((*r[:3], round(r[3], 6), r[4]) for r in got), key=str) == sorted(expected, key=str)
    by_source = Counter()
    for r in got:
        assert r.taken <= 2 * r.size
        by_source[r.source_size, r.target] += r.taken
    assert all(abs(n - t) <= max(0.05 * t, 60) for (_, t), n in by_source.items())


def test_reruns_agree_however_dealt(spark):
    docs = [(k, f"text {k} " * (k % 9), f"s{k % 4}") for k in range(200)] + [(1, "same row", "s1")] * 30
    frame = spark.createDataFrame([(*d, 3, "x") for d in docs], DOCS)
    runs = [sorted(tuple(r) for r in mixing.mix(f).collect()) for f in (frame.repartition(5), frame.coalesce(1))]
    assert runs[0] == runs[1]


def test_repeated_rows_are_drawn_apart(spark):
    """A row that is there 3,000 times is taken near rate times 3,000, not all or nothing."""
    docs = [(1, "one and the same", "c")] * 3000 + [(k, "some other words", "ab"[k % 2]) for k in range(2, 3000)]
    got = mixed(spark, docs).where("doc_id = 1").collect()
    rate = got[0].target / got[0].source_size
    assert len(got) == 3000 and rate % 1 > 0.05
    assert abs(sum(r.times for r in got) / 3000 - rate) < 0.03


def test_emitted(spark):
    docs = [(k, f"{k} " * 5, "a" if k % 5 else "b") for k in range(100)]
    frame = mixed(spark, docs, keep=("text",))
    times = {r.doc_id: r.times for r in frame.collect()}
    out = mixing.emitted(frame).collect()
    assert Counter(r.doc_id for r in out) == Counter({k: n for k, n in times.items() if n})
    assert all(r.text == f"{r.doc_id} " * 5 for r in out)
    assert {(r.doc_id, r.copy) for r in out} == {(k, c) for k, n in times.items() for c in range(1, n + 1)}


def test_parts_of_a_hot_source(spark, monkeypatch):
    docs = [(k, "w " * (k % 11), "hot" if k % 3 else f"s{k % 9}") for k in range(400)]
    one = sorted(tuple(r) for r in mixed(spark, docs).collect())
    monkeypatch.setattr(mixing, "SHARE", 20)
    assert sorted(tuple(r) for r in mixed(spark, docs).collect()) == one


@pytest.mark.parametrize("docs", [[], [(None, None, None)], [(1, "", "a"), (1, "", "a")]])
def test_nothing_to_take(spark, docs):
    got = mixed(spark, docs).collect()
    assert len(got) == len(docs) and not any(r.taken for r in got)


def test_no_python_on_the_path(spark):
    plan = mixed(spark, [(1, "a b", "s")])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
