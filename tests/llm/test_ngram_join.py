"""The n-gram join against comparing all pairs."""

import random

import pytest

from portpulse.llm import common
from portpulse.llm import ngram_join as nj


def grams(text, n):
    words = (text or "").split()  # the texts here hold no other white space than words' own
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, n, threshold):
    sets = [grams(t, n) for _, t in rows]
    near = {i: set() for i in range(len(rows))}
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                near[i].add(j)
                near[j].add(i)
    out, seen = [], {}
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()] - group:
                group.add(k)
                todo.append(k)
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        seen |= dict.fromkeys(group, min(ids, default=None))
    for i, (doc, _) in enumerate(rows):
        out.append((doc, seen[i], len(near[i])))
    return sorted(out, key=str)


def made_rows(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["é", "文"]
    rows = []
    for g in range(12):
        base = [r.choice(words) for _ in range(r.choice([3, 6, 40, 150]))]
        for _ in range(r.choice([1, 2, 9])):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 3])):
                text[r.randrange(len(text))] = r.choice(words)
            rows.append((len(rows) * 3 % 101, "  ".join(text)))
    rows += [(200, None), (201, ""), (202, " \n "), (None, rows[0][1]), (None, "only this one here"), (0, rows[0][1])]
    return rows


@pytest.mark.parametrize("block", [400, 3])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(nj, "BLOCK_TEXTS", block)
    rows = made_rows(block)
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, key int")
    got = nj.similar_texts(docs.repartition(3)).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows, 5, 0.8)
    ids = {}
    for r in got:
        ids.setdefault((r.class_id, r.n_links) if r.class_id is None else r.class_id, []).append(r)
    for key, group in ids.items():
        if key not in (200, 201, 202, 0):
            assert sum(r.kept for r in group) == 1
            assert all(r.doc_id == r.class_id for r in group if r.kept)


def test_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = nj.similar_texts(docs).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows, 5, 0.8)


def test_empty_table(spark):
    assert nj.similar_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = nj.bands_and_rows(threshold, 0.999, 200)
        assert bands * rows <= 200 and 1 - (1 - threshold**rows) ** bands >= 0.999


def test_texts_of_one_template_are_not_compared_all_with_all(spark, monkeypatch):
    """Many texts with a common half and no links: what is verified grows with their number, not its square."""
    seen = []
    settled = common.settle

    def watching(df):
        out = settled(df)
        if out.columns == ["bucket", "one", "two", "block", "key", "buckets"]:
            seen.append(out.count())
        return out

    monkeypatch.setattr(common, "settle", watching)
    r = random.Random(2)
    template = [f"t{k}" for k in range(40)]
    for n in (150, 600):
        rows = [(k, " ".join([*template, *(f"u{r.randrange(10**6)}" for _ in range(80))])) for k in range(n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = nj.similar_texts(docs).collect()
        assert all(x.n_links == 0 and x.class_id == x.doc_id and x.kept for x in got)
    assert seen[1] < 12 * max(seen[0], 20) and seen[1] < 600 * 3


def test_a_pair_is_verified_in_one_bucket(spark, monkeypatch):
    """Copies that share many bands need their sets in few places."""
    seen = []
    settled = common.settle

    def watching(df):
        out = settled(df)
        if out.columns == ["bucket", "one", "two", "block", "key", "buckets"]:
            seen.append(out.count())
        return out

    monkeypatch.setattr(common, "settle", watching)
    base = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join([*base[:k], "other", *base[k + 1 :]])) for k in range(0, 400, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = nj.similar_texts(docs).collect()
    assert {x.n_links for x in got} == {49} and {x.class_id for x in got} == {0}
    assert seen[0] <= 50 * 6


def test_recall_on_pairs_at_the_threshold():
    """Sets that share four fifths of their members meet in some band."""
    import numpy as np

    r = np.random.default_rng(4)
    bands, rows = nj.bands_and_rows(nj.THRESHOLD, nj.RECALL, nj.SIGNATURE)
    met = 0
    for _ in range(400):
        members = r.integers(0, 2**63, 440).astype(np.uint64)
        a, b = np.unique(members[:400]), np.unique(members[44:444])
        one, two = nj._signatures([a, b], bands, rows)
        met += bool((one == two).any())
    assert met >= 398


def test_one_very_long_text(spark):
    long = " ".join(f"w{k % 70_000}" for k in range(150_000))
    rows = [(1, long), (2, long + " end"), (3, "short text of a few words"), (4, "x" * 2_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.class_id, x.n_links) for x in nj.similar_texts(docs).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0), 4: (4, 0)}
