"""Substring deduplication against counting every window."""

import random
from collections import Counter

import pytest

from portpulse.llm import substring_dedup as sd
from portpulse.llm.fmindex import FMIndex, repeated_runs

WHITE = " \t\n\x0b\x0c\r"


def words(text):
    out = [""]
    for ch in text or "":
        if ch in WHITE:
            out.append("")
        else:
            out[-1] += ch
    return [w for w in out if w]


def brute(rows, window):
    seen = Counter()
    for _, t in rows:
        w = words(t)
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] >= 2:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), kept))
    return sorted(out, key=str)


def made_rows(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["né", "the", "of", "a b", "文字"]
    shared = [[r.choice(vocabulary) for _ in range(r.randint(8, 60))] for _ in range(4)]
    rows = []
    for i in range(60):
        text = [r.choice(vocabulary) for _ in range(r.randint(0, 80))]
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(text))
            text[at:at] = r.choice(shared)
        rows.append((i, "".join(w + r.choice(WHITE) * r.randint(1, 2) for w in text)))
    rows += [(60, None), (61, ""), (62, " \n"), (None, rows[5][1]), (3, rows[3][1]), (3, "x")]
    rows += [(70, "again " * 300), (71, "again " * 12), (72, rows[7][1] + " end")]
    return rows


@pytest.mark.parametrize("shard", [600_000, 50])
def test_equals_counting_every_window(spark, monkeypatch, shard):
    monkeypatch.setattr(sd, "SHARD_WORDS", shard)
    rows = made_rows(shard)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string")
    got = sd.remove_repeats(docs.repartition(5), window=10, gram=4).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 10)


def quoted_rows(n):
    """A passage in n texts, each time in other surroundings, some of which repeat."""
    r = random.Random(n)
    passage = " ".join(f"p{k}" for k in range(15))
    ends = [" ".join(f"e{r.randrange(9)}" for _ in range(12)) for _ in range(5)]
    rows = []
    for k in range(n):
        other = lambda: " ".join(f"u{r.randrange(10**9)}" for _ in range(r.randrange(14)))  # noqa: E731, B023
        rows.append((k, f"{other()} {passage} {r.choice([*ends, other(), other()])}"))
    return rows


def test_a_passage_in_many_surroundings(spark, monkeypatch):
    """All of its windows go and no other; what is indexed does not grow with the texts."""
    indexed = []
    inner = sd._indexed
    monkeypatch.setattr(sd, "_indexed", lambda rows, *a: indexed.append(rows.count()) or inner(rows, *a))
    for n in (100, 400):
        rows = quoted_rows(n)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = sd.remove_repeats(docs, window=10, gram=4).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, 10)
    assert indexed[1] < 2 * indexed[0] < 200


def test_sides_in_several_ranges(spark):
    """Neighbours of the sorted order in different ranges count as well."""
    rows = quoted_rows(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set(coalesce, "false")
    try:
        got = sd.remove_repeats(docs, window=10, gram=4).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset(coalesce)
    assert sorted(map(tuple, got), key=str) == brute(rows, 10)


def test_a_very_long_text(spark):
    r = random.Random(1)
    long = " ".join(f"w{r.randrange(10**6)}" for _ in range(300_000))
    part = " ".join(long.split()[1000:1100])
    rows = [(1, long), (2, part), (3, "short"), (4, "x" * 3_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in sd.remove_repeats(docs).collect()}
    assert got == {1: (300_000, 100), 2: (100, 100), 3: (1, 0), 4: (1, 0)}


def test_production_window_on_the_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sd.remove_repeats(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, sd.WINDOW)
    assert any(r.n_removed for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sd.remove_repeats(docs).collect() == []


def test_index_against_counting():
    import numpy as np

    for seed in range(60):
        r = random.Random(seed)
        top, least = r.choice([1, 2, 3, 20]), r.choice([2, 3, 5])
        texts = [[r.randint(1, top) for _ in range(r.randint(1, 14))] for _ in range(r.randint(1, 12))]
        lengths, symbols = np.array([len(t) for t in texts]), np.array(sum(texts, []))
        seen = Counter(
            tuple(t[i : i + least]) for t in texts for i in range(len(t) - least + 1)
        )
        want = {
            (k, j)
            for k, t in enumerate(texts)
            for i in range(len(t) - least + 1)
            if seen[tuple(t[i : i + least])] >= 2
            for j in range(i, i + least)
        }
        runs = repeated_runs(FMIndex(symbols, lengths), symbols, lengths, least)
        assert {(k, j) for k, b, e in zip(*runs) for j in range(b, e)} == want


def test_copies_in_the_index():
    import numpy as np

    for seed in range(40):
        r = random.Random(seed)
        texts = [[r.randint(1, 4) for _ in range(r.randint(1, 9))] for _ in range(r.randint(1, 8))]
        copies = np.array([r.randint(1, 3) for _ in texts])
        lengths, symbols = np.array([len(t) for t in texts]), np.array(sum(texts, []))
        index = FMIndex(symbols, lengths, copies)
        assert index.size == int((copies * (lengths + 1)).sum())
        for _ in range(30):
            pattern = [r.choice(symbols.tolist()) for _ in range(r.randint(1, 4))]
            low, high = np.array([0]), np.array([index.size])
            for s in reversed(pattern):
                low, high = index.extend(np.array([s]), low, high)
            want = sum(
                int(c) * sum(t[i : i + len(pattern)] == pattern for i in range(len(t)))
                for t, c in zip(texts, copies)
            )
            assert max(0, int(high[0] - low[0])) == want
