"""Exact deduplication and its index of live digests."""

import hashlib
import random
import re

from portpulse.llm.exact_dedup import CuckooFilter, digest_rows, find_copies, live_index


def sha(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def test_rows_of_every_kind(spark):
    rows = [
        (5, "a b"), (3, "a \n b"), (None, "a\tb"), (9, " a b"), (1, None), (2, ""), (3, "a \n b"),
        (7, "é" * 200_000), (8, "é" * 200_000), (None, "only null"), (4, "A b"), (6, "a\xa0b"),
    ]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int")
    got = find_copies(docs.repartition(4))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = got.collect()
    assert sorted((r.doc_id or -1, r.text_sha256) for r in got) == sorted(
        (i or -1, sha(t)) for i, t in rows
    )
    groups = {}
    for i, t in rows:
        groups.setdefault(sha(t), []).append(i)
    for key, ids in groups.items():
        mine = [r for r in got if r.text_sha256 == key]
        least = min((i for i in ids if i is not None), default=None)
        assert {r.keep_id for r in mine} == {least} and {r.group_size for r in mine} == {len(ids)}
        assert [r.doc_id for r in mine if r.kept] == [least]


def test_empty_table(spark):
    assert find_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_additions_and_removals(spark):
    docs = [(i, f"text {i % 40}") for i in range(100)]
    gone = [(i, f"text {i % 40}") for i in range(100) if i % 40 < 10] + [(7, "never there")]
    make = lambda rows: digest_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    index = live_index(make(docs), make(gone))
    live = {r.digest.hex(): r.live for r in index.collect()}
    assert live == {sha(f"text {k}"): 3 if k < 20 else 2 for k in range(10, 40)}
    kept = {r.digest.hex(): r.keep_id for r in index.collect()}
    assert kept == {sha(f"text {k}"): k for k in range(10, 40)}
    index = live_index(make([(200, "text 3"), (201, "text 11")]), None, index)
    live = {r.digest.hex(): r.live for r in index.collect()}
    assert live[sha("text 3")] == 1 and live[sha("text 11")] == 4 and len(live) == 31


def test_the_smallest_live_row_stays(spark):
    """After every round of additions and removals, against a list of live rows."""
    make = lambda rows: digest_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    r = random.Random(8)
    rows, index, live = [], None, None
    rounds = [([(1, "x"), (2, "x"), (3, "y")], [(1, "x")])]
    rounds += [
        ([(r.choice([None, *range(6)]), f"t{r.randrange(4)}") for _ in range(25)], None) for _ in range(3)
    ]
    for added, removed in rounds:
        rows += added
        if removed is None:
            removed = [r.choice(rows) for _ in range(12)] + [(99, "t0"), (1, "nowhere")]
        before = live_index(make(added), make(removed), index, live)
        for row in removed:
            if row in rows:
                rows.remove(row)
        got = {e.digest.hex(): (e.keep_id, e.live) for e in before.collect()}
        want = {}
        for i, t in rows:
            want.setdefault(sha(t), []).append(i)
        assert got == {
            d: (min((i for i in ids if i is not None), default=None), len(ids)) for d, ids in want.items()
        }
        live = make(rows)
        index = live_index(live)


def test_filter_is_exact_while_it_grows_and_shrinks():
    r, index, known = random.Random(4), CuckooFilter(buckets=2), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    keys += [b"\1\0" + bytes(8) + i.to_bytes(6, "big") for i in range(6)]  # same print and bucket
    for step in range(20_000):
        key = r.choice(keys)
        assert index.find(key) == known.get(key)
        if key in known and r.random() < 0.5:
            assert index.delete(key)
            del known[key]
        elif key not in known:
            index.insert(key, step)
            known[key] = step
    assert index.resized and dict(index.items()) == known and index.count == len(known)
