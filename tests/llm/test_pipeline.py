"""The stages one by one against plain versions, and the whole."""

import random
import re

import corpus_pipeline
from portpulse.llm.substring_dedup import WINDOW

from test_filters import toxic_rows
from test_ngram_join import brute as near_brute
from test_substring_dedup import brute as repeats_brute

STAGE = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, key string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"k{i}", len(t or "")) for i, t in rows], SCHEMA)


def made_rows():
    r = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, text(r.randint(1, 120))) for i in range(40)]
    rows += [(100, rows[3][1].replace(" ", "\n")), (101, rows[3][1]), (102, None), (103, ""), (104, None)]
    passage = text(60)
    rows += [(110 + k, f"{text(30)}\n{passage} {text(9)}") for k in range(3)]
    near = text(150).split()
    for k in range(3):
        near[k * 50] = "changed"
        rows.append((120 + k, " ".join(near)))
    return rows


def test_stages_on_made_rows(spark, tmp_path):
    rows = made_rows()
    docs = frame(spark, rows)
    got = STAGE["exact_dedup"](spark, docs.union(docs), str(tmp_path))
    assert got.columns == docs.columns
    seen, want = set(), []
    for i, t in sorted(rows, key=lambda x: x[0]):
        normal = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        if normal not in seen:
            want.append((i, t))
            seen.add(normal)
    assert sorted((r.doc_id, r.text) for r in got.collect() if r.text) == [w for w in want if w[1]]
    assert got.count() == len(want)

    kept = frame(spark, want)
    got = STAGE["ngram_dedup"](spark, kept, str(tmp_path))
    near = near_brute(want, 5, 0.8)
    assert got.columns == docs.columns
    want = [w for w in want if (w[0], w[0]) in {(i, c) for i, c, _ in near}]
    assert sorted(r.doc_id for r in got.collect()) == [i for i, _ in want] and 121 not in dict(want)

    got = STAGE["substring_dedup"](spark, frame(spark, want), str(tmp_path))
    assert got.columns == docs.columns
    left = {i: (n, kept) for i, _, n, kept in repeats_brute(want, WINDOW)}
    rows = {r.doc_id: r for r in got.collect()}
    assert set(rows) == set(dict(want))
    for i, t in want:
        n, kept = left[i]
        assert rows[i].text == (kept if n else t) and rows[i].n_chars == len(rows[i].text or "")
    assert rows[111].text.split() == want[[i for i, _ in want].index(111)][1].split()[:30] + rows[111].text.split()[-9:]

    sequences = STAGE["packing"](spark, got, str(tmp_path)).collect()
    assert {r.doc_id for r in sequences} == set(rows)


def test_toxic_documents_go(spark, tmp_path):
    rows = toxic_rows(900)
    spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    docs = frame(spark, [(i, t) for i, t, _ in rows] + [(None, None)])
    got = STAGE["toxicity"](spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    left = {r.doc_id for r in got.collect()}
    bad = sum((i in left) == bool(y) for i, _, y in rows)
    assert bad < 0.03 * len(rows) and None in left


def test_whole_and_empty(spark, tmp_path):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert got and min(r.offset for r in got) == 0
    docs = frame(spark, made_rows()).limit(0)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, _ in corpus_pipeline.STAGES:
        assert STAGE[name](spark, docs, str(tmp_path)).count() == 0
