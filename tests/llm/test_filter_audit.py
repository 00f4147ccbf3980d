"""The audit against running every order row by row."""

import re
from collections import Counter
from itertools import permutations

from portpulse.llm.filter_audit import filter_audit

DOCS = "doc_id long, text string, source string, part string, n_chars int"
LABELS = "doc_id long, quality int, toxic int, row int"


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": any(k is not None and i is not None and k < i and (t or "") == text for k, t, _ in docs),
        }
        rows.append((source or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out, shapley = [], Counter()
    for order in permutations("ABCDE"):
        for part in {r[0] for r in rows}:
            left = [r for r in rows if r[0] == part]
            failing = left
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                fail = [r for r in failing if f in r[1]]
                shapley[part, f] += len(gone)
                out.append(
                    [part, "".join(order), step, len(left), len(gone), len(fail) - len(gone),
                     sum(r[1] == {f} for r in fail), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                )
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(*d, "other", 1) for d in docs], DOCS).repartition(3)
    marks = spark.createDataFrame([(*x, 1) for x in labels], LABELS)
    return sorted(tuple(r) for r in filter_audit(frame, marks).collect())


def test_equals_every_order_run(spark):
    long = " ".join(f"w{k}" for k in range(210))
    same = "word " * 300
    texts = [
        long, long, same, same + "#", "Short", "", None, " \n\t", "#", long + " $", long.upper(), same.upper() + "%",
        "é" * 50 + "A", "é" * 49 + "A", " ".join(["a b"] * 400), long + "\x0b\x0c end", "x" * 100_000, "&\x1ca",
    ]
    docs = [(k, t, ["one", "two", None, ""][k % 4]) for k, t in enumerate(texts * 3)]
    docs += [(None, long, "one"), (None, "", "two"), (5, "Short", "one"), (5, "Short", "one"), (7, long, "three")]
    labels = [(k, k % 2, k % 3 % 2) for k in range(40)] + [(5, 1, 1), (5, 0, 0), (None, 1, 1), (6, None, None), (999, 1, 1)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_one_text_everywhere(spark):
    """A text with nearly all rows: all but the smallest id fail E."""
    docs = [(k, "the same text", "hot" if k % 3 else "cold") for k in range(400)]
    assert audited(spark, docs, []) == brute(docs, [])


def test_empty(spark):
    assert audited(spark, [], []) == []
    assert len(audited(spark, [(None, None, None)], [])) == 600
