"""URL rules, quality, toxicity and WARC against plain versions."""

import hashlib
import io
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from portpulse.llm import quality, toxicity, url_filter, warc
from portpulse.llm.url_filter import Rule

# --- URL rules --------------------------------------------------------------


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: (len(r.text), r.verdict), default=None)
    return host, path, best and best.text, best.verdict if best else default


def test_rules_against_trying_all(spark):
    r = random.Random(1)
    hosts = ["org", "a.org", "b.a.org", "com", "x.com", "a", "aorg", "A.ORG", "a.org:80", "é.org", ""]
    paths = ["", "/", "/es", "/es/", "/es/a", "/en/1", "/en/12/x", "//", "/en//", "?q", "#f", "/es?x/y", "/es/a#b"]
    urls = [f"{s}{h}{p}" for s in ("http://", "://", "") for h in hosts for p in paths]
    urls += [None, "", "x://y://a.org/es/", "http://" + "a." * 5000 + "org/es/" + "z/" * 20_000]
    rules = list(url_filter.RULES)
    rules += [Rule(r.choice(["allow", "block"]), r.choice(["org", "a.org", "x.com", "a"]), r.choice(["/e", "/es/a", "/en/", "//", "/"])) for _ in range(12)]
    rows = [(i % 50 or None, u, 1) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host int")
    got = url_filter.judge(pages.repartition(3), rules).collect()
    want = [(i, *plain_verdict(u, rules)) for i, u, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_bad_rules_and_too_many():
    with pytest.raises(ValueError):
        url_filter.Trie([Rule("deny", "org")])
    with pytest.raises(ValueError):
        url_filter.Trie(Rule("allow", "x" * 10_000_000) for _ in range(6))


# --- toxicity ----------------------------------------------------------------


def toxic_rows(n=1500):
    r = random.Random(2)
    plain = ["tree", "house", "river", "walk", "green", "stone", "you", "said", "not", "light"]
    rows = []
    for i in range(n):
        words = [r.choice(plain) + r.choice(["", "", "s"]) for _ in range(r.randint(5, 60))]
        y = int(r.random() < 0.2)
        if y:
            for _ in range(r.randint(2, 4)):
                insult = r.choice(["fizzle", "grotz", "blarg"]) if i % 2 else "schnurk" + r.choice(["te", "en", "el", "ig"])
                words.insert(r.randrange(len(words)), insult)
        rows.append((i, " ".join(words) + ".", y))
    return rows


def test_held_out_accuracy(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    docs = docs.union(spark.createDataFrame([(None, None, "x"), (9000, "", "x"), (9001, "fizzle " * 30_000, "x")], docs.schema))
    grammar = toxicity.learned(spark, docs, labels)
    got = toxicity.scored(docs, grammar, "text", "doc_id")
    got = {r.doc_id: r.score for r in got.collect()}
    assert len(got) == len(rows) + 3 and all(0 <= s <= 1 for s in got.values())
    assert got[None] < 0.5 and got[9000] < 0.5 and got[9001] > 0.5
    held = [(y, got[i]) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((s >= 0.5) == bool(y) for y, s in held)
    assert right / len(held) > 0.97
    assert "schnurk" in "".join(grammar.lexicon.beginnings)


def test_grammar_weighs_clauses():
    words = {"fizzle": (toxicity.INSULT, 4.0)}
    words |= {w: (toxicity.TARGET, 0.0) for w in ("you", "they")}
    words |= {"not": (toxicity.NEGATION, 0.0), "said": (toxicity.REPORT, 0.0)}
    g = toxicity.Grammar(toxicity.Lexicon(words), -4.0, (1.0, 0.0))
    w = g.clause
    assert w("you fizzle") > w("a fizzle") > w("said a fizzle") > w("not said fizzle") > 0
    assert w("fizzle you") == w("you fizzle") and w("fizzled") == 0
    text = "not here. a fizzle, said nobody; you fizzle fizzle"
    clauses = [w(c) for c in ("not here", " a fizzle", " said nobody", " you fizzle fizzle")]
    assert g.evidence(text) == (max(clauses), sum(clauses), 0.0)
    assert g.evidence("x " * 5000 + "a fizzle") == (4.0, 4.0, 0.0) and g.evidence(None) == (0.0, 0.0, 0.0)


def threatening():
    words = {"fizzle": (toxicity.INSULT, 4.0), "kill": (toxicity.THREAT, 0.0), "you": (toxicity.TARGET, 0.0)}
    return words | {"not": (toxicity.NEGATION, 0.0), "said": (toxicity.REPORT, 0.0)}


def test_a_threat_is_a_pattern_of_its_own():
    g = toxicity.Grammar(toxicity.Lexicon(threatening()), -3.0, (1.0, 0.0, 5.0))
    assert g.evidence("i kill you") == (0.0, 0.0, 1.0) == g.evidence("you i kill")
    assert g.evidence("kill the lights") == g.evidence("you, kill") == (0.0, 0.0, 0.0)
    assert g.evidence("not kill you")[2] == toxicity.NEGATED
    assert g.evidence("he said not kill you. i kill you")[2] == 1.0
    assert g.evidence("a fizzle")[2] == 0.0 and g.evidence("fizzle you") == (5.0, 5.0, 0.0)
    assert g.score("i kill you") > 0.5 > g.score("kill the lights")


def test_the_product_runs_all_transducers():
    """Against the five tables run side by side, over every short string of classes."""
    tables = (toxicity.INSULTS, toxicity.THREATENED, toxicity.AIMED_AT, toxicity.NEGATES, toxicity.TELLS)
    step = toxicity.compose(*tables)
    assert {s for s, _ in step} == {s for s, _ in step.values()} and len({s for s, _ in step}) > 8
    for classes in itertools.product(range(toxicity.END + 1), repeat=5):
        one, each = 0, [0] * len(tables)
        for kind in classes:
            one, said = step[one, kind]
            moves = [t.get((s, kind), (s, "")) for t, s in zip(tables, each, strict=True)]
            each = [s for s, _ in moves]
            assert said == {x for _, x in moves if x}
        assert step[one, toxicity.END][0] == 0  # a clause leaves nothing open


def test_threats_are_learned_apart_from_insults(spark):
    r = random.Random(6)
    plain = ["tree", "house", "river", "green", "walks", "light"]
    rows = []
    for i in range(800):
        words = [r.choice(plain) for _ in range(12)]
        toxic = i % 2
        words[4:4] = ["kill", "you"] if toxic else ["kill", r.choice(plain)] if i % 4 else ["you", "and"]
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    g = toxicity.learned(spark, docs, labels)
    assert g.slopes[2] > 3 and all(kind != toxicity.INSULT for kind, _ in g.lexicon.words.values())
    assert all((g.score(t) >= 0.5) == bool(y) for _, t, y in rows)


def test_scores_recomputed_plainly(spark):
    """The whole score of every row from the learned parts, without the trigger search."""
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    g = toxicity.learned(spark, docs, labels)
    got = {r.doc_id: r.score for r in toxicity.scored(docs, g, "text", "doc_id").collect()}
    for i, text, _ in rows:
        weights, threats = [0.0], [0.0]
        for clause in toxicity.CLAUSE_END.split(text.lower()):
            kinds = [(w, *g.lexicon.of(w)) for w in toxicity.WORD.findall(clause)]
            total = strongest = 0.0
            for k, (_, kind, weight) in enumerate(kinds):
                if kind in (toxicity.INSULT, toxicity.THREAT):
                    before = {x for _, x, _ in kinds[:k]}
                    factor = (toxicity.NEGATED if toxicity.NEGATION in before else 1) * (
                        toxicity.REPORTED if toxicity.REPORT in before else 1
                    )
                    total += factor * weight
                    strongest = max(strongest, factor if kind == toxicity.THREAT else 0)
            aimed = any(kind == toxicity.TARGET for _, kind, _ in kinds)
            weights.append(total * (toxicity.AIMED if aimed else 1))
            threats.append(strongest if aimed else 0)
        z = g.bias + g.slopes[0] * max(weights) + g.slopes[1] * math.log1p(sum(weights)) + g.slopes[2] * max(threats)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-9)


def test_the_sample_is_bounded_by_ids(spark):
    """One text for each id, however often ids are repeated in texts or labels."""
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(2, "b"), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0)] * 50 + [(None, 1)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(docs, labels).collect()
    kept = {i for i in (1, 2) if zlib.crc32(str(i).encode()) % 5}
    assert len(got) == len(kept) and sorted(r._label for r in got) == sorted({1: 1, 2: 0}[i] for i in kept)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    grammar = toxicity.learned(spark, docs, labels)
    assert toxicity.scored(docs, grammar, "text", "doc_id").count() == 2
    assert toxicity.scored(docs.limit(0), grammar, "text", "doc_id").count() == 0
    got = quality.score_quality(docs.withColumn("site", F.lit(None).cast("string")), labels, [["site"]])
    assert got.count() == 2


# --- quality -----------------------------------------------------------------


def test_quality_held_out_and_shrinkage(spark):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(1200):
        site = "big" if i % 3 == 0 else f"s{i % 40}"
        good = r.random() < (0.95 if site == "big" else 0.3 if site in ("s1", "s2") else 0.7)
        words = [r.choice(["tree", "house", "river", "walks", "green"]) + ("." if k % 9 == 8 else "") for k in range(40)]
        text = " ".join(words) if good else " ".join(w + "###" for w in words)
        rows.append((i, text, site, None if i % 50 == 0 else "p"))
        labels.append((i, int(good)))
    rows += [(None, None, None, None), (3, "", "lonely", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.score_quality(docs.withColumn("score", F.lit("x")), marks, [["host"], ["host", "path"]])
    got = got.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id != 3}
    held = [(y, by[i].predicted) for i, y in labels if i != 3 and by[i].held_out]
    assert len(held) > 150 and sum(y == p for y, p in held) / len(held) > 0.95
    assert by[0 if by[0].site_rate else 3].site_rate > 0.8
    lonely = [r for r in got if r.doc_id == 3 and abs(r.site_rate - by[None].site_rate) < 0.5]
    assert lonely  # single documents stay near the rate of all


def test_quality_site_rates_by_hand(spark):
    rows = [("a", "x", 0.9)] * 30 + [("a", "y", 0.1)] * 10 + [("b", "x", 0.5)]
    docs = spark.createDataFrame(rows, "host string, path string, p double")
    host, path = quality.site_rates(docs, [["host"], ["host", "path"]], "p")
    host = {r.host: r._rate for r in host.collect()}
    path = {(r.host, r.path): r._rate for r in path.collect()}
    whole = (30 * 0.9 + 10 * 0.1 + 0.5 + 1) / 43
    assert min(whole, 0.7) <= host["a"] <= max(whole, 0.7)
    assert 0.1 < path["a", "y"] < host["a"] < path["a", "x"] < 0.9


def test_a_document_is_no_part_of_its_own_prior(spark):
    """Against rates summed up anew for every document without it."""
    r = random.Random(9)
    rows = [(i, f"h{i % 3}" if i % 7 else None, f"p{i % 5}", r.random()) for i in range(60)] + [(60, "alone", "q", 0.9)]
    docs = spark.createDataFrame(rows, "id long, host string, path string, p double")
    levels = [["host"], ["host", "path"]]
    sites = quality.site_rates(docs, levels, "p")
    k = [s.first()._k for s in sites]
    got = {x.id: x._rate for x in quality.rates_without_own(docs, sites, levels, "p").collect()}
    assert len(got) == len(rows)
    for i, host, path, _ in rows:
        rest = [x for x in rows if x[0] != i]
        rate = (sum(x[3] for x in rest) + 1) / (len(rest) + 2)
        for n, same in enumerate(([x for x in rest if x[1] == host], [x for x in rest if x[1:3] == (host, path)])):
            rate = (sum(x[3] for x in same) + k[n] * rate) / (len(same) + k[n])
        assert got[i] == pytest.approx(rate)


def test_quality_scores_recomputed_plainly(spark):
    rows = [(i, "good text here. " * (1 + i % 4) if i % 2 else "### x ### " * (1 + i % 3), f"s{i % 4}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, site string")
    labels = spark.createDataFrame([(i, i % 2) for i, _, _ in rows], "doc_id long, quality int")
    got = {x.doc_id: x for x in quality.score_quality(docs, labels, [["site"]]).collect()}
    model = quality.fit(toxicity.labelled_sample(docs, labels, "doc_id", "text", "quality"))
    evidence = model.evidence(np.array([quality.statistics(t) for _, t, _ in rows]))
    own = 1 / (1 + np.exp(-evidence - model.base))
    k = quality.site_rates(spark.createDataFrame([(s, float(p)) for (_, _, s), p in zip(rows, own)], "site string, p double"), [["site"]], "p")[0].first()._k
    for at, (i, _, site) in enumerate(rows):
        same = [j for j, x in enumerate(rows) if x[2] == site and j != at]
        root = (own.sum() - own[at] + 1) / (len(rows) + 1)
        rate = (own[same].sum() + k * root) / (len(same) + k)
        assert got[i].site_rate == pytest.approx(rate)
        clipped = min(max(rate, 1e-4), 1 - 1e-4)
        z = evidence[at] + math.log(clipped / (1 - clipped))
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-z)))
    empty = quality.score_quality(docs.limit(0), labels, [["site"]])
    assert empty.collect() == []


# --- WARC --------------------------------------------------------------------


def pages_rows():
    long = "é<p>" + "x" * 300
    return [
        (3, "http://a/?x\ny%0A", long), (1, None, long), (2, "http://b/", long), (None, "http://c/", long),
        (4, "http://d/", None), (5, "http://d/", ""), (6, "http://e/", "short"), (7, "http://e/", "short"),
        (8, "http://f/", "".join(random.Random(4).choice("abcé\n ") for _ in range(400_000))),
        (9, "http://g/", "only once " * 20), (1, None, long), (None, None, "null " * 40), (None, None, "null " * 40),
    ]


@pytest.mark.parametrize("size", [997, 1 << 20])
def test_archives_round_trip(spark, tmp_path, size):
    rows = pages_rows()
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    manifest = warc.write_archives(pages.repartition(2), f"file://{tmp_path}/w")
    got = warc.read_archives(manifest, size=size).collect()
    want = []
    for i, url, html in rows:
        raw = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "").encode() == raw and j is not None]
        first = min(ids, default=None)
        again = len(raw) >= 100 and first is not None and i != first
        want.append((i, url, "revisit" if again else "response", len(raw), hashlib.sha256(raw).hexdigest(),
                     first if again else None, None if again else raw))
    key = lambda r: (r[0] or -1, r[1] or "", *r[2:5], r[5] or -1, r[6] is None, bytes(r[6] or b""))
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert warc.read_archives(manifest.limit(0)).count() == 0


def test_every_split_owns_each_record_once():
    raw = b"".join
    members, at = [], 0
    for i in range(30):
        # stored blocks carry the payload as it is: a whole nested member among it
        inner = warc.record(17, 99, "http://nested/", b"nested", "0" * 64, None)
        payload = (f"page {i} " * (i * 7)).encode() + inner
        m = warc.record(at, i, f"http://p/{i}", payload, hashlib.sha256(payload).hexdigest(), None)
        if i % 3 == 0:
            body = zlib.decompress(m, 31)
            pack = zlib.compressobj(0, zlib.DEFLATED, 31)
            m = pack.compress(body) + pack.flush()
        members.append(m)
        at += len(m)
    data = raw(members)
    source = warc.Source(io.BytesIO(data), len(data))
    for size in (1, 50, 333, 5000, len(data)):
        if size == 1:
            spans = [(s, s + 1) for s in range(0, 2000)] + [(2000, len(data))]
        else:
            spans = [(s, min(len(data), s + size)) for s in range(0, len(data), size)]
        found = [f["warc-record-id"] for s, e in spans for f, _ in warc.records(source, s, e)]
        assert found == [f"<urn:page:{i}>" for i in range(30)]
