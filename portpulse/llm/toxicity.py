"""Toxicity by a weighted finite-state grammar over clauses.

Words become classes by a lexicon: insults are whole words or word beginnings (languages
inflect), learned with their weights from labelled rows; threats, targets, negations and
reports are short lists of the grammar. Five transducers read the classes of a clause, each
a table of its own, and run as one machine, their product over the states that can be reached:

* insult: an insult is a match with the lexicon's weight;
* threat: a threatening word and a target, in either order, are a threat when the clause ends;
* target: a clause with a target is aimed when it ends, and weighs more;
* negation, report: from the word on to the end of the clause, matches weigh less.

The text's evidence is the weight of its heaviest clause, the sum over its clauses, and its
strongest threat; a logistic curve with a learned weight for each makes the score.

A clause without an insult or threat has no match and no weight, so only clauses that an
automaton over the lexicon finds are run through the machine; this leaves nothing out.

Learning counts words and word beginnings of the labelled rows on the cluster: first those
of toxic texts, then how often the frequent ones occur in others. At most ``SAMPLE``
labelled rows are used, chosen by a hash of the id: more would not change which words
the grammar knows, and the model keeps a bounded size.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.functions.scale import settle
from portpulse.llm.common import Batches, batch, mapped, table

SAMPLE = 20_000
#: Toxic texts that must hold an entry, and the odds against other texts that it must reach.
SUPPORT = 4
ODDS = 8.0
PREFIXES = range(3, 9)
#: Entries of the lexicon at most, heaviest evidence first.
ENTRIES = 2_000

# Words of the grammar's own classes, in four languages.
TARGETS = "you your youre u he she they him her them his their this these all everyone du dich dir ihr euch sie er tu te toi vous il elle ils tú te usted ustedes él ella ellos"
NEGATIONS = "not no never nor neither without isnt arent wasnt dont doesnt cannot nicht kein keine nie ne pas jamais sans no nunca jamás sin"
REPORTS = "said says say told called calls wrote writes quoted quote claimed claims reported according alleged accused sagte sagt laut dit selon dijo según"
THREATS = "kill hurt destroy beat shoot stab burn attack töten umbringen tuer frapper matar golpear"

WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:,|()\"\n\r]|\s[-–—]\s")

PLAIN, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
#: Weight of a match in the scope of a negation, of a report, and beside a target.
NEGATED, REPORTED, AIMED = 0.5, 0.6, 1.25


@dataclass
class Lexicon:
    """Entries: whole words, and word beginnings, to (class, weight)."""

    words: dict[str, tuple[int, float]] = field(default_factory=dict)
    beginnings: dict[str, tuple[int, float]] = field(default_factory=dict)

    def of(self, word: str) -> tuple[int, float]:
        if word in self.words:
            return self.words[word]
        for n in range(min(len(word), max(PREFIXES)), min(PREFIXES) - 1, -1):
            if word[:n] in self.beginnings:
                return self.beginnings[word[:n]]
        return PLAIN, 0.0

    def triggers(self) -> ahocorasick.Automaton:
        """Finds every place where a word may begin that has weight."""
        machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for entries in (self.words, self.beginnings):
            for text, (kind, _) in entries.items():
                if kind in (INSULT, THREAT):
                    machine.add_word(text, len(text))
        machine.make_automaton()
        return machine


#: A transducer: (state, class) to (state, output). What is not listed changes nothing and says
#: nothing; each ends a clause in state 0.
Table = dict[tuple[int, int], tuple[int, str]]
INSULTS: Table = {(0, INSULT): (0, "insult"), (0, THREAT): (0, "insult")}
#: 0: neither, 1: a threatening word, 2: a target, 3: both
THREATENED: Table = {
    (0, THREAT): (1, ""), (0, TARGET): (2, ""), (1, TARGET): (3, ""), (2, THREAT): (3, ""),
    (1, END): (0, ""), (2, END): (0, ""), (3, END): (0, "threat"),
}
AIMED_AT: Table = {(0, TARGET): (1, ""), (1, END): (0, "aimed")}
NEGATES: Table = {(0, NEGATION): (1, ""), (1, INSULT): (1, "negated"), (1, THREAT): (1, "negated"), (1, END): (0, "")}
TELLS: Table = {(0, REPORT): (1, ""), (1, INSULT): (1, "reported"), (1, THREAT): (1, "reported"), (1, END): (0, "")}


def compose(*tables: Table) -> dict[tuple[int, int], tuple[int, frozenset[str]]]:
    """The product of transducers that read the same classes: from every state that can be
    reached, a class leads to a state (numbered as they are found) and says what each of them says."""
    start = (0,) * len(tables)
    number, todo, step = {start: 0}, [start], {}
    while todo:
        states = todo.pop()
        for kind in range(END + 1):
            moves = [t.get((s, kind), (s, "")) for t, s in zip(tables, states, strict=True)]
            after = tuple(s for s, _ in moves)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            step[number[states], kind] = (number[after], frozenset(said for _, said in moves if said))
    return step


class Grammar:
    """The composed machine over one lexicon."""

    def __init__(self, lexicon: Lexicon, bias: float = 0.0, slopes: tuple[float, ...] = (1.0, 0.0, 0.0)):
        self.lexicon, self.bias, self.slopes = lexicon, bias, slopes
        self.step = compose(INSULTS, THREATENED, AIMED_AT, NEGATES, TELLS)
        self.trigger = lexicon.triggers()

    def run(self, clause: str) -> tuple[float, float]:
        """Weight of a clause's matches, and how strong its threat is (0 without one)."""
        state, total, threat = 0, 0.0, 0.0
        for word in WORD.findall(clause):
            kind, weight = self.lexicon.of(word)
            state, said = self.step[state, kind]
            factor = (NEGATED if "negated" in said else 1.0) * (REPORTED if "reported" in said else 1.0)
            if "insult" in said:
                total += factor * weight
            if kind == THREAT:
                threat = max(threat, factor)
        _, said = self.step[state, END]
        return total * (AIMED if "aimed" in said else 1.0), threat if "threat" in said else 0.0

    def clause(self, text: str) -> float:
        return self.run(text)[0]

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """Weight of the heaviest clause, of all clauses together, and the strongest threat."""
        low = (text or "").lower()
        heaviest = together = strongest = 0.0
        if not len(self.trigger):
            return 0.0, 0.0, 0.0
        done = 0
        for last, size in self.trigger.iter(low):
            at = last - size + 1
            if at < done or at and (low[at - 1].isalpha()):
                continue  # in a clause that has been run, or inside a word
            begin = done
            for m in CLAUSE_END.finditer(low, max(done, at - 400), at):
                begin = m.end()
            if begin == done and at - done > 400:
                for m in CLAUSE_END.finditer(low, done, at):
                    begin = m.end()
            end = CLAUSE_END.search(low, last)
            done = end.end() if end else len(low)
            weight, threat = self.run(low[begin:done])
            heaviest, together = max(heaviest, weight), together + weight
            strongest = max(strongest, threat)
        return heaviest, together, strongest

    def score(self, text: str | None) -> float:
        heaviest, together, threat = self.evidence(text)
        features = (heaviest, math.log1p(together), threat)
        z = self.bias + sum(slope * x for slope, x in zip(self.slopes, features))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _features(text: str | None) -> set[str]:
    """Words (marked by a blank) and word beginnings of a text."""
    words = set(WORD.findall((text or "").lower()))
    out = {w + " " for w in words if len(w) >= min(PREFIXES)}
    for n in PREFIXES:
        out.update(w[:n] for w in words if len(w) >= n)
    return out


def _counted(chosen: frozenset[str] | None):
    def run(batches: Batches) -> Batches:
        found, n = Counter(), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                features = _features(text)
                found.update(features if chosen is None else features & chosen)
                n += 1
        found[""] = n
        out = pa.schema([("feature", pa.string()), ("n", pa.int64())])
        rows = list(found.items())
        for at in range(0, len(rows), 50_000):
            yield batch(out, zip(*rows[at : at + 50_000], strict=True))

    return run


def _counts(texts: DataFrame, chosen: frozenset[str] | None, least: int) -> dict[str, int]:
    """Texts that hold each feature. Bounded: the texts are a bounded sample."""
    counted = mapped(texts, _counted(chosen), "feature string, n long")
    counted = counted.groupBy("feature").agg(F.sum("n").alias("n"))
    return dict(counted.where((F.col("n") >= least) | (F.col("feature") == "")).collect())


def learn(labelled: DataFrame, text_col: str, label_col: str) -> Grammar:
    """A grammar from labelled texts (label 1 or 0; rows with a null label are ignored)."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("y"))
    toxic, other = rows.where("y = 1").select("text"), rows.where("y = 0").select("text")
    positive = _counts(toxic, None, SUPPORT)
    n_toxic = positive.pop("", 0)
    negative = _counts(other, frozenset(positive), 1)
    n_other = negative.pop("", 0)
    entries = _entries(positive, n_toxic, negative, n_other)
    lexicon = _lexicon(_needed(entries, toxic))
    grammar = Grammar(lexicon)
    return _calibrated(grammar, rows, n_toxic, n_other)


def _entries(positive: dict, n_toxic: int, negative: dict, n_other: int) -> dict[str, float]:
    """Candidates with their weights, best first."""
    weight = {}
    for feature, n in positive.items():
        rate = (n + 0.5) / (n_toxic + 1)
        other = (negative.get(feature, 0) + 0.5) / (n_other + 1)
        if rate / other >= ODDS and n > negative.get(feature, 0):
            weight[feature] = math.log(rate / other)
    taken: dict[str, float] = {}
    # The shortest beginning that is as telling as its continuations, then made as long as
    # it can be without losing texts.
    for f in sorted(weight, key=lambda f: (-positive[f] * weight[f], len(f), f)):
        if len(taken) >= ENTRIES:
            break
        if any(f.startswith(t) or t.startswith(f.rstrip(" ")) for t in taken):
            continue
        whole, more = f, True
        while more and not whole.endswith(" "):
            longer = [
                g
                for g in weight
                if len(g) == len(whole) + 1 and g.startswith(whole) and positive[g] >= 0.95 * positive[f]
            ]
            more = bool(longer)
            whole = longer[0] if longer else whole
        taken[whole] = weight[f]
    return taken


def _needed(entries: dict[str, float], toxic: DataFrame) -> dict[str, float]:
    """Entries that explain toxic texts which better ones do not explain yet.

    Copies of one toxic text share all their words; its chance words are told from
    insults by the texts that insults explain already. ``toxic`` is a bounded sample.
    """
    names = list(entries)
    number = {f: k for k, f in enumerate(names)}

    def run(batches: Batches) -> Batches:
        out = pa.schema([("held", pa.list_(pa.int32()))])
        for b in batches:
            held = [
                [number[f] for f in _features(t) if f in number] for t in b.column(0).to_pylist()
            ]
            yield batch(out, [held])

    texts = defaultdict(list)
    for k, row in enumerate(mapped(toxic, run, "`held` array<int>").collect()):
        for entry in row.held:
            texts[entry].append(k)
    explained, kept = Counter(), {}
    for k, f in enumerate(names):
        if sum(explained[t] < 2 for t in texts[k]) >= SUPPORT:
            kept[f] = entries[f]
            explained.update(texts[k])
    return kept


def _lexicon(entries: dict[str, float]) -> Lexicon:
    lexicon = Lexicon()
    lists = ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS))
    for kind, words in lists:
        lexicon.words.update({w: (kind, 0.0) for w in words.split()})
    for f, weight in entries.items():
        # a threatening word can be an insult, too: then it has a weight as well
        threat = f.rstrip(" ") in THREATS.split()
        into = lexicon.words if f.endswith(" ") or threat else lexicon.beginnings
        into[f.rstrip(" ")] = (THREAT if threat else INSULT, weight)
    return lexicon


def _calibrated(grammar: Grammar, rows: DataFrame, n_toxic: int, n_other: int) -> Grammar:
    """Fit the logistic curve on a histogram of the evidence, of bounded size."""

    def run(batches: Batches) -> Batches:
        out = pa.schema([("a", pa.float64()), ("b", pa.float64()), ("c", pa.float64()), ("y", pa.int32()), ("n", pa.int64())])
        found = Counter()
        for b in batches:
            for text, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                heaviest, together, threat = grammar.evidence(text)
                found[min(round(heaviest, 1), 100.0), round(min(math.log1p(together), 20), 1), threat, y] += 1
        if found:
            yield batch(out, zip(*((*k, n) for k, n in found.items()), strict=True))

    cells = (
        mapped(rows.where("y in (0, 1)"), run, "a double, b double, c double, y int, n long")
        .groupBy("a", "b", "c", "y")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    base = math.log((n_toxic + 0.5) / (n_other + 0.5))
    if not cells or not n_toxic or not n_other:
        return Grammar(grammar.lexicon, base, (0.0, 0.0, 0.0))
    data = np.array([(1.0, r.a, r.b, r.c, r.y, r.n) for r in cells])
    x, y, n = data[:, :4], data[:, 4], data[:, 5]
    w = np.array([base, 0.0, 0.0, 0.0])
    ridge = np.diag([1e-6, 0.05, 0.05, 0.05])
    for _ in range(30):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - ridge @ w
        curve = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        w = w + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return Grammar(grammar.lexicon, float(w[0]), (float(w[1]), float(w[2]), float(w[3])))


def held_out(id_col: str) -> F.Column:
    """Rows that take no part in learning; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", sample: int = SAMPLE,
) -> DataFrame:
    """One text and label for each labelled id outside the held-out part, ``sample`` at most or so.

    An id with several labels has the largest of them, and of several texts the one with the
    smallest hash; so the chosen labels and the texts that meet them are bounded, and the
    labels are sent to the texts.
    """
    mine = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    mine = mine.where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out("_id"))
    mine = mine.groupBy("_id").agg(F.max("_label").alias("_label"))
    n = mine.count()
    if n > sample:
        share = int(sample / n * (1 << 30))
        mine = mine.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < share)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    met = texts.join(F.broadcast(mine), F.col("_doc") == F.col("_id"))
    one = met.groupBy("_id").agg(F.min_by(F.struct("_text", "_label"), F.xxhash64("_text")).alias("_one"))
    return settle(one.select("_one._text", "_one._label"))


def scored(
    docs: DataFrame, grammar: Grammar, text_col: str = "text", *keep: str, into: str = "score"
) -> DataFrame:
    """Columns ``keep`` of every row, and the score (0 to 1) under the name ``into``; null
    and empty texts score as texts without a match. Reads nothing but the text."""
    lexicon, bias, slopes = grammar.lexicon, grammar.bias, grammar.slopes

    def run(batches: Batches) -> Batches:
        machine = Grammar(lexicon, bias, slopes)
        for b in batches:
            at = b.num_columns - 1
            found = [machine.score(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:at], pa.array(found, pa.float64())],
                names=[*b.schema.names[:at], into],
            )

    kept = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = kept.drop("_text").schema.add(into, "double")
    return kept.mapInArrow(run, schema)


def learned(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Grammar:
    return learn(labelled_sample(docs, labels), "_text", "_label")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = learned(spark, docs, table(spark, sf_dir, "labels"))
    return scored(docs, grammar, "text", "doc_id").select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
