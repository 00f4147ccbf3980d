"""Quality of documents: evidence of the text, on a prior of its site.

A logistic model on statistics of the text gives each document a likelihood ratio (its odds
over the odds of the labelled rows). Sites form levels, from the corpus over the host down
to the path; a site's rate of good documents is a beta-binomial posterior: what its
documents say, on top of its parent's rate counted as ``k`` documents. ``k`` is estimated
for each level from how much the rates of its sites vary beyond chance, so sparse
sites shrink towards their parent and large ones speak for themselves. Everything about
sites is a grouped aggregation with map-side combination; no site is gathered anywhere.

The text model is fitted on at most ``SAMPLE`` labelled rows (about 25 numbers each),
chosen by a hash of the id; site rates use every row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.functions.scale import settle
from portpulse.llm.common import Batches, mapped, table
from portpulse.llm.toxicity import held_out, labelled_sample

SAMPLE = 20_000
#: A site's prior counts as so many documents at least and at most.
LEAST_K, MOST_K = 2.0, 1000.0
_SYMBOLS = re.compile(r"[^\w\s]{2,}|[|<>{}\\]")
_STOPS = re.compile(r"[.!?](?:\s|$)")


def statistics(text: str | None) -> list[float]:
    """What the text model sees; a null text is an empty one."""
    text = text or ""
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    seen = Counter(words)
    letters = max(1, len(text))
    return [
        math.log1p(len(words)),
        min(20.0, sum(map(len, words)) / n),
        len(_SYMBOLS.findall(text)) / n,
        len(seen) / n**0.8,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(map(text.count, "0123456789")) / letters,
        min(1.0, len(_STOPS.findall(text)) / n),
        max(seen.values(), default=0) / n,
        math.log1p(n / max(1, len(lines))),
        min(1.0, text.count(",") / n),
        float(not words),
    ]


SIZE = len(statistics(""))


def _with_statistics(batches: Batches) -> Batches:
    for b in batches:
        at = b.schema.get_field_index("_text")
        found = np.array([statistics(t) for t in b.column(at).to_pylist()], np.float64)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), SIZE).cast(
            pa.list_(pa.float64())
        )
        keep = [i for i in range(b.num_columns) if i != at]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(i) for i in keep), lists], names=[*(b.schema.names[i] for i in keep), "_x"]
        )


class TextModel:
    """A logistic model on the statistics and their squares, standardised."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean, self.scale = np.zeros(2 * SIZE), np.ones(2 * SIZE)
        self.weights = np.zeros(2 * SIZE + 1)
        self.base = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        if not 0 < y.sum() < len(y):
            return
        both = np.hstack((x, x * x))
        self.mean, self.scale = both.mean(0), both.std(0) + 1e-9
        z = np.hstack((np.ones((len(y), 1)), np.clip((both - self.mean) / self.scale, -8, 8)))
        ridge = np.eye(z.shape[1])
        ridge[0, 0] = 1e-6
        for _ in range(40):  # Newton steps
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            slope = z.T @ (y - p) - ridge @ self.weights
            curve = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + ridge
            self.weights = self.weights + np.clip(np.linalg.solve(curve, slope), -2, 2)

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log likelihood ratio of each row."""
        both = np.hstack((x, x * x))
        z = np.clip((both - self.mean) / self.scale, -8, 8)
        at_base = 0 if not self.weights.any() else self.weights[0] - self.base
        return np.clip(z @ self.weights[1:] + at_base, -20, 20)


def fit(sample: DataFrame) -> TextModel:
    """``sample``: _text, _label; a bounded sample."""
    rows = mapped(sample, _with_statistics, "_label int, _x array<double>").collect()
    x = np.array([r._x for r in rows]).reshape(-1, SIZE)
    return TextModel(x, np.array([r._label for r in rows], float))


def _matched(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Join on columns in which null is a value."""
    right = right.withColumnsRenamed({c: f"_up_{c}" for c in columns})
    met = [F.col(c).eqNullSafe(F.col(f"_up_{c}")) for c in columns]
    return left.join(right, met).drop(*(f"_up_{c}" for c in columns))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def site_rates(docs: DataFrame, levels: Sequence[Sequence[str]], value: str) -> list[DataFrame]:
    """Posterior rate of every site of every level: the level's columns and ``_rate``, and what
    it is made of: ``_n`` documents with the sum ``_s``, and ``_k`` documents' worth of the level above.

    ``value`` is each document's own probability. Levels go from coarse to fine, each
    with the columns of the one before; null is a site like any other.
    """
    whole = docs.agg(F.count(value).alias("n"), F.coalesce(F.sum(value), F.lit(0.0)).alias("s")).first()
    rates: list[DataFrame] = []
    parents: Sequence[str] = ()
    for columns in levels:
        sites = docs.groupBy(*columns).agg(F.count(value).alias("_n"), F.sum(value).alias("_s"))
        if parents:
            above = rates[-1].select(*parents, F.col("_rate").alias("_parent"))
            sites = _matched(sites, above, parents)
        else:
            sites = sites.withColumn("_parent", F.lit((whole.s + 1) / (whole.n + 2)))
        joined = settle(sites)
        # Method of moments: variance of rates beyond that of chance, both weighted by size.
        m = joined.agg(
            F.sum("_n").alias("n"),
            F.count(F.lit(1)).alias("sites"),
            F.sum(F.col("_n") * F.pow(F.col("_s") / F.col("_n") - F.col("_parent"), 2)).alias("spread"),
            F.sum(F.col("_parent") * (1 - F.col("_parent"))).alias("chance"),
            F.sum(F.col("_n") * F.col("_parent") * (1 - F.col("_parent"))).alias("whole"),
        ).first()
        k = MOST_K
        if m.n and m.spread > m.chance and m.n > m.sites:
            within = (m.spread - m.chance) / (m.n - m.sites) * m.n / m.whole
            k = min(MOST_K, max(LEAST_K, 1 / min(max(within, 1e-6), 0.9) - 1))
        rates.append(
            joined.select(
                *columns,
                ((F.col("_s") + k * F.col("_parent")) / (F.col("_n") + k)).alias("_rate"),
                "_n",
                "_s",
                F.lit(float(k)).alias("_k"),
            )
        )
        parents = columns
    return rates


def rates_without_own(
    docs: DataFrame, rates: Sequence[DataFrame], levels: Sequence[Sequence[str]], value: str
) -> DataFrame:
    """Adds ``_rate``: the posterior of each document's finest site, of all its documents but this one.

    The document is taken out of every level on the way down, so that its own evidence
    does not come back to it as its site's rate.
    """
    whole = docs.agg(F.count(value).alias("n"), F.coalesce(F.sum(value), F.lit(0.0)).alias("s")).first()
    own = F.col(value)
    docs = docs.withColumn("_rate", (F.lit(whole.s) - own + 1) / F.lit(whole.n + 1))
    for site, columns in zip(rates, levels, strict=True):
        docs = _matched(docs, site.drop("_rate"), columns)
        rate = (F.col("_s") - own + F.col("_k") * F.col("_rate")) / (F.col("_n") - 1 + F.col("_k"))
        docs = docs.withColumn("_rate", rate).drop("_n", "_s", "_k")
    return docs


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    levels: Sequence[Sequence[str]],
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, site_rate, score, predicted.

    ``score`` (0 to 1) is the posterior that the document is good; ``predicted`` is 1 from
    0.5 up. ``site_rate`` is the rate of the document's site without the document itself. ``levels`` names site columns, coarse to fine. Rows whose crc32 of the id, as
    text, is divisible by 5 are held out: their labels are not used. Null and empty
    texts, null sites and null or repeated ids are allowed. Without labels, or with one
    class only, every text is no evidence.
    """
    model = fit(labelled_sample(docs, labels, id_col, text_col, label_col, SAMPLE))
    columns = list(dict.fromkeys(c for level in levels for c in level))
    names = {c: f"_site_{k}" for k, c in enumerate(columns)}
    rows = docs.select(
        F.col(id_col).alias("_id"),
        *(F.col(c).cast("string").alias(n) for c, n in names.items()),
        F.col(text_col).alias("_text"),
    )

    def run(batches: Batches) -> Batches:
        for b in _with_statistics(batches):
            at = b.schema.get_field_index("_x")
            x = b.column(at).flatten().to_numpy().reshape(-1, SIZE)
            found = pa.array(model.evidence(x), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:at], found], names=[*b.schema.names[:at], "_e"])

    schema = rows.drop("_text").schema.add("_e", "double")
    read = settle(rows.mapInArrow(run, schema))
    own = read.withColumn("_p", 1 / (1 + F.exp(-F.col("_e") - F.lit(model.base))))
    deep = [[names[c] for c in level] for level in levels]
    rated = rates_without_own(own, site_rates(own, deep, "_p"), deep, "_p")
    posterior = _logit(F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), F.col("_rate"))))
    return (
        rated.withColumn("_score", 1 / (1 + F.exp(-F.col("_e") - posterior)))
        .select(
            F.col("_id").alias(id_col),
            held_out("_id").alias("held_out"),
            F.col("_rate").alias("site_rate"),
            F.col("_score").alias("score"),
            (F.col("_score") >= 0.5).cast("int").alias("predicted"),
        )
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' host is their source; its parts by language stand for paths."""
    return score_quality(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        [["source"], ["source", "lang"]],
    )
