"""URL filters: allow and block rules over host suffixes and path prefixes.

All rules go into one trie: host labels from the right, then path segments from the
left, then what is left of the rule's path (a beginning of one segment). A URL walks
down once and meets exactly the rules that fit it; the longest wins, whether it allows
or blocks. The trie is sent to the tasks; its size is checked first.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.llm.common import Batches, batch, mapped, table

ALLOW, BLOCK = "allow", "block"
#: Characters of all rules together that one broadcast trie may hold.
MOST = 50_000_000
_HOST_END = re.compile(r"[/?#]")
_PATH_END = re.compile(r"[?#]")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for a null or a URL without ``://``."""
    before, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = _HOST_END.search(rest)
    host, rest = (rest[: end.start()], rest[end.start() :]) if end else (rest, "")
    end = _PATH_END.search(rest)
    return host.translate(_LOWER), rest[: end.start()] if end else rest


class _Node:
    __slots__ = ("labels", "segments", "ends")

    def __init__(self):
        self.labels: dict[str, _Node] = {}
        self.segments: dict[str, _Node] = {}
        #: Beginnings of the next segment, with the rule that ends there.
        self.ends: list[tuple[str, Rule]] = []


class Trie:
    def __init__(self, rules: Iterable[Rule]):
        self.root = _Node()
        size = 0
        for rule in rules:
            if rule.verdict not in (ALLOW, BLOCK) or not rule.host:
                raise ValueError(f"not a rule: {rule}")
            size += len(rule.text)
            if size > MOST:
                raise ValueError("too many rules for one broadcast trie")
            node = self.root
            for label in reversed(rule.host.translate(_LOWER).split(".")):
                node = node.labels.setdefault(label, _Node())
            *whole, rest = rule.path.split("/")
            for segment in whole:
                node = node.segments.setdefault(segment, _Node())
            node.ends.append((rest, rule))

    def best(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits; of equally long ones, a blocking one."""
        found: Rule | None = None
        node, segments = self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            below, at = node, 0
            while below is not None:
                for rest, rule in below.ends:
                    if segments[at].startswith(rest) and (
                        found is None
                        or (len(rule.text), rule.verdict) > (len(found.text), found.verdict)
                    ):
                        found = rule
                below = below.segments.get(segments[at]) if at + 1 < len(segments) else None
                at += 1
        return found


def judge(
    pages: DataFrame,
    rules: Iterable[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    ``rule`` is host and path of the longest rule that fits, or null; ``verdict`` is the
    rule's, else ``default``. A null or malformed URL has an empty host and path, which no
    rule fits. Null and repeated ids are allowed; other columns are ignored; an empty
    table gives none.
    """
    trie = Trie(rules)
    sent = pages.sparkSession.sparkContext.broadcast(trie)
    out = pa.schema(
        [("id", pa.int64())] + [(n, pa.string()) for n in ("host", "path", "rule", "verdict")]
    )

    def run(batches: Batches) -> Batches:
        best = sent.value.best
        for b in batches:
            rows = []
            for url in b.column(1).to_pylist():
                host, path = parts(url)
                rule = best(host, path)
                rows.append((host, path, rule and rule.text, rule.verdict if rule else default))
            yield batch(out, [b.column(0), *zip(*rows, strict=True)] if rows else [[]] * 5)

    return mapped(
        pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url")),
        run,
        "id long, host string, path string, rule string, verdict string",
    ).withColumnRenamed("id", id_col)


RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), RULES)


OP1_SQL = r"""
WITH rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), cut AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN strpos(coalesce(url, ''), '://') > 0
              THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT n, page_id, regexp_extract(rest, '^[^/?#]*') AS rawhost, rest FROM cut
), p AS (
  SELECT n, page_id,
         translate(rawhost, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(rawhost) + 1), '^[^?#]*') AS path
  FROM split
), best AS (
  SELECT p.n, arg_max(r.rhost || r.rpath, length(r.rhost || r.rpath)) AS rule,
         arg_max(r.verdict, length(r.rhost || r.rpath)) AS verdict
  FROM p JOIN rules r
    ON (p.host = r.rhost OR p.host LIKE '%.' || r.rhost) AND starts_with(p.path, r.rpath)
  GROUP BY p.n
)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM p LEFT JOIN best b USING (n)
"""
