"""How filters interact: what each removes in every order, alone, and for nothing.

One table of failing rows is stored per filter. The rows that survive a prefix of filters are
the left anti joins with its tables; what the next filter removes of them is a left semi
join with its table first. What a prefix leaves does not depend on its order, so one chain of
joins serves all sets of filters: before each join a row is doubled, and only one of the two
meets the table. All joins are on the row's number, which no two rows share, so every task
has its share whatever the source, the text or the id; 32 narrow copies of a row at most are
counted where they arise, never written or shuffled.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.functions.scale import settle
from portpulse.llm.common import table

SPACE = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The maximal runs outside white space, none for a text without any."""
    inner = F.btrim(text, F.lit(_BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE))


def failing(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Numbered rows (``row``, ``id``, ``part``) and the numbers of the rows that fail each filter.

    A: under 200 words; B: fewer distinct words than half of all; C: capitals A to Z above
    2 % of the characters; D: one of ``#$%&*|``; E: the text of a smaller id. Null texts are
    empty, a null part is the empty one. A null id is smaller than none and has none below it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        words(text).alias("words"),
    )
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    rows = settle(
        raw.select(
            "row", "id", "part",
            (F.size("words") < 200).alias("A"),
            (100 * F.size(F.array_distinct("words")) < 50 * F.size("words")).alias("B"),
            (100 * capitals > 2 * F.length("text")).alias("C"),
            F.col("text").rlike(r"[#$%&*|]").alias("D"),
            F.unhex(F.sha2("text", 256)).alias("digest"),
        )
    )
    tables = {name: settle(rows.where(name).select("row")) for name in "ABCD"}
    # written, so that no aggregate shares the join's stage: adaptive execution can then split
    # the side that has a hot text
    first = settle(
        rows.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
        .where("n > 1")
        .select(F.col("digest").alias("_digest"), "first")
    )
    copies = rows.join(first, (F.col("digest") == F.col("_digest")) & (F.col("id") > F.col("first")))
    tables["E"] = settle(copies.select("row"))
    return rows.select("row", "id", "part"), tables


def _subsets(rows: DataFrame, tables: dict[str, DataFrame], bit: dict[str, int]) -> DataFrame:
    """Each row once for each set of ``tables`` that it survives; the set is the sum ``before``."""
    rows = rows.withColumn("before", F.lit(0))
    for name, ids in tables.items():
        on = rows.withColumn("_on", F.explode(F.array(F.lit(0), F.lit(bit[name]))))
        gone = ids.select(F.col("row").alias("_row"))
        on = on.join(gone, (F.col("row") == F.col("_row")) & (F.col("_on") > 0), "left_anti")
        rows = on.withColumn("before", F.col("before") + F.col("_on")).drop("_on")
    return rows


def _orders(spark: SparkSession, bit: dict[str, int]) -> DataFrame:
    """Every step of every order of the filters, with the sets before it: m * m! rows."""
    found = []
    for order in permutations(bit):
        before = 0
        for step, name in enumerate(order, 1):
            found.append((len(found), "".join(order), step, list(bit).index(name), bit[name], before))
            before |= bit[name]
    return spark.createDataFrame(found, "_k int, filter_order string, step int, _at int, _bit int, _before int")


def audit(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per part, order of all filters and step, zeros included.

    ``rows`` has ``row``, ``part`` and the flags ``good`` and ``toxic``; ``tables`` holds the
    failing row numbers of each filter, in the order of the letters. Counts within the part:
    ``kept`` after the step, ``removed`` by it, ``redundant`` (failing its filter, removed
    earlier), ``unique_fails`` (failing its filter only), ``good_lost`` and ``toxic_lost``
    among the removed, ``shapley`` (its filter's removed, summed over all orders). The number
    of orders grows as the factorial of the number of filters, which is meant to be small.
    """
    spark, names = rows.sparkSession, list(tables)
    bit = {name: 1 << i for i, name in enumerate(names)}
    full = sum(bit.values())
    totals = [F.count(F.lit(1)).alias("n"), *(F.sum(F.col(c).cast("int")).alias(c) for c in ("good", "toxic"))]

    def counted(found: DataFrame, of: int) -> DataFrame:
        return found.groupBy("part", "before").agg(*totals).withColumn("of", F.lit(of))

    every = counted(_subsets(rows, tables, bit), 0)
    for name in names:
        ids = tables[name].select(F.col("row").alias("_row"))
        fail = rows.join(ids, F.col("row") == F.col("_row"), "left_semi")
        others = {n: t for n, t in tables.items() if n != name}
        every = every.unionByName(counted(_subsets(fail, others, bit), bit[name]))
    every = settle(every)

    size = F.lit(0)
    for name in names:
        size = size + F.shiftright("before", names.index(name)).bitwiseAND(1)
    weights = F.array(*(F.lit(factorial(k) * factorial(len(names) - 1 - k)) for k in range(len(names))))
    share = F.col("n") * F.try_element_at(weights, size + 1)
    of = lambda name: F.col("of") == bit[name]
    per_filter = lambda what: F.array(*(F.coalesce(F.sum(F.when(of(n), what(n))), F.lit(0).cast("long")) for n in names))
    # at most 2**m + m * 2**(m - 1) entries for a part
    parts = every.groupBy("part").agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.col("of") * (full + 1) + F.col("before"), F.struct("n", "good", "toxic")))
        ).alias("_found"),
        per_filter(lambda n: F.when(F.col("before") == 0, F.col("n"))).alias("_failing"),
        per_filter(lambda n: F.when(F.col("before") == full - bit[n], F.col("n"))).alias("_unique"),
        per_filter(lambda n: share).alias("_shapley"),
    )
    orders = _orders(spark, bit)
    steps = F.sequence(F.lit(0), F.lit(len(names) * factorial(len(names)) - 1))
    grid = parts.withColumn("_k", F.explode(steps)).join(orders, "_k")
    at = lambda key, name: F.coalesce(F.try_element_at("_found", key)[name], F.lit(0).cast("long"))
    mine = F.col("_bit") * (full + 1) + F.col("_before")
    of_filter = lambda name: F.col(name)[F.col("_at")]
    return grid.select(
        "part", "filter_order", "step",
        at(F.col("_before") + F.col("_bit"), "n").alias("kept"),
        at(mine, "n").alias("removed"),
        (of_filter("_failing") - at(mine, "n")).alias("redundant"),
        of_filter("_unique").alias("unique_fails"),
        at(mine, "good").alias("good_lost"),
        at(mine, "toxic").alias("toxic_lost"),
        of_filter("_shapley").alias("shapley"),
    )


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """:func:`audit` of the filters of :func:`failing`, by ``part_col``.

    Every row of ``docs`` counts, those with a repeated or null id too. A row is good or
    toxic where any row of ``labels`` for its id says quality=1 or toxic=1; a null id has no
    label. An empty table has no part and no rows; other columns are ignored.
    """
    rows, tables = failing(docs, id_col, text_col, part_col)
    marks = labels.groupBy(F.col(id_col).alias("_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    marked = rows.join(marks, F.col("id") == F.col("_id"), "left").select("row", "part", *flags)
    return audit(settle(marked), tables)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents
), split as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
    min(doc_id) over (partition by text) as first_id
  from texts
), marks as (
  select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id
), failed as (
  select part,
    (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
      + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text))::int
      + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * coalesce(s.doc_id > first_id, false)::int as mask,
    coalesce(quality = 1, false)::int as good, coalesce(toxic = 1, false)::int as toxic
  from split s left join marks m on m.doc_id = s.doc_id
), counted as (
  select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from failed group by part, mask
), letters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as x
), orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps as (
  select filter_order, step, 1 << (ascii(filter_order[step]) - 65) as bit,
    list_sum([1 << (ascii(filter_order[k]) - 65) for k in range(1, 6) if k < step]) as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)
), stepped as (
  select part, filter_order, step, bit,
    sum(case when mask & (coalesce(before, 0)::int | bit) = 0 then n else 0 end) as kept,
    sum(case when mask & bit > 0 and mask & coalesce(before, 0)::int = 0 then n else 0 end) as removed,
    sum(case when mask & bit > 0 and mask & coalesce(before, 0)::int > 0 then n else 0 end) as redundant,
    sum(case when mask = bit then n else 0 end) as unique_fails,
    sum(case when mask & bit > 0 and mask & coalesce(before, 0)::int = 0 then good else 0 end) as good_lost,
    sum(case when mask & bit > 0 and mask & coalesce(before, 0)::int = 0 then toxic else 0 end) as toxic_lost
  from counted, steps group by part, filter_order, step, bit
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
  redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
  toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, bit))::bigint as shapley
from stepped
"""
