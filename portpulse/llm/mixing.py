"""Mixing sources to target weights by repeating documents.

Sizes are summed per source, a level of words per weight is raised until the targets use up
the wanted total, and target over size is a source's repetition rate. Each document is
taken floor(rate) times, and once more where a draw from its hash falls below the
fraction. There are several draws per document, each with its own bits of one SHA-256;
every source uses the one among them whose total comes nearest its target. Draws depend
on a row's contents alone, so that reruns agree however the table is partitioned.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portpulse.functions.scale import numbered_within, settle
from portpulse.llm.common import table

SPACE = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"
#: Draws of a document: as many as SHA-256 has groups of 32 bits.
DRAWS = 8
#: Rows of one source that a task of the join is meant to have at most.
SHARE = 1_000_000


def n_words(text: Column) -> Column:
    """Number of maximal runs outside white space; 0 for null."""
    inner = F.btrim(text, F.lit(_BLANKS))
    return F.when(F.coalesce(inner, F.lit("")) == "", 0).otherwise(F.size(F.split(inner, SPACE))).cast("long")


def _numbered_repeats(rows: DataFrame) -> DataFrame:
    """``nth`` (from 0) tells rows apart that agree in ``key``; usually all are 0.

    Repeated keys are cut into ranges of rows, numbered inside them and shifted by the rows
    of the ranges before, so a key with any share of the rows is spread.
    """
    often = settle(rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    if often.isEmpty():
        return rows.withColumn("nth", F.lit(0).cast("long"))
    order = ["key", "whole", "row"]
    cut = settle(
        rows.join(often, "key", "left_semi").select(*order).repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    )
    before = Window.partitionBy("key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("key", "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("key", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    nth = F.row_number().over(Window.partitionBy("key", "_range").orderBy("whole", "row")) - 1 + F.col("_before")
    numbers = cut.join(offsets, ["key", "_range"]).select("row", nth.alias("nth"))
    return rows.join(numbers, "row", "left").withColumn("nth", F.coalesce("nth", F.lit(0).cast("long")))


def targets(sizes: DataFrame, weights: tuple[int, ...], total: float, most: float) -> DataFrame:
    """Adds ``weight`` and ``target`` to one row per ``source`` with ``source_size``.

    Sources in code point order, null last, have the weights in turn. They share ``total``
    times all sizes by weight; a target stops at ``most`` times its source's size, and what is
    beyond goes to the others by weight, until none is above. That level is unique, so the
    rounds below (three sums each; a source that has stopped stays) end at it.
    """
    known = numbered_within(sizes.where("source is not null"), [], "source", "_nth")
    last = known.count() + 1
    listed = F.array(*(F.lit(w) for w in weights))
    place = F.pmod(F.coalesce("_nth", F.lit(last)) - 1, F.lit(len(weights))).cast("int")
    weighted = settle(
        sizes.join(known, "source", "left").select(sizes.columns[0], *sizes.columns[1:], listed[place].alias("weight"))
    )
    top = most * F.col("source_size")
    wanted = total * (weighted.agg(F.sum("source_size")).first()[0] or 0)
    level, target = None, top
    while True:
        stopped = F.lit(False) if level is None else F.col("weight") * level[0] / level[1] >= top
        spent, free = weighted.agg(
            F.coalesce(F.sum(F.when(stopped, top)), F.lit(0.0)), F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0))
        ).first()
        if not free or (now := (wanted - spent, free)) == level:
            return weighted.withColumn("target", target)
        level = now
        target = F.least(top, F.col("weight") * F.lit(level[0]) / F.lit(level[1]))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    total: float = 1.5,
    most: int = 2,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: id, the columns ``keep``, ``size``, ``source_size``, ``target``,
    ``times`` (how often the mix has it) and ``taken`` (times * size).

    Size is the number of words; a null text has none. A null source is a source of its own,
    apart from the empty one. Rows with one id are documents of their own; rows that agree
    in id, source and text are numbered, so that they are drawn apart. No document is
    taken more than ``most`` times. Documents of a source without words are taken 0 times
    if the rate is undefined. An empty table gives an empty result; columns that are not
    named are ignored. ``keep`` is for :func:`emitted`; its columns must not have names of the result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = F.col(source_col).cast("string")
    rows = settle(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("_id"),
            source.alias("source"),
            n_words(F.col(text_col)).alias("size"),
            F.sha2(
                F.concat_ws(" ", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.sha2(text, 256), source), 256
            ).alias("key"),
            F.xxhash64(*docs.columns).alias("whole"),
            *(F.col(c).alias(f"_keep_{c}") for c in keep),
        )
    )
    counted = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    shared = targets(counted, weights, total, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shared = settle(shared.select("*", F.floor(rate).alias("whole_times"), (rate - F.floor(rate)).alias("fraction")))

    # a source with many rows meets as many copies of its line
    parts = max(1, min(1_000, -(-(shared.agg(F.max("n")).first()[0] or 0) // SHARE)))
    part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    numbered = _numbered_repeats(rows).withColumn("_part", part)
    bits = F.sha2(F.concat_ws(" ", F.col("key"), F.col("nth")), 256)
    drawn = numbered.withColumn("_bits", bits)
    falls = lambda j: F.conv(F.substring("_bits", 8 * j + 1, 8), 16, 10).cast("double") / 2**32 < F.col("fraction")
    line = shared.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumnRenamed("source", "_source")
    joined = drawn.join(line, F.col("source").eqNullSafe(F.col("_source")) & (drawn["_part"] == line["_part"])).drop(line["_part"])

    sums = [F.sum(F.when(falls(j), F.col("size")).otherwise(0)).alias(f"_{j}") for j in range(DRAWS)]
    tried = (
        joined.groupBy("_source", "_part").agg(*sums).groupBy("_source").agg(*(F.sum(f"_{j}").alias(f"_{j}") for j in range(DRAWS)))
    )
    off = lambda j: F.abs(F.col("whole_times") * F.col("source_size") + F.col(f"_{j}") - F.col("target"))
    chosen = settle(
        shared.join(tried, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            *shared.columns,
            F.array_min(F.array(*(F.struct(off(j).alias("off"), F.lit(j).alias("draw")) for j in range(DRAWS))))["draw"].alias("draw"),
        )
    )
    line = chosen.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumnRenamed("source", "_source")
    joined = drawn.join(line, F.col("source").eqNullSafe(F.col("_source")) & (drawn["_part"] == line["_part"]))
    own = F.conv(F.substring(F.col("_bits"), 8 * F.col("draw") + 1, F.lit(8)), 16, 10).cast("double") / 2**32
    times = (F.col("whole_times") + (own < F.col("fraction")).cast("long")).cast("long")
    return joined.select(
        F.col("_id").alias(id_col),
        *(F.col(f"_keep_{c}").alias(c) for c in keep),
        "size",
        "source_size",
        "target",
        times.alias("times"),
        (times * F.col("size")).alias("taken"),
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """Each document of a mix as often as it is taken, numbered by ``copy`` from 1."""
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return mixed.where("times > 0").withColumn("copy", copies).drop("times", "taken")


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP13_SQL = r"""
with docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    sha256(concat_ws(' ', coalesce(doc_id::varchar, 'null'), sha256(coalesce(text, '')), source)) as key
  from documents
), numbered as (
  select *, sha256(key || ' ' || (row_number() over (partition by key) - 1)) as bits from docs
), sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by encode(source) nulls last) - 1 as nth
  from docs group by source
), weighted as (
  select *, [5, 2, 1][nth % 3 + 1] as weight from sources
), running as (
  select sum(source_size) over low as size_to, sum(weight) over low as weight_to
  from weighted window low as (order by 2.0::double * source_size / weight, source rows unbounded preceding)
), level as (
  select max_by(a, a / b) as a, max_by(b, a / b) as b
  from (
    select 1.5::double * (select sum(source_size) from weighted) - 2.0::double * size_to as a,
      (select sum(weight) from weighted) - weight_to as b
    from (select size_to, weight_to from running union all select 0, 0)
  ) where b > 0
), shared as (
  select source, source_size, least(2.0::double * source_size, weight * a / b) as target from weighted, level
), rated as (
  select *, case when source_size > 0 then target / source_size else 0.0 end as rate from shared
), drawn as (
  select n.*, source_size, target, rate, unnest([0, 1, 2, 3, 4, 5, 6, 7]) as draw
  from numbered n join rated r on n.source is not distinct from r.source
), fallen as (
  select *, (('0x' || substr(bits, 8 * draw + 1, 8))::bigint / 4294967296.0::double < rate - floor(rate))::bigint as falls
  from drawn
), tried as (
  select source, draw, abs(floor(any_value(rate)) * any_value(source_size) + sum(falls * size) - any_value(target)) as off_by
  from fallen group by source, draw
), chosen as (
  select source, draw from tried qualify row_number() over (partition by source order by off_by, draw) = 1
)
select doc_id, size, source_size, target, ((floor(rate)::bigint + falls) * size)::bigint as taken
from fallen f join chosen c on f.source is not distinct from c.source and f.draw = c.draw
"""
