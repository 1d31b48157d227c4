"""Mixing sources to target weights by capped water-filling and seeded repetitions.

Every source is to get a share of all words in proportion to its weight, but at most ``max_epochs`` times its own
words. Water-filling clamps the sources that would go over and shares out the rest by weight, until none is above.
A source's target is then taken as whole repetitions of all its documents and one fractional repetition: its
documents in seeded hash order until the words are reached, the last one in part.

The hash order is never sorted as a whole: the first hex digits of the hash make cells, prefix sums over cells find
the one where the target falls, and only that cell's documents (one in 4,096 of the source) are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import salted_join, stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 17
# Hex digits of the hash that make a cell: 16^3 cells in a source.
CELL_DIGITS = 3
# A source table up to this many rows is broadcast; a longer one is joined by a salted shuffle.
BROADCAST_SOURCES = 100_000


def source_key(source: Column) -> Column:
    """A key without nulls that sorts by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def _numbered(table: DataFrame, key: str) -> DataFrame:
    """Add ``number`` (from 0, by ``key``) without one sort of everything: range partitions, then their offsets."""
    ordered = stored(table.orderBy(key).withColumn("part", F.spark_partition_id()), "sources")
    starts = ordered.groupBy("part").count()
    starts = starts.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(key)) - 1
    return ordered.withColumn("number", inside).join(starts, "part").withColumn("number", F.col("number") + F.col("start")).drop("part", "start")


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(key, source_size, target): one row per source of ``sized`` (needs key, size); weights repeat in key order."""
    totals = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    table = stored(_numbered(totals, "key").withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs), "targets")
    whole = table.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    words, level = float(whole["t"] or 0), 0.0
    if whole["w"]:
        level = words / whole["w"]
        while True:
            over = F.col("cap") <= F.lit(level) * F.col("weight")
            row = table.agg(F.sum(F.when(over, F.col("cap"))).alias("c"), F.sum(F.when(~over, F.col("weight"))).alias("w")).first()
            if not row["w"]:
                break
            higher = (words - float(row["c"] or 0)) / row["w"]
            if higher == level:
                break
            level = higher
    return table.select("key", "source_size", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def _order(seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"|{seed}")).cast("binary"))


def plan(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """(key, source_size, target, whole, cut, left): how often a source is repeated whole, and the cell and words where its last repetition ends.

    Sources whose last repetition is empty have no ``cut``.
    """
    shares = targets(sized, weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    shares = shares.withColumn("whole", whole)
    quota = F.floor(F.col("target") - F.col("whole") * F.col("source_size") + F.lit(0.5)).cast("long")
    shares = stored(shares.withColumn("quota", F.when(F.col("source_size") > 0, quota).otherwise(F.lit(0))), "shares")
    cells = sized.groupBy("key", F.substring(_order(seed), 1, CELL_DIGITS).alias("cell")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("key").orderBy("cell"))
    placed = cells.withColumn("upto", upto).join(shares.select("key", "quota"), "key")
    at = placed.where("quota > upto - words and quota <= upto").select("key", F.col("cell").alias("cut"), (F.col("quota") - F.col("upto") + F.col("words")).alias("left"))
    return shares.drop("quota").join(at, "key", "left")


def apply(docs: DataFrame, planned: DataFrame, seed: int = SEED) -> DataFrame:
    """Add source_size, target, whole (repetitions), part (words of the last repetition) and taken (all words) to ``docs`` (needs key, doc_id, size)."""
    planned = stored(planned, "plan")
    dealt = docs.withColumn("order__", _order(seed))
    if planned.count() <= BROADCAST_SOURCES:
        dealt = dealt.join(F.broadcast(planned), "key")
    else:
        dealt = salted_join(dealt, planned, ["key"], "inner")
    cell = F.substring("order__", 1, CELL_DIGITS)
    on_cut = F.coalesce(cell == F.col("cut"), F.lit(False))
    plain = dealt.where(~on_cut).withColumn("part", F.when(cell < F.col("cut"), F.col("size")).otherwise(F.lit(0).cast("long")))
    before = F.sum("size").over(Window.partitionBy("key").orderBy("order__", "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("left") - F.coalesce(before, F.lit(0))))
    cut = dealt.where(on_cut).withColumn("part", part)
    out = plain.unionByName(cut).withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))
    return out.drop("order__", "cut", "left")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id, text, source): doc_id, size, source_size, target, whole, part, taken.

    * Null text, or text without a word: size 0, taken 0.
    * Null source: a source of its own, last in the order of sources.
    * Null and repeated doc_ids: rows like any other; rows with one id stand together in the hash order.
    * A source without words has target 0. An empty table gives an empty table.
    """
    sized = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key(F.col("source").cast("string")).alias("key"), word_count(F.col("text").cast("string")).alias("size")),
        "sized",
    )
    return apply(sized, plan(sized, weights, max_epochs, seed), seed).select("doc_id", "size", "source_size", "target", "whole", "part", "taken")


def repeat(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as the mix takes it whole, and the first ``part`` words of a
    document that is taken in part. Documents without words are kept once, as they count for nothing."""
    columns = docs.columns
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row__"))
    key, text = source_key(F.col("row__.source").cast("string")), F.col("row__.text").cast("string")
    rows = named.select("row__", F.col("row__.doc_id").cast("long").alias("doc_id"), key.alias("key"), word_count(text).alias("size"))
    sized = stored(rows.select("doc_id", "key", "size"), "sized")
    taken = apply(rows, plan(sized, weights, max_epochs, seed), seed)
    full = F.col("whole") + F.when((F.col("part") == F.col("size")) & (F.col("size") > 0), 1).otherwise(0)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(full).cast("int")
    whole = taken.where(copies > 0).select(F.explode(F.array_repeat("row__", copies)).alias("row__")).select("row__.*")
    words = F.regexp_extract_all(F.col("row__.text"), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    cut_text = F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " ")
    some = taken.where("part > 0 and part < size").withColumn("text__", cut_text)
    new = {"text": F.col("text__"), "n_chars": F.length("text__").cast("long")}
    cut = some.select(*[(new[c] if c in new else F.col(f"row__.`{c}`")).alias(c) for c in columns])
    return whole.unionByName(cut)


#: The same in DuckDB: closed form of the water level, then running words in hash order.
SQL = f"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
    md5(concat(doc_id, '|{SEED}')) as ord
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as w
  from d group by source),
r as (
  select *, row_number() over (order by {MAX_EPOCHS} * source_size / w, source) as k from s),
p as (
  select *, coalesce(sum({MAX_EPOCHS} * source_size) over (order by k rows between unbounded preceding and 1 preceding), 0)::double as c,
    sum(w) over (order by k rows between current row and unbounded following) as rest,
    (select sum(source_size) from s)::double as t from r),
level as (
  select coalesce((select (t - c) / rest from p where {MAX_EPOCHS} * source_size > (t - c) / rest * w order by k limit 1), 1e300) as l),
q as (
  select source, source_size, least(({MAX_EPOCHS} * source_size)::double, l * w) as target from s, level),
h as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from q),
g as (
  select *, case when source_size > 0 then floor(target - whole * source_size + 0.5)::bigint else 0 end as quota from h),
x as (
  select d.doc_id, d.size, g.source_size, g.target, g.whole, g.quota,
    coalesce(sum(size) over (partition by d.source order by ord, doc_id rows between unbounded preceding and 1 preceding), 0) as before
  from d join g on d.source is not distinct from g.source)
select doc_id, size, source_size, target, (whole * size + greatest(0, least(size, quota - before)))::bigint as taken from x
"""
