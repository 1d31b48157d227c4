"""Components of similar rows from buckets, without listing the pairs of a bucket.

A bucket holds rows that may be similar. In each round some members of a bucket lead: they are compared with the
members that are not yet in their component, and then leave the bucket. Rounds go on until no bucket holds two
components, so every pair that shares a bucket is in one component in the end or was compared. A round starts with
one leader per bucket, the member that shares buckets with most others, since copies differ less from their original
than from each other; then leaders grow by a factor as long as a round's comparisons stay in proportion to the table.

Copies share many buckets, and one comparison settles them all. So the first rounds see a part of the buckets only,
dealt by a hash; what they join has left the others before their turn comes. All buckets take part in the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import salted_join, stored
from riskframe.llm.components import components

# Comparisons that one round may make in the bucket join, for each row of the table.
COMPARED_PER_ROW = 512
# Leaders of a bucket grow by this factor from round to round, and are so many in one round at most (powers of two).
GROWTH = 16
MOST_LEADERS = 1 << 20
# One bucket in so many takes part from the first, second, ... round on; a few members are compared in all at once.
TURNS = (16, 4, 1)
FEW_MEMBERS = 100_000
# Buckets with more members are spread over SALTS tasks; the rows looked up for the others are not copied.
LARGE_BUCKET = 100
SALTS = 16


def shared_buckets(bucketed: DataFrame) -> DataFrame:
    """(``bucketed`` columns, size, weight): rows (rep, bucket, ...) of buckets with two members at least; weight counts the shared places."""
    sizes = bucketed.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count(F.lit(1)).alias("size"))
    members = stored(salted_join(bucketed, sizes.where("low < high").select("bucket", "size"), ["bucket"], "inner"), "shared")
    weight = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    return stored(members.join(weight, "rep"), "members")


def merge(group: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, label) after ``links`` (a, b) have joined the components of ``group``."""
    if not links.limit(1).count():
        return links.select(F.col("a").alias("node"), F.col("b").alias("label")).limit(0) if group is None else group
    if group is None:
        return components(links)
    named = links.join(group.toDF("a", "la"), "a", "left").join(group.toDF("b", "lb"), "b", "left")
    merged = components(named.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    renamed = group.join(merged.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return stored(renamed.union(merged.join(group.select("node"), "node", "left_anti")), "groups")


def _in_bucket(members: DataFrame, table: DataFrame, how: str) -> DataFrame:
    """Join of ``members`` to ``table`` on the bucket and its size; a large bucket's rows of ``table`` are copied once per salt."""
    salts = F.when(F.col("size") > LARGE_BUCKET, SALTS).otherwise(1)
    dealt = members.withColumn("__salt", F.pmod(F.xxhash64("rep"), salts).cast("int"))
    copies = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.join(copies, ["bucket", "size", "__salt"], how).drop("__salt")


def grow(
    members: DataFrame, group: DataFrame, rows: int, facts: list[str], possible: Column,
    verify: Callable[[DataFrame], DataFrame], more: DataFrame | None = None,
) -> DataFrame:
    """``group`` (node, label) after all links of ``members`` (rep, bucket, size, weight, facts...) have joined it.

    ``possible`` is a condition on a member's ``facts`` and its leader's ``lead_<fact>``; ``verify`` leaves
    the linked ones of pairs (a, b). ``more``: pairs (a, b), a < b, to verify whatever their buckets. ``rows`` is the size of
    the table that the budget of a round follows.
    """
    budget = COMPARED_PER_ROW * rows
    turns = TURNS if members.count() > FEW_MEMBERS else TURNS[-1:]
    place = F.pmod(F.xxhash64("bucket"), F.lit(TURNS[0]))
    checked = None
    live = members.limit(0)
    slots, turn, begun = 1, 0, 0
    while True:
        if turn < len(turns):
            share = TURNS[0] // turns[turn]
            live = live.unionByName(members.where((place >= begun) & (place < share)))
            turn, begun = turn + 1, share
        tagged = live.join(group.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("label", "rep")).drop("label")
        open_ = tagged.groupBy("bucket", "size").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("now"))
        open_ = open_.where("low < high").select("bucket", "size", "now")
        tagged = stored(_in_bucket(tagged, open_, "inner"), "open")
        # comparisons of a round with so many leaders a bucket
        choices = [1 << k for k in range(slots.bit_length())]
        compared = tagged.agg(*[F.sum(F.least("now", F.lit(k))) for k in choices]).first()
        if not compared[0]:
            if turn == len(turns):
                return group if more is None else merge(group, stored(verify(more), "verified"))
            live = tagged.drop("comp", "now")
            continue
        slots = max([1, *[k for k, n in zip(choices, compared) if n <= budget]])
        slot = F.pmod(F.xxhash64("rep", F.lit(slots)), F.lit(slots)) if slots > 1 else F.lit(0)
        first = F.max(F.struct("weight", (-F.col("rep")).alias("minus"), "comp", *facts)).alias("lead")
        chosen = tagged.groupBy("bucket", "size", slot.alias("slot")).agg(first)
        chosen = chosen.select("bucket", "size", (-F.col("lead.minus")).alias("lead_rep"), F.col("lead.comp").alias("lead_comp"), *[F.col(f"lead.{f}").alias(f"lead_{f}") for f in facts])
        chosen = stored(chosen, "leaders")
        pairs = _in_bucket(tagged, chosen, "inner").where(F.col("comp") != F.col("lead_comp")).where(possible)
        pairs = pairs.select(F.least("rep", "lead_rep").alias("a"), F.greatest("rep", "lead_rep").alias("b")).distinct()
        if more is not None:
            pairs, more = pairs.union(more).distinct(), None
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if pairs.limit(1).count():
            checked = pairs if checked is None else checked.union(pairs)
            group = merge(group, stored(verify(pairs), "verified"))
        leading = chosen.select("bucket", F.col("lead_rep").alias("rep"))
        live = tagged.drop("comp", "now").join(leading, ["bucket", "rep"], "left_anti")
        if turn == len(turns):
            slots = min(slots * GROWTH, MOST_LEADERS)
