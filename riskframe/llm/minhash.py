"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Texts become sets of five-word shingles. Two permutations make the whole signature: the first (a seeded
mixing function) places a shingle on a ring of 2^20 cells, the second (a random permutation table of the ring)
is read at that cell shifted by k for coordinate k. So a shingle's values for all coordinates are one contiguous
slice of the table, and a signature is the element-wise minimum of such slices.

Equal sets fall together first, by an exact group-by on a 128-bit digest of the whole set. Signatures of the
remaining distinct sets are cut into bands; sets that agree in a band share a bucket. No pairs of a bucket are listed:
leaders are compared with the members outside their component (see ``leaders``), first by the shingles that no other
candidate has, then by sketches of two bits per coordinate, and where both allow the link, on the full shingle sets.

Edits leave every copy with shingles of its own. Such private shingles are in no intersection and in every union, so their
number bounds the similarity of a set to any other, exactly: copies that differ too much from the rest are out before any
comparison, and two copies of one original are told apart from two numbers each. In a crowd (sets of large buckets) some edits
meet: a shingle in at most RARE sets of the crowd counts as private too. Pairs that have such a shingle in common, a few for
each, are listed by it and verified on their own, so the bound holds for all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import leaders
from riskframe.llm.common import salted_join, stored, worker_store
from riskframe.llm.textbytes import U, Words, blocks, mix, odd_constants, windows

SHINGLE = 5
BANDS = 32
ROWS = 5
RING_BITS = 20
# Coordinates of a sketch, two bits of each.
SKETCH = 768
# A pair whose sketches disagree by this many standard deviations more than at the threshold is not verified.
DEVIATIONS = 5.0
# A shingle in so many sets of a crowd at most is rare.
RARE = 8
# Lists of identifiers up to this size are broadcast; longer ones are joined by a shuffle.
BROADCAST_IDS = 500_000


def _slices(length: int, seed: int) -> np.ndarray:
    """Row s: the second permutation read from cell s on, round the ring, for ``length`` cells."""
    table = np.random.Generator(np.random.PCG64(seed)).permutation(1 << RING_BITS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[:length]]), length)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit shingle hashes: A-Z lower-cased, a text with fewer words is one shingle."""
    words = Words(data, offsets, lower=True)
    hashes = words.hash
    grams = windows(hashes, width, 1)
    for lo, hi in zip(words.first[:-1], words.first[1:], strict=True):
        if hi - lo >= width:
            yield np.unique(grams[lo : hi - width + 1])
        elif hi > lo:
            yield windows(hashes[lo:hi], int(hi - lo), 100 + int(hi - lo))
        else:
            yield np.zeros(0, U)


def signature(shingles: np.ndarray, length: int, seed: int = 7) -> np.ndarray:
    """Circulant MinHash coordinates of a non-empty set."""
    cells = (mix(shingles, seed) >> U(64 - RING_BITS)).astype(np.int64)
    table = worker_store("ring", (length, seed), lambda: _slices(length, seed))
    out = np.full(length, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(cells), 1024):
        np.minimum(out, table[cells[at : at + 1024]].min(axis=0), out=out)
    return out


def _sign(bands: int, rows: int, seed: int):
    """Task function: (doc_id, text) -> set size, 128-bit digest, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(1, bands + 1, dtype=U) * U(0xD6E8FEB86659FD93)
        consts = odd_constants(rows, 11)
        for batch in batches:
            sizes, d1, d2, keys = [], [], [], []
            for _, data, offsets in blocks(batch.column(1)):
                for s in shingle_sets(data, offsets):
                    sizes.append(len(s))
                    d1.append(mix(s, 21).sum(dtype=U))
                    d2.append(mix(s, 22).sum(dtype=U))
                    if len(s):
                        keys.append(mix((signature(s, bands * rows, seed).astype(U).reshape(bands, rows) * consts).sum(axis=1, dtype=U) + salt, 12))
            lists = np.zeros(len(sizes) + 1, np.int32)
            np.cumsum(np.where(np.array(sizes) > 0, bands, 0), out=lists[1:])
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.array(sizes, np.int64)),
                    pa.array(np.array(d1, U).view(np.int64)),
                    pa.array(np.array(d2, U).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(lists), pa.array(flat)),
                ],
                ["doc_id", "n_shingles", "d1", "d2", "bands"],
            )

    return run


def _sketch(seed: int):
    """Task function: (doc_id, text) -> doc_id, set size, digest, the set, and two bits of each of SKETCH coordinates, 32 in a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = U(2) * np.arange(32, dtype=U)
        for batch in batches:
            words, sets, sizes, d1, d2 = [], [], [], [], []
            for _, data, offsets in blocks(batch.column(1)):
                for s in shingle_sets(data, offsets):
                    sizes.append(len(s))
                    d1.append(mix(s, 21).sum(dtype=U))
                    d2.append(mix(s, 22).sum(dtype=U))
                    sets.append(s.view(np.int64))
                    values = signature(s, SKETCH, seed).astype(U) if len(s) else np.zeros(SKETCH, U)
                    words.append(((values & U(3)).reshape(-1, 32) << shifts).sum(axis=1, dtype=U).view(np.int64))
            flat = np.concatenate(words) if words else np.zeros(0, np.int64)
            lists = np.arange(len(words) + 1, dtype=np.int32) * (SKETCH // 32)
            ends = np.zeros(len(sizes) + 1, np.int32)
            np.cumsum(sizes, out=ends[1:])
            shingles = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
            digest = [pa.array(np.array(sizes, np.int64)), *[pa.array(np.array(d, U).view(np.int64)) for d in (d1, d2)]]
            lists = [pa.ListArray.from_arrays(pa.array(ends), shingles), pa.ListArray.from_arrays(pa.array(lists), pa.array(flat))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *digest, *lists], ["doc_id", "n_shingles", "d1", "d2", "shingles", "sketch"])

    return run


def _verify(percent: int):
    """Task function: (a, b, set_a, set_b) -> whether 100 * intersection >= percent * union of the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(*[(row.values.to_numpy() for row in batch.column(k)) for k in (2, 3)], strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keep, pa.bool_())], ["a", "b", "linked"])

    return run


def _only(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is in ``ids`` (one column); the list is broadcast only after it was counted."""
    ids = stored(ids.select(F.col(ids.columns[0]).alias("doc_id")).distinct(), name)
    small = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")


def near_duplicates(
    docs: DataFrame, percent: int = 85, bands: int = BANDS, rows: int = ROWS, seed: int = 7
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (needs doc_id, text; other columns are ignored).

    Two documents are linked when their sets' Jaccard similarity is at least ``percent`` / 100. ``component_id`` is
    the smallest doc_id reachable over links, ``kept`` marks that document.

    * Null or blank text: no shingles, linked with nothing, its own component.
    * Null doc_id: the row stays, with null component and ``kept`` true; it links with nothing.
    * Rows that repeat a doc_id are one node: what any of them links to, all are joined with.
    * A pair at the threshold shares no band with probability (1 - 0.85^rows)^bands, 7e-9 with the defaults, and its
      sketches differ too much for verification with probability 3e-7 (five standard deviations).
    * An empty table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(
        docs.mapInArrow(_sign(bands, rows, seed), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"), "signed"
    )
    usable = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    digest = ["n_shingles", "d1", "d2"]
    # each distinct set is a node with a number of its own, whatever ids its rows have
    sets = usable.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    sets = stored(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    # one row per document row: its set and the smallest document with the same set
    copied = salted_join(usable.select("doc_id", *digest), sets.where("rep < last").select(*digest, "rep", "node"), digest)
    alone = sets.where("rep = last").select(F.col("rep").alias("doc_id"), *digest, F.col("node").alias("own"))
    of_class = stored(
        copied.join(alone, ["doc_id", *digest], "left").select(
            "doc_id", F.coalesce("node", "own").alias("node"), F.coalesce("rep", "doc_id").alias("rep"), *digest
        ),
        "classes",
    )
    leads = sets.select(F.col("rep").alias("doc_id"), *digest, "node")
    bucketed = usable.join(leads, ["doc_id", *digest]).dropDuplicates(["doc_id", *digest]).select(
        F.col("node").alias("rep"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket")
    )
    members = leaders.shared_buckets(bucketed)

    # the sets of rows that repeat an id join
    joined = of_class.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    repeated = of_class.join(joined.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b")).distinct()
    group = leaders.merge(None, stored(repeated, "repeated"))
    if not members.limit(1).count():
        return _labelled(signed, of_class, group)

    schema = "doc_id long, n_shingles long, d1 long, d2 long, shingles array<long>, sketch array<long>"
    wanted = leads.join(members.select(F.col("rep").alias("node")).distinct(), "node", "left_semi")
    full = _only(docs, wanted.select("doc_id"), "wanted").select("doc_id", "text").mapInArrow(_sketch(seed), schema)
    full = full.join(wanted, ["doc_id", *digest]).dropDuplicates(["doc_id", *digest])
    full = stored(full.select("node", F.col("n_shingles").alias("n"), "shingles", "sketch"), "full")
    hopeful = full.join(private_shingles(full), "node", "left").withColumn("private", F.coalesce("private", F.lit(0)))
    hopeful = hopeful.where(100 * (F.col("n") - F.col("private")) >= percent * F.col("n"))
    hopeful = hopeful.select(F.col("node").alias("rep"), "private")
    in_crowd = stored(members.where(F.col("size") > leaders.LARGE_BUCKET).select(F.col("rep").alias("node")).distinct(), "crowd")
    n_crowd = in_crowd.count()
    kin = None
    if n_crowd:
        crowd = full.join(F.broadcast(in_crowd) if n_crowd <= BROADCAST_IDS else in_crowd, "node", "left_semi")
        rare = rare_shingles(crowd)
        kin = rare_pairs(rare, percent)
        counts = rare.groupBy("node").agg(F.count(F.lit(1)).alias("rare"))
        common = crowd.select("node", "n").join(counts, "node", "left").select(F.col("node").alias("rep"), (F.col("n") - F.coalesce("rare", F.lit(0))).alias("common"))
        members = members.join(hopeful, "rep").join(common, "rep", "left")
        # in a large bucket all belong to the crowd
        members = members.where((F.col("size") <= leaders.LARGE_BUCKET) | (100 * F.col("common") >= percent * F.col("n")))
    else:
        members = members.join(hopeful, "rep").withColumn("common", F.lit(None).cast("long"))
    members = stored(members, "hopeful")

    def verify(pairs: DataFrame) -> DataFrame:
        # the sketch of a set is looked up once per pair of sets, not carried in each of its buckets
        lead = full.select(F.col("node").alias("b"), F.col("sketch").alias("lead_sketch"))
        near = pairs.join(lead, "b").join(full.select(F.col("node").alias("a"), "sketch"), "a")
        near = near.where(_close(percent)).select("a", "b")
        side = full.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
        other = full.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
        both = near.join(other, "b").join(side, "a").select("a", "b", "set_a", "set_b")
        return both.mapInArrow(_verify(percent), "a long, b long, linked boolean").where("linked").select("a", "b")

    group = leaders.grow(members, group, signed.count(), ["n", "private", "common"], _may_link(percent), verify, kin)
    return _labelled(signed, of_class, group)


def private_shingles(full: DataFrame) -> DataFrame:
    """(node, private): how many shingles of a set are in no other set of ``full`` (node, shingles); sets without any are left out."""
    each = full.select("node", F.explode("shingles").alias("shingle"))
    holders = each.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    return holders.where("node = last").groupBy("node").agg(F.count(F.lit(1)).alias("private"))


def rare_shingles(crowd: DataFrame) -> DataFrame:
    """(node, n, shingle): the shingles of each set of ``crowd`` (node, n, shingles) that at most RARE of its sets have."""
    each = crowd.select("node", "n", F.explode("shingles").alias("shingle"))
    frequent = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") > RARE).select("shingle")
    return stored(salted_join(each, frequent, ["shingle"], "left_anti").select("node", "n", "shingle"), "rare")


def rare_pairs(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets with a rare shingle in common, where the numbers of common rare and of other shingles allow the threshold."""
    together = rare.groupBy("shingle").agg(F.collect_list("node").alias("nodes")).where(F.size("nodes") > 1)
    pairs = together.select(F.explode("nodes").alias("a"), "nodes").select("a", F.explode("nodes").alias("b")).where("a < b")
    pairs = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("both"))
    facts = rare.groupBy("node", "n").agg(F.count(F.lit(1)).alias("rare"))
    pairs = pairs.join(facts.toDF("a", "n_a", "rare_a"), "a").join(facts.toDF("b", "n_b", "rare_b"), "b")
    shared = F.col("both") + F.least(F.col("n_a") - F.col("rare_a"), F.col("n_b") - F.col("rare_b"))
    return pairs.where(100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")


def _may_link(percent: int) -> Column:
    """Whether sizes and private shingles of two sets allow the threshold: the intersection has none of them, the union has all.

    For two sets of the crowd that is so with their rare shingles too, unless ``rare_pairs`` has the pair.
    """
    # null, which ``least`` skips, unless both are of the crowd
    common = F.when(F.col("common") < F.col("lead_common"), F.col("common")).when(F.col("lead_common").isNotNull() & F.col("common").isNotNull(), F.col("lead_common"))
    shared = F.least(F.col("n") - F.col("private"), F.col("lead_n") - F.col("lead_private"), common)
    return 100 * shared >= percent * (F.col("n") + F.col("lead_n") - shared)


def _close(percent: int) -> Column:
    """Whether two sketches disagree in few enough coordinates for the threshold."""
    j = percent / 100
    miss = (1 - j) * 3 / 4
    most = math.floor(SKETCH * miss + DEVIATIONS * math.sqrt(SKETCH * miss * (1 - miss)))
    odd = F.lit(0x5555555555555555).cast("long")
    differ = F.lit(0)
    for k in range(SKETCH // 32):
        x = F.get("sketch", F.lit(k)).bitwiseXOR(F.get("lead_sketch", F.lit(k)))
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(odd))
    return differ <= most


def _labelled(signed: DataFrame, of_class: DataFrame, group: DataFrame) -> DataFrame:
    """Every document row with the label of its class; the smallest document of a group carries its name."""
    reps = salted_join(of_class.select("doc_id", "node"), group.toDF("node", "label"), ["node"])
    reps = reps.select("doc_id", F.coalesce("label", "node").alias("label"))
    names = reps.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    reps = salted_join(reps, names, ["label"])
    reps = reps.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(reps, "doc_id", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """All columns of ``docs`` for the one document of each group that stays; of rows with equal doc_id one stays.

    Rows without doc_id and documents without words all stay.
    """
    found = near_duplicates(docs, percent)
    lost = found.where(~F.col("kept")).select("doc_id").distinct()
    kept = docs.join(lost, "doc_id", "left_anti")
    plain = kept.where(F.col("doc_id").isNull())
    return kept.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"]).unionByName(plain)
