"""Merkle manifest of a dataset, with Octopus multiproofs for many rows at once.

Every row is a leaf. The leaves of a source, in the order of their id, make a tree of arity 3 whose top is the source's
subroot; the subroots, in the order of their sources, make one more tree of the same kind whose top is the root. A node
is named by (tree, level, idx): ``tree`` is the rank of the source, ``TOP`` the tree over the subroots.

``manifest`` hashes each row once, ranks leaves by a range exchange of (source, id, digest) with running totals over the
partitions, so no source is ever sorted in one task, and folds ``TILE_LEVELS`` levels of a tree per round: an aligned
tile of 3^7 nodes is the unit of work, a hot source is many tiles. ``proofs`` makes the proofs of any set of leaves by
the Octopus way: leaves are dealt in blocks of neighbours; a block first computes the smallest set of node coordinates
that its proofs need and that cannot be had from its own leaves, fetches them once by a join, derives the interior
nodes that its leaves share, and expands every single proof from what it now holds. A node is asked for at most once a
block, so the busiest node of all meets one row per ``BLOCK`` leaves.

Digests are lowercase hex and enter further hashes as that text. A null field is ``-``. Equal rows are leaves of their
own side by side (their order among themselves does not matter, they are alike), rows that share an id but differ are
ordered by digest; null ids come first. An empty table has an empty manifest. Only the five fields are read.
All tables between the steps are stored in the shared folder, so a lost executor costs tasks and not the ranking.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
TILE_LEVELS = 7
BLOCK = 4096
TOP = -1
NODE_SCHEMA = "tree long, level int, idx long, n long, digest string"


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves: none for a lone leaf."""
    levels = 0
    while n > 1:
        n = -(-n // ARITY)
        levels += 1
    return levels


def leaf(values: Sequence[Column]) -> Column:
    """Hash of the fields in order: ``-`` for null, else byte count, colon and value."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


@dataclass
class Manifest:
    """``leaves``: one row per leaf with its place (tree, idx, n, at) and the columns kept by the caller; ``nodes``: every
    node of every tree, leaves included; ``sources``: number of sources."""

    leaves: DataFrame
    nodes: DataFrame
    sources: int


def _ranked(leaves: DataFrame) -> tuple[DataFrame, int]:
    """Leaves with ``tree`` (rank of the source), ``idx`` (place in it), ``n`` (its leaves) and ``at`` (place among all).

    Rows are dealt by range of (source, doc_id, leaf); what is added up afterwards has one row per partition and source.
    """
    dealt = leaves.repartitionByRange(F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "leaf")
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), "leaves")
    runs = dealt.groupBy("part", "source").agg(F.count(F.lit(1)).alias("rows"))
    runs = stored(runs, "runs")
    spans = runs.groupBy(F.col("source").alias("of")).agg(F.min("part").alias("first_part"), F.sum("rows").alias("n"))
    runs = runs.join(spans, F.col("source").eqNullSafe(F.col("of"))).select(
        "part", "source", "rows", "n", (F.col("part") == F.col("first_part")).cast("long").alias("opens")
    )
    # Totals of the partitions before (one row a partition), then running totals inside a partition.
    totals = runs.groupBy("part").agg(F.sum("rows").alias("part_rows"), F.sum("opens").alias("part_opens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "part",
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("part_opens").over(before), F.lit(0)).alias("opens_before"),
    )
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_first())
    runs = runs.join(totals, "part").select(
        "part", "source", "n", "opens",
        (F.col("rows_before") + F.sum("rows").over(inside) - F.col("rows")).alias("start"),
        (F.col("opens_before") + F.sum("opens").over(inside) - 1).alias("tree"),
    )
    runs = stored(runs, "ranks")
    origin = runs.where("opens = 1").select("tree", F.col("start").alias("origin"))
    runs = runs.join(origin, "tree").select(
        F.col("part").alias("run_part"), F.col("source").alias("run_source"), "n", "tree", "start", "origin"
    )
    here = Window.partitionBy("part", "source").orderBy(F.col("doc_id").asc_nulls_first(), "leaf")
    placed = dealt.withColumn("step", F.row_number().over(here) - 1)
    on = (F.col("part") == F.col("run_part")) & F.col("source").eqNullSafe(F.col("run_source"))
    kept = [c for c in leaves.columns if c != "source"]
    placed = placed.join(runs, on).select(
        *kept, "source", "tree", (F.col("start") - F.col("origin") + F.col("step")).alias("idx"), "n", (F.col("start") + F.col("step")).alias("at")
    )
    return stored(placed, "placed"), origin.count()


def _fold_sorted(tree: np.ndarray, idx: np.ndarray, n: np.ndarray, digest: list[bytes], level: int) -> Iterator[tuple]:
    """Levels above a sorted run of whole tiles, each as (tree, level, idx, n, digests)."""
    for up in range(TILE_LEVELS):
        rows_left = -(-n // ARITY ** (level + up))
        keep = rows_left > 1
        if not keep.any():
            return
        if not keep.all():
            digest = [d for d, k in zip(digest, keep) if k]
            tree, idx, n = tree[keep], idx[keep], n[keep]
        parent = idx // ARITY
        change = np.flatnonzero((parent[1:] != parent[:-1]) | (tree[1:] != tree[:-1])) + 1
        first = np.concatenate([[0], change])
        last = np.concatenate([change, [len(parent)]])
        digest = [sha256(b"".join(digest[a:b])).hexdigest().encode() for a, b in zip(first.tolist(), last.tolist())]
        tree, idx, n = tree[first], parent[first], n[first]
        yield tree, level + up + 1, idx, n, digest


def _fold_tiles(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes up to ``TILE_LEVELS`` above ``nodes``, which all lie on ``level``."""
    width = ARITY**TILE_LEVELS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []

        def folded(rows: pd.DataFrame) -> Iterator[pa.RecordBatch]:
            columns = [rows[c].to_numpy(np.int64) for c in ("tree", "idx", "n")]
            for tree, at, idx, n, digest in _fold_sorted(*columns, [d.encode() for d in rows["digest"]], level):
                arrays = [tree, np.full(len(tree), at, np.int32), idx, n]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, arrays), pa.array([d.decode() for d in digest], pa.string())], names=["tree", "level", "idx", "n", "digest"]
                )

        for batch in batches:
            rows = batch.to_pandas()
            if not len(rows):
                continue
            held.append(rows)
            rows = pd.concat(held, ignore_index=True) if len(held) > 1 else rows
            # The last tile may go on in the next batch; a tile has at most 3^7 rows.
            tile = (rows["tree"] == rows["tree"].iat[-1]) & (rows["idx"] // width == rows["idx"].iat[-1] // width)
            cut = len(rows) - int(tile.sum())
            held = [rows.iloc[cut:]]
            if cut:
                yield from folded(rows.iloc[:cut])
        if held:
            yield from folded(pd.concat(held, ignore_index=True))

    tile = F.floor(F.col("idx") / width)
    dealt = nodes.select("tree", "idx", "n", "digest").repartition("tree", tile).sortWithinPartitions("tree", "idx")
    return dealt.mapInArrow(run, NODE_SCHEMA)


def _tree(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all interior nodes, tops) of the trees over ``base`` (tree, idx, n, digest); tops are (tree, digest)."""
    level, parts = 0, []
    tallest = base.agg(F.max("n")).first()[0] or 0
    last = base
    tops = base.where("n = 1").select("tree", "digest")
    while level < height(tallest):
        made = stored(_fold_tiles(last, level), "nodes")
        level += TILE_LEVELS
        parts.append(made)
        last = made.where(F.col("level") == level)
    interior = parts[0] if parts else None
    for part in parts[1:]:
        interior = interior.unionByName(part)
    if interior is None:
        interior = base.sparkSession.createDataFrame([], NODE_SCHEMA)
    else:
        # The top is the only node with nothing beside it: its level holds one node of the tree and the level below more.
        one_left = F.ceil(F.col("n") / F.pow(F.lit(float(ARITY)), F.col("level"))) == 1
        tops = tops.unionByName(interior.where(one_left & (F.col("idx") == 0)).select("tree", "digest"))
    return interior, tops


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None) -> Manifest:
    """Leaves, nodes and sources of a table with the five fields. ``carried`` adds columns to the leaves."""
    extra = [c.alias(name) for name, c in (carried or {}).items()]
    fields = docs.select(*FIELDS)
    rows = fields.select("doc_id", F.col("source").cast("string").alias("source"), leaf([F.col(c) for c in FIELDS]).alias("leaf"), *extra)
    leaves, sources = _ranked(stored(rows, "hashed"))
    base = leaves.select("tree", "idx", "n", F.col("leaf").alias("digest"))
    inner, subroots = _tree(base)
    top = stored(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(sources).cast("long").alias("n"), "digest"), "subroots")
    upper, _ = _tree(top)
    on_level = lambda df: df.select("tree", F.lit(0).alias("level"), "idx", "n", "digest")
    nodes = on_level(base).unionByName(inner).unionByName(on_level(top)).unionByName(upper)
    return Manifest(leaves, nodes, sources)


def _known_levels(idx: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(level, indices known there, their missing siblings) from the leaves up to below the top of a tree of n leaves."""
    known, level = np.unique(idx), 0
    while n > 1:
        above = np.unique(known // ARITY)
        run = (above[:, None] * ARITY + np.arange(ARITY)).ravel()
        run = run[run < n]
        yield level, known, np.setdiff1d(run, known, assume_unique=True)
        known, n, level = above, -(-n // ARITY), level + 1


def missing(tree: np.ndarray, idx: np.ndarray, n: np.ndarray, sources: int) -> np.ndarray:
    """Smallest set of (tree, level, idx) that proves the given leaves up to the root and does not follow from them."""
    out = []
    order = np.lexsort((idx, tree))
    tree, idx, n = tree[order], idx[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]])) if len(tree) else np.zeros(0, int)
    ends = np.append(starts[1:], len(tree))
    groups = [(int(tree[a]), idx[a:b], int(n[a])) for a, b in zip(starts, ends)]
    if groups:
        groups.append((TOP, tree[starts], sources))
    for name, places, size in groups:
        for level, _, gap in _known_levels(places, size):
            out.extend((name, level, int(i)) for i in gap)
    return np.array(out, np.int64).reshape(-1, 3)


def _derive(held: dict[tuple[int, int], dict[int, bytes]], name: int, idx: np.ndarray, n: int) -> bytes:
    """Fill in the interior nodes over the known leaves of one tree; the digest of its top."""
    known, level = np.unique(idx).tolist(), 0
    while n > 1:
        have = held[name, level]
        above = sorted({i // ARITY for i in known})
        made = held.setdefault((name, level + 1), {})
        for up in above:
            made[up] = sha256(b"".join(have[i] for i in range(up * ARITY, min((up + 1) * ARITY, n)))).hexdigest().encode()
        known, n, level = above, -(-n // ARITY), level + 1
    return held[name, level][known[0]]


def _siblings(held: dict[tuple[int, int], dict[int, bytes]], name: int, idx: int, n: int) -> Iterator[bytes]:
    level = 0
    while n > 1:
        have, start = held[name, level], idx - idx % ARITY
        for i in range(start, min(start + ARITY, n)):
            if i != idx:
                yield have[i]
        idx, n, level = idx // ARITY, -(-n // ARITY), level + 1


def proofs(made: Manifest, asked: DataFrame | None = None) -> DataFrame:
    """The asked leaves (rows of ``made.leaves``; all by default) with subroot, root and ``proof``.

    ``proof`` lists the siblings level by level from the leaf to the root, left to right.
    """
    sources = made.sources
    rows = (made.leaves if asked is None else asked).withColumn("block", F.floor(F.col("at") / BLOCK))

    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        gaps = missing(*[table[c].to_numpy() for c in ("tree", "idx", "n")], sources)
        names = ["block", "tree", "level", "idx"]
        arrays = [np.full(len(gaps), key[0].as_py(), np.int64), gaps[:, 0], gaps[:, 1].astype(np.int32), gaps[:, 2]]
        return pa.table(arrays, names=names)

    places = rows.select("block", "tree", "idx", "n")
    wanted = stored(places.groupBy("block").applyInArrow(ask, "block long, tree long, level int, idx long"), "wanted")
    fetched = wanted.join(made.nodes.drop("n"), ["tree", "level", "idx"])
    kept = [c for c in rows.columns if c != "block"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema)

    def expand(table: pa.Table, given: pa.Table) -> pa.Table:
        held: dict[tuple[int, int], dict[int, bytes]] = {}
        for tree, level, idx, digest in zip(*[given[c].to_pylist() for c in ("tree", "level", "idx", "digest")]):
            held.setdefault((tree, level), {})[idx] = digest.encode()
        tree, idx, n = (table[c].to_numpy() for c in ("tree", "idx", "n"))
        for t, i, d in zip(tree.tolist(), idx.tolist(), table["leaf"].to_pylist()):
            held.setdefault((t, 0), {})[i] = d.encode()
        subroot = {}
        for t in np.unique(tree).tolist():
            of = tree == t
            subroot[t] = _derive(held, t, idx[of], int(n[of][0]))
            held.setdefault((TOP, 0), {})[t] = subroot[t]
        root = _derive(held, TOP, np.unique(tree), sources).decode()
        proof = [
            [d.decode() for d in (*_siblings(held, t, i, k), *_siblings(held, TOP, t, sources))]
            for t, i, k in zip(tree.tolist(), idx.tolist(), n.tolist())
        ]
        out = table.select(kept).append_column("subroot", pa.array([subroot[t].decode() for t in tree.tolist()], pa.string()))
        out = out.append_column("root", pa.array([root] * len(table), pa.string()))
        return out.append_column("proof", pa.array(proof, pa.list_(pa.string())))

    both = rows.groupBy("block").cogroup(fetched.groupBy("block"))
    return both.applyInArrow(expand, f"{schema}, subroot string, root string, proof array<string>")


def fold(leaf_digest: str, tree: int, idx: int, n: int, sources: int, proof: Sequence[str]) -> str:
    """Root that a leaf and its siblings lead to."""
    current, rest = leaf_digest.encode(), iter(proof)
    for place, size in ((idx, n), (tree, sources)):
        while size > 1:
            start = place - place % ARITY
            run = [current if i == place else next(rest).encode() for i in range(start, min(start + ARITY, size))]
            current, place, size = sha256(b"".join(run)).hexdigest().encode(), place // ARITY, -(-size // ARITY)
    return current.decode()


def folded(proved: DataFrame, sources: int, leaf_col: str = "leaf") -> DataFrame:
    """``proved`` with ``folded_root``: the root recomputed from ``leaf_col`` and the proof alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (leaf_col, "tree", "idx", "n", "proof")]
            roots = [fold(d, t, i, n, sources, p) for d, t, i, n, p in zip(*columns)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.string())], names=[*batch.schema.names, "folded_root"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in proved.schema)
    return proved.mapInArrow(run, schema + ", folded_root string")


def audit(docs: DataFrame) -> DataFrame:
    """Every row's proof, checked against a copy of the table in which line feeds were deleted from some texts.

    Rows are tampered with where the CRC-32 of the id (as decimal text) is even.
    """
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    shown = leaf([tampered if c == "text" else F.col(c) for c in FIELDS])
    made = manifest(docs, {"shown": shown})
    proved = proofs(made, made.leaves.select("doc_id", "leaf", "shown", "tree", "idx", "n", "at"))
    checked = folded(proved, made.sources, "shown")
    return checked.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.concat_ws("", "proof").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: Siblings of a row by level, in both kinds of trees; folding is one recursive step a level.
SQL = r"""with recursive rows_ as (
  select doc_id, source, coalesce(text, '') as text, array_to_string(list_transform(
      [cast(doc_id as varchar), source, lang, cast(n_chars as varchar), text],
      lambda x: case when x is null then '-' else strlen(x) || ':' || x end), '') as record,
    array_to_string(list_transform([cast(doc_id as varchar), source, lang, cast(n_chars as varchar), replace(text, chr(10), '')],
      lambda x: case when x is null then '-' else strlen(x) || ':' || x end), '') as altered from documents),
bits(k, c) as (select i, i from range(256) t(i)),
crc_table as (select k, list_reduce(list_prepend(cast(k as bigint), [cast(1 as bigint), 2, 3, 4, 5, 6, 7, 8]),
    lambda c, x: case when c & 1 = 1 then xor(cast(3988292384 as bigint), c >> 1) else c >> 1 end) as v from bits),
crc_list as (select list(v order by k) as t from crc_table),
leaves as (select doc_id, source, sha256(record) as leaf, sha256(altered) as altered_leaf,
    (4294967295 - list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
      lambda c, x: xor(t[xor(c, x) % 256 + 1], c >> 8))) % 2 = 0 as tampered from rows_, crc_list),
ranks as (select source, row_number() over (order by source nulls first) - 1 as place, count(*) over () as n
  from (select distinct source from rows_)),
placed as (select *, row_number() over (partition by source order by doc_id, leaf) - 1 as idx, count(*) over (partition by source) as n from leaves),
tree(source, level, idx, n, digest) as (
  select source, 0, idx, n, leaf from placed
  union all
  select source, level + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' order by idx))
  from tree where n > 1 group by source, level, idx // 3),
subroots as (select source, digest from tree where n = 1),
upper_(level, idx, n, digest) as (
  select 0, place, ranks.n, digest from subroots join ranks on subroots.source is not distinct from ranks.source
  union all
  select level + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' order by idx)) from upper_ where n > 1 group by level, idx // 3),
root as (select digest as root from upper_ where n = 1),
walk(doc_id, leaf, source, kind, step, level, idx, n) as (
  select doc_id, leaf, source, 0, 0, 0, idx, n from placed
  union all
  select w.doc_id, w.leaf, w.source, case when w.n > 1 then w.kind else 1 end, case when w.n > 1 then w.step + 1 else w.step end,
    case when w.n > 1 then w.level + 1 else 0 end, case when w.n > 1 then w.idx // 3 else r.place end, case when w.n > 1 then (w.n + 2) // 3 else r.n end
  from walk w join ranks r on w.source is not distinct from r.source where w.n > 1 or w.kind = 0),
nodes as (select 0 as kind, source, level, idx, digest from tree union all select 1, null, level, idx, digest from upper_),
beside as (select w.doc_id, w.leaf, w.step, coalesce(string_agg(d.digest, '' order by d.idx) filter (d.idx < w.idx), '') as before_,
    coalesce(string_agg(d.digest, '' order by d.idx) filter (d.idx > w.idx), '') as after_
  from walk w join nodes d on d.kind = w.kind and d.level = w.level and d.idx // 3 = w.idx // 3
    and (w.kind = 1 or d.source is not distinct from w.source)
  where w.n > 1 group by w.doc_id, w.leaf, w.step, w.kind, w.level, w.idx),
proof as (select doc_id, leaf, sha256(string_agg(before_ || after_, '' order by step)) as proof_sha256 from beside group by doc_id, leaf),
fold(doc_id, leaf, step, digest) as (
  select doc_id, leaf, 0, case when tampered then altered_leaf else leaf end from leaves
  union all
  select f.doc_id, f.leaf, f.step + 1, sha256(b.before_ || f.digest || b.after_) from fold f join beside b
    on f.doc_id is not distinct from b.doc_id and f.leaf = b.leaf and f.step = b.step),
folded as (select doc_id, leaf, arg_max(digest, step) as folded_root from fold group by doc_id, leaf)
select p.doc_id, p.leaf, s.digest as subroot, root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root, folded_root = root as verified
from placed p join subroots s on p.source is not distinct from s.source cross join root
left join proof using (doc_id, leaf) join folded using (doc_id, leaf)"""
