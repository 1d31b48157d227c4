"""Exact k nearest neighbours of every row, without comparing all pairs.

Rows go to the cell of a near pivot, and near cells share a group of bounded size. The group answers its own rows first,
which bounds each row's search radius tightly; by the triangle inequality only cells whose ball meets that radius can hold
a nearer row, so a row goes once to each group of such cells. A group that many rows ask is copied for parts of them,
hence no task sees more than a bounded number of rows. Distances of matrix products sort out what is surely too far; what
is left is measured exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.lineage import cut

BLOCK_ROWS = 512
MAX_PIVOTS = 4096
# Rows of a group, and of those that ask it in one task.
GROUP_ROWS = 32_768
MIN_GROUP_ROWS = 2_048
QUERY_ROWS = 128
PAIRS_AT_ONCE = 100_000
SLACK = 1e-9  # widens each bound against rounding, so no neighbour is lost
ROUNDING = 1e-12  # error of a squared distance from matrix products, relative to the squared lengths
NEAR = "array<struct<dist:double,nvid:string,n:bigint>>"


def _squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all squared distances from below and above; without a finite bound: 0 and infinity."""
    with np.errstate(over="ignore", invalid="ignore"):
        lengths = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]
        about = lengths - 2 * (a @ b.T)
        margin = ROUNDING * lengths
        low, high = np.maximum(about - margin, 0.0), about + margin
    return np.where(np.isfinite(low), low, 0.0), np.where(np.isfinite(high), high, np.inf)


def _candidates(a: np.ndarray, b: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of a, row of b, exact distance) of all pairs within the reach of the row of a, in chunks of few rows of a."""
    for start in range(0, len(a), QUERY_ROWS):
        q = a[start : start + QUERY_ROWS]
        low, _ = _squares(q, b)
        i, j = np.nonzero(low <= (reach[start : start + QUERY_ROWS, None] * (1 + SLACK)) ** 2)
        dist = np.concatenate(
            [
                np.sqrt(((q[i[s : s + PAIRS_AT_ONCE]] - b[j[s : s + PAIRS_AT_ONCE]]) ** 2).sum(axis=1))
                for s in range(0, max(1, len(i)), PAIRS_AT_ONCE)
            ]
        )
        yield i + start, j, dist


def _reach(v: np.ndarray, k: int) -> np.ndarray:
    """An upper bound of every row's distance to its k-th nearest other row."""
    out = np.full(len(v), np.inf)
    if len(v) <= k:
        return out
    for start in range(0, len(v), QUERY_ROWS):
        _, high = _squares(v[start : start + QUERY_ROWS], v)
        high[np.arange(len(high)), np.arange(start, start + len(high))] = np.inf
        out[start : start + QUERY_ROWS] = np.sqrt(np.partition(high, k - 1, axis=1)[:, k - 1])
    return out


def _best(i: np.ndarray, j: np.ndarray, dist: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Which of the pairs are among the k nearest of their row; ties go to the smaller rank. In order."""
    order = np.lexsort((rank[j], dist, i))
    place = np.arange(len(order)) - np.searchsorted(i[order], i[order])
    return order[place < k]


def _groups(centres: np.ndarray, rows: np.ndarray, limit: int) -> list[np.ndarray]:
    """Cells in groups of near ones of at most ``limit`` rows in all (a larger cell alone): halved along the widest axis."""
    done, todo = [], [np.arange(len(rows))]
    while todo:
        cells = todo.pop()
        if len(cells) == 1 or rows[cells].sum() <= limit:
            done.append(cells)
            continue
        axis = np.argmax(np.ptp(centres[cells], axis=0))
        cells = cells[np.argsort(centres[cells, axis], kind="stable")]
        share = np.cumsum(rows[cells])
        at = min(max(1, int(np.searchsorted(share, share[-1] / 2))), len(cells) - 1)
        todo += [cells[:at], cells[at:]]
    return done


def _pivots(points: DataFrame, n_rows: int, wanted: int) -> np.ndarray:
    """Rows of the smallest hashes. Every task sends those below a bound only, so the driver gets about ``wanted`` in all."""
    h = F.pmod(F.xxhash64("vid"), F.lit(1 << 30))
    share = min(1.0, 1.2 * (wanted + 20) / max(1, n_rows))
    drawn = points.select("vec", "vid", h.alias("h")).where(F.col("h") <= int(share * (1 << 30))).collect()
    drawn = sorted(drawn, key=lambda r: (r["h"], r["vid"]))[:wanted] or points.limit(1).collect()
    return np.array([r["vec"] for r in drawn], dtype=float)


def nearest(points: DataFrame, k: int) -> DataFrame:
    """(vid, near): the k nearest other points as array<struct<dist, nvid, n>>, nearest first.

    ``points`` has one row per distinct vector: vid (a hash text, so its order is random),
    n (copies), vec (array<double>). Ties in distance go to the smaller vid.
    """
    spark = points.sparkSession
    points = cut(points)
    n_rows = points.count()
    if not n_rows:
        return points.select("vid", F.array().cast(NEAR).alias("near"))
    pivots = _pivots(points, n_rows, min(MAX_PIVOTS, max(1, n_rows // BLOCK_ROWS)))

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            v = np.stack(pdf["vec"].to_numpy())
            home = np.concatenate([_squares(v[i : i + QUERY_ROWS], pivots)[0].argmin(axis=1) for i in range(0, len(v), QUERY_ROWS)])
            yield pdf.assign(cell=home, radius=np.sqrt(((v - pivots[home]) ** 2).sum(axis=1)))

    located = cut(
        points.mapInPandas(locate, "vid string, n bigint, vec array<double>, cell int, radius double")
    )
    # one row per pivot, so at most MAX_PIVOTS rows
    cells = located.groupBy("cell").agg(F.max("radius").alias("radius"), F.count(F.lit(1)).alias("rows")).collect()
    cores = spark.sparkContext.defaultParallelism
    limit = min(GROUP_ROWS, max(MIN_GROUP_ROWS, n_rows // cores))
    rows = np.array([r["rows"] for r in cells])
    grouped = _groups(pivots[[r["cell"] for r in cells]], rows, limit)
    parts = [max(1, -(-int(rows[g].sum()) // limit)) for g in grouped]  # a large cell alone is cut by hash
    base = np.concatenate([[0], np.cumsum(parts)])
    n_groups = int(base[-1])
    homes = spark.createDataFrame(
        [(cells[c]["cell"], int(base[g]), parts[g]) for g in range(len(grouped)) for c in grouped[g]], "cell int, base int, parts int"
    )
    inside = np.concatenate(grouped)
    first = np.concatenate([[0], np.cumsum([len(g) for g in grouped])[:-1]])
    centres = pivots[[cells[c]["cell"] for c in inside]]
    radii = np.array([cells[c]["radius"] for c in inside])
    members = cut(
        located.join(F.broadcast(homes), "cell").select(
            (F.col("base") + F.pmod(F.xxhash64("vid"), F.col("parts")).cast("int")).alias("group"), "vid", "n", "vec"
        )
    )

    def settle(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """The nearest in the own group, and the other groups that may hold nearer rows."""
        v = np.stack(pdf["vec"].to_numpy())
        ids, copies = pdf["vid"].to_numpy(str), pdf["n"].to_numpy()
        rank = np.argsort(np.argsort(ids))
        near: list = [[] for _ in ids]
        reach = _reach(v, k)
        for i, j, dist in _candidates(v, v, reach):
            other = i != j
            i, j, dist = i[other], j[other], dist[other]
            for p in _best(i, j, dist, rank, k):
                near[i[p]].append((float(dist[p]), str(ids[j[p]]), int(copies[j[p]])))
        reach = np.array([x[k - 1][0] if len(x) >= k else np.inf for x in near])
        asked = []
        for start in range(0, len(v), QUERY_ROWS):
            q, r = v[start : start + QUERY_ROWS], reach[start : start + QUERY_ROWS, None]
            to_cell = np.sqrt(_squares(q, centres)[0]) - radii
            hit = np.logical_or.reduceat(to_cell <= r + SLACK * (1 + np.abs(to_cell) + radii), first, axis=1)
            asked += [
                [int(t) for g in np.flatnonzero(row) for t in range(base[g], base[g + 1]) if t != key[0]] for row in hit
            ]
        return pd.DataFrame({"vid": pdf["vid"], "vec": pdf["vec"], "reach": reach, "near": near, "asked": asked})

    # One task a group or few: how many tasks there are follows from the rows, not from the bytes they take.
    spread = max(2 * cores, n_groups)
    settled = cut(
        members.repartition(spread, "group")
        .groupBy("group")
        .applyInPandas(settle, f"vid string, vec array<double>, reach double, near {NEAR}, asked array<int>")
    )
    # one row per group
    load = settled.select(F.explode("asked").alias("group")).groupBy("group").count().collect()
    if not load:
        return settled.select("vid", "near").where(F.size("near") > 0)
    salts = [(r["group"], -(-r["count"] // GROUP_ROWS)) for r in load]
    copies = F.broadcast(spark.createDataFrame(salts, "group int, salts bigint"))
    tasks = max(2 * cores, int(sum(s for _, s in salts)))
    asks = (
        settled.select(F.explode("asked").alias("group"), "vid", "vec", "reach")
        .join(copies, "group")
        .withColumn("salt", F.pmod(F.xxhash64("vid", F.lit(1)), F.col("salts")))
        .drop("salts")
        .repartition(tasks, "group", "salt")
    )
    targets = (
        members.join(copies, "group")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
        .drop("salts")
        .repartition(tasks, "group", "salt")
    )

    def answer(key: tuple, queries: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(pdf):
            v, ids = np.stack(pdf["vec"].to_numpy()), pdf["vid"].to_numpy(str)
            rank = np.argsort(np.argsort(ids))
            for i, j, dist in _candidates(np.stack(queries["vec"].to_numpy()), v, queries["reach"].to_numpy(float)):
                best = _best(i, j, dist, rank, k)
                i, j, dist = i[best], j[best], dist[best]
                out.append(pd.DataFrame({"vid": queries["vid"].to_numpy()[i], "dist": dist, "nvid": ids[j], "n": pdf["n"].to_numpy()[j]}))
        return pd.concat(out) if out else pd.DataFrame({"vid": [], "dist": [], "nvid": [], "n": []})

    answers = asks.groupBy("group", "salt").cogroup(targets.groupBy("group", "salt")).applyInPandas(
        answer, "vid string, dist double, nvid string, n bigint"
    )
    found = answers.select("vid", F.array(F.struct("dist", "nvid", "n")).cast(NEAR).alias("near"))
    # the own group's answers, and at most k of each group a row was sent to
    merged = settled.select("vid", "near").unionByName(found).groupBy("vid").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near")
    )
    return merged
