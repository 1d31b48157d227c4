"""Forests and boosted trees grown from counted cells, for searches that fit one table many times.

Spark's tree learners see a value by its bin only, so rows of equal bins and label are one row to them, with a count. A search
bins and counts the rows of its folds once; every fit is then a task that grows all its trees from the counts, by the rules of
``RandomForestClassifier`` and ``GBTClassifier``: Poisson bags (a cell of n rows is drawn Poisson(n) times, as its rows are
together), features drawn per node, Gini or variance gain, merged leaves of one prediction, logistic loss. Nothing is sampled
to count the cells; bin borders come from the values of all rows, labels aside.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.lineage import cut

# Bins of a feature, as Spark has them.
MAX_BINS = 32
# Counted cells of a search reach the driver and every task; larger ones are left to Spark's own fits.
MAX_BYTES = 128 << 20
# Rows times trees that a task grows at once.
FLAT_ROWS = 1 << 18
# Gains below these are rounding (relative to the impurity).
GINI_ROUNDING = 1e-14
VARIANCE_ROUNDING = 1e-10
KINDS = ("random_forest", "gradient_boosting", "xgboost", "lightgbm")
SCORED = "fit int, label int, prediction int, score double, n bigint"


@dataclass
class Cells:
    bins: np.ndarray  # (cells, features)
    label: np.ndarray  # (cells): 0 or 1
    rows: np.ndarray  # (folds, cells): rows of the cell in every fold

    def by_class(self, leave_out: int) -> dict[int, int]:
        """Rows of each label outside a fold."""
        left = self.rows.sum(axis=0) - self.rows[leave_out]
        return {c: int(left[self.label == c].sum()) for c in (0, 1)}


def _borders(data: DataFrame, features: Sequence[str], distinct: dict[str, int]) -> dict[str, list[float]]:
    """Lower borders of all bins but the first: every value where there are few, else values of evenly spaced ranks."""
    few = [f for f in features if distinct[f] <= 2 * MAX_BINS]
    out = {}
    if few:
        sets = data.agg(*[F.collect_set(F.col(f).cast("double")).alias(f"s{i}") for i, f in enumerate(few)]).first()
        out = {f: np.unique(sets[i])[1:].tolist() for i, f in enumerate(few) if len(sets[i]) <= MAX_BINS}
    many = [f for f in features if f not in out]
    if many:
        ranks = [i / MAX_BINS for i in range(1, MAX_BINS)]
        out |= {f: np.unique(q).tolist() for f, q in zip(many, data.approxQuantile(many, ranks, 0.1 / MAX_BINS))}
    return out


def count(data: DataFrame, features: Sequence[str], label: str, n_folds: int) -> Cells | None:
    """Cells of a table with ``fold``. None where Spark has to fit: labels other than 0 and 1, or one of them missing outside
    a fold; values without a bin (null, NaN, infinite); too many cells."""
    types = {f.name: f.dataType for f in data.schema}
    if not features or not all(isinstance(types[c], T.NumericType) for c in [*features, label]):
        return None
    values = [F.col(f).cast("double") for f in features]
    odd = F.col(label).isNull() | ~F.col(label).isin(0, 1)
    for v in values:
        odd = odd | v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    seen = data.agg(F.count_if(odd).alias("odd"), *[F.approx_count_distinct(v).alias(f"d{i}") for i, v in enumerate(values)]).first()
    if seen["odd"]:
        return None
    borders = _borders(data, features, {f: seen[f"d{i}"] for i, f in enumerate(features)})
    names = [f"bin{i}__" for i in range(len(features))]
    cut_up = [i for i, f in enumerate(features) if borders[f]]
    binned = data.select(F.col(label).cast("tinyint").alias("label__"), "fold", *[v.alias(n) for v, n in zip(values, names)])
    if cut_up:
        edges = [[-float("inf"), *borders[features[i]], float("inf")] for i in cut_up]
        ids = [f"id{i}__" for i in cut_up]
        binned = Bucketizer(splitsArray=edges, inputCols=[names[i] for i in cut_up], outputCols=ids).transform(binned)
    binned = binned.select(
        "label__", "fold", *[(F.col(f"id{i}__") if i in cut_up else F.lit(0)).cast("tinyint").alias(n) for i, n in enumerate(names)]
    )
    folds = [F.count_if(F.col("fold") == i).alias(f"n{i}__") for i in range(n_folds)]
    cells = cut(binned.groupBy("label__", *names).agg(*folds))
    if cells.count() * (len(features) + 8 * n_folds + 1) > MAX_BYTES:
        return None
    t = cells.toArrow()
    bins = np.column_stack([t[n].to_numpy() for n in names]).astype(np.uint8)
    y = t["label__"].to_numpy().astype(np.int64)
    order = np.lexsort([y, *bins.T])
    rows = np.stack([t[f"n{i}__"].to_numpy() for i in range(n_folds)])[:, order]
    bins, y = bins[order], y[order]
    out = Cells(bins, y, rows)
    return out if all(out.by_class(fold)[c] for fold in range(n_folds) for c in (0, 1)) else None


def _best_gini(h: np.ndarray, weight: np.ndarray, min_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(gain, last bin of the left side) of every node; ``h`` is (nodes, bins, labels) rows."""
    left = h.cumsum(axis=1)
    total = left[:, -1:, :]
    left = left[:, :-1, :]
    right = total - left
    fits = (left.sum(axis=2) >= min_rows) & (right.sum(axis=2) >= min_rows)

    def purity(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = c * weight
        w = s.sum(axis=2)
        return (s * s).sum(axis=2) / w, w

    with np.errstate(divide="ignore", invalid="ignore"):
        whole, w = purity(total)
        gain = (purity(left)[0] + purity(right)[0] - whole) / w
    gain = np.where(fits, gain, -np.inf)
    at = gain.argmax(axis=1)
    return gain[np.arange(len(at)), at], at


def _class_trees(
    bins: np.ndarray, y: np.ndarray, bags: np.ndarray, asked: np.ndarray, weight: np.ndarray, depths: Sequence[int], min_rows: int,
    k: int, rngs: Sequence[np.random.Generator],
) -> np.ndarray:
    """(depths, trees, asked cells): the share of label 1 in a cell's leaf, for trees of every depth (ascending).

    A tree has a row of ``bags`` and a generator that draws level by level, so a shallow tree is the top of the deep one.
    """
    n_trees, depth = len(bags), depths[-1]
    sizes = bins.max(axis=0).astype(int) + 1
    tree, placed = np.nonzero((bags > 0) | asked)
    at, c, cell = tree, bags[tree, placed].astype(float), placed
    leaf_of, live = np.empty(len(cell), dtype=np.int64), np.arange(len(cell))
    ids, made, owner = np.arange(n_trees), n_trees, np.arange(n_trees)
    counts, splits = [], []  # per level: rows by label of its nodes; (node, its first child)
    for level in range(depth + 1):
        a, yy = len(ids), y[cell]
        held = np.bincount(at * 2 + yy, weights=c, minlength=2 * a).reshape(a, 2)
        counts.append(held)
        best, where, what = np.full(a, GINI_ROUNDING), np.zeros(a, dtype=np.int64), np.full(a, -1)
        mixed = (held > 0).all(axis=1) & (level < depth)
        use = np.repeat(mixed[:, None], bins.shape[1], axis=1)
        if k < bins.shape[1]:
            # nodes of a level are in the order of their trees
            draws = np.concatenate([rngs[t].random((m, bins.shape[1])) for t, m in zip(*np.unique(owner, return_counts=True))])
            of_node = np.zeros_like(use)
            np.put_along_axis(of_node, np.argpartition(draws, k - 1, axis=1)[:, :k], True, axis=1)
            use &= of_node
        inside = c > 0
        for f in np.flatnonzero(use.any(axis=0) & (sizes > 1)):
            some = np.flatnonzero(use[:, f])
            local = np.full(a, -1)
            local[some] = np.arange(len(some))
            local = local[at]
            rows = np.flatnonzero(inside & (local >= 0))
            key = (local[rows] * sizes[f] + bins[cell[rows], f]) * 2 + yy[rows]
            h = np.bincount(key, weights=c[rows], minlength=len(some) * sizes[f] * 2).reshape(len(some), sizes[f], 2)
            gain, border = _best_gini(h, weight, min_rows)
            better = gain > best[some]
            best[some[better]], where[some[better]], what[some[better]] = gain[better], border[better], f
        split = np.flatnonzero(what >= 0)
        goes = what[at] >= 0
        leaf_of[live[~goes]] = ids[at[~goes]]
        splits.append((ids[split], made + 2 * np.arange(len(split))))
        if not len(split):
            break
        live, cell, c, at = live[goes], cell[goes], c[goes], at[goes]
        place = np.full(a, -1)
        place[split] = np.arange(len(split))
        at = 2 * place[at] + (bins[cell, what[at]] > where[at])
        ids, owner = made + np.arange(2 * len(split)), np.repeat(owner[split], 2)
        made += len(ids)
    s = np.concatenate(counts) * weight
    guess, w = s[:, 1] > s[:, 0], s.sum(axis=1)
    share = np.divide(s[:, 1], w, out=np.zeros(made), where=w > 0)
    out = asked[placed]
    leaf_of, seat = leaf_of[out], tree[out] * int(asked.sum()) + (np.cumsum(asked) - 1)[placed[out]]
    found = np.empty((len(depths), n_trees * int(asked.sum())))
    for d, most in enumerate(depths):
        leaf, merged = np.ones(made, dtype=bool), np.arange(made)
        for node, child in reversed(splits[:most]):
            leaf[node] = leaf[child] & leaf[child + 1] & (guess[child] == guess[child + 1])
        for node, child in splits:
            into = (merged[node] != node) | leaf[node]
            merged[child[into]] = merged[child[into] + 1] = merged[node[into]]
        found[d, seat] = share[merged[leaf_of]]
    return found.reshape(len(depths), n_trees, -1)


def forest_votes(
    cells: Cells, train: np.ndarray, asked: np.ndarray, weight: np.ndarray, seed: Sequence[int], wanted: Sequence[tuple[int, int]],
    min_rows: int, first: int, end: int,
) -> np.ndarray:
    """(wanted, asked cells): what trees ``first`` to ``end`` add to the votes for label 1 of forests of (trees, depth).

    A tree's draws follow from the seed and its number: forests of any size share their first trees.
    """
    some = np.flatnonzero((train > 0) | asked)
    bins, y, train, ask = cells.bins[some], cells.label[some], train[some], asked[some]
    n_features = bins.shape[1]
    depths = sorted({d for _, d in wanted})
    out, at_once = np.zeros((len(wanted), int(ask.sum()))), max(1, FLAT_ROWS // len(some))
    alone = {1} if n_features > 1 else set()  # the only tree of a forest looks at all features
    for k, sizes in ((n_features, {n for n, _ in wanted} & alone), (int(np.ceil(np.sqrt(n_features))), {n for n, _ in wanted} - alone)):
        for start in range(first, min(end, max(sizes, default=0)), at_once):
            numbers = range(start, min(start + at_once, end, max(sizes)))
            rngs = [np.random.default_rng([*seed, t]) for t in numbers]
            bags = np.stack([rng.poisson(train) for rng in rngs])
            votes = _class_trees(bins, y, bags, ask, weight, depths, min_rows, k, rngs)
            for i, (n, d) in enumerate(wanted):
                if n in sizes and n > start:
                    out[i] += votes[depths.index(d), : n - start].sum(axis=0)
    return out


def _value_tree(columns: list[np.ndarray], w: np.ndarray, target: np.ndarray, depth: int, by_bin: list[np.ndarray]) -> np.ndarray:
    """The prediction of a regression tree for every row; rows of weight 0 are placed only.

    ``by_bin``: running sums of the weights over the bins of every column.
    """
    value, live, at, a = np.empty(len(w)), None, None, 1  # live: rows that go on, None for all of them
    wt = w * target
    wtt = wt * target
    for level in range(depth + 1):
        ww, tt, ss = (w, wt, wtt) if live is None else (w[live], wt[live], wtt[live])
        sw, st, sq = (np.array([x.sum()]) if at is None else np.bincount(at, weights=x, minlength=a) for x in (ww, tt, ss))
        mean = np.divide(st, sw, out=np.zeros(a), where=sw > 0)
        best, where, what = VARIANCE_ROUNDING * sq, np.zeros(a, dtype=np.int64), np.full(a, -1)
        spread = (sq - st * mean > best) & (level < depth)
        if spread.any():
            here = columns if live is None else [column[live] for column in columns]
            for f, column in enumerate(here):
                size = len(by_bin[f])
                if size < 2:
                    continue
                key = column if at is None else at * size + column
                hw = by_bin[f][None, :] if at is None else np.bincount(key, weights=ww, minlength=a * size).reshape(a, size).cumsum(axis=1)
                ht = np.bincount(key, weights=tt, minlength=a * size).reshape(a, size).cumsum(axis=1)
                wl, tl = hw[:, :-1], ht[:, :-1]
                wr, tr = hw[:, -1:] - wl, ht[:, -1:] - tl
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = tl * tl / wl + tr * tr / wr - (st * st / sw)[:, None]
                gain = np.where((wl > 0) & (wr > 0) & spread[:, None], gain, -np.inf)
                border = gain.argmax(axis=1)
                gain = gain[np.arange(a), border]
                better = gain > best
                best[better], where[better], what[better] = gain[better], border[better], f
        split = np.flatnonzero(what >= 0)
        if not len(split):
            value[slice(None) if live is None else live] = mean[0 if at is None else at]
            break
        if len(split) < a:
            goes = what[at] >= 0
            rows = np.flatnonzero(goes) if live is None else live
            value[rows[~goes] if live is not None else ~goes] = mean[at[~goes]]
            live = rows[goes] if live is not None else rows
            here, at = [column[goes] for column in here], at[goes]
        if at is None:
            at = (here[what[0]] > where[0]).astype(np.int64)
        else:
            place, right = np.full(a, -1), np.zeros(len(at), dtype=np.int64)
            place[split] = np.arange(len(split))
            for f in np.unique(what[split]):
                rows = np.flatnonzero(what[at] == f)
                right[rows] = here[f][rows] > where[at[rows]]
            at = 2 * place[at] + right
        a = 2 * len(split)
    return value


def boosted_margins(
    cells: Cells, train: np.ndarray, asked: np.ndarray, weight: np.ndarray, seed: Sequence[int], wanted: Sequence[int], depth: int,
    step: float, rate: float,
) -> np.ndarray:
    """(wanted, asked cells): margins after so many rounds each; a short boosting is the beginning of a long one."""
    some = np.flatnonzero((train > 0) | asked)
    columns = [cells.bins[some, f] for f in range(cells.bins.shape[1])]
    train, ask, sign = train[some], asked[some], 2.0 * cells.label[some] - 1
    each, margin, w = weight[cells.label[some]], np.zeros(len(some)), None
    sizes = [int(column.max()) + 1 for column in columns]
    out = np.zeros((len(wanted), int(ask.sum())))
    for i in range(max(wanted)):
        if w is None or rate < 1:
            w = each * (train if rate >= 1 else np.random.default_rng([*seed, i]).binomial(train, rate))
            by_bin = [np.bincount(column, weights=w, minlength=size).cumsum() for column, size in zip(columns, sizes)]
        with np.errstate(over="ignore"):
            target = 4 * sign / (1 + np.exp(2 * sign * margin)) if i else sign
        margin += (step if i else 1.0) * _value_tree(columns, w, target, depth, by_bin)
        for j, n in enumerate(wanted):
            if n == i + 1:
                out[j] = margin[ask]
    return out


@dataclass
class Fit:
    """One fit of a search: learner, Spark's parameters, held-out fold, weights of label 0 and 1."""

    kind: str
    params: dict
    fold: int
    weight: tuple[float, float]

    def family(self) -> tuple:
        """What fits with trees in common share: forests of any size and depth, boostings of any length."""
        p = self.params
        if self.kind == "random_forest":
            return ("forest", self.fold, self.weight, p["minInstancesPerNode"])
        return ("boosted", self.fold, self.weight, p["maxDepth"], p["stepSize"], p.get("subsamplingRate", 1.0))


def score_fits(data: DataFrame, cells: Cells, fits: Sequence[Fit], seed: int, with_scores: bool = True) -> DataFrame:
    """(fit, label, prediction, score, n): the held-out rows of every fit, counted by what the fit says of them.

    Trees that several fits have in common are grown once, in tasks of a family's boosting or of some trees of its forest.
    Without scores, rows are counted by label and prediction.
    """
    spark = data.sparkSession
    shared = spark.sparkContext.broadcast((cells.bins, cells.label, cells.rows))
    members: dict[tuple, list[int]] = {}
    for i, fit in enumerate(fits):
        members.setdefault(fit.family(), []).append(i)
    families = [(family, ids, [fits[i].params for i in ids]) for family, ids in members.items()]
    blocks = max(1, -(-2 * spark.sparkContext.defaultParallelism // len(families)))
    todo = []  # (cost, family, first tree, end)
    for place, (family, _, params) in enumerate(families):
        if family[0] == "forest":
            n, depth = max(p["numTrees"] for p in params), max(p["maxDepth"] for p in params)
            size = -(-n // blocks)
            todo += [(min(size, n - t) * depth, place, t, min(n, t + size)) for t in range(0, n, size)]
        else:
            todo.append((max(p["maxIter"] for p in params) * family[3], place, 0, 0))
    todo.sort(key=lambda t: -t[0])  # the longest first

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Cells(*shared.value)
        for pdf in batches:
            for i in pdf["id"]:
                _, place, first, end = todo[i]
                family, _, params = families[place]
                held, weight = table.rows[family[1]], np.array(family[2])
                train = table.rows.sum(axis=0) - held
                if family[0] == "forest":
                    wanted = [(p["numTrees"], p["maxDepth"]) for p in params]
                    out = forest_votes(table, train, held > 0, weight, (seed, family[1]), wanted, family[3], first, end)
                else:
                    out = boosted_margins(table, train, held > 0, weight, (seed, family[1]), [p["maxIter"] for p in params], *family[3:])
                yield pd.DataFrame({"family": [place], "first": [first], "said": [out.tobytes()]})

    def judge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        family, ids, params = families[key[0]]
        table, out = Cells(*shared.value), []
        held = table.rows[family[1]]
        y, n = table.label[held > 0], held[held > 0]
        said = sum(np.frombuffer(b).reshape(len(ids), -1) for _, b in sorted(zip(parts["first"], parts["said"])))
        for i, p, x in zip(ids, params, said):
            with np.errstate(over="ignore"):
                score = np.round(x / p["numTrees"] if family[0] == "forest" else 1 / (1 + np.exp(-2 * x)), 12)
            guess = (score > 0.5 if family[0] == "forest" else x > 0).astype(int)
            rows = pd.DataFrame({"fit": i, "label": y, "prediction": guess, "score": score if with_scores else 0.0, "n": n})
            out.append(rows.groupby(["fit", "label", "prediction", "score"], as_index=False)["n"].sum())
        return pd.concat(out)

    grown = cut(spark.range(0, len(todo), 1, len(todo)).mapInPandas(grow, "family int, first int, said binary"))
    return cut(grown.groupBy("family").applyInPandas(judge, SCORED))
