"""Shapley values of one decision tree from the values of its feature coalitions.

The game of a row: features in a coalition S are known and steer the row at their splits, the others are averaged by the
training weight that went each way. A row enters only through the intervals that a tree's thresholds cut each feature
into. So v(S) is a table: for one feature a step function over its sorted thresholds, for several features a grid as
long as the grid is small (``GRID_CELLS``), computed once per tree; rows then look their cell up. Larger coalitions are
computed for the distinct cells that rows fall into, by descending from the root along both branches where S leaves the
split open and along one where it does not. A subtree that asks for no feature of S is never entered: its average is
kept at its top node.
"""

from __future__ import annotations

import itertools
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd

# Trees that use more features than this are explained leaf by leaf (2^k coalitions otherwise).
MAX_FEATURES = 10
# Coalition tables up to this many cells are kept with the tree.
GRID_CELLS = 4096
CELLS_AT_ONCE = 4096


def pack(nodes: pd.DataFrame, forest: bool, factor: float) -> dict:
    """Arrays of one tree from the stored node rows (id, children, split, impurity statistics, prediction).

    Leaves hold the probability of label 1 (forest) or the prediction, times ``factor``; ``mean`` of an inner node is the
    average over its leaves by training weight, ``share`` the part of its weight that went left.
    """
    nodes = nodes.sort_values("id", ignore_index=True)
    n = len(nodes)
    left, right = nodes["leftChild"].to_numpy(np.int64), nodes["rightChild"].to_numpy(np.int64)
    inner = left >= 0
    stats = np.stack(nodes["impurityStats"].to_list()).astype(float)
    cover = stats.sum(axis=1) if forest else stats[:, 0]
    value = (stats[:, 1] / cover if forest else nodes["prediction"].to_numpy(float)) * factor
    feature, threshold = np.full(n, -1), np.full(n, np.nan)
    for i in np.flatnonzero(inner):
        split = nodes["split"].iat[i]
        if split["numCategories"] >= 0:
            raise ValueError("Tree attribution needs numeric splits")
        feature[i], threshold[i] = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
    share = np.zeros(n)
    share[inner] = cover[left[inner]] / cover[inner]
    used = np.unique(feature[inner])
    mean, mask = np.where(inner, 0.0, value), np.zeros(n, np.int64)
    # Children are numbered after their parents, so one pass from the end meets every child first.
    for i in np.flatnonzero(inner)[::-1]:
        a, b = left[i], right[i]
        mean[i] = share[i] * mean[a] + (1 - share[i]) * mean[b]
        if len(used) <= 62:
            mask[i] = mask[a] | mask[b] | (1 << int(np.searchsorted(used, feature[i])))
    cuts = [np.unique(threshold[feature == f]) for f in used]
    place, level = np.full(n, -1), np.full(n, -1)
    for k, f in enumerate(used):
        here = feature == f
        place[here], level[here] = k, np.searchsorted(cuts[k], threshold[here])
    tree = {
        "used": used, "cuts": cuts, "feature": feature, "place": place, "threshold": threshold, "level": level,
        "left": left, "right": right, "share": share, "mean": mean, "mask": mask, "grids": {},
    }
    if len(used) <= MAX_FEATURES:
        tree["grids"] = dict(_grids(tree))
    return tree


def _grids(tree: dict) -> Iterator[tuple[int, np.ndarray]]:
    """(coalition, table of v over the grid of its features' intervals) of all coalitions whose grid is small."""
    sizes = [len(c) + 1 for c in tree["cuts"]]
    features = range(len(sizes))
    for k in range(len(sizes) + 1):
        for members in itertools.combinations(features, k):
            shape = [sizes[i] for i in members]
            cells = math.prod(shape)
            if cells > GRID_CELLS:
                continue
            bins = np.zeros((cells, len(sizes)), np.int64)
            if members:
                bins[:, list(members)] = np.stack(np.unravel_index(np.arange(cells), shape), axis=1)
            yield sum(1 << i for i in members), descend(tree, bins, sum(1 << i for i in members))


def descend(tree: dict, bins: np.ndarray, known: int) -> np.ndarray:
    """v(known) of every row of ``bins`` (interval numbers of the used features)."""
    out = np.zeros(len(bins))
    row, node, weight = np.arange(len(bins)), np.zeros(len(bins), np.int64), np.ones(len(bins))
    while len(row):
        asks = (tree["mask"][node] & known) != 0
        done = ~asks
        if done.any():
            out += np.bincount(row[done], weight[done] * tree["mean"][node[done]], minlength=len(bins))
            row, node, weight = row[asks], node[asks], weight[asks]
        place = tree["place"][node]
        steered = ((known >> place) & 1).astype(bool)
        goes_left = bins[row, place] <= tree["level"][node]
        child = np.where(goes_left, tree["left"][node], tree["right"][node])
        open_ = ~steered
        share = tree["share"][node[open_]]
        row = np.concatenate([row[steered], row[open_], row[open_]])
        weight = np.concatenate([weight[steered], weight[open_] * share, weight[open_] * (1 - share)])
        node = np.concatenate([child[steered], tree["left"][node[open_]], tree["right"][node[open_]]])
    return out


def intervals(tree: dict, x: np.ndarray) -> np.ndarray:
    """Number of the interval of every used feature; NaN goes right at every split, as in Spark."""
    return np.stack([np.searchsorted(c, x[:, f], "left") for f, c in zip(tree["used"], tree["cuts"])], axis=1)


def _value(tree: dict, bins: np.ndarray, known: int) -> np.ndarray:
    members = [i for i in range(bins.shape[1]) if known >> i & 1]
    shape = [len(tree["cuts"][i]) + 1 for i in members]
    if known in tree["grids"]:
        return tree["grids"][known][np.ravel_multi_index(bins[:, members].T, shape) if members else np.zeros(len(bins), int)]
    cell = np.zeros(len(bins), np.int64)
    if math.prod(shape) < 1 << 62:
        cell = np.ravel_multi_index(bins[:, members].T, shape)
        _, first, back = np.unique(cell, return_index=True, return_inverse=True)
    else:
        _, first, back = np.unique(bins[:, members], axis=0, return_index=True, return_inverse=True)
    cells = bins[first]
    parts = [descend(tree, cells[i : i + CELLS_AT_ONCE], known) for i in range(0, len(cells), CELLS_AT_ONCE)]
    return np.concatenate(parts)[back.ravel()]


def phi(tree: dict, x: np.ndarray) -> np.ndarray:
    """Shapley values of the tree for each row of x; features the tree does not use get 0."""
    out = np.zeros_like(x)
    k = len(tree["used"])
    if not k or not len(x):
        return out
    bins = intervals(tree, x)
    share = [math.factorial(s) * math.factorial(k - s - 1) / math.factorial(k) for s in range(k)]
    for known in range(1 << k):
        v, size = _value(tree, bins, known), known.bit_count()
        for i, f in enumerate(tree["used"]):
            if known >> i & 1:
                out[:, f] += share[size - 1] * v
            else:
                out[:, f] -= share[size] * v
    return out


def leaves(tree: dict) -> list[tuple[dict, float]]:
    """({feature: (low, high, share)}, value) of every leaf: reached by low < x <= high."""
    out, stack = [], [(0, {})]
    while stack:
        i, so_far = stack.pop()
        f = int(tree["feature"][i])
        if f < 0:
            out.append((so_far, float(tree["mean"][i])))
            continue
        cut, share = tree["threshold"][i], tree["share"][i]
        low, high, part = so_far.get(f, (-np.inf, np.inf, 1.0))
        stack.append((int(tree["left"][i]), {**so_far, f: (low, min(high, cut), part * share)}))
        stack.append((int(tree["right"][i]), {**so_far, f: (max(low, cut), high, part * (1 - share))}))
    return out


def dumps(tree: dict) -> bytes:
    return pickle.dumps(tree, protocol=pickle.HIGHEST_PROTOCOL)


def loads(blob: bytes) -> dict:
    return pickle.loads(blob)
