"""Quality rules by an isolation forest over rule statistics.

One pass over the texts gives rule statistics per document (words, symbols, repeated lines and word windows, shape of
words and lines). Documents that random splits isolate after few steps are anomalous. Each tree grows on a small
seeded sample, the usual 256 rows, so the forest has a fixed size; every document is scored by its mean path length.
The score that separates accepted from rejected is calibrated on all labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored
from riskframe.llm.textbytes import U, Words, blocks, windows
from riskframe.operators import order

TREES = 100
TREE_ROWS = 256
SEED = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHAPES = ("n_lines", "n_upper", "n_distinct", "n_final")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_FINAL = np.zeros(256, bool)
_FINAL[list(b".!?")] = True


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])


def text_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: COUNTS, then SHAPES."""
    words = Words(data, offsets)
    hashes = words.hash
    triples = windows(hashes, 3, 31)
    n_words = np.diff(words.first)
    chars = words.filled & ((data & 0xC0) != 0x80)
    # lines: the stretches between line feeds; every text has one line more than line feeds
    feeds = np.flatnonzero(data == 10)
    first_feed = np.searchsorted(feeds, offsets)
    repeat_words, dup_lines, distinct = (np.zeros(len(n_words), np.int64) for _ in range(3))
    seen = np.concatenate([[0], np.cumsum(words.filled)])
    for d in range(len(n_words)):
        lo, hi = words.first[d], words.first[d + 1]
        if hi <= lo:
            continue
        distinct[d] = len(np.unique(hashes[lo:hi]))
        if hi - lo > 3:
            _, which, count = np.unique(triples[lo : hi - 2], return_inverse=True, return_counts=True)
            again = count[which] > 1
            if again.any():
                marked = np.zeros(hi - lo, bool)
                for k in range(3):
                    marked[k : k + len(again)] |= again
                repeat_words[d] = marked.sum()
        cuts = feeds[first_feed[d] : first_feed[d + 1]]
        if len(cuts):
            start, end = np.concatenate([[offsets[d]], cuts + 1]), np.concatenate([cuts, [offsets[d + 1]]])
            some = seen[end] > seen[start]
            start, end = start[some], end[some]
            dup_lines[d] = len(start) - len(np.unique(words.spans_hash(start, end, 9)))
    shapes = [np.diff(first_feed) + 1, _per_text(_UPPER[data], offsets), distinct, _per_text(_FINAL[data], offsets)]
    return np.stack([n_words, _per_text(chars, offsets), _per_text(_SYMBOL[data], offsets), dup_lines, repeat_words, *shapes], axis=1).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_counts(data, offsets) for _, data, offsets in blocks(batch.column(1))]
        table = np.concatenate(rows) if rows else np.zeros((0, len(COUNTS) + len(SHAPES)), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(table[:, i]) for i in range(table.shape[1])]], ["doc_id", *COUNTS, *SHAPES])


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, COUNTS, SHAPES) of every row (needs doc_id, text). Null text counts as empty: all zero but for one line."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_count, ", ".join(["doc_id long", *[f"{c} long" for c in (*COUNTS, *SHAPES)]]))


def features(t: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest splits on: rates, so that long and short documents compare; those of repeats are smoothed, since
    one repeat says little in a short text, and that of symbols ends at one in five words, so that cuts fall below it."""
    n = np.maximum(t["n_words"], 1).astype(float)
    chars = np.maximum(t["word_chars"], 1).astype(float)
    return np.stack(
        [
            t["word_chars"] / n,
            np.minimum(t["n_symbols"] / n, 0.2),
            t["n_dup_lines"] / (t["n_lines"] + 10.0),
            t["n_repeat_words"] / (n + 100.0),
            t["n_upper"] / chars,
            np.log1p(t["n_final"] / n),
            t["n_distinct"] / n ** 0.85,
        ],
        axis=1,
    )


def _average_path(n: int) -> float:
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else float(max(0, n - 1))


class Forest:
    """Random trees as flat arrays: split feature (-1 at a leaf), cut, right child; the left child comes next."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.depth = math.ceil(math.log2(max(2, rows)))
        self.norm = max(1e-9, _average_path(min(rows, max(2, len(sample)))))
        self.trees = []
        for _ in range(trees):
            feature, cut, right, path = [], [], [], []

            def grow(x: np.ndarray, depth: int) -> None:
                at = len(feature)
                spread = np.flatnonzero(x.max(0) > x.min(0)) if len(x) > 1 else []
                feature.append(-1), cut.append(0.0), right.append(0), path.append(depth + _average_path(len(x)))
                if depth >= self.depth or not len(spread):
                    return
                f = int(rng.choice(spread))
                c = rng.uniform(x[:, f].min(), x[:, f].max())
                low = x[:, f] <= c
                feature[at], cut[at] = f, c
                grow(x[low], depth + 1)
                right[at] = len(feature)
                grow(x[~low], depth + 1)

            if len(sample):
                grow(sample[rng.choice(len(sample), min(rows, len(sample)), replace=False)], 0)
                self.trees.append(tuple(np.array(a) for a in (feature, cut, right, path)))

    def score(self, x: np.ndarray) -> np.ndarray:
        """2^(-mean path / average path): near 1 for anomalies, below one half for ordinary rows."""
        total = np.zeros(len(x))
        for feature, cut, right, path in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                low = x[np.arange(len(x)), np.maximum(f, 0)] <= cut[at]
                at = np.where(inner, np.where(low, at + 1, right[at]), at)
            total += path[at]
        return 2.0 ** (-(total / max(1, len(self.trees))) / self.norm)


def _score(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.score(features(t)))], [*batch.schema.names, "anomaly"])

    return run


def _threshold(known: DataFrame) -> float:
    """The cut with the best balanced accuracy, as far up as possible among equals; no labels of both kinds: nothing is cut.

    ``known`` holds (anomaly, quality) of all labelled rows. They are counted per distinct score, and running totals over
    ordered cells of scores take the place of a sort of them all.
    """
    marked = known.select("anomaly", F.col("quality").alias("good"), (1 - F.col("quality")).alias("bad"))
    counts = stored(marked.groupBy("anomaly").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "scores")
    total = counts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not total["good"] or not total["bad"]:
        return math.inf
    cells = order.value_cells(counts, ["anomaly"])
    upto = order.add_preceding(cells, [], "anomaly__cell", "anomaly", ["good", "bad"])
    gain = (F.col("good_before") + F.col("good")) / F.lit(total["good"]) - (F.col("bad_before") + F.col("bad")) / F.lit(total["bad"])
    at = upto.agg(F.max(F.struct(gain.alias("gain"), "anomaly")).alias("best")).first()["best"]["anomaly"]
    after = counts.where(F.col("anomaly") > F.lit(at)).agg(F.min("anomaly").alias("anomaly")).first()["anomaly"]
    return math.inf if after is None else (at + after) / 2


def judge(docs: DataFrame, labels: DataFrame, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> DataFrame:
    """(doc_id, COUNTS, anomaly, base_failed, kept) for every row of ``docs``; ``labels`` holds (doc_id, quality 0 or 1).

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated windows. ``kept``: not failed, and
    the anomaly is at most the threshold calibrated on all labelled documents that did not fail.

    * Null or blank text: all counts 0, failed. Null doc_id: judged by its text, never labelled.
    * Labels that are null or name no document are left out; without labels of both kinds only the base rules decide.
    * An empty table gives an empty table.
    """
    stats = stored(statistics(docs), "rules")
    rows = stats.count()
    names = [*COUNTS, *SHAPES]
    want = trees * tree_rows
    drawn = stats.where("n_words > 0").select(*names, F.xxhash64("doc_id", F.lit(seed)).alias("h"))
    share = min(1.0, 1.2 * want / max(rows, 1))
    drawn = drawn.where(F.pmod("h", F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).orderBy("h", *names).limit(want).toPandas()
    forest = Forest(features({n: drawn[n].to_numpy() for n in names}), trees, tree_rows, seed)
    schema = ", ".join(["doc_id long", *[f"{n} long" for n in names], "anomaly double"])
    scored = stored(stats.mapInArrow(_score(forest), schema), "anomaly")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)")
    known = scored.where(~failed).select("doc_id", "anomaly").join(marks.groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id")
    limit = _threshold(known)
    return scored.select("doc_id", *COUNTS, "anomaly", failed.alias("base_failed"), (~failed & (F.col("anomaly") <= F.lit(limit))).alias("kept"))
