"""Quality scores by co-training two views of a document.

One classifier sees the text (hashed words and shape statistics), the other only metadata (language, source, length).
Both start from labelled documents. In each round each names the unlabelled documents it is surest of, and these
pseudo-labels join the training set of the other. In the end each view is calibrated on labelled documents that
neither was trained on, a last fit weighs the two calibrated views, and all documents are scored.

Training sees bounded samples (``labelled`` and ``pool`` rows); scoring sees every document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import quality_rules
from riskframe.llm.textbytes import U, Words, blocks

LABELLED_ROWS = 6_000
POOL_ROWS = 6_000
ROUNDS = 4
# Share of the pool that a view may name in a round, and how sure it must be.
SHARE = 0.1
SURE = 0.9
BUCKETS = 512
LANG_SLOTS, SOURCE_SLOTS, SIZE_SLOTS = 16, 64, 24
SEED = 13


def content_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: shares of hashed lower-case words, then the shape statistics of the quality rules."""
    words = Words(data, offsets, lower=True)
    n = np.diff(words.first)
    text = np.repeat(np.arange(len(n)), n)
    bucket = (words.hash % U(BUCKETS)).astype(np.int64)
    shares = np.bincount(text * BUCKETS + bucket, minlength=len(n) * BUCKETS).reshape(len(n), BUCKETS) / np.maximum(n, 1)[:, None]
    counts = quality_rules.text_counts(data, offsets)
    names = [*quality_rules.COUNTS, *quality_rules.SHAPES]
    shape = quality_rules.features({c: counts[:, i] for i, c in enumerate(names)})
    return np.concatenate([np.sqrt(shares), shape, np.log1p(n)[:, None]], axis=1).astype(np.float32)


def metadata_view(lang: list, source: list, n_chars: list) -> np.ndarray:
    """One row per document: hashed language and source, bins of the length; null is a value of its own."""
    out = np.zeros((len(lang), LANG_SLOTS + SOURCE_SLOTS + SIZE_SLOTS), np.float32)
    for row, (a, b, c) in enumerate(zip(lang, source, n_chars, strict=True)):
        out[row, zlib.crc32(repr(a).encode()) % LANG_SLOTS] = 1
        out[row, LANG_SLOTS + zlib.crc32(repr(b).encode()) % SOURCE_SLOTS] = 1
        size = 0 if c is None or c < 0 else min(SIZE_SLOTS - 1, 1 + int(math.log2(c + 1)))
        out[row, LANG_SLOTS + SOURCE_SLOTS + size] = 1
    return out


@dataclass
class Linear:
    """Logistic regression on standardised columns."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 250) -> Linear:
    """Accelerated full-batch gradient descent; with a single class the bias alone says so."""
    x = np.asarray(x, np.float64)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = (x - mean) / scale
    # the largest curvature bounds the step
    v = np.ones(z.shape[1]) / math.sqrt(z.shape[1])
    for _ in range(15):
        v = z.T @ (z @ v)
        v /= max(1e-12, np.linalg.norm(v))
    step = 1 / (0.25 * float(np.linalg.norm(z @ v) ** 2) / len(z) + 0.25 + ridge)
    w, b = np.zeros(z.shape[1]), 0.0
    last_w, last_b = w, b
    for k in range(steps):
        look_w, look_b = w + k / (k + 3) * (w - last_w), b + k / (k + 3) * (b - last_b)
        miss = _sigmoid(z @ look_w + look_b) - y
        last_w, last_b = w, b
        w, b = look_w - step * (z.T @ miss / len(z) + ridge * look_w), look_b - step * float(miss.mean())
    return Linear(mean, scale, w, b)


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pools: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS, share: float = SHARE, sure: float = SURE) -> list[Linear]:
    """One classifier per view after ``rounds`` of exchanged pseudo-labels."""
    given: list[dict[int, float]] = [{}, {}]  # pseudo-labels that each view has received
    models: list[Linear] = []
    for turn in range(rounds + 1):
        models = []
        for v in (0, 1):
            at = np.array(sorted(given[v]), np.int64)
            x = np.concatenate([views[v], pools[v][at]]) if len(at) else views[v]
            models.append(fit_linear(x, np.concatenate([y, [given[v][k] for k in at.tolist()]])))
        if turn == rounds or not len(pools[0]):
            break
        for v in (0, 1):
            p = _sigmoid(models[v].logit(pools[v]))
            most = max(1, int(share * len(p)))
            for label, confidence in ((1.0, p), (0.0, 1 - p)):
                # as many of each label as its share of the labelled rows
                k = max(1, int(most * float((y == label).mean())))
                for row in np.argsort(-confidence, kind="stable")[:k].tolist():
                    if confidence[row] >= sure:
                        given[1 - v].setdefault(row, label)
    return models


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (doc_id, quality, lang, source, n_chars, text) -> (doc_id, quality, content, metadata)."""
    for batch in batches:
        c = [content_view(d, o) for _, d, o in blocks(batch.column(5))]
        content = np.concatenate(c) if c else np.zeros((0, 0), np.float32)
        meta = metadata_view(*[batch.column(i).to_pylist() for i in (2, 3, 4)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in content], pa.binary()), pa.array([r.tobytes() for r in meta], pa.binary())], ["doc_id", "quality", "content", "metadata"]
        )


@dataclass
class Model:
    views: list[Linear]
    calibration: list[tuple[float, float]]  # slope and intercept of each view's logit
    final: tuple[float, float, float]  # weights of the calibrated views, bias

    def score(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = [a * v.logit(x) + b for v, (a, b), x in zip(self.views, self.calibration, (content, metadata), strict=True)]
        return _sigmoid(z[0]), _sigmoid(z[1]), _sigmoid(self.final[0] * z[0] + self.final[1] * z[1] + self.final[2])


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED_ROWS, pool: int = POOL_ROWS, rounds: int = ROUNDS, seed: int = SEED) -> Model | None:
    """The model from at most ``labelled`` labelled and about ``pool`` other documents, drawn by seeded hash; None without labels of both kinds."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1) and doc_id is not null")
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = marks.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(labelled)
    share = min(1.0, pool / max(1, docs.count()))
    in_pool = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    rows = docs.join(F.broadcast(chosen), "doc_id", "left").where(F.col("quality").isNotNull() | in_pool)
    rows = rows.select("doc_id", "quality", "lang", "source", "n_chars", "text")
    drawn = rows.mapInArrow(_sample, "doc_id long, quality int, content binary, metadata binary").toPandas().sort_values(["doc_id", "content"])
    if drawn.empty:
        return None
    x = [np.stack([np.frombuffer(r, np.float32) for r in drawn[c]]) for c in ("content", "metadata")]
    y = drawn["quality"].to_numpy(float)
    known = ~np.isnan(y)
    if len(np.unique(y[known])) < 2:
        return None
    # one labelled document in four calibrates
    fold = np.array([zlib.crc32(f"{i}|{seed}".encode()) % 4 == 0 for i in drawn["doc_id"]]) & known
    if len(np.unique(y[fold])) < 2 or len(np.unique(y[known & ~fold])) < 2:
        fold = known
    base = known & ~fold if not (fold == known).all() else known
    views = co_train((x[0][base], x[1][base]), y[base], (x[0][~known], x[1][~known]), rounds)
    calibration, parts = [], []
    for v, m in enumerate(views):
        z = m.logit(x[v][fold])
        line = fit_linear(z[:, None], y[fold], ridge=1e-4)
        a = float(line.weights[0] / line.scale[0])
        calibration.append((a, float(line.bias - a * line.mean[0])))
        parts.append(calibration[-1][0] * z + calibration[-1][1])
    last = fit_linear(np.stack(parts, 1), y[fold], ridge=1e-3)
    w = last.weights / last.scale
    return Model(views, calibration, (float(w[0]), float(w[1]), float(last.bias - w @ last.mean)))


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "content_score", "metadata_score", "score"]
        for batch in batches:
            if model is None:
                nothing = pa.nulls(batch.num_rows, pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0), nothing, nothing, nothing], names)
                continue
            lang, source, size = (batch.column(i).to_pylist() for i in (1, 2, 3))
            parts = []
            for row, data, offsets in blocks(batch.column(4)):
                end = row + len(offsets) - 1
                parts.append(model.score(content_view(data, offsets), metadata_view(lang[row:end], source[row:end], size[row:end])))
            columns = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names)

    return run


def assess(docs: DataFrame, labels: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """(doc_id, content_score, metadata_score, score, kept) for every row of ``docs`` (doc_id, text, lang, source, n_chars).

    Scores are probabilities of good quality. ``kept``: the score is at least ``keep_from``. Null text counts as empty,
    null metadata as values of their own; null and repeated ids are rows like any other. Without labels of both kinds
    the scores are null and every document is kept. An empty table gives an empty table.
    """
    docs = docs.select(*[F.col(c).cast(t).alias(c) for c, t in (("doc_id", "long"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long"))])
    model = train(docs, labels)
    scored = docs.select("doc_id", "lang", "source", "n_chars", "text").mapInArrow(_score(model), "doc_id long, content_score double, metadata_score double, score double")
    return scored.withColumn("kept", F.coalesce(F.col("score") >= keep_from, F.lit(True)))
