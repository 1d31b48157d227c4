import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from riskframe.llm import quality_model, quality_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=240, every=3):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        good = i % every > 0
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(40)) for _ in range(90)]
        if not good:
            words = [w + "###" if k % 2 else w.upper() for k, w in enumerate(words)]
        text = " ".join(words)
        rows.append((i, text, "en" if good else "xx", "s" + str(i % 5), len(text), "x"))
        if i % 2:
            labels.append((i, int(good), 0))
    return rows, labels


def stats(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    marked = {i + k for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


def test_statistics_agree_with_brute_force(spark, sf):
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += [None, "", "\n\n", " a\n a\nb\n\n\nb \nb", "é 漢字 x\x0by\x1cz", "a b c a b c", "a a a a", "q " * 60_000, "a\rb\r\na\rb\r"]
    df = spark.createDataFrame([(i, t, None, None, None, None) for i, t in enumerate(texts)], DOCS)
    for r in quality_rules.statistics(df).collect():
        assert tuple(r[c] for c in quality_rules.COUNTS) == stats(texts[r["doc_id"]])


def test_rules_keep_good_and_drop_bad(spark):
    rows, labels = corpus(every=9)
    rows += [(900, None, None, None, None, None), (None, rows[1][1], None, None, None, None), (901, "short text", None, None, None, None), (902, "a b c d e f " * 40, None, None, None, None)]
    got = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, DOCS), spark.createDataFrame([*labels, (None, 1, 0), (5, None, 0), (77777, 0, 0)], LABELS)).collect()}
    assert len(got) == len(rows)
    assert np.mean([got[i]["kept"] for i in range(240) if i % 9]) > 0.95
    assert not any(got[i]["kept"] for i in range(0, 240, 9))
    assert got[900]["base_failed"] and got[901]["base_failed"] and got[902]["base_failed"] and not got[902]["kept"]


def test_rules_without_labels_or_rows(spark):
    rows, _ = corpus(12)
    none = spark.createDataFrame([], LABELS)
    assert all(r["kept"] != r["base_failed"] for r in quality_rules.judge(spark.createDataFrame(rows, DOCS), none).collect())
    assert quality_rules.judge(spark.createDataFrame([], DOCS), none).collect() == []


def test_threshold_takes_all_labelled_rows(spark):
    # with any 50,000 of these rows missing the best cut would lie elsewhere or between other scores
    n = 60_000
    known = spark.range(n).select((F.col("id") / n).alias("anomaly"), (F.col("id") < n - 1000).cast("int").alias("quality"))
    assert quality_rules._threshold(known) == ((n - 1001) / n + (n - 1000) / n) / 2
    rng = np.random.default_rng(3)
    score, good = rng.integers(0, 40, 400) / 40.0, rng.random(400) < 0.6
    cuts = np.unique(score)
    gain = [good[score <= c].sum() / good.sum() - (~good)[score <= c].sum() / (~good).sum() for c in cuts]
    at = len(cuts) - 1 - int(np.argmax(gain[::-1]))
    want = (cuts[at] + cuts[at + 1]) / 2 if at + 1 < len(cuts) else math.inf
    rows = [(float(s), int(g)) for s, g in zip(score, good)]
    assert quality_rules._threshold(spark.createDataFrame(rows, "anomaly double, quality int")) == want
    assert quality_rules._threshold(known.where("quality = 1")) == math.inf


def test_isolated_points_score_high():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(500, 3)), [[9.0, 9.0, 9.0]]])
    score = quality_rules.Forest(x, 50, 128).score(x)
    assert score.argmax() == 500 and score[500] > 0.65 > np.median(score)


def test_model_scores_unlabelled_documents(spark):
    rows, labels = corpus()
    rows += [(900, None, None, None, None, None), (None, rows[1][1], "en", "s1", 5, None), (901, "w " * 50_000, "en", "s", 1, None), (901, "", "en", "s", 1, None)]
    out = quality_model.assess(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    got = out.collect()
    assert len(got) == len(rows)
    right = [r["kept"] == (r["doc_id"] % 3 > 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 240 and r["doc_id"] % 2 == 0]
    assert np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_views_teach_each_other():
    rng = np.random.default_rng(1)
    y = (rng.random(600) < 0.5).astype(float)
    a, b = (y[:, None] * 2 - 1 + rng.normal(size=(600, 4)) for _ in range(2))
    models = quality_model.co_train((a[:12], b[:12]), y[:12], (a[12:400], b[12:400]), rounds=6, share=0.3, sure=0.8)
    alone = quality_model.fit_linear(b[:12], y[:12])
    right = lambda m, x: float(((m.logit(x) > 0) == (y[400:] > 0)).mean())
    assert right(models[1], b[400:]) >= right(alone, b[400:]) - 0.02 and right(models[1], b[400:]) > 0.85


def test_model_without_labels_or_rows(spark):
    rows, _ = corpus(6)
    got = quality_model.assess(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)).collect()
    assert len(got) == 6 and all(r["kept"] and r["score"] is None for r in got)
    assert quality_model.assess(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1, 0)], LABELS)).collect() == []
