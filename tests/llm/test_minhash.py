import random
import re

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import common, leaders, minhash
from riskframe.llm.components import components
from riskframe.llm.textbytes import blocks

SCHEMA = "doc_id long, text string, rep long, n_shingles string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent):
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text))
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b] if x and y):
                p, q = find(a), find(b)
                label[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def family(rng, base, copies, edits):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_agrees_with_brute_force(spark, percent):
    rng = random.Random(percent)
    texts = []
    for size, edits in ((60, 1), (200, 3), (200, 5), (400, 8)):
        texts += family(rng, [f"w{rng.randrange(500)}" for _ in range(size)], 25, edits)
    texts += ["a b c", "A B c", "a b", None, "", " \n", texts[0], texts[0].upper(), "x " * 50_000]
    rows = list(enumerate(texts))
    got = minhash.near_duplicates(spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA), percent).collect()
    want = brute(rows, percent)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["n_shingles"] == len(shingles(texts[r["doc_id"]])) for r in got)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_repeated_and_null_ids(spark):
    one, two = " ".join("abcdefghij"), " ".join("klmnopqrst")
    rows = [(5, one), (3, one), (5, two), (9, two), (9, two), (None, one), (4, None), (7, "z")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA)
    got = minhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(5, 3), (3, 3), (9, 3), (None, None), (4, 4), (7, 7)}
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "4", "7", "None"]


def test_different_texts_under_one_id(spark):
    """Each text of a repeated id has near copies of its own, and all must be found."""
    rng = random.Random(5)
    rows = []
    for k in range(20):
        for _ in range(3):
            a, b, c = family(rng, [f"w{rng.randrange(5000)}" for _ in range(200)], 3, 2)
            rows += [(10 * k, a), (10 * k + 1 + len(rows) % 3, b), (10_000 + len(rows), c)]
    got = minhash.near_duplicates(spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA), 85).collect()
    assert len(got) == len(rows)
    want = brute(rows, 85)
    assert all(r["component_id"] == want[r["doc_id"]] for r in got)


def test_copies_are_settled_in_a_part_of_their_buckets(spark, monkeypatch):
    """Rounds start with few buckets, the rest is left to members still apart; sketches stay out of the bucket tables."""
    rng = random.Random(9)
    texts = family(rng, [f"w{rng.randrange(5000)}" for _ in range(400)], 150, 1) + family(rng, [f"w{rng.randrange(5000)}" for _ in range(200)], 10, 4)
    seen = []

    def spy(df, name):
        out = stored(df, name)
        seen.append((name, out.count(), out.columns))
        return out

    stored = leaders.stored
    monkeypatch.setattr(leaders, "stored", spy)
    monkeypatch.setattr(leaders, "FEW_MEMBERS", 0, raising=False)
    rows = list(enumerate(texts))
    got = minhash.near_duplicates(spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA), 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(rows, 85)
    members = next(n for name, n, _ in seen if name == "members")
    rounds = [n for name, n, _ in seen if name == "open"]
    assert sum(rounds) < members / 4
    assert not any("sketch" in c for name, _, columns in seen if name in ("open", "leaders") for c in columns)


def test_crowd_of_copies_below_the_threshold(spark, monkeypatch):
    """Copies of copies share their edits with a few others only; the crowd is not compared pair by pair, and no link is lost."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = [" ".join(base)]
    for _ in range(100):
        (parent,) = family(rng, base, 1, 6)
        texts += [parent, *family(rng, parent.split(), 1, 1), *family(rng, parent.split(), 1, 2)]
    seen = []

    def spy(df, name):
        out = stored(df, name)
        if name in ("pairs", "verified"):
            seen.append(out.count())
        return out

    stored = leaders.stored
    monkeypatch.setattr(leaders, "stored", spy)
    monkeypatch.setattr(leaders, "LARGE_BUCKET", 10)
    rows = list(enumerate(texts))
    got = minhash.near_duplicates(spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA), 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(rows, 85)
    assert sum(seen) < 10 * len(texts)


def test_worker_keeps_values_of_one_kind():
    made = []
    for kind in ("a", "a", "b", "a"):
        common.worker_store(kind, 1, lambda kind=kind: made.append(kind))
    assert made == ["a", "b", "a"]


def test_no_rows(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_signature_estimates_similarity():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(2000)]
    a = " ".join(words)
    b = " ".join(w if rng.random() > 0.03 else "y" for w in words)
    x, y = (s for _, d, o in blocks(pa.array([a.encode(), b.encode()], pa.binary())) for s in minhash.shingle_sets(d, o))
    real = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert np.mean(minhash.signature(x, 1024) == minhash.signature(y, 1024)) == pytest.approx(real, abs=0.06)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (60, 61)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 60: 60, 61: 60}
