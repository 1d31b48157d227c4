import hashlib
import zlib

import numpy as np
import pytest

from riskframe.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree int, part string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(level):
    """(top, siblings of every leaf with its place in the run)."""
    above = [[] for _ in level]
    at = list(range(len(level)))
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for k, i in enumerate(at):
            run = runs[i // 3]
            above[k].append((run[: i % 3], run[i % 3 + 1 :]))
        at = [i // 3 for i in at]
        level = [sha(*run) for run in runs]
    return level[0], above


def plainly(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        members = sorted(by_source[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees.append((members, *climb([leaf_of(*r) for r in members])))
    root, upper = climb([t[1] for t in trees])
    out = []
    for (members, subroot, paths), top in zip(trees, upper):
        for r, path in zip(members, paths):
            steps = path + top
            proof = sha(*[d for before, after in steps for d in (*before, *after)])
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            shown = r[4].replace("\n", "") if even and r[4] is not None else r[4]
            now = leaf_of(*r[:4], shown)
            for before, after in steps:
                now = sha(*before, now, *after)
            out.append((r[0], leaf_of(*r), subroot, root, proof, now, now == root))
    return sorted(out, key=str)


def rows_of(n):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        source = [None, "", "hot", "hot", "hot", "é", "z", f"s{i % 7}"][i % 8]
        rows.append((int(i * 7 % 1000), source, None if i % 5 == 0 else "en", None if i % 11 == 0 else i, None if i % 13 == 0 else "a\nb" * int(rng.integers(0, 4))))
    rows += rows[:5] + [(None, "hot", "en", 1, "x"), (None, None, None, None, None), (3, "lone", "en", 2, "long " * 20_000)]
    return rows


@pytest.mark.parametrize("n", [1, 40, 400])
def test_like_a_plain_version(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "BLOCK", 37)
    monkeypatch.setattr(merkle, "TILE_LEVELS", 2)
    rows = rows_of(n)
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in merkle.audit(docs).collect()), key=str) == plainly(rows)


def test_one_row_and_empty_table(spark):
    row = (5, "s", "en", 3, "a\nb")
    one = spark.createDataFrame([row], SCHEMA.split(", leaf")[0])
    assert [tuple(r) for r in merkle.audit(one).collect()] == plainly([row])
    assert merkle.audit(one.limit(0)).count() == 0


def test_missing_nodes_are_the_fewest():
    tree, idx = np.array([0, 0, 0, 2]), np.array([0, 1, 8, 0])
    gaps = {tuple(g) for g in merkle.missing(tree, idx, np.array([9, 9, 9, 1]), 3).tolist()}
    # Leaf 2 beside 0 and 1; 6 and 7 beside 8; the middle run's node; the subroot of source 1.
    assert gaps == {(0, 0, 2), (0, 0, 6), (0, 0, 7), (0, 1, 1), (merkle.TOP, 0, 1)}
    whole = merkle.missing(np.zeros(9, int), np.arange(9), np.full(9, 9), 1)
    assert len(whole) == 0


def test_proofs_of_some_leaves(spark):
    docs = spark.createDataFrame([(i, "s" if i % 3 else "t", "en", i, f"text {i}") for i in range(200)], SCHEMA.split(", leaf")[0])
    made = merkle.manifest(docs)
    some = merkle.folded(merkle.proofs(made, made.leaves.where("doc_id in (3, 4, 150)")), made.sources)
    got = some.collect()
    assert len(got) == 3 and all(r.folded_root == r.root for r in got)
    assert merkle.fold("0" * 64, got[0].tree, got[0].idx, got[0].n, made.sources, got[0].proof) != got[0].root
