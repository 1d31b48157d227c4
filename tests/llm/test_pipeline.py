import random
import re

import pytest

pytest.importorskip("public_tokenizers")
import __spark_entry__ as entry_module
import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the cat house with this from they water river stone".split(), "de": "der die katze haus und nicht wasser über fluss stein".split()}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    rows = []
    for i in range(160):
        lang = "en" if i % 2 else "de"
        text = " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "a", "b", "c"]) for _ in range(30 + i % 50))
        rows.append((i, text, lang, f"s{i % 4}", len(text)))
    rows += [(200, rows[0][1], "de", "s0", 1), (201, rows[1][1] + " stone", "en", "s1", 1), (202, "12 34 .", "en", "s1", 1), (203, None, None, None, None), (204, "write to jim.1@mail.com the cat house", "en", "s2", 1)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


def test_each_stage_works_on_what_the_last_one_kept(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = docs.collect()
    ids = {name: {r["doc_id"] for r in rows} for name, rows in seen.items()}
    assert ids["language ID"] == {*range(160), 200, 201, 204}
    assert ids["near-duplicates"] == {*range(160), 204}
    assert ids["personal data"] == ids["near-duplicates"]
    assert "jim.1@mail.com" not in str(seen["personal data"]) and any("[EMAIL]" in r["text"] for r in seen["personal data"])
    words = {}
    for step in ("personal data", "source mix"):
        for r in seen[step]:
            words.setdefault(step, {}).setdefault(r["source"], []).append(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])))
    total = sum(sum(v) for v in words["personal data"].values())
    # four sources, weights 5, 2, 1, 5: none is capped
    for source, weight in zip(sorted(words["personal data"]), (5, 2, 1, 5), strict=True):
        assert sum(words["source mix"][source]) == pytest.approx(total * weight / 13, abs=1)


def test_run_packs_all(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= -(-sum(r["length"] for r in got) // 2048) + 1


def test_all_queries_are_registered():
    names = entry_module.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
