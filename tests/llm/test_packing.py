import random
import zlib

import numpy as np
import pytest

from riskframe.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, piece string, length string"
HARD = [
    "it's a<|endoftext|>b don't, “x”, ´e ﬁ İstanbul ΣΑΣ. Σ, ñ, 12,3 x y \x1cz", "́a b́.", "'s, he'S. ---'t", "", None, " \n\t",
    "A1 a1 <|endoftext|> <|ENDOFTEXT|> É é Éa, ×× ÷a 😀😀", "word " * 9000, "x" * 5000,
]


def direct(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts):
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, text in texts.items():
        ids = direct(text)
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // 2048)))
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == 2048 * r["piece"] and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spots in sequences.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 2048
    return len(sequences)


def test_ids_and_places(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()} | {10_000 + k: t for k, t in enumerate(HARD)}
    df = spark.createDataFrame([(i, t, "p", "l") for i, t in texts.items()], SCHEMA)
    rows = packing.pack(df, PATH, keep_ids=False).collect()
    n = check(rows, texts)
    assert n <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c", None, None)] * 3 + [(None, "a b c", None, None)] * 2, SCHEMA)
    rows = packing.pack(df, PATH).collect()
    assert len(rows) == 5 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 5
    assert np.frombuffer(rows[0]["ids"], "<u4").tolist() == direct("a b c")


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_small_caches_give_the_same_ids(monkeypatch):
    known = packing.WordIds(PATH, limit=3)
    import pyarrow as pa

    for text in ("the cat, the Dog! the", "cat dog bird fish. x1 cat", "bird bird, the cat"):
        for _, data, offsets in packing.blocks(pa.array([text.encode()], pa.binary())):
            ids, bounds = packing.text_ids(data, offsets, known, 0)
            assert ids.tolist() == direct(text) and bounds.tolist() == [0, len(ids)]


def test_the_smallest_gives_way_to_two_that_fit_tighter():
    # greedy: 60 + 30, gap 10; 30 gives way to 22 + 18, which fill the bin
    plan = packing.best_two_fit({60: 1, 30: 1, 22: 1, 18: 1}, 100)
    assert {60: 1, 22: 1, 18: 1} in [used for _, used in plan]


def best_fit_decreasing(counts, capacity):
    gaps = []
    for n in sorted((n for n, k in counts.items() for _ in range(k)), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_plans_use_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {n: rng.randint(1, 50) for n in rng.sample(range(1, 257), 80)}
    used = {}
    bins = 0
    for times, filling in packing.best_two_fit(counts, 256):
        assert times > 0 and sum(k * v for k, v in filling.items()) <= 256
        bins += times
        for k, v in filling.items():
            used[k] = used.get(k, 0) + times * v
    assert used == counts
    assert bins <= best_fit_decreasing(counts, 256)
