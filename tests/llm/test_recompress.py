import re

import numpy as np
import pytest

from riskframe.llm import recompress
from riskframe.llm.textbytes import mix

SCHEMA = "doc_id long, text string, name string, doc int, salt int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plainly(rows, width):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    rank = lambda i: (1 << 63) - 1 if i is None else i
    least = {}
    for i, words in texts:
        for k in range(len(words) - width + 1):
            w = tuple(words[k : k + width])
            least[w] = min(rank(i), least.get(w, rank(i)))
    out = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - width + 1):
            if least[tuple(words[k : k + width])] < rank(i):
                gone.update(range(k, k + width))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(chr(97 + int(c)) for c in rng.integers(0, 3, rng.integers(1, 4)))
    prose = lambda k: [word() for _ in range(k)]
    passages = [prose(int(rng.integers(20, 90))) for _ in range(6)]
    passages += [["ha"] * 70, ["ha", "he"] * 40, ["a", "a", "b"] * 30]
    rows = []
    for i in range(n):
        words = []
        for _ in range(int(rng.integers(0, 4))):
            words += prose(int(rng.integers(0, 30))) + passages[int(rng.integers(0, len(passages)))][int(rng.integers(0, 5)) :]
        rows.append((int(rng.integers(0, n)), [" ", "\n", " \t"][i % 3].join(words)))
    copy = rows[3][1]
    rows += [(i, copy) for i in range(200, 230)] + [(400, copy.replace("a", "x", 1)), (None, copy), (None, copy)]
    rows += [(500, None), (501, ""), (502, " \n "), (503, "é   à " * 40), (504, "é   à " * 40), (505, "w" * 90_000), (506, "w " * 3_000), (507, "w " * 3_000)]
    return rows


@pytest.mark.parametrize("seed, width", [(1, 50), (2, 20), (3, 50)])
def test_like_a_plain_version(spark, seed, width):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in recompress.remove_repeats(docs, width).collect()), key=str)
    want = plainly(rows, width)
    assert got == want
    assert sum(r[2] > 0 for r in want) > 20


def test_empty_table(spark):
    assert recompress.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def words_of(rows):
    """Hashed words of the texts with separators, as one block has them."""
    data = "".join(t for _, t in rows).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for _, t in rows])])
    return recompress.Block(np.frombuffer(data, np.uint8), offsets)


def test_certificates_ascend_and_runs_shrink():
    block = words_of([(i, t or "") for i, t in corpus(4) if t and len(t) < 50_000])
    sizes = []
    for parse in recompress.rounds(block.words, block.separator):
        assert (np.diff(parse.low) >= 0).all() and (np.diff(parse.high) >= 0).all()
        assert (parse.low <= parse.start[:-1]).all() and (parse.high >= parse.start[1:]).all()
        sizes.append(len(parse.name))
    assert all(b < a for a, b in zip(sizes, sizes[1:])) and sizes[-1] < 0.5 * sizes[0]


def test_certified_symbols_depend_on_their_words_only():
    """A passage among changing neighbours: whatever is certified inside it is there every time, at the same place."""
    rng = np.random.default_rng(9)
    for case in range(30):
        passage = mix(rng.integers(0, 3 if case % 2 else 50, 60).astype(np.uint64))
        seen = []
        for _ in range(6):
            before, after = (mix(rng.integers(0, 4, rng.integers(0, 9)).astype(np.uint64)) for _ in range(2))
            words = np.concatenate([[np.uint64(0)], before, passage, after, [np.uint64(0)]])
            wall = np.zeros(len(words), bool)
            wall[[0, -1]] = True
            start = 1 + len(before)
            found = set()
            for r, parse in enumerate(recompress.rounds(words, wall)):
                inside = (parse.low >= start) & (parse.high <= start + 60)
                found |= {(r, int(n), int(s) - start) for n, s in zip(parse.name[inside], parse.start[:-1][inside])}
            seen.append(found)
        assert all(s == seen[0] for s in seen)
