import hashlib
import re

from riskframe.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n string, output int, h1 string"


def plainly(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, len(units), "plain", None, None, text)
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, len(units))))
    if h4 % 100 < 80:
        return (doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def texts():
    odd = [
        "", None, " ", "\n\t ", "one", " one", "one ", "été à la plage \U0001f600 fin", "a\x00b \x00", "back\\slash \\1 \\0",
        "<P>", "x <M> y", "<", "ends with <", "ends with <S", "P> starts", "<P", "x\x1fy z", "line\r\nfeed\x0bv\x0cf", "w " * 30_000,
        "x" * 200_000, " " * 5_000,
    ]
    return [(i * 100 + k, t) for k, t in enumerate(odd) for i in range(12)] + [(None, "a b c"), (7, "a b c d"), (7, "a b c d")]


def test_like_a_plain_version(spark):
    rows = [(i, t, "n", 1, "h") for i, t in texts()]
    made = fim.transform(spark.createDataFrame(rows, SCHEMA))
    key = lambda r: (str(r[0]), str(r[5]))
    got = sorted((tuple(r) for r in made.collect()), key=key)
    assert got == sorted((plainly(i, t) for i, t in texts()), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_round_trip(spark):
    docs = spark.createDataFrame([(i, t or "") for i, t in texts()], "doc_id long, text string")
    made = fim.transform(docs, fim_percent=100)
    back = made.select("doc_id", fim.restored().alias("text"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)


def test_blocks_do_not_matter(spark, monkeypatch):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    whole = sorted(map(tuple, fim.digests(fim.transform(docs)).collect()), key=str)
    monkeypatch.setattr(fim, "BLOCK_BYTES", 10)
    assert sorted(map(tuple, fim.digests(fim.transform(docs.repartition(3))).collect()), key=str) == whole


def test_empty_table(spark):
    made = fim.digests(fim.transform(spark.createDataFrame([], SCHEMA)))
    assert made.count() == 0 and made.columns[:3] == ["doc_id", "n", "form"]
