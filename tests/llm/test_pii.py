import re

from riskframe.llm import pii

SCHEMA = "doc_id long, text string, n_chars long, spans__ string, kind string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CASES = [
    "a@b.co_x@d.ef mail me: bob (at) example.com", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3.4 001.2.3.0255", "call 555-123-4567 or (555) 123-4567",
    "4111 1111 1111 1111 x 4111-1111-1111-1112 5" + " 1" * 20_000, "é😀 +49 (30) 1234-5678. " + "a" * 3000 + "@" + "b.c" * 3000, None, "",
    "card 3782 822463 10005, +1234567, +12345678901234567", "a" * 4000, "9" * 4000, "x@y @z a@b.c@d.e", "+1 (243) 555-5526, 97.51.17.173 u.1@m.com",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(len(p) < 400 and int(p) <= 255 for p in hit.split("."))
    return kind == "email" or (16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15)


def brute(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group()))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in enumerate(texts)], SCHEMA)


def test_strict_spans_agree_with_brute_force(spark, sf):
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + CASES
    got = pii.find(frame(spark, texts)).select("doc_id", pii.listed(pii.F.col("base")).alias("b"), pii.listed(pii.F.col("found")).alias("f")).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["b"] == brute(texts[r["doc_id"]])
        assert set(filter(None, r["b"].split(","))) <= set(r["f"].split(","))


def test_votes_learn_which_labelers_to_trust(spark):
    texts = [f"call +1 (243) 555-{i:04d} now" for i in range(60)] + ["mail to jim (at) example.com", "a value of 12"]
    df = pii.with_candidates(frame(spark, texts).select("text"), "text")
    model = pii.fit(df)
    true, false = model.reliability["pattern"]
    assert true > false
    assert pii.fit(df.limit(0)).weights[0] < -10


def test_redaction(spark):
    df = frame(spark, CASES)
    out = pii.redact(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["text"] == "[IP].[IP] 999.1.1.1 [IP] [IP]"
    assert got[11]["text"] == "[PHONE], [IP] [EMAIL]" and got[11]["n_chars"] == len(got[11]["text"])
    assert got[5]["text"] is None and got[6]["text"] == "" and got[8]["text"] == CASES[8]
    for r in got.values():
        assert brute(r["text"]) == ""


def test_rows_of_all_sorts(spark):
    df = spark.createDataFrame([(1, "x@y.org", None, None, None)] * 2 + [(None, "x@y.org", None, None, None)], SCHEMA)
    assert [len(r["found"]) for r in pii.find(df).collect()] == [1, 1, 1]
    assert pii.find(frame(spark, [])).collect() == [] and pii.redact(frame(spark, [])).collect() == []
