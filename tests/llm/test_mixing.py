import duckdb
import pytest

from riskframe.llm import mixing

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, key string"


def test_agrees_with_sql_and_reaches_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(tuple(r) for r in mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert got == sorted(con.execute(mixing.SQL).fetchall())
    per = {}
    for _, size, source_size, target, taken in got:
        assert 0 <= taken <= 3 * size
        per.setdefault((source_size, target), []).append(taken)
    for (source_size, target), taken in per.items():
        assert target <= 3 * source_size
        assert sum(taken) == pytest.approx(len(taken) and target, abs=1) or len({k for k in per if k == (source_size, target)}) == 1


def test_hard_rows_and_capped_sources(spark):
    words = lambda n: " ".join(["w"] * n)
    data = [(1, words(10), "a"), (2, words(1000), "b"), (2, words(1000), "b"), (3, None, "c"), (4, " \t\n", None), (None, words(7), None), (6, words(30000), "d")]
    df = spark.createDataFrame([(*r, None, 1, "x") for r in data], SCHEMA)
    got = mixing.mix(df).collect()
    assert len(got) == len(data)
    taken = {r["doc_id"]: (r["size"], r["target"], r["taken"]) for r in got}
    assert taken[1][1:] == (30.0, 30)  # weight 5, capped at three times its words
    assert taken[3] == (0, 0.0, 0) and taken[4][2] == 0
    total = sum(r["size"] for r in got)
    targets = {r["target"]: r["source_size"] for r in got}
    assert sum(targets) == pytest.approx(total)
    again = sorted(map(tuple, mixing.mix(df).collect()), key=str)
    assert again == sorted(map(tuple, got), key=str)


def test_repeated_documents_have_the_words_taken(spark):
    words = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    df = spark.createDataFrame([(i, words(50 + i, "ab"), "s" + str(i % 4), None, 3, "k") for i in range(40)], SCHEMA)
    out = mixing.repeat(df)
    assert out.columns == df.columns
    got, want = {}, {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].split())
    for r in mixing.mix(df).collect():
        if r["taken"]:
            want[r["doc_id"]] = r["taken"]
    assert got == want


def test_no_rows(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
