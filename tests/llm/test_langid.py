import zlib

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import langid

SCHEMA = "doc_id long, text string, lang string, source string, lang_pred string"
WORDS = {"en": "the cat house with this from they water".split(), "de": "der die katze haus und nicht wasser über".split(), "fr": "le chat maison avec les eau être dans".split()}


def corpus():
    rows = []
    for k in range(120):
        for lang, words in WORDS.items():
            rows.append((len(rows), " ".join(words[(k + j) % len(words)] for j in range(5 + k % 4)), lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "x") for r in rows], SCHEMA)


def test_held_out_rows_are_found(spark):
    rows = corpus()
    got = {r["doc_id"]: r for r in langid.identify(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, _, lang in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1


def test_held_out_labels_are_never_used(spark):
    rows = corpus()
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    twisted = [(i, t, "xx" if out(i) else lang) for i, t, lang in rows]
    a, b = (sorted(map(tuple, langid.identify(frame(spark, r)).collect())) for r in (rows, twisted))
    assert a == b


def test_unseen_words_back_off_to_their_ngrams(spark):
    model = langid.train(frame(spark, corpus()))
    got = langid.predict(frame(spark, [(1, "katzen wassers", None), (2, "chats maisons", None)]), model, ["doc_id"]).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "de", 2: "fr"}
    assert "wkatzen" not in model.known


def test_hard_rows(spark):
    rows = [*corpus(), (1000, None, None), (1001, "", None), (1002, "123 .. !", None), (None, "the water", None), (1003, "漢字 漢字", None), (1004, "the " * 50_000, None), (1004, "the", "en")]
    df = frame(spark, rows)
    got = langid.identify(df).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is None or r["doc_id"] >= 1000}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert by_id[1003]["lang_pred"] in WORDS and by_id[None]["lang_pred"] == "en"
    kept = langid.keep_known(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({1000, 1001, 1002})


def test_a_tiny_language_takes_no_documents_of_others(spark):
    rows = corpus()
    base = max(r[0] for r in rows) + 1
    free = next(i for i in range(base, base + 100) if zlib.crc32(str(i).encode()) % 4 != 2)
    for text in ("zorp blik", "zorp blik the cat house wub wub"):
        got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(frame(spark, [*rows, (free, text, "xx")])).collect()}
        assert all(got[i] == lang for i, _, lang in rows)
        # and keeps its own
        assert got[free] == "xx"
    # words that the others have seldom
    rare = [(i, f"{t} {'seldom' if lang == 'en' else 'selten'}{i}", lang) for i, t, lang in rows]
    model = langid.train(frame(spark, [*rare, (free, "zorp", "xx")]))
    got = langid.predict(frame(spark, rare), model, ["doc_id", "lang"]).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)


def test_units_are_chosen_per_language(spark):
    model = langid.train(frame(spark, [*corpus(), (5000, "zorp blik", "xx")]), words=3, grams=30)
    assert {"wzorp", "wblik"} <= set(model.known)
    assert langid.train(frame(spark, [*corpus(), (5000, "12", "xx")])).langs == ["de", "en", "fr"]


def test_no_labels_and_no_rows(spark):
    got = langid.identify(frame(spark, [(1, "the cat", None)])).collect()
    assert got[0]["lang_pred"] == "und"
    assert langid.identify(frame(spark, [])).collect() == []


def test_lookups_in_bulk_agree_with_one_unit_at_a_time(spark):
    model = langid.train(frame(spark, corpus()), words=12, grams=60)
    rows = {mark + u: r for mark, (units, table) in model.parts.items() for u, r in zip(units.to_pylist(), table, strict=True)}
    assert set(rows) == model.known

    def single(word):
        if "w" + word in rows:
            return rows["w" + word]
        for k in range(langid.LONGEST, 0, -1):
            known = [rows[f"{k}{g}"] for g in langid._grams(word, k) if f"{k}{g}" in rows]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(len(model.langs))

    words = ["water", "katze", "katzen", "w", "zzz", "漢字", "überhaus", "a"]
    assert np.array_equal(model.words(words), np.array([single(w) for w in words], np.float32))
    assert model.words([]).shape == (0, 3)


def test_model_has_no_object_per_unit_and_texts_travel_once(spark, monkeypatch):
    """Executors hold the model in every worker: both it and a batch have to be small."""
    model = langid.train(frame(spark, corpus()))
    assert all(isinstance(units, pa.Array) and table.dtype == np.float32 for units, table in model.parts.values())
    sent = []
    kind = type(spark.range(1))
    inner = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *args: (sent.append(self.columns), inner(self, *args))[1])
    kept = langid.keep_known(frame(spark, [*corpus(), (1, None, "en")]))
    assert sent[-1] == ["row__"] and kept.count() == len(corpus())


def test_blocks_of_words_and_a_full_cache_change_nothing(spark):
    rows = frame(spark, corpus())
    model = langid.train(rows)
    want = rows.count(), sorted(map(tuple, langid.predict(rows, model, ["doc_id"]).collect()))
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in corpus()]), pa.array([r[1] for r in corpus()])], ["doc_id", "text__"])
    for words, cache in ((1, 1), (7, 20)):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(langid, "BLOCK_WORDS", words)
            patch.setattr(langid, "CACHE_WORDS", cache)
            got = [tuple(r.values()) for b in langid._predict(model, None)(iter([batch])) for r in b.to_pylist()]
        assert (len(got), sorted(got)) == want
