"""Language identification by word-first backoff.

Known words are scored by their log frequency in each language. A word that was not seen in training is scored by
its character n-grams: the longest ones first, shorter ones only where none of the longer is known. Both scores are
log probabilities of the languages given the word or n-gram under equal priors, so they add up over a text.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskframe.llm.common import forget_others, stored

# Training documents of one language, and the words and n-grams of one language that the model keeps, at most.
TRAIN_DOCS = 4_000
MODEL_WORDS = 60_000
MODEL_GRAMS = 120_000
LONGEST = 5
# Units of the background, text of all languages together, that each language's counts are filled up with.
BACKGROUND = 500.0
# Words a task keeps the scores of, and words whose texts are judged together.
CACHE_WORDS = 100_000
BLOCK_WORDS = 500_000
UNKNOWN = "und"

_WORD = r"[^\W\d_]+"


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text leaves 2 when divided by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (lang, text) -> (lang, unit, n), summed within a batch; units are words, and n-grams with their length in front."""
    find = re.compile(_WORD).findall
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(find((text or "").lower()))
        langs, units, numbers = [], [], []
        for lang, words in counts.items():
            grams: Counter = Counter()
            for word, n in words.items():
                for k in range(1, LONGEST + 1):
                    for g in _grams(word, k):
                        grams[f"{k}{g}"] += n
            for table, mark in ((words, "w"), (grams, "")):
                langs += [lang] * len(table)
                units += [mark + u for u in table]
                numbers += table.values()
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(units, pa.string()), pa.array(numbers, pa.int64())], ["lang", "unit", "n"])


class Model:
    """``langs``; ``parts[mark]``: units, and per unit log P(language | unit), of words (mark ``w``) and of n-grams (their length).

    Arrow and NumPy hold the tables as they are, a few MB in the driver and in each worker: no object per unit.
    """

    def __init__(self, langs: list[str], parts: dict[str, tuple[pa.Array, np.ndarray]]):
        self.langs, self.parts = langs, parts

    @property
    def known(self) -> set[str]:
        return {mark + unit for mark, (units, _) in self.parts.items() for unit in units.to_pylist()}

    def _find(self, mark: str, units: list[str]) -> np.ndarray:
        """Places of ``units`` in the part, -1 where it has none."""
        if mark not in self.parts:
            return np.full(len(units), -1)
        return pc.index_in(pa.array(units, pa.string()), value_set=self.parts[mark][0]).fill_null(-1).to_numpy(zero_copy_only=False)

    def words(self, words: list[str]) -> np.ndarray:
        """A row of scores for each word."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        at = self._find("w", words)
        if (at >= 0).any():
            out[at >= 0] = self.parts["w"][1][at[at >= 0]]
        left = np.flatnonzero(at < 0)
        for k in range(LONGEST, 0, -1):
            grams = [_grams(words[i], k) for i in left]
            at = self._find(str(k), list(itertools.chain.from_iterable(grams)))
            ends = np.cumsum([len(g) for g in grams], dtype=np.int64)
            hits = np.concatenate([[0], np.cumsum(at >= 0)])
            some = hits[ends] > hits[ends - [len(g) for g in grams]] if len(left) else np.zeros(0, bool)
            for j in np.flatnonzero(some):
                mine = at[ends[j] - len(grams[j]) : ends[j]]
                out[left[j]] = np.mean(self.parts[str(k)][1][mine[mine >= 0]], axis=0)
            left = left[~some]
        return out


def _log_share(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """What a language has not seen is as frequent in it as in all languages together, so a small language claims nothing by being small."""
    shared = counts.sum(axis=1, keepdims=True) / totals.sum()
    rate = (counts + BACKGROUND * shared) / (totals + BACKGROUND)
    return np.log(rate / rate.sum(axis=1, keepdims=True)).astype(np.float32)


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, words: int = MODEL_WORDS, grams: int = MODEL_GRAMS, seed: int = 3) -> Model:
    """Model from (doc_id, text, lang) rows with a language, on at most about ``train_docs`` seeded documents of each."""
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], {})
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, train_docs / sizes[lang]))).otherwise(share)
    dealt = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    units = rows.where(dealt < share).select("lang", "text").mapInArrow(_count, "lang string, unit string, n long")
    table = stored(units.groupBy("unit").pivot("lang", langs).agg(F.sum("n")).na.fill(0), "units")
    mark = F.substring("unit", 1, 1)
    sums = {r["mark"]: r for r in table.groupBy(mark.alias("mark")).agg(*[F.sum(f"`{lang}`").alias(lang) for lang in langs]).collect()}
    # a language without a word has nothing to be told by
    langs = [lang for lang in langs if "w" in sums and sums["w"][lang]]
    if not langs:
        return Model([], {})
    totals = {k: np.array([r[lang] for lang in langs], float) for k, r in sums.items()}
    least = _least(table, langs, words, grams)
    wanted = F.lit(False)
    for lang in langs:
        wanted = wanted | (F.col(f"`{lang}`") >= F.when(mark == "w", F.lit(least[lang, True])).otherwise(F.lit(least[lang, False])))
    chosen = table.where(wanted).toArrow().combine_chunks()
    marks = pc.utf8_slice_codeunits(chosen["unit"], 0, 1)
    parts = {}
    for k in totals:
        some = chosen.filter(pc.equal(marks, k))
        if some.num_rows:
            counts = np.stack([some[lang].to_numpy() for lang in langs], axis=1).astype(float)
            parts[k] = pc.utf8_slice_codeunits(some["unit"], 1).cast(pa.string()).combine_chunks(), _log_share(counts, totals[k])
    return Model(langs, parts)


def _least(table: DataFrame, langs: list[str], words: int, grams: int) -> dict[tuple[str, bool], int]:
    """(language, of words) -> the count that a unit needs to be among the most frequent ``words`` or ``grams`` of the language.

    Units that are equally frequent in a language stay or go together.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(lang).alias("lang"), F.col(f"`{lang}`").alias("n")) for lang in langs])).alias("cell")
    cells = table.select(F.col("unit").startswith("w").alias("is_word"), cells).select("is_word", "cell.*").where("n > 0")
    least = {(lang, is_word): 1 for lang in langs for is_word in (True, False)}
    above: Counter = Counter()
    for r in cells.groupBy("lang", "is_word", "n").count().orderBy(F.desc("n")).collect():
        key = (r["lang"], r["is_word"])
        above[key] += r["count"]
        if above[key] > (words if r["is_word"] else grams):
            least[key] = max(least[key], r["n"] + 1)
    return least


class _Scores(dict):
    """Word -> its row in a growing table of scores; new words are scored together when the table is asked for."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new, self.table = model, [], np.zeros((1024, len(model.langs)), np.float32)

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        return self.setdefault(word, len(self))

    def rows(self) -> np.ndarray:
        if len(self) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(len(self.table), len(self) - len(self.table)), len(self.model.langs)), np.float32)])
        self.table[len(self) - len(self.new) : len(self)] = self.model.words(self.new)
        self.new = []
        return self.table


def _judge(block: list[np.ndarray], scores: _Scores) -> Iterator[tuple[str, float]]:
    """Language and score of each text, given the places of its words."""
    table = scores.rows()
    for at in block:
        if not len(at):
            yield UNKNOWN, 0.0
            continue
        total = table[at].sum(axis=0, dtype=np.float64)
        share = np.exp(total - total.max())
        best = int(np.argmax(share))
        yield scores.model.langs[best], float(share[best] / share.sum())
    if len(scores) > CACHE_WORDS:
        scores.clear()


def _predict(model: Model, inside: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others("language")
        scores = _Scores(model)
        find = re.compile(_WORD).findall
        for batch in batches:
            found: list[tuple[str, float]] = []
            block, size = [], 0
            for text in batch.column(0).field(inside) if inside else batch.column(batch.num_columns - 1):
                words = find((text.as_py() or "").lower()) if model.langs else []
                block.append(np.fromiter(map(scores.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size > BLOCK_WORDS:
                    found += _judge(block, scores)
                    block, size = [], 0
            found += _judge(block, scores)
            kept = 1 if inside else batch.num_columns - 1
            added = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *added], [*batch.schema.names[:kept], "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model, keep: list[str], inside: str | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` with lang_pred and score. The text alone settles both.

    Text that is null or has no letter: ``und``, score 0. A tie goes to the language that sorts first. The score is
    the probability of the language among those learned. ``inside``: the field of the only kept column, a struct, that
    is the text; then it travels once.
    """
    rows = docs.select(*keep) if inside else docs.select(*keep, F.col("text").cast("string").alias("text__"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(keep)]], "lang_pred string", "score double"])
    return rows.mapInArrow(_predict(model, inside), schema)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; learned from the rows with a language that are not held out.

    Null or repeated doc_ids are rows like any other. Without a labelled row every text is ``und``. An empty table
    gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    return predict(docs, train(docs.where(~F.col("held_out"))), ["doc_id", "held_out"])


def keep_known(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is found with a score of at least ``least``; ``und`` goes."""
    learn = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(~held_out(F.col("doc_id").cast("long")))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row__"), F.col("text").cast("string").alias("text"))
    inside = next((f.name for f in docs.schema if f.name.lower() == "text" and f.dataType == StringType()), None)
    found = predict(named, train(learn), ["row__"], inside)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row__.*")
