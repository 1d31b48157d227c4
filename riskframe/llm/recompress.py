"""Long passages that repeat across documents, found by recompression and removed.

Recompression replaces, round after round, runs of one symbol and then pairs of neighbours by new symbols. A pair is
made where the left symbol's name falls into the left half of a seeded split of all names and the right one's into the
right half. A new name is a 64-bit mix of what it joins (symbol and length of a run, or the two of a pair), so all tasks
give the same name to the same run or pair: the naming is global, and a round needs no exchange. Equal passages get
equal symbols but near their ends. With every symbol goes its *certificate*: the stretch of words that decides that the
symbol is there. Whoever has these words has the symbol, at the same place.

A window of ``WINDOW`` words is filed under one of the symbols of the highest round whose certificates lie inside the
window, the one of smallest name. Certificates are decided by the words inside them, so equal windows are filed under the same symbol at the same
offset, whatever stands around them; the words themselves are symbols of round 0, so every window is filed, inside
long runs too. Consecutive windows under one symbol and in one range of offsets to it make a *file*: a row (name, digest,
id). The name stands for the symbol, the range and the words that all windows of that range have in common, the digest
for all words of the file.

1. Names that occur under one id only are left out: no window filed there repeats.
2. Files with the same name and digest hold the same windows: all but those of the smallest id are removed.
3. Where a name has several digests, files differ at their ends but may share windows (the borders of a passage, or of an
   edit in a copy). One file per digest, that of the smallest id, then lists a 128-bit name per window, and windows
   equal by it are settled in the same way.
4. Texts are parsed again beside what was settled for their id, and the words of settled windows go.

Every step joins rows to a count over (name), (name, digest) or window names. Counts combine before the shuffle;
rows carry one of ``SALTS`` salts of their id, and a count is copied only to the salts that occur in it, so a passage in
a third of all documents is spread over tasks on both sides and no copies are made for rare ones.

Ids are compared as long integers; rows with one id do not remove each other's windows, and repeated rows fare alike. A
null id counts as larger than all others. Null text has no words; a text with fewer than ``WINDOW`` words keeps all; an empty table
gives an empty one. Only the id and text columns are read. Names decide: two different windows pass for equal only if
both 64-bit names agree by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import textbytes
from riskframe.llm.common import stored
from riskframe.llm.textbytes import U, Words, mix, windows

WINDOW = 50
# Symbols of the last round join four words on average: a window holds several, and neighbouring windows share the least.
ROUNDS = 5
# Windows under one symbol are parted by their offset to it, into ranges of ``width // BUCKETS``.
BUCKETS = 4
_PAIR = U(0x9FB21C651E98DF25)
_RUN = U(0xD6E8FEB86659FD93)


class Parse:
    """Symbols of one round over all words of a block: ``name``, ``start`` (first word; ``start[k + 1]`` ends symbol k) and
    the certificate ``low``/``high``. Texts are parted by single separator symbols, which never merge."""

    def __init__(self, words: np.ndarray, separator: np.ndarray):
        n = len(words)
        self.words, self.separator = words, separator
        self.name, self.wall = words.copy(), separator.copy()
        self.start = np.arange(n + 1)
        self.low, self.high = np.arange(n), np.arange(1, n + 1)

    def _merge(self, joined: np.ndarray, name: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Join each symbol marked ``joined`` to the one before it; names and certificates are those of the first."""
        first = np.flatnonzero(~joined)
        self.name, self.wall = name[first], self.wall[first]
        self.low, self.high = low[first], high[first]
        self.start = np.append(self.start[first], self.start[-1])

    def runs(self, round_: int) -> None:
        """Maximal runs of one symbol become symbols.

        That a neighbour differs is certified by one word of it where that word settles it (its first word is not this
        symbol's first, its last not this symbol's last), else by all of the neighbour.
        """
        k = len(self.name)
        same = np.zeros(k, bool)
        same[1:] = (self.name[1:] == self.name[:-1]) & ~self.wall[1:] & ~self.wall[:-1]
        first = np.flatnonzero(~same)
        last = np.append(first[1:], k) - 1
        length = last - first + 1
        begin, end = self.start[first], self.start[last + 1]
        low, high = self.low[first].copy(), self.high[last].copy()
        if len(first) > 1:
            words = self.words
            settled = words[end[:-1]] != words[begin[:-1]]
            beyond = np.where(settled, end[:-1] + 1, self.high[first[1:]])
            high[:-1] = np.maximum(high[:-1], beyond)
            settled = words[begin[1:] - 1] != words[end[1:] - 1]
            beyond = np.where(settled, begin[1:] - 1, self.low[last[:-1]])
            low[1:] = np.minimum(low[1:], beyond)
        name = self.name[first]
        longer = length > 1
        name[longer] = mix(name[longer] * _RUN + length[longer].astype(U), round_)
        self.name, self.wall = name, self.wall[first]
        self.low, self.high = low, high
        self.start = np.append(begin, self.start[-1])

    def pairs(self, round_: int) -> None:
        """Neighbours (left half, right half) become one symbol; a symbol left alone is certified by the neighbour it might have joined."""
        k = len(self.name)
        if k < 2:
            return
        right = (mix(self.name, 1000 + round_) & U(1)).astype(bool)
        left = ~right & ~self.wall
        right &= ~self.wall
        meets = left[:-1] & right[1:]
        joined = np.zeros(k, bool)
        joined[1:] = meets
        low, high, name = self.low.copy(), self.high.copy(), self.name.copy()
        at = np.flatnonzero(meets)
        name[at] = mix(self.name[at] * _PAIR + mix(self.name[at + 1], 7), round_)
        low[at] = np.minimum(self.low[at], self.low[at + 1])
        high[at] = np.maximum(self.high[at], self.high[at + 1])
        alone = np.flatnonzero(left[:-1] & ~meets)
        low[alone] = np.minimum(low[alone], self.low[alone + 1])
        high[alone] = np.maximum(high[alone], self.high[alone + 1])
        alone = np.flatnonzero(right[1:] & ~meets) + 1
        low[alone] = np.minimum(low[alone], self.low[alone - 1])
        high[alone] = np.maximum(high[alone], self.high[alone - 1])
        self._merge(joined, name, low, high)


def rounds(words: np.ndarray, separator: np.ndarray) -> Iterator[Parse]:
    """The parse before the first round and after each round (the same object, whose arrays are replaced)."""
    parse = Parse(words, separator)
    yield parse
    for r in range(1, ROUNDS + 1):
        parse.runs(2 * r)
        parse.pairs(2 * r + 1)
        yield parse


def filed(words: np.ndarray, separator: np.ndarray, first: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(name, start) of the symbol under which each window is filed; ``first`` are the windows' first words.

    Of the symbols certified inside a window at the highest round that has any, the one with the smallest mixed name is
    taken, the first of equal ones.
    """
    name, start = np.zeros(len(first), U), np.zeros(len(first), np.int64)
    if not len(first):
        return name, start
    parses = [(p.name, p.start, p.low, p.high) for p in rounds(words, separator)]
    left = np.arange(len(first))
    for symbol, begin, low, high in reversed(parses):
        # Certificates ascend by both ends, so those inside a window are neighbours.
        a = np.searchsorted(low, first[left])
        count = np.searchsorted(high, first[left] + width, "right") - a
        has = count > 0
        now, left, a, count = left[has], left[~has], a[has], count[has]
        # Smallest name of each stretch of symbols: two overlapping stretches whose length is a power of two.
        best, size = np.zeros(len(a), np.int64), 1
        place, order = np.arange(len(symbol)), mix(symbol, 11)
        while len(now):
            here = np.flatnonzero((count >= size) & (count < 2 * size))
            x, y = place[a[here]], place[a[here] + count[here] - size]
            best[here] = np.where(order[y] < order[x], y, x)
            if not (count >= 2 * size).any():
                break
            ahead = np.minimum(np.arange(len(place)) + size, len(place) - 1)
            place = np.where(order[place[ahead]] < order[place], place[ahead], place)
            size *= 2
        name[now], start[now] = symbol[best], begin[best]
        if not len(left):
            break
    return name, start


class Block:
    """The words of a run of texts with separators around every text, their windows and files."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int = WINDOW):
        self.text = text = Words(data, offsets)
        self.width = width
        self.count = np.diff(text.first)
        texts = len(self.count)
        self.word = np.arange(len(text.start)) + np.repeat(np.arange(texts), self.count) + 1
        self.words = np.zeros(len(text.start) + texts + 1, U)
        self.words[self.word] = text.hash
        self.separator = np.ones(len(self.words), bool)
        self.separator[self.word] = False
        windows_of = np.maximum(self.count - width + 1, 0)
        self.owner = np.repeat(np.arange(texts), windows_of)
        within = np.arange(len(self.owner)) - np.repeat(np.cumsum(windows_of) - windows_of, windows_of)
        self.first = text.first[:-1][self.owner] + self.owner + 1 + within
        self.file = self.name = self.digest = self.file_owner = np.zeros(0, np.int64)
        if not len(self.first):
            return
        name, start = filed(self.words, self.separator, self.first, width)
        bucket = max(1, width // BUCKETS)
        offset = (start - self.first) // bucket
        new = np.zeros(len(name), bool)
        new[0] = True
        for c in (start, name, self.owner, offset):
            new[1:] |= c[1:] != c[:-1]
        self.file = np.cumsum(new) - 1
        opens = np.flatnonzero(new)
        windows_in = np.diff(np.append(opens, len(new)))
        begin, core, self.file_owner = self.first[opens], (start - offset * bucket)[opens], self.owner[opens]
        within_all = self._span_hash(core, core + width - bucket + 1)
        self.name = mix(name[opens] * _PAIR + within_all + U(3) * offset[opens].astype(U), 4)
        span = self._span_hash(begin, begin + windows_in + width - 1)
        self.digest = mix(span + U(3) * (core - begin).astype(U) + (windows_in.astype(U) << U(40)), 5)

    def _span_hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        power, unpower = textbytes._powers(len(self.words) + 1)
        sums = np.zeros(len(self.words) + 1, U)
        np.cumsum(self.words * power[: len(self.words)], out=sums[1:])
        return mix((sums[end] - sums[begin]) * unpower[begin], 3)

    def window_names(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128-bit names of the chosen windows, as two columns."""
        at = self.first[chosen]
        return tuple(windows(self.words, self.width, seed)[at] for seed in (21, 22))

    def kept(self, settled: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """(words removed, text of the words kept, one blank between) of every text, given the settled windows."""
        edge = np.zeros(len(self.words) + 1, np.int64)
        edge[self.first[settled]] += 1
        edge[self.first[settled] + self.width] -= 1
        keep = np.cumsum(edge)[self.word] == 0
        text, owner = self.text, np.repeat(np.arange(len(self.count)), self.count)
        removed = np.bincount(owner[~keep], minlength=len(self.count))
        size = text.end - text.start
        out_size = np.where(keep, size + 1, 0)
        ends = np.concatenate([[0], np.cumsum(out_size)])
        out = np.full(ends[-1], 32, np.uint8)
        byte_kept = np.repeat(keep, size)
        target = np.repeat(ends[:-1] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        out[target[byte_kept]] = text.data[text.filled][byte_kept]
        cuts = ends[text.first].tolist()
        return removed, [out[a : max(a, b - 1)].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


SALTS = 16
ABSENT = (1 << 63) - 1


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _salt(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))


def _counted(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per key: smallest and largest id, and the salts that occur."""
    return rows.groupBy(*by).agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.bit_or(F.expr("shiftleft(1, salt)")).alias("salts"))


def _dealt(counted: DataFrame) -> DataFrame:
    """One copy of each counted row per salt that occurs in it."""
    present = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.getbit("salts", s) == 1)
    return counted.withColumn("salt", F.explode(present)).drop("salts")


def _files(docs: DataFrame, width: int) -> DataFrame:
    """(name, digest, doc, salt) of the files of every text, each once a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = _column(batch, "doc").to_numpy()
            for row, data, offsets in textbytes.blocks(_column(batch, "text")):
                block = Block(data, offsets, width)
                if not len(block.name):
                    continue
                rows = np.stack([block.file_owner.astype(U), block.name, block.digest], 1)
                owner, name, digest = np.unique(rows, axis=0).T
                ids = doc[row + owner.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([*map(_signed, (np.ascontiguousarray(name), np.ascontiguousarray(digest))), pa.array(ids)], names=["name", "digest", "doc"])

    return _salt(docs.mapInArrow(run, "name long, digest long, doc long"))


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all entries of a list column."""
    column = _column(batch, name)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    length = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(column)), length), values


def _among(owner: np.ndarray, value: np.ndarray, row: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Which (owner, value) pairs occur among the (row, entry) pairs."""
    if not len(entry) or not len(value):
        return np.zeros(len(value), bool)
    seed = lambda a, b: mix(a.astype(U) * _PAIR + mix(b.view(U) if b.dtype != U else b, 31), 32)
    return np.isin(seed(owner, value), seed(row, entry))


def _listed(docs: DataFrame, width: int) -> DataFrame:
    """(w1, w2, doc, salt) of the windows in the files whose digest is in the text's list ``open``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, (of, open_) = _column(batch, "doc").to_numpy(), _lists(batch, "open")
            for row, data, offsets in textbytes.blocks(_column(batch, "text")):
                block = Block(data, offsets, width)
                hit = _among(row + block.file_owner, block.digest, of, open_)
                chosen = np.flatnonzero(hit[block.file]) if len(block.file) else np.zeros(0, np.int64)
                if not len(chosen):
                    continue
                w1, w2 = block.window_names(chosen)
                yield pa.RecordBatch.from_arrays([_signed(w1), _signed(w2), pa.array(doc[row + block.owner[chosen]])], names=["w1", "w2", "doc"])

    return _salt(docs.mapInArrow(run, "w1 long, w2 long, doc long"))


def remove_repeats(docs: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every text without the words of windows that also start under a smaller id.

    ``kept`` has the remaining words joined by one blank. One row per row of ``docs``.
    """
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(ABSENT)).alias("doc")
    texts = docs.select(F.col(id_col).alias("doc_id"), doc, F.col(text_col).cast("string").alias("text"))
    # The two steps that need texts beside what is known of their id share this one exchange.
    by_id = texts.repartition("doc")
    files = stored(_files(texts.select("doc", "text"), width), "filed")
    names = _dealt(_counted(files, ["name"]).where("least < most").select("name", "salts"))
    shared = stored(files.join(names, ["name", "salt"]), "files")
    groups = stored(_counted(shared, ["name", "digest"]), "digests")
    several = groups.groupBy("name").agg((F.count(F.lit(1)) > 1).alias("several"))
    groups = groups.join(several, "name").where("several or least < most").select("name", "digest", "least", "several", "salts")
    seen = shared.join(_dealt(groups), ["name", "digest", "salt"]).select(
        "doc", "digest", (F.col("least") < F.col("doc")).alias("settled"), "several"
    )
    seen = stored(seen.where("settled or several"), "seen")
    opened = seen.where("not settled").groupBy("doc").agg(F.collect_set("digest").alias("open"))
    listed = _listed(by_id.join(stored(opened, "open"), "doc"), width)
    twice = _dealt(_counted(listed, ["w1", "w2"]).where("least < most"))
    repeated = listed.join(twice, ["w1", "w2", "salt"]).where("least < doc").select("doc", F.col("w1").alias("digest"), F.lit(True).alias("window"))
    marks = seen.where("settled").select("doc", "digest", F.lit(False).alias("window")).unionByName(repeated)
    one = lambda which: F.collect_set(F.when(which, F.col("digest")))
    marks = marks.groupBy("doc").agg(one(~F.col("window")).alias("files"), one(F.col("window")).alias("windows"))
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (of, files_), (of_w, windows_) = _lists(batch, "files"), _lists(batch, "windows")
            for row, data, offsets in textbytes.blocks(_column(batch, "text")):
                block = Block(data, offsets, width)
                texts_in = len(block.count)
                settled = np.zeros(len(block.first), bool)
                if len(block.first):
                    settled = _among(row + block.file_owner, block.digest, of, files_)[block.file]
                    inside = (of_w >= row) & (of_w < row + texts_in)
                    if inside.any():
                        some = np.flatnonzero(np.isin(row + block.owner, of_w[inside]))
                        settled[some] |= _among(row + block.owner[some], block.window_names(some)[0], of_w, windows_)
                removed, kept = block.kept(settled)
                ids = _column(batch, "doc_id").slice(row, texts_in)
                arrays = [ids, pa.array(block.count.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept"])

    beside = by_id.join(marks, "doc", "left").select("doc_id", "text", "files", "windows")
    return beside.mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, kept string")


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""with texts as (
  select doc_id, row_number() over () as row_, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
starts as (select doc_id, row_, words, unnest(range(1, cast(len(words) as bigint) - 48)) as i from texts where len(words) >= 50),
names as (select doc_id, row_, i, md5_number(array_to_string(words[i:i + 49], ' ')) as w from starts),
least as (select w, min(doc_id) as first_ from names group by w),
gone as (select distinct row_, unnest(range(i, i + 50)) as p from names join least using (w) where first_ < doc_id),
marks as (select row_, list(p) as gone from gone group by row_),
words_ as (select row_, unnest(words) as word, unnest(range(1, cast(len(words) as bigint) + 1)) as p from texts),
kept as (select row_, string_agg(word, ' ' order by p) as kept from words_ anti join gone using (row_, p) group by row_)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256 from texts left join marks using (row_) left join kept using (row_)"""
