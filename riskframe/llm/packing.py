"""Packing documents into token sequences by best-two-fit.

Documents are tokenised, ended with an end id, and cut only where they are longer than a sequence. The plan of the
bins depends on how many pieces there are of each length, a table of at most ``capacity`` rows however large the
corpus is. On it runs best-two-fit: a bin takes the longest piece that still fits, again and again; then its
shortest piece gives way to two unpacked pieces when they fill the widened gap more tightly. A filling is repeated
while its lengths last, so the plan has few distinct fillings. Spark then numbers the pieces of each length and
each number finds its place in the plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stored, worker_store
from riskframe.llm.textbytes import LOWER, Words, blocks

CAPACITY = 2048
# Pieces of one length that one task numbers.
CELL_ROWS = 200_000
# Words that a task's cache holds in each of its two generations.
CACHE_WORDS = 120_000
# Bytes of text that are tokenised together.
BLOCK_BYTES = 3_000_000


class WordIds(dict):
    """UTF-8 piece of a text -> its token ids as little-endian uint32 bytes.

    The tokenizer splits at blanks before anything else, so a text's ids are the ids of its words in turn. A word of
    plain Latin letters with ASCII punctuation behind it is two pieces, which never merge; such letter runs are one
    token group each, whose last token carries the word-end mark, so many are encoded as one text.
    Two generations bound the memory: pieces of the older one that are met again move to the newer.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        super().__init__()
        from tokenizers import Tokenizer

        self.model, self.limit, self.old = Tokenizer.from_file(path), limit, {}
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def one(self, piece: bytes) -> bytes:
        return np.array(self.model.encode(piece.decode("utf-8"), add_special_tokens=False).ids, "<u4").tobytes()

    def runs(self, cores: list[bytes]) -> Iterator[bytes]:
        """Ids of each Latin letter run."""
        for at in range(0, len(cores), 2000):
            some = cores[at : at + 2000]
            ids = np.array(self.model.encode(b" ".join(some).decode("utf-8"), add_special_tokens=False).ids, "<u4")
            stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(stops) != len(some) or stops[-1] != 4 * len(ids):
                yield from (self.one(c) for c in some)
                continue
            raw, begin = ids.tobytes(), 0
            for stop in stops.tolist():
                yield raw[begin:stop]
                begin = stop

    def all(self, pieces: list[bytes], letters: list[bool]) -> list[bytes]:
        """Ids of distinct pieces; ``letters`` marks the Latin letter runs. The older generation goes when the newer is full."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        found = list(map(self.get, pieces))
        new = [k for k, ids in enumerate(found) if ids is None]
        for k in new:
            found[k] = self.old.get(pieces[k])
        runs = [k for k in new if found[k] is None and letters[k]]
        for k, ids in zip(runs, self.runs([pieces[k] for k in runs]), strict=True):
            found[k] = ids
        for k in new:
            if found[k] is None:
                found[k] = self.one(pieces[k])
            self[pieces[k]] = found[k]
        return found


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_TAIL = np.zeros(256, bool)
_TAIL[list(b".,;:!?*#%&$|()\"-")] = True


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, start, end, is a letter run, word) of the pieces of a block, in text order."""
    words = Words(data, offsets)
    letter = _LETTER[data]
    if len(data) > 1:
        # the letters of U+00C0 to U+00FF are two bytes, but for the two signs among them
        lead = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        letter[:-1] |= lead
        letter[1:] |= lead
    n_letters, n_tail = (np.concatenate([[0], np.cumsum(x)]) for x in (letter, _TAIL[data]))
    s, e = words.start, words.end
    run = n_letters[e] - n_letters[s]
    plain = run + n_tail[e] - n_tail[s] == e - s
    plain &= (run > 0) & (n_letters[s + run] - n_letters[s] == run)
    cut = plain & (run < e - s)
    count = 1 + cut
    at = np.cumsum(count) - count
    start = np.empty(int(count.sum()), np.int64)
    end, is_run = start.copy(), np.zeros(len(start), bool)
    start[at], end[at], is_run[at] = s, np.where(cut, s + run, e), plain
    start[at[cut] + 1], end[at[cut] + 1] = s[cut] + run[cut], e[cut]
    # letter runs are looked up in lower case; other pieces as they stand, since special tokens keep their case
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start[is_run]] += 1
    inside[end[is_run]] -= 1
    words.data = np.where(np.cumsum(inside[:-1], dtype=np.int8) > 0, LOWER[data], data)
    return words, start, end, is_run, at


def text_ids(data: np.ndarray, offsets: np.ndarray, known: WordIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts of a block, each with the end id behind; where each text's ids begin, and the end)."""
    words, start, end, is_run, at = _pieces(data, offsets)
    _, first, which = np.unique(words.spans_hash(start, end), return_index=True, return_inverse=True)
    raw = words.data.tobytes()
    pieces = [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    found = known.all(pieces, is_run[first].tolist())
    length = np.array([len(x) // 4 for x in found] + [1], np.int64)
    table = np.frombuffer(b"".join(found) + np.array([end_id], "<u4").tobytes(), "<u4")
    begin = np.cumsum(length) - length
    # the end id as a last piece of every text
    stops = np.append(at, len(start))[words.first[1:]]
    order = np.insert(which, stops, len(found))
    size = length[order]
    after = np.cumsum(size)
    ids = table[np.repeat(begin[order] - after + size, size) + np.arange(after[-1] if len(after) else 0)]
    bounds = np.concatenate([[0], after[stops + np.arange(len(stops))]])
    return ids, bounds


def _tokenize(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_store("word ids", path, lambda: WordIds(path))
        for batch in batches:
            for row, data, offsets in blocks(batch.column(1), BLOCK_BYTES):
                ids, bounds = text_ids(data, offsets, known, end_id)
                n = np.diff(bounds)
                count = -(-n // capacity)
                text = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
                length = np.minimum(capacity, n[text] - piece * capacity)
                # pieces lie in order and without gaps in ``ids``
                edge = np.concatenate([[0], 4 * np.cumsum(length)]).astype(np.int64)
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(text), [None, pa.py_buffer(edge), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + text)), pa.array(piece, pa.int32()), pa.array(piece * capacity), pa.array(length), raw.cast(pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    return run


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every row of ``docs`` (needs doc_id, text; other columns are ignored).

    ``tokenizer`` is the path of a tokenizers file that splits at blanks; ``ids`` are unsigned little-endian 32-bit.
    Null and blank texts are the end id alone. A null or repeated doc_id is tokenised like any other row.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return docs.mapInArrow(_tokenize(tokenizer, capacity, end_id), "doc_id long, piece int, start long, length long, ids binary")


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Plan of bins: (number of bins, pieces of each length in one such bin), using every piece of ``counts`` once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    lengths = np.arange(capacity + 1)
    plan = []
    while True:
        present = np.maximum.accumulate(np.where(left > 0, lengths, 0))  # the longest left at or under a length
        if not present[capacity]:
            return plan
        used: dict[int, int] = {}

        def longest(gap: int, skip: dict[int, int]) -> int:
            at = int(present[gap]) if gap > 0 else 0
            while at and left[at] - skip.get(at, 0) <= 0:
                at = int(present[at - 1])
            return at

        gap = capacity
        while piece := longest(gap, used):
            take = min(gap // piece, int(left[piece]) - used.get(piece, 0))
            used[piece] = used.get(piece, 0) + take
            gap -= take * piece
        smallest = min(used)
        if gap and sum(used.values()) > 1:
            wide = gap + smallest
            rest = dict(used)
            rest[smallest] -= 1
            best = (smallest, 0, 0)
            for x in range(int(present[wide - 1]) if wide > 1 else 0, wide // 2 - 1, -1):
                if best[0] == wide:
                    break
                if x <= 0 or left[x] - used.get(x, 0) <= 0:
                    continue
                y = longest(min(wide - x, x), used | {x: used.get(x, 0) + 1})
                if y and x + y > best[0]:
                    best = (x + y, x, y)
            if best[1]:
                used = {k: v for k, v in rest.items() if v}
                for k in best[1:]:
                    used[k] = used.get(k, 0) + 1
        times = min(int(left[k]) // v for k, v in used.items())
        for k, v in used.items():
            left[k] -= times * v
        plan.append((times, used))


def _slots(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces in a sequence, offset), ordered by length and rank."""
    rows, next_rank, sequence = [], {}, 0
    for times, used in plan:
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            first = next_rank.get(length, 0)
            rows.append((length, first, sequence, n, offset))
            next_rank[length] = first + times * n
            offset += length * n
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(slots: np.ndarray, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = slots[:, 0] * (1 << 48) + slots[:, 1]
        for batch in batches:
            at = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
            length, rank = (at[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in ("length", "rank__"))
            _, first, sequence, n, offset = slots[np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1].T
            turn = rank - first
            yield pa.RecordBatch.from_arrays(
                [*[at[c] for c in names], pa.array(sequence + turn // n), pa.array(offset + turn % n * length)],
                [*names, "sequence_id", "offset"],
            )

    return run


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every row of ``pieces`` (needs doc_id, piece, length from 1 to ``capacity``).

    The other columns go along. An empty table gives an empty table. Lengths outside the range are an error.
    """
    pieces = stored(pieces, "pieces")
    names = pieces.columns
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"Piece lengths must be from 1 to {capacity}")
    slots = _slots(best_two_fit(counts, capacity))
    cells = [1] * (capacity + 1)
    for length, n in counts.items():
        cells[length] = -(-n // CELL_ROWS)
    many = F.element_at(F.array(*[F.lit(c) for c in cells[1:]]), F.col("length").cast("int")) if max(cells) > 1 else F.lit(1)
    dealt = pieces.withColumn("cell__", F.pmod(F.xxhash64("doc_id", "piece"), many.cast("long")).cast("int"))
    per_cell = dealt.groupBy("length", "cell__").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("cell__")) - F.col("count")
    offsets = per_cell.select("length", "cell__", before.alias("before__"))
    inside = Window.partitionBy("length", "cell__").orderBy("doc_id", "piece")
    ranked = dealt.withColumn("number__", F.row_number().over(inside) - 1).join(offsets, ["length", "cell__"])
    ranked = ranked.select(*names, (F.col("number__") + F.col("before__")).alias("rank__"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema] + ["sequence_id long", "offset long"]
    return ranked.mapInArrow(_place(slots, names), ", ".join(schema))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """Tokenised pieces of all documents with their places; ``keep_ids=False`` keeps a CRC-32 of the ids in their stead."""
    pieces = tokenize(docs, tokenizer, capacity, end_id)
    if not keep_ids:
        pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return place(pieces, capacity)
