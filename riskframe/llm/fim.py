"""Fill-in-the-middle transformation of whole texts as a pyarrow.compute pipeline.

A text is cut into units (blanks before a word belong to it). Two seeded cuts part the units into prefix, middle and
suffix, which are written behind sentinels in the order prefix-suffix-middle (``psm``) or suffix-prefix-middle
(``spm``); other texts stay ``plain``. Each Arrow batch is worked on as columns: units become list arrays, flattened
with the index of their parent; ordinals inside the parent decide the role; each role is filtered, rebuilt as lists
and joined to one piece a text. Texts go through in blocks of about ``BLOCK_BYTES``, so memory is bounded by a block
and the longest single text. There is no shuffle: a row depends on its own text and id only, so any retry agrees.

Null text counts as empty, and an empty text is plain with 0 units; a text of blanks only has one unit. A text that
contains a sentinel is plain, since it could not be told apart afterwards. Equal rows give equal rows; a null id is
hashed as an empty id. Only the id and text columns are read, so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
BLOCK_BYTES = 4 << 20
# Ends a unit while units are being told apart: this byte occurs in no UTF-8 text.
END = b"\xff"
NOTHING = pa.scalar(b"", pa.large_binary())


def _modulo(a: pa.Array, m: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, m), m))


def _starts(counts: pa.Array) -> pa.Array:
    """Offsets of lists of the given lengths."""
    return pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(counts).cast(pa.int32())])


def _rebuilt(units: pa.Array, ordinal: pa.Array, parent: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """One piece a parent: its units from ordinal ``low`` to before ``high``, joined."""
    role = pc.and_(pc.greater_equal(ordinal, pc.take(low, parent)), pc.less(ordinal, pc.take(high, parent)))
    lists = pa.ListArray.from_arrays(_starts(pc.subtract(high, low)), pc.filter(units, role))
    return pc.binary_join(lists, NOTHING)


def _arranged(text: pa.Array, count: pa.Array, h1: pa.Array, h2: pa.Array, spm: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(output, prefix, middle) of texts that are not plain."""
    bounded = pc.replace_substring_regex(text, ("(" + UNIT + ")").encode(), rb"\1" + END)
    lists = pc.split_pattern(bounded, END)
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    first = lists.offsets.slice(0, len(lists)).cast(pa.int64())
    place = pa.array(np.arange(len(units), dtype=np.int64))
    ordinal = pc.subtract(place, pc.subtract(pc.take(first, parent), first[0]))
    cuts = pc.add(count, 1)
    a, b = _modulo(h1, cuts), _modulo(h2, cuts)
    low, high, none = pc.min_element_wise(a, b), pc.max_element_wise(a, b), pc.multiply(count, 0)
    prefix = _rebuilt(units, ordinal, parent, none, low)
    middle = _rebuilt(units, ordinal, parent, low, high)
    suffix = _rebuilt(units, ordinal, parent, high, count)
    p, s, m = (pa.scalar(x.encode(), pa.large_binary()) for x in (PREFIX, SUFFIX, MIDDLE))
    as_psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, NOTHING)
    as_spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, NOTHING)
    return pc.if_else(spm, as_spm, as_psm), prefix, middle


def _length(pieces: pa.Array) -> pa.Array:
    return pc.utf8_length(pieces.cast(pa.large_string())).cast(pa.int64())


def _block(rows: pa.RecordBatch, fim_percent: int, spm_percent: int) -> pa.RecordBatch:
    text = pc.fill_null(rows.column("text").cast(pa.large_binary()), b"")
    h1, h2, h3, h4 = (rows.column(f"h{k}") for k in range(1, 5))
    hundred = pa.array([100] * len(text), pa.int64())
    count = pc.count_substring_regex(text, UNIT.encode()).cast(pa.int64())
    marked = pc.match_substring_regex(text, b"<[PSM]>")
    plain = pc.or_(pc.or_(pc.equal(count, 0), marked), pc.greater_equal(_modulo(h3, hundred), fim_percent))
    spm = pc.less(_modulo(h4, hundred), spm_percent)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    chosen = pc.invert(plain)
    output, prefix_chars, middle_chars = text, pa.nulls(len(text), pa.int64()), pa.nulls(len(text), pa.int64())
    if pc.any(chosen).as_py():
        arranged, prefix, middle = _arranged(*[pc.filter(c, chosen) for c in (text, count, h1, h2, spm)])
        output = pc.replace_with_mask(text, chosen, arranged)
        prefix_chars = pc.replace_with_mask(prefix_chars, chosen, _length(prefix))
        middle_chars = pc.replace_with_mask(middle_chars, chosen, _length(middle))
    columns = [rows.column("doc_id"), count, form.cast(pa.string()), prefix_chars, middle_chars, output.cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _blocks(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``BLOCK_BYTES`` of text, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(rows.column("text")), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > BLOCK_BYTES:
            yield rows.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield rows.slice(start)


def transform(
    docs: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    Random numbers are the first four 8-digit groups of the SHA-256 of ``seed:id``: the first two choose the cuts, the
    third the texts that are rearranged (``fim_percent`` of them), the fourth the order (``spm`` for ``spm_percent``).
    Lengths are in code points and null for plain texts.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    group = lambda k: F.conv(F.substring("__key", 8 * k - 7, 8), 16, 10).cast("long").alias(f"h{k}")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), key.alias("__key"))
    rows = rows.select("doc_id", "text", *[group(k) for k in range(1, 5)])
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch):
                yield _block(part, fim_percent, spm_percent)

    schema = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, schema)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that an output was made of, from output and form alone; null output or form gives null.

    Texts with sentinels stay plain, so the first occurrence of a sentinel is always the one that was written.
    """
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    rest = F.substr(output, F.lit(len(PREFIX) + 1))
    head, middle = F.substring_index(rest, MIDDLE, 1), F.substring_index(rest, MIDDLE, -1)
    psm = F.concat(F.substring_index(head, SUFFIX, 1), middle, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), middle, F.substring_index(head, PREFIX, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)


def digests(made: DataFrame) -> DataFrame:
    """Digest columns of ``transform``'s rows in place of the texts."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha(F.col("output")).alias("output_sha256"), sha(restored()).alias("restored_sha256"),
    )


SQL = r"""with h as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id) as k,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units from documents),
g as (select *, cast(len(units) as bigint) as n, cast('0x' || k[1:8] as bigint) as h1, cast('0x' || k[9:16] as bigint) as h2,
    cast('0x' || k[17:24] as bigint) as h3, cast('0x' || k[25:32] as bigint) as h4 from h),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as lo, greatest(h1 % (n + 1), h2 % (n + 1)) as hi,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
      when h4 % 100 < 80 then 'spm' else 'psm' end as form from g),
p as (select *, coalesce(array_to_string(units[1:lo], ''), '') as p, coalesce(array_to_string(units[lo + 1:hi], ''), '') as m,
    coalesce(array_to_string(units[hi + 1:n], ''), '') as s from c)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(text) as restored_sha256 from p"""
