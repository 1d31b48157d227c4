"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a row of tokens: words and tags. Words of running text score above zero, tags and words of menus, notes
and the like below; one linear scan finds the contiguous run with the highest sum, which is the article. The weights
are log odds of token kinds inside and outside the marked article, counted over labelled pages: those whose author
marked the article with its own tag. Inside the run, elements that are no part of an article are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Labelled pages that the weights are counted on, at most about.
TRAIN_PAGES = 5_000
# Published unsupervised weights, for token kinds that the labelled pages do not show.
WORD, TAG = 1.0, -3.25
BOUND = 6.0

# A tag's quoted values may hold ">"; the last alternative takes what only looks like the start of a tag.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?([a-zA-Z][^\s/<>\"']*)([^<>\"']*(?:\"[^\"<]*\"[^<>\"']*|'[^'<]*'[^<>\"']*)*)>|<(?=/?[a-zA-Z])", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*)")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe")}
# Element names by what they mean for the text.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_OUTSIDE = frozenset("nav header footer aside form button select option menu head script style noscript template svg iframe canvas textarea title".split())
_MARKED = ("article", "main")
# Names in a class, id or role of what is no part of an article: whole names, whose parts may be joined with each other
# and with words of place ("site-footer", "cookie-notice"; not "has-sidebar", "search-engine").
_COMMENTS = r"comments?|disqus|replies"
_OUTSIDE_WORD = rf"(?:nav(?:bar|igation)?|menu|header|masthead|footer|sidebar|side|aside|ad|ads|advert(?:isement)?|advertising|sponsor(?:ed)?|promo|banner|cookies?|consent|notice|popup|modal|newsletter|subscribe|signup|{_COMMENTS}|share|social|related|breadcrumbs?|pagination|pager|widget|complementary|contentinfo|search|login|toolbar|skip)"
_PLACE = r"(?:site|main|left|right|top|bottom|primary|secondary|global|list|links?|buttons?|box|bar)"
_OUTSIDE_NAME = re.compile(rf"(?<!\S)(?:{_PLACE}[_-]+)*{_OUTSIDE_WORD}(?:[_-]+(?:{_OUTSIDE_WORD}|{_PLACE}))*(?!\S)", re.I)
_COMMENT_NAME = re.compile(rf"(?<![^\s_-])(?:{_COMMENTS})(?![^\s_-])", re.I)
# For Spark: pages that may have a marked article.
_HAS_MARK = r"(?i)<(article|main)[\s/>]"
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _named_outside(attributes: str) -> str:
    """The first name that leads outside, or an empty text."""
    found = (_OUTSIDE_NAME.search(a or b or c) for a, b, c in _NAMES.findall(attributes))
    return next((m[0] for m in found if m), "")


# An item is (kind of token, number of words or 1 for a tag, text or None for a tag, is part of an article, breaks a block, in a marked article)
Item = tuple[str, int, str | None, bool, bool, bool]


def items(page: str) -> list[Item]:
    """Tokens of a page in order; the words of one stretch of text are one item."""
    out: list[Item] = []
    open_: list[tuple[str, int | None, int]] = []  # (tag, change of ``named``, or None where the element leads outside for good, place of the innermost block from here)
    depth: Counter = Counter()
    # elements around that lead outside; those that do so by their name give way to a marked article in them
    outside = named = marked = 0
    at = 0

    def close() -> str:
        nonlocal outside, named, marked
        t, change, _ = open_.pop()
        depth[t] -= 1
        if change is None:
            outside -= 1
        else:
            named -= change
        marked -= t in _MARKED
        return t

    def text(raw: str) -> None:
        words = len(raw.split())
        around = "a" if depth["a"] else open_[open_[-1][2]][0] if open_ and open_[-1][2] >= 0 else ""
        inside = not outside and not named
        kind = "word" if inside else "outside word"
        if words or raw:
            out.append((f"{kind} {around}", words, raw, inside, False, marked > 0))

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m[0] == "<":
            # a tag with odd quotes or one that never ends
            end = page.find(">", at)
            if end < 0:
                break
            at = end + 1
            name, attributes = _NAME.match(page, m.start(), end + 1).groups()
        elif not m[1]:
            continue
        else:
            name, attributes = m[1], m[2]
        tag = name.lower()
        closing = page[m.start() + 1] == "/"
        if tag in _RAW_END and not closing:
            # its content is no markup
            end = _RAW_END[tag].search(page, at)
            out.append((f"tag {tag}", 1, None, False, True, marked > 0))
            at = end.end() if end else len(page)
            continue
        if closing:
            while depth[tag]:
                t = close()
                if t == tag:
                    break
            out.append((f"tag /{tag}", 1, None, not outside and not named, tag not in _INLINE, marked > 0 or tag in _MARKED))
            continue
        if tag in ("p", "li") and depth[tag]:
            # an open one ends where the next begins, unless another block lies between
            above = open_[-1][2]
            while tag == "li" and above >= 0 and open_[above][0] == "p":
                above = open_[above - 1][2] if above else -1
            if above >= 0 and open_[above][0] == tag:
                while close() != tag:
                    pass
        change = None
        if tag not in _OUTSIDE or (tag == "header" and marked):
            name = "" if tag in ("html", "body", *_MARKED) else _named_outside(attributes)
            if not _COMMENT_NAME.search(name):
                # the outermost article is one whatever is around it is called
                change = 1 if name else -named if tag in _MARKED and not marked else 0
        if tag not in _VOID and not attributes.endswith("/"):
            open_.append((tag, change, len(open_) if tag not in _INLINE else open_[-1][2] if open_ else -1))
            depth[tag] += 1
            if change is None:
                outside += 1
            else:
                named += change
            marked += tag in _MARKED
        out.append((f"tag {tag}", 1, None, not outside and not named, tag not in _INLINE, marked > 0))
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """(begin, end) of the contiguous run with the highest sum; the first of equals, empty when nothing is above zero."""
    best, begin, end = 0.0, 0, 0
    total, start = 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, begin, end = total, start, k + 1
    return begin, end


def score(item: Item, weights: dict[str, float]) -> float:
    kind, n = item[0], item[1]
    known = weights.get(kind)
    if known is None:
        known = (WORD if kind.startswith("word") else -WORD) if item[2] is not None else TAG
    return known * n


def main_text(page: str, weights: dict[str, float]) -> str:
    found = items(page)
    begin, end = best_run([score(i, weights) for i in found])
    parts = []
    for _, _, raw, inside, breaks, _ in found[begin:end]:
        if raw is not None:
            if inside:
                parts.append(html.unescape(raw))
        elif breaks:
            parts.append(" ")
    return " ".join("".join(parts).split())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: html -> (kind, inside, n) of pages with a marked article, summed within a batch."""
    for batch in batches:
        counts: Counter = Counter()
        for page in batch.column(0):
            found = items(page.as_py() or "")
            if any(i[5] for i in found):
                for kind, n, *_, marked in found:
                    counts[kind, marked] += n
        rows = [(k, inside, n) for (k, inside), n in counts.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.int64())], ["kind", "inside", "n"]
        )


def learn(pages: DataFrame, train_pages: int = TRAIN_PAGES, seed: int = 2) -> dict[str, float]:
    """Weight of each token kind, from about ``train_pages`` seeded pages with a mark at most; kinds seen fewer than five times get none."""
    pages = pages.where(F.col("html").cast("string").rlike(_HAS_MARK))
    rows = pages.count()
    share = min(1.0, train_pages / max(1, rows))
    dealt = F.pmod(F.xxhash64("page_id", F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    counted = pages.where(dealt).select(F.col("html").cast("string").alias("html")).mapInArrow(_count, "kind string, inside boolean, n long")
    table = counted.groupBy("kind").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("b"))
    found = table.where("a + b >= 5").orderBy(F.desc(F.col("a") + F.col("b")), "kind").limit(2_000).collect()
    inside, outside = sum(r["a"] for r in found) + 1.0, sum(r["b"] for r in found) + 1.0
    return {r["kind"]: max(-BOUND, min(BOUND, math.log((r["a"] + 0.5) / inside) - math.log((r["b"] + 0.5) / outside))) for r in found}


def _extract(weights: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py() or "", weights) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (needs page_id, url, html).

    Character references are decoded, white space inside a block is one space, blocks are joined by one space.
    Null or empty html, or a page without running text: empty text. Null and repeated ids are rows like any other.
    An empty table gives an empty table. Without marked pages the published weights hold.
    """
    if weights is None:
        weights = learn(pages)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract(weights), "page_id long, url string, text string, n_chars long")
