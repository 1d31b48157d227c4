"""Personal data in texts by aggregated weak labels, in DataFrame functions only.

Patterns propose candidate spans. Labelers vote on each: the strict pattern with its checks, a gazetteer of endings,
issuers and country codes, the words in front, and the span's shape. Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is and how likely each pattern is personal data; these likelihoods
train a logistic span classifier. Spans of the strict patterns always count; of the looser candidates those count
that the classifier accepts and that touch no strict span. The counts that reach the driver are one row per kind
and vote pattern, at most 4 * 3^4, whatever the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "gazetteer", "context", "shape")
ACCEPT = 0.9

# The strict patterns. Runs are possessive, so that long texts need no recursion; the address pattern
# starts only where a run of its characters starts or where the last match ended, which finds the same matches.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser forms of the same data, each kept short by its counts.
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]{1,63}){1,5}",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.])[0-9]{4}[./][0-9]{4}[./][0-9]{4}[./][0-9]{4}(?![0-9.])|(?<![0-9-])3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}(?![0-9-])",
    "phone": r"(?<![0-9+.-])(?:00[1-9][0-9]{0,2}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
}
# What a text must hold before the patterns of a kind are tried.
HINT = {"email": r"@|\(at\)|\[at\]", "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]", "card": r"[0-9][\x20./-]?[0-9][\x20./-]?[0-9][\x20./-]?[0-9]", "phone": r"\+[0-9]|[0-9]{3}[.-][0-9]{4}"}
# Gazetteers and context words (fixed values).
ENDINGS = "com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|eu|us|ca|ch|at|mx|ar|be|pt|pl"
COUNTRY_CODES = "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|54|55|56|57|61|64|65|81|82|86|90|91|351|352|353|358|420"
BEFORE = {
    "email": r"\b(?:e-?mail|mail|contact|write|kontakt|correo|courriel)\b",
    "ip": r"\b(?:ip|host|server|address|adresse|from|login)\b",
    "card": r"\b(?:card|visa|mastercard|credit|karte|carte|tarjeta)\b",
    "phone": r"\b(?:call|phone|tel|telephone|fax|mobile|telefon|appelez|llame)\b",
}
AGAINST = r"\b(?:version|isbn|issn|serial|order|part|section|id|no|nr)\b[^a-z]*$"
CONTEXT_CHARS = 30


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, hit) in code points: the pieces between the matches give the places of the matches."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string>>").alias("found"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        one = F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("hit"))
        return F.when(pair["hit"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.concat(acc["found"], F.array(one)).alias("found")))

    return F.when(F.size(hits) > 0, F.aggregate(pairs, none, step)["found"])


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: p.cast("double") <= 255)
    digits = _digits(hit)
    n = F.length(digits)
    return n.between(16, 19) & F.when(n.between(16, 19), _luhn(digits)).otherwise(False) if kind == "card" else n.between(8, 15)


def _vote(yes: Column, no: Column) -> Column:
    """1, 0 or -1 (abstains)."""
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _votes(kind: str, text: Column, span: Column, strict: bool) -> list[Column]:
    hit, digits = span["hit"], _digits(span["hit"])
    begin = F.greatest(F.lit(0), span["start"] - CONTEXT_CHARS)
    front = F.lower(F.substr(text, begin + 1, span["start"] - begin))
    known = {
        "email": F.lower(hit).rlike(rf"[.)\]]\x20?(?:{ENDINGS})$"),
        "ip": ~hit.rlike(r"^(?:0+|127|22[4-9]|2[3-5][0-9])\."),
        "card": digits.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"),
        "phone": digits.rlike(rf"^(?:00)?(?:{COUNTRY_CODES})") & hit.rlike(r"^(?:\+|00)"),
    }[kind]
    shaped = {
        "email": F.length(hit) <= 254,
        "ip": ~hit.rlike(r"(?:^|\.)0[0-9]"),
        "card": hit.rlike(r"^(?:[0-9]{15,19}|[0-9]{4}([\x20./-])[0-9]{4}\1[0-9]{4}\1[0-9]{4,7}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5})$"),
        "phone": F.length(digits).between(9, 13),
    }[kind]
    return [F.lit(1 if strict else 0), _vote(known, ~known), _vote(front.rlike(BEFORE[kind]), front.rlike(AGAINST)), _vote(shaped, ~shaped)]


def _kind_candidates(df: DataFrame, text: Column, k: int, kind: str, kind_type: str) -> DataFrame:
    strict, loose, base = f"strict_{kind}__", f"loose_{kind}__", f"base_{kind}__"
    hinted = text.rlike(HINT[kind])

    def span(s: Column, is_base: bool) -> Column:
        votes = F.array(*[v.cast("int") for v in _votes(kind, text, s, is_base)])
        return F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(is_base).alias("base"), votes.alias("votes"))

    df = df.withColumns({strict: F.when(hinted, _matches(text, STRICT[kind])), loose: F.when(hinted, _matches(text, LOOSE[kind]))})
    good = F.transform(F.filter(F.col(strict), lambda s: _valid(kind, s["hit"])), lambda s: span(s, True))
    more = F.transform(F.col(loose), lambda s: span(s, False))
    none = F.array().cast(kind_type)
    return df.withColumns({base: F.coalesce(good, none), loose: F.coalesce(more, none)}).drop(strict)


def with_candidates(df: DataFrame, text: str, out: str = "spans__") -> DataFrame:
    """Add ``out``: candidate spans (kind, start, end, base, votes) of the string column ``text``, by kind and start."""
    t = F.col(text)
    kind_type = "array<struct<kind:int,start:int,end:int,base:boolean,votes:array<int>>>"
    for k, kind in enumerate(KINDS):
        df = _kind_candidates(df, t, k, kind, kind_type)
    cols = [(f"base_{kind}__", f"loose_{kind}__") for kind in KINDS]
    bases = F.concat(*[F.col(b) for b, _ in cols])
    free = F.filter(F.concat(*[F.col(c) for _, c in cols]), lambda c: ~F.exists(F.col("bases__"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    df = df.withColumn("bases__", bases).drop(*[b for b, _ in cols]).withColumn(out, F.array_sort(F.concat(F.col("bases__"), free)))
    return df.drop("bases__", *[c for _, c in cols])


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities (share of yes votes on true and on false spans, per labeler) and the weights of the classifier."""

    reliability: dict[str, tuple[float, float]]
    weights: tuple[float, ...]

    def score(self, kind: Column, votes: Column) -> Column:
        z = F.lit(self.weights[0])
        for w, x in zip(self.weights[1:], _features(kind, votes), strict=True):
            z = z + F.lit(w) * x
        return 1 / (1 + F.exp(-z))


def _features(kind: Column, votes: Column) -> list[Column]:
    marks = [F.when(F.get(votes, F.lit(i)) == v, 1.0).otherwise(0.0) for i in range(len(LABELERS)) for v in (0, 1)]
    return [F.when(kind == k, 1.0).otherwise(0.0) for k in range(1, len(KINDS))] + marks


def fit(spans: DataFrame, column: str = "spans__", rounds: int = 50) -> SpanModel:
    """Expectation-maximisation over all vote patterns of ``spans``, then the classifier; a table without spans gives one that accepts nothing."""
    counted = spans.select(F.explode(column).alias("s")).groupBy("s.kind", "s.votes").count().collect()
    rows = [(r["kind"], tuple(r["votes"]), r["count"]) for r in sorted(counted, key=lambda r: (r["kind"], r["votes"]))]
    if not rows:
        return SpanModel({}, (-50.0, *[0.0] * (len(KINDS) - 1 + 2 * len(LABELERS))))
    belief = [(1 + sum(v == 1 for v in votes)) / (2 + sum(v >= 0 for v in votes)) for _, votes, _ in rows]
    share: dict[int, float] = {}
    yes: list[tuple[float, float]] = []
    for _ in range(rounds):
        share = {k: (1 + sum(n * p for (j, _, n), p in zip(rows, belief, strict=True) if j == k)) / (2 + sum(n for j, _, n in rows if j == k)) for k in range(len(KINDS))}
        yes = []
        for i in range(len(LABELERS)):
            # a weak prior: labelers are more often right than wrong
            t1, t0, f1, f0 = 4.0, 1.0, 1.0, 4.0
            for (_, votes, n), p in zip(rows, belief, strict=True):
                if votes[i] == 1:
                    t1, f1 = t1 + n * p, f1 + n * (1 - p)
                elif votes[i] == 0:
                    t0, f0 = t0 + n * p, f0 + n * (1 - p)
            yes.append((t1 / (t1 + t0), f1 / (f1 + f0)))
        for at, (k, votes, _) in enumerate(rows):
            log = math.log(share[k] / (1 - share[k]))
            for (a, b), v in zip(yes, votes, strict=True):
                log += math.log(a / b) if v == 1 else math.log((1 - a) / (1 - b)) if v == 0 else 0.0
            belief[at] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))
    return SpanModel(dict(zip(LABELERS, yes, strict=True)), _logistic(rows, belief))


def _logistic(rows: list[tuple[int, tuple[int, ...], int]], belief: list[float], steps: int = 400) -> tuple[float, ...]:
    """Logistic regression on the vote patterns, weighted by their counts, towards the beliefs (gradient steps, small ridge)."""
    xs = [[1.0, *[float(k == j) for j in range(1, len(KINDS))], *[float(v == w) for v in votes for w in (0, 1)]] for k, votes, _ in rows]
    total = sum(math.log1p(n) for _, _, n in rows)
    w = [0.0] * len(xs[0])
    for _ in range(steps):
        grad = [-0.002 * x for x in w]
        for x, (_, _, n), p in zip(xs, rows, belief, strict=True):
            z = sum(a * b for a, b in zip(w, x, strict=True))
            miss = math.log1p(n) / total * (p - 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            grad = [g + miss * a for g, a in zip(grad, x, strict=True)]
        w = [a + 2.0 * g for a, g in zip(w, grad, strict=True)]
    return tuple(w)


def accepted(model: SpanModel, column: str = "spans__", accept: float = ACCEPT) -> Column:
    """The candidates that count: all of the strict patterns, others by the classifier."""
    return F.filter(F.col(column), lambda s: s["base"] | (model.score(s["kind"], s["votes"]) >= accept))


def listed(spans: Column) -> Column:
    """``kind:start:end`` by kind and start, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def find(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, base, found) for every row of ``docs`` (needs doc_id, text): the strict spans, and all that count.

    A span is (kind, start, end, base, votes), places in code points, end exclusive, ordered by kind and start. Null
    and empty texts have none. Null and repeated doc_ids are rows like any other; an empty table gives an empty table.
    """
    candidates = stored(with_candidates(_documents(docs), "text").select("doc_id", "spans__"), "spans")
    model = fit(candidates)
    return candidates.select("doc_id", F.filter("spans__", lambda s: s["base"]).alias("base"), accepted(model, accept=accept).alias("found"))


def redact(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """All rows and columns of ``docs`` with every span of the text replaced by its kind in brackets, n_chars to match.

    Overlapping spans are replaced as one, under the kind of the one that starts first. Null texts stay null.
    """
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row__"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text__"))
    candidates = with_candidates(packed, "text__")
    model = fit(stored(candidates.select("spans__"), "spans"))
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    slim = F.transform(accepted(model, accept=accept), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    text = F.col("text__")

    def step(acc: Column, s: Column) -> Column:
        new = F.struct(s["end"].alias("at"), F.concat(acc["parts"], F.array(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(name, s["kind"]))).alias("parts"))
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts"))
        return F.when(s["start"] >= acc["at"], new).otherwise(longer)

    done = F.aggregate(F.array_sort(slim), none, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(text, acc["at"] + 1, F.length(text))))
    clean = F.when(F.size("spans__") == 0, F.col("row__.text").cast("string")).otherwise(done)
    out = candidates.withColumn("clean__", clean)
    new = {"text": F.col("clean__"), "n_chars": F.when(F.col("clean__").isNull(), F.col("row__.n_chars") if "n_chars" in columns else F.lit(None)).otherwise(F.length("clean__").cast("long"))}
    return out.select(*[(new[c] if c in new else F.col(f"row__.`{c}`")).alias(c) for c in columns])
