"""Secret scan with a trigram inverted index, in DataFrame expressions only.

Each rule's regex is turned into a Boolean trigram query: a conjunction of alternatives, each an AND of trigrams that
any match must hold (lower-cased). Postings (trigram, document key) are built for the trigrams the queries name and
intersected per document; only candidates are verified with the regex. A rule without a mandatory trigram (hex) scans
every text. Texts meet their candidates on a 64-bit key; a clash of keys only adds a candidate.

Offsets count code points, end exclusive. Cases: a null or empty text has no span; repeated rows and repeated or null
doc_ids are scanned row by row; other columns are ignored.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base rules, in their listed order; group is the part whose length counts.
BASE = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
]
#: Rules beyond the base ones.
EXTRA = [
    ("pem", r"-----BEGIN (?:[A-Z]{1,16} ){0,3}PRIVATE KEY-----", 0, 1),
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
]
#: Most literal strings that one stretch of a regex is expanded to.
MOST_STRINGS = 32


def _strings(parsed) -> list[list[str] | None]:
    """The regex as a sequence of stretches: all strings a stretch can be (lower-cased), or None where it is open."""
    out: list[list[str] | None] = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out.append([chr(arg).lower()])
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            out.append(sorted({chr(c).lower() for _, c in arg}))
        elif name == "SUBPATTERN":
            out.extend(_strings(arg[3]))
        elif name == "BRANCH":
            options = [_joined(_strings(b)) for b in arg[1]]
            out.append(None if any(len(o) != 1 or o[0] is None for o in options) else sorted({s for o in options for s in o[0]}))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, body = arg
            inner = _joined(_strings(body))
            if (low, high) == (0, 1) and len(inner) == 1 and inner[0] is not None:
                out.append(["", *inner[0]])
            else:  # at least ``low`` copies, then anything
                out.extend([*(_strings(body) * min(low, 3)), None])
        elif name not in ("ASSERT", "ASSERT_NOT", "AT"):
            out.append(None)
    return out


def _joined(parts: list) -> list:
    """Neighbouring closed stretches as one, while the expansion stays small."""
    out: list = []
    for p in parts:
        if out and p is not None and out[-1] is not None and len(out[-1]) * len(p) <= MOST_STRINGS:
            out[-1] = sorted({a + b for a, b in product(out[-1], p)})
        else:
            out.append(p)
    return out


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """AND of ORs of ANDs of trigrams that every match holds; empty if none is mandatory."""
    query = []
    for strings in _joined(_strings(re._parser.parse(pattern))):
        if strings and all(len(s) >= 3 for s in strings):
            grams = [sorted({s[i:i + 3] for i in range(len(s) - 2)}) for s in strings]
            if grams not in query:
                query.append(grams)
    return query


def _mask(grams: list[str], order: dict[str, int]) -> int:
    return sum(1 << order[g] for g in grams)


def postings(keyed: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, key): the inverted index over the trigrams that queries name, as numbers in ``grams``."""
    low = keyed.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))
    return low.select("key", F.explode(held).alias("gram"))


def _spans(kind: str, text: Column, pattern: str, group: int, least: int) -> Column:
    """Array of (start, end) of a rule's matches, leftmost first; matches whose group is too short are dropped last."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pairs = F.arrays_zip(found.alias("m"), value.alias("v"))
    span = "struct<start:bigint,end:bigint,long_enough:boolean>"
    zero = F.struct(F.lit(1).cast("bigint").alias("at"), F.array().cast(f"array<{span}>").alias("out"))

    def step(acc, x):  # the next match is the first place of its text from the last match's end on
        length = F.length(x["m"]).cast("bigint")
        placed = F.transform(F.array(F.call_function("locate", x["m"], text, acc["at"].cast("int")).cast("bigint")), lambda p: F.struct(
            (p + length).alias("at"), F.concat(acc["out"], F.array(F.struct(
                (p - 1).alias("start"), (p - 1 + length).alias("end"), (F.length(x["v"]) >= least).alias("long_enough")))).alias("out")))
        return F.element_at(placed, 1)

    walked = F.aggregate(pairs, zero, step, lambda acc: acc["out"])
    return F.filter(walked, lambda s: s["long_enough"])


def _named(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"),
                                                 F.lit(kind).alias("kind"), s["end"].alias("end")))


def _text_of(spans: Column) -> Column:
    ordered = F.array_sort(spans)
    return F.concat_ws(",", F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_spans(docs: DataFrame, base=BASE, extra=EXTRA) -> DataFrame:
    """Per row: doc_id, counts per base kind, a digest of the base spans and all spans as text."""
    rules = [*base, *extra]
    queries = {kind: trigram_query(pattern) for kind, pattern, *_ in rules}
    grams = sorted({g for q in queries.values() for alternatives in q for conj in alternatives for g in conj})
    if len(grams) > 62:
        raise ValueError("the rules name more trigrams than one mask holds; scan them in two calls")
    order = {g: i for i, g in enumerate(grams)}
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .withColumn("key", F.xxhash64("doc_id", "text"))
    held = postings(keyed, grams).groupBy("key").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("gram"))).alias("held"))

    def holds(kind):
        query = queries[kind]
        if not query:
            return F.lit(True)
        every = F.lit(True)
        for alternatives in query:
            some = F.lit(False)
            for conj in alternatives:
                m = F.lit(_mask(conj, order)).cast("long")
                some = some | (F.col("held").bitwiseAND(m) == m)
            every = every & some
        return F.coalesce(every, F.lit(False))

    indexed = [k for k, q in queries.items() if q]
    any_rule = F.lit(False)
    for k in indexed:
        any_rule = any_rule | holds(k)
    candidates = held.where(any_rule)
    rows = keyed.join(candidates, "key", "left")
    kinds = "struct<start:bigint,rank:int,kind:string,end:bigint>"
    for rank, (kind, pattern, group, least) in enumerate(rules):
        spans = _named(_spans(kind, F.col("text"), pattern, group, least), rank, kind)
        rows = rows.withColumn(f"s_{kind}", F.when(holds(kind), spans).otherwise(F.array().cast(f"array<{kinds}>")))
    base_spans = F.concat(*[F.col(f"s_{k}") for k, *_ in base])
    return rows.select(
        "doc_id", *[F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k, *_ in base],
        F.sha2(_text_of(base_spans), 256).alias("base_sha256"),
        _text_of(F.concat(*[F.col(f"s_{k}") for k, *_ in rules])).alias("spans"))
