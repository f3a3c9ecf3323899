"""Stages and operators against brute force where an earlier form did less than the whole job."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.data import words
from tests.llm.test_text_ops import brute_components, brute_lines
from triad.llm.op8_toxicity import toxicity


@pytest.fixture
def tables(spark, tmp_path):
    """Write the pipeline's tables: these documents, no labels, no benchmark."""
    def write(rows):
        spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
            "doc_id", "text", "'en' AS lang", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars").write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return write


def reflowed(w, first):
    """The words in lines of ten, after a first line of ``first``: no line of one flow matches a line of another."""
    cuts = [0, *range(first, len(w), 10), len(w)]
    return "\n".join(" ".join(w[a:b]) for a, b in zip(cuts, cuts[1:]))


def test_pipeline_removes_near_copies_between_the_thresholds(spark, tables):
    import corpus_pipeline as P

    rng, rows = random.Random(5), []
    for group in range(8):
        base = [f"g{group}n{i}" for i in range(200)]
        rows.append((10 * group, reflowed(base, 10)))
        for copy, edits in ((1, 4), (2, 5)):  # 5-word Jaccard 0.815 and 0.774; 3-word 0.886 and 0.859
            w = list(base)
            for e in range(edits):
                w[20 + 30 * e + rng.randrange(10)] = f"edit{group}c{copy}n{e}"
            rows.append((10 * group + copy, reflowed(w, 5 if copy == 1 else 3)))
    expected = {d for d, (_, c) in brute_components(rows, 5, 80).items() if c == d}
    assert expected == {10 * g + c for g in range(8) for c in (0, 2)}
    assert {r.doc_id for r in P.run(spark, tables(rows)).select("doc_id").collect()} == expected


def test_near_copy_stage_decides_by_row(spark):
    import corpus_pipeline as P

    a = " ".join(f"a{i}" for i in range(60))
    near = a.replace("a30 ", "")
    b = " ".join(f"b{i}" for i in range(60))
    rows = [(0, a), (1, near), (1, b), (5, "same text of one id " * 3), (5, "same text of one id " * 3), (None, a), (None, "text of nobody " * 4),
            (None, "text of nobody " * 4), (7, ""), (7, ""), (8, None), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = P.near_copy_stage(spark, docs, "")
    assert got.columns == docs.columns
    want = [(0, a), (1, b), (5, "same text of one id " * 3), (None, "text of nobody " * 4), (7, ""), (7, ""), (8, None), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
    assert P.near_copy_stage(spark, docs.limit(0), "").count() == 0


def test_line_stage_judges_short_lines(spark):
    import corpus_pipeline as P

    rng = random.Random(6)
    short = ["All rights reserved.", "menu", "a a a a b b b b", "one two three four", "é" * 300, "", " \t "]
    rows = []
    for i in range(40):
        lines = [" ".join(words(rng, rng.randrange(1, 9), 30)) for _ in range(5)] + rng.sample(short, 3) + [f"only here {i}"]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(40, "MENU\nmenu"), (41, "all rights reserved."), (42, ""), (43, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "CAST(length(text) AS BIGINT) AS n_chars").repartition(3)
    cut = brute_lines(rows, least=1)
    expected = {d: cut[d] for d, t in rows if cut[d] == t or cut[d].strip()}
    assert set(expected) == {*range(40), 42, 43} and any("menu" in t and "menu" not in cut[d] for d, t in rows[:40])
    got = {r.doc_id: (r.text, r.n_chars) for r in P.line_stage(spark, docs, "").collect()}
    assert got == {d: (t, len(t)) for d, t in expected.items()}


def test_toxicity_neighbours_are_nearest_over_all_terms(spark):
    """Each text's evidence is the brute-force cosine ranking over every word of the examples; clean words count."""
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(160):
        w = words(rng, rng.randrange(3, 30), 150) + ["vile"] * (i % 9 == 0)
        rows.append((i, ("Calm, " if i % 2 else "") + " ".join(w)))
        marks.append((i, 1, int(i % 9 == 0)))
    rows += [(200, "w1x calm"), (201, "nothing-known here!"), (202, None), (203, rows[1][1]), (204, "日本語の文"), (205, "本語")]
    marks += [(203, 1, 1), (204, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in toxicity(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()}
    bags = {d: Counter(re.findall(r"[a-z0-9]+|[぀-鿿]", (t or "").lower())) for d, t in rows}
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    example, first = {}, {}
    for d, _, y in marks:
        if not held(d):
            d = first.setdefault(dict(rows)[d], d)
            example[d] = max(example.get(d, 0), y)
    vocabulary = {t for d in example for t in bags[d]}
    idf = {t: math.log((len(rows) + 1) / (sum(t in b for b in bags.values()) + 1)) + 1 for t in vocabulary}

    def unit(bag):
        v = {t: (1 + math.log(c)) * idf[t] for t, c in bag.items() if t in vocabulary}
        length = math.sqrt(sum(x * x for x in v.values())) or 1
        return {t: x / length for t, x in v.items()}

    units = {d: unit(b) for d, b in bags.items()}
    for d, r in got.items():
        near = sorted((-round(min(sum(x * units[e].get(t, 0) for t, x in units[d].items()), 1), 12), e) for e in example)
        near = [(e, -s) for s, e in near if s < 0][:5]
        assert r.evidence == ",".join(f"{e}:{s:.4f}:{example[e]}" for e, s in near), d
    assert got[200].evidence and got[205].evidence.startswith("204:") and not got[201].evidence and not got[202].evidence
