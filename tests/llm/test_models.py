"""Packing, language model, nearest neighbours, toxicity, quality and the pipeline."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, empty_documents, hard_rows, split
from triad.llm import op5_hmm as hmm
from triad.llm.op1_ann import balanced_parts, nearest
from triad.llm.op2_quality import keep_good, quality
from triad.llm.op4_packing import CapacityTree, best_fit, packed
from triad.llm.op8_toxicity import BlockMaxIndex, toxicity
from triad.llm.queries import vocabulary_path

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- packing

def test_capacity_tree_finds_the_tightest():
    rng = random.Random(3)
    tree, have = CapacityTree(37), Counter()
    for step in range(2000):
        need = rng.randrange(1, 38)
        fit = [c for c in have if have[c] and c >= need]
        got = tree.tightest(need)
        assert got == (min(fit) if fit else None)
        if got is not None and rng.random() < 0.6:
            tree.take(got)
            have[got] -= 1
        else:
            c = rng.randrange(1, 38)
            tree.put(c, step)
            have[c] += 1


def test_best_fit_is_gapless_and_tight():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 500)
    where, offset = best_fit(lengths, 100)
    for s in set(where.tolist()):
        at = 0
        for i in sorted(np.flatnonzero(where == s), key=lambda i: offset[i]):
            assert offset[i] == at
            at += lengths[i]
        assert at <= 100
    assert where.max() + 1 <= math.ceil(lengths.sum() / 100) * 1.05


def test_packed_round_trip(spark):
    from tokenizers import Tokenizer

    special = [(9000 + i, t) for i, t in enumerate(("a <|EndOfText|> b", "x<|STARTOFTEXT|>.", "<|endoftext|>", "<| endoftext |>", "A<|B, <|EndOfText|>!"))]
    docs = documents(spark, null_id=False, repeat=False).select("doc_id", "text").unionByName(spark.createDataFrame(special, "doc_id long, text string"))
    rows = packed(docs, vocabulary_path(), group=40).collect()
    tokenizer = Tokenizer.from_file(vocabulary_path())
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for d in docs.collect():
        ids = np.array(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0], "<u4")
        assert sorted(pieces[d.doc_id]) == [(k, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 2048
    assert packed(empty_documents(spark), vocabulary_path()).count() == 0
    # repeated rows and rows without id are documents of their own
    few = documents(spark).where("doc_id IS NULL OR doc_id < 10")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.length, r.ids_crc32) for r in packed(few, vocabulary_path()).collect())
    want = []
    for d in few.collect():
        ids = np.array(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(d.doc_id is None, d.doc_id or 0, k, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    assert got == sorted(want)


# ---------------------------------------------------------------- language model

def test_forward_and_counts_match_enumeration():
    rng = np.random.default_rng(2)
    k = 3
    model = {"start": rng.dirichlet(np.ones(k)), "move": rng.dirichlet(np.ones(k), k), "emit": rng.dirichlet(np.ones(hmm.CLASSES), k)}
    texts = [np.array(x) for x in ([4], [1, 2], [5, 5, 7, 2], [9, 1, 0])]
    total = 0.0
    moves, emits, starts = np.zeros((k, k)), np.zeros((k, hmm.CLASSES)), np.zeros(k)
    likelihood = []
    for t in texts:
        p_all, paths = 0.0, []
        for path in itertools.product(range(k), repeat=len(t)):
            p = model["start"][path[0]] * model["emit"][path[0], t[0]]
            for a, b, o in zip(path, path[1:], t[1:]):
                p *= model["move"][a, b] * model["emit"][b, o]
            paths.append((path, p))
            p_all += p
        likelihood.append(math.log(p_all))
        total += math.log(p_all)
        for path, p in paths:
            starts[path[0]] += p / p_all
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / p_all
            for s, o in zip(path, t):
                emits[s, o] += p / p_all
    for idx, n, grid in hmm.padded(texts):
        assert np.allclose(hmm.forward(model, n, grid)[0], np.array(likelihood)[idx])
        s, m, e, ll = hmm.expected_counts(model, n, grid)
        assert np.allclose(s, starts, atol=1e-5) and np.allclose(m, moves, atol=1e-5) and np.allclose(e, emits, atol=1e-5) and np.isclose(ll, total)


def test_scores_and_base(spark):
    rows = hard_rows()
    got = {r.doc_id: r for r in hmm.score(documents(spark, repeat=False, null_id=False), states=3, rounds=3).collect()}
    count, ends = Counter(), 0
    low = lambda t: split("".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")))
    for r in rows:
        if zlib.crc32(str(r[0]).encode()) % 10:
            count.update(low(r[1]))
            ends += 1
    n, v = sum(count.values()) + ends, len(count) + 1
    for r in rows:
        w, g = low(r[1]), got[r[0]]
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(count[x] for x in w), ends])
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (zlib.crc32(str(r[0]).encode()) % 10 == 0, len(w) + 1, sum(count[x] > 0 for x in w) + 1, n)
        assert g.base_score == pytest.approx(base)
        assert g.score < 0
    assert hmm.score(empty_documents(spark)).count() == 0


def test_rounds_raise_the_likelihood(spark):
    from triad.llm import exchange as X

    chunks = X.Chunks(spark.read.parquet(f"{SF}/documents.parquet"))
    counts = X.written(hmm.corpus_counts(chunks), "t")
    s = hmm.summary(counts)
    _, history = hmm.train(X.written(hmm.coded(chunks, counts, s), "t"), s, states=4, rounds=4)
    assert all(b > a for a, b in zip(history, history[1:]))


# ---------------------------------------------------------------- nearest neighbours

def test_balanced_parts():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 16)) * 5
    x = (centres[np.arange(800) % 8] + rng.normal(size=(800, 16)))
    near = np.argsort(((x[:, None] - x[None]) ** 2).sum(-1), axis=1)[:, 1:11]
    part = balanced_parts(near, 8, rng)
    assert np.bincount(part).max() <= 110
    assert (part[near] == part[:, None]).mean() > 0.8


def brute_nearest(ids, x, q, k=5):
    s = (x * x[q]).sum(1) / np.sqrt((x * x).sum(1) * (x[q] ** 2).sum())
    order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), float(s[i])) for i in order]


def test_a_repeated_query_row_is_one_query(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(120)]
    rows += [rows[50], rows[50], (7, rows[20][1])]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, id int, v int, visits int").repartition(3)
    got = nearest(df.select("vec_id", "embedding", "v", "visits"), F.col("id") % 50 == 0, parts=2, target_recall=1.0)
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    for q in (0, 50, 100):
        best = brute_nearest(ids, x, int(np.flatnonzero(ids == q)[0]))
        assert found[q] == [(k + 1, i, round(s, 9)) for k, (i, s) in enumerate(best)]


def test_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hit = total = 0
    for q, g in itertools.groupby(sorted(nearest(table, F.col("id") % 50 == 0).collect()), key=lambda r: r.query_id):
        g = list(g)
        want = dict(brute_nearest(ids, x, int(np.flatnonzero(ids == q)[0])))
        assert [r["rank"] for r in g] == [1, 2, 3, 4, 5]
        hit += len(want.keys() & {r.vec_id for r in g})
        total += 5
        for r in g:
            if r.vec_id in want:
                assert r.score == pytest.approx(want[r.vec_id], abs=1e-12)
    assert hit / total >= 0.9


def test_unusable_and_equal_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, float(i % 3)], i) for i in range(60)] + [(60, None, 0), (61, [0.0, 0.0, 0.0], 0), (62, [nan, 1.0, 1.0], 0), (63, [inf, 1.0, 1.0], 0),
            (64, [None, 1.0, 1.0], 0), (65, [1.0], 0), (None, [1.0, 1.0, 1.0], 0), (66, [], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, part int")
    got = nearest(table, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect()
    by = {q: [r.vec_id for r in g] for q, g in itertools.groupby(got, key=lambda r: r.query_id)}
    assert by == {0: [3, 6, 9, 12, 15], 50: [2, 5, 8, 11, 14]}
    assert nearest(table.limit(0), F.col("id") % 50 == 0).count() == 0
    assert nearest(table.where("vec_id IN (0, 1)"), F.col("id") % 50 == 0).count() == 1


# ---------------------------------------------------------------- toxicity and quality

def test_block_max_search_is_exact():
    rng = np.random.default_rng(5)
    made = []
    for i in range(400):
        t = np.sort(rng.choice(60, rng.integers(1, 8), replace=False))
        w = rng.random(len(t))
        made.append((i, int(i % 3 == 0), t, w / np.sqrt((w * w).sum())))
    index = BlockMaxIndex(made, 60, block=16)
    dense = np.zeros((400, 60))
    for i, _, t, w in made:
        dense[i, t] = w
    for q in range(50):
        s = np.round(dense @ dense[q], 12)
        s[q] = 0
        want = [i for i in np.lexsort((np.arange(400), -s))[:10] if s[i] > 0]
        got = index.search(made[q][2], made[q][3], 10, without=q)
        assert [g[1] for g in got] == want
        assert np.allclose([g[0] for g in got], s[want])


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r.toxic for r in rows])
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert right > 0.93 and np.mean(np.array(toxic)[:, None] > np.array(clean)[None]) > 0.9
    assert abs(np.mean(toxic + clean) - np.mean([r.toxic for r in rows])) < 0.04


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_and_quality_edge_tables(spark):
    docs = documents(spark)
    marks = labels(spark, [(r[0], int(i % 4 > 0), int(i % 5 == 0)) for i, r in enumerate(hard_rows())] + [(1, 0, 1), (None, 1, 1), (4, None, None)])
    for table, lab in ((docs, marks), (docs, marks.limit(0)), (empty_documents(spark), marks)):
        got = toxicity(table, lab).collect()
        assert len(got) == table.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
        got = quality(table, lab).collect()
        assert len(got) == table.count() and all(0 <= r.score <= 1 for r in got)
        assert keep_good(table, lab).columns == table.columns
    assert all(r.keep for r in quality(docs, marks.limit(0)).collect())


def test_quality_on_held_out_rows(spark):
    docs, lab = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality(docs, lab).join(lab, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.keep == bool(r.quality) for r in held]) > 0.93
    kept = keep_good(docs, lab)
    assert {r.doc_id for r in rows if r.keep} == {r.doc_id for r in kept.join(lab, "doc_id").collect()}


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = [docs]
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, kept[-1], "/root/testdata/sf0.001")
        assert out.schema.names == docs.schema.names
        kept.append(P.written(out, "t"))
    sizes = [d.count() for d in kept]
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    last = P.STAGES[-1][1](spark, kept[-1], "/root/testdata/sf0.001")
    whole = P.run(spark, "/root/testdata/sf0.001")
    pick = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, last.select(pick).collect())) == sorted(map(tuple, whole.select(pick).collect()))
    assert {r.doc_id for r in whole.select("doc_id").collect()} == {r.doc_id for r in kept[-1].select("doc_id").collect()}
