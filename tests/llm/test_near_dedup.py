"""Near duplicates against brute force over all pairs, the signature guarantee, tiles, and hard rows."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.data import documents, empty_documents, split
from triad.llm import op13_near_dedup as N


def brute(rows, k=4, percent=80):
    """rows: (doc_id, text); every row is a document."""
    sets = []
    for _, text in rows:
        w = [x.lower() for x in split(text)]  # bytes: A-Z only
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    where = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            where[x].add(i)
    for i, s in enumerate(sets):
        for j in set().union(*(where[x] for x in s)) if s else ():
            both = len(s & sets[j])
            if j > i and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                top[find(j)] = find(i)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)].append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        least = min(ids[find(i)], default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "kept")) for r in df.collect()), key=str)


def copies(seed):
    """Groups of copies around the threshold, chains of copies, short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    out = []
    for size in [5, 8, 20, 60, 200, 400]:
        for _ in range(4):
            base = [word() for _ in range(size)]
            for _ in range(8):
                t = list(base)
                for _ in range(rng.randrange(0, max(2, size // 18))):
                    t[rng.randrange(size)] = word()
                out.append(t)
    chain = [word() for _ in range(120)]
    for _ in range(25):
        chain = chain[4:] + [word() for _ in range(4)]
        out.append(chain)
    out += [[word()] for _ in range(5)] + [["same"], ["Same"], ["a", "b", "c"], ["A", "b", "C"], ["a", "b"]]
    return [" ".join(t) for t in out]


def test_every_pair_within_reach_shares_a_key(spark):
    rng = np.random.default_rng(3)
    for symbols, chunk, errors in ((64, 4, 1), (24, 6, 2), (12, 4, 0)):
        most = N.reach(symbols, chunk, errors)
        rows = []
        for i in range(300):
            a = rng.integers(0, 2**16, symbols).astype(np.uint16)
            b = a.copy()
            at = rng.choice(symbols, most if i % 3 else max(most - i % 5, 0), replace=False)
            b[at] ^= rng.integers(1, 2**16, len(at)).astype(np.uint16)
            rows += [(2 * i, bytearray(a.tobytes())), (2 * i + 1, bytearray(b.tobytes()))]
        df = spark.createDataFrame(rows, "class long, signature binary")
        found = {(r["a"], r["b"]) for r in N.bucket_links(df, symbols, chunk, errors).collect()}
        assert {(2 * i, 2 * i + 1) for i in range(300)} <= found


@pytest.mark.parametrize("tile", [4, 1500])
def test_components_against_brute_force(spark, tile):
    rows = [(10 * i + 3, t) for i, t in enumerate(copies(7))]
    df = spark.createDataFrame([(i, t, "c", 1, "s", "k") for i, t in rows], "doc_id long, text string, key string, class long, signature string, row_key string")
    assert result(N.near_duplicates(df.repartition(5), tile=tile)) == brute(rows)


def test_hard_rows_repeated_and_null_ids(spark):
    docs = documents(spark)
    extra = [(40, "entirely another text under an id that is taken"), (None, "a text without an id of its own here"),
             (None, "a text without an id of its own here"), (2, "shared words of one more text"), (2, "shared words of one more text")]
    more = spark.createDataFrame(extra, "doc_id long, text string")
    got = N.near_duplicates(docs.select("doc_id", "text").unionByName(more))
    assert result(got) == brute([(r["doc_id"], r["text"]) for r in docs.collect()] + extra)
    assert N.near_duplicates(empty_documents(spark)).collect() == []
    nulls = spark.createDataFrame([(1, None), (None, ""), (2, " \n")], "doc_id long, text string")
    assert result(N.near_duplicates(nulls)) == brute([(1, None), (None, ""), (2, " \n")])


def test_a_class_of_very_many_rows(spark, monkeypatch):
    monkeypatch.setattr(N, "HEAVY_LEAST", 3)
    rows = [(i, "one text that a third of all documents hold") for i in range(1, 40)] + [(100 + i, f"text {i} alone " * 5) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(N.near_duplicates(df)) == brute(rows)


def test_spanning_edges_connect_what_is_near():
    rng = random.Random(1)
    for n in (2, 7, 40):
        near = np.zeros((n, n), bool)
        for _ in range(n):
            i, j = rng.randrange(n), rng.randrange(n)
            near[i, j] = near[j, i] = True
        got = N.spanning(lambda i, other: near[i] & other, n)

        def groups(edges):
            top = list(range(n))
            for _ in range(n):
                for a, b in edges:
                    top[a] = top[b] = min(top[a], top[b])
            return top

        assert groups(got) == groups([(i, j) for i in range(n) for j in range(n) if near[i, j]]) and len(got) < n
