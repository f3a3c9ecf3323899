"""Vector codes against brute force over every entry, and hard rows."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from triad.llm.op11_vector_codes import assign, trie_leaves, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, q string, of int, error int"


def brute(rows, parts, entries, rounds, scale=256):
    """rows: (vec_id, vector, label), all taking part."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [math.floor(scale * x) for x in r[1]]))
    q = [[math.floor(scale * x) for x in r[1]] for r in rows]
    w = len(q[0]) // parts
    cut = [[tuple(v[p * w:(p + 1) * w]) for p in range(parts)] for v in q]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            got = defaultdict(list)
            for c in cut:
                got[near(c[p], books[p])[1]].append(c[p])
            for e, xs in got.items():
                books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs))
    out = []
    for r, c in zip(rows, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    total = defaultdict(int)
    for _, label, _, error in out:
        total[label] += error
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, code, error, total[label], sha) for i, label, code, error in out), key=str)


def result(df):
    return sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in df.collect()), key=str)


@pytest.mark.parametrize("subtree", [1, 3, 100])
def test_trie_distances_are_those_of_every_entry(subtree):
    rng = np.random.default_rng(subtree)
    x = np.unique(rng.integers(-4, 4, (400, 3)), axis=0)
    book = rng.integers(-4, 4, (7, 3))
    seen = 0
    for lo, hi, d in trie_leaves(x, book, subtree):
        assert lo == seen
        seen = hi
        assert (d == ((x[lo:hi, None] - book[None]) ** 2).sum(axis=2)).all()
    assert seen == len(x)
    part = x[rng.integers(0, len(x), 900)]
    leaves, times, entry, error, back = assign(part, book, subtree)
    assert (leaves[back] == part).all() and times.sum() == 900
    assert (error[back] == ((part[:, None] - book[None]) ** 2).sum(axis=2).min(axis=1)).all()


def test_codes_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(7 * i % 101, [rng.randrange(-3, 4) / 256 + rng.choice([0, 0.0001]) for _ in range(8)], rng.choice([1, 2, None])) for i in range(90)]
    rows += [(3, rows[0][1], 1), (3, rows[0][1], 1), (None, rows[5][1], 2), (None, [0.5] * 8, None), (4, [-0.25] * 8, 9)]
    bad = [(-5, None, 1), (-4, [], 1), (-3, [0.1] * 7 + [None], 2), (-2, [0.1] * 7 + [float("nan")], 2),
           (-1, [float("inf")] + [0.1] * 7, None), (200, [0.5] * 7, 1), (201, [0.5] * 16, 1)]
    df = spark.createDataFrame([(*r, "c", "q", 1, 2) for r in rows + bad], SCHEMA).repartition(5)
    assert result(vector_codes(df, parts=4, entries=6)) == brute(rows, 4, 6, 2)
    assert result(vector_codes(df, parts=2, entries=300, rounds=1)) == brute(rows, 2, 300, 1)


def test_few_equal_huge_and_no_rows(spark):
    same = [(i, [0.25, -0.5, 1.0, 0.0], None) for i in range(9)]
    make = lambda rows: spark.createDataFrame([(*r, "c", "q", 1, 2) for r in rows], SCHEMA)
    assert result(vector_codes(make(same), parts=2)) == brute(same, 2, 64, 2)
    huge = vector_codes(make([(1, [1e300, -1e300], 1), (2, [0.0, 0.0], 1), (3, [1e299, 1.0], 1)]), parts=1, entries=1).collect()
    assert len(huge) == 3 and all(r["error"] >= 0 and r["label_error"] >= r["error"] for r in huge)
    assert vector_codes(make([]), parts=2).collect() == []
    assert vector_codes(make([(1, None, 1)]), parts=2).collect() == []
