"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample of vectors is cut into balanced parts; a small classifier (one hidden layer)
learns from it which parts hold a vector's neighbours. Every row goes to its most probable part, every query to
several; candidates are reranked by exact cosine in double precision. The number of parts a query visits is the
smallest that reaches ``target_recall`` for the sample's own held-out neighbours.

The sample (``SAMPLE`` rows by smallest hash of the id) is a documented bound for fitting only; all rows are indexed.
Parts are split into blocks of at most about ``BLOCK`` rows, so a part swollen by equal vectors stays in bounded tasks.

Vectors that are null, zero, of another width than most of the sample, or that hold null or non-finite components
take no part. Ties go to the smaller vec_id. Repeated rows of an id are candidates each, but never of a query of that id, and
make one query (of the smallest of their vectors). An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 6_000
PARTS = 16
NEIGHBOURS = 10
BLOCK = 8_192
QUERY_BLOCK = 4_096

RESULT = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) with finite, non-zero vectors only."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) \
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow in the squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def balanced_parts(near: np.ndarray, parts: int, rng) -> np.ndarray:
    """Cut a neighbour graph (rows of neighbour indices) into parts of nearly equal size with few cut edges:
    grow parts breadth-first to their capacity, then move vertices to the part of most neighbours while room allows."""
    n = len(near)
    capacity = -(-n // parts)
    part = np.full(n, -1)
    at = 0
    order = rng.permutation(n)
    for p in range(parts):
        queue, size = [], 0
        while size < capacity:
            if not queue:
                while at < n and part[order[at]] >= 0:
                    at += 1
                if at == n:
                    break
                queue = [order[at]]
            nxt = []
            for x in queue:
                if part[x] < 0 and size < capacity:
                    part[x] = p
                    size += 1
                    nxt.extend(near[x])
            queue = [x for x in dict.fromkeys(nxt) if part[x] < 0]
    src = np.concatenate([np.repeat(np.arange(n), near.shape[1]), near.ravel()])
    dst = np.concatenate([near.ravel(), np.repeat(np.arange(n), near.shape[1])])
    room = int(capacity * 1.05) + 1
    for _ in range(12):
        votes = np.zeros((n, parts))
        np.add.at(votes, (src, part[dst]), 1)
        gain = votes.max(axis=1) - votes[np.arange(n), part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for x in np.argsort(-gain, kind="stable"):
            if gain[x] <= 0:
                break
            to = int(votes[x].argmax())
            if sizes[to] < room:
                sizes[to] += 1
                sizes[part[x]] -= 1
                part[x] = to
                moved += 1
        if not moved:
            break
    return part


def train_router(x: np.ndarray, target: np.ndarray, rng, hidden: int = 96, epochs: int = 40) -> dict:
    """Softmax classifier with one hidden layer, by mini-batch Adam, on soft part labels."""
    d, m = x.shape[1], target.shape[1]
    w = [rng.normal(0, np.sqrt(2 / d), (d, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, m)), np.zeros(m)]
    mom, var, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            b = order[i:i + 256]
            h = np.maximum(x[b] @ w[0] + w[1], 0)
            p = softmax(h @ w[2] + w[3])
            g = (p - target[b]) / len(b)
            gh = (g @ w[2].T) * (h > 0)
            t += 1
            for k, grad in enumerate((x[b].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                grad = grad + 1e-4 * w[k]
                mom[k] = 0.9 * mom[k] + 0.1 * grad
                var[k] = 0.999 * var[k] + 0.001 * grad * grad
                w[k] = w[k] - 0.003 * (mom[k] / (1 - 0.9**t)) / (np.sqrt(var[k] / (1 - 0.999**t)) + 1e-8)
    return {"w": w}


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def route(model: dict, x: np.ndarray) -> np.ndarray:
    w = model["w"]
    return softmax(np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3])


def neighbours(x: np.ndarray, k: int, block: int = 256) -> np.ndarray:
    """Each row's k nearest other rows, nearest first, a block of rows at a time."""
    out = np.empty((len(x), k), np.int32)
    for lo in range(0, len(x), block):
        far = -(x[lo:lo + block] @ x.T)
        far[np.arange(len(far)), lo + np.arange(len(far))] = 2
        top = np.argpartition(far, k, axis=1)[:, :k] if k < len(x) - 1 else np.argsort(far, axis=1, kind="stable")[:, :k]
        out[lo:lo + block] = np.take_along_axis(top, np.argsort(np.take_along_axis(far, top, axis=1), axis=1, kind="stable"), axis=1)
    return out


def fit(sample: np.ndarray, parts: int, k: int, target_recall: float, seed: int = 7) -> dict:
    """Graph, parts, router and the number of parts to visit, from unit vectors of the sample."""
    rng = np.random.default_rng(seed)
    n = len(sample)
    parts = max(1, min(parts, n // 50))
    if parts == 1:
        return {"w": [np.zeros((sample.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], "visit": 1, "parts": 1}
    ranked = neighbours(sample, min(max(k, NEIGHBOURS), n - 1))
    near = ranked[:, :NEIGHBOURS]
    part = balanced_parts(near, parts, rng)
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), NEIGHBOURS), part[near].ravel()), 1.0)
    target[np.arange(n), part] += NEIGHBOURS / 2
    target /= target.sum(axis=1, keepdims=True)
    test = rng.random(n) < 0.15
    model = train_router(sample[~test], target[~test], rng)
    p = route(model, sample)
    home = p.argmax(axis=1)
    rank = np.argsort(np.argsort(-p, axis=1, kind="stable"), axis=1)
    top = ranked[test][:, :k]
    place = rank[test][np.arange(test.sum())[:, None], home[top]]
    visit = next(v for v in range(1, parts + 1) if v == parts or (place < v).mean() >= target_recall)
    return model | {"visit": visit, "parts": parts}


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = PARTS,
            target_recall: float = 0.97, sample_rows: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that meets ``is_query`` (a condition on ``id``)."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = int(np.bincount([len(r["v"]) for r in picked]).argmax())
    model = fit(unit(np.array([r["v"] for r in picked if len(r["v"]) == width])), parts, k, target_recall)
    rows = rows.where(F.size("v") == width)

    def place(frames):
        for pdf in frames:
            if len(pdf):
                p = route(model, unit(np.stack(pdf["v"].to_numpy())))
                yield pd.DataFrame({"id": pdf["id"], "v": pdf["v"], "part": p.argmax(axis=1),
                                    "visits": list(np.argsort(-p, axis=1, kind="stable")[:, :model["visit"]].astype(np.int32))})

    placed = rows.mapInPandas(place, "id long, v array<double>, part int, visits array<int>")
    # one row per part and one count: how many blocks each part and the queries need
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).collect()
    blocks = {r["part"]: -(-r["n"] // BLOCK) for r in sizes}
    query_blocks = max(1, -(-sum(r["q"] for r in sizes) // QUERY_BLOCK))
    table = F.create_map(*[F.lit(x) for p in range(model["parts"]) for x in (p, blocks.get(p, 0))])
    spread = lambda n: F.sequence(F.lit(0), F.lit(n) - 1)
    base = placed.select("id", "v", "part", F.pmod(F.xxhash64("id"), table[F.col("part")]).cast("int").alias("block"),
                         F.explode(spread(query_blocks)).alias("qblock"))
    once = placed.where(is_query).groupBy("id").agg(F.min(F.struct("v", "visits")).alias("q")).select("id", "q.v", "q.visits")
    asked = once.select("id", "v", F.explode("visits").alias("part"), F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("qblock")) \
        .withColumn("n", table[F.col("part")]).where("n > 0").select("id", "v", "part", "qblock", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"))

    def rerank(key, q, c):
        out = []
        if len(q) and len(c):
            raw, ids = np.stack(c["v"].to_numpy()), c["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            raw, ids = raw[order], ids[order]
            x = unit(raw)
            for lo in range(0, len(q), 256):
                qv = np.stack(q["v"].iloc[lo:lo + 256].to_numpy())
                sims = unit(qv) @ x.T
                for i, qid in enumerate(q["id"].iloc[lo:lo + 256]):
                    s = sims[i]
                    s[ids == qid] = -np.inf
                    least = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -np.inf
                    top = np.flatnonzero((s >= least - 1e-9) & (ids != qid))
                    exact = cosine(qv[i], raw[top])
                    best = np.lexsort((ids[top], -exact))[:k]
                    out += [(int(qid), int(ids[top[b]]), float(exact[b])) for b in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["part", "block", "qblock"]
    found = asked.groupBy(*keys).cogroup(base.groupBy(*keys)).applyInPandas(rerank, RESULT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def cosine(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine in double precision; each row is summed in the same order, so equal vectors score alike."""
    return (rows * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((rows * rows).sum(axis=1)))
