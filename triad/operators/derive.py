"""Derived edges: co-rated movie pairs, user similarity, strongest edges.

Pair counts ("how many users liked both") are a sparse matrix product ``A^T A``. A group (user) of few items lists
its pairs, which are counted with a map-side partial step; how many pairs that is per row is bounded by the size up to
which a group counts as light. Heavy groups never list their pairs: their rows go to blocks. Items are hashed into blocks of
at most ``block_items``, groups into chunks of about ``group_chunk``; each task receives the rows of one (item block, item
block, group chunk) cell (a group adds at most ``2 x block_items`` rows to a cell, however many rows it has in
all), multiplies two small dense 0/1 matrices with numpy, and emits one partial count per item pair. A final
aggregate sums pairs and chunks.

The ``k`` strongest pairs use a threshold first: the exact weights among the items of highest degree give a lower bound of the
k-th weight, and an item in fewer groups than that bound can be in no pair that reaches it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triad.operators.graph import PropertyGraph
from triad.session import checkpoint_dir


#: A group of at most this many items may list its pairs.
LIGHT_MOST = 1024


def co_occurrence(incidence: DataFrame, group_col: str, item_col: str, min_count: int = 1,
                  block_items: int = 512, group_chunk: int = 2048,
                  distinct_rows: bool = False, top: int | None = None, light: int | None = None) -> DataFrame:
    """(i1, i2, weight) for item pairs i1 < i2 sharing ``weight >= min_count`` groups.

    ``distinct_rows=True`` says each (group, item) occurs once already (skips a shuffle). With ``top``, pairs that
    cannot be among the ``top`` heaviest may be left out. ``light`` overrides the largest size of a group that lists its pairs:
    by default twice the number of blocks, where a row of a group costs as much either way.
    """
    inc = incidence.select(F.col(group_col).alias("g"), F.col(item_col).alias("i"))
    if not distinct_rows:
        inc = inc.distinct()
    checkpoint_dir(inc.sparkSession)
    inc = inc.checkpoint()  # the few passes below read it; a lost executor does not recompute what it came from
    if top:
        min_count = max(min_count, weight_bound(inc, top))
        if min_count > 1:
            strong = inc.groupBy("i").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") >= min_count).select("i")
            inc = inc.join(strong, "i", "left_semi")
    items = inc.agg(F.countDistinct("i").alias("n")).collect()[0]["n"]
    nb = max(1, math.ceil(items / block_items))
    light = min(LIGHT_MOST, max(2 * nb + 1, 64)) if light is None else light
    size = inc.groupBy("g").agg(F.count(F.lit(1)).alias("d"))
    heavy = size.where(F.col("d") > light).select("g")
    heavy_groups = heavy.count()
    lists = inc.join(size.where(F.col("d") <= light).select("g"), "g", "left_semi") if heavy_groups else inc
    parts = listed_pairs(lists)
    if heavy_groups:
        parts = parts.unionByName(block_pairs(inc.join(heavy, "g", "left_semi"), nb, max(1, math.ceil(heavy_groups / group_chunk))))
    return parts.groupBy("i1", "i2").agg(F.sum("n").alias("weight")).where(F.col("weight") >= min_count)


def listed_pairs(inc: DataFrame) -> DataFrame:
    """(i1, i2, n = 1) for every pair of a group's items; for groups of bounded size."""
    of = inc.groupBy("g").agg(F.sort_array(F.collect_list("i")).alias("of")).where(F.size("of") > 1)
    first = of.select("of", F.posexplode("of").alias("at", "i1"))
    rest = first.select("i1", F.explode(F.slice("of", F.col("at") + 2, F.size("of"))).alias("i2"))
    return rest.select("i1", "i2", F.lit(1).cast("long").alias("n"))


def weight_bound(inc: DataFrame, top: int) -> int:
    """A lower bound of the ``top``-th largest pair weight: that among the items of highest degree, of which enough are
    taken to form a few times ``top`` pairs (their number depends on ``top`` only)."""
    some = 2 * math.isqrt(2 * top) + 2
    often = inc.groupBy("i").agg(F.count(F.lit(1)).alias("d")).orderBy(F.desc("d"), "i").limit(some).select("i")
    pairs = co_occurrence(inc.join(often, "i", "left_semi"), "g", "i", 1, distinct_rows=True)
    least = pairs.orderBy(F.desc("weight")).limit(top).agg(F.min("weight").alias("w"), F.count(F.lit(1)).alias("n")).collect()[0]
    return int(least["w"]) if least["n"] == top else 1


def block_pairs(inc: DataFrame, nb: int, nu: int) -> DataFrame:
    """(i1, i2, n): partial counts by (item block, item block, group chunk) cells."""
    inc = inc.select("g", "i", F.pmod(F.xxhash64("i"), F.lit(nb)).alias("b"),
                     F.pmod(F.xxhash64("g"), F.lit(nu)).alias("u"))
    # each row goes to every block pair that holds its block (b with itself once)
    rep = inc.select("g", "i", "b", "u", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("o")) \
        .select("g", "i", "b", "u", F.least("b", "o").alias("b1"), F.greatest("b", "o").alias("b2"))

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        b1, b2 = int(pdf["b1"].iat[0]), int(pdf["b2"].iat[0])
        users, uidx = np.unique(pdf["g"].to_numpy(), return_inverse=True)
        left = pdf["b"].to_numpy() == b1
        right = pdf["b"].to_numpy() == b2
        li, lpos = np.unique(pdf["i"].to_numpy()[left], return_inverse=True)
        ri, rpos = np.unique(pdf["i"].to_numpy()[right], return_inverse=True)
        x = np.zeros((len(users), len(li)), dtype=np.float32)
        y = np.zeros((len(users), len(ri)), dtype=np.float32)
        x[uidx[left], lpos] = 1.0
        y[uidx[right], rpos] = 1.0
        c = x.T @ y  # exact: counts < 2**24 per cell (group_chunk bounds them)
        r, k = np.nonzero(c)
        a, b = li[r], ri[k]
        keep = a < b if b1 == b2 else np.ones(len(a), dtype=bool)
        a, b, n = a[keep], b[keep], c[r[keep], k[keep]]
        return pd.DataFrame({"i1": np.minimum(a, b), "i2": np.maximum(a, b), "n": n.astype(np.int64)})

    schema = T.StructType([T.StructField("i1", inc.schema["i"].dataType),
                           T.StructField("i2", inc.schema["i"].dataType),
                           T.StructField("n", T.LongType())])
    return rep.groupBy("b1", "b2", "u").applyInPandas(cell, schema)


def co_rated_edges(g: PropertyGraph, min_rating: int = 5, min_movie_ratings: int = 500,
                   min_weight: int = 2, top: int | None = None, block_items: int = 512,
                   group_chunk: int = 2048) -> DataFrame:
    """CO_RATED(m1 < m2, weight): users who rated both at least ``min_rating``,
    both movies with at least ``min_movie_ratings`` ratings, weight >= ``min_weight``.
    ``top`` keeps the strongest edges (weight desc, then ids)."""
    hubs = g.rated.groupBy("movie_id").agg(F.count(F.lit(1)).alias("c")) \
        .where(F.col("c") >= min_movie_ratings).select("movie_id")
    liked = g.rated.where(F.col("rating") >= min_rating).join(hubs, "movie_id", "left_semi")
    e = co_occurrence(liked, "user_id", "movie_id", min_weight, block_items, group_chunk, True, top) \
        .select(F.col("i1").alias("m1"), F.col("i2").alias("m2"), "weight")
    return strongest_edges(e, "m1", "m2", top) if top else e


def active_users(g: PropertyGraph, min_ratings: int = 20, k: int = 10) -> DataFrame:
    """The ``k`` users with most ratings among those with at least ``min_ratings``."""
    return g.rated.groupBy("user_id").agg(F.count(F.lit(1)).alias("ratingCount")) \
        .where(F.col("ratingCount") >= min_ratings) \
        .orderBy(F.desc("ratingCount"), "user_id").limit(k)


def similar_edges(g: PropertyGraph, min_rating: int = 4, min_ratings: int = 20, k: int = 10,
                  min_weight: int = 1, symmetric: bool = False) -> DataFrame:
    """SIMILAR(u1, u2, weight, distance) from the ``k`` most active users to
    others sharing liked movies; ``u1 < u2`` unless ``symmetric``.

    The seed list has ``k`` rows, so the join emits at most ``k`` rows per
    like (linear in the data), never all pairs of a movie's fans.
    """
    seeds = active_users(g, min_ratings, k).select(F.col("user_id").alias("u1"))
    likes = g.rated.where(F.col("rating") >= min_rating).select("user_id", "movie_id")
    mine = likes.join(seeds, likes.user_id == seeds.u1).select("u1", "movie_id")
    theirs = likes.select(F.col("user_id").alias("u2"), "movie_id")
    pairs = mine.join(theirs, "movie_id").where(
        (F.col("u1") != F.col("u2")) if symmetric else (F.col("u1") < F.col("u2")))
    w = pairs.groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("weight")).where(F.col("weight") >= min_weight)
    return w.select("u1", "u2", "weight", (F.lit(1.0) / F.col("weight")).alias("distance"))


def all_similar_edges(g: PropertyGraph, min_rating: int = 4, top: int | None = 50000,
                      block_items: int = 512, group_chunk: int = 2048) -> DataFrame:
    """All-pairs variant: every user pair sharing liked movies, strongest ``top`` kept."""
    likes = g.rated.where(F.col("rating") >= min_rating)
    e = co_occurrence(likes, "movie_id", "user_id", 1, block_items, group_chunk, True, top) \
        .select(F.col("i1").alias("u1"), F.col("i2").alias("u2"), "weight")
    e = strongest_edges(e, "u1", "u2", top) if top else e
    return e.withColumn("distance", F.lit(1.0) / F.col("weight"))


def strongest_edges(edges: DataFrame, src: str = "src", dst: str = "dst", k: int = 50000) -> DataFrame:
    """The ``k`` heaviest edges, ties broken by (src, dst)."""
    return edges.orderBy(F.desc("weight"), F.asc(src), F.asc(dst)).limit(k)


def strongest_pair(edges: DataFrame, src: str = "u1", dst: str = "u2") -> DataFrame:
    return strongest_edges(edges, src, dst, 1)
