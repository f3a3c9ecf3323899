"""Iterative graph algorithms: PageRank, Louvain communities, shortest paths.

Each is a short driver loop whose rounds are joins and aggregates that stay
on the executors; the driver only reads one small aggregate per round (a
convergence figure or a found/empty flag). The state of each round is
checkpointed to the shared folder named by ``spark.checkpoint.dir`` (reliable
checkpoints: a lost executor never forces a replay of earlier rounds, and the
plan of a round never carries the lineage of the ones before).
"""

from __future__ import annotations

import itertools
import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from triad.session import checkpoint_dir, scratch_path

_DEBUG = bool(os.environ.get("TRIAD_DEBUG"))  # print per-round progress of the loops


def _cut(df: DataFrame, rnd: int, every: int) -> DataFrame:
    """Reliable checkpoint every ``every`` rounds, else persist."""
    if every and rnd % every == 0:
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: for what many steps read, much smaller than a checkpoint of its rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of (root, vertex) that a join with the edges may broadcast.
LIGHT_ROWS = 200_000


def _light(df: DataFrame) -> DataFrame:
    """A checkpointed ``df``, to be broadcast if it has few rows, so that the edges stay where they are."""
    return F.broadcast(df) if df.limit(LIGHT_ROWS + 1).count() <= LIGHT_ROWS else df


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst", weight: str | None = "weight") -> DataFrame:
    """Both directions of every edge as (src, dst, w)."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    one, other, w = F.col(src), F.col(dst), w.alias("w")
    return edges.select(F.inline(F.array(F.struct(one.alias("src"), other.alias("dst"), w),
                                         F.struct(other.alias("src"), one.alias("dst"), w))))


# ------------------------------------------------------------- PageRank

def pagerank(edges: DataFrame, vertices: DataFrame, src: str = "src", dst: str = "dst",
             weight: str | None = "weight", vertex_id: str = "id", damping: float = 0.85,
             max_iter: int = 20, tol: float = 1e-7, is_undirected: bool = True) -> DataFrame:
    """Weighted PageRank, un-normalised: ``r = (1-d) + d * sum(r_u * w_uv / W_u)``,
    every vertex starting at ``1-d``; a vertex without edges keeps ``1-d``.
    Stops after ``max_iter`` rounds or when no score moves by ``tol``.
    Returns (id, score)."""
    e = undirected(edges, src, dst, weight) if is_undirected else \
        edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"),
                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    n = int(e.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out_w = e.groupBy("src").agg(F.sum("w").alias("wsum"))
    # edges stay dealt by source and vertices by id in all rounds, so a round only exchanges contributions
    p = e.join(out_w, "src").select("src", "dst", (F.col("w") / F.col("wsum")).alias("p")).repartition(n, "src").persist(StorageLevel.MEMORY_AND_DISK)
    base = 1.0 - damping
    verts = vertices.select(F.col(vertex_id).alias("id")).distinct().repartition(n, "id").persist(StorageLevel.MEMORY_AND_DISK)
    ranks = verts.select("id", F.lit(base).alias("r"))
    for i in range(1, max_iter + 1):
        contrib = p.join(ranks.withColumnRenamed("id", "src"), "src").groupBy("dst").agg(F.sum(F.col("r") * F.col("p")).alias("s"))
        new = ranks.withColumnRenamed("r", "old").join(contrib.withColumnRenamed("dst", "id"), "id", "left").select(
            "id", (F.lit(base) + F.lit(damping) * F.coalesce("s", F.lit(0.0))).alias("r"), "old")
        seen = Observation()  # the largest change comes with the job that computes the round
        new = new.observe(seen, F.max(F.abs(F.col("r") - F.col("old"))).alias("delta"))
        ranks = _cut(new, 1, 1).select("id", "r")
        delta = seen.get["delta"]
        if delta is not None and delta < tol:
            break
    p.unpersist()
    verts.unpersist()
    return ranks.select(F.col("id"), F.col("r").alias("score"))


# ------------------------------------------------------------- Louvain

def modularity(edges: DataFrame, labels: DataFrame, src: str = "src", dst: str = "dst",
               weight: str | None = "weight") -> float:
    """Weighted modularity of a labelling (id, community) of an undirected graph."""
    e = undirected(edges, src, dst, weight)
    two_m = e.agg(F.sum("w")).collect()[0][0] or 0.0
    if two_m == 0:
        return 0.0
    lab = labels.select(F.col("id"), F.col("community"))
    inside = e.join(lab.withColumnRenamed("id", "src").withColumnRenamed("community", "cs"), "src") \
        .join(lab.withColumnRenamed("id", "dst").withColumnRenamed("community", "cd"), "dst") \
        .where(F.col("cs") == F.col("cd")).agg(F.sum("w")).collect()[0][0] or 0.0
    deg = e.groupBy("src").agg(F.sum("w").alias("k")).join(
        lab.withColumnRenamed("id", "src"), "src")
    tot = deg.groupBy("community").agg(F.sum("k").alias("t")).agg(F.sum(F.col("t") * F.col("t"))).collect()[0][0] or 0.0
    return inside / two_m - tot / (two_m * two_m)


def louvain(edges: DataFrame, vertices: DataFrame, src: str = "src", dst: str = "dst",
            weight: str | None = "weight", vertex_id: str = "id", min_gain: float = 1e-12) -> DataFrame:
    """Louvain communities (id, community) of an undirected weighted graph.

    Per level: rounds of local moves, then communities are contracted into vertices (edge weights summed, self-loops
    kept) and the next level starts. In a round half of the vertices, by a hash that changes with every pair of
    rounds, may move to the neighbouring community of the best modularity gain (equal gains: the smaller label); the other half may in
    the next one, so two vertices that would only swap places seldom move at once. A level ends when nobody of either half moves, or
    when a pair of rounds did not raise the modularity, whose best labelling is kept. Each level that moves
    anything raises the modularity, so levels end too. Vertices without edges stay alone. Final
    labels are the smallest member id. One job a round: moves and modularity are observed while the round is written.
    """
    e0 = undirected(edges, src, dst, weight).where(F.col("src") != F.col("dst"))
    g = _cut(e0.groupBy(F.col("src").alias("a"), F.col("dst").alias("b")).agg(F.sum("w").alias("w")), 1, 1)
    two_m = g.agg(F.sum("w")).collect()[0][0] or 0.0
    members = _cut(vertices.select(F.col(vertex_id).alias("id")).distinct().select("id", F.col("id").alias("node")), 1, 1)
    if two_m == 0:
        return members.select("id", F.col("id").alias("community"))
    for level in itertools.count():
        k = g.groupBy("a").agg(F.sum("w").alias("k"))
        # vertices without edges have nothing to gain; they are left out of the rounds
        comm = _cut(k.select("a", F.col("a").alias("c"), "k"), 1, 1)
        best, best_q, first_q, dull = comm, None, None, False
        for r in itertools.count():
            new, seen = _louvain_round(g, comm, two_m, min_gain, r)
            q = (seen["inside"] or 0.0) - (seen["squares"] or 0.0) / two_m  # of ``comm``, up to what a level holds constant
            if best_q is None:
                best_q = first_q = q
                moved_before = True
            elif r % 2 == 0:  # after both halves
                if q > best_q + 1e-9 * two_m:
                    best, best_q = comm, q
                else:
                    dull = True
            if _DEBUG:
                print("louvain level", level, "round", r, "moves", seen["moves"], "q", q / two_m, flush=True)
            if dull or not (seen["moves"] or moved_before):
                if q > best_q:
                    best, best_q = comm, q
                break
            moved_before = seen["moves"] > 0
            comm = new
        if best_q <= first_q + 1e-9 * two_m:
            break
        # relabel members to their node's community, contract the communities
        lab = best.select("a", "c")
        members = _cut(members.join(lab.withColumnRenamed("a", "node"), "node", "left").select("id", F.coalesce("c", "node").alias("node")), 1, 1)
        g = _cut(g.join(lab, "a").select(F.col("c").alias("a"), "b", "w").join(lab.select(F.col("a").alias("b"), F.col("c").alias("cb")), "b")
                 .groupBy("a", F.col("cb").alias("b")).agg(F.sum("w").alias("w")), 1, 1)
    smallest = members.groupBy("node").agg(F.min("id").alias("community"))
    return members.join(smallest, "node").select("id", "community")


def _louvain_round(g: DataFrame, comm: DataFrame, two_m: float, min_gain: float, r: int):
    """The labelling after one round, and what was seen of the one before it: moves, weight inside, squared totals."""
    # kin(a, C): weight from a to community C; a "stay" row makes a's own community a candidate even without neighbours in it
    nb = g.where(F.col("a") != F.col("b")).join(comm.select(F.col("a").alias("b"), F.col("c").alias("cb")), "b").select("a", "cb", "w")
    stay = comm.select("a", F.col("c").alias("cb"), F.lit(0.0).alias("w"))
    kin = nb.unionByName(stay).groupBy("a", "cb").agg(F.sum("w").alias("kin"))
    tot = comm.groupBy(F.col("c").alias("cb")).agg(F.sum("k").alias("tot"))
    cand = kin.join(comm.select("a", F.col("c").alias("cur"), "k"), "a").join(tot, "cb")
    # modularity gain of joining C, up to a common factor 1/m and a term shared by all C:
    # kin_C - k_a * tot_C(without a) / 2m
    own = F.col("cb") == F.col("cur")
    score = F.col("kin") - F.col("k") * (F.col("tot") - F.when(own, F.col("k")).otherwise(F.lit(0.0))) / F.lit(two_m)
    best = cand.withColumn("score", score).groupBy("a", "cur", "k").agg(
        F.max(F.struct(F.col("score"), (-F.col("cb")).alias("neg"))).alias("best"), F.max(F.when(own, F.col("score"))).alias("stay"),
        F.max(F.when(own, F.col("kin"))).alias("inside"), F.max(F.when(own, F.col("tot"))).alias("tot"))
    half = F.pmod(F.xxhash64("a", F.lit(r // 2)) + F.lit(r), F.lit(2)) == 0
    moves = half & ((F.col("best.score") - F.col("stay")) * F.lit(2.0 / two_m) > F.lit(min_gain))
    seen = Observation()
    new = best.observe(seen, F.count_if(moves).alias("moves"), F.sum("inside").alias("inside"), F.sum(F.col("k") * F.col("tot")).alias("squares"))
    new = _cut(new.select("a", F.when(moves, -F.col("best.neg")).otherwise(F.col("cur")).alias("c"), "k"), 1, 1)
    return new, seen.get


def community_sizes(labels: DataFrame, k: int = 10) -> DataFrame:
    return labels.groupBy("community").agg(F.count(F.lit(1)).alias("clusterSize")) \
        .orderBy(F.desc("clusterSize"), "community").limit(k)


def community_top_genres(labels: DataFrame, rated: DataFrame, has_genre: DataFrame,
                         min_rating: int = 4, k: int = 3) -> DataFrame:
    """Per community, the ``k`` genres most liked by its members: (community, rank, genre, freq)."""
    likes = rated.where(F.col("rating") >= min_rating).select(F.col("user_id").alias("id"), "movie_id")
    per_movie = likes.join(labels, "id").groupBy("community", "movie_id").agg(F.count(F.lit(1)).alias("n"))
    freq = per_movie.join(has_genre, "movie_id").groupBy("community", "genre").agg(F.sum("n").alias("freq"))
    w = Window.partitionBy("community").orderBy(F.desc("freq"), F.asc("genre"))
    return freq.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("community", "rank", "genre", "freq")


# ------------------------------------------------------------- shortest paths

def hop_paths(edges: DataFrame, pairs: DataFrame, max_hops: int = 6) -> DataFrame:
    """Shortest paths by hop count in an undirected graph of string keys, for
    every (source, target) pair at once; of equally short ones the smallest by its keys, first key first.

    Layers of (root, vertex) grow from the sources and from the targets in turn, so no side goes deeper than half of
    ``max_hops``. A layer's neighbours lie in the layer before, the same and the next one, so only two layers are
    kept out of a new one. Sides of a + b levels meet in their newest layers exactly if the distance is a + b. The paths
    of the pairs that met are rebuilt by joins: vertices between both sides, then the smallest next vertex of each
    step. Returns (source, target, path, length); pairs without a path within ``max_hops`` give no row.

    The edges are exchanged once, each in one direction only, to be told apart. They are written in both, and every new layer
    reads them once; layers of few rows are broadcast to them, and only larger ones exchange the edges again. The edges that
    a layer grew along are kept, and paths are rebuilt from those.
    """
    once = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    e = stored(undirected(once, "src", "dst", None).select("src", "dst"), "edges")
    pairs = _cut(pairs.select(F.col("source").cast("string").alias("s"), F.col("target").cast("string").alias("t")).distinct(), 1, 1)
    found = [pairs.where(F.col("s") == F.col("t")).select(
        F.col("s").alias("source"), F.col("t").alias("target"), F.array("s").alias("path"), F.lit(0).alias("length"))]
    left = pairs.where(F.col("s") != F.col("t"))
    ends = {"s": [left.select(F.col("s").alias("root"), F.col("s").alias("node")).distinct()],
            "t": [left.select(F.col("t").alias("root"), F.col("t").alias("node")).distinct()]}
    links = {"s": [None], "t": [None]}  # edges (root, src, dst) from a layer's predecessor on
    for hops in range(1, max_hops + 1):
        side = "s" if len(ends["s"]) <= len(ends["t"]) else "t"
        layers = ends[side]
        roots = left.select(F.col(side).alias("root")).distinct()  # roots that still have someone to meet
        front = _light(_cut(layers[-1].join(roots, "root", "left_semi"), 1, 1))
        links[side].append(stored(e.join(front, F.col("node") == F.col("src")).select("root", "src", "dst"), "links"))
        new = links[side][-1].select("root", F.col("dst").alias("node")).distinct()
        for old in layers[-2:]:
            new = new.join(old, ["root", "node"], "left_anti")
        new = _cut(new, 1, 1)
        layers.append(new)
        near = ends["s"][-1].select(F.col("root").alias("s"), "node")
        far = ends["t"][-1].select(F.col("root").alias("t"), "node")
        between = left.join(near, "s").join(far, ["t", "node"]).select("s", "t", "node")
        if between.limit(1).count():
            between = _cut(between, 1, 1)
            found.append(_rebuilt(between, links["s"], links["t"]))
            left = _cut(left.join(between, ["s", "t"], "left_anti"), 1, 1)
            if not left.limit(1).count():
                break
        elif not new.limit(1).count():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _rebuilt(between: DataFrame, near: list[DataFrame], far: list[DataFrame]) -> DataFrame:
    """Paths of the pairs whose sides met: ``between`` (s, t, node) holds the vertices of both newest layers. Only the edges
    that the layers grew along are read."""
    a, length = len(near) - 1, len(near) + len(far) - 2
    on_path = {a: between}  # by distance from the source
    for step in [*range(a - 1, 0, -1), *range(a + 1, length)]:
        beside, grown, root = (on_path[step + 1], near[step + 1], "s") if step < a else (on_path[step - 1], far[length - step + 1], "t")
        back = grown.select(F.col("root").alias(root), F.col("dst").alias("node"), "src")
        on_path[step] = _cut(beside.join(back, [root, "node"]).select("s", "t", F.col("src").alias("node")).distinct(), 1, 1)
    walk = between.select("s", "t", F.col("s").alias("p0")).distinct()
    for step in range(1, length):
        if step <= a:
            on = near[step].select(F.col("root").alias("s"), F.col("src").alias(f"p{step - 1}"), F.col("dst").alias("node"))
        else:
            on = far[length - step + 1].select(F.col("root").alias("t"), F.col("dst").alias(f"p{step - 1}"), F.col("src").alias("node"))
        best = walk.join(on, ["s" if step <= a else "t", f"p{step - 1}"]).join(on_path[step], ["s", "t", "node"]) \
            .groupBy("s", "t").agg(F.min("node").alias(f"p{step}"))
        walk = _cut(walk.join(best, ["s", "t"]), 1, 1)
    path = F.array(*[F.col(f"p{i}") for i in range(length)], F.col("t"))
    return _cut(walk.select(F.col("s").alias("source"), F.col("t").alias("target"), path.alias("path"), F.lit(length).alias("length")), 1, 1)


def hop_path(edges: DataFrame, source: str, target: str, max_hops: int = 6) -> DataFrame:
    """One pair: (path, length), or no row beyond ``max_hops``."""
    pairs = edges.sparkSession.createDataFrame([(source, target)], "source string, target string")
    return hop_paths(edges, pairs, max_hops).select("path", "length")


def weighted_path(edges: DataFrame, source, target, src: str = "u1", dst: str = "u2",
                  cost: str = "distance", width: float | None = None) -> DataFrame:
    """Cheapest path in an undirected graph with non-negative edge costs; of equally cheap ones that of fewest edges, then
    the smallest vertex before each vertex, from the target on.

    Vertices are held as (vertex, cost, hops, vertex before). Costs fall into buckets of ``width`` (the mean edge cost by
    default). A round joins the edges with the vertices of the cheapest open bucket that improved in the last round. When none
    is left the bucket is settled: later offers cannot improve it, and later rounds only use it to turn
    offers away. It ends when the target's bucket is settled, however long the path is. The path is read off
    afterwards by pointer doubling over the vertices before. Returns (sourceNode, targetNode, totalCost,
    nodeIds, hops, costs), or no row.
    """
    e = _cut(undirected(edges, src, dst, cost), 1, 1)
    kind = e.schema["src"].dataType.simpleString()
    if source is None or target is None:
        return _path_rows(edges.sparkSession.createDataFrame([], f"v {kind}, d double, at int"), source, target, kind)
    if width is None:
        width = e.agg(F.avg("w")).collect()[0][0] or 1.0
    width = width if width > 0 else 1.0
    first = edges.sparkSession.createDataFrame([(source, 0.0, 0, None, True)], f"v {kind}, d double, h int, before {kind}, fresh boolean")
    unsettled, settled = first, first.limit(0).drop("fresh")
    end, rnd = width, 0
    while True:
        rnd += 1
        active = unsettled.where(F.col("fresh") & (F.col("d") < end))
        offers = active.join(e, F.col("v") == F.col("src")).select(
            F.col("dst").alias("v"), (F.col("d") + F.col("w")).alias("d"), (F.col("h") + 1).alias("h"), F.col("src").alias("before"), F.lit(True).alias("fresh"))
        offers = offers.join(settled.select("v"), "v", "left_anti")
        kept = unsettled.withColumn("fresh", F.col("fresh") & (F.col("d") >= end))
        # false sorts before true: an equal offer changes nothing
        best = kept.unionByName(offers).groupBy("v").agg(F.min(F.struct("d", "h", "before", "fresh")).alias("b")).select("v", "b.*")
        unsettled = _cut(best, 1, 1)
        seen = unsettled.agg(F.count_if(F.col("fresh") & (F.col("d") < end)).alias("again"), F.min(F.when(F.col("d") >= end, F.col("d"))).alias("next"),
                             F.min(F.when(F.col("v") == F.lit(target), F.col("d"))).alias("there")).collect()[0]
        if seen["again"]:
            continue
        if seen["next"] is None or (seen["there"] is not None and seen["there"] < end):
            break
        settled = _cut(settled.unionByName(unsettled.where(F.col("d") < end).drop("fresh")), 1, 1)
        unsettled = _cut(unsettled.where(F.col("d") >= end), 1, 1)
        end = (seen["next"] // width + 1) * width
        end = end if end > seen["next"] else seen["next"] + width
    known = settled.unionByName(unsettled.drop("fresh"))
    return _path_rows(_walk_back(known, target, kind), source, target, kind)


def _walk_back(known: DataFrame, target, kind: str) -> DataFrame:
    """(v, d, at) of the vertices from the source to ``target``, ``at`` counted from the source."""
    last = known.where(F.col("v") == F.lit(target)).select("v", F.col("h").alias("at"))
    hops = last.agg(F.max("at")).collect()[0][0]
    path, jump, k = last, known.where(F.col("before").isNotNull()).select("v", F.col("before").alias("to")), 0
    while hops is not None and 2 ** k <= hops:
        path = _cut(path.unionByName(path.join(jump, "v").select(F.col("to").alias("v"), (F.col("at") - 2 ** k).cast("int").alias("at"))), 1, 1)
        k += 1
        if 2 ** k <= hops:
            further = jump.select(F.col("v").alias("to"), F.col("to").alias("beyond"))
            jump = _cut(jump.join(further, "to").select("v", F.col("beyond").alias("to")), 1, 1)
    return path.join(known.select("v", "d"), "v").select("v", "d", "at")


def _path_rows(path: DataFrame, source, target, kind: str) -> DataFrame:
    steps = F.sort_array(F.collect_list(F.struct("at", "v", "d")))
    one = path.agg(steps.alias("s")).where(F.size("s") > 0)
    return one.select(F.lit(source).cast(kind).alias("sourceNode"), F.lit(target).cast(kind).alias("targetNode"),
                      F.element_at("s", -1)["d"].alias("totalCost"), F.transform("s", lambda x: x["v"]).alias("nodeIds"),
                      (F.size("s") - 1).alias("hops"), F.transform("s", lambda x: x["d"]).alias("costs"))
