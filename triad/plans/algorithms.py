"""Registered derived-edge and graph-algorithm queries with their oracle SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from triad.operators import algorithms as A
from triad.operators import derive as DV
from triad.plans.graph import graph
from triad.plans.views_sql import _view, with_views

# Parameters for the driver's tables (FIXTURES.md, "Thresholds").
HUB_MIN = 35          # movies with at least this many ratings (500 in the reference)
CO_RATING = 5
CO_WEIGHT = 2
ACTIVE_MIN = 20
ACTIVE_K = 10
STRONGEST_K = 50000
PR_ITER = 20
PAIRS = [(1, 100)]    # hop-path report: user 1 to user 100, and to the most active users
REPORT_ACTIVE = 5


def _co_rated(g):
    return DV.co_rated_edges(g, CO_RATING, HUB_MIN, CO_WEIGHT)


def q_co_rated_edges(spark, sf_dir):
    return _co_rated(graph(spark, sf_dir))


def q_co_rated_top(spark, sf_dir):
    """Task variant: liked (>= 4) by the same user, both movies with more than
    20 ratings, the 50,000 strongest pairs."""
    return DV.co_rated_edges(graph(spark, sf_dir), 4, 21, 1, top=STRONGEST_K)


def q_active_users(spark, sf_dir):
    return DV.active_users(graph(spark, sf_dir), ACTIVE_MIN, ACTIVE_K)


def q_similar_edges(spark, sf_dir):
    return DV.similar_edges(graph(spark, sf_dir), 4, ACTIVE_MIN, ACTIVE_K)


def q_strongest_edges(spark, sf_dir):
    return DV.all_similar_edges(graph(spark, sf_dir), 4, STRONGEST_K)


def q_strongest_pair(spark, sf_dir):
    return DV.strongest_pair(DV.similar_edges(graph(spark, sf_dir), 4, ACTIVE_MIN, ACTIVE_K))


def _pagerank(g):
    return A.pagerank(_co_rated(g), g.movies, "m1", "m2", "weight", "movie_id", max_iter=PR_ITER)


def q_pagerank(spark, sf_dir):
    g = graph(spark, sf_dir)
    s = _pagerank(g)
    return s.join(g.movies, s.id == g.movies.movie_id).select(
        F.col("movie_id").alias("movieId"), "title", F.round("score", 6).alias("score")) \
        .orderBy(F.desc("score"), "movieId").limit(20)


def q_vertices_with_scores(spark, sf_dir):
    g = graph(spark, sf_dir)
    s = _pagerank(g)
    return g.movies.join(s.withColumnRenamed("id", "movie_id"), "movie_id", "left").select(
        "movie_id", "title", F.round("score", 6).alias("pagerank"))


def _users_graph(g):
    e = DV.similar_edges(g, 4, ACTIVE_MIN, ACTIVE_K)
    return e, g.users


def q_communities(spark, sf_dir):
    g = graph(spark, sf_dir)
    e, users = _users_graph(g)
    return A.louvain(e, users, "u1", "u2", "weight", "user_id")


def q_louvain_sizes(spark, sf_dir):
    return A.community_sizes(q_communities(spark, sf_dir))


def q_louvain_top_genres(spark, sf_dir):
    g = graph(spark, sf_dir)
    e, users = _users_graph(g)
    return A.community_top_genres(A.louvain(e, users, "u1", "u2", "weight", "user_id"), g.rated, g.has_genre)


def q_louvain_quality(spark, sf_dir):
    """Communities with more than one member, and the modularity of the labelling."""
    e, users = _users_graph(_stored_graph(spark, sf_dir))
    e = A.stored(e, "similar")
    labels = A._cut(A.louvain(e, users, "u1", "u2", "weight", "user_id"), 1, 1)
    q = A.modularity(e, labels, "u1", "u2", "weight")
    large = labels.groupBy("community").count().where("count > 1")
    return large.agg(F.count(F.lit(1)).alias("communities"), F.sum("count").alias("members")).withColumn("modularity", F.round(F.lit(q), 6))


def _stored_graph(spark, sf_dir):
    """The graph with its ratings written once, for queries that read them several times."""
    g = graph(spark, sf_dir)
    return replace(g, rated=A.stored(g.rated, "rated"))


def _segments(g):
    """A given labelling for the SQL-checked community queries: the user's segment."""
    return g.users.select(F.col("user_id").alias("id"), F.col("gender").alias("community"))


def q_community_sizes(spark, sf_dir):
    return A.community_sizes(_segments(graph(spark, sf_dir)))


def q_community_top_genres(spark, sf_dir):
    g = graph(spark, sf_dir)
    return A.community_top_genres(_segments(g), g.rated, g.has_genre)


def _caption_keys(g):
    """RATED edges between string keys 'u:<id>' and 'm:<id>'."""
    return g.rated.select(F.concat(F.lit("u:"), F.col("user_id").cast("string")).alias("src"),
                          F.concat(F.lit("m:"), F.col("movie_id").cast("string")).alias("dst"))


def _captions(g, path_df):
    """Replace keys by captions: 'User(<id>)' / 'Movie(<title>)'."""
    titles = g.movies.select(F.concat(F.lit("m:"), F.col("movie_id").cast("string")).alias("k"), "title")
    ex = path_df.select("*", F.posexplode("path").alias("pos", "k"))
    named = ex.join(titles, "k", "left").select(
        *[c for c in path_df.columns if c != "path"], "pos",
        F.when(F.col("k").startswith("u:"), F.concat(F.lit("User("), F.substring("k", 3, 1 << 20), F.lit(")")))
        .otherwise(F.concat(F.lit("Movie("), F.col("title"), F.lit(")"))).alias("caption"))
    keys = [c for c in path_df.columns if c != "path"]
    return named.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "caption"))), lambda x: x["caption"]),
                     " -> ").alias("pathNodes"))


def q_hop_path(spark, sf_dir):
    g = graph(spark, sf_dir)
    u1, u2 = PAIRS[0]
    p = A.hop_path(_caption_keys(g), f"u:{u1}", f"u:{u2}", 6)
    return _captions(g, p.select(F.col("length").alias("pathLength"), "path"))


def q_path_report(spark, sf_dir):
    """Hop distance from user 1 to user 100 and to the most active users, and the mean."""
    g = _stored_graph(spark, sf_dir)
    u1, u2 = PAIRS[0]
    act = DV.active_users(g, ACTIVE_MIN, REPORT_ACTIVE).select(F.col("user_id").alias("b"))
    pairs = act.select(F.lit(u1).cast("long").alias("a"), "b").unionByName(
        spark.createDataFrame([(u1, u2)], "a long, b long")).where(F.col("a") != F.col("b")).select(
        F.concat(F.lit("u:"), F.col("a").cast("string")).alias("source"),
        F.concat(F.lit("u:"), F.col("b").cast("string")).alias("target"))
    p = A.hop_paths(_caption_keys(g), pairs, 6)
    per_pair = p.select(F.substring("source", 3, 20).cast("long").alias("u1"),
                        F.substring("target", 3, 20).cast("long").alias("u2"),
                        F.col("length").alias("pathLength"))
    mean = per_pair.agg(F.avg("pathLength")).scalar()
    return per_pair.withColumn("meanLength", F.round(mean, 6))


def _path_columns(p):
    """The whole path as text; running costs in billionths."""
    return p.select(F.col("sourceNode").cast("long").alias("sourceUser"), F.col("targetNode").cast("long").alias("targetUser"),
                    F.round("totalCost", 9).alias("totalCost"),
                    F.array_join(F.transform("nodeIds", lambda x: x.cast("string")), ",").alias("userPath"),
                    "hops",
                    F.array_join(F.transform("costs", lambda x: F.round(x * 1e9).cast("long").cast("string")), ",")
                    .alias("costs_nano"))


def q_weighted_path(spark, sf_dir):
    """Cheapest path between the ends of the strongest similarity edge."""
    g = graph(spark, sf_dir)
    e = DV.similar_edges(g, 4, ACTIVE_MIN, ACTIVE_K)
    s, t = DV.strongest_pair(e).select("u1", "u2").collect()[0]
    return _path_columns(A.weighted_path(e, s, t, "u1", "u2", "distance"))


def q_weighted_path_far(spark, sf_dir):
    """Cheapest path between two users without an edge of their own: the two largest ids outside the active users."""
    g = graph(spark, sf_dir)
    e = DV.similar_edges(g, 4, ACTIVE_MIN, ACTIVE_K)
    act = DV.active_users(g, ACTIVE_MIN, ACTIVE_K).select(F.col("user_id").alias("u2"))
    ends = [r[0] for r in e.select("u2").join(act, "u2", "left_anti").distinct().orderBy(F.desc("u2")).limit(2).collect()]
    s, t = ends if len(ends) == 2 else (None, None)  # no such pair: no path
    return _path_columns(A.weighted_path(e, s, t, "u1", "u2", "distance"))


QUERIES = {
    "co_rated_edges": q_co_rated_edges,
    "co_rated_top": q_co_rated_top,
    "active_users": q_active_users,
    "similar_edges": q_similar_edges,
    "strongest_edges": q_strongest_edges,
    "strongest_pair": q_strongest_pair,
    "pagerank": q_pagerank,
    "vertices_with_scores": q_vertices_with_scores,
    "communities": q_communities,
    "louvain_sizes": q_louvain_sizes,
    "louvain_top_genres": q_louvain_top_genres,
    "louvain_quality": q_louvain_quality,
    "community_sizes": q_community_sizes,
    "community_top_genres": q_community_top_genres,
    "hop_path": q_hop_path,
    "path_report": q_path_report,
    "weighted_path": q_weighted_path,
    "weighted_path_far": q_weighted_path_far,
}

# ------------------------------------------------------------- SQL

_view("co_rated", f"""
SELECT r1.movie_id AS m1, r2.movie_id AS m2, count(*) AS weight
FROM rated r1 JOIN rated r2 ON r1.user_id = r2.user_id AND r1.movie_id < r2.movie_id
WHERE r1.rating >= {CO_RATING} AND r2.rating >= {CO_RATING}
  AND r1.movie_id IN (SELECT movie_id FROM rated GROUP BY movie_id HAVING count(*) >= {HUB_MIN})
  AND r2.movie_id IN (SELECT movie_id FROM rated GROUP BY movie_id HAVING count(*) >= {HUB_MIN})
GROUP BY 1, 2 HAVING count(*) >= {CO_WEIGHT}
""", ("rated",))

_view("active", f"""
SELECT user_id, count(*) AS ratingCount FROM rated GROUP BY 1 HAVING count(*) >= {ACTIVE_MIN}
ORDER BY ratingCount DESC, user_id LIMIT {ACTIVE_K}
""", ("rated",))

_view("sim_edges", """
SELECT r1.user_id AS u1, r2.user_id AS u2, count(*) AS weight, 1.0 / count(*) AS distance
FROM rated r1 JOIN rated r2 ON r1.movie_id = r2.movie_id AND r1.user_id < r2.user_id
WHERE r1.rating >= 4 AND r2.rating >= 4 AND r1.user_id IN (SELECT user_id FROM active)
GROUP BY 1, 2
""", ("rated", "active"))


def _pagerank_sql(n_iter: int = PR_ITER) -> str:
    steps = ["pr0 AS (SELECT id, CAST(1.0 AS DOUBLE) - CAST(0.85 AS DOUBLE) AS r FROM pr_v)"]
    for i in range(1, n_iter + 1):
        steps.append(
            f"pr{i} AS (SELECT v.id, (CAST(1.0 AS DOUBLE) - CAST(0.85 AS DOUBLE)) + CAST(0.85 AS DOUBLE) * coalesce(s.s, 0.0) AS r "
            f"FROM pr_v v LEFT JOIN (SELECT p.dst, sum(x.r * p.p) AS s FROM pr_p p JOIN pr{i - 1} x ON x.id = p.src "
            f"GROUP BY p.dst) s ON s.dst = v.id)")
    return ",\n".join([
        "pr_e AS (SELECT m1 AS src, m2 AS dst, CAST(weight AS DOUBLE) AS w FROM co_rated "
        "UNION ALL SELECT m2, m1, CAST(weight AS DOUBLE) FROM co_rated)",
        "pr_p AS (SELECT e.src, e.dst, e.w / o.tw AS p FROM pr_e e JOIN "
        "(SELECT src, sum(w) AS tw FROM pr_e GROUP BY src) o ON o.src = e.src)",
        "pr_v AS (SELECT movie_id AS id FROM g_movies)",
    ] + steps) + f",\npr AS (SELECT id, r AS score FROM pr{n_iter})"


def _cheapest_sql(ends: str) -> str:
    """The cheapest path between ``ends`` (s, t), relaxed until nothing improves: one kept row a vertex, then the walk back."""
    return f"""
WITH RECURSIVE wp_e AS (
  SELECT u1 AS a, u2 AS b, distance AS w FROM sim_edges UNION ALL SELECT u2, u1, distance FROM sim_edges
), wp_ends AS ({ends}), wp(v, c) USING KEY (v) AS (
  SELECT s, {{'d': CAST(0 AS DOUBLE), 'h': 0, 'p': CAST(-1 AS BIGINT)}} FROM wp_ends
  UNION
  SELECT n.b, n.c
  FROM (SELECT e.b, min({{'d': x.c.d + e.w, 'h': x.c.h + 1, 'p': CAST(x.v AS BIGINT)}}) AS c FROM wp x JOIN wp_e e ON e.a = x.v GROUP BY e.b) n
  LEFT JOIN recurring.wp r ON r.v = n.b WHERE r.v IS NULL OR n.c < r.c
), back AS (
  SELECT wp.v, wp.c FROM wp JOIN wp_ends ON wp.v = t
  UNION ALL
  SELECT wp.v, wp.c FROM back JOIN wp ON wp.v = back.c.p
)
SELECT CAST(s AS BIGINT) AS sourceUser, CAST(t AS BIGINT) AS targetUser, round(max(back.c.d), 9) AS totalCost,
       string_agg(CAST(back.v AS VARCHAR), ',' ORDER BY back.c.h) AS userPath, max(back.c.h) AS hops,
       string_agg(CAST(CAST(round(back.c.d * 1e9) AS BIGINT) AS VARCHAR), ',' ORDER BY back.c.h) AS costs_nano
FROM back, wp_ends GROUP BY s, t"""


def _bfs_sql(pairs_sql: str, max_hops: int = 6) -> str:
    """Level-by-level BFS from each source; ``bfs_hits(s, t, path, length)``."""
    parts = [
        f"bfs_pairs AS ({pairs_sql})",
        "bfs_e AS (SELECT 'u:' || CAST(user_id AS VARCHAR) AS a, 'm:' || CAST(movie_id AS VARCHAR) AS b FROM rated "
        "UNION ALL SELECT 'm:' || CAST(movie_id AS VARCHAR), 'u:' || CAST(user_id AS VARCHAR) FROM rated)",
        "l0 AS (SELECT s, s AS node, [s] AS path FROM bfs_pairs)",
        "seen0 AS (SELECT s, node FROM l0)",
    ]
    for d in range(1, max_hops + 1):
        parts.append(
            f"l{d} AS (SELECT f.s, e.b AS node, min(list_append(f.path, e.b)) AS path FROM l{d - 1} f "
            f"JOIN bfs_e e ON e.a = f.node WHERE NOT EXISTS (SELECT 1 FROM seen{d - 1} v WHERE v.s = f.s AND v.node = e.b) "
            f"GROUP BY f.s, e.b)")
        parts.append(f"seen{d} AS (SELECT s, node FROM seen{d - 1} UNION ALL SELECT s, node FROM l{d})")
    hits = " UNION ALL ".join(
        f"SELECT p.s, p.t, l.path, {d} AS length FROM bfs_pairs p JOIN l{d} l ON l.s = p.s AND l.node = p.t"
        for d in range(1, max_hops + 1))
    parts.append(f"bfs_all AS ({hits})")
    parts.append("bfs_hits AS (SELECT s, t, arg_min(path, length) AS path, min(length) AS length FROM bfs_all GROUP BY s, t)")
    return ",\n".join(parts)


ORACLE = {
    "co_rated_edges": with_views("SELECT * FROM co_rated", "co_rated"),
    "co_rated_top": with_views(f"""
SELECT r1.movie_id AS m1, r2.movie_id AS m2, count(*) AS weight
FROM rated r1 JOIN rated r2 ON r1.user_id = r2.user_id AND r1.movie_id < r2.movie_id
WHERE r1.rating >= 4 AND r2.rating >= 4
  AND r1.movie_id IN (SELECT movie_id FROM rated GROUP BY movie_id HAVING count(*) > 20)
  AND r2.movie_id IN (SELECT movie_id FROM rated GROUP BY movie_id HAVING count(*) > 20)
GROUP BY 1, 2 ORDER BY weight DESC, m1, m2 LIMIT {STRONGEST_K}""", "rated"),
    "active_users": with_views("SELECT * FROM active", "active"),
    "similar_edges": with_views("SELECT * FROM sim_edges", "sim_edges"),
    "strongest_edges": with_views(f"""
SELECT r1.user_id AS u1, r2.user_id AS u2, count(*) AS weight, 1.0 / count(*) AS distance
FROM rated r1 JOIN rated r2 ON r1.movie_id = r2.movie_id AND r1.user_id < r2.user_id
WHERE r1.rating >= 4 AND r2.rating >= 4
GROUP BY 1, 2 ORDER BY weight DESC, u1, u2 LIMIT {STRONGEST_K}""", "rated"),
    "strongest_pair": with_views("SELECT * FROM sim_edges ORDER BY weight DESC, u1, u2 LIMIT 1", "sim_edges"),
    "pagerank": with_views(f"""
WITH {_pagerank_sql()}
SELECT m.movie_id AS movieId, m.title, round(pr.score, 6) AS score
FROM pr JOIN g_movies m ON m.movie_id = pr.id ORDER BY score DESC, movieId LIMIT 20""", "co_rated", "g_movies"),
    "vertices_with_scores": with_views(f"""
WITH {_pagerank_sql()}
SELECT m.movie_id, m.title, round(pr.score, 6) AS pagerank FROM g_movies m LEFT JOIN pr ON pr.id = m.movie_id""",
                                       "co_rated", "g_movies"),
    "community_sizes": with_views("""
SELECT gender AS community, count(*) AS clusterSize FROM g_users GROUP BY 1
ORDER BY clusterSize DESC, community LIMIT 10""", "g_users"),
    "community_top_genres": with_views("""
SELECT community, CAST(rank AS INTEGER) AS rank, genre, freq FROM (
  SELECT u.gender AS community, h.genre, count(*) AS freq,
         row_number() OVER (PARTITION BY u.gender ORDER BY count(*) DESC, h.genre) AS rank
  FROM rated r JOIN g_users u ON u.user_id = r.user_id JOIN has_genre h ON h.movie_id = r.movie_id
  WHERE r.rating >= 4 GROUP BY 1, 2) WHERE rank <= 3""", "rated", "g_users", "has_genre"),
    "hop_path": with_views(f"""
WITH {_bfs_sql(f"SELECT 'u:{PAIRS[0][0]}' AS s, 'u:{PAIRS[0][1]}' AS t")}
SELECT CAST(length AS INTEGER) AS pathLength, string_agg(cap, ' -> ' ORDER BY pos) AS pathNodes FROM (
  SELECT hp.length, hp.pos,
         CASE WHEN starts_with(hp.k, 'u:') THEN 'User(' || substr(hp.k, 3) || ')' ELSE 'Movie(' || m.title || ')' END AS cap
  FROM (SELECT length, unnest(path) AS k, unnest(generate_series(1, len(path))) AS pos FROM bfs_hits) hp
  LEFT JOIN g_movies m ON 'm:' || CAST(m.movie_id AS VARCHAR) = hp.k)
GROUP BY length""", "rated", "g_movies"),
    "path_report": with_views(f"""
WITH {_bfs_sql(f"SELECT DISTINCT * FROM (SELECT 'u:{PAIRS[0][0]}' AS s, 'u:' || CAST(user_id AS VARCHAR) AS t FROM (SELECT user_id FROM active ORDER BY ratingCount DESC, user_id LIMIT {REPORT_ACTIVE}) UNION ALL SELECT 'u:{PAIRS[0][0]}', 'u:{PAIRS[0][1]}') WHERE s <> t")}
SELECT CAST(substr(s, 3) AS BIGINT) AS u1, CAST(substr(t, 3) AS BIGINT) AS u2, CAST(length AS INTEGER) AS pathLength,
       round(avg(length) OVER (), 6) AS meanLength
FROM bfs_hits""", "rated", "active"),
    "weighted_path": with_views(_cheapest_sql("SELECT u1 AS s, u2 AS t FROM sim_edges ORDER BY weight DESC, u1, u2 LIMIT 1"), "sim_edges"),
    "weighted_path_far": with_views(_cheapest_sql("""
  SELECT max(v) AS s, min(v) AS t
  FROM (SELECT DISTINCT u2 AS v FROM sim_edges WHERE u2 NOT IN (SELECT user_id FROM active) ORDER BY v DESC LIMIT 2) HAVING count(*) = 2"""),
                                     "sim_edges", "active"),
}
