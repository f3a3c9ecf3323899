"""Registered graph-load, pattern and degree queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from triad.operators import graph as G
from triad.plans.views_sql import _view, with_views
from triad.sources import testviews as V

# Parameters for the driver's tables (FIXTURES.md, "Thresholds").
GENRE = "ECONOMY"
MIN_MOVIE_AVG = 3.5
FIVESTAR_MIN = 10
PAIR = (3, 5)
TARGET_USER = 1
MIN_OVERLAP = 2
GENRE_MIN_COUNT = 1000
TOP_RATED_MIN = 30
SUPERNODE_MIN = 50


def graph(spark: SparkSession, sf_dir: str) -> G.PropertyGraph:
    return G.build_graph(V.users(spark, sf_dir), V.movies(spark, sf_dir),
                         V.ratings_raw(spark, sf_dir), V.RATING_ORDER)


def q_load_text_rows(spark: SparkSession, sf_dir: str):
    """The load from rows of text: counts and sums over what it made."""
    g = G.load_graph(*V.text_rows(spark, sf_dir))
    parts = [("users", g.users, F.sum(F.coalesce("age", F.lit(0)) + F.coalesce(F.col("occupation"), F.lit(-1)))),
             ("movies", g.movies, F.sum(F.length("title"))), ("genres", g.genres, F.sum(F.length("name"))),
             ("ratings", g.rated, F.sum(F.col("rating") + F.col("timestamp") % 1000)), ("has_genre", g.has_genre, F.sum("movie_id"))]
    out = None
    for name, df, total in parts:
        one = df.agg(F.count(F.lit(1)).alias("n"), total.cast("long").alias("total")).select(F.lit(name).alias("item"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


def q_merge_nodes_repeat(spark: SparkSession, sf_dir: str):
    """Repeated keys: a customer's last order, by date and key, sets the properties."""
    return G.merge_nodes(V.user_history(spark, sf_dir), "user_id", ["last_order", "price"], ["o_orderdate", "o_orderkey"])


def q_genre_top_rated(spark: SparkSession, sf_dir: str):
    """Only ratings of the genre's movies are joined with their users and merged."""
    movies = V.movies(spark, sf_dir)
    ratings = V.ratings_raw(spark, sf_dir, G.movies_of_genre(movies, GENRE))
    return G.genre_top_rated(G.build_graph(V.users(spark, sf_dir), movies, ratings, V.RATING_ORDER), GENRE, MIN_MOVIE_AVG)


QUERIES = {
    "load_text_rows": q_load_text_rows,
    "merge_nodes_repeat": q_merge_nodes_repeat,
    "graph_counts": lambda s, d: G.graph_counts(graph(s, d)),
    "edge_types": lambda s, d: G.edge_types(graph(s, d)),
    "key_violations": lambda s, d: G.key_violations(V.ratings_raw(s, d), ["user_id", "movie_id"]),
    "merge_users": lambda s, d: graph(s, d).users,
    "merge_ratings": lambda s, d: graph(s, d).rated,
    "has_genre": lambda s, d: graph(s, d).has_genre,
    "genre_top_rated": q_genre_top_rated,
    "heavy_fivestar_users": lambda s, d: G.heavy_fivestar_users(graph(s, d), 5, FIVESTAR_MIN),
    "both_rated_high": lambda s, d: G.both_rated_high(graph(s, d), PAIR[0], PAIR[1]),
    "genre_quality": lambda s, d: G.genre_quality(graph(s, d), GENRE_MIN_COUNT),
    "recommend": lambda s, d: G.recommend(graph(s, d), TARGET_USER, min_overlap=MIN_OVERLAP),
    "recommend_simple": lambda s, d: G.recommend_simple(graph(s, d), TARGET_USER),
    "top_rated_movies": lambda s, d: G.top_rated_movies(graph(s, d), TOP_RATED_MIN),
    "user_degree": lambda s, d: G.user_degree(graph(s, d)),
    "movie_degree": lambda s, d: G.movie_degree(graph(s, d)),
    "genre_degree": lambda s, d: G.genre_degree(graph(s, d)),
    "supernodes": lambda s, d: G.supernodes(graph(s, d), SUPERNODE_MIN),
    "degree_band": lambda s, d: G.degree_band(graph(s, d), 20, 30),
}

# Graph tables in SQL: vertices and deduplicated edges whose ends exist.
_view("g_users", "SELECT user_id, gender, age, occupation FROM users WHERE user_id IS NOT NULL", ("users",))
_view("g_movies", "SELECT movie_id, title FROM movies WHERE movie_id IS NOT NULL", ("movies",))
_view("g_genres", "SELECT DISTINCT genre AS name FROM genres_of", ("genres_of",))
_view("has_genre", "SELECT movie_id, genre FROM genres_of WHERE movie_id IN (SELECT movie_id FROM g_movies)",
      ("genres_of", "g_movies"))
_view("rated", """
SELECT user_id, movie_id, rating, "timestamp" FROM ratings
WHERE user_id IN (SELECT user_id FROM g_users) AND movie_id IN (SELECT movie_id FROM g_movies)
""", ("ratings", "g_users", "g_movies"))


def _r2(x: str) -> str:
    return f"floor({x} * 100.0 + 0.5) / 100.0"


ORACLE = {
    "load_text_rows": with_views("""
WITH t_users AS (
  SELECT CAST(user_id AS BIGINT) AS user_id, age, CASE WHEN user_id % 7 = 0 THEN -1 ELSE occupation END AS occupation
  FROM users WHERE user_id % 97 <> 0 AND user_id % 89 <> 0
), t_movies AS (
  SELECT movie_id, title FROM movies WHERE movie_id % 83 <> 0
), t_genres AS (
  SELECT movie_id, genre FROM genres_of WHERE movie_id % 11 <> 0
), t_rated AS (
  SELECT rating + "timestamp" % 1000 AS x FROM ratings WHERE user_id IN (SELECT user_id FROM t_users) AND movie_id IN (SELECT movie_id FROM t_movies)
)
SELECT 'users' AS item, count(*) AS n, CAST(sum(age + occupation) AS BIGINT) AS total FROM t_users UNION ALL
SELECT 'movies', count(*), CAST(sum(length(title)) AS BIGINT) FROM t_movies UNION ALL
SELECT 'genres', count(*), CAST(sum(length(genre)) AS BIGINT) FROM (SELECT DISTINCT genre FROM t_genres) UNION ALL
SELECT 'ratings', count(*), CAST(sum(x) AS BIGINT) FROM t_rated UNION ALL
SELECT 'has_genre', count(*), CAST(sum(movie_id) AS BIGINT) FROM t_genres JOIN t_movies USING (movie_id)""", "users", "movies", "genres_of", "ratings"),
    "merge_nodes_repeat": """
SELECT o_custkey AS user_id, o_orderkey AS last_order, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "graph_counts": with_views("""
SELECT 'users' AS item, count(*) AS n FROM g_users UNION ALL
SELECT 'movies', count(*) FROM g_movies UNION ALL
SELECT 'genres', count(*) FROM g_genres UNION ALL
SELECT 'ratings', count(*) FROM rated UNION ALL
SELECT 'has_genre', count(*) FROM has_genre""", "g_users", "g_movies", "g_genres", "rated", "has_genre"),

    "edge_types": with_views("""
SELECT relationshipType, count(*) AS relationshipCount FROM (
  SELECT 'RATED' AS relationshipType FROM rated UNION ALL SELECT 'HAS_GENRE' FROM has_genre)
GROUP BY 1 ORDER BY 2 DESC, 1""", "rated", "has_genre"),

    "key_violations": with_views("""
SELECT user_id, movie_id, count(*) AS n FROM ratings_raw GROUP BY 1, 2 HAVING count(*) > 1""",
                                 "ratings_raw"),

    "merge_users": with_views("SELECT * FROM g_users", "g_users"),
    "merge_ratings": with_views("SELECT * FROM rated", "rated"),
    "has_genre": with_views("SELECT * FROM has_genre", "has_genre"),

    "genre_top_rated": with_views(f"""
SELECT m.movie_id AS movieId, m.title, {_r2('avg(r.rating)')} AS avgRating, count(*) AS ratingsCount
FROM rated r JOIN has_genre h ON r.movie_id = h.movie_id AND h.genre = '{GENRE}'
JOIN g_movies m ON m.movie_id = r.movie_id
GROUP BY m.movie_id, m.title HAVING avg(r.rating) > {MIN_MOVIE_AVG}""", "rated", "has_genre", "g_movies"),

    "heavy_fivestar_users": with_views(f"""
SELECT u.user_id AS userId, u.gender, u.age, u.occupation, count(*) AS fiveStarCount
FROM rated r JOIN g_users u ON u.user_id = r.user_id
WHERE r.rating = 5 GROUP BY 1, 2, 3, 4 HAVING count(*) > {FIVESTAR_MIN}""", "rated", "g_users"),

    "both_rated_high": with_views(f"""
SELECT m.movie_id AS movieId, m.title, r1.rating AS ratingUser1, r2.rating AS ratingUser2
FROM rated r1 JOIN rated r2 ON r1.movie_id = r2.movie_id JOIN g_movies m ON m.movie_id = r1.movie_id
WHERE r1.user_id = {PAIR[0]} AND r2.user_id = {PAIR[1]} AND r1.rating >= 4 AND r2.rating >= 4""",
                                  "rated", "g_movies"),

    "genre_quality": with_views(f"""
SELECT h.genre, {_r2('avg(r.rating)')} AS avgRating, count(*) AS ratingsCount
FROM rated r JOIN has_genre h ON r.movie_id = h.movie_id
GROUP BY h.genre HAVING count(*) >= {GENRE_MIN_COUNT}""", "rated", "has_genre"),

    "recommend": with_views(f"""
WITH pairs AS (
  SELECT o.user_id AS other, count(*) AS overlap, avg(abs(t.rating - o.rating)) AS avg_diff
  FROM rated t JOIN rated o ON t.movie_id = o.movie_id
  WHERE t.user_id = {TARGET_USER} AND t.rating >= 4 AND o.rating >= 4 AND o.user_id <> {TARGET_USER}
  GROUP BY o.user_id),
nb AS (SELECT other FROM pairs WHERE overlap >= {MIN_OVERLAP} AND avg_diff <= 1.0),
rec AS (
  SELECT r2.movie_id, count(DISTINCT r2.user_id) AS similarUsersCount, avg(r2.rating) AS a
  FROM rated r2 JOIN nb ON r2.user_id = nb.other
  WHERE r2.rating >= 4 AND r2.movie_id NOT IN (SELECT movie_id FROM rated WHERE user_id = {TARGET_USER})
  GROUP BY r2.movie_id)
SELECT rec.movie_id AS movieId, m.title, similarUsersCount, {_r2('a')} AS avgRecommendedRating
FROM rec JOIN g_movies m ON m.movie_id = rec.movie_id
ORDER BY similarUsersCount DESC, avgRecommendedRating DESC, title ASC, movieId ASC
LIMIT 20""", "rated", "g_movies"),

    "recommend_simple": with_views(f"""
WITH seen AS (SELECT movie_id FROM rated WHERE user_id = {TARGET_USER}),
shared_films AS (SELECT user_id, count(*) AS w FROM rated SEMI JOIN seen USING (movie_id) WHERE user_id <> {TARGET_USER} GROUP BY user_id),
unseen AS (SELECT user_id, movie_id FROM rated ANTI JOIN seen USING (movie_id))
SELECT title, sum(w)::BIGINT AS score
FROM unseen JOIN shared_films USING (user_id) JOIN g_movies USING (movie_id)
GROUP BY title ORDER BY score DESC, title LIMIT 10""", "rated", "g_movies"),

    "top_rated_movies": with_views(f"""
SELECT m.movie_id AS movieId, m.title, {_r2('avg(r.rating)')} AS avgRating, count(*) AS ratingsCount
FROM rated r JOIN g_movies m ON m.movie_id = r.movie_id
GROUP BY 1, 2 HAVING count(*) >= {TOP_RATED_MIN}
ORDER BY avgRating DESC, ratingsCount DESC, movieId LIMIT 20""", "rated", "g_movies"),

    "user_degree": with_views("""
SELECT user_id AS userId, count(*) AS degree FROM rated GROUP BY 1 ORDER BY degree DESC, userId LIMIT 20""",
                              "rated"),

    "movie_degree": with_views("""
SELECT m.movie_id AS movieId, m.title, count(*) AS degree FROM rated r JOIN g_movies m USING (movie_id)
GROUP BY 1, 2 ORDER BY degree DESC, movieId LIMIT 20""", "rated", "g_movies"),

    "genre_degree": with_views("""
SELECT genre, count(*) AS degree FROM has_genre GROUP BY 1 ORDER BY degree DESC, genre LIMIT 20""",
                               "has_genre"),

    "supernodes": with_views(f"""
WITH ends AS (
  SELECT 'User' AS label, CAST(user_id AS VARCHAR) AS id FROM rated UNION ALL
  SELECT 'Movie', CAST(movie_id AS VARCHAR) FROM rated UNION ALL
  SELECT 'Movie', CAST(movie_id AS VARCHAR) FROM has_genre UNION ALL
  SELECT 'Genre', genre FROM has_genre)
SELECT label AS nodeLabels, id AS identifier, count(*) AS degree FROM ends
GROUP BY 1, 2 HAVING count(*) > {SUPERNODE_MIN}
ORDER BY degree DESC, nodeLabels, identifier LIMIT 50""", "rated", "has_genre"),

    "degree_band": with_views("""
SELECT m.movie_id AS movieId, m.title, count(*) AS ratingCount FROM rated r JOIN g_movies m USING (movie_id)
GROUP BY 1, 2 HAVING count(*) BETWEEN 20 AND 30
ORDER BY ratingCount DESC, movieId LIMIT 20""", "rated", "g_movies"),
}
