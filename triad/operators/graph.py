"""Property graph as vertex and edge DataFrames; load, patterns and degrees.

Vertices: ``users(user_id, gender, age, occupation)``, ``movies(movie_id, title)``,
``genres(name)``. Edges: ``rated(user_id, movie_id, rating, timestamp)``,
``has_genre(movie_id, genre)``. Patterns are joins; a negative pattern is a
left-anti join; nothing is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.functions.numeric import round_half_up, to_integer
from triad.functions.text import strip_ws
from triad.operators.sinks import last_write_wins
from triad.sources.files import rows_with_keys


@dataclass
class PropertyGraph:
    users: DataFrame
    movies: DataFrame
    genres: DataFrame
    rated: DataFrame
    has_genre: DataFrame


# ------------------------------------------------------------- load

def _in_order(rows: DataFrame, order: list[str] | None) -> tuple[DataFrame, list[str]]:
    """``rows`` with order columns: the given ones, else those of the source (``_order``), else numbers in read order."""
    if order:
        return rows, order
    if "_order" in rows.columns:
        return rows, ["_order"]
    return rows.withColumn("_order", F.monotonically_increasing_id()), ["_order"]


def merge_nodes(rows: DataFrame, key: str, set_cols: list[str], order: list[str] | None = None) -> DataFrame:
    """One vertex per non-null key; the last row sets the properties.

    Last is by ``order``, else by the source's ``_order`` column (``sources.files.in_file_order``), else in the
    order the rows are read, which is the source's only if nothing shuffled them before.
    """
    rows, order = _in_order(rows, order)
    return last_write_wins(rows_with_keys(rows, key), [key], order, set_cols)


def genre_names(movie_rows: DataFrame, sep: str = "|") -> DataFrame:
    """(movie_id, genre) for every genre named in a movie row (split, trimmed)."""
    pat = "\\" + sep if sep in ".^$|?*+()[]{}\\" else sep
    return movie_rows.where(F.col("movie_id").isNotNull() & F.col("genres").isNotNull()).select(
        "movie_id", F.explode(F.split("genres", pat, -1)).alias("g")
    ).select("movie_id", strip_ws(F.col("g")).alias("genre"))


def merge_edges(rows: DataFrame, src_key: str, src_nodes: DataFrame, dst_key: str,
                dst_nodes: DataFrame, set_cols: list[str], order: list[str] | None = None) -> DataFrame:
    """One edge per (src, dst) whose both end vertices exist; the last row sets the properties, as in ``merge_nodes``."""
    rows, order = _in_order(rows, order)
    deduped = last_write_wins(rows_with_keys(rows, src_key, dst_key), [src_key, dst_key], order, set_cols)
    # Dedupe first (partial aggregation shrinks the data before the joins);
    # the existence checks are semi-joins, broadcast by AQE when measured small.
    deduped = deduped.join(src_nodes.select(src_key), src_key, "left_semi")
    return deduped.join(dst_nodes.select(dst_key), dst_key, "left_semi")


def build_graph(user_rows: DataFrame, movie_rows: DataFrame, rating_rows: DataFrame,
                rating_order: list[str] | None = None) -> PropertyGraph:
    users = merge_nodes(user_rows, "user_id", ["gender", "age", "occupation"])
    movies = merge_nodes(movie_rows, "movie_id", ["title"])
    named = genre_names(movie_rows)
    genres = named.select(F.col("genre").alias("name")).distinct()
    has_genre = named.join(movies.select("movie_id"), "movie_id", "left_semi").distinct()
    rated = merge_edges(rating_rows, "user_id", users, "movie_id", movies,
                        ["rating", "timestamp"], rating_order)
    return PropertyGraph(users, movies, genres, rated.select("user_id", "movie_id", "rating", "timestamp"),
                         has_genre)


def load_graph(users: DataFrame, movies: DataFrame, ratings: DataFrame) -> PropertyGraph:
    """Graph from rows of text fields, as ``sources.files.read_csv_rows`` gives them: users (userId, gender, age, occupation),
    movies (movieId, title, genres), ratings (userId, movieId, rating, timestamp).

    Rows without a key field are skipped; a key that is no whole number is no key. Other bad numbers become null.
    Repeated keys, also over several files, keep the last row's properties. Ratings of unknown users or movies
    make no edge. A movie without genres is a vertex without genre edges.
    """
    keep = lambda df: ["_order"] if "_order" in df.columns else []
    user_rows = rows_with_keys(users, "userId").select(
        to_integer("userId", "long").alias("user_id"), "gender", to_integer("age").alias("age"), to_integer("occupation").alias("occupation"), *keep(users))
    movie_rows = rows_with_keys(movies, "movieId").select(to_integer("movieId", "long").alias("movie_id"), "title", "genres", *keep(movies))
    rating_rows = rows_with_keys(ratings, "userId", "movieId").select(
        to_integer("userId", "long").alias("user_id"), to_integer("movieId", "long").alias("movie_id"),
        to_integer("rating").alias("rating"), to_integer("timestamp", "long").alias("timestamp"), *keep(ratings))
    g = build_graph(user_rows, movie_rows, rating_rows)
    # genres are vertices whether or not their movie has a key
    named = genre_names(movies.where(F.col("genres").isNotNull()).select(F.lit(0).alias("movie_id"), "genres"))
    g.genres = named.select(F.col("genre").alias("name")).distinct()
    return g


# ------------------------------------------------------------- checks

def graph_counts(g: PropertyGraph) -> DataFrame:
    parts = [("users", g.users), ("movies", g.movies), ("genres", g.genres),
             ("ratings", g.rated), ("has_genre", g.has_genre)]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("item"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def edge_types(g: PropertyGraph) -> DataFrame:
    e = g.rated.select(F.lit("RATED").alias("relationshipType")).unionByName(
        g.has_genre.select(F.lit("HAS_GENRE").alias("relationshipType")))
    return e.groupBy("relationshipType").agg(F.count(F.lit(1)).alias("relationshipCount")) \
        .orderBy(F.desc("relationshipCount"), "relationshipType")


def key_violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row (must be empty for a unique key)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


# ------------------------------------------------------------- patterns

def _movie_avg(rated: DataFrame) -> DataFrame:
    return rated.groupBy("movie_id").agg(F.avg("rating").alias("avg_rating"),
                                         F.count(F.lit(1)).alias("ratings_count"))


def genre_top_rated(g: PropertyGraph, genre: str = "Thriller", min_avg: float = 4.0) -> DataFrame:
    """Movies of one genre whose average rating is above ``min_avg``."""
    in_genre = g.has_genre.where(F.col("genre") == genre).select("movie_id")
    r = g.rated.join(in_genre, "movie_id", "left_semi")
    s = _movie_avg(r).where(F.col("avg_rating") > min_avg).join(g.movies, "movie_id")
    return s.select(F.col("movie_id").alias("movieId"), "title",
                    round_half_up(F.col("avg_rating"), 2).alias("avgRating"),
                    F.col("ratings_count").alias("ratingsCount")) \
        .orderBy(F.desc("avgRating"), F.desc("ratingsCount"), "title", "movieId")


def movies_of_genre(movie_rows: DataFrame, genre: str) -> DataFrame:
    """Keys (movie_id) of one genre's movies: where a graph is only asked for those, a source need not join or merge the ratings
    of others."""
    return genre_names(movie_rows).where(F.col("genre") == genre).select("movie_id").distinct()


def heavy_fivestar_users(g: PropertyGraph, rating: int = 5, min_count: int = 50) -> DataFrame:
    c = g.rated.where(F.col("rating") == rating).groupBy("user_id") \
        .agg(F.count(F.lit(1)).alias("fiveStarCount")).where(F.col("fiveStarCount") > min_count)
    return c.join(g.users, "user_id").select(
        F.col("user_id").alias("userId"), "gender", "age", "occupation", "fiveStarCount") \
        .orderBy(F.desc("fiveStarCount"), "userId")


def both_rated_high(g: PropertyGraph, user1: int = 1, user2: int = 2, min_rating: int = 4) -> DataFrame:
    r1 = g.rated.where((F.col("user_id") == user1) & (F.col("rating") >= min_rating)) \
        .select("movie_id", F.col("rating").alias("ratingUser1"))
    r2 = g.rated.where((F.col("user_id") == user2) & (F.col("rating") >= min_rating)) \
        .select("movie_id", F.col("rating").alias("ratingUser2"))
    return r1.join(r2, "movie_id").join(g.movies, "movie_id").select(
        F.col("movie_id").alias("movieId"), "title", "ratingUser1", "ratingUser2") \
        .orderBy("title", "movieId")


def genre_quality(g: PropertyGraph, min_count: int = 1000) -> DataFrame:
    """Average rating per genre over every rating of its movies."""
    per_movie = g.rated.groupBy("movie_id").agg(F.sum("rating").alias("s"), F.count(F.lit(1)).alias("c"))
    j = per_movie.join(g.has_genre, "movie_id")
    s = j.groupBy("genre").agg((F.sum("s") / F.sum("c")).alias("avg_rating"), F.sum("c").alias("ratingsCount"))
    return s.where(F.col("ratingsCount") >= min_count).select(
        "genre", round_half_up(F.col("avg_rating"), 2).alias("avgRating"), "ratingsCount") \
        .orderBy(F.desc("avgRating"), F.desc("ratingsCount"), "genre")


def recommend(g: PropertyGraph, user: int = 1, min_rating: int = 4, min_overlap: int = 3,
              max_diff: float = 1.0, k: int = 20) -> DataFrame:
    """Users sharing enough liked movies with ``user`` recommend what they liked
    and ``user`` has not rated."""
    likes = g.rated.where(F.col("rating") >= min_rating).select("user_id", "movie_id", "rating")
    mine = likes.where(F.col("user_id") == user).select("movie_id", F.col("rating").alias("tr"))
    theirs = likes.where(F.col("user_id") != user).select(
        F.col("user_id").alias("other"), "movie_id", F.col("rating").alias("orr"))
    pairs = mine.join(theirs, "movie_id").groupBy("other").agg(
        F.count(F.lit(1)).alias("overlap"), F.avg(F.abs(F.col("tr") - F.col("orr"))).alias("avg_diff"))
    neighbours = pairs.where((F.col("overlap") >= min_overlap) & (F.col("avg_diff") <= max_diff)).select("other")
    cand = likes.join(neighbours, likes.user_id == neighbours.other, "inner").select(
        "other", "movie_id", "rating")
    seen = g.rated.where(F.col("user_id") == user).select("movie_id")
    cand = cand.join(seen, "movie_id", "left_anti")
    rec = cand.groupBy("movie_id").agg(F.countDistinct("other").alias("similarUsersCount"),
                                       F.avg("rating").alias("avg_r"))
    return rec.join(g.movies, "movie_id").select(
        F.col("movie_id").alias("movieId"), "title", "similarUsersCount",
        round_half_up(F.col("avg_r"), 2).alias("avgRecommendedRating")) \
        .orderBy(F.desc("similarUsersCount"), F.desc("avgRecommendedRating"), "title", "movieId").limit(k)


def recommend_simple(g: PropertyGraph, user: int = 1, k: int = 10) -> DataFrame:
    """Count of 3-hop paths user->movie<-other->rec over titles the user has not rated.

    Paths are counted without listing them: common movies per other user
    first, then that weight summed over the other user's ratings.
    """
    mine = g.rated.where(F.col("user_id") == user).select("movie_id")
    common = g.rated.join(mine, "movie_id", "left_semi").where(F.col("user_id") != user) \
        .groupBy("user_id").agg(F.count(F.lit(1)).alias("w"))
    reach = g.rated.select("user_id", "movie_id").join(common, "user_id") \
        .join(mine, "movie_id", "left_anti")
    per_movie = reach.groupBy("movie_id").agg(F.sum("w").alias("w"))
    return per_movie.join(g.movies, "movie_id").groupBy("title").agg(F.sum("w").alias("score")) \
        .orderBy(F.desc("score"), "title").limit(k)


def top_rated_movies(g: PropertyGraph, min_count: int = 100, k: int = 20) -> DataFrame:
    s = _movie_avg(g.rated).where(F.col("ratings_count") >= min_count).join(g.movies, "movie_id")
    return s.select(F.col("movie_id").alias("movieId"), "title",
                    round_half_up(F.col("avg_rating"), 2).alias("avgRating"),
                    F.col("ratings_count").alias("ratingsCount")) \
        .orderBy(F.desc("avgRating"), F.desc("ratingsCount"), "movieId").limit(k)


# ------------------------------------------------------------- degrees

def user_degree(g: PropertyGraph, k: int = 20) -> DataFrame:
    return g.rated.groupBy(F.col("user_id").alias("userId")).agg(F.count(F.lit(1)).alias("degree")) \
        .orderBy(F.desc("degree"), "userId").limit(k)


def movie_degree(g: PropertyGraph, k: int = 20) -> DataFrame:
    d = g.rated.groupBy("movie_id").agg(F.count(F.lit(1)).alias("degree"))
    return d.join(g.movies, "movie_id").select(F.col("movie_id").alias("movieId"), "title", "degree") \
        .orderBy(F.desc("degree"), "movieId").limit(k)


def genre_degree(g: PropertyGraph, k: int = 20) -> DataFrame:
    return g.has_genre.groupBy(F.col("genre")).agg(F.count(F.lit(1)).alias("degree")) \
        .orderBy(F.desc("degree"), "genre").limit(k)


def node_degrees(g: PropertyGraph) -> DataFrame:
    """Degree of every vertex over all edge types, both directions:
    (nodeLabels, identifier, degree); vertices without edges have degree 0."""
    ends = (g.rated.select(F.lit("User").alias("label"), F.col("user_id").cast("string").alias("id"))
            .unionByName(g.rated.select(F.lit("Movie").alias("label"), F.col("movie_id").cast("string").alias("id")))
            .unionByName(g.has_genre.select(F.lit("Movie").alias("label"), F.col("movie_id").cast("string").alias("id")))
            .unionByName(g.has_genre.select(F.lit("Genre").alias("label"), F.col("genre").alias("id"))))
    deg = ends.groupBy("label", "id").agg(F.count(F.lit(1)).alias("degree"))
    nodes = (g.users.select(F.lit("User").alias("label"), F.col("user_id").cast("string").alias("id"))
             .unionByName(g.movies.select(F.lit("Movie").alias("label"), F.col("movie_id").cast("string").alias("id")))
             .unionByName(g.genres.select(F.lit("Genre").alias("label"), F.col("name").alias("id"))))
    return nodes.join(deg, ["label", "id"], "left").select(
        F.col("label").alias("nodeLabels"), F.col("id").alias("identifier"),
        F.coalesce("degree", F.lit(0)).alias("degree"))


def supernodes(g: PropertyGraph, min_degree: int = 100, k: int = 50) -> DataFrame:
    return node_degrees(g).where(F.col("degree") > min_degree) \
        .orderBy(F.desc("degree"), "nodeLabels", "identifier").limit(k)


def degree_band(g: PropertyGraph, lo: int = 20, hi: int = 30, k: int = 20) -> DataFrame:
    d = g.rated.groupBy("movie_id").agg(F.count(F.lit(1)).alias("ratingCount")) \
        .where(F.col("ratingCount").between(lo, hi))
    return d.join(g.movies, "movie_id").select(F.col("movie_id").alias("movieId"), "title", "ratingCount") \
        .orderBy(F.desc("ratingCount"), "movieId").limit(k)
