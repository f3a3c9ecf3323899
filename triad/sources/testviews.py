"""Views that give the driver's tables the shapes of the original inputs.

Each function reads only the columns it needs from the parquet tables (so the
scan prunes columns) and returns a lazy DataFrame. The same derivations are
stated in SQL in ``triad.plans.views_sql`` for the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triad.functions.text import first_words

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; its schema is inferred once per path (later reads skip
    the footer-reading job), as a catalog would supply it."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
    else:
        df = spark.read.schema(schema).parquet(path)
    return df


# ---------------------------------------------------------------- tracks

def tracks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat track rows after loading (typed, one row per line item)."""
    l = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    j = l.join(p, l.l_partkey == p.p_partkey, "inner")
    size = F.col("p_size").cast("double")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("track_id"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("album_name"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string"), F.lit("; "),
                 F.col("p_brand"), F.lit(" ;")).alias("artists"),
        F.col("p_type").alias("track_genre"),
        (F.col("l_returnflag") == "R").alias("explicit"),
        F.floor(F.col("l_suppkey") % 61 + F.col("l_quantity") * F.lit(0.8)).cast("int").alias("popularity"),
        F.floor(F.col("l_extendedprice") * F.lit(5.0)).cast("int").alias("duration_ms"),
        (F.col("l_discount") * F.lit(10.0)).alias("danceability"),
        (F.lit(1.0) - F.col("l_tax") * F.lit(10.0)).alias("energy"),
        (F.lit(-0.6) * size).alias("loudness"),
        F.col("l_tax").alias("speechiness"),
        F.col("l_discount").alias("acousticness"),
        (F.col("l_discount") * F.lit(10.0)).alias("instrumentalness"),
        F.col("l_tax").alias("liveness"),
        (size / F.lit(50.0)).alias("valence"),
        (F.col("l_extendedprice") * F.col("l_extendedprice") / F.lit(5e7)).alias("tempo"),
        F.col("l_linenumber").cast("int").alias("key"),
        (F.col("l_linenumber") % 2).cast("int").alias("mode"),
        F.lit(4).alias("time_signature"),
    )


TRACK_TEXT_COLUMNS = ["track_id", "track_name", "album_name", "artists", "track_genre", "explicit",
                      "popularity", "duration_ms", "danceability", "energy", "loudness",
                      "speechiness", "acousticness", "instrumentalness", "liveness", "valence",
                      "tempo", "key", "mode", "time_signature"]


def tracks_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as text, as a headered CSV read with an all-string schema gives them."""
    raw = tracks_raw(spark, sf_dir)
    return raw.select(*[F.col(c).cast("string").alias(c) for c in TRACK_TEXT_COLUMNS])


# ---------------------------------------------------------------- graph inputs

def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return p.select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))).alias("genres"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_nationkey").cast("int").alias("age"),
        (F.col("c_custkey") % 21).cast("int").alias("occupation"),
    )


def ratings_raw(spark: SparkSession, sf_dir: str, movies: DataFrame | None = None) -> DataFrame:
    """Rating rows; with ``movies`` (movie_id) only those of these movies, taken before the orders are joined."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                                "l_quantity", "l_shipdate")
    if movies is not None:
        l = l.join(movies, l.l_partkey == movies.movie_id, "left_semi")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = l.join(o, l.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.least(F.lit(5.0), F.lit(1.0) + F.floor((F.col("l_quantity") - 1) / 10)).cast("int").alias("rating"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        "l_shipdate", "l_orderkey", "l_linenumber",
    )


RATING_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber"]


def text_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Users, movies and ratings as rows of text with their place in the source, as a file load sees them: some keys are missing
    or no numbers, some numbers have fractions or are words, some movies name no genre."""
    u, m, r = users(spark, sf_dir), movies(spark, sf_dir), ratings_raw(spark, sf_dir)
    text = lambda c: F.col(c).cast("string")
    user_rows = u.select(
        F.when(F.col("user_id") % 97 == 0, None).when(F.col("user_id") % 89 == 0, F.concat(F.lit("u"), text("user_id"))).otherwise(text("user_id")).alias("userId"),
        "gender", F.concat(text("age"), F.when(F.col("user_id") % 5 == 0, ".7").otherwise("")).alias("age"),
        F.when(F.col("user_id") % 7 == 0, "none").otherwise(text("occupation")).alias("occupation"), F.col("user_id").alias("_order"))
    movie_rows = m.select(F.when(F.col("movie_id") % 83 == 0, None).otherwise(text("movie_id")).alias("movieId"), "title",
                          F.when(F.col("movie_id") % 11 != 0, F.col("genres")).alias("genres"), F.col("movie_id").alias("_order"))
    rating_rows = r.select(text("user_id").alias("userId"), text("movie_id").alias("movieId"),
                           F.when(F.col("l_orderkey") % 13 == 0, F.concat(text("rating"), F.lit(".5"))).otherwise(text("rating")).alias("rating"),
                           text("timestamp").alias("timestamp"), F.struct(*RATING_ORDER).alias("_order"))
    return user_rows, movie_rows, rating_rows


def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order as an update of its customer: repeated keys, in date order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return o.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("last_order"), F.floor("o_totalprice").cast("long").alias("price"),
                    "o_orderdate", "o_orderkey")


# ---------------------------------------------------------------- papers

def papers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw paper records from ``documents``: whole texts as abstracts, the first
    eight words as titles, two categories, a dated ``update_date`` and no versions."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return d.select(
        F.col("doc_id").alias("id"),
        first_words(F.col("text"), 8).alias("title"),
        F.col("text").alias("abstract"),
        F.col("source").alias("authors"),
        F.concat(F.col("lang"), F.lit(" "), F.col("source")).alias("categories"),
        F.concat((F.lit(2010) + F.col("doc_id") % 15).cast("string"), F.lit("-06-15")).alias("update_date"),
        F.lit(None).cast("array<struct<version:string,created:string>>").alias("versions"),
        F.lit(None).cast("array<array<string>>").alias("authors_parsed"),
    )


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared papers: (id, title, abstract, authors, year, category)."""
    from triad.operators.text import prepare_papers

    return prepare_papers(papers_raw(spark, sf_dir))


def search_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers that have a vector: (id, title, abstract, authors, year, category, values)."""
    return papers(spark, sf_dir).join(vectors(spark, sf_dir).select("id", "values"), "id", "inner")


def whole_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All papers, with their vector where there is one: the keyword leg ranks all of them, the vector leg those with a vector."""
    return papers(spark, sf_dir).join(vectors(spark, sf_dir).select("id", "values"), "id", "left")


def paper_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON Lines text built from ``events``: one paper record per event.

    ``versions`` holds one entry whose ``created`` is the event time in the
    e-print format; error events carry no versions, so the year falls back to
    ``update_date``.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "props")
    created = F.date_format(F.col("ts"), "EEE, d MMM yyyy HH:mm:ss 'GMT'")
    versions = F.when(F.col("event_type") == "error", F.array().cast("array<struct<version:string,created:string>>")) \
        .otherwise(F.array(F.struct(F.lit("v1").alias("version"), created.alias("created"))))
    rec = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("title"),
        F.col("props").alias("abstract"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 400 DAYS"), "yyyy-MM-dd").alias("update_date"),
        versions.alias("versions"),
    )
    return e.select(F.col("event_id"), F.to_json(rec).alias("value"))


def authors_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One author list per group of twelve customers, in key order."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    parts = F.split(F.col("c_name"), "#")
    entry = F.array(parts.getItem(0), parts.getItem(1), F.lit(""))
    g = c.groupBy(F.floor(F.col("c_custkey") / 12).alias("paper_id")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("c_custkey"), entry.alias("e")))).alias("s"),
        F.min("c_nationkey").alias("nation"))
    return g.select("paper_id",
                    F.transform("s", lambda x: x["e"]).alias("authors_parsed"),
                    F.concat(F.lit("raw authors "), F.col("nation").cast("string")).alias("authors"))


# ---------------------------------------------------------------- vectors

def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("values"),
                    F.col("label").alias("category"))


SEARCH_QUERY_IDS = (1, 7, 42)


def search_queries(spark: SparkSession, sf_dir: str, ids=SEARCH_QUERY_IDS) -> DataFrame:
    """Three search queries: first five words of a document and its embedding."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text").where(F.col("doc_id").isin(list(ids)))
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").where(F.col("vec_id").isin(list(ids)))
    return d.join(e, d.doc_id == e.vec_id, "inner").select(
        F.col("doc_id").alias("query_id"),
        first_words(F.col("text"), 5).alias("query_text"),
        F.col("embedding").alias("query_vec"))
