"""Reciprocal-rank fusion and hybrid (keyword + vector) search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triad.operators.text import bm25
from triad.operators.vectors import knn
from triad.session import checkpoint_dir


def rrf(ranked: DataFrame, k: int = 60, top: int = 5, legs: tuple[str, ...] = ("bm25", "vector")) -> DataFrame:
    """Fuse ranked lists ``(query_id, source, doc_id, rank)``.

    ``rrf_score`` = sum of 1/(k + rank) over the lists that found the doc;
    ``sources`` lists 'source:rank' in leg order. Ties keep first-seen order:
    the earlier leg, then the better rank in it.
    """
    leg_index = F.coalesce(*[F.when(F.col("source") == s, F.lit(i)) for i, s in enumerate(legs)],
                           F.lit(len(legs)))
    r = ranked.withColumn("_leg", leg_index)
    g = r.groupBy("query_id", "doc_id").agg(
        F.sum(F.lit(1.0) / (F.lit(float(k)) + F.col("rank"))).alias("rrf_score"),
        F.sort_array(F.collect_list(F.struct(
            "_leg", "rank", F.concat(F.col("source"), F.lit(":"), F.col("rank").cast("string")).alias("s")))
        ).alias("_src"),
        F.min(F.struct("_leg", "rank")).alias("_first"))
    w = Window.partitionBy("query_id").orderBy(F.desc("rrf_score"), F.asc("_first"))
    return g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select(
        "query_id", "rank", "doc_id", "rrf_score", F.transform("_src", lambda x: x["s"]).alias("sources"))


def ranked_legs(corpus: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = True) -> DataFrame:
    """BM25 and vector top-k lists for every query, as (query_id, source, doc_id, rank, score).

    ``corpus``: (id, title, abstract, values); rows without ``values`` take part in the keyword leg only.
    ``queries``: (query_id, query_text, query_vec).
    """
    docs = corpus.select("id", F.concat(F.coalesce("title", F.lit("")), F.lit(" "),
                                        F.coalesce("abstract", F.lit(""))).alias("text"))
    if exclude_self:
        # Each query's own document is left out of its hits: ask for one more
        # and drop it (the own document can take at most one place).
        kw = bm25(docs, queries, k=k + 1).where(F.col("doc_id") != F.col("query_id"))
        w = Window.partitionBy("query_id").orderBy("rank")
        kw = kw.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    else:
        kw = bm25(docs, queries, k=k)
    vec = knn(corpus.where(F.col("values").isNotNull()).select("id", "values"), queries, k=k, exclude_self=exclude_self)
    return (kw.select("query_id", F.lit("bm25").alias("source"), "doc_id", "rank", "score")
            .unionByName(vec.select("query_id", F.lit("vector").alias("source"),
                                    F.col("id").alias("doc_id"), "rank", "score")))


def hybrid_search(corpus: DataFrame, queries: DataFrame, k: int = 10, top: int = 5, rrf_k: int = 60,
                  exclude_self: bool = True) -> DataFrame:
    """BM25 top k + vector top k -> RRF top ``top`` for all queries at once;
    document attributes are joined after fusion."""
    legs = ranked_legs(corpus, queries, k, exclude_self)
    fused = rrf(legs, rrf_k, top)
    attrs = corpus.select(F.col("id").alias("doc_id"), "title", "category", "year")
    return fused.join(attrs, "doc_id").select("query_id", "rank", "doc_id", "title", "category", "year",
                                              "rrf_score", "sources")


def method_top1(corpus: DataFrame, queries: DataFrame, k: int = 10, top: int = 5, rrf_k: int = 60,
                exclude_self: bool = True) -> DataFrame:
    """Best hit per query and method: (query_id, bm25, vector, hybrid) doc ids."""
    checkpoint_dir(corpus.sparkSession)
    legs = ranked_legs(corpus, queries, k, exclude_self).checkpoint()  # 2k rows a query, read twice below
    fused = rrf(legs, rrf_k, top)
    firsts = legs.where(F.col("rank") == 1).select("query_id", "source", "doc_id").unionByName(
        fused.where(F.col("rank") == 1).select("query_id", F.lit("hybrid").alias("source"), "doc_id"))
    return firsts.groupBy("query_id").pivot("source", ["bm25", "vector", "hybrid"]).agg(F.first("doc_id"))
