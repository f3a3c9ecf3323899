"""Registered paper, chunking, keyword, vector and fusion queries with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from triad.operators import fusion as U
from triad.operators import sinks as K
from triad.operators import text as X
from triad.operators import vectors as VE
from triad.plans.common import flatten, round_doubles
from triad.plans.views_sql import _view, with_views
from triad.sources import testviews as V

# Filter A of the filtered search, on these tables: recent years of one category.
FILTER_YEAR_MIN = 2021
FILTER_CATEGORY = "en"
FILTER_YEAR_MAX = 2015     # filter B: up to a year, any category
DIM = 64
ANN_BITS, ANN_BANDS = 9, 64


# ------------------------------------------------------------- Spark plans

def q_paper_year(spark, sf_dir):
    p = X.parse_papers(V.paper_json(spark, sf_dir))
    return p.select("id", X.extract_year().alias("year"))


def q_paper_authors(spark, sf_dir):
    a = V.authors_parsed(spark, sf_dir)
    return a.select("paper_id", X.format_authors().alias("authors"))


def q_prepare_papers(spark, sf_dir):
    return V.papers(spark, sf_dir)


def q_longest_docs(spark, sf_dir):
    return X.longest_docs(V.papers(spark, sf_dir)).select("id", "n_words")


def q_split_sentences(spark, sf_dir):
    from triad.functions.text import split_sentences

    p = V.papers(spark, sf_dir)
    return p.select("id", F.posexplode(split_sentences(F.col("abstract"))).alias("sentence_id", "sentence"))


def q_fixed_chunks(spark, sf_dir):
    return X.fixed_chunks(V.papers(spark, sf_dir))


def q_sentence_chunks(spark, sf_dir):
    return X.sentence_chunks(V.papers(spark, sf_dir))


def q_chunk_records(spark, sf_dir):
    p = V.papers(spark, sf_dir)
    both = X.chunk_records(p, "fixed", top_n=None).unionByName(X.chunk_records(p, "semantic", top_n=None))
    return flatten(both)


def q_bm25(spark, sf_dir):
    p = V.papers(spark, sf_dir)
    docs = p.select("id", F.concat(F.col("title"), F.lit(" "), F.col("abstract")).alias("text"))
    return round_doubles(X.bm25(docs, V.search_queries(spark, sf_dir), k=10))


def q_knn(spark, sf_dir):
    return round_doubles(VE.knn(V.vectors(spark, sf_dir), V.search_queries(spark, sf_dir), k=5,
                                exclude_self=True))


def q_knn_filtered(spark, sf_dir):
    c = V.search_corpus(spark, sf_dir)
    where = (F.col("year") >= FILTER_YEAR_MIN) & (F.col("category") == FILTER_CATEGORY)
    return round_doubles(VE.knn(c, V.search_queries(spark, sf_dir), k=5, where=where, exclude_self=True))


def q_knn_filtered_before(spark, sf_dir):
    c = V.search_corpus(spark, sf_dir)
    return round_doubles(VE.knn(c, V.search_queries(spark, sf_dir), k=5, where=F.col("year") <= FILTER_YEAR_MAX,
                                exclude_self=True))


def q_metric_compare(spark, sf_dir):
    vec, qs = V.vectors(spark, sf_dir), V.search_queries(spark, sf_dir)
    parts = [VE.knn(vec, qs, k=5, metric=m, exclude_self=True).withColumn("metric", F.lit(m))
             for m in VE.METRICS]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return round_doubles(out)


def q_rrf(spark, sf_dir):
    legs = U.ranked_legs(V.whole_corpus(spark, sf_dir), V.search_queries(spark, sf_dir), k=10)
    return round_doubles(flatten(U.rrf(legs, 60, 5), sep=","))


def q_hybrid_search(spark, sf_dir):
    h = U.hybrid_search(V.whole_corpus(spark, sf_dir), V.search_queries(spark, sf_dir))
    return round_doubles(flatten(h, sep=","))


def q_method_top1(spark, sf_dir):
    return U.method_top1(V.whole_corpus(spark, sf_dir), V.search_queries(spark, sf_dir))


def _vector_records(spark, sf_dir):
    """Vector records of all papers: id 'paper_<id>', values (null where a paper has no vector), metadata with length caps.
    Texts are cut to their caps before the vectors are joined."""
    short = V.papers(spark, sf_dir).select("id", F.struct(
        F.col("id").cast("string").alias("arxiv_id"),
        F.substring("title", 1, 300).alias("title"),
        F.substring("abstract", 1, 500).alias("abstract"),
        F.substring("authors", 1, 200).alias("authors"),
        F.col("year").cast("int").alias("year"),
        F.col("category").cast("string").alias("category")).alias("metadata"))
    c = short.join(V.vectors(spark, sf_dir).select("id", "values"), "id", "left")
    return VE.check_vectors(c, "values", DIM, missing=True).select(
        F.concat(F.lit("paper_"), F.col("id").cast("string")).alias("id"), "values", "metadata")


def q_upsert_vectors(spark, sf_dir):
    base = _vector_records(spark, sf_dir)
    labels = V.table(spark, sf_dir, "labels").where(F.col("quality") == 1) \
        .select(F.concat(F.lit("paper_"), F.col("doc_id").cast("string")).alias("id"))
    updates = base.join(labels, "id", "left_semi").withColumn(
        "metadata", F.col("metadata").withField("category", F.lit("reviewed")))
    up = K.upsert_by_key(base, updates, ["id"], ["values", "metadata"])
    # the id parsed back from the record key
    up = up.withColumn("paper_id", F.regexp_extract("id", r"^paper_(\d+)$", 1).cast("long"))
    # papers without a vector are reported, not dropped
    return flatten(up.select("id", "paper_id", F.col("values").isNotNull().alias("has_vector"),
                             F.when(F.col("values").isNotNull(), F.size("values")).alias("dim"), "metadata"))


def q_vector_stats(spark, sf_dir):
    v = VE.check_vectors(V.vectors(spark, sf_dir), "values", DIM)
    return v.groupBy(F.concat(F.lit("label_"), F.col("category").cast("string")).alias("namespace")).agg(
        F.count(F.lit(1)).alias("vector_count"), F.max(F.size("values")).alias("dimension"))


def q_papers_by_category(spark, sf_dir):
    return X.papers_by_category(V.papers(spark, sf_dir))


def q_papers_by_year(spark, sf_dir):
    return X.papers_by_year(V.papers(spark, sf_dir))


def q_embed_docs(spark, sf_dir):
    from triad.functions.vectors import norm

    p = V.papers(spark, sf_dir)
    e = VE.embed(p.select("id", X.embed_text().alias("text")), "text", dim=DIM)
    weighted = F.aggregate(F.transform("embedding", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda acc, x: acc + x)
    return e.select("id", F.size("embedding").alias("dim"), F.round(norm("embedding"), 4).alias("norm"), F.round(weighted, 4).alias("weighted"))


def q_chunk_search(spark, sf_dir):
    p = V.papers(spark, sf_dir)
    qs = VE.embed(V.search_queries(spark, sf_dir).select("query_id", "query_text"), "query_text", out_col="query_vec", dim=DIM)
    out = None
    for strategy in ("fixed", "semantic"):
        ch = X.chunk_records(p, strategy, top_n=None).select("id", "text")
        ch = VE.embed(ch, "text", out_col="values", dim=DIM)
        hits = VE.knn(ch, qs, k=5).withColumn("strategy", F.lit(strategy))
        out = hits if out is None else out.unionByName(hits)
    return round_doubles(out)


def q_ann_knn(spark, sf_dir):
    return round_doubles(VE.ann_knn(V.vectors(spark, sf_dir), V.search_queries(spark, sf_dir), DIM, k=5, bits=ANN_BITS, bands=ANN_BANDS))


QUERIES = {
    "paper_year": q_paper_year,
    "paper_authors": q_paper_authors,
    "prepare_papers": q_prepare_papers,
    "papers_by_category": q_papers_by_category,
    "papers_by_year": q_papers_by_year,
    "longest_docs": q_longest_docs,
    "split_sentences": q_split_sentences,
    "fixed_chunks": q_fixed_chunks,
    "sentence_chunks": q_sentence_chunks,
    "chunk_records": q_chunk_records,
    "bm25": q_bm25,
    "knn": q_knn,
    "knn_filtered": q_knn_filtered,
    "knn_filtered_before": q_knn_filtered_before,
    "metric_compare": q_metric_compare,
    "rrf": q_rrf,
    "hybrid_search": q_hybrid_search,
    "method_top1": q_method_top1,
    "upsert_vectors": q_upsert_vectors,
    "vector_stats": q_vector_stats,
    "embed_docs": q_embed_docs,
    "chunk_search": q_chunk_search,
    "ann_knn": q_ann_knn,
}


# ------------------------------------------------------------- SQL

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _words(e: str) -> str:
    return (f"(CASE WHEN trim({e}, {_WS}) = '' THEN CAST([] AS VARCHAR[]) "
            f"ELSE regexp_split_to_array(trim({e}, {_WS}), '\\s+') END)")


def _sentences(e: str) -> str:
    t = f"trim(regexp_replace({e}, '\\s+', ' ', 'g'), ' ')"
    return (f"(CASE WHEN {t} = '' THEN CAST([] AS VARCHAR[]) "
            f"ELSE string_split(regexp_replace({t}, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)) END)")


def _packed(e: str, max_words: int = 200) -> str:
    n = "len(string_split(x, ' '))"
    last = "acc[len(acc)]"
    return (f"list_transform(list_reduce({_sentences(e)}, lambda acc, x: CASE WHEN len(acc) = 0 OR "
            f"{last}.n + {n} > {max_words} THEN list_append(acc, {{'t': x, 'n': {n}}}) "
            f"ELSE list_append(acc[1:len(acc) - 1], {{'t': {last}.t || ' ' || x, 'n': {last}.n + {n}}}) END, "
            f"CAST([] AS STRUCT(t VARCHAR, n BIGINT)[])), lambda z: z.t)")


def _fixed(e: str, size: int = 200, overlap: int = 30) -> str:
    """SQL list of fixed word windows."""
    step = max(1, size - overlap)
    w = _words(e)
    n = f"(CASE WHEN len({w}) <= {size} THEN 1 ELSE 1 + CAST(ceil((len({w}) - {size}) / {float(step)}) AS BIGINT) END)"
    return (f"(CASE WHEN len({w}) = 0 THEN CAST([] AS VARCHAR[]) ELSE list_transform(generate_series(0, {n} - 1), "
            f"lambda j: array_to_string(list_slice({w}, j * {step} + 1, j * {step} + {size}), ' ')) END)")


_view("q_terms", f"""
SELECT query_id, term, count(*) AS qn
FROM (SELECT query_id, unnest({_words('lower(query_text)')}) AS term FROM search_queries)
GROUP BY ALL
""", ("search_queries",))

_view("corpus", """
SELECT p.*, v."values" FROM papers p JOIN vectors v ON p.id = v.id
""", ("papers", "vectors"))


def _bm25_sql(docs: str, k: int) -> str:
    """BM25 top-k CTE chain over ``docs(doc_id, text)``; ends in ``bm25_hits``."""
    return f"""
bm_docs AS ({docs}),
bm_toks AS (SELECT doc_id, {_words('lower(text)')} AS t FROM bm_docs),
bm_n AS (SELECT count(*) AS n, CAST(sum(len(t)) AS DOUBLE) / count(*) AS avgdl FROM bm_toks),
bm_df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(t) AS term FROM bm_toks) GROUP BY term),
bm_idf AS (SELECT term, ln(bm_n.n - df + 0.5) - ln(df + 0.5) AS idf_raw FROM bm_df, bm_n),
bm_mean AS (SELECT avg(idf_raw) AS m FROM bm_idf),
bm_tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM bm_toks)
          WHERE term IN (SELECT term FROM q_terms) GROUP BY ALL),
bm_scored AS (
  SELECT q.query_id, tf.doc_id,
         sum(q.qn * (CASE WHEN i.idf_raw < 0 THEN 0.25 * bm_mean.m ELSE i.idf_raw END) * tf.tf * 2.5
             / (tf.tf + 1.5 * (0.25 + 0.75 * len(d.t) / bm_n.avgdl))) AS raw_score
  FROM q_terms q JOIN bm_tf tf ON q.term = tf.term JOIN bm_idf i ON i.term = q.term
  JOIN bm_toks d ON d.doc_id = tf.doc_id, bm_n, bm_mean
  GROUP BY ALL),
bm_pos AS (SELECT query_id, doc_id, round(raw_score, 9) AS score,
                  row_number() OVER (PARTITION BY query_id ORDER BY round(raw_score, 9) DESC, doc_id) AS rank
           FROM bm_scored WHERE round(raw_score, 9) > 0 QUALIFY rank <= {k}),
bm_npos AS (SELECT q.query_id, count(p.doc_id) AS c FROM (SELECT DISTINCT query_id FROM search_queries) q
            LEFT JOIN bm_pos p ON p.query_id = q.query_id GROUP BY ALL),
bm_zero AS (
  SELECT z.query_id, z.doc_id, z.c + row_number() OVER (PARTITION BY z.query_id ORDER BY z.doc_id) AS rank,
         0.0 AS score
  FROM (SELECT n.query_id, n.c, f.doc_id FROM bm_npos n,
        (SELECT doc_id FROM bm_docs ORDER BY doc_id LIMIT {k}) f
        WHERE NOT EXISTS (SELECT 1 FROM bm_pos p WHERE p.query_id = n.query_id AND p.doc_id = f.doc_id)) z
  QUALIFY rank <= {k}),
bm25_hits AS (SELECT query_id, doc_id, CAST(rank AS INTEGER) AS rank, score FROM bm_pos
              UNION ALL SELECT query_id, doc_id, CAST(rank AS INTEGER), score FROM bm_zero)"""


def _knn_sql(corpus: str, k: int, metric: str = "cosine", exclude_self: bool = True) -> str:
    """kNN CTE chain over ``corpus(id, values)`` for search_queries; ends in ``knn_hits``."""
    v, q = "CAST(c.\"values\" AS DOUBLE[])", "CAST(s.query_vec AS DOUBLE[])"
    if metric == "cosine":
        score = f"list_dot_product({v}, {q}) / (sqrt(list_dot_product({v}, {v})) * sqrt(list_dot_product({q}, {q})))"
    elif metric == "dot":
        score = f"list_dot_product({v}, {q})"
    else:
        score = f"-sqrt(list_sum(list_transform(list_zip({v}, {q}), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))"
    cond = "WHERE c.id <> s.query_id" if exclude_self else ""
    return f"""
knn_c AS ({corpus}),
knn_s AS (SELECT s.query_id, c.id, round({score}, 9) AS score FROM knn_c c, search_queries s {cond}),
knn_hits AS (SELECT query_id, id, score,
                    CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank
             FROM knn_s QUALIFY rank <= {k})"""


def _q(body: str, *views: str) -> str:
    return with_views(body, *views)


_FUSED = f"""
WITH {_bm25_sql("SELECT id AS doc_id, title || ' ' || abstract AS text FROM papers", 11).strip()},
bm_legs AS (SELECT query_id, doc_id, rnk AS rank FROM (
              SELECT query_id, doc_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) AS INTEGER) AS rnk
              FROM bm25_hits WHERE doc_id <> query_id) WHERE rnk <= 10),
{_knn_sql('SELECT id, "values" FROM corpus', 10).strip()},
legs AS (SELECT query_id, 'bm25' AS source, 0 AS leg, doc_id, rank FROM bm_legs
         UNION ALL SELECT query_id, 'vector', 1, id, rank FROM knn_hits),
fused AS (
  SELECT query_id, doc_id, sum(1.0 / (60.0 + rank)) AS rrf_score,
         string_agg(source || ':' || CAST(rank AS VARCHAR), ',' ORDER BY leg, rank) AS sources,
         min(leg * 100000 + rank) AS first_seen
  FROM legs GROUP BY ALL),
top AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, first_seen) AS INTEGER) AS rank,
               doc_id, rrf_score, sources FROM fused QUALIFY rank <= 5)
"""

_CHUNKS = f"""
ch AS (
  SELECT 'fixed' AS strategy, id AS pid, title, "year", category,
         unnest(generate_series(0, len(c) - 1)) AS j, unnest(c) AS chunk
  FROM (SELECT *, {_fixed('abstract')} AS c FROM papers)
  UNION ALL
  SELECT 'semantic', id, title, "year", category, unnest(generate_series(0, len(c) - 1)), unnest(c)
  FROM (SELECT *, {_packed('abstract')} AS c FROM papers))"""


def _embedded_sql(name: str, source: str) -> str:
    """CTEs over ``source(key, text)`` that end in ``<name>(key, i, x)``: the non-zero components of the hashed bags of words."""
    digit = "(instr('0123456789abcdef', substr(m, {}, 1)) - 1)"
    slot = " + ".join(f"{16 ** (4 - d)} * {digit.format(d)}" for d in range(1, 5))
    return f"""{name}_words AS (SELECT key, md5(unnest({_words('lower(text)')})) AS m FROM ({source})),
{name}_sums AS (SELECT key, ({slot}) % {DIM} AS i, sum(CASE WHEN substr(m, 5, 1) >= '8' THEN 1 ELSE -1 END) AS n FROM {name}_words GROUP BY ALL),
{name} AS (SELECT key, i, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY key)) AS FLOAT) AS DOUBLE) AS x FROM {name}_sums WHERE n <> 0)"""


ORACLE = {
    "paper_year": """
SELECT CAST(event_id AS VARCHAR) AS id,
       CAST(CASE WHEN event_type = 'error' THEN year(ts + INTERVAL 400 DAY) ELSE year(ts) END AS INTEGER) AS "year"
FROM events""",

    "paper_authors": """
SELECT CAST(floor(c_custkey / 12) AS BIGINT) AS paper_id,
       array_to_string(list_slice(list(split_part(c_name, '#', 1) || split_part(c_name, '#', 2) ORDER BY c_custkey), 1, 10), ', ') AS authors
FROM customer GROUP BY 1""",

    "prepare_papers": _q("SELECT * FROM papers", "papers"),

    "papers_by_category": _q("""
SELECT category, count(*) AS n FROM papers GROUP BY 1 ORDER BY n DESC, category LIMIT 10""", "papers"),

    "papers_by_year": _q("""
SELECT * FROM (SELECT "year", count(*) AS n FROM papers GROUP BY 1 ORDER BY "year" DESC LIMIT 10) ORDER BY "year"
""", "papers"),

    "longest_docs": _q(f"""
SELECT id, len({_words('abstract')}) AS n_words FROM papers ORDER BY n_words DESC, id LIMIT 30""", "papers"),

    "split_sentences": _q(f"""
SELECT id, CAST(unnest(generate_series(0, len(s) - 1)) AS INTEGER) AS sentence_id, unnest(s) AS sentence
FROM (SELECT id, {_sentences('abstract')} AS s FROM papers)""", "papers"),

    "fixed_chunks": _q(f"""
SELECT id, CAST(unnest(generate_series(0, len(c) - 1)) AS INTEGER) AS chunk_id, unnest(c) AS chunk_text
FROM (SELECT id, {_fixed('abstract')} AS c FROM papers)""", "papers"),

    "sentence_chunks": _q(f"""
SELECT id, CAST(unnest(generate_series(0, len(c) - 1)) AS INTEGER) AS chunk_id, unnest(c) AS chunk_text
FROM (SELECT id, {_packed('abstract')} AS c FROM papers)""", "papers"),

    "chunk_records": _q(f"""
WITH {_CHUNKS.strip()}
SELECT strategy || '_' || CAST(pid AS VARCHAR) || '_' || CAST(j AS VARCHAR) AS id, strategy,
       title || ' [SEP] ' || chunk AS text, CAST(pid AS VARCHAR) AS arxiv_id, substr(title, 1, 300) AS title,
       substr(chunk, 1, 1000) AS chunk_text, CAST(j AS INTEGER) AS chunk_id, CAST("year" AS INTEGER) AS "year",
       category
FROM ch""", "papers"),

    "bm25": _q(f"""
WITH {_bm25_sql("SELECT id AS doc_id, title || ' ' || abstract AS text FROM papers", 10).strip()}
SELECT query_id, doc_id, rank, round(score, 6) AS score FROM bm25_hits""", "papers", "q_terms", "search_queries"),

    "knn": _q(f"""
WITH {_knn_sql('SELECT id, "values" FROM vectors', 5).strip()}
SELECT query_id, id, round(score, 6) AS score, rank FROM knn_hits""", "vectors", "search_queries"),

    "knn_filtered": _q(f"""
WITH {_knn_sql(f'SELECT id, "values" FROM corpus WHERE "year" >= {FILTER_YEAR_MIN} AND category = {FILTER_CATEGORY!r}', 5).strip()}
SELECT query_id, id, round(score, 6) AS score, rank FROM knn_hits""", "corpus", "search_queries"),

    "knn_filtered_before": _q(f"""
WITH {_knn_sql(f'SELECT id, "values" FROM corpus WHERE "year" <= {FILTER_YEAR_MAX}', 5).strip()}
SELECT query_id, id, round(score, 6) AS score, rank FROM knn_hits""", "corpus", "search_queries"),

    "metric_compare": _q(" UNION ALL ".join(
        f"""SELECT * FROM (WITH {_knn_sql('SELECT id, "values" FROM vectors', 5, m).strip()}
SELECT query_id, id, round(score, 6) AS score, rank, '{m}' AS metric FROM knn_hits)""" for m in VE.METRICS),
        "vectors", "search_queries"),

    "rrf": _q(_FUSED + """
SELECT query_id, rank, doc_id, round(rrf_score, 6) AS rrf_score, sources FROM top""",
              "papers", "corpus", "q_terms", "search_queries"),

    "hybrid_search": _q(_FUSED + """
SELECT t.query_id, t.rank, t.doc_id, c.title, c.category, c."year", round(t.rrf_score, 6) AS rrf_score, t.sources
FROM top t JOIN papers c ON c.id = t.doc_id""", "papers", "corpus", "q_terms", "search_queries"),

    "method_top1": _q(_FUSED + """
SELECT s.query_id,
       (SELECT doc_id FROM bm_legs b WHERE b.query_id = s.query_id AND b.rank = 1) AS bm25,
       (SELECT id FROM knn_hits v WHERE v.query_id = s.query_id AND v.rank = 1) AS vector,
       (SELECT doc_id FROM top h WHERE h.query_id = s.query_id AND h.rank = 1) AS hybrid
FROM (SELECT DISTINCT query_id FROM search_queries) s""", "papers", "corpus", "q_terms", "search_queries"),

    "embed_docs": _q(f"""
WITH {_embedded_sql("e", "SELECT id AS key, coalesce(title, '') || ' [SEP] ' || coalesce(abstract, '') AS text FROM papers")}
SELECT p.id, {DIM} AS dim, round(sqrt(coalesce(sum(e.x * e.x), 0)), 4) AS norm, round(coalesce(sum(e.x * (e.i + 1)), 0), 4) AS weighted
FROM papers p LEFT JOIN e ON e.key = p.id GROUP BY p.id""", "papers"),

    "chunk_search": _q(f"""
WITH {_CHUNKS.strip()},
{_embedded_sql("c", "SELECT strategy || '_' || CAST(pid AS VARCHAR) || '_' || CAST(j AS VARCHAR) AS key, title || ' [SEP] ' || chunk AS text FROM ch")},
{_embedded_sql("q", "SELECT query_id AS key, query_text AS text FROM search_queries")},
lengths AS (SELECT key, sqrt(sum(x * x)) AS l FROM c GROUP BY key),
scored AS (
  SELECT q.key AS query_id, c.key AS id, sum(q.x * c.x) / any_value(l) / (SELECT sqrt(sum(o.x * o.x)) FROM q o WHERE o.key = q.key) AS s
  FROM q JOIN c USING (i) JOIN lengths n ON n.key = c.key GROUP BY q.key, c.key),
every AS (
  SELECT o.query_id, n.strategy || '_' || CAST(n.pid AS VARCHAR) || '_' || CAST(n.j AS VARCHAR) AS id, n.strategy FROM ch n, (SELECT DISTINCT query_id FROM search_queries) o)
SELECT query_id, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank, strategy
FROM (SELECT query_id, id, strategy, score, row_number() OVER (PARTITION BY query_id, strategy ORDER BY score DESC, id) AS rank
      FROM (SELECT e.query_id, e.id, e.strategy, round(coalesce(s.s, 0), 9) AS score FROM every e LEFT JOIN scored s USING (query_id, id)))
WHERE rank <= 5""", "papers", "search_queries"),

    "ann_knn": _q(f"""
WITH signs AS (
  SELECT CAST(j AS INTEGER) AS j, CAST(i AS INTEGER) AS i, CASE WHEN substr(md5('0:' || j || ':' || i), 1, 1) >= '8' THEN 1.0 ELSE -1.0 END AS s
  FROM (SELECT unnest(range({ANN_BITS * ANN_BANDS})) AS j), (SELECT unnest(range({DIM})) AS i)
), spread AS (
  SELECT id, unnest(CAST("values" AS DOUBLE[])) AS x, unnest(range({DIM})) AS i FROM vectors
), codes AS (
  SELECT id, j // {ANN_BITS} AS band, sum(CASE WHEN p > 0 THEN 1 << (j % {ANN_BITS}) ELSE 0 END) AS code
  FROM (SELECT id, j, sum(x * s) AS p FROM spread JOIN signs USING (i) GROUP BY id, j) GROUP BY ALL
), pairs AS (
  SELECT DISTINCT q.query_id, c.id FROM search_queries q JOIN codes o ON o.id = q.query_id JOIN codes c ON c.band = o.band AND c.code = o.code AND c.id <> o.id
), {_knn_sql('SELECT id, "values" FROM vectors', 1000000000).strip()}
SELECT query_id, id, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank
FROM knn_s JOIN pairs USING (query_id, id) QUALIFY rank <= 5""", "vectors", "search_queries"),

    "upsert_vectors": _q(f"""
SELECT 'paper_' || CAST(c.id AS VARCHAR) AS id, c.id AS paper_id, v."values" IS NOT NULL AS has_vector, len(v."values") AS dim,
       CAST(c.id AS VARCHAR) AS arxiv_id, substr(c.title, 1, 300) AS title, substr(c.abstract, 1, 500) AS abstract,
       substr(c.authors, 1, 200) AS authors, CAST(c."year" AS INTEGER) AS "year",
       CASE WHEN c.id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'reviewed' ELSE c.category END AS category
FROM papers c LEFT JOIN vectors v ON v.id = c.id""", "papers", "vectors"),

    "vector_stats": """
SELECT 'label_' || CAST(label AS VARCHAR) AS namespace, count(*) AS vector_count, max(len(embedding)) AS dimension
FROM embeddings GROUP BY 1""",
}
