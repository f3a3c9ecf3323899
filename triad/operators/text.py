"""Text operators: paper preparation, chunking and BM25 keyword ranking.

All per-row work is built-in expressions (regex split, slice, higher-order
functions); BM25 statistics are ordinary aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triad.functions.text import (replace_escaped_newline, split_sentences, split_ws, strip_ws,
                                  word_count)
from triad.session import scratch_path

# JSON Lines schema of a raw paper record.
PAPER_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("submitter", T.StringType()),
    T.StructField("authors", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("comments", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("update_date", T.StringType()),
    T.StructField("versions", T.ArrayType(T.StructType([
        T.StructField("version", T.StringType()), T.StructField("created", T.StringType())]))),
    T.StructField("authors_parsed", T.ArrayType(T.ArrayType(T.StringType()))),
])


# ------------------------------------------------------------- fields

def extract_year(versions="versions", update_date="update_date", default_date: str = "2000-01-01"):
    """Year of the first version ('Mon, 2 Apr 2007 19:18:42 GMT' -> 2007),
    else the first four characters of ``update_date``."""
    v = F.col(versions) if isinstance(versions, str) else versions
    u = F.col(update_date) if isinstance(update_date, str) else update_date
    created = F.get(v, 0).getField("created")
    from_version = F.get(split_ws(created), 3).try_cast("int")
    fallback = F.substring(F.coalesce(u, F.lit(default_date)), 1, 4).try_cast("int")
    return F.coalesce(from_version, fallback)


def format_authors(parsed="authors_parsed", raw="authors", max_authors: int = 10, name_sep: str = ""):
    """'Last' + name_sep + 'First' for the first ``max_authors`` parsed names with
    a non-empty last name, joined by ', '; the raw author text when nothing is parsed."""
    p = F.col(parsed) if isinstance(parsed, str) else parsed
    r = F.col(raw) if isinstance(raw, str) else raw
    names = F.transform(F.slice(p, 1, max_authors), lambda e: F.struct(
        strip_ws(F.coalesce(F.get(e, 0), F.lit(""))).alias("last"),
        strip_ws(F.coalesce(F.get(e, 1), F.lit(""))).alias("first")))
    kept = F.filter(names, lambda x: x["last"] != "")
    joined = F.array_join(F.transform(kept, lambda x: strip_ws(F.concat(x["last"], F.lit(name_sep), x["first"]))), ", ")
    return F.when(F.size(p) > 0, joined).otherwise(replace_escaped_newline(F.coalesce(r, F.lit(""))))


def primary_category(categories="categories", default: str = "unknown"):
    c = F.col(categories) if isinstance(categories, str) else categories
    return F.get(split_ws(F.coalesce(c, F.lit(default))), 0)


# ------------------------------------------------------------- sources (S3)

def read_papers_jsonl(spark, path: str, schema: T.StructType = PAPER_SCHEMA) -> DataFrame:
    """JSON Lines papers; blank lines are skipped, a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def parse_papers(lines: DataFrame, column: str = "value", schema: T.StructType = PAPER_SCHEMA) -> DataFrame:
    """The same parse for JSON text already in a column."""
    return lines.select(F.from_json(F.col(column), schema, {"mode": "FAILFAST"}).alias("p")).select("p.*")


# ------------------------------------------------------------- preparation

def prepare_papers(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Raw paper records -> (id, title, abstract, authors, year, category).

    Records with an empty title or abstract (after strip) are skipped; the
    two-character text backslash+n is replaced by a space. ``limit`` keeps the
    first valid records by id.
    """
    cols = set(raw.columns)

    def opt(name, default=None):
        return F.col(name) if name in cols else F.lit(default)

    title = strip_ws(F.coalesce(opt("title"), F.lit("")))
    abstract = strip_ws(F.coalesce(opt("abstract"), F.lit("")))
    out = raw.select(
        F.col("id"),
        title.alias("_t"), abstract.alias("_a"),
        format_authors(opt("authors_parsed").cast("array<array<string>>"), opt("authors").cast("string")).alias("authors"),
        extract_year(opt("versions").cast("array<struct<version:string,created:string>>"),
                     opt("update_date").cast("string")).alias("year"),
        primary_category(opt("categories").cast("string")).alias("category"),
    ).where((F.col("_t") != "") & (F.col("_a") != ""))
    out = out.select(
        "id",
        strip_ws(replace_escaped_newline(F.col("_t"))).alias("title"),
        strip_ws(replace_escaped_newline(F.col("_a"))).alias("abstract"),
        "authors", "year", "category")
    if limit is not None:
        out = out.orderBy("id").limit(limit)
    return out


def embed_text(title="title", abstract="abstract", sep: str = " [SEP] "):
    """Text given to the encoder: title + sep + abstract (missing parts as '')."""
    t = F.col(title) if isinstance(title, str) else title
    a = F.col(abstract) if isinstance(abstract, str) else abstract
    return F.concat(F.coalesce(t, F.lit("")), F.lit(sep), F.coalesce(a, F.lit("")))


def papers_by_category(papers: DataFrame, k: int = 10) -> DataFrame:
    return papers.groupBy("category").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "category").limit(k)


def papers_by_year(papers: DataFrame, last: int = 10) -> DataFrame:
    """Counts for the ``last`` most recent years, oldest first."""
    g = papers.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("year")).limit(last).orderBy("year")


# ------------------------------------------------------------- chunking

def longest_docs(papers: DataFrame, text_col: str = "abstract", k: int = 30) -> DataFrame:
    """The ``k`` longest texts by word count (ties by id)."""
    return papers.withColumn("n_words", word_count(text_col)) \
        .orderBy(F.desc("n_words"), "id").limit(k)


def fixed_chunk_array(words, size: int = 200, overlap: int = 30):
    """Word windows of ``size`` words over a word-array column, each starting
    ``max(1, size-overlap)`` after the previous; the last window reaches the end.

    ``words`` must be a column of an earlier projection (see ``fixed_chunks``):
    it is read inside the window lambda, so an inline tokeniser would run
    once per window.
    """
    step = max(1, size - overlap)
    words = F.col(words) if isinstance(words, str) else words
    w = F.size(words)
    n = F.when(w <= size, F.lit(1)).otherwise(F.lit(1) + F.ceil((w - size) / F.lit(step)).cast("int"))
    starts = F.sequence(F.lit(0), (n - 1) * step, F.lit(step))
    chunks = F.transform(starts, lambda s: F.array_join(F.slice(words, s + 1, size), " "))
    return F.when(w == 0, F.array().cast("array<string>")).otherwise(chunks)


def sentence_chunk_array(sentences, max_words: int = 200):
    """Greedy packing of whole sentences into chunks of at most ``max_words`` words; a sentence longer than the limit
    stands alone.

    ``sentences`` must be a column of an earlier projection (see ``sentence_chunks``): it is read inside the lambdas.
    The fold keeps the open chunk's word count and the places where chunks begin; only those grow, once a chunk. Each
    chunk is then one slice, so a text of n sentences costs n steps and not n copies of what was packed before.
    """
    sents = F.col(sentences) if isinstance(sentences, str) else sentences
    sizes = F.transform(sents, lambda s, i: F.struct(i.alias("i"), F.size(F.split(s, " ")).alias("n")))
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("cuts"))

    def step(acc, x):
        new = (F.size(acc["cuts"]) == 0) | (acc["n"] + x["n"] > max_words)
        return F.when(new, F.struct(x["n"].alias("n"), F.array_append(acc["cuts"], x["i"]).alias("cuts"))).otherwise(
            F.struct((acc["n"] + x["n"]).alias("n"), acc["cuts"].alias("cuts")))

    def chunk(ends):
        return F.transform(F.arrays_zip(F.slice(ends, 1, F.size(ends) - 1).alias("a"), F.slice(ends, 2, F.size(ends) - 1).alias("b")),
                           lambda x: strip_ws(F.array_join(F.slice(sents, x["a"] + 1, x["b"] - x["a"]), " ")))

    # the fold's result is bound by a one-element transform, so that it runs once
    packed = F.transform(F.array(F.aggregate(sizes, start, step, lambda acc: F.array_append(acc["cuts"], F.size(sents)))), chunk)
    return F.when(F.size(sents) == 0, F.array().cast("array<string>")).otherwise(F.get(packed, 0))


def explode_chunks(df: DataFrame, chunks_col, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.posexplode(chunks_col).alias("chunk_id", "chunk_text"))


def _with_words(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, split_ws(F.coalesce(F.col(text_col), F.lit(""))).alias("_words"))


def fixed_chunks(papers: DataFrame, text_col: str = "abstract", size: int = 200, overlap: int = 30,
                 keep: list[str] | None = None) -> DataFrame:
    keep = keep or ["id"]
    w = _with_words(papers, text_col, keep)
    return explode_chunks(w, fixed_chunk_array("_words", size, overlap), keep)


def _with_sentences(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, split_sentences(F.coalesce(F.col(text_col), F.lit(""))).alias("_sentences"))


def sentence_chunks(papers: DataFrame, text_col: str = "abstract", max_words: int = 200) -> DataFrame:
    return explode_chunks(_with_sentences(papers, text_col, ["id"]), sentence_chunk_array("_sentences", max_words), ["id"])


def chunk_records(papers: DataFrame, strategy: str = "fixed", size: int = 200, overlap: int = 30,
                  max_words: int = 200, top_n: int | None = 30) -> DataFrame:
    """Chunk records of the ``top_n`` longest papers (all papers if None):
    id '<strategy>_<paper>_<j>', text 'title [SEP] chunk', metadata struct."""
    src = longest_docs(papers, "abstract", top_n) if top_n else papers
    keep = ["id", "title", "year", "category"]
    if strategy == "fixed":
        src = _with_words(src, "abstract", keep)
        arr = fixed_chunk_array("_words", size, overlap)
    else:
        src = _with_sentences(src, "abstract", keep)
        arr = sentence_chunk_array("_sentences", max_words)
    ch = src.select(*keep, F.posexplode(arr).alias("chunk_id", "chunk"))
    return ch.select(
        F.concat_ws("_", F.lit(strategy), F.col("id").cast("string"), F.col("chunk_id").cast("string")).alias("id"),
        F.lit(strategy).alias("strategy"),
        F.concat(F.col("title"), F.lit(" [SEP] "), F.col("chunk")).alias("text"),
        F.struct(F.col("id").cast("string").alias("arxiv_id"),
                 F.substring("title", 1, 300).alias("title"),
                 F.substring("chunk", 1, 1000).alias("chunk_text"),
                 F.col("chunk_id").cast("int").alias("chunk_id"),
                 F.col("year").cast("int").alias("year"),
                 F.col("category").cast("string").alias("category")).alias("metadata"))


# ------------------------------------------------------------- BM25 (V7)

def postings(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Term postings (term, doc_id, tf, dl) of lower-cased whitespace words, and one row with a null term for each document
    (its ``dl`` is the document's length), so that corpus statistics come from the same table.

    The raw texts are exchanged once, by id. A document's words are then counted in its own row: sorted, and cut where the word
    changes. So a task holds no postings but those of one document; an aggregate over all words would hold those of its whole
    share. Ids should be unique; documents that share an id and a length count as one. Missing texts have no postings.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col)).alias("_text")).where(F.col("_text").isNotNull()) \
        .repartition(F.col("doc_id"))
    once = texts.groupBy("doc_id", F.size(split_ws(F.col("_text"))).alias("dl")).agg(F.collect_list("_text").alias("_texts"))
    words = once.select("doc_id", "dl", F.size("_texts").alias("_n"), F.array_sort(split_ws(F.array_join("_texts", " "))).alias("_words"))
    end = F.size("_words")
    changes = F.filter(F.sequence(F.lit(0), end), lambda i: (i == 0) | (i == end) | (F.get("_words", i) != F.get("_words", i - 1)))
    cut = words.select("*", changes.alias("_cuts"))
    # the cut at the end stands for the document's own row
    each = F.transform("_cuts", lambda at, i: F.struct(
        F.get("_words", at).alias("term"), F.when(at == end, F.col("_n")).otherwise(F.get("_cuts", i + 1) - at).cast("long").alias("tf")))
    return cut.select("doc_id", "dl", F.inline(each)).select("term", "doc_id", "tf", "dl")


def write_postings(docs: DataFrame, path: str, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """An index for many searches: postings ordered by term and written, so that a search reads only the row groups of its
    terms. Returns the table as read back."""
    postings(docs, id_col, text_col).repartitionByRange("term").sortWithinPartitions("term", "doc_id").write.mode("errorifexists").parquet(path)
    return docs.sparkSession.read.parquet(path)


def bm25(docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.5, b: float = 0.75,
         epsilon: float = 0.25, id_col: str = "id", text_col: str = "text",
         query_id: str = "query_id", query_text: str = "query_text") -> DataFrame:
    """Okapi BM25 top ``k`` per query: (query_id, doc_id, rank, score). See ``bm25_search``.

    The texts are read and tokenised once: their postings are written to the shared folder and all steps read those.
    """
    path, index = scratch_path(docs.sparkSession, "postings"), postings(docs, id_col, text_col)
    index.write.parquet(path)
    return bm25_search(docs.sparkSession.read.schema(index.schema).parquet(path), queries, k, k1, b, epsilon, query_id, query_text)


def bm25_search(index: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25,
                query_id: str = "query_id", query_text: str = "query_text") -> DataFrame:
    """Okapi BM25 top ``k`` per query from ``postings``: (query_id, doc_id, rank, score).

    Tokens are lowercased whitespace words. ``idf = ln(N-df+0.5) - ln(df+0.5)``;
    a negative idf becomes ``epsilon`` times the mean idf of the vocabulary.
    Repeated query words count again. Documents are ranked by (score desc,
    id asc) over the whole corpus, so a query matching fewer than ``k``
    documents is filled with zero-score documents in id order.

    Work: document frequencies are one aggregate over (term) with map-side combining; N and the mean length one over the
    documents' own rows; postings are read for query terms only (semi-join with the small query vocabulary, whose
    bounds reach a scan ordered by term); the zero-score candidates are the k smallest ids; the top k per query is
    a window with a group limit, so only k rows per query and partition cross the final shuffle.
    """
    own = index.where(F.col("term").isNull())
    stats = own.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("total"))).scalar()
    n_docs = stats.getField("n")
    avgdl = stats.getField("total") / n_docs
    df_t = index.where(F.col("term").isNotNull()).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf_raw = F.log(n_docs - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    mean_idf = df_t.agg(F.avg(idf_raw)).scalar()

    q_terms = queries.select(F.col(query_id).alias("query_id"),
                             F.explode(split_ws(F.lower(F.col(query_text)))).alias("term")) \
        .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qn"))
    vocab = q_terms.select("term").distinct()
    asked = index.where(F.col("term").isNotNull()).join(vocab, "term", "left_semi")
    q_idf = asked.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", F.when(idf_raw < 0, F.lit(epsilon) * mean_idf).otherwise(idf_raw).alias("idf"))
    per_term = asked.join(q_idf, "term").select(
        "doc_id", "term",
        (F.col("idf") * F.col("tf") * F.lit(k1 + 1)
         / (F.col("tf") + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("dl") / avgdl))).alias("s"))
    matched = per_term.join(q_terms, "term").select("query_id", "doc_id", (F.col("s") * F.col("qn")).alias("s"))
    first_ids = own.select("doc_id").orderBy("doc_id").limit(k).agg(F.collect_list("doc_id")).scalar()
    zeros = queries.select(F.col(query_id).alias("query_id"), F.explode(first_ids).alias("doc_id"),
                           F.lit(0.0).alias("s"))
    # scores are ranked at 1e-9: sums that are equal in exact arithmetic tie
    # (and fall to the id order) whatever the summation order
    scored = matched.unionByName(zeros).groupBy("query_id", "doc_id").agg(F.round(F.sum("s"), 9).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("query_id", "doc_id", "rank", "score")
