"""A training-data pipeline: each stage applies one operator of ``triad.llm`` to all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triad.llm.exchange import written
from triad.llm.op2_quality import keep_good
from triad.llm.op4_packing import packed
from triad.llm.op7_lines import dedup_lines
from triad.llm.op9_jaccard_join import jaccard_components
from triad.llm.op10_decontaminate import clean_documents
from triad.llm.queries import table, vocabulary_path

#: Near copies share 80 % of their five-word shingles; the op9 query's stricter setting is its own contract's.
COPY_SHINGLE, COPY_PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later matching lines of any number of words go, and documents that lose their last line with words; n_chars follows the text."""
    cut = dedup_lines(docs, least_words=1)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.where(left).withColumn("n_chars", changed).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8) one row stays: that of the smallest doc_id, null last.

    Rows are told apart by doc_id and text, so rows that share an id, or have none, are judged one by one; of equal rows one
    stays. Texts without words are no copies of anything and stay. An empty table stays empty.
    """
    rows = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    found = jaccard_components(rows.select(F.col("__row").alias("doc_id"), "text"), k=COPY_SHINGLE, percent=COPY_PERCENT)
    labels = written(found.where("n_shingles > 0").groupBy(F.col("doc_id").alias("__row")).agg(
        F.min("component_id").alias("group"), F.count(F.lit(1)).alias("n")), "copies")
    several = labels.groupBy("group").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("group")
    members = labels.join(several, "group").select("__row", "group")
    ids = rows.select("__row", "doc_id").join(members, "__row")
    first = ids.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("first")).select("group", F.col("first.__row").alias("stays"))
    judged = labels.join(first, "group", "left").select("__row", F.coalesce(F.col("stays") != F.col("__row"), F.lit(False)).alias("__goes"), (F.col("n") > 1).alias("__equal"))
    left = rows.join(judged.where("__goes OR __equal"), "__row", "left").where("NOT coalesce(__goes, false)")
    once = left.where("__equal").dropDuplicates(["__row"])
    return left.where("NOT coalesce(__equal, false)").unionByName(once).select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a training sequence."""
    return packed(docs, vocabulary_path())


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_copies", near_copy_stage),
          ("benchmark", benchmark_stage), ("packing", packing_stage)]

#: Training and tokenising cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
