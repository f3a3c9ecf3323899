"""The registered queries of this subpackage. Each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triad.llm.oracle import ORACLE as ORACLE
from triad.llm.op1_ann import nearest
from triad.llm.op2_quality import quality
from triad.llm.op3_substring import repeated_words
from triad.llm.op4_packing import packed
from triad.llm.op5_hmm import score
from triad.llm.op6_secrets import secret_spans
from triad.llm.op7_lines import dedup_lines
from triad.llm.op8_toxicity import toxicity
from triad.llm.op9_jaccard_join import jaccard_components
from triad.llm.op10_decontaminate import contained_items
from triad.llm.op11_vector_codes import vector_codes
from triad.llm.op12_alignment import alignment
from triad.llm.op13_near_dedup import near_duplicates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer's file, as installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_learned_partitions(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op2_quality_cotraining(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark, sf_dir):
    return repeated_words(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_hidden_markov(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark, sf_dir):
    return secret_spans(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark, sf_dir):
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_toxicity_neighbours(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark, sf_dir):
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op12_cross_tokenizer_alignment(spark, sf_dir):
    return alignment(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))


def op13_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_learned_partitions, op2_quality_cotraining, op3_substring_dedup, op4_best_fit_packing, op5_hidden_markov,
    op6_secret_scan, op7_line_dedup, op8_toxicity_neighbours, op9_jaccard_join, op10_decontamination,
    op11_vector_codes, op12_cross_tokenizer_alignment, op13_near_dedup)}
