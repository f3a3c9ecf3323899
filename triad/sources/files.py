"""File sources: headered CSV, '::'-delimited Latin-1 text, row sources with key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triad.functions.text import strip_ws

# The words a pandas CSV read turns into missing values by
# default (so such text never survives the reference's loader).
DEFAULT_NA_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null")


def read_csv_text(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Headered CSV with every column read as text (no inference pass).

    Quotes inside quoted fields are doubled and backslashes are plain text. Files are split among tasks; fields
    with line breaks need ``multi_line``, which reads each file in one task.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    if columns is None:
        columns = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.options(**options).schema(schema).csv(path)


def na_to_null(df: DataFrame, na_words=DEFAULT_NA_WORDS) -> DataFrame:
    words = list(na_words)
    return df.select(*[F.when(F.col(f"`{c}`").isin(words), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c)
                       for c in df.columns])


def read_tracks_csv(spark: SparkSession, path: str, na_words=DEFAULT_NA_WORDS,
                    explicit_null_as: bool = True) -> DataFrame:
    """Track CSV -> typed flat rows (bool, lenient ints/doubles, required columns present)."""
    from triad.operators.documents import coerce_tracks

    return coerce_tracks(na_to_null(read_csv_text(spark, path), na_words), explicit_null_as)


def read_delimited(spark: SparkSession, path: str, n_fields: int, names: list[str],
                   sep: str = "::", encoding: str = "ISO-8859-1") -> DataFrame:
    """Lines of ``sep``-separated fields in a single-byte encoding.

    Each line is stripped and split on ``sep``; lines with fewer than
    ``n_fields`` fields are dropped, longer ones cut to the first ``n_fields``
    (an empty last field is kept as ''). Whole lines are read through the CSV
    reader with a separator and quote that never occur, because the plain
    text reader ignores ``encoding``.
    """
    lines = spark.read.schema("line string").options(sep="\u0001", quote="", escape="",
                                                     encoding=encoding, header=False).csv(path)
    parts = F.split(strip_ws(F.col("line")), sep.replace("|", "\\|"), -1)
    keep = lines.select(parts.alias("p")).where(F.size("p") >= n_fields)
    return keep.select(*[F.col("p").getItem(i).alias(names[i]) for i in range(n_fields)])


def rows_with_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Row source that skips rows whose key columns are missing (``WHERE k IS NOT NULL``)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def in_file_order(df: DataFrame, column: str = "_order") -> DataFrame:
    """Rows as read from files, with their place in the source: (path, block start, number inside the block).

    Must be called on the read itself: a scan task reads blocks of files one after the other, so its running row number
    rises inside each block, and path and block start order the blocks, whichever tasks read them. The
    column is a struct to be carried along and compared by ``max`` or ``orderBy``. Files are ordered by path.
    """
    meta = F.col("_metadata")
    return df.select("*", F.struct(meta["file_path"].alias("path"), meta["file_block_start"].alias("block"),
                                   F.monotonically_increasing_id().alias("row")).alias(column))


def read_csv_rows(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Headered CSV rows as text in file order (``_order``); an empty field is null, as in a row source with headers."""
    return in_file_order(read_csv_text(spark, path, columns))
