"""Table layout for equality - sort - range reads (the index work, re-aimed).

A compound index on (equality, sort, range) lets a store jump to one key and
read it in order. The Spark equivalent is a layout: rows range-partitioned
and sorted within each file by (equality, sort, range), so parquet min/max
statistics let a filter on the equality and range columns skip whole row
groups and files. Ranges cover all three, so one equality value that holds a
third of the rows is still split over many writing tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that one task sorts and writes.
ROWS_PER_TASK = 1_000_000


def write_clustered(df: DataFrame, path: str, equality: list[str], sort: list | None = None,
                    range_cols: list[str] | None = None, num_partitions: int | None = None,
                    mode: str = "overwrite", row_group_bytes: int | None = None) -> str:
    """Write ``df`` laid out for ``WHERE equality = ? AND range ... ORDER BY sort``.

    Unless ``num_partitions`` is given, their number follows the number of rows, so that a writing task's share does not
    grow with the table.
    """
    n = num_partitions or max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK))
    sort = sort or []
    range_cols = range_cols or []
    keys = [F.col(c) if isinstance(c, str) else c for c in equality]
    order: list[Column] = keys + [F.col(c) if isinstance(c, str) else c for c in sort] + \
        [F.col(c) for c in range_cols]
    out = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    w = out.write.mode(mode)
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes))
    w.parquet(path)
    return path


def read_clustered(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Save a table bucketed and sorted by its join keys and read it back.

    Two tables with the same number of buckets join on those keys without a
    shuffle of either side; choose ``buckets`` so that one bucket of the larger
    table fits in a task.
    """
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)
