"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, sep: str = "|") -> DataFrame:
    """Nested result -> flat columns for comparison: struct fields become
    columns named by their leaf name, string arrays are joined with ``sep``."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            for sub in f.dataType.fields:
                cols.append(F.col(f"`{f.name}`.`{sub.name}`").alias(sub.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            cols.append(F.array_join(F.col(f"`{f.name}`"), sep).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for ``SQL~`` checks: sums in another order)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
