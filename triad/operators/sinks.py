"""Writes and keyed upserts (drop-and-rebuild, replace, last write wins)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from triad.session import checkpoint_dir


def last_write_wins(rows: DataFrame, keys: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """One row per key: the one that is last by ``order`` (then by payload).

    Written as ``max(struct(order..., payload...))`` per key, an aggregate with a
    map-side partial step: a key holding a third of all rows is reduced to one
    row per input partition before the shuffle, and no group is sorted whole.
    """
    inner = [c for c in dict.fromkeys(order + payload) if c not in keys]
    if not inner:
        return rows.select(*keys).distinct()
    best = F.max(F.struct(*[F.col(c) for c in inner])).alias("_w")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in payload
                                                          if c not in keys])


def upsert_by_key(base: DataFrame, updates: DataFrame, keys: list[str], payload: list[str],
                  order: list[str] | None = None) -> DataFrame:
    """Keyed upsert: rows of ``updates`` replace rows of ``base`` with the same key.

    With ``order`` the given columns decide (last write wins across and within the batches; an update beats a base row that is
    equal in them). Without it an update beats the base. Of rows of a key in one batch that are still equal, the last one in
    the order the batch is read wins: ``updates`` should be as read from its source, or ``order`` should hold the source's place
    (``sources.files.in_file_order``). ``base`` holds each key once.

    Only keys, order and a row number are aggregated. The payload (vectors, texts) is in no sort and no aggregate: it is joined
    to the winners. The numbered updates are checkpointed, so that a lost task cannot number them anew.
    """
    order = order or []
    cols = list(dict.fromkeys(keys + payload + order))
    out = [*keys, *[c for c in payload if c not in keys]]
    checkpoint_dir(updates.sparkSession)
    numbered = updates.select(*cols, F.monotonically_increasing_id().alias("_row")).checkpoint()
    place = F.struct(*[F.col(c) for c in order], "_row")
    last = numbered.groupBy(*keys).agg(F.max(place).alias("_last"))
    new = numbered.join(last.select(F.col("_last._row").alias("_row")), "_row", "left_semi")
    if not order:
        return base.select(*out).join(last.select(*keys), keys, "left_anti").unionByName(new.select(*out))
    later = F.struct(*[F.col(c) for c in order]) > F.struct(*[F.col(f"_last.{c}") for c in order])
    kept = base.select(*cols).join(last, keys, "left").where(F.col("_last").isNull() | later)
    beaten = kept.where(F.col("_last").isNotNull()).select(*keys)
    return kept.select(*out).unionByName(new.join(beaten, keys, "left_anti").select(*out))


class UnequalCounts(ValueError):
    """Both sides of an aligned load do not have the same rows."""


def aligned_load(rows: DataFrame, vectors: DataFrame, key: str, write) -> dict[str, int]:
    """Load rows with their vectors, and fail unless both sides have the same keys.

    ``write`` gets the joined rows and must run one action over all of them (as a write does). Counts are observed on the
    way: rows, vectors, and those without a partner. Unequal sides raise ``UnequalCounts`` after the write, with the
    counts; the caller's write should go to a new place that is only published on success.
    """
    joined = rows.withColumn("_row", F.lit(1)).join(vectors.withColumn("_vector", F.lit(1)), key, "full_outer")
    seen = Observation("aligned")
    joined = joined.observe(seen, F.count("_row").alias("rows"), F.count("_vector").alias("vectors"),
                            F.count_if(F.col("_vector").isNull()).alias("rows_alone"), F.count_if(F.col("_row").isNull()).alias("vectors_alone"))
    write(joined.where("_row IS NOT NULL AND _vector IS NOT NULL").drop("_row", "_vector"))
    found = dict(seen.get)
    if found["rows_alone"] or found["vectors_alone"]:
        raise UnequalCounts(f"rows and vectors do not match: {found}")
    return found


def _plain(path: str) -> str:
    return path.removeprefix("file:").replace("///", "/").rstrip("/")


def read_roots(df: DataFrame) -> list[str]:
    """Root paths of the file tables a DataFrame reads (one per table, however many files it has)."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            roots = leaf.relation().location().rootPaths()
            out += [_plain(roots.apply(j).toString()) for j in range(roots.size())]
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, **options) -> str:
    """Drop-and-rebuild (``overwrite``) or append a table at ``path``.

    Refuses to overwrite a path the DataFrame itself reads from.
    """
    if mode == "overwrite":
        target = _plain(path)
        for root in read_roots(df):
            if (root + "/").startswith(target + "/") or (target + "/").startswith(root + "/"):
                raise ValueError(f"refusing to overwrite {path}: the result reads from it")
    w = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path
