"""Counting distinct keys of the whole corpus without shuffling a row per key.

Documents are dealt to chunks (bounded slices, by a hash of their id). Each chunk sends its sorted keys, packed, to the
blocks of a hashed key space; a block adds up what all chunks sent and answers every chunk for the chunk's own
keys. A chunk then meets its answers in a cogroup. All messages and tasks are bounded by the chunk and
block sizes; a frequent key costs one entry per chunk, however often it occurs. The documents' exchange appears with
the same shape in each step, so Spark writes the texts once and reads them again.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text in a chunk, and keys in a block, on average.
CHUNK_BYTES = 4 << 20
BLOCK_KEYS = 1 << 20

MESSAGE = "chunk int, block int, payload binary"


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where it is unset, a local session sets one of its own."""
    for read in (lambda: spark.sparkContext.getCheckpointDir(), lambda: spark.conf.get("spark.checkpoint.dir", None),
                 lambda: spark.sparkContext.getConf().get("spark.checkpoint.dir")):
        found = read()
        if found:
            return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    import tempfile  # one machine, as in tests: a folder of its own

    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="triad-shared-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back. What nobody drops goes when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the tables that ``written`` wrote and ``df`` reads, once nothing reads them any more."""
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):  # a table's root path, however many files it has
        if leaves.apply(i).getClass().getSimpleName() == "LogicalRelation":
            roots = leaves.apply(i).relation().location().rootPaths()
            for j in range(roots.size()):
                if "/llm-" in roots.apply(j).toString():
                    roots.apply(j).getFileSystem(spark._jsc.hadoopConfiguration()).delete(roots.apply(j), True)


#: Messages of one block that a task merges.
FAN = 64


def merged(messages: DataFrame, add, fan: int = FAN) -> DataFrame:
    """Merge the (block, payload) messages that every partition sends to the same few blocks, in levels: no task gets more than
    about ``fan`` messages of a block, however many partitions sent one. ``add`` merges a frame of one block's messages to one."""
    schema = "block int, payload binary"
    senders = messages.rdd.getNumPartitions()
    if senders > fan:
        messages = messages.withColumn("deal", F.spark_partition_id())
    while senders > fan:
        senders = -(-senders // fan)

        def level(key, pdf):
            return add(pdf).assign(deal=key[1])

        messages = messages.groupBy("block", (F.col("deal") % senders).alias("deal")).applyInPandas(level, f"{schema}, deal int")
    return messages.groupBy("block").applyInPandas(add, schema)


class Chunks:
    """``docs`` with ``doc_id``, ``text`` and ``chunk``; sizes from one pass over the texts."""

    def __init__(self, docs: DataFrame, columns: tuple[str, ...] = ()):
        spark = docs.sparkSession
        row = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
        self.bytes, self.rows = int(row["b"]), int(row["n"])
        self.count = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-self.bytes // CHUNK_BYTES), 1)
        # rows of one id share a chunk, so that ties between them are settled there; rows without id go by text
        deal = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.coalesce(F.col("text"), F.lit(""))))),
                      F.lit(self.count)).cast("int")
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                *columns, deal.alias("chunk"))

    def blocks(self, keys_per_byte: float = 0.2) -> int:
        return max(1, int(self.bytes * keys_per_byte) // BLOCK_KEYS + 1)

    def send(self, make, schema: str = MESSAGE) -> DataFrame:
        return self.docs.groupBy("chunk").applyInPandas(make, schema)

    def meet(self, answers: DataFrame, make, schema: str) -> DataFrame:
        return self.docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(make, schema)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; sorted unsigned ones go as differences, byte plane by byte plane."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        rising = a.dtype.kind == "u" and a.dtype.itemsize > 1 and (len(a) < 2 or bool((a[1:] >= a[:-1]).all()))
        body = np.diff(a, prepend=a.dtype.type(0)) if rising else a
        planes = np.ascontiguousarray(body.view(np.uint8).reshape(len(body), a.dtype.itemsize).T) if len(body) else body
        parts.append(f"{a.dtype.str},{len(a)},{int(rising)};".encode() + planes.tobytes())
    head = ",".join(str(len(p)) for p in parts).encode() + b"\n"
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(bytes(data))
    head, _, rest = data.partition(b"\n")
    out, at = [], 0
    for size in map(int, head.split(b",")):
        part = rest[at:at + size]
        at += size
        meta, _, body = part.partition(b";")
        kind, n, rising = meta.decode().split(",")
        dtype = np.dtype(kind)
        a = np.frombuffer(body, np.uint8).reshape(dtype.itemsize, int(n)).T.copy().view(dtype).ravel() if int(n) else np.empty(0, dtype)
        out.append(np.cumsum(a, dtype=dtype) if int(rising) else a)
    return out


def split_blocks(keys: np.ndarray, block: np.ndarray, *more: np.ndarray):
    """(block, keys, more...) for each block that occurs; keys sorted within a block."""
    order = np.lexsort((keys, block))
    block, keys, more = block[order], keys[order], [m[order] for m in more]
    cuts = np.flatnonzero(np.diff(block)) + 1
    for lo, hi in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(block)]])):
        if hi > lo:
            yield int(block[lo]), keys[lo:hi], *(m[lo:hi] for m in more)


def frame(rows: list[tuple], names: str) -> pd.DataFrame:
    cols = [c.split()[0] for c in names.split(",")]
    return pd.DataFrame(rows, columns=cols)


# ---------------------------------------------------------------- count-min sketch over chunks

ROWS = 2
CELLS_PER_KEY = 8
CAP = 255


def cell(keys: np.ndarray, row: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and cell of each key in one row of the sketch."""
    mult = np.uint64(0xD6E8FEB86659FD93 if row else 0xA0761D6478BD642F)
    h = keys * mult
    h ^= h >> np.uint64(32)
    h = h * mult
    width = np.uint64(BLOCK_KEYS * CELLS_PER_KEY)
    block = (h >> np.uint64(33)) % np.uint64(blocks)
    return block.astype(np.int64) + row * blocks, ((h & np.uint64(0x1FFFFFFFF)) % width).astype(np.uint32)


def sketch_messages(chunk: int, keys: np.ndarray, counts: np.ndarray, blocks: int) -> list[tuple]:
    """A chunk's part of the sketch: for each row and block the cells it touched and their counts."""
    out = []
    for row in range(ROWS):
        b, c = cell(keys, row, blocks)
        at = (b.astype(np.uint64) << np.uint64(32)) | c
        order = np.argsort(at)
        at, n = at[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.empty(0, np.int64)
        total = np.minimum(np.add.reduceat(n, first), CAP).astype(np.uint8) if len(first) else np.empty(0, np.uint8)
        at = at[first]
        block = (at >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(block)) + 1
        for lo, hi in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(at)]])):
            if hi > lo:
                out.append((chunk, int(block[lo]), pack((at[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32), total[lo:hi])))
    return out


def merge_sketch(least: int):
    """Add up one block of the merged sketch; answer each chunk with its cells that reach ``least``."""
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        got = [unpack(p) for p in pdf["payload"]]
        cells = np.concatenate([g[0] for g in got])
        sums = np.zeros(BLOCK_KEYS * CELLS_PER_KEY, np.uint32)
        np.add.at(sums, cells, np.concatenate([g[1] for g in got]).astype(np.uint32))
        rows = []
        for chunk, block, g in zip(pdf["chunk"], pdf["block"], got):
            n = np.minimum(sums[g[0]], CAP).astype(np.uint8)
            keep = n >= least
            if keep.any():
                rows.append((chunk, block, pack(g[0][keep], n[keep])))
        return frame(rows, MESSAGE)
    return merge


def sketch_answers(messages: DataFrame, least: int = 2) -> DataFrame:
    return messages.groupBy("block").applyInPandas(merge_sketch(least), MESSAGE)


def estimates(pdf: pd.DataFrame, keys: np.ndarray, blocks: int) -> np.ndarray:
    """For a chunk's keys, the merged sketch's upper bounds of their counts (1: certainly once), capped."""
    rows = [[] for _ in range(ROWS)]
    for block, payload in zip(pdf["block"], pdf["payload"]):
        c, n = unpack(payload)
        rows[int(block) // blocks].append(((np.uint64(block) << np.uint64(32)) | c.astype(np.uint64), n))
    best = np.full(len(keys), CAP, np.uint8)
    for row, parts in enumerate(rows):
        b, c = cell(keys, row, blocks)
        at = (b.astype(np.uint64) << np.uint64(32)) | c
        have = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.uint64)
        n = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.uint8)
        order = np.argsort(have)
        have, n = have[order], n[order]
        i = np.minimum(np.searchsorted(have, at), max(len(have) - 1, 0))
        est = np.where(have[i] == at, n[i], 1).astype(np.uint8) if len(have) else np.ones(len(keys), np.uint8)
        np.minimum(best, est, out=best)
    return best
