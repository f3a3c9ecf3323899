"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by the number of their five-word shingles. In a partition whose items may miss at most ``m``
shingles and still reach the threshold, an item is represented by its ``2m + 2`` smallest permuted shingle hashes
(bottom-k MinHash; all, if it has fewer). A document that contains an item to the threshold misses at most ``m`` of
them, so probing a document's shingles against the sketches finds every candidate, however long the document is.
Candidates are verified by exact containment of word shingles.

The benchmark is read in blocks of at most ``block_items`` items; each block's index is of bounded size (texts longer
than ``long_words`` words make a block of their own) and is sent to every task once.

Words are lower-cased (A-Z), and ASCII punctuation counts as blank. Cases: null and empty texts, and items of fewer
than five words, match nothing. Repeated items and documents give one row each. Other columns are ignored by
``contained_items`` and passed through by ``clean_documents``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm.text import Words, batches, encoded, mix

SHINGLE = 5
#: An item is contained when PERCENT per cent of its distinct shingles are in the document.
PERCENT = 80
BLOCK_ITEMS = 5_000
LONG_WORDS = 100_000

_PUNCT = bytes(b for b in range(33, 127) if not chr(b).isalnum())
NORMAL = bytes.maketrans(b"\t\n\x0b\x0c\r" + _PUNCT + bytes(range(65, 91)),
                         b" " * (5 + len(_PUNCT)) + bytes(range(97, 123)))

PAIR = "doc_id long, item_id long, n_item long, n_shared long, containment double"


def shingle_strings(text: bytes, k: int = SHINGLE) -> set[bytes]:
    words = text.translate(NORMAL).split()
    return {b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)}


def build_index(items: list[tuple], percent: int = PERCENT, k: int = SHINGLE) -> dict:
    """Sketches of a block of items: sorted hashes with the items they belong to, and each item's least hits."""
    sets, partitions = [], {}
    for item_id, text in items:
        raw = encoded([text])
        w = Words(raw, NORMAL)
        h = np.unique(w.shingles(k)[0])
        if len(h):
            partitions.setdefault(len(h).bit_length(), []).append(len(sets))
            sets.append((item_id, raw[0], h))
    hashes, owners, need = [], [], np.zeros(len(sets), np.int64)
    for size_class, members in partitions.items():
        upper = max(len(sets[i][2]) for i in members)
        missing = upper - -(-percent * upper // 100)
        for i in members:
            h = sets[i][2]
            order = np.argsort(mix(h ^ np.uint64(0x5851F42D4C957F2D * size_class % 2**64)))
            sketch = h[order[:2 * missing + 2]]
            own_missing = len(h) - -(-percent * len(h) // 100)
            need[i] = max(1, len(sketch) - own_missing)
            hashes.append(sketch)
            owners.append(np.full(len(sketch), i))
    if not sets:
        return {"items": []}
    h, o = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(h, kind="stable")
    seen = np.zeros(1 << 20, bool)
    seen[(h >> np.uint64(44)).astype(np.int64)] = True
    return {"items": [(i, t) for i, t, _ in sets], "hashes": h[order], "owners": o[order], "need": need, "seen": seen}


def find(index: dict, raw: list[bytes], percent: int = PERCENT, k: int = SHINGLE):
    """(text index, item_id, item shingles, shared) of every verified containment."""
    if not index["items"]:
        return
    hashes, owners, seen = index["hashes"], index["owners"], index["seen"]
    wanted: dict = index.setdefault("strings", {})
    for a, b in batches(raw):
        w = Words(raw[a:b], NORMAL)
        h, at = w.shingles(k)
        hit = np.flatnonzero(seen[(h >> np.uint64(44)).astype(np.int64)])
        lo, hi = np.searchsorted(hashes, h[hit], "left"), np.searchsorted(hashes, h[hit], "right")
        real = hi > lo
        hit, lo, hi = hit[real], lo[real], hi[real]
        hits: dict = {}
        for doc, value, l, r in zip(w.doc[at[hit]], h[hit], lo, hi):
            for o in owners[l:r]:
                hits.setdefault((int(doc), int(o)), set()).add(int(value))
        own: dict = {}
        for (doc, o), values in sorted(hits.items()):
            if len(values) < index["need"][o]:
                continue
            if doc not in own:
                own = {doc: shingle_strings(raw[a + doc], k)}
            item_id, text = index["items"][o]
            if o not in wanted:
                wanted[o] = shingle_strings(text, k)
            shared = len(wanted[o] & own[doc])
            if 100 * shared >= percent * len(wanted[o]):
                yield a + doc, item_id, len(wanted[o]), shared


def item_blocks(benchmark: DataFrame, block_items: int = BLOCK_ITEMS, long_words: int = LONG_WORDS):
    """The benchmark's items in bounded blocks, one block at a time on the driver."""
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        n = len(r["text"] or "") // 4
        if block and (len(block) >= block_items or size + n > long_words):
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    if block:
        yield block


def contained_items(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, k: int = SHINGLE, **blocks) -> DataFrame:
    """One row per (document, item) with the item's containment."""
    spark, out = docs.sparkSession, None
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for items in item_blocks(benchmark, **blocks):
        index = spark.sparkContext.broadcast(build_index(items, percent, k))

        def scan(frames, index=index):
            for pdf in frames:
                rows = [(pdf["doc_id"].iloc[i], item, n, shared, shared / n)
                        for i, item, n, shared in find(index.value, encoded(pdf["text"]), percent, k)]
                got = pd.DataFrame(rows, columns=["doc_id", "item_id", "n_item", "n_shared", "containment"])
                yield got.astype({"doc_id": "Int64", "item_id": "Int64"})

        part = slim.mapInPandas(scan, PAIR)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], PAIR)


def clean_documents(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, k: int = SHINGLE, **blocks) -> DataFrame:
    """The rows of ``docs`` that contain no item; all columns kept."""
    for items in item_blocks(benchmark, **blocks):
        index = docs.sparkSession.sparkContext.broadcast(build_index(items, percent, k))

        def flag(frames, index=index):
            for texts in frames:
                hit = np.zeros(len(texts), bool)
                for i, *_ in find(index.value, encoded(texts), percent, k):
                    hit[i] = True
                yield pd.Series(hit)

        docs = docs.where(~F.pandas_udf(flag_typed(flag), "boolean")(F.col("text").cast("string")))
    return docs


def flag_typed(flag):
    """An iterator pandas UDF needs its types on the function it is given."""
    from collections.abc import Iterator

    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return flag(frames)

    run.__annotations__ = {"frames": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return run
