"""N-gram Jaccard join by size-banded tiles with hashed bitmap signatures.

A document's set holds its distinct three-word shingles (A-Z lower-cased). Equal sets collapse to one representative
(the smallest doc_id). Sets that can link must share one of their rarest shingles (prefix filter; rarity from the merged
sketch of all chunks, which is the same function of a shingle everywhere). Representatives that share such shingles
form a neighbourhood, and a neighbourhood is cut into tiles: pairs of blocks of nearby set sizes. Within a tile,
bitmap signatures bound the overlap from above (each bit set in one and not in the other is a shingle not shared), and
only pairs that pass are intersected as sorted arrays. Pairs already connected are skipped, so a group of copies
costs about one comparison a member. Links are then closed to components.

Cases: null and empty texts have an empty set and link with nothing (own doc_id). Texts of one or two words have their
whole sequence as the one shingle. Repeated doc_ids with different texts are separate rows that share a component
label when either links. A null doc_id takes no part in links (component null). Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm import exchange as X
from triad.llm.components import components
from triad.llm.text import LOWER_TO_BLANK, encoded, word_sets

SHINGLE = 3
#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 90
#: Representatives in one block of a tile, and most signature bits of one.
TILE = 1500
SIGNATURE_BITS = 1 << 13

ROW = "doc_id long, n_shingles long, fp1 long, fp2 long, keys array<long>, shingles binary"


def _signed(x) -> int:
    return int(np.uint64(x).astype(np.int64))


def sets_with_keys(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: size and fingerprint of its set; for a set that may link also its shared prefix shingles
    (``keys``) and the sorted set."""
    chunks = X.Chunks(docs)
    blocks = chunks.blocks()

    def sketch(key, pdf):
        parts = [s for s in word_sets(encoded(pdf["text"]), k) if len(s)]
        keys, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
        return X.frame(X.sketch_messages(key[0], keys, np.minimum(n, X.CAP), blocks), X.MESSAGE)

    def prefixes(key, pdf, answers):
        rows = []
        sets = list(word_sets(encoded(pdf["text"]), k))
        if sets:
            every = np.concatenate(sets)
            rarity = X.estimates(answers, every, blocks)
        at = 0
        for doc_id, s in zip(pdf["doc_id"], sets):
            n = len(s)
            est = rarity[at:at + n]
            at += n
            p = n - -(-percent * n // 100) + 1
            keys, body = [], None
            if n and np.count_nonzero(est == 1) < p:
                prefix = np.lexsort((s, est))[:p]
                prefix = prefix[est[prefix] > 1]
                keys, body = s[prefix].view(np.int64).tolist(), s.tobytes()
            with np.errstate(over="ignore"):
                f1 = _signed(np.bitwise_xor.reduce(s * np.uint64(0x9E3779B97F4A7C15))) if n else 0
                f2 = _signed(np.add.reduce(s ^ (s >> np.uint64(29)))) if n else 0
            rows.append((None if pd.isna(doc_id) else int(doc_id), n, f1, f2, keys, body))
        out = X.frame(rows, ROW.replace("array<long>", "a"))
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return chunks.meet(X.sketch_answers(chunks.send(sketch)), prefixes, ROW)


def _links(sets: list[np.ndarray], side: np.ndarray, cross: bool, percent: int) -> list[tuple[int, int]]:
    """A spanning set of the links inside a tile (between its two sides if ``cross``)."""
    m = len(sets)
    n = np.array([len(s) for s in sets], np.int64)
    bits = min(SIGNATURE_BITS, max(64, 1 << int(np.ceil(np.log2(max(4 * n.max(), 64))))))
    sig = np.zeros((m, bits // 64), np.uint64)
    for i, s in enumerate(sets):
        b = (s * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - int(np.log2(bits)))
        np.bitwise_or.at(sig[i], (b >> np.uint64(6)).astype(np.int64), np.uint64(1) << (b & np.uint64(63)))
    # start with the sets nearest to the tile's common bits: in a group of copies that is the original
    head = np.unpackbits(sig[:, :min(8, sig.shape[1])].view(np.uint8), axis=1)
    order = np.argsort(-(head @ (2 * head.mean(axis=0) - 1)), kind="stable")
    label = np.arange(m)
    found = []
    for i in order:
        other = label != label[i]
        if cross:
            other &= side != side[i]
        other &= (100 * n >= percent * n[i]) & (100 * n[i] >= percent * n)
        js = np.flatnonzero(other)
        if not len(js):
            continue
        mine = np.bitwise_count(sig[i] & ~sig[js]).sum(axis=1, dtype=np.int64)
        theirs = np.bitwise_count(sig[js] & ~sig[i]).sum(axis=1, dtype=np.int64)
        most = np.minimum(n[i] - mine, n[js] - theirs)
        for j in js[100 * most >= percent * (n[i] + n[js] - most)]:
            if label[j] == label[i]:
                continue
            both = np.concatenate([sets[i], sets[j]])
            both.sort(kind="stable")
            inter = int(np.count_nonzero(both[1:] == both[:-1]))
            if 100 * inter >= percent * (n[i] + n[j] - inter):
                found.append((int(i), int(j)))
                label[label == label[j]] = label[i]
    return found


def jaccard_links(rows: DataFrame, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """Links (a, b) between representatives of different sets that connect all that link, from ``sets_with_keys``."""
    classes = rows.where("n_shingles > 0 AND doc_id IS NOT NULL AND size(keys) > 0")
    first = classes.groupBy("fp1", "fp2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    pick = classes.join(first, ["fp1", "fp2", "n_shingles"]).where("doc_id = rep")
    reps = X.written(pick.dropDuplicates(["rep", "fp1", "fp2"]), "reps")
    keyed = reps.select("rep", F.explode("keys").alias("key"))
    least = keyed.groupBy("key").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    near = keyed.join(least, "key").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    hoods = components(near)
    # blocks: a size band, split evenly by a hash once it holds more than a tile
    width = float(np.log(100 / percent))
    banded = reps.join(hoods.withColumnRenamed("id", "rep"), "rep").select(
        "rep", "component", "shingles", F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(width) - F.lit(1e-9)).cast("int").alias("band"))
    sizes = banded.groupBy("component", "band").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.groupBy("component").agg(F.sum("n").alias("all"))
    sizes = sizes.join(total, "component").where("all > 1").select(
        "component", "band", (F.col("all") <= tile).alias("whole"), F.ceil(F.col("n") / tile).cast("int").alias("parts"))
    beside = sizes.select("component", (F.col("band") - 1).alias("band"), F.col("parts").alias("above"))
    below = sizes.select("component", (F.col("band") + 1).alias("band"), F.col("parts").alias("under"))
    sizes = sizes.join(beside, ["component", "band"], "left").join(below, ["component", "band"], "left").na.fill(0, ["above", "under"])
    placed = banded.join(sizes, ["component", "band"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))

    def tiles_of(band, part, parts, low_band, low_parts):  # pairs of this block with the blocks of a band
        return F.transform(F.sequence(F.lit(0), low_parts - 1), lambda q: F.concat_ws(
            ":", low_band.cast("string"), F.least(part, q).cast("string") if low_band is band else q.cast("string"),
            F.greatest(part, q).cast("string") if low_band is band else part.cast("string"), F.lit("=") if low_band is band else F.lit("<")))

    band, part = F.col("band"), F.col("part")
    own = tiles_of(band, part, F.col("parts"), band, F.col("parts"))
    down = F.when(F.col("under") > 0, tiles_of(band, part, F.col("parts"), band - 1, F.greatest(F.col("under"), F.lit(1))))
    up = F.when(F.col("above") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("above"), F.lit(1)) - 1), lambda q: F.concat_ws(
        ":", band.cast("string"), part.cast("string"), q.cast("string"), F.lit("<"))))
    none = F.array().cast("array<string>")
    tiles = F.when(F.col("whole"), F.array(F.lit("all"))).otherwise(F.concat(own, F.coalesce(down, none), F.coalesce(up, none)))
    members = placed.select("component", "rep", "band", "part", "shingles", F.explode(F.array_distinct(tiles)).alias("tile"))

    def compare(key, pdf):
        sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        ids = pdf["rep"].to_numpy()
        side = (pdf["band"].to_numpy().astype(np.int64) << 32) | pdf["part"].to_numpy()
        cross = len(np.unique(side)) > 1 and key[1] != "all"
        return pd.DataFrame([(ids[i], ids[j]) for i, j in _links(sets, side, cross, percent)], columns=["a", "b"], dtype="int64")

    return members.groupBy("component", "tile").applyInPandas(compare, "a long, b long")


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    rows = X.written(sets_with_keys(docs, k, percent), "sets")
    joined = components(jaccard_links(rows, percent, tile))
    slim = rows.select("doc_id", "n_shingles", "fp1", "fp2")
    first = slim.where("n_shingles > 0").groupBy("fp1", "fp2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classed = slim.join(first, ["fp1", "fp2", "n_shingles"], "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    return classed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"))
