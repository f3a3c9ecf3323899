"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A document's set holds its distinct four-word shingles (A-Z lower-cased). Equal sets collapse to one class first. A class has
a signature of ``SYMBOLS`` b-bit minimum hashes; the distance of two signatures is the number of symbols that differ. The
signature is split into chunks. If two signatures differ in at most ``reach(...)`` symbols, some chunk holds at most ``ERRORS`` of
them (pigeonhole), so they agree on one of the chunk's keys: one key for each choice of ``ERRORS`` symbols that are left
out. Classes that share a key meet in its bucket; those within the distance are joined there by a spanning forest, and
the forests close to neighbourhoods, which hence hold every pair within the distance. Inside a neighbourhood, pairs
that pass the size and distance bounds are confirmed on the full sets read from the texts. Confirmed links close to components.

With 64 symbols in chunks of 4 and one error a chunk, every pair within distance 31 is found. Sets of similarity 0.8 differ in
12.8 symbols on average, standard deviation 3.2: a link is beyond 31 with a probability of about 1e-7, and less the nearer it is.

Skew: copies collapse before any meeting. A bucket or neighbourhood of more than ``TILE`` classes is cut into tiles (pairs of hashed
parts), none holding more than two parts; small ones share tasks. Members of one bucket that are connected already are not
compared again, so a group of copies costs about one comparison a member. No pair list of a group is ever made. Classes of very
many rows (at most ``HEAVY_CLASSES`` of them can exist) hand their component to the rows by a broadcast.

Cases: null and empty texts have an empty set and link with nothing (their own doc_id). Fewer than four words make one shingle
of the whole sequence. Repeated doc_ids with different texts are separate documents. A document without id takes part in links;
component_id is the smallest id reachable, null where there is none, and then ``kept`` is true. An empty table gives no rows.
Other columns are ignored. Sets, shingles and words are compared by 64-bit fingerprints.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm import exchange as X
from triad.llm.components import components
from triad.llm.text import encoded, mix, word_sets

SHINGLE, PERCENT = 4, 80
#: b-bit symbols (16 bits) of a signature, symbols in a chunk, and symbols of a chunk that may differ.
SYMBOLS, CHUNK, ERRORS = 64, 4, 1
#: Classes of a tile's part, rows of buckets and members of neighbourhoods that share a task, on average.
TILE, BUCKET_ROWS, HOOD_MEMBERS = 1500, 100_000, 4_000
#: Classes of more than a ten-thousandth of all rows: there are fewer than this many.
HEAVY_CLASSES, HEAVY_LEAST = 10_000, 1_000

ROW = "row_key long, doc_id long, n_shingles long, class long, signature binary"


def _families(symbols: int) -> list[tuple[np.uint64, np.uint64]]:
    rng = np.random.default_rng(1997)
    return [(np.uint64(a) | np.uint64(1), np.uint64(b)) for a, b in rng.integers(1, 2**63, (symbols, 2), dtype=np.uint64)]


def reach(symbols: int = SYMBOLS, chunk: int = CHUNK, errors: int = ERRORS) -> int:
    """The largest distance at which some chunk is sure to hold at most ``errors`` differences."""
    return (errors + 1) * (symbols // chunk) - 1


def signatures(sets: list[np.ndarray], symbols: int = SYMBOLS) -> np.ndarray:
    """(sets, symbols) 16-bit minimum hashes of non-empty sets."""
    out = np.empty((len(sets), symbols), np.uint16)
    if sets:
        every = np.concatenate(sets)
        first = np.cumsum([0] + [len(s) for s in sets[:-1]])
        for j, (a, b) in enumerate(_families(symbols)):
            out[:, j] = mix(np.minimum.reduceat((every ^ b) * a, first)) & np.uint64(0xFFFF)
    return out


def set_class(s: np.ndarray) -> int:
    """A set's fingerprint."""
    both = np.bitwise_xor.reduce(s * np.uint64(0x9E3779B97F4A7C15)) ^ mix(np.array([np.add.reduce(s ^ (s >> np.uint64(29)))]))[0]
    return int(mix(np.array([both + np.uint64(len(s))]))[0].astype(np.int64))


def keyed_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key of the row's content, by which its text is found again."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("row_key", F.xxhash64("doc_id", "text"))


def signed(docs: DataFrame, k: int = SHINGLE, symbols: int = SYMBOLS) -> DataFrame:
    """One row per document: set size, class (null without words) and signature."""
    def sign(frames):
        for pdf in frames:
            sets = list(word_sets(encoded(pdf["text"]), k))
            full = [i for i, s in enumerate(sets) if len(s)]
            signature = [None] * len(sets)
            lo = size = 0
            for at, i in enumerate(full):  # some hundred thousand shingles at once
                size += len(sets[i])
                if size > 400_000 or at + 1 == len(full):
                    some = full[lo:at + 1]
                    for j, s in zip(some, signatures([sets[j] for j in some], symbols)):
                        signature[j] = s.tobytes()
                    lo, size = at + 1, 0
            yield pd.DataFrame({"row_key": pdf["row_key"], "doc_id": pdf["doc_id"].astype("Int64"), "n_shingles": [len(s) for s in sets],
                                "class": pd.array([set_class(s) if len(s) else None for s in sets], dtype="Int64"),
                                "signature": pd.Series(signature, dtype=object)})

    return keyed_rows(docs).mapInPandas(sign, ROW)


def chunk_keys(symbols: int = SYMBOLS, chunk: int = CHUNK, errors: int = ERRORS):
    """Array of a signature's keys: for every chunk and every choice of ``errors`` symbols left out, a hash of the others."""
    keys = []
    for c in range(symbols // chunk):
        for out in combinations(range(chunk), errors):
            kept = [F.substring("signature", 2 * (c * chunk + s) + 1, 2) for s in range(chunk) if s not in out]
            keys.append(F.xxhash64(F.lit(len(keys)), *kept))
    return F.array(*keys)


def spanning(near, n: int, first: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that connect whatever ``near(i)`` (members near to i, as a mask) connects; a member that is connected with all others is not asked."""
    label, found = np.arange(n), []
    for i in (range(n) if first is None else first):
        other = label != label[i]
        if not other.any():
            break
        js = np.flatnonzero(near(i, other))
        for j in js:
            if label[j] != label[i]:
                found.append((int(i), int(j)))
                label[label == label[j]] = label[i]
    return found


def _matrix(column, symbols: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, symbols)


def bucket_links(classes: DataFrame, symbols: int = SYMBOLS, chunk: int = CHUNK, errors: int = ERRORS, tile: int = TILE) -> DataFrame:
    """(a, b): a spanning forest, in every bucket, of the classes within the distance."""
    most = reach(symbols, chunk, errors)
    keyed = classes.select("class", F.explode(chunk_keys(symbols, chunk, errors)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = X.written(keyed.join(shared, "key"), "met")
    blocks = max(1, -(-met.count() // BUCKET_ROWS))
    parts = F.ceil(F.col("n") / tile).cast("int")
    part = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    placed = met.withColumn("parts", parts).withColumn("part", part).select(
        "class", "key", F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), F.explode(tiles("parts", "part")).alias("tile"))
    rows = placed.join(classes.select("class", "signature"), "class")

    def join(key, pdf):
        pdf = pdf.sort_values(["key", "class"], kind="stable")
        keys, ids, sig = pdf["key"].to_numpy(), pdf["class"].to_numpy(), _matrix(pdf["signature"], symbols)
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        starts = np.flatnonzero(new)
        head = np.repeat(starts, np.diff(np.append(starts, len(keys))))
        close = (sig != sig[head]).sum(axis=1) <= most
        edges = [np.stack([ids[head], ids], axis=1)[close & ~new]]
        # a bucket whose members are not all near its first one is joined member by member
        apart = np.add.reduceat((~close).astype(np.int64), starts) > 0
        for lo, hi in zip(starts[apart], np.append(starts[1:], len(keys))[apart]):
            own, s = ids[lo:hi], sig[lo:hi]
            pairs = spanning(lambda i, other: other & ((s != s[i]).sum(axis=1) <= most), hi - lo)
            if pairs:
                edges.append(own[np.array(pairs)])
        both = np.unique(np.sort(np.concatenate(edges), axis=1), axis=0)
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    return rows.groupBy("block", "tile").applyInPandas(join, "a long, b long").distinct()


def tiles(parts: str, part: str):
    """Names of the tiles of a row: '' for a group of one part, else the pairs of its part with every part."""
    def name(q):
        return F.concat_ws(":", F.least(F.col(part), q).cast("string"), F.greatest(F.col(part), q).cast("string"))

    return F.when(F.col(parts) == 1, F.array(F.lit(""))).otherwise(F.transform(F.sequence(F.lit(0), F.col(parts) - 1), name))


def common_first(sig: np.ndarray) -> np.ndarray:
    """Members by how many symbols they share with the most: in a group of copies the original comes first."""
    agree = np.zeros(len(sig), np.int64)
    for column in sig.T:
        _, where, times = np.unique(column, return_inverse=True, return_counts=True)
        agree += times[where]
    return np.argsort(-agree, kind="stable")


def confirmed_links(docs: DataFrame, classes: DataFrame, hoods: DataFrame, k: int = SHINGLE, percent: int = PERCENT,
                    symbols: int = SYMBOLS, most: int | None = None, tile: int = TILE) -> DataFrame:
    """(a, b): inside every neighbourhood, a spanning forest of the pairs whose full sets link."""
    most = reach() if most is None else most
    sizes = hoods.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    blocks = max(1, -(-hoods.count() // HOOD_MEMBERS))
    wanted = hoods.withColumnRenamed("id", "class").join(sizes, "component").join(classes, "class").select(
        F.col("row_key").alias("wanted_key"), "class", "component", F.ceil(F.col("members") / tile).cast("int").alias("parts"))
    texts = keyed_rows(docs).join(wanted, F.col("row_key") == F.col("wanted_key")).select("class", "component", "parts", "text")

    def sets(frames):
        for pdf in frames:
            got = list(word_sets(encoded(pdf["text"]), k))
            out = pdf[["class", "component", "parts"]].copy()
            out["shingles"] = [s.tobytes() for s in got]
            # the key of a row is a hash: only the row whose set is the class's counts
            yield out[[len(s) > 0 and set_class(s) == c for s, c in zip(got, pdf["class"])]]

    members = texts.mapInPandas(sets, "class long, component long, parts int, shingles binary")
    placed = members.withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")).select(
        "class", "component", "part", "shingles", F.pmod(F.xxhash64("component"), F.lit(blocks)).alias("block"),
        F.explode(tiles("parts", "part")).alias("tile"))

    def confirm(key, pdf):
        pdf = pdf.drop_duplicates(["component", "class"]).sort_values(["component", "class"], kind="stable")
        hood, ids, part = pdf["component"].to_numpy(), pdf["class"].to_numpy(), pdf["part"].to_numpy()
        every = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        starts = np.concatenate([[0], np.flatnonzero(hood[1:] != hood[:-1]) + 1])
        edges = []
        for lo, hi in zip(starts, np.append(starts[1:], len(hood))):
            if hi - lo > 1:
                edges += [(ids[lo + i], ids[lo + j]) for i, j in hood_links(every[lo:hi], part[lo:hi], percent, symbols, most)]
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return placed.groupBy("block", "tile").applyInPandas(confirm, "a long, b long")


def hood_links(sets: list[np.ndarray], part: np.ndarray, percent: int, symbols: int, most: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``; in a tile of two parts, of the links between them."""
    n, sig = np.array([len(s) for s in sets], np.int64), signatures(sets, symbols)
    cross = part.min() != part.max()

    def near(i, other):
        mask = other & (100 * n >= percent * n[i]) & (100 * n[i] >= percent * n)
        if cross:
            mask &= part != part[i]
        js = np.flatnonzero(mask)
        js = js[(sig[js] != sig[i]).sum(axis=1) <= most]
        linked = np.zeros(len(sets), bool)
        for j in js:
            both = np.concatenate([sets[i], sets[j]])
            both.sort(kind="stable")
            same = int(np.count_nonzero(both[1:] == both[:-1]))
            linked[j] = 100 * same >= percent * (n[i] + n[j] - same)
        return linked

    return spanning(near, len(sets), common_first(sig) if len(sets) > 2 else None)


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, symbols: int = SYMBOLS, chunk: int = CHUNK,
                    errors: int = ERRORS, tile: int = TILE) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept (doc_id = component_id)."""
    rows = X.written(signed(docs, k, symbols), "signed")
    classes = X.written(rows.where("class IS NOT NULL").groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), F.min("row_key").alias("row_key"), F.min("signature").alias("signature")), "classes")
    hoods = components(bucket_links(classes, symbols, chunk, errors, tile))
    joined = components(confirmed_links(docs, classes, hoods, k, percent, symbols, reach(symbols, chunk, errors), tile))
    linked = joined.withColumnRenamed("id", "class").join(classes.select("class", "least"), "class")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    told = X.written(classes.select("class", "n", "least").join(joined.withColumnRenamed("id", "class"), "class", "left").join(least, "component", "left").select(
        "class", "n", F.coalesce("component_id", "least").alias("component_id")), "told")
    bound = max(HEAVY_LEAST, (told.agg(F.sum("n").alias("n")).first()["n"] or 0) // HEAVY_CLASSES)
    heavy = F.broadcast(told.where(F.col("n") > bound).select("class", "component_id"))  # fewer than HEAVY_CLASSES rows, or HEAVY_LEAST rows a class
    light = told.where(F.col("n") <= bound).select("class", "component_id")
    slim = rows.select("doc_id", "n_shingles", "class")
    out = slim.where("class IS NOT NULL").join(heavy, "class").unionByName(
        slim.where("class IS NOT NULL").join(heavy, "class", "left_anti").join(light, "class")).unionByName(
        slim.where("class IS NULL").withColumn("component_id", F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
