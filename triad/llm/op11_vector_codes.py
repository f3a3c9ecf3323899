"""Vector code compression: product codes from whole-number codebooks, assigned over a lexicographic trie.

Components become whole numbers (floor of ``SCALE`` times the component) and vectors are cut into equal parts. For each part
position a task takes the distinct parts of the rows it holds, with their multiplicities, in lexicographic order: a trie
whose depths are the part's dimensions. The trie is walked depth first. Every node adds one dimension's squared distances
to all entries to the vector of its parent, so parts that share leading dimensions share that work; subtrees of few leaves
are finished level by level as arrays. Leaves take the argmin and add the part, weighted by its multiplicity, to
the entry's sums.

A training round is a scan that yields at most ``entries`` sums for each part position and task; they are added up by a
grouped sum, and only the new codebooks (parts x entries rows, bounded by the parameters) reach the driver. No vector is shuffled.

Cases: rows whose vector is null or empty, holds null or non-finite components, or cannot be cut into ``parts`` equal
parts are dropped; if widths differ, the width of the row with the smallest id that remains counts, and rows of other widths are dropped.
Fewer rows than entries give fewer entries. Rows with null ids sort after all others; repeated ids are separate rows (ties
among the first entries go to the smaller vector). Scaled components are limited to +-2^27, so that distances fit 64 bits; sums of
errors stop at 2^63 - 1. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows whose parts make one trie, and leaves of a subtree that is finished level by level.
POOL_ROWS, SUBTREE = 1 << 16, 1 << 12
LIMIT = float(1 << 27)

SUMS = "position int, entry int, n long, sums array<long>"
CODED = "vec_id long, label string, code string, error long"


def whole_vectors(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding",
                  label_col: str = "label") -> DataFrame:
    """(vec_id, label as text, q: array<long>) of the rows that take part, widths not yet compared."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    # limited before the floor: that of a huge double has no 64-bit value
    near = lambda x: F.greatest(F.least(x * F.lit(float(scale)), F.lit(LIMIT)), F.lit(-LIMIT))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("v")) \
        .where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & fine)
    return rows.select("vec_id", "label", F.transform("v", lambda x: F.floor(near(x)).cast("long")).alias("q"))


def trie_leaves(x: np.ndarray, book: np.ndarray, subtree: int = SUBTREE):
    """Yield (lo, hi, distances) over the distinct, lexicographically sorted parts ``x``: depth first, the distances of
    x[lo:hi] to every entry of ``book``."""
    width = x.shape[1]
    if not len(x):
        return
    starts = []  # first row of every node, depth by depth
    new = np.zeros(len(x), bool)
    new[0] = True
    for d in range(width):
        new[1:] |= x[1:, d] != x[:-1, d]
        starts.append(np.flatnonzero(new))
    stack = [(0, 0, len(x), np.zeros(len(book), np.int64))]
    while stack:
        depth, lo, hi, acc = stack.pop()
        if hi - lo <= subtree or depth == width:
            node, have = np.array([lo]), acc[None, :]
            for d in range(depth, width):  # every distinct prefix once, from its parent's vector
                s = starts[d][np.searchsorted(starts[d], lo):np.searchsorted(starts[d], hi)]
                parent = np.searchsorted(node, s, side="right") - 1
                have = have[parent] + np.square(x[s, d][:, None] - book[None, :, d])
                node = s
            yield lo, hi, have
            continue
        s = starts[depth][np.searchsorted(starts[depth], lo):np.searchsorted(starts[depth], hi)]
        ends = np.append(s[1:], hi)
        for a, b in zip(s[::-1], ends[::-1]):
            stack.append((depth + 1, int(a), int(b), acc + np.square(x[a, depth] - book[:, depth])))


def assign(part: np.ndarray, book: np.ndarray, subtree: int = SUBTREE):
    """For rows of one part position: (distinct parts, multiplicities, entry, squared distance, row -> distinct part)."""
    order = np.lexsort(part.T[::-1])
    rows = part[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    at = np.flatnonzero(first)
    leaves, times = rows[at], np.diff(np.append(at, len(rows)))
    back = np.empty(len(rows), np.int64)
    back[order] = np.cumsum(first) - 1
    entry, error = np.empty(len(leaves), np.int64), np.empty(len(leaves), np.int64)
    for lo, hi, distance in trie_leaves(leaves, book, subtree):
        entry[lo:hi] = distance.argmin(axis=1)  # the first of equal distances: the lower index
        error[lo:hi] = distance[np.arange(hi - lo), entry[lo:hi]]
    return leaves, times, entry, error, back


def pools(frames, rows: int = POOL_ROWS):
    """Frames of a task put together up to ``rows`` rows, so that a trie sees many parts and memory stays bounded."""
    held, n = [], 0
    for pdf in frames:
        if len(pdf):
            held.append(pdf)
            n += len(pdf)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def train_round(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: assign every part, then replace each used entry by the floor of its parts' mean."""
    parts, entries, width = books.shape

    def partial(frames):
        n = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for pdf in pools(frames):
            q = np.stack(pdf["q"].to_numpy()).reshape(-1, parts, width)
            for p in range(parts):
                leaves, times, entry, _, _ = assign(q[:, p], books[p])
                np.add.at(n[p], entry, times)
                np.add.at(sums[p], entry, leaves * times[:, None])
        p, e = np.nonzero(n)
        yield pd.DataFrame({"position": p.astype(np.int32), "entry": e.astype(np.int32), "n": n[p, e], "sums": pd.Series(list(sums[p, e]), dtype=object)})

    got = rows.select("q").mapInPandas(partial, SUMS).groupBy("position", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(width)])
    after = books.copy()
    for r in got.collect():  # at most parts x entries rows
        after[r["position"], r["entry"]] = [r[f"s{d}"] // r["n"] for d in range(width)]
    return after


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts, entries, width), or None without rows. They start from the rows of the smallest ids."""
    smallest = rows.orderBy(F.asc_nulls_last("vec_id"), "q")
    seeds = smallest.limit(entries).select("q").collect()  # bounded by ``entries``
    if not seeds:
        return None
    alike = F.size("q") == len(seeds[0]["q"])
    if len({len(r["q"]) for r in seeds}) > 1:  # other widths among them
        seeds = smallest.where(alike).limit(entries).select("q").collect()
    rows = rows.where(alike)
    books = np.array([r["q"] for r in seeds], np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = train_round(rows, books)
    return books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): two hex digits for each part's entry, and the summed squared distance."""
    parts, entries, width = books.shape
    digits = np.frombuffer("".join(f"{i:02x}" for i in range(entries)).encode(), "S2")

    def coded(frames):
        for pdf in pools(frames):
            q = np.stack(pdf["q"].to_numpy()).reshape(-1, parts, width)
            codes, error = np.empty((len(q), parts), "S2"), np.zeros(len(q), np.int64)
            for p in range(parts):
                _, _, entry, dist, back = assign(q[:, p], books[p])
                codes[:, p] = digits[entry][back]
                error += dist[back]
            text = codes.view(f"S{2 * parts}").ravel().astype(str)
            yield pd.DataFrame({"vec_id": pdf["vec_id"].astype("Int64"), "label": pdf["label"], "code": text, "error": error})

    return rows.where(F.size("q") == parts * width).mapInPandas(coded, CODED)


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
                 id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error (error summed over equal labels, nulls together), codebooks_sha256."""
    rows = whole_vectors(vectors, parts, scale, id_col, vec_col, label_col)
    books = fit(rows, parts, entries, rounds)
    if books is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = encode(rows, books)
    # one row a label and task before the exchange, so a frequent label is no hot key
    total = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long").alias("label_error")) \
        .withColumnRenamed("label", "of")
    return coded.join(total, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
