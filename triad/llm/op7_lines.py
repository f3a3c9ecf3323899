"""Line dedup by an exact set-similarity join.

A line's set holds its distinct words (A-Z lower-cased). Tokens are ordered by rarity: hashed counters over the whole
corpus give every token a rank, the hash breaks ties. A line sends the prefix of its rarest tokens; lines that reach
Jaccard 0.8 must meet on one of them. Meeting lines pass a length filter, a positional filter and a bound from
128-bit signatures; what remains is a candidate graph, of which each token's task reports a spanning forest only.
Candidate clusters (components) then verify their lines by exact Jaccard on whole sets, in bounded tiles.

A line goes when an earlier line (smaller doc_id, then smaller place) of the input matches it, whether or not that
one goes too. Every line with a word is judged. A set that is too small to match any other set sends no prefix: its repeats
share its fingerprint.

Cases: null and empty texts have no judged lines and come back unchanged (null stays null). Rows with one doc_id and
different texts are ordered by a hash of the text; equal rows count as one document and get the same result. A null
doc_id sorts first. A document that loses every line has an empty ``text`` and ``n_kept`` 0. Extra columns stay, but for those
named n_lines, n_kept or n_removed, which the result's own replace.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm import exchange as X
from triad.llm.components import components
from triad.llm.text import LOWER_TO_BLANK, Words, batches, encoded, mix

PERCENT = 80
LEAST_WORDS = 1
#: Lines of more than a ten-thousandth of all line rows: there are fewer than this many.
HEAVY_LINES, HEAVY_LEAST = 10_000, 1_000
#: Hashed counters for the rarity order (a fixed size: 16 MB), and lines of a cluster that one task compares.
COUNTERS_LOG2 = 22
TILE = 2_000

#: Documents whose lines make one round of messages.
ROWS_AT_ONCE = 2_500

STEP = "block int, payload binary"
FOUND = "a long, b long, doc_id long, rid long, line int"


def release(spark) -> None:
    """Let Spark delete the shuffle files of finished steps now instead of at the driver's next collection."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def rarity_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each hashed counter by its number of words in the whole corpus, rarest first."""
    size, parts = 1 << COUNTERS_LOG2, 16

    def count(frames):
        total = np.zeros(size, np.uint32)
        for pdf in frames:
            raw = encoded(pdf["text"])
            for a, b in batches(raw):
                h = Words(raw[a:b], LOWER_TO_BLANK).hash
                np.add.at(total, (h >> np.uint64(64 - COUNTERS_LOG2)).astype(np.int64), np.uint32(1))
        yield pd.DataFrame({"block": range(parts), "payload": [X.pack(p) for p in np.split(total, parts)]})

    def add(pdf):
        total = sum(X.unpack(p)[0].astype(np.int64) for p in pdf["payload"])
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "payload": [X.pack(total)]})

    got = X.merged(docs.select(F.col("text").cast("string").alias("text")).mapInPandas(count, STEP), add).collect()
    total = np.zeros(size, np.int64)
    for r in got:
        part = X.unpack(r["payload"])[0]
        total[r["block"] * len(part):(r["block"] + 1) * len(part)] = part
    ranks = np.empty(size, np.uint32)
    ranks[np.argsort(total, kind="stable")] = np.arange(size, dtype=np.uint32)
    return ranks


def token_order(line: np.ndarray, rank: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Order by line, rank and hash. One sort of a key that holds the hash's next bits, unless those leave a tie open."""
    rest = 64 - COUNTERS_LOG2
    major = (line.astype(np.uint64) << np.uint64(COUNTERS_LOG2)) | rank
    if len(line) and int(line[-1]) < 1 << (rest - 22):
        key = (major << np.uint64(22)) | ((h >> np.uint64(rest - 22)) & np.uint64((1 << 22) - 1))
        order = np.argsort(key)
        key, h_at = key[order], h[order]
        if not ((key[1:] == key[:-1]) & (h_at[1:] != h_at[:-1])).any():
            return order
    return np.lexsort((h, major))


class LineSets:
    """Judged lines of a batch: ``tokens`` sorted by line, rank and hash; ``first`` token of each line; ``n``, ``doc``, ``line``, ``fp``."""

    def __init__(self, raw: list[bytes], ranks: np.ndarray, least_words: int):
        w = Words(raw, LOWER_TO_BLANK)
        line, _ = w.lines()
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])
        lid = np.cumsum(new) - 1
        order = token_order(lid, ranks[(w.hash >> np.uint64(64 - COUNTERS_LOG2)).astype(np.int64)], w.hash)
        h, lid = w.hash[order], lid[order]
        once = np.ones(len(h), bool)
        once[1:] = (h[1:] != h[:-1]) | (lid[1:] != lid[:-1])
        h, lid = h[once], lid[once]
        n = np.bincount(lid, minlength=int(new.sum()))
        judged = n >= least_words
        self.tokens = h[judged[lid]] if len(h) else h
        self.n = n[judged]
        self.first = np.concatenate([[0], np.cumsum(self.n)[:-1]]).astype(np.int64) if len(self.n) else np.empty(0, np.int64)
        heads = np.flatnonzero(new)[judged]
        self.doc, self.line = w.doc[heads], line[heads]
        self.fp = mix(np.add.reduceat(mix(self.tokens), self.first) + self.n.astype(np.uint64)) if len(self.n) else np.empty(0, np.uint64)

    def signatures(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(self.n)), self.n)
        bit = np.uint64(1) << (self.tokens & np.uint64(63))
        high = (self.tokens & np.uint64(64)) != 0
        zero = np.uint64(0)
        a = np.bitwise_or.reduceat(np.where(high, zero, bit), self.first)
        b = np.bitwise_or.reduceat(np.where(high, bit, zero), self.first)
        del owner
        return a[pick], b[pick]


def _reach(na, nb, most, percent):
    """Whether sets of these sizes can be similar enough with at most ``most`` tokens in common."""
    return (100 + percent) * most >= percent * (na + nb)


def _pass(na, nb, a1, a2, b1, b2, percent):
    """Signature filter for pairs of lines."""
    miss_a = np.bitwise_count(a1 & ~b1) + np.bitwise_count(a2 & ~b2).astype(np.int64)
    miss_b = np.bitwise_count(b1 & ~a1) + np.bitwise_count(b2 & ~a2).astype(np.int64)
    return _reach(na, nb, np.minimum(na - miss_a, nb - miss_b), percent)


def candidate_forest(tok, ident, n, pos, s1, s2, percent: int, group: int = 512):
    """Edges with the components of the candidate graph of all these tokens' lines.

    A line that many tasks sent counts once. The shorter line of a pair must hold its first common token
    within its first n - ceil(2 t n / (1 + t)) + 1 tokens, about half of the prefix that the longer one needs.
    """
    _, once = np.unique(mix(tok ^ mix(ident)), return_index=True)
    tok, ident, n, pos, s1, s2 = (x[once] for x in (tok, ident, n, pos, s1, s2))
    order = np.lexsort((n, tok))
    tok, ident, n, pos, s1, s2 = (x[order] for x in (tok, ident, n, pos, s1, s2))
    left = n - pos  # tokens from this one on: a bound of what is in common
    starts = _reach(n, n, left, percent)
    cuts = np.concatenate([[0], np.flatnonzero(tok[1:] != tok[:-1]) + 1, [len(tok)]]).astype(np.int64)
    size = np.diff(cuts)
    out = []
    at = np.flatnonzero(np.repeat((size > 1) & (size <= group), size) & starts)
    end = np.repeat(cuts[1:], size)[at]
    n_at, left_at = n[at], left[at]
    d = 1
    while len(at):  # each line against the d-th next longer one of its token
        inside = at + d < end
        inside[inside] = 100 * n_at[inside] >= percent * n[at[inside] + d]
        if not inside.all():
            at, end, n_at, left_at = at[inside], end[inside], n_at[inside], left_at[inside]
        i = np.flatnonzero(_reach(n_at, n[at + d], np.minimum(left_at, left[at + d]), percent))
        i = at[i]
        j = i + d
        ok = _pass(n[i], n[j], s1[i], s2[i], s1[j], s2[j], percent)
        out.append((ident[i[ok]], ident[j[ok]]))
        d += 1
    for g in np.flatnonzero(size > group):
        lo, hi = cuts[g], cuts[g + 1]
        ids, nn, ll, a1, a2 = (x[lo:hi] for x in (ident, n, left, s1, s2))
        label = np.arange(hi - lo)
        for i in np.flatnonzero(starts[lo:hi]):
            # sorted by size: only longer lines up to the length bound, not yet connected
            top = np.searchsorted(nn, 100 * nn[i] // percent, "right")
            j = i + 1 + np.flatnonzero((label[i + 1:top] != label[i]) & _reach(nn[i], nn[i + 1:top], np.minimum(ll[i], ll[i + 1:top]), percent))
            if not len(j):
                continue
            j = j[_pass(nn[i], nn[j], a1[i], a2[i], a1[j], a2[j], percent)]
            if len(j):
                others, k = np.unique(label[j], return_index=True)
                out.append((np.repeat(ids[i], len(k)), ids[j[k]]))
                label[np.isin(label, others)] = label[i]
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return stars(np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out]))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the same components as (a, b): every node but a component's smallest, with that smallest one."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(ids))
    while len(x):
        lx, ly = label[x], label[y]
        np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
        while (label[label] != label).any():
            label = label[label]
        open_ = label[x] != label[y]
        x, y = x[open_], y[open_]
    member = np.flatnonzero(label != np.arange(len(ids)))
    return ids[label[member]], ids[member]


def lines_and_candidates(docs: DataFrame, ranks, blocks: int, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """One pass: every judged line (a: its set's fingerprint, with doc_id, rid and line), and candidate edges (a, b)."""
    def send(frames):
        for pdf in frames:
            seen: set = set()
            for at in range(0, len(pdf), ROWS_AT_ONCE):  # a few megabytes of text, so that their arrays stay small
                yield messages(pdf.iloc[at:at + ROWS_AT_ONCE], seen)

    def messages(pdf, seen):
        prefix, lines = [], []
        raw = encoded(pdf["text"])
        ids, rids = pdf["doc_id"].astype("Int64"), pdf["rid"].to_numpy()
        null = ids.isna().to_numpy()
        ids = ids.fillna(0).to_numpy(np.int64)
        for lo, hi in batches(raw):
            s = LineSets(raw[lo:hi], ranks.value, least_words)
            if not len(s.n):
                continue
            doc = s.doc + lo
            lines.append((s.fp, ids[doc], null[doc].astype(np.uint8), rids[doc], s.line.astype(np.int32)))
            fresh = np.array([f not in seen and not seen.add(f) for f in s.fp.tolist()], bool)
            alone = 100 * s.n < percent * (s.n + 1)  # no other set, not even one word larger, is similar enough
            p = np.where(fresh & ~alone, s.n - -(-percent * s.n // 100) + 1, 0)
            pick = np.repeat(np.arange(len(p)), p)
            pos = np.arange(len(pick)) - np.repeat(np.cumsum(p) - p, p)
            a, b = s.signatures(np.arange(len(s.n)))
            prefix.append((s.tokens[s.first[pick] + pos], s.fp[pick], s.n[pick].astype(np.int32), pos.astype(np.int32), a[pick], b[pick]))
        rows = []
        for kind, parts in ((0, prefix), (1, lines)):
            if parts:
                cols = [np.concatenate([p[i] for p in parts]) for i in range(len(parts[0]))]
                # lines are only unpacked: dealt by document, so that a frequent line is no hot block
                deal = cols[3].view(np.uint64) if kind else cols[0]
                for block, *got in X.split_blocks(cols[0], (mix(deal) % np.uint64(blocks)).astype(np.int64) * 2 + kind, *cols[1:]):
                    rows.append((block, X.pack(*got)))
        return pd.DataFrame(rows, columns=["block", "payload"])

    def match(key, pdf):
        got = [X.unpack(p) for p in pdf["payload"]]
        cols = [np.concatenate([g[i] for g in got]) for i in range(len(got[0]))]
        if key[0] % 2:
            ids = pd.Series(cols[1]).astype("Int64").mask(cols[2].astype(bool))
            return pd.DataFrame({"a": cols[0].view(np.int64), "b": pd.Series([None] * len(ids), dtype="Int64"), "doc_id": ids, "rid": cols[3], "line": cols[4]})
        tok, ident, n, pos, s1, s2 = cols
        a, b = candidate_forest(tok, ident, n.astype(np.int64), pos.astype(np.int64), s1, s2, percent)
        none = pd.Series([None] * len(a), dtype="Int64")
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64), "doc_id": none, "rid": none, "line": none})

    return docs.select("doc_id", "rid", "text").mapInPandas(send, STEP).groupBy("block").applyInPandas(match, FOUND)


def _signatures(sets: list[np.ndarray], words: int) -> np.ndarray:
    """Bitmaps of ``words`` 64-bit words, one bit per token by its hash."""
    sig = np.zeros((len(sets), words), np.uint64)
    for row, s in zip(sig, sets):
        np.bitwise_or.at(row, ((s >> np.uint64(6)) & np.uint64(words - 1)).astype(np.int64), np.uint64(1) << (s & np.uint64(63)))
    return sig


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact Jaccard of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    inter = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * inter >= percent * (len(a) + len(b) - inter)


def first_matches(sets: list[np.ndarray], part: np.ndarray, cross: bool, percent: int) -> np.ndarray:
    """For each set the first earlier one that matches (-1: none); ``cross`` compares sets of different parts only."""
    m = len(sets)
    best = np.full(m, -1)
    if m <= 16:
        for i in range(m):
            for k in range(i + 1, m):
                if best[k] < 0 and not (cross and part[i] == part[k]) and _similar(sets[i], sets[k], percent):
                    best[k] = i
        return best
    n = np.array([len(s) for s in sets], np.int64)
    signed = [_signatures(sets, 8)]
    if n.max() > 128:  # long lines fill a narrow signature; what it lets pass meets a wider one
        signed.append(_signatures(sets, min(128, 1 << int(np.ceil(np.log2(n.max() / 16))))))
    for i in range(m):  # earliest first: a line is settled by the first that matches
        j = i + 1 + np.flatnonzero(best[i + 1:] < 0)
        j = j[(100 * n[i] >= percent * n[j]) & (100 * n[j] >= percent * n[i])]
        if cross:
            j = j[part[j] != part[i]]
        for sig in signed:
            if len(j):
                most = np.minimum(n[i] - np.bitwise_count(sig[i] & ~sig[j]).sum(axis=1, dtype=np.int64),
                                  n[j] - np.bitwise_count(sig[j] & ~sig[i]).sum(axis=1, dtype=np.int64))
                j = j[100 * most >= percent * (n[i] + n[j] - most)]
        for k in j:
            if _similar(sets[i], sets[k], percent):
                best[k] = i
    return best


def earliest_matches(members: DataFrame, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """(a, doc_id, rid, line) of the earliest other line whose set matches, from members (component, a, doc_id, rid, line, tokens).

    Clusters of up to ``tile`` lines share groups of about twice that many lines; larger ones are compared part against part.
    """
    buckets = max(2 * int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), members.count() // (2 * tile) + 1)
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n")).select("component", F.ceil(F.col("n") / tile).cast("int").alias("parts"))
    placed = members.join(sizes, "component").withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int"))
    paired = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("q")) \
        .withColumn("lo", F.least("part", "q")).withColumn("hi", F.greatest("part", "q")) \
        .withColumn("bucket", F.when(F.col("parts") == 1, F.pmod(F.xxhash64("component"), F.lit(buckets))).otherwise(F.lit(-1))) \
        .withColumn("large", F.when(F.col("parts") > 1, F.col("component")).otherwise(F.lit(0))).drop("parts", "q")

    def compare(key, pdf):
        pdf = pdf.sort_values(["component", "doc_id", "rid", "line"], na_position="first", kind="stable").reset_index(drop=True)
        sets = [np.frombuffer(x, np.uint64) for x in pdf["tokens"]]
        part, comp = pdf["part"].to_numpy(), pdf["component"].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(comp[1:] != comp[:-1]) + 1, [len(comp)]])
        best = np.full(len(sets), -1)
        for x, y in zip(cuts[:-1], cuts[1:]):
            found = first_matches(sets[x:y], part[x:y], key[2] != key[3], percent)
            best[x:y] = np.where(found >= 0, found + x, -1)
        hit = np.flatnonzero(best >= 0)
        by = pdf.iloc[best[hit]].reset_index(drop=True)
        return pd.DataFrame({"a": pdf["a"].to_numpy()[hit], "doc_id": by["doc_id"].astype("Int64"), "rid": by["rid"], "line": by["line"]})

    return paired.groupBy("bucket", "large", "lo", "hi").applyInPandas(compare, "a long, doc_id long, rid long, line int")


def dedup_lines(docs: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, tile: int = TILE) -> DataFrame:
    """``docs`` with later matching lines cut from ``text``; adds n_lines, n_kept (lines) and the original ``n_removed``."""
    spark = docs.sparkSession
    whole = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string")) \
        .withColumn("__rid", F.xxhash64("doc_id", "text"))
    slim = whole.select("doc_id", F.col("__rid").alias("rid"), "text")
    bytes_ = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0)).alias("b")).first()["b"]
    ranks = spark.sparkContext.broadcast(rarity_ranks(docs))
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(bytes_ * 0.05) // X.BLOCK_KEYS + 1)
    found = X.written(lines_and_candidates(slim, ranks, blocks, least_words, percent), "lines")
    release(spark)
    lines = found.where("b IS NULL").drop("b")
    place = F.struct("doc_id", "rid", "line")
    firsts = lines.groupBy("a").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    clusters = components(found.where("b IS NOT NULL").select("a", "b"))
    release(spark)  # before the texts are joined, the largest exchange that is left
    wanted = firsts.join(clusters.withColumnRenamed("id", "a"), "a").select("a", "component", "first.*")
    asked = wanted.groupBy("rid").agg(F.collect_list(F.struct("a", "component", "doc_id", "line")).alias("asked"))
    texts = slim.select("rid", "text").join(asked, "rid")

    def fetch(frames):
        for pdf in frames:
            rows, raw, tokens = [], [], []
            for rid, text, asks in zip(pdf["rid"], pdf["text"], pdf["asked"]):
                cut = text.split("\n")
                for x in asks:
                    rows.append((x["component"], x["a"], x["doc_id"], rid, x["line"]))
                    raw.append(cut[x["line"]].encode("utf-8", "replace"))
            for lo, hi in batches(raw):
                w = Words(raw[lo:hi], LOWER_TO_BLANK)
                tokens += [np.unique(w.hash[x:y]).tobytes() for x, y in zip(w.bounds[:-1], w.bounds[1:])]
            out = pd.DataFrame(rows, columns=["component", "a", "doc_id", "rid", "line"])
            out["tokens"] = pd.Series(tokens, dtype=object)
            yield out.astype({"doc_id": "Int64"})

    members = X.written(texts.mapInPandas(fetch, "component long, a long, doc_id long, rid long, line int, tokens binary").dropDuplicates(["a"]), "members")
    release(spark)
    other = earliest_matches(members, percent, tile).groupBy("a").agg(F.min(place).alias("match"))
    # only sets with a later line or an earlier match take anything away
    bound = X.written(firsts.join(other, "a", "left").where((F.col("n") > 1) | F.col("match").isNotNull()).select(
        "a", "n", F.least("first", F.coalesce("match", "first")).alias("least")), "bound")
    release(spark)
    most = max(HEAVY_LEAST, (bound.agg(F.sum("n").alias("n")).first()["n"] or 0) // HEAVY_LINES)
    heavy = F.broadcast(bound.where(F.col("n") > most).drop("n"))  # fewer than HEAVY_LINES rows
    cuts = lines.join(heavy, "a").unionByName(lines.join(heavy, "a", "left_anti").join(bound.where(F.col("n") <= most).drop("n"), "a"))
    gone = X.written(cuts.where(F.col("least") < place).groupBy("rid").agg(F.collect_set("line").alias("gone")), "gone")
    for done in (found, clusters, members, bound):  # nothing reads them any more; the texts' exchange needs their room
        X.drop_written(done)
    release(spark)
    none = F.array().cast("array<int>")
    cut = F.split("text", "\n", -1)
    gone = gone.select(F.col("rid").alias("__rid"), F.col("gone").alias("__gone"))
    rows = whole.join(gone, "__rid", "left").withColumn("__gone", F.coalesce("__gone", none)).withColumn("n_lines", F.size(F.coalesce(cut, F.array().cast("array<string>"))).cast("long"))
    kept = F.when(F.size("__gone") == 0, F.col("text")).otherwise(F.array_join(F.filter(cut, lambda x, i: ~F.array_contains("__gone", i)), "\n"))
    return rows.withColumn("text", kept).withColumn("n_removed", F.size("__gone").cast("long")).drop("__rid", "__gone") \
        .withColumn("n_kept", F.col("n_lines") - F.col("n_removed"))
