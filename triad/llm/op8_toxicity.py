"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words (A-Z lower-cased, ASCII punctuation as blanks; scripts written without blanks by character), kept as
64-bit fingerprints. Every term of the labelled examples is in the vectors, clean ones too; terms that no example has
are in no vector. Document frequencies run over all documents. The examples lie in blocks: rare terms as postings,
common ones as a dense matrix with each block's largest weight per term; a block's best possible score lets it be
skipped without changing the exact nearest ones. The neighbours' votes, weighted by similarity, are calibrated by a logistic
fit on up to ``CALIBRATION`` of the examples themselves (each without its own vote) together with the vector's length and the text's term
most tied to toxic examples. ``evidence`` names the neighbours.

Fitting uses a bounded sample of labelled rows (``EXAMPLES``, smallest hash of doc_id; equal texts count once, before
the sample, with their largest label); only rows with crc32(doc_id) mod 5 other than 0 are ever looked at for labels. All else
covers all documents.

Cases: a text without a term of the examples (null and empty ones too) gets the share of toxic examples among those without
terms. Several labels for one doc_id: the largest counts. Null labels are left out. Without any labelled row scores are
0. A null doc_id is not held out. Rows are scored one by one, so repeated rows repeat; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm import exchange as X
from triad.llm.text import LOWER_TO_BLANK, Words, batches, encoded

EXAMPLES = 20_000
NEIGHBOURS = 15
#: Examples whose own neighbours the calibration is fitted on, at most (three weights and an intercept).
CALIBRATION = 6_000
BLOCK = 128
#: Terms in the dense part of the index at most (the rest are postings), and texts searched together.
COMMON = 1_024
TOGETHER = 128
#: Single-precision sums choose candidates with this much room; exact sums then decide.
ROOM = 1e-4

STEP = "block int, payload binary"
VECTOR = "doc_id long, held_out boolean, terms binary, counts binary"
RESULT = "doc_id long, held_out boolean, score double, predicted int, evidence string"

_TABLE = bytes(32 if b < 128 and not chr(b).isalnum() else LOWER_TO_BLANK[b] for b in range(256))
_NO_BLANKS = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff])")


def term_counts(texts):
    """Per text its distinct terms (sorted fingerprints) and how often each occurs."""
    raw = encoded(t if not isinstance(t, str) or t.isascii() else _NO_BLANKS.sub(r" \1 ", t) for t in texts)
    for a, b in batches(raw):
        w = Words(raw[a:b], _TABLE)
        for lo, hi in zip(w.bounds[:-1], w.bounds[1:]):
            yield np.unique(w.hash[lo:hi], return_counts=True)


def held_out(col="doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, examples: int) -> list[tuple[int, int, int]]:
    """(doc_id, hash of its text, toxic) of the examples; of equal texts the smallest doc_id, with their largest label."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("h")).join(marked, "doc_id").groupBy("doc_id").agg(F.min("h").alias("h"), F.max("toxic").alias("toxic"))
    once = texts.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    return [(r["doc_id"], r["h"], r["toxic"]) for r in once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples).collect()]


def example_terms(slim: DataFrame, known: list[tuple[int, int, int]]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(doc_id, toxic, terms, counts) of the examples (at most ``EXAMPLES``), by doc_id."""
    sample = F.broadcast(slim.sparkSession.createDataFrame(known, "doc_id long, h long, toxic int"))
    rows = slim.withColumn("h", F.xxhash64("text")).join(sample, ["doc_id", "h"]).select("doc_id", "toxic", "text")

    def make(frames):
        for pdf in frames:
            got = [(u.tobytes(), n.astype(np.uint32).tobytes()) for u, n in term_counts(pdf["text"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"], "terms": [g[0] for g in got], "counts": [g[1] for g in got]})

    got = {r["doc_id"]: (r["doc_id"], r["toxic"], np.frombuffer(r["terms"], np.uint64), np.frombuffer(r["counts"], np.uint32))
           for r in rows.mapInPandas(make, "doc_id long, toxic int, terms binary, counts binary").toLocalIterator()}
    return [got[d] for d in sorted(got)]


def vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """Places in the vocabulary (broadcast, sorted) of each text's terms and how often each occurs."""
    def make(frames):
        terms = vocabulary.value
        for pdf in frames:
            t, c = [], []
            for u, n in term_counts(pdf["text"]):
                at = np.minimum(np.searchsorted(terms, u), max(len(terms) - 1, 0))
                hit = terms[at] == u if len(terms) else np.zeros(len(u), bool)
                t.append(at[hit].astype(np.uint32).tobytes())
                c.append(n[hit].astype(np.uint32).tobytes())
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "held_out": pdf["held_out"], "terms": t, "counts": c})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text")).mapInPandas(make, VECTOR)


def frequencies(table: DataFrame, terms: int, part: int = 1 << 16) -> tuple[int, np.ndarray]:
    """Documents, and documents per term, over all rows."""
    def count(frames):
        df, n = np.zeros(terms + 1, np.uint32), 0  # the last cell counts the rows
        for pdf in frames:
            n += len(pdf)
            if n:
                df[:-1] += np.bincount(np.frombuffer(b"".join(pdf["terms"]), np.uint32), minlength=terms).astype(np.uint32)
        df[-1] = n
        yield pd.DataFrame([(at // part, X.pack(df[at:at + part])) for at in range(0, len(df), part)], columns=["block", "payload"])

    def add(pdf):
        total = 0
        for p in pdf["payload"]:
            total = total + X.unpack(p)[0].astype(np.int64)
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "payload": [X.pack(total)]})

    df = np.zeros(terms + 1, np.int64)
    for r in X.merged(table.select("terms").mapInPandas(count, STEP), add).collect():
        df[r["block"] * part:(r["block"] + 1) * part] = X.unpack(r["payload"])[0]
    return int(df[-1]), df[:-1]


def weights(terms: bytes, counts: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Terms, unit TF-IDF weights and the vector's length."""
    t = np.frombuffer(terms, np.uint32).astype(np.int64)
    w = (1 + np.log(np.frombuffer(counts, np.uint32).astype(float))) * idf[t] if len(t) else np.empty(0)
    length = float(np.sqrt((w * w).sum()))
    return t, (w / length if length else w), length


class BlockMaxIndex:
    """Examples in blocks: postings of the rare terms, a dense matrix of the common ones with each block's largest weight per term."""

    def __init__(self, examples: list[tuple[int, int, np.ndarray, np.ndarray]], terms: int, block: int = BLOCK, common: int = COMMON):
        # neighbours in the index share their heaviest term, which keeps most blocks' bounds low
        examples = sorted(examples, key=lambda e: (int(e[2][e[3].argmax()]), e[0]))
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.label = np.array([e[1] for e in examples], np.int64)
        self.block, self.blocks, self.terms = block, -(-len(examples) // block), terms
        self.first = np.concatenate([[0], np.cumsum([len(e[2]) for e in examples])]).astype(np.int64)
        self.t = np.concatenate([e[2] for e in examples]).astype(np.int32) if examples else np.empty(0, np.int32)
        self.w = np.concatenate([e[3] for e in examples]) if examples else np.empty(0)
        df = np.bincount(self.t, minlength=terms)
        often = np.argsort(-df, kind="stable")[:common]
        self.common = np.sort(often[df[often] * 64 >= max(len(examples), 1)])
        self.made = None

    def __getstate__(self):  # what follows from the examples is made anew in each worker
        return self.__dict__ | {"made": None}

    def _make(self):
        place = np.full(self.terms, -1, np.int32)
        place[self.common] = np.arange(len(self.common))
        owner = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.first))
        at = place[self.t]
        dense = np.zeros((len(self.ids), len(self.common)), np.float32)
        dense[owner[at >= 0], at[at >= 0]] = self.w[at >= 0]
        starts = np.arange(0, len(self.ids), self.block)
        rare = np.flatnonzero(at < 0)
        rare = rare[np.argsort(self.t[rare], kind="stable")]
        start = np.concatenate([[0], np.cumsum(np.bincount(self.t[rare], minlength=self.terms))])
        self.made = (place, dense, np.maximum.reduceat(dense, starts, axis=0), starts, start, owner[rare], self.w[rare].astype(np.float32), np.zeros(self.terms))

    def example(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of the example at place ``i``."""
        cut = slice(self.first[i], self.first[i + 1])
        return self.t[cut].astype(np.int64), self.w[cut]

    def search(self, t: np.ndarray, w: np.ndarray, k: int, without: int | None = None) -> list[tuple[float, int, int]]:
        """The exact k nearest: (similarity, example id, label), ties to the smaller id; only similarities above zero."""
        return self.search_many([(t, w)], k, [without])[0]

    def search_many(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, without: list | None = None) -> list[list[tuple[float, int, int]]]:
        """``search`` of each text (terms, weights)."""
        if not len(self.ids):
            return [[] for _ in texts]
        if self.made is None:
            self._make()
        place, dense, best, starts, start, owner, weight, exact = self.made
        m, n = len(texts), len(self.ids)
        row = np.repeat(np.arange(m), [len(t) for t, _ in texts])
        t, w = np.concatenate([t for t, _ in texts]).astype(np.int64), np.concatenate([w for _, w in texts])
        at = place[t]
        q = np.zeros((m, dense.shape[1]), np.float32)
        q[row[at >= 0], at[at >= 0]] = w[at >= 0]
        # rare terms: summed over their postings; each block's bound adds its largest weights of the common ones
        rare = (at < 0) & (start[t + 1] > start[t])
        cuts = np.searchsorted(row[rare], np.arange(m + 1))
        lows, highs, heavy = start[t[rare]], start[t[rare] + 1], w[rare]
        sums = np.zeros((m, n), np.float32)
        for i in range(m):
            lo, hi = lows[cuts[i]:cuts[i + 1]], highs[cuts[i]:cuts[i + 1]]
            if len(lo):  # a term's postings lie together: whole slices, no gather
                lists = list(map(slice, lo.tolist(), hi.tolist()))
                whose = np.concatenate([owner[x] for x in lists], dtype=np.int64)
                sums[i] = np.bincount(whose, np.concatenate([weight[x] for x in lists]) * np.repeat(heavy[cuts[i]:cuts[i + 1]], hi - lo), minlength=n)
        for i, x in enumerate(without or ()):
            if x is not None:
                sums[i, self.ids == x] = -4
        bound = q @ best.T + np.maximum.reduceat(sums, starts, axis=1)
        seeds = min(self.blocks, 2 * k // self.block + 2)
        # the most promising blocks of each text give a first bound of its k-th similarity
        first, least = np.argpartition(-bound, seeds - 1, axis=1)[:, :seeds], np.full(m, -np.inf)
        have: list[list] = [[] for _ in range(m)]
        for b in np.unique(first):
            i, lo = np.flatnonzero((first == b).any(axis=1)), b * self.block
            for j, s in zip(i, sums[i, lo:lo + self.block] + q[i] @ dense[lo:lo + self.block].T):
                have[j].append(s)
        for i, s in enumerate(map(np.concatenate, have)):
            if len(s) >= k:
                least[i] = np.partition(s, len(s) - k)[len(s) - k]
        # every block that can still hold one of the k nearest; where most texts need a block, all get their sums there
        todo = (bound > 0) & (bound >= least[:, None] - ROOM)
        for b in np.flatnonzero(todo.any(axis=0)):
            i, lo = np.flatnonzero(todo[:, b]), b * self.block
            i = slice(None) if 2 * len(i) >= m else i
            sums[i, lo:lo + self.block] += q[i] @ dense[lo:lo + self.block].T
        if self.blocks >= k:  # k blocks that each hold such a similarity: a closer bound
            least = np.maximum(least, np.partition(np.where(todo, np.maximum.reduceat(sums, starts, axis=1), -np.inf), self.blocks - k, axis=1)[:, self.blocks - k])
        out = []
        for i, (t, w) in enumerate(texts):
            near = np.flatnonzero(sums[i] >= max(least[i] - ROOM, 1e-12))
            if len(near) > k:
                s = sums[i, near]
                near = near[s >= np.partition(s, len(s) - k)[len(s) - k] - ROOM]
            if not len(near):
                out.append([])
                continue
            exact[t] = w
            size = self.first[near + 1] - self.first[near]
            head = np.cumsum(size) - size
            pick = np.repeat(self.first[near] - head, size) + np.arange(size.sum())
            s = np.add.reduceat(exact[self.t[pick]] * self.w[pick], head)
            exact[t] = 0
            order = np.lexsort((self.ids[near], -np.round(s, 12)))[:k]
            out.append([(float(min(s[j], 1.0)), int(self.ids[near[j]]), int(self.label[near[j]])) for j in order])
        return out


class TermTies:
    """How far each term's toxic examples exceed what the share of toxic ones lets expect, in standard deviations."""

    def __init__(self, examples: list[tuple[int, int, np.ndarray, np.ndarray]], terms: int):
        every = [np.zeros(0, np.int64)]
        self.all = np.bincount(np.concatenate(every + [e[2] for e in examples]), minlength=terms)
        self.toxic = np.bincount(np.concatenate(every + [e[2] for e in examples if e[1]]), minlength=terms)
        self.share = sum(e[1] > 0 for e in examples) / max(len(examples), 1)

    def strongest(self, t: np.ndarray, own: int | None = None) -> float:
        """The largest tie of these terms that more than two examples have, without an example's ``own`` label."""
        n, k, p = self.all[t], self.toxic[t], self.share
        if own is not None:
            n, k = n - 1, k - int(own > 0)
        k, n = k[n > 2], n[n > 2]
        if not len(n) or not 0 < p < 1:
            return 0.0
        return float(np.clip(((k - n * p) / np.sqrt(n * p * (1 - p))).max(), 0, 30))


def vote(found: list[tuple[float, int, int]], length: float) -> tuple[float, float]:
    """Features of the calibration: log-odds of the similarity-weighted vote, and the vector's length."""
    total = sum(s for s, _, _ in found)
    toxic = sum(s for s, _, y in found if y)
    return float(np.log((toxic + 0.05) / (total - toxic + 0.05))), float(np.log1p(length))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first weight is the intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        r = ridge * np.r_[0, np.ones(len(w) - 1)]
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(r + 1e-6), x.T @ (y - p) - r * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, k: int = NEIGHBOURS) -> DataFrame:
    """Score of every document; see the module's description."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labelled_sample(slim, labels, examples)
    if not known:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.lit(0.0).alias("score"),
                           F.lit(0).alias("predicted"), F.lit("").alias("evidence"))
    made = example_terms(slim, known)
    vocabulary = np.unique(np.concatenate([m[2] for m in made])) if made else np.empty(0, np.uint64)
    size = max(len(vocabulary), 1)
    table = X.written(vectors(docs, spark.sparkContext.broadcast(vocabulary)), "toxic")
    n, df = frequencies(table, size)
    idf = np.log((n + 1) / (df + 1)) + 1
    for i, (d, y, t, c) in enumerate(made):
        t, w, length = weights(np.searchsorted(vocabulary, t).astype(np.uint32).tobytes(), c.tobytes(), idf)
        made[i] = (d, y, t.astype(np.int32), w, length)
    bare = [m[1] for m in made if not len(m[2])]
    floor = (sum(bare) + 0.01) / (len(bare) + 1)
    entries = [m for m in made if len(m[2])]
    shared = spark.sparkContext.broadcast((BlockMaxIndex(entries, size), TermTies(entries, size), {m[0]: m[4] for m in entries}, idf))
    # places in the index follow the texts' heaviest terms; a stride takes from all over it
    stride = max(1, -(-len(entries) // CALIBRATION))
    shares = spark.range(0, len(entries), stride, int(spark.conf.get("spark.sql.shuffle.partitions")))
    del made, entries

    def features(vs, leave=None):
        """(neighbours, features) of each (terms, weights, length); ``leave`` has (doc_id, label) of texts that are examples."""
        index, ties = shared.value[:2]
        for at in range(0, len(vs), TOGETHER):
            part = vs[at:at + TOGETHER]
            out = leave[at:at + TOGETHER] if leave else [(None, None)] * len(part)
            near = index.search_many([v[:2] for v in part], k, [d for d, _ in out])
            for (t, _, length), (_, own), found in zip(part, out, near):
                yield found, (*vote(found, length), ties.strongest(t, own))

    def leave_out(frames):
        index, _, lengths, _ = shared.value
        for pdf in frames:
            leave = [(int(index.ids[i]), int(index.label[i])) for i in pdf["id"]]
            vs = [(*index.example(i), lengths[d]) for i, (d, _) in zip(pdf["id"], leave)]
            out = [(*x, float(y)) for (found, x), (_, y) in zip(features(vs, leave), leave) if found]
            yield pd.DataFrame(out, columns=["v", "n", "s", "y"])

    fitted = shares.mapInPandas(leave_out, "v double, n double, s double, y double").collect()
    xy = np.array([tuple(r) for r in fitted]).reshape(-1, 4)
    fit = logistic(xy[:, :3], xy[:, 3]) if len(xy) and 0 < xy[:, 3].sum() < len(xy) else None

    def score(frames):
        idf = shared.value[3]
        for pdf in frames:
            keys = list(zip(pdf["terms"], pdf["counts"]))
            once = list(dict.fromkeys(keys))
            known = {}
            for key, (found, x) in zip(once, features([weights(*key, idf) for key in once])):
                p = floor
                if found and fit is not None:
                    p = float(1 / (1 + np.exp(-np.clip(fit @ np.r_[1.0, x], -30, 30))))
                elif found:
                    p = float(np.mean([y for _, _, y in found]))
                known[key] = (p, int(p >= 0.5), ",".join(f"{i}:{s:.4f}:{y}" for s, i, y in found[:5]))
            out = pd.DataFrame([known[key] for key in keys], columns=["score", "predicted", "evidence"])
            out.insert(0, "held_out", pdf["held_out"].astype(bool).to_numpy())
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").array)
            yield out

    return table.mapInPandas(score, RESULT)
