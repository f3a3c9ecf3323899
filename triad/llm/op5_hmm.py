"""Hidden Markov language model: Baum-Welch counts aggregated across partitions, exact scores by scaled forward recursion.

Tokens are lower-cased words and one end per text. A latent state emits a token class, the class emits the word: the
most frequent training words are classes of their own, other words fall in classes by their first and last two bytes,
where a word has probability (c + 0.1) / (N_class + 0.1 * (V_class + 1)); the last slot is any unknown word.
So emission tables have a bounded size, word probabilities come from counts over the whole training corpus,
and probabilities of all finite texts add up to one. Word counts travel chunk by chunk (``exchange``), so no task or
driver holds the vocabulary. Each Baum-Welch round runs over all training texts.

Cases: null and empty texts are the end token alone. A null doc_id is a training row. Repeated rows count and are scored
each. Without training rows every word is unknown and counts fall back to the 0.1 terms. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm import exchange as X
from triad.llm.text import LOWER_TO_BLANK, Words, batches, encoded, mix

STATES = 8
ROUNDS = 5
TOP_WORDS = 2_048
AFFIX_CLASSES = 2_048
ALPHA = 0.1
#: Tokens worked on at once by the recursions.
BATCH_TOKENS = 1 << 20

RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
CODED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, words_score double, classes binary"
COUNTS = "kind int, chunk int, block int, payload binary"
END = TOP_WORDS + AFFIX_CLASSES  # the end token's class
CLASSES = END + 1


def held_out_ids(ids) -> np.ndarray:
    import zlib

    return np.array([not pd.isna(i) and zlib.crc32(str(int(i)).encode()) % 10 == 0 for i in ids], bool)


def affix_class(w: Words) -> np.ndarray:
    """Class of each word by its first and last two bytes."""
    b = np.frombuffer(w.buffer, np.uint8).astype(np.uint64)
    if not len(w.start):
        return np.empty(0, np.int64)
    second, third = np.minimum(w.start + 1, w.end - 1), np.maximum(w.end - 2, w.start)
    code = b[w.start] | b[second] << np.uint64(8) | b[third] << np.uint64(16) | b[w.end - 1] << np.uint64(24)
    return (mix(code) % np.uint64(AFFIX_CLASSES)).astype(np.int64)


def word_blocks(chunks: X.Chunks) -> int:
    """Blocks of the word space, so that one holds the words of some ten chunks at most."""
    return max(chunks.bytes // 6 // (4 * X.BLOCK_KEYS) + 1, min(chunks.count // 4 + 1, 64))


def corpus_counts(chunks: X.Chunks) -> DataFrame:
    """Answers (kind 0: global training counts of a chunk's words) and block summaries (kind 1)."""
    blocks = word_blocks(chunks)

    def send(key, pdf):
        raw, train = encoded(pdf["text"]), ~held_out_ids(pdf["doc_id"])
        parts = []
        for a, b in batches(raw):
            w = Words(raw[a:b], LOWER_TO_BLANK)
            u, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
            parts.append((u, np.bincount(inverse, train[a:b][w.doc], len(u)).astype(np.int64), affix_class(w)[first]))
        if not parts:
            return X.frame([], X.MESSAGE)
        h, n, c = (np.concatenate([p[i] for p in parts]) for i in range(3))
        u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        n = np.bincount(inverse, n, len(u)).astype(np.uint32)
        rows = [(key[0], blk, X.pack(k, m, a)) for blk, k, m, a in X.split_blocks(u, (u % np.uint64(blocks)).astype(np.int64), n, c[first].astype(np.uint16))]
        rows.append((key[0], blocks, X.pack(np.empty(0, np.uint64), np.array([train.sum()], np.uint32), np.empty(0, np.uint16))))
        return X.frame(rows, X.MESSAGE)

    def add(key, pdf):
        got = [X.unpack(p) for p in pdf["payload"]]
        if key[0] == blocks:  # training texts, one end each
            total = np.array([sum(int(g[1][0]) for g in got)], np.int64)
            return X.frame([(2, -1, -1, X.pack(total))], COUNTS)
        h, n, c = (np.concatenate([g[i] for g in got]) for i in range(3))
        u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        total = np.bincount(inverse, n, len(u)).astype(np.int64)
        rows, at = [], 0
        for chunk, block, g in zip(pdf["chunk"], pdf["block"], got):
            rows.append((0, chunk, block, X.pack(total[inverse[at:at + len(g[0])]].astype(np.int64))))
            at += len(g[0])
        cls, seen = c[first].astype(np.int64), total > 0
        top = np.lexsort((u, -total))[:TOP_WORDS]
        top = top[seen[top]]
        rows.append((1, -1, int(key[0]), X.pack(
            np.bincount(cls, total, AFFIX_CLASSES).astype(np.int64), np.bincount(cls[seen], minlength=AFFIX_CLASSES).astype(np.int64), total[top], u[top], cls[top])))
        return X.frame(rows, COUNTS)

    return chunks.send(send).groupBy("block").applyInPandas(add, COUNTS)


def summary(counts: DataFrame) -> dict:
    """Class totals, the most frequent words and the corpus's size, from one bounded row per block."""
    n, v, top = np.zeros(AFFIX_CLASSES, np.int64), np.zeros(AFFIX_CLASSES, np.int64), []
    ends = 0
    for r in counts.where("kind > 0").toLocalIterator():
        got = X.unpack(r["payload"])
        if r["kind"] == 2:
            ends = int(got[0][0])
            continue
        n, v = n + got[0], v + got[1]
        top = sorted([*top, *zip((-got[2]).tolist(), got[3].tolist(), got[4].tolist())])[:TOP_WORDS]
    total, distinct = int(n.sum()) + ends, int(v.sum()) + (ends > 0)
    for count, _, cls in top:  # a class of its own leaves the affix class
        n[cls] += count
        v[cls] -= 1
    own = np.array([-c for c, _, _ in top] + [0] * (TOP_WORDS - len(top)), np.int64)
    return {"tokens": total, "distinct": distinct, "ends": ends, "class_tokens": n, "class_words": v,
            "top": np.array([h for _, h, _ in top], np.uint64), "class_counts": np.concatenate([own, n, [ends]])}


def coded(chunks: X.Chunks, counts: DataFrame, s: dict) -> DataFrame:
    """Per document: its classes in order and the parts of its scores that need no recursion."""
    floor = s["tokens"] + ALPHA * (s["distinct"] + 1)
    below = s["class_tokens"] + ALPHA * (s["class_words"] + 1)
    top_order = np.argsort(s["top"])
    top_hash = s["top"][top_order]

    def make(key, pdf, answers):
        rows, raw, held = [], encoded(pdf["text"]), held_out_ids(pdf["doc_id"])
        got = {int(b): X.unpack(p)[0] for b, p in zip(answers["block"], answers["payload"])}
        words = [Words(raw[a:b], LOWER_TO_BLANK) for a, b in batches(raw)]
        u = np.unique(np.concatenate([np.unique(w.hash) for w in words])) if words else np.empty(0, np.uint64)
        count = np.zeros(len(u), np.int64)
        if len(u):
            block = (u % np.uint64(blocks)).astype(np.int64)
            for b, n in got.items():
                count[block == b] = n
        end_base = float(np.log10((s["ends"] + ALPHA) / floor))
        at = 0
        for w, (a, b) in zip(words, batches(raw)):
            c = count[np.searchsorted(u, w.hash)]
            base = np.log10((c + ALPHA) / floor)
            cls = affix_class(w)
            word = np.log10((c + ALPHA) / below[cls])
            cls = cls + TOP_WORDS
            if len(top_hash):
                i = np.minimum(np.searchsorted(top_hash, w.hash), len(top_hash) - 1)
                mine = top_hash[i] == w.hash
                cls[mine], word[mine] = top_order[i[mine]], 0.0
            for j in range(b - a):
                lo, hi = w.bounds[j], w.bounds[j + 1]
                d = pdf["doc_id"].iloc[at]
                rows.append((None if pd.isna(d) else int(d), bool(held[at]), int(hi - lo + 1), int((c[lo:hi] > 0).sum() + (s["ends"] > 0)),
                             float(base[lo:hi].sum()) + end_base, float(word[lo:hi].sum()),
                             np.append(cls[lo:hi], END).astype(np.uint16).tobytes()))
                at += 1
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in CODED.split(", ")])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    blocks = word_blocks(chunks)
    return chunks.meet(counts.where("kind = 0").select("chunk", "block", "payload"), make, CODED)


def initial(s: dict, states: int, seed: int = 11) -> dict:
    """Emissions near the corpus's class shares, disturbed at random; states that tend to stay."""
    rng = np.random.default_rng(seed)
    share = s["class_counts"] + ALPHA
    share = share / share.sum()
    emit = share * np.exp(rng.normal(0, 0.7, (states, CLASSES)))
    move = np.full((states, states), 0.1 / max(states - 1, 1)) + np.eye(states) * (0.9 - 0.1 / max(states - 1, 1)) if states > 1 else np.ones((1, 1))
    return {"start": np.full(states, 1 / states), "move": move, "emit": emit / emit.sum(axis=1, keepdims=True), "share": share}


def padded(classes: list[np.ndarray]):
    """Batches of texts of like length: (indices, lengths, classes as steps x texts)."""
    order = np.argsort([len(c) for c in classes], kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and len(classes[order[end]]) * (end + 1 - at) <= BATCH_TOKENS:
            end += 1
        idx = order[at:end]
        n = np.array([len(classes[i]) for i in idx])
        grid = np.full((n.max(), len(idx)), END, np.int64)
        for j, i in enumerate(idx):
            grid[:n[j], j] = classes[i]
        yield idx, n, grid
        at = end


def forward(model: dict, n: np.ndarray, grid: np.ndarray, keep: bool = False):
    """Scaled forward recursion: natural log likelihood of each text (and scaled states and scales, if kept).

    States are rows and texts columns, so sums over states add whole rows. States that are kept are single precision.
    """
    real = np.float32 if keep else np.float64
    emit, move = model["emit"].astype(real), np.ascontiguousarray(model["move"].T, real)
    steps, texts = grid.shape
    alphas = np.zeros((steps, len(move), texts), real) if keep else None
    scales = np.ones((steps, texts), real)
    firsts = np.searchsorted(n, np.arange(steps), "right").tolist()  # texts come sorted by length; shorter ones are done
    prev, done = None, 0
    for t, first in enumerate(firsts):
        a = emit.take(grid[t, first:], axis=1)
        a *= move @ prev[:, first - done:] if t else model["start"].astype(real)[:, None]
        z = a.sum(axis=0)
        a /= z
        scales[t, first:] = z
        if keep:
            alphas[t, :, first:] = a
        prev, done = a, first
    return np.log(scales).sum(axis=0, dtype=np.float64), alphas, scales


def expected_counts(model: dict, n: np.ndarray, grid: np.ndarray):
    """Baum-Welch counts of a batch: starts, moves, emissions and the log likelihood."""
    emit, move = model["emit"], model["move"]
    k = len(move)
    loglik, alphas, scales = forward(model, n, grid, keep=True)
    moves, emits = np.zeros((k, k)), np.zeros((k, CLASSES))
    steps, texts = grid.shape
    firsts = np.searchsorted(n, np.arange(steps), "right").tolist()
    beta = np.ones((k, texts))
    for t in range(steps - 1, -1, -1):
        later = firsts[t + 1] if t < steps - 1 else texts  # texts that go on to t + 1
        if later < texts:
            out = emit.take(grid[t + 1, later:], axis=1)
            out *= beta[:, later:]
            out /= scales[t + 1, later:]
            moves += alphas[t, :, later:] @ out.T
            beta[:, later:] = move @ out
        alphas[t, :, firsts[t]:] *= beta[:, firsts[t]:]  # from here on the states' probabilities given the whole text
    moves *= move
    flat = grid.ravel()
    for s in range(k):  # places beyond a text's end hold zero
        emits[s] = np.bincount(flat, alphas[:, s].ravel(), CLASSES)
    return alphas[0].sum(axis=1, dtype=np.float64), moves, emits, loglik.sum()


def train(table: DataFrame, s: dict, states: int = STATES, rounds: int = ROUNDS) -> tuple[dict, list[float]]:
    """Baum-Welch over all training texts; one job a round, whose counts are added up by blocks of classes."""
    spark = table.sparkSession
    model, history = initial(s, states), []
    parts = 8
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(model)

        def expect(frames, now=now):
            model = now.value
            total = None
            for pdf in frames:
                texts = [np.frombuffer(c, np.uint16) for c in pdf["classes"]]
                for _, n, grid in padded(texts):
                    got = expected_counts(model, n, grid)
                    total = got if total is None else [x + y for x, y in zip(total, got)]
            if total is not None:
                starts, moves, emits, loglik = total
                rows = [(p, X.pack(e.ravel())) for p, e in enumerate(np.array_split(emits, parts, axis=1))]
                yield pd.DataFrame([*rows, (parts, X.pack(starts, moves.ravel(), np.array([loglik])))], columns=["block", "payload"])

        def add(pdf):
            summed = [sum(x) for x in zip(*(X.unpack(p) for p in pdf["payload"]))]
            return pd.DataFrame({"block": pdf["block"].iloc[:1], "payload": [X.pack(*summed)]})

        sent = table.where("NOT held_out").select("classes").mapInPandas(expect, "block int, payload binary")
        got = {r["block"]: X.unpack(r["payload"]) for r in X.merged(sent, add).collect()}
        now.unpersist()
        if not got:
            break
        starts, moves, loglik = got[parts]
        emits = np.concatenate([got[p][0].reshape(states, -1) for p in range(parts)], axis=1)
        emits += model["share"]  # one token's worth of the corpus's shares keeps every class possible
        moves = moves.reshape(states, states) + 0.1
        starts = starts + 0.1
        model = model | {"start": starts / starts.sum(), "move": moves / moves.sum(axis=1, keepdims=True), "emit": emits / emits.sum(axis=1, keepdims=True)}
        history.append(float(loglik[0]))
    return model, history


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Learn from the texts not held out and score every text."""
    from triad.llm.op7_lines import release

    spark = docs.sparkSession
    chunks = X.Chunks(docs)
    counts = X.written(corpus_counts(chunks), "counts")
    release(spark)
    s = summary(counts)
    table = X.written(coded(chunks, counts, s), "coded")
    release(spark)
    model, _ = train(table, s, states, rounds)
    shared, tokens = spark.sparkContext.broadcast(model), s["tokens"]

    def run(frames):
        model = shared.value
        for pdf in frames:
            texts = [np.frombuffer(c, np.uint16) for c in pdf["classes"]]
            out = pdf["words_score"].to_numpy().copy()
            for idx, n, grid in padded(texts):
                out[idx] += forward(model, n, grid)[0] / np.log(10)
            res = pdf[["doc_id", "held_out", "n_tokens", "n_known"]].copy()
            res["doc_id"] = res["doc_id"].astype("Int64")
            res["train_tokens"], res["base_score"], res["score"] = tokens, pdf["base_score"], out
            yield res

    return table.mapInPandas(run, RESULT)
