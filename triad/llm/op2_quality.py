"""Quality classifier by co-training.

Two views of a document: its text's content (character shares, word statistics) and its page metadata (language,
source, length and line counts). Each view has a logistic classifier. In every round both are fitted on the labelled
rows plus the unlabelled rows on which the *other* view's classifier of the round before was confident (its
pseudo-labels, at half weight). Newton steps add up gradients and curvature over all rows in one job, so each round sees
the whole corpus. Labelled rows with crc32(doc_id) mod 5 = 0 are kept from fitting and calibrate the views (a logistic
fit of each view's log-odds and of both together); the combination scores every document.

Cases: null and empty texts have zero content statistics and are scored like others. Null metadata count as a value of
their own. Several labels for one doc_id: the smallest quality counts. Null labels are left out. Without labels of both
kinds every document is kept with score 1. Rows are scored one by one; extra columns stay in ``keep_good``.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm import exchange as X
from triad.llm.text import encoded

ROUNDS = 3
NEWTON_STEPS = 4
#: A view's pseudo-label counts when its probability is within this of 0 or 1.
CONFIDENT = 0.03
PSEUDO_WEIGHT = 0.5
#: Labelled rows held out for calibration that reach the driver, at most (by smallest hash of doc_id).
CALIBRATION_ROWS = 50_000
SOURCE_SLOTS, LANG_SLOTS = 32, 8
#: Documents are kept from this combined probability of good quality.
THRESHOLD = 0.5

_UPPER, _LOWER = np.arange(65, 91), np.arange(97, 123)
_DIGIT = np.arange(48, 58)
_MARKS = np.array([b for b in range(33, 127) if not chr(b).isalnum()])
N_TEXT = 26
N_META = 6 + SOURCE_SLOTS + LANG_SLOTS


def text_features(raw: bytes) -> list[float]:
    """Content statistics of a whole text; shares are of bytes, words or lines."""
    out = [1.0] + [0.0] * (N_TEXT - 1)
    words = raw.split()
    if not words:
        return out
    n, w = len(raw), len(words)
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    marks = h[_MARKS]
    count = Counter(words)
    top = max(count.values())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = sum(a == b for a, b in zip(words, words[1:]))
    lengths = np.fromiter(map(len, words), np.float64, w)
    ends = sum(x[-1:] in b".!?" for x in lines)
    shift = w // 2
    longest = float(lengths.max())
    letters = max(1, int(h[_UPPER].sum() + h[_LOWER].sum() + h[128:].sum()))
    sizes = np.fromiter(map(len, lines), np.float64, len(lines))
    out[1:] = [
        min(np.log1p(w) / 5, 3), lengths.mean() / 8, min(lengths.std() / 8, 4), min(np.log1p(longest) / 3, 4),
        len(count) / w, (len(count) / w) * np.log1p(w) / 5, top / w, pairs / w, h[_UPPER].sum() / letters, h[_DIGIT].sum() / n * 5,
        marks.sum() / n * 5, marks.max() / n * 10, h[33] / n * 20, h[124] / n * 20, (h[35] + h[36] + h[37] + h[38] + h[42]) / n * 10,
        (h[60] + h[62] + h[123] + h[125]) / n * 20, h[128:].sum() / n * 3, len(set(lines)) / max(1, len(lines)), ends / max(1, len(lines)),
        min(np.log1p(sizes.mean()) / 6, 3), min(np.log1p(len(lines)) / 4, 3), sum(1 for k in count.values() if k == 1) / w,
        h[46] / w, h[44] / w, float(shift > 20 and words[:20] in (words[shift:shift + 20], words[-20:])),
    ]
    return out


def meta_features(lang, source, n_chars, lines: int, n_bytes: int) -> list[float]:
    """Page metadata: length as stated, lines, language and source in hashed slots."""
    said = float(n_chars) if n_chars is not None and n_chars == n_chars else float(n_bytes)
    size = np.log1p(max(said, 0.0))
    out = [1.0, size / 8, (size / 8) ** 2, np.log1p(lines) / 4, np.log1p(said / max(lines, 1)) / 6, float(said < 200)]
    for value, slots in ((source, SOURCE_SLOTS), (lang, LANG_SLOTS)):
        hot = [0.0] * slots
        hot[zlib.crc32(str(value).encode()) % slots] = 1.0
        out += hot
    return out


def _matrices(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    raw = encoded(pdf["text"])
    xt = np.array([text_features(r) for r in raw], np.float32).reshape(-1, N_TEXT)
    xm = np.array([meta_features(l if isinstance(l, str) else None, s if isinstance(s, str) else None, None if pd.isna(n) else n, r.count(b"\n") + 1, len(r))
                   for l, s, n, r in zip(pdf["lang"], pdf["source"], pdf["n_chars"], raw)], np.float32).reshape(-1, N_META)
    return xt, xm


def _inputs(docs: DataFrame) -> DataFrame:
    have = set(docs.columns)
    pick = lambda c, t: (F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
    return docs.select(pick("doc_id", "long"), pick("text", "string"), pick("lang", "string"), pick("source", "string"), pick("n_chars", "double"))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, content, meta): both views of every document as packed numbers."""
    def make(frames):
        for pdf in frames:
            xt, xm = _matrices(pdf)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "content": [r.tobytes() for r in xt], "meta": [r.tobytes() for r in xm]})

    return _inputs(docs).mapInPandas(make, "doc_id long, content binary, meta binary")


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def _read(col, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), np.float32).reshape(-1, width).astype(np.float64)


def fit_views(table: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the content and metadata classifiers after co-training; table: features with quality and calib."""
    spark = table.sparkSession
    wt, wm, teacher = np.zeros(N_TEXT), np.zeros(N_META), None
    for _ in range(rounds):
        for _ in range(NEWTON_STEPS):
            state = spark.sparkContext.broadcast((wt, wm, teacher))

            def gather(frames, state=state):
                wt, wm, teacher = state.value
                sums = [np.zeros((n, n)) for n in (N_TEXT, N_META)] + [np.zeros(n) for n in (N_TEXT, N_META)]
                for pdf in frames:
                    if not len(pdf):
                        continue
                    xs = _read(pdf["content"], N_TEXT), _read(pdf["meta"], N_META)
                    y = pdf["quality"].to_numpy(np.float64, na_value=np.nan)
                    known = ~np.isnan(y)
                    guess = [probability(x, w) for x, w in zip(xs, teacher)] if teacher else None
                    for v, (x, w) in enumerate(zip(xs, (wt, wm))):
                        target, weight = np.where(known, y, 0.0), known.astype(np.float64)
                        if guess is not None:  # the other view teaches
                            g = guess[1 - v]
                            sure = ~known & ((g < CONFIDENT) | (g > 1 - CONFIDENT))
                            target, weight = np.where(sure, (g > 0.5).astype(float), target), np.where(sure, PSEUDO_WEIGHT, weight)
                        p = probability(x, w)
                        sums[v] += x.T @ (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None])
                        sums[2 + v] += x.T @ (weight * (target - p))
                yield pd.DataFrame({"block": [0], "payload": [X.pack(*(s.ravel() for s in sums))]})

            def add(pdf):
                return pd.DataFrame({"block": [0], "payload": [X.pack(*[sum(s) for s in zip(*(X.unpack(p) for p in pdf["payload"]))])]})

            got = X.merged(table.where("NOT calib").mapInPandas(gather, "block int, payload binary"), add).first()
            state.unpersist()
            if got is None:
                return wt, wm
            ht, hm, gt, gm = X.unpack(got["payload"])
            wt = wt + _step(ht.reshape(N_TEXT, N_TEXT), gt, wt)
            wm = wm + _step(hm.reshape(N_META, N_META), gm, wm)
        teacher = (wt.copy(), wm.copy())
    return wt, wm


def _step(h: np.ndarray, g: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    step = np.linalg.solve(h + ridge * np.eye(len(w)), g - ridge * w)
    size = np.abs(step).max()
    return step if size < 5 else step * 5 / size


def _calibrated(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic weights of log-odds columns (first weight: intercept)."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.r_[0.0, np.ones(x.shape[1] - 1) / max(1, x.shape[1] - 1)]
    for _ in range(25):
        p = probability(x, w)
        w = w + _step(x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None]), x.T @ (y - p), w, 0.1)
    return w


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> dict | None:
    """The model: both views' weights and their calibration; None without labels of both kinds."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("double").alias("quality"))
    kinds = {r["quality"] for r in known.select("quality").distinct().limit(3).collect()}
    if len(kinds & {0.0, 1.0}) < 2:
        return None
    calib = F.col("quality").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    table = X.written(features(docs).join(known, "doc_id", "left").withColumn("calib", F.coalesce(calib, F.lit(False))), "views")
    wt, wm = fit_views(table, rounds)

    def odds(frames):
        for pdf in frames:
            if len(pdf):
                yield pd.DataFrame({"t": _read(pdf["content"], N_TEXT) @ wt, "m": _read(pdf["meta"], N_META) @ wm, "y": pdf["quality"].astype(float)})

    def logits(rows):
        return np.array([tuple(r) for r in rows]).reshape(-1, 3)

    held = table.where("calib").orderBy(F.xxhash64("doc_id")).limit(CALIBRATION_ROWS)
    xy = logits(held.mapInPandas(odds, "t double, m double, y double").collect())
    if len(set(xy[:, 2])) < 2:  # too few labels for a held-out part: calibrate on the fitted rows
        xy = logits(table.where("quality IS NOT NULL").limit(CALIBRATION_ROWS).mapInPandas(odds, "t double, m double, y double").collect())
    z, y = np.clip(xy[:, :2], -20, 20), xy[:, 2]
    return {"wt": wt, "wm": wm, "t": _calibrated(z[:, :1], y), "m": _calibrated(z[:, 1:], y), "both": _calibrated(z, y)}


def scores(model: dict, pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Calibrated content, metadata and combined probabilities of good quality."""
    xt, xm = _matrices(pdf)
    z = np.clip(np.column_stack([xt @ model["wt"], xm @ model["wm"]]).reshape(-1, 2), -20, 20)
    one = np.ones((len(z), 1))
    return (probability(np.hstack([one, z[:, :1]]), model["t"]), probability(np.hstack([one, z[:, 1:]]), model["m"]),
            probability(np.hstack([one, z]), model["both"]))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, score_content, score_meta, score (combined) and keep."""
    model = train(docs, labels)
    if model is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.lit(1.0).alias(c) for c in ("score_content", "score_meta", "score")], F.lit(True).alias("keep"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames):
        for pdf in frames:
            t, m, b = scores(shared.value, pdf)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score_content": t, "score_meta": m, "score": b, "keep": b >= threshold})

    return _inputs(docs).mapInPandas(run, "doc_id long, score_content double, score_meta double, score double, keep boolean")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they were."""
    model = train(docs, labels)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.Series:
        pdf = pd.DataFrame({"text": text, "lang": lang, "source": source, "n_chars": n_chars})
        return pd.Series(scores(shared.value, pdf)[2] >= threshold)

    have = set(docs.columns)
    col = lambda c, t: (F.col(c) if c in have else F.lit(None)).cast(t)
    return docs.where(good(col("text", "string"), col("lang", "string"), col("source", "string"), col("n_chars", "double")))
