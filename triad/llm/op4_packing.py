"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed length.

Texts are tokenised in tasks. Tokenising is local to words (the vocabulary drops white space and never joins across
it), so each distinct word is tokenised once per worker and looked up afterwards. Whole-length pieces are sequences by
themselves; the rest are dealt evenly by a hash to tasks of about ``group`` pieces, each packed longest first into the
tightest open sequence, found in a segment tree over remaining capacities. A task leaves at most a few
sequences open, so dealing costs little beside one global run.

Cases: a null or empty text is the closing id alone. Documents longer than ``length`` are cut into pieces. Rows with
repeated or null doc_ids are packed as separate documents. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 2048
#: Pieces that one task packs, on average.
GROUP = 20_000
#: Distinct words that a worker remembers; beyond them it starts afresh.
WORDS_KEPT = 1_200_000
#: Texts whose new words are tokenised in one call.
TEXTS_AT_ONCE = 32
_MARKS = b".,;:!?"

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class CapacityTree:
    """A segment tree over remaining capacities 0..limit; each leaf holds the open sequences of that capacity."""

    def __init__(self, limit: int):
        self.size = 1 << limit.bit_length()
        self.count = [0] * (2 * self.size)
        self.open = [[] for _ in range(limit + 1)]

    def _add(self, capacity: int, change: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += change
            i >>= 1

    def put(self, capacity: int, sequence: int) -> None:
        if capacity:
            self.open[capacity].append(sequence)
            self._add(capacity, 1)

    def tightest(self, need: int) -> int | None:
        """Smallest capacity of at least ``need`` with an open sequence: climb to a right subtree that has one, go down left."""
        i = need + self.size
        if not self.count[i]:
            while True:
                while i & 1:
                    i >>= 1
                if i <= 1:
                    return None
                i += 1
                if self.count[i]:
                    break
                i -= 1
                i >>= 1
                if not i:
                    return None
        while i < self.size:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.size

    def take(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.open[capacity].pop()


def best_fit(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, longest first into the tightest open sequence."""
    tree, sequences = CapacityTree(limit), 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        room = tree.tightest(need)
        if room is None:
            where[i], offset[i], room = sequences, 0, limit
            sequences += 1
        else:
            where[i] = tree.take(room)
            offset[i] = limit - room
        tree.put(room - need, int(where[i]))
    return where, offset


_worker: dict = {}


def _ids(vocabulary: str):
    """bytes -> little-endian ids of a word, remembered in this worker."""
    if _worker.get("path") != vocabulary:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _worker.update(path=vocabulary, tokenizer=Tokenizer.from_file(vocabulary), known={})
    return _worker["tokenizer"], _worker["known"]


def learn(words: set, vocabulary: str) -> None:
    """Remember the ids of new words. A word's closing marks after an ASCII letter or digit are a piece of their own to the
    tokenizer, and it lower-cases, so only the bare lower-cased word and the marks are tokenised. A word that may hold a
    special token is tokenised as it stands: those are looked for before lower-casing."""
    tokenizer, known = _ids(vocabulary)
    parts, new = {}, set()
    for w in words:
        bare = w.rstrip(_MARKS).lower()
        if b"<|" in w:
            parts[w] = (w,)
        elif len(bare) < len(w) and bare[-1:].isalnum():
            parts[w] = (bare, w[len(bare):])
        else:
            parts[w] = (w.lower(),)
        new.update(p for p in parts[w] if p not in known)
    new = list(new)
    for w, e in zip(new, tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)):
        known[w] = array("I", e.ids).tobytes()
    for w, p in parts.items():
        if w not in known:
            known[w] = known[p[0]] + known[p[1]] if len(p) == 2 else known[p[0]]


def tokenised(texts: list, vocabulary: str):
    """Ids of each whole text and the closing id 0, as little-endian unsigned 32-bit numbers."""
    _, known = _ids(vocabulary)
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        split = [(t.encode("utf-8", "replace") if isinstance(t, str) else b"").split() for t in texts[at:at + TEXTS_AT_ONCE]]
        words = set().union(*split)
        new = words.difference(known)
        if len(known) + 2 * len(new) > WORDS_KEPT:
            known.clear()
            new = words
        if new:
            learn(new, vocabulary)
        for ws in split:
            yield b"".join(map(known.__getitem__, ws)) + b"\0\0\0\0"


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """One row per piece of each document's ids."""
    def cut(frames):
        for pdf in frames:
            rows = []
            for doc_id, ids in zip(pdf["doc_id"], tokenised(pdf["text"].tolist(), vocabulary)):
                doc = None if pd.isna(doc_id) else int(doc_id)
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    body = ids[at:at + 4 * length]
                    crc = zlib.crc32(body)
                    rows.append((doc, k, at // 4, len(body) // 4, crc, crc ^ zlib.crc32(f"{doc}:{k}".encode()) << 8))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "deal"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(cut, PIECE)


def packed(docs: DataFrame, vocabulary: str, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """One row per piece with its place: sequence_id and gapless offset. Sequence ids are distinct across groups."""
    from triad.llm.exchange import written

    cut = written(pieces(docs, vocabulary, length), "pieces")  # tokenised once, then counted and packed
    groups = max(1, -(-cut.where(F.col("length") < length).count() // group))
    whole = F.col("length") == length
    # whole pieces need no packing; they are only dealt along to be numbered
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("deal", "piece"), F.lit(groups)).cast("long"))

    def fill(key, pdf):
        where, offset = best_fit(pdf["length"].to_numpy(), length)
        out = pdf[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
        out["doc_id"] = out["doc_id"].astype("Int64")
        out["sequence_id"], out["offset"] = where * groups + int(key[0]), offset
        return out

    rest = dealt.where(~whole).groupBy("group").applyInPandas(fill, PACKED)
    # whole pieces are numbered below zero
    alone = cut.where(whole).select("doc_id", "piece", "start", "length", "ids_crc32",
                                    (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return rest.unionByName(alone)
