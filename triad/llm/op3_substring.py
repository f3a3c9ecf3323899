"""Substring dedup with a count-min prefilter.

Pass 1: every chunk sketches its windows of 20 words; the merged sketch overestimates each window's count. Pass 2:
only windows estimated to occur twice or more are grouped exactly, by a 128-bit fingerprint of their word sequence.
A window that occurs twice is estimated so in every row of the sketch, so none is lost.

Cases: a null or empty text has no words (n_words 0, hash of the empty text). Documents of fewer than ``window``
words have no window. Repeated doc_ids are ordered by text; equal rows keep the order they are read in within the
chunk. A null doc_id counts as smaller than any other, and ties between such rows go to the smaller chunk. Columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from triad.llm import exchange as X
from triad.llm.text import Words, batches, encoded

WINDOW = 20
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["doc_id", "text"], na_position="first", kind="stable")


def _ids(pdf: pd.DataFrame) -> np.ndarray:
    low = np.iinfo(np.int64).min
    return np.array([low if pd.isna(x) else int(x) for x in pdf["doc_id"]], np.int64)


def _windows(raw: list[bytes], window: int):
    """(first hash, second hash, text index, start) of all windows, in reading order."""
    parts = []
    for a, b in batches(raw):
        w = Words(raw[a:b])
        h, at = w.shingles(window)
        g, _ = w.shingles(window, 1)
        parts.append((h, g, w.doc[at] + a, at - w.bounds[w.doc[at]]))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(4))


def repeated_words(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Remove each word covered by a window whose word sequence starts earlier as well (smaller doc_id, or the same
    document and an earlier start). With ``with_text`` the kept text is returned too."""
    chunks = X.Chunks(docs)
    blocks = chunks.blocks()

    def sketch(key, pdf):
        h, _, _, _ = _windows(encoded(pdf["text"]), window)
        keys, n = np.unique(h, return_counts=True)
        return X.frame(X.sketch_messages(key[0], keys, np.minimum(n, X.CAP), blocks), X.MESSAGE)

    def candidates(key, pdf, answers):
        """First occurrences in the chunk of windows estimated repeated, to the block that groups them."""
        if not len(pdf):
            return X.frame([], X.MESSAGE)
        pdf = _ordered(pdf)
        ids = _ids(pdf)
        h, g, doc, _ = _windows(encoded(pdf["text"]), window)
        maybe = np.flatnonzero(X.estimates(answers, h, blocks) >= 2)
        h, g, doc = h[maybe], g[maybe], doc[maybe]
        order = np.lexsort((np.arange(len(h)), g, h))
        h, g, doc = h[order], g[order], doc[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        h, g, own = h[first], g[first], ids[doc[first]]
        rows = [(key[0], b, X.pack(k, s, d)) for b, k, s, d in X.split_blocks(h, (h % np.uint64(blocks)).astype(np.int64), g, own)]
        return X.frame(rows, X.MESSAGE)

    def owners(pdf):
        """Exact groups: tell each chunk which of its windows start earlier in another chunk."""
        got = [X.unpack(p) for p in pdf["payload"]]
        n = [len(x[0]) for x in got]
        h, g, d = (np.concatenate([x[i] for x in got]) for i in range(3))
        c = np.repeat(pdf["chunk"].to_numpy(), n)
        order = np.lexsort((c, d, g, h))
        hs, gs = h[order], g[order]
        later = np.zeros(len(h), bool)
        later[order[1:]] = (hs[1:] == hs[:-1]) & (gs[1:] == gs[:-1])
        rows, at = [], 0
        for chunk, block, size in zip(pdf["chunk"], pdf["block"], n):
            keep = later[at:at + size]
            if keep.any():
                rows.append((chunk, block, X.pack(h[at:at + size][keep], g[at:at + size][keep])))
            at += size
        return X.frame(rows, X.MESSAGE)

    def cut(key, pdf, answers):
        if not len(pdf):
            return X.frame([], schema)
        pdf = _ordered(pdf)
        raw = encoded(pdf["text"])
        h, g, doc, start = _windows(raw, window)
        got = [X.unpack(p) for p in answers["payload"]]
        eh = np.concatenate([x[0] for x in got]) if got else np.empty(0, np.uint64)
        eg = np.concatenate([x[1] for x in got]) if got else np.empty(0, np.uint64)
        # earlier in another chunk, or earlier in this one
        order = np.lexsort((np.arange(len(h)), g, h))
        later = np.zeros(len(h), bool)
        if len(h):
            hs, gs = h[order], g[order]
            later[order[1:]] = (hs[1:] == hs[:-1]) & (gs[1:] == gs[:-1])
            if len(eh):
                maybe = np.flatnonzero(np.isin(h, eh))
                all_h, all_g = np.concatenate([eh, h[maybe]]), np.concatenate([eg, g[maybe]])
                both = np.lexsort((np.arange(len(all_h)), all_g, all_h))
                head = np.ones(len(both), bool)
                head[1:] = (all_h[both][1:] != all_h[both][:-1]) | (all_g[both][1:] != all_g[both][:-1])
                told = np.maximum.accumulate(np.where(head, np.arange(len(both)), 0))
                known = both[told] < len(eh)  # the group's first entry came from outside
                back = np.empty(len(both), bool)
                back[both] = known
                later[maybe] |= back[len(eh):]
        rows, at = [], np.searchsorted(doc, np.arange(len(raw) + 1))
        for i, (doc_id, text) in enumerate(zip(pdf["doc_id"], raw)):
            words = text.split()
            gone = np.zeros(len(words) + 1, np.int64)
            starts = start[at[i]:at[i + 1]][later[at[i]:at[i + 1]]]
            np.add.at(gone, starts, 1)
            np.add.at(gone, np.minimum(starts + window, len(words)), -1)
            removed = np.cumsum(gone[:-1]) > 0 if len(words) else np.zeros(0, bool)
            kept = b" ".join([w for w, r in zip(words, removed) if not r]) if removed.any() else b" ".join(words)
            row = (None if pd.isna(doc_id) else int(doc_id), len(words), int(removed.sum()), hashlib.sha256(kept).hexdigest())
            rows.append(row + (kept.decode(),) if with_text else row)
        out = X.frame(rows, schema)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    schema = RESULT + (", kept_text string" if with_text else "")
    counts = X.sketch_answers(chunks.send(sketch))
    groups = chunks.meet(counts, candidates, X.MESSAGE)
    later = groups.groupBy("block").applyInPandas(owners, X.MESSAGE)
    return chunks.meet(later, cut, schema)
