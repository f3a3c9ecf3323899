"""Cross-tokenizer alignment: groups of tokens between the byte offsets where tokens of both vocabularies end.

The ends of both token sequences are cut by divide and conquer: from the middle of one sequence the nearest end that the
other one shares is located by bisect, both halves are cut again, and an interval without a shared end is a leaf group.
Some places are shared cuts in any text, as before a single blank between two other characters (``cut_pattern`` checks this for the
piece vocabulary; the byte-level one splits there by its pattern). Texts are cut there first, each
worker tokenises and aligns a distinct unit once, and a text is put together from its units.

The corpus-wide count of an id pair (documents that hold it linked) needs a meeting of all documents. A chunk is a bounded
run of documents of one task; a chunk's distinct pairs and their document counts are exploded to rows (partial
aggregation first), added up for each pair, and sent back to the chunks that hold the pair, where the documents take
their sums. A pair that every document holds is one row a chunk. The highest count of each A id is a table of at most the
vocabulary's size.

Cases: a null or empty text, and a text whose joined tokens of either side are not blank + text, has no tokens: zeros, and '' as
hash. Special tokens' strings are plain text. Repeated and null doc_ids are separate documents, one row each. Very long texts
and texts without blanks are whole (one unit may be a whole text). An empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm import exchange as X

#: Bytes of text in a chunk (a longer text is a chunk with others of its batch), and texts worked on at once.
CHUNK_BYTES, TEXTS_AT_ONCE = 16 << 20, 256
#: Units a worker remembers, and bytes of their groups; beyond either it keeps those that came again, half of the room at most.
UNITS_KEPT, GROUP_BYTES_KEPT = 500_000, 64 << 20

DOC = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
       "pairs array<long>, times array<int>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def shared_cuts(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Ascending (tokens of ``a``, tokens of ``b``) up to each offset where both end; ``a`` and ``b`` are ascending ends with the same last."""
    out, stack = [], [(0, len(a), 0, len(b))]
    while stack:
        alo, ahi, blo, bhi = stack.pop()
        # ends inside the interval: its own last end is a cut already
        last, stop = ahi - 2, bhi - 1
        found = -1
        if blo < stop:
            left = (alo + last) // 2
            right = left + 1
            while left >= alo or right <= last:
                if left >= alo:
                    j = bisect_left(b, a[left], blo, stop)
                    if j < stop and b[j] == a[left]:
                        found = left
                        break
                    left -= 1
                if right <= last:
                    j = bisect_left(b, a[right], blo, stop)
                    if j < stop and b[j] == a[right]:
                        found = right
                        break
                    right += 1
        if found < 0:
            out.append((ahi, bhi))
        else:
            stack.append((found + 1, ahi, j + 1, bhi))
            stack.append((alo, found + 1, blo, j + 1))
    return out


def overlaps(a: list[int], b: list[int], alo: int, ahi: int, blo: int, bhi: int):
    """Index pairs of tokens with overlapping byte ranges in a group; empty tokens do not occur."""
    i, j = alo, blo
    while i < ahi and j < bhi:
        yield i, j
        if a[i] == b[j]:
            i, j = i + 1, j + 1
        elif a[i] < b[j]:
            i += 1
        else:
            j += 1


class Vocabularies:
    """Both tokenizers of a worker and the bytes of their tokens."""

    def __init__(self, byte_level: str, pieces: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letter = self._letters(ByteLevel.alphabet())
        self.a_bytes = [b"".join(letter.get(c, c.encode()) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())]
        self.b_bytes = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        pattern = cut_pattern([self.b.id_to_piece(i) for i in range(self.b.get_piece_size())])
        self.cut = re.compile(pattern) if pattern else None

    @staticmethod
    def _letters(alphabet: list[str]) -> dict[str, bytes]:
        """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes for 256, 257, ..."""
        own = {c: bytes([ord(c)]) for c in alphabet if ord(c) < 256}
        rest = sorted(c for c in alphabet if ord(c) >= 256)
        missing = sorted(set(range(256)) - {v[0] for v in own.values()})
        return own | {c: bytes([b]) for c, b in zip(rest, missing)}

    @staticmethod
    def _piece(piece: str) -> bytes:
        if re.fullmatch(r"<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def units(self, text: str) -> list[str]:
        """Units of blank + text."""
        return self.cut.split(" " + text) if self.cut else [" " + text]

    def tokenised(self, units: list[str]):
        """(A ids, B ids) of each unit."""
        a = self.a.encode_batch_fast(units, add_special_tokens=False)
        # the piece vocabulary puts a blank before what it is given; behind a line feed that blank joins nothing
        b = self.b.encode([u[1:] if u[0] == " " else u if u[0] == "\n" else "\n" + u for u in units], num_threads=1)
        for u, x, y in zip(units, a, b):
            if u[0] != " ":
                y = y[1:] if u[0] == "\n" else y[2:]
            yield x.ids, y


def pair_shift(pieces: str) -> int:
    """Bits of a B id in an id pair."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size().bit_length()


def cut_pattern(pieces: list[str]) -> str:
    """Where units begin, as a regular expression of empty matches: before a single blank or line feed between two other
    characters, and before closing marks behind an ASCII letter. Each only if no piece of the vocabulary reaches across."""
    places = []
    if not any(re.search("[^▁]▁", p) for p in pieces):
        places.append(r"(?<=\S)(?= \S)")
    if not any("\n" in p for p in pieces):  # units that begin with other than a blank are tokenised behind a line feed
        places.append(r"(?<=\S)(?=\n\S)")
        if not any(re.search("[A-Za-z][.,;:!?]", p) for p in pieces):
            places.append(r"(?<=[A-Za-z])(?=[.,;:!?]+(?:\s|\Z))")
    return "|".join(places)


class Growing:
    """An array that grows at its end; ``data[:n]`` is filled."""

    def __init__(self, data: np.ndarray):
        self.data, self.n = data, 0

    def add(self, more: np.ndarray) -> None:
        need = self.n + len(more)
        if need > len(self.data):
            grown = np.empty((max(need, 2 * len(self.data)), *self.data.shape[1:]), self.data.dtype)
            grown[:self.n] = self.data[:self.n]
            self.data = grown
        self.data[self.n:need] = more
        self.n = need


class Aligner:
    """Aligned units, remembered in a worker: per unit its counts, the text of its groups and its linked id pairs."""

    def __init__(self, byte_level: str, pieces: str, kept: int = UNITS_KEPT):
        self.vocabularies, self.kept = Vocabularies(byte_level, pieces), kept
        self.shift = len(self.vocabularies.b_bytes).bit_length()
        self.a_length, self.b_length = ([len(t) for t in side] for side in (self.vocabularies.a_bytes, self.vocabularies.b_bytes))
        self.shown_id = [str(i) for i in range(max(len(self.a_length), len(self.b_length)))]
        self.units, self.groups = [], []
        self.forget()

    def forget(self, keep: int = 0) -> None:
        """Start afresh with ``keep`` units at most: the ones met most often, and more than once."""
        old, at = (self.units, self.groups), np.empty(0, np.int64)
        if keep:
            hits = self.hits.data[:self.hits.n]
            at = np.sort(np.argsort(-hits, kind="stable")[:min(keep, int((hits > 1).sum()))])
            lo = self.pair_end.data[at]
            size = self.pair_end.data[at + 1] - lo
            ends = np.cumsum(size)
            take = np.arange(size.sum()) + np.repeat(lo - (ends - size), size)
            have = (self.counts.data[at], hits[at] // 2, ends, self.pairs.data[take], self.times.data[take])
        self.counts = Growing(np.empty((1024, 4), np.int64))  # tokens of A (-1: bytes differ), of B, groups, links
        self.hits, self.pair_end, self.pairs, self.times = (Growing(np.empty(4096, np.int64)) for _ in range(4))
        self.pair_end.add(np.zeros(1, np.int64))
        self.units: list[str] = [old[0][i] for i in at.tolist()]
        self.groups: list[bytes] = [old[1][i] for i in at.tolist()]
        self.index: dict[str, int] = dict(zip(self.units, range(len(at))))
        self.group_bytes = sum(map(len, self.groups))
        if len(at):
            for part, data in zip((self.counts, self.hits, self.pair_end, self.pairs, self.times), have):
                part.add(data)

    def learn(self, units: list[str]) -> None:
        v, shift = self.vocabularies, self.shift
        a_bytes, b_bytes = v.a_bytes.__getitem__, v.b_bytes.__getitem__
        a_length, b_length, shown_id = self.a_length.__getitem__, self.b_length.__getitem__, self.shown_id.__getitem__
        at, counts, sizes, pairs, times = len(self.groups), [], [], [], []
        for unit, (ids_a, ids_b) in zip(units, v.tokenised(units)):
            text = unit.encode("utf-8", "replace")
            if b"".join(map(a_bytes, ids_a)) != text or b"".join(map(b_bytes, ids_b)) != text:
                counts.append((-1, 0, 0, 0))
                sizes.append(0)
                self.groups.append(b"")
                continue
            a, b = list(accumulate(map(a_length, ids_a))), list(accumulate(map(b_length, ids_b)))
            alo = blo = 0
            linked, shown = [], []
            for ahi, bhi in shared_cuts(a, b):
                shown.append(",".join(map(shown_id, ids_a[alo:ahi])) + "|" + ",".join(map(shown_id, ids_b[blo:bhi])))
                if ahi - alo == 1:  # one token of a side overlaps all of the other
                    high = ids_a[alo] << shift
                    linked += [high | y for y in ids_b[blo:bhi]]
                elif bhi - blo == 1:
                    linked += [x << shift | ids_b[blo] for x in ids_a[alo:ahi]]
                else:
                    linked += [ids_a[i] << shift | ids_b[j] for i, j in overlaps(a, b, alo, ahi, blo, bhi)]
                alo, blo = ahi, bhi
            once = set(linked)
            if len(once) == len(linked):
                pairs += linked
                times += [1] * len(linked)
            else:
                many = Counter(linked)
                pairs += many.keys()
                times += many.values()
            counts.append((len(ids_a), len(ids_b), len(shown), len(linked)))
            sizes.append(len(once))
            self.groups.append(";".join(shown).encode())
        self.group_bytes += sum(map(len, self.groups[at:]))
        self.units += units
        self.index.update(zip(units, range(at, len(self.groups))))
        self.hits.add(np.zeros(len(units), np.int64))
        self.counts.add(np.array(counts, np.int64).reshape(-1, 4))
        self.pair_end.add(self.pairs.n + np.cumsum(sizes, dtype=np.int64))
        self.pairs.add(np.array(pairs, np.int64))
        self.times.add(np.array(times, np.int64))

    def align(self, texts: list):
        """Yield (counts or None, hash, distinct pairs, links of each pair) for each text."""
        split = [self.vocabularies.units(t) if isinstance(t, str) and t else [] for t in texts]
        new = set().union(*split).difference(self.index)
        if len(self.index) + len(new) > self.kept or self.group_bytes > GROUP_BYTES_KEPT:
            self.forget(self.kept // 2 if self.group_bytes <= GROUP_BYTES_KEPT else 0)
            new = set().union(*split).difference(self.index)
        if new:
            self.learn(list(new))
        none = np.empty(0, np.int64)
        for units in split:
            at = np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))
            counts = self.counts.data[at]
            if not len(at) or (counts[:, 0] < 0).any():
                yield None, "", none, none
                continue
            unit, n = np.unique(at, return_counts=True)
            self.hits.data[unit] += n
            lo = self.pair_end.data[unit]
            size = self.pair_end.data[unit + 1] - lo
            ends = np.cumsum(size)
            take = np.arange(ends[-1]) + np.repeat(lo - (ends - size), size)
            pairs, where = np.unique(self.pairs.data[take], return_inverse=True)
            times = np.bincount(where, self.times.data[take] * np.repeat(n, size)).astype(np.int64)
            yield counts.sum(axis=0), hashlib.sha256(b";".join([self.groups[i] for i in at.tolist()])).hexdigest(), pairs, times

_worker: dict = {}


def worker_aligner(byte_level: str, pieces: str) -> Aligner:
    if _worker.get("key") != (byte_level, pieces):
        _worker.update(key=(byte_level, pieces), aligner=Aligner(byte_level, pieces))
    return _worker["aligner"]


def aligned_documents(docs: DataFrame, byte_level: str, pieces: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: its counts, hash, distinct linked pairs with their links, and its chunk."""
    def align(frames):
        aligner = worker_aligner(byte_level, pieces)
        task, part, held = TaskContext.get().partitionId(), 0, 0
        for pdf in frames:
            for lo in range(0, len(pdf), TEXTS_AT_ONCE):
                batch = pdf.iloc[lo:lo + TEXTS_AT_ONCE]
                texts = batch["text"].tolist()
                rows = []
                for doc_id, (counts, sha, pairs, times) in zip(batch["doc_id"], aligner.align(texts)):
                    n = (0, 0, 0, 0) if counts is None else counts.tolist()
                    rows.append((task << 32 | part, None if pd.isna(doc_id) else int(doc_id), *n, sha, pairs.astype(np.int32), times.astype(np.int32)))
                held += sum(len(t) for t in texts if isinstance(t, str))
                if held >= chunk_bytes:
                    part, held = part + 1, 0
                out = X.frame(rows, "chunk,doc_id,n_a,n_b,n_groups,n_links,groups_sha256,pairs,times")
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(align, DOC)


def pair_counts(held: DataFrame, shift: int) -> DataFrame:
    """(pair, total, best): documents corpus-wide that hold a pair linked, and whether that is its A id's highest."""
    total = held.groupBy("pair").agg(F.sum("n").alias("total"))
    highest = total.groupBy(F.shiftright("pair", shift).alias("a")).agg(F.max("total").alias("most"))
    # one row an A id: bounded by the vocabulary
    return total.join(F.broadcast(highest), F.shiftright("pair", shift) == F.col("a")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, byte_level: str, pieces: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (see the module's text)."""
    aligned = X.written(aligned_documents(docs, byte_level, pieces, chunk_bytes), "aligned")
    held = aligned.select(F.col("chunk").alias("holder"), F.explode("pairs").alias("pair")).groupBy("holder", "pair").agg(F.count(F.lit(1)).alias("n"))
    # ``n`` goes along so that both uses of ``held`` share one exchange
    back = held.join(pair_counts(held, pair_shift(pieces)), "pair")

    def add(key, rows, answers):
        out = rows[["doc_id", "n_a", "n_b", "n_groups", "n_links"]].copy()
        out["doc_id"] = out["doc_id"].astype("Int64")
        known, total, best = (answers[c].to_numpy() for c in ("pair", "total", "best"))
        order = np.argsort(known)
        known, total, best = known[order], total[order], best[order]
        ends = np.concatenate([[0], np.cumsum([len(p) for p in rows["pairs"]], dtype=np.int64)])
        n_best, count_sum = np.zeros(ends[-1] + 1, np.int64), np.zeros(ends[-1] + 1, np.int64)
        if ends[-1]:
            at = np.searchsorted(known, np.concatenate(rows["pairs"].to_list()))
            times = np.concatenate(rows["times"].to_list()).astype(np.int64)
            np.cumsum(times * best[at], out=n_best[1:])
            np.cumsum(times * total[at], out=count_sum[1:])
        out["n_best"], out["count_sum"] = n_best[ends[1:]] - n_best[ends[:-1]], count_sum[ends[1:]] - count_sum[ends[:-1]]
        out["groups_sha256"] = rows["groups_sha256"]
        return out

    return aligned.groupBy("chunk").cogroup(back.groupBy("holder")).applyInPandas(add, RESULT)
