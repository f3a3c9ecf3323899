"""Alignment of two vocabularies against whole-text tokenisation and brute force over byte ranges."""

import bisect
import functools
import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tests.llm.data import documents, empty_documents
from triad.llm.op12_alignment import Vocabularies, alignment, cut_pattern, shared_cuts
from triad.llm.queries import vocabulary_path

A, B = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")


@functools.cache
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), Vocabularies(A, B)


def whole(text):
    """[(id, bytes)] of both vocabularies, each from one call over the whole text."""
    a, b, known = tokenizers()
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    return [(i, known.a_bytes[i]) for i in x], [(i, known.b_bytes[i]) for i in y]


def spans(tokens):
    at, out = 0, []
    for i, b in tokens:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def brute(rows):
    links, out = [], []
    for doc_id, text in rows:
        a, b = whole(text) if text else ([], [])
        want = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
            links.append(Counter())
            out.append((doc_id, 0, 0, 0, ""))
            continue
        a, b = spans(a), spans(b)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        side_a, side_b = defaultdict(list), defaultdict(list)
        for side, tokens in ((side_a, a), (side_b, b)):
            for i, s, e in tokens:
                side[cuts[bisect.bisect_left(cuts, e)]].append(str(i))
        groups = [",".join(side_a[c]) + "|" + ",".join(side_b[c]) for c in cuts]
        mine, j = Counter(), 0
        for i, s, e in a:
            while j and b[j - 1][2] > s:
                j -= 1
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                mine[i, b[k][0]] += 1
                k += 1
        links.append(mine)
        out.append((doc_id, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    total = Counter(p for m in links for p in m)
    most = defaultdict(int)
    for (a, _), n in total.items():
        most[a] = max(most[a], n)
    return sorted(((d, na, nb, ng, sum(m.values()), sum(t for p, t in m.items() if total[p] == most[p[0]]),
                    sum(t * total[p] for p, t in m.items()), sha) for (d, na, nb, ng, sha), m in zip(out, links)), key=str)


def result(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect()), key=str)


def test_shared_cuts_are_all_common_ends():
    rng = random.Random(2)
    for n in list(range(1, 40)) + [5000]:
        a = sorted(rng.sample(range(1, 3 * n + 1), n) + [3 * n + 5])
        b = sorted(rng.sample(range(1, 3 * n + 1), rng.randrange(1, n + 1)) + [3 * n + 5])
        want = sorted(set(a) & set(b))
        assert shared_cuts(a, b) == [(a.index(c) + 1, b.index(c) + 1) for c in want]


def test_places_need_a_vocabulary_that_splits_there():
    assert cut_pattern(["▁a", "▁▁", "b", "<0x0A>", "...", "▁."]).count("|") >= 2
    assert cut_pattern(["▁a", "of▁the", "x\ny"]) == ""
    assert "A-Z" not in cut_pattern(["etc.", "▁a"]) and " " in cut_pattern(["etc.", "▁a"])


def texts():
    rng = random.Random(4)
    bits = ["Hello", "world", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "　", "é", "naïve", "日本語", "😀", "don't", "it's", "<|endoftext|>",
            "<s>", "</s>", "<0x0A>", "▁", "123", "...", "\x00", "\x1c", "end.", "Yes!? ", ".", "a,", "é.", "2.", "\x85", "​", "x" * 30, "é", " ", " a", "ing ", ".\nThe", "'", "﻿"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    return out + ["", None, " ", "\n", "a", " a", "a ", "the of and " * 50, "the of and " * 50, "x" * 20_000, "日本" * 3000, "w " * 9000]


def test_alignment_against_brute_force(spark):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts())] + [(7, "the same"), (7, "the same"), (8, "the other")]
    df = spark.createDataFrame([(i, t, "c", 1, "p") for i, t in rows], "doc_id long, text string, chunk string, n long, pairs string").repartition(5)
    assert result(alignment(df, A, B, chunk_bytes=3000)) == brute(rows)


def test_hard_rows_and_no_rows(spark):
    docs = documents(spark)
    assert result(alignment(docs, A, B)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert alignment(empty_documents(spark), A, B).collect() == []


@pytest.mark.parametrize("kept", [1, 50])
def test_a_worker_that_forgets_gives_the_same(kept):
    from triad.llm.op12_alignment import Aligner

    some = [t for t in texts() if t][:120]
    small, large = Aligner(A, B, kept), Aligner(A, B)
    for lo in range(0, 120, 10):
        for x, y in zip(small.align(some[lo:lo + 10]), large.align(some[lo:lo + 10])):
            assert x[1] == y[1] and x[2].tolist() == y[2].tolist() and x[3].tolist() == y[3].tolist()
