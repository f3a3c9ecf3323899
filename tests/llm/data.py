"""Small hand-made tables with the hard cases: nulls, empty and very long texts, ties, repeated rows, clashing names."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, chunk string, rid string, block string, component string"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" + "xyz"[rng.randrange(3)] for _ in range(n)]


def hard_texts(seed=1):
    rng = random.Random(seed)
    base = words(rng, 120)
    passage = " ".join(words(rng, 55))
    near = [list(base) for _ in range(12)]
    for i, w in enumerate(near):
        if i:
            w[10 * (i % 11)] = f"edit{i}"
    texts = [" ".join(w) for w in near]
    texts += [" ".join(base)] * 3 + [None, "", "   \n\t ", "one", "One two", "a b c", "A B C"]
    texts += [" ".join(words(rng, 40)) + "\n" + passage + "\n" + " ".join(words(rng, 30)) for _ in range(5)]
    texts += [" ".join(words(rng, 30_000, 3000)), "é" * 50_000, "loop " * 500, "x" * 200_000]
    texts += ["\n".join(" ".join(words(rng, rng.randrange(1, 25))) for _ in range(6)) for _ in range(30)]
    texts += ["tab\tand\x0bfeed\x0c end\r\n  nbsp stays   here"] * 2
    return texts


def hard_rows(seed=1):
    rows = []
    for i, t in enumerate(hard_texts(seed)):
        rows.append((i * 3 + 1, t, ("en", "fr", None)[i % 3], "src0" if i % 3 else f"s{i}", None if i % 5 == 0 else len(t or ""), "c", "r", "b", "k"))
    return rows


def documents(spark, seed=1, repeat=True, null_id=True):
    rows = hard_rows(seed)
    if repeat:
        rows += [rows[0], rows[15]]
    if null_id:
        rows += [(None, rows[3][1], "en", "s", 1, "c", "r", "b", "k"), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def empty_documents(spark):
    return spark.createDataFrame([], COLUMNS)


def split(text):
    return (text or "").encode("utf-8", "replace").split()
