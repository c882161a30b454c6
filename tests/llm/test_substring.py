"""Repeated passages against brute force, with small windows and small groups."""

import hashlib
import random
import re

import pytest

from fundspark.llm import substring_dedup as D

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window):
    """(key, n_words, n_removed, digest) by the definition: windows that start in a document of a smaller key."""
    parts = [(k, WORD.findall(t or "")) for k, t in rows]
    first = {}
    for k, w in parts:
        if k is not None:
            for i in range(len(w) - window + 1):
                x = tuple(w[i : i + window])
                first[x] = min(first.get(x, k), k)
    out = []
    for k, w in parts:
        gone = set()
        if k is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i : i + window])] < k:
                    gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    passages = [fresh(rng.randint(8, 40)) for _ in range(6)]
    phrase = fresh(5)  # shared by most documents, with other words around it
    rows = []
    for k in range(n):
        words = fresh(rng.randint(0, 25))
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = f"x{rng.randrange(9)}"
            words += p[rng.randint(0, 4) :] + fresh(rng.randint(0, 6))
        words += phrase + fresh(rng.randint(0, 8))
        rows.append((k, " ".join(words)))
    rows += [(n + i, rows[3][1]) for i in range(20)]  # exact copies
    rows += [(n + 30, "a " * 300), (n + 31, "a " * 299), (n + 32, None), (n + 33, ""), (None, rows[3][1]), (None, rows[3][1])]
    rows += [(2, rows[5][1]), (2, rows[5][1]), (7, rows[7][1])]  # repeated keys and rows
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,window,prefix,most", [(1, 10, 3, 10**6), (2, 10, 3, 8), (3, 9, 2, 3), (4, 6, 6, 4), (5, 12, 5, 1)])
def test_repeats_equal_brute_force(spark, seed, window, prefix, most):
    rows = corpus(seed)
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n_words int").repartition(5)
    want = brute(rows, window)
    assert sum(r[2] for r in want) > 500
    assert sorted(map(tuple, D.repeat_digest(docs, window=window, prefix=prefix, most=most).collect()), key=repr) == want
    if most == 8:
        full = D.drop_repeats(docs, window=window, prefix=prefix, most=most)
        assert sorted((tuple(r)[:4] for r in full.collect()), key=repr) == want
        assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in full.collect())


def test_text_keys_and_empty_tables(spark):
    rows = [("b", "x " * 60), ("a", "x " * 55), ("c", "y " * 10)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in D.repeat_digest(docs).collect()}
    assert got == {"a": (55, 0), "b": (60, 60), "c": (10, 0)}
    assert D.repeat_digest(docs.limit(0)).count() == 0 and D.drop_repeats(docs.limit(0)).count() == 0
