"""Periodic runs, the prefix trie and licence scans against brute force and on their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fundspark.llm import license_scan, periodic_runs, prefix_trie
from fundspark.llm.words import slices
import pyarrow as pa

WORD = re.compile("[^\x20\x09-\x0d]+")
SF = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall(text or "")


def brute_runs(seq, least=24, exponent=3):
    n, runs = len(seq), []
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            j = i
            while j < n and seq[j] == seq[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if j > i and length >= max(least, exponent * q):
                piece = seq[start : start + length]
                if not any(all(piece[k] == piece[k - p] for k in range(p, length)) for p in range(1, q)):
                    runs.append((start, length, q))
            i = max(j, i + 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of(texts, least=24, exponent=3):
    column = pa.array([t.encode() for t in texts], pa.binary())
    for low, high, part in slices(column):
        at, lag, width = periodic_runs.occurrences(part.word_hash(), part.first, part.doc, least)
        bounds = np.searchsorted(at, part.first)
        for row in range(high - low):
            a, b = bounds[row], bounds[row + 1]
            yield periodic_runs.diagonal_runs(at[a:b] - part.first[row], lag[a:b], width[a:b], least, exponent)


BLOCK = st.lists(st.sampled_from("abc"), min_size=1, max_size=9)
PIECES = st.lists(st.tuples(BLOCK, st.integers(1, 12), st.lists(st.sampled_from("abxy"), max_size=3)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(PIECES, st.sampled_from([(24, 3), (6, 3), (1, 3), (10, 4)]))
def test_runs_equal_brute_force(pieces, limits):
    seq = []
    for block, times, rest in pieces:
        seq += block * times + rest
    nested = seq * 3 if len(seq) < 60 else seq
    assert list(runs_of([" ".join(seq), " ".join(nested)], *limits)) == [brute_runs(seq, *limits), brute_runs(nested, *limits)]


def test_runs_of_long_repetitive_texts():
    """Cases on which a diagonal for every earlier occurrence would be quadratic."""
    fib = ["a", "b"]
    while len(fib[-1]) < 30_000:
        fib.append(fib[-1] + fib[-2])
    texts = ["w " * 60_000, "a " * 2_000 + "b " + "a " * 2_000, ("a " * 100 + "b ") * 300, " ".join(fib[-1])]
    found = list(runs_of(texts))
    assert found[0] == [(0, 60_000, 1)] and found[1] == [(0, 2_000, 1), (2_001, 2_000, 1)]
    assert (0, 30_300, 101) in found[2] and len(found[2]) == 301
    assert found[3] and all(n >= max(24, 3 * p) for _, n, p in found[3])


def digest(key, text):
    seq = words(text)
    n = len(seq)
    h = zlib.crc32(str(key).encode())
    if key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        seq = [seq[i] if i < a else seq[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(seq)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    kept = " ".join(w for i, w in enumerate(seq) if i not in gone)
    return (
        len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_run_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 4000")
    got = periodic_runs.run_digest(periodic_runs.periodic_runs(docs, order=periodic_runs.repeated_tail)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts) and any(r.n_runs for r in got)
    for r in got:
        assert tuple(r)[1:] == digest(r.doc_id, texts[r.doc_id]), r.doc_id


def test_run_edges(spark):
    rows = [(0, None, 1), (1, "", 1), (2, " \n", 1), (3, "w " * 30, 1), (3, "w " * 30, 1), (None, "v " * 24, 1), (4, "x\x0bÄ\x0c" * 40, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs long")
    got = periodic_runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    out = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()]
    assert out == [
        (0, 0, [], ""), (1, 0, [], ""), (2, 0, [], ""), (3, 30, [(0, 30, 1)], "w"), (3, 30, [(0, 30, 1)], "w"),
        (None, 24, [(0, 24, 1)], "v"), (4, 80, [(0, 80, 2)], "x Ä"),
    ]
    assert periodic_runs.run_digest(got).where("n_runs = 0 and start is null and runs_sha256 is null").count() == 0
    assert periodic_runs.run_digest(periodic_runs.periodic_runs(docs.limit(0))).count() == 0


def brute_trie(table):
    """Nodes of {conv: [(role, text), ...]}."""
    members = {}
    for c, turns in table.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = set()
    for node, convs in members.items():
        under = [x for x in members if x[: len(node)] == node]
        children = [x for x in under if len(x) == len(node) + 1]
        leaves = sum(not any(y[: len(x)] == x and len(y) == len(x) + 1 for y in under) for x in under)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(table[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        rows.add((min(convs), len(node), parent, len(convs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def turn_rows(table, rng):
    rows = [(c, i * 2, role, text) for c, turns in table.items() for i, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [1, 4, 40, 10_000])
def test_trie_equals_brute_force(spark, most):
    rng = random.Random(most)
    say = lambda: (rng.choice("ua"), rng.choice(["", "x", "ü", "yy"]))
    table = {c: [say() for _ in range(rng.randint(1, 5))] for c in range(40)}
    long = [say() for _ in range(30)]
    for c in range(40, 60):  # copies, a long shared prefix, nested ends
        table[c] = long[: rng.choice([28, 30, 30])] + [say() for _ in range(rng.choice([0, 0, 2]))]
    table[100] = [("u", f"only {i}") for i in range(50)]
    turns = spark.createDataFrame(turn_rows(table, rng), "conv_id long, turn long, role string, text string")
    got = {tuple(r) for r in prefix_trie.prefix_trie(turns, most=most).collect()}
    assert got == brute_trie(table)


def test_trie_query_equals_brute_force(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    own = {}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn)):
        own.setdefault(r.conv_id, []).append((r.role, r.text))
    table = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        table[c] = own.get(c - c % 5, [])[:h] + said[h:]
    got = prefix_trie.trie_nodes(prefix_trie.rebuilt(prefix_trie.sequences(turns)), most=16)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_trie(table)


def test_trie_edges(spark):
    schema = "conv_id long, turn long, role string, text string, head string, n long"
    rows = [(1, 0, None, "a", "x", 1), (2, 0, "", "a", "x", 1), (2, 1, "u", None, "x", 1), (3, None, "", "a", "x", 1), (3, 5, "u", "", "x", 1), (None, 0, "u", "z", "x", 1)]
    got = {tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, schema)).collect()}
    assert got == brute_trie({1: [("", "a")], 2: [("", "a"), ("u", "")], 3: [("", "a"), ("u", "")]})
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    # A conversation without turns of its own is a member of the root: 6 has one turn and no base (5 is absent).
    said = prefix_trie.rebuilt(prefix_trie.sequences(spark.createDataFrame([(6, 0, "u", "q", "x", 1)], schema)))
    h = zlib.crc32(b"6") % 9
    assert [len(r.turns) for r in said.collect()] == [1 if h == 0 else 0]
    # Repeated rows are repeated turns.
    twice = spark.createDataFrame([(1, 0, "u", "q", "x", 1)] * 2, schema)
    assert prefix_trie.prefix_trie(twice).count() == 3


def test_trie_members_in_many_strings(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    table = {c: [("u", "same")] for c in range(50)}
    turns = spark.createDataFrame(turn_rows(table, random.Random(1)), "conv_id long, turn long, role string, text string")
    assert {tuple(r) for r in prefix_trie.prefix_trie(turns).collect()} == brute_trie(table)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=8), min_size=1, max_size=5), st.lists(st.integers(0, 3), max_size=30))
def test_automaton_equals_brute_force(templates, text):
    automaton = license_scan.Automaton(templates)
    held = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for i, (state, length) in enumerate(automaton.statistics(text)):
        want = max((k for k in range(1, i + 2) if tuple(text[i + 1 - k : i + 1]) in held), default=0)
        assert length == want
        if length:
            run = text[i + 1 - length : i + 1]
            ends = [(n, j) for n, t in enumerate(templates) for j in range(len(t)) if j + 1 >= length and t[j + 1 - length : j + 1] == run]
            assert automaton.ends[state] == ends
            done = {n for n, t in enumerate(templates) if len(t) <= length and text[i + 1 - len(t) : i + 1] == t}
            assert {n for n in automaton.finished[state] if len(templates[n]) <= length} == done


def scan_rows(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in license_scan.label_digest(license_scan.license_scan(docs)).collect()}


def test_license_base_equals_brute_force(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rng = random.Random(3)
    parts = ["CC", "by", "general", "PUBLIC", "license", "all", "rights", "reserved", "x", "ß", "-", "\n"]
    texts += [" ".join(rng.choice(parts) for _ in range(40)) for _ in range(300)]
    got = scan_rows(spark, texts)
    for i, t in enumerate(texts):
        w = license_scan.tokens(t)
        places = [(j, label) for p, label in license_scan.PHRASES.items() for j in range(len(w)) if w[j : j + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert r.first_word == min((j for j, _ in places), default=None) and r.last_word == max((j for j, _ in places), default=None)
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_spans(spark):
    mit = license_scan.TEMPLATES["mit"][1]
    changed = mit.replace("without restriction", "with no restriction at all").replace("merge, publish", "publish")
    texts = [
        f"x y {mit} z", f"# {changed.upper()}", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "All rights reserved.",
        "He was licensed under the rules of the house, with no limitation to use the rights of a person.",
        "Licensed under the Foo License, Version 2.0.", None, "", f"{mit} and {mit}", " ".join(mit.split()[:6]),
    ]
    got = scan_rows(spark, texts)
    labels = [got[i].labels for i in range(len(texts))]
    assert labels == ["mit", "mit", "mit", "apache-2.0", "gpl,gpl-3.0", "cc-by,cc-by-nc-4.0", "reserved", "", "", "", "", "mit", ""]
    assert got[0].score == 1.0 and 0.75 <= got[1].score < 1.0 and got[9].score == got[10].score == 0.0 and got[6].score == 0.5
    docs = spark.createDataFrame([(1, f"x y {mit} z {mit}", "a")] * 2 + [(None, "all rights reserved", "a")], "doc_id long, text string, places string")
    spans = license_scan.license_scan(docs).collect()
    n = len(license_scan.tokens(mit))
    assert [(s.label, s.start, s.end) for s in spans[0].spans] == [("mit", 2, n + 1), ("mit", n + 3, 2 * n + 2)] and spans[0] == spans[1]
    assert spans[2].doc_id is None and [tuple(p) for p in spans[2].places] == [("reserved", 0)]
    assert license_scan.license_scan(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan.license_scan(docs, templates={"big": ["w " * (license_scan.MOST_TOKENS + 1)]})
