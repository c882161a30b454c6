"""Operators against brute force and on the edge cases their docstrings define."""

import collections
import hashlib
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundspark.llm import (
    embedding_dedup, html_extract, jaccard_join, mixing, packing, pii, quality, substring_dedup, toxicity, url_filter,
)

WORD = re.compile("[^\x20\x09-\x0d]+")
SF = "/root/testdata/sf0.001"
EDGE = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "one two"), (4, "one two"), (None, "one two"), (None, None),
    (5, "ÄÖ\x0bx y\x0cz " * 40), (6, "w " * 60_000), (7, "a b c"),
]


def edge_docs(spark):
    rows = [(k, t, 1.0, "x") for k, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, n_words string")


def words(text):
    return WORD.findall(text or "")


def empty(df):
    return df.limit(0)


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, n):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_jaccard_join_equals_brute_force(spark, n, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {r.doc_id: shingles(r.text, n) for r in docs.collect()}
    groups, ids = Groups(), sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(docs, n=n, percent=percent).collect()}
    assert got == {k: (len(s), groups.find(k)) for k, s in sets.items()}


def test_jaccard_join_edges(spark):
    got = collections.Counter(map(tuple, jaccard_join.jaccard_join(edge_docs(spark)).collect()))
    assert got[(0, 0, 0)] == got[(1, 0, 1)] == got[(2, 0, 2)] == 1
    assert got[(3, 1, 3)] == 1 and got[(4, 1, 3)] == 2 and got[(None, 1, 3)] == 1 and got[(None, 0, None)] == 1
    assert got[(6, 1, 6)] == 1 and sum(got.values()) == len(EDGE)
    assert jaccard_join.jaccard_join(empty(edge_docs(spark))).count() == 0
    kept = jaccard_join.keep_one(edge_docs(spark))
    assert kept.columns == ["doc_id", "text", "score", "n_words"]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 5, 6, 7]


def test_repeated_passages(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(9, f"x {passage} y"), (2, passage), (3, passage[:-4]), (5, "a b"), (None, passage), (2, passage), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text")
    )
    held = [(r.doc_id, words(r.text)) for r in docs.collect()]
    first = {}
    for k, w in held:
        for i in range(len(w) - 49):
            if k is not None:
                first[tuple(w[i : i + 50])] = min(k, first.get(tuple(w[i : i + 50]), k))
    want = collections.Counter()
    for k, w in held:
        gone = {j for i in range(len(w) - 49) if k is not None and first[tuple(w[i : i + 50])] < k for j in range(i, i + 50)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[(k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    got = collections.Counter(map(tuple, substring_dedup.drop_repeats(docs).drop("kept_text").collect()))
    assert got == want
    assert substring_dedup.drop_repeats(empty(docs)).count() == 0
    assert substring_dedup.drop_repeats(edge_docs(spark)).count() == len(EDGE)


def test_embedding_duplicates_equal_brute_force(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    x = rows[0][1]
    rows += [(1000, x), (1001, [2 * v for v in x]), (1002, None), (1003, [0.0] * 64), (1004, [float("nan")] + x[1:]),
             (1005, [None] + x[1:]), (1006, []), (1007, [1.0, 2.0]), (1007, [1.0, 2.0]), (None, x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("kept", F.lit("extra"))
    unit = [None if v is None or not v or None in v or not np.isfinite(v).all() or not any(v) else np.array(v) / np.linalg.norm(v) for _, v in rows]
    links, groups = [0] * len(rows), Groups()
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    least = collections.defaultdict(list)
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[groups.find(i)].append(k)
    want = collections.Counter((k, links[i], min(least[groups.find(i)], default=None)) for i, (k, _) in enumerate(rows))
    out = embedding_dedup.embedding_duplicates(frame).collect()
    assert collections.Counter((r.vec_id, r.n_links, r.component_id) for r in out) == want
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in out)
    assert embedding_dedup.embedding_duplicates(empty(frame)).count() == 0


def test_quality_base_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(edge_docs(spark).select("doc_id", "text"))
    docs = docs.withColumn("kept", F.lit("extra"))
    want = collections.Counter()
    for r in docs.collect():
        w, text = words(r.text), r.text or ""
        seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        cover = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        bad = len(w) < 20 or 100 * len(cover) > 30 * len(w)
        want[(r.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover), bad)] += 1
    trusted = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    judged = quality.quality_rules(docs, trusted)
    got = collections.Counter(tuple(r)[:7] for r in judged.drop("score", "kept").collect())
    assert got == want
    assert judged.where("base_failed and kept").count() == 0
    assert quality.keep_good(docs, trusted).columns == docs.columns
    assert quality.quality_rules(empty(docs), trusted).count() == 0
    assert set(quality.log_ratios(docs, trusted.limit(0))) == {0.0}


def test_quality_separates_labelled_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.quality_rules(docs, labels.where("quality = 1").select("doc_id")).join(labels, "doc_id").where("not base_failed")
    rate = {r.quality: r.rate for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert rate[1] > 0.99 and rate[0] < 0.5


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        edge_docs(spark).select("doc_id", "text").where("doc_id in (0, 1, 2, 5, 6, 7)").withColumn("doc_id", F.col("doc_id") + 10_000)
    )
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    out = packing.pack_documents(docs.withColumn("piece", F.lit("extra"))).collect()
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    total = 0
    for d in docs.collect():
        ids, at = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0], 0
        total += len(ids)
        for k, r in enumerate(sorted(by_doc[d.doc_id], key=lambda r: r.piece)):
            part = ids[r.start : r.start + r.length]
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            assert k == 0 or r.length == 2048
            at += r.length
        assert at == len(ids) and (len(ids) > 2048) == (len(by_doc[d.doc_id]) > 1)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= 1.02 * -(-total // 2048) + 1
    assert packing.pack_documents(empty(docs)).count() == 0


def test_chunk_encoder_equals_tokenizers():
    import random

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    encoder, rng = packing.ChunkEncoder(packing.tokenizer_path()), random.Random(3)
    odd = ["", " ", "a  b", "a \n b", "don't 's", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y z", "<|endoftext", "tail ", "　x", "\x1c a \x85 b"]
    odd += ["".join(rng.choice(" \n\tab'1.é日😀  \x1f") for _ in range(rng.randint(0, 30))) for _ in range(500)]
    for text in odd:
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_dominance_fixes_are_optimal_on_small_cases():
    def fewest(items, capacity):
        best = len(items)

        def place(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(items):
                best = len(rooms)
                return
            for k, room in enumerate(rooms):
                if room >= items[i]:
                    place(i + 1, rooms[:k] + [room - items[i]] + rooms[k + 1 :])
            place(i + 1, rooms + [capacity - items[i]])

        place(0, [])
        return best

    rng = np.random.default_rng(5)
    for _ in range(60):
        items = sorted((int(x) for x in rng.integers(2, 16, 8)), reverse=True)
        left = packing.Lengths(dict(collections.Counter(items)))
        fixed = packing.reduce_by_dominance(left, 16)
        rest = [s for s, n in left.count.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + (fewest(sorted(rest, reverse=True), 16) if rest else 0) == fewest(items, 16)
        bins = packing.pack(dict(collections.Counter(items)), 16)
        assert sorted(s for b, n in bins for _ in range(n) for s in b) == sorted(items)


def test_personal_data(spark):
    text = ("mail a.b@x.org and a@b.c@d.e, ip 10.0.0.1 not 10.0.0.999, card 4111 1111 1111 1111 not 4111 1111 1111 1112, "
            "call +1 (555) 555-0100, iban DE89 3704 0044 0532 0130 00 bank, password=e3b3ed3cc8548923d6")  # fmt: skip
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string").withColumn("spans", F.lit(0))
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert tuple(got[1])[1:5] == (2, 1, 1, 1)
    kinds = [s.split(":")[0] for s in got[1].spans.split(",")]
    assert kinds == ["email", "email", "ip", "card", "phone", "iban", "secret"]
    base = ",".join(s for s in got[1].spans.split(",") if s.split(":")[0] in pii.BASE_KINDS)
    assert got[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert got[2].spans == got[3].spans == "" and got[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[2] is None and clean[3] == "" and "<EMAIL>" in clean[1] and "4111 1111 1111 1111" not in clean[1]
    assert pii.find_personal_data(empty(docs)).count() == 0


def test_extra_span_inside_a_base_span_that_covers_many_others():
    text = "ssn " + "".join(f"{i}.{i}.{i}.{i}-" for i in range(1, 7)) + "ssn.123-45-6789@a.bc"
    base = pii.base_spans(text)
    assert [k for k, _, _ in base] == ["email"] + ["ip"] * 6
    assert pii.extra_spans(text, base) == []
    assert [k for k, _, _ in pii.extra_spans(text, [])] == ["national_id"]


def test_base_spans_equal_plain_expressions():
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    rng = np.random.default_rng(11)
    for _ in range(3000):
        text = "".join(rng.choice(list("a.@-+ ()0123456789%"), rng.integers(0, 60)))
        want = []
        for kind, pattern in plain.items():
            for m in re.finditer(pattern, text):
                digits = re.sub(r"\D", "", m.group())
                ok = (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                      or kind == "card" and 16 <= len(digits) <= 19 and pii.luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15)
                if ok:
                    want.append((kind, m.start(), m.end()))
        assert pii.base_spans(text) == want, text


def test_mixing_keeps_every_row_and_the_weights(spark):
    rows = [(i, "x" * 100, "abc"[0 if i % 10 < 6 else i % 2 + 1]) for i in range(3000)]
    rows += [(None, None, None), (1, "", None), (1, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mix_slot", F.lit("extra"))
    weights = {"a": 0.2, "b": 0.5, "c": 0.3, "": 0.001}
    out = mixing.mix_sources(docs, weights, block_chars=1000, period=100).collect()
    assert len(out) == len(rows)
    first = [r for r in out if r.mix_phase == 0]
    slots = {(r.mix_source, r.mix_block): r.mix_slot for r in first}
    assert len(set(slots.values())) == len(slots)
    share = mixing.shares(weights, 100)
    for s in "abc":
        mine = sorted(v for (k, _), v in slots.items() if k == s)
        for j, t in enumerate(mine):
            assert abs((j + 1) - (t + 1) * share[s] / 100) < 1 and abs(j - t * share[s] / 100) < 1
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(r[0] for r in rows)
    same = mixing.interleave(docs, weights=weights)
    assert same.columns == docs.columns and same.count() == len(rows)
    assert mixing.mix_sources(empty(docs)).count() == 0


def test_pfair_period_meets_every_deadline():
    rng = np.random.default_rng(2)
    for _ in range(30):
        share = mixing.shares({f"s{i}": float(w) for i, w in enumerate(rng.uniform(0.01, 1, rng.integers(1, 12)))}, 60)
        slots = mixing.one_period(share)
        for s, n in share.items():
            assert len(slots[s]) == n
            for j, t in enumerate(slots[s]):
                assert j * 60 // n <= t < -(-(j + 1) * 60 // n)


def test_url_filter(spark):
    rows = [(1, "https://EN.Example.org/es/x"), (2, "http://a.com/fr/1?utm_source=q"), (3, "http://a.net/login/"), (4, None), (5, "nothing"),
            (6, "http://blog.x.net/login/"), (7, "https://example.org"), (7, "https://example.org"), (8, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit("extra"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages).collect()}
    assert got[1] == ("en.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("a.com", "/fr/1", "com/fr/", "allow")
    assert got[3] == ("a.net", "/login/", None, "block") and got[6][3] == "allow"
    assert got[4] == got[8] == ("", "", None, "allow") and got[5] == ("", "", None, "allow")
    assert got[7] == ("example.org", "", None, "allow")
    assert url_filter.filter_urls(empty(pages)).count() == 0


def test_url_index_fetches_every_matching_rule(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rules = url_filter.PATTERNS
    for r in url_filter.filter_urls(pages).join(pages, "page_id").collect():
        assert r.matched == sorted(p for p in rules if re.search(url_filter.pattern_regex(p), r.url))


def test_html_text(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=x>Menu</a></nav>
      <div class="cookie-banner">Accept</div><div class="content-12"><h1>Head &amp; line</h1><p>First <b>bold</b>ed&nbsp;part.<br>More
      <p>Second &lt;p&gt;<script>var a="</p>";</script><ul><li>One<li>Two</ul><div class="ad">Buy</div><form>Name<input></form></div>
      <aside>Side</aside><div class="comments"><p>Reader says</p></div><footer>Foot</footer></body></html>"""
    rows = [(1, "http://h.org/1", page), (2, "http://h.org/2", None), (3, None, ""), (4, "x", "plain text"), (4, "x", "plain text"),
            (5, "http://h.org/3", "<p>open <!-- never closed")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("extra"))
    got = {r.page_id: r for r in html_extract.extract_text(pages).collect()}
    assert got[1].text == "Head & line First bolded part. More Second <p> One Two"
    assert got[1].n_chars == len(got[1].text) and got[2].text == got[3].text == "" and got[4].text == "plain text" and got[5].text == "open"
    assert html_extract.extract_text(pages).count() == 6 and html_extract.extract_text(empty(pages)).count() == 0


def test_html_articles_of_the_test_pages(spark):
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_extract.extract_text(pages.withColumnRenamed("text", "t")).join(pages.select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == " ".join(b for b in blocks if b)


def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out and toxic is not null")
    rate = {r.toxic: r.rate for r in out.groupBy("toxic").agg(F.avg("predicted").alias("rate")).collect()}
    # Some rows labelled toxic are junk that holds no insult (all of one word, symbols only).
    assert rate[1] > 0.88 and rate[0] < 0.02


def test_toxicity_edges(spark):
    docs = edge_docs(spark).withColumn("toxic", F.lit(5))
    labels = spark.createDataFrame([(3, 1), (5, 0), (6, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, labels)
    assert out.count() == len(EDGE) and out.where("score < 0 or score > 1 or score is null").count() == 0
    assert out.where("predicted = 1 and doc_id in (0, 1, 2)").count() == 0
    assert toxicity.toxicity(empty(docs), labels).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = corpus_pipeline.materialise(stage(spark, step, SF), name)
        assert step.columns == docs.columns
        counts.append(step.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] == counts[4]
    packed = corpus_pipeline.STAGES[-1][1](spark, step, SF)
    assert packed.select("doc_id").distinct().count() == counts[4]
    again = {r.doc_id: shingles(r.text, 5) for r in step.collect()}
    assert len(again) == counts[4]


def test_pipeline_packs_along_the_mixture(spark, monkeypatch):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    two = docs.select("source").distinct().orderBy("source").limit(2).collect()
    names = [r.source for r in two]
    docs = docs.where(F.col("source").isin(names))
    source = {r.doc_id: r.source for r in docs.collect()}

    def packed(weights):
        monkeypatch.setattr(corpus_pipeline, "MIX", {"weights": weights, "block_chars": 2000, "period": 100})
        return sorted(corpus_pipeline.packing_stage(spark, docs, SF).collect(), key=lambda r: (r.sequence_id, r.offset))

    def early_share(rows, name):
        half = rows[-1].sequence_id // 2
        heads = [source[r.doc_id] for r in rows if r.offset == 0 and r.sequence_id < half]
        return heads.count(name) / len(heads)

    plain = packing.pack_documents(docs)
    first, second = packed({names[0]: 0.9, names[1]: 0.1}), packed({names[0]: 0.1, names[1]: 0.9})
    assert first[0].__fields__ == plain.columns
    for rows in (first, second):
        assert {r.sequence_id for r in rows} == set(range(rows[-1].sequence_id + 1))
        filled = collections.Counter()
        for r in rows:
            assert r.offset == filled[r.sequence_id]
            filled[r.sequence_id] += r.length
        assert max(filled.values()) <= 2048
    what = lambda rows: collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert what(first) == what(second) == what(plain.collect())
    assert early_share(first, names[0]) > 0.7 > 0.3 > early_share(second, names[0])
    # The same whatever the order of the stored rows.
    docs = docs.orderBy(F.xxhash64("doc_id", F.lit(1)))
    assert packed({names[0]: 0.1, names[1]: 0.9}) == second


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_quality_behaves_alike_at_every_size(spark, sf):
    from fundspark.llm import queries

    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet").select("doc_id", "quality")
    judged = queries.op7_quality_rules(spark, f"/root/testdata/{sf}").join(labels, "doc_id", "left").where("not base_failed")
    found = judged.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()
    rate = {r.quality: r.kept / r.n for r in found}
    print(sf, found)
    # Rows without a label are mostly like the rows labelled 1.
    assert rate[1] > 0.97 and rate[0] < 0.04 and rate[None] > 0.8


def test_quality_threshold():
    assert quality.best_threshold([], [1.0]) == float("-inf") and quality.best_threshold([3.0, 2.0], []) == 2.0
    assert quality.best_threshold([2.0, 3.0], [0.0, 1.0]) == 1.5
    assert quality.best_threshold([1.0, 2.0], [3.0]) == 1.0


@pytest.fixture(scope="module")
def many_trusted(spark):
    """12,000 trusted rows of a few words; the texts of the last of those that count and of the last of
    those held out, in the order of their hash, are of words that no other row has."""
    keys = spark.range(12_000).select(F.col("id").alias("_key"))
    last = lambda part: keys.where(part).orderBy(F.xxhash64("_key").desc()).first()["_key"]
    counted, held = last(~quality.held_out()), last(quality.held_out())
    plain = [" ".join(f"w{(i + 7 * j) % 40}" for j in range(25)) for i in range(40)]
    texts = [(i, plain[i % 40]) for i in range(12_000) if i not in (counted, held)]
    texts += [(k, " ".join(f"odd{k}x{j}" for j in range(25))) for k in (counted, held)]
    texts += [(20_000 + i, plain[i % 40]) for i in range(12_000)]
    return counted, held, spark.createDataFrame(texts, "doc_id long, text string"), keys.withColumnRenamed("_key", "doc_id")


def test_quality_counts_and_threshold_come_from_all_labelled_rows(many_trusted):
    counted, held, docs, trusted = many_trusted
    found = {r.doc_id: r for r in quality.quality_rules(docs, trusted).where(F.col("doc_id").isin(counted, held)).collect()}
    # Its words occur in trusted rows only: trusted above the corpus, where half of the rows are.
    assert found[counted].score > 0
    # No held-out trusted row has a lower score, which is the threshold where nothing is rejected.
    assert found[held].score < -1 and found[held].kept


def test_quality_threshold_weighs_every_rejected_row(many_trusted, spark):
    _, _, docs, trusted = many_trusted
    # In the order of their hash the first 2,000 rejected rows are far from the trusted ones, the others near.
    ids = [r.id for r in spark.range(40_000, 45_000).orderBy(F.xxhash64("id")).collect()]
    odd = [(k, " ".join(f"{'z' if i < 2000 or j % 6 == 0 else 'w'}{(i + 7 * j) % 40}" for j in range(25))) for i, k in enumerate(ids)]
    odd = spark.createDataFrame(odd, "doc_id long, text string")
    judged = quality.quality_rules(docs.unionByName(odd), trusted, rejected=odd.select("doc_id"))
    rows = judged.withColumn("_key", F.col("doc_id")).withColumn("good", quality.held_out() & (F.col("doc_id") < 12_000))
    rows = rows.where("good or doc_id >= 40000").select("good", "score").collect()
    want = quality.best_threshold([r.score for r in rows if r.good], [r.score for r in rows if not r.good])
    assert judged.where(F.col("kept") != (F.col("score") >= want)).count() == 0
    assert judged.where("doc_id >= 40000 and kept").count() == 0


def test_pipeline_keeps_by_all_labelled_rows(many_trusted):
    counted, held, docs, trusted = many_trusted
    kept = quality.keep_good(docs, trusted).where(F.col("doc_id").isin(counted, held)).collect()
    assert {r.doc_id for r in kept} == {counted, held}


@pytest.fixture(scope="module")
def odd_trusted(spark):
    """400 trusted rows of a few words but for one of each kind of fold, whose words no other trusted row
    has; the keys of these two, and unlabelled rows 1000 of the words of the first, half, 1001 of those of
    the second, and others of few words."""
    fold = {r.id: r.held for r in spark.range(400).select("id", quality.fold_of(F.col("id")).alias("held")).collect()}
    later, first = max(k for k in fold if fold[k] > 0), max(k for k in fold if fold[k] == 0)
    plain = [" ".join(f"w{(i + 7 * j) % 40}" for j in range(25)) for i in range(40)]
    odd = {k: " ".join(f"odd{k}x{j}" for j in range(25)) for k in (later, first)}
    texts = [(i, odd.get(i, plain[i % 40])) for i in range(400)] + [(2000 + i, plain[i % 40]) for i in range(400)]
    texts += [(1000, " ".join(f"new{j}" if j % 2 else f"w{7 * j % 40}" for j in range(25))), (1001, odd[first])]
    return later, first, spark.createDataFrame(texts, "doc_id long, text string"), spark.range(400).withColumnRenamed("id", "doc_id")


def test_quality_threshold_comes_from_trusted_rows_of_every_fold(odd_trusted):
    later, first, docs, trusted = odd_trusted
    # The one trusted row far from the others is in a fold that was counted, and not in the threshold, before.
    docs, trusted = docs.where(F.col("doc_id") != first), trusted.where(F.col("doc_id") != first)
    found = {r.doc_id: r for r in quality.quality_rules(docs, trusted).where("doc_id >= 1000 and doc_id < 2000").collect()}
    assert -2 < found[1000].score < -0.5 and found[1000].kept
    assert quality.keep_good(docs, trusted).where("doc_id = 1000").count() == 1
    without = trusted.where(F.col("doc_id") != later)
    assert quality.keep_good(docs.where(F.col("doc_id") != later), without).where("doc_id = 1000").count() == 0


def test_quality_counts_trusted_rows_of_every_fold(odd_trusted):
    later, first, docs, trusted = odd_trusted
    score = {r.doc_id: r.score for r in quality.quality_rules(docs, trusted).collect()}
    # Row 1001 repeats a trusted row of the first fold, whose own label is not in its own score.
    assert score[1001] > -0.2 and score[first] < -2 and score[later] > 0


def test_quality_ratios_without_a_fold(odd_trusted):
    _, _, docs, trusted = odd_trusted
    keys = quality.keys_of(trusted, "doc_id")
    found = {r.b: r.others for r in quality.ratio_table(docs, keys).collect()}
    for k in range(quality.FOLDS):
        want = quality.ratio_table(docs, keys.where(quality.fold_of(F.col("_key")) != k)).collect()
        assert {r.b: r.ratio for r in want} == {b: others[k] for b, others in found.items()}
    # Of trusted rows in one fold alone nothing is left to weigh them by: only the base rule decides.
    alone = trusted.where(quality.fold_of(F.col("doc_id")) == 3)
    assert quality.quality_rules(docs, alone).where(F.col("kept") == F.col("base_failed")).count() == 0


def test_quality_cut_on_rows_equals_the_one_on_lists(spark):
    rng = np.random.default_rng(7)
    for n, m, digits in [(300, 200, 2), (40, 500, 1), (500, 40, 9), (3, 0, 1), (0, 3, 1), (1, 1, 0), (5, 5, 0)]:
        good, bad = np.round(rng.normal(0.3, 1, n), digits).tolist(), np.round(rng.normal(0, 1, m), digits).tolist()
        rows = spark.createDataFrame([(x, 1) for x in good] + [(x, 0) for x in bad], "score double, _good int")
        assert quality.best_cut(rows) == quality.best_threshold(good, bad)


def test_quality_is_the_same_where_the_texts_are_shuffled(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(edge_docs(spark).select("doc_id", "text"))
    trusted, rejected = (spark.read.parquet(f"{SF}/labels.parquet").where(f"quality = {q}").select("doc_id") for q in (1, 0))
    run = lambda: collections.Counter(map(tuple, quality.quality_rules(docs, trusted, rejected=rejected).collect()))
    want = run()
    monkeypatch.setattr(quality, "BROADCAST_KEYS", 0)
    assert run() == want


def test_html_keeps_every_part_of_the_article(spark):
    long, short = "long text of the body. " * 40, "the lead in short."
    body = f'<div class="body"><p>{long}</p></div>'
    menu, links = "<nav><a href=/>Menu</a></nav><footer>Foot</footer>", '<div><ul><li><a href="/1">other story</a><li><a href="/2">and another</a></ul></div>'
    want = f"Title {short} {long.strip()}"
    pages = {
        "article": (f"<article><h1>Title</h1><p>{short}</p>{body}</article>{links}", want),
        "linked": (f'<div class="post"><h1><a href="/">Title</a></h1><p>{short}</p>{body}</div>{links}', want),
        "main": (f'<main><h1>Title</h1><p>{short}</p>{body}</main>', want),
        "sections": (f'<section class="intro"><h1>Title</h1><p>{short}</p></section><section class="rest"><p>{long}</p></section>', want),
        "parts": (f'<main><article class="one"><h1>Title</h1><p>{short}</p></article><article class="two"><p>{long}</p></article></main>', want),
        "share": (f'<main><article>{"a b c " * 60}</article><section>{"d e f " * 40}</section></main>', ("a b c " * 60 + "d e f " * 40).strip()),
        "list": (f"<main><article><h1>Title</h1><p>{short}</p>{body}</article>{links}</main>", want),
    }
    rows = [(f"{name}{i}", f"http://{name}.org/{i}", f"<html><body>{menu}{html}</body></html>") for name, (html, _) in pages.items() for i in range(3)]
    # A page that has more beside the path that its host's pages agree on.
    rows += [(f"mixed{i}", f"http://mixed.org/{i}", f"<main><article><p>{long}</p></article></main>") for i in range(3)]
    rows.append(("more", "http://mixed.org/4", f"<main><h1>Title</h1><p>{short}</p><article><p>{long}</p></article></main>"))
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    for name, (_, text) in pages.items():
        assert [got[f"{name}{i}"] for i in range(3)] == [text] * 3, name
    assert got["mixed0"] == long.strip() and got["more"] == want


def test_long_secrets_are_found_whole(spark):
    token = "ab1-" * 300
    docs = spark.createDataFrame([(1, f"token={token} end"), (2, f"token={token}.1.2.3.4-{token} end")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(docs).collect()}
    assert got[1] == f"secret:6:{6 + len(token)}"
    assert {r.doc_id: r.text for r in pii.redact(docs).collect()}[1] == "token=<SECRET> end"
    text = f"token={token}x_1.2.3.4_{token} end"
    base = pii.base_spans(text)
    (kind, a, b), = base
    assert kind == "ip" and pii.extra_spans(text, base) == [("secret", 6, a), ("secret", b, len(text) - 4)]
    assert pii.extra_spans("token=1.2.3.4", pii.base_spans("token=1.2.3.4")) == []


@pytest.mark.parametrize("percent,one,two,both", [(85, 6, 7, 6), (80, 8, 10, 8), (80, 16, 16, 15), (85, 12, 14, 12), (85, 20, 20, 19)])
def test_isolated_pairs_of_short_texts_go_on(percent, one, two, both):
    assert 100 * both >= percent * (one + two - both)
    pairs, rng = 40_000, np.random.default_rng(one * 100 + two)
    grams = rng.integers(0, 1 << 64, (pairs, one + two - both), dtype=np.uint64, endpoint=False)
    a, b = np.sort(grams[:, :one], axis=1), np.sort(np.concatenate([grams[:, :both], grams[:, one:]], axis=1), axis=1)
    flat = np.concatenate([a, b], axis=1).ravel()
    first = np.concatenate([[0], np.cumsum(np.tile([one, two], pairs))])
    row, sig, code = jaccard_join.signatures(flat, first, jaccard_join.Ranges(percent, two))
    order = np.lexsort((sig, row // 2))
    row, sig, code = row[order], sig[order], code[order]
    same = (sig[1:] == sig[:-1]) & (row[1:] // 2 == row[:-1] // 2) & (row[1:] != row[:-1])
    shared = np.zeros(len(row), dtype=bool)
    shared[1:] |= same
    shared[:-1] |= same
    held = collections.Counter(zip(row[shared].tolist(), code[shared].tolist(), strict=True))
    goes_on = {r for (r, c), n in held.items() if n > c // 2}
    assert len(goes_on) == 2 * pairs


CLASH = ["size", "low", "high", "slots", "phase", "base", "s", "_n0", "_chunk", "a.b", "mix_slot"]


def test_mixing_with_clashing_and_dotted_names(spark):
    docs = spark.createDataFrame([(i, f"t {i}", f"src{i % 3}", *range(len(CLASH))) for i in range(30)], ["doc_id", "text", "source", *CLASH])
    mixed = mixing.mix_sources(docs, block_chars=10)
    assert sorted(r.doc_id for r in mixed.collect()) == list(range(30))
    assert mixed.columns[: len(CLASH) + 2] == [c for c in docs.columns if c != "mix_slot"]
    ordered = mixing.interleave(docs, block_chars=10)
    assert ordered.columns == docs.columns and ordered.count() == 30


def test_keep_one_with_maps_and_null_keys(spark):
    text = "one two three four five six"
    rows = [(1, text, {"a": 1}), (2, text, {"a": 2}), (1, text, {"a": 1}), (None, text, {"a": 3}), (None, text, {"a": 3}), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>")
    got = [(r.doc_id, r.m) for r in jaccard_join.keep_one(docs).collect()]
    assert sorted(got, key=repr) == sorted([(1, {"a": 1}), (3, None), (None, {"a": 3}), (None, {"a": 3})], key=repr)


def test_training_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "x"), (3, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    never = lambda key: F.lit(False)
    assert len(toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", never, 10).collect()) == 3


def test_links_of_near_copies_move_each_vector_once(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(32)
    near = base + 0.01 * rng.standard_normal((3000, 32))
    edge = base + 0.08 * rng.standard_normal((40, 32))  # linked with many, some outside the core
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([near, edge, rng.standard_normal((50, 32))]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_duplicates(frame).collect()}
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert [got[i][0] for i in range(len(rows))] == want.tolist()
    nodes = frame.select(F.col("vec_id").alias("node"), F.col("embedding").alias("v"), F.lit(1).cast("long").alias("copies"))
    groups = nodes.where("node < 3040").select("node", F.lit(0).alias("component"))
    members = embedding_dedup.core_members(groups, nodes, 0.95)
    outside = members.where(~F.col("core")).count()
    cells = embedding_dedup.link_cells(members).count()
    assert outside <= 40 and cells <= (3040 + 6 * outside if outside else 0)
