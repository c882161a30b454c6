"""Exact n-gram Jaccard join by vertical partitioning.

A text's set holds the 64-bit hashes of its word n-grams. The global order of n-grams is the order of
their hashes; cutting it into equal ranges cuts every set into fragments that are handled apart.

Which sets can have a partner: two sets with Jaccard similarity t differ in at most k =
(1-t)/t * (size of the smaller) n-grams, so of F fragments at least F - k are equal in both. Sizes
are grouped into ranges [l, l/t]; sets meet in the range of the smaller one. A range uses
F = 1.5 (k + 1) fragments, and a set goes on only if it shares a third of them with others. (Empty
fragments are counted but only emitted by sets that have too many; a partner that has fewer may not emit
the ones they share, so such a set, which is rare, goes on with a single shared fragment.)

Candidates: among the sets that go on, n-grams are ordered from rare to frequent. Of n n-grams the
n - ceil(t n) + 1 rarest hold one of every partner's; those that no other set holds come first, so
texts that share a frequent passage but differ elsewhere never meet. A pair is also left out if, range
by range of the order, the n-grams the poorer one has in common with any other set are too few.

Verification: the sets of candidate texts are cut into ``FRAGMENTS`` ranges of the order, each
range's overlap is counted by itself, and the counts are summed per pair.

Texts with equal sets are one node. Nodes that share a rare n-gram are linked through
``graph.bucket_components``, which checks members against a few nodes and then whatever is left in
different components, so groups of many near copies never produce all their pairs and no
component is missed.

Defined results: a null or empty text, or one without words, has an empty set, size 0, and is its own
component. A row with a null key is judged but gives no component its id; if no row of a
component has a key its id is null. Repeated rows and repeated keys are joined by their texts. An
empty table gives an empty table. Only key and text are read; ``keep_one`` passes every column on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import bucket_components
from .shared import materialise, shuffle_width
from .words import WORD_BASE, Texts, dealt, flat, lists, mix, ngrams, signed, slices, spans_hash

FRAGMENTS = 4
FLUSH_BYTES = 8 << 20  # texts gathered before signatures are handed on
SIGNATURES_PER_PART = 1_500_000


def shingle_sets(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct n-grams of each row in ascending order."""
    words = texts.word_hash()
    at, grams = ngrams(words, texts.first, n)
    rows = texts.doc[at] if len(at) else np.zeros(0, dtype=np.int64)
    count = np.diff(texts.first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = spans_hash(words, texts.first[short], texts.first[short + 1], WORD_BASE)
        grams, rows = np.concatenate([grams, whole]), np.concatenate([rows, short])
    order = np.lexsort((grams, rows))
    grams, rows = grams[order], rows[order]
    if len(grams):
        new = np.ones(len(grams), dtype=bool)
        new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
        grams, rows = grams[new], rows[new]
    return grams, np.searchsorted(rows, np.arange(texts.rows + 1))


def set_keys(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One value per row that equal sets share."""
    total = np.zeros(len(grams) + 1, dtype=np.uint64)
    np.cumsum(mix(grams), out=total[1:])
    size = np.diff(first).astype(np.uint64)
    return mix(total[first[1:]] - total[first[:-1]] + size * np.uint64(0x9E3779B97F4A7C15))


class Ranges:
    """Ranges of set sizes: [low, high] with low * 100 >= percent * high where possible."""

    def __init__(self, percent: int, most: int):
        self.percent, self.low = percent, [1]
        while self.low[-1] <= most:
            self.low.append(self.low[-1] * 100 // percent + 1)
        low = np.array(self.low, dtype=np.int64)
        self.starts = low
        high = low * 100 // percent
        # Differences of a pair whose smaller size s is at most high: sizes s and s * 100 / percent.
        self.differ = (high * (100 - percent)) // percent
        self.spare = np.maximum(2, (self.differ + 2) // 2)
        self.count = self.differ + 1 + self.spare

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, size, side="right") - 1


def signatures(grams: np.ndarray, first: np.ndarray, ranges: Ranges) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature, code) of the fragments of each row; code is twice the number of fragments that
    may be left aside, plus 0 or 1 for the range."""
    size = np.diff(first)
    row = np.flatnonzero(size)
    found = []
    for step in (0, 1):
        which = ranges.of(size[row]) - step
        mine, group = row[which >= 0], which[which >= 0]
        parts = ranges.count[group]
        base = np.zeros(len(mine) + 1, dtype=np.int64)
        np.cumsum(parts, out=base[1:])
        index = np.repeat(first[mine], size[mine]) + (
            np.arange(size[mine].sum()) - np.repeat(np.cumsum(size[mine]) - size[mine], size[mine])
        )
        mineg = grams[index]
        fragment = ((mineg >> np.uint64(32)) * np.repeat(parts, size[mine]).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        slot = np.repeat(base[:-1], size[mine]) + fragment
        total = np.zeros(len(mineg) + 1, dtype=np.uint64)
        np.cumsum(mix(mineg), out=total[1:])
        edge = np.searchsorted(slot, np.arange(base[-1] + 1))
        held = np.diff(edge)
        owner = np.repeat(np.arange(len(mine)), parts)
        number = np.arange(base[-1]) - base[owner]
        empty = np.bincount(owner[held == 0], minlength=len(mine))
        emit = (held > 0) | (empty > ranges.spare[group])[owner]
        place = mix(group[owner].astype(np.uint64) * np.uint64(1 << 32) + number.astype(np.uint64))
        value = mix(total[edge[1:]] - total[edge[:-1]] + place + held.astype(np.uint64))
        # Of the spare + 1 equal fragments of a pair, up to spare are empty and not emitted by a partner.
        aside = np.maximum(ranges.spare[group] - empty, 0)
        found.append((mine[owner[emit]], value[emit], 2 * aside[owner[emit]] + step))
    return tuple(np.concatenate([x[i] for x in found]) for i in range(3))


def text_nodes(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """``_key``, ``size`` and ``node`` (the set's value; null for an empty set) of every row."""
    kind = dict(docs.dtypes)[key]

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, values = [], []
            for _, _, texts in slices(batch.column(1), lower=True):
                grams, first = shingle_sets(texts, n)
                sizes.append(np.diff(first))
                values.append(signed(set_keys(grams, first)))
            size = np.concatenate(sizes) if sizes else np.zeros(0, dtype=np.int64)
            node = np.concatenate(values) if values else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size.astype(np.int64)), pa.array(node, mask=size == 0)], ["_key", "size", "node"]
            )

    return docs.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text")).mapInArrow(
        nodes, f"_key {kind}, size long, node long"
    )


def shared_fragments(docs: DataFrame, text: str, n: int, percent: int, most: int, parts: int) -> DataFrame:
    """Nodes (distinct) that share enough fragments with other nodes to have a partner."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges(percent, most)
        sigs, nodes, codes, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            # Repeats inside the flush are dropped here, so copies send a signature once.
            node, sig, code = np.concatenate(nodes), np.concatenate(sigs), np.concatenate(codes)
            order = np.lexsort((sig, node))
            order = order[first_of(node[order], sig[order])]
            order = order[(by_part := dealt(sig[order], parts))[0]]
            columns = [signed(node[order]), signed(sig[order]), code[order].astype(np.int32)]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(parts, dtype=np.int32)), *[lists(c, by_part[1]) for c in columns]],
                ["part", "nodes", "sigs", "codes"],
            )

        for batch in batches:
            for _, _, texts in slices(batch.column(0), lower=True):
                grams, first = shingle_sets(texts, n)
                row, sig, code = signatures(grams, first, ranges)
                sigs.append(sig)
                codes.append(code)
                nodes.append(set_keys(grams, first)[row])
                held += len(texts.data)
                if held >= FLUSH_BYTES:
                    yield out()
                    sigs, nodes, codes, held = [], [], [], 0
        if sigs:
            yield out()

    def shared(table: pa.Table) -> pa.Table:
        sig, node, code = (flat(table.column(c)) for c in ("sigs", "nodes", "codes"))
        order = np.lexsort((node, sig))
        order = order[first_of(sig[order], node[order])]
        sig, node, code = sig[order], node[order], code[order]
        same = sig[1:] == sig[:-1]
        keep = np.zeros(len(sig), dtype=bool)
        keep[1:] |= same
        keep[:-1] |= same
        return pa.table({"sig": sig[keep], "node": node[keep], "code": code[keep]})

    blobs = docs.select(F.col(text).cast("binary").alias("_text")).mapInArrow(
        emit, "part int, nodes array<long>, sigs array<long>, codes array<int>"
    )
    found = blobs.groupBy("part").applyInArrow(shared, "sig long, node long, code int")
    enough = found.groupBy("node", "code").agg(F.count(F.lit(1)).alias("n")).where("n > code div 2")
    return enough.select("node").distinct()


def rare_grams(sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(sig, node, info): the rarest n-grams of every set that another set holds too, as many as the
    prefix principle asks for; info has the set's size and how many of its n-grams others hold, in each of 32 ranges of the order.
    ``sets(node, fragment, grams)``, ``sizes(node, size)``."""
    held = sets.select("node", F.explode_outer("grams").alias("gram")).where("gram is not null")
    # Under a name of its own the join deals both sides out anew and can split an n-gram that very many hold.
    other = F.bitwise_not("gram").alias("other")
    often = held.groupBy("gram").agg(F.count(F.lit(1)).alias("often")).where("often > 1").select(other, "often")
    rows = held.select("node", "gram", other).join(often, "other").select("node", "gram", "often")
    order = Window.partitionBy("node").orderBy(F.desc("often"), F.desc("gram"))
    whole, range_of = Window.partitionBy("node"), F.shiftrightunsigned("gram", 59)
    common = F.array(*[F.count(F.when(range_of == i, 1)).over(whole).cast("int") for i in range(32)])
    ranked = rows.withColumns({"rank": F.row_number().over(order), "common": common}).join(sizes, "node")
    # ceil(t n) - 1 n-grams may be left aside; the most frequent ones are.
    return ranked.where(f"rank > (size * {percent} + 99) div 100 - 1").select(
        F.col("gram").alias("sig"), "node", F.struct("size", "common").alias("info")
    )


def first_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Mask of the first entry of every run of equal pairs."""
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return new


def segments(docs: DataFrame, text: str, n: int, fragments: int) -> DataFrame:
    """(node, fragment, grams): the set of every row cut into ranges of the global order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in slices(batch.column(0), lower=True):
                grams, first = shingle_sets(texts, n)
                node = np.repeat(signed(set_keys(grams, first)), fragments)
                which = np.tile(np.arange(fragments, dtype=np.int32), texts.rows)
                owner = np.repeat(np.arange(texts.rows), np.diff(first))
                part = ((grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
                bounds = np.searchsorted(owner * fragments + part, np.arange(texts.rows * fragments + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(which), lists(signed(grams), bounds)], ["node", "fragment", "grams"]
                )

    return docs.select(F.col(text).cast("binary").alias("_text")).mapInArrow(cut, "node long, fragment int, grams array<long>")


def join_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85
) -> DataFrame:
    """``_key``, ``size``, ``node``, ``component`` (smallest key reachable by links) of every row."""
    spark = docs.sparkSession
    rows = materialise(text_nodes(docs, key, text, n), "nodes")
    totals = rows.agg(F.sum("size").alias("grams"), F.max("size").alias("most")).first()
    total, most = totals["grams"] or 0, totals["most"] or 0
    # Fragments of a set number about 0.56 of its size at 85 percent; bound a part by its signatures.
    expected = total * 3.2 * (100 - percent) / percent
    parts = shuffle_width(spark, expected / SIGNATURES_PER_PART + 1)
    involved = materialise(shared_fragments(docs, text, n, percent, most, parts), "involved")
    of_node = rows.where("node is not null").groupBy("node").agg(F.min("_key").alias("least"), F.min("size").alias("size"))
    # One row per node whose set is needed, chosen by its smallest key (or any row if it has none).
    wanted = rows.join(involved, "node").groupBy("node").agg(F.min("_key").alias("_key")).select("_key").distinct()
    texts = docs.join(wanted, docs[key].eqNullSafe(wanted["_key"]), "left_semi").select(F.col(text))
    sets = materialise(segments(texts, text, n, FRAGMENTS).dropDuplicates(["node", "fragment"]), "sets")

    grams = rare_grams(sets, of_node.select("node", "size"), percent)
    met = grams.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.bitwise_not("sig").alias("other"))
    grams = grams.withColumn("other", F.bitwise_not("sig")).join(met, "other").select("sig", "node", "info")
    buckets = materialise(grams, "buckets")

    def verify(pairs: DataFrame) -> DataFrame:
        size = of_node.select("node", "size")
        sized = (
            pairs.join(size.select(F.col("node").alias("a"), F.col("size").alias("na")), "a")
            .join(size.select(F.col("node").alias("b"), F.col("size").alias("nb")), "b")
            .where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
        )
        one = sized.join(sets.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("ga")), "a")
        both = one.join(sets.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("gb")), ["b", "fragment"])
        partial = both.select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("long").alias("overlap"))
        total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
        return total.where(f"100 * overlap >= {percent} * (na + nb - overlap)").select("a", "b")

    def possible(a: Column, b: Column) -> Column:
        """The overlap is at most the sum, over 32 ranges of the order, of what the poorer of the two
        has in common with any other set."""
        poorer = F.zip_with(a["common"], b["common"], lambda x, y: F.least(x, y))
        overlap = F.aggregate(poorer, F.lit(0).cast("long"), lambda acc, x: acc + x)
        return 100 * overlap >= percent * (a["size"] + b["size"] - overlap)

    groups = bucket_components(buckets, verify, possible)
    # Links run between nodes; a component's id is the smallest key of its rows.
    named = groups.join(of_node, "node", "left").groupBy("component").agg(F.min("least").alias("id"))
    linked = groups.join(named, "component").select("node", "id")
    labels = of_node.join(linked, "node", "left").select("node", F.coalesce("id", "least").alias("component"))
    return rows.join(labels, "node", "left").select(
        "_key", "size", "node", F.when(F.col("node").isNull(), F.col("_key")).otherwise(F.col("component")).alias("component")
    )


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """Key, n_shingles, component_id of every row."""
    found = join_components(docs, key, text, n, percent)
    return found.select(F.col("_key").alias(key), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows and columns of ``docs`` whose key is the smallest of their component. Rows that are equal in
    every column stay once; rows with a null key all stay."""
    found = join_components(docs, key, text, n, percent)
    kept = found.where("_key = component").select("_key").distinct()
    rest = docs.join(kept, docs[key] == kept["_key"], "left_semi")
    # Maps cannot be compared; their text can.
    maps = {f"_map{i}": F.to_json(F.struct(F.col(f.name))) for i, f in enumerate(docs.schema) if "map<" in f.dataType.simpleString()}
    plain = [c for c, kind in docs.dtypes if "map<" not in kind]
    once = rest.withColumns(maps).dropDuplicates([*plain, *maps]).drop(*maps)
    return once.unionByName(docs.where(docs[key].isNull()))
