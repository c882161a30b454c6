"""Repeated passages by prefix-partitioned suffix trees.

A passage of ``window`` words that two documents hold is a node of at least that depth in the tree of
all word suffixes. The tree is never built as a whole: its suffixes are split by prefixes, and each
group's subtree is grown in one task as sorted suffixes with the lengths of their common prefixes,
which is a suffix tree in array form.

* Suffixes. Of the prefixes of ``prefix`` words inside a window the one of the smallest hash stands for
  the window, so equal windows have equal representatives and about one suffix in twenty is needed: an
  anchor. Every window lies in the context of its anchor, ``window - prefix`` words before it and
  ``window`` from it on. One pass over the texts lists the anchors of every document (kept as a table).
* Leaves. An anchor's prefix that one document holds alone is a leaf; it is dropped with all below it.
* Copies. Anchors of equal context are one suffix; its smallest document stands for them. A prefix
  with one context needs no subtree: all its windows are held by that document.
* Groups. The other contexts are grouped by their prefix. A group of more than ``MOST_SUFFIXES`` gets a
  longer prefix: it is split into two groups of suffixes, starting at the anchor and some words before
  it, whose prefixes are half-way longer, and so on until groups fit or a prefix is the whole window
  (then one aggregate per window is enough). So a phrase that very many documents share, with other
  words around it, is no hot spot.
* Subtrees. Inside a task the suffixes of its groups are sorted; the common prefix lengths of neighbours
  give the nodes of every depth. A node at depth ``window - b`` whose suffixes agree in the ``b`` words
  before as well is a window; those two documents hold are repeats, adjoining ones a maximal repeat.

Texts are moved twice at most, and only those of documents that are needed: documents that hold one of
several contexts of a prefix, then documents that lose words. A bitmap of ``BITS`` bits, broadcast, keeps
the others where they are (a clash of bits moves a text in vain, nothing else). All other tables
hold hashes. A passage that a third of all documents hold is one row after the aggregates, and the joins
back are plain joins on a key of their own, which Spark splits.

Defined results: a null text has no words; repeated rows, and different rows of one key, do not
remove each other's words but both lose what a smaller key holds; a row with a null key loses
nothing and removes nothing. An empty table gives an empty table. Only key and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialise, shuffle_width
from .words import WORD_BASE, Texts, mix, ngrams, signed, slices, spans_hash

WINDOW, PREFIX = 50, 12
MOST_SUFFIXES = 20_000  # suffixes of a group; 8 (2 window - prefix) bytes each
PART_SUFFIXES = 60_000  # suffixes of a task, about
BITS = 1 << 25  # bound of the broadcast bitmap: 4 MB
ODD = np.uint64(0x9E3779B97F4A7C15)


def anchors(texts: Texts, words: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, prefix hash, context hash) of the representative prefix of every window of the slice."""
    at, _ = ngrams(words, texts.first, window)
    if not len(at):
        nothing = np.zeros(0, dtype=np.uint64)
        return at, nothing, nothing
    where, hashes = ngrams(words, texts.first, prefix)
    value = np.full(len(words), np.iinfo(np.uint64).max, dtype=np.uint64)
    value[where] = hashes
    # Place of the running minimum over window - prefix + 1 positions, by doubling; the first of equals.
    best, have, width = np.arange(len(words)), 1, window - prefix + 1
    while have < width:
        step = min(have, width - have)
        other = best[step:]
        best[:-step] = np.where(value[other] < value[best[:-step]], other, best[:-step])
        have += step
    at = np.unique(best[at])
    low, high = context(texts, at, window, prefix)
    whole = mix(spans_hash(words, low, high, WORD_BASE) ^ (ODD * (at - low + 1).astype(np.uint64)))
    return at, value[at], whole


def context(texts: Texts, at: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the words that windows around the anchors can hold."""
    row = texts.doc[at]
    return np.maximum(at - (window - prefix), texts.first[row]), np.minimum(at + window, texts.first[row + 1])


def node_name(column: str) -> Column:
    """A hash under a name of its own, so that a join deals both sides out by it anew and a value with
    very many rows can be split."""
    return F.bitwise_not(column).alias("_node")


def involved(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``rows(_key, _row, ..)`` whose key and row hash may be in ``wanted``, with no shuffle of
    ``rows``: a bitmap of at most ``BITS`` bits is broadcast."""
    size = 1 << 15  # bits of one bitmap
    spot = F.pmod(F.xxhash64("_key", "_row"), F.lit(BITS))
    marks = wanted.select((spot / size).cast("long").alias("_bucket"), (spot % size).alias("_bit"))
    bitmap = materialise(marks.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "bitmap")
    met = rows.withColumns({"_bucket": (spot / size).cast("long"), "_bit": spot % size}).join(F.broadcast(bitmap), "_bucket")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1 = 1")
    return met.withColumn("_byte", byte).where(hit).drop("_bucket", "_bit", "_bits", "_byte")


def scan(docs: DataFrame, key: str, text: str, window: int, prefix: int) -> tuple[DataFrame, DataFrame]:
    """(rows, scanned): ``rows(_key, _text, _row)`` is the table itself; ``scanned`` has, for every row, the
    number of its words, the digest of its text and its anchors, and is kept in the shared folder."""
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text")).withColumn(
        "_row", F.xxhash64("_text")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(1)):
                at, prefixes, wholes = anchors(texts, texts.word_hash(), window, prefix)
                row = texts.doc[at]
                bounds = pa.array(np.searchsorted(row, np.arange(texts.rows + 1)).astype(np.int32))
                digests = [hashlib.sha256(b" ".join((v.as_py() or b"").split())).hexdigest() for v in batch.column(1)[low:high]]
                columns = ((at - texts.first[row]).astype(np.int32), signed(prefixes), signed(wholes))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high], batch.column(2)[low:high], pa.array(np.diff(texts.first).astype(np.int64)),
                        pa.array(digests), *[pa.ListArray.from_arrays(bounds, pa.array(c)) for c in columns],
                    ],
                    ["_key", "_row", "n_words", "digest", "at", "prefix", "whole"],
                )

    schema = f"_key {kind}, _row long, n_words long, digest string, at array<int>, prefix array<long>, whole array<long>"
    return rows, materialise(rows.mapInArrow(read, schema), "anchors")


def contexts(rows: DataFrame, holders: DataFrame, kind: str, window: int, prefix: int) -> DataFrame:
    """The words of the contexts ``holders(_key, _row, held)`` names: whole, least, most, left, right, words
    (hashes, ``window - prefix`` of them before the anchor, 0 where the text has ended)."""
    left = window - prefix
    columns = f"prefix long, whole long, least {kind}, most {kind}, left int, right int, words binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(2).to_pylist()
            for low, high, texts in slices(batch.column(1)):
                words = texts.word_hash()
                out: list[list] = [[] for _ in range(7)]
                for row in range(high - low):
                    first, last = texts.first[row], texts.first[row + 1]
                    key = batch.column(0)[low + row].as_py()
                    for one in held[low + row]:
                        j = first + one["at"]
                        a, b = max(first, j - left), min(last, j + window)
                        matrix = np.zeros(left + window, dtype=np.uint64)
                        matrix[left - (j - a) : left + b - j] = words[a:b]
                        for column, x in zip(out, (one["prefix"], one["whole"], key, one["most"], j - a, b - j, matrix.tobytes()), strict=True):
                            column.append(x)
                most = pa.array(out[3], type=batch.schema.field(2).type.value_type.field("most").type)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], batch.schema.field(0).type), most,
                        pa.array(out[4], pa.int32()), pa.array(out[5], pa.int32()), pa.array(out[6], pa.binary()),
                    ],
                    ["prefix", "whole", "least", "most", "left", "right", "words"],
                )

    texts = involved(rows, holders.select("_key", "_row")).join(holders, ["_key", "_row"])
    # Rows that repeat a key and its text hold the same contexts: one of them is enough.
    found = texts.select("_key", "_text", "held").mapInArrow(cut, columns).dropDuplicates(["whole"])
    return found.select(F.col("prefix").alias("group"), F.lit(0).alias("shift"), F.lit(prefix).alias("depth"), *found.columns[1:])


def matrix_of(column: pa.ChunkedArray, width: int) -> np.ndarray:
    parts = [b"".join(chunk.to_pylist()) for chunk in column.chunks]
    return np.frombuffer(b"".join(parts), dtype=np.uint64).reshape(-1, width)


def lengthened(items: DataFrame, window: int, prefix: int) -> DataFrame:
    """The suffixes of oversized groups under prefixes half-way to the window: each twice, starting where
    it did and as many words before as its longer prefix leaves out."""
    left = window - prefix
    names = items.columns

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            words = matrix_of(table.column("words"), left + window)
            shift, depth, before, after = (table.column(c).to_numpy() for c in ("shift", "depth", "left", "right"))
            longer = depth + (window - depth + 1) // 2
            for more in (np.zeros(len(longer), dtype=np.int64), window - longer + 1):
                start = shift + more
                fits = np.flatnonzero((start <= before) & (longer - start <= after))
                if not len(fits):
                    continue
                group = np.zeros(len(fits), dtype=np.uint64)
                for size, s in {(int(n), int(s)) for n, s in zip(longer[fits], start[fits], strict=True)}:
                    at = np.flatnonzero((longer[fits] == size) & (start[fits] == s))
                    value = np.full(len(at), size * 1000 + s, dtype=np.uint64)
                    for column in range(left - s, left - s + size):
                        value = mix(value * np.uint64(WORD_BASE) + words[fits[at], column])
                    group[at] = value
                new = {"group": signed(group), "shift": start[fits].astype(np.int32), "depth": longer[fits].astype(np.int32)}
                rest = table.take(pa.array(fits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new[c]) if c in new else rest.column(c).combine_chunks() for c in names], names
                )

    return items.mapInArrow(split, items.schema)


def subtree_windows(items: DataFrame, kind: str, parts: int, window: int, prefix: int) -> DataFrame:
    """(whole, low, high, least): the windows that start ``low`` to ``high`` words before the anchor of a
    context, with the smallest document that holds them, where that is not the context's own largest."""
    left = window - prefix

    def grow(table: pa.Table) -> pa.Table:
        words = matrix_of(table.column("words"), left + window)
        shift, depth, before, after = (table.column(c).to_numpy() for c in ("shift", "depth", "left", "right"))
        names, rank = np.unique(np.array(table.column("least").to_pylist()), return_inverse=True)
        most = np.searchsorted(names, np.array(table.column("most").to_pylist()), side="left")
        least = np.full((len(words), left + 1), len(names), dtype=np.int64)  # smallest document of each window
        for s, size in sorted({(int(a), int(b)) for a, b in zip(shift, depth, strict=True)}):
            mine = np.flatnonzero((shift == s) & (depth == size))
            suffix = words[mine, left - s : left - s + window]
            order = np.lexsort(suffix.T[::-1])
            mine, suffix = mine[order], suffix[order]
            common = np.cumprod(suffix[1:] == suffix[:-1], axis=1, dtype=np.int8).sum(axis=1)
            behind = np.zeros(len(mine), dtype=np.uint64)  # hash of the words before the suffix
            for b in range(min(window - size, left - s) + 1):
                if b:
                    behind = mix(behind * np.uint64(WORD_BASE) + words[mine, left - s - b])
                whole = np.flatnonzero((before[mine] >= s + b) & (after[mine] >= window - s - b))
                if not len(whole):
                    continue
                node = np.concatenate([[0], np.cumsum(common < window - b)]).astype(np.uint64)
                name = mix(behind[whole] ^ (ODD * (node[whole] + np.uint64(1))))
                by = np.argsort(name, kind="stable")
                start = np.flatnonzero(np.concatenate([[True], name[by][1:] != name[by][:-1]]))
                low = np.minimum.reduceat(rank[mine[whole[by]]], start)
                found = np.repeat(low, np.diff(np.append(start, len(by))))
                at = mine[whole[by]]
                least[at, s + b] = np.minimum(least[at, s + b], found)
        # Neighbouring windows of one document are one row.
        held = least < most[:, None]
        value = np.where(held, least, -1)
        edge = np.ones_like(held)
        edge[:, 1:] = value[:, 1:] != value[:, :-1]
        row, low = np.nonzero(edge)
        high = np.append(low[1:] - 1, left)
        high[np.append(low[1:] == 0, False)] = left
        kept = value[row, low] >= 0
        row, low, high = row[kept], low[kept], high[kept]
        return pa.table(
            {
                "whole": table.column("whole").take(pa.array(row)), "low": low.astype(np.int32), "high": high.astype(np.int32),
                "least": pa.array(names[value[row, low]].tolist(), type=table.schema.field("least").type),
            }
        )

    dealt = items.withColumn("part", F.pmod(F.xxhash64("group"), F.lit(parts)))
    return dealt.groupBy("part").applyInArrow(grow, f"whole long, low int, high int, least {kind}")


def repeats_of_contexts(items: DataFrame, kind: str, window: int, prefix: int, most: int = MOST_SUFFIXES) -> DataFrame:
    """(whole, low, high, least) of all contexts, groups of more than ``most`` suffixes being split first."""
    spark = items.sparkSession
    items, found = materialise(items, "suffixes"), []
    while True:
        sizes = items.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
        heavy = materialise(sizes.where(F.col("n") > most).select(node_name("group")), "heavy")
        large = not heavy.isEmpty()
        met = items.withColumn("_node", F.bitwise_not("group"))
        fits = met.join(heavy, "_node", "left_anti").drop("_node") if large else items
        total = fits.count()
        if total:
            parts = shuffle_width(spark, total / PART_SUFFIXES + 1)
            found.append(subtree_windows(fits, kind, parts, window, prefix))
        if not large:
            break
        longer = lengthened(met.join(heavy, "_node", "left_semi").drop("_node"), window, prefix)
        items = materialise(longer, "suffixes")
        # A prefix as long as the window names the window itself.
        last = items.where(F.col("depth") == window)
        low = last.groupBy("group").agg(F.min("least").alias("_least")).withColumn("_node", F.bitwise_not("group")).drop("group")
        named = last.withColumn("_node", F.bitwise_not("group")).join(low, "_node").where("_least < most")
        found.append(named.select("whole", F.col("shift").alias("low"), F.col("shift").alias("high"), F.col("_least").alias("least")))
        items = materialise(items.where(F.col("depth") < window), "suffixes")
    if not found:
        return spark.createDataFrame([], f"whole long, low int, high int, least {kind}")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def repeated_words(
    docs: DataFrame, key: str, text: str, window: int = WINDOW, prefix: int = PREFIX, most: int = MOST_SUFFIXES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, scanned, places): ``places(_key, _row, spans)`` lists the spans of words (first, end) of a row
    that lie in windows a smaller key holds too."""
    kind, left = dict(docs.dtypes)[key], window - prefix
    rows, scanned = scan(docs, key, text, window, prefix)
    listed = scanned.where("_key is not null").select(
        "_key", "_row", "n_words", F.explode(F.arrays_zip("at", "prefix", "whole")).alias("a")
    ).select("_key", "_row", "n_words", "a.*")
    # Prefixes that two documents hold; of the others' anchors nothing is kept.
    ends = listed.groupBy("prefix").agg(F.min("_key").alias("low"), F.max("_key").alias("high"))
    shared = ends.where("low < high").select(node_name("prefix"))
    kept = listed.withColumn("_node", F.bitwise_not("prefix")).join(shared, "_node").drop("_node")
    kept = materialise(kept, "shared")
    one = kept.groupBy("prefix", "whole").agg(F.min(F.struct("_key", "_row", "at")).alias("first"), F.max("_key").alias("most"))
    one = materialise(one, "contexts")
    many = one.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(node_name("prefix"))
    named = one.withColumn("_node", F.bitwise_not("prefix"))
    alone = named.join(many, "_node", "left_anti").where("first._key < most")
    alone = alone.select("whole", F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("high"), F.col("first._key").alias("least"))
    holders = (
        named.join(many, "_node", "left_semi")
        .groupBy(F.col("first._key").alias("_key"), F.col("first._row").alias("_row"))
        .agg(F.collect_list(F.struct(F.col("first.at").alias("at"), "prefix", "whole", "most")).alias("held"))
    )
    items = contexts(rows, materialise(holders, "holders"), kind, window, prefix)
    found = repeats_of_contexts(items, kind, window, prefix, most).unionByName(alone)
    met = kept.withColumn("_node", F.bitwise_not("whole")).join(found.withColumn("_node", F.bitwise_not("whole")).drop("whole"), "_node")
    # All windows of a context: they start where the text allows it.
    low = F.coalesce("low", F.greatest(F.lit(0), (F.col("at") + window - F.col("n_words")).cast("int")))
    high = F.coalesce("high", F.least(F.lit(left), F.col("at")))
    spans = met.where("least < _key").select("_key", "_row", "at", low.alias("low"), high.alias("high")).where("low <= high")
    span = F.struct((F.col("at") - F.col("high")).alias("first"), (F.col("at") - F.col("low") + window).alias("end"))
    places = spans.select("_key", "_row", span.alias("span")).groupBy("_key", "_row").agg(F.collect_set("span").alias("spans"))
    return rows, scanned, places


def stripped(texts: DataFrame, kind: str, whole: bool) -> DataFrame:
    """``texts(_key, _row, _text, spans)`` without the words of their spans: counts, digest and, if ``whole``, text."""

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for value, spans in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                words = (value.as_py() or b"").split()
                kept = words
                if spans:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(change, [s["first"] for s in spans], 1)
                    np.add.at(change, [s["end"] for s in spans], -1)
                    kept = list(compress(words, np.cumsum(change[:-1]) == 0))
                body = b" ".join(kept)
                row = (len(words), len(words) - len(kept), hashlib.sha256(body).hexdigest(), body if whole else None)
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *arrays], ["_key", "_row", "n_words", "n_removed", "kept_sha256", "kept_text"]
            )

    schema = f"_key {kind}, _row long, n_words long, n_removed long, kept_sha256 string, kept_text binary"
    return texts.select("_key", "_row", "_text", "spans").mapInArrow(strip, schema)


def drop_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, prefix: int = PREFIX, most: int = MOST_SUFFIXES
) -> DataFrame:
    """Key, n_words, n_removed, kept_sha256 and ``kept_text`` (kept words joined by one space). All texts are
    moved once more for it; ``repeat_digest`` moves only those that lose words."""
    kind = dict(docs.dtypes)[key]
    rows, _, places = repeated_words(docs, key, text, window, prefix, most)
    out = stripped(rows.join(places, ["_key", "_row"], "left"), kind, whole=True)
    return out.select(F.col("_key").alias(key), "n_words", "n_removed", "kept_sha256", F.col("kept_text").cast("string").alias("kept_text"))


def repeat_digest(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, prefix: int = PREFIX, most: int = MOST_SUFFIXES
) -> DataFrame:
    """Key, n_words, n_removed, kept_sha256 of every row."""
    kind = dict(docs.dtypes)[key]
    rows, scanned, places = repeated_words(docs, key, text, window, prefix, most)
    places = materialise(places, "spans")
    changed = stripped(involved(rows, places).join(places, ["_key", "_row"]), kind, whole=False)
    changed = changed.select("_key", "_row", "n_removed", "kept_sha256").dropDuplicates(["_key", "_row"])
    out = scanned.select("_key", "_row", "n_words", "digest").join(changed, ["_key", "_row"], "left")
    return out.select(
        F.col("_key").alias(key), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"),
    )
