"""Best-fit packing of tokenised documents, after Martello and Toth's dominance reduction.

A document is its token ids followed by one separator id. Documents longer than the capacity are cut
from the end into full pieces (the first piece takes what is left); every other document is one
piece. Pieces of equal length are interchangeable, so the packing is worked out on the histogram of
lengths: at most ``CAPACITY`` counters, whatever the number of documents. First the reduction
fixes bins that provably dominate every alternative (a piece that nothing fits beside; a piece
with the partner that fills its bin or is the largest that fits when no two pieces do; three
pieces that fill a bin better than any pair), each as often as the counters allow. What is left is
packed best-fit by decreasing length. The result is a list of runs "so many pieces of this length
go to these bins at this offset"; pieces are numbered inside their length and find their run by a
search in that list, which is bounded by the capacity and not by the data.

With a mixture, equal pieces are ranked by their document's place in it, so that a run takes the
earliest, and sequences are numbered by the place of their longest piece (the one at offset 0).
Without, equal pieces are ranked by a hash and sequences are numbered run by run.

Defined results: a null or empty text is one piece holding the separator alone; repeated rows are
packed one by one; rows with a null key are packed like others; an empty table gives an empty
table. Only key, text and (with a mixture) source are read.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mixing import BLOCK_CHARS, PERIOD, placed, tags
from .shared import materialise, ranked, shuffle_width

CAPACITY = 2048
SEPARATOR = 0
CACHE_ENTRIES = 400_000  # chunks remembered inside a task, dropped when full
MOST_RUNS = 2_000_000

# A single space between two visible characters: no token of byte-level BPE crosses its left side.
CHUNK = regex.compile(r"(?<=\S) (?=\S)")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkEncoder:
    """Ids of whole texts as little-endian 32-bit bytes, encoding every distinct chunk once.

    The vocabulary and the merge order are read from the tokenizer's file; the merges are applied by
    ``tiktoken``, which gives the same ids as ``tokenizers`` in a quarter of the time (a test compares
    them). The file's added tokens are cut out of the text first and have their own ids, as the library
    has it unless told otherwise; what lies between them is encoded on its own.
    """

    def __init__(self, path: str):
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary = file["model"]["vocab"]
        added = file.get("added_tokens") or []
        if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.added = {t["content"]: array("I", [t["id"]]).tobytes() for t in added if t["content"]}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        # Byte-level vocabularies write each byte as a printable character.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if all(c in byte_of for c in t) and t not in self.added}
        self.one = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.cache: dict[str, bytes] = {}  # by chunk, without the space before it

    def ids(self, chunk: str) -> bytes:
        return array("I", self.one(chunk)).tobytes()

    def encode(self, text: str) -> bytes:
        """Bytes of the ids of a text."""
        if self.cut is None or not (found := list(self.cut.finditer(text))):
            return self.plain(text)
        ends = [0, *(m.end() for m in found)]
        between = [self.plain(text[a : m.start()]) + self.added[m.group()] for a, m in zip(ends, found, strict=False)]
        return b"".join(between) + self.plain(text[ends[-1] :])

    def plain(self, text: str) -> bytes:
        """Bytes of the ids of a text without added tokens."""
        first, *rest = text.split(" ")
        cache = self.cache
        new = set(rest).difference(cache)
        if not self.alone(first) or not all(map(self.alone, new)):
            first, *rest = CHUNK.split(text)
            return self.ids(first) + b"".join([cache.get(c) or self.ids(" " + c) for c in rest])
        if len(cache) + len(new) > CACHE_ENTRIES:
            cache.clear()
            new = set(rest)
        for c in new:
            cache[c] = self.ids(" " + c)
        return self.ids(first) + b"".join(map(cache.__getitem__, rest))

    @staticmethod
    def alone(chunk: str) -> bool:
        """White space neither begins nor ends the chunk, so that it has the same ids in every text.
        Others belong with their neighbours and are not remembered."""
        return bool(chunk) and not (chunk[0].isspace() or chunk[-1].isspace())


def token_pieces(docs: DataFrame, key: str, text: str, path: str, capacity: int, passed: tuple[str, ...] = ()) -> DataFrame:
    """Key, piece, start, length, ids_crc32 of every piece, and the ``passed`` columns of its document."""
    types = dict(docs.dtypes)
    end = np.array([SEPARATOR], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path)
        for batch in batches:
            rows, out = [], ([], [], [], [])
            for i, value in enumerate(batch.column(1)):
                ids = encoder.encode(value.as_py() or "") + end
                total = len(ids) // 4
                first = total if total <= capacity else total % capacity or capacity
                cuts = [0, *range(first, total + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append(i)
                    for column, x in zip(out, (piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])), strict=True):
                        column.append(x)
            arrays = [pa.array(out[0], pa.int32()), *(pa.array(x, pa.int64()) for x in out[1:])]
            of_row = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of_row), *arrays, *(c.take(of_row) for c in batch.columns[2:])],
                [key, "piece", "start", "length", "ids_crc32", *passed],
            )

    schema = f"`{key}` {types[key]}, piece int, start long, length long, ids_crc32 long"
    return docs.select(key, text, *passed).mapInArrow(pieces, schema + "".join(f", {c} {types[c]}" for c in passed))


class Lengths:
    """A multiset of piece lengths."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n}
        self.sizes = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def largest(self, room: int, besides: dict[int, int]) -> int | None:
        """The largest length of at most ``room`` of which more are left than ``besides`` names."""
        i = bisect_right(self.sizes, room) - 1
        while i >= 0 and self.count[self.sizes[i]] <= besides.get(self.sizes[i], 0):
            i -= 1
        return self.sizes[i] if i >= 0 else None

    def smallest(self, besides: dict[int, int], k: int) -> list[int]:
        """The ``k`` smallest pieces (fewer if there are no more) besides those named."""
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(k - len(out), self.count[s] - besides.get(s, 0))
            if len(out) == k:
                break
        return out


def best_pair(left: Lengths, room: int, besides: dict[int, int]) -> tuple[int, int] | None:
    """Two further pieces with the largest sum of at most ``room``."""
    best = None
    for a in left.sizes:
        if left.count[a] <= besides.get(a, 0) or 2 * a > room:
            continue
        b = left.largest(room - a, {**besides, a: besides.get(a, 0) + 1})
        if b is not None and b >= a and (best is None or a + b > sum(best)):
            best = (a, b)
    return best


def reduce_by_dominance(left: Lengths, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating bins: (lengths in a bin, how many such bins). Takes them out of ``left``.

    A bin {j, b} dominates when it is full, when no two other pieces fit beside j, or when the
    best pair beside j is no heavier than b alone and at most two fit; a bin {j, a, b} dominates
    when it is full, at most two pieces fit beside j, and a and b differ by no more than the
    smallest piece. Lengths for which none holds are left to best fit.
    """
    fixed = []
    for j in sorted(left.count, reverse=True):
        while left.count.get(j):
            own, room = {j: 1}, capacity - j
            small = left.smallest(own, 3)
            beside = sum(1 for k in range(1, len(small) + 1) if sum(small[:k]) <= room)
            if beside == 0:
                bin_ = (j,)
            else:
                b = left.largest(room, own)
                if b == room or beside == 1:
                    bin_ = (j, b)
                elif beside == 2 and (pair := best_pair(left, room, own)):
                    if b >= sum(pair):
                        bin_ = (j, b)
                    elif sum(pair) == room and pair[1] - pair[0] <= small[0]:
                        bin_ = (j, *pair)
                    else:
                        break
                else:
                    break
            need = {s: bin_.count(s) for s in bin_}
            times = min(left.count[s] // n for s, n in need.items())
            for s, n in need.items():
                left.take(s, n * times)
            fixed.append((bin_, times))
    return fixed


def best_fit(left: Lengths, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by decreasing length on runs of equal bins: (lengths in a bin, how many)."""
    rooms: list[int] = []
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    full = []

    def put(bin_: tuple[int, ...], n: int, room: int) -> None:
        if room == 0:
            full.append((bin_, n))
            return
        if room not in open_bins:
            insort(rooms, room)
            open_bins[room] = []
        open_bins[room].append((bin_, n))

    for size in sorted(left.count, reverse=True):
        n = left.count[size]
        while n:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                each = capacity // size
                whole, rest = divmod(n, each)
                if whole:
                    put((size,) * each, whole, capacity - size * each)
                if rest:
                    put((size,) * rest, 1, capacity - size * rest)
                break
            room = rooms[i]
            bin_, have = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(i)
            used = min(have, n)
            if have > used:
                put(bin_, have - used, room)
            put((*bin_, size), used, room - size)
            n -= used
    return full + [x for bins in open_bins.values() for x in bins]


def runs(bins: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Per length and rank: start key (length * 2**40 + first rank), first sequence, offset."""
    rank: dict[int, int] = {}
    start, sequence, offset = [], [], []
    base = 0
    for bin_, n in bins:
        at = 0
        for size in bin_:
            first = rank.get(size, 0)
            start.append((size << 40) + first)
            sequence.append(base)
            offset.append(at)
            rank[size] = first + n
            at += size
        base += n
    order = np.argsort(np.array(start, dtype=np.int64), kind="stable")
    pick = lambda x: np.array(x, dtype=np.int64)[order]
    return pick(start), pick(sequence), pick(offset), base


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Bins for a histogram of lengths: (lengths in a bin, how many such bins)."""
    left = Lengths(counts)
    return reduce_by_dominance(left, capacity) + best_fit(left, capacity)


TAGS = ("mix_source", "_mix_chars", "_mix_hash")
PLACE = ("mix_slot", "mix_source", "mix_place")


def mixed_pieces(pieces: DataFrame, weights: dict[str, float] | None, block_chars: int, period: int) -> DataFrame:
    """The pieces with their document's place in the mixture instead of its tags. Documents of one
    key, text and source are equal and take the first one's place."""
    places = placed(pieces.where("piece = 0").select(*TAGS), weights, block_chars, period)
    first = places.groupBy("mix_source", "_mix_hash").agg(F.min(F.struct("mix_slot", "mix_place")).alias("_at"))
    columns = [F.col(f"`{c}`") for c in pieces.columns if c not in TAGS]
    whole = pieces.join(first, ["mix_source", "_mix_hash"], "left")
    return whole.select(*columns, F.col("_at.mix_slot"), "mix_source", F.col("_at.mix_place"))


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY,
    mix: dict | None = None, source: str = "source",
) -> DataFrame:
    """Key, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    ``mix`` has options of ``mixing.mix_sources`` (weights, block_chars, period); with it, even empty,
    pieces and sequences follow that mixture.
    """
    spark = docs.sparkSession
    path, order, chunk, extra = path or tokenizer_path(), [key, "piece", "start", "ids_crc32"], None, ()
    if mix is None:
        pieces = materialise(token_pieces(docs, key, text, path, capacity), "pieces")
    else:
        options = {"weights": None, "block_chars": BLOCK_CHARS, "period": PERIOD} | mix
        tagged = docs.select(key, text, *tags(key, text, source))
        pieces = materialise(token_pieces(tagged, key, text, path, capacity, TAGS), "pieces")
        pieces = materialise(mixed_pieces(pieces, **options), "mixed")
        # Slots hold equal amounts of text, so ranges of slots are chunks of about equal size.
        slots = (pieces.agg(F.max("mix_slot")).first()[0] or 0) + 1
        chunk = F.expr(f"mix_slot * {shuffle_width(spark, 64)} div {slots}")
        extra, order = PLACE, [*PLACE, *order]
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    start, sequence, offset, _ = runs(pack(counts, capacity))
    if len(start) > MOST_RUNS:
        raise RuntimeError(f"{len(start)} runs; the broadcast table takes {MOST_RUNS}")
    shared = spark.sparkContext.broadcast((start, sequence, offset))
    columns = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, sequence, offset = shared.value
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(start, (length << 40) + rank, side="right") - 1
            ids = sequence[at] + ((length << 40) + rank - start[at])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(ids), pa.array(offset[at])], [*columns, "sequence_id", "offset"]
            )

    passed = [F.col(f"`{c}`") for c in columns]
    numbered = ranked(pieces, ["length"], order, chunk=chunk).select(*passed, "_rank")
    kinds = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    packed = numbered.mapInArrow(place, f"{kinds}, sequence_id long, offset long")
    if mix is None:
        return packed
    packed = materialise(packed, "packed")
    heads = ranked(packed.where("offset = 0").select("sequence_id", "mix_slot", *order[1:]), [], order, chunk=chunk)
    named = heads.select(F.col("sequence_id").alias("_run_id"), F.col("_rank").alias("_number"))
    kept = [F.col(f"`{c}`") for c in columns if c not in extra]
    return packed.join(named, F.col("sequence_id") == F.col("_run_id")).select(*kept, F.col("_number").alias("sequence_id"), "offset")
