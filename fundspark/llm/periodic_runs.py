"""Periodic runs of words by an online sparse diagonal programme.

A run is a stretch of consecutive words with smallest period q that no neighbour extends. On the
diagonal of lag q (word i against word i - q) it is one unbroken stretch of matches, ``length - q``
long. The programme reads a text's words in order; for each word, its earlier occurrences add one to
the match length of their lag, and a lag that the next word does not extend emits its run at once if
the stretch is long enough.

Sparse means that an occurrence is visited only if it can still matter. A run of lag q has at least
``max(least - q, 2 q)`` matches, so an earlier occurrence counts once the ``width`` words before it
agree as well, ``width`` being a lower bound of that: ``ceil(2 least / 3)`` for lags up to it, then
doubled for each doubling of the lag. With windows at least as long as the lag, only the most recent
such occurrence can carry a run: were there a nearer one, at lag e < q, the window would have the
periods e and q - e, by Fine and Wilf hence a period that divides q, and so would the whole run. Each
word therefore has at most one live lag per doubling, and a text of n words takes n log n steps
however often a word or passage is repeated; nothing is cut off or sampled.

Each text is read whole and alone, without a shuffle, so hot sources and groups of copies do not
matter. Defined results: a null or empty text has no runs and collapses to the empty string; repeated
rows give repeated results; a null key is passed through; an empty table gives an empty table. Only
the key and the text are read, other columns and their names play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix, ngrams, slices

LEAST, EXPONENT = 24, 3
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def occurrences(words: np.ndarray, first: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(word, lag, width) of every match that enters the programme, ordered by word: the ``width``
    words up to it occur also ``lag`` words before, and no nearer."""
    width = max(1, -(-2 * least // 3))
    found, low, alive = [], 0, None
    while True:
        at, window = ngrams(words, first, width)
        if alive is not None:
            kept = alive[at]
            at, window = at[kept], window[kept]
        if not len(at):
            break
        # The same window in the same text; positions ascend inside each group.
        group = window ^ mix(doc[at].astype(np.uint64) + np.uint64(1))
        order = np.argsort(group, kind="stable")
        same = group[order[1:]] == group[order[:-1]]
        here, before = at[order[1:][same]], at[order[:-1][same]]
        lag = here - before
        fits = (lag > low) & (lag <= width)
        found.append((here[fits] + width - 1, lag[fits], np.full(int(fits.sum()), width)))
        # A longer window repeats only where this one does.
        alive = np.zeros(len(words), dtype=bool)
        alive[here] = alive[before] = True
        low, width = width, 2 * width
    if not found:
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing, nothing
    at, lag, width = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(at, kind="stable")
    return at[order], lag[order], width[order]


def diagonal_runs(
    at: np.ndarray, lag: np.ndarray, width: np.ndarray, least: int = LEAST, exponent: int = EXPONENT
) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text, from its matches in reading order."""
    active: dict[int, tuple[int, int]] = {}  # lag: last matching word, match length
    runs = []

    def end(d: int) -> None:
        last, match = active.pop(d)
        if match + d >= max(least, exponent * d):
            runs.append((last - match - d + 1, match + d, d))

    for i, d, w in zip(at.tolist(), lag.tolist(), width.tolist(), strict=True):
        for other in [x for x, (last, _) in active.items() if last < i - 1]:
            end(other)
        last, match = active.get(d, (i, w - 1))
        active[d] = (i, match + 1)
    for d in list(active):
        end(d)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def periodic_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST,
    exponent: int = EXPONENT,
    order: Callable[[object, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """Key, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``, the
    text without what runs repeat: the words after each run's first period are dropped, the others
    joined by one space.

    A run has at least ``least`` words and ``exponent`` (at least 3) periods. ``order(key, n)`` may
    give the order in which the n words of a text are read, or None for their own.
    """
    if exponent < 3:
        raise ValueError("exponent must be at least 3")
    kind = dict(docs.dtypes)[key]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(1)):
                words, first = texts.word_hash(), texts.first
                keys = batch.column(0)[low:high]
                moved = {}
                if order is not None:
                    for row, value in enumerate(keys.to_pylist()):
                        index = order(value, int(first[row + 1] - first[row]))
                        if index is not None:
                            moved[row] = index
                            words[first[row] : first[row + 1]] = words[first[row] + index]
                at, lag, width = occurrences(words, first, texts.doc, least)
                bounds = np.searchsorted(at, first)
                values = batch.column(1)[low:high]
                counts, runs, bodies = [], [], []
                for row, value in enumerate(values):
                    a, b = bounds[row], bounds[row + 1]
                    parts = (value.as_py() or b"").split()
                    counts.append(len(parts))
                    if row in moved:
                        parts = [parts[i] for i in moved[row].tolist()]
                    found = diagonal_runs(at[a:b] - first[row], lag[a:b], width[a:b], least, exponent) if b > a else []
                    for start, length, period in found:
                        parts[start + period : start + length] = [None] * (length - period)
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                    bodies.append(b" ".join(x for x in parts if x is not None) if found else b" ".join(parts))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(counts, pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(bodies, pa.binary())],
                    [key, "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(key), F.col(text).cast("binary"))
    found = rows.mapInArrow(
        search, f"`{key}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    )
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def repeated_tail(key: object, n: int) -> np.ndarray | None:
    """The word order of the query's planted runs: a tenth of the keys repeat a tail of their text."""
    if key is None or not n:
        return None
    h = zlib.crc32(str(key).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    index = np.arange(n)
    index[a:] = a + (index[a:] - a) % period
    return index


def run_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, n_runs, the run of greatest exact length / period, and digests of runs and text."""
    better = lambda b, r: F.when(b.isNull() | (r.length * b.period > b.length * r.period), r).otherwise(b)
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = found.withColumn("_best", F.aggregate("runs", none, better))
    return best.select(
        F.col(key),
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
