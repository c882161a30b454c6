"""Toxicity: a support vector machine on a gapped-subsequence string kernel with Nystrom landmarks.

The kernel k(s, t) of two units sums, over all sequences of three characters that both hold in order
but not necessarily next to each other, ``DECAY`` to the power of the two spans, up to a span of
``SPAN`` characters; it is divided by a norm that depends on the units' lengths. An inserted character
lengthens the span by one and so costs a factor, no more. A unit is a window of one to ``WINDOW``
consecutive words of a sentence, its spaces included: a space is a character of the kernel like any
other, so it bounds words, and a sequence may also skip it, so that an insult cut by spaces and a
phrase of harmless words have values of their own. Letters spelled out one by one are a unit without
the spaces between them. Case, compatibility forms (full-width letters and the like) and common
character substitutions are folded, accents are one kind, letters of other scripts fall into
``HASHED`` classes by their code points, and all other characters are skipped.

Training takes a bounded sample of labelled texts cut into sentences. A toxic text says that at least
one of its units is toxic, not which, so the machine is trained in rounds: the highest-scoring unit of
every toxic text stands for it, beside units of several toxic texts that the last round called toxic
(at first, words that only toxic texts hold, in several contexts), each frequent one also with a letter or a
space inserted; units of clean texts are negatives, the common ones, some at random, and in every round
those rated highest.
Nystrom features are the kernel values against landmark units, whitened by the
landmarks' own kernel matrix; a linear SVM on them is a weighted sum of kernel values and hence one
weight per character triple, so all windows of a text are scored in time proportional to its length.
A text's score is the calibrated value of its highest-scoring unit.

Labels are only read from training rows; ``labels``, ``lang``, ``source`` and the key are no input of
a score. Defined results: a null or empty text has the score of a text without units (below 0.5);
repeated rows get equal scores; without labelled rows of both classes every score is 0 and no text is
predicted toxic; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import BYTE_BASE, Texts, slices, spans_hash

DECAY, SPAN = 0.6, 5
MARK = 34  # class of the space that bounds words; 0 is no character
MARKED = bytes([MARK])
HASHED = 16  # classes of the letters of other scripts
SIZE = MARK + 1 + HASHED
WINDOW = 3  # words of a unit
SPELLED = 4  # least number of one-character words in a row that are one unit
LANDMARKS = 300
SAMPLE_PER_CLASS = 1500  # bound of the training sample, in rows
SAMPLE_CHARS = 20_000  # training rows are taken from texts of at most so many characters
ROUNDS = 4
LETTERS = 3  # letters inserted at every place of a virtual example
OFTEN = 5  # toxic texts of a unit that stands for them beside their highest-scoring one
PART_BYTES = 1 << 17  # training texts handled at a time
NOTHING = -10.0  # decision value of a text without units
PAD = SPAN - 1
GAPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b < SPAN]
_CODE = np.arange(SIZE**3)
REAL = (_CODE % SIZE > 0) & (_CODE // SIZE % SIZE > 0) & (_CODE // SIZE**2 > 0)
ACCENTED = "aeioucn"  # letters whose accented forms, taken together, are classes 27 to 33
# Characters that stand in for letters.
FOLDED = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
CODES = 0x20000  # code points with a class of their own rule; higher ones are hashed


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point below ``CODES``; 0 is a character that is skipped."""
    table = np.zeros(CODES, dtype=np.uint8)
    for code in range(CODES):
        plain = unicodedata.normalize("NFKD", chr(code)).lower()
        c = plain[:1]
        c = {"ß": "s", "ø": "o", "æ": "a", "œ": "o"}.get(c, FOLDED.get(c, c))
        if "a" <= c <= "z":
            accent = ACCENTED.find(c) if code >= 0xC0 and c != plain else -1
            table[code] = 27 + accent if accent >= 0 else ord(c) - 96
        elif code >= 0x80 and unicodedata.category(c)[0] in "LN":
            table[code] = hashed(ord(c))
    return table


def hashed(code):
    return MARK + 1 + code * 40503 // 16 % HASHED


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of every character at its first byte; 0 at the others and at skipped characters."""
    table = class_table()
    out = table[:256].copy()
    out[0x80:] = 0
    out = out[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        wide = np.concatenate([data, np.zeros(3, dtype=np.uint8)]).astype(np.int64)
        b0, b1, b2, b3 = (wide[lead + k] for k in range(4))
        two, three = (b0 & 31) << 6 | b1 & 63, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63
        code = np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, three << 6 & 0x1FFFC0 | (b0 & 7) << 18 | b3 & 63))
        out[lead] = np.where(code < CODES, table[np.minimum(code, CODES - 1)], hashed(code))
    bang = np.flatnonzero(data == ord("!"))
    if len(bang):  # an exclamation mark stands for a letter only before another one
        after = np.concatenate([data, np.zeros(1, dtype=np.uint8)])[bang + 1]
        out[bang[(table[after] == 0) | (after == ord("!")) | (after >= 0x80)]] = 0
    return out


class Stream(NamedTuple):
    """The words of many texts as one row of classes: a mark, a word, a mark, a word and so on, zeros
    after a text's last mark, so that no triple reaches into the next text."""

    classes: np.ndarray
    at: np.ndarray  # mark before each word
    after: np.ndarray  # mark after each word
    doc: np.ndarray  # text of each word
    stop: np.ndarray  # whether a sentence ends with the word


def stream(texts: Texts) -> Stream:
    """Words without a character that counts are left out."""
    data, start, end = texts.data, texts.start, texts.end
    classes = byte_classes(data)
    number = np.zeros(len(data) + 1, dtype=np.int64)
    number[start] = 1
    kept = np.flatnonzero(classes)
    owner = np.cumsum(number)[kept] - 1
    inner = np.bincount(owner, minlength=len(start))
    next_byte = np.concatenate([data, np.zeros(1, dtype=np.uint8)])[end]
    ends = np.isin(data[end - 1], np.frombuffer(b".!?", dtype=np.uint8)) | (next_byte == ord("\n"))
    live = np.flatnonzero(inner)
    inner, doc = inner[live], np.asarray(texts.doc)[live]
    # A word that is left out may end a sentence: the last live word before it does.
    passed = np.concatenate([[0], np.cumsum(ends)])
    upto = np.append(live[1:], len(start))
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, dtype=bool)
    stop = last | (passed[upto] > passed[live])
    sizes = 1 + inner + last * (1 + PAD)
    at = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.int32)
    out[at] = MARK
    out[at + 1 + inner] = MARK
    first = np.cumsum(inner) - inner
    out[np.repeat(at + 1 - first, inner) + np.arange(len(kept))] = classes[kept]
    return Stream(out, at, at + 1 + inner, doc, stop)


def windows(s: Stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first word, mark before, mark after) of all units of one word, of two, and so on."""
    stops = np.concatenate([[0], np.cumsum(s.stop)])
    for w in range(WINDOW):
        i = np.arange(max(len(s.at) - w, 0))
        i = i[stops[i + w] == stops[i]]
        yield i, s.at[i], s.after[i + w]


def spelled_out(s: Stream) -> Iterator[tuple[int, bytes]]:
    """(text, unit) of every run of ``SPELLED`` or more one-character words, joined."""
    single = (s.after - s.at == 2).astype(np.int8)
    edge = np.diff(np.concatenate([[0], single, [0]]))
    for low, high in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        cuts = np.flatnonzero(np.diff(s.doc[low:high])) + 1
        for run in np.split(np.arange(low, high), cuts):
            if len(run) >= SPELLED:
                yield int(s.doc[run[0]]), bytes([MARK, *s.classes[s.at[run] + 1].tolist(), MARK])


class Part(NamedTuple):
    """Units of some training texts: spans of one row of classes, marks included. The first units are the words."""

    classes: np.ndarray
    low: np.ndarray
    high: np.ndarray  # the last mark
    bag: np.ndarray  # number of the text
    key: np.ndarray  # hash of the classes
    around: np.ndarray  # units of three words
    middle: np.ndarray  # and the word in the middle of each

    def unit(self, i: int) -> bytes:
        return self.classes[self.low[i] : self.high[i] + 1].tobytes()


def parts_of(texts: list[str]) -> Iterator[Part]:
    """All units of the texts, as scoring sees them."""
    column = pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_binary())
    for first, _, part in slices(column, most=PART_BYTES):
        s = stream(part)
        found = list(windows(s))
        classes = s.classes.astype(np.uint8)
        spelled = list(spelled_out(s))
        after = len(classes) + np.cumsum([0] + [len(u) for _, u in spelled])
        low = np.concatenate([a for _, a, _ in found] + [after[:-1]])
        high = np.concatenate([b for _, _, b in found] + [after[1:] - 1])
        bag = np.concatenate([s.doc[i] for i, _, _ in found] + [np.array([d for d, _ in spelled], dtype=np.int64)])
        classes = np.concatenate([classes, np.frombuffer(b"".join(u for _, u in spelled), dtype=np.uint8)])
        key = keys(classes, low, high)
        threes = found[2][0] if WINDOW > 2 else np.zeros(0, dtype=np.int64)
        before = sum(len(i) for i, _, _ in found[:2])
        small = [x.astype(np.int32) for x in (low, high, bag + first)]
        yield Part(classes, *small, key, (before + np.arange(len(threes))).astype(np.int32), (threes + 1).astype(np.int32))


def keys(classes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return spans_hash(classes.astype(np.uint64) + np.uint64(1), low, high + 1, BYTE_BASE)


def norms(lengths: np.ndarray) -> np.ndarray:
    """Length-only norm: the self kernel of a unit whose character triples all differ."""
    total = np.full(len(lengths), 1e-9)
    for a, b in GAPS:
        total += np.maximum(lengths - a - b, 0) * DECAY ** (2 * (a + b + 1))
    return np.sqrt(total)


def triples(classes: np.ndarray) -> Iterator[tuple[np.ndarray, int, float]]:
    """(triple at every position, its reach, weight) for one pair of gaps after the other."""
    n = len(classes)
    for a, b in GAPS:
        if n > a + b:
            yield (classes[: n - a - b] * SIZE + classes[a : n - b]) * SIZE + classes[a + b :], a + b, DECAY ** (a + b + 1)


class Sums(NamedTuple):
    """Weighted triples by the position they start at: ``part`` by their reach, ``total`` running over all."""

    part: dict[int, np.ndarray]
    total: np.ndarray

    def past(self, end: np.ndarray) -> np.ndarray:
        """Sum of the triples that start at or before ``end`` and reach past it."""
        over = np.zeros(len(end))
        for reach, value in self.part.items():
            for k in range(reach):
                over += np.where(end >= k, value[end - k], 0)
        return over

    def values(self, low: np.ndarray, high: np.ndarray, over: np.ndarray) -> np.ndarray:
        """Decision value, without the bias, of the units from the mark ``low`` to the mark ``high``: the triples
        that start in it less ``over``, those of them that reach past its end, which depends on the end alone."""
        value = self.total[high + 1] - self.total[low] - over
        # A mark, one character, a mark: one triple.
        return np.where(high - low == 2, self.part[2][low], value) / norms(high - low + 1)


def sums(classes: np.ndarray, weights: np.ndarray) -> Sums:
    """``weights`` is 0 for triples that hold a zero."""
    part = {reach: np.zeros(len(classes)) for reach in range(2, SPAN)}
    for triple, reach, weight in triples(classes):
        part[reach][: len(triple)] += weight * weights[triple]
    return Sums(part, np.concatenate([[0.0], np.cumsum(sum(part.values()))]))


def window_values(s: Stream, weights: np.ndarray) -> np.ndarray:
    """For every word the highest decision value, without the bias, of the units that start with it."""
    known = sums(s.classes, weights)
    over = known.past(s.after)
    best = np.full(len(s.at), NOTHING)
    for w, (i, low, high) in enumerate(windows(s)):
        best[i] = np.maximum(best[i], known.values(low, high, over[i + w]))
    return best


def joined(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The units one after the other, zeros behind each, and where each starts (and the end)."""
    at = np.cumsum([0] + [len(u) + PAD for u in units])
    return np.frombuffer(b"".join(u + bytes(PAD) for u in units), dtype=np.uint8).astype(np.int32), at


def unit_values(units: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Decision value of every unit, without the bias."""
    out = [np.zeros(0)]
    for low in range(0, len(units), 20_000):
        part = units[low : low + 20_000]
        classes, at = joined(part)
        total = np.zeros(len(classes))
        for triple, _, weight in triples(classes):
            total[: len(triple)] += weight * weights[triple]
        out.append(np.add.reduceat(total, at[:-1]) / norms(np.diff(at) - PAD))
    return np.concatenate(out)


def triple_features(units: list[bytes], column: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum over a unit's triples of the rows of ``table`` (``column`` gives a triple's row), normalised."""
    out = [np.zeros((0, table.shape[1]), dtype=np.float32)]
    for low in range(0, len(units), 100):
        classes, at = joined(units[low : low + 100])
        total = np.zeros((len(classes), table.shape[1]), dtype=np.float32)
        for triple, _, weight in triples(classes):
            total[: len(triple)] += np.float32(weight) * table[column[triple]]
        out.append(np.add.reduceat(total, at[:-1], axis=0) / norms(np.diff(at) - PAD)[:, None].astype(np.float32))
    return np.vstack(out)


def nystrom(marks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column, codes, table): the rows of ``table`` are the weights that the triples of the landmarks,
    ``codes``, have in each Nystrom feature; ``column`` gives every triple's row, the last one for all others."""
    classes, at = joined(marks)
    owner = np.repeat(np.arange(len(marks)), np.diff(at))
    codes = np.unique(np.concatenate([t[REAL[t]] for t, _, _ in triples(classes)]))
    column = np.full(SIZE**3, len(codes), dtype=np.int32)
    column[codes] = np.arange(len(codes))
    phi = np.zeros((len(marks), len(codes) + 1), dtype=np.float32)
    for triple, _, weight in triples(classes):
        np.add.at(phi, (owner[: len(triple)], column[triple]), weight)
    phi[:, -1] = 0
    phi /= norms(np.diff(at) - PAD)[:, None].astype(np.float32)
    values, vectors = np.linalg.eigh((phi @ phi.T).astype(np.float64))
    good = values > 1e-4 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])
    return column, codes, phi.T @ whiten.astype(np.float32)


class Model(NamedTuple):
    weights: np.ndarray  # one per character triple
    middle: float  # decision value whose score is one half
    slope: float = 4.0


def score(value: np.ndarray, middle: float, slope: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * (value - middle), -30, 30)))


def linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 3.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps on the rows inside the margin, summed a block of rows at a time."""
    w = np.zeros(x.shape[1] + 1)
    value = lambda w: x @ w[:-1].astype(x.dtype) + w[-1]
    loss = lambda w: w @ w / 2 + c * (weight * np.maximum(0, 1 - y * value(w)) ** 2).sum()
    for _ in range(steps):
        inside = np.flatnonzero(y * value(w) < 1)
        square, side = np.eye(len(w)), np.zeros(len(w))
        for low in range(0, len(inside), 1000):
            some = inside[low : low + 1000]
            xs = np.hstack([x[some], np.ones((len(some), 1))]).astype(np.float64)
            scale = 2 * c * weight[some]
            square += (xs * scale[:, None]).T @ xs
            side += xs.T @ (scale * y[some])
        goal = np.linalg.solve(square, side)
        move, before = 1.0, loss(w)
        while move > 1e-3 and loss(w + move * (goal - w)) >= before:
            move /= 2
        if move <= 1e-3 or np.linalg.norm(move * (goal - w)) < 1e-6:
            break
        w = w + move * (goal - w)
    return w[:-1], w[-1]


def gapped(units: list[bytes], rng: np.random.Generator) -> list[bytes]:
    """Virtual examples: each unit with one of some letters, and with a space, inserted at every place inside it."""
    out = []
    for u in units:
        for k in range(2, len(u) - 1):
            out += [u[:k] + bytes([c]) + u[k:] for c in (*rng.integers(1, 27, LETTERS).tolist(), MARK)]
    return out


def keys_of(units: list[bytes]) -> np.ndarray:
    classes, at = joined(units)
    return keys(classes, at[:-1], at[1:] - PAD - 1)


class Sample:
    """Every different unit of the training texts, by number: kept as spans, not as strings, for there are
    several hundred of them in a text."""

    def __init__(self, bags: list[tuple[int, str]]):
        self.label = np.array([y for y, _ in bags], dtype=np.int8)
        self.parts, found = [], []
        for part in parts_of([t for _, t in bags]):
            found.append(part.key)
            self.parts.append(part._replace(key=None))
        self.keys = np.unique(np.concatenate([*found, np.zeros(0, dtype=np.uint64)]))
        self.ids = [np.searchsorted(self.keys, key).astype(np.int32) for key in found]
        del found
        # Where a unit stands first, and each unit of a text once, by text; no text is in two parts.
        n = len(self.keys)
        self.part, self.at = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
        bag, unit = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int32)]
        for k in range(len(self.parts) - 1, -1, -1):
            first, at = np.unique(self.ids[k], return_index=True)
            self.part[first], self.at[first] = k, at
        for p, ids in zip(self.parts, self.ids, strict=True):
            own = np.unique(p.bag.astype(np.int64) * n + ids)
            bag.append((own // n).astype(np.int32))
            unit.append((own % n).astype(np.int32))
        self.bag, self.unit = np.concatenate(bag), np.concatenate(unit)
        toxic = self.label[self.bag] == 1
        self.held = np.bincount(self.unit[toxic], minlength=n)  # toxic texts of every unit
        self.clean = np.bincount(self.unit[~toxic], minlength=n)
        self.bag1, self.unit1 = self.bag[toxic], self.unit[toxic]

    def units(self, numbers: np.ndarray) -> list[bytes]:
        return [self.parts[p].unit(i) for p, i in zip(self.part[numbers], self.at[numbers], strict=True)]

    def values(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.keys))
        for p, ids in zip(self.parts, self.ids, strict=True):
            known = sums(p.classes.astype(np.int32), weights)
            out[ids] = known.values(p.low, p.high, known.past(p.high))
        return out

    def witnesses(self, value: np.ndarray) -> np.ndarray:
        """How many toxic texts every unit stands for: of each, the unit of the highest value."""
        order = np.lexsort((self.unit1, -value[self.unit1], self.bag1))
        top = np.diff(self.bag1[order], prepend=-1) > 0
        return np.bincount(self.unit1[order][top], minlength=len(self.keys))

    def seeds(self) -> np.ndarray:
        """Number of contexts of the words that several toxic texts hold and clean ones do not, 0 for others and for
        words whose places are mostly copies of each other. They stand for their texts in the first round only."""
        n = len(self.keys)
        pairs = [
            (ids[p.middle].astype(np.int64) * n + ids[p.around])[self.label[p.bag[p.around]] == 1]
            for p, ids in zip(self.parts, self.ids, strict=True)
        ]
        seen = np.bincount(np.unique(np.concatenate(pairs)) // n, minlength=n)
        return np.where((self.clean == 0) & (seen >= np.maximum(OFTEN, self.held / 2)), seen, 0)

    def highest(self, value: np.ndarray) -> np.ndarray:
        top = np.full(len(self.label), NOTHING)
        np.maximum.at(top, self.bag, value[self.unit])
        return top


def train(bags: list[tuple[int, str]], landmarks: int = LANDMARKS, seed: int = 7) -> Model | None:
    """Fit on (label, text); None unless texts of both labels hold units."""
    sample = Sample(bags)
    held, clean = sample.held, sample.clean
    if not held.any() or not clean.any():
        return None
    rng = np.random.default_rng(seed)
    odds = (held + 0.1) / (clean + 1.0)
    ranked = lambda value, numbers: numbers[np.argsort(-value[numbers], kind="stable")]
    suspects = ranked(odds, np.flatnonzero(held))[: 2 * landmarks // 3]
    common = ranked(clean, np.flatnonzero(clean))
    some = lambda n: common[np.sort(rng.choice(len(common), min(n, len(common)), replace=False))]
    distinct = lambda numbers: np.array(list(dict.fromkeys(numbers.tolist())), dtype=np.int64)
    marks = distinct(np.concatenate([suspects, some(landmarks - len(suspects) + 100)]))[: landmarks + 100]
    column, codes, table = nystrom(sample.units(marks))
    features = lambda units: triple_features(units, column, table)

    pool = distinct(np.concatenate([common[:6000], some(6000)]))
    known = np.zeros(len(clean), dtype=bool)
    known[pool] = True
    x0, n0 = features(sample.units(pool)), np.ones(len(pool))
    times = sample.seeds() + sample.witnesses(odds)
    weights, value, b = np.zeros(SIZE**3, dtype=np.float32), odds, 0.0
    for _ in range(ROUNDS):
        chosen = np.flatnonzero(times)
        virtual = sorted(set(gapped(sample.units(np.flatnonzero(times >= OFTEN)), rng)))
        if virtual:
            plain = np.isin(keys_of(virtual), sample.keys[clean > 0])
            virtual = [u for u, seen in zip(virtual, plain, strict=True) if not seen]
        x = np.vstack([features(sample.units(chosen) + virtual), x0])
        y = np.array([1.0] * (len(chosen) + len(virtual)) + [-1.0] * len(x0))
        counts = np.concatenate([np.where(times[chosen] > 1, np.minimum(times[chosen], 20) * 2.0, 0.5), np.full(len(virtual), 0.5)])
        w, b = linear_svm(x, y, np.concatenate([counts, n0]))
        weights[codes] = (table[:-1] @ w).astype(np.float32)
        value = sample.values(weights)
        sure = (held >= OFTEN) & (clean == 0) & (value + b > 0)
        times = np.maximum(sample.witnesses(value), np.where(sure, held, 0))
        # The clean units the machine rates highest become negatives of the next round.
        more = ranked(value, common)[:1500]
        more = more[~known[more]]
        if len(more):
            known[more] = True
            x0, n0 = np.vstack([x0, features(sample.units(more))]), np.concatenate([n0, np.full(len(more), 2.0)])
    top = sample.highest(value) + b
    tp, tn = top[(sample.label == 1) & (top > NOTHING + b)], top[sample.label == 0]
    cuts = np.unique(np.concatenate([tp, tn]))
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    tv = unit_values(virtual, weights) + b if virtual else tp
    # A clean text called toxic counts three times: clean texts are far more common; the virtual examples together
    # count a tenth of the toxic texts.
    right = [(np.mean(tp >= c) + 0.1 * np.mean(tv >= c) + 3 * np.mean(tn < c), -abs(c), c) for c in cuts]
    middle = max(right)[2]
    return Model(weights, float(middle - b))


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, held_out, per_class: int) -> DataFrame:
    """A bounded sample of labelled texts: the ``per_class`` keys of each label with the smallest
    hash, outside the held-out fold, and one text of each (of a repeated key the one of the smallest hash)."""
    rows = labels.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y")).where("_k is not null").distinct()
    rows = rows.where(~held_out(F.col("_k")))
    ids = None
    for y in (0, 1):
        part = rows.where(F.col("_y") == y).orderBy(F.xxhash64("_k"), "_k").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    chosen = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).where(F.length("_t") <= SAMPLE_CHARS)
    texts = chosen.join(F.broadcast(ids), "_k").groupBy("_k", "_y").agg(F.min(F.struct(F.xxhash64("_t").alias("_h"), "_t")).alias("r"))
    return texts.select("_y", F.xxhash64("_k").alias("_o"), "r._h", "r._t")


def fit(rows: DataFrame) -> Model | None:
    """Train on the sample (``training_rows``, at most twice ``per_class`` of them) in one task, so that the driver holds
    the weights only; a lost executor costs another run of that task."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(tuple(r.values()) for batch in batches for r in batch.to_pylist())
        if model := train([(y, t) for y, _, _, t in found]):
            cells = [[model.weights.tobytes()], [model.middle], [model.slope]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["weights", "middle", "slope"])

    learned = rows.repartition(1).mapInArrow(learn, "weights binary, middle double, slope double").collect()
    return Model(np.frombuffer(learned[0][0], dtype=np.float32), learned[0][1], learned[0][2]) if learned else None


def fold(key):
    """crc32 of the key as text, mod 5, is 0; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def best_values(texts: Texts, weights: np.ndarray) -> np.ndarray:
    """Per row of a slice, the value of its highest-scoring unit."""
    best = np.full(texts.rows, NOTHING)
    s = stream(texts)
    if not len(s.at):
        return best
    first = np.flatnonzero(np.concatenate([[True], s.doc[1:] != s.doc[:-1]]))
    best[s.doc[first]] = np.maximum.reduceat(window_values(s, weights), first)
    spelled = list(spelled_out(s))
    np.maximum.at(best, [doc for doc, _ in spelled], unit_values([u for _, u in spelled], weights))
    return best


def score_texts(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and score of every row."""
    kind = dict(docs.dtypes)[key]
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else tuple(model))  # SIZE**3 weights, whatever the data

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = np.full(batch.num_rows, NOTHING)
            if shared.value is not None:
                weights, middle, slope = shared.value
                for low, high, texts in slices(batch.column(1)):
                    best[low:high] = best_values(texts, weights)
                rated = score(best, middle, slope)
            else:
                rated = np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rated)], [key, "score"])

    return docs.select(F.col(key), F.col(text).cast("binary").alias(text)).mapInArrow(rate, f"`{key}` {kind}, score double")


def toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = SAMPLE_PER_CLASS
) -> DataFrame:
    """Key, held_out, score, predicted of every row."""
    model = fit(training_rows(docs, labels, key, text, label, fold, per_class))
    scored = score_texts(docs, model, key, text)
    return scored.select(
        key, fold(F.col(key)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
