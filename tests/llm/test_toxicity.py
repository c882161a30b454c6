"""The string kernel against its definition, and what windows of words can tell."""

import itertools

import numpy as np

from fundspark.llm import toxicity
from fundspark.llm.words import Texts

MARKED = toxicity.MARKED


def texts_of(texts):
    raw = [t.encode() for t in texts]
    return Texts(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0] + [len(r) for r in raw]))


def direct_features(unit):
    """Every subsequence of three characters of span at most SPAN, weighed by its span."""
    out = {}
    for i, j, k in itertools.combinations(range(len(unit)), 3):
        if k - i < toxicity.SPAN:
            code = (unit[i] * toxicity.SIZE + unit[j]) * toxicity.SIZE + unit[k]
            out[code] = out.get(code, 0) + toxicity.DECAY ** (k - i + 1)
    return out


def norm(unit):
    """Root of the sum of squared span weights, as if no sequence of characters came twice."""
    spans = (k - i for i, _, k in itertools.combinations(range(len(unit)), 3))
    return sum(toxicity.DECAY ** (2 * (s + 1)) for s in spans if s < toxicity.SPAN) ** 0.5


def direct_words(text):
    """Class strings of the words of every sentence, character by character."""
    table, sentences = toxicity.class_table(), [[]]
    for line in text.split("\n"):
        for word in line.split():
            classes = []
            for at, c in enumerate(word):
                after = word[at + 1 : at + 2]
                if c == "!" and not (after and after != "!" and ord(after) < 128 and table[ord(after)]):
                    continue
                classes.append(int(table[ord(c)]))
            if kept := bytes(x for x in classes if x):
                sentences[-1].append(kept)
            if word[-1] in ".!?":
                sentences.append([])
        sentences.append([])
    return [s for s in sentences if s]


def direct_units(text):
    out = []
    for words in direct_words(text):
        for n in range(1, toxicity.WINDOW + 1):
            out += [MARKED + MARKED.join(words[i : i + n]) + MARKED for i in range(len(words) - n + 1)]
    runs = itertools.groupby((w for s in direct_words(text) for w in s), key=lambda w: len(w) == 1)
    for one, run in runs:
        letters = list(run)
        if one and len(letters) >= toxicity.SPELLED:
            out.append(MARKED + b"".join(letters) + MARKED)
    return out


TEXTS = [
    "Some plain words. And an id iot here!! Yes", "", " \n\t ", "*** %%% .", "a b c d e. f", "x", "!d!ot ! wow!", "Éa naïve ﬀ ｉｄｉｏｔ",
    "Привет мир 你好 世界 \U0001f600 z​y", "one\ntwo three\n\nfour", "m o r o n you " * 3, "long" * 50, "... word *** more",
]


def test_units_and_values_match_their_definition():
    rng = np.random.default_rng(3)
    weights = rng.standard_normal(toxicity.SIZE**3).astype(np.float32) * toxicity.REAL
    texts = texts_of(TEXTS)
    found = [[] for _ in TEXTS]
    for part in toxicity.parts_of(TEXTS):
        assert [part.unit(a).split(MARKED)[2] for a in part.around] == [part.unit(m)[1:-1] for m in part.middle]
        for i, doc in enumerate(part.bag):
            found[doc].append(part.unit(i))
    sample = toxicity.Sample([(k % 2, t) for k, t in enumerate(TEXTS)])
    values = sample.values(weights)
    assert np.allclose(values, toxicity.unit_values(sample.units(np.arange(len(values))), weights), atol=1e-4)
    best = toxicity.best_values(texts, weights)
    for text, units, value in zip(TEXTS, found, best, strict=True):
        want = direct_units(text)
        assert sorted(units) == sorted(want), text
        direct = [sum(weights[c] * x for c, x in direct_features(u).items()) / norm(u) for u in want]
        assert np.allclose(toxicity.unit_values(want, weights), direct, atol=1e-4)
        assert abs(max([toxicity.NOTHING, *direct]) - value) < 1e-4, text


def test_features_are_the_kernel_against_landmarks():
    marks = direct_units("the idiot and some clever other words here")
    others = direct_units("an idxiot or id iot of some kind")
    column, codes, table = toxicity.nystrom(marks)
    kernel = lambda u, v: sum(x * direct_features(v).get(c, 0) for c, x in direct_features(u).items()) / norm(u) / norm(v)
    own = np.array([[kernel(u, v) for v in marks] for u in marks])
    mapped = toxicity.triple_features(marks, column, table)
    assert np.allclose(mapped @ mapped.T, own, atol=2e-3)  # exact on the landmarks, but for the smallest directions
    values, vectors = np.linalg.eigh(own)
    good = values > 1e-4 * values[-1]
    cross = np.array([[kernel(u, v) for v in marks] for u in others])
    want = cross @ (vectors[:, good] / values[good]) @ vectors[:, good].T @ own
    assert np.allclose(toxicity.triple_features(others, column, table) @ mapped.T, want, atol=5e-3)


def bags_of(texts, label):
    return [(label, text) for text in texts]


def made_texts(rng, n, insert=None):
    vocabulary = ["green", "water", "go", "home", "paper", "river", "die", "table", "and", "the", "with", "other", "small"]
    out = []
    for i in range(n):
        words = list(rng.choice(vocabulary, 12))
        while any(a == "go" and b == "die" for a, b in itertools.pairwise(words)):
            words = list(rng.choice(vocabulary, 12))
        if insert:
            words[6:6] = insert[i % len(insert)].split()
        out.append(" ".join(words))
    return out


def test_a_phrase_of_harmless_words_and_an_insult_cut_by_a_space():
    rng = np.random.default_rng(11)
    bags = bags_of(made_texts(rng, 120, ["go die", "wretch", "scumbag"]), 1) + bags_of(made_texts(rng, 400), 0)
    model = toxicity.train(bags)
    rate = lambda texts: (toxicity.best_values(texts_of(texts), model.weights) >= model.middle).mean()
    assert rate(made_texts(rng, 100)) <= 0.05
    for form in ("go die", "wretch", "wre tch", "wr.etch", "WRETCH", "wretch!", "w r e t c h", "scu mbag", "scumxbag", "$cumb4g"):
        assert rate(made_texts(rng, 50, [form])) >= 0.9, form


def test_other_scripts_are_told_apart():
    rng = np.random.default_rng(5)
    words = ["дом", "река", "стол", "вода", "мир", "книга", "дорога", "зима"]
    clean = [" ".join(rng.choice(words, 10)) for _ in range(300)]
    bad = [f"{' '.join(rng.choice(words, 5))} мерзавец {' '.join(rng.choice(words, 5))}" for _ in range(80)]
    model = toxicity.train(bags_of(bad[:40], 1) + bags_of(clean[:200], 0))
    rate = lambda texts: (toxicity.best_values(texts_of(texts), model.weights) >= model.middle).mean()
    assert rate(bad[40:]) == 1 and rate([t.upper() for t in bad[40:]]) == 1 and rate(clean[200:]) == 0
