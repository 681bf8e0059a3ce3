"""Fingerprints, language models and toxicity against plain loops."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import LONG
from tidemark.llm import chunks, langmodel, toxicity
from tidemark.llm.wordhash import _power, mix

ALL = 2**64 - 1


def plain_fingerprint(text):
    """Byte by byte: cut at the first place that the test of the chunk's size allows, then digest the chunk."""
    data = text.encode()
    up = [int(x) for x in _power(chunks.MOST + 1)[0]]
    out, start = set(), 0
    while start < len(data):
        end = min(start + chunks.MOST, len(data))
        for i in range(start + chunks.LEAST - 1, end):
            if len(data) - start <= chunks.LEAST:
                break
            h = sum(int(chunks._GEAR[data[i - k]]) << k for k in range(min(16, i + 1))) & ALL
            bits = chunks.HARD if i - start + 1 < chunks.NORMAL else chunks.EASY
            if (h >> 40) % 2**bits == 0:
                end = i + 1
                break
        total = sum(int(chunks._TAG[b]) * up[k] for k, b in enumerate(data[start:end])) & ALL
        out.add((int(mix(np.array([total], dtype=np.uint64))[0]) & ~0xFF) | (end - start))
        start = end
    return out


def random_text(seed, n):
    r = np.random.default_rng(seed)
    return "".join(r.choice(list("abcdefgh éß語 \n.,"), n))


TEXTS = ["", "a", "sixteen letters!", "sixteen letters!x", "x" * 1000, LONG[:6000], *[random_text(i, n) for i, n in enumerate([15, 40, 127, 128, 129, 3000])]]


@pytest.mark.parametrize("text", TEXTS)
def test_chunks_equal_those_found_byte_by_byte(text):
    assert set(chunks.fingerprint(text).tolist()) == plain_fingerprint(text)


def test_long_texts_are_cut_alike_span_by_span(monkeypatch):
    monkeypatch.setattr(chunks, "SPAN", 512)
    for text in TEXTS:
        assert set(chunks.fingerprint(text).tolist()) == plain_fingerprint(text)


def test_likeness_equals_shared_length():
    prints = [(chunks.fingerprint(t), plain_fingerprint(t)) for t in [*TEXTS, LONG[:3000] + LONG[3050:6000]]]
    for a, plain_a in prints:
        for b, plain_b in prints:
            sizes = [sum(x & 0xFF for x in p) for p in (plain_a, plain_b, plain_a & plain_b)]
            want = float(sizes[0] == sizes[1]) if not min(sizes[:2]) else sizes[2] / min(sizes[:2])
            assert chunks.likeness(a, b) == pytest.approx(want)


def plain_runs(text):
    """Every letter and word end with the up to three letters before it."""
    for word in re.split(r"[\W\d_]+", text):
        letters = [c.lower()[0] for c in word]
        for i in range(len(letters) + 1 if letters else 0):
            yield tuple(letters[max(0, i - 3) : i]), letters[i] if i < len(letters) else None


class PlainModel:
    """Interpolated Kneser-Ney in dictionaries: contexts of up to three letters, the first ones shorter."""

    def __init__(self, texts):
        padded = Counter(((None,) * (3 - len(c)) + c, x) for t in texts for c, x in plain_runs(t))
        self.counts = {4: dict(padded)}
        for k in (3, 2, 1):
            self.counts[k] = dict(Counter((c[1:], x) for c, x in self.counts[k + 1]))
        self.followers = {k: defaultdict(list) for k in self.counts}
        for k, grams in self.counts.items():
            for (c, x), n in grams.items():
                self.followers[k][c].append(n)

    def p(self, context, x, k=4):
        if k == 0:
            return 1 / (len(self.counts[1]) + 1)
        shorter = self.p(context[1:], x, k - 1)
        after = self.followers[k].get(context)
        if not after:
            return shorter
        d = langmodel.DISCOUNT
        return max(self.counts[k].get((context, x), 0) - d, 0) / sum(after) + min(d * len(after) / sum(after), 1) * shorter

    def entropy(self, text):
        runs = [((None,) * (3 - len(c)) + c, x) for c, x in plain_runs(text)]
        return -sum(math.log(self.p(c, x)) for c, x in runs), len(runs)


def test_language_models_equal_dictionaries(spark):
    known = {"de": ["Der Hund und die Katze, sind im Haus!", "ein Mann geht; durch die Straße"], "en": ["the dog & the cat are in the house", "a man walks 12 streets", "the the the"]}
    rows = [(t, lang) for lang, texts in known.items() for t in texts * 3]
    model = langmodel.train(spark.createDataFrame(rows, "text string, lang string"))
    texts = ["the cat", "Die Straße im Haus", "xyz unknown ωορδ", "  dog!!dog  ", "", "12 --", "a", LONG[:2000]]
    nll, n = langmodel._entropies(texts, model)
    for j, lang in enumerate(model["languages"]):
        plain = PlainModel(known[lang] * 3)
        for i, text in enumerate(texts):
            want, size = plain.entropy(text)
            assert n[i] == size
            assert nll[i, j] == pytest.approx(want, rel=1e-5, abs=1e-4)


def test_long_texts_have_the_same_entropy_in_pieces(monkeypatch):
    text = LONG[:5000]
    whole = langmodel.Grams([text]).distinct()
    pieces = langmodel._pieces(text, 300)
    assert "".join(pieces) == text and len(pieces) > 10
    parts = langmodel._merged([langmodel.Grams([p]).distinct() for p in pieces])
    for a, b in zip(whole, parts, strict=True):
        assert (a == b).all()


def plain_loss(w, b, bags, labels, weight):
    total = 0.0
    for sentences, y, share in zip(bags, labels, weight, strict=True):
        clean = 1.0
        for words in sentences:
            clean *= 1 - 1 / (1 + math.exp(-(sum(w[x] for x in words) + b)))
        total += share / sum(weight) * (-math.log(1 - clean) if y else -math.log(clean))
    return total


def test_fit_follows_the_slope_of_the_plain_loss(monkeypatch):
    """Three steps against slopes by differences of the loss over sentences and words."""
    monkeypatch.setattr(toxicity, "ROUNDS", 3)
    monkeypatch.setattr(toxicity, "LEAST_DOCUMENTS", 2)
    r = np.random.default_rng(9)
    bags = [[sorted(r.choice(6, r.integers(0, 4), replace=False).tolist()) for _ in range(r.integers(1, 4))] for _ in range(12)]
    labels, weight = np.arange(12) % 2, r.uniform(0.5, 2, 12)
    items = np.array([x for bag in bags for words in bag for x in words])
    sizes, sentences = np.array([len(words) for bag in bags for words in bag]), np.array([len(bag) for bag in bags])
    got_w, got_b = toxicity.fit(labels, items, sizes, sentences, weight)
    point, sums, h = np.append(np.zeros(6), -math.log(max(1.0, len(sizes) / 12)) - 2.0), np.full(7, 1e-8), 1e-5
    for _ in range(3):
        slope = np.array([(plain_loss(*split(point + e), bags, labels, weight) - plain_loss(*split(point - e), bags, labels, weight)) / (2 * h) for e in np.eye(7) * h])
        sums += slope**2
        step = toxicity.RATE / np.sqrt(sums)
        point = point - step * slope
        point[:6] = np.sign(point[:6]) * np.maximum(np.abs(point[:6]) - step[:6] * toxicity.SPARSE / 12, 0)
    assert all(sum(any(x in words for words in bag) for bag in bags) >= 2 for x in range(6))
    np.testing.assert_allclose(got_w[:6], point[:6], atol=1e-4)
    assert got_b == pytest.approx(point[6], abs=1e-4)


def split(point):
    return point[:6], point[6]


def test_scores_equal_plain_sentences(spark):
    r = np.random.default_rng(10)
    model = {"weights": r.normal(0, 1.0, 2**toxicity.BITS).astype(np.float32), "bias": -1.0}
    texts = ["one two. three! four five six? seven\neight", "a", "no end", "Twice twice. TWICE", "... !", LONG[:900], "ein größeres wort. 語 語"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    for row in toxicity.score(frame, model).collect():
        chances = []
        for sentence in re.split(r"[.!?\n]", row.row.text):
            # Slots of the words one by one; a term counts once in a sentence.
            slots = set()
            for word in sentence.split():
                data = np.frombuffer(word.encode(), dtype=np.uint8)
                slots |= {int(x) & (2**toxicity.BITS - 1) for x in toxicity.sentence_terms(data, np.array([0, len(data)]))[0]}
            if slots:
                chances.append(1 / (1 + math.exp(-(sum(float(model["weights"][s]) for s in slots) + model["bias"]))))
        assert row.score == pytest.approx(1 - math.prod(1 - p for p in chances), abs=1e-5)
        if any(p >= 0.5 for p in chances):
            assert len(row.spans) == sum(p > 0.5 for p in chances)
