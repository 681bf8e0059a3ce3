"""Word hashing, registers and fingerprints against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import chunks, hyperminhash, wordhash

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\t\n.x", max_size=60)), max_size=8)


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def plain_shingles(text, width):
    w = plain_words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingle_sets(texts, width):
    found = list(wordhash.shingle_sets(pa.array(texts, pa.string()), width))
    assert [len(x) for x in found] == [len(plain_shingles(t, width)) for t in texts]


def test_equal_words_hash_alike_wherever_they_stand():
    a, b = wordhash.shingle_sets(pa.array(["the Quick brown fox", "so THE quick\tbrown fox"]), 4)
    assert len(np.intersect1d(a, b)) == 1


def test_very_long_text_equals_its_pieces():
    text = "".join(f"w{i % 977} " for i in range(700_000))
    (long,) = wordhash.shingle_sets(pa.array([text]), 3)
    (short,) = wordhash.shingle_sets(pa.array([text[:20_000]]), 3)
    assert len(long) == 977 and set(short) <= set(long)


@pytest.mark.parametrize("n", [30, 400, 3000])
@pytest.mark.parametrize("share", [0.5, 0.8, 0.95])
def test_estimate_is_near_the_similarity(n, share):
    r = np.random.default_rng(n)
    both = int(n * share)
    x = r.integers(0, 2**63, 2 * n - both, dtype=np.uint64) * np.uint64(2)
    a, b = np.sort(x[:n]), np.sort(np.concatenate([x[:both], x[n:]]))
    make = hyperminhash.small_registers if n <= 500 else hyperminhash.large_registers
    got = hyperminhash.estimate(make(a)[None], make(b)[None], np.array([len(a)]), np.array([len(b)]))[0]
    assert abs(got - both / len(x)) < 0.13


def test_registers_hold_zeros_and_mantissa():
    low = np.array([1 << 63, (1 << 63) | (1 << 62), 1 << 40, 1 << 11], dtype=np.uint64)
    assert hyperminhash.compress(low).tolist() == [1, 513, (23 << 10) + 1, (52 << 10) + 1]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=400))
def test_fingerprint_covers_the_text(text):
    prints = chunks.fingerprint(text)
    assert (len(prints) == 0) == (text == "")
    assert chunks.likeness(prints, chunks.fingerprint(text)) == 1.0
    assert int((prints & np.uint64(0xFF)).sum()) <= len(text.encode())


def test_shifted_text_keeps_most_chunks():
    r = np.random.default_rng(1)
    text = "".join(chr(97 + c) for c in r.integers(0, 26, 5000))
    a, b = chunks.fingerprint(text), chunks.fingerprint("some words before " + text)
    assert chunks.likeness(a, b) > 0.95
    assert chunks.likeness(a, chunks.fingerprint(text[::-1])) < 0.05


def test_spans_of_a_long_text_do_not_matter(monkeypatch):
    r = np.random.default_rng(2)
    text = "".join(chr(97 + c) for c in r.integers(0, 26, 20_000))
    whole = chunks.fingerprint(text)
    monkeypatch.setattr(chunks, "SPAN", 1000)
    assert (chunks.fingerprint(text) == whole).all()
