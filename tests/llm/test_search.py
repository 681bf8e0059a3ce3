"""Sequence files, spelling variants and ranked search against plain Python."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.helpers import LONG, no_documents, odd_documents
from tidemark.llm import lexical, permuterm, runs, sequencefile, tokens

BPE = public_tokenizers.path("byte_bpe_50k.json")


# Token ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aZ0 \n\t.,'!é 　 日\x85\x1f👍́", max_size=40), max_size=6))
def test_ids_of_pieces_are_those_of_the_text(texts):
    own = tokens.encoder(BPE)
    found = [ids[a:b].tolist() for _, _, ids, ends in own.encode(pa.array(texts, pa.string())) for a, b in itertools.pairwise(ends)]
    assert found == [own.whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_of_a_text_longer_than_a_group(monkeypatch):
    own, text = tokens.encoder(BPE), LONG + " " + "x" * 900 + LONG
    want = own.whole.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(tokens, "GROUP", 300)
    ((lo, hi, ids, ends),) = own.encode(pa.array([text]))
    assert ids.tolist() == want and ends.tolist() == [0, len(want)]


def test_without_ranks_the_vocabulary_file_is_enough():
    own = tokens.Encoder(BPE)
    own.ranks = None
    assert np.frombuffer(own.ids("two words, é\n\nx"), own.kind).tolist() == tokens.encoder(BPE).whole.encode("two words, é\n\nx").ids


# Sequence files


def plain_documents(rows, end):
    at, out = 0, []
    for r in rows:
        ids = [*tokens.encoder(BPE).whole.encode(r.text or "", add_special_tokens=False).ids, end]
        out.append((r.doc_id, at, len(ids), np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    return out


@pytest.mark.parametrize("length", [1, 7, 64])
def test_documents_come_back_from_the_files(spark, tmp_path, length):
    docs = odd_documents(spark).union(odd_documents(spark).filter("doc_id = 1"))
    path = f"file://{tmp_path}/out"
    sequencefile.write_sequences(docs, path, BPE, end=2, length=length, files=3)
    got = [tuple(map(lambda x: bytes(x) if isinstance(x, bytearray) else x, r)) for r in sequencefile.read_documents(spark, path).orderBy("start").collect()]
    keys = [r[0] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    # Rows of one key are told apart by their ids only.
    rows = {}
    for k, _, n, ids in plain_documents(docs.collect(), 2):
        rows.setdefault(k, []).append((n, ids))
    for k, found in itertools.groupby(got, key=lambda r: r[0]):
        assert sorted((n, ids) for _, _, n, ids in found) == sorted(rows[k])
    assert [r[1] for r in got] == [0, *itertools.accumulate(r[2] for r in got)][:-1]


def test_sequences_are_equal_long_and_mapped(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    sequencefile.write_sequences(odd_documents(spark), path, BPE, end=2, length=16, files=2)
    listed = sequencefile.manifest(path)
    everything = b"".join(bytes(r.ids) for r in sequencefile.read_documents(spark, path).orderBy("start").collect())
    ids, views = [], 0
    for f in listed["files"]:
        file = sequencefile.SequenceFile(f"{path}/{f['name']}.arrows")
        assert len(file) == f["sequences"]
        real = 0
        for i in range(len(file)):
            before = pa.total_allocated_bytes()
            row, mask = file.sequence(i)
            assert pa.total_allocated_bytes() == before
            assert len(row) == len(mask) == 16 and not row.flags.owndata and not row.flags.writeable
            views += 1
            kept = np.asarray(mask.to_numpy(zero_copy_only=False))
            assert kept.all() or i == len(file) - 1
            real += int(kept.sum())
            ids += row[kept].tolist()
        assert real == f["tokens"]
        for wrong in (-1, len(file)):
            with pytest.raises(IndexError):
                file.sequence(wrong)
    assert np.array(ids, dtype="<u4").tobytes() == everything and views > 500
    rows = sequencefile.read_sequences(spark, path).orderBy("sequence").collect()
    assert [r.sequence for r in rows] == list(range(views))
    assert [i for r in rows for i, m in zip(r.ids, r.mask, strict=True) if m] == ids


def test_one_key_of_all_rows_lies_in_many_files(spark, tmp_path):
    docs = spark.range(3000).selectExpr("7L doc_id", "'same text' text")
    sequencefile.write_sequences(docs, str(tmp_path / "out"), BPE, end=2, files=6)
    assert len(sequencefile.manifest(str(tmp_path / "out"))["files"]) >= 5
    assert sequencefile.read_documents(spark, str(tmp_path / "out")).count() == 3000


def test_no_documents_and_text_keys(spark, tmp_path):
    sequencefile.write_sequences(no_documents(spark), str(tmp_path / "a"), BPE, end=2)
    assert sequencefile.read_documents(spark, str(tmp_path / "a")).count() == 0
    assert sequencefile.read_sequences(spark, str(tmp_path / "a")).count() == 0
    docs = spark.createDataFrame([("b", "x"), ("a", None)], "`the key` string, `the text` string")
    sequencefile.write_sequences(docs, str(tmp_path / "b"), BPE, end=2, key="the key", text="the text")
    got = sequencefile.read_documents(spark, str(tmp_path / "b")).orderBy("start").collect()
    assert [(r.key, r.start, r.length) for r in got] == [("a", 0, 1), ("b", 1, 2)]


# Spelling variants


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts, ratio=5):
    out, forms = {}, {}
    for w, n in counts.items():
        others = sorted((o for o in counts if near(w, o)), key=lambda o: (-counts[o], o))
        best = others[0] if others and counts[others[0]] >= ratio * n else None
        forms[w] = best
        out[w] = [best, n, len(others), counts.get(best)]
    for w, row in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        row.insert(1, root)
    return {w: tuple(r) for w, r in out.items()}


def test_variants_equal_brute_force(spark):
    r = np.random.default_rng(3)
    words = {"".join(r.choice(list("aabé"), r.integers(1, 7))) for _ in range(400)}
    long = "ab" * 40
    words |= {long, long[:-1], "b" + long[1:], long[:10] + long[11:], "c" + long, long[:30] + "é" + long[31:], long[:63], long[:64], long[:65], long[1:65], "b" + long[1:64]}
    counts = {w: int(5 ** r.integers(0, 6)) for w in words}
    counts["a"] = 5**9
    rows = spark.createDataFrame([*counts.items(), (None, 3)], "word string, n long")
    got = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in permuterm.spelling_variants(rows).collect()}
    want = plain_variants(counts)
    assert got == want
    assert any(f and f != root for f, root, *_ in want.values())


def test_variants_of_nothing_and_of_equal_counts(spark):
    assert permuterm.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0
    rows = spark.createDataFrame([("abcd", 5), ("abce", 5)], "word string, n long")
    assert sorted(tuple(x) for x in permuterm.spelling_variants(rows).collect()) == [("abcd", None, "abcd", 5, 1, None), ("abce", None, "abce", 5, 1, None)]
    with pytest.raises(ValueError):
        permuterm.spelling_variants(rows, ratio=1)


def test_words_of_documents(spark, monkeypatch):
    monkeypatch.setattr(runs, "GROUP", 1 << 12)
    docs = odd_documents(spark).union(spark.createDataFrame([(50, "Él NO no×a ÷÷ n°ß x日y ¿" + "é" * 9000, None, None, None, 1, None, None)], odd_documents(spark).schema))
    got = Counter()
    for r in permuterm.document_words(docs, shortest=2).collect():
        got[r.key, r.word] += r.n
    want = Counter()
    for r in docs.collect():
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
        want.update((r.doc_id, w) for w in re.findall("[A-Za-zÀ-ÿ]+", lower) if len(w) > 1)
    assert got == want
    assert permuterm.document_words(no_documents(spark)).count() == 0


# Search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, most):
    counted = [(k, Counter(plain_terms(t))) for k, t in docs]
    n_docs, size = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    terms = {}
    for k, t in items:
        terms.setdefault(k, set()).update(plain_terms(t))
    out = []
    for item, wanted in terms.items():
        scored = []
        for k, c in counted:
            m = 10 + 90 * c.total() * n_docs // max(size, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if c[t]
            )
            if score > 0:
                scored.append((-score, k is not None, k if k is not None else 0, k))
        out += [(item, i + 1, k, -s) for i, (s, _, _, k) in enumerate(sorted(scored)[:most])]
    return sorted(out, key=repr)


def test_search_equals_brute_force(spark, monkeypatch):
    r = np.random.default_rng(8)
    words = [f"w{i}" for i in range(60)] + ["É", "x_y", "Ab"]
    text = lambda n: " ".join(r.choice(words, n, p=np.arange(63, 0, -1) / 2016))
    docs = [(i, text(r.integers(0, 40))) for i in range(150)] + [(None, text(9)), (3, text(5)), (900, None), (901, "...")]
    docs += [(1000 + i, "w1 w2 w3") for i in range(40)]
    items = [(i, text(r.integers(1, 25))) for i in range(30)] + [(None, "w1 w9"), (5, "w2"), (77, None), (78, "nowhere"), (79, "")]
    rows = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id long, text string, item string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = plain_search(docs, items, 10)
    monkeypatch.setattr(lexical, "CELLS", 4000)
    for block in (1 << 22, 300):
        monkeypatch.setattr(lexical, "BLOCK", block)
        got = sorted((tuple(x) for x in lexical.search(rows, asked).select("item", "rank", "key", "score").collect()), key=repr)
        assert got == want


def test_search_in_odd_documents(spark, monkeypatch):
    asked = spark.createDataFrame([("a", "the Fox word17"), (None, "haus")], "item_id string, text string")
    docs = odd_documents(spark)
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], [("a", "the Fox word17"), (None, "haus")], 10)
    monkeypatch.setattr(runs, "GROUP", 1 << 12)
    assert sorted((tuple(x) for x in lexical.search(docs, asked).select("item", "rank", "key", "score").collect()), key=repr) == want
    assert lexical.search(no_documents(spark), asked).count() == 0
    assert lexical.search(docs, asked.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), max_size=9), max_size=12))
def test_shared_sets_sum_to_the_items(wanted):
    pairs = np.array([(i, t) for i, s in enumerate(wanted) for t in s], dtype=np.int64).reshape(-1, 2)
    sharing = lexical.mine(pairs[:, 0], pairs[:, 1], len(wanted), 13)
    sums = np.random.default_rng(1).integers(0, 3, (13, 4))
    items, found = lexical.item_sums(sharing, sums)
    plain = np.array([sums[sorted(s)].sum(axis=0) if s else np.zeros(4, dtype=int) for s in wanted]).reshape(-1, 4)
    laid = np.zeros_like(plain)
    laid[items] = found
    assert (laid == plain).all()
    assert sum(len(x.parts) for x in sharing.levels) <= len(pairs) + sum(len(x.made) for x in sharing.levels[:-1])


def test_a_set_shared_by_items_is_summed_once():
    shared = list(range(10))
    pairs = np.array([(i, t) for i in range(20) for t in [*shared, 100 + i]])
    sharing = lexical.mine(pairs[:, 0], pairs[:, 1], 20, 120)
    assert sum(len(x.parts) for x in sharing.levels) == 10 + 2 * 20
