"""Operators over documents: odd cases, brute force and exact laws."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LONG, no_documents, odd_documents
from tests.llm.test_words import plain_shingles
from tidemark.llm import chunks, components, hyperminhash, langmodel, mixing, packing, sharding, toxicity
from tidemark.llm.tokens import Encoder, encoder

import public_tokenizers


def brute_components(rows, width, percent):
    sets = {i: plain_shingles(t, width) for i, t in rows}
    name = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                linked = sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
                if linked and name[a] != name[b]:
                    name[a] = name[b] = min(name[a], name[b])
                    changed = True
    return name


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_of_odd_documents(spark, width):
    docs = odd_documents(spark)
    got = hyperminhash.near_duplicates(docs, width=width).collect()
    assert len(got) == 12
    want = brute_components([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None], width, 80)
    for r in got:
        if r.doc_id is None:
            assert not r.kept
        else:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_copies_that_differ_from_the_first_are_found(spark):
    """A chain: each text is near the one before it, and the ends are not near each other."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[15 * k : 15 * k + 200])) for k in range(12)] + [(50 + k, " ".join(f"v{k}x{i}" for i in range(60))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, 5, 80)
    assert {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(docs).collect()} == want


def test_common_passage_does_not_link(spark, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK", 8)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(k, passage + " " + " ".join(f"d{k}n{i}" for i in range(12 + k % 9))) for k in range(40)]
    want = brute_components(rows, 5, 80)
    assert {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(3, 3), (None, 4), (8, 7)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 40)}}
    first = components.connected_components(spark.createDataFrame([(1, 2), (5, 6)], "a long, b long"))
    more = components.joined_components(first, spark.createDataFrame([(2, 5), (8, 9)], "a long, b long"))
    assert {r.node: r.component for r in more.collect()} == {1: 1, 2: 1, 5: 1, 6: 1, 8: 8, 9: 8}


def test_fingerprints_of_odd_documents(spark):
    docs = odd_documents(spark)
    got = chunks.fingerprints(docs).collect()
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = {}
    for (i, text), (_, other) in zip(rows, rows[1:] + rows[:1], strict=True):
        want.setdefault(i, []).append((len(text), hashlib.sha256(chunks.edited(text, other).encode()).hexdigest()))
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_chars, r.edited_sha256) in want[r.doc_id]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[3].fingerprint and by[5].fingerprint == "" and by[5].near_edited == 1.0


def test_languages(spark):
    german = ["der hund und die katze sind im haus", "ein mann geht durch die strasse und singt", "wir sehen heute keine wolken am himmel"]
    english = ["the dog and the cat are in the house", "a man walks through the street and sings", "we see no clouds in the sky today"]
    rows = [(i, t, x, None) for i, (t, x) in enumerate([(t, "de") for t in german] * 4 + [(t, "en") for t in english] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n string")
    model = langmodel.train(docs)
    tests = [("die hunde sind in der strasse", "de"), ("the clouds are in the street", "en"), ("", "und"), (None, "und"), ("12 -- 3!", "und"), (LONG, None)]
    frame = spark.createDataFrame([(t, x, 1, "x") for t, x in tests], "text string, want string, n int, score string")
    for r in langmodel.identify(frame, model).collect():
        assert 0 <= r.score <= 1
        if r.row.want:
            assert r.lang_pred == r.row.want
        if r.row.want == "und":
            assert r.rejected and r.score == 0
    assert langmodel.train(docs.filter("doc_id < 0"))["languages"] == []
    none = langmodel.identify(frame, langmodel.train(docs.filter("doc_id < 0"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert langmodel.identify(frame.filter("n = 2"), model).count() == 0


def test_probabilities_of_a_model_sum_to_at_most_one(spark):
    """Over all words of up to eight letters; the rest is for longer words and other letters."""
    model = langmodel.train(spark.createDataFrame([("abab abba baab ab ba a", "x")], "text string, lang string"))
    words = ["".join(w) for n in range(1, 9) for w in itertools.product("ab", repeat=n)]
    nll, n = langmodel._entropies(words, model)
    assert n.tolist() == [len(w) + 1 for w in words]
    assert 0.5 < float(np.exp(-nll[:, 0]).sum()) <= 1 + 1e-6


def test_every_run_of_characters_is_kept_for_any_number_of_languages(spark):
    """More languages than 1024, and a language with more runs of four than 2^18 slots hold apart."""
    r = np.random.default_rng(5)
    text = " ".join("".join(chr(0x4E00 + c) for c in r.integers(0, 20_000, 8)) for _ in range(45_000))
    rows = [(text, "zz")] + [(f"word{chr(0x4E00 + i)} of text", f"l{i:04}") for i in range(1100)]
    model = langmodel.train(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model["languages"]) == 1101
    words = text.split(" ")
    runs = {(w[max(0, i - 3) : i], w[i : i + 1]) for w in words for i in range(len(w) + 1)}
    assert len(model["orders"][-1][3][0]) == len(runs) > 2**18


def test_clean_documents_of_a_rare_language_stay(spark):
    """With one labelled text, and with four: other texts of the language are not rejected; another language is, where texts tell."""
    r = np.random.default_rng(6)
    lexicon = {x: ["".join(r.choice(list(letters), r.integers(2, 7))) for _ in range(150)] for x, letters in {"aa": "abcdeik", "bb": "lmnopou", "cc": "rstvway", "dd": "αβγδεζη"}.items()}
    text = lambda x: " ".join(r.choice(lexicon[x], 60))
    known = [(text("aa"), "aa") for _ in range(60)] + [(text("bb"), "bb")] * 3 + [(text("cc"), "cc") for _ in range(4)]
    model = langmodel.train(spark.createDataFrame(known, "text string, lang string"))
    new = [(text(x), x) for x in ("aa", "bb", "cc", "dd") for _ in range(20)]
    got = langmodel.identify(spark.createDataFrame(new, "text string, want string"), model).collect()
    for x in ("aa", "bb", "cc"):
        assert all(g.lang_pred == x and not g.rejected for g in got if g.row.want == x)
    seen = langmodel.train(spark.createDataFrame([k for k in known if k[1] == "aa"], "text string, lang string"))
    assert all(g.rejected for g in langmodel.identify(spark.createDataFrame(new, "text string, want string"), seen).collect() if g.row.want == "dd")


def test_odd_documents_pass_through_languages(spark):
    docs = odd_documents(spark)
    out = langmodel.identify(docs, langmodel.train(docs))
    assert out.count() == 12
    assert out.filter("row.doc_id in (4, 5, 6, 10)").select("lang_pred").distinct().collect()[0][0] == "und"


def toxic_table(spark):
    r = np.random.default_rng(3)
    word = lambda: "".join(chr(97 + c) for c in r.integers(0, 26, 3))
    rows = []
    for i in range(500):
        said = [" ".join(word() for _ in range(6)) for _ in range(5)]
        if i % 5 == 0:
            said[i % 4] += " blorgh"
        rows.append((i, ". ".join(said) + ".", int(i % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_finds_the_sentence(spark):
    docs = toxic_table(spark)
    model = toxicity.train(docs.select("doc_id", "text"), docs.filter("doc_id < 400").select("doc_id", "toxic"))
    got = toxicity.score(docs, model).filter("row.doc_id >= 400").collect()
    assert [int(r.score >= 0.5) for r in got] == [r.row.toxic for r in got]
    for r in got:
        assert all("blorgh" in s.sentence for s in r.spans) and len(r.spans) == r.row.toxic
        assert all(r.row.text.encode()[s.start :].decode().startswith(s.sentence[:10]) for s in r.spans)


def test_noisy_or_of_sentences(spark):
    model = {"weights": np.zeros(2**toxicity.BITS, dtype=np.float32), "bias": 0.0}
    frame = spark.createDataFrame([("a b. c! d",), ("one",), ("",), (None,), ("...",)], "text string")
    assert [round(r.score, 6) for r in toxicity.score(frame, model).collect()] == [0.875, 0.5, 0, 0, 0]


def test_toxicity_reads_four_thousand_labels_of_either_kind(spark):
    """A word in 0.2 % of four thousand toxic documents is learned, in whichever of them it is."""
    assert toxicity.SAMPLE == 4000
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    docs = docs.withColumn("text", F.concat(F.lit("some plain words "), F.when(F.col("doc_id") % 1000 == 1, "blorgh").otherwise("here")))
    model = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    found = toxicity.score(spark.createDataFrame([("blorgh",), ("here",)], "text string"), model).collect()
    assert found[0].score > found[1].score + 0.05


def test_fit_in_runs_of_documents_does_not_depend_on_the_runs(monkeypatch):
    r = np.random.default_rng(8)
    sentences = r.integers(1, 5, 300)
    sizes = r.integers(0, 7, sentences.sum())
    items, y = r.integers(0, 90, sizes.sum()), r.integers(0, 2, 300)
    whole = toxicity.fit(y, items, sizes, sentences, np.ones(300))
    monkeypatch.setattr(toxicity, "STEP_ITEMS", 50)
    parts = toxicity.fit(y, items, sizes, sentences, np.ones(300))
    assert np.abs(whole[0] - parts[0]).max() < 1e-5 and abs(whole[1] - parts[1]) < 1e-9


def test_every_offending_sentence_has_its_span(spark):
    text = ". ".join(f"number {i} é" for i in range(50)) + "."
    model = {"weights": np.zeros(2**toxicity.BITS, dtype=np.float32), "bias": 1.0}
    (r,) = toxicity.score(spark.createDataFrame([(text,)], "text string"), model).collect()
    assert len(r.spans) == 50
    assert sorted(s.sentence for s in r.spans) == sorted(f"number {i} é." for i in range(50))
    assert all(r.row.text.encode()[s.start :].decode().startswith(s.sentence) for s in r.spans)


def test_weaker_sentences_that_carry_a_document_have_spans(spark):
    """Each sentence is below one half; two of log(1 + e^-0.5) = 0.474 are over log 2."""
    model = {"weights": np.zeros(2**toxicity.BITS, dtype=np.float32), "bias": -0.5}
    frame = spark.createDataFrame([("a b. c d. e f. g h.",), ("a b.",), (None,)], "text string")
    got = toxicity.score(frame, model).collect()
    assert [len(r.spans) for r in got] == [2, 0, 0] and [r.score >= 0.5 for r in got] == [True, False, False]
    assert [s.sentence for s in got[0].spans] == ["a b.", "c d."]


def test_toxicity_of_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, labels))
    assert out.count() == 12 and out.filter("score >= 0.5").count() == 0
    assert toxicity.score(no_documents(spark), toxicity.train(no_documents(spark), labels.limit(0))).count() == 0


def brute_targets(sizes, weights, limit):
    """Share, cut and share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > limit * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed.update({s: limit * sizes[s] for s in above})


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 500, "c": 40, None: 3, "d": 0}, {"a": 5}, {"a": 1, "b": 1, "c": 998}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, n long")
    got = {r.source: r.target for r in mixing.source_targets(frame, F.col("n")).collect()}
    want = brute_targets(sizes, (1, 2, 3), 3)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_of_odd_documents(spark):
    docs = odd_documents(spark)
    plan = mixing.mix_plan(docs).select("doc.doc_id", "size", "copies").collect()
    assert len(plan) == 12 and all(0 <= r.copies <= 3 for r in plan)
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in plan)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix_sources(docs.repartition(3)).collect()))
    assert mixing.mix_sources(no_documents(spark)).count() == 0


def test_mix_comes_near_its_targets(spark):
    rows = spark.range(6000).select("id", F.expr("repeat('w ', cast(1 + id % 40 as int))").alias("text"), F.expr("concat('s', cast(sqrt(id % 49) as int))").alias("source"))
    plan = mixing.mix_plan(rows, key="id")
    for r in plan.groupBy("doc.source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("n")).collect():
        assert abs(r.n / r.t - 1) < 0.12


def test_sources_of_fifty_documents_come_near_their_targets(spark):
    """Sizes of one to some hundreds of words, and in each source one document of a third of it."""
    r = np.random.default_rng(11)
    rows = []
    for source in range(30):
        sizes = (r.lognormal(3, 1, 50) + 1).astype(int)
        rows += [(source * 100 + i, "w " * int(n), f"s{source:02d}") for i, n in enumerate([*sizes, sizes.sum() // 2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix_plan(docs)
    found = plan.groupBy("doc.source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("n")).collect()
    assert max(abs(x.n / x.t - 1) for x in found) < 0.05
    whole = plan.select(F.max(F.col("copies") - F.floor(F.col("target") / F.col("source_size")))).first()[0]
    assert whole == 1


def test_source_column_with_a_dot(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "c", None)], "doc_id long, text string, `the.source` string")
    assert mixing.mix_plan(docs, source="the.source").count() == 2


def shards(rows, n=24, group="text", **options):
    return sharding.shard_by_splitters(rows, F.col(group), F.col("doc_id"), F.octet_length(F.coalesce("text", F.lit(""))) + 8, n, **options)


def test_shards_of_odd_documents(spark):
    got = shards(odd_documents(spark), 4).collect()
    assert len(got) == 12 and {r.shard for r in got} <= set(range(4))
    for k in range(4):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    assert shards(no_documents(spark)).count() == 0


def test_shards_are_even_with_a_large_group(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("t"), F.col("id"), F.expr("repeat('x', cast(id % 97 as int))"))).alias("text"))
    out = shards(rows)
    sums = [r.s for r in out.groupBy("shard").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.max("slot").alias("m")).collect()]
    assert len(sums) == 24 and max(sums) / min(sums) < 1.1
    assert out.groupBy("shard").agg((F.count("*") - F.max("slot")).alias("x")).filter("x <> 1").count() == 0
    spread = out.groupBy("row.text").agg(F.countDistinct("shard").alias("n")).filter("n > 1 and text <> 'same text'")
    assert spread.count() == 0


def test_small_groups_of_equal_texts_stay_whole(spark):
    """Groups of one to three equal texts: none lies in two shards, though every range boundary falls among them."""
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr("concat('t', cast(id % 2500 as string), repeat('x', cast(id % 2500 % 31 as int)))").alias("text"))
    out = shards(rows)
    assert out.groupBy("row.text").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0
    sums = [r.s for r in out.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sums) == 24 and max(sums) / min(sums) < 1.2
    assert out.groupBy("shard").agg((F.count("*") - F.max("slot")).alias("x")).filter("x <> 1").count() == 0


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "DRAWS", 1)
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    sums = [r.s for r in shards(rows).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert max(sums) / min(sums) < 1.2


def check_pieces(pieces, docs, window):
    tokens = encoder(public_tokenizers.path("byte_bpe_50k.json"))
    whole = {}
    for r in docs:
        whole.setdefault(r.doc_id, []).append(np.frombuffer(tokens.ids(r.text or "") + b"\0\0", dtype=np.uint16))
    used = {}
    for p in pieces:
        assert any(len(w) == p.doc_tokens and zlib.crc32(w[p.start : p.start + p.length].astype("<u4").tobytes()) == p.ids_crc32 for w in whole[p.doc_id])
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sum(p.length for p in pieces) == sum(len(w) for x in whole.values() for w in x)
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    return used


def test_packing_of_odd_documents(spark):
    docs = odd_documents(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    used = check_pieces(packing.pack(docs, path).collect(), docs.collect(), 1024)
    assert sum(sum(n for _, n in s) < 1024 for s in used.values()) <= docs.rdd.getNumPartitions()
    assert packing.pack(no_documents(spark), path).count() == 0


def test_ids_equal_those_of_the_whole_text():
    tokens = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", " ", "  a", "a ", " a", "a  b", "a\n b", "a \nb", "\n", "don't  do 's x's", "é è\tb", "x　y z", "<|endoftext|> hi", "日本 語", "1 23 4.5", "a\x85b c", "a\x1fb", "  x", "👍 🏽 ok", LONG[:3000]]
    for t in texts:
        assert np.frombuffer(tokens.ids(t), dtype=np.uint16).tolist() == tokens.whole.encode(t, add_special_tokens=False).ids


def test_retrieval_follows_the_best_unused_neighbour():
    r = np.random.default_rng(4)
    topics = [np.arange(20) + 100 * k for k in range(4)]
    docs = [r.choice(topics[i % 4], 15).astype(np.uint16) for i in range(40)]
    order = packing.retrieval_order(docs, np.ones(1 << 16), 15.0)
    assert sorted(order) == list(range(40))
    assert sum(a % 4 != b % 4 for a, b in zip(order, order[1:], strict=False)) == 3
    index = packing.Index(docs, np.ones(1 << 16), 15.0)
    t, c = np.unique(docs[0], return_counts=True)
    other = dict(zip(*np.unique(docs[4], return_counts=True), strict=True))
    want = sum(other[x] * 2.2 / (other[x] + 1.2) for x in t if x in other)
    assert abs(index.scores(0)[4] - want) < 1e-9


@pytest.mark.parametrize("filled", [0, 37])
def test_windows_are_filled_from_their_seeds(filled):
    r = np.random.default_rng(9)
    docs = [r.choice(60, r.integers(0, 25)).astype(np.uint16) for _ in range(50)] + [np.array([500 + i]) for i in range(4)]
    idf, window = r.random(1 << 16), 64
    # Plain scores, and the order as the docstring has it.
    usual = 12.0
    weight = [{t: idf[t] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * max(len(d), 1) / usual)) for t, c in zip(*np.unique(d, return_counts=True), strict=True)} for d in docs]
    score = lambda a, b: sum(w for t, w in weight[b].items() if t in weight[a])
    want, at, seed = [], filled, None

    def lay(d):
        nonlocal at
        want.append(d)
        before, at = at // window, at + len(docs[d]) + 1
        return at // window > before

    while len(want) < len(docs):
        left = [d for d in range(len(docs)) if d not in want]
        if seed is None:
            seed = left[0]
            if lay(seed):
                seed = seed if at % window else None
                continue
            left = left[1:]
        ranked, seed = sorted((d for d in left if score(seed, d) > 1e-12), key=lambda d: (-score(seed, d), d)), None
        for d in ranked:
            if lay(d):
                seed = d if at % window else None
                break
    assert packing.retrieval_order(docs, idf, usual, window, filled) == want


def test_retrieval_scores_all_terms_of_a_seed():
    """Forty light terms shared outweigh one heavy term; frequent terms and rare ones add up as by brute force."""
    idf = np.ones(1 << 16)
    idf[:30] = 5.0
    light = np.arange(100, 140)
    docs = [np.concatenate([np.arange(30), light]), np.array([0, 200, 201]), light, *(np.array([300 + i, 100]) for i in range(20))]
    docs = [d.astype(np.uint16) for d in docs]
    index = packing.Index(docs, idf, 20.0)
    assert packing.retrieval_order(docs, idf, 20.0)[:2] == [0, 2]
    for i, a in enumerate(docs):
        norm = [1.2 * (0.25 + 0.75 * len(d) / 20.0) for d in docs]
        want = [sum(idf[t] * 2.2 / (1 + norm[j]) for t in np.intersect1d(a, d)) for j, d in enumerate(docs)]
        assert np.abs(index.scores(i) - want).max() < 1e-9
