"""Operators over vectors, conversations and archive records; the pipeline."""

import hashlib
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import no_documents, odd_documents
from tidemark.llm import chat, revisits, spherical
from tidemark.session import checkpoint_folder

import corpus_pipeline
import public_tokenizers

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
HARD = "\\### Assistant: </turn> ok"
VECTORS = "vec_id long, embedding array<float>, label int, id int, n string, cell string"


def brute_links(rows, cosine):
    unit = {}
    for k, v, label in rows:
        ok = v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit[k] = np.array(v, dtype=float) / np.linalg.norm(v) if ok else None
    label = {k: x for k, _, x in rows}
    near = {
        a: {b for b in unit if a != b and unit[a] is not None and unit[b] is not None and label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine}
        for a in unit
    }
    name = {}
    for a in sorted(near):
        stack = [a]
        while stack:
            x = stack.pop()
            if x not in name:
                name[x] = a
                stack += near[x]
    return {a: (len(near[a]), name[a], name[a] == a) for a in near}


def vector_table(spark, rows):
    return spark.createDataFrame([(k, v, label, 1, "x", "c") for k, v, label in rows], VECTORS)


def check_vectors(spark, rows):
    got = spherical.near_duplicate_vectors(vector_table(spark, rows)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_links(rows, 0.98)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0], 1)]
    rows += [(8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [], 1), (12, [1.0, 0.0, 0.0], 1), (13, [1.0, 0.1], 1), (14, [1.0, 0.25], 1)]
    check_vectors(spark, rows)
    assert spherical.near_duplicate_vectors(vector_table(spark, rows).limit(0)).count() == 0


def test_no_link_is_lost_over_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(spherical, "CELL", 24)
    monkeypatch.setattr(spherical, "BLOCK", 16)
    r = np.random.default_rng(8)
    centre = r.normal(size=(12, 6))
    x = centre[r.integers(0, 12, 600)] + r.normal(size=(600, 6)) * 0.12
    x[100:140] = x[100]
    rows = [(k, [float(np.float32(c)) for c in v], int(k % 2)) for k, v in enumerate(x)]
    check_vectors(spark, rows)


def test_no_link_is_lost_over_parts(spark, monkeypatch):
    for name, value in (("CELL", 24), ("BLOCK", 16), ("PART", 60), ("HIGH", 8), ("WIDE", 12), ("EDGES", 20), ("AXES", 3)):
        monkeypatch.setattr(spherical, name, value, raising=False)
    r = np.random.default_rng(9)
    centre = r.normal(size=(10, 6))
    x = centre[r.integers(0, 10, 500)] + r.normal(size=(500, 6)) * 0.12
    x[:90] = x[0] + r.normal(size=(90, 6)) * 0.03
    x[100:140] = x[100]
    check_vectors(spark, [(k, [float(np.float32(c)) for c in v], int(k % 3 == 0)) for k, v in enumerate(x)])


def test_vectors_are_not_copied_to_the_cells_of_their_guests(spark, monkeypatch):
    monkeypatch.setattr(spherical, "CELL", 24)
    x = np.random.default_rng(10).normal(size=(2000, 32)).astype(np.float32)
    folder = checkpoint_folder(spark).removeprefix("file:")
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)
    before = size()
    got = spherical.near_duplicate_vectors(vector_table(spark, [(k, v.tolist(), 1) for k, v in enumerate(x)]))
    assert got.filter("n_links = 0 and kept").count() == 2000
    assert size() - before < x.nbytes


def test_conversations_read_back(spark):
    r = np.random.default_rng(6)
    said = ["", None, HARD, "<turn>system\n", "a\\", "\\n", "é\n\n</turn>\n", "word " * 900, "short one", "<", "\\\\<"]
    rows = [(-7, 0, "user", HARD), (-7, 1, "assistant", HARD), (None, 0, "assistant", "alone"), (5, None, None, None), (5, 1, "a\nb", "x"), (5, 1, "assistant", "y")]
    for conv in range(30):
        turns = [("system", "be kind")] * (conv % 2) + [("user" if i % 2 == 0 else "assistant", said[r.integers(len(said))]) for i in range(r.integers(1, 30))]
        rows += [(100 + conv, i, a, b) for i, (a, b) in enumerate(turns)]
    turns = spark.createDataFrame([(*x, 1, "w") for x in rows], "conv_id long, turn long, role string, text string, window int, loss string")
    windows = chat.chat_windows(turns, TOKENIZER, budget=200, history=60)
    got = {x.conv_id: x for x in chat.read_back(windows).collect()}
    for conv in {x[0] for x in rows}:
        mine = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        mine = [(x[2] or "", x[3] or "") for x in mine]
        target = "".join(b for a, b in mine if a == "assistant")
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(target), hashlib.sha256(target.encode()).hexdigest())
    for w in windows.collect():
        assert w.over_budget == (w.tokens > 200)
        found = chat.parsed(w.text)
        assert "".join(chat.rendered(*x)[0] for x in found) == w.text
        assert all(mark not in chat.escape(b) for _, b in found for mark in ("<", "</turn>", chat.OPEN))
        if w.window and w.conv_id and w.conv_id >= 100 and w.conv_id % 2:
            assert found[0] == ("system", "be kind") and w.repeated >= 1
        if w.over_budget:
            assert len(found) - w.repeated == 1
    assert chat.read_back(chat.chat_windows(turns.limit(0), TOKENIZER)).count() == 0


def test_latest_system_turn_is_kept_from_any_place(spark):
    said = [("user", "hello"), ("system", "first rules"), *[("user", "word " * 30)] * 6, ("system", "second rules"), *[("assistant", "word " * 30)] * 6]
    turns = spark.createDataFrame([(1, i, a, b) for i, (a, b) in enumerate(said)], "conv_id long, turn long, role string, text string")
    seen = 0
    for w in chat.chat_windows(turns, TOKENIZER, budget=100, history=0).collect():
        found = chat.parsed(w.text)
        systems = [("system", b) for a, b in said[:seen] if a == "system"][-1:]
        assert found[: w.repeated] == systems
        seen += len(found) - w.repeated
    assert seen == len(said)


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTP://WWW.Example.com:80/a/B/?utm_source=x&b=2&a=1#top", "example.com/a/B?a=1&b=2"),
        ("https://example.com", "example.com"),
        ("https://example.com/?ref=1", "example.com"),
        ("example.com/a?x=1?y", "example.com/a?x=1?y"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(revisits.canonical_url(F.col("u"))).first()[0] == want


def brute_revisits(rows):
    out = {}
    for r in rows:
        if r["kind"] != "revisit":
            continue
        key = lambda x: (x["time"] is not None, x["time"] or 0, x["record_id"])
        before = [x for x in rows if x["kind"] == "response" and x["url"] == r["url"] and x["url"] is not None and key(x) < key(r)]
        if not before:
            out[r["record_id"]] = ("orphan", None, None)
            continue
        was = max(before, key=key)
        both = [n for n in ("etag", "last_modified", "digest") if r[n] is not None and was[n] is not None]
        status = "mismatch" if any(r[n] != was[n] for n in both) else "resolved" if both else "unchecked"
        lower = lambda h: {k.lower(): v for k, v in (h or {}).items()}
        merged = {**lower(was["headers"]), **{k: v for k, v in lower(r["headers"]).items() if k in revisits.MERGED_HEADERS}}
        out[r["record_id"]] = (status, was["record_id"], None if status == "mismatch" else merged)
    return out


def test_revisits_with_one_hot_url(spark):
    r = np.random.default_rng(9)
    pick = lambda *x: x[r.integers(len(x))]
    rows = [
        {
            "record_id": i,
            "url": pick("h.org/hot", "h.org/hot", "h.org/a", "h.org/b", None),
            "time": pick(None, *map(int, range(40))),
            "kind": pick("response", "revisit", "revisit", "request"),
            "etag": pick(None, "e1", "e2"),
            "last_modified": pick(None, "m"),
            "digest": pick(None, None, "d1"),
            "headers": pick(None, {"ETag": str(i), "X-A": "1"}, {"content-type": "t", "Date": str(i)}),
        }
        for i in range(300)
    ]
    frame = spark.createDataFrame(
        [tuple(x.values()) for x in rows],
        "record_id long, url string, time long, kind string, etag string, last_modified string, digest string, headers map<string,string>",
    ).withColumn("page", F.lit("clash"))
    got = {x.record_id: (x.status, x.refers_to, x.headers) for x in revisits.resolve_revisits(frame).collect()}
    assert got == brute_revisits(rows)
    assert revisits.resolve_revisits(frame.limit(0)).count() == 0


def test_pipeline_on_odd_documents(spark, tmp_path):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 0, 0), (2, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (docs, no_documents(spark)):
        step = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            step = stage(spark, step, str(tmp_path))
            assert step.columns == docs.columns, name
        kept = step.select("doc_id").distinct().count()
        pieces = corpus_pipeline.STAGES[-1][1](spark, step, str(tmp_path))
        assert pieces.select("doc_id").distinct().count() == kept


def test_every_stage_takes_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    whole = {r.doc_id: r.text for r in docs.collect()}
    counts = []
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder).cache()
        counts.append(docs.count())
    left = docs.collect()
    assert counts[0] >= counts[1] > counts[2] and len({r.doc_id for r in left}) == len(left)
    assert all(whole[r.doc_id] == r.text for r in left)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t.lower())
    sets = {r.doc_id: {tuple(w[i : i + 5]) for w in [words(r.text)] for i in range(max(1, len(w) - 4))} for r in left}
    ids = sorted(sets)
    assert not any(5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) for a in ids for b in ids if a < b)


def test_pipeline_is_registered_whole():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "mixing", "packing"]


def test_one_defined_row_of_an_id_or_of_a_text_without_id_stays(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    same = [(1, f"words of text {i} that differ from all others {i * 7}", "en", s, None) for i in range(4) for s in ("b", "a")]
    nameless = [(None, t, "en", s, None) for t in ("alone", None) for s in ("d", "c")]
    docs = spark.createDataFrame([*same, *nameless, (2, "quite another text with words of its own", "en", "x", None)], schema)
    found = [sorted(map(str, corpus_pipeline.drop_near_duplicates(spark, d, "").collect())) for d in (docs, docs.repartition(5), docs.orderBy(F.desc("text"), "source"))]
    assert found[0] == found[1] == found[2] and len(found[0]) == 4
    assert sorted(corpus_pipeline.drop_near_duplicates(spark, docs, "").columns) == sorted(docs.columns)
