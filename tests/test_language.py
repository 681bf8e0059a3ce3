"""Sentences, learned base forms and wiki markup against plain Python."""

import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F
from tidemark.functions.markup import plain_text, strip_wiki
from tidemark.operators import morphology, sentences, text

PROSE = """Dr. Ames met Mr. Bell at 3.30 p.m. in the hall. He said: "It costs 4.50 now." She agreed! Did Mr. Bell pay? (Yes.) The
bill was no. 17 of the morning. J. R. Cole came later... and left. Mr. Bell saw Dr. Ames. the end. Nobody met dr. Ames or mr. Bell. A plan, etc. was
made. He left at 5. The hall closed. \u00bfQue? Si. \u201cOui.\u201d Non. In 1999. It ended"""


def plain_sentences(texts):
    token = re.compile(r"[^ \t\n\r\f]+")
    parts = re.compile(r"^[\"'(\[{\u00ab\u201c\u2018\u00bf\u00a1]*(.*?)([.!?\u2026]*)[\"')\]}\u00bb\u201d\u2019]*$", re.DOTALL)
    docs = [[(m.start(), m.end(), *parts.match(m[0]).groups()) for m in token.finditer(t or "")] for t in texts]
    total, stops, lowers = Counter(), Counter(), Counter()
    for d in docs:
        for _, _, core, mark in d:
            if core:
                total[core.lower()] += 1
                stops[core.lower()] += mark == "."
                lowers[core.lower()] += core[0].islower()
    n, s = sum(total.values()), sum(stops.values())

    def score(w):
        if not stops[w] or not re.search(r"[^\W\d_]", w) or s >= n:
            return 0
        bare, letters = total[w] - stops[w], len(w.replace(".", ""))
        ratio = -2 * (stops[w] * math.log(s / n) + bare * math.log(1 - s / n) - stops[w] * math.log(0.99) - bare * math.log(0.01))
        return ratio * math.exp(-letters) * (len(w) - letters + 1) * letters**-bare

    def ends(d, i):
        _, _, core, mark = d[i]
        if i == len(d) - 1:
            return True
        follows = d[i + 1][2]
        if not mark or follows[:1].islower():
            return False
        if mark != ".":
            return True
        if len(core) == 1 and core.isalpha():
            return False
        if score(core.lower()) >= 0.3 or re.match(r"^[0-9]+([.,:][0-9]+)*$", core):
            return follows[:1].isupper() and lowers[follows.lower()] > 0
        return True

    out = []
    for k, d in enumerate(docs):
        start, number = 0, 0
        for i in range(len(d)):
            if ends(d, i):
                out.append((k, number, d[start][0], d[i][1]))
                start, number = i + 1, number + 1
    return out


def test_sentences_equal_plain_ones(spark):
    texts = [PROSE, "", None, "  \n ", PROSE.replace("hall", "room"), "without marks", "One. Two.  Three!!  ", "... ?", PROSE * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in sentences.split_sentences(docs).collect())
    assert got == plain_sentences(texts)
    shown = [" ".join(PROSE[a:b].split()) for k, _, a, b in got if k == 0]
    assert "Dr. Ames met Mr. Bell at 3.30 p.m. in the hall." in shown
    assert any(x.endswith("no. 17 of the morning.") for x in shown) and any(x.startswith("J. R. Cole") for x in shown)


def test_abbreviations_are_found(spark):
    docs = spark.createDataFrame([(PROSE * 3,)], "text string")
    found = {r.word for r in sentences.abbreviations(sentences.word_counts(docs)).collect()}
    assert {"dr", "mr", "p.m"} <= found and not found & {"hall", "bell", "left"}


def test_sentences_of_repeated_keys_and_none(spark):
    docs = spark.createDataFrame([(1, "One. Two."), (1, "One. Two."), (None, "Three.")], "doc_id long, text string")
    assert Counter(tuple(r) for r in sentences.split_sentences(docs).collect()) == Counter({(1, 0, 0, 4): 2, (1, 1, 5, 9): 2, (None, 0, 0, 6): 1})
    assert sentences.split_sentences(docs.limit(0)).count() == 0


# Base forms

STEMS = "walk talk jump play paint cook clean open close turn watch reach crash wash fix mix box carry hurry study copy marry bake".split()


def regular(stem):
    s = "es" if re.search("(x|ch|sh)$", stem) else "s"
    if stem.endswith("y") and stem[-2] not in "aeiou":
        return [stem[:-1] + "ies", stem[:-1] + "ied", stem + "ing"]
    cut = stem.removesuffix("e")
    return [cut + "es" if cut != stem else stem + s, cut + "ed", cut + "ing"]


def plain_rules(pairs):
    seen = Counter()
    for form, lemma in set(pairs):
        same = next((i for i in range(min(len(form), len(lemma)), -1, -1) if form[:i] == lemma[:i]), 0)
        cut, put = len(form) - same, lemma[same:]
        seen.update((form[len(form) - n :], cut, put) for n in range(min(len(form), 6) + 1) if n >= cut)
    best = {}
    for (ending, cut, put), n in seen.items():
        if n > 1:
            best[ending] = min(best.get(ending, (0, 99, "")), (-n, cut, put))
    return {e: (cut, put) for e, (_, cut, put) in best.items()}


def plain_lemma(form, rules):
    for n in range(min(len(form), 6), -1, -1):
        if form[len(form) - n :] in rules:
            cut, put = rules[form[len(form) - n :]]
            return form[: len(form) - cut] + put
    return form


def test_learned_base_forms(spark):
    pairs = [(f, stem) for stem in STEMS for f in [stem, *regular(stem)]] + [("went", "go"), ("went", "go"), ("", "")]
    known = [p for i, p in enumerate(pairs) if i % 3]
    lemmas = spark.createDataFrame([*known, (None, "x"), ("y", None)], "form string, lemma string")
    rules = plain_rules(known)
    assert {r.ending: (r.cut, r.put) for r in morphology.learn_scripts(lemmas).collect()} == rules
    held = sorted({f for f, _ in pairs[::3]} - {f for f, _ in known})
    got = {r.form: r.lemma for r in morphology.lemmas_of(spark.createDataFrame([(f,) for f in held], "form string"), morphology.learn_scripts(lemmas)).collect()}
    assert got == {f: plain_lemma(f, rules) for f in held}
    right = sum(got[f] == lemma for f, lemma in pairs[::3] if f in got)
    # Two thirds of the forms that were held out; a table alone gets those that are their own base form.
    assert right / len(held) > 0.6 and right > sum(f == lemma for f, lemma in pairs[::3] if f in got)


def test_tokens_take_the_table_first(spark):
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog"), ("was", "be"), ("is", "be")], "form string, lemma string")
    tokens = spark.createDataFrame([(1, 0, "was"), (1, 1, "birds"), (1, 2, "sky"), (2, 0, None)], "doc_id long, pos int, token string")
    got = {(r.doc_id, r.pos): r.token for r in morphology.lemmatize_learned(tokens, lemmas).collect()}
    assert got == {(1, 0): "be", (1, 1): "bird", (1, 2): "sky", (2, 0): None}
    nothing = morphology.lemmatize_learned(tokens, lemmas.limit(0))
    assert {(r.doc_id, r.pos): r.token for r in nothing.collect()} == {(1, 0): "was", (1, 1): "birds", (1, 2): "sky", (2, 0): None}


# Markup


def well_formed(depth):
    """Markup together with its text, built outside in."""
    words = st.text(alphabet="abc ", min_size=1, max_size=6).map(lambda t: (t, t))
    if not depth:
        return words
    inner = st.lists(well_formed(depth - 1), max_size=3).map(lambda xs: ("".join(a for a, _ in xs), "".join(b for _, b in xs)))
    kinds = [
        inner.map(lambda x: ("{{" + x[0] + "|k=" + x[0] + "}}", " ")),
        inner.map(lambda x: ("{|" + x[0] + "|}", " ")),
        inner.map(lambda x: ("[[a b|" + x[0] + "]]", x[1])),
        inner.map(lambda x: ("[[File:a|" + x[0] + "]]", "")),
        inner.map(lambda x: ("<ref name=a>" + x[0] + "</ref>", " ")),
        inner.map(lambda x: ("<!--" + x[0] + "-->", " ") if "<!--" not in x[0] else x),
        inner.map(lambda x: ("<b>" + x[0] + "</b>", " " + x[1] + " ")),
        inner.map(lambda x: ("''" + x[0] + "'' ", x[1] + " ")),
        st.just(("<nowiki>{{a]]</nowiki>", "{{a]]")),
    ]
    return st.one_of(words, inner, *kinds)


@settings(max_examples=300, deadline=None)
@given(well_formed(4))
def test_markup_of_any_nesting(pair):
    markup, want = pair
    assert plain_text(markup).split() == want.split()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["{{", "}}", "{|", "|}", "[[", "]]", "|", "<!--", "-->", "<ref>", "</ref>", "word ", "<nowiki>", "</nowiki>"]), max_size=30))
def test_unbalanced_marks_do_no_harm(pieces):
    found = plain_text("".join(pieces))
    assert set(re.findall("[a-z]+", found)) <= {"word", "nowiki", "ref"}
    if not {"}}", "|}", "]]", "-->", "</ref>", "<nowiki>"} & set(pieces):
        assert found.count("word") == pieces.count("word ")


def test_deep_markup(spark):
    deep = "a " + "{{x|" * 50 + "y" + "}}" * 50 + " [[t|" * 50 + "b" + "]]" * 50 + " c"
    rows = spark.createDataFrame([(deep,), (None,), ("open {{ two",), ("",)], "t string")
    assert [r.x for r in rows.select(strip_wiki(F.col("t")).alias("x")).collect()] == ["a b c", None, "open two", ""]


def test_long_unbalanced_text_takes_linear_time():
    assert plain_text("{{" * 200_000 + "x") == "x"


@pytest.mark.parametrize("learn", [False, True])
def test_text_job_with_lemmas(spark, learn):
    from tidemark.plans.reports import concept_analysis

    words = ["cats dogs birds", "cats birds trees", "dogs trees stones", "stones birds hills"]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "form string, lemma string")
    _, _, terms = concept_analysis(docs, spark.createDataFrame([("the",)], "word string"), lemmas=lemmas, learn_lemmas=learn)
    found = {r.term for r in terms.collect()}
    assert {"cat", "dog"} <= found and ("bird" in found) == learn


def test_distinct_tokens_are_taken_apart(spark, tmp_path):
    from tidemark.operators import sentences

    rows = spark.createDataFrame([(1, "Ab. c ab. Ab"), (2, " "), (3, None)], "doc_id long, text string")
    rows.write.parquet(f"{tmp_path}/docs")
    counts = sentences.word_counts(spark.read.parquet(f"{tmp_path}/docs"))
    assert sorted(map(tuple, counts.collect())) == [("ab", 3, 2, 1), ("c", 1, 0, 1)]
    # Tokens are counted below the words.
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2
