"""From pages to weighted terms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.markup import strip_wiki
from tidemark.functions.text import is_only_letters, letter_tokens, strip_html
from tidemark.operators.joins import lookup_join
from tidemark.operators.stats import dense_index

MIN_LENGTH = 3


def page_filter(pages: DataFrame, marker: str = "disambiguation") -> DataFrame:
    """Articles only: no empty page, other namespace, redirect or marked title."""
    return pages.filter(
        (F.length(F.trim("text")) > 0)
        & (F.col("ns") == 0)
        & ~F.col("is_redirect")
        & ~F.col("title").contains(marker)
    )


def dump_pages(pages: DataFrame) -> DataFrame:
    """Title and plain text of the articles of a dump."""
    return page_filter(pages).select("title", strip_wiki(F.col("text")).alias("text"))


def html_title(c: Column) -> Column:
    return F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1)


def html_pages(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Key, title and plain text of HTML pages."""
    return pages.select(key, html_title(F.col(html)).alias("title"), strip_html(F.col(html)).alias("text"))


def tokenize(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of letters with their position: ``(doc_id, pos, token)``."""
    return docs.select(F.col(key).alias("doc_id"), F.posexplode(letter_tokens(F.col(text))).alias("pos", "token"))


def lemmatize(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace tokens by their base form where ``lemmas (form, lemma)`` has one."""
    keyed = lemmas.select(F.col("form").alias("token"), "lemma")
    joined = lookup_join(tokens, keyed, ["token"], "left")
    others = [c for c in tokens.columns if c != "token"]
    return joined.select(*others, F.coalesce("lemma", "token").alias("token"))


def term_filter(tokens: DataFrame, stopwords: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """Lower-cased terms of three letters or more that are no stopwords.

    The tests see the token as written, so a capitalised stopword passes a
    lower-case list unless ``case_sensitive`` is off.
    """
    token = F.col("token")
    letters = tokens.filter((F.length(token) >= MIN_LENGTH) & is_only_letters(token))
    words = stopwords.select(F.col("word").alias("_key"))
    if not case_sensitive:
        words = words.select(F.lower("_key").alias("_key"))
    keyed = letters.withColumn("_key", token if case_sensitive else F.lower(token))
    kept = lookup_join(keyed, words.distinct(), ["_key"], "left_anti")
    others = [c for c in tokens.columns if c != "token"]
    return kept.select(*others, F.lower("token").alias("term"))


def term_freq(terms: DataFrame) -> DataFrame:
    """Occurrences of each term in each document: ``(doc_id, term, tf)``."""
    return terms.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def doc_terms(docs: DataFrame, stopwords: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, term, tf, terms_in_doc)`` straight from texts, without a shuffle.

    The same as ``tokenize``, ``term_filter`` and ``term_freq`` in a row, with
    lower-case terms of three letters or more.  A document is one row, so its
    terms are counted where it lies.  The stopwords are a list for people to read
    and write, and are sent along.
    """
    stop = F.lit([r["word"] for r in stopwords.select("word").distinct().collect()]).cast("array<string>")
    wanted = F.filter(
        letter_tokens(F.col(text)), lambda t: (F.length(t) >= MIN_LENGTH) & is_only_letters(t) & ~F.array_contains(stop, t)
    )
    rows = docs.select(F.col(key).alias("doc_id"), F.transform(wanted, F.lower).alias("terms"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_count_terms, f"doc_id {kind}, term string, tf long, terms_in_doc long")


def _count_terms(batches):
    """Distinct terms of each row's list with their counts; a few thousand rows at a time."""
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            lists = batch.column(1)
            coded = lists.flatten().dictionary_encode()
            sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            owner = np.repeat(np.arange(len(batch)), sizes)
            pairs = owner.astype(np.int64) * max(len(coded.dictionary), 1) + np.asarray(coded.indices)
            found, n = np.unique(pairs, return_counts=True)
            row, term = np.divmod(found, max(len(coded.dictionary), 1))
            yield pa.record_batch(
                [batch.column(0).take(pa.array(row)), coded.dictionary.take(pa.array(term)), pa.array(n), pa.array(sizes[row].astype(np.int64))],
                names=["doc_id", "term", "tf", "terms_in_doc"],
            )


def term_freq_maps(tf: DataFrame) -> DataFrame:
    """One map per document; its size is bounded by the document's own text."""
    pairs = F.sort_array(F.collect_list(F.struct("term", F.col("tf").cast("int").alias("tf"))))
    return tf.groupBy("doc_id").agg(F.map_from_entries(pairs).alias("term_freqs"))


def doc_freq(tf: DataFrame) -> DataFrame:
    """Documents per term."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def top_vocabulary(df: DataFrame, terms: int) -> DataFrame:
    """The terms found in most documents; ties in alphabetical order."""
    return df.orderBy(F.desc("df"), F.asc("term")).limit(terms)


def idf(df: DataFrame, docs: DataFrame) -> DataFrame:
    """ln(number of documents / document frequency), without smoothing."""
    total = docs.agg(F.count("*")).scalar()
    return df.select("term", "df", F.log(total / F.col("df")).alias("idf"))


def term_doc_weight(tf: Column, terms_in_doc: Column, doc_freq: Column, docs: Column) -> Column:
    """Share of the term in the document times the log of its rarity."""
    return tf / terms_in_doc * F.log(docs / doc_freq)


def term_ids(df: DataFrame) -> DataFrame:
    """Ids from 0, the most widespread term first, ties in alphabetical order."""
    return dense_index(df, [F.desc("df"), F.asc("term")], "term_id")


def tfidf(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """Weights ``(doc_id, term, ..., w)`` for the terms of ``idf``.

    ``tf`` is read more than once; store it first when it comes from a long plan.
    A document's length counts all its terms, also those outside the
    vocabulary.  It is taken from ``terms_in_doc`` where ``tf`` has it already.
    """
    if "terms_in_doc" not in tf.columns:
        tf = tf.join(tf.groupBy("doc_id").agg(F.sum("tf").alias("terms_in_doc")), "doc_id")
    known = lookup_join(tf, idf, ["term"], "inner")
    return known.withColumn("w", F.col("tf") / F.col("terms_in_doc") * F.col("idf"))
