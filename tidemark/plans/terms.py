"""Text queries: tokens, frequencies, weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import morphology, sentences, text
from tidemark.plans.catalog import query, rounded, spread, table
from tidemark.session import cut_lineage

# Fixed values of the checks: stopwords and a small table of base forms.
STOPWORDS = ["the", "and", "are", "that", "with", "les", "des", "que", "der", "die", "und"]
LEMMAS = [("was", "be"), ("are", "be"), ("is", "be"), ("ores", "ore"), ("nteres", "nter"), ("queque", "que"), ("thes", "the")]


def docs(spark, folder):
    return spread(spark, folder, "documents", "doc_id", "text")


def stopwords(spark):
    return spark.createDataFrame([(w,) for w in STOPWORDS], "word string")


def lemmas(spark):
    return spark.createDataFrame(LEMMAS, "form string, lemma string")


def terms(spark, folder):
    return text.term_filter(text.tokenize(docs(spark, folder)), stopwords(spark))


def counts(spark, folder):
    return text.doc_terms(docs(spark, folder), stopwords(spark))


def stored_counts(spark, folder):
    """The counts, written to the checkpoint folder so that texts are read once."""
    return cut_lineage(counts(spark, folder))


STOP_SQL = ", ".join(f"'{w}'" for w in STOPWORDS)
TOKENS = """
    tokens AS (
        SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS token
        FROM (SELECT doc_id, regexp_extract_all(text, '\\p{L}+') AS t FROM documents))
"""
TERMS = TOKENS + f""",
    terms AS (SELECT doc_id, pos, lower(token) AS term FROM tokens WHERE length(token) > 2 AND token NOT IN ({STOP_SQL}))
"""
COUNTS = TERMS + """,
    tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    idf AS (SELECT term, df, ln((SELECT count(*) FROM documents) / df) AS idf FROM df)
"""


@query("tokenize", f"WITH {TOKENS} SELECT doc_id, pos, token FROM tokens")
def tokenize(spark, folder):
    return text.tokenize(docs(spark, folder))


LEMMA_SQL = ", ".join(f"('{a}', '{b}')" for a, b in LEMMAS)


@query(
    "lemmatize_dict",
    f"""
    WITH {TOKENS}
    SELECT doc_id, pos, coalesce(lemma, token) AS token
    FROM tokens LEFT JOIN (VALUES {LEMMA_SQL}) l(form, lemma) ON token = form
    """,
)
def lemmatize_dict(spark, folder):
    return text.lemmatize(text.tokenize(docs(spark, folder)), lemmas(spark))


LEARNED = """
    tokens AS (SELECT DISTINCT token FROM (SELECT unnest(regexp_extract_all(text, '\\p{L}+')) AS token FROM documents)),
    -- The table to learn from: of each capitalised word that the texts also have in lower case, the lower-cased word less
    -- the last letter.
    pairs AS (
        SELECT a.token AS form, lower(b.token)[:-2] AS lemma FROM tokens a JOIN tokens b ON lower(a.token) = b.token AND a.token <> b.token
        WHERE length(b.token) > 3 AND md5(b.token) < '8'),
    same AS (
        SELECT form, lemma, list_max(list_filter(range(least(length(form), length(lemma)) + 1), lambda i: form[1:i] = lemma[1:i])) AS same FROM pairs),
    scripts AS (SELECT form, length(form) - same AS cut, lemma[same + 1:] AS put FROM same),
    endings AS (
        SELECT right(form, n) AS ending, cut, put, count(*) AS seen
        FROM (SELECT *, unnest(range(least(length(form), 6) + 1)) AS n FROM scripts) WHERE n >= cut GROUP BY ALL HAVING count(*) > 1),
    rules AS (SELECT ending, cut, put FROM endings QUALIFY row_number() OVER (PARTITION BY ending ORDER BY seen DESC, cut, put) = 1),
    new AS (SELECT token AS form, unnest(range(least(length(token), 6) + 1)) AS n FROM tokens WHERE token NOT IN (SELECT form FROM pairs)),
    best AS (
        SELECT form, cut, put FROM new JOIN rules ON right(form, n) = ending QUALIFY row_number() OVER (PARTITION BY form ORDER BY n DESC) = 1)
"""


def learned_pairs(spark, folder):
    """A table of forms made from the texts: half of the words that occur with and without a capital."""
    tokens = text.tokenize(docs(spark, folder)).select("token").distinct()
    lower = tokens.select(F.col("token").alias("low"))
    both = tokens.join(lower, (F.lower("token") == F.col("low")) & (F.col("token") != F.col("low")))
    kept = both.filter((F.length("low") > 3) & (F.md5(F.col("low").cast("binary")) < "8"))
    return kept.select(F.col("token").alias("form"), F.substr("low", F.lit(1), F.length("low") - 1).alias("lemma"))


@query(
    "lemmatize_learned",
    f"""
    WITH {LEARNED}
    SELECT token AS form, coalesce(p.lemma, left(token, length(token) - cut) || put, token) AS lemma
    FROM tokens LEFT JOIN pairs p ON token = p.form LEFT JOIN best b ON token = b.form
    """,
)
def lemmatize_learned(spark, folder):
    """The base form of every word of the texts, in the table or not."""
    words = text.tokenize(docs(spark, folder)).select("token").distinct().withColumn("form", F.col("token"))
    return morphology.lemmatize_learned(words, learned_pairs(spark, folder)).withColumnRenamed("token", "lemma")


BLANK_SQL = "[^ \\t\\n\\r\\f]"
# The classes of sentences.PARTS, quoted for SQL.
PARTS_SQL = sentences.PARTS.replace("'", "''")
SENTENCES = f"""
    pieces AS (
        SELECT doc_id, i, p, sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i) AS ends
        FROM (SELECT doc_id, unnest(l) AS p, generate_subscripts(l, 1) AS i
              FROM (SELECT doc_id, regexp_extract_all(text, '[ \\t\\n\\r\\f]*{BLANK_SQL}+') AS l FROM documents))),
    places AS (SELECT *, regexp_extract(p, '{BLANK_SQL}+') AS token FROM pieces),
    parts AS (
        SELECT doc_id, i, ends, ends - length(token) AS starts,
               regexp_extract(token, '{PARTS_SQL}', 1) AS core, regexp_extract(token, '{PARTS_SQL}', 2) AS mark FROM places),
    words AS (
        SELECT lower(core) AS word, count(*) AS total, count(*) FILTER (mark = '.') AS stops,
               count(*) FILTER (regexp_matches(core, '^\\p{{Ll}}')) AS lowers FROM parts WHERE core <> '' GROUP BY 1)
"""


@query("word_stop_counts", f"WITH {SENTENCES} SELECT word, total, stops, lowers FROM words")
def word_stop_counts(spark, folder):
    return sentences.word_counts(docs(spark, folder))


@query(
    "sentence_split",
    f"""
    WITH {SENTENCES},
    sums AS (SELECT sum(total)::DOUBLE AS n, sum(stops)::DOUBLE AS s FROM words),
    scored AS (
        SELECT word, -2 * (stops * ln(s / n) + (total - stops) * ln(1 - s / n) - stops * ln(0.99) - (total - stops) * ln(0.01)) * exp(-letters)
               * (length(word) - letters + 1) * pow(letters, stops - total) AS score
        FROM (SELECT *, length(replace(word, '.', ''))::DOUBLE AS letters FROM words), sums
        WHERE stops > 0 AND s < n AND regexp_matches(word, '\\p{{L}}')),
    ahead AS (
        SELECT *, lower(core) AS word, lead(starts) OVER w AS next, lead(core) OVER w AS follows FROM parts
        WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    places_left AS (
        SELECT a.*, next IS NULL OR (mark <> '' AND NOT regexp_matches(follows, '^\\p{{Ll}}') AND (
            mark <> '.' OR (NOT regexp_matches(a.word, '^\\p{{L}}$') AND (
                NOT (coalesce(score, 0) >= 0.3 OR regexp_matches(a.word, '^[0-9]+([.,:][0-9]+)*$'))
                OR (regexp_matches(follows, '^\\p{{Lu}}') AND coalesce(c.lowers, 0) > 0))))) AS boundary
        FROM ahead a LEFT JOIN scored s ON s.word = a.word LEFT JOIN words c ON c.word = lower(follows)),
    firsts AS (SELECT doc_id, min(starts) AS first FROM parts GROUP BY 1)
    SELECT doc_id, CAST(row_number() OVER w - 1 AS INTEGER) AS sentence,
           CAST(coalesce(lag(next) OVER w, first) AS INTEGER) AS start, CAST(ends AS INTEGER) AS end
    FROM places_left JOIN firsts USING (doc_id) WHERE boundary WINDOW w AS (PARTITION BY doc_id ORDER BY i)
    """,
)
def sentence_split(spark, folder):
    """Sentences of every text as spans; abbreviations are found in the texts."""
    return sentences.split_sentences(docs(spark, folder))


@query("term_filter", f"WITH {TERMS} SELECT doc_id, pos, term FROM terms")
def term_filter(spark, folder):
    return terms(spark, folder)


@query("term_freq", f"WITH {COUNTS} SELECT doc_id, term, tf FROM tf")
def term_freq(spark, folder):
    return counts(spark, folder).select("doc_id", "term", "tf")


@query("doc_freq", f"WITH {COUNTS} SELECT term, df FROM df")
def doc_freq(spark, folder):
    return text.doc_freq(counts(spark, folder))


@query("top_vocabulary", f"WITH {COUNTS} SELECT term, df FROM df ORDER BY df DESC, term LIMIT 1000")
def top_vocabulary(spark, folder):
    return text.top_vocabulary(text.doc_freq(counts(spark, folder)), 1000)


@query("idf", f"WITH {COUNTS} SELECT term, df, round(idf, 8) AS idf FROM idf")
def idf(spark, folder):
    return text.idf(text.doc_freq(counts(spark, folder)), docs(spark, folder)).withColumn("idf", rounded("idf", 8))


@query("term_ids", f"WITH {COUNTS} SELECT term, df, row_number() OVER (ORDER BY df DESC, term) - 1 AS term_id FROM df")
def term_ids(spark, folder):
    return text.term_ids(text.doc_freq(counts(spark, folder)))


@query(
    "term_doc_weight",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           round(l_linenumber / (l_linenumber + l_quantity) * ln(100.0 / (1 + l_quantity)), 8) AS w
    FROM lineitem
    """,
)
def term_doc_weight(spark, folder):
    w = text.term_doc_weight(
        F.col("l_linenumber"), F.col("l_linenumber") + F.col("l_quantity"), 1 + F.col("l_quantity"), F.lit(100.0)
    )
    return table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", rounded(w, 8).alias("w"))


@query(
    "tfidf",
    f"""
    WITH {COUNTS}
    SELECT doc_id, term, round(tf / sum(tf) OVER (PARTITION BY doc_id) * idf, 8) AS w FROM tf JOIN idf USING (term)
    """,
)
def tfidf(spark, folder):
    tf = stored_counts(spark, folder)
    weights = text.tfidf(tf, text.idf(text.doc_freq(tf), docs(spark, folder)))
    return weights.select("doc_id", "term", rounded("w", 8).alias("w"))
