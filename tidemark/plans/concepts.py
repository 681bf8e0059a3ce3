"""Matrix and relevance queries on given factors, and the decompositions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import lsa, matrix, text
from tidemark.operators.gram import gram_matrix
from tidemark.plans.catalog import query, rounded, table
from tidemark.plans.reports import concept_analysis, relevance
from tidemark.plans.terms import COUNTS, counts, docs, stopwords

ROW = 7
WIDTH = 64


def rows(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )


def names(spark, folder):
    em = table(spark, folder, "embeddings")
    return em.select(F.col("vec_id").alias("id"), F.concat_ws("-", F.lit("item"), "label", "vec_id").alias("name"))


def singular(spark, folder):
    """Column lengths as given singular values: one row per column."""
    cells = matrix.to_entries(rows(spark, folder))
    return cells.groupBy("col").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("s"))


M = """
    m AS (SELECT vec_id AS id, label, CAST(i - 1 AS INTEGER) AS j, CAST(embedding[i] AS DOUBLE) AS v
          FROM embeddings, range(1, 65) t(i)),
    s AS (SELECT j, sqrt(sum(v * v)) AS s FROM m GROUP BY j),
    ms AS (SELECT id, m.j, v * s AS v FROM m JOIN s ON m.j = s.j),
    nm AS (SELECT id, j, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS v FROM ms)
"""


def long(df, digits=8):
    return df.select("id", F.posexplode("vec").alias("j", "v")).withColumn("v", rounded("v", digits))


def scored(df):
    return df.withColumn("score", rounded("score", 8))


@query("matrix_row", f"WITH {M} SELECT j, v FROM m WHERE id = {ROW}")
def matrix_row(spark, folder):
    picked = rows(spark, folder).filter(F.col("id") == ROW)
    return picked.select(F.posexplode("vec").alias("j", "v"))


@query("matrix_diag", f"WITH {M} SELECT id, j, round(v, 8) AS v FROM ms")
def matrix_diag(spark, folder):
    return long(matrix.multiply_diagonal(rows(spark, folder), singular(spark, folder)))


@query("matrix_row_normalize", f"WITH {M} SELECT id, j, round(v, 8) AS v FROM nm")
def matrix_row_normalize(spark, folder):
    return long(lsa.cosine_rows(rows(spark, folder), singular(spark, folder)))


@query(
    "matrix_vector",
    f"WITH {M} SELECT id, round(sum(v * s), 8) AS score FROM m JOIN s ON m.j = s.j GROUP BY id",
)
def matrix_vector(spark, folder):
    vector = matrix.diagonal(singular(spark, folder))
    return scored(matrix.multiply_vector(rows(spark, folder), vector))


@query(
    "matrix_transpose_vector",
    f"WITH {M} SELECT j AS col, round(sum(v * (label + 1)), 8) AS v FROM m GROUP BY j",
)
def matrix_transpose_vector(spark, folder):
    weights = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), (F.col("label") + 1).cast("double").alias("w")
    )
    return matrix.transpose_multiply(rows(spark, folder), weights).withColumn("v", rounded("v", 8))


def top_sql(direction: str) -> str:
    return f"""
        SELECT j AS concept, CAST(rank AS INTEGER) AS rank, id, round(v, 8) AS score,
               'item-' || label || '-' || id AS name
        FROM (SELECT *, row_number() OVER (PARTITION BY j ORDER BY v {direction}, id {direction}) AS rank
              FROM m WHERE j < 4)
        WHERE rank <= 10
    """


@query("top_terms_per_concept", f"WITH {M} {top_sql('ASC')}")
def top_terms_per_concept(spark, folder):
    return scored(lsa.top_terms_per_concept(rows(spark, folder), names(spark, folder)))


@query("top_docs_per_concept", f"WITH {M} {top_sql('DESC')}")
def top_docs_per_concept(spark, folder):
    return scored(lsa.top_docs_per_concept(rows(spark, folder), names(spark, folder)))


@query(
    "concept_report",
    f"""
    WITH {M}, t AS ({top_sql('ASC')}), d AS ({top_sql('DESC')}),
    tl AS (SELECT concept, string_agg(name, ', ' ORDER BY rank) AS terms FROM t GROUP BY concept),
    dl AS (SELECT concept, string_agg(name, ', ' ORDER BY rank) AS docs FROM d GROUP BY concept)
    SELECT concept, terms, docs FROM tl JOIN dl USING (concept)
    """,
)
def concept_report(spark, folder):
    m, n = rows(spark, folder), names(spark, folder)
    return lsa.concept_report(lsa.top_terms_per_concept(m, n), lsa.top_docs_per_concept(m, n))


def best_sql(source: str, vector: str, tie: str) -> str:
    return f"""
        SELECT a.id, round(sum(a.v * q.v), 8) AS score
        FROM {source} a JOIN {vector} q ON a.j = q.j GROUP BY a.id ORDER BY sum(a.v * q.v) DESC, a.id {tie} LIMIT 10
    """


NAMED = "SELECT b.id, score, 'item-' || label || '-' || b.id AS name FROM b JOIN embeddings ON b.id = vec_id"


@query("top_docs_for_doc", f"WITH {M}, q AS (SELECT j, v FROM nm WHERE id = {ROW}), b AS ({best_sql('nm', 'q', 'DESC')}) {NAMED}")
def top_docs_for_doc(spark, folder):
    us = lsa.cosine_rows(rows(spark, folder), singular(spark, folder))
    return scored(lsa.named_scores(lsa.top_docs_for_doc(us, ROW), names(spark, folder)))


@query("top_terms_for_term", f"WITH {M}, q AS (SELECT j, v FROM nm WHERE id = {ROW}), b AS ({best_sql('nm', 'q', 'ASC')}) {NAMED}")
def top_terms_for_term(spark, folder):
    vs = lsa.cosine_rows(rows(spark, folder), singular(spark, folder))
    return scored(lsa.named_scores(lsa.top_terms_for_term(vs, ROW), names(spark, folder)))


@query("top_docs_for_term", f"WITH {M}, q AS (SELECT j, v FROM m WHERE id = {ROW}), b AS ({best_sql('ms', 'q', 'DESC')}) {NAMED}")
def top_docs_for_term(spark, folder):
    m = rows(spark, folder)
    us = lsa.scaled(m, singular(spark, folder))
    return scored(lsa.named_scores(lsa.top_docs_for_term(us, m, ROW), names(spark, folder)))


# Frequent words of the documents, one twice and one unknown.
QUERY = ["erat", "hat", "ing", "ing", "xyzzy"]
QUERY_SQL = f"""
    vocab AS (SELECT term, idf, row_number() OVER (ORDER BY df DESC, term) - 1 AS id FROM idf),
    qv AS (SELECT id, sum(idf) AS w FROM vocab JOIN (SELECT unnest({QUERY}) AS term) USING (term) GROUP BY id)
"""


def query_weights(spark, folder):
    df = text.doc_freq(counts(spark, folder))
    vocabulary = text.term_ids(text.idf(df, docs(spark, folder))).withColumnRenamed("term_id", "id")
    return lsa.query_vector(spark.createDataFrame([(t,) for t in QUERY], "term string"), vocabulary)


@query("query_vector", f"WITH {COUNTS}, {QUERY_SQL} SELECT id, round(w, 8) AS w FROM qv")
def query_vector(spark, folder):
    return query_weights(spark, folder).withColumn("w", rounded("w", 8))


@query(
    "top_docs_for_query",
    f"""
    WITH {COUNTS}, {QUERY_SQL}, {M},
    cw AS (SELECT j, sum(m.v * w) AS v FROM m JOIN qv ON m.id = qv.id GROUP BY j),
    b AS ({best_sql('ms', 'cw', 'DESC')}) {NAMED}
    """,
)
def top_docs_for_query(spark, folder):
    m = rows(spark, folder)
    us = lsa.scaled(m, singular(spark, folder))
    best = lsa.top_docs_for_query(us, m, query_weights(spark, folder))
    return scored(lsa.named_scores(best, names(spark, folder)))


@query(
    "svd_fit",
    f"WITH {M} SELECT id, round(sqrt(sum(v * v)), 6) AS length FROM m GROUP BY id",
)
def svd_fit(spark, folder):
    """At full rank the rows of US are as long as those of the matrix."""
    found = lsa.svd(rows(spark, folder), WIDTH)
    us = lsa.scaled(found.u, found.s)
    from tidemark.functions.arrays import norm

    return us.select("id", rounded(norm(F.col("vec")), 6).alias("length"))


@query("svd_values")
def svd_values(spark, folder):
    return lsa.svd(rows(spark, folder), 10).s


@query(
    "svd_power_iter",
    f"""
    WITH {M},
    x0 AS (SELECT DISTINCT j, 1.0 AS x FROM m),
    y1 AS (SELECT id, sum(v * x) AS y FROM m JOIN x0 USING (j) GROUP BY id),
    r1 AS (SELECT j, sum(v * y) AS x FROM m JOIN y1 USING (id) GROUP BY j),
    x1 AS (SELECT j, x / sqrt(sum(x * x) OVER ()) AS x FROM r1),
    y2 AS (SELECT id, sum(v * x) AS y FROM m JOIN x1 USING (j) GROUP BY id),
    r2 AS (SELECT j, sum(v * y) AS x FROM m JOIN y2 USING (id) GROUP BY j)
    SELECT j AS col, round(x / sqrt(sum(x * x) OVER ()), 8) AS x FROM r2
    """,
)
def svd_power_iter(spark, folder):
    """Two rounds of the block iteration with one column, from all ones."""
    entries = matrix.to_entries(rows(spark, folder))
    ones = entries.select(F.col("col").alias("id")).distinct().withColumn("vec", F.array(F.lit(1.0)))
    out = lsa.power_rounds(entries, ones, 1, 2)[0]
    return out.select(F.col("id").alias("col"), rounded(F.col("vec")[0], 8).alias("x"))


@query("lsa_concepts")
def lsa_concepts(spark, folder):
    """The whole text job: concepts of the documents with their terms."""
    report, _, _ = concept_analysis(docs(spark, folder), stopwords(spark))
    return report


@query(
    "svd_laws",
    f"""
    WITH {M},
    g AS (SELECT p.j AS i, q.j AS j, sum(p.v * q.v) AS g FROM m p JOIN m q ON p.id = q.id GROUP BY 1, 2)
    SELECT round(sum(g * g) / sum(CASE WHEN i = j THEN g END) / sum(CASE WHEN i = j THEN g END), 8) AS fourth, true AS orthonormal FROM g
    """,
)
def svd_laws(spark, folder):
    """At full rank the fourth powers of the singular values add up to the squared length of A'A, and V is orthonormal."""
    found = lsa.svd(rows(spark, folder), WIDTH)
    v = gram_matrix(found.v, F.col("vec"), WIDTH)
    square = F.sum(F.col("s") ** 2)
    out = found.s.agg(rounded(F.sum(F.col("s") ** 4) / square / square, 8).alias("fourth"))
    return out.withColumn("orthonormal", F.lit(bool(np.abs(v - np.eye(WIDTH)).max() < 1e-8)))


@query(
    "lsa_laws",
    f"""
    WITH {COUNTS}, useful AS (SELECT term FROM idf WHERE idf > 0)
    SELECT (SELECT count(*) FROM useful) AS terms, (SELECT count(DISTINCT doc_id) FROM tf WHERE term IN (SELECT term FROM useful)) AS documents,
           true AS orthonormal, true AS satisfied, true AS converged,
           CAST(least(100, (SELECT count(DISTINCT doc_id) FROM tf WHERE term IN (SELECT term FROM useful))) AS INTEGER) AS rank
    """,
)
def lsa_laws(spark, folder):
    """The decomposition of the text job at its rank: every term and document has its row, both sides are orthonormal,
    and A v = s u and A'u = s v."""
    _, found, terms = concept_analysis(docs(spark, folder), stopwords(spark))
    k = found.s.count()
    off = [np.abs(gram_matrix(side, F.col("vec"), k) - np.eye(k)).max() for side in (found.u, found.v)]
    tf = counts(spark, folder).join(terms.select("id", "term", "idf"), "term")
    entries = tf.select(F.col("doc_id").alias("row"), F.col("id").alias("col"), (F.col("tf") / F.col("terms_in_doc") * F.col("idf")).alias("v"))
    s = [r["s"] for r in found.s.orderBy("col").collect()]
    scale = F.lit(s).cast("array<double>")

    def apart(side, other, key, across):
        """Largest difference between the product with one side and s times the other."""
        image = lsa._half_step(entries, side, key, across, k).select("id", F.col("vec").alias("image"))
        off = F.zip_with("image", F.zip_with("vec", scale, lambda x, y: x * y), lambda x, y: F.abs(x - y))
        return other.join(image, "id").agg(F.max(F.array_max(off))).first()[0] or 0.0

    # One side is the exact image of the other, the other way round it holds within the tolerance of the fit.
    gaps = apart(found.v, found.u, "row", "col"), apart(found.u, found.v, "col", "row")
    row = (found.v.count(), found.u.count(), bool(max(off) < 1e-6), bool(min(gaps) < 1e-6 * s[0]), bool(max(gaps) < 1e-3 * s[0]), k)
    return spark.createDataFrame([row], "terms long, documents long, orthonormal boolean, satisfied boolean, converged boolean, rank int")


@query(
    "lsa_relevance_laws",
    "SELECT true AS own_first, true AS same_scores, CAST(40 AS BIGINT) AS rows",
)
def lsa_relevance_laws(spark, folder):
    """Lookups by name on the fitted decomposition: a term and a document are most like themselves, and the scores are
    those of the stored factors."""
    _, found, terms = concept_analysis(docs(spark, folder), stopwords(spark))
    doc_names = docs(spark, folder).select(F.col("doc_id").alias("id"), F.concat(F.lit("doc "), "doc_id").alias("name"))
    term, doc = terms.orderBy("id").first(), doc_names.orderBy("id").first()
    got = relevance(found, terms, doc_names, term["term"], doc["name"], [term["term"]]).toPandas()
    s = np.array([r["s"] for r in found.s.orderBy("col").collect()])
    row = lambda side, i: np.array(side.filter(F.col("id") == i).first()["vec"])
    own, same = True, True
    for lookup, mine in got.groupby("lookup"):
        top = mine.sort_values(["score", "id"], ascending=False).iloc[0]
        if "like" in lookup:
            own &= abs(mine[mine.name == (term["term"] if "terms" in lookup else doc["name"])].score.max() - 1) < 1e-9
            side, i = (found.v, term["id"]) if "terms" in lookup else (found.u, doc["id"])
            a, b = row(side, i) * s, row(side, int(top.id)) * s
            want = a @ b / np.linalg.norm(a) / np.linalg.norm(b)
        else:
            want = row(found.u, int(top.id)) * s @ row(found.v, term["id"]) * (term["idf"] if "query" in lookup else 1.0)
        same &= bool(abs(want - top.score) < 1e-9 * max(1.0, abs(want)))
    return spark.createDataFrame([(bool(own), same, len(got))], "own_first boolean, same_scores boolean, rows long")
