import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import classify, clustering, joins, lsa, matrix, recommend, sampling, stats, text, timeseries


def dense(spark, table):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(table)], "id long, vec array<double>")


def array(df):
    return np.array([r.vec for r in df.orderBy("id").collect()])


def test_joins_agree_on_a_hot_key(spark):
    big = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k")
    small = spark.range(0, 2000, 2).selectExpr("id AS k", "id * 10 AS v")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = joins.lookup_join(big, small, ["k"], how)
        b = joins.salted_join(big, small, ["k"], ["id"], how)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_salt_takes_no_doubles(spark):
    frame = spark.range(3).selectExpr("id AS k", "rand() AS x")
    with pytest.raises(TypeError):
        joins.salted_join(frame, frame.select("k"), ["k"], ["x"])


def test_lookups_start_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    frame = spark.range(1000).selectExpr("CAST(id % 20 AS string) AS series", "date_add(DATE '2020-01-01', CAST(id AS int)) AS date", "1.0D AS value")
    ratings = spark.range(100).selectExpr("id AS user", "id AS item", "1.0D AS rating")
    alias = spark.range(50).selectExpr("id AS bad", "id + 1 AS good")
    spark.sparkContext.setJobGroup("lazy", "lookups")
    try:
        timeseries.min_history(frame, 10)
        joins.resolve_alias(ratings, alias)
        joins.semi_filter(ratings, alias.selectExpr("bad AS item"), ["item"])
        assert not tracker.getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_alias_is_one_hop_and_keeps_rows_apart(spark):
    ratings = spark.createDataFrame([(1, 5, 2.0), (1, 6, 3.0), (2, 7, 1.0)], "user int, item int, rating double")
    alias = spark.createDataFrame([(5, 6), (6, 9)], "bad int, good int")
    got = sorted(tuple(r) for r in joins.resolve_alias(ratings, alias).collect())
    assert got == [(1, 6, 2.0), (1, 9, 3.0), (2, 7, 1.0)]
    both = spark.createDataFrame([(5, 9), (6, 9)], "bad int, good int")
    got = sorted(tuple(r) for r in joins.resolve_alias(ratings, both, merge=True).collect())
    assert got == [(1, 9, 5.0), (2, 7, 1.0)]


def test_lookup_by_key(spark):
    df = spark.range(5)
    assert joins.lookup_by_key(df, "id", 3).count() == 1
    with pytest.raises(KeyError):
        joins.lookup_by_key(df, "id", 30, must_exist=True)


def test_dense_index(spark):
    df = spark.range(1000).selectExpr("id", "id % 10 AS g").repartition(7)
    got = stats.dense_index(df, [F.desc("g"), F.asc("id")], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1000))
    assert [(r.g, r.id) for r in got] == sorted(((r.g, r.id) for r in got), key=lambda t: (-t[0], t[1]))
    assert stats.dense_index(df.limit(0), [F.asc("id")], "n").count() == 0


def test_samples_and_splits(spark):
    df = spark.range(20_000)
    assert df.count() == sum(p.count() for p in sampling.random_split(df, [0.8, 0.1, 0.1], 1))
    shares = sampling.hash_split(df, F.col("id"), 1).groupBy("part").count().collect()
    shares = {r["part"]: r["count"] / 20_000 for r in shares}
    assert shares["train"] == pytest.approx(0.8, abs=0.02) and shares["test"] == pytest.approx(0.1, abs=0.02)
    assert sampling.bernoulli_sample(df, 0.1, 1).count() == pytest.approx(2000, abs=250)
    assert sampling.hash_sample(df, F.col("id"), 0.1, 1).count() == pytest.approx(2000, abs=250)
    copies = sampling.poisson_sample(df, "id", 1)
    assert copies.columns == ["id"]
    assert copies.count() == pytest.approx(20_000, abs=600)


def test_precision_recall_of_absent_classes(spark):
    rows = [(0, 0)] * 6 + [(0, 1)] * 2 + [(1, 1)] * 2 + [(2, 0)] * 2
    df = spark.createDataFrame(rows, "label int, prediction int")
    got = {r["class"]: (r.precision, r.recall, r.f1) for r in classify.precision_recall(df, 5).collect()}
    assert got[0] == (0.75, 0.75, 0.75)
    assert got[1] == (0.5, 1.0, pytest.approx(2 / 3))
    assert got[2] == (0.0, 0.0, None)
    assert got[3] == (0.0, None, None) and len(got) == 5
    assert classify.accuracy(df).first()[0] == pytest.approx(8 / 12)


def test_prior_baseline_with_a_missing_class(spark):
    a = spark.createDataFrame([(0,), (0,), (1,), (2,)], "label int")
    b = spark.createDataFrame([(0,), (2,)], "label int")
    assert stats.prior_baseline(a, b).first()[0] == pytest.approx(0.5 * 0.5 + 0.25 * 0.5)


def test_tree_learns_a_simple_rule(spark):
    df = spark.range(400).selectExpr("cast(id % 4 AS double) AS label", "array(cast(id % 4 AS double), cast(id AS double)) AS features")
    model = classify.fit_tree(df)
    assert classify.accuracy(classify.predict(model, df)).first()[0] == 1.0
    assert classify.root_split(model)[0] == 0


def test_kmeans_and_distances(spark):
    gen = np.random.default_rng(0)
    pts = np.vstack([gen.normal(0, 1, (50, 3)), gen.normal(20, 1, (50, 3))])
    df = spark.createDataFrame([([float(v) for v in p],) for p in pts], "features array<double>")
    rows = clustering.centers(clustering.fit(df))
    assert len(rows) == 2
    got = clustering.assign(df, rows).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in got) == [50, 50]
    want = np.min([np.linalg.norm(pts - np.array(c), axis=1) for c in rows], axis=0).mean()
    assert clustering.clustering_score(df, rows).first()[0] == pytest.approx(want)
    sweep = clustering.k_sweep(df, ks=(2, 4)).orderBy("k").collect()
    assert [r.k for r in sweep] == [2, 4] and sweep[0].score == pytest.approx(want, rel=1e-6)
    table = clustering.purity_table(clustering.assign(df.withColumn("label", F.lit("x")), rows))
    assert clustering.formatted_purity(table).first()[0] == "0" + " " * 17 + "x" + " " * 6 + "50"


def test_recommendations(spark):
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id int, features array<float>")
    items = spark.createDataFrame([(10, [3.0, 0.0]), (11, [5.0, 9.0]), (12, [3.0, 1.0])], "id int, features array<float>")
    best = recommend.recommend(users, items, 1, 2)
    assert [(r["rank"], r["item"]) for r in best.orderBy("rank").collect()] == [(1, 11), (2, 10)]
    assert recommend.recommend(users, items, 99, 2).count() == 0
    names = spark.createDataFrame([(10, "ten")], "id int, name string")
    named = recommend.with_names(best, names).orderBy("rank").collect()
    assert [(r["item"], r["name"]) for r in named] == [(11, None), (10, "ten")]


def test_matrix_operations(spark):
    table = np.array([[3.0, 4.0], [0.0, 0.0], [1.0, -1.0]])
    m = dense(spark, table)
    s = spark.createDataFrame([(1, 10.0), (0, 2.0)], "col int, s double")
    np.testing.assert_allclose(array(matrix.multiply_diagonal(m, s)), table * [2.0, 10.0])
    normal = array(matrix.normalize_rows(m))
    np.testing.assert_allclose(normal[0], [0.6, 0.8])
    assert np.isnan(normal[1]).all()
    q = spark.createDataFrame([(0, 2.0), (2, 1.0)], "id long, w double")
    got = {r["col"]: r.v for r in matrix.transpose_multiply(m, q).collect()}
    assert got == {0: 7.0, 1: 7.0}


def test_zero_rows_in_relevance(spark):
    unit = matrix.normalize_rows(dense(spark, [[3.0, 4.0], [0.0, 0.0], [4.0, 3.0], [3.0, 4.0]]))
    docs = [(r.id, r.score) for r in lsa.top_docs_for_doc(unit, 0).collect()]
    assert [i for i, _ in docs] == [3, 0, 2]
    terms = [r.id for r in lsa.top_terms_for_term(unit, 0).collect()]
    assert terms == [0, 3, 2, 1]


def test_query_vector(spark):
    vocabulary = spark.createDataFrame([("a", 0, 1.5), ("b", 1, 0.5)], "term string, id long, idf double")
    words = spark.createDataFrame([("a",), ("a",), ("zz",)], "term string")
    assert [tuple(r) for r in lsa.query_vector(words, vocabulary).collect()] == [(0, 3.0)]
    with pytest.raises(KeyError):
        lsa.query_vector(words, vocabulary, must_exist=True)


def low_rank(rows=60, cols=25):
    gen = np.random.default_rng(4)
    return gen.normal(size=(rows, 5)) @ np.diag([50, 20, 9, 4, 1]) @ gen.normal(size=(5, cols))


def test_svd(spark):
    table = low_rank()
    found = lsa.svd(dense(spark, table), 3)
    s = np.linalg.svd(table, compute_uv=False)[:3]
    np.testing.assert_allclose([r.s for r in found.s.orderBy("col").collect()], s)
    u, v = array(found.u), array(found.v)
    np.testing.assert_allclose(u.T @ u, np.eye(3), atol=1e-8)
    np.testing.assert_allclose(table @ v, u * s, atol=1e-8)
    assert (v[np.abs(v).argmax(axis=0), range(3)] > 0).all()


def test_subspace_svd_equals_svd(spark):
    table = low_rank()
    entries = matrix.to_entries(dense(spark, table))
    found = lsa.subspace_svd(entries, 3, tolerance=1e-7, oversample=2)
    left, s, right = np.linalg.svd(table, full_matrices=False)
    np.testing.assert_allclose([r.s for r in found.s.orderBy("col").collect()], s[:3], rtol=1e-6)
    u, v = array(found.u), array(found.v)
    np.testing.assert_allclose(np.abs((v * right[:3].T).sum(axis=0)), 1.0, atol=1e-6)
    np.testing.assert_allclose(np.abs((u * left[:, :3]).sum(axis=0)), 1.0, atol=1e-6)
    assert (v[np.abs(v).argmax(axis=0), range(3)] > 0).all()


@pytest.mark.parametrize(
    "table, rank",
    [
        (np.array([[1.0, 2.0, 0.5], [0.0, 1.0, 3.0], [2.0, 0.0, 1.0], [1.0, 1.0, 1.0]]), 3),
        (np.tile(np.array([[1.0, 0.0, 2.0, 3.0, 1.0], [0.0, 4.0, 1.0, 0.0, 1.0]]), (10, 1)), 2),
        (np.outer(np.arange(1.0, 41), np.arange(1.0, 41)), 1),
    ],
)
def test_subspace_svd_of_few_columns_and_low_rank(spark, table, rank):
    found = lsa.subspace_svd(matrix.to_entries(dense(spark, table)), 4, tolerance=1e-6)
    s = [r.s for r in found.s.orderBy("col").collect()]
    np.testing.assert_allclose(s, np.linalg.svd(table, compute_uv=False)[:rank], rtol=1e-6)
    u, v = array(found.u), array(found.v)
    np.testing.assert_allclose(u @ np.diag(s) @ v.T, table, atol=1e-5)


def test_subspace_svd_of_nothing(spark):
    for rows in ([], [(0, 0, 0.0), (1, 2, 0.0)]):
        found = lsa.subspace_svd(spark.createDataFrame(rows, "row long, col long, v double"), 3)
        assert found.s.count() == 0


def test_wide_block_plans_at_once(spark):
    entries = spark.range(2000).selectExpr("id % 60 AS row", "id % 47 AS col", "CAST(id % 7 AS double) AS v")
    start = time.perf_counter()
    block = lsa.start_block(entries, 1008)
    assert lsa._half_step(entries, block, "row", "col", 1008).count() == 60
    assert time.perf_counter() - start < 15


def test_concepts_rank_per_column(spark):
    m = dense(spark, [[1.0, 5.0], [2.0, 4.0], [3.0, 3.0]])
    low = lsa.top_per_concept(m, 2, 2, False).orderBy("concept", "rank").collect()
    assert [(r.concept, r.id) for r in low] == [(0, 0), (0, 1), (1, 2), (1, 1)]
    names = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "id long, name string")
    report = lsa.concept_report(lsa.top_terms_per_concept(m, names, 2, 2), lsa.top_docs_per_concept(m, names, 2, 2))
    assert [tuple(r) for r in report.collect()] == [(0, "zero, one", "two, one"), (1, "two, one", "zero, one")]


def test_queries_by_name(spark):
    m = dense(spark, [[1.0, 0.0], [0.0, 1.0], [0.9, 0.1]])
    names = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "id long, name string")
    unit = matrix.normalize_rows(m)

    def listed(df):
        return [r.name for r in df.orderBy(F.desc("score")).collect()]

    assert listed(lsa.terms_like(unit, names, "zero", 2)) == ["zero", "two"]
    assert listed(lsa.docs_like(unit, names, "one", 1)) == ["one"]
    assert listed(lsa.docs_about(m, m, names, names, "zero", 3)) == ["zero", "two", "one"]
    with pytest.raises(KeyError):
        lsa.docs_like(unit, names, "nine")


def test_one_term_may_hold_most_rows(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN concat('rare', repeat('x', int(id % 50)), ' common') ELSE 'common' END AS text")
    tf = text.term_freq(text.term_filter(text.tokenize(docs), spark.createDataFrame([("the",)], "word string")))
    idf = text.idf(text.doc_freq(tf), docs)
    weights = text.tfidf(tf, idf)
    assert weights.count() == 4000
    assert weights.filter("term = 'common' AND w <> 0").count() == 0


def test_terms(spark):
    docs = spark.createDataFrame([(1, "The cats, the Cat9 sat_on 3 éléphants"), (2, ""), (3, "cats")], "doc_id int, text string")
    tokens = text.tokenize(docs)
    assert [r.token for r in tokens.orderBy("pos").filter("doc_id = 1").collect()] == [
        "The", "cats", "the", "Cat", "sat", "on", "éléphants",
    ]
    stop = spark.createDataFrame([("the",)], "word string")
    terms = text.term_filter(tokens, stop)
    assert sorted(r.term for r in terms.filter("doc_id = 1").collect()) == ["cat", "cats", "sat", "the", "éléphants"]
    assert "the" not in [r.term for r in text.term_filter(tokens, stop, case_sensitive=False).collect()]
    lemmas = spark.createDataFrame([("cats", "cat")], "form string, lemma string")
    assert [r.token for r in text.lemmatize(tokens, lemmas).filter("doc_id = 3").collect()] == ["cat"]
    tf = text.term_freq(terms)
    idf = {r.term: r.idf for r in text.idf(text.doc_freq(tf), docs).collect()}
    assert idf["cats"] == pytest.approx(np.log(3 / 2)) and idf["sat"] == pytest.approx(np.log(3))
    w = text.tfidf(tf, text.idf(text.doc_freq(tf), docs)).filter("doc_id = 1 AND term = 'sat'").first()
    assert w.w == pytest.approx(np.log(3) / 5)


@pytest.mark.parametrize("direct", [1 << 21, 0])
def test_sets_of_centres_move_side_by_side(spark, monkeypatch, direct):
    from tidemark.operators import clustering

    monkeypatch.setattr(clustering, "DIRECT", direct)
    r = np.random.default_rng(2)
    table = np.round(r.standard_normal((60, 3)), 1)
    points = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(table)] + [(99, None)], "id int, features array<double>").repartition(3)
    first = clustering.starting_centers(points, 7, F.col("id"))
    assert first == table[:7].tolist()
    # Two centres at one place: the second one stays empty and where it is.
    starts = [first[:2], first, [first[0], first[0]]]
    got = clustering.shared_lloyd(points, starts, rounds=30)
    for start, moved in zip(starts, got, strict=True):
        want = np.array(start)
        for _ in range(30):
            which = ((table[:, None] - want) ** 2).sum(axis=2).argmin(axis=1)
            want = np.array([table[which == c].mean(axis=0) if (which == c).any() else want[c] for c in range(len(want))])
        assert np.abs(np.array(moved) - want).max() < 1e-9
    assert clustering.shared_lloyd(points.limit(0), [first], rounds=2) == [first]
    assert {r.score for r in clustering.k_sweep(points.filter("id = 99"), ks=(2,)).collect()} == {None}
