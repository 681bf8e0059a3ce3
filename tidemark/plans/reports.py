"""Whole jobs composed of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import classify, clustering, density, joins, lanczos, lsa, morphology, recommend, regression, risk, sampling, stats, text, timeseries
from tidemark.operators.orderstat import lower_tail
from tidemark.sources import delimited, files, histories
from tidemark.session import written


#: Rank of the decomposition of texts; a thousand is the same plan with more steps.
RANK = 100


def risk_report(
    trials: DataFrame, returns: DataFrame, resamples: int = 100, p_value: float = 0.05, seed: int = 1
) -> DataFrame:
    """One row: tail risk of the trials, its intervals and the backtest on the returns.

    ``trials`` has ``trial_id`` and ``ret``, ``returns`` has ``date`` and ``ret``
    of every instrument.
    """
    spark = trials.sparkSession
    trials = trials.persist()
    stats_frame = risk.bootstrap_tails(trials, "trial_id", "ret", resamples, seed).persist()
    try:
        tail = lower_tail(trials, "ret")
        if tail is None:
            raise ValueError("no trials")
        bounds = [
            risk.confidence_interval(stats_frame, c, resamples, p_value).first() for c in ("var", "cvar")
        ]
        test = risk.kupiec(risk.failures(returns, F.lit(tail.value)), 1.0 / risk.TAIL_DIVISOR).first()
    finally:
        stats_frame.unpersist()
        trials.unpersist()
    row = (
        tail.rows,
        tail.value,
        tail.mean,
        bounds[0]["lower"],
        bounds[0]["upper"],
        bounds[1]["lower"],
        bounds[1]["upper"],
        test["periods"],
        test["failures"],
        test["p_value"],
    )
    schema = (
        "trials bigint, var double, cvar double, var_lower double, var_upper double, cvar_lower double, "
        "cvar_upper double, periods bigint, failures bigint, p_value double"
    )
    return spark.createDataFrame([row], schema)


def concept_analysis(
    docs: DataFrame,
    stopwords: DataFrame,
    concepts: int = 4,
    vocabulary: int | None = None,
    lemmas: DataFrame | None = None,
    rank: int = RANK,
    learn_lemmas: bool = False,
    terms_shown: int = 10,
) -> tuple[DataFrame, lsa.Decomposition, DataFrame]:
    """From texts ``(doc_id, text)`` to a concept report.

    Gives the report, the decomposition and the vocabulary ``(id, term, idf)``.
    ``rank`` is that of the decomposition (cut to the matrix's), ``concepts`` the number shown.  All
    terms take part unless ``vocabulary`` asks for the most widespread ones.
    With ``learn_lemmas`` forms outside ``lemmas`` take the base form that its pairs teach.
    """
    # The counts are read several times; written once, the texts are not parsed again.
    if lemmas is None:
        tf = written(text.doc_terms(docs, stopwords))
    else:
        based = (morphology.lemmatize_learned if learn_lemmas else text.lemmatize)(text.tokenize(docs), lemmas)
        tf = written(text.term_freq(text.term_filter(based, stopwords)))
    df = text.doc_freq(tf)
    if vocabulary is not None:
        df = text.top_vocabulary(df, vocabulary)
    terms = written(stats.dense_index(text.idf(df, docs), [F.desc("df"), F.asc("term")], "id"))
    entries = text.tfidf(tf, terms).select(
        F.col("doc_id").alias("row"), F.col("id").alias("col"), F.col("w").alias("v")
    )
    found = lanczos.lanczos_svd(written(entries), max(rank, concepts)).factors
    names = terms.select("id", F.col("term").alias("name"))
    doc_names = docs.select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("name"))
    report = lsa.concept_report(
        lsa.top_terms_per_concept(found.v, names, concepts, terms_shown, descending=True),
        lsa.top_docs_per_concept(found.u, doc_names, concepts, terms_shown),
    )
    return report, found, terms


def risk_curves(trials: DataFrame, factors: DataFrame, shown: list[str], steps: int = density.STEPS) -> DataFrame:
    """Density curves of the trials and of some factors' returns: ``(curve, point, x, density)``."""
    sides = [("trials", trials, "ret"), *((name, factors, name) for name in shown)]
    curves = [density.density_curve(frame, c, steps).select(F.lit(name).alias("curve"), "point", "x", "density") for name, frame, c in sides]
    out = curves[0]
    for curve in curves[1:]:
        out = out.unionByName(curve)
    return out


def risk_job(
    spark: SparkSession,
    stocks: str,
    factors: dict[str, str],
    start: str,
    end: str,
    trials: int,
    partitions: int,
    shown: list[str] | None = None,
    resamples: int = 100,
    seed: int = 1001,
    min_rows: int = timeseries.MIN_HISTORY_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """From files of histories to the risk report and its density curves.

    ``stocks`` is a folder of one file per instrument; ``factors`` maps names to
    files (``.tsv`` or ``.csv``). Short histories are dropped first, then series
    are cut to the region, filled and differenced. The report covers all ``trials``.
    """
    kept = timeseries.min_history(histories.read_histories(spark, stocks), min_rows)
    returns = written(timeseries.series_returns(kept, start, end))
    parts = []
    for name, path in factors.items():
        read = histories.read_history_tsv if path.endswith(".tsv") else histories.read_history_csv
        parts.append(read(spark, path).withColumn("series", F.lit(name)))
    daily = parts[0]
    for part in parts[1:]:
        daily = daily.unionByName(part)
    names = list(factors)
    matrix = written(timeseries.factor_matrix(timeseries.series_returns(daily, start, end), names))
    model = regression.fit_factor_model(matrix, names)
    weights = regression.ols(returns, regression.factor_features(matrix, names), 3 * len(names))
    draws = risk.factor_draws(risk.trial_ids(spark, trials, partitions), "trial_id", model, seed)
    outcome = written(risk.trial_returns(draws, regression.portfolio_weights(weights)).select("trial_id", "ret"))
    return risk_report(outcome, returns, resamples, seed=seed), risk_curves(outcome, matrix, names[:2] if shown is None else shown)


def anomaly_job(spark: SparkSession, path: str, ks=clustering.SWEEP, final_k: int = clustering.FINAL_K) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From connection records to the score of each number of clusters, the purity table of the last fit and all points by score."""
    points = written(delimited.parse_labeled_csv(files.read_lines(spark, path)))
    scores = clustering.k_sweep(points, ks)
    found = clustering.assign(points, clustering.centers(clustering.fit(points, final_k)))
    return scores, clustering.purity_table(found), found.orderBy(F.desc("distance"))


def suggestion_job(spark: SparkSession, plays: str, artists: str, alias: str, user: int, n: int = 5) -> DataFrame:
    """From plays, names and aliases to the named suggestions for one user."""
    ratings = delimited.parse_ratings(files.read_lines(spark, plays))
    counts = joins.resolve_alias(ratings, delimited.parse_alias(files.read_lines(spark, alias)))
    model = recommend.fit_implicit(counts)
    return recommend.with_names(recommend.recommend_products(model, user, n), delimited.parse_id_name(files.read_lines(spark, artists)))


def cover_job(spark: SparkSession, path: str, classes: int, seed: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From labelled points to the grid of settings, the accuracy of the best one on the test part and its measures per class."""
    points = written(delimited.parse_labeled_points(files.read_lines(spark, path)))
    parts = sampling.hash_split(points, F.xxhash64("label", "features"), seed=seed)
    train, held_out, test = (parts.filter(F.col("part") == name) for name in ("train", "cv", "test"))
    grid = classify.grid_search(train, held_out)
    best = grid.first()
    settings = (best["impurity"], best["depth"], best["bins"])
    measures = classify.precision_recall(classify.predict_one(train.unionByName(held_out), test, *settings), classes)
    return grid, classify.refit(train, held_out, test, *settings), measures


def relevance(
    found: lsa.Decomposition, terms: DataFrame, docs: DataFrame, term: str, doc: str, query: list[str], n: int = 10
) -> DataFrame:
    """Lookups by name on a decomposition: ``(lookup, name, score)``.

    ``terms`` has ``id, term, idf`` as ``concept_analysis`` gives them, ``docs`` has ``id, name``.
    """
    names = terms.select("id", F.col("term").alias("name"))
    us, vs = lsa.scaled(found.u, found.s), lsa.scaled(found.v, found.s)
    wanted = found.s.sparkSession.createDataFrame([(t,) for t in query], "term string")
    weights = lsa.query_vector(wanted, terms)
    sides = {
        "terms like term": lsa.terms_like(lsa.normalize_rows(vs), names, term, n),
        "docs like doc": lsa.docs_like(lsa.normalize_rows(us), docs, doc, n),
        "docs about term": lsa.docs_about(us, found.v, names, docs, term, n),
        "docs for query": lsa.named_scores(lsa.top_docs_for_query(us, found.v, weights, n), docs),
    }
    out = None
    for lookup, frame in sides.items():
        frame = frame.select(F.lit(lookup).alias("lookup"), "id", "name", "score")
        out = frame if out is None else out.unionByName(frame)
    return out
