import pytest

from tidemark.sources import delimited, histories


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_labeled_csv_skips_text_fields_and_keeps_the_label(lines):
    df = delimited.parse_labeled_csv(lines("0,tcp,http,SF,215,45076,normal.", "1.5,udp,dns,SF,3,4,smurf.,"))
    assert values(df, "label", "features") == [("normal.", [0.0, 215.0, 45076.0]), ("smurf.", [1.5, 3.0, 4.0])]


def test_labeled_csv_bad_number(lines):
    bad = lines("0,tcp,http,SF,215,normal.", "x,tcp,http,SF,215,normal.")
    with pytest.raises(Exception):
        delimited.parse_labeled_csv(bad).collect()
    assert delimited.parse_labeled_csv(bad, "DROP").count() == 1


def test_bad_numbers_stop_the_job_without_ansi_casts_too(spark, lines):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            delimited.parse_labeled_csv(lines("x,tcp,http,SF,215,normal.")).collect()
        with pytest.raises(Exception):
            delimited.parse_labeled_points(lines("1,y,2")).collect()
        with pytest.raises(Exception):
            delimited.parse_term_freq_maps(lines("Map(a -> one)")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_ratings_need_three_whole_numbers(lines):
    good = delimited.parse_ratings(lines("1000002 1 55", "-3 +4 0 "))
    assert values(good, "user", "item", "rating") == [(-3, 4, 0.0), (1000002, 1, 55.0)]
    for bad in ("1 2", "1 2 3 4", "1  2", "a 2 3", "1 2 3.0", "", "1 2 99999999999"):
        with pytest.raises(Exception):
            delimited.parse_ratings(lines(bad)).collect()
        assert delimited.parse_ratings(lines(bad, "1 2 3"), "DROP").count() == 1


def test_id_name(lines):
    df = delimited.parse_id_name(
        lines("1\tA", "2\t", "3", "x4\tB", " 5\tC", "6\t D\tE ", "\tF", "99999999999\tG", "", "7\t\x00H\x1f")
    )
    assert values(df, "id", "name") == [(1, "A"), (2, ""), (6, "D\tE"), (7, "H")]


def test_alias_last_line_wins_and_bad_rows(spark, lines):
    rows = spark.createDataFrame([("1\t10", 0), ("1\t11", 5), ("1\t12", 3), ("\t9", 4), ("2\t20\tx", 6)], "value string, n int")
    assert values(delimited.parse_alias(rows, "n"), "bad", "good") == [(1, 11), (2, 20)]
    for bad in ("1", "1\t", "1\tx", "x\t1"):
        with pytest.raises(Exception):
            delimited.parse_alias(lines(bad)).collect()
        assert delimited.parse_alias(lines(bad, "3\t4"), on_error="DROP").count() == 1


def test_labeled_points(lines):
    df = delimited.parse_labeled_points(lines("2596,51,3,258,5", "1,2,7"))
    assert values(df, "label", "features") == [(4.0, [2596.0, 51.0, 3.0, 258.0]), (6.0, [1.0, 2.0])]


def test_term_freq_maps(lines):
    df = delimited.parse_term_freq_maps(
        lines("Map(a -> 1, b -> 2)", "Map(x -> 1, x -> 5, y)", "Map()", "Map(Mapping(s) -> 3, p -> q -> 2, z ->)")
    )
    got = [dict(r["term_freqs"]) for r in df.collect()]
    assert {"a": 1, "b": 2} in got
    assert {"x": 5, "y": 0} in got
    assert {"": 0} in got
    assert {"Mapping(s)": 3, "p": 0, "z": 0} in got


def test_history_lines(spark):
    csv = spark.createDataFrame(
        [("a", "Date,Open"), ("a", "2014-10-24,3.5,9"), ("a", "2014-10-23,3.25"), ("b", "2014-10-23,zzz"), ("b", "2014-10-24,1")],
        "series string, value string",
    )
    with pytest.raises(Exception):
        histories.parse_history_csv(csv, header="Date,Open").collect()
    kept = histories.drop_bad_series(histories.parse_history_csv(csv, header="Date,Open", strict=False))
    assert [(s, str(d), v) for s, d, v in values(kept, "series", "date", "value")] == [
        ("a", "2014-10-23", 3.25),
        ("a", "2014-10-24", 3.5),
    ]
    tsv = spark.createDataFrame([("o", "Oct 3, 2014\t89.74"), ("o", "Jan 12, 2010\t80")], "series string, value string")
    got = histories.parse_history_tsv(tsv)
    assert [(str(d), v) for d, v in values(got, "date", "value")] == [("2010-01-12", 80.0), ("2014-10-03", 89.74)]


def test_maps_are_parsed_once(spark, tmp_path):
    from tidemark.plans.parsing import parse_term_freq_map

    spark.createDataFrame([(1, "b a b"), (2, ""), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = parse_term_freq_map(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [(1, "a", 1), (1, "b", 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "size(map_from_entries" not in plan and plan.count("map_from_entries(get") <= 1
