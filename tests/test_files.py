import gzip

from pyspark.sql import functions as F

from tidemark.operators import text
from tidemark.sources import files, histories, termcounts


def test_text_and_gzip(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    assert files.read_lines(spark, str(tmp_path / "a.txt")).count() == 2
    with gzip.open(tmp_path / "b.gz", "wt") as out:
        out.write("\n".join(map(str, range(1000))))
    df = files.read_gzip_lines(spark, str(tmp_path / "b.gz"), 4)
    assert df.count() == 1000
    assert df.select(F.spark_partition_id()).distinct().count() == 4


PAGES = """<mediawiki>
<page><title>Plain</title><ns>0</ns><revision><text bytes="9">Some '''bold''' [[link|shown]] {{cut {{me}}}} text</text></revision></page>
<page><title>Old name</title><ns>0</ns><redirect title="Plain"/><revision><text>#REDIRECT [[Plain]]</text></revision></page>
<page><title>Talk:Plain</title><ns>1</ns><revision><text>chat</text></revision></page>
<page><title>Mercury (disambiguation)</title><ns>0</ns><revision><text>may be</text></revision></page>
<page><title>Empty</title><ns>0</ns><revision><text></text></revision></page>
</mediawiki>"""


def test_page_dump(spark, tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(PAGES)
    pages = files.read_page_dump(spark, str(path))
    assert pages.count() == 5
    assert [tuple(r) for r in text.dump_pages(pages).collect()] == [("Plain", "Some bold shown text")]


def test_stopwords(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\nand\nthe\n")
    assert sorted(r.word for r in files.read_stopwords(spark, str(tmp_path / "stop.txt")).collect()) == ["and", "the"]


def test_history_folder_leaves_out_broken_files(spark, tmp_path):
    (tmp_path / "good.csv").write_text("Date,Open,High\n2014-10-23,1.5,2\n2014-10-22,1.25,2\n")
    (tmp_path / "other.csv").write_text("Date,Open,High\n2014-10-23,7,8\n")
    (tmp_path / "bad.csv").write_text("Date,Open,High\n2014-10-23,1.5,2\nnot a date,1,1\n")
    (tmp_path / "short.csv").write_text("Date,Open,High\n2014-10-23\n")
    got = histories.read_histories(spark, str(tmp_path)).groupBy("series").count().collect()
    assert {r["series"]: r["count"] for r in got} == {"good": 2, "other": 1}


def test_history_tsv_file(spark, tmp_path):
    (tmp_path / "oil.tsv").write_text("Oct 23, 2014\t82.09\nOct 22, 2014\t80.52\n")
    got = histories.read_history_tsv(spark, str(tmp_path / "oil.tsv")).orderBy("date").collect()
    assert [(r.series, str(r.date), r.value) for r in got] == [("oil", "2014-10-22", 80.52), ("oil", "2014-10-23", 82.09)]


def test_term_counts_round_trip(spark, tmp_path):
    tf = spark.createDataFrame([(1, "alpha", 2), (1, "beta", 1), (2, "alpha", 5)], "doc_id int, term string, tf long")
    maps = text.term_freq_maps(tf)
    termcounts.save_term_maps(maps, str(tmp_path / "maps"))
    back = [dict(r["term_freqs"]) for r in termcounts.read_term_maps(spark, str(tmp_path / "maps")).collect()]
    assert sorted(back, key=len) == [{"alpha": 5}, {"alpha": 2, "beta": 1}]
    termcounts.save_term_counts(tf, str(tmp_path / "counts"))
    assert spark.read.parquet(str(tmp_path / "counts")).exceptAll(tf).count() == 0


def test_histories_are_read_in_one_scan(spark, tmp_path):
    files = {"ok": "2014-01-01,1\n2014-01-02,2", "text": "2014-01-01,x\n2014-01-02,2", "short": "2014-01-01,1\n2014-01-02", "day": "2014-13-01,1", "none": ""}
    for name, body in files.items():
        (tmp_path / f"{name}.csv").write_text(f"Date,Open\n{body}\n")
    kept = histories.read_histories(spark, str(tmp_path))
    assert sorted((r.series, str(r.date), r.value) for r in kept.collect()) == [("ok", "2014-01-01", 1.0), ("ok", "2014-01-02", 2.0)]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan


def test_rows_without_a_series_stay(spark):
    rows = spark.createDataFrame([(None, None, 1.0), ("a", "2014-01-01", None), ("a", "2014-01-02", 1.0), ("b", "2014-01-01", 2.0)], "series string, date string, value double")
    assert sorted(r.value for r in histories.drop_bad_series(rows).collect()) == [1.0, 2.0]
    assert histories.drop_bad_series(rows.limit(0)).count() == 0
