"""Parsers, run on lines built from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import text as text_ops
from tidemark.plans.catalog import query, rounded, spread, table
from tidemark.plans.inputs import BRAND_DAILY, PLAYS, brand_daily, plays
from tidemark.sources import delimited, histories


@query(
    "parse_labeled_csv",
    """
    SELECT l_returnflag AS label, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, l_tax AS f3
    FROM lineitem
    """,
)
def parse_labeled_csv(spark, folder):
    li = spread(spark, folder, "lineitem", "l_quantity", "l_returnflag", "l_linestatus", "l_extendedprice", "l_discount", "l_tax")
    fields = ["l_quantity", "l_returnflag", "l_linestatus", "x", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
    value = F.concat_ws(",", *[F.lit("x") if f == "x" else F.col(f).cast("string") for f in fields])
    parsed = delimited.parse_labeled_csv(li.select(value.alias("value")))
    return parsed.select("label", *[F.col("features")[i].alias(f"f{i}") for i in range(4)])


@query("parse_ratings", f"WITH {PLAYS} SELECT CAST(usr AS INTEGER) AS usr, CAST(item AS INTEGER) AS item, rating FROM plays")
def parse_ratings(spark, folder):
    value = F.concat_ws(" ", "user", "item", F.col("rating").cast("int"))
    lines = plays(spark, folder).select(value.alias("value"))
    return delimited.parse_ratings(lines).withColumnRenamed("user", "usr")


@query(
    "parse_id_name",
    """
    SELECT CAST(p_partkey AS INTEGER) AS id, CASE WHEN p_size = 3 THEN '' ELSE p_name END AS name
    FROM part WHERE p_size NOT IN (1, 2)
    """,
)
def parse_id_name(spark, folder):
    key = F.col("p_partkey").cast("string")
    line = (
        F.when(F.col("p_size") == 1, F.concat(F.lit("x"), key, F.lit("\t"), F.col("p_name")))
        .when(F.col("p_size") == 2, F.concat_ws(" ", key, "p_name"))
        .when(F.col("p_size") == 3, F.concat(key, F.lit("\t  ")))
        .otherwise(F.concat(key, F.lit("\t "), F.col("p_name"), F.lit(" \t")))
    )
    return delimited.parse_id_name(table(spark, folder, "part").select(line.alias("value")))


@query(
    "parse_alias",
    """
    SELECT CAST(p_partkey AS INTEGER) AS bad,
           CAST(min(p_partkey) OVER (PARTITION BY p_name) AS INTEGER) AS good
    FROM part QUALIFY p_size <> 1
    """,
)
def parse_alias(spark, folder):
    part = table(spark, folder, "part")
    good = part.groupBy("p_name").agg(F.min("p_partkey").alias("good"))
    pairs = part.join(good, "p_name")
    bad = F.when(F.col("p_size") == 1, F.lit("")).otherwise(F.col("p_partkey").cast("string"))
    # Two lines per key: the second one must win.
    first = pairs.select(F.concat_ws("\t", bad, "p_partkey").alias("value"), F.lit(0).alias("line_no"))
    second = pairs.select(F.concat_ws("\t", bad, "good").alias("value"), F.lit(1).alias("line_no"))
    return delimited.parse_alias(second.unionByName(first), line_no="line_no")


@query(
    "parse_labeled_points",
    """
    SELECT CAST(label AS DOUBLE) AS label, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS value
    FROM embeddings, range(1, 65) t(i)
    """,
)
def parse_labeled_points(spark, folder):
    em = table(spark, folder, "embeddings")
    numbers = F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), ",")
    lines = em.select(F.concat_ws(",", numbers, F.col("label") + 1).alias("value"))
    return delimited.parse_labeled_points(lines).select("label", F.posexplode("features").alias("pos", "value"))


HISTORY = f"WITH {BRAND_DAILY} SELECT series, CAST(date AS VARCHAR) AS date, round(value, 6) AS value FROM brand_daily"


def _csv_lines(spark, folder):
    rows = brand_daily(spark, folder).select(
        "series", F.concat_ws(",", F.col("date").cast("string"), F.col("value").cast("string"), F.lit("0")).alias("value")
    )
    headers = rows.select("series").distinct().withColumn("value", F.lit("Date,Close,Volume"))
    return rows.unionByName(headers)


def _shown(history):
    return history.select("series", F.col("date").cast("string").alias("date"), rounded("value", 6).alias("value"))


@query("parse_history_csv", HISTORY)
def parse_history_csv(spark, folder):
    return _shown(histories.parse_history_csv(_csv_lines(spark, folder), header="Date,Close,Volume"))


@query("parse_history_tsv", HISTORY)
def parse_history_tsv(spark, folder):
    line = F.concat_ws("\t", F.date_format("date", "MMM d, yyyy"), F.col("value").cast("string"))
    return _shown(histories.parse_history_tsv(brand_daily(spark, folder).select("series", line.alias("value"))))


@query("read_histories", HISTORY + " WHERE series NOT IN ('Brand#3', 'Brand#7')")
def read_histories(spark, folder):
    lines = _csv_lines(spark, folder)
    broken = F.col("series").isin("Brand#3", "Brand#7") & (F.col("value") == "Date,Close,Volume")
    # One line of each of these two series is no history row.
    damaged = lines.withColumn("value", F.when(broken, F.lit("2000-01-03,n/a")).otherwise(F.col("value")))
    parsed = histories.parse_history_csv(damaged, header="Date,Close,Volume", strict=False)
    return _shown(histories.drop_bad_series(parsed))


@query(
    "parse_term_freq_map",
    """
    SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\\p{L}+')) AS term FROM documents)
    GROUP BY doc_id, term
    """,
)
def parse_term_freq_map(spark, folder):
    tokens = text_ops.tokenize(spread(spark, folder, "documents", "doc_id", "text")).withColumnRenamed("token", "term")
    maps = text_ops.term_freq_maps(text_ops.term_freq(tokens))
    entry = F.transform(F.map_entries("term_freqs"), lambda e: F.concat_ws(" -> ", e["key"], e["value"].cast("string")))
    lines = maps.select("doc_id", F.concat(F.lit("Map("), F.array_join(entry, ", "), F.lit(")")).alias("value"))
    # The outer form, as the inner one parses every line again in a filter for empty maps.
    cut = delimited.parse_term_freq_maps(lines).select("doc_id", F.explode_outer("term_freqs").alias("term", "tf"))
    return cut.filter("term is not null")


@query(
    "scalar_text_fns",
    """
    SELECT p_partkey, split_part(p_name, ' ', 1) AS head, substr(p_name, strpos(p_name, ' ') + 1) AS rest,
           length(p_name) AS len, contains(p_name, 'ring') AS has_ring, lower(p_type) AS type,
           replace(replace(p_brand, 'Brand', ''), '#', '') AS number,
           CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS brand_no,
           regexp_full_match(p_type, '\\p{L}*') AS letters, p_name || ', ' || p_brand AS joined,
           printf('%1s%18s%8s', CAST(p_size AS VARCHAR), p_type, p_brand) AS line
    FROM part
    """,
)
def scalar_text_fns(spark, folder):
    from tidemark.functions.text import is_only_letters, strict_int, strip_control

    name = F.col("p_name")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.substring_index(name, " ", 1).alias("head"),
        strip_control(F.substring(name, F.instr(name, " "), F.length(name))).alias("rest"),
        F.length(name).cast("bigint").alias("len"),
        name.contains("ring").alias("has_ring"),
        F.lower("p_type").alias("type"),
        F.regexp_replace("p_brand", "Brand|#", "").alias("number"),
        strict_int(F.regexp_replace("p_brand", "Brand#", "")).alias("brand_no"),
        is_only_letters(F.col("p_type")).alias("letters"),
        F.array_join(F.array("p_name", "p_brand"), ", ").alias("joined"),
        F.format_string("%1s%18s%8s", F.col("p_size").cast("string"), F.col("p_type"), F.col("p_brand")).alias("line"),
    )


@query(
    "scalar_math_fns",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, round(sign(x) * x * x, 4) AS signed_square,
           round(sign(x) * sqrt(abs(x)), 6) AS signed_sqrt, round(ln(l_quantity), 6) AS log_q,
           round(ln(1 - l_discount), 6) AS log_d, round(exp(-l_discount), 6) AS exp_d,
           round(pow(l_quantity, -0.2), 6) AS pow_q, ceil(l_extendedprice) AS ceil_p,
           greatest(l_discount, l_tax) AS larger, round(2 * pi() * l_tax, 6) AS turn
    FROM (SELECT *, l_extendedprice - 1000 * l_quantity AS x FROM lineitem)
    """,
)
def scalar_math_fns(spark, folder):
    from tidemark.functions.arrays import signed_sqrt, signed_square

    x = F.col("l_extendedprice") - 1000 * F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        rounded(signed_square(x), 4).alias("signed_square"),
        rounded(signed_sqrt(x), 6).alias("signed_sqrt"),
        rounded(F.log("l_quantity"), 6).alias("log_q"),
        rounded(F.log1p(-F.col("l_discount")), 6).alias("log_d"),
        rounded(F.exp(-F.col("l_discount")), 6).alias("exp_d"),
        rounded(F.pow("l_quantity", F.lit(-0.2)), 6).alias("pow_q"),
        F.ceil("l_extendedprice").cast("double").alias("ceil_p"),
        F.greatest("l_discount", "l_tax").alias("larger"),
        rounded(2 * F.pi() * F.col("l_tax"), 6).alias("turn"),
    )


@query(
    "scalar_date_fns",
    """
    SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS iso, strftime(d + 1, '%Y-%m-%d') AS next_day,
           CAST(isodow(d) AS INTEGER) AS day_of_week, d < DATE '1998-01-01' AS early,
           strftime(strptime(strftime(d, '%b %-d, %Y'), '%b %-d, %Y'), '%Y-%m-%d') AS parsed
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    """,
)
def scalar_date_fns(spark, folder):
    d = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        d.cast("string").alias("iso"),
        F.date_add(d, 1).cast("string").alias("next_day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        (d < F.lit("1998-01-01").cast("date")).alias("early"),
        F.to_date(F.date_format(d, "MMM d, yyyy"), "MMM d, yyyy").cast("string").alias("parsed"),
    )


HTML_TEXT = r"""
    trim(regexp_replace(regexp_replace(regexp_replace(html,
        '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<!--.*?-->', ' ', 'g'),
        '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g'))
"""
HTML_TITLE = r"regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"


@query("page_extract", f"SELECT page_id, {HTML_TITLE} AS title, {HTML_TEXT} AS text FROM pages")
def page_extract(spark, folder):
    return text_ops.html_pages(spread(spark, folder, "pages", "page_id", "html"))


@query(
    "page_filter",
    f"""
    SELECT page_id, title FROM (SELECT page_id, url, {HTML_TITLE} AS title, {HTML_TEXT} AS text FROM pages)
    WHERE text <> '' AND contains(url, '/en/') AND NOT contains(url, '#top') AND NOT contains(title, 'thand')
    """,
)
def page_filter(spark, folder):
    # The tables have no namespace or redirect mark; two parts of the address stand in.
    pages = spread(spark, folder, "pages", "page_id", "url", "html")
    marked = pages.select(
        "page_id",
        text_ops.html_title(F.col("html")).alias("title"),
        text_ops.strip_html(F.col("html")).alias("text"),
        F.when(F.col("url").contains("/en/"), 0).otherwise(1).alias("ns"),
        F.col("url").contains("#top").alias("is_redirect"),
    )
    return text_ops.page_filter(marked, marker="thand").select("page_id", "title")
