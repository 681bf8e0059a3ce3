"""Not-modified revisits of a web archive, resolved against earlier full responses.

A revisit record says that a page was as before. Records are sorted by canonical
URL and time over all partitions; the latest full response before each revisit
is carried along, within a partition by a window per URL, across partitions by
one summary row per URL and partition. A URL with any share of the records so
lies in many partitions. Payloads do not move: the result names the response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import written

#: Fixed values of the archive format: what a 304 may change in a stored response's headers (RFC 9110, 15.4.5).
MERGED_HEADERS = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
#: Query parameters that do not name another page.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def canonical_url(url: Column) -> Column:
    """Lower-case host without ``www.`` or default port, no scheme, fragment or tracking parameters, sorted rest, no final slash.

    Null stays null.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    path = F.regexp_replace(F.substring_index(bare, "?", 1), "/+$", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.substring_index(path, "/", 1)), "^www\\.", ""), ":(80|443)$", "")
    rest = F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "^[^/]*", "")).otherwise(F.lit(""))
    query = F.when(F.instr(bare, "?") > 0, F.regexp_replace(bare, "^[^?]*\\?", "")).otherwise(F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, rest, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit record.

    ``records``: ``record_id, url, time, kind`` (``response`` or ``revisit``),
    ``etag, last_modified, digest`` (validators, any may be null) and ``headers``
    (map). A revisit takes the latest response of its canonical URL that is
    earlier, by time and, at one time, by record_id. The result has
    ``record_id, canonical_url, status, refers_to, headers``: status is
    ``orphan`` without an earlier response, ``mismatch`` if a validator that both
    have differs, ``unchecked`` if they share none, else ``resolved``. Headers
    are the response's with the permitted ones of the revisit laid over them, for
    resolved and unchecked revisits, else null. Header names are compared in
    lower case. Null URLs are orphans; a null time comes before all others;
    repeated rows each count; other kinds are ignored; no records give no rows.
    """
    lowered = F.transform_keys("headers", lambda k, _: F.lower(k))
    rows = records.filter(F.col("kind").isin("response", "revisit")).select(
        "record_id", canonical_url(F.col("url")).alias("page"), "time", (F.col("kind") == "response").alias("full"), "etag", "last_modified", "digest",
        lowered.alias("headers"),
    )
    order = [F.col("time").asc_nulls_first(), F.col("record_id").asc_nulls_first(), F.col("full")]
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, F.col("page").asc_nulls_first(), *order).withColumn("part", F.spark_partition_id())
    dealt = written(dealt)
    found = F.when(F.col("full"), F.struct("record_id", "etag", "last_modified", "digest", "headers"))
    inside = Window.partitionBy("part", "page").orderBy(*order)
    place = F.struct("time", "record_id")
    last = dealt.filter("full").groupBy("page", "part").agg(F.max_by(F.struct("record_id", "etag", "last_modified", "digest", "headers"), place).alias("last"))
    # One row per URL and partition it lies in.
    spots = dealt.groupBy("page", "part").count().join(last, ["page", "part"], "left")
    carried = F.last("last", ignorenulls=True).over(Window.partitionBy("page").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spots = spots.select("page", "part", carried.alias("before")).filter("before is not null")
    here = F.last(found, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    revisits = dealt.withColumn("here", here).filter("not full")
    both = revisits.join(spots, ["page", "part"], "left").withColumn("was", F.coalesce("here", "before"))
    names = ["etag", "last_modified", "digest"]
    shared = [F.col(n).isNotNull() & F.col(f"was.{n}").isNotNull() for n in names]
    differs = F.lit(False)
    any_shared = F.lit(False)
    for n, s in zip(names, shared, strict=True):
        differs = differs | (s & (F.col(n) != F.col(f"was.{n}")))
        any_shared = any_shared | s
    status = (
        F.when(F.col("page").isNull() | F.col("was").isNull(), "orphan").when(differs, "mismatch").when(any_shared, "resolved").otherwise("unchecked")
    )
    new = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, _: k.isin(MERGED_HEADERS))
    old = F.map_filter(F.coalesce("was.headers", F.create_map().cast("map<string,string>")), lambda k, _: ~F.map_contains_key(new, k))
    out = both.withColumn("status", status)
    return out.select(
        "record_id",
        F.col("page").alias("canonical_url"),
        "status",
        F.when(F.col("status") != "orphan", F.col("was.record_id")).alias("refers_to"),
        F.when(F.col("status").isin("resolved", "unchecked"), F.map_concat(old, new)).alias("headers"),
    )
