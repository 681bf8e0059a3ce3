"""Parsers of delimited lines."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import arrays
from tidemark.functions.text import must_cast, split_fields, strict_int, strip_control

FAIL, DROP = "FAIL", "DROP"


def _enforce(df: DataFrame, bad: Column, message: str, on_error: str) -> DataFrame:
    """Stop the job at a bad row, or leave bad rows out."""
    if on_error == DROP:
        return df.filter(~bad)
    if on_error != FAIL:
        raise ValueError(f"on_error must be {FAIL} or {DROP}")
    checked = F.when(bad, F.raise_error(F.concat(F.lit(message + ": "), F.col("value"))).cast("string"))
    return df.filter(checked.isNull())


def _as_doubles(fields: Column, on_error: str) -> Column:
    if on_error == DROP:
        return F.transform(fields, lambda x: x.try_cast("double"))
    return F.transform(fields, lambda x: must_cast(x, "double"))


def parse_labeled_csv(lines: DataFrame, on_error: str = FAIL) -> DataFrame:
    """Comma lines whose fields 1 to 3 are text to skip and whose last is a label.

    Gives ``label`` (kept verbatim) and ``features``.
    """
    fields = split_fields(F.col("value"), ",")
    numbers = F.concat(
        F.slice(F.col("f"), 1, 1),
        F.slice(F.col("f"), F.lit(5), F.greatest(F.size("f") - 5, F.lit(0))),
    )
    split = _enforce(
        lines.select("value", fields.alias("f")), F.size("f") < 5, "too few fields", on_error
    )
    out = split.select(arrays.last(F.col("f")).alias("label"), _as_doubles(numbers, on_error).alias("features"))
    return out if on_error == FAIL else out.filter(~F.exists("features", lambda v: v.isNull()))


def parse_ratings(lines: DataFrame, on_error: str = FAIL) -> DataFrame:
    """Blank-separated ``user item count`` lines, exactly three whole numbers."""
    fields = split_fields(F.col("value"), " ")
    ids = [strict_int(F.get("f", F.lit(i))) for i in range(3)]
    split = lines.select("value", fields.alias("f")).select(
        "value", F.size("f").alias("n"), *[c.alias(name) for c, name in zip(ids, ("user", "item", "count"))]
    )
    bad = (F.col("n") != 3) | F.col("user").isNull() | F.col("item").isNull() | F.col("count").isNull()
    good = _enforce(split, bad, "not three whole numbers", on_error)
    return good.select("user", "item", F.col("count").cast("double").alias("rating"))


def parse_id_name(lines: DataFrame) -> DataFrame:
    """``id<TAB>name`` lines; rows without a tab or a whole-number id are left out."""
    tab = F.instr("value", "\t")
    # Everything after the first tab may hold further tabs.
    name = F.substring(F.col("value"), tab + 1, F.length("value"))
    return (
        lines.filter(tab > 0)
        .select(
            strict_int(F.substring(F.col("value"), F.lit(1), tab - 1)).alias("id"),
            strip_control(name).alias("name"),
        )
        .filter(F.col("id").isNotNull())
    )


def parse_alias(lines: DataFrame, line_no: str | None = None, on_error: str = FAIL) -> DataFrame:
    """``bad<TAB>good`` id lines; the last line of a bad id wins.

    ``line_no`` names a column with the line order.  Without it lines of a file
    scan go by file, block and place in the block; other frames have no order of
    their own and need the column.
    """
    if line_no:
        order = F.col(line_no)
    elif lines.inputFiles():
        place = F.struct(F.input_file_name(), F.input_file_block_start(), F.monotonically_increasing_id())
        order = place
    else:
        order = F.monotonically_increasing_id()
    split = lines.select("value", order.alias("line_no"), split_fields(F.col("value"), "\t").alias("f"))
    split = split.filter(F.col("f")[0] != "")
    second = F.try_element_at(F.col("f"), F.lit(2))
    bad = strict_int(F.col("f")[0]).isNull() | F.coalesce(strict_int(second).isNull(), F.lit(True))
    pairs = _enforce(split, bad, "not two whole numbers", on_error).select(
        strict_int(F.col("f")[0]).alias("bad"), strict_int(second).alias("good"), "line_no"
    )
    return pairs.groupBy("bad").agg(F.max_by("good", "line_no").alias("good"))


def parse_labeled_points(lines: DataFrame, on_error: str = FAIL) -> DataFrame:
    """Comma lines of numbers; the last, counted from 1, is the class."""
    values = _as_doubles(split_fields(F.col("value"), ","), on_error)
    out = lines.select(values.alias("v"))
    if on_error == DROP:
        out = out.filter(~F.exists("v", lambda x: x.isNull()))
    return out.select(
        (arrays.last(F.col("v")) - 1).alias("label"), arrays.all_but_last(F.col("v")).alias("features")
    )


def with_vector(df: DataFrame, column: str = "features") -> DataFrame:
    """Turn an array column into the vector type the fitting library expects."""
    return df.withColumn(column, array_to_vector(F.col(column).cast("array<double>")))


def parse_term_freq_maps(lines: DataFrame) -> DataFrame:
    """Term counts printed as ``Map(a -> 1, b -> 2)``, as ``map<string,int>``.

    An entry that is not ``term -> count`` gets the count 0, and of a repeated
    term the last entry counts.  Only the outer ``Map(`` ``)`` is taken off.
    """
    inner = F.regexp_replace("value", r"^Map\(|\)$", "")

    def entry(e: Column, i: Column) -> Column:
        arrows = (F.length(e) - F.length(F.replace(e, F.lit("->"), F.lit("")))) / 2
        two_parts = (arrows == 1) & ~e.endswith("->")
        count = must_cast(strip_control(F.substring_index(e, "->", -1)), "int")
        return F.struct(
            strip_control(F.substring_index(e, "->", 1)).alias("term"),
            i.alias("pos"),
            F.when(two_parts, count).otherwise(0).alias("tf"),
        )

    entries = F.transform(split_fields(inner, ", "), entry)

    def last_ones(ordered: Column) -> Column:
        # Sorted by term and position: an entry counts if another term follows.
        kept = F.filter(
            ordered,
            lambda e, i: F.coalesce(F.get(ordered, i + 1)["term"] != e["term"], F.lit(True)),
        )
        return F.transform(kept, lambda e: F.struct(e["term"].alias("key"), e["tf"].alias("value")))

    # The one-element array binds the sorted entries, so they are sorted once. sort_array compares entries natively,
    # array_sort by a lambda expression for every pair.
    pairs = F.get(F.transform(F.array(F.sort_array(entries)), last_ones), F.lit(0))
    return lines.withColumn("term_freqs", F.map_from_entries(pairs)).drop("value")


def format_term_freq_maps(df: DataFrame, column: str = "term_freqs") -> DataFrame:
    """The text form of term counts, one line per document."""
    entry = F.transform(
        F.map_entries(column), lambda e: F.concat_ws(" -> ", e["key"], e["value"].cast("string"))
    )
    return df.select(F.concat(F.lit("Map("), F.array_join(entry, ", "), F.lit(")")).alias("value"))
