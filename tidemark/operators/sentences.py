"""Sentence boundaries, with abbreviations found in the texts themselves.

A word is taken for an abbreviation if a full stop follows it far more often than
chance, it is short, and it seldom stands without one: the likelihood ratio of
Kiss and Strunk (Unsupervised multilingual sentence boundary detection, 2006).
Counts are one aggregate over all words; decisions are made for the tokens that
end in a mark only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.joins import lookup_join
from tidemark.session import written

BLANK = r"[^ \t\n\r\f]"
OPENING = "\"'(\\[{«“‘¿¡"
CLOSING = "\"')\\]}»”’"
MARKS = ".!?…"
#: Opening signs, the word, its marks, closing signs.
PARTS = rf"(?s)^[{OPENING}]*(.*?)([{MARKS}]*)[{CLOSING}]*$"
NUMBER = r"^[0-9]+([.,:][0-9]+)*$"
#: Least score of an abbreviation.
LEAST = 0.3

_TOKEN = re.compile(rf"{BLANK}+")
_PARTS = re.compile(PARTS)
# A token that ends in a mark, found from its first character only.
_ENDING = re.compile(rf"(?<!{BLANK}){BLANK}*[{MARKS}][{CLOSING}]*(?!{BLANK})")
_BATCH = 100_000


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, total, stops, lowers``: occurrences of each lower-cased word, with a full stop behind it, in lower case."""
    tokens = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{BLANK}+"), F.lit(0))).alias("token"))
    # Each distinct token is taken apart once, not each occurrence.
    tokens = tokens.groupBy("token").agg(F.count("*").alias("n"))
    core, mark = (F.regexp_extract("token", PARTS, i) for i in (1, 2))
    words = tokens.select(core.alias("core"), mark.alias("mark"), "n").filter("core <> ''")

    def counted(which: Column) -> Column:
        return F.sum(F.when(which, F.col("n")).otherwise(F.lit(0)))

    return words.groupBy(F.lower("core").alias("word")).agg(
        F.sum("n").alias("total"), counted(F.col("mark") == ".").alias("stops"), counted(F.col("core").rlike(r"^\p{Ll}")).alias("lowers")
    )


def abbreviation_score(total: Column, stops: Column, word: Column, tokens: Column, all_stops: Column) -> Column:
    """How much more likely the word is an abbreviation than one that ends sentences by chance."""
    share, bare = all_stops / tokens, total - stops
    ratio = -2 * (stops * F.log(share) + bare * F.log(1 - share) - stops * F.log(F.lit(0.99)) - bare * F.log(F.lit(0.01)))
    letters = F.length(F.replace(word, F.lit("."), F.lit("")))
    inner = F.length(word) - letters + 1
    return ratio * F.exp(-letters) * inner * F.pow(letters, -bare)


def abbreviations(counts: DataFrame) -> DataFrame:
    """``word, score`` of the words taken for abbreviations; texts without full stops, or of nothing else, have none."""
    sums = counts.agg(F.sum("total").alias("tokens"), F.sum("stops").alias("all_stops"))
    rows = counts.filter("stops > 0").filter(F.col("word").rlike(r"\p{L}")).crossJoin(F.broadcast(sums)).filter("all_stops < tokens")
    score = abbreviation_score(*(F.col(c).cast("double") for c in ("total", "stops")), F.col("word"), *(F.col(c).cast("double") for c in ("tokens", "all_stops")))
    return rows.select("word", score.alias("score")).filter(F.col("score") >= LEAST)


_FIELDS = "first int, end int, next int, word string, mark string, next_word string, next_case string"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places where a sentence may end: tokens that end in a mark, and the last one."""
    names = ["place", "key", *(f.split()[0] for f in _FIELDS.split(", "))]

    def case(core: str) -> str:
        return "lower" if core[:1].islower() else "upper" if core[:1].isupper() else "other"

    for batch in batches:
        who, rows = [], []

        def out():
            place = pa.array(who)
            types = [pa.int32()] * 3 + [pa.string()] * 4
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays([*(batch.column(c).take(place) for c in (0, 1)), *columns], names)

        for i, value in enumerate(batch.column(2)):
            text = value.as_py() or ""
            begin = _TOKEN.search(text)
            if begin is None:
                continue
            for m in _ENDING.finditer(text):
                after = _TOKEN.search(text, m.end())
                if after is None:
                    break
                core, mark = _PARTS.match(m[0]).groups()
                follows = _PARTS.match(after[0])[1]
                rows.append((begin.start(), m.end(), after.start(), core.lower(), mark, follows.lower(), case(follows)))
                who.append(i)
                if len(rows) >= _BATCH:
                    yield out()
                    who, rows = [], []
            end = len(text.rstrip(" \t\n\r\f"))
            rows.append((begin.start(), end, None, "", "", None, None))
            who.append(i)
        if rows:
            yield out()


def split_sentences(docs: DataFrame, key: str = "doc_id", text: str = "text", counts: DataFrame | None = None) -> DataFrame:
    """``key, sentence, start, end``: sentences numbered from 0, as spans of characters without the blanks around them.

    A token that ends in a mark (and closing signs) ends a sentence unless a word
    in lower case follows. A full stop alone does not after a single letter, and
    after an abbreviation or a number only if a capitalised word follows that the
    texts also have in lower case. Null and blank texts have no sentences; every
    row is split by itself, also those of one key.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("place"), F.col(key).alias("key"), F.col(text).alias("text"))
    counts = written(word_counts(docs, text)) if counts is None else counts
    kind = rows.schema["key"].dataType.simpleString()
    places = rows.mapInArrow(_candidates, f"place long, key {kind}, {_FIELDS}")
    # Only the words that can be looked up at all are joined.
    known = abbreviations(counts).select("word", F.lit(True).alias("short"))
    lowers = counts.filter("lowers > 0").select(F.col("word").alias("next_word"), F.lit(True).alias("common"))
    joined = lookup_join(lookup_join(places, known, ["word"], "left"), lowers, ["next_word"], "left")
    initial = F.col("word").rlike(r"^\p{L}$")
    doubtful = F.col("short").isNotNull() | F.col("word").rlike(NUMBER)
    ends = (
        F.when(F.col("next").isNull(), True)
        .when(F.col("next_case") == "lower", False)
        .when(F.col("mark") != ".", True)
        .when(initial, False)
        .when(doubtful, (F.col("next_case") == "upper") & F.col("common").isNotNull())
        .otherwise(True)
    )
    order = Window.partitionBy("place", "key").orderBy("end")
    found = joined.filter(ends).select(
        F.col("key").alias(key),
        (F.row_number().over(order) - 1).alias("sentence"),
        F.coalesce(F.lag("next").over(order), "first").alias("start"),
        "end",
    )
    return found
