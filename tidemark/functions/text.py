"""String expressions with strict parsing rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Page parts without readable text.
HIDDEN_HTML = (
    r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<!--.*?-->"
)
REGEX_SPECIAL = ".$|()[{^?*+\\"
# All characters up to and including the blank.
CONTROL = "".join(map(chr, range(0x21)))
# A whole number as the parsers accept it: no blanks, optional sign.
INTEGER_PATTERN = r"^[+-]?\d+$"


def strip_control(c: Column) -> Column:
    """Remove leading and trailing characters up to and including the blank."""
    return F.trim(c, F.lit(CONTROL))


def split_fields(c: Column, sep: str) -> Column:
    """Split on a literal separator; empty fields at the end are dropped."""
    if len(sep) == 1:
        return F.split(F.rtrim(c, F.lit(sep)), re.escape(sep) if sep in REGEX_SPECIAL else sep)
    literal = re.escape(sep)
    trimmed = F.when(c.endswith(sep), F.regexp_replace(c, f"(?:{literal})+$", "")).otherwise(c)
    return F.split(trimmed, literal)


def strict_int(c: Column) -> Column:
    """Integer value, or NULL unless the text is exactly one whole number."""
    return F.when(c.rlike(INTEGER_PATTERN), c.try_cast("int"))


def must_cast(c: Column, to: str) -> Column:
    """The value as the given type; text that is none stops the job, in any cast mode."""
    failure = F.raise_error(F.concat(F.lit(f"not a value of type {to}: "), c)).cast(to)
    return F.coalesce(c.try_cast(to), failure)


def is_only_letters(c: Column) -> Column:
    """True when every character is a Unicode letter (also for empty text)."""
    return c.rlike(r"^\p{L}*$")


def letter_tokens(c: Column) -> Column:
    """Array of the maximal runs of letters in a text."""
    return F.regexp_extract_all(c, F.lit(r"\p{L}+"), F.lit(0))


def strip_html(c: Column) -> Column:
    """Readable text of an HTML page: scripts, styles, comments and tags go."""
    body = F.regexp_replace(c, HIDDEN_HTML, " ")
    body = F.regexp_replace(body, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(body, r"[ \t\r\n]+", " "))
