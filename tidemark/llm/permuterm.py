"""Spelling variants by permuterm rotations.

A word with a mark at its end is turned round at every place. Of the rotation
that begins behind character x, in ``a x b`` this is ``b mark a x``, all but x is
the same for every word that has another character in its place, and it is the
whole rotation ``b mark a`` of the word without x. So in the sorted rotations,
words that are one replacement apart share the prefix that ends before the edited
character, and a word one character shorter stands at the start of that range.
A character that repeats the one before it gives the same shorter word again, so
only the first of equal characters counts for insertions and deletions.

A range holds at most one word per character of the alphabet, and one scan of it
gives each of its words the number of its neighbours there and the best of them;
no pairs are formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.runs import lower_runs
from tidemark.operators.stats import dense_index
from tidemark.session import written

MARK = "\0"
#: Rotations of more code points are sorted by a 128-bit digest; whole, a word of n characters would take n * n.
LONGEST = 64
_PRIME, _BASE = 2**127 - 1, 0x5851F42D4C957F2D14057B7EF767814F
_PIECE = 100_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3] = True


def latin(data: np.ndarray) -> np.ndarray:
    """Bytes of A-Z, a-z and U+00C0 to U+00FF; the latter are a byte C3 and the one after it."""
    out = _LETTER[data]
    out[1:] |= data[:-1] == 0xC3
    return out


def document_words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 1) -> DataFrame:
    """``key, word, n``: the lower-cased (A-Z) words of ``shortest`` code points or more of each text.

    A word is a run of Latin letters. Nothing is shuffled: a word of a text longer
    than ``runs.GROUP`` may come in several rows, which add up. Null and empty
    texts have no rows, rows of one key are not joined, null keys stay null.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, words, _, _ in lower_runs(batch.column(1), latin):
                coded = words.dictionary_encode()
                names = coded.dictionary.cast(pa.string())
                long_enough = np.asarray(pc.utf8_length(names)) >= shortest
                code = np.asarray(coded.indices).astype(np.int64)
                kept = long_enough[code]
                pairs, n = np.unique(owner[kept] * len(names) + code[kept], return_counts=True)
                who, what = np.divmod(pairs, max(len(names), 1))
                for at in range(0, len(n), _PIECE):
                    s = slice(at, at + _PIECE)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(who[s])), names.take(pa.array(what[s])), pa.array(n[s].astype(np.int64))], ["key", "word", "n"]
                    )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(count, f"key {kind}, word string, n long")


def _digests(word: str, skip: int) -> Iterator[str]:
    """Digest and length of every rotation of a long word, without the ``skip`` characters behind its end.

    The digest is the value of a polynomial modulo a prime of 127 bits, so equal
    texts agree and two that differ collide with a chance below 1e-30.
    """
    n, front, power = len(word), [0], [1]
    for c in word:
        front.append((front[-1] * _BASE + ord(c) + 1) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)
    for i in range(n + 1 - skip):
        back = front[n] - front[i + skip] * power[n - i - skip]
        yield f"{(back * _BASE * power[i] + front[i]) % _PRIME:032x}:{n + 1 - skip}"


def rotations(word: str) -> Iterator[tuple[str, bool, bool]]:
    """``(text, whole, counts)``: every rotation, and every one without the character behind its end.

    ``counts`` is false for a character that repeats the one before it.
    """
    n = len(word)
    whole = (word[i:] + MARK + word[:i] for i in range(n + 1)) if n + 1 <= LONGEST else _digests(word, 0)
    for text in whole:
        yield text, True, True
    short = (word[i + 1 :] + MARK + word[:i] for i in range(n)) if n <= LONGEST else _digests(word, 1)
    for i, text in enumerate(short):
        yield text, False, i == 0 or word[i] != word[i - 1]


def _rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["rotation", "whole", "counts", "id", "n"]
    for batch in batches:
        out, who = [], []

        def rows():
            columns = [pa.array(c) for c in zip(*out, strict=True)]
            place = pa.array(who)
            return pa.RecordBatch.from_arrays([*columns, batch.column(1).take(place), batch.column(2).take(place)], names)

        for i, word in enumerate(batch.column(0)):
            for row in rotations(word.as_py()):
                out.append(row)
                who.append(i)
                if len(out) >= _PIECE:
                    yield rows()
                    out, who = [], []
        if out:
            yield rows()


def near_words(words: DataFrame) -> DataFrame:
    """``id, n_near, best`` for each word of ``(word, id, n)`` with a neighbour.

    Neighbours differ by one inserted, deleted or replaced code point; ``best`` is
    the struct ``id, n`` of the neighbour of smallest id. Words must be distinct
    and have no code point U+0000. An empty table gives no rows.
    """
    rows = words.select("word", "id", "n").mapInArrow(_rotated, "rotation string, whole boolean, counts boolean, id long, n long")
    group = Window.partitionBy("rotation")
    me = F.struct("id", "n")
    of = lambda when: F.min(F.when(when, me)).over(group)
    skips = ~F.col("whole")
    scanned = (
        rows.withColumns({"first": of(skips), "shorter": of(F.col("whole")), "edited": F.count_if(skips).over(group)})
        .withColumns({"second": of(skips & (F.col("id") > F.col("first.id"))), "longer": of(skips & F.col("counts")), "grown": F.count_if(skips & F.col("counts")).over(group)})
    )
    # A whole rotation sees the longer words of its range; one without a character the others like it, and the shorter word.
    other = F.when(F.col("first.id") == F.col("id"), F.col("second")).otherwise(F.col("first"))
    short = F.when(F.col("counts"), F.col("shorter"))
    near = F.when(F.col("whole"), F.col("grown")).otherwise(F.col("edited") - 1 + short.isNotNull().cast("long"))
    best = F.when(F.col("whole"), F.col("longer")).otherwise(F.least(other, short))
    found = scanned.select("id", near.alias("near"), best.alias("best")).filter("near > 0")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def spelling_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct words ``(word, n)``.

    ``form`` is the neighbour of largest n (ties: the smallest word in code-point
    order) if its n is at least ``ratio`` (above 1) times the word's own, else null. ``root``
    follows forms to the last, the word itself without one. ``n_near`` counts
    neighbours, ``form_n`` is the form's n. Null words are left out; an empty
    table gives no rows.
    """
    if ratio < 2:
        raise ValueError("chains of forms end only if each is more frequent than the one before")
    ranked = written(dense_index(words.filter("word is not null").select("word", "n"), [F.desc("n"), F.asc("word")], "id"))
    near = written(near_words(ranked))
    moves = near.join(ranked.select("id", "n"), "id").filter(F.col("best.n") >= ratio * F.col("n"))
    step = written(moves.select("id", F.col("best.id").alias("to")))
    roots = step
    # A step multiplies n by the ratio, so the chains have at most log n steps and doubling needs the log of that.
    while True:
        beyond = roots.select(F.col("id").alias("to"), F.col("to").alias("beyond"))
        longer = written(roots.join(beyond, "to", "left").select("id", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("moved")))
        done = longer.filter("moved").isEmpty()
        roots = longer.select("id", "to")
        if done:
            break
    form = ranked.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = ranked.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    ends = step.withColumnRenamed("to", "form_id").join(roots.withColumnRenamed("to", "root_id"), "id").join(form, "form_id").join(root, "root_id")
    out = ranked.join(near.select("id", "n_near"), "id", "left").join(ends.select("id", "form", "form_n", "root"), "id", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
