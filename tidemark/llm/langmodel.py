"""Language identification by interpolated Kneser-Ney character models.

Every language gets a model of up to four characters, within words: letters are
lower-cased, every run of other characters is one word end, and contexts do not
cross it. All labelled documents are counted in their tasks, by the characters
of each run of four, and the counts are summed per language; continuation counts
of the shorter runs follow from the distinct longer ones. Models are sorted
arrays of these runs with their log probabilities, as many as the texts have.

The language with the lowest cross-entropy per character wins. Its excess over
the language's usual cross-entropy, times the root of the length, is compared
with what labelled documents of that language show under a model of the other
half of them; beyond ``SLACK`` times their ``QUANTILE`` the document is rejected.
Languages of fewer than ``FEW`` such documents also have the bound of all
languages together, and the looser of both holds; one without any rejects nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.llm.wordhash import mix
from tidemark.session import written

ORDER = 4
DISCOUNT = 0.75
#: Characters scored at a time.
SPAN = 1 << 18
#: Rows of a batch that are decoded at a time.
SLICE = 256
#: Distinct runs of four, by language, that a task holds before it passes them on.
HELD = 1 << 20
#: Rejection: this multiple of this quantile of the labelled documents' excess.
QUANTILE, SLACK = 0.999, 1.5
#: Documents that a language's own quantile needs.
FEW = 1000
#: Sharpness of the score: it is the weight of the best language among all, by this many characters.
SHARPNESS = 20.0
_PLACE = np.random.default_rng(17).integers(1, 2**63, ORDER, dtype=np.uint64) | np.uint64(1)
#: Bits of a character.
_WIDE = 21
_cache: dict = {}


def _symbols() -> np.ndarray:
    """Lower-cased code point of every letter, 0 for all else."""
    if "symbols" not in _cache:
        table = np.zeros(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                table[c] = ord(x.lower()[0])
        _cache["symbols"] = table
    return _cache["symbols"]


class Grams:
    """The predicted characters of some texts with the three before each, and each text's run of them.

    ``low`` has the last three of the four characters, ``high`` the first.
    """

    def __init__(self, texts: list[str]):
        codes = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbols = _symbols()[codes]
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
        place = np.cumsum(keep) - 1
        ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
        # Each text is predicted from after the break before it up to the first word end at or after its last letter.
        self.ends = place[ends]
        s = symbols[keep].astype(np.int64)
        c1, c2, c3 = (np.concatenate([np.zeros(k, dtype=np.int64), s[:-k]])[: len(s)] for k in (1, 2, 3))
        c2[c1 == 0] = 0
        c3[c2 == 0] = 0
        self.high, self.low = c3[1:], (c2 << 2 * _WIDE | c1 << _WIDE | s)[1:]

    def distinct(self) -> tuple[np.ndarray, ...]:
        """Hash, ``high``, ``low`` and number of every run of four."""
        key, first, n = np.unique(_hash(self.high, self.low), return_index=True, return_counts=True)
        return key, self.high[first], self.low[first], n


def _hash(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """64 bits of a run of four."""
    return mix(high.astype(np.uint64) * _PLACE[0] + mix(low.astype(np.uint64) + _PLACE[1]))


def _key(k: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The last k characters: exact up to three, a hash for four."""
    return _hash(high, low) if k == ORDER else low & ((1 << k * _WIDE) - 1)


def _context(k: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The k - 1 characters before the last one, exact."""
    return (high << 2 * _WIDE | low >> _WIDE) & ((1 << (k - 1) * _WIDE) - 1)


def _spans(texts: list[str], limit: int = SPAN) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for hi, t in enumerate(texts):
        size += len(t)
        if size > limit:
            yield lo, hi + 1
            lo, size = hi + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _pieces(text: str, size: int = 4 * SPAN) -> list[str]:
    """A long text in pieces that end after a blank, where there is one."""
    out, at = [], 0
    while len(text) - at > size:
        cut = text.rfind(" ", at, at + size) + 1
        cut = cut if cut > at else at + size
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]] if out else [text]


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    key, high, low, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    key, first, place = np.unique(key, return_index=True, return_inverse=True)
    return key, high[first], low[first], np.bincount(place, weights=n, minlength=len(key)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``text, lang, fold`` to counts of runs of four; some come more than once from a task."""
    kept: dict[tuple[str, int], list[tuple[np.ndarray, ...]]] = {}
    held = 0

    def passed() -> Iterator[pa.RecordBatch]:
        for (lang, fold), ((_, high, low, n),) in kept.items():
            head = [pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), fold, dtype=np.int32))]
            yield pa.RecordBatch.from_arrays([*head, pa.array(high.astype(np.int32)), pa.array(low), pa.array(n)], ["lang", "fold", "high", "low", "n"])

    for batch in batches:
        for at, texts in _by_language_of(batch):
            for lo, hi in _spans(texts):
                kept.setdefault(at, []).append(Grams(texts[lo:hi]).distinct())
                held += len(kept[at][-1][0])
            if held > HELD:
                kept = {x: [_merged(parts)] for x, parts in kept.items()}
                held = sum(len(parts[0][0]) for parts in kept.values())
                if held > HELD // 2:
                    yield from passed()
                    kept, held = {}, 0
    kept = {x: [_merged(parts)] for x, parts in kept.items()}
    yield from passed()


def _by_language_of(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """The texts of each language and fold, from some hundred rows at a time."""
    for start in range(0, len(batch), SLICE):
        part = batch.slice(start, SLICE)
        by: dict[tuple[str, int], list[str]] = {}
        for text, *at in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
            by.setdefault(tuple(at), []).extend(_pieces(text))
        yield from by.items()


def _level(context: np.ndarray, n: np.ndarray, shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probability per gram, sorted contexts and the log weights of their shorter models."""
    contexts, place = np.unique(context, return_inverse=True)
    total, kinds = np.bincount(place, weights=n), np.bincount(place)
    weight = np.minimum(DISCOUNT * kinds / total, 1.0)
    p = np.maximum(n - DISCOUNT, 0) / total[place] + weight[place] * shorter
    return np.log(np.maximum(p, 1e-12)), contexts, np.log(np.maximum(weight, 1e-12))


def _model(high: np.ndarray, low: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Per order: sorted keys, their log probabilities, sorted contexts, the log weights of their shorter models."""
    grams = {ORDER: (high, low, n.astype(float))}
    for k in range(ORDER - 1, 0, -1):
        high, low, _ = grams[k + 1]
        key, n = np.unique(_key(k, high, low), return_counts=True)
        grams[k] = (np.zeros_like(key), key, n.astype(float))
    out, known = [], None
    for k in range(1, ORDER + 1):
        high, low, n = grams[k]
        if k == 1:
            shorter = np.full(len(low), 1.0 / (len(low) + 1))
        else:
            shorter = np.exp(known[1][np.searchsorted(known[0], _key(k - 1, high, low))])
        logp, contexts, weight = _level(_context(k, high, low), n, shorter)
        key = _key(k, high, low)
        order = np.argsort(key)
        known = (key[order], logp[order])
        out.append((known[0], known[1].astype(np.float32), contexts, weight.astype(np.float32)))
    return out


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted keys among the sorted ones, and whether they are there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _logs(orders: list[tuple[np.ndarray, ...]], high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Log probability of the last of every four characters in one language."""
    value, rest = np.zeros(len(low)), np.arange(len(low))
    for k in range(ORDER, 0, -1):
        keys, logp, contexts, weight = orders[k - 1]
        at, there = _found(keys, _key(k, high[rest], low[rest]))
        value[rest[there]] += logp[at[there]]
        rest = rest[~there]
        at, there = _found(contexts, _context(k, high[rest], low[rest]))
        value[rest[there]] += weight[at[there]]
    value[rest] -= np.log(len(orders[0][0]) + 1)
    return value


def _entropies(texts: list[str], model: dict, only: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Summed negative log probability per text and language (all, or one), and characters predicted (0 without a letter)."""
    orders, out, sizes = model["orders"] if only is None else [model["orders"][only]], [], []
    pieces = [_pieces(t) for t in texts]
    flat, owner = [p for x in pieces for p in x], np.repeat(np.arange(len(texts)), [len(x) for x in pieces])
    for lo, hi in _spans(flat):
        g = Grams(flat[lo:hi])
        # Every distinct run is looked up once.
        _, first, place = np.unique(_hash(g.high, g.low), return_index=True, return_inverse=True)
        high, low = g.high[first], g.low[first]
        sums = np.zeros((hi - lo, len(orders)))
        for j, mine in enumerate(orders):
            total = np.concatenate([[0.0], np.cumsum(_logs(mine, high, low)[place])])
            sums[:, j] = total[g.ends[:-1]] - total[g.ends[1:]]
        out.append(sums)
        sizes.append(np.diff(g.ends))
    whole, n = np.zeros((len(texts), len(orders))), np.zeros(len(texts), dtype=np.int64)
    if texts:
        np.add.at(whole, owner, np.concatenate(out))
        np.add.at(n, owner, np.concatenate(sizes))
    return whole, n


def _measured(models: list[dict]):
    """Batches of ``text, lang, fold`` to ``lang, n, entropy`` under the model of the language without that fold."""
    places = [{x: i for i, x in enumerate(model["languages"])} for model in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(start, SLICE) for whole in batches for start in range(0, len(whole), SLICE)):
            by: dict[tuple[str, int], list[str]] = {}
            for text, *at in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                by.setdefault(tuple(at), []).append(text)
            for (lang, fold), texts in by.items():
                if lang in places[fold]:
                    total, n = _entropies(texts, models[fold], places[fold][lang])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(n), pa.array(total[:, 0] / np.maximum(n, 1))], ["lang", "n", "entropy"])

    return run


def _scored(model: dict, place: int):
    """Batches of ``row`` with a text as field ``place`` to the row with ``lang, n, entropy, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = model["languages"]
        for batch in (whole.slice(start, SLICE) for whole in batches for start in range(0, len(whole), SLICE)):
            texts = [t or "" for t in batch.column(0).field(place).to_pylist()]
            total, n = _entropies(texts, model)
            rate = total / np.maximum(n, 1)[:, None]
            best = rate.argmin(axis=1) if len(texts) else np.zeros(0, dtype=np.int64)
            low = rate[np.arange(len(texts)), best]
            weight = np.exp(-SHARPNESS * (rate - low[:, None]))
            score = np.where(n > 0, 1 / weight.sum(axis=1), 0.0)
            lang = pa.array([names[b] if k else None for b, k in zip(best, n, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), lang, pa.array(n), pa.array(low), pa.array(score)], ["row", "lang", "n", "entropy", "score"])

    return run


def _models(table: pa.Table, counts: np.ndarray) -> dict:
    """A model of every language that has a run of four under these counts."""
    used = np.flatnonzero(counts)
    lang = table.column("lang").combine_chunks().dictionary_encode()
    names, of = lang.dictionary.to_pylist(), lang.indices.to_numpy()[used]
    high, low = (table.column(c).to_numpy()[used].astype(np.int64) for c in ("high", "low"))
    model = {"languages": [], "orders": []}
    for i in sorted(set(of.tolist()), key=names.__getitem__):
        mine = of == i
        model["languages"].append(names[i])
        model["orders"].append(_model(high[mine], low[mine], counts[used][mine]))
    return model


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Models and rejection bounds of every language in ``docs``.

    Counts and bounds cover all rows; rows with null text or language are left
    out. Bounds come from documents that the measuring model has not seen: equal
    texts are in the same half. The driver receives the distinct runs of four
    characters of every language with their counts, however many the texts
    have, and two numbers per language; the models go to every worker.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).filter("text is not null and lang is not null")
    rows = rows.withColumn("fold", (F.crc32(F.col("text").cast("binary")) % 2).cast("int"))
    counted = rows.mapInArrow(_counted, "lang string, fold int, high int, low long, n long")
    of = [F.sum(F.when(F.col("fold") == fold, F.col("n")).otherwise(0)).alias(f"n{fold}") for fold in (0, 1)]
    summed = counted.groupBy("lang", "high", "low").agg(*of).toArrow()
    n0, n1 = (summed.column(c).to_numpy() for c in ("n0", "n1"))
    model = {**_models(summed, n0 + n1), "usual": {}, "bound": {}}
    if model["languages"]:
        others = [_models(summed, n1), _models(summed, n0)]
        del summed
        seen = written(rows.mapInArrow(_measured(others), "lang string, n long, entropy double").filter("n > 0"))
        usual = seen.groupBy("lang").agg((F.sum(F.col("n") * F.col("entropy")) / F.sum("n")).alias("x"))
        model["usual"] = {r.lang: r.x for r in usual.collect()}
        if model["usual"]:
            over = F.percentile_approx(_excess(model, F.col("lang"), F.col("n"), F.col("entropy")), QUANTILE, 100_000).alias("x")
            pooled = seen.agg(over).first().x
            own = seen.groupBy("lang").agg(over, F.count("*").alias("n")).collect()
            model["bound"] = {r.lang: SLACK * (r.x if r.n >= FEW else max(r.x, pooled)) for r in own}
    return model


def _by_language(values: dict[str, float], lang: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), lang)


def _excess(model: dict, lang: Column, n: Column, entropy: Column) -> Column:
    return (entropy - _by_language(model["usual"], lang)) * F.sqrt(n.cast("double"))


def identify(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``row`` (the row as a struct), ``lang_pred``, ``score`` (0 to 1), ``rejected`` for every row.

    ``lang_pred`` is a learned language, the first in order of equal ones, or
    ``und`` with score 0 where the text is null or has no letter, or nothing was
    learned. Those are rejected, as are texts far less likely than the labelled
    ones of their language, where that has documents to compare with. Equal texts have equal results; repeated rows stay.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    if not model["languages"]:
        return rows.select("row", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    schema = StructType([rows.schema["row"]])
    for name, of in (("lang", "string"), ("n", "long"), ("entropy", "double"), ("score", "double")):
        schema = schema.add(name, of)
    found = rows.mapInArrow(_scored(model, docs.columns.index(text)), schema)
    far = F.lit(False)
    if model["bound"]:
        far = F.coalesce(_excess(model, F.col("lang"), F.col("n"), F.col("entropy")) > _by_language(model["bound"], F.col("lang")), far)
    return found.select("row", F.coalesce("lang", F.lit("und")).alias("lang_pred"), "score", (F.col("lang").isNull() | far).alias("rejected"))
