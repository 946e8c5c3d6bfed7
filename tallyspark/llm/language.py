"""Language identification by rank-order profiles.

A profile is a language's most frequent character n-grams in order. A text's
own n-grams are put in order the same way, and its distance to a language is
the sum, over its n-grams, of how far out of place each stands in that
language's profile; an n-gram that the profile lacks counts as far as can be.
The language of the least distance wins.

Words are runs of letters, lower-cased and padded by a blank on both sides;
n-grams have one to three characters. Equal counts rank by code points, equal
distances go to the language that sorts first, so nothing depends on how rows
are dealt.

Nulls: a null text, or one without a letter, gets ``und`` and a score of 0.
Where no language could be learned, so does every text. Languages that are null
and texts that are null teach nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NONE = "und"
_OTHERS = re.compile(r"[\W\d_]+")
# A code point takes 21 bits, so that up to three make one number in the order of code points.
_BITS, _LONGEST = 21, 3
_BLANK = ord(" ")


@dataclass(frozen=True)
class Shape:
    longest: int = 3  # characters of an n-gram
    ranks: int = 300  # n-grams of a profile
    slice: int = 1 << 20  # characters of a text that are counted at a time
    batch: int = 1 << 21  # n-grams that are put together before they are counted, while learning

    def __post_init__(self) -> None:
        if not 1 <= self.longest <= _LONGEST:
            raise ValueError(f"n-grams have 1 to {_LONGEST} characters, not {self.longest}")


def _grams(text: str, shape: Shape) -> Iterator[np.ndarray]:
    """The n-grams of a text as numbers, with repeats, slice by slice; none without a letter."""
    words = _OTHERS.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, words)):  # number signs such as fractions are no letters
        return
    # Neighbours share the blank between them: each word has one on either side.
    points = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    for at in range(0, len(points), shape.slice):
        part = points[at : at + shape.slice + _LONGEST - 1]
        own = min(shape.slice, len(part))
        found = part[:own] << (2 * _BITS)
        out = [found[part[:own] != _BLANK]]
        if shape.longest > 1:
            found = found[: len(part) - 1] | part[1 : own + 1] << _BITS
            out.append(found)
        if shape.longest > 2:
            inner = part[1 : min(own, len(part) - 2) + 1] != _BLANK  # else it stands in two words
            out.append((found[: len(inner)] | part[2 : own + 2])[inner])
        yield np.concatenate(out)


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number once, in order, and how often it was there."""
    if not len(grams):
        return grams, np.empty(0, np.int64)
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.diff(np.append(first, len(grams)))


def _counts(text: str, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for grams in _grams(text, shape):
        some, n = _counted(grams)
        if not len(codes):
            codes, counts = some, n
            continue
        codes, place = np.unique(np.concatenate([codes, some]), return_inverse=True)
        both = np.concatenate([counts, n])
        counts = np.zeros(len(codes), np.int64)
        np.add.at(counts, place, both)
    return codes, counts


def _name(code: int) -> str:
    mask = (1 << _BITS) - 1
    return "".join(chr(c) for c in (code >> 2 * _BITS, code >> _BITS & mask, code & mask) if c)


def _code(gram: str) -> int:
    return sum(ord(c) << _BITS * (_LONGEST - 1 - i) for i, c in enumerate(gram))


def _learner(shape: Shape):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, grams in waiting.items():
                codes, n = _counted(np.concatenate(grams))
                langs = pa.DictionaryArray.from_arrays(np.zeros(len(codes), np.int32), pa.array([lang])).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs, pa.array(codes), pa.array(n, pa.int64())], ["lang", "gram", "n"])
            waiting.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for grams in _grams(text, shape):
                    waiting.setdefault(lang, []).append(grams)
                    size += len(grams)
                    if size > shape.batch:
                        yield from flush()
                        size = 0
        yield from flush()

    return learn


def profiles(docs: DataFrame, learn_from: Column, shape: Shape = Shape()) -> list[tuple[str, list[str]]]:
    """(language, its n-grams in order) for every language of the rows to learn from.

    All of these rows count. What reaches the driver is ``ranks`` n-grams for
    each language, whatever the number of documents.
    """
    rows = docs.where(learn_from).where("text IS NOT NULL AND lang IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
    parts = rows.mapInArrow(_learner(shape), "lang string, gram long, n long")
    counted = parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= shape.ranks)
    found: dict[str, list[str]] = {}
    for r in sorted(best.collect(), key=lambda r: (r["lang"], r["rank"])):
        found.setdefault(r["lang"], []).append(_name(r["gram"]))
    return sorted(found.items())


def _scorer(learned: list[tuple[str, list[str]]], shape: Shape):
    langs = [lang for lang, _ in learned]
    far = shape.ranks
    known = np.array(sorted({_code(g) for _, grams in learned for g in grams}), np.int64)
    places = np.full((len(langs), len(known) + 1), -1, np.int32)  # the last column: in no profile
    for k, (_, grams) in enumerate(learned):
        places[k, np.searchsorted(known, [_code(g) for g in grams])] = np.arange(len(grams))

    def score(text: str | None) -> tuple[str, float]:
        codes, counts = _counts(text, shape) if text and langs else ((), ())
        if not len(codes):
            return NONE, 0.0
        if len(codes) > shape.ranks:  # those below the last rank's count can't get in
            stay = counts >= np.partition(counts, -shape.ranks)[-shape.ranks]
            codes, counts = codes[stay], counts[stay]
        codes = codes[np.argsort(-counts, kind="stable")][: shape.ranks]  # equal counts stay in order
        at = np.searchsorted(known, codes)
        at[known[np.minimum(at, len(known) - 1)] != codes] = len(known)
        at = places[:, at]
        out = np.where(at >= 0, np.abs(at - np.arange(len(codes))), far).sum(axis=1)
        best = int(np.argmin(out))
        return langs[best], 1.0 - float(out[best]) / (far * len(codes))

    return score


def _judge(learned: list[tuple[str, list[str]]], shape: Shape):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(learned, shape)
        for batch in batches:
            found = [score(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"],
            )

    return judge


def _filters(learned: list[tuple[str, list[str]]], least: float, shape: Shape):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(learned, shape)
        for batch in batches:
            found = map(score, batch.column(batch.schema.names.index("text")).to_pylist())
            yield batch.filter(pa.array([lang != NONE and s >= least for lang, s in found], pa.bool_()))

    return keep


def identify(docs: DataFrame, learned: list[tuple[str, list[str]]], shape: Shape = Shape(), keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all, unless named) with ``lang_pred`` and ``score``.

    The score is 1 where a text's n-grams stand just as in the profile, and 0
    where the profile has none of them.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    rows = docs.select(*[f"`{c}`" for c in names], F.col("text").alias("_text"))
    schema = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(_judge(learned, shape), schema)


def accepted(docs: DataFrame, learned: list[tuple[str, list[str]]], least: float = 0.2, shape: Shape = Shape()) -> DataFrame:
    """The documents that are in some learned language: not those without a letter, nor those
    whose n-grams the nearest profile hardly has."""
    return docs.mapInArrow(_filters(learned, least, shape), docs.schema)
