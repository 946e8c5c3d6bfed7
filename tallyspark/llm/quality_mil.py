"""Quality of a text by attention over its passages (multiple-instance learning).

A text is cut into passages of a fixed number of words; each is encoded by
figures of its words, characters and repeats through a learned layer. Gated
attention weighs the passages, the weighted mean of their encodings is scored,
and only the document's label teaches which passages matter.

The model is fitted on the driver to a bounded sample of labelled rows
(``Settings.sample`` documents, picked by a hash, of which whole or sampled
passages up to ``Settings.sample_words``; no length is left out); scoring runs
over all passages of all documents in the executors.

Nulls: a null text is an empty one; a text without a word is one passage whose
figures are all 0, so it gets a score like any other. Rows without a label, or
whose label is null, teach nothing; of several labels of one document the
largest counts. Where nothing can be learned every score is 0.5. Equal texts
get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    passage: int = 100  # words
    sample: int = 4_000  # labelled documents to learn from, at most
    sample_words: int = 2_000_000  # words to learn from, at most: long texts make the sample smaller
    teaching: int = 200  # passages of one document to learn from, at most
    hidden: int = 16
    attention: int = 8
    rounds: int = 300
    rate: float = 0.02
    decay: float = 1e-4


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 500_000 and len(word) < 64:
            self[word] = h
        return h


_HASHES = _WordHashes()

_SIGNS = b"#*$%&|<>"
_BLANK, _LOWER, _UPPER, _DIGIT, _SIGN, _STOP, _BREAK, _MARK, _WIDE = range(9)


def _classes() -> np.ndarray:
    """What kind of character a byte is."""
    kinds = np.full(256, _MARK, np.uint8)
    kinds[128:] = _WIDE
    for b in range(128):
        c = chr(b)
        if c in " \t\r\x0b\x0c":
            kinds[b] = _BLANK
        elif c == "\n":
            kinds[b] = _BREAK
        elif c.islower():
            kinds[b] = _LOWER
        elif c.isupper():
            kinds[b] = _UPPER
        elif c.isdigit():
            kinds[b] = _DIGIT
        elif b in _SIGNS:
            kinds[b] = _SIGN
        elif c in ".,;":
            kinds[b] = _STOP
    return kinds


_KINDS = _classes()
FEATURES = 20


def passages(text: str | None, size: int = 100) -> np.ndarray:
    """(passages, FEATURES): the figures of each passage of the whole text."""
    raw = text.encode() if text else b""
    parts = raw.split()
    if not parts:
        return np.zeros((1, FEATURES))
    n = len(parts)
    count = -(-n // size)
    kinds = _KINDS[np.frombuffer(raw, np.uint8)]
    blank = (kinds == _BLANK) | (kinds == _BREAK)
    begins = ~blank
    begins[1:] &= blank[:-1]
    starts = np.flatnonzero(begins)  # as many as there are words: both part by the same blanks
    edges = starts[::size].copy()
    edges[0] = 0
    owner = np.repeat(np.arange(count), np.diff(np.append(edges, len(raw))))
    table = np.bincount(owner * 9 + kinds, minlength=count * 9).reshape(count, 9).astype(float)
    inside = table.sum(axis=1) - table[:, _BLANK] - table[:, _BREAK]
    shares = table / np.maximum(inside, 1)[:, None]

    hashes = np.fromiter(map(_HASHES.__getitem__, parts), np.uint64, n)
    lengths = np.fromiter(map(len, parts), np.int64, n)
    place = np.arange(n) // size
    words = np.bincount(place, minlength=count).astype(float)
    # Distinct words of a passage, and of the whole text.
    order = np.lexsort((hashes, place))
    h, p = hashes[order], place[order]
    new = np.ones(n, bool)
    new[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
    distinct = np.bincount(p[new], minlength=count) / words
    same_next = np.zeros(n)
    same_next[1:] = hashes[1:] == hashes[:-1]
    # Words whose run of four stands elsewhere in the text, too.
    again = np.zeros(n)
    if n >= 8:
        runs = hashes[:-3] * np.uint64(3) + hashes[1:-2] * np.uint64(5) + hashes[2:-1] * np.uint64(7) + hashes[3:] * np.uint64(11)
        _, back, times = np.unique(runs, return_inverse=True, return_counts=True)
        again[: len(runs)] = times[back] > 1
    mean = np.bincount(place, lengths, count) / words
    spread = np.sqrt(np.maximum(np.bincount(place, lengths**2, count) / words - mean**2, 0))
    whole = len(np.unique(hashes)) / n

    def per_word(x: np.ndarray) -> np.ndarray:
        return np.bincount(place, x, count) / words

    return np.column_stack(
        [
            *(shares[:, k] for k in (_LOWER, _UPPER, _DIGIT, _SIGN, _STOP, _MARK, _WIDE)),
            table[:, _BREAK] / words, np.log1p(words) / 5, np.log1p(mean) / 2, np.log1p(spread),
            distinct, np.full(count, whole), per_word(same_next), per_word(again),
            per_word((lengths <= 2).astype(float)), per_word((lengths >= 12).astype(float)),
            np.minimum(table[:, _SIGN] / words, 3), np.minimum(table[:, _MARK] / words, 3), np.full(count, np.log1p(n) / 10),
        ]
    )


@dataclass(frozen=True)
class Model:
    shift: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, bags: Sequence[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(b) for b in bags])
        return _forward(self.weights, (np.vstack(bags) - self.shift) / self.scale, sizes)["score"]


def _sum_by(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts, axis=0)


def _forward(w: dict[str, np.ndarray], x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    h = np.tanh(x @ w["encode"] + w["encode_b"])
    t = np.tanh(h @ w["value"])
    g = 1 / (1 + np.exp(-(h @ w["gate"])))
    e = (t * g) @ w["attend"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a = e / np.repeat(_sum_by(e, starts), sizes)
    z = _sum_by(a[:, None] * h, starts)
    score = 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out_b"], -30, 30)))
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "score": score, "starts": starts}


def fit(bags: Sequence[np.ndarray], labels: np.ndarray, settings: Settings = Settings()) -> Model:
    """Gradient descent (Adam) on the cross entropy of the documents' labels."""
    rng = np.random.default_rng(11)
    x = np.vstack(bags)
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - shift) / scale
    sizes = np.array([len(b) for b in bags])
    d, h, a = x.shape[1], settings.hidden, settings.attention
    w = {
        "encode": rng.normal(0, d**-0.5, (d, h)), "encode_b": np.zeros(h), "value": rng.normal(0, h**-0.5, (h, a)),
        "gate": rng.normal(0, h**-0.5, (h, a)), "attend": rng.normal(0, a**-0.5, a), "out": rng.normal(0, h**-0.5, h), "out_b": np.zeros(1),
    }
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, settings.rounds + 1):
        f = _forward(w, x, sizes)
        slope = (f["score"] - labels) / len(labels)
        d_z = slope[:, None] * w["out"]
        per_row = np.repeat(d_z, sizes, axis=0)
        d_a = (per_row * f["h"]).sum(axis=1)
        d_e = f["a"] * (d_a - np.repeat(_sum_by(f["a"] * d_a, f["starts"]), sizes))
        d_t = d_e[:, None] * w["attend"] * f["g"] * (1 - f["t"] ** 2)
        d_g = d_e[:, None] * w["attend"] * f["t"] * f["g"] * (1 - f["g"])
        d_h = (f["a"][:, None] * per_row + d_t @ w["value"].T + d_g @ w["gate"].T) * (1 - f["h"] ** 2)
        grads = {
            "out": f["z"].T @ slope, "out_b": slope.sum(keepdims=True), "attend": (f["t"] * f["g"]).T @ d_e,
            "value": f["h"].T @ d_t, "gate": f["h"].T @ d_g, "encode": x.T @ d_h, "encode_b": d_h.sum(axis=0),
        }
        for k, grad in grads.items():
            grad = grad + settings.decay * w[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            w[k] = w[k] - settings.rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(shift, scale, w)


def _picked(bag: np.ndarray, most: int) -> np.ndarray:
    """At most so many passages, by a hash of their figures, in the text's order."""
    if len(bag) <= most:
        return bag
    hashes = np.array([xxhash.xxh3_64_intdigest(row.tobytes()) for row in bag], np.uint64)
    return bag[np.sort(np.argsort(hashes, kind="stable")[:most])]


def _featurer(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = (passages(t, settings.passage).astype("<f4") for t in batch.column(2).to_pylist())
            found = [_picked(bag, settings.teaching).tobytes() for bag in bags]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["place", "label", "figures"])

    return run


def learn(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, settings: Settings = Settings()) -> Model | None:
    """A model from a bounded sample of the labelled documents; None without both labels.

    ``learn_from`` is a condition on doc_id. The sample is the same whenever
    the tables are: it goes by a hash of the id.
    """
    wanted = labels.where(learn_from).where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    # No more rows than the sample may have, so sending them to every task is safe.
    texts = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
    rows = texts.select(F.xxhash64("doc_id").alias("place"), "label", "text")
    figures = rows.mapInArrow(_featurer(settings), "place long, label int, figures binary")
    # The bound on words, in passages, is filled in the order of the id's hash, whatever the length;
    # who comes last teaches with as many passages as there is room for.
    ordered = figures.orderBy("place", F.xxhash64("figures")).limit(settings.sample)
    bags, targets, room = [], [], settings.sample_words // settings.passage
    for r in ordered.toLocalIterator():
        if room <= 0:
            break
        bags.append(_picked(np.frombuffer(r["figures"], "<f4").reshape(-1, FEATURES), room).astype(float))
        targets.append(min(max(r["label"], 0), 1))
        room -= len(bags[-1])
    if len(set(targets)) < 2:
        return None
    return fit(bags, np.array(targets, float), settings)


def _scorer(model: Model | None, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            scores = np.full(len(texts), 0.5)
            if model is not None:
                for at in range(0, len(texts), 256):
                    scores[at : at + 256] = model.scores([passages(t, settings.passage).astype("<f4") for t in texts[at : at + 256]])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], [*batch.schema.names[:-1], "score"])

    return run


def scored(docs: DataFrame, model: Model | None, keep: Sequence[str], settings: Settings = Settings()) -> DataFrame:
    """The kept columns and ``score``, 0 to 1, for every document."""
    rows = docs.select(*[f"`{c}`" for c in keep], F.col("text").alias("_text"))
    return rows.mapInArrow(_scorer(model, settings), rows.drop("_text").schema.add("score", "double"))
