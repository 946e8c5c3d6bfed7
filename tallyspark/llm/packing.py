"""Packing documents into sequences of bounded length by minimum bin slack.

Texts become token ids; only what is longer than a sequence is cut. Pieces are
then counted by length: a histogram of at most ``capacity`` numbers, whatever
the corpus, is all that the search for good bins needs. For each bin, subset
sums over the available lengths, kept as the bits of one integer, show the
fullest feasible combination; it is removed, as often as the histogram has it.
Pieces are numbered within their length and each takes the place that the
combinations hold for its number. The search sees one histogram, the pieces
never leave the executors.

Nulls: a null text is an empty one; an empty text is the closing id alone.
Equal pieces are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import Memo, pinned, running_offsets

CAPACITY = 2048
# A task hands on its pieces when their ids have so many bytes; a document's stay together.
OUT_BYTES = 1 << 20


def _byte_names() -> dict[int, str]:
    """How byte-level vocabularies write a byte: printable ones as themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ChunkEncoder:
    """Token ids of a text as little-endian bytes, part by part.

    White space, digits and changes between letters and marks part tokens in
    this vocabulary, so a text's ids are those of its parts in order, and a
    part that was met before needs no encoding. Words are lowered before they
    are looked up. Of the parts met, the last ``MOST`` at most are kept. The
    names of special tokens in a text are those tokens, as for the tokenizer.
    A chunk between blanks with any character that isn't plain is left to the
    tokenizer.
    """

    MOST = 200_000
    # Plain characters are those of ASCII and letters that lower-case one to one and are in normal form already.
    _LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
    _LOW = "a-z\u00df-\u00f6\u00f8-\u00ff"
    _BLANKS = " \\t-\\r"
    _SLICE = re.compile(rf".{{1,1000000}}[^{_BLANKS}]*", re.DOTALL)
    _ODD = re.compile(rf"[^\x00-\x7f{_LETTERS}]")
    _ODD_CHUNK = re.compile(rf"(?<![^{_BLANKS}])([^{_BLANKS}]*[^\x00-\x7f{_LETTERS}][^{_BLANKS}]*)")
    _PARTS = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LOW}]+|[0-9]|[^{_BLANKS}{_LOW}0-9]+")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.names = _byte_names()
        self.special = {t.content: array("I", [i]).tobytes() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self._special_names = re.compile(f"({'|'.join(map(re.escape, self.special))})")
        self.forget()

    def forget(self) -> None:
        self.parts = Memo(self._part, self.MOST)
        self.chunks = Memo(self._chunk, self.MOST // 4)

    def _part(self, part: str) -> bytes:
        if not (part.isascii() and part.isprintable()):
            part = "".join(map(self.names.__getitem__, part.encode()))
        return array("I", [t.id for t in self.model.tokenize(part)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, self._PARTS.findall(text.lower())))

    def _unnamed(self, text: str) -> bytes:
        if text.isascii() or not self._ODD.search(text):
            return self._plain(text)
        return b"".join(self.chunks[x] if i % 2 else self._plain(x) for i, x in enumerate(self._ODD_CHUNK.split(text)))

    def encode(self, text: str | None) -> bytes:
        out = []
        for part in self._SLICE.findall(text or ""):
            out += [self.special[x] if i % 2 else self._unnamed(x) for i, x in enumerate(self._special_names.split(part))]
        return b"".join(out)


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    """One for each Python worker, which serves many tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def _cutter(path: str, closing: int, capacity: int):
    end = np.array([closing], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            rows, pieces, starts, ids = [], [], [], []
            size = 0

            def out() -> pa.RecordBatch:
                kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:-1]]
                lengths = [len(x) // 4 for x in ids]
                columns = [pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())]
                return pa.RecordBatch.from_arrays([*kept, *columns], [*batch.schema.names[:-1], "piece", "start", "length", "ids"])

            # Text by text, and out by small batches: an executor has little room beside its heap.
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                all_ids = encoder.encode(text.as_py()) + end
                for n, at in enumerate(range(0, len(all_ids), step)):
                    rows.append(i)
                    pieces.append(n)
                    starts.append(at // 4)
                    ids.append(all_ids[at : at + step])
                size += len(all_ids)
                if size > OUT_BYTES:
                    yield out()
                    rows, pieces, starts, ids, size = [], [], [], [], 0
            if rows:
                yield out()
        encoder.forget()

    return cut


def pieces(docs: DataFrame, path: str, keep: list[str], closing: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """The kept columns, ``piece``, ``start``, ``length`` and ``ids`` (little-endian, 4 bytes each), a row per piece."""
    rows = docs.select(*[f"`{c}`" for c in keep], F.col("text").alias("_text"))
    schema = rows.drop("_text").schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids", "binary")
    return rows.mapInArrow(_cutter(path, closing, capacity), schema)


def fullest(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(how often, [(length, times)]) for each combination, in the order in which bins are filled.

    Every bin takes the largest piece that is left and, with it, the
    combination whose sum comes closest to the capacity.
    """
    left = dict(sorted(((n, c) for n, c in counts.items() if c > 0), reverse=True))
    bins = []
    while left:
        largest = next(iter(left))
        room = capacity - largest
        mask = (1 << (room + 1)) - 1
        # reach[k]: bits of the sums within reach before the k-th item.
        items, reach, bits = [], [], 1
        for n, c in left.items():
            if n > room or bits >> room & 1:
                continue
            c -= n == largest
            # 1, 2, 4 .. copies at a time reach every number of copies.
            unit, rest = 1, min(c, room // n)
            while rest > 0 and not bits >> room & 1:
                unit = min(unit, rest)
                items.append((n, unit))
                reach.append(bits)
                bits |= (bits << (n * unit)) & mask
                rest -= unit
                unit *= 2
        used = {largest: 1}
        at = bits.bit_length() - 1
        for (n, unit), before in zip(reversed(items), reversed(reach)):
            if not before >> at & 1:
                used[n] = used.get(n, 0) + unit
                at -= n * unit
        often = min(left[n] // k for n, k in used.items())
        bins.append((often, sorted(used.items(), reverse=True)))
        for n, k in used.items():
            left[n] -= often * k
            if not left[n]:
                del left[n]
    return bins


def _places(bins: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end, times in a bin, first sequence, offset): where each number of a length goes."""
    rows, number, sequence = [], {}, 0
    for often, used in bins:
        offset = 0
        for n, k in used:
            first = number.get(n, 0)
            rows.append((n, first, first + often * k, k, sequence, offset))
            number[n] = first + often * k
            offset += n * k
        sequence += often
    return rows


def _locator(rows: list[tuple[int, int, int, int, int, int]]):
    table = np.array(sorted(rows), np.int64).reshape(-1, 6)
    spans = {int(n): table[table[:, 0] == n] for n in np.unique(table[:, 0])}

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            number = batch.column(names.index("_number")).to_numpy(zero_copy_only=False)
            sequence, offset = np.empty_like(length), np.empty_like(length)
            for n in np.unique(length):
                mine, span = length == n, spans[int(n)]
                found = span[np.searchsorted(span[:, 1], number[mine], side="right") - 1]
                nth = number[mine] - found[:, 1]
                sequence[mine] = found[:, 4] + nth // found[:, 3]
                offset[mine] = found[:, 5] + nth % found[:, 3] * n
            kept = [c for c, name in zip(batch.columns, names) if name != "_number"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                [*[x for x in names if x != "_number"], "sequence_id", "offset"],
            )

    return locate


def place(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to the capacity.

    ``rows`` is written once, and dealt by (length, bucket) to be numbered:
    pass narrow rows where the rest isn't needed.
    """
    kept = pinned(rows.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in kept.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    numbered = running_offsets(kept, ["length"], F.xxhash64("_row"), ["_row"], {"_number": F.lit(1)}, 5_000).drop("_row")
    schema = numbered.drop("_number").schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(_locator(_places(fullest(counts, capacity))), schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from placed rows that kept their ``ids``."""
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda all_ids, p: F.concat(all_ids, p["ids"]))
    return parts.select("sequence_id", joined.alias("ids"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


