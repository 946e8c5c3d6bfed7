"""Alignment of two tokenizers' tokens, with counts of the pairs that they link.

Both tokenizers cut the same bytes. Where tokens of both end at one byte the
text is cut into groups; a token of one is linked with a token of the other
where their bytes overlap. How often each pair of ids is linked in the whole
corpus is counted without a table of strings: the distinct pairs are dealt over
buckets by a hash, each bucket gets a minimal perfect hash (levels of bits; a
key stands in the first level in which no other key of the level falls on its
bit, and the rank of the bit is its number), and the pair's own key is kept
under its number to verify look-ups. Tasks count into dense vectors indexed by
these numbers, vectors are summed in a tree, and a second pass aligns the
documents again and looks the counts up.

Texts are encoded once; ids of two bytes each are kept for the passes. Tables go
out in parts of at most ``part_keys`` pairs; where there are more, documents are
aligned once for each part and their sums are added. (Pairs are bounded by the
product of both vocabularies, not by the corpus.)

Texts that are null or empty, or whose tokens of either side don't make up the
bytes of a blank and the text, have no tokens: counts are 0 and the groups an
empty text. Equal counts of a token's pairs are all the highest. Repeated rows
count each. An empty table gives an empty result. Columns to keep are named;
those named like new ones give way.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tallyspark.llm.common import pinned
from tallyspark.llm.lexicon import WORDS, Merger
from tallyspark.llm.shipped import open_shipped, ship

_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@dataclass(frozen=True)
class Settings:
    bucket: int = 20_000  # pairs that get a minimal perfect hash of their own
    part_keys: int = 1 << 23  # pairs whose tables are sent out at a time
    gamma: float = 1.5  # bits of a level for each of its keys
    block: int = 1 << 14  # counts in a row of a dense vector
    fan_in: int = 32  # vectors that are summed at a time
    batch: int = 1 << 18  # bytes of ids that are aligned at a time


# ---- tokens ----


class ByteSide:
    """Ids of a blank and the text by a byte-level vocabulary; names of special tokens are plain text."""

    def __init__(self, path: str) -> None:
        self.merger = Merger(path, names_as_text=True)
        self.tokens = self.merger.token_bytes()
        self.kind = _kind(len(self.tokens))
        self.ranked = self._ranked()
        # With a token for each byte nothing can get lost.
        self.lossless = {bytes([b]) for b in range(256)} <= set(self.tokens)

    def _ranked(self):
        """A faster encoder of the same merges, if the vocabulary numbers its tokens in the order of their merges."""
        import tiktoken

        merges = json.loads(self.merger.tokenizer.to_str())["model"]["merges"]
        number = self.merger.tokenizer.get_vocab(with_added_tokens=False)
        made = [number["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
        if made != list(range(256, 256 + len(merges))) or len(number) != 256 + len(merges):
            return None
        ranks = {self.tokens[i]: i for i in number.values()}
        return tiktoken.Encoding("ranked", pat_str=WORDS.pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        text = f" {text}"
        if self.ranked is None or not self.merger.plain(text):
            return np.array(self.merger.whole(text), self.kind)
        return self.ranked.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(self.kind)


class PieceSide:
    """Ids of the text by a sentence-piece vocabulary, which puts a blank before it."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.tokens = [
            bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.kind = _kind(len(pieces))
        self.lossless = False  # the text may be normalised

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), self.kind)


def _kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _side(path: str) -> ByteSide | PieceSide:
    return PieceSide(path) if path.endswith(".model") else ByteSide(path)


def _kept(side: ByteSide | PieceSide, ids: np.ndarray, text: str) -> bool:
    """Whether the tokens' bytes are those of a blank and the text."""
    return side.lossless or b"".join(map(side.tokens.__getitem__, ids.tolist())) == f" {text}".encode()


def _tokenizes(path_a: str, path_b: str):
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _side(path_a), _side(path_b)
        for batch in batches:
            found_a, found_b = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                x = y = b""
                if text:
                    x, y = a.ids(text), b.ids(text)
                    x, y = (x.tobytes(), y.tobytes()) if _kept(a, x, text) and _kept(b, y, text) else (b"", b"")
                found_a.append(x)
                found_b.append(y)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found_a, pa.binary()), pa.array(found_b, pa.binary())],
                [*batch.schema.names[:-1], "_a", "_b"],
            )

    return tokenize


@dataclass(frozen=True)
class Sizes:
    """Bytes of each id, and how ids are kept, on either side."""

    bytes: tuple[np.ndarray, np.ndarray]
    kinds: tuple[str, str]

    @classmethod
    def of(cls, path_a: str, path_b: str) -> Sizes:
        a, b = _side(path_a), _side(path_b)
        return cls(tuple(np.array([len(t) for t in s.tokens], np.int32) for s in (a, b)), (a.kind, b.kind))


class Aligner:
    """Groups and links of many documents' tokens in a row."""

    def __init__(self, sizes: Sizes) -> None:
        self.sizes, self.kinds = sizes.bytes, sizes.kinds

    def links(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(token of a, token of b) of every link, by place, and the places after each group in a and in b.

        The bytes of one document's tokens follow those of the document before,
        on both sides, so no link and no group crosses documents.
        """
        size_a, size_b = self.sizes[0][a], self.sizes[1][b]
        end_a, end_b = np.cumsum(size_a, dtype=np.int64), np.cumsum(size_b, dtype=np.int64)
        at = np.repeat(np.arange(len(b), dtype=np.int32), size_b)  # the token of b in which a byte stands
        first, last = at[end_a - size_a], at[end_a - 1]
        count = last - first + 1
        before = np.cumsum(count) - count
        of_a = np.repeat(np.arange(len(a)), count)
        of_b = np.arange(len(of_a)) + np.repeat(first - before, count)
        shared = end_b[last] == end_a
        return of_a, of_b, np.flatnonzero(shared) + 1, last[shared].astype(np.int64) + 1

    def batches(self, batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, row after the last, ids of a, ids of b, places after each row in a, in b), some rows at a time."""
        at = [batch.schema.names.index(n) for n in ("_a", "_b")]
        sides = [batch.column(i).to_pylist() for i in at]
        begin, size = 0, 0
        for i in range(len(sides[0])):
            size += len(sides[0][i])
            if size >= limit or i == len(sides[0]) - 1:
                rows = [s[begin : i + 1] for s in sides]
                ids = [np.frombuffer(b"".join(r), kind).astype(np.int64) for r, kind in zip(rows, self.kinds)]
                ends = [np.cumsum([len(x) // np.dtype(kind).itemsize for x in r]) for r, kind in zip(rows, self.kinds)]
                yield begin, i + 1, *ids, *ends
                begin, size = i + 1, 0


def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)


# ---- minimal perfect hashes ----


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(29)


def perfect(keys: np.ndarray, gamma: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, all bits as bytes, keys by number) of a minimal perfect hash of distinct keys."""
    sizes, bits, order, left = [], [], [], keys
    while len(left):
        size = max(64, -(-int(len(left) * gamma) // 64) * 64)
        place = (_mixed(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        first = alone[place]
        order.append(left[first][np.argsort(place[first])])
        sizes.append(size)
        bits.append(np.packbits(alone, bitorder="little"))
        left = left[~first]
    return sizes, np.concatenate([np.empty(0, np.uint8), *bits]), np.concatenate([np.empty(0, np.uint64), *order])


class PairTable:
    """Numbers of pairs by the buckets' hashes, verified by the pairs that are kept under them."""

    def __init__(self, tables: dict[str, np.ndarray]) -> None:
        self.buckets, self.levels = int(tables["shape"][0]), int(tables["shape"][1])
        self.sizes, self.at = (tables[n].reshape(self.levels, -1) for n in ("sizes", "at"))
        self.bits, self.ranks, self.keys = tables["bits"], tables["ranks"], tables["keys"]

    @staticmethod
    def arrays(rows: Sequence[tuple[int, list[int], bytes, bytes]], buckets: int) -> dict[str, np.ndarray]:
        """The tables of (bucket, bits of each level, bits, keys by number), to be shipped."""
        levels = max([1, *(len(r[1]) for r in rows)])
        sizes, at = np.zeros((levels, buckets), np.int64), np.zeros((levels, buckets), np.int64)
        place = 0
        for bucket, own, _, _ in rows:
            for level, size in enumerate(own):
                sizes[level, bucket], at[level, bucket] = size, place
                place += size
        bits = np.frombuffer(b"".join(r[2] for r in rows), np.uint64)
        ranks = np.cumsum(np.bitwise_count(bits), dtype=np.int64) - np.bitwise_count(bits)
        keys = np.frombuffer(b"".join(r[3] for r in rows), np.uint64)
        return {"shape": np.array([buckets, levels]), "sizes": sizes.reshape(-1), "at": at.reshape(-1), "bits": bits, "ranks": ranks, "keys": keys}

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for those that the table lacks."""
        out = np.full(len(keys), -1, np.int64)
        bucket = bucket_of(keys, self.buckets)
        live = np.arange(len(keys))
        for level in range(self.levels):
            size = self.sizes[level, bucket[live]]
            live, size = live[size > 0], size[size > 0].astype(np.uint64)
            if not len(live):
                break
            place = (_mixed(keys[live], level + 1) % size).astype(np.int64) + self.at[level, bucket[live]]
            word, bit = self.bits[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[live[hit]] = self.ranks[place[hit] >> 6] + below
            live = live[~hit]
        found = np.flatnonzero(out >= 0)
        out[found[self.keys[out[found]] != keys[found]]] = -1
        return out


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_mixed(keys, 0) % np.uint64(buckets)).astype(np.int64)


# ---- passes ----


def _pairs(sizes: Sizes, settings: Settings):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, seen, waiting, size = Aligner(sizes), np.empty(0, np.uint64), [], 0

        def rows(keys: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])

        for batch in batches:
            for _, _, a, b, _, _ in aligner.batches(batch, settings.batch):
                of_a, of_b, _, _ = aligner.links(a, b)
                waiting.append(np.unique(_keys(a[of_a], b[of_b])))
                size += len(waiting[-1])
                if size > 1 << 21:
                    seen, waiting, size = np.unique(np.concatenate([seen, *waiting])), [], 0
                    if len(seen) > 1 << 22:
                        yield rows(seen)
                        seen = seen[:0]
        yield rows(np.unique(np.concatenate([seen, *waiting])))

    return pairs


def _builds(gamma: float):
    def build(rows: pa.Table) -> pa.Table:
        keys = rows.column("key").to_numpy().view(np.uint64)
        sizes, bits, order = perfect(np.sort(keys), gamma)
        return pa.table(
            {"bucket": rows.column("bucket").slice(0, 1), "sizes": [np.array(sizes, np.int64).tobytes()], "bits": [bits.tobytes()], "keys": [order.tobytes()]},
            pa.schema([("bucket", pa.int32()), ("sizes", pa.binary()), ("bits", pa.binary()), ("keys", pa.binary())]),
        )

    return build


def _buckets(buckets: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = bucket_of(batch.column(0).to_numpy().view(np.uint64), buckets).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), batch.column(0)], ["bucket", "key"])

    return deal


def _counts(sizes: Sizes, table: str, settings: Settings):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, pairs = Aligner(sizes), PairTable(open_shipped(table))
        dense = np.zeros(-(-len(pairs.keys) // settings.block) * settings.block, np.int64)
        for batch in batches:
            for _, _, a, b, _, _ in aligner.batches(batch, settings.batch):
                of_a, of_b, _, _ = aligner.links(a, b)
                keys, n = np.unique(_keys(a[of_a], b[of_b]), return_counts=True)
                number = pairs.numbers(keys)
                dense[number[number >= 0]] += n[number >= 0]
        blocks = dense.reshape(-1, settings.block)
        used = np.flatnonzero(blocks.any(axis=1))
        shard = TaskContext.get().partitionId()
        for some in np.array_split(used, max(1, len(used) // 64)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array(np.full(len(some), shard), pa.int64()), pa.array([blocks[i].tobytes() for i in some], pa.binary())],
                ["block", "shard", "counts"],
            )

    return count


def _sums(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_buffer(), np.int64) for c in rows.column("counts"))
    return pa.table(
        {"block": rows.column("block").slice(0, 1), "shard": rows.column("shard").slice(0, 1), "counts": [total.tobytes()]},
        pa.schema([("block", pa.int64()), ("shard", pa.int64()), ("counts", pa.binary())]),
    )


_VECTORS = "block long, shard long, counts binary"


def _tree_sum(vectors: DataFrame, fan_in: int) -> DataFrame:
    """One vector of each block, ``fan_in`` of them summed at a time."""
    vectors = pinned(vectors, "pair-counts")
    most = vectors.agg(F.max("shard")).first()[0] or 0
    while most:
        vectors = vectors.withColumn("shard", F.floor(F.col("shard") / fan_in)).groupBy("block", "shard").applyInArrow(_sums, _VECTORS)
        most //= fan_in
    return vectors


@dataclass(frozen=True)
class Part:
    """Names of what was sent out: pairs, and their counts with the highest count of each id of b."""

    pairs: str
    counts: str


def pair_tables(tokens: DataFrame, sizes: Sizes, settings: Settings = Settings()) -> list[Part]:
    """Count the linked pairs of all documents (``_a``, ``_b``); the tables, by parts."""
    spark = tokens.sparkSession
    sides = tokens.select("_a", "_b")
    distinct = pinned(sides.mapInArrow(_pairs(sizes, settings), "key long").distinct(), "pairs")
    buckets = max(1, -(-distinct.count() // settings.bucket))
    each = distinct.mapInArrow(_buckets(buckets), "bucket int, key long").groupBy("bucket")
    hashes = pinned(each.applyInArrow(_builds(settings.gamma), "bucket int, sizes binary, bits binary, keys binary"), "pair-hashes")
    width = max(1, settings.part_keys // settings.bucket)
    best, counted = np.zeros(0, np.int64), []
    for first in range(0, buckets, width):
        rows = hashes.where((F.col("bucket") >= first) & (F.col("bucket") < first + width)).orderBy("bucket").collect()
        arrays = PairTable.arrays([(r["bucket"], np.frombuffer(r["sizes"], np.int64).tolist(), r["bits"], r["keys"]) for r in rows], buckets)
        name = ship(spark, "pairs", arrays)
        vectors = _tree_sum(sides.mapInArrow(_counts(sizes, name, settings), _VECTORS), settings.fan_in)
        dense = np.zeros(-(-len(arrays["keys"]) // settings.block) * settings.block, np.int64)
        for r in vectors.collect():
            dense[r["block"] * settings.block : (r["block"] + 1) * settings.block] = np.frombuffer(r["counts"], np.int64)
        dense = dense[: len(arrays["keys"])]
        of_b = (arrays["keys"] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        size = max(len(best), int(of_b.max(initial=-1)) + 1)
        best = np.pad(best, (0, size - len(best)))
        np.maximum.at(best, of_b, dense)
        counted.append((name, dense))
    return [Part(name, ship(spark, "pair-counts", {"counts": dense, "best": best})) for name, dense in counted]


class Digits:
    """Decimal ids with the mark that follows them, as rows of bytes filled up with zeros."""

    def __init__(self, size: int) -> None:
        shown = np.array([f"{i}{mark}" for i in range(size) for mark in ",|;"], "S")
        self.bytes = shown.view(np.uint8).reshape(len(shown), shown.itemsize)
        self.lengths = np.count_nonzero(self.bytes, axis=1)

    def texts(
        self, a: np.ndarray, b: np.ndarray, after_a: np.ndarray, after_b: np.ndarray, ends: tuple[np.ndarray, np.ndarray]
    ) -> list[bytes]:
        """`a1,a2|b1;a3|b2` of each document; ``ends`` are the places after each document in a and b."""
        size_a, size_b = (np.diff(x, prepend=0) for x in (after_a, after_b))
        # Where each token stands among the tokens of both sides, group by group, and what follows it.
        begin = np.cumsum(size_a + size_b) - size_a - size_b
        place_a = np.arange(len(a)) + np.repeat(begin - (after_a - size_a), size_a)
        place_b = np.arange(len(b)) + np.repeat(begin + size_a - (after_b - size_b), size_b)
        both = np.empty(len(a) + len(b), np.int64)
        both[place_a], both[place_b] = a * 3, b * 3
        both[place_a[after_a - 1]] += 1
        both[place_b[after_b - 1]] += 2
        filled = self.bytes[both].reshape(-1)
        data = filled[filled != 0].tobytes()
        places = np.concatenate([[0], np.cumsum(self.lengths[both])])[ends[0] + ends[1]].tolist()
        return [data[s : max(s, e - 1)] for s, e in zip([0, *places], places)]


def _judges(sizes: Sizes, part: Part, first: bool, settings: Settings):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(sizes)
        pairs, counts = PairTable(open_shipped(part.pairs)), open_shipped(part.counts)
        digits = Digits(max(len(s) for s in aligner.sizes))
        for batch in batches:
            kept = [i for i, n in enumerate(batch.schema.names) if n not in ("_a", "_b")]
            for begin, end, a, b, end_a, end_b in aligner.batches(batch, settings.batch):
                of_a, of_b, after_a, after_b = aligner.links(a, b)
                keys, where = np.unique(_keys(a[of_a], b[of_b]), return_inverse=True)
                number = pairs.numbers(keys)
                count = np.where(number >= 0, counts["counts"][number], 0)[where] if len(keys) else np.empty(0, np.int64)
                most = (count > 0) & (count == counts["best"][b[of_b]]) if len(keys) else np.empty(0, bool)
                ends_of_links = np.searchsorted(of_a, end_a, "left")

                def per_row(x: np.ndarray) -> np.ndarray:
                    return np.diff(np.concatenate([[0], np.cumsum(x)])[ends_of_links], prepend=0)

                groups = np.searchsorted(after_a, end_a, "right")
                figures = [np.diff(end_a, prepend=0), np.diff(end_b, prepend=0), np.diff(groups, prepend=0), np.diff(ends_of_links, prepend=0)]
                texts = digits.texts(a, b, after_a, after_b, (end_a, end_b)) if first else [b""] * (end - begin)
                columns = [pa.array(x, pa.int64()) for x in (*figures, per_row(most), per_row(count))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(begin, end - begin) for i in kept), *columns, pa.array(texts, pa.binary()).cast(pa.string())],
                    [*(batch.schema.names[i] for i in kept), *_COUNTS, "groups"],
                )

    return judge


def aligned(docs: DataFrame, path_a: str, path_b: str, keep: Sequence[str], settings: Settings = Settings()) -> DataFrame:
    """The kept columns with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and
    ``groups`` (`a1,a2|b1;a3|b2,b3`: ids of a and b, group by group).

    ``count_sum`` adds up the corpus-wide counts of the links' pairs, ``n_best``
    counts the links whose pair has the highest count of its id of b.
    """
    names = [c for c in keep if c not in (*_COUNTS, "groups", "_a", "_b")]
    rows = docs.select(*[f"`{c}`" for c in names], F.monotonically_increasing_id().alias("_row"), F.col("text").alias("_text"))
    fields = rows.drop("_text").schema.fields
    tokens = pinned(rows.mapInArrow(_tokenizes(path_a, path_b), StructType([*fields, StructField("_a", BinaryType()), StructField("_b", BinaryType())])), "tokens")
    schema = StructType([*fields, *(StructField(n, LongType()) for n in _COUNTS), StructField("groups", StringType())])
    sizes = Sizes.of(path_a, path_b)
    found = [
        tokens.mapInArrow(_judges(sizes, part, i == 0, settings), schema) for i, part in enumerate(pair_tables(tokens, sizes, settings))
    ]
    if len(found) == 1:
        return found[0].drop("_row")
    # Figures of the links differ by part; what else there is stands in the first.
    more = found[1].select("_row", "n_best", "count_sum")
    for f in found[2:]:
        more = more.union(f.select("_row", "n_best", "count_sum"))
    more = more.groupBy("_row").agg(F.sum("n_best").alias("_best"), F.sum("count_sum").alias("_sum"))
    joined = found[0].join(more, "_row")
    joined = joined.withColumns({"n_best": F.col("n_best") + F.col("_best"), "count_sum": F.col("count_sum") + F.col("_sum")})
    return joined.select(*[f"`{c}`" for c in names], *_COUNTS, "groups")
