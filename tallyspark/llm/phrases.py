"""Phrases whose words stand together more often than their parts would: n-grams counted in quotient filters.

Words become numbers: tasks number the words that they meet, each in a lexicon of
its own, and write chunks of text with these numbers. The lexicons are dealt out
by the words' hashes; where all entries of a word meet, it is counted and, if
frequent, gets one number for all chunks, the smaller the more frequent it is, so
that numbers compress. Chunks are then written with those. Runs
of frequent words hold all phrases that can be frequent, so n-grams are counted
level by level from two words up, the longer ones only where both shorter ones
in them are frequent (by a bitmap of fixed size: a false hit costs a count, and
nothing is lost).

An n-gram is its packed word numbers, 32 bits each. An invertible permutation
makes them evenly spread; the first bits of the result are the quotient, and
the rest is kept in full as the remainder, so that no two n-grams are taken for
one another. A filter holds, quotient by quotient, how many remainders there
are, then the remainders in order and their counts, in one byte each unless
they are larger. Tasks fill filters, cut them by ranges of quotients, and the
pieces of a range are merged in order; a phrase in every document is one counter
of each filter. Only what comes back out of the merged filters is permuted back.

Case is lowered from A to Z. Texts are cut at ``. , ; : ! ?`` and line breaks,
and words at blanks and tabs; no phrase crosses a cut.

Nulls: a null text is an empty one; a null language is ``und``. Counts are per
language. Equal scores rank by count, then by the phrase's bytes. Repeated rows
count each. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import pinned, released
from tallyspark.llm.shipped import in_bitmap, open_shipped, ship_bitmap


@dataclass(frozen=True)
class Shape:
    longest: int = 5  # words of a phrase
    least: int = 100  # times that a phrase must stand somewhere
    best: int = 2_000  # phrases of a language that are reported
    chunk: int = 1 << 20  # words that are written together
    lexicon: int = 1 << 18  # words that a task numbers before it begins anew
    bucket: int = 1 << 18  # entries of lexicons that are counted together
    shard: int = 1 << 22  # words that are counted in one filter
    merged: int = 1 << 21  # words for each range of quotients
    bitmap: int = 26  # bits of a place in the bitmap
    slots: int = 10  # bits of a quotient within its range


# ---- words to numbers ----

_UPPER, _CUTS = bytes(range(65, 91)), b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_UPPER + _CUTS + b"\t", bytes(range(97, 123)) + b"\n" * len(_CUTS) + b" ")


def _slices(text: str, size: int) -> Iterator[bytes]:
    """The text with its words apart by blanks and a line break at each cut, in parts that end at a cut."""
    raw = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    at = 0
    while at < len(raw):
        end = raw.find(b"\n", at + size)
        end = len(raw) if end < 0 else end
        yield raw[at:end].replace(b"\n", b" \n ")
        at = end


class _Numbers(dict):
    """Words numbered as they come; the break between pieces is 0, no word at all is 1."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, compressed byte by byte: most high ones are 0."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(4, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _loosened(data: pa.Buffer) -> np.ndarray:
    n = int.from_bytes(data[:4].to_pybytes(), "little")
    planes = np.frombuffer(pa.decompress(data[4:], 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(n)


class _Lexicon:
    """The numbers of a language's words, their counts, and the texts that wait to be written."""

    def __init__(self, name: int) -> None:
        self.name, self.numbers, self.texts, self.counts = name, _Numbers(), [], np.zeros(2, np.int64)

    def written(self) -> bytes:
        codes = np.concatenate(self.texts)
        counts = np.bincount(codes, minlength=len(self.numbers))
        counts[: len(self.counts)] += self.counts
        self.counts, self.texts = counts, []
        return _squeezed(codes)


def _chunks(shape: Shape):
    """Rows of codes, and a row of each lexicon."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, _Lexicon] = {}
        size, made = 0, 0

        def row(lexicon, lang=None, total=None, size=None, words=None, counts=None, codes=None) -> pa.RecordBatch:
            values = [lexicon, lang, total, size, words, counts, codes]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["lexicon", "lang", "total", "size", "words", "counts", "codes"])

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            for lexicon in known.values():
                if lexicon.texts:
                    yield row(lexicon.name, codes=lexicon.written())
            if last or sum(len(x.numbers) for x in known.values()) >= shape.lexicon or any(x.counts.sum() >> 31 for x in known.values()):
                for lang, x in known.items():
                    counts = x.counts[2:]
                    yield row(x.name, lang, int(counts.sum()), len(counts), b"\n".join(list(x.numbers)[2:]), _squeezed(counts))
                known.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in _slices(text or "", 1 << 20):
                    if lang not in known:
                        known[lang] = _Lexicon(TaskContext.get().partitionId() << 32 | made)
                        made += 1
                    lexicon, found = known[lang], part.split(b" ")
                    codes = np.fromiter(map(lexicon.numbers.__getitem__, found), np.int64, len(found))
                    lexicon.texts += [codes[codes != 1], np.zeros(1, np.int64)]
                    size += len(found)
                    if size >= shape.chunk:
                        yield from flush(False)
                        size = 0
        yield from flush(True)

    return chunks


_CHUNK = "lexicon long, lang string, total long, size long, words binary, counts binary, codes binary"


def _dealt(bits: int):
    """The entries of lexicons by the first bits of the words' hashes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lexicon, lang, joined, counted in zip(*(batch.column(i) for i in range(4))):
                words, counts = joined.as_py().split(b"\n"), _loosened(counted.as_buffer())
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(words), np.int64)
                order = np.argsort(bucket, kind="stable")
                used, first = np.unique(bucket[order], return_index=True)
                parts = np.split(order, first[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int64()), pa.array([lexicon.as_py()] * len(used), pa.int64()), pa.array([lang.as_py()] * len(used), pa.string()),
                        pa.array([b"\n".join([words[i] for i in p.tolist()]) for p in parts], pa.binary()),
                        pa.array([_squeezed(counts[p]) for p in parts], pa.binary()), pa.array([_squeezed(p + 2) for p in parts], pa.binary()),
                    ],
                    ["bucket", "lexicon", "lang", "words", "counts", "places"],
                )

    return deal


_NUMBERED = "lexicon long, places binary, ids binary, id array<long>, lang array<string>, word array<binary>, f array<long>"


def _numbers(least: int, bits: int):
    """The numbers of a bucket's frequent words: by lexicon, and in one row (without a lexicon) the words."""

    def number(rows: pa.Table) -> pa.Table:
        parts = [w.as_py().split(b"\n") for w in rows.column("words")]
        words = pa.array([w for p in parts for w in p], pa.binary()).dictionary_encode()
        langs = pa.array(rows.column("lang").to_pylist(), pa.string()).dictionary_encode()
        of = np.repeat(langs.indices.to_numpy().astype(np.int64), [len(p) for p in parts])
        known, entry = np.unique(of * len(words.dictionary) + words.indices.to_numpy(), return_inverse=True)
        f = np.zeros(len(known), np.int64)
        np.add.at(f, entry, np.concatenate([_loosened(c.as_buffer()) for c in rows.column("counts")]).astype(np.int64))
        often = np.flatnonzero(f >= least)
        often = often[np.argsort(-f[often], kind="stable")]
        if len(often) << bits >= 1 << 32:
            raise ValueError("more frequent words than 32 bits can number")
        ids = np.zeros(len(known), np.int64)
        ids[often] = (np.arange(len(often)) << bits) + rows.column("bucket")[0].as_py() + 1
        each = np.split(ids[entry], np.cumsum([len(p) for p in parts])[:-1])
        places = [_loosened(p.as_buffer())[e != 0] for p, e in zip(rows.column("places"), each)]
        lang, word = (x.dictionary.take(pa.array(i)) for x, i in zip((langs, words), np.divmod(known[often], len(words.dictionary))))
        none, n = [None] * len(parts), len(parts)
        return pa.table(
            {
                "lexicon": pa.array([*rows.column("lexicon").to_pylist(), None], pa.int64()),
                "places": pa.array([*map(_squeezed, places), None], pa.binary()),
                "ids": pa.array([*(_squeezed(e[e != 0]) for e in each), None], pa.binary()),
                "id": pa.array([*none, ids[often]], pa.list_(pa.int64())),
                "lang": pa.array([*none, lang.to_pylist()], pa.list_(pa.string())),
                "word": pa.array([*none, word.to_pylist()], pa.list_(pa.binary())),
                "f": pa.array([*none, f[often]], pa.list_(pa.int64())),
            }
        )

    return number


def _renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for codes, known in zip(batch.column(0), batch.column(1)):
            old = _loosened(codes.as_buffer())
            pieces = [[_loosened(x.as_buffer()) for x in known.values.field(n)] for n in ("places", "ids")] if known.is_valid else [[], []]
            most = max([int(x.max(initial=0)) for x in [old, *pieces[0]]])
            table = np.zeros(most + 1, "<u4")
            for places, ids in zip(*pieces):
                table[places] = ids
            ids = table[old]  # a word that isn't frequent is 0, as a break is
            stays = ids != 0
            stays[1:] |= ids[:-1] != 0  # one break after each run
            out.append(_squeezed(ids[stays]))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])


# ---- quotient filters ----

_C1, _C2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
_I1, _I2 = (np.uint64(pow(c, -1, 1 << 64)) for c in (_C1, _C2))
_C1, _C2 = np.uint64(_C1), np.uint64(_C2)
_ROUNDS = 2


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _C1
    x = (x ^ x >> np.uint64(32)) * _C2
    return x ^ x >> np.uint64(32)


def _gathered(x: np.ndarray) -> np.ndarray:
    """The inverse of ``_spread``."""
    x = (x ^ x >> np.uint64(32)) * _I2
    x = (x ^ x >> np.uint64(32)) * _I1
    return x ^ x >> np.uint64(32)


def permuted(lanes: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The packed numbers, 64 bits a lane, under a permutation in which every lane moves the first."""
    out = list(lanes)
    for _ in range(_ROUNDS):
        for i in range(len(out)):
            out[i] = _spread(out[i] ^ _C1 * out[i - 1] if len(out) > 1 else out[i])
    return out


def restored(lanes: Sequence[np.ndarray]) -> list[np.ndarray]:
    out = list(lanes)
    for _ in range(_ROUNDS):
        for i in reversed(range(len(out))):
            out[i] = _gathered(out[i])
            if len(out) > 1:
                out[i] = out[i] ^ _C1 * out[i - 1]
    return out


def packed(ids: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """The n numbers from each place on, two to a lane."""
    words = [ids[at + i].astype(np.uint64) for i in range(n)] + [np.zeros(len(at), np.uint64)] * (n % 2)
    return [words[i] << np.uint64(32) | words[i + 1] for i in range(0, len(words), 2)]


def unpacked(lanes: Sequence[np.ndarray], n: int) -> np.ndarray:
    words = [part for lane in lanes for part in (lane >> np.uint64(32), lane & np.uint64(0xFFFFFFFF))]
    return np.column_stack(words[:n]).astype(np.int64)


def counted(lanes: Sequence[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Each key once, in order, and the sum of its counts."""
    if len(lanes) == 1 and counts is None:
        lanes = [np.sort(lanes[0])]
    else:
        order = np.lexsort(lanes[::-1]) if len(lanes) > 1 else np.argsort(lanes[0], kind="stable")
        lanes, counts = [x[order] for x in lanes], None if counts is None else counts[order]
    new = np.ones(len(lanes[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in lanes])
    first = np.flatnonzero(new)
    sums = np.diff(np.append(first, len(new))) if counts is None else np.add.reduceat(counts, first) if len(first) else counts
    return [x[first] for x in lanes], sums


class Filters:
    """Filters of one range of quotients as bytes: sizes, remainders and counts."""

    def __init__(self, lanes: int, range_bits: int, slots: int) -> None:
        self.lanes, self.low, self.slots = lanes, 64 - range_bits - slots, slots
        self.width = -(-self.low // 8)

    def dump(self, lanes: Sequence[np.ndarray], counts: np.ndarray) -> bytes:
        first = lanes[0]
        quotient = (first >> np.uint64(self.low) & np.uint64((1 << self.slots) - 1)).astype(np.int64)
        sizes = np.bincount(quotient, minlength=1 << self.slots).astype("<u4")
        remainder = (first & np.uint64((1 << self.low) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : self.width]
        large = counts >= 255
        parts = [sizes, np.ascontiguousarray(remainder), *(x.astype("<u8") for x in lanes[1:]), np.where(large, 255, counts).astype(np.uint8), counts[large].astype("<u8")]
        return b"".join(p.tobytes() for p in parts)

    def load(self, data: pa.Buffer, number: int) -> tuple[list[np.ndarray], np.ndarray]:
        raw, head = np.frombuffer(data, np.uint8), 4 << self.slots
        sizes = raw[:head].view("<u4").astype(np.int64)
        n, at = int(sizes.sum()), head
        low = np.zeros((n, 8), np.uint8)
        low[:, : self.width] = raw[at : at + n * self.width].reshape(n, self.width)
        at += n * self.width
        base = np.uint64(number) << np.uint64(self.slots)
        quotient = np.repeat(np.arange(1 << self.slots, dtype=np.uint64) + base, sizes)
        lanes = [quotient << np.uint64(self.low) | low.view("<u8").reshape(n)]
        for _ in range(1, self.lanes):
            lanes.append(np.frombuffer(raw[at : at + 8 * n].tobytes(), "<u8"))
            at += 8 * n
        counts = raw[at : at + n].astype(np.int64)
        counts[counts == 255] = np.frombuffer(raw[at + n :].tobytes(), "<u8")
        return lanes, counts


def _held(bitmap: np.ndarray, first: np.ndarray, bits: int) -> np.ndarray:
    return in_bitmap(bitmap, first >> np.uint64(64 - bits))


def _fills(n: int, range_bits: int, shape: Shape, shorter: str | None):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = open_shipped(shorter)["bitmap"] if shorter else None
        filters, waiting, size = Filters(-(-n // 2), range_bits, shape.slots), [], 0

        def keys(ids: np.ndarray) -> list[np.ndarray]:
            whole = ids != 0
            run = whole.copy()  # so many words from here on are there
            for i in range(1, n - 1 if bitmap is not None else n):
                run[: len(run) - i] &= whole[i:]
                run[len(run) - i :] = False
            at = np.flatnonzero(run)
            if bitmap is not None:
                known = np.zeros(len(ids) + 1, bool)
                known[at[_held(bitmap, permuted(packed(ids, at, n - 1))[0], shape.bitmap)]] = True
                at = np.flatnonzero(known[:-1] & known[1:])
            return permuted(packed(ids, at, n))

        def flush() -> pa.RecordBatch:
            lanes, counts = counted([np.concatenate(x) for x in zip(*waiting)])
            numbers = (lanes[0] >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(counts), np.int64)
            used = np.unique(numbers)
            cuts = np.append(np.searchsorted(numbers, used), len(numbers)).tolist()
            data = [filters.dump([x[s:e] for x in lanes], counts[s:e]) for s, e in zip(cuts, cuts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(data, pa.binary())], ["range", "filter"])

        for batch in batches:
            for row in batch.column(0):
                ids = _loosened(row.as_buffer())
                if len(ids) >= n:
                    waiting.append(keys(ids))
                    size += len(waiting[-1][0])
                if size >= shape.shard:
                    yield flush()
                    waiting, size = [], 0
        if size:
            yield flush()

    return fill


def _merges(n: int, range_bits: int, shape: Shape):
    def merge(rows: pa.Table) -> pa.Table:
        filters = Filters(-(-n // 2), range_bits, shape.slots)
        found = [filters.load(f.as_buffer(), r.as_py()) for r, f in zip(rows.column("range"), rows.column("filter"))]
        lanes, counts = counted([np.concatenate(x) for x in zip(*(f[0] for f in found))], np.concatenate([f[1] for f in found]))
        often = counts >= shape.least
        lanes, counts = [x[often] for x in lanes], counts[often]
        ids = unpacked(restored(lanes), n)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(ids) + 1) * n, n), pa.int32()), pa.array(ids.reshape(-1)))
        place = (lanes[0] >> np.uint64(64 - shape.bitmap)).astype(np.int64)
        return pa.table({"ids": lists, "f": pa.array(counts, pa.int64()), "place": pa.array(place)})

    return merge


# ---- phrases ----


def frequent(docs: DataFrame, shape: Shape = Shape()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, lang, word, f) of the frequent words, (ids, f) of the frequent phrases from two words on, and (lang, n)."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    chunks = pinned(docs.select(lang.alias("lang"), "text").mapInArrow(_chunks(shape), _CHUNK), "phrase-chunks")
    lexicons = chunks.where("size > 0")
    totals = pinned(lexicons.groupBy("lang").agg(F.sum("total").alias("n")), "totals")
    total, entries = lexicons.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    bits = (entries // shape.bucket).bit_length()
    dealt = lexicons.select("lexicon", "lang", "words", "counts").mapInArrow(_dealt(bits), "bucket long, lexicon long, lang string, words binary, counts binary, places binary")
    numbered = pinned(dealt.groupBy("bucket").applyInArrow(_numbers(shape.least, bits), _NUMBERED), "numbered-words")
    each = numbered.where("lexicon IS NULL").select(F.explode(F.arrays_zip("id", "lang", "word", "f")).alias("w"))
    words = pinned(each.select("w.id", "w.lang", "w.word", "w.f"), "frequent-words")
    known = numbered.where("lexicon IS NOT NULL").groupBy("lexicon").agg(F.collect_list(F.struct("places", "ids")).alias("known"))
    rows = chunks.where("codes IS NOT NULL").select("lexicon", "codes").join(known, "lexicon", "left").select("codes", "known")
    texts = pinned(rows.mapInArrow(_renumber, "ids binary"), "numbered-texts")
    released(chunks, numbered)
    range_bits = max(0, (int(total) // shape.merged).bit_length())
    phrases, shorter = None, None
    for n in range(2, shape.longest + 1):
        pieces = texts.mapInArrow(_fills(n, range_bits, shape, shorter), "range long, filter binary")
        merged = pieces.groupBy("range").applyInArrow(_merges(n, range_bits, shape), "ids array<long>, f long, place long")
        found = pinned(merged, f"phrases-{n}")
        phrases = found if phrases is None else phrases.union(found)
        shorter = ship_bitmap(found, shape.bitmap)
        if not shorter:
            break
    released(texts)
    return words, phrases.drop("place"), totals


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (l * r)); the products have up to 38 digits."""
    whole = F.lit(1000).cast("decimal(4,0)") * a.cast("decimal(14,0)") * n.cast("decimal(16,0)")
    parts = left.cast("decimal(16,0)") * right.cast("decimal(16,0)")
    return F.call_function("div", whole, parts)


def collocations(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    A phrase that stands ``least`` times or more is scored at each of its cuts
    in two; the lowest score counts. Phrases that never stand without a longer
    frequent one are left out.
    """
    words, phrases, totals = frequent(docs, shape)
    single = words.select(F.array("id").alias("ids"), "f")
    every = pinned(single.union(phrases), "counted-phrases")
    size = F.size("ids")
    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("ids", i, n)))))
    covers = every.where(size > 2).select(inner.alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longer"))
    kept = every.where(size > 1).join(covers, "ids", "left").where("longer IS NULL OR 100 * longer < 100 * f").select("ids", F.col("f").alias("a"))
    # Words by number, back to texts.
    spelt = kept.select("ids", "a", F.posexplode("ids").alias("place", "id")).join(words.select("id", "lang", "word"), "id")
    texts = spelt.groupBy("ids", "a").agg(F.min("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    phrase = F.array_join(F.transform("words", lambda w: w["word"].cast("string")), " ")
    texts = texts.select("ids", "a", "lang", phrase.alias("phrase")).join(totals, "lang")
    cuts = texts.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).withColumns({"left": F.slice("ids", F.lit(1), F.col("k")), "right": F.slice("ids", F.col("k") + 1, size)})
    cuts = cuts.join(every.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left").join(every.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
    least = F.min(F.struct(_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("ids", "lang", "phrase", "a", "n").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= shape.best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
