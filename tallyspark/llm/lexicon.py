"""Byte-level BPE through a lexicon of the corpus's frequent words.

The words are counted over all documents; the most frequent are merged once and
compiled into a minimal acyclic transducer: a deterministic automaton in which
equal suffixes share their states, and whose outputs add up along a word's path
to the word's number, under which its ids stand. The transducer is a file that
executors map into memory. A task walks all words of many texts through it at
once, a byte each step; a word that it lacks is merged by the vocabulary itself.
So ids do not depend on what the lexicon holds, only the time does.

A word here is what the byte-level split makes: letters, digits or marks with
the blank before them, or a run of white space. Texts with code points on which
versions of Unicode disagree, or with the name of a special token (which becomes
that token), are left to the tokenizer as a whole.

Counting bounds what it reports: a task puts forth the words that make up a
given share of its own words. A word with that share of the corpus has it in
some task, so it is reported, if perhaps not by all. The driver receives
``entries`` words, whatever the corpus.

Nulls: a null text is an empty one and has no ids; no ids decode to an empty
text. Null ids decode to an empty text, too. Rows are independent of each
other, so repeated rows get the same answer. An empty table gives an empty
result, by an empty lexicon. Other columns are kept by name as asked for; those
named like new ones (``ids``, ``text``) give way.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tallyspark.llm.common import Memo
from tallyspark.llm.packing import _byte_names
from tallyspark.llm.shipped import open_shipped, ship

# Fixed value: the pattern by which byte-level vocabularies part a text.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# The same for texts of the code points below, among which no superscripts, fractions or separators stand.
_COMMON_WORDS = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_COMMON = re.compile("[\x00-\x1b\x20-\x7f\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*")
# Code points whose class has been settled for long; others are left to the tokenizer's own Unicode tables.
_SETTLED = regex.compile(
    "[\x00-ԧא-תء-ي٠-٩ऄ-हก-ฺḀ-ỿ -⁤₠-₸"
    "℀-⯿　-ヿ一-龥가-힣ﬀ-ﬆ️！-～\U0001f300-\U0001f64f]*"
)
_INTS = ArrayType(IntegerType())
_LETTERS = regex.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


@dataclass(frozen=True)
class Shape:
    entries: int = 1 << 18  # words of the lexicon, at most
    longest: int = 48  # bytes of a word that can be an entry
    share: float = 2e-6  # of a task's words that a reported word makes up
    counted: int = 1 << 21  # words that are counted before they are reported
    slice: int = 1 << 20  # characters that are walked at a time


class Merger:
    """A byte-level BPE vocabulary: how texts part into words, and the ids of one word."""

    def __init__(self, path: str, names_as_text: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = names_as_text
        self.specials = [] if names_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.names = _byte_names()

    def plain(self, text: str) -> bool:
        """Whether the text's words can be had by the pattern."""
        return (text.isascii() or _SETTLED.fullmatch(text) is not None) and not any(s in text for s in self.specials)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def merged(self, word: bytes) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize("".join(map(self.names.__getitem__, word)))]

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id; a special token's are those of its name."""
        back = {c: b for b, c in self.names.items()}
        size = max(self.tokenizer.get_vocab().values(), default=-1) + 1
        out = [b""] * size
        for token, i in self.tokenizer.get_vocab().items():
            out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        return out


def words_of(text: str) -> list[str]:
    """The words of a text that is plain."""
    return (_COMMON_WORDS if _COMMON.fullmatch(text) else WORDS).findall(text)


def parts(text: str, size: int) -> Iterator[str]:
    """A long text in parts, cut between two words of letters where there are any."""
    at = 0
    while len(text) - at > size:
        found = _LETTERS.search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


# ---- the frequent words ----


def _counter(path: str, shape: Shape):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, counts, size = Merger(path), Counter(), 0

        def reported() -> pa.RecordBatch:
            least = max(2, shape.share * size)
            rows = [(w, n) for w, n in ((w.encode(), n) for w, n in counts.items() if n >= least) if len(w) <= shape.longest]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text or not merger.plain(text):
                    continue
                for part in parts(text, shape.slice):
                    found = words_of(part)
                    counts.update(found)
                    size += len(found)
                    if size >= shape.counted:
                        yield reported()
                        counts, size = Counter(), 0
        if counts:
            yield reported()

    return count


def frequent_words(docs: DataFrame, path: str, shape: Shape = Shape()) -> list[bytes]:
    """The words with the highest counts, in order of their bytes."""
    counted = docs.select("text").mapInArrow(_counter(path, shape), "word binary, n long")
    best = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(shape.entries)
    return sorted(bytes(r["word"]) for r in best.collect())


# ---- the transducer ----


def automaton(words: Sequence[bytes]) -> list[tuple[bool, tuple[tuple[int, int], ...]]]:
    """The states of the minimal acyclic automaton of sorted distinct words, each (final, its arcs
    (byte, state)); the last is the first to enter. A state's arcs lead to states before it."""
    known: dict[tuple, int] = {}
    open_states: list[list] = [[False, []]]

    def close(depth: int) -> None:
        while len(open_states) > depth + 1:
            final, arcs = open_states.pop()
            state = known.setdefault((final, tuple(arcs)), len(known))
            parent = open_states[-1][1]
            parent[-1] = (parent[-1][0], state)

    before = b""
    for word in words:
        shared = next((i for i, (a, b) in enumerate(zip(before, word)) if a != b), min(len(before), len(word)))
        close(shared)
        for b in word[shared:]:
            open_states[-1][1].append((b, -1))
            open_states.append([False, []])
        open_states[-1][0] = True
        before = word
    close(0)
    final, arcs = open_states[0]
    return [*known, (final, tuple(arcs))]


def _arranged(states: list[tuple[bool, tuple[tuple[int, int], ...]]]) -> dict[str, np.ndarray]:
    """The transducer in two arrays: a state's arc by a byte stands at base + byte, if ``owner`` there is the state."""
    counts: list[int] = []
    for final, arcs in states:
        counts.append(final + sum(counts[t] for _, t in arcs))
    # States of many arcs first; those of one arc fill the gaps. Beyond some tries a state goes to the end.
    taken, base, free, end = bytearray(1024), [0] * len(states), 256, 256
    for state in sorted(range(len(states)), key=lambda s: -len(states[s][1])):
        labels = [b for b, _ in states[state][1]]
        if not labels:
            continue
        free = first = taken.index(0, free)
        for _ in range(50):
            if not any(taken[first - labels[0] + b] for b in labels):
                break
            first = taken.index(0, first + 1)
        else:
            first = end
        base[state] = at = first - labels[0]
        for b in labels:
            taken[at + b] = 1
        end = max(end, at + labels[-1] + 1)
        if end + 512 > len(taken):
            taken.extend(bytes(len(taken)))
    slots = max(base) + 256
    owner, target, output = np.full(slots, -1, np.int32), np.zeros(slots, np.int32), np.zeros(slots, np.int32)
    for state, (final, arcs) in enumerate(states):
        before = int(final)
        for b, t in arcs:
            at = base[state] + b
            owner[at], target[at], output[at] = state, t, before
            before += counts[t]
    return {
        "base": np.array(base, np.int32), "final": np.array([f for f, _ in states], np.uint8),
        "owner": owner, "target": target, "output": output,
    }


def compiled(words: Sequence[bytes], path: str) -> dict[str, np.ndarray]:
    """The transducer of sorted words and, by word number, their ids."""
    merger = Merger(path)
    ids = [merger.merged(w) for w in words]
    ends = np.cumsum([0, *map(len, ids)])
    longest = max(map(len, words), default=0)
    return _arranged(automaton(words)) | {
        "ends": ends.astype(np.int64), "ids": np.array([i for some in ids for i in some], np.int32), "longest": np.array([longest], np.int64),
    }


class Lexicon:
    """The mapped transducer."""

    def __init__(self, tables: dict[str, np.ndarray]) -> None:
        self.base, self.final, self.owner, self.target, self.output = (tables[n] for n in ("base", "final", "owner", "target", "output"))
        self.ends, self.ids, self.longest = tables["ends"], tables["ids"], int(tables["longest"][0])

    def numbers(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each word in the bytes; -1 where the lexicon lacks it."""
        out = np.full(len(starts), -1, np.int64)
        live = np.flatnonzero((lengths <= self.longest) & (lengths > 0))
        state, total = np.full(len(live), len(self.base) - 1, np.int32), np.zeros(len(live), np.int32)
        left, at = lengths[live], starts[live]
        while len(live):
            slot = self.base[state] + raw[at]
            go = self.owner[slot] == state
            live, slot, left, at = live[go], slot[go], left[go] - 1, at[go] + 1
            state, total = self.target[slot], total[go] + self.output[slot]
            end = left == 0
            if end.any():
                hit = end & (self.final[state] == 1)
                out[live[hit]] = total[hit]
                go = ~end
                live, state, total, left, at = live[go], state[go], total[go], left[go], at[go]
        return out


def build(docs: DataFrame, path: str, shape: Shape = Shape()) -> str:
    """Count, compile and send out the lexicon of the documents; the name by which tasks open it."""
    return ship(docs.sparkSession, "lexicon", compiled(frequent_words(docs, path, shape), path))


# ---- encoding and decoding ----


class Encoder:
    """Ids of texts by the lexicon, and by merging where it lacks a word."""

    def __init__(self, lexicon: Lexicon, merger: Merger, shape: Shape) -> None:
        self.lexicon, self.merger, self.shape = lexicon, merger, shape
        self.unseen = Memo(merger.merged)

    def words(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words in a row, how many each word has)."""
        text = "".join(found)
        data = text.encode()
        raw = np.frombuffer(data, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        if len(data) != len(text):  # places of characters to places of bytes
            ends = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(data))[ends]
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        number = self.lexicon.numbers(raw, starts, ends - starts)
        seen = number >= 0
        begin, count = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        begin[seen], count[seen] = self.lexicon.ends[number[seen]], np.diff(self.lexicon.ends)[number[seen]]
        rare = np.flatnonzero(~seen)
        merged = [self.unseen[data[s:e]] for s, e in zip(starts[rare].tolist(), ends[rare].tolist())]
        count[rare] = lengths = np.fromiter(map(len, merged), np.int64, len(merged))
        begin[rare] = len(self.lexicon.ids) + np.cumsum(lengths) - lengths
        pool = np.concatenate([self.lexicon.ids, np.array([i for some in merged for i in some], np.int32)])
        before = np.cumsum(count) - count
        return pool[np.repeat(begin - before, count) + np.arange(count.sum())], count

    def texts(self, texts: Sequence[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(how many texts, their ids in a row, how many each text has), for some texts at a time."""
        waiting: list[str] = []
        parts_of: list[int] = []  # words of each text that waits

        def flush() -> tuple[int, np.ndarray, np.ndarray]:
            ids, count = self.words(waiting) if waiting else (np.empty(0, np.int32), np.empty(0, np.int64))
            ends = np.cumsum([0, *parts_of])
            sums = np.diff(np.concatenate([[0], np.cumsum(count)])[ends])
            return len(parts_of), ids, sums

        size = 0
        for text in texts:
            text = text or ""
            plain = self.merger.plain(text)
            if waiting and (not plain or size + len(text) > self.shape.slice):
                yield flush()
                waiting, parts_of, size = [], [], 0
            if not plain or len(text) > self.shape.slice:
                if parts_of:
                    yield flush()
                    waiting, parts_of, size = [], [], 0
                if plain:
                    ids = np.concatenate([self.words(words_of(p))[0] for p in parts(text, self.shape.slice)])
                else:
                    ids = np.array(self.merger.whole(text), np.int32)
                yield 1, ids, np.array([len(ids)])
                continue
            found = words_of(text)
            waiting += found
            parts_of.append(len(found))
            size += len(text)
        if parts_of:
            yield flush()


def _encodes(path: str, lexicon: str, shape: Shape):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Lexicon(open_shipped(lexicon)), Merger(path), shape)
        for batch in batches:
            at = 0
            for n, ids, sums in encoder.texts(batch.column(batch.num_columns - 1).to_pylist()):
                offsets = np.concatenate([[0], np.cumsum(sums)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                kept = [c.slice(at, n) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, lists], [*batch.schema.names[:-1], "ids"])
                at += n

    return encode


def encoded(docs: DataFrame, path: str, keep: Sequence[str], lexicon: str | None = None, shape: Shape = Shape()) -> DataFrame:
    """The kept columns and the ``ids`` of the text, by the lexicon of these documents unless another is named."""
    name = lexicon or build(docs, path, shape)
    rows = docs.select(*[f"`{c}`" for c in keep if c != "ids"], F.col("text").alias("_text"))
    return rows.mapInArrow(_encodes(path, name, shape), rows.drop("_text").schema.add("ids", _INTS))


def _decodes(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Merger(path).token_bytes()
        for batch in batches:
            ids = batch.column(batch.num_columns - 1)
            flat = ids.values.to_numpy(zero_copy_only=False)
            ends = ids.offsets.to_numpy()
            texts = [
                b"".join(map(tokens.__getitem__, flat[ends[i] : ends[i + 1]].tolist())).decode("utf-8", "replace") for i in range(len(ids))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return decode


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """The rows with the ``text`` of their ``ids``; bytes that are no UTF-8 become replacement characters."""
    ordered = rows.select(*[f"`{c}`" for c in rows.columns if c not in ("ids", "text")], F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return ordered.mapInArrow(_decodes(path), StructType([*ordered.schema.fields, StructField("text", StringType())]))
