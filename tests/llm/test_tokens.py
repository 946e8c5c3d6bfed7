"""Phrases, alignment and encoding: small cases and the given tables, against plain Python and the tokenizers."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyspark.llm import alignment, lexicon, phrases
from tallyspark.llm.packing import tokenizer_path
from tallyspark.llm.queries import CATALOGUE
from tests.llm.test_small import ODD, documents, none, odd  # noqa: F401  (fixtures)

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
STRANGE = [
    "  a  b ", "it's  we'll''s 's\n\n x\t\ty \x0b", "<|endoftext|>a <s> </s>", "a<|endoftext|>", "\u2581x a\u2581b", "\x00 \x1c", " ", "\t\n  \n",
    "\u00e9 e\u0301 \u4e2d\u6587\u5b57 \u0623\u0628 \u0915\u094d", "\U0001f600 x\u200dy\u00a0z\u2009q", "\u088f z \u0558", "a" * 3000, "\u00b2\u00bd 12 1a2",
]


# ---- 11 ----


def plain_collocations(rows, least, best, longest=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f[lang].update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least}
        inside = Counter()
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        scored = []
        for p, a in often.items():
            if len(p) < 2 or 100 * inside[p] >= 100 * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k, often[p[:k]], often[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


TINY = phrases.Shape(least=3, best=7, chunk=50, shard=64, merged=40, bitmap=21, slots=3)


def test_words_are_numbered_without_a_row_for_each(spark):
    texts = [" ".join(f"w{(i * j) % 23}" for j in range(40)) + f" once{i}" for i in range(30)]
    small = phrases.Shape(least=3, chunk=50, lexicon=40, bucket=8)
    counts = Counter(w for t in texts for w in t.split())
    words, found, totals = phrases.frequent(documents(spark, texts), small)
    assert {bytes(r["word"]).decode(): r["f"] for r in words.collect()} == {w: n for w, n in counts.items() if n >= 3}
    assert len({r["id"] for r in words.collect()}) == words.count()
    spelt = {r["id"]: bytes(r["word"]).decode() for r in words.collect()}
    pairs = Counter(p for t in texts for p in zip(t.split(), t.split()[1:]))
    got = {tuple(spelt[i] for i in r["ids"]): r["f"] for r in found.where("size(ids) = 2").collect()}
    assert got == {p: n for p, n in pairs.items() if n >= 3}


@pytest.mark.parametrize("shape", [TINY, phrases.Shape(least=3, best=7)])
def test_collocations(spark, shape):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("a B b c D \u00e9 f, g.\n h\t\ti ;; j\x0bk").lower() if rng.random() < 0.1 else rng.choice(["a", "b", "A", "c", "b.", "\u00c9x", "q\u00a0r"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += [*ODD, "hot phrase of five words!" * 40, *["common line here"] * 300]
    langs = [rng.choice(["en", "de", None]) for _ in texts]
    got = phrases.collocations(documents(spark, texts, langs=langs), shape).collect()
    want = plain_collocations(zip(langs, texts), shape.least, shape.best)
    assert sorted(tuple(r) for r in got) == want and len({r[0] for r in want}) == 3


def test_collocations_of_nothing(spark, none, odd):
    assert phrases.collocations(none).collect() == phrases.collocations(odd.where("size(split(text, ' ')) < 9"), phrases.Shape(least=3)).collect() == []


def test_filters_lose_nothing():
    rng = np.random.default_rng(2)
    for n in (2, 3, 4, 5):
        ids = rng.integers(1, 1 << 32, 4000).astype(np.uint32)
        at = rng.integers(0, 100, 3000)
        lanes, counts = phrases.counted(phrases.permuted(phrases.packed(ids, at, n)))
        counts = counts * rng.integers(1, 1 << 20, len(counts))
        assert (lanes[0][1:] >= lanes[0][:-1]).all() and len(counts) == len(np.unique(at))
        filters = phrases.Filters(len(lanes), 2, 5)
        number = (lanes[0] >> np.uint64(62)).astype(int)
        for r in range(4):
            own = number == r
            back, again = filters.load(filters.dump([x[own] for x in lanes], counts[own]), r)
            assert all((x == y[own]).all() for x, y in zip(back, lanes)) and (again == counts[own]).all()
        words = {tuple(w) for w in phrases.unpacked(phrases.restored(lanes), n).tolist()}
        assert words == {tuple(ids[i : i + n].tolist()) for i in at}


def test_long_texts_are_cut_at_breaks_only():
    text = "a b. c d! e f " * 500
    whole = b" ".join(phrases._slices(text, 1 << 20))
    assert b" ".join(b" ".join(phrases._slices(text, 10)).split()) == b" ".join(whole.split())


# ---- 12 ----


def tokens_of(text, a, b, names):
    """(id, bytes) of both sides; nothing where these don't make up a blank and the text."""
    if not text:
        return [], []
    x = [(i, bytes(names[c] for c in a.id_to_token(i))) for i in a.encode(f" {text}", add_special_tokens=False).ids]
    y = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        y.append((i, bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("\u2581", " ").encode()))
    want = f" {text}".encode()
    return (x, y) if b"".join(t for _, t in x) == want == b"".join(t for _, t in y) else ([], [])


def plain_alignment(texts):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    names = {c: i for i, c in lexicon.Merger(A).names.items()}
    count, rows = Counter(), []
    for text in texts:
        sides, ends = tokens_of(text, a, b, names), []
        for side in sides:
            at, places = 0, []
            for i, t in side:
                places.append((at, at + len(t), i))
                at += len(t)
            ends.append(places)
        links = [(i, j) for s, e, i in ends[0] for u, v, j in ends[1] if s < v and u < e] if len(text or "") < 400 else None
        if links is None:  # the same by going on where the last one ended
            links, first = [], 0
            for s, e, i in ends[0]:
                while ends[1][first][1] <= s:
                    first += 1
                k = first
                while k < len(ends[1]) and ends[1][k][0] < e:
                    links.append((i, ends[1][k][2]))
                    k += 1
        groups, before = [], 0
        for cut in sorted({e for _, e, _ in ends[0]} & {e for _, e, _ in ends[1]}):
            groups.append("|".join(",".join(str(i) for s, e, i in side if before <= s < cut) for side in ends) if len(text) < 400 else None)
            before = cut
        count.update(links)
        rows.append((len(sides[0]), len(sides[1]), links, groups))
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [(x, y, len(g), len(k), sum(count[p] == best[p[1]] for p in k), sum(count[p] for p in k), g) for x, y, k, g in rows]


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.mark.parametrize("settings", [alignment.Settings(), alignment.Settings(bucket=3, part_keys=9, block=4, fan_in=2, batch=20)])
def test_alignment(spark, settings):
    texts = [*ODD, *STRANGE, "same text", "same text", "The tokenizers' tokens."]
    rows = alignment.aligned(documents(spark, texts), A, B, ["doc_id", "n_chars"], settings).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts)
    for i, want in enumerate(plain_alignment(texts)):
        assert tuple(got[i][c] for c in FIGURES) == want[:6], texts[i]
        assert len(texts[i] or "") >= 400 or got[i]["groups"] == ";".join(want[6]), texts[i]


def test_alignment_of_nothing(spark, none):
    assert alignment.aligned(none, A, B, ["doc_id"]).collect() == []


def test_alignment_of_the_table(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in CATALOGUE.queries["op12_aligned_tokens"](spark, small).collect()}
    assert got.keys() == docs.keys()
    for i, want in zip(docs, plain_alignment(docs.values())):
        assert tuple(got[i][c] for c in FIGURES) == want[:6]
        assert len(docs[i]) >= 400 or got[i]["groups_sha256"] == hashlib.sha256(";".join(want[6]).encode()).hexdigest()


def test_perfect_hashes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 500, 20_000):
        keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        buckets = 1 + n // 1000
        rows = []
        for bucket in range(buckets):
            own = keys[alignment.bucket_of(keys, buckets) == bucket]
            sizes, bits, order = alignment.perfect(own, 1.5)
            rows.append((bucket, sizes, bits.tobytes(), order.tobytes()))
        table = alignment.PairTable(alignment.PairTable.arrays(rows, buckets))
        assert sorted(table.numbers(keys).tolist()) == list(range(len(keys)))
        others = np.setdiff1d(rng.integers(0, 1 << 63, 1000).astype(np.uint64), keys)
        assert (table.numbers(others) == -1).all()


# ---- 13 ----


def test_lexicon_agrees_with_the_tokenizer(spark, none):
    texts = [*ODD, *STRANGE, "some words and some more words, again " * 300]
    tokenizer = Tokenizer.from_file(A)
    docs = documents(spark, texts)
    for shape in (lexicon.Shape(), lexicon.Shape(entries=3, slice=50, counted=4)):
        got = {r["doc_id"]: r for r in lexicon.decoded(lexicon.encoded(docs, A, ["doc_id", "size"], shape=shape), A).collect()}
        for i, t in enumerate(texts):
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids
            assert got[i]["ids"] == ids and got[i]["text"] == tokenizer.decode(ids, skip_special_tokens=False) == (t or ""), t
            assert got[i]["size"] == 1
    assert lexicon.decoded(lexicon.encoded(none, A, ["doc_id"]), A).collect() == []


def test_decoding_of_any_ids(spark):
    rows = [(0, None), (1, []), (2, [50256, 220]), (3, [447, 247]), (4, [447])]
    got = {r["k"]: r["text"] for r in lexicon.decoded(spark.createDataFrame(rows, "k int, ids array<int>"), A).collect()}
    tokenizer = Tokenizer.from_file(A)
    assert got == {k: tokenizer.decode(ids or [], skip_special_tokens=False) for k, ids in rows}


def test_random_texts_by_any_lexicon():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab'strelmd  \n\t1\u00b2\u00e9\u4e2d,.!\U0001f600\u0301 \x1c") for _ in range(rng.randrange(40))) for _ in range(3000)]
    words = Counter(w for t in texts for w in lexicon.WORDS.findall(t))
    want = [e.ids for e in Tokenizer.from_file(A).encode_batch(texts, add_special_tokens=False)]
    for every in (1, 2, 10**9):
        known = sorted(w.encode() for w in sorted(words)[::every])
        encoder = lexicon.Encoder(lexicon.Lexicon(lexicon.compiled(known, A)), lexicon.Merger(A), lexicon.Shape(slice=700))
        got = []
        for n, ids, sums in encoder.texts(texts):
            got += np.split(ids, np.cumsum(sums)[:-1])
            assert len(sums) == n
        assert [x.tolist() for x in got] == want


def test_automaton_is_minimal_and_numbers_words():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 8))).encode() for _ in range(80)})
    states = lexicon.automaton(words)

    def language(state):
        final, arcs = states[state]
        return frozenset(([b""] if final else []) + [bytes([b]) + rest for b, t in arcs for rest in language(t)])

    assert language(len(states) - 1) == set(words)
    assert len({language(s) for s in range(len(states))}) == len(states)  # no two states alike
    tables = lexicon.Lexicon(lexicon.compiled(words, A))
    data = b"".join(words)
    lengths = np.array([len(w) for w in words])
    assert tables.numbers(np.frombuffer(data, np.uint8), np.cumsum(lengths) - lengths, lengths).tolist() == list(range(len(words)))


def test_tokens_of_the_table(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(A)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, t in docs.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False)))
    got = CATALOGUE.queries["op13_lexicon_bpe"](spark, small).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want
