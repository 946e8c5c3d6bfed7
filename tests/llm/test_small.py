"""Small cases of each operator: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

from __future__ import annotations

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import language, mixing, near_dups, packing, pii, quality_mil, quality_rules, sharding, topk, url_filter
from tallyspark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, size int, spans string, shard int, score double"


def documents(spark, texts, ids=None, sources=None, langs=None):
    rows = []
    for i, t in enumerate(texts):
        rows.append((ids[i] if ids else i, t, langs[i] if langs else "en", sources[i] if sources else f"s{i % 3}", len(t) if t else None, "x", 1, "y", 9, 0.5))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def text_of(rng, n, words=60):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


ODD = [None, "", " \t\n", "one", "one two three", "\u00e9\u00e8 \u00df!", "x " * 3000, "one", "one"]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD, ids=[0, 1, 2, 3, 4, 5, 6, 7, None], sources=[None, "a", "b", "b", "a", None, "c", "c", "c"])


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, ["x"]).where("false")


# ---- 1 ----

VALUES = {
    "card": "4111 1111 1111 1111", "phone": "+1 (988) 555-2485", "ip": "10.200.3.44", "email": "ann.lee42@mail.example.com",
    "date": "2021-02-28", "ssn": "123-45-6789", "secret": "531ccd051a92ebcb68", "iban": "DE89370400440532013000",
}


def test_pseudonyms_keep_format_and_turn_back():
    f = pii.Feistel(b"k")
    text = f"a {VALUES['card']}, {VALUES['phone']} {VALUES['ip']} {VALUES['email']}. On {VALUES['date']} {VALUES['ssn']} password={VALUES['secret']} {VALUES['iban']} end"
    new, spans = pii.pseudonymised(text, f)
    assert Counter(k for _, _, k in spans) == Counter(list(VALUES))
    assert not any(v in new for v in VALUES.values())
    assert [k for _, _, k in pii.find(new)] == [k for _, _, k in spans]  # still valid in their formats
    assert pii.pseudonymised(new, f, back=True)[0] == text
    for s, e, k in spans:
        shape = [re.sub("[0-9]", "9", x) for x in (new[s:e], VALUES[k])]
        assert k in ("ip", "secret", "email", "iban") or shape[0] == shape[1]
    assert pii.pseudonymised(f"see {VALUES['card']}", f)[0][4:] in new  # linked across texts


def test_pseudonyms_leave_the_rest_alone():
    f = pii.Feistel(b"k")
    for text in ["4111 1111 1111 1112", "300.1.1.1", "2021-02-30", "000-12-3456", "v1.2.3", "12345", "a@b", "plain words", "1234567890123456"]:
        assert pii.pseudonymised(text, f) == (text, [])


PHONES = [
    "+1 (017) 555-7713", "+1 (988) 155-2485", "+14155552671", "+1 415 555 2671", "(415) 555 2671", "+1.017.555.7713", "+1-199-000-0000",
    "(012) 055-7713", "012-555-7713", "1-123-555-2671", "(415)5552671", "+1(415)-555-2671", "+1 (999) 199-9999", "+1 000 000 0000",
]


@pytest.mark.parametrize("value", PHONES)
def test_every_telephone_number_is_found(value):
    f = pii.Feistel(b"k")
    text = f"call {value}, or not"
    new, spans = pii.pseudonymised(text, f)
    assert [k for _, _, k in spans] == ["phone"] and value not in new
    (s, e, _), = spans
    assert re.sub("[0-9]", "9", new[s:e]) == re.sub("[0-9]", "9", value)
    assert pii.pseudonymised(new, f, back=True)[0] == text
    # One number, one pseudonym, whatever parts its digits.
    digits = lambda t: re.sub("[^0-9]", "", t)[-10:]
    assert digits(pii.pseudonymised(f"+1{digits(value)}", f)[0]) == digits(new[s:e])


def test_telephone_numbers_are_permuted_within_their_format():
    same = lambda kind, n, x: x
    for area in (0, 17, 199, 200, 555, 999):
        for office in (0, 199, 200, 999):
            digits = f"{area:03d}{office:03d}0042"
            kind, n, x = pii._ranked_national(digits)
            assert 0 <= x < n and pii._unranked_national(kind, n, x, same) == digits
    ends = [pii._unranked_national("phone/01", 3_600_000_000, x, same) for x in (0, 1_999_999_999, 2_000_000_000, 3_599_999_999)]
    assert ends == ["0000000000", "1999999999", "2000000000", "9991999999"]
    # Those that begin with 2 to 9 keep the pseudonyms they had.
    assert pii.pseudonymised(VALUES["phone"], pii.Feistel(b"k"))[0] == "+1 (577) 781-3025"


@pytest.mark.parametrize("text", ["100 200 3000", "4155552671", "14155552671", "+1 415 555 267", "+1 415 555 26711", "1 415 555 2671", "a+1x 5"])
def test_other_numbers_are_no_telephone_numbers(text):
    assert pii.pseudonymised(text, pii.Feistel(b"k")) == (text, [])


@pytest.mark.parametrize("n", [2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation(n):
    f = pii.Feistel(b"k")
    out = [f.permute("t", n, x) for x in range(n)]
    assert sorted(out) == list(range(n)) and [f.permute("t", n, y, back=True) for y in out] == list(range(n))


def test_pseudonyms_of_tables(odd, none):
    got = pii.pseudonyms(odd, "k").collect()
    assert Counter(r["text"] for r in got) == Counter(ODD) and all(r["spans"] == [] for r in got)
    assert pii.pseudonyms(none, "k").count() == 0


def test_pseudonyms_keep_columns_of_clashing_names(spark, odd):
    staged = corpus_pipeline.under_pseudonyms(spark, odd, "")
    assert staged.columns == odd.columns and {r["spans"] for r in staged.collect()} == {"y"}
    got = pii.pseudonyms(documents(spark, ["call +14155552671"]), "k", spans="places").first()
    assert got["spans"] == "y" and [p["kind"] for p in got["places"]] == ["phone"]


# ---- 2 ----


def water(sizes, weights, most):
    """Targets by resharing the excess again and again."""
    total, full = sum(sizes), [False] * len(sizes)
    while True:
        left = total - sum(most * s for s, f in zip(sizes, full) if f)
        share = left / (sum(w for w, f in zip(weights, full) if not f) or 1)
        over = [not f and share * w > most * s for s, w, f in zip(sizes, weights, full)]
        if not any(over):
            return [most * s if f else share * w for s, w, f in zip(sizes, weights, full)]
        full = [f or o for f, o in zip(full, over)]


def test_mix_near_targets(spark):
    rng = random.Random(1)
    sources = [rng.choice(["a", "a", "a", "a", "b", "B", None, "é"]) for _ in range(400)]
    texts = [text_of(rng, rng.choice([0, 5, 40, 300]) if s != "b" else 3) for s in sources]
    docs = documents(spark, texts, sources=sources)
    got = mixing.mixed(docs).collect()
    assert len(got) == 400
    order = sorted({s for s in sources if s is not None}) + [None]
    sizes = [sum(len((t or "").split()) for t, s in zip(texts, sources) if s == o) for o in order]
    targets = dict(zip(order, water(sizes, [1 + i % 3 for i in range(len(order))], 3)))
    taken = Counter()
    for r in got:
        assert r["size"] == len((texts[r["doc_id"]] or "").split()) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(targets[r["source"]])
        taken[r["source"]] += r["taken"]
    for o in order:
        assert abs(taken[o] - targets[o]) <= 64 + 0.02 * targets[o]
    again = mixing.mixed(docs.repartition(5)).collect()
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in got}
    words = mixing.mixed_documents(docs).select("doc_id", "text", "n_chars").collect()
    mixed = Counter()
    for r in words:
        mixed[r["doc_id"]] += len(r["text"].split())
        at = iter(texts[r["doc_id"]].split())
        assert r["n_chars"] == len(r["text"]) > 0 and all(w in at for w in r["text"].split())  # in the document's order
    assert all(mixed[r["doc_id"]] == r["taken"] for r in got)


def test_index_permutation(spark):
    for n in (1, 2, 7, 100):
        got = spark.range(n).select(mixing.shuffled(F.col("id"), F.lit(n), F.lit(3), F.lit("s")).alias("x")).collect()
        assert sorted(r["x"] for r in got) == list(range(n))


def test_drawn_shards_follow_the_targets(spark):
    targets = mixing.source_targets(spark.createDataFrame([(s, 100_000) for s in "abc"], "source string, size long"))
    mix = mixing.Mix(shard_slots=64)
    planned = {r["_src"]: r for r in targets.collect()}
    n = sum(r["_slots"] for r in planned.values())
    drawn = mixing.slots(targets, mix)
    rows = drawn.collect()
    # Every slot once; each source as often as planned, by every number once; blocks evenly taken.
    assert sorted(r["shard"] * 64 + r["slot"] for r in rows) == list(range(n))
    for src, r in planned.items():
        own = [x for x in rows if x["_src"] == src]
        assert sorted(x["index"] for x in own) == list(range(r["_slots"]))
        times = Counter(x["block"] for x in own)
        assert set(times) <= set(range(r["_blocks"])) and max(times.values()) <= -(-r["_slots"] // r["_blocks"])
        assert r["_slots"] < r["_blocks"] or min(times.get(b, 0) for b in range(r["_blocks"])) >= r["_slots"] // r["_blocks"]
    # The draws again, one by one: only so many slots are handed on as the draws miss the plan.
    seed = xxhash.xxh64_intdigest(mix.seed.to_bytes(4, "little"), 42)
    number = lambda i: xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    source = {}
    for i in range(n):
        at = signed(number(i)) % n
        source[i] = next(k for k, r in planned.items() if r["_first"] <= at < r["_first"] + r["_slots"])
    count = Counter(source.values())
    moved = sum(r["_src"] != source[r["shard"] * 64 + r["slot"]] for r in rows)
    assert moved == sum(max(0, count[k] - r["_slots"]) for k, r in planned.items()) < n / 10
    # The counts of shards vary as multinomial ones: chi-squared of k - 1 on average.
    counts = {(r["shard"], r["_src"]): r["slots"] for r in mixing.shard_counts(drawn).collect()}
    shares = {k: r["_slots"] / n for k, r in planned.items()}
    chi = [sum((counts.get((s, k), 0) - 64 * p) ** 2 / (64 * p) for k, p in shares.items()) for s in range(n // 64)]
    assert len(chi) > 40 and 1.2 < np.mean(chi) < 3


def test_mix_of_odd_rows(odd, none):
    got = mixing.mixed(odd).collect()
    assert len(got) == len(ODD) and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mixed(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns


# ---- 3 ----


def test_quality_learns_and_scores_odd_rows(spark, odd, none):
    rng = random.Random(2)
    texts = [text_of(rng, 150, 5000) + "." for _ in range(60)] + ["junk ### $$$ " * 60 for _ in range(60)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)] + [(5, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_mil.learn(docs, labels, "quality", F.col("doc_id") % 2 == 0)
    got = {r["doc_id"]: r["score"] for r in quality_mil.scored(docs, model, ["doc_id"]).collect()}
    assert all((got[i] > 0.5) == (i < 60) for i in range(120))
    assert all(0 <= r["score"] <= 1 for r in quality_mil.scored(odd, model, ["doc_id"]).collect())
    assert quality_mil.scored(none, model, ["doc_id"]).count() == 0
    assert quality_mil.learn(docs, labels.where("quality = 1"), "quality", F.lit(True)) is None
    assert {r["score"] for r in quality_mil.scored(odd, None, ["doc_id"]).collect()} == {0.5}


def test_quality_learns_from_long_texts_beyond_the_bound(spark):
    rng = random.Random(8)
    texts = [text_of(rng, 80, 5000) + "." for _ in range(60)] + ["junk ### $$$ " * 200 for _ in range(60)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    # Room for 60 passages: the short texts, all good, would fill it.
    model = quality_mil.learn(docs, labels, "quality", F.lit(True), quality_mil.Settings(sample_words=6_000))
    got = {r["doc_id"]: r["score"] for r in quality_mil.scored(docs, model, ["doc_id"]).collect()}
    assert all((got[i] > 0.5) == (i < 60) for i in range(120))


def test_passages_taught_are_picked_by_hash():
    bag = np.random.default_rng(9).normal(0, 1, (300, quality_mil.FEATURES)).astype("<f4")
    some = quality_mil._picked(bag, 40)
    at = [int(np.flatnonzero((bag == row).all(axis=1))[0]) for row in some]
    assert len(at) == 40 and at == sorted(at) and at[0] < 60 and at[-1] > 240  # from all over the text
    assert (quality_mil._picked(some, 40) == some).all() and len(quality_mil._picked(bag, 300)) == 300
    assert {row.tobytes() for row in quality_mil._picked(some, 10)} == {row.tobytes() for row in quality_mil._picked(bag, 10)}


def test_quality_gradient_lowers_the_loss():
    rng = np.random.default_rng(0)
    bags = [rng.normal(i % 2, 1, (1 + i % 4, 6)) for i in range(80)]
    y = np.array([i % 2 for i in range(80)], float)
    loss = [-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) for p in (quality_mil.fit(bags, y, quality_mil.Settings(rounds=r)).scores(bags) for r in (1, 150))]
    assert loss[1] < 0.5 * loss[0]


def test_passages_cover_the_text():
    one = quality_mil.passages("a b " * 250)
    assert one.shape == (5, quality_mil.FEATURES) and np.isfinite(one).all()
    assert quality_mil.passages(None).shape == quality_mil.passages(" ").shape == (1, quality_mil.FEATURES)


# ---- 4 ----


def test_shards(spark, odd, none):
    rng = random.Random(3)
    rows = spark.createDataFrame([(rng.choice([None, *range(400)]), rng.choice([8, 50, 900]), 7) for _ in range(900)], "k long, bytes long, shard int")
    got = sharding.balanced(rows, ["k", "bytes"], "bytes", 24, per_part=50).collect()
    assert len(got) == 900
    total = sum(r["bytes"] for r in got)
    by = {s: sorted((r for r in got if r["shard"] == s), key=lambda r: r["slot"]) for s in range(24)}
    line = [r for s in range(24) for r in by[s]]
    assert all([r["slot"] for r in by[s]] == list(range(len(by[s]))) for s in by)
    assert [(-1 if r["k"] is None else r["k"], r["bytes"]) for r in line] == sorted((-1 if r["k"] is None else r["k"], r["bytes"]) for r in got)
    assert max(abs(sum(r["bytes"] for r in by[s]) - total / 24) for s in by) <= 900
    assert sharding.balanced(none.select("doc_id", "size"), ["doc_id"], "size", 24).count() == 0
    assert sharding.balanced(odd, ["doc_id", "text"], "size", 24).count() == len(ODD)


# ---- 5 ----


def sets_of(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_components(texts):
    sets, label = [sets_of(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return sets, label


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", "One two", "one TWO", "one two three", " "]
    for _ in range(25):
        base = text_of(rng, rng.choice([6, 30, 80, 200]), 500).split()
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"z{rng.random()}"
            texts.append(rng.choice([" ", "\n "]).join(copy))
    sets, label = brute_components(texts)
    got = {r["doc_id"]: r for r in near_dups.near_duplicates(documents(spark, texts)).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(texts))] == label
    assert sum(r["first"] for r in got.values()) == len(set(label))


def test_one_group_of_many_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(70)]
    texts = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.choice([1, 2])):
            copy[rng.randrange(70)] = f"x{i}"
        texts.append(" ".join(copy))
    got = near_dups.near_duplicates(documents(spark, texts)).collect()
    label = brute_components(texts)[1]
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(label))


def test_tested_pairs_leave_by_one_join(spark, monkeypatch):
    plans = []
    kept = near_dups.pinned

    def keep(df, label):
        if label == "pairs":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(df, label)

    monkeypatch.setattr(near_dups, "pinned", keep)
    rng = random.Random(6)
    texts = []
    for _ in range(60):
        copy = [f"b{i}" for i in range(70)]
        for _ in range(4):
            copy[rng.randrange(70)] = f"x{rng.random()}"
        texts.append(" ".join(copy))
    got = near_dups.near_duplicates(documents(spark, texts), tables=near_dups.Tables(rounds=2)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(brute_components(texts)[1]))
    assert [p.count("LeftAnti") for p in plans] == [0, 1, 1]


def test_near_copies_link_with_the_middle_of_their_group(spark, monkeypatch):
    """Whatever the order of rows: each copy is verified against the base, and no pair of copies is."""
    tested, kept = [], near_dups.pinned

    def keep(df, label):
        table = kept(df, label)
        if label == "pairs":
            tested.append(table.count())
        return table

    monkeypatch.setattr(near_dups, "pinned", keep)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for i in range(100):
        copy = list(base)
        for at in rng.sample(range(150), 4 if i < 20 else rng.choice([2, 3, 4])):
            copy[at] = f"x{rng.random()}"
        texts.append(" ".join(copy))
    texts.append(" ".join(base))
    got = near_dups.near_duplicates(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict.fromkeys(range(101), 0) == dict(enumerate(brute_components(texts)[1]))
    assert tested == [100]


def test_texts_and_sets_stay_where_they_are(spark, monkeypatch):
    plans = {}
    for name in ("pinned", "bucketed"):
        def keep(df, label, *by, kept=getattr(near_dups, name)):
            plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString())
            return kept(df, label, *by)

        monkeypatch.setattr(near_dups, name, keep)
    words = [f"b{i}" for i in range(40)]
    texts = [" ".join([*words[:i], f"x{i}", *words[i + 1 :]]) for i in range(3)] + ["else where"]
    got = near_dups.near_duplicates(documents(spark, texts)).collect()
    assert [r["component_id"] for r in sorted(got)] == brute_components(texts)[1]
    assert "LeftSemi" not in plans["sets"]


@pytest.mark.parametrize("sizes", [(1, 1), (60, 70), (64, 65), (300, 400), (3000, 2500), (4, 900)])
def test_sketches_never_miss_less_than_they_say(spark, sizes):
    rng = np.random.default_rng(sum(sizes))
    shared = rng.integers(0, 1 << 63, min(sizes) * 4 // 5).astype(np.uint64)
    sets = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, n - len(shared)).astype(np.uint64)])) for n in sizes]
    rows = spark.createDataFrame([tuple(near_dups.sketch(s).tolist() for s in sets)], "a array<long>, b array<long>")
    said = rows.select(near_dups._missing(F.col("a"), F.col("b")), near_dups._missing(F.col("b"), F.col("a"))).first()
    lacking = [len(np.setdiff1d(sets[0], sets[1])), len(np.setdiff1d(sets[1], sets[0]))]
    assert all(0 <= s <= n for s, n in zip(said, lacking))
    if sizes == (300, 400):
        assert all(s >= 0.7 * n for s, n in zip(said, lacking))  # and they say something


def test_near_duplicates_of_odd_rows(odd, none):
    got = near_dups.near_duplicates(odd).collect()
    assert len(got) == len(ODD) and {r["component_id"] for r in got if r["doc_id"] in (3, 7, None)} == {3}
    assert near_dups.near_duplicates(none).count() == 0
    assert near_dups.deduplicated(odd).columns == odd.columns
    assert sorted(r["doc_id"] for r in near_dups.deduplicated(odd).collect()) == [0, 1, 2, 3, 4, 5, 6]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(40, 50), (50, 60), (41, 60), (70, 70)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 50: 40, 60: 40, 41: 40}


# ---- 6 ----


def test_encoder_agrees_with_the_tokenizer():
    encoder = packing.ChunkEncoder(packing.tokenizer_path())
    texts = [
        "it's DON'T x'LL", "\u03a3\u03b1\u03c2 \u0130stanbul \xa0 x\x1cy\x85z", "<|endoftext|> hi", "\u6f22\u5b57 123 \u00bd", "a,b;c 'sx", "", "  led  ",
        "a\u0301b stra\u00dfe \u00c0\u00d7\u00f7", "...!!!'s ~`^[x]\\", "".join(map(chr, range(1, 900))), "Word, word word. WORD " * 50,
    ]
    for t in texts:
        want = encoder.tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == want


def test_encoder_agrees_with_a_tokenizer_of_its_own():
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    encoder, tokenizer = packing.ChunkEncoder(path), Tokenizer.from_file(path)
    assert np.frombuffer(encoder.encode("a <|endoftext|> hi"), "<u4").tolist() == [320, 49407, 1883]
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "<", "Word", "\u00e9", "a\u0301", "'s", "...", " ", "\n", "7", "\xa0", "\u6f22"]
    rng = random.Random(7)
    for _ in range(600):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_words_are_tokenized_once_in_whatever_form():
    encoder = packing.ChunkEncoder(packing.tokenizer_path())
    model, seen = encoder.model, Counter()

    class Counted:
        def tokenize(self, part):
            seen[part] += 1
            return model.tokenize(part)

    encoder.model = Counted()
    words = ["".join("abcdefghij"[int(d)] for d in str(i)) for i in range(60_000)]
    for text in (" ".join(words), " ".join(words).title() + ",", ", ".join(words), "(" + ") (".join(words) + ")", "\u00e9 " + " ".join(words).upper()):
        encoder.encode(text)
    assert set(words) <= seen.keys() and max(seen.values()) == 1


def test_encoder_cuts_long_texts_between_chunks(monkeypatch):
    path = packing.tokenizer_path()
    encoder = packing.ChunkEncoder(path)
    monkeypatch.setattr(packing.ChunkEncoder, "_SLICE", re.compile(packing.ChunkEncoder._SLICE.pattern.replace("1000000", "7"), re.DOTALL))
    for t in (*ODD, "a long-ish word's end <|endoftext|>'s \u6f22\u5b57x  \n\n y", " " * 40, "x" * 40):
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids


def _held_and_sent(task, texts):
    """MB of Python's objects held at most while a task goes through one batch, and its largest batch out."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    list(task(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    sent = [b.nbytes for b in task(iter([batch]))]
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return held / 1e6, max(sent) / 1e6


def test_tasks_hold_little_of_a_batch():
    texts = ["write to ann@example.org " + "the cat sat on the mat " * 40] * 8_000  # 7.6 MB
    for task in (packing._cutter(packing.tokenizer_path(), 0, 2048), pii._replacer(b"key", False, None)):
        held, sent = _held_and_sent(task, texts)
        assert held < 5 and sent < 2, (task, held, sent)


@pytest.mark.parametrize("seed", range(4))
def test_fullest_bins(seed):
    rng = random.Random(seed)
    capacity = 60
    counts = Counter(rng.randrange(1, capacity + 1) for _ in range(rng.choice([3, 200])))
    left = Counter(counts)
    for often, used in packing.fullest(counts, capacity):
        # The fullest combination with the largest piece that is left, by plain search.
        largest = max(left)
        sums = {largest}
        for n in (Counter(left) - Counter({largest: 1})).elements():
            sums |= {s + n for s in sums if s + n <= capacity}
        assert max(n for n, _ in used) == largest and sum(n * k for n, k in used) == max(sums)
        for n, k in used:
            left[n] -= often * k
        left = +left
    assert not left


def test_packing(spark, odd, none):
    path = packing.tokenizer_path()
    rng = random.Random(6)
    texts = [text_of(rng, rng.choice([0, 3, 100, 900])) for _ in range(60)]
    docs = documents(spark, [*texts, *ODD])
    placed = packing.place(packing.pieces(docs, path, ["doc_id"])).collect()
    tokenizer = packing.ChunkEncoder(path).tokenizer
    ids = {}
    for r in sorted(placed, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(ids.get(r["doc_id"], b"")) // 4 and r["length"] == len(r["ids"]) // 4
        ids[r["doc_id"]] = ids.get(r["doc_id"], b"") + r["ids"]
    for i, t in enumerate([*texts, *ODD]):
        assert np.frombuffer(ids[i], "<u4").tolist() == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
    at = {}
    for r in sorted(placed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 2048 and len(at) <= -(-sum(at.values()) // 2048) + 1
    assert packing.place(packing.pieces(none, path, ["doc_id"])).count() == 0
    whole = packing.sequences(packing.place(packing.pieces(odd, path, ["doc_id", "digest"]))).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(len(ids[60 + i]) for i in range(len(ODD)))


# ---- 7 ----


def test_url_rules(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.org", "", "block"), ("A.org", "", "allow"), (None, "/x", "block"), ("", "/", "block")]
    cases = {
        "http://x.NET/a": ("x.net", "/a", "net/", "block"), "http://www.example.net/en/1?q": ("www.example.net", "/en/1", "example.net/en/", "allow"),
        "http://xnet/": ("xnet", "/", None, "allow"), "http://net": ("net", "", None, "allow"), "https://q.a.org#x": ("q.a.org", "", "a.org", "block"),
        "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "http:///p://b.net/": ("", "/p://b.net/", None, "allow"), "://net/?a": ("net", "/", "net/", "block"),
    }
    pages = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate([*cases, *cases])], "page_id long, url string, host string, digest int")
    got = url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == 2 * len(cases)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == cases[r["url"]], r
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in url_filter.judge(pages, none).collect()} == {"allow"}
    assert url_filter.judge(pages.where("false"), none).count() == 0


# ---- 8 ----


@pytest.mark.parametrize("seed", range(3))
def test_top_k_against_all_products(spark, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.3, (700, 6)).round(1 if seed else 6)
    vectors[100:300] = vectors[100]  # equal ones
    rows = [(i, [float(x) for x in v[: 6 - (i == 7)]]) for i, v in enumerate(vectors)]
    rows += [(900, None), (None, [1.0] * 6), (901, [float("nan")] * 6), (902, [1.0, None]), (903, [float("inf")] * 6)]
    whole = topk.whole_vectors(spark.createDataFrame(rows, "id long, v array<float>").repartition(3), "id", "v")
    index = topk.Index(pivot_rows=150, block_rows=60, page=8, query_rows=5)
    got = {}
    for r in topk.top_k(whole, F.col("vec_id") % 20 == 0, 10, index).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    table = np.zeros((700, 6), np.int64)
    for i, v in rows[:700]:
        table[i, : len(v)] = np.floor(1024 * np.array(v, np.float32).astype(float))
    for q in range(0, 700, 20):
        want = sorted((-int(s), i) for i, s in enumerate(table @ table[q]) if i != q)[:10]
        assert sorted(got[q]) == [(n + 1, *w) for n, w in enumerate(want)]
    assert set(got) == set(range(0, 700, 20))


def test_top_k_of_few_rows(spark):
    rows = spark.createDataFrame([(0, [1]), (1, [2]), (2, [-1])], "vec_id long, vector array<long>")
    assert [(r["vec_id"], r["score"]) for r in topk.top_k(rows, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 2), (2, -1)]
    assert topk.top_k(rows.where("false"), F.lit(True)).count() == 0
    assert topk.top_k(rows.where("vec_id = 0"), F.lit(True)).count() == 0


# ---- 9 ----


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    lines, seen, dup = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def test_quality_rules(spark, odd, none):
    rng = random.Random(7)
    texts = [text_of(rng, n, v) for n in (7, 8, 9, 30, 200) for v in (1, 2, 3, 200)] + ["a b\nc d\n \n a b\nc d\na b " * 9, "#| $x\n" * 5, "é ü\x0b\x0c\r\nz"]
    docs = documents(spark, [*texts, *ODD])
    got = {r["doc_id"]: r for r in quality_rules.judged(docs, docs.select("text").limit(9)).collect()}
    for i, t in enumerate([*texts, *ODD]):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_rules(t), t
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.judged(odd, none).count() == len(ODD) and quality_rules.judged(none, odd).count() == 0
    assert {r["score"] for r in quality_rules.judged(odd, none).collect()} == {None, 0.0}  # nothing is trusted


def test_ratio_is_that_of_the_counts(spark):
    docs = documents(spark, ["good words here"] * 30 + ["bad thing"] * 10)
    rules = quality_rules.Rules(buckets=1 << 12, least_words=1, most_repeated=100)
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(40)] + [(5, 1), (99, 1), (None, 1), (31, None)], "doc_id long, quality int")
    got = quality_rules.judged(docs, quality_rules.labelled(docs, labels), rules).collect()
    # The target has the 5 n-grams of the good texts 30 times each: 150 of 150, and of 180 in the raw corpus.
    mass = 1 << 12
    good = np.log(31 / (150 + mass)) - np.log(31 / (180 + mass))
    bad = np.log(1 / (150 + mass)) - np.log(11 / (180 + mass))
    assert {(r["n_words"], round(r["score"], 4), r["kept"]) for r in got} == {(3, round(good, 4), True), (2, round(bad, 4), False)}


# ---- 10 ----


def test_languages(spark, odd, none):
    rng = random.Random(8)
    make = {"aa": "kalomi batu sena", "bb": "strung glimph chort", "cc": "ñeço vüá jäq"}
    texts, langs = [], []
    for lang, stock in make.items():
        for _ in range(20):
            texts.append(" ".join(rng.choice(stock.split()) + rng.choice(stock.split())[:2] for _ in range(40)))
            langs.append(lang)
    docs = documents(spark, texts, langs=langs)
    learned = language.profiles(docs, F.col("doc_id") % 3 != 1)
    assert [x for x, _ in learned] == ["aa", "bb", "cc"]
    got = language.identify(docs, learned, keep=["doc_id"]).collect()
    assert all(r["lang_pred"] == langs[r["doc_id"]] and 0 <= r["score"] <= 1 for r in got)
    seen = {r["doc_id"]: r for r in language.identify(odd, learned).collect()}
    assert [seen[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and seen[0]["score"] == 0 and seen[3]["lang_pred"] != "und"
    assert language.identify(none, learned).count() == 0
    assert {r["lang_pred"] for r in language.identify(odd, language.profiles(none, F.lit(True))).collect()} == {"und"}
    assert language.accepted(docs, learned).columns == docs.columns and language.accepted(docs, learned).count() == 60
    signs = language.identify(documents(spark, ["\u00bd \u00b2 \u2460 \u2167", "\u00bd a"]), learned, keep=["doc_id"]).collect()
    assert {r["doc_id"]: r["lang_pred"] != "und" for r in signs} == {0: False, 1: True}


def test_rank_distance_by_hand():
    shape = language.Shape(longest=1, ranks=3)
    judge = language._judge([("x", ["a", "b", "c"]), ("y", ["c", "a"])], shape)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a a b", "7", "Ca"])], ["_text"])
    out = next(judge([batch])).to_pylist()
    # "a a b": ranks a, b. x: 0 + 0. y: 1 + 3 (lacks b).
    assert out[0] == {"lang_pred": "x", "score": 1.0} and out[1] == {"lang_pred": "und", "score": 0.0}
    # "Ca": a and c once each, a first by code point. x: 0 + 1, y: 1 + 1.
    assert out[2]["lang_pred"] == "x" and out[2]["score"] == pytest.approx(1 - 1 / 6)


def test_grams_by_brute_force():
    texts = ["Ab ab, a", "x", "  ", "7", "Ünï 𐐀𐐁 ab_cd1ef", "straße " * 50, "a" * 100]
    for text in texts:
        want = Counter()
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            padded = f" {word} "
            want.update(g for n in (1, 2, 3) for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " ")
        for size in (1, 2, 7, 1 << 20):
            codes, counts = language._counts(text, language.Shape(slice=size))
            assert [language._name(int(c)) for c in codes] == sorted(want)
            assert counts.tolist() == [want[g] for g in sorted(want)]
    assert all(language._name(language._code(g)) == g for g in ("a", " a", "a b", "𐐀𐐁"))


def test_crc_of_pieces(spark):
    rows = packing.pieces(documents(spark, ["hello"]), packing.tokenizer_path(), ["doc_id"]).select("ids", F.crc32("ids").alias("c")).collect()
    assert rows[0]["c"] == zlib.crc32(rows[0]["ids"])
