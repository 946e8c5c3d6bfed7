"""The corpus queries on the given tables: SQL where there is some, brute force or properties elsewhere."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as contract
from tallyspark.llm import mixing, packing, pii
from tallyspark.llm.common import word_count
from tallyspark.llm.queries import CATALOGUE
from tests.compare import differences, duck
from tests.llm.test_small import brute_components, water

SQL = CATALOGUE.sql


def query(name):
    return contract.queries()[name]


def test_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in contract.queries() and [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "pseudonyms", "mixing", "packing"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, graded, name):
    assert differences(query(name)(spark, graded), duck(graded), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(CATALOGUE.queries.keys() - {"op11_collocations"}))
def test_a_row_for_every_document(spark, small, name):
    got = query(name)(spark, small)
    ids = {"op7_url_verdicts": "page_id", "op8_top_inner_products": "query_id"}.get(name, "doc_id")
    source = {"page_id": "pages", "query_id": "embeddings"}.get(ids, "documents")
    want = spark.read.parquet(f"{small}/{source}.parquet")
    want = want.where("vec_id % 100 = 0") if source == "embeddings" else want
    assert got.select(ids).distinct().count() == want.count()


def test_near_duplicates_of_the_table(spark, graded):
    """Every link of an exact join, those just above the threshold included."""
    docs = sorted(spark.read.parquet(f"{graded}/documents.parquet").select("doc_id", "text").collect())
    sets = []
    for _, text in docs:
        words = text.encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    holders = defaultdict(list)
    for i, found in enumerate(sets):
        for shingle in found:
            holders[shingle].append(i)
    shared = Counter((a, b) for own in holders.values() for k, b in enumerate(own) for a in own[:k])
    root, close = list(range(len(docs))), 0

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for (a, b), both in shared.items():
        union = len(sets[a]) + len(sets[b]) - both
        if 100 * both >= 75 * union:
            close += 100 * both < 80 * union
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in query("op5_near_duplicates")(spark, graded).collect()}
    assert got == {docs[i][0]: (len(sets[i]), docs[find(i)][0]) for i in range(len(docs))} and close > 0


def test_held_out_quality_and_language(spark, graded):
    labels = spark.read.parquet(f"{graded}/labels.parquet")
    scored = query("op3_quality_scores")(spark, graded).join(labels, "doc_id").collect()
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in scored if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)
    docs = spark.read.parquet(f"{graded}/documents.parquet").select("doc_id", "lang")
    judged = query("op10_language")(spark, graded).join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in judged) >= 0.98 * len(judged)


def test_rules_keep_good_and_drop_junk(spark, graded):
    labels = spark.read.parquet(f"{graded}/labels.parquet")
    got = query("op9_quality_rules")(spark, graded).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r["kept"] for r in got if r["quality"] == 1], [r["kept"] for r in got if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_filters_on_verdicts_do_not_reach_the_texts(spark, small):
    found = query("op9_quality_rules")(spark, small).where("kept AND NOT base_failed")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    filters = [node for node in re.split(r"\n[ :]*[+:]- ", plan) if node.startswith("Filter")]
    assert filters and not any("CASE WHEN" in node for node in filters)


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        new = corpus_pipeline.pinned(stage(spark, docs, small), name)
        if name != "packing":
            assert new.columns == docs.columns
        seen[name], docs = (docs, new), new
    before, after = seen["near_duplicates"]
    kept = {r["doc_id"] for r in query("op5_near_duplicates")(spark, small).where("kept").select("doc_id").collect()}
    assert {r["doc_id"] for r in after.collect()} == kept and before.count() == seen["language"][0].count()
    before, after = seen["mixing"]
    words = lambda d: d.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("w"))
    assert after.select("doc_id").subtract(before.select("doc_id")).count() == 0 and words(after).count() == words(before).count()
    packed = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert packed.where("n <> end or n > 2048").count() == 0


# ---- the stages of the pipeline, each against plain Python on its own input ----


@pytest.fixture(scope="module")
def stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        new = corpus_pipeline.pinned(stage(spark, docs, small), name)
        seen[name], docs = (docs, new), new
    return seen


def rows_of(pair):
    return [sorted((tuple(r) for r in df.collect()), key=repr) for df in pair]


def profile(texts):
    counts = Counter()
    for text in texts:
        for word in re.split(r"[\W\d_]+", text.lower()):
            padded = f" {word} "
            if word:
                counts.update(word)
                counts.update(padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1))
    return [gram for gram, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:300]]


def test_stage_of_language(spark, small, stages):
    before = stages["language"][0]
    # All given documents stay, so a few that don't come in addition.
    odd = ["", "123 ### 45", "\u6f22\u5b57 \u6f22\u5b57\u6f22", "\u043f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440", "qqq xxx zzz", "the one"]
    before = before.union(spark.createDataFrame([(10**6 + i, t, "en", "src0", len(t)) for i, t in enumerate(odd)], before.schema))
    after = corpus_pipeline.in_known_language(spark, before, small)
    docs, by = before.collect(), defaultdict(list)
    for r in docs:
        if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1:
            by[r["lang"]].append(r["text"])
    learned = [{gram: i for i, gram in enumerate(profile(by[lang]))} for lang in sorted(by)]

    def accepted(text):
        own = profile([text])
        far = [sum(abs(known[g] - i) if g in known else 300 for i, g in enumerate(own)) for known in learned]
        return bool(own) and 1 - min(far) / (300 * len(own)) >= 0.2

    want = sorted((tuple(r) for r in docs if accepted(r["text"])), key=repr)
    assert rows_of([after]) == [want] and 0 < len(want) < len(docs)


def test_stage_of_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    docs = sorted(before.collect(), key=lambda r: r["doc_id"])
    label = brute_components([r["text"] for r in docs])[1]
    want = sorted((tuple(r) for i, r in enumerate(docs) if label[i] == i), key=repr)
    assert rows_of([after]) == [want] and len(want) < len(docs)


PERSONAL = {
    "phone": r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", "card": r"(?<!\w)[0-9]{16}(?!\w)",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w.])", "email": r"[A-Za-z0-9._]+@[A-Za-z0-9.]+[a-z]",
    "secret": r"(?<=password=)\w+|(?<=token=)\w+|(?<=api_key=)\w+",
}


def valid(kind, value):
    if kind == "card":
        return pii.luhn_digit(value[:-1]) == value[-1] and value[0] != "0"
    return kind != "ip" or max(map(int, value.split("."))) < 256


def test_stage_of_pseudonyms(stages):
    before, after = ({r["doc_id"]: r for r in df.collect()} for df in stages["pseudonyms"])
    assert before.keys() == after.keys()
    links, seen = defaultdict(set), Counter()
    for i, old in before.items():
        new = after[i]
        assert new["n_chars"] == len(new["text"]) and {**old.asDict(), "text": 0, "n_chars": 0} == {**new.asDict(), "text": 0, "n_chars": 0}
        rest = [old["text"], new["text"]]
        for kind, pattern in PERSONAL.items():
            values = [re.findall(pattern, t) for t in rest]
            assert len(values[0]) == len(values[1])
            for a, b in zip(*values):
                assert valid(kind, a) == valid(kind, b) == (a != b)
                links[kind, a].add(b)
                seen[kind] += a != b
            rest = [re.sub(pattern, "#", t) for t in rest]
        assert rest[0] == rest[1]
    assert all(len(x) == 1 for x in links.values()) and len({(k, *x) for (k, _), x in links.items()}) == len(links)
    assert all(seen[kind] for kind in ("phone", "card", "ip", "email")), seen


def test_stage_of_mixing(stages):
    before, after = stages["mixing"]
    docs = {r["doc_id"]: r for r in before.collect()}
    taken, copies, sums = Counter(), defaultdict(list), Counter()
    for r in after.collect():
        old, words = docs[r["doc_id"]], r["text"].split()
        assert r["n_chars"] == len(r["text"]) and words and {**old.asDict(), "text": 0, "n_chars": 0} == {**r.asDict(), "text": 0, "n_chars": 0}
        taken[r["doc_id"]] += len(words)
        sums[r["source"]] += len(words)
        copies[r["doc_id"]].append(words)
    for i, rows in copies.items():
        # Each row's words stand in this order in the row before, and in the document.
        for more, less in zip([docs[i]["text"].split(), *sorted(rows, key=len, reverse=True)], sorted(rows, key=len, reverse=True)):
            at = iter(more)
            assert all(w in at for w in less)
    assert {r["doc_id"]: r["taken"] for r in mixing.mixed(before).collect() if r["taken"]} == dict(taken)
    order = sorted({r["source"] for r in docs.values()})
    sizes = [sum(len(r["text"].split()) for r in docs.values() if r["source"] == o) for o in order]
    for o, target in zip(order, water(sizes, [1 + i % 3 for i in range(len(order))], 3)):
        assert abs(sums[o] - target) <= 64 + 0.02 * target


def test_stage_of_packing(stages):
    from tokenizers import Tokenizer

    before, after = stages["packing"]
    tokenizer, want = Tokenizer.from_file(packing.tokenizer_path()), Counter()
    for r in before.collect():
        ids = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[r["doc_id"], piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    placed = after.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed) == want
    end = Counter()
    for r in sorted(placed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == end[r["sequence_id"]]
        end[r["sequence_id"]] += r["length"]
    assert max(end.values()) <= 2048 and sorted(end) == list(range(len(end)))
