"""Quality rules: base statistics of a text, then a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed word n-grams (one word and two) are counted: the
raw corpus over all documents, the target over texts that are trusted (a
bounded sample of those labelled good). A document's score is the mean of
log p_target - log p_raw over its n-grams; below a fixed threshold it is not
kept. Everything runs as DataFrame expressions; counts are of a fixed number of
buckets whatever the corpus. A row looks its n-grams up in the list of ratios;
ratios are whole millionths, so sums do not depend on their order.

Nulls: a null text is an empty one. A text without a word has all statistics 0
and fails the base rules. Equal rows get equal answers. Labels that are null or
of unknown documents trust nothing; with nothing trusted all scores are 0. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import BLANKS, words

SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rules:
    least_words: int = 20
    most_repeated: int = 30  # per cent of the words
    window: int = 8
    buckets: int = 1 << 16
    # Nats per n-gram. 0 is a text that is as likely in the target as in the raw corpus.
    threshold: float = -0.1
    prior: float = 1.0  # added to each bucket's counts


def statistics(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add ``_words`` and the statistics of the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    symbols = F.regexp_count(text, F.lit(SYMBOLS))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    out = docs.withColumn("_words", words(F.col("text"))).withColumn("_lines", lines)
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": symbols.cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    return out.drop("_lines")


def repeated_words(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add ``n_repeat_words``: words in windows of ``window`` words that the text holds twice or more.

    Windows are compared by 64-bit hashes. Only texts that hold a window twice
    go through the sort that finds out where.
    """
    n = rules.window
    hashed = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    starts = F.sequence(F.lit(1), F.size("_hashes") - (n - 1))
    windows = F.when(F.size("_hashes") >= n, F.transform(starts, lambda i: F.xxhash64(F.slice("_hashes", i, n))))
    some = hashed.withColumn("_windows", F.coalesce(windows, F.array().cast("array<bigint>")))
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    some = some.withColumn("_placed", F.when(twice, placed).otherwise(none))
    # In sorted order equal windows are neighbours. (get() is null beyond either end.)
    again = F.filter(
        "_placed", lambda p, k: F.coalesce(F.get("_placed", k - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get("_placed", k + 1)["h"] == p["h"], F.lit(False))
    )
    some = some.withColumn("_again", F.sort_array(F.transform(again, lambda p: p["i"])))
    # A window covers its words up to where the next one starts.
    covered = F.transform("_again", lambda p, k: F.least(F.lit(n), F.coalesce(F.get("_again", k + 1) - p, F.lit(n))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    return some.withColumn("n_repeat_words", total).drop("_windows", "_placed", "_again")


def base_failed(rules: Rules = Rules()) -> Column:
    return (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.most_repeated * F.col("n_words"))


def labelled(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 4_000) -> DataFrame:
    """The texts of at most ``most`` documents labelled 1, picked by a hash of the id, to be the target."""
    good = labels.where(F.col(label) == 1).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # No more rows than the sample may have, so sending them to every task is safe.
    return docs.join(F.broadcast(good), "doc_id", "left_semi").select("text")


def _grams() -> Column:
    """Hashes of a text's words and pairs of neighbouring words, from ``_hashes``."""
    later = F.slice("_hashes", F.lit(2), F.size("_hashes"))
    pairs = F.zip_with(F.slice("_hashes", F.lit(1), F.size(later)), later, lambda a, b: F.xxhash64(a, b))
    return F.concat("_hashes", pairs)


def _counts(docs: DataFrame, name: str, buckets: int) -> DataFrame:
    """(bucket, name): the n-grams of all texts."""
    hashed = docs.select(F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("_hashes"))
    grams = hashed.select(F.explode(_grams()).alias("gram")).select(F.pmod("gram", F.lit(buckets)).cast("int").alias("bucket"))
    return grams.groupBy("bucket").agg(F.count(F.lit(1)).alias(name))


def ratios(docs: DataFrame, target: DataFrame, rules: Rules = Rules()) -> list[int]:
    """log p_target - log p_raw of every bucket in millionths, p_raw from all documents; 0 where the target has no word."""
    every = docs.sparkSession.range(rules.buckets).select(F.col("id").cast("int").alias("bucket"))
    for rows, name in ((docs, "raw"), (target, "target")):
        every = every.join(_counts(rows, name, rules.buckets), "bucket", "left")
    found = every.fillna(0, ["raw", "target"]).orderBy("bucket").collect()  # as many as there are buckets
    raw, wanted = (sum(r[name] for r in found) + rules.prior * rules.buckets for name in ("raw", "target"))
    if not any(r["target"] for r in found):
        return [0] * rules.buckets
    return [
        round(1e6 * (math.log((r["target"] + rules.prior) / wanted) - math.log((r["raw"] + rules.prior) / raw))) for r in found
    ]


def judged(docs: DataFrame, target: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per document (doc_id) its statistics, ``base_failed``, ``score`` and ``kept``."""
    # A list of fixed length in the plan: each row looks its n-grams up itself.
    table = F.split(F.lit(",".join(map(str, ratios(docs, target, rules)))), ",").cast("array<int>")
    rows = repeated_words(statistics(docs.select("doc_id", "text"), rules), rules).withColumn("_found", _grams())
    total = F.aggregate("_found", F.lit(0).cast("long"), lambda s, g: s + F.get(table, F.pmod(g, F.lit(rules.buckets)).cast("int")))
    mean = F.when(F.size("_found") > 0, total / (1e6 * F.size("_found")))
    facts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # A filter on the result stops above the one row of inline. Pushed to the texts, it would work out each
    # array anew for each of its elements.
    out = rows.select("doc_id", F.inline(F.array(F.struct(*facts, mean.alias("score"))))).withColumn("base_failed", base_failed(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(0.0)) >= rules.threshold))
