"""URL filters: the longest rule that fits a URL gives its verdict.

A rule is a host and a path prefix. A URL is expanded into expressions, each a
suffix of its host at a label's edge joined with a prefix of its path of a
length that some rule has. Expressions meet rules on the first bytes of a
digest; the full digest confirms the match. Of the rules that fit, the longest
(host and path together, then the longer host) wins; equal rules that
contradict each other block.

Nulls: a null URL, and one without ``://``, has an empty host and path and
takes the default verdict, as does any URL that no rule fits. Rules with a null
or empty host fit nothing; a null path is an empty one. Repeated URLs are judged
once. Empty tables are fine on either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import ascii_lower

SHORT = 8  # hexadecimal digits of the short prefix: four bytes


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    # The first :// settles where the host begins, also when the path holds another.
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # A host has no slash, so the line break can't be taken for a part of it.
    return F.sha2(F.concat_ws("\n", host, path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (host and path of the rule that won, or null) and ``verdict``.

    ``rules`` has columns host, path and verdict.
    """
    known = rules.where("host <> ''").select(
        ascii_lower(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict"
    )
    # Of rules that say the same, one stays: block before allow.
    known = known.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    known = known.withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
    known = known.withColumn("short", F.substring("digest", 1, SHORT))
    # Lengths, not rules: no more than the longest rule path has characters.
    lengths = sorted(r[0] for r in known.select(F.length("rule_path")).distinct().collect())

    parts = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    each = parts.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    prefixes = F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))
    expanded = (
        each.withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode(prefixes))
        .withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    met = expanded.alias("e").join(known.alias("k"), "short").where("e.digest = k.digest")
    strength = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("all"), F.length("rule_host").alias("host"),
        F.concat("rule_host", "rule_path").alias("rule"), "verdict",
    )
    best = met.groupBy("host", "path").agg(F.max(strength).alias("best"))
    out = parts.join(best, ["host", "path"], "left")
    out = out.withColumns({"rule": F.col("best.rule"), "verdict": F.coalesce("best.verdict", F.lit(default))}).drop("best")
    return out.select(*[f"`{c}`" for c in pages.columns if c not in ("host", "path", "rule", "verdict")], "host", "path", "rule", "verdict")
