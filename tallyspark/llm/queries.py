"""The operators on the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import alignment, language, lexicon, mixing, near_dups, packing, phrases, pii, quality_mil, quality_rules, sharding, topk, url_filter
from tallyspark.llm.common import hold_out, table
from tallyspark.plans.catalogue import Catalogue

CATALOGUE = Catalogue()
query = CATALOGUE.query


@query()
def op2_mixed_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Words that a mix by source weights takes from each document."""
    return mixing.mixed(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op4_balanced_shards(spark: SparkSession, sf: str) -> DataFrame:
    """24 contiguous shards of nearly equal bytes."""
    text = F.col("text")
    narrow = table(spark, sf, "documents").select(
        "doc_id", sharding.text_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32")
    )
    placed = sharding.balanced(narrow, ["doc_id", "text_crc32", "size"], "size", 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query()
def op5_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents linked by shingle similarity."""
    found = near_dups.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query()
def op6_packed_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as token pieces in sequences of 2048."""
    cut = packing.pieces(table(spark, sf, "documents"), packing.tokenizer_path(), ["doc_id"])
    narrow = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.place(narrow)


# Fixed values of the task: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query(
    r"""
    WITH parts AS (
      SELECT page_id,
             translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
      FROM pages),
    rules(rule_host, rule_path, rule_verdict) AS (
      VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    judged AS (
      SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
             row_number() OVER (PARTITION BY p.rowid_ ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
      FROM (SELECT *, row_number() OVER () AS rowid_ FROM parts) p
      LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
    SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM judged WHERE place = 1
    """
)
def op7_url_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's URL against host and path rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query()
def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document by rank-order profiles."""
    docs = table(spark, sf, "documents")
    held_out = hold_out(F.col("doc_id"), 3, 1)
    learned = language.profiles(docs, ~held_out)
    judged = language.identify(docs.select("doc_id", "text"), learned, keep=["doc_id"])
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op1_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its personal data under format-preserving pseudonyms."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pii.pseudonyms(docs, pii.session_key(spark)).select("doc_id", "text", pii.replaced_count().alias("n_replaced"))


@query(
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vector FROM embeddings),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vector, c.vector) AS BIGINT) AS score
               FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
    ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
    SELECT * FROM ranked WHERE rank <= 10
    """
)
def op8_top_inner_products(spark: SparkSession, sf: str) -> DataFrame:
    """The ten rows of the largest inner product for every hundredth vector."""
    rows = topk.whole_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return topk.top_k(rows, F.col("vec_id") % 100 == 0)


@query()
def op3_quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document by attention over its passages."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held_out = hold_out(F.col("doc_id"), 5, 0)
    model = quality_mil.learn(docs, labels, "quality", ~held_out)
    rows = quality_mil.scored(docs, model, ["doc_id"])
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Base statistics and the n-gram likelihood verdict of every document."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = quality_rules.judged(docs, quality_rules.labelled(docs, table(spark, sf, "labels")))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


@query()
def op13_lexicon_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every text's ids by the lexicon of the corpus, and the text of the ids."""
    path = packing.tokenizer_path("byte_bpe_50k.json")
    ids = lexicon.encoded(table(spark, sf, "documents"), path, ["doc_id"])
    back = lexicon.decoded(ids, path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op12_aligned_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """How two tokenizers' tokens of every text are linked, and how common these links are."""
    paths = packing.tokenizer_path("byte_bpe_50k.json"), packing.tokenizer_path("piece_bpe_32k.model")
    found = alignment.aligned(table(spark, sf, "documents").withColumn("doc_id", F.col("doc_id").cast("long")), *paths, ["doc_id"])
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


@query(
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents),
    worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
    grams AS (
      SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS p
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, (VALUES (1), (2), (3), (4), (5)) AS t(k))),
    often AS (SELECT lang, k, p, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
    split_ AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS w FROM often WHERE k > 1),
    covered AS (
      SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS p, max(a) AS longer
      FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM split_, (VALUES (2), (3), (4)) AS t(m) WHERE m < k) GROUP BY ALL),
    kept AS (SELECT s.* FROM split_ s LEFT JOIN covered c USING (lang, p) WHERE c.longer IS NULL OR 100 * c.longer < 100 * s.a),
    cuts AS (
      SELECT c.lang, c.p, a, n, j, l.f AS l, r.f AS r,
             CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
      FROM (SELECT *, unnest(range(1, k)) AS j FROM kept) c JOIN totals USING (lang)
      JOIN often l ON l.lang = c.lang AND l.p = array_to_string(c.w[1 : j], ' ')
      JOIN often r ON r.lang = c.lang AND r.p = array_to_string(c.w[j + 1 : c.k], ' ')),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score
    FROM lowest QUALIFY rank <= 2000
    """
)
def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return phrases.collocations(table(spark, sf, "documents").select("lang", "text"))
