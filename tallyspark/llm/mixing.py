"""Mixing sources to target weights, in fixed-length blocks of words.

Every source's documents, in a hashed order, form one stream of words that is
cut into blocks. The mix has a number of output slots, dealt over shards. Each
slot draws its source with the planned shares, by a seeded hash of its number:
a shard's counts of sources are a multinomial draw. Over all shards the counts
miss the plan by a small random share; that many slots are handed on to sources
that were drawn too seldom, so the totals are those planned and no source is
taken more often than allowed. A source's k-th slot is mapped through a pseudorandom permutation of
its block numbers, a new one for each pass over the source, and slots are
joined with blocks by (source, block number).

Nulls: a null text has no words; a null source is a source of its own, last in
order. Empty texts and sources take nothing. Rows that are alike in id, source
and text are interchangeable; each is a document of its own. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import pinned, running_offsets, word_count

_ROUNDS = 24


@dataclass(frozen=True)
class Mix:
    weights: Sequence[float] = (1, 2, 3)  # by the sources' order, repeating
    most: int = 3  # a source is taken at most so many times
    block_words: int = 64
    shard_slots: int = 4096
    seed: int = 20


def shuffled(index: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0..n-1 for any n: swap-or-not rounds."""

    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        swap = F.xxhash64(*key, r, F.greatest(x, other), F.lit(1)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), index.cast("long"), step)


def source_targets(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, source_size, target) and block and slot numbers, one row per source.

    ``target`` shares the size of all sources by weight. Where that is more
    than ``most`` times a source's size, the excess goes to the others by
    weight: in the order of size per weight, the sources that are full come
    first, and the rest share what these leave.
    """
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    per = sized.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    # One row per source from here on, so windows over all of them are small.
    ranked = per.withColumn("_src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumns(
        {"_weight": F.element_at(weights, F.col("_src") % len(mix.weights) + 1), "_most": F.col("source_size") * mix.most}
    )
    filling = Window.orderBy(F.col("_most") / F.col("_weight"), "_src")
    everything = Window.partitionBy()
    ranked = ranked.withColumns(
        {
            "_total": F.sum("source_size").over(everything),
            "_before": F.coalesce(F.sum("_most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_open": F.sum("_weight").over(filling.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    ranked = ranked.withColumn("_level", (F.col("_total") - F.col("_before")) / F.col("_open"))
    level = F.max(F.when(F.col("_level") * F.col("_weight") <= F.col("_most"), F.col("_level"))).over(everything)
    ranked = ranked.withColumn("_share", level)
    ranked = ranked.withColumn(
        "target", F.least(F.col("_most").cast("double"), F.coalesce(F.col("_share") * F.col("_weight"), F.col("_most").cast("double")))
    )
    blocks = F.ceil(F.col("source_size") / mix.block_words)
    ranked = ranked.withColumn("_blocks", blocks)
    # So many slots as blocks of mean length fill the target.
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("_blocks") / F.col("source_size"))).otherwise(0)
    ranked = ranked.withColumn("_slots", slots.cast("long"))
    before = Window.orderBy("_src").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("_first", F.coalesce(F.sum("_slots").over(before), F.lit(0)).cast("long"))
    return ranked.select("source", "source_size", "target", "_src", "_blocks", "_slots", "_first")


def slots(targets: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(shard, slot, _src, index, block): every slot of the mix and the block it takes."""
    spark = targets.sparkSession
    n, sources = targets.agg(F.coalesce(F.sum("_slots"), F.lit(0)), F.count(F.lit(1))).first()
    # The numbers to draw are cut into equal cells; a source stands in each cell that its range meets.
    cell = max(1, n // max(1024, 4 * sources))
    ranges = targets.where("_slots > 0").select(
        "_src", "_first", "_slots",
        F.explode(F.sequence(F.floor(F.col("_first") / cell), F.floor((F.col("_first") + F.col("_slots") - 1) / cell))).alias("_cell"),
    )
    # Each slot draws for itself, so the counts of a shard are a multinomial draw with the sources' shares.
    draw = F.pmod(F.xxhash64(F.lit(mix.seed), F.col("id")), F.lit(max(1, n)))
    drawn = spark.range(n).select(F.col("id").alias("_slot"), draw.alias("_draw")).withColumn("_cell", F.floor(F.col("_draw") / cell))
    taken = drawn.join(ranges, "_cell").where("_draw >= _first AND _draw < _first + _slots").select("_slot", "_src", F.col("_slots").alias("_planned"))
    taken = taken.withColumn("_order", F.xxhash64("_slot", F.lit(1)))  # so that no shard has the last numbers
    numbered = pinned(running_offsets(taken, ["_src"], F.xxhash64("_slot"), ["_order", "_slot"], {"index": F.lit(1)}, 5_000), "mix-draws")
    # Over all shards a source is drawn a little more or less often than planned. Slots beyond the plan,
    # by the last numbers, go to the numbers that other sources lack: the totals come out as planned.
    over = numbered.where("index >= _planned").select("_slot")
    drawn_of = numbered.groupBy("_src").agg(F.count(F.lit(1)).alias("_drawn"))
    lacking = targets.join(drawn_of, "_src", "left").withColumn("_drawn", F.coalesce("_drawn", F.lit(0))).where("_drawn < _slots")
    lacking = lacking.select("_src", F.explode(F.sequence(F.col("_drawn"), F.col("_slots") - 1)).alias("index"))
    over = running_offsets(over, [], F.xxhash64("_slot"), ["_slot"], {"_n": F.lit(1)}, 5_000)
    lacking = running_offsets(lacking, [], F.xxhash64("_src", "index"), ["_src", "index"], {"_n": F.lit(1)}, 5_000)
    every = numbered.where("index < _planned").select("_slot", "_src", "index").union(over.join(lacking, "_n").select("_slot", "_src", "index"))
    known = every.join(targets.select("_src", "_blocks"), "_src")
    turn = F.floor(F.col("index") / F.col("_blocks"))
    place = shuffled(F.col("index") % F.col("_blocks"), F.col("_blocks"), F.lit(mix.seed), F.col("_src"), turn)
    return known.select(
        F.floor(F.col("_slot") / mix.shard_slots).alias("shard"), (F.col("_slot") % mix.shard_slots).alias("slot"), "_src", "index", place.alias("block")
    )


def shard_counts(drawn: DataFrame) -> DataFrame:
    """The counts drawn: slots per shard and source."""
    return drawn.groupBy("shard", "_src").agg(F.count(F.lit(1)).alias("slots"))


def _pieces(rows: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """(documents with their source's figures, their pieces with how often each is taken)."""
    spark = rows.sparkSession
    targets = pinned(source_targets(rows, mix), "mix-targets")
    joined = rows.alias("l").join(targets.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
    known = joined.select("l.*", "r.source_size", "r.target", "r._src")
    placed = running_offsets(known, ["_src"], F.col("_mark"), ["_mark", "_row"], {"_start": F.col("size")}, 2_000)
    length = mix.block_words
    first, last = F.floor(F.col("_start") / length), F.floor((F.col("_start") + F.col("size") - 1) / length)
    cut = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    times = slots(targets, mix).groupBy("_src", "block").agg(F.count(F.lit(1)).alias("_times"))
    pieces = cut.join(times, ["_src", "block"], "left").withColumns(
        {
            "_from": F.greatest(F.col("block") * length - F.col("_start"), F.lit(0)),
            "_to": F.least((F.col("block") + 1) * length - F.col("_start"), F.col("size")),
            "_times": F.coalesce("_times", F.lit(0)),
        }
    )
    return known, pieces


def _sized(docs: DataFrame, *columns: Column) -> DataFrame:
    """Id, source, size, a hash that orders the documents, a number for the row, and further columns."""
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), *columns,
        F.xxhash64("doc_id", "source", "text").alias("_mark"), F.monotonically_increasing_id().alias("_row"),
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes from it."""
    rows = pinned(_sized(docs), "mix-sizes")
    _, pieces = _pieces(rows, mix)
    each = pieces.groupBy("_row", "doc_id", "source", "size", "source_size", "target")
    taken = each.agg(F.coalesce(F.sum((F.col("_to") - F.col("_from")) * F.col("_times")), F.lit(0)).cast("long").alias("taken"))
    return taken.drop("_row")


# A word with the blanks after it.
_SPACED = r"(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+)"


def _blocks(text: Column, start: Column, length: int) -> Column:
    """The text in blocks of its source's stream, in which it starts at that word.

    The first block is filled by as many words as it still takes; blanks before
    the first word belong to it.
    """
    room = F.format_string("{1,%d}", length - start % length)
    pattern = F.concat(F.lit(r"^[\x20\x09-\x0D]*+" + _SPACED), room, F.lit(f"|{_SPACED}{{1,{length}}}"))
    return F.regexp_extract_all(text, pattern, F.lit(0))


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: one row for each time that words of a document are taken.

    The k-th row of a document has the words of those of its blocks that are
    taken k times or more, in order, with the blanks between them. Columns are
    those of ``docs``; ``n_chars`` is that of the new text.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")  # names may clash with ours
    base = pinned(_sized(docs, whole), "mix-documents")  # the text once, inside
    _, pieces = _pieces(base.select("doc_id", "source", "size", "_mark", "_row"), mix)
    plans = pieces.where("_times > 0").groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("block", "_times"))).alias("_plan"), F.max("_times").alias("_most"), F.first("_start").alias("_start")
    )
    cut = base.join(plans, "_row").withColumn("_blocks", _blocks(F.col("_doc.text"), F.col("_start"), mix.block_words))
    # Spark keeps what stands below an explode: in a lambda the blocks would be cut anew for each of them.
    rows = cut.select("_doc", "_blocks", "_plan", "_start", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_most"))).alias("_copy"))
    parts = F.filter("_plan", lambda p: p["_times"] >= F.col("_copy"))
    first = F.floor(F.col("_start") / mix.block_words)
    taken = F.transform(parts, lambda p: F.element_at("_blocks", (p["block"] - first + 1).cast("int")))
    rows = rows.withColumn("_text", F.array_join(taken, ""))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])
