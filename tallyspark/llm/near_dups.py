"""Near-duplicate groups by MinHash with tensored tables.

A document's set is that of its distinct five-word shingles, as 64-bit hashes.
Two collections of keys, each key made of a few minhashes, are computed per
set; a table's key is a pair of one key from either collection. So ``m`` keys
on each side, 2 * m * k minhashes in all, serve m * m tables, where separate
tables would take 2 * m * m * k. A pair of sets of similarity s shares a table
with probability (1 - (1 - s^k)^m)^2: 0.9997 at 0.75 with the defaults.

Sets that are alike become one node first, and buckets of the same nodes one
bucket. In a few rounds every node is held against one or four heads of its
buckets, those that most nodes meet before others, verified on the full sets,
and links join nodes to components; near copies of one text thus find each
other through the one in their middle, whatever the order of rows. Only
buckets with two components or more stay open. For these, all pairs that are
left are verified: those of different components that the exact bounds on the
intersection (by set size, by shingles that no other open node has, and by bits
that the other's sketch lacks) do not rule out. So every pair of a bucket has been verified, is ruled out, or is
connected already: no bucket is capped. Table keys are made in two steps, first
by the first collection; only nodes that meet another there get their pairs.

Nulls: a null text is an empty one; a text without a word has an empty set and
is linked with nothing. A null id is never a component's smallest unless all
of its ids are null. Repeated rows are copies. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tallyspark.llm.common import BLANKS, Memo, bucketed, pinned, released, word_hashes
from tallyspark.llm.components import components
from tallyspark.llm.shipped import in_bitmap, open_shipped, ship_bitmap


@dataclass(frozen=True)
class Tables:
    words: int = 5
    share: int = 75  # linked if 100 * intersection >= share * union
    keys: int = 16  # m: keys in each of the two collections
    hashes: int = 3  # k: minhashes in a key
    rounds: int = 4  # in which nodes are held against few others before the rest is
    # Pairs are dropped unverified if fewer minhashes agree than would for one
    # linked pair in 10^7 or less: half of 96 where three quarters are expected.
    least_agreeing: int = 48


_LONGS = ArrayType(LongType())
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: str | None, words: int = 5, hashes: Memo | None = None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text: its whole word sequence if that is shorter.

    ``hashes`` are the word hashes that the caller's task keeps.
    """
    hashes = word_hashes() if hashes is None else hashes
    parts = text.encode().lower().split() if text else []  # bytes: A-Z are lowered, ASCII blanks part words
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = out * _ODD + h[i : len(h) - n + 1 + i]
    out ^= out >> np.uint64(32)
    out *= _MIX
    out ^= out >> np.uint64(32)
    return np.unique(out)


def _functions(tables: Tables) -> np.ndarray:
    count = 2 * tables.keys * tables.hashes
    odd = np.random.default_rng(5).integers(1, 1 << 63, (2, count), np.int64).astype(np.uint64)
    odd[0] |= np.uint64(1)
    return odd


def signature(found: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """The minhash of the set by each function, in slices that bound the memory."""
    out = np.full(functions.shape[1], np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):
        part = found[at : at + 4096]
        np.minimum(out, (functions[0][:, None] * part + functions[1][:, None]).min(axis=1), out=out)
    return out


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    flat = pa.array(np.ascontiguousarray(values).reshape(-1).view(np.int64))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (rows + 1) * width, width), pa.int32()), flat)


def _signer(tables: Tables):
    m, k = tables.keys, tables.hashes

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions, hashes = _functions(tables), word_hashes()
        for batch in batches:
            digests, sizes, all_mins = [], [], np.zeros((batch.num_rows, 2 * m * k), np.uint64)
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                found = shingles(text, tables.words, hashes)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                if len(found):
                    all_mins[i] = signature(found, functions)
            keys = np.zeros((batch.num_rows, 2 * m), np.uint64)
            for j in range(k):
                keys = (keys ^ all_mins[:, j::k]) * _ODD
                keys ^= keys >> np.uint64(29)
            # 16 bits of each minhash are enough to estimate how many agree.
            short = (all_mins * _MIX >> np.uint64(48)).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    _lists(keys[:, :m]), _lists(keys[:, m:]), pa.array([r.tobytes() for r in short], pa.binary()),
                ],
                [*batch.schema.names[:-1], "n_shingles", "digest", "left_keys", "right_keys", "mins"],
            )

    return sign


def signed(docs: DataFrame, keep: Sequence[str], tables: Tables = Tables()) -> DataFrame:
    """The kept columns with set size, set digest, the two collections of keys, and short minhashes."""
    rows = docs.select(*[f"`{c}`" for c in keep], F.monotonically_increasing_id().alias("_row"), F.col("text").alias("_text"))
    schema = rows.drop("_text").schema.add("n_shingles", "long").add("digest", "binary")
    schema = schema.add("left_keys", _LONGS).add("right_keys", _LONGS).add("mins", "binary")
    return rows.mapInArrow(_signer(tables), schema)


def sketch(found: np.ndarray) -> np.ndarray:
    """The set's hashes as bits, some eight for each up to 16,384, in whole longs.

    A bit of one set that another lacks stands for one shingle at least that the other lacks.
    """
    bits = 1 << min(14, max(9, (8 * len(found) - 1).bit_length()))
    mask = np.zeros(bits, bool)
    mask[(found & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(mask, bitorder="little").view(np.int64)


def _sets(tables: Tables, wanted: str):
    """The sets of the texts whose place stands in the bitmap."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bitmap = word_hashes(), open_shipped(wanted)["bitmap"]
        for batch in batches:
            texts = batch.column(1).filter(pa.array(in_bitmap(bitmap, batch.column(0).to_numpy())))
            for at in range(0, len(texts), 256):
                found = [shingles(t, tables.words, hashes) for t in texts.slice(at, 256).to_pylist()]
                found = [f for f in found if len(f)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([xxhash.xxh3_128_digest(f.tobytes()) for f in found], pa.binary()),
                        pa.array([f.tobytes() for f in found], pa.binary()),
                        pa.array([sketch(f) for f in found], pa.list_(pa.int64())),
                    ],
                    ["digest", "shingles", "sketch"],
                )

    return make


def _verifier(share: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, a, b = (batch.column(i) for i in range(4))
            linked = []
            for i in range(batch.num_rows):
                x = np.frombuffer(a[i].as_buffer(), np.uint64)
                y = np.frombuffer(b[i].as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= share * (len(x) + len(y) - both))
            mask = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([u.filter(mask), v.filter(mask)], ["u", "v"])

    return verify


def _table_keys(nodes: DataFrame) -> DataFrame:
    """(key, slot, node, weight) for the buckets with two nodes or more.

    The slot numbers the table; the weight is the bucket's nodes, those of all buckets like it included.
    """
    firsts = nodes.select("node", "right_keys", F.posexplode("left_keys").alias("i", "left"))
    # A node stays with those of its first keys that another node has, too.
    met = firsts.groupBy("i", "left").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("i", "left")
    shared = firsts.select("node", "i", "left").join(met, ["i", "left"]).join(nodes.select("node", "right_keys"), "node")
    pairs = shared.select("node", "i", "left", F.size("right_keys").alias("m"), F.posexplode("right_keys").alias("j", "right"))
    slot = (F.col("i") * F.col("m") + F.col("j")).alias("slot")
    keyed = pinned(pairs.select(F.xxhash64("i", "left", "j", "right").alias("key"), slot, "node"), "table-keys")
    # Buckets of the same nodes are alike; the one of the first table is enough.
    alike = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x")]
    full = keyed.groupBy("key").agg(F.min("slot").alias("slot"), *alike).where("n > 1")
    full = full.groupBy("n", "s", "x").agg(F.min_by("key", F.struct("slot", "key")).alias("key"), (F.col("n") * F.count(F.lit(1))).alias("weight"))
    buckets = pinned(keyed.join(full.select("key", "weight"), "key"), "buckets")
    released(keyed)
    return buckets


def _agreeing(a: Column, b: Column, hashes: int) -> Column:
    """How many of the short minhashes are the same."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(hashes - 1)), F.lit(0),
        lambda n, i: n + F.when(F.substring(a, i * 2 + 1, F.lit(2)) == F.substring(b, i * 2 + 1, F.lit(2)), 1).otherwise(0),
    )


def _buckets(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class _Linker:
    """Verifies pairs of nodes on their full sets, each pair once."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, tables: Tables) -> None:
        self.docs, self.nodes, self.tables = docs, nodes, tables
        self.sets: DataFrame | None = None

    def prepare(self, members: DataFrame) -> None:
        """The sets of the nodes, from their texts.

        Texts don't move: a bitmap of the nodes' ids, with some false hits, says
        whose sets are made, and sets that no node has fall out by their digest.
        """
        wanted = members.join(self.nodes.select("node", "doc_id", "digest"), "node")
        bits = min(26, max(16, (16 * members.count()).bit_length()))
        place = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << bits) - 1)).alias("place")
        bitmap = ship_bitmap(wanted.select(place), bits)
        if bitmap is None:
            return
        made = self.docs.select(place, "text").mapInArrow(_sets(self.tables, bitmap), "digest binary, shingles binary, sketch array<long>")
        # An id may stand for several texts, and a set for several ids of equal digests.
        found = made.dropDuplicates(["digest"]).join(wanted.select("node", "digest"), "digest").select("node", "shingles", "sketch")
        self.sets = bucketed(found.repartition(_buckets(found), "node"), "sets", "node")

    def links(self, pairs: DataFrame) -> DataFrame:
        facts = self.nodes.select("node", "n_shingles", "mins")
        a = facts.select(F.col("node").alias("u"), F.col("n_shingles").alias("n_u"), F.col("mins").alias("mins_u"))
        b = facts.select(F.col("node").alias("v"), F.col("n_shingles").alias("n_v"), F.col("mins").alias("mins_v"))
        near = pairs.join(a, "u").where("u <> v").join(b, "v")
        near = near.where(100 * F.least("n_u", "n_v") >= self.tables.share * F.greatest("n_u", "n_v"))
        count = 2 * self.tables.keys * self.tables.hashes
        near = near.where(_agreeing(F.col("mins_u"), F.col("mins_v"), count) >= self.tables.least_agreeing).select("u", "v")
        x = self.sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
        y = self.sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
        full = near.join(x, "u").join(y, "v").select("u", "v", "a", "b")
        return pinned(full.mapInArrow(_verifier(self.tables.share), "u long, v long"), "links")


def _merge(groups: DataFrame, links: DataFrame) -> DataFrame:
    """(node, degree, group) after the links have joined groups; what it was made of is gone."""
    a = groups.select(F.col("node").alias("u"), F.col("group").alias("gu"))
    b = groups.select(F.col("node").alias("v"), F.col("group").alias("gv"))
    between = links.join(a, "u").join(b, "v").select(F.col("gu").alias("u"), F.col("gv").alias("v"))
    joined = components(between)
    moved = groups.join(joined.withColumnRenamed("node", "group"), "group", "left")
    merged = pinned(moved.select("node", "degree", F.coalesce("label", "group").alias("group")), "groups")
    released(groups, links, joined)
    return merged


def _open(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, slot, node, degree, group) of the buckets that hold two groups or more."""
    known = rows.select("key", "slot", "node").join(groups, "node")
    split = known.groupBy("key").agg(F.min("group").alias("a"), F.max("group").alias("b")).where("a <> b").select("key")
    return pinned(known.join(split, "key"), "open-buckets")


def _few(rows: DataFrame, turn: int, count: int) -> DataFrame:
    """(u, v): every node with one node for each of ``count`` orders, the first among the heads of its buckets.

    In the first two turns a bucket's head is the node of the highest degree: the text in the middle of its
    near copies, linked with more of them than one that has changes of its own. A node is held against
    the highest of its heads, then against others of them. Later heads are any nodes.
    """
    orders = range(count)

    def any_first(node: str, p: int) -> Column:
        return F.xxhash64(node, F.lit(4 * turn + p))

    def order(p: int) -> Column:
        first = -F.col("degree") if turn < 2 else any_first("node", p)
        return F.struct(first.alias("o"), F.col("node").alias("v"), F.col("group").alias("g"))

    def choice(p: int) -> Column:
        first = any_first(f"h{p}.v", p) if turn == 1 else F.col(f"h{p}.o")
        return F.struct(first.alias("o"), F.col(f"h{p}.v").alias("v"))

    heads = rows.groupBy("key").agg(*[F.min(order(p)).alias(f"h{p}") for p in orders])
    met = rows.join(heads, "key")
    each = met.groupBy("node").agg(*[F.min(F.when(F.col(f"h{p}.g") != F.col("group"), choice(p))).alias(f"h{p}") for p in orders])
    pairs = each.select("node", F.explode(F.array(*[F.col(f"h{p}.v") for p in orders])).alias("head")).where("head IS NOT NULL")
    return pairs.select(F.least("node", "head").alias("u"), F.greatest("node", "head").alias("v")).distinct()


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            found = [np.frombuffer(b.as_buffer(), np.int64) for b in batch.column(1).slice(at, 256)]
            nodes = np.repeat(batch.column(0).slice(at, 256).to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.concatenate(found))], ["node", "token"])


def _missing(a: Column, b: Column) -> Column:
    """At least so many shingles of the first sketch's set are not in the second's.

    The longer sketch is folded once; 0 is said of lengths that differ by more.
    """
    length = F.least(F.size(a), F.size(b))

    def folded(s: Column) -> Column:
        halves = F.zip_with(F.slice(s, 1, length), F.slice(s, length + 1, length), lambda x, y: x.bitwiseOR(y))
        return F.when(F.size(s) == length, s).otherwise(halves)

    bits = F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.when(F.greatest(F.size(a), F.size(b)) <= 2 * length, F.aggregate(bits, F.lit(0), lambda n, x: n + x)).otherwise(0)


def _rest(rows: DataFrame, nodes: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """(u, v): the pairs of open buckets that may be linked and aren't connected.

    Close nodes meet in many tables; a pair is made in the first of them only.
    That bucket is there: of alike buckets the first table's stays, and one
    that isn't open has both nodes in one group.
    """
    members = rows.select("node").distinct()
    tokens = sets.select("node", "shingles").join(members, "node", "left_semi").mapInArrow(_tokens, "node long, token long")
    lone = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
    lone = lone.groupBy("node").agg(F.count(F.lit(1)).alias("lone"))
    known = nodes.select("node", "n_shingles", "left_keys", "right_keys")
    facts = members.join(known, "node").join(sets.select("node", "sketch"), "node").join(lone, "node", "left")
    common = (F.col("n_shingles") - F.coalesce("lone", F.lit(0))).alias("common")
    facts = facts.select("node", F.col("n_shingles").alias("n"), common, "left_keys", "right_keys", "sketch")
    # The intersection has common shingles only.
    able = pinned(facts.where(100 * F.col("common") >= share * F.col("n")), "able")
    a = rows.join(able, "node").alias("a")
    b = rows.join(able, "node").alias("b")
    most = F.least("a.common", "b.common")
    # Solved for the intersection: what is dear to compute must stand once, or Spark computes it first for all.
    least = share * (F.col("a.n") + F.col("b.n"))
    a_not_b, b_not_a = (_missing(F.col(f"{x}.sketch"), F.col(f"{y}.sketch")) for x, y in ("ab", "ba"))

    def first(keys: str) -> Column:
        return F.array_position(F.zip_with(f"a.{keys}", f"b.{keys}", lambda x, y: x == y), True) - 1

    # Equal keys are of one table; with the slot on either side, both are one exchange.
    near = (
        (F.col("a.key") == F.col("b.key")) & (F.col("a.slot") == F.col("b.slot")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.group") != F.col("b.group"))
        & (100 * most >= share * (F.col("a.n") + F.col("b.n") - most))
        & (F.col("a.slot") == first("left_keys") * F.size("a.right_keys") + first("right_keys"))
        & ((100 + share) * (F.col("a.n") - a_not_b) >= least)
        & ((100 + share) * (F.col("b.n") - b_not_a) >= least)
    )
    pairs = pinned(a.join(b, near).select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct(), "rest")
    released(able)
    return pairs


def groups_of(docs: DataFrame, nodes: DataFrame, tables: Tables = Tables()) -> DataFrame:
    """(node, group) for the nodes that share a bucket with another."""
    rows = _table_keys(nodes)
    linker = _Linker(docs, nodes, tables)
    groups = pinned(rows.groupBy("node").agg(F.sum("weight").alias("degree")).withColumn("group", F.col("node")), "groups")
    linker.prepare(groups.select("node"))
    every: list[DataFrame] = []  # the pairs that were verified
    for turn in range(tables.rounds + 1):
        rows, old = _open(rows, groups), rows
        released(old)
        if rows.isEmpty():
            break
        last = turn == tables.rounds
        new = found = _rest(rows, nodes, linker.sets, tables.share) if last else _few(rows, turn, 4 if turn else 1)
        if every:  # all of them at once: each join more would pass all pairs on again
            new = new.join(reduce(DataFrame.union, every), ["u", "v"], "left_anti")
        every.append(pinned(new, "pairs"))
        released(found)
        groups = _merge(groups, linker.links(every[-1]))
    released(rows, linker.sets, *every)
    return groups


def near_duplicates(docs: DataFrame, keep: Sequence[str] = ("doc_id",), tables: Tables = Tables()) -> DataFrame:
    """Per row the kept columns, ``n_shingles``, ``component_id`` (the smallest doc_id that it
    is connected with) and ``first`` (true for the one row of each component that stays)."""
    signatures = pinned(signed(docs, list(keep), tables), "signatures")
    some = signatures.where("n_shingles > 0")
    reps = pinned(some.groupBy("digest").agg(F.min("_row").alias("node"), F.min("doc_id").alias("least")), "representatives")
    dealt = some.repartition(_buckets(some), "_row")
    nodes = bucketed(
        dealt.join(reps.select(F.col("node").alias("_row")), "_row", "left_semi")
        .select(F.col("_row").alias("node"), "doc_id", "n_shingles", "digest", "left_keys", "right_keys", "mins"),
        "nodes", "node",
    )
    rows = pinned(signatures.drop("left_keys", "right_keys", "mins"), "digests")
    released(signatures)
    groups = groups_of(docs, nodes, tables)
    labelled = reps.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    placed = pinned(rows.join(labelled.select("digest", "group"), "digest", "left").withColumn("group", F.coalesce("group", "_row")), "placed")  # an empty set is alone
    released(nodes, rows, reps, groups)
    # Nulls last: the smallest id is a known one if there is any.
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_row")).alias("s")
    heads = placed.groupBy("group").agg(smallest)
    return placed.join(heads, "group").select(
        *[f"`{c}`" for c in keep], "n_shingles", F.col("s.doc_id").alias("component_id"), (F.col("_row") == F.col("s._row")).alias("first")
    )


def deduplicated(docs: DataFrame, tables: Tables = Tables()) -> DataFrame:
    """One document of each component: the row of the smallest id.

    Texts without a word are nobody's copies and stay. Of rows with one id and
    one text the one with the smallest hash of the further columns stays.
    """
    marks = {"_a": F.xxhash64("text"), "_b": F.xxhash64(F.lit(1), "text")}
    blank = F.btrim(F.coalesce("text", F.lit("")), F.lit(BLANKS)) == ""
    found = near_duplicates(docs.select("doc_id", "text", *[c.alias(n) for n, c in marks.items()]), ["doc_id", *marks], tables)
    firsts = pinned(found.where("first AND n_shingles > 0").select("doc_id", *marks), "firsts")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")  # names may clash with ours
    rest = docs.where(~blank).select(whole, F.col("doc_id").alias("_id"), *[c.alias(n) for n, c in marks.items()])
    known = F.col("l._id").eqNullSafe(F.col("r.doc_id"))
    stays = rest.alias("l").join(firsts.alias("r"), known & (F.col("l._a") == F.col("r._a")) & (F.col("l._b") == F.col("r._b")), "left_semi")
    if stays.count() > firsts.count():  # ids are repeated
        others = [f"_doc.`{f.name}`" for f in docs.schema.fields if "map" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
        order = Window.partitionBy("_id", *marks).orderBy(F.xxhash64(*others))
        stays = stays.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    out = stays.select("_doc").union(docs.where(blank).select(whole))
    return out.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
