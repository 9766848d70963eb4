"""N-gram Jaccard join by parity sketches, exact at its threshold.

A document's set of shingle hashes is folded into a bit sketch: each hash flips one bit, so the Hamming
distance of two sketches is at most the size of the sets' symmetric difference. A short block says little, so each
also has a code, the XOR of 32-bit numbers of its hashes, and agrees where bits and code do. Similarity t allows a
difference of (1 - t) / (1 + t) times the sum of the sizes. Sizes are cut into bands; for a level (one band,
or two neighbouring ones) the allowed difference d is known and the sketch has more than d blocks of 64 bits: two
linked documents agree in a block (pigeonhole). By the ring form of the principle, among b blocks some agreeing one is
followed by one that differs in at most 2 d / b bits, and by two that differ in at most 3 d / b, so
each row also carries the next two blocks, and
unrelated documents that agree in a block by chance are turned away where they meet. What is left is verified
on the exact sets.

Blank blocks, which no hash falls into, agree in all documents and would gather strangers. A set with z of them that may
differ from its partners in d' elements leaves them out if d' + z is less than b: with each blank block counted as
one more difference the principle holds as before (with d' + z for d), and so gives an agreeing block that is not blank,
in the partner neither. A few blocks beyond d + 1 are there for this; sets for which it fails use all their blocks.

Skew and links. Equal sets are one node. Within a block's key no pairs are emitted: in keys of up to five nodes
a row meets the first row of its key and the three before it, which is every pair. A key of six nodes and more is
cut by the two halves of the next block, one of which agrees in linked texts, then by parts of the block after it
in the same way; what still has six nodes and more gets a pivot by votes for nodes with most such keys; the keys of a group of near copies so share one pivot, and a
node meets that alone. What a set differs in from its pivot is its difference D; two
sets differ by |D| + |D'| - 2 |D and D'|, so texts that do not link by their sizes |D| alone must share elements
of D, at least a known number of them. Elements are ordered by how many differences under the pivot hold them, and
by the prefix principle linked texts meet on one of their rarest elements, at a rank that leaves room for enough
common ones. Only texts of different components are sought. Pairs left out lie in one component already or cannot
link, so the components are exact, and a large group of near copies costs in proportion to its rows and differences.
The blocks are exchanged in a fixed number of passes, so the executors hold a part of the block keys at a time.

Defined results: a null or empty text, or one without words, has the empty set, no link, and its own id as
component. Repeated rows and equal sets are in one component. A null id is a node like others and is named
by the smallest id it can reach, null if there is none. An empty table gives an empty result. Columns other
than id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paypanel.llm.shingles import mix, shingle_set
from paypanel.llm.tables import BROADCAST_BYTES, hinted
from paypanel.plans.stages import discard, few_rows_sent, written

BAND_GROWTH = 1.5
BEFORE = 3  # rows before it that a row meets in its key
SMALL_KEY = BEFORE + 2
SPARE = 32  # differences for which a level has one block to spare
PASSES = 4  # rounds in which the blocks are exchanged; each round's files are freed before the next


@dataclass(frozen=True)
class Rule:
    """Shingles of ``width`` words; documents link when high * common >= low * union."""

    width: int = 5
    low: int = 80
    high: int = 100

    def difference(self, sizes: int) -> int:
        """Largest symmetric difference of linked sets whose sizes add up to ``sizes``."""
        return (self.high - self.low) * sizes // (self.high + self.low)

    def largest_partner(self, size: int) -> int:
        return size * self.high // self.low


def bands(upto: int) -> list[int]:
    """Edges of the size bands up to beyond ``upto``: band k holds sizes edges[k] to edges[k + 1] - 1."""
    edges = [1]
    while len(edges) < 3 or edges[-2] <= upto:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_GROWTH)))
    return edges


def _blocks(difference: int) -> int:
    """Blocks of a level: one more than may differ, and a few to spare for blank ones."""
    return difference + 1 + -(-difference // SPARE)


@lru_cache(1 << 14)
def levels(size: int, rule: Rule) -> list[tuple[int, int]]:
    """(level, blocks) for a set of ``size``: 2k is band k with itself, 2k + 1 band k with band k + 1."""
    edges = bands(size)
    k = int(np.searchsorted(edges, size, "right")) - 1
    edges = [*edges, max(edges[-1] + 1, int(edges[-1] * BAND_GROWTH))]
    out = [(2 * k, _blocks(rule.difference(2 * (edges[k + 1] - 1))))]

    def cross(low: int) -> tuple[int, int]:
        a = edges[low + 1] - 1
        return 2 * low + 1, _blocks(rule.difference(a + min(edges[low + 2] - 1, rule.largest_partner(a))))

    if rule.largest_partner(size) >= edges[k + 1]:
        out.append(cross(k))
    if k > 0 and rule.largest_partner(edges[k] - 1) >= size:
        out.append(cross(k - 1))
    return out


@lru_cache(1 << 14)
def difference_at(size: int, level: int, rule: Rule) -> int:
    """Largest difference of a set of ``size`` from the linked sets that the level is for."""
    edges, k = bands(rule.largest_partner(size)), level // 2
    upper = edges[k + 2] - 1 if level % 2 and size < edges[k + 1] else edges[k + 1] - 1
    return rule.difference(size + min(upper, rule.largest_partner(size)))


def sketch(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Parity sketch: one 64-bit word per block."""
    words = np.zeros(blocks, np.uint64)
    np.bitwise_xor.at(words, _block(hashes, blocks), np.uint64(1) << (hashes & np.uint64(63)))
    return words


def codes(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Per block, the XOR of a 32-bit number of each of its hashes: equal where the block's hashes are equal."""
    out = np.zeros(blocks, np.uint32)
    np.bitwise_xor.at(out, _block(hashes, blocks), (mix(hashes) >> np.uint64(32)).astype(np.uint32))
    return out


def _block(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


SKETCHES = "n int, hi long, lo long, place long, level int, blank int, words array<long>, codes array<int>"


def sketch_task(rule: Rule):
    """Rows (keys..., text) to one row per document and level, in order: keys, size, digest, place, sketch words.

    ``blank`` counts the blocks without word and code if they are left out, and is 0 if all blocks are used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                source, sizes, high, low, place, level, blank, words, coded = [], [], [], [], [], [], [], [], []
                for i, text in enumerate(part.column(part.num_columns - 1).to_pylist()):
                    hashes = shingle_set(text or "", rule.width)
                    hi = np.bitwise_xor.reduce(mix(hashes + np.uint64(1))) if hashes.size else np.uint64(0)
                    lo = np.add.reduce(hashes) if hashes.size else np.uint64(0)
                    for j, (lev, blocks) in enumerate(levels(hashes.size, rule) if hashes.size else [(-1, 0)]):
                        source.append(i)
                        sizes.append(hashes.size)
                        high.append(hi)
                        low.append(lo)
                        place.append(j)
                        level.append(lev)
                        words.append(sketch(hashes, blocks))
                        coded.append(codes(hashes, blocks))
                        none = int(((words[-1] == 0) & (coded[-1] == 0)).sum())
                        blank.append(none if none and difference_at(hashes.size, lev, rule) + none < blocks else 0)
                ends = np.cumsum([0, *[w.size for w in words]]).astype(np.int32)
                flat = np.concatenate(words).view(np.int64) if words else np.zeros(0, np.int64)
                flat_codes = np.concatenate(coded).view(np.int32) if coded else np.zeros(0, np.int32)
                keys = [part.column(k).take(pa.array(source, pa.int64())) for k in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *keys,
                        pa.array(sizes, pa.int32()),
                        pa.array(np.array(high, np.uint64).view(np.int64)),
                        pa.array(np.array(low, np.uint64).view(np.int64)),
                        pa.array(place, pa.int64()),
                        pa.array(level, pa.int32()),
                        pa.array(blank, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat_codes)),
                    ],
                    names=[*batch.schema.names[:-1], "n", "hi", "lo", "place", "level", "blank", "words", "codes"],
                )

    return run


def set_task(rule: Rule):
    """Rows (text) to (hi, lo, hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = [shingle_set(t or "", rule.width) for t in batch.column(0).slice(at, 512).to_pylist()]
                sets = [s for s in sets if s.size]
                ends = np.cumsum([0, *[s.size for s in sets]]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                hi = np.array([np.bitwise_xor.reduce(mix(s + np.uint64(1))) for s in sets], np.uint64)
                lo = np.array([np.add.reduce(s) for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["hi", "lo", "hashes"],
                )

    return run


def _fits(rule: Rule, own: Column, other: Column, blocks: Column) -> Column:
    """Whether two rows of one key may link: sizes, and the blocks that follow."""
    total = own.n + other.n
    sizes = F.least(own.n, other.n) * rule.high >= F.greatest(own.n, other.n) * rule.low
    # a blank block that one of them leaves out counts as a difference
    allowed = F.floor(F.lit(rule.high - rule.low) * total / F.lit(rule.high + rule.low)) + F.greatest(own.blank, other.blank)
    one = F.bit_count(own.nxt.bitwiseXOR(other.nxt))
    two = one + F.bit_count(own.nxt2.bitwiseXOR(other.nxt2))
    return sizes & (one <= F.floor(2 * allowed / blocks)) & (two <= F.floor(3 * allowed / blocks))


def _meet(keyed: DataFrame, rule: Rule) -> DataFrame:
    """Rows (key, me, blocks) whose key is shared, with its members and, in small keys, the nodes before that may link."""
    order = Window.partitionBy("key").orderBy("me.node")
    # most keys occur once: they go before the nodes of a key are put in order
    shared = keyed.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("members > 1")
    met = shared.select(
        "key",
        "me",
        "blocks",
        F.first("me").over(order).alias("first"),
        *[F.lag("me", k).over(order).alias(f"lag{k}") for k in range(1, BEFORE + 1)],
        "members",
    )
    others = F.array(
        F.struct(F.col("first").alias("it"), F.lit(True).alias("is_first")),
        *[F.struct(F.col(f"lag{k}").alias("it"), F.lit(False).alias("is_first")) for k in range(1, BEFORE + 1)],
    )
    me, small = F.col("me"), F.col("members") <= SMALL_KEY
    near = F.filter(others, lambda o: small & (o.it.node < me.node) & _fits(rule, me, o.it, F.col("blocks")))
    return (
        met.select("key", "me", "blocks", "members", F.transform(near, lambda o: F.struct(o.it.node.alias("node"), o.is_first.alias("is_first"))).alias("near"))
        .where((F.size("near") > 0) | ~small)
    )


def _keyed(sketches: DataFrame, turn: int) -> DataFrame:
    """Rows (key, me, blocks) of the blocks j with j mod PASSES = ``turn``, without blank ones where they are left out."""
    blocks = F.size("words")
    used = F.filter(
        F.sequence(F.lit(turn), blocks - 1, F.lit(PASSES)),
        lambda j: (F.col("blank") == 0) | (F.get("words", j) != 0) | (F.get("codes", j) != 0),
    )
    row = F.transform(
        used,
        lambda j: F.struct(F.xxhash64(F.col("level"), j, F.get("words", j), F.get("codes", j)).alias("key"), F.get("words", (j + 1) % blocks).alias("nxt"), F.get("words", (j + 2) % blocks).alias("nxt2")),
    )
    return sketches.where(blocks > turn).select("node", "n", "blank", blocks.alias("blocks"), F.explode(row).alias("r")).select(
        "r.key", F.struct("node", "n", "blank", "r.nxt", "r.nxt2").alias("me"), "blocks"
    )


def _bits(word: Column, at: int, wide: int) -> Column:
    """The ``wide`` bits of a word that start at bit ``at``."""
    return F.shiftrightunsigned(F.shiftleft(word, 64 - at - wide), 64 - wide)


def _cut(met: DataFrame, parts: list[Column]) -> DataFrame:
    """Rows (key, me, blocks) of the large keys of ``met``, each cut by every part."""
    large = met.where(F.col("members") > SMALL_KEY)
    parts = F.array(*[p.cast("array<bigint>") for p in parts])
    return large.select("key", "me", "blocks", F.explode(parts).alias("p")).withColumn("key", F.xxhash64("key", "p")).drop("p")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the edges (a, b); comp is the smallest node of the component.

    Large-star and small-star steps in turn until nothing changes; each round is written to the shared folder.
    """

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = written(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a != b")
            .distinct()
        )
        now = written(small, "edges")
        after = state(now)
        if after == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        before = after


def _labelled(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends lie in different components."""
    for end in ("a", "b"):
        named = comps.select(F.col("node").alias(end), F.col("comp").alias(f"c{end}"))
        pairs = pairs.join(named, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    return pairs.where("ca != cb").select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) that link on their exact sets; only the sets of their ends are moved."""
    sets = sets.join(hinted(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), 8), "node", "left_semi")
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b"
    )
    common = F.size(F.array_intersect("x", "y"))
    return joined.where(common * rule.high >= (F.size("x") + F.size("y") - common) * rule.low).select("a", "b")


def join(docs: DataFrame, rule: Rule, keys: dict[str, Column], id_key: str, text_col: str = "text") -> DataFrame:
    """The key columns of every row with n_shingles, node (equal sets share it) and component_id.

    ``keys`` names the columns to carry; ``id_key`` is the one that names components. Columns used inside:
    n, hi, lo, place, level, blank, words, codes, uid.
    """
    rows = docs.select(*[c.alias(f"k_{k}") for k, c in keys.items()], F.col(text_col).alias("_text"))
    ident = f"k_{id_key}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    sketched = rows.mapInArrow(sketch_task(rule), f"{fields}, {SKETCHES}")
    # the rows of a document follow one another, so all of them get the number of its first
    with few_rows_sent(docs.sparkSession):
        base = written(sketched.withColumn("uid", F.monotonically_increasing_id() - F.col("place")), "sketches")
    members = written(base.where("place = 0").drop("place", "level", "blank", "words", "codes"), "members")

    nodes = written(
        members.where("n > 0")
        .groupBy("hi", "lo")
        .agg(F.min("uid").alias("node"), F.min(ident).alias("least_id"), F.count(F.lit(1)).alias("rows")),
        "nodes",
    )
    # of equal sets one sketch stays; most sets occur once and need no grouping
    copied = hinted(nodes.where("rows > 1").select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo")), 24)
    same = (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo"))
    sketches = base.where("n > 0").select("hi", "lo", "level", "blank", "words", "codes", "n", F.col("uid").alias("node"))
    once = (
        sketches.join(copied, same, "left_semi")
        .groupBy("hi", "lo", "level")
        .agg(F.min_by(F.struct("blank", "words", "codes"), "node").alias("one"), F.min("n").alias("n"), F.min("node").alias("node"))
        .select("hi", "lo", "level", "one.blank", "one.words", "one.codes", "n", "node")
    )
    sketches = sketches.join(copied, same, "left_anti").unionByName(once)

    # a key names its block, so blocks of different passes never meet
    passes = [written(_meet(_keyed(sketches, p), rule), "near-blocks") for p in range(PASSES)]
    found = reduce(DataFrame.unionByName, passes)
    discard(base)
    # by the ring form the next block differs in one bit at most, so one of its halves agrees
    me = F.col("me")
    halves = written(_meet(_cut(found, [F.array(F.lit(h), _bits(me.nxt, 32 * h, 32)) for h in (0, 1)]), rule), "near-halves")
    # both next blocks differ in two bits at most: a half of the second agrees, or else the first and a third of the second
    finest = [F.array(F.lit(h), _bits(me.nxt2, 32 * h, 32)) for h in (0, 1)]
    finest += [F.array(F.lit(2 + t), me.nxt, _bits(me.nxt2, at, wide)) for t, (at, wide) in enumerate(((0, 21), (21, 21), (42, 22)))]
    thirds = written(_meet(_cut(halves, finest), rule), "near-thirds")
    return _link(docs, rule, keys, id_key, text_col, members, nodes, [*passes, halves], thirds)


def _sets(docs: DataFrame, rule: Rule, own_id: Column, text_col: str, needed: DataFrame) -> DataFrame:
    """(node, hashes) of the needed nodes (hi, lo, node, least_id), from their texts."""
    wanted = hinted(needed.select(F.col("least_id").alias("_id")).distinct(), 24)
    text = (
        docs.select(own_id.alias("_own"), F.col(text_col).alias("_text"))
        .join(wanted, F.col("_own").eqNullSafe(F.col("_id")), "left_semi")
        .select("_text")
    )
    found = (
        text.mapInArrow(set_task(rule), "hi long, lo long, hashes array<long>")
        .join(hinted(needed.select("hi", "lo", "node"), 40), ["hi", "lo"])
        .dropDuplicates(["node"])
        .select("node", "hashes")
    )
    with few_rows_sent(docs.sparkSession):
        return written(found, "sets")


def _pivots(large: DataFrame) -> DataFrame:
    """(node, pivot) for rows (key, node): all nodes of a key share a pivot, which need not be one of them.

    A node that agrees with the group in most blocks has most keys. Each node takes the best node that most of its
    keys name, each key the one that most of its members take; keys shared by chance are a minority in both.
    """
    own = large.groupBy("node").agg(F.struct(F.count(F.lit(1)).alias("keys"), (-F.col("node")).alias("minus")).alias("rank"))
    named = large.join(own, "node").groupBy("key").agg((-F.max("rank")["minus"]).alias("pivot"))

    def most(by: str, names: DataFrame, on: str) -> DataFrame:
        votes = large.join(names, on).groupBy(by, "pivot").agg(F.count(F.lit(1)).alias("votes"))
        return votes.groupBy(by).agg(F.max(F.struct("votes", (-F.col("pivot")).alias("minus"))).alias("top")).select(by, (-F.col("top.minus")).alias("pivot"))

    best = most("key", most("node", named, "key"), "node")
    return large.join(best, "key").select("node", "pivot").distinct()


def _reach(rule: Rule) -> Column:
    """More than linked texts, one of them of size ``n``, can differ in."""
    partner = F.floor(F.col("n") * rule.high / F.lit(rule.low))
    return F.floor((F.col("n") + partner) * (rule.high - rule.low) / F.lit(rule.high + rule.low)) + 1


def _differences(under: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(pivot, node, n, pivot_n, m, own, lost, rest): the elements of the node's set only, and of the pivot's set only.

    m is the number of both, rest that of the latter. ``lost`` is null where ``_across`` asks for ``rest`` alone.
    """
    heads = sets.join(hinted(under.select(F.col("pivot").alias("node")).distinct(), 8), "node", "left_semi")
    weight = heads.agg(F.coalesce(F.sum(F.size("hashes") * 8 + 32), F.lit(0))).first()[0]
    heads = heads.select(F.col("node").alias("pivot"), F.col("hashes").alias("y"))
    if weight <= BROADCAST_BYTES:
        heads = F.broadcast(heads)
    x, y = F.col("x"), F.col("y")
    return (
        under.join(sets.join(hinted(under.select("node").distinct(), 8), "node", "left_semi").select("node", F.col("hashes").alias("x")), "node")
        .join(heads, "pivot")
        .select("pivot", "node", F.size(x).alias("n"), F.size(y).alias("pivot_n"), F.array_except(x, y).alias("own"), F.array_except(y, x).alias("lost"))
        .withColumn("rest", F.size("lost"))
        .withColumn("m", F.size("own") + F.col("rest"))
        .withColumn("lost", F.when(F.col("m") <= F.col("pivot_n") + _reach(rule), F.col("lost")))
    )


def _link(docs, rule, keys, id_key, text_col, members, nodes, found, finer) -> DataFrame:
    """Verify first pairs and pivots, join what links, look across components, and name the components."""
    ident = f"k_{id_key}"
    pairs = written(
        reduce(DataFrame.unionByName, [*found, finer])
        .select(F.col("me.node").alias("a"), F.explode("near").alias("o"))
        .groupBy("a", F.col("o.node").alias("b"))
        .agg(F.max("o.is_first").alias("is_first")),
        "pairs",
    )
    under = written(_pivots(finer.where(F.col("members") > SMALL_KEY).select("key", F.col("me.node").alias("node"))), "pivots")
    for met in (*found, finer):
        discard(met)
    near = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(
        under.select(F.explode(F.array("node", "pivot")).alias("node"))
    )
    sets = _sets(docs, rule, keys[id_key], text_col, written(near.distinct().join(nodes, "node"), "needed"))
    diffs = written(_differences(under, sets, rule), "differences")
    to_pivot = diffs.where(F.col("m") * (rule.high + rule.low) <= (F.col("n") + F.col("pivot_n")) * (rule.high - rule.low))
    links = written(
        verified(pairs.where("is_first").select("a", "b"), sets, rule).unionByName(
            to_pivot.where("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        ),
        "links",
    )
    comps = components(links)

    second = _labelled(pairs.where("not is_first").select("a", "b"), comps)
    across = written(second.unionByName(_across(diffs, comps, rule)).distinct(), "across")
    more = written(verified(across, sets, rule), "links")
    if not more.isEmpty():
        comps = components(links.unionByName(more))

    placed = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = placed.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    names = placed.join(least, "comp").select("hi", "lo", "comp", "component_id")
    return members.join(names, ["hi", "lo"], "left").select(
        *[F.col(f"k_{k}").alias(k) for k in keys],
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(ident)).alias("component_id"),
        F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("uid")).alias("component"),
        "uid",
    )


def _across(diffs: DataFrame, comps: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of different components under one pivot that may link by their differences.

    With ``excess`` = (high + low) |D| - (high - low) n, two sets link exactly if excess + excess' is at most
    2 (high + low) times the number of elements common to D and D'. Sums of at most 0 link for sure: they are
    joined through the node of least ``excess``. Others have a common element, and at the first of them in the
    order by frequency each side has ``left`` elements to go, which must be enough. Beyond rank ``upto`` none is:
    a difference of m elements to a partner needs m - d common ones, and a partner in the pivot's component
    meets only texts that do not link with the pivot.

    Most nodes came to a pivot by chance and have little in common with it. Linked D differ in size by less than
    ``reach``, so every pair is on one side at least: ``far``, both with more than pivot_n elements, or near, both
    with at most pivot_n + reach. A far node holds less than half of its set in common with the pivot, so more than
    ``reach`` elements of its own; put in order before the pivot's lost ones, the own elements are all a far node needs.
    The elements are counted in passes by their hash.
    """
    both, gap = rule.high + rule.low, rule.high - rule.low
    comp = {c: comps.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp")) for c in ("node", "pivot")}
    named = (
        diffs.join(comp["node"], "node", "left")
        .join(comp["pivot"], "pivot", "left")
        .select(
            "pivot",
            "node",
            "n",
            F.coalesce("node_comp", "node").alias("comp"),
            F.coalesce("pivot_comp", "pivot").alias("main"),
            (F.col("m") * both - F.col("n") * gap).cast("long").alias("excess"),
            "m",
            "pivot_n",
            "rest",
        )
    )
    apart = F.col("comp") != F.col("main")
    named = written(named.withColumn("apart", apart), "named")
    mixed = hinted(named.where("apart").select("pivot").distinct(), 8)
    named = named.join(mixed, "pivot", "left_semi")
    common = F.greatest(F.lit(1), F.ceil((F.col("excess") + F.col("pivot_n") * gap + 1) / F.lit(2 * both)))
    reach = _reach(rule)
    upto = F.when(F.col("apart"), reach).otherwise(F.least(reach, F.col("m") - common + 1))

    least = named.groupBy("pivot").agg(F.min(F.struct("excess", "node", "comp")).alias("least"))
    sure = (
        named.join(hinted(least, 32), "pivot")
        .where((F.col("excess") + F.col("least.excess") <= 0) & (F.col("comp") != F.col("least.comp")))
        .select(F.col("node").alias("a"), F.col("least.node").alias("b"))
    )

    def sides(far: Column, near: Column) -> Column:
        both_sides = F.array(F.when(F.col("m") > F.col("pivot_n"), far), F.when(F.col("m") <= F.col("pivot_n") + reach, near))
        return F.explode(F.filter(both_sides, lambda c: c.isNotNull())).alias("c")

    def side(far: bool, name: str, value: Column) -> Column:
        return F.struct(F.lit(far).alias("far"), value.alias(name))

    sided = named.select("pivot", "node", "n", "comp", "excess", "m", upto.alias("upto"), sides(side(True, "rest", F.col("rest")), side(False, "rest", F.lit(0))))
    items = diffs.join(mixed, "pivot", "left_semi").select(
        "pivot", "node", sides(side(True, "items", F.col("own")), side(False, "items", F.concat("own", "lost")))
    )
    elements = items.select("pivot", "c.far", "node", F.explode("c.items").alias("element"))
    group = ["pivot", "far", "element"]

    def held_by_several(turn: int) -> DataFrame:
        part = elements.where(F.pmod("element", F.lit(PASSES)) == turn)
        counts = part.groupBy(*group).agg(F.count(F.lit(1)).alias("held")).where("held > 1")
        return written(part.join(counts, group), "shared")

    shared = (
        reduce(DataFrame.unionByName, [held_by_several(p) for p in range(PASSES)])
        .groupBy("pivot", "far", "node")
        .agg(F.sort_array(F.collect_list(F.struct("held", "element"))).alias("shared"))
    )
    ranked = (
        sided.select("pivot", "c.far", "node", "n", "comp", "excess", "m", "upto", "c.rest")
        .join(shared, ["pivot", "far", "node"])
        .select("*", F.posexplode("shared").alias("at", "e"))
        .withColumn("left", F.size("shared") - F.col("at") + F.col("rest"))
        .where("m - left + 1 <= upto")
        .select("pivot", "far", "e.element", F.struct("node", "n", "comp", "excess", "left").alias("it"))
    )
    ranked = written(ranked, "rare")
    x, y = F.col("x"), F.col("y")
    enough = (x.excess + y.excess) <= F.least(x.left, y.left) * (2 * both)
    sizes = F.least(x.n, y.n) * rule.high >= F.greatest(x.n, y.n) * rule.low
    met = (
        ranked.withColumnRenamed("it", "x")
        .join(ranked.withColumnRenamed("it", "y"), group)
        .where((x.node > y.node) & (x.comp != y.comp) & sizes & enough)
        .select(x.node.alias("a"), y.node.alias("b"))
    )
    return sure.unionByName(met).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def keep_one(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) without near copies: of each component the row of smallest id stays.

    ``docs`` is read from files; a row is known by its place in them.
    """
    place = {"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")}
    found = join(docs, rule, {"id": F.col(id_col), **place}, "id", text_col)
    first = F.struct(F.col("id").isNull(), "id", "uid")
    best = found.groupBy("component").agg(F.min(first).alias("best"))
    losers = written(
        found.join(best, "component").where("uid != best.uid").select(F.col("file").alias("_file"), F.col("row").alias("_row")), "losers"
    )
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"), place["file"].alias("_file"), place["row"].alias("_row")
    )
    return packed.join(hinted(losers, 200), ["_file", "_row"], "left_anti").select("_all.*")


QUERY_RULE = Rule(width=4, low=85, high=100)


def report(docs: DataFrame) -> DataFrame:
    return join(docs, QUERY_RULE, {"doc_id": F.col("doc_id")}, "doc_id").select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT rid, CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
links AS (SELECT x.rid AS a, y.rid AS b FROM s x JOIN s y ON x.g = y.g JOIN n p ON p.rid = x.rid JOIN n q ON q.rid = y.rid
  GROUP BY x.rid, y.rid, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (SELECT r.a AS rid, min(d.doc_id) AS component_id FROM reach r JOIN d ON d.rid = r.b GROUP BY r.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN n USING (rid) LEFT JOIN c USING (rid)
"""
