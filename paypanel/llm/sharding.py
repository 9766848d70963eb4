"""Sharding by histogram sort: near-equal bytes per shard, in key order, with one exchange of the rows.

The key of a row is (digest, id): equal texts lie side by side, and a group of copies of any size can still
be cut between two ids. Splitters are found by counting, not by sampling: a slim copy of the keys and
sizes is written once; each round counts the exact bytes below the edges of every cell that still holds a
wanted splitter, cuts those cells finer, and ends when each splitter is within tolerance or its cell holds
one key. First the 63 digest bits are refined, then, inside one digest, the id range. The driver sees a few
counts per open cell and round, never keys or rows. Rows then find their place by binary search over the
splitters and are exchanged once.

Every shard is cut into ``parts`` runs by the same splitters, so numbering a shard never needs one task for
it: rows are numbered inside a run, runs are offset by exact counts.

Defined results: a null text has size 8 and the digest of nothing; a null id sorts before all others; rows
with equal text and id share a key, so a splitter never falls between them (slots stay gapless, their order
among themselves is arbitrary); an empty table gives an empty result. With fewer distinct keys than shards
some shards stay empty.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paypanel.llm.expressions import let
from paypanel.plans.stages import written

BITS = 63
ROUND_BITS = 7
LOWEST = -(1 << 63)


@dataclass
class Cell:
    """An open interval of keys: the digests that share ``depth`` leading bits, or ids from ``low`` in one digest."""

    digest: int
    depth: int
    below: int
    low: int | None = None
    width: int | None = None


def digest63(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 1)


def _number(id_col: Column) -> Column:
    """The id as a long that orders like it; null first."""
    return F.coalesce(id_col.cast("long"), F.lit(LOWEST))


def find_splitters(keys: DataFrame, wanted: list[int], tolerance: int) -> list[tuple[int, int]]:
    """Keys (digest, id), one per wanted byte count: about that many bytes lie before each.

    ``keys`` has digest, id and size and is read once per round.
    """
    spark = keys.sparkSession
    found: dict[int, tuple[int, int]] = {}
    todo: dict[int, Cell] = {i: Cell(0, 0, 0) for i in range(len(wanted))}

    while todo:
        first = next(iter(todo.values()))
        by_digest = {i: c for i, c in todo.items() if c.depth < BITS}
        step: dict[int, Cell] = {}
        if by_digest:
            depth = min(c.depth for c in by_digest.values())
            finer = min(ROUND_BITS, BITS - depth)
            open_cells = sorted({c.digest for c in by_digest.values()})
            cells = spark.createDataFrame([(d,) for d in open_cells], "cell long")
            fine = F.shiftright("digest", BITS - depth - finer)
            sums = (
                keys.select(F.shiftright(fine, finer).alias("cell"), fine.alias("fine"), "size")
                .join(F.broadcast(cells), "cell")
                .groupBy("cell", "fine")
                .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
                .collect()
            )
            inside: dict[int, list[tuple[int, int, int]]] = {}
            for r in sums:
                inside.setdefault(r["cell"], []).append((r["fine"], r["bytes"], r["rows"]))
            for part in inside.values():
                part.sort()
            for i, cell in by_digest.items():
                below = cell.below
                for fine_cell, size, count in inside[cell.digest]:
                    over = below + size - wanted[i]
                    if abs(below - wanted[i]) <= tolerance or (count == 1 and over > 0):
                        after = count == 1 and 0 < over < wanted[i] - below
                        found[i] = ((fine_cell + after) << (BITS - depth - finer), LOWEST)
                        break
                    if over > tolerance:
                        step[i] = Cell(fine_cell, depth + finer, below)
                        break
                    below += size
                else:
                    last = inside[cell.digest][-1][0] + 1
                    found[i] = (last << (BITS - depth - finer), LOWEST)
        todo = {i: c for i, c in todo.items() if c.depth >= BITS} | step
        if by_digest:
            continue

        # what is open now lies inside single digests: large groups of copies
        if first.low is None:
            groups = spark.createDataFrame([(d,) for d in sorted({c.digest for c in todo.values()})], "digest long")
            ends = {
                r["digest"]: (r["low"], r["high"])
                for r in keys.join(F.broadcast(groups), "digest")
                .groupBy("digest")
                .agg(F.min("id").alias("low"), F.max("id").alias("high"))
                .collect()
            }
            for c in todo.values():
                low, high = ends[c.digest]
                c.low, c.width = low, max(1, -(-(high - low + 1) >> ROUND_BITS))
        spans = sorted({(c.digest, c.low, c.width) for c in todo.values()})
        cells = spark.createDataFrame([(d, low, Decimal(w)) for d, low, w in spans], "digest long, low long, width decimal(20,0)")
        number = F.expr("cast(id as decimal(20,0)) - low")
        counted = (
            keys.join(F.broadcast(cells), "digest")  # at most one cell per splitter
            .where(number.between(F.lit(0), F.expr(f"width * {1 << ROUND_BITS} - 1")))
            .groupBy("digest", "low", F.floor(number / F.col("width")).cast("long").alias("fine"))
            .agg(F.sum("size").alias("bytes"))
            .collect()
        )
        inside = {}
        for r in counted:
            inside.setdefault((r["digest"], r["low"]), []).append((r["fine"], r["bytes"]))
        for part in inside.values():
            part.sort()
        step = {}
        for i, cell in todo.items():
            below = cell.below
            for fine_cell, size in inside[(cell.digest, cell.low)]:
                edge = cell.low + fine_cell * cell.width
                near = abs(below - wanted[i]) <= tolerance
                if near or (cell.width == 1 and below + size > wanted[i]):
                    over = below + size - wanted[i] < wanted[i] - below
                    found[i] = (cell.digest, edge + 1 if over and not near else edge)
                    break
                if below + size > wanted[i] + tolerance:
                    step[i] = Cell(cell.digest, BITS, below, edge, max(1, -(-cell.width >> ROUND_BITS)))
                    break
                below += size
            else:
                found[i] = (cell.digest + 1, LOWEST)
        todo = step

    return [found[i] for i in range(len(wanted))]


def place(digest: Column, number: Column, splitters: list[tuple[int, int]]) -> Column:
    """How many splitters are at or before the key: a binary search over two literal arrays."""
    if not splitters:
        return F.lit(0)
    n = len(splitters)
    digests, numbers = F.lit([s[0] for s in splitters]), F.lit([s[1] for s in splitters])
    steps = F.lit([1 << b for b in reversed(range(n.bit_length()))])

    def move(k: Column) -> Column:
        def one(at: Column, by: Column) -> Column:
            d, m = F.get(digests, at + by - 1), F.get(numbers, at + by - 1)
            reached = (at + by <= n) & ((d < k.d) | ((d == k.d) & (m <= k.m)))
            return F.when(reached, at + by).otherwise(at)

        return F.aggregate(steps, F.lit(0).cast("int"), lambda at, by: one(at, by.cast("int")))

    return let(F.struct(digest.alias("d"), number.alias("m")), move)


def shard(
    rows: DataFrame,
    id_col: str,
    digest_col: str,
    size_col: str,
    shards: int = 24,
    tolerance: float = 0.001,
    rows_per_part: int = 250_000,
    least_parts: int = 8,
) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in the shard, in key order).

    ``tolerance`` is the error allowed for a splitter, as a share of one shard's bytes. ``rows_per_part``
    bounds the rows that one task numbers; the number of splitters follows the number of rows.
    """
    keys = written(
        rows.select(F.col(digest_col).alias("digest"), _number(F.col(id_col)).alias("id"), F.col(size_col).alias("size")),
        "shard-keys",
    )
    total, count = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(least_parts, math.ceil(count / shards / rows_per_part))
    wanted = [total * k // (shards * parts) for k in range(1, shards * parts)] if count else []
    splitters = sorted(find_splitters(keys, wanted, int(total * tolerance / shards / parts))) if wanted else []

    placed = rows.withColumns(
        {"_part": place(F.col(digest_col), _number(F.col(id_col)), splitters), "_at": _number(F.col(id_col))}
    )
    starts = (
        keys.select(place(F.col("digest"), F.col("id"), splitters).alias("_part"))
        .groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn(
            "_start",
            F.sum("_rows").over(
                Window.partitionBy(F.floor(F.col("_part") / parts)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select("_part", F.coalesce("_start", F.lit(0)).alias("_start"))
    )
    in_part = Window.partitionBy("_part").orderBy(digest_col, "_at")
    return (
        placed.withColumn("_n", F.row_number().over(in_part))
        .join(F.broadcast(starts), "_part")  # one row per splitter
        .withColumns(
            {
                "shard": F.floor(F.col("_part") / parts).cast("int"),
                "slot": (F.col("_start") + F.col("_n") - 1).cast("long"),
            }
        )
        .drop("_part", "_at", "_n", "_start")
    )


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = 24) -> None:
    """Write the documents, one folder per shard, each file a key range in slot order."""
    rows = docs.withColumns({"_digest": digest63(F.col(text_col)), "_size": size_of(F.col(text_col))})
    out = shard(rows, id_col, "_digest", "_size", shards).drop("_digest", "_size")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def report(docs: DataFrame, shards: int = 24) -> DataFrame:
    """The place of every document under the law of near-equal bytes."""
    slim = docs.select(
        "doc_id",
        digest63(F.col("text")).alias("digest"),
        size_of(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    return shard(slim, "doc_id", "digest", "size", shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
