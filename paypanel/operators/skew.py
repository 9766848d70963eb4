"""Ordered per-key operators that survive keys holding a large share of the rows.

A plain window sends every row of one key to one task. Here the keys with more than ``HOT_ROWS`` rows are found
first (a map-side combined count). If there are none, the plan is the ordinary one-shuffle window. Otherwise the
rows of the hot keys, and only these, are sorted over range partitions of about ``2**CHUNK_BITS`` rows and written; a
range is a chunk, whatever the order values look like. Windows run inside a chunk; what a chunk needs from the chunks before
or after it comes from a small per-chunk summary. However many keys are hot, all are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paypanel.plans.stages import written

HOT_ROWS = 1_000_000
CHUNK_BITS = 20
#: A list of hot keys up to this length is broadcast; a longer one is joined by shuffle.
LISTED_KEYS = 10_000

PERIOD, ROW = "periode", "row_id"


def group_key(keys: list[str]) -> Column:
    """Grouping columns as one non-null struct, so that NULL group values join like any other."""
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(1).alias("_all"))


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All keys above ``hot_rows`` rows, with their number of rows."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_hot_n"))
    return counts.where(F.col("_hot_n") > hot_rows)


def with_chunks(
    df: DataFrame,
    key: str,
    period: str = PERIOD,
    row: str = ROW,
    hot_rows: int = HOT_ROWS,
    bits: int = CHUNK_BITS,
    listed: int = LISTED_KEYS,
) -> tuple[DataFrame, bool]:
    """The rows with ``_key`` (a NULL key stands alone) and ``_chunk`` (NULL for ordinary keys), and whether any key is hot.

    ``row`` is unique. The hot keys are counted here and now: how their rows are cut depends on it.
    """
    alone = F.when(F.col(key).isNull(), F.col(row))
    keyed = df.withColumn("_key", F.struct(F.col(key).alias("k"), alone.alias("a")))
    nowhere = F.lit(None).cast("int")
    hot = hot_keys(df, key, hot_rows)
    known = hot.limit(listed + 1).collect()
    if not known:
        return keyed.withColumn("_chunk", nowhere), False
    if len(known) <= listed:
        hot = F.broadcast(df.sparkSession.createDataFrame(known, hot.schema))
        n = sum(r["_hot_n"] for r in known)
    else:
        hot = written(hot, "hot-keys")
        n = hot.agg(F.sum("_hot_n")).first()[0]
    same = F.col(key) == F.col("_hot_key")
    pieces = 2 * ((n + (1 << bits) - 1) >> bits)
    cut = keyed.join(hot, same, "left_semi").repartitionByRange(pieces, key, period, row)
    cut = written(cut.withColumn("_chunk", F.spark_partition_id()), "hot-rows")
    return keyed.join(hot, same, "left_anti").withColumn("_chunk", nowhere).unionByName(cut), True


def _order(period: str, row: str) -> Column:
    return F.struct(F.col(period), F.col(row))


def _join_summary(chunked: DataFrame, summary: DataFrame, any_hot: bool) -> DataFrame:
    """Attach the per-chunk summary; without hot keys its columns are NULL."""
    if not any_hot:
        new = [f for f in summary.schema.fields if f.name not in ("_key", "_chunk")]
        return chunked.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new})
    s = summary.withColumnsRenamed({"_key": "_s_key", "_chunk": "_s_chunk"})
    cond = (F.col("_key") == F.col("_s_key")) & (F.col("_chunk") == F.col("_s_chunk"))
    return chunked.join(s, cond, "left").drop("_s_key", "_s_chunk")


def fill_along(
    df: DataFrame,
    key: str,
    cols: list[str],
    period: str = PERIOD,
    row: str = ROW,
    backward: bool = True,
    hot_rows: int = HOT_ROWS,
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """Add ``<col>__fwd`` (last known value up to the row) and ``<col>__bwd`` (first later one)."""
    d, any_hot = with_chunks(df, key, period, row, hot_rows, bits)
    order = _order(period, row)

    per_chunk = (
        d.where(F.col("_chunk").isNotNull())
        .groupBy("_key", "_chunk")
        .agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_l_{c}") for c in cols],
            *[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_f_{c}") for c in cols],
        )
    )
    over_chunks = Window.partitionBy("_key").orderBy("_chunk")
    before = over_chunks.rowsBetween(Window.unboundedPreceding, -1)
    after = over_chunks.rowsBetween(1, Window.unboundedFollowing)
    summary = per_chunk.select(
        "_key",
        "_chunk",
        *[F.last(f"_l_{c}", ignorenulls=True).over(before).alias(f"_prev_{c}") for c in cols],
        *[F.first(f"_f_{c}", ignorenulls=True).over(after).alias(f"_next_{c}") for c in cols],
    )

    in_chunk = Window.partitionBy("_key", "_chunk").orderBy(period, row)
    up_to = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = in_chunk.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    new = {}
    for c in cols:
        new[f"{c}__fwd"] = F.coalesce(F.last(c, ignorenulls=True).over(up_to), F.col(f"_prev_{c}"))
        if backward:
            new[f"{c}__bwd"] = F.coalesce(F.first(c, ignorenulls=True).over(onward), F.col(f"_next_{c}"))
    helpers = [f"_{side}_{c}" for c in cols for side in ("prev", "next")]
    return _join_summary(d, summary, any_hot).withColumns(new).drop("_key", "_chunk", *helpers)


def with_previous(
    df: DataFrame,
    key: str,
    cols: list[str],
    period: str = PERIOD,
    row: str = ROW,
    hot_rows: int = HOT_ROWS,
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """Add ``<col>__prev``: the value of the key's previous row, NULL on its first row."""
    d, any_hot = with_chunks(df, key, period, row, hot_rows, bits)
    order = _order(period, row)
    values = F.struct(*[F.col(c) for c in cols])

    last_rows = (
        d.where(F.col("_chunk").isNotNull())
        .groupBy("_key", "_chunk")
        .agg(F.max_by(values, order).alias("_last"))
    )
    over_chunks = Window.partitionBy("_key").orderBy("_chunk")
    summary = last_rows.select("_key", "_chunk", F.lag("_last").over(over_chunks).alias("_carry"))

    in_chunk = Window.partitionBy("_key", "_chunk").orderBy(period, row)
    joined = _join_summary(d, summary, any_hot).withColumn("_p", F.coalesce(F.lag(values).over(in_chunk), F.col("_carry")))
    return joined.withColumns({f"{c}__prev": F.col("_p").getField(c) for c in cols}).drop(
        "_key", "_chunk", "_carry", "_p"
    )


def with_rank(
    df: DataFrame,
    key: str,
    period: str = PERIOD,
    row: str = ROW,
    hot_rows: int = HOT_ROWS,
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """Add ``rang`` (from 1) and ``effectif`` of the row inside its key."""
    d, any_hot = with_chunks(df, key, period, row, hot_rows, bits)
    sizes = d.where(F.col("_chunk").isNotNull()).groupBy("_key", "_chunk").agg(F.count("*").alias("_m"))
    whole_key = Window.partitionBy("_key")
    summary = sizes.select(
        "_key",
        "_chunk",
        F.sum("_m").over(whole_key).alias("_total"),
        F.sum("_m").over(whole_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("_skip"),
    )
    part = Window.partitionBy("_key", "_chunk")
    return (
        _join_summary(d, summary, any_hot)
        .withColumns(
            {
                "rang": F.row_number().over(part.orderBy(period, row)) + F.coalesce("_skip", F.lit(0)),
                "effectif": F.coalesce(F.col("_total"), F.count("*").over(part)),
            }
        )
        .drop("_key", "_chunk", "_total", "_skip")
    )


def join_back(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Left join group results (one row per group) to the rows; NULL group values match, skewed keys are split by AQE.

    Both sides are shuffled: exchanged files of a few MB can be a large table on the driver, so nothing uncounted is
    broadcast. The groups are hashed by partition, so the rows are not sorted.
    """
    named = {k: f"_r_{k}" for k in keys}
    s = stats.select(*[F.col(k).alias(r) for k, r in named.items()], *[c for c in stats.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(r)) for k, r in named.items()]
    return df.join(s.hint("shuffle_hash"), same, "left").drop(*named.values())


def lookup_back(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """``join_back`` of groups that are usually few: they are written and counted, and a short table is broadcast."""
    table = written(stats, "lookup")
    if table.count() > LISTED_KEYS:
        return join_back(df, table, keys)
    named = {k: f"_r_{k}" for k in keys}
    same = [F.col(k).eqNullSafe(F.col(r)) for k, r in named.items()]
    return df.join(F.broadcast(table.withColumnsRenamed(named)), same, "left").drop(*named.values())
