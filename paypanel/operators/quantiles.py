"""Exact quantiles of groups of any size.

Ranking a whole group in one window, or keeping its value counts in one aggregation buffer,
breaks when a group holds a large share of the data. The exact value at a rank is found here
in bounded pieces instead:

1. equal values of a group are counted (map-side combined, spread by value);
2. values fall into narrow buckets (about 0.05 % wide, so a few thousand per group) and the
   cumulated bucket counts tell which bucket holds each wanted rank;
3. only the rows of those buckets are ranked, bucket by bucket.

Nothing is approximated: the buckets only decide where to look.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paypanel.operators.skew import group_key

BUCKETS_PER_E = 2048


@dataclass(frozen=True)
class Quantile:
    """``p``-quantile of ``value``; linear interpolation unless ``nearest``."""

    value: str
    p: float
    nearest: bool = False


def median(value: str) -> Quantile:
    return Quantile(value, 0.5)


def nearest(value: str, p: float) -> Quantile:
    return Quantile(value, p, nearest=True)


def _bucket(v: Column) -> Column:
    """Monotone, deterministic bucket number of a value."""
    size = F.least(F.log1p(F.abs(v)), F.lit(710.0))
    return (F.signum(v) * F.floor(size * BUCKETS_PER_E)).cast("int")


def _ranks(q: Quantile, n: Column) -> tuple[Column, Column, Column]:
    """(lower rank, upper rank, weight of the upper one), ranks from 1."""
    pos = (n - 1) * F.lit(float(q.p))
    if q.nearest:
        r = (F.floor(pos + 0.5) + 1).cast("bigint")
        return r, r, F.lit(0.0)
    low = F.floor(pos).cast("bigint")
    return low + 1, F.ceil(pos).cast("bigint") + 1, pos - low


def group_quantiles(
    df: DataFrame, keys: list[str], wanted: dict[str, Quantile], counts: bool = False
) -> DataFrame:
    """One row per group: the group columns as struct ``_g`` and one column per wanted quantile.

    NULL and NaN values are ignored; groups without any value are absent. ``counts`` adds the
    number of values behind each variable as ``_n_<value>``.
    """
    values = sorted({q.value for q in wanted.values()})
    points = {v: [q for q in wanted.values() if q.value == v] for v in values}

    # one (group, variable, value) row per cell
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(v).cast("double").alias("v")) for i, v in enumerate(values)])
    counted = (
        df.select(group_key(keys).alias("_g"), F.explode(cells).alias("_c"))
        .select("_g", F.col("_c.i").alias("_i"), F.col("_c.v").alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy("_g", "_i", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_b", _bucket(F.col("_v")))
    )

    # which bucket holds each wanted rank
    by_var = Window.partitionBy("_g", "_i")
    sums = (
        counted.groupBy("_g", "_i", "_b")
        .agg(F.sum("_n").alias("_bn"))
        .withColumn("_total", F.sum("_bn").over(by_var))
        .withColumn("_upto", F.sum("_bn").over(by_var.orderBy("_b")))
        .withColumn("_before", F.col("_upto") - F.col("_bn"))
    )
    rank_list = None
    for i, v in enumerate(values):
        ranks = [r for q in points[v] for r in _ranks(q, F.col("_total"))[:2]]
        arr = F.array_distinct(F.array(*ranks))
        rank_list = F.when(F.col("_i") == i, arr) if rank_list is None else rank_list.when(F.col("_i") == i, arr)
    picked = (
        sums.withColumn(
            "_ranks", F.filter(rank_list, lambda r: (r > F.col("_before")) & (r <= F.col("_upto")))
        )
        .where(F.size("_ranks") > 0)
        .select("_g", "_i", "_b", "_before", "_total", "_ranks")
    )

    # rank the values of those buckets only
    in_bucket = Window.partitionBy("_g", "_i", "_b").orderBy("_v")
    located = (
        counted.join(picked.hint("merge"), ["_g", "_i", "_b"])  # as many as groups, so never on the driver
        .withColumn("_hi", F.col("_before") + F.sum("_n").over(in_bucket))
        .withColumn("_lo", F.col("_hi") - F.col("_n"))
        .where(F.exists("_ranks", lambda r: (r > F.col("_lo")) & (r <= F.col("_hi"))))
    )

    aggs = []
    for name, q in wanted.items():
        mine = F.col("_i") == values.index(q.value)
        low, high, weight = _ranks(q, F.col("_total"))
        holds_low = mine & (low > F.col("_lo")) & (low <= F.col("_hi"))
        holds_high = mine & (high > F.col("_lo")) & (high <= F.col("_hi"))
        a = F.max(F.when(holds_low, F.col("_v")))
        if q.nearest:
            aggs.append(a.alias(name))
            continue
        b = F.max(F.when(holds_high, F.col("_v")))
        w = F.max(F.when(mine, weight))
        aggs.append((a + (b - a) * w).alias(name))
    if counts:
        aggs += [
            F.coalesce(F.max(F.when(F.col("_i") == i, F.col("_total"))), F.lit(0)).alias(f"_n_{v}")
            for i, v in enumerate(values)
        ]
    return located.groupBy("_g").agg(*aggs)


def whole(c: Column) -> Column:
    """Round to units, first removing float noise so that summation order cannot flip a tie."""
    return F.round(F.round(c, 6), 0)


def group_stats(
    df: DataFrame, keys: list[str], aggs: list[Column], quantiles: dict[str, Quantile] | None = None
) -> DataFrame:
    """Ordinary aggregates plus exact quantiles per group (NULL group values form groups)."""
    base = df.groupBy(group_key(keys).alias("_g")).agg(*aggs)
    if quantiles:
        q = group_quantiles(df, keys, quantiles).withColumnRenamed("_g", "_gq")
        base = base.join(q, F.col("_g") == F.col("_gq"), "left").drop("_gq")
    if keys:
        return base.select("_g.*", *[c for c in base.columns if c != "_g"])
    return base.drop("_g")
