"""Longitudinal operators: carrying, deduplication, tenure, first appearance, winsorisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paypanel.functions.dates import months_inclusive
from paypanel.functions.grades import NO_GRADE, civil_servant_grade
from paypanel.operators.joins import first_rows, month_grid
from paypanel.operators.quantiles import Quantile, group_quantiles, nearest
from paypanel.operators.skew import HOT_ROWS, fill_along, join_back

#: Rows of the panel that one task sorts: whole rows are wide.
PANEL_BITS = 18


def locf_forward(df: DataFrame, key: str, col: str, out: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    d = fill_along(df, key, [col], backward=False, hot_rows=hot_rows)
    carried = F.coalesce(F.col(col), F.when(F.col(key).isNotNull(), F.col(f"{col}__fwd")))
    return d.withColumn(out, carried).drop(f"{col}__fwd")


def locf_backward(df: DataFrame, key: str, col: str, out: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """First later value, for the rows before the first known one only."""
    d = fill_along(df, key, [col], hot_rows=hot_rows)
    leading = F.col(key).isNotNull() & F.col(f"{col}__fwd").isNull()
    return d.withColumn(out, F.coalesce(F.col(col), F.when(leading, F.col(f"{col}__bwd")))).drop(
        f"{col}__fwd", f"{col}__bwd"
    )


def dedup_panel(
    df: DataFrame, keys: list[str], row: str = "row_id", hot_rows: int = HOT_ROWS, bits: int = PANEL_BITS
) -> DataFrame:
    """First row of each (person, month); the rows are sorted once, in tasks of about ``2**bits`` of them.

    The rows of each person (first key, NULL is one) are counted here and now. Those of persons above ``hot_rows`` are
    dealt evenly and cut to one row per task before they meet.
    """
    counts = df.groupBy(F.col(keys[0]).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_hot_n"))
    n, most = counts.agg(F.coalesce(F.sum("_hot_n"), F.lit(0)), F.coalesce(F.max("_hot_n"), F.lit(0))).first()
    pieces = max(df.sparkSession.sparkContext.defaultParallelism, (n >> bits) + 1)
    if most <= hot_rows:
        return first_rows(df.repartition(pieces, *keys), keys, [row])
    # at most one in ``hot_rows`` rows is such a person
    hot = F.broadcast(counts.where(F.col("_hot_n") > hot_rows).select("_hot_key"))
    same = F.col(keys[0]).eqNullSafe(F.col("_hot_key"))
    ordinary = first_rows(df.join(hot, same, "left_anti").repartition(pieces, *keys), keys, [row])
    return ordinary.unionByName(first_rows(df.join(hot, same, "left_semi").repartition(pieces), keys, [row]))


def ffill_grade(df: DataFrame, key: str, source: str, status: str, out: str) -> DataFrame:
    """Last known text grade per person over all years; NF by default and for contract statuses."""
    d = df.withColumn("_g", civil_servant_grade(source))
    d = fill_along(d, key, ["_g"], backward=False)
    carried = F.coalesce("_g", F.when(F.col(key).isNotNull(), F.col("_g__fwd")), F.lit(NO_GRADE))
    contract = F.col(status).isin("Contractuel", "Gens de maison")
    return d.withColumn(out, F.when(contract, NO_GRADE).otherwise(carried)).drop("_g", "_g__fwd")


def presence_tenure(
    df: DataFrame, keys: list[str], start: str | None, first: str, last: str, month: str = "mois_date"
) -> DataFrame:
    """Per key and month of the window: rows, presence, cumulated months and years.

    Rows are counted per (key, month) before the calendar is laid out, so a key contributes at
    most one row per month to the ordered sum. ``start`` adds the months before the window.
    """
    window_first = F.lit(first).cast("date")
    d = df.where(F.col(month).between(window_first, F.lit(last).cast("date")))
    counts = d.groupBy(*keys, month).agg(F.count(F.lit(1)).alias("nb_lignes"))
    grid = month_grid(counts, keys, first, last)
    if month != "mois_date":
        grid = grid.withColumnRenamed("mois_date", month)
    w = Window.partitionBy(*keys).orderBy(month).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (
        grid.join(counts, [*keys, month], "left")
        .withColumn("nb_lignes", F.coalesce("nb_lignes", F.lit(0)))
        .withColumn("presence", (F.col("nb_lignes") > 0).cast("int"))
        .withColumn("anciennete_mois", F.sum("presence").over(w))
        .withColumn("anciennete_an", F.floor(F.col("anciennete_mois") / 12))
    )
    if start is None:
        return out
    before = F.add_months(window_first, -1)
    base = (
        d.groupBy(*keys)
        .agg(F.min(start).alias("_start"))
        .select(*keys, F.coalesce(months_inclusive(F.col("_start"), before), F.lit(0)).alias("base_mois"))
    )
    return (
        out.join(base, keys, "left")
        .withColumn("anciennete_mois_total", F.col("base_mois") + F.col("anciennete_mois"))
        .withColumn("anciennete_an_total", F.floor(F.col("anciennete_mois_total") / 12))
    )


def org_tenure(
    df: DataFrame, keys: list[str], collect: str, start: str, row: str = "row_id", fallback: str = "min_collecte"
) -> DataFrame:
    """Months and years since the first known start date, in collection order, of (person, organisation).

    Without any start the first collection counts, or with ``min_ps_non_null`` the earliest
    known start before it.
    """
    seen = F.when(F.col(start).isNotNull(), F.struct(collect, row))
    entry = df.groupBy(*keys).agg(
        F.min_by(start, seen).alias("_at_first"),
        F.min(collect).alias("_first"),
        F.min(start).alias("_min_start"),
    )
    options = ["_at_first", "_min_start", "_first"] if fallback == "min_ps_non_null" else ["_at_first", "_first"]
    entry = entry.select(*keys, F.coalesce(*options).alias("date_entree_org"))
    months = months_inclusive(F.col("date_entree_org"), F.trunc(collect, "month"))
    return (
        join_back(df, entry, keys)
        .withColumn("anciennete_org_mois", months)
        .withColumn("anciennete_org_an", F.floor(F.col("anciennete_org_mois") / 12).cast("int"))
    )


def first_seen(df: DataFrame, key: str = "matricule") -> DataFrame:
    """Number of persons by month of first appearance."""
    return (
        df.groupBy(key)
        .agg(F.min("periode").alias("premier_mois"))
        .groupBy("premier_mois")
        .agg(F.count(F.lit(1)).alias("nb_nouveaux"))
    )


def yearly_arrivals(df: DataFrame, key: str = "matricule") -> DataFrame:
    """Per year: persons, persons never seen before, persons back after a missing year, rows."""
    years = df.where(F.col(key).isNotNull()).groupBy(key, "annee").agg(F.count(F.lit(1)).alias("_obs"))
    prev = F.lag("annee").over(Window.partitionBy(key).orderBy("annee"))
    return (
        years.withColumn("_prev", prev)
        .groupBy("annee")
        .agg(
            F.count(F.lit(1)).alias("nb_individus"),
            F.count(F.when(F.col("_prev").isNull(), 1)).alias("nb_nouveaux"),
            F.count(F.when(F.col("_prev") < F.col("annee") - 1, 1)).alias("nb_reapparus"),
            F.sum("_obs").alias("nb_obs"),
        )
        .withColumn("pct_nouveaux", F.round(F.col("nb_nouveaux") * 100.0 / F.col("nb_individus"), 1))
    )


def declaration_history(df: DataFrame, employer: str, month: str, declared: str) -> DataFrame:
    """Previous declaration (1 before the first month) and mean of the three previous ones.

    One row per (employer, month) is expected, so a window is as long as the calendar.
    """
    w = Window.partitionBy(employer).orderBy(month)
    lags = [F.lag(declared, k, 1).over(w) for k in (1, 2, 3)]
    return df.withColumns({"hist_decl_1": lags[0], "hist_decl_3": (lags[0] + lags[1] + lags[2]) / F.lit(3.0)})


def pct_of_total(df: DataFrame, value: str, out: str, digits: int = 2) -> DataFrame:
    """Share of the column total, through a scalar subquery instead of a one-task window."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, F.round(F.col(value) * 100.0 / total, digits))


def _clip(value: Column, low: Column, high: Column) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def winsorize(
    df: DataFrame, value: str, fine: list[str], coarse: list[str], out: str, p: float = 0.01, min_n: int = 100
) -> DataFrame:
    """Clip to the nearest-rank P and 1-P of the fine group, of the coarse one when it is small."""

    def bounds(keys: list[str], tag: str) -> DataFrame:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"_n_{tag}"))
        q = group_quantiles(df, keys, {f"_lo_{tag}": nearest(value, p), f"_hi_{tag}": nearest(value, 1 - p)})
        return join_back(sizes, q.select("_g.*", f"_lo_{tag}", f"_hi_{tag}"), keys)

    d = join_back(join_back(df, bounds(fine, "f"), fine), bounds(coarse, "c"), coarse)
    v = F.col(value)
    clipped = F.when(F.col("_n_f") >= min_n, _clip(v, F.col("_lo_f"), F.col("_hi_f"))).otherwise(
        _clip(v, F.col("_lo_c"), F.col("_hi_c"))
    )
    return d.withColumn(out, clipped).drop(*[f"_{a}_{t}" for a in ("n", "lo", "hi") for t in ("f", "c")])


def winsorize_linear(
    df: DataFrame,
    value: str,
    by: list[str],
    fallback: list[str],
    out: str,
    only: Column | None = None,
    p: float = 0.01,
    min_n: int = 30,
) -> DataFrame:
    """Variant with interpolated bounds, a row filter and a separate fallback group."""
    scope = F.col(value).isNotNull() if only is None else only & F.col(value).isNotNull()
    scope = F.coalesce(scope, F.lit(False))
    sub = df.where(scope)
    q = {"_lo": Quantile(value, p), "_hi": Quantile(value, 1 - p)}
    fine = join_back(
        sub.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")), group_quantiles(sub, by, q).select("_g.*", "_lo", "_hi"), by
    )
    q2 = {"_lo2": Quantile(value, p), "_hi2": Quantile(value, 1 - p)}
    coarse = group_quantiles(sub, fallback, q2).select("_g.*", "_lo2", "_hi2")
    d = join_back(join_back(df, fine, by), coarse, fallback)
    v = F.col(value)
    clipped = F.when(F.col("_n") >= min_n, _clip(v, F.col("_lo"), F.col("_hi"))).otherwise(
        _clip(v, F.col("_lo2"), F.col("_hi2"))
    )
    return d.withColumn(out, F.when(scope, clipped).otherwise(v)).drop("_n", "_lo", "_hi", "_lo2", "_hi2")
