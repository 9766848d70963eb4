"""Grade and salary imputation with the origin of every value kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paypanel.functions.grades import is_invalid_grade, is_valid_grade
from paypanel.operators.quantiles import group_quantiles, median
from paypanel.operators.skew import HOT_ROWS, fill_along, join_back, lookup_back

SALARIES = ["montant_brut", "montant_net"]

# Median cells from narrow to wide, with the observations each one needs.
LEVELS = {
    "L1": (["CODE_EMPLOI", "GRADE", "CODE_ORGANISME", "periode"], 5),
    "L2": (["CODE_EMPLOI", "GRADE", "periode"], 5),
    "L3": (["GRADE", "CODE_ORGANISME", "periode"], 3),
    "L4": (["GRADE", "periode"], 3),
}
CELL = ["CODE_EMPLOI", "GRADE", "CODE_ORGANISME", "periode"]


def modal_value(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Most frequent non-NULL value per group; ties go to the smallest value."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return modal_of_counts(counts, keys, value, out)


def modal_of_counts(counts: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(out))


def grade_counts(df: DataFrame) -> DataFrame:
    """Rows by job, month and valid grade (NULL for other grades): the finest level, counted once."""
    valid = F.when(is_valid_grade("GRADE"), F.col("GRADE")).alias("_g")
    return df.groupBy("emploi", "annee", "mois", valid).agg(F.count(F.lit(1)).alias("_n"))


def grade_modal_lookup(df: DataFrame) -> DataFrame:
    """For every (job, month): modal valid grade of the job in the month, in the year and overall.

    The counts hold at most months x grades rows per job, so one shuffle by job and ordered
    windows over them are bounded however large the job is.
    """

    def rank(c: str):
        return F.when(F.col("_g").isNotNull(), F.struct(-F.col(c), F.col("_g")))

    def total(*keys: str):
        return F.sum("_n").over(Window.partitionBy(*keys, "_g"))

    def best(c: str, *keys: str):
        return F.min_by("_g", rank(c)).over(Window.partitionBy(*keys))

    return (
        grade_counts(df)
        .repartition("emploi")
        .withColumns({"_n2": total("emploi", "annee"), "_n3": total("emploi")})
        .select(
            "emploi", "annee", "mois",
            best("_n", "emploi", "annee", "mois").alias("GRADE_P1"),
            best("_n2", "emploi", "annee").alias("GRADE_P2"),
            best("_n3", "emploi").alias("GRADE_P3"),
        )
        .distinct()
    )


def grade_modal_lookups(df: DataFrame) -> dict[str, DataFrame]:
    """The three lookups of the cascade as separate tables."""
    lk = grade_modal_lookup(df)
    keys = {"P1": ["emploi", "annee", "mois"], "P2": ["emploi", "annee"], "P3": ["emploi"]}
    return {
        name: lk.where(F.col(f"GRADE_{name}").isNotNull()).select(*k, f"GRADE_{name}").distinct()
        for name, k in keys.items()
    }


def impute_grades(df: DataFrame) -> DataFrame:
    """Replace invalid grades by the cascade P1, P2, P3 and tell the origin in GRADE_SOURCE.

    Only the invalid rows meet the lookup; valid rows are not shuffled.
    """
    bad = F.coalesce(is_invalid_grade("GRADE"), F.lit(False))
    valid_source = F.when(is_valid_grade("GRADE"), "OBSERVE").otherwise("NF_NON_IMPUTABLE")
    sound = df.where(~bad).withColumn("GRADE_SOURCE", valid_source)
    mended = (
        df.where(bad)
        .join(grade_modal_lookup(df), ["emploi", "annee", "mois"], "left")
        .withColumn("GRADE", F.coalesce("GRADE_P1", "GRADE_P2", "GRADE_P3", "GRADE"))
        .withColumn("GRADE_SOURCE", F.when(is_valid_grade("GRADE"), "IMPUTE").otherwise("NF_NON_IMPUTABLE"))
        .select(*sound.columns)
    )
    return sound.unionByName(mended)


def agent_modal_grade(df: DataFrame, key: str = "cle_unique") -> DataFrame:
    """Modal grade of each (post, job) history among grades that are not invalid."""
    kept = df.where(~is_invalid_grade("GRADE"))
    return modal_value(kept, [key, "emploi"], "GRADE", "GRADE_MODAL")


def impute_grades_from_history(df: DataFrame, key: str = "cle_unique") -> DataFrame:
    """Variant: an invalid grade takes the modal grade of its own (post, job) history."""
    modal = agent_modal_grade(df, key)
    joined = join_back(df, modal, [key, "emploi"])
    fixed = F.when(is_invalid_grade("GRADE"), F.coalesce("GRADE_MODAL", "GRADE")).otherwise(F.col("GRADE"))
    return joined.withColumn("GRADE", fixed).drop("GRADE_MODAL")


def median_lookups(df: DataFrame, values: list[str], min_obs: dict[str, int] | None = None) -> DataFrame:
    """Medians of the observed values of every cell of every level, in one pass.

    A row belongs to one cell per level, so it is repeated per level, and counted by (cell,
    value) before anything is shuffled. Codes a level does not use are set to ''. A cell with a
    NULL code is left out, because no row could ever match it. The result has, per amount, the
    median where the cell has enough observations.
    """
    n_min = {name: (min_obs or {}).get(name, default) for name, (_, default) in LEVELS.items()}
    cells = df.withColumn("_level", F.explode(F.array(*[F.lit(name) for name in LEVELS]))).withColumns(level_key())
    complete = F.col("_e").isNotNull() & F.col("_o").isNotNull()
    keys = ["_level", "_e", "_o", "GRADE", "periode"]
    q = group_quantiles(cells.where(complete), keys, {f"_m_{v}": median(v) for v in values}, counts=True)
    need = F.element_at(F.create_map(*[F.lit(x) for kv in n_min.items() for x in kv]), F.col("_level"))
    flat = q.select("_g.*", *[c for c in q.columns if c != "_g"])
    return flat.select(
        *keys,
        *[F.when(F.col(f"_n_{v}") >= need, F.col(f"_m_{v}")).alias(f"_m_{v}") for v in values],
    )


def level_key() -> dict[str, Column]:
    """Code columns of a cell at the level named in ``_level``."""

    def used(code: str) -> Column:
        levels = [name for name, (keys, _) in LEVELS.items() if code in keys]
        return F.when(F.col("_level").isin(*levels), F.col(code)).otherwise(F.lit(""))

    return {"_e": used("CODE_EMPLOI"), "_o": used("CODE_ORGANISME")}


def median_level(df: DataFrame, level: str, value: str, min_obs: int | None = None) -> DataFrame:
    """The median table of one level, with its key columns."""
    keys, default = LEVELS[level]
    q = group_quantiles(df, keys, {"mediane": median(value)}, counts=True)
    return q.where(F.col(f"_n_{value}") >= (min_obs or default)).select("_g.*", "mediane")


def median_cells(df: DataFrame, values: list[str], min_obs: dict[str, int] | None = None) -> DataFrame:
    """For each cell with a missing amount: the cascade median of every amount and its level.

    The cascade runs on distinct cells, so the rows themselves meet a single lookup.
    """
    any_missing = reduce(lambda a, b: a | b, [F.col(v).isNull() for v in values])
    cells = (
        df.where(any_missing)
        .select(*CELL)
        .distinct()
        .withColumn("_level", F.explode(F.array(*[F.lit(name) for name in LEVELS])))
        .withColumns(level_key())
    )
    found = cells.join(
        median_lookups(df, values, min_obs).hint("merge"), ["_level", "_e", "_o", "GRADE", "periode"], "left"
    )  # level names sort in cascade order
    picks = []
    for v in values:
        first = F.when(F.col(f"_m_{v}").isNotNull(), F.col("_level"))
        picks.append(F.min_by(f"_m_{v}", first).alias(f"{v}__med"))
        picks.append(F.concat(F.lit("IMPUTE_"), F.min(first)).alias(f"{v}__level"))
    return found.groupBy(*CELL).agg(*picks)


def impute_by_median(df: DataFrame, values: list[str] = SALARIES, min_obs: dict[str, int] | None = None) -> DataFrame:
    """Median cascade alone, without the carried observations."""
    joined = join_back(df, median_cells(df, values, min_obs), CELL)
    return _finish(joined, values, {}, {}).drop(*[f"{v}__{s}" for v in values for s in ("med", "level")])


def _finish(df: DataFrame, values: list[str], fwd: dict[str, Column], bwd: dict[str, Column]) -> DataFrame:
    nothing = F.lit(None).cast("double")
    new = {}
    for v in values:
        f, b, m = fwd.get(v, nothing), bwd.get(v, nothing), F.col(f"{v}__med")
        new[f"{v}_SOURCE"] = (
            F.when(F.col(v).isNotNull(), "OBSERVE")
            .when(f.isNotNull(), "LOCF_FWD")
            .when(b.isNotNull(), "LOCF_BWD")
            .otherwise(F.coalesce(f"{v}__level", F.lit("NON_IMPUTABLE")))
        )
        new[v] = F.coalesce(F.col(v), f, b, m)
    return df.withColumns(new)


def impute_salaries(
    df: DataFrame,
    key: str = "cle_unique",
    values: list[str] = SALARIES,
    min_obs: dict[str, int] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Last observation forward, then backward, then the median cascade; one source per amount.

    All amounts share one ordered pass; medians use the values observed before any carrying.
    Rows without a post key are not carried. ``df`` is read several times: pass a written layer.
    """
    carried = fill_along(df, key, values, hot_rows=hot_rows)
    known = F.col(key).isNotNull()
    fwd = {v: F.when(known, F.col(f"{v}__fwd")) for v in values}
    bwd = {v: F.when(known, F.col(f"{v}__bwd")) for v in values}
    joined = join_back(carried, median_cells(df, values, min_obs), CELL)
    helpers = [f"{v}__{s}" for v in values for s in ("fwd", "bwd", "med", "level")]
    return _finish(joined, values, fwd, bwd).drop(*helpers)


def imputation_report(df: DataFrame, source: str) -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.groupBy(F.col(source).alias("source"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("pct", F.round(F.col("n") * 100.0 / total, 1))
    )


def group_median_fill(df: DataFrame, value: str, keys: list[str], out: str) -> DataFrame:
    """Missing values take the group median, else the overall median; rounded half to even."""
    by_group = group_quantiles(df, keys, {"_gm": median(value)}).select("_g.*", "_gm")
    overall = group_quantiles(df, [], {"_om": median(value)}).select("_om").scalar()
    joined = lookup_back(df, by_group, keys)
    return joined.withColumn(out, F.bround(F.coalesce(F.col(value), F.col("_gm"), overall), 0)).drop("_gm")


def group_mode_fill(df: DataFrame, value: str, keys: list[str], out: str) -> DataFrame:
    """Missing values take the most frequent value of the group."""
    mode = modal_value(df, keys, value, "_mode")
    return lookup_back(df, mode, keys).withColumn(out, F.coalesce(value, "_mode")).drop("_mode")


def latest_value(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """Last non-NULL value of each key in the given order."""
    when = F.struct(*[F.col(c) for c in order])
    return df.where(F.col(value).isNotNull()).groupBy(key).agg(F.max_by(value, when).alias(f"{value}_dernier"))


def mapping_random(ref: DataFrame, label_norm: str, code: str, label: str, seed: int = 123) -> DataFrame:
    """One code per normalised label, chosen repeatably among several, with audit columns."""
    draw = F.sha2(F.concat(F.col(label_norm), F.col(code), F.lit(str(seed))), 256)
    per_label = (
        ref.select(label_norm, code)
        .distinct()
        .groupBy(label_norm)
        .agg(
            F.min_by(code, draw).alias("CODE_CHOISI"),
            F.count(F.lit(1)).alias("NB_CODES_POSSIBLES"),
            F.concat_ws(", ", F.sort_array(F.collect_set(code))).alias("CODES_POSSIBLES"),
        )
        .withColumn("EST_AMBIGU", F.col("NB_CODES_POSSIBLES") > 1)
    )
    return ref.select(label, label_norm).distinct().join(per_label, label_norm, "left")

