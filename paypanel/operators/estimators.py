"""Means corrected for missing declarations: response weights, matching imputation, pooling."""

from __future__ import annotations

import math
import statistics

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paypanel.operators.quantiles import Quantile, group_quantiles
from paypanel.operators.windows import declaration_history
from paypanel.plans.stages import written

IMPUTATIONS = 20
DONORS = 5
PARTS = 4096  # in which the donors of one prediction are numbered
CHUNK = 1 << 16  # consecutive predictions that are given their neighbours in one task
ROWS_A_RANGE = 1 << 19
NORMAL_975 = 1.959963984540054


def _known(categories: list[str]) -> dict[str, Column]:
    """The predictors' categories, with missing as a level of its own."""
    return {f"_k_{c}": F.coalesce(F.col(c).cast("string"), F.lit("(inconnu)")) for c in categories}


def _features(categories: list[str], numbers: list[str], unseen: str = "error") -> list:
    """Indexing, dummy coding (the last real level dropped) and assembling of the predictors.

    Missing categories are a level of their own (``_known``). ``unseen`` says what becomes of levels that the
    fitted rows do not have: an error, or no dummy at all ("keep").
    """
    stages = []
    for c in categories:
        stages.append(StringIndexer(inputCol=f"_k_{c}", outputCol=f"_ix_{c}", handleInvalid=unseen, stringOrderType="alphabetAsc"))
    if categories:
        stages.append(
            OneHotEncoder(inputCols=[f"_ix_{c}" for c in categories], outputCols=[f"_oh_{c}" for c in categories])
        )
    inputs = [f"_oh_{c}" for c in categories] + numbers
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_x", handleInvalid="error"))
    return stages


def _helpers(categories: list[str]) -> list[str]:
    return ["_x", *[f"_{kind}_{c}" for kind in ("k", "ix", "oh") for c in categories]]


def response_probability(df: DataFrame, response: str, categories: list[str], numbers: list[str]) -> DataFrame:
    """Add ``pi_hat``: fitted probability of a response from an unpenalised logistic model."""
    model = Pipeline(
        stages=[
            *_features(categories, numbers),
            LogisticRegression(featuresCol="_x", labelCol="_label", regParam=0.0, maxIter=100, tol=1e-10),
        ]
    )
    d = df.withColumns({"_label": F.col(response).cast("double"), **_known(categories)})
    scored = model.fit(d).transform(d).withColumn("pi_hat", vector_to_array("probability")[1])
    return scored.drop("_label", "rawPrediction", "probability", "prediction", *_helpers(categories))


def ipw_weights(df: DataFrame, response: str, categories: list[str], numbers: list[str], out: str = "w_ipw") -> DataFrame:
    """Stabilised weights mean(R) / p, 0 for non-respondents, cut at the respondents' 99th percentile."""
    d = written(response_probability(df, response, categories, numbers), "ipw")
    rate = d.agg(F.avg(F.col(response).cast("double"))).scalar()
    d = d.withColumn(out, F.when(F.col(response) == 1, rate / F.col("pi_hat")).otherwise(0.0))
    return truncate_weights(d, out, F.col(response) == 1)


def truncate_weights(df: DataFrame, weight: str, among: Column, p: float = 0.99) -> DataFrame:
    cap = group_quantiles(df.where(among), [], {"_cap": Quantile(weight, p)}).select("_cap").scalar()
    return df.withColumn(weight, F.least(F.col(weight), cap))


def draw_parameters(x: DataFrame, y: str, m: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares coefficients (constant first) and ``m`` draws from their distribution, as rows.

    ``x`` has the assembled predictors ``_x`` and the values ``y``. The cross products are summed on the cluster; what
    is solved here is as wide as the predictors. A draw takes the error variance from its scaled inverse chi-square and
    the coefficients from the normal around the fitted ones. Predictors that depend on others share their effect.
    """
    row = F.concat(F.array(F.lit(1.0)), vector_to_array("_x"), F.array(F.col(y).cast("double")))
    vectors = MLUtils.convertVectorColumnsFromML(x.select(array_to_vector(row).alias("row")), "row")
    gram = RowMatrix(vectors).computeGramianMatrix().toArray()
    xx, xy, yy, n = gram[:-1, :-1], gram[:-1, -1], gram[-1, -1], gram[0, 0]
    scale = np.sqrt(np.where(np.diag(xx) > 0, np.diag(xx), 1.0))
    values, axes = np.linalg.eigh(xx / np.outer(scale, scale))
    used = values > 1e-10 * values.max()
    root = (axes[:, used] / np.sqrt(values[used])) / scale[:, None]
    fitted = root @ (root.T @ xy)
    rest = max(yy - 2 * fitted @ xy + fitted @ xx @ fitted, 0.0)
    draws = []
    for k in range(1, m + 1):
        rng = np.random.default_rng([seed, k])
        spread = math.sqrt(rest / rng.chisquare(max(n - used.sum(), 1)))
        draws.append(fitted + spread * (root @ rng.standard_normal(int(used.sum()))))
    return fitted, np.array(draws)


def within_reach(k: int) -> Column:
    """Of the blocks ``near`` the target ``at``, those as far as its k-th nearest donor.

    The distance is found once a row and used as it leaves the fold; as a column of its own it would be inlined into
    the filter and found again for every block.
    """
    gap = lambda b: F.abs(b.pred - F.col("at"))
    gaps = F.array_sort(F.transform("near", lambda b: F.struct(gap(b).alias("gap"), b.n.alias("n"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("gap"))
    return F.aggregate(
        gaps,
        start,
        lambda acc, g: F.when(acc.n >= k, acc).otherwise(F.struct((acc.n + g.n).alias("n"), g.gap.alias("gap"))),
        lambda acc: F.filter("near", lambda b: gap(b) <= acc.gap),
    )


def nearest_donors(donors: DataFrame, recipients: DataFrame, k: int = DONORS, seed: int = 123) -> DataFrame:
    """(id, m, value): for every recipient (id, m, target) the value of one of the ``k`` donors nearest to its target.

    Donors (id, pred, value) as far as the k-th nearest count as near too, and one of all these is drawn by a seeded hash.
    Equal predictions are one counted block. Blocks and targets are sorted together over range partitions, and counts
    by partition turn places within a partition into places among all; so a target knows the last block not above it.
    Each block is given its neighbours, for which chunks of consecutive blocks exchange the ``k`` rows at their edges. The near
    donors have consecutive numbers, one is drawn, and an equi-join on the number finds its value. Donors of a block are numbered in
    parts, so no block is one task's work.
    """
    part_of = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(PARTS))
    given = donors.select("id", "pred", "value", part_of.alias("piece"))
    counts = written(given.groupBy("pred", "piece").agg(F.count(F.lit(1)).alias("n")), "donor-counts")
    blocks = counts.groupBy("pred").agg(F.sum("n").alias("n"))
    asked = recipients.select("id", "m", F.col("target").alias("at"))
    merged = blocks.select(F.col("pred").alias("at"), F.lit(0).alias("kind"), "n").unionByName(
        asked.select("id", "m", "at", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("n")), allowMissingColumns=True
    )
    ranges = 1 + (counts.count() + recipients.count()) // ROWS_A_RANGE
    placed = merged.withColumn("tie", F.xxhash64("id", "m")).repartitionByRange(ranges, "at", "kind", "tie")
    placed = written(placed.withColumn("part", F.spark_partition_id()), "targets")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
    before = placed.groupBy("part").agg(F.count_if(F.col("kind") == 0).alias("b"), F.sum("n").alias("d"))
    before = before.select(
        "part", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("blocks"), F.coalesce(F.sum("d").over(earlier), F.lit(0)).alias("donors")
    )
    along = Window.partitionBy("part").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    numbered = written(
        placed.withColumns({"b": F.count_if(F.col("kind") == 0).over(along), "d": F.sum("n").over(along)})
        .join(F.broadcast(before), "part")
        .select("id", "m", "at", "kind", "n", (F.col("blocks") + F.col("b")).alias("place"), (F.col("donors") + F.col("d") - F.col("n")).alias("start")),
        "places",
    )

    known = numbered.where("kind = 0").select("place", F.col("at").alias("pred"), "start", "n")
    edges = F.array_distinct(F.transform(F.array(F.lit(-k), F.lit(0), F.lit(k)), lambda s: F.floor((F.col("place") + s) / CHUNK)))
    around = Window.partitionBy("chunk").orderBy("place").rowsBetween(1 - k, k)
    near = (
        known.withColumn("chunk", F.explode(edges))
        .withColumn("near", F.collect_list(F.struct("pred", "start", "n")).over(around))
        .where(F.col("chunk") == F.floor(F.col("place") / CHUNK))
        .select("place", "near")
    )
    sought = numbered.where("kind = 1").select("id", "m", "at", F.greatest("place", F.lit(1)).alias("place")).join(near, "place")

    drawn = (
        sought.withColumn("usable", within_reach(k))
        .withColumn("many", F.aggregate("usable", F.lit(0).cast("long"), lambda acc, b: acc + b.n))
        .select("id", "m", (F.array_min(F.transform("usable", lambda b: b.start)) + F.pmod(F.xxhash64("id", "m", F.lit(seed)), F.col("many"))).alias("number"))
    )

    in_block = Window.partitionBy("pred").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # at most PARTS rows
    skip = counts.select("pred", "piece", F.coalesce(F.sum("n").over(in_block), F.lit(0)).alias("skip")).join(known.select("pred", "start"), "pred")
    ranked = (
        given.withColumn("r", F.row_number().over(Window.partitionBy("pred", "piece").orderBy("id")))
        .join(skip, ["pred", "piece"])
        .select((F.col("start") + F.col("skip") + F.col("r") - 1).alias("number"), "value")
    )
    return drawn.join(ranked, "number").select("id", "m", "value")


def pmm_impute(
    df: DataFrame,
    value: str,
    row: str,
    categories: list[str],
    numbers: list[str],
    m: int = IMPUTATIONS,
    seed: int = 123,
    donors: int = DONORS,
) -> DataFrame:
    """Predictive mean matching: ``m`` completed values per row, long form (row, m, value).

    Every imputation draws its own parameters. A recipient's prediction with these is matched with the donors'
    predictions with the fitted parameters, and the value of one of the nearest ``donors`` is taken. Draws are repeatable.
    """
    ready = df.withColumns(_known(categories))
    known = ready.where(F.col(value).isNotNull())
    features = Pipeline(stages=_features(categories, numbers, "keep")).fit(known)
    scored = written(features.transform(ready).select(F.col(row).alias("id"), F.col(value).alias("value"), "_x"), "pmm")
    fitted, draws = draw_parameters(scored.where("value IS NOT NULL"), "value", m, seed)
    row_x = F.concat(F.array(F.lit(1.0)), vector_to_array("_x"))

    def predicted(beta: np.ndarray) -> Column:
        products = F.zip_with("x", F.lit(beta.tolist()), lambda a, b: a * b)
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    known = scored.where("value IS NOT NULL").select("id", "value", row_x.alias("x"))
    missing = scored.where("value IS NULL").select("id", row_x.alias("x"))
    targets = F.posexplode(F.array(*[predicted(b) for b in draws])).alias("k", "target")
    asked = written(missing.select("id", targets).select("id", (F.col("k") + 1).alias("m"), "target"), "recipients")
    drawn = nearest_donors(known.select("id", predicted(fitted).alias("pred"), "value"), asked, donors, seed)
    kept = known.select("id", F.explode(F.sequence(F.lit(1), F.lit(m))).alias("m"), "value")
    return kept.unionByName(drawn).select(F.col("id").alias(row), "m", F.col("value").alias("valeur"))


def student_quantile(p: float, df: float) -> float:
    """Quantile of Student's t by bisection on the incomplete beta function."""
    if math.isinf(df) or df > 1e7:
        return statistics.NormalDist().inv_cdf(p)

    def tail(t: float) -> float:
        return 0.5 * _beta_inc(df / 2, 0.5, df / (df + t * t))

    low, high = 0.0, 1.0
    while tail(high) > 1 - p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if tail(mid) > 1 - p else (low, mid)
    return (low + high) / 2


def _beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_inc(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1 - (a + b) * x / (a + 1), tiny)
    total = d
    for i in range(1, 500):
        even = i * (b - i) * x / ((a + 2 * i - 1) * (a + 2 * i))
        odd = -(a + i) * (a + b + i) * x / ((a + 2 * i) * (a + 2 * i + 1))
        for term in (even, odd):
            d = 1 / (1 + term * d or tiny)
            c = 1 + term / c or tiny
            total *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * total


_student = F.udf(lambda df: None if df is None else student_quantile(0.975, df), T.DoubleType())


def pool_rubin(estimates: DataFrame, normal: bool = False) -> DataFrame:
    """Pooled mean, variances, degrees of freedom and 95 % interval of (estimation, variance) rows.

    The table has one row per imputation. ``normal`` uses the between variance and the normal
    quantile only.
    """
    m = F.col("m")
    pooled = estimates.agg(
        F.count("*").alias("m"),
        F.avg("estimation").alias("moyenne"),
        F.avg("variance").alias("intra"),
        F.coalesce(F.var_samp("estimation"), F.lit(0.0)).alias("inter"),
    )
    between = (1 + 1 / m) * F.col("inter")
    if normal:
        pooled = pooled.withColumns({"variance_totale": between, "ddl": F.lit(None).cast("double")})
        width = F.lit(1.96) * F.sqrt("variance_totale")
    else:
        pooled = pooled.withColumns(
            {
                "variance_totale": F.col("intra") + between,
                "ddl": (m - 1) * F.pow(1 + F.col("intra") / F.nullif(between, F.lit(0.0)), F.lit(2.0)),
            }
        )
        quantile = F.coalesce(_student("ddl"), F.lit(NORMAL_975))
        width = quantile * F.sqrt("variance_totale")
    return pooled.withColumns(
        {
            "erreur_type": F.sqrt("variance_totale"),
            "ic_bas": F.col("moyenne") - width,
            "ic_haut": F.col("moyenne") + width,
        }
    )


def weighted_estimates(completed: DataFrame, weight: str) -> DataFrame:
    """Per imputation: weighted mean and its approximate variance, from sums taken in one pass."""
    w, x = F.col(weight), F.col("valeur")
    sums = completed.groupBy("m").agg(
        F.sum(w).alias("_w"),
        F.sum(w * x).alias("_wx"),
        F.sum(w * x * x).alias("_wxx"),
        F.count_if(w > 0).alias("_n"),
    )
    mean = F.col("_wx") / F.col("_w")
    spread = F.greatest(F.col("_wxx") / F.col("_w") - mean * mean, F.lit(0.0))
    return sums.select("m", mean.alias("estimation"), (spread / F.col("_n")).alias("variance"))


def individual_estimate(
    df: DataFrame, salary: str, response: str, row: str, categories: list[str], numbers: list[str], m: int = IMPUTATIONS
) -> DataFrame:
    """Individual declarations: response weights, matched log salaries, pooled weighted mean."""
    d = ipw_weights(df, response, categories, numbers)
    d = written(d.withColumn("_log", F.when(F.col(response) == 1, F.log(salary))), "individual")
    completed = pmm_impute(d, "_log", row, categories, numbers, m).withColumn("valeur", F.exp("valeur"))
    joined = completed.join(d.select(row, "w_ipw"), row)
    return pool_rubin(weighted_estimates(joined, "w_ipw"))


def employer_month_base(
    df: DataFrame, employer: str, month: str, salary: str, response: str, age: str, sex: str, female: str, size: str, sector: str
) -> DataFrame:
    """Headcount, declared headcount, declaration flag and means per employer and month."""
    first = F.struct("row_id")
    return (
        df.groupBy(employer, month)
        .agg(
            F.count("*").alias("n_total"),
            F.coalesce(F.sum(response), F.lit(0)).alias("n_declares"),
            F.avg(F.when(F.col(response) == 1, F.col(salary))).alias("salaire_moyen_obs"),
            F.avg(age).alias("age_moyen"),
            F.avg((F.col(sex) == female).cast("double")).alias("part_femmes"),
            F.min_by(size, first).alias("taille"),
            F.min_by(sector, first).alias("secteur"),
        )
        .withColumn("declare", (F.col("n_declares") > 0).cast("int"))
    )


def employer_estimate(base: DataFrame, employer: str, month: str, m: int = IMPUTATIONS) -> DataFrame:
    """Employer declarations: weights × headcount on matched mean salaries, normal interval."""
    d = declaration_history(base, employer, month, "declare").withColumns(
        {
            "log_taille": F.log("taille"),
            "_mois": F.col(month).cast("string"),
            "_log": F.log("salaire_moyen_obs"),
            "_row": F.struct(employer, month),
        }
    )
    numbers = ["log_taille", "age_moyen", "part_femmes", "hist_decl_1", "hist_decl_3"]
    d = written(ipw_weights(written(d, "employer"), "declare", ["secteur", "_mois"], numbers, "w_jt"), "employer")
    completed = pmm_impute(d, "_log", "_row", ["secteur"], numbers, m, seed=456)
    joined = completed.join(d.select("_row", (F.col("w_jt") * F.col("n_total")).alias("_w")), "_row")
    return pool_rubin(weighted_estimates(joined.withColumn("valeur", F.exp("valeur")), "_w"), normal=True)


def two_stage_estimate(
    df: DataFrame,
    base: DataFrame,
    employer: str,
    month: str,
    salary: str,
    response: str,
    categories: list[str],
    numbers: list[str],
) -> DataFrame:
    """Partial employer declarations: employer weight × individual weight, truncated weighted mean."""
    b = base.withColumns({"log_taille": F.log("taille"), "_mois": F.col(month).cast("string")})
    b = written(response_probability(b, "declare", ["secteur", "_mois"], ["log_taille"]), "stage1")
    rate = b.agg(F.avg(F.col("declare").cast("double"))).scalar()
    b = b.where("declare = 1").select(employer, month, (rate / F.col("pi_hat")).alias("w_e"))
    inside = df.join(b, [employer, month])
    scored = written(response_probability(inside, response, categories, numbers), "stage2")
    share = scored.agg(F.avg(F.col(response).cast("double"))).scalar()
    respondents = scored.where(F.col(response) == 1).withColumn("w", F.col("w_e") * share / F.col("pi_hat"))
    final = truncate_weights(respondents, "w", F.lit(True)).select(
        F.col("w"), F.col(salary).alias("valeur"), F.lit(1).alias("m"), employer
    )
    one = weighted_estimates(final, "w").select(F.col("estimation").alias("moyenne"), F.col("variance"))
    width = F.lit(1.96) * F.sqrt("variance")
    firms = final.agg(F.count_distinct(employer)).scalar()
    return one.select(
        "moyenne",
        F.sqrt("variance").alias("erreur_type"),
        (F.col("moyenne") - width).alias("ic_bas"),
        (F.col("moyenne") + width).alias("ic_haut"),
        firms.alias("n_entreprises"),
    )
