"""Grade and salary imputation, ordered carrying, winsorisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.frames import frame, graded, imputed, panel, rounded, silver
from checks.registry import INVALID, define, register
from paypanel.functions.people import sex_letter, status_from_id
from paypanel.functions.text import norm_label
from paypanel.operators import imputation as imp
from paypanel.operators import windows as win

IDS = ["row_id", "cle_unique", "periode"]


@register("a13_grade_modal_p1", "SELECT * FROM mode1")
def _(spark, sf):
    return imp.grade_modal_lookups(silver(spark, sf))["P1"]


@register("a13_grade_modal_p2", "SELECT * FROM mode2")
def _(spark, sf):
    return imp.grade_modal_lookups(silver(spark, sf))["P2"]


@register("a13_grade_modal_p3", "SELECT * FROM mode3")
def _(spark, sf):
    return imp.grade_modal_lookups(silver(spark, sf))["P3"]


define(
    "history",
    f"""SELECT cle_unique, emploi, GRADE AS g, count(*) AS n FROM silver WHERE GRADE NOT IN {INVALID} GROUP BY ALL""",
)
AGENT_MODE = """SELECT cle_unique, emploi, min(g) AS GRADE_MODAL FROM history h
WHERE n = (SELECT max(n) FROM history k WHERE k.cle_unique = h.cle_unique AND k.emploi = h.emploi) GROUP BY ALL"""


@register("a14_agent_modal_grade", AGENT_MODE)
def _(spark, sf):
    return imp.agent_modal_grade(silver(spark, sf))


define("agent_mode", AGENT_MODE)


@register(
    "a14_impute_from_history",
    f"""SELECT s.row_id, CASE WHEN s.GRADE IN {INVALID} THEN coalesce(GRADE_MODAL, s.GRADE) ELSE s.GRADE END AS GRADE
FROM silver s LEFT JOIN agent_mode a ON a.cle_unique = s.cle_unique AND a.emploi = s.emploi""",
)
def _(spark, sf):
    return imp.impute_grades_from_history(silver(spark, sf)).select("row_id", "GRADE")


@register("i01_impute_grades", "SELECT row_id, emploi, mois_annee, GRADE, GRADE_SOURCE FROM imputed")
def _(spark, sf):
    return imputed(spark, sf).select("row_id", "emploi", "mois_annee", "GRADE", "GRADE_SOURCE")


# medians of the cells: exact middle of the observed values
for _value, _tag in (("montant_brut", "b"), ("montant_net", "n")):
    for _name, (_keys, _min) in imp.LEVELS.items():
        _k = ", ".join(_keys)
        define(
            f"med_{_tag}_{_name}",
            f"SELECT {_k}, quantile_cont({_value}, 0.5) AS m, count(*) AS n FROM imputed "
            f"WHERE {_value} IS NOT NULL GROUP BY {_k}",
        )


def _median_sql(level: str, min_obs: int) -> str:
    keys = ", ".join(imp.LEVELS[level][0])
    return f"SELECT {keys}, round(m, 6) AS mediane FROM med_b_{level} WHERE n >= {min_obs}"


def _median_query(level: str, min_obs: int):
    def run(spark, sf):
        return rounded(imp.median_level(imputed(spark, sf), level, "montant_brut", min_obs), 6, "mediane")

    return run


for _name, (_keys, _min) in imp.LEVELS.items():
    register(f"a15_median_{_name}", _median_sql(_name, _min))(_median_query(_name, _min))
register("a15_median_L1_min2", _median_sql("L1", 2))(_median_query("L1", 2))


def _cascade(tag: str, row: str, mins: dict[str, int]) -> str:
    """(value, level) of the first level with enough observations, as scalar subqueries."""
    value, level = [], []
    for name, (keys, _) in imp.LEVELS.items():
        cond = " AND ".join(f"x.{k} = {row}.{k}" for k in keys)
        pick = f"(SELECT m FROM med_{tag}_{name} x WHERE {cond} AND x.n >= {mins[name]})"
        value.append(pick)
        level.append(f"WHEN {pick} IS NOT NULL THEN 'IMPUTE_{name}'")
    return f"coalesce({', '.join(value)})", f"CASE {' '.join(level)} END"


def _median_only_sql(mins: dict[str, int]) -> str:
    out = []
    for value, tag in (("montant_brut", "b"), ("montant_net", "n")):
        v, lev = _cascade(tag, "t", mins)
        out.append(f"round(coalesce(t.{value}, {v}), 6) AS {value}")
        out.append(
            f"CASE WHEN t.{value} IS NOT NULL THEN 'OBSERVE' ELSE coalesce({lev}, 'NON_IMPUTABLE') END AS {value}_SOURCE"
        )
    return f"SELECT t.row_id, {', '.join(out)} FROM imputed t"


SAL = ["montant_brut", "montant_net", "montant_brut_SOURCE", "montant_net_SOURCE"]
DEFAULT_MIN = {name: n for name, (_, n) in imp.LEVELS.items()}
MIN2 = dict.fromkeys(imp.LEVELS, 2)


@register("i02_median_cascade_default", _median_only_sql(DEFAULT_MIN))
def _(spark, sf):
    return rounded(imp.impute_by_median(imputed(spark, sf)).select("row_id", *SAL), 6, *imp.SALARIES)


@register("i02_median_cascade_min2", _median_only_sql(MIN2))
def _(spark, sf):
    out = imp.impute_by_median(imputed(spark, sf), min_obs=MIN2)
    return rounded(out.select("row_id", *SAL), 6, *imp.SALARIES)


# carried values stated as 'the nearest earlier / later observed row of the same post'
for _value, _tag in (("montant_brut", "b"), ("montant_net", "n")):
    define(
        f"carry_{_tag}",
        f"""SELECT t.row_id,
  (SELECT arg_max({_value}, periode * 10000000000 + row_id) FROM imputed e WHERE e.cle_unique = t.cle_unique
     AND e.{_value} IS NOT NULL AND (e.periode < t.periode OR (e.periode = t.periode AND e.row_id <= t.row_id))) AS f,
  (SELECT arg_min({_value}, periode * 10000000000 + row_id) FROM imputed l WHERE l.cle_unique = t.cle_unique
     AND l.{_value} IS NOT NULL AND (l.periode > t.periode OR (l.periode = t.periode AND l.row_id >= t.row_id))) AS b
FROM imputed t""",
    )


def _full_sql(mins: dict[str, int]) -> str:
    out = []
    for value, tag in (("montant_brut", "b"), ("montant_net", "n")):
        v, lev = _cascade(tag, "t", mins)
        out.append(f"round(coalesce(t.{value}, c{tag}.f, c{tag}.b, {v}), 6) AS {value}")
        out.append(
            f"CASE WHEN t.{value} IS NOT NULL THEN 'OBSERVE' WHEN c{tag}.f IS NOT NULL THEN 'LOCF_FWD' "
            f"WHEN c{tag}.b IS NOT NULL THEN 'LOCF_BWD' ELSE coalesce({lev}, 'NON_IMPUTABLE') END AS {value}_SOURCE"
        )
    return (
        f"SELECT t.row_id, {', '.join(out)} FROM imputed t "
        "LEFT JOIN carry_b cb ON cb.row_id = t.row_id LEFT JOIN carry_n cn ON cn.row_id = t.row_id"
    )


@register("i02_impute_salaries", _full_sql(DEFAULT_MIN))
def _(spark, sf):
    return rounded(imp.impute_salaries(imputed(spark, sf)).select("row_id", *SAL), 6, *imp.SALARIES)


@register("i02_impute_salaries_min2", _full_sql(MIN2))
def _(spark, sf):
    out = imp.impute_salaries(imputed(spark, sf), min_obs=MIN2)
    return rounded(out.select("row_id", *SAL), 6, *imp.SALARIES)


define("salaries", _full_sql(DEFAULT_MIN))


@register(
    "i03_imputation_report",
    """SELECT montant_brut_SOURCE AS source, count(*) AS n,
round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM salaries), 1) AS pct FROM salaries GROUP BY 1""",
)
def _(spark, sf):
    return imp.imputation_report(imp.impute_salaries(imputed(spark, sf)), "montant_brut_SOURCE")


@register(
    "i03_grade_report",
    """SELECT GRADE_SOURCE AS source, count(*) AS n,
round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM imputed), 1) AS pct FROM imputed GROUP BY 1""",
)
def _(spark, sf):
    return imp.imputation_report(imputed(spark, sf), "GRADE_SOURCE")


@register(
    "w01_locf_forward",
    "SELECT t.row_id, t.cle_unique, t.periode, c.f AS brut_fwd FROM imputed t JOIN carry_b c ON c.row_id = t.row_id",
)
def _(spark, sf):
    return win.locf_forward(silver(spark, sf), "cle_unique", "montant_brut", "brut_fwd").select(*IDS, "brut_fwd")


@register(
    "w02_locf_backward",
    """SELECT t.row_id, t.cle_unique, t.periode, coalesce(t.montant_brut, CASE WHEN c.f IS NULL THEN c.b END) AS brut_bwd
FROM imputed t JOIN carry_b c ON c.row_id = t.row_id""",
)
def _(spark, sf):
    return win.locf_backward(silver(spark, sf), "cle_unique", "montant_brut", "brut_bwd").select(*IDS, "brut_bwd")


# nearest rank: 1 + floor((n - 1) p + 0.5)
def _nearest(value: str, p: float, src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return (
        f"SELECT {k}, v AS q FROM (SELECT {k}, {value} AS v, row_number() OVER (PARTITION BY {k} ORDER BY {value}) AS r, "
        f"count(*) OVER (PARTITION BY {k}) AS n FROM {src} WHERE {value} IS NOT NULL) "
        f"WHERE r = 1 + floor((n - 1) * {p}::DOUBLE + 0.5::DOUBLE)"
    )


FINE, COARSE = ["annee", "mois", "GRADE", "Code_CITP"], ["annee", "mois", "GRADE"]
define("wins_lo_f", _nearest("montant_brut", 0.05, "panel", FINE))
define("wins_hi_f", _nearest("montant_brut", 0.95, "panel", FINE))
define("wins_lo_c", _nearest("montant_brut", 0.05, "panel", COARSE))
define("wins_hi_c", _nearest("montant_brut", 0.95, "panel", COARSE))


def _wins_sql(min_n: int) -> str:
    def on(alias: str, keys: list[str]) -> str:
        return " AND ".join(f"{alias}.{k} IS NOT DISTINCT FROM p.{k}" for k in keys)

    return f"""SELECT p.row_id, CASE WHEN p.montant_brut IS NULL THEN NULL
  WHEN (SELECT count(*) FROM panel z WHERE {on("z", FINE)}) >= {min_n}
  THEN least(greatest(p.montant_brut, lf.q), hf.q) ELSE least(greatest(p.montant_brut, lc.q), hc.q) END AS brut_w
FROM panel p LEFT JOIN wins_lo_f lf ON {on("lf", FINE)} LEFT JOIN wins_hi_f hf ON {on("hf", FINE)}
LEFT JOIN wins_lo_c lc ON {on("lc", COARSE)} LEFT JOIN wins_hi_c hc ON {on("hc", COARSE)}"""


@register("w03_winsorize_min5", _wins_sql(5))
def _(spark, sf):
    out = win.winsorize(panel(spark, sf), "montant_brut", FINE, COARSE, "brut_w", p=0.05, min_n=5)
    return out.select("row_id", "brut_w")


@register("w03_winsorize_default", _wins_sql(100))
def _(spark, sf):
    out = win.winsorize(panel(spark, sf), "montant_brut", FINE, COARSE, "brut_w", p=0.05)
    return out.select("row_id", "brut_w")


STATUS = """CASE substr(trim(matricule), 1, 1) WHEN '5' THEN 'Contractuel' WHEN '6' THEN 'Gens de maison'
ELSE 'Fonctionnaire' END"""
define("by_status", f"SELECT s.*, {STATUS} AS STATUT FROM silver s")
define(
    "contract",
    "SELECT * FROM by_status WHERE STATUT IN ('Contractuel', 'Gens de maison') AND montant_brut IS NOT NULL",
)


@register(
    "w04_winsorize_linear",
    """WITH f AS (SELECT annee, SEXE_STD, GRADE, STATUT, count(*) AS n, quantile_cont(montant_brut, 0.01) AS lo,
    quantile_cont(montant_brut, 0.99) AS hi FROM contract GROUP BY ALL),
  c AS (SELECT annee, STATUT, quantile_cont(montant_brut, 0.01) AS lo, quantile_cont(montant_brut, 0.99) AS hi
    FROM contract GROUP BY ALL)
SELECT s.row_id, s.STATUT, round(CASE WHEN s.STATUT = 'Fonctionnaire' OR s.montant_brut IS NULL THEN s.montant_brut
  WHEN f.n >= 30 THEN least(greatest(s.montant_brut, f.lo), f.hi)
  ELSE least(greatest(s.montant_brut, c.lo), c.hi) END, 6) AS brut_w
FROM by_status s LEFT JOIN f ON f.annee = s.annee AND f.SEXE_STD = s.SEXE_STD AND f.GRADE = s.GRADE AND f.STATUT = s.STATUT
LEFT JOIN c ON c.annee = s.annee AND c.STATUT = s.STATUT""",
)
def _(spark, sf):
    d = silver(spark, sf).withColumn("STATUT", status_from_id("matricule"))
    only = F.col("STATUT").isin("Contractuel", "Gens de maison")
    by = ["annee", "SEXE_STD", "GRADE", "STATUT"]
    out = win.winsorize_linear(d, "montant_brut", by, ["annee", "STATUT"], "brut_w", only)
    return rounded(out.select("row_id", "STATUT", "brut_w"), 6, "brut_w")


@register(
    "w05_dedup_panel",
    """SELECT matricule, mois_annee, min(row_id) AS row_id FROM silver GROUP BY ALL""",
)
def _(spark, sf):
    return win.dedup_panel(silver(spark, sf), ["matricule", "mois_annee"]).select("matricule", "mois_annee", "row_id")


@register(
    "w06_latest_value",
    """SELECT matricule, sexe AS sexe_dernier FROM panel_src t WHERE sexe IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM panel_src l WHERE l.matricule = t.matricule AND l.sexe IS NOT NULL
  AND (l.periode > t.periode OR (l.periode = t.periode AND l.row_id > t.row_id)))""",
)
def _(spark, sf):
    return imp.latest_value(frame(spark, sf, "panel_src"), "matricule", "sexe", ["periode", "row_id"])


define(
    "text_grade",
    """SELECT s.*, CASE WHEN upper(strip_accents(trim(statut_fonctionnaire))) LIKE 'FONCTIONNAIRE%'
  THEN nullif(regexp_extract(upper(strip_accents(statut_fonctionnaire)), 'CATEGORIE\\s+([ABCD]\\s*[0-9]?)\\b', 1), '') END AS tg
FROM by_status s""",
)


@register(
    "w07_ffill_grade",
    """SELECT t.row_id, CASE WHEN t.STATUT <> 'Fonctionnaire' THEN 'NF' ELSE coalesce((
  SELECT arg_max(tg, periode * 10000000000 + row_id) FROM text_grade e WHERE e.matricule = t.matricule AND e.tg IS NOT NULL
    AND (e.periode < t.periode OR (e.periode = t.periode AND e.row_id <= t.row_id))), 'NF') END AS GRADE_DEFINITIF
FROM text_grade t""",
)
def _(spark, sf):
    d = silver(spark, sf).withColumn("STATUT", status_from_id("matricule"))
    out = win.ffill_grade(d, "matricule", "statut_fonctionnaire", "STATUT", "GRADE_DEFINITIF")
    return out.select("row_id", "GRADE_DEFINITIF")


@register(
    "a16_group_median_fill",
    """WITH g AS (SELECT annee, mois, SEXE_STD, quantile_cont(montant_net, 0.5) AS m FROM graded GROUP BY ALL),
  o AS (SELECT quantile_cont(montant_net, 0.5) AS m FROM graded)
SELECT s.row_id, round_even(coalesce(s.montant_net, g.m, (SELECT m FROM o)), 0) AS net_impute
FROM graded s LEFT JOIN g ON g.annee = s.annee AND g.mois = s.mois AND g.SEXE_STD = s.SEXE_STD""",
)
def _(spark, sf):
    keys = ["annee", "mois", "SEXE_STD"]
    return imp.group_median_fill(graded(spark, sf), "montant_net", keys, "net_impute").select("row_id", "net_impute")


@register(
    "a17_group_mode_fill",
    """WITH x AS (SELECT *, CASE SEXE_STD WHEN 'Homme' THEN 'M' WHEN 'Femme' THEN 'F' END AS s FROM graded),
  c AS (SELECT annee, mois, s, count(*) AS n FROM x WHERE s IS NOT NULL GROUP BY ALL),
  m AS (SELECT annee, mois, min(s) AS s FROM c a WHERE n = (
    SELECT max(n) FROM c b WHERE b.annee = a.annee AND b.mois = a.mois) GROUP BY ALL)
SELECT x.row_id, coalesce(x.s, m.s) AS sexe_impute FROM x LEFT JOIN m ON m.annee = x.annee AND m.mois = x.mois""",
)
def _(spark, sf):
    d = graded(spark, sf).withColumn("_s", sex_letter("sexe"))
    return imp.group_mode_fill(d, "_s", ["annee", "mois"], "sexe_impute").select("row_id", "sexe_impute")


@register(
    "i16_mapping_random",
    """WITH r AS (SELECT libelle, code, nullif(regexp_replace(trim(regexp_replace(upper(libelle), '[-.]', ' ', 'g')), '\\s+', ' ', 'g'), '') AS k
    FROM dim_organisme),
  c AS (SELECT DISTINCT k, code FROM r),
  m AS (SELECT k, arg_min(code, sha256(concat(k, code, '123'))) AS CODE_CHOISI, count(*) AS NB_CODES_POSSIBLES,
    string_agg(code, ', ' ORDER BY code) AS CODES_POSSIBLES, count(*) > 1 AS EST_AMBIGU FROM c GROUP BY k)
SELECT DISTINCT r.libelle, m.* EXCLUDE (k), m.k AS libelle_norm FROM r JOIN m ON m.k = r.k""",
)
def _(spark, sf):
    ref = frame(spark, sf, "dim_organisme").withColumn("libelle_norm", norm_label("libelle"))
    return imp.mapping_random(ref, "libelle_norm", "code", "libelle")


