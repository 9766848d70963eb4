"""Registered queries and the independent SQL each one is compared with.

Oracle statements name shared CTEs freely; ``oracle`` puts the needed definitions in front.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.fixture import TEXTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VALID = "('A1','A2','A3','A4','A5','A6','A7','B1','B2','B3','B4','B5','B6','C1','C2','C3','C4','C5','D1','D2','D3')"
INVALID = "('B7','C7','D7','A','B','C','D')"

# Shared definitions, each written from the rule it stands for.
CTES: dict[str, str] = {
    **TEXTS,
    "graded": """
SELECT p.*, CAST(substr(mois_annee, 3, 4) AS INTEGER) AS annee, CAST(substr(mois_annee, 1, 2) AS INTEGER) AS mois,
  CASE WHEN regexp_matches(upper(strip_accents(coalesce(statut_fonctionnaire, ''))), 'CATEGORIE\\s+[ABCD]')
       THEN regexp_extract(upper(strip_accents(statut_fonctionnaire)), 'CATEGORIE\\s+([ABCD][0-9]*)', 1)
       ELSE 'NF' END AS GRADE,
  CASE WHEN regexp_replace(trim(upper(strip_accents(situation))), '\\s+', ' ', 'g') IN ('EN ACTIVITE', 'ACTIVITE') THEN 'en_activite'
       WHEN regexp_replace(trim(upper(strip_accents(situation))), '\\s+', ' ', 'g')
            IN ('REGUL. INDEMNITES', 'REGUL INDEMNITES', 'REGULARISATION INDEMNITES') THEN 'regul_indemnites'
       WHEN regexp_replace(trim(upper(strip_accents(situation))), '\\s+', ' ', 'g')
            IN ('DEMI-SOLDE', 'DEMI SOLDE', 'DEMISOLDE', '1/2 SOLDE') THEN 'demi_solde'
       ELSE 'autre' END AS situation_normalisee,
  CASE WHEN upper(strip_accents(trim(sexe))) IN ('MASCULIN','M','H','HOMME','MALE','MASC','1') THEN 'Homme'
       WHEN upper(strip_accents(trim(sexe))) IN ('FEMININ','F','FEMME','FEMALE','FEMININE','FEM','2') THEN 'Femme'
       ELSE 'Inconnu' END AS SEXE_STD
FROM panel_src p""",
    "silver": "SELECT * FROM graded WHERE situation_normalisee <> 'autre'",
    # modal grade by repeated 'no other grade is better' tests
    "valid_counts": f"SELECT emploi, annee, mois, GRADE AS g, count(*) AS n FROM silver WHERE GRADE IN {VALID} GROUP BY ALL",
    "mode1": """
SELECT emploi, annee, mois, g AS GRADE_P1 FROM (
  SELECT *, row_number() OVER (PARTITION BY emploi, annee, mois ORDER BY n DESC, g) AS rk FROM valid_counts) WHERE rk = 1""",
    "mode2": """
SELECT emploi, annee, g AS GRADE_P2 FROM (
  SELECT emploi, annee, g, row_number() OVER (PARTITION BY emploi, annee ORDER BY sum(n) DESC, g) AS rk
  FROM valid_counts GROUP BY emploi, annee, g) WHERE rk = 1""",
    "mode3": """
SELECT emploi, g AS GRADE_P3 FROM (
  SELECT emploi, g, row_number() OVER (PARTITION BY emploi ORDER BY sum(n) DESC, g) AS rk
  FROM valid_counts GROUP BY emploi, g) WHERE rk = 1""",
    "imputed": f"""
SELECT s.* EXCLUDE (GRADE),
  CASE WHEN s.GRADE IN {INVALID} THEN coalesce(GRADE_P1, GRADE_P2, GRADE_P3, s.GRADE) ELSE s.GRADE END AS GRADE,
  CASE WHEN s.GRADE IN {VALID} THEN 'OBSERVE'
       WHEN s.GRADE IN {INVALID} AND coalesce(GRADE_P1, GRADE_P2, GRADE_P3) IS NOT NULL THEN 'IMPUTE'
       ELSE 'NF_NON_IMPUTABLE' END AS GRADE_SOURCE
FROM silver s LEFT JOIN mode1 m1 ON s.emploi = m1.emploi AND s.annee = m1.annee AND s.mois = m1.mois
LEFT JOIN mode2 m2 ON s.emploi = m2.emploi AND s.annee = m2.annee LEFT JOIN mode3 m3 ON s.emploi = m3.emploi""",
    "panel": """
SELECT i.*, d.Code_CITP, d.Metier_CITP FROM imputed i LEFT JOIN dim_emploi d ON upper(d.libelle) = i.emploi
WHERE row_id = (SELECT min(row_id) FROM silver k WHERE k.matricule = i.matricule AND k.mois_annee = i.mois_annee)""",
}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its oracle, omitted where SQL cannot state the result."""

    def deco(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def define(name: str, sql: str) -> None:
    CTES[name] = sql


def oracle(sql: str) -> str:
    """Statement with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        words = set(re.findall(r"[A-Za-z_0-9]+", text))
        for name in CTES:
            if name in words and name not in order:
                visit_cte(name)

    def visit_cte(name: str) -> None:
        if name in order:
            return
        words = set(re.findall(r"[A-Za-z_0-9]+", CTES[name])) - {name}
        for dep in CTES:
            if dep in words:
                visit_cte(dep)
        order.append(name)

    visit(sql)
    if not order:
        return sql
    body = ",\n".join(f"{n} AS ({CTES[n]})" for n in order)
    own = re.match(r"\s*WITH\s+", sql)
    return f"WITH {body},\n{sql[own.end():]}" if own else f"WITH {body}\n{sql}"
