"""Payroll-shaped inputs derived from the given tables.

Each text runs unchanged on Spark and on DuckDB. The Spark queries start from these frames and
the oracle statements inline the same texts, so both sides read the whole given tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SOURCES = {
    "panel_src": ["orders", "customer", "nation"],
    "paycodes": ["lineitem"],
    "dim_organisme": ["nation"],
    "dim_emploi": ["customer"],
}

TEXTS = {
    "panel_src": """
SELECT o.o_orderkey AS row_id,
  CAST(c.c_custkey AS STRING) AS matricule,
  concat(CAST(c.c_custkey AS STRING), '||', CAST(o.o_orderkey % 2 + c.c_nationkey AS STRING)) AS cle_unique,
  c.c_name AS nom,
  CASE WHEN c.c_custkey % 20 = 19 THEN NULL WHEN c.c_custkey % 20 = 18 THEN '?'
       WHEN c.c_custkey % 4 = 0 THEN 'Masculin' WHEN c.c_custkey % 4 = 1 THEN 'F'
       WHEN c.c_custkey % 4 = 2 THEN '1' ELSE ' féminin ' END AS sexe,
  CASE WHEN o.o_orderkey % 97 = 0 THEN 'Retraite' WHEN o.o_orderkey % 89 = 0 THEN NULL
       WHEN o.o_orderstatus = 'P' THEN 'Demi-Solde' WHEN o.o_orderkey % 13 = 0 THEN 'Régul.  indemnités'
       WHEN o.o_orderstatus = 'F' THEN ' En activité' ELSE 'ACTIVITE' END AS situation,
  n.n_name AS organisme,
  CASE WHEN c.c_nationkey % 8 = 7 THEN NULL ELSE lpad(CAST(c.c_nationkey AS STRING), 3, '0') END AS CODE_ORGANISME,
  c.c_mktsegment AS emploi,
  CASE WHEN c.c_custkey % 50 = 49 THEN NULL ELSE substr(c.c_mktsegment, 1, 3) END AS CODE_EMPLOI,
  CASE WHEN c.c_custkey % 12 = 11 THEN 'Contractuel' WHEN c.c_custkey % 12 = 10 THEN NULL
       WHEN o.o_orderkey % 17 = 0 THEN 'Catégorie B7' WHEN o.o_orderkey % 19 = 0 THEN 'categorie a'
       ELSE concat('Fonctionnaire Catégorie ', substr('ABCD', CAST(c.c_custkey % 4 AS INT) + 1, 1),
                   CAST(c.c_custkey % 3 + 1 AS STRING)) END AS statut_fonctionnaire,
  concat(lpad(CAST(month(o.o_orderdate) AS STRING), 2, '0'), CAST(year(o.o_orderdate) AS STRING)) AS mois_annee,
  CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS INT) AS periode,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_totalprice END AS montant_brut,
  CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 101 = 0 THEN o.o_totalprice * 1.5e0
       ELSE o.o_totalprice * 0.75e0 END AS montant_net,
  CASE WHEN c.c_custkey % 5 = 0 THEN concat(CAST(1950 + c.c_custkey % 50 AS STRING), '-', lpad(CAST(1 + c.c_custkey % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + c.c_custkey % 28 AS STRING), 2, '0'))
       WHEN c.c_custkey % 5 = 1 THEN concat(lpad(CAST(1 + c.c_custkey % 28 AS STRING), 2, '0'), '/', lpad(CAST(1 + c.c_custkey % 12 AS STRING), 2, '0'), '/', CAST(1950 + c.c_custkey % 50 AS STRING))
       WHEN c.c_custkey % 5 = 2 THEN CAST(18300 + c.c_custkey % 15000 AS STRING)
       WHEN c.c_custkey % 5 = 3 THEN '00/00/0000' ELSE NULL END AS date_naissance,
  CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE concat(CAST(1985 + c.c_custkey % 10 AS STRING), '-0', CAST(1 + (c.c_custkey + CASE WHEN o.o_orderkey % 37 = 0 THEN 1 ELSE 0 END) % 9 AS STRING), '-01') END AS prise_service,
  CASE WHEN o.o_orderkey % 41 = 0 THEN NULL WHEN o.o_orderkey % 43 = 0 THEN '14' ELSE CAST((c.c_custkey + o.o_orderkey % 2) % 6 AS STRING) END AS nombre_enfant,
  CASE WHEN o.o_orderkey % 29 = 0 THEN NULL WHEN (c.c_custkey + o.o_orderkey % 3) % 4 = 0 THEN 'Célibataire' WHEN (c.c_custkey + o.o_orderkey % 3) % 4 = 1 THEN 'Femme Mariée' WHEN (c.c_custkey + o.o_orderkey % 3) % 4 = 2 THEN 'Veuf / veuve' ELSE 'Cas Particulier' END AS situation_matrimoniale
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
    "paycodes": """
SELECT l_orderkey AS row_id,
  CASE l_linenumber WHEN 1 THEN '124' WHEN 2 THEN '228' WHEN 3 THEN '271' WHEN 4 THEN '421' WHEN 5 THEN '425' WHEN 6 THEN '195' ELSE '200' END AS code,
  l_extendedprice AS montant FROM lineitem
""",
    "dim_organisme": """
SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS code, concat(' ', lower(n_name), ' - ') AS libelle FROM nation WHERE n_nationkey % 8 <> 7
UNION ALL SELECT concat('9', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS code, n_name AS libelle FROM nation WHERE n_nationkey % 10 = 3
""",
    "dim_emploi": """
SELECT DISTINCT substr(c_mktsegment, 1, 3) AS code, lower(c_mktsegment) AS libelle,
  CASE c_mktsegment WHEN 'BUILDING' THEN '7111' WHEN 'MACHINERY' THEN '8121' WHEN 'AUTOMOBILE' THEN '3115' ELSE '2221' END AS Code_CITP,
  concat('Métier ', c_mktsegment) AS Metier_CITP
FROM customer WHERE c_mktsegment <> 'FURNITURE'
""",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def frame(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the derived inputs as a lazy DataFrame."""
    tables = SOURCES[name]
    text = re.sub(r"\b(FROM|JOIN) (" + "|".join(tables) + r")\b", r"\1 {\2}", TEXTS[name])
    # braces appear nowhere else in the texts
    return spark.sql(text, **{t: table(spark, sf, t) for t in tables})
