"""Person-level codes: sex, situation, age band, status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paypanel.functions.grades import lookup
from paypanel.functions.text import _col, norm_label_lower, squeeze, strip_accents

# Spellings of each sex.
MALE_WORDS = ["MASCULIN", "M", "H", "HOMME", "MALE", "MASC", "1"]
FEMALE_WORDS = ["FEMININ", "F", "FEMME", "FEMALE", "FEMININE", "FEM", "2"]

# Spellings of the situations that stay in the panel.
SITUATIONS = {
    "en_activite": ["EN ACTIVITE", "ACTIVITE"],
    "regul_indemnites": ["REGUL. INDEMNITES", "REGUL INDEMNITES", "REGULARISATION INDEMNITES"],
    "demi_solde": ["DEMI-SOLDE", "DEMI SOLDE", "DEMISOLDE", "1/2 SOLDE"],
}
KEPT_SITUATIONS = list(SITUATIONS)

# Month names.
MONTHS_FR = [
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
]

# Marital status recode.
MARITAL = {
    "Célibataire": "Célibataire",
    "Cas Particulier": "Autres",
    "Divorcé Séparé": "Divorcé/Séparé",
    "Femme Mariée": "Marié(e)",
    "Invalide Marié": "Marié(e)",
    "Marié": "Marié(e)",
    "Veuf / veuve": "Veuf/Veuve",
}

# Marital status recode used by the coherence flags (normalised spelling).
MARITAL_FLAG_CODES = {
    ("celibataire", "celib"): "celibataire",
    ("marie", "mariee", "femme mariee", "invalide marie"): "marie(e)",
    ("union libre", "concubinage", "concubin"): "union libre",
    ("divorce", "divorce separe", "separe"): "divorce/separe",
    ("veuf", "veuve"): "veuf/veuve",
    ("cas particulier", "autre", "autres"): "autres",
}


def std_sex(c: Column | str) -> Column:
    """Homme / Femme / Inconnu from any known spelling."""
    s = squeeze(strip_accents(F.upper(_col(c).cast("string"))))
    return lookup(s, {tuple(MALE_WORDS): "Homme", tuple(FEMALE_WORDS): "Femme"}, F.lit("Inconnu"))


def sex_letter(c: Column | str) -> Column:
    """M / F, NULL when unknown."""
    return lookup(std_sex(c), {"Homme": "M", "Femme": "F"})


def normalize_situation(c: Column | str) -> Column:
    """One of the three kept situations, else 'autre'."""
    s = squeeze(strip_accents(F.upper(_col(c))))
    return lookup(s, {tuple(words): name for name, words in SITUATIONS.items()}, F.lit("autre"))


def month_fr(c: Column | str) -> Column:
    m = _col(c)
    return F.when(m.between(1, 12), F.element_at(F.array(*[F.lit(x) for x in MONTHS_FR]), m.cast("int")))


def age_band(birth: Column | str, ref_year: int = 2024) -> Column:
    """Ten-year band from the leading four digits of a birth date text."""
    age = F.lit(ref_year) - F.substring(_col(birth).cast("string"), 1, 4).try_cast("int")
    return (
        F.when(age.isNull(), "Inconnu")
        .when(age < 30, "< 30 ans")
        .when(age < 40, "30–39 ans")
        .when(age < 50, "40–49 ans")
        .when(age < 60, "50–59 ans")
        .otherwise("60 ans +")
    )


def status_from_id(c: Column | str) -> Column:
    """Contract type carried by the first digit of the person id."""
    first = F.substring(F.trim(_col(c)), 1, 1)
    return F.when(first == "5", "Contractuel").when(first == "6", "Gens de maison").otherwise("Fonctionnaire")


def recode_marital(c: Column | str) -> Column:
    col = _col(c)
    return F.coalesce(lookup(col, MARITAL), col)


def marital_flag_code(c: Column | str) -> Column:
    """Recode for the coherence flags; unknown spellings stay as they are, NULL stays NULL."""
    s = norm_label_lower(c)
    return F.coalesce(lookup(s, MARITAL_FLAG_CODES), s)


def marital_is_mapped(c: Column | str) -> Column:
    known = [w for words in MARITAL_FLAG_CODES for w in words]
    return norm_label_lower(c).isin(*known)


def children_count(c: Column | str, fill: int = 0) -> Column:
    """Whole number of children; unreadable cells take ``fill``."""
    return F.bround(F.coalesce(_col(c).try_cast("double"), F.lit(float(fill))), 0).cast("bigint")


def build_status(job: Column | str, cat1: Column | str, cat2: Column | str) -> Column:
    """Three-way status from job presence and the two grade categories."""
    has_job = F.coalesce(F.trim(_col(job)) != "", F.lit(False))
    nf = "Non Fonctionnaire"
    one, two = _col(cat1) == nf, _col(cat2) == nf
    return (
        F.when(has_job & (one | two), "Cas particulier")
        .when(~has_job & ~(one & two), "Cas particulier")
        .when(has_job, "Fonctionnaire")
        .otherwise(nf)
    )
