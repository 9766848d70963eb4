"""Civil-service grades, job groups and pay scales."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paypanel.functions.text import _col

# The grade grid is letter + level, with this many levels per letter.
LEVELS = {"A": 7, "B": 6, "C": 5, "D": 3}
VALID_GRADES = [f"{letter}{i}" for letter, top in LEVELS.items() for i in range(1, top + 1)]
INVALID_GRADES = ["B7", "C7", "D7", "A", "B", "C", "D"]
NO_GRADE = "NF"

# Grades listed in the reporting views, by category.
REPORT_CATEGORIES = {
    "Catégorie A": ["A3", "A4", "A5", "A6", "A7"],
    "Catégorie B": ["B1", "B3"],
    "Catégorie C": ["C1", "C2", "C3"],
    "Catégorie D": ["D1", "D2"],
}
REPORT_GRADES = [g for grades in REPORT_CATEGORIES.values() for g in grades]

# Weight of the grade letter in the seniority order.
LETTER_WEIGHT = {"A": 80, "B": 70, "C": 60, "D": 50}

# Grades of primary teaching inside the primary + secondary scale.
PRIMARY_GRADES = ["B3", "C3", "D1", "D2"]
TEACHING_SCALE = "ENS SEC & PRIM"

# Labels of the nine international job groups.
CITP_LABELS = {
    1: "1 - Directeurs & cadres",
    2: "2 - Professions intellectuelles",
    3: "3 - Professions intermédiaires",
    4: "4 - Employés administratifs",
    5: "5 - Services & ventes",
    6: "6 - Agriculture",
    7: "7 - Métiers qualifiés",
    8: "8 - Opérateurs machines",
    9: "9 - Professions élémentaires",
}


def lookup(c: Column, mapping: dict, default: Column | None = None) -> Column:
    """Value of a literal table; tuple keys list several spellings. ``c`` is evaluated once."""
    flat = {k: v for key, v in mapping.items() for k in (key if isinstance(key, tuple) else (key,))}
    if all(isinstance(k, str) for k in flat):
        found = F.element_at(F.create_map(*[F.lit(x) for kv in flat.items() for x in kv]), c)
        return found if default is None else F.coalesce(found, default)
    out = None
    for key, value in flat.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out if default is None else out.otherwise(default)


def extract_grade(c: Column | str) -> Column:
    """Grade named after 'Catégorie' in a status text, else NF."""
    found = F.regexp_extract(_col(c), r"(?iu)Cat[eé]gorie\s+([ABCD][0-9]*)", 1)
    return F.coalesce(F.nullif(F.upper(found), F.lit("")), F.lit(NO_GRADE))


def civil_servant_grade(c: Column | str) -> Column:
    """Grade of a text that starts with 'Fonctionnaire', NULL for any other text."""
    s = F.translate(F.upper(F.trim(_col(c))), "É", "E")
    found = F.regexp_extract(s, r"^FONCTIONNAIRE.*CATEGORIE\s+([ABCD]\s*[0-9]?)\b", 1)
    return F.nullif(F.regexp_replace(found, r"\s", ""), F.lit(""))


def is_valid_grade(c: Column | str) -> Column:
    return _col(c).isin(*VALID_GRADES)


def is_invalid_grade(c: Column | str) -> Column:
    return _col(c).isin(*INVALID_GRADES)


def grade_order(c: Column | str) -> Column:
    """Seniority rank of a letter + one digit grade, 0 for anything else."""
    col = _col(c)
    weight = lookup(F.substring(col, 1, 1), LETTER_WEIGHT)
    ranked = weight + F.substring(col, 2, 1).try_cast("int")
    return F.when(col.rlike("^[ABCD][0-9]$"), ranked).otherwise(F.lit(0))


def grade_category(c: Column | str) -> Column:
    """Category label used by the reporting views."""
    table = {tuple(grades): label for label, grades in REPORT_CATEGORIES.items()}
    return lookup(_col(c), {**table, NO_GRADE: "Non Fonctionnaire"}, F.lit("Autre"))


def grade_letter_category(c: Column | str) -> Column:
    """Category label from the first letter."""
    table = {letter: f"Catégorie {letter}" for letter in LEVELS}
    return lookup(F.substring(_col(c), 1, 1), table, F.lit("Autre"))


def citp_group(c: Column | str) -> Column:
    """Job group from the leading digit of the trimmed code (views)."""
    return F.regexp_extract(F.trim(_col(c)), "^[0-9]", 0).try_cast("int")


def citp_group_any(c: Column | str) -> Column:
    """Job group from the first digit anywhere in the code, 1 to 9 (report)."""
    g = F.regexp_extract(_col(c), "[0-9]", 0).try_cast("int")
    return F.when(g.between(1, 9), g)


def citp_label(c: Column | str) -> Column:
    return lookup(_col(c), CITP_LABELS, F.lit("Non classé"))


def bareme_detail(bareme: Column | str, grade: Column | str) -> Column:
    """Split the teaching scale into primary and secondary by grade."""
    b = _col(bareme)
    split = F.when(F.coalesce(_col(grade).isin(*PRIMARY_GRADES), F.lit(False)), F.lit("_PRIM")).otherwise(F.lit("_SEC"))
    return F.when(b == TEACHING_SCALE, F.concat(b, split)).otherwise(b)


def bareme_rules(organisme: Column | str, emploi: Column | str, grade: Column | str) -> Column:
    """Pay scale from ordered text rules on organisation, job and grade; the first hit wins."""
    raw_job, g = _col(emploi), _col(grade)
    org, job = F.upper(_col(organisme)), F.upper(raw_job)

    def any_like(c: Column, *patterns: str) -> Column:
        out = c.like(patterns[0])
        for p in patterns[1:]:
            out = out | c.like(p)
        return F.coalesce(out, F.lit(False))

    # Text patterns of the scales, in priority order.
    diplomat = any_like(org, "%AFFAIRES ETRANG%") | any_like(job, "%AMBASSAD%", "%CONSUL%")
    prefect = (
        F.coalesce(raw_job == "Corps Préfectoral", F.lit(False))
        | any_like(job, "%GARDE DE SOUS-PREF%")
        | any_like(org, "%ADMINISTRATION DU TERRIT%")
    )
    judge = any_like(org, "%JUSTICE%", "%TRIBUNAL%", "%COUR D%APPEL%") | any_like(
        job, "%MAGISTR%", "%JUGE%", "%PROCUREUR%"
    )
    higher = any_like(org, "%ENSEIGNEMENT SUPER%", "%UNIVERSITE%") | any_like(
        job, "%MAITRE DE CONF%", "%PROFESSEUR TITULAR%"
    )
    school = any_like(org, "%ENSEIGNEMENT%", "%EDUCATION%") | any_like(
        job, "%INSTITUTEUR%", "%PROFESSEUR%", "%EDUCATEUR%"
    )
    doctor = any_like(job, "%MEDECIN%", "%PHARMACIEN%", "%CHIRURGIEN%", "%DENTISTE%") & F.coalesce(
        g.isin("A4", "A5", "A6", "A7"), F.lit(False)
    )
    health = any_like(org, "%SANTE%") | any_like(job, "%INFIRMI%", "%SAGE-FEMME%", "%AIDE SOIGNANT%")
    police = any_like(org, "%POLICE%") | any_like(job, "%POLICIER%", "%COMMISSAIRE%")
    return (
        F.when(diplomat, "CORPS DIPL")
        .when(prefect, "CORPS PREF")
        .when(judge, "MAGISTRAT")
        .when(any_like(job, "%GREFF%"), "GREFFE")
        .when(higher, "ENS SUP")
        .when(school, TEACHING_SCALE)
        .when(doctor, "Cadre-Sup-Santé")
        .when(health, "Tech-Santé")
        .when(police, "police")
        .when(g == NO_GRADE, "Non Fonctionnaire")
        .otherwise("Barême Général")
    )


def category_from_grade_text(c: Column | str) -> Column:
    """A to D named in a grade text, else 'Non Fonctionnaire'."""
    letter = F.upper(F.regexp_extract(_col(c), r"(?iu)Cat[ée]gorie\s+([A-D])", 1))
    not_official = F.coalesce(_col(c).rlike(r"(?iu)\bnon\s*fonctionnaire\b"), F.lit(False))
    return F.when(not_official | (F.coalesce(letter, F.lit("")) == ""), "Non Fonctionnaire").otherwise(letter)


def category_from_grade_code(c: Column | str) -> Column:
    """A to D of a bare letter or letter + digits code, else 'Non Fonctionnaire'."""
    s = F.upper(F.trim(_col(c)))
    return F.when(s.rlike("^[ABCD][0-9]*$"), F.substring(s, 1, 1)).otherwise("Non Fonctionnaire")


