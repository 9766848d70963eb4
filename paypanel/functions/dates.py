"""Period, date and age expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paypanel.functions.text import _col

# Day-first layouts found in the source files, by the shape of the text.
DATE_SHAPES = {
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$": "yyyy-MM-dd",
    r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$": "yyyy/MM/dd",
    r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$": "d/M/yyyy",
    r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$": "d-M-yyyy",
    r"^[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}$": "d.M.yyyy",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$": "yyyy-MM-dd HH:mm:ss",
}
EXCEL_EPOCH = "1899-12-30"
EXCEL_MAX_SERIAL = 60000


def period_parts(c: Column | str) -> tuple[Column, Column]:
    """(year, month) of an MMYYYY or YYYY-MM text."""
    s = F.translate(_col(c), "_/.", "---")
    short = F.length(s) == 6
    year = F.when(short, F.substring(s, 3, 4)).otherwise(F.substring(s, 1, 4)).try_cast("int")
    month = F.when(short, F.substring(s, 1, 2)).otherwise(F.substring(s, 6, 2)).try_cast("int")
    return year, month


def period_int(year: Column | str, month: Column | str) -> Column:
    """Chronological YYYYMM integer."""
    return (_col(year) * 100 + _col(month)).cast("int")


def period_label(year: Column | str, month: Column | str) -> Column:
    return F.concat(_col(year).cast("string"), F.lit("-"), F.lpad(_col(month).cast("string"), 2, "0"))


def first_of_month(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_col(year).cast("int"), _col(month).cast("int"), F.lit(1))


def month_end(c: Column | str) -> Column:
    """Collection date: last day of the MMYYYY month."""
    year, month = period_parts(c)
    return F.last_day(first_of_month(year, month))


def period_index(periode: Column | str) -> Column:
    """Month counter of a YYYYMM integer, for gaps in months."""
    p = _col(periode)
    return F.floor(p / 100).cast("int") * 12 + p % 100


def clean_date(c: Column | str) -> Column:
    """Date from mixed day-first texts or spreadsheet serials; junk becomes NULL.

    The shape decides which layout is parsed, so a row costs one parse and junk (bare times,
    blanks, words) none; zero dates fail their parse.
    """
    s = F.trim(_col(c))
    out = None
    for shape, layout in DATE_SHAPES.items():
        parsed = F.try_to_date(s, layout)
        out = F.when(s.rlike(shape), parsed) if out is None else out.when(s.rlike(shape), parsed)
    serial = s.try_cast("double")
    days = F.when(serial.between(1, EXCEL_MAX_SERIAL), F.floor(serial).cast("int"))
    return out.otherwise(F.date_add(F.lit(EXCEL_EPOCH).cast("date"), days))


def date_ref(*candidates: Column) -> Column:
    """First day of the month of the first usable date."""
    return F.trunc(F.coalesce(*candidates), "month")


def age_years(birth: Column | str, ref: Column | str) -> Column:
    """Birthday-exact age in whole years."""
    b, r = _col(birth), _col(ref)
    before = (F.month(r) < F.month(b)) | ((F.month(r) == F.month(b)) & (F.dayofmonth(r) < F.dayofmonth(b)))
    return F.year(r) - F.year(b) - before.cast("int")


def months_inclusive(d0: Column | str, d1: Column | str, inclusive: bool = True) -> Column:
    """Calendar months from d0 to d1 counting both ends, 0 when reversed."""
    a, b = _col(d0), _col(d1)
    gap = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    return F.when(gap < 0, 0).otherwise(gap + (1 if inclusive else 0))


def years_between(d0: Column | str, d1: Column | str) -> Column:
    """Elapsed years of 365.25 days."""
    return F.datediff(_col(d1), _col(d0)) / F.lit(365.25)


def tenure_years(start: Column | str, ref: Column | str) -> Column:
    return F.bround(years_between(start, ref), 2)


def age_at_start(birth: Column | str, start: Column | str) -> Column:
    """Whole years of 365 days between birth and start of service."""
    return F.floor(F.datediff(_col(start), _col(birth)) / 365).cast("int")
