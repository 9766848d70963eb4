"""Label, identifier and blank-cell expressions (all JVM side)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accented() -> dict[str, str]:
    """Latin letters that are one plain letter with marks, and that letter."""
    out = {}
    for c in map(chr, (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))):
        bare = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if bare != c and len(bare) == 1 and bare.isascii() and bare.isalpha():
            out[c] = bare
    return out


PLAIN_OF = _accented()
ACCENTED, PLAIN = "".join(PLAIN_OF), "".join(PLAIN_OF.values())

# Punctuation that separates words of a label.
PUNCTUATION = "-.,;:()[]/'\u2019\u2018"

# Texts that stand for an empty cell.
BLANK_WORDS = ("", "na", "nan", "none")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# White space of any script; the engine's own \\s and trim know only ASCII.
WHITE = r"[\s\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"


def strip_accents(c: Column | str) -> Column:
    """Plain letters for composed ones, and no combining marks."""
    return F.regexp_replace(F.translate(_col(c), ACCENTED, PLAIN), r"\p{M}+", "")


def squeeze(c: Column | str) -> Column:
    """Collapse runs of white space to one blank and trim both ends."""
    return F.trim(F.regexp_replace(_col(c), WHITE, " "))


def null_if_empty(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def norm_label(c: Column | str) -> Column:
    """Matching key of a label: upper case, no accents, punctuation as blanks, '' as NULL."""
    spaced = F.translate(_col(c), PUNCTUATION, " " * len(PUNCTUATION))
    return null_if_empty(squeeze(strip_accents(F.upper(spaced))))


def norm_label_lower(c: Column | str) -> Column:
    """Lower-case matching key; hyphen, underscore, quote, slash and dot become blanks."""
    return null_if_empty(squeeze(F.translate(strip_accents(F.lower(_col(c))), "-_'/.", "     ")))


def clean_place(c: Column | str) -> Column:
    """Place-name key: accents and apostrophes removed, upper case, never NULL."""
    spaced = F.regexp_replace(F.coalesce(_col(c), F.lit("")), WHITE, " ")
    bare = F.regexp_replace(strip_accents(spaced), "[^\\x00-\\x7F]|'", "")
    return squeeze(F.upper(bare))


def norm_id(c: Column | str) -> Column:
    """Identifier without surrounding blanks or non-breaking spaces, upper case."""
    return F.upper(F.regexp_replace(F.regexp_replace(_col(c), "\u00A0", ""), f"^{WHITE}|{WHITE}$", ""))


def filled(c: Column | str, zero_is_filled: bool = True, numeric: bool = False) -> Column:
    """True when the cell holds a real value."""
    col = _col(c)
    if numeric:
        ok = col.isNotNull()
        return ok if zero_is_filled else ok & (col != 0)
    return F.coalesce(~F.lower(F.trim(col)).isin(*BLANK_WORDS), F.lit(False))


def first_filled(*cols: Column | str) -> Column:
    """First cell, in the given order, that is not NULL or blank (trimmed)."""
    return F.coalesce(*[null_if_empty(F.trim(_col(c).cast("string"))) for c in cols])


def first_filled_amount(*cols: Column | str) -> Column:
    return first_filled(*cols).try_cast("double")
