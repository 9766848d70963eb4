"""Personal data: regular expressions propose spans, validators confirm them, context words adjust the score.

Everything is a native expression on the text; no row leaves its task. Patterns are written so that each
start is tried once (possessive parts, a look at the character before), which keeps long runs of digits or
letters linear; they find the same leftmost matches as the plain patterns named beside them.

The base kinds (email, ip, card, phone) are kept whenever their validator passes. The added kinds (iban,
ssn, tel) are kept from a score of ``threshold`` on: an IBAN by its checksum alone, the others only with a
context word close by. ``score`` is the kind's own weight plus 0.3 with a context word in the 40 characters
before the span or the 20 after it, never beyond the neighbouring match of the kind; 1.0 at most.

Defined results: a null text counts as empty, an empty text has no spans; repeated rows give repeated
rows; an empty table gives an empty result. Columns other than id and text are never read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paypanel.llm.expressions import let, regex_spans

BEFORE, AFTER = 40, 20
CUT = "x"
OCTET = "^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})$"
# Length of an IBAN by country, blanks left out.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FO GL NL SD FK",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
# one alternative per length: the span ends where the IBAN ends, whatever follows
IBAN = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
SPAN = "array<struct<kind:string,start:long,end:long,hit:string,score:double>>"


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _digit(number: Column, at: Column) -> Column:
    return F.ascii(F.substr(number, at, F.lit(1))) - F.lit(48)


def luhn(hit: Column) -> Column:
    """13 to 19 digits whose Luhn sum, every second digit from the right doubled, ends in 0."""

    def total(number: Column) -> Column:
        n = F.length(number)

        def add(acc: Column, i: Column) -> Column:
            twice = _digit(number, n - i) * (F.lit(1) + i % 2)
            return acc + twice - F.when(twice > 9, F.lit(9)).otherwise(F.lit(0))

        return F.when(n.between(13, 19), F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0).otherwise(
            F.lit(False)
        )

    return let(digits(hit), total)


def octets(hit: Column) -> Column:
    return F.forall(F.split(hit, "[.]"), lambda part: part.rlike(OCTET))


def phone_length(hit: Column) -> Column:
    return F.length(digits(hit)).between(9, 15)


def mod97(hit: Column) -> Column:
    """ISO 13616: country and check digits moved to the end, letters as 10 to 35, remainder 1 by 97."""

    def check(code: Column) -> Column:
        n = F.length(code)

        def add(acc: Column, i: Column) -> Column:
            c = F.ascii(F.substr(code, (i + F.lit(4)) % n + 1, F.lit(1)))
            return F.when(c >= 65, (acc * 100 + c - 55) % 97).otherwise((acc * 10 + c - 48) % 97)

        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) == 1

    return let(F.regexp_replace(hit, " ", ""), check)


@dataclass(frozen=True)
class Kind:
    """One kind of personal data. ``gate`` is a cheap test a text with a match always passes."""

    name: str
    pattern: str
    gate: str
    valid: Callable[[Column], Column] | None
    weight: float
    context: str
    base: bool = True

    @property
    def near(self) -> str:
        """The context words as whole words."""
        return rf"(^|[^\p{{L}}])({self.context})([^\p{{L}}]|$)"


KINDS = [
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        None,
        0.7,
        "mail|email|mails|emails|contact|write|reach|address|adresse|correo|kontakt",
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]",
        octets,
        0.6,
        "ip|host|hostname|server|login|client|addr|address",
    ),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", luhn, 0.7, "card|visa|master|mastercard|credit|karte|kreditkarte|carte|tarjeta|pay|payment|paid"),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", phone_length, 0.6, "tel|telephone|telefon|telefono|phone|call|mobile|fax|anruf|appel"),
    Kind(
        "iban",
        IBAN,
        "[A-Z]{2}[0-9]{2}",
        mod97,
        0.7,
        "iban|account|konto|compte|cuenta|bank",
        base=False,
    ),
    Kind(
        "ssn",
        r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
        "[0-9]-[0-9]",
        None,
        0.4,
        "ssn|social|security|insurance|tax",
        base=False,
    ),
    Kind(
        "tel",
        r"\b0[0-9]{1,4}[\x20/-][0-9]{3,4}(?:[\x20-]?[0-9]{2,4}){1,3}\b",
        "[0-9][ /-][0-9]",
        phone_length,
        0.3,
        "tel|telephone|telefon|telefono|phone|call|mobile|fax|anruf|appel",
        base=False,
    ),
]


def kind_spans(text: Column, kind: Kind, threshold: float) -> Column:
    """The confirmed spans of one kind, each with its score."""

    def scored(s: Column) -> Column:
        # a window that begins or ends within a text is closed by a letter, so that no part of a word passes for one
        before = F.concat(F.when(F.length(s.before) > BEFORE, CUT).otherwise(""), F.right(s.before, F.lit(BEFORE)))
        after = F.concat(F.left(s.after, F.lit(AFTER)), F.when(F.length(s.after) > AFTER, CUT).otherwise(""))
        near = F.lower(before).rlike(kind.near) | F.lower(after).rlike(kind.near)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            s.start.alias("start"),
            s.end.alias("end"),
            s.hit.alias("hit"),
            F.when(near, F.lit(round(min(1.0, kind.weight + 0.3), 2))).otherwise(F.lit(kind.weight)).alias("score"),
        )

    found = regex_spans(text, kind.pattern)
    if kind.valid is not None:
        found = F.filter(found, lambda s: kind.valid(s.hit))
    spans = F.transform(found, scored)
    if not kind.base:
        spans = F.filter(spans, lambda s: s.score >= threshold)
    return F.when(text.rlike(kind.gate), spans).otherwise(F.array().cast(SPAN))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """Per row: id and one array of spans (kind, start, end, hit, score) per kind, ordered by start."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("content"))
    return rows.select("id", *[kind_spans(F.col("content"), k, threshold).alias(k.name) for k in KINDS])


def report(docs: DataFrame) -> DataFrame:
    found = find_pii(docs)

    def joined(kinds: list[Kind]) -> Column:
        parts = [F.transform(k.name, lambda s: F.concat_ws(":", s.kind, s.start, s.end)) for k in kinds]
        return F.array_join(F.concat(*parts), ",")

    base = [k for k in KINDS if k.base]
    added = [k for k in KINDS if not k.base]
    best = F.greatest(*[F.coalesce(F.array_max(F.transform(k.name, lambda s: s.score)), F.lit(0.0)) for k in KINDS])
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in base],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(KINDS).alias("spans"),
        sum((F.size(k.name) for k in added), F.lit(0)).cast("long").alias("n_added"),
        best.alias("top_score"),
    )


def _oracle() -> str:
    """The same rule in SQL: the plain patterns, positions from split pieces, validators on lists."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    number = "regexp_replace(hit, '[^0-9]', '', 'g')"
    code = "replace(hit, ' ', '')"
    moved = f"({code}[5:] || {code}[:4])"
    spelled = (
        f"list_aggregate(list_transform(string_split({moved}, ''), lambda c: "
        "CASE WHEN ascii(c) >= 65 THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), 'string_agg', '')"
    )
    mod = (
        f"list_reduce([0] || list_transform(string_split({spelled}, ''), lambda c: CAST(c AS INTEGER)), "
        "lambda a, d: (a * 10 + d) % 97) = 1"
    )
    luhn_sql = (
        f"length({number}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length({number})), lambda i: "
        f"(CAST({number}[length({number}) - i] AS INTEGER) * (1 + i % 2)) - "
        f"CASE WHEN CAST({number}[length({number}) - i] AS INTEGER) * (1 + i % 2) > 9 THEN 9 ELSE 0 END)) % 10 = 0"
    )
    valid = {
        "email": "true",
        "ip": "len(list_filter(string_split(hit, '.'), lambda p: NOT (length(ltrim(p, '0')) <= 3 AND "
        "coalesce(try_cast(ltrim(p, '0') AS INTEGER), 0) <= 255))) = 0",
        "card": luhn_sql,
        "phone": f"length({number}) BETWEEN 9 AND 15",
        "iban": mod,
        "ssn": "true",
        "tel": f"length({number}) BETWEEN 9 AND 15",
    }
    parts = []
    for rank, k in enumerate(KINDS):
        pattern = plain.get(k.name, k.pattern).replace("'", "''")
        left = f"CASE WHEN length(before) > {BEFORE} THEN '{CUT}' ELSE '' END || right(before, {BEFORE})"
        right = f"left(after, {AFTER}) || CASE WHEN length(after) > {AFTER} THEN '{CUT}' ELSE '' END"
        near = f"(regexp_matches(lower({left}), '{k.near}') OR regexp_matches(lower({right}), '{k.near}'))"
        score = f"CASE WHEN {near} THEN {round(min(1.0, k.weight + 0.3), 2)} ELSE {k.weight} END"
        keep = valid[k.name] + ("" if k.base else f" AND {score} >= 0.6")
        parts.append(f"""
SELECT rid, {rank} AS rank, '{k.name}' AS kind, start, start + length(hit) AS stop, {score} AS score FROM (
  SELECT rid, hits[i] AS hit, gaps[i] AS before, gaps[i + 1] AS after,
    CAST(list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: length(h))), 0) AS BIGINT) AS start
  FROM (SELECT rid, gaps, hits, unnest(range(1, len(hits) + 1)) AS i FROM (
    SELECT rid, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS hits FROM d))) WHERE {keep}""")
    counts = ", ".join(
        f"CAST(count(*) FILTER (kind = '{k.name}') AS BIGINT) AS n_{k.name}" for k in KINDS if k.base
    )
    bases = ", ".join(f"'{k.name}'" for k in KINDS if k.base)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(parts)}),
j AS (SELECT rid, {counts}, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY rank, start) FILTER (kind IN ({bases})) AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY rank, start) AS spans,
  CAST(count(*) FILTER (kind NOT IN ({bases})) AS BIGINT) AS n_added, max(score) AS top_score FROM s GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{k.name}, 0) AS n_{k.name}' for k in KINDS if k.base)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_added, 0) AS n_added, CAST(coalesce(top_score, 0) AS DOUBLE) AS top_score
FROM d LEFT JOIN j USING (rid)
"""


ORACLE = _oracle()
