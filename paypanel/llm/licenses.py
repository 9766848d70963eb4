"""License scans: ordered signature rules behind a keyword gate, overlaps resolved by priority and containment.

The text is reduced to its words (``[0-9A-Za-z]`` and everything beyond ASCII, A-Z lower-cased) joined by one
blank, so every rule is a regular expression over whole words. A document that holds no keyword of any rule
is done after one look. Else the keywords it holds choose the rules that are tried; each rule's matches
become word intervals. Rules have a priority (0 first): named texts and tags, then short names, then family
words. A detection goes if it lies inside a detection of the same or a better priority, or if it holds one
of a better priority. All of it is native and stays in the row's task.

``hundreds`` of rules come from the licence names below and a few sentence forms for each.

Defined results: a null text counts as empty; without words counts are 0, first and last word null, labels
empty, score 0. Repeated rows give repeated rows; an empty table gives an empty result. Columns other than id
and text are never read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paypanel.llm.expressions import regex_spans

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Licence names: label, the words that name it (a regular expression), and the keyword that gates its rules.
NAMES = [
    ("0bsd", "(?:0bsd|zero clause bsd|bsd zero clause)", "bsd"),
    ("aal", "attribution assurance", "attribution assurance"),
    ("afl-3.0", "academic free", "academic free"),
    ("agpl-3.0", "(?:agpl(?: ?v?3(?: 0)?)?|(?:gnu )?affero general public)", "agpl|affero"),
    ("apache-1.1", "apache(?: software)?(?: license)?(?: version| v)? 1 1", "apache"),
    ("apache-2.0", "apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?", "apache"),
    ("apsl-2.0", "apple public source", "apple public"),
    ("artistic-1.0", "artistic(?: license)? 1 0", "artistic"),
    ("artistic-2.0", "artistic(?: license)? 2 0", "artistic"),
    ("beerware", "beer ?ware", "beer"),
    ("blueoak-1.0.0", "blue oak(?: model)?", "blue oak"),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd"),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", "bsd"),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd"),
    ("bsl-1.0", "boost(?: software)?(?: license)?(?: 1 0)?", "boost"),
    ("busl-1.1", "business source", "business source"),
    ("cc0-1.0", "(?:cc0(?: 1 0)?|cc zero|creative commons zero)", "cc0|cc zero|commons zero"),
    ("cc-by-nc-4.0", "(?:cc by nc|creative commons attribution non ?commercial)(?: [234] [05])?", "by nc|noncommercial|non commercial"),
    ("cc-by-nc-nd-4.0", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: [234] [05])?", "nc nd|deriv"),
    ("cc-by-nc-sa-4.0", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [234] [05])?", "nc sa|sharealike|share alike"),
    ("cc-by-nd-4.0", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)(?: [234] [05])?", "by nd|deriv"),
    ("cc-by-sa-4.0", "(?:cc by sa|creative commons attribution share ?alike)(?: [234] [05])?", "by sa|sharealike|share alike"),
    ("cc-by-4.0", "(?:cc by [234] [05]|creative commons attribution(?: [234] [05])?)", "cc by|creative commons"),
    ("cddl-1.0", "(?:cddl|common development and distribution)", "cddl|common development"),
    ("cecill-2.1", "cecill", "cecill"),
    ("cpal-1.0", "common public attribution", "common public attribution"),
    ("cpl-1.0", "common public", "common public"),
    ("ecl-2.0", "educational community", "educational community"),
    ("epl-1.0", "(?:epl 1 0|eclipse public license(?: v| version)? 1 0)", "epl|eclipse"),
    ("epl-2.0", "(?:epl 2 0|eclipse public(?: license)?(?: v| version)?(?: 2 0)?)", "epl|eclipse"),
    ("eupl-1.2", "(?:eupl|european union public)", "eupl|european union"),
    ("fdl-1.3", "(?:gfdl|gnu free documentation)", "gfdl|documentation"),
    ("gpl-1.0", "(?:gpl ?v?1(?: 0)?|general public license(?: version| v) ?1)", "gpl|general public"),
    ("gpl-2.0", "(?:gnu )?(?:gpl ?v?2(?: 0)?|general public license(?: version| v) ?2)", "gpl|general public"),
    ("gpl-3.0", "(?:gnu )?(?:gpl ?v?3(?: 0)?|general public license(?: version| v) ?3)", "gpl|general public"),
    ("hpnd", "historical permission notice", "historical permission"),
    ("icu", "icu", "icu"),
    ("ijg", "independent jpeg group", "jpeg"),
    ("intel", "intel open source", "intel open"),
    ("ipl-1.0", "ibm public", "ibm public"),
    ("isc", "isc", "isc"),
    ("json", "json", "json"),
    ("lgpl-2.1", "(?:lgpl ?v?2(?: 1)?|lesser general public license(?: version| v) ?2(?: 1)?)", "lgpl|lesser general"),
    ("lgpl-3.0", "(?:lgpl ?v?3(?: 0)?|lesser general public license(?: version| v) ?3)", "lgpl|lesser general"),
    ("lgpl", "(?:lgpl|(?:gnu )?lesser general public)", "lgpl|lesser general"),
    ("libpng", "libpng", "libpng"),
    ("llama-3", "llama [23](?: community)?", "llama"),
    ("lpl-1.02", "lucent public", "lucent"),
    ("mit", "mit", "mit"),
    ("mit-0", "mit (?:0|no attribution)", "mit"),
    ("mit-x11", "(?:mit x11|x11)", "x11"),
    ("mpl-1.1", "(?:mpl ?v?1(?: [01])?|mozilla public license(?: version| v) ?1(?: [01])?)", "mpl|mozilla public"),
    ("mpl-2.0", "(?:mpl ?v?2(?: 0)?|mozilla public(?: license)?(?: version| v)?(?: ?2(?: 0)?)?)", "mpl|mozilla public"),
    ("ms-pl", "(?:ms pl|microsoft public)", "ms pl|microsoft public"),
    ("ms-rl", "(?:ms rl|microsoft reciprocal)", "ms rl|microsoft reciprocal"),
    ("mulanpsl-2.0", "mulan(?: permissive)?", "mulan"),
    ("ncsa", "(?:ncsa|university of illinois ncsa)", "ncsa"),
    ("odbl-1.0", "(?:odbl|open database)", "odbl|open database"),
    ("odc-by-1.0", "(?:odc by|open data commons attribution)", "odc|open data commons"),
    ("ofl-1.1", "(?:sil )?open font", "open font"),
    ("openssl", "openssl", "openssl"),
    ("osl-3.0", "open software license", "open software"),
    ("pddl-1.0", "(?:pddl|public domain dedication)", "pddl|dedication"),
    ("php-3.01", "php(?: license)? 3(?: 01)?", "php"),
    ("postgresql", "postgresql", "postgresql"),
    ("psf-2.0", "(?:psf|python software foundation)", "psf|python software"),
    ("qpl-1.0", "q public", "q public"),
    ("rail", "(?:open ?)?rail(?: m)?", "rail"),
    ("ruby", "ruby", "ruby"),
    ("sleepycat", "sleepycat", "sleepycat"),
    ("sspl-1.0", "(?:sspl|server side public)", "sspl|server side public"),
    ("sunpl", "sun public", "sun public"),
    ("ucar", "ucar", "ucar"),
    ("unicode", "unicode", "unicode"),
    ("unlicense", "unlicense", "unlicense"),
    ("upl-1.0", "universal permissive", "universal permissive"),
    ("vim", "vim", "vim"),
    ("w3c", "w3c(?: software)?", "w3c"),
    ("wtfpl", "(?:wtfpl|do what the f[a-z]* you want)", "wtfpl|do what the"),
    ("x11", "x consortium", "x consortium"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("zpl-2.1", "zope public", "zope"),
]

# Sentence forms in which a licence is named: priority, weight, text before, text after.
FORMS = [
    (0, 1.0, "spdx license identifier ", "(?: only| or later)?"),
    (0, 0.95, "(?:released|licensed|distributed|available|published|provided|covered) (?:under|by|subject to)(?: the)?(?: terms of)?(?: the)? ", "(?: public)? licen[sc]e"),
    (0, 0.9, "licen[sc]e ", "(?: only| or later)?"),
    (1, 0.8, "", "(?: public)? licen[sc]e"),
]

# Single rules: label, priority, weight, keyword, regular expression.
TEXTS = [
    ("mit", 0, 1.0, "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", 0, 0.9, "permission to use", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", 0, 0.9, "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 0, 0.9, "neither the name", "neither the name of (?:[^ ]+ ){1,8}nor the names of its contributors"),
    ("apache-2.0", 0, 1.0, "apache", "(?:www )?apache org licenses license 2 0"),
    ("apache-2.0", 0, 0.95, "apache license", "apache license version 2 0"),
    ("gpl", 0, 0.9, "free software", "this program is free software you can redistribute it and or modify it"),
    ("gpl", 1, 0.8, "general public", "gnu general public license"),
    ("mpl-2.0", 0, 1.0, "mozilla", "mozilla org mpl 2 0"),
    ("cc0-1.0", 0, 1.0, "publicdomain", "creativecommons org publicdomain zero 1 0"),
    ("cc-by-sa-4.0", 0, 1.0, "creativecommons", "creativecommons org licenses by sa [234] [05]"),
    ("cc-by-nc-4.0", 0, 1.0, "creativecommons", "creativecommons org licenses by nc [234] [05]"),
    ("cc-by-4.0", 0, 1.0, "creativecommons", "creativecommons org licenses by [234] [05]"),
    ("unlicense", 0, 0.9, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("boost", 0, 0.9, "boost", "www boost org license 1 0 txt"),
    ("zlib", 0, 0.9, "software is provided", "this software is provided as is without any express or implied warranty"),
    ("public-domain", 2, 0.6, "public domain", "(?:released|placed|dedicated)(?: in| into| to)? the public domain"),
    ("copyright", 2, 0.4, "copyright", "copyright(?: c)? (?:19|20)[0-9]{2}"),
    ("proprietary", 2, 0.5, "proprietary", "proprietary and confidential"),
    ("creative-commons", 2, 0.5, "creative commons", "creative commons licen[sc]e"),
    ("open-source", 2, 0.3, "open source", "open source licen[sc]e"),
]


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    weight: float
    keywords: str
    regex: str


def rules() -> list[Rule]:
    """All rules in order: for each sentence form every name, then the single rules."""
    out = [Rule(label, p, w, keys, f"{before}{name}{after}") for p, w, before, after in FORMS for label, name, keys in NAMES]
    return out + [Rule(label, p, w, keys, regex) for label, p, w, keys, regex in TEXTS]


RULES = rules()
LEVELS = sorted({r.priority for r in RULES})
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
# a text with any detection or base phrase holds one of these
GATE = (
    f"(?i)licen[sc]e|copyright|public{GAP}domain|publicdomain|permission|redistribut|free{GAP}software|neither{GAP}the|reserved"
    f"|cc{GAP}by|mozilla|proprietary|software{GAP}is{GAP}provided"
)
BASE_SPANS = "array<struct<start:long,stop:long,label:string>>"
FOUND = "array<struct<start:long,minus:long,priority:int,label:string,weight:double>>"


def words_of(text: Column) -> Column:
    """The words, A-Z lower-cased, joined by one blank."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lower, GAP, " "))


def blanks(piece: Column) -> Column:
    return F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))


def whole(regex: str) -> str:
    return f"(?<![^ ])(?:{regex})(?![^ ])"


def rule_table() -> Column:
    """The rules as one literal, those of equal keywords together."""
    keys = list(dict.fromkeys(r.keywords for r in RULES))
    rows = [
        {
            "keys": k.split("|"),
            "rules": [
                {"label": r.label, "priority": r.priority, "weight": r.weight, "regex": whole(r.regex)}
                for r in RULES
                if r.keywords == k
            ],
        }
        for k in keys
    ]
    kind = "array<struct<keys:array<string>,rules:array<struct<label:string,priority:int,weight:double,regex:string>>>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)


def detections(words: Column) -> Column:
    """The matches of every rule that has a keyword among the words, sorted by start, longest first, priority."""

    def of_rule(r: Column) -> Column:
        return F.transform(
            regex_spans(words, r.regex, blanks),
            lambda s: F.struct(
                s.start.alias("start"),
                (-(s.end + 1)).alias("minus"),
                r.priority.alias("priority"),
                r.label.alias("label"),
                r.weight.alias("weight"),
            ),
        )

    tried = F.filter(rule_table(), lambda t: F.exists(t["keys"], lambda k: F.contains(words, k)))
    return F.array_sort(F.flatten(F.transform(F.flatten(F.transform(tried, lambda t: t["rules"])), of_rule)))


def resolve(found: Column) -> Column:
    """Detections left after suppression, in two passes over the sorted intervals.

    Forward: one inside an earlier one of the same or a better priority goes. Backward: one that holds a
    later one of a better priority goes.
    """

    def forward(acc: Column, d: Column) -> Column:
        inside = F.lit(False)
        for p in LEVELS:
            inside = inside | ((d.priority >= p) & (-d.minus <= acc[f"e{p}"]))
        ends = [
            F.when(d.priority == p, F.greatest(acc[f"e{p}"], -d.minus)).otherwise(acc[f"e{p}"]).alias(f"e{p}") for p in LEVELS
        ]
        return F.struct(F.when(inside, acc.kept).otherwise(F.concat(acc.kept, F.array(d))).alias("kept"), *ends)

    def backward(acc: Column, d: Column) -> Column:
        holds = F.lit(False)
        for p in LEVELS:
            holds = holds | ((d.priority > p) & (acc[f"s{p}"] <= -d.minus))
        stops = [
            F.when(d.priority == p, F.least(acc[f"s{p}"], -d.minus)).otherwise(acc[f"s{p}"]).alias(f"s{p}") for p in LEVELS
        ]
        return F.struct(F.when(holds, acc.kept).otherwise(F.concat(acc.kept, F.array(d))).alias("kept"), *stops)

    none = F.array().cast(FOUND).alias("kept")
    first = F.aggregate(
        found,
        F.struct(none, *[F.lit(-1).cast("long").alias(f"e{p}") for p in LEVELS]),
        forward,
        lambda acc: acc.kept,
    )
    return F.aggregate(
        F.reverse(first),
        F.struct(none, *[F.lit(1 << 62).alias(f"s{p}") for p in LEVELS]),
        backward,
        lambda acc: F.reverse(acc.kept),
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, base (start, stop, label of each base phrase), found (detections that stand).

    In ``found`` the exclusive end of an interval is ``-minus``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("content"))
    reduced = rows.select(
        "id",
        F.when(F.col("content").rlike(GATE), words_of(F.col("content"))).alias("words"),
        F.when(~F.col("content").rlike(GATE), F.regexp_count("content", F.lit(WORD))).alias("count"),
    )
    words = F.col("words")
    base_regex = whole("|".join(BASE))

    def named(s: Column) -> Column:
        label = F.coalesce(*[F.when(s.hit == phrase, F.lit(v)) for phrase, v in BASE.items()])
        return F.struct(s.start.alias("start"), (s.end + 1).alias("stop"), label.alias("label"))

    return reduced.select(
        "id",
        F.coalesce("count", F.when(words == "", F.lit(0)).otherwise(blanks(words) + 1)).cast("long").alias("n_words"),
        F.when(words.rlike(base_regex), F.transform(regex_spans(words, base_regex, blanks), named))
        .otherwise(F.array().cast(BASE_SPANS))
        .alias("base"),
        F.when(words.isNotNull(), resolve(detections(words))).otherwise(F.array().cast(FOUND)).alias("found"),
    )


def report(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    base_labels = F.transform("base", lambda s: s.label)
    own = F.transform("found", lambda s: s.label)
    starts = F.transform("base", lambda s: s.start)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat(base_labels, own))), ",").alias("labels"),
        F.greatest(
            F.when(F.size("base") > 0, F.lit(0.5)).otherwise(F.lit(0.0)),
            F.coalesce(F.array_max(F.transform("found", lambda s: s.weight)), F.lit(0.0)),
        ).alias("score"),
        F.size("found").cast("long").alias("n_found"),
    )


def _oracle() -> str:
    """The same rules in SQL, over words joined by two blanks so that neighbouring matches share none."""

    def wide(regex: str) -> str:
        return regex.replace("[^ ]", "\x00").replace(" ?", "(?:\x01)?").replace(" ", "  ").replace("\x01", "  ").replace("\x00", "[^ ]").replace("'", "''")

    values = ",\n".join(
        f"({i}, {r.priority}, {r.weight}, '{r.label}', [{', '.join(chr(39) + k + chr(39) for k in r.keywords.split('|'))}], ' (?:{wide(r.regex)}) ')"
        for i, r in enumerate(RULES)
    )
    places = " UNION ALL ".join(
        f"SELECT rid, CAST(i AS BIGINT) AS start, '{label}' AS label FROM (SELECT rid, w, unnest(range(0, greatest(len(w) - {len(p.split()) - 1}, 0))) AS i FROM d) "
        + "WHERE "
        + " AND ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(p.split()))
        for p, label in BASE.items()
    )
    return f"""
WITH d AS (SELECT rid, doc_id, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents)),
rule(id, priority, weight, label, keys, regex) AS (VALUES {values}),
j AS (SELECT rid, ' ' || list_aggregate(w, 'string_agg', '  ') || ' ' AS x, list_aggregate(w, 'string_agg', ' ') AS y FROM d WHERE len(w) > 0),
m AS (SELECT rid, x, priority, weight, label, string_split_regex(x, regex) AS gaps, regexp_extract_all(x, regex) AS hits
  FROM j, rule WHERE len(list_filter(keys, lambda k: contains(y, k))) > 0),
e AS (SELECT *, CAST(list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: length(h))), 0) AS INTEGER) AS pos
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m)),
f AS (SELECT rid, priority, weight, label, start, start + n AS stop FROM (
  SELECT *, length(left(x, pos)) - length(replace(left(x, pos), '  ', ' ')) AS start,
    length(hits[i]) - length(replace(hits[i], '  ', ' ')) + 1 AS n FROM e)),
k AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM f o WHERE o.rid = f.rid AND o.priority <= f.priority AND o.start <= f.start AND o.stop >= f.stop
  AND (o.start, -o.stop, o.priority, o.label) < (f.start, -f.stop, f.priority, f.label))),
s AS (SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM k o WHERE o.rid = k.rid AND o.priority < k.priority AND o.start >= k.start AND o.stop <= k.stop)),
b AS ({places}),
bb AS (SELECT rid, count(*) AS n, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b GROUP BY rid),
ss AS (SELECT rid, count(*) AS n, max(weight) AS weight FROM s GROUP BY rid),
al AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM s UNION ALL SELECT rid, label FROM b) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(bb.n, 0) AS BIGINT) AS n_base, first_word, last_word, coalesce(bb.labels, '') AS base_labels,
  coalesce(al.labels, '') AS labels, CAST(greatest(CASE WHEN bb.n > 0 THEN 0.5 ELSE 0 END, coalesce(ss.weight, 0)) AS DOUBLE) AS score, CAST(coalesce(ss.n, 0) AS BIGINT) AS n_found
FROM d LEFT JOIN bb USING (rid) LEFT JOIN ss USING (rid) LEFT JOIN al USING (rid)
"""


ORACLE = _oracle()
