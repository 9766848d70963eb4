"""Column helpers shared by the corpus operators: bound values, prefix sums, regex spans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also when the body names it often or in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(numbers: Column) -> Column:
    """Inclusive prefix sums of an array of longs.

    Sums run inside blocks of about sqrt(n) elements and then over the blocks, so an array of n
    elements costs n * sqrt(n) copies at most, not n * n.
    """

    def run(a: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("s"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(
            a,
            start,
            lambda acc, x: F.struct((acc.s + x).alias("s"), F.concat(acc.out, F.array(acc.s + x)).alias("out")),
            lambda acc: acc.out,
        )

    def blocked(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(v.a) - 1, v.k)
        blocks = F.transform(starts, lambda i: run(F.slice(v.a, i + 1, v.k)))

        def joined(b: Column) -> Column:
            before = run(F.transform(b, lambda x: F.element_at(x, -1)))
            return F.flatten(
                F.transform(
                    b, lambda x, i: F.transform(x, lambda y: y + F.when(i > 0, F.get(before, i - 1)).otherwise(F.lit(0)))
                )
            )

        return let(blocks, joined)

    return let(
        F.struct(
            numbers.cast("array<long>").alias("a"),
            F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(numbers))).cast("int")).alias("k"),
        ),
        lambda v: F.when(F.size(v.a) > 0, blocked(v)).otherwise(F.array().cast("array<long>")),
    )


def regex_spans(text: Column, pattern: str | Column, measure: Callable[[Column], Column] = F.length) -> Column:
    """All leftmost non-overlapping matches with their positions, as structs (start, end, hit, before, after).

    ``split`` gives the gaps and ``regexp_extract_all`` the matches of the same scan; positions are the
    prefix sums of their measures (code points unless another measure is named). ``before`` and ``after``
    are the gaps on both sides. The pattern must not match the empty string.
    """

    regex = F.lit(pattern) if isinstance(pattern, str) else pattern

    def spans(v: Column) -> Column:
        steps = F.transform(
            v.hits,
            lambda h, i: (measure(F.get(v.gaps, i)) + F.when(i > 0, measure(F.get(v.hits, i - 1))).otherwise(F.lit(0))).cast(
                "long"
            ),
        )
        return let(
            prefix_sums(steps),
            lambda at: F.transform(
                v.hits,
                lambda h, i: F.struct(
                    F.get(at, i).alias("start"),
                    (F.get(at, i) + measure(h)).alias("end"),
                    h.alias("hit"),
                    F.get(v.gaps, i).alias("before"),
                    F.get(v.gaps, i + 1).alias("after"),
                ),
            ),
        )

    return let(
        F.struct(
            F.split(text, regex, -1).alias("gaps"),
            F.regexp_extract_all(text, regex, F.lit(0)).alias("hits"),
        ),
        spans,
    )
