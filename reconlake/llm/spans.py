"""Places of regular-expression matches, with Spark functions only.

A match's place is the total length of the pieces and matches before it: the
pieces come from ``split``, the matches from ``regexp_extract_all``, and running
totals are made in blocks, so that a text with very many matches stays cheap.
Lengths count code points. Patterns must not match the empty string and must
bound their own backtracking (possessive quantifiers)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x)


def running_totals(lengths: Column) -> Column:
    """For each entry of an array of longs, the total of those before it."""
    def with_sums(values: Column, sums: Column) -> Column:
        base = F.transform(sums, lambda _, i: _sum(F.slice(sums, 1, i)))
        return let(base, lambda b: F.transform(values, lambda _, i: F.get(b, F.floor(i / BLOCK).cast("int")) + _sum(
            F.slice(values, (F.floor(i / BLOCK) * BLOCK + 1).cast("int"), F.pmod(i, F.lit(BLOCK))))))

    def of(values: Column) -> Column:
        n = F.ceil(F.size(values) / BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), n - 1), lambda b: _sum(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))
        return let(sums, lambda s: with_sums(values, s))

    return let(lengths, lambda v: F.when(F.size(v) > 0, of(v)))


def running_greatest(values: Column) -> Column:
    """For each entry of an array of longs, the greatest of those before it, 0 at least."""
    def most(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda acc, x: F.greatest(acc, x))

    def with_tops(v: Column, tops: Column) -> Column:
        return spread(v, F.transform(tops, lambda _, i: most(F.slice(tops, 1, i))))

    def spread(v: Column, base: Column) -> Column:
        return let(base, lambda b: F.transform(v, lambda _, i: F.greatest(
            F.get(b, F.floor(i / BLOCK).cast("int")),
            most(F.slice(v, (F.floor(i / BLOCK) * BLOCK + 1).cast("int"), F.pmod(i, F.lit(BLOCK)))))))

    def of(v: Column) -> Column:
        n = F.ceil(F.size(v) / BLOCK).cast("int")
        tops = F.transform(F.sequence(F.lit(0), n - 1), lambda b: most(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
        return let(tops, lambda t: with_tops(v, t))

    return let(values, lambda v: F.when(F.size(v) > 0, of(v)))


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def located(text: Column, found: Column, pattern: str) -> Column:
    """array<struct<before, value, start, end>> of ``found = matches(text, pattern)``;
    before is the text since the match before."""
    def at(pieces: Column, values: Column) -> Column:
        step = F.zip_with(F.slice(pieces, 1, F.size(values)), values,
                          lambda p, v: (F.length(p) + F.length(v)).cast("long"))
        return let(running_totals(step), lambda before: F.transform(values, lambda v, i: let(
            F.get(pieces, i), lambda p: F.struct(
                p.alias("before"), v.alias("value"), (F.get(before, i) + F.length(p)).alias("start"),
                (F.get(before, i) + F.length(p) + F.length(v)).alias("end")))))

    none = F.array().cast("array<struct<before:string,value:string,start:bigint,end:bigint>>")
    return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), lambda p: let(found, lambda v: at(p, v)))
                  ).otherwise(none)


def joined(spans: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined, as they are sorted."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_spans(found: Column, kind: str, rank: int) -> Column:
    """The spans of one kind, in the shape and order that ``joined`` needs: by start, then kind."""
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def of_kind(found: Column, kind: str) -> Column:
    return F.filter(found, lambda s: s["kind"] == kind)
