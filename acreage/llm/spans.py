"""Places of pattern matches in whole texts, with SQL functions only.

A match's place follows from the lengths of what lies between matches: splitting a text at a pattern gives the pieces
around the matches, and running sums of their lengths give code-point offsets. Every expression is linear in the text,
but for running sums, which cost the power 1.5 of the number of matches in one text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,value:string,left:string,right:string>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"


@dataclass(frozen=True)
class Kind:
    """A kind of match: its pattern, a string without which no text can match, and the filter of its matches."""

    name: str
    pattern: str
    needs: str | None = None
    #: SQL condition on a lambda variable ``x`` with fields value, start and end.
    valid: str = "true"


def quoted(pattern: str) -> str:
    """The pattern as a SQL string."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def running(rows: DataFrame, values: str, name: str, joined: Callable[[str, str], str] = "{} + {}".format) -> DataFrame:
    """Adds ``name``: running sums over the integers of array ``values``, each with its own value in it.

    ``joined`` is the SQL of another associative operation, for which 0 changes nothing. Growing an array copies it, so
    a list of n values is cut into about sqrt(n) portions, which grow apart. A null or empty list gives null.
    """
    width = f"cast(ceil(sqrt(size({values}))) as int)"
    cut = f"transform(sequence(0, (size({values}) - 1) div {width}), p -> slice({values}, p * {width} + 1, {width}))"
    rows = rows.withColumn(f"p_{name}", F.when(F.size(values) > 0, F.expr(cut)))
    total = f"aggregate(p, 0, (s, x) -> {joined('s', 'x')})"
    bases = f"""aggregate(p_{name}, struct(0 as sum, cast(array() as array<int>) as out), (a, p) -> struct(
        {joined("a.sum", total)} as sum, concat(a.out, array(a.sum)) as out), a -> a.out)"""
    rows = rows.withColumn(f"b_{name}", F.expr(bases))
    grown = f"""aggregate(p, struct(b as sum, cast(array() as array<int>) as out), (a, x) -> struct(
        {joined("a.sum", "x")} as sum, concat(a.out, array({joined("a.sum", "x")})) as out), a -> a.out)"""
    summed = F.expr(f"flatten(zip_with(p_{name}, b_{name}, (p, b) -> {grown}))")
    return rows.withColumn(name, summed).drop(f"p_{name}", f"b_{name}")


def located(rows: DataFrame, kinds: list[Kind], text: str = "text", context: int = 0) -> DataFrame:
    """Adds ``at_<kind>``: valid leftmost, non-overlapping matches in order.

    left and right hold up to ``context`` characters around a match, no farther than the matches of its kind beside it.
    ``rows`` must have no null in ``text``.
    """
    for kind in kinds:
        found = F.expr(f"regexp_extract_all({text}, {quoted(kind.pattern)}, 0)")
        if kind.needs:
            found = F.when(F.col(text).contains(kind.needs), found)
        rows = rows.withColumn(f"m_{kind.name}", found)
    for kind in kinds:
        m = f"m_{kind.name}"
        around = f"left(g, {context}) as l, right(g, {context}) as r" if context else "'' as l, '' as r"
        pieces = F.expr(f"transform(split({text}, {quoted(kind.pattern)}, -1), g -> struct(length(g) as n, {around}))")
        rows = rows.withColumn(f"g_{kind.name}", F.when(F.size(m) > 0, pieces))
    for kind in kinds:
        m, g, n, e = (f"{p}_{kind.name}" for p in "mgne")
        rows = rows.withColumn(n, F.expr(f"transform({m}, (x, i) -> {g}[i].n + length(x))"))
        rows = running(rows, n, e)
        placed = f"""transform({m}, (x, i) -> struct({e}[i] - length(x) as start, {e}[i] as end, x as value,
            {g}[i].r as left, {g}[i + 1].l as right))"""
        spans = F.when(F.size(m) > 0, F.expr(f"filter({placed}, x -> {kind.valid})")).otherwise(F.expr(NO_SPANS))
        rows = rows.withColumn(f"at_{kind.name}", spans)
    return rows.drop(*(f"{p}_{k.name}" for k in kinds for p in "mgne"))


def tagged(spans: Column, tag: Column, name: str, *fields: str) -> Column:
    """Structs of the spans' ``fields`` (in order) with ``tag`` as field ``name`` after the first."""
    first, *rest = fields
    return F.transform(spans, lambda x: F.struct(x[first].alias(first), tag.alias(name), *(x[f].alias(f) for f in rest)))


def listing(named: list[tuple[str, Column]]) -> Column:
    """kind:start:end of span arrays, by start, then in the order of the kinds, comma-joined."""
    keyed = [tagged(spans, F.lit(rank), "rank", "start", "end") for rank, (_, spans) in enumerate(named)]
    names = F.array(*(F.lit(name) for name, _ in named))
    return F.array_join(
        F.transform(
            F.array_sort(F.concat(*keyed)),
            lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )
