"""Storey distribution, insured values, shares, imputation and summaries per line of business.

Plan shape: the long cell counts are shuffled once, into one row per cell.
From there a cell becomes three rows (RES, COM, IND) that meet their
multipliers by broadcast; products, totals, shares and imputation are row
arithmetic over the seven storey bins, and the rows keep the partitioning of
that one shuffle, so that folding them back to a cell needs no other. Column
names: n1..n5 counts per height class, b_ buildings, v_ insured values,
p_ building shares, s_ value shares, each followed by the bin.

``keys`` identify a cell together with its settlement group; ``carried``
columns depend on the cell and are taken along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.contracts import require_columns
from acreage.functions import classes as cls
from acreage.session import broadcast_counted

BINS = cls.BINS
CELL_KEYS = ["grid_id", "urban"]
CELL_POSITION = ["lat", "lon"]
SLOTS = [f"n{i}" for i in range(1, 6)]


def total_of(prefix: str, bins: Sequence[str] = BINS) -> str:
    """SQL sum of the seven bin columns with a prefix."""
    return " + ".join(f"{prefix}{b}" for b in bins)


def count_columns() -> list[str]:
    """Wide count columns in output order; IND repeats the COM counts."""
    res = [f"nr{c}_res" for c in cls.RESIDENTIAL]
    return res + [f"nr{c}_{lob}" for c in cls.NON_RESIDENTIAL for lob in ("com", "ind")]


def pivot_counts(counts: DataFrame, keys: Sequence[str] = CELL_KEYS, carried: Sequence[str] = ()) -> DataFrame:
    """One row per cell with nr{class}_{lob} columns; an absent class is 0.

    Conditional sums with the known classes: one aggregation, no job to discover values.
    """
    require_columns(counts, [*keys, *carried, "built", "count"], "cell counts")
    sums = [
        F.expr(f"cast(coalesce(sum(case when built = {c} then `count` end), 0) as bigint) as nr{c}_{lob}")
        for lob, codes in (("res", cls.RESIDENTIAL), ("com", cls.NON_RESIDENTIAL))
        for c in codes
    ]
    return counts.groupBy(*keys).agg(*[F.min(c).alias(c) for c in carried], *sums)


def drop_empty_cells(cells: DataFrame) -> DataFrame:
    """Keep cells with at least one positive count column."""
    counts = [f"coalesce({c}, 0)" for c in cells.columns if c.lower().startswith("nr")]
    return cells.filter(f"greatest({', '.join(counts)}) > 0")


def multiplier_rows(props: DataFrame, tsi: DataFrame) -> DataFrame:
    """Small table with one row per (urban, lob): proportions m{slot}_{bin} and values t_{bin}.

    ``slot`` numbers the five height classes of the line of business.
    """
    shares = props.groupBy("urban", "lob").agg(
        *[
            F.expr(f"coalesce(sum(case when built % 10 = {i} and bin = '{b}' then prop end), 0D) as m{i}_{b}")
            for i in range(1, 6)
            for b in BINS
        ]
    )
    values = tsi.groupBy("lob").agg(
        *[F.expr(f"cast(coalesce(sum(case when bin = '{b}' then tsi end), 0) as double) as t_{b}") for b in BINS]
    )
    return shares.join(values, "lob", "left")


def lob_rows(cells: DataFrame) -> DataFrame:
    """Three rows per cell: its other columns, the line of business and the five class counts n1..n5."""
    rest = [c for c in cells.columns if not c.startswith("nr")]
    per_lob = []
    for lob in cls.LOBS:
        side = "res" if lob == "RES" else "com"
        slots = ", ".join(f"nr{c}_{side} as n{i}" for i, c in enumerate(cls.LOB_CLASSES[lob], 1))
        per_lob.append(f"struct('{lob}' as lob, {slots})")
    return cells.selectExpr(*rest, f"inline(array({', '.join(per_lob)}))")


def storey_profiles(cells: DataFrame, props: DataFrame, tsi: DataFrame) -> DataFrame:
    """Buildings b_{bin}, values v_{bin}, and shares p_{bin}, s_{bin} per cell and line of business.

    ``cells`` is the wide count relation; a cell without settlement group, or
    without a matching multiplier, gets zeros. Multiplier tables have one row
    per (urban, lob); they are counted and broadcast, since a join by shuffle
    would gather all cells under nine keys.
    """
    rows = lob_rows(cells)
    joined = rows.join(broadcast_counted(multiplier_rows(props, tsi)), ["urban", "lob"], "left")
    buildings = [
        " + ".join(f"n{i} * coalesce(m{i}_{b}, 0D)" for i in range(1, 6)) + f" as b_{b}" for b in BINS
    ]
    counted = joined.selectExpr(*rows.columns, *buildings, *[f"t_{b}" for b in BINS])
    valued = counted.selectExpr(
        *rows.columns, *[f"b_{b}" for b in BINS], *[f"b_{b} * coalesce(t_{b}, 0D) as v_{b}" for b in BINS]
    )
    return add_shares(valued)


def add_shares(profiles: DataFrame) -> DataFrame:
    """Share of each bin in the row's buildings and values; all zero when the total is zero."""
    totals = profiles.selectExpr("*", f"{total_of('b_')} as _b", f"{total_of('v_')} as _v")
    return totals.selectExpr(
        *profiles.columns,
        *[f"coalesce(try_divide(b_{b}, _b), 0D) as p_{b}" for b in BINS],
        *[f"coalesce(try_divide(v_{b}, _v), 0D) as s_{b}" for b in BINS],
    )


EMPTY = f"greatest({', '.join(f's_{b}' for b in BINS)}) = 0"


def donor_means(profiles: DataFrame) -> DataFrame:
    """Mean value shares of the non-empty rows per (urban, lob): at most 12 rows.

    Groups and lines outside the known ones fold into NULL in place of a filter,
    so the plan below stays the same as that of the facts and their shuffle is
    reused.
    """
    known = {
        "urban": "case when urban in (0, 1, 2) then urban end",
        "lob": "case when lob in ('RES', 'COM', 'IND') then lob end",
    }
    return profiles.groupBy(*[F.expr(e).alias(n) for n, e in known.items()]).agg(
        *[F.expr(f"avg(case when not ({EMPTY}) then s_{b} end) as d_{b}") for b in BINS]
    )


def impute_shares(profiles: DataFrame) -> DataFrame:
    """Rows whose value shares are all zero take the mean shares of their settlement group.

    Groups without donors, and cells without a settlement group, stay zero. The
    donor table is bounded by its grouping to the known groups and lines, so it
    is broadcast; the fact rows are not moved.
    """
    joined = profiles.join(F.broadcast(donor_means(profiles)), ["urban", "lob"], "left")
    filled = {f"s_{b}": f"case when {EMPTY} then coalesce(d_{b}, 0D) else s_{b} end as s_{b}" for b in BINS}
    # One select, so that every column judges emptiness by the shares before imputation.
    return joined.selectExpr(*[filled.get(c, c) for c in profiles.columns])


def profile_long(profiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, lob, bin, buildings, insured, building_share, value_share)."""
    rows = ", ".join(
        f"struct('{b}' as bin, b_{b} as buildings, v_{b} as insured, p_{b} as building_share, s_{b} as value_share)"
        for b in BINS
    )
    return profiles.selectExpr(*keys, "lob", f"inline(array({rows}))")


# Output blocks: (name of the block sum, column pattern, profile prefix), for each line of business.
BLOCKS = [
    ("{lob}_Buildings_SUM", "storey{bin}_{lob}", "b_"),
    ("{lob}_Buildings_SUM_perc", "{lob}_Storey_{bin}_perc", "p_"),
    ("{lob}_TSI_SUM", "storey{bin}_{lob}_TSI", "v_"),
    ("{lob}_TSI_Perc_SUM", "{lob}_Storey_{bin}_tsi_perc", "s_"),
]


def wide_exposure(profiles: DataFrame, keys: Sequence[str] = CELL_KEYS, carried: Sequence[str] = ()) -> DataFrame:
    """One row per cell: counts, then 12 blocks of seven bins each followed by its sum.

    ``profiles`` keeps the partitioning of the cell aggregation it came from, so
    folding the three rows of a cell back together needs no exchange.
    """
    def pick(lob: str, source: str, name: str) -> Column:
        return F.expr(f"max(case when lob = '{lob}' then {source} end) as {name}")

    counts = [
        pick(lob, f"n{i}", f"nr{c}_{lob.lower()}") for lob in cls.LOBS for i, c in enumerate(cls.LOB_CLASSES[lob], 1)
    ]
    blocks = [
        pick(lob, f"{prefix}{b}", pattern.format(lob=lob, bin=b))
        for _, pattern, prefix in BLOCKS
        for lob in cls.LOBS
        for b in BINS
    ]
    folded = profiles.groupBy(*keys).agg(*[F.min(c).alias(c) for c in carried], *counts, *blocks)
    return folded.selectExpr(*keys, *carried, *count_columns(), *block_columns())


def block_columns() -> list[str]:
    """Building blocks first (counts and shares per line), then the value blocks, each with its sum."""
    out = []
    for half in (BLOCKS[:2], BLOCKS[2:]):
        for lob in cls.LOBS:
            for total_name, pattern, _ in half:
                names = [pattern.format(lob=lob, bin=b) for b in BINS]
                out += [*names, f"{' + '.join(names)} as {total_name.format(lob=lob)}"]
    return out


def lonlat_id(lon: Column, lat: Column) -> Column:
    """'lon_lat' text without decimal points; distinct points may share it, so it is never a key."""
    return F.regexp_replace(F.concat_ws("_", lon.cast("string"), lat.cast("string")), r"\.", "")


def lob_view(profiles: DataFrame, lob: str, id_col: str, x: str, y: str, order: str | None = None) -> DataFrame:
    """Point view of one line of business: id, position, order and seven value shares with their sum."""
    shares = [F.coalesce(F.col(f"s_{b}"), F.lit(0.0)).alias(cls.VIEW_BIN_NAMES[b]) for b in BINS]
    position = F.col(order).cast("bigint") if order else F.lit(None).cast("bigint")
    rows = profiles.filter(F.col("lob") == lob).select(
        F.col(id_col).alias("ID"), F.col(x).alias("POINT_X"), F.col(y).alias("POINT_Y"),
        position.alias("ORDER_ID_XY"), *shares,
    )
    total = F.lit(0.0)
    for b in BINS:
        total = total + F.col(f"`{cls.VIEW_BIN_NAMES[b]}`")
    return rows.withColumn("SUM", total)


def area_summary(profiles: DataFrame, labels: dict[int, str] | None = None) -> DataFrame:
    """Buildings and values with percentages per (lob, area, bin), with bin 'SUM' and area 'OVERALL'.

    Facts are aggregated once per (lob, area); the overall rows, the dense axis of
    all areas that the labels name, percentages and sums are made from those few rows. Percentages are 0
    where the total is 0.
    """
    measures = [f"{p}{b}" for p in ("b_", "v_") for b in BINS]
    by_area = (
        profiles.withColumn("area", cls.area_of(F.col("urban"), labels))
        .groupBy("lob", "area")
        .agg(*[F.expr(f"sum({m}) as {m}") for m in measures])
    )
    # A few rows from here on: each counts for its area and for the overall rows.
    names = cls.areas_of(labels)
    quoted = ["'" + a.replace("\\", "\\\\").replace("'", "\\'") + "'" for a in names]
    sums = [
        F.expr(f"coalesce(sum(case when _of = {a} then {m} end), 0D) as {m}_{i}") for i, a in enumerate(quoted) for m in measures
    ]
    wide = by_area.selectExpr("*", f"explode(array(area, {quoted[0]})) as _of").groupBy("lob").agg(*sums)
    areas = ", ".join(
        f"struct({a} as area, {', '.join(f'{m}_{i} as {m}' for m in measures)})" for i, a in enumerate(quoted)
    )
    dense = wide.selectExpr("lob", f"inline(array({areas}))").selectExpr(
        "*", f"{total_of('b_')} as b_SUM", f"{total_of('v_')} as v_SUM"
    )
    cells = ", ".join(
        f"struct('{b}' as bin, b_{b} as buildings, coalesce(try_divide(b_{b} * 100D, b_SUM), 0D) as buildings_pct, "
        f"v_{b} as insured, coalesce(try_divide(v_{b} * 100D, v_SUM), 0D) as insured_pct)"
        for b in [*BINS, "SUM"]
    )
    return dense.selectExpr("lob", "area", f"inline(array({cells}))")


def classify_lob(counts: DataFrame) -> DataFrame:
    return counts.withColumn("lob", cls.lob_of(F.col("built")))


def multiplier_join(counts: DataFrame, props: DataFrame) -> DataFrame:
    """Long form of the multiplier join: one row per count x line x bin, missing proportions as 0.

    For callers that need the products themselves; the flow uses storey_profiles.
    """
    lobs = F.when(F.col("built").between(11, 15), F.array(F.lit("RES"))).when(
        F.col("built").between(21, 25), F.array(F.lit("COM"), F.lit("IND"))
    )
    bins = F.array(*[F.lit(b) for b in BINS])
    keyed = counts.withColumn("lob", F.explode(lobs)).withColumn("bin", F.explode(bins))
    joined = keyed.join(broadcast_counted(props), ["lob", "urban", "built", "bin"], "left")
    return joined.withColumn("prop", F.coalesce(F.col("prop"), F.lit(0.0)))


def value_join(rows: DataFrame, tsi: DataFrame) -> DataFrame:
    """Insured value per (lob, bin); a missing value counts as 0."""
    joined = rows.join(broadcast_counted(tsi), ["lob", "bin"], "left")
    return joined.withColumn("tsi", F.coalesce(F.col("tsi").cast("double"), F.lit(0.0)))
