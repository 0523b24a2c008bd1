"""Global order, running totals, ranks and quantiles that never sort a whole group in one task.

The common device: cut large groups into slices at approximate quantiles of
the order key, sum inside each slice and add the totals of the slices before
it. The edges of the slices are written, so that every use of them agrees; the
rows are not. A group of any size is spread over as many tasks as it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from acreage.functions.joins import join_groups
from acreage.functions.numbers import order_hash
from acreage.session import broadcast_counted, broadcast_written, cut_lineage

_PART = "_part"

# Groups with more rows than this are cut into slices of about this size, at most MOST_SLICES of them.
SLICE_ROWS = 1_000_000
MOST_SLICES = 4096


def _large_groups(df: DataFrame, group: Sequence[str], slice_rows: int) -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > slice_rows)


def _slice_edges(df: DataFrame, large: DataFrame, lead: str, group: Sequence[str], slice_rows: int) -> DataFrame:
    """(group, edges): approximate quantiles of the leading order column for groups beyond one slice; written."""
    quantiles = [i / MOST_SLICES for i in range(1, MOST_SLICES)]
    rows = join_groups(df.select(*group, F.col(lead).cast("double").alias("_lead")), large, group)
    step = F.greatest(F.lit(1), F.floor(F.lit(float(MOST_SLICES * slice_rows)) / F.max("_rows"))).cast("int")
    every = rows.groupBy(*group).agg(F.percentile_approx("_lead", F.array(*[F.lit(q) for q in quantiles]), 20_000).alias("_all"), step.alias("_step"))
    picked = F.filter("_all", lambda e, i: (i + 1) % F.col("_step") == 0)
    return cut_lineage(every.select(*group, F.array_distinct(picked).alias("_edges")))


def _slice_of(value: Column, edges: Column) -> Column:
    """Number of edges below the value, by binary search."""
    powers = F.array(*[F.lit(1 << k) for k in range(MOST_SLICES.bit_length() - 1, -1, -1)])
    below = F.aggregate(
        powers, F.lit(0),
        lambda at, step: F.when((at + step <= F.size(edges)) & (F.get(edges, at + step - 1) < value), at + step).otherwise(at),
    )
    return F.coalesce(F.when(edges.isNotNull() & value.isNotNull(), below), F.lit(0))


def running_total(
    df: DataFrame, order: Sequence[str], weight: str, group: Sequence[str] = (), name: str = "before",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows of the group that come earlier in ``order``.

    (group, order) should be unique; pre-aggregate equal keys first. The first
    order column decides the slice and should have many values where groups are
    large. If it is not a number, or a small relation has no groups, slices are
    ranges of a written, sorted copy.
    """
    lead = order[0]
    sketched = isinstance(df.schema[lead].dataType, NumericType)
    if sketched:
        large = _large_groups(df, group, slice_rows)
        if large.isEmpty():  # the counts alone tell; edges are sketched only where some group needs them
            if group:
                before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
                return df.select("*", F.coalesce(F.sum(weight).over(before), F.lit(0)).alias(name))
            sketched = False  # the whole relation is not put in one task, however small it is
    if sketched:
        edges = _slice_edges(df, large, lead, group, slice_rows)
        sliced = join_groups(df, edges, group, "left")
        ranged = sliced.withColumn(_PART, _slice_of(F.col(lead).cast("double"), F.col("_edges"))).drop("_edges")
    else:
        ranged = cut_lineage(df.repartitionByRange(*group, *order).withColumn(_PART, F.spark_partition_id()))
    inside = Window.partitionBy(_PART, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))

    # One row per slice of a group.
    totals = ranged.groupBy(_PART, *group).agg(F.sum(weight).alias("_total"))
    across = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_PART, *group, F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_offset"))
    joined = join_groups(local, offsets, [_PART, *group])
    return joined.select(*df.columns, (F.col("_local") + F.col("_offset")).alias(name))


def global_order_id(df: DataFrame, order: Sequence[str], name: str = "order_id") -> DataFrame:
    """1-based position of every row in ``order`` (which must be unique) over the whole relation."""
    counted = running_total(df.withColumn("_one", F.lit(1).cast("bigint")), order, "_one", name="_before")
    return counted.select(*df.columns, (F.col("_before") + 1).cast("bigint").alias(name))


def average_ranks(df: DataFrame, value: str, group: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Distinct values with their average rank: one row per (group, value); NULL values are left out.

    ``weight`` is the multiplicity of a row of a pre-aggregated input.
    """
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    distinct = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(amount.alias("_n"))
    ranked = running_total(distinct, [value], "_n", group, name="_before")
    return ranked.select(*group, value, "_n", (F.col("_before") + (F.col("_n") + 1) / 2.0).alias("avg_rank"))


def spearman(
    df: DataFrame, x: str, y: str, group: Sequence[str] = (), weight: str | None = None, name: str = "spearman"
) -> DataFrame:
    """Rank correlation with average ranks for ties, per group; pairs with a missing side are left out.

    NULL where one side has a single value.
    """
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    # Both rankings and the final sums read the counted pairs.
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*group, x, y).agg(amount.alias("_w"))
    rx = average_ranks(pairs, x, group, "_w").select(*group, F.col(x), F.col("avg_rank").alias("_rx"))
    ry = average_ranks(pairs, y, group, "_w").select(*group, F.col(y), F.col("avg_rank").alias("_ry"))
    ranked = join_groups(join_groups(pairs, rx, [*group, x]), ry, [*group, y])
    w, a, b = F.col("_w").cast("double"), F.col("_rx"), F.col("_ry")
    sums = ranked.groupBy(*group).agg(
        F.sum(w).alias("_n"),
        F.sum(w * a).alias("_a"),
        F.sum(w * b).alias("_b"),
        F.sum(w * a * b).alias("_ab"),
        F.sum(w * a * a).alias("_aa"),
        F.sum(w * b * b).alias("_bb"),
        ((F.min(a) < F.max(a)) & (F.min(b) < F.max(b))).alias("_varies"),
    )
    cov = F.col("_ab") - F.col("_a") * F.col("_b") / F.col("_n")
    var_a = F.col("_aa") - F.col("_a") * F.col("_a") / F.col("_n")
    var_b = F.col("_bb") - F.col("_b") * F.col("_b") / F.col("_n")
    return sums.select(
        *group,
        F.col("_n").cast("bigint").alias("n_pairs"),
        F.when(F.col("_varies"), F.try_divide(cov, F.sqrt(var_a) * F.sqrt(var_b))).alias(name),
    )


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], group: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles {output column: probability}, one row per group."""
    distinct = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(distinct, [value], "_n", group, name="_before")
    totals = placed.groupBy(*group).agg(F.sum("_n").alias("_total"))
    if group:
        placed = join_groups(placed, broadcast_counted(totals.select(*group, "_total")), list(group))
    else:
        placed = placed.withColumn("_total", totals.select("_total").scalar())

    def holds(position: Column) -> Column:
        return (F.col("_before") <= position) & (position < F.col("_before") + F.col("_n"))

    picks = []
    for i, p in enumerate(probabilities.values()):
        spot = F.lit(p) * (F.col("_total") - 1)
        picks += [
            F.max(F.when(holds(F.floor(spot)), F.col(value))).alias(f"_low{i}"),
            F.max(F.when(holds(F.ceil(spot)), F.col(value))).alias(f"_high{i}"),
        ]
    found = placed.groupBy(*group).agg(F.max("_total").alias("_total"), *picks)
    out = []
    for i, (name, p) in enumerate(probabilities.items()):
        spot = F.lit(p) * (F.col("_total") - 1)
        out.append(
            (F.col(f"_low{i}") + (spot - F.floor(spot)) * (F.col(f"_high{i}") - F.col(f"_low{i}"))).alias(name)
        )
    return found.select(*group, *out)


def first_k_by_hash(
    df: DataFrame,
    key: str,
    k: Column | int,
    group: Sequence[str] = (),
    seed: int = 0,
    flag: str = "picked",
    buckets: int = 4096,
) -> DataFrame:
    """Flag the k rows per group that come first in a repeatable pseudo-random order of the unique ``key``.

    ``k`` may be a column that is constant within the group. Counts per hash
    bucket tell which bucket holds the k-th row; only that bucket, 1/``buckets``
    of a group, is ordered to find the exact cut. The rows themselves are never
    shuffled: they are compared with one cut per group.
    """
    width = 2147483647 // buckets + 1
    groups = list(group) or ["_all"]
    source = df if group else df.withColumn("_all", F.lit(0))
    hashed = source.withColumn("_h", order_hash(F.col(key), seed))
    slim = hashed.select(
        *groups,
        F.col(key).alias("_key"),
        "_h",
        F.floor(F.col("_h") / F.lit(width)).alias("_bucket"),
        (F.lit(k) if isinstance(k, int) else k).cast("bigint").alias("_take"),
    )
    # At most ``buckets`` rows per group are written and reach the window.
    counts = cut_lineage(slim.groupBy(*groups, "_bucket").agg(
        F.count(F.lit(1)).alias("_in"), F.max("_take").alias("_take")
    ))
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    marks = counts.withColumn("_lower", F.coalesce(F.sum("_in").over(earlier), F.lit(0)))
    cuts = marks.filter((F.col("_lower") < F.col("_take")) & (F.col("_take") <= F.col("_lower") + F.col("_in")))
    edge = broadcast_written(cuts.select(*groups, "_bucket", "_lower", "_take"))
    place = F.row_number().over(Window.partitionBy(*groups).orderBy("_h", "_key"))
    last = (
        join_groups(slim.drop("_take"), edge, [*groups, "_bucket"])
        .withColumn("_place", place)
        .filter(F.col("_place") == F.col("_take") - F.col("_lower"))
        .select(*groups, F.col("_h").alias("_edge_h"), F.col("_key").alias("_edge_key"))
    )
    totals = counts.groupBy(*groups).agg(F.sum("_in").alias("_total"), F.max("_take").alias("_take"))
    cut = broadcast_written(join_groups(totals, last, groups, "left"))
    names = ["_take", "_total", "_edge_h", "_edge_key"]
    # Without groups the cut is a single row and enters as scalar subqueries.
    limit = {n: F.col(n) if group else cut.select(n).scalar() for n in names}
    first = (F.col("_h") < limit["_edge_h"]) | (
        (F.col("_h") == limit["_edge_h"]) & (F.col(key) <= limit["_edge_key"])
    )
    picked = F.when(limit["_take"] >= limit["_total"], F.lit(1)).otherwise(
        F.coalesce(first, F.lit(False)).cast("int")
    )
    marked = join_groups(hashed, cut, groups) if group else hashed
    return marked.select(*df.columns, picked.alias(flag))
