"""Expected storey counts from observed (settlement, class) counts of a cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.session import broadcast_counted, spread_counted

# Counts dealt to one task, whose cells become some ten times as many rows.
TASK_COUNTS = 200_000


def melt(df: DataFrame, ids: Sequence[str], prefix: str, name: str, value: str) -> DataFrame:
    """Columns '{prefix}{code}' to rows (ids, name, value); a NULL value becomes 0."""
    columns = [c for c in df.columns if c.startswith(prefix)]
    rows = F.array(
        *[
            F.struct(
                F.lit(int(c[len(prefix):])).alias(name),
                F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias(value),
            )
            for c in columns
        ]
    )
    return df.select(*ids, F.inline(rows))


def observed_counts(counts: DataFrame, cell: str = "cell") -> DataFrame:
    """Sum of counts per (cell, smod, built)."""
    return counts.groupBy(cell, "smod", "built").agg(F.sum("count").cast("bigint").alias("count"))


def dense_counts(counts: DataFrame, smods: Sequence[int], builts: Sequence[int], cell: str = "cell") -> DataFrame:
    """Every (smod, built) combination per cell, zeros included.

    Conditional sums give the zeros in the same aggregation that sums the
    counts, in place of a cross join and a lookup. The counts are counted first
    and dealt by cell over as many tasks as they need: each cell grows into as
    many rows as there are combinations, which later sums by cell hold in the
    same task.
    """
    combos = [(s, b) for s in smods for b in builts]
    sums = [
        F.coalesce(
            F.sum(F.when((F.col("smod") == s) & (F.col("built") == b), F.col("count"))), F.lit(0)
        ).cast("bigint").alias(f"c{i}")
        for i, (s, b) in enumerate(combos)
    ]
    rows = F.array(
        *[
            F.struct(F.lit(s).alias("smod"), F.lit(b).alias("built"), F.col(f"c{i}").alias("count"))
            for i, (s, b) in enumerate(combos)
        ]
    )
    return spread_counted(counts, TASK_COUNTS, cell).groupBy(cell).agg(*sums).select(cell, F.inline(rows))


def widen_props(props: DataFrame, bins: Sequence[str]) -> DataFrame:
    """Small table: one row per (smod, built) with a proportion column per bin."""
    return props.groupBy("smod", "built").agg(
        *[F.coalesce(F.sum(F.when(F.col("bin") == b, F.col("prop"))), F.lit(0.0)).alias(f"q_{b}") for b in bins]
    )


def expected_rows(dense: DataFrame, props: DataFrame, bins: Sequence[str], cell: str = "cell") -> DataFrame:
    """expected_{bin} = count x proportion for every dense row whose combination has proportions."""
    joined = dense.join(broadcast_counted(widen_props(props, bins)), ["smod", "built"])
    return joined.select(
        cell, "smod", "built", "count", *[(F.col("count") * F.col(f"q_{b}")).alias(f"expected_{b}") for b in bins]
    )


def expected_by_cell(rows: DataFrame, bins: Sequence[str], cell: str = "cell") -> DataFrame:
    """Product of the cell x combination counts with the combination x bin proportions."""
    return rows.groupBy(cell).agg(*[F.sum(f"expected_{b}").alias(b) for b in bins])


def with_subtotals(rows: DataFrame, bins: Sequence[str], cell: str = "cell") -> DataFrame:
    """Detail rows plus one row per (cell, built) with smod 'ALL'; smod_sort puts it first."""
    measures: list[Column] = [F.sum("count").cast("bigint").alias("count")]
    measures += [F.sum(f"expected_{b}").alias(f"expected_{b}") for b in bins]
    keyed = rows.withColumn("_level", F.explode(F.array(F.lit(None).cast("int"), F.col("smod"))))
    grouped = keyed.groupBy(cell, F.col("_level"), "built").agg(*measures)
    return grouped.select(
        cell,
        F.coalesce(F.col("_level").cast("string"), F.lit("ALL")).alias("smod"),
        F.coalesce(F.col("_level"), F.lit(-1)).alias("smod_sort"),
        "built",
        "count",
        *[f"expected_{b}" for b in bins],
    )


def ordered(rows: DataFrame, cell: str = "cell") -> DataFrame:
    """Cells in order, subtotals before detail, classes ascending."""
    return rows.orderBy(cell, "smod_sort", "built")
