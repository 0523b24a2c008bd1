"""Mixing sources to target token weights by entropy balancing (operator 6, DataFrame functions only).

Of all non-negative document rates that reach every source's token target, entropy balancing takes those closest to the
original corpus in relative entropy. With one token constraint for each source, and no rate above the repeat limit, the
solution is an exponential tilt, rate = min(limit, exp(lambda * size / mean size)), and lambda solves the convex dual.
Newton steps run over counts by source and size, which is exact because equal sizes get equal rates; every step is one
aggregation. Rates are then rounded: each document gets the whole part of its rate, and the fractions are settled by
hashed priorities, of which a cut per source takes as many words as the target still lacks.
Source tables have a row for each source; all document tables are only aggregated by source, with partial sums, so a
source that holds most of the rows spreads over all tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.llm.shared import cut_lineage

WEIGHTS = (5, 2, 1)
LIMIT = 3
#: Most Newton steps; they end earlier when every source is within TOLERANCE of its target.
STEPS, TOLERANCE = 24, 1e-9
#: Bins of one refinement of the priority cut, and their number.
BINS, REFINEMENTS = 1024, 3
SEED = 20

_SPACE = "concat(' ', char(9), char(10), char(11), char(12), char(13))"


def word_count(text: str) -> Column:
    """Number of runs of characters other than space and \\t to \\r; 0 for null."""
    trimmed = F.expr(f"btrim(`{text}`, {_SPACE})")
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, docs, source_size, target) for (source, size): shares by weight, none above ``limit`` times its size.

    Sources in code-point order, null last, take the weights in turn. Resharing the excess by weight until no source is
    above its limit is filling by level: the sources with the least room for their weight are full, the others get an
    equal level times weight. The windows are over one row for each source.
    """
    by_source = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = by_source.withColumn("turn", turn).withColumn("weight", F.element_at(cycle, ((F.col("turn") - 1) % len(weights)) + 1))
    room = limit * F.col("source_size").cast("double")
    order = Window.orderBy(room / F.col("weight"), "turn")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumn("room", room).withColumn("total", F.sum("source_size").over(everything).cast("double"))
    rows = rows.withColumn("level", (F.col("total") - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    rows = rows.withColumn("full", F.col("level") * F.col("weight") > F.col("room"))
    rows = rows.withColumn("common", F.min(F.when(~F.col("full"), F.struct(F.col("room") / F.col("weight"), F.col("turn"), F.col("level").alias("level")))).over(everything)["level"])
    target = F.when(F.col("full"), F.col("room")).otherwise(F.least(F.col("common") * F.col("weight"), "room"))
    return rows.select("source", "docs", "source_size", target.alias("target"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _exact_sum(term: Column) -> Column:
    """A sum that does not depend on the order of its terms: decimal digits are added, so that reruns agree."""
    return F.sum(term.cast("decimal(38,9)")).cast("double")


def tilts(sizes: DataFrame, targets: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``targets`` with mean and tilt (lambda) of each source; one written table for each Newton step."""
    counts = cut_lineage(sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")))
    counts = counts.withColumnRenamed("source", "of")
    mean = F.col("source_size") / F.col("docs")
    share = F.col("target") / F.col("source_size")
    state = cut_lineage(
        targets.where("source_size > 0 and target > 0").withColumn("mean", mean)
        .withColumn("tilt", F.when(share >= limit, F.lit(math.inf)).otherwise(F.log(share)))
        .withColumn("low", F.lit(-math.inf)).withColumn("high", F.lit(math.inf)).withColumn("miss", F.lit(1.0))
    )
    names = state.columns
    scaled = F.col("size") / F.col("mean")
    grown = F.exp(F.least(F.col("tilt") * scaled, F.lit(math.log(limit))))
    capped = F.col("tilt") * scaled >= math.log(limit)
    for _ in range(STEPS):
        open_rows = state.where((F.col("tilt") < math.inf) & (F.abs("miss") > TOLERANCE))
        if open_rows.isEmpty():
            break
        sums = counts.join(F.broadcast(open_rows) if _few(open_rows) else open_rows, _same("of", "source")).groupBy("source").agg(
            _exact_sum(F.col("n") * F.col("size") * grown).alias("reached"),
            _exact_sum(F.when(capped, 0.0).otherwise(F.col("n") * F.col("size") * scaled * grown)).alias("slope"),
        ).withColumnRenamed("source", "of")
        moved = state.join(sums, _same("source", "of"), "left")
        gap = F.col("reached") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.when(F.col("slope") > 0, F.col("tilt") - gap / F.col("slope"))
        # A step that leaves the bracket is replaced by its middle, or by a doubled distance where one side is open.
        middle = F.when((low > -math.inf) & (high < math.inf), (low + high) / 2).when(high < math.inf, high - 2 * F.greatest(F.abs(high), F.lit(1.0))).otherwise(low + 2 * F.greatest(F.abs(low), F.lit(1.0)))
        tilt = F.when(gap == 0, F.col("tilt")).when((step > low) & (step < high), step).otherwise(middle)
        state = cut_lineage(moved.select(
            "source", "docs", "source_size", "target", "mean",
            F.when(F.col("reached").isNull(), F.col("tilt")).otherwise(tilt).alias("tilt"),
            F.when(F.col("reached").isNull(), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("reached").isNull(), F.col("high")).otherwise(high).alias("high"),
            F.when(F.col("reached").isNull(), F.col("miss")).otherwise(gap / F.col("target")).alias("miss"),
        ).select(*names))
    return state.select("source", "docs", "source_size", "target", "mean", "tilt")


#: Most rows of a source table that is broadcast; it is a written table and counted first.
BROADCAST_SOURCES = 200_000


def _few(sources: DataFrame) -> bool:
    return sources.count() <= BROADCAST_SOURCES


class Mix:
    """Rates and cuts of every source, found from the sizes of all documents; applies to any rows of those documents."""

    def __init__(self, docs: DataFrame, id_column: str, text_column: str, source_column: str, weights: tuple[int, ...], limit: int, seed: int):
        self.names, self.limit, self.seed = (id_column, text_column, source_column), limit, seed
        sizes = cut_lineage(docs.select(
            F.col(id_column).cast("bigint").alias("doc_id"), F.col(source_column).cast("string").alias("source"), word_count(text_column).alias("size")
        ))
        targets = cut_lineage(source_targets(sizes, weights, limit))
        state = tilts(sizes, targets, limit).select(F.col("source").alias("of"), "mean", "tilt")
        self.sources = cut_lineage(targets.withColumnRenamed("source", "key").join(state, _same("key", "of"), "left").drop("of"))
        self.few = _few(self.sources)
        self.sizes = sizes
        self.cuts = cut_lineage(self._refined())

    def _joined(self, rows: DataFrame, sources: DataFrame, how: str = "left") -> DataFrame:
        return rows.join(F.broadcast(sources) if self.few else sources, _same("source", "key"), how)

    def rated(self, rows: DataFrame) -> DataFrame:
        """Adds rate, its whole part and a priority for the rest to rows with doc_id, source and size."""
        log_limit = math.log(self.limit)
        tilted = F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(log_limit + 1e-12)))
        rate = (
            F.when((F.col("size") == 0) | F.col("tilt").isNull(), 0.0).when(F.col("tilt") == math.inf, float(self.limit))
            .otherwise(F.least(F.lit(float(self.limit)), tilted))
        )
        parts = (F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), F.coalesce("source", F.lit("")), "size", F.lit(self.seed))
        uniform = (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        found = self._joined(rows, self.sources).withColumn("rate", rate).drop("key", "docs", "mean", "tilt")
        found = found.withColumn("whole", F.floor("rate").cast("bigint"))
        part = F.col("rate") - F.col("whole")
        odds = uniform / part
        return found.withColumn("priority", F.when(part > 0, odds / (1 + odds)))

    def _refined(self) -> DataFrame:
        """(key, edge, extra): priorities below the edge, or equal to extra, get one copy more.

        The edge is the last one, found in finer and finer bins, up to which the words do not exceed what the target
        lacks; extra is the priority from there on whose words fill the remaining gap best, if any makes it smaller.
        """
        rated = cut_lineage(self.rated(self.sizes))
        need = rated.groupBy("source").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("need"))
        cuts = cut_lineage(need.select(
            F.col("source").alias("key"), "need", F.lit(0.0).alias("low"), F.lit(1.0 / BINS).alias("width"),
            F.lit(0.0).alias("below"),
        ))
        inside = (F.col("priority") >= F.col("low")) & (F.col("priority") < F.col("low") + BINS * F.col("width"))
        place = F.least(F.floor((F.col("priority") - F.col("low")) / F.col("width")), F.lit(BINS - 1))
        for number in range(REFINEMENTS):
            bins = self._joined(rated.where("priority is not null"), cuts, "inner").where(inside)
            bins = bins.groupBy(F.col("key").alias("of"), place.alias("bin")).agg(F.sum("size").cast("double").alias("words"))
            bins = bins.join(cuts, _same("of", "key"))
            upto = F.sum("words").over(Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
            bins = bins.withColumn("upto", F.col("below") + upto)
            # The first bin that reaches the need has the cut; if none does, everything is taken.
            reaches = F.struct("bin", (F.col("upto") - F.col("words")).alias("below"))
            best = bins.groupBy("of").agg(
                F.min(F.when(F.col("upto") >= F.col("need"), reaches)).alias("hit"), F.max(F.struct("bin", "upto")).alias("end")
            )
            last = number == REFINEMENTS - 1
            cuts = cut_lineage(cuts.join(best, _same("key", "of"), "left").select(
                "key", "need",
                (F.col("low") + F.coalesce(F.col("hit.bin"), F.col("end.bin") + 1, F.lit(0)) * F.col("width")).alias("low"),
                (F.when(F.col("hit").isNull(), 0.0).otherwise(F.col("width")) / (1 if last else BINS)).alias("width"),
                F.coalesce(F.col("hit.below"), F.col("end.upto"), F.col("below")).alias("below"),
            ))
        gaps = cuts.select("key", F.col("low").alias("edge"), (F.col("need") - F.col("below")).alias("gap"))
        rest = self._joined(rated.where("priority is not null"), gaps, "inner").where("priority >= edge")
        rest = rest.groupBy(F.col("key").alias("of"), "priority").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
        missed = F.abs(F.col("gap") - F.col("words"))
        rest = rest.where(missed < F.abs("gap")).groupBy("of").agg(F.min(F.struct(missed.alias("missed"), "priority"))["priority"].alias("extra"))
        return gaps.join(rest, _same("key", "of"), "left").select("key", "edge", "extra")

    def copied(self, rows: DataFrame) -> DataFrame:
        """Adds copies to rows with doc_id, source and size."""
        found = self._joined(self.rated(rows), self.cuts).drop("key")
        more = F.when((F.col("priority") < F.col("edge")) | (F.col("priority") == F.col("extra")), 1).otherwise(0)
        return found.withColumn("copies", (F.col("whole") + more).cast("bigint")).drop("whole", "priority", "edge", "extra")


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) of every row.

    A null or empty text has size 0 and no copies; a null source is a source of its own, the last. A source without
    words has target 0. Repeated rows (equal id, source and size) are decided alike; rows without id are told apart by
    source and size only. Reruns agree, as priorities are hashes of the row. No other column is read. No rows give no
    rows. Each source's taken words miss the target by a part of one document. Runs jobs while it builds its
    result: sizes, Newton states and cuts are written to the shared folder.
    """
    mix = Mix(docs, id_column, text_column, source_column, weights, limit, seed)
    return mix.copied(mix.sizes).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns; no text is shuffled."""
    mix = Mix(docs, id_column, text_column, source_column, weights, limit, seed)
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"), word_count(text_column).alias("size"),
    )
    taken = mix.copied(rows).where("copies > 0").select("row", F.explode(F.expr("sequence(1, copies)")).alias("copy"))
    return taken.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
