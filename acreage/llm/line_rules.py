"""Rules of quality on whole texts, and lines that a host repeats across its documents (operator 10).

One pass over the texts yields the counts of each and a hash of each distinct normalised line (lower case, single
spaces). A line's frequency is the number of distinct texts of one host that hold it, so that copies of a document do
not make its lines frequent. Lines above the limit are removed; a document of which little is left is rejected.
Only hashes and counts are shuffled, never texts. A line that a third of all documents share is one aggregated row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.shared import cut_lineage, small_batches
from acreage.llm.words import NON_SPACE, code_points, find_words, gathered, grams, mix, range_hashes, slices
from acreage.session import broadcast_counted

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

MIN_WORDS = 50
#: Most words, in percent, that lie in repeated three-word windows.
MAX_REPEATED = 50
#: A line is frequent in more than so many distinct texts of its host, however large the host is.
LEAST_TEXTS = 20
#: A document is depleted when less than so many percent of its words are left.
LEFT_PERCENT = 30

_SCHEMA = (
    "id bigint, host string, text_key bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, lines array<bigint>, line_words array<bigint>"
)


def _sum_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _measures(texts) -> list[np.ndarray]:
    """text_key, the five counts, then the offsets, hashes and words of each text's distinct lines."""
    n = len(texts)
    words = find_words(texts, NON_SPACE, lower=False)
    word_bounds = np.append(words.first, len(words.start))
    chars = _sum_by(code_points(texts, words.start, words.end), word_bounds)
    symbols = _sum_by(SYMBOLS[texts.data], texts.offsets)

    threes, at = grams(words, 3)
    repeated = np.zeros(len(words.start) + 3, dtype=np.int64)
    if len(at):
        keyed = mix(threes ^ mix(words.text[at].astype(np.uint64)))
        _, inverse, times = np.unique(keyed, return_inverse=True, return_counts=True)
        often = at[times[inverse] > 1]
        np.add.at(repeated, often, 1)
        np.add.at(repeated, often + 3, -1)
    repeat_words = _sum_by(np.cumsum(repeated)[: len(words.start)] > 0, word_bounds)

    # Lines start at each text's start and after each line feed.
    feeds = np.flatnonzero(texts.data == 10)
    starts = np.unique(np.concatenate([texts.offsets[:-1][texts.offsets[:-1] < texts.offsets[1:]], feeds + 1]))
    starts = starts[starts < len(texts.data)]
    owner = np.searchsorted(texts.offsets, starts, side="right") - 1
    ends = np.append(starts[1:], len(texts.data))
    ends = ends - ((ends > starts) & (texts.data[np.maximum(ends - 1, 0)] == 10))
    first = np.searchsorted(words.start, starts)
    held = np.searchsorted(words.start, ends) - first
    full = held > 0
    starts, ends, owner, first, held = starts[full], ends[full], owner[full], first[full], held[full]
    exact = mix(range_hashes(texts, starts, ends, lower=False) ^ mix(owner.astype(np.uint64)))
    line_owner = owner[np.unique(exact, return_index=True)[1]]
    dup_lines = np.bincount(owner, minlength=n) - np.bincount(line_owner, minlength=n)

    # A normalised line is the sequence of its lowered words.
    lowered = range_hashes(texts, words.start, words.end)
    place = gathered(first, held)
    within = (place - np.repeat(first, held)).astype(np.uint64)
    sums = np.zeros(len(place) + 1, dtype=np.uint64)
    np.cumsum(mix(lowered[place] + mix(within)), out=sums[1:])
    last = np.cumsum(held)
    line = mix(sums[last] - sums[last - held])
    order = np.lexsort((line, owner))
    line, owner, held = line[order], owner[order], held[order]
    new = np.ones(len(line), dtype=bool)
    new[1:] = (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])
    group = np.flatnonzero(new)
    totals = np.add.reduceat(held, group) if len(group) else np.zeros(0, dtype=np.int64)
    offsets = np.searchsorted(owner[group], np.arange(n + 1))

    key = range_hashes(texts, texts.offsets[:-1], texts.offsets[1:], lower=False)
    return [key, words.count, chars, symbols, dup_lines, repeat_words, offsets, line[group], totals]


def measured(docs: DataFrame) -> DataFrame:
    """Counts and lines of every row of ``docs`` (id, host, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(2)):
                key, n_words, chars, symbols, dups, repeats, offsets, lines, totals = _measures(texts)
                offsets = pa.array(offsets.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high], batch.column(1)[low:high], pa.array(key.view(np.int64)), pa.array(n_words),
                        pa.array(chars), pa.array(symbols), pa.array(dups), pa.array(repeats),
                        pa.ListArray.from_arrays(offsets, pa.array(lines.view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(totals.astype(np.int64))),
                    ],
                    names=[part.split()[0] for part in _SCHEMA.split(", ")],
                )

    return docs.mapInArrow(run, _SCHEMA)


def line_quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source", least_texts: int = LEAST_TEXTS, left_percent: int = LEFT_PERCENT) -> DataFrame:
    """Counts, base rules and verdict of every row; also left_words, the words in lines that are not frequent.

    A null text has no words and fails the base rules; a null host is a host of its own. Repeated rows come back as
    often as they are given and count once for frequencies. No other column is read. No rows give no rows.
    Runs jobs while it builds its result: the measures are written to the shared folder.
    """
    rows = cut_lineage(measured(small_batches(docs).select(
        F.col(id_column).cast("bigint").alias("id"), F.col(host_column).cast("string").alias("host"), F.col(text_column).alias("text")
    )))
    rows = rows.withColumn("hosted", F.xxhash64(F.col("host").isNull(), F.coalesce("host", F.lit(""))))
    texts = rows.where("n_words > 0").groupBy("hosted", "text_key").agg(F.first(F.struct("lines", "line_words")).alias("held"))
    held = texts.select("hosted", "text_key", F.explode(F.arrays_zip("held.lines", "held.line_words")).alias("x"))
    held = held.select("hosted", "text_key", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"))
    counts = held.groupBy("hosted", "line").agg(F.count("*").alias("found")).where(F.col("found") > least_texts)
    frequent = cut_lineage(counts.select("hosted", "line"))
    removed = held.join(broadcast_counted(frequent), ["hosted", "line"]).groupBy("hosted", "text_key").agg(F.sum("words").alias("removed"))
    rows = rows.drop("lines", "line_words").join(removed, ["hosted", "text_key"], "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = rows.withColumn("left_words", F.col("n_words") - F.coalesce("removed", F.lit(0))).withColumn("base_failed", failed)
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (100 * F.col("left_words") >= left_percent * F.col("n_words"))).alias("kept"), "left_words",
    )
