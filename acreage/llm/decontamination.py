"""Benchmark passages in documents, by Wu-Manber search over words (operator 5).

A pattern is a window of 13 consecutive words of an item, or a whole shorter item. Patterns of one length form a
machine: a shift table over blocks of two words says how far the search may jump from a block, and where it says 0, the
bucket of the block holds the patterns that end in it; those are compared word by word, then byte by byte.
Documents never move: each batch of whole texts is searched where it is read. The patterns are sent to the executors in
portions of bounded size; a larger benchmark is searched portion by portion, each pass adding its finds to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from acreage.llm.shared import cut_lineage, small_batches
from acreage.llm.words import ALPHANUMERIC, LOWER_ASCII, Texts, Words, find_words, gathered, mix, slices, texts_of

WINDOW = 13
#: Bytes of item texts whose patterns are sent out at once.
PORTION_BYTES = 8 << 20
#: Places of one text that a search cursor covers; long texts are searched by many cursors at once.
CURSOR_SPAN = 256
#: A document is contaminated when at least one word in so many is hit.
ONE_IN = 20

_TABLE_BITS = 17


def _block(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (mix(first * np.uint64(3) + second) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


class Machine:
    """Shift and bucket tables of all patterns of one length."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, length: int):
        self.length, self.starts, self.codes = length, starts, codes
        self.width = min(2, length)
        self.shift = np.full(1 << _TABLE_BITS, length - self.width + 1, dtype=np.int64)
        for end in range(self.width, length + 1):
            np.minimum.at(self.shift, self.block(codes, starts + end - 1), length - end)
        last = self.block(codes, starts + length - 1)
        self.order = np.argsort(last, kind="stable")
        self.bucket = np.searchsorted(last[self.order], np.arange((1 << _TABLE_BITS) + 1))

    def block(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Block hash of the words that end at ``at``."""
        return _block(codes[at - self.width + 1], codes[at])

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, pattern number) of every occurrence whose word hashes all agree."""
        m, codes = self.length, words.hash
        long_enough = np.flatnonzero(words.count >= m)
        spans = words.count[long_enough] - m + 1
        cursors = (spans + CURSOR_SPAN - 1) // CURSOR_SPAN
        step = gathered(np.zeros(len(cursors), dtype=np.int64), cursors) * CURSOR_SPAN
        low = np.repeat(words.first[long_enough] + m - 1, cursors)
        at = low + step
        stop = np.minimum(at + CURSOR_SPAN, low + np.repeat(spans, cursors))
        places, patterns = [], []
        while len(at):
            block = self.block(codes, at)
            shift = self.shift[block]
            ready = shift == 0
            if ready.any():
                place, bucket = at[ready] - m + 1, block[ready]
                held = self.bucket[bucket + 1] - self.bucket[bucket]
                pattern = self.order[gathered(self.bucket[bucket], held)]
                place = np.repeat(place, held)
                for k in range(m):
                    same = codes[place + k] == self.codes[self.starts[pattern] + k]
                    place, pattern = place[same], pattern[same]
                    if not len(place):
                        break
                places.append(place)
                patterns.append(pattern)
            at = at + np.maximum(shift, 1)
            left = at < stop
            at, stop = at[left], stop[left]
        if not places:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(places), np.concatenate(patterns)


class Patterns:
    """All patterns of some items, (item id, text); items without words have none."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        self.texts = texts_of(pa.array([text for _, text in items], pa.large_string()))
        self.words = find_words(self.texts, ALPHANUMERIC)
        self.machines, self.items = [], []
        lengths = np.minimum(self.words.count, window)
        for m in np.unique(lengths[lengths > 0]).tolist():
            item = np.flatnonzero(lengths == m)
            windows = self.words.count[item] - m + 1
            starts = gathered(self.words.first[item], windows)
            self.machines.append(Machine(self.words.hash, starts, m))
            self.items.append(np.repeat(item, windows))

    def find(self, texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, last word + 1, item number) of every confirmed occurrence."""
        found = []
        for machine, items in zip(self.machines, self.items, strict=True):
            place, pattern = machine.search(words)
            same = np.fromiter(
                (self._same(texts, words, p, machine.starts[q], machine.length) for p, q in zip(place, pattern, strict=True)),
                dtype=bool, count=len(place),
            )
            found.append((place[same], place[same] + machine.length, items[pattern[same]]))
        if not found:
            return (np.zeros(0, dtype=np.int64),) * 3
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))

    def _same(self, texts: Texts, words: Words, place: int, start: int, length: int) -> bool:
        return all(
            np.array_equal(
                LOWER_ASCII[texts.data[words.start[place + k] : words.end[place + k]]],
                LOWER_ASCII[self.texts.data[self.words.start[start + k] : self.words.end[start + k]]],
            )
            for k in range(length)
        )


def _runs(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Union of word ranges, as ranges in order."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(zip(first.tolist(), last.tolist(), strict=True)):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _passed(docs: DataFrame, patterns: Patterns, last: bool) -> DataFrame:
    """One pass: adds the finds of ``patterns`` to columns runs (word ranges, flat) and items, and at last the word count.

    The first three columns are text, runs and items; whatever follows rides along.
    """
    schema = StructType([*docs.schema.fields, *([StructField("n_words", LongType())] if last else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(0)):
                words = find_words(texts, ALPHANUMERIC)
                first, end, item = patterns.find(texts, words)
                owner = words.text[first]
                order = np.argsort(owner, kind="stable")
                bounds = np.searchsorted(owner[order], np.arange(high - low + 1))
                runs, items = batch.column(1)[low:high].to_pylist(), batch.column(2)[low:high].to_pylist()
                for i in np.unique(owner).tolist():
                    mine = order[bounds[i] : bounds[i + 1]]
                    base = words.first[i]
                    old = np.array(runs[i], dtype=np.int64).reshape(-1, 2)
                    merged = _runs(np.concatenate([old[:, 0], first[mine] - base]), np.concatenate([old[:, 1], end[mine] - base]))
                    runs[i] = [x for pair in merged for x in pair]
                    items[i] = sorted({*items[i], *(patterns.names[k] for k in np.unique(item[mine]).tolist())})
                part = batch.slice(low, high - low)
                finds = [pa.array(runs, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
                counts = [pa.array(words.count)] if last else []
                yield pa.RecordBatch.from_arrays([part.column(0), *finds, *part.columns[3:], *counts], names=schema.names)

    return docs.mapInArrow(run, schema)


def _searched(docs: DataFrame, benchmark: DataFrame, text_column: str, item_column: str, item_text: str, window: int, portion_bytes: int) -> DataFrame:
    """text, runs, items, then a struct ``row`` of the given columns, and n_words."""
    items = benchmark.where(F.col(item_column).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item_column).cast("string").alias("item"), F.col(item_text).alias("body")
    ).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    portions = max(1, -(-size // portion_bytes))
    rest = [c for c in docs.columns if c != text_column]
    rows = small_batches(docs).select(
        F.col(text_column).alias("text"), F.expr("cast(array() as array<bigint>)").alias("runs"),
        F.expr("cast(array() as array<string>)").alias("items"), F.struct(*rest).alias("row"),
    )
    for number in range(portions):
        part = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(portions)) == number)
        held = [(r[0], r[1]) for r in part.orderBy("item", "body").toLocalIterator()]
        rows = _passed(rows, Patterns(held, window), number == portions - 1)
        if number < portions - 1:
            rows = cut_lineage(rows)  # The plan, and so the driver and the tasks, hold one portion's patterns at a time.
    hit = F.expr("aggregate(sequence(0, size(runs) div 2 - 1), 0L, (n, i) -> n + runs[2 * i + 1] - runs[2 * i])")
    return rows.withColumn("n_hit", F.when(F.size("runs") > 0, hit).otherwise(F.lit(0).cast("bigint")))


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", window: int = WINDOW, portion_bytes: int = PORTION_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, items, runs): words inside benchmark windows, the items met, and the hit word ranges.

    Null and empty texts have no words and no hits; an item without id or words has no patterns; items of one id are one
    item. Every given row comes back once, also repeated rows and rows without id. Only the named columns are read, so
    further columns may have any names. An empty benchmark hits nothing. The benchmark is measured first, then
    collected in portions of at most ``portion_bytes`` of text on average, one search pass for each. All passes but the
    last write their rows to the shared folder, so only one portion's patterns are held at a time.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    found = _searched(rows, benchmark, "text", item_column, item_text, window, portion_bytes)
    return found.select("row.doc_id", "n_words", "n_hit", "items", "runs")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text", window: int = WINDOW, portion_bytes: int = PORTION_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns; nothing is shuffled."""
    found = _searched(docs, benchmark, text_column, item_column, item_text, window, portion_bytes)
    columns = [F.col("text").alias(c) if c == text_column else F.col("row").getField(c).alias(c) for c in docs.columns]
    return found.where(~contaminated()).select(*columns)


def contamination_digest(hits: DataFrame) -> DataFrame:
    """The contract's columns of ``benchmark_hits``: item ids sorted as strings, comma-joined and hashed."""
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
