"""Phrase collocations by best-first branch and bound (operator 11).

A phrase of two or three words that occurs a times scores a * a / (l * r) at a cut into parts that occur l and r times;
its lowest cut counts. Words are nodes of a tree, phrases grow from them word by word. A phrase occurs no oftener than
any of its parts, so the counts of its parts bound its score from above before it is counted itself: the smallest known
count of a part takes the place of a, and unknown parts that of l or r. The tree is grown best first in waves. A wave
counts every phrase whose bound reaches the wave's level, and the longer phrases that could displace a candidate above
that level; nothing else is counted. Once a language has enough surviving candidates at or above the level, no phrase
outside the frontier can enter or tie, and the language is settled. The last wave has no level and settles the rest.

One pass reads the texts and writes them as streams of 64-bit word identifiers, with the words' counts; the waves read
the streams. Counts reach the tasks as two tables of fixed size, by a hash of the phrase: the largest and the smallest
count of a bucket, in quarter octaves. Phrases that share a bucket only loosen a bound, so the result does not depend
on the size of the tables. Counting sums map-side first; no word or language is one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.llm.shared import cut_lineage, small_batches
from acreage.llm.words import LOWER_ASCII, Texts, find_words, gathered, mix, slices
from acreage.session import broadcast_counted

#: Fewest occurrences of a candidate, and most candidates that a language returns.
LEAST, MOST = 10, 2000
#: A candidate goes when a longer one that holds it occurs at least so many hundredths as often.
DISPLACED = 50
#: Levels of the waves, as powers of a quarter octave of the score: 1/4, 1/64, then everything.
LEVELS = (-8, -24, None)
#: Buckets of the tables of counts, as a power of two; three bytes a bucket are broadcast.
TABLE_BITS = 22
#: Words of a stream that are written as one row, and words that follow so that phrases reach over its end.
ROW_WORDS, AHEAD = 1 << 18, 2
#: Selected places of a task that are counted at once.
COUNTED = 1 << 19
#: What stands for a language that is not given.
UNKNOWN = "und"
#: Below every bound.
_NEVER = -(1 << 14)

#: Pieces end at these characters, words also at space and tab.
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[ord(c) for c in ".,;:!?"]] = True
SEPARATORS[0x0A:0x0E] = True
MEMBERS = ~SEPARATORS
MEMBERS[[0x20, 0x09]] = False

_STREAM = "tokens array<bigint>, lang string, id bigint, n bigint, word string"


def _identified(texts: Texts, lang_keys: np.ndarray):
    """Words, their identifiers (never 0), and whether each is the first of its piece."""
    words = find_words(texts, MEMBERS)
    ids = mix(words.hash ^ mix(lang_keys[words.text]))
    ids[ids == 0] = 1
    ends = np.zeros(len(texts.data) + 1, dtype=np.int64)
    np.cumsum(SEPARATORS[texts.data], out=ends[1:])
    piece = ends[words.start]
    first = np.ones(len(ids), dtype=bool)
    first[1:] = (piece[1:] != piece[:-1]) | (words.text[1:] != words.text[:-1])
    return words, ids.view(np.int64), first


def _stream_rows(stream: np.ndarray) -> Iterator[np.ndarray]:
    padded = np.concatenate([stream, np.zeros(AHEAD, dtype=np.int64)])
    for low in range(0, len(stream), ROW_WORDS):
        yield padded[low : low + ROW_WORDS + AHEAD]


def _strings(texts: Texts, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The lowered byte ranges as strings."""
    sizes = end - start
    data = LOWER_ASCII[texts.data[gathered(start, sizes)]]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def streams(docs: DataFrame) -> DataFrame:
    """Of ``docs`` (lang_key, lang, text): rows with ``tokens``, and rows with a word's count in some of the texts.

    0 in ``tokens`` ends a piece. The last two tokens of a row only follow it; they are counted with the next row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _STREAM.split(", ")]
        for batch in batches:
            keys = np.asarray(batch.column(0)).view(np.uint64)
            ids, counts, words, owners = [], [], [], []
            for low, high, texts in slices(batch.column(2)):
                found, every, first = _identified(texts, keys[low:high])
                if not len(every):
                    continue
                for row in _stream_rows(np.insert(every, np.flatnonzero(first), 0)):
                    tokens = pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), pa.array(row))
                    blank = [pa.nulls(1, t) for t in (pa.string(), pa.int64(), pa.int64(), pa.string())]
                    yield pa.RecordBatch.from_arrays([tokens, *blank], names=names)
                one, at, n = np.unique(every, return_index=True, return_counts=True)
                ids.append(one)
                counts.append(n)
                words.append(_strings(texts, found.start[at], found.end[at]))
                owners.append(found.text[at] + low)
            if ids:
                one, at, inverse = np.unique(np.concatenate(ids), return_index=True, return_inverse=True)
                n = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)
                word = pa.concat_arrays(words).take(pa.array(at)).cast(pa.string())
                lang = batch.column(1).take(pa.array(np.concatenate(owners)[at]))
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(one), pa.list_(pa.int64())), lang, pa.array(one), pa.array(n), word], names=names
                )

    return docs.mapInArrow(run, _STREAM)


def _quarters(count: Column) -> tuple[Column, Column]:
    """Quarter octaves that are surely not below, and not above, a count."""
    place = 4 * F.log2(count.cast("double"))
    return F.ceil(place + 1e-6).cast("int"), F.greatest(F.floor(place - 1e-6), F.lit(0)).cast("int")


def _bucket(first: str, second: str | None, bits: int) -> Column:
    mixed = F.col(first) if second is None else F.col(first).bitwiseXOR(F.shiftrightunsigned(second, 7))
    return mixed.bitwiseAND(F.lit((1 << bits) - 1))


def _buckets(first: np.ndarray, second: np.ndarray | None, bits: int) -> np.ndarray:
    mixed = first if second is None else first ^ (second.view(np.uint64) >> np.uint64(7)).view(np.int64)
    return mixed & ((1 << bits) - 1)


def _table(counts: DataFrame, bits: int, first: str, second: str | None = None, flag: Column | None = None) -> Broadcast:
    """Most and least quarter octaves of each bucket (0 and 255 where it is empty), and whether any row is flagged."""
    high, low = _quarters(F.col("f"))
    marked = F.lit(False) if flag is None else flag
    rows = counts.groupBy(_bucket(first, second, bits).cast("int").alias("b")).agg(
        F.max(high).cast("smallint").alias("high"), F.min(low).cast("smallint").alias("low"), F.max(marked.cast("smallint")).alias("mark")
    ).toArrow()
    place = np.asarray(rows.column(0).combine_chunks())
    table = [np.zeros(1 << bits, dtype=np.uint8), np.full(1 << bits, 255, dtype=np.uint8), np.zeros(1 << bits, dtype=np.uint8)]
    for values, column in zip(table, rows.columns[1:], strict=True):
        values[place] = np.asarray(column.combine_chunks()).astype(np.uint8)
    return counts.sparkSession.sparkContext.broadcast(table)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of one row after the other, and the places at which its own phrases start."""
    for batch in batches:
        lists = batch.column(0)
        if isinstance(lists, pa.ExtensionArray):
            lists = lists.storage
        offsets, values = np.asarray(lists.offsets), np.asarray(lists.values)
        for low, high in zip(offsets[:-1], offsets[1:], strict=True):
            yield values[low:high], np.flatnonzero(values[low : high - AHEAD])


def _counted(words: list[np.ndarray]) -> pa.RecordBatch:
    """Distinct rows of the words, and how often each occurs."""
    key = words[0].view(np.uint64)
    for word in words[1:]:
        key = mix(key ^ mix(word.view(np.uint64)))
    _, at, n = np.unique(key, return_index=True, return_counts=True)
    names = [f"w{i + 1}" for i in range(len(words))]
    return pa.RecordBatch.from_arrays([*(pa.array(w[at]) for w in words), pa.array(n.astype(np.int64))], names=[*names, "n"])


def _counted_portions(found: Iterator[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The same of about ``COUNTED`` rows at a time, so that a task's memory follows neither its batches nor its input."""
    held: list[list[np.ndarray]] = []
    size = 0
    for words in found:
        held.append(words)
        size += len(words[0])
        if size >= COUNTED:
            yield _counted([np.concatenate(w) for w in zip(*held, strict=True)])
            held, size = [], 0
    if size:
        yield _counted([np.concatenate(w) for w in zip(*held, strict=True)])


def _pair_keys(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Bounds, in quarter octaves, of a pair's score by its words' counts, for each place and the next."""
    return np.minimum(high[:-1], high[1:]) - np.maximum(low[:-1], low[1:])


def _of_words(tokens: np.ndarray, table: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the words' counts; the upper one is 0 where no word of the bucket is flagged."""
    place = _buckets(tokens, None, bits)
    high = table[0][place].astype(np.int16)
    high[(tokens == 0) | (table[2][place] == 0)] = 0
    return high, table[1][place].astype(np.int16)


def _pairs(tokens: DataFrame, words: Broadcast, bits: int, level: int, above: int, only: Broadcast | None = None) -> DataFrame:
    """(w1, w2, f) of pairs whose bound lies in level <= bound < above; with ``only``, of flagged pairs among them."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for stream, at in _rows(batches):
            high, low = _of_words(stream, words.value, bits)
            at = at[(high[at] > 0) & (high[at + 1] > 0)]
            bound = _pair_keys(high, low)[at]
            at = at[(bound >= level) & (bound < above)]
            if only is not None:
                at = at[only.value[2][_buckets(stream[at], stream[at + 1], bits)] > 0]
            yield [stream[at], stream[at + 1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted_portions(found(batches))

    return tokens.mapInArrow(run, "w1 bigint, w2 bigint, n bigint").groupBy("w1", "w2").agg(F.sum("n").alias("f"))


def _triples(tokens: DataFrame, words: Broadcast, pairs: Broadcast, bits: int, level: int) -> DataFrame:
    """(w1, w2, w3, f) of triples whose bound reaches the level, or that could displace a flagged pair.

    A pair whose own bound reaches the level has been counted: its bucket bounds the triple, and an empty one rules it out.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        most, least, flags = pairs.value
        for stream, at in _rows(batches):
            high, low = _of_words(stream, words.value, bits)
            at = at[(high[at] > 0) & (high[at + 1] > 0) & (high[at + 2] > 0)]
            known = _pair_keys(high, low) >= level
            left, right = (_buckets(stream[at + k], stream[at + k + 1], bits) for k in (0, 1))
            has_left, has_right = known[at], known[at + 1]
            top = np.minimum(np.minimum(high[at], high[at + 1]), high[at + 2])
            top = np.where(has_left, np.minimum(top, most[left]), top)
            top = np.where(has_right, np.minimum(top, most[right]), top).astype(np.int16)
            first = np.where(has_right, np.minimum(top, 2 * top - least[right]), top) - low[at]
            second = np.where(has_left, np.minimum(top, 2 * top - least[left]), top) - low[at + 2]
            wanted = np.minimum(first, second) >= level
            for has, place in ((has_left, left), (has_right, right)):
                wanted |= has & (flags[place] > 0) & (top >= least[place].astype(np.int16) - 4)
            at = at[wanted & (top > 0)]
            yield [stream[at], stream[at + 1], stream[at + 2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted_portions(found(batches))

    return tokens.mapInArrow(run, "w1 bigint, w2 bigint, w3 bigint, n bigint").groupBy("w1", "w2", "w3").agg(F.sum("n").alias("f"))


def with_score(rows: DataFrame, name: str, a: str, left: str, right: str) -> DataFrame:
    """Adds floor(1000000 * a * a / (left * right)), exact for counts of up to 10^16."""
    wide = {x: f"cast({x} as decimal(19,0))" for x in (a, left, right)}
    return rows.withColumn(name, F.expr(f"(cast(1000000 as decimal(7,0)) * ({wide[a]} * {wide[a]})) div ({wide[left]} * {wide[right]})"))


def _scored_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(w1, w2, w3 null, a, l, r, score) of counted pairs."""
    one = words.select(F.col("id").alias("w1"), F.col("f").alias("l"))
    two = words.select(F.col("id").alias("w2"), F.col("f").alias("r"))
    rows = pairs.withColumnRenamed("f", "a").join(one, "w1").join(two, "w2")
    rows = with_score(rows, "score", "a", "l", "r")
    return rows.select("w1", "w2", F.lit(None).cast("bigint").alias("w3"), "a", "l", "r", "score")


def _scored_triples(triples: DataFrame, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The same of counted triples, by their lowest cut."""
    one = words.select(F.col("id").alias("w1"), F.col("f").alias("f1"))
    three = words.select(F.col("id").alias("w3"), F.col("f").alias("f3"))
    left = pairs.select("w1", "w2", F.col("f").alias("f12"))
    right = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23"))
    rows = triples.withColumnRenamed("f", "a").join(one, "w1").join(three, "w3").join(left, ["w1", "w2"]).join(right, ["w2", "w3"])
    rows = with_score(with_score(rows, "s1", "a", "f1", "f23"), "s2", "a", "f12", "f3")
    cut = F.least(
        F.struct(F.col("s1").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f23").alias("r")),
        F.struct(F.col("s2").alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("f3").alias("r")),
    )
    return rows.withColumn("cut", cut).select("w1", "w2", "w3", "a", "cut.l", "cut.r", "cut.score")


def _undisplaced(scored: DataFrame, triples: DataFrame) -> DataFrame:
    """Pairs that no triple displaces."""
    longer = triples.select("w1", "w2", "f").union(triples.select("w2", "w3", "f")).groupBy("w1", "w2").agg(F.max("f").alias("longer"))
    return scored.join(longer, ["w1", "w2"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < DISPLACED * F.col("a"))
    ).drop("longer")


def collocations(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, most: int = MOST, levels: tuple[int | None, ...] = LEVELS, table_bits: int = TABLE_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``most`` best phrases, by score, count and phrase.

    A null text is empty, a null language is ``und``. Repeated rows count as often as they are given. Ties beyond score
    and count are ranked by the phrase's UTF-8 bytes, so no two rows share a rank. Very long texts are read whole, and
    phrases never reach over a separator or from one text into another. Languages without a phrase of ``least``
    occurrences, and empty tables, give no rows. Only the named columns are read. ``levels`` only decide what is counted
    when; the last must be None. Words are told apart by 64-bit hashes. Runs jobs while it builds its result.
    """
    if not levels or levels[-1] is not None or None in levels[:-1]:
        raise ValueError("the last level, and no other, must be None")
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN))
    rows = small_batches(docs).select(F.xxhash64(lang).alias("lang_key"), lang.alias("lang"), F.col(text_column).alias("text"))
    written = cut_lineage(streams(rows))
    tokens = written.where("tokens is not null").select("tokens")
    counts = cut_lineage(written.where("id is not null").groupBy("id", "lang", "word").agg(F.sum("n").alias("f")))
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = cut_lineage(counts.where(F.col("f") >= least))

    still = cut_lineage(frequent.select("lang").distinct())
    pairs, settled, above = None, [], 1 << 14
    for level in levels:
        if still.isEmpty():
            break
        bound = _NEVER if level is None else level
        words = cut_lineage(frequent.join(broadcast_counted(still), "lang", "left_semi"))
        near = broadcast_counted(words.select("id", "f"))
        # Of all languages, settled or not: bounds that changed between waves would count a pair in two of them.
        opened = frequent.join(broadcast_counted(still.withColumn("open", F.lit(1))), "lang", "left")
        of_words = _table(opened, table_bits, "id", flag=F.col("open").isNotNull())
        found = cut_lineage(_pairs(tokens, of_words, table_bits, bound, above).where(F.col("f") >= least))
        pairs = found if pairs is None else cut_lineage(pairs.union(found).join(near.select(F.col("id").alias("w1")), "w1", "left_semi"))
        edge = 0 if level is None else int(1_000_000 * 2.0 ** (level / 4))
        two = cut_lineage(_scored_pairs(pairs, near).where(F.col("score") >= edge))

        flagged = pairs.join(two.select("w1", "w2", F.lit(1).alias("hit")), ["w1", "w2"], "left")
        of_pairs = _table(flagged, table_bits, "w1", "w2", F.col("hit").isNotNull())
        triples = cut_lineage(_triples(tokens, of_words, of_pairs, table_bits, bound).where(F.col("f") >= least))
        every = pairs
        if level is not None:  # parts of triples whose own bound lies below the level
            parts = triples.select("w1", "w2").union(triples.select("w2", "w3").toDF("w1", "w2")).distinct()
            missing = cut_lineage(parts.join(pairs, ["w1", "w2"], "left_anti").withColumn("f", F.lit(1)))
            of_missing = _table(missing, table_bits, "w1", "w2", F.lit(True))
            more = _pairs(tokens, of_words, table_bits, _NEVER, bound, of_missing).join(missing.select("w1", "w2"), ["w1", "w2"], "left_semi")
            every = cut_lineage(pairs.union(more))
            of_missing.unpersist()
        three = _scored_triples(triples, every, near).where(F.col("score") >= edge)
        alive = _undisplaced(two, triples).unionByName(three)
        alive = cut_lineage(alive.join(broadcast_counted(words.select(F.col("id").alias("w1"), "lang")), "w1"))
        of_words.unpersist()
        of_pairs.unpersist()

        done = still if level is None else cut_lineage(alive.groupBy("lang").agg(F.count("*").alias("found")).where(F.col("found") >= most).select("lang"))
        settled.append(alive.join(broadcast_counted(done), "lang", "left_semi"))
        still = cut_lineage(still.join(done, "lang", "left_anti"))
        above = bound
    if not settled:
        return counts.select("lang", F.lit(0).cast("bigint").alias("rank"), F.col("word").alias("phrase"), *(
            F.lit(0).cast("bigint").alias(c) for c in ("a", "l", "r", "n", "score")
        )).where("false")

    best = settled[0]
    for part in settled[1:]:
        best = best.unionByName(part)
    for place in (1, 2, 3):
        spelled = frequent.select(F.col("id").alias(f"w{place}"), F.col("word").alias(f"t{place}"))
        best = best.join(broadcast_counted(spelled), f"w{place}", "left" if place == 3 else "inner")
    best = best.withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).join(broadcast_counted(totals), "lang")
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
