"""Quality by importance resampling (operator 3).

Two generative models of hashed n-grams, one of the target (documents labelled good) and one of the raw text (all
documents), give each document the log ratio of its probabilities; Gumbel noise is added, and the k largest sums stay,
which samples k documents without replacement in proportion to their importance. N-grams are words, word pairs, and
one to three shapes of words in a row; a shape is the run of character classes of a word, and whether the word repeats
one of the two before it.

Two passes read the texts, and no text is shuffled: the first adds counts into a fixed number of buckets, from all
documents, the second scores. k is the number of documents for which the target is likelier than the rest, by a
threshold set on labelled documents that the target model has not seen. The cut at the k-th sum is found by counts in
refined bins.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from acreage.llm.shared import cut_lineage, small_batches
from acreage.llm.words import NON_SPACE, Texts, find_words, grams, mix, range_hashes, slices

#: Most labelled rows that are used, chosen by a hash of their id; the ids are broadcast.
LABELLED_ROWS = 20_000
#: Buckets of each kind of n-gram.
BUCKETS = 1 << 15
KINDS = 5
#: Added to every bucket's count before dividing.
SMOOTHING = 1.0
#: One labelled row in so many is kept for the threshold.
HELD_OUT = 5
SEED = 3
BINS, REFINEMENTS = 4096, 4

#: Classes of characters: lower case, upper case, digit, other letters, and each ASCII sign by itself.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x30:0x3A] = 0x30
_CLASS[0x41:0x5B] = 0x41
_CLASS[0x61:0x7B] = 0x61
_CLASS[0x80:] = 0x61


def _shapes(texts: Texts, words) -> np.ndarray:
    """Hash of each word's run of character classes and of its repetition."""
    classes = _CLASS[texts.data]
    keep = np.ones(len(classes), dtype=bool)
    keep[1:] = classes[1:] != classes[:-1]
    keep[words.start] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    short = classes[keep]
    shape = range_hashes(Texts(short, np.array([0, len(short)])), place[words.start], place[words.end], lower=False)
    repeats = np.zeros(len(shape), dtype=np.uint64)
    for back in (2, 1):
        same = (words.hash[back:] == words.hash[:-back]) & (words.text[back:] == words.text[:-back])
        repeats[back:][same] = back
    return mix(shape ^ repeats)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text) of every n-gram, and the number of words of each text."""
    words = find_words(texts, NON_SPACE)
    shaped = type(words)(words.start, words.end, words.text, _shapes(texts, words), words.count, words.first)
    buckets, owners = [], []
    for kind, (tokens, n) in enumerate(((words, 1), (words, 2), (shaped, 1), (shaped, 2), (shaped, 3))):
        hashes, at = grams(tokens, n)
        buckets.append((hashes & np.uint64(BUCKETS - 1)).astype(np.int64) + kind * BUCKETS)
        owners.append(tokens.text[at])
    return np.concatenate(buckets), np.concatenate(owners), words.count


@dataclass
class Model:
    """Log ratios by bucket, and the threshold from which the target is likelier than the rest."""

    ratios: np.ndarray
    threshold: float = 0.0

    def weights(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Log importance weight and number of words of each text."""
        bucket, owner, count = features(texts)
        return np.bincount(owner, weights=self.ratios[bucket], minlength=len(texts)).astype(np.float64), count


def _counted(docs: DataFrame) -> DataFrame:
    """(bucket, found) of the n-grams of ``docs`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(KINDS * BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, texts in slices(batch.column(0)):
                counts += np.bincount(features(texts)[0], minlength=len(counts))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "found"])

    return docs.mapInArrow(run, "bucket bigint, found bigint").groupBy("bucket").agg(F.sum("found").alias("found"))


def _totals(docs: DataFrame) -> np.ndarray:
    counts = np.zeros(KINDS * BUCKETS, dtype=np.int64)
    for bucket, found in _counted(docs).toLocalIterator():
        counts[bucket] = found
    return counts


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw of each bucket, smoothed within each kind of n-gram."""
    out = np.zeros(KINDS * BUCKETS)
    for kind in range(KINDS):
        part = slice(kind * BUCKETS, (kind + 1) * BUCKETS)
        q = (raw[part] + SMOOTHING) / (raw[part].sum() + SMOOTHING * BUCKETS)
        # The target is smoothed towards the raw model, so that buckets without evidence weigh nothing.
        total = target[part].sum()
        pull = max(1.0, SMOOTHING * BUCKETS)
        p = (target[part] + pull * q) / (total + pull)
        out[part] = np.log(p) - np.log(q)
    return out


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """(id, part, quality, n_words, log_weight) of ``docs`` (id, part, quality, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(3)):
                weight, count = model.weights(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k)[low:high] for k in range(3)), pa.array(count), pa.array(weight)],
                    names=["id", "part", "quality", "n_words", "log_weight"],
                )

    return docs.mapInArrow(run, "id bigint, part int, quality int, n_words bigint, log_weight double")


def best_threshold(weights: np.ndarray, good: np.ndarray) -> float:
    """The log weight that tells good from bad labelled documents best: good ones reach it."""
    if good.all() or not len(good):
        return -np.inf
    if not good.any():
        return np.inf
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    # Right answers when everything from place i on is taken as good, at places where the weight changes.
    right = np.concatenate([[0], np.cumsum(~good)]) + np.concatenate([np.cumsum(good[::-1])[::-1], [0]])
    edge = np.flatnonzero(np.concatenate([[True], weights[1:] > weights[:-1], [True]]))
    best = edge[np.argmax(right[edge])]
    if best == 0:
        return -np.inf
    return np.inf if best == len(weights) else float((weights[best - 1] + weights[best]) / 2)


def gumbel_key(row_id: Column, n_words: Column, log_weight: Column, seed: int = SEED) -> Column:
    """Log weight plus standard Gumbel noise from a hash of the id, so that reruns agree; null without words."""
    uniform = (F.pmod(F.xxhash64(F.coalesce(row_id, F.lit(-1)), row_id.isNull(), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return F.when(n_words > 0, log_weight - F.log(-F.log(uniform)))


def top_k_edge(keys: DataFrame, k: int, bins: int = BINS, refinements: int = REFINEMENTS) -> float:
    """The smallest of the k largest values of column ``key``, to the width of the last bins; equal values stay together.

    Each round counts the values in at most ``bins`` bins of the open interval and goes on with the bin that holds the
    k-th, so the driver sees ``bins`` counts and no rows.
    """
    span = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k <= 0 or not span[2]:
        return float("inf")
    if k >= span[2]:
        return float("-inf")
    low, high, above = span[0], span[1], 0
    for _ in range(refinements):
        width = (high - low) / bins
        if width <= 0 or low + width <= low:
            break
        place = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
        counts = keys.where((F.col("key") >= F.lit(low)) & (F.col("key") <= F.lit(high))).groupBy(place.alias("bin")).count().collect()
        for number, found in sorted(((r[0], r[1]) for r in counts), reverse=True):
            if above + found >= k:
                low, high = low + number * width, min(high, low + (number + 1) * width)
                break
            above += found
    return low


def fitted(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_id: str = "doc_id", quality_column: str = "quality", labelled_rows: int = LABELLED_ROWS, seed: int = SEED) -> tuple[Model, DataFrame, float]:
    """The model, the scores of all rows (written), and the smallest key that stays."""
    chosen = labels.where(F.col(label_id).isNotNull() & F.col(quality_column).isNotNull()).groupBy(F.col(label_id).cast("bigint").alias("label_of")).agg(
        F.max(F.col(quality_column).cast("int")).alias("quality")
    )
    order = F.xxhash64("label_of", F.lit(seed))
    chosen = cut_lineage(chosen.orderBy(order, "label_of").limit(labelled_rows))
    part = F.when(F.pmod(F.xxhash64("label_of", F.lit(seed + 1)), F.lit(HELD_OUT)) == 0, 2).when(F.col("quality") == 1, 1).otherwise(0)
    chosen = chosen.withColumn("part", part.cast("int"))
    rows = small_batches(docs).select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    texts = rows.select("text")
    rows = rows.join(F.broadcast(chosen), F.col("id") == F.col("label_of"), "left")
    # Rows that repeat a labelled id enlarge neither the target's counts nor the sample of the threshold.
    good = cut_lineage(rows.where("part = 1").groupBy("id").agg(F.max("text").alias("text")))
    raw, target = (_totals(df) for df in (texts, good.select("text")))
    model = Model(log_ratios(raw, target).astype(np.float32))
    scores = cut_lineage(_scored(rows.select("id", "part", "quality", "text"), model).withColumn("key", gumbel_key(F.col("id"), F.col("n_words"), F.col("log_weight"), seed)))
    held = scores.where("part = 2 and n_words > 0").groupBy("id").agg(F.max("log_weight"), F.max("quality")).drop("id").collect()
    model.threshold = best_threshold(np.array([r[0] for r in held], dtype=float), np.array([r[1] == 1 for r in held], dtype=bool))
    k = scores.where((F.col("log_weight") >= F.lit(model.threshold)) & (F.col("n_words") > 0)).count()
    return model, scores, top_k_edge(scores, k)


def resampled(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, log_weight, key, kept) of every row of ``docs``.

    Rows without words are rejected. A null label or id of a label is left out; of several labels of one id the largest
    counts; of several texts of one labelled id the greatest counts, and its largest weight; without labels, or without bad ones, every row with words is kept. Rows without id share one noise, as do
    repeated rows, which are decided alike; rows with equal keys at the cut stay together. Very long texts are scored
    whole. Only the named columns are read. No rows give no rows. Runs jobs while it builds its result.
    """
    _, scores, edge = fitted(docs, labels, **options)
    kept = F.coalesce(F.col("key") >= F.lit(edge), F.lit(False))
    return scores.select(F.col("id").alias("doc_id"), "n_words", "log_weight", "key", kept.alias("kept"))


def resampled_rows(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``resampled`` keeps, with all their columns.

    Each row is scored again where it is read, so that no text is shuffled or joined.
    """
    model, _, edge = fitted(docs, labels, id_column=id_column, text_column=text_column, **options)
    seed = options.get("seed", SEED)
    schema = docs.schema
    at = schema.names.index(text_column)
    names = [f"{uuid.uuid4().hex}_{name}" for name in ("log_weight", "n_words")]  # no given column has such a name
    wider = StructType([*schema.fields, StructField(names[0], DoubleType()), StructField(names[1], LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(at)):
                weight, count = model.weights(texts)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(weight), pa.array(count)], names=wider.names)

    key = gumbel_key(F.col(id_column).cast("bigint"), F.col(names[1]), F.col(names[0]), seed)
    return docs.mapInArrow(run, wider).where(F.coalesce(key >= F.lit(edge), F.lit(False))).drop(*names)
