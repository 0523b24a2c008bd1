"""Spelling variants of words, one edit apart (operator 12).

Words are vectors of letter counts. One replaced letter puts two words at a squared distance of two, one inserted or
deleted letter at one, so the Gram matrix of a block of words, one NumPy product, tells which pairs of equal or adjacent
lengths can be near; only these are compared letter by letter.

Blocks come from the same counts. The alphabet is cut into four parts of about equal use. One edit touches two letters at
most, so near words agree in all counts of at least two parts; each word goes into the six blocks of its counts in two of
the four parts, and a pair is taken from the first block that it shares. Blocks are sorted within partitions and streamed
through tiles. A block of very many words is dealt over buckets by a hash, and every pair of buckets is a block of its
own, so no task holds more than two buckets at once and no pair is left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.shared import cut_lineage, small_batches
from acreage.llm.words import LOWER_ASCII, Texts, gathered, mix, range_hashes, slices, texts_of
from acreage.session import broadcast_counted

#: A run whose checksum this divides loses a code point.
DIVISOR = 31
#: Fewest code points and occurrences of a word; how many times as frequent a word's form is.
LENGTH, LEAST, RATIO = 7, 2, 10
#: Parts of the alphabet; near words agree in all but two.
PARTS = 4
KEYS = list(combinations(range(PARTS), PARTS - 2))
#: Cuts of the other letters in a large block.
CUTS = 3
#: Most words of a block that is not cut further, and of a narrower one that is not dealt over buckets; rows of a Gram
#: matrix; rows that are gathered before their blocks are worked on.
BLOCK, BUCKET, TILE, GATHERED = 512, 2048, 256, 16_384
#: Runs and words of up to so many letters are worked on together, longer ones one by one.
SHORT = 64
#: a-z, then U+00C0 to U+00FF.
LETTERS = 26 + 64

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = True
_LETTER[0x61:0x7B] = True
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF, and of nothing else
_CODES = mix(np.arange(LETTERS, dtype=np.uint64) + np.uint64(0x1F83D9ABFB41BD6B))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """crc32 of byte ranges, each going on from a seed."""
    out = seeds.astype(np.uint32)
    sizes = end - start
    for i in np.flatnonzero(sizes > SHORT):
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(seeds[i]))
    order = np.flatnonzero(sizes <= SHORT)
    order = order[np.argsort(-sizes[order], kind="stable")]
    begin, state = start[order], ~out[order]
    active = len(order) - np.cumsum(np.bincount(sizes[order], minlength=SHORT + 1))
    for p in range(SHORT):
        k = int(active[p])
        if not k:
            break
        state[:k] = _CRC[(state[:k] ^ data[begin[:k] + p]) & 0xFF] ^ (state[:k] >> 8)
    out[order] = ~state
    return out


def _runs(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of maximal runs of letters."""
    data = texts.data
    lead = data == _LEAD
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[texts.offsets] = True
    before = np.concatenate([[False], inside])
    after = np.concatenate([inside, [False]])
    start = np.flatnonzero(inside & (~before[:-1] | edge[:-1]))
    end = np.flatnonzero(inside & (~after[1:] | edge[1:])) + 1
    return start, end


def _words(texts: Texts, ids: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of the texts after deletions, and how often each occurs; only those that are long enough."""
    start, end = _runs(texts)
    heads = np.zeros(len(texts.data) + 1, dtype=np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=heads[1:])
    length = heads[end] - heads[start]
    enough = length >= LENGTH
    start, end, length = start[enough], end[enough], length[enough]
    owner = np.searchsorted(texts.offsets, start, side="right") - 1
    seeds = np.zeros(len(texts), dtype=np.uint32)
    for i in np.unique(owner):
        seeds[i] = zlib.crc32(f"{ids[i]}:".encode())
    lowered = LOWER_ASCII[texts.data]
    sums = checksums(lowered, start, end, seeds[owner])
    shorter = sums % DIVISOR == 0
    changed: dict[str, int] = {}
    for i in np.flatnonzero(shorter & (length > LENGTH)):
        run = lowered[start[i] : end[i]].tobytes().decode()
        place = int(sums[i]) % len(run)
        run = run[:place] + run[place + 1 :]
        changed[run] = changed.get(run, 0) + 1
    start, end = start[~shorter], end[~shorter]
    _, at, n = np.unique(range_hashes(texts, start, end), return_index=True, return_counts=True)
    sizes = (end - start)[at]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    held = np.ascontiguousarray(lowered[gathered(start[at], sizes)])
    plain = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(held))
    words = pa.concat_arrays([plain, pa.array(list(changed), pa.large_string())])
    return words, np.concatenate([n, np.array(list(changed.values()), dtype=np.int64)])


def counted_words(docs: DataFrame) -> DataFrame:
    """(word, n) of ``docs`` (id as text, text): words that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, high, texts in slices(batch.column(1)):
                words, n = _words(texts, ids[low:high])
                yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(n.astype(np.int64))], names=["word", "n"])

    found = docs.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= LEAST)


def _letters(words: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all letters (0 to LETTERS - 1) of the words, and each word's offset among them."""
    texts = texts_of(words)
    lead = texts.data == _LEAD
    second = np.concatenate([[False], lead[:-1]])
    letter = np.where(second, texts.data.astype(np.int16) - 0x80 + 26, texts.data.astype(np.int16) - 0x61)[~lead]
    place = np.concatenate([[0], np.cumsum(~lead)])
    return letter, place[texts.offsets]


@dataclass(frozen=True)
class Alphabet:
    """The part of each letter, and of each choice of parts the cut of each other letter (else -1)."""

    part: np.ndarray
    cuts: np.ndarray


def _dealt(use: np.ndarray, letters: np.ndarray, ways: int) -> np.ndarray:
    """Letters by falling use, each to the way that is used least so far; -1 for letters that are not named."""
    way, held = np.full(LETTERS, -1), np.zeros(ways, dtype=np.int64)
    for letter in letters[np.argsort(-use[letters], kind="stable")]:
        way[letter] = np.argmin(held)
        held[way[letter]] += use[letter] + 1
    return way


def _alphabet(words: DataFrame) -> Alphabet:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_letters(batch.column(0))[0], minlength=LETTERS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LETTERS)), pa.array(total)], names=["letter", "n"])

    use = np.zeros(LETTERS, dtype=np.int64)
    for letter, n in words.select("word").mapInArrow(run, "letter bigint, n bigint").groupBy("letter").agg(F.sum("n")).collect():
        use[letter] = n
    part = _dealt(use, np.arange(LETTERS), PARTS)
    return Alphabet(part, np.stack([_dealt(use, np.flatnonzero(~np.isin(part, key)), CUTS) for key in KEYS]))


def _sums(letter: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each word's counts of those letters that ``counts`` marks; equal counts give equal sums."""
    running = np.zeros(len(letter) + 1, dtype=np.uint64)
    np.cumsum(np.where(counts, _CODES[letter], np.uint64(0)), out=running[1:])
    return running[offsets[1:]] - running[offsets[:-1]]


def _keyed(words: DataFrame, alphabet: Alphabet) -> DataFrame:
    """(word, n, keys): a hash of the word's counts in each choice of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letter, offsets = _letters(batch.column(0))
            sums = [_sums(letter, offsets, alphabet.part[letter] == p) for p in range(PARTS)]
            keys = np.stack([mix(sum((mix(sums[p] + np.uint64(p)) for p in key), np.uint64(k))) for k, key in enumerate(KEYS)], axis=1)
            held = pa.ListArray.from_arrays(
                pa.array(np.arange(len(batch) + 1, dtype=np.int32) * len(KEYS)), pa.array(keys.reshape(-1).view(np.int64))
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, held], names=["word", "n", "keys"])

    return words.mapInArrow(run, "word string, n bigint, keys array<bigint>")


def _narrowed(rows: DataFrame, alphabet: Alphabet) -> DataFrame:
    """(block, choice, cut, word, n): each row of a large block once for each cut of its other letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letter, offsets = _letters(batch.column(2))
            block, choice = np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(1))
            cuts = alphabet.cuts[np.repeat(choice, np.diff(offsets)), letter]
            for cut in range(CUTS):
                key = mix(block ^ mix(_sums(letter, offsets, cuts == cut) + np.uint64(cut)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), batch.column(1), pa.array(np.full(len(batch), cut, dtype=np.int32)), batch.column(2), batch.column(3)],
                    names=["block", "choice", "cut", "word", "n"],
                )

    return rows.select("block", "choice", "word", "n").mapInArrow(run, "block bigint, choice int, cut int, word string, n bigint")


def _large(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with ``size``, the rows of the block where that is more than ``most``, else null."""
    sizes = cut_lineage(rows.groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > most).withColumnRenamed("block", "large"))
    return rows.join(broadcast_counted(sizes), F.col("block") == F.col("large"), "left").drop("large")


def _blocks(keyed: DataFrame, alphabet: Alphabet, block: int, bucket: int) -> DataFrame:
    """(block, choice, cut, side, word, n): side 2 meets all of its block, sides 0 and 1 only each other; cut -1 is no cut."""
    names = ["block", "choice", "cut", "side", "word", "n"]
    rows = _large(keyed.select("word", "n", F.posexplode("keys").alias("choice", "block")), block)
    small = rows.where("size is null").withColumn("cut", F.lit(-1)).withColumn("side", F.lit(2))
    narrow = _large(cut_lineage(_narrowed(rows.where("size is not null"), alphabet)), bucket)
    one = narrow.where("size is null").withColumn("side", F.lit(2))
    many = narrow.where("size is not null").withColumn("buckets", F.ceil(F.col("size") / bucket).cast("int"))
    many = many.withColumn("own", F.pmod(F.xxhash64("word"), F.col("buckets")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, buckets - 1)")))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    pair = F.xxhash64("block", F.least("own", "other"), F.greatest("own", "other"))
    many = many.withColumn("block", pair).withColumn("side", side)
    return small.select(*names).unionByName(one.select(*names)).unionByName(many.select(*names))


def _one_edit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two letter arrays of equal length, or of which ``b`` is longer by one, differ by one edit."""
    differ = np.flatnonzero(a != b[: len(a)])
    if len(a) == len(b):
        return len(differ) == 1
    return not len(differ) or bool((a[differ[0] :] == b[differ[0] + 1 :]).all())


class _Chunk:
    """Rows of some whole blocks, in order of block."""

    def __init__(self, rows: pa.Table, alphabet: Alphabet):
        self.block = np.asarray(rows.column("block").combine_chunks())
        self.choice = np.asarray(rows.column("choice").combine_chunks())
        self.cut = np.asarray(rows.column("cut").combine_chunks())
        self.side = np.asarray(rows.column("side").combine_chunks())
        self.letter, offsets = _letters(rows.column("word"))
        self.first, self.size = offsets[:-1], np.diff(offsets)
        self.alphabet = alphabet
        n = len(rows)
        # Squared lengths must be whole numbers in the type that is multiplied.
        kind = np.float32 if not n or self.size.max() <= 4000 else np.float64
        cell = np.repeat(np.arange(n), self.size) * LETTERS + self.letter
        self.counts = np.bincount(cell, minlength=n * LETTERS).reshape(n, LETTERS).astype(kind)
        self.norm = np.einsum("ij,ij->i", self.counts, self.counts)
        self.last = np.searchsorted(self.block, self.block, side="right")
        # Hashes of the two halves of a word, and of those that its partner has if that is shorter by one.
        held = Texts(self.letter.astype(np.uint8), offsets)
        self.halves = []
        for size in (self.size, self.size - 1):
            half, rest = size // 2, size - size // 2
            self.halves.append((
                range_hashes(held, self.first, self.first + half, lower=False), range_hashes(held, offsets[1:] - rest, offsets[1:], lower=False)
            ))

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(i, j), j the longer or later one, whose counts are one or two apart, from tiles of Gram matrices."""
        for low in range(0, len(self.block), TILE):
            high = min(low + TILE, len(self.block))
            end = int(self.last[high - 1])
            gram = self.counts[low:high] @ self.counts[low:end].T
            square = self.norm[low:high, None] + self.norm[None, low:end] - 2 * gram
            i, j = np.nonzero((square > 0.5) & (square < 2.5))
            i, j = i + low, j + low
            apart = self.size[j] - self.size[i]
            square = square[i - low, j - low]
            near = (j > i) & (self.block[i] == self.block[j]) & np.where(apart == 0, square > 1.5, (np.abs(apart) == 1) & (square < 1.5))
            near &= (self.side[i] == 2) | (self.side[i] != self.side[j])
            i, j = i[near], j[near]
            swap = self.size[i] > self.size[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            # One edit leaves one half of the shorter word as it is.
            equal = self.size[i] == self.size[j]
            (head, tail), (other_head, other_tail) = self.halves
            half = head[i] == np.where(equal, head[j], other_head[j])
            half |= tail[i] == np.where(equal, tail[j], other_tail[j])
            yield i[half], j[half]

    def first_shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the block is the first that the pair shares."""
        differs = self.counts[i] != self.counts[j]
        same = np.stack([~differs[:, self.alphabet.part == p].any(axis=1) for p in range(PARTS)], axis=1)
        shared = np.stack([same[:, list(key)].all(axis=1) for key in KEYS], axis=1)
        first = np.argmax(shared, axis=1) == self.choice[i]
        cut = self.alphabet.cuts[self.choice[i]]
        alike = np.stack([~(differs & (cut == k)).any(axis=1) for k in range(CUTS)], axis=1)
        return first & ((self.cut[i] < 0) | (np.argmax(alike, axis=1) == self.cut[i]))

    def _aligned(self, rows: np.ndarray, width: int, right: bool) -> np.ndarray:
        out = np.full((len(rows), width), 255, dtype=np.uint8)
        size = self.size[rows]
        column = gathered(np.zeros(len(rows), dtype=np.int64), size)
        if right:
            column = column + np.repeat(width - size, size)
        out[np.repeat(np.arange(len(rows)), size), column] = self.letter[gathered(self.first[rows], size)]
        return out

    def one_edit(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether each pair is one edit apart; j is not the shorter one."""
        out = np.zeros(len(i), dtype=bool)
        long = self.size[j] > SHORT
        for k in np.flatnonzero(long):
            a, b = (self.letter[self.first[r] : self.first[r] + self.size[r]] for r in (i[k], j[k]))
            out[k] = _one_edit(a, b)
        rest = np.flatnonzero(~long)
        for low in range(0, len(rest), 1 << 16):
            at = rest[low : low + (1 << 16)]
            width = int(self.size[j[at]].max())
            ahead = self._aligned(i[at], width, False) != self._aligned(j[at], width, False)
            back = self._aligned(i[at], width, True) != self._aligned(j[at], width, True)
            equal = self.size[i[at]] == self.size[j[at]]
            # Letters that agree from the left, and from the right.
            left, right = np.argmax(ahead, axis=1), np.argmax(back[:, ::-1], axis=1)
            out[at] = np.where(equal, ahead.sum(axis=1) == 1, left + right >= self.size[i[at]])
        return out


def _near(blocks: DataFrame, alphabet: Alphabet) -> DataFrame:
    """(word, other, other_n) of every near pair, in both directions; ``blocks`` are sorted within partitions."""
    names = ["word", "other", "other_n"]

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        block = np.asarray(rows.column("block").combine_chunks())
        alone = np.ones(len(block), dtype=bool)
        alone[1:] &= block[1:] != block[:-1]
        alone[:-1] &= block[1:] != block[:-1]
        rows = rows.filter(pa.array(~alone)).combine_chunks()
        if not len(rows):
            return
        chunk = _Chunk(rows, alphabet)
        word, n = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
        for i, j in chunk.candidates():
            hit = chunk.one_edit(i, j)
            i, j = i[hit], j[hit]
            hit = chunk.first_shared(i, j)
            one, two = pa.array(np.concatenate([i[hit], j[hit]])), pa.array(np.concatenate([j[hit], i[hit]]))
            yield pa.RecordBatch.from_arrays([word.take(one), word.take(two), n.take(two)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            if len(rows) < GATHERED:
                continue
            # The last block may go on in the next batch.
            block = np.asarray(batch.column(0))
            start = len(rows) - len(batch) + int(np.flatnonzero(block == block[-1])[0])
            if start == len(rows) - len(batch) and len(held) > 1:
                every = np.asarray(rows.column(0).combine_chunks())
                start = int(np.searchsorted(every, every[-1]))
            if start:
                yield from pairs(rows.slice(0, start))
                held = rows.slice(start).to_batches()
        if held:
            yield from pairs(pa.Table.from_batches(held))

    return blocks.mapInArrow(run, "word string, other string, other_n bigint")


def _roots(base: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form, by doubling the steps until none is left."""
    up = cut_lineage(base.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        step = up.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = cut_lineage(up.join(step, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        up = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return up


def variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least seven code points and two occurrences.

    A null text has no words; a null id is written as nothing before the colon. Repeated rows are counted as often as
    they are given. Of equally frequent near words the first in code-point order is the form. Runs and words of any length are
    taken whole. Tables without such words give no rows. Only the named columns are read. Runs jobs while it builds its
    result: words, near words and steps to roots are written to the shared folder.
    """
    rows = small_batches(docs).select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).alias("text"))
    words = cut_lineage(counted_words(rows))
    alphabet = _alphabet(words)
    keyed = cut_lineage(_keyed(words, alphabet))
    blocks = _blocks(keyed, alphabet, block, bucket).repartition("block").sortWithinPartitions("block")
    # A word's own row has no other; all rows of a word meet in one aggregation.
    every = _near(blocks, alphabet).withColumn("own", F.lit(None).cast("bigint")).unionByName(
        words.select("word", F.lit(None).cast("string").alias("other"), F.lit(None).cast("bigint").alias("other_n"), F.col("n").alias("own"))
    )
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))))
    found = every.groupBy("word").agg(F.max("own").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
    far = -F.col("best.less") >= RATIO * F.col("n")
    base = cut_lineage(found.select(
        "word", F.when(far, F.col("best.other")).alias("form"), "n", "n_near", F.when(far, -F.col("best.less")).alias("form_n")
    ))
    roots = _roots(base)
    return base.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
