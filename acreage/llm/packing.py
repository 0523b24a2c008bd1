"""Token ids packed into sequences of one length (operator 1).

Documents are tokenised where they are read and never shuffled. A document longer than a sequence is split into full
pieces and a rest, losslessly; the pieces of a block of bounded size are packed by best fit decreasing: longest first,
each into the sequence with the least room that still holds it, found by a segment tree over capacities. A task packs
one block after another, so its memory does not grow with its input, and a lost task is simply run again.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.llm.shared import small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how that vocabulary cuts texts into pieces before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: ends every document; free in that vocabulary.
END_OF_TEXT = 50256
LENGTH = 2048
#: Tokens that a task holds before it packs them.
BLOCK_TOKENS = 4_000_000

SCHEMA = (
    "shard int, sequence bigint, n_tokens int, ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<bigint>, pieces array<int>, last array<boolean>"
)


def read_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> bytes:
    """The vocabulary file (about 1 MB): from the driver's disk, else by Spark from wherever the path points."""
    if os.path.exists(path):
        with open(path, "rb") as file:
            return file.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def encoder(vocabulary: bytes):
    """The tokenizer of a rank file; a task builds it once."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Capacities:
    """A segment tree over capacities 0 to ``most``: a leaf counts the open sequences with that much room."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, needed: int) -> tuple[int, int]:
        """(room, sequence) with the least room of at least ``needed``, or (-1, -1)."""
        node = needed + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return -1, -1
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], length: int) -> list[list[int]]:
    """Numbers of the pieces in each sequence; no piece is longer than ``length``."""
    sequences: list[list[int]] = []
    rooms = Capacities(length)
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room, sequence = rooms.take(lengths[piece])
        if sequence < 0:
            room, sequence = length, len(sequences)
            sequences.append([])
        sequences[sequence].append(piece)
        if room > lengths[piece]:
            rooms.add(room - lengths[piece], sequence)
    return sequences


class _Block:
    """Pieces of whole documents: tokens, document ids, piece numbers and whether a piece is the last."""

    def __init__(self, length: int, dtype: str):
        self.length, self.dtype = length, dtype
        self.clear()

    def clear(self) -> None:
        self.tokens, self.ids, self.numbers, self.last, self.held = [], [], [], [], 0

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        for number, low in enumerate(range(0, len(tokens), self.length)):
            self.tokens.append(tokens[low : low + self.length])
            self.ids.append(doc_id)
            self.numbers.append(number)
            self.last.append(low + self.length >= len(tokens))
        self.held += len(tokens)

    def packed(self, shard: int, first: int, pad: int) -> pa.RecordBatch:
        sequences = best_fit_decreasing([len(t) for t in self.tokens], self.length)
        rows: list[list] = [[] for _ in range(9)]
        for number, pieces in enumerate(sequences):
            matrix = np.full(self.length, pad, dtype=self.dtype)
            positions = np.zeros(self.length, dtype=self.dtype)
            ends = [0]
            for piece in pieces:
                low, high = ends[-1], ends[-1] + len(self.tokens[piece])
                matrix[low:high] = self.tokens[piece]
                positions[low:high] = np.arange(high - low)
                ends.append(high)
            values = (
                shard, first + number, ends[-1], matrix.tobytes(), positions.tobytes(), ends,
                [self.ids[p] for p in pieces], [self.numbers[p] for p in pieces], [self.last[p] for p in pieces],
            )
            for column, value in zip(rows, values, strict=True):
                column.append(value)
        kinds = (
            pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()),
            pa.list_(pa.int32()), pa.list_(pa.bool_()),
        )
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)


def packed_sequences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY, length: int = LENGTH, end_of_text: int = END_OF_TEXT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for each packed sequence of ``length`` tokens.

    ids and position_ids are little-endian unsigned integers (16 bit, or 32 bit for larger ids or lengths), padded with
    the end-of-text id and position 0 after n_tokens; cu_seqlens holds the segment bounds from 0 to n_tokens, where
    positions reset; doc_ids, pieces and last say which piece of which document a segment is. Every document ends with
    the end-of-text id. Null and empty texts give no segment; a null id is kept as null; repeated rows are packed as
    often as they are given; a very long text is split like any other. No other column is read. No rows give no rows.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(read_vocabulary(spark, vocabulary))
    dtype = "<u2" if max(end_of_text, length) < 1 << 16 and sent.value.count(b"\n") <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(sent.value).encode_to_numpy
        context = TaskContext.get()
        shard, first = (context.partitionId() if context else 0), 0
        block = _Block(length, dtype)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if text.is_valid and (value := text.as_py()):
                    block.add(doc_id, np.append(encode(value, disallowed_special=()), end_of_text).astype(dtype))
                if block.held >= block_tokens:
                    out = block.packed(shard, first, end_of_text)
                    first += out.num_rows
                    yield from (out.slice(i, 512) for i in range(0, out.num_rows, 512))
                    block.clear()
        if block.tokens:
            out = block.packed(shard, first, end_of_text)
            yield from (out.slice(i, 512) for i in range(0, out.num_rows, 512))

    rows = small_batches(docs).select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, SCHEMA)
