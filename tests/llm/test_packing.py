"""Operator 1: exact round trip, and fits that are best and decreasing."""

import random

import numpy as np
import pytest

from acreage.llm.packing import END_OF_TEXT, VOCABULARY, best_fit_decreasing, encoder, packed_sequences
from tests.llm.conftest import with_clashes


def _documents(rows, length):
    """{doc_id: tokens} and checks of every packed row."""
    parts = {}
    for r in rows:
        ids, positions = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2")
        ends = r["cu_seqlens"]
        assert len(ids) == len(positions) == length and ends[0] == 0 and ends[-1] == r["n_tokens"] <= length
        assert (ids[ends[-1] :] == END_OF_TEXT).all() and not positions[ends[-1] :].any()
        for i, (doc, piece, last) in enumerate(zip(r["doc_ids"], r["pieces"], r["last"], strict=True)):
            low, high = ends[i], ends[i + 1]
            assert (positions[low:high] == np.arange(high - low)).all() and high > low
            assert last or high - low == length
            parts.setdefault(doc, []).append((piece, ids[low:high].tolist()))
    return {d: [t for _, p in sorted(held) for t in p] for d, held in parts.items()}


@pytest.mark.parametrize("length", [64, 2048])
def test_round_trip(spark, documents, texts, length):
    with open(VOCABULARY, "rb") as file:
        encode = encoder(file.read()).encode_ordinary
    rows = packed_sequences(documents, length=length, block_tokens=50_000).collect()
    got = _documents(rows, length)
    assert got == {d: [*encode(t), END_OF_TEXT] for d, _, t in texts}
    filled = sum(r["n_tokens"] for r in rows) / (length * len(rows))
    assert filled > 0.95
    assert len({(r["shard"], r["sequence"]) for r in rows}) == len(rows)


def test_edges(spark):
    rows = [(1, "s", None), (2, "s", ""), (3, "s", "word " * 9_000), (None, "s", "no id"), (5, "s", "<|endoftext|>"), (6, "s", "same"), (6, "s", "same")]
    got = packed_sequences(with_clashes(spark, rows)).collect()
    held = [d for r in got for d in r["doc_ids"]]
    assert set(held) == {3, None, 5, 6} and held.count(6) == 2
    assert packed_sequences(with_clashes(spark, [])).count() == 0


def test_best_fit_decreasing_against_a_plain_search():
    draw = random.Random(1)
    for _ in range(50):
        length = draw.choice((1, 2, 7, 64, 100))
        lengths = [draw.randrange(1, length + 1) for _ in range(draw.randrange(0, 120))]
        got = best_fit_decreasing(lengths, length)
        assert sorted(p for s in got for p in s) == list(range(len(lengths)))
        rooms = []
        for piece in sorted(lengths, reverse=True):
            fits = [r for r in rooms if r >= piece]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - piece)
            else:
                rooms.append(length - piece)
        assert sorted(length - sum(lengths[p] for p in s) for s in got) == sorted(rooms)
