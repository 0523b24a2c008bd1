"""Operator 5 against sets of all windows."""

import random

import pyarrow as pa
import pytest

from acreage.llm.decontamination import Patterns, benchmark_hits, contamination_digest, decontaminated
from acreage.llm.words import ALPHANUMERIC, find_words, texts_of
from tests.llm.brute import contamination
from tests.llm.conftest import SMALL, frame, with_clashes

COLUMNS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def _got(df):
    return {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in contamination_digest(df).collect()}


def test_whole_small_table(spark, documents, texts):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = contamination([(d, t) for d, _, t in texts], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert any(w[4] for w in want.values())
    assert _got(benchmark_hits(documents, items)) == want


def _tables(spark):
    draw = random.Random(2)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(n))) for i, n in enumerate((1, 2, 3, 5, 12, 13, 14, 30, 40))]
    items += [(100, "V3, v4; v3?"), (100, "v9 v9"), (101, "..."), (102, None), (None, "v1 v1"), (103, "É漢 x"), (7, items[7][1])]
    docs = []
    for i in range(60):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(0, 90))]
        if i % 3 == 0:
            words[5:5] = draw.choice(items[:9])[1].upper().split()
        docs.append((i, "s", draw.choice((" ", "-", ".\n")).join(words)))
    docs += [(1000, "s", None), (1001, "s", ""), (1002, "s", "a É漢!x b"), (1003, "s", "v5 " * 40_000 + items[8][1])]
    return with_clashes(spark, docs), docs, items, frame(spark, [(*x, 1) for x in items], "item_id bigint, text string, doc_id int")


@pytest.mark.parametrize("portion", [1 << 20, 60])
def test_short_items_overlaps_and_portions(spark, portion):
    df, docs, items, benchmark = _tables(spark)
    want = contamination([(d, t) for d, _, t in docs], items)
    assert _got(benchmark_hits(df, benchmark, portion_bytes=portion)) == want
    kept = decontaminated(df, benchmark, portion_bytes=portion)
    assert kept.columns == df.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(d for d, w in want.items() if not w[4])


def test_repeated_rows_and_empty_tables(spark):
    df, docs, items, benchmark = _tables(spark)
    twice = benchmark_hits(df.union(df), benchmark)
    assert twice.count() == 2 * len(docs)
    assert benchmark_hits(df.limit(0), benchmark).count() == 0
    nothing = _got(benchmark_hits(df, benchmark.limit(0)))
    assert all(w[1:3] == (0, 0) and not w[4] for w in nothing.values())
    nameless = with_clashes(spark, [(None, None, "v1 v1"), (None, None, None)])
    assert benchmark_hits(nameless, benchmark).count() == 2


def test_shifts_never_pass_an_occurrence():
    draw = random.Random(9)
    for _ in range(30):
        words = [f"{draw.randrange(4)}" for _ in range(200)]
        start = draw.randrange(180)
        held = Patterns([("a", " ".join(words[start : start + 15]))])
        texts = texts_of(pa.array([" ".join(words)]))
        first, end, _ = held.find(texts, find_words(texts, ALPHANUMERIC))
        assert start in first.tolist() and start + 2 in first.tolist()
        for low, high in zip(first.tolist(), end.tolist(), strict=True):
            assert any(words[low:high] == words[start + k : start + k + 13] for k in range(3))
