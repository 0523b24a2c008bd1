"""Operator 3: held-out labels, the ratio, the cut."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreage.llm.resampling import best_threshold, log_ratios, resampled, resampled_rows, top_k_edge
from tests.llm.conftest import frame, with_clashes


def _corpus(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(8, 80))]
        bad = i % 5 == 0
        rows.append((i, "s", " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(not bad), "x"))
    return rows, labels


def test_unlabelled_documents(spark):
    rows, labels = _corpus(1, 400)
    df, known = with_clashes(spark, rows), frame(spark, labels, "doc_id bigint, quality int, text string")
    got = {r["doc_id"]: r["kept"] for r in resampled(df, known).collect()}
    assert got == {i: i % 5 != 0 for i in range(400)}
    kept = resampled_rows(df, known)
    assert kept.columns == df.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [i for i in range(400) if i % 5]


def test_small_table_keeps_clean_documents(spark, documents, labels):
    got = resampled(documents, labels).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    counts = {(r[0], r[1]): r[2] for r in got}
    assert counts.get((1, False), 0) <= 0.03 * counts[1, True]
    assert counts.get((0, True), 0) <= 0.5 * sum(n for (q, _), n in counts.items() if q == 0)


def test_edges(spark):
    rows = [(1, "s", None), (2, "s", ""), (None, "s", "some words"), (3, "s", "a"), (3, "s", "a"), (4, "s", "b " * 30_000)]
    none = frame(spark, [], "doc_id bigint, quality int")
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in resampled(with_clashes(spark, rows), none).collect()) == [
        (0, True), (1, False), (2, False), (3, True), (3, True), (4, True)
    ]
    odd = frame(spark, [(None, 1), (3, None), (4, 1), (4, 0)], "doc_id bigint, quality int")
    assert resampled(with_clashes(spark, rows), odd).where("kept").count() == 4
    assert resampled(with_clashes(spark, []), odd).count() == 0
    assert resampled_rows(with_clashes(spark, []), none).count() == 0


def test_reruns_agree(spark):
    rows, labels = _corpus(2, 100)
    known = frame(spark, labels, "doc_id bigint, quality int, text string")
    one, two = (sorted(map(str, resampled(with_clashes(spark, rows).repartition(n), known).collect())) for n in (2, 5))
    assert one == two


@pytest.mark.parametrize("k", [0, 1, 7, 99, 100, 500])
def test_top_k_edge(spark, k):
    draw = random.Random(k)
    values = [draw.gauss(0, 1) for _ in range(98)] + [5.0, 5.0]
    df = frame(spark, [(v,) for v in [*values, None]], "key double")
    edge = top_k_edge(df, k, bins=8, refinements=30)
    kept = df.where(F.col("key") >= F.lit(edge)).count()
    assert kept == (2 if k == 1 else min(k, 100))


def test_ratios_and_threshold():
    raw = np.zeros(5 * (1 << 15), dtype=np.int64)
    target = raw.copy()
    raw[:4], target[:2] = (100, 100, 100, 100), (50, 50)
    ratios = log_ratios(raw, target)
    assert ratios[0] > ratios[4] >= ratios[2] and ratios[0] > 0 and ratios[4] == pytest.approx(0, abs=0.01)
    assert best_threshold(np.array([1.0, 2.0, 3.0, 4.0]), np.array([False, False, True, True])) == 2.5
    assert best_threshold(np.array([1.0]), np.array([True])) == -np.inf and best_threshold(np.array([1.0]), np.array([False])) == np.inf


def test_repeated_labelled_rows_weigh_once(spark):
    rows, labels = _corpus(4, 200)
    known = frame(spark, labels, "doc_id bigint, quality int, text string")
    good = next(r for r in rows if r[0] % 5 and r[0] % 2 == 0)
    many = with_clashes(spark, [*rows, *[good] * 600])
    got = resampled(many, known).groupBy("doc_id", "kept").count().collect()
    assert {r["doc_id"]: r["kept"] for r in got} == {i: i % 5 != 0 for i in range(200)}
    assert len(got) == 200 and {r["count"] for r in got} == {1, 601}
