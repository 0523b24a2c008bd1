"""Independent draws with replacement, and information of columns with missing values."""

import math
import random

import pytest

from acreage.operators import features, splits


def _drawn(spark, rows, schema="id bigint, weight double", parts=2, **options):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    return {r["id"]: r["draws"] for r in splits.independent_draws(df, "id", **options).collect()}


def test_independent_draws_follow_the_weights(spark):
    rows = [(k, 30.0 if k == 0 else 1.0 + k % 3) for k in range(40)]
    total = sum(w for _, w in rows)
    chi = []
    for seed in range(6):
        got = _drawn(spark, rows, factor=25.0, seed=seed)
        assert sum(got.values()) == 1_000
        chi.append(sum((got[k] - 1_000 * w / total) ** 2 / (1_000 * w / total) for k, w in rows))
    # 39 degrees of freedom each; systematic draws would stay far below.
    assert 39 - 6 * math.sqrt(78 / 6) < sum(chi) / 6 < 39 + 6 * math.sqrt(78 / 6) and len(set(chi)) == 6


def test_independent_draws_agree_again_and_spread_a_heavy_row(spark):
    rows = [(k, 1e6 if k == 3 else 0.1 + k) for k in range(50)]
    one, two = _drawn(spark, rows, factor=2_000.0), _drawn(spark, rows[::-1], factor=2_000.0, parts=5)
    assert one == two and sum(one.values()) == 100_000 and one[3] > 99_000


@pytest.mark.parametrize("rows, factor, want", [
    ([], 2.0, {}), ([(1, None), (2, math.nan), (3, 0.0), (4, -1.0)], 2.0, {1: 0, 2: 0, 3: 0, 4: 0}),
    ([(1, None), (None, 5.0), (3, 0.0)], 2.0, {1: 0, None: 6, 3: 0}), ([(7, 0.2), (8, 0.0)], 100.0, {7: 200, 8: 0}), ([(1, 1.0)], 0.0, {1: 0}),
])
def test_independent_draws_of_odd_weights(spark, rows, factor, want):
    assert _drawn(spark, rows, factor=factor) == want


def test_missing_values_tell_nothing(spark):
    draw = random.Random(2)
    rows = []
    for k in range(4_000):
        target, noise = draw.random(), draw.random()
        missing = target < 0.5
        rows.append((None if missing else noise, math.nan if missing else noise, noise, None, 1.0, target if k % 10 else None))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, target double")
    got = {r["feature"]: r["mi"] for r in features.mutual_information(df, ["a", "b", "c", "d", "e"], "target").collect()}
    assert got["a"] == pytest.approx(got["b"]) and got["a"] < 0.12 and got["c"] < 0.06 and got["d"] == 0 and abs(got["e"]) < 1e-12
