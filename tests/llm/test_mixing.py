"""Operator 6: targets against step-by-step resharing, rates against the dual, copies against targets."""

import math
import random
from collections import defaultdict

import pytest

from acreage.llm.mixing import mixed, mixed_rows, source_targets, word_count
from tests.llm.brute import SPACE_WORDS, level_targets
from tests.llm.conftest import frame, with_clashes


def _rows(seed, sources, docs):
    draw = random.Random(seed)
    return [
        (i, s, "w " * int(draw.lognormvariate(3, 1)))
        for s, n in zip(sources, docs, strict=True) for i in range(n)
    ]


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 5000, None: 7}, {"x": 10}, {None: 4, "": 3}, {"a": 0, "b": 9}, {f"s{i}": 3**i for i in range(9)}])
def test_targets(spark, sizes):
    df = frame(spark, [(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    want = level_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert math.isclose(got[s], want[s], rel_tol=1e-12, abs_tol=1e-9)


def test_rates_and_copies(spark):
    rows = _rows(4, ["a", "b", "c", "d", None], [400, 150, 700, 40, 90]) + [(9, "z", None), (10, "z", ""), (11, "b", " \x0b "), (None, "a", "w w")]
    df = with_clashes(spark, rows)
    got = mixed(df).collect()
    again = mixed(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(rows)
    size, want = defaultdict(int), defaultdict(float)
    for _, s, t in rows:
        size[s] += len(SPACE_WORDS.findall(t or ""))
    target = level_targets(size)
    taken, rated, copies = defaultdict(int), defaultdict(float), defaultdict(set)
    for r in got:
        assert r["source_size"] == size[r["source"]] and math.isclose(r["target"], target[r["source"]], rel_tol=1e-9)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 and (r["size"] or not r["copies"])
        assert math.floor(r["rate"]) <= r["copies"] <= math.ceil(r["rate"])
        taken[r["source"]] += r["taken"]
        rated[r["source"]] += r["rate"] * r["size"]
        copies[r["source"]].add((r["size"], r["rate"]))
    for s in target:
        assert math.isclose(rated[s], target[s], rel_tol=1e-8, abs_tol=1e-6)
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 8)
        # An exponential tilt: log rate over size is the same for all documents below the limit.
        tilts = {round(math.log(rate) / n, 6) for n, rate in copies[s] if n and 1e-9 < rate < 3 - 1e-9}
        assert len(tilts) <= 1
        want[s] = target[s]


def test_rows_are_repeated_with_all_columns(spark):
    rows = _rows(6, ["a", "b", "c"], [30, 30, 30])
    df = with_clashes(spark, rows).withColumnRenamed("k", "rate")
    out = mixed_rows(df)
    assert out.columns == df.columns
    want = defaultdict(int)
    for r in mixed(df).collect():
        want[r["source"], r["doc_id"]] += r["copies"]
    got = defaultdict(int)
    for r in out.collect():
        got[r["source"], r["doc_id"]] += 1
    assert got == {k: n for k, n in want.items() if n}


def test_empty_tables_and_empty_texts(spark):
    assert mixed(with_clashes(spark, [])).count() == 0
    got = mixed(with_clashes(spark, [(1, "a", ""), (2, None, None), (2, None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 3


def test_word_count(spark):
    texts = [None, "", " ", "a", " a\tb\x0b\x0c\r\nc ", "é\xa0漢 x", "\x1c a", "w " * 50_000]
    df = frame(spark, [(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r["n"] for r in df.select("i", word_count("text").alias("n")).orderBy("i").collect()]
    assert got == [len(SPACE_WORDS.findall(t or "")) for t in texts]
