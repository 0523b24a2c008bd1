"""Operator 8: gradients, held-out accuracy, windows, edges."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from acreage.llm import toxicity as module
from acreage.llm.toxicity import STRIDE, WINDOW, Network, best_edge, inputs_of, toxicity, train
from tests.llm.conftest import frame, with_clashes

PLAIN = [f"w{i}" for i in range(400)]
BAD = ["idiotic", "scummy", "trashy", "moronic"]


def _corpus(seed, n):
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [draw.choice(PLAIN) for _ in range(draw.randrange(5, 150))]
        bad = draw.random() < 0.3
        if bad:
            words.insert(draw.randrange(len(words)), draw.choice(BAD) + draw.choice(("", "s", "er")))
        rows.append((i, "s", " ".join(words)))
        labels.append((i, int(bad), "x"))
    return rows, labels


def _inputs(texts):
    return inputs_of(pa.array(texts, pa.large_string()))


def test_gradients_are_the_slopes_of_the_loss():
    network = Network()
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    x = _inputs(["a bb ccc dddd eeeee", "one two three " * 20, "x"])
    chosen, target = np.arange(len(x.places)), np.array([1.0, 0.0, 1.0, 1.0, 0.0])[: len(x.places)]
    _, g = network.gradients(x, chosen, target)
    draw = np.random.default_rng(1)
    for name in ("w", "b", "u", "v", "o", "c", "word", "char"):
        value = network.p[name]
        if name in ("word", "char"):
            rows, slope = g[name]
            row = draw.integers(len(rows))
            place, got = (rows[row], 3), slope[row, 3]
        else:
            place = tuple(draw.integers(s) for s in value.shape)
            got = g[name][place]
        ends = []
        for step in (1e-3, -1e-3):
            old = value[place]
            value[place] = old + step
            ends.append(network.gradients(x, chosen, target)[0])
            value[place] = old
        assert got == pytest.approx((ends[0] - ends[1]) / 2e-3, rel=0.03, abs=2e-5), name


@pytest.mark.parametrize("n", [0, 1, STRIDE, WINDOW, WINDOW + 1, 1000])
def test_windows_cover_every_word(n):
    x = _inputs(["", " ".join(f"w{i}" for i in range(n)), None])
    assert set(x.owner.tolist()) <= {1}
    covered = set()
    for row, length in zip(x.places, x.lengths, strict=True):
        covered |= set(row[:length].tolist())
    assert len(covered) == n and (n == 0 or len(x.places) == 1 + max(0, -(-(n - WINDOW) // STRIDE)))


def test_a_windows_score_does_not_depend_on_its_batch():
    network = Network()
    texts = ["a b c", "d " * 100, "e f"]
    together = network.scores(_inputs(texts))
    apart = np.concatenate([network.scores(_inputs([t])) for t in texts])
    assert together == pytest.approx(apart, abs=1e-5)


def test_held_out_rows(spark):
    rows, labels = _corpus(1, 1500)
    known = frame(spark, labels, "doc_id bigint, toxic int, text string")
    got = {r["doc_id"]: r for r in toxicity(with_clashes(spark, rows), known).collect()}
    truth = {i: t for i, t, _ in labels}
    held = [i for i in got if got[i]["held_out"]]
    assert {i for i in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all((got[i]["score"] >= 0.5) == got[i]["predicted"] and 0 <= got[i]["score"] <= 1 for i in got)
    right = sum(got[i]["predicted"] == truth[i] for i in held)
    assert right >= 0.9 * len(held)


def test_held_out_labels_are_never_read(spark):
    rows, labels = _corpus(2, 300)
    other = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, x) for i, t, x in labels]
    scores = []
    for known in (labels, other):
        df = toxicity(with_clashes(spark, rows), frame(spark, known, "doc_id bigint, toxic int, text string"))
        scores.append({r["doc_id"]: r["score"] for r in df.collect()})
    assert scores[0] == scores[1]


def test_edges(spark):
    rows, labels = _corpus(3, 60)
    rows = [*rows, (1000, "s", None), (1001, "s", ""), (1002, "s", "..."), (None, "s", "word"), (1003, "s", "w1 " * 40_000), (5, "s", rows[5][2])]
    known = frame(spark, [*labels, (None, 1, "x"), (1000, None, "x"), (3, 0, "x"), (3, 1, "x")], "doc_id bigint, toxic int, text string")
    got = toxicity(with_clashes(spark, rows), known).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["score"] for i in (1000, 1001, 1002)] == [0, 0, 0] and by[1003]["n_words"] == 40_000 and not by[None]["held_out"]
    assert toxicity(with_clashes(spark, []), known).count() == 0
    for labels, want in (([], {0}), ([(i, 0, "x") for i in range(20)], {0}), ([(i, 1, "x") for i in range(20)], {1})):
        out = toxicity(with_clashes(spark, rows[:20]), frame(spark, labels, "doc_id bigint, toxic int, text string")).collect()
        assert {r["predicted"] for r in out} == want


def test_best_edge():
    values = np.array([0.0, 1.0, 2.0, 3.0])
    assert best_edge(values, np.array([False, False, True, True]), 0.5) == 1.5
    assert best_edge(values, np.array([False, True, False, True]), 0.01) == 2.5
    assert module.ROWS_BY_CLASS <= 2_000 and train([], np.zeros(0)).p["c"][0] < 0
