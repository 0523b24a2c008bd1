"""Operator 12 against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from acreage.llm.variants import LETTERS, checksums, variants
from tests.llm.brute import LOWER
from tests.llm.conftest import SMALL, with_clashes

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
ALPHABET = [chr(c) for c in range(97, 123)] + [chr(c) for c in range(0xC0, 0x100)]


def counted(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def edits(word):
    """Every string one inserted, deleted or replaced letter away."""
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i + k :] for c in ALPHABET for i in range(len(word) + 1) for k in (0, 1)}
    return out - {word}


def brute(rows):
    n = counted(rows)
    form, near = {}, {}
    for w in n:
        found = [x for x in edits(w) if x in n] if len(w) < 40 else [x for x in n if abs(len(x) - len(w)) < 2 and x in edits(w)]
        near[w] = len(found)
        if found:
            best = min(found, key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], near[w], n[form[w]] if w in form else None))
    return sorted(map(str, out))


def _same(spark, rows, **options):
    got = variants(with_clashes(spark, [(d, "s", t) for d, t in rows]), **options)
    assert got.columns == COLUMNS
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == brute(rows)


@pytest.mark.parametrize(("block", "bucket"), [(256, 2048), (3, 2048), (2, 2)])
def test_whole_small_table(spark, block, bucket):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = variants(docs, block=block, bucket=bucket)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == brute(rows)


@pytest.mark.parametrize(("block", "bucket"), [(256, 2048), (5, 4)])
def test_edits_forms_and_roots(spark, block, bucket):
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdeéÿ×À") for _ in range(draw.randint(6, 10))) for _ in range(60)]
    rows = []
    for k, w in enumerate(words):
        changed = [w, w[:2] + "z" + w[2:], w[:-1], w[1:] + w[0], w[:3] + "q" + w[4:], w[::-1], w[1] + w[0] + w[2:]]
        for times, x in zip((3, 40, 2, 2, 500, 2, 5), changed, strict=True):
            rows += [(k, f"{x.upper() if draw.random() < 0.1 and x.isascii() else x}, ") for _ in range(times)]
    # Chains of forms: each ten times as frequent as the last.
    rows += [(5, "chainaaa " * 2), (6, "chainaab " * 25), (7, "chainabb " * 300), (8, "chainbbb " * 3500)]
    rows += [(None, "nothing nothing nothing"), (1, None), (2, ""), (3, "x" * 6), (4, "ŵŵŵŵŵŵŵ ŵŵŵŵŵŵŵ straße1straßen straßen")]
    _same(spark, rows, block=block, bucket=bucket)


def test_very_long_runs(spark):
    long = "abcdefghij" * 300
    rows = [(1, f"{long} {long} {long}x {long}x {long[1:]} {long[1:]} {long[:50]}q{long[51:]} {long[:50]}q{long[51:]}"), (2, "ab" * 200_000)]
    rows += [(3, " ".join(["wordword"] * 50_000))]
    got = {r["word"]: r["n_near"] for r in variants(with_clashes(spark, [(d, "s", t) for d, t in rows])).collect()}
    n = counted(rows)
    assert got.keys() == n.keys()
    for w in (x for x in got if len(x) > 100):
        near = sum(1 for x in n if x != w and abs(len(x) - len(w)) < 2 and _apart(w, x))
        assert got[w] == near


def _apart(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_nothing_given(spark):
    assert variants(with_clashes(spark, [])).count() == 0
    assert variants(with_clashes(spark, [(1, "s", None), (2, "s", "a b c short wordwordword")])).count() == 0


def test_checksums():
    draw = np.random.default_rng(4)
    data = draw.integers(0, 256, 5000, dtype=np.uint8)
    start = draw.integers(0, 4000, 400)
    end = start + np.concatenate([draw.integers(0, 130, 398), [0, 1000]])
    seeds = draw.integers(0, 1 << 32, 400, dtype=np.uint32)
    want = [zlib.crc32(data[a:b].tobytes(), int(s)) for a, b, s in zip(start, end, seeds, strict=True)]
    assert checksums(data, start, end, seeds).tolist() == want
    assert len(ALPHABET) == LETTERS
