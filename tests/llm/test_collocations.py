"""Operator 11 against plain Python; the SQL twin holds it on the given tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acreage.llm.collocations import LEVELS, _buckets, _identified, collocations, with_score
from acreage.llm.words import texts_of
from tests.llm.brute import LOWER
from tests.llm.conftest import CLASHING, frame

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=10, most=2000):
    """The contract's rows of (lang, text) rows."""
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\t]+", piece)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        n = sum(a for p, a in count.items() if len(p) == 1)
        kept = []
        for p, a in found.items():
            if any(100 * b >= 50 * a for q, b in found.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
                continue
            s, _, left, right = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            kept.append((-s, -a, " ".join(p).encode(), left, right))
        kept.sort()
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(kept[:most])]
    return sorted(out)


def _prose(seed, lang, vocabulary, sentences, idioms=6):
    draw = random.Random(seed)
    words = [f"{lang or 'u'}{i}é"[: draw.randint(2, 9)] for i in range(vocabulary)]
    fixed = [[draw.choice(words) for _ in range(draw.choice([2, 3, 3, 4]))] for _ in range(idioms)]
    texts = []
    for _ in range(sentences):
        parts = []
        for _ in range(draw.randint(1, 6)):
            parts += draw.choice(fixed) if draw.random() < 0.4 else [words[min(int(draw.expovariate(0.08)), vocabulary - 1)]]
        texts.append(draw.choice([" ", "  ", "\t"]).join(parts) + draw.choice([".", "!", "\n", ""]) + draw.choice(["", " The End. THE end"]))
    return [(lang, t) for t in texts]


def _same(spark, rows, **options):
    filler = (7, 7, 7, "x", 7, "x", 7, "x", "x", "x", 7.0, 7, "x")
    df = frame(spark, [(lang, t, *filler) for lang, t in rows], f"lang string, text string, {CLASHING}")
    got = collocations(df, **options)
    assert got.columns == COLUMNS
    wanted = brute(rows, **{k: v for k, v in options.items() if k in ("least", "most")})
    assert sorted(tuple(r) for r in got.collect()) == wanted
    return wanted


@pytest.mark.parametrize("options", [
    {"most": 40}, {"most": 8, "table_bits": 4}, {"most": 3, "levels": (-4, -8, -12, -16, None), "table_bits": 10}, {"levels": (None,)},
])
def test_against_plain_python(spark, options):
    rows = _prose(1, "en", 60, 500) + _prose(2, None, 25, 200) + _prose(3, "und", 25, 100) + _prose(4, "", 400, 40)
    rows += [("en", None), (None, None), ("en", ""), ("xx", " .,;\n "), ("yy", "one two")]
    wanted = _same(spark, rows, **options)
    assert {r[0] for r in wanted} >= {"en", "und"}


def test_ties_repeats_and_long_texts(spark):
    # Equal phrases in all ways but their words, a word repeated, phrases at every place of a long text's rows.
    rows = [("t", f"b{i} c{i}") for i in range(30) for _ in range(10)] + [("r", "na " * 40)] * 3 + [("l", "w x y z . " * 150_000)]
    wanted = _same(spark, rows, most=7)
    assert [r[2] for r in wanted if r[0] == "t"][:3] == ["b0 c0", "b1 c1", "b10 c10"]
    assert ("l", 150_000) in {(r[0], r[3]) for r in wanted}


def test_pairs_are_counted_in_one_wave(spark):
    # A rare word of an open language shares its bucket with a frequent one of a language that the first wave settles.
    key = spark.range(1).select(F.xxhash64(F.lit("s")), F.xxhash64(F.lit("u"))).first()
    names = [f"w{i}" for i in range(4000)]

    def places(k):
        ids = _identified(texts_of(pa.array(names)), np.full(len(names), k, dtype=np.int64).view(np.uint64))[1]
        return dict(zip(names, _buckets(ids, None, 8).tolist(), strict=True))

    settled, still = places(key[0]), places(key[1])
    rare, often = "w0", next(w for w in names if still[w] not in (still["w0"], 0))
    heavy = next(w for w in names if settled[w] == still[rare])
    other = next(w for w in names if settled[w] not in (still[rare], still[often]))
    rows = [("s", f"{heavy} {other}.")] * 1000 + [("u", f"{rare} {often}.")] * 12 + [("u", f"{often}.")] * 988
    wanted = _same(spark, rows, most=1, table_bits=8)
    assert sorted((r[0], r[7]) for r in wanted) == [("s", 1_000_000), ("u", 12_000)]


def test_nothing_given(spark):
    assert collocations(frame(spark, [], "lang string, text string")).count() == 0
    assert collocations(frame(spark, [("a", "x y"), (None, None)], "lang string, text string")).count() == 0


def test_levels_end_with_none(spark):
    with pytest.raises(ValueError, match="last level"):
        collocations(frame(spark, [], "lang string, text string"), levels=LEVELS[:-1])


def test_scores_are_exact_beyond_64_bits(spark):
    draw = random.Random(5)
    rows = []
    for _ in range(300):
        a = draw.randint(1, 10 ** draw.randint(1, 15))
        rows.append((a, a + draw.randint(0, 10 ** draw.randint(0, 15)), a * draw.choice([1, 3]) + draw.randint(0, 9)))
    got = with_score(frame(spark, rows, "a bigint, l bigint, r bigint"), "score", "a", "l", "r").collect()
    for r in got:
        assert r["score"] == 1_000_000 * r["a"] ** 2 // (r["l"] * r["r"])
