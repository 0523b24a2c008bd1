"""Operators 4 and 9: base spans against regular expressions, method spans on planted cases, no Python on the way."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from acreage.llm.disclosure import disclosing, disclosure_digest, sanitised
from acreage.llm.secret_scan import CHARACTERS, secret_digest, secret_spans, transition_scores
from acreage.llm.spans import running
from tests.conftest import plan_of
from tests.llm.conftest import frame, with_clashes


def _luhn(digits):
    return sum(sum(divmod(2 * int(x), 10)) if i % 2 else int(x) for i, x in enumerate(reversed(digits))) % 10 == 0


def _digits(match):
    return re.sub("[^0-9]", "", match[0])


PRIVATE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(_digits(m)) <= 19 and _luhn(_digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m)) <= 15),
}
SECRETS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def _want(text, kinds):
    found, counts = [], []
    for rank, (kind, (pattern, valid)) in enumerate(kinds.items()):
        matches = [m for m in re.finditer(pattern, text or "", re.A) if valid(m)]
        counts.append(len(matches))
        found += [(m.start(), rank, m.end(), kind) for m in matches]
    listed = [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]
    return (*counts, hashlib.sha256(",".join(listed).encode()).hexdigest()), listed


ODD = [
    None, "", "é漢 a@b.c_d@e.f 😀 x@y", "a..b@c-.d.e. @x.y a@b a@.b z@q.r.", "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.0000.1 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111 1111 1111 41111111111111111111 5", "12 34 4111111111111111 12 4111 1111-11111111",
    "+1 (366) 555-9807 +12 3 +1........2 ++49 30 123456789 +123456789012345678 +1-", "(+44) 20 7946 0958. +4420.7946.0958)",
    "password=token:abcdefgh secret=token=abcdefg API_KEY : 'x/y+z==9' apikey=\"short\" PassWd= longer1 token  =  'aaaaaa'",
    "AKIA" + "Z" * 16 + " AKIAAKIA" + "B" * 11 + " xAKIA" + "C" * 20 + " AKIAshort", "0123456789abcdef01234567 g0123456789abcdef0123456 ABCDEF" + "abcdef" * 5,
    "+" + "1 " * 5_000 + "9.9." * 5_000, "a@" + "b." * 20_000 + "c", "tokentoken" * 3_000 + " = ", "1 " * 40_000, "😀" * 5_000 + " q@r.s",
]


def _fuzz(seed, pieces, n):
    draw = random.Random(seed)
    return ["".join(draw.choice(pieces) for _ in range(draw.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("kinds", [PRIVATE, SECRETS], ids=["private", "secrets"])
def test_base_spans(spark, texts, kinds):
    pieces = (
        ["a", "B", ".", "@", "-", "_", "+", "%", " ", "1", "25", "255", "0", "4111", "é", "(", ")", "\n"] if kinds is PRIVATE
        else ["token", "Secret", "api_key", "=", ":", " ", "'", '"', "ab", "0f", "AKIA", "Z9", "deadbeef", "0123456789abcdef", "/", "é"]
    )
    rows = [t for _, _, t in texts] + ODD + _fuzz(1, pieces, 400)
    df = with_clashes(spark, [(i, "s", t) for i, t in enumerate(rows)])
    digest = disclosure_digest(disclosing(df)) if kinds is PRIVATE else secret_digest(secret_spans(df))
    got = {r["doc_id"]: r for r in digest.collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(rows):
        want, listed = _want(text, kinds)
        assert tuple(got[i][f"n_{k}"] for k in kinds) + (got[i]["base_sha256"],) == want, text[:200]
        spans = got[i]["spans"].split(",") if got[i]["spans"] else []
        assert [s for s in spans if s.split(":")[0] in kinds] == listed
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_terms_that_disclose(spark):
    draw = random.Random(4)
    words = lambda: " ".join(draw.choice(("the", "of", "and", "this", "that", "was")) for _ in range(20))
    rows = [(i, "s", f"{words()} Zelda Quist wrote to ann@x.org from {words()}") for i in range(6)]
    rows += [(10 + i, "s", f"{words()} mail bob@x.org here {words()}") for i in range(2)]
    rows += [(20 + i, "s", f"{words()} the mail of {words()}") for i in range(40)]
    rows += [(6, "s", rows[0][2]), (None, None, rows[0][2]), (99, "s", None)]
    df = with_clashes(spark, rows)
    found = {}
    for r in disclosing(df).collect():
        found.setdefault(r["doc_id"], set()).update(x["value"] for x in r["at_term"])
    assert found[0] == found[6] == found[None] and {"zelda", "quist", "wrote"} <= found[0]
    assert not found[0] & {"the", "of", "and", "this", "that", "was"}
    assert not found[10] and not found[20] and not found[99]  # two texts are too few, and no entity is near
    clean = {r["doc_id"]: r["text"] for r in sanitised(df).collect()}
    assert "Zelda" not in clean[0] and "ann@x.org" not in clean[0] and "[EMAIL]" in clean[0] and "[TERM] [TERM]" in clean[0]
    assert clean[20] == rows[8][2] and clean[99] == "" and len(clean) == 51


def test_an_entity_of_a_single_text_is_disclosed(spark):
    draw = random.Random(6)
    words = lambda: " ".join(draw.choice(("the", "of", "and", "this", "that", "was")) for _ in range(20))
    rows = [(i, "s", words()) for i in range(1_000)]
    rows += [(1_000, "s", f"{words()} Quentin Zyxomma wrote to q.z@x.org and {words()}")]
    found = {r["doc_id"]: {x["value"] for x in r["at_term"]} for r in disclosing(with_clashes(spark, rows)).collect()}
    assert found.pop(1_000) == {"quentin", "zyxomma", "wrote"} and not any(found.values())


def test_disclosing_terms_are_marked_wherever_they_occur(spark):
    draw = random.Random(7)
    words = lambda n=20: " ".join(draw.choice(("the", "of", "and", "this", "that", "was")) for _ in range(n))
    long = f"Éü {words(700)} ZELDA\n\n{words()} zelda; {words(600)} 😀 ann@x.org {words(200)}"
    rows = [(i, "s", words()) for i in range(1_000)] + [(1_000 + i, "s", long) for i in range(9)] + [(2_000, "s", f"only Zelda {words()}")]
    df = with_clashes(spark, rows)
    found = {r["doc_id"]: [tuple(x) for x in r["at_term"]] for r in disclosing(df).collect()}
    want = [(m.start(), m.end(), "zelda") for m in re.finditer("zelda", long, re.I)]
    assert len(want) == 2 and all(found[1_000 + i] == want for i in range(9))
    assert found[2_000] == [(5, 10, "zelda")] and not any(found[i] for i in range(1_000))
    clean = {r["doc_id"]: r["text"] for r in sanitised(df).collect()}
    assert clean[1_000] == re.sub("zelda", "[TERM]", long, flags=re.I).replace("ann@x.org", "[EMAIL]") and clean[2_000].startswith("only [TERM] ")


def test_random_keys_among_identifiers(spark, documents):
    draw = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(draw.choice(alphabet) for _ in range(n)) for n in (20, 24, 32, 40) for _ in range(25)]
    plain = ["internationalization_support", "getUserAccountInformation", "1234567890123456", "2024-01-01_00-00-00", "path/to/some/module/name", "-" * 40, "=" * 16,
             "a" * 30_000, "the_quick_brown_fox_jumps", "/usr/local/lib/python/site-packages"]
    extra = spark.createDataFrame([(10_000 + i, f"über {w} end") for i, w in enumerate(keys + plain)], "doc_id bigint, text string")
    df = documents.select("doc_id", "text").union(extra)
    got = {r["doc_id"]: r for r in secret_digest(secret_spans(df)).where("doc_id >= 10000").collect()}
    caught = [got[10_000 + i]["spans"] == f"markov:5:{5 + len(k)}" for i, k in enumerate(keys)]
    assert sum(caught) >= 0.95 * len(keys)
    assert [w for i, w in enumerate(plain) if got[10_000 + len(keys) + i]["n_markov"]] == []


def test_models(spark, documents):
    size = len(CHARACTERS)
    scores = transition_scores(documents)
    assert len(scores) == (size + 1) * size
    row = lambda a: scores[(1 + CHARACTERS.index(a)) * size : (2 + CHARACTERS.index(a)) * size]
    assert row("t")[CHARACTERS.index("h")] < 0 < row("t")[CHARACTERS.index("7")]


def test_no_python_and_empty_tables(spark):
    empty = with_clashes(spark, [])
    for df in (disclosure_digest(disclosing(empty)), secret_digest(secret_spans(empty))):
        assert df.count() == 0
        assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan_of(df))
    assert sanitised(empty).count() == 0


def test_running_sums_and_maxima(spark):
    draw = random.Random(3)
    lists = [None, [], [5], [0, 0], *([draw.randrange(9) for _ in range(n)] for n in (2, 3, 15, 16, 17, 1_000))]
    rows = running(frame(spark, [(k, x) for k, x in enumerate(lists)], "k int, x array<int>"), "x", "sums")
    rows = running(rows, "x", "tops", "greatest({}, {})".format).orderBy("k").collect()
    for row, values in zip(rows, lists):
        assert row["sums"] == (list(itertools.accumulate(values)) if values else None)
        assert row["tops"] == (list(itertools.accumulate(values, max)) if values else None)


def test_texts_of_very_many_matches(spark):
    n = 200_000
    docs = with_clashes(spark, [(1, "a", "9.9.9.9 " * n), (2, "a", ("token=abcdef " + "Zq8" * 8 + " ") * (n // 20))])
    found = secret_spans(docs).where("doc_id = 2").select(F.size("at_assign").alias("n"), F.expr("at_assign[size(at_assign) - 1].end").alias("end")).first()
    assert (found["n"], found["end"]) == (n // 20, 38 * (n // 20 - 1) + 12)
    last = disclosing(docs).where("doc_id = 1").select(F.size("at_ip").alias("n"), F.expr("at_ip[size(at_ip) - 1]").alias("x")).first()
    assert (last["n"], last["x"]["start"], last["x"]["end"]) == (n, 8 * (n - 1), 8 * n - 1)
