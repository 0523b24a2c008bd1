"""Operator 10 against plain Python."""

from acreage.llm.line_rules import line_quality
from tests.llm.brute import line_counts, lines_verdict
from tests.llm.conftest import with_clashes

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def _same(spark, rows, **options):
    got = line_quality(with_clashes(spark, rows), **options).collect()
    verdicts = lines_verdict([(s, t) for _, s, t in rows], *options.values())
    want = [(d, *line_counts(t), kept) for (d, _, t), kept in zip(rows, verdicts, strict=True)]
    assert sorted(map(str, (tuple(r[c] for c in ["doc_id", *COLUMNS]) for r in got))) == sorted(map(str, want))
    return want


def test_whole_small_table(spark, texts):
    _same(spark, texts)


def test_frequent_lines_by_host(spark):
    rows = []
    legal = " ".join(f"c{i}" for i in range(46))
    for i in range(60):
        own = " ".join(f"w{i}_{k}" for k in range(60 if i % 2 else 12))
        rows.append((i, "a" if i < 50 else None, f"{own}\nAll  rights {'reserved' if i % 3 else 'RESERVED'} {legal}\n\n\tsee terms "))
    rows += [(100 + i, "a", rows[1][2]) for i in range(40)]  # copies are one text
    rows += [(200, "b", rows[0][2]), (200, "b", rows[0][2]), (None, "b", "short"), (None, None, None), (201, "c", ""), (202, "c", " \n ")]
    want = _same(spark, rows, least_texts=20, left_percent=60)
    assert {w[-1] for w in want if not w[-2]} == {True, False}


def test_repeats_symbols_and_long_texts(spark):
    rows = [
        (1, "s", "a b c a b c d"), (2, "s", "a a a a"), (3, "s", "x\nx\n\n\nx \n y\n"), (4, "s", "#*$%&|<> é漢 #"),
        (5, "s", " ".join(f"w{i}" for i in range(40_000))), (6, "s", "one two three " * 30_000), (7, "s", "\n".join(["l"] * 500)),
    ]
    _same(spark, rows)
    assert line_quality(with_clashes(spark, [])).count() == 0


def test_verdicts_do_not_follow_the_size_of_the_host(spark):
    shared = " ".join(f"c{i}" for i in range(60))
    rows = [(i, "a", f"{shared}\nown{i} words") for i in range(25)]
    more = [(1_000 + i, "a", " ".join(f"u{i}_{k}" for k in range(55))) for i in range(6_000)]
    small, large = ({r["doc_id"]: r["kept"] for r in line_quality(with_clashes(spark, some)).where("doc_id < 1000").collect()} for some in (rows, rows + more))
    assert small == large == {i: False for i in range(25)}
