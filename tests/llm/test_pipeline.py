"""The pipeline: each stage on its own input, held against plain Python versions."""

from collections import Counter

import pytest

import corpus_pipeline
from acreage.llm.resampling import resampled
from tests.llm.brute import contamination, level_targets, similar_components, SPACE_WORDS
from tests.llm.conftest import SMALL
from tests.llm.test_packing import _documents


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, the given documents first."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
        out.append(docs)
    return out


def _rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "source", "text").collect())


def test_columns_stay(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "token_packing"
    ]
    assert all(df.columns == stages[0].columns and df.schema == stages[0].schema for df in stages[:-1])


def test_classifier(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = {r["doc_id"] for r in resampled(stages[0], labels).where("kept").collect()}
    assert _rows(stages[1]) == [r for r in _rows(stages[0]) if r[0] in kept]
    counts = Counter((r["quality"], r["doc_id"] in kept) for r in labels.join(stages[0], "doc_id", "left_semi").collect())
    assert counts[1, False] <= 0.03 * counts[1, True] and counts[0, True] <= 0.5 * (counts[0, True] + counts[0, False])


def test_one_of_each_group(stages):
    before = _rows(stages[1])
    groups = similar_components([(d, t) for d, _, t in before])
    assert _rows(stages[2]) == [r for r in before if groups[r[0]][1] == r[0]]


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    before = _rows(stages[2])
    found = contamination([(d, t) for d, _, t in before], items)
    assert _rows(stages[3]) == [r for r in before if not found[r[0]][4]] != before


def test_mix(stages):
    before, after = _rows(stages[3]), Counter(_rows(stages[4]))
    assert set(after) <= set(before) and max(after.values()) <= 3
    words = lambda t: len(SPACE_WORDS.findall(t or ""))
    size, taken, largest = Counter(), Counter(), Counter()
    for _, s, t in before:
        size[s] += words(t)
        largest[s] = max(largest[s], words(t))
    for (_, s, t), n in after.items():
        taken[s] += n * words(t)
    for s, target in level_targets(size).items():
        assert abs(taken[s] - target) <= max(0.05 * target, largest[s] / 2)


def test_packing(stages):
    rows = stages[5].collect()
    held = Counter(d for r in rows for d, last in zip(r["doc_ids"], r["last"], strict=True) if last)
    assert held == Counter(d for d, _, t in _rows(stages[4]) if t)
    _documents(rows, 2048)


def test_run(spark, stages):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.schema == stages[5].schema
    assert sum(r["n_tokens"] for r in out.select("n_tokens").collect()) == sum(r["n_tokens"] for r in stages[5].select("n_tokens").collect())
