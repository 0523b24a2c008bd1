import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """(doc_id, source, text) of the small table's documents."""
    return [tuple(r) for r in documents.select("doc_id", "source", "text").collect()]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


#: Names that operators use inside; given tables may have them as further columns.
CLASHING = "id bigint, k bigint, n bigint, key string, size bigint, words string, part int, runs string, items string, n_words string, target double, copies int, host string"


def with_clashes(spark, rows):
    """(doc_id, source, text) rows with further columns whose names the operators use themselves."""
    filler = (7, 7, 7, "x", 7, "x", 7, "x", "x", "x", 7.0, 7, "x")
    return frame(spark, [(*row, *filler) for row in rows], f"doc_id bigint, source string, text string, {CLASHING}")
