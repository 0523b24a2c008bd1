"""Registered queries: their SQL twins, their columns, and what remains when this package is gone."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from acreage.llm import queries
from tests.llm.conftest import SMALL

ROOT = Path(__file__).resolve().parents[2]
KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "int": "INTEGER"}

#: Columns that the contracts name, in their order and with their types.
CONTRACTS = {
    "op2_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op4_disclosure_sanitising": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op5_benchmark_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op6_source_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op7_ngram_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op8_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op10_line_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op11_phrase_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op12_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op13_url_models": "page_id bigint, host string, path string, rule string, verdict string",
}


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = queries.queries()[name](spark, SMALL)
    found = con.execute(queries.oracles()[name])
    types = {d[0]: str(d[1]) for d in found.description}
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema.fields} == types
    order = list(types)
    assert sorted(map(str, (tuple(r[c] for c in order) for r in df.collect()))) == sorted(map(str, found.fetchall()))


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract_columns(spark, name):
    fields = queries.queries()[name](spark, SMALL).schema.fields
    named = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    assert named == CONTRACTS[name] or named.startswith(CONTRACTS[name] + ", ")


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_the_rest_imports_without_this_package():
    code = (
        "import sys; sys.modules['acreage.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
        "names = e.queries(); assert 'pipeline' not in names and not any(n.startswith('op1_') for n in names); assert set(e.oracle_sql()) <= set(names)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
