"""A sample of the registered queries against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, canonical

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["normalize_tokens", "stored_postings", "term_dictionary", "document_stats", "leaf_hits",
         "ranked_search", "top_k_per_query", "query_log_leaves", "upsert_term_counters",
         "pattern_wildcards", "phrase_batch_benchmark", "mixed_batch_index", "mixed_log_search"]
STATUS = {
    "mixed_batch_report": {"indexed", "re-indexed", "skipped", "failed"},
    "mixed_log_status": {"ok", "blank", "malformed", "no_scoring_terms"},
}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def test_every_query_has_sql():
    optional = entry.llm_queries() | entry.pipeline_queries()
    assert set(entry.queries()) - set(optional) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [*NAMES, *STATUS])
def test_query(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = canonical(entry.queries()[name](spark, SF_DIR).toPandas())
    want = canonical(duck.sql(entry.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=0, atol=0)
    if name in STATUS:
        assert set(got["status"]) == STATUS[name]
