import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

pytest.importorskip("termloom.llm")
pytest.importorskip("public_tokenizers")

from messy_texts import messy_texts  # noqa: E402

# Columns whose names the operators use themselves.
CLASHING = "key string, content string, ids string, anchor bigint, row bigint, part int, _id bigint, _marks int, _spans int, _kept int"
CLASHING_ROW = ("k", "c", "i", 1, 2, 3, 4, 5, 6, 7)


@pytest.fixture(scope="session")
def messy(spark):
    rows = [(*row, len(row[1] or ""), *CLASHING_ROW) for row in messy_texts()]
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(messy):
    return messy.limit(0)
