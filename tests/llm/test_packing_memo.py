"""How many chunks a worker remembers changes its time and memory, never the rows."""

import public_tokenizers

from termloom.llm import encoding
from termloom.llm.packing import MEMO_CHUNKS, pack_documents


def test_rows_do_not_depend_on_the_memo(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(f"word{i * j % 91}, Casa{j}" for j in range(i))) for i in range(60)] + [(60, None)],
        "doc_id bigint, text string",
    )
    path = public_tokenizers.path("word_bpe_49k.json")
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    few = sorted(tuple(row) for row in pack_documents(docs, path, capacity=64, memo_chunks=3).select(own).collect())
    assert few == sorted(tuple(row) for row in pack_documents(docs, path, capacity=64).select(own).collect())
    assert MEMO_CHUNKS >= encoding.MEMO_CHUNKS  # on its own the operator has a worker's memory to itself
