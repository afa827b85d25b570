import pytest
from termloom.llm import support
from termloom.llm.support import lookup


@pytest.mark.parametrize("small", [True, False])
def test_lookup_joins_every_row_whatever_is_hot(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(support, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(support, "HOT_KEYS", 4)
    rows = [(i, "hot" if i % 2 else None if i % 3 else f"k{i}", i % 5, "own") for i in range(300)]
    table = [("hot", a, "h") for a in range(5)] + [(None, a, "n") for a in range(4)] + [(f"k{i}", i % 5, "k") for i in range(0, 300, 12)]
    left = spark.createDataFrame(rows, "id bigint, key string, a bigint, other string")
    right = spark.createDataFrame([(k, a, v) for k, a, v in table], "key string, a bigint, value string")
    want = {(k, a): v for k, a, v in table}
    got = sorted(((r.id, r.key, r.a, r.other, r.value) for r in lookup(left, right, ["key", "a"]).collect()), key=str)
    assert got == sorted(((*row, want[row[1], row[2]]) for row in rows if (row[1], row[2]) in want), key=str)
    assert lookup(left.limit(0), right, ["key", "a"]).count() == 0
    assert lookup(left, right.limit(0), ["key", "a"]).count() == 0


def test_a_hot_key_is_in_no_shuffled_join(spark, monkeypatch):
    monkeypatch.setattr(support, "BROADCAST_BYTES", 0)
    left = spark.range(1000).selectExpr("id", "if(id < 900, 0, id) AS key")
    right = spark.range(1000).selectExpr("id AS key", "id * 2 AS value")
    monkeypatch.setattr(support, "HOT_KEYS", 2)
    found = lookup(left, right, ["key"])
    assert found.count() == 1000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan and "LeftAnti" in plan
