import pytest

import __spark_entry__ as entry
import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.oracle(FOLDER)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, db, name):
    found = compare.spark_rows(spark, FOLDER, name)
    assert found[1], "a query without rows shows nothing"
    if name in entry.oracle_sql():
        assert found == compare.sql_rows(db, name)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["document_name", "total_chunks", "avg_length", "min_length", "max_length",
                          "total_characters"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.queries())
def test_plans_have_no_cross_join(spark, name):
    if name in ("ingest_conversations", "index_stats", "json_roundtrip"):
        pytest.skip("plans behind the written files")
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
