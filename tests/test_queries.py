"""Every registered query gives what its SQL gives."""

import json

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect
from tidemark.plans.registry import ORACLES, QUERIES
from tidemark.sources.feeds import encode

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_the_flagship_query(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "o_orderkey" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES[name])


def test_messages_are_written_once(spark):
    """Neither side of a change, nor a condition on the message, writes its values again."""
    columns = [
        "id AS k", "CAST(id + 12.5BD AS DECIMAL(9,2)) AS price", "IF(id % 2 = 0, 'c', 'd') AS _op", "1 AS _src_file",
        "id AS _src_pos", "0 AS _src_row", "timestamp_micros(id) AS _src_commit_at",
    ]
    messages = encode(spark.range(2).selectExpr(*columns), "t", ("k",))
    plan = messages.where("value IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("unhex(") == 1 and "isnotnull" not in plan
    payloads = [json.loads(m.value)["payload"] for m in messages.orderBy("offset").collect()]
    assert payloads[0]["after"] == {"k": 0, "price": "AAAAAAAABOI="} and payloads[0]["before"] is None
    assert payloads[1]["before"] == {"k": 1, "price": "AAAAAAAABUY="} and payloads[1]["after"] is None
