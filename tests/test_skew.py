"""A key holding two thirds of all rows: results stay whole and the plan splits it."""

import json

import pytest
from pyspark.sql import functions as F

from fiscalframe.operators.quality import payment_failures, reconcile_receipts
from fiscalframe.operators.worklist import fetch_outcomes, fetch_worklist
from fiscalframe.plans.responses import recover_receipts
from fiscalframe.schema import conform

N = 120_000
SMALL = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot(spark, name, ending=""):
    key = F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    return spark.range(0, N, 1, 8).select("id", F.concat(key, F.lit(ending)).alias(name))


def ran(df):
    """Rows counted with every column computed, and the plan that ran."""
    digest = df.select(F.xxhash64(*df.columns).alias("h")).groupBy().agg(F.count("*"), F.bit_xor("h"))
    n = digest.collect()[0][0]
    return n, digest._jdf.queryExecution().executedPlan().toString()


def test_answers_joined_to_a_hot_receipt(spark):
    receipts = hot(spark, "filename")
    answer = json.dumps([{"item_name": "Su", "quantity": 1, "unit_price": 2, "line_total": 2}] * 2)
    responses = receipts.select("filename", F.lit(0).alias("attempt"), F.lit(answer).alias("response"))
    n, plan = ran(recover_receipts(receipts, responses))
    assert n == 2 * (N // 3 + 1)
    assert "partial_min_by" in plan and "Broadcast" not in plan


def test_fetch_log_with_a_hot_id(spark, small_partitions):
    # Shuffle sizes are measured compressed, so the rows need something to weigh.
    error = F.sha2(F.col("id").cast("string"), 256)
    none = F.lit(None)
    log = hot(spark, "fiscal_id").select("fiscal_id", none.cast("int").alias("status_code"), none.cast("string").alias("error"), error.alias("note"))
    out = fetch_outcomes(log, hot(spark, "filename", ".jpeg").filter("id % 2 = 0"))
    n, plan = ran(out)
    assert n == N and "skew=true" in plan
    present = out.filter(F.col("outcome") == "present").count()
    assert present == N * 2 // 3 + N // 6


def test_worklist_with_a_hot_id(spark):
    ids, files = hot(spark, "fiscal_id"), hot(spark, "filename", ".jpeg").filter("id % 2 = 0")
    assert fetch_worklist(ids, files).count() == N // 6
    n, plan = ran(fetch_worklist(ids, files))
    left = plan[plan.index("SortMergeJoin") :].split("Range")[0]
    assert n == N // 6 and left.count("HashAggregate") == 2
    assert fetch_worklist(ids, files.filter("filename <> 'hot.jpeg'")).count() == N // 6 + 1


def test_figures_of_a_hot_receipt(spark):
    items = conform(
        hot(spark, "filename").select(
            "filename", F.lit("x").alias("item_name"), F.lit(0.1).alias("line_total"), F.lit("1.00").alias("cash_payment")
        )
    )
    row = reconcile_receipts(items).filter("filename = 'hot'").first()
    assert row["n_items"] == N * 2 // 3 and float(row["items_total"]) == N * 2 / 30
    assert payment_failures(items).first()[0] == 0.0
    plan = reconcile_receipts(items)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
