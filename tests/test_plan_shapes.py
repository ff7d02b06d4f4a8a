"""What the plans must look like: pushdown, pruning, no Python in row operators, no one-task window on a fact table."""

import re

from pyspark.sql import functions as F

from riskspark.operators import behavior, profile
from riskspark.queries.profile_queries import txn_with_device
from riskspark.queries.scalar_queries import sc01, sc03, sc07
from riskspark.sources.views import table, txn, wide


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_scan_reads_two_columns(spark, sf_dir):
    p = plan(profile.bucket_rates(wide(spark, sf_dir), "V1"))
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", p)[-1]
    assert "l_extendedprice" not in schema and "l_quantity" in schema


def test_filter_reaches_the_scan(spark, sf_dir):
    p = plan(table(spark, sf_dir, "lineitem").where(F.col("l_quantity") > 49))
    assert "GreaterThan(l_quantity,49.0)" in p


def test_row_operators_have_no_python(spark, sf_dir):
    for q in (sc01, sc03, sc07):
        assert "Python" not in plan(q(spark, sf_dir)) and "Pandas" not in plan(q(spark, sf_dir))


def test_velocity_shuffles_once(spark, sf_dir):
    t = txn_with_device(spark, sf_dir)
    counts = behavior.velocity(t, behavior.VELOCITY_ENTITIES, "TransactionDT", "TransactionID")
    physical = plan(counts).split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning(entity") == 1


def test_fact_windows_are_partitioned(spark, sf_dir):
    t = txn(spark, sf_dir).select("TransactionID", "TransactionDT", "isFraud")
    physical = plan(behavior.momentum(t, "TransactionDT", "TransactionID", "isFraud")).split("== Physical Plan ==")[1]
    # the only one-task exchange is the offset table, with one row per partition
    singles = [line for line in physical.splitlines() if "SinglePartition" in line]
    assert len(singles) <= 1
