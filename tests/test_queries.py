"""Registered queries against their SQL; RISKSPARK_ALL=1 runs all of them, otherwise a cross-section."""

import os
import re

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from riskspark import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()
SOME = [
    "sc01_time_parts", "sc12_basket", "prj05_conform", "src04_record_input", "jn01_identity_join", "jn03_null_safe_stats", "jn07_nearest_neighbours",
    "ag01_rate_table", "ag05_user_stats", "ag07_entity_degrees", "ag11_heat_map", "ag12_histogram", "ag19_hourly", "wn04_momentum_delayed", "wn05_velocity",
    "wn10_window_anomalies", "st01_total_order", "sp02_chronological_split", "sp08_smote", "sp10_stratified_folds", "ev03_roc_curve", "ev05_best_threshold",
    "ev09_rank_test", "mon01_score_drift", "mon04_column_drift", "fs03_correlation_prune", "tr06_fraud_rules", "tr07_rule_risk_score", "str01_hourly_stream",
]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert all(re.fullmatch(r"[a-z]{2,3}\d\d_[a-z0-9_]+", n) for n in QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES and (os.environ.get("RISKSPARK_ALL") or n in SOME)])
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir).sql(ORACLES[name])) is None


@pytest.mark.parametrize("name,column", [("tr06_fraud_rules", "lift"), ("st05_top_rules", "lift"), ("tr07_rule_risk_score", "association_risk_score")])
def test_rules_are_found(spark, name, column):
    assert QUERIES[name](spark, "/root/testdata/sf0.01").select(column).distinct().count() >= 3
