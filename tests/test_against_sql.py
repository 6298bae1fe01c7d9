"""Quick registered queries against their SQL twins on the smallest tables; all of them run with
``python -m checks.compare``."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, open_tables

SF = "/root/testdata/sf0.001"
QUICK = ["rule_cascade", "sliding_pair_stats_by_pane", "json_decode", "edge_latest", "metrics_summary",
         "wallet_context", "forest_nodes", "forest_scores", "pagerank_k", "edge_collapse", "detector_report",
         "louvain_two_rounds", "modularity", "fastrp", "window_report_scored", "wash_rings", "top_risk_wallets"]


def test_every_twin_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    rows = entry(spark)
    assert rows.count() > 0 and "rule_reason" in rows.columns


@pytest.mark.parametrize("name", QUICK)
def test_same_rows(spark, name):
    assert compare(queries()[name](spark, SF), open_tables(SF), oracle_sql()[name]) == ""


def test_latest_labelled_where_there_are_more_than_its_limit(spark):
    folder = "/root/testdata/sf0.01"
    found = queries()["latest_labelled"](spark, folder)
    assert compare(found, open_tables(folder), oracle_sql()["latest_labelled"]) == ""
