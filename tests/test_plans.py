"""Properties of the physical plans that keep them usable at scale."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

QUERIES = entry.queries()


def plan(spark, key):
    return QUERIES[key](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["q_agg_q21", "q_agg_q32", "q_agg_q42", "q_agg_q82", "q_agg_v_tenure", "q_flt_subset"])
def test_line_items_are_not_read_when_no_count_is_needed(spark, key):
    assert "lineitem.parquet" not in plan(spark, key)


def test_line_items_are_folded_before_their_join(spark):
    text = plan(spark, "q_agg_q33")
    assert re.search(r"Join .*l_orderkey.*LeftOuter[\s\S]*HashAggregate\(keys=\[l_orderkey", text)


def test_scan_reads_only_needed_columns(spark):
    text = plan(spark, "q_agg_q33")
    assert "l_extendedprice" not in text and "l_shipdate" not in text and "o_totalprice" not in text


def test_filter_on_id_rule_reaches_the_scan(spark):
    assert re.search(r"FileScan parquet \[c_custkey.*DataFilters: \[.*c_custkey", plan(spark, "q_flt_neq"))


def test_top_k_is_no_global_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "q_agg_q61")


CHEAP = [k for k in QUERIES if re.match(r"q_(agg_q|agg_sp|agg_v|agg_nb|fe_|bkt_|cln_|flt_|prj_|enc_bin|val_|sco_r|st_t|ev_conf)", k)]


@pytest.mark.parametrize("key", CHEAP)
def test_no_cross_join_and_no_python_rows(spark, key):
    text = plan(spark, key)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


def test_newest_run_is_a_partition_filter(spark):
    from stayrate.session import shared_path
    from stayrate.sources.readers import latest_run

    path = shared_path(spark, "runs")
    for run in ("20240101_000000", "20240301_000000", "20240201_000000"):
        rows = spark.range(3).selectExpr("id", f"'{run}' AS run_ts", "'train' AS split")
        rows.write.mode("append").partitionBy("run_ts", "split").parquet(path)
    newest = latest_run(spark, path)
    assert {r["run_ts"] for r in newest.collect()} == {"20240301_000000"}
    scan = newest._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*run_ts", scan)
