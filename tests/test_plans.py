"""Shape of physical plans: pruned scans, pushed filters, limits below shuffles."""

from conftest import plan_of

from seqloom.operators import aggregates as agg
from seqloom.operators import catalog
from seqloom.operators import positions as at
from seqloom.plans import inputs


def test_scan_reads_only_needed_columns(spark, sf):
    plan = plan_of(agg.sum_of(inputs.table(spark, sf, "lineitem"), "l_linenumber", by="l_returnflag"))
    assert "ReadSchema: struct<l_linenumber:int,l_returnflag:string>" in plan


def test_counting_a_numbered_sequence_reads_no_column(spark, sf):
    plan = plan_of(agg.length(inputs.orders_seq(spark, sf)))
    assert "Window" not in plan and "ReadSchema: struct<>" in plan


def test_filters_reach_the_scan(spark, sf):
    plan = plan_of(catalog.children_of(inputs.table(spark, sf, "customer"), "c_nationkey", 3))
    assert "EqualTo(c_nationkey,3)" in plan


def test_dedup_limits_groups_before_the_shuffle(spark, sf):
    plan = plan_of(at.keep_last_by_key(inputs.events_in_order(spark, sf), "user_id"))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_global_numbering_moves_only_counts_to_one_task(spark, sf):
    plan = plan_of(inputs.orders_seq(spark, sf, "o_totalprice"))
    single = plan[plan.index("SinglePartition") :]
    assert "o_totalprice" not in single


def test_bridge_lookup_lets_spark_split_either_side(spark):
    bridge = spark.createDataFrame([("SRR1", "GSM1", "GSE1")], "SRR STRING, GSM STRING, GSE STRING").hint("merge")
    ids = spark.createDataFrame([("GSM1",), ("GSE2",), ("PRJ1",)], "id STRING").hint("merge")
    found = catalog.bridge_ids(ids, bridge)
    plan = plan_of(found)
    assert "Inner" in plan and "LeftAnti" in plan and "LeftOuter" not in plan
    assert {(r.id, r.kind, r.SRR) for r in found.collect()} == {("GSM1", "GSM", "SRR1"), ("GSE2", "GSE", None), ("PRJ1", None, None)}
