"""Physical plans: no pairwise joins, no window over everything, pruned scans."""

import re

import pytest

from lagline.operators import evaluation as ev
from lagline.plans.examples import example_predictions
from lagline.queries import load_all
from lagline.sources.prepared import read_prepared, write_prepared
from lagline.sources.tables import LINE_KEY, order_lines

REGISTRY = load_all()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["m4_roc_auc", "m9_roc_curve", "m15_comparison_table", "m16_best_by_metric", "a4_class_distribution",
     "a7_distinct_values", "a10_histogram", "a12_contingency_with_margins", "a15_expected_counts",
     "c2_duplicate_count", "c6_fill_with_mode", "c9_outlier_summary", "c11_rare_to_other", "f3_standardised",
     "f7_stratified_split", "l3_class_weights", "l5_folds_of_five", "t4_top_categories"],
)
def test_no_pairwise_join_and_no_global_window(spark, sf, name):
    plan = plan_of(REGISTRY[name].run(spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*SinglePartition", plan)


@pytest.mark.parametrize("name", ["f7_stratified_split", "l5_folds_of_five", "f3_standardised", "c10_capped_values"])
def test_fitted_operators_apply_without_extra_shuffle(spark, sf, name):
    """Applying is a projection: the only exchange left is the spreading of small inputs."""
    plan = plan_of(REGISTRY[name].run(spark, sf))
    exchanges = re.findall(r"(?<!Broadcast)Exchange [^\n]*", plan)
    assert all("REPARTITION_BY_NUM" in e for e in exchanges)


def test_top_k_is_cut_before_the_shuffle(spark, sf):
    plan = plan_of(REGISTRY["t4_top_categories"].run(spark, sf))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scans_read_needed_columns_only(spark, sf):
    plan = plan_of(order_lines(spark, sf, ["late"]))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    read = {column.split("#")[0] for scan in scans for column in scan.split(",")}
    assert read == {*LINE_KEY, "l_shipdate", "o_orderkey", "o_orderdate", "o_orderpriority"}


def test_prepared_split_is_a_pruned_folder(spark, sf, tmp_path):
    lines = order_lines(spark, sf, ["sales", "line_status"]).withColumnRenamed("line_status", "split")
    write_prepared(lines, str(tmp_path / "p"))
    plan = plan_of(read_prepared(spark, str(tmp_path / "p"), "O"))
    assert re.search(r"PartitionFilters: \[[^\]]*split", plan)


def test_scores_are_aggregated_once(spark, sf):
    """Edges, offsets and totals reuse one shuffle; no bucket test runs below it."""
    df = ev.roc_auc(example_predictions(spark, sf))
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") <= 2
    below = [line for line in final.splitlines() if "Filter" in line and "size(filter(" in line]
    assert below == []
