"""Plan-shape checks: no cartesian products, no Python UDF in relational
queries, pushed-down scan filters, bounded broadcasts, partial aggregation."""

import contextlib
import io
import re

import pytest

from tables import SF_SMALL
from portrait.plans.oracle import ORACLE_SQL
from portrait.plans.queries import QUERIES

ARROW_ALLOWED = {"eval_auc", "best_threshold", "ctr_threshold"}   # distributed running sums (mapInPandas)
LOOK_UP = {"install_features", "install_features_prefixed", "sparse_features", "train_predict_sets"}   # a list in a fixed vocabulary


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_no_cartesian_no_python(spark, key):
    p = plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and ("ArrowEvalPython" not in p or key in LOOK_UP)
    if key not in ARROW_ALLOWED:
        assert "MapInPandas" not in p


def test_scan_filter_pushed(spark):
    p = plan(QUERIES["scan_partition"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_install_lists_stay_where_they_are(spark):
    for key in ("install_features", "install_features_prefixed"):
        p = plan(QUERIES[key](spark, SF_SMALL))
        assert "Exchange" not in p and "Generate" not in p and "Join" not in p, key


def test_batch_scoring_is_one_scan(spark):
    p = plan(QUERIES["batch_score"](spark, SF_SMALL))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, flags=re.M)) == 1 and "Join" not in p and "Union" not in p


def test_latest_partition_reads_one_partition(spark):
    p = plan(QUERIES["latest_partition_table"](spark, SF_SMALL))
    assert re.search(r"PartitionFilters: \[isnotnull\(stat_date#\d+L?\), \(stat_date#\d+L? = \d{6}\)\]", p)


def test_result_sets_take_one_shuffle(spark):
    p = plan(QUERIES["multi_level_results"](spark, SF_SMALL))
    final = p[:p.index("Subqueries")] if "Subqueries" in p else p
    grouped = [m for m in re.findall(r"Arguments: hashpartitioning\(id#\d+, text#\d+", final)]
    assert len(grouped) == 1


def test_plan_report_counts_what_is_there(spark):
    from portrait.plans.report import summarize
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert summarize(df.where("user_id is not null"))["pushed_filters"] == "-"
    assert summarize(df.where("user_id = 3"))["pushed_filters"] == "yes"
    assert summarize(df.mapInArrow(lambda it: it, df.schema))["python"] == "yes"
    assert summarize(df.groupBy("user_id").applyInArrow(lambda t: t, df.schema))["python"] == "yes"


def test_dedupe_first_is_an_aggregate(spark):
    p = plan(QUERIES["dedupe_first"](spark, SF_SMALL))
    assert "Window" not in p
    assert "HashAggregate" in p or "ObjectHashAggregate" in p or "SortAggregate" in p


def test_badcase_sample_uses_group_limit(spark):
    p = plan(QUERIES["badcase_sample"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p
