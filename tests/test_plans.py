"""The shapes the jobs rely on at scale, read off their physical plans."""

import re

import pytest

from conftest import SMALL, plan_of
from tallyfold.workload.queries import QUERIES


def lines(spark, name):
    return plan_of(QUERIES[name](spark, SMALL)).splitlines()


def depth(line):
    return len(line) - len(line.lstrip(" :+-"))


@pytest.mark.parametrize(
    "name, key",
    [
        ("ios_transactions", "originalTransactionId"),
        ("play_transactions", "base_order_id"),
        ("customer_rollup_any", "rc_original_app_user_id"),
        ("customer_rollup_latest", "rc_original_app_user_id"),
    ],
)
def test_rollups_shuffle_the_events_once(spark, name, key):
    plan = lines(spark, name)
    exchanges = [x for x in plan if re.search(r"\bExchange hashpartitioning", x)]
    on_id = [x for x in exchanges if f"hashpartitioning({key}#" in x]
    # The only other shuffle is inside the catalogue the test tables imply.
    others = [x for x in exchanges if "hashpartitioning(sku#" in x]
    assert (len(on_id), len(exchanges)) == (1, 1 + len(others))
    assert any("partial_max" in x and f"keys=[{key}#" in x or "partial_max" in x and f"key=[{key}#" in x for x in plan)
    assert any("BroadcastHashJoin" in x for x in plan)
    assert not any("SortMergeJoin" in x for x in plan)


def test_spend_shuffles_nothing(spark):
    plan = "\n".join(lines(spark, "ad_spend"))
    assert "Exchange" not in plan and plan.count("FileScan") == 3


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = "\n".join(lines(spark, name))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan
    assert "FileScan parquet" in plan


def test_top_one_is_pruned_before_the_shuffle(spark):
    plan = lines(spark, "latest_product_window")
    place = {k: next(i for i, x in enumerate(plan) if k in x) for k in ("Final", "Exchange", "Partial")}
    assert place["Final"] < place["Exchange"] < place["Partial"]


def test_scans_read_only_what_is_used(spark):
    (scan,) = [x for x in lines(spark, "distinct_ids") if "FileScan" in x]
    assert "struct<ts:timestamp_ntz,user_id:bigint,props:string>" in scan
    (scan,) = [x for x in lines(spark, "composite_sku") if "FileScan" in x]
    assert "struct<l_partkey:bigint,l_tax:double>" in scan


def test_signal_filters_reach_the_scan(spark, rows, tmp_path):
    from tallyfold.operators import cohorts
    from tallyfold.sources import tables

    path = str(tmp_path / "events")
    rows(tables.IOS_NOTIFICATION, {}).write.parquet(path)
    plan = plan_of(cohorts.ios_converted(spark.read.parquet(path)))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "IsNotNull(originalTransactionId)" in pushed
    assert "EqualTo(offerDiscountType,FREE_TRIAL)" in pushed
    assert "EqualTo(NotificationType,DID_RENEW)" in pushed
