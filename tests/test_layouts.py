"""Event tables in buckets: the rollup over them moves no events and gives the same rows."""

import pytest

from conftest import plan_of
from tallyfold import fixed_values as fv
from tallyfold.plans import layouts, models
from tallyfold.rules import EXAMPLE
from tallyfold.sinks.tables import write_model
from tallyfold.sources import tables

BUNDLE = list(fv.APP_BY_BUNDLE)[0]
BILLING = fv.BILLING_MODELS["meadow_customers"][0]


def events(key):
    """Forty ids with five rows each."""
    if key == ("asc", "Notification"):
        return [
            {"originalTransactionId": f"t{i}", "bundleId": BUNDLE, "ProductId": f"p{n}", "countryCode": "FR", "NotificationType": "DID_RENEW", "offerDiscountType": "FREE_TRIAL" if i % 3 else None}
            for i in range(40) for n in range(5)
        ]
    if key == ("googleplay", "Notification"):
        return [
            {"latestOrderId": f"o{i}" + (f"..{n}" if n else ""), "packageName": BUNDLE, "productId": "p1", "regionCode": "FR", "subscriptionState": "SUBSCRIPTION_STATE_ACTIVE", "offerPhase": "FREE_TRIAL"}
            for i in range(40) for n in range(5)
        ]
    return [{"rc_original_app_user_id": f"u{i}", "country": "FR", "product_identifier": f"p{n}", "is_trial_period": n == 0} for i in range(40) for n in range(5)]


@pytest.fixture
def paths(rows, tmp_path):
    found = {}
    for key, (_, ddl) in tables.SOURCES.items():
        found[key] = str(tmp_path / "_".join(key))
        records = events(key) if key in tables.LAYOUTS else [{"country": "FRA", "product_SKU": f"p{n}", "customer_price_in_usd": 1.0 + n} for n in range(3)] if ddl is tables.PRODUCTS else [{}]
        rows(ddl, *records).repartition(3).write.parquet(found[key])
    return found


@pytest.fixture
def no_copies(spark):
    yield
    for schema in ("AppStoreConnect", "GooglePlay", "Revenue"):
        spark.sql(f"DROP SCHEMA IF EXISTS `{schema}` CASCADE")


@pytest.mark.parametrize("name, source", [(models.IOS, ("asc", "Notification")), (models.ANDROID, ("googleplay", "Notification")), ("meadow_customers", ("raw", BILLING))])
def test_a_rollup_of_buckets_moves_no_events(spark, paths, no_copies, name, source):
    key = tables.LAYOUTS[source]
    plain = models.model(spark, name, paths, EXAMPLE)
    assert f"hashpartitioning({key}#" in plan_of(plain)
    layouts.lay_out(spark, *source, 4, paths[source])
    got = models.model(spark, name, paths, EXAMPLE, laid_out=True)
    plan = plan_of(got)
    assert f"Exchange hashpartitioning({key}#" not in plan and "Bucketed: true" in plan
    rows = got.collect()
    assert len(rows) == 40 and sorted(rows) == sorted(plain.collect())


def test_hot_ids_are_refused(spark, rows, tmp_path, no_copies):
    path = str(tmp_path / "hot")
    hot = [{"originalTransactionId": None if i % 3 else f"t{i}"} for i in range(300)]
    rows(tables.IOS_NOTIFICATION, *hot).write.parquet(path)
    with pytest.raises(layouts.HotId, match="200 of 300"):
        layouts.lay_out(spark, "asc", "Notification", 8, path)
    # Without a copy the table itself is read.
    assert tables.read_source(spark, "asc", "Notification", path, laid_out=True).count() == 300


def test_a_copy_is_replaced_whole(spark, paths, no_copies):
    for buckets in (4, 2):
        layouts.lay_out(spark, "asc", "Notification", buckets, paths["asc", "Notification"])
        copy = tables.read_source(spark, "asc", "Notification", laid_out=True)
        assert copy.count() == 200 and copy.rdd.getNumPartitions() <= 4
    assert write_model(spark.range(3), "Revenue", "Plain") == "`Revenue`.`Plain`"
