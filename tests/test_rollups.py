import datetime as dt

import pytest

from conftest import SMALL, at
from tallyfold import fixed_values as fv
from tallyfold import rules as business
from tallyfold.plans import ad_spend, customers, store_transactions
from tallyfold.sources import tables
from tallyfold.workload import queries

KNOWN, OTHER = list(fv.APP_BY_BUNDLE)[:2]


def price(country, sku="p", amount=1.0, duration="1 month"):
    return {
        "country": country, "product_SKU": sku, "customer_price_in_currency": amount,
        "customer_price_in_usd": amount + 1, "expected_proceeds_in_currency": amount + 2,
        "expected_proceeds_in_usd": amount + 3, "duration": duration,
    }


def by_key(frame, key):
    found = {r[key]: r for r in frame.collect()}
    assert len(found) == frame.count()
    return found


def ios_row(i, day, bundle=KNOWN, **more):
    return {
        "originalTransactionId": i, "bundleId": bundle, "purchaseDate": at(day),
        "firstTransactionDate": at(day), **more,
    }


def test_ios_scope_of_the_bundle_filter(rows):
    """Flags and product see all rows; date and bundle only those of a known app."""
    events = rows(
        tables.IOS_NOTIFICATION,
        ios_row("a", 1, "unknown", offerDiscountType="FREE_TRIAL", ProductId="p", countryCode="FRA"),
        ios_row("a", 5, KNOWN, NotificationType="DID_RENEW", renewalProductId="q", currency="EUR"),
        ios_row("b", 2, "unknown"),
    )
    catalogue = rows(tables.PRODUCTS, price("FRA", "q", 4.0))
    got = by_key(store_transactions.ios_transactions(events, catalogue), "TransactionId")
    assert set(got) == {"a"}
    a = got["a"]
    assert (a.has_started_trial, a.has_converted_trial, a.has_direct_purchase) == (True, True, False)
    assert a.first_transaction_date == dt.date(2025, 1, 5)
    assert (a.bundle_id, a.product_id, a.currency) == (KNOWN, "q", "EUR")
    assert (a.country, a.customer_price_in_currency) == ("", 4.0)
    assert (a.platform, a.app_name) == ("iOS", fv.APP_BY_BUNDLE[KNOWN])


def test_ios_null_id_has_only_plain_picks(rows):
    events = rows(
        tables.IOS_NOTIFICATION,
        ios_row(None, 1, offerDiscountType="FREE_TRIAL", ProductId="p", countryCode="FR"),
        ios_row(None, 2, NotificationType="DID_RENEW", ProductId="p", countryCode="FR"),
    )
    (row,) = store_transactions.ios_transactions(events, rows(tables.PRODUCTS, price("FR"))).collect()
    assert (row.has_started_trial, row.has_converted_trial, row.has_direct_purchase) == (False, False, True)
    assert (row.country, row.product_id, row.customer_price_in_usd) == (None, None, None)
    assert (row.bundle_id, row.first_transaction_date) == (KNOWN, dt.date(2025, 1, 1))


def test_ios_prices_come_from_one_product_row(rows):
    events = rows(
        tables.IOS_NOTIFICATION,
        ios_row("a", 1, ProductId="p", countryCode="XX"),
        ios_row("a", 2, ProductId="p", countryCode="usa"),
        ios_row("a", 3, ProductId="p", countryCode="DE"),
    )
    catalogue = rows(
        tables.PRODUCTS, price("USA", amount=9.0), price("US", amount=8.0), price("DEU", amount=8.5)
    )
    (row,) = store_transactions.ios_transactions(events, catalogue).collect()
    assert [row[f] for f in store_transactions.lookups.PRICE_FIELDS] == [8.0, 9.0, 10.0, 11.0, "1 month"]
    assert row.country == "DE"


def play_row(order, **more):
    return {
        "latestOrderId": order, "packageName": KNOWN, "productId": "p", "regionCode": "fr",
        "subscriptionState": "SUBSCRIPTION_STATE_ACTIVE", **more,
    }


def test_play_rollup(rows):
    events = rows(
        tables.PLAY_NOTIFICATION,
        play_row("A", offerPhase="FREE_TRIAL", startTime=at(1)),
        play_row("A..0", offerPhase="FREE_TRIAL", startTime=at(8)),
        play_row("B..3", offerPhase="BASE", startTime=at(2)),
        play_row("C", offerPhase="BASE", startTime=at(3), basePlanId="m"),
        play_row("D", packageName="unknown"),
        play_row(None, offerPhase="FREE_TRIAL", startTime=at(4)),
    )
    catalogue = rows(tables.PRODUCTS, price("FRA", amount=3.0), price("FR", "p:m", 5.0))
    got = by_key(store_transactions.play_transactions(events, catalogue), "TransactionId")
    assert set(got) == {"A", "B", "C", None}
    flags = {
        k: (r.has_started_trial, r.has_converted_trial, r.has_direct_purchase) for k, r in got.items()
    }
    assert flags == {
        "A": (True, True, False), "B": (False,) * 3, "C": (False, False, True), None: (False,) * 3,
    }
    assert got["A"].first_transaction_date == dt.date(2025, 1, 1)
    assert got["B"].first_transaction_date is None
    assert got[None].first_transaction_date is None
    assert got["A"].customer_price_in_currency == 3.0
    assert (got["C"].product_id, got["C"].customer_price_in_currency) == ("p:m", 5.0)


def test_unified_columns_and_rows(spark):
    both = queries.QUERIES["unified_transactions"](spark, SMALL)
    assert both.columns == store_transactions.COLUMNS
    counts = {r["platform"]: r["count"] for r in both.groupBy("platform").count().collect()}
    assert counts["iOS"] == queries.QUERIES["ios_transactions"](spark, SMALL).count()
    assert counts["Android"] == queries.QUERIES["play_transactions"](spark, SMALL).count()
    assert both.filter("platform = 'Android' AND app_apple_id IS NOT NULL").isEmpty()


def billing_row(user, day, product="p", **more):
    return {
        "rc_original_app_user_id": user, "first_seen_time": at(day), "start_time": at(day),
        "product_identifier": product, "country": "US", **more,
    }


def test_customer_rollup_product_modes(rows):
    events = rows(
        tables.BILLING,
        billing_row("u", 3, "a", purchase_price_in_usd=2.0, refunded_at=at(9)),
        billing_row("u", 5, "z", purchase_price_in_usd=7.0),
        billing_row("u", 5, "b"),
        billing_row(None, 1, is_trial_period=True, is_sandbox=False),
    )
    catalogue = rows(tables.PRODUCTS, price("USA", "z"))
    least = by_key(customers.customer_rollup(events, catalogue), "customer_id")
    newest = by_key(customers.customer_rollup(events, catalogue, "latest"), "customer_id")
    assert (least["u"].product_id, newest["u"].product_id) == ("a", "z")
    u = least["u"]
    assert (u.has_refunded, u.purchased_price_usd, u.region) == (at(9), 7.0, "US/CA")
    assert u.customer_price_in_usd == 2.0
    assert u.first_seen_date == dt.date(2025, 1, 3)
    assert not least[None].has_started_trial
    with pytest.raises(ValueError):
        customers.customer_rollup(events, catalogue, "first")


def event_row(user, name, day, **more):
    return {
        "q_user_id": user, "event_name": name, "event_ts": at(day), "install_ts": at(day),
        "platform": "iOS", "country": "fr", "product_id": "month.x", "price_usd": "5", **more,
    }


def test_activation_rollup(rows):
    android = rows(
        tables.SUBSCRIPTION_EVENT + ", transaction_id bigint",
        event_row("a", "Trial Started", 1, platform="Android"),
        event_row("a", "Trial Converted", 4, platform="Android"),
        event_row("a", "Subscription Started", 6, platform="Android", price_usd="n/a"),
    )
    ios = rows(
        tables.SUBSCRIPTION_EVENT + ", transaction_id string",
        event_row("b", "Subscription Started", 2),
        event_row("c", "Trial Converted", 2),
        event_row(None, "Trial Started", 1), event_row(None, "Trial Converted", 2),
        event_row(None, "Subscription Started", 3),
    )
    catalogue = rows(tables.PRODUCTS, price("FRA", "month.x", 3.0), price("FR", "month.x", 2.0))
    got = by_key(customers.activation_rollup(android, ios, catalogue), "customer_id")
    state = {
        k: (r.has_started_trial, r.has_converted_trial, r.has_started_direct_subscription, r.user_activated_at)
        for k, r in got.items()
    }
    assert state == {
        "a": (True, True, False, at(4)),
        "b": (False, False, True, at(2)),
        "c": (False, False, False, None),
        None: (False, False, False, None),
    }
    assert got["a"].customer_price_in_usd == 5.0
    assert got["b"].customer_price_in_usd == 3.0
    assert (got["b"].duration, got["b"].region) == ("1 month", "Rest of The world")
    fanned = customers.activation_rollup(android, ios, catalogue, allow_fanout=True)
    assert fanned.filter("customer_id = 'b'").count() == 2


def test_invariants_on_the_test_tables(spark):
    one_per_id = {
        "ios_transactions": "TransactionId", "play_transactions": "TransactionId",
        "customer_rollup_any": "customer_id", "activation_rollup": "customer_id",
    }
    for name, key in one_per_id.items():
        frame = queries.QUERIES[name](spark, SMALL).select(key)
        assert frame.count() == frame.distinct().count()
    rolled = queries.QUERIES["customer_rollup_any"](spark, SMALL)
    assert rolled.filter("has_converted_trial_strict AND NOT has_converted_trial_lenient").isEmpty()
    active = queries.QUERIES["activation_rollup"](spark, SMALL)
    assert active.filter("has_converted_trial AND has_started_direct_subscription").isEmpty()
    pending, converted = (queries.QUERIES[f"ios_{n}"](spark, SMALL) for n in ("pending", "converted"))
    assert pending.intersect(converted).isEmpty()


def test_results_do_not_depend_on_the_broadcast_bound(spark):
    """Past the bound the price joins shuffle, and every row stays the same."""
    catalogue = queries.products(spark, SMALL)
    plans = [
        lambda: store_transactions.ios_transactions(queries.ios(spark, SMALL), catalogue),
        lambda: store_transactions.play_transactions(queries.play(spark, SMALL), catalogue),
        lambda: customers.customer_rollup(queries.billing(spark, SMALL), catalogue, "any"),
        lambda: customers.activation_rollup(*queries.event_sources(spark, SMALL), catalogue),
    ]
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    for plan in plans:
        small = sorted(map(str, plan().collect()))
        spark.conf.set(limit, "-1")
        try:
            assert sorted(map(str, plan().collect())) == small
        finally:
            spark.conf.set(limit, before)


def test_ad_spend_shape(rows):
    label = list(fv.META_APP_BY_LABEL)[0]
    meta = rows(tables.SPEND, {"ad_account": label, "spend": 10.0, "currency": "SGD", "campaign_name": "x"})
    asa = rows(
        tables.SPEND,
        {"ad_account": "any", "spend": 1.0, "campaign_name": "har one"},
        {"ad_account": "any", "spend": 1.0, "campaign_name": "other"},
        {"ad_account": "any", "spend": 1.0},
    )
    tiktok = rows(
        tables.SPEND, {"ad_account": list(fv.TIKTOK_APP_BY_LABEL)[0], "spend": 10.0, "currency": "USD"}
    )
    got = ad_spend.ad_spend(asa, meta, tiktok)
    assert got.columns == ad_spend.COLUMNS
    amounts = {r.channel: (r.spend_in_usd, r.platform) for r in got.collect()}
    assert amounts == {
        fv.CHANNEL_ASA: (1.0, "iOS"), fv.CHANNEL_META: (None, "iOS"), fv.CHANNEL_TIKTOK: (11.6, "iOS"),
    }


def test_spark_decides_what_is_broadcast(spark):
    """A small price book is broadcast without a hint, one past Spark's limit is not."""
    catalogue = queries.products(spark, SMALL)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)

    def plan():
        rows = store_transactions.play_transactions(queries.play(spark, SMALL), catalogue)
        rows.collect()
        return rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    assert "BroadcastHashJoin" in plan()
    spark.conf.set(limit, "-1")
    try:
        assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.set(limit, before)


def test_rules_from_tables(spark, rows):
    given = business.from_tables(
        spark.createDataFrame([("b.one", "One")], business.APPS),
        spark.createDataFrame([("meta", "Two", "T", 2), ("meta", "One", "O", 1), ("asa", "PRE", "P", 0), ("tiktok", "Tik", "K", 0)], business.LABELS),
        spark.createDataFrame([("asa", None, 1.0), ("tiktok", None, 2.0), ("meta", "USD", 3.0)], business.RATES),
    )
    assert list(given.meta_labels) == ["One", "Two"] and given.apps == {"b.one": "One"}
    meta = rows(tables.SPEND, {"ad_account": "One", "spend": 10.0, "currency": "USD", "campaign_name": "x"})
    asa = rows(tables.SPEND, {"ad_account": "a", "spend": 10.0, "campaign_name": "pre x"})
    tiktok = rows(tables.SPEND, {"ad_account": "my Tik", "spend": 10.0})
    got = {(r.ad_account, r.spend_in_usd) for r in ad_spend.ad_spend(asa, meta, tiktok, given).collect()}
    assert got == {("P", 10.0), ("O", 30.0), ("K", 20.0)}


@pytest.mark.parametrize("name, key", [("play", "base_order_id"), ("billing", "rc_original_app_user_id")])
def test_pricing_by_pairs_moves_events_once(spark, name, key):
    catalogue = queries.products(spark, SMALL)

    def priced(how):
        if name == "play":
            return store_transactions.play_transactions(queries.play(spark, SMALL), catalogue, priced=how)
        return customers.customer_rollup(queries.billing(spark, SMALL), catalogue, "latest", priced=how)

    assert sorted(map(str, priced("rows").collect())) == sorted(map(str, priced("pairs").collect()))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        plan = priced(None)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    # Above the event scan there is one shuffle, by id; the pairs meet the book above it.
    moves = [line.strip(" :+-") for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    by_pair = [i for i, line in enumerate(moves) if "hashpartitioning(price_country" in line]
    assert f"hashpartitioning({key}#" in moves[by_pair[0] + 1]
    assert sum(f"hashpartitioning({key}#" in line for line in moves) == 2 and "explode" in plan
    with pytest.raises(ValueError, match="rows or pairs"):
        priced("sku")
