"""A third of all rows under one id, or under none: results stay whole."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.operators import cohorts, lookups
from tallyfold.plans import customers, store_transactions
from tallyfold.sources import tables

N = 6000
KNOWN = list(fv.APP_BY_BUNDLE)


def user(i):
    return {0: "hot", 1: None}.get(i % 3, f"u{i % 500}")


@pytest.fixture(scope="module")
def ios_events(rows):
    rng = random.Random(7)
    kinds = ["SUBSCRIBED", "DID_RENEW", "EXPIRED", "REFUND", "DID_FAIL_TO_RENEW"]
    return [
        {
            "originalTransactionId": user(i),
            "NotificationType": rng.choice(kinds),
            "offerDiscountType": "FREE_TRIAL" if rng.random() < 0.05 else None,
            "ProductId": rng.choice(["p", "q", None]),
            "renewalProductId": rng.choice(["p", "r"]),
            "purchaseDate": dt.datetime(2025, 1, 1) + dt.timedelta(minutes=rng.randrange(400)),
            "firstTransactionDate": dt.datetime(2025, 1, 1 + rng.randrange(28)),
            "countryCode": rng.choice(["USA", "FR", "deu", None]),
            "bundleId": rng.choice([*KNOWN, "x"]),
            "currency": rng.choice(["USD", "EUR"]),
        }
        for i in range(N)
    ]


def test_ios_rollup_against_brute_force(rows, ios_events):
    short = {"USA": "US", "FR": "FR", "deu": "DE", None: ""}
    prices = {("US", "p"): 4.0, ("FR", "p"): 3.0, ("DE", "r"): 2.0}
    catalogue = rows(
        tables.PRODUCTS,
        *[{"country": c, "product_SKU": s, "customer_price_in_usd": v} for (c, s), v in prices.items()],
    )
    groups = {}
    for e in ios_events:
        groups.setdefault(e["originalTransactionId"], []).append(e)
    want = {}
    for key, events in groups.items():
        listed = [e for e in events if e["bundleId"] in KNOWN]
        if not listed:
            continue
        trial = key is not None and any(e["offerDiscountType"] for e in events)
        sold = [(e["purchaseDate"], e["ProductId"] or e["renewalProductId"]) for e in events]
        product = max(sold)[1]
        places = {short[e["countryCode"]] for e in events}
        found = [prices[c, product] for c in places if (c, product) in prices]
        want[key] = (
            min(e["firstTransactionDate"] for e in listed).date(),
            trial,
            trial and any(e["NotificationType"] == "DID_RENEW" for e in events),
            not trial,
            min(places) if key else None,
            product if key else None,
            min(e["bundleId"] for e in listed),
            min(e["currency"] for e in listed),
            min(found) if key and found else None,
        )
    frame = rows(tables.IOS_NOTIFICATION, *ios_events).repartition(8)
    got = store_transactions.ios_transactions(frame, catalogue).select(
        "TransactionId", "first_transaction_date", "has_started_trial", "has_converted_trial",
        "has_direct_purchase", "country", "product_id", "bundle_id", "currency", "customer_price_in_usd",
    )
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


def test_event_conversions_against_brute_force(rows):
    rng = random.Random(11)
    names = ["Trial Started", "Trial Converted", "Trial Canceled", "Trial Expired", "Subscription Started"]
    events = [
        {
            "q_user_id": user(i),
            "event_name": rng.choices(names, [1, 3, 1, 1, 2])[0],
            "event_ts": dt.datetime(2025, 1, 1) + dt.timedelta(minutes=rng.randrange(900)),
            "install_ts": dt.datetime(2025, 1, 1),
            "refund": "yes" if rng.random() < 0.05 else "",
        }
        for i in range(N)
    ]
    moments, trials, direct = {}, set(), {}
    for e in events:
        u, t = e["q_user_id"], e["event_ts"]
        if u is None:
            continue
        seen = moments.setdefault((u, t), [])
        seen += [e["event_name"]] + (["Refund"] if e["refund"] else [])
        if e["event_name"] == "Trial Started":
            trials.add(u)
        if e["event_name"] == "Subscription Started":
            direct[u] = max(t, direct.get(u, t))
    converted = {
        (u, t)
        for (u, t), seen in moments.items()
        if u in trials and "Trial Converted" in seen
        and not {"Trial Canceled", "Trial Expired", "Refund"} & set(seen)
    }
    frame = rows(tables.SUBSCRIPTION_EVENT, *events).repartition(8)
    assert {tuple(r) for r in cohorts.event_converted(frame).collect()} == converted
    rolled = customers.activation_rollup(
        frame.filter("event_name = 'Trial Started'"), frame.filter("event_name <> 'Trial Started'"),
        rows(tables.PRODUCTS, {}),
    )
    last = {}
    for u, t in converted:
        last[u] = max(t, last.get(u, t))
    for r in rolled.collect():
        c, d = last.get(r.customer_id), direct.get(r.customer_id)
        assert r.user_activated_at == min([t for t in (c, d) if t], default=None)
        assert r.has_converted_trial == bool(c and (d is None or c < d))


def test_spread_of_conversion_moments(spark, rows):
    """One user's events hash by time, so they do not meet in a single task."""
    hot = spark.range(4000).select(
        F.lit("hot").alias("q_user_id"),
        F.expr("timestamp'2025-01-01' + make_interval(0, 0, 0, 0, 0, id)").alias("event_ts"),
        F.lit("Trial Converted").alias("event_name"),
        F.lit("").alias("refund"),
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = cohorts.conversion_moments(hot).groupBy(F.spark_partition_id().alias("p")).count()
        sizes = [r["count"] for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(sizes) == 4000 and max(sizes) < 2000


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def splitting(spark):
    """Adaptive settings as for a cluster, at the size of a test."""
    before = {k: spark.conf.get(k, None) for k in SPLITTING}
    for key, value in SPLITTING.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_rows(spark, key="k"):
    """Two thirds of the rows have the key `hot`, the others spread."""
    ids = F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 997))
    rows = spark.range(0, 30000, 1, 16).select(ids.alias(key), F.col("id"))
    return rows.withColumn("pad", F.sha2(F.col("id").cast("string"), 256))


def split_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["restrict_to", "exclude", "flag_members", "attach_or_blank"])
def test_a_hot_key_is_split_over_tasks(spark, splitting, name):
    rows = hot_rows(spark)
    ids = rows.filter("id % 5 < 2").groupBy("k").agg(F.max("pad").alias("best"))
    chosen = ids.filter("k <> 'u7'").select("k")
    hits = rows.filter("k <> 'u7'").count()
    if name == "restrict_to":
        joined, expected = cohorts.restrict_to(rows, chosen, "k"), hits
    elif name == "exclude":
        joined, expected = cohorts.exclude(rows, chosen.filter("k <> 'hot'"), "k"), None
    elif name == "flag_members":
        joined, expected = cohorts.flag_members(rows, chosen, "k", "hit"), 30000
    else:
        joined, expected = lookups.attach_or_blank(rows, ids, "k", ["best"]), 30000
    assert "skew=true" in split_plan(joined)
    if expected:
        assert joined.count() == expected


def test_a_hot_product_is_split_over_tasks(spark, rows, splitting):
    facts = hot_rows(spark, "sku").withColumn(
        "country", F.expr("if(id % 4 = 0, 'de', 'fr')")
    )
    catalogue = rows(
        tables.PRODUCTS,
        *[{"country": "FRA", "product_SKU": s, "customer_price_in_usd": 2.0} for s in ("hot", "u7")],
    ).repartition(8)
    book = lookups.price_book(catalogue)
    priced = lookups.attach_prices(facts, book, F.col("country"), "sku")
    assert "skew=true" in split_plan(priced)
    assert priced.filter("prices.customer_price_in_usd = 2").count() == facts.filter(
        "sku IN ('hot', 'u7') AND country = 'fr'"
    ).count()
