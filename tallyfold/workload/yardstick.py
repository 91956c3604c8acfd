"""The rollups composed of id sets and joins: what the one-pass forms are timed against.

Same results, other plan: each cohort is its own scan and shuffle, attached to the
events by a left join, and the events are grouped last.
"""

from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.functions.countries import country_upper, region, trimmed_lower
from tallyfold.functions.store import app_name, composite_sku, is_known_bundle
from tallyfold.operators import cohorts, lookups
from tallyfold.operators.picks import any_row, latest, pick_any
from tallyfold.plans import customers, store_transactions
from tallyfold.workload import queries


def _flagged(rows, key, **sets):
    for name, ids in sets.items():
        rows = cohorts.flag_members(rows, ids, key, name)
    return rows


def ios_transactions(spark, folder):
    key = cohorts.IOS_ID
    events = queries.ios(spark, folder)
    newest = latest(F.coalesce("ProductId", "renewalProductId"), "purchaseDate")
    with_id = events.filter(F.col(key).isNotNull())
    products = with_id.groupBy(key).agg(newest.alias("product_id"))
    places = with_id.select(key, country_upper("countryCode").alias("country")).distinct()
    rows = _flagged(
        events.filter(is_known_bundle("bundleId")),
        key,
        trial=cohorts.ios_trials(events),
        renewed=cohorts.ios_converted(events),
    )
    joined = rows.join(products, key, "left").join(places, key, "left")
    book = lookups.price_book(queries.products(spark, folder))
    priced = lookups.attach_prices(joined, book, trimmed_lower("country"), "product_id")
    rolled = priced.groupBy(F.col(key).alias("TransactionId")).agg(
        F.min(F.to_date("firstTransactionDate")).alias("first_transaction_date"),
        any_row(F.col("trial")).alias("has_started_trial"),
        any_row(F.col("renewed")).alias("has_converted_trial"),
        any_row(~F.col("trial")).alias("has_direct_purchase"),
        pick_any("country").alias("country"),
        pick_any("product_id").alias("product_id"),
        pick_any("bundleId").alias("bundle_id"),
        pick_any("AppAppleId").alias("app_apple_id"),
        pick_any(F.coalesce("currency", "renewalCurrency")).alias("currency"),
        F.min("prices").alias("prices"),
    )
    return rolled.withColumns(
        {
            **lookups.price_columns(),
            "platform": F.lit(fv.PLATFORM_IOS),
            "app_name": app_name("bundle_id"),
        }
    ).select(*store_transactions.COLUMNS)


def play_transactions(spark, folder):
    events = queries.play(spark, folder)
    key = cohorts.PLAY_ID
    based = cohorts.with_base_order(events).withColumn(
        "sku", composite_sku("productId", "basePlanId")
    )
    rows = _flagged(
        based,
        key,
        trial=cohorts.play_trials(events),
        renewed=cohorts.play_converted(events),
        direct=cohorts.play_direct(events),
    )
    book = lookups.price_book(queries.products(spark, folder))
    priced = lookups.attach_prices(rows, book, trimmed_lower("regionCode"), "sku")
    rolled = priced.groupBy(F.col(key).alias("TransactionId")).agg(
        F.min(F.when(cohorts.is_base_order(), F.to_date("startTime"))).alias(
            "first_transaction_date"
        ),
        any_row(F.col("trial")).alias("has_started_trial"),
        any_row(F.col("renewed")).alias("has_converted_trial"),
        any_row(F.col("direct")).alias("has_direct_purchase"),
        pick_any("regionCode").alias("country"),
        pick_any("sku").alias("product_id"),
        pick_any("packageName").alias("bundle_id"),
        pick_any("currencyCode").alias("currency"),
        pick_any(app_name("packageName")).alias("app_name"),
        F.min("prices").alias("prices"),
    )
    return (
        rolled.filter(F.col("app_name").isNotNull())
        .withColumns({**lookups.price_columns(), "platform": F.lit(fv.PLATFORM_ANDROID)})
        .select(*store_transactions.ANDROID_COLUMNS)
    )


def unified_transactions(spark, folder):
    return store_transactions.unified_transactions(
        ios_transactions(spark, folder), play_transactions(spark, folder)
    )


def _customers(spark, folder, product_id):
    rows = queries.billing(spark, folder)
    joined = _flagged(
        rows,
        cohorts.BILLING_ID,
        trial=cohorts.billing_trials(rows),
        lenient=cohorts.billing_converted_lenient(rows),
        strict=cohorts.billing_converted_strict(rows),
    )
    book = lookups.price_book(queries.products(spark, folder))
    priced = lookups.attach_prices(joined, book, trimmed_lower("country"), "product_identifier")
    rolled = priced.groupBy(F.col(cohorts.BILLING_ID).alias("customer_id")).agg(
        F.min(F.to_date("first_seen_time")).alias("first_seen_date"),
        pick_any("country").alias("country"),
        pick_any("platform").alias("platform"),
        F.max("refunded_at").alias("has_refunded"),
        any_row(F.col("trial")).alias("has_started_trial"),
        any_row(F.col("lenient")).alias("has_converted_trial_lenient"),
        any_row(F.col("strict")).alias("has_converted_trial_strict"),
        product_id.alias("product_id"),
        F.max("purchase_price_in_usd").alias("purchased_price_usd"),
        F.min("prices").alias("prices"),
    )
    return rolled.withColumns({**lookups.price_columns(), "region": region("country")}).select(
        *customers.BILLING_COLUMNS
    )


def customer_rollup_any(spark, folder):
    return _customers(spark, folder, pick_any("product_identifier"))


def customer_rollup_latest(spark, folder):
    return _customers(spark, folder, latest("product_identifier", "start_time"))


YARDSTICK = {
    f.__name__: f
    for f in (
        ios_transactions,
        play_transactions,
        unified_transactions,
        customer_rollup_any,
        customer_rollup_latest,
    )
}
