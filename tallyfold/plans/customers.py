"""One row per customer, from billing rows or from a subscription event stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.functions.countries import region, trimmed_lower
from tallyfold.functions.store import duration_from_sku, price_by_platform
from tallyfold.operators import cohorts, lookups
from tallyfold.operators.picks import any_row, latest, pick_any

BILLING_COLUMNS = [
    "customer_id",
    "first_seen_date",
    "country",
    "platform",
    "has_refunded",
    "has_started_trial",
    "has_converted_trial_lenient",
    "has_converted_trial_strict",
    "product_id",
    "purchased_price_usd",
    *lookups.PRICE_FIELDS,
    "region",
]
ACTIVATION_COLUMNS = [
    "customer_id",
    "first_seen_date",
    "app_name",
    "country",
    "platform",
    "has_refunded",
    "has_started_trial",
    "has_started_trial_date",
    "has_converted_trial",
    "has_started_direct_subscription",
    "user_activated_at",
    "product_id",
    "currency",
    "customer_price_in_usd",
    "expected_proceeds_in_usd",
    "customer_price_in_currency",
    "expected_proceeds_in_currency",
    "duration",
    "region",
]
# The two event tables disagree on the types of these, and nobody reads them.
UNSHARED_EVENT_COLUMNS = ["transaction_id", "subscription_group", "app_id"]


def customer_rollup(
    billing: DataFrame, products: DataFrame, product="any", priced=None
) -> DataFrame:
    """Billing rows to customers; `product` is "any" or "latest" (by start time).

    `has_refunded` holds the time of the last refund. `priced` is as in `priced_by_pairs`.
    """
    picks = {
        "any": pick_any("product_identifier"),
        "latest": latest("product_identifier", "start_time") if product == "latest" else None,
    }
    if product not in picks:
        raise ValueError(f"product must be one of {', '.join(picks)}")
    signals = cohorts.billing_signals()
    book = lookups.price_book(products)
    by_pairs = lookups.priced_by_pairs(billing.sparkSession, priced)
    country, sku = trimmed_lower("country"), "product_identifier"
    rows = billing if by_pairs else lookups.attach_prices(billing, book, country, sku)
    pair = F.collect_set(lookups.price_pair(country, sku)).alias("pairs")
    rolled = rows.groupBy(cohorts.BILLING_ID).agg(
        F.min(F.to_date("first_seen_time")).alias("first_seen_date"),
        pick_any("country").alias("country"),
        pick_any("platform").alias("platform"),
        F.max("refunded_at").alias("has_refunded"),
        *[any_row(p).alias(name) for name, p in signals.items()],
        picks[product].alias("product_id"),
        F.max("purchase_price_in_usd").alias("purchased_price_usd"),
        pair if by_pairs else F.min("prices").alias("prices"),
    )
    if by_pairs:
        rolled = lookups.price_rolled(rolled, book, cohorts.BILLING_ID)
    trial = F.col(cohorts.BILLING_ID).isNotNull() & F.col("trial")
    return (
        rolled.withColumns(
            {
                "has_started_trial": trial,
                "has_converted_trial_lenient": trial & F.col("kept_conversion"),
                "has_converted_trial_strict": trial & F.col("conversion") & ~F.col("refunded"),
                "region": region("country"),
                **lookups.price_columns(),
            }
        )
        .withColumnRenamed(cohorts.BILLING_ID, "customer_id")
        .select(*BILLING_COLUMNS)
    )


def union_events(android: DataFrame, ios: DataFrame) -> DataFrame:
    """Both event tables without the columns they do not share."""
    return android.drop(*UNSHARED_EVENT_COLUMNS).unionByName(ios.drop(*UNSHARED_EVENT_COLUMNS))


def user_events_rollup(events: DataFrame) -> DataFrame:
    """One row per user with event times, latest product and greatest amounts."""

    def time_of(event):
        return F.max(F.when(cohorts.event_is(event), F.col(cohorts.EVENT_TIME)))

    def greatest(text):
        return F.max(F.col(text).try_cast("double"))

    return events.groupBy(cohorts.EVENT_ID).agg(
        F.min(F.to_date("install_ts")).alias("first_seen_date"),
        pick_any("app_name").alias("app_name"),
        pick_any("country").alias("country"),
        pick_any("platform").alias("platform"),
        F.max("refund").alias("has_refunded"),
        any_row(cohorts.event_is("Trial Started")).alias("trial"),
        time_of("Trial Started").alias("trial_at"),
        time_of("Subscription Started").alias("direct_at"),
        latest("product_id", cohorts.EVENT_TIME).alias("product_id"),
        pick_any("currency").alias("currency"),
        greatest("price_usd").alias("customer_price_in_usd"),
        greatest("proceeds_usd").alias("expected_proceeds_in_usd"),
        greatest("price").alias("customer_price_in_currency"),
        greatest("proceeds").alias("expected_proceeds_in_currency"),
    )


def activation_rollup(
    android: DataFrame, ios: DataFrame, products: DataFrame, allow_fanout=False
) -> DataFrame:
    """Subscription events to users, each activated by trial or directly.

    Conversions are judged per (user, time). Only the few rows that can decide
    one take that second path, and its result is one time per user, joined on
    the partitioning the main rollup already has.

    `allow_fanout` keeps one output row per matching product row.
    """
    events = union_events(android, ios)
    converted = (
        cohorts.conversion_moments(events)
        .groupBy(cohorts.EVENT_ID)
        .agg(F.max(cohorts.EVENT_TIME).alias("converted_at"))
    )
    has_id = F.col(cohorts.EVENT_ID).isNotNull()
    trial = has_id & F.col("trial")
    users = (
        user_events_rollup(events)
        .join(converted, cohorts.EVENT_ID, "left")
        .withColumns(
            {
                "has_started_trial": trial,
                "has_started_trial_date": F.when(has_id, F.col("trial_at")),
                "direct_at": F.when(has_id, F.col("direct_at")),
                "converted_at": F.when(trial, F.col("converted_at")),
            }
        )
        .withColumns(cohorts.attribute_activation("converted_at", "direct_at"))
    )
    book = lookups.price_book(products, extended=True, unique=not allow_fanout)
    priced = lookups.attach_prices(users, book, trimmed_lower("country"), "product_id")
    amounts = {
        name: price_by_platform("platform", F.col(f"prices.{name}"), F.col(name))
        for name in lookups.PRICE_FIELDS
        if name != "duration"
    }
    return (
        priced.withColumns(
            {
                **amounts,
                "duration": duration_from_sku("product_id"),
                "region": region("country", fv.EUROPE_ACTIVATION),
            }
        )
        .withColumnRenamed(cohorts.EVENT_ID, "customer_id")
        .select(*ACTIVATION_COLUMNS)
    )
