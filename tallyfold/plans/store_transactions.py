"""One row per store transaction, from append-only notifications.

Every flag, pick and date comes out of a single aggregation per store: one scan
of the events and one shuffle on the transaction id.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.functions.countries import country_upper, trimmed_lower
from tallyfold.functions.store import app_name, composite_sku, is_known_bundle
from tallyfold.operators import cohorts, lookups
from tallyfold.operators.picks import any_row, latest, pick_any
from tallyfold.rules import EXAMPLE

COLUMNS = [
    "TransactionId",
    "first_transaction_date",
    "has_started_trial",
    "has_converted_trial",
    "has_direct_purchase",
    "country",
    "product_id",
    "bundle_id",
    "app_apple_id",
    "customer_price_in_currency",
    "currency",
    "customer_price_in_usd",
    "expected_proceeds_in_currency",
    "expected_proceeds_in_usd",
    "duration",
    "platform",
    "app_name",
]
ANDROID_COLUMNS = [c for c in COLUMNS if c != "app_apple_id"]


def ios_transactions(notifications: DataFrame, products: DataFrame, rules=EXAMPLE) -> DataFrame:
    """iOS transactions of the known apps.

    Flags, latest product and country look at all rows of an id; the date and
    the plain picks only at rows of a known app. A null id has no flags, country
    or product of its own.
    """
    key = F.col(cohorts.IOS_ID)
    signals = cohorts.ios_signals()
    known = is_known_bundle("bundleId", rules)
    country = country_upper("countryCode")

    def of_known(value):
        return F.when(known, value)

    rolled = notifications.groupBy(key).agg(
        any_row(known).alias("listed"),
        any_row(signals["trial"]).alias("trial"),
        any_row(signals["renewed"]).alias("renewed"),
        F.min(of_known(F.to_date("firstTransactionDate"))).alias("first_transaction_date"),
        pick_any(country).alias("country"),
        # Two-letter keys, so the set stays small however many rows an id has.
        F.collect_set(country).alias("countries"),
        latest(F.coalesce("ProductId", "renewalProductId"), "purchaseDate").alias("product_id"),
        pick_any(of_known(F.col("bundleId"))).alias("bundle_id"),
        pick_any(of_known(F.col("AppAppleId").cast("string"))).alias("app_apple_id"),
        pick_any(of_known(F.coalesce("currency", "renewalCurrency"))).alias("currency"),
    )
    has_id = key.isNotNull()
    trial = has_id & F.col("trial")
    flagged = rolled.filter("listed").withColumns(
        {
            "has_started_trial": trial,
            "has_converted_trial": trial & F.col("renewed"),
            "has_direct_purchase": ~trial,
            "country": F.when(has_id, F.col("country")),
            "product_id": F.when(has_id, F.col("product_id")),
        }
    )
    book = lookups.price_book_by_sku(products)
    keyed = flagged.withColumn("price_sku", F.col("product_id"))
    priced = lookups.spread_join(keyed, book, ["price_sku"]).withColumn(
        "prices", lookups.best_price("countries", F.col("prices_by_country"))
    )
    return (
        priced.withColumns(lookups.price_columns())
        .withColumns({"platform": F.lit(fv.PLATFORM_IOS), "app_name": app_name("bundle_id", rules)})
        .withColumnRenamed(cohorts.IOS_ID, "TransactionId")
        .select(*COLUMNS)
    )


def play_transactions(
    notifications: DataFrame, products: DataFrame, rules=EXAMPLE, priced=None
) -> DataFrame:
    """Android transactions of the known apps, renewals folded into their base order.

    `priced` is as in `priced_by_pairs`.
    """
    signals = cohorts.play_signals()
    rows = cohorts.with_base_order(notifications).withColumn(
        "sku", composite_sku("productId", "basePlanId")
    )
    book = lookups.price_book(products)
    by_pairs = lookups.priced_by_pairs(notifications.sparkSession, priced)
    country = trimmed_lower("regionCode")
    rows = rows if by_pairs else lookups.attach_prices(rows, book, country, "sku")
    pair = F.collect_set(lookups.price_pair(country, "sku")).alias("pairs")
    rolled = rows.groupBy(cohorts.PLAY_ID).agg(
        any_row(signals["trial"]).alias("trial"),
        any_row(signals["renewed"]).alias("renewed"),
        any_row(signals["direct"]).alias("direct"),
        F.min(F.when(cohorts.is_base_order(), F.to_date("startTime"))).alias(
            "first_transaction_date"
        ),
        pick_any("regionCode").alias("country"),
        pick_any("sku").alias("product_id"),
        pick_any("packageName").alias("bundle_id"),
        pick_any("currencyCode").alias("currency"),
        pick_any(app_name("packageName", rules)).alias("app_name"),
        pair if by_pairs else F.min("prices").alias("prices"),
    )
    if by_pairs:
        rolled = lookups.price_rolled(rolled, book, cohorts.PLAY_ID)
    # base_order_id is null only when the order id is, and then no signal can
    # hold but the renewal one, which counts for trials alone.
    return (
        rolled.filter(F.col("app_name").isNotNull())
        .withColumns(
            {
                "has_started_trial": F.col("trial"),
                "has_converted_trial": F.col("trial") & F.col("renewed"),
                "has_direct_purchase": F.col("direct"),
                "platform": F.lit(fv.PLATFORM_ANDROID),
                **lookups.price_columns(),
            }
        )
        .withColumnRenamed(cohorts.PLAY_ID, "TransactionId")
        .select(*ANDROID_COLUMNS)
    )


def unified_transactions(ios: DataFrame, android: DataFrame) -> DataFrame:
    """Both stores in one table; Android has no Apple app id."""
    filled = android.withColumn("app_apple_id", F.lit(None).cast("string"))
    return ios.select(*COLUMNS).unionByName(filled.select(*COLUMNS))
