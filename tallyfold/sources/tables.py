"""Declared source tables: names, schemas and a checked read."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold import fixed_values as fv
from tallyfold.rules import APPS, LABELS, RATES

IOS_NOTIFICATION = """
    originalTransactionId string, NotificationType string, SubType string,
    offerDiscountType string, ProductId string, renewalProductId string,
    purchaseDate timestamp, firstTransactionDate timestamp, countryCode string,
    bundleId string, AppAppleId string, currency string, renewalCurrency string
"""
PLAY_NOTIFICATION = """
    latestOrderId string, productId string, basePlanId string,
    subscriptionState string, offerPhase string, startTime timestamp,
    regionCode string, packageName string, currencyCode string
"""
PRODUCTS = """
    country string, product_SKU string, customer_price_in_currency double,
    customer_price_in_usd double, expected_proceeds_in_currency double,
    expected_proceeds_in_usd double, duration string
"""
BILLING_UNDATED = """
    rc_original_app_user_id string, first_seen_time timestamp,
    country string, platform string, product_identifier string,
    purchase_price_in_usd double, is_trial_period boolean, is_sandbox boolean,
    is_trial_conversion boolean, ownership_type string, refunded_at timestamp
"""
# The start time is needed where the latest product is picked.
BILLING = BILLING_UNDATED + ", start_time timestamp"
SUBSCRIPTION_EVENT = """
    q_user_id string, event_ts timestamp, event_name string, install_ts timestamp,
    app_name string, platform string, country string, currency string,
    product_id string, price string, proceeds string, price_usd string,
    proceeds_usd string, refund string
"""
SPEND = """
    date date, ad_account string, country string, spend double, campaign_id string,
    campaign_name string, adgroup_id string, adgroup_name string, currency string
"""
ACCOUNTS = "channel string, ad_account string, account_id string, is_new boolean"

#: Schema of the tables that hold the rules of a deployment, and the tables.
RULE_SCHEMA = "Rules"
RULE_TABLES = {"Apps": APPS, "Labels": LABELS, "Rates": RATES, "Accounts": ACCOUNTS}

# Fixed values: (source, table) as declared in the warehouse, their schema there
# and their columns.
SOURCES = {
    ("asc", "Notification"): ("AppStoreConnect", IOS_NOTIFICATION),
    ("googleplay", "Notification"): ("GooglePlay", PLAY_NOTIFICATION),
    ("core", "Products"): ("Staging_Core", PRODUCTS),
    ("raw", "Products"): ("Revenue", PRODUCTS),
    **{
        ("raw", table): ("Revenue", BILLING if product == "latest" else BILLING_UNDATED)
        for table, product in fv.BILLING_MODELS.values()
    },
    **{("raw", table): ("Revenue", SUBSCRIPTION_EVENT) for table in fv.EVENT_TABLES},
    **{("ads", table): (fv.SPEND_SCHEMA, SPEND) for table in fv.SPEND_TABLES.values()},
    **{("rules", table): (RULE_SCHEMA, ddl) for table, ddl in RULE_TABLES.items()},
}

#: Columns by whose buckets a copy of a table may be laid out, so that its rollup shuffles no events.
LAYOUTS = {
    ("asc", "Notification"): "originalTransactionId",
    ("googleplay", "Notification"): "base_order_id",
    **{("raw", table): "rc_original_app_user_id" for table, _ in fv.BILLING_MODELS.values()},
}

# Headings of the event export that are not the snake case of themselves.
EVENT_HEADINGS = {"event receive date": "event_ts", "install date": "install_ts"}


class SchemaMismatch(ValueError):
    pass


def snake_case(rows: DataFrame) -> DataFrame:
    """Spaced headings (`Q user id`), in any letter case, as plain names (`q_user_id`)."""
    names = [" ".join(c.lower().split()) for c in rows.columns]
    return rows.toDF(*[EVENT_HEADINGS.get(n, n.replace(" ", "_")) for n in names])


def conform_to(rows: DataFrame, ddl) -> DataFrame:
    """The declared columns, found by name in any letter case.

    A missing column or one of another type is an error; the two timestamp
    types stand for each other, and where text is declared any plain value is
    read as its text. Other columns are not read.
    """
    found = {f.name.lower(): f for f in rows.schema.fields}
    problems, columns = [], []
    for want in StructType.fromDDL(ddl).fields:
        have = found.get(want.name.lower())
        if have is None:
            problems.append(f"{want.name} is missing")
            continue
        kind, wanted = have.dataType.typeName(), want.dataType.typeName()
        column = F.col(f"`{have.name}`")
        if wanted == "string" and kind not in ("array", "map", "struct", "binary"):
            column = column.cast("string")
        elif kind.removesuffix("_ntz") != wanted:
            problems.append(f"{want.name} is {kind}, not {wanted}")
        columns.append(column.alias(want.name))
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return rows.select(*columns)


def layout_name(source, table):
    """(schema, name) of the laid-out copy of a table."""
    return SOURCES[source, table][0], f"{table}_by_id"


def read_source(spark: SparkSession, source, table, path=None, laid_out=False) -> DataFrame:
    """A declared table, from the catalog or from a Parquet path.

    With `laid_out` its copy in buckets is read where there is one; that has the column of its
    buckets, too.
    """
    if (source, table) not in SOURCES:
        raise KeyError(f"no source table {source}.{table}")
    schema, ddl = SOURCES[source, table]
    if laid_out and (source, table) in LAYOUTS:
        copy = ".".join(f"`{part}`" for part in layout_name(source, table))
        if spark.catalog.tableExists(copy):
            key = LAYOUTS[source, table]
            known = StructType.fromDDL(ddl).names
            return conform_to(spark.table(copy), ddl if key in known else f"{ddl}, {key} string")
    rows = spark.read.parquet(path) if path else spark.table(f"`{schema}`.`{table}`")
    if ddl is SUBSCRIPTION_EVENT:
        rows = snake_case(rows)
    return conform_to(rows, ddl)
