"""Domain relations as projections of the driver tables.

A relation is a list of branches (table, filter, columns). The expressions are
written in the SQL both Spark and the checking engine understand, so one text
defines the input of a query and of its check; only the operators under test are
written twice. Every column is computed row by row, without a join.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv

# Twenty-five ISO countries by nation key: regular and irregular short forms,
# one whose fallback collides (MTQ) and one whose fallback is merely wrong (GRL).
CODES3 = (
    "USA,CAN,FRA,GBR,DEU,JPN,BRA,AND,MTQ,GRL,ESP,ITA,EST,IRL,UKR,SRB,POL,PRT,SWE,MEX,"
    "KOR,CHN,AUS,ISR,TUR"
)
CODES2 = "US,CA,FR,GB,DE,JP,BR,AD,MQ,GL,ES,IT,EE,IE,UA,RS,PL,PT,SE,MX,KR,CN,AU,IL,TR"
EVENT_SKUS = "app.lifetime,app.yearly,premium.x,month.x,other"
BUNDLES = "|".join([*fv.APP_BY_BUNDLE, "com.example.unknown"])


def quoted(text):
    return "'" + text.replace("'", "''") + "'"


def item(texts, index, separator=","):
    """The index-th (from 0) of a separated list of texts."""
    return f"split_part({quoted(texts)}, '{separator}', cast({index} as int) + 1)"


def _near(label):
    """A label that contains the given one under LIKE but is not equal to it."""
    return f"EU {label.replace('_', 'X')} 2"


def _ids(channel, labels):
    return "|".join(fv.ACCOUNTS[channel].get(label, "0") for label in labels)


META_LABELS = [*fv.META_APP_BY_LABEL, "Another account", _near(list(fv.META_APP_BY_LABEL)[1])]
TIKTOK_LABELS = [*fv.TIKTOK_APP_BY_LABEL, "Another account", _near(list(fv.TIKTOK_APP_BY_LABEL)[-1])]
ASA_LABELS = [*fv.ACCOUNTS["asa"], "Another account"]
LABEL_NUMBER = "cast(floor(l_suppkey / 3) as bigint) % 7"

# props is {"k": <number>}
_K = "cast(substr(props, 7, length(props) - 7) as int)"
_USER_DAY = "cast(user_id as string) || '-' || cast(cast(ts as date) as string)"
IOS = [
    (
        "events",
        None,
        {
            "event_id": "event_id",
            "originalTransactionId": f"case when {_K} <> 98 then {_USER_DAY} end",
            "NotificationType": f"""case event_type
                when 'purchase' then case when {_K} % 10 = 0 then 'REFUND' else 'DID_RENEW' end
                when 'error' then 'DID_FAIL_TO_RENEW'
                when 'view' then 'EXPIRED' else 'SUBSCRIBED' end""",
            "SubType": """case event_type when 'click' then 'RESUBSCRIBE'
                when 'signup' then 'INITIAL_BUY' end""",
            "offerDiscountType": "case when event_type = 'signup' then 'FREE_TRIAL' end",
            "ProductId": f"""case when event_type <> 'purchase'
                then 'Brand#' || cast(1 + {_K} % 25 as string) end""",
            "renewalProductId": "'Brand#' || cast(1 + user_id % 25 as string)",
            "purchaseDate": "ts",
            "firstTransactionDate": "ts",
            "countryCode": f"""case when {_K} = 99 then null
                when {_K} % 3 = 0 then {item(CODES3, f'{_K} % 25')}
                when {_K} % 3 = 1 then {item(CODES2, f'{_K} % 25')}
                else lower({item(CODES3, f'{_K} % 25')}) end""",
            "bundleId": item(BUNDLES, f"(user_id + {_K} % 2) % 5", "|"),
            "AppAppleId": "'app' || cast(user_id % 5 as string)",
            "currency": f"case when {_K} % 2 = 0 then 'USD' end",
            "renewalCurrency": "'EUR'",
        },
    )
]
_BRAND = "'Brand#' || cast(1 + l_partkey % 25 as string)"
PLAY = [
    (
        "lineitem",
        None,
        {
            "latestOrderId": """case when l_orderkey % 97 <> 0 then
                'GPA.' || cast(l_orderkey as string) || case when l_linenumber = 1 then ''
                else '..' || cast(l_linenumber - 2 as string) end end""",
            "productId": _BRAND,
            "basePlanId": "case when l_tax > 0.045 then 'monthly' when l_tax < 0.005 then '' end",
            "subscriptionState": """case when l_linestatus = 'O' then 'SUBSCRIPTION_STATE_ACTIVE'
                else 'SUBSCRIPTION_STATE_EXPIRED' end""",
            "offerPhase": "case when l_returnflag = 'R' then 'BASE' else 'FREE_TRIAL' end",
            "startTime": "l_shipdate",
            "regionCode": item(CODES2, "l_suppkey % 25"),
            "packageName": item(BUNDLES, "l_orderkey % 5", "|"),
            "currencyCode": item("USD,EUR,GBP", "l_suppkey % 3"),
        },
    )
]
BILLING = [
    (
        "lineitem",
        None,
        {
            "rc_original_app_user_id": """case when l_orderkey % 89 <> 0
                then cast(l_orderkey as string) end""",
            "first_seen_time": "l_shipdate",
            "start_time": "l_shipdate",
            "country": item(CODES2, "l_suppkey % 25"),
            "platform": "case when l_orderkey % 2 = 0 then 'ios' else 'android' end",
            "product_identifier": _BRAND,
            "purchase_price_in_usd": "l_extendedprice",
            "is_trial_period": "l_returnflag = 'N'",
            "is_sandbox": "l_linenumber = 7",
            "is_trial_conversion": "l_returnflag = 'A' and l_linestatus = 'O'",
            "ownership_type": """case l_linenumber when 6 then 'FAMILY_SHARED' when 5 then null
                else 'PURCHASED' end""",
            "refunded_at": "case when l_discount > 0.075 then l_shipdate end",
        },
    )
]


def _subscription(platform, parity):
    text = "case when o_orderkey % 13 = 0 then 'n/a' else cast({} as string) end".format
    return (
        "orders",
        f"o_orderkey % 2 = {parity}",
        {
            "q_user_id": "case when o_custkey % 83 <> 0 then cast(o_custkey as string) end",
            "event_ts": "o_orderdate",
            "event_name": """case when o_orderstatus = 'P' and o_orderkey % 3 = 0
                then 'Subscription Canceled' else case substr(o_orderpriority, 1, 1)
                when '1' then 'Trial Started' when '2' then 'Trial Converted'
                when '3' then 'Subscription Started' when '4' then 'Trial Canceled'
                else 'Trial Expired' end end""",
            "install_ts": "o_orderdate",
            "app_name": item("Alpha,Beta,Gamma", "o_custkey % 3"),
            "platform": quoted(platform),
            "country": item(CODES2, "o_custkey % 25"),
            "currency": item("USD,EUR", "o_orderkey % 2"),
            "product_id": item(EVENT_SKUS, "o_orderkey % 5"),
            "price": text("o_totalprice"),
            "proceeds": text("o_totalprice * 0.5"),
            "price_usd": text("o_totalprice * 2"),
            "proceeds_usd": text("o_totalprice + 1"),
            "refund": "case when o_orderkey % 11 = 0 then 'yes' else '' end",
            "transaction_id": "o_orderkey" if parity else "cast(o_orderkey as string)",
            "subscription_group": "o_orderpriority",
            "app_id": "o_custkey" if parity else "cast(o_custkey as string)",
        },
    )


ANDROID_EVENTS = [_subscription(fv.PLATFORM_ANDROID, 1)]
IOS_EVENTS = [_subscription(fv.PLATFORM_IOS, 0)]


def _ads(number, account, account_id, campaign):
    """The rows of one of three channels; with no number, all rows as that channel's."""
    return (
        "lineitem",
        None if number is None else f"l_suppkey % 3 = {number}",
        {
            "date": "cast(l_shipdate as date)",
            "ad_account": account,
            "account_id": account_id,
            "country": item(CODES2, "l_suppkey % 25"),
            "spend": "l_extendedprice * l_discount",
            "campaign_id": "cast(l_partkey as string)",
            "campaign_name": campaign,
            "adgroup_id": "cast(l_orderkey as string)",
            "adgroup_name": "case when l_tax < 0.005 then '' else " + _BRAND + " end",
            "currency": item("USD,EUR,GBP,SGD", "l_suppkey % 4"),
            "line": "l_linenumber",
        },
    )


_NAMED = _BRAND + " || " + item("_Ios,_And,", "l_partkey % 3")
_ASA = (
    item("|".join(ASA_LABELS), "l_partkey % 2", "|"),
    item(_ids("asa", ASA_LABELS), "l_partkey % 2", "|"),
    f"""case l_partkey % 4 when 0 then 'har_' || {_BRAND} when 1 then 'HAR ' || l_returnflag
        else {_BRAND} end""",
)
_META = (
    item("|".join(META_LABELS), LABEL_NUMBER, "|"),
    item(_ids("meta", META_LABELS), LABEL_NUMBER, "|"),
    _NAMED,
)
_TIKTOK = (
    item("|".join(TIKTOK_LABELS), LABEL_NUMBER, "|"),
    item(_ids("tiktok", TIKTOK_LABELS), LABEL_NUMBER, "|"),
    _NAMED,
)
ASA_ADS, META_ADS, TIKTOK_ADS = [_ads(0, *_ASA)], [_ads(1, *_META)], [_ads(2, *_TIKTOK)]
# The whole table as one channel's, for the queries that look at one channel alone.
ASA_WHOLE, META_WHOLE, TIKTOK_WHOLE = [_ads(None, *_ASA)], [_ads(None, *_META)], [_ads(None, *_TIKTOK)]
ALL_ADS = [*ASA_ADS, *META_ADS, *TIKTOK_ADS]

# Search campaigns and ad-group details, before they are wrapped into pages. Each is fetched
# twice; what is missing in a fetch has a key there that is none.
def _campaigns(fetch, missing, name):
    return (
        "part",
        None,
        {
            "fetch_date": f"cast('{fetch}' as date)",
            "org_id": item(_ids("asa", ASA_LABELS), "p_partkey % 2", "|"),
            "campaign_id": f"case when {missing} then 'x' else '' end || cast(p_partkey as string)",
            "campaign_name": name,
        },
    )


CAMPAIGNS = [
    _campaigns("2025-01-01", "p_size % 4 = 0", "p_name"),
    _campaigns("2025-01-02", "p_size % 3 = 0", "'a renamed ' || p_name"),
]


def _details(fetch, missing, shift):
    return (
        "part",
        None,
        {
            "fetch_date": f"cast('{fetch}' as date)",
            "campaign_id": f"case when {missing} then 'x' else '' end || cast(p_partkey as string)",
            "countries": f"(p_size + {shift}) % 3",
            "first": item(CODES2, f"(p_partkey + {shift}) % 25"),
            "second": item(CODES2, "(p_partkey + 1) % 25"),
        },
    )


CAMPAIGN_DETAILS = [
    _details("2025-01-01", "p_size % 7 = 0", 0),
    _details("2025-01-02", "p_size % 5 = 0", 2),
]
TIKTOK_ACCOUNT = "|".join(fv.ACCOUNTS["tiktok"].values())


def _adgroups(page, missing, name):
    return (
        "orders",
        None,
        {
            "advertiser_id": item(TIKTOK_ACCOUNT, "o_orderkey % 7", "|"),
            "page": f"{page}",
            "code": "case when o_orderkey % 11 = 0 then 40001 else 0 end",
            "adgroup_id": f"case when {missing} then '' else cast(o_orderkey as string) end",
            "adgroup_name": name,
            "campaign_id": "case when o_orderkey % 6 <> 0 then cast(o_custkey as string) end",
            "campaign_name": "o_orderpriority",
        },
    )


ADGROUPS = [
    _adgroups(1, "o_orderkey % 5 = 0", "'z ' || o_orderpriority"),
    _adgroups(2, "o_orderkey % 3 <> 0", "'page 2 ' || o_orderstatus"),
]
_META_IDS = "|".join([*list(fv.ACCOUNTS["meta"].values())[:-1], "no such account"])
# Several pages for each account, fetched on different days, with different currencies.
META_ACCOUNTS = [
    (
        "nation",
        None,
        {
            "fetch_date": "cast('2025-01-01' as date) + cast(n_nationkey as int)",
            "account_id": item(_META_IDS, f"n_nationkey % {len(fv.ACCOUNTS['meta'])}", "|"),
            "currency": item("USD,EUR,GBP", "n_nationkey % 3"),
        },
    )
]


# Declared, so that opening a table reads no footer on the driver.
TABLES = {
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
}


def table(spark: SparkSession, folder, name) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def as_frame(spark: SparkSession, folder, relation) -> DataFrame:
    """The relation as a lazy DataFrame over the Parquet tables."""
    parts = []
    for name, keep, columns in relation:
        rows = table(spark, folder, name)
        if keep:
            rows = rows.filter(keep)
        parts.append(rows.selectExpr(*[f"{e} AS `{column}`" for column, e in columns.items()]))
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionByName(part)
    return frame


def as_sql(relation):
    """The relation as a SELECT for the checking engine."""
    selects = []
    for name, keep, columns in relation:
        items = ", ".join(f'{e} AS "{column}"' for column, e in columns.items())
        selects.append(f"SELECT {items} FROM {name}" + (f" WHERE {keep}" if keep else ""))
    return " UNION ALL ".join(selects)


# --- the product catalogue -----------------------------------------------------
# Every SKU in every nation, priced from the parts that carry the SKU. Amounts are
# whole hundredths of cents until the last division, so that they are exact. Every
# fifth nation has a second, dearer row under the other form of its code.
_SKUS = [
    "p_brand",
    "p_brand || ':monthly'",
    item(EVENT_SKUS, "p_partkey % 5"),
]
_CENTS = "min(cast(round(p_retailprice * 100) as bigint))"
_CATALOGUE = {
    "country": f"""case when (nation + second) % 2 = 0 then {item(CODES3, 'nation')}
        else {item(CODES2, 'nation')} end""",
    "product_SKU": "sku",
    "customer_price_in_currency": "cast((cents + 100 * second) * (100 + nation) as double) / 10000",
    "customer_price_in_usd": "cast(cents + 100 * second as double) / 100",
    "expected_proceeds_in_currency": "cast(cents * 7 * (100 + nation) as double) / 100000",
    "expected_proceeds_in_usd": "cast(cents * 7 as double) / 1000",
    "duration": "case when sku like '%:monthly' then '1 month' else '1 year' end",
}


def products(spark: SparkSession, folder) -> DataFrame:
    part = table(spark, folder, "part")
    skus = part.select(
        F.explode(F.array(*[F.expr(s) for s in _SKUS])).alias("sku"), "p_retailprice"
    )
    priced = skus.groupBy("sku").agg(F.expr(_CENTS).alias("cents"))
    nations = table(spark, folder, "nation").agg(F.collect_set("n_nationkey")).scalar()
    listed = priced.select("sku", "cents", F.explode(nations).alias("nation")).select(
        "*",
        F.explode(F.expr("if(nation % 5 = 0, array(0, 1), array(0))")).alias("second"),
    )
    return listed.selectExpr(*[f"{e} AS `{name}`" for name, e in _CATALOGUE.items()])


def products_sql():
    skus = " UNION ALL ".join(f"SELECT {s} AS sku, p_retailprice FROM part" for s in _SKUS)
    items = ", ".join(f'{e} AS "{name}"' for name, e in _CATALOGUE.items())
    return f"""SELECT {items} FROM
        (SELECT sku, {_CENTS} AS cents FROM ({skus}) GROUP BY sku)
        CROSS JOIN (SELECT n_nationkey AS nation FROM nation)
        CROSS JOIN (SELECT 0 AS second UNION ALL SELECT 1 AS second)
        WHERE second = 0 OR nation % 5 = 0"""
