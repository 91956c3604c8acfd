"""The same queries in SQL, written over sets, lists and rankings.

The rollups are checked by a different route than the jobs take: id sets and
membership tests instead of one aggregation, ranked rows instead of max of a
struct, a stated code table instead of the shortening rule.
"""

from tallyfold.workload import proxies
from tallyfold.workload.proxies import as_sql, item, products_sql, quoted

ORACLES = {}

# The checks' own lists, so that a wrong value in the library shows.
APP_BY_BUNDLE = {
    "com.example.meadow": "Meadow", "com.example.Lantern": "Lantern",
    "com.example.pantry": "Pantry", "com.example.stride": "Stride",
}
META_APP_BY_LABEL = {
    "Meadow Web": "Meadow", "Own_Lantern": "Lantern", "Lantern (SGD)": "Lantern",
    "Pantry Ads": "Pantry", "Stride Training": "Stride",
}
TIKTOK_APP_BY_LABEL = {
    "[Android/iOS] Pantry": "Pantry", "[iOS] Stride": "Stride", "[IOS] Lantern": "Lantern",
    "(Android) Lantern": "Lantern", "[iOS] Meadow": "Meadow",
}
EUROPE_ACTIVATION = (
    "al at be bg by ch cy cz de dk ee es fi gr hr hu ie is it lt lu lv md mk mt nl no pl "
    "pt ro rs ru se si sk tr ua"
).split()
EUROPE = [*EUROPE_ACTIVATION, "ad", "fr", "gb"]
ACCOUNTS = {
    "tiktok": {
        "[Android/iOS] Pantry": "7000000000000000001", "[iOS] Stride": "7000000000000000002",
        "[IOS] Lantern": "7000000000000000003", "(Android) Lantern": "7000000000000000004",
        "[iOS] Harbour": "7000000000000000005", "Orchard (iOS)": "7000000000000000006",
        "[iOS] Meadow": "7000000000000000007",
    },
    "meta": {
        "Pantry Ads": "300000000000001", "Stride Training": "300000000000002",
        "Own_Lantern": "300000000000003", "Lantern (SGD)": "300000000000004",
        "Orchard (iOS)": "300000000000005", "Orchard (Android)": "300000000000006",
        "Willow Ads": "300000000000007", "Cedar Classes": "300000000000008",
        "Meadow Web": "300000000000009",
    },
    "asa": {"Own": "8000001"},
}


def texts(values):
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def cases(arms, default="NULL"):
    """CASE of (condition, value) pairs; the values are texts."""
    return "CASE " + " ".join(f"WHEN {c} THEN {quoted(v)}" for c, v in arms) + f" ELSE {default} END"


# --- scalar rules --------------------------------------------------------------
def _codes(extra):
    left_out = {"MTQ", "GRL"} - set(extra)
    pairs = zip(proxies.CODES3.split(","), proxies.CODES2.split(","))
    return [(a, b) for a, b in pairs if a not in left_out]


def short_code(c, extra=()):
    arms = [(f"upper({c}) = '{a}'", b) for a, b in _codes(extra)]
    return cases(arms, f"substr({c}, 1, 2)")


def upper_key(c):
    return f"""upper(CASE length(coalesce({c}, '')) WHEN 2 THEN {c} WHEN 3 THEN {short_code(c)}
        ELSE substr(coalesce({c}, ''), 1, 2) END)"""


def lower_key(c, extra=()):
    return f"lower(trim(CASE WHEN length({c}) = 3 THEN {short_code(c, extra)} ELSE {c} END))"


def region(c, europe):
    arms = [
        (f"lower({c}) IN {texts(europe)}", "EUROPE"),
        (f"lower({c}) IN ('us', 'ca')", "US/CA"),
    ]
    return cases(arms, quoted("Rest of The world"))


def app(c):
    return cases([(f"{c} = '{b}'", a) for b, a in APP_BY_BUNDLE.items()])


KNOWN = f"bundleId IN {texts(APP_BY_BUNDLE)}"
ASA_KEEP = "upper(left(campaign_name, 3)) = 'HAR'"
ASA_APP = cases([(ASA_KEEP, "Meadow")], quoted("Unknown"))
META_APP = cases(
    [(f"ad_account = {quoted(t)}", a) for t, a in META_APP_BY_LABEL.items()],
    quoted("Unknown"),
)
TIKTOK_APP = cases(
    [(f"ad_account LIKE {quoted(f'%{t}%')}", a) for t, a in TIKTOK_APP_BY_LABEL.items()],
    quoted("Unknown"),
)
PLATFORM = """CASE WHEN campaign_name ILIKE '%ios%' THEN 'iOS'
    WHEN campaign_name ILIKE '%and%' THEN 'Android' ELSE 'iOS' END"""
META_USD = """spend * CASE currency WHEN 'USD' THEN CAST(1 AS DOUBLE)
    WHEN 'EUR' THEN CAST(1.16 AS DOUBLE) WHEN 'GBP' THEN CAST(1.33 AS DOUBLE) END"""
TIKTOK_USD = "spend * CAST(1.16 AS DOUBLE)"
BASE_ORDER = r"regexp_replace(latestOrderId, '\.\.[0-9]+$', '')"
SKU = "CASE WHEN coalesce(basePlanId, '') = '' THEN productId ELSE productId || ':' || basePlanId END"
DURATION = cases(
    [
        ("product_id ILIKE '%lifetime%'", "Lifetime"),
        ("product_id ILIKE '%year%'", "1 year"),
        ("product_id ILIKE '%premium%'", "1 month"),
        ("product_id ILIKE '%month%'", "1 month"),
    ]
)


def like_any(column, labels):
    return "(" + " OR ".join(f"{column} LIKE {quoted(f'%{t}%')}" for t in labels) + ")"


def newest(value, by):
    """Value of the newest row: no time comes last, the greater value breaks a tie."""
    return f"(array_agg({value} ORDER BY {by} DESC NULLS LAST, {value} DESC NULLS LAST))[1]"


# --- named parts ---------------------------------------------------------------
PRICES = [
    "customer_price_in_currency",
    "customer_price_in_usd",
    "expected_proceeds_in_currency",
    "expected_proceeds_in_usd",
    "duration",
]
PRICE_LIST = ", ".join(PRICES)
PRICE_ORDER = ", ".join(f"{p} NULLS FIRST" for p in PRICES)


def book(name, key):
    """One catalogue row per country key and SKU: the least in column order."""
    return f"""{name} AS (SELECT * FROM (
        SELECT {key} AS price_country, product_SKU AS price_sku, {PRICE_LIST},
            row_number() OVER (PARTITION BY {key}, product_SKU ORDER BY {PRICE_ORDER}) AS place
        FROM products) WHERE place = 1)"""


def least_price(source, key):
    """Least priced row per id among rows that found a price."""
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY {key} ORDER BY {PRICE_ORDER}) AS first FROM {source}) WHERE first = 1)"""


IOS = f"ios AS ({as_sql(proxies.IOS)})"
PLAY = f"play AS (SELECT *, {BASE_ORDER} AS base_order_id, {SKU} AS sku FROM ({as_sql(proxies.PLAY)}))"
BILLING = f"billing AS ({as_sql(proxies.BILLING)})"
PRODUCTS = f"products AS ({products_sql()})"
_SHARED = list(proxies.IOS_EVENTS[0][2])[:-3]
EVENTS = f"""events_all AS (
    SELECT {', '.join(_SHARED)} FROM ({as_sql(proxies.ANDROID_EVENTS)})
    UNION ALL SELECT {', '.join(_SHARED)} FROM ({as_sql(proxies.IOS_EVENTS)}))"""
ADS = f"ads AS ({as_sql(proxies.ALL_ADS)})"


def with_(*parts):
    return "WITH " + ",\n".join(parts) + "\n"


# --- cohorts -------------------------------------------------------------------
ID = "originalTransactionId"
IOS_TRIAL = f"""ios_trial AS (SELECT DISTINCT {ID} FROM ios
    WHERE offerDiscountType = 'FREE_TRIAL' AND {ID} IS NOT NULL)"""


def ios_seen(test):
    return f"{ID} IN (SELECT {ID} FROM ios WHERE {ID} IS NOT NULL AND {test})"


def _ios_cohort(name, rule):
    ORACLES[name] = with_(IOS, IOS_TRIAL) + f"SELECT {ID} FROM ios_trial WHERE {rule}"


_RENEWED = ios_seen("NotificationType = 'DID_RENEW'")
_EXPIRED = ios_seen("NotificationType = 'EXPIRED'")
_FAILED = ios_seen("NotificationType = 'DID_FAIL_TO_RENEW'")
_REFUNDED = ios_seen("NotificationType = 'REFUND'")
_RESUBSCRIBED = ios_seen("SubType = 'RESUBSCRIBE'")
_ios_cohort("ios_trials", "true")
_ios_cohort("ios_converted", _RENEWED)
_ios_cohort("ios_expired", f"({_EXPIRED} AND NOT {_RESUBSCRIBED}) OR {_REFUNDED}")
_ios_cohort(
    "ios_pending", f"{_FAILED} AND NOT {_EXPIRED} AND NOT {_RENEWED} AND NOT {_RESUBSCRIBED}"
)

_ACTIVE = "base_order_id IS NOT NULL AND subscriptionState LIKE '%\\_ACTIVE' ESCAPE '\\'"
PLAY_SETS = f"""play_trial AS (SELECT DISTINCT base_order_id FROM play
    WHERE {_ACTIVE} AND NOT contains(latestOrderId, '..') AND offerPhase = 'FREE_TRIAL'),
play_renewed AS (SELECT DISTINCT base_order_id FROM play
    WHERE {_ACTIVE} AND ends_with(latestOrderId, '..0') AND offerPhase = 'FREE_TRIAL'
      AND base_order_id IN (SELECT base_order_id FROM play_trial)),
play_bought AS (SELECT DISTINCT base_order_id FROM play
    WHERE {_ACTIVE} AND NOT contains(latestOrderId, '..') AND offerPhase = 'BASE')"""
for _name, _set in (
    ("play_trials", "play_trial"),
    ("play_converted", "play_renewed"),
    ("play_direct", "play_bought"),
):
    ORACLES[_name] = with_(PLAY, PLAY_SETS) + f"SELECT base_order_id FROM {_set}"

RC = "rc_original_app_user_id"
BILLING_SETS = f"""rc_trial AS (SELECT DISTINCT {RC} FROM billing WHERE {RC} IS NOT NULL
    AND is_trial_period AND NOT is_sandbox AND ownership_type IS DISTINCT FROM 'FAMILY_SHARED'),
rc_lenient AS (SELECT {RC} FROM rc_trial WHERE {RC} IN (SELECT {RC} FROM billing
    WHERE {RC} IS NOT NULL AND is_trial_conversion AND refunded_at IS NULL)),
rc_strict AS (SELECT {RC} FROM rc_trial
    WHERE {RC} IN (SELECT {RC} FROM billing WHERE {RC} IS NOT NULL AND is_trial_conversion)
      AND {RC} NOT IN (SELECT {RC} FROM billing
          WHERE {RC} IS NOT NULL AND refunded_at IS NOT NULL))"""
for _name, _set in (
    ("rc_trials", "rc_trial"),
    ("rc_converted_lenient", "rc_lenient"),
    ("rc_converted_strict", "rc_strict"),
):
    ORACLES[_name] = with_(BILLING, BILLING_SETS) + f"SELECT {RC} FROM {_set}"

EVENT_SETS = """qon_trial AS (SELECT DISTINCT q_user_id, event_ts AS trial_start_date
    FROM events_all WHERE event_name = 'Trial Started' AND q_user_id IS NOT NULL),
moments AS (SELECT q_user_id, event_ts, list_distinct(list(event_name)) AS names,
        string_agg(refund, '') AS refunds
    FROM events_all WHERE q_user_id IN (SELECT q_user_id FROM qon_trial)
    GROUP BY q_user_id, event_ts),
qon_conv AS (SELECT q_user_id, event_ts AS trial_converted_date FROM moments
    WHERE list_contains(names, 'Trial Converted')
      AND NOT list_has_any(names, ['Trial Canceled', 'Trial Expired'])
      AND coalesce(refunds, '') = ''),
qon_sub AS (SELECT q_user_id, event_ts AS direct_subscription_date
    FROM events_all WHERE event_name = 'Subscription Started')"""
for _name, _set in (
    ("qon_trials", "qon_trial"),
    ("qon_converted", "qon_conv"),
    ("qon_direct", "qon_sub"),
):
    ORACLES[_name] = with_(EVENTS, EVENT_SETS) + f"SELECT * FROM {_set}"
ORACLES["qon_cancels"] = (
    with_(EVENTS)
    + """SELECT q_user_id, event_ts AS cancel_date FROM events_all
    WHERE event_name = 'Subscription Canceled'"""
)


def attribution(converted, direct):
    return f"""coalesce({converted} < coalesce({direct}, timestamp '9999-01-01'), false)
            AS has_converted_trial,
        coalesce({direct} <= coalesce({converted}, timestamp '9999-01-01'), false)
            AS has_started_direct_subscription,
        CASE WHEN {converted} < {direct} THEN {converted} ELSE coalesce({direct}, {converted}) END
            AS user_activated_at"""


ORACLES["activation_attribution"] = (
    with_(EVENTS)
    + f"""SELECT q_user_id, converted_at, direct_at, {attribution('converted_at', 'direct_at')}
    FROM (SELECT q_user_id,
        max(event_ts) FILTER (WHERE event_name = 'Trial Converted') AS converted_at,
        max(event_ts) FILTER (WHERE event_name = 'Subscription Started') AS direct_at
      FROM events_all GROUP BY q_user_id)"""
)
_ROW = f"{RC}, start_time, product_identifier"
_IN_TRIAL = f"coalesce({RC} IN (SELECT {RC} FROM rc_trial), false)"
ORACLES["trial_semi_join"] = (
    with_(BILLING, BILLING_SETS) + f"SELECT {_ROW} FROM billing WHERE {_IN_TRIAL}"
)
ORACLES["trial_anti_join"] = (
    with_(BILLING, BILLING_SETS) + f"SELECT {_ROW} FROM billing WHERE NOT {_IN_TRIAL}"
)
ORACLES["membership_flag"] = (
    with_(BILLING, BILLING_SETS) + f"SELECT {_ROW}, {_IN_TRIAL} AS in_trial FROM billing"
)

# --- pipelines -----------------------------------------------------------------
STORE_TAIL = """customer_price_in_currency, currency, customer_price_in_usd,
    expected_proceeds_in_currency, expected_proceeds_in_usd, duration"""
_LATEST = newest("coalesce(ProductId, renewalProductId)", "purchaseDate")
IOS_FINAL = f"""ios_keys AS (SELECT DISTINCT {ID}, {upper_key('countryCode')} AS country_2 FROM ios
    WHERE {ID} IS NOT NULL),
ios_latest AS (SELECT {ID}, {_LATEST} AS product_id FROM ios
    WHERE {ID} IS NOT NULL GROUP BY {ID}),
{book('upper_book', f"lower(trim({upper_key('country')}))")},
ios_priced AS (SELECT k.{ID}, b.* FROM ios_keys k JOIN ios_latest l USING ({ID})
    JOIN upper_book b ON b.price_sku = l.product_id AND b.price_country = lower(trim(k.country_2))),
ios_rolled AS (SELECT {ID}, min(CAST(firstTransactionDate AS DATE)) AS first_transaction_date,
        min(bundleId) AS bundle_id, min(AppAppleId) AS app_apple_id,
        min(coalesce(currency, renewalCurrency)) AS currency
    FROM ios WHERE {KNOWN} GROUP BY {ID}),
ios_final AS (SELECT r.{ID} AS "TransactionId", first_transaction_date,
        coalesce(r.{ID} IN (SELECT {ID} FROM ios_trial), false) AS has_started_trial,
        coalesce(r.{ID} IN (SELECT {ID} FROM ios_trial WHERE {_RENEWED}), false)
            AS has_converted_trial,
        NOT coalesce(r.{ID} IN (SELECT {ID} FROM ios_trial), false) AS has_direct_purchase,
        (SELECT min(country_2) FROM ios_keys k WHERE k.{ID} = r.{ID}) AS country,
        l.product_id, bundle_id, app_apple_id, {STORE_TAIL},
        'iOS' AS platform, {app('bundle_id')} AS app_name
    FROM ios_rolled r LEFT JOIN ios_latest l USING ({ID})
    LEFT JOIN {least_price('ios_priced', ID)} p USING ({ID}))"""
PLAY_FINAL = f"""{book('lower_book', lower_key('country'))},
play_priced AS (SELECT base_order_id, b.* FROM play
    JOIN lower_book b ON price_country = lower(trim(regionCode)) AND price_sku = sku),
play_rolled AS (SELECT base_order_id,
        min(CAST(startTime AS DATE)) FILTER (WHERE latestOrderId = base_order_id)
            AS first_transaction_date,
        min(regionCode) AS country, min(sku) AS product_id, min(packageName) AS bundle_id,
        min(currencyCode) AS currency, min({app('packageName')}) AS app_name
    FROM play GROUP BY base_order_id),
play_final AS (SELECT r.base_order_id AS "TransactionId", first_transaction_date,
        coalesce(r.base_order_id IN (FROM play_trial), false) AS has_started_trial,
        coalesce(r.base_order_id IN (FROM play_renewed), false) AS has_converted_trial,
        coalesce(r.base_order_id IN (FROM play_bought), false) AS has_direct_purchase,
        country, product_id, bundle_id, {STORE_TAIL}, 'Android' AS platform, app_name
    FROM play_rolled r LEFT JOIN {least_price('play_priced', 'base_order_id')} p
        ON r.base_order_id IS NOT DISTINCT FROM p.base_order_id
    WHERE app_name IS NOT NULL)"""
ORACLES["ios_transactions"] = (
    with_(IOS, PRODUCTS, IOS_TRIAL, IOS_FINAL) + "SELECT * FROM ios_final"
)
ORACLES["play_transactions"] = (
    with_(PLAY, PRODUCTS, PLAY_SETS, PLAY_FINAL) + "SELECT * FROM play_final"
)
ORACLES["unified_transactions"] = (
    with_(IOS, PLAY, PRODUCTS, IOS_TRIAL, IOS_FINAL, PLAY_SETS, PLAY_FINAL)
    + """SELECT * FROM ios_final UNION ALL BY NAME
    SELECT *, CAST(NULL AS VARCHAR) AS app_apple_id FROM play_final"""
)


def _customers(product):
    return (
        with_(
            BILLING,
            PRODUCTS,
            BILLING_SETS,
            book("lower_book", lower_key("country")),
            f"""priced AS (SELECT {RC}, b.* FROM billing c
                JOIN lower_book b ON price_country = lower(trim(c.country))
                    AND price_sku = product_identifier)""",
            f"""rolled AS (SELECT {RC}, min(CAST(first_seen_time AS DATE)) AS first_seen_date,
                    min(country) AS country, min(platform) AS platform,
                    max(refunded_at) AS has_refunded, {product} AS product_id,
                    max(purchase_price_in_usd) AS purchased_price_usd
                FROM billing GROUP BY {RC})""",
        )
        + f"""SELECT r.{RC} AS customer_id, first_seen_date, country, platform, has_refunded,
            coalesce(r.{RC} IN (FROM rc_trial), false) AS has_started_trial,
            coalesce(r.{RC} IN (FROM rc_lenient), false) AS has_converted_trial_lenient,
            coalesce(r.{RC} IN (FROM rc_strict), false) AS has_converted_trial_strict,
            product_id, purchased_price_usd, {PRICE_LIST},
            {region('country', EUROPE)} AS region
        FROM rolled r LEFT JOIN {least_price('priced', RC)} p
            ON r.{RC} IS NOT DISTINCT FROM p.{RC}"""
    )


ORACLES["customer_rollup_any"] = _customers("min(product_identifier)")
ORACLES["customer_rollup_latest"] = _customers(newest("product_identifier", "start_time"))


def _amount(name, own):
    return f"CASE WHEN platform = 'iOS' THEN b.{name} ELSE {own} END AS {name}"


ORACLES["activation_rollup"] = (
    with_(
        EVENTS,
        PRODUCTS,
        EVENT_SETS,
        book("lower_book", lower_key("country", ["MTQ"])),
        f"""users AS (SELECT q_user_id, min(CAST(install_ts AS DATE)) AS first_seen_date,
                min(app_name) AS app_name, min(country) AS country, min(platform) AS platform,
                max(refund) AS has_refunded, {newest('product_id', 'event_ts')} AS product_id,
                min(currency) AS currency,
                max(TRY_CAST(price AS DOUBLE)) AS own_price,
                max(TRY_CAST(proceeds AS DOUBLE)) AS own_proceeds,
                max(TRY_CAST(price_usd AS DOUBLE)) AS own_price_usd,
                max(TRY_CAST(proceeds_usd AS DOUBLE)) AS own_proceeds_usd
            FROM events_all GROUP BY q_user_id)""",
        """t AS (SELECT q_user_id, max(trial_start_date) AS at FROM qon_trial GROUP BY ALL)""",
        """c AS (SELECT q_user_id, max(trial_converted_date) AS at FROM qon_conv GROUP BY ALL)""",
        """d AS (SELECT q_user_id, max(direct_subscription_date) AS at FROM qon_sub
            WHERE q_user_id IS NOT NULL GROUP BY ALL)""",
    )
    + f"""SELECT q_user_id AS customer_id, first_seen_date, app_name, country, platform,
        has_refunded, t.at IS NOT NULL AS has_started_trial, t.at AS has_started_trial_date,
        {attribution('c.at', 'd.at')}, product_id, currency,
        {_amount('customer_price_in_usd', 'own_price_usd')},
        {_amount('expected_proceeds_in_usd', 'own_proceeds_usd')},
        {_amount('customer_price_in_currency', 'own_price')},
        {_amount('expected_proceeds_in_currency', 'own_proceeds')},
        {DURATION} AS duration, {region('country', EUROPE_ACTIVATION)} AS region
    FROM users LEFT JOIN t USING (q_user_id) LEFT JOIN c USING (q_user_id)
    LEFT JOIN d USING (q_user_id)
    LEFT JOIN lower_book b ON price_country = lower(trim(country)) AND price_sku = product_id"""
)

SPEND_ROW = """date, {channel} AS channel, country, {app} AS ad_account, {platform} AS platform,
    campaign_id, campaign_name, adgroup_id, adgroup_name, spend AS spend_in_currency, currency,
    {usd} AS spend_in_usd"""


def _spend(relation, channel, app_rule, platform, usd, keep):
    row = SPEND_ROW.format(channel=quoted(channel), app=app_rule, platform=platform, usd=usd)
    return f"SELECT {row} FROM ({as_sql(relation)}) WHERE {keep}"


ORACLES["ad_spend"] = " UNION ALL ".join(
    [
        _spend(proxies.ASA_ADS, "Apple Search Ads", ASA_APP, "'iOS'", "spend", ASA_KEEP),
        _spend(
            proxies.META_ADS, "Meta", META_APP, PLATFORM, META_USD,
            like_any("ad_account", META_APP_BY_LABEL),
        ),
        _spend(
            proxies.TIKTOK_ADS, "Tiktok", TIKTOK_APP, PLATFORM, TIKTOK_USD,
            like_any("ad_account", TIKTOK_APP_BY_LABEL),
        ),
    ]
)


# --- report pages: the plain relations behind them -----------------------------
def _labels(channel):
    rows = ", ".join(f"({quoted(n)}, {quoted(i)})" for n, i in ACCOUNTS[channel].items())
    return f"labels AS (SELECT * FROM (VALUES {rows}) v(ad_account, account_id))"


def _or_null(*columns):
    return ", ".join(f"nullif({c}, '') AS {c}" for c in columns)


def _last(key, order, relation):
    """The last row of each key; a key of a campaign has to be a number."""
    return f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
        PARTITION BY {key} ORDER BY {order} DESC) AS place FROM ({as_sql(relation)})
        WHERE {key} NOT LIKE 'x%') WHERE place = 1"""


_CLEAN = f"""date, labels.ad_account, country, round(spend, 6) AS spend,
    {_or_null('currency', 'campaign_id', 'campaign_name', 'adgroup_id', 'adgroup_name')}"""
ORACLES["asa_flatten"] = (
    with_(
        _labels("asa"),
        f"ads AS ({as_sql(proxies.ASA_WHOLE)})",
        f"campaigns AS ({_last('campaign_id', 'fetch_date', proxies.CAMPAIGNS)})",
        f"details AS ({_last('campaign_id', 'fetch_date', proxies.CAMPAIGN_DETAILS)})",
        """daily AS (
            SELECT * EXCLUDE (campaign_name) FROM ads UNION ALL
            SELECT * EXCLUDE (campaign_name) REPLACE (CAST(date + 1 AS DATE) AS date,
                CASE WHEN line > 2 THEN spend / 2 ELSE 0 END AS spend) FROM ads)""",
        """flat AS (SELECT daily.* REPLACE (CASE countries WHEN 1 THEN first WHEN 2 THEN 'MULTI'
                ELSE '' END AS country), campaigns.campaign_name
            FROM daily JOIN campaigns ON org_id = account_id
                AND campaigns.campaign_id = daily.campaign_id
            LEFT JOIN details ON details.campaign_id = daily.campaign_id)""",
    )
    + f"SELECT {_CLEAN} FROM flat JOIN labels USING (account_id)"
)
DETAILS = f"""details AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY adgroup_id ORDER BY page DESC) AS place FROM ({as_sql(proxies.ADGROUPS)})
    WHERE {{keep}}) WHERE place = 1)"""
ORACLES["tiktok_flatten"] = (
    with_(
        _labels("tiktok"),
        f"ads AS ({as_sql(proxies.TIKTOK_WHOLE)})",
        DETAILS.format(keep="code = 0"),
        f"""daily AS (SELECT date, country, spend, currency, adgroup_id,
                {item(proxies.TIKTOK_ACCOUNT, 'CAST(adgroup_id AS BIGINT) % 7', '|')} AS account_id
            FROM ads)""",
        """days AS (FROM daily UNION ALL
            SELECT CAST(date + 1 AS DATE), country, 0, currency, adgroup_id, account_id
            FROM daily)""",
        """flat AS (SELECT days.*, adgroup_name, campaign_id, campaign_name
            FROM days LEFT JOIN details USING (adgroup_id))""",
    )
    + f"SELECT {_CLEAN} FROM flat JOIN labels USING (account_id)"
)
ORACLES["meta_flatten"] = (
    with_(
        _labels("meta"),
        f"ads AS ({as_sql(proxies.META_WHOLE)})",
        f"accounts AS ({_last('account_id', 'fetch_date', proxies.META_ACCOUNTS)})",
        """flat AS (SELECT ads.* EXCLUDE (currency), accounts.currency
            FROM ads LEFT JOIN accounts USING (account_id)
            UNION ALL SELECT ads.* EXCLUDE (currency) REPLACE (CAST(date + 1 AS DATE) AS date,
                spend / 2 AS spend, NULL AS adgroup_name), accounts.currency
            FROM ads LEFT JOIN accounts USING (account_id))""",
    )
    + f"SELECT {_CLEAN} FROM flat JOIN labels USING (account_id)"
)
ORACLES["payload_error_split"] = f"""SELECT advertiser_id, code,
    CASE code WHEN 0 THEN 'OK' ELSE 'limit reached' END AS message, code = 0 AS ok, 4 AS n
    FROM ({as_sql(proxies.ADGROUPS)})"""

# --- aggregates ----------------------------------------------------------------
ORACLES["distinct_ids"] = with_(IOS) + f"SELECT {ID} FROM ios GROUP BY {ID}"
_SIGNALS = {
    "trial": "offerDiscountType = 'FREE_TRIAL'",
    "renewed": "NotificationType = 'DID_RENEW'",
    "expired": "NotificationType = 'EXPIRED'",
    "renewal_failed": "NotificationType = 'DID_FAIL_TO_RENEW'",
    "refunded": "NotificationType = 'REFUND'",
    "resubscribed": "SubType = 'RESUBSCRIBE'",
}
_COUNTS = ", ".join(f"count(*) FILTER (WHERE {p}) AS {n}" for n, p in _SIGNALS.items())
ORACLES["countif_profile"] = with_(IOS) + f"SELECT {ID}, {_COUNTS} FROM ios GROUP BY {ID}"
ORACLES["pick_any_min"] = (
    with_(IOS)
    + f"""SELECT {ID}, min(countryCode) AS "countryCode", min(bundleId) AS "bundleId",
    min(currency) AS currency FROM ios GROUP BY {ID}"""
)
ORACLES["latest_product"] = ORACLES["latest_product_window"] = (
    with_(IOS) + f"SELECT {ID}, {_LATEST} AS product_id FROM ios GROUP BY {ID}"
)
ORACLES["play_first_date"] = (
    with_(PLAY)
    + """SELECT base_order_id, min(CASE WHEN NOT contains(latestOrderId, '..')
    THEN CAST(startTime AS DATE) END) AS first_transaction_date FROM play GROUP BY base_order_id"""
)
ORACLES["safe_cast_max"] = (
    with_(EVENTS)
    + """SELECT q_user_id, max(TRY_CAST(price AS DOUBLE)) AS greatest_price
    FROM events_all GROUP BY q_user_id"""
)

# --- lookups -------------------------------------------------------------------
ORACLES["price_lookup"] = (
    with_(PLAY, PRODUCTS, book("lower_book", lower_key("country")))
    + f"""SELECT "latestOrderId", "regionCode", sku, {PRICE_LIST} FROM play
    LEFT JOIN lower_book ON price_sku = sku AND price_country = lower(trim(regionCode))"""
)
ORACLES["price_lookup_post"] = (
    with_(
        EVENTS,
        PRODUCTS,
        f"""users AS (SELECT q_user_id, min(country) AS country,
            {newest('product_id', 'event_ts')} AS product_id FROM events_all GROUP BY q_user_id)""",
    )
    + f"""SELECT q_user_id, users.country, product_id, {PRICE_LIST} FROM users
    LEFT JOIN products ON product_SKU = product_id
        AND lower(trim(users.country)) = {lower_key('products.country', ['MTQ'])}"""
)
ORACLES["adgroup_lookup"] = (
    with_(f"ads AS ({as_sql(proxies.TIKTOK_WHOLE)})", DETAILS.format(keep="true"))
    + """SELECT adgroup_id, date, spend, coalesce(details.adgroup_name, '') AS adgroup_name,
    coalesce(details.campaign_id, '') AS campaign_id,
    coalesce(details.campaign_name, '') AS campaign_name
    FROM ads LEFT JOIN details USING (adgroup_id)"""
)
ORACLES["asa_campaign_country"] = f"""SELECT campaign_id,
    CASE countries WHEN 0 THEN '' WHEN 1 THEN first ELSE 'MULTI' END AS country
    FROM ({_last('campaign_id', 'fetch_date', proxies.CAMPAIGN_DETAILS)})"""
_LABEL_ROWS = ", ".join(
    f"({quoted(c)}, {quoted(n)}, {quoted(i)})" for c, d in ACCOUNTS.items() for n, i in d.items()
)
ORACLES["account_label"] = f"""SELECT a.account_id, date, spend, a.channel, v.ad_account FROM (
    SELECT 'tiktok' AS channel, * FROM ({as_sql(proxies.TIKTOK_ADS)})
    UNION ALL SELECT 'meta' AS channel, * FROM ({as_sql(proxies.META_ADS)})
    UNION ALL SELECT 'asa' AS channel, * FROM ({as_sql(proxies.ASA_ADS)})) a
    JOIN (VALUES {_LABEL_ROWS}) v(channel, ad_account, account_id)
        ON v.channel = a.channel AND v.account_id = a.account_id"""


# --- scalars and filters -------------------------------------------------------
def _scalar(name, part, table, columns):
    ORACLES[name] = with_(part) + f"SELECT {columns} FROM {table}"


_COUNTRY = 'event_id, "countryCode", {} AS country_2'
_scalar("country_norm", IOS, "ios", _COUNTRY.format(upper_key("countryCode")))
_scalar("country_norm_b", IOS, "ios", _COUNTRY.format(lower_key("countryCode")))
_scalar("country_norm_ext", IOS, "ios", _COUNTRY.format(lower_key("countryCode", ["MTQ"])))
_REGION = f"{RC}, country, {{}} AS region"
_scalar("region_bucket", BILLING, "billing", _REGION.format(region("country", EUROPE)))
_scalar(
    "region_bucket_38", BILLING, "billing",
    _REGION.format(region("country", EUROPE_ACTIVATION)),
)
_scalar("app_name_map", IOS, "ios", f'event_id, "bundleId", {app("bundleId")} AS app_name')
_scalar("platform_from_campaign", ADS, "ads", f"campaign_name, {PLATFORM} AS platform")
_scalar(
    "fx_to_usd", ADS, "ads",
    f"spend, currency, spend AS asa_usd, {META_USD} AS meta_usd, {TIKTOK_USD} AS tiktok_usd",
)
_scalar("base_order_id", PLAY, "play", '"latestOrderId", base_order_id')
_scalar("composite_sku", PLAY, "play", '"productId", "basePlanId", sku')
_scalar("duration_from_sku", EVENTS, "events_all", f"q_user_id, product_id, {DURATION} AS duration")
_scalar(
    "string_kit", ADS, "ads",
    """campaign_name, upper(campaign_name) AS upper_name, lower(campaign_name) AS lower_name,
    campaign_name AS trimmed, length(campaign_name) AS n_chars, left(campaign_name, 3) AS head,
    campaign_name || ':' || CAST(CAST(floor(spend) AS INT) AS VARCHAR) AS tagged""",
)
_scalar(
    "ad_account_map", ADS, "ads",
    f"""ad_account, campaign_name, {ASA_APP} AS asa_app, {META_APP} AS meta_app,
    {TIKTOK_APP} AS tiktok_app""",
)
ORACLES["price_by_platform"] = (
    with_(EVENTS, PRODUCTS, book("lower_book", lower_key("country")))
    + """SELECT q_user_id, platform, CASE platform WHEN 'iOS' THEN customer_price_in_currency
    ELSE TRY_CAST(price AS DOUBLE) END AS price FROM events_all LEFT JOIN lower_book
    ON price_sku = product_id AND price_country = lower(trim(country))"""
)
_AD_ROW = "SELECT date, ad_account, campaign_id, campaign_name, adgroup_id, spend FROM ads WHERE "
_LABELS = [*META_APP_BY_LABEL, *TIKTOK_APP_BY_LABEL]
ORACLES["like_channel_filter"] = with_(ADS) + _AD_ROW + like_any("ad_account", _LABELS)
ORACLES["prefix_filter"] = with_(ADS) + _AD_ROW + "campaign_name ILIKE 'har%'"
ORACLES["window_explicit"] = (
    with_(ADS) + _AD_ROW + "date >= DATE '1997-03-05' AND date < DATE '1997-06-21'"
)
ORACLES["window_month"] = with_(ADS) + _AD_ROW + "strftime(date, '%Y-%m') = '1996-02'"
ORACLES["app_filter_pre"] = (
    with_(IOS)
    + f"""SELECT {ID}, min(CAST(purchaseDate AS DATE)) AS first_date FROM ios
    WHERE {KNOWN} GROUP BY {ID}"""
)
ORACLES["app_filter_post"] = (
    with_(IOS)
    + f"""SELECT {ID}, min(CAST(purchaseDate AS DATE)) AS first_date,
        min({app('bundleId')}) AS app_name
    FROM ios GROUP BY {ID} HAVING bool_or({KNOWN})"""
)

# --- set and sink shapes -------------------------------------------------------
ORACLES["except_union"] = with_(EVENTS) + "SELECT * FROM events_all"
_SPEND = """date, ad_account, country, spend, currency, campaign_id, campaign_name,
    adgroup_id, adgroup_name"""
ORACLES["schema_evolve_union"] = f"""SELECT date, ad_account, country, spend
    FROM ({as_sql(proxies.ASA_ADS)})
    UNION ALL BY NAME SELECT {_SPEND} FROM ({as_sql([*proxies.META_ADS, *proxies.TIKTOK_ADS])})"""
ORACLES["spend_required_split"] = (
    with_(ADS)
    + f"""SELECT {_SPEND}, line NOT IN (3, 5) AS accepted FROM (SELECT * REPLACE (
        CASE WHEN line = 3 THEN NULL ELSE country END AS country,
        CASE WHEN line = 5 THEN NULL ELSE date END AS date) FROM ads)"""
)
ORACLES["spend_conform"] = (
    with_(ADS) + f"SELECT {_CLEAN.replace('labels.', '')} FROM ads"
)
ORACLES["spend_csv_rows"] = (
    with_(ADS)
    + """SELECT CAST(date AS VARCHAR) AS date, ad_account AS app, country,
    printf('%.6f', spend) AS spend, currency, campaign_id, campaign_name, adgroup_id, adgroup_name
    FROM ads"""
)
