"""Every operator as a query over the driver tables: name -> (spark, folder) -> DataFrame."""

from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.functions import countries, store
from tallyfold.functions import spend as sp
from tallyfold.operators import cohorts, lookups, picks, spend_rows, windows
from tallyfold.plans import ad_reports, customers, store_transactions
from tallyfold.plans import ad_spend as spend_plan
from tallyfold.sources import payloads
from tallyfold.sources.accounts import accounts, select_accounts
from tallyfold.workload import pages, proxies
from tallyfold.workload.proxies import as_frame, products

QUERIES = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def ios(spark, folder):
    return as_frame(spark, folder, proxies.IOS)


def play(spark, folder):
    return as_frame(spark, folder, proxies.PLAY)


def billing(spark, folder):
    return as_frame(spark, folder, proxies.BILLING)


def event_sources(spark, folder):
    return (
        as_frame(spark, folder, proxies.ANDROID_EVENTS),
        as_frame(spark, folder, proxies.IOS_EVENTS),
    )


def events(spark, folder):
    return customers.union_events(*event_sources(spark, folder))


def ads(spark, folder):
    return as_frame(spark, folder, proxies.ALL_ADS)


# --- pipelines ---------------------------------------------------------------
@query
def ios_transactions(spark, folder):
    return store_transactions.ios_transactions(ios(spark, folder), products(spark, folder))


@query
def play_transactions(spark, folder):
    return store_transactions.play_transactions(play(spark, folder), products(spark, folder))


@query
def unified_transactions(spark, folder):
    return store_transactions.unified_transactions(
        ios_transactions(spark, folder), play_transactions(spark, folder)
    )


@query
def ad_spend(spark, folder):
    channels = (proxies.ASA_ADS, proxies.META_ADS, proxies.TIKTOK_ADS)
    return spend_plan.ad_spend(*[as_frame(spark, folder, c) for c in channels])


@query
def customer_rollup_any(spark, folder):
    return customers.customer_rollup(billing(spark, folder), products(spark, folder))


@query
def customer_rollup_latest(spark, folder):
    return customers.customer_rollup(
        billing(spark, folder), products(spark, folder), product="latest"
    )


@query
def activation_rollup(spark, folder):
    return customers.activation_rollup(*event_sources(spark, folder), products(spark, folder))


def _labelled(spark, flat, channel):
    return ad_reports.to_spend_rows(flat, select_accounts(accounts(spark), channel))


@query
def asa_flatten(spark, folder):
    flat = ad_reports.flatten_asa(
        pages.asa_reports(spark, folder),
        pages.asa_campaigns(spark, folder),
        pages.asa_details(spark, folder),
    )
    return _labelled(spark, flat, "asa")


@query
def tiktok_flatten(spark, folder):
    flat = ad_reports.flatten_tiktok(
        pages.tiktok_reports(spark, folder), pages.tiktok_adgroups(spark, folder)
    )
    return _labelled(spark, flat, "tiktok")


@query
def meta_flatten(spark, folder):
    flat = ad_reports.flatten_meta(
        pages.meta_insights(spark, folder), pages.meta_accounts(spark, folder)
    )
    return _labelled(spark, flat, "meta")


# --- cohorts -----------------------------------------------------------------
def _cohort(name, relation, operator):
    QUERIES[name] = lambda spark, folder: operator(relation(spark, folder))


_cohort("ios_trials", ios, cohorts.ios_trials)
_cohort("ios_converted", ios, cohorts.ios_converted)
_cohort("ios_expired", ios, cohorts.ios_expired)
_cohort("ios_pending", ios, cohorts.ios_pending)
_cohort("play_trials", play, cohorts.play_trials)
_cohort("play_converted", play, cohorts.play_converted)
_cohort("play_direct", play, cohorts.play_direct)
_cohort("rc_trials", billing, cohorts.billing_trials)
_cohort("rc_converted_lenient", billing, cohorts.billing_converted_lenient)
_cohort("rc_converted_strict", billing, cohorts.billing_converted_strict)
_cohort("qon_trials", events, cohorts.event_trials)
_cohort("qon_converted", events, cohorts.event_converted)
_cohort("qon_direct", events, cohorts.event_direct)
_cohort("qon_cancels", events, cohorts.event_cancels)


@query
def activation_attribution(spark, folder):
    """Attribution alone: first conversion-event time against first direct one."""

    def time_of(event):
        return F.max(F.when(cohorts.event_is(event), F.col("event_ts")))

    times = events(spark, folder).groupBy("q_user_id").agg(
        time_of("Trial Converted").alias("converted_at"),
        time_of("Subscription Started").alias("direct_at"),
    )
    return times.withColumns(cohorts.attribute_activation("converted_at", "direct_at"))


_BILLING_ROW = ["rc_original_app_user_id", "start_time", "product_identifier"]


@query
def trial_semi_join(spark, folder):
    rows = billing(spark, folder)
    return cohorts.restrict_to(
        rows.select(*_BILLING_ROW), cohorts.billing_trials(rows), cohorts.BILLING_ID
    )


@query
def trial_anti_join(spark, folder):
    rows = billing(spark, folder)
    return cohorts.exclude(
        rows.select(*_BILLING_ROW), cohorts.billing_trials(rows), cohorts.BILLING_ID
    )


@query
def membership_flag(spark, folder):
    rows = billing(spark, folder)
    return cohorts.flag_members(
        rows.select(*_BILLING_ROW), cohorts.billing_trials(rows), cohorts.BILLING_ID, "in_trial"
    )


# --- aggregates --------------------------------------------------------------
@query
def distinct_ids(spark, folder):
    return cohorts.distinct_ids(ios(spark, folder), cohorts.IOS_ID)


@query
def countif_profile(spark, folder):
    return cohorts.tally(ios(spark, folder), cohorts.IOS_ID, cohorts.ios_signals())


@query
def pick_any_min(spark, folder):
    fields = ["countryCode", "bundleId", "currency"]
    return ios(spark, folder).groupBy(cohorts.IOS_ID).agg(
        *[picks.pick_any(f).alias(f) for f in fields]
    )


_SOLD = "coalesce(ProductId, renewalProductId)"


@query
def latest_product(spark, folder):
    newest = picks.latest(F.expr(_SOLD), "purchaseDate").alias("product_id")
    return ios(spark, folder).groupBy(cohorts.IOS_ID).agg(newest)


@query
def latest_product_window(spark, folder):
    return picks.latest_by_window(
        ios(spark, folder), cohorts.IOS_ID, F.expr(_SOLD), "purchaseDate", "product_id"
    )


@query
def play_first_date(spark, folder):
    first = F.min(F.when(cohorts.is_base_order(), F.to_date("startTime")))
    rows = cohorts.with_base_order(play(spark, folder))
    return rows.groupBy(cohorts.PLAY_ID).agg(first.alias("first_transaction_date"))


@query
def safe_cast_max(spark, folder):
    greatest = F.max(F.col("price").try_cast("double")).alias("greatest_price")
    return events(spark, folder).groupBy("q_user_id").agg(greatest)


# --- lookups -----------------------------------------------------------------
@query
def price_lookup(spark, folder):
    rows = play(spark, folder).select(
        "latestOrderId", "regionCode", store.composite_sku("productId", "basePlanId").alias("sku")
    )
    priced = lookups.attach_prices(
        rows,
        lookups.price_book(products(spark, folder)),
        countries.trimmed_lower("regionCode"),
        "sku",
    )
    return priced.select(*rows.columns, "prices.*")


@query
def price_lookup_post(spark, folder):
    """Grouped first and priced after: users with two listed rows come out twice."""
    users = events(spark, folder).groupBy("q_user_id").agg(
        picks.pick_any("country").alias("country"),
        picks.latest("product_id", "event_ts").alias("product_id"),
    )
    book = lookups.price_book(products(spark, folder), extended=True, unique=False)
    priced = lookups.attach_prices(users, book, countries.trimmed_lower("country"), "product_id")
    return priced.select(*users.columns, "prices.*")


@query
def adgroup_lookup(spark, folder):
    rows = as_frame(spark, folder, proxies.TIKTOK_WHOLE).select("adgroup_id", "date", "spend")
    details = as_frame(spark, folder, proxies.ADGROUPS)
    blank = [F.coalesce(f, F.lit("")).alias(f) for f in ad_reports.ADGROUP_FIELDS]
    newest = lookups.newest_details(
        details.select("adgroup_id", "page", *blank),
        ["adgroup_id"],
        ad_reports.ADGROUP_FIELDS,
        ["page"],
    )
    return lookups.attach_or_blank(rows, newest, "adgroup_id", ad_reports.ADGROUP_FIELDS)


@query
def asa_campaign_country(spark, folder):
    return ad_reports.asa_campaign_countries(pages.asa_details(spark, folder))


@query
def account_label(spark, folder):
    """Rows of every selected account, labelled by account id within their channel."""
    rows = [
        as_frame(spark, folder, relation)
        .select("account_id", "date", "spend")
        .withColumn("channel", F.lit(channel))
        for channel, relation in (
            ("tiktok", proxies.TIKTOK_ADS),
            ("meta", proxies.META_ADS),
            ("asa", proxies.ASA_ADS),
        )
    ]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return lookups.label_accounts(every, select_accounts(accounts(spark)), "channel")


# --- scalars and filters -----------------------------------------------------
def _scalar(name, relation, keep, **columns):
    """Rows of a relation with computed columns; `keep` names the input columns."""

    def run(spark, folder):
        computed = {c: build() for c, build in columns.items()}
        rows = relation(spark, folder)
        return rows.select(*keep, *[c.alias(n) for n, c in computed.items()])

    QUERIES[name] = run


_scalar(
    "country_norm", ios, ["event_id", "countryCode"],
    country_2=lambda: countries.country_upper("countryCode"),
)
_scalar(
    "country_norm_b", ios, ["event_id", "countryCode"],
    country_2=lambda: countries.country_lower("countryCode"),
)
_scalar(
    "country_norm_ext", ios, ["event_id", "countryCode"],
    country_2=lambda: countries.country_lower("countryCode", extended=True),
)
_scalar(
    "region_bucket", billing, ["rc_original_app_user_id", "country"],
    region=lambda: countries.region("country"),
)
_scalar(
    "region_bucket_38", billing, ["rc_original_app_user_id", "country"],
    region=lambda: countries.region("country", fv.EUROPE_ACTIVATION),
)
_scalar(
    "app_name_map", ios, ["event_id", "bundleId"],
    app_name=lambda: store.app_name("bundleId"),
)
_scalar(
    "platform_from_campaign", ads, ["campaign_name"],
    platform=lambda: sp.platform_from_campaign("campaign_name"),
)
_scalar(
    "fx_to_usd", ads, ["spend", "currency"],
    asa_usd=lambda: sp.asa_usd("spend"),
    meta_usd=lambda: sp.meta_usd("spend", "currency"),
    tiktok_usd=lambda: sp.tiktok_usd("spend"),
)
_scalar(
    "base_order_id", play, ["latestOrderId"],
    base_order_id=lambda: store.base_order_id("latestOrderId"),
)
_scalar(
    "composite_sku", play, ["productId", "basePlanId"],
    sku=lambda: store.composite_sku("productId", "basePlanId"),
)
_scalar(
    "duration_from_sku", events, ["q_user_id", "product_id"],
    duration=lambda: store.duration_from_sku("product_id"),
)
_scalar(
    "string_kit", ads, ["campaign_name"],
    upper_name=lambda: F.upper("campaign_name"),
    lower_name=lambda: F.lower("campaign_name"),
    trimmed=lambda: F.trim(F.concat(F.lit("  "), "campaign_name", F.lit(" "))),
    n_chars=lambda: F.length("campaign_name").cast("bigint"),
    head=lambda: F.substring("campaign_name", 1, 3),
    tagged=lambda: F.concat("campaign_name", F.lit(":"), F.col("spend").cast("int").cast("string")),
)


@query
def ad_account_map(spark, folder):
    rows = ads(spark, folder)
    return rows.select(
        "ad_account",
        "campaign_name",
        sp.asa_app("campaign_name").alias("asa_app"),
        sp.meta_app("ad_account").alias("meta_app"),
        sp.tiktok_app("ad_account").alias("tiktok_app"),
    )


@query
def price_by_platform(spark, folder):
    book = lookups.price_book(products(spark, folder))
    rows = events(spark, folder)
    priced = lookups.attach_prices(rows, book, countries.trimmed_lower("country"), "product_id")
    listed = F.col("prices.customer_price_in_currency")
    charged = F.col("price").try_cast("double")
    return priced.select(
        "q_user_id", "platform", store.price_by_platform("platform", listed, charged).alias("price")
    )


_AD_ROW = ["date", "ad_account", "campaign_id", "campaign_name", "adgroup_id", "spend"]


@query
def like_channel_filter(spark, folder):
    labels = [*fv.META_APP_BY_LABEL, *fv.TIKTOK_APP_BY_LABEL]
    return ads(spark, folder).select(*_AD_ROW).filter(sp.label_matches("ad_account", labels))


@query
def prefix_filter(spark, folder):
    return ads(spark, folder).select(*_AD_ROW).filter(sp.is_asa_campaign("campaign_name"))


@query
def app_filter_pre(spark, folder):
    """Rows filtered by app before they are grouped."""
    rows = ios(spark, folder).filter(store.is_known_bundle("bundleId"))
    return rows.groupBy(cohorts.IOS_ID).agg(F.min(F.to_date("purchaseDate")).alias("first_date"))


@query
def app_filter_post(spark, folder):
    """Groups filtered by their app after grouping."""
    rolled = ios(spark, folder).groupBy(cohorts.IOS_ID).agg(
        F.min(F.to_date("purchaseDate")).alias("first_date"),
        picks.pick_any(store.app_name("bundleId")).alias("app_name"),
    )
    return rolled.filter(F.col("app_name").isNotNull())


@query
def window_explicit(spark, folder):
    window = windows.report_window("1997-03-05", "1997-06-20")
    return windows.in_window(ads(spark, folder).select(*_AD_ROW), "date", window)


@query
def window_month(spark, folder):
    window = windows.month_window("1996-02")
    return windows.in_window(ads(spark, folder).select(*_AD_ROW), "date", window)


# --- set and sink shapes -----------------------------------------------------
@query
def except_union(spark, folder):
    return events(spark, folder)


@query
def schema_evolve_union(spark, folder):
    """A table of an older generation, without currency and names, plus new rows."""
    old = as_frame(spark, folder, proxies.ASA_ADS).select("date", "ad_account", "country", "spend")
    later = [*proxies.META_ADS, *proxies.TIKTOK_ADS]
    new = as_frame(spark, folder, later).select(*spend_rows.SPEND_COLUMNS)
    return spend_rows.with_missing_columns(old, new)


def _gappy(spark, folder):
    """Spend rows with a required value missing here and there."""
    rows = ads(spark, folder)
    return rows.withColumns(
        {
            "country": F.when(F.col("line") != 3, F.col("country")),
            "date": F.when(F.col("line") != 5, F.col("date")),
        }
    ).select(*spend_rows.SPEND_COLUMNS)


@query
def spend_required_split(spark, folder):
    valid, rejected = spend_rows.split_required(_gappy(spark, folder))
    return valid.withColumn("accepted", F.lit(True)).unionByName(
        rejected.withColumn("accepted", F.lit(False))
    )


@query
def spend_conform(spark, folder):
    return spend_rows.conform(ads(spark, folder))


@query
def spend_csv_rows(spark, folder):
    return spend_rows.csv_rows(spend_rows.conform(ads(spark, folder)))


@query
def payload_error_split(spark, folder):
    good, failed = payloads.split_errors(pages.tiktok_adgroups(spark, folder))
    failed = failed.withColumn("ok", F.lit(False))
    both = good.withColumn("ok", F.lit(True)).unionByName(failed)
    return both.select("advertiser_id", "code", "message", "ok", F.size("data.list").alias("n"))
