"""Nested ad reports to flat daily spend rows.

Rows come out as (account, date, country, spend, currency, ad group, campaign);
`label_accounts` then names the account and `spend_rows.conform` cleans the row.

Names, countries and currencies come from detail pages. `DETAILS` says what is taken from
them, so that a load can keep what it knows and read new pages only.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.spend import amount_blank_is_zero, amount_or_zero, report_date
from tallyfold.operators import lookups
from tallyfold.operators.spend_rows import SPEND_COLUMNS, conform
from tallyfold.sources import payloads
from tallyfold.sources.payloads import require_success

ADGROUP_FIELDS = ["adgroup_name", "campaign_id", "campaign_name"]
#: Of what was found several times the last counts: fetched last, then the last page, file and place.
NEWEST = {"fetch_date": "date", "page": "int", "page_file": "string", "place": "int"}
#: What says why an entry is left out, where it stood and what it was.
REJECT_COLUMNS = ["reason", "level", "place", "entry_text"]
NO_OBJECT = "the entry is no object"


def _text(value) -> Column:
    return F.coalesce(value, F.lit(""))


def _out(rows: DataFrame, account) -> DataFrame:
    columns = [c for c in SPEND_COLUMNS if c != "ad_account"]
    more = [c for c in REJECT_COLUMNS if c in rows.columns]
    return rows.select(F.col(account).alias("account_id"), *columns, *more)


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows with all columns of their order; those a source lacks are null."""
    lacking = {c: F.lit(None).cast(kind) for c, kind in NEWEST.items() if c not in rows.columns}
    return rows.withColumns(lacking)


def _listed(found: DataFrame, rejects) -> DataFrame:
    """Good entries; with `rejects` also the others, and the columns that say so."""
    if not rejects:
        return payloads.split_entries(found)[0]
    bad = F.col("entry").isNull()
    return found.withColumns({"reason": F.when(bad, NO_OBJECT), "entry_text": F.when(bad, F.col("entry_text"))})


# --- search ads --------------------------------------------------------------
def asa_campaign_rows(pages: DataFrame) -> DataFrame:
    """(account, campaign, name) of campaigns that have an integer id and a name, as often as listed."""
    order = payloads.order_columns(pages)
    found = payloads.good_entries(pages, "data", payloads.ASA_CAMPAIGN, "org_id", *order)
    named = found.select(
        "org_id",
        *order,
        "place",
        F.col("entry.id").try_cast("bigint").cast("string").alias("campaign_id"),
        F.col("entry.name").alias("campaign_name"),
    )
    return _ordered(named.filter("campaign_id IS NOT NULL AND campaign_name IS NOT NULL"))


def asa_campaign_names(pages: DataFrame) -> DataFrame:
    """(account, campaign, name); of a campaign listed several times the newest name counts."""
    return DETAILS["asa"]["campaigns"].newest(asa_campaign_rows(pages))


def asa_country_rows(pages: DataFrame) -> DataFrame:
    """(campaign, country) of each page, several countries being MULTI."""
    found = pages.select(
        *payloads.order_columns(pages),
        F.col("data.id").try_cast("bigint").cast("string").alias("campaign_id"),
        lookups.single_country("data.countriesOrRegions").alias("country"),
    )
    return _ordered(found.filter("campaign_id IS NOT NULL"))


def asa_campaign_countries(pages: DataFrame) -> DataFrame:
    """(campaign, country) of the newest page of each campaign."""
    return DETAILS["asa"]["details"].newest(asa_country_rows(pages))


def _asa_rows(reports: DataFrame) -> DataFrame:
    items = "data.reportingDataResponse.row"
    return payloads.entries(reports, items, payloads.ASA_ROW, "org_id", "campaign_id")


def _asa_days(rows: DataFrame, rejects=False) -> DataFrame:
    """The days of good rows; with `rejects` a row that is no object stands for itself."""
    days = F.col("entry.granularity")
    keep = ["org_id", "campaign_id", F.col("entry.metadata").alias("metadata")]
    if rejects:
        is_row = F.col("entry").isNull()
        days = F.when(is_row, F.array(F.parse_json("entry_text"))).otherwise(days)
        keep += [F.when(is_row, "row").otherwise("day").alias("level"), F.when(is_row, F.col("place")).alias("row_place")]
    return payloads.entries(rows, days, payloads.ASA_DAY, *keep)


def asa_flat(reports: DataFrame, names: DataFrame, countries: DataFrame, rejects=False) -> DataFrame:
    """Report pages x campaign names x campaign countries; only named campaigns stay.

    Reports carry org_id and campaign_id. Rows and days that are no objects are left out one
    by one; with `rejects` they stay, with a reason and without values.
    """
    rows = _asa_rows(reports)
    days = _listed(_asa_days(rows if rejects else payloads.split_entries(rows)[0], rejects), rejects)
    if rejects:
        days = days.withColumn("place", F.coalesce("row_place", "place"))
    more = [c for c in REJECT_COLUMNS if rejects]
    rows = days.select(
        "org_id",
        F.col("campaign_id").try_cast("bigint").cast("string").alias("campaign_id"),
        report_date(F.col("entry.date")).alias("date"),
        amount_or_zero(F.col("entry.localSpend.amount")).alias("spend"),
        _text(F.col("entry.localSpend.currency")).alias("currency"),
        _text(F.col("metadata.adGroupId")).alias("adgroup_id"),
        _text(F.col("metadata.adGroupName")).alias("adgroup_name"),
        *more,
    )
    campaigns = lookups.attach_or_blank(names, countries, "campaign_id", ["country"])
    listed = lookups.spread_join(
        rows.filter("org_id != ''"), campaigns, ["org_id", "campaign_id"], "inner"
    )
    return _out(listed, "org_id")


def flatten_asa(reports: DataFrame, campaigns: DataFrame, details: DataFrame) -> DataFrame:
    """`asa_flat` with the campaign lists (with their org_id) and campaign details as pages."""
    return asa_flat(reports, asa_campaign_names(campaigns), asa_campaign_countries(details))


# --- TikTok ------------------------------------------------------------------
def tiktok_adgroup_rows(pages: DataFrame) -> DataFrame:
    """Ad-group details, as often as listed; pages with an error status are left out quietly."""
    order = payloads.order_columns(pages)
    paged = pages.filter("code = 0").withColumn("page", F.col("data.page_info.page"))
    found = payloads.good_entries(
        paged, "data.list", payloads.TIKTOK_ADGROUP, "advertiser_id", "page", *order
    )
    rows = found.select(
        "advertiser_id",
        *order,
        "page",
        "place",
        F.col("entry.adgroup_id").alias("adgroup_id"),
        *[_text(F.col(f"entry.{f}")).alias(f) for f in ADGROUP_FIELDS],
    )
    return _ordered(rows.filter("adgroup_id != ''"))


def tiktok_adgroups(pages: DataFrame) -> DataFrame:
    """Ad-group details; of repeated ones the newest counts: the last fetch's last page."""
    return DETAILS["tiktok"]["adgroups"].newest(tiktok_adgroup_rows(pages))


def tiktok_flat(reports: DataFrame, adgroups: DataFrame, rejects=False) -> DataFrame:
    """Report pages with their advertiser_id x ad-group details; `rejects` as in `asa_flat`."""
    found = payloads.entries(
        require_success(reports), "data.list", payloads.TIKTOK_REPORT_ROW, "advertiser_id"
    )
    listed = _listed(found, rejects).withColumn("level", F.lit("row"))
    more = [c for c in REJECT_COLUMNS if rejects]
    rows = listed.filter("advertiser_id != ''").select(
        "advertiser_id",
        report_date(
            F.coalesce(
                F.nullif(F.col("entry.dimensions.stat_time_day"), F.lit("")),
                F.col("entry.dimensions.`stat_time_day.0`"),
            )
        ).alias("date"),
        _text(F.col("entry.dimensions.country_code")).alias("country"),
        _text(F.col("entry.dimensions.adgroup_id")).alias("adgroup_id"),
        amount_blank_is_zero(F.col("entry.metrics.spend")).alias("spend"),
        _text(F.col("entry.metrics.currency")).alias("currency"),
        *more,
    )
    named = lookups.attach_or_blank(rows, adgroups, ["advertiser_id", "adgroup_id"], ADGROUP_FIELDS)
    return _out(named, "advertiser_id")


def flatten_tiktok(reports: DataFrame, adgroups: DataFrame) -> DataFrame:
    """`tiktok_flat` with the ad-group details as pages, with their advertiser_id."""
    return tiktok_flat(reports, tiktok_adgroups(adgroups))


# --- Meta --------------------------------------------------------------------
def meta_currency_rows(accounts: DataFrame) -> DataFrame:
    """(account, currency) of each account page; without dates and files the greater currency is the newer."""
    return _ordered(accounts.select("account_id", "currency", *payloads.order_columns(accounts)))


def meta_flat(insights: DataFrame, currencies: DataFrame, rejects=False) -> DataFrame:
    """Insight pages (with their account_id) x account currencies; `rejects` as in `asa_flat`.

    A missing amount is an error downstream (required value), a malformed one fails the job;
    missing ids stay null.
    """
    found = payloads.entries(insights, "data", payloads.META_INSIGHT, "account_id")
    listed = _listed(found, rejects).withColumn("level", F.lit("row"))
    more = [c for c in REJECT_COLUMNS if rejects]
    rows = listed.select(
        "account_id",
        report_date(F.col("entry.date_start")).alias("date"),
        F.col("entry.country").alias("country"),
        F.col("entry.spend").cast("double").alias("spend"),
        F.col("entry.adset_id").alias("adgroup_id"),
        F.col("entry.adset_name").alias("adgroup_name"),
        F.col("entry.campaign_id").alias("campaign_id"),
        F.col("entry.campaign_name").alias("campaign_name"),
        *more,
    )
    return _out(lookups.attach_or_blank(rows, currencies, "account_id", ["currency"]), "account_id")


def flatten_meta(insights: DataFrame, accounts: DataFrame) -> DataFrame:
    """`meta_flat` with account pages; the currency is that of the newest page of the account."""
    return meta_flat(insights, DETAILS["meta"]["accounts"].newest(meta_currency_rows(accounts)))


@dataclass(frozen=True)
class Detail:
    """What is taken from one kind of detail pages."""

    schema: str
    ids: list[str]  # from the names of the folders
    rows: Callable[[DataFrame], DataFrame]
    keys: list[str]
    fields: list[str]

    def newest(self, rows: DataFrame, keep_order=False) -> DataFrame:
        """One row per key, the newest whole, without its order unless that is kept."""
        found = lookups.newest_rows(rows, self.keys, self.fields, list(NEWEST))
        return found if keep_order else found.drop(*NEWEST)


DETAILS = {
    "asa": {
        "campaigns": Detail(
            payloads.ASA_CAMPAIGNS, ["org_id"], asa_campaign_rows, ["org_id", "campaign_id"], ["campaign_name"]
        ),
        "details": Detail(payloads.ASA_CAMPAIGN_DETAIL, [], asa_country_rows, ["campaign_id"], ["country"]),
    },
    "tiktok": {
        "adgroups": Detail(
            payloads.TIKTOK_PAGE, ["advertiser_id"], tiktok_adgroup_rows, ["advertiser_id", "adgroup_id"], ADGROUP_FIELDS
        ),
    },
    "meta": {
        "accounts": Detail(payloads.META_ACCOUNT, [], meta_currency_rows, ["account_id"], ["currency"]),
    },
}


def rejected_entries(channel, reports: DataFrame) -> DataFrame:
    """(account, level, place, entry_text) of a channel's report entries that are no objects."""

    def rejected(found, account, level):
        _, bad = payloads.split_entries(found)
        return bad.select(F.col(account).alias("account_id"), F.lit(level).alias("level"), "place", "entry_text")

    if channel == "asa":
        rows = _asa_rows(reports)
        days = _asa_days(payloads.split_entries(rows)[0])
        return rejected(rows, "org_id", "row").unionAll(rejected(days, "org_id", "day"))
    if channel == "tiktok":
        found = payloads.entries(reports, "data.list", payloads.TIKTOK_REPORT_ROW, "advertiser_id")
        return rejected(found, "advertiser_id", "row")
    found = payloads.entries(reports, "data", payloads.META_INSIGHT, "account_id")
    return rejected(found, "account_id", "row")


def to_spend_rows(flat: DataFrame, labels: DataFrame) -> DataFrame:
    """Flat rows of selected accounts, labelled and cleaned for the spend table."""
    return conform(lookups.label_accounts(flat, labels))
