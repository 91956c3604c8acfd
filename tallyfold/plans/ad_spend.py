"""Daily ad spend of three channels in one shape, in US dollars.

Three narrow scans and a union: nothing is shuffled.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.functions import spend as sp
from tallyfold.operators.lookups import first_label
from tallyfold.rules import EXAMPLE, MAX_BRANCHES

COLUMNS = [
    "date",
    "channel",
    "country",
    "ad_account",
    "platform",
    "campaign_id",
    "campaign_name",
    "adgroup_id",
    "adgroup_name",
    "spend_in_currency",
    "currency",
    "spend_in_usd",
]


def _shape(rows: DataFrame, channel, app, platform, usd) -> DataFrame:
    computed = {
        "channel": F.lit(channel),
        "ad_account": app,
        "platform": platform,
        "spend_in_currency": F.col("spend"),
        "spend_in_usd": usd,
    }
    return rows.select(*[computed.get(c, F.col(c)).alias(c) for c in COLUMNS])


def conform_asa(rows: DataFrame, rules=EXAMPLE) -> DataFrame:
    """Search campaigns of the app their name starts with; the store is iOS only."""
    return _shape(
        rows.filter(sp.is_asa_campaign("campaign_name", rules)),
        fv.CHANNEL_ASA,
        sp.asa_app("campaign_name", rules),
        F.lit(fv.PLATFORM_IOS),
        sp.asa_usd("spend", rules),
    )


def _labelled(rows: DataFrame, labels) -> DataFrame:
    """Rows whose account label contains one of the labels, `label_app` being the first one's app."""
    if len(labels) > MAX_BRANCHES:
        return first_label(rows, "ad_account", labels, "label_app")
    kept = rows.filter(sp.label_matches("ad_account", labels))
    return kept.withColumn("label_app", sp.first_label_app("ad_account", labels))


def conform_meta(rows: DataFrame, rules=EXAMPLE) -> DataFrame:
    """Accounts whose label contains a listed one; only an equal label names the app."""
    return _shape(
        _labelled(rows, rules.meta_labels),
        fv.CHANNEL_META,
        sp.meta_app("ad_account", rules),
        sp.platform_from_campaign("campaign_name"),
        sp.meta_usd("spend", "currency", rules),
    )


def conform_tiktok(rows: DataFrame, rules=EXAMPLE) -> DataFrame:
    return _shape(
        _labelled(rows, rules.tiktok_labels),
        fv.CHANNEL_TIKTOK,
        F.col("label_app"),
        sp.platform_from_campaign("campaign_name"),
        sp.tiktok_usd("spend", rules),
    )


def ad_spend(asa: DataFrame, meta: DataFrame, tiktok: DataFrame, rules=EXAMPLE) -> DataFrame:
    """All channels; `rules` name the apps and hold the rates."""
    return (
        conform_asa(asa, rules)
        .unionByName(conform_meta(meta, rules))
        .unionByName(conform_tiktok(tiktok, rules))
    )
