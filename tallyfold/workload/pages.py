"""Report pages as JSON text, one small page per row, parsed back by the source.

The pages carry what the services send: nested rows and daily entries, amounts
that are missing or malformed, two spellings of a date key, error statuses, entries of
the wrong kind, and what was fetched twice.
"""

from pyspark.sql import functions as F

from tallyfold.sources import payloads
from tallyfold.workload import proxies
from tallyfold.workload.proxies import as_frame


def _pages(rows, body, schema, *ids, lists=()):
    """The pages, with entries that are no objects at the head of each of their `lists`.

    One is a text that looks like an object of the list.
    """
    text = F.to_json(F.expr(body))
    for name in lists:
        odd = '"no object",7,"{\\"date\\":\\"2025-01-01\\",\\"id\\":\\"1\\",\\"name\\":\\"n\\"}",'
        text = F.replace(text, F.lit(f'"{name}":['), F.lit(f'"{name}":[{odd}'))
    keep = [*ids, *(c for c in payloads.ORDER if c in rows.columns)]
    return payloads.parse_pages(rows.select(*keep, text.alias("body")), "body", schema, *keep)


def asa_reports(spark, folder):
    """Two days per row; the second day's amount is halved, missing or not a number."""
    rows = as_frame(spark, folder, proxies.ASA_WHOLE)
    body = """
        struct(struct(struct(array(struct(
            struct(adgroup_id AS adGroupId, adgroup_name AS adGroupName) AS metadata,
            array(
                struct(cast(date AS string) AS date,
                       struct(cast(spend AS string) AS amount, currency) AS localSpend),
                struct(cast(date_add(date, 1) AS string) || 'T00:00' AS date,
                       struct(CASE line WHEN 1 THEN NULL WHEN 2 THEN 'x'
                              ELSE cast(spend / 2 AS string) END AS amount,
                              currency) AS localSpend)
            ) AS granularity)) AS row) AS reportingDataResponse) AS data)
    """
    named = rows.withColumnRenamed("account_id", "org_id")
    return _pages(named, body, payloads.ASA_REPORT, "org_id", "campaign_id", lists=["row", "granularity"])


def asa_campaigns(spark, folder):
    """A listed campaign between one without an integer id and one without a name."""
    body = """
        struct(array(struct('c' || campaign_id AS id, campaign_name AS name),
                     struct(campaign_id AS id, campaign_name AS name),
                     struct(campaign_id AS id, cast(NULL AS string) AS name)) AS data)
    """
    rows = as_frame(spark, folder, proxies.CAMPAIGNS)
    return _pages(rows, body, payloads.ASA_CAMPAIGNS, "org_id", lists=["data"])


def asa_details(spark, folder):
    body = """
        struct(struct(campaign_id AS id,
                      slice(array(first, second), 1, countries) AS countriesOrRegions) AS data)
    """
    rows = as_frame(spark, folder, proxies.CAMPAIGN_DETAILS)
    return _pages(rows, body, payloads.ASA_CAMPAIGN_DETAIL)


def tiktok_reports(spark, folder):
    """Two rows per page: a full one, and one with the other date key and a blank amount."""
    rows = as_frame(spark, folder, proxies.TIKTOK_WHOLE)
    # A null field is left out of the text, so each row has one date key.
    body = """
        struct(0 AS code, 'OK' AS message, struct(
            array(
                struct(struct(cast(date AS string) || ' 00:00:00' AS stat_time_day,
                              cast(NULL AS string) AS `stat_time_day.0`,
                              country AS country_code, adgroup_id) AS dimensions,
                       struct(cast(spend AS string) AS spend, currency) AS metrics),
                struct(struct(cast(NULL AS string) AS stat_time_day,
                              cast(date_add(date, 1) AS string) AS `stat_time_day.0`,
                              country AS country_code, adgroup_id) AS dimensions,
                       struct('' AS spend, currency) AS metrics)) AS list,
            struct(1 AS page, 1 AS total_page) AS page_info) AS data)
    """
    account = proxies.item(proxies.TIKTOK_ACCOUNT, "cast(adgroup_id AS bigint) % 7", "|")
    named = rows.withColumn("advertiser_id", F.expr(account))
    return _pages(named, body, payloads.TIKTOK_PAGE, "advertiser_id", lists=["list"])


def tiktok_adgroups(spark, folder):
    body = """
        struct(code, CASE WHEN code <> 0 THEN 'limit reached' ELSE 'OK' END AS message,
               struct(array(struct(adgroup_id, adgroup_name, campaign_id, campaign_name)) AS list,
                      struct(page, 2 AS total_page) AS page_info) AS data)
    """
    rows = as_frame(spark, folder, proxies.ADGROUPS)
    return _pages(rows, body, payloads.TIKTOK_PAGE, "advertiser_id", lists=["list"])


def meta_insights(spark, folder):
    """Two days per page; the second has no ad-set name."""
    body = """
        struct(array(
            struct(cast(date AS string) AS date_start, cast(date AS string) AS date_stop,
                   country, cast(spend AS string) AS spend, adgroup_id AS adset_id,
                   adgroup_name AS adset_name, campaign_id, campaign_name),
            struct(cast(date_add(date, 1) AS string) AS date_start,
                   cast(date_add(date, 1) AS string) AS date_stop,
                   country, cast(spend / 2 AS string) AS spend, adgroup_id AS adset_id,
                   cast(NULL AS string) AS adset_name, campaign_id, campaign_name)) AS data)
    """
    rows = as_frame(spark, folder, proxies.META_WHOLE)
    return _pages(rows, body, payloads.META_INSIGHTS, "account_id", lists=["data"])


def meta_accounts(spark, folder):
    body = """
        struct('act_' || account_id AS id, account_id, 'account' AS name, currency)
    """
    rows = as_frame(spark, folder, proxies.META_ACCOUNTS)
    return _pages(rows, body, payloads.META_ACCOUNT)
