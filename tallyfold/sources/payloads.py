"""Landed report pages: nested JSON with declared schemas.

A provider's pages lie in one directory per account or campaign, named like
`advertiser_id=123/`, so the id becomes a column and all pages are one scan.

The entries of a page's lists are variants: a page is parsed once, and each entry keeps its
kind, so one of the wrong kind costs itself and not its page, and a text that looks like an
object is still a text.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ASA_REPORT = "data struct<reportingDataResponse: struct<row: array<variant>>>"
ASA_ROW = """
    metadata struct<adGroupId: string, adGroupName: string>,
    granularity array<variant>
"""
ASA_DAY = "date string, localSpend struct<amount: string, currency: string>"
ASA_CAMPAIGNS = "data array<variant>"
ASA_CAMPAIGN = "id string, name string"
ASA_CAMPAIGN_DETAIL = "data struct<id: string, countriesOrRegions: array<string>>"
TIKTOK_PAGE = """
    code int,
    message string,
    data struct<list: array<variant>, page_info: struct<page: int, total_page: int>>
"""
TIKTOK_REPORT_ROW = """
    dimensions struct<
        stat_time_day: string,
        `stat_time_day.0`: string,
        country_code: string,
        adgroup_id: string>,
    metrics struct<spend: string, currency: string>
"""
TIKTOK_ADGROUP = """
    adgroup_id string, adgroup_name string, campaign_id string, campaign_name string
"""
META_INSIGHTS = "data array<variant>"
META_INSIGHT = """
    date_start string,
    date_stop string,
    country string,
    spend string,
    adset_id string,
    adset_name string,
    campaign_id string,
    campaign_name string
"""
META_ACCOUNT = "id string, account_id string, name string, currency string"

# Where a page comes from; what is fetched later is newer, then what lies further on.
ORDER = ["fetch_date", "page_file"]


def read_pages(spark: SparkSession, path, schema, *id_columns) -> DataFrame:
    """All pages under a directory, with the ids and dates of their folders and their file.

    Folders may also be named like `report_date=2025-07-01/` (the day that reports are
    about) and `fetch_date=2025-07-02/`; without them these columns are null. A filter on
    them is applied to the folders, before any page is opened.
    """
    fields = StructType.fromDDL(schema)
    for name in id_columns:
        fields = fields.add(name, "string")
    fields = fields.add("report_date", "date").add("fetch_date", "date")
    pages = spark.read.schema(fields).option("multiLine", True).json(path)
    return pages.withColumn("page_file", F.col("_metadata.file_path"))


def parse_pages(pages: DataFrame, text, schema, *keep) -> DataFrame:
    """The same from a text column; `keep` are columns carried along.

    The page is unfolded by a generator, past which no filter moves: a text is
    parsed once, however many conditions later look into it.
    """
    return pages.select(*keep, F.inline(F.array(F.from_json(text, schema))))


def split_errors(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, failed) pages by status code; a page without a code has failed."""
    good = F.coalesce(F.col("code") == 0, F.lit(False))
    return pages.filter(good), pages.filter(~good)


def require_success(pages: DataFrame) -> DataFrame:
    """The pages; reading one with an error status fails the job."""
    failure = F.raise_error(
        F.concat(F.lit("report error: "), F.coalesce("message", F.lit("unknown error")))
    )
    data = F.when(F.col("code") == 0, F.col("data"))
    return pages.withColumn("data", data.otherwise(failure.cast(pages.schema["data"].dataType)))


def entries(pages: DataFrame, items, schema, *keep) -> DataFrame:
    """One row per entry of a list of variants: `keep`, its place, its JSON text, and `entry` if it is an object.

    The entry is read behind a generator, so that conditions on it don't read it again. A
    field of another kind than declared is null.
    """
    found = pages.select(*keep, F.posexplode(items).alias("place", "found"))
    entry = F.try_variant_get("found", "$", f"struct<{schema}>")
    return found.select(
        *found.columns[:-1],
        F.to_json("found").alias("entry_text"),
        F.explode(F.array(entry)).alias("entry"),
    )


def split_entries(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): rejected entries are no objects."""
    return found.filter("entry IS NOT NULL"), found.filter("entry IS NULL").drop("entry")


def good_entries(pages: DataFrame, items, schema, *keep) -> DataFrame:
    return split_entries(entries(pages, items, schema, *keep))[0]


def order_columns(pages: DataFrame) -> list[str]:
    return [c for c in ORDER if c in pages.columns]
