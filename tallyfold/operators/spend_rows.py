"""Rules for report rows on their way into the spend table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.functions.spend import blank_to_null, six_decimals

REQUIRED = ["date", "ad_account", "country", "spend"]
OPTIONAL = ["currency", "campaign_id", "campaign_name", "adgroup_id", "adgroup_name"]
SPEND_COLUMNS = [
    "date", "ad_account", "country", "spend",
    "currency", "campaign_id", "campaign_name", "adgroup_id", "adgroup_name",
]
CSV_COLUMNS = [
    "date", "app", "country", "spend",
    "currency", "campaign_id", "campaign_name", "adgroup_id", "adgroup_name",
]


def check_channel(channel):
    """The channel name, or an error for one that does not exist."""
    if channel not in fv.ACCOUNTS:
        raise ValueError(f"unknown channel {channel!r}; choose from {', '.join(fv.ACCOUNTS)}")
    return channel


def conform(rows: DataFrame, *more) -> DataFrame:
    """Spend to six decimals and empty optional texts to null; `more` columns are kept as they are."""
    return rows.select(
        "date", "ad_account", "country",
        six_decimals("spend").alias("spend"),
        *[blank_to_null(c).alias(c) for c in OPTIONAL],
        *more,
    )


def with_reason(rows: DataFrame) -> DataFrame:
    """Rows with the reason why they can't be loaded: the one they have, or a missing required value."""
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    incomplete = F.when(~is_valid(), F.concat(F.lit("a required value is missing: "), missing))
    return rows.withColumn("reason", F.coalesce("reason", incomplete))


def is_valid() -> Column:
    ok = F.lit(True)
    for name in REQUIRED:
        ok = ok & F.col(name).isNotNull()
    return ok


def split_required(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows miss a required value."""
    return rows.filter(is_valid()), rows.filter(~is_valid())


def require(rows: DataFrame) -> DataFrame:
    """The rows; reading one that misses a required value fails the job."""
    failure = F.raise_error(F.lit(f"a required value is missing: {', '.join(REQUIRED)}"))
    return rows.withColumn(
        "date", F.when(is_valid(), F.col("date")).otherwise(failure.cast("date"))
    )


def to_fields(rows: DataFrame, fields) -> DataFrame:
    """The rows with a table's columns, found by name in any letter case; missing ones null."""
    have = {c.lower(): F.col(f"`{c}`") for c in rows.columns}
    return rows.select(
        *[have.get(f.name.lower(), F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def with_missing_columns(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Stack two generations of a table; columns of either side survive."""
    present = {c.lower() for c in rows.columns}
    added = [f for f in other.schema.fields if f.name.lower() not in present]
    fields = [*rows.schema.fields, *added]
    return to_fields(rows, fields).unionAll(to_fields(other, fields))


def csv_rows(rows: DataFrame) -> DataFrame:
    """The nine text columns of the CSV report, spend with six decimals."""
    values = {c: F.coalesce(F.col(c), F.lit("")) for c in OPTIONAL}
    values["date"] = F.col("date").cast("string")
    values["app"] = F.col("ad_account")
    values["spend"] = F.format_string("%.6f", "spend")
    return rows.select(*[values.get(c, F.col("country")).alias(c) for c in CSV_COLUMNS])
