"""Ad accounts: the default set and the set being back-filled."""

from pyspark.sql import DataFrame, SparkSession

from tallyfold import fixed_values as fv
from tallyfold.operators.spend_rows import check_channel
from tallyfold.rules import NoRules
from tallyfold.sources.tables import ACCOUNTS, read_source

SCHEMA = ACCOUNTS


def accounts(spark: SparkSession) -> DataFrame:
    """(channel, ad_account, account_id, is_new) of the example; a few dozen rows."""
    rows = [
        (channel, label, account, is_new)
        for is_new, sets in ((False, fv.ACCOUNTS), (True, fv.NEW_ACCOUNTS))
        for channel, labels in sets.items()
        for label, account in labels.items()
    ]
    return spark.createDataFrame(rows, SCHEMA)


def declared_accounts(spark: SparkSession, path=None) -> DataFrame:
    """The accounts of a deployment, from the catalog or a Parquet path; an empty table is an error."""
    found = read_source(spark, "rules", "Accounts", path)
    if found.isEmpty():
        raise NoRules("the rule table Accounts is empty")
    return found


def select_accounts(dimension: DataFrame, channel=None, new=False) -> DataFrame:
    """Accounts of one channel or of all, without blank ids."""
    chosen = dimension.filter((dimension.is_new == new) & (dimension.account_id != ""))
    return chosen.filter(chosen.channel == check_channel(channel)) if channel else chosen
