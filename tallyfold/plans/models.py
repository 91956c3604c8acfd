"""The warehouse models: declared sources in, one replaced table out.

Apps, labels and rates come from the declared rule tables, unless they are given.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tallyfold import fixed_values as fv
from tallyfold.plans import ad_spend, customers, store_transactions
from tallyfold.rules import Rules, apps_from, spend_rules
from tallyfold.sinks.tables import table_name, write_model
from tallyfold.sources.tables import read_source


@dataclass(frozen=True)
class Model:
    custom_schema: str
    alias: str
    # From a reader of source tables, one of upstream models and the rules.
    build: Callable[[Callable[[str, str], DataFrame], Callable[[str], DataFrame], Rules], DataFrame]
    # The rules that the model needs: of apps, of spend or none.
    needs: str = ""


IOS, ANDROID = "Transactions_appstoreconnect", "Transactions_googleplay"


def _ios(source, upstream, rules):
    return store_transactions.ios_transactions(
        source("asc", "Notification"), source("core", "Products"), rules
    )


def _android(source, upstream, rules):
    return store_transactions.play_transactions(
        source("googleplay", "Notification"), source("core", "Products"), rules
    )


def _unified(source, upstream, rules):
    return store_transactions.unified_transactions(upstream(IOS), upstream(ANDROID))


def _ad_spend(source, upstream, rules):
    return ad_spend.ad_spend(
        *[source("ads", fv.SPEND_TABLES[channel]) for channel in ("asa", "meta", "tiktok")], rules
    )


def _billing(table, product, source, upstream, rules):
    rolled = customers.customer_rollup(source("raw", table), source("core", "Products"), product)
    return rolled.withColumnsRenamed(fv.BILLING_MODEL_NAMES)


def _events(source, upstream, rules):
    android, ios = (source("raw", table) for table in fv.EVENT_TABLES)
    rolled = customers.activation_rollup(
        android, ios, source("core", "Products"), allow_fanout=True
    )
    return rolled.withColumnsRenamed(fv.EVENT_MODEL_NAMES)


# In an order in which each model comes after those it reads.
MODELS = {
    IOS: Model("AppStoreConnect", "Transactions", _ios, "apps"),
    ANDROID: Model("GooglePlay", "Transactions", _android, "apps"),
    "Transaction": Model("Core", "Transaction", _unified),
    "AdSpend": Model("Core", "AdSpend", _ad_spend, "spend"),
    **{
        name: Model("Experimentation", name, partial(_billing, table, product))
        for name, (table, product) in fv.BILLING_MODELS.items()
    },
    fv.EVENT_MODEL: Model("Experimentation", fv.EVENT_MODEL, _events),
}


def _source(spark, paths, laid_out):
    return lambda *table: read_source(spark, *table, (paths or {}).get(table), laid_out)


def _rules(source, needs) -> Rules:
    """The rules that a model needs, from their declared tables."""
    if needs == "apps":
        return Rules(apps=apps_from(source("rules", "Apps")))
    if needs == "spend":
        return Rules(**spend_rules(source("rules", "Labels"), source("rules", "Rates")))
    return Rules()


def model(spark: SparkSession, name, paths=None, rules=None, laid_out=False) -> DataFrame:
    """A model as one lazy DataFrame, upstream models and all.

    `paths` maps (source, table) to Parquet paths; other sources are in the catalog. Without
    `rules` those are read from the rule tables; one that is empty is an error. With `laid_out`
    event tables are read from their copies in buckets where there are such (see `layouts`).
    """

    def upstream(other):
        return model(spark, other, paths, rules, laid_out)

    source = _source(spark, paths, laid_out)
    return MODELS[name].build(source, upstream, rules or _rules(source, MODELS[name].needs))


def run_model(spark: SparkSession, name, target, paths=None, rules=None, laid_out=False):
    """Build a model and replace its table; returns the table's name.

    Upstream models are read from their tables, so they have to be run before. Sources, rules
    and copies are as in `model`.
    """

    def upstream(other):
        return spark.table(table_name(target, MODELS[other].alias, MODELS[other].custom_schema))

    chosen, source = MODELS[name], _source(spark, paths, laid_out)
    rows = chosen.build(source, upstream, rules or _rules(source, chosen.needs))
    return write_model(rows, target, chosen.alias, chosen.custom_schema)
