"""Joins of facts to small dimensions: prices, names, currencies, labels."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.countries import country_lower, country_upper

PRICE_FIELDS = [
    "customer_price_in_currency",
    "customer_price_in_usd",
    "expected_proceeds_in_currency",
    "expected_proceeds_in_usd",
    "duration",
]


def spread_join(facts: DataFrame, dimension: DataFrame, keys, how="left") -> DataFrame:
    """Join to a dimension that may come out of an aggregation, safe for hot keys.

    Adaptive execution splits an over-represented key only when both inputs of the
    join are plain shuffles, and an aggregated dimension is not: it is joined where
    its aggregation left it. Joining on the keys and their hash gives it a shuffle
    of its own, of narrow rows, so that the facts of a hot key go to many tasks.
    """
    mark = F.xxhash64(*keys)
    marked = facts.withColumn("_mark", mark), dimension.withColumn("_mark", mark)
    return marked[0].join(marked[1], [*keys, "_mark"], how).drop("_mark")


def _listed(products: DataFrame, country: Column) -> DataFrame:
    return products.select(
        country.alias("price_country"),
        F.col("product_SKU").alias("price_sku"),
        F.struct(*PRICE_FIELDS).alias("prices"),
    )


def _unique(listed: DataFrame) -> DataFrame:
    # One whole row is kept per key, so prices of two rows are never mixed.
    return listed.groupBy("price_country", "price_sku").agg(F.min("prices").alias("prices"))


def price_book(products: DataFrame, extended=False, unique=True) -> DataFrame:
    """(price_country, price_sku) -> prices, with lower-case country keys.

    How it is joined is left to Spark, which knows its size.
    """
    listed = _listed(products, country_lower("country", extended))
    return _unique(listed) if unique else listed


def price_book_by_sku(products: DataFrame) -> DataFrame:
    """price_sku -> map from upper-case country key to prices.

    The keys have at most two letters, which bounds the map of a SKU.
    """
    listed = _unique(_listed(products, F.lower(F.trim(country_upper("country")))))
    return listed.groupBy("price_sku").agg(
        F.map_from_entries(F.collect_list(F.struct("price_country", "prices"))).alias(
            "prices_by_country"
        )
    )


def attach_prices(facts: DataFrame, book: DataFrame, country: Column, sku) -> DataFrame:
    """Left join of the book on a ready-made country key and the SKU."""
    keyed = facts.withColumns({"price_country": country, "price_sku": F.col(sku)})
    keys = ["price_country", "price_sku"]
    return spread_join(keyed, book, keys).drop(*keys)


def priced_by_pairs(spark, priced=None) -> bool:
    """Whether events are priced by the distinct pairs of their ids, after the rollup.

    `priced` is "rows" (each event is joined to the book, which is broadcast if Spark finds it
    small enough), "pairs", or None for pairs where broadcasting is off. A book past the
    broadcast limit is better joined by pairs: the events are then shuffled once, by id.
    """
    if priced not in (None, "rows", "pairs"):
        raise ValueError("priced must be rows or pairs")
    off = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    return priced == "pairs" or (priced is None and off)


def price_pair(country: Column, sku) -> Column:
    """The price key of a row; a rollup collects the distinct ones of an id."""
    return F.struct(country.alias("price_country"), F.col(sku).alias("price_sku"))


def price_rolled(rolled: DataFrame, book: DataFrame, key, pairs="pairs") -> DataFrame:
    """Rolled rows with the least prices over the pairs of their id, as `prices`.

    Only the pairs of the ids meet the book, so its join moves no events, and a pair that very
    many events have counts once an id.
    """
    rest = [c for c in rolled.columns if c not in (key, pairs)]
    each = rolled.select(key, F.struct(*rest).alias("rest"), F.explode_outer(pairs).alias("pair"))
    keyed = each.select(key, "rest", "pair.price_country", "pair.price_sku")
    priced = spread_join(keyed, book, ["price_country", "price_sku"])
    least = priced.groupBy(key).agg(F.first("rest").alias("rest"), F.min("prices").alias("prices"))
    return least.select(key, "rest.*", "prices")


def best_price(countries, prices_by_country) -> Column:
    """Least listed price row over the countries that have one."""
    return F.array_min(
        F.transform(countries, lambda c: F.try_element_at(prices_by_country, F.lower(F.trim(c))))
    )


def price_columns(prices="prices") -> dict[str, Column]:
    return {name: F.col(f"{prices}.{name}") for name in PRICE_FIELDS}


def newest_rows(details: DataFrame, keys, fields, order) -> DataFrame:
    """One row per key: the last one in the given order wins whole, its order columns included."""
    newest = F.max(F.struct(*order, *fields)).alias("newest")
    picked = [F.col(f"newest.{f}").alias(f) for f in [*fields, *order]]
    return details.groupBy(*keys).agg(newest).select(*keys, *picked)


def newest_details(details: DataFrame, keys, fields, order) -> DataFrame:
    """One row per key: the last one in the given order wins whole."""
    return newest_rows(details, keys, fields, order).drop(*order)


def attach_or_blank(facts: DataFrame, details: DataFrame, key, fields) -> DataFrame:
    """Left join; what is not found becomes the empty string."""
    keys = [key] if isinstance(key, str) else key
    return spread_join(facts, details, keys).withColumns(
        {f: F.coalesce(F.col(f), F.lit("")) for f in fields}
    )


def single_country(countries) -> Column:
    """The only country of a campaign, MULTI for several, blank for none."""
    n = F.size(F.coalesce(F.col(countries), F.array().cast("array<string>")))
    return F.when(n == 1, F.col(countries)[0]).when(n > 1, "MULTI").otherwise("")


def first_label(rows: DataFrame, column, labels: dict[str, str], name) -> DataFrame:
    """Rows whose text contains a label (SQL LIKE), with the app of the first such label as `name`.

    For lists of labels that are too long for an expression. Each distinct text is compared
    with the labels once, of a bounded number, and the rows get the answer by an equality join.
    """
    spark = rows.sparkSession
    listed = [(place, f"%{label}%", app) for place, (label, app) in enumerate(labels.items())]
    patterns = F.broadcast(spark.createDataFrame(listed, "place int, pattern string, app string"))
    texts = rows.select(column).distinct()
    fits = texts.join(patterns, F.like(F.col(column), F.col("pattern")))
    first = fits.groupBy(column).agg(F.min_by("app", "place").alias(name))
    return spread_join(rows, first, [column], "inner")


def label_accounts(rows: DataFrame, accounts: DataFrame, *on) -> DataFrame:
    """Rows of the selected accounts, with the account's label as ad_account.

    The accounts, a declared table, go to the rows. Left to the estimates of their sizes, Spark
    shuffles the rows by their few accounts, or sends all of them to every task.
    """
    on = ["account_id", *on]
    return rows.join(F.broadcast(accounts.select(*on, "ad_account")), on)
