"""Store-side scalars: apps, order ids, SKUs, durations, price choice."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.rules import EXAMPLE

RENEWAL_MARK = ".."
RENEWAL_SUFFIX = r"\.\.\d+\z"
FIRST_RENEWAL = "..0"

# (text contained in the lower-case SKU, duration), first match wins.
DURATION_WORDS = [
    ("lifetime", "Lifetime"),
    ("year", "1 year"),
    ("premium", "1 month"),
    ("month", "1 month"),
]


def app_name(bundle, rules=EXAMPLE) -> Column:
    """App of a bundle id; null when it is none of ours."""
    bundle = F.col(bundle) if isinstance(bundle, str) else bundle
    return F.try_element_at(F.create_map(*[F.lit(part) for pair in rules.apps.items() for part in pair]), bundle)


def is_known_bundle(bundle, rules=EXAMPLE) -> Column:
    return F.col(bundle).isin(list(rules.apps))


def base_order_id(order_id) -> Column:
    """Order id without the renewal suffix `..N`; ids without one skip the pattern."""
    order = F.col(order_id)
    return F.when(
        order.contains(RENEWAL_MARK), F.regexp_replace(order, RENEWAL_SUFFIX, "")
    ).otherwise(order)


def is_first_renewal(order_id) -> Column:
    return F.col(order_id).endswith(FIRST_RENEWAL)


def composite_sku(product, base_plan) -> Column:
    """`product:plan` when there is a plan, else the product."""
    plan = F.col(base_plan).cast("string")
    sku = F.col(product).cast("string")
    return F.when(plan != "", F.concat(sku, F.lit(":"), plan)).otherwise(sku)


def duration_from_sku(sku) -> Column:
    sku = F.col(sku) if isinstance(sku, str) else sku
    return pick_first([(F.lower(sku).contains(w), d) for w, d in DURATION_WORDS])


def price_by_platform(platform, listed, charged) -> Column:
    """iOS events carry no price of their own: take the listed one."""
    return F.when(F.col(platform) == fv.PLATFORM_IOS, listed).otherwise(charged)


def not_blank(value) -> Column:
    """True for a value of any type whose text is not empty; null is blank."""
    return F.coalesce(F.col(value).cast("string"), F.lit("")) != ""


def pick_first(arms, default=None) -> Column:
    """CASE over (condition, value) pairs."""
    (condition, value), *rest = arms
    case = reduce(lambda acc, arm: acc.when(*arm), rest, F.when(condition, value))
    return case if default is None else case.otherwise(default)
