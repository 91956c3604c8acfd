"""Ad-spend scalars: platform, app, US dollars, text and amount cleaning."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.functions.store import pick_first
from tallyfold.rules import EXAMPLE


def platform_from_campaign(name) -> Column:
    """iOS when the name says IOS, Android when it says AND, else iOS."""
    upper = F.upper(F.col(name))
    return pick_first(
        [
            (upper.contains("IOS"), fv.PLATFORM_IOS),
            (upper.contains("AND"), fv.PLATFORM_ANDROID),
        ],
        fv.PLATFORM_IOS,
    )


def contains_like(column, label) -> Column:
    """SQL LIKE containment, so `_` in the label matches any one character."""
    return F.col(column).like(f"%{label}%")


def label_matches(column, labels) -> Column:
    return reduce(or_, [contains_like(column, label) for label in labels])


def starts_like(column, prefix) -> Column:
    """The column begins with the prefix, in any letter case."""
    return F.upper(F.substring(F.col(column), 1, len(prefix))) == prefix.upper()


def is_asa_campaign(name, rules=EXAMPLE) -> Column:
    return reduce(or_, [starts_like(name, prefix) for prefix in rules.asa_prefixes])


def asa_app(campaign_name, rules=EXAMPLE) -> Column:
    arms = [(starts_like(campaign_name, prefix), app) for prefix, app in rules.asa_prefixes.items()]
    return pick_first(arms, fv.UNKNOWN_APP)


def meta_app(label, rules=EXAMPLE) -> Column:
    """App by exact label; a merely similar label is unknown."""
    pairs = F.create_map(*[F.lit(part) for pair in rules.meta_labels.items() for part in pair])
    return F.coalesce(F.try_element_at(pairs, F.col(label)), F.lit(fv.UNKNOWN_APP))


def first_label_app(label, labels) -> Column:
    """App of the first listed label that the text contains."""
    return pick_first([(contains_like(label, text), app) for text, app in labels.items()], fv.UNKNOWN_APP)


def tiktok_app(label, rules=EXAMPLE) -> Column:
    return first_label_app(label, rules.tiktok_labels)


def asa_usd(spend, rules=EXAMPLE) -> Column:
    return F.col(spend) * F.lit(rules.asa_rate)


def tiktok_usd(spend, rules=EXAMPLE) -> Column:
    """One rate, whatever the currency column says."""
    return F.col(spend) * F.lit(rules.tiktok_rate)


def meta_usd(spend, currency, rules=EXAMPLE) -> Column:
    """By currency; null for one without a rate."""
    arms = [
        (F.col(currency) == code, F.col(spend) * F.lit(rate))
        for code, rate in rules.meta_rates.items()
    ]
    return pick_first(arms)


def blank_to_null(value) -> Column:
    return F.nullif(F.col(value) if isinstance(value, str) else value, F.lit(""))


def six_decimals(spend) -> Column:
    return F.round(F.col(spend), 6)


def report_date(text) -> Column:
    """Calendar day of a report stamp: its first ten characters, null if no date."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def amount_or_zero(text) -> Column:
    """Missing or malformed amounts count as zero."""
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def amount_blank_is_zero(text) -> Column:
    """Missing or blank amounts are zero; a malformed one is an error."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("0")).cast("double")
