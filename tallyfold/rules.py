"""Business rules that differ between deployments: apps, account labels, rates.

They are data. `from_tables` reads them from small declared tables; `EXAMPLE` has neutral
values, which the tests and the workload use. Accounts are in `sources/accounts.py`.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tallyfold import fixed_values as fv

APPS = "bundle_id string, app string"
LABELS = "channel string, label string, app string, place int"
RATES = "channel string, currency string, usd double"

#: Most rows of a rule table.
MAX_RULES = 1000
#: Up to so many labels of a channel are branches of an expression; more are joined.
MAX_BRANCHES = 50


@dataclass(frozen=True)
class Rules:
    """The rules as plain mappings; labels match in the order they are listed."""

    apps: dict[str, str] = field(default_factory=lambda: dict(fv.APP_BY_BUNDLE))
    asa_prefixes: dict[str, str] = field(default_factory=lambda: {fv.ASA_CAMPAIGN_PREFIX: fv.ASA_CAMPAIGN_APP})
    meta_labels: dict[str, str] = field(default_factory=lambda: dict(fv.META_APP_BY_LABEL))
    tiktok_labels: dict[str, str] = field(default_factory=lambda: dict(fv.TIKTOK_APP_BY_LABEL))
    asa_rate: float = fv.ASA_USD_RATE
    tiktok_rate: float = fv.TIKTOK_USD_RATE
    meta_rates: dict[str, float] = field(default_factory=lambda: dict(fv.META_USD_RATE))


EXAMPLE = Rules()


class NoRules(ValueError):
    pass


def _rows(name, table: DataFrame, *required) -> list:
    """The rows of a rule table, of a checked size, none of them without a required value."""
    rows = table.limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rows of {name}")
    if not rows:
        raise NoRules(f"the rule table {name} is empty")
    if any(row[column] is None for row in rows for column in required):
        raise ValueError(f"a row of {name} misses one of {', '.join(required)}")
    return rows


def apps_from(apps: DataFrame) -> dict[str, str]:
    return {r.bundle_id: r.app for r in _rows("apps", apps, "bundle_id", "app")}


def spend_rules(labels: DataFrame, rates: DataFrame) -> dict:
    """What the rules say about ad spend, as fields of `Rules`.

    `labels` holds the Meta and TikTok labels and the prefixes of search-ads campaigns, of each
    channel in the order of `place`: the first that matches wins. `rates` has a row for each
    Meta currency, and one without a currency for each of the other channels. A channel
    without labels or rates is an error.
    """
    label_rows = _rows("labels", labels, "channel", "label", "app")
    rate_rows = _rows("rates", rates, "channel", "usd")

    def labelled(channel):
        own = [r for r in label_rows if r.channel == channel]
        if not own:
            raise NoRules(f"no labels of {channel}")
        in_order = sorted(own, key=lambda r: (r.place is None, r.place, r.label))
        first = {}
        for r in in_order:
            first.setdefault(r.label, r.app)
        return first

    usd = {(r.channel, r.currency): r.usd for r in rate_rows}
    missing = [c for c in ("asa", "tiktok") if (c, None) not in usd]
    meta = {c: rate for (channel, c), rate in usd.items() if channel == "meta" and c is not None}
    if missing or not meta:
        raise NoRules(f"no rates of {', '.join(missing or ['meta'])}")
    return {
        "asa_prefixes": labelled("asa"),
        "meta_labels": labelled("meta"),
        "tiktok_labels": labelled("tiktok"),
        "asa_rate": usd["asa", None],
        "tiktok_rate": usd["tiktok", None],
        "meta_rates": meta,
    }


def from_tables(apps: DataFrame, labels: DataFrame, rates: DataFrame) -> Rules:
    """All rules from their tables; see `spend_rules`."""
    return Rules(apps=apps_from(apps), **spend_rules(labels, rates))
