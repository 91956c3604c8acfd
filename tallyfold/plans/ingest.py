"""Landed report pages of one provider to spend rows, and on to its table.

Landing layout, one folder per provider:

    asa/reports/org_id=*/campaign_id=*/   asa/campaigns/org_id=*/   asa/details/
    tiktok/reports/advertiser_id=*/       tiktok/adgroups/advertiser_id=*/
    meta/insights/account_id=*/           meta/accounts/

Reports have a further folder level `report_date=*/` above these, the day they are about,
and the others may have `fetch_date=*/`. A load opens the report pages of its window only, so
an old page with an error status does not stop it. Of the others it opens those fetched since
the load before: what that one knew is kept in a table beside the spend table, the newest row
of each key, and is merged with the new pages. Pages without the level are always read.

A load that is given a name is done once for each channel and window. Its begin and its end
are rows of the table `Loads`; when it is called again, only what is missing is loaded.
"""

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.operators import lookups
from tallyfold.operators.spend_rows import check_channel, conform, with_reason
from tallyfold.operators.windows import report_window
from tallyfold.plans import ad_reports
from tallyfold.plans.ad_reports import DETAILS, NEWEST, REJECT_COLUMNS
from tallyfold.sinks.tables import append_rejects, append_rows, append_spend, load_spend, table_name, write_model
from tallyfold.sources import payloads
from tallyfold.sources.accounts import declared_accounts, select_accounts

LOADS = "`AdSpend`.`Loads`"
LOAD = """
    channel string, first date, last date, run string, state string, rows_before long,
    read long, written long, rejected long, at timestamp
"""


@dataclass(frozen=True)
class Loaded:
    """What a load did: `written` and `rejected` make up `read`."""

    table: str
    read: int
    written: int
    rejected: int
    state: str = "loaded"


class LoadInDoubt(RuntimeError):
    """An earlier attempt has written something, but other rows than this one would."""


class LoadFailed(RuntimeError):
    """Some channels failed; `outcomes` has a `Loaded` or the error for each."""

    def __init__(self, outcomes):
        self.outcomes = outcomes
        bad = {c: o for c, o in outcomes.items() if isinstance(o, Exception)}
        super().__init__("; ".join(f"{c}: {str(o).splitlines()[0]}" for c, o in bad.items()))


# --- details -------------------------------------------------------------------
def detail_pages(spark: SparkSession, channel, kind, folder, since=None) -> DataFrame:
    """Pages of one kind of details, without those fetched before the day `since`."""
    detail = DETAILS[channel][kind]
    pages = payloads.read_pages(spark, f"{folder}/{channel}/{kind}", detail.schema, *detail.ids)
    if since is None:
        return pages
    return pages.filter(F.col("fetch_date").isNull() | (F.col("fetch_date") >= F.lit(since)))


def kept_details(channel, kind):
    """Table of the newest row of each key."""
    return table_name(fv.SPEND_SCHEMA, f"Known_{channel}_{kind}")


def refresh_details(spark: SparkSession, channel, folder) -> dict[str, DataFrame]:
    """What is known of each kind of details, brought up to the newest fetch.

    Only pages fetched since the last refresh are read, those of its last day again. What
    newer fetches no longer list stays as it was. The result is (keys, fields).
    """
    known = {}
    for kind, detail in DETAILS[check_channel(channel)].items():
        table = kept_details(channel, kind)
        kept = spark.table(table) if spark.catalog.tableExists(table) else None
        since = kept.agg(F.max("fetch_date")).first()[0] if kept is not None else None
        rows = detail.rows(detail_pages(spark, channel, kind, folder, since))
        rows = rows.select(*detail.keys, *detail.fields, *NEWEST)
        if kept is not None:
            rows = rows.unionByName(kept)
        write_model(detail.newest(rows, keep_order=True), fv.SPEND_SCHEMA, f"Known_{channel}_{kind}")
        known[kind] = spark.table(table).drop(*NEWEST)
    return known


def _all_details(spark, channel, folder) -> dict[str, DataFrame]:
    """The same from all pages, without the kept tables."""
    return {
        kind: detail.newest(detail.rows(detail_pages(spark, channel, kind, folder)))
        for kind, detail in DETAILS[channel].items()
    }


# --- spend ---------------------------------------------------------------------
def _flat(spark, channel, folder, window, known, rejects) -> DataFrame:
    def reports(kind, schema, *ids):
        day = F.col("report_date")
        pages = payloads.read_pages(spark, f"{folder}/{channel}/{kind}", schema, *ids)
        return pages.filter(day.isNull() | day.between(*window))

    if channel == "asa":
        pages = reports("reports", payloads.ASA_REPORT, "org_id", "campaign_id")
        return ad_reports.asa_flat(pages, known["campaigns"], known["details"], rejects)
    if channel == "tiktok":
        pages = reports("reports", payloads.TIKTOK_PAGE, "advertiser_id")
        return ad_reports.tiktok_flat(pages, known["adgroups"], rejects)
    pages = reports("insights", payloads.META_INSIGHTS, "account_id")
    return ad_reports.meta_flat(pages, known["accounts"], rejects)


def _labelled(spark, channel, folder, window, new, accounts, known, rejects=False) -> DataFrame:
    flat = _flat(spark, channel, folder, window, known, rejects)
    in_window = F.coalesce(F.col("date").between(*window), F.lit(True))
    chosen = accounts if accounts is not None else declared_accounts(spark)
    return lookups.label_accounts(flat.filter(in_window), select_accounts(chosen, channel, new))


def channel_rows(
    spark: SparkSession, channel, folder, start=None, end=None, new=False, accounts=None, known=None
) -> DataFrame:
    """Spend rows of a provider's accounts in a window, by default yesterday.

    Rows without a usable date stay in, so that the load refuses them. Accounts are those of
    the rule table unless they are given. Without `known` details all their pages are read.
    """
    known = known or _all_details(spark, check_channel(channel), folder)
    return conform(_labelled(spark, channel, folder, report_window(start, end), new, accounts, known))


def classified_rows(
    spark: SparkSession, channel, folder, start=None, end=None, new=False, accounts=None, known=None
) -> DataFrame:
    """All entries of the same accounts and window; `reason` says why one can't be loaded.

    That is an entry that is no object, or one that misses a required value.
    """
    known = known or _all_details(spark, check_channel(channel), folder)
    rows = _labelled(spark, channel, folder, report_window(start, end), new, accounts, known, rejects=True)
    return with_reason(conform(rows, "account_id", *REJECT_COLUMNS))


def load_channel(
    spark: SparkSession, channel, folder, start=None, end=None, new=False, overwrite_window=False, accounts=None
):
    """Append a provider's rows to its spend table; returns the table's name.

    A row that misses a required value fails the load.
    """
    known = refresh_details(spark, channel, folder)
    rows = channel_rows(spark, channel, folder, start, end, new, accounts, known)
    table = _spend_table(spark, channel)
    append_spend(rows, table, overwrite_window)
    return table


def _spend_table(spark, channel):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{fv.SPEND_SCHEMA}`")
    return table_name(fv.SPEND_SCHEMA, fv.SPEND_TABLES[channel])


def load_channels(spark: SparkSession, folder, channels=None, start=None, end=None, **options):
    """Load the named channels, by default all, one after another.

    Returns their tables by channel. The first channel that fails ends the run.
    """
    names = [check_channel(c) for c in channels or fv.SPEND_TABLES]
    return {c: load_channel(spark, c, folder, start, end, **options) for c in names}


# --- named loads ---------------------------------------------------------------
def _marks(spark, channel, days, run) -> list:
    if not spark.catalog.tableExists(LOADS):
        return []
    load = {"channel": channel, "run": run, "first": days[0], "last": days[1]}
    found = spark.table(LOADS)
    for name, value in load.items():
        found = found.filter(F.col(name) == F.lit(value))
    return found.orderBy("at").collect()


def _mark(spark, channel, days, run, state, before, counts):
    row = (channel, *days, run, state, before, *counts, datetime.now(timezone.utc))
    append_rows(spark.createDataFrame([row], LOAD), LOADS)


def _rows_of(spark, table, days) -> int:
    if not spark.catalog.tableExists(table):
        return 0
    return spark.table(table).filter(F.col("date").between(*days)).count()


def run_load(
    spark: SparkSession, channel, folder, run, start=None, end=None, new=False, overwrite_window=False, accounts=None
) -> Loaded:
    """Load a channel's window under a name, once.

    Entries that can't be loaded go to the table `Rejects` and do not stop the load. If the
    load was done before, nothing happens. If an attempt was cut off, the rows of the window
    tell whether its write went through: it is repeated, or only marked as done. Other loads
    into the same days must not run at the same time.
    """
    table = _spend_table(spark, check_channel(channel))
    days = tuple(spark.range(1).select(*(day.alias(n) for n, day in zip("ab", report_window(start, end), strict=True))).first())
    marks = _marks(spark, channel, days, run)
    for mark in marks:
        if mark.state == "done":
            return Loaded(table, mark.read, mark.written, mark.rejected, "loaded before")
    known = refresh_details(spark, channel, folder)
    rows = classified_rows(spark, channel, folder, str(days[0]), str(days[1]), new, accounts, known)
    before = _rows_of(spark, table, days)
    if marks and not overwrite_window and before != marks[0].rows_before:
        counted = rows.agg(F.count(F.lit(1)).alias("read"), F.count("reason").alias("rejected")).first()
        written = counted["read"] - counted["rejected"]
        if before != marks[0].rows_before + written:
            raise LoadInDoubt(
                f"{table} has {before} rows from {days[0]} to {days[1]}; it had {marks[0].rows_before} before the load"
                f" {run!r}, which has {written}"
            )
        counts = {"read": counted["read"], "written": written, "rejected": counted["rejected"]}
    else:
        if not marks:
            _mark(spark, channel, days, run, "begun", before, (None, None, None))
        counts = load_spend(rows, table, overwrite_window)
    if counts["rejected"]:
        append_rejects(rows.filter("reason IS NOT NULL"), fv.SPEND_SCHEMA, channel, days, run)
    _mark(spark, channel, days, run, "done", before, (counts["read"], counts["written"], counts["rejected"]))
    return Loaded(table, **counts)


def run_loads(spark: SparkSession, folder, run, channels=None, start=None, end=None, **options) -> dict[str, Loaded]:
    """`run_load` of the named channels, by default all; one that fails does not keep the others.

    Returns what each did, or raises `LoadFailed` with it. Calling it again loads what is missing.
    """
    outcomes = {}
    for channel in [check_channel(c) for c in channels or fv.SPEND_TABLES]:
        try:
            outcomes[channel] = run_load(spark, channel, folder, run, start, end, **options)
        except Exception as error:  # noqa: BLE001 - raised again below, with the others' outcomes
            outcomes[channel] = error
    if any(isinstance(o, Exception) for o in outcomes.values()):
        raise LoadFailed(outcomes)
    return outcomes
