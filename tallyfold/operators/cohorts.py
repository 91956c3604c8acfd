"""Lifecycle cohorts: which ids started, converted, expired or bought directly.

A cohort is a set of row signals and a verdict over "did any row of this id
show the signal". The same signals serve the stand-alone cohort queries and the
one-pass rollups. An id that is null never belongs to a cohort.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.store import base_order_id, is_first_renewal, not_blank
from tallyfold.operators.lookups import spread_join
from tallyfold.operators.picks import any_row


def members(rows: DataFrame, key, signals, verdict) -> DataFrame:
    """Ids whose rows, taken together, satisfy the verdict.

    Only rows showing one of the signals take part, so the filter reaches the
    scan; what is shuffled is one row of flags per id and task.
    """
    relevant = reduce(or_, signals.values())
    keys = [key] if isinstance(key, str) else list(key)
    return (
        rows.filter(F.col(keys[0]).isNotNull() & relevant)
        .groupBy(*keys)
        .agg(*[any_row(p).alias(name) for name, p in signals.items()])
        .filter(verdict)
        .select(*keys)
    )


def distinct_ids(rows: DataFrame, *columns) -> DataFrame:
    return rows.select(*columns).distinct()


def restrict_to(rows: DataFrame, ids: DataFrame, key) -> DataFrame:
    """Rows whose id is in the set."""
    return spread_join(rows, ids, [key], "left_semi")


def exclude(rows: DataFrame, ids: DataFrame, key) -> DataFrame:
    """Rows whose id is not in the set; rows without an id are kept."""
    return spread_join(rows, ids, [key], "left_anti")


def flag_members(rows: DataFrame, ids: DataFrame, key, name) -> DataFrame:
    """All rows, with a flag telling whether the id is in the (distinct) set."""
    marked = ids.withColumn(name, F.lit(True))
    return spread_join(rows, marked, [key]).withColumn(
        name, F.coalesce(F.col(name), F.lit(False))
    )


def tally(rows: DataFrame, key, signals) -> DataFrame:
    """How often each signal occurs per id."""
    return rows.groupBy(key).agg(*[F.count_if(p).alias(n) for n, p in signals.items()])


# --- iOS notifications -------------------------------------------------------
IOS_ID = "originalTransactionId"


def ios_signals() -> dict[str, Column]:
    kind = F.col("NotificationType")
    return {
        "trial": F.col("offerDiscountType") == "FREE_TRIAL",
        "renewed": kind == "DID_RENEW",
        "expired": kind == "EXPIRED",
        "renewal_failed": kind == "DID_FAIL_TO_RENEW",
        "refunded": kind == "REFUND",
        "resubscribed": F.col("SubType") == "RESUBSCRIBE",
    }


def _ios(rows, verdict, *names):
    signals = ios_signals()
    return members(rows, IOS_ID, {n: signals[n] for n in names}, verdict)


def ios_trials(rows):
    return _ios(rows, "trial", "trial")


def ios_converted(rows):
    return _ios(rows, "trial AND renewed", "trial", "renewed")


def ios_expired(rows):
    """Trials that lapsed without coming back, or were refunded."""
    return _ios(
        rows,
        "trial AND (refunded OR (expired AND NOT resubscribed))",
        "trial", "expired", "resubscribed", "refunded",
    )


def ios_pending(rows):
    """Trials whose renewal failed and has not been settled either way."""
    return _ios(
        rows,
        "trial AND renewal_failed AND NOT (expired OR renewed OR resubscribed)",
        "trial", "renewal_failed", "expired", "renewed", "resubscribed",
    )


# --- Android notifications ---------------------------------------------------
PLAY_ID = "base_order_id"


def with_base_order(rows: DataFrame) -> DataFrame:
    """The rows with their base order; rows that are laid out by it have it already."""
    if PLAY_ID in rows.columns:
        return rows
    return rows.withColumn(PLAY_ID, base_order_id("latestOrderId"))


def is_base_order() -> Column:
    return F.col("latestOrderId") == F.col(PLAY_ID)


def play_signals() -> dict[str, Column]:
    active = F.col("subscriptionState") == "SUBSCRIPTION_STATE_ACTIVE"
    free = F.col("offerPhase") == "FREE_TRIAL"
    return {
        "trial": is_base_order() & active & free,
        "renewed": is_first_renewal("latestOrderId") & active & free,
        "direct": is_base_order() & active & (F.col("offerPhase") == "BASE"),
    }


def _play(rows, verdict, *names):
    signals = play_signals()
    return members(with_base_order(rows), PLAY_ID, {n: signals[n] for n in names}, verdict)


def play_trials(rows):
    return _play(rows, "trial", "trial")


def play_converted(rows):
    return _play(rows, "trial AND renewed", "trial", "renewed")


def play_direct(rows):
    return _play(rows, "direct", "direct")


# --- billing rows ------------------------------------------------------------
BILLING_ID = "rc_original_app_user_id"


def billing_signals() -> dict[str, Column]:
    owner = F.coalesce(F.col("ownership_type"), F.lit("PURCHASED"))
    converts = F.col("is_trial_conversion")
    refunded = F.col("refunded_at").isNotNull()
    return {
        "trial": F.col("is_trial_period")
        & (F.col("is_sandbox") == F.lit(False))
        & (owner != "FAMILY_SHARED"),
        "conversion": converts,
        "kept_conversion": converts & ~refunded,
        "refunded": refunded,
    }


def _billing(rows, verdict, *names):
    signals = billing_signals()
    return members(rows, BILLING_ID, {n: signals[n] for n in names}, verdict)


def billing_trials(rows):
    return _billing(rows, "trial", "trial")


def billing_converted_lenient(rows):
    """A conversion row that was not itself refunded."""
    return _billing(rows, "trial AND kept_conversion", "trial", "kept_conversion")


def billing_converted_strict(rows):
    """A conversion row, and no refunded row at all."""
    return _billing(
        rows, "trial AND conversion AND NOT refunded", "trial", "conversion", "refunded"
    )


# --- subscription events -----------------------------------------------------
EVENT_ID = "q_user_id"
EVENT_TIME = "event_ts"


def event_is(name) -> Column:
    return F.col("event_name") == name


def event_times(rows: DataFrame, event, name, distinct=False) -> DataFrame:
    """(user, time) of each event of one kind."""
    found = rows.filter(event_is(event)).select(EVENT_ID, F.col(EVENT_TIME).alias(name))
    return found.distinct() if distinct else found


def event_trials(rows):
    started = event_times(rows, "Trial Started", "trial_start_date", distinct=True)
    return started.filter(F.col(EVENT_ID).isNotNull())


def event_cancels(rows):
    return event_times(rows, "Subscription Canceled", "cancel_date")


def event_direct(rows):
    return event_times(rows, "Subscription Started", "direct_subscription_date")


def conversion_moments(rows: DataFrame) -> DataFrame:
    """(user, time) with a conversion that nothing at that same time revokes.

    Grouped by both columns, so the events of one busy user spread over tasks.
    """
    signals = {
        "converted": event_is("Trial Converted"),
        "canceled": event_is("Trial Canceled"),
        "expired": event_is("Trial Expired"),
        "refunded": not_blank("Refund"),
    }
    return members(
        rows,
        (EVENT_ID, EVENT_TIME),
        signals,
        "converted AND NOT (canceled OR expired OR refunded)",
    )


def event_converted(rows: DataFrame) -> DataFrame:
    """Conversion moments of users who started a trial at any time."""
    trials = rows.filter(event_is("Trial Started")).select(EVENT_ID).distinct()
    return restrict_to(conversion_moments(rows), trials, EVENT_ID).withColumnRenamed(
        EVENT_TIME, "trial_converted_date"
    )


def attribute_activation(converted_at, direct_at) -> dict[str, Column]:
    """Which of the two activations came first; a tie goes to the direct one."""
    converted_at, direct_at = F.col(converted_at), F.col(direct_at)
    by_trial = converted_at.isNotNull() & (direct_at.isNull() | (converted_at < direct_at))
    directly = direct_at.isNotNull() & (converted_at.isNull() | (direct_at <= converted_at))
    return {
        "has_converted_trial": by_trial,
        "has_started_direct_subscription": directly,
        "user_activated_at": F.least(converted_at, direct_at),
    }
