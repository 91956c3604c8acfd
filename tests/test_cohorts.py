import datetime as dt

from pyspark.sql import functions as F

from conftest import at
from tallyfold.operators import cohorts, picks
from tallyfold.sources import tables


def ids(frame):
    return sorted(r[0] for r in frame.collect())


def ios(rows, **histories):
    """Each history is a list of (type, subtype, offer)."""
    return rows(
        tables.IOS_NOTIFICATION,
        *[
            {"originalTransactionId": i if i != "null" else None, "NotificationType": t, "SubType": s, "offerDiscountType": o}
            for i, events in histories.items()
            for t, s, o in events
        ],
    )


TRIAL = ("SUBSCRIBED", "INITIAL_BUY", "FREE_TRIAL")
RENEW = ("DID_RENEW", None, None)
EXPIRE = ("EXPIRED", None, None)
FAIL = ("DID_FAIL_TO_RENEW", None, None)
BACK = ("SUBSCRIBED", "RESUBSCRIBE", None)
REFUND = ("REFUND", None, None)


def test_ios_cohorts(rows):
    events = ios(
        rows,
        lapsed=[TRIAL, EXPIRE],
        returned=[TRIAL, EXPIRE, BACK],
        refunded=[TRIAL, EXPIRE, BACK, REFUND],
        failing=[TRIAL, FAIL],
        recovered=[TRIAL, FAIL, RENEW],
        paid=[RENEW, EXPIRE],
        null=[TRIAL, RENEW],
    )
    assert ids(cohorts.ios_trials(events)) == [
        "failing", "lapsed", "recovered", "refunded", "returned",
    ]
    assert ids(cohorts.ios_converted(events)) == ["recovered"]
    assert ids(cohorts.ios_expired(events)) == ["lapsed", "refunded"]
    assert ids(cohorts.ios_pending(events)) == ["failing"]


def test_play_cohorts(rows):
    def row(order, phase="FREE_TRIAL", state="SUBSCRIPTION_STATE_ACTIVE"):
        return {"latestOrderId": order, "offerPhase": phase, "subscriptionState": state}

    events = rows(
        tables.PLAY_NOTIFICATION,
        row("A"), row("A..0"),
        row("B"), row("B..10"),
        row("C..0"),
        row("D", "BASE"), row("D..0", "BASE"),
        row("E", state="SUBSCRIPTION_STATE_EXPIRED"),
        row("F"), row("F..0", "BASE"),
        row(None),
    )
    assert ids(cohorts.play_trials(events)) == ["A", "B", "F"]
    assert ids(cohorts.play_converted(events)) == ["A"]
    assert ids(cohorts.play_direct(events)) == ["D"]


def test_billing_cohorts(rows):
    def row(user, trial=False, sandbox=False, owner="PURCHASED", conversion=False, refund=None):
        return {
            "rc_original_app_user_id": user, "is_trial_period": trial, "is_sandbox": sandbox,
            "ownership_type": owner, "is_trial_conversion": conversion, "refunded_at": refund,
        }

    events = rows(
        tables.BILLING,
        row("unowned", True, owner=None),
        row("shared", True, owner="FAMILY_SHARED"),
        row("sandbox", True, sandbox=True),
        row("unsure", True, sandbox=None),
        row("clean", True), row("clean", conversion=True),
        row("mixed", True), row("mixed", conversion=True), row("mixed", refund=at(3)),
        row("returned", True), row("returned", conversion=True, refund=at(3)),
        row("paid", conversion=True),
        row(None, True, conversion=True),
    )
    assert ids(cohorts.billing_trials(events)) == ["clean", "mixed", "returned", "unowned"]
    assert ids(cohorts.billing_converted_lenient(events)) == ["clean", "mixed"]
    assert ids(cohorts.billing_converted_strict(events)) == ["clean"]


def test_event_conversion_is_judged_per_moment(rows):
    def row(user, name, day, refund=None):
        return {"q_user_id": user, "event_name": name, "event_ts": at(day), "refund": refund}

    events = rows(
        tables.SUBSCRIPTION_EVENT,
        row("same", "Trial Started", 1), row("same", "Trial Converted", 2), row("same", "Trial Canceled", 2),
        row("later", "Trial Started", 1), row("later", "Trial Converted", 2), row("later", "Trial Canceled", 3),
        row("refund", "Trial Started", 1), row("refund", "Trial Converted", 2), row("refund", "Other", 2, "yes"),
        row("blank", "Trial Started", 1), row("blank", "Trial Converted", 2, ""),
        row("untried", "Trial Converted", 2),
        row(None, "Trial Started", 1), row(None, "Trial Converted", 2),
    )
    assert ids(cohorts.event_converted(events)) == ["blank", "later"]
    assert ids(cohorts.event_trials(events)) == ["blank", "later", "refund", "same"]


def test_attribution(spark):
    early, late = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    frame = spark.createDataFrame(
        [(0, early, late), (1, late, early), (2, early, early), (3, early, None), (4, None, late), (5, None, None)],
        "i int, c timestamp, d timestamp",
    )
    got = frame.withColumns(cohorts.attribute_activation("c", "d")).orderBy("i").collect()
    assert [(r.has_converted_trial, r.has_started_direct_subscription, r.user_activated_at) for r in got] == [
        (True, False, early), (False, True, early), (False, True, early),
        (True, False, early), (False, True, late), (False, False, None),
    ]


def test_membership(rows, spark):
    base = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    chosen = spark.createDataFrame([("a",)], "k string")
    assert [r.n for r in cohorts.restrict_to(base, chosen, "k").collect()] == [1]
    assert sorted(r.n for r in cohorts.exclude(base, chosen, "k").collect()) == [2, 3]
    flagged = {r.n: r.hit for r in cohorts.flag_members(base, chosen, "k", "hit").collect()}
    assert flagged == {1: True, 2: False, 3: False}


def test_latest_pick(spark):
    frame = spark.createDataFrame(
        [("g", None, "n"), ("g", 1, "a"), ("g", 1, "b"), ("h", None, "x"), ("h", None, "y"), ("k", 1, "v"), ("k", 2, None)],
        "k string, t int, v string",
    )
    want = {"g": "b", "h": "y", "k": None}
    grouped = frame.groupBy("k").agg(picks.latest("v", "t").alias("p")).collect()
    assert {r.k: r.p for r in grouped} == want
    ranked = picks.latest_by_window(frame, "k", "v", "t", "p").collect()
    assert {r.k: r.p for r in ranked} == want


def test_safe_cast_maximum(spark):
    frame = spark.createDataFrame([("abc",), ("",), ("1e3",), (None,), ("7",)], "x string")
    assert frame.agg(F.max(F.col("x").try_cast("double"))).first()[0] == 1000.0
