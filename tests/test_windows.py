import datetime as dt

import pytest

from tallyfold.operators import windows


def days(spark, window):
    first, last = window
    row = spark.range(1).select(first.alias("a"), last.alias("b")).first()
    return row.a, row.b


@pytest.mark.parametrize(
    "month, first, last",
    [
        ("2024-12", (2024, 12, 1), (2024, 12, 31)),
        ("2024-02", (2024, 2, 1), (2024, 2, 29)),
        ("2025-2", (2025, 2, 1), (2025, 2, 28)),
    ],
)
def test_month(spark, month, first, last):
    assert days(spark, windows.month_window(month)) == (dt.date(*first), dt.date(*last))


@pytest.mark.parametrize("month", ["2024-13", "", "x", None])
def test_bad_month_is_the_current_one(spark, month):
    today = dt.datetime.now(dt.timezone.utc).date()
    first, last = days(spark, windows.month_window(month))
    assert first == today.replace(day=1) and first <= today <= last


def test_explicit_days(spark):
    got = days(spark, windows.report_window("2025-01-02", "2025-01-05"))
    assert got == (dt.date(2025, 1, 2), dt.date(2025, 1, 5))


@pytest.mark.parametrize("start, end", [(None, None), ("2025-01-02", None), ("2025-01-02", "soon")])
def test_default_is_yesterday_in_utc(spark, start, end):
    yesterday = dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    for zone in ("UTC", "Pacific/Kiritimati"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert days(spark, windows.report_window(start, end)) == (yesterday, yesterday)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_window_keeps_both_ends(spark):
    frame = spark.sql("SELECT explode(sequence(date'2025-01-01', date'2025-01-09')) AS d")
    kept = windows.in_window(frame, "d", windows.report_window("2025-01-02", "2025-01-05"))
    assert kept.count() == 4
