import csv
import datetime as dt
from glob import glob

import pytest
from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.operators import spend_rows
from tallyfold.sinks import tables as sinks
from tallyfold.sources import tables

DAY, NEXT = dt.date(2025, 7, 1), dt.date(2025, 7, 2)


def spend(day=DAY, amount=1.0, account="acc", country="FR", **more):
    return {"date": day, "ad_account": account, "country": country, "spend": amount, **more}


def total(spark, table):
    return {r["date"]: r["count"] for r in spark.table(table).groupBy("date").count().collect()}


@pytest.fixture
def table(spark):
    name = "spend_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_schema_routing():
    routed = [sinks.resolve_schema("T", c) for c in (None, " ", "GOOGLEPLAY", "appStoreConnect", "Core", " Core ")]
    assert routed == ["T", "T", "GooglePlay", "AppStoreConnect", "T_Core", "T_Core"]


def test_model_is_replaced_whole(spark):
    for n in (3, 2):
        name = sinks.write_model(spark.range(n), "unit", "Numbers", "Core")
        assert name == "`unit_Core`.`Numbers`"
        assert spark.table(name).count() == n
    spark.sql("DROP SCHEMA unit_Core CASCADE")


def test_a_failed_refresh_leaves_the_old_rows(spark):
    def failing():
        return spark.range(5).select(F.raise_error(F.lit("no more")).alias("id"))

    with pytest.raises(Exception, match="no more"):
        sinks.write_model(failing(), "unit", "Safe")
    assert not spark.catalog.tableExists("unit.Safe")
    name = sinks.write_model(spark.range(5), "unit", "Safe")
    with pytest.raises(Exception, match="no more"):
        sinks.write_model(failing(), "unit", "Safe")
    assert spark.table(name).count() == 5
    assert len(sinks._versions(spark, "unit", "Safe")) == 1
    # A reader that has begun reads on while the next refresh goes through, of another schema as well.
    begun = spark.table(name)
    sinks.write_model(begun.selectExpr("id * 2 AS twice", "'x' AS more"), "unit", "Safe")
    assert begun.count() == 5 and spark.table(name).columns == ["twice", "more"]
    for n in (1, 2, 3):
        sinks.write_model(spark.range(n), "unit", "Safe")
    assert spark.table(name).count() == 3 and len(sinks._versions(spark, "unit", "Safe")) == 2
    spark.sql("DROP SCHEMA unit CASCADE")


def test_the_name_is_never_missing(spark, monkeypatch):
    name = sinks.write_model(spark.range(2), "unit", "Seen")
    run, missing = type(spark).sql, []

    def watched(session, text, *args, **more):
        out = run(session, text, *args, **more)
        missing.append(not spark.catalog.tableExists("unit.Seen"))
        return out

    monkeypatch.setattr(type(spark), "sql", watched)
    sinks.write_model(spark.range(3), "unit", "Seen")
    monkeypatch.undo()
    assert len(missing) > 2 and not any(missing) and spark.table(name).count() == 3
    spark.sql("DROP SCHEMA unit CASCADE")


def test_a_plain_table_becomes_the_first_version(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS unit")
    spark.range(4).write.saveAsTable("unit.Old")
    name = sinks.write_model(spark.table("unit.Old").selectExpr("id + 1 AS id"), "unit", "Old")
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 3, 4]
    assert spark.table("unit.Old__v0").count() == 4
    spark.sql("DROP SCHEMA unit CASCADE")


def test_append_doubles_and_window_replaces(spark, rows, table):
    first = rows(tables.SPEND, spend(), spend(amount=2.0), spend(NEXT))
    sinks.append_spend(first, table)
    sinks.append_spend(first, table)
    assert total(spark, table) == {DAY: 4, NEXT: 2}
    sinks.append_spend(rows(tables.SPEND, spend(amount=7.0)), table, overwrite_window=True)
    assert total(spark, table) == {DAY: 1, NEXT: 2}


def test_append_refuses_incomplete_rows(spark, rows, table):
    with pytest.raises(Exception, match="required value is missing"):
        sinks.append_spend(rows(tables.SPEND, spend(), spend(country=None)), table)
    assert total(spark, table) == {}


def test_missing_columns_are_added(spark, rows, table):
    old = "ad_account string, country string, spend double, extra string, date date"
    before = rows(old, {**spend(), "extra": "kept"})
    before.write.partitionBy("date").saveAsTable(table)
    sinks.append_spend(rows(tables.SPEND, spend(NEXT, currency="USD")), table)
    got = {r.date: (r.extra, r.currency) for r in spark.table(table).collect()}
    assert got == {DAY: ("kept", None), NEXT: (None, "USD")}
    assert len(spark.table(table).columns) == 10


def test_conform_and_csv(spark, rows, tmp_path):
    given = rows(
        tables.SPEND,
        spend(account="b", amount=1.23456789, currency="", campaign_name="n"),
        spend(account="a", amount=2.0),
    )
    clean = spend_rows.conform(given)
    row = clean.filter("ad_account = 'b'").first()
    assert (row.spend, row.currency, row.campaign_name) == (1.234568, None, "n")
    sinks.write_spend_csv(clean, str(tmp_path / "out"))
    lines = []
    for part in sorted(glob(str(tmp_path / "out" / "part-*.csv"))):
        header, *found = csv.reader(open(part))
        assert header == spend_rows.CSV_COLUMNS
        lines += found
    assert [line[:4] for line in lines] == [
        ["2025-07-01", "a", "FR", "2.000000"], ["2025-07-01", "b", "FR", "1.234568"],
    ]


def test_sources_are_checked(spark, rows, tmp_path):
    path = str(tmp_path / "events")
    fields = ["Q user id string", "Event Receive Date timestamp", "event name string", "Install Date timestamp"]
    fields += [f"{n} string" for n in ("App Name", "Platform", "Country", "Currency", "Product ID")]
    fields += [f"{n} string" for n in ("Price", "Proceeds", "Price Usd", "Proceeds Usd", "Refund")]
    ddl = ", ".join(f"`{' '.join(f.split()[:-1])}` {f.split()[-1]}" for f in fields)
    rows(ddl, {"Q user id": "u"}).write.parquet(path)
    events = next(k for k, v in tables.SOURCES.items() if v[1] is tables.SUBSCRIPTION_EVENT)
    read = tables.read_source(spark, *events, path)
    assert read.first().q_user_id == "u" and "event_ts" in read.columns
    with pytest.raises(tables.SchemaMismatch, match="originalTransactionId is missing"):
        tables.read_source(spark, "asc", "Notification", path)
    with pytest.raises(KeyError):
        tables.read_source(spark, "asc", "Nothing")
    upper = rows("Date date, AD_ACCOUNT string, Country string, Spend string", {})
    with pytest.raises(tables.SchemaMismatch, match="spend is string"):
        tables.conform_to(upper, "date date, ad_account string, spend double")


def test_source_from_the_catalog(spark, rows):
    (schema, ddl) = tables.SOURCES["ads", "MetaAds"]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    rows("Date date, Ad_Account string, Country string, Spend double, Campaign_id string, Campaign_name string, "
         "Adgroup_id string, Adgroup_name string, Currency string", {"Spend": 1.0}).write.saveAsTable(f"`{schema}`.MetaAds")
    assert tables.read_source(spark, "ads", "MetaAds").columns[0] == "date"
    spark.sql(f"DROP SCHEMA `{schema}` CASCADE")


def test_append_to_a_table_in_other_letter_case(spark, rows, table):
    names = "Date date, Ad_Account string, Country string, Spend double, Campaign_id string, Campaign_name string, Adgroup_id string, Adgroup_name string, Currency string"
    spark.createDataFrame([], names).write.format("parquet").partitionBy("Date").saveAsTable(table)
    day = {"date": dt.date(2025, 7, 1), "ad_account": "a", "country": "FR", "spend": 1.5, "currency": "EUR"}
    sinks.append_spend(rows(tables.SPEND, day), table)
    got = spark.table(table).collect()
    assert [(r.Ad_Account, r.Spend, r.Currency, str(r.Date)) for r in got] == [("a", 1.5, "EUR", "2025-07-01")]


def test_reads_in_any_letter_case_and_type(spark, tmp_path):
    spaced = ["Q User ID", "event receive date", "EVENT NAME", "install date", "App Name", "Platform", "Country", "Currency", "Product  ID", "Price", "Proceeds", "Price Usd", "Proceeds Usd", "Refund"]
    time = dt.datetime(2025, 7, 1)
    row = (1, time, "Trial Started", time, "a", "iOS", "FR", "EUR", "p", 1.5, 1, "1", "1", 2.5)
    path = str(tmp_path / "events")
    spark.createDataFrame([row], spaced).write.parquet(path)
    key = ("raw", fv.EVENT_TABLES[0])
    got = tables.read_source(spark, *key, path).first()
    assert (got.q_user_id, got.price, got.refund, got.product_id) == ("1", "1.5", "2.5", "p")
