import json

import pytest

from tallyfold import fixed_values as fv
from tallyfold.plans import ingest, models
from tallyfold.rules import EXAMPLE, NoRules
from tallyfold.sources import tables
from tallyfold.sources.accounts import accounts

#: Rules of a deployment that shares no name with the examples.
APPS = [{"bundle_id": "org.acme.kite", "app": "Kite"}]
LABELS = [
    {"channel": "meta", "label": "Kite EU", "app": "Kite", "place": 1},
    {"channel": "tiktok", "label": "Kite Pro", "app": "Kite Pro", "place": 1},
    {"channel": "tiktok", "label": "Kite", "app": "Kite", "place": 2},
    {"channel": "asa", "label": "KIT", "app": "Kite", "place": 1},
    {"channel": "asa", "label": "K", "app": "Other", "place": 2},
]
RATES = [{"channel": "asa", "usd": 2.0}, {"channel": "tiktok", "usd": 3.0}, {"channel": "meta", "currency": "CHF", "usd": 4.0}]
ACCOUNTS = [{"channel": "meta", "ad_account": "Kite EU", "account_id": "99", "is_new": False}]
RULES = {"Apps": APPS, "Labels": LABELS, "Rates": RATES, "Accounts": ACCOUNTS}


@pytest.fixture
def paths(rows, tmp_path):
    """An almost empty warehouse: one row of nulls in every source but those of the rules and two more."""
    found = {}
    for key, (_, ddl) in tables.SOURCES.items():
        found[key] = str(tmp_path / "_".join(key))
        records = [{}]
        if key[0] == "rules":
            records = RULES[key[1]]
        if ddl is tables.PRODUCTS:
            records = [{"country": "FRA", "product_SKU": "p", "customer_price_in_usd": 2.0}]
        if key == ("asc", "Notification"):
            records = [{
                "originalTransactionId": "t", "bundleId": "org.acme.kite", "ProductId": "p", "countryCode": "FR",
            }]
        rows(ddl, *records).write.parquet(found[key])
    return found


@pytest.fixture
def own_accounts(spark):
    """The example accounts as the deployment's table in the catalog."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{tables.RULE_SCHEMA}`")
    accounts(spark).write.mode("overwrite").saveAsTable(f"`{tables.RULE_SCHEMA}`.Accounts")
    yield
    spark.sql(f"DROP SCHEMA `{tables.RULE_SCHEMA}` CASCADE")


def test_every_model_is_written_to_its_schema(spark, paths):
    want = {
        "Transactions_appstoreconnect": ("`AppStoreConnect`.`Transactions`", 17, 1),
        "Transactions_googleplay": ("`GooglePlay`.`Transactions`", 16, 0),
        "Transaction": ("`dev_Core`.`Transaction`", 17, 1),
        "AdSpend": ("`dev_Core`.`AdSpend`", 12, 0),
        **{n: (f"`dev_Experimentation`.`{n}`", 16, 1) for n in fv.BILLING_MODELS},
        fv.EVENT_MODEL: (f"`dev_Experimentation`.`{fv.EVENT_MODEL}`", 19, 1),
    }
    assert set(want) == set(models.MODELS)
    for name in models.MODELS:
        table, columns, count = want[name]
        assert models.run_model(spark, name, "dev", paths) == table
        written = spark.table(table)
        assert (len(written.columns), written.count()) == (columns, count), name
    lazy = models.model(spark, "Transaction", paths)
    assert lazy.collect() == spark.table("`dev_Core`.`Transaction`").collect()
    first = lazy.first()
    assert (first.TransactionId, first.customer_price_in_usd) == ("t", 2.0)
    billing = spark.table(want[list(fv.BILLING_MODELS)[0]][0])
    assert set(fv.BILLING_MODEL_NAMES.values()) <= set(billing.columns)
    for schema in ("AppStoreConnect", "GooglePlay", "dev_Core", "dev_Experimentation"):
        spark.sql(f"DROP SCHEMA `{schema}` CASCADE")


def test_models_read_the_rules_of_the_deployment(spark, rows, paths):
    def ads(channel, *records):
        rows(tables.SPEND, *records).write.mode("overwrite").parquet(paths["ads", fv.SPEND_TABLES[channel]])

    ads("meta", {"ad_account": "Kite EU", "spend": 1.0, "currency": "CHF"}, {"ad_account": "New Kite EU 2", "spend": 1.0}, {"ad_account": "Meadow Web"})
    ads("tiktok", {"ad_account": "my Kite Pro", "spend": 1.0}, {"ad_account": "Kite", "spend": 1.0}, {"ad_account": "[iOS] Stride"})
    ads("asa", {"ad_account": "a", "campaign_name": "kit x", "spend": 1.0}, {"campaign_name": "Kx", "spend": 1.0}, {"campaign_name": "HAR"})
    play = {"latestOrderId": "o..0", "packageName": "org.acme.kite", "productId": "p", "regionCode": "FR"}
    rows(tables.PLAY_NOTIFICATION, play).write.mode("overwrite").parquet(paths["googleplay", "Notification"])

    def spend():
        got = models.model(spark, "AdSpend", paths)
        return sorted((r.channel, r.ad_account, r.spend_in_usd) for r in got.collect())

    want = [
        ("Apple Search Ads", "Kite", 2.0), ("Apple Search Ads", "Other", 2.0), ("Meta", "Kite", 4.0), ("Meta", "Unknown", None),
        ("Tiktok", "Kite", 3.0), ("Tiktok", "Kite Pro", 3.0),
    ]
    assert [(fv.CHANNEL_ASA if c == "Apple Search Ads" else c, a, u) for c, a, u in want] == spend()
    stacked = models.model(spark, "Transaction", paths).collect()
    assert {(r.TransactionId, r.app_name) for r in stacked} == {("t", "Kite"), ("o", "Kite")}
    # Rules that are given win over the tables.
    assert models.model(spark, models.IOS, paths, rules=EXAMPLE).count() == 0


def test_many_labels_are_joined(spark, rows, paths, monkeypatch):
    from tallyfold.plans import ad_spend

    records = [{"ad_account": a, "spend": 1.0} for a in ("x Kite Pro y", "Kite", "none", None, "Kite Pro", "Kite")]
    rows(tables.SPEND, *records).write.mode("overwrite").parquet(paths["ads", "TiktokAds"])

    def apps():
        got = models.model(spark, "AdSpend", paths).filter(f"channel = '{fv.CHANNEL_TIKTOK}'")
        return sorted(r.ad_account for r in got.collect())

    by_expression = apps()
    monkeypatch.setattr(ad_spend, "MAX_BRANCHES", 1)
    assert apps() == by_expression == ["Kite", "Kite", "Kite Pro", "Kite Pro"]


@pytest.mark.parametrize("table", ["Apps", "Labels", "Rates", "Accounts"])
def test_empty_rule_tables_are_refused(spark, rows, paths, tmp_path, table):
    rows(tables.RULE_TABLES[table]).write.mode("overwrite").parquet(paths["rules", table])
    with pytest.raises(NoRules):
        if table == "Accounts":
            from tallyfold.sources.accounts import declared_accounts

            declared_accounts(spark, paths["rules", table])
        else:
            models.model(spark, models.IOS if table == "Apps" else "AdSpend", paths)


def test_a_channel_without_labels_is_refused(spark, rows, paths):
    rows(tables.RULE_TABLES["Labels"], *LABELS[:1]).write.mode("overwrite").parquet(paths["rules", "Labels"])
    with pytest.raises(NoRules, match="no labels of asa"):
        models.model(spark, "AdSpend", paths)
    # Models that need no such rules are not stopped.
    assert models.model(spark, models.IOS, paths).count() == 1


def put(folder, name, page):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(page))


def test_ingest_of_a_window(spark, tmp_path, own_accounts):
    label, account = list(fv.ACCOUNTS["meta"].items())[0]
    days = ["2025-06-30", "2025-07-01", "2025-07-02"]
    page = {"data": [{"date_start": d, "country": "FR", "spend": "1.5"} for d in days]}
    put(tmp_path, f"meta/insights/account_id={account}/p.json", page)
    put(tmp_path, "meta/insights/account_id=other/p.json", page)
    put(tmp_path, "meta/accounts/a.json", {"account_id": account, "currency": "EUR"})
    window = ("2025-07-01", "2025-07-02")
    for replace, expected in ((False, 2), (False, 4), (True, 2)):
        table = ingest.load_channel(
            spark, "meta", str(tmp_path), *window, overwrite_window=replace
        )
        assert spark.table(table).count() == expected
    got = {(str(r.date), r.ad_account, r.currency, r.spend) for r in spark.table(table).collect()}
    assert got == {(d, label, "EUR", 1.5) for d in window}
    assert ingest.channel_rows(spark, "meta", str(tmp_path)).count() == 0
    with pytest.raises(ValueError):
        ingest.channel_rows(spark, "radio", str(tmp_path))
    spark.sql(f"DROP SCHEMA `{fv.SPEND_SCHEMA}` CASCADE")


def test_ingest_refuses_rows_without_a_date(spark, tmp_path, own_accounts):
    account = list(fv.ACCOUNTS["meta"].values())[0]
    page = {"data": [{"date_start": "soon", "country": "FR", "spend": "1"}]}
    put(tmp_path, f"meta/insights/account_id={account}/p.json", page)
    put(tmp_path, "meta/accounts/a.json", {"account_id": account, "currency": "EUR"})
    with pytest.raises(Exception, match="required value is missing"):
        ingest.load_channel(spark, "meta", str(tmp_path), "2025-07-01", "2025-07-02")
    spark.sql(f"DROP SCHEMA `{fv.SPEND_SCHEMA}` CASCADE")


def test_only_the_windows_pages_are_opened(spark, tmp_path, own_accounts):
    account = list(fv.ACCOUNTS["tiktok"].values())[0]
    good = {"code": 0, "data": {"list": [{"dimensions": {"stat_time_day": "2025-07-02", "country_code": "FR", "adgroup_id": "1"}, "metrics": {"spend": "1"}}]}}
    put(tmp_path, f"tiktok/reports/report_date=2025-07-01/advertiser_id={account}/p.json", {"code": 40001, "message": "limit"})
    put(tmp_path, f"tiktok/reports/report_date=2025-07-02/advertiser_id={account}/p.json", good)
    put(tmp_path, f"tiktok/adgroups/advertiser_id={account}/p.json", {"code": 0, "data": {"list": []}})
    rows = ingest.channel_rows(spark, "tiktok", str(tmp_path), "2025-07-02", "2025-07-03")
    assert rows.count() == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "PartitionFilters" in line and "report_date" in line]
    assert filters and "2025-07-02" in filters[0]
    with pytest.raises(Exception, match="limit"):
        ingest.channel_rows(spark, "tiktok", str(tmp_path), "2025-07-01", "2025-07-02").collect()


def test_all_channels_in_one_run(spark, tmp_path, own_accounts):
    meta, tiktok, asa = (list(fv.ACCOUNTS[c].values())[0] for c in ("meta", "tiktok", "asa"))
    put(tmp_path, f"meta/insights/account_id={meta}/p.json", {"data": [{"date_start": "2025-07-01", "country": "FR", "spend": "1"}]})
    put(tmp_path, "meta/accounts/a.json", {"account_id": meta, "currency": "EUR"})
    put(tmp_path, f"tiktok/reports/advertiser_id={tiktok}/p.json", {"code": 0, "data": {"list": []}})
    put(tmp_path, f"tiktok/adgroups/advertiser_id={tiktok}/p.json", {"code": 0, "data": {"list": []}})
    put(tmp_path, f"asa/reports/org_id={asa}/campaign_id=1/p.json", {"data": {}})
    put(tmp_path, f"asa/campaigns/org_id={asa}/p.json", {"data": []})
    put(tmp_path, "asa/details/1.json", {"data": {"id": 1}})
    tables = ingest.load_channels(spark, str(tmp_path), start="2025-07-01", end="2025-07-01")
    assert {c: spark.table(t).count() for c, t in tables.items()} == {"meta": 1, "tiktok": 0, "asa": 0}
    with pytest.raises(ValueError):
        ingest.load_channels(spark, str(tmp_path), ["radio"])
    spark.sql(f"DROP SCHEMA `{fv.SPEND_SCHEMA}` CASCADE")


def landed_meta(folder, account, days, currency="EUR", fetched="2025-07-03", extra=()):
    for day in days:
        page = {"data": [{"date_start": day, "country": "FR", "spend": "1.5"}, *extra]}
        put(folder, f"meta/insights/report_date={day}/account_id={account}/p.json", page)
    put(folder, f"meta/accounts/fetch_date={fetched}/a.json", {"account_id": account, "currency": currency})


def test_loads_use_the_declared_accounts(spark, rows, paths, tmp_path):
    landed_meta(tmp_path, "99", ["2025-07-01"])
    given = tables.read_source(spark, "rules", "Accounts", paths["rules", "Accounts"])
    table = ingest.load_channel(spark, "meta", str(tmp_path), "2025-07-01", "2025-07-01", accounts=given)
    assert [(r.ad_account, r.currency) for r in spark.table(table).collect()] == [("Kite EU", "EUR")]
    spark.sql(f"DROP SCHEMA `{fv.SPEND_SCHEMA}` CASCADE")


def test_details_are_kept_and_only_new_pages_are_read(spark, tmp_path, own_accounts):
    org = list(fv.ACCOUNTS["asa"].values())[0]
    folder = str(tmp_path)

    def campaigns(day, *pairs):
        put(tmp_path, f"asa/campaigns/fetch_date={day}/org_id={org}/p.json", {"data": [{"id": i, "name": n} for i, n in pairs]})
        put(tmp_path, f"asa/details/fetch_date={day}/1.json", {"data": {"id": 1, "countriesOrRegions": ["FR"]}})

    def names():
        return {r.campaign_id: r.campaign_name for r in ingest.refresh_details(spark, "asa", folder)["campaigns"].collect()}

    campaigns("2025-07-01", (1, "one"), (2, "two"))
    assert names() == {"1": "one", "2": "two"}
    campaigns("2025-07-02", (1, "uno"), (3, "three"))
    # A campaign that the newest fetch no longer lists keeps its name.
    assert names() == {"1": "uno", "2": "two", "3": "three"} == names()
    pages = ingest.detail_pages(spark, "asa", "campaigns", folder, "2025-07-02")
    plan = pages._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "PartitionFilters" in line and "fetch_date" in line]
    assert filters and "2025-07-02" in filters[0]
    assert {r.page_file.split("fetch_date=")[1][:10] for r in pages.collect()} == {"2025-07-02"}
    # What was read before is not read again: it may even be gone.
    (tmp_path / f"asa/campaigns/fetch_date=2025-07-01/org_id={org}/p.json").write_text("no json")
    assert names() == {"1": "uno", "2": "two", "3": "three"}
    spark.sql(f"DROP SCHEMA `{fv.SPEND_SCHEMA}` CASCADE")


def test_named_loads_count_and_keep_what_they_refuse(spark, tmp_path, own_accounts):
    account = list(fv.ACCOUNTS["meta"].values())[0]
    looks_good = json.dumps({"date_start": "2025-07-01", "country": "FR", "spend": "9"})
    bad = ["odd", looks_good, 7, {"date_start": "soon", "country": "FR", "spend": "1"}, {"date_start": "2025-07-01", "spend": "1"}]
    landed_meta(tmp_path, account, ["2025-07-01", "2025-07-02"], extra=bad)
    window = ("2025-07-01", "2025-07-02")
    load = ingest.run_load(spark, "meta", str(tmp_path), "daily", *window)
    assert (load.read, load.written, load.rejected, load.state) == (12, 2, 10, "loaded")
    rejects = spark.table("AdSpend.Rejects").collect()
    assert len(rejects) == 10 and {r.account_id for r in rejects} == {account}
    assert {(r.reason, r.entry_text) for r in rejects if r.place in (1, 2)} == {
        ("the entry is no object", '"odd"'), ("the entry is no object", json.dumps(looks_good)),
    }
    assert {r.reason for r in rejects if r.entry_text is None} == {"a required value is missing: date", "a required value is missing: country"}
    again = ingest.run_load(spark, "meta", str(tmp_path), "daily", *window)
    assert (again.written, again.state, spark.table(load.table).count()) == (2, "loaded before", 2)
    # Another name is another load, and appends.
    assert ingest.run_load(spark, "meta", str(tmp_path), "again", *window).written == 2
    assert spark.table(load.table).count() == 4
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    ingest.run_load(spark, "meta", str(tmp_path), "mend", *window, overwrite_window=True)
    assert spark.table(load.table).count() == 2 and spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    spark.sql(f"DROP SCHEMA `{fv.SPEND_SCHEMA}` CASCADE")


def test_rejects_of_all_channels(spark, tmp_path, own_accounts):
    tiktok, asa = (list(fv.ACCOUNTS[c].values())[0] for c in ("tiktok", "asa"))
    row = {"dimensions": {"stat_time_day": "2025-07-01", "country_code": "FR", "adgroup_id": "1"}, "metrics": {"spend": "1"}}
    put(tmp_path, f"tiktok/reports/advertiser_id={tiktok}/p.json", {"code": 0, "data": {"list": [row, "odd", None]}})
    put(tmp_path, f"tiktok/adgroups/advertiser_id={tiktok}/p.json", {"code": 0, "data": {"list": []}})
    day = {"date": "2025-07-01", "localSpend": {"amount": "2", "currency": "USD"}}
    report = {"data": {"reportingDataResponse": {"row": [{"metadata": {"adGroupId": 7}, "granularity": [day, 5]}, "odd", {"granularity": []}]}}}
    put(tmp_path, f"asa/reports/org_id={asa}/campaign_id=1/p.json", report)
    put(tmp_path, f"asa/campaigns/org_id={asa}/p.json", {"data": [{"id": 1, "name": "one"}]})
    put(tmp_path, "asa/details/1.json", {"data": {"id": 1, "countriesOrRegions": ["FR"]}})
    done = ingest.run_loads(spark, str(tmp_path), "daily", ["tiktok", "asa"], "2025-07-01", "2025-07-01")
    assert {c: (o.read, o.written, o.rejected) for c, o in done.items()} == {"tiktok": (3, 1, 2), "asa": (3, 1, 2)}
    got = {(r.load.split("_")[0], r.level, r.place, r.entry_text) for r in spark.table("AdSpend.Rejects").collect()}
    assert got == {("tiktok", "row", 1, '"odd"'), ("tiktok", "row", 2, "null"), ("asa", "row", 1, '"odd"'), ("asa", "day", 1, "5")}
    spark.sql(f"DROP SCHEMA `{fv.SPEND_SCHEMA}` CASCADE")


def test_a_rerun_adds_only_what_is_missing(spark, tmp_path, own_accounts, monkeypatch):
    meta, tiktok = (list(fv.ACCOUNTS[c].values())[0] for c in ("meta", "tiktok"))
    landed_meta(tmp_path, meta, ["2025-07-01"])
    failing = tmp_path / f"tiktok/reports/advertiser_id={tiktok}/p.json"
    put(tmp_path, f"tiktok/reports/advertiser_id={tiktok}/p.json", {"code": 40001, "message": "limit"})
    put(tmp_path, f"tiktok/adgroups/advertiser_id={tiktok}/p.json", {"code": 0, "data": {"list": []}})
    args = (spark, str(tmp_path), "daily", ["tiktok", "meta"], "2025-07-01", "2025-07-01")
    with pytest.raises(ingest.LoadFailed, match="tiktok") as failed:
        ingest.run_loads(*args)
    assert failed.value.outcomes["meta"].written == 1
    row = {"dimensions": {"stat_time_day": "2025-07-01", "country_code": "FR", "adgroup_id": "1"}, "metrics": {"spend": "1"}}
    failing.write_text(json.dumps({"code": 0, "data": {"list": [row]}}))
    done = ingest.run_loads(*args)
    assert {c: (o.state, o.written) for c, o in done.items()} == {"tiktok": ("loaded", 1), "meta": ("loaded before", 1)}
    assert [spark.table(o.table).count() for o in done.values()] == [1, 1]

    # An attempt that was cut off after its write is only marked as done.
    args = (spark, "meta", str(tmp_path), "cut", "2025-07-01", "2025-07-01")
    mark = ingest._mark
    monkeypatch.setattr(ingest, "_mark", lambda *a: mark(*a) if a[4] == "begun" else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.run_load(*args)
    monkeypatch.setattr(ingest, "_mark", mark)
    assert ingest.run_load(*args).written == 1
    assert spark.table("AdSpend.MetaAds").count() == 2
    # One that left something else is not guessed at.
    monkeypatch.setattr(ingest, "load_spend", lambda *a: 1 / 0)
    args = (spark, "meta", str(tmp_path), "odd", "2025-07-01", "2025-07-01")
    with pytest.raises(ZeroDivisionError):
        ingest.run_load(*args)
    monkeypatch.undo()
    spark.sql("INSERT INTO AdSpend.MetaAds SELECT * FROM AdSpend.MetaAds")
    with pytest.raises(ingest.LoadInDoubt):
        ingest.run_load(*args)
    spark.sql(f"DROP SCHEMA `{fv.SPEND_SCHEMA}` CASCADE")
