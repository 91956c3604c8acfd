import json

import pytest

from conftest import plan_of
from tallyfold import fixed_values as fv
from tallyfold.operators import lookups, spend_rows
from tallyfold.plans import ad_reports
from tallyfold.sources import payloads
from tallyfold.sources.accounts import accounts, select_accounts


def put(folder, *pages):
    """Write (relative path, page) pairs."""
    for name, page in pages:
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(page if isinstance(page, str) else json.dumps(page, indent=1))
    return str(folder)


ORG = list(fv.ACCOUNTS["asa"].values())[0]


def test_asa_reports_from_landed_files(spark, tmp_path):
    def report(*entries, group=7):
        return {"data": {"reportingDataResponse": {"row": [
            {"metadata": {"adGroupId": group, "adGroupName": None}, "granularity": list(entries)},
        ]}}}

    def day(date, amount):
        return {"date": date, "localSpend": {"amount": amount, "currency": "USD"}}

    reports = put(
        tmp_path / "reports",
        (f"org_id={ORG}/campaign_id=1/p.json", report(day("2025-07-01T00:00", "1.5"), day("2025-07-02", None))),
        (f"org_id={ORG}/campaign_id=2/p.json", report(day("2025-07-01", "x"), day("bad", "1"))),
        (f"org_id={ORG}/campaign_id=3/p.json", report({"date": "2025-07-01", "localSpend": None})),
        (f"org_id={ORG}/campaign_id=4/p.json", report(day("2025-07-01", "9"))),
        (f"org_id={ORG}/campaign_id=5/p.json", {"data": {"reportingDataResponse": {"row": None}}}),
        (f"org_id={ORG}/campaign_id=6/p.json", "not json"),
    )
    campaigns = put(
        tmp_path / "campaigns",
        (f"org_id={ORG}/p.json", {"data": [
            {"id": 1, "name": "one"}, {"id": "2", "name": "two"}, {"id": 3, "name": "three"},
            {"id": "x", "name": "bad"}, {"id": 4, "name": None}, {"id": 5, "name": "five"},
        ]}),
    )
    details = put(
        tmp_path / "details",
        ("1.json", {"data": {"id": 1, "countriesOrRegions": ["FR"]}}),
        ("2.json", {"data": {"id": 2, "countriesOrRegions": ["FR", "DE"]}}),
        ("3.json", {"data": {"id": 3, "countriesOrRegions": []}}),
    )
    flat = ad_reports.flatten_asa(
        payloads.read_pages(spark, reports, payloads.ASA_REPORT, "org_id", "campaign_id"),
        payloads.read_pages(spark, campaigns, payloads.ASA_CAMPAIGNS, "org_id"),
        payloads.read_pages(spark, details, payloads.ASA_CAMPAIGN_DETAIL),
    )
    got = {
        (r.campaign_id, str(r.date), r.spend, r.country, r.campaign_name, r.currency, r.adgroup_id, r.adgroup_name)
        for r in flat.collect()
    }
    assert got == {
        ("1", "2025-07-01", 1.5, "FR", "one", "USD", "7", ""),
        ("1", "2025-07-02", 0.0, "FR", "one", "USD", "7", ""),
        ("2", "2025-07-01", 0.0, "MULTI", "two", "USD", "7", ""),
        ("2", "None", 1.0, "MULTI", "two", "USD", "7", ""),
        ("3", "2025-07-01", 0.0, "", "three", "", "7", ""),
    }
    labels = select_accounts(accounts(spark), "asa")
    cleaned = ad_reports.to_spend_rows(flat, labels)
    assert cleaned.columns == spend_rows.SPEND_COLUMNS
    valid, rejected = spend_rows.split_required(cleaned)
    assert (valid.count(), rejected.count()) == (4, 1)
    assert cleaned.filter("currency IS NULL").count() == 1


def tiktok_page(rows, code=0, page=1, message="OK"):
    return {"code": code, "message": message, "data": {"list": rows, "page_info": {"page": page, "total_page": 2}}}


def test_tiktok_reports_from_landed_files(spark, tmp_path):
    def row(spend, group, **dims):
        return {"dimensions": {"country_code": "FR", "adgroup_id": group, **dims}, "metrics": {"spend": spend, "currency": "USD"}}

    def detail(group, name):
        return {"adgroup_id": group, "adgroup_name": name, "campaign_id": "c", "campaign_name": None}

    reports = put(
        tmp_path / "reports",
        ("advertiser_id=1/p1.json", tiktok_page([
            row("2.5", "10", stat_time_day="2025-07-01 00:00:00"),
            row("", "11", **{"stat_time_day.0": "2025-07-02 00:00:00"}),
        ])),
        ("advertiser_id=1/p2.json", tiktok_page([row(None, "12", stat_time_day="", **{"stat_time_day.0": "2025-07-03"})], page=2)),
        ("advertiser_id=2/p1.json", tiktok_page([row("1", "10", stat_time_day="2025-07-01")])),
    )
    adgroups = put(
        tmp_path / "adgroups",
        ("advertiser_id=1/p1.json", tiktok_page([detail("10", "z old"), detail("11", "first"), detail("11", "again")])),
        ("advertiser_id=1/p2.json", tiktok_page([detail("10", "new")], page=2)),
        ("advertiser_id=1/p3.json", tiktok_page([detail("12", "failed")], code=5)),
    )
    flat = ad_reports.flatten_tiktok(
        payloads.read_pages(spark, reports, payloads.TIKTOK_PAGE, "advertiser_id"),
        payloads.read_pages(spark, adgroups, payloads.TIKTOK_PAGE, "advertiser_id"),
    )
    got = {(r.account_id, r.adgroup_id): (str(r.date), r.spend, r.adgroup_name, r.campaign_id, r.campaign_name) for r in flat.collect()}
    assert got == {
        ("1", "10"): ("2025-07-01", 2.5, "new", "c", ""),
        ("1", "11"): ("2025-07-02", 0.0, "again", "c", ""),
        ("1", "12"): ("2025-07-03", 0.0, "", "", ""),
        ("2", "10"): ("2025-07-01", 1.0, "", "", ""),
    }


def test_report_error_status_fails_the_job(spark, tmp_path):
    reports = put(
        tmp_path,
        ("advertiser_id=1/a.json", tiktok_page([])),
        ("advertiser_id=1/b.json", tiktok_page([], code=40001, message="too many")),
        ("advertiser_id=1/c.json", {"message": "no code"}),
    )
    pages = payloads.read_pages(spark, reports, payloads.TIKTOK_PAGE, "advertiser_id")
    good, failed = payloads.split_errors(pages)
    assert (good.count(), failed.count()) == (1, 2)
    assert sorted(r.page_file.rsplit("/", 1)[1] for r in failed.collect()) == ["b.json", "c.json"]
    adgroups = payloads.read_pages(spark, reports, payloads.TIKTOK_PAGE, "advertiser_id")
    with pytest.raises(Exception, match="report error"):
        ad_reports.flatten_tiktok(pages, adgroups).collect()


def test_meta_reports_from_landed_files(spark, tmp_path):
    def row(spend, **more):
        return {"date_start": "2025-07-01", "country": "FR", "spend": spend, **more}

    insights = put(
        tmp_path / "insights",
        ("account_id=1/p1.json", {"data": [row("1.5", adset_id="7", campaign_id="c"), row("2")]}),
        ("account_id=2/p1.json", {"data": [row("3")]}),
        ("account_id=2/p2.json", {"data": []}),
    )
    owners = put(tmp_path / "accounts", ("1.json", {"id": "act_1", "account_id": "1", "currency": "EUR"}))
    read = payloads.read_pages(spark, insights, payloads.META_INSIGHTS, "account_id")
    flat = ad_reports.flatten_meta(read, payloads.read_pages(spark, owners, payloads.META_ACCOUNT))
    got = {(r.account_id, r.spend): (r.currency, r.adgroup_id, r.campaign_id) for r in flat.collect()}
    assert got == {("1", 1.5): ("EUR", "7", "c"), ("1", 2.0): ("EUR", None, None), ("2", 3.0): ("", None, None)}


def test_text_pages_parse_like_files(spark):
    texts = spark.createDataFrame([("1", json.dumps(tiktok_page([]))), ("2", "no json"), ("3", None)], "a string, b string")
    got = payloads.parse_pages(texts, "b", payloads.TIKTOK_PAGE, "a")
    assert {r.a: r.code for r in got.collect()} == {"1": 0, "2": None, "3": None}


def test_account_sets(spark):
    dimension = accounts(spark)
    total = sum(len(v) for v in fv.ACCOUNTS.values())
    assert select_accounts(dimension).count() == total
    assert select_accounts(dimension, "meta").count() == len(fv.ACCOUNTS["meta"])
    assert select_accounts(dimension, new=True).count() == 0
    with pytest.raises(ValueError, match="choose from"):
        select_accounts(dimension, "radio")


def test_bad_entries_cost_themselves_only(spark, tmp_path):
    day = {"date": "2025-07-01", "localSpend": {"amount": "2", "currency": "USD"}}
    row = {"metadata": {"adGroupId": 7, "adGroupName": "g"}, "granularity": ["odd", day, 5, None, {"date": "2025-07-02", "localSpend": "odd"}]}
    report = {"data": {"reportingDataResponse": {"row": [5, row, "odd", None, [row]]}}}
    reports = payloads.read_pages(
        spark, put(tmp_path / "r", (f"org_id={ORG}/campaign_id=1/p.json", report)), payloads.ASA_REPORT, "org_id", "campaign_id"
    )
    campaigns = payloads.read_pages(
        spark, put(tmp_path / "c", (f"org_id={ORG}/p.json", {"data": ["odd", {"id": 1, "name": "one"}, 3]})), payloads.ASA_CAMPAIGNS, "org_id"
    )
    details = payloads.read_pages(spark, put(tmp_path / "d", ("1.json", {"data": {"id": 1}})), payloads.ASA_CAMPAIGN_DETAIL)
    flat = ad_reports.flatten_asa(reports, campaigns, details).collect()
    assert {(str(r.date), r.spend, r.campaign_name) for r in flat} == {("2025-07-01", 2.0, "one"), ("2025-07-02", 0.0, "one")}
    bad = ad_reports.rejected_entries("asa", reports).collect()
    assert sorted((r.level, r.place) for r in bad) == [("day", 0), ("day", 2), ("day", 3), ("row", 0), ("row", 2), ("row", 3), ("row", 4)]

    good = {"dimensions": {"stat_time_day": "2025-07-01", "adgroup_id": "9"}, "metrics": {"spend": "1"}}
    listed = payloads.read_pages(
        spark, put(tmp_path / "t", ("advertiser_id=1/p.json", {"code": 0, "data": {"list": ["odd", good]}})), payloads.TIKTOK_PAGE, "advertiser_id"
    )
    groups = payloads.read_pages(
        spark, put(tmp_path / "g", ("advertiser_id=1/p.json", {"code": 0, "data": {"list": [1, {"adgroup_id": "9", "adgroup_name": "n"}]}})), payloads.TIKTOK_PAGE, "advertiser_id"
    )
    assert [(r.spend, r.adgroup_name) for r in ad_reports.flatten_tiktok(listed, groups).collect()] == [(1.0, "n")]
    assert ad_reports.rejected_entries("tiktok", listed).count() == 1

    insight = {"date_start": "2025-07-01", "country": "FR", "spend": "3"}
    insights = payloads.read_pages(spark, put(tmp_path / "m", ("account_id=1/p.json", {"data": ["odd", insight]})), payloads.META_INSIGHTS, "account_id")
    accounts_read = payloads.read_pages(spark, put(tmp_path / "a", ("a.json", {"account_id": "1", "currency": "EUR"})), payloads.META_ACCOUNT)
    assert [(r.spend, r.currency) for r in ad_reports.flatten_meta(insights, accounts_read).collect()] == [(3.0, "EUR")]
    assert ad_reports.rejected_entries("meta", insights).count() == 1


def test_the_newest_fetch_wins(spark, tmp_path):
    def campaign(name):
        return {"data": [{"id": 9, "name": "last"}, {"id": 7, "name": name}]}

    pages = put(
        tmp_path / "c",
        (f"fetch_date=2025-07-01/org_id={ORG}/b.json", campaign("Z old")),
        (f"fetch_date=2025-07-02/org_id={ORG}/a.json", campaign("B newer")),
        (f"fetch_date=2025-07-02/org_id={ORG}/b.json", {"data": [{"id": 7, "name": "A newest"}]}),
    )
    names = ad_reports.asa_campaign_names(payloads.read_pages(spark, pages, payloads.ASA_CAMPAIGNS, "org_id"))
    assert {r.campaign_id: r.campaign_name for r in names.collect()} == {"7": "A newest", "9": "last"}
    pages = put(
        tmp_path / "d",
        ("fetch_date=2025-07-01/7.json", {"data": {"id": 7, "countriesOrRegions": ["US"]}}),
        ("fetch_date=2025-07-02/7.json", {"data": {"id": 7, "countriesOrRegions": ["CA"]}}),
    )
    countries = ad_reports.asa_campaign_countries(payloads.read_pages(spark, pages, payloads.ASA_CAMPAIGN_DETAIL))
    assert [(r.campaign_id, r.country) for r in countries.collect()] == [("7", "CA")]
    insights = put(tmp_path / "m", ("account_id=1/p.json", {"data": [{"date_start": "2025-07-01", "spend": "3"}]}))
    pages = put(
        tmp_path / "a",
        ("fetch_date=2025-07-01/1.json", {"account_id": "1", "currency": "USD"}),
        ("fetch_date=2025-07-02/1.json", {"account_id": "1", "currency": "EUR"}),
    )
    flat = ad_reports.flatten_meta(
        payloads.read_pages(spark, insights, payloads.META_INSIGHTS, "account_id"), payloads.read_pages(spark, pages, payloads.META_ACCOUNT)
    )
    assert [r.currency for r in flat.collect()] == ["EUR"]


def test_rows_stay_where_they_are_read_when_accounts_are_labelled(spark, rows):
    flat = rows("account_id string, spend double", *[{"account_id": str(k % 3), "spend": 1.0 * k} for k in range(30)], {"spend": 1.0})
    named = rows("account_id string, ad_account string", {"account_id": "1", "ad_account": "a"}, {"account_id": "2", "ad_account": "b"})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in ("-1", before):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            found = lookups.label_accounts(flat, named)
            plan = plan_of(found)
            assert "BuildRight" in plan and "hashpartitioning" not in plan
            assert sorted({(r.account_id, r.ad_account) for r in found.collect()}) == [("1", "a"), ("2", "b")]
            assert found.count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
