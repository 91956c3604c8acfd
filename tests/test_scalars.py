from pyspark.sql import functions as F

from tallyfold import fixed_values as fv
from tallyfold.functions import countries, spend, store
from tallyfold.operators.lookups import single_country


def test_country_upper(values):
    given = [None, "FR", "fra", "usa", " US", "XKX", "MTQ", "SVN", "EST", "AND"]
    got = values(lambda: countries.country_upper("x"), given)
    assert got == ["", "FR", "FR", "US", " U", "XK", "MT", "SI", "EE", "AD"]


def test_country_lower_shortens_three_letters_only(values):
    given = [None, "FRA", " US", "FRAN", "MTQ", "CUW", "gum"]
    assert values(lambda: countries.country_lower("x"), given) == [
        None, "fr", "u", "fran", "mt", "cu", "gu",
    ]
    extended = values(lambda: countries.country_lower("x", extended=True), given)
    assert extended[-3:] == ["mq", "cw", "gu"]


def test_country_map_against_the_iso_list(spark, values):
    """Every ISO code gets its true short form, but for the twenty outside the map."""
    locale = spark._jvm.java.util.Locale
    true = {}
    for two in locale.getISOCountries():
        true[locale.Builder().setRegion(two).build().getISO3Country()] = two
    codes = sorted(true)
    got = dict(zip(codes, values(lambda: countries.alpha2("x"), codes)))
    wrong = {c for c in codes if got[c] != true[c]}
    assert wrong == set(
        "ALA ATA ATF ATG BES CUW ESH FLK FRO GLP GRL GUF MAF MNP MTQ NIU PCN PLW SGS SPM".split()
    )
    assert all(got[c] == c[:2] for c in wrong)


def test_region_lists_differ_in_three_codes(values):
    given = ["fr", "US", "de", None, "jp", "ad", "GB"]
    full = values(lambda: countries.region("x"), given)
    short = values(lambda: countries.region("x", fv.EUROPE_ACTIVATION), given)
    rest = "Rest of The world"
    assert full == ["EUROPE", "US/CA", "EUROPE", rest, rest, "EUROPE", "EUROPE"]
    assert short == [rest, "US/CA", "EUROPE", rest, rest, rest, rest]
    assert len(fv.EUROPE) == 41 and len(fv.EUROPE_ACTIVATION) == 38


def test_base_order_and_first_renewal(values):
    given = ["G", "G..0", "G..10", "G.0", "G..x", None]
    assert values(lambda: store.base_order_id("x"), given) == ["G", "G", "G", "G.0", "G..x", None]
    renewal = values(lambda: store.is_first_renewal("x"), given)
    assert renewal == [False, True, False, False, False, None]


def test_composite_sku(spark):
    frame = spark.createDataFrame([("p", "m"), ("p", ""), ("p", None), (None, "m")], "a string, b string")
    got = [r.s for r in frame.select(store.composite_sku("a", "b").alias("s")).collect()]
    assert got == ["p:m", "p", "p", None]


def test_duration_first_match_wins(values):
    given = ["App.LIFETIME.year", "yearly_premium", "Premium", "3month", "weekly", None]
    assert values(lambda: store.duration_from_sku("x"), given) == [
        "Lifetime", "1 year", "1 month", "1 month", None, None,
    ]


def test_app_name(values):
    known = list(fv.APP_BY_BUNDLE)
    assert values(lambda: store.app_name("x"), [*known, "other", None]) == [
        *fv.APP_BY_BUNDLE.values(), None, None,
    ]


def test_platform_from_campaign(values):
    given = ["BRAND_x", "ios_BRAND", "x", None, "android"]
    assert values(lambda: spend.platform_from_campaign("x"), given) == [
        "Android", "iOS", "iOS", "iOS", "Android",
    ]


def test_meta_filter_is_like_and_mapping_is_equality(values):
    label = next(x for x in fv.META_APP_BY_LABEL if "_" in x)
    longer, wildcard = f"{label} EU", label.replace("_", "X")
    given = [label, longer, wildcard, "nothing"]
    kept = values(lambda: spend.label_matches("x", fv.META_APP_BY_LABEL), given)
    assert kept == [True, True, True, False]
    named = values(lambda: spend.meta_app("x"), given)
    assert named == [fv.META_APP_BY_LABEL[label], "Unknown", "Unknown", "Unknown"]


def test_tiktok_brackets_are_literal_and_case_counts(values):
    for label, app in fv.TIKTOK_APP_BY_LABEL.items():
        got = values(lambda: spend.tiktok_app("x"), [f"a {label} b", label.swapcase()])
        assert got == [app, "Unknown"]


def test_dollars(spark):
    frame = spark.createDataFrame(
        [(10.0, "USD"), (10.0, "EUR"), (10.0, "GBP"), (10.0, "SGD"), (10.0, None)], "s double, c string"
    )
    meta = [r.u for r in frame.select(spend.meta_usd("s", "c").alias("u")).collect()]
    assert meta == [10.0, 11.6, 13.3, None, None]
    assert {r.u for r in frame.select(spend.tiktok_usd("s").alias("u")).collect()} == {11.6}
    assert {r.u for r in frame.select(spend.asa_usd("s").alias("u")).collect()} == {10.0}


def test_amounts_and_dates(values):
    given = [None, "x", "", "1e3", "2.5"]
    assert values(lambda: spend.amount_or_zero(F.col("x")), given) == [0.0, 0.0, 0.0, 1000.0, 2.5]
    blank = values(lambda: spend.amount_blank_is_zero(F.col("x")), [None, "", "2.5"])
    assert blank == [0.0, 0.0, 2.5]
    days = values(lambda: spend.report_date(F.col("x")), ["2025-07-01 00:00:00", "2025-07-01", "bad", None])
    assert [str(d) for d in days] == ["2025-07-01", "2025-07-01", "None", "None"]


def test_not_blank_of_any_type(spark):
    frame = spark.createDataFrame([("", 0), ("y", None)], "s string, n int")
    got = frame.select(store.not_blank("s").alias("s"), store.not_blank("n").alias("n")).collect()
    assert [tuple(r) for r in got] == [(False, True), (True, False)]


def test_single_country(spark):
    frame = spark.createDataFrame([(["FR"],), (["FR", "DE"],), ([],), (None,)], "c array<string>")
    got = [r.c for r in frame.select(single_country("c").alias("c")).collect()]
    assert got == ["FR", "MULTI", "", ""]


def test_all_listed_countries(spark):
    listed = dict(pair.split() for pair in fv.ALPHA3.replace("\n", " ").split(","))
    extra = dict(pair.split() for pair in fv.ALPHA3_EXTENDED.split(","))
    assert (len(listed), len(extra)) == (202, 5)
    frame = spark.createDataFrame([(c.lower(),) for c in [*listed, *extra, "XKX"]], "c string")
    strict = countries.alpha2("c", strict=True)
    got = frame.select(F.upper("c"), countries.alpha2("c"), countries.alpha2("c", extended=True), strict).collect()
    for code, plain, extended, only_listed in got:
        assert only_listed == listed.get(code)
        assert plain == listed.get(code, code[:2].lower())
        assert extended == {**listed, **extra}.get(code, code[:2].lower())
