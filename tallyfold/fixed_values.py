"""Business lists and constants that decide results.

These are data, not logic. They are stated here once, in natural order, and
every expression that needs them reads them from this file.
"""

# --- countries ---------------------------------------------------------------
# ISO 3166-1 alpha-3 to alpha-2, the codes that are shortened by the list. A code
# that is not listed falls back to its first two letters.
ALPHA3 = """
    ABW AW, AFG AF, AGO AO, ALB AL, AND AD, ARE AE, ARG AR, ARM AM, AUS AU, AUT AT,
    AZE AZ, BDI BI, BEL BE, BEN BJ, BFA BF, BGD BD, BGR BG, BHR BH, BHS BS, BIH BA,
    BLR BY, BLZ BZ, BMU BM, BOL BO, BRA BR, BRB BB, BRN BN, BTN BT, BWA BW, CAF CF,
    CAN CA, CHE CH, CHL CL, CHN CN, CIV CI, CMR CM, COD CD, COG CG, COK CK, COL CO,
    COM KM, CPV CV, CRI CR, CUB CU, CYM KY, CYP CY, CZE CZ, DEU DE, DJI DJ, DNK DK,
    DOM DO, DZA DZ, ECU EC, EGY EG, ERI ER, ESP ES, EST EE, ETH ET, FIN FI, FJI FJ,
    FRA FR, FSM FM, GAB GA, GBR GB, GEO GE, GHA GH, GIN GN, GMB GM, GNB GW, GNQ GQ,
    GRC GR, GRD GD, GTM GT, GUY GY, HKG HK, HND HN, HRV HR, HTI HT, HUN HU, IDN ID,
    IND IN, IRL IE, IRN IR, IRQ IQ, ISL IS, ISR IL, ITA IT, JAM JM, JOR JO, JPN JP,
    KAZ KZ, KEN KE, KGZ KG, KHM KH, KIR KI, KNA KN, KOR KR, KWT KW, LAO LA, LBN LB,
    LBR LR, LBY LY, LCA LC, LIE LI, LKA LK, LSO LS, LTU LT, LUX LU, LVA LV, MAC MO,
    MAR MA, MCO MC, MDA MD, MDG MG, MDV MV, MEX MX, MKD MK, MLI ML, MLT MT, MMR MM,
    MNE ME, MNG MN, MOZ MZ, MRT MR, MUS MU, MWI MW, MYS MY, MYT YT, NAM NA, NER NE,
    NGA NG, NIC NI, NLD NL, NOR NO, NPL NP, NRU NR, NZL NZ, OMN OM, PAK PK, PAN PA,
    PER PE, PHL PH, PNG PG, POL PL, PRK KP, PRT PT, PRY PY, PYF PF, QAT QA, ROU RO,
    RUS RU, RWA RW, SAU SA, SDN SD, SEN SN, SGP SG, SLB SB, SLE SL, SLV SV, SMR SM,
    SOM SO, SRB RS, SSD SS, STP ST, SUR SR, SVK SK, SVN SI, SWE SE, SWZ SZ, SYC SC,
    SYR SY, TCA TC, TCD TD, TGO TG, THA TH, TJK TJ, TKM TM, TON TO, TTO TT, TUN TN,
    TUR TR, TUV TV, TWN TW, TZA TZ, UGA UG, UKR UA, URY UY, USA US, UZB UZ, VAT VA,
    VCT VC, VEN VE, VGB VG, VIR VI, VNM VN, VUT VU, WLF WF, WSM WS, YEM YE, ZAF ZA,
    ZMB ZM, ZWE ZW
"""
# The extended list also has these.
ALPHA3_EXTENDED = "CUW CW, GUM GU, JEY JE, MTQ MQ, PRI PR"

EUROPE = (
    "ad al at by be ba bg hr cz dk de ee fi gr fr gb hu is ie it lt lv lu mk "
    "mt md nl no pl pt ro ru rs sk si es se ch tr ua cy"
).split()
# The activation rollup uses a list without these three.
EUROPE_ACTIVATION = [c for c in EUROPE if c not in ("ad", "fr", "gb")]
NORTH_AMERICA = ["us", "ca"]
REGION_EUROPE = "EUROPE"
REGION_NORTH_AMERICA = "US/CA"
REGION_OTHER = "Rest of The world"

# --- apps --------------------------------------------------------------------
# Example values of the business rules; a deployment reads its own (see rules.py).
APP_BY_BUNDLE = {
    "com.example.meadow": "Meadow",
    "com.example.Lantern": "Lantern",
    "com.example.pantry": "Pantry",
    "com.example.stride": "Stride",
}
PLATFORM_IOS = "iOS"
PLATFORM_ANDROID = "Android"

# --- advertising -------------------------------------------------------------
CHANNEL_ASA = "Apple Search Ads"
CHANNEL_META = "Meta"
CHANNEL_TIKTOK = "Tiktok"
UNKNOWN_APP = "Unknown"

ASA_CAMPAIGN_PREFIX = "HAR"
ASA_CAMPAIGN_APP = "Meadow"
# Meta labels: a row is kept when its label contains one of them (SQL LIKE, so
# "_" stands for any character) and named when its label equals one.
META_APP_BY_LABEL = {
    "Meadow Web": "Meadow",
    "Own_Lantern": "Lantern",
    "Lantern (SGD)": "Lantern",
    "Pantry Ads": "Pantry",
    "Stride Training": "Stride",
}
# TikTok labels: kept and named by containment, first match wins.
TIKTOK_APP_BY_LABEL = {
    "[Android/iOS] Pantry": "Pantry",
    "[iOS] Stride": "Stride",
    "[IOS] Lantern": "Lantern",
    "(Android) Lantern": "Lantern",
    "[iOS] Meadow": "Meadow",
}

# Units of US dollar per unit of spend.
ASA_USD_RATE = 1.00
TIKTOK_USD_RATE = 1.16
META_USD_RATE = {"USD": 1.00, "EUR": 1.16, "GBP": 1.33}

# Account label to account id, per report provider.
ACCOUNTS = {
    "tiktok": {
        "[Android/iOS] Pantry": "7000000000000000001",
        "[iOS] Stride": "7000000000000000002",
        "[IOS] Lantern": "7000000000000000003",
        "(Android) Lantern": "7000000000000000004",
        "[iOS] Harbour": "7000000000000000005",
        "Orchard (iOS)": "7000000000000000006",
        "[iOS] Meadow": "7000000000000000007",
    },
    "meta": {
        "Pantry Ads": "300000000000001",
        "Stride Training": "300000000000002",
        "Own_Lantern": "300000000000003",
        "Lantern (SGD)": "300000000000004",
        "Orchard (iOS)": "300000000000005",
        "Orchard (Android)": "300000000000006",
        "Willow Ads": "300000000000007",
        "Cedar Classes": "300000000000008",
        "Meadow Web": "300000000000009",
    },
    "asa": {
        "Own": "8000001",
    },
}
# Accounts being back-filled; empty unless someone is adding one.
NEW_ACCOUNTS = {"tiktok": {}, "meta": {}, "asa": {}}

# Spend table of each provider.
SPEND_SCHEMA = "AdSpend"
SPEND_TABLES = {"tiktok": "TiktokAds", "meta": "MetaAds", "asa": "AsaAds"}

# --- warehouse models --------------------------------------------------------
# Customer models over billing rows: source table and how the product is picked.
BILLING_MODELS = {
    "meadow_customers": ("BillingMeadow", "any"),
    "lantern_customers": ("BillingLantern", "any"),
    "stride_customers": ("BillingStride", "latest"),
}
EVENT_MODEL = "pantry_customers"
EVENT_TABLES = ("EventsPantryAndroid", "EventsPantryIOS")
# Column names of the customer models where they differ from the plans' names.
BILLING_MODEL_NAMES = {"customer_id": "billing_id"}
EVENT_MODEL_NAMES = {"customer_id": "event_user_id"}

# --- target schemas ----------------------------------------------------------
FIXED_SCHEMAS = {"appstoreconnect": "AppStoreConnect", "googleplay": "GooglePlay"}
