import pytest
from pyspark.sql import functions as F

from rolemill.functions import classify, keys, names, places, text
from rolemill.functions.similarity import common_subsequence, token_set_ratio, token_sort_ratio


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).head()["x"]


@pytest.mark.parametrize(("title", "want"), [("Backend Engineer (m/w/d) (Softwareentwickler/in)", "backend engineer (m/w/d)"), ("Backend Engineer (m/w/d)", "backend engineer (m/w/d)"), ("  A\t B ", "a b"), ("", "")])
def test_title_core(spark, title, want):
    assert one(spark, text.title_core("t"), t=title) == want


def test_keys(spark):
    assert one(spark, text.company_norm("c"), c="OpenStuff, Inc.") == "openstuffinc"
    assert one(spark, text.title_slug("t"), t="Manager, Sales (EU)") == "manager sales eu"
    assert one(spark, text.name_key("n"), n="Acme Holdings, Inc.") == "acme"
    assert one(spark, text.without_suffix("n"), n="Group") == "group"
    assert one(spark, text.domain_of("u"), u="https://www.Acme.com/jobs") == "acme.com"
    assert one(spark, keys.slugify("u"), u=" Héllo World! ") == "hello-world"


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTP://Example.com:80/a/?utm_source=x&b=2&a=1", "http://example.com/a?a=1&b=2"),
        ("https://t.example/?site=CX_9#4400", "https://t.example/?site=CX_9#4400"),  # the id is in the fragment
        ("https://t.example/x#Apply-Now", "https://t.example/x"),
        ("https://t.example:8443/Case/Kept/?Trk=1&blank=#Part", "https://t.example:8443/Case/Kept#Part"),
        ("https://t.example/a?q=a%20b&q=%C3%A9", "https://t.example/a?q=a+b&q=%C3%A9"),
        ("https://t.example", "https://t.example"),
        ("https://t.example/", "https://t.example/"),
        ("no address at all", "noaddressatall"),
        ("http://[bad", "http://[bad"),
        ("  ", ""),
        (None, ""),
    ],
)
def test_canonical_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(keys.canonical_url("u").alias("x")).head()["x"] == want


def test_fallback_key(spark):
    rows = [("Café  Ünal", "Köch", "Graz"), ("cafe unal", " KOCH ", "graz"), ("cafe unal", "koch", None), (None, "koch", "graz"), ("cafe", " ", "graz")]
    found = [r["k"] for r in spark.createDataFrame(rows, "company string, title string, location string").select(keys.fallback_key().alias("k")).collect()]
    assert found[0] == found[1] != found[2] and found[2] and found[3:] == [None, None]


@pytest.mark.parametrize(("name", "want"), [("Acme Careers", "Acme"), ("Acme (US) Jobs  Page", "Acme"), ("Careers", "Careers"), ("  A   B  ", "A B"), ("Jobsite Ltd", "Jobsite Ltd"), ("", "")])
def test_display_name(spark, name, want):
    assert one(spark, names.display_name("n"), n=name) == want


def test_tenant_keys(spark):
    assert one(spark, names.run_together(F.col("k")), k="northwindholdingsinc") == ["northwindholdings", "northwind"]
    assert one(spark, names.run_together(F.col("k")), k="hexco") == []
    assert one(spark, names.path_name("s"), s="ngc/blue_harbor_external_site?x=1") == "blue harbor"
    assert one(spark, names.first_segment("s"), s="tenant/site?x") == "tenant"
    row = spark.createDataFrame([("Blue Harbor, Inc.", None, "ngc/blue_harbor_careers")], "name string, jobs_company string, slug string")
    assert row.select(names.candidate_keys().alias("k")).head()["k"] == ["blueharborinc", "blueharbor"]


@pytest.mark.parametrize(("url", "fine"), [("https://careers.acme.example/x", True), ("http://10.0.0.8/x", False), ("http://169.254.169.254/", False), ("http://localhost/x", False), ("https://u:p@acme.example/", False), ("https://intra/", False), ("ftp://acme.example", False), ("http://2130706433/", False), ("http://172.16.0.1/", False), ("http://db.internal/", False)])
def test_public_url(spark, url, fine):
    assert (one(spark, names.public_url("u"), u=url) == url) == fine


def test_slugs_places_flags(spark):
    assert [one(spark, names.host_label("s"), s=s) for s in ("acme-co", " acme ", "a.b", "a/b", "-a")] == ["acme-co", "acme", None, None, None]
    assert [one(spark, names.place_title("p"), p=p) for p in ("NEW YORK", "new york", "Den Haag", "McLean")] == ["New York", "New York", "Den Haag", "McLean"]
    assert [one(spark, names.said_bool("b"), b=b) for b in ("Yes", "0", "maybe", " T ")] == [True, False, None, True]


@pytest.mark.parametrize(("title", "said", "want"), [("シニアエンジニア", "", "ja"), ("채용 공고 안내 페이지", "", "ko"), ("Инженер по данным для работы", "", None), ("Wir suchen", "der das die und ist für uns", "de"), ("short", "", None), (None, None, None), ("Role", "the and of it is for you", "en")])
def test_language(spark, title, said, want):
    assert spark.createDataFrame([(title, said)], "title string, description string").select(names.language().alias("x")).head()["x"] == want


@pytest.mark.parametrize(
    ("place", "want"),
    [("Toronto, ON, Canada", "CA"), ("San Francisco, CA", "US"), ("Toronto, ON, CA", "CA"), ("Berlin, DE", "DE"), ("Dover, DE", "US"), ("FR (FRK21)", "FR"), ("Lausanne", ""), ("Tbilisi, Georgia", ""), ("New York, New York", "US"), ("London, UK", "GB"), ("", "")],
)
def test_country(spark, place, want):
    assert one(spark, places.country_of(F.col("p")), p=place) == want


def test_stored_country_wins_unless_ambiguous(spark):
    c = places.reconciled_country(F.col("p"), F.col("s"))
    assert [one(spark, c, p="San Francisco, CA", s=s) for s in ("CA", "", "MX")] == ["US", "US", "MX"]


@pytest.mark.parametrize(("title", "want"), [("Chief of Staff", None), ("Vice President, Sales", "EXECUTIVE"), ("Account Manager", None), ("Store Manager", "MANAGER"), ("Sr. Developer", "SENIOR"), ("Graduate Program", None), ("Staff Software Engineer", "STAFF"), ("Lead generation", None)])
def test_seniority(spark, title, want):
    assert one(spark, classify.seniority("t"), t=title) == want


def test_employment_longest_word(spark):
    assert one(spark, classify.employment_type("c"), c="International") == "INTERN"
    assert one(spark, classify.employment_type("c"), c="unbefristet") == "FULL_TIME"


def test_experience(spark):
    c = classify.experience_years(F.col("d"))
    assert one(spark, c, d="You have 5+ years of relevant experience.") == 5
    assert one(spark, c, d="Founded 20 years ago.") is None


def test_ratios():
    assert common_subsequence("abcde", "ace") == 3
    assert token_sort_ratio("Data Engineer", "engineer, data") == 100.0
    assert token_set_ratio("senior data engineer", "data engineer") == 100.0
    assert token_sort_ratio("", "") == 100.0
    assert token_set_ratio("", "a") == 0.0
