import itertools

from pyspark.sql import functions as F

from rolemill.operators import dedup, quarantine, search, sinks, state

SCHEMA = "seq long, ats_type string, url string, title string, company string, location string, country_iso string, ats_id string, salary_min double, salary_max double, salary_currency string, salary_period string, salary_summary string"


def rows(spark, *found):
    base = {"ats_type": "lever", "title": "Engineer", "company": "Acme", "location": "", "country_iso": "", "ats_id": "", "salary_min": None, "salary_max": None, "salary_currency": None, "salary_period": None, "salary_summary": None}
    made = [base | {"seq": i, "url": f"u{i}"} | x for i, x in enumerate(found)]
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in made], SCHEMA)


def kept(spark, *found):
    return sorted(r.seq for r in dedup.deduplicated(dedup.keys(rows(spark, *found))).survivors.collect())


def test_url_is_global(spark):
    assert kept(spark, {"url": "x", "title": "A"}, {"url": "x", "title": "B"}, {"url": "", "title": "C"}, {"url": "", "title": "D"}) == [0, 2, 3]


def test_better_source_wins_whatever_the_order(spark):
    pair = [{"ats_type": "eightfold", "location": "Paris"}, {"ats_type": "workday", "location": "Paris"}]
    for order in itertools.permutations(range(2)):
        assert kept(spark, *[pair[i] for i in order]) == [order.index(1)]


def test_same_source_stays(spark):
    assert kept(spark, {"location": "Paris"}, {"location": "Paris"}) == [0, 1]


def test_two_countries_stay_and_unknown_is_no_conflict(spark):
    a, b = {"ats_type": "lever", "location": "Paris, France"}, {"ats_type": "eures", "location": "Berlin, Germany"}
    assert kept(spark, a, b) == [0, 1]
    assert kept(spark, a, {"ats_type": "eures", "location": "somewhere"}) == [0]


def test_similar_titles(spark):
    a = {"ats_type": "lever", "title": "Senior Backend Engineer Payments"}
    assert kept(spark, a, {"ats_type": "eures", "title": "Senior Backend Engineers Payments"}) == [0]
    assert kept(spark, a, {"ats_type": "eures", "title": "Senior Frontend Designer Growth"}) == [0, 1]


def test_blocks_above_the_limit_are_told(spark):
    many = [{"ats_type": ("lever", "eures")[i % 2], "title": f"Role {chr(65 + i)}", "location": ("Paris, France", "Berlin, Germany")[i > 3]} for i in range(6)]
    found = dedup.keys(rows(spark, *many, {"company": "Other"}))
    assert [tuple(r) for r in dedup.too_large(found, 3).collect()] == [("acme", "FR", 4)]
    assert dedup.too_large(found, 4).count() == 0 and dedup.by_similar_title(found, 3).count() >= 5


def test_gated_row_gives_its_pay(spark):
    gated = {"ats_type": "welcometothejungle", "title": "Manager (Sales)", "salary_min": 1.0, "salary_max": 2.0, "salary_currency": "EUR", "location": "Paris, France"}
    all_rows = rows(spark, gated, {"ats_type": "greenhouse", "title": "Manager, Sales", "location": "Lyon, France"})
    found = dedup.deduplicated(dedup.keys(all_rows))
    left = all_rows.join(found.survivors.select("seq"), "seq", "left_semi")
    got = dedup.donated(left, all_rows, found.pairs).collect()
    assert [(r.seq, r.salary_min, r.salary_currency, r.salary_source) for r in got] == [(1, 1.0, "EUR", "welcometothejungle")]


def test_quarantine_order_and_split(spark):
    df = spark.createDataFrame([("2031-01-01", "n/a", 1.0, 9e9, "USD", "YEAR", ""), ("soon", "booking.com", None, None, None, None, None), (None, None, None, None, None, None, None), ("2024-01-01", "Acme Inc.", 1.0, 2.0, "USD", "YEAR", "$65 per hour")], "posted_at string, company string, salary_min double, salary_max double, salary_currency string, salary_period string, salary_summary string")
    assert [r[0] for r in df.select(quarantine.reason(df, "2024-06-01")).collect()] == ["future_posted_at", "placeholder_employer", None, "contradicted_salary_period"]
    good, bad = quarantine.split(df, "2024-06-01")
    assert (good.count(), bad.count()) == (1, 3)


def test_search_unknown_flags(spark):
    df = spark.createDataFrame([(0, "Remote job", "Berlin", None), (1, "x", "Remote", None), (2, "x", "Remote", False), (3, None, None, True)], "seq int, title string, location string, is_remote boolean")
    assert [r.seq for r in search.search(df, remote=True).collect()] == [1, 3]
    assert [r.seq for r in search.search(df, remote=False).collect()] == [2]
    assert [r.seq for r in search.search(df.drop("is_remote"), remote=False).collect()] == [0, 3]


def test_upsert_twice_is_once(spark):
    a = spark.createDataFrame([(1, "a", 1)], "k int, v string, t int")
    b = spark.createDataFrame([(1, "b", 2), (1, "c", 3), (2, "d", 1)], "k int, v string, t int")
    once = state.upserted(a, b, ["k"], F.desc("t"))
    twice = state.upserted(once, b, ["k"], F.desc("t"))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "c", 3), (2, "d", 1)]


def test_empty_slice_is_refused():
    import pytest

    with pytest.raises(sinks.EmptySliceError):
        sinks.guard({"lever": 3}, {"by_ats": {"lever": {"rows": 2}, "gem": {"rows": 5}}})
    sinks.guard({"lever": 3}, {"by_ats": {"gem": {"rows": 5}}}, allow_empty=True)
    assert sinks.read_manifest("{not json") == {}


def test_repeated_rows_count_once(spark):
    gated = {"seq": 0, "url": "x", "ats_type": "welcometothejungle", "title": "Manager (Sales)", "location": "Paris, France"}
    own = {"seq": 1, "url": "y", "ats_type": "greenhouse", "title": "Manager, Sales", "location": "Lyon, France"}
    left = dedup.exact_passes(dedup.keys(rows(spark, gated, own, own, gated)))
    assert sorted(r.seq for r in left.collect()) == [0, 1]
    assert [tuple(r) for r in dedup.gated_pairs(left).collect()] == [(0, 1)]


def test_one_row_a_url_where_ids_repeat(spark):
    same = {"seq": 5, "url": "x"}
    found = dedup.by_url(dedup.keys(rows(spark, same | {"title": "B"}, same | {"title": "A"}, same | {"title": "C"}))).collect()
    assert [(r.seq, r.title) for r in found] == [(5, "a")]
