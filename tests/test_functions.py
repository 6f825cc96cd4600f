"""Golden cases of the column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.functions import buckets, dates, geo, rules, text

D = dt.date


def apply(spark, values, schema, expr):
    """One result per input row, in order."""
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    return [r["x"] for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_strict_price(spark):
    texts = ["$1,200", "$261", "N/A", "US$ 20", "12.", "Free airport taxi", None, ""]
    assert apply(spark, texts, "c string", text.parse_price_strict(F.col("c"))) == [
        1200.0, 261.0, None, None, 12.0, None, None, None]


def test_first_number(spark):
    texts = ["0.6 miles from downtown", "N/A", "downtown", "1.2.3", None]
    assert apply(spark, texts, "c string", text.parse_first_number(F.col("c"))) == [0.6, None, None, None, None]


def test_currency_and_whole_numbers(spark):
    assert apply(spark, [100.0, None], "c double", text.convert_currency(F.col("c"))) == [135.0, None]
    assert apply(spark, ["2", "2.0", "two", None], "c string", text.parse_whole(F.col("c"))) == [2, 2, None, None]


def test_na_tokens(spark):
    texts = ["N/A", " nan ", "None", "", "ok", None]
    assert apply(spark, texts, "c string", text.null_if_na(F.col("c"))) == [None, None, None, None, "ok", None]


def test_lead_days(spark):
    pairs = [(D(2025, 10, 3), D(2025, 9, 19)), (D(2025, 10, 3), D(2025, 10, 5)), (D(2025, 10, 3), None)]
    assert apply(spark, pairs, "ci date, s date", dates.lead_days(F.col("ci"), F.col("s"))) == [14, 0, None]


def test_weekend_overlap_equals_day_loop(spark):
    pairs = [(D(2025, 9, 20) + dt.timedelta(days=a), D(2025, 9, 20) + dt.timedelta(days=a + n))
             for a in range(14) for n in range(-2, 9)] + [(None, D(2025, 1, 1))]

    def loop(ci, co):
        if ci is None:
            return False
        return any((ci + dt.timedelta(days=k)).weekday() >= 5 for k in range((co - ci).days + 1))

    assert apply(spark, pairs, "ci date, co date", dates.weekend_overlap(F.col("ci"), F.col("co"))) == [
        loop(*p) for p in pairs]


@pytest.mark.parametrize("bins,values,labels", [
    (fv.DISTANCE_BINS, [-1.0, 0.0, 0.5, 0.51, 5.0, 5.1], [None, "very_close", "very_close", "close", "moderate", "far"]),
    (fv.STAY_BINS, [0.0, 1.0, 2.0, 3.0, 4.0, 15.0], [None, "overnight", "short", "short", "week", "long_term"]),
    (fv.LEAD_BINS, [0.0, 7.0, 8.0, 91.0], ["same_day", "week", "month", "long_term"]),
    (fv.TEMPERATURE_BINS, [-50.0, 50.0, 50.1, None], [None, "hot", None, None]),
])
def test_right_closed_buckets(spark, bins, values, labels):
    assert apply(spark, values, "c double", buckets.bucket_right_closed(F.col("c"), *bins)) == labels


def test_haversine(spark):
    points = [(43.6426, -79.3871, 43.6414, -79.3894), (43.0, -79.0, 43.0, -79.0), (0.0, 0.0, 0.0, 180.0), (None, 0.0, 0.0, 0.0)]
    cols = [F.col(c) for c in "abcd"]
    schema = "a double, b double, c double, d double"
    km = apply(spark, points, schema, F.round(geo.haversine_km(*cols), 4))
    assert km == [0.2282, 0.0, 20015.0868, None]
    miles = apply(spark, points, schema, F.round(geo.haversine_miles(*cols), 4))
    assert miles[0] == 0.1418 and miles[1] == 0.0 and miles[3] is None


def test_nearest_point(spark):
    near = geo.nearest_point(F.col("a"), F.col("b"), fv.DISTRICTS[:-1])
    got = apply(spark, [(43.6532, -79.3832), (None, 1.0)], "a double, b double", near)
    assert got[0]["name"] == "Yonge - Dundas" and round(got[0]["km"], 3) == 0.436 and got[1] is None
    tie = geo.nearest_point(F.col("a"), F.col("b"), [("x", 1.0, 1.0), ("w", 1.0, 1.0)])
    assert apply(spark, [(1.0, 1.0)], "a double, b double", tie)[0]["name"] == "x"


def test_tiered_lookup(spark):
    keys = ["Harbourfront", "cityplace", "Airport", "Nowhere", None]
    got = apply(spark, keys, "c string", rules.tiered_lookup(F.col("c"), fv.DISTRICTS, "Toronto"))
    assert [(g["name"], g["tier"]) for g in got] == [
        ("Harbourfront", 1), ("CityPlace", 2), ("Airport Area", 3), ("Toronto", 4), ("Toronto", 4)]
    assert (got[0]["lat"], got[0]["lon"]) == (43.6389, -79.3817)


def test_rooms(spark):
    cases = {
        "Standard Double Room with Two Double Beds": "Family Room", "Superior Double Room": "Deluxe Room",
        "Queen Room": "Standard Queen", "Twin Room": "Standard Double",
        "One-Bedroom Apartment with Double Bed": "One-Bedroom Apartment",
        "Studio Apartment": "One-Bedroom Apartment", "Studio": "Studio", "Penthouse Suite": "Apartment",
        "Bungalow 4": "Large Apartment", None: "Standard", "Loft": "Standard", "Junior Suite": "Junior Suite",
    }
    assert apply(spark, list(cases), "c string", rules.classify_room(F.col("c"))) == list(cases.values())


def test_districts(spark):
    cases = [("Yonge - Dundas, Toronto", None), ("King Street West", None), ("East York", None), ("Toronto", None),
             (None, "Beach House"), ("Toronto", "Airport Inn")]
    got = apply(spark, cases, "a string, n string", rules.classify_district(F.col("a"), F.col("n")))
    assert got == ["Yonge - Dundas", "Financial District", "East York", None, "The Beaches", "Airport Area"]


def test_event_score(spark):
    cases = [
        ("Game", "Sports", "Hockey", "NHL", "Scotiabank Arena"), ("Show", "Music", "Rock", "Rock", "Massey Hall"),
        ("Gig", None, None, None, "Somewhere"),
        ("Laughs", "Arts & Theatre", "Comedy", "Undefined", "Comedy Bar - Danforth"),
        ("Pride Walk", None, None, None, None), ("Tiffany Live", None, None, None, None), ("Cindy Lee", None, None, None, None),
    ]
    got = apply(spark, cases, "n string, s string, g string, u string, v string",
                rules.event_score(*[F.col(c) for c in "nsguv"]))
    assert got == [11.2, 7.33, 1.8, 3.47, 11.5, 12.0, 10.5]


def test_interactions(spark):
    pairs = [(True, False), (None, True)]
    x = text.interaction(text.python_bool(F.col("a")), text.python_bool(F.col("b")))
    assert apply(spark, pairs, "a boolean, b boolean", x) == ["True_False", None]


def test_log_target_inverts(spark):
    back = buckets.inverse_log_target(buckets.log_target(F.col("c")))
    assert apply(spark, [0.0, 37.0, 1979.0], "c double", F.round(back, 6)) == [0.0, 37.0, 1979.0]
