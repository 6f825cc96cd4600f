"""Captured API responses and listing pages as rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.operators.columns import select_available
from stayglass.functions.text import parse_date

NAMED = "STRUCT<name: STRING>"
EVENT_PAGE = f"""
    _embedded STRUCT<events: ARRAY<STRUCT<
        name: STRING,
        dates: STRUCT<start: STRUCT<localDate: STRING>>,
        _embedded: STRUCT<venues: ARRAY<STRUCT<
            name: STRING,
            address: STRUCT<line1: STRING>,
            location: STRUCT<latitude: STRING, longitude: STRING>>>>,
        classifications: ARRAY<STRUCT<segment: {NAMED}, genre: {NAMED}, subGenre: {NAMED}>>>>>,
    page STRUCT<totalPages: INT>
"""


def flatten_event_pages(pages: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per event of a page of JSON text; first venue, first classification.

    Missing leaves become the text ``N/A``; pages without events give no rows.
    """
    parsed = pages.select(*keep, F.from_json(body, EVENT_PAGE).alias("page"))
    events = parsed.select(*keep, F.explode("page._embedded.events").alias("e"))
    venue = F.try_element_at("e._embedded.venues", F.lit(1))
    kind = F.try_element_at("e.classifications", F.lit(1))

    def text(c: Column, name: str) -> Column:
        return F.coalesce(c, F.lit(fv.MISSING_TEXT)).alias(name)

    return events.select(
        *keep,
        F.col("e.name").alias("Event Name"),
        text(F.col("e.dates.start.localDate"), "Date"),
        text(venue["name"], "Venue"),
        text(venue["address"]["line1"], "Address"),
        text(venue["location"]["latitude"], "Latitude"),
        text(venue["location"]["longitude"], "Longitude"),
        text(kind["segment"]["name"], "Segment"),
        text(kind["genre"]["name"], "Genre"),
        text(kind["subGenre"]["name"], "SubGenre"),
    )


def unwrap_properties(pages: DataFrame, body: str, properties: str) -> DataFrame:
    """``features[].properties`` of GeoJSON text as rows; ``properties`` is a DDL field list."""
    schema = f"features ARRAY<STRUCT<properties: STRUCT<{properties}>>>"
    return (
        pages.select(F.from_json(body, schema).alias("page"))
        .select(F.explode("page.features").alias("f"))
        .select("f.properties.*")
    )


def clean_weather(weather: DataFrame, keep: Sequence[str] = fv.WEATHER_KEEP, date: str = "LOCAL_DATE") -> DataFrame:
    """Known weather columns only, the date typed."""
    kept = select_available(weather, keep)
    if date in kept.columns and dict(kept.dtypes)[date] == "string":
        kept = kept.withColumn(date, parse_date(F.substring(date, 1, 10)))
    return kept


def union_partials(frames: Sequence[DataFrame]) -> DataFrame:
    """Pages, months or years of one source as a single table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def extract_field(html: Column, patterns: Sequence[str]) -> Column:
    """First non-empty match of the patterns in order, else ``N/A``."""
    found = [F.nullif(F.trim(F.regexp_extract(html, p, 1)), F.lit("")) for p in patterns]
    return F.coalesce(*found, F.lit(fv.MISSING_TEXT))


def one_line(c: Column) -> Column:
    return F.regexp_replace(c, "\n", " ")


def listing_cards(pages: DataFrame, html: str, keep: Sequence[str] = (),
                  marker: str = 'data-testid="property-card"') -> DataFrame:
    """One row per listing card of a results page, with the listing fields as text."""
    pieces = F.split(html, marker)
    cards = pages.select(*keep, F.explode(F.slice(pieces, F.lit(2), F.size(pieces))).alias("_card"))
    fields = [extract_field(F.col("_card"), patterns).alias(name) for name, patterns in fv.LISTING_FIELDS]
    rows = cards.select(*keep, *fields)
    return rows.withColumn("price", one_line(F.col("price")))
