"""Ordered rule tables compiled to CASE expressions, and literal lookup tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.functions import geo


def contains_any(c: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def first_match(c: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Label of the first rule with a word inside the lower-cased text, else null."""
    low = F.lower(c)
    chain = None
    for label, words in rules:
        test = contains_any(low, words)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain


def classify_district(address: Column | None = None, name: Column | None = None,
                      existing: Column | None = None) -> Column:
    """Existing district, else from the address, else from the hotel name."""
    parts = [] if existing is None else [existing]
    if address is not None:
        parts.append(first_match(address, fv.ADDRESS_RULES))
    if name is not None:
        parts.append(first_match(name, fv.HOTEL_NAME_RULES))
    return F.coalesce(*parts)


def classify_room(c: Column) -> Column:
    low = F.lower(c)
    chain = None
    for label, words, also in fv.ROOM_RULES:
        test = contains_any(low, words)
        if also:
            test = test & contains_any(low, also)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(fv.DEFAULT_ROOM)


def lookup(c: Column, table: Mapping[str, object], default: object) -> Column:
    """Value of a literal lookup table, ``default`` for missing keys and nulls."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(default))


def event_score(name: Column, segment: Column, genre: Column, subgenre: Column,
                venue: Column) -> Column:
    """Special keyword in the name, else mean part score times the venue multiplier."""
    low = F.lower(name)
    special = None
    for word, score in fv.SPECIAL_EVENTS:
        test = low.contains(word)
        special = F.when(test, F.lit(score)) if special is None else special.when(test, F.lit(score))
    parts = (
        lookup(segment, fv.SEGMENT_SCORES, fv.DEFAULT_PART_SCORE)
        + lookup(genre, fv.GENRE_SCORES, fv.DEFAULT_PART_SCORE)
        + lookup(subgenre, fv.SUBGENRE_SCORES, fv.DEFAULT_PART_SCORE)
    )
    factor = lookup(venue, fv.VENUE_MULTIPLIERS, fv.DEFAULT_VENUE_MULTIPLIER)
    return F.coalesce(special, F.round(parts / F.lit(3) * factor, 2))


def tiered_lookup(key: Column, points: Sequence[tuple[str, float, float]], default: str) -> Column:
    """Struct (name, lat, lon, tier): exact, then case-blind, then substring either way, then default.

    The fixed list is two literal maps and one literal array, so the lookup is local to the row.
    """
    def table(lower: bool) -> Column:
        first: dict[str, int] = {}
        for i, p in enumerate(points):
            first.setdefault(p[0].lower() if lower else p[0], i + 1)
        return F.create_map(*[x for item in first.items() for x in map(F.lit, item)])

    text = F.trim(key)
    low = F.lower(text)
    listed = geo.point_list(points)
    within = F.filter(listed, lambda p: F.lower(p["name"]).contains(low) | low.contains(F.lower(p["name"])))
    fallback = 1 + next(i for i, p in enumerate(points) if p[0] == default)

    def at(position: Column, tier: int) -> Column:
        return F.when(position.isNotNull(), F.struct(position.alias("at"), F.lit(tier).alias("tier")))

    found = F.coalesce(
        at(F.try_element_at(table(False), text), 1),
        at(F.try_element_at(table(True), low), 2),
        at(F.try_element_at(within, F.lit(1))["ord"] + 1, 3),
        at(F.lit(fallback), 4),
    )
    return F.transform(F.array(found), lambda f: F.struct(
        F.element_at(listed, f["at"])["name"].alias("name"), F.element_at(listed, f["at"])["lat"].alias("lat"),
        F.element_at(listed, f["at"])["lon"].alias("lon"), f["tier"].alias("tier"),
    ))[0]
