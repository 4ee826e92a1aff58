import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from stagelight.functions import geo
from stagelight.functions import text as T



def value(spark, column):
    return spark.range(1).select(column.alias("x")).head()["x"]


@pytest.mark.parametrize(("name", "slug"), [("Darrell's Tavern", "darrells-tavern"), ("Sea Monster Lounge!", "sea-monster-lounge"), ("The Venue, Seattle", "the-venue-seattle"), ("Tavern & Grill", "tavern--grill"), ("Café 9", "café-9")])
def test_slug_keep_runs(spark, name, slug):
    assert value(spark, T.slug_keep_runs(F.lit(name))) == slug


@pytest.mark.parametrize(("name", "slug"), [("Rock & Roll Club", "rock-roll-club"), ("  Spaces  Between  ", "spaces-between"), ("Ünder", "ünder")])
def test_slug(spark, name, slug):
    assert value(spark, T.slug(F.lit(name))) == slug


@pytest.mark.parametrize(("title", "is_"), [("Open Mic Night", True), ("Karaoke Thursday", True), ("Trivia Night", True), ("Comedy Show", True), ("Open Jam Session", True), ("The Beatles", False)])
def test_non_artist(spark, title, is_):
    assert value(spark, T.is_non_artist(F.lit(title))) is is_


@pytest.mark.parametrize(("a", "b", "s"), [("blue moon tavern", "blue moon", 2 / 3), ("blue moon", "red sun", 0), ("x", "x", 1), ("", "", 1)])
def test_token_jaccard(spark, a, b, s):
    assert value(spark, T.token_jaccard(F.lit(a), F.lit(b))) == pytest.approx(s)


def test_uuid5(spark):
    for name in ("neumos", "the-barboza", "é"):
        assert value(spark, T.uuid5(F.lit(name))) == str(uuid.uuid5(uuid.NAMESPACE_DNS, name))


@pytest.mark.parametrize(("text", "day"), [("January 15, 2025", date(2025, 1, 15)), ("1/15/2025", date(2025, 1, 15)), ("2025-01-15T20:00:00Z", date(2025, 1, 15)), ("Friday, January 5, 2025", date(2025, 1, 5)), ("soon", None), ("2025-02-30", None)])
def test_parse_day(spark, text, day):
    assert value(spark, T.parse_day(F.lit(text))) == day


@pytest.mark.parametrize(("text", "time"), [("7:30 PM", "19:30:00"), ("19:30", "19:30:00"), ("noon", "12:00:00"), ("midnight", "00:00:00"), ("1 p.m.", "13:00:00"), ("12 AM", "00:00:00"), ("late", None)])
def test_parse_time(spark, text, time):
    assert value(spark, T.parse_time(F.lit(text))) == time


def test_rolling_days(spark):
    AS_OF = F.lit("2025-11-15").cast("date")
    assert value(spark, T.day_of_year_roll(F.lit(2), F.lit(3), AS_OF)) == date(2026, 2, 3)
    assert value(spark, T.day_of_year_roll(F.lit(12), F.lit(3), AS_OF)) == date(2025, 12, 3)
    assert value(spark, T.ordinal_day(F.lit("Aug 31st"), AS_OF)) == date(2026, 8, 31)
    assert value(spark, T.ordinal_day(F.lit("August 31st"), AS_OF)) == date(2026, 8, 31)
    assert value(spark, T.weekday_day(F.lit("friday 08.29"), AS_OF)) == date(2025, 8, 29)


def test_titles(spark):
    assert value(spark, T.split_artists(F.lit("A, B & C / "))) == ["A", "B", "C"]
    assert value(spark, T.headliner(F.lit("Main Act!! feat. Guest"))) == "Main Act"
    assert value(spark, T.featured(F.lit("Main feat. Guest & Other"))) == ["Guest", "Other"]
    assert value(spark, T.with_acts(F.lit("Main with One, Two + Three"))) == ["Main", "One", "Two", "Three"]
    assert value(spark, T.legacy_title_artists(F.lit("Dance Night"))) == []
    assert value(spark, T.title_or_null(F.lit("  Spaced  "))) == "Spaced"
    assert value(spark, T.title_or_null(F.lit(" "))) is None
    assert value(spark, T.artist_tokens(F.array(F.lit("X Presents"), F.lit("Band"), F.lit("a")))) == ["Band"]
    assert value(spark, T.skip_reason(F.lit("Someone LIVE on KEXP"))) == "broadcast only"
    assert value(spark, T.skip_reason(F.lit("Someone LIVE on KEXP (OPEN TO THE PUBLIC)"))) is None


def test_geography(spark):
    y, x = F.lit(47.6131), F.lit(-122.3424)
    assert value(spark, geo.district(y, x)) == "Seattle"
    assert value(spark, geo.spatial_bin(y, x)) == "seattle_grid_4761_-12235"
    assert value(spark, geo.density(geo.from_center(y, x))) == "Dense"
    assert value(spark, geo.distance_km(F.lit(47.6062), F.lit(-122.3321), F.lit(47.6249), F.lit(-122.3120))) == pytest.approx(2.688, abs=1e-3)
    assert "Belltown" in value(spark, geo.landmarks(y, x))
    assert value(spark, geo.tags(F.lit("venue"), F.lit("Ballard"))) == ["venue", "location", "entertainment", "ballard", "craft_beer", "maritime", "seattle", "pacific_northwest"]
    assert value(spark, geo.density(F.lit(None).cast("double"))) == "Unknown"
