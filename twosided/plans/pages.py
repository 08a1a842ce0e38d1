"""The three kinds of contest pages: a round's results, a contest's ratings, a contest's cards.

Tags, classes and labels are fixed values of the pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twosided.functions import text
from twosided.functions.html import Field, Step, page_fields, page_records

ROUND_BOX = [Step("div", "panel-body p0 match-list-new")]
ROUND_MATCH = Step("a", "match-link")
ROUND_FIELDS = {
    "home_team": Field([Step("div", "team-info ta-r"), Step("div", "name")]),
    "away_team": Field([Step("div", "team-info", 1), Step("div", "name")]),
    "home_score": Field([Step("div", "marker"), Step("span", "r1")]),
    "away_score": Field([Step("div", "marker"), Step("span", "r2")]),
    "link": Field(attribute="href", default=None),
}

RATING_ROW = [Step("div", "panel-body pn compare-data"), Step("tr", nth=1)]
RATING_FIELDS = {
    "home_elo": Field([*RATING_ROW, Step("td", "team1-c")]),
    "away_elo": Field([*RATING_ROW, Step("td", "team2-c")]),
}

CARD_FIELDS = {
    "date_text": Field([Step("div", "date header-match-date")], default=None),
    "referee": Field(label=Step("div"), label_text="On field referee"),
    "home_yellow": Field([Step("div", "cards", 0), Step("span", "yc")], default="0"),
    "home_red": Field([Step("div", "cards", 0), Step("span", "rc")], default="0"),
    "away_yellow": Field([Step("div", "cards", 1), Step("span", "yc")], default="0"),
    "away_red": Field([Step("div", "cards", 1), Step("span", "rc")], default="0"),
}


def round_results(pages: DataFrame, keep: tuple[str, ...] = ("season_year", "match_round", "league")) -> DataFrame:
    """One row per contest of each results page; season, round and league come with the page."""
    found = page_records(pages, keep, ROUND_FIELDS, ROUND_MATCH, ROUND_BOX)
    score: Column = text.score_text(F.col("home_score"), F.col("away_score"))
    return found.withColumn("score", score).drop("home_score", "away_score", "place")


def contest_ratings(pages: DataFrame) -> DataFrame:
    """``link`` and the ratings as text, ``N/A`` where the page has none."""
    return page_fields(pages, ["link"], RATING_FIELDS)


def contest_cards(pages: DataFrame) -> DataFrame:
    """``link``, date, referee and the card counts of each contest page, which carries its ``season_year``."""
    found = page_fields(pages, ["link", "season_year"], CARD_FIELDS)
    cards = ["home_yellow", "home_red", "away_yellow", "away_red"]
    found = found.withColumns({name: F.trim(name).cast("double") for name in cards})
    return found.withColumn("date", text.scraped_date("date_text", "season_year")).drop("date_text", "season_year")


def number_of_rounds(pages: DataFrame, keys: list[str]) -> DataFrame:
    """The first whole number in the panel title of each page."""
    titles = page_fields(pages, keys, {"title": Field([Step("div", "panel-title")], default=None)})
    return titles.withColumn("rounds", text.first_number("title")).drop("title")
