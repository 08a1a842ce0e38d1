"""Text fields: scores, results, keys from links, names, dates, numbers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns: fixed values. (?U) lets \w match letters outside ASCII.
SCORE = r"^\d+-\d+$"
TEAMS_IN_LINK = r"(?U)match/([\w-]+/[\w-]+/)"
KEY_IN_LINK = r"(?U)/match[_\d]*/([\w-]+/[\w-]+/[\d]{4})"
REFEREE = r"(?U)\r\nReferee: ([\w -.]+)"
FIRST_NUMBER = r"(?:^|\s)(\d+)(?=\s|$)"

# Tokens that stand for a missing value in text sources, and months in short form: fixed values.
NULL_TOKENS = ["", "N/A", "NaN", "nan", "NULL", "null", "None"]
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]


def extracted(column: str, pattern: str) -> Column:
    """The pattern's first group, null where it does not match."""
    return F.nullif(F.regexp_extract(F.col(column), pattern, 1), F.lit(""))


def without_tokens(df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Null instead of any of ``tokens`` in the text columns."""
    return df.withColumns({name: F.when(~F.col(name).isin(list(tokens)), F.col(name)) for name in columns})


def is_score(score: str = "score") -> Column:
    return F.col(score).rlike(SCORE)


def with_goals(df: DataFrame, score: str = "score") -> DataFrame:
    """``home_goals`` and ``away_goals`` from ``'2-1'``; a malformed number fails under ANSI mode."""
    parts = F.split(F.col(score), "-")
    return df.withColumns({"home_goals": parts[0].cast("int"), "away_goals": parts[1].cast("int")})


def result_of(home: str = "home_goals", away: str = "away_goals") -> Column:
    return F.when(F.col(home) > F.col(away), "home_win").when(F.col(home) == F.col(away), "draw").otherwise("away_win")


def points_of(side: str, result: str = "result") -> Column:
    """3 for a win of ``side``, 1 for a draw, else 0."""
    return F.when(F.col(result) == f"{side}_win", 3).when(F.col(result) == "draw", 1).otherwise(0)


def with_result(df: DataFrame) -> DataFrame:
    """``result`` and both sides' points from the goals."""
    df = df.withColumn("result", result_of())
    return df.withColumns({f"{side}_points": points_of(side) for side in ("home", "away")})


def key_from_teams(link: str = "link", season: str = "season_year") -> Column:
    """``'home/away/season'`` from a result's link and season; null where either is."""
    return F.concat(extracted(link, TEAMS_IN_LINK), F.col(season).cast("string"))


def key_from_link(link: str = "link") -> Column:
    """``'home/away/year'`` from a link that ends in an id starting with the year."""
    return extracted(link, KEY_IN_LINK)


def referee_name(column: str = "referee") -> Column:
    return extracted(column, REFEREE)


# What may stand beside the day, month and year of a date, in lower case: fixed values.
TIME_OF_DAY = r"(?:^|[t, ]+)(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?: ?[ap]\.?m\.?)?(?: ?(?:z|utc|gmt)|[+-]\d{2}:?\d{2})?$"
WEEKDAY = r"^(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\.?,? +"
DATE = r"^(?:[0-9]{8}|(?:[0-9]{1,4}|[a-z]{3,9}\.?)(?:[ ,./-]+(?:[0-9]{1,4}|[a-z]{3,9}\.?)){2})$"
MONTH_NAMES = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
#: Two-digit years from this one on are of the last century.
LAST_CENTURY = 69


def parse_date(column: str, day_first: bool = False) -> Column:
    """A date from text in any usual spelling, a weekday before it and a time of day after it allowed; null where it is none.

    The text is taken apart into three tokens, or eight digits as year, month and day. A name among them is the month; beside it the
    year is the number of more than two digits, or else the last. Of three numbers, a first one of four digits is the year and the month
    comes next; otherwise the last is the year, and the day comes first if ``day_first``, else the month. Where one order is no date, the
    other one is tried. Two-digit years are from 1969 to 2068.
    """
    low = F.trim(F.lower(F.col(column)))
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(low, TIME_OF_DAY, ""), WEEKDAY, ""), r"(\d)(?:st|nd|rd|th)\b(?: of\b)?", "$1")
    return _let(bare, lambda bare: _let(_tokens(bare), lambda parts: _let(_named(parts), lambda x: _date_of(x, day_first))))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once, however often the body names it: written out, the steps of a date multiply."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _tokens(bare: Column) -> Column:
    """The three tokens of a date's text; null where it is none."""
    eight = F.array(F.substring(bare, 1, 4), F.substring(bare, 5, 2), F.substring(bare, 7, 2))
    split = F.regexp_extract_all(bare, F.lit("([a-z]+|[0-9]+)"), F.lit(1))
    return F.when(bare.rlike(DATE), F.when(bare.rlike(r"^\d{8}\z"), eight).otherwise(split))


def _named(parts: Column) -> Column:
    """The tokens ``a``, ``b``, ``c``, the months ``ma``, ``mb``, ``mc`` of those that are names, and the number of ``names``."""
    tokens = {name: F.get(parts, F.lit(i)) for i, name in enumerate("abc")}
    months = {f"m{name}": F.when(token.rlike("^[a-z]"), _month_of(token)) for name, token in tokens.items()}
    names = F.size(F.filter(parts, lambda x: x.rlike("^[a-z]")))
    return F.struct(*[value.alias(name) for name, value in (tokens | months).items()], names.alias("names"))


def _date_of(x: Column, day_first: bool) -> Column:
    a, b, c = x["a"], x["b"], x["c"]
    others = {"ma": (b, c), "mb": (a, c), "mc": (a, b)}
    spelled = [F.when(x[month].isNotNull(), _day(*_year_and_day(x[month], *two))) for month, two in others.items()]
    day_then_month, month_then_day = _day(c, b, a), _day(c, a, b)
    first, second = (day_then_month, month_then_day) if day_first else (month_then_day, day_then_month)
    numbers = F.when(F.length(a) == 4, F.coalesce(_day(a, b, c), _day(a, c, b))).otherwise(F.coalesce(first, second))
    return F.when(x["names"] == 1, F.coalesce(*spelled)).when(x["names"] == 0, numbers)


def _month_of(word: Column) -> Column:
    """The number of a month from its name or a beginning of at least three letters; null for other words."""
    return F.coalesce(*[F.when(F.lit(name).startswith(word) | ((word == "sept") & F.lit(name == "september")), F.lit(str(i)))
                        for i, name in enumerate(MONTH_NAMES, 1)])


def _year_and_day(month: Column, a: Column, b: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of two numbers beside a month's name."""
    swapped = F.length(a) > 2
    return F.when(swapped, a).otherwise(b), month, F.when(swapped, b).otherwise(a)


def _day(year: Column, month: Column, day: Column) -> Column:
    """The date of three numbers as text; null if there is no such day."""
    short = F.length(year) <= 2
    full = F.when(short, (F.lit(2000) - F.when(year.try_cast("int") >= LAST_CENTURY, 100).otherwise(0) + year.try_cast("int")).cast("string")).when(F.length(year) == 4, year)
    fits = (F.length(month) <= 2) & (F.length(day) <= 2)
    return F.when(fits, F.try_to_timestamp(F.concat_ws("-", F.nullif(full, F.lit("")), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd"))).cast("date")


def unparsed_dates(df: DataFrame, column: str, day_first: bool = False) -> DataFrame:
    """How many values of ``column`` that stand for something are no date in any spelling."""
    known = F.col(column).isNotNull() & ~F.col(column).isin(NULL_TOKENS)
    return df.agg(F.count_if(known & parse_date(column, day_first).isNull()).alias("unparsed"))


def whole_number(column: str) -> Column:
    """``'60,704'`` as 60704."""
    return F.translate(F.col(column), ",", "").cast("int")


def score_text(home: Column, away: Column, missing: str = "N/A") -> Column:
    """``'home-away'`` of trimmed parts, with ``missing`` in place of an absent one."""
    return F.concat_ws("-", *[F.coalesce(F.trim(part), F.lit(missing)) for part in (home, away)])


def first_number(column: str) -> Column:
    """The first word made of digits only, as a number."""
    return extracted(column, FIRST_NUMBER).try_cast("bigint")


def scraped_date(column: str, year: str) -> Column:
    """``'SAT, 12 AUG'`` and a year as a date."""
    day_month = F.regexp_extract(F.col(column), r"^(?:[A-Z]{3}, )?(\d{1,2}) ([A-Z]{3})$", 1)
    month = F.regexp_extract(F.col(column), r"^(?:[A-Z]{3}, )?(\d{1,2}) ([A-Z]{3})$", 2)
    numbers = F.create_map(*[F.lit(item) for i, name in enumerate(MONTHS, 1) for item in (name, i)])
    return F.make_date(F.col(year), F.try_element_at(numbers, month), F.nullif(day_month, F.lit("")).cast("int"))


def league_labels(df: DataFrame, labels: Mapping[object, tuple[str, str]], league: str = "league") -> DataFrame:
    """``country`` and ``division`` of each league; ``labels`` holds a dozen entries, so they become literals."""
    pairs = {
        name: F.create_map(*[F.lit(item) for key, label in labels.items() for item in (key, label[place])])
        for place, name in enumerate(("country", "division"))
    }
    return df.withColumns({name: F.try_element_at(lookup, F.col(league)) for name, lookup in pairs.items()})
