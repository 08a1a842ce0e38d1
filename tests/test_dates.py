"""Dates in thirty spellings, in both orders, and text that is no date."""

import pytest

from twosided.functions import text

#: Spelling -> the date with the month first, with the day first.
SPELLINGS = {
    "2023-08-13": ("2023-08-13",) * 2, "2023/08/13": ("2023-08-13",) * 2, "2023.8.3": ("2023-08-03",) * 2, "20230813": ("2023-08-13",) * 2,
    "2023-08-13 15:00": ("2023-08-13",) * 2, "2023-08-13T15:00:01": ("2023-08-13",) * 2, "2023-08-13T15:00:01.250Z": ("2023-08-13",) * 2,
    "2023-08-13 15:00:00+02:00": ("2023-08-13",) * 2, "2023-13-08": ("2023-08-13",) * 2,
    "13-08-2023": ("2023-08-13",) * 2, "13/08/2023": ("2023-08-13",) * 2, "13.08.2023": ("2023-08-13",) * 2, "13/08/2023 3:00 PM": ("2023-08-13",) * 2,
    "08/13/2023": ("2023-08-13",) * 2, "05/04/2021": ("2021-05-04", "2021-04-05"), "5-4-21": ("2021-05-04", "2021-04-05"), "05.04.99": ("1999-05-04", "1999-04-05"),
    "13/08/68": ("2068-08-13",) * 2, "13/08/69": ("1969-08-13",) * 2,
    "13 Aug 2023": ("2023-08-13",) * 2, "13 August 2023": ("2023-08-13",) * 2, "Aug 13, 2023": ("2023-08-13",) * 2, "August 13th, 2023": ("2023-08-13",) * 2,
    "13th of August 2023": ("2023-08-13",) * 2, "Sun, 13 Aug 2023": ("2023-08-13",) * 2, "Sunday 13 August 2023 15:00": ("2023-08-13",) * 2,
    "SAT, 12 AUG 2023": ("2023-08-12",) * 2, "13-Aug-23": ("2023-08-13",) * 2, "2023-Aug-13": ("2023-08-13",) * 2, "2023 August 13": ("2023-08-13",) * 2,
    "Aug. 13 2023": ("2023-08-13",) * 2, "1 Sept 2020": ("2020-09-01",) * 2, "29 Feb 2024": ("2024-02-29",) * 2, " 1 may 2020 ": ("2020-05-01",) * 2,
}
NO_DATES = ["odd", "", "N/A", "13 Foo 2023", "2023-02-30", "29 Feb 2023", "32/01/2020", "2023-08", "2023-08-13-01", "99999999", "Aug Aug 2023", "13 Aug 02023",
            "2023-08-13 25:00", "12:30", "1/2/345", "ma 1 2020", "13 Augustus 2023"]


@pytest.mark.parametrize("day_first", [False, True])
def test_spellings(spark, day_first):
    df = spark.createDataFrame([(x,) for x in [*SPELLINGS, *NO_DATES, None]], "d string")
    found = {r.d: str(r.date) for r in df.select("d", text.parse_date("d", day_first).alias("date")).collect()}
    assert found == {x: dates[day_first] for x, dates in SPELLINGS.items()} | dict.fromkeys([*NO_DATES, None], "None")


def test_all_spellings_are_dates(spark):
    df = spark.createDataFrame([(x,) for x in SPELLINGS], "d string")
    assert len(SPELLINGS) >= 30 and text.unparsed_dates(df, "d").first().unparsed == 0


def test_steps_of_a_date_are_written_once(spark):
    df = spark.createDataFrame([("2023-08-13",)], "d string").select(text.parse_date("d").alias("date"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 3 and plan.count("regexp_extract_all(") == 1


def test_a_line_end_is_no_part_of_a_date(spark):
    df = spark.createDataFrame([("20230813\n",)], "d string")
    assert df.select(text.parse_date("d")).first()[0] is None
