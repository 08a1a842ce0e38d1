"""Golden text files through the readers, the merge and the cleaning, and the sinks."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from twosided.functions import naming, text
from twosided.plans.merge import read_and_merge
from twosided.plans.prepare import prepare
from twosided.sources import readers, schemas, sinks

HEADER = "Home_Team,Away_Team,Result,Link,Season,Round,League\n"
SITE = "https://scores.example.com"
ROWS = {
    ("premier_league", 2020): [
        "Ärsenal,Boro,2-1,{s}/match/arsenal/boro/2020111,2020,1,premier_league",
        "Ärsenal,Boro,5-5,{s}/match/arsenal/boro/2020999,2020,2,premier_league",
        "Boro,Ärsenal,0-0,{s}/match/boro/arsenal/2020222,2020,2,premier_league",
        "City,Boro,N/A-N/A,{s}/match/city/boro/2020333,2020,3,premier_league",
        "City,Ärsenal,abandoned,{s}/match/city/arsenal/2020444,2020,3,premier_league",
    ],
    ("championship", 2021): [
        '"Dale, The",Ende,1-3,{s}/other/dale/ende,2021,1,championship',
        'Ende,"Dale, The",pending,{s}/match/ende/dale/2021777,2021,2,championship',
    ],
}
INFO = (
    "Link,Date_New,Referee,Home_Yellow,Home_Red,Away_Yellow,Away_Red\n"
    f'{SITE}/match_123/arsenal/boro/2020111,2020-08-12,"\r\nReferee: J.P. O Neíl\r\n",1,0,2,\n'
    f"{SITE}/match/boro/arsenal/2020222,,N/A,,,,\n"
)
TEAMS = (
    "Team,City,Country,Stadium,Capacity,Pitch\n"
    'Ärsenal,London,England,Emirates,"60,704",Natural\n'
    'Porto,Porto,Portugal,Dragao,"50,000",Natural\n'
    'Boro,Middlesbrough,,,"34,000",\n'
)


@pytest.fixture
def files(tmp_path):
    for (league, year), rows in ROWS.items():
        folder = tmp_path / league
        folder.mkdir()
        body = HEADER + "".join(row.format(s=SITE) + "\n" for row in rows)
        (folder / f"Results_{year}_{league}.csv").write_text(body, encoding="utf-8")
    (tmp_path / "info.csv").write_bytes(INFO.encode())
    (tmp_path / "teams.csv").write_text(TEAMS, encoding="utf-8")
    link = f"{SITE}/match/arsenal/boro/2020111"
    lines = [{"ratings": {link: {"Elo_home": "71.5", "Elo_away": "N/A"}, "x": {"Elo_home": "N/A", "Elo_away": "3"}}}]
    (tmp_path / "elo.json").write_text("\n".join(map(json.dumps, lines)))
    return tmp_path


def paths(files):
    return [f"{files}/{league}/Results_{year}_{league}.csv" for league, year in ROWS]


def test_result_paths_name_only_the_wanted_files():
    found = readers.result_paths("/data", ["serie_a"], [2000, 2001])
    assert found == ["/data/serie_a/Results_2000_serie_a.csv", "/data/serie_a/Results_2001_serie_a.csv"]
    assert len(readers.result_paths("/data")) == 12 * 32
    assert set(schemas.LEAGUE_LABELS) == set(schemas.LEAGUES)


def test_scan_leaves_out_unplayed_contests(spark, files):
    df = readers.scan_results(spark, paths(files))
    assert df.columns == ["home_team", "away_team", "score", "link", "season_year", "match_round", "league"]
    assert df.count() == 6
    assert {r.home_team for r in df.collect()} == {"Ärsenal", "Boro", "City", "Dale, The", "Ende"}


def test_zip_archives_give_the_same_rows(spark, files):
    with zipfile.ZipFile(files / "all.zip", "w") as archive:
        for path in paths(files):
            archive.write(path, f"Data/{path.rsplit('/', 1)[1]}")
        archive.writestr("Data/readme.txt", "not a result")
    zipped = readers.scan_zipped_results(spark, str(files / "all.zip"))
    plain = readers.scan_results(spark, paths(files))
    assert sorted(map(tuple, zipped.collect())) == sorted(map(tuple, plain.collect()))


def test_match_info(spark, files):
    df = readers.scan_match_info(spark, str(files / "info.csv")).withColumn("key", text.key_from_link())
    first, second = sorted(df.collect(), key=lambda r: r.key)
    assert (first.key, str(first.date), first.referee) == ("arsenal/boro/2020", "2020-08-12", "J.P. O Neíl")
    assert (first.home_yellow, first.away_red) == (1.0, None)
    assert (second.key, second.date, second.referee) == ("boro/arsenal/2020", None, None)


def test_team_info_drops_one_country_and_keeps_unknown_ones(spark, files):
    df = readers.scan_team_info(spark, str(files / "teams.csv"))
    assert {(r.team, r.capacity) for r in df.collect()} == {("Ärsenal", 60704), ("Boro", 34000)}


def test_ratings(spark, files):
    df = readers.scan_ratings(spark, str(files / "elo.json"))
    got = {r.link: (r.home_elo, r.away_elo) for r in df.collect()}
    assert got == {f"{SITE}/match/arsenal/boro/2020111": (71.5, None), "x": (None, 3.0)}


def test_read_merge_clean_and_features(spark, files):
    bad = readers.scan_results(spark, paths(files)).filter(~text.is_score())
    fixes = bad.select(
        *["home_team", "away_team", "season_year"],
        F.lit("3-0").alias("new_value"),
        F.when(F.col("score") == "pending", "delete").otherwise("patch").alias("action"),
    )
    merged = read_and_merge(
        spark, paths(files), str(files / "info.csv"), str(files / "teams.csv"), str(files / "elo.json"), fixes
    )
    rows = {(r.home_team, r.away_team): r for r in merged.collect()}
    assert set(rows) == {("Ärsenal", "Boro"), ("Boro", "Ärsenal"), ("City", "Ärsenal"), ("Dale, The", "Ende")}
    first = rows["Ärsenal", "Boro"]
    assert (first.score, first.result, first.home_points, first.away_points) == ("2-1", "home_win", 3, 0)
    assert (first.match_id, first.capacity, first.home_elo) == ("arsenal/boro/2020", 60704.0, 71.5)
    assert rows["Dale, The", "Ende"].match_id is None and rows["Dale, The", "Ende"].result == "away_win"
    assert rows["City", "Ärsenal"].home_goals == 3
    sources = paths(files), str(files / "info.csv"), str(files / "teams.csv"), str(files / "elo.json")
    frame = prepare(spark, *sources, fixes, table="prepared_contests", table_path=str(files / "published"))
    featured = {r.home_team: r for r in frame.collect()}
    assert spark.table("prepared_contests").count() == 4 == frame.count()
    assert featured["City"].away_form == 3 + 1 and featured["City"].away_total_goals == 2
    assert featured["Boro"].home_form == 0 and featured["Boro"].away_team_away_form == 0
    assert featured["Boro"].missing_cards and "date" not in frame.columns


def test_later_maps_win(spark):
    one = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    two = spark.createDataFrame([("b", None, "z")], "k string, v int, w string")
    got = {r.k: (r.v, r.w) for r in readers.merge_maps([one, two], "k").collect()}
    assert got == {"a": (1, "x"), "b": (None, "z")}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", None), (2, 'say "c"', 2.5)], "i int, t string, x double")
    sinks.write_csv(df, str(tmp_path / "out"))
    back = spark.read.schema(df.schema).option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == [(1, "a,b", None), (2, 'say "c"', 2.5)]
    for _ in range(2):
        sinks.replace_table(df, "sink_test", path=str(tmp_path / "table"))
    assert spark.table("sink_test").count() == 2


def test_text_fields(spark):
    df = spark.createDataFrame(
        [("SAT, 12 AUG", 2023, "Round 38 of 3x 40"), ("3 FEB", 2024, "no number"), ("odd", 2024, "7")],
        "d string, y int, t string",
    )
    got = df.select(text.scraped_date("d", "y").alias("day"), text.first_number("t").alias("n")).collect()
    assert [(str(r.day), r.n) for r in got] == [("2023-08-12", 38), ("2024-02-03", None), ("None", 7)]
    names = naming.rename_with(df.limit(0), naming.with_side("home", keep=("y",)))
    assert names.columns == ["home_d", "y", "home_t"]
    assert naming.rename_with(names, naming.without_side("home")).columns == ["d", "y", "t"]


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Away_Team,Home_Team,Season,Result,Link,Round,League\nB,A,2020,1-0,x,1,serie_a\n")
    row = readers.scan_results(spark, str(tmp_path / "a.csv")).first()
    assert (row.home_team, row.away_team, row.season_year) == ("A", "B", 2020)
    (tmp_path / "b.csv").write_text(HEADER + "A,B,1-0,x,20x0,1,serie_a\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.scan_results(spark, str(tmp_path / "b.csv")).collect()


def test_zip_members_keep_quoted_line_ends(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("Results_2020_x.csv", HEADER + '"A\nB",C,1-0,x,2020,1,serie_a\n')
        archive.writestr("Results_2021_x.csv", "Away_Team,Home_Team,Season,Result,Link,Round,League\nB,A,2021,1-0,x,1,serie_a\n")
        archive.writestr("Results_2022_x.csv", "")
    rows = {r.season_year: (r.home_team, r.away_team) for r in readers.scan_zipped_results(spark, str(tmp_path / "a.zip")).collect()}
    assert rows == {2020: ("A\nB", "C"), 2021: ("A", "B")}


def test_year_first_dates_in_day_first_files(spark, tmp_path):
    (tmp_path / "i.csv").write_text("Link,Date_New,Referee,Home_Yellow,Home_Red,Away_Yellow,Away_Red\nx,2023-08-13,Name,1,0,0,0\ny,13/08/2023,Name,1,0,0,0\n")
    assert {str(r.date) for r in readers.scan_match_info(spark, str(tmp_path / "i.csv"), day_first=True).collect()} == {"2023-08-13"}


RATING_LINES = [
    '{"ratings": {"a": {"Elo_home": "1.5", "Elo_away": "N/A"}, "b": {"Elo_home": 17, "Elo_away": 2.50e1}}}', "", "   ",
    '{"ratings": {"c": null, "d": {}, "e": {"Elo_home": true, "Elo_away": [1]}}}', '{"ratings": {"f": 5, "g": {"Elo_home": "1"}}}',
    "{'ratings': {'h': {'Elo_home': '3'}}}", '{"ratings": {"i": {"Elo_home": "1"}, "i": {"Elo_home": "2", "Elo_home": "3"}}}',
    '{"ratings": []}', '{"ratings": null}', '{"other": 1}', "[]", "7", '{"ratings": {"j": {"Elo_home": "1"', "nonsense",
    '[{"ratings": {"k": {"Elo_home": "8"}}}, {"ratings": {"l": {"Elo_away": "9"}}}]', '[1, {"ratings": {"m": {"Elo_home": "5"}}}]',
    '{"ratings": {"\\u00e9\\ud83d\\ude00": {"Elo_home": NaN, "Elo_away": -Infinity}}} trailing', '{"ratings": {"n": {"Elo_home": "\\ud800"}}}',
]


def test_links_are_no_field_names_of_a_parser(spark, tmp_path):
    for i, line in enumerate(RATING_LINES):
        (tmp_path / f"{i:02d}.json").write_text(line + "\n", encoding="utf-8")
    df = readers.scan_ratings(spark, str(tmp_path))
    theirs = readers.flatten_ratings(spark.read.schema(schemas.RATINGS).json(str(tmp_path)))
    assert sorted(map(str, df.collect())) == sorted(map(str, theirs.collect()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan json" not in plan and "FileScan text" in plan
