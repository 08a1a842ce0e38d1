"""Sources, text fields, corrections and lookups."""

from pyspark.sql import functions as F

from twosided.catalog.contest_sql import CONTESTS, RAW
from twosided.functions import naming, text
from twosided.operators import corrections as fixes
from twosided.operators.joins import left_lookup, unmatched
from twosided.plans.contest_view import ROW_KEY, SOURCE_ORDER, contest_table, table
from twosided.plans.merge import merge_contests, parse_scores
from twosided.plans.source_view import match_info_text, ratings_map, results_text, score_corrections, team_info_text
from twosided.session import materialise, new_path
from twosided.sources import readers, sinks
from twosided.sources.schemas import LEAGUES

SEASONS = (1996, 1999)
BY_POSITION = {1: "0-0", 2: "3-2", 3: "0-1", 5: "0-0"}


def _played(spark, sf_dir):
    return results_text(spark, sf_dir).filter(~F.col("score").contains("N/A"))


def _corrections(played):
    # Written, their size is known when the join with the results is planned.
    return materialise(score_corrections(played), "corrections")


def bad_scores(spark, sf_dir):
    return _played(spark, sf_dir).filter(~text.is_score()).select("link", "score", "season_year", "league")


def corrections(spark, sf_dir):
    played = _played(spark, sf_dir)
    return fixes.apply_corrections(played, _corrections(played), ["link"], "score").select("link", "score")


def corrections_by_position(spark, sf_dir):
    played = _played(spark, sf_dir).select(*SOURCE_ORDER, "link", "score")
    table_ = fixes.corrections_by_position(played, ~text.is_score(), SOURCE_ORDER, SOURCE_ORDER, BY_POSITION, [4])
    return fixes.apply_corrections(played, table_, SOURCE_ORDER, "score").select("link", "score")


def parsed_scores(spark, sf_dir):
    played = _played(spark, sf_dir)
    fixed = fixes.apply_corrections(played, _corrections(played), ["link"], "score")
    return parse_scores(fixed, SOURCE_ORDER).drop(*SOURCE_ORDER)


def result_points(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "home_goals", "away_goals")
    return text.with_result(df)


def match_keys(spark, sf_dir):
    df = results_text(spark, sf_dir).select("link", "season_year")
    df = df.withColumns({"from_teams": text.key_from_teams(), "from_link": text.key_from_link()})
    return df.drop("season_year")


def match_info_fields(spark, sf_dir):
    df = readers.parse_match_info(match_info_text(spark, sf_dir))
    df = df.withColumn("match_id", text.key_from_link()).drop("link")
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def team_info(spark, sf_dir):
    return readers.parse_team_info(team_info_text(spark, sf_dir), "NATION_3")


def flatten_ratings(spark, sf_dir):
    return readers.flatten_ratings(ratings_map(spark, sf_dir))


def merged_contests(spark, sf_dir):
    results = _played(spark, sf_dir)
    merged = merge_contests(
        results,
        readers.parse_match_info(match_info_text(spark, sf_dir)),
        readers.parse_team_info(team_info_text(spark, sf_dir), "NATION_3"),
        readers.flatten_ratings(ratings_map(spark, sf_dir)),
        order=SOURCE_ORDER,
        corrections=_corrections(results),
        correction_keys=["link"],
    )
    return merged.drop(*SOURCE_ORDER).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def merge_dimensions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    joined = joined.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.drop("c_custkey", "n_nationkey")


def null_key_lookup(spark, sf_dir):
    key = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", key.alias("key"))
    customers = table(spark, sf_dir, "customer")
    other = customers.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("key"), "c_acctbal")
    return left_lookup(orders, other, "key")


def unmatched_results(spark, sf_dir):
    results = contest_table(spark, sf_dir).select(*ROW_KEY)
    results = results.withColumn("team", F.concat(F.lit("team-"), F.col("home_team").cast("string")))
    return unmatched(results, team_info(spark, sf_dir), "team").drop("team")


def season_filter(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "league", "result")
    return spark.sql(
        "SELECT * FROM {df} WHERE season_year = :season AND league = :league", {"season": 1998, "league": 3}, df=df
    )


def scan_results(spark, sf_dir):
    path = new_path(spark, "results")
    names = {"home_team": "Home_Team", "away_team": "Away_Team", "score": "Result", "link": "Link",
             "season_year": "Season", "match_round": "Round", "league": "League"}
    df = results_text(spark, sf_dir).select(*[F.col(old).alias(new) for old, new in names.items()])
    sinks.write_csv(df, path)
    return readers.scan_results(spark, path)


def scan_match_info(spark, sf_dir):
    path = new_path(spark, "match-info")
    # Another order of columns than the reader's: they are found by name.
    sinks.write_csv(_reordered(match_info_text(spark, sf_dir)), path)
    df = readers.scan_match_info(spark, path).withColumn("match_id", text.key_from_link()).drop("link")
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def _reordered(df):
    return df.select(*reversed(df.columns))


def scan_team_info(spark, sf_dir):
    path = new_path(spark, "team-info")
    teams = team_info_text(spark, sf_dir)
    sinks.write_csv(_reordered(teams.withColumns({name: F.lit("any") for name in ("city", "stadium", "pitch")})), path)
    return readers.scan_team_info(spark, path, "NATION_3").select("team", "country", "capacity")


def scan_ratings(spark, sf_dir):
    path = new_path(spark, "ratings")
    ratings_map(spark, sf_dir).write.json(path)
    return readers.scan_ratings(spark, path)


def unparsed_dates(spark, sf_dir):
    """Dates in several layouts, some of them none."""
    layouts = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss", "'no date'"]
    place = F.col("o_orderkey") % len(layouts)
    spelled = F.coalesce(*[F.when(place == i, F.date_format("o_orderdate", layout)) for i, layout in enumerate(layouts)])
    orders = table(spark, sf_dir, "orders").select(spelled.alias("spelled"))
    return text.unparsed_dates(orders, "spelled", day_first=True)


def csv_round_trip(spark, sf_dir):
    path = new_path(spark, "contests-csv")
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "league", "result", "home_goals", "away_goals", "home_elo")
    sinks.write_csv(df, path, ["league"])
    read = spark.read.schema(df.schema).option("header", True).csv(path)
    return read.select(*df.columns)


def table_round_trip(spark, sf_dir):
    path = new_path(spark, "contests-table")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "league", "result", "capacity")
    sinks.replace_table(df, name, ["season_year"], path)
    return spark.table(name).select(*df.columns)


def concatenated(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), F.lit("supplier").alias("kind")
    )
    return readers.concatenate([customers, suppliers])


def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")

    def source(kind):
        last = F.max_by(F.struct("event_id", "value"), "event_id").alias("last")
        return events.filter(F.col("event_type") == kind).groupBy("user_id").agg(last).select("user_id", "last.*")

    kinds = [row[0] for row in events.select("event_type").distinct().orderBy("event_type").collect()]  # a handful of types
    return readers.merge_maps([source(kind) for kind in kinds], "user_id")


def flatten_map(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    entries = F.from_json("props", "map<string, string>")
    df = events.select("event_id", F.explode(entries).alias("name", "setting"))
    return df.withColumn("setting", F.nullif("setting", F.lit("N/A")).try_cast("double"))


def lower_names(spark, sf_dir):
    df = table(spark, sf_dir, "region")
    return naming.lower_names(naming.rename_with(df, str.upper))


def side_names(spark, sf_dir):
    df = contest_table(spark, sf_dir).select(*ROW_KEY, "home_goals", "home_yellow")
    stripped = naming.rename_with(df.drop("away_team"), naming.without_side("home"))
    return naming.rename_with(stripped, naming.with_side("host", keep=("season_year",)))


def first_numbers(spark, sf_dir):
    title = F.concat_ws(" ", F.lit("Round"), F.col("o_orderkey").cast("string"), F.lit("of 38x"), F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", title.alias("title"))
    return orders.select("o_orderkey", text.first_number("title").alias("number"))


def scraped_dates(spark, sf_dir):
    spelled = F.upper(F.date_format("o_orderdate", "EEE, d MMM"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", spelled.alias("spelled"))
    orders = orders.withColumn("year", F.year("o_orderdate"))
    return orders.select("o_orderkey", F.date_format(text.scraped_date("spelled", "year"), "dd-MM-yyyy").alias("day"))


def day_first_dates(spark, sf_dir):
    spelled = F.when(F.col("o_orderkey") % 10 != 0, F.date_format("o_orderdate", "dd-MM-yyyy")).otherwise("N/A")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", spelled.alias("spelled"))
    day = text.parse_date("spelled", day_first=True)
    return orders.select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"))


def score_texts(spark, sf_dir):
    padded = F.when(F.col("home_goals") != 3, F.concat(F.lit("  "), F.col("home_goals").cast("string"), F.lit(" ")))
    score = text.score_text(padded, F.col("away_goals").cast("string"))
    return contest_table(spark, sf_dir).select(*ROW_KEY, score.alias("score"))


QUERIES = {
    "bad_scores": bad_scores,
    "corrections": corrections,
    "corrections_by_position": corrections_by_position,
    "parse_scores": parsed_scores,
    "result_points": result_points,
    "match_keys": match_keys,
    "match_info_fields": match_info_fields,
    "team_info": team_info,
    "flatten_ratings": flatten_ratings,
    "merge_contests": merged_contests,
    "merge_dimensions": merge_dimensions,
    "null_key_lookup": null_key_lookup,
    "unmatched_results": unmatched_results,
    "season_filter": season_filter,
    "scan_results": scan_results,
    "scan_match_info": scan_match_info,
    "scan_team_info": scan_team_info,
    "scan_ratings": scan_ratings,
    "unparsed_dates": unparsed_dates,
    "csv_round_trip": csv_round_trip,
    "table_round_trip": table_round_trip,
    "concatenated": concatenated,
    "latest_per_key": latest_per_key,
    "flatten_map": flatten_map,
    "lower_names": lower_names,
    "side_names": side_names,
    "first_numbers": first_numbers,
    "scraped_dates": scraped_dates,
    "day_first_dates": day_first_dates,
    "score_texts": score_texts,
}

KEY = "home_team, away_team, season_year"
LEAGUE_SQL = "CASE league " + " ".join(f"WHEN {i} THEN '{LEAGUES[i]}'" for i in range(5)) + " END"
TEXT = f"""{RAW}, results_text AS (
  SELECT 'team-' || home_team AS home_team, 'team-' || away_team AS away_team,
    'https://scores.example.com/match/team-' || home_team || '/team-' || away_team || '/' || season_year || '-'
      || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS link,
    season_year, match_round, {LEAGUE_SQL} AS league, source_row, l_orderkey,
    CASE WHEN l_partkey % 97 = 0 THEN 'N/A-N/A' WHEN l_partkey % 89 = 0 THEN 'abandoned'
         ELSE home_goals || '-' || away_goals END AS score
  FROM raw_contests
), corrected AS (
  SELECT * REPLACE (CASE WHEN score = 'abandoned' THEN '0-0' ELSE score END AS score) FROM results_text
  WHERE score <> 'N/A-N/A' AND NOT (score = 'abandoned' AND l_orderkey % 2 = 1)
), goals AS (
  SELECT * EXCLUDE (source_row, l_orderkey), CAST(split_part(score, '-', 1) AS INTEGER) AS home_goals,
    CAST(split_part(score, '-', 2) AS INTEGER) AS away_goals FROM corrected
  QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY source_row) = 1
), parsed AS (
  SELECT *, CASE WHEN home_goals > away_goals THEN 'home_win' WHEN home_goals = away_goals THEN 'draw'
                 ELSE 'away_win' END AS result,
    CASE WHEN home_goals > away_goals THEN 3 WHEN home_goals = away_goals THEN 1 ELSE 0 END AS home_points,
    CASE WHEN home_goals > away_goals THEN 0 WHEN home_goals = away_goals THEN 1 ELSE 3 END AS away_points
  FROM goals
), match_info AS (
  SELECT 'team-' || home_team || '/team-' || away_team || '/'
      || CASE WHEN season_year = 2001 THEN 2101 ELSE season_year END AS match_id,
    CASE WHEN home_team % 10 <> 0 THEN season_year || '-' || lpad(CAST(home_team % 12 + 1 AS VARCHAR), 2, '0')
      || '-' || lpad(CAST(away_team % 28 + 1 AS VARCHAR), 2, '0') END AS date,
    CASE WHEN away_team % 8 <> 0 THEN 'J. O-é ' || away_team % 9 END AS referee,
    CASE WHEN known THEN CAST((home_team * 7 + away_team) % 6 AS DOUBLE) END AS home_yellow,
    CASE WHEN known THEN CAST((home_team + away_team) % 2 AS DOUBLE) END AS home_red,
    CASE WHEN known THEN CAST((home_team + away_team * 5) % 6 AS DOUBLE) END AS away_yellow,
    CASE WHEN known THEN CAST((home_team * 3 + away_team) % 2 AS DOUBLE) END AS away_red
  FROM (SELECT DISTINCT home_team, away_team, season_year, (home_team + season_year) % 11 <> 0 AS known
        FROM raw_contests)
), team_info AS (
  SELECT 'team-' || s_suppkey AS team, CASE WHEN s_suppkey % 13 <> 0 THEN n_name END AS country,
    CAST(1000 * (s_suppkey % 50 + 1) + s_suppkey % 7 AS INTEGER) AS capacity
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  WHERE s_suppkey % 13 = 0 OR n_name IS DISTINCT FROM 'NATION_3'
), ratings AS (
  SELECT DISTINCT 'https://scores.example.com/match/team-' || home_team || '/team-' || away_team || '/'
      || season_year || '-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
      || CASE WHEN l_tax > 0 THEN '' ELSE '-untaxed' END AS link,
    CASE WHEN l_partkey % 7 <> 0 THEN c_acctbal END AS home_elo,
    CASE WHEN l_partkey % 7 <> 0 THEN s_acctbal END AS away_elo
  FROM raw_contests JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
)"""

ORACLE = {
    "bad_scores": f"WITH {TEXT} SELECT link, score, season_year, league FROM results_text WHERE score = 'abandoned'",
    "corrections": f"WITH {TEXT} SELECT link, score FROM corrected",
    "corrections_by_position": f"""WITH {TEXT}, bad AS (
        SELECT source_row, row_number() OVER (ORDER BY source_row) AS place FROM results_text
        WHERE score = 'abandoned')
        SELECT link, CASE place WHEN 1 THEN '0-0' WHEN 2 THEN '3-2' WHEN 3 THEN '0-1' WHEN 5 THEN '0-0'
          ELSE score END AS score FROM results_text LEFT JOIN bad USING (source_row)
        WHERE score <> 'N/A-N/A' AND place IS DISTINCT FROM 4""",
    "parse_scores": f"WITH {TEXT} SELECT * FROM parsed",
    "result_points": f"""WITH {CONTESTS} SELECT {KEY}, home_goals, away_goals, result, home_points, away_points
        FROM contests""",
    "match_keys": f"""WITH {TEXT} SELECT link,
        regexp_extract(link, 'match/([a-z0-9-]+/[a-z0-9-]+/)', 1) || season_year AS from_teams,
        regexp_extract(link, '/match/([a-z0-9-]+/[a-z0-9-]+/[0-9][0-9][0-9][0-9])', 1) AS from_link
        FROM results_text""",
    "match_info_fields": f"WITH {TEXT} SELECT * FROM match_info",
    "team_info": f"WITH {TEXT} SELECT * FROM team_info",
    "flatten_ratings": f"WITH {TEXT} SELECT * FROM ratings",
    "merge_contests": f"""WITH {TEXT} SELECT p.*, p.home_team || '/' || p.away_team || '/' || p.season_year AS match_id,
        m.* EXCLUDE (match_id), CAST(t.capacity AS DOUBLE) AS capacity, r.home_elo, r.away_elo FROM parsed p
        LEFT JOIN match_info m ON m.match_id = p.home_team || '/' || p.away_team || '/' || p.season_year
        LEFT JOIN team_info t ON t.team = p.home_team LEFT JOIN ratings r ON r.link = p.link""",
    "merge_dimensions": """SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_nationkey, n_name FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "null_key_lookup": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'c' || o_custkey END AS key, c_acctbal
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND o_orderstatus <> 'P'""",
    "unmatched_results": f"""WITH {CONTESTS} SELECT {KEY} FROM contests ANTI JOIN (
        SELECT s_suppkey FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
        WHERE s_suppkey % 13 = 0 OR n_name IS DISTINCT FROM 'NATION_3') t ON home_team = s_suppkey""",
    "season_filter": f"""WITH {CONTESTS} SELECT {KEY}, league, result FROM contests
        WHERE season_year = 1998 AND league = 3""",
    "scan_results": f"""WITH {TEXT} SELECT home_team, away_team, score, link, season_year, match_round, league
        FROM results_text WHERE score <> 'N/A-N/A'""",
    "scan_match_info": f"WITH {TEXT} SELECT * FROM match_info",
    "scan_team_info": f"WITH {TEXT} SELECT * FROM team_info",
    "scan_ratings": f"WITH {TEXT} SELECT * FROM ratings",
    "unparsed_dates": "SELECT count(*) FILTER (o_orderkey % 4 = 3) AS unparsed FROM orders",
    "csv_round_trip": f"""WITH {CONTESTS} SELECT {KEY}, league, result, home_goals, away_goals, home_elo
        FROM contests""",
    "table_round_trip": f"WITH {CONTESTS} SELECT {KEY}, league, result, capacity FROM contests",
    "concatenated": """SELECT 'customer' AS kind, c_custkey AS key, c_name AS name FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier""",
    "latest_per_key": """SELECT user_id, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC, event_id DESC) = 1""",
    "flatten_map": """SELECT event_id, e.key AS name, TRY_CAST(e.value AS DOUBLE) AS setting
        FROM events, LATERAL (SELECT unnest(map_entries(CAST(CAST(props AS JSON) AS MAP(VARCHAR, VARCHAR)))) AS e)""",
    "lower_names": "SELECT r_regionkey, r_name FROM region",
    "side_names": f"""WITH {CONTESTS} SELECT home_team AS host_team, season_year, home_goals AS host_goals,
        home_yellow AS host_yellow FROM contests""",
    "first_numbers": "SELECT o_orderkey, o_orderkey AS number FROM orders",
    "scraped_dates": "SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS day FROM orders",
    "day_first_dates": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
    "score_texts": f"""WITH {CONTESTS} SELECT {KEY},
        CASE WHEN home_goals = 3 THEN 'N/A' ELSE CAST(home_goals AS VARCHAR) END || '-' || away_goals AS score
        FROM contests""",
}
