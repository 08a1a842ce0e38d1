"""SQL text shared by the checks: the contests view and its long form."""

RAW = """raw_contests AS (
  SELECT l.*, o.o_custkey, o.o_custkey % k.teams AS home_team, l.l_suppkey AS away_team,
         CAST(year(l.l_shipdate) AS INTEGER) AS season_year,
         CAST((o.o_custkey % k.teams) % 5 AS INTEGER) AS league,
         CAST(month(l.l_shipdate) AS INTEGER) AS match_round,
         CAST(CAST(l.l_quantity AS INTEGER) % 5 AS INTEGER) AS home_goals,
         CAST(l.l_linenumber % 4 AS INTEGER) AS away_goals,
         row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                            l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS source_row
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  CROSS JOIN (SELECT count(*) AS teams FROM supplier) k
  WHERE o.o_custkey % k.teams <> l.l_suppkey
)"""

CONTESTS = (
    RAW
    + """, first_contests AS (
  SELECT * FROM raw_contests
  QUALIFY row_number() OVER (PARTITION BY home_team, away_team, season_year ORDER BY source_row) = 1
), contests AS (
  SELECT f.home_team, f.away_team, f.season_year, f.league, f.match_round, f.home_goals, f.away_goals,
    CASE WHEN home_goals > away_goals THEN 'home_win' WHEN home_goals = away_goals THEN 'draw'
         ELSE 'away_win' END AS result,
    CASE WHEN home_goals > away_goals THEN 3 WHEN home_goals = away_goals THEN 1 ELSE 0 END AS home_points,
    CASE WHEN home_goals > away_goals THEN 0 WHEN home_goals = away_goals THEN 1 ELSE 3 END AS away_points,
    l_shipdate AS date,
    CASE WHEN NOT (gone OR (season_year = 1998 AND home_team % 10 = 3))
         THEN CAST(l_partkey % 6 AS DOUBLE) END AS home_yellow,
    CASE WHEN NOT (gone OR (season_year = 1998 AND home_team % 10 = 3))
         THEN CAST(l_partkey % 13 = 0 AS DOUBLE) END AS home_red,
    CASE WHEN NOT (gone OR (season_year = 1998 AND away_team % 10 = 3))
         THEN CAST((l_partkey // 6) % 6 AS DOUBLE) END AS away_yellow,
    CASE WHEN NOT (gone OR (season_year = 1998 AND away_team % 10 = 3))
         THEN CAST(l_partkey % 17 = 0 AS DOUBLE) END AS away_red,
    CASE WHEN home_team % 9 <> 0 THEN CAST(1000 * (home_team % 50 + 1) AS DOUBLE) END AS capacity,
    CASE WHEN NOT no_elo THEN c_acctbal END AS home_elo,
    CASE WHEN NOT no_elo THEN s_acctbal END AS away_elo
  FROM (SELECT *, ((season_year = 1996 AND league = 2) OR l_partkey % 11 = 0) AS gone,
               ((season_year = 1997 AND league = 4) OR l_partkey % 7 = 0) AS no_elo FROM first_contests) f
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
)"""
)


def participants(source: str, name: str = "participants") -> str:
    """A CTE with one row per contest of ``source`` and side."""

    def side(label: str, number: int) -> str:
        return f"""SELECT home_team, away_team, season_year, league, match_round, '{label}' AS side,
    {number} AS side_ord, {label}_team AS team, {label}_goals AS goals, {label}_points AS points,
    {label}_yellow AS yellow, {label}_red AS red, {label}_elo AS elo FROM {source}"""

    return f"{name} AS (\n  {side('home', 0)}\n  UNION ALL {side('away', 1)}\n)"
