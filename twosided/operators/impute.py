"""Missing measures: flags, wholly missing blocks, fills from medians, fills along an entity's history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twosided.operators.ordered import MAX_GROUP_ROWS, FillBackward, FillForward, oversized_groups, with_ordered
from twosided.operators.quantiles import count_values, grouped_median, one_column_each, quantiles_from_counts
from twosided.operators.sides import SIDES, attach, by_team, pair, to_contests, to_participants
from twosided.session import materialise

CARDS = ["home_yellow", "home_red", "away_yellow", "away_red"]
ELO = ["home_elo", "away_elo"]
SEASON, BLOCK = ["season_year"], ["season_year", "league"]


def flag_missing(df: DataFrame, flags: Mapping[str, str] | None = None) -> DataFrame:
    """One boolean per ``{flag: column}``, true where the column is null; call it before any fill."""
    flags = {"missing_cards": "home_yellow", "missing_elo": "home_elo"} if flags is None else flags
    return df.withColumns({flag: F.col(column).isNull() for flag, column in flags.items()})


def block_missing(df: DataFrame, column: str, block: Sequence[str] = BLOCK) -> DataFrame:
    """Per block without null keys: ``missing`` and ``total`` rows of ``column``."""
    return (
        df.dropna(subset=list(block))
        .groupBy(*block)
        .agg(F.count_if(F.col(column).isNull()).alias("missing"), F.count(F.lit(1)).alias("total"))
    )


def wholly_missing(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.col("missing") == F.col("total"))


def partly_missing(blocks: DataFrame) -> DataFrame:
    return blocks.filter((F.col("missing") > 0) & (F.col("missing") < F.col("total")))


def any_missing(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.col("missing") > 0)


def participants_missing(df: DataFrame, measure: str = "yellow", block: Sequence[str] = BLOCK) -> DataFrame:
    """Per block and team, over both sides: ``missing`` and ``total`` rows of the measure."""
    rows = to_participants(df, ["team", measure], block)
    return block_missing(rows, measure, [*block, "team"])


def _fill_from(df: DataFrame, fill: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fill nulls of ``columns`` from the row of ``fill`` with the same keys, which are distinct there.

    ``fill`` is a written table, computed once however often later steps read the result. The join carries no
    broadcast hint: ``fill`` can grow with the number of teams, so Spark compares the size of its files with the
    broadcast threshold and otherwise joins by shuffle.
    """
    renamed = fill.select(*keys, *[F.col(name).alias(f"__{name}") for name in columns])
    filled = {name: F.coalesce(F.col(name), F.col(f"__{name}")) for name in columns}
    return df.join(renamed, list(keys), "left").withColumns(filled).drop(*[f"__{name}" for name in columns])


@dataclass(frozen=True)
class BlockRule:
    """Fill ``columns`` in blocks that lack the first of them.

    With ``wholly``, in blocks where it is missing throughout, from the medians of the coarser group; otherwise in
    blocks where it is missing at all, from the block's own medians.
    """

    columns: Sequence[str]
    wholly: bool


def block_fills(
    df: DataFrame,
    rules: Sequence[BlockRule],
    block: Sequence[str] = BLOCK,
    coarse: Sequence[str] = SEASON,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per block that some rule fills, with the median of every column to fill there, as a written table.

    All rules share one scan that looks for blocks and one that counts values, the latter only of groups in which
    something is to be filled.
    """
    fine = [name for name in block if name not in coarse]
    counts = [F.count_if(F.col(rule.columns[0]).isNull()).alias(f"__m{i}") for i, rule in enumerate(rules)]
    found = df.dropna(subset=list(block)).groupBy(*block).agg(F.count(F.lit(1)).alias("__total"), *counts)
    flags = []
    for i, rule in enumerate(rules):
        missing = F.col(f"__m{i}")
        flags.append((missing == F.col("__total") if rule.wholly else missing > 0).alias(f"__f{i}"))
    blocks = found.select(*block, *flags).filter(" OR ".join(f"__f{i}" for i in range(len(rules))))
    blocks = materialise(blocks, "blocks")

    own = [f"__f{i}" for i, rule in enumerate(rules) if not rule.wholly]
    wide = [f"__f{i}" for i, rule in enumerate(rules) if rule.wholly]
    needed = df
    if own:
        needed = needed.join(blocks.select(*block, *own), list(block), "left")
    if wide:
        groups = blocks.groupBy(*coarse).agg(*[F.max(name).alias(name) for name in wide])
        needed = needed.join(groups, list(coarse), "left")
    # Values of a coarse group are counted under a null fine key.
    values = [
        F.struct(
            *[(F.lit(None) if rule.wholly else F.col(name)).cast(df.schema[name].dataType).alias(name) for name in fine],
            F.lit(column).alias("measure"),
            F.when(F.col(f"__f{i}"), F.col(column).cast("double")).alias("value"),
        )
        for i, rule in enumerate(rules)
        for column in rule.columns
    ]
    long = needed.select(*coarse, F.explode(F.array(*values)).alias("__v")).select(*coarse, "__v.*")
    medians = quantiles_from_counts(*count_values(long, block), block, {"median": 0.5}, max_rows)

    fill = blocks
    for keys, wholly in ((coarse, True), (block, False)):
        columns = [c for rule in rules if rule.wholly == wholly for c in rule.columns]
        if columns:
            part = one_column_each(medians.filter(F.col("measure").isin(columns)), keys, columns, "median")
            fill = fill.join(part, list(keys), "left")
    chosen = [
        F.when(F.col(f"__f{i}"), F.col(column)).alias(column) for i, rule in enumerate(rules) for column in rule.columns
    ]
    return materialise(fill.select(*block, *chosen), "fill")


def fill_blocks(df: DataFrame, rules: Sequence[BlockRule], block: Sequence[str] = BLOCK, **options) -> DataFrame:
    """Fill nulls by several rules on disjoint columns, with one join."""
    columns = [column for rule in rules for column in rule.columns]
    return _fill_from(df, block_fills(df, rules, block, **options), block, columns)


def block_medians(df: DataFrame, columns: Sequence[str], wholly: bool, **options) -> DataFrame:
    """The blocks a single :class:`BlockRule` fills, with their medians."""
    return block_fills(df, [BlockRule(columns, wholly)], **options)


def fill_block_median(df: DataFrame, columns: Sequence[str], wholly: bool = False, **options) -> DataFrame:
    """Fill nulls of ``columns`` by a single :class:`BlockRule`."""
    return fill_blocks(df, [BlockRule(columns, wholly)], **options)


def fill_cards_by_season(df: DataFrame, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Card counts of blocks without any, from the medians of the season."""
    return fill_block_median(df, CARDS, wholly=True, max_rows=max_rows)


def team_block_medians(
    df: DataFrame,
    measures: Sequence[str] = ("yellow", "red"),
    block: Sequence[str] = BLOCK,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Teams whose first measure is missing for a whole block, with the block's medians of both sides' columns."""
    columns = [f"{side}_{name}" for side in SIDES for name in measures]
    teams = wholly_missing(participants_missing(df, measures[0], block)).select(*block, "team")
    teams = materialise(teams, "teams")
    needed = df.join(teams.select(*block).distinct(), list(block), "left_semi")
    # A block without any value has no median row; its teams stay, with nulls.
    return teams.join(grouped_median(needed, block, columns, max_rows), list(block), "left")


def fill_team_block_median(
    df: DataFrame,
    measures: Sequence[str] = ("yellow", "red"),
    block: Sequence[str] = BLOCK,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Fill the home columns where the home team, and the away columns where the away team, lacks a whole block."""
    fill = materialise(team_block_medians(df, measures, block, max_rows), "fill")
    for side in SIDES:
        columns = [f"{side}_{name}" for name in measures]
        df = _fill_from(df, fill.withColumnRenamed("team", f"{side}_team"), [*block, f"{side}_team"], columns)
    return df


def history_rows(
    df: DataFrame,
    row_key: Sequence[str],
    forward: Sequence[str] = ("yellow", "red", "elo"),
    backward: Sequence[str] = ("yellow", "red"),
    order: Sequence[str] = ("season_year", "match_round"),
    max_rows: int = MAX_GROUP_ROWS,
    counted_on: DataFrame | None = None,
    also: Sequence[str] = (),
    paired: bool = False,
) -> CleanedRows:
    """Participant rows with the gaps filled along each team's history.

    The forward fill runs over a team's contests on either side, across seasons and leagues. The backward fill
    runs per (league, team, side): along an order that starts with the season, the next value is one of the same
    season whenever there is one, so it is also the fill within the season followed by the one across seasons.

    ``counted_on`` names a cheaper frame with the same teams on which to look for oversized groups, ``also`` further measures.
    Everything happens on one row per participant, where partitioning by team serves both fills. With ``paired`` home rows carry their
    contest, unless a team is too large for one partition; such rows should be computed within ``session.co_partitioned``.
    """
    order = list(order)
    keep = list(dict.fromkeys([*row_key, "league", *order]))
    teams = to_participants(df if counted_on is None else counted_on, ["team"], ["league"])
    check = oversized_groups(teams, ["team"], max_rows) is not None
    paired = paired and not check and {"home_team", "away_team"} <= set(row_key)
    measures = [*forward, *also]
    replaced = {f"{side}_{name}" for side in SIDES for name in forward} | {f"home_{name}" for name in also}
    own = [name for name in df.columns if name not in keep and name not in replaced]
    rows = to_participants(df, ["team", *measures], keep, (own or row_key[:1]) if paired else ())
    if paired:
        rows = by_team(rows)
    total_order = [*order, "side_ord", *[key for key in row_key if key not in order]]
    ahead = {name: FillForward(name) for name in forward}
    behind = {name: FillBackward(name) for name in backward}
    filled = with_ordered(rows, ["team"], total_order, ahead, max_rows, teams, check)
    if backward:
        filled = with_ordered(filled, ["team", "league", "side"], total_order, behind, max_rows, teams, check)
    return CleanedRows(filled, df, row_key, forward, paired, check)


def _unordered(names: Sequence[str], order: Sequence[str] = (), **_) -> list[str]:
    """The names that a history is not ordered by: they need not be carried along it."""
    return [name for name in names if name not in order]


def fill_along_history(
    df: DataFrame, row_key: Sequence[str], drop: Sequence[str] = ("date", "referee"), **options
) -> DataFrame:
    """``df`` with the gaps filled by :func:`history_rows`; ``backward=()`` leaves out the backward fill."""
    return history_rows(df.drop(*_unordered(drop, **options)), row_key, **options).contests().drop(*drop)


def clean(
    df: DataFrame,
    row_key: Sequence[str],
    drop: Sequence[str] = ("date", "referee"),
    max_rows: int = MAX_GROUP_ROWS,
    **history,
) -> DataFrame:
    """The whole cascade; each step reads the values the step before has filled. ``paired`` is as in :func:`history_rows`."""
    return cleaned_rows(df, row_key, drop, max_rows, **history).contests().drop(*drop)


@dataclass(frozen=True)
class CleanedRows:
    """Participant rows of cleaned contests, and how they become contests again.

    ``filled`` has the contests that the rows were made of. ``large`` tells that a team has too many rows for one partition. ``paired`` rows
    are partitioned by team and carry their contest, see :func:`twosided.operators.sides.pair`.
    """

    rows: DataFrame
    filled: DataFrame
    row_key: Sequence[str]
    measures: Sequence[str]
    paired: bool
    large: bool

    def contests(self) -> DataFrame:
        """The filled contests with both sides' ``measures`` as in the rows."""
        if not self.paired:
            return attach(self.filled, to_contests(self.rows, self.row_key, self.measures), self.row_key)
        replaced = [f"{side}_{name}" for side in SIDES for name in self.measures]
        return pair(self.rows, self.row_key, self.measures, _key_first([c for c in self.filled.columns if c not in replaced], self.row_key))


def _key_first(columns: Sequence[str], row_key: Sequence[str]) -> list[str]:
    return [*row_key, *[name for name in columns if name not in row_key]]


def cleaned_rows(
    df: DataFrame,
    row_key: Sequence[str],
    drop: Sequence[str] = ("date", "referee"),
    max_rows: int = MAX_GROUP_ROWS,
    also: Sequence[str] = (),
    **history,
) -> CleanedRows:
    """The cascade of :func:`clean` up to participant rows, which have the measures ``also`` besides the filled ones.

    The rules for whole blocks touch different columns, so they are one step with one join. What else a contest has goes with its
    home row through the fills along histories.
    """
    rules = [BlockRule(CARDS, wholly=True), BlockRule(["capacity"], wholly=False), BlockRule(ELO, wholly=True)]
    fill = block_fills(df, rules, max_rows=max_rows)
    filled = _fill_from(flag_missing(df), fill, BLOCK, [*CARDS, "capacity", *ELO])
    filled = fill_team_block_median(filled.drop(*_unordered(drop, **history)), max_rows=max_rows)
    return history_rows(filled, row_key, max_rows=max_rows, counted_on=df, also=also, **history)
