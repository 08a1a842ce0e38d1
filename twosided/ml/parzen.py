"""Sequential parameter search: each trial is proposed from the densities of good and of bad earlier trials.

Options of a parameter are ordered, so a trial speaks for its neighbours as well. The best quarter of the trials gives one density
per parameter, the others another one. Candidates are drawn from the first, and that with the greatest ratio of the two is tried next. The
proposals need the scores only, so they are made on the driver; every trial is a distributed fit.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from twosided.ml.search import evaluate_params, search_report

#: Trials drawn at random before the first proposal, the share of trials that count as good, and candidates of a proposal.
STARTUP, GOOD, CANDIDATES = 8, 0.25, 24


@dataclass(frozen=True)
class Trial:
    """The places of the options that were tried, by parameter, and the score, of which more is better."""

    places: tuple[int, ...]
    score: float


def density(options: int, places: Sequence[int]) -> list[float]:
    """The share of each option: a uniform part as large as one trial, and for each trial a bell around its place.

    A bell's width is the number of options divided by the number of trials, but at least one; what it loses beyond the ends is
    spread over the options that are left, so that every trial counts the same.
    """
    width = max(1.0, options / max(len(places), 1) / 2)
    shares = [1 / options] * options
    for place in places:
        bell = [math.exp(-0.5 * ((i - place) / width) ** 2) for i in range(options)]
        shares = [s + b / sum(bell) for s, b in zip(shares, bell, strict=True)]
    return [s / (len(places) + 1) for s in shares]


def _drawn(shares: Sequence[float], at: float) -> int:
    for place, share in enumerate(shares):
        at -= share
        if at < 0:
            return place
    return len(shares) - 1


def propose(sizes: Sequence[int], trials: Sequence[Trial], rng: random.Random) -> tuple[int, ...]:
    """The places to try next, of parameters with so many options each.

    Candidates that were tried before give way to others; if all were, the best of them is tried again.
    """
    if len(trials) < STARTUP:
        tried = {t.places for t in trials}
        drawn = [tuple(rng.randrange(n) for n in sizes) for _ in range(CANDIDATES)]
        return next((x for x in drawn if x not in tried), drawn[0])
    order = sorted(trials, key=lambda t: -t.score)  # of equal scores the earlier trial is better
    count = math.ceil(GOOD * len(order))
    good, bad = ([density(n, [t.places[p] for t in part]) for p, n in enumerate(sizes)] for part in (order[:count], order[count:]))
    drawn = [tuple(_drawn(shares, rng.random()) for shares in good) for _ in range(CANDIDATES)]
    ratio = {x: sum(math.log(good[p][i] / bad[p][i]) for p, i in enumerate(x)) for x in drawn}
    tried = {t.places for t in trials}
    return max([x for x in drawn if x not in tried] or drawn, key=ratio.__getitem__)


def search(values: Mapping[str, Sequence], score: Callable[[dict], float], trials: int = 24, seed: int = 42) -> list[tuple[dict, float]]:
    """``(values by name, score)`` of so many trials, in the order in which they were made; values, not places, are scored."""
    names, options = list(values), [list(x) for x in values.values()]
    if not all(options):
        raise ValueError("a parameter without options")
    rng, done, found = random.Random(seed), [], []
    for _ in range(trials):
        places = propose([len(x) for x in options], done, rng)
        chosen = {name: x[i] for name, x, i in zip(names, options, places, strict=True)}
        done.append(Trial(places, score(chosen)))
        found.append((chosen, done[-1].score))
    return found


def sequential_search(classifier, values: Mapping[str, Sequence], train: DataFrame, valid: DataFrame, trials: int = 24, seed: int = 42) -> DataFrame:
    """One row per trial as :func:`search.search_report` gives it; every trial is fitted on ``train`` and scored on both frames."""
    grid, scores = [], []

    def score(chosen: dict) -> float:
        grid.append({classifier.getParam(name): value for name, value in chosen.items()})
        scores.extend(evaluate_params(classifier, grid[-1:], train, valid))
        return scores[-1][1]

    search(values, score, trials, seed)
    return search_report(grid, scores)
