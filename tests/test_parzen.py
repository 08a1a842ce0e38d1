"""Sequential proposals against a version that scores every combination of the drawn options by plain sums."""

import math
import random

import pytest

from twosided.ml import parzen
from twosided.ml.parzen import Trial


def plain_density(options, places):
    width = max(1.0, options / max(len(places), 1) / 2)
    found = []
    for i in range(options):
        total = 1 / options
        for p in places:
            total += math.exp(-((i - p) ** 2) / (2 * width * width)) / sum(math.exp(-((j - p) ** 2) / (2 * width * width)) for j in range(options))
        found.append(total / (len(places) + 1))
    return found


def plain_proposal(sizes, trials, rng):
    ranked = [t for _, t in sorted(enumerate(trials), key=lambda x: (-x[1].score, x[0]))]
    cut = -(-len(ranked) // 4)
    best, chosen = -math.inf, None
    draws = []
    for _ in range(24):
        places = []
        for p, n in enumerate(sizes):
            at, place = rng.random(), 0
            shares = plain_density(n, [t.places[p] for t in ranked[:cut]])
            while place < n - 1 and at >= sum(shares[: place + 1]):
                place += 1
            places.append(place)
        draws.append(tuple(places))
    fresh = [d for d in draws if d not in {t.places for t in trials}] or draws
    for d in fresh:
        value = sum(math.log(plain_density(n, [t.places[p] for t in ranked[:cut]])[i]) - math.log(plain_density(n, [t.places[p] for t in ranked[cut:]])[i])
                    for p, (n, i) in enumerate(zip(sizes, d)))
        if value > best + 1e-12:
            best, chosen = value, d
    return chosen


@pytest.mark.parametrize("seed", range(20))
def test_proposals_are_those_of_the_plain_version(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 12) for _ in range(rng.randint(1, 4))]
    trials = [Trial(tuple(rng.randrange(n) for n in sizes), rng.choice([0.1, 0.2, 0.5, rng.random()])) for _ in range(rng.randint(8, 30))]
    assert parzen.propose(sizes, trials, random.Random(seed)) == plain_proposal(sizes, trials, random.Random(seed))


def test_densities_are_shares():
    for options, places in ((1, []), (5, [0, 0, 4]), (16, list(range(16)))):
        shares = parzen.density(options, places)
        assert sum(shares) == pytest.approx(1) and min(shares) > 0


def test_a_search_nears_the_best_values_and_gives_values():
    values = {"trees": range(100, 501), "depth": range(5, 21), "kind": ["a", "b", "c"]}

    def score(x):
        return -abs(x["trees"] - 250) / 400 - abs(x["depth"] - 9) / 16 + 0.3 * (x["kind"] == "b")

    found = [max(s for _, s in parzen.search(values, score, 40, seed)) for seed in range(10)]
    blind = []
    for seed in range(10):
        rng = random.Random(seed)
        blind.append(max(score({n: rng.choice(list(o)) for n, o in values.items()}) for _ in range(40)))
    assert sum(found) > sum(blind)
    trials = parzen.search(values, score, 24, 1)
    assert trials == parzen.search(values, score, 24, 1) and len(trials) == 24
    assert all(t["trees"] in values["trees"] and t["kind"] in "abc" for t, _ in trials)
    with pytest.raises(ValueError):
        parzen.search({"x": []}, lambda _: 0.0)


def test_few_combinations_are_all_tried_before_one_is_repeated():
    trials = parzen.search({"a": [1, 2, 3], "b": [1, 2]}, lambda x: x["a"] - x["b"], 6, 3)
    assert len({tuple(t.items()) for t, _ in trials}) >= 5
