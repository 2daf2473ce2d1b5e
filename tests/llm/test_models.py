"""The two fitted models against plain loops: expectation-maximisation, and Viterbi against all paths of a lattice."""

import itertools
import math
import random

import numpy as np
import pytest

from sensorwarden.llm import quality, toxicity

SIDES = (0, 1)


def brute_em(patterns, counts, rounds):
    """Posterior of good per pattern, one document group at a time."""
    k = len(quality.HEURISTICS)
    ballots = [[p // 3 ** (k - 1 - i) % 3 for i in range(k)] for p in patterns]
    good = []
    for ballot in ballots:
        balance = sum(v == quality.GOOD for v in ballot) - 3 * sum(v == quality.BAD for v in ballot)
        good.append(1 / (1 + math.exp(-balance)))
    for _ in range(rounds):
        chance = {}
        for side in SIDES:
            for i in range(k):
                seen = [1.0] * 3
                for ballot, n, g in zip(ballots, counts, good):
                    seen[ballot[i]] += n * (g if side else 1 - g)
                chance[side, i] = [s / sum(seen) for s in seen]
        prior = min(max(sum(n * g for n, g in zip(counts, good)) / sum(counts), 1e-3), 1 - 1e-3)
        for j, ballot in enumerate(ballots):
            odds = math.log(prior / (1 - prior))
            for i, vote in enumerate(ballot):
                if vote != quality.NONE:
                    odds += math.log(chance[1, i][vote] / chance[0, i][vote])
            good[j] = 1 / (1 + math.exp(-min(max(odds, -30), 30)))
    return good


@pytest.mark.parametrize("seed", range(4))
def test_expectation_maximisation(seed):
    rng = random.Random(seed)
    patterns = rng.sample(range(3 ** len(quality.HEURISTICS)), 12)
    counts = [rng.choice([1, 5, 1000, 40_000]) for _ in patterns]
    found, _ = quality.fit_votes(np.array(patterns), np.array(counts), rounds=7)
    assert np.allclose([found[p] for p in patterns], brute_em(patterns, counts, 7), atol=1e-9)


def path_cost(costs, path):
    """Channel and language cost of one path through a lattice."""
    a, b, total = toxicity.SPACE, toxicity.SPACE, 0.0
    for char, price in path:
        total += price
        if char:
            c = toxicity._symbol(char)
            total += costs[a][b][c]
            a, b = b, c
    return total + costs[a][b][toxicity.SPACE]


@pytest.mark.parametrize("seed", range(3))
def test_viterbi_finds_the_cheapest_path(seed):
    rng = random.Random(seed)
    costs = -np.log(np.random.default_rng(seed).dirichlet(np.full(toxicity.SYMBOLS, 0.3), (toxicity.SYMBOLS,) * 2) + 1e-9)
    restorer = toxicity.Restorer(costs)
    for _ in range(120):
        token = "".join(rng.choices("abst13!|$4.-5 é", k=rng.randint(1, 5))).strip()
        for doubled in (True, False):
            lattice = restorer.lattice(token, doubled)
            if math.prod(len(options) for options in lattice) > 20_000:
                continue
            best = min((path_cost(costs, path) for path in itertools.product(*lattice)), default=path_cost(costs, ()))
            got = restorer.restore(token, doubled)
            costs_of_got = [
                path_cost(costs, path) for path in itertools.product(*lattice) if "".join(c for c, _ in path) == got
            ]
            assert min(costs_of_got, default=path_cost(costs, ())) == pytest.approx(best)
