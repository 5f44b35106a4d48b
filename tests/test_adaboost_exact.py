"""Stumps are the best of all cuts, on continuous features."""

import math

import numpy as np
import pytest
from test_models import frame

from tabloom.models.adaboost import AdaBoost, ordered_bits, value_of


def best_of_all_cuts(x, y, weights, classes):
    """The smallest weighted error over every feature and every cut between two values."""
    best = math.inf
    hot = np.eye(classes)[y] * weights[:, None]
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        ranked, below = x[order, f], hot[order].cumsum(axis=0)
        for i in np.flatnonzero(ranked[1:] > ranked[:-1]):
            best = min(best, 1 - (below[i].max() + (below[-1] - below[i]).max()) / weights.sum())
    return best


@pytest.mark.parametrize("classes,seed,bins", [(2, 1, 4), (3, 2, 4), (3, 3, 256), (5, 4, 16)])
def test_every_round_takes_the_best_cut(spark, classes, seed, bins):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, 700)
    x = np.column_stack([rng.normal(y, 1.5), rng.lognormal(0, 4, 700) * np.sign(rng.normal(size=700)), np.round(rng.normal(y, 2), 1)])
    model = AdaBoost(classes, 6, 0.9, bins=bins).fit(frame(spark, x, y).repartition(4))
    assert len(model.stumps) == 6
    weights = np.full(700, 1 / 700)
    for s in model.stumps:
        missed = np.where(x[:, s.feature] <= s.threshold, s.left, s.right) != y
        error = weights[missed].sum() / weights.sum()
        assert error == pytest.approx(best_of_all_cuts(x, y, weights, classes), abs=1e-9)
        assert s.weight == pytest.approx(0.9 * (math.log((1 - error) / error) + math.log(classes - 1)), abs=1e-6)
        weights = weights * np.exp(s.weight * missed)


def test_order_of_doubles():
    values = np.array([-np.inf, -1e300, -2.5, -1e-310, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, np.inf])
    bits = ordered_bits(values)
    assert (np.diff(bits) >= 0).all() and bits[4] == bits[5] == 0
    assert [value_of(int(b)) for b in bits] == values.tolist()
