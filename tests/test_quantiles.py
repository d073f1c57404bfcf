"""Exact quantiles by histogram refinement against numpy."""

import random

import numpy as np
import pytest

from shelfcast.operators import quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]


def found(spark, rows, group=None):
    df = spark.createDataFrame(rows, "g string, v double")
    return {(r.g if group else None): (r.n, r.quantiles) for r in quantiles.exact_quantiles(df, "v", PROBS, group).collect()}


def wanted(values):
    return [float(np.quantile(values, p)) for p in PROBS]


@pytest.mark.parametrize("bins", [2, 1024])
def test_groups_of_all_kinds(spark, monkeypatch, bins):
    monkeypatch.setattr(quantiles, "BINS", bins)
    r = random.Random(bins)
    groups = {
        "one": [3.5], "two": [1.0, -1.0], "same": [7.0] * 50, "ties": [float(r.randint(0, 3)) for _ in range(200)],
        "wide": [10.0 ** r.randint(-12, 12) * r.choice((1, -1)) for _ in range(100)], "hot": [r.gauss(0, 1) for _ in range(2000)],
        None: [r.random() for _ in range(31)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("hot", None), ("hot", float("nan")), ("empty", None)]
    got = found(spark, rows, "g")
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g][0] == len(values)
        assert got[g][1] == pytest.approx(wanted(values), rel=1e-12, abs=1e-12)


def test_whole_table_and_empty_table(spark):
    values = [float(v * v % 101) for v in range(300)]
    assert found(spark, [("x", v) for v in values]) == {None: (300, pytest.approx(wanted(values)))}
    assert found(spark, []) == {} and found(spark, [("a", None)], "g") == {}
    assert quantiles.interpolated(sorted(values), 0.77) == pytest.approx(np.quantile(values, 0.77))
