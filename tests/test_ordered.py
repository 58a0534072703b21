"""Running sums and quantiles over ranges of keys."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import catalogue
from tessera.functions import metrics as M
from tessera.operators import ordered as O

SF = "/root/testdata/sf0.001"


def test_keys_sort_as_numbers_do(spark):
    values = [-math.inf, -1e300, -2.5, -1e-310, -0.0, 0.0, 5e-324, 1.0, 1e300, math.inf, math.nan, None]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "i int, v double")
    keys = [r[0] for r in rows.sort("i").select(O.order_key(F.col("v"))).collect()]
    assert keys[-1] is None and keys[4] == keys[5]
    assert keys[:4] + keys[5:-1] == sorted(set(keys[:-1]))


def groups(seed=1):
    draw = random.Random(seed)
    close = [1 + k * 2.0**-50 for k in range(400)]
    for g in ("a", "b", None):
        for _ in range(500):
            yield g, draw.choice([draw.random(), draw.gauss(0, 1e9), float(draw.randrange(4)), draw.choice(close), None])


@pytest.mark.parametrize("most", [1, 20, 1 << 17])
def test_quantiles_in_ranges_of_any_size(spark, most):
    rows = list(groups())
    out = O.quantiles(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", {"low": 0.0, "q": 0.25, "m": 0.5, "r": 0.9, "top": 1.0}, most).collect()
    assert len(out) == 3
    for r in out:
        own = [x for g, x in rows if g == r.g and x is not None]
        assert r.n == len(own)
        assert np.allclose([r.low, r.q, r.m, r.r, r.top], np.quantile(own, [0, 0.25, 0.5, 0.9, 1]), rtol=1e-12)
    assert O.quantiles(spark.createDataFrame([], "g string, x double"), ["g"], "x", {"m": 0.5}).collect() == []


@pytest.mark.parametrize("most", [1, 20, 1 << 17])
def test_running_sums(spark, most):
    keys = sorted({(g, x) for g, x in groups(2) if x is not None}, key=str)
    rows = spark.createDataFrame([(g, x, k) for k, (g, x) in enumerate(keys)], "g string, x double, w long").withColumn("key", O.order_key(F.col("x")))
    for r in O.running_sums(rows, ["g"], "key", ["w"], most).collect():
        own = [(x, k) for k, (g, x) in enumerate(keys) if g == r.g]
        assert r.w_below == sum(k for x, k in own if x < r.x) and r.w_all == sum(k for _, k in own)


def test_rank_metrics_of_continuous_scores(spark, monkeypatch):
    monkeypatch.setattr(O, "MOST", 50)
    draw = np.random.default_rng(3)
    y, s = draw.integers(0, 2, 2000), draw.normal(size=2000)
    s = s + 0.5 * y
    rows = spark.createDataFrame([(int(a), float(b), None) for a, b in zip(y, s)], "y int, s double, g string")
    pairs = (s[y == 1][:, None] > s[y == 0][None]).mean()
    assert math.isclose(M.auroc(rows, "y", "s", ["g"]).first().auroc, pairs, rel_tol=1e-12)
    best = M.tuned_threshold(rows, "y", "s", ["g"]).first()

    def macro(t):
        p = s >= t
        f = lambda a, b: 2 * (a & b).sum() / (a.sum() + b.sum())
        return (f(p, y == 1) + f(~p, y == 0)) / 2

    assert math.isclose(best.macro_f1, max(macro(t) for t in s), rel_tol=1e-12)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["quantile_thresholds", "median_labels", "degree_summary", "roc_areas", "tuned_thresholds"])
def test_no_task_holds_a_group(spark, name):
    """No buffer of a group's values, and every window over rows lies within a range."""
    text = plan(catalogue.QUERIES[name](spark, SF))
    assert "percentile" not in text and "median(" not in text
    for window in re.findall(r"Window \[.*", text):
        if "windowspecdefinition" in window and "unboundedpreceding$(), -1" in window and "range" not in window:
            raise AssertionError(window)
