"""Models against their defining equations on small tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from edgelog.operators import recommend as R


def _points(spark, rows):
    return spark.createDataFrame(rows, "label double, f array<double>").select("label", array_to_vector("f").alias("features"))


@pytest.fixture(scope="module")
def cloud():
    """Points of two classes that overlap."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(scale=1.5, size=300) > 0.3).astype(float)
    return x, y


def test_factors_solve_their_normal_equations(spark):
    """Each user's factors are the ridge solution for the items rated; the items returned are the best by brute force."""
    rng, reg = np.random.default_rng(1), 0.05
    rated = [(u, i, float(rng.uniform(1, 5))) for u in range(12) for i in range(8) if rng.random() < 0.6 or i == u % 8]
    ratings = spark.createDataFrame(rated, "user int, item int, rating float")
    model = R.als_model(ratings, rank=3, iterations=6, reg=reg)
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    for user, factors in users.items():
        own = [(i, r) for u, i, r in rated if u == user]
        v, r = np.array([items[i] for i, _ in own]), np.array([r for _, r in own])
        want = np.linalg.solve(v.T @ v + reg * len(own) * np.eye(3), v.T @ r)
        assert np.allclose(factors, want, atol=1e-3)
    named = spark.createDataFrame([(3,), (7,), (99,)], "user int")
    got = R.als_items(model, named, 4).collect()
    for user in (3, 7):
        best = sorted(((float(users[user] @ v), i) for i, v in items.items()), reverse=True)[:4]
        mine = sorted(((r.score, r.item) for r in got if r.user == user), reverse=True)
        assert [i for _, i in mine] == [i for _, i in best]
        assert np.allclose([s for s, _ in mine], [s for s, _ in best], atol=1e-4)
    assert not [r for r in got if r.user == 99]
    error = R.als_error(model, ratings).first()
    gap = [(r - float(users[u] @ items[i])) ** 2 for u, i, r in rated]
    assert error.n == len(rated) and np.isclose(error.model_error, np.mean(gap), atol=1e-4)
    assert np.isclose(error.mean_error, np.var([r for *_, r in rated]), atol=1e-4)


def test_logistic_gradient_is_zero(spark, cloud):
    x, y = cloud
    points = _points(spark, [(float(b), a.tolist()) for a, b in zip(x, y)])
    model = R.logistic_regression(points, iterations=200, tol=1e-12)
    p = 1 / (1 + np.exp(-(x @ np.array(model.coefficients) + model.intercept)))
    assert np.abs(x.T @ (p - y) / len(y)).max() < 1e-5 and abs((p - y).mean()) < 1e-5
    told = [r.prediction for r in model.transform(points).collect()]
    assert told == (p > 0.5).astype(float).tolist()


def test_hinge_loss_cannot_be_lowered(spark, cloud):
    """Of many near and far separators none has a lower regularised hinge loss."""
    x, y = cloud
    reg = 0.1
    points = _points(spark, [(float(b), a.tolist()) for a, b in zip(x, y)])
    model = R.linear_svc(points, iterations=200, reg=reg)
    scale = x.std(axis=0, ddof=1)  # the penalty is on coefficients of scaled features
    sign = 2 * y - 1

    def loss(w, b):
        return np.maximum(0, 1 - sign * (x @ w + b)).mean() + reg / 2 * ((w * scale) ** 2).sum()

    w, b = np.array(model.coefficients), model.intercept
    rng = np.random.default_rng(9)
    least = loss(w, b)
    for spread in (0.001, 0.01, 0.1, 1.0):
        for _ in range(200):
            assert loss(w + rng.normal(scale=spread, size=3), b + rng.normal(scale=spread)) > least - 2e-4
    told = [r.prediction for r in model.transform(points).collect()]
    assert told == (x @ w + b > 0).astype(float).tolist()


def test_named_users_of_a_parameter(spark, sf):
    from catalog import queries

    got = queries.als_top(spark, sf, users=(4, 6), n=2).groupBy("user").agg(F.count("*").alias("n")).collect()
    assert sorted(map(tuple, got)) == [(4, 2), (6, 2)]


def test_distinct_points_stand_for_all_rows(spark):
    """Repeated points are one row with their number, and the majority of each kind is what the model learns."""
    points = _points(spark, [(float(i % 10 < (2 if i % 20 < 10 else 7)), [float(i % 20 < 10)]) for i in range(400)])
    few = R.distinct_points(points)
    assert few.count() == 4 and few.agg(F.sum("weight")).first()[0] == 400
    told = R.linear_svc(few, iterations=20, weight="weight").transform(few).select("features", "prediction").distinct()
    assert {(r.features[0], r.prediction) for r in told.collect()} == {(1.0, 0.0), (0.0, 1.0)}
