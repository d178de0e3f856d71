"""Regressions from moments against fits on the rows themselves."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaywright.learning import least_squares, search
from delaywright.operators import splitting

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    found = []
    for i in range(400):
        a, b = draw.gauss(1000, 2), draw.gauss(0, 1)
        found.append((i, f"2024-01-{1 + i // 20:02d}", a, b, a - 2 * b + draw.gauss(0, 3), 3 * a - b + draw.gauss(0, 5)))
    found += [(400, "2024-01-21", None, 1.0, 1.0, 1.0), (401, "2024-01-21", float("nan"), 1.0, 1.0, 1.0), (402, "2024-01-21", 1.0, 1.0, 1.0, None)]
    frame = spark.createDataFrame(found, "id bigint, day string, a double, b double, c double, y double")
    return frame.withColumn("day", F.to_date("day")).cache()


def arrays(rows):
    known = [r for r in rows.collect() if None not in (r["a"], r["y"]) and r["a"] == r["a"]]
    return np.array([[r[f] for f in FEATURES] for r in known]), np.array([r["y"] for r in known])


def refit(x, y, ridge=0.0):
    centred = x - x.mean(axis=0)
    weights = np.linalg.solve(centred.T @ centred / len(x) + ridge * np.eye(x.shape[1]), centred.T @ (y - y.mean()) / len(x))
    return weights, y.mean() - weights @ x.mean(axis=0)


@pytest.mark.parametrize("ridge", [0.0, 2.0])
def test_equals_a_fit_on_the_rows(rows, ridge):
    x, y = arrays(rows)
    model = least_squares.fit(least_squares.moments(rows, FEATURES, "y")[0], ridge)
    weights, intercept = refit(x, y, ridge)
    assert model.coefficients == pytest.approx(weights, abs=1e-6)
    assert model.intercept == pytest.approx(intercept, abs=1e-3)
    predicted = [r[0] for r in rows.dropna().filter("not isnan(a)").select(model.prediction(FEATURES)).collect()]
    error = float(np.mean((np.array(predicted) - y) ** 2))
    assert model.squared_error(least_squares.moments(rows, FEATURES, "y")[0]) == pytest.approx(error, rel=1e-6)


def test_elastic_net_meets_its_conditions(rows):
    data = least_squares.moments(rows, FEATURES, "y")[0]
    scaled = data.cross / data.n
    for l1, ridge in ((0.5, 0.0), (4.0, 1.0), (1e9, 0.0)):
        w = least_squares.fit(data, ridge, l1).coefficients
        slope = scaled[:-1, -1] - scaled[:-1, :-1] @ w - ridge * w
        for value, at in zip(w, slope, strict=True):
            assert (abs(at) <= l1 + 1e-6) if value == 0 else at == pytest.approx(l1 * np.sign(value), abs=1e-5)


def test_segments_add_up_and_constant_features_are_harmless(rows):
    parts = least_squares.moments(rows, FEATURES, "y", (F.col("id") / 90).cast("int"))
    whole, total = least_squares.moments(rows, FEATURES, "y")[0], least_squares.span(parts, 0, 9)
    assert total.n == whole.n and total.cross == pytest.approx(whole.cross, rel=1e-9) and total.mean == pytest.approx(whole.mean)
    flat = least_squares.fit(least_squares.moments(rows.withColumn("c", F.lit(7.0)), FEATURES, "y")[0])
    assert flat.coefficients[2] == pytest.approx(0, abs=1e-9)
    assert least_squares.moments(rows.filter("false"), FEATURES, "y") == {}


@pytest.mark.parametrize("make", [splitting.sliding_folds, splitting.expanding_folds])
def test_folds_equal_refitting_each(rows, make):
    known = rows.filter("id < 400")
    folds = make(400)
    found = search.moments_over_folds(known, "day", "id", folds, FEATURES, "y", [(0.0, 0.0), (2.0, 0.0)])
    got = {(r["fold"], r["ridge"], r["name"]): r["value"] for r in found.collect()}
    x, y = arrays(known)
    for fold in folds:
        train, test = slice(fold.train_start - 1, fold.train_end), slice(fold.test_start - 1, fold.test_end)
        for ridge in (0.0, 2.0):
            weights, intercept = refit(x[train], y[train], ridge)
            assert [got[fold.number, ridge, f] for f in FEATURES] == pytest.approx(weights, abs=1e-6)
            rmse = np.sqrt(np.mean((y[test] - x[test] @ weights - intercept) ** 2))
            assert got[fold.number, ridge, "rmse"] == pytest.approx(rmse, rel=1e-6)
