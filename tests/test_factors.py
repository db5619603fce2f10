"""Biased factorisation by strata against a plain NumPy descent in the same order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.catalog import texts
from weirflow.operators import factors

SETTINGS = {"rank": 4, "epochs": 3, "rate": 0.01, "penalty": 0.05, "seed": 7}


def plain_descent(rows, blocks, of_block):
    """The same model without Spark: {(kind, id): (bias, factors)} and the mean."""
    mean = sum(r for _, _, r in rows) / len(rows)
    bias = {(k, i): 0.0 for u, p, _ in rows for k, i in ((0, u), (1, p))}
    vector = {key: factors.start_row(SETTINGS["seed"], *key, SETTINGS["rank"]) for key in bias}
    rate, penalty = SETTINGS["rate"], SETTINGS["penalty"]
    for step in range(SETTINGS["epochs"] * blocks):
        now = [x for x in rows if of_block[x[1]] == (of_block[x[0]] + step) % blocks]
        for u, p, r in sorted(now, key=lambda x: (x[1], x[0])):
            a, b = (0, u), (1, p)
            error = r - (mean + bias[a] + bias[b] + vector[a] @ vector[b])
            bias[a] += rate * (error - penalty * bias[a])
            bias[b] += rate * (error - penalty * bias[b])
            vector[a], vector[b] = (vector[a] + rate * (error * vector[b] - penalty * vector[a]),
                                    vector[b] + rate * (error * vector[a] - penalty * vector[b]))
    return {k: (bias[k], vector[k]) for k in bias}, mean


@pytest.fixture(scope="module")
def dealt(spark):
    rows = texts.ratings(spark, "/root/testdata/sf0.001").filter("user_id % 3 = 0").withColumn(
        "fold", factors.hashed_fold(F.col("user_id"), F.col("product_id"), 3))
    return spark.createDataFrame(rows.collect(), rows.schema)


@pytest.mark.parametrize("blocks", [2, 3])
def test_strata_equal_a_plain_descent(spark, dealt, blocks):
    model, means = factors.fit_folds(dealt, 3, blocks=blocks, **SETTINGS)
    rows = [(r.user_id, r.product_id, r.rating, r.fold) for r in dealt.collect()]
    of_block = factors.by_blocks(sorted({k for r in rows for k in r[:2]}), blocks, spark)
    got = {(r.fold, r.kind, r.id): (r.bias, r.factors) for r in model.collect()}
    n = 0
    for fold in range(3):
        want, mean = plain_descent([r[:3] for r in rows if r[3] != fold], blocks, of_block)
        assert means[fold] == pytest.approx(mean, abs=1e-9)
        for (kind, key), (bias, vector) in want.items():
            b, v = got[fold, kind, key]
            assert abs(b - bias) < 1e-6 and np.abs(np.array(v) - vector).max() < 1e-6
            n += 1
    assert n == len(got) and any(abs(b) > 1e-3 for b, _ in got.values())


def test_what_lies_between_strata_is_a_row_a_slab(spark, dealt, monkeypatch):
    rows, write = [], factors.written

    def counted(df, folder):
        out = write(df, folder)
        if "/state-" in folder:
            rows.append(out.count())
        return out

    monkeypatch.setattr(factors, "written", counted)
    model = lambda: {(r.fold, r.kind, r.id): (r.bias, r.factors) for r in factors.fit_folds(dealt, 3, blocks=2, **SETTINGS)[0].collect()}
    whole = model()
    assert rows == [3 * 2 * 2] * (2 * SETTINGS["epochs"] + 1)  # a row for each fold, kind and block, however many ids
    monkeypatch.setattr(factors, "SLAB", 64)
    cut = model()
    assert cut == whole and rows[-1] > len(whole) / 3


def test_every_rating_is_predicted_and_unknown_ones_by_the_mean(spark):
    rows = [(u, p, float(u % 5 + 1), (u + p) % 3) for u in range(30) for p in range(20)] + [(99, 5, 2.0, 1), (3, 88, 4.0, 2), (98, 87, 1.0, 0)]
    ratings = spark.createDataFrame(rows, "user_id long, product_id long, rating double, fold int")
    model, means = factors.fit_folds(ratings, 3, rank=2, epochs=30, rate=0.02, blocks=2)
    got = {(r.user_id, r.product_id): r for r in factors.predict(ratings, model, means).collect()}
    assert len(got) == len(rows)
    assert got[98, 87].prediction == pytest.approx(means[0])
    error = lambda f: np.sqrt(np.mean([f(r) ** 2 for r in got.values() if r.user_id < 30 and r.product_id < 20]))
    assert error(lambda r: r.prediction - r.rating) < 0.3 * error(lambda r: means[r.fold] - r.rating)


def test_no_ratings(spark):
    empty = spark.createDataFrame([], "user_id long, product_id long, rating double, fold int")
    model, means = factors.fit_folds(empty, 3, rank=2, epochs=1)
    assert model.count() == 0 and means == {} and factors.predict(empty, model, means).count() == 0


def test_blocks_follow_the_ratings_and_the_hottest_key(spark):
    ratings = spark.range(1000).selectExpr("id AS user_id", "IF(id < 400, 0, id) AS product_id", "1.0 AS rating")
    assert factors.blocks_for(ratings, 1000) == 2
    assert factors.blocks_for(ratings, 10) == 40


@pytest.mark.parametrize("n_users, n_items", [(400, 300), (1, 50), (40, 2)])
def test_ratings_taken_together_equal_one_after_the_other(n_users, n_items, monkeypatch):
    draw = np.random.default_rng(3)
    pairs = np.unique(np.stack([draw.integers(0, n_users, 900), draw.integers(0, n_items, 900)], 1), axis=0)
    users, items, ratings = pairs[:, 0], pairs[:, 1], draw.uniform(1, 5, len(pairs))
    level = factors.waits(users, items)
    for k in range(level.max() + 1):
        at = level == k
        assert len(set(users[at])) == len(set(items[at])) == at.sum()
    if n_users == 400:
        assert level.max() < 60  # ratings share few users and items: far fewer steps than ratings

    def run(together):
        monkeypatch.setattr(factors, "TOGETHER", together)
        rows = np.random.default_rng(5).normal(0, 0.1, (n_users, 4)), np.random.default_rng(6).normal(0, 0.1, (n_items, 4))
        biases = np.zeros(n_users), np.zeros(n_items)
        factors.descend(users, items, ratings, 3.0, biases, rows, 0.05, 0.02)
        return np.concatenate([x.ravel() for x in (*biases, *rows)])

    assert np.abs(run(1) - run(10**9)).max() < 1e-9
