"""Runs that end early and go on from their saved generations."""

import pytest
from pyspark.sql import functions as F

from termfit import cross_validate, factorize, train_logistic
from termfit.plans import joins
from termfit.session import Generations


def generations(folder):
    return sorted(p.name for p in folder.iterdir())


def without_time(history):
    return [tuple(v for n, v in r.asDict().items() if n != "time_s") for r in history.orderBy(history.columns[0]).collect()]


def test_generations(spark, tmp_path):
    folder = tmp_path / "state"
    saved = Generations(spark, str(folder), {"d": 2, "models": [0, 1]})
    assert saved.newest() is None
    for k in range(1, 5):
        table = saved.save(k, spark.range(k), {"k": k, "change": float("nan")})
        assert table.count() == k
    assert generations(folder) == ["generation-00000003", "generation-00000004"]
    (folder / "generation-00000004" / "record.json").unlink()  # as if the run had ended while it wrote
    table, values = Generations(spark, str(folder), {"d": 2, "models": [0, 1]}).newest()
    assert table.count() == values["k"] == 3
    with pytest.raises(ValueError, match="other settings"):
        Generations(spark, str(folder), {"d": 3, "models": [0, 1]}).newest()


@pytest.mark.parametrize("large", [False, True])
def test_factorization_goes_on(spark, tmp_path, monkeypatch, large):
    if large:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    ratings = spark.range(60).selectExpr("id % 7 AS user_id", "id % 5 AS item_id", "double(id % 4) AS rating")
    options = dict(d=2, gain=0.01, seed=5)
    whole = factorize(ratings, maxiter=5, **options)
    folder = tmp_path / "state"
    factorize(ratings, maxiter=3, state=str(folder), **options)
    assert generations(folder) == ["generation-00000002", "generation-00000003"]
    again = factorize(ratings, maxiter=5, state=str(folder), **options)
    assert [r[0] for r in without_time(again.history)] == [1, 2, 3, 4, 5]
    for found, wanted in zip(without_time(again.history), without_time(whole.history), strict=True):
        assert found == pytest.approx(wanted)
    profiles = [{r["id"]: r["factors"] for r in model.users.collect()} for model in (again, whole)]
    assert profiles[0].keys() == profiles[1].keys() and all(profiles[0][i] == pytest.approx(profiles[1][i]) for i in profiles[0])
    with pytest.raises(ValueError):
        factorize(ratings, maxiter=5, state=str(folder), **{**options, "gain": 0.02})


def test_cross_validation_goes_on(spark, tmp_path):
    folded = spark.range(60).selectExpr("id % 7 AS user_id", "id % 5 AS item_id", "double(id % 4) AS rating", "int(id % 3) AS fold")
    whole = cross_validate(folded, 3, d=2, maxiter=4, seed=1).collect()
    cross_validate(folded, 3, d=2, maxiter=2, seed=1, state=str(tmp_path / "cv"))
    again = cross_validate(folded, 3, d=2, maxiter=4, seed=1, state=str(tmp_path / "cv")).collect()
    assert [tuple(r) for r in again] == [pytest.approx(tuple(r)) for r in whole]


@pytest.mark.parametrize("large", [False, True])
def test_logistic_training_goes_on(spark, tmp_path, monkeypatch, large):
    if large:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    points = spark.range(80).select(
        F.col("id").alias("row_id"), F.expr("int(IF(id % 3 = 0, 1, -1))").alias("y"), F.expr("map('a', double(id % 5), concat('f', id % 4), 1D)").alias("x")
    )
    whole = train_logistic(points, lam=0.3, max_iter=5, eps=1e-9, test=points)
    folder = tmp_path / "state"
    train_logistic(points, lam=0.3, max_iter=3, eps=1e-9, test=points, state=str(folder))
    again = train_logistic(points, lam=0.3, max_iter=5, eps=1e-9, test=points, state=str(folder))
    assert generations(folder) == ["generation-00000004", "generation-00000005"]
    for found, wanted in zip(without_time(again.history), without_time(whole.history), strict=True):
        assert found == pytest.approx(wanted)
    assert dict(again.beta.collect()) == pytest.approx(dict(whole.beta.collect()))
