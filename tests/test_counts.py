"""What the training loops count, and what they refuse."""

import pytest
from pyspark.sql import functions as F

from termfit import cross_validate, cross_validation_error, factorize, rmse
from termfit.plans.factorize import FactorModel

RATINGS = [(u, 10 + i, float((u * i) % 5 + 1), (u + i) % 3) for u in range(6) for i in range(5)]


def rated(spark, rows=RATINGS):
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double, fold int")


@pytest.mark.parametrize("fold", [3, -1, None])
def test_rows_outside_the_folds_are_an_error(spark, fold):
    with pytest.raises(ValueError, match="1 rows have no fold"):
        cross_validate(rated(spark, [*RATINGS, (1, 11, 2.0, fold)]), 3, d=2, maxiter=1)


def test_error_of_a_cross_validation(spark):
    folds = cross_validate(rated(spark), 3, d=2, maxiter=1)
    wanted = [r.rmse for r in folds.collect()]
    found = cross_validation_error(folds).first()
    assert found.folds == 3 and found.rmse == pytest.approx(sum(wanted) / 3)


def test_scored_rows_of_a_warm_start(spark):
    rows = rated(spark, [*RATINGS, (None, 11, 2.0, 0), (1, 11, None, 0)])
    start = factorize(rated(spark), d=2, maxiter=1)
    partial = FactorModel(start.users.where("id <> 2"), start.items, start.history)
    last = factorize(rows, d=2, maxiter=1, initial=partial).history.first()
    known = rmse(rows.select("user_id", "item_id", "rating"), partial.users, partial.items).first()
    assert last.n_scored == 25 and last.rmse_scored == pytest.approx(
        (last.rmse**2 * last.n / last.n_scored) ** 0.5
    )
    assert known.n_scored == last.n_scored
    assert start.users.where(F.col("id") == 2).count() == 1
