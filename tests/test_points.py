import math
import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from termfit import (
    LogisticModel,
    all_features,
    axpy,
    confusion,
    grad_norm,
    gradient_weight,
    line_search,
    logistic_loss,
    margins,
    metrics,
    predict,
    total_gradient,
    total_loss,
    train_logistic,
)

GOLDEN = [(1, 1, {"a": 1.0, "b": 2.0}), (2, -1, {"a": -1.0}), (3, -1, {"b": 1.0, "c": 1.0})]


def pointed(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, y int, x map<string,double>")


def coefficients(spark, beta):
    return spark.createDataFrame(list(beta.items()), "feature string, coef double")


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}


def python_margin(x, beta):
    return sum(v * beta.get(f, 0.0) for f, v in x.items())


def python_loss(rows, beta, lam):
    return sum(math.log1p(math.exp(-y * python_margin(x, beta))) for _, y, x in rows) + lam * sum(
        c * c for c in beta.values()
    )


def python_gradient(rows, beta, lam):
    g = {f: 2 * lam * c for f, c in beta.items()}
    for _, y, x in rows:
        w = -y / (1 + math.exp(y * python_margin(x, beta)))
        for f, v in x.items():
            g[f] = g.get(f, 0.0) + w * v
    return g


def python_descent(rows, lam, steps):
    beta, history = {}, []
    for _ in range(steps):
        fx, g = python_loss(rows, beta, lam), python_gradient(rows, beta, lam)
        sq = sum(v * v for v in g.values())
        t, n = 1.0, 0
        while python_loss(rows, {f: beta.get(f, 0.0) - t * g[f] for f in g}, lam) > fx - 0.2 * t * sq:
            t, n = 0.6 * t, n + 1
        history.append((fx, math.sqrt(sq), n))
        beta = {f: beta.get(f, 0.0) - t * g[f] for f in g}
    return beta, history


def random_rows(seed=4, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = {f"f{j}": rng.gauss(0, 2) for j in rng.sample(range(12), rng.randrange(1, 5))}
        x["bias"] = 1.0
        rows.append((i, rng.choice([1, -1]), x))
    return rows + [(n, -1, {}), (n + 1, 1, {})]


def check_golden_training(spark):
    data = pointed(spark, GOLDEN)
    model = train_logistic(data, lam=0.5, max_iter=3, eps=1e-9, test=data)
    rows = model.history.orderBy("k").collect()
    assert [round(r["loss"], 6) for r in rows] == [2.079442, 1.663918, 1.628516]
    assert [round(r["grad_norm"], 6) for r in rows] == [1.224745, 0.392178, 0.132757]
    assert [r["gamma"] for r in rows] == pytest.approx([0.6, 0.6, 0.6])
    assert {f: round(c, 6) for f, c in as_dict(model.beta).items()} == {"a": 0.638056, "b": 0.162396, "c": -0.420079}
    last = rows[-1]
    assert (last["acc"], last["pre"], last["rec"]) == (1.0, 1.0, 1.0)
    assert (model.iterations, model.converged) == (3, False)
    assert model.grad_norm == pytest.approx(rows[-1]["grad_norm"])
    found = {r["row_id"]: (round(r["m"], 6), r["y_hat"]) for r in model.predict(data).collect()}
    assert found == {1: (0.962848, 1), 2: (-0.638056, -1), 3: (-0.257683, -1)}


def test_golden_training(spark):
    check_golden_training(spark)


def test_golden_training_without_broadcast(spark, shuffled_joins):
    check_golden_training(spark)


def check_random_training(spark):
    rows = random_rows()
    model = train_logistic(pointed(spark, rows), lam=0.3, max_iter=4, eps=1e-9)
    beta, history = python_descent(rows, 0.3, 4)
    found = [(r["loss"], r["grad_norm"], r["trials"]) for r in model.history.orderBy("k").collect()]
    assert found == [pytest.approx(step) for step in history]
    assert as_dict(model.beta) == pytest.approx(beta)
    losses = [step[0] for step in found]
    assert losses == sorted(losses, reverse=True)


def test_training_with_empty_rows(spark):
    check_random_training(spark)


def test_training_with_hot_features_without_broadcast(spark, shuffled_joins, monkeypatch):
    from termfit.plans import joins

    monkeypatch.setattr(joins, "SHARES", 20)
    check_random_training(spark)


def test_start_from_coefficients_outside_the_data(spark):
    rows = [(1, 1, {"a": 1.0}), (2, -1, {"a": 0.5})]
    beta0 = {"a": 0.5, "gone": 2.0}
    model = train_logistic(
        pointed(spark, rows), lam=0.1, max_iter=1, eps=1e-9, beta0=coefficients(spark, beta0)
    )
    row = model.history.first()
    assert row["loss"] == pytest.approx(python_loss(rows, beta0, 0.1))
    g = python_gradient(rows, beta0, 0.1)
    assert as_dict(model.beta) == pytest.approx({f: beta0[f] - row["gamma"] * g[f] for f in g})


def test_stopping(spark):
    data = pointed(spark, GOLDEN)
    none = train_logistic(data, max_iter=0)
    assert none.beta.count() == 0 and none.iterations == 0 and none.history.count() == 0
    assert train_logistic(data, eps=0.0).iterations == 0
    done = train_logistic(data, lam=0.5, eps=0.5)
    assert done.converged and done.iterations == 2


def test_single_steps_equal_python(spark):
    rows = random_rows(9)
    beta = {"bias": 0.4, "f1": -0.7, "f2": 0.1, "unseen": 3.0}
    data, b = pointed(spark, rows), coefficients(spark, beta)
    found = {r["row_id"]: r["m"] for r in margins(data, b).collect()}
    assert found == pytest.approx({i: python_margin(x, beta) for i, _, x in rows})
    assert total_loss(data, b, 0.7).first()[0] == pytest.approx(python_loss(rows, beta, 0.7))
    gradient = total_gradient(data, b, 0.7)
    g = python_gradient(rows, beta, 0.7)
    assert as_dict(gradient) == pytest.approx(g)
    assert grad_norm(gradient).first()[0] == pytest.approx(math.sqrt(sum(v * v for v in g.values())))
    for f in ("bias", "f1", "f3"):
        up, down = ({**beta, f: beta.get(f, 0.0) + h} for h in (1e-6, -1e-6))
        slope = (python_loss(rows, up, 0.7) - python_loss(rows, down, 0.7)) / 2e-6
        assert g[f] == pytest.approx(slope, rel=1e-4, abs=1e-4)


def test_line_search_takes_the_first_passing_step(spark):
    rows = random_rows(6)
    beta = {"bias": 0.2, "f1": 0.5}
    data, b = pointed(spark, rows), coefficients(spark, beta)
    fx, g = python_loss(rows, beta, 0.2), python_gradient(rows, beta, 0.2)
    sq = sum(v * v for v in g.values())
    for slope in (0.2, 0.45):
        found = line_search(data, b, total_gradient(data, b, 0.2), fx, sq, 0.2, a=slope)

        def after(t):
            return python_loss(rows, {f: beta.get(f, 0.0) - t * g[f] for f in g}, 0.2)

        assert after(found.t) <= fx - slope * found.t * sq
        assert found.n == 0 or after(found.t / 0.6) > fx - slope * found.t / 0.6 * sq
        assert found.t == pytest.approx(0.6**found.n)


def test_line_search_goes_on_past_one_batch(spark):
    data = pointed(spark, [(1, 1, {"a": 3000.0}), (2, -1, {"a": 2999.0})])
    b = coefficients(spark, {"a": 0.0})
    gradient = total_gradient(data, b)
    norm = grad_norm(gradient).first()[0]
    found = line_search(data, b, gradient, 2 * math.log(2), norm * norm)
    assert found.n >= 16 and found.batches == found.n // 16 + 1


def test_loss_does_not_overflow(spark):
    df = spark.createDataFrame([(-1000.0, 1), (1000.0, 1), (0.0, -1)], "m double, y int")
    rows = df.select(logistic_loss(), gradient_weight()).collect()
    assert [r[0] for r in rows] == pytest.approx([1000.0, 0.0, math.log(2)])
    assert [r[1] for r in rows] == pytest.approx([-1.0, 0.0, 0.5])


def test_vector_algebra(spark):
    a, b = coefficients(spark, {"x": 1.0, "y": 2.0}), coefficients(spark, {"y": 1.0, "z": 4.0})
    assert as_dict(axpy(a, -0.5, b)) == {"x": 1.0, "y": 1.5, "z": -2.0}
    assert as_dict(axpy(a, 1.0, coefficients(spark, {}))) == {"x": 1.0, "y": 2.0}


def test_features(spark):
    names = sorted(r["feature"] for r in all_features(pointed(spark, GOLDEN + [(4, 1, {})])).collect())
    assert names == ["a", "b", "c"]


def test_confusion_and_metrics(spark):
    data = pointed(spark, GOLDEN + [(4, 1, {}), (5, -1, {"a": 1.0})])
    beta = coefficients(spark, {"a": 1.0})
    assert confusion(data, beta).first().asDict() == {"p": 2, "n": 3, "tp": 1, "fp": 1, "tn": 2, "fn": 1}
    assert tuple(metrics(data, beta).first()) == (0.6, 0.5, 0.5)
    assert {r["row_id"]: r["y_hat"] for r in predict(data, beta).collect()} == {1: 1, 2: -1, 3: -1, 4: -1, 5: 1}


def test_metrics_without_positives_are_null(spark):
    data = pointed(spark, [(1, -1, {"a": 1.0})])
    assert tuple(metrics(data, coefficients(spark, {"a": -1.0})).first()) == (1.0, None, None)
    assert tuple(metrics(pointed(spark, []), coefficients(spark, {})).first()) == (None, None, None)


def test_optimum_agrees_with_mllib(spark):
    # without the constant feature, which the other solver pins to zero
    rows = [(i, y, {f: v for f, v in x.items() if f != "bias"}) for i, y, x in random_rows(8, 80) if x]
    lam = 4.0
    names = sorted({f for _, _, x in rows for f in x})
    model = train_logistic(pointed(spark, rows), lam=lam, max_iter=60, eps=0.02)
    assert model.converged
    vectors = spark.createDataFrame(
        [((y + 1) / 2, Vectors.dense([x.get(f, 0.0) for f in names])) for _, y, x in rows], ["label", "features"]
    )
    solver = LogisticRegression(
        regParam=2 * lam / len(rows), elasticNetParam=0.0, fitIntercept=False, standardization=False, tol=1e-10
    )
    optimum = dict(zip(names, solver.fit(vectors).coefficients))
    assert as_dict(model.beta) == pytest.approx(optimum, abs=0.02)


def test_saved_model(spark, tmp_path):
    model = train_logistic(pointed(spark, GOLDEN), lam=0.5, max_iter=2)
    model.save(str(tmp_path / "beta"))
    again = LogisticModel.load(spark, str(tmp_path / "beta"))
    assert as_dict(again.beta) == as_dict(model.beta)


def test_partitioning_does_not_matter(spark):
    rows = random_rows(5)
    a = train_logistic(pointed(spark, rows), lam=0.3, max_iter=2)
    b = train_logistic(pointed(spark, rows).repartition(7, F.col("y")), lam=0.3, max_iter=2, num_partitions=2)
    assert as_dict(a.beta) == pytest.approx(as_dict(b.beta))
