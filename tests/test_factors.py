import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from termfit import (
    FactorModel,
    cross_validate,
    entity_ids,
    factorize,
    fit_and_save,
    gain_schedule,
    init_profiles,
    objective,
    profile_penalty,
    residuals,
    rmse,
    squared_error,
    step_items,
    step_users,
)
from termfit.operators.factors import step_models

TRAIN = [(1, 10, 5.0), (1, 20, 3.0), (2, 10, 4.0)]
TEST = [(2, 20, 1.0), (3, 10, 2.0)]
USERS = {1: [1.0, 0.0], 2: [0.5, 0.5]}
ITEMS = {10: [1.0, 1.0], 20: [0.0, 2.0]}
GOLDEN = dict(d=2, lam=1.0, mu=1.0, gain=0.1, power=0.2)


def rated(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")


def profiles(spark, vectors):
    return spark.createDataFrame(list(vectors.items()), "id bigint, factors array<double>")


def vectors(df):
    return {row["id"]: list(row["factors"]) for row in df.collect()}


def start(spark):
    return FactorModel(profiles(spark, USERS), profiles(spark, ITEMS))


def reference_run(ratings, users, items, gain, power, lam, mu, steps):
    """The same descent over plain arrays, rating by rating."""
    users = {i: np.array(v) for i, v in users.items()}
    items = {j: np.array(v) for j, v in items.items()}
    history = []
    for step in range(1, steps + 1):
        gu, gv = defaultdict(float), defaultdict(float)
        error = 0.0
        for i, j, r in ratings:
            delta = float(users[i] @ items[j]) - r
            error += delta**2
            gu[i] = gu[i] + 2 * delta * items[j]
            gv[j] = gv[j] + 2 * delta * users[i]
        penalty = lam * sum(u @ u for u in users.values()) + mu * sum(v @ v for v in items.values())
        history.append((error + penalty, math.sqrt(error / len(ratings))))
        gamma = gain / step**power
        users = {i: u - gamma * (gu[i] + 2 * lam * u) for i, u in users.items() if i in gu}
        items = {j: v - gamma * (gv[j] + 2 * mu * v) for j, v in items.items() if j in gv}
    return users, items, history


def test_golden_steps(spark):
    train, users, items = rated(spark, TRAIN), profiles(spark, USERS), profiles(spark, ITEMS)
    for d in (2, None):
        res = residuals(train, users, items, d)
        deltas = {(r["user_id"], r["item_id"]): r["delta"] for r in res.collect()}
        assert deltas == {(1, 10): -4.0, (1, 20): -3.0, (2, 10): -3.0}
        assert squared_error(res).first()[0] == 34.0
        assert profile_penalty(users, 2.0, d).first()[0] == 3.0
        assert objective(res, users, items, 1.0, 1.0, d).first()[0] == 41.5
    assert vectors(step_users(res, 0.1, 1.0, 2)) == {1: pytest.approx([1.6, 2.0]), 2: pytest.approx([1.0, 1.0])}
    assert vectors(step_items(res, 0.1, 1.0, 2)) == {10: pytest.approx([1.9, 1.1]), 20: pytest.approx([0.6, 1.6])}


@pytest.mark.parametrize("without_broadcast", [False, True])
def test_long_vectors_with_held_out_rows(spark, monkeypatch, without_broadcast):
    """Factors beyond the unroll limit: the golden run padded with zeros."""
    from termfit.plans import joins

    if without_broadcast:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    padded = FactorModel(
        *[profiles(spark, {i: v + [0.0] * 43 for i, v in table.items()}) for table in (USERS, ITEMS)]
    )
    model = factorize(
        rated(spark, TRAIN), rated(spark, TEST), maxiter=2, initial=padded, **{**GOLDEN, "d": 45}
    )
    second = model.history.orderBy("iter").collect()[1]
    assert second["objective"] == pytest.approx(18.7032)
    assert second["rmse_scored"] == pytest.approx(1.2) and second["n_scored"] == 1
    assert sorted(vectors(model.users)) == [1, 2]
    assert vectors(model.users)[1] == pytest.approx([1.120849, 1.282666] + [0.0] * 43, abs=1e-6)


def check_golden_run(spark):
    model = factorize(
        rated(spark, TRAIN), rated(spark, TEST), maxiter=2, initial=start(spark), **GOLDEN
    )
    first, second = model.history.orderBy("iter").collect()
    assert first["objective"] == pytest.approx(41.5) and first["rmse"] == first["rmse_scored"] == 0.0
    assert second["objective"] == pytest.approx(18.7032)
    assert second["rmse"] == pytest.approx(0.848528, abs=1e-6)
    assert second["rmse_scored"] == pytest.approx(1.2)
    assert (second["n"], second["n_scored"]) == (2, 1)
    assert second["change"] == pytest.approx(41.5 - 18.7032)
    assert sorted(vectors(model.users)) == [1, 2] and sorted(vectors(model.items)) == [10, 20]
    assert vectors(model.users)[1] == pytest.approx([1.120849, 1.282666], abs=1e-6)
    assert vectors(model.users)[2] == pytest.approx([1.156699, 1.017411], abs=1e-6)
    assert vectors(model.items)[10] == pytest.approx([1.676443, 0.999016], abs=1e-6)
    assert vectors(model.items)[20] == pytest.approx([0.172386, 0.917488], abs=1e-6)


def test_golden_run(spark):
    check_golden_run(spark)


def test_golden_run_without_broadcast(spark, shuffled_joins):
    check_golden_run(spark)


def skewed_ratings():
    """Item 0 holds most ratings, user 0 many, and one row is repeated often."""
    rng = random.Random(11)
    rows = [(u, 0, rng.uniform(1, 5)) for u in range(60)]
    rows += [(0, j, rng.uniform(1, 5)) for j in range(40)]
    rows += [(rng.randrange(60), rng.randrange(40), rng.uniform(1, 5)) for _ in range(60)]
    return rows + [(3, 4, 2.5)] * 50


def check_against_arrays(spark, d):
    rows = skewed_ratings()
    rng = random.Random(2)
    users = {u: [rng.uniform(-0.5, 0.5) for _ in range(d)] for u in {r[0] for r in rows}}
    items = {j: [rng.uniform(-0.5, 0.5) for _ in range(d)] for j in {r[1] for r in rows}}
    settings = dict(gain=0.002, power=0.2, lam=0.5, mu=0.7)
    model = factorize(
        rated(spark, rows),
        d=d,
        maxiter=3,
        initial=FactorModel(profiles(spark, users), profiles(spark, items)),
        **settings,
    )
    want_users, want_items, history = reference_run(rows, users, items, steps=3, **settings)
    assert [(r["objective"], r["rmse"]) for r in model.history.orderBy("iter").collect()] == [
        pytest.approx(step) for step in history
    ]
    for found, wanted in ((vectors(model.users), want_users), (vectors(model.items), want_items)):
        assert found.keys() == wanted.keys()
        for key in found:
            assert found[key] == pytest.approx(list(wanted[key]))
    assert {r["n"] for r in model.history.collect()} == {len(rows)}


@pytest.mark.parametrize("d", [3, 45])
def test_skewed_ratings_equal_array_descent(spark, d):
    check_against_arrays(spark, d)


@pytest.mark.parametrize("d", [3, 45])
def test_skewed_ratings_without_broadcast(spark, shuffled_joins, monkeypatch, d):
    from termfit.plans import joins

    monkeypatch.setattr(joins, "SHARES", 20)
    check_against_arrays(spark, d)


def test_step_is_the_negative_gradient(spark):
    d = 3
    rows = [(1, 1, 4.0), (1, 2, 1.0), (2, 1, 3.0)]
    rng = np.random.default_rng(0)
    users = {i: rng.normal(size=d).tolist() for i in (1, 2)}
    items = {j: rng.normal(size=d).tolist() for j in (1, 2)}

    def value(users, items):
        error = sum((np.dot(users[i], items[j]) - r) ** 2 for i, j, r in rows)
        return error + 0.3 * sum(np.dot(u, u) for u in users.values()) + 0.6 * sum(
            np.dot(v, v) for v in items.values()
        )

    res = residuals(rated(spark, rows), profiles(spark, users), profiles(spark, items), d)
    moved = {
        "u": vectors(step_users(res, 1e-3, 0.3, d)),
        "v": vectors(step_items(res, 1e-3, 0.6, d)),
    }
    h = 1e-6
    for side, table in (("u", users), ("v", items)):
        for key, vector in table.items():
            for k in range(d):
                up, down = ({**table, key: list(vector)} for _ in range(2))
                up[key][k] += h
                down[key][k] -= h
                pair = [(up, items), (down, items)] if side == "u" else [(users, up), (users, down)]
                slope = (value(*pair[0]) - value(*pair[1])) / (2 * h)
                assert (vector[k] - moved[side][key][k]) / 1e-3 == pytest.approx(slope, rel=1e-4, abs=1e-4)


def test_all_profiles_at_once_equal_single_steps(spark):
    train, users, items = rated(spark, TRAIN), profiles(spark, USERS), profiles(spark, ITEMS)
    res = residuals(train, users, items, 2)
    both = step_models(res.drop("delta").withColumn("fold", F.lit(-1)), [0], [0.1], 0.5, 2.0, 2).collect()
    found = {(r["side"], r["id"]): list(r["factors"]) for r in both}
    single = {(0, i): v for i, v in vectors(step_users(res, 0.1, 0.5, 2)).items()}
    single |= {(1, j): v for j, v in vectors(step_items(res, 0.1, 2.0, 2)).items()}
    assert found == single
    assert sum(r["parts"][0]["sq_error"] for r in both if r["side"] == 0) == 34.0


def test_rmse_counts_rows_without_profiles(spark):
    row = rmse(rated(spark, TEST), profiles(spark, USERS), profiles(spark, ITEMS), 2).first()
    assert (row["n"], row["n_scored"], row["rmse"], row["rmse_scored"]) == (2, 1, 0.0, 0.0)
    empty = rmse(rated(spark, []), profiles(spark, USERS), profiles(spark, ITEMS), 2).first()
    assert (empty["rmse"], empty["n"]) == (None, 0)


def test_random_profiles(spark):
    ids = spark.range(20000)
    normal = init_profiles(ids, 3, 5, "u")
    row = normal.select(F.explode("factors").alias("z")).agg(F.avg("z"), F.stddev("z"), F.kurtosis("z")).first()
    assert abs(row[0]) < 0.02 and abs(row[1] - 1) < 0.02 and abs(row[2]) < 0.1
    some = init_profiles(ids.where("id % 7 = 0").repartition(5), 3, 5, "u")
    assert some.join(normal.withColumnRenamed("factors", "f"), "id").where("factors <> f").count() == 0
    assert vectors(init_profiles(spark.range(3), 2, 5, "v")) != vectors(init_profiles(spark.range(3), 2, 5, "u"))
    uniform = init_profiles(ids, 2, 5, "u", "uniform").select(F.explode("factors").alias("z"))
    low, high = uniform.agg(F.min("z"), F.max("z")).first()
    assert -0.5 <= low < -0.49 and 0.49 < high < 0.5


def test_entity_ids_and_gain(spark):
    assert sorted(r["id"] for r in entity_ids(rated(spark, TRAIN), "user_id").collect()) == [1, 2]
    assert sorted(r["id"] for r in entity_ids(rated(spark, TRAIN), "item_id").collect()) == [10, 20]
    assert gain_schedule(0.1, 0.2, 1) == 0.1
    assert gain_schedule(0.1, 0.5, 4) == pytest.approx(0.05)


def test_stopping(spark):
    none = factorize(rated(spark, TRAIN), d=2, maxiter=0, seed=1)
    assert none.history.count() == 0 and none.users.count() == 2 and none.items.count() == 2
    early = factorize(rated(spark, TRAIN), maxiter=9, eps=1e98, initial=start(spark), **GOLDEN)
    assert early.history.count() == 2
    still = factorize(rated(spark, TRAIN), maxiter=2, initial=start(spark), **{**GOLDEN, "gain": 0.0})
    assert [r["objective"] for r in still.history.orderBy("iter").collect()] == [41.5, 41.5]
    assert vectors(still.users) == USERS
    empty = factorize(rated(spark, []), d=2, maxiter=3)
    assert empty.history.count() == 0 and empty.users.count() == 0


def test_repartitioned_run_is_the_same(spark):
    a = factorize(rated(spark, TRAIN), d=2, maxiter=2, seed=3)
    b = factorize(rated(spark, TRAIN).repartition(3), d=2, maxiter=2, seed=3, num_partitions=2)
    for left, right in ((a.users, b.users), (a.items, b.items)):
        left, right = vectors(left), vectors(right)
        assert left.keys() == right.keys()
        assert all(left[key] == pytest.approx(right[key]) for key in left)


@pytest.mark.parametrize("d", [2, 23])
def test_cross_validation(spark, d):
    """Folds trained side by side agree with single runs."""
    rows = [(9, 1, 3.0)]  # a user that only fold 1 knows
    rows += [(u, j, float((u * j) % 5 + 1)) for u in range(6) for j in range(5)]
    folded = rated(spark, rows).withColumn("fold", ((F.col("user_id") + F.col("item_id")) % 3).cast("int"))
    result = cross_validate(folded, 3, d=d, maxiter=2, seed=3).orderBy("fold").collect()
    assert [(r["fold"], r["n_train"], r["n_test"], r["iterations"]) for r in result] == [
        (0, 21, 10, 2),
        (1, 20, 11, 2),
        (2, 21, 10, 2),
    ]
    for k in range(3):
        single = factorize(
            folded.where(F.col("fold") != k), folded.where(F.col("fold") == k), d=d, maxiter=2, seed=3
        )
        last = single.history.orderBy(F.col("iter").desc()).first()
        assert result[k]["rmse"] == pytest.approx(last["rmse"])
        assert result[k]["rmse_scored"] == pytest.approx(last["rmse_scored"])
    assert result[1]["rmse_scored"] > result[1]["rmse"]


def test_models_stop_on_their_own(spark):
    """With a wide tolerance a fold may stop early without holding up the others."""
    rows = [(u, j, float((u * j) % 5 + 1)) for u in range(6) for j in range(5)]
    fold = F.when(F.col("user_id") == 0, 0).otherwise(F.col("item_id") % 2 + 1).cast("int")
    folded = rated(spark, rows).withColumn("fold", fold)
    options = dict(d=2, maxiter=6, seed=3, gain=0.01)
    objectives = []
    for k in range(3):
        parts = folded.where(F.col("fold") != k), folded.where(F.col("fold") == k)
        objectives.append([r["change"] for r in factorize(*parts, **options).history.orderBy("iter").collect()])
    eps = sorted(objectives[k][1] for k in range(3))[1]
    wanted = []
    for k in range(3):
        parts = folded.where(F.col("fold") != k), folded.where(F.col("fold") == k)
        history = factorize(*parts, eps=eps * 1.0001, **options).history.orderBy("iter").collect()
        wanted.append((len(history), pytest.approx(history[-1]["rmse"])))
    result = cross_validate(folded, 3, eps=eps * 1.0001, **options).orderBy("fold").collect()
    assert [(r["iterations"], r["rmse"]) for r in result] == wanted
    assert len({r["iterations"] for r in result}) > 1


def test_single_fold_trains_and_tests_on_itself(spark):
    folded = rated(spark, TRAIN).withColumn("fold", F.lit(0))
    row = cross_validate(folded, 1, d=2, maxiter=2, seed=3).first()
    model = factorize(rated(spark, TRAIN), d=2, maxiter=2, seed=3)
    assert (row["n_train"], row["n_test"]) == (3, 3)
    assert row["rmse"] == pytest.approx(model.history.orderBy(F.col("iter").desc()).first()["rmse"])


def test_saved_model(spark, tmp_path):
    path = str(tmp_path / "model")
    model = fit_and_save(rated(spark, TRAIN), path, d=2, maxiter=1, seed=3)
    again = FactorModel.load(spark, path)
    assert vectors(again.users) == vectors(model.users)
    assert vectors(again.items) == vectors(model.items)


def test_partial_sums_without_own_vectors_step_alike(spark):
    """With the profiles given, tasks exchange pulls only; ids without a profile and rows without an id included."""
    rows = [(u, i, (u * i) % 5 + 0.5, (u + i) % 3, 1 + u % 2) for u in range(6) for i in range(7)]
    rows += [(None, 3, 2.0, 0, 1), (77, 2, 1.0, 1, 1), (1, 88, 1.0, 2, 1)]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double, fold int, weight bigint")
    for models, d in (([0, 1, 2], 3), ([0], 25)):
        known = [(side, i, [0.1 * ((side * 7 + i * 3 + k) % 9) for k in range(d * len(models))]) for side in (0, 1) for i in range(7)]
        profiles = spark.createDataFrame([*known, (0, None, known[0][2])], "side int, id bigint, factors array<double>")
        u, v = (profiles.where(f"side = {s}").selectExpr(f"id AS {key}", f"factors AS {name}") for s, key, name in ((0, "user_id", "u"), (1, "item_id", "v")))
        joined = ratings.join(u, "user_id", "left").join(v, "item_id", "left")
        steps = [step_models(joined, models, [0.01] * len(models), 0.5, 0.7, d, own) for own in (None, profiles)]
        plain, summed = ({(r["side"], r["id"]): r for r in step.collect()} for step in steps)
        assert plain.keys() == summed.keys()
        for key, row in plain.items():
            assert summed[key]["factors"] == pytest.approx(row["factors"])
            for a, b in zip(summed[key]["parts"], row["parts"], strict=True):
                assert [x or 0 for x in a] == pytest.approx([x or 0 for x in b])
