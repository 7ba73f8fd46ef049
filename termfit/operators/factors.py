"""Matrix factorization, one step at a time.

The objective is sum((<u_i, v_j> - r_ij)^2) + lam * sum(|u_i|^2) + mu * sum(|v_j|^2),
with profiles in (id, factors ARRAY<DOUBLE>) tables. Repeated (user, item) rows each
count. A ``weight`` column, where present, stands for that many equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfit.functions.hashing import hash_normal, hash_uniform
from termfit.functions.vectors import UNROLL_LIMIT, dot
from termfit.plans.joins import lookup

USER, ITEM = 0, 1


def entity_ids(ratings: DataFrame, column: str) -> DataFrame:
    """(id): the distinct users or items of a rating table."""
    return ratings.select(F.col(column).alias("id")).distinct()


def random_vector(d: int, seed: int, side: str, dist: str = "normal") -> Column:
    """A random vector that depends on (seed, side, id) alone."""
    draws = {"normal": hash_normal, "uniform": hash_uniform}
    draw = draws[dist]
    return F.array(*[draw(F.lit(seed), F.lit(side), F.col("id"), F.lit(k)) for k in range(d)])


def init_profiles(
    ids: DataFrame, d: int, seed: int, side: str, dist: str = "normal"
) -> DataFrame:
    """(id, factors): a random vector for every id."""
    return ids.select("id", random_vector(d, seed, side, dist).alias("factors"))


def as_users(profiles: DataFrame) -> DataFrame:
    return profiles.select(F.col("id").alias("user_id"), F.col("factors").alias("u"))


def as_items(profiles: DataFrame) -> DataFrame:
    return profiles.select(F.col("id").alias("item_id"), F.col("factors").alias("v"))


def residual(d: int | None = None) -> Column:
    return (dot("u", "v", d) - F.col("rating")).alias("delta")


def residuals(
    ratings: DataFrame, users: DataFrame, items: DataFrame, d: int | None = None
) -> DataFrame:
    """ratings plus u, v and delta = <u, v> - rating; rows without both profiles drop.

    The profile tables are measured to choose the joins, so pass stored ones.
    """
    joined = _with_profiles(ratings, users, items, "inner")
    return joined.select(*ratings.columns, "u", "v", residual(d))


def _with_profiles(ratings: DataFrame, users: DataFrame, items: DataFrame, how: str) -> DataFrame:
    spread = ["user_id", "item_id", "rating"]
    joined = lookup(ratings, as_users(users), "user_id", by=spread, how=how)
    return lookup(joined, as_items(items), "item_id", by=spread, how=how)


def _weight(df: DataFrame) -> Column:
    return F.col("weight") if "weight" in df.columns else F.lit(1)


def squared_error(res: DataFrame) -> DataFrame:
    """(squared_error): the sum of delta^2."""
    total = F.sum(F.col("delta") * F.col("delta") * _weight(res))
    return res.agg(F.coalesce(total, F.lit(0.0)).alias("squared_error"))


def profile_penalty(profiles: DataFrame, strength: float, d: int | None = None) -> DataFrame:
    """(penalty): strength * sum of squared norms."""
    norm = dot("factors", "factors", d)
    return profiles.agg(F.coalesce(F.lit(float(strength)) * F.sum(norm), F.lit(0.0)).alias("penalty"))


def objective(
    res: DataFrame,
    users: DataFrame,
    items: DataFrame,
    lam: float = 1.0,
    mu: float = 1.0,
    d: int | None = None,
) -> DataFrame:
    """(objective): squared error plus both penalties."""
    parts = [
        squared_error(res).toDF("part"),
        profile_penalty(users, lam, d).toDF("part"),
        profile_penalty(items, mu, d).toDF("part"),
    ]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return stacked.agg(F.sum("part").alias("objective"))


def rmse(
    ratings: DataFrame, users: DataFrame, items: DataFrame, d: int | None = None
) -> DataFrame:
    """(rmse, rmse_scored, n, n_scored): one row.

    ``rmse`` divides by all rows although rows without both profiles add no error;
    ``rmse_scored`` divides by the rows that could be scored.
    """
    joined = _with_profiles(ratings, users, items, "left")
    return rmse_of(joined.select(*ratings.columns, residual(d)))


def rmse_of(scored: DataFrame) -> DataFrame:
    """The same from rows whose delta is NULL where a profile is missing."""
    weight = _weight(scored)
    error = F.coalesce(F.sum(F.col("delta") * F.col("delta") * weight), F.lit(0.0))
    n = F.coalesce(F.sum(weight), F.lit(0)).cast("bigint")
    n_scored = F.coalesce(F.sum(F.when(F.col("delta").isNotNull(), weight)), F.lit(0)).cast("bigint")
    sums = scored.agg(error.alias("error"), n.alias("n"), n_scored.alias("n_scored"))
    return sums.select(
        F.sqrt(F.try_divide("error", F.col("n").cast("double"))).alias("rmse"),
        F.sqrt(F.try_divide("error", F.col("n_scored").cast("double"))).alias("rmse_scored"),
        "n",
        "n_scored",
    )


def gain_schedule(gain: float, power: float, iteration: int) -> float:
    """Step size of an iteration, counted from 1."""
    return gain / iteration**power


def parts_per_model(d: int) -> int:
    """Long vectors are summed in parts of at most UNROLL_LIMIT elements."""
    return -(-d // UNROLL_LIMIT)


def stretches(models: int, d: int) -> list[tuple[int, int, int, int, int]]:
    """(part, model, its how-manyth part, first element, elements) of vectors that hold d factors per model."""
    per_model = parts_per_model(d)
    width = part_width(d)
    return [
        (m * per_model + c, m, c, m * d + c * width, min(width, d - c * width))
        for m in range(models)
        for c in range(per_model)
    ]


def part_width(d: int) -> int:
    return -(-d // parts_per_model(d))


def _descend(
    pulls: DataFrame, keys: list[str], gammas: list[float], strength: str, d: int
) -> DataFrame:
    """(*keys, factors, parts): own - gamma * (sum(2 delta other) + 2 strength own) per key.

    Several models are stepped side by side: ``own`` and ``other`` hold the d factors of
    each model one after the other; ``delta`` and ``held`` have one residual per model,
    NULL where the row does not train or test it. A part is a stretch of one model's
    vector; every pull is summed part by part in a hash aggregate over plain numbers.
    """
    parts = stretches(len(gammas), d)
    if len(parts) == 1:
        pieces = pulls.select(
            *keys, "weight", "own", "other", F.lit(0).alias("part"),
            F.expr("delta[0] AS delta"), F.expr("delta[0] AS error"), F.expr("held[0] AS held"),
        )
    else:
        structs = ", ".join(
            f"struct({part} AS part, slice(own, {start + 1}, {n}) AS own, slice(other, {start + 1}, {n}) AS other, "
            f"delta[{m}] AS delta, {f'delta[{m}]' if c == 0 else 'CAST(NULL AS DOUBLE)'} AS error, "
            f"{f'held[{m}]' if c == 0 else 'CAST(NULL AS DOUBLE)'} AS held)"
            for part, m, c, start, n in parts
        )
        pieces = pulls.select(*keys, "weight", F.expr(f"inline(array({structs}))"))
    cells = range(part_width(d))
    summed = pieces.groupBy(*keys, "part").agg(
        *[F.expr(f"sum(2D * delta * weight * get(other, {j}))").alias(f"_g{j}") for j in cells],
        *[F.expr(f"first(get(own, {j}))").alias(f"_p{j}") for j in cells],
        F.expr("sum(error * error * weight)").alias("sq_error"),
        F.expr("sum(held * held * weight)").alias("held_error"),
        F.expr("sum(IF(held IS NULL, 0, weight))").alias("held_rows"),
        F.expr("sum(IF(error IS NULL, 0, weight))").alias("rows"),
    )
    return _moved(summed, keys, gammas, strength, d)


def _moved(summed: DataFrame, keys: list[str], gammas: list[float], strength: str, d: int) -> DataFrame:
    """(*keys, factors, parts) from a part's summed pulls (_g0 ...) and its own elements (_p0 ...).

    ``parts`` gives each part's share of the squared error, the squared norm before the
    step, the held-out squared error and the numbers of held-out and of training rows scored.
    """
    per_model, width = parts_per_model(d), part_width(d)
    cells = range(width)
    steps = ", ".join(f"{float(gamma)!r}D" for gamma in gammas)
    gamma = f"{float(gammas[0])!r}D" if len(set(gammas)) == 1 else f"array({steps})[part div {per_model}]"
    moved = ", ".join(f"_p{j} - {gamma} * (_g{j} + 2D * ({strength}) * _p{j})" for j in cells)
    last = d - (per_model - 1) * width
    if last < width:
        moved = f"slice(array({moved}), 1, IF(part % {per_model} = {per_model - 1}, {last}, {width}))"
    else:
        moved = f"array({moved})"
    norm = " + ".join(f"coalesce(_p{j} * _p{j}, 0D)" for j in cells)
    report = f"struct(part, sq_error, {norm} AS sq_norm, held_error, held_rows, rows)"
    stepped = summed.select(*keys, "part", F.expr(moved).alias("factors"), F.expr(report).alias("report"))
    if per_model * len(gammas) == 1:
        return stepped.select(*keys, "factors", F.array("report").alias("parts"))
    # as many rows meet per key as it has parts
    whole = stepped.groupBy(*keys).agg(
        F.expr("array_sort(collect_list(struct(part, factors, report)))").alias("_parts")
    )
    return whole.select(
        *keys, F.flatten("_parts.factors").alias("factors"), F.col("_parts.report").alias("parts")
    )


def _step(res: DataFrame, key: str, own: str, other: str, gamma: float, strength: float, d: int) -> DataFrame:
    pulls = res.select(
        F.col(key).alias("id"),
        F.col(own).alias("own"),
        F.col(other).alias("other"),
        F.array("delta").alias("delta"),
        F.expr("array(CAST(NULL AS DOUBLE))").alias("held"),
        _weight(res).alias("weight"),
    )
    return _descend(pulls, ["id"], [gamma], f"{float(strength)!r}D", d).select("id", "factors")


def step_users(res: DataFrame, gamma: float, lam: float, d: int) -> DataFrame:
    """(id, factors): user profiles after one gradient step from the residuals."""
    return _step(res, "user_id", "u", "v", gamma, lam, d)


def step_items(res: DataFrame, gamma: float, mu: float, d: int) -> DataFrame:
    """(id, factors): item profiles after one gradient step from the same residuals."""
    return _step(res, "item_id", "v", "u", gamma, mu, d)


def step_models(
    rows: DataFrame, models: list[int], gammas: list[float], lam: float, mu: float, d: int, profiles: DataFrame | None = None
) -> DataFrame:
    """(side, id, factors, parts): all profiles of several models after one step.

    ``rows`` is (user_id, item_id, rating, fold[, weight], u, v), with u and v holding the
    factors of every model and NULL where a profile is missing. A model trains on the rows
    whose fold is not its own number; the rows of its own fold are held out, and their
    error is booked on the user.

    All of it comes from one reading of the rows and one aggregation in which every row
    pulls at its user and at its item. With ``profiles``, the (side, id, factors) that u and v come from, a partial
    sum of a task carries no copy of its id's own vector: that joins the sums once, as a row.
    """
    places = range(len(models))
    unroll = len(models) * d <= UNROLL_LIMIT
    residuals = [dot("u", "v", d, i * d, unroll) - F.col("rating") for i in places]
    trained = ", ".join(f"IF(fold = {m}, NULL, delta[{i}])" for i, m in enumerate(models))
    held = ", ".join(f"IF(fold = {m}, delta[{i}], NULL)" for i, m in enumerate(models))
    nothing = ", ".join("CAST(NULL AS DOUBLE)" for _ in models)
    scored = rows.select(
        "user_id", "item_id", "fold", "u", "v", _weight(rows).alias("weight"), F.array(*residuals).alias("delta")
    )
    pulls = scored.select(
        "weight",
        F.expr(
            "inline(array("
            f"struct({USER} AS side, user_id AS id, u AS own, v AS other, "
            f"array({trained}) AS delta, array({held}) AS held), "
            f"struct({ITEM} AS side, item_id AS id, v AS own, u AS other, "
            f"array({trained}) AS delta, array({nothing}) AS held)))"
        ),
    )
    if profiles is not None:
        # rows without an id have no vector of their own
        return step_summed(_pulled(pulls, len(models), d), profiles.where("id IS NOT NULL"), gammas, lam, mu, d)
    return _descend(pulls, ["side", "id"], gammas, strength_of_sides(lam, mu), d)


def _pulled(pulls: DataFrame, models: int, d: int) -> DataFrame:
    """What every row pulls at its ids, by part, as ``step_summed`` adds it up. Short vectors are summed for all models in one row."""
    if models * d <= UNROLL_LIMIT:
        summed = pulls.groupBy("side", "id").agg(
            *[F.expr(f"sum(2D * delta[{j // d}] * weight * get(other, {j}))").alias(f"_g{j}") for j in range(models * d)],
            *[
                F.expr(f"sum({value.format(m=m)})").alias(f"_{name}{m}")
                for m in range(models)
                for name, value in (
                    ("sq_error", "delta[{m}] * delta[{m}] * weight"),
                    ("held_error", "held[{m}] * held[{m}] * weight"),
                    ("held_rows", "CAST(IF(held[{m}] IS NULL, 0, weight) AS BIGINT)"),
                    ("rows", "CAST(IF(delta[{m}] IS NULL, 0, weight) AS BIGINT)"),
                )
            ],
        )
        structs = ", ".join(
            f"struct({part} AS part, {', '.join(f'_g{start + j} AS {name}' for j, name in enumerate(pull_columns(d)))}, "
            f"{', '.join(f'_{name}{m} AS {name}' for name in ('sq_error', 'held_error', 'held_rows', 'rows'))})"
            for part, m, _, start, _ in stretches(models, d)
        )
        return summed.select("side", "id", F.expr(f"inline(array({structs}))"))
    structs = ", ".join(
        f"struct({part} AS part, 2D * delta[{m}] * weight AS push, slice(other, {start + 1}, {n}) AS other, "
        f"{f'delta[{m}]' if c == 0 else 'CAST(NULL AS DOUBLE)'} AS error, {f'held[{m}]' if c == 0 else 'CAST(NULL AS DOUBLE)'} AS held)"
        for part, m, c, start, n in stretches(models, d)
    )
    pieces = pulls.select("side", "id", "weight", F.expr(f"inline(array({structs}))"))
    return pieces.select(
        "side", "id", "part", *[F.expr(f"push * get(other, {j})").alias(name) for j, name in enumerate(pull_columns(d))],
        F.expr("error * error * weight").alias("sq_error"),
        F.expr("held * held * weight").alias("held_error"),
        F.expr("CAST(IF(held IS NULL, 0, weight) AS BIGINT)").alias("held_rows"),
        F.expr("CAST(IF(error IS NULL, 0, weight) AS BIGINT)").alias("rows"),
    )


def strength_of_sides(lam: float, mu: float) -> str:
    return f"IF(side = {USER}, {float(lam)!r}D, {float(mu)!r}D)"


def pull_columns(d: int) -> list[str]:
    return [f"_g{j}" for j in range(part_width(d))]


def step_summed(
    pulls: DataFrame, profiles: DataFrame, gammas: list[float], lam: float, mu: float, d: int
) -> DataFrame:
    """(side, id, factors, parts) as ``step_models`` gives them, from pulls that are partly summed already.

    ``pulls`` has rows (side, id, part, _g0 ..., sq_error, held_error, held_rows, rows), any number per id and
    part; the profiles travel along as rows. A profile that nothing pulls at is left out.
    """
    sums = ["sq_error", "held_error", "held_rows", "rows"]
    cells = range(part_width(d))
    own = ", ".join(
        "struct(" + ", ".join([f"{part} AS part", *(f"{f'get(factors, {start + j})' if j < n else 'CAST(NULL AS DOUBLE)'} AS _p{j}" for j in cells)]) + ")"
        for part, _, _, start, n in stretches(len(gammas), d)
    )
    carried = profiles.select("side", "id", F.expr(f"inline(array({own}))"), F.lit(False).alias("pulled"))
    stacked = pulls.withColumn("pulled", F.lit(True)).unionByName(carried, allowMissingColumns=True)
    summed = stacked.groupBy("side", "id", "part").agg(
        *[F.sum(name).alias(name) for name in (*pull_columns(d), *sums)],
        *[F.first(f"_p{j}", ignorenulls=True).alias(f"_p{j}") for j in cells],
        F.max("pulled").alias("pulled"),
    )
    return _moved(summed.where("pulled"), ["side", "id"], gammas, strength_of_sides(lam, mu), d)


def report(stepped: DataFrame, d: int) -> DataFrame:
    """(place, error, users_norm, items_norm, held_error, held_rows, rows): one row per model."""
    parts = stepped.select("side", F.expr("inline(parts)"))
    return parts.groupBy(F.expr(f"part div {parts_per_model(d)}").alias("place")).agg(
        F.expr(f"coalesce(sum(IF(side = {USER}, sq_error, 0D)), 0D)").alias("error"),
        F.expr(f"coalesce(sum(IF(side = {USER}, sq_norm, 0D)), 0D)").alias("users_norm"),
        F.expr(f"coalesce(sum(IF(side = {ITEM}, sq_norm, 0D)), 0D)").alias("items_norm"),
        F.expr("coalesce(sum(held_error), 0D)").alias("held_error"),
        F.expr("CAST(coalesce(sum(held_rows), 0) AS BIGINT)").alias("held_rows"),
        F.expr(f"CAST(coalesce(sum(IF(side = {USER}, rows, 0)), 0) AS BIGINT)").alias("rows"),
    )
