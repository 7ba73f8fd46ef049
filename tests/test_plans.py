"""Shapes of physical plans, and the joins for tables that do not fit a broadcast."""

import random
import re

import pytest
from pyspark.sql import functions as F

from termfit import document_term_frequency, tfidf, top_terms_from_text
from termfit.operators.factors import entity_ids, init_profiles, step_models
from termfit.operators.points import Sufficient, margins, total_gradient
from termfit.operators.rows import row_pulls
from termfit.plans import joins, logistic
from termfit.plans.factorize import _Ratings
from termfit.plans.rating_cells import RatingGrid
from termfit.session import checkpoint_dir, durable


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keyed(spark, rows, name):
    return spark.createDataFrame(rows, f"key string, {name} int")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, monkeypatch, how):
    monkeypatch.setattr(joins, "SHARES", 10)
    rng = random.Random(0)
    left = keyed(spark, [("hot", i) for i in range(200)] + [(f"k{rng.randrange(60)}", i) for i in range(200)], "a")
    right = keyed(spark, [("hot", 1)] + [(f"k{i}", i) for i in range(40)], "b")
    hot = joins.hot_keys(left.groupBy("key").count(), "key")
    assert [(r["key"], r["splits"]) for r in hot.collect()] == [("hot", 5)]
    salted = joins.salted_join(left, right, "key", hot_left=hot, left_by=["a"], how=how)
    assert sorted(map(str, salted.select("key", "a", "b").collect())) == sorted(
        map(str, left.join(right, "key", how).select("key", "a", "b").collect())
    )
    pieces = joins.add_salt(left, "key", hot, "s", by=["a"]).where("key = 'hot'").groupBy("s").count().collect()
    assert len(pieces) == 5 and max(r["count"] for r in pieces) < 80


def test_both_sides_hot(spark, monkeypatch):
    monkeypatch.setattr(joins, "SHARES", 10)
    left = keyed(spark, [("x", i) for i in range(50)] + [("y", 1), ("z", 2)], "a")
    right = keyed(spark, [("x", i) for i in range(30)] + [("y", 7), ("y", 8)], "b")
    salted = joins.salted_join(
        left,
        right,
        "key",
        hot_left=joins.hot_keys(left.groupBy("key").count(), "key"),
        left_by=["a"],
        hot_right=joins.hot_keys(right.groupBy("key").count(), "key"),
        right_by=["b"],
    )
    assert sorted(map(str, salted.select("key", "a", "b").collect())) == sorted(
        map(str, left.join(right, "key").select("key", "a", "b").collect())
    )
    with pytest.raises(ValueError):
        joins.salted_join(left, right, "key", hot_left=right, left_by=["a"], hot_right=right, how="left")


def test_hot_list_is_bounded(spark):
    table = spark.range(5000).select((F.col("id") % 700).cast("string").alias("key"))
    hot = joins.hot_keys(table.groupBy("key").count(), "key")
    assert hot.count() < joins.SHARES


def test_size_checks(spark, monkeypatch):
    table = spark.createDataFrame([("abc", 1.0)] * 10, "term string, value double")
    assert joins.measured_bytes(table) == 10 * (32 + 2 * 16 + 3)
    assert joins.measured_bytes(table.limit(0)) == 0
    profiles = spark.range(4).selectExpr("id", "array(1D, 2D) AS factors")
    assert joins.measured_bytes(profiles) == 4 * (32 + 2 * 16 + 16)
    wide = spark.createDataFrame([("abc", i) for i in range(10)], "term string, n int")
    assert "BroadcastHashJoin" in plan(joins.lookup(wide, table.limit(1), "term", by=["n"]))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    shown = plan(joins.lookup(wide, table.limit(1), "term", by=["n"]))
    assert "_salt" in shown


def test_rows_without_a_key_are_spread(spark, shuffled_joins):
    facts = spark.createDataFrame([(None, i) for i in range(100)] + [("a", 1)], "key string, n int")
    table = spark.createDataFrame([("a", 5)], "key string, v int")
    found = joins.lookup(facts, table, "key", by=["n"], how="left")
    assert found.count() == 101 and found.where("v = 5").count() == 1
    hot = joins.hot_keys(facts.where("key IS NOT NULL").groupBy("key").count(), "key")
    salts = joins.add_salt(facts, "key", hot, "s", by=["n"]).where("key IS NULL").select("s").distinct().count()
    assert salts > 50


def test_document_terms_are_counted_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, "a b a", "x")], "doc_id int, text string, extra string").write.parquet(path)
    shown = plan(document_term_frequency(spark.read.parquet(path)))
    assert "Exchange" not in shown and "extra" not in shown


def test_terms_of_every_document_are_split(spark, shuffled_joins, monkeypatch):
    monkeypatch.setattr(joins, "SHARES", 10)
    tf = spark.createDataFrame([(d, t, 1) for d in range(60) for t in ("the", f"t{d}", f"u{d}")], "doc_id int, term string, tf int")
    idf = spark.createDataFrame([("the", 60, 0.5), *((f"{c}{d}", 1, 2.0) for c in "tu" for d in range(60))], "term string, df int, idf double")
    found = tfidf(tf, idf)
    assert "_salt" in plan(found)
    assert found.groupBy("term").agg(F.count("*"), F.sum("tfidf")).where("term = 'the'").first()[1:] == (60, 30.0)
    assert found.count() == 180
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1 << 20)
    assert "BroadcastHashJoin" in plan(tfidf(tf, idf.drop("df")))


def test_top_terms_do_not_sort_everything(spark):
    shown = plan(top_terms_from_text(spark.createDataFrame([("a b",)], "text string")))
    assert "TakeOrderedAndProject" in shown


def labelled(spark, n=50):
    return spark.createDataFrame(
        [(i, 1 if i % 2 else -1, {"a": float(i % 7 - 3), "b": 1.0, f"f{i % 9}": 0.5} if i % 11 else {}) for i in range(n)],
        "row_id int, y int, x map<string,double>",
    )


def test_gradient_and_margins_leave_the_points_whole(spark):
    beta = durable(spark.createDataFrame([("a", 0.1)], "feature string, coef double"))
    shown = plan(total_gradient(labelled(spark), beta, 0.1))
    assert shown.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(feature" in shown
    assert "Generate" not in shown and "Window" not in shown and "Sort" not in shown
    assert "Exchange" not in plan(margins(labelled(spark), beta))


def test_an_iteration_reads_the_points_once(spark, monkeypatch):
    readings = []
    monkeypatch.setattr(logistic, "row_pulls", lambda *given: (readings.append(given), row_pulls(*given))[1])
    even = spark.createDataFrame([(1, 1, {"a": 1.0, "b": 2.0}), (2, -1, {"a": -1.0}), (3, -1, {"b": 1.0, "c": 1.0})], labelled(spark).schema)
    for points, most in ((even, 1), (labelled(spark, 200), 5)):
        readings.clear()
        model = logistic.train_logistic(points, lam=0.5, max_iter=6, eps=1e-9)
        trials = [r["trials"] for r in model.history.orderBy("k").collect()]
        # the first gradient, one reading per search, and one after each step that was not guessed but the last
        missed = sum(a != b for a, b in zip([0, *trials], trials)) - (trials[-1] != trials[-2])
        assert len(readings) == 1 + 6 + missed and missed <= most


def cell_layout(spark, monkeypatch, n=200):
    from termfit.plans import grid

    monkeypatch.setattr(grid, "CELL_PAIRS", 40)
    return logistic._InCells(labelled(spark, n), None)


def test_entries_stay_in_their_cells(spark, monkeypatch):
    cells = cell_layout(spark, monkeypatch)
    table = durable(spark.createDataFrame([("a", 0.1), ("b", 0.2)], "feature string, g double"))
    shown = plan(cells.along(table, "g", "q"))
    assert re.search(r"FlatMapCoGroupsInArrow[^\n]*\n[^\n]*:- (?:\*\(\d+\) )?(?:Project[^\n]*\n[^\n]*)?(?:InMemoryTableScan|TableCacheQueryStage)", shown), shown
    assert cells.grid.cells.count() > 4
    cells.release()


@pytest.mark.parametrize("refresh", [1, 2, 10])
def test_carried_margins_equal_new_ones(spark, monkeypatch, refresh):
    monkeypatch.setattr(logistic, "REFRESH", refresh)
    cells = cell_layout(spark, monkeypatch)
    cells.begin(spark.createDataFrame([("a", 0.3)], "feature string, coef double"), 0.1)
    ages = []
    for _ in range(4):
        loss, coef_sq, coef_g, grad_sq = cells.sums(0.1)
        ages.append(cells.age)
        cells.search(Sufficient(loss + 0.1 * coef_sq, coef_sq, coef_g, grad_sq, 0.1), 0, 16)
        carried = {r["row_id"]: r["m"] for r in cells.rows.collect()}
        assert carried == pytest.approx({r["row_id"]: r["m"] for r in margins(labelled(spark, 200), durable(cells.coefficients)).collect()}, abs=1e-12)
    assert ages == [k % refresh for k in range(4)]
    cells.release()


def test_cells_need_row_ids(spark):
    points = labelled(spark, 5)
    for bad in (points.unionByName(points), points.withColumn("row_id", F.expr("nullif(row_id, 3)"))):
        with pytest.raises(ValueError):
            logistic._InCells(bad, None)


def test_large_ratings_stay_with_their_users(spark):
    ratings = spark.createDataFrame(
        [(u, i, 1.0, -1) for u in range(20) for i in range(10)],
        "user_id bigint, item_id bigint, rating double, fold int",
    )
    sides = [
        init_profiles(entity_ids(ratings, key), 2, 1, key).select(F.lit(side).alias("side"), "id", "factors")
        for side, key in enumerate(("user_id", "item_id"))
    ]
    profiles = durable(sides[0].unionByName(sides[1]))

    def steps(*small):
        return plan(step_models(_Ratings(ratings, *small, None).with_profiles(profiles), [0], [0.1], 1.0, 1.0, 2))

    limit = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        shown = steps(False, True)
    finally:
        spark.conf.set(limit, usual)
    # the user profiles are moved and sorted, the cached ratings are read in place
    assert re.search(r"SortMergeJoin \[user_id[^\n]*\n[^\n]*:- InMemoryTableScan", shown)
    shown = steps(True, True)
    assert shown.count("Exchange hashpartitioning(side") == 1 and "SortAggregate" not in shown
    assert shown.count("BroadcastExchange") == 2


def some_ratings(spark):
    rows = [(u, i, float(u % 5 + i % 3), (u + i) % 3) for u in range(40) for i in range(30) if (u * i) % 4 == 0 or u == 7]
    return spark.createDataFrame(rows * 2, "user_id bigint, item_id bigint, rating double, fold int")


def some_profiles(ratings, models, d):
    sides = [
        init_profiles(entity_ids(ratings, key), models * d, 1, key).select(F.lit(side).alias("side"), "id", "factors")
        for side, key in enumerate(("user_id", "item_id"))
    ]
    return durable(sides[0].unionByName(sides[1]))


def test_two_large_sides_exchange_no_ratings(spark, monkeypatch):
    from termfit.plans import grid

    monkeypatch.setattr(grid, "CELL_PAIRS", 40)
    monkeypatch.setattr(joins, "SHARES", 100)
    ratings = some_ratings(spark)
    profiles = some_profiles(ratings, 1, 2)
    cells = RatingGrid(ratings, [40, 30], 2, None)
    rows = cells.grid.cells.select(F.size("left_ids").alias("users"), F.size("right_ids").alias("items"), F.octet_length("at").alias("bytes")).collect()
    assert sum(r["bytes"] for r in rows) == 4 * ratings.distinct().count() and len(rows) > 8
    # user 7, who rated everything, is in several cells, and no cell holds more than a few times its share
    assert cells.grid.routes[0].where("id = 7").count() > 2
    assert max(r["bytes"] for r in rows) < 4 * 4 * 40
    # one vector per id and listing cell
    sent = [cells.grid.send(side, profiles.where(F.col("side") == side).select("id", F.col("factors").alias("vector"))) for side in (0, 1)]
    assert [table.count() for table in sent] == [sum(r["users"] for r in rows), sum(r["items"] for r in rows)]
    shown = plan(cells.step(profiles, [-9], [0.1], 1.0, 1.0, 2))
    # the cached cells are read in place: neither exchanged nor sorted
    assert re.search(r"FlatMapCoGroupsInArrow[^\n]*\n[^\n]*:- (?:\*\(\d+\) )?(?:Project[^\n]*\n[^\n]*)?(?:InMemoryTableScan|TableCacheQueryStage)", shown), shown
    cells.release()


def test_cells_step_several_models(spark, monkeypatch):
    from termfit.plans import grid

    monkeypatch.setattr(grid, "CELL_PAIRS", 100)
    ratings = some_ratings(spark)
    models, d = [0, 1, 2], 23
    profiles = some_profiles(ratings, len(models), d)
    cells = RatingGrid(ratings, [40, 30], len(models) * d, 3)
    place = _Ratings(ratings, True, True, None)

    def steps(layout):
        table = layout.step(profiles, models, [0.1, 0.0, 0.2], 0.5, 2.0, d)
        return {(r["side"], r["id"]): (r["factors"], r["parts"]) for r in table.collect()}

    found, wanted = steps(cells), steps(place)
    assert found.keys() == wanted.keys()
    for key, (factors, parts) in wanted.items():
        assert found[key][0] == pytest.approx(factors)
        for part, same in zip(found[key][1], parts, strict=True):
            assert part["sq_norm"] == pytest.approx(same["sq_norm"])
            if key[0] == 0:  # errors are booked on users
                assert [part[n] or 0 for n in ("sq_error", "held_error", "held_rows", "rows")] == pytest.approx(
                    [same[n] or 0 for n in ("sq_error", "held_error", "held_rows", "rows")]
                )
    for layout in (cells, place):
        layout.release()


def test_checkpoint_folder_comes_from_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") in checkpoint_dir(spark)
