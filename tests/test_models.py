"""Ranks, quantiles, splits, features and models on small data with known answers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelog.ml import features, training as t
from parcelog.operators import ranks, summaries


def test_exact_quantiles_are_those_of_the_values(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 999), (None, 50)) for v in rng.integers(0, 60, n)] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    at = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r.g: r for r in ranks.exact_quantiles(df, ["g"], "v", at).collect()}
    assert set(got) == {"a", "b", "c", None}
    for g, row in got.items():
        own = [v for k, v in rows if k == g and v is not None]
        assert [row[k] for k in at] == pytest.approx([np.quantile(own, p) for p in at.values()])
    every = [v for _, v in rows if v is not None]
    assert ranks.overall_quantiles(df, "v", 0.25, 0.75) == pytest.approx(list(np.quantile(every, [0.25, 0.75])))
    assert ranks.overall_quantiles(df.filter("g = 'd'"), "v", 0.5) is None and ranks.overall_quantiles(df.limit(0), "v", 0.5) is None
    large, small = ({r.g: (r.med, r.n) for r in summaries.median_band(df, ["g"], "v", large=x).collect()} for x in (True, False))
    assert large == small


def test_ranks(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(rng.integers(0, 9, 500))], "id int, x int")
    got = ranks.ranked(df, F.desc("x"), F.asc("id")).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 501)) and [(r.x, r.id) for r in got] == sorted(((r.x, r.id) for r in got), key=lambda p: (-p[0], p[1]))
    assert ranks.ranked(df.limit(0), "x").count() == 0


def test_stratified_split_and_folds(spark):
    df = spark.createDataFrame([(i, "a" if i < 103 else "b" if i < 120 else None) for i in range(130)], "id int, y string")
    split = t.stratified_split(df, "id", "y", 0.2)
    assert {r.y: (r.n, r.k) for r in split.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("k")).collect()} == {"a": (103, 21), "b": (17, 3), None: (10, 2)}
    drawn = [{r.id for r in t.stratified_split(df, "id", "y", 0.2, seed).filter("is_test").collect()} for seed in (0, 0, 1)]
    assert drawn[0] == drawn[1] != drawn[2]
    folds = t.stratified_folds(df, "id", "y", 3).groupBy("y", "fold").count().collect()
    assert {(r.y, r.fold) for r in folds} == {(y, k) for y in ("a", "b", None) for k in range(3)}
    for y, n in (("a", 103), ("b", 17), (None, 10)):
        assert all(n // 3 <= r["count"] <= n // 3 + 1 for r in folds if r.y == y)


def test_label_index(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(["b", "a", "c", "a", None])], "id int, x string")
    assert {r.id: r["index"] for r in t.label_index(df, "x").collect()} == {0: 1, 1: 0, 2: 2, 3: 0}


def listings(spark, rows):
    names = ["id", "region", "municipality", "district", "building_type", "total_area", "kitchen_area", "living_area", "price_first", "rooms", "is_studio", "year_built", "completion_date", "is_new_building", "floor", "total_floors", "deal_conditions", "bathrooms", "ceiling_height", "nearest_metro_time"]
    return spark.createDataFrame([tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


TRAIN = [
    {"id": 1, "region": "Москва", "municipality": "M", "district": "D", "building_type": "brick", "total_area": 40, "kitchen_area": 8, "price_first": 4000, "rooms": 1, "year_built": 1990, "deal_conditions": "free", "nearest_metro_time": 5},
    {"id": 2, "municipality": "M", "district": "D", "building_type": "brick", "total_area": 41, "kitchen_area": 10, "price_first": 8200, "rooms": 1, "year_built": 2000, "deal_conditions": "free", "nearest_metro_time": 7},
    {"id": 3, "municipality": "N", "district": "nan", "building_type": "panel", "total_area": 80, "kitchen_area": 90, "price_first": 8000, "rooms": 3, "year_built": 100, "deal_conditions": "alt", "nearest_metro_time": 30},
    {"id": 4, "municipality": "N", "building_type": "", "total_area": 60, "kitchen_area": 12, "price_first": None, "rooms": 9, "is_studio": "t", "year_built": 1980},
]
NEW = [
    {"id": 9, "municipality": "M", "district": "D", "building_type": "brick", "total_area": 42, "price_first": 8400, "rooms": 1, "completion_date": "3 кв. 2027", "is_new_building": 1, "floor": 5, "total_floors": 5, "bathrooms": "1 разд., 2 совм.", "ceiling_height": 99},
    {"id": 10, "municipality": "X", "building_type": "panel", "total_area": 100, "living_area": 50, "price_first": 1000, "is_studio": "True", "floor": 1, "total_floors": 0},
    {"id": 11},
]


def test_features_use_what_was_learnt_only(spark):
    fitted = features.fit(listings(spark, TRAIN), 2024)
    a, b, c = (r.asDict() for r in fitted.transform(listings(spark, NEW), "id").orderBy(F.col("id").cast("int")).collect())
    assert list(a) == ["id", *features.NUMERIC, *features.CATEGORICAL]
    # Group (brick, 40-45): median of 8 and 10; panel: no kitchen (its own exceeded the whole), so the overall median of 8, 10, 12.
    assert (a["kitchen_area"], b["kitchen_area"], c["kitchen_area"]) == (9.0, 10.0, 10.0)
    assert (a["building_age"], b["building_age"]) == (2024 - 1995, 2024 - 1990)  # brick; panel has no year, municipality X none, so overall
    assert (a["rooms"], b["rooms"], c["rooms"]) == (1.0, 0.0, 1.0)  # median of 1, 1, 3, 0
    assert a["price_per_m2"] == 200 and a["ppm2_to_district"] == pytest.approx(200 / 150) and b["ppm2_to_district"] == pytest.approx(10 / 100)
    assert [a[k] for k in ("completion_year", "years_to_completion", "is_presale", "has_completion", "is_ready")] == [2027, 3, 1, 1, 0]
    assert [b[k] for k in ("completion_year", "years_to_completion", "is_presale", "has_completion", "is_ready")] == [None, None, 0, 0, 1]
    assert [a[k] for k in ("is_first_floor", "is_last_floor", "floor_ratio", "bath_separate", "bath_combined", "balcony_count")] == [0, 1, 1.0, 1, 2, -1]
    assert [b[k] for k in ("is_first_floor", "is_last_floor", "floor_ratio", "living_to_total", "area_per_room", "bath_separate")] == [1, 0, None, 0.5, 100, -1]
    assert (a["deal_conditions"], a["seller_type"], c["building_type"], c["nearest_metro_time"], a["ceiling_height"]) == ("free", "unknown", "unknown", 7.0, None)
    alone = fitted.transform(listings(spark, NEW[:1]), "id").first().asDict()
    assert alone == a  # other scored rows lend nothing
    empty = features.fit(listings(spark, TRAIN).limit(0), 2024).transform(listings(spark, NEW), "id").count()
    assert empty == 3


def test_features_of_places(spark):
    rings = spark.createDataFrame([("Square", [(55.0, 37.0), (55.5, 37.0), (55.5, 37.5), (55.0, 37.5)])], "name string, ring array<struct<x:double,y:double>>")
    df = spark.createDataFrame([(1, "55.2", "37.2", None), (2, "55.2", "37.2", "Own"), (3, "50", "30", None), (4, None, None, None)], "id int, lat string, lon string, district string")
    got = {r.id: r for r in features.fit(df, 2024, rings).transform(df, "id").collect()}
    assert {k: r.district for k, r in got.items()} == {1: "Square", 2: "Own", 3: "unknown", 4: "unknown"}
    assert got[1].dist_to_center == pytest.approx(6371 * math.acos(math.sin(math.radians(55.2)) * math.sin(math.radians(55.752)) + math.cos(math.radians(55.2)) * math.cos(math.radians(55.752)) * math.cos(math.radians(37.2 - 37.6175))), rel=1e-6)


@pytest.fixture(scope="module")
def known(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        x, z, kind = float(rng.uniform(0, 10)), float(rng.uniform(0, 1)), "pq"[int(rng.integers(2))]
        rows.append((i, x, z, kind, int(x > 6), 3 * x + (5.0 if kind == "q" else 0.0) + 2, i % 7 == 0))
    return spark.createDataFrame([(i, None if gone else x, z, k, y, v) for i, x, z, k, y, v, gone in rows if not gone], "id int, x double, z double, kind string, y int, v double").cache()


def test_preprocessing(spark, known):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(1.0, "p"), (3.0, "q"), (None, "q"), (5.0, None)], "x double, kind string").fillna({"kind": "none"})
    made = Pipeline(stages=t.preprocessor(["x"], ["kind"])).fit(df)
    rows = made.transform(df.union(spark.createDataFrame([(3.0, "new")], df.schema))).select(vector_to_array("features")).collect()
    scale = np.std([1, 3, 3, 5], ddof=1)  # the missing number is the median
    assert [list(r[0]) for r in rows] == [pytest.approx([x / scale, *hot]) for x, hot in zip((1, 3, 3, 5, 3), ([0, 1, 0], [0, 0, 1], [0, 0, 1], [1, 0, 0], [0, 0, 0]))]


def test_models_find_known_rules(spark, known):
    tree = t.fit(known, "tree", "y", ["x", "z"], ["kind"])
    split = tree.stages[-1].toDebugString
    metrics = t.classifier_metrics(t.score(tree, known, "y"), "y").first()
    assert "feature 0 <= " in split and metrics.roc_auc >= 0.99 and metrics.accuracy >= 0.98
    boosted = t.fit(known, "clf_boosted", "y", ["x", "z"], ["kind"])
    assert t.classifier_metrics(t.score(boosted, known, "y"), "y").first().roc_auc >= 0.99
    top = t.importances(boosted, known).collect()
    assert top[0].feature == "scaled_0" and top[0].importance > 0.9 and sum(r.importance for r in top) == pytest.approx(1)
    assert t.classifier_metrics(t.score(t.fit(known, "logistic", "y", ["x", "z"], ["kind"]), known, "y"), "y").first().roc_auc >= 0.99
    linear = t.fit(known, "linear", "v", ["x", "z"], ["kind"])
    rows = t.score(linear, known, "v", "x", "kind").collect()
    assert all(r.score == pytest.approx(r.v, abs=1e-3) for r in rows)
    assert t.regression_metrics(t.score(t.fit(known, "reg_boosted", "v", ["x", "z"], ["kind"]), known, "v"), "v", "score").first().r2 > 0.98


def test_random_search_prefers_what_can_tell(spark, known):
    noise = known.withColumn("y", (F.floor(F.col("z") * 1e6) % 2).cast("int")).select("id", "z", "kind", "y")
    spaces = [{"model": ["tree"], "maxDepth": [1, 3]}, {"model": ["logistic"], "regParam": [0.01]}]
    drawn = t.drawn_parameters(spaces, 2, seed=3)
    assert len(drawn) == 2 and drawn == t.drawn_parameters(spaces, 2, seed=3) and len(t.drawn_parameters(spaces, 99)) == 3
    found = t.random_search(known, "id", "y", ["x", "z"], ["kind"], spaces, n=3)
    assert len(found) == 3 and found[0][0] >= found[-1][0] >= 0.9 and {s["model"] for _, s in found} == {"tree", "logistic"}
    assert abs(t.random_search(noise, "id", "y", ["z"], ["kind"], spaces[1:], n=1)[0][0] - 0.5) < 0.15


def test_random_search_ranks_leaves_by_their_share(spark):
    """A large leaf with many positive rows ranks below a small one that has only such; all is prepared in one go a fold."""
    rows = [(i, 0.0 if i < 900 else 1.0, int(i >= 900 or i % 3 == 0)) for i in range(1000)]
    spaces = [{"model": ["tree"], "maxDepth": [1], "minInstancesPerNode": [1, 2, 3]}]
    found = t.random_search(spark.createDataFrame(rows, "id int, x double, y int").withColumn("kind", F.lit("a")), "id", "y", ["x"], ["kind"], spaces, n=3)
    positive = 300 + 100
    want = (100 * 600 + 300 * 600 / 2) / (positive * 600)
    assert len(found) == 3 and all(abs(area - want) < 0.02 for area, _ in found)


def test_holdout_is_the_newest_share(spark, known):
    model, metrics = t.train_with_holdout(known, "tree", "y", "id", "id", ["x", "z"], ["kind"])
    row = metrics.first()
    assert row.n == int(0.2 * known.count()) and row.n_train == known.count() and row.newest == 398 and row.roc_auc > 0.9
    assert t.score(model, known, "y").count() == known.count()


def test_simple_models_share_their_features(spark, monkeypatch):
    from parcelog.ml import training
    from parcelog.queries import QUERIES

    made, own = [], training.preprocessor
    monkeypatch.setattr(training, "preprocessor", lambda *x: (made.append(x), own(*x))[1])
    assert sorted(r.model for r in QUERIES["simple_models"](spark, "/root/testdata/sf0.001").collect()) == ["logistic", "tree"]
    assert len(made) == 1
