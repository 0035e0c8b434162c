"""Hand-made cases: ties, nulls, single rows, broken files."""

import json
import random
from collections import Counter

import pytest

from parcelog.operators import checks, lifecycle as life, matching, ranks, summaries
from parcelog.operators.components import connected_components
from parcelog.sources import files, flats, offers
from pyspark.sql import Window, functions as F


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_slots_count_what_is_open_at_the_start(spark):
    df = frame(spark, [("k", 1, 1, 3), ("k", 2, 2, 10), ("k", 3, 4, 5), ("j", 4, 1, 1), ("j", 5, 1, 2)], "k string, id int, s int, e int")
    got = {r.id: r.slot for r in life.sweep_slots(df, ["k"], "id", "s", "e").collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0, 5: 1}


def test_gap_group_breaks_below_the_tolerance(spark):
    df = frame(spark, [("k", float(p), i) for i, p in enumerate((98, 99.5, 100, 103))] + [("l", 1.0, 9)], "k string, price double, id int")
    got = {r.id: r.price_grp for r in life.gap_group(df, ["k"], "price", ["id"], 0.01).collect()}
    assert got == {0: 1, 1: 2, 2: 2, 3: 3, 9: 1}


def test_price_changes_skip_nulls(spark):
    df = frame(spark, [(1, 1, i, p) for i, p in enumerate((5, 5, 6, None, 6, 7))], "listing_id int, obs_id int, scraped_at int, price int")
    assert [(r.price_before, r.price) for r in life.price_changes(df).orderBy("scraped_at").collect()] == [(5, 6), (6, 7)]


def test_latest_prefers_full_rows_and_breaks_ties(spark):
    df = frame(spark, [(1, 1, 5, "A", 10), (1, 2, 9, None, 11), (1, 3, 5, "B", 12)], "listing_id int, obs_id int, scraped_at int, region string, price int")
    (row,) = life.latest(df).collect()
    assert (row.obs_id, row.region) == (3, "B")


def test_cuts_with_ties_and_k_of_one(spark):
    df = frame(spark, [("a", 4, v) for v in (1, 1, 1, 1, 5, 6, 7, 8)] + [("b", 1, 3), ("c", 9, 2)], "k string, n_cuts int, v int").withColumnRenamed("n_cuts", "parts")
    got = sorted((r.k, r.i, r.cut) for r in summaries.equi_depth_cuts(df, ["k"], "v", "parts").collect())
    assert got == [("a", 1, 1), ("a", 2, 1), ("a", 3, 6), *[("c", i, 2) for i in range(1, 9)]]


def test_overlaps_touch_nest_and_span_buckets(spark):
    df = spark.range(0).sparkSession.createDataFrame([("k", 1, 0, 400), ("k", 2, 400, 500), ("k", 3, 10, 20), ("k", 4, 501, 502), ("j", 5, 0, 999)], "k string, id int, a int, b int").select("k", "id", *[F.expr(f"timestamp_ntz '2020-01-01' + make_dt_interval({x})").alias(x) for x in "ab"])
    got = sorted((r.a, r.b) for r in matching.overlapping_pairs(df, ["k"], "id", "a", "b").collect())
    assert got == [(1, 2), (1, 3)]


def test_points_inside_concave_rings(spark):
    rings = frame(spark, [("square", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]), ("notch", [(2.0, 0.0), (4.0, 0.0), (4.0, 2.0), (3.0, 0.5), (2.0, 2.0)])], "name string, ring array<struct<x:double,y:double>>")
    points = frame(spark, [(1, 0.5, 0.5), (2, 3.0, 1.5), (3, 2.2, 1.0), (4, None, 0.5), (5, 9.0, 9.0)], "id int, x double, y double")
    assert {r.id: r.name for r in matching.points_in_polygons(points, rings, "id").collect()} == {1: "square", 2: None, 3: "notch", 4: None, 5: None}


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    edges = frame(spark, [*chain, (100, 101), (101, 100), (7, 7), (None, 3), (200, 150)], "u long, v long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 150: 150, 200: 150}
    assert connected_components(edges.limit(0)).count() == 0


def test_checks_are_empty_when_all_is_well(spark):
    df = frame(spark, [(1, "a"), (2, "b"), (2, None)], "id int, x string")
    assert checks.unique(df, "id").count() == 1 and checks.not_null(df, "x").count() == 1 and checks.accepted(df, "x", ["a", "b"]).count() == 0
    got = {r.check: r.passed for r in checks.run_checks({"u": checks.unique(df, "id"), "a": checks.accepted(df, "x", ["a", "b"])}).collect()}
    assert got == {"u": False, "a": True}


def test_appends_skip_known_rows_and_count(spark, tmp_path):
    path, df = f"{tmp_path}/t", frame(spark, [("u", 5), ("u", 5), ("w", 0), ("x", None)], "url string, price long")
    first, second = (files.append_new(df, path, ["url", "price"]).first() for _ in range(2))
    assert (first.processed, first.no_price, first.inserted, first.skipped) == (4, 2, 1, 1)
    assert (second.inserted, second.skipped) == (0, 2) and spark.read.parquet(path).count() == 1


def test_quarantine_parts_good_and_bad(spark):
    good, bad = files.quarantine(frame(spark, [("1", "x"), ("no", "y"), (None, "z"), ("70000", "w")], "n string, t string"), "n short, t string")
    assert [r.t for r in good.collect()] == ["x", "z"] and [r.t for r in bad.collect()] == ["y", "w"]


def test_files_by_registry_json_and_geojson(spark, tmp_path):
    (tmp_path / "deep/er").mkdir(parents=True)
    (tmp_path / "deep/er/a.csv").write_text("price;id_region;geo_lat;geo_lon;level;levels;rooms;area;object_type;building_type\n5;77;55.5;37.5;2;9;-1;30;2;3\n5;99;55.5;37.5;2;9;1;30;2;3\n")
    (row,) = files.scan_registry(spark, "flats_b", f"{tmp_path}/deep", "price long, id_region int, geo_lat double, geo_lon double, level int, levels int, rooms int, area double, object_type int, building_type int").collect()
    assert (row.city, row.rooms, row.building_type, row.is_new_building) == ("Москва", None, "Кирпичный", True) and row.url.startswith("flats_b_")
    for name, text in (("d1", '{"price": "5"}'), ("d2", "{broken")):
        (tmp_path / "train" / name).mkdir(parents=True)
        (tmp_path / "train" / name / "data.json").write_text(text)
    good, bad = files.scan_json_docs(spark, f"{tmp_path}/train", "price string")
    assert [r.doc_id for r in good.collect()] == ["d1"] and [r.doc_id for r in bad.collect()] == ["d2"]
    (tmp_path / "g.json").write_text(json.dumps({"features": [{"properties": {"name": "n"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}}]}))
    (poly,) = files.scan_geojson(spark, f"{tmp_path}/g.json").collect()
    assert poly.name == "n" and [tuple(p) for p in poly.ring] == [(0, 0), (1, 0), (1, 1)]


def test_sanitize_keeps_plausible_values(spark):
    df = frame(spark, [(4.0, 3.0, 55.0, None, 9, 5, 1600, 100), (50.0, 60.0, 55.0, 37.0, 3, 9, 2030, 100)], "total_area double, living_area double, lat double, lon double, floor int, total_floors int, year_built int, price long")
    a, b = offers.sanitize(df, 2024).collect()
    assert (a.total_area, a.lat, a.total_floors, a.year_built, a.price_per_m2) == (None, None, None, None, None)
    assert (b.living_area, b.lon, b.total_floors, b.year_built, b.price_per_m2) == (None, 37.0, 9, 2030, 2)


def test_own_addresses_are_repeatable(spark):
    df = frame(spark, [(5, 77, 55.5, 37.5, 70000, 9, 1, 30.0, 2, 9)] * 2, "price long, id_region int, geo_lat double, geo_lon double, level int, levels int, rooms int, area double, object_type int, building_type int")
    rows = flats.REGISTRY["flats_b"][1](df).collect()
    assert rows[0] == rows[1] and rows[0].floor is None and rows[0].building_type is None


@pytest.mark.parametrize("share", [0.0, 0.34, 1.0])
def test_newest_share(spark, share):
    df = frame(spark, [(i, i // 3) for i in range(10)], "id int, t int")
    got = {r.id for r in summaries.newest_share(df, "t", "id", share).filter("is_test").collect()}
    order = sorted(range(10), key=lambda i: (-(i // 3), i))
    assert got == set(order[: int(share * 10)])


def test_inserts_that_ignore_conflicts(spark, tmp_path):
    path, schema = f"{tmp_path}/runs", "run int, seen int, cards int"
    assert files.insert_ignore(frame(spark, [(1, 5, 50), (1, 4, 40), (None, 1, 7)], schema), path, "run", "seen") == 2
    assert files.insert_ignore(frame(spark, [(1, 1, 10), (2, 2, 20), (2, 2, 19), (None, 1, 7)], schema), path, "run", "seen") == 2
    got = [tuple(r) for r in spark.read.parquet(path).collect()]
    assert sorted(got, key=str) == sorted([(1, 4, 40), (2, 2, 19), (None, 1, 7), (None, 1, 7)], key=str)
    assert files.insert_ignore(frame(spark, [], schema), path, "run", "seen") == 0


def test_swaps_keep_the_old_table_when_the_new_one_fails(spark, tmp_path):
    path = f"{tmp_path}/mart"
    files.replace_swap(frame(spark, [(1,)], "x int"), path)
    files.replace_swap(frame(spark, [(2,)], "x int"), path)
    assert [r.x for r in spark.read.parquet(path).collect()] == [2] and [p.name for p in tmp_path.iterdir()] == ["mart"]
    with pytest.raises(Exception, match="divide|zero"):
        files.replace_swap(frame(spark, [(0,)], "x int").select(F.expr("raise_error('divide by zero')").cast("int").alias("x")), path)
    assert [r.x for r in spark.read.parquet(path).collect()] == [2]


def test_sources_are_registered_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n|t\n3|x\n")
    flats.register("flats_of_test", "|", lambda df: flats.align(df, {"price": F.col("n") * 10, "city": F.col("t")}))
    try:
        (row,) = files.scan_registry(spark, "flats_of_test", str(tmp_path), "n long, t string").collect()
        assert (row.price, row.city) == (30, "x")
        with pytest.raises(ValueError, match="registered"):
            flats.register("flats_of_test", ",", lambda df: df)
    finally:
        del flats.REGISTRY["flats_of_test"]


def test_sheets_go_by_position(spark, tmp_path):
    (tmp_path / "s.csv").write_text("same,same,\n1,2,3\n4,,6\n")
    assert [tuple(r) for r in files.scan_sheet(spark, str(tmp_path), 3).collect()] == [("1", "2", "3"), ("4", None, "6")]


def test_pages_give_titles_and_links(spark):
    df = frame(spark, [(1, "<html><TITLE lang='x'>A\nb</title><a class=q href='u'>u</a><a href=v>v</a>"), (2, "<p>none</p>"), (3, None), (4, "")], "id int, html string")
    assert [tuple(r) for r in files.scan_html(df).orderBy("id").collect()] == [(1, "A\nb", 2, 73), (2, None, 0, 11), (3, None, 0, None), (4, None, 0, 0)]


@pytest.fixture
def many_ranges(spark):
    """Ranges stay as they are dealt, however small."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_running_values_cross_ranges(spark, many_ranges):
    """One key of several ranges, lags and sums as a window over whole groups gives them; nulls are a key."""
    r = random.Random(1)
    rows = [(r.choice(["hot", "hot", "hot", "b", None]), r.randrange(50), i, r.choice([None, 1, 2])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, i long, x int")
    first = lambda c: F.when(F.col(c).isNull(), 1).otherwise(0)
    got = ranks.running(df, ["k"], ["t", F.desc("i")], {"px": F.col("x"), "pi": F.col("i")}, {"s": F.col("x"), "n": first("px")})
    own = Window.partitionBy("k").orderBy("t", F.desc("i"))
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    lagged = df.withColumns({"px": F.lag("x").over(own), "pi": F.lag("i").over(own)})
    want = lagged.withColumns({"s": F.sum(F.coalesce("x", F.lit(0))).over(upto), "n": F.sum(first("px")).over(upto)})
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    spread = ranks._in_ranges(df, "k", "t", F.desc("i")).groupBy("k").agg(F.countDistinct("range_").alias("n")).collect()
    assert {x.k: x.n for x in spread}["hot"] > 3
    whole = ranks.running(df, [], ["i"], sums={"s": F.lit(1)})
    assert sorted((x.i, x.s) for x in whole.collect()) == [(i, i + 1) for i in range(3000)]
    assert ranks.running(df.limit(0), ["k"], ["i"], {"p": F.col("x")}, {"s": F.lit(1)}).count() == 0


def test_chains_and_slots_of_a_hot_key(spark, many_ranges):
    r = random.Random(2)
    rows = [(r.choice(["hot", "hot", "b"]), i, r.randrange(100, 3000), r.randrange(500)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, id long, price int, t int").withColumn("until", F.col("t") + F.col("id") % 40)
    chains = {(x.k, x.id): x.price_grp for x in life.gap_group(df, ["k"], "price", ["id"], 0.002).collect()}
    slots = {(x.k, x.id): x.slot for x in life.sweep_slots(df, ["k"], "id", "t", "until").collect()}
    for k in ("hot", "b"):
        own = sorted((p, i) for key, i, p, _ in rows if key == k)
        group, before = 0, None
        for p, i in own:
            group += before is None or before < p * (1 - 0.002)
            before = p
            assert chains[k, i] == group
        spans = [(t, t + i % 40, i) for key, i, _, t in rows if key == k]
        for t, _, i in spans:
            assert slots[k, i] == sum((a, j) < (t, i) and b >= t for a, b, j in spans)
    plan = life.sweep_slots(df, ["k"], "id", "t", "until")._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window" in x]
    assert windows and all("range_" in x for x in windows)


def test_sums_of_short_chains(spark):
    assert life.gap_group(spark.createDataFrame([], "k string, id long, price int"), ["k"], "price", ["id"], 0.1).count() == 0


HOLE = [[(0, 0), (10, 0), (10, 10), (0, 10)], [(3, 3), (7, 3), (7, 7), (3, 7)]]
TWO_PARTS = [[(20.5, 0.25), (24, 0), (22, 6)], [(30, 30), (31, 30), (31, 33), (30, 33)], [(30.2, 30.2), (30.8, 30.2), (30.8, 30.8)]]
STAR = [[(-9, -9), (-5, -8), (-1, -9.5), (-4, -5), (-2, -1), (-5, -3), (-8, -1), (-6, -5)]]


def even_odd(x, y, rings):
    crossed = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            crossed += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return crossed % 2 == 1


@pytest.mark.parametrize("cell", [0.5, 2.0, 40.0])
def test_points_in_areas_with_holes_and_parts(spark, cell):
    areas = {"hole": HOLE, "parts": TWO_PARTS, "star": STAR}
    r = random.Random(4)
    points = [(i, r.uniform(-11, 34), r.uniform(-11, 34)) for i in range(1500)] + [(2000 + i, r.uniform(*rx), r.uniform(*ry)) for i in range(1500) for rx, ry in [r.choice([((0, 10), (0, 10)), ((20, 25), (0, 7)), ((29, 32), (29, 34)), ((-9, -1), (-10, 0))])]]
    rows = [(name, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for name, rings in areas.items()]
    table = frame(spark, rows, "name string, rings array<array<struct<x:double,y:double>>>")
    got = {x.id: x.name for x in matching.points_in_polygons(frame(spark, points, "id int, x double, y double"), table, "id", cell).collect()}
    want = {i: next((name for name, rings in sorted(areas.items()) if even_odd(x, y, rings)), None) for i, x, y in points}
    assert got == want and len(set(want.values())) == 4
    if cell == 0.5:
        free = matching.area_cells(table, cell).groupBy("name").agg(F.count_if(F.col("edges").isNull()).alias("n"), F.max(F.size("edges")).alias("edges")).collect()
        assert all(x.n > 0 for x in free) and max(x.edges for x in free) <= 8  # cells wholly inside carry no edges, others few


def test_geojson_of_many_rings(spark, tmp_path):
    feature = lambda name, kind, coordinates: {"properties": {"name": name}, "geometry": {"type": kind, "coordinates": coordinates}}
    good = [feature("hole", "Polygon", HOLE), feature("parts", "MultiPolygon", [[TWO_PARTS[0]], TWO_PARTS[1:]])]
    (tmp_path / "g.json").write_text(json.dumps({"features": good}))
    got = {x.name: [[tuple(p) for p in ring] for ring in x.rings] for x in files.scan_geojson(spark, f"{tmp_path}/g.json").collect()}
    assert got == {"hole": HOLE, "parts": TWO_PARTS}
    (tmp_path / "b.json").write_text(json.dumps({"features": [*good, feature("p", "Point", [1, 2])]}))
    with pytest.raises(Exception, match="Point"):
        files.scan_geojson(spark, f"{tmp_path}/b.json").collect()


def test_registry_takes_the_named_file_else_the_first(spark, tmp_path):
    head = "price;id_region;geo_lat;geo_lon;level;levels;rooms;area;object_type;building_type\n"
    schema = "price long, id_region int, geo_lat double, geo_lon double, level int, levels int, rooms int, area double, object_type int, building_type int"
    for name, price in (("b/two.csv", 2), ("a/one.csv", 1), ("z.txt", 9)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(f"{head}{price};77;55.5;37.5;2;9;1;30;2;3\n")
    prices = lambda **k: [x.price for x in files.scan_registry(spark, "flats_b", str(tmp_path), schema, **k).collect()]
    assert prices() == [1] and prices(file="b/two.csv") == [2]
    (tmp_path / "input_data.csv").write_text(f"{head}5;77;55.5;37.5;2;9;1;30;2;3\n")
    assert prices() == [5]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        files.scan_registry(spark, "flats_b", f"{tmp_path}/none", schema)


def test_checks_survive_failure(spark):
    df = frame(spark, [(1, "a"), (1, None)], "id int, x string")
    got = checks.run_checks({
        "dup": checks.unique(df, "id"), "ok": lambda: checks.accepted(df, "x", ["a"]), "null": checks.not_null(df, "x"),
        "unbuilt": lambda: checks.not_null(df, "nothing"), "fails": df.filter(F.raise_error(F.lit("broken pipe")).cast("string").isNotNull()),
    }, spark).collect()
    assert [(x.check, x.n_violations, x.passed) for x in got] == [("dup", 1, False), ("ok", 0, True), ("null", 1, False), ("unbuilt", None, False), ("fails", None, False)]
    assert [x.error is None for x in got] == [True, True, True, False, False] and "broken pipe" in got[4].error


def cramers(rows, i, j):
    own = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
    n, a, b = len(own), Counter(x for x, _ in own), Counter(y for _, y in own)
    if n < 2 or min(len(a), len(b)) < 2:
        return None
    seen = Counter(own)
    chi2 = sum((seen[x, y] - a[x] * b[y] / n) ** 2 / (a[x] * b[y] / n) for x in a for y in b)
    r, k = len(a), len(b)
    phi = max(0, chi2 / n - (k - 1) * (r - 1) / (n - 1))
    least = min(r - (r - 1) ** 2 / (n - 1), k - (k - 1) ** 2 / (n - 1))
    return (phi / (least - 1)) ** 0.5 if least > 1 else None


def test_association_of_all_pairs(spark):
    r = random.Random(5)
    rows = []
    for i in range(600):
        x = r.choice([None, r.uniform(0, 50), r.uniform(0, 50)])
        rows.append((x, None if x is None else x * 2 + r.uniform(0, 5), r.choice("abc"), "abc"[int(x or 0) // 20], r.random() < 0.3, i % 7, None, 5))
    names = ["x", "y", "a", "b", "f", "k", "none", "one"]
    df = frame(spark, rows, "x double, y double, a string, b string, f boolean, k int, none string, one int")
    got = {(m.a, m.b): m.v for m in summaries.association_matrix(df, names).collect()}

    def binned(i):
        own = [row[i] for row in rows if row[i] is not None]
        low, high = min(own), max(own)
        return [None if row[i] is None else 0 if high == low else min(int((row[i] - low) / (high - low) * 10), 9) for row in rows]

    coded = list(zip(*[binned(i) if names[i] in ("x", "y", "k", "one") else [row[i] for row in rows] for i in range(8)], strict=True))
    for i, a in enumerate(names):
        assert got[a, a] == 1
        for j, b in enumerate(names):
            if i < j:
                want = cramers(coded, i, j)
                assert got.get((a, b)) == got.get((b, a)) == (None if want is None else pytest.approx(want, abs=1e-6))
    assert got["x", "y"] > 0.8 > got["x", "a"]


def test_many_quantiles_in_one_pass(spark, many_ranges):
    r = random.Random(6)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.choice([1, 2]), r.choice([None, r.randrange(40), 3]), r.uniform(0, 9)) for _ in range(2000)] + [("z", 9, None, 1.0)]
    df = frame(spark, rows, "g string, k int, v int, w double")
    at = {"lo": 0.05, "med": 0.5, "hi": 0.99}
    wanted = [ranks.Quantiles(("g", "k"), "v", at), ranks.Quantiles((), "w", {"m": 0.3}), ranks.Quantiles(("k",), "w", {"med": 0.5})]
    by_both, whole, by_k = [t.collect() for t in ranks.quantile_tables(df, wanted)]
    import numpy as np

    for x in by_both:
        own = [v for g, k, v, _ in rows if g == x.g and k == x.k and v is not None]
        assert (x.n, [x.lo, x.med, x.hi]) == (len(own), pytest.approx(list(np.quantile(own, list(at.values())))))
    assert len(by_both) == 6 and not any(x.g == "z" for x in by_both)
    assert whole[0].m == pytest.approx(np.quantile([w for *_, w in rows], 0.3)) and len(whole) == 1
    assert {x.k: x.med for x in by_k} == {k: pytest.approx(np.median([w for _, j, _, w in rows if j == k])) for k in (1, 2, 9)}
    assert all(t.count() == 0 for t in ranks.quantile_tables(df.limit(0), wanted))


def test_quantiles_order_only_values_about_the_places(spark, monkeypatch):
    """Of different values few are dealt into ranges, whatever they are like; the rest is counted by bins."""
    r = random.Random(7)
    draw = [lambda: r.uniform(900, 105000), lambda: -r.lognormvariate(0, 6), lambda: r.choice([1e300, -1e300, 0.0]) if r.random() < 0.1 else r.gauss(55, 1e-4)]
    rows = [(r.choice("abc"), r.randrange(3), *[f() for f in draw]) for _ in range(6000)]
    rows[5] = ("c", 1, None, float("nan"), float("inf"))
    df = frame(spark, rows, "g string, k int, even double, wide double, narrow double")
    ordered = []
    dealt = ranks._in_ranges
    monkeypatch.setattr(ranks, "_in_ranges", lambda d, *order: (ordered.append(d.count()), dealt(d, *order))[1])
    names = ("even", "wide", "narrow")
    wanted = [ranks.Quantiles(keys, v, {"med": 0.5}) for v in names for keys in (("g", "k"), ("g",), ())]
    import numpy as np

    for w, table in zip(wanted, ranks.quantile_tables(df, wanted), strict=True):
        groups = {}
        for g, k, *values in rows:
            own = {"g": g, "k": k}
            v = values[names.index(w.value)]
            if v is not None:
                groups.setdefault(tuple(own[x] for x in w.keys), []).append(float("inf") if v != v else v)
        got = {tuple(x[k] for k in w.keys): (x.n, x.med) for x in table.collect()}
        assert got == {key: (len(v), pytest.approx(np.median(v), rel=1e-12)) for key, v in groups.items()}
    assert 0 < ordered[0] < 0.1 * 9 * len(rows)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "int", "double"])
def test_cuts_of_the_newest(spark, kind):
    """Ties, nulls and one huge tie, at every kind of time."""
    times = [None if i % 11 == 0 else 5 if i % 3 == 0 else i // 4 for i in range(400)]
    as_time = {"timestamp": "timestamp_seconds(t * 86400)", "timestamp_ntz": "cast(timestamp_seconds(t * 86400) as timestamp_ntz)", "date": "date_from_unix_date(t)"}.get(kind, f"cast(t as {kind})")
    df = frame(spark, [(i, t) for i, t in enumerate(times)], "id int, t int").withColumn("t", F.expr(as_time))
    order = sorted(range(400), key=lambda i: (times[i] is None, -(times[i] or 0), i))
    for n in (0, 1, 37, 150, 290, 363, 364, 380, 400, 1000):
        assert {x.id for x in summaries.newest(df, "t", "id", n).collect()} == set(order[:n])
    assert summaries.newest(df.limit(0), "t", "id", 5).count() == 0


def test_bands_of_segments(spark):
    units = frame(spark, [("r", p, k, n) for p, k, n in ((10, "1", True), (20, "1", False), (30, "studio", None), (40, "2", True), (0, "1", True), (None, "1", True), (50, None, True))], "region string, price int, room_key string, is_new boolean")
    text = json.dumps([{"region": "r", "rkey": "all", "rks": ["1", "2", "studio"], "isnew": None, "k": 2}, {"region": "r", "rkey": "new", "rks": ["1", "2"], "isnew": True, "k": 1}, {"region": "q", "rkey": "no", "rks": ["1"], "isnew": None, "k": 3}])
    got = summaries.price_bands(units, summaries.segments_of(frame(spark, [(text,)], "j string"), "j")).collect()
    assert sorted(map(tuple, got), key=str) == [("all", 1, 20, 4), ("new", None, None, 2)]


def test_outcomes_of_a_run(spark):
    cards = frame(spark, [(1, 1, 1, 90), (1, 2, 2, 80), (1, 3, 3, 100), (2, 1, 4, None), (2, 2, 5, 7), (3, 1, 6, None), (3, 2, 7, 0), (4, 1, 8, 5)], "listing_id int, scraped_at int, obs_id int, price int")
    state = frame(spark, [(1, 100), (3, 5), (4, None)], "listing_id int, price int")
    got = {x.obs_id: x.outcome for x in matching.classify_sightings(cards, state).collect()}
    assert got == {1: "repriced", 2: "known", 3: "known", 4: "new", 5: "dup", 6: "known", 7: "known", 8: "repriced"}


def test_large_groups_give_the_same_quantiles(spark, monkeypatch):
    r = random.Random(8)
    df = frame(spark, [(r.choice(["a", "b", None]), r.choice([None, r.random()])) for _ in range(500)] + [("none", None)], "g string, v double")
    at = {"lo": 0.1, "hi": 0.75}
    small = summaries.quantiles(df, ["g"], "v", at), summaries.median_band(df, ["g"], "v"), summaries.median_band(df, [], "v")
    monkeypatch.setattr(summaries, "LARGE_GROUP", 100)
    large = summaries.quantiles(df, ["g"], "v", at), summaries.median_band(df, ["g"], "v"), summaries.median_band(df, [], "v")
    for a, b in zip(small, large, strict=True):
        key = lambda x: str(x[0])
        for x, y in zip(sorted(map(tuple, a.collect()), key=key), sorted(map(tuple, b.collect()), key=key), strict=True):
            assert x == pytest.approx(y)


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(200):
        folder = tmp_path / f"{i}"
        folder.mkdir()
        (folder / "data.json").write_text(f'{{"x": {i}}}')
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, tracker = spark.conf.get(key), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "")
    good, bad = files.scan_json_docs(spark, str(tmp_path), "x int")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < sum(s.numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key) == before
    assert sorted((int(r.doc_id), r.x) for r in good.collect()) == [(i, i) for i in range(200)] and bad.count() == 0


def test_costly_rows_of_a_small_file_are_many_tasks(spark):
    from parcelog.queries import QUERIES

    assert QUERIES["flats_g"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 8
