import random

import numpy as np

from orelode.operators import spatial


def near_brute(points, places, km):
    out = set()
    for i, a, o in points:
        if i is None or a is None or o is None or abs(a) > 90 or abs(o) > 180 or (a, o) == (0, 0):
            continue
        for j, b, p in places:
            if b is not None and p is not None and spatial.haversine(np.float64(a), np.float64(o), np.float64(b), np.float64(p)) <= km:
                out.add((i, j))
    return out


def test_near_pairs_against_brute_force_with_salt_poles_and_antimeridian(spark):
    rng = random.Random(5)
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(300)]
    points += [(300 + i, 10 + rng.gauss(0, 0.3), 20 + rng.gauss(0, 0.3)) for i in range(300)]
    points += [(600 + i, 89.5 + rng.uniform(0, 0.5), rng.uniform(-180, 180)) for i in range(50)] + [(700 + i, 5.0, 180 - rng.uniform(0, 0.4)) for i in range(40)]
    points += [(900, None, 1.0), (901, 0.0, 0.0), (902, 95.0, 1.0), (903, 10.0, 20.0), (904, 10.0, 20.0), (None, 10.0, 20.0)]
    places = [(i, 10 + rng.gauss(0, 0.4), 20 + rng.gauss(0, 0.4)) for i in range(40)] + [(50, 89.9, 10.0), (51, 5.0, -179.9), (52, -90.0, 0.0), (53, None, None), (54, 10.0, 20.0)]
    p = spark.createDataFrame(points, "rec_id long, lat double, lon double").selectExpr("*", "'x' AS id", "'y' AS label", "1 AS strip")
    q = spark.createDataFrame(places, "place_id long, lat double, lon double").selectExpr("*", "'x' AS shape")
    got = spatial.match_boxes(p, "rec_id", "lat", "lon", spatial.circles(q, "place_id", "lat", "lon", 25.0), 25.0, per_task=40)
    pairs = [(r["point_id"], r["box_id"]) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == near_brute(points, places, 25.0)


def test_regions_with_holes_and_several_parts(spark):
    wkt = "MULTIPOLYGON (((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4)), ((20 0, 21 0, 21 1, 20 0)))"
    d = spark.createDataFrame([(1, wkt), (2, None), (3, "POLYGON ((broken"), (4, "POLYGON ((1 1, 2 1))")], "district_id long, wkt string")
    p = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 0.2, 20.8), (4, 5.0, 15.0), (5, None, 1.0)], "rec_id long, lat double, lon double")
    got = spatial.match_boxes(p, "rec_id", "lat", "lon", spatial.regions(d, "district_id", "wkt")).collect()
    assert {(r["point_id"], r["box_id"]) for r in got} == {(1, 1), (3, 1)}


def test_empty_inputs(spark):
    p = spark.createDataFrame([], "rec_id long, lat double, lon double")
    q = spark.createDataFrame([(1, 1.0, 1.0)], "place_id long, lat double, lon double")
    assert spatial.match_boxes(p, "rec_id", "lat", "lon", spatial.circles(q, "place_id", "lat", "lon", 25.0), 25.0).count() == 0
    one = spark.createDataFrame([(1, 1.0, 1.0)], "rec_id long, lat double, lon double")
    assert spatial.match_boxes(one, "rec_id", "lat", "lon", spatial.circles(q.limit(0), "place_id", "lat", "lon", 25.0), 25.0).count() == 0


def test_home_and_abroad(spark):
    f = spark.createDataFrame([(1, "chile ", (1.0, 1.0)), (2, "CL", (1.0, 1.0)), (3, None, (1.0, 1.0)), (4, "PER", (1.0, 1.0))], "rec_id long, country_iso3 string, location struct<lat:double,lon:double>")
    d = spark.createDataFrame([(7, "CHL", "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))")], "district_id long, country_iso3 string, wkt string")
    c = spark.createDataFrame([("CHL", "CL", "Chile"), ("PER", "PE", "Peru")], "iso3 string, iso2 string, country_name string")
    place = spark.createDataFrame([], "place_id long, lat double, lon double")
    got = {r["rec_id"]: r["kind"] for r in spatial.surroundings(f, place, d, c).collect()}
    assert got == {1: "district_home", 2: "district_home", 3: "district_abroad", 4: "district_abroad"}


def test_nearest_region(spark):
    d = spark.createDataFrame([(1, "CHL", "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"), (2, "CHL", "POLYGON ((10 0, 12 0, 12 2, 10 2, 10 0))"), (3, "PER", "POLYGON ((3 0, 4 0, 4 1, 3 0))"), (4, "CHL", None)], "district_id long, c string, wkt string")
    p = spark.createDataFrame([(1, "CHL", 1.0, 1.0), (2, "CHL", 1.0, 5.0), (3, "CHL", 1.0, 8.0), (4, "XXX", 1.0, 1.0), (5, "CHL", None, 1.0)], "rec_id long, c string, lat double, lon double")
    got = {r["rec_id"]: (r["region_id"], round(r["km"])) for r in spatial.nearest_regions(p, "rec_id", "lat", "lon", "c", d, "district_id", "wkt", "c").collect()}
    assert got == {1: (1, 0), 2: (1, 333), 3: (2, 222)}
