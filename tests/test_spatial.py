import math
import random

from pyspark.sql import functions as F

from martkit.functions.geo import haversine_km
from martkit.operators import spatial
from martkit.operators.spatial import near_members, near_pairs, nearest, pairs_within
from martkit.session import staged
from tests.conftest import plan, rows


def distance(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371 * math.asin(min(1.0, math.sqrt(h)))


def test_haversine_and_antipodes(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (-33.865, 151.2094, -37.8136, 144.9631)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    assert abs(got[0] - math.pi * 6371) < 1e-6
    assert abs(got[1] - distance(-33.865, 151.2094, -37.8136, 144.9631)) < 1e-9


def test_both_ways_to_the_nearest_centroid_are_exact(spark):
    rng = random.Random(1)
    cities = [(i, f"c{i}", rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(30)]
    cities.append((99, "twin", cities[4][2], cities[4][3]))
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(300)]
    points += [(400, cities[4][2], cities[4][3]), (401, None, 10.0)]
    centers = spark.createDataFrame(cities, "id int, city string, lat double, lon double")
    located = spark.createDataFrame(points, "pid int, lat double, lon double")
    expected = {
        i: None if la is None else min((round(distance(la, lo, c[2], c[3]), 6), c[0]) for c in cities)
        for i, la, lo in points
    }
    constant = nearest(located, centers)
    for result in (constant, nearest(located, centers, max_constants=3)):
        got = {r["pid"]: r for r in result.collect()}
        assert len(got) == len(points)
        for i, best in expected.items():
            assert (got[i]["city_id"] is None) if best is None else got[i]["city_id"] == best[1]
            assert best is None or abs(got[i]["distance_km"] - best[0]) < 1e-3
    assert "Join" not in plan(constant) and "Exchange" not in plan(constant)


def test_no_cell_of_the_tree_holds_all_centroids(spark, monkeypatch):
    rng = random.Random(5)
    cities = [(i, f"c{i}", 50 + rng.gauss(0, 0.01), 8 + rng.gauss(0, 0.01)) for i in range(400)] + [(900 + i, f"f{i}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(200)]
    cities += [(2000 + i, "again", 50.0, 8.0) for i in range(60)]  # more than a list, at one place
    points = [(i, 50 + rng.gauss(0, 0.02), 8 + rng.gauss(0, 0.02)) for i in range(200)] + [(300 + i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(200)]
    points += [(900, 50.0, 8.0), (901, -89.99, 0.0), (902, 89.99, 179.99)]
    lists = []
    monkeypatch.setattr(spatial, "staged", lambda df, name: [out := staged(df, name), lists.append(out) if name == "lists" else None][0])
    found = nearest(spark.createDataFrame(points, "pid int, lat double, lon double"), spark.createDataFrame(cities, "id int, city string, lat double, lon double"))
    got = {r["pid"]: r["city_id"] for r in found.collect()}
    for i, la, lo in points:
        km, best = min((distance(la, lo, c[2], c[3]), c[0]) for c in cities)
        assert got[i] == best or abs(distance(la, lo, *next(c[2:] for c in cities if c[0] == got[i])) - km) < 1e-6
    for kept in lists[1:]:
        assert kept.groupBy("_cx", "_cy", "_cz").count().agg(F.max("count")).first()[0] < 601


def test_lists_of_the_tree_do_not_outgrow_the_places(spark, monkeypatch):
    rng = random.Random(6)
    cities = [(i, f"c{i}", rng.uniform(-10, 60), rng.uniform(-20, 100)) for i in range(400)]
    points = [(i, rng.uniform(-85, 85), rng.uniform(-180, 180)) for i in range(300)]
    lists = []
    monkeypatch.setattr(spatial, "staged", lambda df, name: [out := staged(df, name), lists.append(out) if name == "lists" else None][0])
    found = nearest(spark.createDataFrame(points, "pid int, lat double, lon double"), spark.createDataFrame(cities, "id int, city string, lat double, lon double"))
    got = {r["pid"]: r["city_id"] for r in found.collect()}
    assert got == {i: min((distance(la, lo, c[2], c[3]), c[0]) for c in cities)[1] for i, la, lo in points}
    # The places of a cell soon are few, and no list is made for each of them.
    assert len(lists) < 3 and sum(kept.count() for kept in lists) < 18_000


def crowd(n, seed):
    rng = random.Random(seed)
    people = [(i, -33.86 + rng.uniform(-0.03, 0.03), 151.2 + rng.uniform(-0.03, 0.03)) for i in range(n)]
    return people + [(n, 10.0, 179.9999), (n + 1, 10.0, -179.9999)]


def brute(people, km=1.0):
    return sorted(
        (a[0], b[0]) for a in people for b in people if a[0] > b[0] and round(distance(*a[1:], *b[1:]), 2) <= km
    )


def test_near_pairs_equal_all_pairs(spark):
    people = crowd(150, 2)
    positions = spark.createDataFrame(people, "user_id int, lat double, lon double")
    got = near_pairs(positions, 1.0)
    assert sorted(rows(got, "user_left", "user_right")) == brute(people)
    text = plan(got)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_crowded_cells_are_split_without_loss(spark):
    people = crowd(120, 3)
    everyone = spark.createDataFrame(people, "user_id int, lat double, lon double").withColumn("g", F.lit("hot"))
    small = everyone.filter("user_id < 20").withColumn("g", F.lit("small"))
    got = near_members(everyone.unionByName(small), "g", 1.0, rows_per_task=5)
    assert sorted(rows(got.filter("g = 'hot'"), "user_left", "user_right")) == brute(people)
    assert sorted(rows(got.filter("g = 'small'"), "user_left", "user_right")) == brute(people[:20])


def test_pairs_of_several_groups_once(spark):
    people = crowd(80, 7)
    rng = random.Random(8)
    of = {p[0]: {rng.randrange(6) for _ in range(3)} for p in people}
    members = spark.createDataFrame([(g, u, la, lo, f"at {u}") for u, la, lo in people for g in of[u]], "g int, user_id int, lat double, lon double, place string")
    expected = [(a, b) for a, b in brute(people) if of[a] & of[b]]
    for size in (20_000, 4):
        got = near_members(members, "g", 1.0, size, once=True, carry=["place"])
        assert rows(got) == sorted(((min(of[a] & of[b]), a, b, got_km, f"at {a}", f"at {b}") for a, b, got_km in [(a, b, km_of(people, a, b)) for a, b in expected]), key=repr)
    # Nothing is shuffled behind the join that makes the pairs.
    text = plan(near_members(members, "g", 1.0, once=True))
    assert "Exchange" not in text[: text.index("Join")]


def test_members_are_not_broadcast_by_the_size_of_their_files(spark):
    members = spark.createDataFrame(crowd(40, 9), "user_id int, lat double, lon double").withColumn("g", F.lit(1))
    for once in (False, True):
        text = plan(near_members(members, "g", 1.0, once=once))
        assert text[: text.index("Join")].endswith("SortMerge")


def km_of(people, a, b):
    at = {p[0]: p[1:] for p in people}
    return round(distance(*at[a], *at[b]), 2)


def test_pairs_within(spark):
    people = crowd(10, 4)
    positions = spark.createDataFrame(people, "user_id int, lat double, lon double")
    pairs = [(a[0], b[0]) for a in people for b in people if a[0] > b[0]]
    given = spark.createDataFrame(pairs, "user_left int, user_right int")
    assert sorted(rows(pairs_within(given, positions, 1.0), "user_left", "user_right")) == brute(people)
