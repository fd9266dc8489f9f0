import random
import uuid

from pyspark.sql import functions as F

from martkit.functions.keys import ORDER_NAMESPACE, hash_key, uuid5_key
from martkit.functions.temporal import active_at, local_time, on_day, since, whole_days
from martkit.functions.text import part
from martkit.operators.aggregates import chunked_lists, cross_tab, difference, duplicates, joined_chunks, ordered_list, with_group_stat
from martkit.operators.calendar import calendar
from martkit.operators.distinct import distinct_counts, id_bitmaps, united
from martkit.operators.islands import islands
from martkit.operators.joins import join_by_day, left_keep, missing_from, outer_metrics, resolve_items
from martkit.operators.latest import first, latest
from martkit.operators.neighbours import with_previous
from martkit.operators.pairs import in_same_group, undirected, without
from tests.conftest import plan, rows


def test_uuid5_equals_the_standard_library(spark):
    names = ["user_01", "ö", "", "10001"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["u"] for r in df.select("n", uuid5_key("n").alias("u")).collect()}
    assert got == {n: str(uuid.uuid5(uuid.UUID(ORDER_NAMESPACE), n)) for n in names}
    both = df.select(uuid5_key(F.lit("a"), F.lit("b")).alias("u")).first()["u"]
    assert both == str(uuid.uuid5(uuid.UUID(ORDER_NAMESPACE), "a|b"))


def test_hash_keys_keep_parts_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "abc")], "x string, y string")
    keys = df.select(hash_key("x", "y", algorithm="md5").alias("m"), uuid5_key("x", "y").alias("u")).collect()
    assert len({r["m"] for r in keys}) == 3 and len({r["u"] for r in keys}) == 3


def test_delimited_parts(spark):
    df = spark.createDataFrame([("12:A-1:0.05:0.1",), ("x:y",), (None,)], "t string")
    got = df.select(part("t", 1, as_type="int").alias("a"), part("t", 4, as_type="decimal(14,3)").alias("b")).collect()
    assert [(r["a"], None if r["b"] is None else float(r["b"])) for r in got] == [(12, 0.1), (None, None), (None, None)]


def test_time_rules(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-03-01 00:00:00' as ts union all select timestamp_ntz'2024-03-01 23:59:59' "
        "union all select timestamp_ntz'2024-03-02 00:00:00' union all select null"
    )
    assert on_day(df, "ts", "2024-03-01").count() == 2
    assert since(df, "ts", 1, "2024-03-02 12:00:00").count() == 2
    spans = spark.sql("select timestamp_ntz'2024-03-05 01:00:00' as b, timestamp_ntz'2024-03-01 02:00:00' as a")
    assert spans.select(whole_days(F.col("b"), F.col("a"))).first()[0] == 3
    live = spark.createDataFrame([(1, 5), (3, 5), (1, 3)], "s int, e int")
    assert rows(active_at(live, "s", "e", F.lit(3))) == [(1, 5)]
    zones = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' as t, z from values ('Australia/Perth'), (null) as v(z)")
    assert [str(r[0]) for r in zones.select(local_time(F.col("t"), F.col("z"))).collect()] == [
        "2024-01-01 08:00:00",
        "None",
    ]


def test_calendar_weeks_across_the_year(spark):
    days = {str(r["date_actual"]): r for r in calendar(spark, "2024-12-29", "2025-01-06").collect()}
    assert len(days) == 9 and days["2024-12-29"]["week_of_year"] == 52
    new_year = days["2025-01-01"]
    assert (new_year["week_of_year"], str(new_year["first_day_of_week"]), str(new_year["last_day_of_week"])) == (
        1,
        "2024-12-30",
        "2025-01-05",
    )


def test_latest_and_first_break_ties(spark):
    df = spark.createDataFrame(
        [(1, 5, 1, "a"), (1, 5, 2, "b"), (1, None, 9, "n"), (2, None, 1, "x")], "k int, t int, id int, v string"
    )
    assert rows(latest(df, "k", ["t", "id"]), "k", "v") == [(1, "b"), (2, "x")]
    assert rows(first(df, "k", ["t", "id"]), "k", "v") == [(1, "a"), (2, "x")]


def brute_islands(data):
    out, by_key = [], {}
    for k, t, v in data:
        by_key.setdefault(k, []).append((t, v))
    for k, seq in by_key.items():
        seq.sort(key=lambda r: r[0])
        runs = []
        for t, v in seq:
            if runs and runs[-1][0] == v:
                runs[-1][2] = t
                runs[-1][3] += 1
            else:
                runs.append([v, t, t, 1])
        out += [(k, i, v, a, b, n) for i, (v, a, b, n) in enumerate(runs)]
    return sorted(out, key=repr)


def test_islands_equal_a_scan_per_key(spark):
    rng = random.Random(5)
    # Key 0 holds half of the rows; values repeat across hours and may be null.
    data = [(0 if i % 2 else rng.randint(1, 4), i * 700, rng.choice([None, "a", "a", "b"])) for i in range(800)]
    df = spark.createDataFrame(data, "k int, s int, v string").withColumn(
        "ts", F.timestamp_seconds("s").cast("timestamp_ntz")
    )
    got = islands(df, "k", "ts", "v").select(
        "k",
        "island",
        "v",
        F.unix_seconds(F.col("first_at").cast("timestamp")).alias("a"),
        F.unix_seconds(F.col("last_at").cast("timestamp")).alias("b"),
        "n",
    )
    assert rows(got) == brute_islands(data)


def test_islands_window_is_cut_by_time(spark):
    df = spark.createDataFrame([(1, 1, "a")], "k int, s int, v string").withColumn("ts", F.timestamp_seconds("s"))
    assert "_slice" in plan(islands(df, "k", "ts", "v"))


def test_missing_from_sets_null_keys_aside(spark):
    new = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    old = spark.createDataFrame([(2,), (None,)], "k int")
    missing, nulls = missing_from(new, old, "k")
    assert rows(missing) == [(1,)] and rows(nulls) == [(None,)]


def test_outer_metrics_keeps_null_keys_and_missing_metrics(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([(None, 5), ("y", 6)], "k string, b int")
    assert rows(outer_metrics([a, b], ["k"])) == sorted([("x", 1, None), (None, 2, 5), ("y", None, 6)], key=repr)


def test_left_keep_and_join_by_day(spark):
    users = spark.createDataFrame([(1,), (2,)], "id int")
    orders = spark.createDataFrame([(1, "F"), (2, "O")], "id int, s string")
    assert rows(left_keep(users, orders, "id", F.col("s") == "F")) == sorted([(1, "F"), (2, None)], key=repr)
    facts = spark.sql("select timestamp_ntz'2024-01-01 10:00:00' as ts, 1 as c")
    dim = spark.sql("select date'2024-01-01' as d, 1 as c, 'v' as v")
    assert rows(join_by_day(facts, dim, "ts", "d", ["c"]), "v") == [("v",)]


def test_resolve_items_in_order_with_unknown_ones(spark):
    orders = spark.sql(
        """select 1 as object_id, 'r' as restaurant_id, array(named_struct('id','b','price',2,'quantity',1),
           named_struct('id','a','price',1,'quantity',3), named_struct('id','zz','price',1,'quantity',1)) as order_items
           union all select 2, 'unknown', array(named_struct('id','a','price',1,'quantity',1))
           union all select 3, 'r', null"""
    )
    restaurants = spark.sql(
        """select 'r' as id, 'R' as name, array(named_struct('_id','a','name','A','category','c1'),
           named_struct('_id','b','name','B','category','c2'), named_struct('_id','a','name','later','category','c3')) as menu"""
    )
    got = {r["object_id"]: r for r in resolve_items(orders, restaurants).collect()}
    assert [(p["id"], p["name"], p["category"]) for p in got[1]["products"]] == [
        ("b", "B", "c2"),
        ("a", "A", "c1"),
        ("zz", None, None),
    ]
    assert got[1]["unresolved"] == 1 and got[2]["unresolved"] == 1 and got[2]["restaurant_name"] is None
    assert got[3]["unresolved"] == 0


def test_only_keys_of_orders_are_looked_up(spark):
    line = "array<struct<id: string, price: int, quantity: int>>"
    data = [(1, "r", "u", "note", [("a", 2, 1)]), (2, "r", "u", "note", [("a", 2, 1)]), (3, None, "w", "note", None)]
    orders = spark.createDataFrame(data, f"object_id int, restaurant_id string, user_id string, note string, order_items {line}")
    menu = "array<struct<_id: string, name: string, category: string>>"
    restaurants = spark.createDataFrame([("r", "R", [("a", "A", "c")]), ("r", "S", [("b", "B", "c")])], f"id string, name string, menu {menu}")
    people = spark.createDataFrame([("u", "U"), ("v", "V")], "user_id string, user_name string")
    got = resolve_items(orders, restaurants, people)
    # A restaurant of two names gives a row for each, as a join does.
    want = [(n, r, "U", "note") for n in (1, 2) for r in ("R", "S")] + [(3, None, None, "note")]
    assert rows(got, "object_id", "restaurant_name", "user_name", "note") == sorted(want, key=repr)
    scans = [part.split("ReadSchema")[-1] for part in plan(got).split("FileScan")[1:]]
    assert sum("note" in scan for scan in scans) == 1


def test_group_statistics_with_null_group(spark):
    df = spark.createDataFrame([(1, 2), (1, 4), (None, 8)], "g int, v int")
    got = with_group_stat(df, "g", mean=F.avg("v"), n=F.count("*"))
    assert rows(got) == sorted([(1, 2, 3.0, 2), (1, 4, 3.0, 2), (None, 8, 8.0, 1)], key=repr)
    assert "Window" not in plan(got)


def test_small_aggregates(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (1, 1)], "r int, c int")
    assert rows(cross_tab(df, "r", "c", [1, 2, 3])) == [(1, 2, 1, 0), (2, 1, 0, 0)]
    assert rows(duplicates(df, ["r", "c"])) == [(1, 1, 1)]
    assert df.agg(ordered_list("c", "c").alias("l")).first()["l"] == [1, 1, 1, 2]
    assert difference(df, df.limit(1), F.count("*"), F.count("*"), "d").first()["d"] == 3


def test_pairs(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (None, 1)], "a int, b int")
    pairs = undirected(edges, "a", "b")
    assert rows(pairs) == [(2, 1), (3, 1)]
    assert rows(without(pairs, pairs.filter("user_left = 3"))) == [(2, 1)]
    members = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (1, "z"), (2, "z")], "user_id int, g string")
    assert rows(in_same_group(pairs, members, "g")) == [(2, 1)]


def test_the_row_before_spans_ranges(spark):
    pairs = [("hot", i, i % 3) for i in range(500)] + [("a", 1, 7), ("b", None, 8), ("b", 2, 9), (None, 1, 1), (None, 2, 2)]
    df = spark.createDataFrame(pairs, "k string, t int, v int").repartition(7)
    got = {(r["k"], r["t"]): (r["w"], r["_has_previous"]) for r in with_previous(df, ["k"], ["t"], {"w": "v"}).collect()}
    want, last = {}, {}
    for k, t, v in sorted(pairs, key=lambda p: (p[0] or "", -1 if p[1] is None else p[1])):
        want[(k, t)] = (last.get(k), k in last)
        last[k] = v
    assert got == want
    assert "hashpartitioning(k" not in plan(with_previous(df, ["k"], ["t"], {"w": "v"}))
    assert with_previous(df.limit(0), ["k"], ["t"], {"w": "v"}).count() == 0


def test_bitmaps_count_exactly(spark):
    df = spark.createDataFrame([("d1", 1), ("d1", 1), ("d1", 32768), ("d1", 32769), ("d2", 1), ("d2", 70000), ("d2", None)], "d string, n long")
    days = id_bitmaps(df, ["d"], "n")
    assert rows(distinct_counts(days, ["d"], "c")) == [("d1", 3), ("d2", 2)]
    assert rows(distinct_counts(united(days.withColumn("m", F.lit("m")), ["m"]), ["m"], "c")) == [("m", 4)]


def test_long_arrays_are_rows_of_bounded_size(spark):
    df = spark.range(25).select(F.lit("k").alias("k"), F.col("id").alias("at"), F.concat(F.lit("v"), "id").alias("v"))
    chunks = chunked_lists(df.unionByName(df.limit(1).withColumn("k", F.lit("one"))), ["k"], "at", "v", 10)
    assert rows(chunks.select("k", "chunk", F.size("values"))) == [("k", 0, 10), ("k", 1, 10), ("k", 2, 5), ("one", 0, 1)]
    joined = {r["k"]: r["all"] for r in joined_chunks(chunks, ["k"], "all").collect()}
    assert joined == {"k": [f"v{i}" for i in range(25)], "one": ["v0"]}


def test_sparse_sets_are_short(spark):
    """A set of few ids takes a number per 64 ids, not a bitmap of 4 KB."""
    df = spark.createDataFrame([("d1", 64), ("d1", 127), ("d1", 128), ("d2", 1 << 40), (None, 63)], "d string, n long")
    days = id_bitmaps(df, ["d"], "n")
    assert dict(days.dtypes)["bits"] == "bigint"
    assert rows(days.groupBy("d").count()) == sorted([("d1", 2), ("d2", 1), (None, 1)], key=repr)
    assert rows(distinct_counts(united(days, ["d"]), ["d"], "c")) == sorted([("d1", 3), ("d2", 1), (None, 1)], key=repr)


def test_one_row_per_key_sends_no_column_twice(spark):
    data = [(1, 1, "a", {"m": 1}), (1, 2, None, None), (1, None, "z", None), (2, None, "x", None), (2, None, None, None)]
    df = spark.createDataFrame(data, "k int, t int, v string, m map<string,int>")
    flat = df.drop("m")
    assert rows(latest(flat, "k", ["t", "v"])) == [(1, 2, None), (2, None, "x")]
    assert rows(first(flat, "k", ["t", "v"])) == [(1, 1, "a"), (2, None, "x")]
    assert rows(first(flat, "k", ["k", "v"])) == [(1, 1, "a"), (2, None, "x")]
    for pick in (latest, first):
        assert "_by(" not in plan(pick(flat, "k", ["t", "v"]))
        assert pick(df, "k", ["t", "v"]).drop("m").collect() == pick(flat, "k", ["t", "v"]).collect()
