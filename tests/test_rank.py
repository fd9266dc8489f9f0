import random

import pytest
from pyspark.sql import functions as F

from martkit.operators.ordering import Key
from martkit.operators.rank import global_ntile, global_ntiles, global_row_number, surrogate_key, tile_starts, top_n
from tests.conftest import plan


def expected_tiles(ids, n):
    size, extra = divmod(len(ids), n)
    tiles, at = {}, 0
    for tile in range(1, n + 1):
        step = size + (1 if tile <= extra else 0)
        tiles.update({i: tile for i in ids[at : at + step]})
        at += step
    return tiles


@pytest.mark.parametrize("total,n", [(0, 5), (1, 5), (4, 5), (5, 5), (13, 5), (1000, 7)])
def test_tile_starts_follow_sql(total, n):
    tiles = expected_tiles(list(range(total)), n)
    starts = [i for i in range(1, total) if tiles[i] != tiles[i - 1]]
    assert tile_starts(total, n) == starts


def test_ntile_with_heavy_ties_and_nulls(spark):
    rng = random.Random(3)
    # A third of the rows share one value, some are null.
    data = [(i, None if i % 11 == 0 else (7 if i % 3 == 0 else rng.randint(0, 50))) for i in range(3001)]
    df = spark.createDataFrame(data, "id bigint, v int").repartition(5)
    got = {r["id"]: r["tile"] for r in global_ntile(df, 5, ["v", "id"]).collect()}
    ids = [i for i, _ in sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))]
    assert got == expected_tiles(ids, 5)


def test_ntile_descending_nulls_last_and_text(spark):
    data = [(i, None if i % 5 == 0 else f"é{i % 17}") for i in range(200)]
    df = spark.createDataFrame(data, "id bigint, v string")
    order = [Key("v", ascending=False, nulls_first=False), Key("id")]
    got = {r["id"]: r["tile"] for r in global_ntile(df, 4, order).collect()}
    ranked = df.orderBy(F.col("v").desc_nulls_last(), "id").collect()
    assert got == expected_tiles([r["id"] for r in ranked], 4)


def test_ntile_by_instants_doubles_and_bytes(spark):
    df = spark.range(400).select(
        "id",
        F.timestamp_seconds(F.col("id") * 977 % 60 * 600).alias("at"),
        F.when(F.col("id") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 7).alias("x"),
        F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("raw"),
    )
    for name in ("at", "x", "raw"):
        tiled = global_ntile(df, 3, [name, "id"])
        ids = [r["id"] for r in df.orderBy(F.col(name).asc_nulls_first(), "id").collect()]
        assert {r["id"]: r["tile"] for r in tiled.collect()} == expected_tiles(ids, 3)


def test_ntile_with_all_rows_equal_but_the_tie(spark):
    df = spark.range(2000).select("id", F.lit(1).alias("v"))
    tiled = global_ntiles(df, 5, {"a": ["v", "id"]})
    assert {r["a"]: r["n"] for r in tiled.groupBy("a").agg(F.count("*").alias("n")).collect()} == {
        i: 400 for i in range(1, 6)
    }


def test_ntile_of_few_and_no_rows(spark):
    few = spark.range(3).select("id")
    assert sorted(tuple(r) for r in global_ntile(few, 5, "id").collect()) == [(0, 1), (1, 2), (2, 3)]
    assert global_ntile(few.limit(0), 5, "id").collect() == []


def test_ntile_does_not_shuffle_the_table(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("v"))
    assert "Exchange" not in plan(global_ntile(df, 5, ["v", "id"]))


def test_row_numbers_are_dense_and_ordered(spark):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 4).alias("v")).repartition(7)
    numbered = global_row_number(df, ["v", "id"])
    got = [r["id"] for r in numbered.orderBy("rn").collect()]
    assert [r["rn"] for r in numbered.orderBy("rn").collect()] == list(range(1, 5001))
    assert got == [r["id"] for r in df.orderBy("v", "id").collect()]
    assert "SinglePartition" not in plan(numbered)


def test_surrogate_key_does_not_depend_on_row_order(spark):
    data = [("b", 1), ("a", 2), ("a", 1), (None, 3)]
    keyed = lambda rows: {
        (r["n"], r["x"]): r["sk"]
        for r in surrogate_key(spark.createDataFrame(rows, "n string, x int"), ["n", "x"], "sk").collect()
    }
    assert keyed(data) == keyed(data[::-1]) == {(None, 3): 1, ("a", 1): 2, ("a", 2): 3, ("b", 1): 4}


def test_top_n_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(3, 1), (1, 1), (2, 1), (4, 0)], "id int, v int")
    assert [r["id"] for r in top_n(df, 3, "v", "id").collect()] == [4, 1, 2]
