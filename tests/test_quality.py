import pytest
from pyspark.sql import functions as F

from martkit.quality import checks as dq
from martkit.quality import constraints
from martkit.quality.expectations import ConstraintViolation, Expectations, enforce
from tests.conftest import rows


def test_each_kind_of_check_finds_its_rows(spark):
    good = spark.createDataFrame([(1, 2, 3.0), (2, 5, 4.0)], "k int, v int, w double")
    bad = spark.createDataFrame([(1, None, 3.0), (1, 9, 4.0), (None, -1, 5.0)], "k int, v int, w double")
    parents = spark.createDataFrame([(1,), (None,)], "k int")
    made = [
        dq.not_null("nulls", "t", "k", "v"),
        dq.in_range("range", "t", 0, 5, "v"),
        dq.recompute_within("formula", "t", 0.01, (F.col("w"), F.col("v") + 1.0)),
        dq.unique_key("unique", "t", "k"),
        dq.references("parents", "t", ("k", "p")),
        dq.row_count_equals("count", "t", "p"),
        dq.row_count_equals("distinct", "t", "p", distinct="k"),
        dq.not_empty("filled", "t"),
    ]
    report = {r["check_name"]: (r["measured_value"], r["status"]) for r in dq.run_checks({"t": bad, "p": parents}, made).collect()}
    assert report == {
        "nulls": (2, "FAILED"),
        "range": (2, "FAILED"),
        "formula": (2, "FAILED"),
        "unique": (1, "FAILED"),
        "parents": (0, "PASSED"),
        "count": (1, "FAILED"),
        "distinct": (0, "PASSED"),
        "filled": (3, "PASSED"),
    }
    some = dq.run_checks({"t": good, "p": parents}, [made[0], made[1], made[4], made[7]])
    assert rows(some, "check_name", "measured_value") == [("filled", 2), ("nulls", 0), ("parents", 1), ("range", 0)]
    empty = dq.run_checks({"t": good.limit(0), "p": parents}, [made[7], made[3]]).collect()
    assert [r["status"] for r in empty] == ["FAILED", "PASSED"]


def test_constraints_set_rows_aside_or_fail(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 11, "b"), (2, None, "c"), (3, 99, "too long"), (4, 10, "d")], "k int, f int, s string")
    parent = spark.createDataFrame([(10,), (11,)], "id int")
    rules = Expectations(not_null=["k"], checks={"k": F.col("k") < 4}, max_length={"s": 5}, unique=[["k"]], references={"f": (parent, "id")})
    good, bad = enforce(df, rules, mode="quarantine")
    assert rows(good) == [(2, None, "c")]
    assert {r["s"]: r["violated"] for r in bad.collect()} == {
        "a": ["unique:k"],
        "b": ["unique:k"],
        "too long": ["length:s", "references:f"],
        "d": ["check:k"],
    }
    with pytest.raises(ConstraintViolation, match="unique:k"):
        enforce(df, rules)
    assert enforce(good, rules)[0].count() == 1


def test_target_constraints(spark):
    scores = spark.createDataFrame([(1, 1, 5, 3), (2, 0, 1, 1)], "user_id int, recency int, frequency int, monetary_value int")
    good, bad = enforce(scores, constraints.rfm_segments(), mode="quarantine")
    assert good.count() == 1 and bad.first()["violated"] == ["check:recency_range"]
    pairs = spark.createDataFrame([(1, 7), (2, 8)], "delivery_id int, courier_id int")
    details = pairs.select("*", F.lit("t").alias("delivery_ts"), F.lit(6).alias("rate"))
    _, bad = enforce(details, constraints.delivery_details(spark.createDataFrame([(7,)], "courier_id int")), mode="quarantine")
    assert sorted(r["violated"] for r in bad.collect()) == [["check:rate"], ["check:rate", "references:courier_id"]]
