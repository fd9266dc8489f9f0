import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.jsons import CORRUPT, parse_json_column, split_corrupt, to_message
from martkit.plans.staging import stage_csv
from martkit.sinks.files import (
    SnapshotTable,
    append_batch,
    register_views,
    replace_partition,
    write_full,
    write_layout,
)
from martkit.session import brief_shuffles, staged
from martkit.sinks.commits import CommitLog, written_at_once
from martkit.sinks.hashed import MOST_BUCKETS, HashedTable, hashed_table
from martkit.sinks.merge import CounterTable, accumulate, insert_missing, upsert
from martkit.sources.files import (
    increment_path,
    load_csv_day,
    load_csv_full,
    read_increment_csv,
    read_landed_pages,
    read_parquet,
    read_reference,
)
from martkit.sources.jdbc import day_predicates
from martkit.sources import pages
from martkit.sources.pages import read_json_pages
from martkit.sources.streams import kafka_options
from tests.conftest import plan, rows


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_daily_csv_drops_repeated_ids(spark, tmp_path):
    schema = "id int, date_time timestamp_ntz, status string"
    path = increment_path(str(tmp_path), "2024-03-05", "user_order_log.csv")
    assert path.endswith("inc-20240305/user_order_log.csv")
    put(path, "id,date_time,status\n1,2024-03-05 10:00:00,shipped\n1,2024-03-05 10:00:00,shipped\n2,2024-03-05 11:00:00,\n")
    got = read_increment_csv(spark, str(tmp_path), "2024-03-05", T._parse_datatype_string(schema))
    assert got.columns == ["date_time", "status"] and got.count() == 2


def test_csv_loads_split_unreadable_lines(spark, tmp_path):
    schema = T._parse_datatype_string("id int, name string, at timestamp_ntz")
    put(f"{tmp_path}/a.csv", "1,x,2024-01-01 00:00:00\nbad,y,2024-01-01 00:00:00\n")
    good, bad = load_csv_full(spark, f"{tmp_path}/a.csv", schema)
    assert good.select("id").collect()[0][0] == 1 and bad.count() == 1
    put(f"{tmp_path}/b.csv", "id,name,at\n1,null,2024-01-01 00:00:00\n")
    good, bad = load_csv_day(spark, f"{tmp_path}/b.csv", schema)
    assert good.first()["name"] is None and bad.count() == 0


def test_pages_and_reference_documents(spark, tmp_path):
    put(f"{tmp_path}/pages/0.json", json.dumps([{"order_id": "1", "delivery_ts": "2024-01-01 10:00:00"}]))
    put(f"{tmp_path}/pages/1.json", json.dumps([{"order_id": "2", "delivery_ts": "2024-01-09 10:00:00"}]))
    schema = T._parse_datatype_string("order_id string, delivery_ts string")
    assert read_landed_pages(spark, f"{tmp_path}/pages", schema).count() == 2
    assert rows(read_landed_pages(spark, f"{tmp_path}/pages", schema, since="2024-01-05"), "order_id") == [("2",)]
    put(f"{tmp_path}/ref/u.json", '{"id": "u1", "name": "N"}\n')
    assert rows(read_reference(spark, f"{tmp_path}/ref", T._parse_datatype_string("id string, name string"))) == [("u1", "N")]


@pytest.mark.parametrize("stretch", [7, 64, 1 << 20])
def test_pages_are_split_inside(spark, tmp_path, stretch):
    """Records of pages in several stretches, with braces and quotes in texts."""
    texts = ['plain', 'a } b', '{"k": "}"}', 'quote " here', 'back \\ slash', 'both \\" }{ "', 'é 漢 }', "line\nbreak }", "", "}" * 5, '"']
    records = [{"id": i, "t": texts[i % len(texts)], "in": {"deep": {"er": i}}} for i in range(60)]
    put(f"{tmp_path}/p/array.json", json.dumps(records))
    put(f"{tmp_path}/p/spread.json", json.dumps(records, indent=2, ensure_ascii=False) + "\n")
    put(f"{tmp_path}/p/lines.json", "\n".join(map(json.dumps, records)))
    put(f"{tmp_path}/p/empty.json", "[]")
    put(f"{tmp_path}/p/bad.json", '[{"id": 1, "t": "x"}, {"id": , "t": "}"}, {"id": 2, "t": "y"}, {"id": 3, "t": "cut}')
    schema = T._parse_datatype_string("id int, t string, in struct<deep: struct<er: int>>")
    good, broken = read_json_pages(spark, f"{tmp_path}/p", schema, stretch)
    want = [(r["id"], r["t"], r["id"]) for r in records] * 3 + [(1, "x", None), (2, "y", None)]
    assert rows(good.select("id", "t", "in.deep.er")) == sorted(want, key=repr)
    assert rows(broken, CORRUPT) == sorted([('{"id": , "t": "}"}',), ('{"id": 3, "t": "cut}',)], key=repr)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(stretch)


def test_json_column_accepts_single_quotes_and_keeps_bad_documents(spark):
    df = spark.createDataFrame([("{'a': 1}",), ('{"a": 2}',), ("{broken",)], "d string")
    good, bad = split_corrupt(parse_json_column(df, "d", T._parse_datatype_string("a int")))
    assert rows(good) == [(1,), (2,)] and bad.first()["_corrupt_record"] == "{broken"
    assert json.loads(to_message(good).orderBy("value").first()["value"]) == {"a": 1}


def test_connector_options():
    ranges = day_predicates("ts", "2024-01-01", slices=2)
    assert ranges[0].startswith("ts >= TIMESTAMP '2024-01-01 00:00:00") and ranges[1].endswith(
        "ts < TIMESTAMP '2024-01-02 00:00:00.000000'"
    )
    assert kafka_options("h:1", "t", 30)["maxOffsetsPerTrigger"] == "30"


def test_replacing_a_day_twice_changes_only_that_day(spark, tmp_path):
    path = f"{tmp_path}/t"
    data = spark.createDataFrame([(1, "d1"), (2, "d2"), (3, "d2")], "v int, ds string")
    replace_partition(data, path, "ds")
    fixed = spark.createDataFrame([(20, "d2")], "v int, ds string")
    for _ in range(2):
        replace_partition(fixed, path, "ds")
    assert rows(spark.read.parquet(path), "v", "ds") == [(1, "d1"), (20, "d2")]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    for _ in range(2):
        append_batch(spark.range(3), f"{tmp_path}/b", 0)
    append_batch(spark.range(2), f"{tmp_path}/b", 1)
    assert spark.read.parquet(f"{tmp_path}/b").count() == 5


def test_snapshot_can_be_rebuilt_from_itself(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/s")
    assert not table.exists()
    table.refresh(spark.range(3))
    table.refresh(table.read().filter("id > 0"))
    assert rows(table.read()) == [(1,), (2,)] and table.versions() == [1, 2]
    os.makedirs(f"{tmp_path}/s/v00000003")  # a version that was never finished
    assert rows(table.read()) == [(1,), (2,)]


def test_upsert_rules(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 5, "keep"), (3, 1, "tie")], "k int, t int, v string")
    new = spark.createDataFrame([(1, 2, "b"), (1, 3, "c"), (2, 4, "late"), (3, 1, "new"), (4, 1, "d")], "k int, t int, v string")
    got = upsert(old, new, "k", "t")
    assert rows(got, "k", "v") == [(1, "c"), (2, "keep"), (3, "new"), (4, "d")]
    assert rows(upsert(got, new, "k", "t")) == rows(got)


def test_an_upsert_opens_and_writes_touched_buckets_only(spark, tmp_path):
    table = hashed_table(spark, f"{tmp_path}/u", "k", "t", bits=4, most_parts=3)
    assert table.read() is None and table.near(spark.range(1), "id") is None
    table.upsert(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("t"), F.lit("old").alias("v")))
    parts = lambda: {p["path"] for p in table.log.state()["tables"]["rows"]["parts"]}
    before = parts()
    update = spark.createDataFrame([(5, 2, "new"), (5, 1, "older")], "k int, t int, v string")
    table.upsert(update)
    assert before < parts() and len(parts() - before) == 1  # one delta file, nothing rewritten
    near = table.near(update)
    opened = {f.split("_bucket=")[1].split("/")[0] for f in near.inputFiles()}
    assert len(opened) == 1 and 1 < near.count() < 50
    table.upsert(spark.createDataFrame([(100, 1, "added"), (6, 1, "tie")], "k bigint, t int, v string"))
    got = {r["k"]: r["v"] for r in table.read().collect()}
    assert len(got) == 101 and got[5] == "new" and got[100] == "added" and got[6] == "tie" and got[7] == "old"
    for _ in range(3):  # a bucket of many parts becomes one again
        table.upsert(update)
    counts = [sum(p["bucket"] == b for p in table.log.state()["tables"]["rows"]["parts"]) for b in table.buckets()]
    assert max(counts) <= 3 and {r["k"]: r["v"] for r in table.read().collect()} == got


def test_buckets_split_as_they_grow(spark, tmp_path):
    table = hashed_table(spark, f"{tmp_path}/u", "k", "t", limit=100, bits=0)
    numbers = lambda n, t: spark.range(n).select(F.col("id").alias("k"), F.lit(t).alias("t"))
    table.upsert(numbers(80, 1))
    assert table.buckets() == {"b": 80}
    table.upsert(numbers(2000, 2))
    sizes = table.buckets()
    assert sum(sizes.values()) == 2000 and max(sizes.values()) <= 100 and table.read().filter("t = 2").count() == 2000
    # Rows of one key cannot be split, and are not tried again.
    log = hashed_table(spark, f"{tmp_path}/one", "k", None, limit=10, bits=1)
    log.upsert(spark.range(50).select(F.lit(1).alias("k"), "id"))
    versions = log.log.versions()
    log.maintain()
    assert log.read().count() == 50 and log.log.versions() == versions


def test_tables_in_the_same_buckets_join_without_a_shuffle(spark, tmp_path):
    for name in ("left_side", "right_side"):
        write_layout(spark.range(1000).select("id", F.lit(name).alias(name)), name, bucket_by=["id"], sort_by=["id"], buckets=4, path=f"{tmp_path}/{name}")
    joined = spark.table("left_side").join(spark.table("right_side").hint("merge"), "id").groupBy("id").count()
    assert "Exchange" not in plan(joined) and joined.count() == 1000
    for name in ("left_side", "right_side"):
        spark.sql(f"drop table {name}")


def test_insert_missing_keeps_the_first(spark):
    held = spark.createDataFrame([(1, 1, "held")], "k int, t int, v string")
    new = spark.createDataFrame([(1, 0, "x"), (2, 3, "second"), (2, 2, "first"), (None, 1, "null")], "k int, t int, v string")
    assert rows(insert_missing(held, new, "k", "t")) == [(2, 2, "first")]


def test_counters_count_each_batch_once(spark, tmp_path):
    one = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, n int")
    assert rows(accumulate(one, one, "k", "n")) == [("a", 4), ("b", 2)]
    table = CounterTable(spark, f"{tmp_path}/c", "k", "n")
    table.add(one, 0)
    table.add(one, 0)
    assert rows(table.read()) == [("a", 2), ("b", 1)]
    table.compact()
    table.add(one, 0)
    table.add(one, 1)
    assert rows(table.read()) == [("a", 4), ("b", 2)]
    table.compact()
    assert rows(table.read()) == [("a", 4), ("b", 2)]


def test_staging_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    was = spark.conf.get(setting, None)
    counts = written_at_once({k: lambda k=k: staged(spark.range(1000).groupBy(F.col("id") % k).count(), "counts").count() for k in (3, 5, 7)})
    assert counts == {3: 3, 5: 5, 7: 7}
    shuffled = files()
    staged(spark.range(1000).groupBy(F.col("id") % 11).count(), "counts")
    assert files() <= shuffled
    with brief_shuffles(spark):
        with brief_shuffles(spark):
            assert spark.conf.get(setting) == "true"
        assert spark.conf.get(setting) == "true"
        again = spark.range(1000).groupBy(F.col("id") % 9).count()
    assert len(again.collect()) == len(again.collect()) == 9
    assert spark.conf.get(setting, None) == was


def test_layouts_and_views(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("ds"))
    write_layout(df, f"{tmp_path}/p", partition_by=["ds"], sort_by=["id"])
    assert read_parquet(spark, f"{tmp_path}/p").filter("ds = 1").count() == 33
    write_full(df, f"{tmp_path}/w")
    write_full(df.limit(1), f"{tmp_path}/w")
    assert read_parquet(spark, f"{tmp_path}/w").count() == 1
    write_layout(df, "bucketed", bucket_by=["id"], sort_by=["id"], buckets=4)
    joined = spark.table("bucketed").join(spark.table("bucketed").select(F.col("id")), "id").hint("merge")
    assert joined.count() == 100
    register_views({"users_v": (df, ["id"])})
    assert spark.table("users_v").columns == ["id"]
    spark.sql("drop table bucketed")


@pytest.fixture()
def chat_files(tmp_path):
    put(f"{tmp_path}/in/users.csv", "1,ann,2024-01-01 00:00:00,AU,30\n2,bob,2024-01-02 00:00:00,AU,40\nx,bad,,,\n")
    put(f"{tmp_path}/in/groups.csv", "10,1,g,2024-01-01 00:00:00,true\n11,9,orphan,2024-01-01 00:00:00,false\n")
    put(f"{tmp_path}/in/dialogs.csv", "100,2024-01-03 00:00:00,1,2,hi,10\n101,2024-01-03 00:00:00,1,2,hello,\n")
    put(f"{tmp_path}/in/group_log.csv", "10,2,1,add,2024-01-02 00:00:00\n")
    return f"{tmp_path}/in", f"{tmp_path}/out"


def test_chat_tables_are_staged_and_bad_rows_set_aside(spark, chat_files):
    for _ in range(2):
        staged, rejected = stage_csv(spark, *chat_files)
    assert {n: df.count() for n, df in staged.items()} == {"users": 2, "groups": 1, "dialogs": 2, "group_log": 1}
    assert rows(rejected["users"], "reason") == [("unreadable",)]
    assert rows(rejected["groups"], "reason") == [("references:admin_id",)]


def test_stretches_grow_with_the_pages(spark, tmp_path):
    put(f"{tmp_path}/p/big.json", json.dumps([{"id": i, "t": "a } b"} for i in range(4000)]))
    put(f"{tmp_path}/p/small.json", json.dumps([{"id": i, "t": "x"} for i in range(5)]))
    size = sum(os.path.getsize(f"{tmp_path}/p/{name}") for name in ("big.json", "small.json"))
    assert pages._grown(spark, f"{tmp_path}/p", 16) == size // pages.MOST_STRETCHES > 16
    assert pages._grown(spark, f"{tmp_path}/p", 1 << 20) == 1 << 20 and pages._grown(spark, f"{tmp_path}/p", None) is None
    good, broken = read_json_pages(spark, f"{tmp_path}/p", T._parse_datatype_string("id int, t string"), 16)
    assert broken.count() == 0 and good.count() == 4005 and good.agg(F.sum("id")).first()[0] == sum(range(4000)) + 10


def test_buckets_grow_with_a_large_table(spark, tmp_path):
    table = hashed_table(spark, f"{tmp_path}/u", "k", "t", limit=1, bits=1, most_parts=4)
    numbers = lambda a, b, t: spark.range(a, b).select(F.col("id").alias("k"), F.lit(t).alias("t"))
    for n, t in ((3000, 1), (6000, 2)):
        table.upsert(numbers(0, n, t))
    sizes = table.buckets()
    assert 8 <= len(sizes) <= 8 * MOST_BUCKETS and sum(sizes.values()) >= 6000
    assert rows(table.read().groupBy("t").count()) == [(2, 6000)]


def test_first_batches_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    frame = type(spark.range(1))
    hints, hint = [], frame.hint
    monkeypatch.setattr(frame, "hint", lambda df, name, *args: hints.append(name) or hint(df, name, *args))
    log = CommitLog(spark, f"{tmp_path}/t")
    table = HashedTable(log, "rows", "id", limit=100, bits=1)
    data = spark.range(0, 3000, 1, 4).withColumn("text", F.sha1(F.col("id").cast("string")))
    log.commit(log.state(), {"rows": table.added(data, log.state())})
    table.maintain()  # from two buckets to many, by tasks that hold whole buckets
    counters = CounterTable(spark, f"{tmp_path}/c", "id", "n")
    counters.add(data.select("id", F.lit(1).alias("n")), 0)
    assert "rebalance" not in hints
    assert rows(table.read()) == rows(data) and counters.read().count() == 3000
    parts = log.state()["tables"]["rows"]["parts"]
    files = [f"{p['path']}/{f}" for p in parts for f in os.listdir(p["path"].removeprefix("file:")) if f.endswith(".parquet")]
    assert len(parts) > 8 and len(files) == len(parts)
    assert pq.ParquetFile(files[0].removeprefix("file:")).metadata.row_group(0).column(0).compression == "ZSTD"
    log.commit(log.state(), {"rows": table.added(data.limit(50), log.state())})
    assert "rebalance" in hints  # one file a bucket where there are many
