import os

from pyspark.sql import functions as F

from martkit.functions.keys import hash_key, joined, uuid5_key
from martkit.plans.conversion import group_conversion, load_community_vault
from martkit.session import passing_tables, staged, work_dir
from martkit.sinks.commits import CommitLog, written_at_once
from martkit.sinks.hashed import HashedTable
from martkit.vault import loaders
from martkit.vault.loaders import load_hub, load_link, load_satellite, merged
from tests.conftest import plan, rows



def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def test_hub_takes_new_keys_once(spark):
    day = stamp("2024-01-01 00:00:00")
    rows_ = spark.createDataFrame([(1, 5), (1, 3), (None, 1), (2, 1)], "id int, at int")
    first = load_hub(None, rows_, "id", "hk", ["at"], "src", day)
    assert rows(first, "id", "at") == [(1, 3), (2, 1)]
    again = load_hub(first, rows_.unionByName(spark.createDataFrame([(3, 1)], "id int, at int")), "id", "hk", ["at"], "src", day)
    assert rows(again, "id") == [(3,)]


def test_link_needs_its_parents(spark):
    day = stamp("2024-01-01 00:00:00")
    users = load_hub(None, spark.createDataFrame([(1,), (2,)], "u int"), "u", "hk_u", [], "s", day)
    groups = load_hub(None, spark.createDataFrame([(7,)], "g int"), "g", "hk_g", [], "s", day)
    data = spark.createDataFrame([(1, 7), (1, 7), (2, 8), (3, 7), (None, 7)], "u int, g int")
    link = load_link(None, data, "hk", {"hk_g": "g", "hk_u": "u"}, "s", day, hubs={"hk_g": groups, "hk_u": users})
    assert link.count() == 1
    assert load_link(link, data, "hk", {"hk_g": "g", "hk_u": "u"}, "s", day, hubs={"hk_g": groups, "hk_u": users}).count() == 0


def test_satellite_modes(spark):
    day = stamp("2024-01-01 00:00:00")
    seen = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, "a"), (2, 1, "x"), (2, 9, "x")], "hk int, t int, v string"
    ).withColumn("at", F.timestamp_seconds(F.col("t") * 5000).cast("timestamp_ntz"))
    first = load_satellite(None, seen, "hk", ["v"], "s", day, mode="first", order_by="at")
    assert rows(first, "hk", "v") == [(1, "a"), (2, "x")]
    assert load_satellite(first, seen, "hk", ["v"], "s", day, mode="first", order_by="at").count() == 0

    events = load_satellite(None, seen.unionByName(seen), "hk", ["v", "at"], "s", day, mode="event", event_cols=["at", "v"])
    assert events.count() == 6
    assert load_satellite(events, seen, "hk", ["v", "at"], "s", day, mode="event", event_cols=["at", "v"]).count() == 0

    changes = load_satellite(None, seen, "hk", ["v"], "s", day, mode="hashdiff", order_by=["at", "t"])
    assert [v for _, _, v in rows(changes, "hk", "at", "v")] == ["a", "b", "a", "x"]
    later = spark.createDataFrame([(1, 20, "a"), (1, 21, "c"), (2, 20, "y"), (3, 20, "n")], "hk int, t int, v string")
    later = later.withColumn("at", F.timestamp_seconds(F.col("t") * 5000).cast("timestamp_ntz"))
    more = load_satellite(changes, later, "hk", ["v"], "s", day, mode="hashdiff", order_by=["at", "t"])
    assert rows(more, "hk", "v") == [(1, "c"), (2, "y"), (3, "n")]
    both = merged(changes, more)
    assert load_satellite(both, later.filter("hk > 1"), "hk", ["v"], "s", day, mode="hashdiff", order_by=["at", "t"]).count() == 0


def community(spark):
    users = spark.createDataFrame([(i, f"u{i}", f"2024-01-0{i} 00:00:00", "AU", 20 + i) for i in range(1, 6)], "id int, chat_name string, t string, country string, age int")
    groups = spark.createDataFrame(
        [(10, 1, "old", "2024-01-01 00:00:00", True), (11, 2, "new", "2024-01-05 00:00:00", False)],
        "id int, admin_id int, group_name string, t string, is_private boolean",
    )
    dialogs = spark.createDataFrame(
        [(100, "2024-01-06 00:00:00", 1, 2, "m", 10), (101, "2024-01-06 00:00:00", 2, 1, "m", 10), (102, "2024-01-06 00:00:00", 3, 1, "m", 10), (103, "2024-01-07 00:00:00", 1, 2, "m", None)],
        "message_id int, t string, message_from int, message_to int, message string, message_group int",
    )
    log = spark.createDataFrame(
        [(10, 2, 1, "add", "2024-01-02 00:00:00"), (10, 2, 1, "add", "2024-01-02 00:00:00"), (10, 3, 1, "add", "2024-01-03 00:00:00"), (11, 4, 2, "add", "2024-01-06 00:00:00"), (11, 5, 2, "leave", "2024-01-07 00:00:00"), (12, 1, 1, "add", "2024-01-07 00:00:00")],
        "group_id int, user_id int, user_id_from int, event string, t string",
    )
    at = lambda df, name: df.withColumn(name, F.to_timestamp_ntz("t")).drop("t")
    return {
        "users": at(users, "registration_dt"),
        "groups": at(groups, "registration_dt"),
        "dialogs": at(dialogs, "message_ts"),
        "group_log": at(log, "datetime_"),
    }


def test_community_vault_and_conversion(spark):
    staging = community(spark)
    vault = load_community_vault(staging, stamp("2024-02-01 00:00:00"))
    sizes = {n: df.count() for n, df in vault.items()}
    assert sizes == {
        "h_users": 5, "h_dialogs": 4, "h_groups": 2, "l_admins": 2, "l_groups_dialogs": 3, "l_user_message": 4,
        "l_user_group_activity": 4, "s_admins": 2, "s_group_name": 2, "s_group_private_status": 2, "s_dialog_info": 4,
        "s_user_socdem": 5, "s_user_chatinfo": 5, "s_auth_history": 4,
    }
    again = load_community_vault(staging, stamp("2024-03-01 00:00:00"), vault, tables=["l_admins", "s_auth_history", "s_user_socdem"])
    assert {n: df.count() for n, df in again.items()} == {n: sizes[n] for n in again}
    assert "l_user_message" not in again
    got = rows(group_conversion(vault), "cnt_added_users", "cnt_users_in_group_with_messages", "group_conversion")
    assert got == sorted([(2, 3, 1.5), (1, None, None)], key=repr)
    assert rows(group_conversion(vault, n=1), "cnt_added_users") == [(2,)]


def test_links_look_up_parents_with_one_hash_at_a_time(spark):
    day = stamp("2024-01-01 00:00:00")
    users = spark.createDataFrame([(1,), (2,)], "u int").select(hash_key("u").alias("hk_u"))
    groups = spark.createDataFrame([(7,)], "g int").select(hash_key("g").alias("hk_g"))
    data = spark.createDataFrame([(1, 7), (2, 8), (3, 7), (2, 7)], "u int, g int")
    link = load_link(None, data, "hk", {"hk_g": "g", "hk_u": "u"}, "s", day, hubs={"hk_g": groups, "hk_u": users})
    want = data.filter("u < 3 and g = 7").select(hash_key("g").alias("hk_g"), hash_key("u").alias("hk_u"))
    assert rows(link, "hk_g", "hk_u") == rows(want)
    lines = plan(link).splitlines()
    below = lines[next(i for i, line in enumerate(lines) if "LeftSemi" in line) + 1 :]
    assert below and max(line.count("xxhash64(") for line in below) == 1


def test_link_hashes_parents_of_new_rows_only(spark):
    day = stamp("2024-01-01 00:00:00")
    data = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 1)], "g int, u int")
    parents = {"hk_g": "g", "hk_u": "u"}
    held = load_link(None, data.filter("u = 1"), "hk", parents, "s", day)
    fresh = load_link(held, data, "hk", parents, "s", day)
    assert rows(merged(held, fresh).drop("load_dt")) == rows(load_link(None, data, "hk", parents, "s", day).drop("load_dt"))
    text = plan(fresh)
    assert "AS hk_u" in text[: text.index("Join")] and "AS hk_u" not in text[text.index("Join") :]


def test_keys_are_hashed_once_rows_are_reduced(spark, tmp_path):
    day = stamp("2024-01-01 00:00:00")
    spark.range(40).select((F.col("id") % 5).alias("g"), (F.col("id") % 3).alias("u")).write.parquet(f"{tmp_path}/rows")
    data = spark.read.parquet(f"{tmp_path}/rows")
    load_hub(None, data.filter("g < 2"), "g", "hk", [], "s", day).write.parquet(f"{tmp_path}/held")
    held = spark.read.parquet(f"{tmp_path}/held")
    fresh = load_hub(held, data, "g", "hk", [], "s", day)
    assert rows(fresh, "g") == [(2,), (3,), (4,)]
    assert rows(load_hub(held.unionByName(held), data, "g", "hk", [], "s", day), "g") == rows(fresh, "g")
    lines = fresh._jdf.queryExecution().optimizedPlan().toString().splitlines()
    reduced = next(i for i, line in enumerate(lines) if "Aggregate" in line)
    assert "xxhash64" in "".join(lines[: reduced + 1]) and "xxhash64" not in "".join(lines[reduced + 1 :])


def test_steady_keys_of_satellites_are_not_put_in_order(spark, monkeypatch):
    day = stamp("2024-01-01 00:00:00")
    at = F.to_timestamp_ntz(F.concat(F.lit("2024-02-"), "t"))
    data = lambda *r: spark.createDataFrame(list(r), "id string, t string, v string").withColumn("at", at).drop("t")
    load = lambda held, new: load_satellite(held, new, "hk", ["v"], "s", day, mode="hashdiff", order_by="at", key="id", key_of=key_of)
    new = data(("a", "05", "x"), ("b", "05", "y"), ("c", "01", "x"), ("d", "05", "x"), ("e", None, "x"), ("f", "05", None), ("g", "05", "x"))
    for key_of in (uuid5_key, hash_key, plain):
        held = load(None, data(("a", "03", "x"), ("b", "03", "x"), ("c", "03", "x"), ("e", "03", "x"), ("f", "03", None), ("g", None, "x")))
        several = load(held, data(("b", "04", "z"), ("b", "06", "y")))
        assert rows(several, "v") == [("y",), ("z",)]
        with monkeypatch.context() as m:
            m.setattr(loaders, "with_previous", None)
            fresh = load(held, new)
            want = new.filter("id in ('b', 'c', 'd', 'e')").select(key_of("id").alias("hk"), "at", "v")
            assert rows(fresh, "hk", "at", "v") == rows(want)
            assert rows(fresh.select(key_of("hk", "v").alias("h"))) == rows(fresh, "hk_hashdiff" if "hk_hashdiff" in fresh.columns else "hash_diff")
        # Known rows that differ are put in order with the new ones.
        assert rows(load(merged(held, several), data(("b", "05", "z"), ("b", "07", "y"), ("c", "02", "x"))), "v", "at") == rows(
            data(("c", "02", "x")), "v", "at"
        )


def test_new_keys_meet_known_ones_in_short_form(spark):
    day = stamp("2024-01-01 00:00:00")
    data = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y"), ("c", "y"), ("c", "y")], "g string, u string")
    text = lambda *cols: F.concat(F.lit("00000000-0000-0000-0000-00000000000A"), joined(*cols))
    for key_of in (uuid5_key, hash_key, text):
        parents = {"hk_g": "g", "hk_u": "u"}
        held = load_link(None, data.filter("g <> 'c'"), "hk", parents, "s", day, key_of=key_of)
        fresh = load_link(held, data, "hk", parents, "s", day, key_of=key_of)
        want = data.filter("g = 'c'").distinct().select(key_of(key_of("g"), key_of("u")).alias("hk"), key_of("g").alias("hk_g"), key_of("u").alias("hk_u"))
        assert rows(fresh, "hk", "hk_g", "hk_u") == rows(want)
        assert ("unhex" in plan(fresh)) == (key_of is not hash_key)


def test_rows_of_a_batch_are_reduced_once_and_not_kept(spark, tmp_path):
    day = stamp("2024-01-01 00:00:00")
    data = spark.range(60).select((F.col("id") % 7).alias("g"))
    table = HashedTable(CommitLog(spark, f"{tmp_path}/log"), "h", "hk")
    load = lambda rows: load_hub(table, rows, "g", "hk", [], "s", day)
    staged_now = lambda: set(os.listdir(work_dir(spark).removeprefix("file:"))) if os.path.isdir(work_dir(spark)) else set()
    table.upsert(load(data.filter("g < 5")))
    before = staged_now()
    with passing_tables(spark):
        fresh = load(data)
        assert "Aggregate" not in plan(fresh) and staged_now() > before
        assert rows(fresh, "g") == [(5,), (6,)]
        done = written_at_once({n: lambda: staged(fresh, "copy").count() for n in ("a", "b")})
        assert done == {"a": 2, "b": 2} and len(staged_now() - before) == 3
    assert staged_now() == before


def plain(*cols):
    """Keys as text that only look like a UUID."""
    return F.concat_ws("|", F.lit("00000000-0000-0000-0000-00000000000A"), *[F.coalesce(F.col(c), F.lit("-")) for c in cols])
