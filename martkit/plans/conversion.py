"""Community vault and group conversion (M-19..M-24)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.keys import hash_key
from martkit.functions.money import ratio
from martkit.operators.rank import top_n
from martkit.vault.loaders import load_hub, load_link, load_satellite, merged

SOURCE = "s3"  # Fixed value: load source of the community vault.


def load_community_vault(
    staging: dict[str, DataFrame],
    load_ts: Column,
    existing: dict[str, DataFrame] | None = None,
    algorithm: str = "xxhash64",
    tables=None,
    save=None,
) -> dict[str, DataFrame]:
    """Three hubs, four links, seven satellites after loading the staging
    tables users, groups, dialogs and group_log.

    ``tables`` names those wanted, their parents are added. ``save(df, name)``
    stores a table that others refer to and returns the stored one.
    """
    old = existing or {}
    wanted = _with_parents(_PARENTS if tables is None else tables)
    key_of = partial(hash_key, algorithm=algorithm)
    users, groups = staging["users"], staging["groups"]
    dialogs, log = staging["dialogs"], staging["group_log"]
    vault: dict[str, DataFrame] = {}

    def keep(name, fresh):
        table = merged(old.get(name), fresh)
        vault[name] = save(table, name) if save and name in _REFERRED else table

    def hub(name, rows, key, source_key, hk, attrs):
        if name not in wanted:
            return
        rows = rows.withColumnRenamed(source_key, key) if source_key != key else rows
        fresh = load_hub(old.get(name), rows, key, hk, attrs, SOURCE, load_ts, key_of=key_of)
        keep(name, fresh)

    def link(name, rows, hk, parents):
        if name not in wanted:
            return
        hubs = {p: vault[_HUB_OF[p]] for p in parents}
        fresh = load_link(old.get(name), rows, hk, parents, SOURCE, load_ts, hubs=hubs, key_of=key_of)
        keep(name, fresh)

    def satellite(name, rows, hk, attrs, parent=None, **how):
        if name not in wanted:
            return
        fresh = load_satellite(
            old.get(name), rows, hk, attrs, SOURCE, load_ts, parent=vault[parent] if parent else None, **how
        )
        keep(name, fresh)

    hub("h_users", users, "user_id", "id", "hk_user_id", ["registration_dt"])
    hub("h_dialogs", dialogs, "message_id", "message_id", "hk_message_id", ["message_ts"])
    hub("h_groups", groups, "group_id", "id", "hk_group_id", ["registration_dt"])

    link("l_admins", groups, "hk_l_admin_id", {"hk_group_id": "id", "hk_user_id": "admin_id"})
    link(
        "l_groups_dialogs",
        dialogs,
        "hk_l_groups_dialogs",
        {"hk_group_id": "message_group", "hk_message_id": "message_id"},
    )
    link(
        "l_user_message", dialogs, "hk_l_user_message", {"hk_user_id": "message_from", "hk_message_id": "message_id"}
    )
    activity = {"hk_group_id": "group_id", "hk_user_id": "user_id"}
    link("l_user_group_activity", log, "hk_l_user_group_activity", activity)

    if "s_admins" in wanted:
        since = vault["h_groups"].select("hk_group_id", F.col("registration_dt").alias("admin_from"))
        admins = vault["l_admins"].join(since, "hk_group_id", "left").select(
            F.col("hk_l_admin_id").alias("hk_admin_id"), F.lit(True).alias("is_admin"), "admin_from"
        )
        satellite("s_admins", admins, "hk_admin_id", ["is_admin", "admin_from"])
    named = groups.withColumn("hk_group_id", key_of("id"))
    satellite("s_group_name", named, "hk_group_id", ["group_name"], "h_groups")
    satellite("s_group_private_status", named, "hk_group_id", ["is_private"], "h_groups")
    sent = dialogs.withColumn("hk_message_id", key_of("message_id"))
    satellite("s_dialog_info", sent, "hk_message_id", ["message", "message_from", "message_to"], "h_dialogs")
    people = users.withColumn("hk_user_id", key_of("id"))
    satellite("s_user_socdem", people, "hk_user_id", ["country", "age"], "h_users")
    satellite("s_user_chatinfo", people, "hk_user_id", ["chat_name"], "h_users")
    history = (
        log.withColumns({p: key_of(business) for p, business in activity.items()})
        .withColumn("hk_l_user_group_activity", key_of(*activity))
        .withColumnRenamed("datetime_", "event_dt")
    )
    satellite(
        "s_auth_history",
        history,
        "hk_l_user_group_activity",
        ["user_id_from", "event", "event_dt"],
        "l_user_group_activity",
        mode="event",
        event_cols=["event_dt", "event"],
    )
    return vault


_HUB_OF = {"hk_user_id": "h_users", "hk_message_id": "h_dialogs", "hk_group_id": "h_groups"}
_PARENTS = {
    "h_users": [],
    "h_dialogs": [],
    "h_groups": [],
    "l_admins": ["h_users", "h_groups"],
    "l_groups_dialogs": ["h_groups", "h_dialogs"],
    "l_user_message": ["h_users", "h_dialogs"],
    "l_user_group_activity": ["h_groups", "h_users"],
    "s_admins": ["l_admins", "h_groups"],
    "s_group_name": ["h_groups"],
    "s_group_private_status": ["h_groups"],
    "s_dialog_info": ["h_dialogs"],
    "s_user_socdem": ["h_users"],
    "s_user_chatinfo": ["h_users"],
    "s_auth_history": ["l_user_group_activity"],
}
_REFERRED = {parent for parents in _PARENTS.values() for parent in parents}
# Tables the conversion mart reads.
CONVERSION_TABLES = ("h_groups", "l_user_group_activity", "l_groups_dialogs", "l_user_message", "s_auth_history")


def _with_parents(names) -> set[str]:
    found, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo.extend(_PARENTS[name])
    return found


def group_conversion(vault: dict[str, DataFrame], n: int = 10, event: str = "add") -> DataFrame:
    """Share of writers among added users for the n oldest groups with such
    users (M-24). All writers of a group count, so the share may exceed 1.

    The few groups are chosen first; messages of other groups are dropped
    before writers are counted.
    """
    activity = vault["l_user_group_activity"].select("hk_l_user_group_activity", "hk_group_id", "hk_user_id")
    added = (
        vault["s_auth_history"]
        .filter(F.col("event") == event)
        .select("hk_l_user_group_activity")
        .join(activity, "hk_l_user_group_activity")
        .groupBy("hk_group_id")
        .agg(F.count_distinct("hk_user_id").alias("cnt_added_users"))
        .join(vault["h_groups"].select("hk_group_id", "registration_dt"), "hk_group_id")
    )
    oldest = top_n(added, n, "registration_dt", "hk_group_id").select("hk_group_id", "cnt_added_users")
    writers = (
        vault["l_groups_dialogs"]
        .select("hk_group_id", "hk_message_id")
        .join(oldest.select("hk_group_id"), "hk_group_id", "left_semi")
        .join(vault["l_user_message"].select("hk_message_id", "hk_user_id"), "hk_message_id")
        .groupBy("hk_group_id")
        .agg(F.count_distinct("hk_user_id").alias("cnt_users_in_group_with_messages"))
    )
    share = ratio(F.col("cnt_users_in_group_with_messages").cast("double"), F.col("cnt_added_users").cast("double"), 2)
    return oldest.join(writers, "hk_group_id", "left").select(
        "hk_group_id", "cnt_added_users", "cnt_users_in_group_with_messages", share.alias("group_conversion")
    )
