"""The sample tables read as the inputs the marts expect.

The sample schema is a small star schema with an event table; each function
maps it to one input (orders, shipping log, chat tables, geo events, ...).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.money import money
from martkit.operators.calendar import calendar_between
from martkit.plans.geo_dims import cities


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def days_after(ts, n) -> Column:
    """Timestamp ``n`` days later (n may be a column)."""
    return F.timestamp_add("DAY", _int(n), ts if isinstance(ts, Column) else F.col(ts))


def digit(col: str = "o_orderpriority") -> Column:
    return F.substring(col, 1, 1).cast("int")


def _int(n) -> Column:
    return (n if isinstance(n, Column) else F.lit(n)).cast("int")


# --- segmentation -----------------------------------------------------------


def users(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("cost"),
        F.col("o_orderstatus").alias("status"),
    )


def status_log(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.concat("l_returnflag", "l_linestatus").alias("status_id"),
        F.col("l_shipdate").alias("dttm"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )


LOG_TIE = ("l_linenumber", "l_partkey", "l_suppkey")


# --- shipping ---------------------------------------------------------------


def shipping_log(spark, sf) -> DataFrame:
    rate = lambda c: c.cast("decimal(14,3)")
    per_order = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    agreement = (F.col("c_nationkey") % 7).cast("string")
    state = F.when(F.col("l_returnflag") == "A", "booked").when(F.col("l_returnflag") == "R", "recieved")
    return (
        table(spark, sf, "lineitem")
        .join(per_order, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").alias("shippingid"),
            F.col("c_nationkey").cast("bigint").alias("vendorid"),
            money("o_totalprice").alias("payment_amount"),
            F.col("l_shipdate").alias("state_datetime"),
            F.when(F.col("l_linestatus") == "F", "finished").otherwise("in_progress").alias("status"),
            state.otherwise("delivering").alias("state"),
            days_after("o_orderdate", 60).alias("shipping_plan_datetime"),
            F.concat_ws(":", F.substring("o_orderpriority", 3, 20), "o_orderstatus").alias(
                "shipping_transfer_description"
            ),
            rate(digit() * F.lit("0.005").cast("decimal(4,3)")).alias("shipping_transfer_rate"),
            F.col("n_name").alias("shipping_country"),
            rate((F.col("c_nationkey") % 5 + 1) * F.lit("0.01").cast("decimal(3,2)")).alias(
                "shipping_country_base_rate"
            ),
            F.concat(
                agreement, F.lit(":vspn-"), agreement, F.lit("000:0.0"), agreement, F.lit(":0.1"), agreement
            ).alias("vendor_agreement_description"),
            *LOG_TIE,
        )
    )


# --- sales star -------------------------------------------------------------


def order_log(spark, sf) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "shipped").when(F.col("o_orderstatus") == "P", "refunded")
    return (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderdate").alias("date_time"),
            F.col("c_nationkey").alias("city_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("c_name").alias("last_name"),
            digit().alias("item_id"),
            (F.col("o_orderkey") % 5 + 1).cast("int").alias("quantity"),
            money("o_totalprice").alias("payment_amount"),
            status.alias("status"),
        )
    )


def order_calendar(spark, sf) -> DataFrame:
    bounds = table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end")
    )
    return calendar_between(bounds)


# --- courier ledger ---------------------------------------------------------


def delivery_documents(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Courier and delivery documents as JSON text with a load time. A delivery
    is an order; its courier is the supplier of the order's first line."""
    couriers = table(spark, sf, "supplier").select(
        F.to_json(F.struct(F.concat(F.lit("c"), "s_suppkey").alias("_id"), F.col("s_name").alias("name"))).alias(
            "document"
        ),
        F.lit("2002-01-01").alias("loaded_at"),
    )
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("courier"), F.max("l_shipdate").alias("delivered")
    )
    rating = F.least(F.lit(5), 1 + F.col("courier") % 5 + F.col("o_orderkey") % 2)
    total = money("o_totalprice", 12)
    tip = (total * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)")
    body = F.struct(
        F.concat(F.lit("o"), "o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("string").alias("order_ts"),
        F.concat(F.lit("d"), "o_orderkey").alias("delivery_id"),
        F.concat(F.lit("c"), "courier").alias("courier_id"),
        F.col("delivered").cast("string").alias("delivery_ts"),
        rating.cast("int").alias("rate"),
        total.alias("sum"),
        tip.alias("tip_sum"),
    )
    deliveries = (
        table(spark, sf, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(F.to_json(body).alias("document"), F.col("o_orderdate").cast("string").alias("loaded_at"))
    )
    return couriers, deliveries


# --- community vault --------------------------------------------------------


def community(spark, sf) -> dict[str, DataFrame]:
    start = F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
    kind = (
        F.when(F.col("event_type") == "signup", "add")
        .when(F.col("event_type") == "view", "join")
        .when(F.col("event_type") == "click", "create")
        .when(F.col("event_type") == "purchase", "leave")
        .otherwise("kick")
    )
    return {
        "users": table(spark, sf, "customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("chat_name"),
            days_after(start, F.col("c_custkey") % 365).alias("registration_dt"),
            F.col("c_mktsegment").alias("country"),
            (F.col("c_custkey") % 60 + 18).cast("int").alias("age"),
        ),
        "groups": table(spark, sf, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            (F.col("n_nationkey") * 3).cast("bigint").alias("admin_id"),
            F.col("n_name").alias("group_name"),
            days_after(start, F.col("n_nationkey") * 37 % 100).alias("registration_dt"),
            (F.col("n_regionkey") % 2 == 1).alias("is_private"),
        ),
        "dialogs": table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("message_id"),
            F.col("o_orderdate").alias("message_ts"),
            F.col("o_custkey").alias("message_from"),
            (F.col("o_custkey") + 1).alias("message_to"),
            F.col("o_orderpriority").alias("message"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") % 27).alias("message_group"),
        ),
        "group_log": table(spark, sf, "events").select(
            (event_number() % 25).alias("group_id"),
            "user_id",
            (F.col("user_id") + 1).alias("user_id_from"),
            kind.alias("event"),
            F.col("ts").alias("datetime_"),
        ),
    }


def community_before(staging: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The part of the chat tables that an earlier load has seen."""
    return {
        "users": staging["users"].filter(F.col("registration_dt") < F.lit("1995-07-01").cast("timestamp_ntz")),
        "groups": staging["groups"].filter(F.col("registration_dt") < F.lit("1995-02-20").cast("timestamp_ntz")),
        "dialogs": staging["dialogs"].filter(F.col("message_ts") < F.lit("1998-01-01").cast("timestamp_ntz")),
        "group_log": staging["group_log"].filter(F.col("datetime_") < F.lit("2024-01-16").cast("timestamp_ntz")),
    }


def event_number() -> Column:
    """The number ``k`` in the JSON properties of an event."""
    return F.get_json_object("props", "$.k").cast("bigint")


# --- geo events -------------------------------------------------------------


def geo_events(spark, sf) -> DataFrame:
    """Events with places: a third of the users never move, the others change
    city every week."""
    events = table(spark, sf, "events")
    moving = (F.col("user_id") + F.weekofyear("ts")) % 24 + 1
    place = F.when(F.col("user_id") % 3 == 0, F.col("user_id") % 24 + 1).otherwise(moving)
    kind = (
        F.when(F.col("event_type").isin("view", "purchase"), "message")
        .when(F.col("event_type").isin("click", "error"), "reaction")
        .otherwise("subscription")
    )
    located = events.select("*", place.alias("place"), kind.alias("kind")).join(
        cities(spark).select(F.col("id").alias("place"), F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon")),
        "place",
    )
    is_message = F.col("kind") == "message"
    body = F.struct(
        F.when(is_message, F.col("user_id")).alias("message_from"),
        F.when(is_message, F.col("event_id") * 7 % 151).alias("message_to"),
        F.when(is_message, F.col("ts")).alias("message_ts"),
        F.when(F.col("kind") == "reaction", F.col("user_id")).alias("reaction_from"),
        F.when(F.col("kind") == "subscription", F.col("user_id")).alias("user"),
        F.when(F.col("kind") == "subscription", event_number().cast("string")).alias("subscription_channel"),
    )
    return located.select(
        F.col("event_id").alias("message_id"),
        F.col("kind").alias("event_type"),
        (F.col("c_lat") + (F.col("user_id") % 5 - 2) * 0.004).alias("lat"),
        (F.col("c_lon") + (F.col("user_id") % 7 - 3) * 0.004).alias("lon"),
        F.to_date("ts").alias("date"),
        body.alias("event"),
    )


# --- order messages ---------------------------------------------------------


def restaurant_of() -> Column:
    """Parts of one brand and number range make a menu, so menus stay small."""
    return F.concat_ws("-", "p_brand", F.floor(F.col("p_partkey") / 1000).cast("string"))


def order_messages(spark, sf) -> DataFrame:
    """Order messages: the lines of one order that go to one restaurant."""
    lines = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select("*", restaurant_of().alias("restaurant"))
        # Plain lines are dealt by order, so neither messages nor their parts are.
        .repartition("l_orderkey")
    )
    shown = F.struct(
        F.col("l_partkey").cast("string").alias("id"),
        money("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    item = F.struct(
        shown.alias("shown"),
        "l_linenumber",
        "l_suppkey",
        "l_shipdate",
    )
    grouped = lines.groupBy("l_orderkey", "restaurant").agg(
        F.sort_array(F.collect_list(item)).alias("items"),
        F.sum(money("l_extendedprice")).cast("decimal(14,2)").alias("cost"),
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", "CLOSED")
        .when(F.col("o_orderstatus") == "P", "CANCELLED")
        .otherwise("OPEN")
    )
    payload = F.struct(
        F.col("o_orderdate").cast("string").alias("date"),
        "cost",
        F.col("cost").alias("payment"),
        status.alias("final_status"),
        F.struct(F.col("restaurant").alias("id")).alias("restaurant"),
        F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"),
        F.col("items.shown").alias("order_items"),
    )
    return grouped.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("/", F.col("l_orderkey").cast("string"), "restaurant").alias("object_id"),
        F.lit("order").alias("object_type"),
        F.col("o_orderdate").cast("string").alias("sent_dttm"),
        payload.alias("payload"),
    )


def order_users(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))


def restaurants(spark, sf) -> DataFrame:
    """Restaurants with their menus. A menu is one document of the reference
    data, so it is one row here too."""
    entry = F.struct(
        F.col("p_partkey").cast("string").alias("_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        money("p_retailprice").alias("price"),
    )
    return (
        table(spark, sf, "part")
        .groupBy(restaurant_of().alias("id"))
        .agg(F.array_sort(F.collect_list(entry)).alias("menu"))
        .select("id", F.concat(F.lit("Restaurant "), "id").alias("name"), "menu")
    )


# --- transactions -----------------------------------------------------------


def transactions(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("operation_id"),
        (F.col("o_custkey") - 5).alias("account_number_from"),
        (digit() * 10 + 400).alias("currency_code"),
        F.when(F.col("o_orderstatus") == "P", "chargeback").otherwise("done").alias("status"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount"),
        F.col("o_orderdate").alias("transaction_dt"),
    )


def rates(spark, sf) -> DataFrame:
    """Two rates a day for the currencies traded that day, none on some days."""
    pairs = table(spark, sf, "orders").select("o_orderdate", digit().alias("digit")).distinct()
    # Day numbers count from 1970-01-01.
    day = F.datediff("o_orderdate", F.lit("1970-01-01"))
    morning = (F.lit(500) + day % 50 * 10 + F.col("digit")).cast("decimal(9,3)") / F.lit(1000)
    traded = pairs.filter((day + F.col("digit")) % 7 != 0)
    updates = F.explode(F.array(F.lit(0), F.lit(12)))
    return (
        traded.select("*", morning.cast("decimal(5,3)").alias("morning"))
        .select("*", updates.alias("hour"))
        .select(
            F.timestamp_add("HOUR", F.col("hour"), F.col("o_orderdate")).alias("date_update"),
            (F.col("digit") * 10 + 400).alias("currency_code"),
            F.lit(420).alias("currency_code_with"),
            (F.col("morning") + F.when(F.col("hour") == 12, F.lit("0.050").cast("decimal(5,3)")).otherwise(F.lit("0.000").cast("decimal(5,3)")))
            .cast("decimal(5,3)")
            .alias("currency_with_div"),
        )
    )


# --- campaign stream --------------------------------------------------------


def campaign_rows(events: DataFrame) -> DataFrame:
    """Campaign messages: an event announces a campaign of its user, created at
    the full hour; repeated events of that hour repeat the message."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", epoch, F.col("ts"))
    hour = seconds - seconds % 3600
    owner = F.col("user_id").cast("string")
    return events.select(
        F.concat(F.lit("rest_"), owner).alias("restaurant_id"),
        F.concat_ws("-", owner, "event_type").alias("adv_campaign_id"),
        F.col("event_type").alias("adv_campaign_content"),
        F.concat(F.lit("owner "), owner).alias("adv_campaign_owner"),
        F.concat(F.lit("owner"), owner, F.lit("@example.org")).alias("adv_campaign_owner_contact"),
        hour.alias("adv_campaign_datetime_start"),
        (hour + (F.col("user_id") % 10 + 1) * 86400).alias("adv_campaign_datetime_end"),
        hour.alias("datetime_created"),
    )


def subscribers(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_name").alias("client_id"),
        F.concat(F.lit("rest_"), F.floor(F.col("c_custkey") / 10).cast("string")).alias("restaurant_id"),
    )


def event_orders(events: DataFrame) -> DataFrame:
    """Order messages of a stream: each event orders two items."""
    k = event_number()
    item = lambda n: F.struct(
        n.cast("string").alias("id"), F.lit("1.00").cast("decimal(14,2)").alias("price"), F.lit(1).alias("quantity")
    )
    payload = F.struct(
        F.col("ts").cast("string").alias("date"),
        money("value").alias("cost"),
        money("value").alias("payment"),
        F.lit("CLOSED").alias("final_status"),
        F.struct(F.col("event_type").alias("id")).alias("restaurant"),
        F.struct(F.col("user_id").cast("string").alias("id")).alias("user"),
        F.array(item(k), item((k + 50) % 100)).alias("order_items"),
    )
    return events.select(
        F.col("event_id").alias("object_id"),
        F.lit("order").alias("object_type"),
        F.col("ts").cast("string").alias("sent_dttm"),
        payload.alias("payload"),
    )


def event_restaurants(events: DataFrame) -> DataFrame:
    """One restaurant per event type; the menu lists the items ordered there."""
    lines = events.select(F.col("event_type").alias("id"), event_number().alias("k"))
    items = lines.unionByName(lines.select("id", ((F.col("k") + 50) % 100).alias("k"))).distinct()
    entry = F.struct(
        F.col("k").cast("string").alias("_id"),
        F.concat(F.lit("Item "), F.col("k")).alias("name"),
        F.concat(F.lit("Category "), F.col("k") % 10).alias("category"),
    )
    return items.groupBy("id").agg(F.array_sort(F.collect_list(entry)).alias("menu")).select(
        "id", F.concat(F.lit("Restaurant "), "id").alias("name"), "menu"
    )


def event_users(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").cast("string").alias("id")).distinct().select(
        "id", F.concat(F.lit("User "), "id").alias("name")
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
