import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martkit.catalog import readings
from martkit.functions.keys import ORDER_NAMESPACE
from martkit.operators.calendar import calendar
from martkit.operators.joins import resolve_items
from martkit.plans import counters, fx_metrics, ledger, orders, recommend, retention, rfm, shipping, travel, zones
from martkit.plans.geo_dims import CITIES, CITY_ZONES, cities
from martkit.plans.geo_dims import zones as zone_table
from tests.conftest import plan, rows


def table(spark, data, schema, **times):
    """Rows with some text columns turned into times without zone."""
    df = spark.createDataFrame(data, schema)
    return df.withColumns({c: F.to_timestamp_ntz(c) for c in times}) if times else df


# --- segmentation -----------------------------------------------------------


def shop(spark):
    users = spark.createDataFrame([(i,) for i in range(1, 11)], "id int")
    data = [(i, f"2023-01-{i:02d} 00:00:00", i, Decimal(i * 10), 4) for i in range(1, 8)]
    data += [(20, "2023-02-01 00:00:00", 1, Decimal(500), 4), (21, "2021-01-01 00:00:00", 9, Decimal(9999), 4)]
    data += [(22, "2023-03-01 00:00:00", 8, Decimal(9999), 5), (23, "2023-03-02 00:00:00", 9, Decimal(10), 1)]
    orders_ = table(spark, data, "order_id int, order_ts string, user_id int, cost decimal(10,2), status int", order_ts=1)
    return users, orders_


def test_rfm_keeps_users_without_orders(spark):
    users, orders_ = shop(spark)
    got = {r["user_id"]: tuple(r)[1:] for r in rfm.rfm(users, orders_, "2022-01-01", closed=4).collect()}
    assert len(got) == 10
    assert got[8] == (1, 1, 1)  # cancelled orders do not count
    assert got[10][0] == 2 and got[9][0] == 1  # before the date, and none: both first, by id
    assert got[1] == (5, 5, 5)


def test_rfm_stepwise_counts_open_orders_for_recency(spark):
    users, orders_ = shop(spark)
    got = {r["user_id"]: r for r in rfm.rfm_recency_any(users, orders_, "2022-01-01", closed=4, cancelled=5).collect()}
    assert got[9]["recency"] == 5 and got[8]["recency"] == 1
    assert got[10]["monetary_value"] == 5  # null spend sorts last
    first = rfm.rfm_recency_any(users, orders_, "2022-01-01", closed=4, cancelled=5, no_spend_first=True)
    assert {r["user_id"]: r for r in first.collect()}[10]["monetary_value"] == 2


def test_rfm_matrix_counts_every_user(spark):
    users, orders_ = shop(spark)
    matrix = rfm.rfm_matrix(rfm.rfm(users, orders_, "2022-01-01", closed=4)).collect()
    assert sum(sum(r[1:]) for r in matrix) == 10 and len(matrix[0]) == 6


def test_latest_status_by_time_then_log_id(spark):
    orders_ = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "order_id int, status int")
    log = table(
        spark,
        [(1, 1, 1, "2023-01-01 00:00:00"), (2, 1, 2, "2023-01-02 00:00:00"), (3, 1, 3, "2023-01-02 00:00:00"), (4, 2, 5, "2023-01-01 00:00:00")],
        "id int, order_id int, status_id int, dttm string",
        dttm=1,
    )
    assert rows(rfm.orders_with_status(orders_, log), "order_id", "status") == [(1, 3), (2, 5)]


# --- shipping ---------------------------------------------------------------


def shipping_log(spark):
    def shipment(i, states, rate="0.02", plan="2023-01-10 00:00:00"):
        return [
            (n, i, Decimal("100.00"), at, 7, status, state, plan, "sea:ship", Decimal("0.010"), "AU", Decimal(rate), "3:vspn-1:0.05:0.02")
            for n, (status, state, at) in enumerate(states)
        ]

    late = shipment(1, [("in_progress", "booked", "2023-01-01 10:00:00"), ("finished", "recieved", "2023-01-12 09:00:00")])
    on_time = shipment(2, [("in_progress", "booked", "2023-01-01 00:00:00"), ("finished", "recieved", "2023-01-05 12:00:00")], "0.03")
    returned = shipment(3, [("in_progress", "booked", "2023-01-01 00:00:00"), ("cancelled", "returned", "2023-01-05 12:00:00")])
    return table(
        spark,
        late + on_time + returned,
        """id int, shippingid bigint, payment_amount decimal(14,2), state_datetime string, vendorid bigint, status string,
        state string, shipping_plan_datetime string, shipping_transfer_description string, shipping_transfer_rate decimal(14,3),
        shipping_country string, shipping_country_base_rate decimal(14,3), vendor_agreement_description string""",
        state_datetime=1,
        shipping_plan_datetime=1,
    )


def test_shipping_mart(spark):
    log = shipping_log(spark)
    countries, kinds, terms = shipping.country_rates(log), shipping.transfers(log), shipping.agreements(log)
    assert countries.count() == 2 and kinds.count() == 1 and terms.count() == 1
    ships = shipping.shipments(log)
    info = shipping.shipping_info(ships, countries, kinds)
    assert info.count() == 3  # two rates of one country do not multiply shipments
    status = shipping.shipping_status(log)
    assert rows(ships.select(*status.columns)) == rows(status)
    mart = shipping.shipping_mart(ships, countries, kinds, terms)
    got = {r["shippingid"]: r for r in mart.collect()}
    assert (got[1]["is_delay"], got[1]["delay_day_at_shipping"], got[1]["full_day_at_shipping"]) == (1, 2, 10)
    assert (got[2]["is_delay"], got[2]["is_shipping_finish"], got[2]["full_day_at_shipping"]) == (0, 1, 4)
    assert (got[3]["is_shipping_finish"], got[3]["full_day_at_shipping"]) == (0, None)
    assert got[1]["vat"] == Decimal("8.0") and got[2]["vat"] == Decimal("9.0") and got[1]["profit"] == Decimal("2.0")
    stats = rows(shipping.delay_stats(mart), "is_shipping_finish", "is_delay", "shipment_count")
    assert stats == [(0, 0, 1), (1, 0, 1), (1, 1, 1)]


# --- sales star -------------------------------------------------------------


def test_retention(spark):
    days = calendar(spark, "2024-01-01", "2025-01-12")
    log = table(
        spark,
        [
            (1, "2024-01-01 10:00:00", 1, 7, Decimal(10), None),
            (2, "2024-01-02 10:00:00", 1, 8, Decimal(20), "shipped"),
            (3, "2024-01-03 10:00:00", 2, 7, Decimal(5), "shipped"),
            (4, "2024-01-03 10:00:00", 2, 7, Decimal(50), "refunded"),
            (5, "2024-01-04 10:00:00", 3, 7, Decimal(30), "refunded"),
            (6, "2025-01-01 10:00:00", 3, 7, Decimal(1), "shipped"),
        ],
        "id int, date_time string, customer_id int, item_id int, payment_amount decimal(14,2), status string",
        date_time=1,
    ).withColumns({"city_id": F.lit(1), "quantity": F.lit(1)})
    facts = retention.sales_fact(log, days)
    assert facts.agg(F.sum("payment_amount")).first()[0] == Decimal(-44)
    assert retention.sales_fact(log, days, "2024-01-03").count() == 2
    got = {(str(r["first_day_of_week"]), r["item_id"]): r for r in retention.customer_retention(facts, days).collect()}
    week = got[("2024-01-01", 7)]
    assert (week["new_customers_count"], week["returning_customers_count"]) == (2, 1)
    assert (week["new_customers_revenue"], week["returning_customers_revenue"]) == (Decimal(5), Decimal(10))
    assert (week["refunded_customer_count"], week["customers_refunded"]) == (2, 2)
    assert week["period_name"] == "Неделя с 2024-01-01 по 2024-01-07"
    assert got[("2024-12-30", 7)]["period_id"] == 1 and week["period_id"] == 1  # years are kept apart
    people = {r["item_id"]: r for r in retention.customer_retention(facts, days, "customers").filter("first_day_of_week = '2024-01-01'").collect()}
    assert people[7]["new_customers_count"] == 1


def test_dimension_takes_the_latest_name(spark):
    held = spark.createDataFrame([(1, "held")], "customer_id int, name string")
    staging = spark.createDataFrame([(1, "x", 1), (2, "old", 1), (2, "new", 2), (None, "n", 3)], "customer_id int, name string, t int")
    assert rows(retention.load_dimension(held, staging, "customer_id", ["name"], "t")) == [(2, "new")]


# --- ledger -----------------------------------------------------------------


@pytest.mark.parametrize(
    "ratings,pay",
    [([3, 4], 100), ([4, 4], 150), ([4, 5], 175), ([5] * 9 + [4], 200), ([5, 5], 200), ([1], 100)],
)
def test_ledger_tiers_and_minimum(spark, ratings, pay):
    """Averages on a bound belong to the upper tier; small orders get the minimum."""
    n = len(ratings)
    orders_ = spark.range(n).select(F.col("id").alias("order_id"), F.lit("2024-05-31 23:00:00").cast("timestamp_ntz").alias("order_ts"))
    details = spark.createDataFrame([(i, "c", r) for i, r in enumerate(ratings)], "delivery_id bigint, courier_id string, rate smallint")
    sales = spark.createDataFrame([(i, i, Decimal(100), Decimal(10)) for i in range(n)], "order_id bigint, delivery_id bigint, order_sum decimal(12,2), tip_sum decimal(12,2)")
    couriers = spark.createDataFrame([("c", "C")], "courier_id string, courier_name string")
    row = ledger.courier_ledger(sales, orders_, details, couriers).first()
    assert row["courier_order_sum"] == Decimal(pay * n)
    assert row["courier_reward_sum"] == Decimal(pay * n) + Decimal("9.5") * n
    assert (row["settlement_month"], row["order_processing_fee"]) == (5, Decimal(25 * n))


def test_ledger_from_documents(spark):
    doc = '{"order_id": "o%d", "order_ts": "2024-01-0%d 10:00:00", "delivery_id": "d%d", "courier_id": "%s", "delivery_ts": "2024-01-05 10:00:00", "rate": %d, "sum": 4000.0, "tip_sum": 10.5}'
    pages = spark.createDataFrame(
        [(doc % (1, 1, 1, "c1", 3), 1), (doc % (1, 1, 1, "c1", 5), 2), (doc % (2, 2, 2, "nobody", 5), 1), ("{'order_id': 'o3', broken", 1)],
        "document string, loaded_at int",
    )
    couriers = spark.createDataFrame([("{'_id': 'c1', 'name': 'Ann'}", 1)], "document string, loaded_at int")
    staged_ = ledger.stage_documents(pages, "order_id")
    assert rows(staged_, "object_id") == [("o1",), ("o2",)]
    bad = spark.createDataFrame([("x", "{broken", 1)], staged_.schema)
    # A courier document in single quotes is accepted by the parser.
    courier_docs = couriers.select(F.lit("c1").alias("object_id"), F.col("document").alias("object_value"), "loaded_at")
    e = ledger.delivery_entities(courier_docs, staged_.unionByName(bad))
    assert e["rejected"].count() == 1
    row = ledger.courier_ledger(e["sales"], e["orders"], e["details"], e["couriers"]).collect()
    assert [(r["courier_name"], r["rate_avg"], r["courier_order_sum"]) for r in row] == [("Ann", 5.0, Decimal("400.00"))]
    assert rows(ledger.unsettled(e["sales"], e["orders"], e["details"], e["couriers"]), "order_id") == [("o2",)]


# --- geo --------------------------------------------------------------------

EVENT = """message_id bigint, event_type string, lat double, lon double, date string,
    event struct<message_from: bigint, message_to: bigint, message_ts: string, reaction_from: bigint, user: bigint,
                 subscription_channel: string>"""


def geo(spark):
    sydney, melbourne, brisbane = (-33.865, 151.2094), (-37.8136, 144.9631), (-27.4678, 153.0281)
    data = []

    def add(kind, place, day, **event):
        fields = ("message_from", "message_to", "message_ts", "reaction_from", "user", "subscription_channel")
        data.append((len(data), kind, *place, day, tuple(event.get(f) for f in fields)))

    for user, channel, place in [(1, "tech", sydney), (2, "tech", sydney), (3, "music", brisbane), (4, "music", melbourne)]:
        add("subscription", place, "2023-05-27", user=user, subscription_channel=channel)
    add("message", sydney, "2023-06-01", message_from=1, message_to=3, message_ts="2023-06-01 12:00:00")
    add("message", (-33.8652, 151.2096), "2023-06-01", message_from=2, message_to=3, message_ts="2023-06-01 12:05:00")
    add("message", brisbane, "2023-06-01", message_from=3, message_to=4, message_ts="2023-06-01 12:10:00")
    add("message", melbourne, "2023-06-01", message_from=4, message_to=1, message_ts="2023-06-01 12:10:00")
    add("message", sydney, "2023-06-01", message_from=5, message_to=1, message_ts="2023-06-01 12:00:00")
    add("message", melbourne, "2023-06-10", message_from=5, message_to=1, message_ts="2023-06-10 12:00:00")
    for i in range(31):
        day = f"2023-06-{15 + i:02d}" if i < 16 else f"2023-07-{i - 15:02d}"
        add("message", sydney, day, message_from=5, message_to=1, message_ts=f"{day} 12:00:00")
    add("reaction", sydney, "2023-06-01", reaction_from=1)
    add("reaction", melbourne, "2023-06-10", reaction_from=77)
    df = spark.createDataFrame(data, EVENT)
    return df.withColumn("date", F.to_date("date")).withColumn(
        "event", F.col("event").withField("message_ts", F.to_timestamp_ntz("event.message_ts"))
    )


def test_travel_of_the_wandering_user(spark):
    got = {r["user_id"]: r for r in travel.user_travel(geo(spark), cities(spark), zone_table(spark)).collect()}
    five = got[5]
    assert (five["act_city"], five["home_city"], five["travel_count"]) == ("Sydney", "Sydney", 2)
    assert five["travel_array"] == ["Sydney", "Melbourne", "Sydney"]
    assert str(five["local_time"]) == "2023-07-15 22:00:00"
    assert got[1]["home_city"] is None and got[1]["travel_count"] == 0


def test_home_is_kept_after_leaving_unless_strict(spark):
    moved = spark.createDataFrame(
        [(900, "message", -31.9522, 115.8589, "2023-08-01", (5, 1, "2023-08-01 12:00:00", None, None, None))], EVENT
    )
    moved = moved.withColumn("date", F.to_date("date")).withColumn("event", F.col("event").withField("message_ts", F.to_timestamp_ntz("event.message_ts")))
    events = geo(spark).unionByName(moved)
    home = lambda strict: {
        r["user_id"]: r["home_city"] for r in travel.user_travel(events, cities(spark), zone_table(spark), strict_current=strict).collect()
    }[5]
    assert home(False) == "Sydney" and home(True) is None


def test_unknown_zone_gives_no_local_time(spark):
    some = zone_table(spark).filter("city <> 'Sydney'")
    got = {r["user_id"]: r["local_time"] for r in travel.user_travel(geo(spark), cities(spark), some).collect()}
    assert got[1] is None and got[4] is not None
    assert set(CITY_ZONES) == {c[1] for c in CITIES}


def test_zone_stats(spark):
    got = {(str(r["month"]), str(r["week"]), r["zone_id"]): r for r in zones.zone_stats(geo(spark), cities(spark)).collect()}
    first = got[("2023-06-01", "2023-05-29", "Sydney")]
    assert (first["week_message"], first["month_message"], first["week_user"], first["month_user"]) == (3, 19, 3, 3)
    assert (first["week_reaction"], first["month_reaction"]) == (1, 1) and first["week_subscription"] is None
    assert got[("2023-05-01", "2023-05-22", "Sydney")]["week_subscription"] == 2
    assert not any(k[2] is None for k in got)
    kept = zones.zone_stats(geo(spark), cities(spark), keep_unplaced=True).filter("zone_id is null").collect()
    assert [(str(r["week"]), r["week_reaction"]) for r in kept] == [("2023-06-05", 1)]


def test_recommendations(spark):
    got = recommend.friend_recommendations(geo(spark), cities(spark), zone_table(spark), "2023-08-01").collect()
    assert [(r["user_left"], r["user_right"], r["zone_id"], str(r["local_time"]), str(r["processed_dttm"])) for r in got] == [
        (2, 1, "Sydney", "2023-06-01 22:00:00", "2023-08-01")
    ]


# --- orders -----------------------------------------------------------------


def order_messages(spark):
    pizza, burger = "rest_01", "rest_02"
    data = [
        (10001, pizza, "user_01", [("prod_01", 500, 2), ("prod_03", 100, 1)]),
        (10002, burger, "user_01", [("prod_04", 300, 1), ("prod_05", 150, 1)]),
        (10003, pizza, "user_02", [("prod_01", 500, 1)]),
        (10004, burger, "user_03", [("prod_04", 300, 1), ("prod_05", 150, 1), ("prod_06", 200, 1)]),
        (10005, pizza, "user_02", [("prod_02", 400, 1)]),
    ]
    messages = [
        (i, "order", "2024-01-01 00:00:00", ("2024-01-01 00:00:00", Decimal(sum(p * q for _, p, q in items)), Decimal(0), "CLOSED", (place,), (user,), [(a, Decimal(p), q) for a, p, q in items]))
        for i, place, user, items in data
    ]
    return spark.createDataFrame(messages, orders.ORDER_MESSAGE)


def reference(spark):
    users = spark.createDataFrame([("user_01", "Ann"), ("user_02", "Bob"), ("user_03", "Cy")], "id string, name string")
    menu = lambda *items: [tuple(i) for i in items]
    restaurants = spark.createDataFrame(
        [
            ("rest_01", "P", menu(("prod_01", "one", "Pizza"), ("prod_02", "two", "Pizza"), ("prod_03", "three", "Drinks"))),
            ("rest_02", "B", menu(("prod_04", "four", "Burgers"), ("prod_05", "five", "Sides"), ("prod_06", "six", "Drinks"))),
        ],
        "id string, name string, menu array<struct<_id: string, name: string, category: string>>",
    )
    return users, restaurants


def test_five_orders_to_counters(spark):
    good, unknown = orders.enrich_orders(order_messages(spark), *reference(spark))
    assert good.count() == 5 and unknown.count() == 0
    lines = counters.product_rows(orders.build_product_message(good))
    key = lambda x: str(uuid.uuid5(uuid.UUID(ORDER_NAMESPACE), x))
    got = {(r["user_id"], r["category_name"]): r["order_cnt"] for r in counters.user_category_counters(lines).collect()}
    assert got[(key("user_01"), "Pizza")] == 1 and got[(key("user_01"), "Drinks")] == 1
    assert got[(key("user_02"), "Pizza")] == 2 and len(got) == 8
    products = {(r["user_id"], r["product_id"]): r["order_cnt"] for r in counters.user_product_counters(lines).collect()}
    assert products[(key("user_02"), key("prod_01"))] == 1 and len(products) == 9


def test_unknown_references_are_set_aside(spark):
    users, restaurants = reference(spark)
    good, unknown = orders.enrich_orders(order_messages(spark), users.filter("id <> 'user_03'"), restaurants.filter("id = 'rest_02'"))
    assert rows(good, "object_id") == [(10002,)] and unknown.count() == 4
    closed, _ = orders.enrich_orders(order_messages(spark), users, restaurants, status="OPEN")
    assert closed.count() == 0


def test_order_vault_is_loaded_once(spark):
    good, _ = orders.enrich_orders(order_messages(spark), *reference(spark))
    vault = orders.load_order_vault(good, F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    sizes = {n: df.count() for n, df in vault.items()}
    assert sizes == {
        "h_user": 3, "h_product": 6, "h_category": 4, "h_restaurant": 2, "h_order": 5, "l_order_product": 9,
        "l_product_restaurant": 6, "l_product_category": 6, "l_order_user": 5, "s_user_names": 3, "s_product_names": 6,
        "s_restaurant_names": 2, "s_order_cost": 5, "s_order_status": 5,
    }
    names = ["h_order", "l_order_product", "s_order_cost", "s_product_names"]
    again = orders.load_order_vault(good, F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"), vault, tables=names)
    assert {n: df.count() for n, df in again.items()} == {n: sizes[n] for n in names}


def test_raw_orders_keep_the_last_message(spark):
    first = order_messages(spark)
    later = first.filter("object_id = 10001").withColumn("sent_dttm", F.lit("2024-01-02 00:00:00"))
    raw = orders.raw_orders(first.unionByName(later))
    assert raw.count() == 5 and raw.filter("object_id = 10001").first()["sent_dttm"] == "2024-01-02 00:00:00"


# --- transactions -----------------------------------------------------------


def fx(spark):
    transactions = table(
        spark,
        [
            ("a", 1, 430, "done", 1000, "2022-10-01 10:00:00"),
            ("b", 1, 430, "done", 500, "2022-10-01 23:59:59"),
            ("c", 2, 430, "done", 100, "2022-10-01 00:00:00"),
            ("d", -1, 430, "done", 9999, "2022-10-01 10:00:00"),
            ("e", 1, 430, "blocked", 9999, "2022-10-01 10:00:00"),
            ("f", 1, 440, "done", 9999, "2022-10-01 10:00:00"),
            ("g", 1, 430, "done", 200, "2022-10-02 00:00:00"),
        ],
        "operation_id string, account_number_from int, currency_code int, status string, amount int, transaction_dt string",
        transaction_dt=1,
    )
    rates = table(
        spark,
        [("2022-10-01 00:00:00", 430, 420, Decimal("0.900")), ("2022-10-01 12:00:00", 430, 420, Decimal("0.500")), ("2022-10-02 00:00:00", 430, 420, Decimal("2.000")), ("2022-10-01 00:00:00", 440, 430, Decimal("5.000"))],
        "date_update string, currency_code int, currency_code_with int, currency_with_div decimal(5,3)",
        date_update=1,
    )
    return transactions, rates


def test_global_metrics(spark, tmp_path):
    transactions, rates = fx(spark)
    got = {str(r["date_update"]): tuple(r)[1:] for r in fx_metrics.global_metrics(transactions, rates).collect()}
    assert got == {
        "2022-10-01": (430, Decimal("800.00"), 3, Decimal("1.50"), 2),
        "2022-10-02": (430, Decimal("400.00"), 1, Decimal("1.00"), 1),
    }
    day = fx_metrics.global_metrics(transactions, rates, "2022-10-02").collect()
    assert [tuple(r)[1:] for r in day] == [got["2022-10-02"]]
    assert rows(fx_metrics.without_rate(transactions, rates), "operation_id") == [("f",)]
    for _ in range(2):
        fx_metrics.copy_day(transactions, f"{tmp_path}/t", "transaction_dt", "2022-10-01")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 6


def test_messages_are_built_where_their_lines_are(spark, tmp_path):
    """Lines are dealt by order once; what is gathered of them is not dealt again."""
    lines = [(o, p, 1, n, 2.0, 10.0 * n, "1997-01-0%d" % n) for o in (1, 2, 3) for n, p in ((1, 7), (2, 8), (3, 1007))] + [(None, 7, 1, 1, 1.0, 1.0, "1997-01-01")]
    put = lambda data, ddl, name: spark.createDataFrame(data, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    put(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate string", "lineitem")
    put([(p, "Brand#1", "n", "t", 1.0) for p in (7, 8, 1007)], "p_partkey long, p_brand string, p_name string, p_type string, p_retailprice double", "part")
    put([(o, 5, "F", "1997-01-01") for o in (1, 2, 2)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string", "orders")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        messages = readings.order_messages(spark, str(tmp_path))
        assert sum("Exchange" in line and "l_orderkey" in line.split("Exchange")[1] for line in plan(messages).splitlines()) == 1
        got = rows(messages.select("object_id", "payload.cost", F.expr("transform(payload.order_items, x -> x.id)").alias("ids")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    one = lambda o: [(f"{o}/Brand#1-0", Decimal("30.00"), ["7", "8"]), (f"{o}/Brand#1-1", Decimal("30.00"), ["1007"])]
    assert got == sorted([*one(1), *one(2), *one(2)], key=repr)


def test_documents_are_parsed_once(spark, tmp_path):
    docs = spark.createDataFrame(
        [("o1", '{"order_id": "o1", "delivery_id": "d1", "courier_id": "c1", "rate": 4, "sum": 10.5}'), ("o2", "{broken")], "object_id string, object_value string"
    )
    couriers = spark.createDataFrame([("c1", '{"_id": "c1", "name": "A"}')], "object_id string, object_value string")

    def save(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    plain, saved = ledger.delivery_entities(couriers, docs), ledger.delivery_entities(couriers, docs, save=save)
    for name, df in saved.items():
        assert rows(df) == rows(plain[name])
    for name in ("orders", "details", "sales"):
        assert "from_json" in plan(plain[name]) and "from_json" not in plan(saved[name])


def test_lines_are_gathered_without_lambdas(spark):
    line = "array<struct<id: string, price: int, quantity: int>>"
    data = [(1, "r", [("b", 1, 1), ("a", 2, 1), ("x", 3, 1)]), (2, "r", []), (3, "r", None), (4, "q", [None, ("a", 4, 1)])]
    orders_ = spark.createDataFrame(data, f"object_id int, restaurant_id string, order_items {line}")
    menu = "array<struct<_id: string, name: string, category: string>>"
    places = spark.createDataFrame([("r", "R", [("a", "A", "c"), ("b", "B", "c"), ("a", "Z", "c")])], f"id string, name string, menu {menu}")
    got = resolve_items(orders_, places)
    shown = {r["object_id"]: (r["restaurant_name"], r["products"] and [p["name"] for p in r["products"]], r["unresolved"]) for r in got.collect()}
    assert shown == {1: ("R", ["B", "A", None], 1), 2: ("R", [], 0), 3: ("R", None, 0), 4: (None, [None, None], 2)}
    assert "lambda" not in plan(got)
