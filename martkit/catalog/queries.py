"""Every mart and operator as a query over the sample tables.

Results are shown in plain types: whole numbers as bigint, money and ratios as
double, dates and times as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.catalog import readings as r
from martkit.functions.jsons import parse_json_column, split_corrupt, to_message
from martkit.functions.keys import hash_key, uuid5_key
from martkit.functions.temporal import in_days, on_day, since
from martkit.operators.aggregates import duplicates, with_group_stat
from martkit.operators.distinct import distinct_counts, id_bitmaps, united
from martkit.operators.islands import islands
from martkit.operators.joins import missing_from, numbered
from martkit.operators.neighbours import with_previous
from martkit.operators.pairs import undirected
from martkit.operators.rank import global_ntile, global_row_number, surrogate_key, top_n
from martkit.operators.spatial import near_pairs, nearest
from martkit.plans import conversion, counters, fx_metrics, ledger, recommend, retention, rfm, shipping, travel, zones
from martkit.plans import orders as order_plans
from martkit.plans.geo_dims import cities
from martkit.plans.geo_dims import zones as zone_table
from martkit.plans.staging import SCHEMAS, stage_csv
from martkit.quality import checks as dq
from martkit.quality.expectations import Expectations, split_violations
from martkit.session import new_path, scratch, staged
from martkit.sinks.files import SnapshotTable, append, register_views, replace_partition, replace_values, write_full, write_layout
from martkit.sinks.commits import CommitLog, compact, publish_batch, written_at_once
from martkit.sinks.hashed import hashed_table
from martkit.sinks.merge import CounterTable, KeyedTable, insert_missing
from martkit.sources.files import increment_path, load_csv_day, load_csv_full, read_increment_csv, read_reference
from martkit.sources.pages import read_json_pages
from martkit.sources.streams import decode_json
from martkit.streaming import campaigns, runner
from martkit.streaming import orders as order_stream
from martkit.streaming.lateness import deduplicating_sink
from martkit.streaming.progress import ProgressTable
from martkit.vault.loaders import load_satellite

Query = Callable[[SparkSession, str], DataFrame]

SINCE = "1997-01-01"
SALES_DAY, METRICS_DAY = "1997-01-15", "1999-02-18"
CAMPAIGN_NOW = 1705276800  # 2024-01-15 00:00:00 UTC


def big(c, name: str | None = None) -> Column:
    return F.col(c).cast("bigint").alias(name or c) if isinstance(c, str) else c.cast("bigint").alias(name)


def num(c, name: str | None = None) -> Column:
    return F.col(c).cast("double").alias(name or c) if isinstance(c, str) else c.cast("double").alias(name)


def text(c, name: str | None = None) -> Column:
    return F.col(c).cast("string").alias(name or c) if isinstance(c, str) else c.cast("string").alias(name)


# --- segmentation -----------------------------------------------------------


def _scores(df: DataFrame) -> DataFrame:
    return df.select(big("user_id"), big("recency"), big("frequency"), big("monetary_value"))


def rfm_segments(spark, sf) -> DataFrame:
    return _scores(rfm.rfm(r.users(spark, sf), r.orders(spark, sf), SINCE, closed="F"))


def rfm_recency_any(spark, sf) -> DataFrame:
    marts = rfm.rfm_recency_any(r.users(spark, sf), r.orders(spark, sf), SINCE, closed="F", cancelled="P")
    return _scores(marts)


def rfm_matrix(spark, sf) -> DataFrame:
    matrix = rfm.rfm_matrix(rfm.rfm(r.users(spark, sf), r.orders(spark, sf), SINCE, closed="F"))
    return matrix.select(big("recency"), *[big(f"{i}", f"f{i}") for i in range(1, 6)])


def order_latest_status(spark, sf) -> DataFrame:
    latest = rfm.orders_with_status(r.orders(spark, sf), r.status_log(spark, sf), ("dttm", *r.LOG_TIE))
    return latest.select(big("order_id"), text("order_ts"), big("user_id"), num("cost"), "status")


# --- shipping ---------------------------------------------------------------


def dim_country_rates(spark, sf) -> DataFrame:
    dim = shipping.country_rates(r.shipping_log(spark, sf))
    return dim.select(big("shipping_country_id"), "shipping_country", num("shipping_country_base_rate"))


def dim_agreements(spark, sf) -> DataFrame:
    dim = shipping.agreements(r.shipping_log(spark, sf))
    return dim.select(big("agreementid"), "agreement_number", num("agreement_rate"), num("agreement_commission"))


def dim_transfers(spark, sf) -> DataFrame:
    dim = shipping.transfers(r.shipping_log(spark, sf))
    return dim.select(big("transfer_type_id"), "transfer_type", "transfer_model", num("shipping_transfer_rate"))


def _shipping(spark, sf) -> dict[str, DataFrame]:
    # The joined log feeds three dimensions and two facts: write it down once.
    log = staged(r.shipping_log(spark, sf), "shipping-log")
    countries, kinds = shipping.country_rates(log), shipping.transfers(log)
    ships = staged(shipping.shipments(log, r.LOG_TIE), "shipments")
    return {
        "log": log,
        "countries": countries,
        "transfers": kinds,
        "agreements": shipping.agreements(log),
        "shipments": ships,
        "info": shipping.shipping_info(ships, countries, kinds),
    }


def shipping_info(spark, sf) -> DataFrame:
    return _shipping(spark, sf)["info"].select(
        big("shippingid"),
        text("shipping_plan_datetime"),
        num("payment_amount"),
        big("vendorid"),
        big("shipping_country_id"),
        big("transfer_type_id"),
        big("agreementid"),
    )


def shipping_status(spark, sf) -> DataFrame:
    status = shipping.shipping_status(r.shipping_log(spark, sf), r.LOG_TIE)
    return status.select(
        big("shippingid"),
        "status",
        "state",
        text("shipping_start_fact_datetime"),
        text("shipping_end_fact_datetime"),
    )


def _shipping_mart(spark, sf) -> tuple[DataFrame, dict[str, DataFrame]]:
    t = _shipping(spark, sf)
    return shipping.shipping_mart(t["shipments"], t["countries"], t["transfers"], t["agreements"]), t


def shipping_mart(spark, sf) -> DataFrame:
    mart, _ = _shipping_mart(spark, sf)
    return mart.select(
        big("shippingid"),
        big("vendorid"),
        "transfer_type",
        big("full_day_at_shipping"),
        big("is_delay"),
        big("is_shipping_finish"),
        big("delay_day_at_shipping"),
        num("payment_amount"),
        num("vat"),
        num("profit"),
    )


def delay_stats(spark, sf) -> DataFrame:
    mart, _ = _shipping_mart(spark, sf)
    return shipping.delay_stats(mart).select(
        big("is_shipping_finish"), big("is_delay"), big("shipment_count"), num("avg_payment"), num("avg_delay_days")
    )


# --- sales star -------------------------------------------------------------


def calendar_weeks(spark, sf) -> DataFrame:
    return r.order_calendar(spark, sf).select(
        big("date_id"),
        text("date_actual"),
        big("week_of_year"),
        text("first_day_of_week"),
        text("last_day_of_week"),
    )


def dim_insert_missing(spark, sf) -> DataFrame:
    """Customer dimension: loaded from the orders before 1996, then again from
    the whole log."""
    log = r.order_log(spark, sf)
    empty = spark.createDataFrame([], "customer_id bigint, last_name string, city_id int")
    args = ("customer_id", ["last_name", "city_id"], ["date_time", "id"])
    early = retention.load_dimension(empty, in_days(log, "date_time", "1995-01-01", "1996-01-01"), *args)
    late = retention.load_dimension(early, log, *args)
    both = early.withColumn("load", F.lit(1)).unionByName(late.withColumn("load", F.lit(2)))
    return both.select(big("customer_id"), "last_name", big("city_id"), big("load"))


def sales_fact_day(spark, sf) -> DataFrame:
    """Facts of every day of the log, as a back-fill loads them."""
    facts = retention.sales_fact(r.order_log(spark, sf), r.order_calendar(spark, sf))
    return facts.select(
        big("date_id"),
        big("item_id"),
        big("customer_id"),
        big("city_id"),
        big("quantity"),
        num("payment_amount"),
        "status",
    )


def sales_fact_one_day(spark, sf) -> DataFrame:
    """The daily load: facts of one day of the log."""
    facts = retention.sales_fact(r.order_log(spark, sf), r.order_calendar(spark, sf), SALES_DAY)
    return facts.select(big("date_id"), big("customer_id"), big("quantity"), num("payment_amount"), "status")


def _retention(spark, sf, mode: str) -> DataFrame:
    calendar = r.order_calendar(spark, sf)
    sales = retention.sales_fact(r.order_log(spark, sf), calendar)
    return retention.customer_retention(sales, calendar, mode).select(
        big("new_customers_count"),
        big("returning_customers_count"),
        big("refunded_customer_count"),
        "period_name",
        big("period_id"),
        big("item_id"),
        num("new_customers_revenue"),
        num("returning_customers_revenue"),
        big("customers_refunded"),
    )


def customer_retention(spark, sf) -> DataFrame:
    return _retention(spark, sf, "rows")


def customer_retention_distinct(spark, sf) -> DataFrame:
    return _retention(spark, sf, "customers")


# --- write semantics --------------------------------------------------------


def _event_rows(spark, sf) -> DataFrame:
    return r.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")


def upsert_latest(spark, sf) -> DataFrame:
    """Two overlapping loads into a keyed table, the second one twice, while its
    buckets split."""
    events = _event_rows(spark, sf)
    target = hashed_table(spark, new_path(spark, "upsert"), ["user_id", "event_type"], ["ts", "event_id"], limit=200, bits=0)
    target.upsert(events.filter("ts < timestamp_ntz '2024-01-20'"))
    for _ in range(2):
        target.upsert(in_days(events, "ts", "2024-01-10"))
    return target.read().select(big("user_id"), "event_type", text("ts"), big("event_id"), num("value"))


def insert_first(spark, sf) -> DataFrame:
    """First event per user and type; the second load adds only new keys."""
    events = _event_rows(spark, sf)
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    table = SnapshotTable(spark, new_path(spark, "first"))
    early = in_days(events, "ts", "2024-01-01", "2024-01-08")
    table.refresh(insert_missing(early.limit(0), early, keys, order))
    held = table.read()
    table.refresh(held.unionByName(insert_missing(held, events, keys, order)))
    return table.read().select(big("user_id"), "event_type", text("ts"), big("event_id"), num("value"))


def replace_day(spark, sf) -> DataFrame:
    """Events by day; the days from the 20th on are replaced by corrected
    values, twice."""
    events = _event_rows(spark, sf).withColumn("ds", F.to_date("ts"))
    path = new_path(spark, "days")
    replace_partition(events, path, "ds")
    corrected = in_days(events, "ts", "2024-01-20").withColumn("value", F.col("value") + 1)
    for _ in range(2):
        replace_partition(corrected, path, "ds")
    return spark.read.parquet(path).select(big("event_id"), num(F.round("value", 2), "value"), text("ds"))


def accumulate_batches(spark, sf) -> DataFrame:
    """Counters over three batches, one of them repeated, with a compaction in
    between."""
    events = _event_rows(spark, sf).withColumn("cnt", F.lit(1))
    table = CounterTable(spark, new_path(spark, "counters"), ["user_id", "event_type"], "cnt")
    first = events.filter("ts < timestamp_ntz '2024-01-10'")
    batches = [first, in_days(events, "ts", "2024-01-10", "2024-01-20"), in_days(events, "ts", "2024-01-20")]
    table.add(batches[0], 0)
    table.add(batches[1], 1)
    table.compact()
    table.add(batches[1], 1)
    table.add(batches[2], 2)
    return table.read().select(big("user_id"), "event_type", big("cnt"))


def upsert_other_width(spark, sf) -> DataFrame:
    """The keyed table again, with keys of another integer width in the second
    load."""
    events = _event_rows(spark, sf)
    target = hashed_table(spark, new_path(spark, "upsert"), ["user_id", "event_type"], ["ts", "event_id"], limit=200)
    target.upsert(events.filter("ts < timestamp_ntz '2024-01-20'"))
    target.upsert(in_days(events, "ts", "2024-01-10").withColumn("user_id", F.col("user_id").cast("int")))
    return target.read().select(big("user_id"), "event_type", text("ts"), big("event_id"), num("value"))


def daily_increments(spark, sf) -> DataFrame:
    """Three days of an order log as CSV in folders by day, each line twice,
    loaded day by day."""
    root = new_path(spark, "increments")
    orders = r.orders(spark, sf).select(F.col("order_id").alias("id"), F.col("order_ts").alias("date_time"), "cost", "status")
    days = ["1997-01-15", "1997-01-16", "1997-01-17"]
    schema = T.StructType.fromDDL("id long, date_time timestamp_ntz, cost decimal(14,2), status string")
    loaded = []
    for ds in days:
        day = on_day(orders, "date_time", ds)
        day.unionByName(day).write.option("header", True).csv(increment_path(root, ds, "user_order_log.csv"))
        rows = read_increment_csv(spark, root, ds, schema)
        loaded.append(rows.groupBy("status").agg(F.count("*").alias("n"), F.sum("cost").alias("cost")).select(F.lit(ds).alias("ds"), "*"))
    return r.union_all(loaded).select("ds", "status", big("n"), num("cost"))


def day_csv(spark, sf) -> DataFrame:
    """One day's file with a header and a mark for nulls, some lines damaged."""
    orders = on_day(r.orders(spark, sf), "order_ts", "1997-01-15")
    cost = F.when(F.col("order_id") % 3 == 0, "null").otherwise(F.col("cost").cast("string")).alias("cost")
    key = F.when(F.col("order_id") % 7 == 0, "none").otherwise(F.col("order_id").cast("string")).alias("id")
    path = new_path(spark, "day")
    orders.select(key, cost, "status").write.option("header", True).csv(path)
    good, rejected = load_csv_day(spark, path, T.StructType.fromDDL("id long, cost decimal(14,2), status string"))
    kept = good.select("id", F.col("cost").cast("double").alias("cost"), "status")
    lost = rejected.agg(F.count("*").alias("id")).select(big("id"), F.lit(None).cast("double").alias("cost"), F.lit("rejected").alias("status"))
    return kept.unionByName(lost)


def reference_menus(spark, sf) -> DataFrame:
    """Restaurants with their menus as JSON documents, read back."""
    path = new_path(spark, "reference")
    menus = r.event_restaurants(r.table(spark, sf, "events"))
    menus.write.json(path)
    read = read_reference(spark, path, menus.schema)
    return read.select("id", "name", F.explode("menu").alias("m")).select("id", "name", F.col("m._id").alias("item"), F.col("m.category").alias("category"))


def rolling_days(spark, sf) -> DataFrame:
    """Orders of the thirty days before a moment."""
    recent = since(r.orders(spark, sf), "order_ts", 30, "1998-01-01 12:00:00")
    return recent.select(big("order_id"), text("order_ts"))


def appended_views(spark, sf) -> DataFrame:
    """A mart written anew twice, a table appended to twice, and a view of some
    columns of both."""
    orders, root = r.orders(spark, sf), new_path(spark, "views")
    for part in (orders.limit(5), orders):
        write_full(part, f"{root}/full")
    for _ in range(2):
        append(orders.filter("status = 'F'"), f"{root}/added")
    tag = uuid.uuid4().hex
    views = {f"{name}_{tag}": (spark.read.parquet(f"{root}/{name}"), ["order_id", "status"]) for name in ("full", "added")}
    register_views(views)
    full, added = views
    return spark.sql(
        f"select status, count(*) as n, sum(a.n) as added from {full} left join (select order_id, count(*) as n from {added} group by order_id) a"
        " using (order_id) group by status"
    ).select("status", big("n"), big("added"))


def chat_staging(spark, sf) -> DataFrame:
    """Chat tables as CSV without header, staged twice; rows that break a
    reference are set aside with the reason."""
    source, target = new_path(spark, "chat"), new_path(spark, "staging")
    for name, df in r.community(spark, sf).items():
        df.select(*SCHEMAS[name].names).write.csv(f"{source}/{name}.csv")
    for _ in range(2):
        kept, rejected = stage_csv(spark, source, target)
    shown = [df.groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), F.lit("kept").alias("state"), big("n")) for name, df in kept.items()]
    shown += [df.groupBy(F.col("reason").alias("state")).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "state", big("n")) for name, df in rejected.items()]
    return r.union_all(shown)


def emptied_day(spark, sf) -> DataFrame:
    """Two named days are replaced; one of them has no rows any more."""
    events = _event_rows(spark, sf).withColumn("ds", F.to_date("ts"))
    path = new_path(spark, "days")
    replace_partition(events, path, "ds")
    corrected = on_day(events, "ts", "2024-01-10").withColumn("value", F.col("value") + 1)
    for _ in range(2):
        replace_values(corrected, path, "ds", ["2024-01-10", "2024-01-11"])
    return spark.read.parquet(path).select(big("event_id"), num(F.round("value", 2), "value"), text("ds"))


def late_satellite(spark, sf) -> DataFrame:
    """Attributes that change, return, arrive late and arrive twice: half of the
    events first, then all of them, then all again."""
    return _late_loads(r.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id"))


def _late_loads(rows: DataFrame) -> DataFrame:
    known = None
    for load in (rows.filter("event_id % 2 = 1"), rows, rows):
        fresh = load_satellite(
            known, load, "hk_user", ["event_type"], "events", F.lit("2024-02-01").cast("timestamp_ntz"),
            mode="hashdiff", order_by=["ts", "event_id"], key="user_id", key_of=partial(hash_key, algorithm="md5"),
        )
        known = staged(fresh if known is None else known.unionByName(fresh), "satellite")
    return known.select("hk_user", "event_type", text("ts"))


def key_parts(spark, sf) -> DataFrame:
    """Keys of parts that are null, hold the separator, or look like the mark."""
    part = r.table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 3 != 0, F.replace("p_name", F.lit(" "), F.lit("|"))).alias("a"),
        F.when(F.col("p_partkey") % 5 != 0, F.concat(F.lit("\\N"), "p_type", F.lit("\\"))).alias("b"),
    )
    keys = hash_key("a", "b", algorithm="md5"), hash_key("b", algorithm="md5")
    return part.select(big("p_partkey"), keys[0].alias("pair_key"), keys[1].alias("single_key"))


def rejected_lines(spark, sf) -> DataFrame:
    """Customers as lines without header, some of them damaged, loaded back:
    readable rows and rejected lines."""
    damaged = F.when(F.col("c_custkey") % 7 == 0, F.lit("none")).otherwise(F.col("c_custkey").cast("string"))
    lines = r.table(spark, sf, "customer").select(F.concat_ws(",", damaged, F.col("c_nationkey").cast("string"), "c_mktsegment").alias("value"))
    path = new_path(spark, "lines")
    lines.write.text(path)
    fields = [T.StructField("id", T.LongType()), T.StructField("nation", T.IntegerType()), T.StructField("segment", T.StringType())]
    good, rejected = load_csv_full(spark, path, T.StructType(fields))
    kept = good.groupBy("nation", "segment").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))
    lost = rejected.groupBy(F.lit(-1).alias("nation"), F.lit("rejected").alias("segment")).agg(F.count("*").alias("n"), F.lit(0).alias("ids"))
    return kept.unionByName(lost).select(big("nation"), "segment", big("n"), big("ids"))


def unkeyed_documents(spark, sf) -> DataFrame:
    """Documents by object id, and those without a readable id."""
    props = F.when(F.col("event_id") % 11 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct(F.col("user_id").alias("_id"), "event_type")))
    pages = r.table(spark, sf, "events").select("event_id", props.alias("document"), F.col("ts").alias("loaded_at"))
    kept = ledger.stage_documents(pages, "_id").select(F.col("object_id").alias("id"), F.lit("kept").alias("state"))
    lost = ledger.without_id(pages, "_id").select(F.col("event_id").cast("string").alias("id"), F.lit("rejected").alias("state"))
    return kept.unionByName(lost)


# --- documents and ledger ---------------------------------------------------


def json_entities(spark, sf) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType())])
    good, _ = split_corrupt(parse_json_column(r.table(spark, sf, "events"), "props", schema, ["event_id", "event_type"]))
    return good.select(big("event_id"), "event_type", big("k"))


def _entities(spark, sf) -> dict[str, DataFrame]:
    courier_pages, delivery_pages = r.delivery_documents(spark, sf)
    couriers = ledger.stage_documents(courier_pages, "_id")
    deliveries = ledger.stage_documents(delivery_pages, "order_id")
    # Parsed into orders, details and sales: staged as the warehouse does.
    return ledger.delivery_entities(couriers, staged(deliveries, "deliveries"), save=staged)


def delivery_entities(spark, sf) -> DataFrame:
    e = _entities(spark, sf)
    sales = e["sales"].join(e["orders"], "order_id").join(e["details"], "delivery_id")
    return sales.select(
        "order_id",
        text("order_ts"),
        "delivery_id",
        "courier_id",
        text("delivery_ts"),
        big("rate"),
        num("order_sum"),
        num("tip_sum"),
    )


def _ledger(spark, sf) -> tuple[DataFrame, dict[str, DataFrame]]:
    e = _entities(spark, sf)
    return ledger.courier_ledger(e["sales"], e["orders"], e["details"], e["couriers"]), e


def courier_ledger(spark, sf) -> DataFrame:
    mart, _ = _ledger(spark, sf)
    return mart.select(
        "courier_id",
        "courier_name",
        big("settlement_year"),
        big("settlement_month"),
        big("orders_count"),
        num("orders_total_sum"),
        num("rate_avg"),
        num("order_processing_fee"),
        num("courier_order_sum"),
        num("courier_tips_sum"),
        num("courier_reward_sum"),
    )


# --- community vault --------------------------------------------------------

_FIRST_LOAD, _SECOND_LOAD = "2024-01-16 00:00:00", "2024-02-01 00:00:00"


def _community(spark, sf, *tables: str) -> dict[str, DataFrame]:
    staging = r.community(spark, sf)
    stamp = lambda t: F.lit(t).cast("timestamp_ntz")
    load = partial(conversion.load_community_vault, algorithm="md5", tables=tables)
    early = load(r.community_before(staging), stamp(_FIRST_LOAD), save=staged)
    return load(staging, stamp(_SECOND_LOAD), early, save=staged)


def vault_hubs(spark, sf) -> DataFrame:
    v = _community(spark, sf, "h_users", "h_dialogs", "h_groups")

    def hub(name, hk, key, ts):
        return v[name].select(
            F.lit(name).alias("hub"), F.col(hk).alias("hk"), big(key, "business_key"), text(ts, "at"), text("load_dt"), "load_src"
        )

    return r.union_all(
        [
            hub("h_users", "hk_user_id", "user_id", "registration_dt"),
            hub("h_dialogs", "hk_message_id", "message_id", "message_ts"),
            hub("h_groups", "hk_group_id", "group_id", "registration_dt"),
        ]
    )


def vault_links(spark, sf) -> DataFrame:
    v = _community(spark, sf, "l_admins", "l_groups_dialogs", "l_user_message", "l_user_group_activity")

    def link(name, hk, first, second):
        return v[name].select(
            F.lit(name).alias("link"),
            F.col(hk).alias("hk"),
            F.col(first).alias("hk_first"),
            F.col(second).alias("hk_second"),
            text("load_dt"),
            "load_src",
        )

    return r.union_all(
        [
            link("l_admins", "hk_l_admin_id", "hk_group_id", "hk_user_id"),
            link("l_groups_dialogs", "hk_l_groups_dialogs", "hk_group_id", "hk_message_id"),
            link("l_user_message", "hk_l_user_message", "hk_user_id", "hk_message_id"),
            link("l_user_group_activity", "hk_l_user_group_activity", "hk_group_id", "hk_user_id"),
        ]
    )


def vault_satellites(spark, sf) -> DataFrame:
    names = ("s_admins", "s_group_name", "s_group_private_status", "s_dialog_info", "s_user_socdem", "s_user_chatinfo")
    v = _community(spark, sf, *names)

    def satellite(name, hk, *attrs):
        return v[name].select(
            F.lit(name).alias("satellite"),
            F.col(hk).alias("hk"),
            F.concat_ws("|", *[F.col(a).cast("string") for a in attrs]).alias("attributes"),
            text("load_dt"),
            "load_src",
        )

    return r.union_all(
        [
            satellite("s_admins", "hk_admin_id", "is_admin", "admin_from"),
            satellite("s_group_name", "hk_group_id", "group_name"),
            satellite("s_group_private_status", "hk_group_id", "is_private"),
            satellite("s_dialog_info", "hk_message_id", "message", "message_from", "message_to"),
            satellite("s_user_socdem", "hk_user_id", "country", "age"),
            satellite("s_user_chatinfo", "hk_user_id", "chat_name"),
        ]
    )


def vault_history(spark, sf) -> DataFrame:
    return _community(spark, sf, "s_auth_history")["s_auth_history"].select(
        F.col("hk_l_user_group_activity").alias("hk"),
        big("user_id_from"),
        "event",
        text("event_dt"),
        text("load_dt"),
        "load_src",
    )


def group_conversion(spark, sf) -> DataFrame:
    stamp = F.lit(_SECOND_LOAD).cast("timestamp_ntz")
    vault = conversion.load_community_vault(
        r.community(spark, sf), stamp, algorithm="md5", tables=conversion.CONVERSION_TABLES, save=staged
    )
    return conversion.group_conversion(vault).select(
        "hk_group_id",
        big("cnt_added_users"),
        big("cnt_users_in_group_with_messages"),
        num("group_conversion"),
    )


# --- geo --------------------------------------------------------------------


def nearest_city(spark, sf) -> DataFrame:
    placed = travel.nearest_city(r.geo_events(spark, sf), cities(spark))
    return placed.select(
        big("message_id"), big("user_id"), "city", num(F.round("distance_km", 3), "distance_km")
    )


def user_travel(spark, sf) -> DataFrame:
    return _travel(spark, sf, False)


def user_travel_strict(spark, sf) -> DataFrame:
    return _travel(spark, sf, True)


def _travel(spark, sf, strict: bool) -> DataFrame:
    mart = travel.user_travel(r.geo_events(spark, sf), cities(spark), zone_table(spark), strict_current=strict)
    return mart.select(
        big("user_id"),
        "act_city",
        "home_city",
        big("travel_count"),
        F.array_join("travel_array", ">").alias("travel_array"),
        text("local_time"),
    )


def travel_chunks(spark, sf) -> DataFrame:
    """The cities of each user's stays, five to a row."""
    stays = travel.stays_of(r.geo_events(spark, sf), cities(spark))
    chunks = travel.travel_chunks(stays, 5)
    return chunks.select(big("user_id"), big("chunk"), big(F.size("values"), "n"), F.array_join("values", ">").alias("cities"))


def nearest_of_many(spark, sf) -> DataFrame:
    """Orders and the nearest of as many places as there are customers; places
    repeat, and some orders are far from all of them."""
    at = lambda c, a, b, span, low: F.pmod(F.col(c) * a + b, F.lit(span)) / 100.0 - low
    centers = r.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("city"), at("c_custkey", 3571, 7, 7000, 10).alias("lat"), at("c_custkey", 9241, 5, 12000, 20).alias("lon")
    )
    key = F.floor(F.col("o_orderkey") / 3).alias("k")  # so that points repeat
    points = r.table(spark, sf, "orders").select("o_orderkey", key).select(
        big("o_orderkey", "order_id"), at("k", 6151, 3, 17000, 85).alias("lat"), at("k", 15485, 11, 36000, 180).alias("lon")
    )
    found = nearest(points, centers)
    return found.select("order_id", big("city_id"), num(F.round("distance_km", 3), "distance_km"))


def split_pages(spark, sf) -> DataFrame:
    """Events as JSON arrays, one page per type, some records damaged; each page
    is read by several tasks. Texts hold quotes and braces."""
    events = r.table(spark, sf, "events")
    whole = F.to_json(F.struct("event_id", "event_type", F.struct("props").alias("more"), F.lit('say "}{" \\').alias("note")))
    record = F.when(F.col("event_id") % 50 == 0, F.regexp_replace(whole, '"event_id":\\d+', '"event_id":')).otherwise(whole)
    ends = events.groupBy("event_type").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    sign = lambda c, a, b: F.when(F.col("event_id") == F.col(c), a).otherwise(b)
    lines = events.join(ends, "event_type").select(F.concat(sign("first", "[", ""), record, sign("last", "]", ",")).alias("value"), "event_type", "event_id")
    path = new_path(spark, "landed")
    ordered = lines.repartition(F.col("event_type")).sortWithinPartitions("event_type", "event_id")
    ordered.select("value", F.col("event_type").alias("page")).write.partitionBy("page").text(path)
    schema = T.StructType.fromDDL("event_id long, event_type string, more struct<props: string>, note string")
    good, broken = read_json_pages(spark, path, schema, stretch=4096)
    kind = F.regexp_extract("path", "page=(\\w+)/", 1)
    kept = good.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.sum(F.get_json_object("more.props", "$.k").cast("long")).alias("ks"))
    lost = broken.groupBy(F.concat(F.lit("broken "), kind).alias("event_type")).agg(F.count("*").alias("n"))
    empty = [F.lit(0).cast("bigint").alias(c) for c in ("ids", "ks")]
    return kept.select("event_type", big("n"), big("ids"), big("ks")).unionByName(lost.select("event_type", big("n"), *empty))


def zone_stats(spark, sf) -> DataFrame:
    mart = zones.zone_stats(r.geo_events(spark, sf), cities(spark))
    counts = [f"{p}_{k}" for k in ("message", "user", "reaction", "subscription") for p in ("week", "month")]
    return mart.select(text("month"), text("week"), "zone_id", *[big(c) for c in counts])


def friend_recommendations(spark, sf) -> DataFrame:
    mart = recommend.friend_recommendations(r.geo_events(spark, sf), cities(spark), zone_table(spark), "2024-02-01")
    return mart.select(
        big("user_left"), big("user_right"), "zone_id", text("local_time"), text("processed_dttm")
    )


def near_users(spark, sf) -> DataFrame:
    positions = staged(recommend.last_positions(r.geo_events(spark, sf)), "positions")
    return near_pairs(positions, 1.0).select(big("user_left"), big("user_right"), num("distance_km"))


def contacts(spark, sf) -> DataFrame:
    sent = travel.events_of(r.geo_events(spark, sf), "message").select(
        F.col("event.message_from").alias("a"), F.col("event.message_to").alias("b")
    )
    return undirected(sent, "a", "b").select(big("user_left"), big("user_right"))


# --- order messages ---------------------------------------------------------


def _enriched(spark, sf, messages: DataFrame | None = None) -> DataFrame:
    messages = r.order_messages(spark, sf) if messages is None else messages
    good, _ = order_plans.enrich_orders(messages, r.order_users(spark, sf), r.restaurants(spark, sf))
    return good


def raw_orders(spark, sf) -> DataFrame:
    raw = order_plans.raw_orders(r.order_messages(spark, sf))
    schema = T.StructType(
        [T.StructField("final_status", T.StringType()), T.StructField("cost", T.DecimalType(14, 2))]
    )
    parsed = parse_json_column(raw, "payload", schema, ["object_id", "object_type", "sent_dttm"])
    return parsed.select("object_id", "object_type", "sent_dttm", "final_status", num("cost"))


def order_enrichment(spark, sf) -> DataFrame:
    messages = order_plans.build_order_message(_enriched(spark, sf)).select("object_id", "payload.*")
    lines = messages.select("object_id", "date", "cost", "status", "restaurant", "user", F.posexplode("products"))
    return lines.select(
        "object_id",
        "date",
        num("cost"),
        "status",
        F.col("restaurant.id").alias("restaurant_id"),
        F.col("restaurant.name").alias("restaurant_name"),
        F.col("user.id").alias("user_id"),
        F.col("user.name").alias("user_name"),
        big("pos", "line"),
        F.col("col.id").alias("product_id"),
        num("col.price", "price"),
        big("col.quantity", "quantity"),
        F.col("col.name").alias("product_name"),
        F.col("col.category").alias("category"),
    )


def _product_rows(spark, sf) -> DataFrame:
    return counters.product_rows(order_plans.build_product_message(_enriched(spark, sf)))


def product_counters(spark, sf) -> DataFrame:
    mart = counters.user_product_counters(_product_rows(spark, sf))
    return mart.select("user_id", "product_id", "product_name", big("order_cnt"))


def category_counters(spark, sf) -> DataFrame:
    mart = counters.user_category_counters(_product_rows(spark, sf))
    return mart.select("user_id", "category_id", "category_name", big("order_cnt"))


def _order_vault(spark, sf, tables) -> dict[str, DataFrame]:
    """Loaded from the orders before 1998, then again from all orders."""
    with scratch(numbered(r.order_messages(spark, sf)), "messages") as messages:
        enriched = staged(_enriched(spark, sf, messages), "enriched")
    stamp = lambda t: F.lit(t).cast("timestamp_ntz")
    early = enriched.filter(F.col("date") < "1998-01-01")
    load = partial(order_plans.load_order_vault, tables=tables)
    initial = load(early, stamp("1998-01-01 00:00:00"))
    held = written_at_once({name: partial(staged, df, name) for name, df in initial.items()})
    return load(enriched, stamp("2002-01-01 00:00:00"), held)


def vault_uuid5_hubs(spark, sf) -> DataFrame:
    keys = {
        "h_user": "user_id",
        "h_product": "product_id",
        "h_category": "category_name",
        "h_restaurant": "restaurant_id",
        "h_order": "order_id",
    }
    v = _order_vault(spark, sf, keys)
    return r.union_all(
        [
            v[name].select(
                F.lit(name).alias("hub"), F.col(f"{name}_pk").alias("pk"), F.col(key).alias("business_key"), text("load_dt"), "load_src"
            )
            for name, key in keys.items()
        ]
    )


def vault_uuid5_links(spark, sf) -> DataFrame:
    parents = {
        "l_order_product": ("h_order_pk", "h_product_pk"),
        "l_product_restaurant": ("h_product_pk", "h_restaurant_pk"),
        "l_product_category": ("h_product_pk", "h_category_pk"),
        "l_order_user": ("h_order_pk", "h_user_pk"),
    }
    v = _order_vault(spark, sf, parents)
    return r.union_all(
        [
            v[name].select(
                F.lit(name).alias("link"),
                F.col(f"hk_{name[2:]}_pk").alias("pk"),
                F.col(a).alias("first_pk"),
                F.col(b).alias("second_pk"),
                text("load_dt"),
            )
            for name, (a, b) in parents.items()
        ]
    )


def vault_uuid5_satellites(spark, sf) -> DataFrame:
    columns = {
        "s_user_names": ("h_user_pk", ["username", "userlogin"]),
        "s_product_names": ("h_product_pk", ["name"]),
        "s_restaurant_names": ("h_restaurant_pk", ["name"]),
        "s_order_cost": ("h_order_pk", ["cost", "payment"]),
        "s_order_status": ("h_order_pk", ["status"]),
    }
    v = _order_vault(spark, sf, columns)
    return r.union_all(
        [
            v[name].select(
                F.lit(name).alias("satellite"),
                F.col(hk).alias("pk"),
                F.concat_ws("|", *[F.col(a).cast("string") for a in attrs]).alias("attributes"),
                text("order_dt"),
                F.col(f"hk_{name[2:]}_hashdiff").alias("hash_diff"),
                text("load_dt"),
            )
            for name, (hk, attrs) in columns.items()
        ]
    )


# --- transactions -----------------------------------------------------------


def global_metrics(spark, sf) -> DataFrame:
    mart = fx_metrics.global_metrics(r.transactions(spark, sf), r.rates(spark, sf))
    return mart.select(
        text("date_update"),
        big("currency_from"),
        num("amount_total"),
        big("cnt_transactions"),
        num("avg_transactions_per_account"),
        big("cnt_accounts_make_transactions"),
    )


def transactions_without_rate(spark, sf) -> DataFrame:
    lost = fx_metrics.without_rate(r.transactions(spark, sf), r.rates(spark, sf))
    return lost.select("operation_id", big("currency_code"), big("amount"), text("transaction_dt"))


def monthly_accounts(spark, sf) -> DataFrame:
    """Accounts per month and currency, out of bitmaps stored by day."""
    valid = r.transactions(spark, sf).filter((F.col("status") == "done") & (F.col("account_number_from") >= 0))
    used = valid.select(F.to_date("transaction_dt").alias("day"), "currency_code", F.col("account_number_from").alias("account"))
    numbers = surrogate_key(used.select("account").distinct(), "account", "number")
    days = staged(id_bitmaps(used.join(numbers, "account"), ["day", "currency_code"], "number"), "day-bitmaps")
    months = united(days.withColumn("month", F.date_format("day", "yyyy-MM")), ["month", "currency_code"])
    counts = distinct_counts(months, ["month", "currency_code"], "cnt_accounts")
    return counts.select("month", big("currency_code", "currency_from"), big("cnt_accounts"))


# --- operators --------------------------------------------------------------


def layout_join(spark, sf) -> DataFrame:
    """Order lines by order from two tables laid out in the same buckets: no
    shuffle between the files and the result."""
    tag = uuid.uuid4().hex
    names = {t: f"layout_{t}_{tag}" for t in ("orders", "lineitem")}
    for t, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        write_layout(r.table(spark, sf, t), names[t], bucket_by=[key], sort_by=[key], buckets=16, path=new_path(spark, t))
    orders, lines = (spark.table(names[t]) for t in ("orders", "lineitem"))
    joined = orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    per_order = joined.groupBy("o_orderkey").agg(F.first("o_custkey").alias("user_id"), F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
    return per_order.select(big("o_orderkey", "order_id"), big("user_id"), big("n"), num("quantity"))


def previous_events(spark, sf) -> DataFrame:
    """The event before each one of the same user, a third of all events being
    of one user."""
    events = r.table(spark, sf, "events").select("event_id", "ts", "event_type", _hot_user().alias("user_id"))
    rows = with_previous(events, ["user_id"], ["ts", "event_id"], {"before": "event_id", "type_before": "event_type"})
    return rows.select(big("event_id"), big("user_id"), big("before"), "type_before", F.col("_has_previous").alias("has_before"))


def _hot_user() -> Column:
    return F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id"))


def hot_satellite(spark, sf) -> DataFrame:
    """``late_satellite`` with a third of all rows under one key."""
    rows = r.table(spark, sf, "events").select(_hot_user().alias("user_id"), "event_type", "ts", "event_id")
    return _late_loads(rows)


def row_numbers(spark, sf) -> DataFrame:
    numbered = global_row_number(r.orders(spark, sf).select("order_id", "cost"), ["cost", "order_id"])
    return numbered.select(big("order_id"), big("rn"))


def global_metrics_one_day(spark, sf) -> DataFrame:
    """The daily load: one day copied into the staging table, then its metrics."""
    path = new_path(spark, "transactions")
    for _ in range(2):
        fx_metrics.copy_day(r.transactions(spark, sf), path, "transaction_dt", METRICS_DAY)
    mart = fx_metrics.global_metrics(spark.read.parquet(path).drop("ds"), r.rates(spark, sf), METRICS_DAY)
    return mart.select(text("date_update"), big("currency_from"), num("amount_total"), big("cnt_transactions"))


def quintile_rows(spark, sf) -> DataFrame:
    """The quintile of every row."""
    order = ["l_quantity", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    tiled = global_ntile(r.table(spark, sf, "lineitem").select(*order), 5, order)
    return tiled.select(big("l_orderkey"), big("l_linenumber"), big("l_partkey"), num("l_quantity"), big("tile"))


def quintiles(spark, sf) -> DataFrame:
    """Quintiles of a column with few values, so most rows are ties."""
    lines = r.table(spark, sf, "lineitem").select("l_quantity", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    order = ["l_quantity", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    tiled = global_ntile(lines, 5, order)
    return tiled.groupBy("tile").agg(
        F.count("*").alias("n"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"), F.sum("l_orderkey").alias("keys")
    ).select(big("tile"), big("n"), num("low"), num("high"), big("keys"))


def event_runs(spark, sf) -> DataFrame:
    runs = islands(r.table(spark, sf, "events"), "user_id", ["ts", "event_id"], "event_type", stage_runs=True)
    return runs.select(
        big("user_id"), big("island"), "event_type", text("first_at"), text("last_at"), big("n")
    )


def group_statistics(spark, sf) -> DataFrame:
    lines = r.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag")
    stats = with_group_stat(
        lines,
        ["l_suppkey", "l_returnflag"],
        avg_quantity=F.avg("l_quantity"),
        n_rows=F.count("*"),
        n_large=F.count_if(F.col("l_quantity") > 25),
    )
    return stats.select(
        big("l_orderkey"),
        big("l_partkey"),
        big("l_suppkey"),
        big("l_linenumber"),
        text("l_shipdate"),
        num(F.round("avg_quantity", 6), "avg_quantity"),
        big("n_rows"),
        big("n_large"),
    )


def duplicate_lines(spark, sf) -> DataFrame:
    found = duplicates(r.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return found.select(big("l_orderkey"), big("l_linenumber"), big("surplus"))


def oldest_orders(spark, sf) -> DataFrame:
    top = top_n(r.orders(spark, sf), 10, "order_ts", "order_id")
    return top.select(big("order_id"), text("order_ts"), num("cost"))


def customers_without_closed_orders(spark, sf) -> DataFrame:
    closed = r.orders(spark, sf).filter(F.col("status") == "F")
    placed = closed.select(F.col("user_id").alias("id"))
    idle, _ = missing_from(r.users(spark, sf), placed, "id")
    return idle.select(big("id"), "name")


def constraint_report(spark, sf) -> DataFrame:
    """Violations of table constraints on the order lines, by rule."""
    lines = r.table(spark, sf, "lineitem")
    rules = Expectations(
        not_null=["l_orderkey", "l_shipdate"],
        checks={"quantity": F.col("l_quantity") <= 45, "discount": F.col("l_discount") < F.lit(0.1)},
        unique=[["l_orderkey", "l_linenumber"]],
        references={"l_partkey": (r.table(spark, sf, "part"), "p_partkey")},
    )
    _, bad = split_violations(lines, rules)
    return bad.select(F.explode("violated").alias("rule")).groupBy("rule").agg(F.count("*").alias("n")).select("rule", big("n"))


def order_keys(spark, sf) -> DataFrame:
    return r.orders(spark, sf).select(
        big("order_id"), uuid5_key("order_id").alias("order_pk"), uuid5_key("user_id", "order_id").alias("link_pk")
    )


# --- quality ----------------------------------------------------------------


def quality_report(spark, sf) -> DataFrame:
    def shipped():
        mart, ship = _shipping_mart(spark, sf)
        return staged(mart, "shipping-mart"), ship

    def settled():
        month, entities = _ledger(spark, sf)
        return staged(month, "ledger"), entities

    # The marts do not depend on each other, so their jobs fill the cores together.
    built = written_at_once(
        {
            "rfm": lambda: staged(rfm.rfm(r.users(spark, sf), r.orders(spark, sf), SINCE, closed="F"), "rfm"),
            "shipping": shipped,
            "ledger": settled,
            "vault": lambda: _community(spark, sf, "h_users", "h_dialogs", "h_groups", "l_admins", "s_user_socdem"),
        }
    )
    scores, vault = built["rfm"], built["vault"]
    (mart, ship), (month, entities) = built["shipping"], built["ledger"]
    dims = ship["info"].select("shippingid", "shipping_country_id", "transfer_type_id", "agreementid")
    recomputed = (
        mart.join(dims, "shippingid")
        .join(ship["countries"], "shipping_country_id")
        .join(ship["transfers"], ["transfer_type_id", "transfer_type"])
        .join(ship["agreements"], "agreementid")
    )
    tables = {
        "rfm": scores,
        "users": r.users(spark, sf),
        "shipping": mart,
        "shipping_terms": recomputed,
        "shipping_log": ship["log"],
        "ledger": month,
        "details": entities["details"],
        "staging_users": r.community(spark, sf)["users"],
        "h_users": vault["h_users"],
        "h_dialogs": vault["h_dialogs"],
        "h_groups": vault["h_groups"],
        "l_admins": vault["l_admins"],
        "s_user_socdem": vault["s_user_socdem"],
    }
    return dq.run_checks(tables, standard_checks()).select("check_name", big("measured_value"), "status")


_SCORES = ("recency", "frequency", "monetary_value")
_SUMS = (
    "orders_total_sum",
    "rate_avg",
    "order_processing_fee",
    "courier_order_sum",
    "courier_tips_sum",
    "courier_reward_sum",
)


def standard_checks() -> list[dq.Check]:
    """The 17 checks of the marts."""
    tax = F.col("shipping_country_base_rate") + F.col("agreement_rate") + F.col("shipping_transfer_rate")
    pay = F.col("payment_amount")
    return [
        dq.not_null("rfm: no nulls", "rfm", *_SCORES),
        dq.in_range("rfm: scores in 1..5", "rfm", 1, 5, *_SCORES),
        dq.row_count_equals("rfm: one row per user", "rfm", "users"),
        dq.not_null("shipping: no nulls", "shipping", "shippingid", "vendorid", "payment_amount", "vat", "profit"),
        dq.in_range(
            "shipping: no negatives", "shipping", 0, None, "full_day_at_shipping", "delay_day_at_shipping", "payment_amount", "vat", "profit"
        ),
        dq.recompute_within(
            "shipping: vat and profit",
            "shipping_terms",
            0.01,
            (F.col("vat"), pay * tax),
            (F.col("profit"), pay * F.col("agreement_commission")),
        ),
        dq.row_count_equals("shipping: all shipments", "shipping", "shipping_log", distinct="shippingid"),
        dq.not_null("ledger: no nulls", "ledger", "courier_id", "courier_name", "settlement_year", "settlement_month", "orders_count", *_SUMS),
        dq.in_range("ledger: no negatives", "ledger", 0, None, "orders_count", *_SUMS),
        dq.recompute_within(
            "ledger: reward formula",
            "ledger",
            0.01,
            (F.col("courier_reward_sum"), F.col("courier_order_sum") + F.col("courier_tips_sum") * F.lit("0.95").cast("decimal(3,2)")),
        ),
        dq.unique_key("ledger: one row per courier and month", "ledger", "courier_id", "settlement_year", "settlement_month"),
        dq.in_range("deliveries: rating in 1..5", "details", 1, 5, "rate"),
        dq.not_empty("staging: users loaded", "staging_users"),
        dq.not_null("hub users: keys", "h_users", "hk_user_id", "user_id"),
        dq.not_null("hub dialogs: keys", "h_dialogs", "hk_message_id", "message_id"),
        dq.references("link admins: parents exist", "l_admins", ("hk_user_id", "h_users"), ("hk_group_id", "h_groups")),
        dq.row_count_equals("satellite socdem: as long as hub", "h_users", "s_user_socdem"),
    ]


# --- streams ----------------------------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event table as a file stream, whether it is one file or a folder."""
    schema = r.table(spark, sf, "events").schema
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/events.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema)
    if fs.getFileStatus(path).isDirectory():
        return reader.parquet(f"{sf}/events.parquet")
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf)


def _run(df: DataFrame, sink, spark: SparkSession, name: str) -> None:
    query = runner.start(df, sink, new_path(spark, f"{name}-checkpoint"), available_now=True)
    query.awaitTermination()


def stream_campaigns(spark, sf) -> DataFrame:
    """Campaign messages as JSON, active on a fixed day, to two targets."""
    messages = to_message(r.campaign_rows(_event_stream(spark, sf)))
    decoded = decode_json(messages, campaigns.CAMPAIGN)
    now = F.lit(CAMPAIGN_NOW)
    triggers = campaigns.campaign_triggers(decoded, r.subscribers(spark, sf), now)
    log = CommitLog(spark, new_path(spark, "campaigns"))
    _run(triggers, runner.committed_sink(log, {"feedback": runner.feedback_target, "messages": runner.message_target}), spark, "campaigns")
    sent = decode_json(log.read("messages"), campaigns.CAMPAIGN + ", client_id string")
    stored = log.read("feedback").groupBy("adv_campaign_id", "client_id", "datetime_created").agg(
        F.count("*").alias("feedback_rows"), F.count("feedback").alias("feedback_filled")
    )
    return sent.join(stored, ["adv_campaign_id", "client_id", "datetime_created"]).select(
        "restaurant_id",
        "adv_campaign_id",
        "adv_campaign_content",
        big("adv_campaign_datetime_start"),
        big("adv_campaign_datetime_end"),
        big("datetime_created"),
        "client_id",
        big("feedback_rows"),
        big("feedback_filled"),
    )


def interrupted_targets(spark, sf) -> DataFrame:
    """Two targets of one batch. The first attempt breaks off while the second
    target is written, the next one succeeds, and the batch comes again."""
    events = r.table(spark, sf, "events").select("event_id", "event_type")
    log = CommitLog(spark, new_path(spark, "targets"))
    broken = runner.message_target(events).withColumn("value", F.when(F.length("value") > 0, F.raise_error(F.lit("target is down"))))
    seen = 0
    try:
        publish_batch(log, {"feedback": events, "messages": broken}, 0)
    except Exception:
        seen = sum(df.count() for name in ("feedback", "messages") if (df := log.read(name)) is not None)
    write = runner.committed_sink(log, {"feedback": runner.feedback_target, "messages": runner.message_target})
    for _ in range(2):
        write(events, 0)
    sent = decode_json(log.read("messages"), "event_id long, event_type string").groupBy("event_type").agg(F.count("*").alias("sent"))
    stored = log.read("feedback").groupBy("event_type").agg(F.count("*").alias("stored"))
    return stored.join(sent, "event_type").select("event_type", big("stored"), big("sent"), big(F.lit(seen), "seen_before"))


def _run_order_streams(spark, sf, slices: int = 1) -> dict:
    """Three chained streams: raw and enriched orders, vault, counters. The
    events land in ``slices`` by time, each of which is a micro-batch."""
    root = new_path(spark, "orders")
    events = r.table(spark, sf, "events")
    raw = KeyedTable(spark, f"{root}/raw", "object_id", ["sent_dttm", "payload"])
    stg, dds = CommitLog(spark, f"{root}/stg"), CommitLog(spark, f"{root}/dds")
    products = CounterTable(spark, f"{root}/products", ["id", "product_id"], "order_cnt", ["product_name"])
    categories = CounterTable(spark, f"{root}/categories", ["id", "category_name"], "order_cnt")
    keep, enrich = order_stream.raw_sink(raw), order_stream.enrich_sink(r.event_users(events), r.event_restaurants(events), stg)
    load_ts = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    load = order_stream.vault_sink(dds, load_ts, limit=2000, bits=1, most_parts=4)
    count = order_stream.counter_sink(products, categories)

    def staging(batch: DataFrame, batch_id: int) -> None:
        with scratch(numbered(batch), "micro-batch") as rows:
            keep(rows, batch_id)
            enrich(rows, batch_id)

    # What the vault got last, for a repetition.
    last = {}

    def vault(batch: DataFrame, batch_id: int) -> None:
        last.update(id=batch_id, version=stg.state()["version"])
        load(decode_json(batch, _ENRICHED), batch_id)

    for k in range(slices):
        cut = F.floor((F.dayofmonth("ts") - 1) * slices / 31) == k
        events.filter(cut).write.parquet(f"{root}/in/{k}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(f"{root}/in")
        runs = [
            lambda c: runner.start(r.event_orders(stream), staging, c, available_now=True),
            lambda c: runner.start_after(stg, "messages", vault, c, available_now=True),
            lambda c: runner.start_after(dds, "messages", lambda b, i: count(decode_json(b, _PRODUCTS), i), c, available_now=True),
        ]
        for n, run in enumerate(runs):
            run(f"{root}/checkpoint-{n}").awaitTermination()
    if slices > 1:  # the last batch comes again, and the messages of all are gathered
        again = stg.state(last["version"])["added"]["messages"]
        load(decode_json(stg.open(again, stg.state()["tables"]["messages"]["schema"]), _ENRICHED), last["id"])
        compact(dds, "messages")
        raw.compact()
    return {"raw": raw, "vault": dds, "products": products, "categories": categories}


def restarted_counters(spark, sf) -> DataFrame:
    """Event counters fed by a stream of five files, one a batch, with a
    compaction, then by a second run with a new checkpoint."""
    source = new_path(spark, "event-files")
    r.table(spark, sf, "events").select("event_id", "user_id").repartition(5, "event_id").write.parquet(source)
    table = CounterTable(spark, new_path(spark, "counters"), "user_id", "cnt")
    add = lambda batch, batch_id: table.add(batch.withColumn("cnt", F.lit(1)), batch_id)
    for run in range(2):
        stream = spark.readStream.schema("event_id bigint, user_id bigint").option("maxFilesPerTrigger", 1).parquet(source)
        _run(stream, add, spark, "counters")
        table.compact()
    return table.read().select(big("user_id"), big("cnt"))


_ENRICHED = """object_id bigint, object_type string,
    payload struct<id: bigint, date: string, cost: decimal(14,2), payment: decimal(14,2), status: string,
        restaurant: struct<id: string, name: string>, user: struct<id: string, name: string>,
        products: array<struct<id: string, price: decimal(14,2), quantity: int, name: string, category: string>>>"""
_PRODUCTS = """object_id bigint, object_type string,
    payload array<struct<id: string, product_id: string, product_name: string, category_name: string>>"""


def stream_counters(spark, sf) -> DataFrame:
    tables = _run_order_streams(spark, sf)
    by_product = tables["products"].read().select(
        F.lit("product").alias("kind"), F.col("id").alias("user_id"), F.col("product_name").alias("name"), big("order_cnt")
    )
    by_category = tables["categories"].read().select(
        F.lit("category").alias("kind"), F.col("id").alias("user_id"), F.col("category_name").alias("name"), big("order_cnt")
    )
    return by_product.unionByName(by_category)


def stream_vault(spark, sf) -> DataFrame:
    """Rows of the raw table and of the 14 vault tables after five micro-batches,
    a repetition of the last one and a compaction."""
    tables = _run_order_streams(spark, sf, slices=5)
    parents = {"l_order_product": ("h_order_pk", "h_product_pk"), "l_product_restaurant": ("h_product_pk", "h_restaurant_pk"),
               "l_product_category": ("h_product_pk", "h_category_pk"), "l_order_user": ("h_order_pk", "h_user_pk")}
    described = {"s_user_names": ["username", "userlogin"], "s_product_names": ["name"], "s_restaurant_names": ["name"],
                 "s_order_cost": ["cost", "payment"], "s_order_status": ["status"]}
    business = {"h_user": "user_id", "h_product": "product_id", "h_category": "category_name", "h_restaurant": "restaurant_id", "h_order": "order_id"}
    shown = [tables["raw"].read().select(F.lit("raw").alias("name"), text("object_id", "pk"), text("sent_dttm", "content"))]
    for name, df in order_stream.vault_tables(tables["vault"]).items():
        columns = [business[name]] if name in business else [*parents[name]] if name in parents else [*described[name], "order_dt", f"hk_{name[2:]}_hashdiff"]
        content = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
        shown.append(df.select(F.lit(name).alias("name"), F.col(order_plans.VAULT_KEYS[name]).alias("pk"), content.alias("content")))
    return r.union_all(shown)


def _in_slots(spark, sf) -> DataFrame:
    """Events in the micro-batch they arrive in, out of order: every tenth comes
    one slot late, every thirtieth four, and every seventh comes again."""
    events = r.table(spark, sf, "events").select("event_id", "ts")
    due = F.floor((F.dayofmonth("ts") - 1) / 6)
    behind = F.when(F.col("event_id") % 30 == 0, 4).when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    first = events.withColumn("slot", due + behind)
    again = first.filter("event_id % 7 = 0").withColumn("slot", F.col("slot") + 1)
    return first.unionByName(again).withColumn("slot", F.least("slot", F.lit(4)).cast("int"))


def _land(df: DataFrame, folder: str, k: int) -> None:
    df.filter(F.col("slot") == k).drop("slot").coalesce(1).write.parquet(f"{folder}/{k}")


def late_events(spark, sf) -> DataFrame:
    """Events that arrive out of order in five micro-batches: which are kept,
    once each, and which come too late, three days being allowed."""
    rows = staged(_in_slots(spark, sf), "slots")
    root = new_path(spark, "late")
    log = CommitLog(spark, f"{root}/log")
    sink = deduplicating_sink(log, ["event_id", "ts"], "ts", 3 * 86400)
    for k in range(5):
        _land(rows, f"{root}/in", k)
        stream = spark.readStream.schema("event_id long, ts timestamp_ntz").option("recursiveFileLookup", True).parquet(f"{root}/in")
        runner.start(stream, sink, f"{root}/checkpoint", available_now=True).awaitTermination()
    number = F.col("batch_id").bitwiseAND(F.lit((1 << 24) - 1)).alias("batch")
    kept, late = log.read("kept"), log.read("late")
    shown = [df.select(big("event_id"), number, F.lit(state).alias("state")) for df, state in ((kept, "kept"), (late, "late"))]
    return r.union_all(shown)


def watermark_drops(spark, sf) -> DataFrame:
    """The same arrivals through Spark's own watermark and state: events kept,
    and rows dropped as late in each micro-batch, as the listener wrote them."""
    rows = staged(_in_slots(spark, sf), "slots")
    root = new_path(spark, "drops")
    log, name = CommitLog(spark, f"{root}/log"), f"drops-{root[-8:]}"
    with ProgressTable(spark, f"{root}/progress", name) as progress:
        for k in range(5):
            _land(rows, f"{root}/in", k)
            stream = spark.readStream.schema("event_id long, ts timestamp_ntz").option("recursiveFileLookup", True).parquet(f"{root}/in")
            timed = stream.withColumn("at", F.col("ts").cast("timestamp")).drop("ts")
            once = campaigns.dedup_stream(timed, ["event_id", "at"], "at", "3 days")
            sink = runner.committed_sink(log, {"kept": lambda df: df})
            runner.start(once, sink, f"{root}/checkpoint", available_now=True, name=name).awaitTermination()
    dropped = progress.read().agg(F.sum("dropped_rows")).select(F.lit("dropped").alias("what"), big("sum(dropped_rows)", "n"))
    kept = log.read("kept").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))
    return dropped.unionByName(kept.select(F.lit("kept").alias("what"), big("n"))).unionByName(kept.select(F.lit("ids").alias("what"), big("ids", "n")))


def stream_progress(spark, sf) -> DataFrame:
    """Progress of a stream of more micro-batches than Spark remembers."""
    root = new_path(spark, "progress")
    events = r.table(spark, sf, "events").select("event_id")
    events.repartition(110, "event_id").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("event_id long").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    name = f"progress-{root[-8:]}"
    with ProgressTable(spark, f"{root}/progress", name) as progress:
        sink = lambda df, _: df.write.format("noop").mode("overwrite").save()
        runner.start(stream, sink, f"{root}/checkpoint", available_now=True, name=name).awaitTermination()
    held = progress.read()
    return held.agg(
        F.sum("input_rows").cast("bigint").alias("input_rows"),
        (F.countDistinct("batch_id") == F.count("*")).alias("each_once"),
        (F.count("*") > 100).alias("more_than_remembered"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        rfm_segments,
        rfm_recency_any,
        rfm_matrix,
        order_latest_status,
        dim_country_rates,
        dim_agreements,
        dim_transfers,
        shipping_info,
        shipping_status,
        shipping_mart,
        delay_stats,
        calendar_weeks,
        dim_insert_missing,
        sales_fact_day,
        customer_retention,
        customer_retention_distinct,
        upsert_latest,
        insert_first,
        replace_day,
        accumulate_batches,
        json_entities,
        delivery_entities,
        courier_ledger,
        vault_hubs,
        vault_links,
        vault_satellites,
        vault_history,
        group_conversion,
        nearest_city,
        user_travel,
        user_travel_strict,
        zone_stats,
        friend_recommendations,
        near_users,
        contacts,
        raw_orders,
        order_enrichment,
        product_counters,
        category_counters,
        vault_uuid5_hubs,
        vault_uuid5_links,
        vault_uuid5_satellites,
        global_metrics,
        transactions_without_rate,
        row_numbers,
        quintiles,
        quintile_rows,
        upsert_other_width,
        emptied_day,
        late_satellite,
        key_parts,
        rejected_lines,
        unkeyed_documents,
        sales_fact_one_day,
        global_metrics_one_day,
        restarted_counters,
        event_runs,
        group_statistics,
        duplicate_lines,
        oldest_orders,
        customers_without_closed_orders,
        constraint_report,
        order_keys,
        quality_report,
        stream_campaigns,
        stream_counters,
        stream_vault,
        interrupted_targets,
        late_events,
        watermark_drops,
        stream_progress,
        daily_increments,
        day_csv,
        reference_menus,
        rolling_days,
        appended_views,
        chat_staging,
        travel_chunks,
        nearest_of_many,
        split_pages,
        monthly_accounts,
        layout_join,
        previous_events,
        hot_satellite,
    ]
}
