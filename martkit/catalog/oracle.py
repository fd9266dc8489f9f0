"""The same results in plain SQL, for comparison in another engine.

Written from the rules of the marts, with windows, self joins and cross joins
where they say it best; nothing here runs on Spark.
"""

from __future__ import annotations

from martkit.plans.geo_dims import CITIES, CITY_ZONES

NS = "unhex('d4dc5ac049c649c9b5f45fdc183e9c7a')"


def uuid5(name: str) -> str:
    """Name-based UUID of a text expression."""
    h = f"sha1({NS} || encode({name}))"
    variant = f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"{variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


def txt(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def md5(c: str) -> str:
    return f"md5({txt(c)})"


def dec(c: str) -> str:
    return f"CAST({c} AS DECIMAL(14,2))"


def dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def big(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


# --- segmentation -----------------------------------------------------------

RFM = f"""
done AS (
  SELECT o_custkey, max(o_orderdate) AS last_ts, count(*) AS cnt, sum({dec('o_totalprice')}) AS spend
  FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1),
base AS (
  SELECT c_custkey AS user_id, last_ts, coalesce(cnt, 0) AS cnt, coalesce(spend, 0) AS spend
  FROM customer LEFT JOIN done ON c_custkey = o_custkey),
scores AS (
  SELECT user_id, ntile(5) OVER (ORDER BY last_ts NULLS FIRST, user_id) AS recency,
         ntile(5) OVER (ORDER BY cnt, user_id) AS frequency, ntile(5) OVER (ORDER BY spend, user_id) AS monetary_value
  FROM base)"""

LATEST_STATUS = """
SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS VARCHAR) AS order_ts, o.o_custkey AS user_id,
       CAST(CAST(o.o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS cost, s.status
FROM orders o JOIN (
  SELECT l_orderkey, l_returnflag || l_linestatus AS status,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                    l_returnflag || l_linestatus DESC) AS rn
  FROM lineitem) s ON o.o_orderkey = s.l_orderkey AND s.rn = 1"""

# --- shipping ---------------------------------------------------------------

LOG_ORDER = "state_datetime DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC"
LOG = f"""
log AS (
  SELECT l_orderkey AS shippingid, {big('c_nationkey')} AS vendorid, {dec('o_totalprice')} AS payment_amount,
         l_shipdate AS state_datetime,
         CASE WHEN l_linestatus = 'F' THEN 'finished' ELSE 'in_progress' END AS status,
         CASE l_returnflag WHEN 'A' THEN 'booked' WHEN 'R' THEN 'recieved' ELSE 'delivering' END AS state,
         o_orderdate + INTERVAL 60 DAY AS plan,
         substr(o_orderpriority, 3) AS transfer_type, o_orderstatus AS transfer_model,
         CAST(CAST(substr(o_orderpriority, 1, 1) AS INT) * 0.005 AS DECIMAL(14,3)) AS transfer_rate,
         n_name AS country,
         CAST((c_nationkey % 5 + 1) * 0.01 AS DECIMAL(14,3)) AS base_rate,
         {big('c_nationkey % 7')} AS agreementid,
         'vspn-' || (c_nationkey % 7) || '000' AS agreement_number,
         CAST('0.0' || (c_nationkey % 7) AS DECIMAL(14,3)) AS agreement_rate,
         CAST('0.1' || (c_nationkey % 7) AS DECIMAL(14,3)) AS agreement_commission,
         l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
countries AS (
  SELECT row_number() OVER (ORDER BY country, base_rate) AS shipping_country_id, country, base_rate
  FROM (SELECT DISTINCT country, base_rate FROM log)),
transfers AS (
  SELECT row_number() OVER (ORDER BY transfer_type, transfer_model, transfer_rate) AS transfer_type_id,
         transfer_type, transfer_model, transfer_rate
  FROM (SELECT DISTINCT transfer_type, transfer_model, transfer_rate FROM log)),
agreements AS (
  SELECT DISTINCT agreementid, agreement_number, agreement_rate, agreement_commission FROM log),
info AS (
  SELECT DISTINCT shippingid, plan, payment_amount, vendorid, shipping_country_id, transfer_type_id, agreementid
  FROM log LEFT JOIN countries USING (country, base_rate)
       LEFT JOIN transfers USING (transfer_type, transfer_model, transfer_rate)),
status AS (
  SELECT shippingid, first(status ORDER BY {LOG_ORDER}) AS status, first(state ORDER BY {LOG_ORDER}) AS state,
         min(CASE state WHEN 'booked' THEN state_datetime END) AS start_at,
         max(CASE state WHEN 'recieved' THEN state_datetime END) AS end_at
  FROM log GROUP BY shippingid),
late AS (SELECT *, greatest(end_at - plan, INTERVAL 0 DAY) AS delay FROM info JOIN status USING (shippingid)),
mart AS (
  SELECT shippingid, vendorid, transfer_type, datepart('day', end_at - start_at) AS full_day_at_shipping,
         (coalesce(delay, INTERVAL 0 DAY) > INTERVAL 0 DAY)::INT AS is_delay,
         (status = 'finished')::INT AS is_shipping_finish,
         datepart('day', coalesce(delay, INTERVAL 0 DAY)) AS delay_day_at_shipping,
         payment_amount, (base_rate + agreement_rate + transfer_rate) * payment_amount AS vat,
         agreement_commission * payment_amount AS profit
  FROM late JOIN transfers USING (transfer_type_id) JOIN countries USING (shipping_country_id)
       JOIN agreements USING (agreementid))"""

# --- sales star -------------------------------------------------------------

SALES = f"""
uol AS (
  SELECT o_orderkey AS id, o_orderdate AS date_time, c_nationkey AS city_id, o_custkey AS customer_id,
         c_name AS last_name, CAST(substr(o_orderpriority, 1, 1) AS INT) AS item_id,
         o_orderkey % 5 + 1 AS quantity, {dec('o_totalprice')} AS payment_amount,
         CASE o_orderstatus WHEN 'F' THEN 'shipped' WHEN 'P' THEN 'refunded' END AS status
  FROM orders JOIN customer ON o_custkey = c_custkey),
cal AS (
  SELECT row_number() OVER (ORDER BY d) AS date_id, CAST(d AS DATE) AS date_actual,
         date_part('week', d) AS week_of_year,
         CAST(date_trunc('week', d) AS DATE) AS first_day_of_week,
         CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS last_day_of_week
  FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)),
sales AS (
  SELECT date_id, item_id, customer_id, city_id, quantity,
         CASE WHEN status = 'refunded' THEN -payment_amount ELSE payment_amount END AS payment_amount,
         coalesce(status, 'shipped') AS status
  FROM uol LEFT JOIN cal ON CAST(date_time AS DATE) = date_actual)"""


def retention(new: str, returning: str) -> str:
    return f"""WITH {SALES},
weekly AS (SELECT * FROM sales JOIN cal USING (date_id)),
shipped AS (
  SELECT customer_id, first_day_of_week, count(*) AS n FROM weekly WHERE status = 'shipped' GROUP BY ALL),
rows AS (SELECT w.*, coalesce(n, 0) AS n FROM weekly w LEFT JOIN shipped USING (customer_id, first_day_of_week))
SELECT {big(f'coalesce({new}, 0)')} AS new_customers_count, {big(f'coalesce({returning}, 0)')} AS returning_customers_count,
       count(DISTINCT customer_id) FILTER (status = 'refunded') AS refunded_customer_count,
       format('Неделя с {{}} по {{}}', first_day_of_week, last_day_of_week) AS period_name,
       {big('week_of_year')} AS period_id, {big('item_id')} AS item_id,
       {dbl("coalesce(sum(payment_amount) FILTER (status = 'shipped' AND n = 1), 0)")} AS new_customers_revenue,
       {dbl("coalesce(sum(payment_amount) FILTER (status = 'shipped' AND n > 1), 0)")} AS returning_customers_revenue,
       count(*) FILTER (status = 'refunded') AS customers_refunded
FROM rows GROUP BY first_day_of_week, last_day_of_week, week_of_year, item_id"""


DIM_MISSING = f"""WITH {SALES},
ranked AS (
  SELECT customer_id, last_name, city_id, date_time < TIMESTAMP '1996-01-01' AS early,
         row_number() OVER (PARTITION BY customer_id, date_time < TIMESTAMP '1996-01-01'
                            ORDER BY date_time DESC, id DESC) AS rn,
         bool_or(date_time < TIMESTAMP '1996-01-01') OVER (PARTITION BY customer_id) AS known
  FROM uol)
SELECT customer_id, last_name, {big('city_id')} AS city_id, {big('CASE WHEN early THEN 1 ELSE 2 END')} AS load
FROM ranked WHERE rn = 1 AND (early OR NOT known)"""

# --- writes -----------------------------------------------------------------

LAST_EVENT = f"""
SELECT user_id, event_type, {txt('ts')} AS ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""
FIRST_EVENT = LAST_EVENT.replace("ts DESC, event_id DESC", "ts, event_id")

REPLACED = f"""
SELECT event_id, round(CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN value + 1 ELSE value END, 2) AS value,
       {txt('CAST(ts AS DATE)')} AS ds
FROM events"""

LATE_SATELLITE = f"""WITH
a AS (SELECT user_id, event_type, ts, 0 AS new FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events WHERE event_id % 2 = 1)
  WHERE was IS DISTINCT FROM event_type),
c AS (SELECT user_id, event_type, ts, 1 AS new FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events)
  WHERE was IS DISTINCT FROM event_type),
u AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, new) AS was FROM (SELECT * FROM a UNION ALL SELECT * FROM c))
SELECT md5(CAST(user_id AS VARCHAR)) AS hk_user, event_type, {txt('ts')} AS ts FROM u WHERE new = 0 OR was IS DISTINCT FROM event_type"""

KEY_PARTS = r"""WITH p AS (
  SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN replace(p_name, ' ', '|') END AS a,
         CASE WHEN p_partkey % 5 <> 0 THEN '\N' || p_type || '\' END AS b FROM part)
SELECT p_partkey, md5(coalesce(replace(replace(a, '\', '\\'), '|', '\|'), '\N') || '|' ||
         coalesce(replace(replace(b, '\', '\\'), '|', '\|'), '\N')) AS pair_key, md5(coalesce('\' || b, '\N')) AS single_key FROM p"""

# --- ledger -----------------------------------------------------------------

DELIVERIES = """
firsts AS (SELECT l_orderkey, min(l_suppkey) AS courier, max(l_shipdate) AS delivered FROM lineitem GROUP BY 1),
deliveries AS (
  SELECT 'o' || o_orderkey AS order_id, o_orderdate AS order_ts, 'd' || o_orderkey AS delivery_id,
         'c' || courier AS courier_id, delivered AS delivery_ts,
         least(5, 1 + courier % 5 + o_orderkey % 2) AS rate,
         CAST(o_totalprice AS DECIMAL(12,2)) AS order_sum,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 0.01 AS DECIMAL(12,2)) AS tip_sum
  FROM orders JOIN firsts ON o_orderkey = l_orderkey)"""

LEDGER = f"""{DELIVERIES},
tiers(low, high, share, minimum) AS (
  VALUES (0.0, 4.0, 0.05, 100.0), (4.0, 4.5, 0.07, 150.0), (4.5, 4.9, 0.08, 175.0), (4.9, 99.0, 0.10, 200.0)),
rated AS (
  SELECT courier_id, year(order_ts) AS y, month(order_ts) AS m, avg(rate) AS rate_avg FROM deliveries GROUP BY ALL),
paid AS (
  SELECT d.*, y, m, rate_avg, greatest(order_sum * share, minimum) AS pay
  FROM deliveries d JOIN rated r ON d.courier_id = r.courier_id AND year(order_ts) = y AND month(order_ts) = m
       JOIN tiers ON rate_avg >= low::DOUBLE AND rate_avg < high::DOUBLE),
ledger AS (
  SELECT courier_id, s_name AS courier_name, y AS settlement_year, m AS settlement_month, count(*) AS orders_count,
         {dec('sum(order_sum)')} AS orders_total_sum, round(any_value(rate_avg), 5) AS rate_avg,
         {dec('sum(order_sum) * 0.25')} AS order_processing_fee, {dec('sum(pay)')} AS courier_order_sum,
         {dec('sum(tip_sum)')} AS courier_tips_sum, {dec('sum(pay) + sum(tip_sum) * 0.95')} AS courier_reward_sum
  FROM paid JOIN supplier ON courier_id = 'c' || s_suppkey GROUP BY courier_id, s_name, y, m)"""

# --- community vault --------------------------------------------------------

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
START = "TIMESTAMP '1995-01-01 00:00:00'"
FIRST, SECOND = "'2024-01-16 00:00:00'", "'2024-02-01 00:00:00'"


def loaded(early: str) -> str:
    """Load time as text: of the first load for rows it had seen."""
    return f"CASE WHEN {early} THEN {FIRST} ELSE {SECOND} END"


COMMUNITY = f"""
users AS (
  SELECT c_custkey AS id, c_name AS chat_name, {START} + to_days(CAST(c_custkey % 365 AS INT)) AS registration_dt,
         c_mktsegment AS country, c_custkey % 60 + 18 AS age,
         {START} + to_days(CAST(c_custkey % 365 AS INT)) < TIMESTAMP '1995-07-01' AS early
  FROM customer),
grps AS (
  SELECT {big('n_nationkey')} AS id, {big('n_nationkey * 3')} AS admin_id, n_name AS group_name,
         {START} + to_days(CAST(n_nationkey * 37 % 100 AS INT)) AS registration_dt,
         n_regionkey % 2 = 1 AS is_private,
         {START} + to_days(CAST(n_nationkey * 37 % 100 AS INT)) < TIMESTAMP '1995-02-20' AS early
  FROM nation),
dialogs AS (
  SELECT o_orderkey AS message_id, o_orderdate AS message_ts, o_custkey AS message_from,
         o_custkey + 1 AS message_to, o_orderpriority AS message,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 27 END AS message_group,
         o_orderdate < TIMESTAMP '1998-01-01' AS early
  FROM orders),
glog AS (
  SELECT {K} % 25 AS group_id, user_id, user_id + 1 AS user_id_from,
         CASE event_type WHEN 'signup' THEN 'add' WHEN 'view' THEN 'join' WHEN 'click' THEN 'create'
                         WHEN 'purchase' THEN 'leave' ELSE 'kick' END AS event,
         ts AS event_dt, ts < TIMESTAMP '2024-01-16' AS early
  FROM events),
admins AS (
  SELECT g.id AS group_id, u.id AS user_id, g.registration_dt, g.early AND u.early AS early
  FROM grps g JOIN users u ON g.admin_id = u.id),
in_groups AS (
  SELECT d.message_id, g.id AS group_id, d.message_from, d.early AND g.early AS early
  FROM dialogs d JOIN grps g ON d.message_group = g.id),
sent AS (
  SELECT d.message_id, u.id AS user_id, d.early AND u.early AS early FROM dialogs d JOIN users u ON d.message_from = u.id),
activity AS (
  SELECT l.group_id, l.user_id, bool_or(l.early AND u.early AND g.early) AS early
  FROM glog l JOIN users u ON l.user_id = u.id JOIN grps g ON l.group_id = g.id GROUP BY 1, 2)"""

HUBS = " UNION ALL ".join(
    f"SELECT '{hub}' AS hub, {md5(key)} AS hk, {big(key)} AS business_key, {txt(at)} AS at, "
    f"{loaded('early')} AS load_dt, 's3' AS load_src FROM {source}"
    for hub, source, key, at in [
        ("h_users", "users", "id", "registration_dt"),
        ("h_dialogs", "dialogs", "message_id", "message_ts"),
        ("h_groups", "grps", "id", "registration_dt"),
    ]
)

LINKS = " UNION ALL ".join(
    f"SELECT '{link}' AS link, md5({md5(a)} || '|' || {md5(b)}) AS hk, {md5(a)} AS hk_first, {md5(b)} AS hk_second, "
    f"{loaded('early')} AS load_dt, 's3' AS load_src FROM {source}"
    for link, source, a, b in [
        ("l_admins", "admins", "group_id", "user_id"),
        ("l_groups_dialogs", "in_groups", "group_id", "message_id"),
        ("l_user_message", "sent", "user_id", "message_id"),
        ("l_user_group_activity", "activity", "group_id", "user_id"),
    ]
)

SATELLITES = " UNION ALL ".join(
    f"SELECT '{sat}' AS satellite, {hk} AS hk, concat_ws('|', {', '.join(txt(a) for a in attrs)}) AS attributes, "
    f"{loaded('early')} AS load_dt, 's3' AS load_src FROM {source}"
    for sat, source, hk, attrs in [
        ("s_admins", "admins", f"md5({md5('group_id')} || '|' || {md5('user_id')})", ["true", "registration_dt"]),
        ("s_group_name", "grps", md5("id"), ["group_name"]),
        ("s_group_private_status", "grps", md5("id"), ["is_private"]),
        ("s_dialog_info", "dialogs", md5("message_id"), ["message", "message_from", "message_to"]),
        ("s_user_socdem", "users", md5("id"), ["country", "age"]),
        ("s_user_chatinfo", "users", md5("id"), ["chat_name"]),
    ]
)

HISTORY = f"""
SELECT md5({md5('l.group_id')} || '|' || {md5('l.user_id')}) AS hk, min(l.user_id_from) AS user_id_from, l.event,
       {txt('l.event_dt')} AS event_dt, {loaded('bool_or(l.early AND a.early)')} AS load_dt, 's3' AS load_src
FROM glog l JOIN activity a ON l.group_id = a.group_id AND l.user_id = a.user_id
GROUP BY l.group_id, l.user_id, l.event, l.event_dt"""

CONVERSION = f"""WITH {COMMUNITY},
added AS (
  SELECT g.id, g.registration_dt, count(DISTINCT l.user_id) AS cnt_added_users
  FROM glog l JOIN users u ON l.user_id = u.id JOIN grps g ON l.group_id = g.id
  WHERE event = 'add' GROUP BY 1, 2 ORDER BY g.registration_dt, {md5('g.id')} LIMIT 10),
writers AS (
  SELECT i.group_id, count(DISTINCT i.message_from) AS n
  FROM in_groups i JOIN users u ON i.message_from = u.id GROUP BY 1)
SELECT {md5('id')} AS hk_group_id, cnt_added_users, n AS cnt_users_in_group_with_messages,
       round(CAST(n AS DOUBLE) / nullif(cnt_added_users, 0), 2) AS group_conversion
FROM added LEFT JOIN writers ON id = group_id"""

# --- geo --------------------------------------------------------------------

CITY_ROWS = ", ".join(f"({i}, '{n}', {la}::DOUBLE, {lo}::DOUBLE)" for i, n, la, lo in CITIES)
ZONE_ROWS = ", ".join(f"('{n}', '{z}')" for n, z in CITY_ZONES.items())


def haversine(la1: str, lo1: str, la2: str, lo2: str) -> str:
    return (
        f"(12742 * asin(least(1.0::DOUBLE, sqrt(pow(sin((radians({la2}) - radians({la1})) / 2), 2) + cos(radians({la1})) "
        f"* cos(radians({la2})) * pow(sin((radians({lo2}) - radians({lo1})) / 2), 2)))))"
    )


GEO = f"""
cities(id, city, lat, lon) AS (VALUES {CITY_ROWS}),
zones(city, zone) AS (VALUES {ZONE_ROWS}),
geo AS (
  SELECT event_id, user_id, ts, {K} AS k,
         CASE WHEN event_type IN ('view', 'purchase') THEN 'message'
              WHEN event_type IN ('click', 'error') THEN 'reaction' ELSE 'subscription' END AS kind,
         lat + (user_id % 5 - 2) * 0.004::DOUBLE AS lat, lon + (user_id % 7 - 3) * 0.004::DOUBLE AS lon
  FROM events JOIN cities ON cities.id =
    CASE WHEN user_id % 3 = 0 THEN user_id % 24 + 1 ELSE (user_id + date_part('week', ts)) % 24 + 1 END),
placed AS (
  SELECT event_id, user_id, ts, lat, lon, city, km FROM (
    SELECT g.*, c.city, {haversine('g.lat', 'g.lon', 'c.lat', 'c.lon')} AS km,
           row_number() OVER (PARTITION BY event_id
             ORDER BY {haversine('g.lat', 'g.lon', 'c.lat', 'c.lon')}, c.id) AS rn
    FROM geo g CROSS JOIN cities c WHERE kind = 'message') WHERE rn = 1)"""


STAYS = f"""{GEO},
marked AS (
  SELECT *, CASE WHEN city <> lag(city) OVER w THEN 1 ELSE 0 END AS moved FROM placed
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, sum(moved) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM marked),
stays AS (
  SELECT user_id, island, city, min(ts) AS first_at, max(ts) AS last_at,
         date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) >= 27 AS long
  FROM numbered GROUP BY 1, 2, 3)"""

TRAVEL_CHUNKS = f"""WITH {STAYS} SELECT user_id, {big('island // 5')} AS chunk, count(*) AS n, string_agg(city, '>' ORDER BY island) AS cities
FROM stays GROUP BY user_id, island // 5"""

MANY_CENTERS = f"""WITH c AS (SELECT c_custkey AS id, (c_custkey * 3571 + 7) % 7000 / 100.0 - 10 AS lat, (c_custkey * 9241 + 5) % 12000 / 100.0 - 20 AS lon FROM customer),
p AS (SELECT DISTINCT o_orderkey // 3 AS k, (o_orderkey // 3 * 6151 + 3) % 17000 / 100.0 - 85 AS lat, (o_orderkey // 3 * 15485 + 11) % 36000 / 100.0 - 180 AS lon FROM orders),
d AS (SELECT p.k, c.id, {haversine('p.lat', 'p.lon', 'c.lat', 'c.lon')} AS km FROM p CROSS JOIN c),
best AS (SELECT k, min(km) AS km, arg_min(id, (km, id)) AS id FROM d GROUP BY k)
SELECT o_orderkey AS order_id, id AS city_id, round(km, 3) AS distance_km FROM orders JOIN best ON k = o_orderkey // 3"""


def travel(home: str) -> str:
    return f"""WITH {STAYS},
people AS (
  SELECT user_id, max(island) AS travel_count, arg_max(city, island) AS act_city, arg_max(long, island) AS now_long,
         arg_max(city, island) FILTER (WHERE long) AS last_home, max(last_at) AS utc,
         string_agg(city, '>' ORDER BY island) AS travel_array
  FROM stays GROUP BY 1)
SELECT user_id, act_city, {home} AS home_city, {big('travel_count')} AS travel_count, travel_array,
       {txt("timezone(zone, timezone('UTC', utc))")} AS local_time
FROM people LEFT JOIN zones ON act_city = city"""


def _zone_part(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT DISTINCT month, week, zone_id, count(*) OVER (PARTITION BY week, zone_id) AS week_{name},
         count(*) OVER (PARTITION BY month, zone_id) AS month_{name}
  FROM ({source}))"""


MONTH_WEEK = "date_trunc('month', ts) AS month, date_trunc('week', ts) AS week"
CURRENT_CITY = """SELECT user_id, city AS zone_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM placed) WHERE rn = 1"""

ZONES = f"""WITH {GEO},
{_zone_part('message', f'SELECT {MONTH_WEEK}, city AS zone_id FROM placed')},
{_zone_part('user', f'SELECT {MONTH_WEEK}, city AS zone_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM placed) WHERE rn = 1').replace('user AS (', '"user" AS (', 1)},
{_zone_part('reaction', f"SELECT {MONTH_WEEK}, zone_id FROM geo JOIN ({CURRENT_CITY}) USING (user_id) WHERE kind = 'reaction'")},
{_zone_part('subscription', f"SELECT {MONTH_WEEK}, zone_id FROM geo JOIN ({CURRENT_CITY}) USING (user_id) WHERE kind = 'subscription'")}
SELECT {txt('CAST(month AS DATE)')} AS month, {txt('CAST(week AS DATE)')} AS week, zone_id, week_message, month_message,
       week_user, month_user, week_reaction, month_reaction, week_subscription, month_subscription
FROM message FULL JOIN "user" USING (month, week, zone_id) FULL JOIN reaction USING (month, week, zone_id)
     FULL JOIN subscription USING (month, week, zone_id)"""

POSITIONS = """
positions AS (
  SELECT user_id, ts, lat, lon, city FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM placed) WHERE rn = 1)"""
WROTE = """
wrote AS (
  SELECT DISTINCT greatest(user_id, event_id * 7 % 151) AS user_left, least(user_id, event_id * 7 % 151) AS user_right
  FROM geo WHERE kind = 'message')"""
NEAR = f"round({haversine('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 2)"

FRIENDS = f"""WITH {GEO}, {POSITIONS}, {WROTE},
subs AS (SELECT DISTINCT k, user_id FROM geo WHERE kind = 'subscription'),
pairs AS (
  SELECT DISTINCT x.user_id AS user_left, y.user_id AS user_right
  FROM subs x JOIN subs y ON x.k = y.k AND x.user_id > y.user_id)
SELECT user_left, user_right, a.city AS zone_id, {txt("timezone(zone, timezone('UTC', b.ts))")} AS local_time,
       '2024-02-01' AS processed_dttm
FROM pairs ANTI JOIN wrote USING (user_left, user_right)
JOIN positions a ON user_left = a.user_id JOIN positions b ON user_right = b.user_id
LEFT JOIN zones z ON a.city = z.city
WHERE {NEAR} <= 1"""

# --- order messages ---------------------------------------------------------

RESTAURANT = "p_brand || '-' || CAST(floor(p_partkey / 1000) AS BIGINT)"
ORDER_LINES = f"""
lines AS (
  SELECT l_orderkey || '/' || {RESTAURANT} AS object_id, {RESTAURANT} AS restaurant_id, o_orderdate AS order_dt,
         o_custkey, c_name, CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'CANCELLED' ELSE 'OPEN' END AS status,
         {txt('l_partkey')} AS product_id, {dec('l_extendedprice')} AS price, CAST(l_quantity AS INT) AS quantity,
         p_name, p_type, l_linenumber, l_suppkey, l_shipdate
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey),
heads AS (
  SELECT object_id, restaurant_id, order_dt, o_custkey, c_name, status, {dec('sum(price)')} AS cost
  FROM lines GROUP BY ALL)"""

ENRICHED = f"""WITH {ORDER_LINES}
SELECT object_id, {txt('h.order_dt')} AS date, {dbl('cost')} AS cost, h.status, h.restaurant_id,
       'Restaurant ' || h.restaurant_id AS restaurant_name, {txt('h.o_custkey')} AS user_id, h.c_name AS user_name,
       row_number() OVER (PARTITION BY object_id
         ORDER BY product_id, price, quantity, l_linenumber, l_suppkey, l_shipdate) - 1 AS line,
       product_id, {dbl('price')} AS price, {big('quantity')} AS quantity, p_name AS product_name, p_type AS category
FROM heads h JOIN lines USING (object_id)"""

FIRST_ORDERS, ALL_ORDERS = "'1998-01-01 00:00:00'", "'2002-01-01 00:00:00'"
VAULT_LOAD = f"CASE WHEN min(order_dt) < TIMESTAMP '1998-01-01' THEN {FIRST_ORDERS} ELSE {ALL_ORDERS} END"
_PARTS = {
    "user": txt("o_custkey"),
    "product": "product_id",
    "category": "p_type",
    "restaurant": "restaurant_id",
    "order": "object_id",
}

ORDER_HUBS = f"WITH {ORDER_LINES} " + " UNION ALL ".join(
    f"SELECT 'h_{name}' AS hub, {uuid5(key)} AS pk, {key} AS business_key, {VAULT_LOAD} AS load_dt, "
    f"'stg-service-orders' AS load_src FROM lines GROUP BY {key}"
    for name, key in _PARTS.items()
)

ORDER_LINKS = f"WITH {ORDER_LINES} " + " UNION ALL ".join(
    f"SELECT '{link}' AS link, {uuid5(' || chr(124) || '.join(_PARTS[p] for p in name))} AS pk, "
    f"{uuid5(_PARTS[a])} AS first_pk, {uuid5(_PARTS[b])} AS second_pk, {VAULT_LOAD} AS load_dt "
    f"FROM lines GROUP BY {_PARTS[a]}, {_PARTS[b]}"
    for link, a, b, name in [
        ("l_order_product", "order", "product", ("order", "product")),
        ("l_product_restaurant", "product", "restaurant", ("restaurant", "product")),
        ("l_product_category", "product", "category", ("product", "category")),
        ("l_order_user", "order", "user", ("order", "user")),
    ]
)

# Attributes never change in the sample, so each key has one row: its first.
ORDER_SATELLITES = f"WITH {ORDER_LINES} " + " UNION ALL ".join(
    f"SELECT '{sat}' AS satellite, {uuid5(_PARTS[part])} AS pk, {attrs} AS attributes, {txt('min(order_dt)')} AS order_dt, "
    f"{uuid5(uuid5(_PARTS[part]) + ' || chr(124) || ' + attrs)} AS hash_diff, {VAULT_LOAD} AS load_dt "
    f"FROM {source} GROUP BY {_PARTS[part]}, {attrs}"
    for sat, source, part, attrs in [
        ("s_user_names", "heads", "user", "(c_name || '|' || c_name)"),
        ("s_product_names", "lines", "product", "p_name"),
        ("s_restaurant_names", "heads", "restaurant", "('Restaurant ' || restaurant_id)"),
        ("s_order_cost", "heads", "order", f"({txt('cost')} || '|' || {txt('cost')})"),
        ("s_order_status", "heads", "order", "status"),
    ]
)


def counter(key: str, name: str, out: str) -> str:
    return f"""
SELECT {uuid5(txt('o_custkey'))} AS user_id, {uuid5(key)} AS {out}_id, {name} AS {out}_name, count(*) AS order_cnt
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey, {key}, {name}"""


# --- transactions -----------------------------------------------------------

FX = """
trans AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS operation_id, o_custkey - 5 AS account,
         CAST(substr(o_orderpriority, 1, 1) AS INT) * 10 + 400 AS currency,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount, o_orderdate AS dt
  FROM orders WHERE o_orderstatus <> 'P' AND o_custkey - 5 >= 0),
traded AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(substr(o_orderpriority, 1, 1) AS INT) AS digit,
         date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS n
  FROM orders),
cur AS (
  SELECT day, digit * 10 + 400 AS currency, CAST((500 + n % 50 * 10 + digit) / 1000.0 + 0.05 AS DECIMAL(5,3)) AS rate
  FROM traded WHERE (n + digit) % 7 <> 0)"""

METRICS = f"""WITH {FX}
SELECT {txt('day')} AS date_update, {big('currency')} AS currency_from,
       {dbl('CAST(sum(amount * rate) AS DECIMAL(18,2))')} AS amount_total, count(operation_id) AS cnt_transactions,
       round(CAST(count(operation_id) AS DOUBLE) / count(DISTINCT account), 2) AS avg_transactions_per_account,
       count(DISTINCT account) AS cnt_accounts_make_transactions
FROM trans JOIN cur USING (currency) WHERE CAST(dt AS DATE) = day GROUP BY day, currency"""

# --- quality ----------------------------------------------------------------


def _zero(name: str, query: str) -> str:
    return f"SELECT '{name}' AS check_name, ({query}) AS measured_value"


def _nulls(table: str, *cols: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE " + " OR ".join(f"{c} IS NULL" for c in cols)


def _negative(table: str, *cols: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE " + " OR ".join(f"{c} < 0" for c in cols)


_SUMS = ["orders_total_sum", "rate_avg", "order_processing_fee", "courier_order_sum", "courier_tips_sum", "courier_reward_sum"]
_CHECKS = [
    _zero("rfm: no nulls", _nulls("scores", "recency", "frequency", "monetary_value")),
    _zero(
        "rfm: scores in 1..5",
        "SELECT count(*) FROM scores WHERE least(recency, frequency, monetary_value) < 1 "
        "OR greatest(recency, frequency, monetary_value) > 5",
    ),
    _zero("rfm: one row per user", "SELECT abs((SELECT count(*) FROM scores) - (SELECT count(*) FROM customer))"),
    _zero("shipping: no nulls", _nulls("mart", "shippingid", "vendorid", "payment_amount", "vat", "profit")),
    _zero(
        "shipping: no negatives",
        _negative("mart", "full_day_at_shipping", "delay_day_at_shipping", "payment_amount", "vat", "profit"),
    ),
    _zero(
        "shipping: vat and profit",
        "SELECT count(*) FROM mart m JOIN info i USING (shippingid) JOIN countries USING (shipping_country_id) "
        "JOIN transfers USING (transfer_type_id) JOIN agreements a ON i.agreementid = a.agreementid "
        "WHERE abs(vat - m.payment_amount * (base_rate + agreement_rate + transfer_rate)) > 0.01 "
        "OR abs(profit - m.payment_amount * agreement_commission) > 0.01",
    ),
    _zero(
        "shipping: all shipments",
        "SELECT abs((SELECT count(DISTINCT shippingid) FROM mart) - (SELECT count(DISTINCT shippingid) FROM log))",
    ),
    _zero(
        "ledger: no nulls",
        _nulls("ledger", "courier_id", "courier_name", "settlement_year", "settlement_month", "orders_count", *_SUMS),
    ),
    _zero("ledger: no negatives", _negative("ledger", "orders_count", *_SUMS)),
    _zero(
        "ledger: reward formula",
        "SELECT count(*) FROM ledger WHERE abs(courier_reward_sum - (courier_order_sum + courier_tips_sum * 0.95)) > 0.01",
    ),
    _zero(
        "ledger: one row per courier and month",
        "SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM ledger "
        "GROUP BY courier_id, settlement_year, settlement_month HAVING count(*) > 1)",
    ),
    _zero("deliveries: rating in 1..5", "SELECT count(*) FROM deliveries WHERE rate < 1 OR rate > 5"),
    _zero("staging: users loaded", "SELECT count(*) FROM users"),
    _zero("hub users: keys", _nulls("users", "id")),
    _zero("hub dialogs: keys", _nulls("dialogs", "message_id")),
    _zero(
        "link admins: parents exist",
        "SELECT count(*) FROM admins WHERE user_id NOT IN (SELECT id FROM users) OR group_id NOT IN (SELECT id FROM grps)",
    ),
    _zero("satellite socdem: as long as hub", "SELECT count(*) - count(id) FROM users"),
]

QUALITY = f"""WITH {RFM}, {LOG}, {LEDGER}, {COMMUNITY},
report AS ({' UNION ALL '.join(_CHECKS)})
SELECT check_name, {big('measured_value')} AS measured_value,
       CASE WHEN (measured_value = 0) <> (check_name = 'staging: users loaded') THEN 'PASSED' ELSE 'FAILED' END AS status
FROM report"""

# --- streams ----------------------------------------------------------------

CAMPAIGNS = f"""WITH camp AS (
  SELECT DISTINCT 'rest_' || user_id AS restaurant_id, user_id || '-' || event_type AS adv_campaign_id,
         event_type AS adv_campaign_content, epoch_us(date_trunc('hour', ts)) // 1000000 AS h, user_id % 10 + 1 AS n
  FROM events),
live AS (
  SELECT * FROM camp WHERE h < epoch_us(TIMESTAMP '2024-01-15') // 1000000
    AND h + n * 86400 > epoch_us(TIMESTAMP '2024-01-15') // 1000000)
SELECT restaurant_id, adv_campaign_id, adv_campaign_content, {big('h')} AS adv_campaign_datetime_start,
       {big('h + n * 86400')} AS adv_campaign_datetime_end, {big('h')} AS datetime_created, c_name AS client_id,
       {big('1')} AS feedback_rows, {big('0')} AS feedback_filled
FROM live JOIN customer ON restaurant_id = 'rest_' || CAST(floor(c_custkey / 10) AS BIGINT)"""

EVENT_LINES = f"""
ev AS (SELECT event_type, user_id, {K} AS k FROM events),
ol AS (SELECT event_type, user_id, k FROM ev UNION ALL SELECT event_type, user_id, (k + 50) % 100 FROM ev)"""

STREAM_COUNTERS = f"""WITH {EVENT_LINES}
SELECT 'product' AS kind, {txt('user_id')} AS user_id, 'Item ' || k AS name, count(*) AS order_cnt FROM ol GROUP BY user_id, k
UNION ALL
SELECT 'category', {txt('user_id')}, 'Category ' || (k % 10), count(*) FROM ol GROUP BY user_id, k % 10"""

_EVENT_KEYS = {
    "user": txt("user_id"),
    "product": txt("k"),
    "category": "('Category ' || (k % 10))",
    "restaurant": "event_type",
    "order": txt("event_id"),
}
_EVENT_LINKS = {
    "order_product": ("order", "product", ("order", "product")),
    "product_restaurant": ("product", "restaurant", ("restaurant", "product")),
    "product_category": ("product", "category", ("product", "category")),
    "order_user": ("order", "user", ("order", "user")),
}
_EVENT_SATELLITES = {
    "user_names": ("user", "('User ' || user_id || '|User ' || user_id)"),
    "product_names": ("product", "('Item ' || k)"),
    "restaurant_names": ("restaurant", "('Restaurant ' || event_type)"),
    "order_cost": ("order", f"({txt(dec('value'))} || '|' || {txt(dec('value'))})"),
    "order_status": ("order", "'CLOSED'"),
}
# Attributes never change, and slices come in the order of time: a key has its first row.
STREAM_VAULT = f"""WITH e AS (SELECT event_id, ts, event_type, user_id, value, {K} AS k FROM events),
l AS (SELECT * FROM e UNION ALL SELECT event_id, ts, event_type, user_id, value, (k + 50) % 100 FROM e)
SELECT 'raw' AS name, {txt('event_id')} AS pk, {txt('ts')} AS content FROM events
""" + "".join(
    [f"UNION ALL SELECT 'h_{n}', {uuid5(key)}, {key} FROM l GROUP BY {key}\n" for n, key in _EVENT_KEYS.items()]
    + [
        f"UNION ALL SELECT 'l_{n}', {uuid5(' || chr(124) || '.join(_EVENT_KEYS[p] for p in parts))}, "
        f"{uuid5(_EVENT_KEYS[a])} || '|' || {uuid5(_EVENT_KEYS[b])} FROM l GROUP BY {_EVENT_KEYS[a]}, {_EVENT_KEYS[b]}\n"
        for n, (a, b, parts) in _EVENT_LINKS.items()
    ]
    + [
        f"UNION ALL SELECT 's_{n}', {uuid5(_EVENT_KEYS[k])}, {attrs} || '|' || {txt('min(ts)')} || '|' || "
        f"{uuid5(uuid5(_EVENT_KEYS[k]) + ' || chr(124) || ' + attrs)} FROM l GROUP BY {_EVENT_KEYS[k]}, {attrs}\n"
        for n, (k, attrs) in _EVENT_SATELLITES.items()
    ]
)

ARRIVED = """WITH f AS (
  SELECT event_id, ts, (day(ts) - 1) // 6 + CASE WHEN event_id % 30 = 0 THEN 4 WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS slot FROM events),
a AS (SELECT event_id, ts, least(slot, 4) AS slot FROM (SELECT * FROM f UNION ALL SELECT event_id, ts, slot + 1 FROM f WHERE event_id % 7 = 0)),
w AS (SELECT slot, (SELECT max(ts) FROM a b WHERE b.slot < s.slot) - INTERVAL 3 DAY AS mark FROM (SELECT DISTINCT slot FROM a) s)"""

LATE_EVENTS = f"""{ARRIVED},
t AS (SELECT event_id, ts, slot, coalesce(ts < mark, false) AS late FROM a JOIN w USING (slot))
SELECT event_id, {big('slot')} AS batch, 'late' AS state FROM t WHERE late
UNION ALL SELECT event_id, {big('min(slot)')}, 'kept' FROM t WHERE NOT late GROUP BY event_id, ts"""

# Spark drops a row at its watermark as well, and keeps that in milliseconds.
WATERMARK_DROPS = f"""{ARRIVED},
t AS (SELECT event_id, coalesce(ts <= date_trunc('milliseconds', mark), false) AS late FROM a JOIN w USING (slot))
SELECT 'dropped' AS what, count(*) AS n FROM t WHERE late
UNION ALL SELECT 'kept', count(DISTINCT event_id) FROM t WHERE NOT late
UNION ALL SELECT 'ids', count(DISTINCT event_id) FROM t WHERE NOT late"""

CHAT_STAGING = f"""WITH {COMMUNITY},
g AS (SELECT *, admin_id IN (SELECT id FROM users) AS ok FROM grps),
d AS (SELECT *, concat_ws(',',
    CASE WHEN message_from NOT IN (SELECT id FROM users) THEN 'references:message_from' END,
    CASE WHEN message_to NOT IN (SELECT id FROM users) THEN 'references:message_to' END,
    CASE WHEN message_group IS NOT NULL AND message_group NOT IN (SELECT id FROM g WHERE ok) THEN 'references:message_group' END) AS why FROM dialogs),
l AS (SELECT concat_ws(',',
    CASE WHEN group_id NOT IN (SELECT id FROM g WHERE ok) THEN 'references:group_id' END,
    CASE WHEN user_id NOT IN (SELECT id FROM users) THEN 'references:user_id' END) AS why FROM glog)
SELECT 'users' AS name, 'kept' AS state, count(*) AS n FROM users
UNION ALL SELECT 'groups', CASE WHEN ok THEN 'kept' ELSE 'references:admin_id' END, count(*) FROM g GROUP BY ok
UNION ALL SELECT 'dialogs', CASE WHEN why = '' THEN 'kept' ELSE why END, count(*) FROM d GROUP BY why
UNION ALL SELECT 'group_log', CASE WHEN why = '' THEN 'kept' ELSE why END, count(*) FROM l GROUP BY why"""

HOT_EVENTS = "hot AS (SELECT event_id, ts, event_type, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id FROM events)"
HOT_SATELLITE = LATE_SATELLITE.replace("FROM events", "FROM hot").replace("WITH\n", f"WITH {HOT_EVENTS},\n")

ORACLE_SQL: dict[str, str] = {
    "rfm_segments": f"WITH {RFM} SELECT user_id, recency, frequency, monetary_value FROM scores",
    "rfm_recency_any": f"""WITH base AS (
  SELECT c.c_custkey AS user_id, max(CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderdate END) AS last_ts,
         count(CASE WHEN o.o_orderstatus = 'F' THEN 1 END) AS cnt,
         sum(CASE WHEN o.o_orderstatus = 'F' THEN {dec('o.o_totalprice')} END) AS spend
  FROM customer c LEFT JOIN orders o
    ON c.c_custkey = o.o_custkey AND o.o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
  GROUP BY c.c_custkey)
SELECT user_id, ntile(5) OVER (ORDER BY last_ts ASC NULLS FIRST, user_id) AS recency,
       ntile(5) OVER (ORDER BY cnt, user_id) AS frequency,
       ntile(5) OVER (ORDER BY spend ASC NULLS LAST, user_id) AS monetary_value FROM base""",
    "rfm_matrix": f"WITH {RFM} SELECT recency, "
    + ", ".join(f"count(*) FILTER (WHERE frequency = {i}) AS f{i}" for i in range(1, 6))
    + " FROM scores GROUP BY recency",
    "order_latest_status": LATEST_STATUS,
    "dim_country_rates": f"WITH {LOG} SELECT shipping_country_id, country AS shipping_country, "
    f"{dbl('base_rate')} AS shipping_country_base_rate FROM countries",
    "dim_agreements": f"WITH {LOG} SELECT agreementid, agreement_number, {dbl('agreement_rate')} AS agreement_rate, "
    f"{dbl('agreement_commission')} AS agreement_commission FROM agreements",
    "dim_transfers": f"WITH {LOG} SELECT transfer_type_id, transfer_type, transfer_model, "
    f"{dbl('transfer_rate')} AS shipping_transfer_rate FROM transfers",
    "shipping_info": f"WITH {LOG} SELECT shippingid, {txt('plan')} AS shipping_plan_datetime, "
    f"{dbl('payment_amount')} AS payment_amount, vendorid, shipping_country_id, transfer_type_id, agreementid FROM info",
    "shipping_status": f"WITH {LOG} SELECT shippingid, status, state, {txt('start_at')} AS shipping_start_fact_datetime, "
    f"{txt('end_at')} AS shipping_end_fact_datetime FROM status",
    "shipping_mart": f"""WITH {LOG} SELECT shippingid, vendorid, transfer_type,
       {big('full_day_at_shipping')} AS full_day_at_shipping, {big('is_delay')} AS is_delay,
       {big('is_shipping_finish')} AS is_shipping_finish, {big('delay_day_at_shipping')} AS delay_day_at_shipping,
       {dbl('payment_amount')} AS payment_amount, {dbl('vat')} AS vat, {dbl('profit')} AS profit FROM mart""",
    "delay_stats": f"""WITH {LOG} SELECT {big('is_shipping_finish')} AS is_shipping_finish, {big('is_delay')} AS is_delay,
       count(*) AS shipment_count,
       round(CAST(sum(payment_amount) AS DOUBLE) / count(*), 2) AS avg_payment,
       round(CAST(sum(delay_day_at_shipping) AS DOUBLE) / count(*), 2) AS avg_delay_days FROM mart GROUP BY 1, 2""",
    "calendar_weeks": f"WITH {SALES} SELECT date_id, {txt('date_actual')} AS date_actual, week_of_year, "
    f"{txt('first_day_of_week')} AS first_day_of_week, {txt('last_day_of_week')} AS last_day_of_week FROM cal",
    "dim_insert_missing": DIM_MISSING,
    "sales_fact_day": f"WITH {SALES} SELECT date_id, {big('item_id')} AS item_id, customer_id, {big('city_id')} AS city_id, "
    f"{big('quantity')} AS quantity, {dbl('payment_amount')} AS payment_amount, status FROM sales",
    "customer_retention": retention("count(*) FILTER (n = 1)", "count(*) FILTER (n > 1)"),
    "customer_retention_distinct": retention(
        "count(DISTINCT customer_id) FILTER (n = 1)", "count(DISTINCT customer_id) FILTER (n > 1)"
    ),
    "upsert_latest": LAST_EVENT,
    "insert_first": FIRST_EVENT,
    "replace_day": REPLACED,
    "accumulate_batches": "SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY 1, 2",
    "json_entities": f"SELECT event_id, event_type, {K} AS k FROM events",
    "delivery_entities": f"WITH {DELIVERIES} SELECT order_id, {txt('order_ts')} AS order_ts, delivery_id, courier_id, "
    f"{txt('delivery_ts')} AS delivery_ts, {big('rate')} AS rate, {dbl('order_sum')} AS order_sum, "
    f"{dbl('tip_sum')} AS tip_sum FROM deliveries",
    "courier_ledger": f"WITH {LEDGER} SELECT courier_id, courier_name, settlement_year, settlement_month, orders_count, "
    + ", ".join(f"{dbl(c)} AS {c}" for c in _SUMS)
    + " FROM ledger",
    "vault_hubs": f"WITH {COMMUNITY} {HUBS}",
    "vault_links": f"WITH {COMMUNITY} {LINKS}",
    "vault_satellites": f"WITH {COMMUNITY} {SATELLITES}",
    "vault_history": f"WITH {COMMUNITY} {HISTORY}",
    "group_conversion": CONVERSION,
    "nearest_city": f"WITH {GEO} SELECT event_id AS message_id, user_id, city, round(km, 3) AS distance_km FROM placed",
    "user_travel": travel("last_home"),
    "user_travel_strict": travel("CASE WHEN now_long THEN act_city END"),
    "zone_stats": ZONES,
    "friend_recommendations": FRIENDS,
    "near_users": f"WITH {GEO}, {POSITIONS} SELECT a.user_id AS user_left, b.user_id AS user_right, {NEAR} AS distance_km "
    f"FROM positions a JOIN positions b ON a.user_id > b.user_id WHERE {NEAR} <= 1",
    "contacts": f"WITH {GEO}, {WROTE} SELECT user_left, user_right FROM wrote",
    "raw_orders": f"WITH {ORDER_LINES} SELECT object_id, 'order' AS object_type, {txt('order_dt')} AS sent_dttm, "
    f"status AS final_status, {dbl('cost')} AS cost FROM heads",
    "order_enrichment": ENRICHED,
    "product_counters": counter(txt("l_partkey"), "p_name", "product"),
    "category_counters": counter("p_type", "p_type", "category"),
    "vault_uuid5_hubs": ORDER_HUBS,
    "vault_uuid5_links": ORDER_LINKS,
    "vault_uuid5_satellites": ORDER_SATELLITES,
    "global_metrics": METRICS,
    "transactions_without_rate": f"WITH {FX} SELECT operation_id, {big('currency')} AS currency_code, amount, "
    f"{txt('dt')} AS transaction_dt FROM trans t WHERE NOT EXISTS "
    "(SELECT 1 FROM cur c WHERE c.currency = t.currency AND c.day = CAST(t.dt AS DATE))",
    "row_numbers": f"SELECT o_orderkey AS order_id, row_number() OVER (ORDER BY {dec('o_totalprice')}, o_orderkey) AS rn FROM orders",
    "quintiles": """SELECT tile, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high, CAST(sum(l_orderkey) AS BIGINT) AS keys
FROM (SELECT *, ntile(5) OVER (ORDER BY l_quantity, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS tile
      FROM lineitem) GROUP BY tile""",
    "quintile_rows": f"""SELECT l_orderkey, {big('l_linenumber')} AS l_linenumber, l_partkey, l_quantity,
       ntile(5) OVER (ORDER BY l_quantity, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS tile FROM lineitem""",
    "upsert_other_width": LAST_EVENT,
    "emptied_day": f"""SELECT event_id, round(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN value + 1 ELSE value END, 2) AS value,
       {txt('CAST(ts AS DATE)')} AS ds FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-11'""",
    "late_satellite": LATE_SATELLITE,
    "key_parts": KEY_PARTS,
    "rejected_lines": f"""SELECT {big('c_nationkey')} AS nation, c_mktsegment AS segment, count(*) AS n, {big('sum(c_custkey)')} AS ids
FROM customer WHERE c_custkey % 7 <> 0 GROUP BY 1, 2
UNION ALL SELECT -1, 'rejected', count(*), 0 FROM customer WHERE c_custkey % 7 = 0""",
    "unkeyed_documents": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, 'kept' AS state FROM events WHERE event_id % 11 <> 0
UNION ALL SELECT CAST(event_id AS VARCHAR), 'rejected' FROM events WHERE event_id % 11 = 0""",
    "sales_fact_one_day": f"""WITH {SALES} SELECT date_id, customer_id, {big('quantity')} AS quantity, {dbl('payment_amount')} AS payment_amount, status
FROM sales WHERE date_id = (SELECT date_id FROM cal WHERE date_actual = DATE '1997-01-15')""",
    "global_metrics_one_day": f"SELECT date_update, currency_from, amount_total, cnt_transactions FROM ({METRICS}) WHERE date_update = '1999-02-18'",
    "restarted_counters": "SELECT user_id, 2 * count(*) AS cnt FROM events GROUP BY user_id",
    "event_runs": f"""WITH m AS (
  SELECT *, CASE WHEN event_type <> lag(event_type) OVER w THEN 1 ELSE 0 END AS c FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT user_id, {big('island')} AS island, event_type, {txt('min(ts)')} AS first_at, {txt('max(ts)')} AS last_at, count(*) AS n
FROM n GROUP BY user_id, n.island, event_type""",
    "group_statistics": f"""SELECT l_orderkey, l_partkey, l_suppkey, {big('l_linenumber')} AS l_linenumber,
       {txt('l_shipdate')} AS l_shipdate,
       round(avg(l_quantity) OVER w, 6) AS avg_quantity, count(*) OVER w AS n_rows,
       count(*) FILTER (WHERE l_quantity > 25) OVER w AS n_large
FROM lineitem WINDOW w AS (PARTITION BY l_suppkey, l_returnflag)""",
    "duplicate_lines": f"SELECT l_orderkey, {big('l_linenumber')} AS l_linenumber, count(*) - 1 AS surplus "
    "FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "oldest_orders": f"SELECT o_orderkey AS order_id, {txt('o_orderdate')} AS order_ts, {dbl(dec('o_totalprice'))} AS cost "
    "FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10",
    "customers_without_closed_orders": "SELECT c_custkey AS id, c_name AS name FROM customer "
    "WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')",
    "constraint_report": """SELECT rule, count(*) AS n FROM (
  SELECT unnest([CASE WHEN l_orderkey IS NULL THEN 'not_null:l_orderkey' END,
                 CASE WHEN l_shipdate IS NULL THEN 'not_null:l_shipdate' END,
                 CASE WHEN NOT l_quantity <= 45 THEN 'check:quantity' END,
                 CASE WHEN NOT l_discount < 0.1::DOUBLE THEN 'check:discount' END,
                 CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'unique:l_orderkey,l_linenumber' END,
                 CASE WHEN l_partkey NOT IN (SELECT p_partkey FROM part) THEN 'references:l_partkey' END]) AS rule
  FROM lineitem) WHERE rule IS NOT NULL GROUP BY rule""",
    "order_keys": f"SELECT o_orderkey AS order_id, {uuid5(txt('o_orderkey'))} AS order_pk, "
    f"{uuid5(txt('o_custkey') + ' || chr(124) || ' + txt('o_orderkey'))} AS link_pk FROM orders",
    "quality_report": QUALITY,
    "stream_campaigns": CAMPAIGNS,
    "stream_counters": STREAM_COUNTERS,
    "stream_vault": STREAM_VAULT,
    "interrupted_targets": "SELECT event_type, count(*) AS stored, count(*) AS sent, CAST(0 AS BIGINT) AS seen_before FROM events GROUP BY event_type",
    "late_events": LATE_EVENTS,
    "watermark_drops": WATERMARK_DROPS,
    "stream_progress": "SELECT count(*) AS input_rows, true AS each_once, true AS more_than_remembered FROM events",
    "daily_increments": f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS ds, o_orderstatus AS status, count(*) AS n, {dbl(f"sum({dec('o_totalprice')})")} AS cost
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-15' AND DATE '1997-01-17' GROUP BY 1, 2""",
    "day_csv": f"""WITH d AS (SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-01-15')
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 <> 0 THEN {dbl(dec('o_totalprice'))} END AS cost, o_orderstatus AS status FROM d WHERE o_orderkey % 7 <> 0
UNION ALL SELECT count(*), NULL, 'rejected' FROM d WHERE o_orderkey % 7 = 0""",
    "reference_menus": f"""WITH {EVENT_LINES} SELECT DISTINCT event_type AS id, 'Restaurant ' || event_type AS name, {txt('k')} AS item,
  'Category ' || (k % 10) AS category FROM ol""",
    "rolling_days": f"SELECT o_orderkey AS order_id, {txt('o_orderdate')} AS order_ts FROM orders WHERE o_orderdate >= TIMESTAMP '1997-12-02 12:00:00'",
    "appended_views": f"""SELECT o_orderstatus AS status, count(*) AS n, {big("CASE WHEN o_orderstatus = 'F' THEN 2 * count(*) END")} AS added
FROM orders GROUP BY o_orderstatus""",
    "chat_staging": CHAT_STAGING,
    "travel_chunks": TRAVEL_CHUNKS,
    "nearest_of_many": MANY_CENTERS,
    "split_pages": f"""SELECT event_type, count(*) AS n, {big('sum(event_id)')} AS ids, {big(f'sum({K})')} AS ks FROM events WHERE event_id % 50 <> 0 GROUP BY 1
UNION ALL SELECT 'broken ' || event_type, count(*), 0, 0 FROM events WHERE event_id % 50 = 0 GROUP BY event_type""",
    "monthly_accounts": f"""WITH {FX} SELECT strftime(dt, '%Y-%m') AS month, {big('currency')} AS currency_from,
  count(DISTINCT account) AS cnt_accounts FROM trans GROUP BY 1, 2""",
    "layout_join": f"""SELECT o_orderkey AS order_id, {big('any_value(o_custkey)')} AS user_id, count(*) AS n,
  {dbl('sum(l_quantity)')} AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""",
    "previous_events": f"""WITH {HOT_EVENTS} SELECT event_id, user_id, lag(event_id) OVER w AS before, lag(event_type) OVER w AS type_before,
  lag(event_id) OVER w IS NOT NULL AS has_before FROM hot WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "hot_satellite": HOT_SATELLITE,
}
