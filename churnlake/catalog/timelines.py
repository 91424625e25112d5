"""Registered queries: grouping sets, joins in time, sessions, snapshots, cohorts and payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.catalog.relations import Tables, query
from churnlake.catalog.sql import RAW_CTE, big, emean, esum, over, r
from churnlake.functions.numbers import round_even
from churnlake.functions.times import DAY, HOUR
from churnlake.operators import asof, cohorts, grouping, overlaps, payloads, sessions, skew, snapshots
from churnlake.sources.tables import customers_from_orders

# Declared, so that no job has to read file footers first.
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
LINES = "l_orderkey bigint, l_shipdate timestamp_ntz"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _table(t: Tables, name: str, schema: str):
    return t.spark.read.schema(schema).parquet(f"{t.directory}/{name}.parquet")


# ---- grouping sets ----

_KEYS = ("Contract", "InternetService", "PaymentMethod")
_MEASURES = {"n": ("count", None), "churned": ("sum", "Churn"), "revenue": ("sum", "MonthlyCharges"),
             "mean_charge": ("mean", "MonthlyCharges"), "shortest": ("min", "tenure"), "longest": ("max", "tenure")}


def _sets_sql(grouped: str) -> str:
    return over("clean", f"""SELECT {", ".join(_KEYS)}, {big(f"GROUPING({', '.join(_KEYS)})")} AS grouping_id, count(*) AS n,
  {esum("Churn")} AS churned, {esum("MonthlyCharges")} AS revenue, {r(emean("MonthlyCharges"), 6)} AS mean_charge,
  min(tenure) AS shortest, max(tenure) AS longest
FROM (SELECT * REPLACE (nullif(InternetService, 'No') AS InternetService) FROM clean) GROUP BY {grouped}""")


def _with_null_keys(t: Tables):
    """No internet service as a null key, which must not be taken for a subtotal."""
    return t.clean.withColumn("InternetService", F.expr("nullif(InternetService, 'No')"))


def _rounded_mean(df):
    return df.withColumn("mean_charge", round_even(F.col("mean_charge"), 6))


@query("seg_20_rollup", _sets_sql(f"ROLLUP ({', '.join(_KEYS)})"))
def _(t: Tables):
    return _rounded_mean(grouping.rollup(_with_null_keys(t), _KEYS, _MEASURES))


@query("seg_21_cube", _sets_sql(f"CUBE ({', '.join(_KEYS)})"))
def _(t: Tables):
    return _rounded_mean(grouping.cube(_with_null_keys(t), _KEYS, _MEASURES))


@query("seg_22_grouping_sets", _sets_sql(
    "GROUPING SETS ((Contract, PaymentMethod), (InternetService), (PaymentMethod, InternetService), ())"))
def _(t: Tables):
    sets = [("Contract", "PaymentMethod"), ("InternetService",), ("PaymentMethod", "InternetService"), ()]
    return _rounded_mean(grouping.grouping_sets(_with_null_keys(t), _KEYS, sets, _MEASURES))


# ---- joins ----


@query("jn_1_asof_orders", """SELECT e.event_id, e.user_id, e.ts, o.o_orderkey, o.o_orderdate, o.o_totalprice
FROM events e ASOF LEFT JOIN (
  SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1) o
ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate""")
def _(t: Tables):
    """The latest order at or before each event of a customer."""
    events = _table(t, "events", EVENTS).select("event_id", "user_id", "ts")
    return asof.asof_join(events, _table(t, "orders", ORDERS), [("user_id", "o_custkey")], "ts", "o_orderdate",
                          ["o_orderkey", "o_orderdate", "o_totalprice"], ties=["o_orderkey"])


@query("jn_2_asof_clicks", """SELECT e.event_id, e.user_id, e.ts,
  CASE WHEN e.ts - c.click_ts <= INTERVAL 1 DAY THEN c.click_id END AS click_id,
  CASE WHEN e.ts - c.click_ts <= INTERVAL 1 DAY THEN c.click_ts END AS click_ts
FROM (SELECT * FROM events WHERE event_type = 'error') e ASOF LEFT JOIN (
  SELECT user_id, ts AS click_ts, max(event_id) AS click_id FROM events WHERE event_type = 'click' GROUP BY user_id, ts) c
ON e.user_id = c.user_id AND e.ts > c.click_ts""")
def _(t: Tables):
    """The last click before each error of a user, within a day."""
    events = _table(t, "events", EVENTS)
    clicks = events.where("event_type = 'click'").selectExpr("user_id AS click_user", "ts AS click_ts", "event_id AS click_id")
    errors = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    return asof.asof_join(errors, clicks, [("user_id", "click_user")], "ts", "click_ts", ["click_id", "click_ts"],
                          ties=["click_id"], strict=True, within=DAY)


@query("jn_3_overlapping_orders", """WITH open AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS a, max(l_shipdate) AS b
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT x.c AS customer, x.k AS first_order, y.k AS second_order
FROM open x JOIN open y ON x.c = y.c AND x.k < y.k AND x.a <= y.b AND y.a <= x.b AND x.a <= x.b AND y.a <= y.b""")
def _(t: Tables):
    """Pairs of a customer's orders that were open, from order to last shipment, at the same time."""
    shipped = _table(t, "lineitem", LINES).groupBy("l_orderkey").agg(F.max("l_shipdate").alias("b"))
    open_ = _table(t, "orders", ORDERS).selectExpr("o_orderkey AS k", "o_custkey AS c", "o_orderdate AS a").join(
        shipped, F.col("k") == F.col("l_orderkey")).select("k", "c", "a", "b")
    pairs = overlaps.interval_join(open_, open_, ("a", "b"), ("a", "b"), on=[("c", "c")])
    return pairs.where("l.k < r.k").selectExpr("l.c AS customer", "l.k AS first_order", "r.k AS second_order")


@query("jn_4_skewed_priorities", f"""SELECT o_orderkey, status, orders_of_status, total_of_status
FROM orders JOIN (
  SELECT o_orderpriority AS priority, o_orderstatus AS status, count(*) AS orders_of_status, {esum("o_totalprice")} AS total_of_status
  FROM orders GROUP BY ALL) ON o_orderpriority = priority""")
def _(t: Tables):
    """Every order with the totals of each status of its priority: a join on a key of which every value is hot."""
    orders = _table(t, "orders", ORDERS)
    totals = orders.groupBy(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("orders_of_status"),
        F.sum(F.col("o_totalprice").cast("decimal(18,4)")).cast("double").alias("total_of_status"))
    joined = skew.skew_join(orders.select("o_orderkey", "o_orderpriority"), totals, [("o_orderpriority", "priority")],
                            ["status", "orders_of_status", "total_of_status"])
    return joined.drop("o_orderpriority")


# ---- sessions ----


@query("ses_1_sessions", f"""WITH e AS (
  SELECT user_id, ts, event_id, value, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER w AS before FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(CASE WHEN us - before <= {6 * HOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts
  ROWS UNBOUNDED PRECEDING) AS no FROM e),
g AS (SELECT user_id, no, min(ts) AS start, max(ts) AS "end", count(*) AS n_rows, {esum("value")} AS value, max(value) AS top
  FROM s GROUP BY user_id, no)
SELECT user_id, start, "end", n_rows, value, top,
  epoch_us(start) - lag(epoch_us("end")) OVER (PARTITION BY user_id ORDER BY start) AS idle FROM g""")
def _(t: Tables):
    """Sessions of a user's events with pauses of six hours at most, and the pause before each."""
    return sessions.islands(_table(t, "events", EVENTS).select("user_id", "ts", "value"), ["user_id"], "ts", 6 * HOUR,
                            {"value": ("sum", "value"), "top": ("max", "value")})


# ---- snapshots ----

SNAPSHOT = "2001-03-01"


def _snapshots_sql(body: str) -> str:
    """``body`` over the raw customers before the snapshot date and now."""
    def raw(where: str) -> str:
        return f"WITH orders AS (SELECT * FROM orders {where}), {RAW_CTE} SELECT * FROM raw"
    early = raw(f"WHERE o_orderdate < TIMESTAMP '{SNAPSHOT}'")
    return f"WITH before_ AS ({early}), after_ AS ({raw('')})\n{body}"


def _counted(operation: str) -> str:
    return _snapshots_sql(f"SELECT *, count(*) AS copies FROM ({operation}) GROUP BY ALL")


def _versions(t: Tables):
    return customers_from_orders(t.spark, t.directory, SNAPSHOT), t.raw


@query("set_1_except_all", _counted("SELECT * FROM before_ EXCEPT ALL SELECT * FROM after_"))
def _(t: Tables):
    return snapshots.except_all(*_versions(t))


@query("set_2_intersect_all", _counted("SELECT * FROM before_ INTERSECT ALL SELECT * FROM after_"))
def _(t: Tables):
    return snapshots.intersect_all(*_versions(t))


_RAW = ("customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService", "MultipleLines", "InternetService",
        "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
        "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn")


@query("set_3_changes", _snapshots_sql(f""", gone AS (SELECT *, count(*) AS n FROM (SELECT * FROM before_ EXCEPT ALL SELECT * FROM after_) GROUP BY ALL),
new AS (SELECT *, count(*) AS n FROM (SELECT * FROM after_ EXCEPT ALL SELECT * FROM before_) GROUP BY ALL)
SELECT coalesce(x.customerID, y.customerID) AS customerID,
  CASE WHEN x.customerID IS NULL THEN 'added' WHEN y.customerID IS NULL THEN 'removed' ELSE 'changed' END AS change,
  CAST(coalesce(x.n, 0) AS BIGINT) AS n_before, CAST(coalesce(y.n, 0) AS BIGINT) AS n_after,
  CASE WHEN x.customerID = y.customerID THEN concat_ws(',', {", ".join(
    f"CASE WHEN x.{c} IS DISTINCT FROM y.{c} THEN '{c}' END" for c in _RAW)}) END AS columns
FROM gone x FULL JOIN new y ON x.customerID = y.customerID""").replace("\n, gone", ", gone"))
def _(t: Tables):
    """Customers whose row is another one now than at the snapshot, and which columns differ."""
    return snapshots.changes(*_versions(t), ["customerID"])


# ---- cohorts ----


@query("coh_1_retention", f"""WITH m AS (SELECT DISTINCT o_custkey AS k, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m FROM orders),
f AS (SELECT k, min(m) AS c FROM m GROUP BY k),
n AS (SELECT c, m - c AS a, count(*) AS active FROM m JOIN f USING (k) GROUP BY c, m - c),
spine AS (SELECT c, a FROM (SELECT unnest(range((SELECT min(c) FROM n), (SELECT max(m) FROM m) + 1)) AS c),
  LATERAL (SELECT unnest(range(0, (SELECT max(m) FROM m) - c + 1)) AS a)),
j AS (SELECT s.c, s.a, coalesce(n.active, 0) AS active, coalesce(z.active, 0) AS size FROM spine s
  LEFT JOIN n ON s.c = n.c AND s.a = n.a LEFT JOIN n z ON s.c = z.c AND z.a = 0)
SELECT format('{{:04d}}-{{:02d}}', c // 12, c % 12 + 1) AS cohort, {big("a")} AS age, {big("size")} AS customers, {big("active")} AS active,
  {r("CAST(active AS DOUBLE) / CAST(nullif(size, 0) AS DOUBLE) * 100.0", 2)} AS retention FROM j""")
def _(t: Tables):
    """Customers who order again, by the month of their first order and the months since."""
    return cohorts.retention(_table(t, "orders", ORDERS), "o_custkey", "o_orderdate")


@query("coh_2_survival", over("clean", f"""SELECT Contract, duration, {big("at_risk")} AS at_risk, {big("events")} AS events, {big("n - events")} AS censored,
  {r("s", 6)} AS survival, {r("CASE WHEN alive THEN s * sqrt(g) END", 6)} AS std_error
FROM (SELECT *, min(events < at_risk) OVER w AS alive,
    CASE WHEN min(events < at_risk) OVER w THEN exp(sum(CASE WHEN events < at_risk THEN ln(1 - CAST(events AS DOUBLE) / at_risk) END) OVER w) ELSE 0.0 END AS s,
    sum(CASE WHEN events < at_risk THEN CAST(events AS DOUBLE) / (CAST(at_risk AS DOUBLE) * (at_risk - events)) END) OVER w AS g
  FROM (SELECT *, sum(n) OVER (PARTITION BY Contract ORDER BY duration DESC) AS at_risk
    FROM (SELECT Contract, tenure AS duration, sum(Churn) AS events, count(*) AS n FROM clean GROUP BY Contract, tenure))
  WINDOW w AS (PARTITION BY Contract ORDER BY duration))"""))
def _(t: Tables):
    """Kaplan-Meier curve of the months until churn, by contract."""
    return cohorts.survival(t.clean, "tenure", "Churn", ["Contract"])


# ---- payloads ----

#: Payload text of an event in the forms that a stream of them has: whole, cut off, absent, not an object, wrongly typed.
_PAYLOAD = """CASE event_id % 13 WHEN 1 THEN substring(props, 1, 5) WHEN 2 THEN NULL WHEN 3 THEN '[1, 2]'
  WHEN 4 THEN concat('{"k": "', event_type, '"}') WHEN 5 THEN concat('{"type": "', event_type, '"}')
  WHEN 6 THEN replace(props, '}', ', "type": null, "steps": []}') WHEN 7 THEN replace(props, '}', ', "type": 5, "steps": ["a"]}')
  ELSE concat(replace(props, '}', concat(', "type": "', event_type, '", "steps": [')), user_id, ', ', event_id, ', null]}') END"""


def _payloads(t: Tables):
    events = _table(t, "events", EVENTS).select("event_id", "event_type", F.expr(_PAYLOAD).alias("payload"))
    return payloads.parse(events, "payload", {"k": "bigint", "type": "string", "steps": "array<bigint>"}, required=["k", "type"])


_PARSED_SQL = f"""WITH p AS (SELECT event_id, event_type, {_PAYLOAD} AS payload FROM events),
d AS (SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc FROM p),
v AS (SELECT *, json_type(doc, '$.k') AS tk, json_type(doc, '$.type') AS tt, json_type(doc, '$.steps') AS ts,
  CAST(json_extract(doc, '$.steps[*]') AS JSON[]) AS items FROM d),
q AS (SELECT *, CASE WHEN tk IN ('UBIGINT', 'BIGINT') THEN CAST(doc ->> '$.k' AS BIGINT) END AS k,
  CASE WHEN tt = 'VARCHAR' THEN doc ->> '$.type' END AS type,
  CASE WHEN ts = 'ARRAY' AND len([x for x in items if json_type(x) NOT IN ('UBIGINT', 'BIGINT', 'NULL')]) = 0
    THEN [TRY_CAST(CAST(x AS VARCHAR) AS BIGINT) for x in items] END AS steps FROM v),
parsed AS (SELECT *, CASE WHEN payload IS NULL THEN 'absent' WHEN doc IS NULL THEN 'malformed' WHEN json_type(doc) <> 'OBJECT' THEN 'no object'
  WHEN k IS NULL AND tk <> 'NULL' THEN 'type of k' WHEN type IS NULL AND tt <> 'NULL' THEN 'type of type'
  WHEN steps IS NULL AND ts <> 'NULL' THEN 'type of steps' WHEN k IS NULL THEN 'no k' WHEN type IS NULL THEN 'no type' END AS problem FROM q)
"""


@query("pay_1_parse", _PARSED_SQL + "SELECT event_id, k, type, problem FROM parsed")
def _(t: Tables):
    return _payloads(t).select("event_id", "k", "type", "problem")


@query("pay_2_problems", _PARSED_SQL + "SELECT coalesce(problem, 'ok') AS problem, count(*) AS n FROM parsed GROUP BY 1")
def _(t: Tables):
    return payloads.problems(_payloads(t))


@query("pay_3_folded", _PARSED_SQL + """SELECT event_id, len([x for x in steps if x IS NOT NULL]) AS n,
  CASE WHEN steps IS NOT NULL THEN CAST(coalesce(list_sum(steps), 0) AS DOUBLE) END AS total, list_min(steps) AS least, list_max(steps) AS most
FROM parsed""")
def _(t: Tables):
    return payloads.folded(_payloads(t), "steps", {"n": "n", "total": "sum", "least": "least", "most": "most"}).select(
        "event_id", "n", "total", "least", "most")


@query("pay_4_map_totals", f"""SELECT event_type, key AS name, count(*) AS n, {esum("CAST(value AS DOUBLE)")} AS total
FROM (SELECT event_type, unnest(json_keys(props)) AS key, props ->> unnest(json_keys(props)) AS value FROM events) GROUP BY event_type, key""")
def _(t: Tables):
    events = _table(t, "events", EVENTS).select("event_type", F.from_json("props", "map<string, double>").alias("entries"))
    return payloads.map_totals(events, ["event_type"], "entries")
