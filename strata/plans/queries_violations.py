"""The data checks on inputs with known violations, derived from the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import medallion, model, quality
from strata.plans.catalog import register
from strata.plans.oracle import CLEAN_CTE, SILVER_CTE, with_raw
from strata.plans.queries_commerce import _daily_value
from strata.sources.driver_tables import events_as_raw, read_table


@register(
    "orders_key_duplicates_found",
    "SELECT o_orderkey, 2::BIGINT AS n FROM orders WHERE o_orderstatus = 'P'",
)
def q_orders_key_duplicates_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and, once more, the partly shipped ones."""
    orders = read_table(spark, sf_dir, "orders")
    return quality.unique_violations(orders.unionByName(orders.filter("o_orderstatus = 'P'")), "o_orderkey")


@register(
    "orders_status_not_accepted",
    "SELECT * FROM orders WHERE o_orderstatus = 'P'",
)
def q_orders_status_not_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_values_violations(read_table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


@register(
    "lineitem_order_orphans_found",
    """SELECT l.l_orderkey, count(*) AS n_rows
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P'
WHERE o.o_orderkey IS NULL GROUP BY ALL""",
)
def q_lineitem_order_orphans_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines against the orders without the partly shipped ones."""
    parents = read_table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    return quality.relationship_violations(read_table(spark, sf_dir, "lineitem"), parents, "l_orderkey", "o_orderkey")


@register(
    "lineitem_part_orphans_found",
    """SELECT l_partkey * 3 AS shifted, count(*) AS n_rows FROM lineitem
WHERE l_partkey * 3 > (SELECT max(p_partkey) FROM part) GROUP BY ALL""",
)
def q_lineitem_part_orphans_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tripled part keys: those beyond the last part have no parent (part keys have no gaps)."""
    lines = read_table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 3).alias("shifted"))
    return quality.relationship_violations(lines, read_table(spark, sf_dir, "part"), "shifted", "p_partkey")


@register(
    "orders_negative_totals_found",
    "SELECT o_orderkey, 1000 - o_totalprice AS rest FROM orders WHERE o_totalprice > 1000",
)
def q_orders_negative_totals_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = read_table(spark, sf_dir, "orders").select("o_orderkey", (F.lit(1000) - F.col("o_totalprice")).alias("rest"))
    return quality.negative_violations(rest, "rest")


@register(
    "orders_after_a_date",
    "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-30 00:00:00'",
)
def q_orders_after_a_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("1997-06-30 00:00:00").cast("timestamp")
    return quality.future_violations(read_table(spark, sf_dir, "orders"), "o_orderdate", now)


@register(
    "events_quarantine_found",
    "SELECT * FROM events WHERE value < 50 OR event_type = 'view'",
)
def q_events_quarantine_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return quality.quarantine(events, (F.col("value") < 50) | (F.col("event_type") == "view"))[1]


@register(
    "daily_value_small_drops",
    """WITH d AS (SELECT ts::DATE AS event_date, sum(value::DECIMAL(18,2))::DOUBLE AS total_value FROM events GROUP BY ALL),
p AS (SELECT *, lag(total_value) OVER (ORDER BY event_date) AS prev_value FROM d)
SELECT *, (total_value - prev_value) / prev_value AS change FROM p WHERE (total_value - prev_value) / prev_value < -0.001""",
)
def q_daily_value_small_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_alerts(_daily_value(spark, sf_dir), "event_date", "total_value", 0.001)


@register(
    "gold_returning_users_by_type",
    with_raw(
        """SELECT if(questions = 1, 'One_time_user', 'Returning_user') AS is_repeat_user, count(user_id) AS user_count
FROM (SELECT user_id || '/' || event_type || '/' || time_posted::DATE AS user_id, count(*) AS questions
      FROM clean GROUP BY ALL) GROUP BY ALL""",
        SILVER_CTE,
        CLEAN_CTE,
    ),
)
def q_gold_returning_users_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users told apart by event type and day: both classes occur."""
    clean = medallion.clean_silver(medallion.to_silver(events_as_raw(spark, sf_dir, with_region=False)))
    parts = [F.col("user_id"), F.col("event_type"), F.to_date("time_posted").cast("string")]
    return medallion.gold_returning_users(clean.withColumn("user_id", F.concat_ws("/", *parts)))


@register(
    "customer_priority_changes",
    """WITH b AS (SELECT if(o_orderstatus <> 'P', o_custkey, NULL) AS k, max(o_orderpriority) AS p FROM orders GROUP BY 1),
a AS (SELECT if(o_orderstatus <> 'P', o_custkey, NULL) AS k, max(o_orderpriority) AS p FROM orders
      WHERE o_orderdate < TIMESTAMP '1995-06-30' GROUP BY 1),
j AS (SELECT b.k IS NOT DISTINCT FROM a.k AS same, b.k, b.p AS before, a.p AS after, a.p IS NULL AS gone
      FROM b LEFT JOIN a ON b.k IS NOT DISTINCT FROM a.k)
SELECT k, CASE WHEN gone THEN 'delete' ELSE 'update' END AS change_type, before AS o_orderpriority_before,
    after AS o_orderpriority_after FROM j WHERE before IS DISTINCT FROM after""",
)
def q_customer_priority_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change capture with a null key and many rows per key."""
    orders = read_table(spark, sf_dir, "orders")
    keyed = orders.withColumn("k", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    earlier = keyed.filter(F.col("o_orderdate") < F.lit("1995-06-30").cast("timestamp_ntz"))
    return model.capture_changes(keyed, earlier, "k", ["o_orderpriority"])
