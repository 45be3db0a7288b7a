"""Registered queries: commerce reporting, dimensional model, checks, privacy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import commerce, model, privacy, quality
from strata.plans.catalog import register
from strata.sources.driver_tables import customer_regions, read_table

CUST_REGION = """WITH cust_region AS (
    SELECT c.c_custkey, r.r_name
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)
"""

DEC = "CAST({} AS DECIMAL(18,2))"
NET = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --- events as sales ------------------------------------------------------------


@register(
    "hourly_summary",
    f"""SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS event_count,
       CAST(SUM({DEC.format('value')}) AS DOUBLE) AS total_value,
       CAST(SUM({DEC.format('value')}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_value
FROM events GROUP BY 1""",
)
def q_hourly_summary(spark, sf_dir):
    return commerce.hourly_summary(_t(spark, sf_dir, "events"))


@register(
    "hourly_engagement",
    """SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS event_count,
       COUNT(DISTINCT user_id) AS active_users
FROM events GROUP BY 1""",
)
def q_hourly_engagement(spark, sf_dir):
    return commerce.hourly_engagement(_t(spark, sf_dir, "events"))


@register(
    "user_segments",
    """SELECT segment, COUNT(*) AS user_count, CAST(SUM(n) AS BIGINT) AS event_count FROM (
    SELECT user_id, COUNT(*) AS n,
           CASE WHEN COUNT(*) < 50 THEN 'light' WHEN COUNT(*) < 100 THEN 'regular' ELSE 'heavy' END AS segment
    FROM events GROUP BY user_id) u
GROUP BY segment""",
)
def q_user_segments(spark, sf_dir):
    return commerce.user_segments(_t(spark, sf_dir, "events"))


@register(
    "hourly_anomalies",
    """WITH h AS (SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS event_count FROM events GROUP BY 1),
s AS (SELECT AVG(event_count) AS m, STDDEV_SAMP(event_count) AS sd FROM h)
SELECT h.hour, h.event_count, round((h.event_count - s.m) / s.sd, 4) AS z_score
FROM h, s WHERE abs((h.event_count - s.m) / s.sd) > 2.0""",
)
def q_hourly_anomalies(spark, sf_dir):
    out = commerce.hourly_anomalies(_t(spark, sf_dir, "events"), z=2.0)
    return out.withColumn("z_score", F.round("z_score", 4))


@register(
    "value_outliers",
    """SELECT * FROM events
WHERE value > (SELECT AVG(value) + 2 * STDDEV_SAMP(value) FROM events)""",
)
def q_value_outliers(spark, sf_dir):
    return commerce.value_outliers(_t(spark, sf_dir, "events"), "value", 2.0)


@register(
    "revenue_tiers",
    f"""SELECT CASE WHEN value < 50 THEN 'Low' WHEN value <= 200 THEN 'Medium'
            WHEN value > 200 THEN 'High' END AS tier,
       COUNT(*) AS row_count, CAST(SUM({DEC.format('value')}) AS DOUBLE) AS total_value
FROM events GROUP BY 1""",
)
def q_revenue_tiers(spark, sf_dir):
    return commerce.revenue_tiers(_t(spark, sf_dir, "events"))


@register(
    "daily_value_change",
    f"""WITH d AS (SELECT CAST(ts AS DATE) AS event_date,
                  CAST(SUM({DEC.format('value')}) AS DOUBLE) AS total_value
           FROM events GROUP BY 1)
SELECT event_date, total_value, LAG(total_value) OVER (ORDER BY event_date) AS prev_value,
       (total_value - LAG(total_value) OVER (ORDER BY event_date))
         / LAG(total_value) OVER (ORDER BY event_date) AS change
FROM d""",
)
def q_daily_value_change(spark, sf_dir):
    return quality.day_over_day_change(_daily_value(spark, sf_dir), "event_date", "total_value")


def _daily_value(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    agg = ev.groupBy(F.to_date("ts").alias("event_date")).agg(
        F.sum(commerce.money("value")).alias("_v")
    )
    return agg.select("event_date", F.col("_v").cast("double").alias("total_value"))


@register(
    "daily_value_drop_alerts",
    f"""WITH d AS (SELECT CAST(ts AS DATE) AS event_date,
                  CAST(SUM({DEC.format('value')}) AS DOUBLE) AS total_value
           FROM events GROUP BY 1),
c AS (SELECT event_date, total_value, LAG(total_value) OVER (ORDER BY event_date) AS prev_value FROM d)
SELECT event_date, total_value, prev_value, (total_value - prev_value) / prev_value AS change
FROM c WHERE (total_value - prev_value) / prev_value < -0.3""",
)
def q_daily_value_drop_alerts(spark, sf_dir):
    return quality.drop_alerts(_daily_value(spark, sf_dir), "event_date", "total_value", 0.3)


@register(
    "props_variant_get",
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def q_props_variant_get(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    v = F.try_parse_json("props")
    return ev.select("event_id", F.try_variant_get(v, "$.k", "int").alias("k"))


@register(
    "props_flatten",
    """SELECT e.event_id, j.key AS prop_key, CAST(j.value AS VARCHAR) AS prop_value
FROM events e, json_each(e.props) j""",
)
def q_props_flatten(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    exploded = ev.lateralJoin(
        spark.tvf.variant_explode(F.try_parse_json(F.col("props").outer())).alias("j")
    )
    return exploded.select(
        "event_id",
        F.col("j.key").alias("prop_key"),
        F.col("j.value").cast("string").alias("prop_value"),
    )


# --- orders -------------------------------------------------------------------


@register(
    "order_totals",
    f"""SELECT COUNT(*) AS order_count,
       CAST(SUM({DEC.format('o_totalprice')}) AS DOUBLE) AS revenue,
       CAST(SUM({DEC.format('o_totalprice')}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_order_value
FROM orders""",
)
def q_order_totals(spark, sf_dir):
    return commerce.order_totals(_t(spark, sf_dir, "orders"))


@register(
    "yearly_kpis",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, COUNT(*) AS order_count,
       CAST(SUM({DEC.format('o_totalprice')}) AS DOUBLE) AS revenue,
       CAST(SUM({DEC.format('o_totalprice')}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_order_value,
       CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) * 100 / CAST(COUNT(*) AS DOUBLE)
         AS cancellation_rate_pct
FROM orders GROUP BY 1""",
)
def q_yearly_kpis(spark, sf_dir):
    return commerce.yearly_kpis(_t(spark, sf_dir, "orders"))


@register(
    "status_pivot",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
       COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS status_F,
       COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS status_O,
       COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS status_P,
       COUNT(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')) AS status_other,
       COUNT(*) AS total
FROM orders GROUP BY 1""",
)
def q_status_pivot(spark, sf_dir):
    return commerce.status_pivot(_t(spark, sf_dir, "orders"))


@register(
    "daily_orders",
    f"""SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS order_count,
       CAST(SUM({DEC.format('o_totalprice')}) AS DOUBLE) AS revenue
FROM orders GROUP BY 1""",
)
def q_daily_orders(spark, sf_dir):
    return commerce.daily_orders(_t(spark, sf_dir, "orders"))


@register(
    "ytd_revenue",
    f"""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS order_date,
                  SUM({DEC.format('o_totalprice')}) AS rev
           FROM orders GROUP BY 1)
SELECT order_date, CAST(rev AS DOUBLE) AS revenue,
       CAST(SUM(rev) OVER (PARTITION BY year(order_date) ORDER BY order_date
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS ytd_revenue
FROM d""",
)
def q_ytd_revenue(spark, sf_dir):
    return commerce.ytd_revenue(_t(spark, sf_dir, "orders"))


@register(
    "regional_revenue",
    CUST_REGION
    + f"""SELECT COALESCE(cr.r_name, 'UNKNOWN') AS region, COUNT(*) AS order_count,
       CAST(SUM({DEC.format('o.o_totalprice')}) AS DOUBLE) AS revenue
FROM orders o LEFT JOIN cust_region cr ON o.o_custkey = cr.c_custkey
GROUP BY 1""",
)
def q_regional_revenue(spark, sf_dir):
    return commerce.regional_revenue(_t(spark, sf_dir, "orders"), customer_regions(spark, sf_dir))


@register(
    "orders_by_region_status",
    CUST_REGION
    + f"""SELECT COALESCE(cr.r_name, 'UNKNOWN') AS region, o.o_orderstatus AS order_status,
       COUNT(*) AS order_count, CAST(SUM({DEC.format('o.o_totalprice')}) AS DOUBLE) AS revenue
FROM orders o LEFT JOIN cust_region cr ON o.o_custkey = cr.c_custkey
GROUP BY 1, 2""",
)
def q_orders_by_region_status(spark, sf_dir):
    return commerce.orders_by_region_status(
        _t(spark, sf_dir, "orders"), customer_regions(spark, sf_dir)
    )


@register(
    "filtered_orders",
    CUST_REGION
    + """SELECT o.* FROM orders o
WHERE o.o_orderdate >= TIMESTAMP '1996-01-01' AND o.o_orderdate < TIMESTAMP '1998-01-01'
  AND o.o_orderstatus IN ('O', 'P')
  AND o.o_custkey IN (SELECT c_custkey FROM cust_region WHERE r_name IN ('ASIA', 'EUROPE'))""",
)
def q_filtered_orders(spark, sf_dir):
    return commerce.filter_orders(
        _t(spark, sf_dir, "orders"),
        start="1996-01-01",
        end="1998-01-01",
        statuses=["O", "P"],
        regions=["ASIA", "EUROPE"],
        customer_regions=customer_regions(spark, sf_dir),
    )


# --- products ---------------------------------------------------------------


@register(
    "top_products",
    f"""WITH t AS (SELECT l_partkey AS product_id, SUM({DEC.format('l_quantity')}) AS q
           FROM lineitem GROUP BY 1 ORDER BY q DESC, product_id ASC LIMIT 10)
SELECT CAST(ROW_NUMBER() OVER (ORDER BY q DESC, product_id ASC) AS INTEGER) AS rank,
       t.product_id, p.p_name AS product_name, CAST(q AS DOUBLE) AS total_quantity
FROM t LEFT JOIN part p ON t.product_id = p.p_partkey""",
)
def q_top_products(spark, sf_dir):
    return commerce.top_products(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part"), 10)


@register(
    "product_revenue",
    f"""SELECT l_partkey AS product_id, CAST(SUM({NET}) AS DOUBLE) AS revenue
FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
GROUP BY 1""",
)
def q_product_revenue(spark, sf_dir):
    return commerce.product_revenue(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"), "F")


@register(
    "category_drilldown",
    f"""WITH pp AS (SELECT l_partkey, SUM({DEC.format('l_quantity')}) AS q, SUM({NET}) AS r
            FROM lineitem GROUP BY 1)
SELECT p.p_brand AS category, p.p_type AS product_type,
       CAST(GROUPING(p.p_brand, p.p_type) AS INTEGER) AS grouping_level,
       CAST(SUM(q) AS DOUBLE) AS quantity, CAST(SUM(r) AS DOUBLE) AS revenue
FROM pp LEFT JOIN part p ON pp.l_partkey = p.p_partkey
GROUP BY ROLLUP (p.p_brand, p.p_type)""",
)
def q_category_drilldown(spark, sf_dir):
    return commerce.category_drilldown(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part"))


# --- dimensional model -----------------------------------------------------------

STAGE_ORDERS_SQL = f"""SELECT order_id, customer_id, order_status, total_amount, order_ts, order_date, order_priority
FROM (
    SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id,
           upper(trim(o_orderstatus)) AS order_status,
           CAST({DEC.format('o_totalprice')} AS DOUBLE) AS total_amount,
           o_orderdate AS order_ts, CAST(o_orderdate AS DATE) AS order_date,
           o_orderpriority AS order_priority,
           ROW_NUMBER() OVER (PARTITION BY o_orderkey
                              ORDER BY o_orderdate DESC NULLS LAST,
                                       CAST({DEC.format('o_totalprice')} AS DOUBLE) DESC NULLS LAST,
                                       upper(trim(o_orderstatus)) ASC NULLS LAST) AS rn
    FROM orders WHERE o_orderkey IS NOT NULL) s
WHERE rn = 1"""


@register("stage_orders", STAGE_ORDERS_SQL)
def q_stage_orders(spark, sf_dir):
    return model.stage_orders(_t(spark, sf_dir, "orders"))


@register(
    "dim_products",
    """SELECT DISTINCT p_partkey AS product_key, CAST(p_partkey AS VARCHAR) AS product_id,
       p_name AS product_name, p_brand AS category
FROM part""",
)
def q_dim_products(spark, sf_dir):
    return model.dim_products(_t(spark, sf_dir, "part"))


@register(
    "dim_regions",
    """SELECT n.n_nationkey AS region_key, upper(replace(r.r_name, ' ', '_')) AS region_code,
       r.r_name AS region_name, n.n_name AS country, 'UTC' AS timezone
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
def q_dim_regions(spark, sf_dir):
    return model.dim_regions(_t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region"))


@register(
    "dim_customers",
    """SELECT c_custkey AS customer_key, c_name AS customer_id,
       regexp_replace(lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example',
                      '^.+@', '***@') AS email_masked
FROM customer""",
)
def q_dim_customers(spark, sf_dir):
    return model.dim_customers(_t(spark, sf_dir, "customer"))


@register(
    "dim_date",
    """WITH b AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders),
s AS (SELECT CAST(generate_series AS DATE) AS d
      FROM b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY))
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) AS INTEGER) AS day_of_week
FROM s""",
)
def q_dim_date(spark, sf_dir):
    return model.dim_date(_t(spark, sf_dir, "orders"), "o_orderdate")


@register(
    "fact_orders",
    f"""SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_number, l.l_partkey AS product_key,
       o.o_custkey AS customer_key, c.c_nationkey AS region_key, l.l_quantity AS quantity,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS revenue,
       CAST({NET} AS DOUBLE) AS net_revenue,
       CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER)
         AS order_date_key
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def q_fact_orders(spark, sf_dir):
    return model.fact_orders(
        _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")
    )


DERIVED_STATUS = """derived AS (
    SELECT l_orderkey AS o_orderkey,
           CASE WHEN COUNT(*) FILTER (WHERE l_linestatus = 'F') = COUNT(*) THEN 'F'
                WHEN COUNT(*) FILTER (WHERE l_linestatus = 'O') = COUNT(*) THEN 'O'
                ELSE 'P' END AS o_orderstatus
    FROM lineitem GROUP BY l_orderkey
)"""


@register(
    "order_status_changes",
    f"""WITH {DERIVED_STATUS}
SELECT COALESCE(b.o_orderkey, a.o_orderkey) AS o_orderkey,
       CASE WHEN b.o_orderkey IS NULL THEN 'insert'
            WHEN a.o_orderkey IS NULL THEN 'delete'
            ELSE 'update' END AS change_type,
       b.o_orderstatus AS o_orderstatus_before, a.o_orderstatus AS o_orderstatus_after
FROM orders b FULL OUTER JOIN derived a ON b.o_orderkey = a.o_orderkey
WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL
   OR b.o_orderstatus IS DISTINCT FROM a.o_orderstatus""",
)
def q_order_status_changes(spark, sf_dir):
    before = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    after = model.derived_order_status(_t(spark, sf_dir, "lineitem"))
    return model.capture_changes(before, after, "o_orderkey", ["o_orderstatus"])


SCD2_EFFECTIVE = "2001-09-01"


@register(
    "order_status_scd2",
    f"""WITH {DERIVED_STATUS},
cur AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS valid_from FROM orders),
j AS (SELECT COALESCE(c.o_orderkey, d.o_orderkey) AS o_orderkey, c.o_orderstatus AS cur_status,
             c.valid_from, d.o_orderstatus AS new_status,
             c.o_orderkey IS NOT NULL AS has_cur, d.o_orderkey IS NOT NULL AS has_new
      FROM cur c FULL OUTER JOIN derived d ON c.o_orderkey = d.o_orderkey)
SELECT o_orderkey, cur_status AS o_orderstatus, valid_from, CAST(NULL AS DATE) AS valid_to, TRUE AS is_current
FROM j WHERE has_cur AND NOT (has_new AND cur_status IS DISTINCT FROM new_status)
UNION ALL
SELECT o_orderkey, cur_status, valid_from, DATE '{SCD2_EFFECTIVE}', FALSE
FROM j WHERE has_cur AND has_new AND cur_status IS DISTINCT FROM new_status
UNION ALL
SELECT o_orderkey, new_status, DATE '{SCD2_EFFECTIVE}', CAST(NULL AS DATE), TRUE
FROM j WHERE has_new AND (NOT has_cur OR cur_status IS DISTINCT FROM new_status)""",
)
def q_order_status_scd2(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    dim = model.scd2_initial(
        orders.select("o_orderkey", "o_orderstatus", "o_orderdate"), F.to_date("o_orderdate")
    ).drop("o_orderdate")
    incoming = model.derived_order_status(_t(spark, sf_dir, "lineitem"))
    return model.scd2_apply(dim, incoming, "o_orderkey", ["o_orderstatus"], SCD2_EFFECTIVE)


# --- data checks ----------------------------------------------------------------


@register(
    "orders_key_duplicates",
    "SELECT o_orderkey, COUNT(*) AS n FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1",
)
def q_orders_key_duplicates(spark, sf_dir):
    return quality.unique_violations(_t(spark, sf_dir, "orders"), "o_orderkey")


@register(
    "orders_null_counts",
    """SELECT 'o_orderkey' AS "column", COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS null_count FROM orders
UNION ALL SELECT 'o_custkey', COUNT(*) FILTER (WHERE o_custkey IS NULL) FROM orders
UNION ALL SELECT 'o_orderstatus', COUNT(*) FILTER (WHERE o_orderstatus IS NULL) FROM orders
UNION ALL SELECT 'o_totalprice', COUNT(*) FILTER (WHERE o_totalprice IS NULL) FROM orders
UNION ALL SELECT 'o_orderdate', COUNT(*) FILTER (WHERE o_orderdate IS NULL) FROM orders""",
)
def q_orders_null_counts(spark, sf_dir):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    return quality.null_counts(_t(spark, sf_dir, "orders"), cols)


@register(
    "orders_status_violations",
    "SELECT * FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')",
)
def q_orders_status_violations(spark, sf_dir):
    return quality.accepted_values_violations(_t(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O", "P"])


@register(
    "lineitem_order_orphans",
    """SELECT l_orderkey, COUNT(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
GROUP BY l_orderkey""",
)
def q_lineitem_order_orphans(spark, sf_dir):
    return quality.relationship_violations(
        _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"), "l_orderkey", "o_orderkey"
    )


@register(
    "lineitem_part_orphans",
    """SELECT l_partkey, COUNT(*) AS n_rows FROM lineitem
WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)
GROUP BY l_partkey""",
)
def q_lineitem_part_orphans(spark, sf_dir):
    return quality.relationship_violations(
        _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part"), "l_partkey", "p_partkey"
    )


@register("orders_negative_totals", "SELECT * FROM orders WHERE o_totalprice < 0")
def q_orders_negative_totals(spark, sf_dir):
    return quality.negative_violations(_t(spark, sf_dir, "orders"), "o_totalprice")


@register(
    "orders_future_dates",
    "SELECT * FROM orders WHERE o_orderdate > CAST(now() AS TIMESTAMP)",
)
def q_orders_future_dates(spark, sf_dir):
    return quality.future_violations(_t(spark, sf_dir, "orders"), "o_orderdate")


@register(
    "events_quarantine",
    """SELECT * FROM events
WHERE COALESCE(value < 0 OR TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL
               OR user_id IS NULL OR ts IS NULL, FALSE)""",
)
def q_events_quarantine(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    k = F.from_json("props", "k INT").getField("k")
    bad = (F.col("value") < 0) | k.isNull() | F.col("user_id").isNull() | F.col("ts").isNull()
    _, rejected = quality.quarantine(ev, bad)
    return rejected


# --- privacy --------------------------------------------------------------------


@register(
    "document_emails_masked",
    r"""SELECT doc_id, regexp_replace(email, '^.+@', '***@') AS email_masked
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS email
      FROM documents) t""",
)
def q_document_emails_masked(spark, sf_dir):
    return privacy.emails_in_text(_t(spark, sf_dir, "documents"))


@register(
    "customer_contacts_analyst_view",
    """SELECT c_custkey, c_name,
       regexp_replace(lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example',
                      '^.+@', '***@') AS email,
       CASE WHEN c_acctbal IS NOT NULL THEN '***' END AS c_acctbal
FROM customer""",
)
def q_customer_contacts_analyst_view(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer")
    contacts = cust.select(
        "c_custkey", "c_name", model.customer_email(cust).alias("email"), "c_acctbal"
    )
    return privacy.role_masked(contacts, "analyst", {"email": "email", "c_acctbal": "redact"})


@register(
    "events_after_erasure",
    """SELECT * FROM events
WHERE user_id IS NULL
   OR user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey IS NOT NULL)""",
)
def q_events_after_erasure(spark, sf_dir):
    subjects = _t(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    return privacy.erase_subjects(_t(spark, sf_dir, "events"), subjects, "user_id", "c_custkey")
