"""Registered queries of what grows batch by batch: change feeds, distinct loads, dimensions, streams, states, erasure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import safe_divide
from strata.operators import metrics, model, states
from strata.plans.catalog import register
from strata.plans.jobs import run_daily_increment, run_incremental_cycle, write_days
from strata.plans.oracle import with_raw
from strata.plans.queries_medallion import RAW_FLAT_SQL, flatten_raw
from strata.plans.queries_stored import TOTALS, _days, _folder, _ingested
from strata.sinks import dedupe_path, write_messages_text
from strata.sinks.dimension import apply_snapshot, read_dimension
from strata.sinks.distinct import append_distinct
from strata.sinks.subjects import erase_indexed, refresh_subjects
from strata.sources import lake
from strata.sources.driver_tables import events_as_raw, read_table
from strata.streaming.any_order import late_pairs, read_late, read_pairs, start_any_order_join
from strata.streaming.ingest import ingest
from strata.streaming.upsert import apply_changes_batch, compact_deletions


# --- change feed -------------------------------------------------------------------


@register(
    "order_status_delete_then_late",
    """SELECT o_orderkey AS order_id, if(o_orderkey % 3 = 0, 'late', o_orderstatus) AS status, o_orderdate::DATE AS order_date
FROM orders WHERE o_orderkey % 5 <> 0""",
)
def q_order_status_delete_then_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletions at version 3, then changes of version 2: before and after the deletion log is compacted."""
    path = _folder(spark, "feed") + "/target"
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.to_date("o_orderdate").alias("order_date"),
        F.year("o_orderdate").alias("order_year"),
    )
    by_five, by_three = F.col("order_id") % 5 == 0, F.col("order_id") % 3 == 0
    late = orders.withColumn("status", F.lit("late"))
    feed = [
        (orders, 1, False),
        (orders.filter(by_five), 3, True),
        (late.filter(by_five | by_three), 2, False),
        None,
        (late.filter(by_five).withColumn("order_year", F.lit(1900)), 2, False),  # moved as well
    ]
    apply = apply_changes_batch(spark, path, ["order_id"], ["version"], "order_year", delete_col="_deleted")
    for epoch, step in enumerate(feed):
        if step is None:
            compact_deletions(spark, path, ["order_id"], ["version"])
            continue
        rows, version, gone = step
        apply(rows.withColumns({"version": F.lit(version), "_deleted": F.lit(gone)}), epoch)
    return spark.read.parquet(path).select("order_id", "status", "order_date")


# --- distinct loads ----------------------------------------------------------------


@register("lake_loaded_three_times", with_raw(RAW_FLAT_SQL))
def q_lake_loaded_three_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads that overlap, one of them repeated and with rows twice: each row is there once."""
    path = _folder(spark, "distinct") + "/lake"
    raw = events_as_raw(spark, sf_dir)
    part = F.pmod(F.xxhash64("event_id"), F.lit(10))
    twice = raw.filter(part.between(4, 8)).unionByName(raw.filter(part == 5))
    loads = [("first", raw.filter(part < 6)), ("second", twice), ("second", twice), ("third", raw.filter(part >= 5))]
    for name, rows in loads:
        append_distinct(spark, path, rows, name)
    return flatten_raw(lake.read_raw(spark, path))


@register("lake_ingested_twice_deduped", with_raw(RAW_FLAT_SQL))
def q_lake_ingested_twice_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages ingested by two streams; the batch level takes no part in the comparison."""
    path = _ingested(spark, sf_dir)
    again = _folder(spark, "again")
    write_messages_text(events_as_raw(spark, sf_dir), f"{again}/landing")
    ingest(spark, path, f"{again}/ckpt", {"fmt": "files", "path": f"{again}/landing"})
    dedupe_path(spark, path)
    return flatten_raw(lake.read_raw(spark, path))


@register("lake_topic_delivered_twice", with_raw(RAW_FLAT_SQL))
def q_lake_topic_delivered_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages delivered again in a later batch, after a restart of the stream, land once."""
    base = _folder(spark, "once")
    for _ in range(2):
        write_messages_text(events_as_raw(spark, sf_dir), f"{base}/landing")
        ingest(spark, f"{base}/lake", f"{base}/ckpt", {"fmt": "files", "path": f"{base}/landing"}, once_within="1 day")
    return flatten_raw(lake.read_raw(spark, f"{base}/lake"))


@register("incremental_cycle_totals", with_raw(TOTALS))
def q_incremental_cycle_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cycles, the second with the rest of the events: totals of all."""
    base = _folder(spark, "cycle")
    raw = events_as_raw(spark, sf_dir)
    early = F.unix_date("event_date") < raw.select(F.percentile_approx(F.unix_date("event_date"), 0.8)).scalar()
    for rows in (raw.filter(early), raw.filter(~early)):
        write_messages_text(rows, f"{base}/landing")
        run_incremental_cycle(
            spark, {"fmt": "files", "path": f"{base}/landing"}, f"{base}/lake", f"{base}/ckpt", f"{base}/out", f"{base}/distinct"
        )
    return metrics.question_score_totals(lake.read_raw(spark, f"{base}/distinct")).join(
        spark.read.parquet(f"{base}/out/question_score_totals"), ["question_id", "total"], "left_semi"
    )


# --- dimension ---------------------------------------------------------------------

_SNAPSHOTS = ("2024-01-01", "2024-02-01", "2024-03-01")


@register(
    "order_status_dimension",
    f"""WITH derived AS (
    SELECT l_orderkey, if(min(l_linestatus) = max(l_linestatus), min(l_linestatus), 'P') AS status FROM lineitem GROUP BY ALL
),
named AS (SELECT o_orderkey AS order_id, o_orderstatus AS first, coalesce(status, o_orderstatus) AS second
    FROM orders LEFT JOIN derived ON l_orderkey = o_orderkey),
seen AS (
    SELECT order_id, first AS status, DATE '{_SNAPSHOTS[0]}' AS seen_on FROM named WHERE order_id % 10 <> 0
    UNION ALL SELECT order_id, second, DATE '{_SNAPSHOTS[1]}' FROM named
    UNION ALL SELECT order_id, if(order_id % 2 = 0, 'X', second), DATE '{_SNAPSHOTS[2]}' FROM named WHERE order_id % 7 <> 0
),
opened AS (SELECT * FROM seen QUALIFY lag(status) OVER (PARTITION BY order_id ORDER BY seen_on) IS DISTINCT FROM status)
SELECT order_id, status, seen_on AS valid_from, lead(seen_on) OVER w AS valid_to, lead(seen_on) OVER w IS NULL AS is_current
FROM opened WINDOW w AS (PARTITION BY order_id ORDER BY seen_on)""",
)
def q_order_status_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots in a row, the second applied twice: only buckets with changes are written."""
    base = _folder(spark, "dimension")
    path = f"{base}/versions"
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("first"))
    derived = model.derived_order_status(read_table(spark, sf_dir, "lineitem"))
    named = orders.join(derived, orders.order_id == derived.o_orderkey, "left")
    named.select("order_id", "first", F.coalesce("o_orderstatus", "first").alias("second")).write.parquet(f"{base}/named")
    named = spark.read.parquet(f"{base}/named")  # all snapshots come from it
    snapshots = [
        named.filter("order_id % 10 <> 0").select("order_id", F.col("first").alias("status")),
        named.select("order_id", F.col("second").alias("status")),
        named.filter("order_id % 7 <> 0").select("order_id", F.expr("if(order_id % 2 = 0, 'X', second) AS status")),
    ]
    for k in (0, 1, 1, 2):
        apply_snapshot(spark, path, snapshots[k], "order_id", ["status"], _SNAPSHOTS[k])
    return read_dimension(spark, path)


# --- streams in any order ------------------------------------------------------------


@register(
    "stream_join_any_order",
    """SELECT o.o_orderkey AS order_id, o.o_orderdate AS order_ts, l.l_linenumber,
       l.l_shipdate AS update_ts, l.l_linestatus AS status
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_shipdate >= o.o_orderdate AND l.l_shipdate <= o.o_orderdate + INTERVAL 60 DAY""",
)
def q_stream_join_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches in which lines come before their orders and old rows after new ones.

    The pairs found, and those that the recorded late rows add, are the join of all rows.
    """
    base = _folder(spark, "anyorder")
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("order_ts")
    )
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        "l_linenumber",
        F.col("l_shipdate").cast("timestamp").alias("update_ts"),
        F.col("l_linestatus").alias("status"),
    )
    bound = {"key": "order_id", "left_ts": "order_ts", "right_ts": "update_ts", "within": "60 days"}
    for k in range(3):
        orders.filter(F.col("order_id") % 3 == k).write.mode("append").parquet(f"{base}/orders")
        lines.filter((F.col("order_id") + F.col("l_linenumber")) % 3 == 2 - k).write.mode("append").parquet(f"{base}/lines")
        streams = [spark.readStream.schema(df.schema).parquet(f"{base}/{n}") for df, n in ((orders, "orders"), (lines, "lines"))]
        query = start_any_order_join(*streams, f"{base}/joined", f"{base}/ckpt", lateness="1500 days", unit="year", **bound)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    late = late_pairs(read_late(spark, f"{base}/joined"), orders, lines, **bound)
    found = read_pairs(spark, f"{base}/joined").unionByName(late)
    times = [F.col(c).cast("timestamp_ntz").alias(n) for c, n in (("l.order_ts", "order_ts"), ("r.update_ts", "update_ts"))]
    return found.select(F.col("l.order_id"), *times, F.col("r.l_linenumber"), F.col("r.status"))


# --- mergeable states ----------------------------------------------------------------


def _stored_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value states per day, hour and type, stored in two increments that overlap."""
    path = _folder(spark, "states")
    events = read_table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    days = _days(events)
    for dates in (days[: 2 * len(days) // 3], days[len(days) // 3 :]):
        rows = events.filter(F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))
        keys = ["event_date", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type"]
        write_days(states.value_states(rows, keys, "value", "user_id"), path, dates)
    return spark.read.parquet(path)


@register(
    "states_hourly_summary",
    """SELECT date_trunc('hour', ts) AS hour, count(*) AS event_count, sum(value::DECIMAL(18,2))::DOUBLE AS total_value,
       sum(value::DECIMAL(18,2))::DOUBLE / count(*)::DOUBLE AS avg_value
FROM events GROUP BY 1""",
)
def q_states_hourly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = states.merge_states(_stored_states(spark, sf_dir), ["hour"])
    total = F.col("total").cast("double")
    return merged.select("hour", F.col("n").alias("event_count"), total.alias("total_value"), safe_divide(total, F.col("n")).alias("avg_value"))


@register(
    "states_monthly_totals",
    """SELECT event_type, date_trunc('month', ts)::DATE AS month, count(*) AS event_count,
       sum(value::DECIMAL(18,2))::DOUBLE AS total_value, min(value::DECIMAL(18,2))::DOUBLE AS least, max(value::DECIMAL(18,2))::DOUBLE AS largest
FROM events GROUP BY 1, 2""",
)
def q_states_monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc("event_date", "month").alias("month")
    merged = states.merge_states(_stored_states(spark, sf_dir), ["event_type", month])
    money = [F.col(c).cast("double").alias(name) for c, name in (("total", "total_value"), ("least", "least"), ("largest", "largest"))]
    return merged.select("event_type", "month", F.col("n").alias("event_count"), *money)


@register(
    "states_value_outliers",
    """SELECT * FROM events
WHERE value > (SELECT avg(value::DECIMAL(18,2)::DOUBLE) + 2 * stddev_samp(value::DECIMAL(18,2)::DOUBLE) FROM events)""",
)
def q_states_value_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    threshold = states.outlier_threshold(_stored_states(spark, sf_dir), 2.0)
    return read_table(spark, sf_dir, "events").filter(F.col("value") > threshold)


@register(
    "active_users_sketched",
    "SELECT ts::DATE AS event_date, count(DISTINCT user_id) AS active_users, true AS within_five_percent FROM events GROUP BY 1",
)
def q_active_users_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly sketches merged per day, beside the exact count: three standard errors are 4.9 %."""
    merged = states.merge_states(_stored_states(spark, sf_dir), ["event_date"])
    estimate = merged.select(F.col("event_date").alias("day"), states.distinct_estimate().alias("estimate"))
    events = read_table(spark, sf_dir, "events")
    exact = events.groupBy(F.to_date("ts").alias("event_date")).agg(F.count_distinct("user_id").alias("active_users"))
    near = F.abs(F.col("estimate") - F.col("active_users")) <= 0.05 * F.col("active_users")
    both = exact.join(estimate, F.col("event_date").eqNullSafe(F.col("day")))
    return both.select("event_date", "active_users", near.alias("within_five_percent"))


# --- erasure -------------------------------------------------------------------------

_NOT_ERASED = """(user_id IS NULL OR user_id NOT IN (SELECT c_custkey::VARCHAR FROM customer WHERE c_acctbal < -500))"""


def _erased(spark: SparkSession, sf_dir: str, outputs: bool) -> str:
    """A lake, and its daily outputs if wanted, from which the subjects are erased by the index; their folder."""
    base = _folder(spark, "erase")
    raw = events_as_raw(spark, sf_dir)
    raw.write.partitionBy("event_date").parquet(f"{base}/lake")
    if outputs:
        run_daily_increment(spark, f"{base}/lake", f"{base}/out", _days(raw))
    refresh_subjects(spark, f"{base}/lake", "user_id")
    subjects = read_table(spark, sf_dir, "customer").filter("c_acctbal < -500").select("c_custkey")
    days = erase_indexed(spark, f"{base}/lake", subjects, "user_id")
    if days and outputs:
        run_daily_increment(spark, f"{base}/lake", f"{base}/out", days)
    return base


@register("lake_subjects_erased", with_raw(f"{RAW_FLAT_SQL} WHERE {_NOT_ERASED}"))
def q_lake_subjects_erased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_raw(lake.read_raw(spark, f"{_erased(spark, sf_dir, outputs=False)}/lake"))


@register(
    "outputs_after_erasure",
    with_raw(
        f"""SELECT event_date, 'type ' || event_type AS what, count(*) AS n FROM kept GROUP BY ALL
UNION ALL SELECT event_date, 'region ' || region, count(*) FROM kept GROUP BY ALL
UNION ALL SELECT NULL, 'question ' || question_id, sum(coalesce(score, 0))::BIGINT FROM kept GROUP BY question_id""",
        f"kept AS (SELECT * FROM raw WHERE {_NOT_ERASED})",
    ),
)
def q_outputs_after_erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{_erased(spark, sf_dir, outputs=True)}/out"

    def rows(name: str, day, what: str, column: str, n: str) -> DataFrame:
        return spark.read.parquet(f"{out}/{name}").select(
            day.alias("event_date"), F.concat(F.lit(f"{what} "), F.col(column)).alias("what"), F.col(n).alias("n")
        )

    day = F.col("event_date")
    types = rows("events_by_type_daily", day, "type", "event_type", "event_count")
    regions = rows("region_distribution", day, "region", "region", "event_count")
    totals = rows("question_score_totals", F.lit(None).cast("date"), "question", "question_id", "total")
    return types.unionByName(regions).unionByName(totals)
