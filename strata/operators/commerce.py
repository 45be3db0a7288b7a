"""Commerce reporting: sales summaries, rankings, pivots, drill-downs, KPIs.

Money is summed as DECIMAL(18,2) (exact, order-independent) and cast to
double at the end. Where a large fact meets a dimension only to be grouped
by a dimension attribute, the fact is first aggregated on the join key (a
map-side-combined hash aggregate), so the join and the final grouping see
one row per key instead of one per fact row. Catalyst does not push
aggregates below joins by itself.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import revenue_tier, safe_divide
from strata.functions.constants import DEFAULT_REGION


#: Decimal places of money. Amounts with more are rounded before they are summed: check a new
#: source with ``quality.scale_violations`` first.
MONEY_SCALE = 2


def money(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(f"decimal(18,{scale})")


def net_amount(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """price * (1 - discount), exact in decimal."""
    return money(price) * (F.lit(1) - F.col(discount).cast("decimal(4,2)"))


def _to_double(c: Column) -> Column:
    return c.cast("double")


# --- time series ------------------------------------------------------------


def hourly_summary(df: DataFrame, ts_col: str = "ts", amount_col: str = "value") -> DataFrame:
    """(hour, event_count, total_value, avg_value) per clock hour."""
    hour = F.date_trunc("hour", F.col(ts_col)).cast("timestamp_ntz").alias("hour")
    agg = df.groupBy(hour).agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(money(amount_col)).alias("_total")
    )
    return agg.select(
        "hour",
        "event_count",
        _to_double(F.col("_total")).alias("total_value"),
        safe_divide(_to_double(F.col("_total")), F.col("event_count")).alias("avg_value"),
    )


def daily_orders(orders: DataFrame) -> DataFrame:
    """(order_date, order_count, revenue) per day."""
    agg = orders.groupBy(F.to_date("o_orderdate").alias("order_date")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(money("o_totalprice")).alias("_rev")
    )
    return agg.select("order_date", "order_count", _to_double(F.col("_rev")).alias("revenue"))


def ytd_revenue(orders: DataFrame) -> DataFrame:
    """(order_date, revenue, ytd_revenue): running revenue within each year.

    Aggregated to one row per day first; the window is partitioned by year,
    so a partition holds at most 366 rows.
    """
    daily = orders.groupBy(F.to_date("o_orderdate").alias("order_date")).agg(
        F.sum(money("o_totalprice")).alias("_rev")
    )
    w = (
        Window.partitionBy(F.year("order_date"))
        .orderBy("order_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.select(
        "order_date",
        _to_double(F.col("_rev")).alias("revenue"),
        _to_double(F.sum("_rev").over(w)).alias("ytd_revenue"),
    )


# --- engagement over events ---------------------------------------------------


def hourly_engagement(events: DataFrame, ts_col: str = "ts", user_col: str = "user_id") -> DataFrame:
    """(hour, event_count, active_users) per clock hour (exact distinct users)."""
    hour = F.date_trunc("hour", F.col(ts_col)).cast("timestamp_ntz").alias("hour")
    return events.groupBy(hour).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct(F.col(user_col)).alias("active_users"),
    )


# Segment bands by events per user (our choice of cut points).
SEGMENT_BANDS = (("light", 50), ("regular", 100))
SEGMENT_TOP = "heavy"


def user_segments(events: DataFrame, user_col: str = "user_id") -> DataFrame:
    """(segment, user_count, event_count): users banded by their event count."""
    per_user = events.groupBy(user_col).agg(F.count(F.lit(1)).alias("n"))
    seg = None
    for name, below in SEGMENT_BANDS:
        seg = (F.when if seg is None else seg.when)(F.col("n") < below, F.lit(name))
    seg = seg.otherwise(F.lit(SEGMENT_TOP))
    return per_user.groupBy(seg.alias("segment")).agg(
        F.count(F.lit(1)).alias("user_count"), F.sum("n").alias("event_count")
    )


def hourly_anomalies(events: DataFrame, ts_col: str = "ts", z: float = 2.0) -> DataFrame:
    """Hours whose event count is more than ``z`` sample deviations from the mean.

    Mean and deviation come from scalar subqueries over the hourly counts
    (one row each), not from a join.
    """
    hourly = events.groupBy(
        F.date_trunc("hour", F.col(ts_col)).cast("timestamp_ntz").alias("hour")
    ).agg(F.count(F.lit(1)).alias("event_count"))
    mean = hourly.select(F.avg("event_count")).scalar()
    sd = hourly.select(F.stddev_samp("event_count")).scalar()
    zscore = F.try_divide(F.col("event_count") - mean, sd)
    return hourly.withColumn("z_score", zscore).filter(F.abs(F.col("z_score")) > z)


def value_outliers(df: DataFrame, value_col: str = "value", k: float = 2.0) -> DataFrame:
    """Rows with value > mean + k * stddev_samp (scalar subquery, pushed to the scan)."""
    threshold = df.select(F.avg(value_col) + F.lit(k) * F.stddev_samp(value_col)).scalar()
    return df.filter(F.col(value_col) > threshold)


def revenue_tiers(df: DataFrame, amount_col: str = "value") -> DataFrame:
    """(tier, row_count, total_value) by the Low / Medium / High tier of the amount."""
    agg = df.groupBy(revenue_tier(amount_col).alias("tier")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(money(amount_col)).alias("_total")
    )
    return agg.select("tier", "row_count", _to_double(F.col("_total")).alias("total_value"))


# --- orders ------------------------------------------------------------------


def order_totals(orders: DataFrame) -> DataFrame:
    """One row: order_count, revenue, avg_order_value."""
    agg = orders.agg(F.count(F.lit(1)).alias("order_count"), F.sum(money("o_totalprice")).alias("_rev"))
    return agg.select(
        "order_count",
        _to_double(F.col("_rev")).alias("revenue"),
        safe_divide(_to_double(F.col("_rev")), F.col("order_count")).alias("avg_order_value"),
    )


def yearly_kpis(orders: DataFrame, cancelled_status: str = "F") -> DataFrame:
    """(order_year, order_count, revenue, avg_order_value, cancellation_rate_pct)."""
    agg = orders.groupBy(F.year("o_orderdate").alias("order_year")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(money("o_totalprice")).alias("_rev"),
        F.count_if(F.col("o_orderstatus") == cancelled_status).alias("_cancelled"),
    )
    return agg.select(
        "order_year",
        "order_count",
        _to_double(F.col("_rev")).alias("revenue"),
        safe_divide(_to_double(F.col("_rev")), F.col("order_count")).alias("avg_order_value"),
        safe_divide(F.col("_cancelled").cast("double") * 100, F.col("order_count")).alias(
            "cancellation_rate_pct"
        ),
    )


def status_pivot(orders: DataFrame, statuses: Iterable[str] = ("F", "O", "P")) -> DataFrame:
    """(order_year, status_<s>..., status_other, total) order counts; one pass, no status is lost."""
    statuses = list(statuses)
    s = F.col("o_orderstatus")
    return orders.groupBy(F.year("o_orderdate").alias("order_year")).agg(
        *[F.count_if(s == v).alias(f"status_{v}") for v in statuses],
        F.count_if(s.isNull() | ~s.isin(statuses)).alias("status_other"),
        F.count(F.lit(1)).alias("total"),
    )


def regional_revenue(orders: DataFrame, customer_regions: DataFrame) -> DataFrame:
    """(region, order_count, revenue): orders joined to the customer's region.

    Orders are reduced to one row per customer before the join.
    """
    per_cust = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(money("o_totalprice")).alias("_rev")
    )
    joined = per_cust.join(customer_regions, per_cust.o_custkey == customer_regions.c_custkey, "left")
    region = F.coalesce(F.col("r_name"), F.lit(DEFAULT_REGION)).alias("region")
    agg = joined.groupBy(region).agg(F.sum("_n").alias("order_count"), F.sum("_rev").alias("_rev"))
    return agg.select("region", "order_count", _to_double(F.col("_rev")).alias("revenue"))


def orders_by_region_status(orders: DataFrame, customer_regions: DataFrame) -> DataFrame:
    """(region, order_status, order_count, revenue)."""
    per_cust = orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(money("o_totalprice")).alias("_rev")
    )
    joined = per_cust.join(customer_regions, per_cust.o_custkey == customer_regions.c_custkey, "left")
    region = F.coalesce(F.col("r_name"), F.lit(DEFAULT_REGION)).alias("region")
    agg = joined.groupBy(region, F.col("o_orderstatus").alias("order_status")).agg(
        F.sum("_n").alias("order_count"), F.sum("_rev").alias("_rev")
    )
    return agg.select("region", "order_status", "order_count", _to_double(F.col("_rev")).alias("revenue"))


def filter_orders(
    orders: DataFrame,
    start: str | None = None,
    end: str | None = None,
    statuses: Iterable[str] | None = None,
    regions: Iterable[str] | None = None,
    customer_regions: DataFrame | None = None,
    categories: Iterable[str] | None = None,
    lineitem: DataFrame | None = None,
    part: DataFrame | None = None,
) -> DataFrame:
    """Orders within [start, end) of order date, with given statuses, regions and product categories.

    Date and status predicates reach the Parquet scan as pushed filters. A
    region filter is a semi join against the (filtered) customer regions; a
    category filter keeps orders with at least one line of such a product
    (brand plays category), by semi joins from the filtered products up.
    """
    out = orders
    if start is not None:
        out = out.filter(F.col("o_orderdate") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        out = out.filter(F.col("o_orderdate") < F.lit(end).cast("timestamp_ntz"))
    if statuses is not None:
        out = out.filter(F.col("o_orderstatus").isin(list(statuses)))
    if regions is not None:
        if customer_regions is None:
            raise ValueError("a region filter needs customer_regions")
        keep = customer_regions.filter(F.col("r_name").isin(list(regions))).select("c_custkey")
        out = out.join(keep, out.o_custkey == keep.c_custkey, "left_semi")
    if categories is not None:
        if lineitem is None or part is None:
            raise ValueError("a category filter needs lineitem and part")
        wanted = part.filter(F.col("p_brand").isin(list(categories))).select("p_partkey")
        lines = lineitem.select("l_orderkey", "l_partkey")
        lines = lines.join(wanted, lines.l_partkey == wanted.p_partkey, "left_semi")
        out = out.join(lines, out.o_orderkey == lines.l_orderkey, "left_semi")
    return out


# --- products ---------------------------------------------------------------


def top_products(lineitem: DataFrame, part: DataFrame, n: int = 10) -> DataFrame:
    """(rank, product_id, product_name, total_quantity): the n best sellers by quantity.

    Global top-n is ``orderBy.limit`` (each task keeps n rows, then one merge),
    and only those n rows are joined to the product names.
    """
    totals = lineitem.groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.sum(money("l_quantity")).alias("_qty")
    )
    top = totals.orderBy(F.col("_qty").desc(), F.col("product_id").asc()).limit(n)
    names = part.select(F.col("p_partkey"), F.col("p_name").alias("product_name"))
    joined = top.join(names, top.product_id == names.p_partkey, "left")
    w = Window.orderBy(F.col("_qty").desc(), F.col("product_id").asc())
    return joined.select(
        F.row_number().over(w).alias("rank"),
        "product_id",
        "product_name",
        _to_double(F.col("_qty")).alias("total_quantity"),
    )


def product_revenue(
    lineitem: DataFrame, orders: DataFrame, excluded_status: str = "F"
) -> DataFrame:
    """(product_id, revenue): net revenue per product over orders not in ``excluded_status``.

    A semi join keeps the line items of kept orders; only the order keys of
    the orders side are shuffled.
    """
    kept = orders.filter(F.col("o_orderstatus") != excluded_status).select("o_orderkey")
    lines = lineitem.join(kept, lineitem.l_orderkey == kept.o_orderkey, "left_semi")
    agg = lines.groupBy(F.col("l_partkey").alias("product_id")).agg(F.sum(net_amount()).alias("_rev"))
    return agg.select("product_id", _to_double(F.col("_rev")).alias("revenue"))


def category_drilldown(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Revenue by rollup(category, product_type) with the grouping level.

    (category, product_type, grouping_level, quantity, revenue); level 0 is a
    (category, type) cell, 1 a category subtotal, 3 the grand total. Line
    items are summed per part before the join, so the rollup sees one row per
    part.
    """
    per_part = lineitem.groupBy("l_partkey").agg(
        F.sum(money("l_quantity")).alias("_qty"), F.sum(net_amount()).alias("_rev")
    )
    joined = per_part.join(
        part.select("p_partkey", "p_brand", "p_type"),
        per_part.l_partkey == part.p_partkey,
        "left",
    )
    agg = joined.rollup(F.col("p_brand").alias("category"), F.col("p_type").alias("product_type")).agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        F.sum("_qty").alias("_qty"),
        F.sum("_rev").alias("_rev"),
    )
    return agg.select(
        "category",
        "product_type",
        "grouping_level",
        _to_double(F.col("_qty")).alias("quantity"),
        _to_double(F.col("_rev")).alias("revenue"),
    )
