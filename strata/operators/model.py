"""Dimensional model: staging, dimensions, fact, date spine, SCD2, change capture.

TPC-H keys are already integer surrogate keys, so dimensions keep them as
their keys and the fact needs no dimension lookups to obtain keys (no join
per dimension). ``strata.functions.surrogate_key`` (a 64-bit hash) is there
for natural keys that are text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import mask_email
from strata.operators.commerce import money, net_amount

CHANGE_INSERT = "insert"
CHANGE_DELETE = "delete"
CHANGE_UPDATE = "update"


# --- staging -----------------------------------------------------------------


def stage_orders(orders: DataFrame) -> DataFrame:
    """Typed, renamed orders; null keys dropped, one row per order id.

    When an order id repeats, the latest order time wins, then the higher
    total, then status, customer and priority, so the pick is deterministic. ``row_number() = 1`` is
    planned with a partial group limit before the shuffle.
    """
    typed = orders.select(
        F.col("o_orderkey").cast("long").alias("order_id"),
        F.col("o_custkey").cast("long").alias("customer_id"),
        F.upper(F.trim(F.col("o_orderstatus"))).alias("order_status"),
        money("o_totalprice").cast("double").alias("total_amount"),
        F.col("o_orderdate").alias("order_ts"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("order_priority"),
    ).filter(F.col("order_id").isNotNull())
    w = Window.partitionBy("order_id").orderBy(
        F.col("order_ts").desc_nulls_last(),
        F.col("total_amount").desc_nulls_last(),
        F.col("order_status").asc_nulls_last(),
        F.col("customer_id").asc_nulls_last(),
        F.col("order_priority").asc_nulls_last(),
    )
    return typed.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# --- dimensions ----------------------------------------------------------------


def dim_products(part: DataFrame) -> DataFrame:
    """(product_key, product_id, product_name, category); brand plays category."""
    return part.select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("category"),
    ).distinct()


def dim_regions(nation: DataFrame, region: DataFrame) -> DataFrame:
    """(region_key, region_code, region_name, country, timezone) at nation grain.

    Both inputs are fixed-size reference tables (25 and 5 rows).
    """
    j = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return j.select(
        F.col("n_nationkey").alias("region_key"),
        F.upper(F.regexp_replace(F.col("r_name"), " ", "_")).alias("region_code"),
        F.col("r_name").alias("region_name"),
        F.col("n_name").alias("country"),
        F.lit("UTC").alias("timezone"),
    )


def customer_email(customer: DataFrame) -> Column:
    """A contact address derived from the customer row (the tables carry none)."""
    return F.concat(
        F.lower(F.regexp_replace(F.col("c_name"), "#", ".")),
        F.lit("@"),
        F.lower(F.col("c_mktsegment")),
        F.lit(".example"),
    )


def dim_customers(customer: DataFrame) -> DataFrame:
    """(customer_key, customer_id, email_masked): the address keeps only its domain."""
    return customer.select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("customer_id"),
        mask_email(customer_email(customer)).alias("email_masked"),
    )


def date_key(d: Column) -> Column:
    """yyyymmdd as int."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def dim_date(dates: DataFrame, date_col: str) -> DataFrame:
    """A gap-free date spine from the minimum to the maximum of ``date_col``.

    (date_key, full_date, year, quarter, month, day, day_of_week with
    Monday = 1). The spine length is the number of calendar days covered, not
    the number of input rows; the range comes from a one-row aggregate.
    """
    bounds = dates.agg(
        F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi")
    )
    spine = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    d = F.col("full_date")
    return spine.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
    )


def fact_orders(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per order line with dimension keys, quantity and revenue.

    (order_key, line_number, product_key, customer_key, region_key, quantity,
    revenue, net_revenue, order_date_key). ``revenue`` is quantity times unit
    price (the extended price of the line), ``net_revenue`` less its discount. Orders are joined to customers first (orders
    are the smaller fact), then line items to that; both are equi-joins that
    shuffle on their keys unless adaptive execution finds a side small.
    """
    cust = customer.select("c_custkey", "c_nationkey")
    ord_ = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    ord_cust = ord_.join(cust, ord_.o_custkey == cust.c_custkey, "left")
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    j = lines.join(ord_cust, lines.l_orderkey == ord_cust.o_orderkey, "left")
    return j.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_key"),
        F.col("o_custkey").alias("customer_key"),
        F.col("c_nationkey").alias("region_key"),
        F.col("l_quantity").alias("quantity"),
        money("l_extendedprice").cast("double").alias("revenue"),
        net_amount().cast("double").alias("net_revenue"),
        date_key(F.to_date("o_orderdate")).alias("order_date_key"),
    )


def order_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items with their order's customer and date.

    On tables bucketed by the order key with one number of buckets
    (``sinks.write_bucketed``) neither side is shuffled.
    """
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    ord_ = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(ord_, lines.l_orderkey == ord_.o_orderkey, "left")


# --- change capture and SCD2 -------------------------------------------------------


def derived_order_status(lineitem: DataFrame) -> DataFrame:
    """(o_orderkey, o_orderstatus) recomputed from line statuses.

    F when every line is F, O when every line is O, P otherwise; a partial +
    final aggregate per order.
    """
    agg = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("l_linestatus") == "F").alias("_f"),
        F.count_if(F.col("l_linestatus") == "O").alias("_o"),
    )
    status = (
        F.when(F.col("_f") == F.col("_n"), F.lit("F"))
        .when(F.col("_o") == F.col("_n"), F.lit("O"))
        .otherwise(F.lit("P"))
    )
    return agg.select("o_orderkey", status.alias("o_orderstatus"))


def _sides(left: DataFrame, right: DataFrame, keys: list[str], left_cols: list[str], right_cols: list[str]) -> DataFrame:
    """One row per key of either frame: ``l`` and ``r`` are structs of its columns, null where it has no row.

    A union and one aggregate instead of a full outer join: null keys are one
    key, a key that repeats (null or hot) is combined before the shuffle, and
    of several rows of one side the largest by its columns counts (``n_l``,
    ``n_r`` say how many there were).
    """
    def tagged(df: DataFrame, own: str, cols: list[str], other: str, like: DataFrame, other_cols: list[str]) -> DataFrame:
        empty = F.lit(None).cast(like.select(F.struct(*other_cols).alias("x")).schema["x"].dataType)
        return df.select(*keys, F.struct(*cols).alias(own), empty.alias(other))

    rows = tagged(left, "l", left_cols, "r", right, right_cols).unionByName(
        tagged(right, "r", right_cols, "l", left, left_cols)
    )
    return rows.groupBy(*keys).agg(
        F.max("l").alias("l"), F.max("r").alias("r"), F.count("l").alias("n_l"), F.count("r").alias("n_r")
    )


def capture_changes(
    before: DataFrame, after: DataFrame, keys: str | Iterable[str], compare: Iterable[str]
) -> DataFrame:
    """Row-level diff of two snapshots keyed by ``keys``.

    Output: keys, ``change_type`` (insert / delete / update) and for each
    compared column ``<c>_before`` and ``<c>_after``. Unchanged keys are
    dropped. Keys and values are compared null-safely; of several rows of one
    key in a snapshot the largest by the compared columns counts.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    compare = list(compare)
    both = _sides(before, after, keys, compare, compare)
    kind = (
        F.when(F.col("l").isNull(), F.lit(CHANGE_INSERT))
        .when(F.col("r").isNull(), F.lit(CHANGE_DELETE))
        .when(~F.col("l").eqNullSafe(F.col("r")), F.lit(CHANGE_UPDATE))
    )
    pairs = [F.col(f"{side}.{c}").alias(f"{c}_{name}") for c in compare for side, name in (("l", "before"), ("r", "after"))]
    return both.withColumn("change_type", kind).filter("change_type IS NOT NULL").select(*keys, "change_type", *pairs)


def scd2_initial(snapshot: DataFrame, valid_from: Column) -> DataFrame:
    """Open one current version per row: valid_from, valid_to = null, is_current."""
    return snapshot.select(
        "*",
        valid_from.cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_apply(
    dim: DataFrame,
    incoming: DataFrame,
    keys: str | Iterable[str],
    tracked: Iterable[str],
    effective_date: str,
    close_missing: bool = False,
) -> DataFrame:
    """Apply a snapshot to a type-2 dimension; returns the whole new dimension.

    A key whose tracked values changed gets its current version closed
    (valid_to = effective date, is_current = false) and a new current
    version opened from the effective date. New keys open a version. Keys
    missing from ``incoming`` stay open unless ``close_missing``. History rows
    pass through untouched. One aggregate over the current versions and the
    snapshot, then unions (no further shuffle). A null key is a key like any
    other. Of several snapshot rows of one key the largest by the tracked
    columns counts; a dimension with two current versions of one key is an
    error. Parquet has no MERGE: write the result to a new location
    (``strata.sinks``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    tracked = list(tracked)
    eff = F.lit(effective_date).cast("date")
    attrs = keys + tracked
    history = dim.filter(~F.col("is_current"))
    current = dim.filter(F.col("is_current"))
    both = _sides(current, incoming, keys, ["valid_from", *tracked], tracked)
    once = F.when(F.col("n_l") > 1, F.raise_error(F.lit("a key has several current versions")).cast("boolean")).otherwise(True)
    j = both.filter(once)
    changed = ~F.struct(*[F.col(f"l.{c}").alias(c) for c in tracked]).eqNullSafe(F.col("r"))
    has_cur, has_new = F.col("l").isNotNull(), F.col("r").isNotNull()
    close = has_cur & ((has_new & changed) | (~has_new & F.lit(close_missing)))
    open_new = has_new & (~has_cur | changed)

    def version(side: str, valid_from: Column, valid_to: Column, is_current: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in tracked],
            valid_from.cast("date").alias("valid_from"),
            valid_to.cast("date").alias("valid_to"),
            is_current.alias("is_current"),
        )

    # One pass over the joined rows: each key yields its current version
    # (kept open or closed) and, when it changed or is new, an opened one.
    current_version = F.when(
        has_cur,
        version(
            "l",
            F.col("l.valid_from"),
            F.when(close, eff),
            ~close,
        ),
    )
    opened_version = F.when(open_new, version("r", eff, F.lit(None), F.lit(True)))
    versions = F.filter(F.array(current_version, opened_version), lambda v: v.isNotNull())
    out = j.select(*keys, F.explode(versions).alias("_v")).select(*keys, "_v.*")
    cols = attrs + ["valid_from", "valid_to", "is_current"]
    return history.select(*cols).unionByName(out.select(*cols))
