"""A key holding a third of all rows: the plans must split or pre-reduce it."""

import os

from pyspark.sql import functions as F

from strata.operators import medallion, metrics
from strata.sources.driver_tables import events_as_raw

SF = "/root/testdata/sf0.01"


def _skewed_events(spark, scratch):
    """events with a third of all rows moved to user 7 (and to one question)."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    hot = F.col("event_id") % 3 == 0
    skewed = ev.withColumn("user_id", F.when(hot, F.lit(7)).otherwise(F.col("user_id")))
    folder = os.path.join(scratch, "skewed")
    os.makedirs(folder)
    for t in ("customer", "nation", "region"):
        os.symlink(f"{SF}/{t}.parquet", os.path.join(folder, f"{t}.parquet"))
    skewed.repartition(8).write.parquet(os.path.join(folder, "events.parquet"))
    return folder


def test_hot_user_join_is_split(spark, scratch):
    folder = _skewed_events(spark, scratch)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = metrics.region_distribution(events_as_raw(spark, folder))
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        # the hot user's shuffle partition is split across several tasks
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
        assert sum(r.event_count for r in rows) == 10000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_question_shuffles_one_row_per_task(spark, scratch):
    raw = events_as_raw(spark, SF, with_region=False)
    hot = raw.withColumn(
        "payload",
        F.col("payload").withField(
            "question_id", F.when(F.col("event_id").cast("long") % 3 == 0, F.lit(1)).otherwise(F.col("payload.question_id"))
        ),
    )
    clean = medallion.clean_silver(medallion.to_silver(hot))
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert clean.filter(F.col("question_id") == "1").count() == 1
