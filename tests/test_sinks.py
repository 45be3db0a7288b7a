import os

import pytest
from pyspark.sql import functions as F

from strata import sinks
from strata.operators import metrics, quality
from strata.sinks import files, swap
from strata.sources import lake
from strata.sources.driver_tables import events_as_raw

SF = "/root/testdata/sf0.001"


def test_text_roundtrip_equals_parquet(spark, scratch):
    totals = metrics.question_score_totals(events_as_raw(spark, SF, with_region=False))
    extra = spark.createDataFrame([(-1, -7)], "question_id long, total long")
    totals = totals.unionByName(extra)
    path = os.path.join(scratch, "totals_text")
    sinks.write_score_totals_text(totals, path)
    sinks.write_score_totals_text(totals, path)  # overwrite is idempotent
    back = lake.read_score_totals_text(spark, path)
    assert back.exceptAll(totals).count() == 0 and totals.exceptAll(back).count() == 0


def test_parse_rejects_junk_lines(spark):
    lines = spark.createDataFrame([("(1, 2)",), ("(3, -4)",), ("__import__('os')",)], "value string")
    rows = lake.parse_score_totals_text(lines).collect()
    assert [(r.question_id, r.total) for r in rows] == [(1, 2), (3, -4), (None, None)]


def test_self_overwrite_through_staging(spark, scratch):
    path = os.path.join(scratch, "bronze")
    raw = events_as_raw(spark, SF, with_region=False)
    sinks.write_output(raw.unionByName(raw), path, partition_by="event_date")
    out = sinks.dedupe_path(spark, path, partition_by="event_date")
    assert out.count() == 1000
    assert spark.read.parquet(path).count() == 1000
    assert not os.path.exists(path + "._staging")


def test_replace_table_from_itself(spark):
    sinks.ensure_layers(spark, ["t2_bronze"])
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    sinks.replace_table(spark, df, "t2_bronze.t")
    out = sinks.replace_table(spark, spark.table("t2_bronze.t").distinct(), "t2_bronze.t")
    assert sorted(r.k for r in out.collect()) == [1, 2]


def test_bucketed_tables_join_without_exchange(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    spark.sql("CREATE DATABASE IF NOT EXISTS t3")
    o = sinks.write_bucketed(orders, "t3.orders_b", 4, "o_orderkey", sort_by="o_orderkey")
    li = sinks.write_bucketed(lineitem, "t3.lineitem_b", 4, "l_orderkey", sort_by="l_orderkey")
    joined = li.join(o, li.l_orderkey == o.o_orderkey)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).count()
    assert "Exchange hashpartitioning" not in plan


def test_clone_database_and_views(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t4_src")
    spark.createDataFrame([(1, "a")], "k int, v string").write.mode("overwrite").saveAsTable("t4_src.x")
    copied = sinks.clone_database(spark, "t4_src", "t4_dst")
    assert copied == ["x"] and spark.table("t4_dst.x").count() == 1
    sinks.create_views(spark, {"v_orders": spark.read.parquet(f"{SF}/orders.parquet")})
    assert spark.sql("SELECT count(*) FROM v_orders").first()[0] == 1500


def test_daily_job_writes_and_validates(spark, scratch):
    from strata.plans.jobs import run_daily_outputs

    raw = events_as_raw(spark, SF)
    result = run_daily_outputs(spark, raw, scratch)
    assert result["malformed_rows"] == 0
    assert result["row_counts"]["question_score_totals"] == 250
    assert set(result["row_counts"]) == {
        "events_by_type_daily", "top_questions_daily", "answered_rate_daily",
        "region_distribution", "question_score_totals",
    }
    text = lake.read_score_totals_text(spark, os.path.join(scratch, "question_score_totals_text"))
    assert text.count() == 250


def test_check_outputs_lists_missing(spark, scratch):
    try:
        quality.check_outputs(spark, {"a": os.path.join(scratch, "nope"), "b": os.path.join(scratch, "nope2")})
    except quality.CheckFailed as e:
        assert "a: nothing" in str(e) and "b: nothing" in str(e)
    else:
        raise AssertionError("expected failure")


def test_questions_csv(spark, scratch):
    path = os.path.join(scratch, "q.csv")
    with open(path, "w") as f:
        f.write("question_id,creation_date,title,score,answer_count,is_answered,link\n")
        f.write('1,2026-03-03 16:12:47,Can&#39;t pass,1,0,False,/q/1\n')
        f.write('2,2026-03-03 16:01:09,"A, quoted title",-3,1,True,/q/2\n')
    rows = lake.read_questions_csv(spark, path).orderBy("question_id").collect()
    assert rows[0].title == "Can&#39;t pass" and rows[0].is_answered is False
    assert rows[1].title == "A, quoted title" and rows[1].score == -3 and rows[1].is_answered is True
    assert str(rows[0].creation_date) == "2026-03-03 16:12:47"


def test_seed_csv_and_preview(spark, scratch):
    path = os.path.join(scratch, "regions")
    spark.read.parquet(f"{SF}/region.parquet").write.mode("overwrite").option("header", True).csv(path)
    seed = lake.read_seed_csv(spark, path, "r_regionkey int, r_name string")
    assert seed.count() == 5
    schema, rows = lake.preview(seed, 3)
    assert "r_name" in schema and rows.count() == 3
    assert seed.filter(F.col("r_name") == "ASIA").count() == 1


def test_incremental_daily_equals_full_recompute(spark, scratch):
    from strata.plans.jobs import run_daily_increment

    raw = events_as_raw(spark, SF)
    lake_path = os.path.join(scratch, "lake")
    sinks.write_output(raw, lake_path, partition_by="event_date")
    # partition pruning reaches the scan
    plan = (
        lake.read_raw(spark, lake_path).filter(F.col("event_date") == F.lit("2024-01-03").cast("date"))
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "PartitionFilters: [isnotnull(event_date" in plan
    days = [str(r.event_date) for r in raw.select("event_date").distinct().orderBy("event_date").collect()]
    out = os.path.join(scratch, "out")
    run_daily_increment(spark, lake_path, out, days[:10])
    run_daily_increment(spark, lake_path, out, days[5:])
    run_daily_increment(spark, lake_path, out, days[3:4])  # rerun of a day changes nothing
    full = metrics.daily_metrics(spark.read.parquet(lake_path), use_partition_date=True)
    for name, expected in full.items():
        got = spark.read.parquet(os.path.join(out, name)).select(*expected.columns)
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0, name
    totals = spark.read.parquet(os.path.join(out, "question_score_totals"))
    expected = metrics.question_score_totals(spark.read.parquet(lake_path))
    assert totals.exceptAll(expected).count() == 0 and expected.exceptAll(totals).count() == 0


def _numbers(spark, path, lo, hi, part=None):
    df = spark.range(lo, hi).select("id", F.lit(part).alias("p"))
    df.write.mode("append").partitionBy("p").parquet(path)


def test_left_over_staging_without_manifest_is_thrown_away(spark, scratch):
    path = os.path.join(scratch, "t")
    spark.range(15).write.parquet(path)
    spark.range(10).write.parquet(swap.staging_path(path) + "/data")  # complete, but of an earlier run
    assert sinks.dedupe_path(spark, path).count() == 15
    assert not os.path.exists(swap.staging_path(path))


@pytest.mark.parametrize("moves_before_the_crash", [0, 1, 2])
def test_interrupted_swap_is_completed(spark, scratch, monkeypatch, moves_before_the_crash):
    path = os.path.join(scratch, "t")
    spark.range(20).unionByName(spark.range(20)).write.parquet(path)
    rename, done = swap.rename_path, []

    def crash(*args):
        if len(done) == moves_before_the_crash:
            raise RuntimeError("driver lost")
        done.append(args)
        rename(*args)

    monkeypatch.setattr(swap, "rename_path", crash)
    if moves_before_the_crash < 2:
        with pytest.raises(RuntimeError):
            sinks.dedupe_path(spark, path)
    else:
        sinks.dedupe_path(spark, path)
    monkeypatch.undo()
    assert sinks.dedupe_path(spark, path).count() == 20
    assert not os.path.exists(swap.staging_path(path))


def test_folders_that_changed_since_the_manifest_are_left_alone(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    for part in ("a", "b"):
        _numbers(spark, path, 0, 5, part)
    with monkeypatch.context() as m:
        m.setattr(swap, "finish_swap", lambda *a: None)  # lost right after the manifest
        smaller = spark.read.parquet(path).where("id < 2")
        swap.replace(spark, path, lambda f: smaller.write.partitionBy("p").parquet(f), names=["p=a", "p=b"])
    _numbers(spark, path, 100, 101, "a")  # newer data in one of them
    swap.finish_swap(spark, path)
    rows = sorted((r["p"], r["id"]) for r in spark.read.parquet(path).collect())
    assert rows == [("a", i) for i in (0, 1, 2, 3, 4, 100)] + [("b", 0), ("b", 1)]


def test_compaction_ignores_staging_of_another_call(spark, scratch):
    path = os.path.join(scratch, "lake")
    for day in ("2024-01-01", "2024-01-02"):
        spark.range(6).repartition(3).selectExpr("id", f"date'{day}' AS event_date").write.mode("append").partitionBy("event_date").parquet(path)
    stale = swap.staging_path(path)
    spark.range(2).selectExpr("id", "date'2024-01-01' AS event_date").write.partitionBy("event_date").parquet(stale + "/data")
    assert sinks.compact_partitions(spark, path, ["2024-01-02"]) == {"2024-01-02": 1}
    counts = {str(r[0]): r[1] for r in spark.read.parquet(path).groupBy("event_date").count().collect()}
    assert counts == {"2024-01-01": 6, "2024-01-02": 6}
    assert len([f for f in os.listdir(f"{path}/event_date=2024-01-02") if f.endswith(".parquet")]) == 1


def test_compaction_refuses_a_lake_with_a_sink_log(spark, scratch):
    os.makedirs(f"{scratch}/lake/_spark_metadata")
    with pytest.raises(ValueError, match="log"):
        sinks.compact_partitions(spark, f"{scratch}/lake", ["2024-01-01"])


def test_replace_table_writes_once_unless_it_reads_itself(spark):
    sinks.ensure_layers(spark, ["t3_bronze"])
    sinks.replace_table(spark, spark.range(3), "t3_bronze.t")
    assert not files._reads_table(spark.range(9), "t3_bronze.t")
    assert files._reads_table(spark.table("t3_bronze.t"), "t3_bronze.t")
    assert sinks.replace_table(spark, spark.range(9), "t3_bronze.t").count() == 9


def test_compaction_keeps_rows_and_merges_files(spark, scratch):
    import glob

    raw = events_as_raw(spark, SF, with_region=False)
    path = os.path.join(scratch, "lake")
    raw.repartition(16).write.option("maxRecordsPerFile", 5).partitionBy("event_date").parquet(path)
    day = "2024-01-02"
    before = len(glob.glob(f"{path}/event_date={day}/*.parquet"))
    plan = sinks.compact_partitions(spark, path, [day, "2024-01-03"], rows_per_file=20)
    after = len(glob.glob(f"{path}/event_date={day}/*.parquet"))
    assert after < before and after <= plan[day] + 2
    back = spark.read.parquet(path)
    assert back.count() == 1000
    cols = ["event_id", "timestamp", "event_date"]
    assert back.select(cols).exceptAll(raw.select(cols)).count() == 0


def test_increment_removes_days_that_have_no_rows_any_more(spark, scratch):
    from strata.plans.jobs import run_daily_increment
    from strata.sinks.swap import delete_path

    raw = events_as_raw(spark, SF, with_region=False)
    days = [str(r[0]) for r in raw.select("event_date").distinct().orderBy("event_date").limit(2).collect()]
    lake_path, out = f"{scratch}/lake", f"{scratch}/out"
    raw.filter(F.col("event_date").cast("string").isin(days)).write.partitionBy("event_date").parquet(lake_path)
    run_daily_increment(spark, lake_path, out, days)
    delete_path(spark, f"{lake_path}/event_date={days[1]}")
    run_daily_increment(spark, lake_path, out, [days[1]])
    left = spark.read.parquet(f"{out}/events_by_type_daily").select("event_date").distinct().collect()
    assert [str(r[0]) for r in left] == days[:1]
    kept = metrics.question_score_totals(raw.filter(F.col("event_date").cast("string") == days[0]))
    totals = spark.read.parquet(f"{out}/question_score_totals")
    assert totals.exceptAll(kept.select(totals.columns)).count() == 0 and totals.count() == kept.count()
