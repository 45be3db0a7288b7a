import datetime as dt
import json
import os

import pytest
from cases import message
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.operators import envelope
from strata.plans import queries_streaming
from strata.sinks import compact_partitions, swap
from strata.sources.driver_tables import events_as_raw
from strata.sources.lake import read_raw
from strata.streaming import (
    apply_changes_batch,
    join_status_updates,
    read_event_stream,
    start_apply_changes,
    start_raw_sink,
    stream_to_raw,
    windowed_summary,
    upsert,
)


def _land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _drain(spark, landing, lake, ckpt):
    stream = read_event_stream(spark, "files", path=landing, max_files_per_trigger=1)
    q = start_raw_sink(stream_to_raw(stream), lake, ckpt, trigger="available_now")
    q.awaitTermination()
    assert q.exception() is None


def test_file_stream_to_lake_once_and_idempotent(spark, scratch):
    landing, lake, ckpt = (os.path.join(scratch, d) for d in ("landing", "lake", "ckpt"))
    _land(landing, "a.json", [message("a"), message("b", ts="junk"), "not json"])
    _drain(spark, landing, lake, ckpt)
    out = spark.read.parquet(lake)
    assert out.count() == 3
    dates = {r.event_date for r in out.select("event_date").distinct().collect()}
    assert dates == {dt.date(2026, 3, 3), dt.date(1970, 1, 1)}
    # rerun on the same checkpoint: nothing new
    _drain(spark, landing, lake, ckpt)
    assert spark.read.parquet(lake).count() == 3
    # a new landed file is picked up exactly once
    _land(landing, "b.json", [message("c")])
    _drain(spark, landing, lake, ckpt)
    assert spark.read.parquet(lake).count() == 4


def test_stream_equals_batch_on_same_rows(spark, scratch):
    landing, lake, ckpt = (os.path.join(scratch, d) for d in ("landing", "lake", "ckpt"))
    raw = events_as_raw(spark, "/root/testdata/sf0.001")
    msgs = [r.value for r in envelope.to_messages(raw).collect()]
    for i in range(0, len(msgs), 250):
        _land(landing, f"part{i:05d}.json", msgs[i : i + 250])
    _drain(spark, landing, lake, ckpt)
    streamed = spark.read.parquet(lake)
    batch = envelope.derive_time(envelope.parse_events(envelope.to_messages(raw)))
    cols = ["event_id", "event_type", "timestamp", "user_id", "region", "event_date"]
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert streamed.count() == 1000


def test_windowed_summary_emits_closed_windows(spark, scratch):
    src = os.path.join(scratch, "src")
    schema = "ts timestamp, v double"
    rows = [
        ("2024-01-01 00:05:00", 1.0),
        ("2024-01-01 00:40:00", 2.0),
        ("2024-01-01 01:10:00", 4.0),
        ("2024-01-01 03:00:00", 8.0),
    ]
    spark.createDataFrame(rows, "ts string, v double").select(
        F.to_timestamp("ts").alias("ts"), "v"
    ).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    agg = windowed_summary(stream, ts_col="ts", amount_col="v", window="1 hour", watermark="10 minutes")
    q = agg.writeStream.format("memory").queryName("hourly_t").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.window_start.hour: (r.event_count, r.total_value) for r in spark.table("hourly_t").collect()}
    # the 03:00 window is still open (watermark 02:50)
    assert got == {0: (2, 3.0), 1: (1, 4.0)}


def test_stream_stream_join_time_bound(spark, scratch):
    o_dir, u_dir = os.path.join(scratch, "o"), os.path.join(scratch, "u")
    spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")], "order_id int, ts string"
    ).select("order_id", F.to_timestamp("ts").alias("order_ts")).write.parquet(o_dir)
    spark.createDataFrame(
        [(1, "2024-01-01 00:10:00", "F"), (2, "2024-01-01 02:00:00", "F")], "order_id int, ts string, status string"
    ).select("order_id", F.to_timestamp("ts").alias("update_ts"), "status").write.parquet(u_dir)
    o = spark.readStream.schema("order_id int, order_ts timestamp").parquet(o_dir)
    u = spark.readStream.schema("order_id int, update_ts timestamp, status string").parquet(u_dir)
    j = join_status_updates(o, u)
    q = j.writeStream.format("memory").queryName("joined_t").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = [(r.order_id, r.status) for r in spark.table("joined_t").collect()]
    assert got == [(1, "F")]


def test_foreach_batch_upsert(spark, scratch):
    land, target, ckpt = (os.path.join(scratch, d) for d in ("land", "target", "ckpt"))
    schema = "order_id long, status string, order_date string, version int, _deleted boolean"

    def write(name, rows):
        os.makedirs(land, exist_ok=True)
        with open(os.path.join(land, name), "w") as f:
            for r in rows:
                f.write(json.dumps(dict(zip(["order_id", "status", "order_date", "version", "_deleted"], r))) + "\n")

    def run():
        changes = spark.readStream.schema(schema).json(land)
        q = start_apply_changes(
            spark, changes, target, ckpt, keys=["order_id"], order_by=["version"],
            partition_col="order_date", delete_col="_deleted",
        )
        q.awaitTermination()
        assert q.exception() is None
        return {r.order_id: r.status for r in spark.read.parquet(target).collect()}

    write("1.json", [(1, "O", "2024-01-01", 1, False), (2, "O", "2024-01-02", 1, False), (1, "P", "2024-01-01", 2, False)])
    assert run() == {1: "P", 2: "O"}
    write("2.json", [(1, "F", "2024-01-01", 3, False), (2, "O", "2024-01-02", 2, True), (3, "O", "2024-01-03", 1, False)])
    assert run() == {1: "F", 3: "O"}
    assert run() == {1: "F", 3: "O"}


def test_bounded_interval_run_stops(spark, scratch):
    import time

    from strata.streaming import ingest

    landing, lake, ckpt = (os.path.join(scratch, d) for d in ("landing", "lake", "ckpt"))
    _land(landing, "a.json", [message("a"), message("b")])
    t0 = time.time()
    q = ingest(
        spark, lake, ckpt, source={"fmt": "files", "path": landing},
        trigger="processing_time", interval="1 second", run_seconds=6,
    )
    assert not q.isActive and time.time() - t0 < 60
    assert spark.read.parquet(lake).count() == 2


def test_daily_cycle_end_to_end(spark, scratch):
    from strata.plans.jobs import run_daily_cycle
    from strata.sinks import write_messages_text

    landing = os.path.join(scratch, "landing")
    raw = events_as_raw(spark, "/root/testdata/sf0.001")
    write_messages_text(raw, landing)
    result = run_daily_cycle(
        spark,
        {"fmt": "files", "path": landing},
        os.path.join(scratch, "lake"),
        os.path.join(scratch, "ckpt"),
        os.path.join(scratch, "out"),
        table_prefix="cyc_",
    )
    assert len(result["recent_partitions"]) == 5
    assert result["row_counts"]["events_by_type_daily"] == 150
    assert result["tables"]["cyc_silver.cleaned_silver_table"] == 250


def test_landed_files_archived_after_commit(spark, scratch):
    import glob
    import time

    landing, archive, lake, ckpt = (os.path.join(scratch, d) for d in ("landing", "archive", "lake", "ckpt"))
    _land(landing, "a.json", [message("a")])
    _land(landing, "b.json", [message("b")])
    stream = read_event_stream(
        spark, "files", path=landing, max_files_per_trigger=1, clean_source="archive", archive_dir=archive
    )
    q = start_raw_sink(stream_to_raw(stream), lake, ckpt, trigger="available_now")
    q.awaitTermination()
    assert spark.read.parquet(lake).count() == 2
    deadline = time.time() + 30
    while time.time() < deadline and os.path.exists(os.path.join(landing, "a.json")):
        time.sleep(0.5)
    # the file of the first committed batch has been moved out of the landing folder
    assert not os.path.exists(os.path.join(landing, "a.json"))
    assert glob.glob(os.path.join(archive, "**", "a.json"), recursive=True)


def test_topic_metadata_kept_without_name_clash(spark):
    import datetime as _dt

    rows = [(message("a").encode(), 0, 17, _dt.datetime(2026, 3, 3, 16, 13))]
    topic_like = spark.createDataFrame(rows, "value binary, partition int, offset long, timestamp timestamp")
    out = stream_to_raw(topic_like, keep_metadata=True).first()
    assert out.timestamp == "2026-03-03T16:12:47+00:00"
    assert (out._partition, out._offset) == (0, 17) and out._broker_time is not None


def test_windows_with_off_heap_state_store(spark, scratch):
    # the settings build_session(large_state=True) applies, set on this session
    keys = {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        src = os.path.join(scratch, "src")
        spark.createDataFrame(
            [("2024-01-01 00:05:00", 1.0), ("2024-01-01 01:10:00", 4.0), ("2024-01-01 03:00:00", 8.0)],
            "ts string, v double",
        ).select(F.to_timestamp("ts").alias("ts"), "v").write.parquet(src)
        stream = spark.readStream.schema("ts timestamp, v double").parquet(src)
        agg = windowed_summary(stream, ts_col="ts", amount_col="v")
        q = (
            agg.writeStream.format("parquet").outputMode("append")
            .option("path", os.path.join(scratch, "out"))
            .option("checkpointLocation", os.path.join(scratch, "ckpt"))
            .trigger(availableNow=True).start()
        )
        q.awaitTermination()
        assert q.exception() is None
        got = {r.window_start.hour: r.event_count for r in spark.read.parquet(os.path.join(scratch, "out")).collect()}
        assert got == {0: 1, 1: 1}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# --- safety of the upsert, the lake and the table streams --------------------------


def _apply(spark, target, rows, epoch=0, **options):
    schema = "id long, s string, p string, version int, _deleted boolean"
    batch = spark.createDataFrame([(*r, False) if len(r) == 4 else r for r in rows], schema)
    fn = apply_changes_batch(spark, target, ["id"], ["version"], "p", delete_col="_deleted", **options)
    fn(batch, epoch)
    out = spark.read.schema("id long, s string, p string, version int").parquet(target)
    return sorted(((r.id, r.s, r.p, r.version) for r in out.collect()), key=str)


def test_late_change_does_not_replace_a_newer_row(spark, scratch):
    target = os.path.join(scratch, "t")
    _apply(spark, target, [(1, "new", "a", 5)])
    assert _apply(spark, target, [(1, "late", "a", 3)], epoch=1) == [(1, "new", "a", 5)]
    assert _apply(spark, target, [(1, "newer", "a", 6)], epoch=2) == [(1, "newer", "a", 6)]


def test_null_and_odd_partition_values_survive(spark, scratch):
    target = os.path.join(scratch, "t")
    odd = "a=b/c %d:e"
    first = [(1, "x", None, 1), (2, "x", None, 1), (3, "x", odd, 1), (4, "x", odd, 1), (5, "x", "z", 1)]
    _apply(spark, target, first)
    got = _apply(spark, target, [(2, "y", None, 2), (4, "y", odd, 2)], epoch=1)
    assert got == sorted([(1, "x", None, 1), (2, "y", None, 2), (3, "x", odd, 1), (4, "y", odd, 2), (5, "x", "z", 1)], key=str)
    # every key of a partition deleted: the partition goes
    got = _apply(spark, target, [(3, "x", odd, 3, True), (4, "x", odd, 3, True), (1, "x", None, 3, True), (2, "x", None, 3, True)], epoch=2)
    assert got == [(5, "x", "z", 1)]


def test_key_that_moves_to_another_partition(spark, scratch):
    target = os.path.join(scratch, "t")
    _apply(spark, target, [(1, "x", "a", 1), (2, "x", "a", 1)])
    assert _apply(spark, target, [(1, "y", "b", 2)], epoch=1, keys_move=True) == [(1, "y", "b", 2), (2, "x", "a", 1)]


def test_left_over_staging_of_another_run_is_not_applied(spark, scratch):
    target = os.path.join(scratch, "t")
    _apply(spark, target, [(1, "x", "a", 1)])
    spark.createDataFrame([(9, "old", 9, "a")], "id long, s string, version int, p string").write.partitionBy("p").parquet(
        swap.staging_path(target) + "/data"
    )
    assert _apply(spark, target, [(1, "y", "a", 2), (3, "n", "a", 1)]) == [(1, "y", "a", 2), (3, "n", "a", 1)]


def test_order_of_rows_and_ties_do_not_matter(spark, scratch):
    rows = [(1, s, "a", 1) for s in ("b", "c", "a")]
    results = set()
    for k in range(3):
        results.add(str(_apply(spark, os.path.join(scratch, f"t{k}"), rows[k:] + rows[:k])))
    assert len(results) == 1


def test_too_fine_a_partition_column_is_refused(spark, scratch):
    rows = [(i, "x", str(i), 1) for i in range(9)]
    with pytest.raises(ValueError, match="touches more"):
        _apply(spark, os.path.join(scratch, "t"), rows, max_partitions=5)


def test_lake_survives_compaction_and_replay(spark, scratch):
    landing, lake, ckpt = (os.path.join(scratch, d) for d in ("landing", "lake", "ckpt"))
    for k in range(3):
        _land(landing, f"{k}.json", [message(f"e{k}{i}") for i in range(5)])
    _drain(spark, landing, lake, ckpt)
    assert read_raw(spark, lake).count() == 15
    assert compact_partitions(spark, lake, ["2026-03-03"]) == {"2026-03-03": 1}
    assert read_raw(spark, lake).count() == 15
    assert len([d for d in os.listdir(f"{lake}/event_date=2026-03-03") if "=" in d]) == 1
    # a replay of the last epoch (its commit was lost) adds nothing: compaction has its rows
    last = max(int(f) for f in os.listdir(f"{ckpt}/commits") if f.isdigit())
    os.remove(f"{ckpt}/commits/{last}")
    os.remove(f"{ckpt}/commits/.{last}.crc")
    _drain(spark, landing, lake, ckpt)
    assert read_raw(spark, lake).count() == 15
    _land(landing, "new.json", [message("n1"), message("n2", ts="2026-03-04T00:00:00+00:00")])
    _drain(spark, landing, lake, ckpt)
    ids = [r.event_id for r in read_raw(spark, lake).collect()]
    assert len(ids) == len(set(ids)) == 17


def test_table_streams_read_folders_and_files_alike(spark, scratch):
    sf = os.path.join(scratch, "sf")
    os.makedirs(sf)
    for t in ("events", "orders", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").repartition(3).write.parquet(f"{sf}/{t}.parquet")
    for q in (queries_streaming.q_stream_hourly_windows, queries_streaming.q_stream_order_line_join):
        one, many = (q(spark, d) for d in ("/root/testdata/sf0.001", sf))
        assert one.count() == many.count() > 0
        assert one.exceptAll(many).count() == 0
    with pytest.raises(AnalysisException):
        queries_streaming.q_stream_hourly_windows(spark, scratch)


def test_late_rows_over_several_batches(spark, scratch):
    """Rows behind the watermark of an earlier batch are dropped; those within it count."""
    land, ckpt, out = (os.path.join(scratch, d) for d in ("land", "ckpt", "out"))
    schema = "ts timestamp, v double"
    batches = [["2024-01-01 00:10", "2024-01-01 00:50"], ["2024-01-01 02:30", "2024-01-01 00:55"], ["2024-01-01 00:56", "2024-01-01 05:00"]]
    for k, times in enumerate(batches):
        rows = [(dt.datetime.fromisoformat(t), 1.0) for t in times]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{land}/{k}")
        stream = spark.readStream.schema(schema).parquet(f"{land}/*")
        agg = windowed_summary(stream, ts_col="ts", amount_col="v", window="1 hour", watermark="30 minutes")
        q = agg.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
    got = {r.window_start.hour: r.event_count for r in spark.read.parquet(out).collect()}
    # 00:55 came in time for the open first hour; 00:56 after that hour had been closed at 02:00.
    assert got == {0: 3, 2: 1}


def test_latest_row_without_sorting_whole_rows(spark):
    rows = [(1, 2, "b", None), (1, 2, "b", "x"), (1, 1, "z", "z"), (None, None, "a", "a"), (None, 0, None, None), (2, None, "q", "q")]
    changes = spark.createDataFrame(rows * 2, "k int, v int, a string, b string")
    latest = upsert.latest_per_key(changes, ["k"], ["v"])
    assert latest.columns == changes.columns
    assert sorted(map(tuple, latest.collect()), key=str) == [(1, 2, "b", "x"), (2, None, "q", "q"), (None, 0, None, None)]
    assert "Window" not in latest._jdf.queryExecution().executedPlan().toString()
    with_map = changes.withColumn("m", F.create_map(F.lit("m"), "a"))
    assert sorted(map(str, upsert.latest_per_key(with_map, ["k"], ["v"]).drop("m").collect())) == sorted(map(str, latest.collect()))


def test_moved_keys_are_searched_in_other_partitions_only(spark, scratch):
    path = os.path.join(scratch, "t")
    apply = apply_changes_batch(spark, path, ["k"], ["v"], "p")

    def rows(*values):
        return spark.createDataFrame(values, "k int, v int, p string")

    apply(rows((1, 1, "a"), (2, 1, "b"), (3, 1, None)), 0)
    apply(rows((1, 2, "b"), (2, 2, None), (3, 2, "a")), 1)  # all move among the batch's own partitions
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect())) == [(1, 2, "b"), (2, 2, None), (3, 2, "a")]
    apply(rows((3, 3, "c")), 2)  # from a partition that the batch doesn't name
    apply(rows((2, 3, "c")), 3)  # from the null partition
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect())) == [(1, 2, "b"), (2, 3, "c"), (3, 3, "c")]
