"""What grows batch by batch: rewrites beside other writers, change feeds, distinct loads, dimensions, streams, erasure."""

import datetime as dt
import os

import pytest
from cases import SF_SMALL, message, raw_from_messages
from pyspark.sql import functions as F

from strata import sinks
from strata.operators import model, privacy, states
from strata.plans.jobs import run_daily_increment, run_incremental_cycle
from strata.sinks import compaction, dimension, distinct, subjects, swap, versions
from strata.sources.driver_tables import events_as_raw, read_table, region_counts
from strata.sources.lake import read_raw
from strata.streaming import any_order, upsert
from strata.streaming.ingest import ingest


def _files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                f = os.path.join(folder, n)
                found[f] = os.stat(f).st_mtime_ns
    return found


def _rows(spark, path, *columns):
    return sorted((tuple(r) for r in spark.read.parquet(path).select(*columns).collect()), key=str)


# --- rewrites beside another writer ----------------------------------------------------


def _numbers(spark, path, lo, hi, part):
    spark.range(lo, hi).select("id", F.lit(part).alias("p")).write.mode("append").partitionBy("p").parquet(path)


@pytest.fixture()
def lands_while_staging(monkeypatch):
    """Let another writer append when a replacement has been written and not yet moved in."""

    def arm(append, times=1):
        check, left = swap._check_unchanged, [times]

        def interfere(*args):
            if left[0]:
                left[0] -= 1
                append()
            return check(*args)

        monkeypatch.setattr(swap, "_check_unchanged", interfere)

    return arm


def test_compaction_and_dedupe_raise_when_rows_land_meanwhile(spark, scratch, lands_while_staging):
    path = f"{scratch}/t"
    _numbers(spark, path, 0, 10, "a")
    for rewrite in (lambda: sinks.compact_partitions(spark, path, ["a"], partition_col="p"), lambda: sinks.dedupe_path(spark, path)):
        lands_while_staging(lambda: _numbers(spark, path, 100, 105, "a"))
        before = spark.read.parquet(path).count()
        with pytest.raises(swap.ConcurrentChange):
            rewrite()
        assert spark.read.parquet(path).count() == before + 5
        assert not os.path.exists(swap.staging_path(path))
    sinks.dedupe_path(spark, path)
    assert len(_rows(spark, path, "id")) == 15 and os.path.isdir(f"{path}/p=a")


def test_rows_that_land_after_the_frame_was_made_are_seen(spark, scratch):
    path = f"{scratch}/t"
    _numbers(spark, path, 0, 10, "a")
    seen = swap.observe(spark, path)
    kept = spark.read.parquet(path).distinct()
    _numbers(spark, path, 100, 105, "a")
    with pytest.raises(swap.ConcurrentChange):
        sinks.overwrite_via_staging(spark, kept, path, partition_by="p", seen=seen)
    assert spark.read.parquet(path).count() == 15


def test_change_between_the_check_and_the_move(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    _numbers(spark, path, 0, 10, "a")
    rename, armed = swap.rename_path, [True]

    def late(spark_, source, target):
        if armed:
            armed.clear()
            _numbers(spark, path, 100, 105, "a")
        rename(spark_, source, target)

    monkeypatch.setattr(swap, "rename_path", late)
    with pytest.raises(swap.ConcurrentChange):
        sinks.compact_partitions(spark, path, ["a"], partition_col="p")
    assert spark.read.parquet(path).count() == 15


def test_folder_that_another_writer_created_meanwhile(spark, scratch):
    path = f"{scratch}/t"
    _numbers(spark, path, 0, 3, "a")

    def write(folder):
        _numbers(spark, folder, 5, 6, "b")
        _numbers(spark, path, 7, 9, "b")

    with pytest.raises(swap.ConcurrentChange):
        swap.replace(spark, path, write, names=["p=a"])
    assert _rows(spark, path, "id", "p") == [(0, "a"), (1, "a"), (2, "a"), (7, "b"), (8, "b")]


# --- change feed ------------------------------------------------------------------------

_CHANGES = "id long, s string, p string, version int, _deleted boolean"


def _apply(spark, target, rows, **options):
    batch = spark.createDataFrame([(*r, False) if len(r) == 4 else r for r in rows], _CHANGES)
    upsert.apply_changes_batch(spark, target, ["id"], ["version"], "p", delete_col="_deleted", **options)(batch, 0)
    return _rows(spark, target, "id", "s", "p", "version")


def test_upsert_is_merged_anew_when_another_writer_appends(spark, scratch, lands_while_staging):
    target = f"{scratch}/t"
    _apply(spark, target, [(1, "old", "a", 1)])

    def append():
        spark.createDataFrame([(9, "x", 1, "a")], "id long, s string, version int, p string").write.mode("append").partitionBy("p").parquet(target)

    lands_while_staging(append)
    got = _apply(spark, target, [(1, "new", "a", 2), (2, "n", "a", 2)])
    assert got == [(1, "new", "a", 2), (2, "n", "a", 2), (9, "x", "a", 1)]
    lands_while_staging(append, times=2)
    with pytest.raises(swap.ConcurrentChange):
        _apply(spark, target, [(3, "n", "a", 2)], attempts=2)
    assert (1, "new", "a", 2) in _rows(spark, target, "id", "s", "p", "version")


def test_deleted_keys_stay_away(spark, scratch):
    target = f"{scratch}/t"
    _apply(spark, target, [(1, "x", "a", 1), (2, "x", "a", 1), (None, "x", "a", 1)])
    assert _apply(spark, target, [(1, "", "a", 3, True), (None, "", "a", 3, True), (5, "", "a", 3, True)]) == [(2, "x", "a", 1)]
    late = [(1, "late", "a", 2), (None, "late", "b", 2), (5, "late", "c", 2)]
    assert _apply(spark, target, late) == [(2, "x", "a", 1)]
    _apply(spark, target, [(1, "", "a", 3, True)])  # delivered again
    log = upsert.compact_deletions(spark, target, ["id"], ["version"])
    assert sorted(((r.id, r.version) for r in log.collect()), key=str) == [(1, 3), (5, 3), (None, 3)]
    assert _apply(spark, target, late) == [(2, "x", "a", 1)]
    assert _apply(spark, target, [(1, "again", "b", 4)]) == [(1, "again", "b", 4), (2, "x", "a", 1)]
    # the old deletion is older than the row that is there now
    assert _apply(spark, target, [(2, "y", "b", 2)]) == [(1, "again", "b", 4), (2, "y", "b", 2)]


def test_deletions_are_forgotten_when_told(spark, scratch):
    target = f"{scratch}/t"
    _apply(spark, target, [(2, "x", "a", 1)])
    _apply(spark, target, [(1, "", "a", 3, True)])
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=1)
    assert upsert.compact_deletions(spark, target, ["id"], ["version"], keep_since=later).count() == 0
    assert _apply(spark, target, [(1, "late", "a", 2)]) == [(1, "late", "a", 2), (2, "x", "a", 1)]


def test_moved_keys_are_kept_once(spark, scratch):
    target = f"{scratch}/t"
    _apply(spark, target, [(1, "x", "a", 1), (2, "x", "a", 1)])
    assert _apply(spark, target, [(1, "y", "b", 2)]) == [(1, "y", "b", 2), (2, "x", "a", 1)]


# --- distinct loads -----------------------------------------------------------------------


def _events(spark, ids, ts="2026-03-03T16:12:47+00:00", **fields):
    return raw_from_messages(spark, [message(i, ts=ts, **fields) for i in ids])


def test_loads_with_overlaps_equal_one_distinct(spark, scratch):
    path = f"{scratch}/lake"
    loads = [("a", "12"), ("b", "234"), ("c", "4451")]
    for name, ids in loads:
        day_two = _events(spark, ids, ts="2026-03-04T00:00:00+00:00", score=None)
        distinct.append_distinct(spark, path, _events(spark, ids).unionByName(day_two), name)
    all_ids = "12" + "234" + "4451"
    whole = _events(spark, all_ids).unionByName(_events(spark, all_ids, ts="2026-03-04T00:00:00+00:00", score=None)).distinct()
    got = read_raw(spark, path)
    assert got.count() == 10 and got.exceptAll(whole.select(got.columns)).count() == 0


def test_nulls_and_batch_names_in_the_comparison(spark, scratch):
    path = f"{scratch}/lake"
    rows = [(None, "x", 1), ("x", None, 1), ("x", None, None), (None, None, None)]
    schema = "a string, b string, event_date int"
    for name in ("1", "2"):
        batch = spark.createDataFrame(rows * 2, schema).withColumn("_ingest", F.lit(f"other{name}"))
        distinct.append_distinct(spark, path, batch, name)
    assert sorted(map(str, spark.read.parquet(path).select("a", "b", "event_date").collect())) == sorted(
        map(str, spark.createDataFrame(rows, schema).collect())
    )


def test_only_touched_days_are_read_and_a_repeated_load_does_nothing(spark, scratch):
    path = f"{scratch}/lake"
    for k, day in enumerate(("2026-03-03", "2026-03-04", "2026-03-05")):
        distinct.append_distinct(spark, path, _events(spark, "12", ts=f"{day}T00:00:00+00:00"), f"load{k}")
    field = read_raw(spark, path).schema["event_date"]
    read = distinct.known_digests(spark, path, [dt.date(2026, 3, 4)], field, "new")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0] and read.count() == 2
    before = _files(scratch)
    distinct.append_distinct(spark, path, _events(spark, "789"), "load1")
    assert _files(scratch) == before
    distinct.append_distinct(spark, path, _events(spark, "123", ts="2026-03-03T00:00:00+00:00"), "load9")
    assert read_raw(spark, path).count() == 7
    assert before.items() <= _files(scratch).items()  # nothing was rewritten


def test_load_that_broke_off_is_repeated(spark, scratch, monkeypatch):
    path = f"{scratch}/lake"
    distinct.append_distinct(spark, path, _events(spark, "12"), "a")
    with monkeypatch.context() as m:
        m.setattr(distinct, "write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            distinct.append_distinct(spark, path, _events(spark, "234"), "b")
    distinct.append_distinct(spark, path, _events(spark, "234"), "b")
    assert sorted(r.event_id for r in read_raw(spark, path).collect()) == ["1", "2", "3", "4"]


def test_lake_ingested_twice_is_made_distinct_and_survives_replay(spark, scratch):
    lake = f"{scratch}/lake"
    for k in range(2):
        os.makedirs(f"{scratch}/land{k}")
        with open(f"{scratch}/land{k}/a.json", "w") as f:
            f.write("\n".join(message(f"e{i}") for i in range(5)) + "\n")
        ingest(spark, lake, f"{scratch}/ckpt{k}", {"fmt": "files", "path": f"{scratch}/land{k}"})
    assert read_raw(spark, lake).count() == 10
    sinks.dedupe_path(spark, lake)
    assert read_raw(spark, lake).count() == 5
    assert compaction.merged_epochs(spark, lake, ["event_date=2026-03-03"])["event_date=2026-03-03"].keys()
    for k in range(2):  # both streams lose their last commit
        os.remove(f"{scratch}/ckpt{k}/commits/0")
        os.remove(f"{scratch}/ckpt{k}/commits/.0.crc")
        ingest(spark, lake, f"{scratch}/ckpt{k}", {"fmt": "files", "path": f"{scratch}/land{k}"})
    assert read_raw(spark, lake).count() == 5


def test_events_delivered_again_land_once(spark, scratch):
    land, lake, ckpt = (f"{scratch}/{d}" for d in ("land", "lake", "ckpt"))
    os.makedirs(land)
    no_id = message("x").replace('"event_id": "x"', '"event_id": null')
    deliveries = [["a", "b", "a"], ["b", "c"], ["a", "c", "d"]]
    for k, ids in enumerate(deliveries):
        with open(f"{land}/{k}.json", "w") as f:
            f.write("\n".join([*(message(i, ts="junk" if i == "a" else "2026-03-03T16:12:47+00:00") for i in ids), no_id]) + "\n")
        ingest(spark, lake, ckpt, {"fmt": "files", "path": land}, once_within="1 day")
    assert sorted(str(r.event_id) for r in read_raw(spark, lake).collect()) == ["None", "a", "b", "c", "d"]


# --- dimension ----------------------------------------------------------------------------


def _versions(spark, path):
    rows = dimension.read_dimension(spark, path).collect()
    return sorted(((r.k, r.s, str(r.valid_from), str(r.valid_to), r.is_current) for r in rows), key=str)


def test_snapshots_equal_the_whole_rewrite(spark, scratch):
    path = f"{scratch}/dim"
    snapshots = [
        [(1, "a"), (2, "a"), (3, None), (None, "n")],
        [(1, "b"), (2, "a"), (4, "z"), (4, "y"), (None, None)],
        [(1, "a"), (3, "c"), (4, "z")],
    ]
    whole = None
    for i, rows in enumerate(snapshots):
        day = f"2024-01-0{i + 1}"
        incoming = spark.createDataFrame(rows, "k int, s string")
        close = i == 2
        dimension.apply_snapshot(spark, path, incoming, "k", ["s"], day, close_missing=close, buckets=4)
        one = incoming.groupBy("k").agg(F.max(F.struct("s")).alias("x")).select("k", "x.s")
        if whole is None:
            whole = model.scd2_initial(one, F.lit(day))
        else:
            whole = model.scd2_apply(whole, incoming, "k", ["s"], day, close_missing=close)
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        expected = sorted(((r.k, r.s, str(r.valid_from), str(r.valid_to), r.is_current) for r in whole.collect()), key=str)
        assert _versions(spark, path) == expected


def test_a_snapshot_writes_touched_buckets_only(spark, scratch):
    path = f"{scratch}/dim"
    base = spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("s"))
    assert dimension.apply_snapshot(spark, path, base, "k", ["s"], "2024-01-01", buckets=16) == 1
    one = base.withColumn("s", F.when(F.col("k") == 7, "b").otherwise("a"))
    before = _files(path)
    assert dimension.apply_snapshot(spark, path, one, "k", ["s"], "2024-02-01") == 2
    after = _files(path)
    assert before.items() <= after.items()
    new = {os.path.dirname(f).replace(path, "") for f in after if f not in before}
    assert len([f for f in new if f.startswith("/current/2/")]) == 1 and "/history/2" in new
    assert dimension.apply_snapshot(spark, path, one, "k", ["s"], "2024-02-01") == 2  # again: nothing to do
    assert _files(path) == after
    assert [v for v in _versions(spark, path) if v[0] == 7] == [
        (7, "a", "2024-01-01", "2024-02-01", False),
        (7, "b", "2024-02-01", "None", True),
    ]
    rows = _versions(spark, path)
    assert dimension.forget_versions(spark, path, keep=1) and _versions(spark, path) == rows


def test_a_snapshot_is_evaluated_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def status(k):
        seen.add(1)
        return "ab"[k % 2]

    path = f"{scratch}/dim"
    for n, day in ((60, "2024-01-01"), (100, "2024-02-01"), (100, "2024-03-01")):
        before = seen.value
        incoming = spark.range(n).select(F.col("id").alias("k"), F.udf(status, "string")("id").alias("s"))
        dimension.apply_snapshot(spark, path, incoming, "k", ["s"], day, buckets=4)
        assert seen.value - before == n
    assert len(_versions(spark, path)) == 100


def test_snapshots_differ_by_null_and_by_typed_values(spark, scratch):
    path = f"{scratch}/dim"
    first, second = float("nan"), dt.datetime(2024, 1, 1, 0, 0, 1)
    rows = [
        [(1, None, None, [1]), (2, first, second, None), (3, 0.5, second, [])],
        [(1, None, None, [1]), (2, first, second, []), (3, None, None, None)],
    ]
    for k, snapshot in enumerate(rows):
        incoming = spark.createDataFrame(snapshot, "k int, x double, t timestamp, a array<int>")
        dimension.apply_snapshot(spark, path, incoming, "k", ["x", "t", "a"], f"2024-01-0{k + 1}", buckets=4)
    found = dimension.read_dimension(spark, path).collect()
    assert sorted((r.k, r.is_current) for r in found) == [(1, True), (2, False), (2, True), (3, False), (3, True)]


def test_two_writers_of_one_version(spark, scratch):
    path = f"{scratch}/v"
    assert versions.commit(spark, path, 0, {"a": 1}) == 1
    with pytest.raises(swap.ConcurrentChange):
        versions.commit(spark, path, 0, {"a": 2})
    open(f"{path}/_versions/2.json", "w").write("{")  # another commit, not finished
    assert versions.latest(spark, path) == (1, {"a": 1})


# --- streams in any order -------------------------------------------------------------------


def _ts(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


@pytest.mark.parametrize("unit", ["day", "month"])
def test_any_order_join_equals_the_batch_join(spark, scratch, unit):
    orders = [(i, _ts(i * 7 % 240)) for i in range(60)] + [(7, _ts(1)), (None, _ts(2)), (8, None)]
    updates = [(i % 60, _ts(i * 7 % 240 + i % 30), f"s{i}") for i in range(120)] + [(None, _ts(3), "n"), (8, None, "n")]
    o_schema, u_schema = "order_id int, order_ts timestamp", "order_id int, update_ts timestamp, status string"
    bound = {"key": "order_id", "left_ts": "order_ts", "right_ts": "update_ts", "within": "20 hours"}
    for k in range(4):  # updates before their orders, times running backwards
        spark.createDataFrame(orders[3 - k :: 4], o_schema).coalesce(1).write.mode("append").parquet(f"{scratch}/o")
        spark.createDataFrame(updates[k::4], u_schema).coalesce(1).write.mode("append").parquet(f"{scratch}/u")
        streams = [spark.readStream.schema(s).parquet(f"{scratch}/{n}") for s, n in ((o_schema, "o"), (u_schema, "u"))]
        q = any_order.start_any_order_join(*streams, f"{scratch}/j", f"{scratch}/ckpt", lateness="72 hours", unit=unit, **bound)
        q.awaitTermination()
        assert q.exception() is None
        if k == 2:  # the batch is replayed: its commit was lost
            os.remove(f"{scratch}/ckpt/commits/{k}")
            os.remove(f"{scratch}/ckpt/commits/.{k}.crc")
    o, u = spark.createDataFrame(orders, o_schema), spark.createDataFrame(updates, u_schema)
    late = any_order.read_late(spark, f"{scratch}/j")
    assert late.where("l IS NOT NULL AND ts IS NOT NULL").count() and late.where("r IS NOT NULL AND ts IS NOT NULL").count()
    assert late.where("key IS NULL OR ts IS NULL").count() == 4
    found = any_order.read_pairs(spark, f"{scratch}/j")
    assert found.count() > 0
    repaired = found.unionByName(any_order.late_pairs(late, o, u, **bound))
    rows = any_order.both_sides(o, u, "order_id", "order_ts", "update_ts")
    expected = any_order.match(rows.where("l IS NOT NULL"), rows.where("r IS NOT NULL"), "20 hours")
    assert repaired.exceptAll(expected).count() == 0 and expected.exceptAll(repaired).count() == 0


def test_any_order_state_is_bounded(spark, scratch):
    schema = "order_id int, order_ts timestamp"
    run = any_order.any_order_batch(spark, f"{scratch}/j", "1 hour", "24 hours")
    none = spark.createDataFrame([], "order_id int, update_ts timestamp")
    for epoch in range(6):
        rows = spark.createDataFrame([(epoch, _ts(48 * epoch))], schema)
        run(any_order.both_sides(rows, none, "order_id", "order_ts", "update_ts"), epoch)
    days = [d for d in os.listdir(f"{scratch}/j/state/l") if d.startswith("_period")]
    assert len(days) <= 3


# --- mergeable states --------------------------------------------------------------------------


def test_merged_states_equal_states_of_all_rows(spark):
    rows = [("a", 1, 1.25, 5), ("a", 1, None, 5), ("a", 2, -3.5, 6), ("b", 1, 2.0, None), ("b", 3, None, 7)]
    df = spark.createDataFrame(rows, "k string, day int, v double, u long")
    parts = [states.value_states(df.filter(c), ["k", "day"], "v", "u") for c in ("day = 1", "day > 1")]
    merged = states.merge_states(parts[0].unionByName(parts[1]), ["k"])
    whole = states.value_states(df, ["k"], "v", "u")
    columns = [F.col(c).cast("double").alias(c) for c in states.STATE] + [states.distinct_estimate().alias("u"), states.mean().alias("m")]
    got, expected = (sorted(map(tuple, x.select("k", *columns, states.stddev_samp().alias("s")).collect())) for x in (merged, whole))
    assert got == expected
    exact = df.groupBy("k").agg(F.stddev_samp("v").alias("s")).collect()
    for r in exact:
        mine = next(g for g in got if g[0] == r.k)
        assert mine[-1] == (pytest.approx(r.s) if r.s is not None else None)


def test_states_of_no_rows(spark):
    empty = spark.createDataFrame([], "k string, v double")
    threshold = states.outlier_threshold(states.value_states(empty, ["k"], "v"))
    assert spark.range(3).filter(F.col("id") > threshold).count() == 0


# --- erasure -----------------------------------------------------------------------------------


def test_erasure_touches_the_subjects_days_only(spark, scratch):
    lake, out = f"{scratch}/lake", f"{scratch}/out"
    raw = events_as_raw(spark, SF_SMALL, with_region=False)
    raw.write.partitionBy("event_date").parquet(lake)
    days = [str(r[0]) for r in raw.select("event_date").distinct().collect()]
    run_daily_increment(spark, lake, out, days)
    assert len(subjects.refresh_subjects(spark, lake, "user_id")) == len(days)
    assert subjects.refresh_subjects(spark, lake, "user_id") == []
    victim = raw.groupBy("user_id").count().orderBy("count", "user_id").first()["user_id"]
    # rows that land after the index was made are found too
    raw.filter(F.col("event_date") == F.lit(days[0])).limit(1).withColumn("user_id", F.lit(victim)).write.mode("append").partitionBy(
        "event_date"
    ).parquet(lake)
    held = {str(r[0]) for r in spark.read.parquet(lake).filter(F.col("user_id") == victim).select("event_date").distinct().collect()}
    before, before_out = _files(lake), _files(out)
    gone = spark.createDataFrame([(victim,), (victim,)], "u string")
    touched = subjects.erase_indexed(spark, lake, gone, "user_id")
    assert set(touched) == held and 0 < len(held) < len(days)
    after = _files(lake)
    changed = {f.split("event_date=")[1][:10] for f in before.keys() ^ after.keys()}
    assert changed == held
    run_daily_increment(spark, lake, out, touched)
    same = [f for f, t in _files(out).items() if before_out.get(f) == t and "events_by_type_daily" in f]
    assert {f.split("event_date=")[1][:10] for f in same} == set(days) - held
    kept = raw.filter(F.col("user_id") != victim)
    got = spark.read.parquet(f"{out}/events_by_type_daily").select("event_date", "event_type", "event_count")
    expected = kept.groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias("event_count"))
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_erase_stored_keeps_layout_and_marks(spark, scratch):
    land, lake, ckpt = (f"{scratch}/{d}" for d in ("land", "lake", "ckpt"))
    os.makedirs(land)
    with open(f"{land}/a.json", "w") as f:
        f.write("\n".join(message(f"e{i}", user_id=f"u{i % 2}", ts=f"2026-03-0{1 + i // 2}T00:00:00+00:00") for i in range(6)) + "\n")
    ingest(spark, lake, ckpt, {"fmt": "files", "path": land})
    left = privacy.erase_stored(spark, lake, spark.createDataFrame([("u1",)], "user_id string"), "user_id")
    assert left.count() == 3 and sorted(d for d in os.listdir(lake) if "=" in d) == [f"event_date=2026-03-0{d}" for d in (1, 2, 3)]
    os.remove(f"{ckpt}/commits/0")
    os.remove(f"{ckpt}/commits/.0.crc")
    ingest(spark, lake, ckpt, {"fmt": "files", "path": land})  # the replay doesn't bring the rows back
    assert {r.user_id for r in read_raw(spark, lake).collect()} == {"u0"} and read_raw(spark, lake).count() == 3


# --- the cycle and the region counts --------------------------------------------------------------


def test_incremental_cycle_works_on_new_days_only(spark, scratch):
    land, lake, ckpt, out = (f"{scratch}/{d}" for d in ("land", "lake", "ckpt", "out"))
    os.makedirs(land)
    source = {"fmt": "files", "path": land}
    done = []
    for k, day in enumerate(("2026-03-03", "2026-03-04", None, "2026-03-03")):
        if day:
            with open(f"{land}/{k}.json", "w") as f:
                f.write(message(f"e{k}", ts=f"{day}T10:00:00+00:00") + "\n")
        done.append(run_incremental_cycle(spark, source, lake, ckpt, out, f"{scratch}/distinct")["days"])
    assert done == [["2026-03-03"], ["2026-03-04"], [], ["2026-03-03"]]
    totals = {r.question_id: r.total for r in spark.read.parquet(f"{out}/question_score_totals").collect()}
    assert totals == {100: 3} and read_raw(spark, f"{scratch}/distinct").count() == 3
    assert states.merge_states(spark.read.parquet(f"{out}/value_states"), []).first()["n"] == 3


def test_regions_are_counted_before_the_join(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = region_counts(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    top, below = plan.split("Join LeftOuter", 1)
    assert "Aggregate [event_date" in top and "Aggregate [" in below.split("Relation")[0]
    assert read_table(spark, SF_SMALL, "events").count() == region_counts(spark, SF_SMALL).agg(F.sum("event_count")).first()[0]
