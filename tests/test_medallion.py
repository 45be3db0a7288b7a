import datetime as dt

import pytest
from cases import message, raw_from_messages
from pyspark.sql import functions as F

from strata.operators import medallion


def test_reload_dedupe_and_new_ids(spark):
    rows = [message(f"e{i}", question_id=i % 2, score=i) for i in range(4)]
    raw = raw_from_messages(spark, rows)
    twice = medallion.load_bronze(medallion.load_bronze(None, raw), raw)
    assert twice.count() == 8
    assert medallion.dedupe_bronze(twice).count() == 4
    # same content with fresh event ids survives bronze, merges in clean silver
    renamed = raw_from_messages(spark, [message(f"n{i}", question_id=i % 2, score=i) for i in range(4)])
    bronze = medallion.dedupe_bronze(medallion.load_bronze(medallion.load_bronze(None, raw), renamed))
    assert bronze.count() == 8
    clean = medallion.clean_silver(medallion.to_silver(bronze))
    assert clean.count() == 2


def test_load_bronze_matches_names_case_insensitively(spark):
    staged = spark.createDataFrame([("x1", "CLICK", 7)], "EVENT_ID string, Event_Type string, junk int")
    out = medallion.load_bronze(None, staged).first()
    assert out.event_id == "x1" and out.event_type == "CLICK" and out.payload is None


def test_silver_shape(spark):
    raw = raw_from_messages(spark, [message("a", question_id=42, creation_date=1700000000)])
    s = medallion.to_silver(raw)
    assert s.columns[:5] == ["event_id", "event_type", "time_posted", "user_id", "api_used"]
    r = s.first()
    assert r.question_id == "42" and r.creation_date == "1700000000"
    assert "region" not in s.columns and "payload_version" not in s.columns


def test_clean_keeps_latest_and_collapses_null_ids(spark):
    rows = [
        message("a", ts="2026-03-01T10:00:00+00:00", question_id=1, score=1),
        message("b", ts="2026-03-03T09:00:00+00:00", question_id=1, score=2),
        message("c", ts="2026-03-03T11:00:00+00:00", question_id=1, score=3),
        message("d", question_id=None, score=4),
        message("e", question_id=None, score=5),
        message("f", ts="2026-03-03T23:30:00-05:00", question_id=2, score=6),
    ]
    clean = medallion.clean_silver(medallion.to_silver(raw_from_messages(spark, rows)))
    got = {r.question_id: r for r in clean.collect()}
    assert set(got) == {"1", "2", None}
    assert got["1"].event_id == "c"
    # zone-less silver time keeps the wall clock of the text
    assert got["2"].time_posted == dt.datetime(2026, 3, 3, 23, 30)
    assert clean.groupBy("question_id").count().filter("count > 1").count() == 0


def test_null_time_wins_under_desc_nulls_first(spark):
    rows = [
        message("a", ts="2026-03-03T10:00:00+00:00", question_id=1),
        message("b", ts="junk", question_id=1),
    ]
    clean = medallion.clean_silver(medallion.to_silver(raw_from_messages(spark, rows)))
    assert clean.first().event_id == "b"


def test_gold_tables(spark):
    rows = [
        message("a", question_id=1, user_id="u1", score=5, is_answered=True),
        message("b", question_id=2, user_id="u1", score=5, is_answered=False),
        message("c", question_id=3, user_id="u2", score=None, is_answered=None),
        message("d", question_id=None, user_id="u3", score=1),
    ]
    clean = medallion.clean_silver(medallion.to_silver(raw_from_messages(spark, rows)))
    rate = medallion.gold_answer_rate_daily(clean).first()
    assert (rate.total_questions, rate.questions_answered, rate.questions_not_answered) == (3, 1, 2)
    users = {r.is_repeat_user: r.user_count for r in medallion.gold_returning_users(clean).collect()}
    assert users == {"Returning_user": 1, "One_time_user": 2}
    hist = {r.score: r.score_count for r in medallion.gold_score_distribution(clean).collect()}
    assert hist == {5: 2, None: 0, 1: 1}
    fact = medallion.behavioral_fact(clean)
    assert "creation_date" not in fact.columns
    assert medallion.user_dimension(fact).count() == 3
    qd = medallion.question_dimension(fact)
    assert qd.columns == ["question_id", "time_posted", "title", "score", "answer_count", "is_answered", "link"]


def test_medallion_job_writes_all_layers(spark):
    from strata.plans.jobs import run_medallion
    from strata.sources.driver_tables import events_as_raw

    counts = run_medallion(spark, events_as_raw(spark, "/root/testdata/sf0.001"), prefix="t1_")
    assert counts["t1_bronze.raw_event_table"] == 1000
    assert counts["t1_silver.cleaned_silver_table"] == 250
    assert counts["t1_gold.question_dimension_table"] == 250
    # rerun over existing tables replaces them (self-read goes through staging)
    again = run_medallion(spark, events_as_raw(spark, "/root/testdata/sf0.001"), prefix="t1_")
    assert again == counts
    unique = spark.table("t1_silver.cleaned_silver_table").groupBy("question_id").count()
    assert unique.filter(F.col("count") > 1).count() == 0


def test_silver_from_variant_payload(spark):
    raw = raw_from_messages(spark, [message("a", question_id=42, score=-3, is_answered=True)])
    as_variant = raw.withColumn("payload", F.parse_json(F.to_json("payload")))
    bad = spark.createDataFrame([("b",)], "event_id string").select(
        "event_id", F.parse_json(F.lit('{"question_id": "x", "score": "many"}')).alias("payload")
    )
    both = as_variant.select("event_id", "payload").unionByName(bad)
    both = both.join(raw.drop("payload"), "event_id", "left")
    rows = {r.event_id: r for r in medallion.to_silver(both).collect()}
    struct_row = medallion.to_silver(raw).first()
    assert rows["a"].asDict() == struct_row.asDict()
    assert rows["b"].question_id == "x" and rows["b"].score is None


def test_clean_prefers_latest_ingest_when_metadata_kept(spark):
    import datetime as _dt

    from strata.streaming import stream_to_raw

    same = "2026-03-03T10:00:00+00:00"
    rows = [
        (message("z-ingested-last", ts=same, question_id=1, score=1).encode(), 0, 9, _dt.datetime(2026, 3, 3, 10, 5)),
        (message("a-ingested-first", ts=same, question_id=1, score=2).encode(), 0, 5, _dt.datetime(2026, 3, 3, 10, 1)),
    ]
    topic_like = spark.createDataFrame(rows, "value binary, partition int, offset long, timestamp timestamp")
    raw = stream_to_raw(topic_like, keep_metadata=True)
    clean = medallion.clean_silver(medallion.to_silver(raw)).collect()
    assert [r.event_id for r in clean] == ["z-ingested-last"]
    assert "_offset" not in clean[0].asDict()
    # without metadata the event id decides
    plain = medallion.clean_silver(medallion.to_silver(stream_to_raw(topic_like))).collect()
    assert [r.event_id for r in plain] == ["a-ingested-first"]


def test_conform_matches_nested_fields_by_name(spark):
    staged = spark.sql(
        "SELECT 'e' AS EVENT_ID, named_struct('LINK', 'l', 'title', 't', 'extra', 1, 'score', '7') AS Payload, 1 AS other"
    )
    r = medallion.conform(staged).first()
    assert (r.event_id, r.payload.title, r.payload.link, r.payload.score) == ("e", "t", "l", 7)
    assert r.payload.question_id is None and r.region is None


def test_conform_keeps_null_structs_and_refuses_ambiguous_names(spark):
    none = spark.sql("SELECT 'e' AS event_id, cast(null AS struct<title:string>) AS payload")
    assert medallion.conform(none).first().payload is None
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        twice = spark.sql("SELECT 1 AS event_id, 2 AS Event_Id")
        with pytest.raises(ValueError, match="only in case"):
            medallion.conform(twice)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_event_ids_tell_null_from_empty(spark):
    from strata.operators.envelope import _event_id

    rows = spark.createDataFrame([(None,), ("",), ("=",)], "a string").select(_event_id(["a"]).alias("i"))
    assert rows.distinct().count() == 3
