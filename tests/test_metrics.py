import datetime as dt

from cases import message, raw_from_messages
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.operators import metrics

D = dt.date(2026, 3, 3)
SENTINEL = dt.date(1970, 1, 1)


def test_time_parsing_edges(spark):
    msgs = [
        message("z", ts="2026-03-03T16:12:47Z"),
        message("off", ts="2026-03-03T16:12:47+00:00"),
        message("mid", ts="2026-03-03T23:30:00-05:00"),
        message("frac", ts="2026-03-03T16:12:47.123456+00:00"),
        message("junk", ts="junk"),
        message("none", ts=None),
    ]
    rows = {r.event_id: r for r in raw_from_messages(spark, msgs).collect()}
    assert rows["z"].event_time == rows["off"].event_time
    assert rows["mid"].event_date == dt.date(2026, 3, 4)
    for k in ("frac", "junk", "none"):
        assert rows[k].event_time is None
        assert rows[k].event_date == SENTINEL


def test_lenient_accepts_fraction(spark):
    from strata.operators.envelope import derive_time, parse_events

    df = spark.createDataFrame([(message("frac", ts="2026-03-03T16:12:47.123456+00:00"),)], "value string")
    row = derive_time(parse_events(df), lenient=True).first()
    assert row.event_date == D and row.event_time is not None


def test_bad_json_and_bad_fields(spark):
    msgs = [
        "not json",
        message("badfield", question_id="x"),
        message("overflow", score=99999999999),
    ]
    rows = raw_from_messages(spark, msgs).collect()
    bad = [r for r in rows if r.event_id is None]
    assert len(bad) == 1 and bad[0].event_date == SENTINEL and bad[0].payload is None
    by_id = {r.event_id: r for r in rows if r.event_id}
    assert by_id["badfield"].payload.question_id is None
    assert by_id["badfield"].payload.title == "A question"
    assert by_id["overflow"].payload.score is None


def _events(spark):
    msgs = [
        message("a", question_id=1, score=5, is_answered=True, region="EU"),
        message("b", question_id=2, score=None, is_answered=False, region="EU"),
        message("c", question_id=3, score=-2, is_answered=None, region="US"),
        message("d", payload=None),
        message("e", question_id=None, score=7),
        message("f", ts="junk", question_id=4, score=1),
    ]
    return raw_from_messages(spark, msgs)


def test_daily_counts_and_sentinel_group(spark):
    raw = _events(spark)
    by_type = {(r.event_date, r.event_type): r.event_count for r in metrics.events_by_type_daily(raw).collect()}
    assert by_type[(D, "SOCIAL_INTERACTION")] == 5
    assert by_type[(None, "SOCIAL_INTERACTION")] == 1
    by_part = {r.event_date: r.event_count for r in metrics.events_by_type_daily(raw, use_partition_date=True).collect()}
    assert by_part[SENTINEL] == 1
    regions = {(r.event_date, r.region): r.event_count for r in metrics.region_distribution(raw).collect()}
    assert regions[(D, "EU")] == 2 and regions[(D, "US")] == 1


def test_answered_rate_null_semantics(spark):
    rate = {r.event_date: r for r in metrics.answered_rate_daily(_events(spark)).collect()}[D]
    assert rate.total_questions == 5
    # answered: a; unanswered: b and e; c (null flag) and d (no payload) in the total only
    assert rate.answered == 1
    assert rate.unanswered == 2
    assert rate.answered + rate.unanswered <= rate.total_questions


def test_score_totals_skip_and_count_malformed(spark):
    obs = Observation("m")
    totals = {r.question_id: r.total for r in metrics.question_score_totals(_events(spark), obs).collect()}
    assert totals == {1: 5, 2: 0, 3: -2, 4: 1}
    assert obs.get["malformed_rows"] == 2


def test_repeat_question_sums_every_observation(spark):
    msgs = [message(f"r{i}", question_id=9, score=3) for i in range(3)]
    totals = metrics.question_score_totals(raw_from_messages(spark, msgs)).collect()
    assert [(r.question_id, r.total) for r in totals] == [(9, 9)]


def test_top_questions_ties_and_nulls(spark):
    msgs = [message(f"t{i:02d}", question_id=i, score=12) for i in range(12)]
    msgs.append(message("zz", question_id=99, score=None))
    top = metrics.top_questions_daily(raw_from_messages(spark, msgs)).collect()
    assert len(top) == 10
    assert sorted(r.question_id for r in top) == list(range(10))
    # null score sorts last
    msgs = [message("n", question_id=1, score=None), message("m", question_id=2, score=-5)]
    top = metrics.top_questions_daily(raw_from_messages(spark, msgs), k=1).collect()
    assert top[0].question_id == 2


def test_top_questions_distinct_option(spark):
    msgs = [message(f"x{i}", question_id=1, score=50) for i in range(5)] + [message("y", question_id=2, score=1)]
    raw = raw_from_messages(spark, msgs)
    assert len(metrics.top_questions_daily(raw, k=2).collect()) == 2
    qs = {r.question_id for r in metrics.top_questions_daily(raw, k=2, distinct_questions=True).collect()}
    assert qs == {1, 2}


def test_sorted_and_top_totals(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, -1)], "question_id long, total long")
    assert [r.question_id for r in metrics.sorted_score_totals(df).collect()] == [2, 3, 1, 4]
    assert [r.question_id for r in metrics.top_score_totals(df, 2).collect()] == [2, 3]


def test_properties_on_driver_tables(spark):
    from strata.sources.driver_tables import events_as_raw

    raw = events_as_raw(spark, "/root/testdata/sf0.001")
    n_by_day = {r.event_date: r["count"] for r in raw.groupBy("event_date").count().collect()}
    by_type = metrics.events_by_type_daily(raw).groupBy("event_date").agg(F.sum("event_count").alias("s"))
    assert {r.event_date: r.s for r in by_type.collect()} == n_by_day
    per_day = metrics.top_questions_daily(raw).groupBy("event_date").count().collect()
    assert all(r["count"] <= 10 for r in per_day)
    total = metrics.question_score_totals(raw).agg(F.sum("total")).first()[0]
    direct = raw.filter("payload.question_id is not null").agg(F.sum(F.coalesce(F.col("payload.score"), F.lit(0)))).first()[0]
    assert total == direct
