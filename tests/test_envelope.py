import json

from strata.operators import envelope


def _pages(spark, pages):
    return spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(pages)], "page_no int, value string")


def test_pages_to_items_and_envelope(spark):
    pages = [
        {
            "items": [
                {"question_id": 7, "creation_date": 1772554367, "title": "t", "score": 2,
                 "answer_count": 1, "is_answered": False, "link": "/q/7", "owner": {"user_id": 55}},
                {"question_id": 8, "creation_date": None, "title": "u", "score": 0},
                {"creation_date": 1772554367},
            ],
            "has_more": True,
        },
        {"has_more": False},
        {"items": []},
    ]
    items = envelope.items_from_pages(_pages(spark, pages))
    assert items.count() == 3
    ev = envelope.build_envelope(items).collect()
    by_q = {r.payload.question_id: r for r in ev}
    assert by_q[7].user_id == "55"
    assert by_q[7].timestamp == "2026-03-03T16:12:47+00:00"
    assert by_q[8].user_id == "anon-8"
    assert by_q[None].user_id == "anon-unknown"
    # a missing creation time becomes "now" with microseconds
    assert "." in by_q[8].timestamp
    assert all(r.event_type == "SOCIAL_INTERACTION" and r.payload_version == 1 for r in ev)
    assert len({r.event_id for r in ev}) == 3


def test_deterministic_ids(spark):
    items = envelope.items_from_pages(_pages(spark, [{"items": [{"question_id": 1, "creation_date": 5}]}]))
    a = envelope.build_envelope(items, id_columns=["question_id", "creation_date"]).first().event_id
    b = envelope.build_envelope(items, id_columns=["question_id", "creation_date"]).first().event_id
    assert a == b and len(a) == 36


def test_messages_roundtrip_keeps_nulls(spark):
    items = envelope.items_from_pages(_pages(spark, [{"items": [{"question_id": 1, "creation_date": 1772554367}]}]))
    events = envelope.build_envelope(items)
    msg = envelope.to_messages(events).first()
    body = json.loads(msg.value)
    assert msg.key == body["event_id"]
    assert body["payload"]["score"] is None and "score" in body["payload"]
    back = envelope.derive_time(envelope.parse_events(envelope.to_messages(events))).first()
    assert back.payload.question_id == 1 and str(back.event_date) == "2026-03-03"


def test_load_time_and_landing_roundtrip(spark, scratch):
    import os

    from strata.operators import medallion
    from strata.sinks import write_messages_text
    from strata.sources.driver_tables import events_as_raw

    raw = events_as_raw(spark, "/root/testdata/sf0.001", with_region=False)
    b1 = medallion.load_bronze(None, raw, with_load_time=True)
    assert b1.filter("_loaded_at is null").count() == 0
    b2 = medallion.load_bronze(b1, raw, with_load_time=True)
    assert b2.count() == 2000 and "_loaded_at" in b2.columns
    landing = os.path.join(scratch, "landing")
    write_messages_text(raw, landing)
    back = envelope.derive_time(envelope.parse_events(spark.read.text(landing)))
    cols = ["event_id", "timestamp", "user_id", "event_date"]
    assert back.select(cols).exceptAll(raw.select(cols)).count() == 0 and back.count() == 1000


def test_publish_pages_fixes_ids_once(spark, scratch):
    import os

    from strata.plans.jobs import publish_pages
    from strata.sources.driver_tables import events_as_pages

    landing = os.path.join(scratch, "landing")
    events = publish_pages(spark, events_as_pages(spark, "/root/testdata/sf0.001"), landing_path=landing)
    ids = {r.event_id for r in events.select("event_id").collect()}
    again = {r.event_id for r in events.select("event_id").collect()}
    landed = envelope.parse_events(spark.read.text(landing))
    assert len(ids) == 1000 and ids == again
    assert {r.event_id for r in landed.select("event_id").collect()} == ids
