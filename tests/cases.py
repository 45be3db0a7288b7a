"""Inputs shared by the tests: folders of the benchmark tables, event messages, raw rows."""

from __future__ import annotations

import json

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def message(
    event_id="e1",
    ts="2026-03-03T16:12:47+00:00",
    user_id="u1",
    region="UNKNOWN",
    event_type="SOCIAL_INTERACTION",
    payload="default",
    **payload_fields,
) -> str:
    """One event message as JSON text, payload fields overridable."""
    body = {
        "event_id": event_id,
        "event_type": event_type,
        "timestamp": ts,
        "user_id": user_id,
        "region": region,
        "source": "qa_api",
        "payload_version": 1,
    }
    if payload == "default":
        p = {
            "question_id": 100,
            "creation_date": 1772554367,
            "title": "A question",
            "score": 1,
            "answer_count": 0,
            "is_answered": False,
            "link": "/questions/100",
        }
        p.update(payload_fields)
        body["payload"] = p
    else:
        body["payload"] = payload
    return json.dumps(body)


def raw_from_messages(spark, messages: list[str]):
    from strata.operators.envelope import derive_time, parse_events

    df = spark.createDataFrame([(m,) for m in messages], "value string")
    return derive_time(parse_events(df))
