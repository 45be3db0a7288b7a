"""Random event batches: metrics equal a plain-Python brute force."""

from collections import Counter, defaultdict

from cases import message, raw_from_messages
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import medallion, metrics

DAYS = ["2026-03-01", "2026-03-02", "2026-03-03"]

event = st.fixed_dictionaries(
    {
        "day": st.sampled_from(DAYS + ["junk"]),
        "hour": st.integers(0, 23),
        "question_id": st.one_of(st.none(), st.integers(1, 6)),
        "score": st.one_of(st.none(), st.integers(-5, 20)),
        "is_answered": st.one_of(st.none(), st.booleans()),
        "user": st.sampled_from(["u1", "u2", "u3", None]),
    }
)


def _messages(rows):
    out = []
    for i, r in enumerate(rows):
        ts = "junk" if r["day"] == "junk" else f"{r['day']}T{r['hour']:02d}:00:00+00:00"
        out.append(
            message(
                f"e{i:04d}", ts=ts, user_id=r["user"], question_id=r["question_id"],
                score=r["score"], is_answered=r["is_answered"],
            )
        )
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=40))
def test_metrics_match_brute_force(spark, rows):
    raw = raw_from_messages(spark, _messages(rows))
    import datetime as dt

    def day(r):
        return None if r["day"] == "junk" else dt.date.fromisoformat(r["day"])

    # rows per day
    got = {r.event_date: r.event_count for r in metrics.events_by_type_daily(raw).collect()}
    assert got == dict(Counter(day(r) for r in rows))

    # answered rate
    want = defaultdict(lambda: [0, 0, 0])
    for r in rows:
        w = want[day(r)]
        w[0] += 1
        w[1] += r["is_answered"] is True
        w[2] += r["is_answered"] is False
    got = {r.event_date: [r.total_questions, r.answered, r.unanswered] for r in metrics.answered_rate_daily(raw).collect()}
    assert got == dict(want)

    # score totals over keyed rows
    want_tot = defaultdict(int)
    for r in rows:
        if r["question_id"] is not None:
            want_tot[r["question_id"]] += r["score"] or 0
    got = {r.question_id: r.total for r in metrics.question_score_totals(raw).collect()}
    assert got == dict(want_tot)

    # top-10 per day: ranked by score desc (nulls last), then event id
    by_day = defaultdict(list)
    for i, r in enumerate(rows):
        by_day[day(r)].append((r["score"] is None, -(r["score"] or 0), f"e{i:04d}", r["question_id"]))
    want_top = Counter((d, q) for d, items in by_day.items() for *_, q in sorted(items)[:10])
    got_top = Counter((r.event_date, r.question_id) for r in metrics.top_questions_daily(raw).collect())
    assert got_top == want_top

    # clean silver: one row per question id (nulls collapse to one)
    clean = medallion.clean_silver(medallion.to_silver(raw)).collect()
    assert len(clean) == len({r["question_id"] for r in rows})
