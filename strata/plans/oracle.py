"""Independent SQL (DuckDB dialect) for each registered query.

The same adapter as ``strata.sources.driver_tables`` written in plain SQL:
these strings share no code with the Spark side, so agreement is evidence.
Integer sums are cast to BIGINT (DuckDB sums to HUGEINT); money is summed as
DECIMAL(18,2) and cast to DOUBLE at the end on both sides.
"""

from __future__ import annotations

RAW_CTE = """
cust_region AS (
    SELECT c.c_custkey, r.r_name
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
ev AS (
    SELECT e.*, TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
    FROM events e
),
raw AS (
    SELECT
        CAST(e.event_id AS VARCHAR) AS event_id,
        e.event_type,
        strftime(e.ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp",
        CAST(e.user_id AS VARCHAR) AS user_id,
        COALESCE(cr.r_name, 'UNKNOWN') AS region,
        'qa_api' AS source,
        1 AS payload_version,
        e.event_id // 4 AS question_id,
        epoch_us(e.ts) // 1000000 AS creation_date,
        'Question ' || CAST(e.event_id // 4 AS VARCHAR) AS title,
        e.k AS score,
        e.k % 5 AS answer_count,
        CASE WHEN e.k % 3 = 0 THEN TRUE WHEN e.k % 3 = 1 THEN FALSE END AS is_answered,
        '/questions/' || CAST(e.event_id // 4 AS VARCHAR) AS link,
        date_trunc('second', e.ts) AS event_time,
        CAST(e.ts AS DATE) AS event_date
    FROM ev e
    LEFT JOIN cust_region cr ON e.user_id = cr.c_custkey
)"""


def with_raw(body: str, *extra_ctes: str) -> str:
    ctes = ",\n".join((RAW_CTE,) + extra_ctes)
    return f"WITH {ctes}\n{body}"


SILVER_CTE = """
silver AS (
    SELECT event_id, event_type, "timestamp" AS time_posted, user_id, source AS api_used,
           CAST(question_id AS VARCHAR) AS question_id,
           CAST(creation_date AS VARCHAR) AS creation_date,
           title, score, answer_count, is_answered, link
    FROM raw
)"""

# The newest observation of each question: newest day, newest time, smallest id; unknown times are newest.
CLEAN_CTE = """
timed AS (SELECT * REPLACE (TRY_CAST(time_posted AS TIMESTAMP) AS time_posted) FROM silver),
clean AS (
    SELECT DISTINCT ON (question_id) *
    FROM timed
    ORDER BY question_id, time_posted::DATE DESC NULLS FIRST, time_posted DESC NULLS FIRST, event_id NULLS LAST
)"""
