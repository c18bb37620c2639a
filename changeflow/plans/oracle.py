"""SQL that gives the result of every query, for a second engine on the same tables."""

from __future__ import annotations

TOP = "(SELECT MAX(event_id) + 1 FROM events)"


def v(percent: int) -> str:
    """The version at a percentage of the version range."""
    return f"({TOP} * {percent} // 100)"


PRELUDE = f"""
e AS (
  SELECT event_id, user_id, event_type, value, props, ts,
         LAG(event_type) OVER w AS p_type, LAG(value) OVER w AS p_value, LAG(props) OVER w AS p_props
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
c AS (
  SELECT *, event_type = 'error' AS is_del, (p_type IS NOT NULL AND p_type <> 'error') AS alive FROM e),
feed AS (
  SELECT user_id, event_type AS segment, value AS score, props AS note, 'insert' AS _change_type,
         event_id + 1 AS _commit_version, ts AS _commit_timestamp FROM c WHERE NOT is_del AND NOT alive
  UNION ALL SELECT user_id, p_type, p_value, p_props, 'update_preimage', event_id + 1, ts
  FROM c WHERE NOT is_del AND alive
  UNION ALL SELECT user_id, event_type, value, props, 'update_postimage', event_id + 1, ts
  FROM c WHERE NOT is_del AND alive
  UNION ALL SELECT user_id, p_type, p_value, p_props, 'delete', event_id + 1, ts
  FROM c WHERE is_del AND alive),
raw AS (
  SELECT user_id, event_type AS segment, CAST(FLOOR(value / 25) AS BIGINT) AS tier,
         CASE WHEN event_type = 'error' THEN 'DELETE' WHEN event_type = 'signup' THEN 'INSERT'
              ELSE 'UPDATE' END AS operation,
         date_trunc('hour', CASE WHEN event_id % 7 = 0 THEN ts - INTERVAL 6 HOURS ELSE ts END) AS updated_at,
         event_id + 1 AS _commit_version
  FROM events),
raw_note AS (
  SELECT r.*, CASE WHEN r._commit_version >= {v(50)} THEN ev.props END AS note
  FROM raw r JOIN events ev ON ev.event_id + 1 = r._commit_version),
commits AS (
  SELECT 'users' AS source, event_id + 1 AS version, ts AS "timestamp",
         CASE WHEN is_del AND alive THEN 'DELETE' WHEN is_del THEN 'OPTIMIZE'
              WHEN alive THEN 'UPDATE' ELSE 'INSERT' END AS operation,
         NOT (event_id + 1 BETWEEN {v(40)} AND {v(45)}) AS feed_enabled,
         event_id + 1 > {v(10)} AS retained
  FROM c),
source_commits AS (
  SELECT event_type AS source, event_id + 1 AS version,
         NOT (event_id + 1 BETWEEN {v(40)} AND {v(45)}) AS feed_enabled,
         event_id + 1 > {v(10)} AS retained
  FROM events),
source_progress AS (
  SELECT source, CASE source WHEN 'click' THEN top WHEN 'view' THEN top * 5 // 100
                             WHEN 'purchase' THEN top * 43 // 100 WHEN 'signup' THEN top - 100
                             ELSE top - 101 END AS last_version
  FROM (SELECT source, MAX(version) AS top FROM source_commits GROUP BY source)),
people AS (
  SELECT c_custkey AS employee_id, c_name AS name, c_mktsegment AS department, r_name AS state,
         LPAD(CAST(c_custkey AS VARCHAR), 9, '0') AS tfn, CAST(c_acctbal AS DECIMAL(10,2)) AS salary
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
regional AS (
  SELECT s_name AS principal, s_acctbal AS balance, r_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
principals AS (
  SELECT principal, r_name AS group_name FROM regional
  UNION ALL SELECT principal, 'HR' FROM regional WHERE balance > 8000
  UNION ALL SELECT principal, 'Finance' FROM regional WHERE balance > 6000 AND balance <= 9000
  UNION ALL SELECT principal, 'platform-admins' FROM regional WHERE balance < 0
  UNION ALL SELECT principal, 'admins' FROM regional WHERE balance < -500),
last_images AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY _commit_version DESC) AS rn
    FROM feed WHERE _change_type <> 'update_preimage') WHERE rn = 1),
live AS (
  SELECT user_id, segment, score, note, _commit_version AS last_commit_version
  FROM last_images WHERE _change_type <> 'delete'),
state_rows AS (
  SELECT user_id,
         CASE WHEN _change_type <> 'delete' THEN segment END AS segment,
         CASE WHEN _change_type <> 'delete' THEN score END AS score,
         CASE WHEN _change_type <> 'delete' THEN note END AS note,
         _commit_version AS last_commit_version, _change_type = 'delete' AS is_deleted
  FROM last_images)
"""


def snapshot(name: str, version: str) -> str:
    """A table expression: the live rows at a version."""
    return f"""{name} AS (
  SELECT user_id, segment, score, note, _commit_version AS last_commit_version FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY _commit_version DESC) AS rn
    FROM feed WHERE _change_type <> 'update_preimage' AND _commit_version <= {version})
  WHERE rn = 1 AND _change_type <> 'delete')"""


def scd2(name: str, source: str, track: list[str]) -> str:
    """Table expressions: the Type 2 dimension of a raw table, and the events kept for it."""
    lags = ", ".join(f"LAG({c}) OVER w AS p_{c}" for c in track)
    same = " AND ".join(f"{c} IS NOT DISTINCT FROM p_{c}" for c in track)
    columns = ", ".join(track)
    return f"""{name}_seen AS (
  SELECT *, operation = 'DELETE' AS gone, LAG(operation = 'DELETE') OVER w AS p_gone, {lags}
  FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY updated_at, _commit_version)),
{name}_kept AS (
  SELECT * FROM {name}_seen
  WHERE NOT ((gone AND COALESCE(p_gone, TRUE)) OR (NOT gone AND COALESCE(NOT p_gone, FALSE) AND {same}))),
{name} AS (
  SELECT * EXCLUDE (gone) FROM (
    SELECT user_id, {columns}, gone, updated_at AS __START_AT, _commit_version AS __START_VERSION,
           LEAD(updated_at) OVER w AS __END_AT, LEAD(_commit_version) OVER w AS __END_VERSION
    FROM {name}_kept WINDOW w AS (PARTITION BY user_id ORDER BY updated_at, _commit_version))
  WHERE NOT gone)"""


def latest_raw(name: str, condition: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY updated_at DESC, _commit_version DESC) AS rn
    FROM raw WHERE {condition}) WHERE rn = 1)"""


MANUAL_DIM = (
    latest_raw("first_half", f"_commit_version <= {v(50)}")
    + f""",
dim AS (
  SELECT user_id, segment, tier, updated_at AS start_date, CAST(NULL AS TIMESTAMP) AS end_date,
         TRUE AS is_current FROM first_half WHERE operation <> 'DELETE'),
later AS (SELECT * FROM raw WHERE _commit_version > {v(50)})"""
)

DIFFERS = "(i.segment IS DISTINCT FROM d.segment OR i.tier IS DISTINCT FROM d.tier)"


def stepped(batch: str) -> str:
    """Table expressions: one manual Type 2 step of a batch onto dim."""
    return f"""closing AS (
  SELECT i.user_id, MIN(i.updated_at) AS closed_at FROM {batch} i
  JOIN dim d ON d.user_id = i.user_id AND d.is_current
  WHERE i.operation <> 'DELETE' AND {DIFFERS} GROUP BY i.user_id),
closed AS (
  SELECT d.user_id, segment, tier, start_date,
         CASE WHEN is_current AND closed_at IS NOT NULL THEN closed_at ELSE end_date END AS end_date,
         is_current AND closed_at IS NULL AS is_current
  FROM dim d LEFT JOIN closing USING (user_id)),
added AS (
  SELECT i.user_id, i.segment, i.tier, i.updated_at, CAST(NULL AS TIMESTAMP), TRUE
  FROM {batch} i LEFT JOIN closed d ON d.user_id = i.user_id AND d.is_current
  WHERE i.operation <> 'DELETE' AND (d.user_id IS NULL OR {DIFFERS})),
deleting AS (
  SELECT user_id, MAX(updated_at) AS deleted_at FROM {batch} WHERE operation = 'DELETE' GROUP BY user_id),
stepped AS (
  SELECT a.user_id, segment, tier, start_date,
         CASE WHEN is_current AND deleted_at IS NOT NULL THEN deleted_at ELSE end_date END AS end_date,
         is_current AND deleted_at IS NULL AS is_current
  FROM (SELECT * FROM closed UNION ALL SELECT * FROM added) a LEFT JOIN deleting USING (user_id))"""


def sql(body: str, *tables: str) -> str:
    return "WITH " + ",\n".join([PRELUDE.strip(), *tables]) + "\n" + body.strip()


DIM2 = scd2("dim2", "raw", ["segment", "tier"])
SNAP_50 = snapshot("snap", v(50))
IMAGES = """images AS (
  SELECT a.user_id, a._commit_version, a._commit_timestamp,
         b.segment AS segment_before, a.segment AS segment_after, b.score AS score_before,
         a.score AS score_after, b.note AS note_before, a.note AS note_after
  FROM feed a JOIN feed b ON a.user_id = b.user_id AND a._commit_version = b._commit_version
  WHERE a._change_type = 'update_postimage' AND b._change_type = 'update_preimage')"""
LOCAL_EARLY = f"""local_early AS (
  SELECT * REPLACE (CASE WHEN _commit_version <= {v(30)} THEN updated_at - INTERVAL 10 HOURS
                         ELSE updated_at END AS updated_at) FROM raw)"""
CHANGED_CUSTOMER = """
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, 'HOUSING' AS c_mktsegment
  FROM customer WHERE c_mktsegment = 'BUILDING' AND NOT c_acctbal < 0"""
NEW_CUSTOMER = """
  SELECT s_suppkey + 1000000000 AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey,
         s_acctbal AS c_acctbal, 'NEW' AS c_mktsegment FROM supplier"""
HISTORY = """
  SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS captured_at, CAST(_commit_timestamp AS DATE) AS commit_date
  FROM feed"""
LEDGER = """facts AS (
  SELECT p.source, MAX(p.last_version) AS last_version, MAX(version) AS current_version,
         MAX_BY(feed_enabled, version) AS enabled_now,
         MIN(version) FILTER (WHERE retained) AS first_retained,
         MIN_BY(retained, version) FILTER (WHERE version > last_version) AS next_retained,
         COALESCE(BOOL_OR(version > last_version AND NOT feed_enabled), FALSE) AS gap_unread,
         MAX(version) - MAX(p.last_version) AS lag
  FROM source_progress p JOIN source_commits USING (source) GROUP BY p.source)"""
METRICS = """
  SELECT segment, COUNT(*) AS "rows", CAST(SUM(CAST(score AS DECIMAL(18,2))) AS DOUBLE) AS score_sum
  FROM live GROUP BY segment"""
VISIBLE = """seen AS (
  SELECT principal, BOOL_OR(group_name = 'platform-admins') AS bypasses,
         BOOL_OR(group_name IN ('admins', 'platform-admins')) AS excluded FROM principals GROUP BY principal),
counts AS (
  SELECT s.principal, s.excluded,
         (SELECT COUNT(*) FROM people WHERE s.bypasses OR state IN (
            SELECT group_name FROM principals p WHERE p.principal = s.principal)) AS visible_rows,
         (SELECT COUNT(*) FROM people WHERE salary >= 0 AND (s.bypasses OR state IN (
            SELECT group_name FROM principals p WHERE p.principal = s.principal))) AS expected_rows
  FROM seen s)"""


def secured(filtered: str | None = None, tfn: bool = True, salary: bool = True) -> str:
    return sql(
        "SELECT employee_id, name, department, state, "
        + ("tfn" if tfn else "'XXX' AS tfn")
        + ", "
        + ("salary" if salary else "CAST(NULL AS DECIMAL(10,2)) AS salary")
        + " FROM people"
        + (f" WHERE state IN ({filtered})" if filtered else "")
    )


ORACLE_SQL: dict[str, str] = {
    # sources and scans
    "changes_between": sql(f"SELECT * FROM feed WHERE _commit_version BETWEEN {v(20)} AND {v(60)}"),
    "changes_since": sql("""
        SELECT * FROM feed
        WHERE _commit_version >= (SELECT MIN(version) FROM commits WHERE "timestamp" >= TIMESTAMP '2024-01-10 00:00:00')
          AND _commit_version <= (SELECT MAX(version) FROM commits WHERE "timestamp" <= TIMESTAMP '2024-01-20 12:00:00')"""),
    "stream_changes": sql(f"SELECT * FROM feed WHERE _commit_version >= {v(20)}"),
    "current_snapshot": sql("SELECT * FROM live"),
    "snapshot_as_of": sql("SELECT * FROM snap", SNAP_50),
    "commit_history": sql(f"SELECT * FROM commits WHERE version BETWEEN {v(40)} AND {v(45)}"),
    "feed_enabled_ranges": sql("""
        SELECT source, feed_enabled, MIN(version) AS first_version, MAX(version) AS last_version,
               COUNT(*) AS commits
        FROM (SELECT *, SUM(CASE WHEN feed_enabled IS DISTINCT FROM before THEN 1 ELSE 0 END)
                          OVER (PARTITION BY source ORDER BY version) AS island
              FROM (SELECT *, LAG(feed_enabled) OVER (PARTITION BY source ORDER BY version) AS before
                    FROM commits))
        GROUP BY source, feed_enabled, island"""),
    "rows_by_file_time": sql(f"SELECT * FROM feed WHERE _commit_version > {v(50)}"),
    "stream_table": sql("SELECT * FROM raw"),
    "policy_audit_trail": """
        SELECT ts AS event_time, event_type AS action_name, CAST(user_id AS VARCHAR) AS actor,
               props AS policy_name, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code
        FROM events WHERE event_id % 2 = 0 AND event_type IN ('error', 'signup')""",
    # sinks and writes
    "publish_snapshot": sql("SELECT * FROM live"),
    "run_feed_stream": sql("SELECT COUNT(*) AS sink_rows, MAX(_commit_version) AS last_version FROM feed"),
    "capture_history": sql(HISTORY),
    "write_partitioned_history": sql(HISTORY),
    "widen_and_append": sql(f"""
        SELECT * REPLACE (CASE WHEN _commit_version > {v(50)} THEN note END AS note) FROM feed"""),
    "apply_dml_state": f"""
        SELECT * FROM customer WHERE NOT c_acctbal < 0 AND c_mktsegment <> 'BUILDING'
        UNION ALL {CHANGED_CUSTOMER} UNION ALL {NEW_CUSTOMER}""",
    "apply_dml_feed": f"""
        SELECT *, CAST(2 AS BIGINT) AS _commit_version, TIMESTAMP '2024-02-01 00:00:00' AS _commit_timestamp
        FROM (
          SELECT *, 'delete' AS _change_type FROM customer WHERE c_acctbal < 0
          UNION ALL SELECT *, 'update_preimage' FROM customer
          WHERE c_mktsegment = 'BUILDING' AND NOT c_acctbal < 0
          UNION ALL SELECT *, 'update_postimage' FROM ({CHANGED_CUSTOMER})
          UNION ALL SELECT *, 'insert' FROM ({NEW_CUSTOMER}))""",
    "enforce_not_null": sql("""
        SELECT user_id, last_commit_version,
               CASE WHEN is_deleted THEN 'segment,score' ELSE '' END AS null_columns FROM state_rows"""),
    "append_only_audit": sql("""
        SELECT *, CAST(1 AS BIGINT) AS lost_copies FROM feed
        WHERE _change_type = 'delete' OR segment = 'purchase'"""),
    "retention_profile": sql("""
        SELECT grain, period, "rows", CAST(SUM("rows") OVER (PARTITION BY grain ORDER BY period) AS BIGINT)
               AS rows_so_far, 'daily' AS advice
        FROM (
          SELECT 'day' AS grain, CAST(_commit_timestamp AS DATE) AS period, COUNT(*) AS "rows" FROM feed GROUP BY 2
          UNION ALL
          SELECT 'month', CAST(date_trunc('month', _commit_timestamp) AS DATE), COUNT(*) FROM feed GROUP BY 2)"""),
    # projections, filters, predicates
    "safe_cdf_read": sql(f"""
        SELECT user_id, segment, CAST(NULL AS INTEGER) AS added_later, score,
               _change_type, _commit_version, _commit_timestamp
        FROM feed WHERE _commit_version >= {v(30)}"""),
    "filter_change_type": sql(
        "SELECT * FROM feed WHERE _change_type IN ('update_preimage', 'update_postimage')"
    ),
    "expect_or_drop": sql("SELECT * FROM feed WHERE score >= 10"),
    "changed_columns": sql("""
        SELECT user_id, _commit_version, concat_ws(',',
                 CASE WHEN segment_before IS DISTINCT FROM segment_after THEN 'segment' END,
                 CASE WHEN score_before IS DISTINCT FROM score_after THEN 'score' END,
                 CASE WHEN note_before IS DISTINCT FROM note_after THEN 'note' END) AS changed
        FROM images""", IMAGES),
    "tombstones": sql(
        "SELECT user_id, _commit_version, TRUE AS is_deleted FROM feed WHERE _change_type = 'delete'"
    ),
    "drift_impact": sql("""
        SELECT 'tier' AS suspect, COUNT(tier) AS non_null_rows, COUNT(DISTINCT tier) AS distinct_values,
               MIN(_commit_version) FILTER (WHERE tier IS NOT NULL) AS first_version,
               COUNT(*) FILTER (WHERE quiet AND tier IS DISTINCT FROM p_tier) AS spurious_versions FROM q
        UNION ALL
        SELECT 'note', COUNT(note), COUNT(DISTINCT note),
               MIN(_commit_version) FILTER (WHERE note IS NOT NULL),
               COUNT(*) FILTER (WHERE quiet AND note IS DISTINCT FROM p_note) FROM q""",
        """q AS (
          SELECT *, COALESCE(NOT gone AND NOT p_gone AND segment IS NOT DISTINCT FROM p_segment, FALSE) AS quiet
          FROM (
            SELECT *, operation = 'DELETE' AS gone, LAG(operation = 'DELETE') OVER w AS p_gone,
                   LAG(segment) OVER w AS p_segment, LAG(tier) OVER w AS p_tier, LAG(note) OVER w AS p_note
            FROM raw_note WINDOW w AS (PARTITION BY user_id ORDER BY updated_at, _commit_version)))"""),
    "drift_profile": sql("""
        SELECT 'segment' AS "column", COUNT(*) AS rows, COUNT(segment) AS non_null_rows,
               MIN(_commit_version) FILTER (WHERE segment IS NOT NULL) AS first_version,
               TRUE AS distinct_near, NULL::BOOLEAN AS median_near FROM raw_note
        UNION ALL SELECT 'tier', COUNT(*), COUNT(tier), MIN(_commit_version) FILTER (WHERE tier IS NOT NULL), TRUE, TRUE
        FROM raw_note
        UNION ALL SELECT 'note', COUNT(*), COUNT(note), MIN(_commit_version) FILTER (WHERE note IS NOT NULL), TRUE, NULL
        FROM raw_note"""),
    "profile_shift": sql(f"""
        SELECT 'segment' AS "column", COUNT(segment) FILTER (WHERE _commit_version < {v(50)}) AS non_null_before, COUNT(segment) FILTER (WHERE NOT _commit_version < {v(50)}) AS non_null_after,
               COUNT(segment) FILTER (WHERE _commit_version < {v(50)}) = 0 AS was_empty,
               COUNT(DISTINCT segment) > COUNT(DISTINCT segment) FILTER (WHERE _commit_version < {v(50)}) AS has_new_values FROM raw_note
        UNION ALL SELECT 'tier', COUNT(tier) FILTER (WHERE _commit_version < {v(50)}) AS non_null_before, COUNT(tier) FILTER (WHERE NOT _commit_version < {v(50)}) AS non_null_after,
               COUNT(tier) FILTER (WHERE _commit_version < {v(50)}) = 0 AS was_empty,
               COUNT(DISTINCT tier) > COUNT(DISTINCT tier) FILTER (WHERE _commit_version < {v(50)}) AS has_new_values FROM raw_note
        UNION ALL SELECT 'note', COUNT(note) FILTER (WHERE _commit_version < {v(50)}) AS non_null_before, COUNT(note) FILTER (WHERE NOT _commit_version < {v(50)}) AS non_null_after,
               COUNT(note) FILTER (WHERE _commit_version < {v(50)}) = 0 AS was_empty,
               COUNT(DISTINCT note) > COUNT(DISTINCT note) FILTER (WHERE _commit_version < {v(50)}) AS has_new_values FROM raw_note"""),
    "incremental_slice": sql(f"SELECT * FROM feed WHERE _commit_version > {v(70)}"),
    "history_audit": sql(f"""
        SELECT * FROM ({HISTORY})
        WHERE commit_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND user_id = 7"""),
    "entity_history": sql(f"SELECT * FROM ({HISTORY}) WHERE user_id = 7"),
    "null_semantics_diff": sql("""
        SELECT COALESCE(a.user_id, b.user_id) AS user_id, a.segment AS old_segment, b.segment AS new_segment
        FROM snap a FULL OUTER JOIN live b ON a.user_id = b.user_id
        WHERE a.segment IS DISTINCT FROM b.segment OR a.score IS DISTINCT FROM b.score""", SNAP_50),
    # joins
    "pair_images": sql("SELECT * FROM images", IMAGES),
    "snapshot_diff": sql("""
        SELECT COALESCE(a.user_id, b.user_id) AS user_id,
               CASE WHEN a.user_id IS NULL THEN 'INSERT' WHEN b.user_id IS NULL THEN 'DELETE'
                    ELSE 'UPDATE' END AS change,
               a.segment AS segment_before, b.segment AS segment_after, a.score AS score_before,
               b.score AS score_after, a.note AS note_before, b.note AS note_after
        FROM snap a FULL OUTER JOIN live b ON a.user_id = b.user_id
        WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.segment IS DISTINCT FROM b.segment
           OR a.score IS DISTINCT FROM b.score OR a.note IS DISTINCT FROM b.note""", SNAP_50),
    "match_current_changed": sql(f"""
        SELECT i.*, d.segment AS current_segment, d.tier AS current_tier
        FROM later i JOIN dim d ON i.user_id = d.user_id
        WHERE i.operation <> 'DELETE' AND {DIFFERS}""", MANUAL_DIM),
    "match_current_new_or_changed": sql(f"""
        SELECT i.*, d.segment AS current_segment, d.tier AS current_tier
        FROM later i LEFT JOIN dim d ON i.user_id = d.user_id
        WHERE i.operation <> 'DELETE' AND (d.user_id IS NULL OR {DIFFERS})""", MANUAL_DIM),
    "merge_state": sql("SELECT * FROM live"),
    "anti_new_customers": """
        SELECT * FROM customer WHERE c_custkey NOT IN (
          SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1995)""",
    "anti_new_keys": """
        SELECT * FROM customer WHERE c_custkey NOT IN (
          SELECT o_custkey FROM orders)""",
    "member_rows": sql("""
        SELECT * FROM people
        WHERE state IN (SELECT group_name FROM principals WHERE principal = 'Supplier#000000001')"""),
    "as_of_dimension": sql("""
        SELECT f.user_id, f.event_id, f.ts, f.value, d.segment AS dim_segment, d.tier AS dim_tier
        FROM events f LEFT JOIN dim2 d ON d.user_id = f.user_id AND d.__START_AT <= f.ts
             AND (d.__END_AT IS NULL OR f.ts < d.__END_AT)""", DIM2),
    "since_commit": sql(f"""
        SELECT * FROM feed
        WHERE _commit_timestamp > (SELECT "timestamp" FROM commits WHERE version = {v(60)})"""),
    "affected_keys": sql(f"""
        SELECT * FROM raw WHERE user_id IN (SELECT user_id FROM raw WHERE _commit_version > {v(99)})"""),
    # aggregations
    "high_water_mark": sql("""
        SELECT _change_type, MAX(_commit_version) AS high_water_mark FROM feed GROUP BY _change_type"""),
    "duplicate_current": sql("""
        SELECT user_id, COUNT(*) AS open_rows FROM stepped WHERE is_current
        GROUP BY user_id HAVING COUNT(*) > 1""",
        MANUAL_DIM, "later_alive AS (SELECT * FROM later WHERE operation <> 'DELETE')", stepped("later_alive")),
    "duplicate_open_rows": sql("""
        SELECT user_id, COUNT(*) AS open_rows FROM dim2 WHERE __END_AT IS NULL
        GROUP BY user_id HAVING COUNT(*) > 1""", DIM2),
    "change_summary": sql(
        'SELECT segment, _change_type, COUNT(*) AS "rows" FROM feed GROUP BY segment, _change_type'
    ),
    "distinct_versions": sql("SELECT DISTINCT _commit_version FROM feed"),
    "version_span": sql("""
        SELECT MIN(_commit_version) AS first_version, MAX(_commit_version) AS last_version,
               COUNT(DISTINCT _commit_version) AS versions FROM feed"""),
    "processing_lag": sql("""
        SELECT source, last_version, current_version, lag,
               lag * 100 // (current_version - first_retained + 1) AS retention_used_percent,
               lag * 100 // (current_version - first_retained + 1) > 80 AS alert FROM facts""", LEDGER),
    "incremental_aggregate": sql(METRICS),
    "distinct_zone_offsets": sql(f"""
        SELECT CASE WHEN _commit_version < {v(30)} THEN '+10:00' ELSE '+00:00' END AS utc_offset,
               COUNT(*) AS "rows" FROM raw GROUP BY 1"""),
    "latest_by_key": sql("SELECT * FROM last_images"),
    # windows, sorts, sets
    "dedupe_latest": sql("SELECT * FROM last_images"),
    "close_intervals": sql("""
        SELECT *, updated_at AS __START_AT, _commit_version AS __START_VERSION,
               LEAD(updated_at) OVER w AS __END_AT, LEAD(_commit_version) OVER w AS __END_VERSION
        FROM raw WINDOW w AS (PARTITION BY user_id ORDER BY updated_at, _commit_version)"""),
    "sequence_ties": sql("""
        SELECT user_id, updated_at, COUNT(*) AS events FROM raw GROUP BY user_id, updated_at
        HAVING COUNT(*) > 1"""),
    "sequence_regressions": sql("""
        SELECT * FROM (
          SELECT *, MAX(updated_at) OVER (PARTITION BY user_id ORDER BY _commit_version
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_before FROM raw)
        WHERE updated_at < latest_before"""),
    "composite_order": sql("SELECT * FROM raw"),
    "suppress_unchanged": sql(
        "SELECT user_id, segment, tier, operation, updated_at, _commit_version FROM dim2_kept", DIM2
    ),
    "ordered_feed": sql("SELECT * FROM feed"),
    "latest_commit": sql("SELECT * FROM commits ORDER BY version DESC LIMIT 1"),
    "union_changes": sql("SELECT * FROM feed WHERE _change_type <> 'update_preimage'"),
    "distinct_rows": sql("SELECT DISTINCT user_id, segment, _change_type FROM feed"),
    "reconcile": sql("""
        SELECT *, 'left' AS only_in, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM snap EXCEPT SELECT * FROM live)
        UNION ALL
        SELECT *, 'right', 1 FROM (SELECT * FROM live EXCEPT SELECT * FROM snap)""", SNAP_50),
    # apply, history and recovery
    "apply_changes_scd1": sql("SELECT * FROM state_rows"),
    "apply_changes_scd2": sql("SELECT * FROM dim2", DIM2),
    "scd2_step": sql(
        "SELECT * FROM stepped",
        MANUAL_DIM,
        latest_raw("later_latest", f"_commit_version > {v(50)}"),
        stepped("later_latest"),
    ),
    "scd2_effect": sql("""
        SELECT * FROM feed WHERE _change_type IN ('insert', 'delete')
        UNION ALL
        SELECT f.* FROM feed f JOIN images i
          ON f.user_id = i.user_id AND f._commit_version = i._commit_version
        WHERE f._change_type = 'update_postimage' AND i.segment_before IS DISTINCT FROM i.segment_after""",
        IMAGES),
    "history_vs_scd2": sql("""
        SELECT user_id, COALESCE(h, 0) AS history_events, COALESCE(d, 0) AS dimension_rows
        FROM (SELECT user_id, COUNT(*) AS h FROM feed GROUP BY user_id)
        FULL OUTER JOIN (SELECT user_id, COUNT(*) AS d FROM dim2 GROUP BY user_id) USING (user_id)""", DIM2),
    "rebaseline": sql(f"SELECT * REPLACE ({TOP} AS last_commit_version) FROM live"),
    "recover_stream": sql("SELECT * FROM feed"),
    "recover_split_commit": sql("SELECT * FROM feed"),
    "apply_scd1_split_versions": sql("""
        SELECT user_id, segment, score, note, _commit_version AS last_commit_version
        FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY _commit_version DESC,
                                       CASE WHEN _change_type = 'delete' THEN 1 ELSE 0 END) AS rn
          FROM (
            SELECT * FROM feed WHERE _change_type <> 'update_preimage'
            UNION ALL
            SELECT user_id, segment, score, note, 'insert', _commit_version, _commit_timestamp
            FROM feed WHERE _change_type = 'delete' AND _commit_version % 2 = 0))
        WHERE rn = 1 AND _change_type <> 'delete'"""),
    "gap_repair_inserts": sql(f"""
        SELECT DISTINCT user_id + 1000000 AS user_id, 'insert' AS _change_type, {v(45)} AS _commit_version,
               TRUE AS synthetic
        FROM feed WHERE _change_type = 'insert' AND _commit_version BETWEEN {v(40)} AND {v(45)}"""),
    "run_first_batch": f"""
        SELECT 'others' AS source, CAST(7 AS BIGINT) AS last_version UNION ALL SELECT 'users', {TOP}""",
    "stream_drops": sql("""
        SELECT CAST(CAST(date_trunc('month', _commit_timestamp) AS DATE) AS VARCHAR) AS what, COUNT(*) AS "rows"
        FROM feed WHERE score < 50 GROUP BY 1
        UNION ALL SELECT 'cheap', COUNT(*) FROM feed WHERE score >= 50 OR score IS NULL"""),
    "tag_policies_by_table": """
        SELECT 'hr.people' AS "table", COUNT(*) AS "rows", COUNT(*) AS readable
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE r_name = 'ASIA'
        UNION ALL SELECT 'hr.untagged', COUNT(*), COUNT(*) FROM customer
        UNION ALL SELECT 'sales.people', COUNT(*), COUNT(*) FROM customer""",
    "gap_window": sql(f"""
        SELECT source, {v(40)} AS first_version, {v(45)} AS last_version,
               MIN(version) FILTER (WHERE operation <> 'OPTIMIZE') AS first_data_version,
               MAX(version) FILTER (WHERE operation <> 'OPTIMIZE') AS last_data_version,
               COUNT(*) FILTER (WHERE operation = 'INSERT') AS inserts,
               COUNT(*) FILTER (WHERE operation = 'UPDATE') AS updates,
               COUNT(*) FILTER (WHERE operation = 'DELETE') AS deletes,
               COUNT(*) FILTER (WHERE operation <> 'OPTIMIZE') AS data_commits,
               COUNT(*) AS commits,
               BOOL_AND(operation IN ('INSERT', 'OPTIMIZE')) AS insert_only
        FROM commits WHERE NOT feed_enabled GROUP BY source"""),
    "gap_repair": sql(f"""
        SELECT user_id, segment, score, note, _change_type, {v(45)} AS _commit_version,
               (SELECT "timestamp" FROM commits WHERE version = {v(45)}) AS _commit_timestamp,
               TRUE AS synthetic
        FROM (
          SELECT *, 'insert' AS _change_type FROM post WHERE user_id NOT IN (SELECT user_id FROM pre)
          UNION ALL SELECT *, 'delete' FROM pre WHERE user_id NOT IN (SELECT user_id FROM post)
          UNION ALL SELECT pre.*, 'update_preimage' FROM pre JOIN post USING (user_id) WHERE {{differs}}
          UNION ALL SELECT post.*, 'update_postimage' FROM pre JOIN post USING (user_id) WHERE {{differs}})"""
        .replace("{differs}", "(pre.segment IS DISTINCT FROM post.segment OR "
                 "pre.score IS DISTINCT FROM post.score OR pre.note IS DISTINCT FROM post.note)"),
        snapshot("pre", f"{v(40)} - 1"), snapshot("post", v(45))),
    "replay_check": sql("""
        SELECT *, CAST(1 AS BIGINT) AS forward, CAST(1 AS BIGINT) AS backward, CAST(1 AS BIGINT) AS again
        FROM state_rows WHERE FALSE"""),
    "replayed_state": sql("SELECT * FROM live"),
    "backfill_drift": sql("""
        SELECT COALESCE(r.user_id, i.user_id) AS user_id,
               COALESCE(r.__START_VERSION, i.__START_VERSION) AS __START_VERSION,
               r.__START_AT AS rebuilt_start, i.__START_AT AS incremental_start,
               CASE WHEN i.user_id IS NULL THEN 'only_rebuilt' WHEN r.user_id IS NULL THEN 'only_incremental'
                    ELSE 'moved' END AS drift
        FROM rebuilt r FULL OUTER JOIN dim2 i
          ON r.user_id = i.user_id AND r.__START_VERSION = i.__START_VERSION
        WHERE r.__START_AT IS DISTINCT FROM i.__START_AT""",
        DIM2, LOCAL_EARLY, scd2("rebuilt", "local_early", ["segment", "tier"])),
    "normalize_sequence": sql("SELECT * FROM local_early", LOCAL_EARLY),
    "feed_health": sql("""
        SELECT source, last_version, current_version, lag,
               COALESCE(CASE WHEN off THEN 'FEED_DISABLED' WHEN lost THEN 'VERSION_LOST'
                             WHEN late THEN 'HIGH_LAG' END, 'OK') AS status,
               concat_ws(',', CASE WHEN off THEN 'FEED_DISABLED' END, CASE WHEN lost THEN 'VERSION_LOST' END,
                         CASE WHEN late THEN 'HIGH_LAG' END) AS issues
        FROM (SELECT *, NOT enabled_now OR gap_unread AS off,
                     lag > 0 AND NOT COALESCE(next_retained, TRUE) AS lost, lag > 100 AS late FROM facts)""",
        LEDGER),
    "feed_health_unread": sql("""
        SELECT s.source, CASE WHEN s.source = 'ghost' THEN p.last_version WHEN s.source <> 'view' THEN f.last_version END AS last_version,
               CASE WHEN s.source <> 'ghost' THEN f.current_version END AS current_version,
               CASE WHEN s.source = 'view' THEN f.current_version WHEN s.source <> 'ghost' THEN f.lag END AS lag,
               CASE WHEN s.source IN ('ghost', 'view') THEN 'FEED_DISABLED'
                    ELSE COALESCE(CASE WHEN off THEN 'FEED_DISABLED' WHEN lost THEN 'VERSION_LOST'
                                       WHEN late THEN 'HIGH_LAG' END, 'OK') END AS status,
               CASE s.source WHEN 'ghost' THEN 'FEED_DISABLED' WHEN 'view' THEN 'FEED_DISABLED,VERSION_LOST,NEVER_READ,HIGH_LAG'
                    ELSE concat_ws(',', CASE WHEN off THEN 'FEED_DISABLED' END, CASE WHEN lost THEN 'VERSION_LOST' END,
                                   CASE WHEN late THEN 'HIGH_LAG' END) END AS issues
        FROM (SELECT source FROM source_progress UNION ALL SELECT 'ghost') s
        LEFT JOIN (SELECT *, NOT enabled_now OR gap_unread AS off,
                          lag > 0 AND NOT COALESCE(next_retained, TRUE) AS lost, lag > 100 AS late FROM facts) f
          ON f.source = s.source
        JOIN source_progress p ON p.source = 'click'""", LEDGER),
    "consumer_health": sql(f"""
        SELECT consumer, 'users' AS source, last_version, top AS current_version, top - COALESCE(last_version, 0) AS lag,
               CASE consumer WHEN 'archive' THEN 'OK' WHEN 'reports' THEN 'STALLED' ELSE 'NEVER_STARTED' END AS status,
               concat_ws(',', CASE consumer WHEN 'reports' THEN 'STALLED'
                              WHEN 'alerts' THEN 'NEVER_STARTED,FEED_DISABLED,VERSION_LOST' END,
                         CASE WHEN top - COALESCE(last_version, 0) > 100 THEN 'HIGH_LAG' END) AS issues, total_rows
        FROM (SELECT MAX(_commit_version) AS top FROM feed),
             (SELECT 'archive' AS consumer, MAX(_commit_version) AS last_version, COUNT(*) AS total_rows FROM feed
              UNION ALL SELECT 'reports', MAX(_commit_version), COUNT(*) FROM feed WHERE _commit_version <= {v(50)}
              UNION ALL SELECT 'alerts', NULL, NULL)"""),
    "zone_shifts": f"""
        SELECT CAST(1 AS BIGINT) AS first_version, {v(30)} AS last_version, CAST(600 AS BIGINT) AS lag_minutes
        UNION ALL SELECT {v(30)} + 1, {TOP}, 0""",
    "zones_restored": sql("SELECT * FROM raw"),
    "evolve_dim2": sql("SELECT * FROM wide", scd2("wide", "raw_note", ["segment", "note"])),
    "run_full_batch": sql(
        "SELECT user_id, segment, score, last_commit_version, is_deleted FROM state_rows"
    ),
    # streaming
    "available_now_rerun": sql(
        "SELECT COUNT(*) AS sink_rows, MAX(_commit_version) AS last_version FROM feed"
    ),
    "stream_apply_scd1": sql("SELECT * FROM live"),
    "late_stream_batches": sql("SELECT * FROM state_rows"),
    "stream_apply_scd2": sql("SELECT * FROM dim2", DIM2),
    "stream_history": sql(HISTORY),
    "stream_metrics": sql(METRICS),
    "stream_live_metrics": sql(METRICS),
    "partial_replication": sql("SELECT * FROM live"),
    "changes_function": sql(f"SELECT * FROM feed WHERE _commit_version BETWEEN {v(20)} AND {v(60)}"),
    "fan_out": sql("""
        SELECT user_id, _commit_version, 'history' AS sink FROM feed
        UNION ALL
        SELECT user_id, _commit_version, 'deletes' FROM feed WHERE _change_type = 'delete'"""),
    # row and column security
    "row_filter": secured("'ASIA'"),
    "mask_text": secured(tfn=False),
    "mask_number": secured(salary=False),
    "view_filtered": secured("'EUROPE'"),
    "view_masked": secured(salary=False),
    "view_secured": secured("'EUROPE'", tfn=False),
    "session_view": secured("'AFRICA'"),
    "apply_tag_policies": secured("'ASIA'", salary=False),
    "verify_row_filter": sql("""
        SELECT principal, visible_rows, expected_rows, NOT excluded AS proves,
               NOT excluded AND visible_rows > expected_rows AS excess FROM counts""", VISIBLE),
    "verify_column_mask": sql("""
        SELECT COUNT(*) AS "rows", COUNT(*) FILTER (WHERE salary >= 0) AS unmasked FROM people"""),
    "bypass_members": sql("""
        SELECT principal, string_agg(DISTINCT group_name, ',' ORDER BY group_name) AS bypass_groups
        FROM principals WHERE group_name IN ('admins', 'platform-admins') GROUP BY principal"""),
    "policy_coverage": sql("""
        SELECT table_name, column_name, tag, mechanism, rule, covered_values,
               COUNT(*) FILTER (WHERE mechanism <> 'none') OVER (PARTITION BY table_name, column_name) > 1 AS overlap
        FROM (
          SELECT 'people' AS table_name, 'state' AS column_name, 'state' AS tag, 'tag policy' AS mechanism,
                 'own_state_only' AS rule, (SELECT COUNT(state) FROM people) AS covered_values
          UNION ALL SELECT 'people', 'tfn', 'pii', 'tag policy', 'hide_personal', (SELECT COUNT(tfn) FROM people)
          UNION ALL SELECT 'people', 'salary', 'financial', 'tag policy', 'hide_pay',
                           (SELECT COUNT(salary) FROM people)
          UNION ALL SELECT 'people', 'state', NULL, 'table rule', 'row filter', (SELECT COUNT(state) FROM people)
          UNION ALL SELECT 'people', 'tfn', NULL, 'table rule', 'column mask', (SELECT COUNT(tfn) FROM people)
          UNION ALL SELECT 'suppliers', 's_acctbal', 'financial', 'tag policy', 'hide_pay',
                           (SELECT COUNT(s_acctbal) FROM supplier)
          UNION ALL SELECT 'suppliers', 's_name', 'public', 'none', NULL, (SELECT COUNT(s_name) FROM supplier))"""),
}
