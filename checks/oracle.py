"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from checks.views import AS_OF_SQL, CONFIRMED, COUNTED_TYPE, RAW_VALUE

# Key texts of every kind, by event number (expressions both engines understand).
KEY_TEXT = """CASE event_id % 6
  WHEN 0 THEN concat(CAST(event_id AS VARCHAR(20)), '.7')
  WHEN 1 THEN concat('-', CAST(event_id AS VARCHAR(20)), '.7')
  WHEN 2 THEN concat(CAST(event_id AS VARCHAR(20)), '000000000')
  WHEN 3 THEN concat('-', CAST(event_id AS VARCHAR(20)), '000000000')
  WHEN 4 THEN CASE WHEN event_type = 'error' THEN 'NaN' ELSE 'abc' END
  ELSE CAST(event_id AS VARCHAR(20)) END"""
# A message of every fate by event number: each reason, then what is let through.
REASON_TEXT = """CASE event_id % 12
  WHEN 0 THEN 'not json'
  WHEN 1 THEN '{"payload":null}'
  WHEN 2 THEN '{"payload":{"__source_ts_ms":1}}'
  WHEN 3 THEN '{"payload":{"__table":"TBL_ENROLL","Enroll_Seq":1}}'
  WHEN 4 THEN '{"payload":{"__table":"TBL_ENROLL","__source_ts_ms":1}}'
  WHEN 5 THEN '{"payload":{"__table":"TBL_ENROLL","__source_ts_ms":1,"Enroll_Seq":"abc"}}'
  WHEN 6 THEN concat('{"payload":{"__table":"TBL_LEARNING_SUBJECT","__source_ts_ms":1,"Learning_Seq":3',
       lpad(CAST(event_id AS VARCHAR(20)), 10, '0'), '}}')
  WHEN 7 THEN '{"payload":{"__table":"TBL_ENROLL","__source_ts_ms":1,"Enroll_Seq":1}} trailing'
  WHEN 8 THEN '{"payload":{"__table":"TBL_ENROLL","__source_ts_ms":1,"Enroll_Seq":1}}{"payload":{"__table":"TBL_ENROLL","__source_ts_ms":1,"Enroll_Seq":7}}'
  WHEN 9 THEN concat('{payload:{', chr(39), '__table', chr(39), ':', chr(39), 'TBL_ENROLL', chr(39),
       ',__source_ts_ms:1,Enroll_Seq:', CAST(event_id AS VARCHAR(20)), '}}')
  WHEN 10 THEN '{"payload":{"__table":"TBL_OTHER","__source_ts_ms":1}}'
  ELSE concat('{"payload":{"__table":"TBL_LEARNING_SUBJECT","__source_ts_ms":1,"Learning_Seq":',
       CAST(event_id AS VARCHAR(20)), '}}') END"""
FLAG_TYPE = "CASE user_id % 3 WHEN 0 THEN 'LMCT01' WHEN 1 THEN 'LMCT02' END"
FLAG_STATUS = "CASE event_id % 3 WHEN 0 THEN 'LMER01' WHEN 1 THEN 'LMER02' END"

_VIEWS = f"""
enroll AS (SELECT c_custkey enroll_seq, c_nationkey course_run_seq,
                  CASE WHEN c_mktsegment = '{CONFIRMED}' THEN 'LMER01' ELSE c_mktsegment END
                      confirm_status_cd FROM customer),
course_run AS (SELECT n_nationkey course_run_seq, n_name course_run_nm,
                      n_regionkey course_seq FROM nation),
course AS (SELECT r_regionkey course_seq, r_name course_id,
                  CASE WHEN r_name = '{COUNTED_TYPE}' THEN 'LMCT01' ELSE r_name END course_type_cd
           FROM region),
learning AS (SELECT o_orderkey learning_seq, o_custkey enroll_seq, o_custkey learner_seq,
                    CASE WHEN o_orderkey % 10 = 0 THEN (c_nationkey + 1) % 25
                         ELSE c_nationkey END course_run_seq
             FROM orders JOIN customer ON o_custkey = c_custkey),
learning_subject AS (SELECT l_orderkey learning_seq, l_linenumber learning_subject_seq,
                            MAX(l_discount) progress_ratio
                     FROM lineitem GROUP BY l_orderkey, l_linenumber),
mart AS (SELECT o_orderkey learning_seq, CAST(NULL AS VARCHAR) course_run_nm,
                CAST(NULL AS VARCHAR) course_id, CAST(NULL AS INT) course_run_seq,
                CAST(NULL AS BIGINT) learner_seq, CAST(NULL AS DOUBLE) progress_ratio,
                CAST(NULL AS INT) learning_subject_seq,
                CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END insert_date,
                CAST(NULL AS TIMESTAMP) update_date,
                CASE WHEN o_orderkey % 6 = 0 THEN 'Y' ELSE 'N' END delete_yn
         FROM orders WHERE o_orderkey % 3 = 0),
enroll_mart AS (SELECT c_custkey enroll_seq, c_nationkey course_run_seq,
                       TIMESTAMP '2023-01-01 00:00:00' insert_date,
                       CAST(NULL AS TIMESTAMP) update_date, 'N' delete_yn
                FROM customer WHERE c_custkey % 2 = 0),
raw AS (SELECT event_id, {RAW_VALUE} AS value FROM events),
parsed AS (
  SELECT event_id, value, v IS NOT NULL AS sound,
         v->>'$.payload.__table' table_name, v->>'$.payload.__source_ts_ms' source_ts_ms,
         TRY_CAST(trunc(TRY_CAST(v->>'$.payload.Enroll_Seq' AS DOUBLE)) AS INT) enroll_seq,
         TRY_CAST(trunc(TRY_CAST(v->>'$.payload.Learning_Seq' AS DOUBLE)) AS INT) learning_seq,
         v->>'$.payload.Confirm_Status_Cd' confirm_status_cd
  FROM (SELECT event_id, value, CASE WHEN json_valid(value) THEN value END v
        FROM raw WHERE length(value) > 0)),
accepted AS (
  SELECT * FROM parsed
  WHERE source_ts_ms IS NOT NULL
    AND ((table_name = 'TBL_ENROLL' AND enroll_seq IS NOT NULL)
      OR (table_name = 'TBL_LEARNING_SUBJECT' AND learning_seq IS NOT NULL))),
enroll_msg AS (SELECT enroll_seq, confirm_status_cd FROM accepted WHERE table_name = 'TBL_ENROLL'),
expanded AS (SELECT m.enroll_seq, m.confirm_status_cd, CAST(l.learning_seq AS INT) learning_seq
             FROM enroll_msg m JOIN learning l ON l.enroll_seq = m.enroll_seq),
touched AS (
  SELECT enroll_seq seq, 'enroll' target FROM enroll_msg
  UNION ALL SELECT learning_seq, 'progress' FROM expanded
  UNION ALL SELECT learning_seq, 'progress' FROM accepted
            WHERE table_name = 'TBL_LEARNING_SUBJECT'),
progress_keys AS (SELECT DISTINCT CAST(seq AS BIGINT) learning_seq FROM touched
                  WHERE target = 'progress'),
enroll_keys AS (SELECT DISTINCT CAST(seq AS BIGINT) enroll_seq FROM touched
                WHERE target = 'enroll'),
all_keys AS (SELECT learning_seq FROM learning),
all_enroll_keys AS (SELECT enroll_seq FROM enroll)
"""


def _with(body: str, *more: str) -> str:
    return "WITH " + ",".join([_VIEWS, *more]) + body


def _facts(name: str, keys: str) -> str:
    """All fanned-out rows of ``keys`` with their mart entry."""
    return f"""{name} AS (
      SELECT l.learning_seq, cr.course_run_nm, c.course_id, cr.course_run_seq, l.learner_seq,
             ls.progress_ratio, ls.learning_subject_seq,
             lp.learning_seq AS known_key, lp.insert_date AS known_date, lp.delete_yn AS known_yn,
             CASE WHEN c.course_type_cd = 'LMCT01' AND e.confirm_status_cd = 'LMER01'
                  THEN 'N' ELSE 'Y' END AS delete_yn
      FROM {keys} k
      JOIN learning l ON l.learning_seq = k.learning_seq
      JOIN course_run cr ON cr.course_run_seq = l.course_run_seq
      JOIN course c ON c.course_seq = cr.course_seq
      JOIN enroll e ON e.course_run_seq = cr.course_run_seq AND e.enroll_seq = l.enroll_seq
      LEFT JOIN learning_subject ls ON ls.learning_seq = l.learning_seq
      LEFT JOIN mart lp ON lp.learning_seq = l.learning_seq)"""


_KEEP = f"coalesce(known_date, {AS_OF_SQL})"
_REVIVE = f"CASE WHEN known_key IS NULL OR known_yn = 'Y' THEN {AS_OF_SQL} ELSE known_date END"


def _rows(facts: str, one: bool = False, date: str = _KEEP, zero: bool = False) -> str:
    def number(name: str) -> str:
        return f"coalesce({name}, 0) AS {name}" if zero else name

    chosen = """QUALIFY row_number() OVER (PARTITION BY learning_seq
        ORDER BY learning_subject_seq DESC NULLS LAST, progress_ratio DESC NULLS LAST) = 1"""
    return f"""SELECT learning_seq, course_run_nm, course_id, {number('course_run_seq')},
        {number('learner_seq')}, {number('progress_ratio')}, {number('learning_subject_seq')},
        {date} AS insert_date, {AS_OF_SQL} AS update_date, delete_yn
        FROM {facts} {chosen if one else ''}"""


def _enroll(keys: str, run: str = "em.course_run_seq") -> str:
    return f"""SELECT e.enroll_seq, {run} AS course_run_seq,
        coalesce(em.insert_date, {AS_OF_SQL}) AS insert_date, {AS_OF_SQL} AS update_date,
        'N' AS delete_yn
        FROM {keys} k JOIN enroll e ON e.enroll_seq = k.enroll_seq
        LEFT JOIN enroll_mart em ON em.enroll_seq = e.enroll_seq"""


def _merge(mart: str, rows: str, key: str) -> str:
    return f"""SELECT * FROM {rows} UNION ALL
        SELECT * FROM {mart} m WHERE m.{key} NOT IN (SELECT {key} FROM {rows})"""


def _differences(columns: str) -> str:
    return f"""SELECT 'mart' AS side, * FROM
        (SELECT {columns} FROM merged EXCEPT ALL SELECT {columns} FROM rebuilt)
        UNION ALL SELECT 'rebuild' AS side, * FROM
        (SELECT {columns} FROM rebuilt EXCEPT ALL SELECT {columns} FROM merged)"""


_FACTS = _facts("facts", "progress_keys")
_ALL_FACTS = _facts("all_facts", "all_keys")
_ROWS = f"rows_one AS ({_rows('facts', one=True)})"
_UNDATED = (
    "learning_seq, course_run_nm, course_id, course_run_seq, learner_seq,"
    " progress_ratio, learning_subject_seq, delete_yn"
)
_TOMBSTONE = """CAST(learning_seq AS BIGINT) AS learning_seq,
    CAST(NULL AS VARCHAR) AS course_run_nm, CAST(NULL AS VARCHAR) AS course_id,
    CAST(NULL AS INT) AS course_run_seq, CAST(NULL AS BIGINT) AS learner_seq,
    CAST(NULL AS DOUBLE) AS progress_ratio, CAST(NULL AS INT) AS learning_subject_seq,
    CAST(NULL AS TIMESTAMP) AS insert_date, CAST(NULL AS TIMESTAMP) AS update_date,
    'Y' AS delete_yn"""


def _with_tombstones(facts: str) -> str:
    return f"""SELECT * FROM revived UNION ALL
        SELECT DISTINCT {_TOMBSTONE} FROM expanded
        WHERE confirm_status_cd <> 'LMER01'
          AND learning_seq NOT IN (SELECT learning_seq FROM {facts})"""


_REVIVED = f"revived AS ({_rows('facts', one=True, date=_REVIVE)})"
_LAST_KEYS = """last_keys AS (
    SELECT CAST(learning_seq AS BIGINT) learning_seq FROM accepted
    WHERE table_name = 'TBL_LEARNING_SUBJECT'
    UNION SELECT max(learning_seq) FROM learning
    WHERE enroll_seq IN (SELECT enroll_seq FROM enroll_msg) GROUP BY enroll_seq)"""
_MERGED = _with(_merge("mart", "rows_one", "learning_seq"), _FACTS, _ROWS)
_ENROLL_ROWS = f"enroll_new AS ({_enroll('enroll_keys')})"
_MERGED_ENROLL = _with(_merge("enroll_mart", "enroll_new", "enroll_seq"), _ENROLL_ROWS)
_TOMBSTONE_MART = _with(
    _merge("mart", "earlier", "learning_seq"),
    _FACTS,
    _REVIVED,
    f"earlier AS ({_with_tombstones('facts')})",
)

SQL: dict[str, str] = {
    "cdc_nonempty": _with("SELECT event_id, value FROM raw WHERE length(value) > 0"),
    "cdc_parse": _with(
        "SELECT event_id, table_name, source_ts_ms, enroll_seq, learning_seq, confirm_status_cd"
        " FROM parsed"
    ),
    "cdc_accepted": _with(
        "SELECT event_id, table_name, enroll_seq, learning_seq FROM accepted"
    ),
    "cdc_quarantine": _with(
        """SELECT event_id, value, CASE WHEN NOT sound THEN 'bad_json'
             WHEN table_name IS NULL THEN 'missing_table'
             WHEN source_ts_ms IS NULL THEN 'missing_source_ts' ELSE 'bad_key' END AS reason
           FROM parsed p WHERE NOT sound OR table_name IS NULL OR source_ts_ms IS NULL
             OR (table_name = 'TBL_ENROLL' AND enroll_seq IS NULL)
             OR (table_name = 'TBL_LEARNING_SUBJECT' AND learning_seq IS NULL)"""
    ),
    "cdc_fail_fast": _with("SELECT event_id, table_name, confirm_status_cd FROM accepted"),
    "cdc_reasons": f"""SELECT event_id, {REASON_TEXT} AS value,
        CASE event_id % 12 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'missing_payload'
          WHEN 2 THEN 'missing_table' WHEN 3 THEN 'missing_source_ts' WHEN 4 THEN 'missing_key'
          WHEN 5 THEN 'bad_key' WHEN 6 THEN 'bad_key' WHEN 7 THEN 'bad_json'
          WHEN 8 THEN 'bad_json' END AS reason,
        CASE WHEN event_id % 12 IN (3, 4, 5, 9) THEN 'TBL_ENROLL' WHEN event_id % 12 = 10
          THEN 'TBL_OTHER' WHEN event_id % 12 IN (6, 11) THEN 'TBL_LEARNING_SUBJECT' END AS table_name,
        CAST(CASE event_id % 12 WHEN 3 THEN 1 WHEN 9 THEN event_id END AS INT) AS enroll_seq,
        CAST(CASE event_id % 12 WHEN 11 THEN event_id END AS INT) AS learning_seq FROM events""",
    "cdc_since": """SELECT event_id, CAST(event_id AS INT) AS learning_seq FROM events
        WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""",
    "start_time_parse": """SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS start_text,
        date_trunc('second', ts) AS start_time FROM events""",
    "key_coercion": f"""WITH texts AS (
          SELECT event_id, TRY_CAST({KEY_TEXT} AS DOUBLE) AS number FROM events)
        SELECT event_id, TRY_CAST(trunc(number) AS INT) AS strict_key,
          CAST(CASE WHEN number IS NULL THEN NULL WHEN isnan(number) THEN 0
               WHEN number >= 2147483647 THEN 2147483647
               WHEN number <= -2147483648 THEN -2147483648
               ELSE trunc(number) END AS INT) AS clamped_key FROM texts""",
    "named_keys": _with(
        """SELECT t.seq AS learning_seq, t.target AS target_table FROM touched t
           WHERE t.target = 'progress'"""
    ),
    "message_keys": _with(
        """SELECT table_name = 'TBL_ENROLL' AS from_enroll,
             CASE WHEN table_name = 'TBL_ENROLL' THEN enroll_seq ELSE learning_seq END AS seq,
             count(*) AS n_messages,
             count(*) FILTER (WHERE table_name = 'TBL_ENROLL'
                              AND confirm_status_cd <> 'LMER01') AS n_unconfirmed,
             max(CAST(source_ts_ms AS BIGINT)) AS last_source_ts_ms
           FROM accepted GROUP BY 1, 2"""
    ),
    "touched_keys": _with("SELECT seq, target FROM touched"),
    "touched_keys_wide": _with(
        """SELECT seq, target, count(*) AS n_messages FROM (
             SELECT CAST(enroll_seq AS BIGINT) AS seq, 'enroll' AS target FROM enroll_msg
             UNION ALL SELECT learning_seq + 3000000000, 'progress' FROM expanded
             UNION ALL SELECT learning_seq, 'progress' FROM accepted
                       WHERE table_name = 'TBL_LEARNING_SUBJECT') GROUP BY seq, target"""
    ),
    "touched_keys_distinct": _with(
        "SELECT seq, target, count(*) AS n_messages FROM touched GROUP BY seq, target"
    ),
    "route_exclusive": _with("SELECT target, count(*) AS n FROM touched GROUP BY target"),
    "route_progress": _with(
        """SELECT CAST(seq AS BIGINT) AS learning_seq, count(*) AS n_messages FROM touched
           WHERE target = 'progress' GROUP BY 1"""
    ),
    "route_enroll": _with(
        """SELECT CAST(seq AS BIGINT) AS enroll_seq, count(*) AS n_messages FROM touched
           WHERE target = 'enroll' GROUP BY 1"""
    ),
    "route_fallthrough": _with(
        """SELECT seq, 'enroll' AS mart FROM touched UNION ALL
           SELECT seq, 'progress' AS mart FROM touched WHERE target = 'progress'"""
    ),
    "enroll_to_learning": _with(
        """SELECT CAST(k.enroll_seq AS INT) AS enroll_seq, l.learning_seq
           FROM enroll_keys k JOIN learning l ON l.enroll_seq = k.enroll_seq"""
    ),
    "lookup_learning": _with(
        """SELECT l.learning_seq, l.enroll_seq, l.course_run_seq, l.learner_seq
           FROM progress_keys k JOIN learning l ON l.learning_seq = k.learning_seq"""
    ),
    "lookup_course_run": _with(
        """SELECT learning_seq, cr.course_run_seq, course_run_nm, course_seq
           FROM learning l JOIN course_run cr ON l.course_run_seq = cr.course_run_seq"""
    ),
    "lookup_course": _with(
        """SELECT course_run_seq, course_run_nm, course_id, course_type_cd
           FROM course_run cr JOIN course c ON cr.course_seq = c.course_seq"""
    ),
    "lookup_enroll": _with(
        """SELECT learning_seq, e.enroll_seq, e.course_run_seq, confirm_status_cd
           FROM learning l JOIN enroll e
             ON e.enroll_seq = l.enroll_seq AND e.course_run_seq = l.course_run_seq"""
    ),
    "lookup_subject": _with(
        """SELECT l.learning_seq, learner_seq, learning_subject_seq, progress_ratio
           FROM learning l LEFT JOIN learning_subject ls ON ls.learning_seq = l.learning_seq"""
    ),
    "lookup_top_subject": _with(
        """SELECT l.learning_seq, learning_subject_seq, progress_ratio
           FROM learning l LEFT JOIN learning_subject ls ON ls.learning_seq = l.learning_seq
           QUALIFY row_number() OVER (PARTITION BY l.learning_seq ORDER BY
             learning_subject_seq DESC NULLS LAST, progress_ratio DESC NULLS LAST) = 1"""
    ),
    "lookup_progress_mart": _with(
        f"""SELECT l.learning_seq, coalesce(lp.insert_date, {AS_OF_SQL}) AS insert_date,
              {AS_OF_SQL} AS update_date
            FROM learning l LEFT JOIN mart lp ON lp.learning_seq = l.learning_seq"""
    ),
    "insert_date_revival": _with(
        f"""SELECT l.learning_seq, CASE WHEN lp.learning_seq IS NULL OR lp.delete_yn = 'Y'
                 THEN {AS_OF_SQL} ELSE lp.insert_date END AS insert_date,
              {AS_OF_SQL} AS update_date
            FROM progress_keys k JOIN learning l ON l.learning_seq = k.learning_seq
            LEFT JOIN mart lp ON lp.learning_seq = l.learning_seq"""
    ),
    "lookup_enroll_row": _with(
        """SELECT e.enroll_seq, e.course_run_seq, e.confirm_status_cd
           FROM enroll_keys k JOIN enroll e ON e.enroll_seq = k.enroll_seq"""
    ),
    "lookup_enroll_mart": _with(
        f"""SELECT e.enroll_seq, coalesce(em.insert_date, {AS_OF_SQL}) AS insert_date,
              {AS_OF_SQL} AS update_date
            FROM enroll e LEFT JOIN enroll_mart em ON em.enroll_seq = e.enroll_seq"""
    ),
    "soft_delete_flag": f"""SELECT event_id, CASE WHEN {FLAG_TYPE} = 'LMCT01'
        AND {FLAG_STATUS} = 'LMER01' THEN 'N' ELSE 'Y' END AS delete_yn FROM events""",
    "progress_rows": _with(_rows("facts"), _FACTS),
    "progress_rows_sql": _with(_rows("facts"), _FACTS),
    "progress_rows_one_per_key": _with(_rows("facts", one=True), _FACTS),
    "progress_rows_kept": _with(_rows("facts", one=True), _FACTS),
    "progress_rows_null_as_zero": _with(_rows("facts", zero=True), _FACTS),
    "enroll_rows": _with(_enroll("enroll_keys")),
    "enroll_rows_sql": _with(_enroll("enroll_keys")),
    "enroll_rows_from_enroll": _with(_enroll("enroll_keys", "e.course_run_seq")),
    "enroll_rows_fallthrough": _with(
        _enroll("(SELECT DISTINCT CAST(seq AS BIGINT) AS enroll_seq FROM touched)")
    ),
    "tombstones": _with(
        f"SELECT {_TOMBSTONE} FROM expanded WHERE confirm_status_cd <> 'LMER01'"
    ),
    "last_learning": _with(
        """SELECT m.enroll_seq, l.learning_seq FROM enroll_msg m JOIN
             (SELECT enroll_seq, max(learning_seq) AS learning_seq FROM learning GROUP BY 1) l
             ON l.enroll_seq = m.enroll_seq"""
    ),
    "progress_rows_with_tombstones": _with(_with_tombstones("facts"), _FACTS, _REVIVED),
    "progress_rows_last_only": _with(
        _with_tombstones("facts"), _LAST_KEYS, _facts("facts", "last_keys"), _REVIVED
    ),
    "merge_progress": _MERGED,
    "merge_progress_flag_missing": _with(
        _merge("mart", "flagged", "learning_seq"),
        _FACTS,
        _ROWS,
        f"""flagged AS (SELECT * FROM rows_one UNION ALL
            SELECT m.* REPLACE ({AS_OF_SQL} AS update_date, 'Y' AS delete_yn)
            FROM mart m JOIN progress_keys USING (learning_seq)
            WHERE m.learning_seq NOT IN (SELECT learning_seq FROM rows_one) AND m.delete_yn <> 'Y')""",
    ),
    "merge_two_writers": _MERGED,
    "merge_enroll": _MERGED_ENROLL,
    "rebuild_progress": _with(_rows("all_facts", one=True), _ALL_FACTS),
    "rebuild_enroll": _with(_enroll("all_enroll_keys")),
    "reconcile_progress": _with(
        _differences(_UNDATED),
        _FACTS,
        _ROWS,
        _ALL_FACTS,
        f"rebuilt AS ({_rows('all_facts', one=True)})",
        f"merged AS ({_merge('mart', 'rows_one', 'learning_seq')})",
    ),
    "reconcile_enroll": _with(
        _differences("enroll_seq, course_run_seq, delete_yn"),
        _ENROLL_ROWS,
        f"rebuilt AS ({_enroll('all_enroll_keys')})",
        f"merged AS ({_merge('enroll_mart', 'enroll_new', 'enroll_seq')})",
    ),
    "stream_progress": _MERGED,
    "stream_restart": _MERGED,
    "stream_restart_audit": _with(
        """SELECT CASE WHEN table_name IN ('TBL_ENROLL', 'TBL_LEARNING_SUBJECT') THEN table_name
                  ELSE 'other' END AS name,
             CASE WHEN NOT sound THEN 'bad_json' END AS reason, count(*) AS n
           FROM parsed GROUP BY 1, 2
           UNION ALL SELECT 'quarantine', 'bad_json', count(*) FROM parsed WHERE NOT sound"""
    ),
    "stream_enroll": _MERGED_ENROLL,
    "stream_quarantine": _with(
        "SELECT value, 'bad_json' AS reason, count(*) AS n FROM parsed WHERE NOT sound GROUP BY 1"
    ),
    "stream_audit": _with(
        """SELECT 'messages' AS kind,
             CASE WHEN table_name IN ('TBL_ENROLL', 'TBL_LEARNING_SUBJECT') THEN table_name
                  ELSE 'other' END AS name,
             CASE WHEN NOT sound THEN 'bad_json' END AS reason,
             count(*) AS n, CAST(NULL AS BIGINT) AS n_keys
           FROM parsed GROUP BY 1, 2, 3
           UNION ALL SELECT 'keys', target, NULL, count(*), count(DISTINCT seq)
           FROM touched GROUP BY target"""
    ),
    "stream_tombstones": _TOMBSTONE_MART,
}
