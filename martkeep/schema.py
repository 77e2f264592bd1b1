"""Names and types shared by every part of the package.

Column names are lower case; Spark resolves names without regard to case, so
tables that spell them ``Learning_Seq`` work unchanged.
"""

from __future__ import annotations

# They must equal what the change feed and the source tables carry.
ENROLL_TABLE = "TBL_ENROLL"
SUBJECT_TABLE = "TBL_LEARNING_SUBJECT"
CONFIRMED_STATUS = "LMER01"
COUNTED_COURSE_TYPE = "LMCT01"

# Envelope of one message. Every field is read as text and cast afterwards, so
# that 13, 13.0 and "13" are all accepted.
ENVELOPE = (
    "payload STRUCT<`__table`: STRING, `__source_ts_ms`: STRING, Enroll_Seq: STRING,"
    " Learning_Seq: STRING, Confirm_Status_Cd: STRING>, _end STRING"
)

# Columns the mart queries read, per source table. Readers select exactly these,
# so a JDBC or Parquet scan never fetches more.
SOURCE_COLUMNS = {
    "learning": ("learning_seq", "enroll_seq", "course_run_seq", "learner_seq"),
    "course_run": ("course_run_seq", "course_run_nm", "course_seq"),
    "course": ("course_seq", "course_id", "course_type_cd"),
    "enroll": ("enroll_seq", "course_run_seq", "confirm_status_cd"),
    "learning_subject": ("learning_seq", "learning_subject_seq", "progress_ratio"),
}

# Unique numbers by which a table can be read in ranges of even size.
SOURCE_KEYS = {
    "learning": "learning_seq",
    "course_run": "course_run_seq",
    "course": "course_seq",
    "enroll": "enroll_seq",
    "learning_subject": "learning_subject_seq",
}

# Names of the source tables in the operational database.
SOURCE_TABLES = {
    "learning": "TBL_LEARNING",
    "course_run": "TBL_COURSE_RUN",
    "course": "TBL_COURSE",
    "enroll": "TBL_ENROLL",
    "learning_subject": "TBL_LEARNING_SUBJECT",
}

PROGRESS_KEY = "learning_seq"
PROGRESS_SCHEMA = (
    "learning_seq INT, course_run_nm STRING, course_id STRING, course_run_seq INT,"
    " learner_seq INT, progress_ratio DOUBLE, learning_subject_seq INT,"
    " insert_date TIMESTAMP, update_date TIMESTAMP, delete_yn STRING"
)
PROGRESS_COLUMNS = tuple(part.split()[0] for part in PROGRESS_SCHEMA.split(","))

ENROLL_KEY = "enroll_seq"
ENROLL_SCHEMA = (
    "enroll_seq INT, course_run_seq INT, insert_date TIMESTAMP,"
    " update_date TIMESTAMP, delete_yn STRING"
)
ENROLL_COLUMNS = tuple(part.split()[0] for part in ENROLL_SCHEMA.split(","))

# Routing tags: which mart a key belongs to.
PROGRESS = "progress"
ENROLL = "enroll"
