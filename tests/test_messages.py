import pytest

import world
from martkeep import operators as ops
from martkeep.functions import start_time_millis


def parsed(spark, *messages, **options):
    rows = ops.read_messages(world.raw(spark, *messages), **options).collect()
    return {row.value: row for row in rows}


def test_empty_and_null_messages_vanish(spark):
    assert parsed(spark, "", None) == {}


@pytest.mark.parametrize(
    ("message", "reason"),
    [
        ("not json", "bad_json"),
        ("[1]", "bad_json"),
        ('{"payload": 5}', "bad_json"),
        ('{"payload":{"__table":"TBL_ENROLL"', "bad_json"),
        (" ", "missing_payload"),
        ('{"payload":null}', "missing_payload"),
        ("{}", "missing_payload"),
        ('{"payload":{"__source_ts_ms":1}}', "missing_table"),
        ('{"payload":{"__table":"TBL_ENROLL","Enroll_Seq":1}}', "missing_source_ts"),
        ('{"payload":{"__table":"TBL_ENROLL","__source_ts_ms":1}}', "missing_key"),
        (world.enroll_message("abc"), "bad_key"),
        (world.enroll_message("NaN"), "bad_key"),
        (world.enroll_message(3e9), "bad_key"),
        (world.subject_message("12x"), "bad_key"),
        ('{"payload":{"__table":"TBL_OTHER","__source_ts_ms":1}}', None),
        (world.enroll_message(1), None),
    ],
)
def test_reasons(spark, message, reason):
    messages = ops.read_messages(world.raw(spark, message))
    assert messages.first().reason == reason
    usable = reason is None and "OTHER" not in message
    assert ops.accepted(messages).count() == usable
    assert ops.rejected(messages).count() == (reason is not None)


@pytest.mark.parametrize(
    ("sent", "key"),
    [(12, 12), (12.7, 12), ("12.7", 12), (-12.7, -12), ("-12.7", -12), (" 7 ", 7), (0, 0)],
)
def test_numbers_lose_their_fraction(spark, sent, key):
    messages = ops.read_messages(world.raw(spark, world.subject_message(sent)))
    assert ops.accepted(messages).first().learning_seq == key


@pytest.mark.parametrize(
    ("sent", "key"),
    [(3e9, 2147483647), (-3e9, -2147483648), ("NaN", 0), (12.7, 12), ("-12.7", -12)],
)
def test_clamped_numbers(spark, sent, key):
    raw = world.raw(spark, world.enroll_message(sent))
    assert ops.accepted(ops.read_messages(raw, coercion="clamp")).first().enroll_seq == key


def test_clamping_still_rejects_text(spark):
    raw = world.raw(spark, world.enroll_message("abc"))
    assert ops.read_messages(raw, coercion="clamp").first().reason == "bad_key"


def test_wide_keys_keep_all_digits(spark):
    raw = world.raw(spark, world.subject_message(2**53 + 1), world.subject_message("3000000000.9"))
    rows = ops.accepted(ops.read_messages(raw, key_type="bigint")).collect()
    assert {row.learning_seq for row in rows} == {2**53 + 1, 3000000000}


def test_lenient_json(spark):
    single = "{'payload':{'__table':'TBL_ENROLL','__source_ts_ms':1,'Enroll_Seq':3}}"
    unquoted = '{payload:{__table:"TBL_ENROLL",__source_ts_ms:1,Enroll_Seq:4}}'
    messages = ops.accepted(ops.read_messages(world.raw(spark, single, unquoted)))
    assert {row.enroll_seq for row in messages.collect()} == {3, 4}


def test_fail_mode_stops_at_a_bad_message(spark):
    good = world.raw(spark, world.enroll_message(1), "")
    assert ops.accepted(ops.read_messages(good, on_error="fail")).count() == 1
    bad = world.raw(spark, world.enroll_message(1), "not json")
    with pytest.raises(Exception, match="bad_json"):
        ops.accepted(ops.read_messages(bad, on_error="fail")).count()
    with pytest.raises(ValueError):
        ops.read_messages(good, on_error="ignore")


def test_required_status(spark):
    raw = world.raw(spark, world.enroll_message(1, status=None), world.subject_message(2))
    reasons = {row.table_name: row.reason for row in ops.read_messages(raw, require_status=True).collect()}
    assert reasons == {"TBL_ENROLL": "missing_status", "TBL_LEARNING_SUBJECT": None}
    assert ops.rejected(ops.read_messages(raw)).count() == 0


def test_other_columns_are_carried(spark):
    raw = world.raw(spark, world.enroll_message(1)).selectExpr("7 AS offset", "value")
    assert ops.read_messages(raw).first().offset == 7


def test_each_message_is_decoded_once(spark):
    messages = ops.accepted(ops.read_messages(world.raw(spark, world.enroll_message(1))))
    plan = messages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_start_time(spark):
    assert start_time_millis(spark, "20220928133000") == 1664371800000
    raw = world.raw(
        spark,
        world.subject_message(1, ts=1664371799999),
        world.subject_message(2, ts=1664371800000),
    )
    kept = ops.since(ops.read_messages(raw), 1664371800000).collect()
    assert [row.learning_seq for row in kept] == [2]


def test_named_rows(spark):
    rows = spark.createDataFrame([(1.0, "x")], ["_1", "_2"])
    named = ops.named_rows(rows, {"Learning_Seq": "int", "Target_Table": "string"})
    assert named.dtypes == [("Learning_Seq", "int"), ("Target_Table", "string")]
    with pytest.raises(ValueError):
        ops.named_rows(rows, {"Learning_Seq": "int"}).collect()


@pytest.mark.parametrize(
    "message",
    [
        world.enroll_message(1) + " trailing",
        world.enroll_message(1) + world.enroll_message(7),
        world.enroll_message(1) + "," + world.enroll_message(7),
        world.enroll_message(1) + "]",
        "[" + world.enroll_message(1) + "]",
        world.enroll_message(1) + ',{"_end":"martkeep-end"}',
    ],
)
def test_a_value_is_one_document(spark, message):
    assert ops.read_messages(world.raw(spark, message)).first().reason == "bad_json"


def test_nothing_prunes_the_strict_mode(spark):
    messages = ops.read_messages(world.raw(spark, world.enroll_message(1), "not json"), on_error="fail")
    for action in (lambda: messages.count(), lambda: messages.select("enroll_seq").collect()):
        with pytest.raises(Exception, match="bad_json"):
            action()
    sound = world.raw(spark, world.enroll_message(1), "", '{"payload":{"__table":"X","__source_ts_ms":1}}')
    assert ops.read_messages(sound, on_error="fail").count() == 2


def test_what_the_earlier_job_asks_of_a_message(spark):
    text = '{"payload":{"__table":"TBL_ENROLL","Enroll_Seq":1,"Confirm_Status_Cd":"LMER01"}}'
    asked = {"require_status": True, "require_source_ts": False}
    assert ops.read_messages(world.raw(spark, text), **asked).first().reason is None
    bare = text.replace("Confirm", "Other")
    assert ops.read_messages(world.raw(spark, bare), **asked).first().reason == "missing_status"
