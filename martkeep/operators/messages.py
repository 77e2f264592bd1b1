"""From raw message text to typed, classified messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeep.functions.numbers import key_number
from martkeep.schema import ENROLL_TABLE, ENVELOPE, SUBJECT_TABLE

_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_malformed",
    "allowUnquotedFieldNames": "true",
    "allowSingleQuotes": "true",
    "allowNonNumericNumbers": "true",
}

# A message is decoded as the first of two documents; if the second is not this one, the
# text holds something else after (or instead of) one document.
_MARK = "martkeep-end"

ON_ERROR = ("quarantine", "skip", "fail")


def read_messages(
    raw: DataFrame,
    *,
    on_error: str = "quarantine",
    coercion: str = "strict",
    key_type: str = "int",
    require_status: bool = False,
    require_source_ts: bool = True,
) -> DataFrame:
    """One row per non-empty message with its fields and, if unusable, a ``reason``.

    ``raw`` needs a string column ``value``; its other columns are carried along.
    With ``on_error="fail"`` the first unusable message fails the query; otherwise it
    stays in the result (see :func:`accepted` and :func:`rejected`). Messages of
    tables that no mart depends on have no reason and are not accepted either. A value must
    be one JSON document and nothing else. ``require_status`` without
    ``require_source_ts`` is what the earlier job asks of a message.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    carried = [F.col(name) for name in raw.columns]
    # The decoded struct goes through a generator, which keeps the optimizer from
    # pushing later filters below it and decoding every message once more per filter.
    text = F.concat(F.lit('{"_pair":['), "value", F.lit(f',{{"_end":"{_MARK}"}}]}}'))
    schema = f"_pair ARRAY<STRUCT<{ENVELOPE}>>, _malformed STRING"
    decoded = raw.where(F.length("value") > 0).select(
        *carried, F.inline(F.array(F.from_json(text, schema, _JSON_OPTIONS)))
    )
    whole = (
        F.col("_malformed").isNull()
        & (F.size("_pair") == 2)
        & (F.get("_pair", F.lit(1))["_end"] == _MARK)
    )
    blank = F.length(F.btrim("value", F.lit(" \t\r\n"))) == 0  # a document without anything
    decoded = decoded.withColumn("_whole", F.coalesce(whole | blank, F.lit(False)))
    payload = F.when(F.col("_whole"), F.get("_pair", F.lit(0))["payload"])
    enroll_text = payload.getField("Enroll_Seq")
    learning_text = payload.getField("Learning_Seq")
    fields = decoded.select(
        *carried,
        payload.getField("__table").alias("table_name"),
        payload.getField("__source_ts_ms").alias("source_ts_ms"),
        key_number(enroll_text, key_type, coercion).alias("enroll_seq"),
        key_number(learning_text, key_type, coercion).alias("learning_seq"),
        payload.getField("Confirm_Status_Cd").alias("confirm_status_cd"),
        _reason(payload, key_type, coercion, require_status, require_source_ts).alias("reason"),
    )
    if on_error == "fail":
        message = F.concat(F.lit("unusable message, reason: "), F.col("reason"))
        # In a filter, so that no choice of columns and no count goes without it.
        stop = F.when(F.col("reason").isNotNull(), F.raise_error(message).cast("boolean"))
        fields = fields.where(stop.otherwise(F.lit(True)))
    return fields


def _reason(
    payload: Column, key_type: str, coercion: str, require_status: bool, require_source_ts: bool
) -> Column:
    """Why a message cannot be used; NULL when it can or is of no interest."""
    table = payload.getField("__table")
    from_enroll = table == ENROLL_TABLE
    key_text = F.when(from_enroll, payload.getField("Enroll_Seq")).when(
        table == SUBJECT_TABLE, payload.getField("Learning_Seq")
    )
    keyed = table.isin(ENROLL_TABLE, SUBJECT_TABLE)
    reason = (
        F.when(~F.col("_whole"), "bad_json")
        .when(payload.isNull(), "missing_payload")
        .when(table.isNull(), "missing_table")
        .when(
            payload.getField("__source_ts_ms").isNull() & F.lit(require_source_ts),
            "missing_source_ts",
        )
        .when(keyed & key_text.isNull(), "missing_key")
        .when(keyed & key_number(key_text, key_type, coercion).isNull(), "bad_key")
    )
    if require_status:
        status = payload.getField("Confirm_Status_Cd")
        reason = reason.when(from_enroll & status.isNull(), "missing_status")
    return reason


def accepted(messages: DataFrame) -> DataFrame:
    """Usable messages of the two tables that touch mart keys."""
    return messages.where(
        F.col("reason").isNull() & F.col("table_name").isin(ENROLL_TABLE, SUBJECT_TABLE)
    )


def rejected(messages: DataFrame) -> DataFrame:
    """Unusable messages with the reason."""
    return messages.where(F.col("reason").isNotNull())


def since(messages: DataFrame, start_millis: int) -> DataFrame:
    """Messages without those whose source time is before ``start_millis``.

    For replayable file sources; a broker is asked for the offset instead. A message
    without a readable time is kept, to be rejected for its own reason.
    """
    source_time = F.col("source_ts_ms").try_cast("double")
    return messages.where(F.coalesce(source_time >= F.lit(start_millis), F.lit(True)))


def named_rows(rows: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Give positional columns the names and types of ``types``."""
    return rows.select(
        *(
            F.col(f"`{have}`").cast(kind).alias(name)
            for have, (name, kind) in zip(rows.columns, types.items(), strict=True)
        )
    )
