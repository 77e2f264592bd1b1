"""Column-level building blocks: number coercion, dates and flags."""

from martkeep.functions.dates import (
    as_of_column,
    insert_date,
    parse_start_time,
    start_time_millis,
)
from martkeep.functions.flags import delete_flag, is_unconfirmed
from martkeep.functions.numbers import key_number, zero_if_null

__all__ = [
    "as_of_column",
    "delete_flag",
    "insert_date",
    "is_unconfirmed",
    "key_number",
    "parse_start_time",
    "start_time_millis",
    "zero_if_null",
]
