"""DataFrame-to-DataFrame operators: parsing, keys, routing, lookups, folding."""

from martkeep.operators.fold import flag_missing, fold, fold_delta, one_per_key, stamp, top_subject
from martkeep.operators.keys import (
    count_messages,
    distinct_keys,
    expand_counts,
    expand_enrolments,
    keys_by_target,
    keys_of,
    message_keys,
    touched_keys,
    touched_learnings,
)
from martkeep.operators.lookups import (
    LookupPolicy,
    fan_out_left_join,
    in_parts,
    mark_matched,
    narrow,
    part_name,
    with_part,
)
from martkeep.operators.messages import accepted, named_rows, read_messages, rejected, since
from martkeep.operators.routing import route

__all__ = [
    "LookupPolicy",
    "accepted",
    "count_messages",
    "distinct_keys",
    "expand_counts",
    "expand_enrolments",
    "fan_out_left_join",
    "flag_missing",
    "fold",
    "fold_delta",
    "in_parts",
    "keys_by_target",
    "keys_of",
    "mark_matched",
    "message_keys",
    "named_rows",
    "narrow",
    "one_per_key",
    "part_name",
    "read_messages",
    "rejected",
    "route",
    "since",
    "stamp",
    "top_subject",
    "touched_keys",
    "touched_learnings",
    "with_part",
]
