from tierflow.functions.buckets import hash_flag, hash_sample, unit_interval, weighted_choice
from tierflow.functions.ladders import Ladder
from tierflow.functions.scalar import (
    add_days_if,
    age_years,
    dated_sequence_id,
    first_part,
    fingerprint,
    gap,
    join_text,
    last_part,
    mailbox,
    net_of,
    nz,
    padded_key,
    parse_day,
    pct_of,
    signed_movement,
    total,
    when_type,
    zero_fill,
)
