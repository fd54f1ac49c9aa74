from orderloom.functions.columns import (  # noqa: F401
    CHANNELS, REALIZED_STATUSES, REGIONS, RETURNED_STATUS, SEGMENTS, UNKNOWN,
    blank_to_null, canonicalize, date_key, exact_sum, money_round, month_start,
    percent, realized, realized_amount, realized_revenue, return_rate,
    sentence_case, trimmed, try_double, try_integer, try_timestamp,
)
