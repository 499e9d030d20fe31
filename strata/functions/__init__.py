from strata.functions.clean import (  # noqa: F401
    count_where, is_filled, is_missing, is_null, is_token, normalize_label, pair_state,
    parse_date, parse_number, parse_ts, row_stats, signed_pair,
    try_parse_number,
)
