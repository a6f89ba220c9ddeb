from hublytics.functions.semantics import *  # noqa: F401,F403
from hublytics.functions.semantics import (  # noqa: F401
    round_like, pct, ratio, safe_ratio, to_bigint, money, clean_text, lower_trim,
    normalize_plate, normalize_order_status, order_outcome_group, client_channel,
    action_name, parse_date, parse_timestamp, seconds_between, hours_between,
    date_key, week_start, tenure_days, volumetric_weight, add_hours,
)
