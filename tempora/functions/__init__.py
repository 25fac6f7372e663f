from tempora.functions.timefns import (  # noqa: F401
    time_bucket, local_bucket, bucket, at_time_zone, from_local, weekday_abbrev, hour_of_day,
    hour_interval, month_start, ntz_literal, epoch_seconds, from_epoch_seconds, trailing,
    bucket_floor, bucket_ceil, parse_width, WEEKDAYS,
)
from tempora.functions.aggs import (  # noqa: F401
    first_at, last_at, counter_delta, ohlc, temperature_stats, median_exact,
    median_approx, kll_sketch, kll_merge, kll_median, round_half_even,
)
