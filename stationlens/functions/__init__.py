"""Pure Column builders."""

from stationlens.functions.cleaning import (  # noqa: F401
    blank, label_map, norm, null_flag, ongoing_flag, prefix_code, range_flag,
    safe_decimal, safe_ts, scaled_coordinate, to_day, truthy,
)
from stationlens.functions.labels import (  # noqa: F401
    band, bucket, classify, gap_pct, lookup, map_code, out_of_box, pct_variation,
    price_bucket, spread, surrogate_key, trend, trend_preset, weighted_score,
)
from stationlens.functions.calendar import calendar_columns, iso_weekday, iso_year, week_start  # noqa: F401
