from rainroute.functions.calendar import day_category, hour_of_clock, hour_of_timestamp, is_weekend
from rainroute.functions.names import canonical_name, mapped_name
from rainroute.functions.rain import DRY, rain_band, rain_band_contiguous

__all__ = [
    "DRY",
    "canonical_name",
    "day_category",
    "hour_of_clock",
    "hour_of_timestamp",
    "is_weekend",
    "mapped_name",
    "rain_band",
    "rain_band_contiguous",
]
