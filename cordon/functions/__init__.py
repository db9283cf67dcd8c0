from cordon.functions.columns import (
    add_minutes,
    date_key,
    daypart,
    iso_dow,
    month_label,
    ntz,
    trip_key,
    whole_minutes,
)

__all__ = [
    "add_minutes", "date_key", "daypart", "iso_dow", "month_label", "ntz",
    "trip_key", "whole_minutes",
]
