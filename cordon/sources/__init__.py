from cordon.sources.adapter import tpch_raw_trips, tpch_trip_count, tpch_zone_lookup
from cordon.sources.raw import (
    read_raw_trips,
    read_zone_lookup,
    write_raw_months,
    write_zone_lookup_csv,
)

__all__ = [
    "read_raw_trips", "read_zone_lookup", "tpch_raw_trips", "tpch_trip_count", "tpch_zone_lookup",
    "write_raw_months", "write_zone_lookup_csv",
]
