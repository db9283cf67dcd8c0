"""Parameter sets.

Every operator takes a ``PipelineConfig``; nothing below the config layer
hard-codes a cutoff, a window, a treated set or a threshold.  Two profiles
ship with the library:

* ``TAXI`` - the values of the original yellow-taxi study.
* ``TPCH_TRIPS`` - the same study re-aimed at the trips adapter over the
  TPC-H style test tables (see ``cordon.sources.adapter``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Bounds:
    """Inclusive/exclusive limits of the range assertions (DQ3)."""

    distance_max: float = 200.0          # (0, distance_max]
    fare_max: float = 5000.0             # [0, fare_max]
    total_max: float = 5000.0            # [0, total_max]
    minutes_max: int = 1440              # [0, minutes_max]
    tip_pct_max: float = 5.0             # [0, tip_pct_max] when not NULL


@dataclass(frozen=True)
class PipelineConfig:
    # grain window: pickups in [window_start, window_end) are kept
    window_start: dt.date
    window_end: dt.date
    # policy date: dates >= cutoff are 'post'
    cutoff: dt.date
    # placebo: fake cutoff, evaluated on dates < placebo_end only
    placebo_cutoff: dt.date
    placebo_end: dt.date
    # treated zones = borough in treated_boroughs AND zone name in treated_zones
    treated_boroughs: tuple[str, ...]
    treated_zones: tuple[str, ...]
    # zones moved across the boundary by the sensitivity analysis
    borderline_zones: tuple[str, ...] = ()
    # decode tables (code, description)
    payment_codes: tuple[tuple[int, str], ...] = ()
    ratecode_codes: tuple[tuple[int, str], ...] = ()
    vendor_codes: tuple[tuple[int, str], ...] = ()
    unknown_ratecode: int = 99
    card_payment: int = 1
    weekend_iso_days: tuple[int, ...] = (6, 7)
    bounds: Bounds = field(default_factory=Bounds)
    reconciliation_tolerance: float = 0.02
    min_segment_trips: int = 1000
    top_segments: int = 25
    deciles: int = 10

    @property
    def expected_months(self) -> int:
        s, e = self.window_start, self.window_end
        months = (e.year - s.year) * 12 + (e.month - s.month)
        return months + (1 if e.day > 1 else 0)

    @property
    def last_window_date(self) -> dt.date:
        return self.window_end - dt.timedelta(days=1)

    def with_(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)


# ---------------------------------------------------------------------------
# Fixed values of the original study (they must equal the study's values for
# the same results): decode tables, daypart hours, treated zone names.
# ---------------------------------------------------------------------------

# payment type code -> description
TAXI_PAYMENT_CODES = (
    (1, "Credit card"), (2, "Cash"), (3, "No charge"),
    (4, "Dispute"), (5, "Unknown"), (6, "Voided trip"),
)

# rate code -> description (99 = Unknown, used for NULL rate codes)
TAXI_RATECODE_CODES = (
    (1, "Standard rate"), (2, "JFK"), (3, "Newark"),
    (4, "Nassau/Westchester"), (5, "Negotiated fare"), (6, "Group ride"),
    (99, "Unknown"),
)

# vendor id -> description
TAXI_VENDOR_CODES = (
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc."),
    (6, "Myle Technologies"),
    (7, "Helix"),
)

# dayparts: (name, first hour, last hour), inclusive; hours not covered
# fall into OVERNIGHT
DAYPARTS = (
    ("AM peak", 6, 9),
    ("Midday", 10, 15),
    ("PM peak", 16, 19),
    ("Evening", 20, 23),
)
OVERNIGHT = "Overnight"

# treated zones of the original study: Manhattan zones at or below 60th St
TAXI_TREATED_BOROUGHS = ("Manhattan",)
TAXI_TREATED_ZONES = (
    "Midtown Center", "Midtown East", "Midtown North", "Midtown South",
    "Times Sq/Theatre District", "Garment District", "Clinton East", "Clinton West",
    "Murray Hill", "Kips Bay", "Gramercy", "Flatiron", "Union Sq",
    "East Chelsea", "West Chelsea/Hudson Yards", "Hudson Sq",
    "Greenwich Village North", "Greenwich Village South", "West Village",
    "East Village", "SoHo", "Little Italy/NoLiTa", "Chinatown", "Two Bridges/Seward Park",
    "Lower East Side", "Financial District North", "Financial District South",
    "World Trade Center", "Battery Park", "Battery Park City", "Seaport",
    "TriBeCa/Civic Center", "Stuy Town/Peter Cooper Village", "Meatpacking/West Village West",
    "Sutton Place/Turtle Bay North", "UN/Turtle Bay South", "Park Ave South",
    "Penn Station/Madison Sq West",
)

# raw columns whose absence is schema drift (DQ5), lower-cased
EXPECTED_RAW_COLUMNS = (
    "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "passenger_count", "trip_distance", "ratecodeid", "pulocationid",
    "dolocationid", "payment_type", "fare_amount", "tip_amount",
    "tolls_amount", "total_amount",
)

TAXI = PipelineConfig(
    window_start=dt.date(2024, 1, 1),
    window_end=dt.date(2025, 4, 1),
    cutoff=dt.date(2025, 1, 5),
    placebo_cutoff=dt.date(2024, 7, 1),
    placebo_end=dt.date(2025, 1, 5),
    treated_boroughs=TAXI_TREATED_BOROUGHS,
    treated_zones=TAXI_TREATED_ZONES,
    payment_codes=TAXI_PAYMENT_CODES,
    ratecode_codes=TAXI_RATECODE_CODES,
    vendor_codes=TAXI_VENDOR_CODES,
)

# The study re-aimed at the adapter over the test tables: the window covers
# every complete month of order dates, zones are nations, boroughs regions.
TPCH_TRIPS = TAXI.with_(
    window_start=dt.date(1995, 1, 1),
    window_end=dt.date(2001, 8, 1),
    cutoff=dt.date(2000, 10, 5),
    placebo_cutoff=dt.date(2000, 4, 1),
    placebo_end=dt.date(2000, 10, 5),
    treated_boroughs=("AMERICA",),
    treated_zones=("NATION_1", "NATION_6", "NATION_11", "NATION_16"),
    borderline_zones=("NATION_21",),
    bounds=Bounds(fare_max=120000.0, total_max=120000.0),
    min_segment_trips=30,
)
