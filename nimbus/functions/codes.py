"""Column -> Column codings of hourly station observations.

All of these are native Catalyst expressions (chained CASE, map lookups, date
functions), so they stay inside whole-stage code generation and can be pushed
into Parquet filters when used in a predicate. None of them needs Python.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's for the same results.
# Beaufort force lower bounds in km/h for forces 1..12 (closed below, open above).
BEAUFORT_LOWER_KMH = [1, 6, 12, 20, 29, 38, 50, 62, 75, 89, 103, 118]
# Beaufort force names for forces 0..12.
BEAUFORT_NAMES = [
    "Calm", "Light Air", "Light Breeze", "Gentle Breeze", "Moderate Breeze",
    "Fresh Breeze", "Strong Breeze", "Near Gale", "Gale", "Strong Gale",
    "Storm", "Violent Storm", "Hurricane",
]
# Monthly normal temperature in degrees Celsius, January..December.
MONTHLY_NORMAL_C = [3.45, 3.9, 6.45, 9.3, 12.95, 15.6, 17.9, 17.7, 15.5, 11.55, 7.3, 4.2]
# Locations and their station codes.
STATIONS = {
    "De Bilt": 260,
    "Eindhoven": 370,
    "Amsterdam": 240,
    "Maastricht": 380,
    "Rotterdam": 344,
}
# SQL table names of the five locations.
STATION_TABLES = {
    "De_Bilt": 260,
    "eindhoven": 370,
    "Rotterdam": 344,
    "Amsterdam": 240,
    "Maastricht": 380,
}
# Parts of the day by hour (1..24): 5-11 Morning, 12-17 Afternoon, 18-24 Evening, else Night.
PARTS_OF_DAY = ["Morning", "Afternoon", "Evening", "Night"]
# Seasons by month: 12, 1, 2 Winter; 3-5 Spring; 6-8 Summer; else Autumn.
# Wind direction: 0 calm, 990 variable, 90 E, 180 S, 270 W, 360 N, open quadrants
# NE / SE / SW / NW, anything else 'Invalid direction'.
# Request heading: HEADING_LOCATION location HEADING_DATE 'Month dd, yyyy' [HEADING_TIME part].
HEADING_LOCATION, HEADING_DATE, HEADING_TIME = "location - ", ", date - ", ", time - "
# Unit scaling: temperatures and durations are in tenths; wind speed in 0.1 m/s,
# turned into km/h by x 0.1 x 18/5.
# ---------------------------------------------------------------------------

M_S_TO_KMH = 18.0 / 5.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tenths(c: Column | str) -> Column:
    """Integer tenths of a unit -> double units, null for text that is no number."""
    return _col(c).try_cast("double") * F.lit(0.1)


def wind_kmh(c: Column | str) -> Column:
    """Wind speed in 0.1 m/s -> km/h, in the reference's order of operations."""
    return _col(c).try_cast("double") * F.lit(0.1) * F.lit(M_S_TO_KMH)


def beaufort(kmh: Column | str) -> Column:
    """Wind speed in km/h -> Beaufort force 0..12; null stays null."""
    c = _col(kmh)
    expr = F.when(c.isNull(), F.lit(None).cast("int")).when(c < BEAUFORT_LOWER_KMH[0], F.lit(0))
    for force, upper in enumerate(BEAUFORT_LOWER_KMH[1:], start=1):
        expr = expr.when(c < upper, F.lit(force))
    return expr.otherwise(F.lit(12))


def beaufort_name(force: Column | str) -> Column:
    """Beaufort force -> English name; unknown force -> null."""
    mapping = F.create_map(*chain.from_iterable((F.lit(i), F.lit(n)) for i, n in enumerate(BEAUFORT_NAMES)))
    return F.try_element_at(mapping, _col(force).cast("int"))


def wind_direction(degrees: Column | str) -> Column:
    """Wind degrees -> compass text; missing or out of range -> 'Invalid direction'."""
    d = _col(degrees)
    return (
        F.when(d == 0, "calm")
        .when(d == 990, "variable")
        .when((d > 0) & (d < 90), "NE")
        .when(d == 90, "E")
        .when((d > 90) & (d < 180), "SE")
        .when(d == 180, "S")
        .when((d > 180) & (d < 270), "SW")
        .when(d == 270, "W")
        .when((d > 270) & (d < 360), "NW")
        .when(d == 360, "N")
        .otherwise("Invalid direction")
    )


def part_of_day(hour: Column | str) -> Column:
    """Hour 1..24 -> Morning / Afternoon / Evening / Night (hours 1-4 and anything else)."""
    h = _col(hour)
    return (
        F.when(h.between(5, 11), "Morning")
        .when(h.between(12, 17), "Afternoon")
        .when(h.between(18, 24), "Evening")
        .otherwise("Night")
    )


def season(month: Column | str) -> Column:
    """Month number -> meteorological season name."""
    m = _col(month)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .otherwise("Autumn")
    )


def normal_temperature(month: Column | str) -> Column:
    """Month number -> monthly normal temperature (unrounded)."""
    mapping = F.create_map(
        *chain.from_iterable((F.lit(i + 1), F.lit(v)) for i, v in enumerate(MONTHLY_NORMAL_C))
    )
    return F.try_element_at(mapping, _col(month).cast("int"))


def obs_date(yyyymmdd: Column | str) -> Column:
    """Integer yyyymmdd -> DATE; invalid -> null."""
    return F.try_to_date(_col(yyyymmdd).cast("string"), "yyyyMMdd")


def long_date(d: Column | str) -> Column:
    """DATE -> 'May 02, 2023'."""
    return F.date_format(_col(d), "MMMM dd, yyyy")


def next_day_of(d: Column | str) -> Column:
    """The following calendar day (crosses month and year ends)."""
    return F.date_add(_col(d), 1)


def date_to_int(d: Column | str) -> Column:
    """DATE -> integer yyyymmdd, the key the observation table carries."""
    c = _col(d)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def visibility_band(code: Column | str) -> Column:
    """Visibility code 0..89 -> struct(min_m, max_m) in metres.

    0 = below 100 m; 1..50 in 100 m steps; 56..79 = (code-50)..(code-49) km;
    80..88 = 30..75 km in 5 km steps; 89 = more than 70 km (no upper bound);
    51..55 and anything else are not codes (null).
    """
    c = _col(code).cast("int")
    lo = (
        F.when(c == 0, F.lit(0))
        .when(c.between(1, 50), c * 100)
        .when(c.between(56, 79), (c - 50) * 1000)
        .when(c.between(80, 88), (c - 74) * 5000)
        .when(c == 89, F.lit(70000))
    )
    hi = (
        F.when(c == 0, F.lit(100))
        .when(c.between(1, 49), c * 100 + 100)
        .when(c == 50, F.lit(6000))
        .when(c.between(56, 79), (c - 49) * 1000)
        .when(c.between(80, 88), (c - 73) * 5000)
    )
    return F.struct(lo.alias("min_m"), hi.alias("max_m"))


def precipitation_mm(code: Column | str) -> Column:
    """Hourly precipitation code (0.1 mm, -1 = trace below 0.05 mm) -> mm; trace -> 0.0."""
    c = _col(code)
    return F.when(c < 0, F.lit(0.0)).otherwise(c.cast("double") * F.lit(0.1))


def is_trace(code: Column | str) -> Column:
    return _col(code) == -1


def sky_invisible(cloud: Column | str) -> Column:
    """Cloud-cover code 9 means the upper sky is invisible."""
    return _col(cloud) == 9


def hours_from_tenths(c: Column | str) -> Column:
    """Sunshine / rain duration in tenths of an hour -> hours."""
    return _col(c).cast("double") * F.lit(0.1)


def request_text(location: Column | str, day: Column | str, part: Column | str | None = None) -> Column:
    """Request heading 'location - L, date - Month dd, yyyy[, time - P]'."""
    base = F.concat(F.lit(HEADING_LOCATION), _col(location), F.lit(HEADING_DATE), long_date(day))
    if part is None:
        return base
    return F.concat(base, F.lit(HEADING_TIME), _col(part))


def parse_request(heading: Column | str) -> Column:
    """Heading -> struct(location, date, part); part null when absent."""
    h = _col(heading)
    loc = F.regexp_extract(h, r"location - (.*?), date - ", 1)
    dtext = F.regexp_extract(h, r"date - ([A-Za-z]+ \d{1,2}, \d{4})", 1)
    part = F.regexp_extract(h, r", time - (.+)$", 1)
    return F.struct(
        F.nullif(loc, F.lit("")).alias("location"),
        F.try_to_date(dtext, "MMMM d, yyyy").alias("date"),
        F.nullif(part, F.lit("")).alias("part"),
    )


def pct_label(c: Column | str, digits: int = 2) -> Column:
    """Share in percent -> '12.34%'. Rounded half-even first, then printed."""
    return F.format_string(f"%.{digits}f%%", F.bround(_col(c), digits))
