"""Lookups and summaries over cleaned observations.

Input everywhere: the cleaned table of ``nimbus.operators.clean`` (``station``,
``date`` as int yyyymmdd, ``obs_date`` DATE, ``hour``, ``Time_Category``, ...).
Every operator is a lazy DataFrame transformation.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbus.functions import codes
from nimbus.operators.clean import SECTION_COLUMNS

# The hour ranges of the reference's literal lookup (hours run 1..24, so 18..23
# leaves hour 24 out; the query keeps that gap on purpose).
LITERAL_HOUR_RANGES = [(5, 17), (18, 23), (0, 4)]


# --- predicates -------------------------------------------------------------

def on_date(df: DataFrame, yyyymmdd: int) -> DataFrame:
    """Point lookup on the integer date (pushed into the Parquet scan)."""
    return df.where(F.col("date") == F.lit(int(yyyymmdd)))


def hour_in_ranges(ranges: Sequence[tuple[int, int]] = LITERAL_HOUR_RANGES) -> Column:
    """Disjunction of closed hour ranges."""
    cond = F.lit(False)
    for lo, hi in ranges:
        cond = cond | F.col("hour").between(lo, hi)
    return cond


def in_month(yyyymm: int) -> Column:
    """``date LIKE 'yyyymm%'`` as an integer range, so it stays a pushable range filter."""
    return F.col("date").between(int(yyyymm) * 100 + 1, int(yyyymm) * 100 + 31)


def period_rows(df: DataFrame, station: int, yyyymmdd: int, part: str | None = None) -> DataFrame:
    """Rows of one part of one day at one station; ``part=None`` = the full day.

    The full day is ``date = d AND Time_Category IS NOT NULL`` (the reference's
    template text says OR, which would select the whole table).
    """
    cond = (F.col("station") == F.lit(int(station))) & (F.col("date") == F.lit(int(yyyymmdd)))
    if part is None:
        cond = cond & F.col("Time_Category").isNotNull()
    else:
        cond = cond & (F.col("Time_Category") == F.lit(part))
    return df.where(cond).select(*SECTION_COLUMNS, "hour").orderBy("hour").drop("hour")


# --- set operation ------------------------------------------------------------

def today_tomorrow_union(df: DataFrame, station: int | None = None, yyyymmdd: int | None = None) -> DataFrame:
    """Hours of a day in the literal ranges UNION (distinct) all hours of the next day.

    The projection has no hour column, so equal readings merge, as a SQL UNION
    does. With ``station``/``yyyymmdd`` it is the reference's single lookup
    (ordered by part of day); without them it answers that lookup for every
    station-day at once, keyed by ``(station, date)`` of the first day, as one
    distinct aggregation (one shuffle) instead of one query per day.
    """
    cols = [F.col(c) for c in SECTION_COLUMNS]
    prev = codes.date_to_int(F.date_sub("obs_date", 1))
    if station is not None:
        df = df.where(F.col("station") == int(station))
    if yyyymmdd is not None:
        # the two days themselves, so that the test reaches the scan
        day = datetime.strptime(str(int(yyyymmdd)), "%Y%m%d")
        df = df.where(F.col("date").isin(int(yyyymmdd), int((day + timedelta(days=1)).strftime("%Y%m%d"))))
    # each reading belongs to its own day (when its hour is in the ranges) and, as
    # the next day, to the day before: one pass over the observations, one distinct
    anchors = F.array(F.when(hour_in_ranges(), F.col("date")), prev)
    out = df.select("station", F.explode(anchors).alias("date"), *cols).where(F.col("date").isNotNull())
    if yyyymmdd is not None:
        out = out.where(F.col("date") == int(yyyymmdd))
    out = out.distinct()
    if station is not None and yyyymmdd is not None:
        return out.drop("station", "date").orderBy("Time_Category")
    return out


# --- aggregations --------------------------------------------------------------

def rain_days(df: DataFrame) -> DataFrame:
    """Distinct days with rain per station and month."""
    return (
        df.where(F.col("rain") == 1)
        .groupBy("station", (F.col("date") / 100).cast("int").alias("month"))
        .agg(F.count_distinct("date").alias("rain_days"))
    )


def monthly_temperature(df: DataFrame, digits: int = 6) -> DataFrame:
    """Mean temperature (degrees C) per station and month, nulls skipped."""
    return (
        df.groupBy("station", (F.col("date") / 100).cast("int").alias("month"))
        .agg(
            F.bround(F.avg("temperature"), digits).alias("avg_temperature"),
            F.count("temperature").alias("n_readings"),
        )
    )


# Ordered packing of a reading into one long: temperature (whole degrees, |t| < 10^8)
# x 10^10 + date (yyyymmdd, 8 digits) x 100 + hour (2 digits). Comparing the packed
# values compares (temperature, date, hour), so a plain min / max is a fixed-width
# hash aggregate (partial before the shuffle) instead of a sort-based min_by of structs.
_T, _D = 10**10, 100


def coldest_day(df: DataFrame) -> DataFrame:
    """Per station: the coldest reading's date, month, hour and temperature.
    Null temperatures are left out; ties go to the earliest date and hour."""
    key = F.col("temperature").cast("long") * _T + F.col("date").cast("long") * _D + F.col("hour")
    m = df.where(F.col("temperature").isNotNull()).groupBy("station").agg(F.min(key).alias("k"))
    dh = F.pmod(F.col("k"), F.lit(_T))
    date = (dh / _D).cast("int")
    return m.select(
        "station",
        date.alias("date"),
        (date / 100 % 100).cast("int").alias("month"),
        (dh % _D).cast("int").alias("hour"),
        F.floor(F.col("k") / _T).cast("long").alias("temperature"),
    )


def hottest_hour(df: DataFrame) -> DataFrame:
    """Per station and month: the first reading whose temperature is the month's
    maximum (earliest date and hour among equals)."""
    # date and hour enter reversed, so the largest key is the earliest among the hottest
    key = (F.col("temperature").cast("long") * _T + (99_999_999 - F.col("date").cast("long")) * _D
           + (99 - F.col("hour")))
    m = (
        df.where(F.col("temperature").isNotNull())
        .groupBy("station", (F.col("date") / 100).cast("int").alias("month"))
        .agg(F.max(key).alias("k"))
    )
    dh = F.pmod(F.col("k"), F.lit(_T))
    return m.select(
        "station", "month",
        (99_999_999 - (dh / _D).cast("long")).cast("int").alias("date"),
        (99 - dh % _D).cast("int").alias("hour"),
        F.floor(F.col("k") / _T).cast("long").alias("temperature"),
    )


def hottest_in_month(df: DataFrame, station: int, yyyymm: int) -> DataFrame:
    """The reference's single-month form: order by temperature descending, limit 1."""
    return (
        df.where((F.col("station") == int(station)) & in_month(yyyymm))
        .select("date", "hour", "temperature")
        .orderBy(F.desc("temperature"), "date", "hour")
        .limit(1)
    )


def distinct_seasons(df: DataFrame, date_col: str = "obs_date") -> DataFrame:
    """Distinct seasons present in a date column."""
    return df.select(codes.season(F.month(date_col)).alias("season")).distinct()


# --- sky condition of a section -------------------------------------------------

# Sky wording, most specific rule first.
SKY_WORDS = [
    "Thunderstorms", "Cumulus clouds and thunderstorms", "Winter showers",
    "Sun and snow showers", "Snow showers", "Fog followed by sun", "Foggy",
    "Sun and showers", "Occasional rain", "Rain", "Sunny", "Gray and hardly sunny",
    "Gray", "Sun and cumulus clouds", "Partly cloudy",
]

SECTION_KEYS = ["station", "date", "Time_Category"]


def fog_then_sun_rows(df: DataFrame, keys: Sequence[str] = SECTION_KEYS) -> DataFrame:
    """Per row: fog now and more sunshine at some later hour of the same section."""
    w = Window.partitionBy(*keys).orderBy("hour").rowsBetween(1, Window.unboundedFollowing)
    later_sun = F.max("sunshine").over(w)
    return df.withColumn(
        "fog_then_sun", F.coalesce((F.col("fog") == 1) & (later_sun > F.col("sunshine")), F.lit(False))
    )


def fog_then_sun(df: DataFrame, keys: Sequence[str] = SECTION_KEYS) -> DataFrame:
    """Per section: did fog give way to sun. The window and the aggregate share
    one hash partitioning, so this is one shuffle."""
    return fog_then_sun_rows(df, keys).groupBy(*keys).agg(F.bool_or("fog_then_sun").alias("fog_then_sun"))


def sky_condition(df: DataFrame, keys: Sequence[str] = SECTION_KEYS, words: Sequence[str] = SKY_WORDS) -> DataFrame:
    """Sky wording per section from sunshine, cloud cover and the weather flags.

    s = mean sunshine (tenths of an hour per hour), n = mean cloud cover with code
    9 counted as 8; flags are the maximum over the section. Ample sun s>=7,
    moderate 2<s<7, some s>=1, low s<=2; high cloud n>=7, some cloud n>=1.
    """
    agg = fog_then_sun_rows(df, keys).groupBy(*keys).agg(
        F.avg("sunshine").alias("s"),
        F.avg(F.least(F.col("cloudcover"), F.lit(8))).alias("n"),
        F.max("rain").alias("rain"),
        F.max("snow").alias("snow"),
        F.max("fog").alias("fog"),
        F.max("thunderstorm").alias("thunder"),
        F.bool_or("fog_then_sun").alias("fts"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    s, n = F.col("s"), F.col("n")
    rain, snow, fog, thunder = (F.col(c) == 1 for c in ("rain", "snow", "fog", "thunder"))
    some_sun, low_sun = s >= 1, s <= 2
    high_cloud, some_cloud = n >= 7, n >= 1
    w = list(words)
    sky = (
        F.when(thunder & rain & some_sun & some_cloud, w[0])
        .when(thunder & some_sun & some_cloud, w[1])
        .when(snow & rain & low_sun, w[2])
        .when(snow & some_sun, w[3])
        .when(snow, w[4])
        .when(F.col("fts"), w[5])
        .when(fog, w[6])
        .when(rain & (s > 2) & (s < 7) & high_cloud, w[7])
        .when(rain & low_sun, w[8])
        .when(rain, w[9])
        .when(s >= 7, w[10])
        .when((s == 0) & high_cloud, w[11])
        .when(low_sun & high_cloud, w[12])
        .when(some_sun & some_cloud, w[13])
        .otherwise(w[14])
    )
    return agg.select(*keys, "n_rows", F.bround(s, 6).alias("mean_sunshine"), F.bround(n, 6).alias("mean_cloud"), sky.alias("sky"))


def decoded_codes(df: DataFrame) -> DataFrame:
    """Observation codes decoded into units (extra columns; raw codes stay)."""
    vis = codes.visibility_band("visibility")
    return df.select(
        "station", "date", "hour",
        codes.precipitation_mm("precipitation").alias("precipitation_mm"),
        codes.is_trace("precipitation").alias("precipitation_trace"),
        codes.hours_from_tenths("sunshine").alias("sunshine_h"),
        codes.hours_from_tenths("precipitationduration").alias("rain_duration_h"),
        codes.sky_invisible("cloudcover").alias("sky_invisible"),
        vis.getField("min_m").alias("visibility_min_m"),
        vis.getField("max_m").alias("visibility_max_m"),
    )
