"""Registered queries over cleaned observations (observations built from ``events``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions import codes
from nimbus.operators import weather
from nimbus.operators.clean import clean_observations
from nimbus.plans.registry import register
from nimbus.plans.sqltext import (
    WITH_OBS, beaufort_case, beaufort_name_case, date_to_int, season_case,
)
from nimbus.sources.stations import observations_from_events
from nimbus.sources.tables import load


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned observations over the driver's ``events`` table."""
    return clean_observations(observations_from_events(load(spark, sf_dir, "events")))


# --- codings --------------------------------------------------------------------

@register("clean_observations", "P1 P2 P4 P5 P6 P7 F1 F3 F4 F6 F7", f"{WITH_OBS} SELECT * FROM obs")
def q_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir)


@register(
    "beaufort_hist", "P5 F1",
    f"{WITH_OBS} SELECT beaufort, CAST(count(*) AS BIGINT) AS n_hours FROM obs GROUP BY beaufort",
)
def q_beaufort_hist(spark, sf_dir):
    return observations(spark, sf_dir).groupBy("beaufort").agg(F.count(F.lit(1)).alias("n_hours"))


@register(
    "beaufort_names", "F1 F2",
    f"{WITH_OBS} SELECT station, date, hour, beaufort, {beaufort_name_case('beaufort')} AS wind_name FROM obs",
)
def q_beaufort_names(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return obs.select("station", "date", "hour", "beaufort", codes.beaufort_name("beaufort").alias("wind_name"))


@register(
    "wind_direction_hist", "F3",
    f"{WITH_OBS} SELECT winddirection, CAST(count(*) AS BIGINT) AS n_hours FROM obs GROUP BY winddirection",
)
def q_wind_direction_hist(spark, sf_dir):
    return observations(spark, sf_dir).groupBy("winddirection").agg(F.count(F.lit(1)).alias("n_hours"))


@register(
    "part_of_day_summary", "F4 P6",
    f"""{WITH_OBS} SELECT station, date, Time_Category, CAST(count(*) AS BIGINT) AS n_hours,
    min(temperature) AS min_temperature, max(temperature) AS max_temperature
    FROM obs GROUP BY station, date, Time_Category""",
)
def q_part_of_day_summary(spark, sf_dir):
    return (
        observations(spark, sf_dir)
        .groupBy("station", "date", "Time_Category")
        .agg(
            F.count(F.lit(1)).alias("n_hours"),
            F.min("temperature").alias("min_temperature"),
            F.max("temperature").alias("max_temperature"),
        )
    )


@register(
    "visibility_decoded", "F17 F18",
    f"""{WITH_OBS} SELECT station, date, hour,
    CASE WHEN precipitation < 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(precipitation AS DOUBLE) * CAST(0.1 AS DOUBLE) END AS precipitation_mm,
    precipitation = -1 AS precipitation_trace,
    CAST(sunshine AS DOUBLE) * CAST(0.1 AS DOUBLE) AS sunshine_h,
    CAST(precipitationduration AS DOUBLE) * CAST(0.1 AS DOUBLE) AS rain_duration_h,
    cloudcover = 9 AS sky_invisible,
    CASE WHEN visibility = 0 THEN 0 WHEN visibility BETWEEN 1 AND 50 THEN visibility * 100
         WHEN visibility BETWEEN 56 AND 79 THEN (visibility - 50) * 1000
         WHEN visibility BETWEEN 80 AND 88 THEN (visibility - 74) * 5000
         WHEN visibility = 89 THEN 70000 END AS visibility_min_m,
    CASE WHEN visibility = 0 THEN 100 WHEN visibility BETWEEN 1 AND 49 THEN visibility * 100 + 100
         WHEN visibility = 50 THEN 6000
         WHEN visibility BETWEEN 56 AND 79 THEN (visibility - 49) * 1000
         WHEN visibility BETWEEN 80 AND 88 THEN (visibility - 73) * 5000 END AS visibility_max_m
    FROM obs""",
)
def q_visibility_decoded(spark, sf_dir):
    return weather.decoded_codes(observations(spark, sf_dir))


# --- lookups and set operations ---------------------------------------------------

_SECTION = "Time_Category, temperature, winddirection, beaufort, precipitation, sunshine, cloudcover, fog, rain, snow, thunderstorm"


@register(
    "today_tomorrow_union", "P10 U1",
    f"""{WITH_OBS}
    SELECT station, date, {_SECTION} FROM obs
      WHERE hour BETWEEN 5 AND 17 OR hour BETWEEN 18 AND 23 OR hour BETWEEN 0 AND 4
    UNION
    SELECT station, {date_to_int('obs_date - INTERVAL 1 DAY')} AS date, {_SECTION} FROM obs""",
)
def q_today_tomorrow_union(spark, sf_dir):
    return weather.today_tomorrow_union(observations(spark, sf_dir))


@register(
    "period_lookup", "R1",
    f"""{WITH_OBS} SELECT station, date, Time_Category,
    string_agg(CAST(hour AS VARCHAR) || ':' || COALESCE(CAST(temperature AS VARCHAR), 'None') || ':' || winddirection
               || ':' || CAST(beaufort AS VARCHAR), ';' ORDER BY hour) AS rows_text
    FROM obs GROUP BY station, date, Time_Category""",
)
def q_period_lookup(spark, sf_dir):
    """Every (station, date, part) lookup at once, rows as text in hour order."""
    obs = observations(spark, sf_dir)
    row = F.struct(
        "hour",
        F.concat_ws(
            ":", F.col("hour").cast("string"), F.coalesce(F.col("temperature").cast("string"), F.lit("None")),
            "winddirection", F.col("beaufort").cast("string"),
        ).alias("t"),
    )
    return (
        obs.groupBy("station", "date", "Time_Category")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(row)), lambda r: r["t"]), ";").alias("rows_text"))
    )


@register(
    "full_day_lookup", "A6",
    f"""{WITH_OBS} SELECT station, date, CAST(count(*) AS BIGINT) AS n_hours,
    CAST(count(DISTINCT Time_Category) AS BIGINT) AS n_parts,
    min(temperature) AS min_temperature, max(temperature) AS max_temperature
    FROM obs WHERE Time_Category IS NOT NULL GROUP BY station, date""",
)
def q_full_day_lookup(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return (
        obs.where(F.col("Time_Category").isNotNull())
        .groupBy("station", "date")
        .agg(
            F.count(F.lit(1)).alias("n_hours"),
            F.count_distinct("Time_Category").alias("n_parts"),
            F.min("temperature").alias("min_temperature"),
            F.max("temperature").alias("max_temperature"),
        )
    )


# --- monthly analytics -------------------------------------------------------------

@register(
    "rain_days", "A9",
    f"""{WITH_OBS} SELECT station, CAST(date // 100 AS INTEGER) AS month,
    CAST(count(DISTINCT date) AS BIGINT) AS rain_days
    FROM obs WHERE rain = 1 GROUP BY station, CAST(date // 100 AS INTEGER)""",
)
def q_rain_days(spark, sf_dir):
    return weather.rain_days(observations(spark, sf_dir))


@register(
    "monthly_temperature", "A10",
    f"""{WITH_OBS} SELECT station, CAST(date // 100 AS INTEGER) AS month,
    round_even(avg(temperature), 6) AS avg_temperature, CAST(count(temperature) AS BIGINT) AS n_readings
    FROM obs GROUP BY station, CAST(date // 100 AS INTEGER)""",
)
def q_monthly_temperature(spark, sf_dir):
    return weather.monthly_temperature(observations(spark, sf_dir))


@register(
    "coldest_day", "A11",
    f"""{WITH_OBS} SELECT station, date, CAST(date // 100 % 100 AS INTEGER) AS month, hour, temperature FROM (
      SELECT *, row_number() OVER (PARTITION BY station ORDER BY temperature, date, hour) AS rn
      FROM obs WHERE temperature IS NOT NULL) t WHERE rn = 1""",
)
def q_coldest_day(spark, sf_dir):
    return weather.coldest_day(observations(spark, sf_dir))


@register(
    "hottest_hour", "A12 R2",
    f"""{WITH_OBS} SELECT station, month, date, hour, temperature FROM (
      SELECT *, CAST(date // 100 AS INTEGER) AS month,
        row_number() OVER (PARTITION BY station, date // 100 ORDER BY temperature DESC, date, hour) AS rn
      FROM obs WHERE temperature IS NOT NULL) t WHERE rn = 1""",
)
def q_hottest_hour(spark, sf_dir):
    return weather.hottest_hour(observations(spark, sf_dir))


@register(
    "season_orders", "F5 F7 A14",
    f"SELECT DISTINCT {season_case('month(o_orderdate)')} AS season FROM orders",
)
def q_season_orders(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return weather.distinct_seasons(orders, "o_orderdate")


@register(
    "long_dates_next_day", "F9 F10",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
    strftime(CAST(o_orderdate AS DATE), '%B %d, %Y') AS long_date,
    CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE) AS next_date,
    strftime(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY, '%B %d, %Y') AS long_next_date
    FROM orders""",
)
def q_long_dates(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return orders.select(
        "o_orderkey",
        d.alias("order_date"),
        codes.long_date(d).alias("long_date"),
        codes.next_day_of(d).alias("next_date"),
        codes.long_date(codes.next_day_of(d)).alias("long_next_date"),
    )


# --- sky ------------------------------------------------------------------------

_SKY_SQL = f"""{WITH_OBS},
w AS (
  SELECT *, COALESCE(fog = 1 AND max(sunshine) OVER (PARTITION BY station, date, Time_Category ORDER BY hour
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) > sunshine, false) AS fts FROM obs),
a AS (
  SELECT station, date, Time_Category, avg(sunshine) AS s, avg(least(cloudcover, 8)) AS n,
    max(rain) AS rain, max(snow) AS snow, max(fog) AS fog, max(thunderstorm) AS thunder, bool_or(fts) AS fts,
    CAST(count(*) AS BIGINT) AS n_rows
  FROM w GROUP BY station, date, Time_Category)
SELECT station, date, Time_Category, n_rows, round_even(s, 6) AS mean_sunshine, round_even(n, 6) AS mean_cloud,
  CASE
    WHEN thunder = 1 AND rain = 1 AND s >= 1 AND n >= 1 THEN 'Thunderstorms'
    WHEN thunder = 1 AND s >= 1 AND n >= 1 THEN 'Cumulus clouds and thunderstorms'
    WHEN snow = 1 AND rain = 1 AND s <= 2 THEN 'Winter showers'
    WHEN snow = 1 AND s >= 1 THEN 'Sun and snow showers'
    WHEN snow = 1 THEN 'Snow showers'
    WHEN fts THEN 'Fog followed by sun'
    WHEN fog = 1 THEN 'Foggy'
    WHEN rain = 1 AND s > 2 AND s < 7 AND n >= 7 THEN 'Sun and showers'
    WHEN rain = 1 AND s <= 2 THEN 'Occasional rain'
    WHEN rain = 1 THEN 'Rain'
    WHEN s >= 7 THEN 'Sunny'
    WHEN s = 0 AND n >= 7 THEN 'Gray and hardly sunny'
    WHEN s <= 2 AND n >= 7 THEN 'Gray'
    WHEN s >= 1 AND n >= 1 THEN 'Sun and cumulus clouds'
    ELSE 'Partly cloudy' END AS sky
FROM a"""


@register("sky_condition", "F16 W1", _SKY_SQL)
def q_sky_condition(spark, sf_dir):
    return weather.sky_condition(observations(spark, sf_dir))


@register(
    "fog_then_sun", "W1",
    f"""{WITH_OBS} SELECT station, date, Time_Category, bool_or(fts) AS fog_then_sun FROM (
      SELECT *, COALESCE(fog = 1 AND max(sunshine) OVER (PARTITION BY station, date, Time_Category ORDER BY hour
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) > sunshine, false) AS fts FROM obs) t
    GROUP BY station, date, Time_Category""",
)
def q_fog_then_sun(spark, sf_dir):
    return weather.fog_then_sun(observations(spark, sf_dir))
