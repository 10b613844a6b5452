"""Raw hourly observations -> the cleaned 19-column observation table.

One ``select``: coerce, scale, code, project, round and rename in a single
narrow projection, so the whole step is one whole-stage-codegen span with no
shuffle and no Python, and Catalyst prunes the raw columns nobody uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.functions import codes

# The reference's required columns, in order, and their new names.
REQUIRED_RAW = [
    "STN", "YYYYMMDD", "Time_Category", "T", "HH", "DD", "FH", "FX", "SQ", "DR",
    "RH", "VV", "N", "M", "R", "S", "O", "Y", "Avg_Temperature",
]
CLEAN_NAMES = [
    "station", "date", "Time_Category", "temperature", "hour", "winddirection",
    "beaufort", "wind_gust", "sunshine", "precipitationduration", "precipitation",
    "visibility", "cloudcover", "fog", "rain", "snow", "thunderstorm",
    "iceformation", "Avg_Temperature",
]

# The 11 columns a report section shows, in table order.
SECTION_COLUMNS = [
    "Time_Category", "temperature", "winddirection", "beaufort", "precipitation",
    "sunshine", "cloudcover", "fog", "rain", "snow", "thunderstorm",
]


def clean_observations(raw: DataFrame, with_obs_date: bool = True) -> DataFrame:
    """Cleaned observations.

    * temperature: tenths -> degrees, rounded **up** (``ceil``); null stays null
    * beaufort: FH (0.1 m/s) -> km/h -> force 0..12; null stays null
    * wind_gust: FX (0.1 m/s) -> km/h, rounded to 1 decimal half-even (``bround``)
    * winddirection: degrees -> text
    * Time_Category: part of day of the hour
    * Avg_Temperature: monthly normal, rounded to 1 decimal half-even
    * obs_date (extra, optional): the date as DATE for date arithmetic
    """
    month = F.month(codes.obs_date("YYYYMMDD"))
    out = raw.select(
        F.col("STN").cast("int").alias("station"),
        F.col("YYYYMMDD").cast("int").alias("date"),
        codes.part_of_day("HH").alias("Time_Category"),
        F.ceil(codes.tenths("T")).alias("temperature"),
        F.col("HH").cast("int").alias("hour"),
        codes.wind_direction("DD").alias("winddirection"),
        codes.beaufort(codes.wind_kmh("FH")).alias("beaufort"),
        F.bround(codes.wind_kmh("FX"), 1).alias("wind_gust"),
        F.col("SQ").cast("int").alias("sunshine"),
        F.col("DR").cast("int").alias("precipitationduration"),
        F.col("RH").cast("int").alias("precipitation"),
        F.col("VV").cast("int").alias("visibility"),
        F.col("N").cast("int").alias("cloudcover"),
        F.col("M").cast("int").alias("fog"),
        F.col("R").cast("int").alias("rain"),
        F.col("S").cast("int").alias("snow"),
        F.col("O").cast("int").alias("thunderstorm"),
        F.col("Y").cast("int").alias("iceformation"),
        F.bround(codes.normal_temperature(month), 1).alias("Avg_Temperature"),
    )
    if with_obs_date:
        out = out.withColumn("obs_date", codes.obs_date("date"))
    return out
