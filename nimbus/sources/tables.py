"""Parquet tables and named SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions.codes import STATION_TABLES

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(observations: DataFrame, name: str = "observations") -> list[str]:
    """Register cleaned observations as one view plus one filter view per location.

    The reference keeps one SQL table per location; here there is one table and
    the location views are filters on ``station``, so a query on a location view
    prunes to that station's partition when the table is partitioned by station.
    Existing views of the same names are replaced.
    """
    observations.createOrReplaceTempView(name)
    names = [name]
    for view, station in STATION_TABLES.items():
        observations.where(F.col("station") == F.lit(station)).createOrReplaceTempView(view)
        names.append(view)
    return names
