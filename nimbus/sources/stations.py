"""Hourly station observations: the CSV reader and an adapter over ``events``.

Raw observation columns (one row per station, date and hour):
``STN YYYYMMDD HH DD FH FX T T10N TD SQ DR RH VV N M R S O Y``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.session import materialised

RAW_COLUMNS = "STN YYYYMMDD HH DD FH FX T T10N TD SQ DR RH VV N M R S O Y".split()
# Columns that may arrive as blank text and are coerced to numbers.
_SOFT_NUMERIC = {"T", "T10N", "TD"}


def _cells(line: Column) -> Column:
    """The cells of a line, without blanks and quotes around them."""
    return F.transform(F.split(F.ltrim(line, F.lit("# ")), ","), lambda c: F.btrim(c, F.lit(" \t\r\"")))


def read_stations(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Read hourly station CSVs (comma, header, header names padded with blanks).

    ``paths`` are files, directories or globs; every file may have its columns in an order
    of its own. The text is scanned once for the rows: each line finds its columns through the
    places its own file's header gives them. Those places (one row per file) come from a pass
    over the header lines before, are written once and joined by file name, so a thousand files
    make one scan, not a thousand. A header is a line that names STN and YYYYMMDD; lines before
    it that are no rows (comments) are dropped with it. A blank, broken or missing cell is null.
    A file without such a line, or without one of the required columns, is an error.
    """
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths)).select("value", F.col("_metadata.file_path").alias("file"))
    names = _cells(F.col("value"))
    heads = lines.where(F.col("value").contains("YYYYMMDD") & F.col("value").contains("STN")).select("file", names.alias("names"))
    places = F.array(*[F.array_position("names", c).cast("int") for c in RAW_COLUMNS])
    heads = materialised(heads.groupBy("file").agg(F.min("names").alias("names")).select("file", places.alias("at")), "station-headers")
    lacking = heads.where(F.array_min("at") == 0).limit(1).collect()
    if lacking:
        raise ValueError(f"{lacking[0]['file']}: no column {RAW_COLUMNS[lacking[0]['at'].index(0)]}")
    # only rows start with a number
    rows = lines.where(F.col("value").rlike(r'^[\s"]*[0-9]')).select("file", _cells(F.col("value")).alias("cells"))
    found = rows.join(heads.withColumnRenamed("file", "head_file"), F.col("file") == F.col("head_file"), "left")
    at = F.coalesce("at", F.raise_error(F.concat(F.lit("no header in "), F.col("file"))).cast("array<int>"))
    placed = found.select("cells", at.alias("at"))
    cell = lambda k: F.try_element_at("cells", F.col("at")[k])
    return placed.select(*[cell(k).try_cast("double" if c in _SOFT_NUMERIC else "int").alias(c) for k, c in enumerate(RAW_COLUMNS)])


def observations_from_events(events: DataFrame) -> DataFrame:
    """Raw hourly observations derived from the driver's ``events`` table.

    Half of the users report to the five named stations, every other user is a
    station of its own (``1000 + user_id``), so observations grow with the data.
    An observation folds all events of its station, date and hour: readings come
    from integer sums, flags from the parity of a count, so every event counts.
    One scan and one hash aggregate; a hot station ships one row per hour and task.
    """
    stn = F.lit(None).cast("long")
    for at, number in reversed(list(enumerate((260, 370, 344, 240, 380)))):
        stn = F.when(F.col("user_id") % 10 == at, F.lit(number).cast("long")).otherwise(stn)
    k = F.get_json_object("props", "$.k").try_cast("int")
    et = F.col("event_type")
    seen = events.select(
        F.coalesce(stn, 1000 + F.col("user_id")).cast("int").alias("STN"),
        (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).alias("YYYYMMDD"),
        (F.hour("ts") + 1).alias("HH"),
        F.floor("value").cast("long").alias("v"), F.col("event_id").alias("e"), et.alias("et"), k.alias("k"),
    )
    count = lambda test: F.sum(F.when(test, 1).otherwise(0))
    hours = seen.groupBy("STN", "YYYYMMDD", "HH").agg(
        F.count("*").alias("n"),
        F.sum("v").alias("v"),
        F.sum("e").alias("e"),
        F.sum(F.coalesce("k", F.lit(0)).cast("long")).alias("k"),
        count(F.col("et") == "error").alias("errors"),
        count((F.col("et") == "error") & (F.col("k") % 10 == 0)).alias("lost"),
        count(F.col("et") == "view").alias("views"),
        count(F.col("k") % 7 == 0).alias("fogs"),
        count((F.col("et") == "signup") & (F.col("k") % 3 == 0)).alias("snows"),
        count((F.col("et") == "purchase") & (F.col("k") % 4 == 0)).alias("storms"),
        count(F.col("k") % 10 == 0).alias("ices"),
    )
    wet = F.col("views") % 2 == 1
    # no temperature where every event of the hour lost it
    t = F.when(F.col("lost") < F.col("n"), F.col("v") % 400 - 50)
    readings = {
        "DD": F.when(F.col("errors") * 2 > F.col("n"), 990).otherwise(F.col("e") * 10 % 370),
        "FH": F.col("v") % 50 * 10,
        "FX": F.col("v") % 50 * 10 + 30,
        "T": t,
        "T10N": t - 20,
        "TD": t - 35,
        "SQ": F.col("e") % 11,
        "DR": F.when(wet, F.col("e") % 11).otherwise(0),
        "RH": F.when(wet, F.col("k") % 25 - 1).otherwise(0),
        "VV": F.col("e") % 90,
        "N": F.col("e") % 10,
        "M": F.col("fogs") % 2,
        "R": F.col("views") % 2,
        "S": F.col("snows") % 2,
        "O": F.col("storms") % 2,
        "Y": F.col("ices") % 2,
    }
    return hours.select(*[F.col(c) if c in ("STN", "YYYYMMDD", "HH") else readings[c].cast("int").alias(c) for c in RAW_COLUMNS])


# The same adapter in SQL (DuckDB dialect), used by the oracle queries.
OBS_RAW_SQL = """
SELECT STN, YYYYMMDD, HH,
  CASE WHEN errors * 2 > n THEN 990 ELSE CAST(e * 10 % 370 AS INTEGER) END AS DD,
  CAST(v % 50 * 10 AS INTEGER) AS FH,
  CAST(v % 50 * 10 + 30 AS INTEGER) AS FX,
  CASE WHEN lost < n THEN CAST(v % 400 - 50 AS INTEGER) END AS T,
  CASE WHEN lost < n THEN CAST(v % 400 - 50 AS INTEGER) END - 20 AS T10N,
  CASE WHEN lost < n THEN CAST(v % 400 - 50 AS INTEGER) END - 35 AS TD,
  CAST(e % 11 AS INTEGER) AS SQ,
  CASE WHEN views % 2 = 1 THEN CAST(e % 11 AS INTEGER) ELSE 0 END AS DR,
  CASE WHEN views % 2 = 1 THEN CAST(k % 25 - 1 AS INTEGER) ELSE 0 END AS RH,
  CAST(e % 90 AS INTEGER) AS VV,
  CAST(e % 10 AS INTEGER) AS N,
  CAST(fogs % 2 AS INTEGER) AS M,
  CAST(views % 2 AS INTEGER) AS R,
  CAST(snows % 2 AS INTEGER) AS S,
  CAST(storms % 2 AS INTEGER) AS O,
  CAST(ices % 2 AS INTEGER) AS Y
FROM (
  SELECT
    CAST(CASE user_id % 10 WHEN 0 THEN 260 WHEN 1 THEN 370 WHEN 2 THEN 344 WHEN 3 THEN 240 WHEN 4 THEN 380
      ELSE 1000 + user_id END AS INTEGER) AS STN,
    CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS YYYYMMDD,
    CAST(hour(ts) + 1 AS INTEGER) AS HH,
    count(*) AS n, sum(CAST(floor(value) AS BIGINT)) AS v, sum(event_id) AS e, sum(coalesce(k, 0)) AS k,
    count(*) FILTER (WHERE event_type = 'error') AS errors,
    count(*) FILTER (WHERE event_type = 'error' AND k % 10 = 0) AS lost,
    count(*) FILTER (WHERE event_type = 'view') AS views,
    count(*) FILTER (WHERE k % 7 = 0) AS fogs,
    count(*) FILTER (WHERE event_type = 'signup' AND k % 3 = 0) AS snows,
    count(*) FILTER (WHERE event_type = 'purchase' AND k % 4 = 0) AS storms,
    count(*) FILTER (WHERE k % 10 = 0) AS ices
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e0
  GROUP BY 1, 2, 3
) e1
"""
