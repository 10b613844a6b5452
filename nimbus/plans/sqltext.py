"""SQL building blocks (DuckDB dialect) shared by the oracle queries."""

from __future__ import annotations

from nimbus.functions.codes import BEAUFORT_LOWER_KMH, BEAUFORT_NAMES, MONTHLY_NORMAL_C
from nimbus.sources.stations import OBS_RAW_SQL

D01 = "CAST(0.1 AS DOUBLE)"
D36 = "CAST(3.6 AS DOUBLE)"


def beaufort_case(x: str) -> str:
    parts = [f"WHEN {x} IS NULL THEN NULL", f"WHEN {x} < {BEAUFORT_LOWER_KMH[0]} THEN 0"]
    for force, upper in enumerate(BEAUFORT_LOWER_KMH[1:], start=1):
        parts.append(f"WHEN {x} < {upper} THEN {force}")
    return "CASE " + " ".join(parts) + " ELSE 12 END"


def beaufort_name_case(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = {i} THEN '{n}'" for i, n in enumerate(BEAUFORT_NAMES)) + " END"


def direction_case(d: str) -> str:
    return (
        f"CASE WHEN {d} = 0 THEN 'calm' WHEN {d} = 990 THEN 'variable' "
        f"WHEN {d} > 0 AND {d} < 90 THEN 'NE' WHEN {d} = 90 THEN 'E' "
        f"WHEN {d} > 90 AND {d} < 180 THEN 'SE' WHEN {d} = 180 THEN 'S' "
        f"WHEN {d} > 180 AND {d} < 270 THEN 'SW' WHEN {d} = 270 THEN 'W' "
        f"WHEN {d} > 270 AND {d} < 360 THEN 'NW' WHEN {d} = 360 THEN 'N' "
        "ELSE 'Invalid direction' END"
    )


def part_case(h: str) -> str:
    return (
        f"CASE WHEN {h} BETWEEN 5 AND 11 THEN 'Morning' WHEN {h} BETWEEN 12 AND 17 THEN 'Afternoon' "
        f"WHEN {h} BETWEEN 18 AND 24 THEN 'Evening' ELSE 'Night' END"
    )


def season_case(m: str) -> str:
    return (
        f"CASE WHEN {m} IN (12, 1, 2) THEN 'Winter' WHEN {m} IN (3, 4, 5) THEN 'Spring' "
        f"WHEN {m} IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"
    )


def normal_case(m: str) -> str:
    return "CASE " + " ".join(
        f"WHEN {m} = {i + 1} THEN CAST({v} AS DOUBLE)" for i, v in enumerate(MONTHLY_NORMAL_C)
    ) + " END"


def ymd_to_date(x: str) -> str:
    return f"CAST(strptime(CAST({x} AS VARCHAR), '%Y%m%d') AS DATE)"


def date_to_int(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


CLEAN_SQL = f"""
SELECT CAST(STN AS INTEGER) AS station, CAST(YYYYMMDD AS INTEGER) AS date,
  {part_case('HH')} AS Time_Category,
  CAST(ceil(CAST(T AS DOUBLE) * {D01}) AS BIGINT) AS temperature,
  CAST(HH AS INTEGER) AS hour,
  {direction_case('DD')} AS winddirection,
  {beaufort_case(f'(CAST(FH AS DOUBLE) * {D01} * {D36})')} AS beaufort,
  round_even(CAST(FX AS DOUBLE) * {D01} * {D36}, 1) AS wind_gust,
  CAST(SQ AS INTEGER) AS sunshine, CAST(DR AS INTEGER) AS precipitationduration,
  CAST(RH AS INTEGER) AS precipitation, CAST(VV AS INTEGER) AS visibility,
  CAST(N AS INTEGER) AS cloudcover, CAST(M AS INTEGER) AS fog, CAST(R AS INTEGER) AS rain,
  CAST(S AS INTEGER) AS snow, CAST(O AS INTEGER) AS thunderstorm, CAST(Y AS INTEGER) AS iceformation,
  round_even({normal_case(f'month({ymd_to_date("YYYYMMDD")})')}, 1) AS Avg_Temperature,
  {ymd_to_date('YYYYMMDD')} AS obs_date
FROM ({OBS_RAW_SQL}) raw
"""

# A WITH clause defining ``obs`` (cleaned observations over events).
WITH_OBS = f"WITH obs AS ({CLEAN_SQL})"
