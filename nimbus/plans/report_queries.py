"""Registered report queries.

Requests come from ``orders``: one request per order, location from
``o_custkey`` (five known locations and one unknown, 'Utrecht'), day from
``o_orderkey`` over the 31 days of January 2024 (the observations cover
January 1-30, so the 30th has no next day and the 31st has no data at all).
The batch therefore grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions import codes
from nimbus.operators import report
from nimbus.operators.clean import SECTION_COLUMNS
from nimbus.plans.registry import register
from nimbus.plans.sqltext import WITH_OBS, beaufort_name_case, date_to_int
from nimbus.plans.weather_queries import observations
from nimbus.sources.tables import load

REQUEST_LOCATIONS = [*report.LOCATIONS, "Utrecht"]
FIRST_DAY = "2024-01-01"
N_DAYS = 31


def requests_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    locs = F.array(*[F.lit(x) for x in REQUEST_LOCATIONS])
    base = orders.select(
        F.col("o_orderkey").alias("request_id"),
        F.element_at(locs, (F.pmod("o_custkey", F.lit(len(REQUEST_LOCATIONS))) + 1).cast("int")).alias("location"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod("o_orderkey", F.lit(N_DAYS)).cast("int")).alias("date"),
    )
    return report.finish_requests(report.with_station(base, report.station_dim(spark)))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_dataset(requests_from_orders(spark, sf_dir), observations(spark, sf_dir), stations=report.station_dim(spark))


def _day_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_records(requests_from_orders(spark, sf_dir), observations(spark, sf_dir), stations=report.station_dim(spark))


# --- SQL ----------------------------------------------------------------------------

_LOC_LIST = "[" + ", ".join(f"'{x}'" for x in REQUEST_LOCATIONS) + "]"
_DIM = ", ".join(f"('{loc}', {st})" for loc, st in codes.STATIONS.items())
_SEC_VALUES = ", ".join(
    [f"('{s}', {i}, '{report.SECTION_TITLES[s]}', '{report.SECTION_TITLES[s]}')" for i, s in enumerate(report.SECTIONS[:4])]
    + [f"('tomorrow', 4, 'Tomorrow', '{p}')" for p in ("Morning", "Afternoon", "Evening", "Night")]
)
_COLS = ", ".join(f"o.{c}" for c in SECTION_COLUMNS)

REPORT_CTES = f"""{WITH_OBS},
r0 AS (
  SELECT o_orderkey AS request_id,
    list_element({_LOC_LIST}, CAST(o_custkey % {len(REQUEST_LOCATIONS)} AS INTEGER) + 1) AS location,
    CAST(DATE '{FIRST_DAY}' + CAST(o_orderkey % {N_DAYS} AS INTEGER) AS DATE) AS date
  FROM orders),
req AS (
  SELECT r0.request_id, r0.location, dim.station, r0.date, CAST(r0.date + INTERVAL 1 DAY AS DATE) AS next_date,
    'location - ' || r0.location || ', date - ' || strftime(r0.date, '%B %d, %Y') AS heading
  FROM r0 LEFT JOIN (VALUES {_DIM}) dim(location, station) ON r0.location = dim.location),
sec AS (
  SELECT req.request_id, s.section, s.ord, s.title, req.station,
    CASE WHEN s.section = 'tomorrow' THEN req.next_date ELSE req.date END AS kd, s.part
  FROM req CROSS JOIN (VALUES {_SEC_VALUES}) s(section, ord, title, part)),
rows AS (
  SELECT sec.request_id, sec.section, sec.ord, sec.title, o.hour, {_COLS}
  FROM sec LEFT JOIN obs o
    ON o.station = sec.station AND o.date = {date_to_int('sec.kd')} AND o.Time_Category = sec.part)"""

_CELLS = " || ".join(f"'<td>' || COALESCE(CAST({c} AS VARCHAR), 'None') || '</td>'" for c in SECTION_COLUMNS)
_HEAD = "".join(f"<th>{h}</th>" for h in report.TABLE_HEADINGS)

REPORT_RECORD_CTES = f"""{REPORT_CTES},
w AS (
  SELECT *, COALESCE(fog = 1 AND max(sunshine) OVER (PARTITION BY request_id, section ORDER BY hour
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) > sunshine, false) AS fts FROM rows),
sa AS (
  SELECT request_id, section, ord, title, count(hour) AS n, avg(sunshine) AS s, avg(least(cloudcover, 8)) AS nc,
    max(rain) AS rain, max(snow) AS snow, max(fog) AS fog, max(thunderstorm) AS thunder, bool_or(fts) AS fts,
    min(temperature) AS tmin, max(temperature) AS tmax, max(beaufort) AS mb,
    string_agg(CASE WHEN hour IS NOT NULL THEN '<tr>' || {_CELLS} || '</tr>' END, '' ORDER BY hour) AS body
  FROM w GROUP BY request_id, section, ord, title),
st AS (
  SELECT *, CASE WHEN n = 0 THEN title || ': No data.' ELSE title || ': ' ||
    CASE
      WHEN thunder = 1 AND rain = 1 AND s >= 1 AND nc >= 1 THEN 'Thunderstorms'
      WHEN thunder = 1 AND s >= 1 AND nc >= 1 THEN 'Cumulus clouds and thunderstorms'
      WHEN snow = 1 AND rain = 1 AND s <= 2 THEN 'Winter showers'
      WHEN snow = 1 AND s >= 1 THEN 'Sun and snow showers'
      WHEN snow = 1 THEN 'Snow showers'
      WHEN fts THEN 'Fog followed by sun'
      WHEN fog = 1 THEN 'Foggy'
      WHEN rain = 1 AND s > 2 AND s < 7 AND nc >= 7 THEN 'Sun and showers'
      WHEN rain = 1 AND s <= 2 THEN 'Occasional rain'
      WHEN rain = 1 THEN 'Rain'
      WHEN s >= 7 THEN 'Sunny'
      WHEN s = 0 AND nc >= 7 THEN 'Gray and hardly sunny'
      WHEN s <= 2 AND nc >= 7 THEN 'Gray'
      WHEN s >= 1 AND nc >= 1 THEN 'Sun and cumulus clouds'
      ELSE 'Partly cloudy' END
    || ', ' || COALESCE(CAST(tmin AS VARCHAR), 'None') || ' to ' || COALESCE(CAST(tmax AS VARCHAR), 'None')
    || ' degrees, ' || COALESCE({beaufort_name_case('mb')}, 'no wind reading') || '.' END AS text,
    '<h3>' || title || '</h3><table border=''1''><tr>{_HEAD}</tr>' || COALESCE(body, '') || '</table>' AS tbl
  FROM sa),
rec AS (
  SELECT request_id, string_agg(text, ' ' ORDER BY ord) AS report, string_agg(tbl, '' ORDER BY ord) AS tables,
    sum(n) AS total, min(n) AS least_n
  FROM st GROUP BY request_id)
SELECT req.request_id, req.location, req.station, req.date, req.next_date, req.heading,
  CASE WHEN req.station IS NULL THEN 'unknown_location' WHEN rec.total = 0 THEN 'no_data'
       WHEN rec.least_n = 0 THEN 'partial' ELSE 'ok' END AS status,
  rec.report,
  '<html> <p><strong>Location:</strong> ' || req.location || '</p><p><strong>Date:</strong> ' || req.heading
    || '</p><p><strong>Report:</strong> ' || rec.report || '</p>' || rec.tables || '</html>' AS html_report,
  CAST(req.request_id AS VARCHAR) || '_{report.DEFAULT_BATCH_SUFFIX}' AS external_id
FROM req JOIN rec ON req.request_id = rec.request_id"""


@register(
    "report_sections", "J1 J2 J3",
    f"""{REPORT_CTES}
    SELECT request_id, section, CAST(count(hour) AS BIGINT) AS n_rows,
      min(temperature) AS min_temperature, max(temperature) AS max_temperature
    FROM rows GROUP BY request_id, section""",
)
def q_report_sections(spark, sf_dir):
    rec = _day_records(spark, sf_dir)
    secs = F.array(*[F.struct(F.lit(s).alias("section"), F.col(f"rows_{s}").alias("rows")) for s in report.SECTIONS])
    x = rec.select("request_id", F.explode(secs).alias("x"))
    return x.select(
        "request_id", "x.section",
        F.size("x.rows").cast("long").alias("n_rows"),
        F.array_min(F.col("x.rows").getField("temperature")).alias("min_temperature"),
        F.array_max(F.col("x.rows").getField("temperature")).alias("max_temperature"),
    )


@register(
    "report_rows", "A13 J1 J2",
    f"""{REPORT_CTES}
    SELECT request_id, section, CAST(row_number() OVER (PARTITION BY request_id, section ORDER BY hour) - 1 AS INTEGER) AS pos,
      hour, {', '.join(SECTION_COLUMNS)}
    FROM rows WHERE hour IS NOT NULL""",
)
def q_report_rows(spark, sf_dir):
    rec = _day_records(spark, sf_dir)
    # one explode over the five sections (a single pass over the records)
    secs = F.array(*[F.struct(F.lit(s).alias("section"), F.col(f"sec_{s}").alias("arr")) for s in report.SECTIONS])
    x = rec.select("request_id", F.explode(secs).alias("x"))
    out = x.select("request_id", "x.section", F.posexplode("x.arr").alias("pos", "e"))
    return out.select("request_id", "section", "pos", "e.hour", *[F.col(f"e.r.{c}").alias(c) for c in SECTION_COLUMNS])


@register("report_dataset", "G3 G4 G6 G7 F14 F19", REPORT_RECORD_CTES)
def q_report_dataset(spark, sf_dir):
    rec = _records(spark, sf_dir)
    return rec.select(
        "request_id", "location", "station", "date", "next_date", "heading", "status", "report",
        "html_report", "external_id",
    )


@register(
    "report_uri", "F13",
    """SELECT page_id, 'data:text/html;charset=utf-8,' || replace(url_encode(html), '%2F', '/') AS uri FROM pages""",
)
def q_report_uri(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    return pages.select("page_id", report.data_uri(F.col("html")).alias("uri"))


_TEXTS = ("Time_Category", "winddirection")
_JSON_ROW = "'{' || " + " || ',' || ".join(
    f"'\"{c}\":' || COALESCE({repr(chr(34))} || {c} || {repr(chr(34))}, 'null')" if c in _TEXTS else f"'\"{c}\":' || COALESCE(CAST({c} AS VARCHAR), 'null')"
    for c in SECTION_COLUMNS) + " || '}'"
_GUIDANCE = report.DEFAULT_GUIDANCE.replace("'", "''")
_PROMPT_CTES = f"""{REPORT_RECORD_CTES.rsplit("SELECT req.request_id, req.location", 1)[0].rstrip()},
js AS (SELECT request_id, section, ord, any_value(title) AS title,
    '[' || COALESCE(string_agg(CASE WHEN hour IS NOT NULL THEN {_JSON_ROW} END, ',' ORDER BY hour), '') || ']' AS js
  FROM rows GROUP BY request_id, section, ord),
pr AS (SELECT js.request_id, string_agg(js.title || ':' || chr(10) || 'location - ' || req.location || ', date - ' ||
      strftime(CASE WHEN section = 'tomorrow' THEN req.next_date ELSE req.date END, '%B %d, %Y') || ', time - ' ||
      CASE WHEN section = 'tomorrow' THEN 'full day' ELSE js.title END || chr(10) || '{_GUIDANCE}' || chr(10) || js.js, chr(10) || chr(10) ORDER BY ord) AS prompt
  FROM js JOIN req ON req.request_id = js.request_id GROUP BY js.request_id)"""


@register(
    "report_prompts", "G2 G5",
    f"""{_PROMPT_CTES}
    SELECT pr.request_id, CAST(length(pr.prompt) AS INTEGER) AS prompt_chars, md5(pr.prompt) AS prompt_md5,
      '## Question' || chr(10) || '> ' || req.heading || chr(10) || chr(10) || '## Answer' || chr(10) || rec.report || chr(10) || chr(10) || '## Query' || chr(10) ||
      '```' || chr(10) || 'lookup by (station, date, part of day)' || chr(10) || '```' || chr(10) || chr(10) || '## Data' || chr(10) || js.js || chr(10) AS markdown
    FROM pr JOIN req ON req.request_id = pr.request_id JOIN rec ON rec.request_id = pr.request_id JOIN js ON js.request_id = pr.request_id AND js.section = 'morning'""",
)
def q_report_prompts(spark, sf_dir):
    """Section prompts and the combined prompt per request (the input a text
    generator would get; shown by length and digest), with question / answer / data as Markdown."""
    rec = _day_records(spark, sf_dir)
    rec = report.build_prompts(rec.withColumn("report", F.concat_ws(" ", *[F.col(f"text_{s}") for s in report.SECTIONS])))
    md = report.to_markdown(F.col("heading"), F.col("report"), F.lit("lookup by (station, date, part of day)"),
                            F.col("json_morning"))
    return rec.select("request_id", F.length("prompt").alias("prompt_chars"), F.md5("prompt").alias("prompt_md5"), md.alias("markdown"))
