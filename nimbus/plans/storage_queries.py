"""Registered queries that write and read back: sources, sinks, stored tables and indexes.

Each one writes data derived from the driver tables into the session's shared scratch
folder and reads it through the reader under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions.sql import register_sql_functions
from nimbus.operators import answers, retrieval, vector_index, weather
from nimbus.operators.clean import SECTION_COLUMNS, clean_observations
from nimbus.plans.answer_queries import SEASONS, titles
from nimbus.plans.registry import register
from nimbus.plans.sqltext import WITH_OBS, beaufort_case, beaufort_name_case, direction_case, normal_case, part_case, season_case
from nimbus.plans.text_queries import _sql_html_to_text
from nimbus.plans.weather_queries import observations
from nimbus.session import scratch_path
from nimbus.sinks import chunk_index, files, html_pages
from nimbus.sources import reports
from nimbus.sources.stations import RAW_COLUMNS, observations_from_events, read_stations
from nimbus.sources.tables import load, register_views

# --- sources ---------------------------------------------------------------------------


def station_files(spark: SparkSession, sf_dir: str) -> str:
    """Raw observations as CSV files with padded headers, stations dealt into three column orders."""
    raw = observations_from_events(load(spark, sf_dir, "events"))
    path = scratch_path(spark, "stations")
    orders = [RAW_COLUMNS, RAW_COLUMNS[::-1], sorted(RAW_COLUMNS)]
    for k, names in enumerate(orders):
        padded = [F.col(c).alias(f"  {c}" if c != names[-1] else c) for c in names]
        raw.where(F.col("STN") % 3 == k).select(*padded).write.option("header", True).csv(f"{path}/order-{k}")
    return path


@register("stations_roundtrip", "S1 U3 P1 P2 P4", f"{WITH_OBS} SELECT * FROM obs")
def q_stations_roundtrip(spark, sf_dir):
    return clean_observations(read_stations(spark, f"{station_files(spark, sf_dir)}/*"))


_PUBLISHED = "CAST(TIMESTAMP '2022-11-01 07:30:00' + INTERVAL 1 HOUR * (page_id * 37 % 12000) AS TIMESTAMP)"


@register(
    "archive_roundtrip", "S2 P3 P8 F5 F8 F12",
    f"""SELECT strftime(t, '%Y-%m-%d') AS date, strftime(t, '%H:%M:%S') AS time, {_sql_html_to_text('html')} AS weather_report,
      {season_case('month(t)')} AS season FROM (SELECT html, {_PUBLISHED} AS t FROM pages) p WHERE year(t) = 2023""",
)
def q_archive_roundtrip(spark, sf_dir):
    """Pages as a report archive (';' separated, HTML over several lines) over 500 days, read back for one year."""
    path = scratch_path(spark, "archive")
    hours = F.make_interval(hours=F.expr("CAST(page_id * 37 % 12000 AS INT)"))
    published = F.date_format(F.lit("2022-11-01 07:30:00").cast("timestamp_ntz") + hours, "yyyy-MM-dd HH:mm:ss")
    rows = load(spark, sf_dir, "pages").select(published.alias("publishDate"), F.col("html").alias("content"))
    rows.write.option("header", True).option("sep", ";").option("quoteAll", True).option("escape", '"').option("lineSep", "\n").csv(path)
    return reports.archive_parts(reports.read_reports(spark, path), year=2023)


@register(
    "articles_roundtrip", "S5 J4",
    f"""SELECT d.doc_id, t.title, d.text FROM documents d JOIN (
      SELECT doc_id, min(list_element(['{"', '".join(SEASONS)}'], CAST(quality * 2 + toxic AS INTEGER) + 1)) AS title FROM labels GROUP BY doc_id) t ON t.doc_id = d.doc_id""",
)
def q_articles_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "articles")
    answers.titled(load(spark, sf_dir, "documents").select("doc_id", "text"), titles(spark, sf_dir)).write.parquet(path)
    return reports.read_articles(spark, path)


# --- sinks -----------------------------------------------------------------------------

_DAYS_SQL = f"""{WITH_OBS} SELECT station, date, hour, temperature, rain FROM obs"""


def _station_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.struct("hour", "temperature", "rain")
    return observations(spark, sf_dir).groupBy("station", "date").agg(F.sort_array(F.collect_list(hour)).alias("hours"))


def _hours(days: DataFrame) -> DataFrame:
    return days.select(F.col("station").cast("int"), F.col("date").cast("int"), F.inline("hours")).select(
        "station", "date", F.col("hour").cast("int"), F.col("temperature").cast("long"), F.col("rain").cast("int"))


@register("csv_roundtrip", "K1", _DAYS_SQL)
def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    days = _station_days(spark, sf_dir)
    files.write_csv(days, path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return _hours(back.withColumn("hours", F.from_json("hours", days.schema["hours"].dataType.simpleString())))


@register("log_roundtrip", "K3", _DAYS_SQL)
def q_log_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "log")
    days = _station_days(spark, sf_dir)
    files.write_log(days.where("date % 2 = 0"), path)
    files.write_log(days.where("date % 2 = 1"), path)
    return _hours(spark.read.schema(days.schema).json(path))


@register("pages_roundtrip", "K2", "SELECT CAST(page_id AS VARCHAR) AS external_id, md5(html) AS page FROM pages")
def q_pages_roundtrip(spark, sf_dir):
    """Every page as a file of its own, published in one commit and read back as files."""
    path = scratch_path(spark, "pages")
    rows = load(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("external_id"), "html")
    names = html_pages.write_pages(rows, path, html="html")
    files_ = spark.read.text(f"{path}/part-*/*.HTML", wholetext=True).select(F.col("_metadata.file_path").alias("filename"), F.md5("value").alias("page"))
    return names.join(files_, "filename").select("external_id", "page")


_CHUNKS = """c AS (SELECT lang AS namespace, doc_id, CAST(n AS INTEGER) AS chunk_no, substr(text, 1 + 400 * n, 400) AS text
  FROM (SELECT lang, doc_id, text, unnest(range(0, 3)) AS n FROM documents WHERE lang IS NOT NULL) d)"""


@register(
    "chunk_index_roundtrip", "K4",
    f"""WITH {_CHUNKS} SELECT namespace, doc_id, chunk_no, CASE WHEN doc_id % 2 = 0 THEN 'again: ' || text ELSE text END AS text,
      CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END AS revision FROM c""",
)
def q_chunk_index_roundtrip(spark, sf_dir):
    """All chunks, then those of even documents again (marked), then the first batch once more, which changes nothing."""
    path = scratch_path(spark, "chunk-index")
    docs = load(spark, sf_dir, "documents").where("lang IS NOT NULL").withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.lit(2))))
    first = docs.select(F.col("lang").alias("namespace"), "doc_id", "chunk_no", F.substring("text", F.col("chunk_no") * 400 + 1, F.lit(400)).alias("text"), F.lit(1).alias("revision"))
    chunk_index.upsert(first, path, "first")
    again = first.where("doc_id % 2 = 0").withColumn("text", F.concat(F.lit("again: "), F.col("text"))).withColumn("revision", F.lit(2))
    chunk_index.upsert(again.unionByName(first.where("doc_id % 2 = 0")), path, "second", newest="revision")
    chunk_index.upsert(first, path, "first")
    return chunk_index.read(spark, path).select("namespace", "doc_id", "chunk_no", "text", "revision")


# --- lookups on the stored table ---------------------------------------------------------

STATION, DAY, MONTH = 260, 20240105, 202401


def stored_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observation table as a deployment keeps it: a folder per station, months sorted by date."""
    path = scratch_path(spark, "observations")
    files.write_observations(observations(spark, sf_dir), path)
    return spark.read.parquet(path)


_SEC = ", ".join(SECTION_COLUMNS)


@register("lookup_day", "P9", f"{WITH_OBS} SELECT station, date, hour, {_SEC} FROM obs WHERE date = {DAY}")
def q_lookup_day(spark, sf_dir):
    return weather.on_date(stored_observations(spark, sf_dir), DAY).select("station", "date", "hour", *SECTION_COLUMNS)


@register("lookup_period", "P11 P16", f"{WITH_OBS} SELECT {_SEC} FROM obs WHERE station = {STATION} AND date = {DAY} AND Time_Category = 'Evening'")
def q_lookup_period(spark, sf_dir):
    return weather.period_rows(stored_observations(spark, sf_dir), STATION, DAY, "Evening")


@register("lookup_month", "P12", f"{WITH_OBS} SELECT station, date, hour, temperature FROM obs WHERE CAST(date AS VARCHAR) LIKE '{MONTH}%'")
def q_lookup_month(spark, sf_dir):
    return stored_observations(spark, sf_dir).where(weather.in_month(MONTH)).select("station", "date", "hour", "temperature")


@register(
    "lookup_hottest", "R2 A12 P12",
    f"""{WITH_OBS} SELECT date, hour, temperature FROM obs WHERE station = {STATION} AND date BETWEEN {MONTH}01 AND {MONTH}31
      ORDER BY temperature DESC NULLS LAST, date, hour LIMIT 1""",
)
def q_lookup_hottest(spark, sf_dir):
    return weather.hottest_in_month(stored_observations(spark, sf_dir), STATION, MONTH)


@register(
    "lookup_union", "U1 P9 P10 R1",
    f"""{WITH_OBS} SELECT {_SEC} FROM obs WHERE station = {STATION} AND date = {DAY} AND (hour BETWEEN 5 AND 17 OR hour BETWEEN 18 AND 23 OR hour BETWEEN 0 AND 4)
      UNION SELECT {_SEC} FROM obs WHERE station = {STATION} AND date = {DAY + 1}""",
)
def q_lookup_union(spark, sf_dir):
    return weather.today_tomorrow_union(stored_observations(spark, sf_dir), STATION, DAY)


@register(
    "station_views", "S4",
    f"""{WITH_OBS} SELECT 'De_Bilt' AS place, date, count(*) AS n, max(temperature) AS top FROM obs WHERE station = 260 GROUP BY date
      UNION ALL SELECT 'Eindhoven', date, count(*), max(temperature) FROM obs WHERE station = 370 GROUP BY date""",
)
def q_station_views(spark, sf_dir):
    register_views(stored_observations(spark, sf_dir))
    one = "SELECT '{0}' AS place, date, count(*) AS n, max(temperature) AS top FROM {0} GROUP BY date"
    return spark.sql(f"{one.format('De_Bilt')} UNION ALL {one.format('Eindhoven')}")


@register(
    "sql_functions", "F1 F2 F3 F4 F5 F6 F11",
    f"""{WITH_OBS} SELECT station, date, hour, {beaufort_case('wind_gust')} AS force, {beaufort_name_case('beaufort')} AS name,
      {direction_case('(precipitation * 10)')} AS heading, {part_case('hour')} AS part, {season_case('month(obs_date)')} AS season,
      {normal_case('month(obs_date)')} AS normal, CASE WHEN cloudcover BETWEEN 1 AND 5 THEN cloudcover END AS stars FROM obs""",
)
def q_sql_functions(spark, sf_dir):
    register_sql_functions(spark)
    observations(spark, sf_dir).createOrReplaceTempView("seen")
    return spark.sql("""SELECT station, date, hour, beaufort(wind_gust) AS force, beaufort_name(beaufort) AS name, wind_direction(precipitation * 10) AS heading,
      part_of_day(hour) AS part, season(month(obs_date)) AS season, normal_temperature(month(obs_date)) AS normal,
      rating(concat('clouds ', cloudcover, '!')) AS stars FROM seen""")


# --- vectors ---------------------------------------------------------------------------

LISTS, NEAREST = 16, 10
_ALL_PAIRS = f"""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
  SELECT a.vec_id AS qid, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY round_even(list_cosine_similarity(a.e, b.e), 9) DESC, b.vec_id) AS INTEGER) AS rank,
    b.vec_id AS item_id, round_even(list_cosine_similarity(a.e, b.e), 9) AS similarity
  FROM v a CROSS JOIN v b QUALIFY rank <= {NEAREST}"""


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    emb = load(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("q_embedding")), emb.select(F.col("vec_id").alias("item_id"), "embedding")


@register("top_k_all", "V3 J5 R3", _ALL_PAIRS)
def q_top_k_all(spark, sf_dir):
    """Every embedding as a query, block against block."""
    queries, items = _vectors(spark, sf_dir)
    return retrieval.top_k(queries, items, NEAREST)


@register("vector_index_all_lists", "V3 J5 R3", _ALL_PAIRS)
def q_vector_index_all_lists(spark, sf_dir):
    """The inverted-file index with every list probed is the exact search."""
    queries, items = _vectors(spark, sf_dir)
    path = scratch_path(spark, "vector-index")
    vector_index.build(items, path, LISTS)
    return vector_index.search(queries, path, NEAREST, LISTS)


@register("vector_index_recall", "V3", f"SELECT {NEAREST} AS k, count(*) AS queries, true AS reached FROM embeddings")
def q_vector_index_recall(spark, sf_dir):
    """Whether recall@10 over all embeddings as queries reaches 0.9 at the probes ``calibrate`` picks."""
    queries, items = _vectors(spark, sf_dir)
    path = scratch_path(spark, "vector-index")
    vector_index.build(items, path, LISTS)
    _, reached = vector_index.calibrate(queries, path, NEAREST)
    return queries.agg(F.lit(NEAREST).alias("k"), F.count(F.lit(1)).alias("queries"), F.lit(reached >= 0.9).alias("reached"))
