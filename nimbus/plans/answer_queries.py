"""Registered queries that answer free questions with rows or chunks.

Questions come from ``orders``: a day or a month of which two thirds lie in the observed
month, no, one or two places (in any letter case, some inside longer words that name no
place), or a season. Articles are ``documents`` whose title, a season, is in ``labels``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions import codes
from nimbus.operators import answers, retrieval, routing
from nimbus.operators.report import station_dim
from nimbus.plans.registry import register
from nimbus.plans.sqltext import WITH_OBS, date_to_int
from nimbus.plans.text_queries import digest_terms_sql
from nimbus.plans.weather_queries import observations
from nimbus.sources.tables import load

SEASONS = ["Spring", "Summer", "Autumn", "Winter"]
#: What questions call the titles.
TITLE_WORDS = {"spring": "Spring", "summer": "Summer", "fall": "Autumn", "autumn": "Autumn", "winter": "Winter"}
#: Asked about where a question names no place.
DEFAULT_PLACES = ["De Bilt"]
CHUNK, OVERLAP, TOP = 256, 20, 3
ASKED = [
    "Which readings did {0} have on {day}?", "on {day} was it wetter in {0} or in {1}?", "An Amsterdammer wants the report of {day}.",
    "How warm was {month}, {year} around {0}?", "What do people do in the {season}?", "Compare {0} with {0} on {day}, please.", "Where do birds go?",
]


def _shaped(col) -> tuple:
    """A place name in one of three spellings, by the order's key."""
    return F.when(F.col("k") % 3 == 0, F.upper(col)).when(F.col("k") % 3 == 1, F.lower(col)).otherwise(col)


def asked_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, question) of every order."""
    places = F.array(*[F.lit(p) for p in codes.STATIONS])
    seasons = F.array(*[F.lit(s) for s in ("Springs", "summer", "fall", "winters")])
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.to_date("o_orderdate").alias("od"))
    d = F.when(F.col("k") % 3 == 0, F.col("od")).otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c") % 35).cast("int")))
    place = lambda n: _shaped(F.element_at(places, (F.pmod(F.col("c") * n + F.col("k"), F.lit(5)) + 1).cast("int")))
    parts = {"{0}": place(1), "{1}": place(3), "{day}": F.date_format(d, "MMMM d, yyyy"), "{month}": F.date_format(d, "MMMM"),
             "{year}": F.year(d).cast("string"), "{season}": F.element_at(seasons, (F.pmod("c", F.lit(4)) + 1).cast("int"))}
    form = F.element_at(F.array(*[F.lit(a) for a in ASKED]), (F.pmod(F.col("k") + F.col("c"), F.lit(len(ASKED))) + 1).cast("int"))
    question = form
    for mark, value in parts.items():
        question = F.replace(question, F.lit(mark), value)
    return o.select(F.col("k").alias("qid"), question.alias("question"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title) of the labelled documents."""
    names = F.array(*[F.lit(s) for s in SEASONS])
    return load(spark, sf_dir, "labels").select("doc_id", F.element_at(names, (F.col("quality") * 2 + F.col("toxic") + 1).cast("int")).alias("title"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.titled_chunks(load(spark, sf_dir, "documents").select("doc_id", "text"), titles(spark, sf_dir), CHUNK, OVERLAP)


def _list(items) -> str:
    return "[" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + "]"


_PLACES = list(codes.STATIONS)


def _place_sql(n: int) -> str:
    """The n-th place's name as it is spelt, and its index."""
    name = f"list_element({_list(_PLACES)}, CAST((c * {n} + k) % 5 AS INTEGER) + 1)"
    return f"CASE k % 3 WHEN 0 THEN upper({name}) WHEN 1 THEN lower({name}) ELSE {name} END"


ASKED_SQL = f"""a0 AS (
  SELECT o_orderkey AS k, o_custkey AS c, (o_orderkey + o_custkey) % {len(ASKED)} AS form,
    CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) ELSE CAST(DATE '2024-01-01' + CAST(o_custkey % 35 AS INTEGER) AS DATE) END AS d
  FROM orders),
a1 AS (
  SELECT k AS qid, c, form, d, k,
    replace(replace(replace(replace(replace(replace(list_element({_list(ASKED)}, CAST(form AS INTEGER) + 1),
      '{{0}}', {_place_sql(1)}), '{{1}}', {_place_sql(3)}), '{{day}}', strftime(d, '%B') || ' ' || CAST(day(d) AS VARCHAR) || ', ' || CAST(year(d) AS VARCHAR)),
      '{{month}}', strftime(d, '%B')), '{{year}}', CAST(year(d) AS VARCHAR)), '{{season}}', list_element(['Springs', 'summer', 'fall', 'winters'], CAST(c % 4 AS INTEGER) + 1)) AS question
  FROM a0),
dim(place, station) AS (VALUES {", ".join(f"('{p}', {s})" for p, s in codes.STATIONS.items())}),
asked_place AS (
  SELECT qid, list_element({_list(_PLACES)}, CAST((c + k) % 5 AS INTEGER) + 1) AS place FROM a1 WHERE form IN (0, 1, 3, 5)
  UNION SELECT qid, list_element({_list(_PLACES)}, CAST((c * 3 + k) % 5 AS INTEGER) + 1) FROM a1 WHERE form = 1
  UNION SELECT qid, '{DEFAULT_PLACES[0]}' FROM a1 WHERE form = 2),
asked_day AS (
  SELECT qid, d AS day FROM a1 WHERE form IN (0, 1, 2, 5)
  UNION ALL SELECT qid, unnest(generate_series(CAST(date_trunc('month', d) AS TIMESTAMP), CAST(last_day(d) AS TIMESTAMP), INTERVAL 1 DAY)) FROM a1 WHERE form = 3),
keys AS (
  SELECT p.qid, p.place, dim.station, {date_to_int('CAST(t.day AS DATE)')} AS date
  FROM asked_place p JOIN dim ON dim.place = p.place JOIN asked_day t ON t.qid = p.qid),
hits AS (SELECT keys.qid, keys.place, o.* FROM keys JOIN obs o ON o.station = keys.station AND o.date = keys.date),
routes AS (
  SELECT qid, form, question, CASE WHEN form IN (4, 6) THEN 'articles' WHEN qid IN (SELECT qid FROM hits) THEN 'observations' ELSE 'both' END AS route FROM a1)"""
_READ = ", ".join(answers.READINGS)


@register("asked_places", "P16 F20 V6", f"""{WITH_OBS}, {ASKED_SQL} SELECT qid, place, CAST(station AS INTEGER) AS station, date FROM keys""")
def q_asked_places(spark, sf_dir):
    routed = answers.dated(asked_questions(spark, sf_dir))
    return answers.place_dates(routed, station_dim(spark).withColumnRenamed("location", "place"), default=DEFAULT_PLACES)


def _gazetteer(spark: SparkSession) -> DataFrame:
    return station_dim(spark).withColumnRenamed("location", "place")


@register("answer_rows", "V7 V6 F20 P16 J3 P9 P12", f"""{WITH_OBS}, {ASKED_SQL}
    SELECT qid, place, station, date, hour, {_READ} FROM hits""")
def q_answer_rows(spark, sf_dir):
    routed = answers.dated(asked_questions(spark, sf_dir))
    return answers.answer_rows(routed, observations(spark, sf_dir), _gazetteer(spark), default=DEFAULT_PLACES)


TITLED_SQL = f"""tt AS (SELECT doc_id, min(list_element({_list(SEASONS)}, CAST(quality * 2 + toxic AS INTEGER) + 1)) AS title FROM labels GROUP BY doc_id),
td AS (SELECT doc_id, title, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS toks FROM documents JOIN tt USING (doc_id)),
ts AS (SELECT doc_id, title, toks, unnest(range(0, greatest(len(toks) - {OVERLAP} - 1, 0) + 1, {CHUNK - OVERLAP})) AS st FROM td WHERE len(toks) > 0),
tc AS (SELECT doc_id, title, CAST(st // {CHUNK - OVERLAP} AS INTEGER) AS chunk_no, CAST(len(list_slice(toks, st + 1, st + {CHUNK})) AS INTEGER) AS n_tokens,
  array_to_string(list_slice(toks, st + 1, st + {CHUNK}), ' ') AS chunk FROM ts)"""


@register("titled_chunks", "J4 V1", f"WITH {TITLED_SQL} SELECT doc_id, title, chunk_no, n_tokens, chunk FROM tc")
def q_titled_chunks(spark, sf_dir):
    return articles(spark, sf_dir)


_SEASON_OF = "CASE c % 4 WHEN 0 THEN 'Spring' WHEN 1 THEN 'Summer' WHEN 2 THEN 'Autumn' ELSE 'Winter' END"
CHUNKS_SQL = f"""{TITLED_SQL},
asked AS (SELECT DISTINCT r.question, CASE WHEN r.form = 4 THEN {_SEASON_OF.replace('c %', 'a1.c %')} END AS wanted FROM routes r JOIN a1 ON a1.qid = r.qid WHERE r.route <> 'observations'),
qv AS ({digest_terms_sql('asked', 'question', 'question')}),
tk AS (SELECT *, doc_id * 1000000 + chunk_no AS item FROM tc),
cv AS ({digest_terms_sql('tk', 'item', 'chunk')}),
sims AS (SELECT qv.question, cv.item, round_even(sum(qv.v * cv.v), 9) AS similarity FROM qv JOIN cv ON cv.bucket = qv.bucket GROUP BY 1, 2),
every AS (SELECT asked.question, tk.item, tk.title, coalesce(sims.similarity, 0) AS similarity FROM asked JOIN tk ON asked.wanted IS NULL OR asked.wanted = tk.title
  LEFT JOIN sims ON sims.question = asked.question AND sims.item = tk.item),
top AS (SELECT question, item, similarity, row_number() OVER (PARTITION BY question ORDER BY similarity DESC, item) AS rank FROM every QUALIFY rank <= {TOP}),
chosen AS (SELECT r.qid, r.route, CAST(top.rank AS INTEGER) AS rank, tk.title, tk.doc_id, tk.chunk_no, top.similarity, tk.chunk
  FROM routes r JOIN top ON top.question = r.question JOIN tk ON tk.item = top.item WHERE r.route <> 'observations')"""


@register("answer_chunks", "V7 V6 V4 V3 V2 J4 J5 R3",
          f"{WITH_OBS}, {ASKED_SQL}, {CHUNKS_SQL} SELECT qid, rank, title, doc_id, chunk_no, similarity, chunk FROM chosen")
def q_answer_chunks(spark, sf_dir):
    routed = answers.dated(asked_questions(spark, sf_dir))
    final = answers.final_routes(routed, observations(spark, sf_dir), _gazetteer(spark), default=DEFAULT_PLACES)
    return answers.answer_chunks(final.where(F.col("route") != routing.ROUTE_OBSERVATIONS), articles(spark, sf_dir), TOP, TITLE_WORDS)


@register("answers", "V7 V6 V4 V3 J4 J5 F20 P16",
          f"""{WITH_OBS}, {ASKED_SQL}, {CHUNKS_SQL}
    SELECT qid, 'observations' AS route, 'row' AS kind, place AS title, date, hour, CAST(NULL AS INTEGER) AS rank, CAST(NULL AS DOUBLE) AS similarity, temperature AS temperature FROM hits
    UNION ALL SELECT qid, route, 'chunk', title, NULL, NULL, rank, similarity, NULL FROM chosen""")
def q_answers(spark, sf_dir):
    """The text column (readings as JSON, or the chunk) is shown by its temperature; ``answer_rows`` and ``answer_chunks`` show it whole."""
    temperature = lambda t: F.get_json_object(t, "$.temperature").cast("long")
    found = answers.answers(asked_questions(spark, sf_dir), observations(spark, sf_dir), _gazetteer(spark), articles(spark, sf_dir), TOP, TITLE_WORDS, DEFAULT_PLACES,
                            read={"temperature": temperature})
    return found.drop("text")


@register("embed_digest", "V2", f"SELECT doc_id, CAST(bucket AS INTEGER) AS pos, round_even(v, 9) AS value FROM ({digest_terms_sql('documents', 'doc_id', 'text')})")
def q_embed_digest(spark, sf_dir):
    docs = retrieval.embed_digest(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.posexplode("embedding").alias("pos", "value")).where("value <> 0").withColumn("value", F.bround("value", 9))
