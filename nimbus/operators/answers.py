"""Answers to free questions (V7): observation rows or titled article chunks.

A question's day or month comes from ``routing``, its places and titles from one
pattern over all known names, matched in the JVM. Then the questions fan out:

* dated ones to the rows of their day or month at the places they name, by one equi
  join on (station, date). The observations of the named stations are counted first: up to
  ``MAX_SENT`` rows go to every task and the questions, whose days are few keys, are not
  shuffled; more are joined by a shuffle, where AQE splits the question side;
* undated ones, and dated ones whose lookup finds nothing, to the ``k`` chunks closest
  to them, among the chunks of the titles they name if they name any. Questions of the
  same words are embedded and searched once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbus.functions import codes, text
from nimbus.operators import retrieval, routing
from nimbus.session import materialised

#: Names one pattern holds at most; the gazetteer is read to the driver within this bound.
MAX_NAMES = 10_000
#: Observations (of the gazetteer's stations) that are sent to all tasks; more are joined by a shuffle.
MAX_SENT = 200_000
READINGS = ("temperature", "winddirection", "beaufort", "wind_gust", "sunshine", "precipitation", "cloudcover", "fog", "rain", "snow", "thunderstorm")


def _bounded(df: DataFrame, bound: int) -> list:
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} names")
    return rows


def titled(documents: DataFrame, titles: DataFrame, on: str = "doc_id", title: str = "title") -> DataFrame:
    """Documents with their titles, paired by key; a document without a title, or a
    title without a document, is left out. Of several titles of one key the smallest stays."""
    return documents.join(titles.where(F.col(title).isNotNull()).groupBy(on).agg(F.min(title).alias(title)), on)


def titled_chunks(documents: DataFrame, titles: DataFrame, size: int = retrieval.DEFAULT_CHUNK_TOKENS,
                  overlap: int = retrieval.DEFAULT_OVERLAP) -> DataFrame:
    """J4 + V1: (doc_id, title, chunk_no, n_tokens, chunk) of every titled document."""
    return retrieval.chunk_text(titled(documents, titles), size=size, overlap=overlap, keep=("doc_id", "title"))


def dated(questions: DataFrame, qid: str = "qid", question: str = "question") -> DataFrame:
    """F20 + V6: (qid, question, q_date, month_start, month_end, route), written once: the parsing
    of a question is long, and what follows reads it several times. The questions are dealt out
    first, as they may come in few files, and each is long to parse and may ask for many rows."""
    spark = questions.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    return materialised(routing.route(questions.select(qid, question).repartition(tasks), question), "dated-questions")


def _sent(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, and sent to every task of a join if it has at most ``MAX_SENT`` rows: what
    it is joined with, far more rows of few keys, then stays where it is."""
    held = materialised(df, name)
    return F.broadcast(held) if held.count() <= MAX_SENT else held


def _asked_places(routed: DataFrame, gazetteer: DataFrame, qid: str, question: str, default: Sequence[str]) -> DataFrame:
    """Per dated question and named place: (qid, place, station) and the question's day or month."""
    known = _bounded(gazetteer.select("place", "station"), MAX_NAMES)
    names = [r["place"] for r in known]
    every = F.array(*[F.lit(" ".join(n.lower().split())) for n in (default or names)])
    when = ("q_date", "month_start", "month_end")
    asked = routed.where(F.col("route") == routing.ROUTE_OBSERVATIONS).select(qid, text.names_in(question, names).alias("_named"), *when)
    named = asked.select(qid, F.explode(F.when(F.size("_named") > 0, F.col("_named")).otherwise(every)).alias("_name"), *when)
    return named.join(F.broadcast(gazetteer.select(text.name_key("place").alias("_name"), "place", "station")), "_name").select(qid, "place", "station", *when)


def _day_by_day(places: DataFrame, qid: str) -> DataFrame:
    """(qid, place, station, date) of ``_asked_places``; a month gives all its days."""
    days = F.when(F.col("q_date").isNotNull(), F.array("q_date")).otherwise(F.sequence("month_start", "month_end"))
    return places.select(qid, "place", "station", F.explode(days).alias("_day")).select(qid, "place", "station", codes.date_to_int("_day").alias("date"))


def place_dates(routed: DataFrame, gazetteer: DataFrame, qid: str = "qid", question: str = "question",
                default: Sequence[str] = ()) -> DataFrame:
    """Per dated question (of ``dated``), named place and day: (qid, place, station, date).

    ``gazetteer`` is (place, station). A month gives all its days. A question that names no
    place asks for the places ``default`` (all of the gazetteer, if none are given).
    """
    return _day_by_day(_asked_places(routed, gazetteer, qid, question, default), qid)


def _at_places(obs: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """The observations of the gazetteer's stations."""
    return obs.join(F.broadcast(gazetteer.select("station").distinct()), "station", "left_semi").select("station", "date", "hour", *READINGS)


def answer_rows(routed: DataFrame, obs: DataFrame, gazetteer: DataFrame, qid: str = "qid", question: str = "question",
                default: Sequence[str] = ()) -> DataFrame:
    """V7, lookup branch: every observation of the day or month at the places a question
    names, as (qid, place, station, date, hour, readings). The gazetteer's stations prune
    the observations before the join."""
    keys = place_dates(routed, gazetteer, qid, question, default)
    return keys.join(_sent(_at_places(obs, gazetteer), "seen"), ["station", "date"]).select(qid, "place", "station", "date", "hour", *READINGS)


def _answered(keys: DataFrame, seen: DataFrame, qid: str) -> DataFrame:
    """The (qid) that have an observation at one of their places and days."""
    held = seen.select("station", "date").distinct()
    return keys.join(_sent(held, "station-days"), ["station", "date"], "left_semi").select(qid).distinct()


def final_routes(routed: DataFrame, obs: DataFrame, gazetteer: DataFrame, qid: str = "qid", question: str = "question",
                 default: Sequence[str] = ()) -> DataFrame:
    """``routed`` with route ``both`` where a dated question's lookup is empty at all its places."""
    keys = place_dates(routed, gazetteer, qid, question, default)
    answered = _answered(keys, _at_places(obs, gazetteer), qid).withColumn("_rows", F.lit(True))
    empty = (F.col("route") == routing.ROUTE_OBSERVATIONS) & F.col("_rows").isNull()
    return routed.join(answered, qid, "left").withColumn("route", F.when(empty, routing.ROUTE_BOTH).otherwise(F.col("route"))).drop("_rows")


def answer_chunks(questions: DataFrame, chunks: DataFrame, k: int = 3, titles: dict[str, str] | None = None,
                  embed: Callable[[DataFrame, str, str], DataFrame] | None = None, qid: str = "qid",
                  question: str = "question", keep: Sequence[str] = ()) -> DataFrame:
    """V7, article branch: the ``k`` chunks closest to each question, as (qid, rank, title,
    doc_id, chunk_no, similarity, chunk) and the questions' columns ``keep``.

    ``chunks`` is (doc_id, title, chunk_no, chunk) or carries an ``embedding`` already;
    ``embed(df, text column, out column)`` adds one (hashed terms by default). ``titles`` maps
    the words a question may use to titles: a question that names titles searches only their
    chunks (best ``k`` over all of them), any other searches all chunks.
    """
    embed = embed or (lambda df, column, out: retrieval.embed_digest(df, column, out=out))
    texts = questions.select(F.col(question).alias("_q")).where("_q IS NOT NULL").distinct().withColumn("_qid", F.xxhash64("_q"))
    # embedded once; both searches and the join that shows the chunks read it
    index = chunks if "embedding" in chunks.columns else materialised(embed(chunks, "chunk", "embedding"), "embedded-chunks")
    # ties go to the smaller document, then the earlier chunk
    digits = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    index = index.withColumn("_key", F.concat_ws(":", digits("doc_id", 20), digits("chunk_no", 10)))
    titles = titles or {}
    names = F.array(*[F.lit(t) for t in titles.values()]) if titles else F.array().cast("array<string>")
    words = F.array(*[F.lit(" ".join(w.lower().split())) for w in titles]) if titles else names
    named = F.array_distinct(F.transform(text.names_in("_q", list(titles), plural=True), lambda w: F.element_at(names, F.array_position(words, w).cast("int"))))
    # the distinct texts are found, embedded and matched with titles once
    asked = materialised(embed(texts, "_q", "_qv").withColumn("_titles", named), "asked-texts")
    items = index.select("_key", F.col("title").alias("_title"), "embedding")
    free = retrieval.top_k(asked.where(F.size("_titles") == 0), items, k, qid="_qid", iid="_key", qvec="_qv")
    bound = retrieval.top_k(asked.where(F.size("_titles") > 0).withColumn("_title", F.explode("_titles")), items, k, qid="_qid", iid="_key", qvec="_qv", on="_title")
    best = free.unionByName(bound)
    shown = index.select("_key", "doc_id", "chunk_no", "title", "chunk")
    found = best.join(shown, "_key").join(asked.select("_qid", "_q"), "_qid")
    asks = questions.select(qid, F.col(question).alias("_q"), *keep)
    return asks.join(found, "_q").select(qid, *keep, "rank", "title", "doc_id", "chunk_no", "similarity", "chunk")


def _open(routed: DataFrame, answered: DataFrame, qid: str, question: str) -> DataFrame:
    """(qid, question, route) of the questions that chunks answer: undated ones, and dated ones
    whose key has no rows. A key that comes several times has each of its questions with each of its routes."""
    columns = [qid, question, "route"]
    dated_ = routed.where(F.col("route") == routing.ROUTE_OBSERVATIONS).select(*columns)
    empty = dated_.join(answered, qid, "left_anti").withColumn("route", F.lit(routing.ROUTE_BOTH))
    left = routed.where(F.col("route") != routing.ROUTE_OBSERVATIONS).select(*columns).unionByName(empty).where(F.col(qid).isNotNull())
    same = Window.partitionBy(qid)
    routes = (routing.ROUTE_ARTICLES, routing.ROUTE_BOTH)
    counts = [F.count(F.when(F.col("route") == r, 1)).over(same).cast("int") for r in routes]
    each = left.select(qid, question, *[n.alias(f"_n{i}") for i, n in enumerate(counts)])
    every = F.concat(*[F.array_repeat(F.lit(r), F.col(f"_n{i}")) for i, r in enumerate(routes)])
    return each.select(qid, question, F.explode(every).alias("route"))


def answers(questions: DataFrame, obs: DataFrame, gazetteer: DataFrame, chunks: DataFrame, k: int = 3,
            titles: dict[str, str] | None = None, default: Sequence[str] = (), qid: str = "qid", question: str = "question",
            embed: Callable[[DataFrame, str, str], DataFrame] | None = None,
            read: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """V7 in one frame: per question its rows or its chunks (or both) as (qid, route, kind, title,
    date, hour, rank, similarity, text). ``kind`` is row or chunk; a row's title is its place and
    its text the readings as JSON. ``read`` adds columns made from a row's text (null for chunks).

    Questions are parsed, looked up for places and routed once each; an observation's text is
    written, and read again, once per observation and not once per question that it answers."""
    read = read or {}
    routed = dated(questions, qid, question)
    places = materialised(_asked_places(routed, gazetteer, qid, question, default), "asked-places")
    shown = F.to_json(F.struct(*READINGS), {"ignoreNullFields": "false"})
    seen = materialised(_at_places(obs, gazetteer).select("station", "date", "hour", shown.alias("text")), "seen")
    open_ = materialised(_open(routed, _answered(_day_by_day(places, qid), seen, qid), qid, question), "open-questions")
    told = seen.select("*", *[f(F.col("text")).alias(c) for c, f in read.items()])
    rows = _day_by_day(places, qid).join(_sent(told, "told"), ["station", "date"]).select(
        qid, F.lit(routing.ROUTE_OBSERVATIONS).alias("route"), F.lit("row").alias("kind"), F.col("place").alias("title"), "date", "hour",
        F.lit(None).cast("int").alias("rank"), F.lit(None).cast("double").alias("similarity"), "text", *read)
    found = answer_chunks(open_, chunks, k, titles, embed, qid, question, keep=["route"])
    return rows.unionByName(found.select(qid, "route", F.lit("chunk").alias("kind"), "title", F.lit(None).cast("int").alias("date"),
                                         F.lit(None).cast("int").alias("hour"), "rank", "similarity", F.col("chunk").alias("text"),
                                         *[F.lit(None).cast(told.schema[c].dataType).alias(c) for c in read]))
