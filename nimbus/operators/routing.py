"""Question routing and answer context (rule-based; no model selector).

A question naming a day or a month goes to the observation lookup; one naming
neither goes to the article index; a question with a date whose lookup finds
nothing goes to both (the lookup is empty, so the articles answer it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.functions import codes
from nimbus.functions import text
from nimbus.operators import retrieval

ROUTE_OBSERVATIONS = "observations"
ROUTE_ARTICLES = "articles"
ROUTE_BOTH = "both"


def with_question_dates(df: DataFrame, question: str = "question") -> DataFrame:
    """add ``q_date`` (a day) and ``month_start`` / ``month_end`` (month only).

    Staged in projections: the regex matches first, the date parsing on the
    short matched texts after, so every pattern runs once per question and the
    generated code stays small enough to be compiled."""
    staged = df.withColumns(text.date_matches(F.col(question)))
    first = F.when(F.col("q_date").isNull(), text.month_from_matches())
    return staged.withColumn("q_date", text.date_from_matches()).withColumn("month_start", first).withColumn(
        "month_end", F.last_day("month_start")).drop(*text.MATCH_COLUMNS)


def route(df: DataFrame, question: str = "question") -> DataFrame:
    """V6: ``route`` = observations when a day or month is named, else articles."""
    dated = with_question_dates(df, question)
    has_date = F.col("q_date").isNotNull() | F.col("month_start").isNotNull()
    return dated.withColumn("route", F.when(has_date, ROUTE_OBSERVATIONS).otherwise(ROUTE_ARTICLES))


def _per_day_month(obs: DataFrame) -> tuple[DataFrame, DataFrame]:
    per_day = obs.groupBy(F.col("obs_date").alias("_day")).agg(F.count(F.lit(1)).alias("_n_day"))
    per_month = per_day.groupBy(F.trunc("_day", "month").alias("_month")).agg(F.sum("_n_day").alias("_n_month"))
    return per_day, per_month


def answer_context(routed: DataFrame, obs: DataFrame, qid: str = "qid") -> DataFrame:
    """V7 (relational part): per question its final route and how many
    observation rows back it; a dated question without rows is routed to both.

    Observations are first reduced to one count per day and per month (partial
    aggregates; their size is the number of distinct days, not the data size),
    and every question is left-joined to both by key. No filter sits on the
    parsed columns, so the date parsing is not copied into pushed-down
    predicates, and each question is parsed once."""
    per_day, per_month = _per_day_month(obs)
    j = routed.join(per_day, routed["q_date"] == per_day["_day"], "left").join(
        per_month, routed["month_start"] == per_month["_month"], "left"
    )
    n = F.when(F.col("route") != ROUTE_OBSERVATIONS, F.lit(0)).when(F.col("q_date").isNotNull(), F.coalesce("_n_day", F.lit(0))).otherwise(
        F.coalesce("_n_month", F.lit(0))
    ).cast("long")
    final = F.when((F.col("route") == ROUTE_OBSERVATIONS) & (n == 0), ROUTE_BOTH).otherwise(F.col("route"))
    return j.select(qid, final.alias("route"), n.alias("n_obs_rows"))


def article_context(questions: DataFrame, chunks: DataFrame, k: int = 3, qid: str = "qid",
                    question: str = "question", on: str | None = None) -> DataFrame:
    """V7 article branch: the ``k`` chunks closest to each question (hashed
    embeddings unless the chunks already carry an ``embedding``)."""
    q = retrieval.embed_hash(questions.select(qid, question, *([on] if on else [])), question, out="q_embedding")
    idx = chunks if "embedding" in chunks.columns else retrieval.embed_hash(chunks, "chunk")
    return retrieval.top_k(q, idx, k, qid=qid, iid="chunk_id", on=on)


def observation_context(routed: DataFrame, obs: DataFrame, qid: str = "qid") -> DataFrame:
    """V7 lookup branch, raw rows: every observation on the question's day."""
    day_q = routed.where(F.col("q_date").isNotNull()).select(qid, codes.date_to_int("q_date").alias("date"))
    return day_q.join(obs, "date", "inner")
