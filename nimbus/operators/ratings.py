"""Rating summaries: means, value shares, question x answer matrix, largest share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbus.functions.codes import pct_label


def rating_means(df: DataFrame, columns: Sequence[str], ceil: bool = False,
                 consensus: str | None = "ConsensusScore", digits: int = 9) -> DataFrame:
    """A1 / A2: one row, the mean of each rating (nulls skipped) and of the
    consensus score; with ``ceil`` the rating means are rounded up (the
    consensus mean is left as it is). One aggregation, one pass."""
    aggs = []
    for c in columns:
        m = F.avg(F.col(c))
        aggs.append((F.ceil(m) if ceil else F.bround(m, digits)).alias(f"avg_{c}"))
    if consensus:
        aggs.append(F.bround(F.avg(consensus), digits).alias(f"avg_{consensus}"))
    return df.agg(*aggs)


def value_share(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """A3 + F15 + R4: share in percent of each value; nulls are out of both parts.

    The total is a scalar subquery (one number broadcast to the tasks), so the
    per-value counts are never gathered into one partition.
    """
    total = df.select(F.count(F.col(column))).scalar()
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    pct = F.col("n") * F.lit(100.0) / total
    return counts.select(
        F.lit(column).alias("question"), "value", "n",
        F.bround(pct, 9).alias("pct"), pct_label(pct, digits).alias("pct_label"),
    ).orderBy("value")


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("question"), F.col(c).cast("string").alias("answer")) for c in columns])).alias("s")
    ).select("s.question", "s.answer").where(F.col("answer").isNotNull())


def answer_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Shares of every answer within each question (long form)."""
    counts = _long(df, columns).groupBy("question", "answer").agg(F.count(F.lit(1)).alias("n"))
    # rows per question = distinct answers of that question: a small window
    total = F.sum("n").over(Window.partitionBy("question"))
    return counts.withColumn("pct", F.col("n") * F.lit(100.0) / total)


def answer_matrix(df: DataFrame, columns: Sequence[str], answers: Sequence[str], digits: int = 9) -> DataFrame:
    """A4: question x answer percentage matrix; an absent answer gives 0. What ``answers`` does not
    list is summed up in ``other_pct``. The list is explicit, so no job runs to find the values."""
    answer, pct = F.col("answer"), F.col("pct")
    listed = [F.max(F.when(answer == a, F.bround(pct, digits))).alias(f"pct_{a}") for a in answers]
    other = F.bround(F.sum(F.when(~answer.isin(*answers), pct)), digits).alias("other_pct")
    return answer_shares(df, columns).groupBy("question").agg(*listed, other).fillna(0.0)


def max_share(df: DataFrame, columns: Sequence[str], digits: int = 9) -> DataFrame:
    """A5: the largest value share over several questions (e.g. for a common axis)."""
    return answer_shares(df, columns).agg(F.bround(F.max("pct"), digits).alias("max_pct"))
