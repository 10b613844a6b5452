"""Written-report archive (';' separated CSV, HTML in a field) and articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions import codes
from nimbus.functions.text import html_to_text


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """The archive CSV; fields may hold quoted HTML spanning lines."""
    return (
        spark.read.option("header", True)
        .option("sep", ";")
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def archive_parts(df: DataFrame, ts: str = "publishDate", content: str | None = "content",
                  year: int | None = None) -> DataFrame:
    """F8 + P8 + F12 + F5: timestamp -> ``date`` text, ``time`` text and
    ``season``; HTML content -> ``weather_report`` plain text; optionally one
    year only (as a timestamp range, so it can reach the Parquet scan)."""
    t = F.try_to_timestamp(F.col(ts).cast("string")) if dict(df.dtypes).get(ts) == "string" else F.col(ts)
    out = df.withColumn("_ts", t)
    if year is not None:
        lo = F.make_timestamp_ntz(F.lit(year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        hi = F.make_timestamp_ntz(F.lit(year + 1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        out = out.where((F.col("_ts") >= lo) & (F.col("_ts") < hi))
    cols = [
        F.date_format("_ts", "yyyy-MM-dd").alias("date"),
        F.date_format("_ts", "HH:mm:ss").alias("time"),
    ]
    if content is not None:
        cols.append(html_to_text(F.col(content)).alias("weather_report"))
    cols.append(codes.season(F.month("_ts")).alias("season"))
    return out.select(*cols)


def read_articles(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Any ``(doc_id, title, text)`` table."""
    return spark.read.format(fmt).load(path).select("doc_id", "title", "text")


def title_filter(df: DataFrame, col: str, words: list[str]) -> DataFrame:
    """Rows whose ``col`` contains any of ``words`` (case-sensitive)."""
    cond = F.lit(False)
    for w in words:
        cond = cond | F.col(col).contains(w)
    return df.where(cond)


def concat_lists(frames: list[DataFrame]) -> DataFrame:
    """Concatenate lists, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
