"""All registered queries, imported in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nimbus.plans import (  # noqa: F401  (registers)
    answer_queries, conversation_queries, label_queries, report_queries, storage_queries, text_queries, weather_queries,
)
from nimbus.plans.registry import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    return dict(REGISTRY)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report dataset: requests x observations -> records -> text and HTML."""
    return REGISTRY["report_dataset"].fn(spark, sf_dir)
