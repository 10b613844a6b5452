"""Sinks: CSV report dataset, one HTML file per report, JSON log, chunk index.

All of them write from the executors; nothing passes through the driver.
Paths must be on a file system every executor reaches (the session's
checkpoint root is one).
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _json_arrays(df: DataFrame) -> DataFrame:
    """Array / struct / map columns -> JSON text (CSV has no nested types)."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(
        *[F.to_json(F.col(f.name), {"ignoreNullFields": "false"}).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields]
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: header, every field quoted, nested columns as JSON text."""
    _json_arrays(df).write.mode(mode).option("header", True).option("quoteAll", True).option(
        "escape", '"'
    ).csv(path)


def write_log(df: DataFrame, path: str, mode: str = "append") -> None:
    """K3: one JSON object per record (JSON lines)."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_html(df: DataFrame, directory: str, html: str = "html_report", name: str = "external_id",
               suffix: str = ".HTML") -> DataFrame:
    """K2: one file ``{name}{suffix}`` per row, written by the task that holds the
    row (overwritten on retry, so a lost executor only rewrites its files).
    Returns ``(name, filename)``; a manifest of it is written next to the files."""
    directory = directory.rstrip("/")

    def write(batches):
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(directory if "://" in directory else "file://" + os.path.abspath(directory))
        filesystem.create_dir(base, recursive=True)
        for pdf in batches:
            names = []
            for ident, page in zip(pdf[name], pdf[html]):
                target = f"{base}/{ident}{suffix}"
                with filesystem.open_output_stream(target) as out:
                    out.write(("" if page is None else str(page)).encode("utf-8"))
                names.append(f"{directory}/{ident}{suffix}")
            yield pd.DataFrame({name: pdf[name].astype(str), "filename": names})

    out = df.select(F.col(name).cast("string").alias(name), html).mapInPandas(
        write, f"{name} string, filename string"
    )
    out.write.mode("overwrite").parquet(f"{directory}/_manifest")
    return out.sparkSession.read.parquet(f"{directory}/_manifest")


def write_index(chunks: DataFrame, path: str, mode: str = "append") -> None:
    """K4: chunk rows (namespace, doc_id, chunk_no, title, text, embedding) into
    a namespace-partitioned Parquet index, one row per key."""
    chunks.dropDuplicates(["namespace", "doc_id", "chunk_no"]).write.mode(mode).partitionBy("namespace").parquet(path)


def read_index(spark, path: str, namespace: str | None = None) -> DataFrame:
    """Read the index; a namespace filter prunes to that partition."""
    df = spark.read.parquet(path)
    return df.where(F.col("namespace") == namespace) if namespace is not None else df


def write_observations(obs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Cleaned observations as the lookup table: one directory per station
    (a location view or request prunes to it), files holding whole months
    sorted by date and hour, so a day or month lookup reads only the row groups
    whose min/max statistics cover it. Rows are clustered by (station, month)
    in one shuffle; a month of one station is at most 24 x 31 rows, so no task
    gets more than the data of the months hashed to it."""
    month = (F.col("date") / 100).cast("int")
    (
        obs.repartition(month, "station")
        .sortWithinPartitions("station", "date", "hour")
        .write.mode(mode)
        .partitionBy("station")
        .parquet(path)
    )
