"""K4: the chunk index as a table that can be written again and again.

Layout under one URI any executor reaches: ``data/<version>/namespace=...`` holds the
rows one write made, ``manifests/<number>.json`` names the version of every namespace
and the batches applied so far. A write rewrites the namespaces it touches (old rows
whose key it does not bring, and its own) into a new version, and becomes visible by
creating the next manifest, which fails if another writer was first; then it is tried
again on top of that one. So a write that dies half-way changes nothing, a batch applied
twice is applied once, and a reader keeps the manifest it started with.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ("namespace", "doc_id", "chunk_no")
#: Namespaces of one manifest (a small text file read by the driver).
MAX_NAMESPACES = 100_000
_ATTEMPTS = 20


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests there are, oldest first."""
    fs, at = _files(spark, path)
    folder = at(f"{path}/manifests")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """{"version", "namespaces": {name: folder}, "batches": [...]}; the newest one, or empty."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return {"version": 0, "namespaces": {}, "batches": []}
        version = known[-1]
    text = spark.read.text(f"{path}/manifests/{version:012d}.json", wholetext=True).first()[0]
    return json.loads(text)


def _commit(spark: SparkSession, path: str, found: dict) -> bool:
    """Create the manifest; false if its number is taken. Written aside first, so no reader sees a part of it."""
    fs, at = _files(spark, path)
    fs.mkdirs(at(f"{path}/manifests"))
    aside = at(f"{path}/manifests/.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(found, sort_keys=True).encode()))
    out.close()
    target = at(f"{path}/manifests/{found['version']:012d}.json")
    done = not fs.exists(target) and fs.rename(aside, target)
    if not done:
        fs.delete(aside, False)
    return bool(done)


def _rows(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(*[f"{path}/{f}" for f in folders])


def _folder(namespace) -> str:
    """A namespace's folder: a digest, as names may hold any characters (they are a column of the rows)."""
    return "part=" + hashlib.md5(str(namespace).encode()).hexdigest()


def upsert(chunks: DataFrame, path: str, batch: str, newest: str | None = None) -> int:
    """Add or replace rows by (namespace, doc_id, chunk_no); the number of the manifest that holds them.

    Of several rows of one key in ``chunks`` the one with the largest ``newest`` column stays (then,
    or without it, the largest row). ``batch`` names the write: one already applied is a no-op.
    Columns absent on one side are null there. A namespace is text; a null one is an error.
    """
    spark = chunks.sparkSession
    path = path.rstrip("/")
    own = [c for c in chunks.columns if c not in KEY]
    order = F.struct(*([F.col(newest).alias("_newest")] if newest else []), *own)
    best = chunks.groupBy(*KEY).agg(F.max(order).alias("_row")).select(*KEY, *[F.col("_row").getField(c).alias(c) for c in own])
    best = best.withColumn("namespace", F.col("namespace").cast("string"))
    touched = [r[0] for r in best.select("namespace").distinct().limit(MAX_NAMESPACES + 1).collect()]
    if None in touched or len(touched) > MAX_NAMESPACES:
        raise ValueError("a chunk needs a namespace, and an index has at most %d" % MAX_NAMESPACES)
    for _ in range(_ATTEMPTS):
        now = manifest(spark, path)
        if batch in now["batches"]:
            return now["version"]
        held = [f for n, f in sorted(now["namespaces"].items()) if n in touched]
        rows = best
        if held:
            kept = _rows(spark, path, held).join(best.select(*KEY), list(KEY), "left_anti")
            rows = kept.unionByName(best, allowMissingColumns=True)
        folder = f"data/{uuid.uuid4().hex}"
        dealt = rows.withColumn("part", F.md5(F.col("namespace"))).repartition("part", F.pmod(F.xxhash64("doc_id"), F.lit(8)))
        dealt.write.partitionBy("part").parquet(f"{path}/{folder}")
        spaces = now["namespaces"] | {n: f"{folder}/{_folder(n)}" for n in touched}
        if _commit(spark, path, {"version": now["version"] + 1, "namespaces": spaces, "batches": [*now["batches"], batch]}):
            return now["version"] + 1
    raise RuntimeError("other writers were faster every time")


def read(spark: SparkSession, path: str, namespaces: list[str] | None = None, version: int | None = None) -> DataFrame:
    """The index of a manifest (the newest by default); ``namespaces`` reads only their folders."""
    path = path.rstrip("/")
    now = manifest(spark, path, version)
    folders = [f for n, f in sorted(now["namespaces"].items()) if namespaces is None or n in namespaces]
    if not folders:
        raise ValueError("no such namespace in this manifest")
    return _rows(spark, path, folders)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove manifests but the newest ``keep``, and data none of those names; how many folders went.

    Not to be run while a write is under way: its data is not named yet.
    """
    path = path.rstrip("/")
    fs, at = _files(spark, path)
    known = versions(spark, path)
    for old in known[: max(0, len(known) - keep)]:
        fs.delete(at(f"{path}/manifests/{old:012d}.json"), False)
    used = {f.split("/")[1] for v in known[-keep:] for f in manifest(spark, path, v)["namespaces"].values()}
    gone = 0
    if fs.exists(at(f"{path}/data")):
        for status in fs.listStatus(at(f"{path}/data")):
            if status.getPath().getName() not in used:
                fs.delete(status.getPath(), True)
                gone += 1
    return gone
