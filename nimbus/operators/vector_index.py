"""An inverted-file vector index (V3): trained centroids, one stored list per centroid.

``build`` assigns every vector to the list of its closest centroid and writes the
lists as partitions of a Parquet table. ``search`` sends each query to its ``probes``
closest lists; the scan reads the probed partitions only, and candidates are ranked by
their exact cosine, so a result's scores and ties are those of ``retrieval.top_k`` and
only items of unprobed lists can be missing. With as many probes as lists the result is
exact. ``calibrate`` measures recall against the exact search and gives the fewest
probes that reach a target.

A list of any size is dealt into blocks, as are the queries that probe it, so neither a
hot list nor a hot query neighbourhood lands in one task. The centroids (``lists`` x
dimension) are the only thing on the driver; their number is a parameter, bounded by
``MAX_LISTS``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.operators import retrieval
from nimbus.session import materialised

MAX_LISTS = 65_536
#: Vectors the centroids are trained on, per list (a sample by hash of the id; the index holds every vector).
TRAINED_PER_LIST = 256
_SEED, _ROUNDS = 5, 12
#: Scores of vectors against centroids a task holds at once.
_SCORES = 1 << 20


def _usable(df: DataFrame, vec: str) -> DataFrame:
    """Rows with a direction: no null, no null component, not all zero."""
    length = retrieval.norm(F.col(vec))
    return df.where(F.col(vec).isNotNull() & (F.coalesce(length, F.lit(0.0)) > 0))


def train(vectors: DataFrame, lists: int, iid: str = "item_id", vec: str = "embedding") -> np.ndarray:
    """Unit centroids of at most ``lists`` clusters (cosine k-means on Spark), from a sample of
    about ``TRAINED_PER_LIST`` vectors a list chosen by a hash of the id."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    if not 1 <= lists <= MAX_LISTS:
        raise ValueError(f"lists must lie in 1..{MAX_LISTS}")
    usable = _usable(vectors.select(iid, vec), vec)
    share = min(1.0, lists * TRAINED_PER_LIST / max(1, usable.count()))
    sample = usable.where(F.pmod(F.xxhash64(iid, F.lit(_SEED)), F.lit(1 << 30)) < int(share * (1 << 30)))
    points = sample.select(array_to_vector(F.transform(vec, lambda x: x.cast("double"))).alias("features"))
    if points.isEmpty():
        return np.zeros((0, 0))
    model = KMeans(k=lists, seed=_SEED, maxIter=_ROUNDS, distanceMeasure="cosine").fit(points) if lists > 1 else None
    centres = np.array(model.clusterCenters()) if model else np.array([points.first()[0].toArray()])
    return centres / np.linalg.norm(centres, axis=1, keepdims=True)


def _closest(centres: np.ndarray, n: int):
    """Column function: the ``n`` closest lists of a vector, best first."""

    @F.pandas_udf("array<int>")
    def closest(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        # a bounded number of scores at a time, however many lists there are
        step = max(1, _SCORES // len(centres))
        near: list[np.ndarray] = []
        for low in range(0, len(vectors), step):
            some = np.stack([np.asarray(v, np.float64) for v in vectors.iloc[low : low + step]]) @ centres.T
            near.extend(np.argsort(-some, axis=1, kind="stable")[:, :n].astype(np.int32))
        return pd.Series(near, dtype=object)

    return closest


def build(vectors: DataFrame, path: str, lists: int, iid: str = "item_id", vec: str = "embedding", files_per_list: int = 1,
          keep: tuple[str, ...] = ()) -> None:
    """Train and write the index: ``path``/centroids and ``path``/lists (list_id=...), every usable
    vector once, with the columns ``keep``. Vectors without a direction are not stored, as no
    search can return them."""
    spark = vectors.sparkSession
    centres = train(vectors, lists, iid, vec)
    rows = [(k, [float(x) for x in c]) for k, c in enumerate(centres)]
    spark.createDataFrame(rows, "list_id int, centroid array<double>").write.mode("overwrite").parquet(f"{path}/centroids")
    usable = _usable(vectors.select(iid, vec, *keep), vec)
    if not len(centres):
        usable.withColumn("list_id", F.lit(0)).limit(0).write.mode("overwrite").parquet(f"{path}/lists")  # the schema alone
        return
    placed = usable.withColumn("list_id", _closest(centres, 1)(vec)[0])
    # a list is written by ``files_per_list`` tasks
    dealt = placed.repartition("list_id", F.pmod(F.xxhash64(iid), F.lit(files_per_list)))
    dealt.write.mode("overwrite").partitionBy("list_id").parquet(f"{path}/lists")


def centroids_of(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.parquet(f"{path}/centroids").orderBy("list_id").limit(MAX_LISTS).collect()
    return np.array([r["centroid"] for r in rows]) if rows else np.zeros((0, 0))


def read_lists(spark: SparkSession, path: str, lists: list[int] | None = None) -> DataFrame:
    """The stored vectors; ``lists`` prunes to those partitions."""
    df = spark.read.parquet(f"{path}/lists")
    return df if lists is None else df.where(F.col("list_id").isin(lists))


def search(queries: DataFrame, path: str, k: int, probes: int, qid: str = "qid", qvec: str = "q_embedding", iid: str = "item_id",
           vec: str = "embedding", digits: int | None = 9, query_block: int = retrieval.QUERY_BLOCK,
           item_block: int = retrieval.ITEM_BLOCK) -> DataFrame:
    """(qid, rank, iid, similarity): the best ``k`` items of the ``probes`` lists closest to each query.

    Ties go to the smaller item id. A query without a direction gets no row.
    """
    spark = queries.sparkSession
    centres = centroids_of(spark, path)
    stored = spark.read.parquet(f"{path}/lists")
    types = {f.name: f.dataType.simpleString() for f in [*stored.schema.fields, *queries.schema.fields]}
    if not len(centres):
        return spark.createDataFrame([], f"{qid} {types[qid]}, rank int, {iid} {types.get(iid, 'long')}, similarity double")
    usable = _usable(queries.select(qid, qvec), qvec)
    probing = materialised(usable.withColumn("list_id", F.explode(_closest(centres, min(probes, len(centres)))(qvec))), "probing")
    most = retrieval.block_rows(centres.shape[1])
    query_block, item_block = min(query_block, most), min(item_block, most)
    # one number per list on either side
    asked = probing.groupBy("list_id").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("_qn"))
    lists = sorted(r["list_id"] for r in asked.select("list_id").collect())
    items = read_lists(spark, path, lists)
    held = items.groupBy("list_id").agg(F.ceil(F.count(F.lit(1)) / item_block).cast("int").alias("_in"))
    sizes = F.broadcast(asked.join(held, "list_id"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    deal = lambda a, b, n: F.pmod(F.xxhash64(a, b), F.col(n)).cast("int")
    left = probing.join(sizes, "list_id").select("list_id", qid, qvec, deal(qid, qvec, "_qn").alias("_qb"), every("_in").alias("_ib"))
    right = items.join(sizes, "list_id").select("list_id", iid, vec, deal(iid, vec, "_in").alias("_ib"), every("_qn").alias("_qb"))
    right = retrieval.own_columns(right)
    keys = ["list_id", "_qb", "_ib"]
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        retrieval.block_scorer(k, qid, iid, qvec, vec, digits), f"{qid} {types[qid]}, {iid} {types[iid]}, similarity double")
    return retrieval.ranked(scored, k, qid, iid)


def recall(exact: DataFrame, found: DataFrame, qid: str = "qid", iid: str = "item_id") -> float:
    """Share of the exact result's (query, item) rows that were found; 1 where there are none."""
    both = exact.select(qid, iid).join(found.select(qid, iid).withColumn("_hit", F.lit(1)), [qid, iid], "left")
    n, hits = both.agg(F.count(F.lit(1)), F.count("_hit")).first()
    return hits / n if n else 1.0


def calibrate(queries: DataFrame, path: str, k: int, target: float = 0.9, qid: str = "qid", qvec: str = "q_embedding",
              iid: str = "item_id", vec: str = "embedding") -> tuple[int, float]:
    """(probes, recall): the fewest probes, by doubling, whose recall over ``queries`` reaches ``target``."""
    lists = len(centroids_of(queries.sparkSession, path))
    exact = materialised(retrieval.top_k(queries, read_lists(queries.sparkSession, path), k, qid=qid, iid=iid, qvec=qvec, ivec=vec), "exact")
    probes = 1
    while True:
        reached = recall(exact, search(queries, path, k, probes, qid, qvec, iid, vec), qid, iid)
        if reached >= target or probes >= lists:
            return min(probes, max(lists, 1)), reached
        probes *= 2
