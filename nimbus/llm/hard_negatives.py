"""Hard-negative mining by segment summary filtering.

Components become whole numbers (floor of ``SCALE`` times their value), so scores
are exact inner products. Every vector stores the mean and the deviation of each
of its segments of ``LEAF`` components. For two segments of length d the inner
product lies within

    d * mean_x * mean_y  -/+  deviation_x * deviation_y

and the sums over segments bound the score. Summaries of longer segments follow
from those of their halves, so a pair of vectors is first bounded by one segment,
then by two, four and so on; what can't reach its window any more is dropped, and
only what is left is scored exactly.

Rows and anchors are dealt into blocks; every block of rows meets every block of
anchors in one task. A task keeps at most ``k`` rows per anchor and window, and
raises an anchor's lower limit as it finds them. A window over those few rows
gives the result, ties by smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbus.llm.common import written

SCALE, LEAF = 256, 8
#: Rows and anchors of a block, rows compared at once, and the share of pairs below which single pairs are refined.
ROWS, ANCHORS, TILE, SPARSE = 65_536, 8_192, 1_024, 1 / 16
_LOWEST, _HIGHEST = -(2**63), 2**63 - 1


def prepared(rows: DataFrame, anchor: Column, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(rid, id, label, anchor, vector, wide, summary) of the rows that take part.

    ``rid`` numbers the rows; ``vector`` holds the whole numbers as int16, or as double where
    ``wide``; ``summary`` the mean and the deviation of every segment of ``LEAF`` components.
    """
    finite = F.forall(F.col(vector_col), lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    taking = rows.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).where(finite)
    chosen = taking.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                           F.coalesce(anchor, F.lit(False)).alias("anchor"), F.transform(vector_col, lambda x: x.cast("double")).alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(4)
            at = column.offsets.to_numpy()
            values = np.floor(SCALE * column.values.to_numpy(zero_copy_only=False))
            blobs, wide, summaries = [], [], []
            for a, b in zip(at[:-1], at[1:]):
                v = values[a:b]
                wide.append(bool(len(v)) and bool(np.abs(v).max() > 32767))
                blobs.append(v.astype("<f8" if wide[-1] else "<i2").tobytes())
                padded = np.zeros(-(-len(v) // LEAF) * LEAF)
                padded[: len(v)] = v
                leaves = padded.reshape(-1, LEAF)
                mean = leaves.mean(1)
                deviation = np.sqrt(((leaves - mean[:, None]) ** 2).sum(1))
                with np.errstate(over="ignore"):
                    summaries.append(np.concatenate([mean, deviation]).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(4)], pa.array(blobs, pa.binary()), pa.array(wide, pa.bool_()), pa.array(summaries, pa.binary())],
                ["rid", "id", "label", "anchor", "vector", "wide", "summary"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in (id_col, label_col)}
    schema = f"rid long, id {kinds[id_col]}, label {kinds[label_col]}, anchor boolean, vector binary, wide boolean, summary binary"
    return written(chosen.mapInArrow(run, schema), "negatives-rows")


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """Vectors as float64 rows, missing components zero."""
    out = np.zeros((len(table), width))
    for k, (blob, wide) in enumerate(zip(table.column("vector").to_pylist(), table.column("wide").to_pylist())):
        v = np.frombuffer(blob, "<f8" if wide else "<i2")
        out[k, : len(v)] = v
    return out


def _levels(table: pa.Table, leaves: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(means, deviations) per level, from one segment to ``leaves`` (a power of two) of them."""
    mean, deviation = np.zeros((len(table), leaves)), np.zeros((len(table), leaves))
    for k, blob in enumerate(table.column("summary").to_pylist()):
        m, d = np.frombuffer(blob, "<f4").reshape(2, -1)
        mean[k, : len(m)], deviation[k, : len(d)] = m, d
    out, length = [(mean, deviation)], LEAF
    while mean.shape[1] > 1:
        a, b = mean[:, ::2], mean[:, 1::2]
        squares = deviation[:, ::2] ** 2 + deviation[:, 1::2] ** 2 + length * (a - b) ** 2 / 2
        mean, deviation, length = (a + b) / 2, np.sqrt(squares), 2 * length
        out.append((mean, deviation))
    return out[::-1]


def _products(x: np.ndarray, y: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """x @ y.T, as a whole or only where ``alive`` once few pairs are left (zero elsewhere)."""
    if alive.mean() > SPARSE:
        return x @ y.T
    r, a = np.nonzero(alive)
    out = np.zeros(alive.shape, x.dtype)
    out[r, a] = (x[r] * y[a]).sum(1)
    return out


def _search(rows: pa.Table, anchors: pa.Table, k: int, same: bool) -> tuple[np.ndarray, ...]:
    """(anchor, slot, row, score): the k best rows per anchor and window, rows being in order of id.

    ``same`` takes rows of the anchor's label, else those of other labels; an anchor itself never counts.
    """
    width = max(max(len(b) // (8 if w else 2) for b, w in zip(t.column("vector").to_pylist(), t.column("wide").to_pylist())) for t in (rows, anchors))
    x, y = _matrix(rows, width), _matrix(anchors, width)
    size_x, size_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    # partial sums stay below the product of the lengths, so they are exact in the narrowest of these
    most = float(size_x.max() * size_y.max())
    if most >= 2**62:
        raise ValueError("a score may not fit a long")
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    x, y = x.astype(kind), y.astype(kind)
    slack = 1e-5 * most + 1e-3
    leaves = 1
    while leaves * LEAF < width:
        leaves *= 2
    levels_x, levels_y = _levels(rows, leaves), _levels(anchors, leaves)
    low = np.array(anchors.column("low").to_pylist(), np.int64)
    high = np.array(anchors.column("high").to_pylist(), np.int64)
    least = low.copy()  # raised once a slot has k rows
    label_x, label_y = rows.column("label").to_numpy(zero_copy_only=False), anchors.column("label").to_numpy(zero_copy_only=False)
    rid_x, rid_y = rows.column("rid").to_numpy(), anchors.column("rid").to_numpy()
    best = tuple(np.zeros(0, np.int64) for _ in range(4))
    for at in range(0, len(x), TILE):
        part = slice(at, at + TILE)
        alive = (label_x[part, None] == label_y[None, :]) == same
        alive &= rid_x[part, None] != rid_y[None, :]
        floor, ceiling = least.min(1).astype(float) - slack, high.max(1).astype(float) + slack
        for level, (mean, deviation) in enumerate(levels_x):
            if not alive.any():
                break
            length = LEAF * leaves >> level
            centre = length * _products(mean[part], levels_y[level][0], alive)
            spread = _products(deviation[part], levels_y[level][1], alive)
            alive &= (centre + spread >= floor) & (centre - spread <= ceiling)
        if not alive.any():
            continue
        scores = _products(x[part], y, alive)
        r, a = np.nonzero(alive)
        s = np.rint(scores[r, a]).astype(np.int64) if kind is not np.int64 else scores[r, a]
        found = [best]
        for slot in range(low.shape[1]):
            inside = (s >= least[a, slot]) & (s <= high[a, slot])
            found.append((a[inside], np.full(int(inside.sum()), slot), r[inside] + at, s[inside]))
        a, slot, r, s = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((r, -s, slot, a))
        a, slot, r, s = a[order], slot[order], r[order], s[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (slot[1:] != slot[:-1])
        place = np.arange(len(a)) - np.maximum.accumulate(np.where(first, np.arange(len(a)), 0))
        full = place == k - 1
        least[a[full], slot[full]] = np.maximum(least[a[full], slot[full]], s[full])
        kept = place < k
        best = a[kept], slot[kept], r[kept], s[kept]
    return best


def nearest(rows: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """(arid, slot, rank, rid, id, score): the k best rows of every window of every anchor.

    ``anchors`` has, besides the columns of ``rows``, equally long arrays ``low`` and ``high``:
    the limits of its windows, both included.
    """
    spark = rows.sparkSession
    row_blocks = max(-(-rows.count() // ROWS), spark.sparkContext.defaultParallelism)
    anchor_blocks = max(1, -(-anchors.count() // ANCHORS))
    columns = ["rid", "id", "label", "vector", "wide", "summary"]
    deal = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select(*columns, deal(row_blocks).alias("i")).select("*", every(anchor_blocks).alias("j"))
    right = anchors.select(*columns, "low", "high", deal(anchor_blocks).alias("j")).select("*", every(row_blocks).alias("i"))
    # columns of their own, apart from those of ``left``, which has the same ancestors
    right = right.select(*[F.col(c).alias(f"{c}_") for c in right.columns]).toDF(*right.columns)
    kind = rows.schema["id"].dataType.simpleString()
    names = ["arid", "slot", "rid", "id", "score"]

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        if not len(x) or not len(y):
            none = [pa.int64(), pa.int32(), pa.int64(), x.schema.field("id").type, pa.int64()]
            return pa.table([pa.array([], t) for t in none], names)
        x = x.take(pc.sort_indices(x, sort_keys=[("id", "ascending"), ("rid", "ascending")], null_placement="at_end")).combine_chunks()
        a, slot, r, s = _search(x, y, k, same)
        r = pa.array(r)
        return pa.table([y.column("rid").combine_chunks().take(pa.array(a)), pa.array(slot, pa.int32()), x.column("rid").take(r), x.column("id").take(r), pa.array(s)], names)

    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(meet, f"arid long, slot int, rid long, id {kind}, score long")
    order = Window.partitionBy("arid", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("arid", "slot", "rank", "rid", "id", "score")


def hard_negatives(rows: DataFrame, anchor: Column, k: int = 5, low: int = 80, high: int = 100, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are the ``k`` other rows of its label with the highest scores; for each,
    the first ``k`` rows of other labels with low * positive_score <= 100 * negative_score <=
    high * positive_score are returned, ``rank`` from 1. Ties go to the smaller id, null ids last,
    rows of one id in order of reading. Rows with a null label, a null vector or any null or
    non-finite component take no part; a vector shorter than another is as if filled up with zeros
    (an empty one scores 0). ``anchor`` marks the anchors; where it is null the row is none. An
    anchor without positives, or a positive without negatives, gives no row, as does an empty
    table. Scores that may not fit a long are an error.
    """
    rows = prepared(rows, anchor, id_col, vector_col, label_col)
    anchors = rows.where("anchor")
    whole = anchors.withColumn("low", F.array(F.lit(_LOWEST))).withColumn("high", F.array(F.lit(_HIGHEST)))
    positives = written(nearest(rows, whole, k, same=True), "negatives-positives")
    # whole limits of the window, reckoned in decimals: a score times a percentage may not fit a long
    least = F.transform("p", lambda x: F.ceil(x["score"].cast("decimal(20,0)") * low / 100).cast("long"))
    most = F.transform("p", lambda x: F.floor(x["score"].cast("decimal(20,0)") * high / 100).cast("long"))
    windows = positives.groupBy("arid").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))
    # slots are told by place, so an anchor with fewer positives gets empty windows besides
    pad = lambda c, v: F.concat(c, F.array_repeat(F.lit(v).cast("long"), F.lit(k) - F.size("p")))
    windows = windows.select(F.col("arid").alias("rid"), pad(least, _HIGHEST).alias("low"), pad(most, _LOWEST).alias("high"))
    negatives = nearest(rows, anchors.join(windows, "rid"), k, same=False)
    ids = anchors.select(F.col("rid").alias("arid"), F.col("id").alias("anchor_id"))
    named = positives.select("arid", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(named, ["arid", "slot"]).join(ids, "arid").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
