"""Exact deduplication with one static binary-fuse filter per immutable snapshot.

Texts are equal when identical after lower-casing A-Z. The rows are dealt by a
hash of their id into a snapshot (already stored, immutable) and an arriving
batch. The snapshot's distinct digests are sharded by digest and each shard gets
a static 3-wise binary-fuse filter. The batch is first grouped by itself (its
own duplicates); only one row per distinct digest is screened. Digests that a
filter rejects are certainly new; the others join the snapshot's exact buckets.
Rows of every class with two or more members are then compared byte for byte:
they are grouped by digest and whole normalised text, so a digest collision
can't merge two texts.

Everything but the byte check moves digests, never texts. Nothing is collected
and no group is gathered: every group is reduced by partial aggregation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import columns_of, lower_az, mix64, row_key, with_row_key, written

KEYS_PER_SHARD = 200_000


class BinaryFuse:
    """Static filter of 8-bit fingerprints: no false negative, about 1/256 false positives.

    Each key has one cell in each of three consecutive segments. Building peels
    cells that hold a single key, all such cells of a round at once, then
    assigns fingerprints in reverse order. A failed peeling takes the next seed.
    """

    def __init__(self, seed: int, segment: int, cells: np.ndarray):
        self.seed, self.segment, self.cells = seed, segment, cells

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix64(keys + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
        first = ((h >> np.uint64(32)) * np.uint64(size // segment - 2)) >> np.uint64(32)
        low, mask = mix64(h), np.uint64(segment - 1)
        places = np.stack([((first + np.uint64(i)) * np.uint64(segment) + ((low >> np.uint64(20 * i)) & mask)).astype(np.int64) for i in range(3)])
        return places, (h & np.uint64(0xFF)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys)
        segment = 1 << int(max(2, min(18, np.log2(max(len(keys), 2)) / 1.74 + 2.25)))
        size = (int(len(keys) * (1.125 + 1.2 / max(1.0, np.log2(len(keys) + 2) / 4)) / segment) + 4) * segment
        for seed in range(1, 200):
            places, prints = cls._places(keys, seed, segment, size)
            count = np.bincount(places.ravel(), minlength=size)
            which = np.zeros(size, np.int64)
            index = np.arange(len(keys))
            for p in places:
                np.bitwise_xor.at(which, p, index)
            order: list[tuple[np.ndarray, np.ndarray]] = []
            left = len(keys)
            while left:
                cells = np.flatnonzero(count == 1)
                if not len(cells):
                    break
                owner, at = np.unique(which[cells], return_index=True)
                order.append((owner, cells[at]))
                for p in places[:, owner]:
                    np.subtract.at(count, p, 1)
                    np.bitwise_xor.at(which, p, owner)
                left -= len(owner)
            if left:
                continue
            out = np.zeros(size, np.uint8)
            for owner, cell in reversed(order):
                a, b, c = places[:, owner]
                out[cell] = 0
                out[cell] = prints[owner] ^ out[a] ^ out[b] ^ out[c]
            return cls(seed, segment, out)
        raise RuntimeError("no seed peels this key set")

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        (a, b, c), prints = self._places(keys, self.seed, self.segment, len(self.cells))
        return prints == self.cells[a] ^ self.cells[b] ^ self.cells[c]

    def dump(self) -> bytes:
        return np.array([self.seed, self.segment], "<i8").tobytes() + self.cells.tobytes()

    @classmethod
    def load(cls, blob: bytes) -> BinaryFuse:
        seed, segment = np.frombuffer(blob, "<i8", 2)
        return cls(int(seed), int(segment), np.frombuffer(blob, np.uint8, offset=16))


def _keys(column) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in column.to_pylist()), "<u8")


def snapshot_filters(digests: DataFrame) -> DataFrame:
    """(shard, filter): one filter per shard of a frame of distinct (shard, digest)."""

    def build(key, table):
        blob = BinaryFuse.build(_keys(table.column("digest"))).dump()
        return pa.table({"shard": [key[0].as_py()], "filter": [blob]})

    return digests.select("shard", "digest").groupBy("shard").applyInArrow(build, "shard long, filter binary")


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """``incoming`` distinct (shard, digest) with ``maybe``: false is certainly not in the snapshot."""

    def probe(left, right):
        digests = left.column("digest")
        blobs = right.column("filter").to_pylist()
        hit = BinaryFuse.load(blobs[0]).maybe(_keys(digests)) if blobs and len(digests) else np.zeros(len(digests), bool)
        return pa.table({"digest": digests.cast(pa.binary()), "maybe": pa.array(hit, pa.bool_())})

    return (
        incoming.select("shard", "digest").groupBy("shard")
        .cogroup(filters.groupBy("shard"))
        .applyInArrow(probe, "digest binary, maybe boolean")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``row`` (hash of the whole row), keep_id, group_size, kept,
    text_sha256, repeats.

    Of equal texts the row with the largest id stays. Null texts are empty texts; null ids
    sort below all others. Rows that share id and text: the one with the larger row hash
    stays; ``repeats`` counts rows equal in every column to the one that stays (all of
    which are marked kept, being one and the same row). An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias(id_col), row_key(docs).alias("__row"), lower_az(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("__norm"))
    # the check hash tells apart texts whose digests collide, once the byte check has found them
    digest, check = F.unhex(F.sha2(F.col("__norm"), 256)), F.xxhash64("__norm")
    rows = written(
        docs.select(F.col(id_col).alias("id"), F.col("__row").alias("row"), digest.alias("digest"), check.alias("check"),
                    F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(2)).alias("batch")),
        "digests",
    )
    shards = max(1, rows.count() // KEYS_PER_SHARD + 1)
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard")

    def grouped(batch: int) -> DataFrame:
        return rows.where(F.col("batch") == batch).groupBy("digest").agg(F.count("*").alias("n")).select(shard, "digest", "n")

    snapshot, incoming = grouped(0), grouped(1)
    screened = screen(incoming, snapshot_filters(snapshot)).where("maybe").select("digest")
    hits = screened.join(snapshot, "digest", "left_semi")  # the exact buckets drop false positives
    own = snapshot.where("n > 1").select("digest").unionByName(incoming.where("n > 1").select("digest"))
    doubled = hits.unionByName(own).distinct()
    # byte check: members of a class are equal in their whole normalised text
    members = docs.select(F.col(id_col).alias("id"), F.col("__row").alias("row"), F.col("__norm"), digest.alias("digest")).join(doubled, "digest", "left_semi")
    classes = (
        members.groupBy("digest", "__norm", "id", "row").agg(F.count("*").alias("n"))
        .groupBy("digest", "__norm").agg(F.max(F.struct("id", "row", "n")).alias("top"), F.sum("n").alias("group_size"))
        .select("digest", F.xxhash64("__norm").alias("check"), "top", "group_size")
    )
    return rows.join(classes, ["digest", "check"], "left").select(
        F.col("id").alias(id_col),
        "row",
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | (F.col("id").eqNullSafe(F.col("top.id")) & (F.col("row") == F.col("top.row")))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.coalesce("top.n", F.lit(1)).cast("long").alias("repeats"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact copies: of every class one row stays, with its columns."""
    verdict = exact_dedup(docs, id_col, text_col)
    gone = verdict.where("NOT kept").select("row").distinct()
    same = verdict.where("kept AND repeats > 1").select("row").distinct()
    rows, key = with_row_key(docs)
    once = rows.join(same.withColumnRenamed("row", key), key, "left_semi").dropDuplicates([key])
    drop = gone.unionByName(same).withColumnRenamed("row", key)
    return rows.join(drop, key, "left_anti").unionByName(once).select(*columns_of(docs))
