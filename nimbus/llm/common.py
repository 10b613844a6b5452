"""Helpers the operators share: scratch tables, text normalisation, word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word: a run of characters other than space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation. The
    folder is ``spark.checkpoint.dir`` (see ``nimbus.session.checkpoint_root``).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_az(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def columns_of(df: DataFrame) -> list[Column]:
    """Every column by its literal name, dots and backticks included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def _values_and_nulls(df: DataFrame) -> list[Column]:
    """What a row is: its values and, as the hash passes over nulls, which of them are null."""
    columns = columns_of(df)
    return [*columns, F.concat(*[F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns])]


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a whole row; tells rows that share an id apart."""
    return F.xxhash64(*_values_and_nulls(df))


def row_key(df: DataFrame) -> Column:
    """128-bit hash of a whole row as text: what verdicts on rows are joined back by."""
    parts = _values_and_nulls(df)
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), *parts)), 16, "0") for k in (1, 2)])


def with_row_key(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with its row key in a new column, and that column's name."""
    name = "__row"
    while name in df.columns:
        name += "_"
    return df.select(*columns_of(df), row_key(df).alias(name)), name


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % n


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# --- word hashes over raw UTF-8 buffers -------------------------------------

#: Bytes between words, and bytes that are not letters (all bytes beyond ASCII count as letters).
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
_MULT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_MULT, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift, multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        size = max(n, 1 << 20)
        for name, base in (("p", _MULT), ("i", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["p"][:n], _POWERS["i"][:n]


def buffer_chunks(column, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a binary Arrow column into runs of whole rows of about ``limit`` bytes.

    Yields (first row, end row, bytes as uint8, row offsets into them); a row
    longer than the limit is a run of its own.
    """
    n = len(column)
    if not n:
        return
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32, n + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, A-Z read as a-z, and the word offset of every row.

    ``gaps`` marks the bytes between words. A word's hash is a polynomial over its
    bytes, taken from one prefix sum over the buffer, then mixed with its length;
    words never cross rows.
    """
    n = len(data)
    rows = len(offsets) - 1
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    inside = ~gaps[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power, out=total[1:])
    hashes = (total[ends] - total[starts]) * inverse[starts]
    hashes = mix64(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, offsets)
