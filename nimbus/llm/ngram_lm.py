"""Language-model scoring with Elias-Fano n-gram tries.

The model is an interpolated bigram model: with c counts over the training rows,
P(w) = (c(w) + 1) / (N + V + 1) and P(w | u) = (c(u w) + m P(w)) / (c(u) + m)
with prior mass m = MASS * c(u) ** POWER. It sums to one over all words.

Rows are dealt by hash into blocks of about ``BLOCK_BYTES``. A block sends its
distinct words and bigrams (as sorted hashes with their training counts, packed
per shard) to shards; a shard adds them up and builds one trie: contexts, monotone
pointers and context-relative successors as Elias-Fano sequences, counts quantised
to eight bits by a logarithmic codebook (exact up to 64, steps of 8 % above, wider ones
only where a word comes so often that its count would not fit). It answers the very
n-grams each block sent, in their order, and the block scores its rows. So counts
and queries travel once, texts are shuffled once for both uses, and neither a
shard nor a block grows with the corpus. A context's successors are spread over
``SPREAD`` shards, those of a word that comes ``HOT`` times or more over all shards, so
a very common word is no hot spot, whatever share of the corpus it has.
"""

from __future__ import annotations

import math
import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import buffer_chunks, mix64, row_hash, word_hashes

BLOCK_BYTES = 12 << 20
SPREAD = 8
#: About the tokens of two blocks; there are no more such words than half the blocks.
HOT = 1 << 22
MASS, POWER = 3.0, 0.85
#: Hashes of the sentence end and of the context before the first word.
END, START = np.uint64(0x1D8E4E27C47D124F), np.uint64(0x7C1F36B5A9E0D283)
_FACTOR = 1.08


# --- quantised counts ---------------------------------------------------------


def factor(top: int) -> float:
    """The step of the codebook that reaches counts up to ``top``."""
    return max(_FACTOR, (max(top, 64) / 64) ** (1 / 191))


def codebook(top: int = 0) -> np.ndarray:
    """Counts of the 256 codes: 0 to 64 exactly, then a constant factor a code."""
    return np.concatenate([np.arange(65), 64 * factor(top) ** np.arange(1, 192)])


def quantise(counts: np.ndarray, top: int = 0) -> np.ndarray:
    above = np.rint(np.log(np.maximum(counts, 64) / 64) / math.log(factor(top))).astype(np.int64)
    return np.where(counts <= 64, counts, np.minimum(64 + above, 255)).astype(np.uint8)


# --- Elias-Fano ---------------------------------------------------------------


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit integers: low bits packed, high bits in unary."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        ones = np.flatnonzero(np.unpackbits(high, bitorder="little"))[:n]
        self._high = (ones - np.arange(len(ones))).astype(np.int64)

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        width = min(56, max(0, (top // max(n, 1)).bit_length() - 1))
        low = np.zeros(n * width // 8 + 9, np.uint8)
        if width and n:
            bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(bits.ravel(), bitorder="little")
            low[: len(packed)] = packed
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        flags[ones] = 1
        return cls(n, width, low, np.packbits(flags, bitorder="little"))

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), np.uint64)
        bit = at * self.width
        byte = bit >> 3
        word = np.zeros(len(at), np.uint64)
        for k in range((self.width + 14) // 8):
            word |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k) if k < 8 else np.uint64(0)
        return (word >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return (self._high[at].astype(np.uint64) << np.uint64(self.width)) | self._low(at)

    def next_geq(self, x: np.ndarray) -> np.ndarray:
        """Index of the first element >= x (n when there is none): the high part's bucket, then bisection."""
        high, low = (x >> np.uint64(self.width)).astype(np.int64), x & np.uint64((1 << self.width) - 1)
        lo, hi = np.searchsorted(self._high, high, "left"), np.searchsorted(self._high, high, "right")
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < low[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of x, or -1."""
        at = self.next_geq(x)
        inside = at < self.n
        hit = np.zeros(len(x), bool)
        hit[inside] = self[at[inside]] == x[inside]
        return np.where(hit, at, -1)

    def parts(self) -> list[bytes]:
        return [np.array([self.n, self.width, len(self.low), len(self.high)], "<i8").tobytes(), self.low.tobytes(), self.high.tobytes()]

    @classmethod
    def read(cls, data: np.ndarray, at: int) -> tuple[EliasFano, int]:
        n, width, low, high = (int(x) for x in np.frombuffer(data[at : at + 32].tobytes(), "<i8"))
        at += 32
        return cls(n, width, data[at : at + low], data[at + low : at + low + high]), at + low + high


class Trie:
    """Bigrams (u << 32 | w, sorted) by context: contexts, pointers, successors, count codes."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @staticmethod
    def dump(keys: np.ndarray, counts: np.ndarray, top: int = 0) -> bytes:
        contexts, first, place = np.unique(keys >> np.uint64(32), return_index=True, return_inverse=True)
        # a successor is stored relative to its context's number, which keeps the level monotone
        successors = (place.astype(np.uint64) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
        pointers = np.append(first, len(keys)).astype(np.uint64)
        levels = [EliasFano.build(x) for x in (contexts, pointers, successors)]
        return b"".join(p for level in levels for p in level.parts()) + quantise(counts, top).tobytes()

    @classmethod
    def load(cls, data: np.ndarray) -> Trie:
        at, levels = 0, []
        for _ in range(3):
            level, at = EliasFano.read(data, at)
            levels.append(level)
        return cls(*levels, data[at:])

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Count codes of bigrams (0: not in the model)."""
        out = np.zeros(len(keys), np.uint8)
        context = self.contexts.find(keys >> np.uint64(32))
        known = np.flatnonzero(context >= 0)
        target = (context[known].astype(np.uint64) << np.uint64(32)) | (keys[known] & np.uint64(0xFFFFFFFF))
        at = self.successors.next_geq(target)
        inside = at < self.pointers[context[known] + 1].astype(np.int64)
        inside[inside] = self.successors[at[inside]] == target[inside]
        out[known[inside]] = self.codes[at[inside]]
        return out


@contextmanager
def mapped(blob: bytes) -> Iterator[np.ndarray]:
    """``blob`` as a memory-mapped file of this task, gone afterwards."""
    handle, path = tempfile.mkstemp(prefix="trie-")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(blob or b"\0")
        yield np.memmap(path, np.uint8, "r")
    finally:
        os.unlink(path)


# --- blocks and shards ----------------------------------------------------------


def _pack(values: np.ndarray) -> bytes:
    """Bytes of equal rank side by side (sorted values share their first bytes), compressed."""
    return zstandard.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def _unpack(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with the end token after each text, and token offsets."""
    parts, counts = [], []
    for _, _, data, offsets in buffer_chunks(texts):
        words, at = word_hashes(data, offsets)
        parts.append(np.insert(words, at[1:], END))
        counts.append(np.diff(at) + 1)
    counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


class Block:
    """A block's distinct words and bigrams, in the order they are sent to the shards."""

    def __init__(self, table: pa.Table, shards: int, hot: np.ndarray):
        tokens, self.offsets = _tokens(table.column("text"))
        held = table.column("held").to_numpy(zero_copy_only=False)
        train = np.repeat(~held, np.diff(self.offsets))
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[self.offsets[:-1]] = START
        self.words, self.word_of = np.unique(tokens, return_inverse=True)
        self.word_counts = np.bincount(self.word_of, weights=train, minlength=len(self.words)).astype(np.uint32)
        self.word_shard = ((self.words >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)  # rising with the hash
        keys = (before & np.uint64(0xFFFFFFFF00000000)) | (tokens >> np.uint64(32))
        keys, pair_of = np.unique(keys, return_inverse=True)
        counts = np.bincount(pair_of, weights=train, minlength=len(keys)).astype(np.uint32)
        context = mix64(keys >> np.uint64(32)) >> np.uint64(32)
        shard = (((context * np.uint64(shards)) >> np.uint64(32)) + (keys & np.uint64(SPREAD - 1))) % np.uint64(shards)
        whole = (mix64(keys) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
        shard = np.where(np.isin(keys >> np.uint64(32), hot), whole, shard)
        order = np.argsort(shard, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.keys, self.key_counts, self.key_shard, self.pair_of = keys[order], counts[order], shard[order], place[pair_of]

    def sent(self) -> Iterator[tuple[int, bool, bytes, bytes]]:
        for pairs, keys, counts, shard in ((False, self.words, self.word_counts, self.word_shard), (True, self.keys, self.key_counts, self.key_shard)):
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if b > a:
                    yield int(shard[a]), pairs, _pack(keys[a:b]), _pack(counts[a:b])


def _reduce(table: pa.Table, top: int) -> Iterator[tuple[int, bytes]]:
    """A shard: counts added up, its model built, every block's n-grams answered in order."""
    sent = [_unpack(b.as_py(), np.uint64) for b in table.column("keys")]
    counts = [_unpack(b.as_py(), np.uint32) for b in table.column("counts")]
    everything, at = np.unique(np.concatenate(sent), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts), minlength=len(everything)).astype(np.int64)
    seen, n = everything[total > 0], total[total > 0]
    if table.column("pairs")[0].as_py():
        with mapped(Trie.dump(seen, n, top)) as data:
            trie = Trie.load(data)
            for block, keys in zip(table.column("block").to_pylist(), sent):
                yield block, zstandard.compress(trie.lookup(keys).tobytes(), 1)
            del trie, data
    else:
        level = EliasFano.build(seen)
        n = np.append(n, 0)  # for -1: a word of held-out rows only
        for block, keys in zip(table.column("block").to_pylist(), sent):
            yield block, _pack(n[level.find(keys)].astype(np.uint32))


def corpus_totals(docs: DataFrame) -> tuple[int, int, int, int, list[int]]:
    """(N, V, bytes, top, hot) of (text, held): tokens and distinct tokens of the training rows, bytes
    of all rows, the largest count of a training token, the tokens that come ``HOT`` times in all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 0
        for batch in batches:
            size += batch.column("text").nbytes
            words, offsets = _tokens(batch.column("text"))
            train = np.repeat(~batch.column("held").to_numpy(zero_copy_only=False), np.diff(offsets))
            words, at, every = np.unique(words, return_inverse=True, return_counts=True)
            n = np.bincount(at, weights=train, minlength=len(words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n), pa.array(every)], ["word", "n", "every"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([size], pa.int64()), pa.array([0], pa.int64())], ["word", "n", "every"])

    words = docs.select("text", "held").mapInArrow(run, "word long, n long, every long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("every").alias("every"))
    known = F.col("word").isNotNull()
    row = words.agg(
        F.sum(F.when(known, F.col("n"))), F.count(F.when(known & (F.col("n") > 0), 1)), F.sum(F.when(~known, F.col("n"))),
        F.max(F.when(known, F.col("n"))), F.collect_list(F.when(F.col("every") >= HOT, F.col("word"))),
    ).first()
    return *(int(x or 0) for x in row[:4]), row[4]


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Rows where ``held_out`` is false train the model; every row is scored. A text's tokens are
    its words (A-Z as a-z) and one end; null, empty and blank texts have the end alone. Repeated
    rows count and score as often as they come. With no training rows all counts are 0.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), text.alias("text"), row_hash(docs).alias("row"))
    tokens, distinct, size, top, common = corpus_totals(rows)
    common = np.array(common, np.int64).view(np.uint64)
    # contexts are known by the upper half of their hash; the start comes as often as the end
    hot = np.append(common, START if END in common else common[:0]) >> np.uint64(32)
    blocks = max(1, -(-size // BLOCK_BYTES))
    norm = tokens + distinct + 1
    dealt = rows.select("id", "held", "text", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(blocks)).alias("block"))

    def send(key, table):
        out = list(Block(table, blocks, hot).sent())
        return pa.table({
            "shard": pa.array([x[0] for x in out], pa.int64()), "pairs": pa.array([x[1] for x in out], pa.bool_()),
            "block": pa.array([key[0].as_py()] * len(out), pa.int64()),
            "keys": pa.array([x[2] for x in out], pa.binary()), "counts": pa.array([x[3] for x in out], pa.binary()),
        })

    def answer(key, table):
        out = list(_reduce(table, top))
        return pa.table({
            "block": pa.array([x[0] for x in out], pa.int64()), "shard": pa.array([key[0].as_py()] * len(out), pa.int64()),
            "pairs": pa.array([key[1].as_py()] * len(out), pa.bool_()), "reply": pa.array([x[1] for x in out], pa.binary()),
        })

    def finish(key, table, replies):
        block = Block(table, blocks, hot)
        got = sorted(zip(replies.column("pairs").to_pylist(), replies.column("shard").to_pylist(), replies.column("reply").to_pylist()))
        count = np.concatenate([_unpack(r, np.uint32) for pairs, _, r in got if not pairs]).astype(np.float64)
        pair = np.concatenate([np.frombuffer(zstandard.decompress(r), np.uint8) for pairs, _, r in got if pairs])
        c = count[block.word_of]
        context = np.empty_like(c)
        context[1:] = c[:-1]
        context[block.offsets[:-1]] = count[np.searchsorted(block.words, END)]  # one start for each end
        unigram = (c + 1) / norm
        mass = MASS * context**POWER
        joint = codebook(top)[pair][block.pair_of]
        p = np.where(context > 0, (joint + mass * unigram) / np.maximum(context + mass, 1e-300), unigram)
        at = block.offsets[:-1]
        return pa.table({
            "id": table.column("id"), "held_out": table.column("held"), "n_tokens": np.diff(block.offsets),
            "n_known": np.add.reduceat((c > 0).astype(np.int64), at), "train_tokens": np.full(len(at), tokens, np.int64),
            "base_score": np.add.reduceat(np.log10(unigram), at), "score": np.add.reduceat(np.log10(p), at),
        })

    sent = dealt.groupBy("block").applyInArrow(send, "shard long, pairs boolean, block long, keys binary, counts binary")
    replies = sent.groupBy("shard", "pairs").applyInArrow(answer, "block long, shard long, pairs boolean, reply binary")
    kind = docs.schema[id_col].dataType.simpleString()
    done = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        finish, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return done.withColumnRenamed("id", id_col)
