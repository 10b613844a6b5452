"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents are encoded and, only where longer than a sequence, cut into pieces.
A piece of full length is a sequence of its own. The others are dealt by hash
into blocks of about ``BLOCK`` pieces; each block is searched by several islands.
An individual is a grouping of the block's pieces into bins. A crossover injects
whole well-filled bins of one parent into the other, drops the bins that hold a
piece twice and places the pieces this displaces by best fit, longest first.
After each epoch an island's best individual moves to the next island (one
shuffle). Pieces in bins the search couldn't fill well are dealt anew into
blocks of their own, level by level, until one block is left. A level that fills
hardly any bin (pieces of 1300 tokens with nothing to put beside them) keeps its
bins as they are, but for the emptiest of each block; so the levels end and the
loss is about one block's, whatever the number of documents.

Encoding remembers the ids of white-space separated chunks per worker: a
pre-tokenizer that never crosses white space encodes a text as the chunks'
ids one after another.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbus.llm.common import row_hash, shuffle_parts, written

LENGTH = 2048
BLOCK, ISLANDS, EPOCHS = 2048, 2, 2
POPULATION, OFFSPRING = 5, 12
#: Bins with more free room than this share of a sequence go to the next level.
SLACK = 1 / 64
#: A level that leaves more than this share of its pieces has nothing to gain from being dealt anew.
STALLED = 0.9
#: What a worker remembers before it starts afresh (bounds its memory, not the result).
CHUNKS_KEPT, WORDS_KEPT = 600_000, 800_000
_WORKER: dict = {}
#: Visible ASCII and the letters of Latin-1 that have both cases there; the pre-tokenizer's words of such text.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, other bytes for 256, 257, ..."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


def _encoder(path: str):
    """UTF-8 texts to little-endian unsigned 32-bit ids, through the worker's memory of chunks.

    A chunk of ASCII and Latin-1 letters is cut into the words of the pre-tokenizer, and
    each distinct word goes to the tokenizer's model once; any other chunk goes through the
    whole tokenizer. Tokenizers that a probe shows to work otherwise encode whole texts.
    """
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    tokenize, letters, word_struct = whole.model.tokenize, _byte_letters(), {n: struct.Struct(f"<{n}I") for n in range(64)}
    pack = lambda ids: word_struct[len(ids)].pack(*ids) if len(ids) < 64 else np.array(ids, "<u4").tobytes()
    library = lambda xs: [pack(e.ids) for e in whole.encode_batch_fast([x.decode() for x in xs], add_special_tokens=False)]
    words: dict[str, bytes] = {}
    chunks: dict[bytes, bytes] = {}

    def word(w: str) -> bytes:
        ids = words.get(w)
        if ids is None:
            seen = w if w.isascii() else w.encode().decode("latin-1").translate(letters)
            ids = words[w] = pack([t.id for t in tokenize(seen)])
        return ids

    def learn(new: set[bytes]) -> None:
        other = []
        for c in new:
            s = c.decode()
            if _PLAIN.fullmatch(s) and "<|" not in s:
                found = _WORDS.findall(s.lower())
                chunks[c] = word(found[0]) if len(found) == 1 else b"".join([word(w) for w in found])
            else:
                other.append(c)
        chunks.update(zip(other, library(other)))

    def encode(texts: list[bytes]) -> list[bytes]:
        if len(chunks) > CHUNKS_KEPT:
            chunks.clear()
        if len(words) > WORDS_KEPT:
            words.clear()
        cut = [t.split() for t in texts]
        learn({c for cs in cut for c in cs if c not in chunks})
        return [b"".join(map(chunks.__getitem__, cs)) for cs in cut]

    probe = ["It's we'll they'd 'tis a1b22 x--y... <|endoftext|> \u00e9t\u00e9, NA\u00cfVE!?\n\tA  b", "don't 'S o'clock \u00a0x\u00b5\u00aa", " \u2014 ok e\u0301 \u4e2d\u6587"]
    probe = [x.encode() for x in probe]
    return encode if encode(probe) == library(probe) else library


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = LENGTH, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per piece: id, row, piece, start, length, ids_crc32 (and ``ids``, little-endian 32-bit, if asked).

    A document is its text's ids, then ``end_id``; null texts are empty, so every row has a piece.
    """
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, row long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), row_hash(docs).alias("row"), text.alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _WORKER:
            _WORKER[tokenizer] = _encoder(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                owner, cols = [], [[] for _ in range(4 + with_ids)]
                for k, ids in enumerate(_WORKER[tokenizer](batch.column(2).to_pylist())):
                    ids += end
                    for n, start in enumerate(range(0, len(ids), 4 * length)):
                        part = ids[start : start + 4 * length]
                        owner.append(k)
                        for col, value in zip(cols, (n, start // 4, len(part) // 4, zlib.crc32(part), part)):
                            col.append(value)
                take = pa.array(owner, pa.int64())
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                    ["id", "row", "piece", "start", "length", "ids_crc32", "ids"][: 6 + with_ids],
                )

    return rows.mapInArrow(run, schema)


def best_fit(sizes: np.ndarray, items: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Place ``items`` (longest first) into the fullest bin with room; ``bins`` and ``room`` are updated.

    A bit per amount of room says which amounts some bin has, so the tightest fit
    is the lowest bit from the item's size on.
    """
    by_room: dict[int, list[int]] = {}
    mask = 0
    for b, r in enumerate(room):
        if r > 0:
            by_room.setdefault(r, []).append(b)
            mask |= 1 << r
    for i in items:
        size = int(sizes[i])
        fit = mask >> size
        if fit:
            r = size + (fit & -fit).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                mask ^= 1 << r
        else:
            b, r = len(room), capacity
            room.append(capacity)
        room[b] = left = r - size
        bins[i] = b
        if left:
            held = by_room.setdefault(left, [])
            if not held:
                mask |= 1 << left
            held.append(b)


def _fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[float, float]:
    """Fewer bins first, then more uneven fill (full bins beside empty ones)."""
    fill = np.bincount(bins, weights=sizes) / capacity
    return -float((fill > 0).sum()), float((fill * fill).sum())


def crossover(sizes: np.ndarray, a: np.ndarray, b: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``a`` with some of ``b``'s best-filled bins injected whole."""
    fill = np.bincount(b, weights=sizes)
    good = np.flatnonzero(fill)
    good = good[np.argsort(-fill[good], kind="stable")][: max(1, len(good) // 2)]
    chosen = rng.choice(good, max(1, len(good) // 5), replace=False)
    injected = np.isin(b, chosen)
    hit = np.isin(a, np.unique(a[injected]))
    stay = ~hit & ~injected
    out = np.empty(len(a), np.int64)
    kept, place = np.unique(a[stay], return_inverse=True)
    out[stay] = place
    new, place = np.unique(b[injected], return_inverse=True)
    out[injected] = place + len(kept)
    room = (capacity - np.bincount(out[stay | injected], weights=sizes[stay | injected], minlength=len(kept) + len(new))).astype(int).tolist()
    # a few badly filled bins are opened too, so that their pieces can move
    displaced = hit & ~injected
    loose = rng.random(len(room)) < 0.5 * (np.array(room) / capacity) ** 0.5
    opened = np.zeros(len(a), bool)
    settled = np.flatnonzero(stay | injected)
    opened[settled] = loose[out[settled]]
    for k in np.flatnonzero(loose):
        room[k] = capacity
    items = np.flatnonzero(displaced | opened)
    items = items[np.argsort(-sizes[items], kind="stable")]
    best_fit(sizes, items, out, room, capacity)
    return out


def evolve(sizes: np.ndarray, start: list[np.ndarray], capacity: int, offspring: int, seed: int) -> np.ndarray:
    """The best grouping after ``offspring`` crossovers from ``start`` and random best-fit orders."""
    rng = np.random.default_rng(seed)
    order = np.argsort(-sizes, kind="stable")
    people = list(start)
    while len(people) < POPULATION:
        noise = order if not people else np.argsort(-(sizes * (1 + 0.2 * rng.random(len(sizes)))), kind="stable")
        bins, room = np.empty(len(sizes), np.int64), []
        best_fit(sizes, noise, bins, room, capacity)
        people.append(bins)
    ranked = sorted(((_fitness(sizes, p, capacity), k) for k, p in enumerate(people)), reverse=True)
    pool = [(f, people[k]) for f, k in ranked]
    least = -float(-(-int(sizes.sum()) // capacity))
    for _ in range(offspring):
        if pool[0][0][0] >= least:  # as few bins as the sizes allow
            break
        i, j = sorted(rng.choice(len(pool), 2, replace=False))
        child = crossover(sizes, pool[j][1], pool[i][1], capacity, rng) if rng.random() < 0.5 else crossover(sizes, pool[i][1], pool[j][1], capacity, rng)
        pool.append((_fitness(sizes, child, capacity), child))
        pool.sort(key=lambda x: x[0], reverse=True)
        pool.pop()
    return pool[0][1]


_STATE = "block long, island int, sizes array<int>, best array<array<int>>"


def _islands(blocks: DataFrame, capacity: int, seed: int, tasks: int) -> DataFrame:
    """(block, sizes, bins) of a frame (block, sizes): the best grouping the islands found."""
    state = blocks.select("block", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"), "sizes", F.array().cast("array<array<int>>").alias("best"))
    for epoch in range(EPOCHS):

        def run(batches: Iterator[pa.RecordBatch], epoch=epoch) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    sizes = np.array(row["sizes"], np.int64)
                    start = [np.array(b, np.int64) for b in row["best"]]
                    key = int.from_bytes(hashlib.blake2b(f"{seed},{row['block']},{row['island']},{epoch}".encode(), digest_size=8).digest(), "little")
                    best = evolve(sizes, start, capacity, OFFSPRING, key)
                    yield pa.RecordBatch.from_pylist([row | {"best": [best.tolist()]}], batch.schema)

        state = written(state.repartition(tasks, "block", "island").mapInArrow(run, _STATE), "islands")
        if epoch < EPOCHS - 1:  # each island's best also goes to the next island
            moved = state.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), "sizes", "best")
            state = state.unionByName(moved).groupBy("block", "island").agg(F.first("sizes").alias("sizes"), F.flatten(F.collect_list("best")).alias("best"))
    fewest = F.array_max(F.element_at("best", 1))
    return state.groupBy("block").agg(F.min_by(F.struct("sizes", F.element_at("best", 1).alias("bins")), F.struct(fewest, "island")).alias("s")).select("block", "s.*")


def pack(items: DataFrame, capacity: int = LENGTH, seed: int = 11) -> DataFrame:
    """``items`` (with id, row, piece, length <= capacity) with sequence_id and offset.

    Sequence numbers are unique; offsets are gapless from 0. The same items give the same packing.
    """
    columns = items.columns
    full = items.where(F.col("length") == capacity)
    out = []
    left = items.where(F.col("length") < capacity)
    place = F.xxhash64("id", "row", "piece", F.lit(seed))
    n, level = left.count(), 0
    while n:
        blocks = max(1, -(-n // BLOCK))
        # a block is few bytes and much work, so the tasks are not merged by size
        tasks = min(blocks * ISLANDS, shuffle_parts(items.sparkSession))
        block = F.pmod(F.xxhash64(place, F.lit(level)), F.lit(blocks))
        order = Window.partitionBy("block").orderBy(F.col("length").desc(), "id", "row", "piece")
        numbered = written(left.withColumn("block", block).withColumn("nr", F.row_number().over(order)), f"pack-items-{level}")
        sizes = numbered.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("nr", F.col("length").cast("int").alias("length")))).alias("x"))
        bins = _islands(sizes.select("block", F.col("x.length").alias("sizes")), capacity, seed + level, tasks)
        cells = bins.select("block", F.posexplode(F.arrays_zip("sizes", "bins")).alias("nr", "x"))
        cells = cells.select("block", (F.col("nr") + 1).alias("nr"), F.col("x.bins").alias("bin"), F.col("x.sizes").cast("long").alias("size"))
        per_bin = Window.partitionBy("block", "bin")
        cells = cells.withColumn("fill", F.sum("size").over(per_bin)).withColumn(
            "offset", F.sum("size").over(per_bin.orderBy("nr").rowsBetween(Window.unboundedPreceding, -1)))
        placed = written(numbered.join(cells.drop("size"), ["block", "nr"]), f"pack-level-{level}")
        done = F.lit(True) if blocks == 1 else F.col("fill") >= capacity * (1 - SLACK)
        n, before = placed.where(~done).count(), n
        if n > STALLED * before:
            emptiest = placed.groupBy("block").agg(F.min(F.struct("fill", "bin")).alias("least"))
            placed = placed.join(emptiest, "block")
            done = done | (F.col("bin") != F.col("least.bin"))
            n = placed.where(~done).count()
            if n > STALLED * before:
                done, n = F.lit(True), 0
        number = F.lit(level << 52) + F.col("block") * F.lit(1 << 20) + F.col("bin")
        out.append(placed.where(done).select(*columns, number.alias("sequence_id"), F.coalesce("offset", F.lit(0)).cast("long").alias("offset")))
        left = placed.where(~done).select(*columns)
        level += 1
    # pieces of full length are numbered below zero, within small groups by hash
    group = F.pmod(place, F.lit(1 << 20))
    alone = Window.partitionBy("group").orderBy("id", "row", "piece")
    result = full.withColumn("group", group).withColumn("nr", F.row_number().over(alone)).select(
        *columns, (-(F.col("nr") * F.lit(1 << 20) + F.col("group"))).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for part in out:
        result = result.unionByName(part)
    return result


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: id, row, piece, start, length, ids_crc32, sequence_id, offset.

    Every row gives at least one piece (a null or empty text: the end id alone). Repeated rows are
    packed as often as they come; null ids stay null. An empty table gives no rows.
    """
    items = written(pieces(docs, tokenizer, end_id, length, id_col, text_col), "pieces")
    return pack(items, length).withColumnRenamed("id", id_col)
