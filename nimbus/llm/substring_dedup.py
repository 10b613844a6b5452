"""Removal of long repeated byte strings by interval expansion on a Burrows-Wheeler transform.

Every byte covered by a ``LEAST``-byte string that also starts anywhere else is
removed. Equal strings must meet in one task, so candidates are found first:
of the hashes of all ``GRAM``-byte strings inside a ``LEAST``-byte window the
smallest (leftmost of equals) is the window's anchor. Equal windows have equal
anchors, and consecutive windows with one anchor make one context: the bytes of
all those windows. The contexts of a text share out its windows, each window to
exactly one. Anchors that occur once are done. Contexts that occur twice or more
are repeated as a whole. Only where different contexts share an anchor do bytes
have to be compared, one copy of each context:

the contexts of a bucket of anchors are put together, their suffixes sorted, and
common prefixes derived from the Burrows-Wheeler transform breadth first: two
neighbouring suffixes that begin with the same letter have one more letter in
common than the least of the boundaries between their successors. So the
boundaries with value l + 1 follow from those with value l, and the search stops
at ``LEAST``: what has no value by then shares at least that much. Windows that
share a class are repeated.

An anchor with more than ``CROWD`` different contexts is not gathered: its
windows are hashed and counted by partial aggregation, which gives the same
marks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import _powers, buffer_chunks, mix64, row_hash, written

LEAST, GRAM = 200, 32
SPAN = LEAST - GRAM + 1
BUCKET_BYTES = 1 << 20
CROWD = 4000
_RAW = np.random.default_rng(31337).integers(1, 2**63, 256, dtype=np.uint64)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every place on."""
    n = len(data)
    power, inverse = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_RAW[data] * power, out=total[1:])
    return mix64((total[size:] - total[: n - size + 1]) * inverse[: n - size + 1])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first window, last window, place of the anchor from the first window on, its hash) of every
    run of windows with one anchor.

    The minimum over each window comes from running minima forwards and backwards
    within blocks of SPAN hashes; a hash's last byte holds its place in the block,
    so that equal hashes resolve to the leftmost.
    """
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    n = len(data)
    if n < LEAST:
        return none
    hashes = gram_hashes(data, GRAM)
    windows = n - LEAST + 1
    blocks = -(-len(hashes) // SPAN)
    low = np.uint64(0xFF)
    packed = np.full(blocks * SPAN, ~np.uint64(0))
    packed[: len(hashes)] = hashes & ~low
    packed = packed.reshape(blocks, SPAN) | np.arange(SPAN, dtype=np.uint64)
    ahead = np.minimum.accumulate(packed, axis=1).ravel()[SPAN - 1 : SPAN - 1 + windows]
    behind = np.minimum.accumulate(packed[:, ::-1], axis=1)[:, ::-1].ravel()[:windows]
    left = (behind | low) <= (ahead | low)
    place = np.arange(windows)
    at = np.where(left, place // SPAN * SPAN + (behind & low).astype(np.int64), (place + SPAN - 1) // SPAN * SPAN + (ahead & low).astype(np.int64))
    row = np.searchsorted(offsets, place, "right") - 1
    valid = place + LEAST <= offsets[row + 1]
    place, at, row = place[valid], at[valid], row[valid]
    if not len(place):
        return none
    new = np.ones(len(place), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    begin = place[first]
    return row[first], begin - offsets[row[first]], place[last] - offsets[row[first]], at[first] - begin, hashes[at[first]]


def contexts(rows: DataFrame) -> DataFrame:
    """(row, first, last, place, anchor, context) for every context of a frame (row, text): where its windows
    start, where its anchor lies in it, its anchor's hash and the hash of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("row").to_numpy()
            for begin, end, data, offsets in buffer_chunks(batch.column("text")):
                row, first, last, place, hashes = anchors(data, offsets)
                raw = memoryview(data)
                start = (offsets[row] + first).tolist()
                stop = (offsets[row] + last + LEAST).tolist()
                digest = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(start, stop)), np.uint64, len(start))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[begin:end][row]), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(hashes.view(np.int64)), pa.array(digest.view(np.int64))],
                    ["row", "first", "last", "place", "anchor", "context"])

    return rows.select("row", "text").mapInArrow(run, "row long, first int, last int, place int, anchor long, context long")


# --- suffix order and common prefixes -------------------------------------------


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; only suffixes whose rank is still shared are sorted again."""
    n = len(data)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = data.astype(np.uint64) + 1
    key = np.zeros(n, np.uint64)
    for j in range(7):  # seven letters of nine bits
        key = (key << np.uint64(9)) | wide[j : j + n]
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.zeros(n + 1, np.int64)  # 0 for the empty suffix
    rank[order] = first + 1
    step = 7
    shared = ~(new & np.append(new[1:], True))
    while shared.any():
        places = np.flatnonzero(shared)
        items = order[places]
        second = rank[np.minimum(items + step, n)]
        again = np.lexsort((second, first[places]))
        items, second = items[again], second[again]
        order[places] = items
        group = first[places]
        new = np.ones(len(places), bool)
        new[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        first[places] = np.maximum.accumulate(np.where(new, places, 0))
        rank[items] = first[places] + 1
        shared = np.zeros(n, bool)
        shared[places] = ~(new & np.append(new[1:], True))
        step *= 2
    return order


def shares_least(data: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For every suffix in order: whether it shares at least ``least`` bytes with the one before it.

    Breadth-first over the values of the common prefixes, on the Burrows-Wheeler
    transform of ``data`` with an end mark.
    """
    n = len(data)
    # the empty suffix comes first; place 0 is its row
    letters = np.zeros(n + 1, np.int16)
    letters[0] = int(data[-1]) + 1
    letters[1:] = np.where(order > 0, data[order - 1].astype(np.int16) + 1, 0)
    by_letter = np.argsort(letters, kind="stable").astype(np.int32)  # row j of the first column comes from this row of the last
    head = letters[by_letter]
    open_ = (np.flatnonzero(head[1:] == head[:-1]) + 1).astype(np.int32)
    low, high = by_letter[open_ - 1], by_letter[open_]
    found = np.ones(n + 1, bool)
    found[open_] = False
    value = np.flatnonzero(found).astype(np.int32)  # boundaries with common prefix 0
    # successors next to each other: one boundary between them, which passes its value on
    single = high - low == 1
    after = np.zeros(n + 1, np.int32)
    after[high[single]] = open_[single]
    open_, low, high = open_[~single], low[~single], high[~single]
    for _ in range(least - 1):
        if not len(value):
            break
        passed = after[value]
        if len(value) * 64 > n:
            below = np.zeros(n + 2, np.int32)
            below[value + 1] = 1
            np.cumsum(below, out=below)
            reached = below[high + 1] > below[low + 1]
        else:
            nearest = np.append(value, n + 1)[np.searchsorted(value, low, "right")]
            reached = nearest <= high
        value = np.sort(np.concatenate([passed[passed > 0], open_[reached]]))
        found[value] = True
        keep = ~reached
        open_, low, high = open_[keep], low[keep], high[keep]
    return ~found[1:]


def repeated_windows(texts: list[bytes]) -> list[np.ndarray]:
    """Per context: which of its windows occur again, in it or in another context.

    Bytes of neighbouring contexts follow each other without a mark: a window lies
    inside its own context, so its first ``LEAST`` bytes never reach the next one.
    """
    sizes = np.array([len(t) for t in texts])
    start = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    order = suffix_array(data)
    group = np.cumsum(~shares_least(data, order, LEAST))
    window = np.zeros(len(data), bool)
    for a, n in zip(start, sizes):
        window[a : a + n - LEAST + 1] = True
    inside = window[order]
    again = np.bincount(group[inside], minlength=group[-1] + 1)[group] > 1
    marks = np.zeros(len(data), bool)
    marks[order] = again & inside
    return [marks[a : a + n - LEAST + 1] for a, n in zip(start, sizes)]


def _runs(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


_MARKS = "anchor long, context long, begin int, stop int"


def worth_comparing(anchor: list[int], place: list[int], texts: list[bytes]) -> list[int]:
    """Contexts that share, with another of their anchor, half of what a window has beside it.

    A window holds SPAN - 1 bytes beside its anchor, so at least half of them on one side; a
    context whose bytes on neither side are shared that far has no repeated window.
    """
    half = (SPAN - 1) // 2
    seen: dict = {}
    for k, (a, p, t) in enumerate(zip(anchor, place, texts)):
        if p >= half:
            seen.setdefault((a, 0, t[p - half : p + GRAM]), []).append(k)
        if p + GRAM + half <= len(t):
            seen.setdefault((a, 1, t[p : p + GRAM + half]), []).append(k)
    return sorted({k for ks in seen.values() if len(ks) > 1 for k in ks})


def _compare(key, table):
    out = [[], [], [], []]
    anchors, names, texts = (table.column(c).to_pylist() for c in ("anchor", "context", "bytes"))
    chosen = worth_comparing(anchors, table.column("place").to_pylist(), texts)
    marks = repeated_windows([texts[k] for k in chosen]) if chosen else []
    for anchor, context, mark in zip([anchors[k] for k in chosen], [names[k] for k in chosen], marks):
        for a, b in zip(*_runs(mark)):
            for col, x in zip(out, (anchor, context, a, b)):
                col.append(x)
    return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["anchor", "context", "begin", "stop"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for anchor, context, text in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "bytes"))):
            n = len(text) - LEAST + 1
            digests = [hashlib.blake2b(text[i : i + LEAST], digest_size=16).digest() for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([anchor] * n), pa.array([context] * n), pa.array(range(n), pa.int32()), pa.array(digests)], ["anchor", "context", "begin", "window"])


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(row, spans) of a frame (row, text): begin and end of every run of repeated windows, as bytes."""
    found = contexts(rows)
    groups = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi")).where("n > 1")
    found = written(found.join(groups.select("anchor", (F.col("lo") < F.col("hi")).alias("mixed")), "anchor"), "contexts")
    mixed = found.where("mixed").groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("row", "first", "last", "place")).alias("at"))
    mixed = written(mixed.select("anchor", "context", "n", "at.*"), "mixed")
    crowds = mixed.groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > CROWD).select("anchor", F.lit(True).alias("crowd"))
    wanted = mixed.join(crowds, "anchor", "left").groupBy("row").agg(F.collect_list(F.struct("anchor", "context", "first", "last", "place", "crowd")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, asked in zip(batch.column("text"), batch.column("wanted")):
                text = text.as_py()
                out += [{"anchor": w["anchor"], "context": w["context"], "place": w["place"], "crowd": bool(w["crowd"]), "bytes": text[w["first"] : w["last"] + LEAST]} for w in asked.as_py()]
            kind = pa.schema([("anchor", pa.int64()), ("context", pa.int64()), ("place", pa.int32()), ("crowd", pa.bool_()), ("bytes", pa.binary())])
            yield pa.RecordBatch.from_pylist(out, kind)

    # rows alike in every column have the same row hash; their contexts are cut once
    texts = written(
        rows.join(wanted, "row").select("text", "wanted").mapInArrow(cut, "anchor long, context long, place int, crowd boolean, bytes binary").dropDuplicates(["anchor", "context"]),
        "context-bytes",
    )
    size = texts.where("NOT crowd").agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-size // BUCKET_BYTES))))
    marks = texts.where("NOT crowd").select(bucket.alias("bucket"), "anchor", "context", "place", "bytes").groupBy("bucket").applyInArrow(_compare, _MARKS)
    windows = texts.where("crowd").select("anchor", "context", "bytes").mapInArrow(_windows, "anchor long, context long, begin int, window binary")
    often = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    crowded = windows.join(often, "window").select("anchor", "context", "begin", (F.col("begin") + 1).alias("stop"))
    once = mixed.where("n = 1").select("anchor", "context")
    marks = marks.unionByName(crowded).join(once, ["anchor", "context"], "left_semi")
    whole = found.where("NOT mixed").select("row", "first", F.col("last").alias("end")).unionByName(
        found.where("mixed").join(mixed.where("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi").select("row", "first", F.col("last").alias("end")))
    # a context that occurs once has one place
    partial = mixed.where("n = 1").join(marks, ["anchor", "context"]).select(
        "row", (F.col("first") + F.col("begin")).alias("first"), (F.col("first") + F.col("stop") - 1).alias("end"))
    return whole.unionByName(partial).groupBy("row").agg(F.collect_list(F.struct("first", (F.col("end") + LEAST).alias("end"))).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    Null texts are empty. Texts shorter than ``LEAST`` bytes keep all. Repeated rows repeat each
    other's bytes, so all of them lose them. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), row_hash(docs).alias("row"), text.alias("text"))
    spans = repeated_spans(rows.select("row", "text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, text, spans in zip(batch.column("id"), batch.column("text"), batch.column("spans")):
                text = text.as_py()
                kept, at, runs = [], 0, 0
                end = -1
                for s in sorted((x["first"], x["end"]) for x in spans.as_py() or ()):
                    if s[0] > end:
                        runs += 1
                        kept.append(text[at : s[0]])
                    end = max(end, s[1])
                    at = end
                kept.append(text[at:])
                kept = b"".join(kept)
                out.append({"id": name.as_py(), "n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": runs, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept})
            yield pa.RecordBatch.from_pylist(out, pa.schema([batch.schema.field("id"), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]))

    done = rows.join(spans, "row", "left").select("id", "text", "spans")
    return done.mapInArrow(cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").withColumnRenamed("id", id_col)
