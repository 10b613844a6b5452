"""N-gram Jaccard join by set-relation skipping.

A document's set holds its distinct n-word shingles; sets with
100 * |intersection| >= similar * |union| are linked. Documents with one set are one node.

Shingles are ordered by a corpus-wide frequency sketch (a fixed number of hash
buckets counted over all documents, so its size never grows), rare ones first.
Linked sets share a shingle of their prefixes in this order, whatever the order
is. An index list holds a prefix shingle's nodes of two neighbouring size classes;
the node with the smallest hash is the list's hub, and lists of one hub are one
bucket, so linked sets meet in a bucket at least. Two members that differ in more
parity bits than a link allows share that shingle by chance: before any set is read
a bucket falls apart into what the other pairs join, each with a hub of its own, and
the same set of nodes from many buckets is one bucket again.

Within a bucket the hub's answers are computed first: the overlap of every member
with the hub, kept as what the member lacks of the hub and what it has besides.
Members linked with the hub are settled against each other. The answers of all
others are derived from those differences alone:

    |y & z| = |h| - |h-y| - |h-z| + |(h-y) & (h-z)| + |(y-h) & (z-h)|

A large bucket is cut into blocks by size and by position (what is lacking of the
hub); block pairs whose ranges rule a link out are skipped. Only a spanning forest
of the links found leaves a task, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import buffer_chunks, mix64, word_hashes, written
from nimbus.llm.near_dedup import components, distinct_sets, shingles

SHINGLE, SIMILAR = 3, 90
#: Counters of the frequency sketch (4 bytes each, the same at every size).
COUNTERS = 1 << 18
#: Vectors of the sketch summed in one task, about.
FAN_IN = 64
#: Bits of the filter of wanted nodes (8 MB, the same at every size), and the parts it is made in.
FILTER, FILTER_PARTS = 1 << 26, 64
#: Members of a block, and of a large bucket at least.
BLOCK = 2048
#: Members of small buckets that are settled together, about.
BIN = 256
_COLUMNS = 2048


def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def _sets_of(column, shingle: int):
    for first, end, data, offsets in buffer_chunks(column, 1 << 19):
        words, at = word_hashes(data, offsets)
        yield first, end, *distinct_sets(*shingles(words, at, shingle))


def _node_keys(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """128-bit key of every set: two order-free sums of mixed values, null for an empty set."""
    n = np.diff(at).astype(np.uint64)
    halves = []
    for salt in (0xA5A5A5A5DEADBEEF, 0x1F83D9ABFB41BD6B):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix64(values ^ np.uint64(salt)), out=total[1:])
        halves.append(mix64(total[at[1:]] - total[at[:-1]] + n))
    raw = np.stack(halves, 1).tobytes()
    return pa.array([raw[16 * k : 16 * k + 16] if size else None for k, size in enumerate(n)], pa.binary())


def _dealt(vectors: DataFrame, slots: int) -> DataFrame:
    """``vectors`` with ``slot``, a number below ``slots``, each about as often.

    Row numbers are hashed: those of a partition start at a multiple of 2**33, so by themselves
    they fall on few slots, on one if ``slots`` is a power of two and a partition holds one row.
    """
    slot = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(slots)) if slots > 1 else F.lit(0).cast("long")
    return vectors.withColumn("slot", slot)


def set_rows(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> tuple[DataFrame, np.ndarray]:
    """Per row (id, node, n), and the frequency sketch of all shingles.

    ``node`` is the key of the set (null when empty), ``n`` its size.
    """
    rows = docs.select(F.col(id_col).alias("id"), _text(text_col).alias("text"))
    names = ["id", "node", "n", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(COUNTERS, np.uint32), None
        for batch in batches:
            kind = batch.column(0).type
            for first, end, values, at in _sets_of(batch.column(1), shingle):
                counts += np.bincount((values & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _node_keys(values, at), pa.array(np.diff(at), pa.int64()), pa.nulls(end - first, pa.binary())], names)
        if kind is not None:
            one = [pa.nulls(1, t) for t in (kind, pa.binary(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*one, pa.array([counts.tobytes()], pa.binary())], names)

    kind = docs.schema[id_col].dataType.simpleString()
    out = written(rows.mapInArrow(run, f"id {kind}, node binary, n long, counts binary"), "join-rows")

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(COUNTERS, np.uint64)
        for blob in table.column("counts").to_pylist():
            total += np.frombuffer(blob, np.uint32)
        return pa.table({"counts": [np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()]})

    vectors = out.where("counts IS NOT NULL").select("counts")
    left = vectors.count()
    while left > 1:
        left = -(-left // FAN_IN)
        vectors = written(_dealt(vectors.select("counts"), left).groupBy("slot").applyInArrow(add, "counts binary"), "join-sketch")
        left = min(left, vectors.count())
    found = vectors.first()
    sketch = np.frombuffer(bytes(found[0]), np.uint32) if found else np.zeros(COUNTERS, np.uint32)
    return out.where("counts IS NULL").drop("counts"), sketch


def _parity(values: np.ndarray) -> bytes:
    """Parity of the number of shingles in each of a power of two of hash buckets, half as many as shingles.

    Two sets differ in at least as many shingles as their parities differ in bits.
    """
    size = 64
    while size * 2 < len(values):
        size *= 2
    odd = np.bincount(((values >> np.uint64(24)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def prefixes(docs: DataFrame, sketch: np.ndarray, text_col: str, shingle: int, similar: int) -> DataFrame:
    """(node, n, tokens, early, parity): every node's prefix, rare shingles first.

    Of two linked sets the smaller has the first shared shingle among its ``early`` first ones:
    behind them too few are left for the overlap a link with a larger set needs.
    """
    order = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = order.value
        for batch in batches:
            for _, _, values, at in _sets_of(batch.column(0), shingle):
                n = np.diff(at)
                filled = np.flatnonzero(n)
                owner = np.repeat(np.arange(len(n)), n)
                ranked = np.lexsort((values, weights[(values & np.uint64(COUNTERS - 1)).astype(np.int64)], owner))
                length = n - -(-similar * n // 100) + 1
                taken = np.arange(len(values)) - at[owner] < length[owner]
                tokens = values[ranked][taken].view(np.int64)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(length[filled])]).astype(np.int32), pa.array(tokens))
                early = pa.array((n - -(-2 * similar * n // (100 + similar)) + 1)[filled], pa.int64())
                parity = pa.array([_parity(values[at[k] : at[k + 1]]) for k in filled], pa.binary())
                yield pa.RecordBatch.from_arrays([_node_keys(values, at).take(pa.array(filled)), pa.array(n[filled], pa.int64()), lists, early, parity], ["node", "n", "tokens", "early", "parity"])

    found = docs.select(_text(text_col).alias("text")).mapInArrow(run, "node binary, n long, tokens array<bigint>, early long, parity binary")
    return written(found.dropDuplicates(["node"]), "join-prefixes")


def _bits_of(keys: pa.Array) -> np.ndarray:
    """Place of every key (a node's, or a shingle's hash) in a bitmap; keys must not be null."""
    if pa.types.is_integer(keys.type):
        return mix64(keys.to_numpy(zero_copy_only=False).view(np.uint64)) & np.uint64(FILTER - 1)
    return np.frombuffer(b"".join(keys.to_pylist()), "<u8")[::2] & np.uint64(FILTER - 1)


def _hits(bits: np.ndarray, keys: pa.Array) -> np.ndarray:
    """Whether each key's bit is set."""
    at = _bits_of(keys).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def wanted_bits(keys: DataFrame) -> np.ndarray:
    """A bitmap of ``FILTER`` bits, the same size for any number of keys, set for those of a one-column frame."""
    part = FILTER // FILTER_PARTS

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}  # the parts of the bitmap this task sets
        for batch in batches:
            at = _bits_of(batch.column(0)).astype(np.int64)
            for k in np.unique(at // part):
                own.setdefault(int(k), np.zeros(part, bool))[at[at // part == k] % part] = True
        for k, bits in own.items():
            set_ = np.flatnonzero(bits).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(set_), k, np.int32)), pa.array(set_)], ["part", "bit"])

    def collect(key: tuple, table: pa.Table) -> pa.Table:
        bits = np.zeros(part, bool)
        bits[table.column("bit").to_numpy()] = True
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": [np.packbits(bits).tobytes()]})

    blobs = keys.mapInArrow(places, "part int, bit int").groupBy("part").applyInArrow(collect, "part int, bits binary").collect()
    out = np.zeros(FILTER // 8, np.uint8)
    for row in blobs:
        out[row["part"] * part // 8 : (row["part"] + 1) * part // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def likely(frame: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``frame`` whose first column is among ``keys`` (a one-column frame), and few others; nothing is shuffled."""
    bitmap = frame.sparkSession.sparkContext.broadcast(wanted_bits(keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(_hits(bits, batch.column(0))))

    return frame.mapInArrow(run, frame.schema)


def full_sets(docs: DataFrame, nodes: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(node, shingles): the whole set of every node of the frame ``nodes`` (node), and of few others.

    Texts stay where they are: their sets are made again, and what the bitmap of wanted nodes
    rules out goes at once, as do further copies of a node within a task; copies in other tasks stay
    in the table and go on the way to a join.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(wanted_bits(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = wanted.value, set()
        for batch in batches:
            for _, _, values, at in _sets_of(batch.column(0), shingle):
                keys = _node_keys(values, at)
                filled = np.flatnonzero(np.diff(at))
                hits = [int(k) for k in filled[_hits(bits, keys.take(pa.array(filled)))]] if len(filled) else []
                fresh = [k for k in hits if (key := keys[k].as_py()) not in seen and not seen.add(key)]
                sets = [values[at[k] : at[k + 1]].tobytes() for k in fresh]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(fresh, pa.int64())), pa.array(sets, pa.binary())], ["node", "shingles"])

    found = docs.select(_text(text_col).alias("text")).mapInArrow(run, "node binary, shingles binary")
    return written(found, "join-sets")


def _size_class(similar: int):
    """Sizes of linked sets are at most one class apart (classes are a trifle wider, for rounding)."""
    width = max(-np.log(similar / 100), 1e-3) * (1 + 1e-9)
    return F.floor(F.log("n") / width).cast("int")


def buckets(found: DataFrame, similar: int) -> DataFrame:
    """(hub, node, n, parity, members): the nodes of every hub with two members at least.

    ``hub`` is the 64-bit hash of the hub's node, which is a member itself. A node is in the
    lists of its size class and of the next, where it meets the sets one class larger.
    """
    own = F.xxhash64("node").alias("h")
    lists = found.select(own, _size_class(similar).alias("class"), "early", F.posexplode("tokens").alias("place", "token"))
    lists = lists.select("token", "h", "class", (F.col("place") < F.col("early")).alias("early"))
    several = (F.count(F.lit(1)) > 1) & F.max("early")
    shared = written(lists.groupBy("token").agg(several.alias("shared")).where("shared").select("token"), "join-shared")
    # a bitmap keeps most shingles of one set alone from the join
    kept = likely(lists, shared).join(shared, "token")
    entries = written(kept.select("token", "h", "early", F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("class")), "join-lists")
    hubs = entries.groupBy("token", "class").agg(F.min("h").alias("hub"), several.alias("shared")).where("shared").select("token", "class", "hub")
    pairs = written(entries.join(hubs, ["token", "class"]).select("hub", "h").distinct(), "join-members")
    # the thin rows are counted before parities, the most of a member, come to them
    return _counted(pairs).join(found.select(own, "node", "n", "parity"), "h").drop("h")


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of members of their hub."""
    return rows.join(rows.groupBy("hub").agg(F.count("*").alias("members")), "hub")


def _grouped(column: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of every distinct value."""
    order = np.argsort(column, kind="stable")
    edges = np.flatnonzero(np.diff(column[order])) + 1
    return iter(np.split(order, edges)) if len(order) else iter(())


def _near_classes(n: np.ndarray, parity: list[np.ndarray], similar: int) -> np.ndarray:
    """Per member the first of those that pairs of fitting size and parity join it with (itself, if none); members are in order of size."""
    label = np.arange(len(n))
    lengths = np.array([len(p) for p in parity])
    folded: dict[int, np.ndarray] = {}
    for k in range(len(n)):
        end = int(np.searchsorted(n * similar, n[k] * 100, "right"))
        if end <= k + 1:
            continue
        words = int(lengths[k])
        if words not in folded:
            # longer parities fold to this length by their halves
            folded = {words: np.zeros((len(n), words), np.uint64)}
            for j in range(k, len(n)):
                folded[words][j] = np.bitwise_xor.reduce(parity[j].reshape(-1, words))
        differ = np.bitwise_count(folded[words][k + 1 : end] ^ parity[k]).sum(1)
        near = differ <= (n[k] + n[k + 1 : end]) * (100 - similar) // (100 + similar)
        met = label[k + 1 : end][near]
        if (met != label[k]).any():
            met = np.append(met, label[k])
            label[np.isin(label, met)] = met.min()
    return label


def plausible(members: DataFrame, similar: int) -> DataFrame:
    """(hub, node, n, members): the buckets that are left where size and parity allow a link.

    Members that such pairs join stay together, under the one of smallest hash among them; so the nodes of
    a link, which share many shingles, are one bucket, whatever others held these shingles by chance.
    Buckets above ``BLOCK`` members stay as they are: there links are decided block by block.
    """
    few = members.where(F.col("members") <= BLOCK)
    bins = few.count() // BIN + 1

    def sift(table: pa.Table) -> pa.Table:
        table = table.sort_by([("hub", "ascending"), ("n", "ascending")]).combine_chunks()
        n, hub, own = (table.column(c).to_numpy() for c in ("n", "hub", "own"))
        parity = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("parity")]
        keep, least = np.zeros(len(n), bool), np.zeros(len(n), np.int64)
        for rows in _grouped(hub):
            label = _near_classes(n[rows], [parity[k] for k in rows], similar)
            keep[rows] = np.bincount(label, minlength=len(rows))[label] > 1
            low = np.full(len(rows), np.iinfo(np.int64).max)
            np.minimum.at(low, label, own[rows])
            least[rows] = low[label]
        return pa.table([pa.array(least), table.column("node"), table.column("n")], ["hub", "node", "n"]).filter(pa.array(keep))

    sifted = few.select(F.pmod("hub", F.lit(bins)).alias("bin"), "hub", "node", "n", "parity", F.xxhash64("node").alias("own")).groupBy("bin").applyInArrow(
        sift, "hub long, node binary, n long")
    left = written(sifted.unionByName(members.where(F.col("members") > BLOCK).select("hub", "node", "n")).distinct(), "join-sifted")
    return written(_counted(left), "join-buckets")


def _compared(core: np.ndarray, own: np.ndarray, similar: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """What a member lacks of its hub (places in the hub's set), what it has besides, and whether the two are linked."""
    at = np.searchsorted(core, own)
    shared = core[np.minimum(at, len(core) - 1)] == own
    missing = np.ones(len(core), bool)
    missing[at[shared]] = False
    both = int(shared.sum())
    return np.flatnonzero(missing), own[~shared], 100 * both >= similar * (len(core) + len(own) - both)


def small_links(members: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """(a, b) nodes: a spanning forest of the links within buckets of at most ``BLOCK`` members, each in one task."""
    bins = members.count() // BIN + 1
    head = (F.xxhash64("node") == F.col("hub")).alias("head")
    own = members.select(F.pmod("hub", F.lit(bins)).alias("bin"), "hub", "node", "n", head).join(sets.dropDuplicates(["node"]), "node")

    def settle(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, n, head = table.column("node").to_pylist(), table.column("n").to_numpy(), table.column("head").to_numpy().astype(bool)
        own = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("shingles")]
        a, b = [], []
        for rows in _grouped(table.column("hub").to_numpy()):
            top = rows[np.argmax(head[rows])]
            core = own[top]
            lacks, extra, linked = zip(*[_compared(core, own[k], similar) for k in rows])
            settled = np.array(linked)
            for k in rows[settled]:
                a.append(node[k])
                b.append(node[top])
            if not settled.all():
                root = _links(n[rows], len(core), [x.astype(np.uint64) for x in lacks], list(extra), settled, np.zeros(len(rows), int), similar)
                for k in np.flatnonzero(root != np.arange(len(rows))):
                    a.append(node[rows[k]])
                    b.append(node[rows[root[k]]])
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return own.groupBy("bin").applyInArrow(settle, "a binary, b binary")


def differences(members: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The hub's answers in buckets above ``BLOCK`` members: (hub, node, n, size, lacks, extra, settled).

    ``size`` is the hub's; ``lacks`` holds places in the hub's set, ``extra`` the shingles
    it has not; ``settled`` says that member and hub are linked. A bucket is spread over tasks.
    """
    parts = F.ceil(F.col("members") / BLOCK)
    sets = likely(sets, members.select("node").distinct()).dropDuplicates(["node"])
    place = F.pmod(F.xxhash64("node", F.lit(3)), parts).cast("int").alias("place")
    own = members.select("hub", "node", "n", place).join(sets, "node")
    # a hub goes to all places of its members
    each = members.where(F.xxhash64("node") == F.col("hub")).groupBy("hub", "members").agg(F.min("node").alias("node"))
    hubs = each.join(sets, "node").select("hub", F.explode(F.sequence(F.lit(0), parts.cast("int") - 1)).alias("place"), F.col("shingles").alias("core"))
    # columns of their own, apart from those of ``own``, which has the same ancestors
    hubs = hubs.select(*[F.col(c).alias(f"{c}_") for c in hubs.columns]).toDF(*hubs.columns)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        cores = {h: np.frombuffer(s, np.uint64) for h, s in zip(right.column("hub").to_pylist(), right.column("core").to_pylist())}
        size, lacks, extra, settled = [], [], [], []
        for hub, blob in zip(left.column("hub").to_pylist(), left.column("shingles")):
            missing, besides, linked = _compared(cores[hub], np.frombuffer(blob.as_buffer(), np.uint64), similar)
            size.append(len(cores[hub]))
            lacks.append(missing.astype(np.uint32).tobytes())
            extra.append(besides.tobytes())
            settled.append(linked)
        columns = [left.column(c) for c in ("hub", "node", "n")]
        return pa.table([*columns, pa.array(size, pa.int64()), pa.array(lacks, pa.binary()), pa.array(extra, pa.binary()), pa.array(settled, pa.bool_())],
                        ["hub", "node", "n", "size", "lacks", "extra", "settled"])

    out = own.groupBy("hub", "place").cogroup(hubs.groupBy("hub", "place")).applyInArrow(
        compare, "hub long, node binary, n long, size long, lacks binary, extra binary, settled boolean")
    return written(out, "join-differences")


def _shared_counts(x: list[np.ndarray], y: list[np.ndarray], same: bool) -> np.ndarray:
    """|x_i & y_j| of two lists of sorted arrays, over the values that can be shared at all."""
    out = np.zeros((len(x), len(y)), np.float32)
    flat_x, flat_y = (np.concatenate(v) if v else np.zeros(0, np.uint64) for v in (x, y))
    values, seen = np.unique(flat_x, return_counts=True)
    common = values[seen > 1] if same else np.intersect1d(values, flat_y)
    if not len(common):
        return out

    def places(flat, parts):
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        at = np.searchsorted(common, flat)
        hit = common[np.minimum(at, len(common) - 1)] == flat
        return row[hit], at[hit]

    row_x, at_x = places(flat_x, x)
    row_y, at_y = (row_x, at_x) if same else places(flat_y, y)
    for low in range(0, len(common), _COLUMNS):
        width = min(_COLUMNS, len(common) - low)
        tiles = []
        for row, at, n in ((row_x, at_x, len(x)), (row_y, at_y, len(y))):
            inside = (at >= low) & (at < low + width)
            tile = np.zeros((n, width), np.float32)
            tile[row[inside], at[inside] - low] = 1
            tiles.append(tile)
        out += tiles[0] @ tiles[1].T
    return out


def _spanning(linked: np.ndarray) -> np.ndarray:
    """The smallest row number reachable from every row of a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(label)).min(1)
        low = np.minimum(label, near)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _links(n: np.ndarray, size: int, lacks: list, extra: list, settled: np.ndarray, side: np.ndarray, similar: int) -> np.ndarray:
    """Per row of one bucket's block pair: the row it is connected with (itself, if none).

    Settled rows are linked with the hub and need no comparison with each other.
    """
    sides = [np.flatnonzero(side == 0), np.flatnonzero(side == 1)]
    same = not len(sides[1])
    if same:
        sides[1] = sides[0]
    linked = np.zeros((len(n), len(n)), bool)
    open_x, open_y = sides[0][~settled[sides[0]]], sides[1][~settled[sides[1]]]
    # open rows of one side meet the whole other side; what is left of the other's open rows meets settled ones
    for x, y in ((open_x, sides[1]), (sides[0][settled[sides[0]]], open_y)):
        if same and x is not open_x:
            break
        if not len(x) or not len(y):
            continue
        for low in range(0, len(x), 512):
            some = x[low : low + 512]
            both = _shared_counts([lacks[k] for k in some], [lacks[k] for k in y], False)
            both += _shared_counts([extra[k] for k in some], [extra[k] for k in y], False)
            held = size - np.array([len(lacks[k]) for k in some])[:, None] - np.array([len(lacks[k]) for k in y])[None, :]
            both = both.astype(np.int64) + held
            linked[np.ix_(some, y)] |= 100 * both >= similar * (n[some][:, None] + n[y][None, :] - both)
    return _spanning(linked | linked.T)


def large_links(found: DataFrame, similar: int) -> DataFrame:
    """(a, b) nodes: a spanning forest of the links within large buckets, from the frame ``differences``."""
    d, e = F.length("lacks") / 4, F.length("extra") / 8
    cell = F.xxhash64(_size_class(similar), F.floor(d * 16 / F.col("size")))
    placed = found.select("*", cell.alias("cell"), d.alias("d"), e.alias("e"))
    cells = placed.groupBy("hub", "cell").agg(F.count("*").alias("held"))
    block = F.xxhash64("cell", F.pmod(F.xxhash64("node", F.lit(11)), F.ceil(F.col("held") / BLOCK)))
    spread = written(placed.join(cells, ["hub", "cell"]).withColumn("block", block).drop("cell", "held"), "join-blocks")
    ranges = spread.groupBy("hub", "block").agg(
        *[f(c).alias(f"{name}_{c}") for c in ("n", "d", "e") for name, f in (("lo", F.min), ("hi", F.max))], F.min("settled").alias("done"))
    left, right = (ranges.select("hub", *[F.col(c).alias(f"{s}_{c}") for c in ranges.columns if c != "hub"]) for s in "xy")
    gap = lambda c: F.greatest(F.col(f"x_lo_{c}") - F.col(f"y_hi_{c}"), F.col(f"y_lo_{c}") - F.col(f"x_hi_{c}"), F.lit(0))
    # |y - z| + |z - y| is at least the gaps in what is lacking and in what is extra
    room = (F.col("x_hi_n") + F.col("y_hi_n")) * (100 - similar) / (100 + similar)
    able = (F.greatest("x_lo_n", "y_lo_n") * similar <= F.least("x_hi_n", "y_hi_n") * 100) & (gap("d") + gap("e") <= room)
    met = left.join(right, "hub").where("x_block <= y_block AND NOT (x_done AND y_done)").where(able)
    met = met.select("hub", F.col("x_block").alias("i"), F.col("y_block").alias("j"))
    columns = ["i", "j", "hub", "node", "n", "size", "lacks", "extra", "settled", "side"]
    rows = spread.withColumnRenamed("block", "i").join(met, ["hub", "i"]).withColumn("side", F.lit(0)).select(*columns).unionByName(
        spread.withColumnRenamed("block", "j").join(met.where("i <> j"), ["hub", "j"]).withColumn("side", F.lit(1)).select(*columns))

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        hub, n, size, side = (table.column(c).to_numpy() for c in ("hub", "n", "size", "side"))
        settled = table.column("settled").to_numpy().astype(bool)
        lacks = [np.frombuffer(v.as_buffer(), np.uint32).astype(np.uint64) for v in table.column("lacks")]
        extra = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("extra")]
        a, b = [], []
        for rows in _grouped(hub):
            if len(rows) > 1 and not settled[rows].all():
                root = _links(n[rows], int(size[rows[0]]), [lacks[k] for k in rows], [extra[k] for k in rows], settled[rows], side[rows], similar)
                moved = np.flatnonzero(root != np.arange(len(rows)))
                a.append(rows[moved])
                b.append(rows[root[moved]])
        node = table.column("node")
        pick = lambda parts: node.take(pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))
        return pa.table([pick(a), pick(b)], ["a", "b"])

    others = rows.groupBy("hub", "i", "j").applyInArrow(meet, "a binary, b binary")
    heads = found.where(F.xxhash64("node") == F.col("hub")).groupBy("hub").agg(F.min("node").alias("b"))
    to_hub = found.where("settled").join(heads, "hub").select(F.col("node").alias("a"), "b")
    return to_hub.unionByName(others)


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """Per input row: id, n_shingles, component_id.

    A set holds the distinct runs of ``shingle`` words (A-Z lower-cased; all words, if fewer).
    Rows whose sets have 100 * |intersection| >= ``similar`` * |union| are linked, and
    ``component_id`` is the smallest id reachable. Null, empty and blank texts have an empty set,
    are linked with nothing and keep their own id. A null id sorts above all others: it names a
    component only where no row has an id. Rows that share an id stay rows of their own. Extra
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    rows, sketch = set_rows(docs, id_col, text_col, shingle)
    found = written(buckets(prefixes(docs, sketch, text_col, shingle, similar), similar), "join-candidates")
    members = plausible(found, similar)
    sets = full_sets(docs, members.select("node").distinct(), text_col, shingle)
    few, crowds = members.where(F.col("members") <= BLOCK), members.where(F.col("members") > BLOCK)
    found = small_links(few, sets, similar)
    if not crowds.isEmpty():
        found = found.unionByName(large_links(differences(crowds, sets, similar), similar))
    label = components(found)
    named = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least")).join(label, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    out = rows.join(named.join(first, "component").select("node", "component_id"), "node", "left")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
