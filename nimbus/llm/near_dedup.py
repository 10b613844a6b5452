"""MinHash near-deduplication with SetSketch registers.

A document's set holds its distinct n-word shingles. Its sketch has ``REGISTERS``
values: the minimum of an exponential hash over the set, kept as its exponent in
powers of ``BASE`` (an exponentially spaced truncated minimum). Sketches merge by
maximum, and similar sets agree in most registers. Runs of ``ROWS`` registers
form a band; documents that share a band are candidates. A candidate pair's
similarity is first estimated from all registers by maximum likelihood, and
confirmed on the full sets.

Documents with the same set are one node. In each round every band group links
its members to one pivot only (another one each round), and only where they are not in one component
already, so no round makes more pairs than there are band rows. After ``PIVOTS``
rounds the groups that still hold several components compare members across
components inside tasks (small groups whole, large ones block against block), without
making the pairs as rows, so that no link between different texts is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from nimbus.llm.common import buffer_chunks, columns_of, mix64, row_key, with_row_key, word_hashes, written

SHINGLE, SIMILAR = 2, 80
BANDS, ROWS, BASE = 40, 6, 1.02
REGISTERS = BANDS * ROWS
PIVOTS = 3
#: Estimates below this are not compared in full: five standard errors of the estimate under 0.8.
LEAST_ESTIMATE = 0.66
#: Band groups up to this size compare what is left whole, larger ones in blocks of this size.
SMALL = 128
#: Members of small groups that share a task.
BIN = 30_000
#: Edges of a file while components are found.
EDGES = 200_000
_STEP = 1 << 15
_rng = np.random.default_rng(77)
_SEEDS = _rng.integers(0, 2**32, REGISTERS, dtype=np.uint32)
_FACTORS = _rng.integers(0, 2**32, REGISTERS, dtype=np.uint32) | np.uint32(1)


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every row's word n-grams (with fewer words, of all its words), and row offsets."""
    counts = np.diff(offsets)
    made = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out_at = np.concatenate([[0], np.cumsum(made)])
    owner = np.repeat(np.arange(len(counts)), made)
    first = offsets[owner] + np.arange(out_at[-1]) - out_at[owner]
    used = np.minimum(counts[owner], n)
    out = np.zeros(len(first), np.uint64)
    for j in range(n):
        has = used > j
        word = hashes[np.where(has, first + j, 0)] if len(hashes) else out
        out = np.where(has, mix64(out * np.uint64(0x9FB21C651E98DF25) + word + np.uint64(j + 1)), out)
    return out, out_at


def distinct_sets(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every row, and row offsets."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(offsets)))


def sketch(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, REGISTERS) uint16: the exponents of the truncated minima; empty sets are zeros.

    Register i hashes by a multiplier of its own; -log(1 - u) turns the smallest
    uniform hash into the smallest exponential one, so one minimum per register is
    enough. Values go through in blocks that stay in the processor's cache.
    """
    rows = len(offsets) - 1
    least = np.full((rows, REGISTERS), np.uint32(0xFFFFFFFF))
    small = (values >> np.uint64(32)).astype(np.uint32)
    at = 0
    while at < len(small):
        end = min(at + _STEP, len(small))
        first = int(np.searchsorted(offsets, at, "right")) - 1
        last = int(np.searchsorted(offsets, end, "left"))
        local = np.maximum(offsets[first:last], at) - at
        filled = np.flatnonzero(np.diff(np.append(local, end - at)) > 0)
        block = small[at:end]
        for i in range(REGISTERS):
            found = np.minimum.reduceat((block ^ _SEEDS[i]) * _FACTORS[i], local[filled])
            np.minimum(least[first + filled, i], found, out=found)
            least[first + filled, i] = found
        at = end
    uniform = (least.astype(np.float64) + 0.5) / 2**32
    exponent = np.floor(1 - np.log(-np.log1p(-uniform)) / np.log(BASE))
    out = np.clip(exponent + 2**9, 0, 65535).astype(np.uint16)
    out[np.diff(offsets) == 0] = 0
    return out


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard index of sketch rows, given the set sizes.

    A register is larger, smaller or equal with probabilities that the index and
    the two shares of the joint size fix; the best of a grid of indexes is taken.
    """
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u
    top = np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    best, value = np.full(len(a), -np.inf), np.zeros(len(a))
    for share in np.linspace(0, 1, 101):
        j = top * share
        up, down = p(u - v * j), p(v - u * j)
        stay = np.maximum(1 - up - down, 1e-12)
        likely = more * np.log(np.maximum(up, 1e-12)) + less * np.log(np.maximum(down, 1e-12)) + same * np.log(stay)
        value = np.where(likely > best, j, value)
        best = np.maximum(best, likely)
    return value


def _sets_of(column, shingle: int):
    for first, end, data, offsets in buffer_chunks(column, 1 << 19):
        words, at = word_hashes(data, offsets)
        yield first, end, *distinct_sets(*shingles(words, at, shingle))


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """Per row: id, row, node (hash of its set), n (set size), registers (null for an empty set)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), row_key(docs).alias("row"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, values, at in _sets_of(batch.column(2), shingle):
                registers = sketch(values, at)
                n = np.diff(at)
                filled = np.flatnonzero(n)
                node = np.zeros(end - first, np.uint64)
                # order-free sum of mixed values: the same set gives the same node
                mixed = np.concatenate([[0], np.cumsum(mix64(values ^ np.uint64(0xA5A5A5A5DEADBEEF)))]).astype(np.uint64)
                node[filled] = mix64((mixed[at[1:]] - mixed[at[:-1]])[filled] + n[filled].astype(np.uint64))
                blobs = [registers[k].tobytes() if n[k] else None for k in range(end - first)]
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(node.view(np.int64)), pa.array(n, pa.int64()), pa.array(blobs, pa.binary())],
                    ["id", "row", "node", "n", "registers"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, row string, node long, n long, registers binary")


def full_sets(docs: DataFrame, wanted: DataFrame, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(node, shingles) of a frame ``wanted`` (row, node): one row's whole set per node."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(row_key(docs).alias("row"), text.alias("text")).join(wanted, "row").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, values, at in _sets_of(batch.column(1), shingle):
                sets = [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(sets, pa.binary())], ["node", "shingles"])

    return rows.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The (a, b) pairs whose sizes allow the similarity and whose estimate comes near it."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    both = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * SIMILAR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
                near = estimate(x, y, part.column("na").to_numpy().astype(float), part.column("nb").to_numpy().astype(float)) >= LEAST_ESTIMATE
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(near))

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with 100 * |intersection| >= SIMILAR * |union| on their full sets."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(sa.as_buffer(), np.uint64), np.frombuffer(sb.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= SIMILAR * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def linked_in_blocks(open_: DataFrame, sizes: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (a, b) between components within large band groups, without making their pairs.

    A group's members, and apart from them those outside its largest component, are dealt into
    blocks of about ``SMALL``; every block of the former meets every block of the latter in one
    task. There pairs are estimated at once from their registers, each in its first shared band
    only, and the likely ones confirmed on the full sets. Only links leave the task.
    """
    loaded = open_.join(sizes, "key").join(nodes.select("node", "n", "registers"), "node").join(sets, "node")
    blocks = F.ceil(F.col("size") / SMALL).cast("int")
    others = F.greatest(F.lit(1), F.ceil((F.col("size") - F.col("most.n")) / SMALL).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    deal = lambda n: F.pmod(F.xxhash64("node", F.lit(5)), n).cast("int")
    columns = ("key", "i", "j", "node", "component", "band", "n", "registers", "shingles")
    left = loaded.withColumn("i", deal(blocks)).withColumn("j", every(others)).select(*[F.col(c).alias(c + "_") for c in columns]).toDF(*columns)
    right = loaded.where("component <> most.component").withColumn("j", deal(others)).withColumn("i", every(blocks)).select(*[F.col(c).alias(c + "_") for c in columns]).toDF(*columns)

    def meet(x, y):
        nodes_x, nodes_y, home_x, home_y, size_x, size_y = (t.column(c).to_numpy() for c in ("node", "component", "n") for t in (x, y))
        sketch_x, sketch_y = (np.frombuffer(b"".join(t.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS) for t in (x, y))
        sets_x, sets_y = ([np.frombuffer(v, np.uint64) for v in t.column("shingles").to_pylist()] for t in (x, y))
        links = []
        for k in range(len(nodes_y)):
            near = np.flatnonzero((home_x != home_y[k]) & (np.minimum(size_x, size_y[k]) * 100 >= np.maximum(size_x, size_y[k]) * SIMILAR))
            if not len(near):
                continue
            band = y.column("band")[0].as_py()
            equal = sketch_x[near] == sketch_y[k]
            near = near[equal.reshape(len(near), BANDS, ROWS).all(2).argmax(1) == band]
            if not len(near):
                continue
            one = np.broadcast_to(sketch_y[k], (len(near), REGISTERS))
            near = near[estimate(sketch_x[near], one, size_x[near].astype(float), np.full(len(near), float(size_y[k]))) >= LEAST_ESTIMATE]
            for i in near:
                both = len(np.intersect1d(sets_x[i], sets_y[k], assume_unique=True))
                if 100 * both >= SIMILAR * (len(sets_x[i]) + len(sets_y[k]) - both):
                    links.append((int(nodes_x[i]), int(nodes_y[k])))
        return pa.table([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])

    return left.groupBy("key", "i", "j").cogroup(right.groupBy("key", "i", "j")).applyInArrow(meet, "a long, b long")


def _near_links(rows: np.ndarray, others: np.ndarray, home: np.ndarray, band: int, size: np.ndarray, sketches_: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """The links (row, other) between components, each pair in its first shared band only."""
    links = []
    for k in rows:
        near = others[(home[others] != home[k]) & (np.minimum(size[others], size[k]) * 100 >= np.maximum(size[others], size[k]) * SIMILAR)]
        if len(near):
            equal = sketches_[near] == sketches_[k]
            near = near[equal.reshape(len(near), BANDS, ROWS).all(2).argmax(1) == band]
        if len(near):
            one = np.broadcast_to(sketches_[k], (len(near), REGISTERS))
            near = near[estimate(sketches_[near], one, size[near].astype(float), np.full(len(near), float(size[k]))) >= LEAST_ESTIMATE]
        for i in near:
            both = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if 100 * both >= SIMILAR * (len(sets[i]) + len(sets[k]) - both):
                links.append((int(k), int(i)))
    return links


def linked_in_bins(few: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (a, b) between components within small band groups, without making their pairs.

    Groups are dealt into bins of about ``BIN`` members; a node comes into a bin once, however
    many of its groups are there, with its registers and its full set. Only links leave the task.
    """
    bins = max(1, few.count() // BIN + 1)
    members = few.select(F.pmod("key", F.lit(bins)).alias("bin"), "key", "node", "component", "band")
    data = members.select("bin", "node").distinct().join(nodes.select("node", "n", "registers"), "node").join(sets, "node")
    # columns of their own, apart from those of ``members``, which has the same ancestors
    data = data.select(*[F.col(c).alias(c + "_") for c in data.columns]).toDF(*data.columns)

    def meet(groups: pa.Table, held: pa.Table) -> pa.Table:
        known = held.column("node").to_numpy()
        order = np.argsort(known)
        known, held = known[order], held.take(pa.array(order)).combine_chunks()
        size = held.column("n").to_numpy()
        sketches_ = np.frombuffer(b"".join(held.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        full = [np.frombuffer(v.as_buffer(), np.uint64) for v in held.column("shingles")]
        at = np.searchsorted(known, groups.column("node").to_numpy())
        key, component, band = (groups.column(c).to_numpy() for c in ("key", "component", "band"))
        home = np.zeros(len(known), np.int64)
        home[at] = component
        by_key = np.argsort(key, kind="stable")
        links = []
        for rows in np.split(by_key, np.flatnonzero(np.diff(key[by_key])) + 1) if len(by_key) else ():
            inside = at[rows]
            for j in range(1, len(inside)):
                links += _near_links(inside[j : j + 1], inside[:j], home, int(band[rows[0]]), size, sketches_, full)
        return pa.table([pa.array([known[a] for a, _ in links], pa.int64()), pa.array([known[b] for _, b in links], pa.int64())], ["a", "b"])

    return members.groupBy("bin").cogroup(data.groupBy("bin")).applyInArrow(meet, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of a frame of links (a, b): the smallest node reachable from each.

    Alternates large stars and small stars: every node hands its larger, then its smaller,
    neighbours to the smallest one it sees, until nothing changes. Each step is partially
    aggregated, so a node with very many links is no hot spot.
    """
    def step(df: DataFrame, parts: int | None) -> tuple[DataFrame, tuple]:
        """Written edges, in few files once few are left, with their number and checksum."""
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
        out = written(df if parts is None else df.coalesce(parts), "edges")
        return out, (seen.get["n"], seen.get["sum"])

    edges, state = step(links.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), None)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select("v", "m").distinct()  # v keeps a link to the smallest around u
        small = large.where("v <> m").groupBy("v").agg(F.min("m").alias("least"))
        star = large.where("v <> m").join(small, "v")
        joined = star.select(F.col("least").alias("u"), "v").unionByName(star.where("m <> least").select(F.col("least").alias("u"), F.col("m").alias("v")))
        edges, now = step(joined.distinct(), state[0] // EDGES + 1)
        if now == state:
            break
        state = now
    roots = edges.select("u").distinct().select(F.col("u").alias("node"), F.col("u").alias("component"))
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots.join(edges.select(F.col("v").alias("node")), "node", "left_anti"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per input row: id, row, n_shingles, component_id, kept, top_row, repeats.

    A set holds the runs of ``shingle`` words. Rows whose sets have 100 * |intersection| >= 80 * |union| are linked; ``component_id`` is the
    smallest id reachable and ``kept`` marks its row. Rows without words (null, empty, blank)
    have an empty set and are linked with nothing. Null ids sort above all others, so they are
    kept only where no row of the component has an id. Of rows that share the smallest id the one
    with the smallest row hash (``top_row``) stands; ``repeats`` counts rows equal to it in every
    column.
    """
    rows = written(sketches(docs, id_col, text_col, shingle), "sketches")
    nodes = written(rows.where("n > 0").groupBy("node").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("registers").alias("registers")), "nodes")
    width = 2 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("registers", k * width + 1, width)) for k in range(BANDS)])
    bands = nodes.select("node", F.posexplode(keys).alias("band", "key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    bands = written(bands.join(shared, "key"), "bands")
    # the full sets of every node that shares a band are made once
    wanted = bands.select("node").distinct().join(nodes.select("node", "row"), "node")
    sets = written(full_sets(docs, wanted, text_col, shingle), "sets")
    labels = written(bands.select("node").distinct().withColumn("component", F.col("node")), "labels")
    for turn in range(PIVOTS + 1):
        members = bands.join(labels, "node")
        # at first the same pivot in as many groups as possible, then another one in each
        draw = F.xxhash64("node", F.lit(turn)) if turn == 0 else F.xxhash64("node", "key", F.lit(turn))
        groups = written(members.groupBy("key").agg(
            F.min(F.struct(draw, "node", "component")).alias("p"), F.min("component").alias("lo"), F.max("component").alias("hi")
        ).where("lo < hi"), "groups")
        if groups.isEmpty():
            break
        if turn < PIVOTS:
            met = members.join(groups.select("key", F.col("p.node").alias("pivot"), F.col("p.component").alias("home")), "key").where("component <> home")
            pairs = met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        else:
            # what is left: members of different components within one group, compared inside tasks
            open_ = written(members.join(groups.select("key"), "key"), "open")
            sizes = written(open_.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(
                F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("most")), "sizes")
            small = open_.join(sizes.where(F.col("size") <= SMALL).select("key"), "key")
            crowd = linked_in_blocks(open_, sizes.where(F.col("size") > SMALL), nodes, sets)
        found = confirmed(likely(pairs.distinct(), nodes), sets) if turn < PIVOTS else linked_in_bins(small, nodes, sets).unionByName(crowd)
        found = written(found, "links")
        if found.isEmpty():
            continue
        # only what the links join anew: components of components
        ends = [labels.select(F.col("node").alias(c), F.col("component").alias(f"home_{c}")) for c in ("a", "b")]
        anew = found.join(ends[0], "a").join(ends[1], "b").select(F.col("home_a").alias("a"), F.col("home_b").alias("b"))
        moved = components(anew).select(F.col("node").alias("component"), F.col("component").alias("to"))
        labels = written(labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
    tagged = rows.drop("registers").join(labels.where("component IS NOT NULL"), "node", "left")
    # documents without words stand alone, as do sets that share no band
    group = F.when(F.col("n") == 0, F.xxhash64("row", F.lit("alone"))).otherwise(F.coalesce("component", "node"))
    tagged = written(tagged.select("id", "row", "n", group.alias("component"), (F.col("n") == 0).alias("blank")), "tagged")
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")
    heads = tagged.groupBy("component", "blank").agg(F.min(order).alias("head"), F.count("*").alias("members"))
    same = tagged.groupBy("component", "blank", "id", "row").agg(F.count("*").alias("repeats"))
    heads = heads.where("members > 1").alias("h").join(
        same.alias("s"), (F.col("h.component") == F.col("s.component")) & (F.col("h.blank") == F.col("s.blank")) & F.col("h.head.id").eqNullSafe(F.col("s.id")) & (F.col("h.head.row") == F.col("s.row"))
    ).select("h.component", "h.blank", "h.head", "s.repeats")
    out = tagged.join(heads, ["component", "blank"], "left")
    alone = F.col("head").isNull() | F.col("blank")
    return out.select(
        F.col("id").alias(id_col), "row", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
        (alone | (F.col("id").eqNullSafe(F.col("head.id")) & (F.col("row") == F.col("head.row")))).alias("kept"),
        F.when(alone, F.col("row")).otherwise(F.col("head.row")).alias("top_row"),
        F.when(F.col("blank"), F.lit(1)).otherwise(F.coalesce("repeats", F.lit(1))).cast("long").alias("repeats"),
    )


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, columns as they were."""
    verdict = near_duplicates(docs, id_col, text_col, shingle)
    gone = verdict.where("NOT kept").select("row").distinct()
    same = verdict.where("kept AND repeats > 1").select("row").distinct()
    rows, key = with_row_key(docs)
    once = rows.join(same.withColumnRenamed("row", key), key, "left_semi").dropDuplicates([key])
    drop = gone.unionByName(same).withColumnRenamed("row", key)
    return rows.join(drop, key, "left_anti").unionByName(once).select(*columns_of(docs))
