"""Chunks, embeddings and top-k similarity search.

* Chunking (V1) is a narrow ``explode``: no shuffle, whole texts.
* Embeddings (V2) are a caller hook (a pandas UDF returning array<float>); built in
  are hashed term counts, L2-normalised, computed in the JVM, and the same with a
  digest any SQL engine has.
* Top-k (V3-V5): queries and items are dealt into blocks of bounded size and every
  block of queries meets every block of items in one task (with ``on``, only the rows
  of one metadata value meet). A task multiplies the two matrices and keeps the best k
  per query, so each ships at most k rows per query, whatever the index size, and
  neither side passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbus.session import materialised

DEFAULT_CHUNK_TOKENS = 256
DEFAULT_OVERLAP = 20
DEFAULT_MAX_BROADCAST_QUERIES = 20_000
#: Queries and items of a block at most: what one task of a search holds.
QUERY_BLOCK, ITEM_BLOCK = 16_384, 65_536
#: Numbers in the vectors of a block at most (32 MB of doubles): long vectors make smaller blocks.
BLOCK_VALUES = 1 << 22
#: Queries and items whose scores a task holds at once.
QUERY_TILE, ITEM_TILE = 1_024, 2_048
#: Texts and characters of a step of ``embed_digest``: what a task hashes at once.
TEXTS_STEP, CHARS_STEP = 1_024, 1 << 21


def tokens(text: Column | str) -> Column:
    """White-space tokens of a text (native split; the empty pieces a leading or
    trailing blank leaves are removed with ``array_remove``, no lambda)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(c, r"\s+"), "")


def chunk_text(df: DataFrame, text: str = "text", size: int = DEFAULT_CHUNK_TOKENS,
               overlap: int = DEFAULT_OVERLAP, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """V1: split each text into chunks of at most ``size`` white-space tokens,
    consecutive chunks sharing ``overlap`` tokens. A chunk starts every
    ``size - overlap`` tokens while new tokens remain, so no chunk lies wholly
    inside the one before. Output: ``keep`` columns, ``chunk_no``, ``n_tokens``,
    ``chunk`` (tokens joined by one blank)."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap
    exploded = df.select(*keep, tokens(text).alias("_toks")).where(F.size("_toks") > 0).select(
        *keep, "_toks", F.posexplode(F.sequence(F.lit(0), F.greatest(F.size("_toks") - overlap - 1, F.lit(0)), F.lit(step))).alias("chunk_no", "_start")
    )
    piece = F.slice("_toks", F.col("_start") + 1, size)
    return exploded.select(
        *keep, "chunk_no", F.size(piece).alias("n_tokens"), F.array_join(piece, " ").alias("chunk")
    )


def embed_hash(df: DataFrame, text: str = "text", dim: int = 256, out: str = "embedding") -> DataFrame:
    """V2 built-in: hashed lower-cased term counts, L2-normalised, as array<float>.
    JVM-side (``HashingTF`` + ``Normalizer``), so no Python worker runs."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    tmp = df.withColumn("_toks", tokens(F.lower(F.col(text))))
    tf = HashingTF(inputCol="_toks", outputCol="_tf", numFeatures=dim).transform(tmp)
    nv = Normalizer(inputCol="_tf", outputCol="_nv", p=2.0).transform(tf)
    return nv.withColumn(out, vector_to_array("_nv", "float32")).drop("_toks", "_tf", "_nv")


def embed_digest(df: DataFrame, text: str = "text", dim: int = 256, out: str = "embedding") -> DataFrame:
    """V2 built-in: like ``embed_hash``, but a term's place is the first 32 bits of its MD5
    modulo ``dim``, which every SQL engine can compute. A batch goes through in steps of bounded
    size, each of which hashes its distinct terms once. A null text has the zero vector. Components are double."""
    # one string per text: its terms do not leave Arrow, and no term holds a blank
    terms = F.coalesce(F.array_join(tokens(F.lower(F.col(text))), " "), F.lit(""))

    @F.pandas_udf("array<double>")
    def place(texts: pd.Series) -> pd.Series:
        rows: list[np.ndarray] = []
        for some in _steps(texts):
            rows.extend(_digest_rows(some, dim))
        return pd.Series(rows, dtype=object)

    return df.withColumn(out, place(terms))


def _steps(texts: pd.Series):
    """The texts in order, a bounded number of texts and (but for a longer single text) characters at a time."""
    ends = np.cumsum(texts.str.len().to_numpy(np.int64)) if len(texts) else np.zeros(0, np.int64)
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = int(np.searchsorted(ends, before + CHARS_STEP, "right"))
        end = min(max(end, at + 1), at + TEXTS_STEP)
        yield texts.iloc[at:end]
        at = end


def _digest_rows(texts: pd.Series, dim: int) -> np.ndarray:
    """(texts, dim): the unit rows of ``embed_digest``, of terms joined by one blank."""
    lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    coded = pc.dictionary_encode(lists.flatten())
    names = coded.dictionary.to_pylist()
    at = np.array([int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dim for t in names], dtype=np.int64)
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    which = coded.indices.to_numpy(zero_copy_only=False)
    # the one empty piece of a text without terms
    held = np.array([bool(t) for t in names], dtype=bool)[which]
    rows = np.bincount(owner[held] * dim + at[which[held]], minlength=len(texts) * dim).reshape(len(texts), dim).astype(np.float64)
    size = np.sqrt((rows**2).sum(1, keepdims=True))
    return rows / np.where(size == 0, 1, size)


def embed(df: DataFrame, fn: Callable | None = None, text: str = "text", out: str = "embedding") -> DataFrame:
    """V2 hook: ``fn`` is a pandas UDF (Series[str] -> Series[list[float]]), e.g. a
    model client; without it the built-in hashed embedding is used."""
    if fn is None:
        return embed_hash(df, text, out=out)
    return df.withColumn(out, fn(F.col(text)))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two equal-length numeric arrays, in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))


def unit(a: Column) -> Column:
    """The vector scaled to length 1 (elements null for a zero vector)."""
    n = norm(a)
    return F.transform(a, lambda v: F.try_divide(v.cast("double"), n))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector has zero length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def centroids(df: DataFrame, key: str, vec: str = "embedding", out: str = "embedding") -> DataFrame:
    """Element-wise mean vector per key (partial aggregation on (key, position))."""
    pos = df.select(key, F.posexplode(vec).alias("pos", "x")).groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return pos.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias(out)
    )


def _as_matrix(vectors) -> np.ndarray:
    """Array column values of one Arrow batch -> float64 matrix of unit rows
    (rows of a zero vector become NaN and never rank)."""
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    with np.errstate(invalid="ignore", divide="ignore"):
        return m / np.linalg.norm(m, axis=1, keepdims=True)


def _unit_rows(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers with a usable vector (no null in it, not all zero) and their unit rows."""
    lists = table.column(column).combine_chunks()
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes > 0)
    if not len(rows):
        return rows, np.zeros((0, 0))
    matrix = _as_matrix([np.array(lists[int(k)].as_py(), dtype=np.float64) for k in rows]) if len(set(sizes[rows])) > 1 else None
    if matrix is None:
        flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        with np.errstate(invalid="ignore", divide="ignore"):
            matrix = flat.reshape(len(rows), -1)
            matrix = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    usable = np.isfinite(matrix).all(1)
    return rows[usable], matrix[usable]


def _alike(vectors: np.ndarray) -> np.ndarray:
    """An order in which rows with the same places other than zero stand together."""
    there = vectors != 0
    often = np.ascontiguousarray(np.packbits(there[:, np.argsort(-there.sum(0), kind="stable")], axis=1))
    return np.argsort(often.view(f"S{often.shape[1]}")[:, 0], kind="stable") if often.size else np.arange(len(vectors))


def _better(score: np.ndarray, q: np.ndarray, x: np.ndarray, sims: np.ndarray, k: int, digits: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, similarity) of a tile's pairs that may enter the rows' best ``k``, of which
    ``score`` has those so far (-inf: none). The tile's items come after all before it, so an
    equal score does not enter.

    ``q`` and ``x`` (one column an item) are unit vectors and ``sims`` their products in single precision,
    which only choose: what may enter by them, give or take their error, is computed in double."""
    least = score[:, -1]
    slack = 0.0 if digits is None else 10.0**-digits
    wrong = (q.shape[1] + 4) * 2.0**-23
    # what rounds to more than the bound, which is rounded
    bound = least + 0.4 * slack - wrong
    width = sims.shape[1]
    if width > 2 * k and np.isinf(least).any():
        # no bound yet: the k-th of the largest of 2 k parts of the tile is one
        part = width // (2 * k)
        tops = sims[:, : 2 * k * part].reshape(len(sims), 2 * k, part).max(2)
        bound = np.maximum(bound, np.partition(tops, k, axis=1)[:, k].astype(np.float64) - 2 * wrong - slack)
    some = np.flatnonzero(sims.max(1) > bound)
    # in single precision, and not above the bound by that
    bound = np.nextafter(bound[some].astype(np.float32), np.float32(-np.inf))
    near = sims[some] > bound[:, None]
    at = np.flatnonzero(near)
    row, column = some[at // width], at % width
    # pair by pair, unless their vectors are more numbers than the tile's scores
    found = np.einsum("ij,ij->i", q[row], x.T[column]) if len(at) * q.shape[1] <= near.size else (q[some] @ x).reshape(-1)[at]
    if digits is not None:
        found = np.round(found, digits)
    enters = found > least[row]
    return row[enters], column[enters], found[enters]


def block_scorer(k: int, qid: str, iid: str, qvec: str, ivec: str, digits: int | None):
    """cogroup body: a block of queries against a block of items, the best ``k`` items per
    query (cosine, ties to the smaller item id). Items and queries go through in tiles, so that
    beside the two blocks only a tile's scores and the best so far are held. Queries with the same
    places other than zero stand together: a tile is multiplied only where any of its queries is not zero."""

    def meet(queries: pa.Table, items: pa.Table) -> pa.Table:
        asked, q = _unit_rows(queries, qvec) if len(queries) and len(items) else (np.zeros(0, int), np.zeros((0, 0)))
        alike = _alike(q) if len(asked) else np.zeros(0, int)
        asked, q = asked[alike], q[alike] if len(asked) else q
        order = pc.sort_indices(items, sort_keys=[(iid, "ascending")]).to_numpy() if len(asked) and k > 0 else np.zeros(0, int)
        score, place = np.full((len(asked), k), -np.inf), np.full((len(asked), k), -1, np.int64)
        vectors = items.column(ivec)
        tiles = [(first, min(first + QUERY_TILE, len(asked))) for first in range(0, len(asked), QUERY_TILE)]
        places = [np.flatnonzero((q[first:last] != 0).any(0)) for first, last in tiles]
        for low in range(0, len(order), ITEM_TILE):
            some = order[low : low + ITEM_TILE]
            rows, x = _unit_rows(pa.table({ivec: vectors.take(pa.array(some))}), ivec)
            if not len(rows):
                continue
            if x.shape[1] != q.shape[1]:
                raise ValueError(f"vectors of {q.shape[1]} and of {x.shape[1]} numbers")
            x = np.ascontiguousarray(x.T)
            single = x.astype(np.float32)
            for (first, last), there in zip(tiles, places):
                some_q, some_x = q[first:last][:, there], x[there]
                row, column, found = _better(score[first:last], some_q, some_x, some_q.astype(np.float32) @ single[there], k, digits)
                if not len(row):
                    continue
                # the best k of those so far and the new ones; earlier items stand first
                hit, own = np.unique(row, return_inverse=True)
                held_score, held_place = score[first + hit], place[first + hit]
                owner = np.concatenate([np.repeat(np.arange(len(hit)), k), own])
                every = np.concatenate([held_score.reshape(-1), found])
                at = np.concatenate([held_place.reshape(-1), low + rows[column]])
                best = np.lexsort((at, -every, owner))
                starts = np.searchsorted(owner[best], np.arange(len(hit)))
                best = best[starts[:, None] + np.arange(k)]
                score[first + hit], place[first + hit] = every[best], at[best]
        query, rank = np.nonzero(place >= 0)
        which = pa.array(asked[query].astype(np.int64))
        found = pa.array(order[place[query, rank]].astype(np.int64))
        return pa.table([queries.column(qid).take(which), items.column(iid).take(found), pa.array(score[query, rank])], [qid, iid, "similarity"])

    return meet


def block_rows(dim: int | None) -> int:
    """Vectors of ``dim`` numbers that a block holds at most."""
    return max(1, BLOCK_VALUES // max(1, dim or 1))


def ranked(scored: DataFrame, k: int, qid: str, iid: str) -> DataFrame:
    """The best ``k`` per query of (qid, iid, similarity); row_number's limit runs before the shuffle."""
    w = Window.partitionBy(qid).orderBy(F.desc("similarity"), F.asc(iid))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(qid, "rank", iid, "similarity")


def own_columns(df: DataFrame) -> DataFrame:
    """The same columns as new attributes, so that a cogroup of two frames of one source is not ambiguous."""
    return df.select(*[F.col(f"`{c}`").alias(f"_own_{k}") for k, c in enumerate(df.columns)]).toDF(*df.columns)


def top_k(queries: DataFrame, index: DataFrame, k: int, qid: str = "qid", iid: str = "item_id",
          qvec: str = "q_embedding", ivec: str = "embedding", on: str | None = None, digits: int | None = 9,
          method: str = "numpy", query_block: int = QUERY_BLOCK, item_block: int = ITEM_BLOCK,
          max_broadcast_queries: int = DEFAULT_MAX_BROADCAST_QUERIES) -> DataFrame:
    """V3 (+ V4 with ``on``): for each query the ``k`` most similar index items
    (cosine). ``on`` names a metadata column on both sides; only items with an
    equal value are candidates, and only they meet. Ties go to the smaller item id. Output:
    ``qid, rank, iid, similarity``.

    ``method='numpy'``: the queries are written once, both sides are dealt into blocks
    and each pair of blocks is one task (see the module). ``method='native'``: a broadcast
    join scored with Spark array expressions (no Python, but interpreted per pair), for at
    most ``max_broadcast_queries`` queries, which is checked.
    """
    if method == "native":
        if queries.limit(max_broadcast_queries + 1).count() > max_broadcast_queries:
            raise ValueError("too many queries to broadcast; use method='numpy'")
        idx = index.select(iid, unit(F.col(ivec)).alias("_iv"), *([on] if on else []))
        q = F.broadcast(queries.select(qid, unit(F.col(qvec)).alias("_qv"), *([on] if on else [])))
        pairs = idx.join(q, on=on, how="inner") if on else idx.join(q, how="inner")
        scored = pairs.select(qid, iid, dot(F.col("_qv"), F.col("_iv")).alias("similarity"))
        if digits is not None:
            scored = scored.withColumn("similarity", F.bround("similarity", digits))
        return ranked(scored.where("similarity IS NOT NULL"), k, qid, iid)
    spark = index.sparkSession
    extra = [on] if on and on != qid else []
    asked = materialised(queries.select(qid, qvec, *extra), "top-k-queries")
    held, dim = asked.agg(F.count(F.lit(1)), F.max(F.size(qvec))).first()
    most = block_rows(dim)
    query_block, item_block = min(query_block, most), min(item_block, most)
    query_blocks = max(1, -(-held // query_block))
    item_blocks = max(-(-index.count() // item_block), spark.sparkContext.defaultParallelism)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda c, v, n: F.pmod(F.xxhash64(c, v), F.lit(n)).cast("int")
    left = asked.withColumn("_qb", deal(qid, qvec, query_blocks)).withColumn("_ib", every(item_blocks))
    right = index.select(iid, ivec, *([on] if on else [])).where(F.col(ivec).isNotNull()).withColumn("_ib", deal(iid, ivec, item_blocks)).withColumn("_qb", every(query_blocks))
    if on:  # a null value equals nothing, as in a join
        left, right = left.where(F.col(on).isNotNull()), right.where(F.col(on).isNotNull())
    right = own_columns(right)
    keys = ["_qb", "_ib", *([on] if on else [])]
    types = {f.name: f.dataType.simpleString() for f in [*index.schema.fields, *queries.schema.fields]}
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        block_scorer(k, qid, iid, qvec, ivec, digits), f"{qid} {types[qid]}, {iid} {types[iid]}, similarity double")
    return ranked(scored, k, qid, iid)


def route_table(questions: DataFrame, catalog: DataFrame, qid: str = "qid", qvec: str = "q_embedding",
                table: str = "table_name", tvec: str = "embedding", k: int = 1,
                max_catalog: int = DEFAULT_MAX_BROADCAST_QUERIES, keep: tuple[str, ...] = ()) -> DataFrame:
    """V5: the ``k`` catalog entries (e.g. table descriptions' embeddings) closest
    to each question, ties to the smaller name. The catalog is broadcast after
    its size is checked; the questions stream through ``mapInPandas`` in Arrow
    batches, each batch scored against the whole catalog with one matrix
    product, so the work is linear in the number of questions and no shuffle
    is needed. A question with a zero vector gets no row. A catalog over ``max_catalog`` entries is handled exactly by
    ``top_k`` with the questions as queries."""
    rows = catalog.select(table, unit(F.col(tvec)).alias("_t")).limit(max_catalog + 1).collect()
    if len(rows) > max_catalog:
        # too large to broadcast: score the catalog as an index against the questions,
        # block by block (exact, same tie order)
        best = top_k(questions.select(qid, qvec), catalog.select(table, tvec), k, qid=qid, iid=table,
                     qvec=qvec, ivec=tvec).drop("rank")
        return best.join(questions.select(qid, *keep), qid, "left") if keep else best
    rows = sorted((r for r in rows if r["_t"] is not None and None not in r["_t"]), key=lambda r: r[table])
    names = np.array([r[table] for r in rows], dtype=object)
    bc = questions.sparkSession.sparkContext.broadcast((names, np.array([r["_t"] for r in rows], dtype=np.float64)))
    qtype = dict((f.name, f.dataType.simpleString()) for f in questions.schema.fields)[qid]
    ttype = dict((f.name, f.dataType.simpleString()) for f in catalog.schema.fields)[table]

    def run(batches):
        cat_names, cat = bc.value
        kk = min(k, len(cat_names))
        for pdf in batches:
            pdf = pdf[pdf[qvec].notna()]
            if pdf.empty or kk == 0:
                continue
            mat = _as_matrix(pdf[qvec].to_numpy())
            # a zero vector is like nothing, here and in top_k
            there = ~np.isnan(mat).any(axis=1)
            pdf, sims = pdf[there], np.round(mat[there] @ cat.T, 9)
            # stable sort on -similarity keeps the name order among equal scores
            order = np.argsort(-np.nan_to_num(sims, nan=-np.inf), axis=1, kind="stable")[:, :kk]
            rr = np.repeat(np.arange(len(pdf)), kk)
            cc = order.reshape(-1)
            out = {qid: pdf[qid].to_numpy()[rr], table: cat_names[cc], "similarity": sims[rr, cc]}
            out.update({c: pdf[c].to_numpy()[rr] for c in keep})
            yield pd.DataFrame(out)

    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in questions.schema.fields if f.name in keep)
    return questions.select(qid, qvec, *keep).mapInPandas(run, f"{qid} {qtype}, {table} {ttype}, similarity double{extra}")
