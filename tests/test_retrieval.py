"""Chunking, top-k search and routing against brute force."""

import numpy as np
from pyspark.sql import functions as F

from nimbus.operators import retrieval, routing


def _py_chunks(text, size, overlap):
    toks = [t for t in __import__("re").split(r"[ \t\n\x0b\f\r]+", text) if t]
    if not toks:
        return []
    step = size - overlap
    starts = range(0, max(len(toks) - overlap - 1, 0) + 1, step)
    return [" ".join(toks[s:s + size]) for s in starts]


def test_chunks_match_python(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    got = {}
    for r in retrieval.chunk_text(docs, size=50, overlap=10).collect():
        got.setdefault(r["doc_id"], []).append((r["chunk_no"], r["chunk"]))
    for r in docs.collect():
        want = _py_chunks(r["text"], 50, 10)
        assert [c for _, c in sorted(got.get(r["doc_id"], []))] == want


def test_chunks_cover_whole_text(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    ch = retrieval.chunk_text(docs, size=40, overlap=5)
    per_doc = ch.groupBy("doc_id").agg(F.sum(F.col("n_tokens") - F.when(F.col("chunk_no") > 0, 5).otherwise(0)).alias("n"))
    n_tok = docs.select("doc_id", F.size(retrieval.tokens("text")).alias("m"))
    bad = per_doc.join(n_tok, "doc_id").where(F.col("n") != F.col("m")).count()
    assert bad == 0


def _brute_top_k(queries, items, k, same_label=False):
    out = {}
    for qid, qv, ql in queries:
        scored = []
        for iid, iv, il in items:
            if same_label and il != ql:
                continue
            s = float(np.dot(qv, iv) / (np.linalg.norm(qv) * np.linalg.norm(iv)))
            scored.append((-round(s, 9), iid))
        out[qid] = [iid for _, iid in sorted(scored)[:k]]
    return out


def _emb(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def test_top_k_matches_brute_force(spark, sf_small):
    emb = _emb(spark, sf_small)
    q = retrieval.centroids(emb, "label", out="q_embedding").withColumnRenamed("label", "qid")
    items = [(r["vec_id"], np.array(r["embedding"], dtype=float), r["label"]) for r in emb.collect()]
    queries = [(r["qid"], np.array(r["q_embedding"]), r["qid"]) for r in q.collect()]
    got = {}
    for r in retrieval.top_k(q, emb, 3, qid="qid", iid="vec_id").collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["vec_id"]))
    got = {k: [i for _, i in sorted(v)] for k, v in got.items()}
    assert got == _brute_top_k(queries, items, 3)
    filt = {}
    idx = emb.withColumnRenamed("label", "qid")
    for r in retrieval.top_k(q, idx, 3, qid="qid", iid="vec_id", on="qid").collect():
        filt.setdefault(r["qid"], []).append((r["rank"], r["vec_id"]))
    filt = {k: [i for _, i in sorted(v)] for k, v in filt.items()}
    assert filt == _brute_top_k(queries, items, 3, same_label=True)


def test_top_k_bucketed_equals_single_broadcast(spark, sf_small):
    emb = _emb(spark, sf_small)
    q = emb.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("q_embedding")).where(F.col("label") < 3)
    one = retrieval.top_k(q, emb, 2, qid="qid", iid="vec_id")
    many = retrieval.top_k(q, emb, 2, qid="qid", iid="vec_id", query_block=7, item_block=11)
    assert sorted(one.collect()) == sorted(many.collect())


def test_top_k_plan_limits_before_shuffle(spark, sf_small):
    emb = _emb(spark, sf_small)
    q = retrieval.centroids(emb, "label", out="q_embedding").withColumnRenamed("label", "qid")
    plan = retrieval.top_k(q, emb, 3, qid="qid", iid="vec_id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "FlatMapCoGroupsInArrow" in plan and "Broadcast" not in plan
    native = retrieval.top_k(q, emb, 3, qid="qid", iid="vec_id", method="native")
    assert "WindowGroupLimit" in native._jdf.queryExecution().executedPlan().toString()
    assert sorted(native.collect()) == sorted(retrieval.top_k(q, emb, 3, qid="qid", iid="vec_id").collect())


def test_route_and_context(spark, sf_small):
    from nimbus.plans.weather_queries import observations

    qs = spark.createDataFrame([
        (1, "What does the weather look like on January 5th, 2024?"),
        (2, "What does the weather look like on June 5th, 2024?"),
        (3, "How many days did it rain in January, 2024?"),
        (4, "what should I pack for mid November?"),
    ], "qid long, question string")
    ctx = {r["qid"]: (r["route"], r["n_obs_rows"]) for r in routing.answer_context(routing.route(qs), observations(spark, sf_small)).collect()}
    assert ctx[1][0] == "observations" and ctx[1][1] > 0
    assert ctx[2] == ("both", 0)
    assert ctx[3][0] == "observations" and ctx[3][1] >= ctx[1][1]
    assert ctx[4] == ("articles", 0)


def test_article_context(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    chunks = retrieval.chunk_text(docs, size=64, overlap=8).withColumn(
        "chunk_id", F.col("doc_id") * 10000 + F.col("chunk_no"))
    first = chunks.orderBy("chunk_id").limit(1).collect()[0]
    qs = spark.createDataFrame([(1, first["chunk"])], "qid long, question string")
    top = routing.article_context(qs, chunks, k=1).collect()
    assert top[0]["chunk_id"] == first["chunk_id"] and abs(top[0]["similarity"] - 1.0) < 1e-6


def test_route_table_matches_brute_force(spark, sf_small):
    emb = _emb(spark, sf_small)
    cat = retrieval.centroids(emb, "label").withColumnRenamed("label", "table_name")
    qs = emb.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("q_embedding"), "label")
    got = {r["qid"]: r["table_name"] for r in retrieval.route_table(qs, cat, keep=("label",)).collect()}
    cents = [(r["table_name"], np.array(r["embedding"])) for r in cat.collect()]
    for r in qs.collect():
        v = np.array(r["q_embedding"], dtype=float)
        sims = sorted((-round(float(np.dot(v, c) / (np.linalg.norm(v) * np.linalg.norm(c))), 9), n) for n, c in cents)
        assert got[r["qid"]] == sims[0][1]
    # a catalog over the broadcast bound takes the exact bucketed path
    big = {r["qid"]: r["table_name"] for r in retrieval.route_table(qs, cat, keep=("label",), max_catalog=3).collect()}
    assert big == got


def test_top_k_with_few_digits_agrees(spark, sf_small):
    """Rounding to two digits ties many items; both methods break the ties by id."""
    emb = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    names = emb.columns
    index = emb.select(F.col(names[0]).alias("item_id"), F.col("embedding"))
    queries = index.limit(3).select(F.col("item_id").alias("qid"), F.col("embedding").alias("q_embedding"))
    got = [sorted(map(tuple, retrieval.top_k(queries, index, 5, digits=2, method=m).collect())) for m in ("numpy", "native")]
    assert got[0] == got[1]


def test_block_scorer_holds_a_tile_of_scores():
    """What a task of a search holds beside its blocks does not grow with them, and the result is brute force's, ties included."""
    import tracemalloc

    import pyarrow as pa

    rnd = np.random.default_rng(3)
    pool = rnd.normal(size=(300, 8))  # most vectors come several times
    q, x = pool[rnd.integers(0, 300, 3_000)], pool[rnd.integers(0, 300, 9_000)]
    ids = rnd.permutation(9_000)
    queries = pa.table({"qid": np.arange(3_000), "v": pa.array(list(q), pa.list_(pa.float64()))})
    items = pa.table({"item_id": ids, "e": pa.array(list(x), pa.list_(pa.float64()))})
    tracemalloc.start()
    got = retrieval.block_scorer(4, "qid", "item_id", "v", "e", 9)(queries, items).to_pydict()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20  # the scores of 3,000 queries and 8,192 items alone take 197 MB
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    order = np.argsort(ids)
    sims = np.round(unit(q) @ unit(x[order]).T, 9)
    want = np.argsort(-sims, axis=1, kind="stable")[:, :4]
    found = {}
    for a, b in zip(got["qid"], got["item_id"]):
        found.setdefault(a, []).append(b)
    assert all(sorted(found[i]) == sorted(want[i].tolist()) for i in range(3_000))


def test_sparse_queries_are_multiplied_where_they_are_not_zero(monkeypatch):
    """Queries of few terms meet only those places of the items; the result is brute force's, copies of items included."""
    import pyarrow as pa
    import pytest

    monkeypatch.setattr(retrieval, "QUERY_TILE", 64)
    widths, better = [], retrieval._better
    monkeypatch.setattr(retrieval, "_better", lambda score, q, *rest: widths.append(q.shape[1]) or better(score, q, *rest))
    rnd = np.random.default_rng(5)
    q = np.zeros((640, 200))
    for i in range(640):  # ten kinds of questions, dealt out, with a term of their own
        q[i, i % 10 * 20 + np.append(rnd.integers(1, 20, 5), 0)] = 1
    x = rnd.poisson(0.6, size=(5_000, 200)).astype(float)
    x[1000:3000] = x[999]
    table = lambda key, name, m: pa.table({key: np.arange(len(m)), name: pa.array(list(m), pa.list_(pa.float64()))})
    for digits in (9, 3):
        got = retrieval.block_scorer(3, "qid", "item_id", "v", "e", digits)(table("qid", "v", q), table("item_id", "e", x)).to_pydict()
        unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
        sims = np.round(unit(q) @ unit(x).T, digits)
        want = np.argsort(-sims, axis=1, kind="stable")[:, :3]
        assert sorted(zip(got["qid"], got["item_id"])) == sorted((i, int(j)) for i in range(640) for j in want[i])
        assert np.allclose(got["similarity"], sims[got["qid"], got["item_id"]], atol=1e-12)
    assert widths and max(widths) <= 20
    with pytest.raises(ValueError):
        retrieval.block_scorer(3, "qid", "item_id", "v", "e", 9)(table("qid", "v", q), table("item_id", "e", x[:, :50]))


def test_block_of_long_vectors_is_smaller(spark, sf_small):
    assert retrieval.block_rows(256) * 256 <= retrieval.BLOCK_VALUES and retrieval.block_rows(None) > 1 and retrieval.block_rows(1 << 30) == 1


def test_digest_embedding_goes_in_steps(monkeypatch):
    """Texts are hashed a bounded number of characters at a time, and none is left out."""
    import pandas as pd

    monkeypatch.setattr(retrieval, "CHARS_STEP", 50)
    monkeypatch.setattr(retrieval, "TEXTS_STEP", 4)
    texts = pd.Series(["wind rain", "", "x" * 200, "a", "b", "c", "d", "e", "wind", "é wind é"])
    steps = list(retrieval._steps(texts))
    assert [t for s in steps for t in s] == list(texts)
    assert all(len(s) <= 4 and (len(s) == 1 or s.str.len().sum() <= 50) for s in steps)
    rows = np.concatenate([retrieval._digest_rows(s, 16) for s in steps])
    assert np.allclose(rows, retrieval._digest_rows(texts, 16)) and not rows[1].any() and np.isclose(np.linalg.norm(rows[9]), 1)
