"""The vector index, the chunk index and the station reader on files of their own."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from nimbus.operators import retrieval, vector_index
from nimbus.sinks import chunk_index
from nimbus.sources.stations import RAW_COLUMNS, read_stations


# --- vector index -----------------------------------------------------------------------

def vectors(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(8 if j == i % 6 else 0, 1) for j in range(12)]) for i in range(300)]
    rows += [(1000 + i, [1.0] * 12) for i in range(150)]  # one vector a third of all
    rows += [(2000, [0.0] * 12), (2001, None), (2002, [1.0, None] + [0.0] * 10), (5, [2.0] * 12)]
    return spark.createDataFrame(rows, "item_id long, embedding array<double>").repartition(4)


def as_queries(items):
    return items.select(F.col("item_id").alias("qid"), F.col("embedding").alias("q_embedding"))


def test_index_recall_pruning_and_exactness(spark, scratch):
    items = vectors(spark)
    path = f"{scratch}/ivf"
    vector_index.build(items, path, lists=8, files_per_list=3)
    stored = spark.read.parquet(f"{path}/lists")
    assert stored.count() == 451  # every vector with a direction, once
    queries = as_queries(items)
    exact = retrieval.top_k(queries, items, 10).cache()
    every = vector_index.search(queries, path, 10, probes=8, query_block=50, item_block=40)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, exact.collect()))
    probes, reached = vector_index.calibrate(queries, path, 10)
    assert reached >= 0.9 and probes < 8
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    one = vector_index.search(queries.where("qid = 3"), path, 10, probes=1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any("list_id" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])
    assert set(r["qid"] for r in one.collect()) == {3}


def test_index_of_nothing_and_bad_sizes(spark, scratch):
    none = spark.createDataFrame([], "item_id long, embedding array<double>")
    vector_index.build(none, f"{scratch}/none", lists=4)
    assert vector_index.search(as_queries(vectors(spark)), f"{scratch}/none", 3, 2).count() == 0
    with pytest.raises(ValueError):
        vector_index.train(none, 0)


# --- chunk index ------------------------------------------------------------------------

def chunk_rows(spark, spec):
    return spark.createDataFrame([(ns, d, c, t) for ns, d, c, t in spec], "namespace string, doc_id long, chunk_no int, text string")


def rows_of(df):
    return sorted(map(tuple, df.select("namespace", "doc_id", "chunk_no", "text").collect()))


def test_upserts_retries_and_pinned_readers(spark, scratch, monkeypatch):
    path = f"{scratch}/index"
    first = [("en", 1, 0, "a"), ("en", 1, 1, "b"), ("d/é =", 2, 0, "c")]
    assert chunk_index.upsert(chunk_rows(spark, [*first, first[0]]), path, "one") == 1
    pinned = chunk_index.read(spark, path)
    second = chunk_rows(spark, [("en", 1, 0, "A"), ("en", 3, 0, "x"), ("fr", 9, 0, "new")])
    # a writer that dies before it commits changes nothing
    with monkeypatch.context() as m:
        m.setattr(chunk_index, "_commit", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            chunk_index.upsert(second, path, "two")
    assert chunk_index.versions(spark, path) == [1] and rows_of(chunk_index.read(spark, path)) == sorted(first)
    assert chunk_index.upsert(second, path, "two") == 2
    now = sorted([("en", 1, 0, "A"), ("en", 1, 1, "b"), ("en", 3, 0, "x"), ("fr", 9, 0, "new"), ("d/é =", 2, 0, "c")])
    assert rows_of(chunk_index.read(spark, path)) == now
    assert rows_of(pinned) == sorted(first) == rows_of(chunk_index.read(spark, path, version=1))
    # the same batch again is a no-op; the namespace not touched keeps its folder
    assert chunk_index.upsert(second, path, "two") == 2 and chunk_index.versions(spark, path) == [1, 2]
    a, b = (chunk_index.manifest(spark, path, v)["namespaces"]["d/é ="] for v in (1, 2))
    assert a == b
    only = chunk_index.read(spark, path, ["fr"])
    assert rows_of(only) == [("fr", 9, 0, "new")] and len(only.inputFiles()) == 1
    assert chunk_index.vacuum(spark, path) == 1 and rows_of(chunk_index.read(spark, path)) == now  # the dead writer's folder goes


def test_a_faster_writer_is_built_upon(spark, scratch, monkeypatch):
    path = f"{scratch}/race"
    chunk_index.upsert(chunk_rows(spark, [("en", 1, 0, "a")]), path, "one")
    commit, raced = chunk_index._commit, []

    def slow(spark_, path_, found):
        if not raced:
            raced.append(1)
            chunk_index.upsert(chunk_rows(spark, [("en", 2, 0, "b")]), path, "other")
        return commit(spark_, path_, found)

    monkeypatch.setattr(chunk_index, "_commit", slow)
    assert chunk_index.upsert(chunk_rows(spark, [("en", 3, 0, "c")]), path, "mine") == 3
    assert [r[3] for r in rows_of(chunk_index.read(spark, path))] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        chunk_index.upsert(chunk_rows(spark, [(None, 1, 0, "a")]), path, "null")


# --- station files ----------------------------------------------------------------------

def test_a_thousand_files_make_one_scan(spark, scratch):
    import os

    os.makedirs(f"{scratch}/stations")
    orders = [RAW_COLUMNS, RAW_COLUMNS[::-1], [*sorted(RAW_COLUMNS), "EXTRA"]]
    for k in range(1000):
        names = orders[k % 3]
        value = {c: str(i) for i, c in enumerate(RAW_COLUMNS)} | {"STN": str(k), "T": " " if k % 2 else "-15", "EXTRA": "9", "YYYYMMDD": "20240101"}
        with open(f"{scratch}/stations/{k}.csv", "w") as out:
            out.write("# a comment before the header\n" * (k % 5 == 0) + ", ".join(f" {c}" for c in names) + "\n" + ",".join(value[c] for c in names) + "\n")
    found = read_stations(spark, f"{scratch}/stations")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 1
    rows = found.collect()
    assert sorted(r["STN"] for r in rows) == list(range(1000))
    for r in rows[:50]:
        assert r["T"] == (None if r["STN"] % 2 else -15.0)
        assert all(r[c] == i for i, c in enumerate(RAW_COLUMNS) if c not in ("STN", "T", "YYYYMMDD"))


def test_station_file_without_a_column(spark, scratch):
    import os

    os.makedirs(f"{scratch}/broken")
    with open(f"{scratch}/broken/a.csv", "w") as out:
        out.write(",".join(RAW_COLUMNS[:-1]) + "\n" + ",".join("1" for _ in RAW_COLUMNS[:-1]) + "\n")
    with pytest.raises(ValueError, match="no column Y"):
        read_stations(spark, f"{scratch}/broken")


# --- chat stream ------------------------------------------------------------------------

def test_greeting_once_over_batches_and_restarts(spark, scratch):
    from nimbus.streaming.chat import run_chat_stream

    def put(rows):
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.mode("append").parquet(f"{scratch}/in")

    put([(1, 0, "user", "hi there"), (2, 0, "assistant", "x")])
    put([(1, 1, "user", "more"), (3, 0, "user", "EXIT")])
    where = dict(sink=f"{scratch}/out", checkpoint=f"{scratch}/state", greeting="hello", max_files=1)
    first = run_chat_stream(spark, f"{scratch}/in", **where)
    greeted = lambda df: sorted(r["conv_id"] for r in df.where("n_answered = 0 AND answer = 'hello' AND turn IS NULL").collect())
    assert greeted(first) == [1, 2, 3]
    put([(1, 2, "user", "and more"), (3, 1, "user", "after the end"), (4, 0, "user", "new")])
    again = run_chat_stream(spark, f"{scratch}/in", **where)
    assert greeted(again) == [1, 2, 3, 4]
    said = sorted((r["conv_id"], r["turn"], r["n_answered"]) for r in again.where("turn IS NOT NULL").collect())
    assert said == [(1, 0, 1), (1, 1, 2), (1, 2, 3), (4, 0, 1)]


# --- HTML pages -------------------------------------------------------------------------

def test_pages_are_published_together_or_not_at_all(spark, scratch):
    import os

    from nimbus.sinks import html_pages

    uri = f"file://{scratch}/pages"
    rows = spark.range(40).select(F.concat(F.col("id").cast("string"), F.lit("_x")).alias("external_id"),
                                  F.when(F.col("id") != 3, F.concat(F.lit("<p>é"), F.col("id").cast("string"))).alias("html_report")).repartition(5)
    broken = rows.withColumn("external_id", F.when(F.col("external_id") == "33_x", "a/b").otherwise(F.col("external_id")))
    with pytest.raises(Exception, match="name a file"):
        html_pages.write_pages(broken, uri)
    left = [f for _, _, names in os.walk(f"{scratch}/pages") for f in names]
    assert left == []  # a failed write leaves no file
    found = {r["external_id"]: r["filename"] for r in html_pages.write_pages(rows, uri).collect()}
    on_disk = {f for _, _, names in os.walk(f"{scratch}/pages") for f in names if f.endswith(".HTML")}
    assert on_disk == {f"{k}.HTML" for k in found} and len(found) == 40
    assert not [d for d in os.listdir(f"{scratch}/pages") if d.startswith("_staging")]
    read = lambda k: open(found[k].replace("file:", "", 1).replace("//", "", 1) if found[k].startswith("file://") else found[k].replace("file:", ""), encoding="utf-8").read()
    assert read("7_x") == "<p>é7" and read("3_x") == ""
    with pytest.raises(Exception, match="URI"):
        html_pages.write_pages(rows, f"{scratch}/plain")
