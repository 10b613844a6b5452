"""Sources, sinks, the chat stream and the driver contract."""

import json
import os
import urllib.parse

from pyspark.sql import functions as F

from nimbus.operators import conversations, report
from nimbus.sinks import files
from nimbus.sources import reports, stations
from nimbus.sources.tables import register_views
from nimbus.plans import catalog
from nimbus.streaming.chat import run_chat_stream


def test_read_stations_padded_headers(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    header = "# STN, YYYYMMDD,   HH,   DD,   FH,   FX,    T, T10N,   TD,   SQ,   DR,   RH,   VV,    N,    M,    R,    S,    O,    Y"
    header = header.replace("# ", "")
    rows = ["  260, 20230101,    1,  230,   50,   80,   45,     ,   20,    0,    0,   -1,   70,    8,    0,    1,    0,    0,    0",
            "  260, 20230101,    2,  990,   40,   70,     ,   10,   15,    3,    0,    0,   80,    9,    1,    0,    0,    0,    0"]
    path = os.path.join(scratch, "De_Bilt.csv")
    with open(path, "w") as f:
        f.write("\n".join([header, *rows]) + "\n")
    df = stations.read_stations(spark, [path])
    got = df.orderBy("HH").collect()
    assert got[0]["STN"] == 260 and got[0]["T"] == 45.0 and got[0]["T10N"] is None and got[0]["RH"] == -1
    assert got[1]["T"] is None and got[1]["DD"] == 990
    names = register_views(__import__("nimbus.operators.clean", fromlist=["x"]).clean_observations(df))
    assert spark.sql("SELECT count(*) FROM De_Bilt").collect()[0][0] == 2
    assert spark.sql("SELECT count(*) FROM eindhoven").collect()[0][0] == 0 and "Maastricht" in names


def test_read_reports_multiline_html(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    path = os.path.join(scratch, "reports.csv")
    with open(path, "w") as f:
        f.write('publishDate;content\n2023-05-24T06:30:00;"<p>Zon\nen &amp; wolken</p>"\n2022-01-01T00:00:00;"<b>old</b>"\n')
    out = reports.archive_parts(reports.read_reports(spark, path), year=2023).collect()
    assert len(out) == 1
    assert (out[0]["date"], out[0]["time"], out[0]["weather_report"], out[0]["season"]) == ("2023-05-24", "06:30:00", "Zon\nen & wolken", "Spring")


def test_read_labels_file(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    path = os.path.join(scratch, "labels.ndjson")
    with open(path, "w") as f:
        f.write(json.dumps({"data_row": {"id": "r"}, "projects": {"p": {"name": "P", "labels": [{"id": "l"}]}}}) + "\nnot json\n")
    from nimbus.operators import labels

    good, bad = labels.read_labels(spark, path)
    assert labels.flatten_labels(good).count() == 1
    b = bad.collect()
    assert len(b) == 1 and b[0]["value"] == "not json" and b[0]["file_path"].endswith("labels.ndjson")


def test_report_sinks_roundtrip(spark, sf_small, scratch):
    from nimbus.plans.report_queries import requests_from_orders
    from nimbus.plans.weather_queries import observations

    rec = report.report_dataset(requests_from_orders(spark, sf_small), observations(spark, sf_small)).limit(25)
    rec = rec.withColumn("uri", report.data_uri(F.col("html_report"))).cache()
    files.write_csv(rec, f"{scratch}/csv")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{scratch}/csv")
    assert back.count() == rec.count()
    r = back.orderBy(F.col("request_id").cast("long")).first()
    orig = rec.orderBy("request_id").first()
    assert json.loads(r["rows_morning"]) == [x.asDict() for x in orig["rows_morning"]]
    assert urllib.parse.unquote(r["uri"].split(",", 1)[1]) == orig["html_report"]
    manifest = files.write_html(rec, f"{scratch}/html")
    m = manifest.collect()
    assert len(m) == rec.count()
    with open(m[0]["filename"], encoding="utf-8") as f:
        assert f.read() == rec.where(F.col("external_id") == m[0]["external_id"]).first()["html_report"]
    files.write_log(rec.select("request_id", "heading", "report"), f"{scratch}/log")
    assert spark.read.json(f"{scratch}/log").count() == rec.count()
    rec.unpersist()


def test_index_roundtrip(spark, sf_small, scratch):
    from nimbus.operators import retrieval

    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "lang", "text")
    ch = retrieval.embed_hash(retrieval.chunk_text(docs, keep=("doc_id", "lang")), "chunk")
    idx = ch.select(F.col("lang").alias("namespace"), "doc_id", "chunk_no", F.lit("t").alias("title"),
                    F.col("chunk").alias("text"), "embedding")
    files.write_index(idx.unionByName(idx), f"{scratch}/index")  # duplicates collapse to one row per key
    back = files.read_index(spark, f"{scratch}/index", "en")
    assert back.count() == idx.where(F.col("namespace") == "en").count()


def test_stream_equals_batch(spark, sf_mid):
    conv = spark.read.parquet(f"{sf_mid}/conversations.parquet")
    batch = conversations.answered_turns(conv)
    stream = run_chat_stream(spark, f"{sf_mid}/conversations*.parquet").select("conv_id", "turn", "question", "n_answered")
    assert sorted(batch.collect()) == sorted(stream.collect())


def test_exit_cuts_session(spark, scratch):
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 2, "user", ""), (1, 3, "user", "EXIT"),
            (1, 4, "user", "after"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 0, "system", "s")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conv.write.parquet(f"{scratch}/conv")
    ans = run_chat_stream(spark, f"{scratch}/conv").collect()
    assert [(r["conv_id"], r["turn"], r["n_answered"]) for r in ans] == [(1, 0, 1), (2, 0, 1)]
    opened = {r["conv_id"]: r["last_role"] for r in conversations.open_turns(conv).collect()}
    assert opened == {3: "system"}


def test_chat_rule_is_the_same_in_batch_and_stream(spark, scratch):
    """Only the user's bare 'exit' ends a session; an assistant's, or one with blanks, doesn't; ' ' is a prompt."""
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "exit"), (1, 2, "user", " exit"), (1, 3, "user", ""), (1, 4, "user", " "),
            (1, 5, "user", "\n"), (1, 6, "user", "Exit"), (1, 7, "user", "late"), (2, 0, "user", None), (2, 1, None, "x"), (2, 2, "user", "b")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conv.write.parquet(f"{scratch}/rule")
    want = [(1, 0, 1), (1, 2, 2), (1, 4, 3), (1, 5, 4), (2, 2, 1)]
    for out in (conversations.answered_turns(conv), run_chat_stream(spark, f"{scratch}/rule")):
        assert sorted((r["conv_id"], r["turn"], r["n_answered"]) for r in out.collect()) == want


def test_entry_and_all_queries_run(spark, sf_small):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and "html_report" in df.columns
    sql = e.oracle_sql()
    own = catalog.all_queries()  # the queries of the training-data subpackage have their own tests
    for name, fn in ((n, f) for n, f in e.queries().items() if n in own):
        out = fn(spark, sf_small)
        assert out.columns, name
        assert name in sql or name in {"embed_hash", "route_table", "report_prompts"}


def test_stream_state_survives_restart(spark, scratch):
    """Two runs of the stream on one checkpoint: the second sees only new files and
    continues each conversation's state (answer count, closed) from the first."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "exit" if (c == 1 and t == 6) else f"q{c}-{t}")
            for c in range(3) for t in range(10)]
    first = [r for r in rows if r[1] < 5]
    second = [r for r in rows if r[1] >= 5]
    schema = "conv_id long, turn long, role string, text string"
    src, sink, cp = f"{scratch}/src", f"{scratch}/sink", f"{scratch}/cp"
    spark.createDataFrame(first, schema).write.mode("append").parquet(src)
    run_chat_stream(spark, src, sink=sink, checkpoint=cp)
    spark.createDataFrame(second, schema).write.mode("append").parquet(src)
    out = run_chat_stream(spark, src, sink=sink, checkpoint=cp).select("conv_id", "turn", "question", "n_answered")
    batch = conversations.answered_turns(spark.createDataFrame(rows, schema))
    assert sorted(out.collect()) == sorted(batch.collect())


def test_observation_table_layout_prunes(spark, sf_mid, scratch):
    from nimbus.operators import weather
    from nimbus.plans.weather_queries import observations

    obs = observations(spark, sf_mid)
    files.write_observations(obs, f"{scratch}/obs")
    stored = spark.read.parquet(f"{scratch}/obs")
    assert stored.count() == obs.count()
    q = weather.on_date(stored.where(F.col("station") == 240), 20240105)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(station" in plan and "EqualTo(date,20240105)" in plan
    assert sorted(map(repr, q.collect())) == sorted(map(repr, weather.on_date(obs.where(F.col("station") == 240), 20240105)
                                                       .select(*stored.columns).collect()))
