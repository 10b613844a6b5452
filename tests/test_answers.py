"""Names in questions, answers by rows and chunks, and the plans behind them."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from nimbus.functions import text
from nimbus.operators import answers, conversations, report, retrieval
from nimbus.plans.weather_queries import observations

NAMES = ["De Bilt", "Eindhoven", "Amsterdam", "Rotterdam", "Rotterdam Noord", "St. Anna (oost)", "Ede"]


def named(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [list(r[0]) for r in df.orderBy("i").select(text.names_in("t", NAMES, **kw)).collect()]


def test_names_in_questions(spark):
    got = named(spark, [
        "rain in DE  BILT or eindhoven?", "Amsterdammer", "(Amsterdam)", "rotterdam noord, then Rotterdam", "st. anna (oost)?", "Edelstein near Ede",
        "", None, "amsterdam Amsterdam", "rotterdam  noordwijk"])
    assert got == [["de bilt", "eindhoven"], [], ["amsterdam"], ["rotterdam noord", "rotterdam"], ["st. anna (oost)"], ["ede"], [], [], ["amsterdam"], ["rotterdam"]]
    assert named(spark, ["two edes"], plural=True) == [["ede"]]
    assert spark.range(1).select(text.names_in(F.lit("De Bilt"), [])).first()[0] == []


def test_pattern_finds_what_a_plain_alternation_finds():
    pattern = text.names_pattern(NAMES).replace(r"(?iu)", "").replace(r"\p{L}\p{N}", "A-Za-z0-9")
    plain = "|".join(re.escape(n).replace(r"\ ", r"\s+") for n in sorted(NAMES, key=len, reverse=True))
    plain = rf"(?<![A-Za-z0-9])(?:{plain})(?![A-Za-z0-9])"
    for said in ["De Bilt, Ede and Rotterdam Noord", "Rotterdam NoordX", "Eindhoven/De  Bilt", "St. Anna (oost) St. Anna"]:
        assert re.findall(pattern, said, re.I) == re.findall(plain, said, re.I)


@pytest.fixture(scope="module")
def chunks(spark):
    docs = spark.createDataFrame([(1, "snow and ice on the canals in january"), (2, "beach and sun in july"), (3, "leaves fall in the wood"), (4, "no title for this one")], "doc_id long, text string")
    titles = spark.createDataFrame([(1, "Winter"), (2, "Summer"), (3, "Autumn"), (3, "Winter"), (9, "Spring"), (4, None)], "doc_id long, title string")
    return answers.titled_chunks(docs, titles, size=64, overlap=8)


def test_titles_pair_by_key(chunks):
    assert sorted((r["doc_id"], r["title"]) for r in chunks.collect()) == [(1, "Winter"), (2, "Summer"), (3, "Autumn")]


QUESTIONS = [
    (1, "Compare De Bilt with Eindhoven on January 5, 2024"), (2, "how was June 5th, 2024 in De Bilt: beach and sun in july"), (3, "what about the winters?"),
    (4, "ice or beach?"), (5, "rain on 20240105?"), (6, "Rotterdam in January, 2024"), (7, None), (8, ""),
]


def test_answers_in_one_frame(spark, sf_small, chunks):
    gazetteer = report.station_dim(spark).withColumnRenamed("location", "place")
    obs = observations(spark, sf_small)
    questions = spark.createDataFrame(QUESTIONS, "qid long, question string")
    got = answers.answers(questions, obs, gazetteer, chunks, k=2, titles={"winter": "Winter"}, default=["Maastricht"]).collect()
    of = lambda q, kind: [r for r in got if r["qid"] == q and r["kind"] == kind]
    held = {(r["station"], r["date"]): r["n"] for r in obs.groupBy("station", "date").agg(F.count("*").alias("n")).collect()}
    assert {(r["title"], r["date"]) for r in of(1, "row")} <= {("De Bilt", 20240105), ("Eindhoven", 20240105)} and not of(1, "chunk")
    assert len(of(1, "row")) == held.get((260, 20240105), 0) + held.get((370, 20240105), 0) > 0
    assert not of(2, "row") and {r["route"] for r in of(2, "chunk")} == {"both"} and min(of(2, "chunk"), key=lambda r: r["rank"])["title"] == "Summer"
    assert [r["title"] for r in of(3, "chunk")] == ["Winter"]  # only that title's chunks
    assert len(of(4, "chunk")) == 2 and {r["route"] for r in of(4, "chunk")} == {"articles"}
    assert {r["title"] for r in of(5, "row")} == {"Maastricht"}  # no place named
    assert len(of(6, "row")) == sum(n for (s, d), n in held.items() if s == 344 and d // 100 == 202401)
    assert not of(7, "row") and not of(7, "chunk")
    assert '"temperature":' in of(1, "row")[0]["text"]


def test_readings_are_written_once_per_observation(spark, sf_small, chunks):
    """A question's rows bring the text of an observation along; it is not written, nor questions parsed, per row."""
    gazetteer = report.station_dim(spark).withColumnRenamed("location", "place")
    obs = observations(spark, sf_small)
    questions = spark.createDataFrame(QUESTIONS, "qid long, question string")
    found = answers.answers(questions, obs, gazetteer, chunks, k=2, titles={"winter": "Winter"}, default=["Maastricht"])
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "to_json" not in plan and "structstojson" not in plan and "regexp" not in plan
    read = {"wind": lambda t: F.get_json_object(t, "$.beaufort").cast("int")}
    told = answers.answers(questions, obs, gazetteer, chunks, k=2, titles={"winter": "Winter"}, default=["Maastricht"], read=read)
    assert "get_json_object" not in told.drop("text")._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    force = {(r["station"], r["date"], r["hour"]): r["beaufort"] for r in obs.collect()}
    at = {"De Bilt": 260, "Eindhoven": 370, "Maastricht": 380, "Rotterdam": 344}
    for r in told.collect():
        assert r["wind"] == (force[at[r["title"]], r["date"], r["hour"]] if r["kind"] == "row" else None)


def test_keys_that_come_twice_have_every_route(spark, sf_small, chunks):
    """Questions of one key: each with each of the key's routes; those without a key have no chunks."""
    gazetteer = report.station_dim(spark).withColumnRenamed("location", "place")
    rows = [(1, "ice or beach?"), (1, "June 5th, 2024: beach and sun in july"), (2, "ice or beach?"), (2, "ice or beach?"), (3, "Ede or Eindhoven on January 5, 2024"), (3, "June 5th, 2024: snow"),
            (None, "ice or beach?")]
    got = answers.answers(spark.createDataFrame(rows, "qid long, question string"), observations(spark, sf_small), gazetteer, chunks, k=1).where("kind = 'chunk'").collect()
    assert sorted((r["qid"], r["route"]) for r in got) == [(1, "articles")] * 2 + [(1, "both")] * 2 + [(2, "articles")] * 4


def test_date_parsing_is_compiled(spark):
    """The JVM leaves methods of over 8,000 bytes to its interpreter."""
    from nimbus.operators import routing

    asked = routing.route(spark.range(3).selectExpr("id AS qid", "concat('rain on January ', id, ', 2024') AS question"))
    debug = getattr(getattr(spark.sparkContext._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    code = debug.codegenString(asked._jdf.queryExecution().executedPlan())
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8_000


def test_gazetteer_bound(spark, monkeypatch):
    monkeypatch.setattr(answers, "MAX_NAMES", 3)
    routed = spark.createDataFrame([(1, "x", None, None, None, "articles")], "qid long, question string, q_date date, month_start date, month_end date, route string")
    with pytest.raises(ValueError):
        answers.place_dates(routed, report.station_dim(spark).withColumnRenamed("location", "place"))


def test_digest_embedding(spark):
    import hashlib

    rows = spark.createDataFrame([(1, "Wind wind rain"), (2, None), (3, "")], "i int, text string")
    got = {r["i"]: list(r["embedding"]) for r in retrieval.embed_digest(rows, dim=64).collect()}
    at = {w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64 for w in ("wind", "rain")}
    assert got[1][at["wind"]] == pytest.approx(2 / 5**0.5) and got[1][at["rain"]] == pytest.approx(1 / 5**0.5)
    assert not any(got[2]) and not any(got[3])


def test_numbering_by_ranges(spark, monkeypatch):
    """A conversation with a third of all turns is numbered range by range; null turns come first."""
    monkeypatch.setattr(conversations, "TURN_RANGE", 64)
    rows = [(1, t) for t in range(0, 3000, 3)] + [(1, None), (None, 5), (None, 9)] + [(c, t) for c in range(2, 400) for t in (0, 100, 2000, 70)]
    got = conversations.numbered(spark.createDataFrame(rows, "conv_id long, turn long").repartition(6))
    by = {}
    for r in got.collect():
        by.setdefault(r["conv_id"], []).append((r["turn"], r["n"]))
    expected = {}
    for c, t in rows:
        expected.setdefault(c, []).append(t)
    for c, turns in expected.items():
        order = sorted(turns, key=lambda t: (t is not None, t or 0))
        assert sorted(by[c], key=lambda x: x[1]) == [(t, k) for k, t in enumerate(order, 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # turns are sorted within a range; the only window over whole conversations sorts counts
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("row_number" in w and "_range" in w.split("], [")[-2] for w in windows) == 1
    assert sum("sum(_n" in w for w in windows) == 1


def test_report_folds_once_and_joins_once(spark, sf_small):
    from nimbus.plans.report_queries import requests_from_orders

    rec = report.report_dataset(requests_from_orders(spark, sf_small), observations(spark, sf_small), stations=report.station_dim(spark))
    plan = rec._jdf.queryExecution().optimizedPlan().toString()
    folds = [line for line in plan.splitlines() if "Aggregate" in line and "collect_list" in line]
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    # the station dimension's broadcast join and the join with the bundles
    assert len(folds) == 1 and len(joins) == 2
    assert "IN (" in plan or "INSET" in plan  # stations pruned before the fold


def test_chunks_are_embedded_once(spark, chunks):
    """Both searches and the join that shows the chunks read one embedding of them."""
    seen = spark.sparkContext.accumulator(0)

    def embed(df, column, out):
        @F.udf("array<double>")
        def count(t):
            seen.add(1)
            return [1.0, float(len(t))]

        return df.withColumn(out, count(column))

    questions = spark.createDataFrame([(1, "what about the winters?"), (2, "ice or beach?")], "qid long, question string")
    found = answers.answer_chunks(questions, chunks, k=2, titles={"winter": "Winter"}, embed=embed)
    asked_and_chunks = 2 * 2 + chunks.count()  # the questions of either search
    assert found.count() == 3 and seen.value <= asked_and_chunks


def test_few_observations_are_sent_to_the_questions(spark, sf_small, monkeypatch):
    """Questions, whose days are few keys, are not shuffled by day for a bounded number of observations; the rows are the same either way."""
    gazetteer = report.station_dim(spark).withColumnRenamed("location", "place")
    routed = answers.dated(spark.createDataFrame(QUESTIONS + [(None, "Ede or Eindhoven on January 5, 2024"), (1, "Eindhoven in January, 2024")], "qid long, question string"))
    assert routed.count() == len(QUESTIONS) + 2
    obs = observations(spark, sf_small)
    rows, routes = [], []
    for most in (answers.MAX_SENT, 0):
        monkeypatch.setattr(answers, "MAX_SENT", most)
        found = answers.answer_rows(routed, obs, gazetteer, default=["Maastricht"])
        final = answers.final_routes(routed, obs, gazetteer, default=["Maastricht"])
        if most:
            assert "hashpartitioning(station" not in found._jdf.queryExecution().executedPlan().toString()
        rows.append(sorted(found.collect(), key=repr))
        routes.append(sorted(final.collect(), key=repr))
    assert rows[0] == rows[1] and len(rows[0]) > 0 and routes[0] == routes[1]
