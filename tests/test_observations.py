"""The observation adapter folds every event; missing readings stay visible."""

import datetime as dt

from pyspark.sql import functions as F

from nimbus.operators import report, retrieval
from nimbus.sources.stations import RAW_COLUMNS, observations_from_events

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _rows(spark, events):
    rows = observations_from_events(spark.createDataFrame(events, EVENTS)).collect()
    return {(r["STN"], r["YYYYMMDD"], r["HH"]): r for r in rows}


def test_every_event_of_an_hour_counts(spark):
    at = dt.datetime(2024, 1, 5, 13, 10)
    events = [(n, at, 10 * n, "view", 100.0 + n, '{"k": %d}' % n) for n in range(1, 8)]  # all users of station 260
    whole = _rows(spark, events)
    assert list(whole) == [(260, 20240105, 14)]
    for gone in range(len(events)):
        less = _rows(spark, events[:gone] + events[gone + 1:])
        assert less != whole


def test_other_users_are_stations_of_their_own(spark):
    at = dt.datetime(2024, 1, 5, 0, 0)
    got = _rows(spark, [(n, at, n, "purchase", 20.0, '{"k": 1}') for n in range(10)])
    assert {k[0] for k in got} == {260, 370, 344, 240, 380, 1005, 1006, 1007, 1008, 1009}
    assert list(next(iter(got.values())).asDict()) == RAW_COLUMNS


def test_hour_without_readable_values(spark):
    at = dt.datetime(2024, 1, 5, 0, 0)
    got = _rows(spark, [(1, at, 5, "error", 20.0, '{"k": 10}'), (2, at, 6, None, None, None)])
    assert got[(1005, 20240105, 1)]["T"] is None and got[(1005, 20240105, 1)]["DD"] == 990
    assert got[(1006, 20240105, 1)]["T"] is None and got[(1006, 20240105, 1)]["FH"] is None
    assert _rows(spark, []) == {}


def test_one_aggregate_over_one_scan(spark, sf_small):
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    plan = observations_from_events(events)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan and "Window" not in plan
    assert events.count() * 0.6 < observations_from_events(events).count()


def test_missing_reading_stays_in_the_prompt(spark):
    rows = ", ".join(f"array(named_struct('hour', 1, 'temperature', cast(null as double))) AS rows_{s}" for s in report.SECTIONS)
    df = spark.sql(f"SELECT 'De Bilt' AS location, date'2024-01-05' AS date, date'2024-01-06' AS next_date, {rows}")
    prompt = report.build_prompts(df).first()["prompt"]
    assert prompt.count('"temperature":null') == len(report.SECTIONS)


def test_zero_vector_gets_no_table_on_either_path(spark):
    questions = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "qid long, q_embedding array<float>")
    catalog = spark.createDataFrame([("a", [0.0, 1.0]), ("b", [1.0, 0.1])], "table_name string, embedding array<float>")
    small = retrieval.route_table(questions, catalog).select("qid", "table_name").collect()
    large = retrieval.route_table(questions, catalog, max_catalog=1).select("qid", "table_name").collect()
    assert [tuple(r) for r in small] == [tuple(r) for r in large] == [(2, "b")]


def test_generator_runs_without_joining_the_records_back(spark, sf_small):
    from nimbus.plans.report_queries import requests_from_orders
    from nimbus.plans.weather_queries import observations

    reqs, obs = requests_from_orders(spark, sf_small), observations(spark, sf_small)
    plain = report.report_dataset(reqs, obs)._jdf.queryExecution().optimizedPlan().toString()
    hook = report.report_dataset(reqs, obs, fn=lambda pdf: pdf["request_id"].astype(str))
    plan = hook._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == plain.count("Join ")
    assert hook.where(F.col("report") != F.col("request_id").cast("string")).count() == 0
