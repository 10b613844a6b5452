"""Observation cleaning, lookups, report assembly: goldens, properties, plans."""

import datetime as dt

from pyspark.sql import functions as F

from nimbus.operators import report, weather
from nimbus.operators.clean import CLEAN_NAMES, SECTION_COLUMNS, clean_observations
from nimbus.plans.weather_queries import observations
from nimbus.sources.stations import RAW_COLUMNS


def _raw_row(stn, ymd, hh, t=100, sq=5, n=4, m=0, r=0, s=0, o=0, fh=50, dd=90):
    vals = dict(STN=stn, YYYYMMDD=ymd, HH=hh, DD=dd, FH=fh, FX=fh + 30, T=t, T10N=t, TD=t, SQ=sq, DR=0, RH=0,
                VV=60, N=n, M=m, R=r, S=s, O=o, Y=0)
    return tuple(vals[c] for c in RAW_COLUMNS)


RAW_SCHEMA = ", ".join(f"{c} int" for c in RAW_COLUMNS)


def _obs(spark, rows):
    return clean_observations(spark.createDataFrame(rows, RAW_SCHEMA))


def test_clean_schema_and_values(spark):
    o = _obs(spark, [_raw_row(260, 20231231, 24, t=-31, fh=330)])
    assert o.columns[:19] == CLEAN_NAMES and "obs_date" in o.columns
    r = o.collect()[0]
    assert r["temperature"] == -3 and r["Time_Category"] == "Evening" and r["beaufort"] == 12
    assert r["wind_gust"] == 129.6 and r["Avg_Temperature"] == 4.2 and r["obs_date"] == dt.date(2023, 12, 31)


def test_union_has_no_duplicates_and_merges(spark, sf_mid):
    u = weather.today_tomorrow_union(observations(spark, sf_mid))
    assert u.count() == u.distinct().count()


def test_literal_lookup_keeps_hour_24_gap(spark):
    rows = [_raw_row(240, 20230510, h, t=10 * h) for h in (5, 18, 24)] + [_raw_row(240, 20230511, 3, t=7)]
    o = _obs(spark, rows)
    got = weather.today_tomorrow_union(o, 240, 20230510).collect()
    temps = sorted(r["temperature"] for r in got)
    assert temps == [1, 5, 18]  # hour 24 of the day is out, the next day's hour 3 is in
    assert [r["Time_Category"] for r in got] == sorted(r["Time_Category"] for r in got)


def test_point_lookup_pushes_filter(spark, sf_mid, scratch):
    observations(spark, sf_mid).write.partitionBy("station").parquet(scratch)
    stored = spark.read.parquet(scratch)
    plan = stored.where(F.col("station") == 240).transform(lambda d: weather.on_date(d, 20240105))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date), EqualTo(date,20240105)]" in plan
    assert "PartitionFilters: [isnotnull(station" in plan


def test_sky_condition_rules(spark):
    def sky(rows):
        return weather.sky_condition(_obs(spark, rows)).collect()[0]["sky"]

    morning = [5, 6, 7]
    assert sky([_raw_row(260, 20230101, h, sq=9, n=2) for h in morning]) == "Sunny"
    assert sky([_raw_row(260, 20230101, h, sq=0, n=8) for h in morning]) == "Gray and hardly sunny"
    assert sky([_raw_row(260, 20230101, h, sq=5, n=8, r=1) for h in morning]) == "Sun and showers"
    assert sky([_raw_row(260, 20230101, h, sq=1, n=2, r=1, o=1) for h in morning]) == "Thunderstorms"
    fog_sun = [_raw_row(260, 20230101, 5, sq=0, n=2, m=1), _raw_row(260, 20230101, 6, sq=4, n=2)]
    assert sky(fog_sun) == "Fog followed by sun"
    fog_only = [_raw_row(260, 20230101, 5, sq=4, n=2), _raw_row(260, 20230101, 6, sq=0, n=2, m=1)]
    assert sky(fog_only) == "Foggy"


def test_sample_requests_deterministic_across_partitionings(spark):
    a = report.sample_requests(spark, 500, seed=7).orderBy("request_id").collect()
    b = report.sample_requests(spark, 500, seed=7).repartition(1).orderBy("request_id").collect()
    c = report.sample_requests(spark, 500, seed=7).repartition(8).orderBy("request_id").collect()
    assert a == b == c
    assert {r["location"] for r in a} == set(report.LOCATIONS)
    assert all(dt.date(2023, 1, 1) <= r["date"] <= dt.date(2023, 12, 31) for r in a)
    assert any(r["date"] == dt.date(2023, 12, 31) for r in report.sample_requests(spark, 5000, seed=1).collect())


def _requests(spark, rows):
    base = spark.createDataFrame(rows, "request_id long, location string, date date")
    return report.finish_requests(report.with_station(base, report.station_dim(spark)))


def test_report_edge_cases(spark):
    obs = _obs(spark, [_raw_row(260, 20231231, h, t=10 * h) for h in (3, 8, 13, 20)]
               + [_raw_row(260, 20240101, h, t=5) for h in (2, 9)])
    reqs = _requests(spark, [
        (1, "De Bilt", dt.date(2023, 12, 31)),   # next day in another year
        (2, "Utrecht", dt.date(2023, 12, 31)),   # unknown location
        (3, "De Bilt", dt.date(2023, 6, 1)),     # date without rows
    ])
    rec = {r["request_id"]: r for r in report.report_dataset(reqs, obs).collect()}
    r1 = rec[1]
    assert r1["status"] == "ok" and r1["next_date"] == dt.date(2024, 1, 1)
    assert [x["temperature"] for x in r1["rows_morning"]] == [8]
    assert [x["temperature"] for x in r1["rows_night"]] == [3]
    assert len(r1["rows_tomorrow"]) == 2 and r1["external_id"] == "1_23052024"
    assert "<h3>Tomorrow</h3>" in r1["html_report"] and r1["html_report"].startswith("<html> <p><strong>Location:</strong> De Bilt")
    assert rec[2]["status"] == "unknown_location" and all(len(rec[2][f"rows_{s}"]) == 0 for s in report.SECTIONS)
    assert rec[3]["status"] == "no_data" and "Morning: No data." in rec[3]["report"]
    assert set(r1["rows_morning"][0].asDict()) == set(SECTION_COLUMNS)


def test_assembly_keeps_each_observation_once(spark, sf_mid):
    obs = observations(spark, sf_mid)
    reqs = report.finish_requests(report.with_station(
        obs.select("station", "obs_date").distinct().select(
            F.monotonically_increasing_id().alias("request_id"), F.col("obs_date").alias("date"), "station")
        .join(report.station_dim(spark), "station").select("request_id", "location", "date"),
        report.station_dim(spark)))
    rec = report.assemble_report_rows(report.section_rows(reqs, obs))
    n_today = rec.select(sum(F.size(f"rows_{s}") for s in report.SECTIONS[:4]).alias("n")).agg(F.sum("n")).collect()[0][0]
    # requests name a location, so the stations without one have no report
    named = obs.join(report.station_dim(spark).select("station"), "station", "left_semi").count()
    assert n_today == named > 0


def test_report_plan_has_no_python(spark, sf_small):
    from nimbus.plans.report_queries import requests_from_orders

    rec = report.report_dataset(requests_from_orders(spark, sf_small), observations(spark, sf_small))
    plan = rec._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan


def test_broadcast_only_with_known_small_request_count(spark, sf_small):
    obs = observations(spark, sf_small)
    reqs = report.sample_requests(spark, 400, seed=1)
    small = report.section_rows(reqs, obs, n_requests=400)._jdf.queryExecution().optimizedPlan().toString()
    huge = report.section_rows(reqs, obs, n_requests=400_000_000)._jdf.queryExecution().optimizedPlan().toString()
    # the 5-row station dimension is always broadcast; the request side only when its size is known
    assert small.lower().count("strategy=broadcast") == huge.lower().count("strategy=broadcast") + 1


def test_bundle_records_equal_row_level_assembly(spark, sf_small):
    from nimbus.plans.report_queries import requests_from_orders

    reqs = requests_from_orders(spark, sf_small)
    obs = observations(spark, sf_small)
    a = report.report_records(reqs, obs).select("request_id", *[f"rows_{s}" for s in report.SECTIONS])
    b = report.assemble_report_rows(report.section_rows(reqs, obs)).select("request_id", *[f"rows_{s}" for s in report.SECTIONS])
    assert sorted(a.collect()) == sorted(b.collect())
    # pruned fold (few requests, keys broadcast into a semi join) gives the same records
    c = report.report_records(reqs, obs, n_requests=10_000, prune=True).select("request_id", *[f"rows_{s}" for s in report.SECTIONS])
    assert sorted(a.collect()) == sorted(c.collect())
    plan = report.report_records(reqs, obs, n_requests=100, prune=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_row_level_rendering_equals_bundle_rendering(spark, sf_small):
    from nimbus.plans.report_queries import requests_from_orders

    reqs = requests_from_orders(spark, sf_small)
    obs = observations(spark, sf_small)
    rec = report.assemble_report_rows(report.section_rows(reqs, obs), with_html=True, with_summary=True)
    rec = report.generate(rec)
    rec = rec.withColumn("html_report", report.to_html(rec)).drop(*report.internal_columns(rec))
    a = rec.select("request_id", "report", "html_report")
    b = report.report_dataset(reqs, obs).select("request_id", "report", "html_report")
    assert sorted(a.collect()) == sorted(b.collect())


def test_hottest_in_month_matches_all_months_form(spark, sf_small):
    obs = observations(spark, sf_small)
    per_month = {(r["station"], r["month"]): (r["date"], r["hour"], r["temperature"])
                 for r in weather.hottest_hour(obs).collect()}
    for (station, month), want in per_month.items():
        got = weather.hottest_in_month(obs, station, month).collect()
        assert len(got) == 1 and tuple(got[0]) == want
    plan = weather.hottest_in_month(obs, 240, 202401)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_coldest_and_hottest_with_negatives_and_ties(spark):
    rows = [_raw_row(260, 20240101, 3, t=-50), _raw_row(260, 20240101, 2, t=-50), _raw_row(260, 20231231, 20, t=-50),
            _raw_row(260, 20231231, 21, t=-49), _raw_row(260, 20240102, 5, t=None),
            _raw_row(370, 20240110, 7, t=310), _raw_row(370, 20240103, 9, t=310), _raw_row(370, 20240103, 8, t=-999)]
    o = _obs(spark, rows)
    cold = {r["station"]: (r["date"], r["month"], r["hour"], r["temperature"]) for r in weather.coldest_day(o).collect()}
    assert cold == {260: (20231231, 12, 20, -5), 370: (20240103, 1, 8, -99)}
    hot = {(r["station"], r["month"]): (r["date"], r["hour"], r["temperature"]) for r in weather.hottest_hour(o).collect()}
    assert hot[(370, 202401)] == (20240103, 9, 31)
    assert hot[(260, 202312)] == (20231231, 21, -4) and hot[(260, 202401)] == (20240101, 2, -5)
