"""Goldens and differential checks of the Column functions."""

import html as stdlib_html
import urllib.parse
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import functions as F

from nimbus.functions import codes
from nimbus.functions.text import html_to_text, question_date, question_month, rating
from nimbus.operators.report import data_uri


def _one(spark, expr, values, schema):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_beaufort_boundaries(spark):
    vals = [0.99, 1.0, 5.99, 6.0, 11.99, 12.0, 117.99, 118.0, 500.0, None]
    got = _one(spark, codes.beaufort(F.col("x")), vals, "x double")
    assert got == [0, 1, 1, 2, 2, 3, 11, 12, 12, None]


def test_beaufort_names(spark):
    got = _one(spark, codes.beaufort_name(F.col("x")), [0, 3, 12, 13, None], "x int")
    assert got == ["Calm", "Gentle Breeze", "Hurricane", None, None]


def test_wind_direction(spark):
    vals = [0, 45, 90, 135, 180, 225, 270, 315, 360, 990, -1, 400, None]
    got = _one(spark, codes.wind_direction(F.col("x")), vals, "x int")
    assert got == ["calm", "NE", "E", "SE", "S", "SW", "W", "NW", "N", "variable",
                   "Invalid direction", "Invalid direction", "Invalid direction"]


def test_part_of_day(spark):
    got = _one(spark, codes.part_of_day(F.col("x")), [4, 5, 11, 12, 17, 18, 24, 1], "x int")
    assert got == ["Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night"]


def test_temperature_ceil(spark):
    got = _one(spark, F.ceil(codes.tenths(F.col("x"))), [-5, 1, 30, 31, -31, None], "x int")
    assert got == [0, 1, 3, 4, -3, None]


def test_monthly_normals_half_even(spark):
    got = _one(spark, F.bround(codes.normal_temperature(F.col("x")), 1), list(range(1, 13)), "x int")
    assert got == [3.4, 3.9, 6.4, 9.3, 13.0, 15.6, 17.9, 17.7, 15.5, 11.6, 7.3, 4.2]
    # numpy rounds half to even as well
    assert [float(np.round(v, 1)) for v in codes.MONTHLY_NORMAL_C] == got


def test_long_date_and_next_day(spark):
    df = spark.createDataFrame([("2023-05-02",), ("2023-12-31",)], "d string").select(F.to_date("d").alias("d"))
    rows = df.select(codes.long_date("d"), codes.long_date(codes.next_day_of("d"))).collect()
    assert [tuple(r) for r in rows] == [("May 02, 2023", "May 03, 2023"), ("December 31, 2023", "January 01, 2024")]


def test_visibility_band(spark):
    got = _one(spark, codes.visibility_band(F.col("x")), [0, 1, 49, 50, 56, 79, 80, 88, 89, 52], "x int")
    assert [tuple(g) for g in got] == [
        (0, 100), (100, 200), (4900, 5000), (5000, 6000), (6000, 7000), (29000, 30000),
        (30000, 35000), (70000, 75000), (70000, None), (None, None),
    ]


def test_rating_goldens(spark):
    vals = ["5 - good", "a 3/5", "score 10", "é5", "", None, "3rd", "4.5"]
    got = _one(spark, rating(F.col("x")), vals, "x string")
    assert got == [5, 3, None, None, None, None, None, 4]
    assert _one(spark, codes.F.col("x").try_cast("double").try_cast("int"), [4.0, 7.0], "x double") == [4, 7]


def test_request_text_roundtrip(spark):
    df = spark.createDataFrame([("De Bilt", "2023-05-10", "Morning")], "l string, d string, p string")
    df = df.select(codes.request_text("l", F.to_date("d"), F.col("p")).alias("h"))
    h = df.collect()[0]["h"]
    assert h == "location - De Bilt, date - May 10, 2023, time - Morning"
    parsed = df.select(codes.parse_request("h").alias("r")).collect()[0]["r"]
    assert parsed["location"] == "De Bilt" and str(parsed["date"]) == "2023-05-10" and parsed["part"] == "Morning"


def test_pct_label(spark):
    got = _one(spark, codes.pct_label(F.col("x")), [12.5, 100 / 3, 0.0], "x double")
    assert got == ["12.50%", "33.33%", "0.00%"]


class _Text(HTMLParser):
    """Reference text extraction with the standard library: all text nodes
    except script / style / template bodies, entities decoded."""

    SKIP = {"script", "style", "template"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.depth += 1

    def handle_endtag(self, tag):
        if tag in self.SKIP and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def _stdlib_text(page):
    p = _Text()
    p.feed(page)
    p.close()
    return "".join(p.out)


def test_html_to_text_matches_stdlib_parser(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    rows = pages.select("html", html_to_text(F.col("html")).alias("t")).collect()
    assert rows
    for r in rows:
        assert r["t"] == _stdlib_text(r["html"])


def test_html_entities_and_comments(spark):
    page = "<!DOCTYPE html><p>a &amp;lt; b &quot;c&quot;</p><!-- x --><script>var s='<p>';</script>&copy;"
    got = _one(spark, html_to_text(F.col("x")), [page], "x string")[0]
    assert got == _stdlib_text(page) == stdlib_html.unescape("a &amp;lt; b &quot;c&quot;") + "©"


def test_data_uri_matches_python_quote(spark, sf_small):
    texts = ["a b/c*~+é<>\"'%&=?#", "plain", ""]
    pages = [r["html"] for r in spark.read.parquet(f"{sf_small}/pages.parquet").limit(20).collect()]
    got = _one(spark, data_uri(F.col("x")), texts + pages, "x string")
    want = ["data:text/html;charset=utf-8," + urllib.parse.quote(t) for t in texts + pages]
    assert got == want


def test_question_dates(spark):
    qs = [
        "Would you cycle to work on July 10, 2023?",
        "Was it windy around noon on June 1st, 2023?",
        "Summary 20230913",
        "report 2023-09-13 please",
        "Tell me about the first day of January, 2023 at the coast?",
        "which days were dry in February, 2023 down south?",
        "do I need a coat in mid November?",
    ]
    df = spark.createDataFrame([(q,) for q in qs], "q string")
    rows = df.select(question_date("q").alias("d"), question_month("q").alias("m")).collect()
    assert [str(r["d"]) if r["d"] else None for r in rows] == [
        "2023-07-10", "2023-06-01", "2023-09-13", "2023-09-13", "2023-01-01", None, None,
    ]
    assert rows[5]["m"]["month_start"].isoformat() == "2023-02-01"
    assert rows[5]["m"]["month_end"].isoformat() == "2023-02-28"
    assert rows[6]["m"] is None


def test_sql_functions_inline_and_match_columns(spark, sf_small, scratch):
    from nimbus.functions.sql import register_sql_functions

    register_sql_functions(spark)
    got = spark.sql(
        "SELECT beaufort(0.99) a, beaufort(118.0) b, beaufort(CAST(NULL AS DOUBLE)) c, beaufort_name(3) d, "
        "wind_direction(45) e, part_of_day(24) f, season(1) g, normal_temperature(5) h, rating('a 3/5') i"
    ).collect()[0]
    assert tuple(got) == (0, 12, None, "Gentle Breeze", "NE", "Evening", "Winter", 12.95, 3)
    from nimbus.plans.weather_queries import observations

    observations(spark, sf_small).write.parquet(scratch)
    spark.read.parquet(scratch).createOrReplaceTempView("obs_tmp")
    plan = spark.sql("SELECT date FROM obs_tmp WHERE part_of_day(hour) = 'Morning'")._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "hour" in plan and "DataFilters" in plan


def test_sql_text_functions_match_columns(spark, sf_small):
    from nimbus.functions.sql import register_sql_functions

    register_sql_functions(spark)
    spark.read.parquet(f"{sf_small}/pages.parquet").createOrReplaceTempView("pages_tmp")
    a = spark.sql("SELECT page_id, html_to_text(html) t, data_uri(html) u FROM pages_tmp").collect()
    b = spark.read.parquet(f"{sf_small}/pages.parquet").select(
        "page_id", html_to_text(F.col("html")).alias("t"), data_uri(F.col("html")).alias("u")).collect()
    assert sorted(a) == sorted(b)
