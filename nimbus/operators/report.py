"""Report dataset: requests -> section rows -> one record per request -> text and HTML.

The reference runs five lookups per report, one after another, 400 times.
Here every request of a batch is answered by one plan:

1. requests carry ``(station, date, next_date)``; the station comes from a
   broadcast join with the fixed 5-row location dimension (J3);
2. each request is exploded into its section keys, ``(section, date, part)``,
   the next-day section as one key per part, so the lookup is a single inner
   equi join on ``(station, date, part)`` (J1, J2), plus one placeholder row
   per request section so a request or section without rows survives empty;
3. one aggregation keyed by the request gathers each section's rows into a
   list sorted by hour (A13); a section holds at most one day of hours, so
   lists stay small whatever the data size;
4. text (G3) and HTML (G6) are native array expressions on those lists.

Shuffles: the join (none when one side is broadcast: the request keys when
their count is known to be small, else whichever side AQE measures small) and
the aggregation, whose map-side partial aggregate folds a request's rows
before the exchange. Observations are never collected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbus.functions import codes
from nimbus.operators.clean import SECTION_COLUMNS

# Report sections, their titles, and the HTML table headings.
SECTIONS = ["morning", "afternoon", "evening", "night", "tomorrow"]
SECTION_TITLES = {
    "morning": "Morning",
    "afternoon": "Afternoon",
    "evening": "Evening",
    "night": "Night",
    "tomorrow": "Tomorrow",
}
TABLE_HEADINGS = [
    "Time", "Temperature", "winddirection", "beaufort", "precipitation", "sunshine",
    "cloudcover", "fog", "rain", "snow", "thunderstorm",
]
LOCATIONS = ["Rotterdam", "De Bilt", "Eindhoven", "Maastricht", "Amsterdam"]
NO_DATA = "No data"
# Page format: PAGE_LOCATION location PAGE_DATE heading PAGE_REPORT report PAGE_REPORT_END,
# then one table per section (TABLE_OPEN rows TABLE_END; a row is <tr> cells </tr>, a cell
# <td> value </td>), then PAGE_END. A missing value prints as NULL_TEXT.
PAGE_LOCATION = "<html> <p><strong>Location:</strong> "
PAGE_DATE = "</p><p><strong>Date:</strong> "
PAGE_REPORT = "</p><p><strong>Report:</strong> "
PAGE_REPORT_END = "</p>"
PAGE_END = "</html>"
TABLE_OPEN = "<h3>{title}</h3><table border='1'><tr>{head}</tr>"
TABLE_END = "</table>"
NULL_TEXT = "None"
DATA_URI_PREFIX = "data:text/html;charset=utf-8,"
LINK = ('<a href="', '" target="_blank">View Report</a>')
DEFAULT_BATCH_SUFFIX = "23052024"

# Stations one report batch may name.
MAX_STATIONS = 10_000
# Bytes of one exploded section key row, used for the broadcast size check.
_SECTION_ROW_BYTES = 64


def station_dim(spark: SparkSession) -> DataFrame:
    """The fixed location -> station dimension (5 rows)."""
    return spark.createDataFrame(
        [(loc, st) for loc, st in codes.STATIONS.items()],
        "location string, station int",
    )


def with_station(requests: DataFrame, dim: DataFrame) -> DataFrame:
    """Resolve ``location`` to ``station``; unknown locations keep a null station.
    The dimension has a fixed 5 rows, so broadcasting it is always safe."""
    return requests.join(F.broadcast(dim), on="location", how="left")


def finish_requests(df: DataFrame) -> DataFrame:
    """Add ``next_date`` and the heading text to ``(request_id, location, station, date)``."""
    return df.select(
        "request_id", "location", "station", "date",
        codes.next_day_of("date").alias("next_date"),
        codes.request_text("location", "date").alias("heading"),
    )


def sample_requests(
    spark: SparkSession,
    n: int,
    seed: int = 0,
    year: int = 2023,
    locations: Sequence[str] = LOCATIONS,
) -> DataFrame:
    """G1: ``n`` requests, each a random location and a random day of ``year``
    (both ends in), drawn with replacement.

    The draw is a hash of ``(id, seed)``, not ``rand``, so the same ``n`` and
    ``seed`` give the same requests for every partitioning and on every retry.
    """
    start = F.make_date(F.lit(year), F.lit(1), F.lit(1))
    n_days = F.datediff(F.make_date(F.lit(year), F.lit(12), F.lit(31)), start) + 1
    locs = F.array(*[F.lit(x) for x in locations])
    base = spark.range(n).select(
        F.col("id").alias("request_id"),
        F.element_at(locs, (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(len(locations))) + 1).cast("int")).alias("location"),
        F.date_add(start, F.pmod(F.xxhash64("id", F.lit(seed), F.lit(1)), n_days).cast("int")).alias("date"),
    )
    return finish_requests(with_station(base, station_dim(spark)))


def section_keys(requests: DataFrame) -> DataFrame:
    """One row per (request, section, part): four parts of the day on ``date``,
    and the next day as four keys (all its parts) under section ``tomorrow``.
    All request columns are carried along."""
    d = codes.date_to_int("date")
    nd = codes.date_to_int("next_date")
    parts = [("morning", "Morning"), ("afternoon", "Afternoon"), ("evening", "Evening"), ("night", "Night")]
    keys = [F.struct(F.lit(s).alias("section"), d.alias("key_date"), F.lit(p).alias("key_part")) for s, p in parts]
    keys += [F.struct(F.lit("tomorrow").alias("section"), nd.alias("key_date"), F.lit(p).alias("key_part")) for _, p in parts]
    return requests.select(*requests.columns, F.inline(F.array(*keys)))


def _broadcast_if_bounded(df: DataFrame, n_requests: int | None, threshold_bytes: int) -> DataFrame:
    if n_requests is not None and n_requests * 8 * _SECTION_ROW_BYTES <= threshold_bytes:
        return F.broadcast(df)
    return df


def section_rows(
    requests: DataFrame,
    obs: DataFrame,
    n_requests: int | None = None,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """J1 + J2: every request section with its observation rows.

    An inner equi join on ``(station, date, part)`` finds the rows; one
    placeholder row per (request, section) with a null ``hour`` keeps requests
    and sections without rows (the effect of a left join). The inner join lets
    either side be the broadcast one: the request keys when the caller passes
    ``n_requests`` and their size is within ``broadcast_bytes`` (then the
    observations are streamed, never shuffled, and a table partitioned by
    station is pruned), otherwise whatever AQE picks from measured sizes.
    Output: all request columns, ``section``, ``hour`` and the 11 section columns.
    """
    req_cols = requests.columns
    keys = _broadcast_if_bounded(section_keys(requests), n_requests, broadcast_bytes)
    o = obs.select(
        F.col("station").alias("o_station"), F.col("date").alias("o_date"), "hour",
        *[F.col(c) for c in SECTION_COLUMNS],
    )
    cond = (
        (keys["station"] == o["o_station"])
        & (keys["key_date"] == o["o_date"])
        & (keys["key_part"] == o["Time_Category"])
    )
    found = keys.join(o, cond, "inner").select(*req_cols, "section", "hour", *SECTION_COLUMNS)
    types = {f.name: f.dataType for f in found.schema.fields}
    placeholders = requests.select(
        *req_cols,
        F.explode(F.array(*[F.lit(s) for s in SECTIONS])).alias("section"),
        *[F.lit(None).cast(types[c]).alias(c) for c in ["hour", *SECTION_COLUMNS]],
    )
    return found.unionByName(placeholders)


def _html_row(row: Column | None = None) -> Column:
    """One observation (the row's columns, or a struct of them) as an HTML table row."""
    return F.concat(F.lit("<tr>"), *[_cell(F.col(c) if row is None else row[c]) for c in SECTION_COLUMNS], F.lit("</tr>"))


def assemble_report_rows(rows: DataFrame, with_html: bool = False, with_summary: bool = False) -> DataFrame:
    """One record per request, one list of rows per section, in hour order.

    One aggregation keyed by the request columns. The rows of a request come
    from the same input partitions, so the partial (map-side) aggregate already
    folds them and the shuffle carries about one row per request and task. A
    section without rows gives an empty list.

    Output per section ``s``: ``rows_s`` (the 11 columns, no hour) and
    ``sec_s`` (sorted ``struct<hour, r[, html]>``). ``with_summary`` adds the
    section's sky inputs as conditional aggregates of the same pass
    (``n_s, sun_s, cloud_s, rain_s, snow_s, fog_s, thunder_s, tmin_s, tmax_s,
    bmax_s``); ``with_html`` carries each row's HTML table row.
    """
    req_cols = [c for c in rows.columns if c not in ("section", "hour", *SECTION_COLUMNS)]
    fields = [F.col("hour"), F.struct(*SECTION_COLUMNS).alias("r")]
    if with_html:
        fields.append(_html_row().alias("html"))
    item = F.struct(*fields)
    aggs = []
    for s in SECTIONS:
        in_s = (F.col("section") == s) & F.col("hour").isNotNull()
        aggs.append(F.sort_array(F.collect_list(F.when(in_s, item))).alias(f"sec_{s}"))
        if with_summary:
            aggs += [
                F.count(F.when(in_s, F.lit(1))).alias(f"n_{s}"),
                F.avg(F.when(in_s, F.col("sunshine"))).alias(f"sun_{s}"),
                F.avg(F.when(in_s, F.least(F.col("cloudcover"), F.lit(8)))).alias(f"cloud_{s}"),
                F.max(F.when(in_s, F.col("rain"))).alias(f"rain_{s}"),
                F.max(F.when(in_s, F.col("snow"))).alias(f"snow_{s}"),
                F.max(F.when(in_s, F.col("fog"))).alias(f"fog_{s}"),
                F.max(F.when(in_s, F.col("thunderstorm"))).alias(f"thunder_{s}"),
                F.min(F.when(in_s, F.col("temperature"))).alias(f"tmin_{s}"),
                F.max(F.when(in_s, F.col("temperature"))).alias(f"tmax_{s}"),
                F.max(F.when(in_s, F.col("beaufort"))).alias(f"bmax_{s}"),
            ]
    out = rows.groupBy(*req_cols).agg(*aggs)
    # field access on an array of structs is a native expression (no lambda)
    return out.withColumns({f"rows_{s}": F.col(f"sec_{s}").getField("r") for s in SECTIONS})


def internal_columns(df: DataFrame) -> list[str]:
    prefixes = ("sec_", "n_", "sun_", "cloud_", "rain_", "snow_", "fog_", "thunder_", "tmin_", "tmax_", "bmax_")
    return [c for c in df.columns if c.startswith(prefixes) and c.split("_", 1)[1] in SECTIONS]


# --- text -----------------------------------------------------------------------

def fog_then_sun_flag(sec: Column) -> Column:
    """Fog at some hour and more sunshine at a later hour of the section: one
    pass from the last hour back, carrying the largest later sunshine."""
    init = F.struct(F.lit(None).cast("int").alias("m"), F.lit(False).alias("f"))
    return F.aggregate(
        F.reverse(sec),
        init,
        lambda acc, x: F.struct(
            F.greatest(acc["m"], x["r"]["sunshine"]).alias("m"),
            (acc["f"] | F.coalesce((x["r"]["fog"] == 1) & (acc["m"] > x["r"]["sunshine"]), F.lit(False))).alias("f"),
        ),
        lambda acc: acc["f"],
    )


def section_sky(section: str) -> Column:
    """Sky wording of one section from its summary columns (rules as in
    ``weather.sky_condition``)."""
    from nimbus.operators.weather import SKY_WORDS as w

    s, n = F.col(f"sun_{section}"), F.col(f"cloud_{section}")
    rain, snow, fog, thunder = (F.col(f"{c}_{section}") == 1 for c in ("rain", "snow", "fog", "thunder"))
    some_sun, low_sun = s >= 1, s <= 2
    high_cloud, some_cloud = n >= 7, n >= 1
    return (
        F.when(thunder & rain & some_sun & some_cloud, w[0])
        .when(thunder & some_sun & some_cloud, w[1])
        .when(snow & rain & low_sun, w[2])
        .when(snow & some_sun, w[3])
        .when(snow, w[4])
        .when(fog_then_sun_flag(F.col(f"sec_{section}")), w[5])
        .when(fog, w[6])
        .when(rain & (s > 2) & (s < 7) & high_cloud, w[7])
        .when(rain & low_sun, w[8])
        .when(rain, w[9])
        .when(s >= 7, w[10])
        .when((s == 0) & high_cloud, w[11])
        .when(low_sun & high_cloud, w[12])
        .when(some_sun & some_cloud, w[13])
        .otherwise(w[14])
    )


def section_text(section: str) -> Column:
    """'Morning: Sunny, 3 to 7 degrees, Gentle Breeze.' or 'Morning: No data.'"""
    title = SECTION_TITLES[section]
    wind = F.coalesce(codes.beaufort_name(F.col(f"bmax_{section}")), F.lit("no wind reading"))
    temp = F.concat(
        F.coalesce(F.col(f"tmin_{section}").cast("string"), F.lit("None")), F.lit(" to "),
        F.coalesce(F.col(f"tmax_{section}").cast("string"), F.lit("None")), F.lit(" degrees"),
    )
    text = F.concat(F.lit(f"{title}: "), section_sky(section), F.lit(", "), temp, F.lit(", "), wind, F.lit("."))
    return F.when(F.col(f"n_{section}") == 0, F.lit(f"{title}: {NO_DATA}.")).otherwise(text)


def template_report(df: DataFrame) -> Column:
    """G3 default: one deterministic sentence per section from the summaries
    (``assemble_report_rows(..., with_summary=True)``)."""
    return F.concat_ws(" ", *[section_text(s) for s in SECTIONS])


def report_status(df: DataFrame) -> Column:
    """Unknown location / no data at all / some sections empty / ok."""
    sizes = [F.size(f"rows_{s}") for s in SECTIONS]
    total = sizes[0]
    for x in sizes[1:]:
        total = total + x
    some_empty = F.lit(False)
    for x in sizes:
        some_empty = some_empty | (x == 0)
    return (
        F.when(F.col("station").isNull(), "unknown_location")
        .when(total == 0, "no_data")
        .when(some_empty, "partial")
        .otherwise("ok")
    )


def generate(df: DataFrame, fn: Callable[[pd.DataFrame], pd.Series] | None = None) -> DataFrame:
    """Add ``report`` text.

    ``fn`` is the caller's text generator (e.g. a model client): it receives
    batches of records as pandas frames and returns one string per row; it runs
    in Arrow batches through ``mapInPandas``. Without ``fn`` the native template
    is used and nothing leaves the JVM.
    """
    if fn is None:
        return df.withColumn("report", template_report(df))
    schema = T.StructType(df.schema.fields + [T.StructField("report", T.StringType(), True)])

    def run(batches):
        for pdf in batches:
            pdf = pdf.copy()
            pdf["report"] = list(fn(pdf))
            yield pdf

    return df.mapInPandas(run, schema)


# --- prompts and rendering ------------------------------------------------------------

DEFAULT_GUIDANCE = (
    "Describe the weather of this period for a general audience: sky, temperature "
    "range and wind, in at most three sentences."
)


#: A reading that is missing shows as null in JSON text.
KEEP_NULLS = {"ignoreNullFields": "false"}


def build_prompts(df: DataFrame, guidance: str = DEFAULT_GUIDANCE) -> DataFrame:
    """One prompt per section (heading, part, guidance, rows) and a combined prompt."""
    parts = {"morning": "Morning", "afternoon": "Afternoon", "evening": "Evening", "night": "Night", "tomorrow": "full day"}
    out = df
    for s in SECTIONS:
        day = "next_date" if s == "tomorrow" else "date"
        heading = codes.request_text("location", day, F.lit(parts[s]))
        out = out.withColumn(
            f"prompt_{s}",
            F.concat_ws("\n", heading, F.lit(guidance),
                        F.col(f"json_{s}") if f"json_{s}" in df.columns else F.to_json(F.col(f"rows_{s}"), KEEP_NULLS)),
        )
    return out.withColumn(
        "prompt",
        F.concat_ws("\n\n", *[F.concat(F.lit(f"{SECTION_TITLES[s]}:\n"), F.col(f"prompt_{s}")) for s in SECTIONS]),
    )


def to_markdown(question: Column, answer: Column, query: Column, data: Column | None = None) -> Column:
    """Question / answer / query (and optional data) as one Markdown text."""
    parts = [
        F.lit("## Question\n> "), question,
        F.lit("\n\n## Answer\n"), F.coalesce(answer, F.lit(NO_DATA)),
        F.lit("\n\n## Query\n```\n"), F.coalesce(query, F.lit("")), F.lit("\n```\n"),
    ]
    if data is not None:
        parts += [F.lit("\n## Data\n"), F.coalesce(data, F.lit("")), F.lit("\n")]
    return F.concat(*parts)


def _cell(v: Column) -> Column:
    return F.concat(F.lit("<td>"), F.coalesce(v.cast("string"), F.lit(NULL_TEXT)), F.lit("</td>"))


def _table(section: str, body: Column) -> Column:
    head = "".join(f"<th>{h}</th>" for h in TABLE_HEADINGS)
    return F.concat(F.lit(TABLE_OPEN.format(title=SECTION_TITLES[section], head=head)), body, F.lit(TABLE_END))


def _page(tables: list[Column]) -> Column:
    return F.concat(
        F.lit(PAGE_LOCATION), F.coalesce(F.col("location"), F.lit(NULL_TEXT)),
        F.lit(PAGE_DATE), F.col("heading"),
        F.lit(PAGE_REPORT), F.coalesce(F.col("report"), F.lit(NULL_TEXT)), F.lit(PAGE_REPORT_END),
        *tables, F.lit(PAGE_END),
    )


def section_table(section: str, sec: Column) -> Column:
    """One section as an HTML table with the 11 fixed headings; the rows'
    HTML was built before the aggregation, so this is a native join."""
    return _table(section, F.array_join(sec.getField("html"), ""))


def to_html(df: DataFrame) -> Column:
    """The whole report page (location, heading, report text, five tables).
    Needs ``assemble_report_rows(..., with_html=True)``."""
    return _page([section_table(s, F.col(f"sec_{s}")) for s in SECTIONS])


def data_uri(html: Column) -> Column:
    """percent-encode into a ``data:text/html`` URI, byte-equal to Python's
    ``urllib.parse.quote`` (safe '/'): the JVM encoder writes '+' for blank and
    leaves '*' alone, and encodes '~' and '/'; those four are put right."""
    enc = F.url_encode(html)
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    enc = F.replace(enc, F.lit("%7E"), F.lit("~"))
    enc = F.replace(enc, F.lit("%2F"), F.lit("/"))
    return F.concat(F.lit(DATA_URI_PREFIX), enc)


def link(uri: Column) -> Column:
    return F.concat(F.lit(LINK[0]), uri, F.lit(LINK[1]))


def external_id(request_id: Column, suffix: str = DEFAULT_BATCH_SUFFIX) -> Column:
    """``{request_id}_{suffix}``; ids come from the requests, so no global sort."""
    return F.concat(request_id.cast("string"), F.lit("_"), F.lit(suffix))


# --- station-day bundles --------------------------------------------------------------

PART_OF_SECTION = {"morning": "Morning", "afternoon": "Afternoon", "evening": "Evening", "night": "Night"}


def day_bundles(obs: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Observations folded to one row per ``(station, date)``: what a report of that day shows.

    For every section ``arr_<s>`` (sorted ``struct<hour, r>``), ``body_<s>`` (the HTML table
    body), ``json_<s>`` and ``text_<s>`` (the section sentence). A reading counts for its own
    day, in the section of its part, and for the day before, in section ``tomorrow``: one pass
    and one aggregation. ``keys`` (station, date), when given, restricts the fold to the days
    some request asks for (a left-semi join, so a few hundred requests do not fold an archive).

    The output has one row per station-day, so what requests later join to is bounded by the
    calendar, not by the data volume, and a day that many requests share is folded, rendered
    and worded once.
    """
    day = lambda d, later: F.struct(d.alias("date"), F.lit(later).alias("later"))
    days = F.array(day(F.col("date"), False), day(codes.date_to_int(F.date_sub("obs_date", 1)), True))
    rows = obs.select("station", F.explode(days).alias("_d"), "hour", *SECTION_COLUMNS).select("station", "_d.date", "_d.later", "hour", *SECTION_COLUMNS)
    if keys is not None:
        rows = rows.join(keys, ["station", "date"], "left_semi")
    item = F.struct(F.col("hour"), F.struct(*SECTION_COLUMNS).alias("r"))
    aggs = []
    for s in SECTIONS:
        cond = F.col("later") if s == "tomorrow" else ~F.col("later") & (F.col("Time_Category") == PART_OF_SECTION[s])
        pick = lambda c: F.when(cond, c)  # noqa: B023, E731
        aggs += [
            F.collect_list(pick(item)).alias(f"arr_{s}"),
            F.count(pick(F.lit(1))).alias(f"n_{s}"),
            F.avg(pick(F.col("sunshine"))).alias(f"sun_{s}"),
            F.avg(pick(F.least(F.col("cloudcover"), F.lit(8)))).alias(f"cloud_{s}"),
            F.max(pick(F.col("rain"))).alias(f"rain_{s}"),
            F.max(pick(F.col("snow"))).alias(f"snow_{s}"),
            F.max(pick(F.col("fog"))).alias(f"fog_{s}"),
            F.max(pick(F.col("thunderstorm"))).alias(f"thunder_{s}"),
            F.min(pick(F.col("temperature"))).alias(f"tmin_{s}"),
            F.max(pick(F.col("temperature"))).alias(f"tmax_{s}"),
            F.max(pick(F.col("beaufort"))).alias(f"bmax_{s}"),
        ]
    b = rows.groupBy("station", "date").agg(*aggs)
    b = b.withColumns({f"arr_{s}": F.sort_array(F.col(f"arr_{s}")) for s in SECTIONS})
    out = {}
    for s in SECTIONS:
        # rendered from the rows, so a bundle carries them once until something asks for more
        out[f"body_{s}"] = F.array_join(F.transform(f"arr_{s}", lambda x: _html_row(x["r"])), "")
        out[f"json_{s}"] = F.to_json(F.col(f"arr_{s}").getField("r"), KEEP_NULLS)
        out[f"text_{s}"] = _section_text_of(s, SECTION_TITLES[s])
    b = b.withColumns(out)
    return b.select("station", "date", *[f"{c}_{s}" for s in SECTIONS for c in ("arr", "body", "text", "json")])


def _section_text_of(p: str, title: str) -> Column:
    from nimbus.operators.weather import SKY_WORDS as w

    s, n = F.col(f"sun_{p}"), F.col(f"cloud_{p}")
    rain, snow, fog, thunder = (F.col(f"{c}_{p}") == 1 for c in ("rain", "snow", "fog", "thunder"))
    some_sun, low_sun = s >= 1, s <= 2
    high_cloud, some_cloud = n >= 7, n >= 1
    sky = (
        F.when(thunder & rain & some_sun & some_cloud, w[0])
        .when(thunder & some_sun & some_cloud, w[1])
        .when(snow & rain & low_sun, w[2])
        .when(snow & some_sun, w[3])
        .when(snow, w[4])
        .when(fog_then_sun_flag(F.col(f"arr_{p}")), w[5])
        .when(fog, w[6])
        .when(rain & (s > 2) & (s < 7) & high_cloud, w[7])
        .when(rain & low_sun, w[8])
        .when(rain, w[9])
        .when(s >= 7, w[10])
        .when((s == 0) & high_cloud, w[11])
        .when(low_sun & high_cloud, w[12])
        .when(some_sun & some_cloud, w[13])
        .otherwise(w[14])
    )
    wind = F.coalesce(codes.beaufort_name(F.col(f"bmax_{p}")), F.lit("no wind reading"))
    temp = F.concat(
        F.coalesce(F.col(f"tmin_{p}").cast("string"), F.lit("None")), F.lit(" to "),
        F.coalesce(F.col(f"tmax_{p}").cast("string"), F.lit("None")), F.lit(" degrees"),
    )
    text = F.concat(F.lit(f"{title}: "), sky, F.lit(", "), temp, F.lit(", "), wind, F.lit("."))
    return F.when(F.col(f"n_{p}") == 0, F.lit(f"{title}: {NO_DATA}.")).otherwise(text)


def report_records(
    requests: DataFrame,
    obs: DataFrame,
    n_requests: int | None = None,
    broadcast_bytes: int = 64 << 20,
    prune: bool | None = None,
    stations: DataFrame | None = None,
) -> DataFrame:
    """J1 + J2 + A13 over day bundles: each request takes its day's bundle (five
    sections) by one equi left join on ``(station, date)``. Output: the request columns,
    ``sec_<section>`` (sorted ``struct<hour, r>``), ``rows_<section>`` (the 11 columns),
    ``text_<section>``, ``json_<section>`` and ``body_<section>``.

    ``stations`` (station) names all stations a request can have, at most ``MAX_STATIONS``,
    which is checked; the observations of others are not folded. ``prune`` (default: when
    ``n_requests`` is known and small) folds only the days requests need; the request keys
    are then broadcast into a semi join. Otherwise the bundle side is whatever size the
    calendar gives, and AQE broadcasts it when it measures it small, else both sides are
    shuffled on ``(station, date)`` (a hot day is one bundle row, so skew stays on the
    streamed request side, where AQE can split it).
    """
    d = codes.date_to_int("date")
    if stations is not None:
        known = [r[0] for r in stations.select("station").distinct().limit(MAX_STATIONS + 1).collect()]
        if len(known) > MAX_STATIONS:
            raise ValueError(f"more than {MAX_STATIONS} stations")
        obs = obs.where(F.col("station").isin(known))
    if prune is None:
        prune = n_requests is not None and n_requests * _SECTION_ROW_BYTES <= broadcast_bytes
    keys = None
    if prune:
        keys = F.broadcast(requests.where(F.col("station").isNotNull()).select("station", d.alias("date")).distinct())
    b = day_bundles(obs, keys).withColumnsRenamed({"station": "_station", "date": "_date"})
    rec = requests.join(b, (requests["station"] == b["_station"]) & (d == b["_date"]), "left")
    item_type = b.schema["arr_tomorrow"].dataType
    cols = {}
    for sct in SECTIONS:
        arr = F.coalesce(F.col(f"arr_{sct}"), F.array().cast(item_type))
        title = SECTION_TITLES[sct]
        cols[f"sec_{sct}"] = arr
        cols[f"rows_{sct}"] = arr.getField("r")
        cols[f"text_{sct}"] = F.coalesce(F.col(f"text_{sct}"), F.lit(f"{title}: {NO_DATA}."))
        cols[f"body_{sct}"] = F.coalesce(F.col(f"body_{sct}"), F.lit(""))
        cols[f"json_{sct}"] = F.coalesce(F.col(f"json_{sct}"), F.lit("[]"))
    return rec.withColumns(cols).drop("_station", "_date", *[f"arr_{sct}" for sct in SECTIONS])


def render(rec: DataFrame, fn: Callable[[pd.DataFrame], pd.Series] | None = None,
           suffix: str = DEFAULT_BATCH_SUFFIX) -> DataFrame:
    """G3 + G4 + G6 + F14 on report records: text, status, page, external id."""
    if fn is None:
        rec = rec.withColumn("report", F.concat_ws(" ", *[F.col(f"text_{s}") for s in SECTIONS]))
    else:
        rec = generate(rec.drop(*[f"sec_{s}" for s in SECTIONS]), fn)
    page = _page([_table(s, F.col(f"body_{s}")) for s in SECTIONS])
    rec = rec.withColumn("status", report_status(rec)).withColumn("html_report", page)
    rec = rec.withColumn("external_id", external_id(F.col("request_id"), suffix))
    drop = [f"{c}_{s}" for s in SECTIONS for c in ("sec", "text", "body", "json")]
    return rec.drop(*drop)


def report_dataset(
    requests: DataFrame,
    obs: DataFrame,
    fn: Callable[[pd.DataFrame], pd.Series] | None = None,
    suffix: str = DEFAULT_BATCH_SUFFIX,
    n_requests: int | None = None,
    stations: DataFrame | None = None,
) -> DataFrame:
    """The whole report record per request, lazily (sinks write it).
    Columns: the request columns, ``rows_<section>`` x5, ``report``, ``status``,
    ``html_report``, ``external_id``."""
    return render(report_records(requests, obs, n_requests=n_requests, stations=stations), fn, suffix)
