"""Registered annotation queries.

No annotation export is among the driver tables, so the export is built from
``labels`` (doc_id, quality, toxic): one NDJSON line per labels row, with
every shape the flattener must handle (two projects, a project without labels,
missing consensus score, a label without annotations, answers nested under a
radio answer and directly, checklists, a question answered twice, an unnamed
node, a null radio answer, a null annotator, broken and empty lines). The
oracle computes the expected flat table straight from ``labels``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions.text import rating
from nimbus.operators import agreement, labels, ratings
from nimbus.plans.registry import register
from nimbus.sources.tables import load

Q = {v: k for k, v in labels.QUESTION_COLUMNS.items()}  # column name -> question text
EXCLUDED = ["annotator1@example.org", "annotator2@example.org"]
MASKED = ["annotator3@example.org"]


def _js(x: Column) -> Column:
    """JSON string literal of a text column."""
    esc = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), esc, F.lit('"'))


def _jl(text: str) -> Column:
    return _js(F.lit(text))


def _s(c: Column) -> Column:
    return c.cast("string")


def export_lines(labels_df: DataFrame) -> DataFrame:
    """One NDJSON text line per ``labels`` row (column ``value``)."""
    d, q, t = F.col("doc_id"), F.col("quality"), F.col("toxic")
    rating_text = (
        F.when(d % 4 == 0, F.concat(_s(1 + d % 5), F.lit(" - goed")))
        .when(d % 4 == 1, F.concat(F.lit("een "), _s(1 + d % 5), F.lit("/5")))
        .when(d % 4 == 2, F.concat(F.lit("score "), _s(6 + d % 5)))
        .otherwise(_s(1 + d % 5))
    )
    node1 = F.concat(
        F.lit('{"name": '), _jl(Q["MorningInfoGiven"]),
        F.lit(', "radio_answer": {"name": '), _js(F.when(q == 1, F.lit("Ja")).otherwise(F.lit("Nee"))),
        F.lit(', "classifications": [{"name": '), _jl(Q["MorningCorrectness"]),
        F.lit(', "radio_answer": {"name": '), _js(rating_text), F.lit("}}]}}"),
    )
    node2 = F.concat(
        F.lit('{"name": '), _jl(Q["MorningWeatherInfo"]), F.lit(', "checklist_answers": '),
        F.when(t == 1, F.lit('[{"name": "zon"}, {"name": "regen"}]')).otherwise(F.lit('[{"name": "wolken"}]')),
        F.lit("}"),
    )
    node3 = F.concat(
        F.lit('{"name": '), _jl(Q["Satisfaction"]), F.lit(', "radio_answer": {"name": '),
        _js(_s(1 + (d + q) % 5)), F.lit("}}"),
    )
    node3b = F.when(
        d % 3 == 0,
        F.concat(F.lit('{"name": '), _jl(Q["Satisfaction"]), F.lit(', "radio_answer": {"name": '),
                 _js(_s(1 + (d + 2) % 5)), F.lit("}}")),
    )
    node4 = F.concat(
        F.lit('{"name": "", "radio_answer": {"name": "x", "classifications": [{"name": '),
        _jl(Q["LanguageClarity"]), F.lit(', "radio_answer": {"name": "5"}}]}}'),
    )
    node5 = F.concat(
        F.lit('{"name": '), _jl(Q["ReportStructureGood"]),
        F.lit(', "radio_answer": null, "classifications": [{"name": '), _jl(Q["AfternoonCorrectness"]),
        F.lit(', "radio_answer": {"name": '), _js(_s(1 + d % 3)), F.lit("}}]}"),
    )
    node6 = F.when(
        d % 2 == 0,
        F.concat(F.lit('{"name": '), _jl(Q["EveningInfoGiven"]),
                 F.lit(', "radio_answer": {"name": "Ja"}, "checklist_answers": [{"name": "a"}, {"name": "b"}]}')),
    )
    classifications = F.concat(F.lit("["), F.concat_ws(", ", node1, node2, node3, node3b, node4, node5, node6), F.lit("]"))
    annotations = F.when(d % 10 != 9, F.concat(F.lit('"annotations": {"classifications": '), classifications, F.lit("}")))
    perf = F.when(
        d % 5 != 0,
        F.concat(F.lit('"performance_details": {"consensus_score": '), _s((q + t) / F.lit(2.0)), F.lit("}")),
    )
    created_by = F.when(d % 11 == 0, F.lit("null")).otherwise(
        _js(F.concat(F.lit("annotator"), _s(d % 6), F.lit("@example.org")))
    )
    created_at = F.concat(F.lit("2024-02-"), F.lpad(_s(1 + d % 28), 2, "0"), F.lit("T10:00:00Z"))
    label = F.concat(
        F.lit("{"),
        F.concat_ws(
            ", ",
            F.concat(F.lit('"id": '), _js(F.concat(F.lit("lb-"), _s(d)))),
            F.concat(F.lit('"label_details": {"created_at": '), _js(created_at), F.lit(', "created_by": '), created_by, F.lit("}")),
            perf,
            annotations,
        ),
        F.lit("}"),
    )
    project = F.concat(
        F.lit('"p'), _s(d % 2), F.lit('": {"name": '), _js(F.concat(F.lit("Weather "), _s(d % 2))),
        F.lit(', "labels": ['), label, F.lit("]}"),
    )
    extra = F.when(d % 4 == 3, F.lit(', "p9": {"name": "Empty", "labels": []}')).otherwise(F.lit(""))
    line = F.concat(
        F.lit('{"data_row": {"id": '), _js(F.concat(F.lit("dr-"), _s(F.floor(d / 3)))), F.lit('}, "projects": {'),
        project, extra, F.lit("}}"),
    )
    value = (
        F.when(d % 13 == 0, F.concat(F.lit('{"data_row": {"id": "dr-'), _s(d), F.lit('"')))
        .when(d % 17 == 0, F.lit(""))
        .otherwise(line)
    )
    return labels_df.select(value.alias("value"))


def label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = labels.parse_lines(export_lines(load(spark, sf_dir, "labels")))
    # DuckDB has no such map; tests cover the column
    return labels.with_ratings(labels.flatten_labels(good)).drop(labels.OTHER_QUESTIONS)


# --- SQL ----------------------------------------------------------------------------

_STR_COLS = [c for c in labels.QUESTION_COLUMNS.values() if c not in labels.RATING_COLUMNS]


def _expected_answers() -> dict[str, str]:
    ans = {c: "CAST(NULL AS VARCHAR)" for c in _STR_COLS}
    ans.update({c: "CAST(NULL AS INTEGER)" for c in labels.RATING_COLUMNS})
    ans["MorningInfoGiven"] = "CASE WHEN quality = 1 THEN 'Ja' ELSE 'Nee' END"
    ans["MorningCorrectness"] = "CAST(CASE WHEN doc_id % 4 = 2 THEN NULL ELSE 1 + doc_id % 5 END AS INTEGER)"
    ans["MorningWeatherInfo"] = "CASE WHEN toxic = 1 THEN 'zon, regen' ELSE 'wolken' END"
    ans["Satisfaction"] = "CAST(CASE WHEN doc_id % 3 = 0 THEN 1 + (doc_id + 2) % 5 ELSE 1 + (doc_id + quality) % 5 END AS INTEGER)"
    ans["AfternoonCorrectness"] = "CAST(1 + doc_id % 3 AS INTEGER)"
    ans["EveningInfoGiven"] = "CASE WHEN doc_id % 2 = 0 THEN 'a, b' END"
    return ans


def _label_flat_sql() -> str:
    ans = _expected_answers()
    cols = [
        "'dr-' || CAST(doc_id // 3 AS VARCHAR) AS DataRowID",
        "'p' || CAST(doc_id % 2 AS VARCHAR) AS ProjectID",
        "'Weather ' || CAST(doc_id % 2 AS VARCHAR) AS ProjectName",
        "'lb-' || CAST(doc_id AS VARCHAR) AS LabelID",
        "'2024-02-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') || 'T10:00:00Z' AS LabelCreatedAt",
        "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE 'annotator' || CAST(doc_id % 6 AS VARCHAR) || '@example.org' END AS LabelCreatedBy",
        "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE (quality + toxic) / 2.0 END AS ConsensusScore",
    ]
    for c in labels.QUESTION_COLUMNS.values():
        cols.append(f"CASE WHEN doc_id % 10 = 9 THEN NULL ELSE {ans[c]} END AS {c}")
    return "SELECT " + ",\n  ".join(cols) + "\nFROM labels WHERE doc_id % 13 <> 0 AND doc_id % 17 <> 0"


LABEL_FLAT_SQL = _label_flat_sql()


def alpha_sql(src: str, columns: list[str], unit: str, annotator: str, order: str, digits: int = 9) -> str:
    """Krippendorff's alpha (nominal) in DuckDB SQL over ``src`` (a subquery)."""
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({unit} AS VARCHAR) AS unit, CAST({annotator} AS VARCHAR) AS annotator, "
        f"{order} AS ord, CAST({c} AS VARCHAR) AS value FROM ({src}) s"
        for c in columns
    )
    cols = ", ".join(f"('{c}')" for c in columns)
    return f"""WITH long AS (SELECT * FROM ({long}) x WHERE value IS NOT NULL),
nv AS (SELECT col, count(DISTINCT value) AS n_values FROM long GROUP BY col),
one AS (SELECT col, unit, annotator, value FROM (
  SELECT *, row_number() OVER (PARTITION BY col, unit, annotator ORDER BY ord, value) AS rn
  FROM long WHERE annotator IS NOT NULL) y WHERE rn = 1),
counts AS (SELECT col, unit, value, CAST(count(*) AS DOUBLE) AS n_uc FROM one GROUP BY col, unit, value),
pu AS (SELECT col, unit, sum(n_uc) AS m_u, sum(n_uc * n_uc) AS sq_u FROM counts GROUP BY col, unit),
kept AS (SELECT * FROM pu WHERE m_u >= 2),
obs AS (SELECT col, sum(m_u) AS N, sum((m_u * m_u - sq_u) / (m_u - 1)) AS D, count(*) AS n_units FROM kept GROUP BY col),
nc AS (SELECT c.col, c.value, sum(c.n_uc) AS n_c FROM counts c JOIN kept k ON c.col = k.col AND c.unit = k.unit
       GROUP BY c.col, c.value),
exp AS (SELECT col, sum(n_c * n_c) AS S FROM nc GROUP BY col),
res AS (
  SELECT nv.col, COALESCE(obs.n_units, 0) AS n_units, nv.n_values,
    CASE WHEN nv.n_values < 2 THEN 'not_enough_values'
         WHEN obs.N IS NULL OR obs.N < 2 OR (obs.N * obs.N - exp.S) = 0 THEN 'insufficient_data'
         ELSE 'ok' END AS status,
    1 - (obs.D / obs.N) / ((obs.N * obs.N - exp.S) / (obs.N * (obs.N - 1))) AS a
  FROM nv LEFT JOIN obs ON nv.col = obs.col LEFT JOIN exp ON nv.col = exp.col)
SELECT cl.col AS "column", CAST(COALESCE(res.n_units, 0) AS BIGINT) AS n_units,
  CAST(COALESCE(res.n_values, 0) AS BIGINT) AS n_values,
  CASE WHEN res.status = 'ok' THEN round_even(res.a, {digits}) END AS alpha,
  COALESCE(res.status, 'not_enough_values') AS status
FROM (VALUES {cols}) cl(col) LEFT JOIN res ON cl.col = res.col"""


# --- queries -------------------------------------------------------------------------

@register("label_flatten", "S3 N1 N2 N3 N4 N5 P2 P17 F11 P4", LABEL_FLAT_SQL)
def q_label_flatten(spark, sf_dir):
    return label_table(spark, sf_dir)


@register(
    "label_bad_lines", "S3",
    "SELECT CASE WHEN doc_id % 13 = 0 THEN '{\"data_row\": {\"id\": \"dr-' || CAST(doc_id AS VARCHAR) || '\"' ELSE '' END AS value "
    "FROM labels WHERE doc_id % 13 = 0 OR doc_id % 17 = 0",
)
def q_label_bad_lines(spark, sf_dir):
    _, bad = labels.parse_lines(export_lines(load(spark, sf_dir, "labels")))
    return bad.select("value")


@register(
    "rating_extract", "F11 P4",
    """SELECT event_id, txt AS answer,
      TRY_CAST(NULLIF(regexp_extract(txt, '\\b([1-5])\\b', 1), '') AS INTEGER) AS rating FROM (
      SELECT event_id, CASE event_id % 6
        WHEN 0 THEN CAST(k % 7 AS VARCHAR) || ' - goed'
        WHEN 1 THEN 'een ' || CAST(k % 9 AS VARCHAR) || '/5'
        WHEN 2 THEN 'score ' || CAST(k % 12 AS VARCHAR)
        WHEN 3 THEN 'x' || CAST(k % 5 AS VARCHAR)
        WHEN 4 THEN ''
        ELSE event_type || ' ' || CAST(k % 6 AS VARCHAR) END AS txt
      FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e) t""",
)
def q_rating_extract(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    e = F.col("event_id") % 6
    txt = (
        F.when(e == 0, F.concat(_s(k % 7), F.lit(" - goed")))
        .when(e == 1, F.concat(F.lit("een "), _s(k % 9), F.lit("/5")))
        .when(e == 2, F.concat(F.lit("score "), _s(k % 12)))
        .when(e == 3, F.concat(F.lit("x"), _s(k % 5)))
        .when(e == 4, F.lit(""))
        .otherwise(F.concat(F.col("event_type"), F.lit(" "), _s(k % 6)))
    )
    return ev.select("event_id", txt.alias("answer")).withColumn("rating", rating("answer"))


@register(
    "exclude_annotators", "P13",
    f"SELECT LabelID, LabelCreatedBy FROM ({LABEL_FLAT_SQL}) f "
    f"WHERE LabelCreatedBy IS NULL OR LabelCreatedBy NOT IN ({', '.join(repr(x) for x in EXCLUDED)})",
)
def q_exclude_annotators(spark, sf_dir):
    return labels.exclude_annotators(label_table(spark, sf_dir), EXCLUDED).select("LabelID", "LabelCreatedBy")


@register(
    "mask_annotators", "P14",
    f"SELECT LabelID, LabelCreatedBy, CASE WHEN LabelCreatedBy NOT IN ({', '.join(repr(x) for x in MASKED)}) "
    f"THEN LabelCreatedBy END AS annotators FROM ({LABEL_FLAT_SQL}) f",
)
def q_mask_annotators(spark, sf_dir):
    return labels.mask_annotators(label_table(spark, sf_dir), MASKED).select("LabelID", "LabelCreatedBy", "annotators")


_MEANS = ", ".join(f"round_even(avg({c}), 9) AS avg_{c}" for c in labels.MEAN_COLUMNS)
_CEILS = ", ".join(f"CAST(ceil(avg({c})) AS BIGINT) AS avg_{c}" for c in labels.MEAN_COLUMNS)


@register(
    "rating_means", "A1 P13",
    f"SELECT {_MEANS}, round_even(avg(ConsensusScore), 9) AS avg_ConsensusScore FROM ({LABEL_FLAT_SQL}) f "
    f"WHERE LabelCreatedBy IS NULL OR LabelCreatedBy NOT IN ({', '.join(repr(x) for x in EXCLUDED)})",
)
def q_rating_means(spark, sf_dir):
    flat = labels.exclude_annotators(label_table(spark, sf_dir), EXCLUDED)
    return ratings.rating_means(flat, labels.MEAN_COLUMNS)


@register(
    "rating_means_ceil", "A2",
    f"SELECT {_CEILS}, round_even(avg(ConsensusScore), 9) AS avg_ConsensusScore FROM ({LABEL_FLAT_SQL}) f",
)
def q_rating_means_ceil(spark, sf_dir):
    return ratings.rating_means(label_table(spark, sf_dir), labels.MEAN_COLUMNS, ceil=True)


def _share_sql(col: str, table: str = "labels") -> str:
    return f"""SELECT '{col}' AS question, {col} AS value, CAST(count(*) AS BIGINT) AS n,
      round_even(count(*) * 100.0 / (SELECT count({col}) FROM {table}), 9) AS pct,
      printf('%.2f%%', round_even(count(*) * 100.0 / (SELECT count({col}) FROM {table}), 2)) AS pct_label
    FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}"""


@register("value_share", "A3 F15 R4", _share_sql("quality"))
def q_value_share(spark, sf_dir):
    return ratings.value_share(load(spark, sf_dir, "labels"), "quality")


@register(
    "answer_matrix", "A4",
    """WITH l AS (SELECT 'quality' AS question, CAST(quality AS VARCHAR) AS answer FROM labels WHERE quality IS NOT NULL
                 UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR) FROM labels WHERE toxic IS NOT NULL),
      c AS (SELECT question, answer, count(*) AS n FROM l GROUP BY question, answer),
      s AS (SELECT question, answer, n * 100.0 / sum(n) OVER (PARTITION BY question) AS pct FROM c)
    SELECT question, COALESCE(max(CASE WHEN answer = '0' THEN round_even(pct, 9) END), 0.0) AS pct_0,
      COALESCE(max(CASE WHEN answer = '1' THEN round_even(pct, 9) END), 0.0) AS pct_1,
      COALESCE(max(CASE WHEN answer = '2' THEN round_even(pct, 9) END), 0.0) AS pct_2
    FROM s GROUP BY question""",
)
def q_answer_matrix(spark, sf_dir):
    # the SQL has the listed answers only; the labels hold no other
    return ratings.answer_matrix(load(spark, sf_dir, "labels"), ["quality", "toxic"], ["0", "1", "2"]).drop("other_pct")


@register(
    "max_share", "A5",
    """WITH l AS (SELECT 'quality' AS question, CAST(quality AS VARCHAR) AS answer FROM labels WHERE quality IS NOT NULL
                 UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR) FROM labels WHERE toxic IS NOT NULL),
      c AS (SELECT question, answer, count(*) AS n FROM l GROUP BY question, answer)
    SELECT round_even(max(n * 100.0 / t), 9) AS max_pct FROM c JOIN (SELECT question, sum(n) AS t FROM c GROUP BY question) q USING (question)""",
)
def q_max_share(spark, sf_dir):
    return ratings.max_share(load(spark, sf_dir, "labels"), ["quality", "toxic"])


_LI_SRC = "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem"
_LI_MASKED = ("SELECT l_orderkey, CASE WHEN l_linenumber NOT IN (1, 2) THEN l_linenumber END AS l_linenumber, "
              "l_returnflag FROM lineitem")


@register("alpha", "A6 A7 W3", alpha_sql(_LI_SRC, ["l_returnflag"], "l_orderkey", "l_linenumber", "NULL"))
def q_alpha(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return agreement.krippendorff_alpha(li, "l_orderkey", "l_linenumber", ["l_returnflag"], digits=9)


@register("alpha_masked", "A8 P14", alpha_sql(_LI_MASKED, ["l_returnflag"], "l_orderkey", "l_linenumber", "NULL"))
def q_alpha_masked(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    masked = li.withColumn("l_linenumber", F.when(~F.col("l_linenumber").isin(1, 2), F.col("l_linenumber")))
    return agreement.krippendorff_alpha(masked, "l_orderkey", "l_linenumber", ["l_returnflag"], digits=9)


@register(
    "label_alpha", "A6 A7 W3",
    alpha_sql(LABEL_FLAT_SQL, labels.RATING_COLUMNS, "DataRowID", "LabelCreatedBy",
              "struct_pack(a := LabelCreatedAt, b := LabelID)"),
)
def q_label_alpha(spark, sf_dir):
    flat = label_table(spark, sf_dir)
    return agreement.krippendorff_alpha(
        flat, "DataRowID", "LabelCreatedBy", labels.RATING_COLUMNS,
        order=F.struct("LabelCreatedAt", "LabelID"), digits=9,
    )


def alpha_interval_sql(src: str, columns: list[str], unit: str, annotator: str, order: str, digits: int = 9) -> str:
    """Krippendorff's alpha, interval metric, in DuckDB SQL over ``src``."""
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({unit} AS VARCHAR) AS unit, CAST({annotator} AS VARCHAR) AS annotator, "
        f"{order} AS ord, CAST({c} AS DOUBLE) AS value FROM ({src}) s"
        for c in columns
    )
    cols = ", ".join(f"('{c}')" for c in columns)
    return f"""WITH long AS (SELECT * FROM ({long}) x WHERE value IS NOT NULL),
nv AS (SELECT col, count(DISTINCT value) AS n_values FROM long GROUP BY col),
one AS (SELECT col, unit, annotator, value FROM (
  SELECT *, row_number() OVER (PARTITION BY col, unit, annotator ORDER BY ord, value) AS rn
  FROM long WHERE annotator IS NOT NULL) y WHERE rn = 1),
pu AS (SELECT col, unit, CAST(count(*) AS DOUBLE) AS m_u, sum(value) AS s1_u, sum(value * value) AS s2_u
       FROM one GROUP BY col, unit),
kept AS (SELECT * FROM pu WHERE m_u >= 2),
agg AS (SELECT col, sum(m_u) AS N, sum(2 * (m_u * s2_u - s1_u * s1_u) / (m_u - 1)) AS D,
          sum(s1_u) AS S1, sum(s2_u) AS S2, count(*) AS n_units FROM kept GROUP BY col),
res AS (
  SELECT nv.col, COALESCE(agg.n_units, 0) AS n_units, nv.n_values,
    CASE WHEN nv.n_values < 2 THEN 'not_enough_values'
         WHEN agg.N IS NULL OR agg.N < 2 OR (agg.N * agg.S2 - agg.S1 * agg.S1) = 0 THEN 'insufficient_data'
         ELSE 'ok' END AS status,
    1 - (agg.D / agg.N) / (2 * (agg.N * agg.S2 - agg.S1 * agg.S1) / (agg.N * (agg.N - 1))) AS a
  FROM nv LEFT JOIN agg ON nv.col = agg.col)
SELECT cl.col AS "column", CAST(COALESCE(res.n_units, 0) AS BIGINT) AS n_units,
  CAST(COALESCE(res.n_values, 0) AS BIGINT) AS n_values,
  CASE WHEN res.status = 'ok' THEN round_even(res.a, {digits}) END AS alpha,
  COALESCE(res.status, 'not_enough_values') AS status
FROM (VALUES {cols}) cl(col) LEFT JOIN res ON cl.col = res.col"""


@register(
    "label_alpha_interval", "A7 W3",
    alpha_interval_sql(LABEL_FLAT_SQL, labels.RATING_COLUMNS, "DataRowID", "LabelCreatedBy",
                       "struct_pack(a := LabelCreatedAt, b := LabelID)"),
)
def q_label_alpha_interval(spark, sf_dir):
    """Agreement on the 1-5 ratings with the interval metric (distance = squared difference)."""
    flat = label_table(spark, sf_dir)
    return agreement.krippendorff_alpha(
        flat, "DataRowID", "LabelCreatedBy", labels.RATING_COLUMNS,
        order=F.struct("LabelCreatedAt", "LabelID"), metric="interval", digits=9,
    )
