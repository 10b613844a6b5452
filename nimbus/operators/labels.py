"""Annotation exports (NDJSON, one data row per line) -> one flat row per label.

Shape of a line::

    data_row: {id}
    projects: map of project id -> {name, labels: [
        {id, label_details: {created_at, created_by},
         performance_details: {consensus_score}        (may be absent)
         annotations: {classifications: [NODE, ...]}}]}
    NODE: {name, radio_answer: {name, classifications: [NODE]},
           checklist_answers: [{name}], classifications: [NODE]}

Lines are parsed with ``try_parse_json`` into VARIANT; a line that does not
parse (or is empty) goes to the ``bad`` frame, the rest go on. Projects and
labels are exploded (a project without labels gives no row). The recursive
classification tree is walked inside the row, level by level, as one array of
nodes; every answer carries a sortable ``path`` (positions, with 0 for a node's
radio answer, 1 for its checklist, 2 for nodes under its radio answer and 3 for
nodes directly under it), so "a later answer overwrites an earlier one" is the
answer of the largest path. No key, shuffle or action.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions.text import rating

# Question texts of the annotation project and their column names.
QUESTION_COLUMNS = {
    "Wordt er informatie gegeven over deze ochtend?": "MorningInfoGiven",
    "Welke weerinformatie wordt gegeven over deze ochtend?": "MorningWeatherInfo",
    "Hoe correct is de informatie over deze ochtend op een schaal van 1 tot 5?": "MorningCorrectness",
    "Wordt er informatie gegeven over deze middag?": "AfternoonInfoGiven",
    "Welke weerinformatie wordt gegeven over deze middag?": "AfternoonWeatherInfo",
    "Hoe correct is de informatie over deze middag op een schaal van 1 tot 5?": "AfternoonCorrectness",
    "Wordt er informatie gegeven over deze avond?": "EveningInfoGiven",
    "Welke weerinformatie wordt gegeven over deze avond?": "EveningWeatherInfo",
    "Hoe correct is de informatie over deze avond op een schaal van 1 tot 5?": "EveningCorrectness",
    "Wordt er informatie gegeven over morgen?": "TomorrowInfoGiven",
    "Welke weerinformatie wordt gegeven over morgen?": "TomorrowWeatherInfo",
    "Hoe correct is de informatie over morgen op een schaal van 1 tot 5?": "TomorrowCorrectness",
    "Zou het je opvallen dat dit weerbericht automatisch is gegenereerd als je het zou lezen op de buienradar website? Op een schaal van 1-5": "AutoGeneratedNoticeable",
    "Is de opzet van het weerbericht goed? Oftewel, begint het met deze ochtend, vervolgens de middag, de avond en de nacht en eindigt het met de volgende dag? Op een schaal van 1-5": "ReportStructureGood",
    "Vind je dit een goed weerbericht, qua taal en begrijpelijkheid, op een schaal van 1 tot 5?": "LanguageClarity",
    "Hoe tevreden zou je zijn met dit weerbericht, op een schaal van 1 tot 5?": "Satisfaction",
    "Wordt er informatie gegeven over aankomende nacht?": "NightInfoGiven",
    "Welke weerinformatie wordt gegeven over aankomende nacht?": "NightWeatherInfo",
    "Hoe correct is deze informatie op een schaal van 1 tot 5?": "NightCorrectness",
}
METADATA_COLUMNS = {
    "data_row_id": "DataRowID",
    "project_id": "ProjectID",
    "project_name": "ProjectName",
    "label_id": "LabelID",
    "label_created_at": "LabelCreatedAt",
    "label_created_by": "LabelCreatedBy",
    "consensus_score": "ConsensusScore",
}
# The nine 1-5 ratings, in the order the agreement report lists them.
RATING_COLUMNS = [
    "AutoGeneratedNoticeable", "ReportStructureGood", "LanguageClarity", "Satisfaction",
    "MorningCorrectness", "AfternoonCorrectness", "EveningCorrectness", "NightCorrectness",
    "TomorrowCorrectness",
]
# The eight ratings whose means the report prints (night is not among them).
MEAN_COLUMNS = [
    "MorningCorrectness", "AfternoonCorrectness", "EveningCorrectness", "TomorrowCorrectness",
    "AutoGeneratedNoticeable", "ReportStructureGood", "LanguageClarity", "Satisfaction",
]
INFO_COLUMNS = ["MorningInfoGiven", "AfternoonInfoGiven", "EveningInfoGiven", "TomorrowInfoGiven"]

DEFAULT_MAX_DEPTH = 12
OTHER_QUESTIONS = "OtherQuestions"

_RADIO, _CHECKLIST, _UNDER_RADIO, _DIRECT = 0, 1, 2, 3


def read_labels(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S3: NDJSON lines -> (good, bad). ``good`` has ``value`` (text) and ``v``
    (VARIANT); ``bad`` keeps the file and the offending text."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file_path")
    )
    return parse_lines(lines)


def parse_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parse a frame with a ``value`` text column into (good, bad) frames."""
    parsed = lines.withColumn("v", F.try_parse_json(F.trim("value")))
    good = parsed.where(F.col("v").isNotNull())
    bad = parsed.where(F.col("v").isNull()).drop("v")
    return good, bad


def _vs(v: Column | str, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def explode_labels(good: DataFrame) -> DataFrame:
    """N1 + N2: one row per (line, project, label) with the label's metadata and
    its top-level classification nodes. Missing fields give null (consensus
    score, details) or '' (data row id)."""
    proj = good.select(
        F.coalesce(_vs("v", "$.data_row.id"), F.lit("")).alias("data_row_id"),
        F.explode(F.try_variant_get("v", "$.projects", "map<string,variant>")).alias("project_id", "pd"),
    )
    lab = proj.select(
        "data_row_id", "project_id",
        _vs("pd", "$.name").alias("project_name"),
        F.explode(F.try_variant_get("pd", "$.labels", "array<variant>")).alias("lb"),
    )
    return lab.select(
        "data_row_id", "project_id", "project_name",
        _vs("lb", "$.id").alias("label_id"),
        _vs("lb", "$.label_details.created_at").alias("label_created_at"),
        _vs("lb", "$.label_details.created_by").alias("label_created_by"),
        F.try_variant_get("lb", "$.performance_details.consensus_score", "double").alias("consensus_score"),
        F.try_variant_get("lb", "$.annotations.classifications", "array<variant>").alias("nodes"),
    )


_ITEM = "struct<node: variant, path: array<int>, question: string, answer: string>"


def _item(node: Column, path: Column, question: Column | None = None, answer: Column | None = None) -> Column:
    return F.struct(
        node.alias("node"), path.alias("path"),
        (question if question is not None else F.lit(None).cast("string")).alias("question"),
        (answer if answer is not None else F.lit(None).cast("string")).alias("answer"),
    )


def _step(items: Column) -> Column:
    """One level down, inside the row: a node becomes its answer writes (node = null)
    plus its child nodes; items that are already writes pass through unchanged."""

    def below(item: Column) -> Column:
        node, path = item["node"], item["path"]
        name = _vs(node, "$.name")
        named = F.coalesce(name != "", F.lit(False))
        radio = F.try_variant_get(node, "$.radio_answer", "map<string,variant>")
        checklist = F.try_variant_get(node, "$.checklist_answers", "array<variant>")
        no_node = F.lit(None).cast("variant")
        radio_item = F.when(
            named & (F.size(F.coalesce(radio, F.create_map().cast("map<string,variant>"))) > 0),
            _item(no_node, F.concat(path, F.array(F.lit(_RADIO))), name,
                  F.coalesce(_vs(node, "$.radio_answer.name"), F.lit(""))),
        )
        check_item = F.when(
            named & (F.size(F.coalesce(checklist, F.array().cast("array<variant>"))) > 0),
            _item(no_node, F.concat(path, F.array(F.lit(_CHECKLIST))), name,
                  F.array_join(F.transform(checklist, lambda x: F.coalesce(F.try_variant_get(x, "$.name", "string"), F.lit(""))), ", ")),
        )

        def kids(field: str, step: int) -> Column:
            arr = F.coalesce(F.try_variant_get(node, field, "array<variant>"), F.array().cast("array<variant>"))
            return F.when(named, F.transform(arr, lambda x, i: _item(x, F.concat(path, F.array(F.lit(step), i)))))\
                .otherwise(F.array().cast(f"array<{_ITEM}>"))

        found = F.concat(F.array(radio_item, check_item), kids("$.radio_answer.classifications", _UNDER_RADIO),
                         kids("$.classifications", _DIRECT))
        return F.when(node.isNull(), F.array(item)).otherwise(F.filter(found, lambda x: x.isNotNull()))

    return F.flatten(F.transform(items, below))


def answer_writes(labels: DataFrame, max_depth: int = DEFAULT_MAX_DEPTH) -> DataFrame:
    """N3 + N4: ``labels`` with ``writes``, the answers of the label's tree as an array of
    ``(path, question, answer)``, in place of ``nodes``.

    The tree is walked inside the row, one array per level: no shuffle, no key to
    join on, the same for any split of the input. A node left below ``max_depth``
    is an error, not a silent loss.
    """
    first = F.transform(F.coalesce("nodes", F.array().cast("array<variant>")), lambda x, i: _item(x, F.array(i)))
    level = labels.withColumn("_items", first)
    for _ in range(max_depth):
        level = level.withColumn("_items", _step(F.col("_items")))
    deeper = F.exists("_items", lambda x: x["node"].isNotNull())
    checked = F.when(deeper, F.raise_error(F.lit(f"classification tree deeper than max_depth={max_depth}")).cast(f"array<{_ITEM}>")).otherwise(F.col("_items"))
    writes = F.transform(checked, lambda x: F.struct(x["path"].alias("path"), x["question"].alias("question"), x["answer"].alias("answer")))
    return level.withColumn("writes", writes).drop("_items", "nodes")


def _last_answer(writes: Column, question: Column) -> Column:
    """The answer written last (largest path) for a question; null without one."""
    return F.array_max(F.filter(writes, lambda w: w["question"] == question))["answer"]


def flatten_labels(good: DataFrame, questions: dict[str, str] | None = None, max_depth: int = DEFAULT_MAX_DEPTH) -> DataFrame:
    """N1-N5 + P2: one row per label, metadata plus one column per known question.

    Labels without answers keep their row. Questions not in ``questions`` are
    kept in the map column ``OtherQuestions`` (question text to last answer), so
    the column set is fixed and no schema inference runs.
    """
    questions = QUESTION_COLUMNS if questions is None else questions
    rows = answer_writes(explode_labels(good), max_depth)
    writes = F.col("writes")
    known = F.array(*[F.lit(q) for q in questions]) if questions else F.array().cast("array<string>")
    others = F.array_distinct(F.transform(F.filter(writes, lambda w: ~F.array_contains(known, w["question"])), lambda w: w["question"]))
    return rows.select(
        *[F.col(c).alias(out) for c, out in METADATA_COLUMNS.items()],
        *[_last_answer(writes, F.lit(q)).alias(col) for q, col in questions.items()],
        F.map_from_entries(F.transform(others, lambda q: F.struct(q.alias("key"), _last_answer(writes, q).alias("value")))).alias(OTHER_QUESTIONS),
    )


def with_ratings(flat: DataFrame, columns: Sequence[str] = RATING_COLUMNS) -> DataFrame:
    """F11 + P4: rating columns -> nullable int (first stand-alone digit 1-5)."""
    return flat.withColumns({c: rating(F.col(c)) for c in columns if c in flat.columns})


def exclude_annotators(df: DataFrame, who: Sequence[str], col: str = "LabelCreatedBy") -> DataFrame:
    """Drop rows of listed annotators; rows without annotator stay."""
    return df.where(~F.coalesce(F.col(col).isin(list(who)), F.lit(False)))


def mask_annotators(df: DataFrame, who: Sequence[str], col: str = "LabelCreatedBy", out: str = "annotators") -> DataFrame:
    """Copy of the annotator column with listed annotators set to null."""
    return df.withColumn(out, F.when(~F.col(col).isin(list(who)), F.col(col)))
