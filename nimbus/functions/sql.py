"""The codings as SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN expr``).

SQL UDFs defined this way are inlined by the analyzer, so a predicate on them
still reaches the Parquet scan and they run in generated code; no Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from nimbus.functions.codes import BEAUFORT_LOWER_KMH, BEAUFORT_NAMES, MONTHLY_NORMAL_C
from nimbus.functions.text import HTML_DROP_PATTERNS, _REFERENCE, character_references
from nimbus.operators.report import DATA_URI_PREFIX


def _lit(text: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _references_sql(x: str) -> str:
    """``text.decode_references`` as SQL text."""
    table = "map(" + ", ".join(f"{_lit(n)}, {_lit(c)}" for n, c in character_references().items()) + ")"
    name = f"regexp_extract(p, {_lit(_REFERENCE)}, 1)"
    code = f"CAST(CASE WHEN {name} RLIKE '^#[xX]' THEN conv(substring({name}, 3, 6), 16, 10) ELSE substring({name}, 2, 7) END AS INT)"
    odd = f"({code} = 0 OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343)"
    old = f"CASE WHEN {code} BETWEEN 128 AND 159 THEN try_element_at({table}, concat('#', CAST({code} AS STRING))) END"
    number = f"CASE WHEN {odd} THEN {_lit(chr(0xFFFD))} ELSE coalesce({old}, decode(unhex(lpad(hex(CASE WHEN {odd} THEN 32 ELSE {code} END), 8, '0')), 'UTF-32')) END"
    found = f"CASE WHEN {name} = '' THEN NULL WHEN startswith({name}, '#') THEN {number} ELSE try_element_at({table}, {name}) END"
    piece = f"CASE WHEN i = 0 THEN p ELSE coalesce(concat({found}, substr(p, length({name}) + 2)), concat('&', p)) END"
    return f"array_join(transform(split({x}, '&'), (p, i) -> {piece}), '')"


def _html_to_text_sql(x: str) -> str:
    for pat in HTML_DROP_PATTERNS:
        x = f"regexp_replace({x}, {_lit(pat)}, '')"
    return _references_sql(x)


def _data_uri_sql(x: str) -> str:
    enc = f"url_encode({x})"
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        enc = f"replace({enc}, {_lit(a)}, {_lit(b)})"
    return f"concat({_lit(DATA_URI_PREFIX)}, {enc})"


def _beaufort_sql(x: str) -> str:
    parts = [f"WHEN {x} IS NULL THEN NULL", f"WHEN {x} < {BEAUFORT_LOWER_KMH[0]} THEN 0"]
    parts += [f"WHEN {x} < {u} THEN {f}" for f, u in enumerate(BEAUFORT_LOWER_KMH[1:], start=1)]
    return "CASE " + " ".join(parts) + " ELSE 12 END"


FUNCTIONS = {
    "beaufort": ("kmh DOUBLE", "INT", _beaufort_sql("kmh")),
    "beaufort_name": (
        "force INT", "STRING",
        "CASE " + " ".join(f"WHEN force = {i} THEN '{n}'" for i, n in enumerate(BEAUFORT_NAMES)) + " END",
    ),
    "wind_direction": (
        "d INT", "STRING",
        "CASE WHEN d = 0 THEN 'calm' WHEN d = 990 THEN 'variable' WHEN d > 0 AND d < 90 THEN 'NE' "
        "WHEN d = 90 THEN 'E' WHEN d > 90 AND d < 180 THEN 'SE' WHEN d = 180 THEN 'S' "
        "WHEN d > 180 AND d < 270 THEN 'SW' WHEN d = 270 THEN 'W' WHEN d > 270 AND d < 360 THEN 'NW' "
        "WHEN d = 360 THEN 'N' ELSE 'Invalid direction' END",
    ),
    "part_of_day": (
        "h INT", "STRING",
        "CASE WHEN h BETWEEN 5 AND 11 THEN 'Morning' WHEN h BETWEEN 12 AND 17 THEN 'Afternoon' "
        "WHEN h BETWEEN 18 AND 24 THEN 'Evening' ELSE 'Night' END",
    ),
    "season": (
        "m INT", "STRING",
        "CASE WHEN m IN (12, 1, 2) THEN 'Winter' WHEN m IN (3, 4, 5) THEN 'Spring' "
        "WHEN m IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END",
    ),
    "normal_temperature": (
        "m INT", "DOUBLE",
        "CASE " + " ".join(f"WHEN m = {i + 1} THEN CAST({v} AS DOUBLE)" for i, v in enumerate(MONTHLY_NORMAL_C)) + " END",
    ),
    "rating": ("v STRING", "INT", "try_cast(nullif(regexp_extract(v, '(?U)\\\\b([1-5])\\\\b', 1), '') AS INT)"),
    "html_to_text": ("html STRING", "STRING", _html_to_text_sql("html")),
    "data_uri": ("html STRING", "STRING", _data_uri_sql("html")),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    for name, (params, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
    return list(FUNCTIONS)
