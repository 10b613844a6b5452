"""No stage loses or swaps a row: nulls in different columns, equal rows, odd column names."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from nimbus.llm import exact_dedup, near_dedup, source_mix, toxicity
from nimbus.llm.common import row_hash, row_key

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, `a.b` string, `__row` string"
ROWS = [
    (5, None, None, None, None, None, None, None),  # the same values in other columns
    (None, None, None, None, 5, None, None, None),
    (9, "one text of nine words that is here twice", "a", None, None, 0.5, "x", "r"),
    (9, "one text of nine words that is here twice", None, "a", None, 0.5, "x", "r"),
    (11, "another text that stands alone in this table", "a", "b", 3, None, "y", None),
    (12, "equal rows stay as one or as many as the mix takes", "a", "b", 3, None, "y", None),
    (12, "equal rows stay as one or as many as the mix takes", "a", "b", 3, None, "y", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("key", [row_hash, row_key])
def test_keys_see_where_a_null_stands(docs, key):
    found = docs.select(key(docs)).distinct().count()
    assert found == len(set(ROWS))


def test_exact_copies_leave_one_of_each_class(docs):
    kept = rows_of(exact_dedup.drop_copies(docs))
    assert sum(kept.values()) == 4 and set(kept) <= set(ROWS)
    assert kept[ROWS[0]] == 1  # of the empty texts the row with an id
    assert kept[ROWS[2]] + kept[ROWS[3]] == 1
    assert kept[ROWS[4]] == kept[ROWS[5]] == 1


def test_near_copies_leave_one_of_each_group(docs):
    kept = rows_of(near_dedup.drop_near(docs, shingle=5))
    assert kept[ROWS[0]] == kept[ROWS[1]] == 1  # without words: linked with nothing
    assert kept[ROWS[2]] + kept[ROWS[3]] == 1
    assert kept[ROWS[4]] == kept[ROWS[5]] == 1 and sum(kept.values()) == 5


def test_mix_takes_each_row_as_often_as_it_says(docs):
    taken = source_mix.source_mix(docs)
    copies = {r["row"]: r["n"] for r in taken.groupBy("row").agg(F.sum("copies").alias("n")).collect()}
    keys = {tuple(r[:-1]): r[-1] for r in docs.select(*[F.col(f"`{c}`") for c in docs.columns], row_key(docs)).collect()}
    mixed = rows_of(source_mix.mixed_documents(docs))
    assert mixed == Counter({row: copies[key] for row, key in keys.items() if copies[key]})


def test_toxicity_keeps_columns_as_they_were(spark, docs):
    labels = spark.createDataFrame([(9, 0, 1), (11, 1, 0), (12, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    kept = toxicity.reject(docs, labels)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert not rows_of(kept) - rows_of(docs)
