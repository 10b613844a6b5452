"""Annotation export flattening, ratings, exclusion, shares, agreement."""

import itertools
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from nimbus.operators import agreement, labels, ratings

QM = "Hoe correct is de informatie over deze ochtend op een schaal van 1 tot 5?"
QI = "Wordt er informatie gegeven over deze ochtend?"
QW = "Welke weerinformatie wordt gegeven over deze ochtend?"
QS = "Hoe tevreden zou je zijn met dit weerbericht, op een schaal van 1 tot 5?"
QL = "Vind je dit een goed weerbericht, qua taal en begrijpelijkheid, op een schaal van 1 tot 5?"
QA = "Hoe correct is de informatie over deze middag op een schaal van 1 tot 5?"


def _label(lid, by, score=None, classifications=None):
    lab = {"id": lid, "label_details": {"created_at": f"2024-01-0{lid[-1]}", "created_by": by}}
    if score is not None:
        lab["performance_details"] = {"consensus_score": score}
    if classifications is not None:
        lab["annotations"] = {"classifications": classifications}
    return lab


LINES = [
    json.dumps({"data_row": {"id": "r1"}, "projects": {
        "pA": {"name": "A", "labels": [_label("l1", "ann1@x", 0.5, [
            {"name": QI, "radio_answer": {"name": "Ja", "classifications": [
                {"name": QM, "radio_answer": {"name": "4 - goed"}}]}},
            {"name": QW, "checklist_answers": [{"name": "zon"}, {"name": "regen"}]},
            {"name": QS, "radio_answer": {"name": "2"}},
            {"name": QS, "radio_answer": {"name": "5"}},
            {"name": "", "radio_answer": {"name": "x", "classifications": [{"name": QL, "radio_answer": {"name": "1"}}]}},
            {"name": QA, "radio_answer": None, "classifications": [{"name": QL, "radio_answer": {"name": "een 3/5"}}]},
        ])]},
        "pB": {"name": "B", "labels": []},
    }}),
    json.dumps({"data_row": {"id": "r1"}, "projects": {
        "pA": {"name": "A", "labels": [_label("l2", None), _label("l3", "ann2@x", 1.0, [
            {"name": QI, "radio_answer": {"name": "Nee"}, "checklist_answers": [{"name": "a"}, {"name": "b"}]}])]}}}),
    "{broken",
    "",
]


@pytest.fixture(scope="module")
def flat(spark):
    good, bad = labels.parse_lines(spark.createDataFrame([(x,) for x in LINES], "value string"))
    return labels.with_ratings(labels.flatten_labels(good)), bad


def test_flatten_shapes(flat):
    df, bad = flat
    rows = {r["LabelID"]: r for r in df.collect()}
    assert set(rows) == {"l1", "l2", "l3"}            # project without labels gives no row
    l1, l2, l3 = rows["l1"], rows["l2"], rows["l3"]
    assert l1["DataRowID"] == "r1" and l1["ProjectID"] == "pA" and l1["ProjectName"] == "A"
    assert l1["ConsensusScore"] == 0.5 and l2["ConsensusScore"] is None
    assert l1["MorningInfoGiven"] == "Ja" and l1["MorningCorrectness"] == 4      # nested under radio
    assert l1["MorningWeatherInfo"] == "zon, regen"                               # checklist
    assert l1["Satisfaction"] == 5                                                # later answer wins
    assert l1["LanguageClarity"] == 3                                             # nested directly; unnamed subtree cut
    assert l1["AfternoonCorrectness"] is None                                     # null radio answer
    assert l2["LabelCreatedBy"] is None and l2["MorningInfoGiven"] is None        # no annotations: metadata only
    assert l3["MorningInfoGiven"] == "a, b"                                       # checklist beats radio
    assert sorted(r["value"] for r in bad.collect()) == ["", "{broken"]


def test_exclude_keeps_null_annotators_and_mask(flat):
    df, _ = flat
    kept = {r["LabelID"] for r in labels.exclude_annotators(df, ["ann1@x"]).collect()}
    assert kept == {"l2", "l3"}
    masked = {r["LabelID"]: r["annotators"] for r in labels.mask_annotators(df, ["ann2@x"]).collect()}
    assert masked == {"l1": "ann1@x", "l2": None, "l3": None}


def test_depth_guard(spark):
    node = {"name": "q0", "radio_answer": {"name": "a"}}
    for i in range(1, 12):
        node = {"name": f"q{i}", "radio_answer": {"name": "a"}, "classifications": [node]}
    line = json.dumps({"data_row": {"id": "r"}, "projects": {"p": {"name": "P", "labels": [_label("l1", "a", 1.0, [node])]}}})
    good, _ = labels.parse_lines(spark.createDataFrame([(line,)], "value string"))
    writes = labels.answer_writes(labels.explode_labels(good), max_depth=12).collect()[0]["writes"]
    assert len(writes) == 12
    with pytest.raises(Exception, match="deeper than max_depth=8"):
        labels.answer_writes(labels.explode_labels(good), max_depth=8).collect()
    flat = labels.flatten_labels(good, {"q0": "Q0", "q11": "Q11"}).collect()[0]
    assert flat["Q0"] == "a" and flat["Q11"] == "a"
    assert flat["OtherQuestions"] == {f"q{i}": "a" for i in range(1, 11)}


def test_flatten_is_independent_of_the_input_split(spark, tmp_path):
    """The walk stays inside the row: other splits between building and reading give the same rows."""
    path = str(tmp_path / "export")
    rows = [(json.dumps({"data_row": {"id": f"r{i}"}, "projects": {"p": {"name": "P", "labels": [
        _label(f"l{i}", f"a{i % 3}", 1.0, [{"name": QI, "radio_answer": {"name": f"answer {i}"}}])]}}}),) for i in range(300)]
    spark.createDataFrame(rows, "value string").repartition(7).write.text(path)
    good, _ = labels.read_labels(spark, path)
    flat = labels.flatten_labels(good)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        got = {r["LabelID"]: r["MorningInfoGiven"] for r in flat.collect()}
        other = {r["LabelID"]: r["MorningInfoGiven"] for r in labels.flatten_labels(good.repartition(11)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == other == {f"l{i}": f"answer {i}" for i in range(300)}


def test_shares_sum_to_100(spark, sf_mid):
    lab = spark.read.parquet(f"{sf_mid}/labels.parquet")
    s = ratings.value_share(lab, "quality").collect()
    assert abs(sum(r["pct"] for r in s) - 100.0) < 1e-6
    assert [r["value"] for r in s] == sorted(r["value"] for r in s)
    m = ratings.answer_matrix(lab, ["quality", "toxic"], ["0", "1"]).collect()
    for r in m:
        assert abs(r["pct_0"] + r["pct_1"] - 100.0) < 1e-6


def test_answer_matrix_keeps_answers_outside_the_list(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (3, 1), (4, None)], "quality int, toxic int")
    m = {r["question"]: r.asDict() for r in ratings.answer_matrix(df, ["quality", "toxic"], ["0", "1", "2"]).collect()}
    assert m["quality"] == {"question": "quality", "pct_0": 25.0, "pct_1": 25.0, "pct_2": 0.0, "other_pct": 50.0}
    assert m["toxic"] == {"question": "toxic", "pct_0": 0.0, "pct_1": 100.0, "pct_2": 0.0, "other_pct": 0.0}


# --- agreement ---------------------------------------------------------------------

def _alpha(spark, triples, metric="nominal"):
    df = spark.createDataFrame(triples, "unit string, ann string, v int")
    return agreement.krippendorff_alpha(df, "unit", "ann", ["v"], metric=metric).collect()[0]


def test_alpha_goldens(spark):
    r = _alpha(spark, [("u1", "a", 1), ("u1", "b", 1), ("u2", "a", 2), ("u2", "b", 2)])
    assert r["status"] == "ok" and abs(r["alpha"] - 1.0) < 1e-12
    assert _alpha(spark, [("u1", "a", 1), ("u1", "b", 1)])["status"] == "not_enough_values"
    assert _alpha(spark, [("u1", "a", 1), ("u2", "b", 2)])["status"] == "insufficient_data"
    r = _alpha(spark, [("u1", "a", 1), ("u1", "b", 1), ("u2", "a", 1), ("u2", "b", 2), ("u3", "a", 2), ("u3", "b", 2)])
    assert abs(r["alpha"] - 4 / 9) < 1e-12


def _brute_alpha(triples, metric):
    """Pair-counting definition: coincidences over ordered pairs within units."""
    first = {}
    for u, a, v in sorted(triples, key=lambda t: (t[0], t[1], t[2])):
        first.setdefault((u, a), v)
    units = {}
    for (u, _), v in first.items():
        units.setdefault(u, []).append(v)
    delta = (lambda c, k: float(c != k)) if metric == "nominal" else (lambda c, k: float((c - k) ** 2))
    units = {u: vs for u, vs in units.items() if len(vs) >= 2}
    n = sum(len(vs) for vs in units.values())
    do = sum(
        sum(delta(x, y) for x, y in itertools.permutations(vs, 2)) / (len(vs) - 1) for vs in units.values()
    ) / n
    counts = Counter(v for vs in units.values() for v in vs)
    de = sum(counts[c] * counts[k] * delta(c, k) for c in counts for k in counts) / (n * (n - 1))
    return 1 - do / de


@pytest.mark.parametrize("metric", ["nominal", "interval"])
def test_alpha_matches_pair_count(spark, metric):
    rnd = random.Random(5)
    triples = [(f"u{rnd.randrange(40)}", f"a{rnd.randrange(6)}", rnd.randrange(1, 6)) for _ in range(300)]
    got = _alpha(spark, triples, metric)["alpha"]
    assert abs(got - _brute_alpha(triples, metric)) < 1e-9


def test_alpha_invariant_to_annotator_names(spark):
    rnd = random.Random(9)
    triples = [(f"u{rnd.randrange(30)}", f"a{rnd.randrange(5)}", rnd.randrange(1, 4)) for _ in range(200)]
    renamed = [(u, "x" + a[::-1], v) for u, a, v in triples]
    assert abs(_alpha(spark, triples)["alpha"] - _alpha(spark, renamed)["alpha"]) < 1e-12


def test_alpha_on_lineitem(spark, sf_mid):
    li = spark.read.parquet(f"{sf_mid}/lineitem.parquet")
    r = agreement.krippendorff_alpha(li, "l_orderkey", "l_linenumber", ["l_returnflag"]).collect()[0]
    assert r["status"] == "ok" and abs(r["alpha"] - 0.005644168) < 1e-9


def test_rating_means_and_ceil(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None), (None, 1.0)], "MorningCorrectness int, ConsensusScore double")
    r = ratings.rating_means(df, ["MorningCorrectness"]).collect()[0]
    assert r["avg_MorningCorrectness"] == 1.5 and r["avg_ConsensusScore"] == 0.75
    r = ratings.rating_means(df, ["MorningCorrectness"], ceil=True).collect()[0]
    assert r["avg_MorningCorrectness"] == 2 and r["avg_ConsensusScore"] == 0.75
    assert F is not None
