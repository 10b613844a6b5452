"""Jaccard join, hard negatives and conversation audit against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from nimbus.llm import conversation_audit, hard_negatives, jaccard_join
from nimbus.llm.queries import ORACLES, QUERIES
from tests.llm.test_operators import ROWS, SCHEMA, WORD, low


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def oracle(name, sf_dir, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = con.execute(ORACLES[name])
    return [d[0] for d in found.description], Counter(found.fetchall())


# --- op11 -------------------------------------------------------------------

def near_rows():
    rnd = random.Random(8)
    rows = list(ROWS)
    base = [f"t{rnd.randrange(400)}" for _ in range(240)]
    for k in range(60):  # some within 0.9 of the base, some of each other, some of none
        copy = list(base)
        for j in range(k % 7):
            copy[rnd.randrange(len(copy))] = f"e{rnd.randrange(3)}"
        rows.append((1000 + k, " ".join(copy[k % 5 :]), None, None, None, None, None))
    return rows


def brute_join(rows, shingle, similar):
    sets = []
    for row in rows:
        words = WORD.findall(low(row[1]))
        sets.append(frozenset(tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))) if words else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= similar * (len(sets[a]) + len(sets[b]) - both):
            root[find(b)] = find(a)
    least = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            least[find(k)] = min(least.get(find(k), row[0]), row[0])
    return Counter((row[0], len(sets[k]), least.get(find(k))) for k, row in enumerate(rows))


@pytest.mark.parametrize("block,shingle,similar", [(2048, 3, 90), (5, 3, 90), (5, 2, 70)])
def test_join_equals_all_pairs(spark, monkeypatch, block, shingle, similar):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = brute_join(rows, shingle, similar)
    assert max(Counter(c for _, _, c in expected.elements()).values()) > 20
    assert rows_of(jaccard_join.jaccard_join(docs, shingle=shingle, similar=similar)) == expected


def test_join_sends_a_set_to_one_bucket(spark):
    """Near copies that share shingles with others by chance are one bucket, however many lists they meet in."""
    rnd = random.Random(3)
    base = np.array([rnd.getrandbits(63) for _ in range(400)], np.uint64)
    near = [np.concatenate([base[: len(base) - k], np.array([rnd.getrandbits(63) for _ in range(k)], np.uint64)]) for k in range(1, 4)]
    others = [np.array([rnd.getrandbits(63) for _ in range(400)], np.uint64) for _ in range(40)]
    node = lambda kind, k: f"{kind}{k:015d}".encode()
    keys = [node("n", k) for k in range(3)] + [node("o", k) for k in range(40)]
    nodes = spark.createDataFrame([(key, len(v), jaccard_join._parity(v)) for key, v in zip(keys, near + others)], "node binary, n long, parity binary")
    nodes = nodes.withColumn("h", F.xxhash64("node"))
    hashes = {bytes(r.node): r.h for r in nodes.collect()}
    # every other text holds one shingle of the near copies, and is the hub of that list if its hash is smaller
    lists = [(min(hashes[key] for key in [*keys[:3], other]), hashes[key]) for other in keys[3:] for key in [*keys[:3], other]]
    pairs = spark.createDataFrame(sorted(set(lists)), "hub long, h long")
    assert pairs.select("hub").distinct().count() > 5
    found = jaccard_join.plausible(jaccard_join._counted(pairs).join(nodes, "h").drop("h"), 90)
    least = min(hashes[key] for key in keys[:3])
    assert rows_of(found.select("hub", "node", "members")) == Counter((least, key, 3) for key in keys[:3])


def test_join_sketch_vectors_are_dealt_out(spark):
    """However many slots there are, none gets the vectors of all tasks."""
    for slots in (1, 2, 8, 30):
        held = jaccard_join._dealt(spark.range(0, 256, 1, 64).repartition(64), slots).groupBy("slot").count().collect()
        assert len(held) == slots and max(r["count"] for r in held) <= 3 * 256 / slots
    one_each = jaccard_join._dealt(spark.range(0, 64, 1, 64), 8).groupBy("slot").count().collect()
    assert len(one_each) > 4 and max(r["count"] for r in one_each) <= 24


def test_join_of_nothing(spark):
    assert jaccard_join.jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_join_query_equals_oracle(spark, sf_small):
    found = QUERIES["op11_jaccard_join"](spark, sf_small)
    names, expected = oracle("op11_jaccard_join", sf_small, "documents")
    assert found.columns == names and rows_of(found) == expected


# --- op12 -------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, rid int, score string"


def vector_rows():
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(20)], rnd.randrange(3), None, "x") for i in range(200)]
    rows += [(200 + i, [0.25] * 20, i % 2, None, None) for i in range(80)]  # one vector, many ties
    rows += [(300, [0.1] * 20, None, 1, None), (301, None, 1, 1, None), (302, [0.1, None], 1, 1, None), (303, [float("nan")] * 20, 1, 1, None),
             (304, [float("inf")] * 20, 1, 1, None), (305, [], 1, 1, None), (400, [], 1, 1, None), (307, [0.5] * 3, 2, 1, None), (500, [300.0, -2.0], 0, 1, None),
             (None, [0.2] * 20, 1, 1, None)]
    return rows


def brute_negatives(rows, is_anchor, k, lo, hi):
    taking = [(i, [math.floor(256 * x) for x in v], label) for i, v, label, *_ in rows
              if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = Counter()
    for at, (aid, av, al) in enumerate(taking):
        if not is_anchor(aid):
            continue
        scored = [(sum(x * y for x, y in zip(av, v)), i, label) for n, (i, v, label) in enumerate(taking) if n != at]
        positives = sorted((t for t in scored if t[2] == al), key=order)[:k]
        for ps, pid, _ in positives:
            fit = sorted((t for t in scored if t[2] != al and lo * ps <= 100 * t[0] <= hi * ps), key=order)[:k]
            out.update((aid, pid, rank, nid, ps, ns) for rank, (ns, nid, _) in enumerate(fit, 1))
    return out


@pytest.mark.parametrize("tile,anchors", [(1024, 8192), (7, 2)])
def test_negatives_equal_all_pairs(spark, monkeypatch, tile, anchors):
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    rows = vector_rows()
    # components as the float column holds them
    frame = spark.createDataFrame(rows, VECTORS).repartition(4).cache()
    found = hard_negatives.hard_negatives(frame, F.col("vec_id") % 20 == 0)
    expected = brute_negatives([tuple(r) for r in frame.collect()], lambda i: i is not None and i % 20 == 0, 5, 80, 100)
    assert sum(expected.values()) > 50
    assert rows_of(found) == expected


def test_negatives_other_limits_and_nothing(spark):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, VECTORS).cache()
    found = hard_negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0, k=2, low=-300, high=33)
    assert rows_of(found) == brute_negatives([tuple(r) for r in frame.collect()], lambda i: i is not None and i % 50 == 0, 2, -300, 33)
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_hold():
    import numpy as np
    import pyarrow as pa

    rnd = np.random.default_rng(2)
    x = rnd.integers(-300, 300, (40, 24)).astype(float)
    leaves = x.reshape(40, 3, 8)
    mean = leaves.mean(2)
    spread = np.sqrt(((leaves - mean[:, :, None]) ** 2).sum(2))
    table = pa.table({"summary": [np.concatenate([m, d]).astype("<f4").tobytes() for m, d in zip(mean, spread)]})
    exact, gaps = x @ x.T, []
    for level, (m, d) in enumerate(hard_negatives._levels(table, 4)):
        centre, width = (32 >> level) * m @ m.T, d @ d.T
        assert (np.abs(exact - centre) <= width + 1).all()
        gaps.append(width.mean())
    assert gaps[0] > gaps[1] > gaps[2]


def test_negatives_query_equals_oracle(spark, sf_mid):
    found = QUERIES["op12_hard_negatives"](spark, sf_mid)
    names, expected = oracle("op12_hard_negatives", sf_mid, "embeddings")
    assert set(found.columns) == set(names)
    assert rows_of(found.select(*names)) == expected and expected


# --- op13 -------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, fault string, bin int"


def brute_edits(tokens):
    """(cost, audit) by trying every edit sequence: (initial, forced deletion, cut) per row."""
    best = None

    def go(at, made, cost, audit, run):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if run < 2:  # no more than two inserts in a row can help
            for role in "ua":
                if fits(made, role):
                    go(at, made + role, cost + 2, audit + "I", run + 1)
        if at == len(tokens):
            if made == "" or made[-1] == "a":
                best = min(best, (cost, audit)) if best else (cost, audit)
            return
        initial, forced, cut = tokens[at]
        go(at + 1, made, cost + 3, audit + "D", 0)
        if not forced:
            if fits(made, initial):
                go(at + 1, made + initial, cost + cut, audit + "K", 0)
            for role in "ua":
                if role != initial and fits(made, role):
                    go(at + 1, made + role, cost + 2 + cut, audit + "R", 0)

    def fits(made, role):
        if role == "s":
            return made == ""
        return (role == "a") == (made[-1:] == "u") and role in ("u", "a")

    go(0, "", 0, "", 0)
    return best


def brute_audit(rows, ids):
    found = {}
    for conv in ids:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        seen, tokens, faults = set(), [], Counter()
        for _, _, role, text in mine:
            kept = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            tokens.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(tokens, tokens[1:]))
        cost, audit = brute_edits(tokens)
        out, at = [], 0
        for step in audit:
            role = "user" if not out or out[-1][0][:1] in ("s", "a") else "assistant"
            if step == "I":
                out.append((role, ""))
                continue
            if step != "D":
                out.append((mine[at][2] if step == "K" else role, mine[at][3]))
            at += 1
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        found[conv] = (conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha)
    return Counter(found.values())


def brute_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = (" " if v is None else v for v in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw:
            text = "" if draw == 1 else text.translate({ord(c): None for c in ".!?"}) if draw == 2 else text
            out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def turn_rows():
    rnd = random.Random(6)
    texts = ["Yes.", "No!", "cut off", "", " \n", "Why?  \n", "ok.", "é.", "."]
    rows = []
    for conv in range(120):
        for turn in range(rnd.randrange(1, 8)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, rnd.choice([turn, turn, turn, turn * 3, None]), role, rnd.choice([*texts, f"said {turn}.", None]), "clash", 1))
    # one row per turn (rows of one turn and role are sorted by a hash); one may have no turn
    once = {r[:2]: r for r in rows}
    return [*once.values(), (None, 1, "user", "Hello.", None, None), (None, 3, "assistant", "x" * 100_000 + ".", None, None)]


@pytest.mark.parametrize("chunk,parts", [(8192, 8), (1, 8), (2, 3)])
def test_audit_equals_every_edit_sequence(spark, monkeypatch, chunk, parts):
    monkeypatch.setattr(conversation_audit, "CHUNK", chunk)
    rows = turn_rows()
    conv = spark.createDataFrame(rows, TURNS).repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = rows_of(conversation_audit.audit(conversation_audit.damaged(conv), conv))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    expected = brute_audit(brute_damage(rows), {r[0] for r in rows})
    assert found == expected
    audits = "".join(t[7] for t in expected)
    assert set(audits) == set("KRDI") and any(t[7] == "" for t in expected)


def test_one_conversation_over_many_partitions(spark, monkeypatch):
    """A third and more of all rows in one conversation: cut into chunks, equal to the same program in one piece."""
    rnd = random.Random(9)
    rows = [(1000, t, rnd.choice(["user", "assistant"]), f"turn {t % 300}{rnd.choice(['.', ''])}", None, None) for t in range(3000)]
    rows += [(c, t, "user", "a.", None, None) for c in range(300) for t in range(2)]
    conv = spark.createDataFrame(rows, TURNS).repartition(5)
    whole = rows_of(conversation_audit.audit(conv))
    monkeypatch.setattr(conversation_audit, "CHUNK", 50)
    parts = conversation_audit.chunks(conversation_audit.flagged(conversation_audit._rows(conv, "conv_id", "turn", "role", "text")))
    assert parts.where("conv = 1000").count() >= 60 and parts.agg(F.max("n")).first()[0] <= 50
    assert rows_of(conversation_audit.audit(conv)) == whole
    best = {0: (0, "")}
    seen = set()
    for _, _, role, text, *_ in rows[:3000]:
        fault = 2 if (role, text) in seen else 0 if text[-1] == "." else 3
        seen.add((role, text))
        best = plain_step(best, role[0], fault)
    assert min(v for s, v in plain_step(best, None, 0).items() if s in (0, 3)) == next((t[6], t[7]) for t in whole if t[0] == 1000)


def plain_step(best, initial, fault):
    """The program on whole strings; the initial None only inserts."""
    def keep(into, state, value):
        if state not in into or value < into[state]:
            into[state] = value

    best = dict(best)
    for s in (0, 1, 3):
        if s in best:
            keep(best, 2, (best[s][0] + 2, best[s][1] + "I"))
    if 2 in best:
        keep(best, 3, (best[2][0] + 2, best[2][1] + "I"))
    if initial is None:
        return best
    new = {}
    for s, (cost, text) in best.items():
        keep(new, s, (cost + 3, text + "D"))
        if fault == 2:
            continue
        cost += fault == 3
        after, letter = (3, "a") if s == 2 else (2, "u")
        keep(new, after, (cost, text + "K") if initial == letter else (cost + 2, text + "R"))
        if s == 0 and initial == "s":
            keep(new, 1, (cost, text + "K"))
    return new


@pytest.mark.parametrize("prime", [conversation_audit._PRIME, 7])
def test_edit_strings_compare_as_strings(monkeypatch, prime):
    """With a tiny prime hashes collide all the time, and the letters decide."""
    monkeypatch.setattr(conversation_audit, "_PRIME", prime)
    rnd = random.Random(1)
    edits = conversation_audit.Edits()
    for _ in range(400):
        edits.add(rnd.randrange(len(edits.letter)) if rnd.random() < 0.3 else len(edits.letter) - 1, rnd.choice("DK"))
    nodes = [rnd.randrange(len(edits.letter)) for _ in range(60)]
    for x, y in itertools.product(nodes, nodes):
        assert edits.less(x, y) == (edits.text(x) < edits.text(y))


def test_audit_of_nothing(spark):
    assert conversation_audit.audit(spark.createDataFrame([], TURNS)).count() == 0
