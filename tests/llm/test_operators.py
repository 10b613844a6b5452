"""The training-data operators against brute force, on one small awkward table.

The table holds nulls in every column, empty and blank texts, a very long text, exact and near
copies, rows equal in every column, a shared passage and a column whose name the operators use.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from nimbus.llm import exact_dedup, fingerprints, near_dedup, ngram_lm, packing, source_mix, substring_dedup, token_counts, toxicity, url_filter
from nimbus.llm.common import crc_mod, written
from nimbus.llm.queries import ORACLES, QUERIES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id int"
AZ = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def low(text):
    return (text or "").translate(AZ)


def make_rows():
    rnd = random.Random(3)
    vocabulary = ["ba", "Kel", "mor", "tino", "étu", "das", "Über", "x9", "fin,", "sol."] + [f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage = prose(70)
    texts = [prose(rnd.randrange(1, 120)) for _ in range(40)]
    base = prose(100).split(" ")
    for k in range(6):  # near copies: one word each
        copy = list(base)
        copy[10 * k] = f"edit{k}"
        texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper(), prose(30) + "\n" + passage, prose(20) + "\n" + passage + " " + prose(5)]
    texts += [None, "", " \t\n", "a", "A", "one two", "a" * 900, prose(9000), "ﬁ ½   end  two  spaces ", "<|endoftext|> <s>"]
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "s3"][i % 4] if i % 5 else "s1", None, "clash", i) for i, t in enumerate(texts)]
    rows.append((None, "no id here at all", None, None, None, None, None))
    rows.append(rows[3])  # equal in every column
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_source_mix(docs, empty):
    got = source_mix.source_mix(docs).collect()
    again = source_mix.source_mix(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(ROWS)
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        level = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] > 2 * sizes[s]}
        if not more:
            break
        full |= more
    targets = sorted(2.0 * sizes[s] if s in full else level * weight[s] for s in order)
    assert np.allclose(sorted({round(r["target"], 6) for r in got}), targets)
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[round(r["target"], 6)] += r["taken"]
    longest = max(r["size"] for r in got)
    assert all(abs(n - t) <= longest / 2 + 1e-6 for t, n in taken.items())
    mixed = source_mix.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert source_mix.source_mix(empty).count() == 0


@pytest.mark.parametrize("weights", [(3,), (1, 2)])
def test_source_mix_keeps_many_equal_rows(spark, monkeypatch, weights):
    """More rows equal in every column than one block of the tree could ever hold."""
    monkeypatch.setattr(source_mix, "BLOCK", 8)
    same = spark.range(9001).selectExpr("7L AS doc_id", "'one two three' AS text", "'s1' AS source")
    rest = spark.range(100).selectExpr("id + 10 AS doc_id", "repeat('w ', int(id % 9)) AS text", "if(id % 2 = 0, 's1', 's2') AS source")
    frame = same.unionByName(rest)
    got = source_mix.source_mix(frame, weights=weights, share=1.25).collect()
    assert Counter(r["doc_id"] for r in got) == Counter([7] * 9001 + list(range(10, 110)))
    assert sorted(map(str, got)) == sorted(map(str, source_mix.source_mix(frame.repartition(5), weights=weights, share=1.25).collect()))
    taken, target = Counter(), {}
    for r in got:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    assert all(abs(taken[s] - t) <= 4 + 1e-6 for s, t in target.items())
    mine = [r["copies"] for r in got if r["doc_id"] == 7]
    assert max(mine) - min(mine) <= 1 and abs(np.mean(mine) - target[max(target)] / max(target)) < 0.01


def brute_repeats(texts, least):
    seen = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - least + 1):
            if seen[t[i : i + least]] > 1:
                hit[i : i + least] = b"\1" * least
        out.append((len(t), sum(hit), len(re.findall(b"\1+", bytes(hit))), hashlib.sha256(bytes(b for b, h in zip(t, hit) if not h)).hexdigest()))
    return out


def test_substring_removal(docs, empty, monkeypatch):
    want = sorted(brute_repeats([(r[1] or "").encode() for r in ROWS], substring_dedup.LEAST))
    for crowd in (substring_dedup.CROWD, 1):  # both ways of comparing an anchor's contexts
        monkeypatch.setattr(substring_dedup, "CROWD", crowd)
        got = substring_dedup.remove_repeats(docs).collect()
        assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_suffix_order_and_common_prefixes():
    for seed in range(6):
        rnd = random.Random(seed)
        data = np.frombuffer(("".join(rnd.choice("ab" if seed % 2 else "abcd") for _ in range(200)) * 2)[:300].encode(), np.uint8)
        raw = data.tobytes()
        order = substring_dedup.suffix_array(data)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        for least in (1, 2, 7, 40):
            want = [k > 0 and len(raw) - min(order[k], order[k - 1]) >= 0 and raw[order[k] :][:least] == raw[order[k - 1] :][:least] and len(raw[order[k - 1] :]) >= least for k in range(len(raw))]
            assert substring_dedup.shares_least(data, order, least).tolist() == want


def test_near_duplicates(docs, empty):
    sets = []
    for r in ROWS:
        w = WORD.findall(low(r[1]))
        sets.append(set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} if w else set())
    home = list(range(len(ROWS)))

    def find(i):
        while home[i] != i:
            i = home[i]
        return i

    for i in range(len(ROWS)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                home[find(i)] = find(j)
    least = {}
    for i, r in enumerate(ROWS):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    want = Counter((r[0], len(sets[i]), r[0] if not sets[i] else least.get(find(i))) for i, r in enumerate(ROWS))
    got = near_dedup.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)
    left = near_dedup.drop_near(docs)
    assert left.columns == docs.columns and left.count() == len({find(i) if sets[i] else ("blank", i) for i in range(len(ROWS))})
    assert near_dedup.near_duplicates(empty).count() == 0


def test_pipeline_stage_compares_runs_of_five_words(spark, sf_small):
    """Four words of a hundred changed: a near copy by pairs of words, another text by runs of five."""
    import corpus_pipeline

    base = [f"b{i}" for i in range(100)]
    edited = lambda *at: " ".join(f"e{i}" if i in at else w for i, w in enumerate(base))
    rows = [(1, edited()), (2, edited(20, 40, 60, 80)), (3, edited(50)), (4, "b1 b2 b3"), (5, "b1 b2 b3"), (6, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    runs = [set(zip(*[t.split()[k:] for k in range(5)])) for _, t in rows[:3]]
    assert 100 * len(runs[0] & runs[1]) < 80 * len(runs[0] | runs[1]) and 100 * len(runs[0] & runs[2]) >= 80 * len(runs[0] | runs[2])
    assert sorted(r["doc_id"] for r in corpus_pipeline.near(spark, frame, sf_small).collect()) == [1, 2, 4, 6]
    got = near_dedup.near_duplicates(frame, shingle=5).collect()
    assert [(r["n_shingles"], r["component_id"]) for r in sorted(got, key=lambda r: r["doc_id"])] == [(96, 1), (96, 2), (96, 1), (1, 4), (1, 4), (0, 6)]
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame).collect()}[2] == 1


def test_large_groups_in_blocks(spark, monkeypatch):
    """A crowd of variants around the threshold gives the same components in blocks as in pairs."""
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for k in range(60):
        words = list(base)
        for at in rnd.sample(range(60), rnd.choice([2, 3, 4])):
            words[at] = f"e{k}_{at}"
        rows.append((k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [set(zip(t.split(), t.split()[1:])) for _, t in rows]
    home = list(range(60))
    for _ in range(60):
        for i in range(60):
            for j in range(60):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    home[i] = home[j] = min(home[i], home[j])
    monkeypatch.setattr(near_dedup, "PIVOTS", 1)
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame).collect()}
    assert got == dict(enumerate(home))


def test_token_counts(docs, empty, scratch):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = Counter((r[0], len((r[1] or "").encode()), len(model.encode(r[1] or ""))) for r in ROWS)
    for _ in range(2):  # the second time all counts come from the cache
        got = token_counts.token_counts(docs, path, cache=f"{scratch}/cache").collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got)
    assert token_counts.token_counts(empty, path).count() == 0


def test_toxicity_learns_and_rejects(spark, docs, empty):
    rnd = random.Random(1)
    words = [f"v{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        text = [rnd.choice(words) for _ in range(40)]
        if i % 3 == 0:
            text[rnd.randrange(40)] = rnd.choice(["vile,", "Nasty", "foul."])
        rows.append((i, " ".join(text), "en", "s", 0, None, None))
        labels.append((i, 0, int(i % 3 == 0)))
    frame, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, marks)
    got = toxicity.score(frame, model, keep=("doc_id",)).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 100 and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 3 == 0) for r in held]) > 0.95
    left = toxicity.reject(frame, marks)
    assert left.columns == frame.columns and abs(left.count() - 600) < 40
    assert toxicity.score(docs, model, keep=tuple(docs.columns)).count() == len(ROWS)
    assert toxicity.score(empty, model, keep=("doc_id",)).count() == 0
    assert toxicity.reject(frame, marks.limit(0)).count() == 900  # no labels: nothing is rejected


def test_toxicity_thresholds_cover_all_labelled_rows(spark, monkeypatch):
    """However small the sample, the thresholds have the fewest errors of all rows it leaves, in the labels' mix."""
    rnd = random.Random(4)
    words = [f"v{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(4000):
        toxic = i % 10 == 0
        text = [rnd.choice(words) for _ in range(20)]
        if rnd.random() < (0.8 if toxic else 0.12):  # clean texts use the word too, and outnumber the others by far
            text[3] = "vile"
        rows.append((i, " ".join(text), ["en", "de", None][i % 3], "s", 0, None, None))
        labels.append((i, 0, int(toxic)))
    frame, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    models = []
    real = toxicity.score
    monkeypatch.setattr(toxicity, "score", lambda docs, model, **k: models.append(model) or real(docs, model, **k))
    left = {r["doc_id"] for r in toxicity.reject(frame, marks, sample=150).select("doc_id").collect()}
    model = models[-1]
    scores = {r["doc_id"]: r["score"] for r in real(frame, model, keep=("doc_id",)).collect()}
    learn = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 != 2]
    judged = [i for i in learn if i not in set(model.used)]
    assert 200 < len(model.used) < 280 and set(model.used) <= set(learn)

    def least(keep):
        weight = [sum(keep(i) and (i % 10 == 0) == y for i in learn) / sum(keep(i) and (i % 10 == 0) == y for i in judged) for y in (False, True)]
        cost = np.array([sum(weight[i % 10 == 0] for i in judged if keep(i) and (scores[i] >= t) != (i % 10 == 0)) for t in np.linspace(0.1, 0.9, 81)])
        return np.median(np.linspace(0.1, 0.9, 81)[np.abs(cost - cost.min()) < 1e-5])

    assert abs(model.threshold - least(lambda i: True)) < 1e-9
    assert model.thresholds == {lang: pytest.approx(least(lambda i: i % 3 == k)) for k, lang in enumerate(["en", "de"])}
    assert left == {i for i in range(4000) if scores[i] < model.thresholds.get(["en", "de", None][i % 3], model.threshold)}


def test_fingerprints(docs, empty, spark):
    unique = spark.createDataFrame([r for r in ROWS[:-1] if r[0] is not None], SCHEMA)
    texts = [r[1] or "" for r in ROWS[:-1] if r[0] is not None]
    after = texts[1:] + texts[:1]
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, after)]
    for buckets in (1, 7, None):
        got = sorted(fingerprints.fingerprints(unique, buckets=buckets).collect(), key=lambda r: r["doc_id"])
        assert [(r["n_chars"], r["edited_sha256"]) for r in got] == [(len(t), hashlib.sha256(e.encode()).hexdigest()) for t, e in zip(texts, edited)]
        prints = {t: r["fingerprint"] for t, r in zip(texts, got)}
        assert all(prints[t] == r["fingerprint"] for t, r in zip(texts, got))
        parts = [{r[k][i : i + 8] for i in range(0, len(r[k]), 8)} for k in ("fingerprint",) for r in got]
        for k, r in enumerate(got):
            a, b = parts[k], parts[(k + 1) % len(parts)]
            assert abs(r["near_next"] - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-9
    assert fingerprints.fingerprints(docs).count() == len(ROWS)
    assert fingerprints.fingerprints(empty).count() == 0


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    want = Counter()
    for r in ROWS:
        ids = np.array(whole.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[(r[0], k // 2048, k, len(part), zlib.crc32(part.tobytes()))] += 1
    got = packing.pack_documents(docs, path).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= -(-sum(ends.values()) // 2048) + 1
    assert packing.pack_documents(empty, path).count() == 0


@pytest.mark.parametrize("kind", ["alone", "few beside", "pairs"])
def test_packing_ends_where_no_bin_can_be_filled(spark, monkeypatch, kind):
    """More than a block of pieces that cannot reach the fill a level asks for."""
    levels = []

    def counted(df, name):
        levels.append(name.startswith("pack-level"))
        assert sum(levels) < 12
        return written(df, name)

    monkeypatch.setattr(packing, "written", counted)
    monkeypatch.setattr(packing, "BLOCK", 128)
    rnd = random.Random(6)
    sizes = {
        "alone": [1300] * 600,
        "few beside": [1300] * 400 + [rnd.randrange(5, 500) for _ in range(200)],
        "pairs": [rnd.randrange(690, 1001) for _ in range(600)],
    }[kind]
    items = spark.createDataFrame([(i, i, 0, n) for i, n in enumerate(sizes)], "id long, row long, piece int, length int")
    got = sorted(packing.pack(items).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    assert sorted((r["id"], r["length"]) for r in got) == list(enumerate(sizes))
    ends = {}
    for r in got:
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and sum(n <= 1024 for n in ends.values()) <= 1
    assert len(ends) <= {"alone": 600, "few beside": 402, "pairs": 301}[kind]


def test_ngram_scores(docs, empty):
    train = [r for r in ROWS if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2]
    end, start = 0, 1  # no words
    tokens = lambda r: WORD.findall(low(r[1])) + [end]
    words, pairs = Counter(), Counter()
    for r in train:
        t = tokens(r)
        words.update(t)
        pairs.update(zip([start] + t, t))
    norm = sum(words.values()) + len(words) + 1
    want = {}
    for r in ROWS:
        t, base, score = tokens(r), 0.0, 0.0
        for u, w in zip([start] + t, t):
            p = (words[w] + 1) / norm
            n = words[end] if u == start else words[u]
            m = ngram_lm.MASS * n**ngram_lm.POWER
            base += np.log10(p)
            score += np.log10((pairs[(u, w)] + m * p) / (n + m)) if n else np.log10(p)
        want[r[0]] = (len(t), sum(words[w] > 0 for w in t), base, score)
    got = ngram_lm.score(docs, crc_mod(docs["doc_id"], 7) == 2).collect()
    assert len(got) == len(ROWS)
    for r in got:
        n, known, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, sum(words.values()))
        assert abs(r["base_score"] - base) < 1e-6 and abs(r["score"] - score) <= 0.03 * abs(score) + 1e-6
    assert ngram_lm.score(empty, crc_mod(empty["doc_id"], 7) == 2).count() == 0


def test_common_context_is_spread_over_all_shards(docs, monkeypatch):
    import pyarrow as pa

    text = " ".join(f"the w{i}" for i in range(20000))
    table = pa.table({"text": pa.array([text.encode()], pa.binary()), "held": pa.array([False])})
    the = ngram_lm._tokens(pa.array([b"the"], pa.binary()))[0][:1] >> np.uint64(32)
    load = lambda hot: np.bincount(ngram_lm.Block(table, 400, hot).key_shard.astype(int), minlength=400).max()
    assert load(the) < 200 < 2000 < load(the[:0])  # 40,000 bigrams over 400 shards: 100 each
    held = crc_mod(docs["doc_id"], 7) == 2
    monkeypatch.setattr(ngram_lm, "BLOCK_BYTES", 4000)
    want = sorted(map(str, ngram_lm.score(docs, held).collect()))
    monkeypatch.setattr(ngram_lm, "HOT", 20)
    assert len(ngram_lm.corpus_totals(docs.selectExpr("cast(coalesce(text, '') as binary) AS text", "false AS held"))[4]) > 5
    assert sorted(map(str, ngram_lm.score(docs, held).collect())) == want


def test_codebook_reaches_the_largest_count():
    for top in (0, 10**6, 10**8, 10**9, 10**11):
        counts = np.unique(np.geomspace(1, max(top, 64), 500).astype(np.int64))
        back = ngram_lm.codebook(top)[ngram_lm.quantise(counts, top)]
        assert (back[counts <= 64] == counts[counts <= 64]).all() and np.abs(back / counts - 1).max() < 0.065
    assert (ngram_lm.codebook(10**6) == ngram_lm.codebook()).all()


def test_elias_fano_and_trie_lookup():
    rng = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 9), (500, 10**6), (2000, 2**63)):
        values = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        level = ngram_lm.EliasFano.build(values)
        back, _ = ngram_lm.EliasFano.read(np.frombuffer(b"".join(level.parts()), np.uint8), 0)
        probe = np.concatenate([values, rng.integers(0, top, 50, dtype=np.uint64)])
        assert (back.next_geq(probe) == np.searchsorted(values, probe)).all() and (back[np.arange(len(values))] == values).all()
    keys = np.unique(rng.integers(0, 50, 400, dtype=np.uint64) << np.uint64(32) | rng.integers(0, 2**32, 400, dtype=np.uint64))
    counts = rng.integers(1, 60, len(keys))
    trie = ngram_lm.Trie.load(np.frombuffer(ngram_lm.Trie.dump(keys, counts), np.uint8))
    assert (trie.lookup(keys) == counts).all() and not trie.lookup(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)].any()


def test_exact_duplicates(docs, empty):
    groups = {}
    for r in ROWS:
        groups.setdefault(low(r[1]), []).append(r[0])
    want = Counter((r[0], max((x for x in groups[low(r[1])] if x is not None), default=None), len(groups[low(r[1])]), hashlib.sha256(low(r[1]).encode()).hexdigest()) for r in ROWS)
    got = exact_dedup.exact_dedup(docs).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_binary_fuse_has_no_false_negative():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 10, 1000, 30000):
        keys = rng.integers(0, 2**63, n, dtype=np.uint64)
        held = exact_dedup.BinaryFuse.load(exact_dedup.BinaryFuse.build(keys).dump())
        assert held.maybe(keys).all() and held.maybe(rng.integers(0, 2**63, 20000, dtype=np.uint64)).mean() < 0.01


def test_url_filter(spark):
    rows = [
        (1, "https://blog.GoodNews.Example.net/en/12?x", "<p>good news blog example</p>"), (2, "http://badspot.net/a", "bad spot"),
        (3, "http://x.example.com/de/1", None), (4, "http://y.org/fr/#t", "fr"), (5, "http://z.example.com/en/3", "en"),
        (6, None, None), (7, "no scheme", ""), (8, "ftp://example.net", "x"), (None, "http://q.com/fr", "q"), (5, "http://z.example.com/en/3", "en"),
        (9, "http://notexample.net/en/1", "n"), (10, "HTTP://Ä.Org/fr/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.url_filter(pages).collect()}
    assert url_filter.url_filter(pages).count() == len(rows)
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("blog.goodnews.example.net", "/en/12", "example.net/en/", "allow")
    assert {k: got[k]["rule"] for k in (2, 3, 4, 5, 6, 7, 8, 9, 10)} == {
        2: "net/", 3: "example.com/de/", 4: "org/fr/", 5: None, 6: None, 7: None, 8: None, 9: "net/", 10: "org/fr/"}
    assert (got[6]["host"], got[6]["path"], got[7]["host"]) == ("", "", "") and got[10]["host"] == "Ä.org"
    assert {r["verdict"] for r in got.values()} <= {"allow", "block"}
    assert url_filter.viterbi("goodnews", {"good": -2.0, "news": -2.0, "go": -4.0}, 1000.0) == ["good", "news"]
    assert url_filter.url_filter(pages.limit(0)).count() == 0


def test_registered_queries():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 11)] == [1] * 10 and set(ORACLES) <= set(QUERIES)


def test_pipeline_stages_on_the_awkward_table(docs, spark, sf_small):
    import corpus_pipeline

    frame = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[1:]:
        before, frame = frame, stage(spark, frame, sf_small)
        if name != "packing":
            assert frame.columns == before.columns
            frame = spark.createDataFrame(frame.collect(), frame.schema)
    assert frame.count() > 0
