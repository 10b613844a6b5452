"""Toxicity: a convolutional text classifier trained in numpy.

Words (letter runs, A-Z as a-z) hash to 64 bits; those in at least two training
texts own an embedding row, all others share a zero row. Filters of widths 1 to
3 slide over the embeddings, each keeps its maximum over the whole text, and a
logistic layer weighs the maxima. Only the winning windows get gradient, so a
training step costs little more than a forward pass.

Training takes a bounded sample of the labelled rows (``SAMPLE`` of each class,
chosen by a hash of the id); everything else covers all rows, the thresholds too:
they come from counts of every labelled row's score. For scoring each
filter tap is multiplied into the embedding table once per worker, so a window
costs a few row lookups and additions.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from nimbus.llm.common import NOT_LETTER, buffer_chunks, crc_mod, word_hashes

#: At most so many labelled rows of each class train the model.
SAMPLE = 2000
DIM, FILTERS, WIDTHS, EPOCHS, BATCH = 8, 12, (1, 2, 3), 12, 32
_LAST = max(WIDTHS) - 1
#: Thresholds to choose from, and the rows of label 1 a language needs for one of its own.
GRID, LEAST_TOXIC = np.linspace(0.1, 0.9, 81), 20


@dataclass
class Model:
    words: np.ndarray  # sorted hashes that own a row
    table: np.ndarray  # row 0 is the shared zero row
    taps: dict[int, np.ndarray]  # width -> (width, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    shift: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5
    used: list = field(default_factory=list)  # places, then ids, of the texts it was fitted on

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == hashes, at + 1, 0) if len(self.words) else np.zeros(len(hashes), np.int64)

    def products(self) -> list[list[np.ndarray]]:
        return [[np.ascontiguousarray(self.table @ self.taps[w][j]) for j in range(w)] for w in WIDTHS]


def _maxima(ids: np.ndarray, offsets: np.ndarray, products) -> np.ndarray:
    """(texts, widths * FILTERS) maxima over windows; a window may run past the text's end into zero rows."""
    n = len(offsets) - 1
    out = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
    filled = np.flatnonzero(np.diff(offsets))
    if not len(filled):
        return out
    # zero rows after each text keep windows from reading the next one
    gap = np.repeat(np.arange(n) * _LAST, np.diff(offsets))
    padded = np.zeros(len(ids) + n * _LAST + _LAST, np.int64)
    padded[np.arange(len(ids)) + gap] = ids
    places = np.arange(len(ids)) + gap
    for k, taps in enumerate(products):
        score = taps[0][padded[places]]
        for j in range(1, len(taps)):
            score += taps[j][padded[places + j]]
        out[filled, k * FILTERS : (k + 1) * FILTERS] = np.maximum.reduceat(score, offsets[filled])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _probability(model: Model, ids: np.ndarray, offsets: np.ndarray, products) -> np.ndarray:
    hidden = np.maximum(_maxima(ids, offsets, products) + model.bias, 0)
    return _sigmoid(hidden @ model.out + model.shift)


def train(texts: list[bytes], labels: np.ndarray, prior: float, seed: int = 5) -> Model:
    """Fit on ``texts``; ``prior`` is the share of label 1 among all labelled rows (weights the classes).

    One text in five is held back, so that thresholds can be set even where all labelled rows are in
    the sample. With one class only, the model answers that class's share and its threshold rejects nothing.
    """
    rng = np.random.default_rng(seed)
    docs = []
    for t in texts:
        data = np.frombuffer(t, np.uint8)
        docs.append(word_hashes(data, np.array([0, len(data)]), NOT_LETTER)[0])
    seen, count = np.unique(np.concatenate([np.unique(d) for d in docs] or [np.zeros(0, np.uint64)]), return_counts=True)
    words = seen[count >= 2]
    model = Model(
        words, (rng.standard_normal((len(words) + 1, DIM)) * 0.1).astype(np.float32),
        {w: (rng.standard_normal((w, DIM, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS},
        np.zeros(len(WIDTHS) * FILTERS, np.float32), (rng.standard_normal(len(WIDTHS) * FILTERS) * 0.3).astype(np.float32),
        float(np.log(max(prior, 1e-4) / max(1 - prior, 1e-4))),
    )
    model.table[0] = 0
    labels = np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        model.out[:] = 0
        model.threshold = 2.0
        return model
    ids = [model.rows(d) for d in docs]
    held = rng.random(len(docs)) < 0.2
    use = np.flatnonzero(~held)
    share = labels[use].mean()
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share)).astype(np.float32)
    weight = weight ** 0.5  # between the sample's odds and the corpus's
    memory = {"table": np.full(model.table.shape, 1e-8, np.float32), "bias": 1e-8, "out": 1e-8, "shift": 1e-8} | {w: 1e-8 for w in WIDTHS}

    def step(name, param, grad, rate=0.05):
        memory[name] = memory[name] + grad * grad
        param -= rate * grad / np.sqrt(memory[name])

    for epoch in range(EPOCHS):
        order = rng.permutation(use)
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            lengths = np.array([len(ids[i]) + _LAST for i in pick])
            starts = np.concatenate([[0], np.cumsum(lengths)])
            flat = np.zeros(starts[-1] + _LAST, np.int64)
            for i, s in zip(pick, starts):
                # a word is dropped now and then, so that no single one decides
                flat[s : s + len(ids[i])] = ids[i] * (rng.random(len(ids[i])) > 0.1)
            x = model.table[flat]
            hidden = np.zeros((len(pick), len(WIDTHS) * FILTERS), np.float32)
            best = np.zeros(hidden.shape, np.int64)
            for k, w in enumerate(WIDTHS):
                score = sum(x[j : starts[-1] + j] @ model.taps[w][j] for j in range(w))
                for row in range(len(pick)):
                    n = len(ids[pick[row]])
                    if n:
                        part = score[starts[row] : starts[row] + n]
                        win = part.argmax(0)
                        best[row, k * FILTERS : (k + 1) * FILTERS] = win + starts[row]
                        hidden[row, k * FILTERS : (k + 1) * FILTERS] = part[win, np.arange(FILTERS)]
            active = hidden + model.bias > 0
            values = np.where(active, hidden + model.bias, 0)
            delta = (_sigmoid(values @ model.out + model.shift) - labels[pick]) * weight[pick] / len(pick)
            back = np.outer(delta, model.out) * active
            rows, grads = [], []
            for k, w in enumerate(WIDTHS):
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                tap_grad = np.empty_like(model.taps[w])
                for j in range(w):
                    at_word = flat[best[:, cols] + j]
                    tap_grad[j] = np.einsum("rfd,rf->df", model.table[at_word], back[:, cols])
                    rows.append(at_word.ravel())
                    grads.append((back[:, cols, None] * model.taps[w][j].T[None]).reshape(-1, DIM))
                step(w, model.taps[w], tap_grad + 1e-4 * model.taps[w])
            step("bias", model.bias, back.sum(0))
            step("out", model.out, values.T @ delta + 1e-3 * model.out)
            shift = np.array([model.shift], np.float32)
            step("shift", shift, np.array([delta.sum()], np.float32))
            model.shift = float(shift[0])
            rows, grads = np.concatenate(rows), np.concatenate(grads)
            touched, place = np.unique(rows, return_inverse=True)
            grad = np.zeros((len(touched), DIM), np.float32)
            np.add.at(grad, place, grads)
            keep = touched > 0
            touched, grad = touched[keep], grad[keep] + 1e-4 * model.table[touched[keep]]
            memory["table"][touched] += grad * grad
            model.table[touched] -= 0.05 * grad / np.sqrt(memory["table"][touched])
    model.used = use.tolist()
    return model


def _labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, y) of the labels to learn from: 0 or 1, with an id whose crc32 as text mod 4 is not 2."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    return own.where(crc_mod(F.col("id"), 4) != 2).groupBy("id").agg(F.max("y").alias("y"))


def _best(counts: np.ndarray, weight: np.ndarray) -> float:
    """The threshold with the least weighted errors; ``counts[y, k]`` rows of label y reach k values of ``GRID``."""
    below = np.cumsum(counts, 1)[:, :-1]  # rows under each threshold
    errors = np.round(weight[0] * (counts[0].sum() - below[0]) + weight[1] * below[1], 6)
    return float(np.median(GRID[errors == errors.min()]))


def calibrate(model: Model, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang", label_col: str = "toxic") -> Model:
    """``model`` with the thresholds of the fewest errors over all labelled rows (mod 4 not 2).

    Per language where at least ``LEAST_TOXIC`` rows of label 1 can be judged, else over all. Rows the
    model was fitted on are not judged; the others of their language and label count for them, so
    that each label weighs what it does among all labelled rows, at any size.
    """
    if not model.used:
        return model
    spark = docs.sparkSession
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang")).join(_labelled(labels, id_col, label_col), "id")
    used = spark.createDataFrame([(i,) for i in model.used], StructType([StructField("id", rows.schema["id"].dataType)])).withColumn("used", F.lit(True))
    scored = score(rows.join(F.broadcast(used), "id", "left"), model, keep=("lang", "y", "used"))
    # how many values of the grid the score reaches
    place = F.size(F.filter(F.array(*[F.lit(float(t)) for t in GRID]), lambda t: t <= F.col("score")))
    place = F.when(F.col("used").isNull(), place).otherwise(F.lit(-1))
    every, judged = {}, {}
    for r in scored.groupBy("lang", "y", place.alias("place")).count().collect():
        for key in {(r["lang"],), ()}:
            every.setdefault(key, np.zeros(2))[r["y"]] += r["count"]
            if r["place"] >= 0:
                judged.setdefault(key, np.zeros((2, len(GRID) + 1)))[r["y"], r["place"]] += r["count"]
    for key, counts in judged.items():
        limit = _best(counts, every[key] / np.maximum(counts.sum(1), 1))
        if not key:
            model.threshold = limit
        elif key[0] is not None and counts[1].sum() >= LEAST_TOXIC:
            model.thresholds[key[0]] = limit
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Train on labelled rows whose crc32(id as text) mod 4 is not 2, at most ``sample`` of each class.

    One task trains on that bounded sample; the driver gets the finished model. Labels other than 0 and 1, and null ids, are passed over;
    a row labelled both ways counts as 1. Without labels the model answers 0.5. ``calibrate`` sets the thresholds.
    """
    own = _labelled(labels, id_col, label_col)
    counts = {r.y: r["count"] for r in own.groupBy("y").count().collect()}
    order = F.xxhash64("id")
    some = own.where("y = 1").orderBy(order, "id").limit(sample).unionByName(own.where("y = 0").orderBy(order, "id").limit(sample))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(some), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
    prior = counts.get(1, 0) / sum(counts.values()) if counts else 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["id"])
        model = train([r["text"].encode() for r in got], np.array([r["y"] for r in got]), prior)
        model.used = [got[i]["id"] for i in model.used]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = rows.select("id", "text", "y").repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(made["model"]) if made else train([], np.zeros(0), prior)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``score`` in [0, 1], from the text alone.

    Null texts count as empty; a text without words scores the model's base rate.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("__text")
    rows = docs.select(text, *[F.col(c) for c in keep])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = shared.value.products()
        for batch in batches:
            out = np.empty(batch.num_rows)
            for first, end, data, offsets in buffer_chunks(batch.column(0)):
                hashes, at = word_hashes(data, offsets, NOT_LETTER)
                out[first:end] = _probability(shared.value, shared.value.rows(hashes), at, products)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out)], [*keep, "score"])

    return rows.mapInArrow(run, schema)


def reject(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold of their language; columns as they were."""
    model = calibrate(fit(docs, labels, sample), docs, labels)
    # columns by place: a document's own may be called score, or hold dots
    places = [f"__{k}" for k in range(len(docs.columns))]
    at = dict(zip(docs.columns, places))
    limits = F.lit(model.threshold)
    for lang, limit in sorted(model.thresholds.items()) if "lang" in at else ():
        limits = F.when(F.col(at["lang"]) == lang, F.lit(limit)).otherwise(limits)
    marked = score(docs.toDF(*places), model, text_col=at["text"], keep=tuple(places))
    return marked.where(F.col("score") < limits).select(*places).toDF(*docs.columns)
