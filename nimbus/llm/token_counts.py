"""Token counts through a digest cache.

A text's cache key is the SHA-256 of its UTF-8 bytes together with a digest of
the tokenizer (its file and library version), so counts stay valid until either
changes. Every row joins its key to the stored counts; of the keys that are
missing, one row each is encoded, and the new counts are appended to the cache.
Texts are never grouped: only keys are, and one representative row per missing
key is looked up by its hash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.llm.common import row_hash, written
from nimbus.session import scratch_path

CACHE_SCHEMA = "key binary, n_tokens long"
#: Entries a worker remembers before it starts afresh (bounds its memory, not the result).
WORKER_CACHE = 400_000
_SPACED = re.compile(" *[^ ]+| +$")
_WORKER: dict = {}


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and the version of the library that reads it."""
    import sentencepiece
    import tokenizers

    library = tokenizers.__version__ if path.endswith(".json") else sentencepiece.__version__
    return hashlib.sha256(Path(path).read_bytes() + library.encode()).hexdigest()


def _counter(path: str) -> Callable[[list[str]], list[int]]:
    """Texts to token counts, with the worker's own memory of units.

    A piece model without pieces that hold a space after another character can't
    merge across a run of spaces, so a text's count is the sum over its units (a
    run of spaces with the word after it). A model with such pieces, and every
    tokenizers file, encodes whole texts.
    """
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        return lambda texts: [len(x.ids) for x in whole.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    mark = "▁"
    pieces = (model.id_to_piece(i) for i in range(model.vocab_size()))
    probe = ["a b", "a  b ", " a", "x \n y"]
    if any(mark in p.lstrip(mark) for p in pieces) or encode(["a "]) != [encode(["a"])[0] + 1]:
        return encode
    known: dict[str, int] = {}

    def units(text: str) -> list[str]:
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            parts = _SPACED.findall(text)
            return [p[1:] if i and p[0] == " " else p for i, p in enumerate(parts)]
        return text.split(" ")

    def count(texts: list[str]) -> list[int]:
        if len(known) > WORKER_CACHE:
            known.clear()
        out = []
        cut = [units(t) if t and mark not in t else None for t in texts]
        new = list({u for us in cut if us for u in us if u not in known})
        # an empty unit is the one space a text ends with: one piece of its own
        known.update(zip(new, (n if u else 1 for u, n in zip(new, encode(new)))))
        for text, us in zip(texts, cut):
            out.append(sum(map(known.__getitem__, us)) if us else len(model.encode(text)) if text else 0)
        return out

    return count if count(probe) == encode(probe) else encode


def encode_counts(texts: DataFrame, path: str) -> DataFrame:
    """(key, n_tokens) of a frame (key, text), encoded whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _WORKER:
            _WORKER[path] = _counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts = _WORKER[path](part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("key").cast(pa.binary()), pa.array(counts, pa.int64())], ["key", "n_tokens"])

    return texts.mapInArrow(run, CACHE_SCHEMA)


def _stored(spark: SparkSession, cache: str) -> DataFrame:
    try:
        found = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = spark.createDataFrame([], CACHE_SCHEMA)
    # two runs may have stored the same key at once
    return found.groupBy("key").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per input row, with the cache at ``cache`` read and appended to.

    ``tokenizer`` is the path of a ``.model`` or ``.json`` file, the same on every machine.
    ``cache`` None starts an empty cache in the shared scratch folder. Null texts count as
    empty: no bytes, no tokens. Repeated rows each get their row; null ids stay null.
    """
    spark = docs.sparkSession
    cache = cache or scratch_path(spark, "token-cache")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    version = tokenizer_version(tokenizer)
    key = F.unhex(F.sha2(F.concat(F.lit(version), text), 256))
    rows = written(
        docs.select(F.col(id_col).alias("id"), row_hash(docs).alias("row"), key.alias("key"), F.octet_length(text).cast("long").alias("n_bytes")),
        "token-keys",
    )
    wanted = rows.groupBy("key").agg(F.min("row").alias("row"))
    misses = wanted.join(_stored(spark, cache).select("key"), "key", "left_anti").select("row")
    texts = docs.select(row_hash(docs).alias("row"), key.alias("key"), text.alias("text")).join(misses, "row", "left_semi")
    encode_counts(texts.select("key", "text"), tokenizer).write.mode("append").parquet(cache)
    return rows.join(_stored(spark, cache), "key", "left").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
