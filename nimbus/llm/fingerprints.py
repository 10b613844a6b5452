"""Document fingerprints of closed syncmers, in DataFrame operations only.

A text is its sequence of word hashes. A k-mer (k words) is selected when the
smallest of its s-mers lies at its first or last place: a closed syncmer. The
choice depends on the k-mer alone, so a passage selects the same anchors in any
surroundings, and an edit only touches the k-mers that overlap it. The
fingerprint lists the anchors' 32-bit hashes in text order, so equal passages
show as equal runs; the likeness of two fingerprints is the Jaccard index of
their anchors. A text with no anchor is fingerprinted by its word hashes.

Successors in id order come from one shuffle: rows go to buckets of the id
range, each bucket also holds the first row of the next bucket, and a window
inside the bucket does the rest. Two windows share the shuffle and the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbus.llm.common import shuffle_parts

K, S = 6, 2
_LOWEST = -(1 << 63)


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with column ``out``: the 32-bit hashes of the closed syncmers of column ``text``, in order.

    Each step is a projection of its own and is used more than once by the next,
    so it is computed once per row.
    """
    h, m, at = f"__h_{out}", f"__m_{out}", f"__at_{out}"
    words = F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), "")
    df = df.withColumn(h, F.transform(words, lambda w: F.xxhash64(w)))
    none = F.array().cast("array<bigint>")
    df = df.withColumn(m, F.when(F.size(h) >= S, F.transform(F.sequence(F.lit(0), F.size(h) - S), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(S)]))).otherwise(none))
    edge = lambda i: F.least(F.get(m, i), F.get(m, i + (K - S)))
    inner = lambda i: F.least(*[F.get(m, i + j) for j in range(1, K - S)])
    closed = F.filter(F.sequence(F.lit(0), F.size(m) - (K - S) - 1), lambda i: edge(i) <= inner(i))
    df = df.withColumn(at, F.when(F.size(m) >= K - S + 1, closed).otherwise(F.array().cast("array<int>")))
    anchors = F.transform(at, lambda i: F.hash(*[F.get(m, i + j) for j in range(0, K, S)]))
    df = df.withColumn(out, F.when(F.size(at) > 0, anchors).otherwise(F.transform(h, lambda x: F.hash(x))))
    return df.drop(h, m, at)


def fingerprint_text(anchors: Column) -> Column:
    """Anchors as text: eight hex digits each, in text order."""
    return F.array_join(F.transform(anchors, lambda x: F.lpad(F.hex(x.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Jaccard index of two distinct-anchor columns; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def id_buckets(docs: DataFrame, key: Column, buckets: int) -> Column:
    """A bucket number for every id: how many of the (approximate) id quantiles lie below it.

    The driver sees the quantiles only, ``buckets`` numbers at most. The lookup is
    in two steps, so that it costs the root of their number per row.
    """
    cuts = sorted(set(docs.select(key.cast("double").alias("k")).approxQuantile("k", [i / buckets for i in range(1, buckets)], 0.2 / buckets))) if buckets > 1 else []
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    k = key.cast("double")
    literal = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    coarse = F.size(F.filter(literal(cuts[::step]), lambda c: c <= k))
    fine = F.size(F.filter(F.slice(literal(cuts), F.greatest(coarse - 1, F.lit(0)) * step + 1, F.lit(step)), lambda c: c <= k))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + fine)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_anchors.

    The edited text replaces the last floor(n_chars / 2) code points by the first as many (or
    all) of the next row's text, in ascending id; after the last row comes the first. Null texts
    are empty and have an empty fingerprint; two empty fingerprints have likeness 1. Null ids sort
    first. Rows that share an id follow the order of a hash of their text; equal rows are alike,
    so their order doesn't matter. A single row is its own successor.
    """
    buckets = buckets or 4 * shuffle_parts(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LOWEST)).alias("key"), text.alias("text"))
    rows = rows.withColumn("bucket", id_buckets(rows, F.col("key"), buckets))
    # one row per bucket: its lowest id, and the bucket before it (before the first: the last)
    order = Window.orderBy("bucket")
    heads = rows.groupBy("bucket").agg(F.min("key").alias("key")).select(
        "key", F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy())).alias("before")
    )
    both = rows.join(F.broadcast(heads), "key", "left").withColumn(
        "place", F.explode(F.when(F.col("before").isNull(), F.array(F.struct("bucket", F.lit(False).alias("guest"))))
                           .otherwise(F.array(F.struct("bucket", F.lit(False).alias("guest")), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("guest")))))
    ).select("id", "key", "text", F.col("place.bucket").alias("bucket"), F.col("place.guest").alias("guest"))
    both = both.withColumn("tie", F.xxhash64("text"))
    window = Window.partitionBy("bucket").orderBy("guest", "key", "tie")
    both = both.withColumn("next", F.lead("text").over(window))
    both = both.withColumn("n_chars", F.length("text").cast("long")).withColumn("cut", F.floor(F.col("n_chars") / 2).cast("int"))
    both = both.withColumn("edited", F.when(~F.col("guest"), F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - F.col("cut")).cast("int")), F.substring("next", F.lit(1), F.col("cut"))))).drop("next")
    both = with_anchors(both, "text", "anchors").drop("text")
    both = both.withColumn("own", F.array_distinct("anchors")).withColumn("follow", F.lead("own").over(window))
    out = both.where("NOT guest").withColumn("edited_sha256", F.sha2("edited", 256))
    out = with_anchors(out, "edited", "new_anchors").drop("edited").withColumn("new", F.array_distinct("new_anchors"))
    return out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", fingerprint_text(F.col("anchors")).alias("fingerprint"),
        fingerprint_text(F.col("new_anchors")).alias("edited_fingerprint"), likeness("own", "new").alias("near_edited"),
        likeness("own", "follow").alias("near_next"), F.size("anchors").cast("long").alias("n_anchors"),
    )
