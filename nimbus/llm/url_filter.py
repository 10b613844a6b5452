"""URL filter: rules first, then naive Bayes over segmented host and path words.

Host labels are concatenated names. A unigram model of the pages' own words
splits them: every distinct label joins its substrings to the word counts, and
a Viterbi pass picks the most probable split. Pages that a rule decides train a
multinomial naive Bayes model over host and path words (counted over all pages);
it judges the pages no rule fits.

Words are counted per task before they are shuffled. Scores are summed per
distinct url. Words that make up more than one thousandth of all occurrences
(so at most a thousand of them) are broadcast, the others are joined by shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import lower_az, written

#: (host and path prefix, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
LONGEST_WORD = 20
HOT_SHARE = 1000
_TAG, _WORD = re.compile(rb"<[^>]*>"), re.compile(rb"[a-z]{2,20}")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; null or without ``://`` both are empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_az(host), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (null, null when none does)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: len(r[0])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of a frame with one binary column of markup or text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for x in batch.column(0):
                seen.update(_WORD.findall(_TAG.sub(b" ", x.as_py()).lower()))
            if len(seen) > 300_000:
                yield flush(seen)
                seen = Counter()
        yield flush(seen)

    def flush(seen: Counter) -> pa.RecordBatch:
        words = [w.decode() for w in seen]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(name: str, logs: dict[str, float], total: float) -> list[str]:
    """The most probable split of ``name``; unknown words cost ten times more per letter."""
    best, cut = [0.0], [0]
    for end in range(1, len(name) + 1):
        score, at = max(
            (best[start] + logs.get(name[start:end], math.log(10 / total) - (end - start) * math.log(10)), start)
            for start in range(max(0, end - LONGEST_WORD), end)
        )
        best.append(score)
        cut.append(at)
    out, end = [], len(name)
    while end:
        out.append(name[cut[end] : end])
        end = cut[end]
    return out[::-1]


def segment(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, words) of a frame of distinct ``name``, split by the unigram counts ``words`` (word, n)."""
    total = float(words.agg(F.sum("n")).first()[0] or 1)
    length = F.length("name")
    spans = F.flatten(F.transform(F.sequence(F.lit(1), length), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), length - i + 1)), lambda n: F.substring("name", i, n))))
    pieces = names.where(length > 0).select("name", F.explode(F.array_distinct(spans)).alias("word"))
    known = pieces.join(words, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("known"))  # bounded by the name's length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                logs = {k["word"]: math.log(k["n"] / total) for k in row["known"] or ()}
                out.append({"name": row["name"], "words": viterbi(row["name"], logs, total)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("name", pa.string()), ("words", pa.list_(pa.string()))]))

    return names.where(length > 0).join(known, "name", "left").mapInArrow(run, "name string, words array<string>")


def url_filter(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """Per input row: id, host, path, rule, verdict, score (log odds of block, null for rule pages).

    Null urls and urls without ``://`` have empty host and path, fit no rule and are judged by
    the class sizes alone. Null texts hold no words. If rules decide only one class, or none,
    the smoothed model still judges; ties allow. Repeated rows each get their row.
    """
    url = F.col(url_col).cast("string")
    host, path = host_path(url)
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")).withColumn("rule", rule).withColumn("says", says)
    urls = written(rows.groupBy("host", "path", "rule", "says").agg(F.count("*").alias("pages")), "urls")
    names = urls.select(F.explode(F.split("host", "[^a-z]+")).alias("name")).union(
        urls.select(F.explode(F.split(F.lower("path"), "[^a-z]+")))).where("name <> ''").distinct()
    words = written(word_counts(pages.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("x"))), "url-unigrams")
    split = written(segment(names, words), "url-names")
    token = urls.select("*", F.explode(F.array_remove(F.split(F.concat_ws("/", "host", F.lower("path")), "[^a-z]+"), "")).alias("name"))
    # a name may be in most urls: the distinct names are few rows, and AQE splits the large side
    tokens = written(token.join(split, "name").select("host", "path", "says", "pages", F.explode("words").alias("word")), "url-tokens")
    is_block, is_allow = F.col("says") == "block", F.col("says") == "allow"
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("pages"))), F.lit(0))
    model = written(tokens.groupBy("word").agg(count(is_block).alias("b"), count(is_allow).alias("a"), F.count("*").alias("n")), "url-model")
    sums = model.agg(F.sum("b"), F.sum("a"), F.count("*"), F.sum("n")).first()
    blocks, allows, size, uses = (x or 0 for x in sums)
    prior = urls.agg(count(is_block), count(is_allow)).first()
    odds = math.log(((prior[0] or 0) + 1) / ((prior[1] or 0) + 1))
    weight = F.log((F.col("b") + 1) / (blocks + size + 1)) - F.log((F.col("a") + 1) / (allows + size + 1))
    model = model.select("word", "n", weight.alias("weight"))
    hot = F.broadcast(model.where(F.col("n") * HOT_SHARE >= uses))
    open_ = tokens.where("says IS NULL").select("host", "path", "word")
    parts = open_.join(hot, "word").unionByName(open_.join(hot, "word", "left_anti").join(model, "word"))
    scores = parts.groupBy("host", "path").agg((F.sum("weight") + odds).alias("score"))
    scored = rows.join(scores, ["host", "path"], "left")
    score = F.when(F.col("says").isNull(), F.coalesce("score", F.lit(odds)))
    verdict = F.coalesce("says", F.when(score > 0, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))
