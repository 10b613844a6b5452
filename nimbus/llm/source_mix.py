"""Mixing sources to target weights by Pivotal dependent rounding, in DataFrame operations only.

Sources get shares of a word budget by weight, none above ``cap`` times its own
size (water filling). A source's documents then all have the same copy rate; its
whole part is certain and its fraction is rounded dependently: two units with
fractional copy probability meet, and word mass moves from one to the other, in
a random direction with the odds that keep both expectations, until one of them
is integral. The sum of size times copies never moves, so a source's words miss
its target by less than one document.

The pairing runs as a reduction tree: units are dealt by hash into blocks of
about 64 within their source, a block folds its units into at most one that is
still fractional, and those residuals are dealt into the blocks of the next
level. A source of any size is spread over as many blocks as it needs. Rows equal
in every column are rounded among themselves first, by their count: any number of
them leaves at most one unit to the tree. All randomness is a hash of the rows and
the seed, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbus.llm.common import WORD, columns_of, row_key, with_row_key, written

BLOCK = 64
#: Equal rows are written out again in runs of this length.
RUN = 4096
_UNIT = "struct<size:bigint,key:bigint,id:{id},row:string,p:double>"


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """(source, number, n, source_size, target, base, p) per source of a frame (source, size).

    Sources by code point, null last, take ``weights`` in turn. The budget is ``share`` of all
    sizes; a source's target stops at ``cap`` times its size and the excess is reshared by
    weight: min(cap * size, level * weight) with one level, found from running sums over the
    sources ordered by cap * size / weight. ``base`` and ``p`` split the copy rate.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    # one row per source from here on
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))
    each = each.withColumn("number", number).withColumn("weight", pick).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    each = (
        each.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("most").over(order), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)))
        .withColumn("level", F.max((F.col("budget") - F.col("full")) / F.col("left")).over(everything))
        .withColumn("target", F.least("most", F.col("level") * F.col("weight")))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return each.select("source", "number", "n", "source_size", "target", F.floor(rate).alias("base"), (rate - F.floor(rate)).alias("p"))


def _uniform(*cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _meet(state: Column, b: Column, seed: int) -> Column:
    """One pivotal step of the fold: the carried unit meets the next, one of them is settled."""
    a = state["carry"]
    mass_a, room_a = a["p"] * a["size"], (1 - a["p"]) * a["size"]
    mass_b, room_b = b["p"] * b["size"], (1 - b["p"]) * b["size"]
    up, down = F.least(room_a, mass_b), F.least(mass_a, room_b)
    rises = F.coalesce(_uniform(a["key"], b["key"], F.lit(seed)) < F.try_divide(down, up + down), F.lit(False))
    # which one becomes integral: the one whose own limit stops the transfer
    a_settles = F.when(rises, room_a <= mass_b).otherwise(mass_a <= room_b)
    to_b = F.when(rises, -room_a).otherwise(mass_a) / b["size"]
    to_a = F.when(rises, mass_b).otherwise(-room_b) / a["size"]

    def unit(u: Column, p: Column) -> Column:
        return F.struct(u["size"].alias("size"), u["key"].alias("key"), u["id"].alias("id"), u["row"].alias("row"), p.alias("p"))

    one_if = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
    settled = F.when(a_settles, unit(a, one_if(rises))).otherwise(unit(b, one_if(~rises)))
    bounded = lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
    carry = F.when(a_settles, unit(b, bounded(b["p"] + to_b))).otherwise(unit(a, bounded(a["p"] + to_a)))
    return F.struct(F.concat(state["done"], F.array(settled)).alias("done"), carry.alias("carry"))


def _meeting(seed: int):
    return lambda state, unit: _meet(state, unit, seed)


def _repeated(rows: DataFrame) -> DataFrame:
    """``rows`` (number, id, row, size, extra, times), each as often as ``times`` says.

    What comes more than once is cut into runs that are dealt out, so that no task makes all of it.
    """
    columns = ["number", "id", "row", "size", "extra"]
    runs = rows.where("times > 1").withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / RUN))))
    runs = runs.repartition("number", "id", "row", "run")
    length = F.least(F.lit(RUN), F.col("times") - F.col("run") * RUN)
    many = runs.withColumn("nr", F.explode(F.sequence(F.lit(1).cast("long"), length.cast("long"))))
    return rows.where("times = 1").select(*columns).unionByName(many.select(*columns))


def round_equal(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pivotal rounding of rows equal in every column among themselves, by their count.

    ``times`` such units have the mass of times * p copies: as many as its whole part are taken,
    at most one is left fractional, the others are not taken. Gives the settled ones
    (number, id, row, size, extra 0/1, times) and those left, in the columns of ``units``.
    """
    times = units.groupBy(*units.columns).agg(F.count("*").alias("times"))
    groups = written(times, "mix-equal")
    single, mass = groups.where("times = 1").drop("times"), F.col("times") * F.col("p")
    shared = groups.where("times > 1").withColumn("taken", F.floor(mass).cast("long")).withColumn("rest", mass - F.floor(mass))
    not_taken = F.col("times") - F.col("taken") - (F.col("rest") > 0).cast("long")
    each = F.explode(F.array(F.struct(F.lit(1).alias("extra"), F.col("taken").alias("times")), F.struct(F.lit(0).alias("extra"), not_taken.alias("times"))))
    settled = shared.select("number", "id", "row", "size", each.alias("x")).select("number", "id", "row", "size", "x.*").where("times > 0")
    left = single.unionByName(shared.where("rest > 0").withColumn("p", F.col("rest")).select(*units.columns))
    return settled, left


def round_rates(units: DataFrame, largest: int, seed: int) -> DataFrame:
    """(number, id, row, size, extra 0/1) of a frame (number, n, size, id, row, p) with 0 < p < 1, size > 0.

    ``largest`` is the row count of the largest source; it sets the tree's height.
    """
    kind = _UNIT.format(id=units.schema["id"].dataType.simpleString())
    equal, left = round_equal(units)
    left = left.withColumn("key", F.xxhash64("id", "row", F.lit(seed)))
    done, level = [_repeated(equal)], 0
    while True:
        largest = -(-largest // BLOCK)
        left = left.withColumn("n", F.ceil(F.col("n") / BLOCK))
        block = F.pmod(F.xxhash64("key", F.lit(seed + level)), F.greatest(F.col("n"), F.lit(1)))
        blocks = left.groupBy("number", "n", block.alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("size", "key", "id", "row", "p")), asc=False).alias("units")
        )
        start = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.element_at("units", 1).cast(kind).alias("carry"))
        # the fold starts from the first (largest) unit, so small ones are left for the fine adjustment
        rest = F.slice("units", F.lit(2), F.size("units"))
        folded = blocks.select("number", "n", F.aggregate(rest, start, _meeting(seed + level)).alias("s"))
        out = written(
            folded.select("number", "n", F.explode(F.concat(
                F.transform("s.done", lambda u: F.struct(u.alias("u"), F.lit(True).alias("settled"))),
                F.array(F.struct(F.col("s.carry").alias("u"), F.lit(False).alias("settled"))),
            )).alias("x")).select("number", "n", "x.u.*", "x.settled"),
            f"mix-level-{level}",
        )
        done.append(out.where("settled").select("number", "id", "row", "size", F.col("p").cast("int").alias("extra")))
        left = out.where("NOT settled").drop("settled")
        level += 1
        if largest <= 1:
            break
    # one unit per source is left; the nearer integer keeps the source closest to its target
    last = F.round("p").cast("int")
    result = left.select("number", "id", "row", "size", last.alias("extra"))
    for part in done:
        result = result.unionByName(part)
    return result


def source_mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 17,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, row, size, source_size, target, copies, taken) per input row.

    ``size`` counts words (null text: 0); ``row`` hashes the whole row; ``copies`` is how often
    the mix takes the row, ``taken`` the words that makes. Documents without words are rounded
    each on its own. Rows equal in every column are units of their own with the same ``row``.
    Null sources form one source, last in order. An empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = written(
        docs.select(F.col(id_col).alias("id"), row_key(docs).alias("row"), F.col(source_col).cast("string").alias("source"), size.alias("size")),
        "mix-sizes",
    )
    sources = written(source_targets(sizes, weights, share, cap), "mix-sources")
    largest = sources.agg(F.max("n")).first()[0] or 0
    tagged = sizes.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.id", "d.row", "d.size", "s.number", "s.n", "s.p")
    fractional = (F.col("p") > 0) & (F.col("size") > 0)
    free = tagged.where(~fractional).select("number", "id", "row", "size", (_uniform(F.col("id"), F.col("row"), F.lit(seed)) < F.col("p")).cast("int").alias("extra"))
    extra = free.unionByName(round_rates(tagged.where(fractional), largest, seed))
    return extra.join(sources.drop("source", "n", "p"), "number").select(
        F.col("id").alias(id_col), "row", "size", "source_size", "target",
        (F.col("base") + F.col("extra")).alias("copies"), (F.col("size") * (F.col("base") + F.col("extra"))).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it, columns as they were."""
    rows, key = with_row_key(docs)
    copies, equal, copy = (f"{key}_{c}" for c in ("copies", "equal", "copy"))
    taken = source_mix(docs, **options).groupBy(F.col("row").alias(key)).agg(F.sum("copies").alias(copies), F.count("*").alias(equal))
    rows = rows.join(taken.where(F.col(copies) > 0), key)
    # rows equal in every column share their copies: one of them stands for all
    single, shared = rows.where(F.col(equal) == 1), rows.where(F.col(equal) > 1).dropDuplicates([key])
    return single.unionByName(shared).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*columns_of(docs))
