"""Inter-annotator agreement (Krippendorff's alpha, nominal or interval) as
plain aggregations.

With n_uc = ratings of value c in unit u, m_u = sum_c n_uc, only units with
m_u >= 2 (pairable), N = sum m_u, n_c = sum_u n_uc:

    Do = (1/N) sum_u (m_u^2 - sum_c n_uc^2) / (m_u - 1)
    De = (N^2 - sum_c n_c^2) / (N (N - 1))
    alpha = 1 - Do / De                                  (nominal)

Every rating column is handled in the same job (the columns are unpivoted into
a ``column`` key). Plan, per column:

1. one value per (unit, annotator): ``min_by(value, order)``;
2. counts per (unit, value), so a unit with a third of all ratings still ships
   only (#values x #tasks) rows;
3. per-unit totals, and per-value totals less the units that hold one rating;
4. one global row per column.

All of them are partial aggregates, without a window or a join.

No pair of ratings is ever materialised, no group is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUS_OK = "ok"
STATUS_NOT_ENOUGH_VALUES = "not_enough_values"
STATUS_INSUFFICIENT = "insufficient_data"


def _long(df: DataFrame, unit: str, annotator: str, columns: Sequence[str], order: Column | None, vtype: str) -> DataFrame:
    order_col = order if order is not None else F.lit(None)
    stacked = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(vtype).alias("value")) for c in columns])
    )
    return df.select(
        F.col(unit).cast("string").alias("unit"),
        F.col(annotator).cast("string").alias("annotator"),
        order_col.alias("ord"),
        stacked.alias("s"),
    ).select("unit", "annotator", "ord", "s.column", "s.value").where(F.col("value").isNotNull())


def krippendorff_alpha(
    df: DataFrame,
    unit: str,
    annotator: str,
    columns: Sequence[str],
    order: Column | None = None,
    metric: str = "nominal",
    digits: int | None = None,
) -> DataFrame:
    """One row per rating column:
    ``(column, n_units, n_values, alpha, status)``.

    ``order`` picks the rating kept when an annotator rated a unit twice (the
    smallest ``order`` wins; without it, the smallest value). Rows without
    annotator or value drop out. ``n_values`` counts distinct values in the
    column; fewer than two -> ``not_enough_values``; no pairable unit or no
    expected disagreement -> ``insufficient_data``.
    """
    if metric not in ("nominal", "interval"):
        raise ValueError("metric must be 'nominal' or 'interval'")
    vtype = "string" if metric == "nominal" else "double"
    long = _long(df, unit, annotator, columns, order, vtype)
    # what everything else is counted from: one row per value an annotator gave a unit
    given = long.groupBy("column", "unit", "annotator", "value").agg(F.min("ord").alias("ord"))
    # distinct values of the whole column, as the gate before the computation
    n_values = given.groupBy("column").agg(F.count_distinct("value").alias("n_values"))
    one = given.groupBy("column", "unit", "annotator").agg(
        (F.min_by("value", F.struct("ord", "value")) if order is not None else F.min("value")).alias("value")
    )
    # ratings without annotator count for the gate only; left out here and not before, both read one exchange
    counts = one.groupBy("column", "unit", "value").agg(F.count("annotator").cast("double").alias("n")).where("n > 0")
    # per unit its ratings m and its part of the observed disagreement, by partial aggregation
    n_uc = F.col("n")
    if metric == "nominal":
        sums = [F.sum(n_uc * n_uc).alias("sq")]
        part = (F.col("m") * F.col("m") - F.col("sq")) / (F.col("m") - 1)
    else:
        # interval: sum over pairs of (c - k)^2 n_uc n_uk = 2 (m S2 - S1^2)
        sums = [F.sum(n_uc * F.col("value")).alias("s1"), F.sum(n_uc * F.col("value") * F.col("value")).alias("s2")]
        part = 2 * (F.col("m") * F.col("s2") - F.col("s1") * F.col("s1")) / (F.col("m") - 1)
    units = counts.groupBy("column", "unit").agg(F.sum("n").alias("m"), F.min("value").alias("value"), *sums)
    pairable = F.col("m") >= 2
    # a value's count over pairable units: over all units, less the units that hold a single rating
    alone = units.select("column", "value", F.when(pairable, 0.0).otherwise(-1.0).alias("n"),
                         F.when(pairable, part).otherwise(0.0).alias("d"), pairable.cast("long").alias("u"))
    every = counts.select("column", "value", "n", F.lit(0.0).alias("d"), F.lit(0).cast("long").alias("u"))
    per_value = every.unionByName(alone).groupBy("column", "value").agg(F.sum("n").alias("n_c"), F.sum("d").alias("d"), F.sum("u").alias("u"))
    totals = [F.sum("n_c").alias("N"), F.sum("d").alias("D"), F.sum("u").alias("n_units")]
    if metric == "nominal":
        final = per_value.groupBy("column").agg(*totals, F.sum(F.col("n_c") * F.col("n_c")).alias("S"))
        de_num = F.col("N") * F.col("N") - F.col("S")
    else:
        final = per_value.groupBy("column").agg(
            *totals, F.sum(F.col("n_c") * F.col("value")).alias("S1"), F.sum(F.col("n_c") * F.col("value") * F.col("value")).alias("S2"))
        de_num = 2 * (F.col("N") * F.col("S2") - F.col("S1") * F.col("S1"))
    n, d = F.col("N"), F.col("D")
    de = F.try_divide(de_num, n * (n - 1))
    do = F.try_divide(d, n)
    alpha = F.lit(1.0) - F.try_divide(do, de)
    status = (
        F.when(F.col("n_values") < 2, STATUS_NOT_ENOUGH_VALUES)
        .when(n.isNull() | (n < 2) | de.isNull() | (de == 0), STATUS_INSUFFICIENT)
        .otherwise(STATUS_OK)
    )
    # one row per column from each; a join would filter one side's input and part what both read
    both = final.unionByName(n_values, allowMissingColumns=True)
    both = both.groupBy("column").agg(*[F.max(c).alias(c) for c in both.columns if c != "column"])
    out = both.select(
        "column",
        F.coalesce(F.col("n_units"), F.lit(0)).alias("n_units"),
        F.col("n_values").cast("long").alias("n_values"),
        F.when(status == STATUS_OK, F.bround(alpha, digits) if digits is not None else alpha).alias("alpha"),
        status.alias("status"),
    )
    # columns with no usable rating at all still get a row
    all_cols = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return all_cols.join(out, "column", "left").select(
        "column",
        F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"),
        F.coalesce("n_values", F.lit(0)).cast("long").alias("n_values"),
        "alpha",
        F.coalesce("status", F.lit(STATUS_NOT_ENOUGH_VALUES)).alias("status"),
    )
