"""Running totals over an ordered histogram without a single-task window, and exact medians
built on them.

A window ``orderBy(x)`` with no partition (or one partition per column) moves every row of a
group into one task. Here the input is first collapsed to distinct ordering values (a
map-side-combined ``groupBy``) and counted. The histogram is range-partitioned into buckets of
about ``ROWS_PER_BUCKET`` rows (two at least, their number grows with the data), each bucket sums
locally in its own task, and the bucket totals (groups x buckets rows) give the offsets, which
are broadcast back. No task holds more than one bucket, however skewed the original data is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime_spark.session import materialize

# Histogram rows that one task sums: ceil(rows / ROWS_PER_BUCKET) range buckets, two at least.
ROWS_PER_BUCKET = 1_000_000


def running_totals(hist: DataFrame, keys: Sequence[str], order_col: str,
                   value_cols: Sequence[str], descending: bool = False,
                   buckets: int | None = None, prefix: str = "cum_",
                   rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``cum_<v>``: the inclusive running sum of each value column within ``keys``,
    ordered by ``order_col`` (distinct per key group) ascending or descending.

    The histogram is counted, then Spark's range partitioner (sampled bounds, binary search per
    row) cuts it into ``ceil(rows / rows_per_bucket)`` buckets, two at least, ordered by
    (keys, order); the bucket id is written with the rows once (so it cannot change if a task is
    recomputed); each bucket computes local sums in its own task and adds the totals of the
    earlier buckets of its key group (a table of groups x buckets rows, broadcast). ``buckets``
    overrides the bucket count (tests)."""
    keys = list(keys)
    out_cols = list(hist.columns)
    ox = F.col(order_col).desc() if descending else F.col(order_col).asc()
    limit = ROWS_PER_BUCKET if rows_per_bucket is None else rows_per_bucket
    # The histogram is read twice (count, then sums): write it once so its source (a scan and
    # aggregation, or a model scoring a test set) is evaluated once.
    hist = materialize(hist, "histogram")
    n_buckets = buckets or max(2, math.ceil(hist.count() / max(limit, 1)))
    ranged = hist.repartitionByRange(n_buckets, *[F.col(k) for k in keys], ox)
    tagged = materialize(ranged.withColumn("_bucket", F.spark_partition_id()), "running-buckets")

    totals = tagged.groupBy(*keys, "_bucket").agg(
        *[F.sum(v).alias(f"_tot_{v}") for v in value_cols])
    w_off = (Window.partitionBy(*keys).orderBy("_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*keys, "_bucket", *[
        F.coalesce(F.sum(f"_tot_{v}").over(w_off), F.lit(0)).alias(f"_off_{v}")
        for v in value_cols])

    w_loc = (Window.partitionBy(*keys, "_bucket").orderBy(ox)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = tagged.select("*", *[F.sum(v).over(w_loc).alias(f"_loc_{v}") for v in value_cols])
    out = local.join(F.broadcast(offsets), [*keys, "_bucket"], "inner")
    return out.select(
        *out_cols,
        *[(F.col(f"_loc_{v}") + F.col(f"_off_{v}")).alias(f"{prefix}{v}") for v in value_cols])


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, value) rows for the non-null values of the given numeric columns."""
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), number(c).alias("value")) for c in columns])
    return (df.select(F.inline(pairs)).where(F.col("value").isNotNull()))


#: Half the share of ranks that the bracket around a median takes in, and the accuracy of the
#: sketch that finds it (its rank error is a tenth of that share).
BRACKET, SKETCH_ACCURACY = 0.001, 10_000


def exact_medians(df: DataFrame, columns: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Exact median per column (mean of the two middle values for an even count, nulls and NaN
    ignored): rows (name, median, n). Columns with no values are absent.

    One pass counts the values and brackets each median with a quantile sketch; a second counts
    the values below the bracket; a third makes a histogram of the values inside it (a few per
    mille of the rows, more only where values repeat, and those are combined before the
    shuffle). The running count inside the bracket, started at the count below, gives the ranks.
    A sketch that missed (its error is not bounded for every input) is noticed by the ranks and
    its column is counted in full."""
    spark = df.sparkSession
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    ends = [0.5 - BRACKET, 0.5 + BRACKET]
    stats = df.agg(*[F.struct(F.count(v).alias("n"), F.percentile_approx(v, ends, SKETCH_ACCURACY).alias("q")).alias(f"_{i}")
                     for i, v in enumerate(value.values())]).first()
    found = {c: stats[i] for i, c in enumerate(columns) if stats[i]["n"]}
    empty = spark.createDataFrame([], "name string, median double, n long")
    if not found:
        return empty
    under = df.agg(*[F.count_if(value[c] < s["q"][0]).alias(f"_{i}") for i, (c, s) in enumerate(found.items())],
                   *[F.count_if(value[c] <= s["q"][1]).alias(f"t{i}") for i, (c, s) in enumerate(found.items())]).first()
    whole, bounds = {}, []
    for i, (c, s) in enumerate(found.items()):
        below, upto, n = under[f"_{i}"], under[f"t{i}"], s["n"]
        lo, hi = s["q"]
        if not (below < (n + 1) // 2 and upto >= n // 2 + 1):
            below, lo, hi = 0, None, None
        whole[c] = (lo, hi)
        bounds.append((c, below, n))
    inside = F.array_compact(F.array(*[
        F.when(value[c].isNotNull() if lo is None else value[c].between(lo, hi),
               F.struct(F.lit(c).alias("name"), value[c].alias("value"))) for c, (lo, hi) in whole.items()]))
    hist = df.select(F.inline(inside)).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    cum = running_totals(hist, ["name"], "value", ["n"], buckets=buckets)
    offsets = spark.createDataFrame(bounds, "name string, below long, n_total long")
    ranked = cum.join(F.broadcast(offsets), "name").withColumn("end", F.col("below") + F.col("cum_n"))
    covers = lambda r: (F.col("end") - F.col("n") < r) & (r <= F.col("end"))
    lo_rank, hi_rank = F.floor((F.col("n_total") + 1) / 2), F.floor(F.col("n_total") / 2) + 1
    picked = ranked.where(covers(lo_rank) | covers(hi_rank)).groupBy("name").agg(
        F.max(F.when(covers(lo_rank), F.col("value"))).alias("lo"),
        F.max(F.when(covers(hi_rank), F.col("value"))).alias("hi"), F.first("n_total").alias("n"))
    return picked.select("name", ((F.col("lo") + F.col("hi")) / 2).alias("median"), "n")


def approx_medians(df: DataFrame, columns: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """Sketch-based median per column (rank error about n/accuracy)."""
    return (long_values(df, columns).groupBy("name")
            .agg(F.percentile_approx("value", 0.5, accuracy).alias("median"),
                 F.count(F.lit(1)).alias("n")))
