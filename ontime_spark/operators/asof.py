"""As-of / nearest-in-time join (J6) as an ordered scan, without candidate pairs.

Right rows are first reduced to one per ``(by, time)`` (the smallest id, map-side combined).
Left and right rows are then unioned and sorted by ``(by, time)``; in one pass every left row
takes the last right row at or before it (backward) and the first one at or after it
(forward); 'nearest' picks the closer of the two. Every row is shuffled a fixed number of
times, so a key with many rows in one hour costs linear, not quadratic, work.

The scan is distributed like the running totals of ``cumulative.py``: Spark's range
partitioner (sampled bounds) cuts the sorted union into buckets of bounded size, so a hot key
is split by time over several tasks; the bucket id is written with the rows once; each bucket
carries its last right row forward and its next right row backward locally, and the
neighbouring buckets of the same key (a table with one row per (key, bucket)) fill left rows
that saw none in their own bucket. Ties at equal distance go to the earlier observation, then the smaller right id.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime_spark.session import materialize

# Rows per range bucket of the scan (the bucket count grows with the data).
ROWS_PER_BUCKET = 1_000_000


def epoch_micros(c: str | F.Column) -> F.Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(col.cast("timestamp"))


def _scan(u: DataFrame, by: Sequence[str], n_buckets: int) -> DataFrame:
    """One ordered pass over the union ``u`` (rights unique per (by, time)). For every left row
    (``_side`` = 1): ``bk``, the last right row at or before it, and ``fw``, the first right
    row at or after it, within ``by``; columns (_lid, _lt, bk, fw)."""
    order = [F.col("_t").asc(), F.col("_side").asc()]  # at equal time the right row first
    # The left id ends the range key: rows of one key and time are split over buckets, too.
    ranged = u.repartitionByRange(n_buckets, *[F.col(b).asc() for b in by], *order, F.col("_lid").asc())
    tagged = materialize(ranged.withColumn("_bucket", F.spark_partition_id()), "asof-buckets")
    right_row = F.when(F.col("_side") == 0, F.struct("_rt", "_rid", "_rv"))
    # Both candidates are running frames (unbounded preceding .. current row), evaluated in
    # one streaming pass each; a frame reaching to unbounded following would be re-aggregated
    # for every row (quadratic in the bucket). Forward runs over the descending order, where
    # at equal time the left row comes first (a right row at the same time is backward's).
    w = Window.partitionBy(*by, "_bucket").orderBy(*order)
    w_desc = Window.partitionBy(*by, "_bucket").orderBy(F.col("_t").desc(), F.col("_side").desc())
    running = (Window.unboundedPreceding, Window.currentRow)
    local = tagged.select(
        *by, "_bucket", "_side", "_lid", "_lt",
        F.last(right_row, ignorenulls=True).over(w.rowsBetween(*running)).alias("_bk"),
        F.last(right_row, ignorenulls=True).over(w_desc.rowsBetween(*running)).alias("_fw"),
        F.row_number().over(w).alias("_rn"))
    # Last / first right row of each (key, bucket), carried into the later / earlier buckets.
    ends = local.groupBy(*by, "_bucket").agg(F.max_by("_bk", "_rn").alias("_tail"),
                                             F.min_by("_fw", "_rn").alias("_head"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    after = (Window.partitionBy(*by).orderBy(F.col("_bucket").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    carry = ends.select(
        *by, "_bucket",
        F.last("_tail", ignorenulls=True).over(before).alias("_cbk"),
        F.last("_head", ignorenulls=True).over(after).alias("_cfw"))
    lefts = local.where(F.col("_side") == 1).join(carry, [*by, "_bucket"], "left")
    bk = F.coalesce("_bk", "_cbk")
    # A right row at exactly the left time sorts before it: it is the backward candidate.
    fw = F.when(bk.isNotNull() & (bk["_rt"] == F.col("_lt")), bk).otherwise(
        F.coalesce("_fw", "_cfw"))
    return lefts.select("_lid", "_lt", bk.alias("bk"), fw.alias("fw"))


def asof_matches(left: DataFrame, right: DataFrame, by: str | Sequence[str], left_time: str,
                 right_time: str, left_id: str, right_id: str, tolerance_seconds: int,
                 direction: str = "nearest", right_cols: Sequence[str] | None = None,
                 rows_per_bucket: int | None = None) -> DataFrame:
    """The matches of ``asof_join`` alone: left_id, ``_rv`` (struct of the right columns) and ``_dt``
    (microseconds, right minus left) of the left rows that have one."""
    if direction not in ("nearest", "backward", "forward"):
        raise ValueError(f"direction must be nearest, backward or forward, not {direction!r}")
    by = [by] if isinstance(by, str) else list(by)
    tol = int(tolerance_seconds) * 1_000_000
    right_cols = list(right_cols) if right_cols is not None else [
        c for c in right.columns if c not in by]

    lt, rt = epoch_micros(left_time), epoch_micros(right_time)
    rv_type = right.select(F.struct(*right_cols)).schema[0].dataType
    rid_type = right.schema[right_id].dataType
    lid_type = left.schema[left_id].dataType
    keys_ok = F.lit(True)
    for b in by:
        keys_ok = keys_ok & F.col(b).isNotNull()
    lefts = left.select(*by, F.col(left_id).alias("_lid"), lt.alias("_lt")).where(
        keys_ok & F.col("_lt").isNotNull()).select(
        *by, F.lit(1).alias("_side"), "_lid", "_lt", F.col("_lt").alias("_t"),
        F.lit(None).cast(rid_type).alias("_rid"), F.lit(None).cast("long").alias("_rt"),
        F.lit(None).cast(rv_type).alias("_rv"))
    # One right row per (key, time): the smallest id (the tie rule), map-side combined.
    rights = (right.select(*by, F.col(right_id).alias("_rid"), rt.alias("_rt"),
                           F.struct(*right_cols).alias("_rv"))
                   .where(keys_ok & F.col("_rt").isNotNull())
                   .groupBy(*by, "_rt").agg(F.min_by(F.struct("_rid", "_rv"), "_rid").alias("_r"))
                   .select(*by, F.lit(0).alias("_side"), F.lit(None).cast(lid_type).alias("_lid"),
                           F.lit(None).cast("long").alias("_lt"), F.col("_rt").alias("_t"),
                           F.col("_r._rid").alias("_rid"), "_rt", F.col("_r._rv").alias("_rv")))
    u = materialize(lefts.unionByName(rights), "asof-union")
    per = ROWS_PER_BUCKET if rows_per_bucket is None else rows_per_bucket
    n_buckets = max(2, math.ceil(u.count() / max(per, 1)))

    both = _scan(u, by, n_buckets)

    def within(c: str, backward: bool) -> F.Column:
        d = F.col("_lt") - F.col(f"{c}._rt") if backward else F.col(f"{c}._rt") - F.col("_lt")
        return F.when(F.col(c).isNotNull() & (d <= tol), F.col(c))

    bk, fw = within("bk", True), within("fw", False)
    if direction == "nearest":
        # Equal distance: the earlier observation (the backward one) wins.
        pick_fw = bk.isNull() | (fw.isNotNull() & (
            (F.col("fw._rt") - F.col("_lt")) < (F.col("_lt") - F.col("bk._rt"))))
        chosen = F.when(pick_fw, fw).otherwise(bk)
    else:
        chosen = bk if direction == "backward" else fw
    best = both.select("_lid", "_lt", chosen.alias("_best"))
    best = best.where(F.col("_best").isNotNull()).select(
        F.col("_lid").alias(left_id), F.col("_best._rv").alias("_rv"),
        (F.col("_best._rt") - F.col("_lt")).alias("_dt"))
    return best


def asof_join(left: DataFrame, right: DataFrame, by: str | Sequence[str], left_time: str,
              right_time: str, left_id: str, right_id: str, tolerance_seconds: int,
              direction: str = "nearest", right_cols: Sequence[str] | None = None,
              prefix: str = "", rows_per_bucket: int | None = None) -> DataFrame:
    """Attach to each left row the right row of the same ``by`` key closest in time.

    direction: 'nearest' (|dt| <= tol), 'backward' (right time <= left time, within tol) or
    'forward' (right time >= left time, within tol). Adds ``{prefix}<col>`` for each right
    column plus ``{prefix}dt_seconds`` (right minus left). ``left_id`` must be unique.
    ``rows_per_bucket`` overrides the scan's bucket size (tests)."""
    keys = [by] if isinstance(by, str) else list(by)
    right_cols = list(right_cols) if right_cols is not None else [c for c in right.columns if c not in keys]
    best = asof_matches(left, right, by, left_time, right_time, left_id, right_id, tolerance_seconds, direction, right_cols, rows_per_bucket)
    out = left.join(best, left_id, "left")
    return out.select(
        *left.columns,
        *[F.col(f"_rv.{c}").alias(f"{prefix}{c}") for c in right_cols],
        (F.col("_dt") / 1_000_000).alias(f"{prefix}dt_seconds"))
