"""Distributed k-th pick (B8) and territory assignment with a fallback.

A SQL generator would number a dimension with ``ROW_NUMBER() OVER
(PARTITION BY grp)`` and join each fact row to the row whose number equals
``1 + floor(random() * count)``.  In Spark that window puts a whole group into
one task, and without ``PARTITION BY`` the whole table, so the numbering is
built from bounded pieces instead.  The order is free as long as it is fixed;
ours is by a hash of the key (then the key), which makes equal slices of the
hash range hold about equally many rows however the keys are spread:

1. a row's bucket is the top bits of its key's hash;
2. count rows per (group, bucket): at most groups x ``buckets`` rows;
3. running sums over that small table give each bucket's offset;
4. ``row_number`` within (group, bucket) plus the offset is the position.

The pick itself is an equi-join on (group, position); Catalyst broadcasts the
dimension side when its size allows and AQE splits skewed fact partitions when
one group is hot.  There is one path for every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotalake.functions.draws import DRAW_BITS, POSITION, key_draw, kth_of

POS = "pos"
GROUP_SIZE = "group_size"
BUCKETS = 4096


def attach_positions(dim: DataFrame, key: str, groups: Sequence[str] = (),
                     buckets: int = BUCKETS) -> DataFrame:
    """Add ``pos`` (1-based rank by key hash, then key, within ``groups``) and ``group_size``.

    Keys must be unique within a group (audited by ``audit_unique``).
    """
    groups = list(groups)
    with_bucket = (dim.withColumn("_hash", key_draw(F.col(key), POSITION))
                   .withColumn("_bucket", F.expr(f"_hash div {-(-(1 << DRAW_BITS) // buckets)}L")))
    counts = with_bucket.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    by_group = Window.partitionBy(*groups)
    running = by_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *groups, "_bucket",
        F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"),
        F.sum("_n").over(by_group).alias(GROUP_SIZE),
    )
    local = F.row_number().over(Window.partitionBy(*groups, "_bucket").orderBy("_hash", F.col(key)))
    return (with_bucket.withColumn("_local", local)
            .join(offsets, [*groups, "_bucket"], "inner")
            .withColumn(POS, (F.col("_before") + F.col("_local")).cast("long"))
            .drop("_bucket", "_hash", "_local", "_before"))


def kth_pick(facts: DataFrame, draw_col: str, size: Column, dim: DataFrame, dim_key: str,
             out_col: str, groups: Sequence[tuple[str, str]] = (), buckets: int = BUCKETS) -> DataFrame:
    """Pick the ``1 + draw mod size``-th dimension row per fact row.

    ``groups`` pairs a fact column with a dimension column; the pick is made
    among dimension rows of the same group (B10 when the group is a category).
    ``size`` is the group's row count as a fact-side expression (a column that
    came with an earlier join, or a literal), so the facts are shuffled for the
    pick alone.  Fact rows whose size is 0 or NULL get NULL.
    """
    dim_cols = [d for _, d in groups]
    ranked = attach_positions(dim.select(*dim_cols, dim_key), dim_key, dim_cols, buckets)
    with_k = facts.withColumn("_k", kth_of(F.col(draw_col), size))
    picks = ranked.select(*[F.col(d).alias(f"_g{i}") for i, d in enumerate(dim_cols)],
                          F.col(POS).alias("_pos"), F.col(dim_key).alias(out_col))
    cond = [with_k[f] == picks[f"_g{i}"] for i, (f, _) in enumerate(groups)]
    cond.append(with_k["_k"] == picks["_pos"])
    return (with_k.join(picks, cond, "left")
            .drop("_k", "_pos", *[f"_g{i}" for i in range(len(dim_cols))]))


def group_sizes(dim: DataFrame, group: str, size_col: str) -> DataFrame:
    """One row per group with its row count."""
    return dim.groupBy(group).agg(F.count(F.lit(1)).alias(size_col))


def assign_territory(facts: DataFrame, fact_state: str, draw_col: str,
                     reps: DataFrame, rep_key: str, rep_state: str,
                     state_reps: Column, all_reps: Column,
                     out_col: str = "salesperson_id", buckets: int = BUCKETS) -> DataFrame:
    """K-th rep of the fact's state; if the state has no rep, k-th rep overall.

    Equivalent to a LEFT lateral pick in the state plus a COALESCE with a pick
    over all reps.  ``state_reps`` and ``all_reps`` are the two pool sizes as
    fact-side expressions (0 or NULL: no rep in the state).  Each fact row is
    routed to exactly one of the two rankings and joined once, on an equi-key
    (fallback flag, state, position), so no nested-loop join appears.
    """
    pool = reps.select(F.col(rep_key).alias("_rep"), F.col(rep_state).alias("_state"))
    by_state = attach_positions(pool.where("_state IS NOT NULL"), "_rep", ["_state"], buckets)
    overall = attach_positions(pool.select("_rep"), "_rep", [], buckets)
    fallback = F.col(fact_state).isNull() | (F.coalesce(state_reps, F.lit(0)) == 0)
    routed = (facts.withColumn("_fallback", fallback)
              .withColumn("_jstate", F.when(F.col("_fallback"), F.lit("")).otherwise(F.col(fact_state)))
              .withColumn("_k", kth_of(F.col(draw_col), F.when(F.col("_fallback"), all_reps).otherwise(state_reps))))
    targets = (by_state.select(F.lit(False).alias("_t_fallback"), F.col("_state").alias("_t_state"),
                               F.col(POS).alias("_t_pos"), F.col("_rep").alias(out_col))
               .unionByName(overall.select(F.lit(True).alias("_t_fallback"), F.lit("").alias("_t_state"),
                                           F.col(POS).alias("_t_pos"), F.col("_rep").alias(out_col))))
    cond = [routed["_fallback"] == targets["_t_fallback"],
            routed["_jstate"] == targets["_t_state"],
            routed["_k"] == targets["_t_pos"]]
    return (routed.join(targets, cond, "left")
            .drop("_fallback", "_jstate", "_k", "_t_fallback", "_t_state", "_t_pos"))
