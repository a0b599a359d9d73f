"""Integrity audits (D1-D4): the declared keys, references, CHECKs and NOT NULLs.

Parquet enforces none of them, so each rule becomes a counting job that
reports ``(rule, table_name, violations)``.  NULL and CHECK counts are
conditional counts in one aggregate per frame, unpivoted with ``stack``; key
uniqueness is a grouped count; references are left-anti joins of distinct keys.

Rules name columns that a source may lack (``sale_id`` or ``hire_date`` of the
order tables): a rule is applied where its columns exist, and ``not_applicable``
lists the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotalake.sources.star import Star

# The declared rules, as (table, columns) / (table, column, SQL condition).
UNIQUE_KEYS = (
    ("customers", ("customer_id",)),
    ("products", ("product_id",)),
    ("products", ("product_name",)),
    ("salespeople", ("salesperson_id",)),
    ("sales", ("sale_id",)),
    ("pipeline", ("opportunity_id",)),
    ("calendar", ("date",)),
    ("targets", ("salesperson_id", "year", "month")),
    ("targets", ("target_id",)),
    ("customer_master", ("customer_master_id",)),
    ("customer_master", ("company_name",)),
)

CHECKS = (
    ("products", "standard_cost", "standard_cost >= 0"),
    ("products", "list_price", "list_price >= 0"),
    ("salespeople", "annual_target", "annual_target >= 0"),
    ("pipeline", "probability", "probability BETWEEN 0 AND 100"),
    ("pipeline", "expected_revenue", "expected_revenue >= 0"),
    ("targets", "month", "month BETWEEN 1 AND 12"),
    ("targets", "monthly_target", "monthly_target >= 0"),
    ("calendar", "quarter", "quarter BETWEEN 1 AND 4"),
    ("calendar", "month", "month BETWEEN 1 AND 12"),
    ("calendar", "week", "week BETWEEN 1 AND 53"),
    ("calendar", "day", "day BETWEEN 1 AND 31"),
)

# Per source frame (see ``Star.audit_frames``): the columns that must not be NULL.
# Keys and dates are counted in the tables they come from, before any join could
# drop the rows; only derived columns are counted in the built table.
NOT_NULL = (
    ("customers", "customers_lookup", ("customer_id", "company_name", "industry", "state", "city", "customer_size",
                                       "created_date")),
    ("products", "products", ("product_id", "product_name", "category", "standard_cost", "list_price")),
    ("salespeople", "salespeople_lookup", ("salesperson_id", "first_name", "last_name", "state", "region", "manager",
                                           "hire_date")),
    ("salespeople", "salespeople", ("annual_target",)),
    ("sales", "sales_source", ("sale_id", "product_id", "salesperson_id", "quantity")),
    ("sales", "sales_order_source", ("customer_id", "sale_date")),
    ("sales", "sales", ("unit_price", "revenue", "cost", "profit")),
    ("pipeline", "opportunities", ("opportunity_id", "customer_id", "stage", "probability", "expected_close_date",
                                   "expected_revenue")),
    ("pipeline", "pipeline", ("salesperson_id", "product_id")),
    ("targets", "target_keys", ("target_id", "salesperson_id", "year", "month")),
    ("targets", "targets", ("monthly_target",)),
    ("calendar", "calendar", ("date", "year", "quarter", "month", "month_name", "week", "day", "financial_year")),
    ("customer_master", "customer_master", ("customer_master_id", "company_name", "industry")),
)

# The declared references: (rule, child frame, child column, parent frame, parent column).
FOREIGN_KEYS = (
    ("sales.customer_id", "sales_order_source", "customer_id", "customers_source", "customer_id"),
    ("sales.salesperson_id", "sales_source", "salesperson_id", "salespeople_source", "salesperson_id"),
    ("sales.product_id", "sales_source", "product_id", "products", "product_id"),
    ("pipeline.customer_id", "opportunities", "customer_id", "customers_source", "customer_id"),
    ("pipeline.salesperson_id", "pipeline", "salesperson_id", "salespeople_source", "salesperson_id"),
    ("pipeline.product_id", "pipeline", "product_id", "products", "product_id"),
    ("targets.salesperson_id", "target_keys", "salesperson_id", "salespeople_source", "salesperson_id"),
)


def _star_table(star: Star, name: str) -> DataFrame | None:
    frames = star.audit_frames
    return frames[name] if name in frames else getattr(star, name, None)


def _lacks(star: Star, frame: str, columns: tuple[str, ...]) -> list[str]:
    """The columns that a frame (all of them, if there is no such frame) does not have."""
    df = _star_table(star, frame)
    return [c for c in columns if df is None or c not in df.columns]


def not_applicable(star: Star) -> list[str]:
    """The unique and NOT NULL rules whose columns this star does not have."""
    return ([f"unique:{t}({','.join(c)})" for t, c in UNIQUE_KEYS if _lacks(star, _KEY_FRAMES.get(t, t), c)]
            + [f"not_null:{t}.{c}" for t, frame, cols in NOT_NULL for c in _lacks(star, frame, cols)])


def _result(rule: str, table: str, violations: Column) -> list[Column]:
    return [F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
            violations.cast("long").alias("violations")]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# A unique key of the pipeline or of sales needs none of their joins.
_KEY_FRAMES = {"pipeline": "opportunities", "customers": "customers_source", "salespeople": "salespeople_source",
               "targets": "target_keys"}


def audit_unique(star: Star) -> DataFrame:
    """Number of key values that occur more than once."""
    frames = []
    for table, cols in UNIQUE_KEYS:
        if _lacks(star, _KEY_FRAMES.get(table, table), cols):
            continue
        dupes = (_star_table(star, _KEY_FRAMES.get(table, table)).groupBy(*cols).count()
                 .agg(F.count(F.when(F.col("count") > 1, F.lit(1))).alias("v")))
        frames.append(dupes.select(*_result(f"unique:{table}({','.join(cols)})", table, F.col("v"))))
    return _union(frames)


def audit_fk(star: Star) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row.

    Child keys are counted first (a hot key becomes one row), the distinct keys
    anti-joined, and the counts of the orphans summed.  A source table is read
    one key column at a time; the pipeline, which takes joins to build, is
    built once for all of its references.
    """
    links = [*FOREIGN_KEYS, *star.more_foreign_keys]
    frames = [_orphans(star, [link]) for link in links if link[1] != "pipeline"]
    return _union([*frames, _orphans(star, [link for link in links if link[1] == "pipeline"])])


def _orphans(star: Star, links: list[tuple[str, ...]]) -> DataFrame:
    """One row per reference of one child frame."""
    child = _star_table(star, links[0][1])
    pairs = [F.struct(F.lit(i).alias("rule"), F.col(link[2]).cast("long").alias("k")) for i, link in enumerate(links)]
    pair = F.explode(F.array(*pairs)) if len(pairs) > 1 else pairs[0]
    keys = (child.select(pair.alias("x")).select("x.rule", "x.k").where("k IS NOT NULL")
            .groupBy("rule", "k").agg(F.count(F.lit(1)).alias("n")))
    parents = _union([_star_table(star, parent).select(F.lit(i).alias("rule"), F.col(col).cast("long").alias("k"))
                      for i, (_, _, _, parent, col) in enumerate(links)])
    sums = keys.join(parents, ["rule", "k"], "left_anti").agg(
        *[F.coalesce(F.sum(F.when(F.col("rule") == i, F.col("n"))), F.lit(0)).alias(f"_r{i}") for i in range(len(links))])
    stack = ", ".join(f"'fk:{rule}', '{rule.split('.')[0]}', `_r{i}`" for i, (rule, *_) in enumerate(links))
    return (sums.selectExpr(f"stack({len(links)}, {stack}) AS (rule, table_name, violations)")
            .select("rule", "table_name", F.col("violations").cast("long").alias("violations")))


def per_frame(star: Star, rules: dict[tuple[str, str], list[tuple[str, Column]]]) -> DataFrame:
    """One aggregate per (table, frame), unpivoted to one row per rule."""
    frames = []
    for (table, frame), items in rules.items():
        df = _star_table(star, frame)
        agg = df.agg(*[F.count(F.when(cond, F.lit(1))).alias(f"_r{i}") for i, (_, cond) in enumerate(items)])
        stack = ", ".join(f"'{name}', `_r{i}`" for i, (name, _) in enumerate(items))
        frames.append(agg.selectExpr(f"stack({len(items)}, {stack}) AS (rule, violations)")
                      .select(F.col("rule"), F.lit(table).alias("table_name"),
                              F.col("violations").cast("long")))
    return _union(frames)


def check_rules() -> dict[tuple[str, str], list[tuple[str, Column]]]:
    """(table, frame) -> (rule, condition of a violation) of D3."""
    rules: dict[tuple[str, str], list[tuple[str, Column]]] = {}
    for table, col, cond in CHECKS:
        frame = "opportunities" if table == "pipeline" else table
        rules.setdefault((table, frame), []).append((f"check:{table}.{col}", ~F.expr(cond)))
    return rules


def not_null_rules(star: Star) -> dict[tuple[str, str], list[tuple[str, Column]]]:
    """(table, frame) -> (rule, condition of a violation) of D4, for the columns that are there."""
    rules = {}
    for table, frame, cols in NOT_NULL:
        lacking = _lacks(star, frame, cols)
        found = [(f"not_null:{table}.{c}", F.col(c).isNull()) for c in cols if c not in lacking]
        if found:
            rules[table, frame] = found
    return rules


def audit_check(star: Star) -> DataFrame:
    """D3: rows where a CHECK condition is false (NULL passes, as in SQL)."""
    return per_frame(star, check_rules())


def audit_not_null(star: Star) -> DataFrame:
    """NULLs in NOT NULL columns, one row per column."""
    return per_frame(star, not_null_rules(star))


# --- D1 without a shuffle of keys ---------------------------------------------

#: Fewer keys than this in the bitmap of a task and range, and the bitmaps take more bytes than the keys.
DENSE = 512

#: The keys of one integral column, by table.
INTEGRAL_KEYS = tuple((table, cols[0]) for table, cols in UNIQUE_KEYS if len(cols) == 1 and cols[0].endswith("_id"))


def duplicate_keys(df: DataFrame, key: str, dense: int = DENSE) -> int:
    """How many non-NULL values of an integral key occur more than once, exactly.

    The keys of a range of 32,768 values are one bitmap; tasks send bitmaps and
    row counts of the ranges they hold, no keys.  A range with as many bits as
    rows is clean; only the rows of other ranges are grouped by key.  This pays
    where the rows of a task lie in few ranges: one narrow pass counts rows and
    (task, range) pairs, and where a pair has fewer than ``dense`` rows the keys
    are grouped right away.
    """
    k = F.col(key).cast("long")
    keys = df.where(F.col(key).isNotNull()).select(
        k.alias("k"), F.bitmap_bucket_number(k).alias("range"), F.bitmap_bit_position(k).alias("bit"))
    spread = (keys.withColumn("task", F.spark_partition_id())
              .agg(F.count("*").alias("n"), F.approx_count_distinct(F.struct("task", "range")).alias("pairs")).first())
    if spread.n >= dense * spread.pairs:
        ranges = keys.groupBy("range").agg(F.bitmap_count(F.bitmap_construct_agg("bit")).alias("bits"), F.count("*").alias("n"))
        keys = keys.join(ranges.where("n > bits").select("range"), "range", "left_semi")
    return keys.groupBy("k").count().where("count > 1").count()


def audit_unique_integral(star: Star) -> DataFrame:
    """D1 for the keys of one integral column, by ``duplicate_keys``."""
    rows = []
    for table, col in INTEGRAL_KEYS:
        frame = _KEY_FRAMES.get(table, table)
        if not _lacks(star, frame, (col,)):
            rows.append((f"unique:{table}({col})", table, duplicate_keys(_star_table(star, frame), col)))
    return star.spark.createDataFrame(rows, "rule string, table_name string, violations long")
