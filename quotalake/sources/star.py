"""The sales star (customers, products, salespeople, sales, pipeline, calendar,
targets) defined over the driver's order/line-item tables.

Role mapping (fixed, see README):

* customers   = customer join nation: id c_custkey, company c_name, industry
  c_mktsegment, state = nation name, size from a key draw (B6).
* salespeople = supplier join nation join region: id s_suppkey, first/last name =
  s_name split at '#', state = nation, region = region name, opening annual
  target = max(s_acctbal, 0).
* products    = part: id p_partkey, name p_name, category p_type, list_price =
  p_retailprice as DECIMAL(10,2), standard_cost = list_price * (56 + 4*(p_size % 6)) %.
* sales       = lineitem join orders join products: rep l_suppkey, customer
  o_custkey, sale_date = date(o_orderdate), quantity l_quantity, discount %
  = l_discount * 100 to hundredths of a percent, priced by B5.
* pipeline    = orders: id o_orderkey, stage/probability from a key draw (B7),
  expected revenue o_totalprice, close date = date(o_orderdate), product by a
  weighted category (B6) and a pick within it (B10), rep by the territory rule
  (B9) over all reps.  An order without a known customer stays, with the
  fallback rep.
* calendar    = every day from 1 January of the year before the first order to
  31 December of the last order's year (B1); the leading year has no sales.
* targets     = B3 rescale (sales / years spanned by the orders, 90 %) then B2.

The calendar span, the years behind the target rescale and the first year of
the miss-rate report are derived from the orders (one min/max aggregate), the
same rule the reference applies to its own data; ``StarConfig`` can pin any of
them.

Every frame is lazy; reports select what they need and Catalyst prunes the
Parquet reads down to those columns.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotalake.functions import draws
from quotalake.functions.draws import key_draw, weighted_choice
from quotalake.functions.exact import (
    money_cents,
    money_from_cents,
    round_half_up_double,
    sum_cents,
    to_money,
)
from quotalake.functions.text import full_name
from quotalake.operators import build
from quotalake.operators.ranking import assign_territory, group_sizes, kth_pick
from quotalake.sources.tables import ParquetTables, SpreadTables


SALES_CENTS = ("unit_price_cents", "revenue_cents", "cost_cents", "profit_cents")


def with_money_columns(df: DataFrame) -> DataFrame:
    """Add the DECIMAL money columns of the sales fact next to their cents."""
    return df.select(
        *df.columns,
        money_from_cents(F.col("unit_price_cents"), 12).alias("unit_price"),
        money_from_cents(F.col("revenue_cents"), 14).alias("revenue"),
        money_from_cents(F.col("cost_cents"), 14).alias("cost"),
        money_from_cents(F.col("profit_cents"), 14).alias("profit"),
    )


def totals_by(sales: DataFrame, *keys: str) -> DataFrame:
    """Revenue and profit cents and sale count per key.

    The first-level aggregate every report starts from; map-side partial
    aggregation collapses a hot key before the shuffle.
    """
    return sales.groupBy(*keys).agg(sum_cents(F.col("revenue_cents")).alias("rev_c"),
                                    sum_cents(F.col("profit_cents")).alias("prof_c"),
                                    F.count(F.lit(1)).alias("sales_count"))


def rep_months_of(sales: DataFrame) -> DataFrame:
    """Totals per rep and calendar month of the sale date.

    The month keys are made non-nullable (a sale without a date lands in
    month 0, which matches no target month but still counts in the rep's
    total).  Otherwise the join that consumes this aggregate gets inferred
    IS NOT NULL filters the rep-total branch lacks, the two subtrees stop
    being identical, and Spark aggregates the fact twice instead of reusing
    one exchange.
    """
    dated = sales.select("salesperson_id",
                         F.coalesce(F.year("sale_date"), F.lit(0)).alias("year"),
                         F.coalesce(F.month("sale_date"), F.lit(0)).alias("month"),
                         "revenue_cents", "profit_cents")
    return totals_by(dated, "salesperson_id", "year", "month")


def rolled_up(totals: DataFrame, *keys: str) -> DataFrame:
    """Coarser totals from finer ones."""
    return (totals.groupBy(*keys)
            .agg(F.sum("rev_c").alias("rev_c"), F.sum("prof_c").alias("prof_c"),
                 F.sum("sales_count").alias("sales_count")))


# The totals ``materialize`` writes; per-rep totals roll up from the rep-months.
MATERIALIZED_TOTALS = ("customer_id", "product_id", "sale_date")


#: So many orders, three narrow columns each, are sent to every task instead of shuffling the line items.
FEW_ORDERS = 1 << 21


@dataclass(frozen=True)
class StarConfig:
    # None: derived from the order dates (see ``Star.order_years``).
    calendar_start: dt.date | None = None
    calendar_end: dt.date | None = None
    target_years: int | None = None
    miss_from_year: int | None = None
    lead_years: int = 1
    target_share_pct: int = 90
    tier_high: int = 8000
    tier_medium: int = 5000
    top_customers: int = 20
    rank_buckets: int = 4096
    # Category split of opportunities (B6) before the product pick within the
    # category (B10), per mille.  Fixed values: the driver's part types and the
    # reference's 32/25/18/15/10 split, the last share halved over two types.
    product_categories: tuple[str, ...] = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    category_weights: tuple[int, ...] = (320, 250, 180, 150, 50, 50)
    # SQL condition on ``n_nationkey``: only reps of these nations take part in B9 (None: all reps).
    territory_nations: str | None = None


class Star:
    """Lazy star-schema frames over a table source.

    Each frame is built once per ``Star`` and memoized: the object holds
    logical plans, not data.  Sharing one plan object between the reports that
    use it keeps PySpark from re-analysing the same subtree on every access
    and lets Spark recognise (and reuse) identical exchanges.
    """

    def __init__(self, spark: SparkSession, source, config: StarConfig | None = None):
        self.spark = spark
        self.source = source
        self.config = config or StarConfig()

    @classmethod
    def from_parquet(cls, spark: SparkSession, base_dir: str,
                     config: StarConfig | None = None, spread: int | None = None) -> "Star":
        """Star over ``<base_dir>/<table>.parquet``.

        ``spread``: hash-partition the fact scans into that many partitions (for
        small facts stored as a single row group, which one task would read).
        """
        source = ParquetTables(spark, base_dir)
        return cls(spark, SpreadTables(source, spread) if spread else source, config)

    def t(self, name: str) -> DataFrame:
        return self.source.table(name)

    def raw(self, name: str) -> DataFrame:
        """The table as stored, for scans that aggregate right away."""
        return getattr(self.source, "raw", self.source.table)(name)

    # --- dimensions -----------------------------------------------------

    @cached_property
    def nations(self) -> DataFrame:
        return self.t("nation").select("n_nationkey", F.col("n_name").alias("state"), "n_regionkey")

    @cached_property
    def customers(self) -> DataFrame:
        c = self.t("customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
        return (c.join(self.nations, c["c_nationkey"] == F.col("n_nationkey"), "inner")
                .select(F.col("c_custkey").alias("customer_id"),
                        F.col("c_name").alias("company_name"),
                        F.col("c_mktsegment").alias("industry"),
                        "state",
                        build.customer_size(key_draw("c_custkey", draws.CUSTOMER_SIZE)).alias("customer_size")))

    @cached_property
    def products(self) -> DataFrame:
        """Products with DECIMAL prices and their BIGINT cents (computed once per product)."""
        list_price = F.col("p_retailprice").cast("decimal(10,2)")
        markup = (F.lit(56) + F.lit(4) * F.pmod(F.col("p_size"), F.lit(6))).cast("decimal(4,0)")
        cost = F.round(list_price * markup * F.lit(0.01).cast("decimal(3,2)"), 2).cast("decimal(10,2)")
        return (self.t("part")
                .select(F.col("p_partkey").alias("product_id"),
                        F.col("p_name").alias("product_name"),
                        F.col("p_type").alias("category"),
                        cost.alias("standard_cost"),
                        list_price.alias("list_price"))
                .withColumn("list_cents", money_cents(F.col("list_price")))
                .withColumn("cost_cents", money_cents(F.col("standard_cost"))))

    @cached_property
    def salespeople_opening(self) -> DataFrame:
        """Reps with their opening annual target (before the B3 rescale)."""
        s = self.t("supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
        r = self.t("region").select("r_regionkey", F.col("r_name").alias("region"))
        n = self.nations.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
        return (s.join(n, s["s_nationkey"] == n["n_nationkey"], "inner")
                .select(F.col("s_suppkey").alias("salesperson_id"),
                        F.split_part(F.col("s_name"), F.lit("#"), F.lit(1)).alias("first_name"),
                        F.split_part(F.col("s_name"), F.lit("#"), F.lit(2)).alias("last_name"),
                        "state", "region",
                        to_money(F.greatest(F.col("s_acctbal"), F.lit(0.0))).alias("annual_target")))

    @cached_property
    def rep_months(self) -> DataFrame:
        """Totals (exact cents) per rep and month of the sale date."""
        return rep_months_of(self.sales)

    @property
    def monthly_actuals(self) -> DataFrame:
        """Revenue cents per rep and month of the sale date."""
        return self.rep_months.select("salesperson_id", "year", "month", F.col("rev_c").alias("actual_cents"))

    def actuals_since(self, from_year: int | None) -> DataFrame:
        """Actuals for a report that starts at ``from_year``; here all, as the rescale needs the same aggregate."""
        return self.monthly_actuals

    def sales_totals(self, key: str) -> DataFrame:
        """Per-customer / product / rep / day totals (``rev_c``, ``prof_c``, ``sales_count``)."""
        cache = self.__dict__.setdefault("_totals", {})
        if key not in cache:
            cache[key] = totals_by(self.sales, key)
        return cache[key]

    def grand_totals(self) -> DataFrame:
        """Totals over all sales: one partial row per task, nothing shuffled by key."""
        return totals_by(self.sales)

    @cached_property
    def rep_revenue(self) -> DataFrame:
        """Total revenue cents per rep, rolled up from the rep-months.

        Deriving it from ``rep_months`` lets a report that needs both (actual
        vs target) reuse one shuffle of the sales fact.
        """
        return (self.monthly_actuals.groupBy("salesperson_id")
                .agg(sum_cents(F.col("actual_cents")).alias("revenue_cents")))

    @cached_property
    def salespeople(self) -> DataFrame:
        """Reps with the rescaled annual target."""
        return build.rescale_targets(self.salespeople_opening,
                                     self.rep_revenue, self.target_years,
                                     self.config.target_share_pct)

    # --- data-derived parameters -------------------------------------------

    @cached_property
    def order_years(self) -> tuple[int, int]:
        """First and last calendar year of the order dates (one aggregate job)."""
        row = self.raw("orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
        if row is None or row["lo"] is None:
            raise ValueError("orders has no dates; set calendar_start/calendar_end/target_years explicitly")
        return row["lo"].year, row["hi"].year

    @cached_property
    def calendar_range(self) -> tuple[dt.date, dt.date]:
        c = self.config
        if c.calendar_start is not None and c.calendar_end is not None:
            return c.calendar_start, c.calendar_end
        lo, hi = self.order_years
        return (c.calendar_start or dt.date(lo - c.lead_years, 1, 1),
                c.calendar_end or dt.date(hi, 12, 31))

    @property
    def target_years(self) -> int:
        if self.config.target_years is not None:
            return self.config.target_years
        lo, hi = self.order_years
        return hi - lo + 1

    @property
    def miss_from_year(self) -> int:
        if self.config.miss_from_year is not None:
            return self.config.miss_from_year
        return self.order_years[0]

    @cached_property
    def calendar(self) -> DataFrame:
        return build.build_calendar(self.spark, *self.calendar_range)

    @property
    def calendar_rows(self) -> int:
        """Known before any job runs once the range is fixed: the broadcast bound."""
        return build.calendar_rows(*self.calendar_range)

    @cached_property
    def targets(self) -> DataFrame:
        return build.build_targets(self.salespeople.select("salesperson_id", "annual_cents"),
                                   *self.calendar_range)

    def target_rows(self, from_year: int | None = None) -> DataFrame:
        """Targets with the rep's name: salesperson_id, full_name, year, month, target_cents, monthly_target.

        Generated from the rep rows (B2), so the name rides along.  ``from_year``
        moves the start of the generated months; a filter on the year instead
        would reach the actuals through the join and keep Spark from reusing
        the aggregate that also feeds the rescale.
        """
        reps = self.salespeople.select("salesperson_id", "annual_cents",
                                       full_name(F.col("first_name"), F.col("last_name")).alias("full_name"))
        start, end = self.calendar_range
        if from_year is not None:
            start = max(start, dt.date(from_year, 1, 1))
        return build.build_targets(reps, start, end, carry=["full_name"])

    # --- facts ------------------------------------------------------------

    @cached_property
    def sales_lines(self) -> DataFrame:
        """Sales priced from line items and products, without the order columns.

        Money is carried as BIGINT cents (``*_cents``); the DECIMAL columns
        are derived from them and only computed when a query selects them.
        """
        return self._priced_lines(self._line_items())

    def _line_items(self) -> DataFrame:
        return self.t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")

    def _priced_lines(self, li: DataFrame, *carry: str) -> DataFrame:
        p = self.products.select("product_id", "list_cents", "cost_cents")
        joined = li.join(p, li["l_partkey"] == p["product_id"], "inner")
        hundredths = round_half_up_double(F.col("l_discount") * F.lit(10000.0)).cast("long")
        lines = joined.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"), F.col("l_suppkey").alias("salesperson_id"), "product_id",
            F.col("l_quantity").cast("int").alias("quantity"),
            hundredths.alias("_disc"), "list_cents", "cost_cents", *carry)
        priced = build.price_sales(F.col("list_cents"), F.col("cost_cents"), F.col("quantity"),
                                   F.col("_disc"))
        return with_money_columns(lines.select(
            "order_id", "line_number", "salesperson_id", "product_id", "quantity",
            money_from_cents(F.col("_disc"), 5).alias("discount_percent"),
            *[v.alias(k) for k, v in priced.items()], *carry))

    @cached_property
    def sales(self) -> DataFrame:
        """The full sales fact: one row per line item with its order's customer and date."""
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.sales_lines
        return with_money_columns(
            lines.join(o, lines["order_id"] == o["o_orderkey"], "inner")
            .select("order_id", "line_number", F.col("o_custkey").alias("customer_id"), "salesperson_id", "product_id",
                    F.to_date(F.col("o_orderdate")).alias("sale_date"),
                    "quantity", "discount_percent", *SALES_CENTS))

    def sales_on(self, condition: Column) -> DataFrame:
        """The sales whose ``sale_date`` meets a condition.

        The line items meet these orders before they are priced, so no others are
        carried on; few orders are broadcast, and the line items stay in place.
        """
        mine = self.__dict__
        if type(self).sales is not Star.sales or ("sales" in mine and "sales_lines" not in mine):  # stored or given
            return self.sales.where(condition)
        o = self.t("orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"),
                                    F.to_date(F.col("o_orderdate")).alias("sale_date")).where(condition)
        if o.count() <= FEW_ORDERS:
            o = F.broadcast(o)
        li = self._line_items()
        lines = self._priced_lines(li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner"), "customer_id", "sale_date")
        return lines.select("order_id", "line_number", "customer_id", "salesperson_id", "product_id", "sale_date", "quantity",
                            "discount_percent", *SALES_CENTS, "unit_price", "revenue", "cost", "profit")

    @cached_property
    def opportunities(self) -> DataFrame:
        """Orders as opportunities: stage, probability, value and date, without any join."""
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
        stage, prob = build.stage_and_probability(key_draw("o_orderkey", draws.STAGE))
        return o.select(F.col("o_orderkey").alias("opportunity_id"),
                        F.col("o_custkey").alias("customer_id"),
                        stage.alias("stage"), prob.alias("probability"),
                        F.to_date("o_orderdate").alias("expected_close_date"),
                        money_cents(to_money(F.col("o_totalprice"))).alias("expected_revenue_cents"),
                        money_from_cents(money_cents(to_money(F.col("o_totalprice"))), 14).alias("expected_revenue"))

    @cached_property
    def territory_reps(self) -> DataFrame:
        """The reps that opportunities are dealt to, with their state."""
        reps = self.salespeople_opening.select("salesperson_id", "state")
        if self.config.territory_nations is None:
            return reps
        return reps.join(self.nations.where(self.config.territory_nations).select("state"), "state", "left_semi")

    @cached_property
    def _customer_territory(self) -> DataFrame:
        """Customer key with its state and the two rep pool sizes (attached to the few states)."""
        sizes = group_sizes(self.territory_reps.where("state IS NOT NULL"), "state", "_state_reps")
        states = self.nations.join(sizes, "state", "left").select("n_nationkey", "state", "_state_reps")
        c = self.t("customer").select("c_custkey", "c_nationkey")
        return (c.join(states, c["c_nationkey"] == states["n_nationkey"], "inner")
                .select(F.col("c_custkey").alias("_cid"), F.col("state").alias("_cstate"), "_state_reps"))

    @cached_property
    def opportunities_with_rep(self) -> DataFrame:
        """Opportunities with their salesperson."""
        cust = self._customer_territory
        opp = self.opportunities.withColumn("_draw", key_draw("opportunity_id", draws.TERRITORY))
        with_state = opp.join(cust, opp["customer_id"] == cust["_cid"], "left").drop("_cid")
        all_reps = self.territory_reps.count()  # one number
        return assign_territory(with_state, "_cstate", "_draw", self.territory_reps, "salesperson_id", "state",
                                F.col("_state_reps"), F.lit(all_reps), "salesperson_id",
                                self.config.rank_buckets).drop("_cstate", "_state_reps", "_draw")

    @cached_property
    def pipeline(self) -> DataFrame:
        """Opportunities with salesperson and product (B6 category, B10 pick within it)."""
        c = self.config
        products = self.products.select("product_id", "category")
        sizes = {r["category"]: r["n"] for r in group_sizes(
            products.where(F.col("category").isin(*c.product_categories)), "category", "n").collect()}
        size = F.lit(None).cast("long")  # at most one branch per configured category
        for name, n in sizes.items():
            size = F.when(F.col("_cat") == F.lit(name), F.lit(n)).otherwise(size)
        with_cat = (self.opportunities_with_rep
                    .withColumn("_cat", weighted_choice(key_draw("opportunity_id", draws.CATEGORY),
                                                        c.category_weights, c.product_categories))
                    .withColumn("_pdraw", key_draw("opportunity_id", draws.PRODUCT)))
        with_product = kth_pick(with_cat, "_pdraw", size, products, "product_id", "product_id",
                                [("_cat", "category")], c.rank_buckets)
        return with_product.select("opportunity_id", "customer_id", "salesperson_id", "product_id", "stage",
                                   "probability", "expected_close_date", "expected_revenue",
                                   "expected_revenue_cents")

    # --- first-level aggregates of the pipeline --------------------------------

    def stage_values(self) -> DataFrame:
        """Opportunities (``n``) and expected cents (``e_c``) per stage and probability."""
        return (self.opportunities.groupBy("stage", "probability")
                .agg(F.count("opportunity_id").alias("n"), sum_cents(F.col("expected_revenue_cents")).alias("e_c")))

    def deal_counts(self, *keys: str) -> DataFrame:
        """Deals won, lost and closed per key, or over all opportunities."""
        deals = self.opportunities_with_rep if keys else self.opportunities

        def count(*stages: str):
            return F.count(F.when(F.col("stage").isin(*stages), F.col("opportunity_id")))

        return deals.groupBy(*keys).agg(
            count(build.CLOSED_WON).alias("deals_won"), count(build.CLOSED_LOST).alias("deals_lost"),
            count(build.CLOSED_WON, build.CLOSED_LOST).alias("total_closed"))

    # --- audits ---------------------------------------------------------------

    #: The tables as stored, for SQL; None: they are derived (see ``sql_tables``).
    stored_frames: dict[str, DataFrame] | None = None

    #: References of the source tables beside the declared ones.
    more_foreign_keys = (
        ("sales.order_id", "sales_source", "order_id", "sales_order_source", "order_id"),
        ("customers.state", "customers_source", "nation_key", "nations", "n_nationkey"),
        ("salespeople.state", "salespeople_source", "nation_key", "nations", "n_nationkey"),
    )

    @cached_property
    def audit_frames(self) -> dict[str, DataFrame]:
        """The source tables under the star's column names, before any join."""
        first, last = (F.split_part(F.col("s_name"), F.lit("#"), F.lit(i)) for i in (1, 2))
        return {
            "customers_source": self.raw("customer").select(
                F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("nation_key")),
            "salespeople_source": self.raw("supplier").select(
                F.col("s_suppkey").alias("salesperson_id"), F.col("s_nationkey").alias("nation_key")),
            # state and region as looked up: NULL where the nation is unknown
            "customers_lookup": self.raw("customer").join(
                self.nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
                F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("company_name"),
                F.col("c_mktsegment").alias("industry"), "state",
                build.customer_size(key_draw("c_custkey", draws.CUSTOMER_SIZE)).alias("customer_size")),
            "salespeople_lookup": self.raw("supplier").join(
                self.nations.join(self.t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"),
                F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
                F.col("s_suppkey").alias("salesperson_id"), first.alias("first_name"), last.alias("last_name"),
                "state", F.col("r_name").alias("region")),
            "sales_source": self.raw("lineitem").select(
                F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                F.col("l_suppkey").alias("salesperson_id"), F.col("l_quantity").alias("quantity")),
            "sales_order_source": self.raw("orders").select(
                F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                F.col("o_orderdate").alias("sale_date")),
            # the keys of the generated targets, without the rescale that needs all sales
            "target_keys": build.build_targets(
                self.salespeople_opening.withColumn("annual_cents", money_cents(F.col("annual_target"))),
                *self.calendar_range),
        }

    # --- materialization ----------------------------------------------------

    def materialize(self, path: str | None = None, partitions: int | None = None, *,
                    sales: DataFrame | None = None, pipeline: DataFrame | None = None) -> "MaterializedStar":
        """Write the priced facts and the dimensions once; return a star reading them.

        Like the load scripts of a warehouse: the two big joins and the per-row
        pricing run once, and every report then scans a narrow, already priced
        fact.  Tables go to ``path`` or to a fresh folder under the shared
        ``spark.checkpoint.dir``, never to a machine-local folder on a cluster.
        Writing a table also cuts the lineage, so a lost executor costs a
        re-read, not a re-join.

        ``partitions``: if given, every table is written as that many files;
        otherwise as the joins produce it (``spread`` of ``from_parquet``
        decides how many partitions a small fact scan has).

        ``sales`` and ``pipeline``: these facts in another form with the same rows
        and columns, such as one that counts as it is written (``load_audit``).
        """
        from quotalake.session import shared_scratch

        base = path or f"{shared_scratch(self.spark)}/quotalake-star-{uuid.uuid4().hex}"
        builder = self
        # Plans are built inside the writer threads: building the pipeline runs
        # its own small bounds jobs, which then overlap with the other writes.
        frames = {
            "customers": lambda: builder.customers,
            "products": lambda: builder.products,
            "salespeople_opening": lambda: builder.salespeople_opening,
            "pipeline": lambda: (builder.pipeline if pipeline is None else pipeline).drop("expected_revenue"),  # carried as cents
        }
        sales_plan = (builder.sales if sales is None else sales).select("order_id", "line_number", "customer_id", "salesperson_id", "product_id", "sale_date",
                                          "quantity", "discount_percent", *SALES_CENTS)

        def write(name: str, df: DataFrame) -> None:
            (df.repartition(partitions) if partitions else df).write.mode("overwrite").parquet(f"{base}/{name}")

        def sales_and_aggregates() -> None:
            # The aggregates read the sales table just written, not the joins again.
            write("sales", sales_plan)
            sales = with_money_columns(self.spark.read.parquet(f"{base}/sales"))
            aggregates = {"rep_months": rep_months_of(sales),
                          **{f"totals_{key}": totals_by(sales, key) for key in MATERIALIZED_TOTALS}}
            with ThreadPoolExecutor(max_workers=len(aggregates)) as inner:
                for f in [inner.submit(write, n, df) for n, df in aggregates.items()]:
                    f.result()

        # The writes are independent jobs (the aggregates wait for the sales
        # table only): submitting them from a few driver threads lets the
        # scheduler overlap their stages instead of leaving cores idle while
        # one small table's job finishes.
        jobs = [sales_and_aggregates] + [(lambda n=name, plan=plan: write(n, plan())) for name, plan in frames.items()]
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for f in [pool.submit(job) for job in jobs]:
                f.result()
        return MaterializedStar(self.spark, self.source, self.config, base)


class MaterializedStar(Star):
    """A star whose facts and dimensions were written by ``Star.materialize``."""

    def __init__(self, spark: SparkSession, source, config: StarConfig, base: str):
        super().__init__(spark, source, config)
        self.base = base

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{name}")

    @cached_property
    def customers(self) -> DataFrame:
        return self._read("customers")

    @cached_property
    def products(self) -> DataFrame:
        return self._read("products")

    @cached_property
    def salespeople_opening(self) -> DataFrame:
        return self._read("salespeople_opening")

    @cached_property
    def sales(self) -> DataFrame:
        return with_money_columns(self._read("sales"))

    @cached_property
    def sales_lines(self) -> DataFrame:
        return self.sales

    @cached_property
    def rep_months(self) -> DataFrame:
        return self._read("rep_months")

    def grand_totals(self) -> DataFrame:
        return rolled_up(self._read("totals_sale_date"))

    def sales_totals(self, key: str) -> DataFrame:
        cache = self.__dict__.setdefault("_totals", {})
        if key not in cache:
            if key in MATERIALIZED_TOTALS:
                cache[key] = self._read(f"totals_{key}")
            elif key == "salesperson_id":
                cache[key] = rolled_up(self.rep_months, key)
            else:
                cache[key] = totals_by(self.sales, key)
        return cache[key]

    @property
    def opportunities(self) -> DataFrame:
        return self.pipeline

    @property
    def opportunities_with_rep(self) -> DataFrame:
        return self.pipeline

    @cached_property
    def pipeline(self) -> DataFrame:
        p = self._read("pipeline")
        return p.select(*[c for c in p.columns if c != "expected_revenue_cents"],
                        money_from_cents(F.col("expected_revenue_cents"), 14).alias("expected_revenue"),
                        "expected_revenue_cents")
