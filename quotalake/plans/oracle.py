"""SQL definitions of every registered query, for DuckDB.

Written from the same specification as the DataFrame operators, not generated
from them: weights, labels, thresholds and audit rules are spelled out here and
nothing is imported from the package.  DuckDB divides DECIMALs in DOUBLE, so
every rounded ratio is computed on integer units (cents, counts) with an
explicit half-away-from-zero integer quotient, and money leaves as DOUBLE,
exactly as the Spark side is cast for the comparison.
"""

from __future__ import annotations

# Fixed values of the specification, stated here a second time on purpose.
STAGES = ("Prospecting", "Qualification", "Proposal", "Negotiation", "Closed Won", "Closed Lost")
STAGE_PROBABILITY = (10, 25, 50, 75, 100, 0)
STAGE_WEIGHTS = (300, 250, 200, 150, 60, 40)
CUSTOMER_SIZES = ("Small", "Medium", "Large", "Enterprise")
CUSTOMER_SIZE_WEIGHTS = (400, 300, 200, 100)
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CATEGORY_WEIGHTS = (320, 250, 180, 150, 50, 50)
TARGET_SHARE_PCT = 90
LEAD_YEARS = 1
TIER_HIGH = 8000
TIER_MEDIUM = 5000
TOP_CUSTOMERS = 20


def _hu(num: str, den: str) -> str:
    """Half-away-from-zero integer quotient of two HUGEINT expressions (NULL if den is 0)."""
    return (f"(sign({num}) * sign({den}) * ((2 * abs({num}) + abs({den})) "
            f"// (2 * abs(nullif({den}, 0)))))")


def _c(expr: str) -> str:
    """Integral cents of a 2-decimal money expression."""
    return f"CAST(({expr}) * 100 AS HUGEINT)"


def _d(units: str, scale: int) -> str:
    """Integral units of 10^-scale as DOUBLE."""
    return f"(CAST({units} AS DOUBLE) / {10 ** scale})"


def _money(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def _draw(key: str, name: str) -> str:
    """The leading 60 bits of md5(key:name)."""
    return f"CAST('0x' || left(md5(CAST({key} AS VARCHAR) || ':{name}'), 15) AS BIGINT)"


def _case(draw: str, weights, labels, quote: bool = True) -> str:
    parts, bound = [], 0
    for w, label in zip(weights[:-1], labels[:-1]):
        bound += w
        lit = f"'{label}'" if quote else str(label)
        parts.append(f"WHEN {draw} % 1000 < {bound} THEN {lit}")
    last = f"'{labels[-1]}'" if quote else str(labels[-1])
    return "CASE " + " ".join(parts) + f" ELSE {last} END"


_MARKUP = "CAST(56 + 4 * (((p_size % 6) + 6) % 6) AS DECIMAL(4,0))"

def _pool_state(reps: str) -> str:
    return f"""
        SELECT salesperson_id, state,
               row_number() OVER (PARTITION BY state ORDER BY {_draw('salesperson_id', 'position')}, salesperson_id)
                   AS rn,
               count(*) OVER (PARTITION BY state) AS cnt
        FROM {reps}"""


def _pool_all(reps: str) -> str:
    return f"""
        SELECT salesperson_id,
               row_number() OVER (ORDER BY {_draw('salesperson_id', 'position')}, salesperson_id) AS rn,
               count(*) OVER () AS cnt
        FROM {reps}"""


_PIPELINE = """
        SELECT o.opportunity_id, o.customer_id,
               coalesce(m.salesperson_id, f.salesperson_id) AS salesperson_id, pr.product_id,
               o.stage, o.probability, o.expected_close_date, o.expected_revenue
        FROM opp o
        LEFT JOIN (SELECT DISTINCT category, cnt FROM prod_rank) pc ON pc.category = o.pcat
        LEFT JOIN prod_rank pr ON pr.category = o.pcat AND pr.rn = 1 + o.pdraw % pc.cnt
        LEFT JOIN (SELECT DISTINCT state, cnt FROM pool_state) sc ON sc.state = o.state
        LEFT JOIN pool_state m ON m.state = o.state AND m.rn = 1 + o.tdraw % sc.cnt
        LEFT JOIN pool_all f ON f.rn = 1 + o.tdraw % f.cnt"""

_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    # first/last order year: the calendar starts a year before the first, the
    # rescale divides by the years spanned, the miss rate starts at the first
    "span": ((), """
        SELECT CAST(year(min(o_orderdate)) AS INTEGER) AS y0,
               CAST(year(max(o_orderdate)) AS INTEGER) AS y1
        FROM orders"""),
    "products": ((), f"""
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * {_MARKUP} * 0.01, 2) AS DECIMAL(10,2))
                   AS standard_cost,
               CAST(p_retailprice AS DECIMAL(10,2)) AS list_price
        FROM part"""),
    "customers": ((), f"""
        SELECT c_custkey AS customer_id, c_name AS company_name, c_mktsegment AS industry,
               n_name AS state,
               {_case(_draw('c_custkey', 'customer_size'), CUSTOMER_SIZE_WEIGHTS, CUSTOMER_SIZES)}
                   AS customer_size
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "reps0": ((), """
        SELECT s_suppkey AS salesperson_id, split_part(s_name, '#', 1) AS first_name,
               split_part(s_name, '#', 2) AS last_name, n_name AS state, r_name AS region,
               CAST(greatest(s_acctbal, 0.0) AS DECIMAL(14,2)) AS annual_target
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey"""),
    "lines": (("products",), """
        SELECT l_orderkey, l_suppkey AS salesperson_id, product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(CAST(round(l_discount * 10000.0) AS DECIMAL(7,0)) * 0.01 AS DECIMAL(5,2)) AS discount_percent,
               list_price, standard_cost
        FROM lineitem JOIN products ON l_partkey = product_id"""),
    "priced": (("lines",), """
        SELECT l_orderkey, salesperson_id, product_id, quantity, discount_percent,
               CAST(round(list_price * (100 - coalesce(discount_percent, 0)) * 0.01, 2) AS DECIMAL(12,2))
                   AS unit_price,
               CAST(round(list_price * (100 - coalesce(discount_percent, 0)) * quantity * 0.01, 2)
                   AS DECIMAL(14,2)) AS revenue,
               CAST(round(standard_cost * quantity, 2) AS DECIMAL(14,2)) AS cost,
               CAST(round(list_price * (100 - coalesce(discount_percent, 0)) * quantity * 0.01
                          - standard_cost * quantity, 2) AS DECIMAL(14,2)) AS profit
        FROM lines"""),
    "sales": (("priced",), """
        SELECT o_custkey AS customer_id, salesperson_id, product_id,
               CAST(o_orderdate AS DATE) AS sale_date, quantity, discount_percent,
               unit_price, revenue, cost, profit
        FROM priced JOIN orders ON l_orderkey = o_orderkey"""),
    "monthly_actuals": (("sales",), """
        SELECT salesperson_id, CAST(year(sale_date) AS INTEGER) AS year,
               CAST(month(sale_date) AS INTEGER) AS month, sum(revenue) AS actual_revenue
        FROM sales GROUP BY 1, 2, 3"""),
    "rep_revenue": (("monthly_actuals",), """
        SELECT salesperson_id, sum(actual_revenue) AS revenue_total
        FROM monthly_actuals GROUP BY 1"""),
    "reps": (("reps0", "rep_revenue", "span"), f"""
        SELECT r.salesperson_id, r.first_name, r.last_name, r.state, r.region,
               coalesce({_hu(_c('rr.revenue_total') + f' * {TARGET_SHARE_PCT}',
                             'CAST((sp.y1 - sp.y0 + 1) * 100 AS HUGEINT)')},
                        {_c('r.annual_target')}) AS annual_cents
        FROM reps0 r LEFT JOIN rep_revenue rr ON rr.salesperson_id = r.salesperson_id
        CROSS JOIN span sp"""),
    "months": (("span",), f"""
        SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
        FROM (SELECT unnest(generate_series(make_date(y0 - {LEAD_YEARS}, 1, 1), make_date(y1, 12, 1),
                                            INTERVAL 1 MONTH)) AS m FROM span)"""),
    "targets": (("reps", "months"), f"""
        SELECT r.salesperson_id, r.first_name || ' ' || r.last_name AS full_name, m.year, m.month,
               {_hu('r.annual_cents', 'CAST(12 AS HUGEINT)')} AS target_cents
        FROM reps r, months m"""),
    "target_months": (("targets", "monthly_actuals"), """
        SELECT t.salesperson_id, t.full_name, t.year, t.month, t.target_cents,
               coalesce(CAST(ma.actual_revenue * 100 AS HUGEINT), 0) AS actual_cents
        FROM targets t LEFT JOIN monthly_actuals ma
          ON ma.salesperson_id = t.salesperson_id AND ma.year = t.year AND ma.month = t.month"""),
    "calendar": (("span",), f"""
        SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
               CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day,
               'FY' || CAST(year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS VARCHAR)
                   AS financial_year
        FROM (SELECT CAST(unnest(generate_series(make_date(y0 - {LEAD_YEARS}, 1, 1),
                                                 make_date(y1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
              FROM span)"""),
    "pool_state": (("reps0",), _pool_state("reps0")),
    "pool_all": (("reps0",), _pool_all("reps0")),
    "opp": (("customers",), f"""
        SELECT o_orderkey AS opportunity_id, o_custkey AS customer_id,
               {_case(_draw('o_orderkey', 'stage'), STAGE_WEIGHTS, STAGES)} AS stage,
               CAST({_case(_draw('o_orderkey', 'stage'), STAGE_WEIGHTS, STAGE_PROBABILITY, quote=False)}
                    AS DECIMAL(5,2)) AS probability,
               CAST(o_orderdate AS DATE) AS expected_close_date,
               CAST(o_totalprice AS DECIMAL(14,2)) AS expected_revenue,
               {_draw('o_orderkey', 'territory')} AS tdraw, c.state,
               {_case(_draw('o_orderkey', 'category'), CATEGORY_WEIGHTS, CATEGORIES)}
                   AS pcat,
               {_draw('o_orderkey', 'product')} AS pdraw
        FROM orders LEFT JOIN customers c ON o_custkey = c.customer_id"""),
    "prod_rank": (("products",), f"""
        SELECT product_id, category,
               row_number() OVER (PARTITION BY category ORDER BY {_draw('product_id', 'position')}, product_id)
                   AS rn,
               count(*) OVER (PARTITION BY category) AS cnt
        FROM products"""),
    "pipeline": (("opp", "pool_state", "pool_all", "prod_rank"), _PIPELINE),
    "state_revenue": (("sales", "customers"), """
        SELECT cu.state, sum(s.revenue) AS total_revenue, sum(s.profit) AS total_profit,
               count(*) AS sales_count
        FROM sales s JOIN customers cu ON cu.customer_id = s.customer_id
        GROUP BY cu.state"""),
    "product_summary": (("sales", "products"), f"""
        SELECT p.product_id, p.product_name, sum(s.revenue) AS total_revenue,
               sum(s.profit) AS total_profit, count(*) AS sales_count
        FROM products p JOIN sales s ON p.product_id = s.product_id
        GROUP BY p.product_id, p.product_name"""),
    "pipeline_closed": (("pipeline",), """
        SELECT salesperson_id,
               count(opportunity_id) FILTER (WHERE stage = 'Closed Won') AS deals_won,
               count(opportunity_id) FILTER (WHERE stage = 'Closed Lost') AS deals_lost,
               count(opportunity_id) FILTER (WHERE stage IN ('Closed Won', 'Closed Lost')) AS total_closed
        FROM pipeline GROUP BY salesperson_id"""),
}


def _with(*needed: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in needed:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]}\n)" for n in order) + "\n"


def _pct(part: str, whole: str, scale: int) -> str:
    return _d(_hu(f"CAST({part} AS HUGEINT) * {100 * 10 ** scale}", f"CAST({whole} AS HUGEINT)"), scale)


def _margin(profit: str = "total_profit", revenue: str = "total_revenue") -> str:
    return _d(_hu(f"{_c(profit)} * 10000", _c(revenue)), 2)


def _avg2(total: str, n: str) -> str:
    return _d(_hu(_c(total), f"CAST({n} AS HUGEINT)"), 2)


_PRODUCT_COLS = f"""product_id, product_name, {_money('total_revenue')} AS total_revenue,
    {_money('total_profit')} AS total_profit, sales_count,
    {_avg2('total_revenue', 'sales_count')} AS avg_revenue,
    {_avg2('total_profit', 'sales_count')} AS avg_profit"""

_STATE_VARIANCE = _with("state_revenue") + f"""
    , sv AS (SELECT state, total_revenue, {_c('total_revenue')} AS rc,
                    sum({_c('total_revenue')}) OVER () AS tot, count(*) OVER () AS n FROM state_revenue)
    SELECT state, {_money('total_revenue')} AS total_revenue,
           {_d(_hu('tot', 'CAST(n AS HUGEINT)'), 2)} AS company_avg_revenue,
           {_d(_hu('CAST(n AS HUGEINT) * rc - tot', 'CAST(n AS HUGEINT)'), 2)} AS variance_from_avg
    FROM sv"""

def _miss_rate(since: str) -> str:
    return _with("target_months", "span") + f"""
    , tm AS (SELECT * FROM target_months WHERE year >= (SELECT {since} FROM span))
    SELECT salesperson_id, full_name,
           count(month) FILTER (WHERE actual_cents < target_cents) AS months_missed,
           count(month) AS total_months,
           {_pct('count(month) FILTER (WHERE actual_cents < target_cents)', 'count(month)', 1)}
               AS pct_months_missed
    FROM tm GROUP BY salesperson_id, full_name"""


_MISS_RATE = _miss_rate("y0")

_ACTUAL_VS_TARGET = _with("target_months") + f"""
    SELECT salesperson_id, full_name, year, month, {_d('target_cents', 2)} AS monthly_target,
           {_d('actual_cents', 2)} AS actual_revenue,
           {_d('actual_cents - target_cents', 2)} AS variance,
           {_d(_hu('actual_cents * 1000', 'target_cents'), 1)} AS pct_of_target
    FROM target_months"""

_STATE = _with("state_revenue") + f"""
    SELECT state, {_money('total_revenue')} AS total_revenue, {_money('total_profit')} AS total_profit,
           {_margin()} AS margin_pct, sales_count
    FROM state_revenue"""

_MONTH = _with("calendar", "sales") + f"""
    SELECT c.year, c.month, c.month_name, {_money('sum(s.revenue)')} AS total_revenue
    FROM calendar c JOIN sales s ON c.date = s.sale_date
    GROUP BY c.year, c.month, c.month_name"""

_CUSTOMERS_ALL = _with("sales", "customers") + f"""
    SELECT cu.customer_id, cu.company_name, cu.industry, cu.state,
           {_money('sum(s.revenue)')} AS total_revenue, {_money('sum(s.profit)')} AS total_profit,
           count(*) AS num_purchases
    FROM customers cu JOIN sales s ON s.customer_id = cu.customer_id
    GROUP BY cu.customer_id, cu.company_name, cu.industry, cu.state"""

_REP_PERF = _with("sales", "reps0") + f"""
    , agg AS (SELECT salesperson_id, sum(revenue) AS total_revenue, sum(profit) AS total_profit,
                     count(*) AS sales_count FROM sales GROUP BY salesperson_id)
    SELECT r.salesperson_id,
           upper(left(r.first_name, 1)) || lower(substr(r.first_name, 2)) || ' '
             || upper(left(r.last_name, 1)) || lower(substr(r.last_name, 2)) AS full_name,
           {_money('a.total_revenue')} AS total_revenue, {_money('a.total_profit')} AS total_profit,
           {_avg2('a.total_revenue', 'a.sales_count')} AS avg_deal_size, a.sales_count
    FROM agg a JOIN reps0 r ON r.salesperson_id = a.salesperson_id"""

_STAGE = _with("pipeline") + f"""
    SELECT stage, count(opportunity_id) AS num_deals,
           {_money('sum(expected_revenue)')} AS total_expected_revenue,
           {_money('round(sum(expected_revenue * probability * 0.01), 2)')} AS weighted_pipeline_value
    FROM pipeline GROUP BY stage"""

_WIN_BY_REP = _with("pipeline_closed", "reps0") + f"""
    SELECT r.salesperson_id, r.first_name || ' ' || r.last_name AS full_name,
           pc.deals_won, pc.total_closed,
           {_pct('pc.deals_won', 'pc.total_closed', 1)} AS win_rate_pct
    FROM pipeline_closed pc JOIN reps0 r ON r.salesperson_id = pc.salesperson_id"""

ORACLE_SQL: dict[str, str] = {
    "overall_performance": _with("sales") + f"""
        SELECT {_money('sum(revenue)')} AS total_revenue, {_money('sum(profit)')} AS total_profit,
               {_margin('sum(profit)', 'sum(revenue)')} AS margin_pct
        FROM sales""",
    "revenue_by_month": f"SELECT year, month_name, total_revenue FROM ({_MONTH})",
    "vw_revenue_by_month": _MONTH,
    "revenue_by_state": _STATE,
    "vw_revenue_by_state": _STATE,
    "revenue_by_product": _with("product_summary") + f"""
        , ps AS (SELECT {_PRODUCT_COLS} FROM product_summary)
        SELECT *, CASE WHEN avg_profit >= {TIER_HIGH} THEN 'High'
                       WHEN avg_profit >= {TIER_MEDIUM} THEN 'Medium' ELSE 'Low' END AS profit_tier
        FROM ps""",
    "vw_revenue_by_product": _with("product_summary") + f"""
        SELECT {_PRODUCT_COLS},
               CASE WHEN total_profit >= {TIER_HIGH} * sales_count THEN 'High'
                    WHEN total_profit >= {TIER_MEDIUM} * sales_count THEN 'Medium' ELSE 'Low' END
                   AS profit_tier
        FROM product_summary""",
    "salesperson_performance": _REP_PERF,
    "vw_salesperson_performance": _REP_PERF,
    "actual_vs_target": _ACTUAL_VS_TARGET,
    "vw_actual_vs_target": _ACTUAL_VS_TARGET,
    "top_customers": f"""SELECT * FROM ({_CUSTOMERS_ALL})
        ORDER BY total_revenue DESC, customer_id LIMIT {TOP_CUSTOMERS}""",
    "vw_top_customers": _CUSTOMERS_ALL,
    "pipeline_by_stage": _STAGE,
    "vw_pipeline_by_stage": _STAGE,
    "win_rate_overall": _with("pipeline") + f"""
        , w AS (SELECT count(opportunity_id) FILTER (WHERE stage = 'Closed Won') AS deals_won,
                       count(opportunity_id) FILTER (WHERE stage = 'Closed Lost') AS deals_lost,
                       count(opportunity_id) FILTER (WHERE stage IN ('Closed Won', 'Closed Lost'))
                           AS total_closed
                FROM pipeline)
        SELECT deals_won, deals_lost, total_closed,
               {_pct('deals_won', 'total_closed', 1)} AS win_rate_pct FROM w""",
    "win_rate_by_salesperson": _WIN_BY_REP,
    "vw_win_rate_by_salesperson": _WIN_BY_REP,
    "state_variance": _STATE_VARIANCE,
    "vw_underperforming_states": _STATE_VARIANCE,
    "target_miss_rate": _MISS_RATE,
    "vw_target_miss_rate": _MISS_RATE,
    # --- data-building operators ---
    "build_calendar": _with("calendar") + """
        SELECT CAST(date AS VARCHAR) AS date, year, quarter, month, month_name, week, day,
               financial_year FROM calendar""",
    "build_products": _with("products") + f"""
        SELECT product_id, product_name, category, {_money('standard_cost')} AS standard_cost,
               {_money('list_price')} AS list_price FROM products""",
    "build_customers": _with("customers") + "SELECT * FROM customers",
    "price_sales": _with("sales") + f"""
        SELECT customer_id, salesperson_id, product_id, CAST(sale_date AS VARCHAR) AS sale_date, quantity,
               {_money('discount_percent')} AS discount_percent, {_money('unit_price')} AS unit_price,
               {_money('revenue')} AS revenue, {_money('cost')} AS cost, {_money('profit')} AS profit
        FROM sales""",
    "rescale_targets": _with("reps") + f"""
        SELECT salesperson_id, first_name, last_name, state, region,
               {_d('annual_cents', 2)} AS annual_target FROM reps""",
    "build_targets": _with("targets") + f"""
        SELECT salesperson_id, year, month, {_d('target_cents', 2)} AS monthly_target FROM targets""",
    "target_validation": _with("reps", "rep_revenue", "span") + f"""
        SELECT r.salesperson_id, {_d('r.annual_cents', 2)} AS annual_target,
               {_d(_hu('r.annual_cents', 'CAST(12 AS HUGEINT)'), 2)} AS monthly_target,
               {_d(_hu(_c('rr.revenue_total') + ' * 10000', 'CAST(12 * (sp.y1 - sp.y0 + 1) AS HUGEINT)'), 6)}
                   AS avg_actual_monthly_revenue
        FROM reps r JOIN rep_revenue rr ON rr.salesperson_id = r.salesperson_id CROSS JOIN span sp""",
    "assign_territory": _with("pipeline") + f"""
        SELECT opportunity_id, customer_id, salesperson_id, product_id, stage,
               {_money('probability')} AS probability,
               CAST(expected_close_date AS VARCHAR) AS expected_close_date,
               {_money('expected_revenue')} AS expected_revenue
        FROM pipeline""",
}


# --- integrity audits -------------------------------------------------------
#
# Rules by hand, as (rule, table, SQL).  Keys, references and NULLs of source
# columns are counted in the source tables.

def _count(rule: str, table: str, condition: str, source: str) -> str:
    return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, "
            f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT) AS violations FROM {source}")


def _dupes(rule: str, table: str, source: str, cols: str) -> str:
    return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) "
            f"AS violations FROM (SELECT count(*) AS n FROM {source} GROUP BY {cols})")


def _orphans(rule: str, child: str, col: str, parent: str, pcol: str) -> str:
    return (f"SELECT 'fk:{rule}' AS rule, '{rule.split('.')[0]}' AS table_name, CAST(count(*) AS BIGINT) AS violations "
            f"FROM {child} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})")


_AUDIT_TABLES = _with("customers", "products", "pipeline", "calendar", "sales", "reps", "targets") + """
    , salespeople_t AS (SELECT *, CAST(annual_cents AS DOUBLE) / 100 AS annual_target FROM reps)
    , targets_t AS (SELECT *, CAST(target_cents AS DOUBLE) / 100 AS monthly_target FROM targets)
"""

_UNIQUE = [
    _dupes("unique:customers(customer_id)", "customers", "customer", "c_custkey"),
    _dupes("unique:products(product_id)", "products", "part", "p_partkey"),
    _dupes("unique:products(product_name)", "products", "part", "p_name"),
    _dupes("unique:salespeople(salesperson_id)", "salespeople", "supplier", "s_suppkey"),
    _dupes("unique:pipeline(opportunity_id)", "pipeline", "orders", "o_orderkey"),
    _dupes("unique:calendar(date)", "calendar", "calendar", "date"),
    _dupes("unique:targets(salesperson_id,year,month)", "targets", "targets_t", "salesperson_id, year, month"),
]

_FOREIGN = [
    _orphans("sales.customer_id", "orders", "o_custkey", "customer", "c_custkey"),
    _orphans("sales.salesperson_id", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _orphans("sales.product_id", "lineitem", "l_partkey", "part", "p_partkey"),
    _orphans("pipeline.customer_id", "orders", "o_custkey", "customer", "c_custkey"),
    _orphans("pipeline.salesperson_id", "pipeline", "salesperson_id", "supplier", "s_suppkey"),
    _orphans("pipeline.product_id", "pipeline", "product_id", "part", "p_partkey"),
    _orphans("targets.salesperson_id", "targets_t", "salesperson_id", "supplier", "s_suppkey"),
    _orphans("sales.order_id", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _orphans("customers.state", "customer", "c_nationkey", "nation", "n_nationkey"),
    _orphans("salespeople.state", "supplier", "s_nationkey", "nation", "n_nationkey"),
]

_CHECK = [
    _count("check:products.standard_cost", "products", "NOT standard_cost >= 0", "products"),
    _count("check:products.list_price", "products", "NOT list_price >= 0", "products"),
    _count("check:salespeople.annual_target", "salespeople", "NOT annual_target >= 0", "salespeople_t"),
    _count("check:pipeline.probability", "pipeline", "NOT probability BETWEEN 0 AND 100", "pipeline"),
    _count("check:pipeline.expected_revenue", "pipeline", "NOT expected_revenue >= 0", "pipeline"),
    _count("check:targets.month", "targets", "NOT month BETWEEN 1 AND 12", "targets_t"),
    _count("check:targets.monthly_target", "targets", "NOT monthly_target >= 0", "targets_t"),
    _count("check:calendar.quarter", "calendar", "NOT quarter BETWEEN 1 AND 4", "calendar"),
    _count("check:calendar.month", "calendar", "NOT month BETWEEN 1 AND 12", "calendar"),
    _count("check:calendar.week", "calendar", "NOT week BETWEEN 1 AND 53", "calendar"),
    _count("check:calendar.day", "calendar", "NOT day BETWEEN 1 AND 31", "calendar"),
]

_NULLS = [_count(f"not_null:{table}.{col}", table, f"{expr} IS NULL", source) for table, col, expr, source in (
    ("customers", "customer_id", "c_custkey", "customer"),
    ("customers", "company_name", "c_name", "customer"),
    ("customers", "industry", "c_mktsegment", "customer"),
    ("customers", "state", "n_name", "customer LEFT JOIN nation ON c_nationkey = n_nationkey"),
    ("customers", "customer_size", "c_custkey", "customer"),
    ("products", "product_id", "p_partkey", "part"),
    ("products", "product_name", "p_name", "part"),
    ("products", "category", "p_type", "part"),
    ("products", "standard_cost", "standard_cost", "products"),
    ("products", "list_price", "p_retailprice", "part"),
    ("salespeople", "salesperson_id", "s_suppkey", "supplier"),
    ("salespeople", "first_name", "s_name", "supplier"),
    ("salespeople", "last_name", "s_name", "supplier"),
    ("salespeople", "state", "n_name", "supplier LEFT JOIN nation ON s_nationkey = n_nationkey"),
    ("salespeople", "region", "r_name", "supplier LEFT JOIN nation ON s_nationkey = n_nationkey "
                                        "LEFT JOIN region ON n_regionkey = r_regionkey"),
    ("salespeople", "annual_target", "annual_target", "salespeople_t"),
    ("sales", "product_id", "l_partkey", "lineitem"),
    ("sales", "salesperson_id", "l_suppkey", "lineitem"),
    ("sales", "quantity", "l_quantity", "lineitem"),
    ("sales", "customer_id", "o_custkey", "orders"),
    ("sales", "sale_date", "o_orderdate", "orders"),
    ("sales", "unit_price", "unit_price", "sales"),
    ("sales", "revenue", "revenue", "sales"),
    ("sales", "cost", "cost", "sales"),
    ("sales", "profit", "profit", "sales"),
    ("pipeline", "opportunity_id", "o_orderkey", "orders"),
    ("pipeline", "customer_id", "o_custkey", "orders"),
    ("pipeline", "stage", "stage", "pipeline"),
    ("pipeline", "probability", "probability", "pipeline"),
    ("pipeline", "expected_close_date", "o_orderdate", "orders"),
    ("pipeline", "expected_revenue", "o_totalprice", "orders"),
    ("pipeline", "salesperson_id", "salesperson_id", "pipeline"),
    ("pipeline", "product_id", "product_id", "pipeline"),
    ("targets", "salesperson_id", "salesperson_id", "targets_t"),
    ("targets", "year", "year", "targets_t"),
    ("targets", "month", "month", "targets_t"),
    ("targets", "monthly_target", "monthly_target", "targets_t"),
    *(("calendar", c, c, "calendar") for c in ("date", "year", "quarter", "month", "month_name", "week", "day",
                                               "financial_year")),
)]

ORACLE_SQL |= {
    "audit_unique": _AUDIT_TABLES + " UNION ALL ".join(_UNIQUE),
    "audit_fk": _AUDIT_TABLES + " UNION ALL ".join(_FOREIGN),
    "audit_check": _AUDIT_TABLES + " UNION ALL ".join(_CHECK),
    "audit_not_null": _AUDIT_TABLES + " UNION ALL ".join(_NULLS),
    "audit_load": _AUDIT_TABLES + " UNION ALL ".join(_CHECK + _NULLS),
    "audit_unique_integral": _AUDIT_TABLES + " UNION ALL ".join(
        r for r in _UNIQUE if any(f"({key})" in r for key in ("customer_id", "product_id", "salesperson_id", "opportunity_id"))),
    # targets of the last year's rep-months that beat them become the actuals
    "merge_targets": _with("target_months", "span") + f"""
        SELECT salesperson_id, year, month,
               {_d("CASE WHEN year = (SELECT y1 FROM span) AND actual_cents > target_cents THEN actual_cents "
                   "ELSE target_cents END", 2)} AS monthly_target
        FROM target_months""",
    # B9 with reps of some nations only
    "assign_territory_fallback": _with("opp", "prod_rank", "reps0") + f"""
        , some_reps AS (SELECT reps0.* FROM reps0 JOIN supplier ON salesperson_id = s_suppkey
                        WHERE s_nationkey % 5 <> 4)
        , pool_state AS ({_pool_state("some_reps")})
        , pool_all AS ({_pool_all("some_reps")})
        , pipeline AS ({_PIPELINE})
        SELECT opportunity_id, customer_id, salesperson_id, product_id, stage,
               {_money('probability')} AS probability, CAST(expected_close_date AS VARCHAR) AS expected_close_date,
               {_money('expected_revenue')} AS expected_revenue
        FROM pipeline""",
    # kept views equal the views over all facts
    "kept_revenue_by_state": _STATE,
    "kept_target_miss_rate": _MISS_RATE,
    "kept_pipeline_by_stage": _STAGE,
    # sales stored by year: the last financial year, the last three years' targets, all after a reload
    "yearly_revenue_by_month": _with("calendar", "sales", "span") + f"""
        SELECT c.year, c.month, c.month_name, {_money('sum(s.revenue)')} AS total_revenue
        FROM calendar c JOIN sales s ON c.date = s.sale_date
        WHERE c.financial_year = (SELECT 'FY' || CAST(y1 AS VARCHAR) FROM span)
        GROUP BY c.year, c.month, c.month_name""",
    "yearly_target_miss_rate": _miss_rate("y1 - 2"),
    "yearly_actual_vs_target": _ACTUAL_VS_TARGET,
    # Every line item valued at its product's list price, undiscounted
    "value_opportunity": _with("products") + f"""
        SELECT l_orderkey AS opportunity_id, l_linenumber AS line_number, product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               {_money('round(list_price * CAST(l_quantity AS INTEGER), 2)')} AS expected_revenue
        FROM lineitem JOIN products ON l_partkey = product_id""",
    # ungrouped B8: one customer picked per order
    "pick_customer": _with("customers") + f"""
        , ranked AS (SELECT customer_id, row_number() OVER (
                         ORDER BY {_draw('customer_id', 'position')}, customer_id) AS rn,
                     count(*) OVER () AS cnt FROM customers)
        SELECT o_orderkey AS opportunity_id, r.customer_id AS picked_customer_id
        FROM orders LEFT JOIN ranked r ON r.rn = 1 + {_draw('o_orderkey', 'customer')} % r.cnt""",
}
