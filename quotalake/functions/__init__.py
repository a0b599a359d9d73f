"""Column-expression helpers: exact decimals, deterministic draws, dates, text."""

from quotalake.functions.calendar_fns import financial_year, iso_week, month_name
from quotalake.functions.draws import kth_of, key_draw, weighted_choice
from quotalake.functions.exact import (
    half_up_long,
    half_up_quotient,
    money_cents,
    money_from_cents,
    pct,
    round_ratio,
    sum_cents,
    to_money,
    unscale,
)
from quotalake.functions.text import full_name, title_case

__all__ = [
    "financial_year", "full_name", "half_up_long", "half_up_quotient", "iso_week", "key_draw",
    "kth_of", "money_cents", "money_from_cents", "month_name", "pct", "round_ratio", "sum_cents",
    "title_case", "to_money", "unscale", "weighted_choice",
]
