"""Deterministic per-row draws and weighted bucketing.

The original data generator draws a separate ``random()`` column per decision.
Here a draw is the leading 60 bits of ``md5(key || ':' || name)``: a pure
function of the row key and the draw's name, so results are reproducible,
recomputable after an executor loss and checkable in SQL, while draws of
different names are independent and cover any dimension size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_BITS = 60
WEIGHT_MODULUS = 1000

# Names of the draws, one per decision (our own choice).
STAGE = "stage"
TERRITORY = "territory"
CUSTOMER_SIZE = "customer_size"
CATEGORY = "category"
PRODUCT = "product"
CUSTOMER = "customer"
POSITION = "position"


def key_draw(key: Column | str, name: str) -> Column:
    """BIGINT draw in [0, 2**60) from a key column (NULL for a NULL key)."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f":{name}")).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("long")


def weighted_choice(draw: Column, weights: Sequence[int],
                    labels: Sequence[object]) -> Column:
    """Cumulative-weight bucketing: the first label whose running weight exceeds the draw.

    ``weights`` are in per-mille (they sum to 1000) and meet ``draw mod 1000``;
    the last label takes the remainder like an ``ELSE`` branch.
    """
    if len(weights) != len(labels) or not labels:
        raise ValueError("weights and labels must have the same non-zero length")
    if sum(weights) != WEIGHT_MODULUS:
        raise ValueError(f"weights must sum to {WEIGHT_MODULUS}, got {sum(weights)}")
    mille = F.pmod(draw, F.lit(WEIGHT_MODULUS))
    expr = None
    bound = 0
    for weight, label in zip(weights[:-1], labels[:-1]):
        bound += weight
        cond = mille < F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    last = F.lit(labels[-1])
    return last if expr is None else expr.otherwise(last)


def kth_of(draw: Column, count: Column) -> Column:
    """1-based pick ``1 + draw mod count``; NULL where the count is 0 or NULL."""
    n = F.nullif(count.cast("long"), F.lit(0).cast("long"))
    return (F.lit(1) + F.pmod(draw.cast("long"), n)).cast("long")
