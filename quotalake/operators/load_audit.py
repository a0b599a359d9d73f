"""Audits D3 and D4 at load time: the write of the facts counts their violations.

``materialize_audited`` builds the star as ``Star.materialize`` does, with
observed metrics on the scans of line items and orders, on the priced sales and on
the pipeline.  The pass that writes a fact also counts, so no fact is read again;
the remaining rules (dimensions, calendar, targets) are counted on the written
star, whose targets come from the written rep-months.

An observed row is counted at least once: a zero proves a rule.  A map stage that
runs again after a lost executor may count rows twice, so a rule with violations
is counted once more by its audit.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quotalake.operators import audits
from quotalake.sources.star import MaterializedStar, Star

_ROW = "rule string, table_name string, violations long"

#: Frames whose rules are counted while a fact is written, under the step that counts them.
OBSERVED = {
    "sales_source": "lineitem", "sales_order_source": "orders", "sales": "sales",
    "opportunities": "pipeline", "pipeline": "pipeline",
}
#: The source columns behind the rules on line items and orders.
_SOURCE = {
    "lineitem": {"product_id": "l_partkey", "salesperson_id": "l_suppkey", "quantity": "l_quantity"},
    "orders": {"customer_id": "o_custkey", "sale_date": "o_orderdate"},
}


@dataclass
class LoadAudit:
    """The rules counted at each step of a build, and their observations."""

    rules: dict[str, list[tuple[str, str, Column]]]
    observations: dict[str, Observation] = field(default_factory=dict)

    def observe(self, step: str, df: DataFrame) -> DataFrame:
        """``df`` with counts of the step's violations."""
        counts = [F.count(F.when(bad, F.lit(1))).alias(f"r{i}") for i, (_, _, bad) in enumerate(self.rules.get(step, []))]
        if not counts:
            return df
        self.observations[step] = Observation(f"{step}-{uuid.uuid4().hex}")
        return df.observe(self.observations[step], *counts)

    def counted(self) -> list[tuple[str, str, int]]:
        """(rule, table, violations) of everything observed; waits for the writes to end."""
        return [(rule, table, self.observations[step].get[f"r{i}"])
                for step, rules in self.rules.items() for i, (rule, table, _) in enumerate(rules)]


class _ObservedTables:
    """A source whose line items and orders carry observations."""

    def __init__(self, inner, audit: LoadAudit):
        self.inner, self.audit = inner, audit

    def table(self, name: str) -> DataFrame:
        df = self.inner.table(name)
        if name not in _SOURCE:
            return df
        # only the columns of the fact: a metric must not widen the scan
        wanted = [c for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
                              "o_orderkey", "o_custkey", "o_orderdate") if c in df.columns]
        return self.audit.observe(name, df.select(*wanted))


def materialize_audited(star: Star, path: str | None = None,
                        partitions: int | None = None) -> tuple[MaterializedStar, DataFrame]:
    """(the written star, one (rule, table_name, violations) row per rule of D3 and D4)."""
    steps: dict[str, list[tuple[str, str, Column]]] = {}
    rest: dict[tuple[str, str], list[tuple[str, Column]]] = {}
    for group in (audits.check_rules(), audits.not_null_rules(star)):
        for (table, frame), rules in group.items():
            step = OBSERVED.get(frame)
            if step is None:
                rest.setdefault((table, frame), []).extend(rules)
            elif step in _SOURCE:
                names = _SOURCE[step]
                steps.setdefault(step, []).extend(
                    (rule, table, F.col(names[rule.split(".")[1]]).isNull()) for rule, _ in rules)
            else:
                steps.setdefault(step, []).extend((rule, table, bad) for rule, bad in rules)
    audit = LoadAudit(steps)
    builder = Star(star.spark, _ObservedTables(star.source, audit), star.config)
    built = star.materialize(path, partitions, sales=audit.observe("sales", builder.sales),
                             pipeline=audit.observe("pipeline", star.pipeline))
    counted = audit.counted()
    found = [row for row in counted if not row[2]]
    suspect = {row[0] for row in counted if row[2]}
    again: dict[tuple[str, str], list[tuple[str, Column]]] = {}
    for group in (audits.check_rules(), audits.not_null_rules(star)):
        for key, rules in group.items():
            hit = [r for r in rules if r[0] in suspect]
            if hit:
                again.setdefault(key, []).extend(hit)
    rows = star.spark.createDataFrame(found, _ROW).unionByName(audits.per_frame(built, rest))
    return built, rows.unionByName(audits.per_frame(star, again)) if again else rows
