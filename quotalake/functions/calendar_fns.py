"""Date attribute expressions used by the calendar dimension and the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the financial year runs July to June and is named by the
# calendar year in which it ends ("FY" + year), so July opens the next FY.
FY_FIRST_MONTH = 7
FY_PREFIX = "FY"


def month_name(d: Column) -> Column:
    """Full English month name (not blank-padded)."""
    return F.date_format(d, "MMMM")


def financial_year(d: Column) -> Column:
    """'FY' || ending year of the July-June financial year containing d."""
    fy = F.year(d) + F.when(F.month(d) >= F.lit(FY_FIRST_MONTH), F.lit(1)).otherwise(F.lit(0))
    return F.concat(F.lit(FY_PREFIX), fy.cast("string"))


def iso_week(d: Column) -> Column:
    """ISO-8601 week number (1-53); 1 January can fall in week 52/53 of the prior year."""
    return F.weekofyear(d)
