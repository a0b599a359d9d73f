from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quotalake.session import local_session  # noqa: E402
from quotalake.sources.star import Star, StarConfig, with_money_columns  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app_name="quotalake-tests")
    yield s
    s.stop()


class DictTables:
    """A table source backed by in-memory DataFrames (driver-table schemas)."""

    def __init__(self, frames):
        self.frames = frames

    def table(self, name):
        return self.frames[name]


def star_with(spark, config: StarConfig | None = None, tables=None, **frames) -> Star:
    """A Star whose frames (sales, pipeline, ...) are given directly.

    ``Star`` memoizes its frames as cached properties, so pre-filling the
    instance dictionary replaces a frame; everything derived from it
    (monthly actuals, targets, reports) is computed by the library as usual.
    """
    star = Star(spark, DictTables(tables or {}), config or StarConfig())
    for name, df in frames.items():
        if name == "sales":
            df = with_money_columns(df)
        star.__dict__[name] = df
        if name == "pipeline":
            star.__dict__["opportunities"] = star.__dict__["opportunities_with_rep"] = df
    return star
