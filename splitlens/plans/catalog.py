"""Registered queries: Spark plans over the experiment tables derived from a
scale-factor directory, each paired with DuckDB SQL that computes the same
result the plain way (the correctness oracle).

Every computed column is aliased identically on both sides; doubles that come
out of sums or long formulas are rounded on both sides (``ROUND_DIGITS``)
because the two engines add in different orders.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlens.plans.oracle_fixtures import with_fixtures
from splitlens.sources.fixtures import Fixtures

ROUND_DIGITS = 9


@dataclass
class Entry:
    name: str
    build: Callable[[Fixtures], DataFrame]
    sql: str | None
    doubles: tuple = ()
    digits: int = ROUND_DIGITS

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(fixtures_for(spark, sf_dir))
        if self.doubles:
            df = df.withColumns({c: F.round(F.col(c), self.digits) for c in self.doubles})
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        return with_fixtures(self.sql, self.doubles, self.digits)


REGISTRY: dict[str, Entry] = {}
_FIXTURES: dict[tuple, Fixtures] = {}


def fixtures_for(spark: SparkSession, sf_dir: str) -> Fixtures:
    """One set of fixture frames per session and directory: the test tables
    are static, so their file listings and derived plans are built once and
    shared by every registered query (library readers are not cached)."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    fx = _FIXTURES.get(key)
    if fx is None:
        fx = _FIXTURES[key] = Fixtures(spark, sf_dir)
    return fx


def register(name: str, sql: str | None, doubles=(), digits: int = ROUND_DIGITS):
    """Register a query; ``doubles`` are rounded to ``digits`` places on both
    sides (fewer places for large sums, whose last bits depend on the order
    of addition)."""
    def deco(fn):
        REGISTRY[name] = Entry(name, fn, sql, tuple(doubles), digits)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: e.run for k, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: e.oracle() for k, e in REGISTRY.items() if e.sql is not None}


def _load_all():
    # Importing the modules registers their queries.
    from splitlens.plans import q_readout, q_mart, q_reporting, q_people, q_tables  # noqa: F401
