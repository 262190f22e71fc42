"""Registered queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from airway.checks.fixtures import Fixtures


@dataclass(frozen=True)
class Check:
    name: str
    covers: list[str]
    build: Callable[[Fixtures], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(Fixtures(spark, sf_dir))


CHECKS: dict[str, Check] = {}


def check(covers: str, sql: str | None = None):
    """Register a query under its function's name; ``covers`` lists inventory ids."""

    def register(build):
        name = build.__name__
        if name in CHECKS:
            raise ValueError(f"query {name} registered twice")
        CHECKS[name] = Check(name, covers.split(), build, sql)
        return build

    return register
